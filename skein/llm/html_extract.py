"""Operator 6, HTML extraction by tree scoring.

A page is read once into a flat tree. Each paragraph has points for its length and its commas, which it passes to its
parent in full and to further ancestors in falling shares; an ancestor's sum is discounted by the share of its text
that stands in links. The best container is kept with those siblings that score well beside it. What can't be part of
an article (menus, headers, footers, sidebars, notices, adverts, forms, comments) is taken out before and never comes
back. Pages are independent, so Spark deals them out and a worker holds one batch of them.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from html import unescape

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skein.llm.common import table


@dataclass(frozen=True)
class Params:
    #: Characters from which a block counts as a paragraph.
    paragraph: int = 25
    #: Share of the best score from which a sibling is kept.
    sibling: float = 0.2
    #: Share of link text up to which a heading, paragraph or list beside the best container is kept.
    link_density: float = 0.25
    #: How many times the score of a page's only article element counts against containers outside it.
    named: float = 2.0
    #: Share of a page's unlinked text from which an element is a wrapper, whatever its name.
    wrapper: float = 0.7
    #: Links from which a block inside the container that is nothing but links is a menu, and the share that makes it one.
    menu_links: int = 3
    menu_density: float = 0.9
    #: Share of link text up to which a part of the article stays whose name could be its subject.
    subject_density: float = 0.3


# Names of HTML elements by their role.
VOID = frozenset("area base br col embed frame hr img input link meta param source track wbr".split())
RAW = frozenset("script style title textarea noscript iframe noembed noframes xmp template svg".split())
BLOCK = frozenset(
    "address article aside blockquote body center dd details dialog dir div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr html li main menu nav ol p pre section summary table tbody td tfoot th thead tr ul caption".split()
)
ENDS_P = BLOCK - frozenset("body html li dd dt td th tr tbody thead tfoot caption summary".split())
DROP = frozenset("head script style title textarea noscript iframe noembed noframes xmp template svg annotation annotation-xml object applet canvas audio video nav footer aside button select option datalist dialog menu fieldset label".split())
DROP_ROLES = frozenset("navigation banner contentinfo complementary search alert alertdialog dialog menu menubar toolbar tooltip status form".split())
#: Words of class and id attributes that mark what isn't the article.
DROP_WORDS = frozenset(
    "ad adblock adbox adslot adunit ads adv advert adverts advertisement advertising adsense alert alerts banner breadcrumb breadcrumbs comment comments commentlist consent cookie cookies copyright discussion discussions disqus feedback footer gdpr header login masthead menu menus modal nav navbar navigation newsletter notice notices notification outbrain overlay pagination pager paywall popup privacy promo promoted promotion recommended related replies reply respond response responses share sharing sidebar sidenav signup skip social sponsor sponsored subnav subscribe subscription taboola toolbar topbar topnav widget widgets".split()
)
#: Those that mark what readers wrote, which can be longer than the article.
TALK_WORDS = frozenset("comment comments commentlist discussion discussions disqus feedback replies reply respond response responses".split())
#: Words that make a "header" the article's own.
OWN_WORDS = frozenset("article content entry post story".split())
#: Those that are as often the subject of a section of the article as what stands beside it.
SUBJECT_WORDS = frozenset("ad ads adv alert alerts banner consent cookie cookies copyright discussion discussions feedback footer header login menu menus modal navigation notice notices notification overlay privacy promotion recommended related reply respond response responses share sharing skip social sponsor subscription widget widgets".split())
#: Those that name a part of a text itself, in class or id, unless readers' words or a form are in it.
TOPIC_WORDS = frozenset("consent copyright discussion discussions feedback privacy response responses".split())
#: Words for a box. Inside an article a name counts if it is made of these and unwanted words alone: "ad-box", but not
#: "response-curve", "share-heading" or "privacy-in-law".
BOX_WORDS = frozenset(
    "area article articles bar block bottom box btn button buttons center col column container content count cta entries entry fixed float form global group icon icons inline inner item items js large left link links list main mobile outer page panel post posts primary right row rows secondary section site slot small sticky stories text the this thread top unit us with wp wrap wrapper you your zone".split()
)
#: Elements inside an article whose id is an anchor of its text and says nothing of their role.
ANCHORED = frozenset("h1 h2 h3 h4 h5 h6 p pre blockquote li dt dd td th tr table figure a span".split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
#: Elements that a class name alone doesn't take out.
SAFE = frozenset("html body article main".split())
PARAGRAPH = frozenset("p pre td blockquote li dd dt h1 h2 h3 h4 h5 h6 figcaption address summary".split())
#: What belongs to the text around it, however short.
BESIDE = frozenset("h1 h2 h3 h4 h5 h6 p pre blockquote ul ol dl table figure".split())
#: Lists: beside an article element, more likely comments or teasers than its text.
LISTS = frozenset("ul ol li dl dt dd".split())
#: A new one ends an open one, if no element of the second set lies between.
IMPLIED = {"li": ("li", "ul ol menu dir"), "dt": ("dt dd", "dl"), "dd": ("dt dd", "dl"), "td": ("td th", "tr table"), "th": ("td th", "tr table"), "tr": ("tr td th", "table"), "tbody": ("tbody thead tfoot tr td th", "table"), "thead": ("tbody thead tfoot tr td th", "table"), "tfoot": ("tbody thead tfoot tr td th", "table"), "option": ("option", "select"), "optgroup": ("option optgroup", "select")}
IMPLIED = {k: (frozenset(a.split()), frozenset(b.split())) for k, (a, b) in IMPLIED.items()}

TOKEN = re.compile(r"""<!--.*?(?:--!?>|\Z)|<[!?][^>]*+(?:>|\Z)|<(/?)([a-zA-Z][^\s/>]*+)((?:[^>"']++|"[^"]*+"|'[^']*+')*+)>|<(/?)([a-zA-Z][^\s/>]*+)([^>]*+)(?:>|\Z)""", re.S)
MARKS = re.compile(r"""\b(class|id|role|hidden|aria-hidden|style)\b(?:\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+))?""", re.I)
PIECES = re.compile(r"[a-z]+|[A-Z]+(?![a-z])|[A-Z][a-z]+")


#: Why an element is taken out: for good; or by a name, of readers' words or other ones, unless it turns out to be a wrapper;
#: or, inside an article, by a name that its subject may have, if it is full of links or holds a form or readers' words; if
#: the name is a class, then also if it has no heading.
ALWAYS, TALK, NAME, HEADED, SUBJECT = 5, 4, 3, 2, 1


def unwanted(tag: str, attrs: str, in_article: bool) -> int:
    """Why an element can't be part of the article; 0 if it can."""
    if tag in DROP or (tag == "header" and not in_article):
        return ALWAYS
    out = NAME if tag == "form" else 0
    if not attrs or tag == "html":
        return out
    for m in MARKS.finditer(attrs):
        name, value = m[1].lower(), (m[2] or "").strip("\"'")
        if name == "hidden" or (name == "aria-hidden" and value.lower() == "true"):
            return ALWAYS
        if name == "role" and value.lower() in DROP_ROLES:
            return ALWAYS
        if name == "style" and re.search(r"display\s*:\s*none|visibility\s*:\s*hidden", value, re.I):
            return ALWAYS
        if name in ("class", "id") and (tag not in SAFE or (tag == "article" and in_article)):
            names = {w.lower() for w in PIECES.findall(value)}
            if not (found := names & DROP_WORDS - ({"header"} if in_article or names & OWN_WORDS else set())):
                continue
            if in_article:
                each = [{w.lower() for w in PIECES.findall(x)} for x in value.split()]
                found = found & set().union(*(x for x in each if x <= DROP_WORDS | BOX_WORDS))
                if not found or name == "id" and tag in ANCHORED:
                    continue
                if not found - TOPIC_WORDS or name == "id" and tag == "section" and not found - SUBJECT_WORDS:
                    out = max(out, SUBJECT if name == "id" else HEADED)
                    continue
            out = max(out, TALK if found & TALK_WORDS else NAME)
    return out


class Tree:
    """Elements in page order, each after its parent, why each is unwanted, and the pieces of text not taken out for good."""

    def __init__(self, html: str):
        self.tag, self.parent, self.kept, self.why = ["#root"], [-1], [True], [0]
        self.pieces: list[tuple[int, str]] = []  # (element, text); a blank text stands for a break
        stack, at, end = [0], 0, len(html)
        opened = Counter(("#root",))  # tags on the stack
        article = 0  # open article or main elements
        while at < end:
            m = TOKEN.search(html, at)
            if (to := m.start() if m else end) > at and self.kept[stack[-1]]:
                self.pieces.append((stack[-1], unescape(html[at:to])))
            if not m:
                break
            at = m.end()
            tag = (m[2] or m[5] or "").lower()
            if not tag:
                continue
            if m[1] or m[4]:
                if tag in ("body", "html") or not opened[tag]:
                    continue
                while True:
                    x = stack.pop()
                    opened[self.tag[x]] -= 1
                    article -= self.tag[x] in ("article", "main")
                    if self.tag[x] == tag:
                        break
                if tag in BLOCK:
                    self.pieces.append((stack[-1], " "))
                continue
            if tag in BLOCK or tag == "br":
                self.pieces.append((stack[-1], " "))
            ends = (frozenset(("p",)), BLOCK - {"p"}) if tag in ENDS_P else IMPLIED.get(tag)
            if ends:
                for k in range(len(stack) - 1, 0, -1):
                    if (t := self.tag[stack[k]]) in ends[0]:
                        opened.subtract(self.tag[x] for x in stack[k:])
                        del stack[k:]
                        break
                    if t in ends[1]:
                        break
            attrs = m[3] if m[2] else m[6]
            why = unwanted(tag, attrs, article > 0)
            if tag in RAW:
                if attrs.endswith("/") and tag == "svg":
                    continue
                close = re.compile(rf"</{tag}\b[^>]*>", re.I).search(html, at)
                at = close.end() if close else end
                continue
            if tag in VOID or attrs.endswith("/") and tag not in BLOCK:
                continue
            self.tag.append(tag)
            self.parent.append(stack[-1])
            self.kept.append(self.kept[stack[-1]] and why != ALWAYS)
            self.why.append(why)
            stack.append(len(self.tag) - 1)
            opened[tag] += 1
            article += tag in ("article", "main")


def dropped(t: Tree, p: Params) -> list[bool]:
    """Whether each element is in one that is unwanted by its name and is no wrapper of the page's text.

    A wrapper holds most of the unlinked text; if there is an article element beside it, it holds that much in blocks.
    What is named after readers' words must also hold an h1 or main; other readers' words aren't counted."""
    n = len(t.tag)
    linked, every = [0] * n, [0] * n
    link, talk, holds, mass = [False] * n, [False] * n, [False] * n, [0] * n
    block, direct, named, articles = [0] * n, [0] * n, [False] * n, [0] * n
    for i in range(1, n):
        link[i] = t.tag[i] == "a" or link[t.parent[i]]
        block[i] = i if t.tag[i] in BLOCK else block[t.parent[i]]
        named[i] = named[t.parent[i]] or t.why[i] in (NAME, TALK)
        articles[i] = int(t.kept[i] and t.tag[i] in ("article", "main"))
        holds[i] = t.kept[i] and t.tag[i] in ("h1", "main")
    free = any(articles[i] and not named[i] for i in range(n))
    talks = [False] * n  # something in it is a form, or named after readers' words
    headed = [x in HEADINGS for x in t.tag]
    for i in range(n - 1, 0, -1):
        talks[t.parent[i]] |= talks[i] or t.tag[i] == "form" or t.why[i] == TALK
        holds[t.parent[i]] |= holds[i]
        headed[t.parent[i]] |= headed[i]
        articles[t.parent[i]] += articles[i]
    for i in range(1, n):
        talk[i] = talk[t.parent[i]] or (t.why[i] == TALK and not holds[i])
    for i, text in t.pieces:
        k = len("".join(text.split()))
        every[i] += k
        linked[i] += k * link[i]
        if not link[i] and not talk[i]:
            mass[i] += k
            direct[block[i]] += k
    for i in range(n - 1, 0, -1):
        for sums in (mass, every, linked):
            sums[t.parent[i]] += sums[i]
    out = [False] * n
    for i in range(1, n):
        own = mass[i] - direct[i] if free and not articles[i] and not holds[i] else mass[i]
        by_name = t.why[i] in (NAME, TALK) and (talk[i] or not own or own < p.wrapper * mass[0])
        other = talks[i] or linked[i] > p.subject_density * every[i] or t.why[i] == HEADED and not headed[i]
        by_subject = t.why[i] in (SUBJECT, HEADED) and other
        out[i] = out[t.parent[i]] or by_name or by_subject
    return out


def main_text(html: str | None, p: Params = Params()) -> str:
    """The article of a page as one line of text; empty if there is none."""
    t = Tree(html or "")
    if not any(0 < t.why[i] < ALWAYS for i in range(len(t.tag))):
        return scored_text(t, t.pieces, p)
    out = dropped(t, p)
    text = scored_text(t, [(i, x) for i, x in t.pieces if not out[i] or x == " "], p)
    return text or scored_text(t, t.pieces, p)  # the names left nothing


def scored_text(t: Tree, pieces: list[tuple[int, str]], p: Params) -> str:
    """The best container of some of the tree's pieces and what is kept beside it."""
    n = len(t.tag)
    block, link = [0] * n, [False] * n  # nearest block around (or itself); inside a link
    for i in range(1, n):
        block[i] = i if t.tag[i] in BLOCK else block[t.parent[i]]
        link[i] = t.tag[i] == "a" or link[t.parent[i]]
    chars, linked, commas, own, titled = [0] * n, [0] * n, [0] * n, [0] * n, [0] * n
    for i, text in pieces:
        if k := len("".join(text.split())):
            b = block[i]
            own[b] += k
            commas[b] += text.count(",")
            chars[b] += k
            linked[b] += k * link[i]
            titled[b] += k * (t.tag[b] == "h1")
    links = [int(t.tag[i] == "a") for i in range(n)]
    for i in range(n - 1, 0, -1):
        for sums in (chars, linked, titled, links):
            sums[t.parent[i]] += sums[i]
    inner = [False] * n  # inside or itself an element that names the article
    listed = [False] * n  # in a list outside such an element
    for i in range(1, n):
        inner[i] = inner[t.parent[i]] or t.tag[i] in ("article", "main")
        listed[i] = not inner[i] and (listed[t.parent[i]] or t.tag[i] in LISTS)

    def scores(least: int, lists: bool = True) -> list[float]:
        score = [0.0] * n
        for i in range(n):
            if own[i] >= least and (lists or not listed[i]):
                points, up, share = 1 + commas[i] + min(own[i] / 100, 3), i, 1.0
                if t.tag[i] in PARAGRAPH:
                    up = max(t.parent[i], 0)
                for depth in range(2, 7):
                    score[up] += points * share
                    up, share = t.parent[up], 1 / depth if depth < 3 else 1 / (depth * 1.5)
                    if up < 0:
                        break
        return [s * (1 - linked[i] / chars[i]) if chars[i] else 0.0 for i, s in enumerate(score)]

    for least in (p.paragraph, 1):  # if nothing is long enough, whatever there is
        score = scores(least)
        best = max(range(n), key=score.__getitem__)
        if score[best] > 0:
            break
    else:
        return ""
    named = [i for i in range(1, n) if inner[i] and not inner[t.parent[i]] and score[i] > 0]
    up = best
    while up > 0 and t.tag[up] not in ("article", "main"):
        up = t.parent[up]
    if up <= 0 and len(named) == 1:
        plain = scores(least, lists=False)
        if p.named * plain[named[0]] >= max(plain[i] for i in range(n) if not inner[i]):
            up = named[0]
    if up > 0:  # the page names its article
        score[up] = max(score[up], score[best]) if inner[best] else score[up]
        best = up
    chosen = {best}
    for i in range(1, n):
        if best and i != best and t.parent[i] == t.parent[best] and chars[i]:
            dense = linked[i] / chars[i]
            strong, part = score[i] >= max(4.0, p.sibling * score[best]), t.tag[i] in BESIDE and dense < p.link_density
            if [best] == named:  # beside a page's only article no lists and nothing short but its title
                strong, part = strong and t.tag[i] not in LISTS, False
            if titled[i] == chars[i] and dense < p.link_density or strong or part:
                chosen.add(i)
    inside = [False] * n
    for i in range(n):
        menu = t.tag[i] in BLOCK and i not in chosen and not inner[i] and links[i] >= p.menu_links and linked[i] >= p.menu_density * chars[i]
        inside[i] = i in chosen or (i > 0 and inside[t.parent[i]] and not menu)
    return " ".join("".join(text if inside[i] else " " for i, text in pieces).split())


def extract(pages: DataFrame, p: Params = Params()) -> DataFrame:
    """``pages`` with the article of ``html`` as text and its code points as n_chars; columns of these names go.

    Null or empty html, and a page without text, give the empty text. Unclosed or misnested tags are read as browsers
    do, as far as they change the text. Rows are independent: repeated ones give repeated rows, none gives none."""

    @F.pandas_udf("string")
    def run(htmls: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for h in htmls:
            yield pd.Series([main_text(x, p) for x in h], dtype=object)

    out = pages.drop("text", "n_chars").withColumn("text", run("html"))
    return out.withColumn("n_chars", F.length("text").cast("long"))


def op6(spark, sf_dir: str) -> DataFrame:
    return extract(table(spark, sf_dir, "pages").select("page_id", "url", "html")).select("page_id", "url", "text", "n_chars")
