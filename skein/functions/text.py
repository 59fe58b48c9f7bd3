"""Text predicates and builders, as column expressions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from skein.schemas import PREFIX, TOC_MARKERS

#: White space as Python's str.strip() knows it; Java's class lacks U+001C to U+001F.
WHITE = r"[\s\x1c-\x1f]"


def is_blank(c: Column) -> Column:
    return c.rlike(rf"(?U)^{WHITE}*$")


def strip(c: Column) -> Column:
    return F.regexp_replace(c, rf"(?U)^{WHITE}+|{WHITE}+$", "")


def printable(c: Column) -> Column:
    """Without control characters and without separators other than the space."""
    return F.regexp_replace(c, r"[\p{C}\p{Z}&&[^ ]]", "")


def stem(name: Column) -> Column:
    """A file name without its last extension."""
    return F.regexp_replace(name, r"(?<=[^.])\.[^.]*$", "")


def merged_name(name: Column) -> Column:
    return F.replace(name, F.lit(".jsonl"), F.lit("-merged.jsonl"))


def breadcrumb(*headers: Column) -> Column:
    """Present headers in order; null is absent, empty is present."""
    return F.concat_ws(" > ", *headers)


def prefixed(crumb: Column, content: Column, prefix: str = PREFIX) -> Column:
    return F.concat(F.lit(prefix), crumb, F.lit("\n\n"), content)


def is_toc(text: Column, markers: Sequence[str] = TOC_MARKERS) -> Column:
    """Whether the lower-cased text holds a marker of a table of contents."""
    low, out = F.lower(text), F.lit(False)
    for m in markers:
        out = out | F.contains(low, F.lit(m))
    return out
