"""Queries over the test tables, one per operator, with the SQL each must equal.

The tables hold no Markdown headers, JSON lines or tables of contents, so these are made of their columns, by the same
expressions on both sides. ``source`` stands for the file and ``doc_id`` for the line order."""

from __future__ import annotations

import uuid
from collections.abc import Callable
from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from skein.functions import text as tx
from skein.functions.lineage import shared_folder
from skein.functions.tokens import count_tokens
from skein.operators import dataset, pack, parse, prompt, records, sections, split
from skein.operators.incremental import skip_existing
from skein.plans import prepare
from skein.schemas import PREFIX, Config
from skein.sources import files, named, sinks

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}
EOS = "<|end_of_text|>"
WORDS = r"len(regexp_extract_all({}, '[^ \n\r\t]+'))::bigint"


def query(sql: str | None = None):
    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            ORACLES[f.__name__] = sql
        return f

    return add


def read(spark: SparkSession, d: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{d}/{name}.parquet")


def length(c: str):
    return F.length(c).cast("long")


@query("select doc_id, length(text)::bigint n_chars from documents where length(text) >= 800")
def min_chars(spark, d):
    return read(spark, d, "documents").filter(records.min_chars(F.col("text"))).select("doc_id", length("text").alias("n_chars"))


@query(f"select doc_id, {WORDS.format('text')} n_words from documents")
def word_count(spark, d):
    return read(spark, d, "documents").select("doc_id", count_tokens(F.col("text")).alias("n_words"))


@query("select source source_file, doc_id, row_number() over (partition by source order by doc_id)::bigint id from documents where length(text) >= 800")
def seq_id(spark, d):
    rows = read(spark, d, "documents").filter(records.min_chars(F.col("text"))).withColumnRenamed("source", "source_file")
    return records.sequential_ids(rows, "source_file", ["doc_id"]).select("source_file", "doc_id", "id")


@query("select doc_id, row_number() over (order by md5(concat_ws(':', '42', doc_id::varchar)), doc_id)::bigint pos from documents")
def hash_shuffle(spark, d):
    return dataset.hash_shuffle(read(spark, d, "documents"), "doc_id").select("doc_id", F.col("pos").cast("long").alias("pos"))


@query("select doc_id, md5(text) text_md5 from documents order by md5(concat_ws(':', '42', doc_id::varchar)), doc_id limit 1")
def first_row(spark, d):
    return dataset.first_row(dataset.hash_shuffle(read(spark, d, "documents"), "doc_id")).select("doc_id", F.md5("text").alias("text_md5"))


#: every fifth document gets a marker, in changing case; every seventh one that is a dot short
_MARKED = "case when doc_id % 5 = 0 then concat(text, ' ', case doc_id % 3 when 0 then 'SPIS TREŚCI' when 1 then 'Contents' else 'x.......9' end) when doc_id % 7 = 0 then concat(text, '......') else text end"


@query(f"""with m as (select doc_id, {_MARKED} t from documents)
select doc_id, md5(t) text_md5 from m where not (contains(lower(t), '.......') or contains(lower(t), 'spis treści') or contains(lower(t), 'contents'))""")
def toc_filter(spark, d):
    rows = read(spark, d, "documents").select("doc_id", F.expr(_MARKED).alias("t"))
    return rows.filter(~tx.is_toc(F.col("t"))).select("doc_id", F.md5("t").alias("text_md5"))


@query("""with recursive w as (
  select source, doc_id, text, lang, len(regexp_extract_all(text, '[^ \\n\\r\\t]+'))::bigint n, row_number() over (partition by source order by doc_id) k from documents),
fold as (
  select source, k, n total, 1::bigint bin from w where k = 1
  union all
  select w.source, w.k, case when f.total + w.n > 2000 then w.n else f.total + w.n end, case when f.total + w.n > 2000 then f.bin + 1 else f.bin end
  from fold f join w on w.source = f.source and w.k = f.k + 1)
select w.source source_file, f.bin id, max(i.lang) instruction, md5(string_agg(w.text, chr(10) || chr(10) order by w.doc_id)) input_md5, '' as output, sum(w.n)::bigint n_tokens, count(*)::bigint n_parts
from w join fold f on w.source = f.source and w.k = f.k
join (select source, lang from w where k = 1) i on i.source = w.source group by w.source, f.bin""")
def next_fit_pack(spark, d):
    rows = read(spark, d, "documents").select(F.col("source").alias("source_file"), F.col("doc_id").alias("pos"), F.col("lang").alias("instruction"), F.col("text").alias("input"), count_tokens(F.col("text")).alias("n"))
    out = pack.next_fit_pack(rows, 2000)
    return out.select("source_file", "id", "instruction", F.md5("input").alias("input_md5"), "output", "n_tokens", "n_parts")


_ROLES = "(select conv_id, turn, case when conv_id % 3 = 0 then null when conv_id % 3 = 1 then role else '' end instruction, text input, case when turn % 4 = 3 then null else role end output from conversations)"
_PROMPT = f"concat('### Instruction:', chr(10), coalesce(instruction, 'None'), chr(10), chr(10), '### Input:', chr(10), coalesce(input, 'None'), chr(10), chr(10), '### Output:', chr(10), coalesce(output, 'None'), '{EOS}')"


def _turns(spark, d):
    c = read(spark, d, "conversations")
    return c.selectExpr("conv_id", "turn", "case when conv_id % 3 = 0 then null when conv_id % 3 = 1 then role else '' end instruction", "text input", "case when turn % 4 = 3 then null else role end output")


@query(f"select conv_id, turn, {_PROMPT} as text from {_ROLES}")
def prompt_text(spark, d):
    return prompt.with_prompt(_turns(spark, d), EOS).select("conv_id", "turn", "text")


@query(f"""with p as (select conv_id, turn, {_PROMPT} as text from {_ROLES})
select conv_id, turn, (instr(text, '### Output:' || chr(10)) + 12)::bigint resp_start, substr(text, 1, instr(text, '### Output:' || chr(10)) + 11) as prompt, substr(text, instr(text, '### Output:' || chr(10)) + 12) response from p""")
def response_span(spark, d):
    return prompt.response_span(prompt.with_prompt(_turns(spark, d), EOS)).select("conv_id", "turn", "resp_start", "prompt", "response")


#: Markdown of a document's lines: some become headers of changing levels, some are followed by a blank line
_LINE = "case when i % 5 = 0 then concat(repeat('#', (i + doc_id) % 4 + 1), ' ', substr(line, 1, 12)) when i % 7 = 3 then concat(line, chr(10)) when i % 11 = 6 then '##' else line end"


def markdown(spark, d) -> DataFrame:
    docs = read(spark, d, "documents").select("doc_id", F.split("text", "\n").alias("l"))
    line = lambda x, i: F.when(i % 5 == 0, F.concat(F.repeat(F.lit("#"), ((i + F.col("doc_id")) % 4 + 1).cast("int")), F.lit(" "), F.substring(x, 1, 12))).when(i % 7 == 3, F.concat(x, F.lit("\n"))).when(i % 11 == 6, F.lit("##")).otherwise(x)
    return docs.select(F.col("doc_id").cast("string").alias("source_file"), F.array_join(F.transform("l", line), "\n").alias("md"))


@query(f"""with a as (select doc_id, unnest(string_split(text, chr(10))) line, generate_subscripts(string_split(text, chr(10)), 1) - 1 i from documents),
md as (select doc_id::varchar source_file, string_agg({_LINE}, chr(10) order by i) md from a group by doc_id),
b as (select source_file, trim(unnest(string_split(md, chr(10)))) x, generate_subscripts(string_split(md, chr(10)), 1) pos from md),
c as (select *, case when regexp_matches(x, '^###( |$)') then 3 when regexp_matches(x, '^##( |$)') then 2 when regexp_matches(x, '^#( |$)') then 1 else 0 end lv from b),
e as (select *, trim(substr(x, lv + 1)) t,
  coalesce(max(case when lv = 1 then pos end) over w, -1) p1, coalesce(max(case when lv = 2 then pos end) over w, -1) p2, coalesce(max(case when lv = 3 then pos end) over w, -1) p3,
  sum(case when lv > 0 or x = '' then 1 else 0 end) over w blk
  from c window w as (partition by source_file order by pos)),
f as (select e.source_file, e.pos, e.x, e.blk, a.t h1, case when e.p2 > e.p1 then b2.t end h2, case when e.p3 > greatest(e.p1, e.p2) then b3.t end h3
  from e left join e a on a.source_file = e.source_file and a.pos = e.p1 left join e b2 on b2.source_file = e.source_file and b2.pos = e.p2
  left join e b3 on b3.source_file = e.source_file and b3.pos = e.p3 where e.lv = 0 and e.x <> ''),
g as (select *, case when row_number() over w = 1 or lag(h1) over w is distinct from h1 or lag(h2) over w is distinct from h2 or lag(h3) over w is distinct from h3 then 1 else 0 end new,
  coalesce(lag(blk) over w = blk, false) same from f window w as (partition by source_file order by pos)),
h as (select *, sum(new) over (partition by source_file order by pos) - 1 sec from g)
select source_file, sec::bigint sec_pos, h1, h2, h3, substr(string_agg(case when same then chr(10) || x else '  ' || chr(10) || x end, '' order by pos), 4) as content
from h group by source_file, sec, h1, h2, h3""")
def header_sections(spark, d):
    return sections.header_sections(markdown(spark, d)).withColumn("sec_pos", F.col("sec_pos").cast("long"))


_HEADS = "case when page_id % 2 = 0 then concat('H', page_id % 10) end h1, case when page_id % 3 = 0 then '' when page_id % 3 = 1 then 'S' end h2, case when page_id % 5 < 2 then url end h3"


@query(f"select page_id, concat_ws(' > ', h1, h2, h3) crumb, concat('{PREFIX}', concat_ws(' > ', h1, h2, h3), chr(10), chr(10), url) as input from (select page_id, url, {_HEADS} from pages)")
def prefixed_input(spark, d):
    rows = read(spark, d, "pages").selectExpr("page_id", "url", *_HEADS.split(", case")[0:1], *("case" + x for x in _HEADS.split(", case")[1:]))
    crumb = tx.breadcrumb(F.col("h1"), F.col("h2"), F.col("h3"))
    return rows.select("page_id", crumb.alias("crumb"), tx.prefixed(crumb, F.col("url")).alias("input"))


def _chunks(spark, d) -> DataFrame:
    """Documents as chunks: the source is the only header, some carry a marker."""
    rows = read(spark, d, "documents")
    return rows.select(F.col("source").alias("source_file"), F.col("doc_id"), F.lit(None).cast("string").alias("h1"), F.col("source").alias("h2"), F.lit(None).cast("string").alias("h3"), F.expr(_MARKED).alias("content"))


_JUDGED = f"""(select source source_file, doc_id, t content, concat('{PREFIX}', source, chr(10), chr(10), t) as input from (select source, doc_id, {_MARKED} t from documents))"""
_TOC = "(contains(lower(input), '.......') or contains(lower(input), 'spis treści') or contains(lower(input), 'contents'))"
_VERDICT = "case when length(content) < {0} then 'short' when " + _TOC + " then 'toc' when length(input) < 200 then 'small' else 'saved' end"


@query(f"select source_file, doc_id, {_VERDICT.format(150)} verdict from {_JUDGED}")
def len_floor(spark, d):
    return records.verdicts(_chunks(spark, d), Config(min_characters=150)).select("source_file", "doc_id", "verdict")


@query(f"""with v as (select source_file, {_VERDICT.format(800)} v from {_JUDGED})
select source_file, count(*)::bigint n_chunks, count(*) filter (v = 'saved')::bigint n_saved, count(*) filter (v = 'short')::bigint n_short, count(*) filter (v = 'toc')::bigint n_toc, count(*) filter (v = 'small')::bigint n_small from v group by source_file""")
def run_report(spark, d):
    return records.run_report(records.verdicts(_chunks(spark, d)))


@query(f"""with v as (select source_file, doc_id, input, {_VERDICT.format(800)} v from {_JUDGED})
select source_file, row_number() over (partition by source_file order by doc_id)::bigint id, md5('{Config().instruction.replace("'", "''")}') instruction_md5, input, '' as output from v where v = 'saved'""")
def training_records(spark, d):
    out = records.training_records(records.verdicts(_chunks(spark, d)), ["doc_id"])
    return out.select("source_file", "id", F.md5("instruction").alias("instruction_md5"), "input", "output")


_GOOD = "'{\"instruction\": \"' || source || '\", \"input\": ' || doc_id || ', \"output\": \"' || lang || '\"'"
_JSON = f"""case doc_id % 9 when 0 then {_GOOD} || '}}' when 1 then {_GOOD} || ', "id": 7}}' when 2 then {_GOOD} || '}} x' when 3 then {_GOOD} when 4 then '{{"instruction": "i", "input": null, "output": "o"}}'
  when 5 then '{{"Instruction": "i", "input": "x", "output": "o"}}' when 6 then '[1, 2]' when 7 then '' else '{{"instruction": "i", "input": "x"}}' end"""


@query(f"""with j as (select doc_id, {_JSON} as v from documents),
ok as (select doc_id, case when json_valid(v) and v <> '' then v end v from j)
select doc_id, v->>'$.instruction' instruction, v->>'$.input' as input, v->>'$.output' as output from ok
where json_type(v) = 'OBJECT' and json_exists(v, '$.instruction') and json_exists(v, '$.input') and json_exists(v, '$.output')""")
def jsonl_parse(spark, d):
    return parse.records(read(spark, d, "documents").select("doc_id", F.expr(_JSON).alias("value")))


@query("select doc_id, value from (select doc_id, doc_id % 9 k, " + _JSON + " as value from documents) where k in (2, 3, 5, 6, 7, 8)")
def jsonl_rejects(spark, d):
    return parse.rejects(read(spark, d, "documents").select("doc_id", F.expr(_JSON).alias("value")))


#: lines of every JSON type, one of them malformed and one without a key
_TYPED = """case doc_id % 8 when 0 then '{"instruction":' || doc_id || ',"input":true,"output":null}' when 1 then '{"instruction":"' || lang || '","input":[1,"ś",{"a":null}],"output":-2.5}'
  when 2 then '{"id":1,"instruction":{"b":[],"c":' || doc_id || '},"input":"1","output":false}' when 3 then '{"instruction":"' || chr(92) || 'u015b ' || chr(92) || '" ' || chr(92) || chr(92) || ' ' || chr(92) || 'n","input":"","output":"' || source || '"}' when 4 then '{"instruction":1,"input":2}'
  when 5 then '{"instruction":1,"input":2,"output":' else '{"instruction":"i","input":"x","output":"o"}' end"""


@query(f"""with j as (select source, doc_id, {_TYPED} as v from documents), ok as (select source, doc_id, v::json v from j where json_valid(v) and json_exists(v, '$.output'))
select (v->'$.instruction')::varchar instruction, (v->'$.input')::varchar as input, (v->'$.output')::varchar as output, row_number() over (order by md5(concat_ws(':', '42', source, doc_id::varchar)), source, doc_id)::bigint pos from ok""")
def typed_final(spark, d):
    rows = read(spark, d, "documents").select(F.col("source").alias("source_file"), F.col("doc_id").alias("pos_in_file"), F.expr(_TYPED).alias("value"))
    out = prepare.final_set(rows)
    return out.select(*(F.to_json(F.col(k)).alias(k) for k in parse.KEYS), F.col("pos").cast("long").alias("pos"))


_STRICT = """case doc_id % 4 when 0 then '  ' when 1 then '{"input": "' || lang || '"}' when 2 then '{"instruction": null, "input": "' || source || '"}' else '{"instruction": "i", "input": "x", "output": "gone"}' end"""


@query("select doc_id, case doc_id % 4 when 1 then '' when 2 then null else 'i' end instruction, case doc_id % 4 when 1 then lang when 2 then source else 'x' end as input from documents where doc_id % 4 > 0")
def jsonl_strict(spark, d):
    return parse.strict(read(spark, d, "documents").select("doc_id", F.expr(_STRICT).alias("value")))


@query("select conv_id, min_by(instruction, turn) filter (instruction is not null) instruction from (select conv_id, turn, case when turn % 3 = conv_id % 3 then null else role end instruction from conversations) group by conv_id")
def first_instruction(spark, d):
    rows = read(spark, d, "conversations").selectExpr("conv_id", "turn", "case when turn % 3 = conv_id % 3 then null else role end instruction")
    return rows.groupBy("conv_id").agg(pack.first_instruction(F.col("instruction"), F.col("turn")).alias("instruction"))


@query("select doc_id from documents d where not exists (select 1 from labels l where l.doc_id = d.doc_id and l.toxic = 0)")
def skip_existing_files(spark, d):
    done = read(spark, d, "labels").filter("toxic = 0").select(F.concat(F.lit("f"), F.col("doc_id")).alias("stem"))
    rows = read(spark, d, "documents").select("doc_id", F.concat(F.lit("f"), F.col("doc_id"), F.lit(".pdf")).alias("source_file"))
    return skip_existing(rows, done).select("doc_id")


@query("select 'd' instruction, text as input, '' as output from documents union all select 'b', text, '' from benchmark")
def union_all(spark, d):
    of = lambda t, i: dataset.project(read(spark, d, t).select("*", F.lit(i).alias("instruction"), F.col("text").alias("input"), F.lit("").alias("output")))
    return dataset.union_all(of("documents", "d"), of("benchmark", "b"))


@query("select doc_id, replace(concat(source, case when doc_id % 2 = 0 then '.jsonl.jsonl' else '.jsonl' end), '.jsonl', '-merged.jsonl') merged_file, source stem from documents")
def file_names(spark, d):
    rows = read(spark, d, "documents").withColumn("f", F.concat("source", F.when(F.col("doc_id") % 2 == 0, ".jsonl.jsonl").otherwise(".jsonl")))
    return rows.select("doc_id", tx.merged_name(F.col("f")).alias("merged_file"), tx.stem(F.concat("source", F.lit(".pdf"))).alias("stem"))


@query("select doc_id, coalesce(case when toxic is null then null else concat('toxic=', toxic) end, '') as output from documents left join labels using (doc_id)")
def annotations_join(spark, d):
    rows = read(spark, d, "documents").select(F.col("source").alias("source_file"), F.col("doc_id").alias("id"), F.lit("").alias("output"))
    notes = read(spark, d, "labels").join(read(spark, d, "documents").select("doc_id", "source"), "doc_id").select(F.col("source").alias("source_file"), F.col("doc_id").alias("id"), F.concat(F.lit("toxic="), "toxic").alias("output"))
    return prepare.attach_outputs(rows, notes).select(F.col("id").alias("doc_id"), "output")


#: documents spread over some hundred files, so that no source is one file
_FILE = "concat(source, ' ', doc_id % 16, '.jsonl')"


@query(f"""select {_FILE} source_file, row_number() over (partition by {_FILE} order by doc_id)::bigint pos, md5(to_json(struct_pack(id := doc_id, instruction := lang, input := text, output := case when doc_id % 3 = 0 then null else source end))::varchar) line_md5
from documents""")
def written_lines(spark, d):
    """Records to named files and back, line by line."""
    rows = read(spark, d, "documents").select(F.expr(_FILE).alias("name"), F.col("doc_id").alias("id"), F.col("lang").alias("instruction"), F.col("text").alias("input"), F.expr("case when doc_id % 3 = 0 then null else source end").alias("output"))
    folder = f"{shared_folder(spark).rstrip('/')}/lines-{uuid.uuid4().hex}"
    named.write(rows.select("name", F.lit("saved").alias("verdict"), sinks.json_line("id", "instruction", "input", "output").alias("value"), F.col("id").alias("at")), folder, "at")
    return files.jsonl_lines(spark, folder).select("source_file", "pos", F.md5("value").alias("line_md5"))


@query()
def token_count(spark, d):
    return read(spark, d, "documents").select("doc_id", count_tokens(F.col("text"), "bpe_multi50k").alias("n_tokens"))


#: White space as Python strips it.
_WHITE = " || ".join(f"chr({c})" for c in (*range(9, 14), *range(28, 33), 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000))


def split_sql(table: str, size: int, overlap: int) -> str:
    """CTEs that cut ``table`` (key, content) by words into ``chunks`` (key, chunk_pos, content).

    A node is a text and the first separator it may be cut by; its pieces of ``size`` words or more are nodes of the next
    level. Neighbouring smaller pieces are a run. Running sums of a run give each chunk from the one before: it ends where
    the sum since its first piece passes the size, and the next one begins at the first piece from which no more than the
    overlap is left, and the size isn't passed."""
    return f"""node as (
  select key, []::bigint[] path, 0 lv, content from {table} where content <> ''
  union all
  select key, list_append(path, i), k + 1, piece from (select key, path, k, unnest(pieces) piece, unnest(range(1, len(pieces) + 1)) i from ({_PIECES.format("node")})) where k < 3 and {WORDS.format("piece")} >= {size}),
piece as (select key, path, i, piece, {WORDS.format("piece")} n, k from (select key, path, k, unnest(pieces) piece, unnest(range(1, len(pieces) + 1)) i from ({_PIECES.format("node")})) where piece <> ''),
marked as (select *, count(*) filter (n >= {size}) over (partition by key, path order by i) before from piece),
run as (select key, list_append(path, min(i)) place, list(piece order by i) pieces, list(s order by i) s, list(s - n order by i) q from
  (select *, sum(n) over (partition by key, path, before order by i) s from marked where n < {size}) group by key, path, before),
cut as (
  select *, 1::bigint a, len(list_filter(s, lambda x: x <= {size}))::bigint b from run
  union all
  select key, place, pieces, s, q, c, len(list_filter(s, lambda x: x <= q[c] + {size}))::bigint from
    (select *, greatest(a, len(list_filter(q, lambda x: x < least(s[b], greatest(s[b] - {overlap}, s[b + 1] - {size})))) + 1)::bigint c from cut where b < len(s))),
chunk as (select key, list_append(place, b) place, trim(array_to_string(pieces[a:b], ''), {_WHITE}) content from cut
  union all select key, list_append(path, i), piece from piece where n >= {size} and k = 3),
chunks as (select key, content, row_number() over (partition by key order by place) - 1 chunk_pos from chunk where content <> '')"""


#: a node's pieces, and the level of the separator that cut it
_PIECES = """select *, case when k = 3 then regexp_extract_all(content, '(?s).') else list_transform(string_split(content, sep), lambda x, j: case when j = 1 then x else sep || x end) end pieces
  from (select *, case k when 0 then chr(10) || chr(10) when 1 then chr(10) else ' ' end sep
  from (select *, case when lv <= 0 and contains(content, chr(10) || chr(10)) then 0 when lv <= 1 and contains(content, chr(10)) then 1 when lv <= 2 and contains(content, ' ') then 2 else 3 end k from {}))"""


@query(f"""with recursive t as (select doc_id as key, text content from documents), {split_sql("t", 500, 50)}
select key doc_id, content, chunk_pos from chunks""")
def token_split(spark, d):
    rows = read(spark, d, "documents").select("doc_id", F.col("text").alias("content"))
    return split.token_split(rows, 500, 50, "words")


@query()
def token_split_bpe(spark, d):
    rows = read(spark, d, "documents").select("doc_id", F.col("text").alias("content"))
    return split.token_split(rows, 500, 50)


_SMALL = Config(max_tokens=500, overlap=50, min_characters=300)


@query(f"""with recursive sections as ({ORACLES["header_sections"]}),
t as (select struct_pack(f := source_file, p := sec_pos, a := h1, b := h2, c := h3) as key, content from sections), {split_sql("t", 500, 50)},
j as (select key.f source_file, key.p sec_pos, chunk_pos, content, concat('{PREFIX}', concat_ws(' > ', key.a, key.b, key.c), chr(10), chr(10), content) as input from chunks),
v as (select *, {_VERDICT.format(300)} v from j)
select source_file, row_number() over (partition by source_file order by sec_pos, chunk_pos)::bigint id, md5('{Config().instruction.replace("'", "''")}') instruction_md5, input, '' as output from v where v = 'saved'""")
def chunk_records(spark, d):
    out = prepare.chunk_records(markdown(spark, d), replace(_SMALL, counter="words"))
    return out.select("source_file", "id", F.md5("instruction").alias("instruction_md5"), "input", "output")


@query(f"select source_file, id, {WORDS.format('input')} n_tokens, {WORDS.format('input')} > 500 over_budget from ({ORACLES['chunk_records']})")
def record_tokens(spark, d):
    out = prepare.chunk_records(markdown(spark, d), replace(_SMALL, counter="words"))
    return records.with_tokens(out, 500).select("source_file", "id", "n_tokens", "over_budget")


@query()
def chunk_records_bpe(spark, d):
    out = prepare.chunk_records(markdown(spark, d), _SMALL)
    return out.select("source_file", "id", F.md5("instruction").alias("instruction_md5"), "input", "output")


@query()
def token_labels(spark, d):
    rows = prompt.with_prompt(_turns(spark, d), EOS)
    cap = Config().max_seq_length
    return prompt.token_labels(rows, cap=cap).select("conv_id", "turn", "tokens", "labels", "n_tokens", prompt.over_cap(F.col("n_tokens"), cap).alias("over_cap"))
