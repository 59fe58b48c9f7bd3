"""Operator 8, mixing sources to target weights by a multivariate-hypergeometric splitting tree.

Each source's documents are dealt by a hash into blocks. A source's target is met by whole passes over its blocks plus
a partial pass, so a quota is an exact number of block draws. A binary tree then splits the vector of quotas over the
output shards: each node draws its left child's share from a multivariate hypergeometric distribution, which is what a
uniform shuffle of all draws would give, without shuffling them. A shard takes the next blocks of each source's
permutation, disjoint from all others, and orders its own documents by a hash.

Totals, ranks, targets and permutations are Spark's work, so that sources may be many. The tree is drawn for groups of
sources on the driver, and carried on for the sources of a group in a task, with the group's share of each shard as given.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from skein.llm.common import boxed, cut, n_words, table


@dataclass(frozen=True)
class Params:
    weights: tuple[float, ...] = (3, 1, 2)
    share: float = 1.5
    most: float = 2.0
    #: Documents in a block, as long as a source then has no more blocks than max_blocks; beyond, blocks grow.
    block_docs: int = 256
    max_blocks: int = 16_384
    #: Output shards, and the words in a piece of one that is sorted by itself.
    shards: int = 64
    piece_words: int = 50_000_000
    #: Draws whose sources are split over the shards in one task, about.
    group_draws: int = 65_536
    #: Documents of blocks drawn in part that are looked at in one task, about.
    fill_docs: int = 16_384
    seed: int = 8


def ranked(sources: DataFrame) -> DataFrame:
    """``sources`` with m_id: places from 0 in the order of ``source`` by code point, null last."""
    rows = cut(sources.orderBy(F.col("source").asc_nulls_last()).withColumn("m_at", F.monotonically_increasing_id()))
    part = F.shiftright("m_at", 33)
    per = rows.groupBy(part.alias("m_part")).agg(F.count("*").alias("n"))  # a row a partition
    before = F.sum("n").over(Window.orderBy("m_part").rowsBetween(Window.unboundedPreceding, -1))
    offsets = per.select("m_part", F.coalesce(before, F.lit(0)).alias("m_before"))
    out = rows.join(F.broadcast(offsets), part == F.col("m_part"))
    return out.withColumn("m_id", F.col("m_before") + F.col("m_at").bitwiseAND(F.lit((1 << 33) - 1))).drop("m_at", "m_part", "m_before")


def with_targets(sources: DataFrame, p: Params) -> DataFrame:
    """``sources`` (m_id, words) with target: the share of all words by weight, at most ``most`` times a source's own.

    Each round fixes the sources that are then over it and deals out again what they leave; two sums a round return."""
    weight = F.get(F.array(*(F.lit(float(w)) for w in p.weights)), (F.col("m_id") % len(p.weights)).cast("int"))
    rows = sources.withColumn("m_weight", weight)
    over = lambda per: per * F.col("m_weight") > p.most * F.col("words")
    total = rows.agg(F.coalesce(F.sum("words"), F.lit(0)).alias("n"), F.sum("m_weight").alias("w")).first()
    full, per = 0, p.share * total.n / (total.w or 1)
    while True:
        r = rows.agg(F.count_if(over(per)).alias("full"), F.sum(F.when(over(per), F.col("words"))).alias("words"), F.sum(F.when(~over(per), F.col("m_weight"))).alias("w")).first()
        if r.full == full or not r.w:
            break
        full, per = r.full, (p.share * total.n - p.most * (r.words or 0)) / r.w
    return rows.withColumn("target", F.when(over(per), p.most * F.col("words")).otherwise(per * F.col("m_weight"))).drop("m_weight")


#: Numbers from which numpy draws no hypergeometric variates.
LARGE = 1_000_000_000


def hypergeometric(rng: np.random.Generator, good: int, bad: int, n: int) -> int:
    """How many of ``n`` draws without replacement are good; for any numbers, by inversion around the mode where they are
    too large for numpy."""
    if max(good, bad) < LARGE:
        return int(rng.hypergeometric(good, bad, n))
    all_ = good + bad
    low, high = max(0, n - bad), min(good, n)
    mode = min(max((n + 1) * (good + 1) // (all_ + 2), low), high)
    spread = int(40 * (n * (good / all_) * (bad / all_) * ((all_ - n) / max(1, all_ - 1))) ** 0.5) + 64
    k = np.arange(max(low, mode - spread), min(high, mode + spread) + 1, dtype=np.float64)
    # log of the ratio of neighbouring probabilities
    steps = np.log(good - k[:-1]) + np.log(n - k[:-1]) - np.log(k[:-1] + 1) - np.log(bad - n + k[:-1] + 1)
    weight = np.r_[0.0, np.cumsum(steps)]
    sums = np.cumsum(np.exp(weight - weight.max()))
    return int(k[min(int(np.searchsorted(sums, rng.random() * sums[-1], "right")), len(k) - 1)])


def multivariate(rng: np.random.Generator, counts: np.ndarray, n: int) -> np.ndarray:
    """A draw from the multivariate hypergeometric distribution, by its marginals."""
    if counts.sum() < LARGE:
        return rng.multivariate_hypergeometric(counts, n, method="marginals")
    out, rest = np.zeros(len(counts), np.int64), int(counts.sum())
    for i, c in enumerate(counts.tolist()):
        rest -= c
        out[i] = hypergeometric(rng, c, rest, n) if n else 0
        n -= int(out[i])
    return out


def split_tree(quotas: np.ndarray, room: np.ndarray, seed: tuple[int, ...]) -> np.ndarray:
    """Quotas by source and room by shard, of equal sums -> quotas by (shard, source), whose rows and columns sum to
    them."""
    out = np.zeros((len(room), len(quotas)), np.int64)

    def node(q: np.ndarray, low: int, high: int) -> None:
        if high - low == 1:
            out[low] = q
            return
        mid, rng = (low + high) // 2, np.random.default_rng((*seed, low, high))
        left = multivariate(rng, q, int(room[low:mid].sum()))
        node(left, low, mid)
        node(q - left, mid, high)

    node(quotas, 0, len(room))
    return out


def draws(blocks: DataFrame, sources: DataFrame, p: Params) -> DataFrame:
    """(m_id, m_block, m_pos, m_room): each source's draws in the order of its permutation. m_room is null, or the words
    of a last block that is drawn in part."""
    rows = blocks.join(sources.select("m_id", F.col("words").alias("all"), "target"), "m_id")
    whole = F.when(F.col("all") > 0, F.floor(F.col("target") / F.col("all"))).otherwise(0).cast("int")
    rows = rows.select("m_id", "m_block", "words", whole.alias("whole"), (F.col("target") - whole * F.col("all")).alias("room"))
    at = lambda turn: F.xxhash64("m_id", "m_block", turn, F.lit(p.seed))
    full = rows.filter("whole > 0").select("m_id", "m_block", F.explode(F.sequence(F.lit(0), F.col("whole") - 1)).alias("turn"), F.lit(None).cast("double").alias("m_room"))
    per = Window.partitionBy("m_id")  # max_blocks rows at most, or twice as many
    before = F.sum("words").over(per.orderBy(at(F.col("whole")), "m_block").rowsBetween(Window.unboundedPreceding, -1))
    last = rows.withColumn("left", F.col("room") - F.coalesce(before, F.lit(0))).filter("left > 0")
    last = last.select("m_id", "m_block", F.col("whole").alias("turn"), F.when(F.col("words") > F.col("left"), F.col("left")).alias("m_room"))
    pos = F.row_number().over(per.orderBy("turn", at(F.col("turn")), "m_block"))
    return full.unionByName(last).select("m_id", "m_block", pos.alias("m_pos"), "m_room")


def sharded(drawn: DataFrame, p: Params) -> DataFrame:
    """``drawn`` with m_shard: the splitting tree deals each source's draws out, in their order."""
    total = drawn.count()
    groups = max(1, -(-total // p.group_draws))
    of = drawn.withColumn("g", F.pmod(F.xxhash64("m_id"), F.lit(groups)).cast("int"))
    per = {r.g: r["count"] for r in of.groupBy("g").count().collect()}  # a row a group
    n = max(1, min(p.shards, total))
    room = np.diff(np.arange(n + 1) * total // n)
    known = sorted(per)
    tree = split_tree(np.array([per[g] for g in known], np.int64), room, (p.seed,)) if total else np.zeros((n, 0), np.int64)
    share = {g: tree[:, k] for k, g in enumerate(known)}

    def run(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values(["m_id", "m_pos"])
        quotas = rows.groupby("m_id", sort=True).size().to_numpy(dtype=np.int64)
        own = split_tree(quotas, share[key[0]], (p.seed, int(key[0])))
        shard = [np.repeat(np.arange(n), own[:, k]) for k in range(len(quotas))]
        return rows.drop(columns="g").assign(m_shard=np.concatenate(shard).astype(np.int32))

    return of.groupBy("g").applyInPandas(run, "m_id long, m_block int, m_pos int, m_room double, m_shard int")


def near(sizes: np.ndarray, room: float) -> tuple[float, np.ndarray]:
    """What is left of ``room`` (over it: negative), and which sizes fill it: in the order given what still fits, then
    as long as that comes nearer the best change of one, put in, taken out or exchanged for another."""
    takes = np.zeros(len(sizes), bool)
    for i, n in enumerate(sizes):
        if 0 < n <= room:
            takes[i], room = True, room - n
    for _ in range(8):
        inside, outside = np.append(np.flatnonzero(takes), -1), np.append(np.flatnonzero(~takes & (sizes > 0)), -1)  # -1: none
        out = np.where(inside >= 0, sizes[inside], 0)
        order = outside[np.argsort(np.where(outside >= 0, sizes[outside], 0), kind="stable")]
        into = np.where(order >= 0, sizes[order], 0)
        # for each one taken out, the one to put in of the nearest size from below and from above
        at = np.clip(np.searchsorted(into, out + room)[:, None] + np.array([-1, 0]), 0, len(into) - 1)
        left = np.abs(room + out[:, None] - into[at])
        k = np.unravel_index(np.argmin(left), left.shape)
        if left[k] >= abs(room):
            break
        room += out[k[0]] - into[at[k]]
        for i, mark in ((inside[k[0]], False), (order[at[k]], True)):
            if i >= 0:
                takes[i] = mark
    return room, takes


def filling(sizes: np.ndarray, room: float) -> np.ndarray:
    """Which documents of one block fill ``room`` words: in the order given, or, where that leaves over a hundredth of it
    and the longest first come nearer, in that one."""
    if len(sizes) == 1:
        return sizes < 2 * room
    left, takes = near(sizes, room)
    if abs(left) > room / 100:
        order = np.argsort(-sizes, kind="stable")
        less, other = near(sizes[order], room)
        if abs(less) < abs(left):
            takes[order] = other
    return takes


def fill(rows: pd.DataFrame) -> pd.DataFrame:
    """Of some blocks, the documents that fill each one's ``m_room`` words, tried in hashed order."""
    rows = rows.sort_values(["m_id", "m_block", "m_h1", "m_h2"], kind="stable")
    block, sizes, room = rows[["m_id", "m_block"]].to_numpy(), rows["size"].to_numpy(), rows["m_room"].to_numpy()
    starts = np.flatnonzero(np.r_[True, (block[1:] != block[:-1]).any(axis=1)])
    takes = [filling(x, float(room[at])) for x, at in zip(np.split(sizes, starts[1:]), starts)]
    return rows.drop(columns="m_set").assign(m_takes=np.concatenate(takes))


def hashes(docs: DataFrame, p: Params) -> tuple[Column, Column]:
    """Two hashes of a row in all its columns, 128 bits together: rows that share them are alike."""
    cols = [F.to_json(F.struct(f"`{c}`")) if "map<" in kind or "variant" in kind else F.col(f"`{c}`") for c, kind in docs.dtypes]
    return F.xxhash64(*cols, F.lit(p.seed)).alias("m_h1"), F.xxhash64(F.lit(p.seed + 1), *cols).alias("m_h2")


def planned(docs: DataFrame, p: Params) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Of ``docs``: its rows (doc_id, source, size, hashes, m_id, m_block), sources (m_id, source, words, target, m_blocks)
    and blocks drawn (m_id, m_block, m_copies: a shard for each whole draw, m_room, m_last: the shard of a part)."""
    sized = cut(docs.select("doc_id", "source", n_words(F.col("text")).alias("size"), *hashes(docs, p)))
    per = sized.groupBy("source").agg(F.count("*").alias("docs"), F.sum("size").alias("words"))
    n = F.least(F.greatest(F.ceil(F.col("docs") / p.block_docs), F.lit(1)), F.lit(p.max_blocks)).cast("long")
    sources = cut(with_targets(cut(ranked(per)), p).withColumn("m_blocks", n).drop("docs"))
    rows = in_blocks(sized, sources)
    blocks = cut(rows.groupBy("m_id", "m_block").agg(F.sum("size").alias("words")))
    dealt = sharded(cut(draws(blocks, sources, p)), p)
    whole = F.sort_array(F.collect_list(F.when(F.col("m_room").isNull(), F.col("m_shard")))).alias("m_copies")
    last = F.max(F.when(F.col("m_room").isNotNull(), F.col("m_shard"))).alias("m_last")
    return rows, sources, cut(dealt.groupBy("m_id", "m_block").agg(whole, F.max("m_room").alias("m_room"), last))


def in_blocks(rows: DataFrame, sources: DataFrame) -> DataFrame:
    """``rows`` (source, m_h1) with m_id and m_block. No hint: Spark broadcasts the sources if they are few, and splits hot
    ones if not."""
    of = sources.select(F.col("source").alias("m_source"), "m_id", "m_blocks")
    out = rows.join(of, F.col("source").eqNullSafe(F.col("m_source")))
    return out.withColumn("m_block", F.pmod(F.xxhash64("m_h1", F.lit("block")), F.col("m_blocks")).cast("int")).drop("m_source", "m_blocks")


def chosen(rows: DataFrame, blocks: DataFrame, p: Params) -> DataFrame:
    """``rows`` of the blocks that are drawn in part, one a source at most, with m_takes: whether a row is in that part. A
    task has some blocks, or one large one."""
    part = cut(rows.join(blocks.filter("m_room is not null"), ["m_id", "m_block"]))
    kinds = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in part.schema)
    sets = max(1, -(-part.count() // p.fill_docs))
    part = part.withColumn("m_set", F.pmod(F.xxhash64("m_id", "m_block"), F.lit(sets)))
    return part.groupBy("m_set").applyInPandas(fill, f"{kinds}, m_takes boolean")


def assign(docs: DataFrame, p: Params = Params()) -> DataFrame:
    """doc_id, source, size, source_size, target, taken and shards (that of each copy, in order), one row per row of
    ``docs``.

    Size counts words; null text has none, and an empty document is copied but counts nothing. Sources are ordered by
    code point, null last as a source of its own. Repeated rows are dealt like others. An empty table gives no rows;
    other columns only tell rows apart. Every step is seeded, so reruns agree."""
    rows, sources, blocks = planned(docs, p)
    rest = rows.join(blocks, ["m_id", "m_block"], "left").filter("m_room is null").withColumn("m_takes", F.lit(False))
    out = rest.unionByName(chosen(rows, blocks, p))
    none = F.array().cast("array<int>")
    shards = F.sort_array(F.concat(F.coalesce("m_copies", none), F.when(F.col("m_takes"), F.array("m_last")).otherwise(none)))
    out = out.withColumn("shards", shards).join(sources.select("m_id", F.col("words").alias("source_size"), "target"), "m_id")
    return out.select("doc_id", "source", "size", "source_size", "target", (F.col("size") * F.size("shards")).alias("taken"), "shards")


def mix(docs: DataFrame, p: Params = Params()) -> DataFrame:
    """The mixture: a row of ``docs`` (all its columns) for every copy, with m_shard, and m_order for its place there; columns
    of these two names are replaced. Rows lie by shard, each in its own shuffled order; a shard of over
    ``piece_words`` words lies in several pieces.

    Texts are shuffled once, to their shards. Rows that are alike in all columns stand for each other: in a block drawn in part they come
    as often as they are drawn together."""
    rows, sources, blocks = planned(docs, p)
    words = sources.agg(F.sum("target")).first()[0] or 0
    pieces = max(1, round(words / p.shards / p.piece_words))
    keyed = in_blocks(docs.select(boxed(docs, "m_shard", "m_order").alias("r"), F.col("source").alias("source"), *hashes(docs, p)), sources)
    met = keyed.join(blocks, ["m_id", "m_block"])
    whole = met.select("r", "m_h1", "m_h2", F.posexplode("m_copies").alias("m_at", "m_shard"))
    times = chosen(rows, blocks, p).filter("m_takes").groupBy("m_h1", "m_h2").agg(F.count("*").cast("int").alias("m_times"))
    part = met.filter("m_room is not null").dropDuplicates(["m_h1", "m_h2"]).join(times, ["m_h1", "m_h2"])
    part = part.select("r", "m_h1", "m_h2", F.posexplode(F.array_repeat("m_last", F.col("m_times"))).alias("m_at", "m_shard"))
    order = F.xxhash64("m_h1", "m_h2", "m_at", "m_shard", F.lit(p.seed + 1))
    out = whole.unionByName(part.withColumn("m_at", F.col("m_at") - F.lit(1 << 30))).select("r", "m_shard", order.alias("m_order"))
    piece = F.pmod(F.shiftrightunsigned("m_order", 20), F.lit(pieces)).alias("m_piece")
    out = out.withColumn("m_piece", piece).repartition("m_shard", "m_piece").sortWithinPartitions("m_shard", "m_piece", "m_order")
    return out.select("r.*", "m_shard", "m_order")


def op8(spark, sf_dir: str) -> DataFrame:
    out = assign(table(spark, sf_dir, "documents"))
    return out.select("doc_id", "size", "source_size", "target", "taken", "shards")
