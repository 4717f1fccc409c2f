"""Exact Jaccard self-join on word shingles by a grouped prefix join.

1. One pass counts all shingles into a sketch of fixed size. Its counts, ties by
   hash, are the global order of shingles: any fixed order gives right results,
   one that puts rare shingles first gives short posting lists.
2. A second pass writes each document's prefix. Documents with one and the same
   set collapse into a member, members with identical prefixes and size into a
   group; only groups enter the join.
3. Each shingle's posting list is paired with its cleanest group (the one with the
   smallest share of rarer shingles): a number of pairs linear in the postings.
   These are verified on whole texts and give first components.
4. Then pairs of groups that share a prefix shingle are filtered by sizes, by
   positions and by whether all their members are in one component already; what
   is left expands to pairs of members in different components, which are
   verified. So no link between different texts is missed, while pairs inside a
   component, whose links change nothing, are never formed.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .components import connected_components
from .flat import distinct_sets, mix, shingle_hashes, word_slices
from .shared import materialize

SKETCH_BITS = 22
SKETCH_BLOCK = 1 << 14
BROADCAST_IDS = 2_000_000
MEMBERS_PER_TASK = 64
GROUPS_PER_TASK = 256


def shingle_sketch(docs: DataFrame, k: int) -> np.ndarray:
    """Rank of each of 2**22 sketch cells by the documents' shingles that fall into it.

    4 MB at any input size: partitions send 8-bit counts (saturated at 255), which
    are added up by block of cells in Spark. The logarithm of the sum is kept.
    """

    def count(batches):
        cells = np.zeros(1 << SKETCH_BITS, np.uint32)
        for batch in batches:
            for w in word_slices(batch.column(0)):
                for s in distinct_sets(*shingle_hashes(w.hashes(), w.bounds, k)):
                    np.add.at(cells, (s >> np.uint64(64 - SKETCH_BITS)).astype(np.int64), 1)
        blocks = np.minimum(cells, 255).astype(np.uint8).reshape(-1, SKETCH_BLOCK)
        keep = np.flatnonzero(blocks.any(axis=1))
        if len(keep):
            yield pa.RecordBatch.from_arrays(
                [pa.array(keep.astype(np.int32)), pa.array([blocks[i].tobytes() for i in keep], pa.binary())], ["block", "counts"]
            )

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, block = np.zeros(SKETCH_BLOCK, np.int64), 0
        for batch in batches:
            block = batch.column(0)[0].as_py()
            for x in batch.column(1):
                total += np.frombuffer(x.as_buffer(), np.uint8)
        level = np.minimum(255, 8 * np.log2(1 + total)).astype(np.uint8)
        yield pa.RecordBatch.from_arrays([pa.array([block], pa.int32()), pa.array([level.tobytes()], pa.binary())], ["block", "counts"])

    parts = docs.select("text").mapInArrow(count, "block int, counts binary")
    out = np.zeros((1 << SKETCH_BITS) // SKETCH_BLOCK * SKETCH_BLOCK, np.uint8).reshape(-1, SKETCH_BLOCK)
    for row in parts.groupBy("block").applyInArrow(add, "block int, counts binary").collect():
        out[row.block] = np.frombuffer(row.counts, np.uint8)
    return out.reshape(-1)


def prefix_length(n: int, percent: int) -> int:
    """Shingles of a set of ``n`` of which one at least is in any set that links with it."""
    return n + (-percent * n) // 100 + 1


def document_prefixes(docs: DataFrame, k: int, percent: int) -> DataFrame:
    """Per document: ``doc_id, n, set_a, set_b`` (a 128-bit key of the set) and ``prefix``, in the global order."""
    ranks = docs.sparkSession.sparkContext.broadcast(shingle_sketch(docs, k))

    def run(batches):
        rank = ranks.value
        for batch in batches:
            for w in word_slices(batch.column(1)):
                n, a, b, prefix = [], [], [], []
                for s in distinct_sets(*shingle_hashes(w.hashes(), w.bounds, k)):
                    order = np.argsort(rank[(s >> np.uint64(64 - SKETCH_BITS)).astype(np.int64)], kind="stable")
                    n.append(len(s))
                    a.append(int(np.add.reduce(s)) & (1 << 64) - 1)
                    b.append(int(np.bitwise_xor.reduce(mix(s ^ np.uint64(0xA0761D6478BD642F)))) if len(s) else 0)
                    prefix.append(s[order[: prefix_length(len(s), percent)]].view(np.int64) if len(s) else np.zeros(0, np.int64))
                offsets = np.concatenate([[0], np.cumsum([len(p) for p in prefix])]).astype(np.int32)
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).slice(w.first, w.n_docs),
                        pa.array(n, pa.int32()),
                        pa.array(np.array(a, np.uint64).view(np.int64)),
                        pa.array(np.array(b, np.uint64).view(np.int64)),
                        pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.concatenate(prefix))),
                    ],
                    ["doc_id", "n", "set_a", "set_b", "prefix"],
                )

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, "doc_id long, n int, set_a long, set_b long, prefix array<long>")


def _compatible(percent: int):
    """Sizes and first common positions leave room for a link."""
    need = F.expr(f"{percent} * (n1 + n2)")
    return (
        (F.col("n1") * 100 >= F.col("n2") * percent)
        & (F.col("n2") * 100 >= F.col("n1") * percent)
        & (F.least(F.expr("n1 - p1"), F.expr("n2 - p2")) * (100 + percent) >= need)
    )


def verify_pairs(docs: DataFrame, pairs: DataFrame, k: int, percent: int) -> DataFrame:
    """Of ``pairs(a, b)`` of doc_ids those whose whole texts link.

    Texts of candidates only are moved: each second document goes to its first
    one, whose pairs are dealt over several tasks when it has many.
    """
    salted = pairs.join(
        pairs.groupBy("a").agg(F.count("*").alias("c")), "a"
    ).withColumn("salt", F.pmod(F.hash("b"), F.greatest(F.lit(1), (F.col("c") / MEMBERS_PER_TASK).cast("int"))))
    salted = materialize(salted.select("a", "b", "salt"))
    ids = salted.select(F.explode(F.array("a", "b")).alias("doc_id")).distinct()
    few = salted.count() * 2 <= BROADCAST_IDS
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    texts = texts.join(F.broadcast(ids) if few else ids, "doc_id", "left_semi")
    roles = salted.select("a", "salt", F.lit(0).alias("role"), F.col("a").alias("doc_id")).distinct().union(
        salted.select("a", "salt", F.lit(1).alias("role"), F.col("b").alias("doc_id"))
    )
    rows = roles.join(texts, "doc_id").select("a", "salt", "role", "doc_id", "text")
    rows = rows.repartition("a", "salt").sortWithinPartitions("a", "salt", "role")

    def run(batches):
        pivot, pivot_key = [], None
        for batch in batches:
            keys = list(zip(*(batch.column(i).to_pylist() for i in range(4)), strict=True))
            a, b = [], []
            for w in word_slices(batch.column(4)):
                for i, s in enumerate(distinct_sets(*shingle_hashes(w.hashes(), w.bounds, k))):
                    key = keys[w.first + i]
                    if key[2] == 0:
                        if pivot_key != key[:2]:
                            pivot, pivot_key = [], key[:2]
                        pivot.append(s)
                    elif key[:2] == pivot_key:
                        for p in pivot:
                            both = len(np.intersect1d(p, s, assume_unique=True))
                            if both and 100 * both >= percent * (len(p) + len(s) - both):
                                a.append(key[0])
                                b.append(key[3])
                                break
            yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], ["a", "b"])

    return rows.mapInArrow(run, "a long, b long")


def jaccard_components(docs: DataFrame, k: int = 5, percent: int = 80) -> DataFrame:
    """Components of the documents that link by shingle Jaccard similarity.

    ``docs``: ``doc_id, text`` and any other columns, which are ignored. A set holds
    a document's distinct ``k``-word shingles (fewer words: the whole sequence);
    two link when ``100 * intersection >= percent * union``. Returns ``doc_id,
    n_shingles long, component_id`` (the smallest doc_id reachable), a row for each
    input row.

    Null or empty texts have ``n_shingles`` 0 and link with nothing: their
    component is their own doc_id. Repeated rows are repeated in the result; rows
    that share a doc_id count as one document that has either text. A null doc_id
    links with nothing and has a null component.
    """
    if not 1 <= percent <= 100 or k < 1:
        raise ValueError("k must be 1 or more, percent 1 to 100")
    prefixes = materialize(document_prefixes(docs, k, percent))
    sets = prefixes.filter("n > 0 AND doc_id IS NOT NULL")
    members = sets.groupBy("set_a", "set_b", "n").agg(F.min("doc_id").alias("member"), F.first("prefix").alias("prefix"))
    members = members.withColumns({"key": F.xxhash64("prefix"), "key2": F.xxhash64(F.lit(1), "prefix")})  # 128 bits in all
    members = materialize(members.select("set_a", "set_b", "n", "member", "prefix", "key", "key2"))
    groups = members.groupBy("key", "key2", "n").agg(F.min("member").alias("g"), F.first("prefix").alias("prefix"), F.count("*").alias("size"))
    postings = materialize(groups.select("g", "n", "size", F.posexplode("prefix").alias("p", "token")))
    in_group = members.join(groups.filter("size > 1").select("key", "key2", "n", "g"), ["key", "key2", "n"]).select("g", "member")
    in_group = materialize(in_group)  # only groups of several different sets

    pivots = postings.groupBy("token").agg(F.min(F.struct(F.expr("p / n").alias("share"), "g", "p", "n", "size")).alias("pivot"), F.count("*").alias("c"))
    # Members of a group that shares nothing with others meet at its first shingle.
    pivots = materialize(pivots.filter("c > 1 OR pivot.size > 1 AND pivot.p = 0").select("token", F.col("pivot.g").alias("g1"), F.col("pivot.p").alias("p1"), F.col("pivot.n").alias("n1")))
    shared = materialize(postings.drop("size").join(pivots, "token"))
    near = shared.select("g1", "p1", "n1", F.col("g").alias("g2"), F.col("p").alias("p2"), F.col("n").alias("n2"))
    near = near.filter("g1 <> g2").filter(_compatible(percent)).select(F.col("g1").alias("a"), F.col("g2").alias("b"))
    first = materialize(near.union(in_group.filter("g <> member")).distinct())
    links = materialize(verify_pairs(docs, first, k, percent))
    found = materialize(connected_components(links))

    # Pairs of groups that may link and aren't in one component yet: lo and hi are the first and last component of a group.
    placed = in_group.join(found, in_group.member == found.node, "left").select("g", "member", F.coalesce("component", "member").alias("comp"))
    several = placed.groupBy("g").agg(F.min("comp").alias("lo"), F.max("comp").alias("hi"))
    alone = found.select(F.col("node").alias("g"), F.col("component").alias("c"))
    home = found.select(F.col("node").alias("g1"), F.col("component").alias("home"))
    labelled = shared.select("token", "g", "p", "n", "g1").join(several, "g", "left").join(alone, "g", "left").join(home, "g1", "left")
    lo, hi, home = F.coalesce("lo", "c", "g"), F.coalesce("hi", "c", "g"), F.coalesce("home", "g1")
    labelled = labelled.select("token", "g", "p", "n", lo.alias("lo"), hi.alias("hi"), ((lo != home) | (hi != home)).alias("apart"))
    span = labelled.groupBy("token").agg(F.min("lo").alias("a"), F.max("hi").alias("b"), F.ceil(F.count_if("apart") / GROUPS_PER_TASK).cast("int").alias("parts")).filter("a <> b AND parts > 0").select("token", "parts")
    labelled = materialize(labelled.join(span, "token"))
    left = labelled.filter("apart").select("token", F.pmod(F.hash("g"), F.col("parts")).alias("part"), F.col("g").alias("ga"), F.col("p").alias("p1"), F.col("n").alias("n1"), F.col("lo").alias("lo1"), F.col("hi").alias("hi1"))
    right = labelled.select("token", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part"), F.col("g").alias("gb"), F.col("p").alias("p2"), F.col("n").alias("n2"), F.col("lo").alias("lo2"), F.col("hi").alias("hi2"), "apart")
    once = ~F.col("apart") | F.expr("ga <= gb")
    open_ = F.expr("NOT (lo1 = hi1 AND lo2 = hi2 AND lo1 = lo2)")
    pairs = left.join(right, ["token", "part"]).filter(once & open_ & _compatible(percent)).select("ga", "gb", "lo1", "lo2").distinct()
    of = lambda g, m, c: placed.select(F.col("g").alias(g), F.col("member").alias(m), F.col("comp").alias(c))
    rest = pairs.join(of("ga", "ma", "ca"), "ga", "left").join(of("gb", "mb", "cb"), "gb", "left")
    rest = rest.select(F.coalesce("ma", "ga").alias("a"), F.coalesce("mb", "gb").alias("b"), F.coalesce("ca", "lo1").alias("c"), F.coalesce("cb", "lo2").alias("d")).filter("c <> d")
    rest = materialize(rest.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct())
    more = materialize(verify_pairs(docs, rest, k, percent)) if not rest.isEmpty() else rest
    if not more.isEmpty():
        found = materialize(connected_components(links.union(more)))

    of_set = members.join(found, members.member == found.node, "left").select("set_a", "set_b", "n", F.coalesce("component", "member").alias("component"))
    out = prefixes.select("doc_id", "n", "set_a", "set_b").join(of_set, ["set_a", "set_b", "n"], "left")
    # A component's smallest doc_id is that of its members; a repeated doc_id joins the sets it holds.
    repeated = prefixes.filter("doc_id IS NOT NULL").groupBy("doc_id").agg(F.count("*").alias("c")).filter("c > 1").select("doc_id")
    if not repeated.isEmpty():
        again = out.filter("n > 0").join(repeated, "doc_id").select(F.col("doc_id").alias("a"), F.col("component").alias("b"))
        merged = connected_components(again).select(F.col("node").alias("component"), F.col("component").alias("to"))
        out = out.join(merged, "component", "left").withColumn("component", F.coalesce("to", "component"))
    return out.select("doc_id", F.col("n").cast("long").alias("n_shingles"), F.coalesce("component", "doc_id").alias("component_id"))


def drop_near_copies(docs: DataFrame, k: int = 5, percent: int = 80) -> DataFrame:
    """One document of each component: the one with the smallest doc_id.

    Keeps the columns of ``docs``. Rows with a null doc_id all stay, as do rows
    that repeat a kept doc_id.
    """
    found = jaccard_components(docs, k, percent)
    drop = found.filter("doc_id <> component_id").select("doc_id").distinct()
    return docs.join(drop, "doc_id", "left_anti").select(docs.columns)
