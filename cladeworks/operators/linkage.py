"""Hierarchical clustering by rounds of Spark jobs (H3).

Average and Ward linkage never bring two clusters closer by another merge, so all pairs
that are each other's nearest may merge at once, and what results is the same as by
single merges. Distances of clusters come from sums over their members' pairs, so a
round only renames clusters in the table of pairs and adds up.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions import linkage as L
from ..functions.staging import staged

#: Groups with at most this many clusters left are finished in one task (a matrix of 2 MB).
FINISH_CLUSTERS = 512


def _height(method: str):
    a, b, na, nb = F.col("pa"), F.col("pb"), F.col("na"), F.col("nb")
    if method == "average":
        return F.round(1 - F.col("s") / (na * nb), L.DIGITS)
    return F.round(F.sqrt(F.greatest(2 * ((a + b + F.col("s")) / (na + nb) - a / na - b / nb), F.lit(0.0))), L.DIGITS)


def _goes(pairs: DataFrame, threshold: float, method: str, finish: int) -> DataFrame:
    """Clusters that can still merge, and what each becomes: ``g, c, to, n, p, small``."""
    best = F.struct(_height(method).alias("h"), L.tie(F.col("a"), F.col("b")).alias("tie"), "a", "b", "na", "nb", "pa", "pb", "s")
    side = F.explode(F.array(F.struct(F.col("a").alias("c"), F.col("na").alias("n"), F.col("pa").alias("p")), F.struct(F.col("b").alias("c"), F.col("nb").alias("n"), F.col("pb").alias("p")))).alias("x")
    ends = pairs.withColumn("best", best).filter(F.col("best.h") <= threshold).select("g", "best", side)
    near = ends.groupBy("g", "x.c").agg(F.min("best").alias("best"), F.first("x.n").alias("n"), F.first("x.p").alias("p"))
    size = near.groupBy("g").agg((F.count("*") <= finish).alias("small"))
    both = F.count("*").over(Window.partitionBy("g", "best.a", "best.b")) == 2
    met = near.join(size, "g").withColumn("met", both & ~F.col("small"))
    b = F.col("best")
    return met.select("g", "c", F.when(F.col("met"), b["a"]).otherwise(F.col("c")).alias("to"), F.when(F.col("met"), b["na"] + b["nb"]).otherwise(F.col("n")).alias("n"),
                      F.when(F.col("met"), b["pa"] + b["pb"] + b["s"]).otherwise(F.col("p")).alias("p"), "small")


def agglomerate(pairs: DataFrame, members: DataFrame, threshold: float, method: str, finish: int = FINISH_CLUSTERS) -> DataFrame:
    """Flat clusters of merges up to ``threshold`` (to nine digits) within each group ``g``.

    ``members``: ``g, c`` (long ids, distinct in a group) and others. ``pairs``: ``g, a, b``
    with ``a < b``, sizes ``na, nb``, sums within ``pa, pb`` and the sum between ``s``
    (see :func:`cladeworks.functions.linkage.heights`); for ``average`` pairs without
    similarity may be left out where ``threshold`` is below 1. Returns ``members``
    with ``c`` as the smallest id of the cluster. Of equal distances the pair with the
    smallest :func:`~cladeworks.functions.linkage.tie` merges first.

    All pairs of clusters that can still merge are kept, over many tasks; a cluster with
    no other within the threshold is final and leaves. Each round is written to
    the shared folder. Rounds grow with the logarithm of the clusters, but where
    distances grow along a chain, only two clusters merge in one.
    """
    if method not in ("average", "ward"):
        raise ValueError("method is 'average' or 'ward'")
    threshold = round(threshold, L.DIGITS)

    def last(f: pd.DataFrame) -> pd.DataFrame:
        size = {**dict(zip(f["b"], f["nb"], strict=True)), **dict(zip(f["a"], f["na"], strict=True))}
        within = {**dict(zip(f["b"], f["pb"], strict=True)), **dict(zip(f["a"], f["pa"], strict=True))}
        to = L.merge_clusters(f["a"], f["b"], f["s"], size, within, threshold, method)
        return pd.DataFrame({"g": f["g"].iloc[0], "c": list(to), "to": list(to.values())})

    def renamed(goes: DataFrame) -> DataFrame:
        return members.join(goes.select("g", "c", "to"), ["g", "c"], "left").withColumn("c", F.coalesce("to", "c")).drop("to")

    pairs = staged(pairs)
    while True:
        goes = staged(_goes(pairs, threshold, method, finish))
        if goes.isEmpty():
            return members
        x = goes.select("g", F.col("c").alias("a"), F.col("to").alias("ta"), F.col("n").alias("xn"), F.col("p").alias("xp"), "small")
        y = goes.select("g", F.col("c").alias("b"), F.col("to").alias("tb"), F.col("n").alias("yn"), F.col("p").alias("yp"))
        moved = pairs.join(x, ["g", "a"]).join(y, ["g", "b"]).filter("ta <> tb")
        first = F.col("ta") < F.col("tb")
        pick = lambda u, v: F.when(first, F.col(u)).otherwise(F.col(v))
        moved = moved.select("g", pick("ta", "tb").alias("a"), pick("tb", "ta").alias("b"), pick("xn", "yn").alias("na"), pick("yn", "xn").alias("nb"), pick("xp", "yp").alias("pa"), pick("yp", "xp").alias("pb"), "s", "small")
        moved = staged(moved.groupBy("g", "a", "b", "small").agg(*(F.first(c).alias(c) for c in ("na", "nb", "pa", "pb")), F.sum("s").alias("s")))
        members = staged(renamed(goes))
        members = staged(renamed(moved.filter("small").groupBy("g").applyInPandas(last, "g string, c long, to long")))
        pairs = moved.filter("NOT small").select("g", "a", "b", "na", "nb", "pa", "pb", "s")


#: Groups with at most this many clusters are merged in one task, whose matrices then take some 400 MB.
WHOLE_CLUSTERS = 4096
BLOCKS = "g string, lo long, hi long, a array<long>, b array<long>, na array<long>, nb array<long>, sums binary"


def block_row(g: str, lo: int, hi: int, a, b, na, nb, sums: np.ndarray) -> dict:
    """A row of :data:`BLOCKS`: sums between the clusters ``a`` and ``b``, of sizes ``na`` and ``nb``."""
    return {"g": g, "lo": lo, "hi": hi, "a": a, "b": b, "na": na, "nb": nb, "sums": np.ascontiguousarray(sums, float).tobytes()}


def agglomerate_blocks(blocks: DataFrame, members: DataFrame, threshold: float, method: str) -> DataFrame:
    """:func:`agglomerate` of groups whose pairs come as blocks (:data:`BLOCKS`), each two parts of a group once.

    Blocks are made by many tasks; a group's are merged in one, which holds
    ``WHOLE_CLUSTERS`` clusters at most. The diagonal of a block of one part with itself
    holds the sums within its clusters.
    """
    threshold = round(threshold, L.DIGITS)

    def merge(f: pd.DataFrame) -> pd.DataFrame:
        ids = np.unique(np.concatenate([*f["a"], *f["b"]]))
        if len(ids) > WHOLE_CLUSTERS:
            raise ValueError(f"more than {WHOLE_CLUSTERS} clusters in a group")
        total, n = np.zeros((len(ids), len(ids))), np.zeros(len(ids))
        for r in f.itertuples():
            i, j = np.searchsorted(ids, r.a), np.searchsorted(ids, r.b)
            sums = np.frombuffer(r.sums).reshape(len(i), len(j))
            total[np.ix_(i, j)] = sums
            total[np.ix_(j, i)] = sums.T
            n[i], n[j] = r.na, r.nb
        within = total.diagonal().copy()
        np.fill_diagonal(total, 0)
        to = L.merge_mutual(total, n, within, ids, threshold, method)
        return pd.DataFrame({"g": f["g"].iloc[0], "c": ids, "to": to})

    goes = blocks.groupBy("g").applyInPandas(merge, "g string, c long, to long")
    return members.join(goes, ["g", "c"], "left").withColumn("c", F.coalesce("to", "c")).drop("to")


def agglomerate_kinds(blocks: DataFrame, kinds: DataFrame, members: DataFrame, threshold: float, method: str) -> DataFrame:
    """:func:`agglomerate` of groups in which many points are alike: those of a kind have the same sums with all others.

    ``kinds``: ``g, c, names``, a kind's number and the ids of its points. ``blocks``
    (:data:`BLOCKS`): the sums between points of two kinds, on the diagonal those between
    two points of one. A group of ``WHOLE_CLUSTERS`` kinds at most is merged in one task
    that holds a matrix of its kinds and an id for each point.
    """
    threshold = round(threshold, L.DIGITS)

    def merge(f: pd.DataFrame, named: pd.DataFrame) -> pd.DataFrame:
        named = named.sort_values("c")
        kind = named["c"].to_numpy()
        total = np.zeros((len(kind), len(kind)))
        for r in f.itertuples():
            i, j = np.searchsorted(kind, r.a), np.searchsorted(kind, r.b)
            sums = np.frombuffer(r.sums).reshape(len(i), len(j))
            total[np.ix_(i, j)] = sums
            total[np.ix_(j, i)] = sums.T
        one = np.ones(len(kind))
        ids, to = L.merge_kinds(total, one, one * 0, list(named["names"]), threshold, method)
        return pd.DataFrame({"g": named["g"].iloc[0], "c": ids, "to": to})

    goes = blocks.groupBy("g").cogroup(kinds.groupBy("g")).applyInPandas(merge, "g string, c long, to long")
    return members.join(goes, ["g", "c"], "left").withColumn("c", F.coalesce("to", "c")).drop("to")


#: Points of a tile; each two tiles of a group meet in a row of their own.
TILE = 1024


def unbuffered(pairs: DataFrame, parts: int) -> DataFrame:
    """Pairs of tiles with one side taken apart, before the other is: generated code keeps all rows that one of its input rows makes.

    ``coalesce`` to as many partitions as there are ends that code's stage and moves
    nothing, so those are the rows of one tile and not of a pair of tiles.
    """
    return pairs.coalesce(max(1, parts * parts))


#: Parts of the tiles on either side where each two meet.
PAIR_PARTS = 64


def meeting_parts(tiles: DataFrame) -> int:
    """Parts of either side for a Cartesian product of tiles."""
    return min(PAIR_PARTS, max(1, -(-tiles.count() // 4)))


def tile_pairs(points: DataFrame, columns: list[str], fresh: bool = False, extra: DataFrame | None = None) -> DataFrame:
    """Each two tiles of a group once: ``g, lo, hi, same``, and arrays ``a_{column}`` and ``b_{column}`` sorted by the first column.

    ``points``: ``g`` and ``columns``; those of equal first column are in one tile. With
    ``fresh``, a boolean column, only pairs with a tile of fresh points. ``extra`` holds
    columns of a group. Tiles meet in a Cartesian product, so no tile is shuffled for each pair.
    """
    key = ["g", "fresh"]
    points = points if fresh else points.withColumn("fresh", F.lit(True))
    count = points.groupBy(*key).agg(F.ceil(F.count("*") / TILE).alias("tiles"))
    dealt = points.join(count, key).withColumn("tile", F.pmod(F.xxhash64(columns[0]), F.col("tiles")))
    packed = dealt.groupBy(*key, "tile").agg(F.sort_array(F.collect_list(F.struct(*columns))).alias("x"))
    packed = staged(packed.select(*key, F.when(F.col("fresh"), -1 - F.col("tile")).otherwise(F.col("tile")).alias("tile"), *[F.col("x")[c].alias(c) for c in columns]))
    parts = meeting_parts(packed)
    left = packed.filter("fresh").select("g", F.col("tile").alias("lo"), *[F.col(c).alias(f"a_{c}") for c in columns])
    left = (left if extra is None else left.join(extra, "g")).repartition(parts, "g", "lo")
    right = packed.select(F.col("g").alias("h"), F.col("tile").alias("hi"), *[F.col(c).alias(f"b_{c}") for c in columns]).repartition(parts, "h", "hi")
    return left.join(right.hint("shuffle_replicate_nl"), (F.col("g") == F.col("h")) & (F.col("lo") <= F.col("hi"))).drop("h").withColumn("same", F.col("lo") == F.col("hi"))


def agglomerate_points(points: DataFrame, columns: list[str], members: DataFrame, threshold: float, method: str, sums, extra: DataFrame | None = None) -> DataFrame:
    """:func:`agglomerate` of groups of any size without a table of their pairs.

    ``points``: ``g, c, n`` and ``columns``, from which ``sums(row, side_a, side_b)``
    makes the clusters of two tiles and the matrix of sums between them; ``extra`` holds
    columns of a group that ``row`` has too. Each round makes the sums anew, tile by
    tile, keeps each cluster's nearest, and merges all that are each other's. Only
    clusters that merged, or whose nearest did, look for it again, and the others look
    at these. A group of few enough clusters is finished by :func:`agglomerate_blocks`.
    So time grows with the square of the points, but disk and memory don't.
    """
    threshold = round(threshold, L.DIGITS)
    use = ["to", "c", "n", "cn", "cp", *columns]
    near = "g string, to long, h double, tie long, other long, s double, on double, op double"

    def between(row):
        a, b = ({c: getattr(row, f"{x}_{c}") for c in use} for x in "ab")
        ia, ib, s = sums(row, a, b)
        (na, pa), (nb, pb) = ((x["cn"][f], x["cp"][f]) for x in (a, b) for f in [np.unique(x["to"], return_index=True)[1]])
        return ia, ib, s, na, nb, pa, pb

    def look(frames):
        for f in frames:
            for r in f.itertuples():
                ia, ib, s, na, nb, pa, pb = between(r)
                for own, other, t, n, m, p, q in [(ia, ib, s, na, nb, pa, pb)] + [(ib, ia, s.T, nb, na, pb, pa)] * (not r.same):
                    i, j, h, ties = L.nearest(t, n, m, p, q, own, other, threshold, method, r.same)
                    yield pd.DataFrame({"g": r.g, "to": own[i], "h": h, "tie": ties, "other": other[j], "s": t[i, j], "on": m[j], "op": q[j]})

    def block(frames):
        for f in frames:
            for r in f.itertuples():
                ia, ib, s, na, nb, pa, _ = between(r)
                if r.same:
                    np.fill_diagonal(s, pa)
                yield pd.DataFrame([block_row(r.g, r.lo, r.hi, ia, ib, na.astype(int), nb.astype(int), s)])

    def met(x, fresh):
        return tile_pairs(x, use, fresh, extra)

    size = points.groupBy("g").agg(F.count("*").alias("k"))
    known = F.lit(None).cast("struct<h:double,tie:long,other:long,s:double,on:double,op:double>").alias("best")
    live = staged(points.select("g", "c", "n", *columns, F.col("c").alias("to"), F.col("n").cast("double").alias("cn"), F.lit(0.0).alias("cp"), F.lit(True).alias("fresh"), known))
    final, rest = [], []
    while True:
        size = staged(live.groupBy("g").agg(F.count_distinct("to").alias("k")))
        rest.append(live.join(size.filter(F.col("k") <= WHOLE_CLUSTERS), "g", "left_semi"))
        size = size.filter(F.col("k") > WHOLE_CLUSTERS)
        if size.isEmpty():
            break
        live = live.join(size, "g", "left_semi")
        found = met(live, True).mapInPandas(look, near)
        pick = F.struct("h", "tie", "other", "s", "on", "op").alias("best")
        before = live.filter("best IS NOT NULL").select("g", "to", "best").distinct()
        best = staged(found.select("g", "to", pick).unionByName(before).groupBy("g", "to").agg(F.min("best").alias("best")))
        back = best.select("g", F.col("to").alias("other"), F.col("best.other").alias("back"))
        pair = staged(best.select("g", "to", F.col("best.other").alias("other"), "best").join(back, ["g", "other"], "left").select("g", "to", "best", F.coalesce(F.col("back") == F.col("to"), F.lit(False)).alias("met")))
        gone = pair.select("g", F.col("to").alias("nearest"), F.col("met").alias("lost"))
        goes = pair.withColumn("nearest", F.col("best.other")).join(gone, ["g", "nearest"], "left").select("g", "to", F.col("best").alias("now"), "met", (F.col("met") | F.coalesce("lost", F.lit(False))).alias("stale"))
        moved = live.drop("best", "fresh").join(goes, ["g", "to"], "left")
        final.append(moved.filter("now IS NULL").select("g", "c", "to"))
        b = F.col("now")
        live = staged(moved.filter("now IS NOT NULL").select("g", "c", "n", *columns, F.when(F.col("met"), F.least("to", b["other"])).otherwise(F.col("to")).alias("to"),
                      F.when(F.col("met"), F.col("cn") + b["on"]).otherwise(F.col("cn")).alias("cn"), F.when(F.col("met"), F.col("cp") + b["op"] + b["s"]).otherwise(F.col("cp")).alias("cp"),
                      F.col("stale").alias("fresh"), F.when(~F.col("stale"), b).alias("best")))
    left = rest[0]
    for x in rest[1:]:
        left = left.unionByName(x)
    left = staged(left.drop("fresh", "best"))
    ends = agglomerate_blocks(met(left, False).mapInPandas(block, BLOCKS), left.select("g", F.col("to").alias("c"), F.col("c").alias("point")), threshold, method).select("g", F.col("point").alias("c"), F.col("c").alias("to"))
    for x in final:
        ends = ends.unionByName(x)
    return members.join(ends, ["g", "c"], "left").withColumn("c", F.coalesce("to", "c")).drop("to")


#: 64-bit words of a group's sets that a task may hold, and pairs of a group that are listed at a time (4 bytes a pair).
SET_WORDS, LISTED = 1 << 23, 1 << 25
#: Clusters of a range at least, and ranges of a group at most; each range meets all points of its group.
RANGE, RANGES = 512, 256
SETS = "g string, k long, at binary, c binary, n binary, words binary"


def packed_sets(points: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Groups of weighted sets as a row each (:data:`SETS`), and those with too many words for one, ``g``.

    ``points``: ``g, c, n, codes`` (array of longs). ``words`` has a bit for each code of
    the group, ``at`` the cluster of each point, of which there are ``k``.
    """
    codes = points.select("g", "c", F.explode("codes").alias("code"))
    names = staged(codes.select("g", "code").distinct().withColumn("bit", F.row_number().over(Window.partitionBy("g").orderBy("code")) - 1))
    wide = names.groupBy("g").agg(F.ceil(F.count("*") / 64).alias("wide"))
    sizes = staged(points.groupBy("g").agg(F.count("*").alias("k")).join(wide, "g", "left").select("g", F.coalesce("wide", F.lit(1)).alias("wide"), (F.col("k") * F.coalesce("wide", F.lit(1)) > SET_WORDS).alias("over")))
    bits = codes.join(names, ["g", "code"]).groupBy("g", "c").agg(F.collect_list("bit").alias("bits"))
    fit = points.select("g", "c", "n").join(sizes.filter("NOT over").select("g", "wide"), "g").join(bits, ["g", "c"], "left")

    def pack(f: pd.DataFrame) -> pd.DataFrame:
        f = f.sort_values("c")
        words = np.zeros((len(f), int(f["wide"].iloc[0])), np.uint64)
        for k, x in enumerate(f["bits"]):
            if x is not None:
                np.bitwise_or.at(words[k], x >> 6, np.uint64(1) << (x & 63).astype(np.uint64))
        c = f["c"].to_numpy(np.int64)
        return pd.DataFrame({"g": f["g"].iloc[0], "k": len(c), "at": [c.tobytes()], "c": [c.tobytes()], "n": [f["n"].to_numpy(np.int64).tobytes()], "words": [words.tobytes()]})

    return staged(fit.groupBy("g").applyInPandas(pack, SETS)), sizes.filter("over").select("g")


def _unpacked(r) -> tuple[np.ndarray, ...]:
    """Of a row of :data:`SETS`: clusters, where each starts, ids, weights and words of the points."""
    at, c, n = (np.frombuffer(x, np.int64) for x in (r.at, r.c, r.n))
    names, starts = np.unique(at, return_index=True)
    return names, starts, c, n, np.frombuffer(r.words, np.uint64).reshape(len(c), -1)


def by_ranges(sets: DataFrame, run, schema: str) -> DataFrame:
    """``run(row, lo, hi)`` for ranges of the clusters of each group, as ``g`` and the columns of ``schema``.

    A range meets the row of its group in a Cartesian product, so nothing is shuffled by range.
    """
    many = F.greatest(F.lit(1), F.least(F.lit(RANGES), F.ceil(F.col("k") / RANGE)))
    ranges = staged(sets.select("g", "k", F.ceil(F.col("k") / many).alias("step")).select(F.col("g").alias("own"), F.col("step"), F.explode(F.sequence(F.lit(0).cast("long"), F.col("k") - 1, F.col("step"))).alias("lo")))
    rows = ranges.count()
    left = ranges.repartition(max(1, min(64, rows)), "own", "lo")
    right = sets.repartition(max(1, min(8, rows)), "g")
    pairs = left.join(right.hint("shuffle_replicate_nl"), F.col("own") == F.col("g")).drop("own")

    def each(frames):
        for f in frames:
            for r in f.itertuples():
                yield pd.DataFrame([{"g": r.g} | run(r, r.lo, min(r.lo + r.step, r.k))])

    return pairs.mapInPandas(each, f"g string, {schema}")


def agglomerate_sets(sets: DataFrame, members: DataFrame, threshold: float) -> DataFrame:
    """:func:`agglomerate` by the average Jaccard distance of weighted sets (:func:`packed_sets`).

    Many tasks list the clusters near each cluster, as far as ``LISTED`` pairs of a group
    go; a task a group then merges all for which the lists tell which is the nearest.
    Those that are left, which lists ended too early for, go through another round. No
    pair is shuffled but those listed.
    """
    threshold = round(threshold, L.DIGITS)

    def near(r, lo, hi):
        _, starts, _, n, words = _unpacked(r)
        cut, many, found = L.near_lists(words, n, starts, lo, hi, 1 - threshold - 10**-L.DIGITS, max(1, LISTED // len(starts)))
        return {"lo": lo, "cut": cut.tobytes(), "many": many.tobytes(), "found": found.tobytes()}

    def merge(f: pd.DataFrame, lists: pd.DataFrame) -> pd.DataFrame:
        r = next(f.itertuples())
        names, starts, c, n, words = _unpacked(r)
        cut, near = [], []
        for x in lists.sort_values("lo").itertuples():
            cut.append(np.frombuffer(x.cut))
            near += np.split(np.frombuffer(x.found, np.int32), np.cumsum(np.frombuffer(x.many, np.int64))[:-1])
        to, waits = L.merge_listed(words, n, starts, names, np.concatenate(cut), near, threshold)
        own = np.repeat(np.arange(len(starts)), np.diff(np.append(starts, len(c))))
        to, waits = to[own], waits[own]
        left = np.flatnonzero(waits)
        left = left[np.lexsort((c[left], to[left]))]
        k = len(np.unique(to[left]))
        rest = {x: [v[left].tobytes()] for x, v in (("at", to), ("c", c), ("n", n), ("words", words))}
        return pd.DataFrame({"g": r.g, "k": k, **rest, "ends": [c[~waits]], "to": [to[~waits]]})

    found = []
    while not sets.isEmpty():
        lists = by_ranges(sets, near, "lo long, cut binary, many binary, found binary")
        out = staged(sets.groupBy("g").cogroup(lists.groupBy("g")).applyInPandas(merge, f"{SETS}, ends array<long>, to array<long>"))
        found.append(out.select("g", F.explode(F.arrays_zip(F.col("ends").alias("c"), "to")).alias("x")).select("g", "x.c", "x.to"))
        sets = out.filter("k > 0").drop("ends", "to")
    if not found:
        return members
    ends = found[0]
    for x in found[1:]:
        ends = ends.unionByName(x)
    return members.join(ends, ["g", "c"], "left").withColumn("c", F.coalesce("to", "c")).drop("to")
