"""Trees as node tables.

``nodes``: ``tree_id, node_id, parent_id, is_leaf, edge_length, pre, last, depth,
root_dist``. ``pre`` is the place in preorder and ``last`` that of the last node below,
so ``x`` is under ``n`` when ``x.pre BETWEEN n.pre AND n.last`` in the same tree.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions import linkage as L
from ..functions.staging import staged
from .linkage import BLOCKS, PAIR_PARTS, block_row, meeting_parts, tile_pairs, unbuffered

#: Places in preorder that share a key where nodes meet what is below them.
TILE = 1024
#: Places in preorder of a block of distances.
BLOCK = 512


def _below(nodes: DataFrame, places: DataFrame, how: str = "inner") -> DataFrame:
    """Join ``nodes`` (as ``n``) with those of ``places`` (as ``x``) that are under them.

    A tree is cut into tiles of preorder numbers, so one tree is many keys. ``how`` may
    be ``right`` to keep places under none.
    """
    tile = lambda c: F.floor(F.col(c) / TILE)
    n = nodes.withColumn("tile", F.explode(F.sequence(tile("pre"), tile("last")))).alias("n")
    x = places.withColumn("tile", tile("pre")).alias("x")
    return n.join(x, (F.col("n.tree_id") == F.col("x.tree_id")) & (F.col("n.tile") == F.col("x.tile")) & F.col("x.pre").between(F.col("n.pre"), F.col("n.last")), how)


def number_nodes(tree: DataFrame) -> DataFrame:
    """Node tables of trees that are given as parents and children only.

    ``tree``: ``tree_id, node_id, parent_id`` (null or empty: a root), ``edge_length`` and,
    where there is one, ``place``, the order of the children of a node; else they go by
    ``node_id``. Returns ``tree_id, node_id, parent_id, is_leaf, edge_length, pre, last, depth,
    root_dist``. Null lengths count as 0. Node ids that repeat in a tree, several roots
    of one tree, unknown parents and cycles are errors.

    A tour goes down and up every edge; each of its steps knows the next one, and twice
    as far every round, with the steps down and the depth summed up on the way. So rounds
    grow with the logarithm of the nodes, whatever the shape, and one large tree is many
    keys.
    """
    place = ["place"] if "place" in tree.columns else []
    rows = tree.select("tree_id", "node_id", F.when(F.col("parent_id") != "", F.col("parent_id")).alias("parent_id"), F.coalesce(F.col("edge_length").cast("double"), F.lit(0.0)).alias("edge_length"), *place)
    rows = staged(rows.withColumn("num", F.monotonically_increasing_id()))
    known = rows.select("tree_id", F.col("node_id").alias("parent_id"), F.col("num").alias("parent"))
    rows = staged(rows.join(known, ["tree_id", "parent_id"], "left"))
    sizes = staged(rows.groupBy("tree_id").agg(F.count("*").alias("n"), F.count_if(F.expr("parent_id IS NULL")).alias("roots"), F.count_if(F.expr("parent_id IS NOT NULL AND parent IS NULL")).alias("lost"), F.count_distinct("num").alias("distinct"), F.count_distinct("node_id").alias("names")))
    if not sizes.filter("roots <> 1 OR lost > 0 OR n <> distinct OR n <> names").isEmpty():
        raise ValueError("a tree has one root, known parents and distinct nodes")
    siblings = Window.partitionBy("parent").orderBy(*place, "node_id")
    kids = staged(rows.filter("parent IS NOT NULL").select("num", "parent", "node_id", *place).withColumn("next", F.lead("num").over(siblings)).withColumn("rank", F.row_number().over(siblings)))
    first = kids.filter("rank = 1").select(F.col("parent").alias("num"), F.col("num").alias("first"))
    after = kids.select("num", "next")
    linked = rows.select("num", "parent").join(first, "num", "left").join(after, "num", "left")
    # A step is twice the node's number down to it, one more back up.
    down = F.struct((2 * F.col("num")).alias("step"), F.when(F.col("first").isNotNull(), 2 * F.col("first")).otherwise(2 * F.col("num") + 1).alias("to"), F.lit(1).cast("long").alias("downs"), F.lit(1).cast("long").alias("level"))
    up = F.struct((2 * F.col("num") + 1).alias("step"), F.when(F.col("next").isNotNull(), 2 * F.col("next")).otherwise(2 * F.col("parent") + 1).alias("to"), F.lit(0).cast("long").alias("downs"), F.lit(-1).cast("long").alias("level"))
    tour = staged(linked.select(F.explode(F.array(down, up)).alias("x")).select("x.*"))
    ways = staged(rows.select("num", F.col("parent").alias("up"), F.col("edge_length").alias("far")))
    most = int(sizes.agg(F.max("n")).first()[0] or 0)
    for _ in range(max(1, (4 * most).bit_length())):
        if tour.filter("to IS NOT NULL").isEmpty():
            break
        on = tour.select(F.col("step").alias("to"), F.col("to").alias("then"), F.col("downs").alias("d"), F.col("level").alias("l"))
        tour = staged(tour.join(on, "to", "left").select("step", F.col("then").alias("to"), (F.col("downs") + F.coalesce("d", F.lit(0))).alias("downs"), (F.col("level") + F.coalesce("l", F.lit(0))).alias("level")))
        if not ways.filter("up IS NOT NULL").isEmpty():
            over = ways.select(F.col("num").alias("up"), F.col("up").alias("then"), F.col("far").alias("more"))
            ways = staged(ways.join(over, "up", "left").select("num", F.col("then").alias("up"), (F.col("far") + F.coalesce("more", F.lit(0.0))).alias("far")))
    else:
        raise ValueError("a tree has a cycle")
    there = tour.withColumn("num", F.shiftright("step", 1))
    into = there.filter("step % 2 = 0").select("num", F.col("downs").alias("left"), (-F.col("level")).alias("depth"))
    out = there.filter("step % 2 = 1").select("num", F.col("downs").alias("rest"))
    done = rows.join(into, "num").join(out, "num").join(ways.select("num", "far"), "num").join(sizes.select("tree_id", "n"), "tree_id")
    pre, last = F.col("n") - F.col("left"), F.col("n") - F.col("rest") - 1
    return done.select("tree_id", "node_id", "parent_id", (pre == last).alias("is_leaf"), "edge_length", pre.alias("pre"), last.alias("last"), "depth", F.col("far").alias("root_dist"))


def node_table(nodes: DataFrame) -> DataFrame:
    """Nodes with the number of leaves below, from one running count per tree."""
    upto = Window.partitionBy("tree_id").orderBy("pre").rowsBetween(Window.unboundedPreceding, 0)
    counted = nodes.withColumn("_c", F.sum(F.col("is_leaf").cast("long")).over(upto))
    ends = counted.select("tree_id", F.col("pre").alias("last"), F.col("_c").alias("_e"))
    below = F.col("_e") - F.col("_c") + F.col("is_leaf").cast("long")
    return counted.join(ends, ["tree_id", "last"]).select("tree_id", "node_id", "parent_id", "is_leaf", F.coalesce("edge_length", F.lit(0.0)).alias("edge_length"), below.alias("n_leaves"))


def edge_table(nodes: DataFrame) -> DataFrame:
    """Every child with its parent and the length between."""
    return nodes.filter("parent_id IS NOT NULL").select("tree_id", F.col("node_id").alias("child"), F.col("parent_id").alias("parent"), "edge_length")


def leaves(nodes: DataFrame) -> DataFrame:
    """Leaves in the order of the tree."""
    return nodes.filter("is_leaf").select("tree_id", "node_id", "pre").orderBy("tree_id", "pre")


def clade_leaves(nodes: DataFrame) -> DataFrame:
    """All leaves below each internal node."""
    return _below(nodes.filter("NOT is_leaf"), nodes.filter("is_leaf")).select("n.tree_id", "n.node_id", F.col("x.node_id").alias("leaf"))


def find_node(nodes: DataFrame, label: str) -> DataFrame:
    """The first node of each tree, in preorder, with a label."""
    found = nodes.filter(F.col("node_id") == label).groupBy("tree_id").agg(F.min("pre").alias("pre"))
    return nodes.join(found, ["tree_id", "pre"], "left_semi")


def mrca(nodes: DataFrame, cells: DataFrame) -> DataFrame:
    """Most recent common ancestor of a set of cells (``id``) in each tree; null where none is known."""
    known = nodes.filter("is_leaf").join(cells.select(F.col("id").alias("node_id")).distinct(), "node_id", "left_semi")
    span = known.groupBy("tree_id").agg(F.min("pre").alias("lo"), F.max("pre").alias("hi"))
    over = nodes.join(span, "tree_id").filter("pre <= lo AND last >= hi")
    deepest = over.groupBy("tree_id").agg(F.max_by("node_id", "pre").alias("mrca"))
    return nodes.select("tree_id").distinct().join(deepest, "tree_id", "left")


def _meeting_leaves(nodes: DataFrame, size: int) -> DataFrame:
    """Leaves with their tile of ``size`` places: ``g, tile, pre, root_dist, cell`` and ``meet``, ``level`` and ``up``, depth and root distance of the node where a leaf meets the next one."""
    parent = nodes.select("tree_id", F.col("node_id").alias("parent_id"), F.col("root_dist").alias("up"))
    after = nodes.filter("parent_id IS NOT NULL").join(parent, ["tree_id", "parent_id"]).select("tree_id", (F.col("pre") - 1).alias("pre"), (F.col("depth") - 1).alias("level"), "up")
    leaf = nodes.filter("is_leaf").select("tree_id", "pre", "root_dist", F.col("node_id").alias("cell")).join(after, ["tree_id", "pre"], "left")
    meet = F.struct(F.coalesce("level", F.lit(0)).cast("long").alias("level"), F.coalesce("up", F.lit(0.0)).alias("up"))
    return leaf.select(F.col("tree_id").alias("g"), F.floor(F.col("pre") / size).alias("tile"), "pre", "root_dist", "cell", meet.alias("meet"))


def _leaf_tiles(nodes: DataFrame, size: int) -> DataFrame:
    """Leaves by tiles of ``size`` places: ``g, tile``, ``x`` (``pre, root_dist, level, up, cell`` in preorder) and ``line`` (``tile, level, up`` of the tree's tiles).

    ``level`` and ``up`` are those of :func:`_meeting_leaves`, in ``line`` those of the
    shallowest node where leaves of a tile meet the next one.
    """
    tiles = _meeting_leaves(nodes, size).groupBy("g", "tile").agg(F.sort_array(F.collect_list(F.struct("pre", "root_dist", "meet.level", "meet.up", "cell"))).alias("x"), F.min("meet").alias("least"))
    tiles = staged(tiles)
    line = tiles.groupBy("g").agg(F.sort_array(F.collect_list(F.struct("tile", "least.level", "least.up"))).alias("line"))
    return tiles.join(line, "g").select("g", "tile", "x", "line")


def _meetings(level: np.ndarray, up: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Shallowest meeting from the first on, up to each one."""
    least = np.minimum.accumulate(level)
    first = np.maximum.accumulate(np.where(np.r_[True, least[1:] < least[:-1]], np.arange(len(level)), 0))
    return level[first], up[first]


def _meet(level_a: np.ndarray, up_a: np.ndarray, level_b: np.ndarray, up_b: np.ndarray, between: list | None) -> np.ndarray:
    """Root distances of where the leaves of two tiles meet; ``between`` is None for one tile with itself (zero diagonal), else holds the tiles' meetings between."""
    n, m = len(level_a), len(level_b)
    if between is None:
        top = np.zeros((n, n))
        for i in range(n - 1):
            top[i, i + 1 :] = _meetings(level_a[i:-1], up_a[i:-1])[1]
        return top + top.T
    la, ua = (x[::-1] for x in _meetings(level_a[::-1], up_a[::-1]))
    if between:
        least = min(between)
        low = least[0] < la
        la, ua = np.where(low, least[0], la), np.where(low, least[1], ua)
    lb, ub = np.full(m, np.inf), np.zeros(m)
    lb[1:], ub[1:] = _meetings(level_b[:-1], up_b[:-1]) if m > 1 else ((), ())
    return np.where(la[:, None] <= lb[None, :], ua[:, None], ub[None, :])


def _leaf_distances(nodes: DataFrame, whole: bool) -> DataFrame:
    """Each two leaves once (with places), or ``whole``: both ways and with the diagonal.

    Tiles of leaves meet in a Cartesian product: its tasks read their parts of both
    sides, so no shuffle grows with the pairs. Leaves of two tiles meet at the shallowest of
    three nodes: where the first meets the rest of its tile, the second the leaves before it in
    its own, and the tiles between; so a pair is a row of two arrays and an expression.
    """
    tiles = staged(_leaf_tiles(nodes, TILE))
    count, parts = tiles.count(), meeting_parts(tiles)
    names = ["tree_id", *(() if whole else ("a", "b")), "cell_a", "cell_b", "dist"]
    out = _tile_distances(tiles, whole, min(count, PAIR_PARTS**2)).select(names)
    if count == 1:
        return out
    order = Window.partitionBy("g", "tile").orderBy("pre")
    behind, before = (F.min("meet").over(order.rowsBetween(*x)) for x in ((0, Window.unboundedFollowing), (Window.unboundedPreceding, -1)))
    leaf = _meeting_leaves(nodes, TILE).select("g", "tile", "pre", "root_dist", "cell", behind.alias("behind"), before.alias("before"))
    side = lambda c: F.sort_array(F.collect_list(F.struct("pre", "root_dist", "cell", F.coalesce(f"{c}.level", F.lit(2**31)).alias("level"), F.coalesce(f"{c}.up", F.lit(0.0)).alias("up"))))
    sides = staged(leaf.groupBy("g", "tile").agg(side("behind").alias("behind"), side("before").alias("before")).join(tiles.select("g", "tile", "line"), ["g", "tile"]))
    ways = [("behind", "before", True), ("before", "behind", False)][: 2 if whole else 1]
    left, right = (sides.select("g", "tile", "line", F.explode(F.array(*(F.struct(F.lit(w[2]).alias("on"), F.col(w[k]).alias("x")) for w in ways))).alias("y")) for k in (0, 1))
    left = left.select("g", F.col("tile").alias("lo"), "line", "y.on", F.col("y.x").alias("a")).repartition(parts, "g", "lo", "on")
    right = right.select(F.col("g").alias("h"), F.col("tile").alias("hi"), F.col("y.on").alias("to"), F.col("y.x").alias("b")).repartition(parts, "h", "hi", "to")
    met = left.join(right.hint("shuffle_replicate_nl"), (F.col("g") == F.col("h")) & (F.col("on") == F.col("to")) & F.when(F.col("on"), F.col("lo") < F.col("hi")).otherwise(F.col("lo") > F.col("hi")))
    inside = F.filter("line", lambda x: (x["tile"] > F.least("lo", "hi")) & (x["tile"] < F.greatest("lo", "hi")))
    least = F.array_min(F.transform(inside, lambda x: F.struct(x["level"].alias("level"), x["up"].alias("up"))))
    # An array of one is looked at once a pair of tiles, a column once a row.
    met = met.select("g", "a", "b", F.explode(F.array(least)).alias("m"))
    low = lambda x: F.col("m.level") < x["level"]
    met = met.select("g", "b", F.inline(F.transform("a", lambda x: F.struct(x["pre"], x["root_dist"], x["cell"], F.when(low(x), F.col("m.level")).otherwise(x["level"]), F.when(low(x), F.col("m.up")).otherwise(x["up"])))).alias("a", "root_a", "cell_a", "level_a", "up_a"))
    met = unbuffered(met, parts).select("g", "a", "root_a", "cell_a", "level_a", "up_a", F.inline("b").alias("b", "root_b", "cell_b", "level_b", "up_b"))
    top = F.when(F.col("level_a") <= F.col("level_b"), F.col("up_a")).otherwise(F.col("up_b"))
    return out.unionByName(met.withColumn("tree_id", F.col("g")).withColumn("dist", F.col("root_a") + F.col("root_b") - 2 * top).select(names))


def _tile_distances(tiles: DataFrame, whole: bool, tasks: int) -> DataFrame:
    """Distances of the leaves of each tile, dealt over ``tasks``, which they leave in pieces; ``whole``: both ways and with the diagonal."""

    def run(batches):
        for batch in batches:
            for k in range(batch.num_rows):
                x = batch.column("x")[k].values
                level, up, root, pre = (x.field(c).to_numpy() for c in ("level", "up", "root_dist", "pre"))
                cell, name, top = x.field("cell"), batch.column("g")[k].as_py(), _meet(level, up, level, up, None)
                for i in range(0, len(root), 64):
                    dist = root[i : i + 64, None] + root[None, :] - 2 * top[i : i + 64]
                    a, b = (z.reshape(-1) for z in np.broadcast_arrays(np.arange(i, i + len(dist))[:, None], np.arange(len(root))[None, :]))
                    dist = dist.reshape(-1)
                    dist[a == b] = 0.0
                    if not whole:
                        a, b, dist = (z[a < b] for z in (a, b, dist))
                    g = pa.DictionaryArray.from_arrays(pa.array(np.zeros(len(a), np.int32)), pa.array([name], pa.string())).dictionary_decode()
                    yield pa.RecordBatch.from_arrays([g, pa.array(pre[a]), pa.array(pre[b]), cell.take(pa.array(a)), cell.take(pa.array(b)), pa.array(dist)], ["tree_id", "a", "b", "cell_a", "cell_b", "dist"])

    kind = tiles.schema["x"].dataType.elementType["cell"].dataType.simpleString()
    return tiles.select("g", "x").repartition(tasks, "g", F.col("x")[0]["pre"]).mapInArrow(run, f"tree_id string, a long, b long, cell_a {kind}, cell_b {kind}, dist double")


def leaf_pairs(nodes: DataFrame) -> DataFrame:
    """Each two leaves of a tree once (``a < b``): ``tree_id, a, b`` (places in preorder), ``cell_a, cell_b, dist``.

    The result grows with the square of a tree's leaves, what is kept doesn't.
    """
    return _leaf_distances(nodes, False)


def distance_blocks(nodes: DataFrame) -> DataFrame:
    """Squared distances of all leaves of a tree by blocks of two tiles: rows of :data:`~cladeworks.operators.linkage.BLOCKS`.

    Clusters are leaves by their place in preorder. Two neighbouring leaves meet at the
    parent of the node that follows the first; any two leaves meet at the shallowest
    meeting between them. So a block needs its own two tiles of leaves and the
    shallowest meeting of each tile between, and no pair is a row.
    """
    tiles = _leaf_tiles(nodes, BLOCK)
    left = tiles.select("g", F.col("tile").alias("lo"), F.col("x").alias("a"), "line")
    right = tiles.select("g", F.col("tile").alias("hi"), F.col("x").alias("b"))
    pairs = left.join(right, "g").filter("lo <= hi").repartition("g", "lo", "hi")

    def run(frames):
        for f in frames:
            out = []
            for r in f.itertuples():
                a, b = (np.array([(x["pre"], x["root_dist"], x["level"], x["up"]) for x in side]) for side in (r.a, r.b))
                n, m = len(a), len(b)
                between = None if r.lo == r.hi else [(x["level"], x["up"]) for x in r.line if r.lo < x["tile"] < r.hi]
                dist = a[:, 1][:, None] + b[:, 1][None, :] - 2 * _meet(a[:, 2], a[:, 3], b[:, 2], b[:, 3], between)
                if r.lo == r.hi:
                    np.fill_diagonal(dist, 0)
                out.append(block_row(r.g, r.lo, r.hi, a[:, 0].astype(int), b[:, 0].astype(int), np.ones(n, int), np.ones(m, int), dist * dist))
            yield pd.DataFrame(out, columns=["g", "lo", "hi", "a", "b", "na", "nb", "sums"])

    return pairs.mapInPandas(run, BLOCKS)


def leaf_points(nodes: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Leaves as points of :func:`~cladeworks.operators.linkage.agglomerate_points`, and a tree's inner nodes in one row.

    Points: ``g, c`` (place in preorder), ``n`` (1), ``top`` (place of the parent) and
    ``e``, the length above. The other: ``g, place, level, up, root``, arrays in preorder,
    ``up`` the distance of the parent from the root.
    """
    parent = nodes.select("tree_id", F.col("node_id").alias("parent_id"), F.col("pre").cast("long").alias("top"), F.col("root_dist").alias("up"))
    under = nodes.join(parent, ["tree_id", "parent_id"], "left")
    points = under.filter("is_leaf AND top IS NOT NULL").select(F.col("tree_id").alias("g"), F.col("pre").cast("long").alias("c"), F.lit(1).cast("long").alias("n"), "top", (F.col("root_dist") - F.col("up")).alias("e"))
    inner = under.filter("NOT is_leaf").groupBy(F.col("tree_id").alias("g")).agg(F.sort_array(F.collect_list(F.struct("pre", "depth", F.coalesce("up", F.lit(0.0)).alias("up"), "root_dist"))).alias("x"))
    return points, inner.select("g", F.col("x.pre").alias("place"), F.col("x.depth").alias("level"), F.col("x.up").alias("up"), F.col("x.root_dist").alias("root"))


def _apart(place: np.ndarray, level: np.ndarray, up: np.ndarray, root: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Distances between the inner nodes at the places ``a`` and those at ``b``.

    Two nodes meet above the shallowest node that lies behind the first, up to the second.
    """
    a, b = np.searchsorted(place, a), np.searchsorted(place, b)
    least = [np.arange(len(place))]  # the shallowest of 1, 2, 4... nodes from each on
    while 2 << len(least) - 1 <= len(place):
        x, y = least[-1][: -(1 << len(least) - 1)], least[-1][1 << len(least) - 1 :]
        least.append(np.where(level[x] <= level[y], x, y))
    lo, hi = np.minimum(a[:, None], b[None, :]), np.maximum(a[:, None], b[None, :])
    out = np.zeros(lo.shape)
    for k, first in enumerate(least):
        i, j = np.nonzero((hi - lo >= 1 << k) & (hi - lo < 2 << k))
        x, y = first[lo[i, j] + 1], first[hi[i, j] + 1 - (1 << k)]
        out[i, j] = root[lo[i, j]] + root[hi[i, j]] - 2 * up[np.where(level[x] <= level[y], x, y)]
    return out


def distance_sums(row, a: dict, b: dict) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Sums of squared distances between clusters of :func:`leaf_points`: leaves below one parent count as one.

    A distance is what is above each leaf and what is between their parents.
    """
    sides = []
    for x in (a, b):
        key, at = np.unique(np.stack([x["to"], x["top"]]), axis=1, return_inverse=True)
        n, e = np.bincount(at), np.bincount(at, x["e"])
        ids, own = np.unique(x["to"], return_inverse=True)
        tops, top = np.unique(key[1], return_inverse=True)
        sides.append((key[0], n.astype(float), e, tops, top, np.bincount(own).astype(float), np.bincount(own, x["e"]), np.bincount(own, x["e"] ** 2)))
    (ka, na, ea, ta, pa, *wa), (kb, nb, eb, tb, pb, *wb) = sides
    apart = _apart(row.place, row.level, row.up, row.root, ta, tb)

    def values(i, j):
        d = apart[np.ix_(pa[i], pb[j])]
        return d * ((d * na[i, None] + 2 * ea[i, None]) * nb[None, j] + 2 * na[i, None] * eb[None, j])

    ia, ib, s = L.cluster_sums(values, ka, kb)
    (na, ea, qa), (nb, eb, qb) = wa, wb
    return ia, ib, s + qa[:, None] * nb + na[:, None] * qb + 2 * ea[:, None] * eb


def leaf_kinds(points: DataFrame) -> DataFrame:
    """Points of :func:`leaf_points` below one parent and at one length from it as one: ``g, c`` (the smallest place), ``top, e, names`` (all places)."""
    return points.groupBy("g", "top", "e").agg(F.min("c").alias("c"), F.collect_list("c").alias("names"))


def kind_blocks(kinds: DataFrame, inner: DataFrame) -> DataFrame:
    """Squared distances between leaves of two kinds, and between two leaves of one: rows of :data:`~cladeworks.operators.linkage.BLOCKS`."""
    use = ["to", "top", "e"]

    def run(frames):
        for f in frames:
            for r in f.itertuples():
                ia, ib, s = distance_sums(r, *({c: getattr(r, f"{x}_{c}") for c in use} for x in "ab"))
                yield pd.DataFrame([block_row(r.g, r.lo, r.hi, ia, ib, np.ones(len(ia), int), np.ones(len(ib), int), s)])

    return tile_pairs(kinds.withColumnRenamed("c", "to"), use, extra=inner).mapInPandas(run, BLOCKS)


def pairwise_distances(nodes: DataFrame) -> DataFrame:
    """Distances of all leaves of each tree, both ways and with the diagonal: ``tree_id, cell_a, cell_b, dist``."""
    return _leaf_distances(nodes, True)


def node_positions(nodes: DataFrame) -> DataFrame:
    """Layout: ``x`` is the distance from the root, ``y`` a leaf's rank or the mean of the children's ``y``.

    Trees contract in rounds, as many as the logarithm of the nodes whatever the shape: a
    node that is known adds to its parent's sum; a parent that waits for one child only
    is a linear function of it, and of that child's own one child, twice as deep each
    round. So a round is linear in the nodes that aren't known yet.
    """
    rank = (F.row_number().over(Window.partitionBy("tree_id").orderBy("pre")) - 1).cast("double")
    above = nodes.select("tree_id", F.col("node_id").alias("parent_id"), F.col("pre").alias("up"))
    kids = nodes.filter("parent_id IS NOT NULL").groupBy("tree_id", F.col("parent_id").alias("node_id")).agg(F.count("*").alias("wait"))
    placed = nodes.select("tree_id", "node_id", "parent_id", F.col("pre").alias("at"), "is_leaf").join(above, ["tree_id", "parent_id"], "left").join(kids, ["tree_id", "node_id"], "left")
    share = kids.select("tree_id", F.col("node_id").alias("parent_id"), (1 / F.col("wait")).alias("w"))
    placed = staged(placed.join(share, ["tree_id", "parent_id"], "left").select("tree_id", "at", "up", "w", "wait", "is_leaf"))
    key = ["tree_id", "at"]
    leaf = nodes.filter("is_leaf").select("tree_id", F.col("pre").alias("at"), rank.alias("y"))
    fresh = staged(leaf.join(placed, key).select(*key, "up", "w", "y"))
    live = placed.filter("NOT is_leaf").select(*key, "up", "w", F.lit(0.0).alias("sum"), "wait", F.lit(None).cast("long").alias("link"), F.lit(0.0).alias("slope"))
    known = [fresh]
    while True:
        gains = fresh.groupBy("tree_id", F.col("up").alias("at")).agg(F.sum(F.col("w") * F.col("y")).alias("gain"), F.count("*").alias("came"))
        child = live.select("tree_id", F.col("up").alias("at"), F.col("at").alias("only"), F.col("w").alias("only_w")).groupBy("tree_id", "at").agg(F.min("only").alias("only"), F.min("only_w").alias("only_w"))
        value = fresh.select("tree_id", F.col("at").alias("link"), F.col("y").alias("below"))
        free = F.col("link").isNull()
        rows = live.join(gains, key, "left").withColumns({"sum": F.when(free, F.col("sum") + F.coalesce("gain", F.lit(0.0))).otherwise(F.col("sum")), "wait": F.when(free, F.col("wait") - F.coalesce("came", F.lit(0))).otherwise(F.col("wait"))})
        one = free & (F.col("wait") == 1)
        rows = rows.join(child, key, "left").withColumns({"slope": F.when(one, F.col("only_w")).otherwise(F.col("slope")), "link": F.when(one, F.col("only")).otherwise(F.col("link"))})
        y = F.when(F.col("wait") == 0, F.col("sum")).otherwise(F.col("sum") + F.col("slope") * F.col("below"))
        rows = staged(rows.join(value, ["tree_id", "link"], "left").select(*key, "up", "w", "sum", "wait", "link", "slope", y.alias("y")))
        fresh, rest = rows.filter("y IS NOT NULL").select(*key, "up", "w", "y"), rows.filter("y IS NULL").drop("y")
        if rest.isEmpty() or fresh.isEmpty() and rest.filter("link IS NOT NULL").isEmpty():
            break
        known.append(fresh)
        further = rest.filter("link IS NOT NULL").select("tree_id", F.col("at").alias("link"), F.col("sum").alias("s"), F.col("slope").alias("k"), F.col("link").alias("next"))
        on = F.col("next").isNotNull()
        live = rest.join(further, ["tree_id", "link"], "left").select(*key, "up", "w", F.when(on, F.col("sum") + F.col("slope") * F.col("s")).otherwise(F.col("sum")).alias("sum"), "wait", F.coalesce("next", "link").alias("link"), F.when(on, F.col("slope") * F.col("k")).otherwise(F.col("slope")).alias("slope"))
        live = staged(live)
    known.append(fresh)
    out = known[0]
    for part in known[1:]:
        out = out.union(part)
    named = nodes.select("tree_id", F.col("pre").alias("at"), "node_id", F.col("root_dist").alias("x"))
    return named.join(out.select(*key, "y"), key).select("tree_id", "node_id", "x", "y")


def _inner(nodes: DataFrame) -> DataFrame:
    return nodes.filter("NOT is_leaf AND parent_id IS NOT NULL")


def cut_threshold(nodes: DataFrame, min_branch_length: float | None = None) -> DataFrame:
    """Per tree the branch length from which a cut may be made.

    A given positive minimum; else mean plus population deviation of the branches
    into internal nodes, 0 if there are none.
    """
    trees = nodes.select("tree_id").distinct()
    if min_branch_length is not None and min_branch_length > 0:
        return trees.withColumn("threshold", F.lit(float(min_branch_length)))
    auto = _inner(nodes).groupBy("tree_id").agg((F.avg("edge_length") + F.stddev_pop("edge_length")).alias("threshold"))
    return trees.join(auto, "tree_id", "left").fillna(0.0, ["threshold"])


def select_boundary_nodes(nodes: DataFrame, min_cells: int, min_branch_length: float | None = None) -> DataFrame:
    """Internal nodes below the root whose branch is longer than the threshold and that hold ``min_cells`` leaves."""
    sized = node_table(nodes).select("tree_id", "node_id", "n_leaves")
    rows = _inner(nodes).join(sized, ["tree_id", "node_id"]).join(cut_threshold(nodes, min_branch_length), "tree_id")
    return rows.filter((F.col("edge_length") > F.col("threshold")) & (F.col("n_leaves") >= min_cells)).select("tree_id", "node_id", "edge_length", "n_leaves")


def cut_candidates(nodes: DataFrame, min_branch_length: float | None = None) -> DataFrame:
    """Internal nodes below the root whose branch is at or above the tree's threshold."""
    rows = _inner(nodes).join(cut_threshold(nodes, min_branch_length), "tree_id").filter("edge_length >= threshold")
    return rows.select("tree_id", "node_id", "edge_length", "pre", "last")


def sized_candidates(nodes: DataFrame, min_branch_length: float | None = None) -> DataFrame:
    """:func:`cut_candidates` as part of the whole tree: with ``part`` (empty), ``n``, the tree's leaves, and ``below``, those under the branch."""
    counted = node_table(nodes).select("tree_id", "node_id", F.col("n_leaves").alias("below"))
    size = nodes.filter("is_leaf").groupBy("tree_id").agg(F.count("*").alias("n"))
    rows = cut_candidates(nodes, min_branch_length).join(counted, ["tree_id", "node_id"]).join(size, "tree_id")
    return rows.select("tree_id", F.lit("").alias("part"), "n", "pre", "last", "edge_length", "below")


def longest_edges(sized: DataFrame, min_cells: int) -> DataFrame:
    """Of each part the longest candidate that leaves ``min_cells`` on both sides (ties: first in preorder): ``tree_id, part, from, to, under``.

    ``sized``: ``tree_id, part, n`` (leaves of the part) and ``pre, last, edge_length,
    below`` (leaves of the part under it) of each candidate.
    """
    good = sized.filter((F.col("below") >= min_cells) & (F.col("n") - F.col("below") >= min_cells))
    best = good.groupBy("tree_id", "part").agg(F.max(F.struct("edge_length", (-F.col("pre")).alias("p"), "last", "below")).alias("x"))
    return best.select("tree_id", "part", (-F.col("x.p")).alias("from"), F.col("x.last").alias("to"), F.col("x.below").alias("under"))


def cut_into_clones(nodes: DataFrame, min_cells: int = 5, min_branch_length: float | None = None) -> DataFrame:
    """Cut trees at long branches: ``tree_id, clone_id, cell_id, part``.

    Starts with all leaves of a tree. A part under ``2 * min_cells`` is final. Else
    the longest branch at or above the threshold (ties: first in preorder) that leaves
    ``min_cells`` on both sides cuts it; the lower part gets ``0`` behind its path, the
    rest ``1``, and the order of the paths is that in which parts become final:
    ``clade_1`` and so on. All parts of all trees go through a round together.

    A candidate belongs to the part around it. A cut takes its leaves off the candidates
    above it and moves those below to the new part, so a round is linear in the
    candidates and leaves of the parts that it cuts.
    """
    if min_cells < 1:
        raise ValueError("min_cells must be 1 or more")
    sized = staged(sized_candidates(nodes, min_branch_length))
    parts = nodes.filter("is_leaf").select("tree_id", F.col("node_id").alias("cell_id"), "pre", F.lit("").alias("part"))
    done = None
    while True:
        cut = staged(longest_edges(sized, min_cells))
        if cut.isEmpty():
            break
        inside = F.col("pre").between(F.col("from"), F.col("to"))
        part = F.concat("part", F.when(inside, "0").otherwise("1"))
        above = (F.col("pre") < F.col("from")) & (F.col("last") >= F.col("to"))
        n = F.when(inside, F.col("under")).otherwise(F.col("n") - F.col("under"))
        below = F.when(above, F.col("below") - F.col("under")).otherwise(F.col("below"))
        final = parts.join(cut, ["tree_id", "part"], "left_anti")
        done = final if done is None else done.unionByName(final)
        parts = staged(parts.join(cut, ["tree_id", "part"]).select("tree_id", "cell_id", "pre", part.alias("part")))
        # Parts that weren't cut won't be, and the branch that was cut is no longer within a part.
        sized = staged(sized.join(cut, ["tree_id", "part"]).filter(F.col("pre") != F.col("from")).select("tree_id", part.alias("part"), n.alias("n"), "pre", "last", "edge_length", below.alias("below")))
    parts = parts if done is None else done.unionByName(parts)
    names = parts.select("tree_id", "part").distinct().withColumn("k", F.dense_rank().over(Window.partitionBy("tree_id").orderBy("part")))
    return parts.join(names, ["tree_id", "part"]).select("tree_id", F.concat(F.lit("clade_"), "k").alias("clone_id"), "cell_id", "part")


def cut_at_nodes(nodes: DataFrame, labels: list[str]) -> DataFrame:
    """Each leaf goes to the smallest of the given clades that holds it (ties: the one given first), else ``unassigned``."""
    place = F.create_map(*[y for i, x in enumerate(labels) for y in (F.lit(x), F.lit(i))]) if labels else F.create_map().cast("map<string,int>")
    chosen = nodes.filter(F.col("node_id").isin(labels)).withColumn("place", place[F.col("node_id")]).join(node_table(nodes).select("tree_id", "node_id", "n_leaves"), ["tree_id", "node_id"])
    claims = _below(chosen, nodes.filter("is_leaf"), "right")
    first = Window.partitionBy("x.tree_id", "x.node_id").orderBy(F.col("n.n_leaves").asc_nulls_last(), "n.place")
    best = claims.withColumn("r", F.row_number().over(first)).filter("r = 1")
    return best.select("x.tree_id", F.coalesce("n.node_id", F.lit("unassigned")).alias("clone_id"), F.col("x.node_id").alias("cell_id"))


def annotate_nodes_with_clones(nodes: DataFrame, assignments: DataFrame) -> DataFrame:
    """Clone label of each node: a leaf's clone (or empty), an internal node's sorted clones below, joined by ``,``."""
    leaf = nodes.filter("is_leaf").join(assignments.select(F.col("cell_id").alias("node_id"), "clone_id"), "node_id", "left").select("tree_id", "node_id", "pre", F.coalesce("clone_id", F.lit("")).alias("clone_id"))
    below = _below(nodes.filter("NOT is_leaf"), leaf.filter("clone_id <> ''")).groupBy("n.tree_id", "n.node_id").agg(F.array_join(F.sort_array(F.collect_set("x.clone_id")), ",").alias("label"))
    inner = nodes.filter("NOT is_leaf").select("tree_id", "node_id").join(below, ["tree_id", "node_id"], "left").fillna("", ["label"])
    return inner.union(leaf.select("tree_id", "node_id", F.col("clone_id").alias("label")))


def annotate_nodes_with_events(nodes: DataFrame, branch_events: DataFrame | None) -> DataFrame:
    """Node table with ``n_events`` of the branch into each node, 0 for none, and ``event_summary``."""
    table = node_table(nodes)
    if branch_events is None:
        return table.withColumns({"n_events": F.lit(0), "event_summary": F.lit("")})
    child = "child_node" if "child_node" in branch_events.columns else branch_events.columns[0]
    kinds = F.array_join(F.sort_array(F.collect_set("event_type")), ";") if "event_type" in branch_events.columns else F.lit("")
    count = branch_events.groupBy(F.col(child).alias("node_id")).agg(F.count("*").cast("int").alias("n_events"), kinds.alias("event_summary"))
    return table.join(count, "node_id", "left").fillna(0, ["n_events"]).fillna("", ["event_summary"])
