"""Cells to clones (C1-C11, W2, W4): strategies, small clones, names, descriptions.

``clones`` hold ``tree_id, clone_id, cell_id``, one row for each cell.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.columns import event_key
from ..functions.linkage import DIGITS, NEAR_POINTS, cluster_sums, jaccard, merge_smallest, shared_counts
from ..functions.staging import staged
from . import linkage
from . import tree as T
from .linkage import BLOCKS, WHOLE_CLUSTERS, agglomerate_blocks, agglomerate_kinds, agglomerate_points, agglomerate_sets, block_row, by_ranges, packed_sets, tile_pairs

#: Clusters of a block whose sums one task makes.
BLOCK = 512
STRATEGIES = ("internal_node", "distance", "event_profile", "hybrid")


def event_profile(events: DataFrame, cells: DataFrame) -> DataFrame:
    """Distinct ``cell_id, event`` of the wanted cells; a cell without events has one row with null."""
    keyed = events.select("cell_id", event_key(events.columns).alias("event")).distinct()
    return cells.select("cell_id").distinct().join(keyed, "cell_id", "left")


def profile_matrix(profile: DataFrame, max_columns: int = 400) -> DataFrame:
    """Wide 0/1 matrix of an event profile; refused beyond ``max_columns`` events."""
    names = [r.event for r in profile.filter("event IS NOT NULL").select("event").distinct().orderBy("event").limit(max_columns + 1).collect()]
    if len(names) > max_columns:
        raise ValueError(f"more than {max_columns} events; use the long form")
    return profile.groupBy("cell_id").pivot("event", names).agg(F.lit(1)).fillna(0) if names else profile.select("cell_id").distinct()


def jaccard_distances(profile: DataFrame) -> DataFrame:
    """Jaccard distance of each two cells of a group: ``tree_id, cell_a, cell_b, dist`` with ``cell_a < cell_b``.

    ``profile``: ``tree_id, cell_id, event``. Two cells without events are at 0. Tiles of
    cells meet in a Cartesian product, and events are told apart by 64-bit hashes; a row
    that leaves Python is a cell with all cells of a tile. Only the result grows with
    the square of a group's cells.
    """
    code = F.when(F.col("event").isNotNull(), F.xxhash64("event"))
    cells = profile.groupBy(F.col("tree_id").alias("g"), "cell_id").agg(F.collect_set(code).alias("codes"))
    placed = cells.withColumn("tile", F.floor((F.row_number().over(Window.partitionBy("g").orderBy("cell_id")) - 1) / linkage.TILE))
    tiles = placed.groupBy("g", "tile").agg(F.sort_array(F.collect_list(F.struct("cell_id", "codes"))).alias("x"))
    tiles = staged(tiles.select("g", "tile", F.col("x.cell_id").alias("cells"), F.col("x.codes").alias("codes")))
    parts = linkage.meeting_parts(tiles)
    left = tiles.select("g", F.col("tile").alias("lo"), F.col("cells").alias("a_cells"), F.col("codes").alias("a_codes")).repartition(parts, "g", "lo")
    right = tiles.select(F.col("g").alias("h"), F.col("tile").alias("hi"), F.col("cells").alias("b_cells"), F.col("codes").alias("b_codes")).repartition(parts, "h", "hi")
    pairs = left.join(right.hint("shuffle_replicate_nl"), (F.col("g") == F.col("h")) & (F.col("lo") <= F.col("hi")))

    def run(batches):
        for batch in batches:
            for k in range(batch.num_rows):
                r = {c: batch.column(c)[k] for c in batch.schema.names}
                (na, ca), (nb, cb) = ((pc.list_value_length(x).to_numpy(), x.flatten().to_numpy()) for x in (r["a_codes"].values, r["b_codes"].values))
                both, ids, others, same = shared_counts(ca, na, cb, nb), r["a_cells"].values, r["b_cells"].values, r["lo"] == r["hi"]
                for i in range(0, len(ids), 64):
                    shared = both[i : i + 64].astype(float)
                    union = na[i : i + 64, None] + nb[None, :] - shared
                    dist = np.where(union > 0, 1 - shared / np.maximum(union, 1), 0.0)
                    first = np.arange(i, i + len(dist)) + 1 if same else np.zeros(len(dist), int)  # in its own tile a cell meets those behind
                    ends = pa.array(np.append(0, np.cumsum(len(others) - first)), pa.int32())
                    names = pa.concat_arrays([others.slice(x) for x in first])
                    dist = dist[np.arange(len(others)) >= first[:, None]]
                    g = pa.array([r["g"].as_py()] * len(first), pa.string())
                    yield pa.RecordBatch.from_arrays([g, ids.slice(i, len(first)), pa.ListArray.from_arrays(ends, names), pa.ListArray.from_arrays(ends, pa.array(dist))], ["tree_id", "cell_a", "others", "dists"])

    kind = profile.schema["cell_id"].dataType.simpleString()
    met = pairs.mapInArrow(run, f"tree_id string, cell_a {kind}, others array<{kind}>, dists array<double>")
    met = met.select("tree_id", "cell_a", "others", F.posexplode("dists").alias("at", "dist"))
    return met.select("tree_id", "cell_a", F.col("others")[F.col("at")].alias("cell_b"), "dist")


def merge_to_n(clones: DataFrame, max_clones: int | None) -> DataFrame:
    """Merge the smallest clone of a tree into its second smallest until ``max_clones`` are left.

    Existing order (ties) is that of the clone's number, then its name.
    """
    if max_clones is None:
        return clones
    number = F.coalesce(F.regexp_extract("clone_id", r"(\d+)$", 1).try_cast("int"), F.lit(0))
    sizes = clones.groupBy("tree_id", "clone_id").agg(F.count("*").alias("n")).withColumn("place", number)

    def cap(f: pd.DataFrame) -> pd.DataFrame:
        f = f.sort_values(["place", "clone_id"])
        goes = merge_smallest(list(zip(f["clone_id"], f["n"], strict=True)), max_clones)
        return pd.DataFrame({"tree_id": f["tree_id"], "clone_id": f["clone_id"], "to": [goes[c] for c in f["clone_id"]]})

    goes = sizes.groupBy("tree_id").applyInPandas(cap, "tree_id string, clone_id string, to string")
    return clones.join(goes, ["tree_id", "clone_id"]).withColumn("clone_id", F.col("to")).drop("to")


def assign_internal_node(nodes: DataFrame, min_cells: int, min_branch_length: float | None = None, max_clones: int | None = None) -> DataFrame:
    """Cut at long branches, then cap the number of clones."""
    return merge_to_n(T.cut_into_clones(nodes, min_cells, min_branch_length).select("tree_id", "clone_id", "cell_id"), max_clones)


def _numbered(clusters: DataFrame, name: str) -> DataFrame:
    """``g, cell_id, label``: clusters numbered by their first member."""
    rank = F.dense_rank().over(Window.partitionBy("g").orderBy("c"))
    labels = clusters.select("g", "c").distinct().withColumn("label", F.concat(F.lit(name), rank.cast("string")))
    return clusters.join(labels, ["g", "c"]).select("g", "cell_id", "label")


def assign_distance(nodes: DataFrame, distance_threshold: float | None) -> DataFrame:
    """Ward linkage on tree distances, cut at ``distance_threshold``.

    In a large tree leaves below one parent at one length from it are merged as a kind;
    where even those are many, tile by tile.
    """
    if distance_threshold is None:
        raise ValueError("the distance strategy needs distance_threshold")
    members = staged(nodes.filter("is_leaf").select(F.col("tree_id").alias("g"), F.col("pre").cast("long").alias("c"), F.col("node_id").alias("cell_id")))
    small, large = _by_size(members)
    out = agglomerate_blocks(T.distance_blocks(nodes.join(small.withColumnRenamed("g", "tree_id"), "tree_id", "left_semi")), members.join(small, "g", "left_semi"), distance_threshold, "ward")
    if not large.isEmpty():
        points, inner = map(staged, T.leaf_points(nodes.join(large.withColumnRenamed("g", "tree_id"), "tree_id", "left_semi")))
        kinds = staged(T.leaf_kinds(points))
        few, many = _by_size(kinds)
        out = out.unionByName(agglomerate_kinds(T.kind_blocks(kinds.join(few, "g", "left_semi"), inner), kinds.join(few, "g", "left_semi"), members.join(few, "g", "left_semi"), distance_threshold, "ward"))
        if not many.isEmpty():
            out = out.unionByName(agglomerate_points(points.join(many, "g", "left_semi"), ["top", "e"], members.join(many, "g", "left_semi"), distance_threshold, "ward", T.distance_sums, inner))
    return _numbered(out, "clone_").select(F.col("g").alias("tree_id"), F.col("label").alias("clone_id"), "cell_id")


def _by_size(members: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Groups of few enough clusters for one task, and the others."""
    size = staged(members.groupBy("g").agg((F.count_distinct("c") <= WHOLE_CLUSTERS).alias("whole")))
    return size.filter("whole").select("g"), size.filter("NOT whole").select("g")


def _alike(profile: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Cells of equal events as one: ``g, cell_id, c`` and the clusters ``g, c, n, events``.

    ``profile``: ``g, cell_id, place, event``; ``c`` is the smallest place.
    """
    cells = staged(profile.groupBy("g", "cell_id").agg(F.min("place").cast("long").alias("place"), F.sort_array(F.collect_set("event")).alias("events")))
    alike = staged(cells.groupBy("g", "events").agg(F.min("place").alias("c"), F.count("*").alias("n")))
    return cells.join(alike, ["g", "events"]).select("g", "cell_id", "c"), alike


def _similar_points(alike: DataFrame) -> DataFrame:
    """Clusters of cells with equal events as points: ``g, c, n, codes`` (events as 64-bit hashes)."""
    return alike.select("g", "c", "n", F.transform("events", lambda e: F.xxhash64(e)).alias("codes"))


def similar_sums(row, a: dict, b: dict) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Sums of their cells' Jaccard similarities between clusters of points with ``codes``."""
    na, nb = (np.array([len(c) for c in x["codes"]]) for x in (a, b))
    both = shared_counts(np.concatenate(a["codes"]), na, np.concatenate(b["codes"]), nb)

    def values(i, j):
        k = both[i, j].astype(float)
        k /= np.maximum(na[i, None] + nb[None, j] - k, 1)
        k *= a["n"][i, None]
        k *= b["n"][None, j]
        return k

    return cluster_sums(values, a["to"], b["to"])


def _similar_blocks(alike: DataFrame) -> DataFrame:
    """The same sums by blocks (:data:`~cladeworks.operators.linkage.BLOCKS`) of ``BLOCK`` clusters."""
    counts = alike.groupBy("g").agg(F.ceil(F.count("*") / BLOCK).alias("blocks"))
    dealt = alike.join(counts, "g").withColumn("own", F.pmod(F.xxhash64("c"), F.col("blocks")))
    tiles = staged(dealt.groupBy("g", "own").agg(F.sort_array(F.collect_list(F.struct("c", "n", "events"))).alias("x")))
    left = tiles.select("g", F.col("own").alias("lo"), F.col("x").alias("a"))
    right = tiles.select("g", F.col("own").alias("hi"), F.col("x").alias("b"))
    pairs = left.join(right, "g").filter("lo <= hi").repartition("g", "lo", "hi")

    def run(frames):
        for f in frames:
            out = []
            for r in f.itertuples():
                names = {e: k for k, e in enumerate({e for side in (r.a, r.b) for x in side for e in x["events"]})}
                has = []
                for side in (r.a, r.b):
                    m = np.zeros((len(side), len(names)), np.float32)
                    for k, x in enumerate(side):
                        m[k, [names[e] for e in x["events"]]] = 1
                    has.append(m)
                both = (has[0] @ has[1].T).astype(float)
                size = [m.sum(axis=1).astype(float) for m in has]
                ids, n = ([np.array([x[c] for x in side], int) for side in (r.a, r.b)] for c in ("c", "n"))
                union = size[0][:, None] + size[1][None, :] - both
                sums = n[0][:, None] * n[1][None, :] * both / np.maximum(union, 1)
                if r.lo == r.hi:
                    np.fill_diagonal(sums, 0)
                out.append(block_row(r.g, r.lo, r.hi, *ids, *n, sums))
            yield pd.DataFrame(out, columns=["g", "lo", "hi", "a", "b", "na", "nb", "sums"])

    return pairs.mapInPandas(run, BLOCKS)


def _similarity_within(alike: DataFrame) -> DataFrame:
    """Per group the sum of similarities of each two of its clusters' cells: ``g, s``; a range of clusters hands on one number."""
    sets, over = packed_sets(_similar_points(alike))

    def run(r, lo, hi):
        n, words = np.frombuffer(r.n, np.int64).astype(float), np.frombuffer(r.words, np.uint64).reshape(r.k, -1)
        size = np.bitwise_count(words).sum(axis=1).astype(float)
        total, tall = 0.0, max(1, NEAR_POINTS // r.k)
        for i in range(lo, hi, tall):
            own = slice(i, min(i + tall, hi))
            for j in range(0, r.k, NEAR_POINTS):
                other = slice(j, j + NEAR_POINTS)
                total += n[own] @ (jaccard(words, size, own, other) @ n[other])
        return {"s": (total - (n[lo:hi] ** 2)[size[lo:hi] > 0].sum()) / 2}

    def tiles(frames):
        for f in frames:
            for r in f.itertuples():
                s = similar_sums(r, *({c: getattr(r, f"{x}_{c}") for c in ("to", "n", "codes")} for x in "ab"))[2]
                yield pd.DataFrame({"g": [r.g], "s": [(s.sum() - s.trace()) / 2 if r.same else s.sum()]})

    out = by_ranges(sets, run, "s double")
    if not over.isEmpty():
        points = _similar_points(alike).join(over, "g", "left_semi").withColumnRenamed("c", "to")
        out = out.unionByName(tile_pairs(points, ["to", "n", "codes"]).mapInPandas(tiles, "g string, s double"))
    return out.groupBy("g").agg(F.sum("s").alias("s"))


def _by_events(members: DataFrame, alike: DataFrame, similarity: float, name: str) -> DataFrame:
    """Average linkage of Jaccard distances within each group: ``g, cell_id, label``."""
    if similarity <= 0:  # no two clusters are further apart than 1
        return _numbered(members.withColumn("c", F.lit(0).cast("long")), name)
    members = staged(members)
    small, large = _by_size(members)
    out = agglomerate_blocks(_similar_blocks(alike.join(small, "g", "left_semi")), members.join(small, "g", "left_semi"), 1 - similarity, "average")
    if not large.isEmpty():
        points = staged(_similar_points(alike.join(large, "g", "left_semi")))
        sets, over = packed_sets(points)
        out = out.unionByName(agglomerate_sets(sets, members.join(large, "g", "left_semi").join(over, "g", "left_anti"), 1 - similarity))
        if not over.isEmpty():
            out = out.unionByName(agglomerate_points(points.join(over, "g", "left_semi"), ["codes"], members.join(over, "g", "left_semi"), 1 - similarity, "average", similar_sums))
    return _numbered(out, name)


def assign_event_profile(cells: DataFrame, events: DataFrame, similarity: float = 0.5, max_clones: int | None = None) -> DataFrame:
    """Average linkage on event profiles, cut so that clusters keep ``similarity``; then the cap.

    ``cells``: ``tree_id, cell_id, place``; a clone's number follows its first place. No events: one clone.
    """
    profile = cells.join(event_profile(events, cells), "cell_id").withColumnRenamed("tree_id", "g")
    members, alike = _alike(profile)
    clones = _by_events(members, alike, similarity, "clone_")
    return merge_to_n(clones.select(F.col("g").alias("tree_id"), F.col("label").alias("clone_id"), "cell_id"), max_clones)


def assign_hybrid(nodes: DataFrame, cells: DataFrame, events: DataFrame, min_cells: int, min_branch_length: float | None = None, similarity: float = 0.5, max_clones: int | None = None) -> DataFrame:
    """Cut the tree, then split parts of differing events: clones ``{clone}_sub{label}``.

    The tree is cut with 2 cells at least. A part is kept when one minus the mean of
    its whole distance matrix (zero diagonal included) reaches ``similarity``, when it
    has fewer than ``min_cells`` cells, or when there are no events.
    """
    parts = assign_internal_node(nodes, 2, min_branch_length, max_clones).join(cells.select("tree_id", "cell_id", "place"), ["tree_id", "cell_id"])
    parts = staged(parts.withColumn("g", F.concat_ws("\u0001", "tree_id", "clone_id")))
    members, alike = _alike(parts.join(event_profile(events, cells), "cell_id").select("g", "cell_id", "place", "event"))
    size = parts.groupBy("g").agg(F.count("*").alias("n"))
    within = alike.groupBy("g").agg(F.sum(F.col("n") * F.col("n")).alias("own")).join(_similarity_within(alike), "g", "left").fillna(0.0, ["s"])
    mean = (F.col("own") + 2 * F.col("s")) / (F.col("n") * F.col("n"))
    split = staged(size.join(within, "g").filter((F.col("n") >= max(2, min_cells)) & (F.round(mean, DIGITS) < similarity)).select("g"))
    cut = _by_events(members.join(split, "g", "left_semi"), alike.join(split, "g", "left_semi"), similarity, "_sub")
    label = F.concat("clone_id", F.coalesce("label", F.lit("")))
    return parts.join(cut, ["g", "cell_id"], "left").select("tree_id", label.alias("clone_id"), "cell_id")


def handle_small_clones(clones: DataFrame, min_cells: int = 5, action: str = "flag") -> DataFrame:
    """Append ``flagged`` after dealing with clones under ``min_cells`` cells.

    ``drop`` takes their cells out, ``merge`` puts them into the largest clone of the
    tree (ties: the first by name; all small: one ``clone_merged``), ``flag`` marks them.
    """
    if action not in ("drop", "merge", "flag"):
        raise ValueError("action is 'drop', 'merge' or 'flag'")
    size = clones.groupBy("tree_id", "clone_id").agg(F.count("*").alias("n"))
    best = Window.partitionBy("tree_id").orderBy(F.desc("n"), "clone_id")
    size = size.withColumn("r", F.row_number().over(best)).withColumn("small", F.col("n") < min_cells)
    largest = size.filter("r = 1").select("tree_id", F.when(F.col("small"), "clone_merged").otherwise(F.col("clone_id")).alias("largest"))
    rows = clones.join(size.select("tree_id", "clone_id", "small"), ["tree_id", "clone_id"])
    if action == "drop":
        return rows.filter("NOT small").select("tree_id", "clone_id", "cell_id", F.lit(False).alias("flagged"))
    if action == "flag":
        return rows.select("tree_id", "clone_id", "cell_id", F.col("small").alias("flagged"))
    rows = rows.join(largest, "tree_id")
    return rows.select("tree_id", F.when(F.col("small"), F.col("largest")).otherwise(F.col("clone_id")).alias("clone_id"), "cell_id", F.lit(False).alias("flagged"))


def rename_clones(clones: DataFrame) -> DataFrame:
    """Final names ``clone_001``... by the order of the provisional names as text, per tree."""
    rank = F.dense_rank().over(Window.partitionBy("tree_id").orderBy("clone_id")).cast("string")
    name = F.concat(F.lit("clone_"), F.when(F.length(rank) < 3, F.lpad(rank, 3, "0")).otherwise(rank))
    names = clones.select("tree_id", "clone_id").distinct().withColumn("_name", name)
    return clones.join(names, ["tree_id", "clone_id"]).withColumn("clone_id", F.col("_name")).select(clones.columns)


def assign_clones(strategy: str, nodes: DataFrame, cells: DataFrame, events: DataFrame | None = None, *, min_cells: int = 5, min_branch_length: float | None = None,
                  distance_threshold: float | None = None, similarity: float = 0.5, max_clones: int | None = None, small: str = "flag") -> DataFrame:
    """Assignment table of a strategy: ``tree_id, cell_id, clone_id, strategy, flagged, confidence``.

    The full tree is cut or measured; then cells that aren't in ``cells`` go, before
    sizes are checked.
    """
    if strategy not in STRATEGIES:
        raise ValueError(f"strategy is one of {', '.join(STRATEGIES)}")
    if strategy in ("event_profile", "hybrid") and events is None:
        raise ValueError(f"the {strategy} strategy needs events")
    wanted = nodes.filter("is_leaf").select("tree_id", F.col("node_id").alias("cell_id"), F.col("pre").alias("place")).join(cells.select("cell_id").distinct(), "cell_id", "left_semi")
    if strategy == "internal_node":
        clones = assign_internal_node(nodes, min_cells, min_branch_length, max_clones)
    elif strategy == "distance":
        clones = assign_distance(nodes, distance_threshold)
    elif strategy == "event_profile":
        clones = assign_event_profile(wanted, events, similarity, max_clones)
    else:
        clones = assign_hybrid(nodes, wanted, events, min_cells, min_branch_length, similarity, max_clones)
    clones = clones.join(wanted.select("tree_id", "cell_id"), ["tree_id", "cell_id"], "left_semi")
    out = rename_clones(handle_small_clones(clones, min_cells, small))
    return out.select("tree_id", "cell_id", "clone_id", F.lit(strategy).alias("strategy"), "flagged", F.lit(1.0).alias("confidence"))


def sort_assignments(assignments: DataFrame) -> DataFrame:
    """Assignments by clone and cell."""
    return assignments.orderBy("clone_id", "cell_id")


def clone_cell_events(assignments: DataFrame, events: DataFrame) -> DataFrame:
    """Events of assigned cells with their clone: ``clone_id, cell_id, event``."""
    keyed = events.select("cell_id", event_key(events.columns).alias("event"))
    return keyed.join(assignments.select("cell_id", "clone_id"), "cell_id").select("clone_id", "cell_id", "event")


def clone_events(assignments: DataFrame, events: DataFrame) -> DataFrame:
    """Per clone every event with the share of the clone's cells that have it.

    Repeated events of a cell are neighbours in the order that the join needs anyway, so
    a task holds one sort of its rows and no table of distinct cells and events.
    """
    assigned = assignments.select("cell_id", "clone_id").repartition("cell_id").distinct()
    size = assigned.groupBy("clone_id").agg(F.count("cell_id").alias("n"))
    keyed = events.select("cell_id", event_key(events.columns).alias("event")).filter("cell_id IS NOT NULL")
    new = F.coalesce(F.lag("event").over(Window.partitionBy("cell_id").orderBy("event")) != F.col("event"), F.lit(True))
    has = keyed.withColumn("new", new).filter("new").join(assigned, "cell_id")
    per = has.groupBy("clone_id", "event").agg(F.count("*").alias("k"))
    return per.join(size, "clone_id").select("clone_id", "event", (F.col("k") / F.col("n")).alias("fraction_cells"))


def clone_summary(assignments: DataFrame, events: DataFrame) -> DataFrame:
    """Per clone its cells, its defining events (in half of the cells or more), and the first ten of those."""
    size = assignments.groupBy("clone_id").agg(F.countDistinct("cell_id").alias("n_cells"))
    main = clone_events(assignments, events).filter("fraction_cells >= 0.5").groupBy("clone_id")
    main = main.agg(F.count("*").alias("n_defining_events"), F.array_join(F.slice(F.sort_array(F.collect_list("event")), 1, 10), ";").alias("defining_events"))
    return size.join(main, "clone_id", "left").fillna(0, ["n_defining_events"]).fillna("", ["defining_events"]).orderBy(F.desc("n_cells"), "clone_id")
