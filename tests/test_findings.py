"""Findings of a reviewer, each as a small case that failed before."""

import inspect
import os
import random
import re
import tracemalloc

import duckdb
import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from cladeworks.functions.linkage import merge_clusters, merge_kinds, merge_listed, merge_smallest, near_lists
from cladeworks.functions.newick import newick_parts, parse_newick
from cladeworks.operators import alignment
from cladeworks.operators import calls as K
from cladeworks.operators import clones as G
from cladeworks.operators import linkage
from cladeworks.operators import pseudobulk as P
from cladeworks.operators import tree as T
from cladeworks.plans import queries, testdata

SMALL = "/root/testdata/sf0.001"


def test_indel_reference_is_never_broadcast(spark):
    """an exploded reference passes for small, whatever comes out of it."""
    chunks = spark.range(1).select(F.lit("c").alias("chrom"), F.explode(F.sequence(F.lit(0), F.lit(1000))).alias("chunk_index"), F.lit("A" * 64).alias("sequence"))
    sites = spark.range(100_000).select(F.lit("c").alias("chrom"), F.col("id").alias("chunk_index"))
    plan = sites.join(alignment._chunks(chunks), ["chrom", "chunk_index"])._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in plan and "Broadcast" not in plan


def test_base_qualities_are_those_of_the_sql(spark):
    """F8: a cast rounds in DuckDB and truncates in Spark."""
    sql = testdata.with_views("SELECT read_id, base_quality FROM reads")
    with duckdb.connect() as con:
        for t in testdata.TABLES:
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SMALL}/{t}.parquet'")
        want = sorted(con.execute(sql).fetchall())
    got = testdata.view(spark, SMALL, "reads").select("read_id", "base_quality").collect()
    assert sorted(map(tuple, got)) == want


@pytest.mark.parametrize("across", [False, True])
@pytest.mark.parametrize("few", [0, 1000])
def test_counts_of_duplicates_without_marking(spark, monkeypatch, across, few):
    """The counts are those of marked reads, also where some reads have the bit before and qualities tie."""
    monkeypatch.setattr(P, "BROADCAST_GROUPS", few)
    rng = random.Random(3)
    rows = [(rng.choice(["x", "y", None]), rng.choice("ab"), f"r{rng.randrange(40)}", "c", rng.randrange(3), "5M", rng.choice([0, 16, 4, 256, 1024]), "c", 9, rng.choice([7, 8, None])) for _ in range(200)]
    rows += [("z", "a", "r", "c", 1, "5M", 4, "c", 9, 1), *[("w", "a", "r", "c", 1, "5M", 1024, "c", 9, 1)] * 3]
    reads = spark.createDataFrame(rows, "clone_id string, cell_id string, read_id string, chrom string, start long, cigar string, flag int, mate_chrom string, mate_start long, base_quality int")
    marked = P.mark_duplicates(reads, across)
    assert marked.count() == len(rows)
    assert set(map(tuple, P.marked_metrics(reads, across).collect())) == set(map(tuple, P.duplicate_metrics(marked).collect()))
    for name in ("p7_duplicate_metrics", "p7_library_size"):
        plan = queries.QUERIES[name](spark, SMALL)._jdf.queryExecution().optimizedPlan().toString()
        assert "read_id" not in plan


def test_pileup_hands_on_a_base_once(monkeypatch):
    """however many reads a task adds up, each place and letter leaves it once."""
    monkeypatch.setattr(K, "PILEUP_BASES", 1000)
    rng = random.Random(1)
    rows = [(rng.choice(["x", None]), rng.choice(["c", None]), rng.choice([-2, 0, 500, 510]), rng.choice(["ACGT" * 5, "é一T"])) for _ in range(2000)]
    want = {}
    for clone, chrom, first, bases in rows:
        for i, b in enumerate(bases.encode("latin-1", "replace").decode("latin-1")):
            want[clone, chrom, first + i + 1, b] = want.get((clone, chrom, first + i + 1, b), 0) + 1
    schema = pa.schema([("clone_id", pa.string()), ("chrom", pa.string()), ("first", pa.int64()), ("bases", pa.string())])
    batches = [pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows[k : k + 100], strict=True), schema, strict=True)], schema=schema) for k in range(0, 2000, 100)]
    out = [r for b in K._count_bases(iter(batches)) for r in b.to_pylist()]
    seen = [((r["clone_id"], r["chrom"], x["pos"], x["alt"]), x["n"]) for r in out for x in r["seen"]]
    assert len(seen) == len(want) and dict(seen) == want
    assert all((x["pos"] - 1) // K.PILEUP_TILE == r["tile"] for r in out for x in r["seen"])


def test_default_search_does_not_depend_on_size():
    """the number of vectors chooses nothing."""
    from cladeworks.llm import cross_polytope

    assert inspect.signature(cross_polytope.nearest_neighbours).parameters["hashes"].default == 1
    assert all(len(x) == 2 for x in cross_polytope.SETTINGS.values())


def test_alignment_text_is_written_compressed(spark, monkeypatch, tmp_path):
    """lines of alignments are mostly bases and qualities."""
    monkeypatch.setattr(queries, "staging_path", lambda _: str(tmp_path))
    assert queries.QUERIES["s5_read_reads"](spark, SMALL).count() == testdata.view(spark, SMALL, "reads").count()
    assert any(f.endswith(".gz") for f in os.listdir(tmp_path / "reads"))


def test_large_tree_takes_little_memory():
    """nodes leave the parser in pieces; before, each was a dictionary of all of its values."""
    n = 50_000
    text = "(" + ",".join(f"CELL_{i:09d}:0.5" for i in range(n)) + ")root;"
    tracemalloc.start()
    assert sum(len(p[0]) for p in newick_parts(text, 1024)) == n + 1
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 200 * n
    small = "((a:1,b:2)x:0.5,(,c));"
    assert [[r for p in newick_parts(small, k) for r in zip(*p, strict=True)] for k in (1, 3)] == [[tuple(r.values()) for r in parse_newick(small)]] * 2


def _partition(clones):
    out = {}
    for r in clones.collect():
        out.setdefault(r.clone_id, set()).add(r.cell_id)
    return {frozenset(x) for x in out.values()}


@pytest.mark.parametrize("strategy", ["distance", "event_profile"])
def test_large_groups_have_no_table_of_pairs(spark, monkeypatch, strategy):
    """groups beyond one task are merged tile by tile, with the same clones; before, all pairs were rows."""
    rng = random.Random(2)
    nodes = [("n0", None, 0.0)]
    for k in range(1, 60):
        up = rng.randrange(max(0, k - 12), k) if k < 25 else rng.randrange(25)
        nodes.append((f"n{k}", f"n{up}", rng.choice([0.0, 0.1, 0.1, 0.25, rng.random()])))
    tree = T.number_nodes(spark.createDataFrame([("t", *n) for n in nodes], "tree_id string, node_id string, parent_id string, edge_length double")).localCheckpoint()
    cells = tree.filter("is_leaf").select("tree_id", F.col("node_id").alias("cell_id"), F.col("pre").alias("place")).localCheckpoint()
    events = spark.createDataFrame([(r.cell_id, f"chr{x}") for r in cells.collect() for x in range(7) if rng.random() < 0.4], "cell_id string, chr string")
    run = lambda: _partition(G.assign_distance(tree, 0.6) if strategy == "distance" else G.assign_event_profile(cells, events, 0.6))
    whole = run()
    assert 1 < len(whole) < cells.count()
    monkeypatch.setattr(G, "WHOLE_CLUSTERS", 6)
    monkeypatch.setattr(linkage, "WHOLE_CLUSTERS", 6)
    monkeypatch.setattr(linkage, "TILE", 5)
    assert not hasattr(G, "_similar")
    assert run() == whole


def test_many_clones_are_capped_fast():
    """tens of thousands of clones, each step of which sorted them all before."""
    sizes = [(f"c{i}", 1 + i % 3) for i in range(50_000)]
    assert len(set(merge_smallest(sizes, 20).values())) == 20


def test_jaccard_pairs_copy_no_cell_for_each_block(spark, monkeypatch):
    """tiles of cells meet, so a pair of tiles is one row; a cell was one for each block of its group before."""
    monkeypatch.setattr(linkage, "TILE", 4)
    rng = random.Random(4)
    has = {(g, f"c{i}"): {f"e{x}" for x in range(9) if rng.random() < 0.3} for g in "xy" for i in range(11)}
    profile = spark.createDataFrame([(g, c, e) for (g, c), s in has.items() for e in s or [None]], "tree_id string, cell_id string, event string")
    want = {}
    for (g, a), x in has.items():
        for (k, b), y in has.items():
            if g == k and a < b:
                want[g, a, b] = 1 - len(x & y) / len(x | y) if x | y else 0.0
    out = G.jaccard_distances(profile)
    got = {tuple(r)[:3]: r.dist for r in out.collect()}
    assert out.count() == len(want) == len(got) and all(abs(got[k] - v) < 1e-12 for k, v in want.items())
    assert "FlatMapGroups" not in out._jdf.queryExecution().optimizedPlan().toString()


def test_hybrid_keeps_no_matrix_of_similarities(spark, monkeypatch):
    """a part's mean comes from one number for two tiles; all sums of all parts were written before."""
    monkeypatch.setattr(linkage, "TILE", 3)
    rng = random.Random(6)
    sets = {(g, c): sorted(f"e{x}" for x in range(6) if rng.random() < 0.4) for g in "xy" for c in range(10)}
    alike = spark.createDataFrame([(g, c, 1 + c % 3, e) for (g, c), e in sets.items()], "g string, c long, n long, events array<string>")
    jaccard = lambda a, b: len({*a} & {*b}) / max(1, len({*a} | {*b}))
    want = {g: sum((1 + a % 3) * (1 + b % 3) * jaccard(sets[g, a], sets[g, b]) for a in range(10) for b in range(a)) for g in "xy"}
    got = {r.g: r.s for r in G._similarity_within(alike).collect()}
    assert got.keys() == want.keys() and all(abs(got[g] - want[g]) < 1e-9 for g in want)


def test_clone_events_keep_no_table_of_cells(spark):
    """each cell's repeated events are passed over in order; distinct cells of all clones and events were hashed before."""
    rng = random.Random(8)
    cells = [f"c{i}" for i in range(40)]
    assigned = [(rng.choice([*cells, None]), rng.choice(["x", "y", "z", None])) for _ in range(90)]
    has = [(rng.choice([*cells, "other", None]), rng.choice(["chr1", "chr2", "chr3", None]), rng.randrange(2)) for _ in range(400)]
    want = {}
    for clone in "xyz":
        own = {c for c, k in assigned if k == clone and c}
        for chrom, start in {(x, y) for c, x, y in has if c in own}:
            want[clone, f"{chrom or ''}|{start}"] = len({c for c, x, y in has if (x, y) == (chrom, start)} & own) / len(own)
    out = G.clone_events(spark.createDataFrame(assigned, "cell_id string, clone_id string"), spark.createDataFrame(has, "cell_id string, chr string, start int"))
    assert {(r.clone_id, r.event): r.fraction_cells for r in out.collect()} == want
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "distinct cell_id" not in plan and not any("event" in x and "cell_id" in x for x in re.findall(r"HashAggregate\(keys=\[([^]]*)", plan))


def test_leaf_distances_shuffle_no_pairs(spark, monkeypatch):
    """tiles of leaves meet in a Cartesian product; before, every leaf was shuffled sixteen times for each ancestor."""
    monkeypatch.setattr(T, "TILE", 4)
    rng = random.Random(9)
    rows = [(g, f"n{k}", f"n{rng.randrange(max(0, k - 6), k)}" if k else None, rng.choice([0.0, 0.25, rng.random()])) for g in "xy" for k in range(45)]
    rows += [("one", "alone", None, 0.0)]
    up = {(g, n): (p, e) for g, n, p, e in rows}
    tree = T.number_nodes(spark.createDataFrame(rows, "tree_id string, node_id string, parent_id string, edge_length double")).localCheckpoint()

    def above(g, n):
        out = {}
        while n:
            out[n] = last[0] + last[1] if out else 0.0
            last = (out[n], up[g, n][1])
            n = up[g, n][0]
        return out

    leaves = [(r.tree_id, r.node_id) for r in tree.filter("is_leaf").collect()]
    want = {(g, a, b): min(x + above(g, b)[n] for n, x in above(g, a).items() if n in above(g, b)) for g, a in leaves for h, b in leaves if g == h}
    out = T.pairwise_distances(tree)
    got = out.collect()
    assert len(got) == len(want) and {tuple(r)[:3] for r in got} == want.keys()
    assert all(abs(r.dist - want[tuple(r)[:3]]) < 1e-9 for r in got)
    once = T.leaf_pairs(tree).collect()
    assert len(once) * 2 + len(leaves) == len(want) and all(r.a < r.b and abs(r.dist - want[r.tree_id, r.cell_a, r.cell_b]) < 1e-9 for r in once)
    assert "CartesianProduct" in out._jdf.queryExecution().executedPlan().toString()


def test_clusters_of_a_kind_merge_as_single_ones_do():
    """r04 F2: the same clusters as one pair at a time, also where distances tie and where a threshold stops within a kind."""
    rng = random.Random(1)
    for _ in range(60):
        inner = rng.randrange(1, 7)
        at = np.round(np.abs(np.subtract.outer(x := np.array([rng.choice([0, 0.02, 0.05, 0.1]) for _ in range(inner)]), x)), 9)
        leaves = [(rng.randrange(inner), rng.randrange(6) / 100) for _ in range(rng.randrange(2, 60))]
        ids = np.array(sorted(rng.sample(range(10**6), len(leaves))))
        square = lambda rows: np.array([[(a[1] + b[1] + at[a[0], b[0]]) ** 2 for b in rows] for a in rows])
        i, j = np.triu_indices(len(leaves), 1)
        threshold = rng.choice([0.04, 0.1, 0.2, 0.5])
        want = merge_clusters(ids[i], ids[j], square(leaves)[i, j], dict.fromkeys(ids.tolist(), 1), dict.fromkeys(ids.tolist(), 0), threshold, "ward")
        kinds = sorted(set(leaves))
        one = np.ones(len(kinds))
        got = merge_kinds(square(kinds), one, one * 0, [ids[[x == k for x in leaves]] for k in kinds], threshold, "ward")
        assert dict(zip(*map(np.ndarray.tolist, got), strict=True)) == want


def test_large_tree_of_few_lengths_needs_no_rounds(spark, monkeypatch):
    """r04 F2: leaves alike are merged as a kind; before, a round of jobs merged one pair below each parent."""
    rng = random.Random(5)
    rows = [("r", None, 0.0), *[(f"p{k}", "r" if k < 4 else "p1", rng.choice([0.05, 0.1])) for k in range(6)]]
    rows += [(f"leaf{k}", f"p{rng.randrange(6)}", rng.randrange(1, 4) / 100) for k in range(90)]
    tree = T.number_nodes(spark.createDataFrame([(g, *r) for g in "xy" for r in rows], "tree_id string, node_id string, parent_id string, edge_length double")).localCheckpoint()
    want = {t: _partition(G.assign_distance(tree.filter(F.col("tree_id") == "x"), t)) for t in (0.05, 0.15)}
    monkeypatch.setattr(G, "WHOLE_CLUSTERS", 30)
    monkeypatch.setattr(linkage, "TILE", 5)
    monkeypatch.setattr(G, "agglomerate_points", None)
    for t, clones in want.items():
        out = G.assign_distance(tree, t).localCheckpoint()
        assert 1 < len(clones) < 90 and all(_partition(out.filter(F.col("tree_id") == g)) == clones for g in "xy")


def _jaccard(a, b):
    return len(a & b) / max(1, len(a | b))


@pytest.mark.parametrize("most", [1, 3, 100])
def test_lists_of_near_clusters_merge_as_single_pairs_do(most):
    """r04 F3: the same clusters as one pair at a time, whatever the lists hold; what they don't tell waits for the next ones."""
    rng = random.Random(most)
    for _ in range(25):
        events, wide = rng.choice([(5, 1), (8, 1), (20, 1), (130, 3)])
        sets = list({frozenset(x for x in rng.sample(range(events), 5) if rng.random() < 0.7) for _ in range(rng.randrange(2, 60))})
        words = np.array([[sum(1 << x % 64 for x in s if x // 64 == w) for w in range(wide)] for s in sets], np.uint64)
        n, ids, threshold = np.array([rng.choice([1, 1, 2, 5]) for _ in sets]), np.array(sorted(rng.sample(range(10**6), len(sets)))), rng.choice([0.3, 0.5, 0.6, 0.8])
        i, j = np.triu_indices(len(sets), 1)
        s = [n[a] * n[b] * _jaccard(sets[a], sets[b]) for a, b in zip(i, j, strict=True)]
        want = merge_clusters(ids[i], ids[j], s, dict(zip(ids.tolist(), n.tolist(), strict=True)), dict.fromkeys(ids.tolist(), 0), threshold, "average")
        to, live = ids.copy(), np.arange(len(ids))
        while len(live):
            live = live[np.lexsort((ids[live], to[live]))]
            names, starts = np.unique(to[live], return_index=True)
            cut, many, found = zip(*(near_lists(words[live], n[live], starts, k, k + 1, 1 - threshold - 1e-9, most) for k in range(len(names))), strict=True)
            into, waits = merge_listed(words[live], n[live], starts, names, np.concatenate(cut), list(found), threshold)
            assert (into != names).any() or not waits.any()
            own = np.repeat(np.arange(len(names)), np.diff(np.append(starts, len(live))))
            to[live] = into[own]
            live = live[waits[own]]
        assert dict(zip(ids.tolist(), to.tolist(), strict=True)) == want


def test_large_groups_of_cells_take_few_rounds(spark, monkeypatch):
    """r04 F3, F5: near clusters are listed once for many merges; before, each round looked at all pairs again and shuffled all pairs of tiles."""
    rng = random.Random(7)
    cells = spark.createDataFrame([(g, f"{g}{k}", k) for g in "xy" for k in range(40)], "tree_id string, cell_id string, place long").localCheckpoint()
    events = spark.createDataFrame([(f"{g}{k}", f"chr{e}") for g in "xy" for k in range(40) for e in range(9) if rng.random() < 0.5], "cell_id string, chr string").localCheckpoint()
    run = lambda: {tuple(r) for r in G.assign_event_profile(cells, events, 0.55).collect()}
    want = run()
    clones = {r[:2] for r in want}
    assert 2 < len(clones) < 60
    monkeypatch.setattr(G, "WHOLE_CLUSTERS", 6)
    points = G.agglomerate_points
    monkeypatch.setattr(G, "agglomerate_points", None)
    monkeypatch.setattr(linkage, "RANGE", 7)
    assert run() == want
    monkeypatch.setattr(linkage, "LISTED", 80)
    assert run() == want
    monkeypatch.setattr(G, "agglomerate_points", points)
    monkeypatch.setattr(linkage, "SET_WORDS", 0)
    assert run() == want


def test_rounding_is_that_of_decimals(spark):
    """r04 F1, F4: a query's doubles are rounded without decimals, with the same result to the last bit and sign."""
    odd = [0.0, -0.0, -1e-7, 5e-7, -5e-7, 1.5e-6, 2.5e-6, 0.0015625, 1 / 3, float("nan"), float("inf"), float("-inf"), None, 1e9 + 0.1234565, 123456.7890125, 1e300, -1e-320, 99999999.9999995, 1e8]
    rng = random.Random(10)
    odd += [rng.randrange(10**7) / rng.randrange(1, 1300) for _ in range(2000)] + [(rng.randrange(10**9) + 0.5) / 1e6 for _ in range(2000)]
    df = spark.createDataFrame([(x,) for x in odd], "x double")
    plain = df.select(F.round("x", 6).cast("string"))
    quick = queries._rounded(df).select(F.col("x").cast("string"))
    assert [*map(tuple, quick.collect())] == [*map(tuple, plain.collect())]


def test_leaves_of_two_tiles_meet_without_python(spark, monkeypatch):
    """r04 F1: a pair of leaves is an expression; before, all pairs went through Python, which now makes those within a tile only."""
    monkeypatch.setattr(T, "TILE", 4)
    made = []
    within = T._tile_distances
    monkeypatch.setattr(T, "_tile_distances", lambda *a: made.append(within(*a)) or made[0])
    rows = [("t", f"n{k}", f"n{(k - 1) // 2}" if k else None, k / 8) for k in range(41)]
    tree = T.number_nodes(spark.createDataFrame(rows, "tree_id string, node_id string, parent_id string, edge_length double")).localCheckpoint()
    out = T.pairwise_distances(tree)
    assert out.count() == 21**2 and 0 < made[0].count() < 100
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Generate inline") == 2 and "Coalesce" in plan.split("Generate inline")[1]


def test_pairs_of_cells_leave_python_by_tiles(spark, monkeypatch):
    """r04 F4: a cell leaves Python once for a tile, and tiles meet in a Cartesian product; before, each pair did, and pairs of tiles were shuffled."""
    monkeypatch.setattr(linkage, "TILE", 5)
    rng = random.Random(11)
    has = {(g, f"c{i}"): {f"e{x}" for x in range(9 if g == "x" else 90) if rng.random() < 0.3} for g in "xy" for i in range(17)} | {("x", "none"): set(), ("x", "nil"): set(), ("z", "alone"): {"e1"}}
    profile = spark.createDataFrame([(g, c, e) for (g, c), s in has.items() for e in s or [None]], "tree_id string, cell_id string, event string")
    want = {(g, a, b): 1 - _jaccard(x, y) if x | y else 0.0 for (g, a), x in has.items() for (k, b), y in has.items() if g == k and a < b}
    out = G.jaccard_distances(profile)
    got = {tuple(r)[:3]: r.dist for r in out.collect()}
    assert out.count() == len(want) and got.keys() == want.keys() and all(abs(got[k] - v) < 1e-12 for k, v in want.items())
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "Generate posexplode" in plan and "CartesianProduct" in plan


def test_similarity_of_parts_shuffles_no_pair_of_tiles(spark):
    """r04 F5: a range of clusters meets its group's row of bits; before, each two tiles of a part were shuffled together."""
    alike = spark.createDataFrame([("x", c, 1, [f"e{c % 3}", f"f{c}"]) for c in range(20)], "g string, c long, n long, events array<string>")
    out = G._similarity_within(alike)
    want = sum(1 / 3 for a in range(20) for b in range(a) if a % 3 == b % 3)
    assert abs(out.first().s - want) < 1e-9
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" in plan and not re.search(r"hashpartitioning\([^)]*\blo\b[^)]*\bhi\b", plan)
