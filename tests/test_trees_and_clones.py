import random

import numpy as np
import pytest
from example import NEWICK, cell, cells, events, nodes, partition

from cladeworks.functions.linkage import merge_smallest, tie
from cladeworks.functions.newick import format_newick, parse_newick
from cladeworks.operators import clones as G
from cladeworks.operators import tree as T
from cladeworks.operators import validate as V
from cladeworks.operators.linkage import BLOCKS, agglomerate, agglomerate_blocks


def sets(*groups):
    return {frozenset(g) for g in groups}


def test_newick_round_trip_and_labels():
    rows = parse_newick(NEWICK)
    assert len(rows) == 24 and sum(r["is_leaf"] for r in rows) == 12
    text = format_newick([{**r, "label": r["node_id"]} for r in rows])
    assert [(r["node_id"], r["parent_id"], r["edge_length"]) for r in parse_newick(text)] == [(r["node_id"], r["parent_id"], r["edge_length"]) for r in rows]
    odd = parse_newick("[note](('a b':1e-2,c_d),(,e)f:2,)g;")
    assert [r["node_id"] for r in odd] == ["g", "internal_1", "a b", "c_d", "f", "leaf_1", "e", "leaf_2"]
    assert parse_newick("A;")[0]["is_leaf"]
    with pytest.raises(ValueError):
        parse_newick("((a,b);")
    deep = "(" * 3000 + "x" + ")" * 3000 + ";"
    assert len(parse_newick(deep)) == 3001


def test_nodes_are_numbered_from_parents(spark):
    """A tree of any shape, a ladder, and one node; then what is no tree."""
    rnd = random.Random(4)
    trees = {"one": [("x", None, 0.5)], "ladder": [(f"n{i}", f"n{i - 1}" if i else "", 1.0) for i in range(3000)]}
    trees["any"] = [(f"m{i}", f"m{rnd.randrange(i)}" if i else None, rnd.randrange(9) / 8 if i % 5 else None) for i in range(400)]
    want = {}
    for t, rows in trees.items():
        kids = {}
        for node, up, _ in rows:
            kids.setdefault(up or None, []).append(node)
        length = {node: x or 0.0 for node, _, x in rows}
        stack, pre = [(kids[None][0], 0, length[kids[None][0]], None)], 0
        order = []
        while stack:
            node, depth, far, up = stack.pop()
            order.append((node, up, depth, far))
            stack += [(k, depth + 1, far + length[k], node) for k in sorted(kids.get(node, []), reverse=True)]
        size = dict.fromkeys(length, 1)
        for node, up, _, _ in reversed(order):
            if up:
                size[up] += size[node]
        for pre, (node, up, depth, far) in enumerate(order):
            want[t, node] = (up, size[node] == 1, pre, pre + size[node] - 1, depth, far)
    df = spark.createDataFrame([(t, *r, 7) for t, rows in trees.items() for r in rows], "tree_id string, node_id string, parent_id string, edge_length double, num int")
    got = {(r.tree_id, r.node_id): (r.parent_id, r.is_leaf, r.pre, r.last, r.depth, r.root_dist) for r in T.number_nodes(df).collect()}
    assert got == want
    assert T.number_nodes(df.limit(0)).count() == 0
    for bad in ([("a", None), ("b", None)], [("a", None), ("b", "z")], [("a", None), ("b", "a"), ("b", "a")], [("r", None), ("a", "b"), ("b", "a")]):
        with pytest.raises(ValueError):
            T.number_nodes(spark.createDataFrame([("t", *r, 1.0) for r in bad], "tree_id string, node_id string, parent_id string, edge_length double"))


def test_threshold_and_boundaries(spark):
    n = nodes(spark)
    assert T.cut_threshold(n).first().threshold == pytest.approx(0.3195442, abs=1e-6)
    assert T.cut_threshold(n, 0.1).first().threshold == 0.1
    assert {r.node_id for r in T.select_boundary_nodes(n, 2).collect()} == {"node_G", "node_K"}


def test_distances(spark):
    n = nodes(spark)
    d = {(r.cell_a, r.cell_b): r.dist for r in T.pairwise_distances(n).collect()}
    assert len(d) == 144
    for (a, b), x in {(1, 2): 0.10, (1, 3): 0.51, (1, 5): 1.05, (1, 6): 1.42, (9, 11): 0.48}.items():
        assert d[cell(a), cell(b)] == pytest.approx(x) and d[cell(b), cell(a)] == pytest.approx(x)
    m = np.array([[d[cell(i), cell(j)] for j in range(1, 13)] for i in range(1, 13)])
    for i, j, k, l in [random.Random(1).sample(range(12), 4) for _ in range(50)]:  # four-point condition
        s = sorted([m[i, j] + m[k, l], m[i, k] + m[j, l], m[i, l] + m[j, k]])
        assert s[1] == pytest.approx(s[2])


def test_cut_into_clones(spark):
    n = nodes(spark)
    named = T.cut_into_clones(n, 2)
    assert {r.clone_id: set() for r in named.collect()}.keys() == {"clade_1", "clade_2", "clade_3"}
    assert partition(named.filter("clone_id = 'clade_1'")) == sets([9, 10, 11, 12])
    assert partition(named.filter("clone_id = 'clade_2'")) == sets([6, 7, 8])
    assert partition(T.cut_into_clones(n, 2, 0.1)) == sets([11, 12], [9, 10], [6, 7, 8], [1, 2], [3, 4, 5])
    assert partition(T.cut_into_clones(n, 5)) == sets(range(1, 13))


def test_cut_at_nodes_and_labels(spark):
    n = nodes(spark)
    cut = T.cut_at_nodes(n, ["node_D", "node_C", "node_K", "nobody"])
    assert partition(cut) == sets([1, 2, 3, 4], [5], [9, 10, 11, 12], [6, 7, 8])
    assert T.mrca(n, spark.createDataFrame([(cell(1),), (cell(3),), ("x",)], "id string")).first().mrca == "node_C"
    assert T.mrca(n, spark.createDataFrame([("x",)], "id string")).first().mrca is None


def test_strategies(spark):
    n, c, e = nodes(spark), cells(spark), events(spark)
    by = G.assign_clones("internal_node", n, c, min_cells=2)
    names = {r.cell_id: r.clone_id for r in by.collect()}
    assert names[cell(9)] == "clone_001" and names[cell(6)] == "clone_002" and names[cell(1)] == "clone_003"
    pairs = [[1, 2], [3, 4], [5], [6, 7], [8], [9, 10], [11, 12]]
    assert partition(G.assign_clones("distance", n, c, distance_threshold=0.3, min_cells=1)) == sets(*pairs)
    merged = G.assign_clones("distance", n, c, distance_threshold=0.3, min_cells=2, small="merge")
    assert partition(merged) == sets([1, 2, 5, 8], [3, 4], [6, 7], [9, 10], [11, 12])
    assert partition(G.assign_clones("distance", n, c, distance_threshold=1.0, min_cells=1)) == sets([1, 2, 3, 4], [5], [6, 7, 8], [9, 10, 11, 12])
    assert partition(G.assign_clones("event_profile", n, c, e, similarity=0.6, min_cells=1)) == sets([1], [2, 5, 9, 10], [3, 4], [6, 7, 8], [11, 12])
    assert partition(G.assign_clones("hybrid", n, c, e, similarity=0.5, min_cells=2)) == sets([9, 10, 11, 12], [6, 7, 8], [1, 2, 3, 4, 5])
    for bad in ({"strategy": "x"}, {"strategy": "distance"}, {"strategy": "hybrid"}):
        with pytest.raises(ValueError):
            G.assign_clones(nodes=n, cells=c, **bad)


def test_clone_descriptions(spark):
    a = G.assign_clones("internal_node", nodes(spark), cells(spark), min_cells=2)
    got = {(r.clone_id, r.event.split("|")[0]): round(r.fraction_cells, 4) for r in G.clone_events(a, events(spark)).collect()}
    assert got == {
        ("clone_003", "chr1"): 1.0, ("clone_003", "chr7"): 0.4, ("clone_003", "chr5"): 0.2, ("clone_002", "chr1"): 1.0, ("clone_002", "chr3"): 1.0,
        ("clone_002", "chr9"): 0.6667, ("clone_001", "chr1"): 1.0, ("clone_001", "chr11"): 0.5,
    }
    rows = [(r.clone_id, r.n_cells, r.n_defining_events) for r in G.clone_summary(a, events(spark)).collect()]
    assert rows == [("clone_003", 5, 1), ("clone_001", 4, 2), ("clone_002", 3, 3)]


def naive(dist, threshold, method, ids=range(100)):
    """Recomputes every distance of clusters from their members; of equal ones the smallest tie merges first."""
    clusters = [[i] for i in range(len(dist))]

    def far(a, b):
        if method == "average":
            return np.mean([dist[i, j] for i in a for j in b])
        within = lambda s: sum(dist[i, j] ** 2 for i in s for j in s) / (2 * len(s))
        return np.sqrt(max(0, 2 * (within(a + b) - within(a) - within(b))))

    while len(clusters) > 1:
        d, _, i, j = min((round(far(a, b), 9), tie(ids[a[0]], ids[b[0]]), i, j) for i, a in enumerate(clusters) for j, b in enumerate(clusters) if i < j)
        if d > threshold:
            break
        clusters[i] = clusters[i] + clusters.pop(j)
    return sets(*clusters)


@pytest.mark.parametrize("method", ["average", "ward"])
@pytest.mark.parametrize("finish", [0, 8])
def test_linkage_against_a_naive_loop(spark, method, finish):
    """Groups of points, half of them on a grid where most distances are equal; by rounds alone, and with the last merges in one task."""
    rng = np.random.default_rng(3)
    want, pairs, members = {}, [], []
    for g in range(8):
        x = rng.normal(size=(14, 3)) if g % 2 else rng.integers(0, 3, size=(14, 2))
        d = np.round(np.sqrt(((x[:, None] - x[None]) ** 2).sum(-1)), 12)
        d = d / d.max() if method == "average" else d
        want[f"g{g}"] = naive(d, 0.45 if method == "average" else 1.5, method)
        members += [(f"g{g}", i) for i in range(14)]
        pairs += [(f"g{g}", i, j, 1, 1, 0.0, 0.0, float(1 - d[i, j] if method == "average" else d[i, j] ** 2)) for i in range(14) for j in range(i + 1, 14)]
    pairs = spark.createDataFrame(pairs, "g string, a long, b long, na long, nb long, pa double, pb double, s double")
    members = spark.createDataFrame([(g, i, i) for g, i in members], "g string, c long, i long")
    got: dict = {}
    for r in agglomerate(pairs, members, 0.45 if method == "average" else 1.5, method, finish).collect():
        got.setdefault(r.g, {}).setdefault(r.c, []).append(r.i)
    assert {g: sets(*v.values()) for g, v in got.items()} == want
    assert all(c == min(v) for x in got.values() for c, v in x.items())


@pytest.mark.parametrize("method", ["average", "ward"])
def test_linkage_of_blocks_against_a_naive_loop(spark, method):
    """The same groups, their pairs in blocks of five clusters; and clusters of several cells."""
    rng = np.random.default_rng(6)
    want, blocks, members = {}, [], []
    for g in range(6):
        x = rng.normal(size=(14, 3)) if g % 2 else rng.integers(0, 3, size=(14, 2))
        d = np.round(np.sqrt(((x[:, None] - x[None]) ** 2).sum(-1)), 12)
        d = d / d.max() if method == "average" else d
        want[f"g{g}"] = naive(d, 0.45 if method == "average" else 1.5, method)
        members += [(f"g{g}", i, i) for i in range(14)]
        s = (1 - d if method == "average" else d**2) * (1 - np.eye(14))
        for lo in range(3):
            for hi in range(lo, 3):
                a, b = (list(range(k * 5, min(14, k * 5 + 5))) for k in (lo, hi))
                blocks.append((f"g{g}", lo, hi, a, b, [1] * len(a), [1] * len(b), bytearray(s[np.ix_(a, b)].tobytes())))
    got: dict = {}
    found = agglomerate_blocks(spark.createDataFrame(blocks, BLOCKS), spark.createDataFrame(members, "g string, c long, i long"), 0.45 if method == "average" else 1.5, method)
    for r in found.collect():
        got.setdefault(r.g, {}).setdefault(r.c, []).append(r.i)
    assert {g: sets(*v.values()) for g, v in got.items()} == want
    assert all(c == min(v) for x in got.values() for c, v in x.items())


def test_distances_by_blocks(spark, monkeypatch):
    """Blocks of few places hold what the pairs have."""
    monkeypatch.setattr(T, "BLOCK", 5)
    n = nodes(spark)
    want = {(r.a, r.b): r.dist for r in T.leaf_pairs(n).collect()}
    got = {}
    for r in T.distance_blocks(n).collect():
        m = np.frombuffer(r.sums).reshape(len(r.a), len(r.b))
        got |= {(min(a, b), max(a, b)): m[i, j] ** 0.5 for i, a in enumerate(r.a) for j, b in enumerate(r.b) if a != b}
    assert got.keys() == want.keys() and all(got[k] == pytest.approx(v) for k, v in want.items())


def test_large_groups_go_by_rounds(spark, monkeypatch):
    """Beyond the size of one task the pairs' way gives the same clones."""
    calls = lambda: [partition(G.assign_clones(s, nodes(spark), cells(spark), events(spark), distance_threshold=0.8, min_cells=1)) for s in ("distance", "event_profile")]
    whole = calls()
    monkeypatch.setattr(G, "WHOLE_CLUSTERS", 3)
    assert calls() == whole


def test_event_clusters_against_a_naive_loop(spark):
    """Cells with few events, none, or equal ones; the profile strategy and the parts that hybrid splits."""
    rng = random.Random(5)
    n = nodes(spark)
    place = [r.pre for r in n.filter("is_leaf").orderBy("pre").collect()]
    for _ in range(2):
        has = {i: {e for e in range(4) if rng.random() < 0.4} for i in range(1, 13)}
        e = spark.createDataFrame([(cell(i), f"chr{x}", 1, 2, "gain") for i, s in has.items() for x in s], "cell_id string, chr string, start long, end long, event_type string")
        d = np.array([[1 - len(has[i] & has[j]) / len(has[i] | has[j]) if has[i] | has[j] else 0.0 for j in has] for i in has])
        got = partition(G.assign_clones("event_profile", n, cells(spark), e, similarity=0.6, min_cells=1))
        assert got == {frozenset(i + 1 for i in s) for s in naive(d, 0.4, "average", place)}
        mean = {}
        for part in ([1, 2, 3, 4, 5], [6, 7, 8], [9, 10, 11, 12]):
            own = d[np.ix_([i - 1 for i in part], [i - 1 for i in part])]
            mean[tuple(part)] = [part] if 1 - own.mean() >= 0.6 else [[part[i] for i in s] for s in naive(own, 0.4, "average", [place[i - 1] for i in part])]
        assert partition(G.assign_clones("hybrid", n, cells(spark), e, similarity=0.6, min_cells=2)) == sets(*[s for v in mean.values() for s in v])
    none = e.limit(0)
    assert partition(G.assign_clones("event_profile", n, cells(spark), none, min_cells=1)) == sets(range(1, 13))
    assert partition(G.assign_clones("event_profile", n, cells(spark), events(spark), similarity=0.0, min_cells=1)) == sets(range(1, 13))


def test_deep_tree(spark):
    """A ladder of 1,500 levels: positions, leaves below and cuts, over several tiles."""
    depth = 1500
    rows, total = [("t", "n0", None, False, 0.0, 0, 2 * depth, 0, 0.0)], 2 * depth
    for i in range(depth):
        rows.append(("t", f"l{i}", f"n{i}", True, 1.0, 2 * i + 1, 2 * i + 1, i + 1, i + 1.0))
        leaf = i == depth - 1
        rows.append(("t", f"n{i + 1}", f"n{i}", leaf, 1.0, 2 * i + 2, 2 * i + 2 if leaf else total, i + 1, i + 1.0))
    n = spark.createDataFrame(rows, "tree_id string, node_id string, parent_id string, is_leaf boolean, edge_length double, pre long, last long, depth long, root_dist double")
    y = {r.node_id: r.y for r in T.node_positions(n).collect()}
    want = {f"n{depth}": float(depth)}
    for i in range(depth - 1, -1, -1):
        want[f"l{i}"], want[f"n{i}"] = float(i), (i + want[f"n{i + 1}"]) / 2
    assert len(y) == len(want) and all(y[k] == pytest.approx(v, abs=1e-6) for k, v in want.items())
    assert T.clade_leaves(n).filter("node_id = 'n700'").count() == depth - 700 + 1
    cut = T.cut_at_nodes(n, ["n100", "n1200"])
    assert {r.clone_id: r["count"] for r in cut.groupBy("clone_id").count().collect()} == {"unassigned": 100, "n100": 1100, "n1200": 301}


def test_small_helpers():
    assert merge_smallest([("a", 1), ("b", 1), ("c", 5)], 2) == {"a": "b", "b": "b", "c": "c"}


def test_validation_report(spark):
    c = cells(spark).selectExpr("cell_id", "concat('/', cell_id, '.bam') AS bam_path", "'s' AS sample_id", "'p' AS patient_id")
    row = V.validate_inputs(c, cells(spark), nodes(spark), events(spark)).first()
    assert (row.status, row.n_bam_cells, row.n_overlap, row.pct_overlap, row.n_tree_leaves, row.n_tree_nodes, row.n_events, row.n_event_cells) == ("ok", 12, 12, 100.0, 12, 24, 22, 12)
    worse = V.validate_inputs(c.union(c.limit(1)), cells(spark).limit(3), nodes(spark).filter("node_id = 'root'")).first()
    assert worse.status == "failed" and len(worse.errors) == 3
    with pytest.raises(ValueError, match="sample_id"):
        V.check_required_columns(c.drop("sample_id"), "bam")
    with pytest.raises(ValueError):
        V.check_required_columns(c, "nothing")
