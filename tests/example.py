"""The 12-cell example: its tree, its events, and values worked out from them."""

# The example's tree and events.
NEWICK = (
    "((((CELL_001:0.05,CELL_002:0.05)node_A:0.20,(CELL_003:0.08,CELL_004:0.07)node_B:0.18)node_C:0.30,CELL_005:0.50)node_D:0.15,"
    "((CELL_006:0.12,CELL_007:0.10)node_E:0.25,(CELL_008:0.08)node_F:0.20)node_G:0.35,"
    "(((CELL_009:0.06,CELL_010:0.06)node_H:0.15,(CELL_011:0.09,CELL_012:0.08)node_I:0.18)node_J:0.28)node_K:0.40)root;"
)
#: Event and the cells that have it.
EVENTS = {
    ("chr1", 10000000, 50000000, "gain"): range(1, 13),
    ("chr5", 20000000, 80000000, "gain"): [1],
    ("chr7", 30000000, 60000000, "loss"): [3, 4],
    ("chr3", 5000000, 30000000, "gain"): [6, 7, 8],
    ("chr9", 10000000, 90000000, "gain"): [6, 7],
    ("chr11", 40000000, 80000000, "loss"): [11, 12],
}


def cell(i: int) -> str:
    return f"CELL_{i:03d}"


def nodes(spark):
    from cladeworks.functions.newick import parse_newick
    from cladeworks.sources.readers import NODES

    names = [f.split()[0] for f in NODES.split(", ")]
    return spark.createDataFrame([tuple({"tree_id": "t", **n}[k] for k in names) for n in parse_newick(NEWICK)], NODES)


def events(spark):
    rows = [(cell(i), *key) for key, cells in EVENTS.items() for i in cells]
    return spark.createDataFrame(rows, "cell_id string, chr string, start long, end long, event_type string")


def cells(spark):
    return spark.createDataFrame([(cell(i),) for i in range(1, 13)], "cell_id string")


def partition(df) -> set:
    """Clones as sets of cell numbers."""
    out: dict = {}
    for r in df.collect():
        out.setdefault(r.clone_id, set()).add(int(r.cell_id[-3:]))
    return {frozenset(v) for v in out.values()}
