"""Checks of manifests, metadata, events and trees."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.staging import staged

# Required columns, names that stand for others, and labels of tips that are no cells.
REQUIRED = {
    "bam": {"cell_id", "bam_path", "sample_id", "patient_id"},
    "cells": {"cell_id"},
    "normals": {"sample_id", "patient_id", "bam_path"},
    "events": {"cell_id", "chr", "start", "end", "event_type"},
}
EVENT_SYNONYMS = {
    "chr": ["chrom", "chromosome", "seqnames"],
    "cell_id": ["cell", "cellid", "sample"],
    "copy_number": ["cn", "copynumber", "state"],
    "event_type": ["type", "event"],
}
CELL_SYNONYMS = ["cell", "cellid", "sample", "barcode"]
NOT_CELLS = ["diploid", "normal", "root", "reference"]
SHOWN = 10


def check_required_columns(df: DataFrame, kind: str) -> None:
    """Raise ``ValueError`` naming missing (sorted) and found columns; runs no job."""
    if kind not in REQUIRED:
        raise ValueError(f"kind is one of {', '.join(REQUIRED)}")
    if missing := sorted(REQUIRED[kind] - set(df.columns)):
        raise ValueError(f"{kind}: missing columns {missing}; found {df.columns}")


def standardize_events(df: DataFrame) -> DataFrame:
    """Lower-case column names, and the first known synonym of each standard name that isn't there."""
    names: dict[str, str] = {c: c.lower() for c in df.columns}
    taken = set(names.values())
    for target, synonyms in EVENT_SYNONYMS.items():
        found = next((s for s in synonyms if s in taken), None)
        if target not in taken and found:
            names = {c: target if n == found else n for c, n in names.items()}
            taken.add(target)
    return df.withColumnsRenamed(names)


def standardize_cells(df: DataFrame, sample_id: str) -> DataFrame:
    """``cell_id`` from ``cellname``, itself, or the first synonym; sample and patient default to ``sample_id``."""
    source = next((c for c in ["cellname", "cell_id", *CELL_SYNONYMS] if c in df.columns), None)
    if source is None:
        raise ValueError(f"no cell column among {df.columns}")
    out = df.withColumn("cell_id", F.col(source).cast("string"))
    return out.withColumns({c: F.lit(sample_id) for c in ("sample_id", "patient_id") if c not in df.columns})


def manifest_from_tree(nodes: DataFrame, bam_dir: str, sample_id: str) -> DataFrame:
    """Manifest rows of a tree's tips, but for those that are no cells."""
    tips = nodes.filter("is_leaf").filter(~F.lower("node_id").isin(NOT_CELLS)).select(F.col("node_id").alias("cell_id"))
    bam = F.concat(F.lit(bam_dir.rstrip("/") + "/"), "cell_id", F.lit(".bam"))
    return tips.select("cell_id", bam.alias("bam_path"), F.concat(bam, F.lit(".bai")).alias("bai_path"), F.lit(sample_id).alias("sample_id"), F.lit(sample_id).alias("patient_id"))


def infer_index(cells: DataFrame) -> DataFrame:
    """A missing or empty ``bai_path`` becomes ``{bam_path}.bai``."""
    given = F.col("bai_path") if "bai_path" in cells.columns else F.lit(None).cast("string")
    return cells.withColumn("bai_path", F.coalesce(F.nullif(given, F.lit("")), F.concat("bam_path", F.lit(".bai"))))


def flatten_events(df: DataFrame) -> DataFrame:
    """Event rows of nested lists: ``cell_id, chr, start, end, h0, h1``.

    ``df``: ``cell_id, events: array<struct<...>>``; where ``h0`` or ``h1`` isn't a
    field it is null; entries without ``chr`` go.
    """
    fields = df.schema["events"].dataType.elementType.fieldNames()
    rows = df.select("cell_id", F.explode("events").alias("e"))
    pick = [(F.col(f"e.{c}") if c in fields else F.lit(None).cast("int")).alias(c) for c in ("chr", "start", "end", "h0", "h1")]
    return rows.select("cell_id", *pick).filter("chr IS NOT NULL")


def find_duplicate_cells(df: DataFrame) -> DataFrame:
    """Cell ids found more than once, with how often."""
    return df.groupBy("cell_id").agg(F.count("*").alias("n")).filter("n > 1")


def event_stats(events: DataFrame) -> DataFrame:
    """One row: events and the cells that have them."""
    return events.agg(F.count("*").alias("n_events"), F.countDistinct("cell_id").alias("n_cells"))


def tree_stats(nodes: DataFrame) -> DataFrame:
    """Leaves and nodes of each tree, and whether it has the two leaves it needs."""
    out = nodes.groupBy("tree_id").agg(F.count_if("is_leaf").alias("n_leaves"), F.count("*").alias("n_nodes"))
    return out.withColumn("ok", F.col("n_leaves") >= 2)


def cross_validate(cells: DataFrame, meta: DataFrame, nodes: DataFrame) -> DataFrame:
    """One row on how the ids of manifest, metadata and tree agree; not ``ok`` below half of the manifest."""
    ids = lambda df, name: df.select(F.col("cell_id").cast("string").alias("cell_id")).distinct().withColumn(name, F.lit(True))
    both = ids(cells, "b").join(ids(meta, "m"), "cell_id", "full")
    b, m = F.col("b").isNotNull(), F.col("m").isNotNull()
    out = both.agg(
        F.count_if(b).alias("n_bam_cells"), F.count_if(m).alias("n_meta_cells"), F.count_if(b & m).alias("n_overlap"),
        F.count_if(b & ~m).alias("n_in_bam_not_meta"), F.count_if(m & ~b).alias("n_in_meta_not_bam"),
    )
    share = 100 * F.col("n_overlap") / F.greatest("n_bam_cells", F.lit(1))
    leaf = nodes.agg(F.count_if("is_leaf").alias("n_tree_leaves"))
    return out.withColumns({"pct_overlap": F.round(share, 2), "ok": share >= 50}).crossJoin(leaf)


def usable_cells(nodes: DataFrame, cells: DataFrame) -> DataFrame:
    """Leaves that are in the manifest, in tree order, and whether their tree has two or more (``enough``)."""
    rows = nodes.filter("is_leaf").join(cells.select(F.col("cell_id").cast("string").alias("node_id")).distinct(), "node_id", "left_semi")
    n = F.count("*").over(Window.partitionBy("tree_id"))
    return rows.select("tree_id", F.col("node_id").alias("cell_id"), "pre", (n >= 2).alias("enough"))


def check_paths(cells: DataFrame, listing: DataFrame) -> DataFrame:
    """Paths with a fault: ``cell_id, path, level, problem``.

    ``listing``: ``path, length``. Missing or empty alignments are errors, a missing
    index is a warning; an index beside the file, ``x.bai`` for ``x.bam``, will do.
    """
    listed = listing.select("path", "length")
    bam = cells.select("cell_id", F.col("bam_path").alias("path")).join(listed, "path", "left")
    bad = bam.filter("length IS NULL OR length = 0").select("cell_id", "path", F.lit("error").alias("level"), F.when(F.col("length").isNull(), "missing").otherwise("empty").alias("problem"))
    index = infer_index(cells).select("cell_id", F.col("bai_path").alias("path"), F.regexp_replace("bam_path", r"\.bam$", ".bai").alias("beside"))
    lost = index.join(listed.select("path"), "path", "left_anti").join(listed.select(F.col("path").alias("beside")), "beside", "left_anti")
    return bad.union(lost.select("cell_id", "path", F.lit("warning"), F.lit("missing index")))


def dedupe_cells(df: DataFrame, order: Sequence[str] | str) -> DataFrame:
    """The first row of each cell by an explicit order."""
    first = Window.partitionBy("cell_id").orderBy(*([order] if isinstance(order, str) else order))
    return df.withColumn("_r", F.row_number().over(first)).filter("_r = 1").drop("_r")


def compare_ids(left: DataFrame, right: DataFrame) -> DataFrame:
    """Distinct cell ids and where they are: ``both``, ``left`` or ``right``."""
    a, b = left.select("cell_id").distinct().withColumn("a", F.lit(1)), right.select("cell_id").distinct().withColumn("b", F.lit(1))
    side = F.when(F.col("a").isNull(), "right").when(F.col("b").isNull(), "left").otherwise("both")
    return a.join(b, "cell_id", "full").select("cell_id", side.alias("side"))


def validate_inputs(cells: DataFrame, meta: DataFrame, nodes: DataFrame, events: DataFrame | None = None, listing: DataFrame | None = None) -> DataFrame:
    """One report row of all checks: ``status, errors, warnings`` and counts.

    Every check runs before the verdict; messages begin with the input they are about,
    and of many faults the first ten are shown.
    """
    for df, kind in ((cells, "bam"), (meta, "cells"), (events, "events")):
        if df is not None:
            check_required_columns(df, kind)

    def shown(df: DataFrame, item: str, text: str, level: str) -> DataFrame:
        first = df.select(F.col(item).alias("x")).distinct().orderBy("x").limit(SHOWN)
        row = first.agg(F.array_join(F.sort_array(F.collect_list("x")), ", ").alias("x"), F.count("*").alias("n"))
        return row.filter("n > 0").select(F.lit(level).alias("level"), F.concat(F.lit(text), "x").alias("message"))

    # Each check is evaluated once, and its few rows are written for all that looks at them.
    cross, trees = staged(cross_validate(cells, meta, nodes)), staged(tree_stats(nodes))
    found = [
        shown(find_duplicate_cells(cells), "cell_id", "BAM manifest: duplicate cell_id ", "error"),
        shown(find_duplicate_cells(meta), "cell_id", "cell metadata: duplicate cell_id ", "error"),
        shown(trees.filter("NOT ok"), "tree_id", "tree: fewer than 2 leaves in ", "error"),
        cross.filter("NOT ok").select(F.lit("error").alias("level"), F.concat(F.lit("cross-check: cells in metadata, percent: "), F.col("pct_overlap").cast("string")).alias("message")),
        cross.filter("n_in_bam_not_meta > 0").select(F.lit("warning"), F.concat(F.lit("cross-check: cells without metadata: "), F.col("n_in_bam_not_meta").cast("string"))),
        cross.filter("n_in_meta_not_bam > 0").select(F.lit("warning"), F.concat(F.lit("cross-check: cells without alignments: "), F.col("n_in_meta_not_bam").cast("string"))),
    ]
    if listing is not None:
        faults = staged(check_paths(cells, listing))
        found += [shown(faults.filter(F.col("level") == x), "path", f"BAM manifest: {t} ", x) for x, t in (("error", "missing or empty"), ("warning", "no index"))]
    messages = found[0]
    for f in found[1:]:
        messages = messages.union(f)
    of = lambda level: F.sort_array(F.collect_list(F.when(F.col("level") == level, F.col("message"))))
    report = messages.agg(of("error").alias("errors"), of("warning").alias("warnings"))
    report = report.withColumn("status", F.when(F.size("errors") > 0, "failed").otherwise("ok"))
    report = report.crossJoin(cross.select("n_bam_cells", "n_meta_cells", "n_overlap", "pct_overlap", "n_tree_leaves")).crossJoin(trees.agg(F.sum("n_nodes").alias("n_tree_nodes")))
    return report if events is None else report.crossJoin(event_stats(events).withColumnRenamed("n_cells", "n_event_cells"))
