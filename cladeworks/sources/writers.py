"""Sinks (S6-S10): tables, per-clone files, VCF, reports, trees."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.columns import KEY

#: Places in preorder whose text is put together at a time.
PIECE = 4096
#: A name with one of these is quoted.
QUOTED = r"[\s(),:;'\[\]]"
# Header lines of a VCF of consensus calls.
VCF_HEADER = [
    "##fileformat=VCFv4.2",
    '##INFO=<ID=N_CLONES,Number=1,Type=Integer,Description="Clones with the variant">',
    '##INFO=<ID=CALLERS,Number=.,Type=String,Description="Callers with the variant">',
    '##FILTER=<ID=PASS,Description="All filters passed">',
    "#CHROM\tPOS\tID\tREF\tALT\tQUAL\tFILTER\tINFO",
]


def write_per_clone(df: DataFrame, path: str, files_per_clone: int = 16, max_records: int = 5_000_000) -> None:
    """A folder of tab-separated files for each clone; a large clone is dealt to several writers."""
    salt = F.pmod(F.xxhash64(*[c for c in df.columns if c != "clone_id"]), F.lit(files_per_clone))
    df.repartition("clone_id", salt).write.partitionBy("clone_id").option("header", True).option("sep", "\t").option("maxRecordsPerFile", max_records).csv(path)


def write_table(df: DataFrame, path: str, fmt: str = "csv") -> None:
    """A result table as CSV with a header, or as Parquet."""
    if fmt not in ("csv", "parquet"):
        raise ValueError("fmt is 'csv' or 'parquet'")
    (df.write.option("header", True).csv if fmt == "csv" else df.write.parquet)(path)


def vcf_lines(info: DataFrame) -> DataFrame:
    """VCF text of consensus keys with ``n_clones, callers``, with the place that sorts it after the header."""
    text = F.concat_ws("\t", "chrom", F.col("pos").cast("string"), F.lit("."), "ref", "alt", F.lit("."), F.lit("PASS"), F.concat(F.lit("N_CLONES="), F.col("n_clones").cast("string"), F.lit(";CALLERS="), "callers"))
    body = info.select(F.lit(1).alias("part"), F.lit(0).alias("line"), *KEY, text.alias("value"))
    head = info.sparkSession.createDataFrame([(0, i, "", 0, "", "", x) for i, x in enumerate(VCF_HEADER)], "part int, line int, chrom string, pos long, ref string, alt string, value string")
    return head.unionByName(body)


def write_vcf(info: DataFrame, path: str) -> None:
    """Consensus as gzip VCF text in order of the keys; the header comes first in the first file.

    A range sort deals the rows out, so files read in the order of their names are one VCF.
    """
    vcf_lines(info).orderBy("part", "line", *KEY).select("value").write.option("compression", "gzip").text(path)


def write_report(report: DataFrame, path: str) -> None:
    """A one-row report as JSON."""
    report.coalesce(1).write.json(path)


def to_newick(nodes: DataFrame, labels: DataFrame | None = None) -> DataFrame:
    """Newick text of each tree: ``tree_id, newick``.

    With ``labels`` (``tree_id, node_id, label``) internal nodes are named by their
    clones; leaves keep their ids. Each node gives its opening and its closing text;
    they are put together by pieces of the preorder, then by tree.
    """
    rows = nodes.withColumn("label", F.col("node_id"))
    if labels is not None:
        named = labels.select("tree_id", "node_id", F.col("label").alias("clones"))
        rows = rows.join(named, ["tree_id", "node_id"], "left").withColumn("label", F.when(F.col("is_leaf"), F.col("node_id")).otherwise(F.coalesce("clones", F.lit(""))))
    above = nodes.select("tree_id", F.col("node_id").alias("parent_id"), F.col("pre").alias("above"))
    rows = rows.join(above, ["tree_id", "parent_id"], "left")
    quoted = F.when(F.col("label").rlike(QUOTED), F.concat(F.lit("'"), F.replace("label", F.lit("'"), F.lit("''")), F.lit("'"))).otherwise(F.coalesce("label", F.lit("")))
    length = F.when(F.col("above").isNotNull(), F.concat(F.lit(":"), F.coalesce("edge_length", F.lit(0.0)).cast("string"))).otherwise("")
    name, leaf = F.concat(quoted, length), F.col("pre") == F.col("last")
    comma = F.when(F.col("pre") > F.col("above") + 1, ",").otherwise("")
    # A node opens at its own place and closes behind the last one below it, the deepest first.
    opens = F.struct(F.col("pre").alias("at"), F.lit(0).cast("long").alias("order"), F.concat(comma, F.when(leaf, name).otherwise("(")).alias("text"))
    closes = F.struct(F.col("last").alias("at"), (F.lit(1) + F.col("last") - F.col("pre")).alias("order"), F.concat(F.lit(")"), name).alias("text"))
    pieces = rows.select("tree_id", F.explode(F.array_compact(F.array(opens, F.when(~leaf, closes)))).alias("x"))
    joined = lambda c: F.array_join(F.transform(F.sort_array(F.collect_list(c)), lambda x: x["text"]), "")
    parts = pieces.groupBy("tree_id", F.floor(F.col("x.at") / PIECE).alias("piece")).agg(joined("x").alias("text"))
    return parts.groupBy("tree_id").agg(F.concat(joined(F.struct("piece", "text")), F.lit(";")).alias("newick"))
