"""Sources (S1-S5): manifests, events, trees, variant calls, alignments."""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.cigar import reference_length
from ..functions.columns import clone_and_caller
from ..functions.newick import newick_parts
from ..operators.validate import check_required_columns, infer_index

NODES = "tree_id string, node_id string, parent_id string, is_leaf boolean, edge_length double, pre long, last long, depth long, root_dist double"
_ARROW = pa.schema(
    [(c, pa.string()) for c in ("tree_id", "node_id", "parent_id")] + [("is_leaf", pa.bool_()), ("edge_length", pa.float64())]
    + [(c, pa.int64()) for c in ("pre", "last", "depth")] + [("root_dist", pa.float64())]
)
# The mandatory columns of SAM lines, and columns whose types are known.
SAM = ["qname", "flag", "rname", "pos", "mapq", "cigar", "rnext", "pnext", "tlen", "seq", "qual"]
TYPES = {"start": "long", "end": "long", "copy_number": "int", "is_unique": "boolean", "is_recent": "boolean", "ploidy": "double", "alpha": "double", "rpc": "int", "pass_qc": "boolean"}


def _csv(spark: SparkSession, path: str, sep: str) -> DataFrame:
    """All columns as text, without a second pass over the file; known ones get their types."""
    df = spark.read.option("header", True).option("sep", sep).csv(path)
    return df.withColumns({c: F.col(c).try_cast(t) for c, t in TYPES.items() if c in df.columns})


def read_manifest(spark: SparkSession, path: str, kind: str) -> DataFrame:
    """A manifest CSV (``bam``, ``cells`` or ``normals``); extra columns stay, missing index paths are inferred."""
    df = _csv(spark, path, ",")
    check_required_columns(df, kind)
    return infer_index(df) if kind == "bam" else df


def read_events(spark: SparkSession, path: str) -> DataFrame:
    """Copy-number events: tabs between columns if the name ends in ``.tsv``, else commas."""
    df = _csv(spark, path, "\t" if path.rstrip("/").endswith(".tsv") else ",")
    check_required_columns(df, "events")
    return df


def parse_trees(texts: DataFrame) -> DataFrame:
    """Node table of Newick texts: ``tree_id, value``, one tree a row."""

    def run(batches):
        for batch in batches:
            for tree, text in zip(*(batch.column(i) for i in (0, 1)), strict=True):
                for part in newick_parts(text.as_py()):
                    columns = [[tree.as_py()] * len(part[0]), *part]
                    yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, _ARROW, strict=True)], schema=_ARROW)

    return texts.select("tree_id", "value").mapInArrow(run, NODES)


def read_newick(spark: SparkSession, path: str) -> DataFrame:
    """Node table of Newick files, one tree a file; ``tree_id`` is the file's name without its ending."""
    name = F.regexp_extract(F.col("_metadata.file_path"), r"([^/]*?)(?:\.[^./]*)?$", 1)
    return parse_trees(spark.read.text(path, wholetext=True).select(name.alias("tree_id"), "value"))


def parse_vcf_lines(lines: DataFrame) -> DataFrame:
    """``chrom, pos, ref, alt, qual, filters, info`` of VCF text in ``value``, other columns kept."""
    f = F.split("value", "\t")
    rest = [c for c in lines.columns if c != "value"]
    at = lambda i: F.get(f, F.lit(i))
    body = lines.filter(~F.col("value").startswith("#") & (F.length("value") > 0))
    return body.select(*rest, at(0).alias("chrom"), at(1).cast("long").alias("pos"), at(3).alias("ref"), F.when(at(4) == ".", "").otherwise(at(4)).alias("alt"), at(5).try_cast("double").alias("qual"), at(6).alias("filters"), at(7).alias("info"))


def read_vcf(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    """Calls of VCF text files, plain or gzip, with clone and caller from the file name.

    Files are ``{clone}.{caller}.norm.vcf.gz``; others have no clone and are left out.
    """
    clone, caller = clone_and_caller(F.col("_metadata.file_path"))
    lines = spark.read.text(paths).select("value", clone.alias("clone_id"), caller.alias("caller")).filter("clone_id IS NOT NULL")
    return parse_vcf_lines(lines)


def vcf_files(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    """``clone_id, caller`` of each file, also of files without a call."""
    clone, caller = clone_and_caller(F.col("_metadata.file_path"))
    return spark.read.text(paths).select(clone.alias("clone_id"), caller.alias("caller")).filter("clone_id IS NOT NULL").distinct()


def read_reads(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    """Alignments as a table: Parquet as it is, else SAM text, one cell a file (its name up to the first dot)."""
    if all(p.rstrip("/").endswith(".parquet") for p in ([paths] if isinstance(paths, str) else paths)):
        return spark.read.parquet(*([paths] if isinstance(paths, str) else paths))
    f = F.split("value", "\t")
    cell = F.regexp_extract(F.col("_metadata.file_path"), r"([^/.]*)[^/]*$", 1)
    lines = spark.read.text(paths).select("value", cell.alias("cell_id")).filter(~F.col("value").startswith("@") & (F.size(f) >= len(SAM)))
    r = {c: F.get(f, F.lit(i)) for i, c in enumerate(SAM)}
    quality = F.aggregate(F.transform(F.split(r["qual"], "(?<=.)(?=.)"), lambda c: F.ascii(c) - 33), F.lit(0), lambda a, x: a + x)
    return lines.select(
        "cell_id", r["qname"].alias("read_id"), r["rname"].alias("chrom"), (r["pos"].cast("long") - 1).alias("start"), r["cigar"].alias("cigar"), r["mapq"].cast("long").alias("mapq"),
        r["flag"].cast("int").alias("flag"), F.when(r["rnext"] == "=", r["rname"]).otherwise(r["rnext"]).alias("mate_chrom"), (r["pnext"].cast("long") - 1).alias("mate_start"),
        r["seq"].alias("seq"), quality.cast("long").alias("base_quality"),
    ).withColumn("end", F.col("start") + reference_length(F.col("cigar")))

