"""Column expressions on events and variant calls."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

KEY = ["chrom", "pos", "ref", "alt"]
# Columns that make an event key, and the chromosomes with a standard name.
EVENT_KEY_COLUMNS = ["chr", "chrom", "chromosome", "start", "end", "event_type"]
STANDARD_CHROMOSOMES = [*map(str, range(1, 23)), "X", "Y"]


def event_key(columns: list[str]) -> Column:
    """Key of an event: its location columns that exist, joined by ``|``; else the first three that aren't the id."""
    parts = [c for c in EVENT_KEY_COLUMNS if c in columns] or [c for c in columns if c != "cell_id"][:3]
    return F.concat_ws("|", *[F.coalesce(F.col(c).cast("string"), F.lit("")) for c in parts])


def with_variant_key(calls: DataFrame) -> DataFrame:
    """``alt`` of records without an alternative (``.``) becomes the empty string."""
    return calls.withColumn("alt", F.when(F.col("alt") == ".", "").otherwise(F.coalesce("alt", F.lit(""))))


def normalize_chrom(chrom: Column, target: str = "chr") -> Column:
    """Chromosome names in ``chr1`` style (``target="chr"``) or ``1`` style (``"plain"``)."""
    if target not in ("chr", "plain"):
        raise ValueError("target is 'chr' or 'plain'")
    if target == "plain":
        return F.when(chrom == "chrM", "MT").otherwise(F.regexp_replace(chrom, "^[chr]+", ""))
    return F.when(chrom.isin("M", "MT"), "chrM").when(chrom.isin(STANDARD_CHROMOSOMES) | ~chrom.startswith("chr"), F.concat(F.lit("chr"), chrom)).otherwise(chrom)


def extract_info(calls: DataFrame, fields: list[str]) -> DataFrame:
    """INFO fields as columns: text, ``true`` for flags, null where absent."""
    flags = F.transform(F.split(F.coalesce("info", F.lit("")), ";"), lambda x: F.when(F.contains(x, F.lit("=")), x).otherwise(F.concat(x, F.lit("=true"))))
    pairs = F.map_from_entries(F.array_distinct(F.transform(F.filter(flags, lambda x: x != "=true"), lambda x: F.struct(F.substring_index(x, "=", 1).alias("k"), F.regexp_replace(x, "^[^=]*=", "").alias("v")))))
    return calls.withColumn("_i", pairs).select("*", *[F.col("_i")[f].alias(f) for f in fields]).drop("_i")


def clone_and_caller(path: Column) -> tuple[Column, Column]:
    """Clone and caller from a file name ``{clone}.{caller}.norm.vcf.gz``: the caller is the last dotted part.

    Both are null for a name with fewer than two parts.
    """
    stem = F.regexp_replace(F.regexp_extract(path, r"([^/]*)$", 1), r"(?:\.norm)?\.vcf(?:\.gz)?$", "")
    both = F.contains(stem, F.lit("."))
    return F.when(both, F.regexp_extract(stem, r"^(.*)\.[^.]*$", 1)), F.when(both, F.regexp_extract(stem, r"\.([^.]*)$", 1))
