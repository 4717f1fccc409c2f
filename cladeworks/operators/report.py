"""Tables of the final report (Q1-Q3, L4)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .pseudobulk import library_sizes

# Rows that a report shows.
CLONE_ROWS, TEXT_ROWS, HTML_ROWS = 50, 20, 30


def run_overview(summary: DataFrame, consensus: DataFrame, keys: DataFrame, status: str = "ok") -> DataFrame:
    """One row: clones, assigned cells, consensus variants, unique positions, validation status."""
    clones = summary.agg(F.count("*").alias("n_clones"), F.coalesce(F.sum("n_cells"), F.lit(0)).alias("n_assigned_cells"))
    return clones.crossJoin(consensus.agg(F.count("*").alias("n_consensus"))).crossJoin(keys.agg(F.count("*").alias("n_unique_positions"))).withColumn("status", F.lit(status))


def sharing_counts(sharing: DataFrame) -> DataFrame:
    """Keys of each sharing class, the most frequent class first."""
    return sharing.groupBy("sharing_class").agg(F.count("*").alias("n")).orderBy(F.desc("n"), "sharing_class")


def qc_table(flags: DataFrame, duplicates: DataFrame, coverage: DataFrame, calls: DataFrame) -> DataFrame:
    """One row for each clone with what flag counts, duplicates, coverage and calls say."""
    out = flags.groupBy("clone_id").agg(F.sum("total").alias("total"), F.sum("mapped").alias("mapped"))
    out = out.join(duplicates.select("clone_id", "dup_rate"), "clone_id", "full").join(coverage.select("clone_id", "mean_depth"), "clone_id", "full")
    called = calls.groupBy("clone_id").agg(F.sum("records").alias("records"), F.sum("snps").alias("snps"))
    return out.join(called, "clone_id", "full")


def qc_details(flags: DataFrame, duplicates: DataFrame, coverage: DataFrame, headline: DataFrame, calls: DataFrame) -> DataFrame:
    """All that the report shows of a clone: reads, pairs, duplicates, library size, depths, records by kind.

    ``coverage``: ``clone_id, mean_depth``; ``headline``: median depth and percentages of
    the genome at 1, 5, 10 and 30 or more. Rates of calls are those of all callers' records.
    """
    reads = flags.groupBy("clone_id").agg(*(F.sum(c).alias(c) for c in ("total", "mapped", "paired", "properly_paired")))
    share = lambda a, b: F.when(F.col(b) > 0, F.round(100 * F.col(a) / F.col(b), 2))
    reads = reads.withColumns({"mapped_pct": share("mapped", "total"), "properly_paired_pct": share("properly_paired", "paired")}).drop("paired", "properly_paired")
    kinds = ("records", "snps", "indels", "multiallelic", "transitions", "transversions")
    called = calls.groupBy("clone_id").agg(*(F.sum(c).alias(c) for c in kinds))
    called = called.withColumn("ts_tv", F.when(F.col("transversions") > 0, F.col("transitions") / F.col("transversions"))).drop("transitions", "transversions")
    out = reads.join(duplicates.select("clone_id", "dup_rate"), "clone_id", "full").join(library_sizes(duplicates), "clone_id", "full")
    for part in (coverage.select("clone_id", "mean_depth"), headline, called):
        out = out.join(part, "clone_id", "full")
    return out


def preview(df: DataFrame, n: int, *order: str) -> DataFrame:
    """The first ``n`` rows in order, each with the number of rows that aren't shown."""
    more = df.agg(F.greatest(F.count("*") - n, F.lit(0)).alias("n_more"))
    return df.orderBy(*order).limit(n).crossJoin(F.broadcast(more))
