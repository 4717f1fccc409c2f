"""Rows that overlap intervals.

Intervals are ``chrom, start, end`` (from 0, end not included). They meet rows by bins of
the chromosome: each interval is in the bin of its start, and each bin knows the farthest
end of all intervals that start in earlier bins. So a row only looks at the bin of its
own last base, and comes out once at most, however many intervals it overlaps.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

BIN = 16_384


def _bin(column):
    return F.floor(column / BIN)


def overlapping(rows: DataFrame, bed: DataFrame, start: str = "start", end: str = "end") -> DataFrame:
    """Rows whose span from ``start`` (from 0) up to ``end`` shares a base with an interval.

    Spans and intervals without a base overlap nothing; nulls don't either. Rows that
    come twice stay twice.
    """
    bed = bed.select("chrom", "start", "end").filter("end > start")
    by_bin = bed.groupBy("chrom", _bin(F.col("start")).alias("_bin")).agg(F.max("end").alias("far"))
    ends = bed.groupBy("chrom").agg(F.min("start").alias("first"), F.max("end").alias("_last"))
    every = ends.select("chrom", F.explode(F.sequence(_bin(F.col("first")), _bin(F.col("_last") - 1))).alias("_bin"))
    before = Window.partitionBy("chrom").orderBy("_bin").rowsBetween(Window.unboundedPreceding, -1)
    carried = every.join(by_bin, ["chrom", "_bin"], "left").withColumn("far", F.max("far").over(before)).filter("far IS NOT NULL")
    # What starts earlier starts before every row of the bin ends.
    pieces = bed.select("chrom", _bin(F.col("start")).alias("_bin"), "start", "end").union(carried.select("chrom", "_bin", (F.col("_bin") * BIN - 1).alias("start"), "far"))
    pieces = pieces.withColumnsRenamed({"start": "_from", "end": "_to"})
    found = rows.join(ends.select("chrom", "_last"), "chrom").withColumn("_end", F.least(F.col(end), F.col("_last"))).filter(F.col("_end") > F.col(start))
    found = found.withColumn("_bin", _bin(F.col("_end") - 1)).alias("r")
    pieces = pieces.alias("i")
    same = (F.col("r.chrom") == F.col("i.chrom")) & (F.col("r._bin") == F.col("i._bin"))
    met = found.join(pieces, same & (F.col("i._from") < F.col("r._end")) & (F.col("i._to") > F.col(f"r.{start}")), "left_semi")
    return met.select(*rows.columns)


def restrict_to_intervals(rows: DataFrame, bed: DataFrame, pos: str = "pos", until: str | None = None) -> DataFrame:
    """Rows in an interval: those whose position ``pos`` (from 1) lies in one, or, given ``until``, that overlap one with any base from ``pos`` (from 0) on."""
    if until is not None:
        return overlapping(rows, bed, pos, until)
    spans = rows.withColumns({"_a": F.col(pos) - 1, "_b": F.col(pos)})
    return overlapping(spans, bed, "_a", "_b").select(*rows.columns)
