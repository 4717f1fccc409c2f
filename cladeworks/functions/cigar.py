"""CIGAR strings (H5; SAM format, Li et al. 2009)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

def aligned_runs(cigar: Column) -> Column:
    """Runs of aligned bases as ``array<struct<at, i, n>>``: offset on the reference, place in the read, length."""
    number, kind = (F.regexp_extract_all(cigar, F.lit(r"(\d+)([MIDNSHP=X])"), F.lit(g)) for g in (1, 2))
    steps = F.arrays_zip(F.transform(number, lambda x: x.cast("int")).alias("n"), kind.alias("op"))
    start = F.struct(F.lit(0).alias("at"), F.lit(0).alias("i"), F.expr("cast(array() as array<struct<at:int,i:int,n:int>>)").alias("out"))

    def step(state, x):
        n, op = x["n"], x["op"]
        both = op.isin("M", "=", "X")
        return F.struct(
            (state["at"] + F.when(both | op.isin("D", "N"), n).otherwise(0)).alias("at"), (state["i"] + F.when(both | op.isin("I", "S"), n).otherwise(0)).alias("i"),
            F.when(both, F.concat(state["out"], F.array(F.struct(state["at"].alias("at"), state["i"].alias("i"), n.alias("n"))))).otherwise(state["out"]).alias("out"),
        )

    plain = _plain(cigar).cast("int")
    return F.when(plain.isNotNull(), F.array(F.struct(F.lit(0).alias("at"), F.lit(0).alias("i"), plain.alias("n")))).otherwise(F.aggregate(steps, start, step, lambda s: s["out"]))


def _sum(cigar: Column, pattern: str) -> Column:
    parts = F.regexp_extract_all(cigar, F.lit(pattern), F.lit(1))
    return F.aggregate(F.coalesce(parts, F.array().cast("array<string>")), F.lit(0).cast("long"), lambda a, x: a + x.cast("long"))


def _plain(cigar: Column) -> Column:
    """Length of an alignment without clips, gaps or breaks (``75M``), null for others; no regular expression."""
    return F.when(F.right(cigar, F.lit(1)) == "M", F.substring(cigar, F.lit(1), F.length(cigar) - 1).try_cast("long"))


def reference_length(cigar: Column) -> Column:
    """Bases of the reference that an alignment covers."""
    return F.coalesce(_plain(cigar), _sum(cigar, r"(\d+)[MDN=X]"))


def _clips(cigar: Column, soft: str, hard: str) -> Column:
    found = [F.coalesce(F.regexp_extract(cigar, p, 1).try_cast("long"), F.lit(0)) for p in (soft, hard)]
    return F.when(F.contains(cigar, F.lit("S")) | F.contains(cigar, F.lit("H")), found[0] + found[1]).otherwise(F.lit(0).cast("long"))


def leading_clip(cigar: Column) -> Column:
    """Bases clipped at the front."""
    return _clips(cigar, r"^(?:\d+H)?(\d+)S", r"^(\d+)H")


def trailing_clip(cigar: Column) -> Column:
    """Bases clipped at the end."""
    return _clips(cigar, r"(\d+)S(?:\d+H)?$", r"(\d+)H$")


def five_prime(start: Column, cigar: Column, reverse: Column) -> Column:
    """Unclipped 5' position of a read."""
    return F.when(reverse, start + reference_length(cigar) + trailing_clip(cigar) - 1).otherwise(start - leading_clip(cigar))
