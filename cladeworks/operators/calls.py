"""Call tables: filters, joins with resources, allele normalisation."""

from __future__ import annotations

from collections.abc import Iterable, Iterator, Mapping

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.cigar import aligned_runs
from ..functions.columns import KEY
from ..functions.staging import staged

BROADCAST_KEYS = 1_000_000
PILEUP_TILE, PILEUP_BASES = 512, 4_000_000


def pass_filter(calls: DataFrame, pass_only: bool = True) -> DataFrame:
    """Records without a filter, or with ``PASS`` among theirs; all if switched off."""
    f = F.col("filters")
    return calls.filter(f.isNull() | f.isin(".", "") | F.array_contains(F.split(f, ";"), "PASS")) if pass_only else calls


def select_callers(calls: DataFrame, callers: str | Iterable[str]) -> DataFrame:
    """Records of the given callers: a list, or names with commas between."""
    names = [c.strip() for c in (callers.split(",") if isinstance(callers, str) else callers) if c.strip()]
    if not names:
        raise ValueError("no caller given")
    return calls.filter(F.col("caller").isin(names))


def threshold_alleles(counts: DataFrame, min_count: int = 3, min_fraction: float = 0.05) -> DataFrame:
    """Alternatives with ``min_count`` observations and ``min_fraction`` of the depth in the clone.

    ``counts``: ``clone_id, chrom, pos, ref, alt, n_alt``; the depth of a position is
    the sum over its alleles, that of the reference included.
    """
    depth = F.sum("n_alt").over(Window.partitionBy("clone_id", "chrom", "pos"))
    out = counts.withColumn("depth", depth).withColumn("fraction", F.col("n_alt") / F.col("depth"))
    return out.filter((F.col("alt") != F.col("ref")) & (F.col("n_alt") >= min_count) & (F.col("fraction") >= min_fraction))


def match_normals(clones: DataFrame, cells: DataFrame, normals: DataFrame) -> DataFrame:
    """The normal sample of each clone's patient; nulls for a clone without one (tumour only)."""
    patients = clones.join(cells.select("cell_id", "patient_id"), "cell_id").select("clone_id", "patient_id").distinct()
    normal = normals.select("patient_id", F.col("sample_id").alias("normal_id"), F.col("bam_path").alias("normal_bam"))
    return patients.join(normal, "patient_id", "left").select("clone_id", "patient_id", "normal_id", "normal_bam")


def _wanted(resource: DataFrame, calls: DataFrame) -> DataFrame:
    """Rows of a resource whose key is among the calls'.

    Resources are large and calls few: up to a checked number the calls' keys are
    broadcast, so that only rows that pass move on.
    """
    keys = staged(calls.select(*KEY).distinct())
    few = keys.limit(BROADCAST_KEYS + 1).count() <= BROADCAST_KEYS
    return resource.join(F.broadcast(keys), KEY, "left_semi") if few else resource


def drop_known(calls: DataFrame, panel: DataFrame) -> DataFrame:
    """Calls whose key isn't in a panel of normals."""
    return calls.join(_wanted(panel.select(*KEY), calls).distinct(), KEY, "left_anti")


def annotate_germline_af(calls: DataFrame, resource: DataFrame, default_af: float = 0.0000025) -> DataFrame:
    """Append ``germline_af``: the population frequency of the key, or the default."""
    af = _wanted(resource.select(*KEY, "af"), calls).groupBy(*KEY).agg(F.max("af").alias("germline_af"))
    return calls.join(af, KEY, "left").withColumn("germline_af", F.coalesce("germline_af", F.lit(default_af)))


def merge_callers(calls: DataFrame, callers: list[str]) -> DataFrame:
    """One row for each clone and key, with ``{caller}_qual`` and ``{caller}_filters``.

    Of records that repeat a key in a file the one with the best quality counts.
    """
    best = F.max_by(F.struct("qual", "filters"), F.struct(F.coalesce("qual", F.lit(-1.0)), "filters"))
    wide = calls.groupBy("clone_id", *KEY).pivot("caller", callers).agg(best)
    return wide.select("clone_id", *KEY, *[F.col(c)[f].alias(f"{c}_{f}") for c in callers for f in ("qual", "filters")])


def caller_stats(calls: DataFrame) -> DataFrame:
    """Per clone and caller: records, SNPs, indels, others, multi-allelic sites, transitions, transversions, their ratio."""
    many = F.contains("alt", F.lit(","))
    snp = (F.length("ref") == 1) & (F.length("alt") == 1) & (F.col("alt") != ".")
    indel = ~many & (F.length("ref") != F.length("alt")) & ~F.col("alt").isin("", ".")
    change = F.concat("ref", "alt")
    ts = snp & change.isin("AG", "GA", "CT", "TC")
    out = calls.groupBy("clone_id", "caller").agg(
        F.count("*").alias("records"), F.count_if(snp).alias("snps"), F.count_if(indel).alias("indels"), F.count_if(~snp & ~indel & ~many).alias("others"),
        F.count_if(many).alias("multiallelic"), F.count_if(ts).alias("transitions"), F.count_if(snp & ~ts).alias("transversions"),
    )
    return out.withColumn("ts_tv", F.when(F.col("transversions") > 0, F.col("transitions") / F.col("transversions")))


def concat_calls(first: DataFrame, second: DataFrame) -> DataFrame:
    """All records of two call sets in the order of their positions; overlaps stay."""
    return first.unionByName(second, allowMissingColumns=True).orderBy(*KEY)


def union_callers(tables: Mapping[str, DataFrame]) -> DataFrame:
    """One call table of the outputs of several callers, each row with its caller."""
    out = None
    for caller, calls in tables.items():
        tagged = calls.withColumn("caller", F.lit(caller))
        out = tagged if out is None else out.unionByName(tagged, allowMissingColumns=True)
    if out is None:
        raise ValueError("no caller given")
    return out


def split_multiallelic(calls: DataFrame) -> DataFrame:
    """One row for each alternative, with its place ``alt_index`` from 1."""
    return calls.select(*[c for c in calls.columns if c != "alt"], F.posexplode(F.split("alt", ",")).alias("alt_index", "alt")).withColumn("alt_index", F.col("alt_index") + 1)


def trim_alleles(calls: DataFrame) -> DataFrame:
    """Shortest alleles: what both end with goes, then what both begin with; a base stays in each."""
    common = lambda a, b: F.aggregate(
        F.sequence(F.lit(1), F.greatest(F.lit(1), F.least(F.length(a), F.length(b)) - 1)),
        F.lit(0), lambda n, i: F.when((n == i - 1) & (F.least(F.length(a), F.length(b)) > i) & (F.substring(a, F.lit(1), i) == F.substring(b, F.lit(1), i)), i).otherwise(n),
    )
    out = calls.withColumn("_s", common(F.reverse("ref"), F.reverse("alt")))
    for c in ("ref", "alt"):
        out = out.withColumn(c, F.substring(F.col(c), F.lit(1), F.length(c) - F.col("_s")))
    out = out.withColumn("_p", common(F.col("ref"), F.col("alt")))
    out = out.withColumn("pos", F.col("pos") + F.col("_p"))
    for c in ("ref", "alt"):
        out = out.withColumn(c, F.expr(f"substring({c}, _p + 1)"))
    return out.drop("_s", "_p")


def pileup_counts(reads: DataFrame, reference: DataFrame, chunk: int) -> DataFrame:
    """Bases seen at each position of a clone: ``clone_id, chrom, pos, ref, alt, n_alt, depth``.

    ``reads``: ``clone_id, chrom, start`` (from 0), ``cigar, seq, flag``; unmapped,
    secondary, failed and duplicate reads are left out. ``reference`` as in
    :func:`~cladeworks.operators.alignment.left_align`; rows where ``alt`` is ``ref`` give the reference count. A task adds
    up its bases by place and hands on one row for each tile; bases are never rows before they are counted.
    """
    used = reads.filter("(flag & 1796) = 0").select("clone_id", "chrom", "start", "seq", F.explode(aligned_runs(F.col("cigar"))).alias("r"))
    # A run of aligned bases is a stretch of the reference and one of the read, base by base.
    used = used.select("clone_id", "chrom", (F.col("start") + F.col("r.at")).alias("first"), F.expr("substring(seq, r.i + 1, r.n)").alias("bases")).filter("bases <> '' AND first IS NOT NULL")
    parts = used.mapInArrow(_count_bases, f"clone_id {reads.schema['clone_id'].dataType.simpleString()}, chrom string, tile long, seen array<struct<pos:long,alt:string,n:long>>")
    tile = ["clone_id", "chrom", "tile"]
    counts = parts.repartition(*tile).select(*tile, F.explode("seen").alias("x")).groupBy(*tile, "x.pos", "x.alt").agg(F.sum("x.n").alias("n_alt"))
    counts = counts.withColumn("depth", F.sum("n_alt").over(Window.partitionBy(*tile, "pos")))
    counts = counts.withColumn("chunk_index", F.floor((F.col("pos") - 1) / chunk).cast("long")).join(reference, ["chrom", "chunk_index"], "left")
    ref = F.expr(f"substring(sequence, cast((pos - 1) % {chunk} as int) + 1, 1)")
    return counts.withColumn("ref", ref).select("clone_id", "chrom", "pos", "ref", "alt", "n_alt", "depth")


#: Bits of a place on a chromosome and the value that stands for place 0; a clone's chromosomes have the bits above.
_PLACE, _ZERO, _PAIRS = 40, 1 << 39, 1 << 14


def _count_bases(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Counts of each base at each place, added up in a task and cut at tiles: ``clone_id, chrom, tile, seen``.

    A base is one number (pair of clone and chromosome, place, letter); numbers are
    sorted and counted :data:`PILEUP_BASES` at a time, and their counts kept while
    there are at most as many different ones.
    """
    pairs: dict[tuple, int] = {}
    codes, counts = np.zeros(0, np.int64), np.zeros(0, np.int64)
    waiting: list[np.ndarray] = []
    size, kind = 0, pa.string()

    def added():
        """The counts held, with those that wait."""
        new, n = np.unique(np.concatenate(waiting), return_counts=True)
        both, sums = np.concatenate([codes, new]), np.concatenate([counts, n])
        order = np.argsort(both, kind="stable")
        both, sums = both[order], sums[order]
        first = np.flatnonzero(np.r_[True, both[1:] != both[:-1]])
        return both[first], np.add.reduceat(sums, first)

    def tiles():
        pos = (codes >> 8 & (1 << _PLACE) - 1) - _ZERO + 1
        pair, tile = codes >> 8 + _PLACE, (pos - 1) // PILEUP_TILE
        starts = np.flatnonzero(np.r_[True, (pair[1:] != pair[:-1]) | (tile[1:] != tile[:-1])])
        letters = pa.array([chr(i) for i in range(256)]).take(pa.array(codes & 255))
        seen = pa.StructArray.from_arrays([pa.array(pos), letters, pa.array(counts)], ["pos", "alt", "n"])
        seen = pa.ListArray.from_arrays(pa.array(np.r_[starts, len(codes)].astype(np.int32)), seen)
        at = pa.array(pair[starts])
        names = [pa.array([p[i] for p in pairs], t).take(at) for i, t in ((0, kind), (1, pa.string()))]
        rows = pa.RecordBatch.from_arrays([*names, pa.array(tile[starts]), seen], ["clone_id", "chrom", "tile", "seen"])
        for k in range(0, len(starts), 512):
            yield rows.slice(k, 512)

    for batch in batches:
        if not batch.num_rows:
            continue
        clone, chrom, first, bases = (batch.column(i) for i in range(4))
        kind = clone.type
        # Null clones and chromosomes are keys as well.
        (c, cs), (h, hs) = ((x.fill_null(-1).to_numpy() + 1, [None, *y.to_pylist()]) for x, y in ((d.indices, d.dictionary) for d in (clone.dictionary_encode(), chrom.dictionary_encode())))
        different, own = np.unique(c.astype(np.int64) * len(hs) + h, return_inverse=True)
        named = np.array([pairs.setdefault((cs[k // len(hs)], hs[k % len(hs)]), len(pairs)) for k in different.tolist()], np.int64)
        raw = [x.encode("latin-1", "replace") for x in bases.to_pylist()]
        n = np.fromiter(map(len, raw), np.int64, len(raw))
        begin = (named[own] << _PLACE) + first.to_numpy() + _ZERO - (np.cumsum(n) - n)
        waiting.append((np.repeat(begin, n) + np.arange(n.sum())) << 8 | np.frombuffer(b"".join(raw), np.uint8))
        size += int(n.sum())
        if size > PILEUP_BASES or len(pairs) > _PAIRS:
            codes, counts = added()
            waiting.clear()
            size = 0
            if len(codes) > PILEUP_BASES or len(pairs) > _PAIRS:
                yield from tiles()
                pairs.clear()
                codes, counts = codes[:0], counts[:0]
    if waiting:
        codes, counts = added()
    if len(codes):
        yield from tiles()
