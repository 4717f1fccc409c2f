"""Clone pseudobulks from reads: cell QC, merge and sort, duplicates, flags, coverage.

``reads``: ``cell_id, read_id, chrom, start`` (from 0), ``end, cigar, mapq, flag,
mate_chrom, mate_start, base_quality`` and, after the merge, ``clone_id``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.cigar import five_prime
from ..functions.staging import staged

# Bits of the SAM flag.
PAIRED, PROPER, UNMAPPED, MATE_UNMAPPED, REVERSE, MATE_REVERSE, READ1, READ2, SECONDARY, QC_FAIL, DUPLICATE, SUPPLEMENTARY = (1 << i for i in range(12))
SKIPPED = UNMAPPED | SECONDARY | QC_FAIL | DUPLICATE
TILE = 500
BROADCAST_CELLS = 1_000_000
BROADCAST_GROUPS = 500_000  # 20 MB


def _bit(mask: int) -> Column:
    return F.col("flag").bitwiseAND(mask) != 0


def filter_cells(cells: DataFrame, assignments: DataFrame, min_confidence: float = 0.0) -> DataFrame:
    """Manifest rows of assigned cells with their clone, from a confidence on."""
    rows = cells.join(assignments.select("cell_id", "clone_id", "confidence", "flagged"), "cell_id")
    return rows.filter(F.col("confidence") >= min_confidence)


def filter_cells_by_metrics(cells: DataFrame, metrics: DataFrame, min_mapped_reads: int = 100_000, max_dup_rate: float = 0.95) -> DataFrame:
    """Cells whose metrics (``cell_id, mapped_reads, dup_rate``) are good enough; cells without metrics go."""
    good = metrics.filter((F.col("mapped_reads") >= min_mapped_reads) & (F.col("dup_rate") <= max_dup_rate))
    return cells.join(good.select("cell_id"), "cell_id", "left_semi")


def cell_qc_summary(cells: DataFrame, assignments: DataFrame, min_confidence: float = 0.0) -> DataFrame:
    """Cells of each clone after the filter, and their share of all cells before it in percent."""
    total = filter_cells(cells, assignments, float("-inf")).agg(F.count("*").alias("n_start"))
    per = filter_cells(cells, assignments, min_confidence).groupBy("clone_id").agg(F.count("*").alias("n_cells"))
    return per.crossJoin(F.broadcast(total)).select("clone_id", "n_cells", F.round(F.col("n_cells") / F.col("n_start") * 100, 2).alias("pct_passed"))


def low_cell_clones(summary: DataFrame, least: int = 5) -> DataFrame:
    """Clones of fewer than ``least`` cells."""
    return summary.filter(F.col("n_cells") < least)


def group_cells(cells: DataFrame) -> DataFrame:
    """Cells and paths of each clone as a list ordered by cell."""
    return cells.groupBy("clone_id").agg(F.sort_array(F.collect_list(F.struct("cell_id", "bam_path"))).alias("cells"))


def build_pseudobulk(reads: DataFrame, assignments: DataFrame, sort: bool = True, partitions: int | None = None) -> DataFrame:
    """Reads of assigned cells with their clone; ``sort``ed by clone and coordinate over a range of partitions.

    Cells are many fewer than reads: their table is broadcast while its checked size
    allows, so that reads only move for the sort.
    """
    cells = assignments.select("cell_id", "clone_id")
    few = cells.limit(BROADCAST_CELLS + 1).count() <= BROADCAST_CELLS
    merged = reads.drop("clone_id").join(F.broadcast(cells) if few else cells, "cell_id")
    if not sort:
        return merged
    order = ["clone_id", "chrom", "start", "read_id"]
    ranged = merged.repartitionByRange(partitions, *order) if partitions else merged.repartitionByRange(*order)
    return ranged.sortWithinPartitions(*order)


def _grid(reads: DataFrame, rows: DataFrame) -> DataFrame:
    """Each clone of ``reads`` with each of ``rows``: the clones are broadcast while their checked number allows."""
    clones = staged(reads.select("clone_id").distinct())
    few = clones.limit(BROADCAST_CELLS + 1).count() <= BROADCAST_CELLS
    return rows.crossJoin(F.broadcast(clones) if few else clones)


def mark_duplicates(reads: DataFrame, across_cells: bool = False, enabled: bool = True) -> DataFrame:
    """Set the duplicate bit on all but the best read of each group; no read is removed.

    A group shares clone, cell (unless ``across_cells``), chromosome, unclipped 5'
    position, strand and the mate's position and strand, nulls being equal; the largest
    sum of base qualities is best, ties go to the smaller ``read_id``, then to a hash of
    the row; of equal rows one is kept. Unmapped, secondary and supplementary reads are
    left as they are.
    Groups of several reads are broadcast up to a checked number, so that reads needn't move.
    """
    if not enabled:
        return reads
    # Written once: keys are dear where alignments have clips and gaps, and all that follows reads only the columns it needs.
    rows = staged(_grouped(reads, across_cells))
    groups = rows.filter("_a IS NOT NULL").groupBy("_a", "_b").agg(F.count("*").alias("_n"), F.max(_quality()).alias("_top")).filter("_n > 1")
    hint = _few(groups := staged(groups.select("_a", "_b", "_top")))
    # Of the reads of the best quality the first by id and a hash of all columns stays; equal rows are told apart by their number.
    hashed = rows.withColumn("_h", F.xxhash64(*reads.columns))
    tied = hashed.join(hint(groups), ["_a", "_b"]).filter(_quality() == F.col("_top"))
    equal = tied.groupBy("_a", "_b", "read_id", "_h").agg(F.count("*").alias("_c"))
    pick = F.struct("_c", F.col("read_id").alias("_id"), "_h")
    best = staged(equal.groupBy("_a", "_b").agg(F.min_by(pick, F.struct("read_id", "_h")).alias("_best")))
    marked = F.col("flag").bitwiseOR(DUPLICATE)
    stays = F.col("read_id").eqNullSafe(F.col("_best._id")) & (F.col("_h") == F.col("_best._h"))
    flag = F.when(F.col("_best").isNotNull() & ~stays, marked).otherwise(F.col("flag"))
    out = hashed.join(hint(best), ["_a", "_b"], "left")
    out = out.filter(F.col("_best").isNull() | ~stays | (F.col("_best._c") == 1)).withColumn("flag", flag).select(reads.columns)
    several = staged(best.filter("_best._c > 1"))
    copies = hashed.join(_few(several)(several), ["_a", "_b"]).filter(stays).groupBy("_a", "_b").agg(F.first(F.struct(*reads.columns)).alias("_row"), F.count("*").alias("_c"))
    copies = copies.select("_row.*", F.posexplode(F.sequence(F.lit(1).cast("long"), F.col("_c"))).alias("_i", "_k"))
    return out.unionByName(copies.withColumn("flag", F.when(F.col("_i") > 0, marked).otherwise(F.col("flag"))).select(reads.columns))


def _quality() -> Column:
    return F.coalesce(F.col("base_quality").cast("double"), F.lit(float("-inf")))


def _few(rows: DataFrame):
    """Broadcasts ``rows`` while their checked number allows."""
    few = rows.limit(BROADCAST_GROUPS + 1).count() <= BROADCAST_GROUPS
    return F.broadcast if few else lambda df: df


def _grouped(reads: DataFrame, across_cells: bool) -> DataFrame:
    """Reads with their group of possible duplicates as 128 bits, ``_a`` and ``_b``; null for reads that take no part.

    Only numbers are added up, within tasks first, so that a pile of reads is a row for each of them.
    """
    takes = F.col("flag").bitwiseAND(UNMAPPED | SECONDARY | SUPPLEMENTARY) == 0
    key = ["clone_id", *([] if across_cells else ["cell_id"]), "chrom", "mate_chrom", "mate_start"]
    rows = reads.withColumn("_five", five_prime(F.col("start"), F.col("cigar"), _bit(REVERSE)))
    key = [*(F.col(c) for c in key), F.col("_five"), F.col("flag").bitwiseAND(REVERSE | MATE_REVERSE), *(F.col(c).isNull() for c in key)]
    return rows.withColumns({"_a": F.when(takes, F.xxhash64(*key)), "_b": F.when(takes, F.xxhash64(F.lit(1), *key))}).drop("_five")


def marked_metrics(reads: DataFrame, across_cells: bool = False) -> DataFrame:
    """:func:`duplicate_metrics` of each clone after :func:`mark_duplicates`, by counts of groups alone: no read is marked or moved.

    All reads of a group but the best are duplicates; the best one keeps its own bit. So
    reads meet again only where some of a group have the bit, some not, and the best
    quality is in both.
    """
    rows = _grouped(reads, across_cells).withColumns({"_d": _bit(DUPLICATE), "_q": _quality()})
    groups = rows.groupBy("clone_id", "_a", "_b").agg(F.count("*").alias("_n"), F.max(F.when(F.col("_d"), F.col("_q"))).alias("_old"), F.max(F.when(~F.col("_d"), F.col("_q"))).alias("_new"))
    groups = groups.withColumn("_n", F.when(F.col("_a").isNotNull(), F.col("_n")).otherwise(0))
    kept = F.coalesce(F.col("_old") > F.col("_new"), F.col("_new").isNull()).cast("long")
    tied = F.coalesce(F.col("_old") == F.col("_new"), F.lit(False)) & F.col("_a").isNotNull()
    found = groups.groupBy("clone_id").agg(F.sum("_n").alias("mapped_reads"), F.sum(F.when(F.col("_a").isNotNull(), F.col("_n") - 1 + kept).otherwise(0)).alias("duplicates"), F.count_if(tied).alias("_tied"))
    found = staged(found)
    if not found.filter("_tied > 0").isEmpty():
        unsure = staged(groups.filter(tied).select("_a", "_b", F.col("_old").alias("_top")))
        met = rows.withColumn("_h", F.xxhash64(*reads.columns)).join(_few(unsure)(unsure), ["_a", "_b"]).filter("_q = _top")
        own = met.groupBy("clone_id", "_a", "_b").agg(F.min_by("_d", F.struct("read_id", "_h")).alias("_d")).groupBy(F.col("clone_id").alias("_clone")).agg(F.count_if("_d").alias("_more"))
        found = found.join(own, F.col("clone_id").eqNullSafe(F.col("_clone")), "left").withColumn("duplicates", F.col("duplicates") + F.coalesce("_more", F.lit(0)))
    rate = F.when(F.col("mapped_reads") > 0, F.col("duplicates") / F.col("mapped_reads")).otherwise(0.0)
    return found.select("clone_id", "mapped_reads", "duplicates", rate.alias("dup_rate"))


def flag_stats(reads: DataFrame, by: str = "clone_id") -> DataFrame:
    """Counts of alignment flags, for reads that pass QC and that fail it, and percentages of the mapped and paired."""
    primary = ~_bit(SECONDARY) & ~_bit(SUPPLEMENTARY)
    pair, mapped = _bit(PAIRED) & primary, ~_bit(UNMAPPED)
    other = pair & mapped & ~_bit(MATE_UNMAPPED) & (F.col("chrom") != F.col("mate_chrom"))
    counts = {
        "total": F.lit(True), "primary": primary, "secondary": _bit(SECONDARY), "supplementary": _bit(SUPPLEMENTARY), "duplicates": _bit(DUPLICATE), "mapped": mapped,
        "paired": pair, "read1": pair & _bit(READ1), "read2": pair & _bit(READ2), "properly_paired": pair & _bit(PROPER) & mapped,
        "both_mapped": pair & mapped & ~_bit(MATE_UNMAPPED), "singletons": pair & mapped & _bit(MATE_UNMAPPED), "mate_other_chrom": other, "mate_other_chrom_mapq5": other & (F.col("mapq") >= 5),
    }
    out = reads.groupBy(by, _bit(QC_FAIL).alias("qc_failed")).agg(*[F.count_if(c).alias(n) for n, c in counts.items()])
    share = lambda a, b: F.when(F.col(b) > 0, F.round(F.col(a) / F.col(b) * 100, 2))
    return out.withColumns({"mapped_pct": share("mapped", "total"), "properly_paired_pct": share("properly_paired", "paired"), "singletons_pct": share("singletons", "paired")})


def duplicate_metrics(reads: DataFrame, by: str = "clone_id") -> DataFrame:
    """Mapped primary reads, duplicates among them, and their rate."""
    primary = F.col("flag").bitwiseAND(UNMAPPED | SECONDARY | SUPPLEMENTARY) == 0
    out = reads.groupBy(by).agg(F.count_if(primary).alias("mapped_reads"), F.count_if(primary & _bit(DUPLICATE)).alias("duplicates"))
    return out.withColumn("dup_rate", F.when(F.col("mapped_reads") > 0, F.col("duplicates") / F.col("mapped_reads")).otherwise(0.0))


def library_size(reads: Column, distinct: Column) -> Column:
    """Molecules of a library of which ``reads`` drawn at random hit ``distinct``; null without duplicates.

    The root of ``distinct / x = 1 - exp(-reads / x)`` (Lander and Waterman), by 64
    bisections between ``distinct`` and the first of its doublings beyond the root.
    """
    n, c = reads.cast("double"), distinct.cast("double")
    short = lambda x: c / x - 1 + F.exp(-n / x)
    top = F.aggregate(F.sequence(F.lit(1), F.lit(64)), c, lambda x, _: F.when(short(x) > 0, 2 * x).otherwise(x))
    ends = F.aggregate(
        F.sequence(F.lit(1), F.lit(64)), F.struct(c.alias("lo"), top.alias("hi")),
        lambda s, _: F.struct(F.when(short((s["lo"] + s["hi"]) / 2) > 0, (s["lo"] + s["hi"]) / 2).otherwise(s["lo"]).alias("lo"), F.when(short((s["lo"] + s["hi"]) / 2) > 0, s["hi"]).otherwise((s["lo"] + s["hi"]) / 2).alias("hi")),
    )
    return F.when((c > 0) & (n > c), F.round(ends["hi"]).cast("long"))


def library_sizes(metrics: DataFrame, by: str = "clone_id") -> DataFrame:
    """``library_size`` of each row of :func:`duplicate_metrics`."""
    return metrics.select(by, library_size(F.col("mapped_reads"), F.col("mapped_reads") - F.col("duplicates")).alias("library_size"))


def clone_totals(reads: DataFrame) -> DataFrame:
    """Reads and bases of each clone and, with a null clone, of all: the whole-tumour pseudobulk."""
    return reads.rollup("clone_id").agg(F.count("*").alias("n_reads"), F.sum(F.col("end") - F.col("start")).alias("n_bases"), F.grouping("clone_id").cast("int").alias("all_clones"))


def _steps(reads: DataFrame, tile: int) -> DataFrame:
    """Depth as runs: ``clone_id, chrom, tile, pos, until, depth`` within tiles that reads touch.

    A read goes to the tiles it touches, clipped to each, so the running sum is over
    one tile of one clone and no chromosome lands in a task.
    """
    used = reads.filter(F.col("flag").bitwiseAND(SKIPPED) == 0).filter("end > start")
    tiles = F.sequence(F.floor(F.col("start") / tile), F.floor((F.col("end") - 1) / tile))
    cut = used.select("clone_id", "chrom", "start", "end", F.explode(tiles).alias("tile"))
    cut = cut.select("clone_id", "chrom", "tile", F.greatest("start", F.col("tile") * tile).alias("a"), F.least("end", (F.col("tile") + 1) * tile).alias("b"))
    ends = cut.select("clone_id", "chrom", "tile", F.explode(F.array(F.struct(F.col("a").alias("pos"), F.lit(1).alias("d")), F.struct(F.col("b").alias("pos"), F.lit(-1).alias("d")))).alias("e"))
    steps = ends.groupBy("clone_id", "chrom", "tile", F.col("e.pos").alias("pos")).agg(F.sum("e.d").alias("d"))
    by = Window.partitionBy("clone_id", "chrom", "tile").orderBy("pos")
    runs = steps.select("clone_id", "chrom", "tile", "pos", F.lead("pos").over(by).alias("until"), F.sum("d").over(by.rowsBetween(Window.unboundedPreceding, 0)).alias("depth"))
    return runs.filter("until IS NOT NULL AND depth > 0")


def coverage_windows(reads: DataFrame, tile: int = TILE) -> DataFrame:
    """Mean depth of each window of ``tile`` bases that has reads; the others have depth 0.

    Unmapped, secondary, failed and duplicate reads don't count; overlaps of mates do.
    """
    per = _steps(reads, tile).groupBy("clone_id", "chrom", "tile").agg(F.sum((F.col("until") - F.col("pos")) * F.col("depth")).alias("bases"))
    return per.select("clone_id", "chrom", (F.col("tile") * tile).alias("start"), ((F.col("tile") + 1) * tile).alias("end"), (F.col("bases") / tile).alias("mean_depth"))


def coverage_summary(reads: DataFrame, chrom_sizes: DataFrame, tile: int = TILE) -> DataFrame:
    """Per clone and chromosome: length, bases, mean, least and largest depth."""
    per = _steps(reads, tile).groupBy("clone_id", "chrom").agg(
        F.sum((F.col("until") - F.col("pos")) * F.col("depth")).alias("bases"), F.sum(F.col("until") - F.col("pos")).alias("covered"), F.min("depth").alias("low"), F.max("depth").alias("max_depth")
    )
    grid = _grid(reads, chrom_sizes.select("chrom", "length"))
    out = grid.join(per, ["clone_id", "chrom"], "left").fillna(0)
    least = F.when(F.col("covered") < F.col("length"), 0).otherwise(F.col("low"))
    return out.select("clone_id", "chrom", "length", "bases", (F.col("bases") / F.col("length")).alias("mean_depth"), least.alias("min_depth"), "max_depth")


def coverage_targets(reads: DataFrame, targets: DataFrame, tile: int = TILE) -> DataFrame:
    """Depth over each target ``chrom, start, end`` (from 0, end not included) in each clone.

    Returns ``clone_id, chrom, start, end, bases, mean_depth, max_depth, covered`` (bases
    of the target with any read); targets without reads have zeros, equal targets are
    one, targets without a base are left out. Runs of depth and targets are both cut at
    tiles and meet there, so neither a deep locus nor a long target is one task. Reads
    count as in :func:`coverage_windows`.
    """
    wanted = targets.select("chrom", "start", "end").filter("end > start").distinct()
    tiles = F.sequence(F.floor(F.col("start") / tile), F.floor((F.col("end") - 1) / tile))
    pieces = wanted.withColumn("tile", F.explode(tiles)).withColumns({"a": F.greatest("start", F.col("tile") * tile), "b": F.least("end", (F.col("tile") + 1) * tile)})
    met = _steps(reads, tile).join(pieces, ["chrom", "tile"]).filter("pos < b AND until > a").withColumn("shared", F.least("until", "b") - F.greatest("pos", "a"))
    per = met.groupBy("clone_id", "chrom", "start", "end").agg(F.sum(F.col("shared") * F.col("depth")).alias("bases"), F.max("depth").alias("max_depth"), F.sum("shared").alias("covered"))
    out = _grid(reads, wanted).join(per, ["clone_id", "chrom", "start", "end"], "left").fillna(0, ["bases", "max_depth", "covered"])
    return out.select("clone_id", "chrom", "start", "end", "bases", (F.col("bases") / (F.col("end") - F.col("start"))).alias("mean_depth"), "max_depth", "covered")


def coverage_distribution(reads: DataFrame, chrom_sizes: DataFrame, tile: int = TILE) -> DataFrame:
    """Per clone and depth the bases of just that depth and the share of the genome that has it or more."""
    per = _steps(reads, tile).groupBy("clone_id", "depth").agg(F.sum(F.col("until") - F.col("pos")).alias("bases"))
    total = chrom_sizes.agg(F.sum("length").alias("length"))
    covered = per.groupBy("clone_id").agg(F.sum("bases").alias("c"))
    none = reads.select("clone_id").distinct().join(covered, "clone_id", "left").fillna(0).crossJoin(F.broadcast(total))
    rows = per.unionByName(none.select("clone_id", F.lit(0).cast("long").alias("depth"), (F.col("length") - F.col("c")).alias("bases"))).crossJoin(F.broadcast(total))
    deeper = Window.partitionBy("clone_id").orderBy(F.desc("depth")).rowsBetween(Window.unboundedPreceding, 0)
    return rows.select("clone_id", "depth", "bases", (F.sum("bases").over(deeper) / F.col("length")).alias("share_at_least"))


def coverage_headline(distribution: DataFrame) -> DataFrame:
    """Per clone the median depth and the percentage of the genome at 1, 5, 10 and 30 or more."""
    at = lambda d: F.round(100 * F.coalesce(F.max(F.when(F.col("depth") >= d, F.col("share_at_least"))), F.lit(0.0)), 4).alias(f"pct_{d}x")
    median = F.max(F.when(F.col("share_at_least") >= 0.5, F.col("depth"))).alias("median_depth")
    return distribution.groupBy("clone_id").agg(median, *[at(d) for d in (1, 5, 10, 30)])
