"""Registered queries over the derived single-cell tables, and the SQL they are held against."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import columns as C
from ..operators import calls as K
from ..operators import clones as G
from ..operators import compare as X
from ..operators import pseudobulk as P
from ..operators import report as R
from ..operators import tree as T
from ..operators import validate as V
from ..operators.alignment import left_align
from ..operators.intervals import restrict_to_intervals
from ..functions.staging import staged, staging_path
from ..sources import readers, writers
from .testdata import view, with_views

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE_SQL: dict[str, str] = {}


def _six(name: str):
    """``round(name, 6)``; decimals, which take ten times as long, only near a half and for large numbers."""
    x = F.col(name)
    m = x * 1e6
    plain = (F.abs(x) < 1e8) & (F.abs(F.abs(m - F.rint(m)) - 0.5) > 1e-3)
    return F.when(plain, F.rint(m) / 1e6 + F.lit(0.0)).otherwise(F.round(x, 6))


def _rounded(df: DataFrame) -> DataFrame:
    """Doubles to six digits, so that sums in another order compare equal."""
    return df.withColumns({c: _six(c) for c, t in df.dtypes if t == "double"})


def query(name: str, sql: str | None = None):
    """Register ``f(get)``, where ``get`` gives a view by name; ``sql`` names views too."""

    def add(f):
        QUERIES[name] = lambda spark, sf_dir: _rounded(f(lambda v: view(spark, sf_dir, v)))
        if sql:
            ORACLE_SQL[name] = with_views(sql)
        return f

    return add


KEYS = "chrom, pos, ref, alt"
PASSED = "(SELECT * FROM calls WHERE filters IS NULL OR filters IN ('.', '') OR list_contains(string_split(filters, ';'), 'PASS'))"
SUPPORT = f"(SELECT {KEYS}, clone_id, count(DISTINCT caller) AS n_callers, array_to_string(list_sort(list(DISTINCT caller)), ';') AS callers, list(DISTINCT caller) AS cs FROM {PASSED} GROUP BY {KEYS}, clone_id)"
N_CLONES = "(SELECT count(DISTINCT clone_id) FROM files)"
SHARING = f"""(SELECT {KEYS}, count(DISTINCT clone_id) AS n_clones_with_variant,
  CASE WHEN count(DISTINCT clone_id) <= 1 THEN 'private' WHEN count(DISTINCT clone_id) < {N_CLONES} THEN 'partial' ELSE 'shared' END AS sharing_class FROM {PASSED} GROUP BY {KEYS})"""


def passed(get) -> DataFrame:
    return K.pass_filter(get("calls"))


# Calls compared ----------------------------------------------------------------------------------

query("f6_pass_filter", f"SELECT clone_id, caller, {KEYS}, filters FROM {PASSED}")(lambda get: passed(get).select("clone_id", "caller", *C.KEY, "filters"))
query("f7_select_callers", f"SELECT clone_id, caller, {KEYS} FROM calls WHERE caller IN ('mutect2', 'strelka2')")(lambda get: K.select_callers(get("calls"), "mutect2, strelka2").select("clone_id", "caller", *C.KEY))
query("u1_variant_set", f"SELECT DISTINCT clone_id, caller, {KEYS} FROM {PASSED}")(lambda get: X.variant_set(passed(get)))
query("u2_all_keys", f"SELECT DISTINCT {KEYS} FROM {PASSED}")(lambda get: X.all_keys(passed(get)))
_CLONES = [f"clone_{i:03d}" for i in range(1, 6)]
_MATRIX = ", ".join(f"max(CASE WHEN clone_id = '{c}' AND caller = '{k}' THEN 1 ELSE 0 END) AS \"{c}.{k}\"" for c in _CLONES for k in ("freebayes", "mutect2", "quiet", "strelka2"))
query("x3_presence_matrix", f"SELECT {KEYS}, {_MATRIX} FROM {PASSED} GROUP BY {KEYS}")(lambda get: X.presence_matrix(passed(get), get("files")))
query("x4_caller_concordance", f"""
SELECT n.clone_id, n_callers, count(k) AS n_variants_any, count_if(k >= n_callers) AS n_variants_all, count_if(k >= 2) AS n_variants_2plus,
  round(CASE WHEN count(k) > 0 THEN count_if(k >= n_callers) / count(k) ELSE 0 END, 6) AS concordance_rate
FROM (SELECT clone_id, count(DISTINCT caller) AS n_callers FROM files GROUP BY 1) n
LEFT JOIN (SELECT clone_id, {KEYS}, count(DISTINCT caller) AS k FROM {PASSED} GROUP BY ALL) s USING (clone_id) GROUP BY 1, 2""")(
    lambda get: X.caller_concordance(passed(get), get("files").filter("caller <> 'quiet'").union(get("files").filter("caller = 'quiet'")))
)
query("x5_clone_presence", f"SELECT DISTINCT clone_id, {KEYS} FROM {PASSED}")(lambda get: X.clone_presence(passed(get)))
query("x6_variant_sharing", f"SELECT * FROM {SHARING}")(lambda get: X.variant_sharing(passed(get), get("files")))
query("x7_per_clone_variants", f"SELECT clone_id, caller, {KEYS}, round(qual, 6) AS qual, filters FROM {PASSED}")(lambda get: X.per_clone_variants(passed(get)))
query("j4_detected_records", f"SELECT clone_id, caller, {KEYS}, round(qual, 6) AS qual, filters FROM calls c WHERE EXISTS (SELECT 1 FROM {PASSED} p WHERE p.clone_id = c.clone_id AND p.chrom = c.chrom AND p.pos = c.pos AND p.ref = c.ref AND p.alt = c.alt)")(
    lambda get: X.detected_records(get("calls"), X.clone_presence(passed(get))).select("clone_id", "caller", *C.KEY, "qual", "filters")
)
query("x8_sharing_by_clone", f"""
SELECT clone_id, count_if(sharing_class = 'private') AS private, count_if(sharing_class = 'partial') AS partial, count_if(sharing_class = 'shared') AS shared
FROM (SELECT DISTINCT clone_id, {KEYS} FROM {PASSED}) JOIN {SHARING} USING ({KEYS}) GROUP BY 1""")(lambda get: X.sharing_by_clone(passed(get), get("files")))
query("x9_clone_similarity", f"""
WITH p AS (SELECT DISTINCT clone_id, {KEYS} FROM {PASSED}), n AS (SELECT clone_id, count(*) AS n FROM p GROUP BY 1), c AS (SELECT DISTINCT clone_id FROM files),
b AS (SELECT a.clone_id AS ca, b.clone_id AS cb, count(*) AS k FROM p a JOIN p b USING ({KEYS}) GROUP BY 1, 2)
SELECT a.clone_id AS clone_a, z.clone_id AS clone_b, round(coalesce(k / (na.n + nb.n - k), 0), 6) AS jaccard
FROM c a CROSS JOIN c z LEFT JOIN b ON ca = a.clone_id AND cb = z.clone_id LEFT JOIN n na ON na.clone_id = a.clone_id LEFT JOIN n nb ON nb.clone_id = z.clone_id""")(lambda get: X.clone_similarity(passed(get), get("files")))
query("x10_consensus_variants", f"SELECT {KEYS}, max(n_callers) AS max_callers FROM {SUPPORT} GROUP BY {KEYS} HAVING max(n_callers) >= 2")(lambda get: X.consensus_variants(passed(get)))
_TABLE = ", ".join(f"CAST(max(CASE WHEN clone_id = '{c}' THEN n_callers ELSE 0 END) AS INT) AS {c}_n_callers, max(CASE WHEN clone_id = '{c}' THEN callers ELSE '' END) AS {c}_callers" for c in _CLONES)
query("x11_consensus_table", f"SELECT {KEYS}, {_TABLE} FROM {SUPPORT} GROUP BY {KEYS} HAVING max(n_callers) >= 2")(lambda get: X.consensus_table(passed(get), get("files")))
query("x12_consensus_info", f"""
SELECT {KEYS}, count(DISTINCT clone_id) AS n_clones, array_to_string(list_sort(list_distinct(flatten(list(cs)))), ',') AS callers FROM {SUPPORT} GROUP BY {KEYS} HAVING max(n_callers) >= 2""")(lambda get: X.consensus_info(passed(get)))
query("x13_consensus_summary", f"""
SELECT count(*) AS n_input_variants, count_if(k >= 2) AS n_consensus, 2 AS min_callers_required, true AS pass_only FROM (SELECT max(n_callers) AS k FROM {SUPPORT} GROUP BY {KEYS})""")(lambda get: X.consensus_summary(passed(get)))
query("l2_sorted_keys", f"SELECT DISTINCT {KEYS} FROM {PASSED} ORDER BY ALL")(lambda get: X.sort_keys(X.all_keys(passed(get))))

# Calls: joins, alleles, functions ----------------------------------------------------------------

query("f10_threshold_alleles", f"""
WITH d AS (SELECT clone_id, chrom, pos, sum(n_alt) AS depth FROM alleles GROUP BY ALL)
SELECT clone_id, {KEYS}, n_alt, CAST(depth AS BIGINT) AS depth, round(n_alt / depth, 6) AS fraction FROM alleles JOIN d USING (clone_id, chrom, pos) WHERE alt <> ref AND n_alt >= 3 AND n_alt / depth >= 0.05""")(lambda get: K.threshold_alleles(get("alleles")))
query("j5_match_normals", """
SELECT DISTINCT clone_id, c.patient_id, n.sample_id AS normal_id, n.bam_path AS normal_bam FROM assignments JOIN cells c USING (cell_id) LEFT JOIN normals n USING (patient_id)""")(lambda get: K.match_normals(get("assignments"), get("cells"), get("normals")))
query("j6_restrict_to_intervals", f"SELECT clone_id, caller, {KEYS} FROM calls c WHERE EXISTS (SELECT 1 FROM bed b WHERE b.chrom = c.chrom AND c.pos > b.start AND c.pos <= b.\"end\")")(
    lambda get: restrict_to_intervals(get("calls"), get("bed")).select("clone_id", "caller", *C.KEY)
)
query("j6_overlapping_reads", "SELECT clone_id, cell_id, read_id FROM reads r WHERE EXISTS (SELECT 1 FROM genes b WHERE b.chrom = r.chrom AND b.start < r.\"end\" AND b.\"end\" > r.start)")(
    lambda get: restrict_to_intervals(get("reads"), get("genes"), "start", "end").select("clone_id", "cell_id", "read_id")
)
query("j7_drop_known", f"SELECT clone_id, caller, {KEYS} FROM calls c WHERE NOT EXISTS (SELECT 1 FROM panel p WHERE p.chrom = c.chrom AND p.pos = c.pos AND p.ref = c.ref AND p.alt = c.alt)")(
    lambda get: K.drop_known(get("calls"), get("panel")).select("clone_id", "caller", *C.KEY)
)
query("j8_annotate_germline_af", f"SELECT clone_id, caller, {KEYS}, round(coalesce(g.af, 0.0000025), 6) AS germline_af FROM calls LEFT JOIN germline g USING ({KEYS})")(
    lambda get: K.annotate_germline_af(get("calls"), get("germline")).select("clone_id", "caller", *C.KEY, "germline_af")
)
_BEST = ", ".join(f"max(CASE WHEN caller = '{k}' THEN b.qual END) AS {k}_qual, max(CASE WHEN caller = '{k}' THEN b.filters END) AS {k}_filters" for k in ("mutect2", "strelka2", "freebayes"))
query("j9_merge_callers", f"""
WITH b AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY clone_id, caller, {KEYS} ORDER BY coalesce(qual, -1) DESC, filters DESC) AS k FROM calls) WHERE k = 1)
SELECT clone_id, {KEYS}, {_BEST} FROM b GROUP BY clone_id, {KEYS}""")(lambda get: K.merge_callers(get("calls"), ["mutect2", "strelka2", "freebayes"]))
query("m8_caller_stats", """
SELECT clone_id, caller, count(*) AS records, count(*) AS snps, CAST(0 AS BIGINT) AS indels, CAST(0 AS BIGINT) AS others, CAST(0 AS BIGINT) AS multiallelic,
  count_if(ref || alt IN ('AG', 'GA', 'CT', 'TC')) AS transitions, count_if(ref || alt NOT IN ('AG', 'GA', 'CT', 'TC')) AS transversions,
  round(count_if(ref || alt IN ('AG', 'GA', 'CT', 'TC')) / nullif(count_if(ref || alt NOT IN ('AG', 'GA', 'CT', 'TC')), 0), 6) AS ts_tv
FROM calls GROUP BY 1, 2""")(lambda get: K.caller_stats(get("calls")))
# Two call sets that hold all calls between them and overlap in one caller.
query("u4_concat_calls", f"SELECT {KEYS}, caller FROM calls WHERE caller <> 'freebayes' UNION ALL SELECT {KEYS}, caller FROM calls WHERE caller <> 'mutect2' ORDER BY ALL")(
    lambda get: K.concat_calls(*(get("calls").filter(F.col("caller") != c).select(*C.KEY, "caller") for c in ("freebayes", "mutect2")))
)
query("u5_union_callers", f"SELECT clone_id, caller, {KEYS} FROM calls")(
    lambda get: K.union_callers({k: get("calls").filter(F.col("caller") == k).drop("caller") for k in ("mutect2", "strelka2", "freebayes")}).select("clone_id", "caller", *C.KEY)
)
query("e1_event_key", """SELECT cell_id, chr || '|' || start || '|' || "end" || '|' || event_type AS event FROM cn_events""")(lambda get: get("cn_events").select("cell_id", C.event_key(get("cn_events").columns).alias("event")))
query("e2_variant_key", f"SELECT chrom, pos, ref, CASE WHEN pos % 900 = 0 THEN '' ELSE alt END AS alt FROM (SELECT DISTINCT {KEYS} FROM calls)")(
    lambda get: C.with_variant_key(X.all_keys(get("calls")).withColumn("alt", F.when(F.col("pos") % 900 == 0, ".").otherwise(F.col("alt"))))
)
query("e3_normalize_chrom", """
SELECT DISTINCT chrom, CASE WHEN chrom IN ('M', 'MT') THEN 'chrM' WHEN starts_with(chrom, 'chr') THEN chrom ELSE 'chr' || chrom END AS long_name,
  CASE WHEN chrom = 'chrM' THEN 'MT' ELSE regexp_replace(chrom, '^[chr]+', '') END AS short_name
FROM (SELECT chrom FROM calls UNION ALL SELECT replace(chrom, 'chr', '') FROM calls UNION ALL SELECT CASE WHEN pos % 200 = 0 THEN 'MT' ELSE 'chrM' END FROM calls UNION ALL SELECT 'GL' || ref FROM calls)""")(
    lambda get: get("calls").select(F.explode(F.array("chrom", F.replace(F.col("chrom"), F.lit("chr"), F.lit("")), F.when(F.col("pos") % 200 == 0, "MT").otherwise("chrM"), F.concat(F.lit("GL"), "ref"))).alias("chrom"))
    .distinct().select("chrom", C.normalize_chrom(F.col("chrom")).alias("long_name"), C.normalize_chrom(F.col("chrom"), "plain").alias("short_name"))
)
query("e4_extract_info", f"""
SELECT clone_id, caller, {KEYS}, regexp_extract(info, 'DP=([^;]*)', 1) AS DP, regexp_extract(info, 'AF=([^;]*)', 1) AS AF, CASE WHEN contains(info, 'SOMATIC') THEN 'true' END AS SOMATIC FROM calls""")(
    lambda get: C.extract_info(get("calls"), ["DP", "AF", "SOMATIC"]).select("clone_id", "caller", *C.KEY, "DP", "AF", "SOMATIC")
)


def _sites(get) -> DataFrame:
    return get("calls").groupBy("clone_id", "chrom", "pos", "ref").agg(F.array_join(F.sort_array(F.collect_set("alt")), ",").alias("alt"))


_SITES = "(SELECT clone_id, chrom, pos, ref, list_sort(list(DISTINCT alt)) AS alts FROM calls GROUP BY ALL)"
query("e5_split_multiallelic", f"SELECT clone_id, chrom, pos, ref, unnest(alts) AS alt, CAST(generate_subscripts(alts, 1) AS INT) AS alt_index FROM {_SITES}")(lambda get: K.split_multiallelic(_sites(get)))
query("e5_trim_alleles", f"SELECT chrom, pos + 2 AS pos, ref, alt FROM (SELECT DISTINCT {KEYS} FROM calls) WHERE ref <> alt UNION ALL SELECT chrom, pos, 'GT', 'G' FROM (SELECT DISTINCT chrom, pos FROM calls)")(
    lambda get: K.trim_alleles(X.all_keys(get("calls")).filter("ref <> alt").select("chrom", "pos", F.concat(F.lit("GT"), "ref", F.lit("CA")).alias("ref"), F.concat(F.lit("GT"), "alt", F.lit("CA")).alias("alt"))
    .union(get("calls").select("chrom", "pos", F.lit("GTCA"), F.lit("GCA")).distinct()))
)


#: Reference of the indels: this text again and again, with runs over several chunks of 64.
_MOTIF = "GATTACAC" * 8 + "T" * 200 + "CA" * 60 + "ACGGTCTA" * 8


def _aligned(get) -> DataFrame:
    """Insertions of one and two bases, deletions of 1, 2 and 150 behind each call's position."""
    size = 64
    n = len(_MOTIF)
    top = get("calls").groupBy("chrom").agg((F.max("pos") + 1000).alias("top"))
    chunks = top.select("chrom", F.explode(F.sequence(F.lit(0), F.floor(F.col("top") / size))).alias("chunk_index"))
    chunks = chunks.withColumn("sequence", F.substring(F.repeat(F.lit(_MOTIF), 2), (F.col("chunk_index") * size % n + 1).cast("int"), F.lit(size)))
    chunks = staged(chunks)
    calls = get("calls").select("chrom", "pos", (F.floor(F.col("pos") / 100) % 5).alias("kind")).distinct()
    there = lambda size: F.substring(F.repeat(F.lit(_MOTIF), 2), ((F.col("pos") - 1) % n + 1).cast("int"), size)
    gone = F.element_at(F.array(*[F.lit(x) for x in (1, 2, 0, 0, 150)]), (F.col("kind") + 1).cast("int"))
    come = F.element_at(F.array(*[F.lit(x) for x in ("", "", "T", "CA", "")]), (F.col("kind") + 1).cast("int"))
    return left_align(calls.select("chrom", "pos", there(gone + 1).alias("ref"), F.concat(there(F.lit(1)), come).alias("alt")), chunks, size)


query("e5_left_align", f"""
WITH RECURSIVE v AS (SELECT DISTINCT chrom, pos, CAST(floor(pos / 100) AS BIGINT) % 5 AS kind FROM calls), m AS (SELECT repeat('{_MOTIF}', 2) AS m, {len(_MOTIF)} AS n),
s AS (
  SELECT chrom, pos, kind, pos + 1 AS q, CASE kind WHEN 2 THEN 'T' WHEN 3 THEN 'CA' ELSE substr(m, pos % n + 1, [1, 2, 0, 0, 150][kind + 1]) END AS b, substr(m, (pos - 1) % n + 1, 1) AS f FROM v, m
  UNION ALL SELECT chrom, pos, kind, q - 1, f || left(b, length(b) - 1), substr(m, (q - 3) % n + 1, 1) FROM s, m WHERE f = right(b, 1) AND q > 2)
SELECT chrom, q - 1 AS pos, CASE WHEN kind IN (2, 3) THEN f ELSE f || b END AS ref, CASE WHEN kind IN (2, 3) THEN f || b ELSE f END AS alt, true AS ref_matches FROM s WHERE f <> right(b, 1)""")(_aligned)
query("e6_clone_and_caller", "SELECT DISTINCT clone_id, caller FROM files")(
    lambda get: get("files").distinct().select(*[c.alias(n) for c, n in zip(C.clone_and_caller(F.concat(F.lit("/x/"), "clone_id", F.lit("."), "caller", F.lit(".norm.vcf.gz"))), ("clone_id", "caller"), strict=True)])
)
query("s4_parse_vcf_lines", f"SELECT clone_id, caller, {KEYS}, round(qual, 6) AS qual, filters, info FROM calls")(
    lambda get: readers.parse_vcf_lines(
        get("calls").select("clone_id", "caller", F.concat_ws("\t", "chrom", F.col("pos").cast("string"), F.lit("."), "ref", "alt", F.coalesce(F.col("qual").cast("string"), F.lit(".")), "filters", "info").alias("value"))
        .union(get("files").select("clone_id", "caller", F.lit("##fileformat=VCFv4.2")))
    )
)
query("s8_vcf_lines", f"""
SELECT chrom || chr(9) || pos || chr(9) || '.' || chr(9) || ref || chr(9) || alt || chr(9) || '.' || chr(9) || 'PASS' || chr(9) || 'N_CLONES=' || count(DISTINCT clone_id) || ';CALLERS=' || array_to_string(list_sort(list_distinct(flatten(list(cs)))), ',') AS value
FROM {SUPPORT} GROUP BY {KEYS} HAVING max(n_callers) >= 2""")(lambda get: writers.vcf_lines(X.consensus_info(passed(get))).filter("part = 1").select("value"))
query("p9_pileup_counts")(lambda get: _pileup(get))


def _pileup(get) -> DataFrame:
    """Reads of a repeated sequence against a reference of another one."""
    reads = get("reads").withColumn("seq", F.expr("substring(repeat('ACGT', 40), cast(start % 4 as int) + 1, cast(`end` - start as int))"))
    chunks = reads.groupBy("chrom").agg(F.max("end").alias("top")).select("chrom", F.explode(F.sequence(F.lit(0), F.floor(F.col("top") / 1000))).alias("chunk_index"), F.lit("ACGA" * 250).alias("sequence"))
    return K.pileup_counts(reads, chunks, 1000)


ORACLE_SQL["p9_pileup_counts"] = with_views("""
WITH used AS (SELECT clone_id, chrom, start, "end" FROM reads WHERE (flag & 1796) = 0),
b AS (SELECT clone_id, chrom, unnest(range(start, "end")) AS p FROM used),
c AS (SELECT clone_id, chrom, p + 1 AS pos, substr('ACGT', CAST(p % 4 AS INT) + 1, 1) AS alt, substr('ACGA', CAST(p % 4 AS INT) + 1, 1) AS ref, count(*) AS n_alt FROM b GROUP BY ALL)
SELECT clone_id, chrom, pos, ref, alt, n_alt, CAST(sum(n_alt) OVER (PARTITION BY clone_id, chrom, pos) AS BIGINT) AS depth FROM c""")

# Validation and cells ----------------------------------------------------------------------------

def _known_cells(get) -> DataFrame:
    """Cells of the view ``ids``, as ``id, bam_path``."""
    return get("ids").join(get("cells").select(F.col("cell_id").alias("id"), "bam_path"), "id")


query("f2_standardize_events", "SELECT cell_id, chr, start, \"end\", event_type FROM cn_events")(
    lambda get: V.standardize_events(get("cn_events").withColumnsRenamed({"cell_id": "Cell", "chr": "Seqnames", "event_type": "Type", "start": "START"}))
)
query("f3_standardize_cells", "SELECT cell_id AS barcode, bam_path, cell_id, 'S1' AS sample_id, 'S1' AS patient_id FROM cells")(
    lambda get: V.standardize_cells(get("cells").select(F.col("cell_id").alias("barcode"), "bam_path"), "S1")
)
query("f4_manifest_from_tree", "SELECT node_id AS cell_id, '/d/' || node_id || '.bam' AS bam_path, '/d/' || node_id || '.bam.bai' AS bai_path, 'S' AS sample_id, 'S' AS patient_id FROM nodes WHERE is_leaf")(
    lambda get: V.manifest_from_tree(get("nodes"), "/d/", "S")
)
query("f5_infer_index", "SELECT cell_id, bam_path, coalesce(nullif(bai_path, ''), bam_path || '.bai') AS bai_path, sample_id, patient_id FROM cells")(lambda get: V.infer_index(get("cells")))
query("f8_filter_cells", "SELECT c.*, clone_id, round(confidence, 6) AS confidence, flagged FROM cells c JOIN assignments USING (cell_id) WHERE confidence >= 0.5")(lambda get: P.filter_cells(get("cells"), get("assignments"), 0.5))
query("p1_filtered_manifest", "SELECT c.*, clone_id, round(confidence, 6) AS confidence, flagged FROM cells c JOIN assignments USING (cell_id) WHERE confidence >= 0.25")(lambda get: P.filter_cells(get("cells"), get("assignments"), 0.25))
query("j1_assigned_cells", "SELECT c.*, clone_id, round(confidence, 6) AS confidence, flagged FROM cells c JOIN assignments USING (cell_id)")(lambda get: P.filter_cells(get("cells"), get("assignments")))
query("f9_filter_by_metrics", """
SELECT c.* FROM cells c JOIN (SELECT cell_id, count_if((flag & 2308) = 0) AS m FROM reads GROUP BY 1) USING (cell_id) WHERE m >= 20""")(
    lambda get: P.filter_cells_by_metrics(get("cells"), P.duplicate_metrics(get("reads"), "cell_id"), 20)
)
query("j10_check_paths", """
WITH l AS (SELECT bam_path AS path, CASE WHEN d.id IS NOT NULL THEN 0 ELSE 10 END AS length FROM cells JOIN ids i ON i.id = cell_id LEFT JOIN dear d ON d.id = cell_id UNION ALL SELECT bam_path || '.bai', 1 FROM cells JOIN dear ON id = cell_id)
SELECT cell_id, bam_path AS path, 'error' AS level, CASE WHEN length IS NULL THEN 'missing' ELSE 'empty' END AS problem FROM cells LEFT JOIN l ON path = bam_path WHERE coalesce(length, 0) = 0
UNION ALL SELECT cell_id, bam_path || '.bai', 'warning', 'missing index' FROM cells WHERE cell_id NOT IN (SELECT id FROM dear)""")(
    lambda get: V.check_paths(get("cells"), _known_cells(get).join(get("dear"), "id", "left_semi").select("bam_path", F.lit(0).alias("length")).union(_known_cells(get).join(get("dear"), "id", "left_anti").select("bam_path", F.lit(10)))
    .withColumnRenamed("bam_path", "path").union(_known_cells(get).join(get("dear"), "id", "left_semi").select(F.concat("bam_path", F.lit(".bai")), F.lit(1))))
)
query("v1_duplicate_cells", "SELECT cell_id, count(*) AS n FROM (SELECT cell_id FROM cells UNION ALL SELECT id FROM ids) GROUP BY 1 HAVING count(*) > 1")(
    lambda get: V.find_duplicate_cells(get("cells").select("cell_id").union(get("ids")))
)
query("v2_event_stats", "SELECT count(*) AS n_events, count(DISTINCT cell_id) AS n_cells FROM cn_events")(lambda get: V.event_stats(get("cn_events")))
query("v3_tree_stats", "SELECT tree_id, count_if(is_leaf) AS n_leaves, count(*) AS n_nodes, count_if(is_leaf) >= 2 AS ok FROM nodes GROUP BY 1")(lambda get: V.tree_stats(get("nodes")))
query("v4_cross_validate", """
WITH b AS (SELECT DISTINCT cell_id FROM cells), m AS (SELECT DISTINCT id AS cell_id FROM ids),
j AS (SELECT b.cell_id AS x, m.cell_id AS y FROM b FULL JOIN m ON b.cell_id = m.cell_id)
SELECT count(x) AS n_bam_cells, count(y) AS n_meta_cells, count_if(x IS NOT NULL AND y IS NOT NULL) AS n_overlap, count_if(y IS NULL) AS n_in_bam_not_meta, count_if(x IS NULL) AS n_in_meta_not_bam,
  round(100 * count_if(x IS NOT NULL AND y IS NOT NULL) / greatest(count(x), 1), 2) AS pct_overlap, 100 * count_if(x IS NOT NULL AND y IS NOT NULL) / greatest(count(x), 1) >= 50 AS ok,
  (SELECT count_if(is_leaf) FROM nodes) AS n_tree_leaves FROM j""")(
    lambda get: V.cross_validate(get("cells"), get("ids").withColumnRenamed("id", "cell_id"), get("nodes"))
)
query("v5_usable_cells", "SELECT tree_id, node_id AS cell_id, pre, count(*) OVER (PARTITION BY tree_id) >= 2 AS enough FROM nodes WHERE is_leaf AND node_id IN (SELECT id FROM ids)")(
    lambda get: V.usable_cells(get("nodes"), get("ids").withColumnRenamed("id", "cell_id"))
)
query("v6_validate_inputs", """
WITH bad AS (SELECT DISTINCT bam_path AS path FROM cells WHERE cell_id NOT IN (SELECT id FROM ids) ORDER BY 1 LIMIT 10), lost AS (SELECT DISTINCT coalesce(nullif(bai_path, ''), bam_path || '.bai') AS path FROM cells ORDER BY 1 LIMIT 10),
c AS (SELECT count(DISTINCT cell_id) AS n FROM cells), a AS (SELECT count(DISTINCT cell_id) AS n FROM assignments), b AS (SELECT count(DISTINCT cell_id) AS n FROM cells JOIN assignments USING (cell_id))
SELECT 'BAM manifest: missing or empty ' || (SELECT string_agg(path, ', ' ORDER BY path) FROM bad) AS errors, 'BAM manifest: no index ' || (SELECT string_agg(path, ', ' ORDER BY path) FROM lost) AS warnings, 'failed' AS status,
  c.n AS n_bam_cells, a.n AS n_meta_cells, b.n AS n_overlap, round(100.0 * b.n / c.n, 2) AS pct_overlap, (SELECT count_if(is_leaf) FROM nodes) AS n_tree_leaves, (SELECT count(*) FROM nodes) AS n_tree_nodes,
  (SELECT count(*) FROM cn_events) AS n_events, (SELECT count(DISTINCT cell_id) FROM cn_events) AS n_event_cells FROM c, a, b""")(
    lambda get: V.validate_inputs(get("cells"), get("assignments"), get("nodes"), get("cn_events"), _known_cells(get).select(F.col("bam_path").alias("path"), F.lit(1).alias("length")))
    .withColumns({c: F.array_join(c, " | ") for c in ("errors", "warnings")})
)
query("u3_compare_ids", """
WITH a AS (SELECT cell_id FROM cells), b AS (SELECT id AS cell_id FROM ids UNION SELECT 'other')
SELECT coalesce(a.cell_id, b.cell_id) AS cell_id, CASE WHEN a.cell_id IS NULL THEN 'right' WHEN b.cell_id IS NULL THEN 'left' ELSE 'both' END AS side FROM a FULL JOIN b ON a.cell_id = b.cell_id""")(
    lambda get: V.compare_ids(get("cells"), get("ids").withColumnRenamed("id", "cell_id").union(get("ids").select(F.lit("other")).distinct()))
)
query("w1_dedupe_cells", """
SELECT cell_id, chr, start, event_type FROM (SELECT *, row_number() OVER (PARTITION BY cell_id ORDER BY chr, start, event_type) AS k FROM cn_events) WHERE k = 1""")(
    lambda get: V.dedupe_cells(get("cn_events"), ["chr", "start", "event_type"]).select("cell_id", "chr", "start", "event_type")
)
query("s11_flatten_events", "SELECT cell_id, chr, start, \"end\", CAST(start % 7 AS INT) AS h0, CAST(NULL AS INT) AS h1 FROM cn_events WHERE chr <> 'chr3'")(
    lambda get: V.flatten_events(get("cn_events").groupBy("cell_id").agg(F.collect_list(F.struct(F.when(F.col("chr") != "chr3", F.col("chr")).alias("chr"), "start", "end", (F.col("start") % 7).cast("int").alias("h0"))).alias("events")))
)

# Clones described ----------------------------------------------------------------------------------

EVENT = "chr || '|' || start || '|' || \"end\" || '|' || event_type"
FRACTION = f"""(SELECT clone_id, event, k / n AS f FROM (SELECT clone_id, {EVENT} AS event, count(DISTINCT cell_id) AS k FROM cn_events JOIN assignments USING (cell_id) GROUP BY 1, 2)
  JOIN (SELECT clone_id, count(DISTINCT cell_id) AS n FROM assignments GROUP BY 1) USING (clone_id))"""
query("c1_event_profile", f"SELECT DISTINCT c.cell_id, {EVENT} AS event FROM cells c LEFT JOIN cn_events e ON e.cell_id = c.cell_id")(lambda get: G.event_profile(get("cn_events"), get("cells")))
query("j3_clone_cell_events", f"SELECT clone_id, cell_id, {EVENT} AS event FROM cn_events JOIN assignments USING (cell_id)")(
    lambda get: G.clone_cell_events(get("assignments"), get("cn_events"))
)
query("c10_clone_events", f"SELECT clone_id, event, round(f, 6) AS fraction_cells FROM {FRACTION}")(lambda get: G.clone_events(get("assignments"), get("cn_events")))
# Whole chromosomes as events: single ones are in less than half of any clone's cells here.
query("c11_clone_summary", """
WITH e AS (SELECT DISTINCT cell_id, chr || '|' || event_type AS event FROM cn_events), n AS (SELECT clone_id, count(*) AS n_cells FROM assignments GROUP BY 1),
f AS (SELECT clone_id, event FROM e JOIN assignments USING (cell_id) JOIN n USING (clone_id) GROUP BY clone_id, event, n_cells HAVING count(*) / n_cells >= 0.5)
SELECT n.clone_id, n_cells, count(event) AS n_defining_events, coalesce(array_to_string(list_sort(list(event) FILTER (event IS NOT NULL))[1:10], ';'), '') AS defining_events FROM n LEFT JOIN f USING (clone_id) GROUP BY 1, 2""")(
    lambda get: G.clone_summary(get("assignments"), get("cn_events").select("cell_id", "chr", "event_type"))
)
BYNATION = "(SELECT tree_id, cell AS cell_id, nat AS clone_id FROM labelled)"


def by_nation(get) -> DataFrame:
    return get("labelled").select("tree_id", F.col("nat").alias("clone_id"), F.col("cell").alias("cell_id"))


SIZES = f"(SELECT tree_id, clone_id, count(*) AS n, row_number() OVER (PARTITION BY tree_id ORDER BY count(*) DESC, clone_id) AS k FROM {BYNATION} GROUP BY 1, 2)"
_SMALL = "SELECT b.tree_id, {0} AS clone_id, cell_id, {1} AS flagged FROM " + BYNATION + " b JOIN " + SIZES + " s USING (tree_id, clone_id) {2}"
query("c8_small_clones_flag", _SMALL.format("b.clone_id", "n < 60", ""))(lambda get: G.handle_small_clones(by_nation(get), 60, "flag"))
query("c8_small_clones_drop", _SMALL.format("b.clone_id", "false", "WHERE n >= 60"))(lambda get: G.handle_small_clones(by_nation(get), 60, "drop"))
query("w4_small_clones_merge", _SMALL.format("CASE WHEN s.n >= 60 THEN b.clone_id WHEN t.n < 60 THEN 'clone_merged' ELSE t.clone_id END", "false", f"JOIN {SIZES} t ON t.tree_id = b.tree_id AND t.k = 1").replace("n < 60", "s.n < 60").replace("t.s.n", "t.n"))(
    lambda get: G.handle_small_clones(by_nation(get), 60, "merge")
)
query("w2_rename_clones", f"SELECT tree_id, 'clone_' || lpad(CAST(dense_rank() OVER (PARTITION BY tree_id ORDER BY clone_id) AS STRING), 3, '0') AS clone_id, cell_id FROM {BYNATION}")(lambda get: G.rename_clones(by_nation(get)))
query("l3_sorted_assignments", "SELECT clone_id, cell_id FROM assignments ORDER BY ALL")(lambda get: G.sort_assignments(get("assignments")).select("clone_id", "cell_id"))
query("c2_jaccard_distances", f"""
WITH c AS (SELECT nat AS t, cell AS cell_id FROM labelled), e AS (SELECT DISTINCT t, cell_id, {EVENT} AS ev FROM cn_events JOIN c USING (cell_id)), n AS (SELECT t, cell_id, count(ev) AS n FROM c LEFT JOIN e USING (t, cell_id) GROUP BY 1, 2),
m AS (SELECT a.t, a.cell_id AS x, b.cell_id AS y, count(*) AS k FROM e a JOIN e b ON a.t = b.t AND a.ev = b.ev AND a.cell_id < b.cell_id GROUP BY ALL)
SELECT a.t AS tree_id, a.cell_id AS cell_a, b.cell_id AS cell_b, round(CASE WHEN a.n + b.n > 0 THEN 1 - coalesce(k, 0) / (a.n + b.n - coalesce(k, 0)) ELSE 0 END, 6) AS dist
FROM n a JOIN n b ON a.t = b.t AND a.cell_id < b.cell_id LEFT JOIN m ON m.t = a.t AND x = a.cell_id AND y = b.cell_id""")(
    lambda get: G.jaccard_distances(get("labelled").select(F.col("nat").alias("tree_id"), F.col("cell").alias("cell_id")).join(G.event_profile(get("cn_events"), get("cells")), "cell_id"))
)
query("c4_distance")(lambda get: G.assign_clones("distance", get("nodes"), get("cells"), distance_threshold=1.0, min_cells=5))
query("c5_event_profile")(lambda get: G.assign_clones("event_profile", get("nodes"), get("cells"), get("cn_events").select("cell_id", "chr", "event_type"), similarity=0.5, max_clones=20))
query("c6_hybrid")(lambda get: G.assign_clones("hybrid", get("nodes"), get("cells"), get("cn_events").select("cell_id", "chr", "event_type"), min_cells=5, similarity=0.6))


def merge_sql(sizes: str, most: int, rounds: int) -> list[str]:
    """Common table expressions ``r0`` to ``r{rounds}``: where each clone is (``now``) when the smallest joins the second smallest until ``most`` are left."""
    out = [f"r0 AS (SELECT tree_id, clone_id, clone_id AS now, n, p FROM ({sizes}))"]
    for i in range(1, rounds + 1):
        out.append(f"s{i} AS (SELECT tree_id, now, any_value(n) AS n, row_number() OVER (PARTITION BY tree_id ORDER BY any_value(n), min(CASE WHEN now = clone_id THEN p END)) AS k, count(*) OVER (PARTITION BY tree_id) AS c FROM r{i - 1} GROUP BY tree_id, now)")
        out.append(f"""r{i} AS (SELECT r.tree_id, r.clone_id, CASE WHEN a.c > {most} AND r.now = a.now THEN b.now ELSE r.now END AS now, CASE WHEN a.c > {most} AND r.now IN (a.now, b.now) THEN a.n + b.n ELSE r.n END AS n, r.p
  FROM r{i - 1} r JOIN s{i} a ON a.tree_id = r.tree_id AND a.k = 1 LEFT JOIN s{i} b ON b.tree_id = r.tree_id AND b.k = 2)""")
    return out


_MERGE = merge_sql(f"SELECT tree_id, clone_id, count(*) AS n, CAST(regexp_extract(clone_id, '([0-9]+)$', 1) AS INT) AS p FROM {BYNATION} GROUP BY 1, 2", 2, 3)  # five nations become two clones in three
query("c7_merge_to_n", f"WITH {', '.join(_MERGE)} SELECT b.tree_id, r3.now AS clone_id, cell_id FROM {BYNATION} b JOIN r3 USING (tree_id, clone_id)")(lambda get: G.merge_to_n(by_nation(get), 2))

# Trees ---------------------------------------------------------------------------------------------

UNDER = "x.tree_id = n.tree_id AND x.pre BETWEEN n.pre AND n.last"
LEAVES = "(SELECT n.tree_id, n.node_id, count_if(x.is_leaf) AS n_leaves FROM nodes n JOIN nodes x ON " + UNDER + " GROUP BY 1, 2)"
NODE_TABLE = f"(SELECT tree_id, node_id, parent_id, is_leaf, round(edge_length, 6) AS edge_length, n_leaves FROM nodes JOIN {LEAVES} USING (tree_id, node_id))"
THRESHOLD = "(SELECT tree_id, avg(edge_length) + stddev_pop(edge_length) AS threshold FROM nodes WHERE NOT is_leaf AND parent_id IS NOT NULL GROUP BY 1)"
query("t2_node_table", f"SELECT * FROM {NODE_TABLE}")(lambda get: T.node_table(get("nodes")))
query("t3_edge_table", "SELECT tree_id, node_id AS child, parent_id AS parent, round(edge_length, 6) AS edge_length FROM nodes WHERE parent_id IS NOT NULL")(lambda get: T.edge_table(get("nodes")))
query("t4_leaves", "SELECT tree_id, node_id, pre FROM nodes WHERE is_leaf ORDER BY 1, 3")(lambda get: T.leaves(get("nodes")))
query("t5_clade_leaves", f"SELECT n.tree_id, n.node_id, x.node_id AS leaf FROM nodes n JOIN nodes x ON {UNDER} WHERE NOT n.is_leaf AND x.is_leaf")(lambda get: T.clade_leaves(get("nodes")))
query("t5_number_nodes", "SELECT tree_id, node_id, parent_id, is_leaf, round(edge_length, 6) AS edge_length, pre, last, depth, round(root_dist, 6) AS root_dist FROM nodes")(
    lambda get: T.number_nodes(get("nodes").select("tree_id", "node_id", "parent_id", "edge_length", F.col("pre").alias("place")))
)
query("t6_find_node", "SELECT tree_id, node_id, pre FROM nodes WHERE node_id = 'N7'")(lambda get: T.find_node(get("nodes"), "N7").select("tree_id", "node_id", "pre"))
query("t7_mrca", """
WITH k AS (SELECT tree_id, min(pre) AS lo, max(pre) AS hi FROM nodes WHERE is_leaf AND node_id IN (SELECT id FROM dear) GROUP BY 1), a AS (SELECT n.tree_id, arg_max(node_id, pre) AS mrca FROM nodes n JOIN k ON k.tree_id = n.tree_id AND pre <= lo AND last >= hi GROUP BY 1)
SELECT DISTINCT nodes.tree_id, mrca FROM nodes LEFT JOIN a ON a.tree_id = nodes.tree_id""")(lambda get: T.mrca(get("nodes"), get("dear")))
query("t8_pairwise_distances", f"""
WITH u AS (SELECT n.tree_id, n.root_dist AS up, x.node_id AS cell, x.root_dist AS r, n.pre AS np FROM nodes n JOIN nodes x ON {UNDER} WHERE NOT n.is_leaf AND x.is_leaf)
SELECT a.tree_id, a.cell AS cell_a, b.cell AS cell_b, round(CASE WHEN a.cell = b.cell THEN 0 ELSE any_value(a.r) + any_value(b.r) - 2 * max(a.up) END, 6) AS dist FROM u a JOIN u b ON a.tree_id = b.tree_id AND a.np = b.np GROUP BY 1, 2, 3""")(lambda get: T.pairwise_distances(get("nodes")))
query("t9_node_positions", """
WITH l AS (SELECT tree_id, node_id, parent_id, CAST(row_number() OVER (PARTITION BY tree_id ORDER BY pre) - 1 AS DOUBLE) AS y FROM nodes WHERE is_leaf),
s AS (SELECT n.tree_id, n.node_id, n.parent_id, avg(y) AS y FROM l JOIN nodes n ON n.tree_id = l.tree_id AND n.node_id = l.parent_id GROUP BY 1, 2, 3),
m AS (SELECT n.tree_id, n.node_id, n.parent_id, avg(y) AS y FROM s JOIN nodes n ON n.tree_id = s.tree_id AND n.node_id = s.parent_id GROUP BY 1, 2, 3),
r AS (SELECT n.tree_id, n.node_id, n.parent_id, avg(y) AS y FROM m JOIN nodes n ON n.tree_id = m.tree_id AND n.node_id = m.parent_id GROUP BY 1, 2, 3)
SELECT tree_id, node_id, round(root_dist, 6) AS x, round(y, 6) AS y FROM (SELECT * FROM l UNION ALL SELECT * FROM s UNION ALL SELECT * FROM m UNION ALL SELECT * FROM r) JOIN nodes USING (tree_id, node_id)""")(lambda get: T.node_positions(get("nodes")))
query("t10_cut_threshold", f"SELECT tree_id, round(threshold, 6) AS threshold FROM {THRESHOLD}")(lambda get: T.cut_threshold(get("nodes")))
query("t11_boundary_nodes", f"SELECT tree_id, node_id, round(edge_length, 6) AS edge_length, n_leaves FROM nodes JOIN {LEAVES} USING (tree_id, node_id) JOIN {THRESHOLD} USING (tree_id) WHERE NOT is_leaf AND parent_id IS NOT NULL AND edge_length > threshold AND n_leaves >= 5")(
    lambda get: T.select_boundary_nodes(get("nodes"), 5)
)


def cut_sql(least: int, rounds: int = 8) -> list[str]:
    """Common table expressions ``p0`` to ``p{rounds}``: the parts after each round of cuts."""
    out = ["p0 AS (SELECT tree_id, node_id AS cell_id, pre, '' AS part FROM nodes WHERE is_leaf)", f"cand AS (SELECT * FROM nodes JOIN {THRESHOLD} USING (tree_id) WHERE NOT is_leaf AND parent_id IS NOT NULL AND edge_length >= threshold)"]
    for i in range(1, rounds + 1):
        out.append(f"n{i} AS (SELECT tree_id, part, count(*) AS n FROM p{i - 1} GROUP BY 1, 2 HAVING count(*) >= {2 * least})")
        out.append(f"""c{i} AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY tree_id, part ORDER BY edge_length DESC, f) AS k FROM (
  SELECT p.tree_id, p.part, c.pre AS f, c.last AS l, c.edge_length, count(*) AS b, any_value(n) AS n FROM p{i - 1} p JOIN n{i} USING (tree_id, part) JOIN cand c ON c.tree_id = p.tree_id AND p.pre BETWEEN c.pre AND c.last GROUP BY ALL) WHERE b >= {least} AND n - b >= {least}) WHERE k = 1)""")
        out.append(f"p{i} AS (SELECT p.tree_id, cell_id, pre, CASE WHEN f IS NULL THEN p.part WHEN pre BETWEEN f AND l THEN p.part || '0' ELSE p.part || '1' END AS part FROM p{i - 1} p LEFT JOIN c{i} c ON c.tree_id = p.tree_id AND c.part = p.part)")
    return [*out, f"cut AS (SELECT tree_id, 'clade_' || dense_rank() OVER (PARTITION BY tree_id ORDER BY part) AS clone_id, cell_id, part FROM p{rounds})"]


query("t12_cut_into_clones", f"WITH {', '.join(cut_sql(10))} SELECT * FROM cut")(lambda get: T.cut_into_clones(get("nodes"), 10))
_FINAL = "SELECT tree_id, cell_id, 'clone_' || lpad(CAST(dense_rank() OVER (PARTITION BY tree_id ORDER BY clone_id) AS STRING), 3, '0') AS clone_id, 'internal_node' AS strategy, flagged, 1.0 AS confidence FROM ({0})"
_CAP = merge_sql("SELECT tree_id, clone_id, count(*) AS n, CAST(regexp_extract(clone_id, '([0-9]+)$', 1) AS INT) AS p FROM cut GROUP BY 1, 2", 6, 24)
query("c3_internal_node", f"""WITH {", ".join([*cut_sql(10), *_CAP])}, k AS (SELECT tree_id, cell_id, r24.now AS clone_id FROM cut JOIN r24 USING (tree_id, clone_id))
{_FINAL.format("SELECT *, count(*) OVER (PARTITION BY tree_id, clone_id) < 10 AS flagged FROM k WHERE cell_id IN (SELECT cell_id FROM cells)")}""")(lambda get: G.assign_clones("internal_node", get("nodes"), get("cells"), min_cells=10, max_clones=6))
query("c9_assignments_merged", f"""WITH {", ".join(cut_sql(12))}, k AS (SELECT tree_id, clone_id, cell_id FROM cut WHERE cell_id IN (SELECT id FROM ids)),
z AS (SELECT tree_id, clone_id, count(*) AS n, row_number() OVER (PARTITION BY tree_id ORDER BY count(*) DESC, clone_id) AS r FROM k GROUP BY 1, 2)
{_FINAL.format("SELECT k.tree_id, cell_id, CASE WHEN z.n >= 12 THEN k.clone_id WHEN t.n < 12 THEN 'clone_merged' ELSE t.clone_id END AS clone_id, false AS flagged FROM k JOIN z USING (tree_id, clone_id) JOIN z t ON t.tree_id = k.tree_id AND t.r = 1")}""")(lambda get: G.assign_clones("internal_node", get("nodes"), get("ids").withColumnRenamed("id", "cell_id"), min_cells=12, small="merge"))
query("t13_cut_at_nodes", f"""
SELECT x.tree_id, coalesce(arg_min(n.node_id, l.n_leaves), 'unassigned') AS clone_id, x.node_id AS cell_id FROM nodes x LEFT JOIN (SELECT * FROM nodes WHERE node_id IN ('N1', 'N5', 'N8_BUILDING', 'N8')) n ON {UNDER} LEFT JOIN {LEAVES} l ON l.tree_id = n.tree_id AND l.node_id = n.node_id
WHERE x.is_leaf GROUP BY x.tree_id, x.node_id""")(lambda get: T.cut_at_nodes(get("nodes"), ["N8", "N1", "N5", "N8_BUILDING"]))
ASSIGNED = "(SELECT cell AS cell_id, s AS clone_id FROM labelled JOIN ids ON id = cell)"
query("t14_node_clones", f"""
SELECT n.tree_id, n.node_id, array_to_string(list_sort(list(DISTINCT clone_id) FILTER (clone_id IS NOT NULL)), ',') AS label FROM nodes n JOIN nodes x ON {UNDER} AND x.is_leaf LEFT JOIN {ASSIGNED} a ON a.cell_id = x.node_id GROUP BY 1, 2""".replace("array_to_string(list_sort(list(DISTINCT clone_id) FILTER (clone_id IS NOT NULL)), ',')", "coalesce(array_to_string(list_sort(list(DISTINCT clone_id) FILTER (clone_id IS NOT NULL)), ','), '')"))(
    lambda get: T.annotate_nodes_with_clones(get("nodes"), get("labelled").join(get("ids"), F.col("id") == F.col("cell")).select(F.col("cell").alias("cell_id"), F.col("s").alias("clone_id")))
)
query("j2_nodes_with_events", f"""
SELECT t.*, coalesce(k, 0) AS n_events, coalesce(e, '') AS event_summary FROM {NODE_TABLE} t
LEFT JOIN (SELECT child_node, CAST(count(*) AS INT) AS k, array_to_string(list_sort(list(DISTINCT event_type)), ';') AS e FROM branch_events GROUP BY 1) ON child_node = node_id""")(lambda get: T.annotate_nodes_with_events(get("nodes"), get("branch_events")))
_UP = "SELECT n.tree_id, n.parent_id, n.pre, '(' || string_agg(x.t, ',' ORDER BY x.pre) || ')' || n.node_id || CASE WHEN n.parent_id IS NULL THEN ';' ELSE ':' || CAST(n.edge_length AS VARCHAR) END AS t FROM {0} x JOIN nodes n ON n.tree_id = x.tree_id AND n.node_id = x.parent_id GROUP BY n.tree_id, n.node_id, n.parent_id, n.pre, n.edge_length"
query("s10_to_newick", f"WITH l AS (SELECT tree_id, parent_id, pre, node_id || ':' || CAST(edge_length AS VARCHAR) AS t FROM nodes WHERE is_leaf), s AS ({_UP.format('l')}), m AS ({_UP.format('s')}), r AS ({_UP.format('m')}) SELECT tree_id, t AS newick FROM r")(lambda get: writers.to_newick(get("nodes")))
_NODES = "SELECT {0}node_id, parent_id, is_leaf, round(edge_length, 6) AS edge_length, pre, last, depth, round(root_dist, 6) AS root_dist FROM nodes"
query("t1_parse_trees", _NODES.format("tree_id, "))(lambda get: readers.parse_trees(writers.to_newick(get("nodes")).withColumnRenamed("newick", "value")))


@query("s3_read_newick", _NODES.format(""))
def _trees_from_files(get) -> DataFrame:
    """Newick files of all trees, written one a file and read back."""
    trees = writers.to_newick(get("nodes"))
    path = staging_path(trees.sparkSession)
    trees.repartition("tree_id").write.partitionBy("tree_id").text(path)
    return readers.read_newick(trees.sparkSession, f"{path}/tree_id=*").drop("tree_id")


query("w3_longest_edges", f"""
WITH l AS (SELECT tree_id, pre FROM nodes WHERE is_leaf), k AS (SELECT tree_id, count(*) AS n FROM l GROUP BY 1 HAVING count(*) >= 20),
b AS (SELECT c.tree_id, c.pre AS f, c.last AS t, c.edge_length, count(*) AS below, any_value(n) AS n FROM nodes c JOIN {THRESHOLD} h USING (tree_id) JOIN k USING (tree_id) JOIN l ON l.tree_id = c.tree_id AND l.pre BETWEEN c.pre AND c.last
  WHERE NOT c.is_leaf AND c.parent_id IS NOT NULL AND c.edge_length >= threshold GROUP BY 1, 2, 3, 4)
SELECT tree_id, '' AS part, f AS first_pre, t AS last_pre FROM (SELECT *, row_number() OVER (PARTITION BY tree_id ORDER BY edge_length DESC, f) AS k FROM b WHERE below >= 10 AND n - below >= 10) WHERE k = 1""")(
    lambda get: T.longest_edges(T.sized_candidates(get("nodes")), 10).select("tree_id", "part", F.col("from").alias("first_pre"), F.col("to").alias("last_pre"))
)

# Reads ---------------------------------------------------------------------------------------------

query("p2_cell_qc_summary", """
SELECT clone_id, count(*) AS n_cells, round(count(*) / (SELECT count(*) FROM assignments) * 100, 2) AS pct_passed FROM assignments WHERE confidence >= 0.3 GROUP BY 1""")(lambda get: P.cell_qc_summary(get("cells"), get("assignments"), 0.3))
query("p3_low_cell_clones", "SELECT nat AS clone_id, count(*) AS n_cells FROM labelled GROUP BY 1 HAVING count(*) < 60")(
    lambda get: P.low_cell_clones(by_nation(get).groupBy("clone_id").agg(F.count("*").alias("n_cells")), 60)
)
query("p4_group_cells", "SELECT clone_id, count(*) AS n, array_to_string(list_sort(list(cell_id)), ',') AS cells FROM assignments GROUP BY 1")(
    lambda get: P.group_cells(P.filter_cells(get("cells"), get("assignments"))).select("clone_id", F.size("cells").cast("long").alias("n"), F.array_join(F.col("cells.cell_id"), ",").alias("cells"))
)
query("p5_clone_totals", """
SELECT clone_id, count(*) AS n_reads, CAST(sum("end" - start) AS BIGINT) AS n_bases, CAST(grouping(clone_id) AS INT) AS all_clones FROM reads GROUP BY ROLLUP (clone_id)""")(lambda get: P.clone_totals(get("reads")))
_B = lambda m: f"(flag & {m}) <> 0"
_PRIMARY = "(flag & 2304) = 0"
_PAIR = f"{_PRIMARY} AND {_B(1)}"
_OTHER = f"{_PAIR} AND NOT {_B(4)} AND NOT {_B(8)} AND chrom <> mate_chrom"
_FLAGS = {
    "total": "true", "primary": _PRIMARY, "secondary": _B(256), "supplementary": _B(2048), "duplicates": _B(1024), "mapped": f"NOT {_B(4)}", "paired": _PAIR, "read1": f"{_PAIR} AND {_B(64)}", "read2": f"{_PAIR} AND {_B(128)}",
    "properly_paired": f"{_PAIR} AND {_B(2)} AND NOT {_B(4)}", "both_mapped": f"{_PAIR} AND NOT {_B(4)} AND NOT {_B(8)}", "singletons": f"{_PAIR} AND NOT {_B(4)} AND {_B(8)}", "mate_other_chrom": _OTHER, "mate_other_chrom_mapq5": f"{_OTHER} AND mapq >= 5",
}
_STATS = "SELECT {0}, (flag & 512) <> 0 AS qc_failed, " + ", ".join(f'count_if({c}) AS "{n}"' for n, c in _FLAGS.items()) + " FROM reads GROUP BY 1, 2"
_PCT = 'SELECT *, round(mapped / nullif(total, 0) * 100, 2) AS mapped_pct, round(properly_paired / nullif(paired, 0) * 100, 2) AS properly_paired_pct, round(singletons / nullif(paired, 0) * 100, 2) AS singletons_pct FROM ({0})'
query("p6_flag_stats", _PCT.format(_STATS.format("clone_id")))(lambda get: P.flag_stats(get("reads")))
query("p6_flag_stats_by_cell", _PCT.format(_STATS.format("cell_id")))(lambda get: P.flag_stats(get("reads"), "cell_id"))
_TAKES = "(flag & 2308) = 0"
_FIVE = "CASE WHEN (flag & 16) <> 0 THEN \"end\" - 1 ELSE start END"
_MARKED = f"""(SELECT *, CASE WHEN {_TAKES} AND row_number() OVER (PARTITION BY clone_id, {{0}} chrom, {_FIVE}, flag & 16, mate_chrom, mate_start, flag & 32, {_TAKES}, CASE WHEN NOT ({_TAKES}) THEN read_id END ORDER BY base_quality DESC, read_id) > 1 THEN flag | 1024 ELSE flag END AS marked FROM reads)"""
query("w5_mark_duplicates", f"SELECT clone_id, cell_id, read_id, marked AS flag FROM {_MARKED.format('cell_id,')}")(lambda get: P.mark_duplicates(get("reads")).select("clone_id", "cell_id", "read_id", "flag"))
query("w5_mark_duplicates_across_cells", f"SELECT clone_id, cell_id, read_id, marked AS flag FROM {_MARKED.format('')}")(lambda get: P.mark_duplicates(get("reads"), across_cells=True).select("clone_id", "cell_id", "read_id", "flag"))
query("p7_duplicate_metrics", f"""
SELECT clone_id, count_if({_TAKES}) AS mapped_reads, count_if({_TAKES} AND (marked & 1024) <> 0) AS duplicates, round(CASE WHEN count_if({_TAKES}) > 0 THEN count_if({_TAKES} AND (marked & 1024) <> 0) / count_if({_TAKES}) ELSE 0 END, 6) AS dup_rate
FROM {_MARKED.format('')} GROUP BY 1""")(lambda get: P.marked_metrics(get("reads"), across_cells=True))
_BASES = """(SELECT clone_id, chrom, unnest(range(start, "end")) AS p FROM reads WHERE (flag & 1796) = 0)"""
_DEPTH = f"(SELECT clone_id, chrom, p, count(*) AS depth FROM {_BASES} GROUP BY ALL)"
_SIZES = "(SELECT DISTINCT chrom, 21000 AS length FROM reads)"


def chrom_sizes(get) -> DataFrame:
    return get("reads").select("chrom", F.lit(21000).cast("long").alias("length")).distinct()


query("p8_coverage_windows", f"""SELECT clone_id, chrom, CAST(floor(p / 500) AS BIGINT) * 500 AS start, CAST(floor(p / 500) AS BIGINT) * 500 + 500 AS "end", round(count(*) / 500, 6) AS mean_depth FROM {_BASES} GROUP BY 1, 2, 3, 4""")(lambda get: P.coverage_windows(get("reads")))
query("p8_coverage_summary", f"""
SELECT c.clone_id, s.chrom, CAST(length AS BIGINT) AS length, CAST(coalesce(sum(depth), 0) AS BIGINT) AS bases, round(coalesce(sum(depth), 0) / length, 6) AS mean_depth, CASE WHEN count(depth) < length THEN 0 ELSE min(depth) END AS min_depth, coalesce(max(depth), 0) AS max_depth
FROM (SELECT DISTINCT clone_id FROM reads) c CROSS JOIN {_SIZES} s LEFT JOIN {_DEPTH} d ON d.clone_id = c.clone_id AND d.chrom = s.chrom GROUP BY c.clone_id, s.chrom, s.length""")(lambda get: P.coverage_summary(get("reads"), chrom_sizes(get)))
query("p8_coverage_targets", f"""
WITH t AS (SELECT DISTINCT chrom, start, "end" FROM bed), g AS (SELECT t.*, clone_id FROM t CROSS JOIN (SELECT DISTINCT clone_id FROM reads))
SELECT g.clone_id, g.chrom, g.start, g."end", CAST(coalesce(sum(depth), 0) AS BIGINT) AS bases, round(coalesce(sum(depth), 0) / (g."end" - g.start), 6) AS mean_depth, coalesce(max(depth), 0) AS max_depth, count(depth) AS covered
FROM g LEFT JOIN {_DEPTH} d ON d.clone_id = g.clone_id AND d.chrom = g.chrom AND p >= start AND p < "end" GROUP BY 1, 2, 3, 4""")(lambda get: P.coverage_targets(get("reads"), get("bed")))
_DIST = f"""(WITH k AS (SELECT clone_id, depth, count(*) AS bases FROM {_DEPTH} GROUP BY 1, 2), t AS (SELECT sum(length) AS total FROM {_SIZES}),
a AS (SELECT clone_id, depth, bases FROM k UNION ALL SELECT clone_id, 0, any_value(total) - sum(bases) FROM k, t GROUP BY 1)
SELECT clone_id, depth, CAST(bases AS BIGINT) AS bases, sum(bases) OVER (PARTITION BY clone_id ORDER BY depth DESC) / total AS share_at_least FROM a, t)"""
query("p8_coverage_distribution", f"SELECT clone_id, depth, bases, round(share_at_least, 6) AS share_at_least FROM {_DIST}")(lambda get: P.coverage_distribution(get("reads"), chrom_sizes(get)))
query("p8_coverage_headline", f"""SELECT clone_id, max(CASE WHEN share_at_least >= 0.5 THEN depth END) AS median_depth, {", ".join(f"round(100 * coalesce(max(CASE WHEN depth >= {d} THEN share_at_least END), 0), 4) AS pct_{d}x" for d in (1, 5, 10, 30))} FROM {_DIST} GROUP BY 1""")(
    lambda get: P.coverage_headline(P.coverage_distribution(get("reads"), chrom_sizes(get)))
)
query("w6_depth_runs", f"""SELECT clone_id, chrom, CAST(floor(p / 500) AS BIGINT) AS tile, CAST(sum(depth) AS BIGINT) AS bases, max(depth) AS top FROM {_DEPTH} GROUP BY 1, 2, 3""")(
    lambda get: P._steps(get("reads"), 500).groupBy("clone_id", "chrom", "tile").agg(F.sum((F.col("until") - F.col("pos")) * F.col("depth")).alias("bases"), F.max("depth").alias("top"))
)
query("l1_build_pseudobulk", "SELECT a.clone_id, r.cell_id, read_id, chrom, start FROM reads r JOIN assignments a USING (cell_id)")(lambda get: P.build_pseudobulk(get("reads"), get("assignments")).select("clone_id", "cell_id", "read_id", "chrom", "start"))

# Report --------------------------------------------------------------------------------------------

_OVERVIEW = f"""
SELECT (SELECT count(DISTINCT clone_id) FROM assignments) AS n_clones, (SELECT count(*) FROM assignments) AS n_assigned_cells,
  (SELECT count(*) FROM (SELECT 1 FROM {SUPPORT} GROUP BY {KEYS} HAVING max(n_callers) >= 2)) AS n_consensus, (SELECT count(*) FROM (SELECT DISTINCT {KEYS} FROM {PASSED})) AS n_unique_positions, 'ok' AS status"""
query("q1_run_overview", _OVERVIEW)(
    lambda get: R.run_overview(G.clone_summary(get("assignments"), get("cn_events")), X.consensus_variants(passed(get)), X.all_keys(passed(get)))
)
query("q2_sharing_counts", f"SELECT sharing_class, count(*) AS n FROM {SHARING} GROUP BY 1")(lambda get: R.sharing_counts(X.variant_sharing(passed(get), get("files"))))
query("q3_qc_table", f"""
WITH f AS (SELECT clone_id, count(*) AS total, count_if((flag & 4) = 0) AS mapped, round(count_if({_TAKES} AND (flag & 1024) <> 0) / count_if({_TAKES}), 6) AS dup_rate FROM reads GROUP BY 1),
c AS (SELECT clone_id, round(count(*) / (SELECT sum(length) FROM {_SIZES}), 6) AS mean_depth FROM {_BASES} GROUP BY 1), k AS (SELECT clone_id, count(*) AS records, count(*) AS snps FROM calls GROUP BY 1)
SELECT clone_id, total, mapped, dup_rate, mean_depth, records, snps FROM f FULL JOIN c USING (clone_id) FULL JOIN k USING (clone_id)""")(
    lambda get: R.qc_table(P.flag_stats(get("reads")), P.duplicate_metrics(get("reads")), P.coverage_summary(get("reads"), chrom_sizes(get)).groupBy("clone_id").agg((F.sum("bases") / F.sum("length")).alias("mean_depth")), K.caller_stats(get("calls")))
)
_DUPLICATES = f"(SELECT clone_id, count_if({_TAKES}) AS m, count_if({_TAKES} AND (marked & 1024) <> 0) AS d FROM {_MARKED.format('')} GROUP BY 1)"
#: Bisection as in the operator: doublings until the end lies beyond the root, then halves.
_LIBRARY = f"""(WITH RECURSIVE t AS (
  SELECT clone_id, CAST(m AS DOUBLE) AS n, CAST(m - d AS DOUBLE) AS c, CAST(m - d AS DOUBLE) AS lo, CAST(m - d AS DOUBLE) AS hi, 0 AS k FROM {_DUPLICATES} WHERE d > 0 AND m > d
  UNION ALL
  SELECT clone_id, n, c, CASE WHEN k >= 64 AND c / ((lo + hi) / 2) - 1 + exp(-n / ((lo + hi) / 2)) > 0 THEN (lo + hi) / 2 ELSE lo END,
    CASE WHEN k < 64 THEN CASE WHEN c / hi - 1 + exp(-n / hi) > 0 THEN 2 * hi ELSE hi END WHEN c / ((lo + hi) / 2) - 1 + exp(-n / ((lo + hi) / 2)) > 0 THEN hi ELSE (lo + hi) / 2 END, k + 1 FROM t WHERE k < 128)
SELECT clone_id, CAST(round(hi) AS BIGINT) AS library_size FROM t WHERE k = 128)"""
query("p7_library_size", f"SELECT clone_id, library_size FROM {_DUPLICATES} LEFT JOIN {_LIBRARY} USING (clone_id)")(lambda get: P.library_sizes(P.marked_metrics(get("reads"), across_cells=True)))
# Calls of which some are longer than a base, and some have two alternatives.
_LONGER = "(SELECT clone_id, caller, ref, CASE WHEN pos % 300 = 0 THEN alt || 'T' WHEN pos % 1100 = 0 THEN alt || ',' || ref || 'C' ELSE alt END AS alt FROM calls)"


def _longer(get) -> DataFrame:
    alt = F.when(F.col("pos") % 300 == 0, F.concat("alt", F.lit("T"))).when(F.col("pos") % 1100 == 0, F.concat("alt", F.lit(","), "ref", F.lit("C"))).otherwise(F.col("alt"))
    return get("calls").withColumn("alt", alt)


_KINDS = """count(*) AS records, count_if(length(alt) = 1) AS snps, count_if(length(alt) = 2) AS indels, CAST(count_if(contains(alt, ',')) AS BIGINT) AS multiallelic,
  count_if(ref || alt IN ('AG', 'GA', 'CT', 'TC')) AS ts, count_if(length(alt) = 1 AND ref || alt NOT IN ('AG', 'GA', 'CT', 'TC')) AS tv"""
query("m8_caller_stats_by_kind", f"""
SELECT clone_id, caller, records, snps, indels, CAST(0 AS BIGINT) AS others, multiallelic, ts AS transitions, tv AS transversions, round(ts / nullif(tv, 0), 6) AS ts_tv
FROM (SELECT clone_id, caller, {_KINDS} FROM {_LONGER} GROUP BY 1, 2)""")(lambda get: K.caller_stats(_longer(get)))
_FIVES = ", ".join(f"max(CASE WHEN depth >= {d} THEN share_at_least END) AS s{d}" for d in (1, 5, 10, 30))
query("q3_qc_details", f"""
WITH f AS (SELECT clone_id, count(*) AS total, count_if((flag & 4) = 0) AS mapped, count_if({_PAIR}) AS pairs, count_if({_PAIR} AND {_B(2)} AND NOT {_B(4)}) AS proper FROM reads GROUP BY 1),
d AS (SELECT clone_id, CASE WHEN m > 0 THEN d / m ELSE 0 END AS dup_rate FROM {_DUPLICATES}),
c AS (SELECT clone_id, count(*) / (SELECT sum(length) FROM {_SIZES}) AS mean_depth FROM {_BASES} GROUP BY 1),
h AS (SELECT clone_id, max(CASE WHEN share_at_least >= 0.5 THEN depth END) AS median_depth, {_FIVES} FROM {_DIST} GROUP BY 1),
k AS (SELECT clone_id, {_KINDS} FROM {_LONGER} GROUP BY 1)
SELECT clone_id, total, mapped, round(100 * mapped / total, 2) AS mapped_pct, round(100 * proper / nullif(pairs, 0), 2) AS properly_paired_pct, round(dup_rate, 6) AS dup_rate, library_size, round(mean_depth, 6) AS mean_depth, median_depth,
  {", ".join(f"round(100 * coalesce(s{d}, 0), 4) AS pct_{d}x" for d in (1, 5, 10, 30))}, records, snps, indels, multiallelic, round(ts / nullif(tv, 0), 6) AS ts_tv
FROM f FULL JOIN d USING (clone_id) FULL JOIN {_LIBRARY} USING (clone_id) FULL JOIN c USING (clone_id) FULL JOIN h USING (clone_id) FULL JOIN k USING (clone_id)""")(
    lambda get: R.qc_details(
        P.flag_stats(get("reads")), P.marked_metrics(get("reads"), across_cells=True),
        P.coverage_summary(get("reads"), chrom_sizes(get)).groupBy("clone_id").agg((F.sum("bases") / F.sum("length")).alias("mean_depth")),
        P.coverage_headline(P.coverage_distribution(get("reads"), chrom_sizes(get))), K.caller_stats(_longer(get)),
    )
)
query("x4_caller_concordance_of_finders", f"""
SELECT n.clone_id, n_callers, count(k) AS n_variants_any, count_if(k >= n_callers) AS n_variants_all, count_if(k >= 2) AS n_variants_2plus,
  round(CASE WHEN count(k) > 0 THEN count_if(k >= n_callers) / count(k) ELSE 0 END, 6) AS concordance_rate
FROM (SELECT clone_id, count(DISTINCT caller) AS n_callers FROM calls GROUP BY 1) n
LEFT JOIN (SELECT clone_id, {KEYS}, count(DISTINCT caller) AS k FROM {PASSED} GROUP BY ALL) s USING (clone_id) GROUP BY 1, 2""")(
    lambda get: X.caller_concordance(passed(get), get("calls").select("clone_id", "caller").distinct())
)
# Reads clipped at both ends, with five bases of the reference left out after the first twenty.
_CLIPPED = """(SELECT *, flag % 7 AS lead, flag % 5 AS trail FROM reads)"""
_CLIPPED_FIVE = "CASE WHEN (flag & 16) <> 0 THEN \"end\" + 5 + trail - 1 ELSE start - lead END"


def _clipped(get) -> DataFrame:
    text = lambda c: c.cast("string")
    size = F.col("end") - F.col("start")
    cut = lambda n: F.when(n > 0, F.concat(text(n), F.lit("S"))).otherwise("")
    reads = get("reads").withColumn("cigar", F.concat(F.lit("2H"), cut(F.col("flag") % 7), F.lit("20M5D"), text(size - 20), F.lit("M"), cut(F.col("flag") % 5)))
    return reads.withColumn("seq", F.concat(F.repeat(F.lit("N"), F.col("flag") % 7), F.expr("substring(repeat('ACGT', 40), cast(start % 4 as int) + 1, cast(`end` - start as int))"), F.repeat(F.lit("N"), F.col("flag") % 5)))


query("w5_clipped_reads", f"SELECT clone_id, cell_id, read_id, marked AS flag FROM {_MARKED.format('cell_id,')}".replace(_FIVE, _CLIPPED_FIVE).replace("FROM reads)", f"FROM {_CLIPPED})"))(
    lambda get: P.mark_duplicates(_clipped(get)).select("clone_id", "cell_id", "read_id", "flag")
)


@query("p9_pileup_gaps", """
WITH used AS (SELECT clone_id, chrom, start, "end" FROM reads WHERE (flag & 1796) = 0),
b AS (SELECT clone_id, chrom, start, unnest(range(start, "end")) AS p FROM used),
c AS (SELECT clone_id, chrom, p + CASE WHEN p - start >= 20 THEN 6 ELSE 1 END AS pos, substr('ACGT', CAST(p % 4 AS INT) + 1, 1) AS alt, count(*) AS n_alt FROM b GROUP BY ALL)
SELECT clone_id, chrom, CAST(floor(pos / 100) AS BIGINT) AS place, alt, CAST(sum(n_alt) AS BIGINT) AS n_alt, count(*) AS positions FROM c GROUP BY ALL""")
def _gaps(get) -> DataFrame:
    reads = _clipped(get)
    chunks = reads.groupBy("chrom").agg(F.max("end").alias("top")).select("chrom", F.explode(F.sequence(F.lit(0), F.floor(F.col("top") / 1000))).alias("chunk_index"), F.lit("ACGA" * 250).alias("sequence"))
    found = K.pileup_counts(reads, chunks, 1000)
    return found.groupBy("clone_id", "chrom", F.floor(F.col("pos") / 100).alias("place"), "alt").agg(F.sum("n_alt").alias("n_alt"), F.count("*").alias("positions"))


query("l4_preview", f"SELECT *, (SELECT count(*) FROM (SELECT 1 FROM {SUPPORT} GROUP BY {KEYS} HAVING max(n_callers) >= 2)) - 20 AS n_more FROM (SELECT {KEYS}, max(n_callers) AS max_callers FROM {SUPPORT} GROUP BY {KEYS} HAVING max(n_callers) >= 2 ORDER BY 1, 2, 3, 4 LIMIT 20)")(
    lambda get: R.preview(X.consensus_variants(passed(get)), R.TEXT_ROWS, *C.KEY)
)

# Reads and writes: tables are written to the shared folder and read back --------------------------


def _path(df: DataFrame, name: str) -> str:
    return f"{staging_path(df.sparkSession)}/{name}"


@query("s1_read_manifest", "SELECT cell_id, bam_path, coalesce(nullif(bai_path, ''), bam_path || '.bai') AS bai_path, sample_id, patient_id FROM cells")
def _manifest(get) -> DataFrame:
    path = _path(get("cells"), "cells.csv")
    writers.write_table(get("cells"), path)
    return readers.read_manifest(get("cells").sparkSession, path, "bam")


@query("s2_read_events", 'SELECT cell_id, chr, start, "end", event_type FROM cn_events')
def _events(get) -> DataFrame:
    path = _path(get("cn_events"), "events.tsv")
    get("cn_events").write.option("header", True).option("sep", "\t").csv(path)
    return readers.read_events(get("cn_events").sparkSession, path)


@query("s5_read_reads", 'SELECT read_id, chrom, start, "end", cigar, mapq, flag, mate_chrom, mate_start, 40 * ("end" - start) AS base_quality FROM reads')
def _sam(get) -> DataFrame:
    reads = get("reads")
    size = (F.col("end") - F.col("start")).cast("int")
    text = lambda c: F.col(c).cast("string")
    mate = F.when(F.col("mate_chrom") == F.col("chrom"), "=").otherwise(F.col("mate_chrom"))
    line = F.concat_ws("\t", "read_id", text("flag"), "chrom", (F.col("start") + 1).cast("string"), text("mapq"), "cigar", mate, (F.col("mate_start") + 1).cast("string"), F.lit("0"), F.repeat(F.lit("A"), size), F.repeat(F.lit("I"), size))
    path = _path(reads, "reads")
    reads.select(line.alias("value")).write.option("compression", "gzip").text(path)
    return readers.read_reads(reads.sparkSession, path).drop("cell_id", "seq")


@query("s6_write_per_clone", f"SELECT clone_id, caller, {KEYS}, round(qual, 6) AS qual, filters FROM {PASSED}")
def _per_clone(get) -> DataFrame:
    rows = X.per_clone_variants(passed(get))
    path = _path(rows, "clones")
    writers.write_per_clone(rows, path)
    back = rows.sparkSession.read.option("header", True).option("sep", "\t").csv(path)
    return back.withColumns({"pos": F.col("pos").cast("long"), "qual": F.col("qual").cast("double")})


@query("s7_write_table", f"SELECT * FROM {SHARING}")
def _table(get) -> DataFrame:
    rows = X.variant_sharing(passed(get), get("files"))
    path = _path(rows, "sharing.csv")
    writers.write_table(rows, path)
    return rows.sparkSession.read.option("header", True).csv(path).withColumns({c: F.col(c).cast("long") for c in ("pos", "n_clones_with_variant")})


@query("s9_write_report", _OVERVIEW)
def _report(get) -> DataFrame:
    report = R.run_overview(G.clone_summary(get("assignments"), get("cn_events")), X.consensus_variants(passed(get)), X.all_keys(passed(get)))
    path = _path(report, "report.json")
    writers.write_report(report, path)
    return report.sparkSession.read.schema(report.schema).json(path)
