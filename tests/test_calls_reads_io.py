import gzip
import random

import pytest
from pyspark.sql import Row
from pyspark.sql import functions as F
from example import NEWICK, nodes

from cladeworks.functions.cigar import aligned_runs, five_prime, reference_length
from cladeworks.operators import alignment
from cladeworks.operators import calls as K
from cladeworks.operators import compare as X
from cladeworks.operators import intervals
from cladeworks.operators import pseudobulk as P
from cladeworks.operators import tree as T
from cladeworks.sources import readers, writers

HEAD = "##fileformat=VCFv4.2\n#CHROM\tPOS\tID\tREF\tALT\tQUAL\tFILTER\tINFO\n"
FILES = {
    "A.mutect2": ["chr1\t100\t.\tA\tG\t50\tPASS\tDP=3", "chr1\t100\t.\tA\tG\t40\tPASS\tDP=2", "chr1\t200\t.\tC\t.\t.\t.\tDB"],
    "A.strelka2": ["chr1\t100\t.\tA\tG\t.\tweak;PASS\t", "chr2\t5\t.\tT\tC,G\t9\tweak\tDP=1"],
    "B.x.freebayes": ["chr2\t5\t.\tT\tC,G\t9\t.\tDP=1"],
    "A.quiet": [],
}


@pytest.fixture(scope="module")
def vcf_dir(tmp_path_factory):
    d = tmp_path_factory.mktemp("vcf")
    for name, lines in FILES.items():
        with gzip.open(d / f"{name}.norm.vcf.gz", "wt") as f:
            f.write(HEAD + "".join(f"{x}\n" for x in lines))
    (d / "odd.vcf").write_text(HEAD + "chr9\t1\t.\tA\tC\t.\tPASS\t\n")
    return str(d)


def test_vcf_files(spark, vcf_dir, tmp_path):
    calls, files = readers.read_vcf(spark, vcf_dir), readers.vcf_files(spark, vcf_dir)
    assert {(r.clone_id, r.caller) for r in files.collect()} == {("A", "mutect2"), ("A", "strelka2"), ("B.x", "freebayes"), ("A", "quiet")}
    assert calls.count() == 6
    kept = K.pass_filter(calls)
    assert kept.count() == 5
    assert {r.alt for r in calls.filter("pos = 200").collect()} == {""}
    a = X.caller_concordance(kept, files).filter("clone_id = 'A'").first()
    assert (a.n_callers, a.n_variants_any, a.n_variants_all, a.n_variants_2plus, a.concordance_rate) == (3, 2, 0, 1, 0.0)
    assert {(r.pos, r.sharing_class) for r in X.variant_sharing(kept, files).collect()} == {(100, "private"), (200, "private"), (5, "private")}
    assert [r.pos for r in X.consensus_variants(kept).collect()] == [100]
    wide = X.presence_matrix(kept, files).toPandas()
    assert wide["A.quiet"].sum() == 0 and wide["A.mutect2"].sum() == 2
    with pytest.raises(ValueError):
        X.presence_matrix(kept, files, max_columns=2)
    assert {r.jaccard for r in X.clone_similarity(kept, files).filter("clone_a <> clone_b").collect()} == {0.0}
    out = str(tmp_path / "consensus")
    writers.write_vcf(X.consensus_info(kept), out)
    lines = [r.value for r in spark.read.text(out).collect()]
    assert lines[0] == "##fileformat=VCFv4.2" and "chr1\t100\t.\tA\tG\t.\tPASS\tN_CLONES=1;CALLERS=mutect2,strelka2" in lines
    writers.write_per_clone(X.per_clone_variants(kept), str(tmp_path / "per"))
    back = spark.read.option("header", True).option("sep", "\t").csv(str(tmp_path / "per"))
    assert {(r["clone_id"], r["count"]) for r in back.groupBy("clone_id").count().collect()} == {("A", 4), ("B.x", 1)}


@pytest.mark.parametrize("n", [1, 2, 3])
def test_sharing_classes_of_few_clones(spark, n):
    rows = [(f"c{i}", "m", "chr1", 1, "A", "G") for i in range(n)] + [("c0", "m", "chr1", 2, "A", "G")]
    calls = spark.createDataFrame(rows, "clone_id string, caller string, chrom string, pos long, ref string, alt string")
    got = {r.pos: r.sharing_class for r in X.variant_sharing(calls, calls).collect()}
    assert got == {1: "private" if n == 1 else "shared", 2: "private"}
    assert X.variant_sharing(calls.limit(0), calls).count() == 0


def test_trees_and_tables_round_trip(spark, tmp_path):
    (tmp_path / "one.new").write_text(NEWICK)
    got = readers.read_newick(spark, str(tmp_path / "one.new"))
    assert got.select("tree_id").distinct().first()[0] == "one"
    assert got.drop("tree_id").exceptAll(nodes(spark).drop("tree_id")).count() == 0
    assert writers.to_newick(nodes(spark)).first().newick.startswith("((((CELL_001:0.05,CELL_002:0.05)node_A:0.2")
    assert {r.node_id: r.y for r in T.node_positions(nodes(spark)).collect()}["node_A"] == 0.5
    (tmp_path / "e.tsv").write_text("cell_id\tchr\tstart\tend\tevent_type\tmore\nc\tchr1\t1\t2\tgain\tx\n")
    e = readers.read_events(spark, str(tmp_path / "e.tsv")).first()
    assert (e.start, e.more) == (1, "x")
    (tmp_path / "m.csv").write_text("cell_id,bam_path,bai_path,sample_id,patient_id\nc,/a.bam,,s,p\n")
    assert readers.read_manifest(spark, str(tmp_path / "m.csv"), "bam").first().bai_path == "/a.bam.bai"
    with pytest.raises(ValueError):
        readers.read_manifest(spark, str(tmp_path / "m.csv"), "events")
    writers.write_report(spark.range(1).selectExpr("'ok' AS status"), str(tmp_path / "r"))
    assert spark.read.json(str(tmp_path / "r")).first().status == "ok"
    writers.write_table(spark.range(3).toDF("x"), str(tmp_path / "t"))
    assert spark.read.option("header", True).csv(str(tmp_path / "t")).count() == 3


def test_sam_duplicates_and_coverage(spark, tmp_path):
    line = "\t".join
    rows = [
        line(["r1", "99", "chr1", "11", "60", "5S10M", "=", "101", "0", "A" * 15, "I" * 15]),
        line(["r2", "99", "chr1", "11", "60", "5S10M", "=", "101", "0", "A" * 15, "#" * 15]),
        line(["r3", "99", "chr1", "6", "60", "15M", "=", "101", "0", "A" * 15, "5" * 15]),
        line(["r4", "4", "*", "0", "0", "*", "*", "0", "0", "*", "*"]),
    ]
    for c in ("c1", "c2"):
        (tmp_path / f"{c}.sam").write_text("@HD\tVN:1.6\n" + "\n".join(rows) + "\n")
    reads = readers.read_reads(spark, str(tmp_path))
    bulk = P.build_pseudobulk(reads, spark.createDataFrame([("c1", "k"), ("c2", "k")], "cell_id string, clone_id string"))
    kept = lambda df: {(r.cell_id, r.read_id) for r in df.filter("(flag & 1024) = 0").collect()}
    assert kept(P.mark_duplicates(bulk)) == {(c, r) for c in ("c1", "c2") for r in ("r1", "r4")}
    assert {r for _, r in kept(P.mark_duplicates(bulk, across_cells=True))} == {"r1", "r4"}
    assert len(kept(P.mark_duplicates(bulk, across_cells=True))) == 3
    assert P.mark_duplicates(bulk, enabled=False) is bulk
    cover = P.coverage_windows(bulk, tile=10)
    assert sum(r.mean_depth * 10 for r in cover.collect()) == 2 * (10 + 10 + 15)
    sizes = spark.createDataFrame([("chr1", 100)], "chrom string, length long")
    s = P.coverage_summary(bulk, sizes, 10).first()
    assert (s.bases, s.min_depth, s.max_depth) == (70, 0, 6)
    d = {r.depth: r.bases for r in P.coverage_distribution(bulk, sizes, 10).collect()}
    assert sum(d.values()) == 100 and d[0] == 85
    f = P.flag_stats(bulk).first()
    assert (f.total, f.mapped, f.paired, f.read1) == (8, 6, 6, 6)


def step_by_step(seq, pos, ref, alt):
    """Left alignment of one variant by single steps."""
    at = pos - 1
    if at < 0 or not ref or seq[at : at + len(ref)] != ref:
        return pos, ref, alt, False
    moving = ref != alt
    while moving:
        moving = False
        if ref and alt and ref[-1] == alt[-1]:
            ref, alt, moving = ref[:-1], alt[:-1], True
        if not ref or not alt:
            if at == 0:
                after = seq[len(ref)]
                return 1, ref + after, alt + after, True
            at, moving = at - 1, True
            ref, alt = seq[at] + ref, seq[at] + alt
    while len(ref) > 1 and len(alt) > 1 and ref[0] == alt[0] and ref != alt:
        ref, alt, at = ref[1:], alt[1:], at + 1
    return at + 1, ref, alt, True


@pytest.mark.parametrize("chunk", [4, 16, 1000])
def test_left_alignment_over_any_distance(spark, chunk):
    rnd = random.Random(1)
    seqs = {"runs": "AC" + "T" * 400 + "GATC" * 30 + "A" * 5, "start": "T" * 90 + "GTGTGT", "mixed": "".join(rnd.choice(["A" * rnd.randint(1, 9), "CA" * rnd.randint(1, 12), "GTA" * rnd.randint(1, 6), "C"]) for _ in range(60))}
    rows = [("runs", 380, "TT", "T"), ("runs", 402, "T", "TTTT"), ("start", 90, "T", "TT"), ("start", 80, "TTT", "T"), ("runs", 3, "T" * 300 + "T", "T"), ("runs", 5, "G", "C"), ("runs", 5, "T", "<DEL>"), ("none", 5, "T", "TT"), ("runs", 0, "A", "AC"), (None, 5, "T", "TT"), ("runs", 5, "T", None)]
    for chrom, seq in seqs.items():
        for _ in range(120):
            p, n, m = rnd.randint(1, len(seq) - 50), rnd.randint(1, 40), rnd.randint(1, 40)
            ref = seq[p - 1 : p - 1 + n]
            alt = rnd.choice([ref[: rnd.randint(1, n)], ref + seq[p - 1 + n :][:m], ref[0] + ref, ref + "".join(rnd.choice("ACGT") for _ in range(m % 4 + 1)), "ACGT"[m % 4]])
            rows.append((chrom, p, ref, alt))
    rows += rows[:5]
    reference = spark.createDataFrame([(c, i // chunk, s[i : i + chunk]) for c, s in seqs.items() for i in range(0, len(s), chunk)], "chrom string, chunk_index int, sequence string")
    calls = spark.createDataFrame([(*r, 1, "x") for r in rows], "chrom string, pos long, ref string, alt string, id int, bases string")
    got = sorted(alignment.left_align(calls, reference, chunk).select("chrom", "pos", "ref", "alt", "ref_matches").collect(), key=str)
    odd = {"<DEL>": True, None: False}
    want = [(c, p, r, a, odd[a]) if a in odd else (c, *step_by_step(seqs.get(c, ""), p, r, a)) for c, p, r, a in rows]
    assert [tuple(r) for r in got] == sorted(((c, p, r, a, bool(k)) for c, p, r, a, k in want), key=lambda x: str(Row(chrom=x[0], pos=x[1], ref=x[2], alt=x[3], ref_matches=x[4])))


@pytest.mark.parametrize("few", [500_000, 0])
def test_duplicates_of_odd_reads(spark, few, monkeypatch):
    """One read of each group stays: a pile, equal rows, null keys that are not one another's."""
    monkeypatch.setattr(P, "BROADCAST_GROUPS", few)
    row = lambda clone, cell, read, mate, q, flag=0: (clone, cell, read, "chr1", 100, "10M", mate, 300, flag, q)
    rows = [row("k", "c", f"r{i:05}", "chr1", i % 50) for i in range(2000)]
    rows += [row(None, "x", "n1", "chr1", 1), row("x", None, "n2", "chr1", 1), row(None, "x", "n3", "chr1", 2), row("m", "c", "same", None, None), row("m", "c", "same", None, None), row("m", "c", "same", None, None), row("m", "c", "gone", "chr1", 9, 4)]
    df = spark.createDataFrame(rows, "clone_id string, cell_id string, read_id string, chrom string, start long, cigar string, mate_chrom string, mate_start long, flag int, base_quality int").repartition(5)
    got = P.mark_duplicates(df).collect()
    kept = sorted((r.read_id for r in got if not r.flag & P.DUPLICATE))
    assert len(got) == len(rows) and kept == ["gone", "n2", "n3", "r00049", "same"]


def test_cigars(spark):
    rows = [("2S2M1D1I1M1H", False), ("2S2M1D1I1M1H", True), ("75M", False), ("75M", True), ("10M5N3=", True), ("4H3S9M", False), (None, False)]
    got = spark.createDataFrame(rows, "cigar string, reverse boolean").select(
        reference_length(F.col("cigar")).alias("n"), five_prime(F.lit(100), F.col("cigar"), F.col("reverse")).alias("five"), aligned_runs(F.col("cigar")).alias("runs")
    ).collect()
    assert [r.n for r in got] == [4, 4, 75, 75, 18, 9, 0]
    assert [r.five for r in got][:6] == [98, 104, 100, 174, 117, 93]
    assert [[tuple(x) for x in r.runs or []] for r in got] == [[(0, 2, 2), (3, 5, 1)]] * 2 + [[(0, 0, 75)]] * 2 + [[(0, 0, 10), (15, 10, 3)], [(0, 3, 9)], []]


def test_intervals_in_bins(spark):
    calls = spark.createDataFrame([("chr1", p) for p in (1, 10, 11, 20000, 40000)], "chrom string, pos long")
    bed = spark.createDataFrame([("chr1", 10, 20000), ("chr1", 5, 12), ("chr2", 0, 50000), ("chr1", 30000, 30000)], "chrom string, start long, end long")
    assert sorted(r.pos for r in intervals.restrict_to_intervals(calls, bed).collect()) == [10, 11, 20000]


@pytest.mark.parametrize("size", [8, 16_384])
def test_spans_that_overlap_intervals(spark, size, monkeypatch):
    """Spans that begin before an interval, hold it, or lie within; over many bins or in one; each comes out once."""
    monkeypatch.setattr(intervals, "BIN", size)
    rnd = random.Random(size)
    bed = [("chr1", a, a + rnd.choice([0, 1, 3, 30, 90])) for a in (rnd.randrange(500) for _ in range(15))] + [("chr2", 7, 9)] * 2 + [("chr3", None, 5)]
    rows = [(c, a, a + rnd.choice([0, 1, 2, 9, 40, 300]), i) for i in range(300) for c, a in [(rnd.choice(["chr1", "chr2", "chr4"]), rnd.randrange(900))]] + [("chr1", 0, 10_000, -1), (None, 1, 2, -2), ("chr1", None, 5, -3)]
    rows.append(rows[0])
    inside = lambda c, a, b: a is not None and b > a and any(c == x and y is not None and z > y and y < b and z > a for x, y, z in bed)
    got = intervals.restrict_to_intervals(spark.createDataFrame(rows, "chrom string, a long, b long, i long"), spark.createDataFrame(bed, "chrom string, start long, end long"), "a", "b")
    assert sorted(r.i for r in got.collect()) == sorted(i for c, a, b, i in rows if inside(c, a, b))


def test_coverage_of_targets(spark):
    reads = [("k", "chr1", 90, 150, 0), ("k", "chr1", 95, 99, 0), ("k", "chr1", 200, 260, 0), ("m", "chr1", 100, 101, 0), ("m", "chr2", 0, 5000, 1024)]
    df = spark.createDataFrame(reads, "clone_id string, chrom string, start long, end long, flag int")
    targets = [("chr1", 100, 110), ("chr1", 120, 130), ("chr1", 0, 2000), ("chr2", 5, 5), ("chr2", 1, 3), ("chr1", 100, 110)]
    got = {(r.clone_id, r.start, r.end): (r.bases, r.mean_depth, r.max_depth, r.covered) for r in P.coverage_targets(df, spark.createDataFrame(targets, "chrom string, start long, end long"), 64).collect()}
    assert got == {
        ("k", 100, 110): (10, 1.0, 1, 10), ("k", 120, 130): (10, 1.0, 1, 10), ("k", 0, 2000): (124, 0.062, 2, 120), ("k", 1, 3): (0, 0.0, 0, 0),
        ("m", 100, 110): (1, 0.1, 1, 1), ("m", 120, 130): (0, 0.0, 0, 0), ("m", 0, 2000): (1, 0.0005, 1, 1), ("m", 1, 3): (0, 0.0, 0, 0),
    }


def test_library_size_is_the_root(spark):
    import math

    rows = [(1000, 900), (10**9, 5 * 10**8), (50, 50), (7, 0), (100, 99), (10**6, 1000)]
    got = [r.x for r in spark.createDataFrame(rows, "n long, c long").select(P.library_size(F.col("n"), F.col("c")).alias("x")).collect()]
    assert got[2:4] == [None, None]
    for (n, c), x in zip(rows, got, strict=True):
        if x:
            low, high = c, c * 2**40
            for _ in range(200):
                mid = (low + high) / 2
                low, high = (mid, high) if c / mid - 1 + math.exp(-n / mid) > 0 else (low, mid)
            assert x == pytest.approx(high, rel=1e-6, abs=1)


def test_similarity_of_many_clones(spark, monkeypatch):
    """Products of bits, and pairs where there are more clones than a matrix takes."""
    rnd = random.Random(2)
    has = {f"c{i}": {k for k in range(40) if rnd.random() < 0.3} for i in range(12)} | {"empty": set(), "none": set()}
    calls = spark.createDataFrame([(c, "x", "chr1", k, "A", "C") for c, ks in has.items() for k in ks], "clone_id string, caller string, chrom string, pos long, ref string, alt string")
    files = spark.createDataFrame([(c, "x") for c in has], "clone_id string, caller string")
    want = {(a, b): len(x & y) / len(x | y) if x | y else 0.0 for a, x in has.items() for b, y in has.items()}
    for most in (2048, 3):
        monkeypatch.setattr(X, "MAX_DENSE", most)
        got = {(r.clone_a, r.clone_b): r.jaccard for r in X.clone_similarity(calls, files).collect()}
        assert got.keys() == want.keys() and all(got[k] == pytest.approx(v) for k, v in want.items())


def test_registered_queries_match_their_sql(spark):
    """A few of the registered queries against DuckDB on the smallest tables."""
    import duckdb

    from cladeworks.plans.queries import ORACLE_SQL, QUERIES

    d, con = "/root/testdata/sf0.001", duckdb.connect()
    for t in ("region", "nation", "customer", "supplier", "part", "orders", "lineitem"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{d}/{t}.parquet')")
    for name in ("x4_caller_concordance", "x11_consensus_table", "w5_mark_duplicates", "t12_cut_into_clones", "p8_coverage_summary", "j6_overlapping_reads", "s10_to_newick", "q3_qc_details"):
        got, want = QUERIES[name](spark, d).toPandas(), con.execute(ORACLE_SQL[name]).df()
        cols = sorted(want.columns)
        text = lambda f: sorted(map(tuple, f[cols].map(lambda v: f"{v:.6g}" if isinstance(v, float) else str(v)).to_numpy()))  # noqa: B023, E731
        assert sorted(got.columns) == cols and text(got) == text(want), name
