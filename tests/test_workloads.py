"""The three workloads from files to files, held against plain Python over the same input."""

import gzip
import random
from collections import Counter, defaultdict

from example import EVENTS, NEWICK, cell, partition

from cladeworks.functions.newick import parse_newick
from cladeworks.operators import calls as K
from cladeworks.operators import clones as G
from cladeworks.operators import compare as X
from cladeworks.operators import pseudobulk as P
from cladeworks.operators import report as R
from cladeworks.operators import tree as T
from cladeworks.operators import validate as V
from cladeworks.sources import readers, writers


def csv(spark, path):
    return spark.read.option("header", True).csv(path)


def test_clones_are_defined_from_a_tree(spark, tmp_path):
    at = lambda name: str(tmp_path / name)
    (tmp_path / "t.new").write_text(NEWICK)
    ids = [*range(1, 13), 99]
    (tmp_path / "bam.csv").write_text("cell_id,bam_path,sample_id,patient_id,batch\n" + "".join(f"{cell(i)},/b/{i}.bam,s,p,x\n" for i in ids))
    (tmp_path / "meta.csv").write_text("cell_id,sample_id\n" + "".join(f"{cell(i)},s\n" for i in ids[:-1]))
    (tmp_path / "events.tsv").write_text("cell_id\tchr\tstart\tend\tevent_type\n" + "".join(f"{cell(i)}\t{c}\t{a}\t{b}\t{e}\n" for (c, a, b, e), who in EVENTS.items() for i in who))
    tree = readers.read_newick(spark, at("t.new"))
    cells, events = readers.read_manifest(spark, at("bam.csv"), "bam"), readers.read_events(spark, at("events.tsv"))
    meta = csv(spark, at("meta.csv"))
    listing = spark.createDataFrame([(f"/b/{i}.bam{x}", 5) for i in ids for x in ("", ".bai")], "path string, length long")
    report = V.validate_inputs(cells, meta, tree, events, listing).first()
    assert (report.status, report.errors, report.n_overlap, report.n_tree_leaves) == ("ok", [], 12, 12)
    assert report.warnings == ["cross-check: cells without metadata: 1"]
    failed = V.validate_inputs(cells, meta, tree, events, listing.filter("path <> '/b/3.bam'")).first()
    assert failed.status == "failed" and failed.errors == ["BAM manifest: missing or empty /b/3.bam"]

    usable = V.usable_cells(tree, cells)
    assert usable.count() == 12
    clones = G.assign_clones("internal_node", tree, usable.filter("enough"), events, min_cells=2)
    writers.write_table(G.sort_assignments(clones), at("clones.csv"))
    writers.write_table(G.clone_summary(clones, events), at("summary.csv"))
    labels = T.annotate_nodes_with_clones(tree, clones)
    text = writers.to_newick(tree, labels).first().newick

    back = csv(spark, at("clones.csv"))
    assert partition(back) == {frozenset(x) for x in ((9, 10, 11, 12), (6, 7, 8), (1, 2, 3, 4, 5))}
    of = {r.cell_id: r.clone_id for r in back.collect()}
    held = defaultdict(Counter)
    for event, who in EVENTS.items():
        for i in who:
            held[of[cell(i)]][event] += 1
    size = Counter(of.values())
    want = {c: (size[c], sum(2 * k >= size[c] for k in held[c].values())) for c in size}
    assert {r.clone_id: (int(r.n_cells), int(r.n_defining_events)) for r in csv(spark, at("summary.csv")).collect()} == want
    # The written tree has the shape of the one read, its inner nodes named by the clones below.
    old, new = parse_newick(NEWICK), parse_newick(text)
    assert [(n["edge_length"], n["is_leaf"], n["depth"]) for n in old] == [(n["edge_length"], n["is_leaf"], n["depth"]) for n in new]
    for n, m in zip(old, new, strict=True):
        below = {of[x["node_id"]] for x in old[n["pre"] : n["last"] + 1] if x["is_leaf"]}
        assert m["node_id"] == (n["node_id"] if n["is_leaf"] else ",".join(sorted(below)))


def test_pseudobulks_are_built_from_reads(spark, tmp_path):
    rnd = random.Random(11)
    reads = []
    for i in range(1, 7):
        rows = []
        for k in range(60):
            start, n = rnd.randrange(300), rnd.choice([20, 30])
            flag = rnd.choice([99, 163, 99, 147, 1123, 77, 355])
            rows.append((f"r{k}", flag, rnd.choice(["chr1", "chr2"]), start, n, rnd.randrange(2, 40)))
        reads += [(cell(i), *r) for r in rows]
        text = "".join("\t".join([q, str(f), c, str(s + 1), "60", f"{n}M", "=", "500", "0", "A" * n, chr(33 + b) * n]) + "\n" for q, f, c, s, n, b in rows)
        (tmp_path / f"{cell(i)}.sam").write_text("@HD\tVN:1.6\n" + text)
    of = {cell(1): ("a", 0.9), cell(2): ("a", 0.8), cell(3): ("b", 0.7), cell(4): ("b", 0.1), cell(5): ("c", 1.0)}
    cells = spark.createDataFrame([(cell(i), f"/b/{i}.bam") for i in range(1, 7)], "cell_id string, bam_path string")
    clones = spark.createDataFrame([(c, k, x, False) for c, (k, x) in of.items()], "cell_id string, clone_id string, confidence double, flagged boolean")
    kept = P.filter_cells(cells, clones, 0.5)
    assert {r.clone_id: r.n for r in kept.groupBy("clone_id").count().withColumnRenamed("count", "n").collect()} == {"a": 2, "b": 1, "c": 1}
    assert [r.clone_id for r in P.low_cell_clones(P.cell_qc_summary(cells, clones, 0.5), 2).orderBy("clone_id").collect()] == ["b", "c"]
    bulk = P.mark_duplicates(P.build_pseudobulk(readers.read_reads(spark, str(tmp_path / "*.sam")), kept))
    writers.write_per_clone(bulk.select("clone_id", "cell_id", "read_id", "flag"), str(tmp_path / "bulk"))

    used = [(of[r[0]][0], *r) for r in reads if r[0] in of and of[r[0]][1] >= 0.5]
    groups = defaultdict(list)
    for k, c, q, f, chrom, s, n, b in used:
        if not f & 2308:
            groups[k, c, chrom, s + n - 1 if f & 16 else s, f & 16, f & 32].append((-b * n, q))
    first = {(*g[:2], min(x)[1]) for g, x in groups.items()}
    want = Counter()
    for k, c, q, f, *_ in used:
        want[k, c, q, f if f & 2308 or (k, c, q) in first else f | 1024] += 1
    back = spark.read.option("header", True).option("sep", "\t").csv(str(tmp_path / "bulk"))
    assert Counter((r.clone_id, r.cell_id, r.read_id, int(r.flag)) for r in back.collect()) == want

    flags = {r.clone_id: (r.total, r.duplicates) for r in P.flag_stats(bulk).groupBy("clone_id").agg({"total": "sum", "duplicates": "sum"}).toDF("clone_id", "a", "b").selectExpr("clone_id", "greatest(a, b) total", "least(a, b) duplicates").collect()}
    assert flags == {k: (sum(x for y, x in want.items() if y[0] == k), sum(x for y, x in want.items() if y[0] == k and y[3] & 1024)) for k in "abc"}
    depth = Counter()
    marked = {y[:3]: y[3] for y in want}
    for k, c, q, f, chrom, s, n, _ in used:
        if not marked[k, c, q] & 1796:
            depth.update((k, chrom, p) for p in range(s, s + n))
    sizes = spark.createDataFrame([("chr1", 400), ("chr2", 400)], "chrom string, length long")
    got = {(r.clone_id, r.chrom): (r.bases, r.max_depth) for r in P.coverage_summary(bulk, sizes, 50).collect()}
    at = lambda k, chrom: [d for (a, b, _), d in depth.items() if (a, b) == (k, chrom)]
    assert got == {(k, c): (sum(at(k, c)), max(at(k, c), default=0)) for k in "abc" for c in ("chr1", "chr2")}


def test_variants_are_compared_into_a_consensus_and_a_report(spark, tmp_path):
    rnd = random.Random(12)
    head = "##fileformat=VCFv4.2\n#CHROM\tPOS\tID\tREF\tALT\tQUAL\tFILTER\tINFO\n"
    found = defaultdict(set)
    (tmp_path / "in").mkdir()
    for clone in ("a", "b", "c"):
        for caller in ("mutect2", "strelka2", "freebayes", "other"):
            lines = []
            for pos in sorted(rnd.sample(range(10, 60), 25)):
                alts, ok = rnd.choice(["G", "G,T", "T"]), rnd.choice(["PASS", ".", "weak", "weak;PASS"])
                lines.append(f"chr{1 + pos % 2}\t{pos}\t.\tA\t{alts}\t{pos}\t{ok}\tDP=4\n")
                if ok != "weak" and caller != "other":
                    for alt in alts.split(","):
                        found[f"chr{1 + pos % 2}", pos, "A", alt].add((clone, caller))
            with gzip.open(tmp_path / "in" / f"{clone}.{caller}.norm.vcf.gz", "wt") as f:
                f.write(head + "".join(lines))
    callers = "mutect2, strelka2, freebayes"
    files = K.select_callers(readers.vcf_files(spark, str(tmp_path / "in")), callers)
    calls = K.trim_alleles(K.split_multiallelic(K.pass_filter(K.select_callers(readers.read_vcf(spark, str(tmp_path / "in")), callers))).drop("alt_index"))
    key = lambda r: (r.chrom, r.pos, r.ref, r.alt)

    wide = X.presence_matrix(calls, files)
    assert {key(r): {c for c in wide.columns[4:] if r[c]} for r in wide.collect()} == {k: {f"{c}.{x}" for c, x in v} for k, v in found.items()}
    by_clone = {(c, k): {x for d, x in v if d == c} for k, v in found.items() for c in "abc"}
    for r in X.caller_concordance(calls, files).collect():
        n = [len(v) for (c, _), v in by_clone.items() if c == r.clone_id and v]
        assert (r.n_variants_any, r.n_variants_2plus, r.n_variants_all) == (len(n), sum(x >= 2 for x in n), sum(x == 3 for x in n))
    sharing = X.variant_sharing(calls, files)
    kinds = {k: {1: "private", 2: "partial", 3: "shared"}[len({c for c, _ in v})] for k, v in found.items()}
    assert {key(r): r.sharing_class for r in sharing.collect()} == kinds
    assert {r.sharing_class: r.n for r in R.sharing_counts(sharing).collect()} == Counter(kinds.values())

    best = {k for (_, k), v in by_clone.items() if len(v) >= 2}
    out, report = str(tmp_path / "consensus"), str(tmp_path / "report")
    writers.write_vcf(X.consensus_info(calls, 2), out)
    lines = [x for f in sorted((tmp_path / "consensus").glob("part-*")) for x in gzip.open(f, "rt").read().splitlines()]
    assert lines[: len(writers.VCF_HEADER)] == writers.VCF_HEADER
    want = [f"{c}\t{p}\t.\t{r}\t{a}\t.\tPASS\tN_CLONES={len({x for x, _ in found[c, p, r, a]})};CALLERS={','.join(sorted({x for _, x in found[c, p, r, a]}))}" for c, p, r, a in sorted(best)]
    assert lines[len(writers.VCF_HEADER) :] == want
    clones = spark.createDataFrame([("a", 3), ("b", 2), ("c", 4)], "clone_id string, n_cells long")
    writers.write_report(R.run_overview(clones, X.consensus_variants(calls, 2), X.all_keys(calls)), report)
    got = spark.read.json(report).first()
    assert (got.n_clones, got.n_assigned_cells, got.n_consensus, got.n_unique_positions, got.status) == (3, 9, len(best), len(found), "ok")
