"""Conversation repair, repeated passages and spelling variants against brute force."""

import collections
import hashlib
import itertools
import random
import re

import pytest
from pyspark.sql import functions as F

from cladeworks.llm import conversations, queries, spelling, suffix_trees

ODD = [None, "", " \t\n", "word", "żółć ▁ 😀 \u0000 é À× ÷ÿ", "\n".join(["x"] * 60), "ab " * 60_000, "A" * 100_000]


def cheapest(rows):
    """All edits tried: ``cost, letters, repaired`` of rows ``role, text, fault``."""
    found = []

    def go(i, state, cost, letters, out):
        for x in "" if letters.endswith("II") else ("ua" if state in "sa-" else "a"):
            if state == "u" or x == "u":
                go(i, x, cost + 2, letters + "I", [*out, ({"u": "user", "a": "assistant"}[x], "")])
        if i == len(rows):
            if state in "-a":
                found.append((cost, letters, out))
            return
        role, text, fault = rows[i]
        go(i + 1, state, cost + 3, letters + "D", out)
        if fault in ("blank", "duplicate"):
            return
        more = fault == "truncated"
        follows = {"-": "su", "s": "u", "u": "a", "a": "u"}[state]
        if role[:1] and role[:1] in follows:
            go(i + 1, role[:1], cost + more, letters + "K", [*out, (role, text)])
        for x in "ua":
            if x in follows:
                go(i + 1, x, cost + 2 + more, letters + "R", [*out, ({"u": "user", "a": "assistant"}[x], text)])

    go(0, "-", 0, "", [])
    return min(found)


def expected_report(rows):
    """Of one conversation's ``turn, role, text`` in order."""
    seen, judged = set(), []
    for _, role, text in rows:
        bare = text.strip(" \t\n\v\f\r")
        judged.append((role, text, "blank" if not bare else "duplicate" if (role, text) in seen else "truncated" if bare[-1] not in ".!?" else ""))
        seen.add((role, text))
    cost, letters, out = cheapest(judged)
    turns = [t for t, _, _ in rows if t is not None]
    faults = [f for _, _, f in judged]
    illegal = sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in itertools.pairwise(rows))
    gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
    digest = hashlib.sha256("\n".join(f"{r}:{t}" for r, t in out).encode()).hexdigest()
    return (gaps, *(faults.count(f) for f in ("blank", "duplicate", "truncated")), illegal, cost, letters, digest)


def random_conversations(rnd, n, most):
    rows = []
    for c in [None, *range(n)]:
        for i in range(rnd.randint(1, most)):
            rows.append((c, i * rnd.choice([1, 2]) + 2 * i if i else rnd.choice([None, 0]), rnd.choice(["user", "assistant", "assistant", "system", "tool", ""]), rnd.choice([f"t{i}.", f"t{i}", "same.", "", " \n", f"{i}! \t"])))
    return rows


@pytest.mark.parametrize("bits", [10, 1])
def test_conversation_repair_is_the_cheapest(spark, bits, monkeypatch):
    monkeypatch.setattr(conversations, "BLOCK_BITS", bits)
    rows = random_conversations(random.Random(bits), 25, 5)
    df = spark.createDataFrame([(*r, 1, "x") for r in rows], "conv_id long, turn long, role string, text string, n long, edits string")
    got = {r[0]: tuple(r[1:]) for r in conversations.conversation_report(df).collect()}
    by = collections.defaultdict(list)
    for r in rows:
        by[r[0]].append(r[1:])
    assert got == {c: expected_report(sorted(x, key=lambda r: (r[0] is not None, r[0] or 0))) for c, x in by.items()}


def test_long_conversations_are_solved_by_levels(spark, monkeypatch):
    rnd = random.Random(3)
    rows = [(c, i, rnd.choice(["user", "assistant", "system"]), rnd.choice([f"{i}.", f"{i}", "same.", ""])) for c in (1, 2) for i in range(700)]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").repartition(5)
    whole = sorted(conversations.conversation_report(df).collect())
    monkeypatch.setattr(conversations, "BLOCK_BITS", 3)
    assert sorted(conversations.conversation_report(df).collect()) == whole


def test_conversation_repair_gives_rows(spark):
    rows = [("c", 1, "system", "Be kind."), ("c", 2, "assistant", "Hello."), ("c", 3, "assistant", "Hello."), ("c", 4, "tool", "4"), ("d", None, None, None)]
    lines, repaired = conversations.repair_conversations(spark.createDataFrame(rows, "conv_id string, turn int, role string, text string"))
    assert [(r.turn, r.edits) for r in lines.orderBy("conv_id", "at", "part").collect()][:4] == [(1, "K"), (2, "IK"), (3, "D"), (4, "D")]
    assert [(r.turn, r.role, r.text) for r in repaired.orderBy("conv_id", "at", "slot").collect()] == [(1, "system", "Be kind."), (None, "user", ""), (2, "assistant", "Hello.")]
    none = spark.createDataFrame([], "conv_id long, turn long, role string, text string")
    assert conversations.conversation_report(none).count() == 0


def test_conversation_query_keeps_what_lost_all_rows(spark, tmp_path):
    rows = [(c, t, "user", "Hi.") for c in range(60) for t in (0,)] + [(None, None, None, None)]
    spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").write.parquet(str(tmp_path / "conversations.parquet"))
    got = queries.op11_conversation_repair(spark, str(tmp_path)).collect()
    assert len(got) == 61 and any(r.audit == "" and r.repaired_sha256 == hashlib.sha256(b"").hexdigest() for r in got)


def cut_by_hand(rows, words):
    """``rows``: doc_id and text in their order."""
    first, out = {}, []
    split = [(d, (t or "").encode().split()) for d, t in rows]
    for d, w in split:
        for i in range(len(w) - words + 1):
            first.setdefault(tuple(w[i : i + words]), (d, i))
    for d, w in split:
        gone = [False] * len(w)
        for i in range(len(w) - words + 1):
            if first[tuple(w[i : i + words])] != (d, i):
                gone[i : i + words] = [True] * words
        out.append((d, len(w), sum(gone), b" ".join(x for x, g in zip(w, gone, strict=True) if not g).decode()))
    return out


@pytest.mark.parametrize("group_rows,task_rows", [(4096, 1 << 15), (2, 8)])
def test_repeated_passages(spark, group_rows, task_rows, monkeypatch):
    monkeypatch.setattr(suffix_trees, "GROUP_ROWS", group_rows)
    monkeypatch.setattr(suffix_trees, "TASK_ROWS", task_rows)
    rnd = random.Random(group_rows)
    passages = [" ".join(rnd.choice("abcdefgh") + str(rnd.randint(0, 9)) for _ in range(rnd.randint(5, 40))) for _ in range(12)]
    texts = [" \t".join(rnd.choice([*passages, f"u{i} v{i}", "the same old words", "z z z z z"]) for _ in range(rnd.randint(0, 12))) for i in range(150)]
    rows = list(enumerate([*texts, *[t for t in ODD if t != ODD[-2]], "no id " * 30]))
    df = spark.createDataFrame([(d, t, "x", 1) for d, t in rows], "doc_id long, text string, id string, hash int").repartition(4)
    for words in (20, 7, 1):
        got = sorted((r.doc_id, r.n_words, r.n_removed, r.kept) for r in suffix_trees.cut_repeats(df, words).collect())
        assert got == cut_by_hand(rows, words)
    spans = {r.doc_id: r.removed for r in suffix_trees.cut_repeats(df).collect()}
    assert all(sum(s.end - s.start for s in spans[d]) == n for d, _, n, _ in cut_by_hand(rows, 20))


def test_repeated_passages_of_odd_rows(spark):
    long = " ".join(f"w{i}" for i in range(50_000))
    rows = [(5, long), (5, long), (3, "a b " + long), (None, long), (None, None), (7, "q " * 30_000)]
    df = spark.createDataFrame(rows, "doc_id int, text string")
    got = sorted(((r.doc_id or 99, r.n_words, r.n_removed) for r in suffix_trees.cut_repeats(df).collect()))
    assert got == [(3, 50_002, 0), (5, 50_000, 50_000), (5, 50_000, 50_000), (7, 30_000, 29_999), (99, 0, 0), (99, 50_000, 50_000)]
    # Repeated rows are one document: neither copy is earlier.
    twice = spark.createDataFrame([(1, long), (1, long)], "doc_id int, text string")
    assert [r.n_removed for r in suffix_trees.cut_repeats(twice).collect()] == [0, 0]
    assert suffix_trees.cut_repeats(df.limit(0)).count() == 0


def forms_by_hand(counts):
    near = {w: {x for x in counts if one_edit(w, x)} for w in counts}
    form = {}
    for w, others in near.items():
        if others:
            n, f = min((-counts[x], x) for x in others)
            if -n >= 2 * counts[w]:
                form[w] = f
    out = {}
    for w in counts:
        root = w
        while root in form:
            root = form[root]
        out[w] = (form.get(w), root, counts[w], len(near[w]), counts[form[w]] if w in form else None)
    return out


def one_edit(a, b):
    if a == b or abs(len(a) - len(b)) > 1:
        return False
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b, strict=True)) == 1
    a, b = sorted((a, b), key=len)
    return any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


@pytest.mark.parametrize("block", [256, 2])
def test_spelling_forms(spark, block, monkeypatch):
    monkeypatch.setattr(spelling, "BLOCK", block)
    rnd = random.Random(block)
    words = {"".join(rnd.choice("abé😀") for _ in range(rnd.randint(1, 6))) for _ in range(400)} | {"a" * n for n in range(1, 12)}
    counts = {w: rnd.randint(1, 60) for w in words}
    rows = [(w, n, "x", 0) for w, n in counts.items()] + [(None, 3, "x", 0)]
    df = spark.createDataFrame(rows, "word string, n int, form string, side int")
    got = {r.word: (r.form, r.root, r.n, r.n_near, r.form_n) for r in spelling.spelling_forms(df).collect()}
    assert got == forms_by_hand(counts)
    assert spelling.spelling_forms(df.limit(0)).count() == 0


def test_words_of_damaged_texts(spark):
    texts = [*ODD, "Straße CAFÉ café naïve naïve " * 400, "banana bananas Banana bananna " * 300]
    df = spark.createDataFrame([(i, t, 1) for i, t in enumerate(texts)] + [(None, "nobody nobody", 1)], "doc_id long, text string, word int")
    got = {r.word: r["count"] for r in queries.damaged_words(df).groupBy("word").count().collect()}
    want = collections.Counter()
    import zlib

    for i, t in [*enumerate(texts), ("", "nobody nobody")]:
        for run in re.findall("[A-Za-zÀ-ÿ]+", t or ""):
            run = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{i}:{run}".encode())
            if h % 97 == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            if len(run) >= 4:
                want[run] += 1
    assert {w: n for w, n in got.items() if len(w) >= 5} == {w: n for w, n in want.items() if len(w) >= 5}
    counted = spelling.count_words(queries.damaged_words(df).select("word", F.lit(1).alias("n")))
    assert {r.word: r.n for r in counted.collect()} == {w: n for w, n in want.items() if len(w) >= 5 and n >= 3}
