"""Repair of conversation structure by cheapest edits.

A conversation's rows, in order, are edited so that the initials of its roles read
``(s?(ua)+)?``. The edits are a shortest path through a DAG whose nodes are places
between rows and states of that pattern. An edge's weight is one big integer: its
high digits are the cost, its low digits the edits' letters at the row's own fixed
place, ended by zeros. So one minimum of integers decides both cost and ties.

Letters stay comparable as inserts stand in front of the row that needs them: a
row's letters then end with that row's own one and are never the start of another
choice for it. For the same reason blocks compose: a block of rows is again an edge
for each pair of states, its letters replaced by their rank among the block's own.
Conversations of any length are solved by levels of blocks, and no task gets a whole
one; only a digest of the repaired text streams through one.
"""

from __future__ import annotations

import hashlib

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from .shared import materialize

BLOCK_BITS = 10  # rows of a block, and blocks of a larger one, at most 2**10
SPACE = " \t\n\x0b\f\r"
START, SYSTEM, USER, ASSISTANT = range(4)  # states, by the role put out last
#: By state, the state after each role (s, u, a) that may follow.
NEXT = {START: {0: SYSTEM, 1: USER}, SYSTEM: {1: USER}, USER: {2: ASSISTANT}, ASSISTANT: {1: USER}}
ENDS = (START, ASSISTANT)
LETTERS = "DIKR"  # digits 1 to 4, as in ASCII
DIGIT_BITS, ROW_LETTERS, END_LETTERS = 3, 3, 2
ROW_BITS, END_BITS, RANK_BITS = DIGIT_BITS * ROW_LETTERS, DIGIT_BITS * END_LETTERS, 4
KEEP, REROLE, INSERT, DELETE, TRUNCATED = 0, 2, 2, 3, 1
ROLES = ("system", "user", "assistant")
LEGAL = ("su", "ua", "au")


def _digits(letters: str, width: int) -> int:
    """Letters as digits of fixed width, zeros at the end."""
    out = 0
    for i in range(width):
        out = out << DIGIT_BITS | (LETTERS.index(letters[i]) + 1 if i < len(letters) else 0)
    return out


def _inserted(state: int, count: int) -> int:
    for _ in range(count):
        state = ASSISTANT if state == USER else USER
    return state


def _row_edges(code: int) -> list[tuple[int, int, int, int]]:
    """Edges ``(from, to, cost, digits)`` of a row by the lower bits of its code."""
    initial, forced, more = code & 3, code & 4, TRUNCATED if code & 8 else 0
    edges = []
    for state in NEXT:
        edges.append((state, state, DELETE, _digits("D", ROW_LETTERS)))
        for n in range(0 if not forced else ROW_LETTERS, ROW_LETTERS):
            before = _inserted(state, n)
            for role, after in NEXT[before].items():
                if role == initial:
                    edges.append((state, after, KEEP + INSERT * n + more, _digits("I" * n + "K", ROW_LETTERS)))
                elif role:
                    edges.append((state, after, REROLE + INSERT * n + more, _digits("I" * n + "R", ROW_LETTERS)))
    return edges


def _end_edges() -> list[tuple[int, int, int, int]]:
    return [(q, end, INSERT * n, _digits("I" * n, END_LETTERS)) for q in NEXT for n in range(END_LETTERS + 1) if (end := _inserted(q, n)) in ENDS]


ROW_EDGES, END_EDGES = [_row_edges(code) for code in range(16)], _end_edges()


def shortest(steps: list[list[tuple[int, int, int, int]]], bits: int, entry: int, end: bool) -> dict[int, tuple[int, int]]:
    """By exit state, cost and digits of the least path from ``entry`` over all steps, and the end's edges if asked."""
    places = [(edges, bits) for edges in steps] + ([(END_EDGES, END_BITS)] if end else [])
    below = top = sum(width for _, width in places)
    least = {entry: 0}
    for edges, width in places:
        below -= width
        reached: dict[int, int] = {}
        for q, to, cost, digits in edges:
            if q in least:
                weight = least[q] + (cost << top) + (digits << below)
                if to not in reached or weight < reached[to]:
                    reached[to] = weight
        least = reached
    return {q: (w >> top, w & ((1 << top) - 1)) for q, w in least.items()}


def _walk(steps: list[list[tuple[int, int, int, int]]], bits: int, entry: int, digits: int, tail: int) -> list[tuple[int, int, int]]:
    """The path that digits spell: for each step its states and own digits. ``tail``: bits below the steps'."""
    out, state, below = [], entry, bits * len(steps) + tail
    for edges in steps:
        below -= bits
        own = digits >> below & ((1 << bits) - 1)
        to = next(to for q, to, _, d in edges if q == state and d == own)
        out.append((state, to, own))
        state = to
    return out


def _spelled(digits: int, width: int) -> str:
    found = [digits >> DIGIT_BITS * (width - 1 - i) & 7 for i in range(width)]
    return "".join(LETTERS[d - 1] for d in found if d)


def _matrix(steps: list[list[tuple[int, int, int, int]]], bits: int) -> list[tuple[int, int, int, int]]:
    """Edges of a block: for each pair of states the least cost, and the rank of its digits."""
    paths = [(q, to, cost, digits) for q in NEXT for to, (cost, digits) in shortest(steps, bits, q, False).items()]
    rank = {d: i for i, d in enumerate(sorted({p[3] for p in paths}))}
    return [(q, to, cost, rank[d]) for q, to, cost, d in paths]


def _edited(code: int, entry: int, own: int) -> tuple[str, str]:
    """Letters and initials of the roles that a row puts out."""
    letters, roles, state = _spelled(own, ROW_LETTERS), "", entry
    for x in letters:
        if x != "D":
            state = NEXT[state][code & 3] if x == "K" else _inserted(state, 1)
            roles += "sua"[state - 1]
    return letters, roles


_EDGES = "array<struct<q:int,to:int,cost:bigint,rank:int>>"
_OUT = "conv_id {kind}, at long, part int, code int, n long, turn long, role string, ka long, kb long, edits string, roles string"


def _line_rows(conv, lines: list[dict], entry: int, digits: int, end: bool) -> list[tuple]:
    steps = [ROW_EDGES[x["code"] & 15] for x in lines]
    tail = END_BITS if end else 0
    out = []
    for x, (state, _, own) in zip(lines, _walk(steps, ROW_BITS, entry, digits, tail), strict=True):
        out.append((conv, x["at"], 0, x["code"], x["n"], x["turn"], x["role"], x["ka"], x["kb"], *_edited(x["code"], state, own)))
    if end:
        out += _end_row(conv, lines[-1]["at"], _spelled(digits & ((1 << END_BITS) - 1), END_LETTERS))
    return out


def _end_row(conv, at: int, letters: str) -> list[tuple]:
    """Inserts behind the last row end with an assistant."""
    return [(conv, at, 1, None, None, None, None, None, None, letters, "ua"[-len(letters) :])] if letters else []


def _python(df: DataFrame, f, schema: str) -> DataFrame:
    """Rows that ``f`` makes of each row (a dict)."""
    target = to_arrow_schema(StructType.fromDDL(schema))

    def run(batches):
        for batch in batches:
            for part in range(0, len(batch), 256):
                rows = [out for row in batch.slice(part, 256).to_pylist() for out in f(row)]
                yield pa.RecordBatch.from_pylist([dict(zip(target.names, r, strict=True)) for r in rows], schema=target)

    return df.mapInArrow(run, schema)


def _same(a: Column, b: Column) -> Column:
    return a.eqNullSafe(b)


def _row_key() -> list[Column]:
    """``ka, kb``: 128 bits of a row, nulls told apart."""
    key = [F.col("conv_id"), F.col("conv_id").isNull(), F.col("turn"), F.col("turn").isNull(), F.col("role"), F.col("text")]
    return [F.xxhash64(*key).alias("ka"), F.xxhash64(F.lit(1), *key).alias("kb")]


def order_rows(rows: DataFrame) -> DataFrame:
    """Distinct rows with their count ``n``, numbered by ``at`` in the order of ``conv_id, turn`` (nulls first).

    Rows of one turn go by role and a hash of the text. ``code`` says what edges a row
    has: its initial (0 to 2, else 3), 4 more if it has to go, 8 if it is truncated, 16
    if it is a duplicate. ``ka, kb`` are a 128-bit key of the row.
    """
    text = F.col("text")
    bare = F.rtrim(text, F.lit(SPACE))
    narrow = rows.select(
        "conv_id", F.col("turn").cast("long").alias("turn"), "role", *_row_key(),
        F.xxhash64("role", text).alias("ta"), F.xxhash64(F.lit(1), "role", text).alias("tb"),
        (bare == "").alias("blank"), (~F.right(bare, F.lit(1)).isin(".", "!", "?")).alias("open"),
    )
    counted = narrow.groupBy(*narrow.columns).agg(F.count("*").alias("n"))
    order = ["conv_id", "turn", "role", "ka", "kb"]
    placed = materialize(counted.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("at", F.monotonically_increasing_id()))
    # conv_id is part of the texts' key by its hash, as it may be null.
    said = ["ca", "ta", "tb"]
    placed = placed.withColumn("ca", F.xxhash64("conv_id", F.col("conv_id").isNull()))
    first = placed.groupBy(*said).agg(F.min("at").alias("first"))
    out = placed.join(first, said)
    fault = F.when(F.col("blank"), 4).when(F.col("at") > F.col("first"), 20).when(F.col("open"), 8).otherwise(0)
    initial = F.when(F.col("role").startswith("s"), 0).when(F.col("role").startswith("u"), 1).when(F.col("role").startswith("a"), 2).otherwise(3)
    return materialize(out.select("conv_id", "at", "turn", "role", "ka", "kb", "n", (initial + fault).cast("int").alias("code")))


def plan_edits(ordered: DataFrame) -> DataFrame:
    """The cheapest edits of each row of :func:`order_rows`.

    Returns ``conv_id, at, part, code, n, turn, role, ka, kb, edits, roles``: ``edits``
    are the letters of the row (of its first copy; the others are deleted), ``roles``
    the initials it puts out. Rows of ``part`` 1 stand for inserts at the end.
    """
    kind = ordered.schema["conv_id"].dataType.simpleString()
    schema = _OUT.format(kind=kind)
    block = F.shiftright("at", BLOCK_BITS).alias("id")
    line = F.struct("at", "code", "n", "turn", "role", "ka", "kb")
    blocks = ordered.groupBy("conv_id", block).agg(F.sort_array(F.collect_list(line)).alias("lines"))  # 2**10 lines at most
    sizes = ordered.groupBy("conv_id").agg((F.max(block) != F.min(block)).alias("long"))
    blocks = blocks.join(sizes.withColumnRenamed("conv_id", "_c"), _same(F.col("conv_id"), F.col("_c"))).drop("_c")
    blocks = materialize(blocks)

    def whole(row):
        steps = [ROW_EDGES[x["code"] & 15] for x in row["lines"]]
        _, digits = min(shortest(steps, ROW_BITS, START, True).values())
        return _line_rows(row["conv_id"], row["lines"], START, digits, True)

    short = _python(blocks.filter("NOT long").select("conv_id", "lines"), whole, schema)
    blocks = blocks.filter("long").drop("long")
    if blocks.isEmpty():
        return short

    def edges_of(steps, bits):
        return [{"q": q, "to": to, "cost": cost, "rank": r} for q, to, cost, r in _matrix(steps, bits)]

    def as_steps(children):
        return [[(e["q"], e["to"], e["cost"], e["rank"]) for e in c["edges"]] for c in children]

    node = f"conv_id {kind}, id long, edges {_EDGES}"
    level = materialize(_python(blocks, lambda r: [(r["conv_id"], r["id"], edges_of([ROW_EDGES[x["code"] & 15] for x in r["lines"]], ROW_BITS))], node))
    levels, shift = [], BLOCK_BITS
    while True:  # up: blocks of blocks, by the widest span of numbers that holds few enough of them
        for wider in (*range(63, shift, -BLOCK_BITS), shift + 1):
            up = level.groupBy("conv_id", F.shiftright("id", wider - shift).alias("up"))
            if up.count().agg(F.max("count")).first()[0] <= 1 << BLOCK_BITS:
                break
        children = materialize(up.agg(F.sort_array(F.collect_list(F.struct("id", "edges"))).alias("children")))
        levels.append(children)
        if wider == 63:
            break
        level = materialize(_python(children, lambda r: [(r["conv_id"], r["up"], edges_of(as_steps(r["children"]), RANK_BITS))], node))
        shift = wider

    # Down: what a block is entered and left by, until blocks are those of rows.
    def top(row):
        steps = as_steps(row["children"])
        _, digits = min(shortest(steps, RANK_BITS, START, True).values())
        ends = _spelled(digits & ((1 << END_BITS) - 1), END_LETTERS)
        path = _walk(steps, RANK_BITS, START, digits, END_BITS)
        last = len(path) - 1
        return [(row["conv_id"], c["id"], q, to, ends if i == last else "") for i, (c, (q, to, _)) in enumerate(zip(row["children"], path, strict=True))]

    way = f"conv_id {kind}, id long, entry int, leave int, ends string"
    chosen = materialize(_python(levels[-1], top, way))

    def middle(row):
        steps = as_steps(row["children"])
        path = _walk(steps, RANK_BITS, row["entry"], shortest(steps, RANK_BITS, row["entry"], False)[row["leave"]][1], 0)
        last = len(path) - 1
        return [(row["conv_id"], c["id"], q, to, row["ends"] if i == last else "") for i, (c, (q, to, _)) in enumerate(zip(row["children"], path, strict=True))]

    def met(down, which):
        w = chosen.withColumnsRenamed({"conv_id": "_c", "id": "_id"})
        return down.join(w, _same(F.col("conv_id"), F.col("_c")) & (F.col(which) == F.col("_id"))).drop("_c", "_id")

    for down in reversed(levels[:-1]):
        chosen = materialize(_python(met(down, "up"), middle, way))

    def lines(row):
        steps = [ROW_EDGES[x["code"] & 15] for x in row["lines"]]
        digits = shortest(steps, ROW_BITS, row["entry"], False)[row["leave"]][1]
        return _line_rows(row["conv_id"], row["lines"], row["entry"], digits, False) + _end_row(row["conv_id"], row["lines"][-1]["at"], row["ends"])

    return short.union(_python(met(blocks, "id"), lines, schema))


def repair_conversations(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Cheapest edits of ``rows(conv_id, turn, role, text)``: the edited lines, and the repaired rows.

    A row's first fault counts: blank (nothing but white space), duplicate (role and
    text stood earlier in the conversation), truncated (it doesn't end with one of
    ``.!?``). Keep costs 0, Rerole to user or assistant 2, Delete 3 (blank rows and
    duplicates have to go), Insert of an empty user or assistant row 2; a truncated row
    that stays adds 1. Of equal costs the least string of edits in ASCII order is
    taken. Roles other than those beginning with s, u or a can't be kept.

    Lines: those of :func:`plan_edits`. Repaired rows: ``conv_id, at, slot, turn, role,
    text``, in the order of ``at, slot``; inserted ones have no turn. Null roles and
    texts count as one space; a null conv_id is a conversation of its own; null turns
    come first; equal rows are neighbours; other columns are ignored; an empty table
    gives none.
    """
    rows = rows.select("conv_id", F.col("turn").cast("long").alias("turn"), F.coalesce("role", F.lit(" ")).alias("role"), F.coalesce("text", F.lit(" ")).alias("text"))
    lines = materialize(plan_edits(order_rows(rows)))
    texts = rows.select(*_row_key(), "text").dropDuplicates(["ka", "kb"])
    slots = lines.filter("roles <> ''").select("*", F.posexplode(F.split("roles", "")).alias("i", "initial"))
    inserted = F.expr("i < length(edits) - 1 OR part = 1")
    slots = slots.withColumns({"slot": F.col("i") + 10 * F.col("part"), "new": inserted, "kept": F.expr("endswith(edits, 'K')")})
    named = F.when(~F.col("new") & F.col("kept"), F.col("role"))
    for x in ROLES:
        named = named.when(F.col("initial") == x[0], x)
    old = slots.filter("NOT new").join(texts, ["ka", "kb"]).select("conv_id", "at", "slot", "turn", named.alias("role"), "text")
    new = slots.filter("new").select("conv_id", "at", "slot", F.lit(None).cast("long").alias("turn"), named.alias("role"), F.lit("").alias("text"))
    return lines, old.unionByName(new)


def conversation_report(rows: DataFrame) -> DataFrame:
    """Per conversation of ``rows``: gaps, faults, cost, edits and a digest of the repaired text.

    Returns ``conv_id, gaps, blank, duplicate, truncated, illegal, cost`` (longs),
    ``audit`` (the letters of all edits) and ``repaired_sha256`` (of ``role:text``, joined
    by line feeds). Nulls and odd rows are treated as in :func:`repair_conversations`.
    A digest has to see its conversation in order: sorted rows stream through a task,
    which holds one batch of them and the letters.
    """
    lines, repaired = repair_conversations(rows)
    kind = lines.schema["conv_id"].dataType.simpleString()
    marks = lines.select("conv_id", "at", (10 * F.col("part")).alias("slot"), F.lit(0).alias("kind"), "code", "n", "turn", F.substring("role", 1, 1).alias("initial"), "edits")
    said = repaired.select("conv_id", "at", "slot", F.lit(1).alias("kind"), F.concat("role", F.lit(":"), "text").alias("edits"))
    stream = marks.unionByName(said, allowMissingColumns=True).repartition("conv_id").sortWithinPartitions("conv_id", "at", "slot", "kind")
    names = ["conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]
    target = to_arrow_schema(StructType.fromDDL(f"conv_id {kind}, gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string, repaired_sha256 string"))

    def run(batches):
        now = None
        for batch in batches:
            done = []
            for row in batch.to_pylist():
                if now is None or now.conv_id != row["conv_id"]:
                    done += [now.row()] if now else []
                    now = _Report(row["conv_id"])
                now.add(row)
            yield pa.RecordBatch.from_pylist([dict(zip(names, r, strict=True)) for r in done], schema=target)
        if now:
            yield pa.RecordBatch.from_pylist([dict(zip(names, now.row(), strict=True))], schema=target)

    return stream.mapInArrow(run, StructType.fromDDL(f"conv_id {kind}, gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string, repaired_sha256 string"))


class _Report:
    """Figures of one conversation, fed row by row."""

    def __init__(self, conv_id):
        self.conv_id, self.letters, self.digest, self.said = conv_id, [], hashlib.sha256(), False
        self.blank = self.duplicate = self.truncated = self.illegal = self.cost = self.turns = 0
        self.first = self.last = self.before = None

    def add(self, row: dict) -> None:
        if row["kind"]:
            self.digest.update(("\n" if self.said else "").encode() + row["edits"].encode())
            self.said = True
            return
        edits, code, n, turn = row["edits"], row["code"], row["n"], row["turn"]
        self.letters.append(edits)
        self.cost += sum({"K": KEEP, "R": REROLE, "I": INSERT, "D": DELETE}[x] for x in edits)
        if code is None:
            return
        self.letters.append("D" * (n - 1))
        self.cost += DELETE * (n - 1) + (TRUNCATED if code & 8 and edits != "D" else 0)
        if code & 4 and not code & 16:
            self.blank += n
        else:
            self.duplicate += n if code & 16 else n - 1
            self.truncated += code >> 3 & 1
        if self.before is not None and self.before + row["initial"] not in LEGAL:
            self.illegal += 1
        self.illegal += n - 1
        self.before = row["initial"]
        if turn is not None and turn != self.last:
            self.first, self.last, self.turns = turn if self.first is None else self.first, turn, self.turns + 1

    def row(self) -> tuple:
        gaps = self.last - self.first + 1 - self.turns if self.turns else 0
        return self.conv_id, gaps, self.blank, self.duplicate, self.truncated, self.illegal, self.cost, "".join(self.letters), self.digest.hexdigest()
