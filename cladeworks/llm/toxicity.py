"""Toxicity by a weighted lexicon.

Texts are folded (case, accents, look-alike letters, digits for letters), entries
are word beginnings with weights learned from labelled rows, and all are matched in
one pass by an Aho-Corasick automaton in which the longest match counts, so that
longer exception phrases of weight 0 cover the entries they hold. The sums,
normalised by length, give a probability through a small logistic model.
"""

from __future__ import annotations

import re
import unicodedata
from collections import Counter
from dataclasses import dataclass, field

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .flat import shingle_hashes, word_slices
from .shared import materialize

# Letters of other scripts that look like Latin ones.
HOMOGLYPHS = {
    "а": "a", "в": "b", "с": "c", "е": "e", "һ": "h", "і": "i", "ј": "j", "к": "k", "м": "m", "н": "h", "о": "o", "р": "p", "ѕ": "s", "т": "t", "у": "y", "х": "x",
    "α": "a", "β": "b", "ε": "e", "η": "n", "ι": "i", "κ": "k", "ν": "v", "ο": "o", "ρ": "p", "τ": "t", "υ": "u", "χ": "x", "ı": "i", "ɑ": "a", "ɡ": "g",
}
# Signs that stand for letters beside a letter.
SUBSTITUTES = {"0": "o", "1": "i", "3": "e", "4": "a", "5": "s", "7": "t", "8": "b", "@": "a", "$": "s"}
MIN_PREFIX, MAX_PREFIX = 4, 10
SHORT_WORD = 2  # letters of a word that may be an entry as a whole
ROWS = 128  # texts that are Python strings at a time
COUNTED_ENTRIES = 600_000  # entries that a task counts before it hands them on


def _fold_table() -> dict[int, str | None]:
    """What becomes of a code point: joiners and combining marks go, letters of all styles become plain small ones."""
    marks = [*range(0x300, 0x370), *range(0x1AB0, 0x1B00), *range(0x1DC0, 0x1E00), *range(0x20D0, 0x2100), *range(0xFE00, 0xFE30)]
    table: dict[int, str | None] = {cp: None for cp in (0xAD, 0x200B, 0x200C, 0x200D, 0x2060, 0xFEFF, *marks)}
    styled = [*range(0x1D00, 0x1DC0), *range(0x2070, 0x20A0), *range(0x2100, 0x2150), *range(0x249C, 0x24EA), *range(0xFB00, 0xFB07), *range(0xFF10, 0xFF5B), *range(0x1D400, 0x1D800), *range(0x1F110, 0x1F16A)]
    for cp in [*range(0x41, 0x5B), *range(0xC0, 0x250), *range(0x1E00, 0x1F00), *styled]:
        plain = "".join(c for c in unicodedata.normalize("NFKD", chr(cp).lower()).lower() if not unicodedata.combining(c)).strip("()")
        if plain and plain != chr(cp):
            table[cp] = plain
    for seen, plain in HOMOGLYPHS.items():
        table[ord(seen)] = table[ord(seen.upper())] = plain
    for cp, plain in list(table.items()):  # styled letters of other scripts look like theirs
        if plain in HOMOGLYPHS:
            table[cp] = HOMOGLYPHS[plain]
    return table


_TABLE = _fold_table()
_SIGN = re.compile(r"(?<=[^\W\d_])[0134578@$]++|(?<![0134578@$])[0134578@$]++(?=[^\W\d_])")  # whole runs, each looked at once
_AS_LETTERS = str.maketrans(SUBSTITUTES)
_GAP = re.compile(r"[\W\d_]+")


def fold(text: str | None) -> str:
    """Folded words, each between two blanks: ``'  words  of  a  text  '``."""
    text = (text or "").translate(_TABLE)
    text = _SIGN.sub(lambda m: m[0].translate(_AS_LETTERS), text)
    return f"  {_GAP.sub('  ', text)}  "


@dataclass
class ToxicityModel:
    """``weights``: word beginning to weight, with a blank behind for a whole word; ``exceptions``: phrases that don't count.

    ``coef``: intercept and weights of the four features. All are of bounded size.
    """

    weights: dict[str, float] = field(default_factory=dict)
    exceptions: list[str] = field(default_factory=list)
    coef: list[float] = field(default_factory=lambda: [-6.0, 0.0, 0.0, 0.0, 0.0])
    _automaton: object = field(default=None, repr=False, compare=False)

    def __getstate__(self):
        return {**self.__dict__, "_automaton": None}

    def automaton(self):
        if self._automaton is None and self.weights:
            self._automaton = ahocorasick.Automaton()
            for entry, weight in self.weights.items():
                self._automaton.add_word(f" {fold(entry).strip()}{' ' * entry.endswith(' ')}", weight)
            for phrase in self.exceptions:
                self._automaton.add_word(f" {fold(phrase).strip()} ", 0.0)
            self._automaton.make_automaton()
        return self._automaton

    def features(self, texts) -> np.ndarray:
        """Per text: log of the weights' sum, of the sum by length, of the hits, and the largest weight."""
        out, matcher = np.zeros((len(texts), 4)), self.automaton()
        for i, text in enumerate(texts):
            if matcher is None or not isinstance(text, str) or not text:
                continue
            folded = fold(text)
            hits = [w for _, w in matcher.iter_long(folded) if w]
            if hits:
                total = sum(hits)
                out[i] = np.log1p(total), np.log1p(100 * total / (50 + folded.count("  "))), np.log1p(len(hits)), max(hits)
        return out

    def score(self, texts) -> np.ndarray:
        z = self.coef[0] + self.features(texts) @ np.array(self.coef[1:])
        return 1 / (1 + np.exp(-np.clip(z, -40, 40)))


def _logistic(x: np.ndarray, y: np.ndarray, ridge: float = 1.0, rounds: int = 30) -> list[float]:
    """Newton's method with a ridge on the weights."""
    x = np.hstack([np.ones((len(x), 1)), x])
    penalty = np.diag([1e-3] + [ridge] * (x.shape[1] - 1))
    w = np.zeros(x.shape[1])
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        step = np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + penalty, x.T @ (y - p) - penalty @ w)
        w += step
        if np.abs(step).max() < 1e-6:
            break
    return w.tolist()


def labelled_rows(docs: DataFrame, labels: DataFrame, max_rows: int, mod: int = 5) -> DataFrame:
    """At most ``max_rows`` labelled texts outside the held-out fold: ``doc_id, toxic, sketch, text``.

    A doc_id labelled more than once counts as toxic if one label says so; labels
    other than 0 and 1 are left out. Rows are picked by a hash of doc_id, so any
    source can be hot. ``sketch`` is the least 5-word shingle: near copies share it.
    """
    fold_of = F.crc32(F.col("doc_id").cast("string").cast("binary")) % mod
    ids = labels.filter("toxic IN (0, 1) AND doc_id IS NOT NULL").filter(fold_of != 0)
    ids = ids.groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(F.max("toxic").cast("int").alias("toxic"))
    ids = ids.orderBy(F.xxhash64("doc_id"), "doc_id").limit(max_rows)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").join(F.broadcast(ids), "doc_id").select("doc_id", "toxic", "text")

    def run(batches):
        for batch in batches:
            for w in word_slices(batch.column(2)):
                values, bounds = shingle_hashes(w.hashes(), w.bounds, 5)
                sketch = [int(values[a:b].min()) - (1 << 63) if b > a else 0 for a, b in zip(bounds[:-1], bounds[1:], strict=True)]
                part = batch.slice(w.first, w.n_docs)
                yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), pa.array(sketch, pa.int64()), part.column(2)], ["doc_id", "toxic", "sketch", "text"])

    return rows.mapInArrow(run, "doc_id long, toxic int, sketch long, text string")


def _entries(text: str) -> set[str]:
    """Word beginnings, and whole words with a blank behind."""
    words = {w for w in fold(text).split() if len(w) >= SHORT_WORD}
    return {w[:k] for w in words for k in range(MIN_PREFIX, min(MAX_PREFIX, len(w)) + 1)} | {f"{w} " for w in words if len(w) < MIN_PREFIX}


def _phrases(text: str, weights: dict[str, float]) -> set[str]:
    """The words that entries match, alone and with one word before, behind, or both."""
    words, out = fold(text).split(), set()
    for i, w in enumerate(words):
        if f"{w} " in weights or any(w[:k] in weights for k in range(MIN_PREFIX, min(MAX_PREFIX, len(w)) + 1)):
            out.update(" ".join(words[max(0, i - a) : i + 1 + b]) for a in (0, 1) for b in (0, 1))
    return out


def _counts(train: DataFrame, parts_of, n1: int, n0: int) -> DataFrame:
    """``entry, n1, n0, w, spread``: toxic and clean texts that hold an entry, its log odds and their standard error."""

    def handed_on(seen: tuple[Counter, Counter]) -> pa.RecordBatch:
        keys = list(seen[0].keys() | seen[1].keys())
        counts = [pa.array([seen[i][k] for k in keys], pa.int64()) for i in (1, 0)]
        return pa.RecordBatch.from_arrays([pa.array(keys, pa.string()), *counts], ["entry", "n1", "n0"])

    def count(batches):
        seen: tuple[Counter, Counter] = (Counter(), Counter())
        for batch in batches:
            for at in range(batch.num_rows):
                seen[batch.column(0)[at].as_py()].update(parts_of(batch.column(1)[at].as_py() or ""))
                if len(seen[0]) + len(seen[1]) > COUNTED_ENTRIES:
                    yield handed_on(seen)
                    seen = (Counter(), Counter())
        yield handed_on(seen)

    counts = train.select("toxic", "text").repartition(16).mapInArrow(count, "entry string, n1 long, n0 long")
    counts = counts.groupBy("entry").agg(F.sum("n1").alias("n1"), F.sum("n0").alias("n0")).filter("n1 >= 3 OR n0 >= 3")
    odds = F.log((F.col("n1") + 0.5) / (n1 + 1)) - F.log((F.col("n0") + 0.5) / (n0 + 1))
    return materialize(counts.withColumns({"w": odds, "spread": F.sqrt(1 / (F.col("n1") + 0.5) + 1 / (F.col("n0") + 0.5))}))


def learn_toxicity(docs: DataFrame, labels: DataFrame, max_rows: int = 20_000, max_entries: int = 20_000, least: float = 2.0, chance: float = 10.0) -> ToxicityModel:
    """Learn lexicon, exceptions and weights from at most ``max_rows`` labelled rows.

    An entry is a word beginning of 4 to 10 letters, or a whole word of 2 or 3. It needs
    log odds of ``least`` or more after one standard error is taken off, and so many
    more toxic texts than their share that among all entries counted one as uneven
    would turn up by chance ``chance`` times at most (Chernoff's bound); so
    a rare word that only toxic texts hold is enough, whatever the number of rows.
    Near copies count once. Words that an entry covers, and phrases of two and three
    words around them, become exceptions if their own log odds are low. Words are runs of letters: inside compounds
    and in scripts without blanks entries match at the beginning of a run only.
    Without toxic and clean labelled rows the model scores every text near 0.
    """
    spark = docs.sparkSession
    rows = labelled_rows(docs, labels, max_rows).groupBy("toxic", "sketch").agg(F.min(F.struct("doc_id", "text")).alias("first"))
    train = materialize(rows.select("first.doc_id", "toxic", "first.text"))
    totals = {r["toxic"]: r["n"] for r in train.groupBy("toxic").agg(F.count("*").alias("n")).collect()}
    n1, n0 = totals.get(1, 0), totals.get(0, 0)
    if not n1 or not n0:
        return ToxicityModel()
    counts = _counts(train, _entries, n1, n0)
    n, usual = F.col("n1") + F.col("n0"), n1 / (n1 + n0)
    share = F.col("n1") / n
    evidence = F.col("n1") * F.log(share / usual) + F.when(F.col("n0") > 0, F.col("n0") * F.log((1 - share) / (1 - usual))).otherwise(0.0)
    proven = evidence >= float(np.log(max(counts.count(), 1) / chance))
    top = counts.filter((F.col("n1") >= 3) & (share > usual) & proven & (F.col("w") - F.col("spread") >= least)).orderBy(F.desc("w"), "entry").limit(max_entries)
    weights: dict[str, float] = {}
    for r in sorted(top.collect(), key=lambda r: (len(r.entry), r.entry)):
        shorter = [weights[r.entry[:k]] for k in range(MIN_PREFIX, len(r.entry)) if r.entry[:k] in weights]
        if not shorter or r.w > max(shorter) + 0.3:
            weights[r.entry] = float(r.w)
    if not weights:
        return ToxicityModel()
    around = _counts(train, lambda text: _phrases(text, weights), n1, n0)
    sure = F.when(F.contains("entry", F.lit(" ")), F.col("spread")).otherwise(0.0)
    mild = around.filter((F.col("n0") >= 3) & (F.col("w") + sure < least / 2)).orderBy(F.desc("n0"), "entry").limit(max_entries)
    model = ToxicityModel(weights, [r.entry for r in mild.collect()])

    shared = spark.sparkContext.broadcast(model)

    def features(batches):
        for batch in batches:
            for at in range(0, batch.num_rows, ROWS):
                part = batch.slice(at, ROWS)
                x = shared.value.features(part.column(1).to_pylist())
                yield pa.RecordBatch.from_arrays([part.column(0), *(pa.array(x[:, i]) for i in range(4))], ["toxic", "x0", "x1", "x2", "x3"])

    named = ["toxic", "x0", "x1", "x2", "x3"]
    rows = train.select("toxic", "text").mapInArrow(features, "toxic int, x0 double, x1 double, x2 double, x3 double").toPandas().sort_values(named)
    model.coef = _logistic(rows[named[1:]].to_numpy(), rows["toxic"].to_numpy(float))
    return model


def _score(docs: DataFrame, model: ToxicityModel, text: str) -> Column:
    shared = docs.sparkSession.sparkContext.broadcast(model)

    @F.arrow_udf("double")
    def scored(texts: pa.Array) -> pa.Array:
        parts = [shared.value.score(texts.slice(at, ROWS).to_pylist()) for at in range(0, len(texts), ROWS)]
        return pa.array(np.concatenate(parts) if parts else np.zeros(0))

    return scored(F.col(text).cast("string"))


def score_toxicity(docs: DataFrame, model: ToxicityModel, text: str = "text") -> DataFrame:
    """Append ``score`` (0 to 1) and ``predicted`` (1 from 0.5 on) for every row; no shuffle.

    Whole texts are scored, in time that grows with their length; null and empty ones
    get the score of a text without hits. Columns of those names are replaced, other
    ones stay; every row gives one row, repeated ones too.
    """
    out = docs.withColumn("score", _score(docs, model, text))
    return out.withColumn("predicted", (F.col("score") >= 0.5).cast("int"))


def drop_toxic(docs: DataFrame, model: ToxicityModel, text: str = "text") -> DataFrame:
    """Rows of ``docs`` with a score under 0.5, with just its columns, whatever their names."""
    return docs.filter(_score(docs, model, text) < 0.5)
