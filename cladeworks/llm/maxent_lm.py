"""Language-model scores by a hashed maximum-entropy model.

P(token | context) = P(class | context) * P(token | class, context). The commonest
768 tokens form 24 classes of 32, whose inner probabilities are learned; all other words
fall into 8 classes by their last letters and have their smoothed relative count in
the class as inner probability, so that the model is a distribution over any
vocabulary. Both softmaxes have hashed features of the context: last word, last two
words, and the word before the last (a skip).

Counts cover all training texts and grow with them. The rows of weights that features
are hashed to grow with the number of distinct tokens from 2**13 to 2**16 (8 MB a table,
which every task holds). Training is distributed: every task runs minibatch
gradient updates over its texts from the weights broadcast last, and what each row of
weights moved is averaged over tasks, weighted by how often the row was in use.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .flat import Words, mix, word_slices
from .shared import materialize

WIDTH = 32  # classes, and tokens of a class
COMMON = 24  # classes of common tokens; the rest are by word ending
BUCKET_BITS = (13, 16)  # of the rows of weights, by the number of distinct tokens
TOKENS_PER_TASK = 1 << 21  # of training: a task hands on as many rows of weights as it has used
HEAD = 1 << 19  # commonest tokens whose counts are broadcast (8 MB)
BATCH = 1 << 14
BLOCK = 256
_U = np.uint64
_END = _U(0x51ED270B9F652295)
_START = _U(0xB492B66FBE98F273)


def token_stream(w: Words) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hashes of each document's words and one end, classes by word ending, and bounds."""
    hashes = w.hashes()
    last = w.data[w.ends - 1].astype(np.int64) if len(w.ends) else np.zeros(0, np.int64)
    second = np.where(w.ends - w.starts > 1, w.data[np.maximum(w.ends - 2, 0)], 0).astype(np.int64) if len(w.ends) else last
    ending = (last | 32) * 31 + (second | 32)
    bounds = w.bounds + np.arange(w.n_docs + 1)
    out, tail = np.full(bounds[-1], _END), np.zeros(bounds[-1], np.int64)
    at = np.arange(len(hashes)) + w.doc
    out[at] = hashes
    tail[at] = ending
    return out, COMMON + tail % (WIDTH - COMMON), bounds


def count_tokens(train: DataFrame) -> DataFrame:
    """``h, cls, c``: count of each token over whole ``text`` values, null as empty."""

    def run(batches):
        hs, cs, ks, held = [], [], [], 0

        def folded():
            h, c, k = np.concatenate(hs), np.concatenate(cs), np.concatenate(ks)
            order = np.argsort(h, kind="stable")
            h, c, k = h[order], c[order], k[order]
            new = np.concatenate([[True], h[1:] != h[:-1]])
            return h[new], np.add.reduceat(c, np.flatnonzero(new)), k[new]

        for batch in batches:
            for w in word_slices(batch.column(0)):
                h, cls, _ = token_stream(w)
                u, first, n = np.unique(h, return_index=True, return_counts=True)
                hs.append(u)
                cs.append(n)
                ks.append(cls[first])
                held += len(u)
                if held > 3_000_000:
                    h, c, k = folded()
                    hs, cs, ks, held = [h], [c], [k], len(h)
                    if held > 2_000_000:
                        yield pa.RecordBatch.from_arrays([pa.array(h.view(np.int64)), pa.array(k.astype(np.int32)), pa.array(c.astype(np.int64))], ["h", "cls", "c"])
                        hs, cs, ks, held = [], [], [], 0
        if hs:
            h, c, k = folded()
            yield pa.RecordBatch.from_arrays([pa.array(h.view(np.int64)), pa.array(k.astype(np.int32)), pa.array(c.astype(np.int64))], ["h", "cls", "c"])

    return train.select("text").mapInArrow(run, "h long, cls int, c long").groupBy("h", "cls").agg(F.sum("c").alias("c"))


@dataclass
class MaxEnt:
    """Model and counts of bounded size: see the constants of this module."""

    head: np.ndarray  # sorted hashes of the commonest tokens
    head_count: np.ndarray
    common: np.ndarray  # sorted hashes of the tokens in common classes
    common_id: np.ndarray  # class * WIDTH + place
    bias: np.ndarray  # of classes
    inner_bias: np.ndarray  # of the places of each common class
    rest_norm: np.ndarray  # log10 of each ending class's denominator
    weights: np.ndarray  # features x classes
    inner: np.ndarray  # features x places

    def targets(self, h: np.ndarray, cls: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Class of each token, and its place in a common class (else -1)."""
        if not len(self.common):
            return cls, np.full(len(h), -1)
        at = np.minimum(np.searchsorted(self.common, h), len(self.common) - 1)
        known = self.common[at] == h
        code = self.common_id[at]
        return np.where(known, code // WIDTH, cls), np.where(known, code % WIDTH, -1)

    @staticmethod
    def contexts(h: np.ndarray, bounds: np.ndarray) -> np.ndarray:
        """64-bit features of each position: last word, last two, the one before the last."""
        one, two = np.full(len(h), _START), np.full(len(h), _START)
        one[1:], two[2:] = h[:-1], h[:-2]
        first = bounds[:-1][bounds[:-1] < bounds[1:]]
        one[first] = _START
        two[first] = _START
        second = first + 1
        two[second[second < len(h)]] = _START
        return np.stack([mix(one + _U(1)), mix(one * _U(0x9FB21C651E98DF25) + mix(two + _U(2))), mix(two + _U(3))], axis=1)

    def _buckets(self, hashes: np.ndarray) -> np.ndarray:
        return (hashes >> _U(65 - len(self.weights).bit_length())).astype(np.uint16)

    def class_rows(self, feats: np.ndarray) -> np.ndarray:
        return self._buckets(feats)

    def inner_rows(self, feats: np.ndarray, cls: np.ndarray) -> np.ndarray:
        return self._buckets(mix(feats + (cls[:, None].astype(_U) + _U(11)) * _U(0x8CB92BA72F3D8DD7)))

    @staticmethod
    def softmax(table: np.ndarray, rows: np.ndarray, bias: np.ndarray) -> np.ndarray:
        z = table[rows[:, 0]] + table[rows[:, 1]] + table[rows[:, 2]] + bias
        z -= z.max(axis=1, keepdims=True)
        np.exp(z, out=z)
        z /= z.sum(axis=1, keepdims=True)
        return z

    def log10_probabilities(self, h: np.ndarray, cls: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Of each position log10 P(class) and, for common tokens, plus log10 P(token | class); whether it is common."""
        cls, place = self.targets(h, cls)
        out, feats = np.zeros(len(h)), self.contexts(h, bounds)
        for a in range(0, len(h), BATCH):
            f, c, p = feats[a : a + BATCH], cls[a : a + BATCH], place[a : a + BATCH]
            prob = self.softmax(self.weights, self.class_rows(f), self.bias)[np.arange(len(c)), c].astype(float)
            inside = np.flatnonzero(p >= 0)
            if len(inside):
                q = self.softmax(self.inner, self.inner_rows(f[inside], c[inside]), self.inner_bias[c[inside]])
                prob[inside] *= q[np.arange(len(inside)), p[inside]]
            out[a : a + BATCH] = np.log10(np.maximum(prob, 1e-30))
        return out - np.where(place < 0, self.rest_norm[cls], 0.0), place >= 0


class _Trainer:
    """Minibatch gradient updates of one table of weights within a task; a step touches the rows in use.

    The rate of a row falls with the sum of its squared gradients (AdaGrad by rows).
    """

    def __init__(self, table: np.ndarray, rate: float):
        self.table, self.start, self.rate = table.copy(), table, rate
        self.squares = np.ones(len(table), np.float32)
        self.used = np.zeros(len(table), np.float32)

    def step(self, rows: np.ndarray, bias: np.ndarray, target: np.ndarray) -> None:
        p = MaxEnt.softmax(self.table, rows, bias)
        p[np.arange(len(target)), target] -= 1
        flat = rows.T.ravel()
        order = np.argsort(flat, kind="stable")
        flat = flat[order]
        first = np.flatnonzero(np.concatenate([[True], flat[1:] != flat[:-1]]))
        row, times = flat[first], np.diff(np.append(first, len(flat)))
        self.used[row] += times
        order %= len(p)
        g = p[order[first]]
        many = np.flatnonzero(times > 1)  # most rows are in use once
        if len(many):
            inside = np.repeat(times > 1, times)
            start = np.cumsum(times[many]) - times[many]
            g[many] = np.add.reduceat(p[order[inside]], start, axis=0)
        squares = self.squares[row] + np.einsum("ij,ij->i", g, g) * np.float32(1 / WIDTH)
        self.squares[row] = squares
        g *= (self.rate / np.sqrt(squares))[:, None]
        self.table[row] -= g

    def moved(self) -> tuple[np.ndarray, np.ndarray]:
        """Rows in use, and their use and movement in half precision (use as a power of two)."""
        row = np.flatnonzero(self.used)
        return row, np.hstack([np.log2(self.used[row])[:, None], (self.table - self.start)[row]]).astype(np.float16)


def gradient_round(texts: DataFrame, model: MaxEnt, rate: float) -> None:
    """One round of distributed updates over ``texts``; changes ``model``'s weights."""
    shared = texts.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        m = shared.value
        outer, inner, seen = _Trainer(m.weights, rate), _Trainer(m.inner, rate), False
        for batch in batches:
            for w in word_slices(batch.column(0)):
                h, cls, bounds = token_stream(w)
                cls, place = m.targets(h, cls)
                feats = m.contexts(h, bounds)
                seen = seen or len(h) > 0
                for a in range(0, len(h), BATCH):
                    f, c, p = feats[a : a + BATCH], cls[a : a + BATCH], place[a : a + BATCH]
                    outer.step(m.class_rows(f), m.bias, c)
                    inside = np.flatnonzero(p >= 0)
                    if len(inside):
                        inner.step(m.inner_rows(f[inside], c[inside]), m.inner_bias[c[inside]], p[inside])
        if seen:
            row, moved = (np.concatenate(x) for x in zip(outer.moved(), (lambda r, v: (r + len(m.weights), v))(*inner.moved()), strict=True))
            block, first = np.unique(row // BLOCK, return_index=True)
            cut = [*first[1:], len(row)]
            packed = [(row[a:b] % BLOCK).astype(np.uint8).tobytes() + moved[a:b].tobytes() for a, b in zip(first, cut, strict=True)]
            yield pa.RecordBatch.from_arrays([pa.array(block.astype(np.int32)), pa.array(packed, pa.binary())], ["block", "moved"])

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, use, block = np.zeros((BLOCK, WIDTH)), np.zeros((BLOCK, 1)), 0
        for batch in batches:
            block = batch.column(0)[0].as_py()
            for x in batch.column(1):
                data = x.as_py()
                n = len(data) // (2 * WIDTH + 3)  # a byte for the row and halves for its use and movement
                row, moved = np.frombuffer(data, np.uint8, n), np.frombuffer(data, np.float16, offset=n).reshape(n, WIDTH + 1).astype(float)
                weight = 2 ** moved[:, :1]
                use[row] += weight
                total[row] += weight * moved[:, 1:]
        step = (total / np.maximum(use, 1)).astype(np.float32)
        yield pa.RecordBatch.from_arrays([pa.array([block], pa.int32()), pa.array([step.tobytes()], pa.binary())], ["block", "moved"])

    rows = texts.select("text").mapInArrow(run, "block int, moved binary").groupBy("block").applyInArrow(add, "block int, moved binary").collect()
    both = np.vstack([model.weights, model.inner])
    for r in rows:
        both[r.block * BLOCK : (r.block + 1) * BLOCK] += np.frombuffer(r.moved, np.float32).reshape(BLOCK, WIDTH)
    model.weights, model.inner = np.split(both, 2)
    shared.unpersist()


def train_maxent(train: DataFrame, counts: DataFrame, rounds: int = 3, rate: float = 0.25) -> MaxEnt:
    """Learn from all texts of ``train(doc_id, text)``: each is used in one of ``rounds`` rounds.

    ``counts`` is :func:`count_tokens` of the same texts. Only counts of bounded
    number reach the driver: the commonest ``HEAD`` and sums of each class.
    """
    level = F.floor(F.log2("c") * 8)  # at most HEAD tokens: whole levels of counts, from the top
    left, least = HEAD, 1 << 10
    for r in sorted(counts.groupBy(level.alias("b")).agg(F.count("*").alias("n")).collect(), reverse=True):
        left, least = left - r.n, r.b
        if left < 0:
            least += 1
            break
    top = counts.filter(level >= least).toArrow().sort_by([("c", "descending"), ("h", "ascending")])
    h, c, classes = top["h"].to_numpy().view(_U), top["c"].to_numpy(), top["cls"].to_numpy()
    k = min(len(h), COMMON * WIDTH)
    order = np.argsort(h)
    code = np.arange(k)  # classes of neighbouring ranks
    place = np.argsort(h[:k])
    inner_bias = np.full((WIDTH, WIDTH), -30.0, np.float32)
    size = np.full(WIDTH, 0.5)
    for i in range(k):
        inner_bias[code[i] // WIDTH, code[i] % WIDTH] = np.log(c[i])
        size[code[i] // WIDTH] += c[i]
    rest_norm, tokens = np.log10(np.full(WIDTH, 0.5)), 0
    for r in counts.groupBy("cls").agg(F.sum("c").alias("n"), F.count("*").alias("v")).collect():
        mine = classes[:k] == r.cls
        n, v = r.n - int(c[:k][mine].sum()), r.v - int(mine.sum())
        rest_norm[r.cls] = np.log10(n + 0.5 * (v + 1))
        size[r.cls] += n
        tokens += r.n
    low, high = BUCKET_BITS
    shape = (1 << min(high, max(low, int(counts.count()).bit_length() - 3)), WIDTH)
    model = MaxEnt(
        h[order], c[order], h[:k][place], code[place], np.log(size / size.sum()).astype(np.float32), inner_bias,
        rest_norm, np.zeros(shape, np.float32), np.zeros(shape, np.float32),
    )
    train = train.coalesce(-(-tokens // TOKENS_PER_TASK) or 1)  # small partitions share a task, without a shuffle
    for i in range(rounds if k else 0):
        gradient_round(train.filter(F.pmod(F.xxhash64("doc_id", F.lit("round")), F.lit(rounds)) == i), model, rate)
    return model


def score_texts(docs: DataFrame, rounds: int = 3, rate: float = 0.25) -> DataFrame:
    """Score whole texts: ``doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score``.

    Learns from the rows of ``docs(doc_id, text)`` whose crc32(doc_id as text) mod 5
    is not 1 (a null doc_id counts as such); the others are ``held_out``. Tokens are
    the words and one end; null texts are empty. ``base_score`` is the smoothed
    unigram's log10 probability, ``score`` the model's. Counts of all but the
    ``HEAD`` commonest tokens are joined, not broadcast. One row comes back for each
    row, repeated doc_ids too; without training rows both scores treat every token
    as unseen. Null texts are empty ones; columns besides doc_id and text are ignored;
    an empty table gives no rows.
    """
    spark = docs.sparkSession
    held = F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 1, F.lit(False))
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    train = docs.filter(~held)
    counts = materialize(count_tokens(train))
    n, v = counts.agg(F.coalesce(F.sum("c"), F.lit(0)), F.count("*")).first()
    model = train_maxent(train, counts, rounds, rate)
    shared = spark.sparkContext.broadcast(model)

    def run(batches):
        m = shared.value
        log_count = np.log10(m.head_count + 0.5)
        for batch in batches:
            ids, keys = batch.column(0), batch.column(1).to_numpy()
            for w in word_slices(batch.column(2)):
                h, cls, bounds = token_stream(w)
                value, common = m.log10_probabilities(h, cls, bounds)
                at = np.minimum(np.searchsorted(m.head, h), max(len(m.head) - 1, 0))
                known = m.head[at] == h if len(m.head) else np.zeros(len(h), bool)
                logs = np.where(known, log_count[at] if len(m.head) else 0.0, 0.0)
                doc = np.repeat(np.arange(w.n_docs), np.diff(bounds))
                total = lambda x: np.bincount(doc, x, minlength=w.n_docs)  # noqa: B023, E731
                far = np.flatnonzero(~known)
                pair = np.stack([doc[far].astype(_U), h[far]], axis=1)
                order = np.lexsort((pair[:, 1], pair[:, 0]))
                pair = pair[order]
                new = np.ones(len(pair), bool)
                new[1:] = (pair[1:] != pair[:-1]).any(axis=1)
                start = np.flatnonzero(new)
                times = np.diff(np.append(start, len(pair)))
                rows, t = keys[w.first : w.first + w.n_docs], len(start)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.concat_arrays([ids.slice(w.first, w.n_docs), pa.nulls(t, pa.int64())]),
                        pa.array(np.concatenate([rows, rows[pair[start, 0].astype(np.int64)]])),
                        pa.concat_arrays([pa.nulls(w.n_docs, pa.int64()), pa.array(pair[start, 1].view(np.int64))]),
                        pa.array(np.concatenate([np.diff(bounds), times]).astype(np.int64)),
                        pa.array(np.concatenate([total(known.astype(float)), np.zeros(t)]).astype(np.int64)),
                        pa.array(np.concatenate([total(logs), np.zeros(t)])),
                        pa.array(np.concatenate([total(value + np.where(common, 0.0, logs)), np.zeros(t)])),
                    ],
                    ["doc_id", "row", "h", "n", "known", "logs", "value"],
                )

    rows = docs.select("doc_id", F.monotonically_increasing_id().alias("row"), "text")
    rows = materialize(rows.mapInArrow(run, "doc_id long, row long, h long, n long, known long, logs double, value double"))
    far = rows.filter("h IS NOT NULL").select("row", "h", "n").join(counts.select("h", "c"), "h", "left")
    log_c = F.col("n") * F.log10(F.coalesce("c", F.lit(0)) + 0.5)
    far = far.groupBy("row").agg(F.sum(log_c).alias("far_logs"), F.sum(F.when(F.col("c") > 0, F.col("n")).otherwise(0)).alias("far_known"))
    out = rows.filter("h IS NULL").join(far, "row", "left").fillna(0, ["far_logs", "far_known"])
    norm = float(np.log10(n + 0.5 * (v + 1)))
    return out.select(
        "doc_id", held.alias("held_out"), F.col("n").alias("n_tokens"), (F.col("known") + F.col("far_known")).alias("n_known"), F.lit(n).cast("long").alias("train_tokens"),
        (F.col("logs") + F.col("far_logs") - F.col("n") * norm).alias("base_score"), (F.col("value") + F.col("far_logs")).alias("score"),
    )
