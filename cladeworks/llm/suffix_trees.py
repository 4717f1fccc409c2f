"""Repeated passages by prefix-partitioned suffix trees over words.

A passage of ``words`` words that stands in two places is a node of that depth in the
suffix tree of all texts. The tree is built in parts that fit a task:

1. Suffixes start at anchors: in each window of ``words`` words the place of its
   k-word sequence of least hash. Equal windows have equal anchors, neighbouring
   windows mostly share one, so one suffix stands for several windows. It carries
   the words of these windows, to the right and to the left of its first k.
2. The first k words are the prefix that parts the suffixes. A prefix that stands once
   has no node below it and goes no further (a filter of bounded size, sized by the
   number of repeated prefixes; where it is full, more get through). A prefix with more
   suffixes than a task should hold is lengthened to all words that its suffixes carry;
   those of the same words are then one, at the least of their places, which is
   aggregated before the shuffle.
3. Each task sorts its prefixes' suffixes, rightwards and leftwards; the common lengths
   of neighbours are the inner nodes. Leaves below one node of full depth are places of
   one passage, of which the first stays. Where the prefix is the whole passage the
   leaves need no tree, only their least place.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import compress

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .flat import Words, mix, word_slices
from .shared import materialize

GROUP_ROWS = 4096  # suffixes of one prefix in a task
TASK_ROWS = 1 << 15  # suffixes sorted at a time
BLOCK_BITS = 17
MAX_FILTER_BITS = 28  # 32 MB
_U = np.uint64
_NO_ID = (1 << 63) - 1  # null doc_ids come last


def _grams(hashes: np.ndarray, k: int) -> np.ndarray:
    """A hash of the k words from each place on; the last k - 1 places have none."""
    n = max(0, len(hashes) - k + 1)
    value = np.zeros(n, _U)
    for j in range(k):
        value = mix(value * _U(0x2545F4914F6CDD1D) + hashes[j : j + n] + _U(j + 1))
    return value


class _Anchors:
    """Anchors of a slice of documents: place ``q`` of each and the windows ``low`` to ``high`` that it stands for."""

    def __init__(self, w: Words, words: int, k: int):
        self.hashes = w.hashes(fold=False)
        grams = _grams(self.hashes, k)
        sizes = np.maximum(np.diff(w.bounds) - words + 1, 0)
        ends = np.cumsum(sizes)
        starts = np.arange(ends[-1] if len(ends) else 0) + np.repeat(w.bounds[:-1] - (ends - sizes), sizes)
        least, at = grams[starts], np.zeros(len(starts), np.int64)
        for j in range(1, words - k + 1):
            other = grams[starts + j]
            less = other < least
            least, at = np.where(less, other, least), np.where(less, j, at)
        q = starts + at
        new = np.ones(len(q), bool)
        new[1:] = q[1:] != q[:-1]
        first = np.flatnonzero(new)
        self.q, self.low = q[first], starts[first]
        self.gram = mix(least[first] ^ _U(0xA0761D6478BD642F))  # least hashes are small: spread anew
        self.high = starts[np.append(first[1:], len(q)) - 1] if len(q) else starts
        self.doc = np.repeat(np.arange(w.n_docs), sizes)[first]
        self.base = w.bounds[self.doc]


def _filter(grams: DataFrame, count: int) -> np.ndarray:
    """Bits of the hashes ``gram`` by their first bits; 16 kB to 32 MB, built by blocks of them."""
    bits = min(MAX_FILTER_BITS, max(BLOCK_BITS, (8 * count).bit_length()))

    def run(batches):
        now, block = None, np.zeros(1 << BLOCK_BITS, bool)
        for batch in batches:
            cells = (batch.column(0).to_numpy().view(_U) >> _U(64 - bits)).astype(np.int64)
            for b in np.unique(blocks := cells >> BLOCK_BITS):
                if b != now:
                    if now is not None:
                        yield _block(now, block)
                    now, block = int(b), np.zeros(1 << BLOCK_BITS, bool)
                block[cells[blocks == b] & ((1 << BLOCK_BITS) - 1)] = True
        if now is not None:
            yield _block(now, block)

    # Signed order within a partition keeps blocks together.
    key = F.shiftrightunsigned("gram", 64 - bits + BLOCK_BITS) if bits > BLOCK_BITS else F.lit(0).cast("long")
    rows = grams.select("gram", key.alias("block")).repartition("block").sortWithinPartitions("block").select("gram")
    out = np.zeros((1 << bits) // 8, np.uint8)
    for row in rows.mapInArrow(run, "block long, bits binary").collect():
        size = (1 << BLOCK_BITS) // 8
        out[row.block * size : (row.block + 1) * size] |= np.frombuffer(row.bits, np.uint8)
    return out


def _block(number: int, block: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([number], pa.int64()), pa.array([np.packbits(block, bitorder="little").tobytes()], pa.binary())], ["block", "bits"])


def _held(bits: np.ndarray, grams: np.ndarray) -> np.ndarray:
    cell = (grams >> _U(64 - (len(bits) * 8).bit_length() + 1)).astype(np.int64)
    return (bits[cell >> 3] >> (cell & 7).astype(np.uint8)) & 1 == 1


def _spans(places: np.ndarray, sizes: np.ndarray, step: int = 1) -> np.ndarray:
    """``sizes[i]`` places from ``places[i]`` on, one after the other."""
    ends = np.cumsum(sizes)
    return np.repeat(places, sizes) + step * (np.arange(ends[-1] if len(ends) else 0) - np.repeat(ends - sizes, sizes))


def _suffixes(docs: DataFrame, words: int, k: int, wanted, collapse: bool = False) -> DataFrame:
    """Suffixes of the prefixes that ``wanted`` picks, with the words beside their first k.

    With ``collapse`` those of one document with the same words are one row, at the
    least place, and ``later`` holds their other places.
    """
    kinds = ["gram", "id", "hash", "q", "left", "right", "beside"]

    def run(batches):
        for batch in batches:
            ids, texts = batch.column(0).to_numpy(), batch.column(1).to_numpy()
            for w in word_slices(batch.column(2)):
                a = _Anchors(w, words, k)
                keep = np.flatnonzero(wanted(a.gram))
                later = None
                if collapse:
                    keep, later = _same_words(a, keep, words, k)
                q, doc = a.q[keep], w.first + a.doc[keep]
                left, right = q - a.low[keep], words - k - (q - a.high[keep])
                # Right words, then left ones from the nearest on.
                at = np.concatenate([_spans(q + k, right), _spans(q - 1, left, -1)])
                order = np.concatenate([np.repeat(2 * np.arange(len(q)), right), np.repeat(2 * np.arange(len(q)) + 1, left)])
                flat = a.hashes[at[np.argsort(order, kind="stable")]]
                offsets = np.concatenate([[0], np.cumsum(8 * (left + right))]).astype(np.int32)
                beside = pa.Array.from_buffers(pa.binary(), len(q), [None, pa.py_buffer(offsets.tobytes()), pa.py_buffer(flat.tobytes())])
                columns = [pa.array(a.gram[keep].view(np.int64)), pa.array(ids[doc]), pa.array(texts[doc]), pa.array(q - a.base[keep]), pa.array(left.astype(np.int32)), pa.array(right.astype(np.int32)), beside]
                yield pa.RecordBatch.from_arrays([*columns, *([later] if collapse else [])], [*kinds, *(["later"] if collapse else [])])

    return docs.mapInArrow(run, "gram long, id long, hash long, q long, left int, right int, beside binary" + (", later array<long>" if collapse else ""))


def _same_words(a: _Anchors, keep: np.ndarray, words: int, k: int) -> tuple[np.ndarray, pa.ListArray]:
    """Of the anchors ``keep`` the first of each document and words, and the places of the others."""
    q = a.q[keep]
    left, right = q - a.low[keep], words - k - (q - a.high[keep])
    last = max(0, len(a.hashes) - 1)
    key = mix(a.gram[keep] ^ (left * 64 + right).astype(_U))
    for j in range(words - k):
        for there, at in ((right > j, q + k + j), (left > j, q - 1 - j)):
            word = a.hashes[np.clip(at, 0, last)] if len(q) else np.zeros(0, _U)
            key = mix(key * _U(0x2545F4914F6CDD1D) + np.where(there, word, _U(0)))
    order = np.lexsort((q, key, a.doc[keep]))
    new = np.ones(len(order), bool)
    new[1:] = (key[order][1:] != key[order][:-1]) | (a.doc[keep][order][1:] != a.doc[keep][order][:-1])
    others = np.diff(np.append(np.flatnonzero(new), len(order))) - 1
    offsets = np.concatenate([[0], np.cumsum(others)]).astype(np.int32)
    places = (q - a.base[keep])[order][~new]
    return keep[order[new]], pa.ListArray.from_arrays(pa.array(offsets), pa.array(places))


def _beside(batch: pa.RecordBatch, n_left: int, n_right: int, span: int) -> list[np.ndarray]:
    """Words to the right and to the left of each suffix of a batch, the nearest first, as rows of two matrices."""
    left, right = (batch.column(i).to_numpy().astype(np.int64) for i in (n_left, n_right))
    n, beside = len(batch), batch.column("beside")
    _, where, data = beside.buffers()
    offsets = np.frombuffer(where, np.int32)[beside.offset : beside.offset + n + 1].astype(np.int64)
    flat = np.frombuffer(data, np.uint8)[offsets[0] : offsets[-1]].view(_U) if n and offsets[-1] > offsets[0] else np.zeros(0, _U)
    at = (offsets[:-1] - offsets[0]) // 8
    sides = []
    for begin, size in ((at, right), (at + right, left)):
        matrix = np.zeros((span, n), _U)
        matrix[_spans(np.zeros(n, np.int64), size), np.repeat(np.arange(n), size)] = flat[_spans(begin, size)]
        sides.append(matrix)
    return sides


def _frequent(suffixes: DataFrame, words: int, k: int) -> DataFrame:
    """Repeated windows of prefixes with too many suffixes for a task: ``id, hash, starts, bits`` (arrays).

    ``suffixes``: collapsed. Those with the same words count as one, at their least
    place; of these only the windows are taken apart, each with all its words as its prefix.
    """
    span = words - k
    content = ["gram", "left", "right", "beside"]
    keyed = suffixes.withColumns({"ka": F.xxhash64(*content), "kb": F.xxhash64(F.lit(1), *content)})
    keyed = materialize(keyed)
    firsts = keyed.groupBy("ka", "kb").agg(F.min(F.struct("id", "hash", "q")).alias("first"), *(F.first(c).alias(c) for c in content))
    firsts = materialize(firsts.select("ka", "kb", "first.id", "first.hash", "first.q", *content))

    def windows(batches):
        for batch in batches:
            right, left = _beside(batch, 6, 7, span)
            n_left, n_right = batch.column(6).to_numpy(), batch.column(7).to_numpy()
            gram = batch.column(5).to_numpy().view(_U)
            for back in range(span + 1):
                rows = np.flatnonzero((n_left >= back) & (span - n_right <= back))
                keys = []
                for seed in (0x2545F4914F6CDD1D, 0xD6E8FEB86659FD93):
                    key = mix(gram[rows] ^ _U(seed)) + _U(back)
                    for word in (*right[: span - back], *left[:back]):
                        key = mix(key * _U(seed) + word[rows])
                    keys.append(pa.array(key.view(np.int64)))
                at = pa.array(rows)
                yield pa.RecordBatch.from_arrays(
                    [*keys, *(batch.column(i).take(at) for i in range(5)), pa.array(np.full(len(rows), back, np.int32))], ["wa", "wb", "ka", "kb", "id", "hash", "q", "back"]
                )

    each = firsts.mapInArrow(windows, "wa long, wb long, ka long, kb long, id long, hash long, q long, back int")
    place = F.struct("id", "hash", "q")
    least = each.groupBy("wa", "wb").agg(F.min(place).alias("least"))
    late = each.join(least, ["wa", "wb"]).filter(place > F.col("least"))
    bits = late.groupBy("ka", "kb").agg(F.sum(F.expr(f"shiftleft(1L, {span} - back)")).alias("late"))
    known = firsts.select("ka", "kb", place.alias("first")).join(bits, ["ka", "kb"], "left")
    met = keyed.select("ka", "kb", "id", "hash", "q", "left", "right", "later").join(known, ["ka", "kb"])
    # Another one of the same words repeats all windows of the first; bit span - back for each of them.
    every = F.expr(f"shiftleft(2L, right) - shiftleft(1L, {span} - left)")
    own = F.when(place > F.col("first"), every).otherwise(F.coalesce("late", F.lit(0)))
    starts = F.transform(F.concat(F.array("q"), "later"), lambda x: x - span)
    bits = F.concat(F.array(own), F.transform("later", lambda _: every))
    return met.filter((own != 0) | (F.size("later") > 0)).select("id", "hash", starts.alias("starts"), bits.alias("bits"))


def _depths(keys: list[np.ndarray], group: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Order of sorted suffixes, and the words that each has in common with the one before (-1: another group)."""
    order = np.lexsort([*reversed(keys), group])
    common, open_ = np.full(len(order), -1, np.int64), group[order][1:] == group[order][:-1]
    common[1:][open_] = 0
    for key in keys:
        open_ = open_ & (key[order][1:] == key[order][:-1])
        common[1:] += open_
    return order, common


def _repeated(batch: pa.RecordBatch, words: int, k: int) -> pa.RecordBatch:
    """Windows of whole groups of suffixes that aren't the first place of their passage, as bits from ``start`` on."""
    group, ids, texts, q, left, right = (batch.column(i).to_numpy() for i in range(6))
    left, right, n, span = left.astype(np.int64), right.astype(np.int64), len(batch), words - k
    sides = [_depths(list(matrix), group) for matrix in _beside(batch, 4, 5, span)]
    by_place = np.lexsort((q, texts, ids))
    place = np.zeros(n, np.int64)
    step = (ids[by_place][1:] != ids[by_place][:-1]) | (texts[by_place][1:] != texts[by_place][:-1]) | (q[by_place][1:] != q[by_place][:-1])
    place[by_place[1:]] = np.cumsum(step)
    bits = np.zeros(n, np.int64)
    for back in range(span + 1):  # windows that begin so many words before the anchor
        rows = np.flatnonzero((left >= back) & (span - right <= back))
        if len(rows) < 2:
            continue
        key = np.zeros(n, np.int64)
        for (order, common), depth in zip(sides, (span - back, back), strict=True):
            node = np.empty(n, np.int64)
            node[order] = np.cumsum(common < depth)
            key = key * (n + 1) + node
        own = key[rows]
        order = np.lexsort((place[rows], own))
        new = np.ones(len(rows), bool)
        new[1:] = own[order][1:] != own[order][:-1]
        first = place[rows][order][np.flatnonzero(new)][np.cumsum(new) - 1]
        late = rows[order[place[rows][order] != first]]
        bits[late] |= 1 << (span - back)
    late = np.flatnonzero(bits)
    return pa.RecordBatch.from_arrays([pa.array(ids[late]), pa.array(texts[late]), pa.array(q[late] - span), pa.array(bits[late])], ["id", "hash", "start", "bits"])


def repeated_windows(docs: DataFrame, words: int) -> list[DataFrame]:
    """Windows that repeat an earlier one, by document: tables of ``id, hash, starts, bits``, bit j of a place for the window at ``start + j``.

    ``docs``: ``id long, hash long, text``; ``hash`` tells texts with one id apart.
    """
    k = max(1, 2 * words // 5)
    spark = docs.sparkSession

    def prefixes(batches):
        for batch in batches:
            for w in word_slices(batch.column(2)):
                gram, n = np.unique(_Anchors(w, words, k).gram, return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array(gram.view(np.int64)), pa.array(n)], ["gram", "n"])

    counts = docs.mapInArrow(prefixes, "gram long, n long").groupBy("gram").agg(F.sum("n").alias("n"))
    counts = materialize(counts.filter("n > 1"))
    often = counts.filter(F.col("n") > GROUP_ROWS)
    n_often = often.count()
    once = spark.sparkContext.broadcast(_filter(counts, counts.count()))
    hot = spark.sparkContext.broadcast(_filter(often, n_often))
    few = lambda gram: _held(once.value, gram) & ~_held(hot.value, gram)
    suffixes = _suffixes(docs, words, k, few).repartition("gram").sortWithinPartitions("gram")

    def trees(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        for batch in batches:
            held.append(batch)
            if sum(map(len, held)) >= TASK_ROWS:
                whole = pa.Table.from_batches(held).combine_chunks().to_batches()[0]
                gram = whole.column(0).to_numpy()
                cut = int(np.searchsorted(gram, gram[-1]))  # the last group may go on
                if cut:
                    yield _repeated(whole.slice(0, cut), words, k)
                held = [whole.slice(cut)]
        for whole in pa.Table.from_batches(held).combine_chunks().to_batches() if held else ():
            yield _repeated(whole, words, k)

    found = suffixes.mapInArrow(trees, "id long, hash long, start long, bits long")
    by_document = [found.groupBy("id", "hash").agg(F.collect_list("start").alias("starts"), F.collect_list("bits").alias("bits"))]
    if n_often:
        often = _frequent(_suffixes(docs, words, k, lambda gram: _held(hot.value, gram), True), words, k)
        by_document.append(often.groupBy("id", "hash").agg(*(F.flatten(F.collect_list(c)).alias(c) for c in ("starts", "bits"))))
    return by_document


def cut_repeats(docs: DataFrame, words: int = 20) -> DataFrame:
    """Texts without the words of passages that also start earlier.

    A window is ``words`` consecutive words (``[^\\x20\\x09-\\x0D]+``, unchanged) of one
    document. A word goes if any window over it has the words of one that starts
    earlier: in a document with a smaller doc_id, or before it in the same one; windows
    are judged on ``docs`` as given. Returns ``doc_id, n_words long, n_removed long,
    removed array<struct<start long, end long>>`` (spans of words, from 0, the end not
    in it) and ``kept`` (the other words, joined by one space), a row for each input row.

    Null and empty texts have no words. A null doc_id comes after all others. Rows that
    share doc_id and text count as one document, and each has its result; other texts
    of one doc_id come in the order of a hash. Other columns are ignored.
    """
    if not 1 <= words <= 100:
        raise ValueError("words must be 1 to 100")
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    rows = rows.select("doc_id", F.coalesce("doc_id", F.lit(_NO_ID)).alias("id"), F.xxhash64("text").alias("hash"), "text")
    joined = rows
    for i, marks in enumerate(repeated_windows(rows.select("id", "hash", "text"), words)):
        joined = joined.join(marks.withColumnsRenamed({"starts": f"starts{i}", "bits": f"bits{i}"}), ["id", "hash"], "left")
    joined = joined.drop("id", "hash")

    def run(batches):
        for batch in batches:
            out: tuple[list, ...] = ([], [], [], [])
            size = 0
            begun = 0
            for i in range(len(batch)):
                w = batch.column(1)[i].as_buffer().to_pybytes().split()
                gone = np.zeros(len(w) + 1, np.int64)
                for c in range(2, batch.num_columns, 2):
                    if not batch.column(c)[i].is_valid:
                        continue
                    start, bits = (np.asarray(batch.column(c + d)[i].values) for d in (0, 1))
                    for j in range(words):
                        at = start[bits >> j & 1 == 1] + j
                        np.add.at(gone, at, 1)
                        np.add.at(gone, at + words, -1)
                stays = np.cumsum(gone)[: len(w)] == 0
                edge = np.flatnonzero(np.diff(np.concatenate([[True], stays, [True]]).astype(np.int8))).reshape(-1, 2)
                out[0].append(len(w))
                out[1].append(len(w) - int(stays.sum()))
                out[2].append([{"start": int(a), "end": int(b)} for a, b in edge])
                out[3].append(b" ".join(compress(w, stays.tolist())))
                size += len(out[3][-1])
                if size > 1 << 24 or i + 1 == len(batch):
                    spans = pa.array(out[2], pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())])))
                    yield pa.RecordBatch.from_arrays(
                        [batch.column(0).slice(begun, i + 1 - begun), pa.array(out[0], pa.int64()), pa.array(out[1], pa.int64()), spans, pa.array(out[3], pa.binary())],
                        ["doc_id", "n_words", "n_removed", "removed", "kept"],
                    )
                    out, size, begun = ([], [], [], []), 0, i + 1

    cut = joined.mapInArrow(run, "doc_id long, n_words long, n_removed long, removed array<struct<start:long,end:long>>, kept binary")
    return cut.withColumn("kept", F.col("kept").cast("string"))
