"""SentencePiece encoding with N-best segmentation, and decoding.

A text is a lattice of vocabulary pieces. Forward Viterbi scores of every position
are exact heuristics for an A* search backward from the end, which so completes
segmentations in order of score. No piece holds a blank but at its beginning, so the
lattice falls apart before each run of blanks: units are solved once and kept, and
the search over a whole text deviates from the best path only in the units whose
second-best segmentation costs least.
"""

from __future__ import annotations

import bisect
import heapq
import math
import re
from dataclasses import dataclass, field
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import types as T

_UNIT = re.compile(r" +[^ ]*|[^ ]+")
_LOW = -1e18
_NEVER = -1e8  # pieces of lower scores are there, but not used


@dataclass
class Vocabulary:
    """Pieces (with plain blanks) and log probabilities of a model with byte fallback.

    A unigram model has such scores. Those of a BPE model are merge ranks, whose sums
    would prefer many early merges to whole words; they become probabilities by Zipf's law.
    """

    pieces: list[str]
    scores: list[float]
    normal: list[bool]
    byte_ids: list[int]

    @classmethod
    def load(cls, model_file: str) -> Vocabulary:
        """Read pieces and scores of a model file on the driver."""
        import sentencepiece

        sp = sentencepiece.SentencePieceProcessor(model_file=model_file)
        n = sp.get_piece_size()
        normal = [not (sp.is_byte(i) or sp.is_control(i) or sp.is_unknown(i) or sp.is_unused(i)) for i in range(n)]
        pieces = [sp.id_to_piece(i).replace("▁", " ") if normal[i] else sp.id_to_piece(i) for i in range(n)]
        bytes_ = [sp.piece_to_id(f"<0x{b:02X}>") for b in range(256)]
        if not all(sp.is_byte(i) for i in bytes_):
            raise ValueError("the model has no byte pieces, so texts may not survive encoding")
        if any(" " in p.lstrip(" ") for p, ok in zip(pieces, normal, strict=True) if ok):
            raise ValueError("a piece holds a blank after a letter")
        scores = [sp.get_score(i) for i in range(n)]
        held = [s for s, ok in zip(scores, normal, strict=True) if ok and s > _NEVER]
        if _are_ranks(held):
            likely = _by_rank(held)
            scores = [likely[s] if ok and s > _NEVER else s for s, ok in zip(scores, normal, strict=True)]
        return cls(pieces, scores, normal, bytes_)


def _are_ranks(scores: list[float]) -> bool:
    """Whether scores are merge ranks of a BPE model, negated: whole numbers, each once."""
    return len(scores) > 1 and all(s <= 0 and float(s).is_integer() for s in scores) and len(set(scores)) == len(scores)


def _by_rank(scores: list[float]) -> dict[float, float]:
    """Log probabilities by Zipf's law, 1 / (rank * H), which sum to 1 over all scores.

    They are multiples of 2^-16, so that sums are exact in any order and ties stay ties.
    """
    log_h = math.log(sum(1 / k for k in range(1, len(scores) + 1)))
    return {s: round((-math.log(k) - log_h) * 65536) / 65536 for k, s in enumerate(sorted(scores, reverse=True), 1)}


_SPREAD = (np.uint64(0xD6E8FEB86659FD93), np.uint64(0xA0761D6478BD642F))
_SLOTS = 20  # bits of a lookup table
SLICE_ROWS, SLICE_BYTES = 512, 3 << 20  # texts that are Python objects at a time
TOGETHER = 48  # units of a length from which numpy pays


@dataclass
class Segmenter:
    """Segmentation that keeps up to about ``cache_units`` solved units.

    Kept units have a number; score, loss of the second-best way, and the place and
    number of their piece ids stand in arrays under it.
    """

    vocabulary: Vocabulary
    cache_units: int = 200_000
    edges: dict[str, tuple[float, int]] = field(init=False, repr=False)

    def __post_init__(self):
        v = self.vocabulary
        self.edges = {p: (s, i) for i, (p, s, ok) in enumerate(zip(v.pieces, v.scores, v.normal, strict=True)) if ok}
        self.longest = max(map(len, self.edges))
        self.unknown = min((s for s, _ in self.edges.values() if s > _NEVER), default=0.0) - 10.0
        self.score_of = np.array([*v.scores, _LOW])
        self._tables()
        self.forget()

    def forget(self) -> None:
        """Drop all kept units."""
        self.number: dict[str, int] = {}
        self.score, self.gap, self.place, self.size = np.zeros(0), np.zeros(0), np.zeros(0, np.int64), np.zeros(0, np.int64)
        self.ids = np.zeros(0, np.int32)
        self.others: dict = {}

    def _tables(self) -> None:
        """The trie of all pieces: node and character, exact in 64 bits, to the next node, in two tables of one slot a key."""
        node = {"": 0}
        for piece in self.edges:
            for k in range(1, len(piece) + 1):
                node.setdefault(piece[:k], len(node))
        self.piece_at = np.full(len(node), -1, np.int32)
        for piece, (_, i) in self.edges.items():
            self.piece_at[node[piece]] = i
        text = list(node)[1:]
        key = np.array([node[t[:-1]] << 21 | ord(t[-1]) for t in text], np.uint64) + np.uint64(1)  # 0 is an empty slot
        slots = [((key * spread) >> np.uint64(64 - _SLOTS)).astype(np.int64).tolist() for spread in _SPREAD]
        held: list[dict[int, int]] = [{}, {}]
        for i in range(len(text)):
            which, now = 0, i
            while now is not None:  # what stood in the slot goes to its other one
                slot = slots[which][now]
                before = held[which].get(slot)
                held[which][slot] = now
                now, which = before, which ^ 1
        self.keys = [np.zeros(1 << _SLOTS, np.uint64) for _ in _SPREAD]
        self.to = [np.zeros(1 << _SLOTS, np.int64) for _ in _SPREAD]
        for keys, to, rows in zip(self.keys, self.to, held, strict=True):
            at, i = np.array(list(rows), np.int64), np.array(list(rows.values()), np.int64)
            keys[at], to[at] = key[i], i + 1  # node numbers are in order of the texts

    def _step(self, node: np.ndarray, chars: np.ndarray) -> np.ndarray:
        """Next nodes of the trie, -1 for none."""
        key = (node.astype(np.uint64) << np.uint64(21)) + chars
        out = np.full(len(node), -1, np.int64)
        for keys, to, spread in zip(self.keys, self.to, _SPREAD, strict=True):
            slot = ((key * spread) >> np.uint64(64 - _SLOTS)).astype(np.int64)
            hit = np.flatnonzero(keys[slot] == key)
            out[hit] = to[slot[hit]]
        return out

    def solve_all(self, units: set[str]) -> None:
        """Forward Viterbi over units that aren't kept yet, those of a length together."""
        by: dict[int, list[str]] = {}
        for u in units:
            if u not in self.number:
                by.setdefault(len(u), []).append(u)
        parts: list[tuple] = []
        for length, group in by.items():
            if length >= 64 or len(group) < TOGETHER:
                parts += [self._solve_one(u) for u in group]
            else:
                for at in range(0, len(group), 8192):
                    parts += self._solve_group(group[at : at + 8192], length)
        if not parts:
            return
        names = list(chain.from_iterable([p[0] for p in parts]))
        self.number.update(zip(names, range(len(self.number), len(self.number) + len(names)), strict=True))
        size = np.concatenate([p[3] for p in parts])
        self.score = np.concatenate([self.score, *(p[1] for p in parts)])
        self.gap = np.concatenate([self.gap, *(p[2] for p in parts)])
        self.place = np.concatenate([self.place, len(self.ids) + np.cumsum(size) - size])
        self.size = np.concatenate([self.size, size])
        self.ids = np.concatenate([self.ids, *(p[4] for p in parts)])

    def _solve_one(self, unit: str) -> tuple:
        best, second, back = self._forward(unit)
        cuts, at = [], len(unit)
        while at:
            cuts.append(unit[back[at] : at])
            at = back[at]
        ids = [i for piece in reversed(cuts) for i in self._ids(piece)]
        gap = best[-1] - second[-1] if second[-1] > _LOW / 2 else np.inf
        return [unit], np.array([best[-1]]), np.array([gap]), np.array([len(ids)]), np.array(ids, np.int32)

    def _solve_group(self, group: list[str], length: int) -> list[tuple]:
        n = len(group)
        chars = np.frombuffer("".join(group).encode("utf-32-le", "surrogatepass"), np.uint32).reshape(n, length).T.astype(np.uint64) + np.uint64(1)
        best, second = np.full((length + 1, n), _LOW), np.full((length + 1, n), _LOW)
        came = np.zeros((length + 1, n), np.int64)  # (piece + 1) * 64 + start
        best[0] = 0.0
        one_byte = np.array(self.vocabulary.byte_ids[:128], np.int32)
        for start in range(length):
            node, rows = np.zeros(n, np.int64), slice(None)  # rows: units in which a piece may still go on
            for end in range(start + 1, min(length, start + self.longest) + 1):
                node = self._step(node, chars[end - 1, rows])
                ids = np.where(node >= 0, self.piece_at[node], np.int32(-1))
                hit = rows
                if end == start + 1:
                    score = self.score_of[ids]
                    miss = np.flatnonzero(ids < 0)
                    score[miss] = self.unknown
                    c = chars[start, miss].astype(np.int64) - 1
                    ids[miss] = np.where(c < 128, one_byte[np.minimum(c, 127)], -1)
                else:
                    found = np.flatnonzero(ids >= 0)
                    hit, ids = found if isinstance(rows, slice) else rows[found], ids[found]
                    score = self.score_of[ids]
                one, two, was = best[start, hit] + score, second[start, hit] + score, best[end, hit]
                better = one > was
                second[end, hit] = np.maximum(np.maximum(second[end, hit], np.minimum(one, was)), two)
                best[end, hit] = np.maximum(one, was)
                came[end, hit] = np.where(better, (ids + np.int64(1)) * 64 + start, came[end, hit])
                alive = np.flatnonzero(node >= 0)
                if not len(alive):
                    break
                if 2 * len(alive) < len(node):  # dead nodes have no next ones, so they may stay a while
                    node, rows = node[alive], alive if isinstance(rows, slice) else rows[alive]
        # Backward through all units at once; the pieces come out last first.
        steps, at, every = [], np.full(n, length), np.arange(n)
        while at.any():
            code = came[at, every]
            steps.append(np.where(at > 0, code >> 6, -1))
            at = np.where(at > 0, code & 63, 0)
        pieces = np.stack(steps[::-1], axis=1) - 1
        odd = (pieces == -1).any(axis=1)  # a character without a piece and of several bytes
        plain = np.flatnonzero(~odd)
        used = pieces[plain] >= 0
        gap = np.where(second[length] > _LOW / 2, best[length] - second[length], np.inf)
        part = ([group[i] for i in plain], best[length][plain], gap[plain], used.sum(axis=1), pieces[plain][used].astype(np.int32))
        return [part, *(self._solve_one(group[i]) for i in np.flatnonzero(odd))]

    def _forward(self, unit: str) -> tuple[list[float], list[float], list[int]]:
        """Per position the best and second-best score of reaching it, and where the best came from."""
        n, edges, longest = len(unit), self.edges, self.longest
        best, second, back = [0.0] + [_LOW] * n, [_LOW] * (n + 1), [0] * (n + 1)
        for end in range(1, n + 1):
            top = low = _LOW
            came = end - 1
            for start in range(end - longest if end > longest else 0, end):
                edge = edges.get(unit[start:end])
                if edge is None and start != end - 1:
                    continue
                score = edge[0] if edge else self.unknown
                one, two = best[start] + score, second[start] + score
                if one > top:
                    low = max(top, two)
                    top, came = one, start
                else:
                    low = max(low, one)
            best[end], second[end], back[end] = top, low, came
        return best, second, back

    def _ids(self, piece: str) -> tuple[int, ...]:
        edge = self.edges.get(piece)
        return (edge[1],) if edge else tuple(self.vocabulary.byte_ids[b] for b in piece.encode("utf-8", "surrogatepass"))

    def solve(self, unit: str) -> tuple[tuple[int, ...], float, float]:
        """Best ids of a unit, their score, and what the second-best segmentation costs more."""
        self.solve_all({unit})
        k = self.number[unit]
        return tuple(self.ids[self.place[k] : self.place[k] + self.size[k]].tolist()), float(self.score[k]), float(self.gap[k])

    def _ways(self, unit: str, n: int) -> list[tuple[float, tuple[int, ...]]]:
        """The ``n`` best ways through a unit, the kept one first also where others tie with it."""
        found = self.others.get((unit, n))
        if found is None:
            ids, score, _ = self.solve(unit)
            found = [(score, ids), *(w for w in self.nbest_unit(unit, n) if w[1] != ids)][:n]
            if len(self.others) >= 20_000:
                self.others.clear()
            self.others[unit, n] = found
        return found

    def nbest_unit(self, unit: str, n: int) -> list[tuple[float, tuple[int, ...]]]:
        """The ``n`` best segmentations of a unit, by backward A*.

        A state holds the last piece and the state behind it, so it has one size however
        long the unit is. The open states stand for separate sets of segmentations, and
        each one's estimate is the score of one in its set: only the best ``n`` of them
        can still count, so no more are kept. Of equal ones those nearer to the
        beginning come first.
        """
        best, _, _ = self._forward(unit)
        states: list[tuple] = [(-best[-1], len(unit), 0, 0.0, None)]
        out: list[tuple[float, tuple[int, ...]]] = []
        made = 0
        while states and len(out) < n:
            _, at, _, done, tail = states.pop(0)
            if at == 0:
                ids: list[int] = []
                while tail is not None:
                    ids += self._ids(tail[0])
                    tail = tail[1]
                out.append((done, tuple(ids)))
                continue
            for start in range(max(0, at - self.longest), at):
                piece = unit[start:at]
                edge = self.edges.get(piece)
                if edge is None and start != at - 1:
                    continue
                score = done + (edge[0] if edge else self.unknown)
                made += 1
                bisect.insort(states, (-(best[start] + score), start, made, score, (piece, tail)))
            del states[n - len(out) :]
        return out

    def encode_all(self, texts: list[str], n: int = 1, paths: bool = False) -> tuple[np.ndarray, np.ndarray, list[list[float]], list]:
        """The ``n`` best segmentations of whole texts.

        Returns the best ids of all texts, the bounds of each text's, its ``n`` scores,
        and with ``paths`` the ids of every one of them.
        """
        units = [_UNIT.findall(f" {t}") if t else [] for t in texts]
        if len(self.number) > self.cache_units:
            self.forget()
        flat = list(chain.from_iterable(units))
        self.solve_all(set(flat))
        which = np.fromiter(map(self.number.__getitem__, flat), np.int64, len(flat))
        words = np.concatenate([[0], np.cumsum([len(u) for u in units])])
        total = np.bincount(np.repeat(np.arange(len(texts)), np.diff(words)), self.score[which], len(texts)).tolist()
        size = self.size[which]
        end = np.cumsum(size)
        ids = self.ids[np.repeat(self.place[which] - (end - size), size) + np.arange(end[-1] if len(end) else 0)]
        bounds = np.concatenate([[0], end])[words]
        scores, every = [[t] for t in total], []
        for row in range(len(texts) if n > 1 or paths else 0):
            a, b = words[row], words[row + 1]
            gap = self.gap[which[a:b]]
            close = np.argpartition(gap, n - 2)[: n - 1] if n > 1 and len(gap) > n - 1 else np.arange(len(gap) if n > 1 else 0)
            close = sorted(int(i) for i in close if gap[i] < np.inf)
            ways = [self._ways(units[row][i], n) for i in close]
            picks = _least_losses(ways, n)
            scores[row] = [total[row] - loss for loss, _ in picks]
            if paths:
                solved = [self.ids[self.place[k] : self.place[k] + self.size[k]].tolist() for k in which[a:b]]
                for _, pick in picks:
                    instead = {i: ways[j][pick[j]][1] for j, i in enumerate(close)}
                    every.append([x for i, s in enumerate(solved) for x in instead.get(i, s)])
        if paths:
            cut = np.concatenate([[0], np.cumsum([len(s) for s in scores])])
            every = [every[x:y] for x, y in zip(cut[:-1], cut[1:], strict=True)]
        return ids, bounds, scores, every

    def encode(self, text: str, n: int = 1) -> list[tuple[float, list[int]]]:
        """The ``n`` best segmentations of one text with their scores, best first."""
        _, _, scores, every = self.encode_all([text], n, paths=True)
        return list(zip(scores[0], every[0], strict=True))


def _least_losses(ways: list[list[tuple[float, tuple[int, ...]]]], n: int) -> list[tuple[float, tuple[int, ...]]]:
    """The ``n`` choices of one way for each unit that lose least in all, the first losing nothing."""
    start = (0,) * len(ways)
    heap, seen, picks = [(0.0, start)], {start}, []
    while heap and len(picks) < n:
        loss, pick = heapq.heappop(heap)
        picks.append((loss, pick))
        for j, way in enumerate(ways):
            if pick[j] + 1 < len(way):
                more = (*pick[:j], pick[j] + 1, *pick[j + 1 :])
                if more not in seen:
                    seen.add(more)
                    heapq.heappush(heap, (sum(w[0][0] - w[k][0] for w, k in zip(ways, more, strict=True)), more))
    return picks


def _slices(batch: pa.RecordBatch, column: int):
    """Cut a batch by rows and by bytes of a column."""
    at, each = 0, max(1, batch.column(column).nbytes // max(1, batch.num_rows))
    step = max(1, min(SLICE_ROWS, SLICE_BYTES // max(1, each)))
    while at < batch.num_rows:
        yield batch.slice(at, step)
        at += step


_WORKER: dict[int, Segmenter] = {}


def _segmenter(vocabulary: Vocabulary) -> Segmenter:
    """One segmenter, with its cache, for a worker process."""
    key = hash((len(vocabulary.pieces), vocabulary.pieces[-1], vocabulary.scores[-1], sum(vocabulary.scores)))
    if key not in _WORKER:
        _WORKER.clear()
        _WORKER[key] = Segmenter(vocabulary)
    return _WORKER[key]


def encode_pieces(docs: DataFrame, vocabulary: Vocabulary, nbest: int = 1, paths: bool = False, text: str = "text") -> DataFrame:
    """Append ``ids array<int>``, ``nbest_scores array<double>`` and, with ``paths``, ``nbest_ids``.

    ``ids`` is the best segmentation of the whole text, ``nbest_scores`` the scores of
    the best ``nbest`` ones (fewer if there aren't as many). A null or empty text has
    no ids and the one score 0. Characters without a piece become their bytes. Columns
    of those names are replaced, other ones stay; every row gives one row, repeated ones
    too. No shuffle; the vocabulary is broadcast. Time and memory grow with a text's
    length, blanks or none.
    """
    if nbest < 1:
        raise ValueError("nbest must be 1 or more")
    docs = docs.drop("ids", "nbest_scores", "nbest_ids")
    where = docs.columns.index(text)
    shared = docs.sparkSession.sparkContext.broadcast(vocabulary)
    new = [T.StructField("ids", T.ArrayType(T.IntegerType())), T.StructField("nbest_scores", T.ArrayType(T.DoubleType()))]
    new += [T.StructField("nbest_ids", T.ArrayType(T.ArrayType(T.IntegerType())))] if paths else []

    def run(batches):
        segmenter = _segmenter(shared.value)
        for batch in batches:
            for part in _slices(batch, where):
                ids, bounds, scores, every = segmenter.encode_all(part.column(where).to_pylist(), nbest, paths)
                arrays = [pa.ListArray.from_arrays(pa.array(bounds, pa.int32()), pa.array(ids, pa.int32())), pa.array(scores, pa.list_(pa.float64()))]
                if paths:
                    arrays.append(pa.array(every, pa.list_(pa.list_(pa.int32()))))
                yield pa.RecordBatch.from_arrays([*part.columns, *arrays], [*part.schema.names, *(f.name for f in new)])
        segmenter.forget()

    return docs.mapInArrow(run, T.StructType([*docs.schema.fields, *new]))


def decode_pieces(docs: DataFrame, vocabulary: Vocabulary, ids: str = "ids", to: str = "decoded") -> DataFrame:
    """Append the text of piece ids as ``to``; null ids give null."""
    docs = docs.drop(to)
    where = docs.columns.index(ids)
    shared = docs.sparkSession.sparkContext.broadcast(vocabulary)

    def run(batches):
        v = shared.value
        raw = [p.encode() if ok else b"" for p, ok in zip(v.pieces, v.normal, strict=True)]
        for b, i in enumerate(v.byte_ids):
            raw[i] = bytes([b])
        raw.append(b"")  # for ids outside the vocabulary
        blob, size = np.frombuffer(b"".join(raw), np.uint8), np.array([len(r) for r in raw])
        place = np.cumsum(size) - size
        for batch in batches:
            for part in _slices(batch, where):
                column = part.column(where)
                flat = column.flatten().fill_null(-1).to_numpy()
                flat = np.where((flat >= 0) & (flat < len(raw)), flat, len(raw) - 1)
                count = np.array([0 if n is None else n for n in pc.list_value_length(column).to_pylist()], np.int64)
                n = size[flat]
                end = np.cumsum(n)
                data = blob[np.repeat(place[flat] - (end - n), n) + np.arange(end[-1] if len(end) else 0)]
                cut = np.concatenate([[0], end])[np.concatenate([[0], np.cumsum(count)])]
                texts = [data[a:b].tobytes() for a, b in zip(cut[:-1], cut[1:], strict=True)]
                texts = [(t[1:] if t.startswith(b" ") else t).decode("utf-8", "replace") for t in texts]
                texts = pa.array(texts, pa.string())
                if column.null_count:
                    texts = pc.if_else(column.is_valid(), texts, pa.scalar(None, pa.string()))
                yield pa.RecordBatch.from_arrays([*part.columns, texts], [*part.schema.names, to])

    return docs.mapInArrow(run, T.StructType([*docs.schema.fields, T.StructField(to, T.StringType())]))
