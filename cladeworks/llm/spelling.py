"""Grouping of spelling variants: words one edit apart, and the commoner form of each.

Two different words differ by one inserted, deleted or replaced code point just if their
common prefix and suffix together reach the longer length minus one. So one of both
covers half of that: words meet only with those of their prefix or suffix of that
length. A meeting's words are padded to matrices of code points, cut into blocks, and
block pairs are compared whole. A pair counts where its prefix reaches half, else in
the suffix's meeting. Of a block pair only sums and the best partner of each word are
handed on, never pairs.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .shared import materialize

BLOCK = 256
CELLS = 1 << 22  # of code points compared at a time
_MEETING = ["longer", "side", "half", "i", "j"]


def count_words(words: DataFrame, min_length: int = 5, min_count: int = 3) -> DataFrame:
    """``word, n`` of words with as many code points and occurrences; null words are left out."""
    words = words.filter(F.length("word") >= min_length)
    return words.groupBy("word").agg(F.count("*").alias("n")).filter(F.col("n") >= min_count)


def _meetings(counted: DataFrame) -> DataFrame:
    """Each word in the blocks in which it meets others: ``longer, side, half, i, j, role, word, n``."""
    size = F.length("word")
    rows = counted.withColumn("longer", F.explode(F.array(size, size + 1)))
    half = F.floor(F.col("longer") / 2).cast("int")  # ceil((longer - 1) / 2)
    keys = F.array(F.struct(F.lit(0).alias("side"), F.left("word", half).alias("half")), F.struct(F.lit(1).alias("side"), F.right("word", half).alias("half")))
    rows = rows.withColumn("key", F.explode(keys)).select("longer", "key.side", "key.half", "word", "n")
    key = _MEETING[:3]
    full = F.length("word") == F.col("longer")
    sizes = rows.groupBy(key).agg(F.count("*").alias("c"), F.count_if(full).alias("f")).filter("c > 1 AND f > 0")
    rows = rows.join(sizes.select(*key, F.ceil(F.col("c") / BLOCK).cast("int").alias("blocks")), key)
    rows = rows.withColumns({"own": F.pmod(F.xxhash64("word"), F.col("blocks")).cast("int")}).withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    role = F.when(F.col("own") <= F.col("other"), 0).otherwise(1)
    return rows.select(*key, F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"), role.alias("role"), "word", "n")


def _padded(words: list[str], width: int, fill: int, right: bool) -> np.ndarray:
    out = np.full((len(words), width), fill, np.int32)
    for k, w in enumerate(words):
        points = np.frombuffer(w.encode("utf-32-le"), np.int32)
        out[k, width - len(w) :] = points if right else out[k, width - len(w) :]
        if not right:
            out[k, : len(w)] = points
    return out


def _common(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Equal code points from the first column on, for each row of ``a`` and of ``b``; padding differs."""
    differ = a[:, :, None, :] != b[:, None, :, :]
    return np.where(differ.any(3), differ.argmax(3), a.shape[2])


def _near(a: list[str], b: list[str], shape: tuple[int, int, int], longer: int, side: int) -> np.ndarray:
    """Which words of the blocks ``a`` and ``b`` (flat, ``shape``: block pairs, words of each) are one edit apart."""
    pairs, n, m = shape
    forms = [(_padded(w, longer, fill, right).reshape(pairs, k, longer)) for right in (False, True) for w, k, fill in ((a, n, -1), (b, m, -2))]
    prefix = _common(forms[0], forms[1])
    suffix = _common(forms[2][:, :, ::-1], forms[3][:, :, ::-1])
    size = [np.array([len(x) for x in w], np.int32).reshape(pairs, k) for w, k in ((a, n), (b, m))]
    wide = np.maximum(size[0][:, :, None], size[1][:, None, :])
    near = (prefix + suffix >= longer - 1) & (wide == longer) & (np.minimum(size[0][:, :, None], size[1][:, None, :]) > 0)
    same = (size[0][:, :, None] == longer) & (size[1][:, None, :] == longer) & (prefix >= longer)
    reached = prefix >= longer // 2
    return near & ~same & (reached if side == 0 else ~reached)


def _compare(tiles: list[tuple[tuple, list, list]]) -> Iterator[pa.RecordBatch]:
    """Partial sums of block pairs ``key, rows of i, rows of j``, small ones of a kind many at a time."""
    kinds: dict[tuple, list] = {}
    for key, left, right in tiles:
        if not right and key[3] == key[4]:
            right = left
        if left and right:
            width = 1 << max(len(left), len(right), 2).bit_length() - 1
            width *= 1 if width >= max(len(left), len(right)) else 2
            kinds.setdefault((key[0], key[1], width), []).append((key[3] == key[4], left, right))
    words, counts, bests, forms = [], [], [], []
    for (longer, side, width), group in kinds.items():
        step = max(1, CELLS // (width * width * longer))
        for at in range(0, len(group), step):
            part = group[at : at + step]
            sides = [[r for t in part for r in t[k] + [("", 0)] * (width - len(t[k]))] for k in (1, 2)]
            names = [[r[0] for r in s] for s in sides]
            near = _near(*names, (len(part), width, width), longer, side)
            # In a block with itself each word looks at all others; of two blocks either side looks at the other.
            for k, axis in ((0, 2), (1, 1)):
                own, other = sides[k], sides[1 - k]
                number = near.sum(axis).reshape(-1)
                n = np.array([r[1] for r in other]).reshape(len(part), width)
                for w in np.flatnonzero(number):
                    pair, place = divmod(int(w), width)
                    if k and part[pair][0]:
                        continue
                    line = near[pair, place] if k == 0 else near[pair, :, place]
                    top = int(n[pair][line].max())
                    words.append(own[w][0])
                    counts.append(int(number[w]))
                    bests.append(top)
                    forms.append(min(other[pair * width + int(x)][0] for x in np.flatnonzero(line & (n[pair] == top))))
    yield pa.RecordBatch.from_arrays([pa.array(words, pa.string()), pa.array(counts, pa.int64()), pa.array(bests, pa.int64()), pa.array(forms, pa.string())], ["word", "n_near", "best", "form"])


def near_words(counted: DataFrame) -> DataFrame:
    """Of each word that has any: ``word, n_near, best, form``, its near words' number, the largest n and whose it is.

    ``counted``: ``word, n`` with distinct words. Ties go to the smallest word in
    code-point order.
    """
    rows = _meetings(counted).repartition(*_MEETING).sortWithinPartitions(*_MEETING, "role")

    def run(batches):
        tiles, now, left, right, held = [], None, [], [], 0
        for batch in batches:
            for *key, role, word, n in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if (key := tuple(key)) != now:
                    tiles.append((now, left, right))
                    held += len(left) + len(right)
                    now, left, right = key, [], []
                    if held > 1 << 14:
                        yield from _compare(tiles[1 if tiles[0][0] is None else 0 :])
                        tiles, held = [], 0
                (right if role else left).append((word, n))
        tiles.append((now, left, right))
        yield from _compare([t for t in tiles if t[0] is not None])

    partial = rows.mapInArrow(run, "word string, n_near long, best long, form string")
    least = F.min(F.struct(-F.col("best"), "form"))
    return partial.groupBy("word").agg(F.sum("n_near").alias("n_near"), least.alias("least")).select("word", "n_near", F.col("least.form").alias("form"))


def spelling_forms(counted: DataFrame) -> DataFrame:
    """Near words, form and root of each word of ``counted(word, n)``.

    Two words are near if they differ by exactly one inserted, deleted or replaced code
    point. ``form`` is the near word of largest n (ties: the smallest), if that is at
    least twice the word's own, else null; ``root`` the last word reached by forms, the
    word itself if it has none. Returns ``word, form, root, n, n_near, form_n``. Null
    words take no part, rows of one word are added up, other columns are ignored; an
    empty table gives none.
    """
    counted = materialize(counted.filter("word IS NOT NULL").groupBy("word").agg(F.sum("n").cast("long").alias("n")))
    found = near_words(counted).join(counted.select(F.col("word").alias("form"), F.col("n").alias("form_n")), "form")
    joined = counted.join(found, "word", "left")
    taken = F.col("form_n") >= 2 * F.col("n")
    forms = joined.select("word", "n", F.coalesce("n_near", F.lit(0)).alias("n_near"), F.when(taken, F.col("form")).alias("form"), F.when(taken, F.col("form_n")).alias("form_n"))
    forms = materialize(forms)
    # n at least doubles with each form, so the ways are short; they double each round.
    way = forms.filter("form IS NOT NULL").select("word", F.col("form").alias("root"))
    while True:
        onward = way.select(F.col("word").alias("root"), F.col("root").alias("next"))
        way = materialize(way.join(onward, "root", "left").select("word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved")))
        moved = not way.filter("moved").isEmpty()
        way = way.drop("moved")
        if not moved:
            break
    return forms.join(way, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
