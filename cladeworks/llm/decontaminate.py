"""Benchmark decontamination by template windows.

Words become canonical: numbers, names and units turn into typed placeholders, all
else is lower-cased; names of several words and number words in a row are one
placeholder. Windows of canonical words are hashed and hash-joined between
documents and benchmark items, beside windows of plain lower-cased words. Where
placeholders stand for other values than in the item, the values must be consistent:
within an alignment one item value always stands for one document value, and of names
one document value for one item value too (numbers may be alike by chance). So a
question with other numbers or names is caught, and text that has only the shape of
one is not.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .flat import SLICE_BYTES, Words, mix, string_buffers
from .shared import hash_filter, materialize, may_hold

# Unit and number words that become placeholders.
UNITS = (
    "mm cm m km in inch inches ft foot feet yd yard yards mile miles mg g kg gram grams kilogram kilograms lb lbs oz pound pounds ton tons "
    "ml l liter liters litre litres gallon gallons cup cups s sec second seconds min minute minutes h hour hours day days week weeks month months year years "
    "mph kmh usd eur dollar dollars euro euros cent cents percent degrees celsius fahrenheit watt watts volt volts joule joules meter meters metre metres kilometer kilometers"
).split()
NUMBER_WORDS = "zero one two three four five six seven eight nine ten eleven twelve thirteen fourteen fifteen sixteen seventeen eighteen nineteen twenty thirty forty fifty sixty seventy eighty ninety hundred thousand million billion".split()

PLAIN, NUMBER, NAME, UNIT = 0, 1, 2, 3


@dataclass
class Reading:
    """One way to take the words of a slice: texts' bounds, and of each token its hash, its kind, and what it is hashed as."""

    bounds: np.ndarray
    values: np.ndarray  # hash of the lower-cased word, or words
    kinds: np.ndarray
    canonical: np.ndarray  # the same hash, or that of the placeholder, by kind


@dataclass
class Tokens:
    """Words of a slice of a string column."""

    first: int
    n_docs: int
    #: Plain words; canonical ones with doubtful names (at the start of a sentence, in capitals) as plain words, and as names.
    readings: tuple[Reading, Reading, Reading]


def _word_set(words) -> np.ndarray:
    raw = np.frombuffer(" ".join(words).encode(), np.uint8)
    inside = raw != 32
    starts = np.flatnonzero(inside & ~np.concatenate([[False], inside[:-1]]))
    ends = np.flatnonzero(inside & ~np.concatenate([inside[1:], [False]])) + 1
    return np.unique(Words(0, 1, raw, starts, ends, np.array([0, len(starts)])).hashes())


def _joined(hashes: np.ndarray, follows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First words of runs, whose other words are marked by ``follows``, and a hash of each run."""
    keep = np.flatnonzero(~follows)
    place = np.arange(len(hashes)) - keep[np.cumsum(~follows) - 1] if len(keep) else keep
    parts = np.where(follows, mix(hashes + place.astype(np.uint64)), hashes)
    return keep, np.add.reduceat(parts, keep) if len(keep) else parts


def canonical_slices(column: pa.Array, limit: int = SLICE_BYTES):
    """Cut a string column into slices and its texts into canonical words.

    Words are runs of letters, digits and bytes from 0x80 on, so punctuation between
    them doesn't matter. A number is a word of digits (digits joined by one ``.`` or
    ``,`` count as one word; letters right behind digits are a word of their own) or a
    number word; a unit is a unit word after a number; a name is a word with a capital
    and a small letter in front. Where such a word starts a sentence it may be either,
    as may a word in capitals, so there are two readings. Names in a row with a blank,
    a hyphen or an apostrophe between them are one name; so is a number with number
    words behind it one number.
    """
    units, numbers = _word_set(UNITS), _word_set(NUMBER_WORDS)
    placeholder = mix(np.arange(4, dtype=np.uint64) + np.uint64(0xF00D))
    data, offsets = string_buffers(column)
    n, at = len(offsets) - 1, 0
    while at < n:
        end = min(n, max(at + 1, int(np.searchsorted(offsets, offsets[at] + limit, "right")) - 1))
        raw, cut = data[offsets[at] : offsets[end]], offsets[at : end + 1] - offsets[at]
        digit = (raw >= 48) & (raw <= 57)
        upper = (raw >= 65) & (raw <= 90)
        small = (raw >= 97) & (raw <= 122)
        inside = digit | upper | small | (raw >= 128)
        before, after = np.zeros(len(raw), bool), np.zeros(len(raw), bool)
        before[1:], after[:-1] = inside[:-1], inside[1:]
        edges = cut[1:-1]
        before[edges[edges < len(raw)]] = False
        after[edges[edges > 0] - 1] = False
        starts, ends = np.flatnonzero(inside & ~before), np.flatnonzero(inside & ~after) + 1
        other = np.append(np.flatnonzero(~digit), len(raw))
        turn = other[np.searchsorted(other, starts)]  # where the digits in front of a word end
        turn = turn[(turn > starts) & (turn < ends)]
        starts, ends = np.sort(np.concatenate([starts, turn])), np.sort(np.concatenate([ends, turn]))
        bounds = np.searchsorted(starts, cut)
        plain = Words(at, end - at, raw, starts, ends, bounds).hashes() if len(raw) else np.zeros(0, np.uint64)
        digits = np.concatenate([[0], np.cumsum(digit)])
        number = digits[ends] - digits[starts] == ends - starts
        head = np.zeros(len(starts), bool)
        head[bounds[:-1][np.diff(bounds) > 0]] = True
        gap_one = ~head
        gap_one[1:] &= starts[1:] - ends[:-1] == 1
        joined = gap_one & number
        if len(starts):
            joined[0] = False
            joined[1:] &= number[:-1] & np.isin(raw[np.minimum(ends[:-1], len(raw) - 1)], (44, 46))
        if joined.any():  # 3.14 and 1,000 are one word
            keep, plain = _joined(plain, joined)
            bounds = np.searchsorted(keep, bounds)
            tail = np.append(keep[1:], len(starts)) - 1
            starts, ends, number, head = starts[keep], ends[tail], number[keep], head[keep]
        spelled = np.isin(plain, numbers)
        number = number | spelled
        close = ~head  # one blank, hyphen or apostrophe behind the word before
        if len(starts):
            close[0] = False
            close[1:] &= (starts[1:] - ends[:-1] == 1) & np.isin(raw[np.minimum(ends[:-1], len(raw) - 1)], (32, 39, 45))
        stop = np.concatenate([[0], np.cumsum((raw == 46) | (raw == 33) | (raw == 63) | (raw == 10) | (raw == 58))])
        opens = head.copy()
        if len(starts):
            opens[1:] |= stop[starts[1:]] > stop[ends[:-1]]
        first = raw[starts] if len(starts) else np.zeros(0, np.uint8)
        second = raw[np.minimum(starts + 1, max(len(raw) - 1, 0))] if len(starts) else first
        capital = ((first >= 65) & (first <= 90) & ((second >= 97) & (second <= 122) | (second >= 128))) | ((first == 0xC3) & (second >= 0x80) & (second <= 0x9E))
        shouted = (first >= 65) & (first <= 90) & (second >= 65) & (second <= 90) & (ends - starts > 1)
        capital &= ends - starts > 1
        readings = [Reading(bounds, plain, np.zeros(len(plain), np.int8), plain)]
        for names in (capital & ~opens, capital | shouted):
            kind = np.where(number, NUMBER, np.where(names, NAME, PLAIN)).astype(np.int8)
            follows = np.zeros(len(starts), bool)
            if len(starts):
                unit = np.isin(plain, units) & ~head
                unit[1:] &= number[:-1]
                unit[0] = False
                kind[unit] = UNIT
                follows[1:] = close[1:] & (kind[1:] == kind[:-1]) & ((kind[1:] == NAME) | (kind[1:] == NUMBER) & spelled[1:])
            keep, value = _joined(plain, follows)
            kind = kind[keep]
            readings.append(Reading(np.searchsorted(keep, bounds), value, kind, np.where(kind > 0, placeholder[kind], value)))
        yield Tokens(at, end - at, tuple(readings))
        at = end


def _windows(r: Reading, size: int, template: bool):
    """Start, text, hash and number of slots of each window.

    Windows of a template with fewer than two plain words are hashed by their values.
    """
    sizes = np.diff(r.bounds)
    count = np.maximum(sizes - size + 1, 0)
    ends = np.cumsum(count)
    start = np.arange(ends[-1] if len(ends) else 0) - np.repeat(ends - count - r.bounds[:-1], count)

    def hashed(words: np.ndarray, at: np.ndarray) -> np.ndarray:
        h = np.full(len(at), size + 100 * template, np.uint64)
        for j in range(size):
            h = h * np.uint64(0x2545F4914F6CDD1D) + words[at + j]
        return mix(h)

    h = hashed(r.canonical, start)
    slots = np.concatenate([[0], np.cumsum(r.kinds > 0)])
    held = slots[start + size] - slots[start]
    bare = np.flatnonzero(held > size - 2)
    h[bare], held[bare] = hashed(r.values, start[bare]), 0
    return start, np.repeat(np.arange(len(sizes)), count), h, held


def _window_rows(texts: DataFrame, id_name: str, sizes: list[int], shortest: int, bloom=None) -> DataFrame:
    """``h, reading, heavy, id, pos, slots`` of each window; with ``bloom`` only those it may hold.

    Without ``bloom``, as for items, a text has the windows of the largest size that
    it can fill. Reading 0 is of plain words; windows of the others need ``shortest``
    tokens; ``heavy`` ones are slots for the more part. A slot is the hash of its words,
    with 1 in the last bit for names. ``pos`` counts tokens of the reading.
    """

    def run(batches):
        bits = bloom.value if bloom is not None else None
        for batch in batches:
            ids = batch.column(0).to_numpy(zero_copy_only=False)
            for t in canonical_slices(batch.column(1)):
                out = ([], [], [], [], [])
                slots = []
                for size in sizes:
                    for k, r in enumerate(t.readings):
                        if k and size < shortest:
                            continue
                        start, doc, h, held = _windows(r, size, k > 0)
                        pick = np.ones(len(h), bool) if bits is None else may_hold(bits, h)
                        if bits is None and size < sizes[-1]:
                            pick &= np.diff(r.bounds)[doc] == size
                        at = np.flatnonzero(pick)
                        out[0].append(h[at].view(np.int64))
                        out[1].append(np.full(len(at), k))
                        out[2].append(2 * held[at] > size)
                        out[3].append(ids[t.first + doc[at]])
                        out[4].append(start[at] - r.bounds[doc[at]])
                        value = (r.values & ~np.uint64(1)) | (r.kinds == NAME).astype(np.uint64)
                        slots += [value[s : s + size][r.kinds[s : s + size] > 0].view(np.int64).tolist() if n else [] for s, n in zip(start[at], held[at], strict=True)]
                h, reading, heavy, who, pos = (np.concatenate(x) if x else np.zeros(0) for x in out)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(h, pa.int64()), pa.array(reading.astype(np.int32)), pa.array(heavy, pa.bool_()), pa.array(who.astype(np.int64)), pa.array(pos.astype(np.int32)), pa.array(slots, pa.list_(pa.int64()))],
                    ["h", "reading", "heavy", "id", "pos", "slots"],
                )

    rows = texts.filter(F.col(id_name).isNotNull() & F.col("text").isNotNull()).select(F.col(id_name).cast("long").alias("id"), "text")
    return rows.mapInArrow(run, "h long, reading int, heavy boolean, id long, pos int, slots array<long>").withColumn("templ", F.col("reading") > 0)


def _item_sizes(benchmark: DataFrame, window: int) -> list[int]:
    """The window sizes in use: ``window``, and the lengths of items that are shorter."""

    def run(batches):
        for batch in batches:
            for t in canonical_slices(batch.column(0)):
                n = np.unique(np.concatenate([np.diff(r.bounds) for r in t.readings]))
                yield pa.RecordBatch.from_arrays([pa.array(n.astype(np.int32))], ["n"])

    lengths = benchmark.filter("text IS NOT NULL").select("text").mapInArrow(run, "n int").filter(f"n >= 1 AND n < {window}").distinct()
    return sorted({window, *(r.n for r in lengths.collect())})


def contaminated_pairs(docs: DataFrame, benchmark: DataFrame, window: int = 8, coverage: float = 0.5, shortest: int = 4) -> DataFrame:
    """Documents that hold a benchmark item, and which: ``doc_id, item_id, coverage, n_windows, reparameterised``.

    ``docs``: ``doc_id, text``; ``benchmark``: ``item_id, text``; other columns are
    ignored. A pair is returned when at least ``coverage`` of the item's windows of
    ``window`` words (one window for an item of fewer words) are found in the document:
    of its plain words, or in one of its readings as a template, in alignments whose
    slots are consistent. Templates that are slots for the more part count only in an
    alignment that has all of the reading's windows. Items of fewer than ``shortest``
    words are matched word for word only. ``coverage`` is the best share found,
    ``n_windows`` the number of windows of plain words; ``reparameterised`` says that
    templates were needed. Null ids, null texts and texts without words hold nothing;
    repeated rows count once; an empty table on either side gives no rows.

    Whole documents are scanned, and only windows that pass a 2 MB filter leave the scan.
    A pair must share one of the item's rarest windows, as many as can be missed and one
    more; only pairs that do meet by the others, so that windows which many items and
    many documents share (instructions, answer letters) make no product of the two.
    """
    if window < 2 or not 0 < coverage <= 1:
        raise ValueError("window must be 2 or more and coverage in (0, 1]")
    spark = docs.sparkSession
    sizes = _item_sizes(benchmark, window)
    items = materialize(_window_rows(benchmark, "item_id", sizes, shortest).distinct())
    bloom = spark.sparkContext.broadcast(hash_filter(items))
    n = materialize(items.groupBy(F.col("id").alias("item_id"), "reading").agg(F.countDistinct("pos").alias("n_windows")))
    hits = materialize(_window_rows(docs, "doc_id", sizes, shortest, bloom).withColumnRenamed("id", "doc_id"))
    near = materialize(_may_pair(hits, items, n, coverage))
    theirs = near.join(items.withColumnsRenamed({"id": "item_id", "pos": "at", "slots": "theirs", "reading": "of"}).drop("heavy"), "item_id")
    both = theirs.join(hits, ["doc_id", "h", "templ"]).select(
        "doc_id", "item_id", "of", "reading", "templ", "heavy", F.col("at").alias("pos"), (F.col("pos") - F.col("at")).alias("shift"), F.arrays_zip("theirs", F.col("slots").alias("ours")).alias("slots")
    )
    both = materialize(both)
    at = ["doc_id", "item_id", "of", "reading", "shift"]
    slots = both.filter("templ").select(*at, F.explode("slots").alias("s")).select(*at, "s.theirs", "s.ours").distinct()
    clash = slots.groupBy(*at, "theirs").agg(F.count("*").alias("c")).filter("c > 1").select(*at)
    clash = clash.union(slots.filter("ours & 1 = 1").groupBy(*at, "ours").agg(F.count("*").alias("c")).filter("c > 1").select(*at)).distinct()
    every = both.filter("NOT templ").union(both.filter("templ").join(clash, at, "left_anti").select(both.columns)).select(*at, "pos", "heavy")
    n_of = n.withColumnRenamed("reading", "of")
    full = every.groupBy(*at).agg(F.countDistinct("pos").alias("n"), F.bool_or("heavy").alias("heavy")).filter("heavy").join(n_of, ["item_id", "of"]).filter("n = n_windows")
    found = every.filter("NOT heavy").union(every.filter("heavy").join(full.select(*at), at, "left_semi").select(every.columns))
    found = found.groupBy("doc_id", "item_id", "of").agg(F.countDistinct("pos").alias("found")).join(n_of, ["item_id", "of"])
    found = found.filter(F.col("found") >= coverage * F.col("n_windows"))
    best = found.groupBy("doc_id", "item_id").agg(F.max(F.col("found") / F.col("n_windows")).alias("coverage"), (~F.bool_or(F.col("of") == 0)).alias("reparameterised"))
    whole = n.filter("reading = 0").select("item_id", F.col("n_windows").cast("long").alias("n_windows"))
    return best.join(whole, "item_id").select("doc_id", "item_id", "coverage", "n_windows", "reparameterised")


def _may_pair(hits: DataFrame, items: DataFrame, n: DataFrame, coverage: float) -> DataFrame:
    """Documents and items that share one of the item's rarest windows: ``doc_id, item_id``.

    Of a reading's ``n`` windows ``n - ceil(coverage * n)`` can be missed; so a pair to be
    found shares one of any that are one more. Rare means in few items.
    """
    common = items.groupBy("h", "templ").agg(F.countDistinct("id").alias("n_items"))
    places = items.join(common, ["h", "templ"]).groupBy(F.col("id").alias("item_id"), "reading", "pos").agg(F.max("n_items").alias("n_items"))
    rank = F.row_number().over(Window.partitionBy("item_id", "reading").orderBy("n_items", "pos"))
    places = places.withColumn("rank", rank).join(n, ["item_id", "reading"]).filter(F.col("rank") <= F.col("n_windows") - F.ceil(coverage * F.col("n_windows")) + 1)
    rare = items.withColumnRenamed("id", "item_id").join(places.select("item_id", "reading", "pos"), ["item_id", "reading", "pos"], "left_semi")
    return hits.select("doc_id", "h", "templ").distinct().join(rare.select("item_id", "h", "templ").distinct(), ["h", "templ"]).select("doc_id", "item_id").distinct()


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, **options) -> DataFrame:
    """Rows of ``docs``, with all columns, that hold no benchmark item; those with a null doc_id stay, repeated rows go or stay together."""
    return docs.join(contaminated_pairs(docs, benchmark, **options).select("doc_id").distinct(), "doc_id", "left_anti").select(docs.columns)
