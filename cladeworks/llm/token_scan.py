"""Token counts of documents from flat, unindexed token files.

A file is nothing but big-endian 16-bit token ids, each document ended by an
end-of-document id. The scan searches splits for that id with numpy, at both byte
alignments since a split may start inside a token, and a prefix scan over the
splits' sizes, last boundaries and counts stitches what they found.
"""

from __future__ import annotations

import base64

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Observation, SparkSession, Window
from pyspark.sql import functions as F

from .shared import materialize, shared_dir
from .splits import bases, file_sizes, read_lines, splits_of

#: Free in a vocabulary of 50,256; its two bytes are one UTF-8 character, as Spark's text writer needs for what it puts after each row.
END_OF_DOCUMENT = 0xC480
#: Fixed value: the pattern by which byte-level BPE of this family cuts words.
WORD_PATTERN = r"'(?:[sdmt]|ll|ve|re)| ?\p{L}++| ?\p{N}++| ?[^\s\p{L}\p{N}]++|\s++$|\s+(?!\S)|\s"
_ENCODERS: dict = {}


def _encoder(ranks_text: bytes):
    """The tokenizer of a ranks file, built once in a worker."""
    key = hash(ranks_text)
    if key not in _ENCODERS:
        import tiktoken

        ranks = {base64.b64decode(a): int(b) for a, b in (line.split() for line in ranks_text.splitlines() if line)}
        _ENCODERS[key] = tiktoken.Encoding("ranks", pat_str=WORD_PATTERN, mergeable_ranks=ranks, special_tokens={})
    return _ENCODERS[key]


def _dealt(docs: DataFrame) -> DataFrame:
    """Append ``place`` (task and place in it) and ``sign``, a hash of it and doc_id."""
    rows = docs.withColumn("place", F.monotonically_increasing_id())
    return rows.withColumn("sign", F.xxhash64(F.coalesce(F.col("doc_id").cast("string"), F.lit("none")), "place"))


def _signs() -> list[Column]:
    return [F.count(F.lit(1)).alias("n"), F.bit_xor("sign").alias("sign")]


def write_token_files(docs: DataFrame, path: str, ranks_file: str, end: int = END_OF_DOCUMENT) -> dict:
    """Encode whole ``text`` values of ``docs(doc_id, text)`` and write them as flat token files, one for each task.

    The vocabulary (``ranks_file``: base64 token and rank a line, read on the driver,
    under 65,536 entries) is broadcast. Null and empty texts are documents of no
    tokens. ``end`` must be unused and its two bytes one UTF-8 character. Returns the
    number of rows and a sign of how they were dealt out to tasks, which
    :func:`count_tokens` holds against its own.
    """
    with open(ranks_file, "rb") as f:
        ranks_text = f.read()
    if not 0xC280 <= end <= 0xDFBF or end & 0xC0 != 0x80:
        raise ValueError(f"the bytes of end-of-document id {end} are no UTF-8 character")
    if (top := max(int(line.split()[1]) for line in ranks_text.splitlines() if line)) >= 1 << 16 or top >= end:
        raise ValueError(f"token ids up to {top} do not fit 16 bits below {end}")
    shared = docs.sparkSession.sparkContext.broadcast(ranks_text)

    def run(batches):
        encode = _encoder(shared.value).encode_ordinary
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                rows = [np.array(encode(t), ">u2").tobytes() if t else b"" for t in batch.column(0).slice(at, 256).to_pylist()]
                yield pa.RecordBatch.from_arrays([pa.array(rows, pa.binary())], ["value"])

    seen = Observation()
    rows = _dealt(docs.select("doc_id", F.col("text").cast("string").alias("text"))).observe(seen, *_signs())
    rows = rows.select("text").mapInArrow(run, "value binary")
    rows.select(F.col("value").cast("string")).write.option("lineSep", end.to_bytes(2, "big").decode()).option("maxRecordsPerFile", 0).text(path)
    return seen.get


def scan_token_files(spark: SparkSession, path: str, end: int = END_OF_DOCUMENT) -> DataFrame:
    """Documents of the flat token files below ``path``: ``path, ordinal, start, n_tokens, ended``.

    ``ordinal`` counts a file's documents from 0, ``start`` is a byte offset. Tokens
    after the last end-of-document id are a document that isn't ``ended``; a last odd
    byte is left out. Windows run over splits only, never over documents.
    """
    high, low = end.to_bytes(2, "big")

    def run(batches):
        for key, split, data in splits_of(batches):
            raw = np.frombuffer(data, np.uint8)
            at = np.flatnonzero((raw[:-1] == high) & (raw[1:] == low))
            out = {"kind": [0], "at": [len(raw)], "prev": [None], "k": [None], "odd": [int(raw[0]) << 8 | int(raw[-1])]}
            for odd in (0, 1):
                found = at[at % 2 == odd]
                out["kind"] += [1] * len(found)
                out["at"] += found.tolist()
                out["prev"] += [None, *found[:-1].tolist()][: len(found)]
                out["k"] += range(len(found))
                out["odd"] += [odd] * len(found)
            n = len(out["kind"])
            yield pa.RecordBatch.from_arrays(
                [pa.array([key] * n, pa.int64()), pa.array([split] * n, pa.int64()), *(pa.array(c, pa.int64()) for c in out.values())], ["file_key", "split", *out]
            )

    scan = materialize(read_lines(spark, path).mapInArrow(run, "file_key long, split long, kind long, at long, prev long, k long, odd long"))
    files = file_sizes(spark, path)
    # A split's size, first and last byte; where it starts; a boundary that its last and the next one's first byte form.
    by_split = Window.partitionBy("file_key").orderBy("split")
    sizes = bases(scan.filter("kind = 0").select("file_key", "split", F.col("at").alias("n_bytes"), F.shiftright("odd", 8).alias("first"), F.col("odd").bitwiseAND(255).alias("last")))
    sizes = sizes.withColumn("seam", ((F.col("base") + F.col("n_bytes")) % 2 == 1) & (F.col("last") == high) & (F.lead("first").over(by_split) == low))
    found = scan.filter("kind = 1").join(sizes.select("file_key", "split", "base"), ["file_key", "split"]).filter("odd = base % 2")
    ends = found.select("file_key", "split", (F.col("at") + F.col("base")).alias("at"), (F.col("prev") + F.col("base")).alias("prev"), "k")
    per_split = ends.groupBy("file_key", "split").agg(F.count("*").alias("n"), F.max("at").alias("top"))
    state = sizes.join(per_split, ["file_key", "split"], "left").withColumn("seam_at", F.when(F.col("seam"), F.col("base") + F.col("n_bytes") - 1))
    upto = by_split.rowsBetween(Window.unboundedPreceding, -1)
    state = state.withColumns({
        "before_n": F.coalesce(F.sum(F.coalesce("n", F.lit(0)) + F.coalesce("seam", F.lit(False)).cast("int")).over(upto), F.lit(0)),
        "before_at": F.max(F.greatest("top", "seam_at")).over(upto),
    })
    state = materialize(state.select("file_key", "split", "base", "n_bytes", F.coalesce("n", F.lit(0)).alias("n"), "top", "seam_at", "before_n", "before_at"))
    inner = ends.join(state.select("file_key", "split", "before_n", "before_at"), ["file_key", "split"])
    inner = inner.select("file_key", (F.col("before_n") + F.col("k")).alias("ordinal"), F.coalesce("prev", "before_at").alias("prev"), "at")
    seams = state.filter("seam_at IS NOT NULL").select("file_key", (F.col("before_n") + F.col("n")).alias("ordinal"), F.greatest("top", "before_at").alias("prev"), F.col("seam_at").alias("at"))
    docs = inner.union(seams).withColumn("ended", F.lit(True))
    rest = state.groupBy("file_key").agg(F.sum(F.col("n") + F.col("seam_at").isNotNull().cast("int")).alias("ordinal"), F.max(F.greatest("top", "seam_at")).alias("prev"))
    rest = rest.join(files, "file_key").select("file_key", "ordinal", "prev", (F.col("size") - F.col("size") % 2).alias("at"), F.lit(False).alias("ended"))
    start = F.coalesce(F.col("prev") + 2, F.lit(0))
    docs = docs.union(rest.filter(F.col("at") > start)).withColumn("start", start).join(files.select("file_key", "path"), "file_key")
    return docs.select("path", "ordinal", "start", ((F.col("at") - F.col("start")) / 2).cast("long").alias("n_tokens"), "ended")


def count_tokens(docs: DataFrame, path: str, ranks_file: str, end: int = END_OF_DOCUMENT) -> DataFrame:
    """Tokens of each row's whole text: ``doc_id, n_tokens``.

    Writes ``docs(doc_id, text)`` as token files to ``path`` and counts by scanning
    them. Rows are matched by task and place in it. Where a second scan of ``docs`` is
    dealt out in another way than the one that was written (what comes out of a shuffle
    may be), ids and texts are written as a table first and read twice. Other columns
    are ignored; null ids and repeated rows keep their rows; an empty table gives none.
    """
    written = write_token_files(docs, path, ranks_file, end)
    rows = materialize(_dealt(docs.select("doc_id")))
    again = rows.agg(*_signs()).first()
    if (again.n, again.sign) != (written["n"], written["sign"]):
        path = shared_dir(docs.sparkSession)
        docs = materialize(docs.select("doc_id", F.col("text").cast("string").alias("text")))
        written = write_token_files(docs, path, ranks_file, end)
        rows = materialize(_dealt(docs.select("doc_id")))
        again = rows.agg(*_signs()).first()
    part = F.regexp_extract("path", r"part-(\d+)-[^/]*$", 1).cast("long")
    found = materialize(scan_token_files(docs.sparkSession, path, end).filter("ended").select(part.alias("part"), "ordinal", "n_tokens"))
    if (again.n, again.sign) != (written["n"], written["sign"]) or found.count() != again.n:
        raise RuntimeError("the rows were dealt out to tasks in two ways, or files were lost")
    rows = rows.select("doc_id", F.shiftright("place", 33).alias("part"), F.col("place").bitwiseAND((1 << 33) - 1).alias("ordinal"))
    return rows.join(found, ["part", "ordinal"], "left").select("doc_id", "n_tokens")
