"""Byte ranges of any files through Spark's own reader.

The text source cuts files into splits at line feeds and keeps all bytes, so a
split's bytes are its lines joined by line feeds, and where it starts is the sum of
the splits before it. Files in any store that Spark reads can so be searched by many
tasks without an index. Memory: one split (``spark.sql.files.maxPartitionBytes``)
and its last line.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F


def read_lines(spark: SparkSession, path: str) -> DataFrame:
    """``file_key, split, value binary``: lines in file order within each split."""
    lines = spark.read.option("lineSep", "\n").text(path)
    return lines.select(F.xxhash64("_metadata.file_path").alias("file_key"), F.col("_metadata.file_block_start").alias("split"), F.col("value").cast("binary").alias("value"))


def file_sizes(spark: SparkSession, path: str) -> DataFrame:
    """``file_key, path, size`` of each file that isn't empty."""
    lines = spark.read.option("lineSep", "\n").text(path)
    return lines.select(F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_size").alias("size")).distinct().select(F.xxhash64("path").alias("file_key"), "path", "size")


def splits_of(batches: Iterable[pa.RecordBatch]) -> Iterator[tuple[int, int, bytes]]:
    """Join the rows of :func:`read_lines` to ``file_key, split, bytes``, a split at a time."""
    key, parts = None, []
    for batch in batches:
        if not batch.num_rows:
            continue
        files, starts, lines = batch.column(0).to_numpy(), batch.column(1).to_numpy(), batch.column(2)
        changes = [0, *(((files[1:] != files[:-1]) | (starts[1:] != starts[:-1])).nonzero()[0] + 1).tolist(), batch.num_rows]
        for a, b in zip(changes[:-1], changes[1:], strict=True):
            now = (int(files[a]), int(starts[a]))
            if key is not None and now != key:
                yield *key, b"".join(parts)
                parts = []
            key = now
            parts += [b"\n".join(lines.slice(a, b - a).to_pylist()), b"\n"]
    if key is not None:
        yield *key, b"".join(parts)


def bases(summary: DataFrame) -> DataFrame:
    """Append ``base``, where each split of ``file_key, split, n_bytes`` starts: a prefix sum in its file."""
    before = Window.partitionBy("file_key").orderBy("split").rowsBetween(Window.unboundedPreceding, -1)
    return summary.withColumn("base", F.coalesce(F.sum("n_bytes").over(before), F.lit(0)))
