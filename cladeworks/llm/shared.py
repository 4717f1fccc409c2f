"""Tables in the folder that driver and executors share."""

from __future__ import annotations

import tempfile
import uuid

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

FILTER_BITS = 24


def shared_dir(spark: SparkSession) -> str:
    """A new folder name below ``spark.checkpoint.dir``.

    Where a local session names no such folder (tests) a temporary one is set once; on a
    cluster that is an error, as executors wouldn't see it.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        base = spark.sparkContext._jsc.sc().getCheckpointDir()
        base = base.get() if base.isDefined() else None
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
        base = tempfile.mkdtemp(prefix="spark-")
        spark.sparkContext.setCheckpointDir(base)
    return f"{base.rstrip('/')}/{uuid.uuid4().hex}"


def materialize(df: DataFrame) -> DataFrame:
    """Write ``df`` as Parquet to the shared folder and read it back.

    Cuts the lineage like ``checkpoint()`` but keeps the rows columnar and
    compressed; a lost executor costs a reread, not a recomputation.
    """
    path = shared_dir(df.sparkSession)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def hash_filter(rows: DataFrame) -> np.ndarray:
    """2 MB of bits that say which 64-bit hashes (column ``h``) may be there; more of them only let more pass."""

    def run(batches):
        bits = np.zeros(1 << FILTER_BITS, bool)
        for batch in batches:
            bits[(batch.column(0).to_numpy().view(np.uint64) >> np.uint64(64 - FILTER_BITS)).astype(np.int64)] = True
        packed = np.packbits(bits, bitorder="little")
        cells = np.flatnonzero(packed)
        if len(cells):
            yield pa.RecordBatch.from_arrays([pa.array(cells.astype(np.int32)), pa.array(packed[cells].astype(np.int32))], ["cell", "bits"])

    got = rows.select("h").mapInArrow(run, "cell int, bits int").groupBy("cell").agg(F.bit_or("bits").cast("short").alias("bits")).toPandas()
    out = np.zeros((1 << FILTER_BITS) // 8, np.uint8)
    out[got["cell"].to_numpy(np.int64)] = got["bits"].to_numpy(np.uint8)
    return out


def may_hold(bits: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    """Whether each hash may be among those of a :func:`hash_filter`."""
    cell = (hashes.view(np.uint64) >> np.uint64(64 - FILTER_BITS)).astype(np.int64)
    return (bits[cell >> 3] >> (cell & 7).astype(np.uint8)) & 1 == 1
