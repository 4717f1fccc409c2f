"""Left alignment of indels over any distance (E5; after Tan, Abecasis & Kang 2015).

An indel that adds or takes away ``length`` bases can move left as long as the base
before it equals the one ``length`` further on. So it stops right behind the last place
at which the reference differs from itself shifted by ``length``. That place is looked
up chunk by chunk to the left, twice as many chunks each round, for all indels together;
one look at a chunk serves all indels of one length that need it.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.alleles import simplest
from ..functions.columns import KEY
from ..functions.staging import staged


def _chunks(reference: DataFrame) -> DataFrame:
    """The reference as a side of joins that is never broadcast: Spark takes one that is exploded or well compressed for small."""
    return reference.select("chrom", F.col("chunk_index").cast("long").alias("chunk_index"), "sequence").hint("merge")


def _with_reference(rows: DataFrame, reference: DataFrame, text: str, first: str, chunk: int) -> DataFrame:
    """``rows`` once for each chunk that a text touches, with the text's ``piece`` there and what the reference has (``found``)."""
    low, high = F.floor((F.col(first) - 1) / chunk), F.floor((F.col(first) + F.length(text) - 2) / chunk)
    cut = rows.withColumn("chunk_index", F.explode(F.sequence(low, high))).withColumn("begin", F.col("chunk_index") * chunk + 1)
    cut = cut.withColumn("a", F.greatest(first, "begin")).withColumn("b", F.least(F.col(first) + F.length(text), F.col("begin") + chunk))
    cut = cut.withColumn("piece", F.substring(F.col(text), (F.col("a") - F.col(first) + 1).cast("int"), (F.col("b") - F.col("a")).cast("int")))
    joined = cut.join(_chunks(reference), ["chrom", "chunk_index"], "left")
    found = F.substring(F.col("sequence"), (F.col("a") - F.col("begin") + 1).cast("int"), (F.col("b") - F.col("a")).cast("int"))
    return joined.withColumn("found", F.coalesce(found, F.lit(""))).drop("sequence")


def _last(a: pd.Series, b: pd.Series) -> pd.Series:
    """Place (from 1) of the last base of ``a`` that isn't that of ``b`` (shorter: a difference); 0 if there is none."""
    out = np.zeros(len(a), np.int64)
    for i, (x, y) in enumerate(zip(a, b, strict=True)):
        u, v = (np.frombuffer(s.upper().encode("latin-1", "replace"), np.uint8) for s in (x, y))
        n = min(len(u), len(v))
        apart = np.flatnonzero(u[:n] != v[:n])
        out[i] = len(u) if len(u) > n else apart[-1] + 1 if len(apart) else 0
    return pd.Series(out)


def _last_difference(a: Column | str, b: Column | str) -> Column:
    return F.pandas_udf(_last, "long")(a, b)


def _stops(moving: DataFrame, reference: DataFrame, chunk: int) -> DataFrame:
    """For each ``id, chrom, length, upto`` the last place up to ``upto`` where the reference isn't as ``length`` further on: ``id, stop`` (0: none)."""
    parts = _chunks(reference)
    live = moving.withColumns({"next": F.floor((F.col("upto") - 1) / chunk), "wide": F.lit(1).cast("long")})
    done = None
    while True:
        asked = live.withColumn("chunk_index", F.explode(F.sequence(F.greatest(F.lit(0), F.col("next") - F.col("wide") + 1), F.greatest(F.col("next"), F.lit(0)))))
        asked = asked.withColumn("size", F.least(F.lit(chunk), F.col("upto") - F.col("chunk_index") * chunk))
        looks = asked.select("chrom", "length", "chunk_index", "size").distinct()
        at = looks.withColumn("shifted", F.col("chunk_index") + F.floor(F.col("length") / chunk))
        own = at.join(parts, ["chrom", "chunk_index"], "left")
        ahead = lambda k, name: parts.select("chrom", (F.col("chunk_index") - k).alias("shifted"), F.col("sequence").alias(name)).hint("merge")
        both = own.join(ahead(0, "near"), ["chrom", "shifted"], "left").join(ahead(1, "far"), ["chrom", "shifted"], "left")
        skip = (F.col("length") % chunk).cast("int")
        size = F.col("size").cast("int")
        later = F.substring(F.concat(F.coalesce("near", F.lit("")), F.coalesce("far", F.lit(""))), skip + 1, size)
        # Where the reference has no bases an indel can't go.
        here = F.rpad(F.substring(F.coalesce("sequence", F.lit("")), F.lit(1), size), size, F.lit("?"))
        seen = both.select("chrom", "length", "chunk_index", "size", _last_difference(here, later).alias("last"))
        met = asked.join(seen, ["chrom", "length", "chunk_index", "size"])
        stop = F.max(F.when(F.col("last") > 0, F.col("chunk_index") * chunk + F.col("last")))
        found = staged(met.groupBy("id", "chrom", "length", "upto", "next", "wide").agg(stop.alias("stop")))
        ended = F.col("stop").isNotNull() | (F.col("next") < F.col("wide"))
        part = found.filter(ended).select("id", F.coalesce("stop", F.lit(0)).alias("stop"))
        done = part if done is None else done.union(part)
        live = found.filter(~ended).select("id", "chrom", "length", "upto", (F.col("next") - F.col("wide")).alias("next"), (2 * F.col("wide")).alias("wide"))
        if live.isEmpty():
            return done


def left_align(calls: DataFrame, reference: DataFrame, chunk: int) -> DataFrame:
    """Indels moved as far left as the reference allows, over any distance.

    ``reference``: ``chrom, chunk_index, sequence``, ``chunk`` bases each (positions from
    1 in chunk 0); the result doesn't depend on ``chunk``. Adds ``ref_matches``: whether
    ``ref``, of any length, is what the reference has (letters of either case are
    equal); others, and alleles that aren't plain bases, are returned unmoved. What
    isn't an insertion or a deletion is trimmed only. An indel before the first base
    keeps the base after it, others the base before. Null keys and null alleles don't match.
    """
    sites = calls.select(*KEY).distinct()
    sites = staged(sites.withColumn("id", F.xxhash64(*KEY)).withColumn("id2", F.xxhash64(F.lit(1), *KEY)))
    known = sites.filter("chrom IS NOT NULL AND pos > 0 AND length(ref) > 0 AND alt IS NOT NULL")
    checked = _with_reference(known, reference, "ref", "pos", chunk)
    right = checked.groupBy("id", "id2").agg(F.bool_and(F.upper("found") == F.upper("piece")).alias("ok")).filter("ok")
    plain = known.join(right, ["id", "id2"], "left_semi").filter(F.col("ref").rlike("^[A-Za-z]+$") & F.col("alt").rlike("^[A-Za-z]+$") & (F.upper("ref") != F.upper("alt")))
    # ``drop`` or ``add`` are the bases that go or come at ``at``; both are there where the variant is no indel.
    least = plain.withColumn("s", simplest("pos", "ref", "alt")).select("id", "id2", "chrom", "s.*")
    least = staged(least.withColumn("bases", F.concat("drop", "add")).withColumn("length", F.length("bases").cast("long")))
    indels = least.filter("drop = '' OR add = ''")
    # An insertion first has to match its own bases to the left of it.
    own = indels.filter("drop = '' AND at > 1").withColumn("size", F.least(F.col("length"), F.col("at") - 1)).withColumn("first", F.col("at") - F.col("size"))
    own = own.withColumn("tail", F.right("bases", F.col("size").cast("int")))
    met = _with_reference(own, reference, "tail", "first", chunk)
    last = F.max(F.when(_last_difference("piece", "found") > 0, F.col("a") - 1 + _last_difference("piece", "found")))
    met = met.groupBy("id", "id2", "chrom", "at", "length").agg(last.alias("stop"))
    through = F.col("stop").isNull()
    insertions = staged(met.withColumn("stop", F.when(through & (F.col("at") <= F.col("length") + 1), 0).otherwise(F.col("stop"))))
    moving = indels.filter("add = '' AND at > 1").select("id", "id2", "chrom", "length", (F.col("at") - 1).alias("upto"))
    moving = moving.union(insertions.filter("stop IS NULL").select("id", "id2", "chrom", "length", (F.col("at") - F.col("length") - 1).alias("upto")))
    keyed = staged(moving.withColumn("pair", F.struct("id", "id2")).select(F.col("pair").alias("id"), "chrom", "length", "upto"))
    stops = _stops(keyed, reference, chunk).select("id.id", "id.id2", "stop").union(insertions.filter("stop IS NOT NULL").select("id", "id2", "stop"))
    moved = indels.join(stops, ["id", "id2"], "left").withColumn("to", F.coalesce(F.col("stop") + 1, F.col("at")))
    turn = ((F.col("at") - F.col("to")) % F.col("length")).cast("int")
    moved = moved.withColumn("bases", F.concat(F.right("bases", turn), F.left("bases", (F.col("length") - turn).cast("int"))))
    # The base before, or after where there is none.
    front = F.col("to") > 1
    beside = F.when(front, F.col("to") - 1).otherwise(F.when(F.col("drop") == "", F.lit(1)).otherwise(1 + F.col("length")))
    moved = moved.withColumn("beside", beside).withColumn("chunk_index", F.floor((F.col("beside") - 1) / chunk))
    based = moved.join(_chunks(reference), ["chrom", "chunk_index"], "left")
    base = F.coalesce(F.substring(F.col("sequence"), ((F.col("beside") - 1) % chunk + 1).cast("int"), F.lit(1)), F.lit(""))
    whole, only = F.when(front, F.concat(base, "bases")).otherwise(F.concat("bases", base)), base
    gone = F.col("add") == ""
    done = based.select("id", "id2", F.greatest(F.col("to") - 1, F.lit(1)).alias("_pos"), F.when(gone, whole).otherwise(only).alias("_ref"), F.when(gone, only).otherwise(whole).alias("_alt"))
    done = done.union(least.filter("drop <> '' AND add <> ''").select("id", "id2", "at", "drop", "add"))
    out = calls.withColumns({"_id": F.xxhash64(*KEY), "_id2": F.xxhash64(F.lit(1), *KEY)})
    out = out.join(done.withColumnsRenamed({"id": "_id", "id2": "_id2"}), ["_id", "_id2"], "left")
    out = out.join(right.select(F.col("id").alias("_id"), F.col("id2").alias("_id2"), F.lit(True).alias("ref_matches")), ["_id", "_id2"], "left")
    new = {k: F.coalesce(f"_{k}", k) for k in ("pos", "ref", "alt")}
    return out.withColumns(new).withColumn("ref_matches", F.coalesce("ref_matches", F.lit(False))).select(*calls.columns, "ref_matches")
