"""Calls compared across clones and callers.

``calls`` hold ``clone_id, caller, chrom, pos, ref, alt``; ``files`` hold
``clone_id, caller`` of each caller file, also of ones without a call. Everything
starts from the distinct (key, clone, caller): one shuffle on the key.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.columns import KEY
from ..functions.staging import staged

MAX_PIVOT = 400
#: Clones whose counts of shared keys a task holds as a matrix (32 MB), and keys of a product.
MAX_DENSE, KEY_ROWS = 2048, 2048


def variant_set(calls: DataFrame) -> DataFrame:
    """Distinct keys of each caller's file."""
    return calls.select("clone_id", "caller", *KEY).distinct()


def all_keys(calls: DataFrame) -> DataFrame:
    """Keys found anywhere."""
    return calls.select(*KEY).distinct()


def presence_matrix(calls: DataFrame, files: DataFrame, max_columns: int = MAX_PIVOT) -> DataFrame:
    """0/1 for each key and ``{clone}.{caller}``, empty files included; columns in order.

    Refuses more than ``max_columns`` files: stay with the long form then.
    """
    names = [r.c for r in files.select(F.concat_ws(".", "clone_id", "caller").alias("c")).distinct().orderBy("c").limit(max_columns + 1).collect()]
    if len(names) > max_columns:
        raise ValueError(f"more than {max_columns} files; use variant_set")
    wide = variant_set(calls).withColumn("c", F.concat_ws(".", "clone_id", "caller"))
    if not names:
        return wide.select(*KEY).limit(0)
    return wide.groupBy(*KEY).pivot("c", names).agg(F.lit(1)).fillna(0, subset=[f"`{n}`" for n in names])


def caller_concordance(calls: DataFrame, files: DataFrame) -> DataFrame:
    """Per clone the keys seen by one caller or more, two or more, and all its caller files.

    ``concordance_rate`` is all / any, 0 without calls.
    """
    n_files = files.groupBy("clone_id").agg(F.countDistinct("caller").alias("n_callers"))
    seen = calls.groupBy("clone_id", *KEY).agg(F.countDistinct("caller").alias("k"))
    per = seen.join(n_files, "clone_id").groupBy("clone_id").agg(
        F.count("*").alias("n_variants_any"), F.count_if(F.col("k") >= F.col("n_callers")).alias("n_variants_all"), F.count_if(F.col("k") >= 2).alias("n_variants_2plus")
    )
    out = n_files.join(per, "clone_id", "left").fillna(0, ["n_variants_any", "n_variants_all", "n_variants_2plus"])
    return out.withColumn("concordance_rate", F.when(F.col("n_variants_any") > 0, F.col("n_variants_all") / F.col("n_variants_any")).otherwise(0.0))


def clone_presence(calls: DataFrame) -> DataFrame:
    """Keys of each clone, whichever caller found them."""
    return calls.select("clone_id", *KEY).distinct()


def variant_sharing(calls: DataFrame, files: DataFrame) -> DataFrame:
    """Per key the number of clones that have it, and ``private``, ``partial`` or ``shared`` (in all clones)."""
    n = files.agg(F.countDistinct("clone_id").alias("n"))
    k = calls.groupBy(*KEY).agg(F.countDistinct("clone_id").alias("n_clones_with_variant"))
    return k.crossJoin(F.broadcast(n)).withColumn("sharing_class", _sharing(F.col("n_clones_with_variant"), F.col("n"))).drop("n")


def _sharing(k: Column, n: Column) -> Column:
    return F.when(k <= 1, "private").when(k < n, "partial").otherwise("shared")


def sharing_by_clone(calls: DataFrame, files: DataFrame) -> DataFrame:
    """Per clone the number of its keys of each sharing class."""
    n = files.agg(F.countDistinct("clone_id").alias("n"))
    by_key = calls.groupBy(*KEY).agg(F.collect_set("clone_id").alias("cs")).crossJoin(F.broadcast(n))
    rows = by_key.select(F.explode("cs").alias("clone_id"), _sharing(F.size("cs"), F.col("n")).alias("sharing_class"))
    return rows.groupBy("clone_id").pivot("sharing_class", ["private", "partial", "shared"]).agg(F.count(F.lit(1))).fillna(0)


def detected_records(calls: DataFrame, present: DataFrame) -> DataFrame:
    """Records whose clone and key are among ``present``."""
    return calls.join(present, ["clone_id", *KEY], "left_semi")


def per_clone_variants(calls: DataFrame) -> DataFrame:
    """Every record of every caller of a clone; the caller comes first."""
    return detected_records(calls, clone_presence(calls)).select("clone_id", "caller", *KEY, "qual", "filters")


def clone_similarity(calls: DataFrame, files: DataFrame) -> DataFrame:
    """Jaccard similarity of the key sets of each two clones, the diagonal included; 0 for two empty ones.

    Up to ``MAX_DENSE`` clones, a task makes rows of bits of its keys' clones and adds up
    products of these matrices; it hands on one row for each clone. With more clones
    pairs are counted within the array of a key's clones. No key is joined with itself.
    """
    clones = staged(files.select("clone_id").distinct())
    by_key = calls.groupBy(*KEY).agg(F.collect_set("clone_id").alias("cs"))
    names = [r.clone_id for r in clones.orderBy("clone_id").limit(MAX_DENSE + 1).collect()]
    if len(names) <= MAX_DENSE:
        both = _shared_keys(by_key, names)
    else:
        pairs = by_key.select(F.explode("cs").alias("clone_a"), "cs").select("clone_a", F.explode("cs").alias("clone_b"))
        both = pairs.groupBy("clone_a", "clone_b").agg(F.count("*").alias("n"))
    both = staged(both)
    size = both.filter("clone_a = clone_b")
    few = len(names) <= MAX_DENSE
    other = clones.select(F.col("clone_id").alias("clone_b"))
    grid = clones.select(F.col("clone_id").alias("clone_a")).crossJoin(F.broadcast(other) if few else other)
    grid = grid.join(both, ["clone_a", "clone_b"], "left")
    grid = grid.join(size.select("clone_a", F.col("n").alias("na")), "clone_a", "left").join(size.select("clone_b", F.col("n").alias("nb")), "clone_b", "left").fillna(0)
    union = F.col("na") + F.col("nb") - F.col("n")
    return grid.select("clone_a", "clone_b", F.when(union > 0, F.col("n") / union).otherwise(0.0).alias("jaccard"))


def _shared_keys(by_key: DataFrame, names: list[str]) -> DataFrame:
    """Keys that each two of ``names`` share: ``clone_a, clone_b, n``, without zeros."""
    place = {c: i for i, c in enumerate(names)}
    m = len(names)

    def multiply(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total = np.zeros((m, m), np.int64)
        for f in frames:
            for at in range(0, len(f), KEY_ROWS):
                sets = [[place[c] for c in cs if c in place] for cs in f["cs"].iloc[at : at + KEY_ROWS]]
                has = np.zeros((len(sets), m), np.float32)
                has[np.repeat(np.arange(len(sets)), [len(x) for x in sets]), [i for x in sets for i in x]] = 1
                total += (has.T @ has).astype(np.int64)
        found = np.flatnonzero(total.any(axis=1))
        yield pd.DataFrame({"a": found, "n": [total[i] for i in found]})

    parts = by_key.select("cs").mapInPandas(multiply, "a int, n array<long>")
    added = parts.select("a", F.posexplode("n").alias("b", "n")).filter("n > 0").groupBy("a", "b").agg(F.sum("n").alias("n"))
    named = F.array(*[F.lit(c) for c in names]) if names else F.array().cast("array<string>")
    return added.select(F.get(named, F.col("a")).alias("clone_a"), F.get(named, F.col("b")).alias("clone_b"), "n")


def _support(calls: DataFrame) -> DataFrame:
    return calls.groupBy(*KEY, "clone_id").agg(F.countDistinct("caller").alias("n_callers"), F.sort_array(F.collect_set("caller")).alias("callers"))


def consensus_variants(calls: DataFrame, min_callers: int = 2) -> DataFrame:
    """Keys that ``min_callers`` callers have found in one and the same clone."""
    best = _support(calls).groupBy(*KEY).agg(F.max("n_callers").alias("max_callers"))
    return best.filter(F.col("max_callers") >= min_callers)


def consensus_long(calls: DataFrame, min_callers: int = 2) -> DataFrame:
    """Consensus keys with the callers of every clone that has them: ``key, clone_id, n_callers, callers``."""
    return _support(calls).join(consensus_variants(calls, min_callers).select(*KEY), KEY, "left_semi")


def consensus_table(calls: DataFrame, clones: DataFrame, min_callers: int = 2, max_columns: int = MAX_PIVOT) -> DataFrame:
    """Consensus keys with ``{clone}_n_callers`` and ``{clone}_callers`` (joined by ``;``) for each clone."""
    names = [r[0] for r in clones.select("clone_id").distinct().orderBy("clone_id").limit(max_columns + 1).collect()]
    if len(names) > max_columns:
        raise ValueError(f"more than {max_columns} clones; use consensus_long")
    per = _support(calls).groupBy(*KEY)
    of = lambda c, x, none: F.coalesce(F.max(F.when(F.col("clone_id") == c, x)), F.lit(none))
    columns = [y for c in names for y in (of(c, F.col("n_callers").cast("int"), 0).alias(f"{c}_n_callers"), of(c, F.array_join("callers", ";"), "").alias(f"{c}_callers"))]
    return per.agg(F.max("n_callers").alias("_best"), *columns).filter(F.col("_best") >= min_callers).drop("_best")


def consensus_info(calls: DataFrame, min_callers: int = 2) -> DataFrame:
    """Per consensus key the number of clones with any support, and all their callers joined by ``,``."""
    callers = F.array_join(F.sort_array(F.array_distinct(F.flatten(F.collect_list("callers")))), ",")
    per = _support(calls).groupBy(*KEY).agg(F.count("*").alias("n_clones"), callers.alias("callers"), F.max("n_callers").alias("_best"))
    return per.filter(F.col("_best") >= min_callers).drop("_best")


def consensus_summary(calls: DataFrame, min_callers: int = 2, pass_only: bool = True) -> DataFrame:
    """One row: keys that came in, keys of the consensus, and the settings."""
    best = _support(calls).groupBy(*KEY).agg(F.max("n_callers").alias("k"))
    return best.agg(F.count("*").alias("n_input_variants"), F.count_if(F.col("k") >= min_callers).alias("n_consensus")).select(
        "n_input_variants", "n_consensus", F.lit(min_callers).alias("min_callers_required"), F.lit(pass_only).alias("pass_only")
    )


def sort_keys(keys: DataFrame) -> DataFrame:
    """Rows in the order of their keys: chromosome as text, position, alleles."""
    return keys.orderBy(*KEY)
