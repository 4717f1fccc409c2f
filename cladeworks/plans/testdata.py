"""Single-cell tables derived from the driver's tables.

Each view is one SQL text that Spark and DuckDB both run: ``{table}`` stands for a
table of the driver, ``{view}`` for another view.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events")

_CELL = "'CELL_' || lpad(CAST({0} AS STRING), 9, '0')"
_CLONE = "'clone_' || lpad(CAST(1 + n_regionkey AS STRING), 3, '0')"

VIEWS: dict[str, str] = {
    "cells": f"""
SELECT {_CELL.format("c_custkey")} AS cell_id, '/bam/' || CAST(c_custkey AS STRING) || '.bam' AS bam_path,
  CASE WHEN c_custkey % 3 = 0 THEN NULL WHEN c_custkey % 3 = 1 THEN '' ELSE '/bam/' || CAST(c_custkey AS STRING) || '.bam.bai' END AS bai_path,
  c_mktsegment AS sample_id, 'P' || CAST(c_nationkey AS STRING) AS patient_id
FROM {{customer}}""",
    "assignments": f"""
SELECT {_CELL.format("c_custkey")} AS cell_id, {_CLONE} AS clone_id, 'region' AS strategy, false AS flagged, CAST(c_custkey % 100 AS DOUBLE) / 100 AS confidence
FROM {{customer}} JOIN {{nation}} ON c_nationkey = n_nationkey""",
    "normals": """
SELECT 'N' || CAST(n_nationkey AS STRING) AS sample_id, 'P' || CAST(n_nationkey AS STRING) AS patient_id, '/normal/' || CAST(n_nationkey AS STRING) || '.bam' AS bam_path
FROM {nation} WHERE n_nationkey IN (SELECT s_nationkey FROM {supplier} GROUP BY s_nationkey HAVING avg(s_acctbal) > 4000)""",
    # Two named levels above the cells of each region's tree; lengths in hundredths.
    "labelled": f"""
SELECT 'T' || CAST(n_regionkey AS STRING) AS tree_id, n_regionkey AS r, n_nationkey AS n, CAST(c_custkey AS BIGINT) AS c, c_mktsegment AS s,
  'R' || CAST(n_regionkey AS STRING) AS root, 'N' || CAST(n_nationkey AS STRING) AS nat, 'N' || CAST(n_nationkey AS STRING) || '_' || c_mktsegment AS seg, {_CELL.format("c_custkey")} AS cell
FROM {{customer}} JOIN {{nation}} ON c_nationkey = n_nationkey""",
    "nodes": """
SELECT tree_id, node_id, parent_id, is_leaf, edge_length, CAST(pre AS BIGINT) AS pre, CAST(pre + below AS BIGINT) AS last, CAST(depth AS BIGINT) AS depth, root_dist
FROM (
  SELECT tree_id, node_id, parent_id, is_leaf, edge_length, below, depth, root_dist, row_number() OVER (PARTITION BY tree_id ORDER BY k1, k2, k3) - 1 AS pre
  FROM (
    SELECT tree_id, root AS node_id, CAST(NULL AS STRING) AS parent_id, false AS is_leaf, CAST(0 AS DOUBLE) AS edge_length, count(*) + count(DISTINCT seg) + count(DISTINCT nat) AS below, 0 AS depth, CAST(0 AS DOUBLE) AS root_dist, -1 AS k1, '' AS k2, CAST(-1 AS BIGINT) AS k3
    FROM {labelled} GROUP BY tree_id, root
    UNION ALL
    SELECT tree_id, nat, root, false, CAST(n * 7 % 20 + 5 AS DOUBLE) / 100, count(*) + count(DISTINCT seg), 1, CAST(n * 7 % 20 + 5 AS DOUBLE) / 100, n, '', CAST(-1 AS BIGINT)
    FROM {labelled} GROUP BY tree_id, nat, root, n
    UNION ALL
    SELECT tree_id, seg, nat, false, CAST((n * 3 + length(s) * 5) % 17 + 3 AS DOUBLE) / 100, count(*), 2, CAST(n * 7 % 20 + 5 + (n * 3 + length(s) * 5) % 17 + 3 AS DOUBLE) / 100, n, s, CAST(-1 AS BIGINT)
    FROM {labelled} GROUP BY tree_id, seg, nat, n, s
    UNION ALL
    SELECT tree_id, cell, seg, true, CAST(c % 9 + 1 AS DOUBLE) / 100, 0, 3, CAST(n * 7 % 20 + 5 + (n * 3 + length(s) * 5) % 17 + 3 + c % 9 + 1 AS DOUBLE) / 100, n, s, c
    FROM {labelled}
  ) a
) b""",
    "branch_events": """
SELECT tree_id, node_id AS child_node, 'chr' || CAST(1 + pre % 22 AS STRING) AS chrom, pre * 1000 AS start, CASE WHEN pre % 2 = 0 THEN 'gain' ELSE 'loss' END AS event_type
FROM {nodes} WHERE parent_id IS NOT NULL AND pre % 3 <> 0
UNION ALL SELECT tree_id, node_id, 'chrX', pre * 1000, 'gain' FROM {nodes} WHERE parent_id IS NOT NULL AND pre % 5 = 0""",
    "cn_events": f"""
SELECT DISTINCT {_CELL.format("o_custkey")} AS cell_id, 'chr' || CAST(1 + l_suppkey % 22 AS STRING) AS chr, CAST(floor(l_suppkey / 22) AS BIGINT) * 10000000 AS start,
  CAST(floor(l_suppkey / 22) AS BIGINT) * 10000000 + 5000000 AS "end", CASE WHEN l_returnflag = 'R' THEN 'gain' ELSE 'loss' END AS event_type
FROM {{lineitem}} JOIN {{orders}} ON l_orderkey = o_orderkey WHERE l_returnflag <> 'N'""",
    "calls": f"""
SELECT {_CLONE} AS clone_id, CASE l_linenumber % 3 WHEN 0 THEN 'mutect2' WHEN 1 THEN 'strelka2' ELSE 'freebayes' END AS caller,
  'chr' || CAST(1 + l_partkey % 22 AS STRING) AS chrom, 1000 + l_partkey * 100 AS pos, substr('ACGT', CAST(1 + l_partkey % 4 AS INT), 1) AS ref,
  substr('ACGT', CAST(1 + (l_partkey + 1 + CAST(l_quantity AS BIGINT) % 3) % 4 AS INT), 1) AS alt, CASE WHEN l_linenumber % 4 = 0 THEN NULL ELSE l_quantity END AS qual,
  CASE l_returnflag WHEN 'N' THEN 'PASS' WHEN 'A' THEN '.' ELSE 'weak_evidence' END AS filters, 'DP=' || CAST(CAST(l_quantity AS BIGINT) AS STRING) || ';AF=0.' || CAST(l_linenumber AS STRING) || CASE WHEN l_linestatus = 'O' THEN ';SOMATIC' ELSE '' END AS info
FROM {{lineitem}} JOIN {{orders}} ON l_orderkey = o_orderkey JOIN {{customer}} ON o_custkey = c_custkey JOIN {{nation}} ON c_nationkey = n_nationkey""",
    # Caller files: also one caller that finds nothing.
    "files": "SELECT DISTINCT clone_id, caller FROM {calls} UNION ALL SELECT DISTINCT clone_id, 'quiet' FROM {calls}",
    "reads": f"""
SELECT {_CELL.format("o_custkey")} AS cell_id, {_CLONE} AS clone_id,
  CAST(l_orderkey AS STRING) || ':' || CAST(l_linenumber AS STRING) || ':' || CAST(l_partkey AS STRING) || ':' || CAST(l_suppkey AS STRING) || ':' || CAST(CAST(round(l_extendedprice * 100) AS BIGINT) AS STRING) AS read_id,
  'chr' || CAST(1 + l_suppkey % 22 AS STRING) AS chrom, 1 + l_suppkey % 22 AS chrom_idx, (l_partkey * 97 + l_linenumber * 13) % 20000 AS start,
  (l_partkey * 97 + l_linenumber * 13) % 20000 + 50 + CAST(l_quantity AS BIGINT) AS "end", CAST(50 + CAST(l_quantity AS BIGINT) AS STRING) || 'M' AS cigar, CAST(round(l_discount * 100) AS BIGINT) * 6 AS mapq,
  CAST(1 + 2 * (l_linenumber % 2) + 16 * (l_linenumber % 2) + CASE WHEN l_linenumber % 3 = 0 THEN 128 ELSE 64 END + CASE WHEN l_quantity > 48 THEN 4 ELSE 0 END
    + CASE WHEN l_quantity < 3 THEN 8 ELSE 0 END + CASE WHEN l_tax > 0.07 THEN 256 ELSE 0 END + CASE WHEN l_linestatus = 'F' AND l_discount > 0.09 THEN 512 ELSE 0 END AS INT) AS flag,
  'chr' || CAST(1 + (l_suppkey + CASE WHEN l_quantity < 10 THEN 1 ELSE 0 END) % 22 AS STRING) AS mate_chrom, (l_partkey * 97 + l_linenumber * 13) % 20000 + 200 AS mate_start, CAST(floor(l_extendedprice) AS BIGINT) % 4000 AS base_quality
FROM {{lineitem}} JOIN {{orders}} ON l_orderkey = o_orderkey JOIN {{customer}} ON o_custkey = c_custkey JOIN {{nation}} ON c_nationkey = n_nationkey""",
    "panel": "SELECT DISTINCT 'chr' || CAST(1 + p_partkey % 22 AS STRING) AS chrom, 1000 + p_partkey * 100 AS pos, substr('ACGT', CAST(1 + p_partkey % 4 AS INT), 1) AS ref, substr('ACGT', CAST(1 + (p_partkey + 1 + p_size % 3) % 4 AS INT), 1) AS alt FROM {part}",
    "germline": "SELECT 'chr' || CAST(1 + p_partkey % 22 AS STRING) AS chrom, 1000 + p_partkey * 100 AS pos, substr('ACGT', CAST(1 + p_partkey % 4 AS INT), 1) AS ref, substr('ACGT', CAST(1 + (p_partkey + 1) % 4 AS INT), 1) AS alt, p_retailprice / 2000 AS af FROM {part}",
    "bed": "SELECT 'chr' || CAST(1 + p_partkey % 22 AS STRING) AS chrom, p_partkey * 100 AS start, p_partkey * 100 + 900 + p_partkey % 200 AS \"end\" FROM {part}",
    "genes": "SELECT 'chr' || CAST(1 + s_suppkey % 22 AS STRING) AS chrom, CAST(s_suppkey * 1777 % 20000 AS BIGINT) AS start, CAST(s_suppkey * 1777 % 20000 + 5 + s_suppkey % 40 AS BIGINT) AS \"end\" FROM {supplier}",
    "alleles": """
SELECT clone_id, chrom, pos, ref, alt, CAST(count(*) AS BIGINT) AS n_alt FROM {calls} GROUP BY clone_id, chrom, pos, ref, alt""",
    # Cells whose orders are dear on the whole, and those with one of the dearest.
    "ids": f"SELECT {_CELL.format('o_custkey')} AS id FROM {{orders}} GROUP BY o_custkey HAVING avg(o_totalprice) > (SELECT avg(o_totalprice) FROM {{orders}})",
    "dear": f"SELECT DISTINCT {_CELL.format('o_custkey')} AS id FROM {{orders}} WHERE o_totalprice > (SELECT avg(o_totalprice) + 2 * stddev_pop(o_totalprice) FROM {{orders}})",
}


def view(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A view, or a table of the driver, as a DataFrame."""
    if name in TABLES:
        return spark.read.parquet(f"{sf_dir}/{name}.parquet")
    sql = VIEWS[name].replace('"end"', "`end`")
    return spark.sql(sql, **{n: view(spark, sf_dir, n) for n in set(re.findall(r"\{(\w+)\}", sql))})


def with_views(sql: str) -> str:
    """DuckDB text of a query that names views: its views as common table expressions."""
    order: list[str] = []

    def need(text: str) -> None:
        for name in VIEWS:
            if re.search(rf"\b{name}\b", text) and name not in order:
                need(VIEWS[name])
                if name not in order:
                    order.append(name)

    need(sql)
    views = ",\n".join(f"{n} AS ({re.sub(r'[{](\w+)[}]', r'\1', VIEWS[n])})" for n in order)
    head = "WITH RECURSIVE " if "RECURSIVE" in sql else "WITH "
    body = re.sub(r"^\s*WITH (RECURSIVE )?", ", ", sql, count=1)
    return f"{head}{views}\n{body}" if views else sql
