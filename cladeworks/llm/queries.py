"""Registered queries of the operators in this subpackage, and their SQL."""

from __future__ import annotations

import os
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .conversations import conversation_report
from .cross_polytope import nearest_neighbours
from .decontaminate import contaminated_pairs
from .jaccard_join import jaccard_components
from .maxent_lm import score_texts
from .pieces import Vocabulary, decode_pieces, encode_pieces
from .secret_scan import scan_secrets
from .shared import materialize, shared_dir
from .spelling import count_words, spelling_forms
from .suffix_trees import cut_repeats
from .token_scan import count_tokens
from .toxicity import learn_toxicity, score_toxicity
from .url_trie import judge_urls
from .warc import read_warc, write_warc

#: Folder of the public vocabulary files.
TOKENIZERS = os.environ.get("TOKENIZER_DIR", "/opt/tokenizers")


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pieces of each whole text, scores of its four best segmentations, and whether decoding gives it back."""
    vocabulary = Vocabulary.load(f"{TOKENIZERS}/piece_bpe_32k.model")
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    out = decode_pieces(encode_pieces(docs, vocabulary, nbest=4), vocabulary)
    return out.select(
        "doc_id", F.size("ids").cast("long").alias("n_pieces"), "nbest_scores", F.xxhash64("ids").alias("ids_hash"),
        (F.col("decoded") == F.coalesce("text", F.lit(""))).alias("round_trip"),
    )


def op2_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pairs of a document and a benchmark item that it holds, word for word or with other slots."""
    return contaminated_pairs(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))


def op3_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every place of a candidate in any text, with the forest's verdict."""
    found = scan_secrets(_table(spark, sf_dir, "documents"))
    return found.select("doc_id", F.sha2("candidate", 256).alias("candidate_sha256"), F.length("candidate").alias("length"), "start", "probability", "is_secret")


def op4_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages written as WARC records and read back: digest, size and kind of each record."""
    path = shared_dir(spark)
    write_warc(_table(spark, sf_dir, "pages"), path)
    page = lambda name: F.regexp_extract(F.coalesce(name, F.lit("")), r"^<urn:page:(-?\d+)>$", 1).try_cast("long")
    digested = read_warc(spark, path).select(
        page("record_id").alias("page_id"), F.col("type").alias("record_type"), page("refers_to").alias("refers_to"),
        F.octet_length("payload").cast("long").alias("payload_bytes"), F.sha1("payload").alias("payload_digest"), F.substring_index("digest", ":", -1).alias("named"),
    )
    digested = materialize(digested)
    held = digested.filter("record_type = 'response'")
    full = held.select(F.col("page_id").alias("refers_to"), "payload_bytes", "payload_digest").filter("payload_bytes >= 1000").distinct()
    revisits = digested.filter("record_type = 'revisit'").select("page_id", "record_type", "refers_to", F.col("named").alias("payload_digest"))
    revisits = revisits.join(full.hint("merge"), ["refers_to", "payload_digest"])  # a page_id may be there with several payloads
    return held.drop("named").unionByName(revisits).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op5_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Size of each document's shingle set and its component of links."""
    return jaccard_components(_table(spark, sf_dir, "documents"), k=4, percent=85)


def op6_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tokens of each whole text, counted in flat token files."""
    return count_tokens(_table(spark, sf_dir, "documents"), shared_dir(spark), f"{TOKENIZERS}/byte_bpe_50k.tiktoken")


def op7_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Smoothed unigram and maximum-entropy scores of each whole text."""
    return score_texts(_table(spark, sf_dir, "documents"))


def op8_cross_polytope_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The five nearest vectors found for every fiftieth one."""
    return nearest_neighbours(_table(spark, sf_dir, "embeddings"), k=5, query_mod=50)


def op9_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity of each whole text by a lexicon learned outside the held-out fold."""
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    scored = score_toxicity(docs, learn_toxicity(docs, _table(spark, sf_dir, "labels")))
    held_out = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0
    return scored.select("doc_id", held_out.alias("held_out"), "score", "predicted")


#: Fixed values of op10: host, path prefix, verdict.
URL_RULES = [
    ("org", "/", "allow"),
    ("example.org", "/es/", "block"),
    ("example.org", "/en/1", "block"),
    ("com", "/fr/", "allow"),
    ("com", "/de/", "block"),
]


def op10_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Host, path, longest rule and verdict of each page's URL."""
    judged = judge_urls(_table(spark, sf_dir, "pages").select("page_id", "url"), URL_RULES)
    return judged.select("page_id", "host", "path", "rule", "verdict")


def damaged_conversations(conversations: DataFrame) -> DataFrame:
    """``conv_id, turn, role, text`` damaged by a checksum of conversation and turn; nulls are one space there."""
    said = lambda name: F.coalesce(F.col(name).cast("string"), F.lit(" "))
    kind = F.crc32(F.concat(said("conv_id"), F.lit(":"), said("turn")).cast("binary")) % 20
    rows = conversations.select("conv_id", "turn", said("role").alias("role"), said("text").alias("text"), kind.alias("kind")).filter("kind <> 0")
    text = F.when(F.col("kind") == 1, "").when(F.col("kind") == 2, F.translate("text", ".!?", "")).otherwise(F.col("text"))
    role = F.when(F.col("kind") == 4, "user").otherwise(F.col("role"))
    return rows.select("conv_id", "turn", role.alias("role"), text.alias("text"), F.explode(F.expr("sequence(1, if(kind = 3, 2, 1))"))).drop("col")


def op11_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Faults of each damaged conversation and its cheapest repair; one that lost all its rows has zeros."""
    conversations = _table(spark, sf_dir, "conversations")
    report = conversation_report(damaged_conversations(conversations))
    ids = conversations.select(F.col("conv_id").alias("id")).distinct()
    found = ids.join(report, F.col("id").eqNullSafe(F.col("conv_id")), "left")
    longs = [F.coalesce(c, F.lit(0)).alias(c) for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")]
    nothing = F.sha2(F.lit("").cast("binary"), 256)
    return found.select(F.col("id").alias("conv_id"), *longs, F.coalesce("audit", F.lit("")).alias("audit"), F.coalesce("repaired_sha256", nothing).alias("repaired_sha256"))


def op12_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words of each whole text, those in passages of 20 words that start earlier too, and a digest of the others."""
    cut = cut_repeats(_table(spark, sf_dir, "documents"), words=20)
    return cut.select("doc_id", "n_words", "n_removed", F.sha2(F.col("kept").cast("binary"), 256).alias("kept_sha256"))


UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def damaged_words(documents: DataFrame, min_length: int = 5) -> DataFrame:
    """Runs of letters of all whole texts, some with a code point less by a checksum; a null doc_id reads as empty there."""
    runs = F.regexp_extract_all(F.translate("text", UPPER, LOWER), F.lit("[a-z\u00c0-\u00ff]+"), F.lit(0))
    rows = documents.select(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).alias("id"), F.explode(runs).alias("run"))
    rows = rows.filter(F.length("run") >= min_length).withColumn("h", F.crc32(F.concat("id", F.lit(":"), "run").cast("binary")))
    place = (F.col("h") % F.length("run")).cast("int")
    less = F.concat(F.left("run", place), F.right("run", F.length("run") - place - 1))
    return rows.select(F.when(F.col("h") % 97 == 0, less).otherwise(F.col("run")).alias("word"))


def op13_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every word of at least 5 code points and 3 occurrences with its near words' number, form and root."""
    return spelling_forms(count_words(damaged_words(_table(spark, sf_dir, "documents"))))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_sentencepiece": op1_sentencepiece,
    "op2_benchmark_decontamination": op2_benchmark_decontamination,
    "op3_secret_scan": op3_secret_scan,
    "op4_warc": op4_warc,
    "op5_ngram_jaccard_join": op5_ngram_jaccard_join,
    "op6_token_counts": op6_token_counts,
    "op7_lm_scoring": op7_lm_scoring,
    "op8_cross_polytope_neighbours": op8_cross_polytope_neighbours,
    "op9_toxicity": op9_toxicity,
    "op10_url_filter": op10_url_filter,
    "op11_conversation_repair": op11_conversation_repair,
    "op12_substring_dedup": op12_substring_dedup,
    "op13_spelling_variants": op13_spelling_variants,
}

_CRC_TABLE = """crc AS (
  SELECT list_transform(range(256), lambda i: list_reduce(range(8), lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END, i)) AS t
)"""


def _crc32(codes: str) -> str:
    """SQL of the CRC-32 of a list of bytes; ``crc.t`` is its table."""
    step = "xor(c >> 8, crc.t[(xor(c, b) & 255) + 1])"
    return f"xor(list_reduce({codes}, lambda c, b: {step}, 4294967295), 4294967295)"


def _op11_sql() -> str:
    """A recursion over rows that holds the best edits for each state: none (z), system (s), user (u), assistant (a)."""
    add = lambda x, cost, letter, said="NULL": (
        f"{{'c': {x}.c + {cost}, 'e': {x}.e || '{letter}', 'o': " + (f"{x}.o" if said == "NULL" else f"CASE WHEN {x}.o IS NULL THEN {said} ELSE {x}.o || chr(10) || {said} END") + "}"
    )
    insert = lambda x, role: add(x, 2, "I", f"'{role}:'")
    least = lambda *x: f"list_sort([{', '.join(x)}])[1]"
    never = "{'c': 1000000000::BIGINT, 'e': '', 'o': NULL::VARCHAR}"
    user = least("u", insert("z", "user"), insert("s", "user"), insert("a", "user"))
    keep = lambda x, role: f"CASE WHEN r.i = '{role}' THEN {add(x, 'r.more', 'K', 'r.said')} ELSE {never} END"
    to = lambda x, role: add(x, "2 + r.more", "R", f"'{role}:' || r.text")
    gone = lambda x: add(x, 3, "D")
    stays = lambda *x: f"CASE WHEN r.forced THEN {never} ELSE {least(*x)} END"
    return rf"""
WITH RECURSIVE {_CRC_TABLE}, k AS (
  SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
    {_crc32("list_transform(string_split(coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' '), ''), lambda x: ascii(x)::BIGINT)")} % 20 AS kind
  FROM conversations, crc
), d AS (
  SELECT conv_id, turn, CASE WHEN kind = 4 THEN 'user' ELSE role END AS role,
    CASE WHEN kind = 1 THEN '' WHEN kind = 2 THEN translate(text, '.!?', '') ELSE text END AS text, unnest(range(CASE WHEN kind = 3 THEN 2 ELSE 1 END)) AS copy
  FROM k WHERE kind <> 0
), n AS (
  SELECT *, row_number() OVER w AS pos, rtrim(text, chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)) AS bare, row_number() OVER (PARTITION BY conv_id, role, text ORDER BY turn NULLS FIRST, copy) AS nth
  FROM d WINDOW w AS (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text, copy)
), f AS (
  SELECT *, CASE WHEN bare = '' THEN 'blank' WHEN nth > 1 THEN 'duplicate' WHEN NOT regexp_matches(right(bare, 1), '[.!?]') THEN 'truncated' ELSE '' END AS fault,
    left(role, 1) AS i, lag(left(role, 1)) OVER (PARTITION BY conv_id ORDER BY pos) || left(role, 1) AS two
  FROM n
), r AS (
  SELECT conv_id, pos, i, text, role || ':' || text AS said, fault IN ('blank', 'duplicate') AS forced, CASE WHEN fault = 'truncated' THEN 1 ELSE 0 END AS more FROM f
), t AS (
  SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count(*) FILTER (fault = 'blank') AS blank,
    count(*) FILTER (fault = 'duplicate') AS duplicate, count(*) FILTER (fault = 'truncated') AS truncated, count(*) FILTER (two NOT IN ('su', 'ua', 'au')) AS illegal, count(*) AS n
  FROM f GROUP BY conv_id
), b AS (
  SELECT conv_id, n, 1 AS pos, {{'c': 0::BIGINT, 'e': '', 'o': NULL::VARCHAR}} AS z, {never} AS s, {never} AS u, {never} AS a FROM t
  UNION ALL
  SELECT p.conv_id, p.n, p.pos + 1, {gone('z')}, {least(gone('s'), stays(keep('z', 's')))},
    {least(gone('u'), stays(*(x for q in ('z', 's', 'a1') for x in (keep(q, 'u'), to(q, 'user')))))},
    {least(gone('a'), stays(keep('u1', 'a'), to('u1', 'assistant')))}
  FROM (SELECT *, {least('a', insert('u1', 'assistant'))} AS a1 FROM (SELECT *, {user} AS u1 FROM b WHERE pos <= n)) p
  JOIN r ON r.conv_id IS NOT DISTINCT FROM p.conv_id AND r.pos = p.pos
), e AS (
  SELECT conv_id, {least('z', 'a', insert('u1', 'assistant'))} AS x FROM (SELECT *, {user} AS u1 FROM b WHERE pos = n + 1)
)
SELECT i.conv_id, coalesce(gaps, 0) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate, coalesce(truncated, 0) AS truncated,
  coalesce(illegal, 0) AS illegal, coalesce(x.c, 0) AS cost, coalesce(x.e, '') AS audit, sha256(coalesce(x.o, '')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) i
LEFT JOIN t ON t.conv_id IS NOT DISTINCT FROM i.conv_id LEFT JOIN e ON e.conv_id IS NOT DISTINCT FROM i.conv_id
"""


ORACLE_SQL: dict[str, str] = {
    "op4_warc": r"""
WITH p AS (
  SELECT page_id, octet_length(encode(coalesce(html, ''))) AS n, sha1(coalesce(html, '')) AS d FROM pages
), k AS (SELECT d, max(page_id) AS kept FROM p WHERE n >= 1000 GROUP BY 1)
SELECT page_id, CAST(n AS BIGINT) AS payload_bytes, p.d AS payload_digest,
  CASE WHEN kept <> page_id THEN 'revisit' ELSE 'response' END AS record_type,
  CASE WHEN kept <> page_id THEN kept END AS refers_to
FROM p LEFT JOIN k ON p.d = k.d AND n >= 1000
""",
    "op5_ngram_jaccard_join": r"""
WITH RECURSIVE w AS (
  SELECT doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w
  FROM documents
), s AS (
  SELECT doc_id, CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 4 THEN [array_to_string(w, ' ')]
    ELSE list_distinct(list_transform(range(1, len(w) - 2), lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2] || ' ' || w[i + 3])) END AS s
  FROM w
), e AS (SELECT doc_id, len(s) AS n, unnest(s) AS sh FROM s),
pairs AS (
  SELECT a.doc_id AS a, b.doc_id AS b, any_value(a.n) AS na, any_value(b.n) AS nb, count(*) AS c
  FROM e a JOIN e b ON a.sh = b.sh AND a.doc_id < b.doc_id GROUP BY 1, 2
), links AS (
  SELECT a, b FROM pairs WHERE 100 * c >= 85 * (na + nb - c)
  UNION ALL SELECT b, a FROM pairs WHERE 100 * c >= 85 * (na + nb - c)
), reach AS (
  SELECT doc_id, doc_id AS root FROM documents
  UNION SELECT l.b, r.root FROM reach r JOIN links l ON l.a = r.doc_id
), roots AS (SELECT doc_id, min(root) AS component_id FROM reach GROUP BY 1)
SELECT s.doc_id, CAST(len(s.s) AS BIGINT) AS n_shingles, r.component_id FROM s JOIN roots r USING (doc_id)
""",
    "op10_url_filter": r"""
WITH p AS (
  SELECT page_id, CASE WHEN contains(coalesce(url, ''), '://') THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest FROM pages
), h AS (
  SELECT page_id,
    translate(regexp_extract(rest, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
    regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path
  FROM p
), rules(rhost, rpath, v) AS (
  VALUES ('org', '/', 'allow'), ('example.org', '/es/', 'block'), ('example.org', '/en/1', 'allow'), ('com', '/fr/', 'allow'), ('com', '/de/', 'block')
), m AS (
  SELECT h.page_id, host, path, rhost || rpath AS rule, v,
    row_number() OVER (PARTITION BY h.page_id, host, path ORDER BY length(rhost) + length(rpath) DESC NULLS LAST) AS k
  FROM h LEFT JOIN rules ON (host = rhost OR ends_with(host, '.' || rhost)) AND starts_with(path, rpath)
)
SELECT page_id, host, path, rule, coalesce(v, 'allow') AS verdict FROM m WHERE k = 1
""",
    "op11_conversation_repair": _op11_sql(),
    "op12_substring_dedup": r"""
WITH w AS (
  SELECT doc_id, list_filter(regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w FROM documents
), e AS (
  SELECT doc_id, i, md5(array_to_string(w[i + 1:i + 20], ' ')) AS k FROM (SELECT doc_id, w, unnest(range(len(w) - 19)) AS i FROM w WHERE len(w) >= 20)
), late AS (
  SELECT doc_id, i FROM e QUALIFY row_number() OVER (PARTITION BY k ORDER BY doc_id, i) > 1
), gone AS (
  SELECT doc_id, list(DISTINCT j) AS gone FROM (SELECT doc_id, unnest(range(i, i + 20)) AS j FROM late) GROUP BY doc_id
), kept AS (
  SELECT w.doc_id, len(w) AS n, list_distinct(coalesce(gone, [])) AS gone, w FROM w LEFT JOIN gone USING (doc_id)
), words AS (
  SELECT doc_id, string_agg(x, ' ' ORDER BY j) AS kept
  FROM (SELECT doc_id, unnest(w) AS x, unnest(range(len(w))) AS j FROM w) ANTI JOIN (SELECT doc_id, unnest(gone) AS j FROM gone) USING (doc_id, j) GROUP BY doc_id
)
SELECT kept.doc_id, CAST(n AS BIGINT) AS n_words, CAST(len(gone) AS BIGINT) AS n_removed, sha256(coalesce(kept, '')) AS kept_sha256 FROM kept LEFT JOIN words USING (doc_id)
""",
    "op13_spelling_variants": rf"""
WITH RECURSIVE {_CRC_TABLE}, runs AS (
  SELECT coalesce(doc_id::VARCHAR, '') || ':' AS id, unnest(regexp_extract_all(translate(text, '{UPPER}', '{LOWER}'), '[a-z\x{{C0}}-\x{{FF}}]+')) AS run FROM documents
), h AS (
  SELECT run, count(*) AS n, {_crc32("flatten(list_transform(string_split(id || run, ''), lambda x: CASE WHEN unicode(x) < 128 THEN [unicode(x)::BIGINT] ELSE [(192 + (unicode(x) >> 6))::BIGINT, (128 + (unicode(x) & 63))::BIGINT] END))")} AS h
  FROM runs, crc WHERE length(run) >= 5 GROUP BY run, id, crc.t
), c AS (
  SELECT CASE WHEN h % 97 = 0 THEN left(run, (h % length(run))::INT) || right(run, length(run) - (h % length(run))::INT - 1) ELSE run END AS word, sum(n)::BIGINT AS n FROM h GROUP BY 1
), v AS (SELECT word, n FROM c WHERE length(word) >= 5 AND n >= 3),
less AS (SELECT word, n, i, left(word, i) || substr(word, i + 2) AS rest FROM (SELECT word, n, unnest(range(length(word))) AS i FROM v)),
pairs AS (
  SELECT DISTINCT a.word AS a, b.word AS b, b.n FROM less a JOIN less b ON a.rest = b.rest AND a.i = b.i AND a.word <> b.word AND length(a.word) = length(b.word)
  UNION SELECT less.word, v.word, v.n FROM less JOIN v ON v.word = less.rest
  UNION SELECT v.word, less.word, less.n FROM less JOIN v ON v.word = less.rest
), best AS (SELECT a, count(*) AS n_near, max(n) AS top, min({{'n': -n, 'b': b}}).b AS b FROM pairs GROUP BY a),
f AS (
  SELECT word, n, coalesce(n_near, 0) AS n_near, CASE WHEN top >= 2 * n THEN b END AS form, CASE WHEN top >= 2 * n THEN top END AS form_n FROM v LEFT JOIN best ON a = word
), way AS (
  SELECT word, form AS root FROM f WHERE form IS NOT NULL UNION ALL SELECT way.word, f.form FROM way JOIN f ON f.word = way.root WHERE f.form IS NOT NULL
), roots AS (SELECT way.word, root FROM way JOIN f ON f.word = way.root WHERE f.form IS NULL)
SELECT word, form, coalesce(root, word) AS root, n, n_near, form_n FROM f LEFT JOIN roots USING (word)
""",
}
