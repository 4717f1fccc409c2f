"""Secret scan with a random forest that removes false positives; DataFrame functions only.

A pattern finds candidates in whole texts. Every place where one stands gets features:
length, character transitions, how much of it common words of the corpus cover, path
signs, and the words beside it. A random forest, trained from labelled findings,
decides. Nothing is joined or grouped by candidate, so one that is in a third of all
texts is no bottleneck.
"""

from __future__ import annotations

from pyspark.ml.classification import RandomForestClassificationModel, RandomForestClassifier
from pyspark.ml.feature import StopWordsRemover, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .shared import materialize, shared_dir

# Words that name a secret, and beginnings of tokens that services give out.
KEYWORDS = r"token|secret|passw(?:or)?d|passwd|api[_-]?key|access[_-]?key|private[ _-]?key|credential|auth(?!ors?\b)|bearer"
PREFIXES = r"ghp_|gho_|ghs_|github_pat_|glpat-|sk_live_|rk_live_|xox[abp]-|AKIA|AIza|npm_|hf_"

_NAME = rf"(?i:{KEYWORDS})[A-Za-z0-9_-]{{0,12}}[\"']?\s{{0,2}}[:=]\s{{0,2}}"
_RUN = "(?<![A-Za-z0-9+/_-])[A-Za-z0-9+/_-]{16,}+"
_PADDING = "(?:={1,2}(?![A-Za-z0-9+/_=-]))?"
#: Forms of candidates, of which the first that fits counts; each tells by one character in front whether it may begin.
CANDIDATE = "|".join([
    r"(?<=-)(?<=PRIVATE KEY-----)[A-Za-z0-9+/=\s\\]{16,}+(?=-----END)",  # a block between its lines
    r"(?<=:)(?<=://[^\s/:@]{1,64}:)[^\s/@\"']{4,}+(?=@)",  # a password in a URL
    rf"{_RUN}(?:\.[A-Za-z0-9_-]{{16,}}+)+",  # dotted parts are one
    rf"(?<=[\"'`])(?<={_NAME}[\"'`])[^\s\"'`]{{6,}}+(?=[\"'`])",  # a quoted value of a secret's name, whatever its signs
    rf"(?<=[:=]|[:=] )(?<={_NAME})(?!(?i:bearer|basic|token)\b)[A-Za-z0-9+/_!@#$%^*~-]{{6,}}+{_PADDING}",  # one without quotes
    _RUN + _PADDING,
])
LEFT, RIGHT = 80, 40  # characters beside a candidate
FEATURES = [
    "length", "transitions", "runs", "digits", "capitals", "hexadecimal", "signs", "vowels", "coverage",
    "slashes", "after_path", "before_extension", "keyword", "assigned", "quoted", "left_letters", "right_letters",
    "in_block", "in_url", "known_prefix", "dots",
]
FORM_FINDINGS = 64  # of each form
DICTIONARY_WORDS = 20_000
MAX_FINDINGS = 20_000  # of each label
BROADCAST_BYTES = 32 << 20
REDACTED = "<secret>"


def _count(pattern: str, text: Column) -> Column:
    return F.regexp_count(text, F.lit(pattern)).cast("double")


def find_candidates(docs: DataFrame) -> DataFrame:
    """Every candidate of each whole text: ``doc_id, text_hash, candidate, start, left, right``.

    A candidate is a run of 16 or more letters, digits and ``+/_-``, with one or two
    ``=`` as padding at its end (elsewhere ``=`` parts name and value), or several such
    runs with dots between; the whole body of a private key between its BEGIN and END
    lines; a password in a URL; or 6 or more characters that a secret's name is given
    in one line or the next, in quotes with any signs. ``start`` is its
    place from 1. ``left`` and ``right`` are up to 80 and 40 characters beside it, but no
    more than the candidate before and the one after. ``text_hash`` is the xxhash64 of
    the text. The work grows with the text's length.
    """
    text = docs.select("doc_id", "text", F.xxhash64("text").alias("text_hash"), F.monotonically_increasing_id().alias("row"))
    text = text.withColumns({"c": F.regexp_extract_all("text", F.lit(CANDIDATE), F.lit(0)), "gap": F.split("text", CANDIDATE)}).filter("size(c) > 0").drop("text")
    found = text.select("doc_id", "text_hash", "row", "gap", "c", F.posexplode("c").alias("i", "candidate"))
    at = lambda name, shift: F.get(name, F.col("i") + shift)
    found = found.select(
        "doc_id", "text_hash", "row", "i", "candidate", F.length(at("gap", 0)).alias("before"),
        F.right(F.concat(F.coalesce(F.right(at("c", -1), F.lit(LEFT)), F.lit("")), F.right(at("gap", 0), F.lit(LEFT))), F.lit(LEFT)).alias("left"),
        F.left(F.concat(F.left(at("gap", 1), F.lit(RIGHT)), F.coalesce(F.left(at("c", 1), F.lit(RIGHT)), F.lit(""))), F.lit(RIGHT)).alias("right"),
    )
    upto = Window.partitionBy("row").orderBy("i")
    start = 1 + F.sum(F.col("before") + F.length("candidate")).over(upto) - F.length("candidate")
    return found.withColumn("start", start).select("doc_id", "text_hash", "candidate", "start", "left", "right")


def _grams(text: str) -> Column:
    """All four-letter pieces, in lower case."""
    return F.regexp_extract_all(F.lower(text), F.lit(r"(?s)(?=(.{4}))"), F.lit(1))


def corpus_dictionary(docs: DataFrame, words: int = DICTIONARY_WORDS) -> list[str]:
    """Four-letter pieces of the ``words`` commonest words of 4 to 12 letters a-z in all texts: 9 a word at most."""
    every = docs.select(F.explode(F.regexp_extract_all(F.lower("text"), F.lit(r"(?<![a-z])[a-z]{4,12}(?![a-z])"), F.lit(0))).alias("word"))
    top = every.groupBy("word").agg(F.count("*").alias("n")).orderBy(F.desc("n"), "word").limit(words)
    return [r.gram for r in top.select(F.explode(_grams("word")).alias("gram")).distinct().orderBy("gram").collect()]


def with_features(candidates: DataFrame, dictionary: list[str]) -> DataFrame:
    """Append the columns of :data:`FEATURES`, row by row."""
    c, left, right = F.col("candidate"), F.col("left"), F.col("right")
    size = F.length(c).cast("double")
    rows = candidates.withColumn("_all", _grams("candidate"))
    rows = StopWordsRemover(inputCol="_all", outputCol="_new", stopWords=dictionary, caseSensitive=True).transform(rows)
    return rows.withColumns({
        "length": size,
        "transitions": (_count("[a-z]+|[A-Z]+|[0-9]+|[^a-zA-Z0-9]+", c) - 1) / size,
        "runs": _count(r"(.)\1", c) / size,
        "digits": _count("[0-9]", c) / size,
        "capitals": _count("[A-Z]", c) / size,
        "hexadecimal": _count("[0-9a-fA-F]", c) / size,
        "signs": _count("[^a-zA-Z0-9]", c) / size,
        "vowels": _count("[aeiouAEIOU]", c) / size,
        "coverage": F.when(F.size("_all") > 0, (F.size("_all") - F.size("_new")) / F.size("_all")).otherwise(0.0),
        "slashes": _count("/", c),
        "after_path": left.rlike(r"[/.~:\\]$").cast("double"),
        "before_extension": right.rlike(r"^\.[A-Za-z0-9]{1,5}\b").cast("double"),
        "keyword": left.rlike(rf"(?i)(?:{KEYWORDS})[^\n]{{0,16}}(?:[:=][ \t]*[|>]?-?\s*)?[\"'`]?$").cast("double"),
        "assigned": left.rlike(r"[:=]\s*(?:[a-zA-Z]{1,12} )?[\"'`]?$").cast("double"),
        "quoted": (left.rlike(r"[\"'`]$") & right.rlike(r"^[\"'`]")).cast("double"),
        "left_letters": F.length(F.regexp_extract(left, r"(\p{L}*)[^\p{L}]*$", 1)).cast("double"),
        "right_letters": F.length(F.regexp_extract(right, r"^[^\p{L}]*(\p{L}*)", 1)).cast("double"),
        **{name: form.cast("double") for name, form in _forms().items()},
        "dots": _count(r"\.", c),
    }).drop("_all", "_new")


def _forms() -> dict[str, Column]:
    """Signs of a secret in a candidate's own form and place."""
    left, right = F.col("left"), F.col("right")
    return {
        "in_block": left.rlike("PRIVATE KEY-----$") & right.startswith("-----END"),
        "in_url": left.rlike(r"://[^\s/:@]{1,64}:$") & right.startswith("@"),
        "known_prefix": F.col("candidate").rlike(f"^(?:{PREFIXES})[A-Za-z0-9_-]{{12,}}"),
    }


def form_findings(spark: SparkSession) -> DataFrame:
    """Findings of forms that a corpus may hold too seldom to learn from: ``candidate, left, right, label``.

    ``FORM_FINDINGS`` for each form, with values from hashes as secrets, and with words
    and placeholders, and hashes in other places, as what only looks alike.
    """
    i = F.col("id")
    digest = lambda salt: F.base64(F.unhex(F.sha2(F.concat(F.lit(salt), i.cast("string")), 256)))
    token = lambda salt: F.translate(digest(salt), "+/=", "xY")
    cut = lambda text, least, spread: F.left(text, (least + i % spread).cast("int"))
    some = lambda *values: F.get(F.array(*(F.lit(v) if isinstance(v, str) else v for v in values)), (i % len(values)).cast("int"))
    short = F.concat(cut(token("short"), 5, 9), some("7", "!4", "x9", "2$"), some("a", "Q8", "k"))
    jwt = F.concat(F.lit("eyJ"), token("a"), F.lit(".eyJ"), token("b"), cut(token("c"), 4, 30), F.lit("."), token("d"))
    words = some("changeme", "password", "placeholder", "required", "disabled", "none-given", "your-password", "username")
    url, at = some("postgres://app:", "https://admin:", "see amqp://guest:", "mysql://root_user:"), some("@db.local:5432/x", "@host/", "@10.0.0.1 ")
    named = some('password = "', "api_key = '", "passwd: ", 'SECRET="', "auth_token=", "db_password:\n  ", 'token": "')
    after = some('" and', "' end", "\n", '"', " ", "\n", '"}')
    beside = some("Authorization: Bearer ", "the value ", "cookie session=", "", "use: ")
    forms = [
        (F.concat(F.lit("\n"), digest("a"), digest("b"), F.lit("\n"), digest("c"), F.lit("\n")), F.lit("-----BEGIN RSA PRIVATE KEY-----"), F.lit("-----END RSA PRIVATE KEY-----"), 1),
        (jwt, beside, some(" ", "\n", '"'), 1),
        (F.concat(some("ghp_", "sk_live_", "glpat-", "AKIA", "npm_", "xoxb-"), cut(token("a"), 20, 20)), beside, some(" ", ",", "\n"), 1),
        (short, url, at, 1),
        (short, named, after, 1),
        (cut(token("a"), 18, 24), named, after, 1),
        (words, url, at, 0),
        (words, named, after, 0),
        (F.concat(words, F.lit("internalpackage.organisationname."), words, F.lit("implementation")), beside, some(" ", "\n"), 0),
        (F.concat(digest("a"), F.left(digest("b"), F.lit(20))), F.lit("-----BEGIN PUBLIC KEY-----\n"), F.lit("\n-----END PUBLIC KEY-----"), 0),
        (cut(token("a"), 18, 24), some("checksum ", "sha1:", "commit ", "see /objects/", "id="), some(" ", ".bin", "\n"), 0),
    ]
    rows = F.array(*(F.struct(c.alias("candidate"), left.alias("left"), right.alias("right"), F.lit(float(y)).alias("label")) for c, left, right, y in forms))
    return spark.range(FORM_FINDINGS).select(F.explode(rows).alias("f")).select("f.*")


def label_by_assignment(candidates: DataFrame) -> DataFrame:
    """Labels for want of reviewed findings: ``candidate, left, right, label``.

    Two kinds of evidence that don't depend on each other must agree on a 1: a name of
    a secret is given the value (``name = "v"``, ``name: v``, ``name=v``, ``"name": "v"``,
    ``Authorization: Bearer v``), and the value looks drawn at random, having ten
    different characters (six, if it is shorter than 16), letters among them, and digits
    in two places (one). So is a 1 what stands in a private key's block, or is drawn and
    is a password in a URL or begins like a service's token. All else is 0: words and numbers beside such a name, and random values, as checksums, beside
    others. At most ``MAX_FINDINGS`` findings of each label are used, picked by a hash
    of the finding.
    """
    named = F.col("left").rlike(rf"(?i)(?:{KEYWORDS})[a-z0-9_-]{{0,12}}[\"']?\s*(?:[:=]\s*(?:bearer |basic |token )?|[\"'])[\"'`]?$")
    size = F.length("candidate")
    different = F.size(F.array_distinct(F.split("candidate", "")))
    random = (F.regexp_count("candidate", F.lit("[0-9]+")) >= F.when(size < 16, 1).otherwise(2)) & (different >= F.when(size < 16, 6).otherwise(10))
    random = random & F.col("candidate").rlike("[A-Za-z]") & ~F.col("candidate").rlike("(?i)example|changeme|placeholder")
    forms = _forms()
    secret = forms["in_block"] | random & (named | forms["in_url"] | forms["known_prefix"])
    rows = candidates.select("candidate", "left", "right", secret.cast("double").alias("label")).distinct()
    rows = rows.withColumn("pick", F.xxhash64("candidate", "left", "right"))
    # Only hashes go to the driver: candidates may be long.
    last = [rows.filter(F.col("label") == x).select("pick").orderBy("pick").limit(MAX_FINDINGS).agg(F.max("pick").alias("last")).withColumn("label", F.lit(x)) for x in (0.0, 1.0)]
    return rows.join(F.broadcast(last[0].union(last[1])), "label").filter("pick <= last").select("candidate", "left", "right", "label")


def train_forest(labelled: DataFrame, trees: int = 30, depth: int = 6, seed: int = 7) -> RandomForestClassificationModel | None:
    """A forest on rows with :data:`FEATURES`, ``label`` and ``weight``; None unless both labels are there.

    It is written to the shared folder and read back: a fitted model holds its training
    summary, and with it the session, which can't go to executors once the session has
    observations.
    """
    rows = VectorAssembler(inputCols=FEATURES, outputCol="features").transform(labelled).select("features", "label", "weight")
    rows = rows.repartition(4, F.xxhash64("features")).sortWithinPartitions(F.xxhash64("features"))
    if labelled.select("label").distinct().count() < 2:
        return None
    path = shared_dir(labelled.sparkSession)
    RandomForestClassifier(weightCol="weight", numTrees=trees, maxDepth=depth, seed=seed, featureSubsetStrategy="sqrt").fit(rows).save(path)
    return RandomForestClassificationModel.load(path)


def _scored(docs: DataFrame, findings: DataFrame | None, threshold: float) -> DataFrame:
    docs = docs.select("doc_id", F.col("text").cast("string").alias("text"))
    candidates = materialize(find_candidates(docs))
    dictionary = corpus_dictionary(docs)
    labelled = label_by_assignment(candidates) if findings is None else findings.select("candidate", "left", "right", F.col("label").cast("double"))
    labelled = labelled.filter("label IN (0, 1)").withColumn("weight", F.lit(1.0))
    if findings is None:  # forms weigh as much as the corpus, however large that is
        forms = form_findings(docs.sparkSession)
        total = labelled.agg((F.count("*") / forms.count()).alias("weight"))
        labelled = labelled.unionByName(forms.crossJoin(F.broadcast(total.select(F.greatest("weight", F.lit(1.0)).alias("weight")))))
    labelled = materialize(with_features(labelled, dictionary))
    model, featured = train_forest(labelled), with_features(candidates, dictionary)
    if model is None:
        only = labelled.agg(F.coalesce(F.max("label"), F.lit(0.0))).first()[0]
        scored = featured.withColumn("probability", F.lit(float(only)))
    else:
        scored = model.transform(VectorAssembler(inputCols=FEATURES, outputCol="features").transform(featured))
        scored = scored.withColumn("probability", vector_to_array("probability")[1])
    return scored.select("doc_id", "text_hash", "candidate", F.col("start").cast("long").alias("start"), "probability", (F.col("probability") >= threshold).alias("is_secret"))


def scan_secrets(docs: DataFrame, findings: DataFrame | None = None, threshold: float = 0.5) -> DataFrame:
    """All candidates in ``docs(doc_id, text)`` with the forest's verdict.

    Returns ``doc_id, candidate, start, probability, is_secret``, a row for each place
    of each candidate in each row of ``docs``; other columns are ignored. ``findings``
    are labelled ones (``candidate, left, right, label`` 0 or 1; null labels are left
    out); without them :func:`label_by_assignment` labels a bounded number. If all
    labels are alike, that label decides. Null and empty texts have no candidates; a
    null doc_id is kept; repeated rows are repeated; an empty table gives no rows.
    """
    return _scored(docs, findings, threshold).drop("text_hash")


def redact_secrets(docs: DataFrame, findings: DataFrame | None = None, threshold: float = 0.5) -> DataFrame:
    """``docs`` with every secret in ``text`` replaced by ``<secret>``; no row goes.

    What is a secret in one place of a text is replaced in all of it. Texts are matched
    by their hash, so rows without a doc_id and repeated rows are treated alike. An
    integer column ``n_chars`` is counted anew where the text changed.
    """
    found = _scored(docs, findings, threshold).filter("is_secret")
    # Longest first, so that a secret within another one doesn't spoil it.
    by_text = found.groupBy("text_hash").agg(F.reverse(F.array_sort(F.collect_set(F.struct(F.length("candidate").alias("n"), "candidate")))).alias("_secrets"))
    by_text = materialize(by_text.withColumnRenamed("text_hash", "_hash"))
    few = by_text.agg(F.sum(F.aggregate("_secrets", F.lit(64), lambda a, x: a + x["n"] + 32))).first()[0] or 0
    out = docs.join(F.broadcast(by_text) if few <= BROADCAST_BYTES else by_text, F.xxhash64(F.col("text").cast("string")) == F.col("_hash"), "left")
    none = F.expr("cast(array() as array<struct<n:int,candidate:string>>)")
    text = F.aggregate(F.coalesce("_secrets", none), F.col("text"), lambda t, s: F.replace(t, s["candidate"], F.lit(REDACTED)))
    out = out.withColumn("text", text)
    if "n_chars" in docs.columns:
        kind = docs.schema["n_chars"].dataType
        out = out.withColumn("n_chars", F.when(F.col("_secrets").isNotNull(), F.length("text").cast(kind)).otherwise(F.col("n_chars")))
    return out.select(docs.columns)
