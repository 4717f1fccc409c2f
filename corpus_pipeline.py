"""A corpus pipeline: stages that each work on what the stage before kept.

Every stage takes ``(spark, docs, sf_dir)`` and returns a DataFrame; all but the last
return the columns of ``docs``, whatever others it has besides those of ``documents``.
An empty table goes through as such. Rows with null or empty texts, with null ids, and
rows that repeat others are kept unless a stage says otherwise.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from cladeworks.llm.decontaminate import drop_contaminated
from cladeworks.llm.jaccard_join import drop_near_copies
from cladeworks.llm.pieces import Vocabulary, encode_pieces
from cladeworks.llm.queries import TOKENIZERS
from cladeworks.llm.secret_scan import redact_secrets
from cladeworks.llm.shared import materialize
from cladeworks.llm.toxicity import drop_toxic, learn_toxicity

#: Whole documents may be long: batches between Spark and Python hold few of them.
BATCH_ROWS = 1000


def _few_rows(spark: SparkSession) -> None:
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", BATCH_ROWS)


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the lexicon model doesn't call toxic; one without a text isn't."""
    _few_rows(spark)
    model = learn_toxicity(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return drop_toxic(docs, model)


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group that links by five-word shingles at 0.8 the smallest doc_id; null ids and texts link with nothing."""
    _few_rows(spark)
    return drop_near_copies(docs, k=5, percent=80)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without benchmark items; those without an id stay, as they can't be named."""
    _few_rows(spark)
    return drop_contaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, secrets in them replaced, also in those without an id."""
    return redact_secrets(docs)


def pieces(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with the piece ids of their texts and the scores of the four best segmentations; null texts have no ids."""
    _few_rows(spark)
    vocabulary = Vocabulary.load(f"{TOKENIZERS}/piece_bpe_32k.model")
    return encode_pieces(docs, vocabulary, nbest=4).select("doc_id", "lang", "source", "ids", "nbest_scores")


STAGES = [
    ("toxicity", toxicity),
    ("n-gram Jaccard join", near_copies),
    ("benchmark decontamination", decontamination),
    ("secret scans", secrets),
    ("SentencePiece encoding", pieces),
]

#: SQL can express neither the learned models nor the segmentation.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages in turn on ``documents``; what each keeps is written to the shared folder."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for _, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
