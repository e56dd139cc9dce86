"""From raw documents to packed training sequences, in five stages.

Each stage takes ``(spark, docs, sf_dir)`` and returns a DataFrame; it is
written as Parquet, and the next stage reads it back.  All but the last return
the columns of ``documents``.

1. toxicity: documents that score 0.7 or more go.
2. line dedup: lines that eight sources or more share are cut out of the texts.
3. n-gram Jaccard join: of each group of near copies the document of the smallest id stays.
4. secret scan: secrets are replaced by a mark.
5. packing: the remaining texts as token pieces in sequences.

Every stage works on the whole of what the one before has kept.  Empty tables
pass through.  Documents that lose all their lines stay, as empty texts.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from paylater.llm import documents, line_dedup, ngram_join, packing, secret_scan, toxicity
from paylater.llm.tables import delete, tracked, written
from paylater.llm.vocabulary import public_path


def _with_length(docs: DataFrame) -> DataFrame:
    """``n_chars`` after the text has changed, where the table has that column."""
    if "n_chars" not in docs.columns:
        return docs
    kind = docs.schema["n_chars"].dataType
    return docs.withColumn("n_chars", F.char_length("text").cast(kind))


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents below the toxicity threshold; each row is scored by its own whole text, learned from the training labels."""
    labels = documents.read(spark, sf_dir, "labels")
    scores = toxicity.score_rows(docs, toxicity.training_rows(labels))
    return (scores.where(F.col("score") < toxicity.THRESHOLD)
            .select(*[F.col(f"doc.`{c}`").alias(c) for c in docs.columns]))


def drop_boilerplate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the lines that many sources share."""
    cut = line_dedup.remove_boilerplate(docs)
    # the last column is the operator's; a table may have one of the same name
    named = cut.toDF(*docs.columns, "_line_counts") if "line_counts" in docs.columns else cut
    return _with_length(named.select(*docs.columns))


def keep_one_copy(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document of the smallest id of each group of near copies.

    Rows that repeat an id are one document here, and stay or go together; rows without an id stay.
    The ids of the copies grow with the corpus, so they are joined by a shuffle at every size.
    """
    groups = ngram_join.similar_components(docs)
    copies = groups.where("doc_id <> component_id").select("doc_id").distinct()
    return docs.join(copies.hint("merge"), "doc_id", "left_anti").select(*docs.columns)


def mask_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts with a mark in place of each secret."""
    return _with_length(secret_scan.redact(docs))


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token pieces with their places in sequences of at most 4096."""
    return packing.pack(docs, public_path("word_bpe_49k.json"))


STAGES = [
    ("toxicity", drop_toxic),
    ("line_dedup", drop_boilerplate),
    ("ngram_jaccard_join", keep_one_copy),
    ("secret_scan", mask_secrets),
    ("packing", pack_sequences),
]

# The toxicity model, the guess costs and the tokenizer are beyond SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages on ``documents``; what is between two stages lies in the shared folder.

    A stage's own tables, and the output of the stage before, are deleted when its output is written.
    """
    docs, before = documents.read(spark, sf_dir, "documents"), []
    for name, stage in STAGES[:-1]:
        with tracked() as paths:
            docs = written(stage(spark, docs, sf_dir), f"stage-{name}")
        delete(spark, before + paths[:-1])
        before = paths[-1:]
    return STAGES[-1][1](spark, docs, sf_dir)
