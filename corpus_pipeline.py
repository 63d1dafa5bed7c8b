"""A corpus-cleaning pipeline: toxicity, near-duplicates, benchmark leaks, secrets, packing.

Every stage takes the documents that its predecessor kept and applies its operator
to all of them; all but the last return the columns of documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from padron.llm import hilbert_packing, oph_minhash, ordinal_toxicity, phrase_index, secret_automata
from padron.llm.common import discard, materialize, table

#: Jaccard similarity of word shingles, in percent, from which the near-duplicate stage links documents.
NEAR_PERCENT = 80


def _numbered(docs: DataFrame) -> tuple[DataFrame, str]:
    """docs written with one more column that numbers its rows, and the column's name: an id may be null or repeat."""
    name = "row_number"
    while name in docs.columns:
        name += "_"
    return materialize(docs.withColumn(name, F.monotonically_increasing_id())), name


def _columns(docs: DataFrame) -> list:
    return [F.col(f"`{c}`") for c in docs.columns]


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the severity model, learned from the labels of this input, does not reject.

    Null and empty texts stay; of an empty table nothing is left; equal rows are judged alike.
    """
    model = ordinal_toxicity.train(docs, table(spark, sf_dir, "labels"))
    return ordinal_toxicity.score(docs, model).where("not rejected").select(*_columns(docs))


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near-duplicates the document with the smallest id; a null id comes last.

    Rows are told apart by their place in the table, so that rows with equal or null ids count on their own:
    of a row that is there twice, one stays. Texts without words are nobody's copy and stay.
    """
    rows, number = _numbered(docs)
    groups = oph_minhash.near_duplicates(spark, rows.select(F.col(number).alias("doc_id"), "text"), NEAR_PERCENT).select(F.col("doc_id").alias("n"), "component_id")
    ids = rows.select(F.col(number).alias("n"), F.col("doc_id").alias("id"))
    first = groups.join(ids.hint("merge"), "n").groupBy("component_id").agg(F.min(F.struct(F.col("id").isNull(), "id", "n")).alias("first")).select(F.col("first.n").alias(number))
    return rows.join(first.hint("merge"), number, "left_semi").select(*_columns(docs))


def drop_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a benchmark window, row by row as in drop_near_copies; null and empty texts stay."""
    rows, number = _numbered(docs)
    hit = phrase_index.match(spark, rows.select(F.col(number).alias("doc_id"), "text"), table(spark, sf_dir, "benchmark")).where("contaminated").select(F.col("doc_id").alias(number))
    return rows.join(hit.hint("merge"), number, "left_anti").select(*_columns(docs))


def redact_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, every found credential replaced by a mark; null texts stay null."""
    return secret_automata.redact(docs, secret_automata.train(docs))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents, packed along the curve; null and empty texts are their end id alone."""
    return hilbert_packing.pack(spark, docs)


STAGES = [
    ("toxicity", drop_toxic),
    ("minhash", drop_near_copies),
    ("decontamination", drop_leaks),
    ("secrets", redact_secrets),
    ("packing", pack),
]

#: SQL can express neither the learned models nor the tokenizer.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents, each written as Parquet and read again by the next."""
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES[:-1]:
        before, docs = docs, materialize(stage(spark, docs, sf_dir))
        discard(before)
    return STAGES[-1][1](spark, docs, sf_dir)
