"""A training-corpus pipeline: each stage filters or rewrites what the stage before it kept.

Every stage takes (spark, docs, sf_dir) and returns a DataFrame; all but the last return the columns of
``documents``. Outside (and in ``run``) each result is written as Parquet and read again as the next stage's docs.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lexweave.llm import langid, packing, pii, simhash_similar, toxicity
from lexweave.llm.common import cut
from lexweave.llm.queries import remainder

#: Fitting and scoring can't be said in SQL; the tests hold ``run`` against a brute-force version.
ORACLE_SQL = None


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a toxicity score of at least ``toxicity.THRESHOLD`` go."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    model = toxicity.train(docs, labels.where(remainder("doc_id", 3) != 1))
    return docs.where(toxicity.score_column(docs, model) < toxicity.THRESHOLD)


def drop_unknown_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a letter or too far from every language's centroids go; ``lang`` stays as given."""
    model = langid.train(docs.where(F.coalesce(remainder("doc_id", 4) != 2, F.lit(True))))
    return docs.where(~langid.classify_column(docs, model)["rejected"])


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents that share four fifths of their five-word shingles the one with the least id stays."""
    return simhash_similar.keep_one(docs)


def mask_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data in texts is replaced by its kind's mark; ``n_chars`` follows."""
    # the row travels in one column, so that none of its names meets those of the operator
    found = pii.spans(docs.select(F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("_row"), "doc_id", "text"))
    text = pii.mask(F.col("text"), "spans")
    size = F.coalesce(F.char_length(text).cast("long"), F.lit(0))

    def column(c: str):
        own = text if c == "text" else size.cast(docs.schema[c].dataType) if c == "n_chars" else F.col("_row").getField(c)
        return own.alias(c)

    return found.select(*map(column, docs.columns))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents in sequences of at most 1024 tokens."""
    return packing.pack(docs)


STAGES = [
    ("toxicity", drop_toxic),
    ("language", drop_unknown_language),
    ("simhash", drop_near_copies),
    ("pii", mask_personal_data),
    ("packing", pack),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for i, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if i < len(STAGES) - 1:
            docs, _ = cut(docs)
    return docs
