"""A training corpus from documents: quality, near-duplicates, benchmark passages, personal data, mixture.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame, which is written as Parquet and reread as the next one's
docs. All but the last return the columns of documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tracewright.llm import decontaminate, mixing, pii, quality_classifier, simhash
from tracewright.llm.common import materialize, table

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")


def keep_good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier accepts.

    Null and empty texts score as a text without words; repeated rows share a fate; null ids are judged like others. Without
    trusted labels every document stays. Of an empty table nothing is left.
    """
    model = quality_classifier.train(docs, table(spark, sf_dir, "labels"), quality_classifier.learnable())
    return quality_classifier.score(docs, model, list(COLUMNS)).where(F.col("score") >= quality_classifier.CUT).select(*COLUMNS)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates, that of the least id.

    Null and empty texts are copies of each other, and one of them stays. Of rows that repeat an id and text one stays. Rows
    without id stay in groups that no id is in. Of an empty table nothing is left.
    """
    return simhash.one_of_each(docs.select(*COLUMNS))


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no window of a benchmark item, whether the item has an id or not.

    Null and empty texts hold none and stay; repeated rows share a fate, null ids included. With an empty benchmark all stay.
    """
    return decontaminate.clean(docs.select(*COLUMNS), table(spark, sf_dir, "benchmark"))


def redact_private(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document, personal data replaced by its kind; n_chars is that of the new text.

    Null texts stay null, with null n_chars; repeated rows and null ids are kept.
    """
    return pii.redact(docs.select(*COLUMNS)).withColumn("n_chars", F.length("text").cast("long")).select(*COLUMNS)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """A row for each repetition that the mixture takes of a document, with repetitions and epoch (from 1).

    Rows that repeat both id and text take the repetitions of the most repeated of them. Null and empty texts have size 0 and
    cost nothing; null sources are a source. Of an empty table nothing is left.
    """
    one, two = decontaminate.row_names(F.col("doc_id"), F.col("text"))
    keyed = docs.select(*COLUMNS, one.alias("_row"), two.alias("_twin"))
    taken = mixing.mix(keyed, keep=("_row", "_twin")).groupBy("_row", "_twin").agg(F.max("repetitions").alias("repetitions"))
    taken = materialize(taken.where("repetitions > 0"), "taken")
    repeated = keyed.join(taken.hint("shuffle_hash"), ["_row", "_twin"])
    return repeated.select(*COLUMNS, "repetitions", F.explode(F.sequence(F.lit(1), F.col("repetitions").cast("int"))).alias("epoch"))


STAGES = [
    ("quality_classifier", keep_good),
    ("simhash_near_dedup", drop_near_duplicates),
    ("benchmark_decontamination", drop_contaminated),
    ("pii", redact_private),
    ("mixing", mix_sources),
]

#: The first stage is a trained model, so SQL cannot express the rows; the tests hold them against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
