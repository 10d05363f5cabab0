"""Session dedup: the longest record of a session stays.

Everything rests on aggregates by session (and length), which are partial before any shuffle, and on joins back, whose
skew Spark splits: a session that holds a third of all records meets in no task. Order columns identify a record.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def _rank(length: str, order: list[str]) -> Column:
    return F.struct((-F.col(length)).alias("l"), *order)


def winners(df: DataFrame, session: str, length: str, order: list[str]) -> DataFrame:
    """df with winner: the longest of its session, of equals the first in order."""
    best = df.groupBy(F.col(session).alias("_session")).agg(F.min(_rank(length, order)).alias("_best"))
    out = df.join(best, F.col(session).eqNullSafe(F.col("_session")))
    return out.withColumn("winner", _rank(length, order) == F.col("_best")).drop("_session", "_best")


def dropped_in_order(df: DataFrame, session: str, length: str, order: list[str]) -> DataFrame:
    """df with dropped: an earlier record of the session is at least as long. A longer later one replaces silently.

    The first record of each session and length, and from these the first of at least that length, decide: the window
    runs over the distinct lengths of a session, not over its records.
    """
    first = df.groupBy(F.col(session).alias("_session"), F.col(length).alias("_length")).agg(F.min(F.struct(*order)).alias("_first"))
    longer = Window.partitionBy("_session").orderBy(F.col("_length").desc()).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    first = first.withColumn("_first", F.min("_first").over(longer))
    out = df.join(first, F.col(session).eqNullSafe(F.col("_session")) & F.col(length).eqNullSafe(F.col("_length")))
    return out.withColumn("dropped", F.col(length).isNotNull() & (F.col("_first") < F.struct(*order))).drop("_session", "_length", "_first")


def demoted(df: DataFrame, session: str, length: str, order: list[str]) -> DataFrame:
    """df with winner, and the reason session_id_duplicate added to every record that is none. Null sessions never clash."""
    out = winners(df, session, length, order).withColumn("winner", F.col("winner") | F.col(session).isNull())
    return out.withColumn("reasons", F.when(F.col("winner"), F.col("reasons")).otherwise(F.array_append("reasons", "session_id_duplicate")))


def stats(df: DataFrame, session: str) -> DataFrame:
    """One row: unique_sessions, duplicate_groups, would_collapse."""
    sizes = df.where(F.col(session).isNotNull()).groupBy(session).agg(F.count("*").alias("n"))
    return sizes.agg(F.count("*").alias("unique_sessions"), F.count_if(F.col("n") > 1).alias("duplicate_groups"), F.coalesce(F.sum(F.col("n") - 1), F.lit(0)).alias("would_collapse"))


def first_by_key(values: Column, key) -> Column:
    """Elements of an array whose key no earlier element has."""
    keyed = F.transform(values, lambda x, i: F.struct(key(x).alias("k"), i.alias("i"), x.alias("x")))
    firsts = F.transform(keyed, lambda e: e["k"])
    return F.transform(F.filter(keyed, lambda e: F.array_position(firsts, e["k"]) == e["i"] + 1), lambda e: e["x"])
