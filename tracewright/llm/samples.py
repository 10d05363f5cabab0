"""Bounded samples of rows for fitting models."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def bounded_sample(rows: DataFrame, key: Column, limit: int, seed: int = 11) -> DataFrame:
    """The limit rows whose keys hash lowest (all if there are no more); the same rows on every run.

    Only keys are read to find the hash that bounds the sample; texts are read in the second pass, of chosen rows alone.
    Rows that share a key share a fate, so repeats of a chosen key may add to limit; callers reduce them to one.
    """
    h = F.xxhash64(F.lit(seed), key)
    last = rows.select(h.alias("h")).orderBy("h").limit(limit).agg(F.max("h")).first()[0]
    return rows.where(h <= (F.lit(last) if last is not None else F.lit(-(1 << 63))))


def one_text_each(docs: DataFrame, chosen: DataFrame) -> DataFrame:
    """chosen (a bounded sample of one row for each doc_id) with the text of that id, of several the least; ids without text fall out.

    The sample is all that is broadcast and no text is shuffled to find its rows; repeats of an id are reduced to one before they meet.
    """
    texts = docs.select("doc_id", "text").where("text is not null and doc_id is not null")
    return texts.join(F.broadcast(chosen), "doc_id").groupBy(*chosen.columns).agg(F.min("text").alias("text"))


def sampled_texts(docs: DataFrame, limit: int, seed: int = 11) -> DataFrame:
    """doc_id, text of limit ids at most, one row each (of several the least text); the same on every run."""
    texts = docs.select("doc_id", "text").where("text is not null and doc_id is not null")
    return bounded_sample(texts, F.col("doc_id"), limit, seed).groupBy("doc_id").agg(F.min("text").alias("text"))


def shares(sizes: dict[str, int], limit: int) -> dict[str, int]:
    """Rows that each kind gives, limit in all: small kinds give all they have, the others alike."""
    out, left = {}, limit
    for k, name in enumerate(sorted(sizes, key=lambda x: (sizes[x], x))):
        out[name] = min(sizes[name], max(1, left // (len(sizes) - k)))
        left -= out[name]
    return out


def bounded_sample_each(rows: DataFrame, key: Column, kind: str, limit: int, seed: int = 11) -> DataFrame:
    """As bounded_sample, but limit is shared out over the values of kind (the limit most frequent, if there are more)."""
    h = F.xxhash64(F.lit(seed), key)
    sizes = {r[0]: r[1] for r in rows.groupBy(kind).count().orderBy(F.desc("count"), kind).limit(limit).collect()}
    if not sizes:
        return rows.limit(0)
    # hashes are even, so the lowest are sought among about twice as many as are wanted
    bound = lambda k, n: (1 << 63) - 1 if 2 * k + 100 >= n else -(1 << 63) + (1 << 64) * (2 * k + 100) // n
    wanted = rows.sparkSession.createDataFrame([(x, k, bound(k, sizes[x])) for x, k in shares(sizes, limit).items()], f"{kind} string, _wanted int, _bound long")
    near = rows.select(kind, h.alias("_h")).join(F.broadcast(wanted), kind).where("_h <= _bound")
    last = near.groupBy(kind).agg(F.array_sort(F.collect_list("_h")).alias("_a"), F.max("_wanted").alias("_wanted"))
    last = last.select(kind, F.element_at("_a", F.least("_wanted", F.size("_a"))).alias("_last"))
    last = rows.sparkSession.createDataFrame(last.collect(), f"{kind} string, _last long")
    return rows.join(F.broadcast(last), kind).where(h <= F.col("_last")).select(rows.columns)
