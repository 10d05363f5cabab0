"""Mixing sources to target weights by capped water-filling.

Targets: sources share the total by weight; one above MAX_EPOCHS times its size is clamped there and what it leaves is
shared by weight among the rest, until none is above. As the clamped sources are those with the least capacity per
weight, one ordered pass over the sources (not the documents) finds the level. Sampling: floor(target / size) whole
repetitions of every document, and one more for the documents that a seeded order puts first, as long as they fit the
fraction that remains. FILLS rounds then fill the gap before the first document that is too large with later documents
that are not. The order's running sum is taken in hash ranges of each source, so that no source, however large, meets in
one task.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import SPACED, materialize

WEIGHTS, MAX_EPOCHS, SEED = (5, 2, 1), 3, "mix-1"
FILLS = 4


def water_fill(sizes: DataFrame, weights=WEIGHTS, max_epochs: int = MAX_EPOCHS) -> DataFrame:
    """sizes: source, source_size (one row a source). Adds weight and target (doubles)."""
    order = Window.orderBy(F.col("source").asc_nulls_last())
    w = F.element_at(F.array(*(F.lit(float(x)) for x in weights)), (F.row_number().over(order) - 1) % len(weights) + 1)
    ranked = sizes.withColumn("weight", w).withColumn("cap", F.col("source_size") * F.lit(float(max_epochs)))
    fill = Window.orderBy((F.col("cap") / F.col("weight")).asc(), F.col("source").asc_nulls_last())
    before = fill.rowsBetween(Window.unboundedPreceding, -1)
    after = fill.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    total = F.sum(F.col("source_size").cast("double")).over(Window.partitionBy())
    # the level if all sources before this one are clamped and this one and the rest are not
    level = (total - F.coalesce(F.sum("cap").over(before), F.lit(0.0))) / F.sum("weight").over(after)
    free = F.col("level") * F.col("weight") <= F.col("cap")
    leveled = ranked.withColumn("level", level).withColumn("_at", F.row_number().over(fill))
    leveled = leveled.withColumn("level", F.min(F.when(free, F.struct("_at", "level"))).over(Window.partitionBy())["level"])
    return leveled.select("source", "source_size", "weight", F.when(F.col("level").isNull(), F.col("cap")).otherwise(F.least("cap", F.col("level") * F.col("weight"))).alias("target"))


def mix(docs: DataFrame, weights=WEIGHTS, max_epochs: int = MAX_EPOCHS, seed: str = SEED, buckets: int = 1024, keep: tuple[str, ...] = ()) -> DataFrame:
    """doc_id, size, source_size, target, repetitions, taken for every row of docs (columns doc_id, text, source).

    size counts the words of the whole text (null or empty: 0). A null source is a source of its own, last in order.
    Documents are ordered by md5(seed:doc_id), then doc_id and size; a null doc_id counts as empty text. Repeated rows
    are documents of their own. A source whose words are all missing has target 0. An empty table gives an empty result.
    keep: further columns of docs to carry along.
    """
    h = F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit(""))).cast("binary"))
    size = F.coalesce(F.size(F.regexp_extract_all("text", F.lit(SPACED), F.lit(0))), F.lit(0)).cast("long")
    size = F.when(F.col("text").isNull(), F.lit(0).cast("long")).otherwise(size)
    sized = materialize(docs.select("doc_id", "source", size.alias("size"), h.alias("_h"), *(k for k in keep if k != "source")), "sizes")
    sizes = sized.groupBy("source").agg(F.sum("size").alias("source_size"))
    plan = water_fill(sizes, weights, max_epochs)
    whole = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0).cast("long")
    plan = materialize(plan.withColumn("_whole", whole).withColumn("_rest", F.col("target") - F.col("_whole") * F.col("source_size")), "targets")

    width = max(1, len(f"{buckets - 1:x}"))
    bucket = (F.conv(F.substring("_h", 1, width), 16, 10).cast("long") * buckets / 16**width).cast("int")
    left, extra, open_ = sized.withColumn("_b", bucket), None, plan.select(F.col("source").alias("_s"), F.col("_rest").alias("_gap"))
    columns = left.columns
    for _ in range(FILLS):
        fits = left.join(open_, F.col("source").eqNullSafe(F.col("_s"))).withColumn("_fits", F.col("size") <= F.col("_gap"))
        fits = fits.withColumn("_run", F.when(F.col("_fits"), F.col("size")).otherwise(0))
        offsets = fits.groupBy("source", "_b").agg(F.sum("_run").alias("_in"))
        offsets = offsets.select(F.col("source").alias("_o"), F.col("_b").alias("_ob"), (F.sum("_in").over(Window.partitionBy("source").orderBy("_b")) - F.col("_in")).alias("_offset"))
        run = F.sum("_run").over(Window.partitionBy("source", "_b").orderBy("_h", "doc_id", "size").rowsBetween(Window.unboundedPreceding, 0))
        placed = fits.withColumn("_run", run).join(offsets, F.col("source").eqNullSafe(F.col("_o")) & (F.col("_b") == F.col("_ob")))
        placed = materialize(placed.select(*columns, "_gap", (F.col("_fits") & (F.col("_offset") + F.col("_run") <= F.col("_gap"))).alias("_in")), "filled")
        taken = placed.where("_in").select(*columns)
        extra = taken if extra is None else extra.unionByName(taken)
        left = placed.where("not _in").select(*columns)
        gone = taken.groupBy("source").agg(F.sum("size").alias("_n"))
        open_ = open_.join(gone, F.col("source").eqNullSafe(F.col("_s")), "left").select("_s", (F.col("_gap") - F.coalesce("_n", F.lit(0))).alias("_gap"))
        open_ = materialize(open_, "gaps")
    placed = extra.withColumn("_once", F.lit(1)).unionByName(left.withColumn("_once", F.lit(0)))
    placed = placed.join(plan.withColumnRenamed("source", "_s"), F.col("source").eqNullSafe(F.col("_s")))
    reps = (F.col("_whole") + F.col("_once")).cast("long")
    out = placed.withColumn("repetitions", F.least(reps, F.lit(max_epochs).cast("long")))
    return out.select("doc_id", "size", "source_size", "target", "repetitions", (F.col("repetitions") * F.col("size")).alias("taken"), *keep)
