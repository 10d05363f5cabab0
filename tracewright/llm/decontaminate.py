"""Benchmark decontamination by winnowing, with DataFrame functions only.

An item's windows are its runs of SPAN consecutive words. Every run of SPAN words has SPAN - GRAM + 1 hashed GRAM-word
grams; the least of them is its fingerprint, so a shared run of SPAN words always shares one. Runs of neighbouring
windows that share their fingerprint are joined once, at the first of them (and every SPAN - GRAM + 1 windows, the
longest that one gram can serve), then extended over the windows that follow it, where whole windows are compared word for word.
Items of fewer words are one window each, sought at the places of their first words. The join's side is small (fingerprints
of items) or shuffled, as Spark finds from its size on disk; it is never forced.
"""

from __future__ import annotations

import uuid
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import WORD_GAP, ascii_lower, materialize

SPAN, GRAM = 10, 5


def words_of(text: Column) -> Column:
    """The words of a text, in order: runs of digits, letters and characters beyond ASCII, A-Z lower-cased."""
    return F.filter(F.split(ascii_lower(F.coalesce(text, F.lit(""))), WORD_GAP), lambda w: w != "")


def _shifted(values: str, by: int, of: int) -> Column:
    """The array without its first by values, cut to the length that of values in a row leave."""
    return F.slice(values, by + 1, F.greatest(F.size(values) - (of - 1), F.lit(0)))


def _paired(df: DataFrame, name: str, by: int, values: str, merge) -> DataFrame:
    """name: merge of each value with the one by places on."""
    return df.withColumn(name, F.zip_with(_shifted(values, 0, by + 1), _shifted(values, by, by + 1), merge))


def _hashed(df: DataFrame, grams: int) -> DataFrame:
    """_g: hashes of runs of grams words, built from single words so that each is hashed once."""
    df = df.withColumn("_g", F.transform("_w", lambda w: F.xxhash64(w)))
    have = 1
    while have < grams:
        by = min(have, grams - have)
        df = _paired(df, "_g", by, "_g", lambda a, b: F.xxhash64(a, b))
        have += by
    return df


def _least(df: DataFrame, window: int) -> DataFrame:
    """_m: the least of each window of _g."""
    df, have = df.withColumn("_m", F.col("_g")), 1
    while have < window:
        by = min(have, window - have)
        df = _paired(df, "_m", by, "_m", lambda a, b: F.least(a, b))
        have += by
    return df


def _settled(df: DataFrame, *names: str) -> DataFrame:
    """df with the named columns computed once a row: generated code would otherwise put them off into explode's loop."""
    rest = [c for c in df.columns if c not in names]
    return df.select(*rest, F.explode(F.array(F.struct(*names))).alias("_s")).select(*rest, *(F.col("_s")[n].alias(n) for n in names))


def _windows(items: DataFrame, span: int, gram: int) -> DataFrame:
    """item_id, length, h, f, window, w1, w2: every window of every item; f is the hash of its first word, w1 and w2 together name it."""
    base = items.select("item_id", words_of(F.col("text")).alias("_w")).where(F.size("_w") > 0)
    full = _settled(_least(_hashed(base.where(F.size("_w") >= span), gram), span - gram + 1).select("item_id", "_w", "_m"), "_w", "_m")
    full = full.select("item_id", "_w", F.posexplode("_m").alias("p", "h"))
    full = full.select("item_id", F.lit(span).alias("length"), "h", F.lit(None).cast("long").alias("f"), F.array_join(F.slice("_w", F.col("p") + 1, span), " ").alias("window"))
    short = base.where(F.size("_w") < span).select("item_id", F.size("_w").alias("length"), F.array_join("_w", " ").alias("window"), F.xxhash64(F.get("_w", F.lit(0))).alias("f"))
    short = short.select("item_id", "length", F.xxhash64("window").alias("h"), "f", "window")
    return full.unionByName(short).distinct().withColumns({"w1": F.xxhash64("window"), "w2": F.xxhash64(F.lit(7), "window")})


def row_names(doc_id: Column, text: Column) -> tuple[Column, Column]:
    """Two hashes that together name a row by its id and text."""
    return F.xxhash64(doc_id, text), F.xxhash64(F.lit(7), text, doc_id)


def _long_hits(texts: DataFrame, sought: DataFrame, span: int, gram: int) -> DataFrame:
    many = span - gram + 1
    grams = _least(_hashed(texts.where(F.size("_w") >= span), gram), many)
    runs = _settled(grams.select("_r1", "_r2", "_w", "_m"), "_w", "_m")
    runs = runs.select("_r1", "_r2", "_w", "_m", F.posexplode("_m").alias("p", "h"))
    runs = runs.where((F.col("p") % many == 0) | (F.element_at("_m", F.greatest(F.col("p"), F.lit(1))) != F.col("h")))
    runs = runs.select("_r1", "_r2", "h", "p", F.slice("_m", F.col("p") + 1, many).alias("_m"), F.slice("_w", F.col("p") + 1, span + many - 1).alias("_w"))
    near = runs.join(sought.select("h").distinct(), "h", "left_semi")
    near = near.select("_r1", "_r2", "h", "p", "_w", F.posexplode("_m").alias("q", "_h")).where(F.col("_h") == F.col("h"))
    near = near.select("_r1", "_r2", "h", (F.col("p") + F.col("q")).alias("p"), F.lit(span).alias("length"), F.array_join(F.slice("_w", F.col("q") + 1, span), " ").alias("window"))
    return near.join(sought.select("h", "window", "w1", "w2"), ["h", "window"])


def _short_hits(texts: DataFrame, sought: DataFrame, lengths: list[int]) -> DataFrame:
    """One pass over the words, whatever the lengths: only places of a window's first word are compared."""
    most = max(lengths)
    words = _settled(texts.where(F.size("_w") > 0).select("_r1", "_r2", "_w", F.transform("_w", lambda w: F.xxhash64(w)).alias("_f")), "_w", "_f")
    places = words.select("_r1", "_r2", "_w", F.posexplode("_f").alias("p", "f"))
    places = places.select("_r1", "_r2", "f", "p", F.slice("_w", F.col("p") + 1, most).alias("_w")).join(sought.select("f").distinct(), "f", "left_semi")
    near = places.select("_r1", "_r2", "p", "_w", F.explode(F.array(*map(F.lit, lengths))).alias("length")).where(F.size("_w") >= F.col("length"))
    near = near.select("_r1", "_r2", "p", "length", F.array_join(F.slice("_w", F.lit(1), F.col("length")), " ").alias("window")).withColumn("h", F.xxhash64("window"))
    return near.join(sought.select("h", "window", "w1", "w2"), ["h", "window"])


def _hits(docs: DataFrame, windows: DataFrame, span: int, gram: int) -> DataFrame | None:
    """_r1, _r2, p, e, w1, w2: words p to e of the row are the window. None if there is no window."""
    lengths = [r[0] for r in windows.select("length").distinct().orderBy("length").collect()]  # span values at most
    r1, r2 = row_names(F.col("doc_id"), F.col("text"))
    texts = docs.select(r1.alias("_r1"), r2.alias("_r2"), words_of(F.col("text")).alias("_w"))
    # a window of many items is sought once
    sought = windows.select("length", "h", "f", "window", "w1", "w2").distinct()
    parts = [_long_hits(texts, sought.where(F.col("length") == span), span, gram)] if span in lengths else []
    if short := [n for n in lengths if n < span]:
        parts.append(_short_hits(texts, sought.where(F.col("length") < span), short))
    return reduce(DataFrame.unionByName, [x.select("_r1", "_r2", "p", (F.col("p") + F.col("length")).alias("e"), "w1", "w2") for x in parts]) if parts else None


def contamination(docs: DataFrame, items: DataFrame, span: int = SPAN, gram: int = GRAM) -> DataFrame:
    """doc_id, n_words, n_hit, n_items, items_sha256, contaminated for every row of docs (columns doc_id, text).

    items: item_id, text. An item of fewer than span words, but not none, is one window; items without words match nothing.
    Windows of items without id count like any other; all such items together are one in n_items and none in items_sha256.
    Null texts have no words. Rows that repeat both doc_id and text get the same figures each; null ids are kept. Empty
    tables, of either kind, give a defined result: no rows, or no hits. Other columns are ignored.
    """
    r1, r2 = row_names(F.col("doc_id"), F.col("text"))
    counted = docs.select("doc_id", r1.alias("_r1"), r2.alias("_r2"), F.size(words_of(F.col("text"))).cast("long").alias("n_words"))
    windows = materialize(_windows(items, span, gram), "windows")
    found, none, zero = _hits(docs, windows, span, gram), F.sha2(F.lit(""), 256), F.lit(0).cast("long")
    if found is None:
        return counted.select("doc_id", "n_words", zero.alias("n_hit"), zero.alias("n_items"), none.alias("items_sha256"), F.lit(False).alias("contaminated"))
    found = materialize(found, "hits")
    covered = F.aggregate(
        F.array_sort("_spans"),
        F.struct(zero.alias("n"), F.lit(0).alias("end")),
        lambda s, x: F.struct((s["n"] + F.greatest(x["e"] - F.greatest(x["p"], s["end"]), F.lit(0))).alias("n"), F.greatest(s["end"], x["e"]).alias("end")),
        lambda s: s["n"],
    )
    spans = found.groupBy("_r1", "_r2").agg(F.collect_set(F.struct("p", "e")).alias("_spans")).select("_r1", "_r2", covered.alias("n_hit"))
    # items of a window are looked up once a row, however often it occurs there
    owners = found.select("_r1", "_r2", "w1", "w2").distinct().join(windows.select("w1", "w2", "item_id"), ["w1", "w2"])
    ids = F.array_sort(F.collect_set(F.col("item_id").cast("string")))
    unnamed = F.max(F.col("item_id").isNull().cast("long"))
    named = owners.groupBy("_r1", "_r2").agg(ids.alias("_ids"), unnamed.alias("_unnamed"))
    named = named.select("_r1", "_r2", (F.size("_ids") + F.col("_unnamed")).alias("n_items"), F.sha2(F.array_join("_ids", ","), 256).alias("items_sha256"))
    out = counted.join(spans.join(named, ["_r1", "_r2"]), ["_r1", "_r2"], "left")
    n = F.coalesce("n_hit", zero)
    return out.select("doc_id", "n_words", n.alias("n_hit"), F.coalesce("n_items", zero).alias("n_items"), F.coalesce("items_sha256", none).alias("items_sha256"), (n > 0).alias("contaminated"))


def clean(docs: DataFrame, items: DataFrame, span: int = SPAN, gram: int = GRAM) -> DataFrame:
    """The rows of docs, with all their columns, in which no window of an item occurs, whether the item has an id or not.

    Null and empty texts hold no window and stay; rows that repeat both id and text share a fate, null ids included. Of an
    empty table nothing is left, and without items with words everything. Columns may have any names.
    """
    found = _hits(docs, materialize(_windows(items, span, gram), "windows"), span, gram)
    if found is None:
        return docs
    mine = uuid.uuid4().hex
    hit = materialize(found.select(F.col("_r1").alias(f"_a{mine}"), F.col("_r2").alias(f"_b{mine}")).distinct(), "contaminated")
    r1, r2 = row_names(docs["doc_id"], docs["text"])
    return docs.join(hit, (r1 == hit[f"_a{mine}"]) & (r2 == hit[f"_b{mine}"]), "left_anti")
