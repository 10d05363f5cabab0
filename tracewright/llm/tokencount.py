"""Token counts from an exact length histogram.

Documents are encoded whole; only their lengths are aggregated. Suffix sums over the histogram (in two levels, so that
no task orders more than WIDTH lengths) answer totals, quantiles and totals after truncation for every context limit.
"""

from __future__ import annotations

import base64

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import map_texts, materialize

VOCABULARY = "/opt/tokenizers/byte_bpe_50k.tiktoken"
PATTERN = r"'(?:[sdmt]|ll|ve|re)| ?\p{L}++| ?\p{N}++| ?[^\s\p{L}\p{N}]++|\s++$|\s+(?!\S)|\s"
WIDTH = 1024
_ENCODERS: dict = {}


def encoder(path: str = VOCABULARY):
    """The byte-level BPE of a rank file; made once a process."""
    if path not in _ENCODERS:
        import tiktoken

        with open(path, "rb") as f:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        _ENCODERS[path] = tiktoken.Encoding("ranks", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})
    return _ENCODERS[path]


def token_lengths(docs: DataFrame, path: str = VOCABULARY) -> DataFrame:
    """doc_id, n_tokens for every row of docs (doc_id, text); null and empty texts have 0 tokens."""

    def make():
        encode = encoder(path).encode_ordinary
        return lambda texts: [np.array([len(encode(t)) if t else 0 for t in texts], dtype=np.int64)]

    return map_texts(docs, ["doc_id"], make, "n_tokens long")


def length_histogram(lengths: DataFrame) -> DataFrame:
    """One row for each length that occurs: n_tokens, n_docs; docs_longer and tokens_longer (of longer documents), truncated_total
    (all tokens if each document is cut at n_tokens), quantile (share of documents of at most n_tokens).

    For a limit L between two rows, the total after truncation is truncated_total of the lower row plus (L - n_tokens) *
    docs_longer of that row. An empty table gives an empty result.
    """
    # written, a row a length, as it is read twice and documents are to be encoded once
    h = materialize(lengths.groupBy("n_tokens").agg(F.count("*").alias("n_docs")), "histogram").withColumn("_b", F.floor(F.col("n_tokens") / WIDTH))
    after = Window.orderBy(F.col("_b").desc()).rowsBetween(Window.unboundedPreceding, -1)
    zero = F.lit(0).cast("long")
    blocks = h.groupBy("_b").agg(F.sum("n_docs").alias("_d"), F.sum(F.col("n_docs") * F.col("n_tokens")).alias("_t"))
    blocks = blocks.select("_b", F.coalesce(F.sum("_d").over(after), zero).alias("_docs_after"), F.coalesce(F.sum("_t").over(after), zero).alias("_tokens_after"), F.sum("_d").over(Window.partitionBy()).alias("_all"), F.sum("_t").over(Window.partitionBy()).alias("_every"))
    inside = Window.partitionBy("_b").orderBy(F.col("n_tokens").desc()).rowsBetween(Window.unboundedPreceding, -1)
    out = h.join(blocks, "_b")
    out = out.withColumn("docs_longer", F.col("_docs_after") + F.coalesce(F.sum("n_docs").over(inside), zero))
    out = out.withColumn("tokens_longer", F.col("_tokens_after") + F.coalesce(F.sum(F.col("n_docs") * F.col("n_tokens")).over(inside), zero))
    return out.select("n_tokens", "n_docs", "docs_longer", "tokens_longer", (F.col("_every") - F.col("tokens_longer") + F.col("docs_longer") * F.col("n_tokens")).alias("truncated_total"), (1 - F.col("docs_longer") / F.col("_all")).alias("quantile"))
