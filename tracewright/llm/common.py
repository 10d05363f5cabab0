"""Shared pieces of the corpus operators: scratch tables, Arrow mapping over whole texts, folds."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Rows and bytes of text that one Arrow batch holds at most; bounds a Python worker's memory.
BATCH_ROWS, BATCH_BYTES = 1000, 16 << 20

#: Java pattern of the words that white space separates.
SPACED = r"[^\x20\x09-\x0D]+"
#: Java patterns of the words made of digits, letters and everything beyond ASCII, and of what separates them.
WORD, WORD_GAP = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: Byte table: A-Z to lower case, ASCII that is no digit or letter to a space.
WORD_TABLE = bytes(c + 32 if 65 <= c <= 90 else c if c >= 128 or 48 <= c <= 57 or 97 <= c <= 122 else 32 for c in range(256))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def scratch_root(spark: SparkSession) -> str:
    """The shared folder the cluster names in spark.checkpoint.dir. Where that is unset, as in tests: a temporary folder if all runs on
    one machine, else one in the warehouse, which executors share."""
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not root:
        alone = spark.sparkContext.master.split("[")[0] == "local"
        spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="tracewright-") if alone else spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + "/_scratch")
        root = spark.sparkContext.getCheckpointDir()
    return root.rstrip("/")


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write df to the shared scratch folder and read it back: lineage is cut and a lost executor costs no recomputation.

    The path is in the attribute scratch_path, for drop_scratch().
    """
    path = f"{scratch_root(df.sparkSession)}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    out = df.sparkSession.read.schema(df.schema).parquet(path)
    out.scratch_path = path
    return out


def drop_scratch(df: DataFrame | None) -> None:
    """Delete a materialized table that no later plan reads."""
    path = getattr(df, "scratch_path", None)
    if path:
        spark = df.sparkSession
        p = spark._jvm.org.apache.hadoop.fs.Path(path)
        p.getFileSystem(spark._jsc.hadoopConfiguration()).delete(p, True)


def fold(doc_id: Column, parts: int) -> Column:
    """crc32 of the id as text, modulo parts; null for a null id."""
    return F.crc32(doc_id.cast("string").cast("binary")) % parts


def ascii_lower(text: Column) -> Column:
    """Lower-case A-Z only."""
    return F.translate(text, _UPPER, _LOWER)


def map_texts(df: DataFrame, carry: list[str], make: Callable[[], Callable], ddl: str, text: str = "text") -> DataFrame:
    """carry columns and the columns of ddl, which make()(list of texts) returns as lists or arrays in that order.

    A null text reaches the function as None. Runs on bounded Arrow batches; no shuffle. A text that is also carried goes
    to Python once.
    """
    spark = df.sparkSession
    # read when the query runs, which is after this returns
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))
    keys = [f"_k{i}" for i in range(len(carry))]
    at = carry.index(text) if text in carry else len(carry)
    source = df.select(*(F.col(f"`{c}`").alias(k) for c, k in zip(carry, keys)), *([F.col(f"`{text}`").alias("_text")] if at == len(carry) else []))
    types = [f"`{k}` {source.schema[k].dataType.simpleString()}" for k in keys]
    added = [x.split()[0] for x in ddl.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        work = make()
        for batch in batches:
            if batch.num_rows:
                out = work(batch.column(at).to_pylist())
                yield pa.RecordBatch.from_arrays([*batch.columns[: len(keys)], *(x if isinstance(x, pa.Array) else pa.array(x) for x in out)], names=[*keys, *added])

    return source.mapInArrow(run, ", ".join([*types, ddl])).withColumnsRenamed(dict(zip(keys, carry)))
