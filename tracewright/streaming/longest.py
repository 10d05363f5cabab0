"""Streaming form of session dedup: the longest record of a session so far."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle


class _Longest(StatefulProcessor):
    def init(self, handle: StatefulProcessorHandle) -> None:
        self.best = handle.getValueState("best", "n bigint")

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timers) -> Iterator[pd.DataFrame]:
        best = self.best.get()[0] if self.best.exists() else -1
        out = []
        for part in rows:
            for r in part.sort_values("ord").itertuples():
                if r.n_messages > best:
                    best = r.n_messages
                    out.append((r.session_id, r.ord, r.n_messages))
        if out:
            self.best.update((best,))
        yield pd.DataFrame(out, columns=["session_id", "ord", "n_messages"])

    def close(self) -> None:
        pass


def longest_so_far(stream: DataFrame) -> DataFrame:
    """Rows (session_id, ord, n_messages) that are longer than every earlier one of their session. State: one number a session."""
    slim = stream.select("session_id", "ord", "n_messages")
    return slim.groupBy("session_id").transformWithStateInPandas(_Longest(), "session_id string, ord bigint, n_messages bigint", "append", "none")


def keep_longest(stream: DataFrame, target: str, checkpoint: str):
    """A query that keeps in target, for each session, the longest record so far: every batch is merged with what is there.

    Versions are folders; the newest complete one is current. Needs no state store, only the previous result.
    """
    spark = stream.sparkSession

    def fold(batch: DataFrame, epoch: int) -> None:
        from pyspark.sql import functions as F

        rows = batch.select("session_id", "ord", "n_messages")
        old = current(spark, target, epoch)
        both = rows if old is None else old.unionByName(rows)
        best = both.groupBy("session_id").agg(F.max_by(F.struct("ord", "n_messages"), F.struct("n_messages", -F.col("ord"))).alias("b"))
        best.select("session_id", "b.ord", "b.n_messages").write.mode("overwrite").parquet(f"{target}/v{epoch:010d}")

    return stream.writeStream.foreachBatch(fold).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def current(spark: SparkSession, target: str, before: int | None = None) -> DataFrame | None:
    """The newest complete version (older than before, where given)."""
    fs_path = spark._jvm.org.apache.hadoop.fs.Path(target)
    fs = fs_path.getFileSystem(spark._jsc.hadoopConfiguration())
    if not fs.exists(fs_path):
        return None
    names = sorted(s.getPath().getName() for s in fs.listStatus(fs_path) if fs.exists(spark._jvm.org.apache.hadoop.fs.Path(s.getPath(), "_SUCCESS")))
    names = [n for n in names if before is None or int(n[1:]) < before]
    return spark.read.parquet(f"{target}/{names[-1]}") if names else None
