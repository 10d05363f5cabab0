"""Tables written once to the cluster's shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def new_path(spark: SparkSession, name: str) -> str:
    """A fresh path in spark.checkpoint.dir. Where that is unset: in a temporary folder if all runs on one machine, else in the
    warehouse, which executors share."""
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not root:
        alone = spark.sparkContext.master.split("[")[0] == "local"
        spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="tracewright-") if alone else spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + "/_scratch")
        root = spark.sparkContext.getCheckpointDir()
    return f"{root.rstrip('/')}/{name}-{uuid.uuid4().hex}"


def materialize(df: DataFrame, name: str) -> DataFrame:
    """df written as Parquet to the scratch folder and read back.

    A filter on a column that many steps built would be rewritten in terms of the first step's input and grow without
    bound; behind a written table it stays what it is, and no later plan parses the logs again.
    """
    path = new_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
