"""Validators that are not part of this package: a module with check(events: str) -> (route, error), found by name."""

from __future__ import annotations

from collections.abc import Iterator
from importlib.util import find_spec

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def available(name: str) -> bool:
    try:
        return find_spec(name) is not None
    except (ImportError, ValueError):
        return False


def by_module(df: DataFrame, name: str) -> DataFrame:
    """df (validated by the rule built in) with route and error as the module tells them, in Arrow batches."""

    @F.pandas_udf("route string, error string")
    def judged(parts: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        from importlib import import_module

        check = import_module(name).check
        for part in parts:
            yield pd.DataFrame([check(x) for x in part], columns=["route", "error"], dtype=object)

    told = judged(F.to_json(F.to_variant_object("events")))
    return df.withColumn("_told", told).withColumns({"route": F.col("_told.route"), "error": F.col("_told.error")}).drop("_told")
