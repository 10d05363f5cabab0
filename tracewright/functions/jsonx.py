"""Type-guarded access to JSON held in VARIANT columns.

Casting a VARIANT turns numbers into text and the like, so types are tested first: containers by a shallow cast, which fails
for all else and leaves their members unread, scalars by their schema. Columns are built from few copies of their arguments; plans put what is used often into columns of its own.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F


def configure(spark: SparkSession) -> SparkSession:
    """Repeated keys: the last wins."""
    spark.conf.set("spark.sql.variant.allowDuplicateKeys", "true")
    return spark


def parse(text: Column | str) -> Column:
    """VARIANT of a JSON text; null if there is anything besides one JSON value."""
    text = F.col(text) if isinstance(text, str) else text
    whole = F.try_variant_get(F.try_parse_json(F.concat(F.lit("["), text, F.lit("]"))), "$", "array<variant>")
    # an argument of a function is evaluated once, so the text is parsed once
    return F.get(F.flatten(F.transform(F.array(whole), lambda a: F.when(F.array_size(a) == 1, a))), F.lit(0))


def present(v: Column) -> Column:
    """v, with JSON null as null."""
    return F.when(~F.is_variant_null(v), v)


def field(v: Column, *path: str) -> Column:
    """A member, JSON null included: the type tests below take that for missing, present() makes it null."""
    return F.try_variant_get(v, "$" + "".join(f".{p}" for p in path), "variant")


def has(v: Column, name: str) -> Column:
    return field(v, name).isNotNull()


def _members(v: Column) -> Column:
    return F.try_variant_get(v, "$", "map<string,variant>")


def is_object(v: Column) -> Column:
    return _members(v).isNotNull()


def items(v: Column) -> Column:
    """The elements of a list; null for anything else."""
    return F.try_variant_get(v, "$", "array<variant>")


def listed(v: Column) -> Column:
    """The elements of a list; none for anything else."""
    return F.coalesce(items(v), no_items())


def no_items() -> Column:
    return F.array().cast("array<variant>")


def objects(values: Column) -> Column:
    return F.filter(values, is_object)


def string(v: Column) -> Column:
    """The text of a string; null for anything else."""
    return F.when(_members(v).isNull() & items(v).isNull() & (F.schema_of_variant(v) == "STRING"), F.try_variant_get(v, "$", "string"))


def text_of(v: Column) -> Column:
    """Any scalar as text."""
    return F.try_variant_get(v, "$", "string")


def truthy(v: Column) -> Column:
    """v unless it is missing, null, false, zero or empty."""
    full = F.coalesce(F.array_size(F.map_keys(_members(v))) > 0, F.array_size(items(v)) > 0, ~F.to_json(v).isin("null", '""', "false", "0", "0.0", "-0.0"))
    return F.when(full, v)


def first_truthy(*values: Column) -> Column:
    return F.coalesce(*(truthy(v) for v in values))


def variant(value: Column) -> Column:
    """VARIANT of a struct, map or array column."""
    return F.to_variant_object(value)


def scalar(value) -> Column:
    """VARIANT of a text or a number."""
    return (value if isinstance(value, Column) else F.lit(value)).cast("variant")


def any_of(*conditions: Column) -> Column:
    """OR in which an unknown condition counts as false."""
    return reduce(lambda a, b: a | b, (F.coalesce(c, F.lit(False)) for c in conditions))
