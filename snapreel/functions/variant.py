"""Path access and casts on VARIANT documents, and lateral flatten.

The warehouse notation ``doc:a::number`` becomes ``variant_get(doc, '$.a',
'decimal(38,0)')``. Casts are strict (ANSI): a value that cannot be cast
raises instead of turning into NULL; a JSON null or a missing path is NULL.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Target types of the warehouse casts (fixed values).
NUMBER = "decimal(38,0)"   # ::number -- integral, rounds half away from zero
FLOAT = "double"           # ::float  -- 64-bit
STRING = "string"          # ::string -- strings unquoted
BOOLEAN = "boolean"        # ::boolean
VARIANT = "variant"        # sub-document, kept semi-structured


def _c(col: Column | str) -> Column:
    return F.col(col) if isinstance(col, str) else col


def vget(doc: Column | str, path: str, type_: str = VARIANT) -> Column:
    """``doc:path::type`` -- typed read of one path."""
    if not path.startswith("$"):
        path = "$." + path
    return F.variant_get(_c(doc), path, type_)


def vstr(doc: Column | str, path: str) -> Column:
    return vget(doc, path, STRING)


def vnum(doc: Column | str, path: str) -> Column:
    return vget(doc, path, NUMBER)


def flatten(df: DataFrame, array: Column, keep: list[str],
            value_name: str = "value", pos_name: str | None = None) -> DataFrame:
    """Lateral flatten of ``array`` (J1): one output row per element.

    Inner semantics: a NULL, missing or empty array gives no rows; an object
    gives one row per field value. Planned as a ``Generate`` inside the
    scan's whole-stage-codegen span -- no shuffle, no Python. ``pos_name``
    adds the element's place, from 0.
    """
    spark = df.sparkSession
    exploded = df.lateralJoin(spark.tvf.variant_explode(array))
    place = [F.col("pos").alias(pos_name)] if pos_name else []
    return exploded.select(*[F.col(c) for c in keep], F.col("value").alias(value_name), *place)


def entries(array: Column | str) -> Column:
    """The rows that :func:`flatten` gives of ``array``, as an array of VARIANT: a list's elements, an object's values."""
    found = lambda kind: F.try_variant_get(_c(array), "$", kind)
    return F.coalesce(found("array<variant>"), F.map_values(found("map<string,variant>")))


def outer(col_name: str) -> Column:
    """Reference to a column of the outer row inside :func:`flatten`."""
    return F.col(col_name).outer()
