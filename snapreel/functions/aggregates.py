"""Aggregate rules: ordered string aggregation and first-by-name.

Both are ordinary Spark aggregates, so they run partial (map-side) before
the shuffle and never need a whole group in one buffer before the final
merge.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

LIST_SEPARATOR = ", "  # fixed value


def ordered_listagg(value: str, order_by: list[str], where: str | None = None,
                    separator: str = LIST_SEPARATOR) -> Column:
    """``listagg(value, sep) within group (order by ...)`` with the warehouse's
    NULL rules (A2/A3, O4, T6, T7).

    * ascending order puts NULLs last;
    * NULL values are skipped;
    * a group whose rows (after ``where``) all have NULL ``value`` gives
      ``''``; a group with no such rows gives NULL.
    ``value`` and ``order_by`` are column names; ``where`` a SQL predicate.
    """
    keys = ", ".join(f"{c} ASC NULLS LAST" for c in order_by)
    flt = f" FILTER (WHERE {where})" if where else ""
    sep = separator.replace("'", "\\'")
    agg = F.expr(f"listagg({value}, '{sep}') WITHIN GROUP (ORDER BY {keys}){flt}")
    if where:
        n = F.expr(f"count_if({where})")
    else:
        n = F.count(F.lit(1))
    return F.when(n > 0, F.coalesce(agg, F.lit("")))


def split_listagg(rows: DataFrame, keys: list[str], value: str, order_by: list[str], out: str, pieces: int,
                  separator: str = LIST_SEPARATOR) -> DataFrame:
    """:func:`ordered_listagg` for groups of any size: ``keys`` and ``out``.

    All rows are dealt to ``pieces`` ranges of ``(keys, order_by)``, so a group
    with a large share of them is cut into ordered ranges on many tasks. Each
    range becomes one string, and a group's strings are joined in the ranges'
    order: the last step handles one string a range, not the group's rows.
    """
    order = [F.asc_nulls_last(c) for c in order_by]
    dealt = rows.repartitionByRange(pieces, *keys, *order).withColumn("_piece", F.spark_partition_id())
    parts = dealt.groupBy(*keys, "_piece").agg(ordered_listagg(value, order_by, separator=separator).alias("_part"),
                                               F.count(value).alias("_named"))
    # a range of NULL values only adds nothing; a group of such ranges gives ''
    joined = ordered_listagg("_part", ["_piece"], where="_named > 0", separator=separator)
    return parts.groupBy(*keys).agg(F.coalesce(joined, F.lit("")).alias(out))


def first_by_name(name: str, payload: list[str], where: Column | None = None) -> Column:
    """Row with the smallest ``name`` (NULL names last), as a struct.

    Equivalent of ``row_number() over (partition by key order by name) = 1``
    (W1 + O1) but as a partial aggregate: ``min`` over a struct whose first
    fields are the sort key. Ties on ``name`` are broken by the ``payload``
    columns in order, NULLs last (T8).
    """
    fields = [F.col(name).isNull().alias("_name_null"), F.col(name).alias(name)]
    for p in payload:
        fields += [F.col(p).isNull().alias(f"_{p}_null"), F.col(p).alias(p)]
    s = F.struct(*fields)
    if where is not None:
        s = F.when(where, s)
    return F.min(s)
