"""The column types in which registered queries leave the library."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Columns held as decimal(38,0) in the models; narrowed at the boundary.
NUMBER_COLUMNS = {"tmdb_id", "vote_count", "runtime", "genre_id", "person_id", "cast_order"}


def flat(df: DataFrame) -> DataFrame:
    return df.select(*[F.col(c).cast("bigint").alias(c) if c in NUMBER_COLUMNS else F.col(c) for c in df.columns])
