"""Raw tables and models built from the driver's tables, by name.

``Catalog(spark, sf_dir)`` reads the driver tables lazily, turns them into
raw documents through the adapters, loads them into raw-table rows and
exposes every model as a DataFrame. Nothing is cached: each model is one
lazy plan, so Catalyst prunes columns and pushes filters through the whole
chain, and reused exchanges are shared within a plan. A job that goes over its
documents or raw rows several times asks for them to be kept (``keep``): they
are then written once under the shared folder and read from there;
``raw-trending`` keeps the raw trending rows only.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession

from snapreel.plans import intermediate as I
from snapreel.plans import marts as M
from snapreel.plans import staging as S
from snapreel.plans.daily import build_models
from snapreel.session import stage
from snapreel.sources import adapters as A
from snapreel.sources import raw_loaders as L

DRIVER_TABLES = ("events", "part", "lineitem", "supplier")


class Catalog:
    def __init__(self, spark: SparkSession, sf_dir: str, envelope: str = "all",
                 media_type_from: str = "envelope", keep: str | None = None):
        if keep not in (None, "documents", "raw", "raw-trending"):
            raise ValueError("keep must be None, 'documents', 'raw' or 'raw-trending'")
        self.keep, self._held = keep, {}
        self.spark = spark
        self.sf_dir = sf_dir.rstrip("/")
        self.envelope = envelope
        self.media_type_from = media_type_from

    def table(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.sf_dir}/{name}.parquet")

    def _kept(self, level: str, name: str, build: Callable[[], DataFrame]) -> DataFrame:
        if self.keep not in (level, f"{level}-{name.split('-')[0]}"):
            return build()
        if name not in self._held:
            self._held[name] = stage(build(), f"{level}-{name}")
        return self._held[name]

    # documents -------------------------------------------------------------
    def trending_documents(self, envelope: str | None = None, time_window: str = "day") -> DataFrame:
        envelope = envelope or self.envelope
        return self._kept("documents", f"trending-{envelope}-{time_window}",
                          lambda: A.trending_documents(self.table("events"), envelope=envelope, time_window=time_window))

    def details_documents(self) -> DataFrame:
        return self._kept("documents", "details", lambda: A.details_documents(self.table("part")))

    def credits_documents(self) -> DataFrame:
        return self._kept("documents", "credits", lambda: A.credits_documents(self.table("lineitem"), self.table("supplier")))

    # raw tables ------------------------------------------------------------
    def raw_trending(self, envelope: str | None = None) -> DataFrame:
        return self._kept("raw", f"trending-{envelope or self.envelope}",
                          lambda: L.load_trending_raw(self.trending_documents(envelope)))

    @cached_property
    def raw_details(self) -> DataFrame:
        return self._kept("raw", "details", lambda: L.load_details_raw(self.details_documents()))

    @cached_property
    def raw_credits(self) -> DataFrame:
        return self._kept("raw", "credits", lambda: L.load_credits_raw(self.credits_documents()))

    # models ----------------------------------------------------------------
    def stg_trending(self, envelope: str | None = None, media_type_from: str | None = None) -> DataFrame:
        return S.stg_trending(self.raw_trending(envelope), media_type_from or self.media_type_from)

    @property
    def stg_details(self) -> DataFrame:
        return S.stg_details(self.raw_details)

    @property
    def stg_details_genres(self) -> DataFrame:
        return S.stg_details_genres(self.raw_details)

    @property
    def stg_credits_cast(self) -> DataFrame:
        return S.stg_credits_cast(self.raw_credits)

    @property
    def stg_credits_crew(self) -> DataFrame:
        return S.stg_credits_crew(self.raw_credits)

    @property
    def credits_summary(self) -> DataFrame:
        return I.credits_summary_from_raw(self.raw_credits)

    @property
    def genres_summary(self) -> DataFrame:
        return I.genres_summary(self.stg_details_genres)

    def dim_content(self, envelope: str | None = None, media_type_from: str | None = None) -> DataFrame:
        return M.dim_content(self.stg_trending(envelope, media_type_from), self.stg_details,
                             self.credits_summary, self.genres_summary)

    def fct_trending_daily(self, envelope: str | None = None) -> DataFrame:
        return M.fct_trending_daily(self.stg_trending(envelope))

    def models(self) -> dict[str, DataFrame]:
        """Every model under its reference name, plus the raw key columns (for the checks)."""
        models = build_models(self.raw_trending(), self.raw_details, self.raw_credits,
                              self.media_type_from)
        models["tmdb_details_raw"] = self.raw_details.drop("payload")
        models["tmdb_credits_raw"] = self.raw_credits.drop("payload")
        return models
