"""The daily job as plain functions: ingest -> enrich -> barrier -> models -> checks.

This composes the reference's task chain (trending load, details
enrichment, credits enrichment, then the model build and its tests) as one
Spark program a scheduler can call once a day. Storage layout under
``raw_root``: ``trending`` (partitioned by slice), ``details`` and
``credits`` (partitioned by key bucket); marts under ``mart_root``.
"""

from __future__ import annotations

import hashlib
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from snapreel.operators import enrich as E
from snapreel.operators import keyindex as KI
from snapreel.operators import quality as Q
from snapreel.operators.ingest import ingest_trending
from snapreel.operators.joins import input_size_bytes, match, restrict_to
from snapreel.operators.replace import (
    MIN_BUCKETS, buckets_for, key_bucket, read_keyed, table_buckets, upsert_keyed_table, write_keyed,
)
from snapreel.plans import intermediate as I
from snapreel.plans import marts as M
from snapreel.plans import staging as S
from snapreel.sources import snapshots as SN
from snapreel.sources import versions as VT
from snapreel.sources.raw_loaders import RAW_LOADERS
from snapreel.session import stage
from snapreel.sources import tables as TB
from snapreel.sources.schemas import RAW_NAMES, RAW_SCHEMAS, create_raw_tables

RAW_COLUMNS = {s: [f.name for f in schema.fields] for s, schema in RAW_SCHEMAS.items()}
KEY = ["tmdb_id", "media_type"]


def read_raw(spark: SparkSession, raw_root: str, source: str, database: str | None = None) -> DataFrame:
    """A raw table as declared (layout columns dropped), by its name when ``database`` is
    given; empty if not yet written."""
    path = f"{raw_root.rstrip('/')}/{source}"
    if not VT.exists(spark, path):
        return spark.createDataFrame([], RAW_SCHEMAS[source])
    table = TB.attach(spark, path, f"{database}.{RAW_NAMES[source]}") if database else VT.read(spark, path)
    return table.select(*RAW_COLUMNS[source])


def default_database(mart_root: str) -> str:
    """A schema name of a marts folder's own, for runs that are not given one."""
    return "snapreel_" + hashlib.md5(mart_root.rstrip("/").encode()).hexdigest()[:8]


def attach_marts(spark: SparkSession, mart_root: str, database: str) -> list[str]:
    """The stored marts by name (S15, S17); returns the names."""
    return [TB.attach(spark, f"{mart_root.rstrip('/')}/{m}", f"{database}.{m}") and f"{database}.{m}"
            for m in MART_MODELS if VT.exists(spark, f"{mart_root.rstrip('/')}/{m}")]


def enrich_source(spark: SparkSession, store_root: str, raw_root: str, source: str,
                  landing: DataFrame, latest: DataFrame | None = None,
                  pending_root: str | None = None) -> tuple[DataFrame, DataFrame | None]:
    """R2-R9 for one source: missing keys -> their landing documents -> store + raw.

    ``landing`` holds fetched envelopes (column ``doc``). Only documents of
    keys missing from the raw table are stored (S2) and upserted (S13).
    Returns ``(missing keys, keys loaded)``; the second is None when nothing
    was loaded. The missing set is staged, so both stay fixed. With
    ``pending_root`` the loaded keys are recorded there before the raw table
    changes; they stay until :func:`clear_pending`, so a run that dies before
    its marts are written leaves a record of the titles still to summarise.
    """
    if latest is None:
        latest = stage(E.latest_trending_keys(read_raw(spark, raw_root, "trending"), latest_date(spark, raw_root)), "latest-keys")
    # of the loaded keys only the latest ones' pages are counted, not those of all history
    existing = E.existing_keys(restrict_to(KI.loaded_keys(spark, raw_root, source), latest, KEY))
    missing = stage(E.missing_keys(latest, existing), f"missing-{source}")
    keyed = landing.select("doc", *SN._key_cols("doc"))
    todo = stage(E.select_documents(keyed, missing).select("doc"), f"todo-{source}")
    if todo.first() is None:
        return missing, pending_keys(spark, pending_root, source)
    SN.write_snapshots(todo, store_root, source, skip_stored=True)   # a rerun stores only the rest
    rows = RAW_LOADERS[source](todo)
    keys = rows.select(*KEY).where(F.col("tmdb_id").isNotNull()).distinct()
    if pending_root:
        keys.write.mode("append").parquet(f"{pending_root.rstrip('/')}/{source}")
    KI.load(spark, raw_root, source, rows)
    if pending_root:
        return missing, pending_keys(spark, pending_root, source)
    return missing, stage(keys, f"touched-{source}")


def pending_keys(spark: SparkSession, pending_root: str | None, source: str) -> DataFrame | None:
    """Titles loaded into the raw table since the marts were last written; None without any."""
    path = f"{pending_root.rstrip('/')}/{source}" if pending_root else None
    if path is None or not SN.committed(spark, path):
        return None
    schema = T.StructType([f for f in RAW_SCHEMAS["details"].fields if f.name in KEY])
    return stage(spark.read.schema(schema).parquet(path).distinct(), f"touched-{source}")


def clear_pending(spark: SparkSession, pending_root: str) -> None:
    """Forget the pending titles: their summaries and marts are stored."""
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(pending_root)
    p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(p, True)


def build_models(raw_trending: DataFrame, raw_details: DataFrame, raw_credits: DataFrame,
                 media_type_from: str = "envelope") -> dict[str, DataFrame]:
    """All nine models as lazy DataFrames (S16: views) under their reference names."""
    st = S.stg_trending(raw_trending, media_type_from)
    det, gen = S.stg_details(raw_details), S.stg_details_genres(raw_details)
    cast, crew = S.stg_credits_cast(raw_credits), S.stg_credits_crew(raw_credits)
    cs, gs = I.credits_summary_from_raw(raw_credits), I.genres_summary(gen)
    return {
        "stg_tmdb_trending": st, "stg_tmdb_details": det, "stg_tmdb_details_genres": gen,
        "stg_tmdb_credits_cast": cast, "stg_tmdb_credits_crew": crew,
        "int_tmdb_credits_summary": cs, "int_tmdb_genres_summary": gs,
        "dim_content": M.dim_content(st, det, cs, gs), "fct_trending_daily": M.fct_trending_daily(st),
    }


def register_views(models: dict[str, DataFrame]) -> None:
    """Expose every model as a temporary view for SQL users."""
    for name, df in models.items():
        df.createOrReplaceTempView(name)


MART_MODELS = ("dim_content", "fct_trending_daily")


def materialize_marts(spark: SparkSession, models: dict[str, DataFrame], mart_root: str,
                      fact_dates: list[str] | None = None, changed: DataFrame | None = None) -> dict[str, DataFrame]:
    """Bring the mart tables up to date; returns them read back from storage.

    A ``dim_content`` row depends on its own key only. With ``changed`` (a
    :func:`change_set`) just those keys' rows are computed and upserted by
    bucket; without it, or on the first run, the table is rebuilt. Likewise
    ``fct_trending_daily`` is partitioned by ``trending_date``, and with
    ``fact_dates`` only those dates are recomputed (the filter prunes the raw
    trending partitions) and replaced. Both give the tables of a full rebuild
    without rewriting the history, and appear as published versions: readers
    see the marts before or after a run, never in between.
    """
    root = mart_root.rstrip("/")
    out = dict(models)
    dim_path = f"{root}/dim_content"
    if changed is not None and VT.exists(spark, dim_path):
        upsert_keyed_table(spark, dim_path, models["dim_content"])
    else:
        write_keyed(models["dim_content"], dim_path)
    out["dim_content"] = read_keyed(spark, dim_path).drop("key_bucket")

    fact_path = f"{root}/fct_trending_daily"
    fact = models["fct_trending_daily"]
    replace: str | set[str] = VT.TABLE       # full rebuild: dates gone from raw disappear too
    if fact_dates is not None and VT.exists(spark, fact_path):
        fact = fact.where(F.col("trending_date").isin([F.to_date(F.lit(d)) for d in fact_dates]))
        replace = {f"trending_date={d}" for d in fact_dates}      # only the given dates are replaced
    VT.publish(fact, fact_path, ["trending_date"], replace)
    out["fct_trending_daily"] = VT.read(spark, fact_path).select(*M.FACT_COLUMNS)
    return out


# --- the inputs of dim_content, stored alike -------------------------------------
# Keyed models that depend on one source's rows of their own title.
KEYED_INPUTS = {"stg_tmdb_details": "details", "int_tmdb_credits_summary": "credits", "int_tmdb_genres_summary": "details"}


def _keyed_input(name: str, raw: DataFrame) -> DataFrame:
    if name == "int_tmdb_credits_summary":
        return I.credits_summary_of_any(raw)
    if name == "int_tmdb_genres_summary":
        return I.genres_summary(S.stg_details_genres(raw))
    return S.stg_details(raw)


def input_paths(mart_root: str, media_type_from: str) -> dict[str, str]:
    root = mart_root.rstrip("/")
    return {**{name: f"{root}/_{name}" for name in KEYED_INPUTS},
            "trending_descriptions": f"{root}/_trending_descriptions_{media_type_from}"}


def update_descriptions(spark: SparkSession, path: str, stg_trending: DataFrame, dates: list[str] | None = None,
                        buckets: int | None = None) -> DataFrame:
    """Maintain the distinct trending descriptions incrementally; returns the rows a run added.

    Snapshots are immutable, so a date's descriptions never change once
    stored: each run adds only the descriptions of its own dates that were
    never seen (matched null-safely on all six columns), and a rerun adds
    nothing. Without a table yet, or with ``dates=None``, the table is
    rebuilt from all of ``stg_trending``.
    """
    if dates is None or not VT.exists(spark, path):
        rows = stage(M.trending_descriptions(stg_trending), "descriptions")
        write_keyed(rows, path, buckets, clustered=True)
        return rows
    day = stg_trending.where(F.col("trending_date").isin([F.to_date(F.lit(d)) for d in dates]))
    new = stage(M.trending_descriptions(day), "descriptions-delta")
    version = VT.current(spark, path)
    kb = key_bucket(table_buckets(spark, path), clustered=True)
    # only descriptions of the run's keys can match; of the stored ones, only their buckets are read
    hit = {f"key_bucket={r[0]}" for r in new.select(kb.alias("b")).distinct().collect()}
    seen = restrict_to(VT.read(spark, path, version, hit), new.select(*M.KEY).distinct(), M.KEY)
    fresh = stage(match(new, seen, M.DESCRIPTION_COLUMNS, "left_anti"), "descriptions-fresh")
    if fresh.first() is not None:
        VT.publish(fresh.withColumn("key_bucket", kb), path, ["key_bucket"], VT.APPEND)
    return fresh


def refresh_inputs(spark: SparkSession, raw: dict[str, DataFrame], mart_root: str, touched: dict[str, DataFrame | None],
                   stg_trending: DataFrame, dates: list[str] | None, media_type_from: str) -> tuple[dict[str, str], DataFrame]:
    """Bring the four inputs of ``dim_content`` up to date; returns their folders and the descriptions added.

    Descriptions, details and the two summaries are keyed tables clustered
    alike: one bucket count, Spark's bucket layout. A key's rows depend only on
    its own raw rows, and a run adds or replaces raw rows of the titles it
    loaded: those are taken from the raw table (size-checked broadcast semi
    join), computed and upserted; every other key is untouched. Tables that do
    not exist are built in full. When one has outgrown its buckets fourfold (or a
    run died while doing this), all are written with the larger count.
    """
    paths = input_paths(mart_root, media_type_from)
    held = {n: table_buckets(spark, p) for n, p in paths.items() if VT.exists(spark, p)}
    built = {n: stage(_keyed_input(n, raw[s]), f"input-{n}") for n, s in KEYED_INPUTS.items() if n not in held}
    sizes = [input_size_bytes(df) or 0 for df in [*built.values(), *(read_keyed(spark, paths[n]) for n in held)]]
    want, have = max(map(buckets_for, sizes), default=MIN_BUCKETS), max(held.values(), default=0)
    buckets = want if want >= 4 * have else have
    for name, count in held.items():
        if count != buckets:
            write_keyed(read_keyed(spark, paths[name]).drop("key_bucket"), paths[name], buckets, clustered=True)
    for name, source in KEYED_INPUTS.items():
        if name in built:
            write_keyed(built[name], paths[name], buckets, clustered=True)
        elif touched.get(source) is not None:
            upsert_keyed_table(spark, paths[name], _keyed_input(name, restrict_to(raw[source], touched[source], KEY)))
    return paths, update_descriptions(spark, paths["trending_descriptions"], stg_trending, dates, buckets)


def named_inputs(spark: SparkSession, paths: dict[str, str], database: str) -> dict[str, DataFrame]:
    """The inputs by name: bucketed tables, so that joining them on the title needs no exchange."""
    return {name: TB.attach(spark, path, f"{database}.{name}") for name, path in paths.items()}


def dim_from_inputs(inputs: dict[str, DataFrame]) -> DataFrame:
    return M.dim_from_descriptions(inputs["trending_descriptions"], inputs["stg_tmdb_details"],
                                   inputs["int_tmdb_credits_summary"], inputs["int_tmdb_genres_summary"])


def change_set(fresh: DataFrame, touched: dict[str, DataFrame | None]) -> DataFrame:
    """The titles whose ``dim_content`` rows a run can have changed: those it loaded
    details or credits for, and those with a description never seen before."""
    keys = fresh.select(*KEY)
    for loaded in touched.values():
        if loaded is not None:
            keys = keys.unionByName(loaded.select(*KEY))
    return stage(keys.distinct(), "changed-titles")


# Models whose rows come from one trending date, and keyed models by source.
DATED_MODELS = {"stg_tmdb_trending": "trending_date", "fct_trending_daily": "trending_date"}
KEYED_MODELS = {"stg_tmdb_details": "details", "stg_tmdb_details_genres": "details",
                "tmdb_details_raw": "details", "stg_tmdb_credits_cast": "credits",
                "stg_tmdb_credits_crew": "credits", "tmdb_credits_raw": "credits"}


def scope_checks(checked: dict[str, DataFrame], run_dates: list[str],
                 touched: dict[str, DataFrame | None]) -> dict[str, DataFrame]:
    """Restrict the checks to what a run can have changed.

    Stored snapshots are immutable and keyed raw rows change only for the
    titles a run loads, so a new not-null or uniqueness failure can only sit
    in the run's own dates (date-partitioned models: partition pruning) or
    among the touched titles (keyed models: broadcast semi join with the
    staged key set; models without touched titles are left out of the report).
    The rebuilt dimension and the summaries are checked whole. Earlier data was checked
    when it arrived.
    """
    out = dict(checked)
    days = [F.to_date(F.lit(d)) for d in run_dates]
    for name, col in DATED_MODELS.items():
        out[name] = checked[name].where(F.col(col).isin(days))
    for name, source in KEYED_MODELS.items():
        keys = touched.get(source)
        if keys is None:
            del out[name]              # nothing new to check: left out of the report, not reported as passed
        else:
            out[name] = restrict_to(checked[name], keys, KEY)
    return out


class RawIncompleteError(RuntimeError):
    """The latest snapshot's keys are not all loaded."""


def stored_dates(spark: SparkSession, table_path: str, column: str, **fixed: str) -> set[str]:
    """The dates a table stores (with the ``fixed`` other partition values), from partition names alone."""
    version = VT.current(spark, table_path)
    found = version.partitions() if version else []
    return {p[column] for p in found if p[column] is not None and all(p[c] == v for c, v in fixed.items())}


def run_dates(spark: SparkSession, raw_root: str, mart_root: str, run_date: str) -> list[str]:
    """The run's date and every raw date that the stored fact does not hold."""
    days = stored_dates(spark, f"{raw_root.rstrip('/')}/trending", "snapshot_date")
    held = stored_dates(spark, f"{mart_root.rstrip('/')}/fct_trending_daily", "trending_date")
    return sorted({run_date} | (days - held))


def latest_date(spark: SparkSession, raw_root: str) -> str | None:
    """R2 from partition names: the newest stored ``all``/``day`` snapshot."""
    return max(stored_dates(spark, f"{raw_root.rstrip('/')}/trending", "snapshot_date", **E.DAILY_ALL), default=None)


@dataclass
class DailyResult:
    routes: DataFrame
    gate: DataFrame
    not_null: DataFrame
    unique: DataFrame
    models: dict


def run_daily(spark: SparkSession, store_root: str, raw_root: str, mart_root: str,
              run_date: str, today: str | None = None,
              trending_landing: DataFrame | None = None,
              details_landing: DataFrame | None = None,
              credits_landing: DataFrame | None = None,
              media_type_from: str = "envelope", scoped_checks: bool = False,
              allow_incomplete: bool = False, database: str | None = None) -> DailyResult:
    """One daily run. Landing frames carry freshly fetched envelopes (``doc``).

    Checks cover every stored row, or with ``scoped_checks`` only what the run
    changed (:func:`scope_checks`). The marts are built when no latest key lacks
    its details or credits (R11); ``allow_incomplete`` builds them all the same.
    Dates in the raw table that the stored fact lacks (late snapshots) are
    added to the run's own date, and titles that an earlier run loaded without
    reaching its marts are summarised now. Raw tables, the inputs of the
    dimension and the marts are read by their names in ``database``.
    """
    database = database or default_database(mart_root)
    create_raw_tables(spark, database, location=raw_root)
    pending = f"{mart_root.rstrip('/')}/_pending"
    requested = spark.range(1).select(F.to_date(F.lit(run_date)).alias("snapshot_date"))
    routes = ingest_trending(spark, store_root, f"{raw_root.rstrip('/')}/trending", requested,
                             today or run_date, trending_landing)
    # one snapshot's keys: staged once, so its real (small) size drives the broadcasts
    latest = stage(E.latest_trending_keys(read_raw(spark, raw_root, "trending"), latest_date(spark, raw_root)), "latest-keys")
    touched = {}
    for source, landing in (("details", details_landing), ("credits", credits_landing)):
        if landing is not None:
            touched[source] = enrich_source(spark, store_root, raw_root, source, landing, latest, pending)[1]
        else:
            touched[source] = pending_keys(spark, pending, source)
    raw = {s: read_raw(spark, raw_root, s, database) for s in RAW_SCHEMAS}
    loaded = {s: KI.loaded_keys(spark, raw_root, s) for s in ("details", "credits")}       # keys only, no raw history
    gate = stage(E.raw_complete(raw["trending"], loaded["details"], loaded["credits"], keys=latest), "gate")
    if not allow_incomplete and not gate.first().raw_complete:
        raise RawIncompleteError(f"raw tables are incomplete for the latest snapshot: {gate.first().asDict()}")
    dates = run_dates(spark, raw_root, mart_root, run_date)
    models = build_models(raw["trending"], raw["details"], raw["credits"], media_type_from)
    # after a run that died between its inputs and its marts the dimension is rebuilt: its change set is lost
    started = f"{pending}/dim_content"
    rebuild = SN._exists(spark, started)
    spark.range(1).write.mode("overwrite").parquet(started)
    paths, fresh = refresh_inputs(spark, raw, mart_root, touched, models["stg_tmdb_trending"], dates, media_type_from)
    inputs = named_inputs(spark, paths, database)
    models.update({n: inputs[n] for n in KEYED_INPUTS})
    changed = None if rebuild else change_set(fresh, touched)
    if changed is not None and VT.exists(spark, f"{mart_root.rstrip('/')}/dim_content"):
        inputs = {n: restrict_to(df, changed, KEY) for n, df in inputs.items()}
    models["dim_content"] = dim_from_inputs(inputs)
    models = materialize_marts(spark, models, mart_root, fact_dates=dates, changed=changed)
    attach_marts(spark, mart_root, database)
    clear_pending(spark, pending)
    if scoped_checks:
        checked = scope_checks({**models, "tmdb_details_raw": raw["details"].drop("payload"),
                                "tmdb_credits_raw": raw["credits"].drop("payload")}, dates, touched)
        return DailyResult(routes, gate, Q.run_not_null(checked), Q.run_unique(checked), models)
    checks = stage(Q.run_checks(models, raw["details"], raw["credits"]), "checks")       # a few rows: every source is read once
    return DailyResult(routes, gate, Q.checked_not_null(checks), Q.checked_unique(checks), models)
