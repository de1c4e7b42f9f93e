"""Flat-SQL oracles (DuckDB dialect) for the registered queries.

They compute each answer straight from the driver's flat tables -- no JSON,
no VARIANT -- following the adapter mapping in README.md, so they are
independent of the code under test. Column names match the Spark queries.
"""

from __future__ import annotations

# ---- shared fragments ---------------------------------------------------
_MT = "CASE WHEN {k} % 2 = 0 THEN 'movie' ELSE 'tv' END"
_LOAD_TS = "(TIMESTAMP '2024-01-01 00:00:00' + to_days(CAST({k} % 50 + 1 AS INTEGER)))"

EV = """ev AS (
  SELECT event_id,
         CAST(ts AS DATE) AS snapshot_date,
         CAST(CAST(ts AS DATE) + INTERVAL 1 DAY AS TIMESTAMP) AS load_ts,
         CAST(json_extract_string(props, '$.k') AS BIGINT) AS tmdb_id,
         CASE WHEN event_type IN ('view', 'click') THEN 'movie'
              WHEN event_type IN ('purchase', 'signup') THEN 'tv'
              ELSE 'person' END AS item_type,
         event_type, value, user_id
  FROM events)"""

# stg_trending rows; {mt} is the output media_type expression
_STG_TRENDING = """SELECT snapshot_date AS trending_date, 'day' AS time_window, {mt} AS media_type,
         tmdb_id, event_type AS title,
         CASE WHEN item_type = 'movie' THEN upper(event_type) END AS original_title,
         CASE WHEN item_type <> 'person' THEN 'en' END AS original_language,
         CASE WHEN item_type = 'movie' THEN snapshot_date END AS release_date,
         value AS popularity, user_id AS vote_count, value AS vote_average, load_ts,
         value >= 400 AS is_adult,
         CASE WHEN item_type = 'tv' THEN upper(event_type) END AS original_name,
         '/poster/' || CAST(event_id AS VARCHAR) || '.jpg' AS poster_path,
         CASE WHEN item_type <> 'person' THEN '/backdrop/' || CAST(tmdb_id AS VARCHAR) || '.jpg' END AS backdrop_path
  FROM ev"""

STG_TRENDING_ALL = "st AS (" + _STG_TRENDING.format(mt="'all'") + ")"
STG_TRENDING_ITEM = "st AS (" + _STG_TRENDING.format(mt="item_type") + ")"

DETAILS = f"""det AS (
  SELECT p_partkey AS tmdb_id, {_MT.format(k='p_partkey')} AS media_type,
         p_name AS title,
         CASE WHEN p_partkey % 2 = 0 THEN upper(p_name) END AS original_title,
         CASE WHEN p_size <= 25 THEN 'en' ELSE 'ko' END AS original_language,
         CASE WHEN p_partkey % 5 = 0 THEN NULL
              ELSE DATE '2000-01-01' + CAST(p_partkey % 10000 AS INTEGER) END AS release_date,
         CAST(p_size AS BIGINT) AS runtime, p_retailprice AS vote_average,
         CAST(p_size * 10 AS BIGINT) AS vote_count,
         CASE WHEN p_partkey % 7 = 0 THEN NULL
              ELSE 'tt' || lpad(CAST(p_partkey AS VARCHAR), 7, '0') END AS imdb_id,
         {_LOAD_TS.format(k='p_partkey')} AS load_ts
  FROM part)"""

GENRES = f"""gen AS (
  SELECT tmdb_id, media_type, CAST(genre_id AS BIGINT) AS genre_id, genre_name, load_ts
  FROM (SELECT p_partkey AS tmdb_id, {_MT.format(k='p_partkey')} AS media_type,
               {_LOAD_TS.format(k='p_partkey')} AS load_ts,
               unnest(w) AS genre_name, generate_subscripts(w, 1) AS genre_id
        FROM (SELECT *, list_append(string_split(p_name, ' '), p_type) AS w FROM part)))"""

LINES = f"""li AS (
  SELECT l.l_partkey AS tmdb_id, {_MT.format(k='l.l_partkey')} AS media_type,
         {_LOAD_TS.format(k='l.l_partkey')} AS load_ts,
         l.l_suppkey AS person_id, s.s_name AS person_name,
         l.l_returnflag, l.l_linestatus, l.l_linenumber, l.l_orderkey
  FROM lineitem l JOIN supplier s ON l.l_suppkey = s.s_suppkey)"""

CAST = """cst AS (
  SELECT tmdb_id, media_type, person_id, person_name, l_returnflag AS character_name,
         CAST(l_linenumber - 1 + CASE WHEN tmdb_id % 4 = 0 THEN 4 ELSE 0 END AS BIGINT) AS cast_order,
         load_ts
  FROM li)"""

CREW = """crw AS (
  SELECT tmdb_id, media_type, person_id, person_name, l_linestatus AS department,
         CASE WHEN l_returnflag = 'R' AND l_linenumber = 7 THEN 'Director'
              WHEN l_returnflag = 'A' THEN 'Writer' ELSE 'Producer' END AS job,
         load_ts
  FROM li)"""

# the first director by name: a window over the director rows
DIRECTOR = """dir AS (
  SELECT tmdb_id, media_type, person_name AS director_name, load_ts
  FROM (SELECT *, row_number() OVER (PARTITION BY tmdb_id, media_type
                                     ORDER BY person_name NULLS LAST, load_ts NULLS LAST) AS r
        FROM crw WHERE job = 'Director')
  WHERE r = 1)"""

TOPCAST = """tc AS (
  SELECT tmdb_id, media_type,
         coalesce(string_agg(person_name, ', ' ORDER BY cast_order NULLS LAST, person_name NULLS LAST), '') AS top_cast
  FROM cst WHERE cast_order <= 2 GROUP BY ALL)"""

# every title in crew or cast, with its first director and top cast where it has them
CREDITS_SUMMARY = """cs AS (
  SELECT k.tmdb_id, k.media_type, dir.director_name, tc.top_cast, dir.load_ts
  FROM (SELECT tmdb_id, media_type FROM crw UNION SELECT tmdb_id, media_type FROM cst) k
  LEFT JOIN dir ON k.tmdb_id = dir.tmdb_id AND k.media_type = dir.media_type
  LEFT JOIN tc ON k.tmdb_id = tc.tmdb_id AND k.media_type = tc.media_type)"""

GENRES_SUMMARY = """gs AS (
  SELECT tmdb_id, media_type, string_agg(genre_name, ', ' ORDER BY genre_name) AS genres
  FROM gen GROUP BY ALL)"""

DIM = """dim AS (
  SELECT t.tmdb_id, t.media_type,
         coalesce(det.title, t.title) AS title,
         coalesce(det.original_title, t.original_title) AS original_title,
         coalesce(det.original_language, t.original_language) AS original_language,
         coalesce(det.release_date, t.release_date) AS release_date,
         det.runtime, det.imdb_id, cs.director_name, cs.top_cast, gs.genres
  FROM (SELECT DISTINCT tmdb_id, media_type, title, original_title, original_language, release_date
        FROM st WHERE tmdb_id IS NOT NULL) t
  LEFT JOIN det ON t.tmdb_id = det.tmdb_id AND t.media_type = det.media_type
  LEFT JOIN cs ON t.tmdb_id = cs.tmdb_id AND t.media_type = cs.media_type
  LEFT JOIN gs ON t.tmdb_id = gs.tmdb_id AND t.media_type = gs.media_type)"""

LATEST = """latest AS (SELECT max(snapshot_date) AS d FROM ev),
lk AS (SELECT DISTINCT e.tmdb_id, e.item_type AS media_type
       FROM ev e WHERE e.snapshot_date = (SELECT d FROM latest) AND e.item_type IN ('movie', 'tv'))"""

ASOF = """det_asof AS (SELECT * FROM det WHERE load_ts < (SELECT CAST(d AS TIMESTAMP) FROM latest)),
li_asof AS (SELECT * FROM li WHERE load_ts < (SELECT CAST(d AS TIMESTAMP) FROM latest))"""

_CREDIT_MODELS = [LINES, CAST, CREW, DIRECTOR, TOPCAST, CREDITS_SUMMARY]
_DETAIL_MODELS = [DETAILS, GENRES, GENRES_SUMMARY]


def _with(*ctes: str) -> str:
    return "WITH " + ",\n".join(ctes) + "\n"


def _dim(trending_cte: str) -> str:
    return _with(EV, trending_cte, *_DETAIL_MODELS, *_CREDIT_MODELS, DIM) + "SELECT * FROM dim"


_FACT = "SELECT trending_date, time_window, tmdb_id, media_type, popularity, vote_count, vote_average, load_ts FROM st"

_NOT_NULL = {
    "stg_tmdb_trending": ("st", ["trending_date", "tmdb_id", "title", "media_type", "time_window"]),
    "stg_tmdb_details": ("det", ["tmdb_id", "media_type"]),
    "stg_tmdb_details_genres": ("gen", ["tmdb_id", "media_type", "genre_id", "genre_name"]),
    "stg_tmdb_credits_cast": ("cst", ["tmdb_id", "media_type", "person_id", "person_name"]),
    "stg_tmdb_credits_crew": ("crw", ["tmdb_id", "media_type", "person_id", "person_name", "job"]),
    "int_tmdb_credits_summary": ("cs", ["tmdb_id", "media_type"]),
    "int_tmdb_genres_summary": ("gs", ["tmdb_id", "media_type", "genres"]),
    "dim_content": ("dim", ["tmdb_id", "media_type", "title"]),
    "fct_trending_daily": ("st", ["trending_date", "tmdb_id", "media_type"]),
}

_UNIQUE = {
    "stg_tmdb_details": ("det", ["tmdb_id", "media_type"]),
    "stg_tmdb_details_genres": ("gen", ["tmdb_id", "media_type", "genre_id"]),
    "int_tmdb_credits_summary": ("cs", ["tmdb_id", "media_type"]),
    "int_tmdb_genres_summary": ("gs", ["tmdb_id", "media_type"]),
    "dim_content": ("dim", ["tmdb_id", "media_type"]),
    "tmdb_details_raw": ("det", ["tmdb_id", "media_type"]),
}


def _dq_not_null() -> str:
    parts = []
    for model, (cte, cols) in _NOT_NULL.items():
        for c in cols:
            parts.append(f"SELECT '{model}' AS model, '{c}' AS column_name, "
                         f"count(*) FILTER (WHERE {c} IS NULL) AS failing_rows FROM {cte}")
    return (_with(EV, STG_TRENDING_ALL, *_DETAIL_MODELS, *_CREDIT_MODELS, DIM)
            + "\nUNION ALL\n".join(parts))


def _dq_unique() -> str:
    parts = []
    for model, (cte, cols) in _UNIQUE.items():
        k = ", ".join(cols)
        parts.append(f"SELECT '{model}' AS model, '{','.join(cols)}' AS key_columns, "
                     f"count(*) AS failing_groups, CAST(coalesce(sum(n), 0) AS BIGINT) AS failing_rows "
                     f"FROM (SELECT {k}, count(*) AS n FROM {cte} GROUP BY {k} HAVING count(*) > 1)")
    # a raw credits row is a title's run of order keys, numbered as a page: a key with two runs fails
    parts.append("""SELECT 'tmdb_credits_raw', 'tmdb_id,media_type,page', count(*), CAST(coalesce(sum(n), 0) AS BIGINT)
FROM (SELECT tmdb_id, media_type, page, count(DISTINCT run) AS n FROM (
  SELECT tmdb_id, media_type, l_orderkey // 4096 AS run, dense_rank() OVER (PARTITION BY tmdb_id ORDER BY l_orderkey // 4096) AS page FROM li)
  GROUP BY tmdb_id, media_type, page HAVING count(DISTINCT run) > 1)""")
    return (_with(EV, STG_TRENDING_ALL, *_DETAIL_MODELS, *_CREDIT_MODELS, DIM)
            + "\nUNION ALL\n".join(parts))


# titles whose documents the enriched daily job holds in the end: loaded before the
# last day, or trending on one of the last two days
_ENRICHED = (DETAILS.replace("det AS", "det_all AS"), LINES.replace("li AS", "li_all AS"),
    """days AS (SELECT DISTINCT snapshot_date AS d FROM ev ORDER BY d DESC LIMIT 2),
wanted AS (SELECT DISTINCT tmdb_id, item_type AS media_type FROM ev WHERE snapshot_date IN (SELECT d FROM days)),
det AS (SELECT * FROM det_all WHERE load_ts < (SELECT CAST(max(d) AS TIMESTAMP) FROM days)
  OR (tmdb_id, media_type) IN (SELECT tmdb_id, media_type FROM wanted)),
li AS (SELECT * FROM li_all WHERE load_ts < (SELECT CAST(max(d) AS TIMESTAMP) FROM days)
  OR (tmdb_id, media_type) IN (SELECT tmdb_id, media_type FROM wanted)),
gen AS (SELECT g.* FROM gen_all g JOIN det ON g.tmdb_id = det.tmdb_id AND g.media_type = det.media_type)""")

ORACLE_SQL = {
    "fct_trending_daily": _with(EV, STG_TRENDING_ALL) + _FACT,
    "stg_trending": _with(EV, STG_TRENDING_ALL) + "SELECT * FROM st",
    "stg_trending_item": _with(EV, STG_TRENDING_ITEM) + "SELECT * FROM st",
    "stg_details": _with(DETAILS) + "SELECT * FROM det",
    "stg_details_genres": _with(GENRES) + "SELECT * FROM gen",
    "stg_credits_cast": _with(LINES, CAST) + "SELECT * FROM cst",
    "stg_credits_crew": _with(LINES, CREW) + "SELECT * FROM crw",
    "genres_summary": _with(*_DETAIL_MODELS) + "SELECT * FROM gs",
    "credits_summary": _with(*_CREDIT_MODELS) + "SELECT * FROM cs",
    "top_cast": _with(LINES, CAST, TOPCAST) + "SELECT * FROM tc",
    "first_director": _with(LINES, CREW, DIRECTOR) + "SELECT * FROM dir",
    "credits_keys": _with(LINES, CAST, CREW) + "SELECT tmdb_id, media_type FROM crw UNION SELECT tmdb_id, media_type FROM cst",
    "dim_content_envelope": _dim(STG_TRENDING_ITEM),
    "dim_content_all": _dim(STG_TRENDING_ALL),
    "dim_content_item": _dim(STG_TRENDING_ITEM),
    "latest_trending_keys": _with(EV, LATEST) + "SELECT * FROM lk",
    "existing_details_keys": _with(EV, LATEST, DETAILS, LINES, ASOF) + "SELECT DISTINCT tmdb_id, media_type FROM det_asof",
    "existing_credits_keys": _with(EV, LATEST, DETAILS, LINES, ASOF) + "SELECT DISTINCT tmdb_id, media_type FROM li_asof",
    "missing_keys_details": _with(EV, LATEST, DETAILS, LINES, ASOF)
        + "SELECT tmdb_id, media_type FROM lk EXCEPT SELECT tmdb_id, media_type FROM det_asof",
    "missing_keys_credits": _with(EV, LATEST, DETAILS, LINES, ASOF)
        + "SELECT tmdb_id, media_type FROM lk EXCEPT SELECT tmdb_id, media_type FROM li_asof",
    "enrich_details": _with(EV, LATEST, DETAILS, LINES, ASOF)
        + """SELECT d.tmdb_id, d.media_type, d.title, d.load_ts FROM det d
             WHERE (d.tmdb_id, d.media_type) IN (
               SELECT tmdb_id, media_type FROM lk EXCEPT SELECT tmdb_id, media_type FROM det_asof)""",
    "enrich_credits": _with(EV, LATEST, DETAILS, LINES, ASOF)
        + """SELECT tmdb_id, media_type, load_ts, count(*) AS cast_entries, count(DISTINCT run) = max(page) AS all_pages
             FROM (SELECT *, l_orderkey // 4096 AS run, dense_rank() OVER (PARTITION BY tmdb_id ORDER BY l_orderkey // 4096) AS page FROM li)
             WHERE (tmdb_id, media_type) IN (
               SELECT tmdb_id, media_type FROM lk EXCEPT SELECT tmdb_id, media_type FROM li_asof)
             GROUP BY tmdb_id, media_type, load_ts""",
    "missing_details_count": _with(EV, LATEST, DETAILS, LINES, ASOF)
        + """SELECT count(*) AS missing_count FROM (
               SELECT tmdb_id, media_type FROM lk EXCEPT SELECT tmdb_id, media_type FROM det_asof)""",
    "snapshot_names": _with(DETAILS)
        + "SELECT 'tmdb_details_' || media_type || '_' || tmdb_id || '.json' AS name FROM det",
    "daily_enriched_dim": _with(EV, STG_TRENDING_ITEM, GENRES.replace("gen AS", "gen_all AS"), *_ENRICHED,
                                GENRES_SUMMARY, CAST, CREW, DIRECTOR, TOPCAST, CREDITS_SUMMARY, DIM) + "SELECT * FROM dim",
    "daily_backfill_fact": _with(EV, STG_TRENDING_ITEM) + _FACT,
    "raw_complete_gate": _with(EV, LATEST, DETAILS, LINES)
        + """, flags AS (
               SELECT EXISTS (SELECT 1 FROM det d
                              WHERE d.tmdb_id = lk.tmdb_id AND d.media_type = lk.media_type) AS has_details,
                      EXISTS (SELECT 1 FROM li c
                              WHERE c.tmdb_id = lk.tmdb_id AND c.media_type = lk.media_type) AS has_credits
               FROM lk)
             SELECT count(*) AS latest_keys,
                    count(*) FILTER (WHERE NOT has_details) AS missing_details,
                    count(*) FILTER (WHERE NOT has_credits) AS missing_credits,
                    count(*) FILTER (WHERE NOT has_details) = 0
                      AND count(*) FILTER (WHERE NOT has_credits) = 0 AS raw_complete
             FROM flags""",
    "keyed_replace": _with(EV, LATEST, DETAILS, LINES, ASOF)
        + """SELECT tmdb_id, media_type, title, load_ts FROM det_asof
             WHERE (tmdb_id, media_type) NOT IN (SELECT tmdb_id, media_type FROM lk
                                                 INTERSECT SELECT tmdb_id, media_type FROM det)
             UNION ALL
             SELECT d.tmdb_id, d.media_type, d.title,
                    (SELECT CAST(d AS TIMESTAMP) FROM latest) + INTERVAL 6 HOUR AS load_ts
             FROM det d
             WHERE (d.tmdb_id, d.media_type) IN (SELECT tmdb_id, media_type FROM lk)""",
    "replay_routing": """WITH inv AS (SELECT DISTINCT CAST(ts AS DATE) AS d FROM events),
bounds AS (SELECT min(d) AS lo, max(d) AS hi FROM inv),
req AS (SELECT CAST(unnest(generate_series(CAST(lo - 1 AS TIMESTAMP), CAST(hi + 2 AS TIMESTAMP), INTERVAL 1 DAY)) AS DATE) AS requested_date FROM bounds)
SELECT r.requested_date, inv.d IS NOT NULL AS snapshot_exists,
       CASE WHEN inv.d IS NOT NULL THEN 'replay'
            WHEN r.requested_date = (SELECT hi + 1 FROM bounds) THEN 'fetch'
            ELSE 'fail' END AS action
FROM req r LEFT JOIN inv ON r.requested_date = inv.d""",
    "snapshot_roundtrip": _with(EV, STG_TRENDING_ALL) + _FACT,
    "load_once_stream": _with(EV, STG_TRENDING_ALL) + _FACT,
    "daily_dim_content": _dim(STG_TRENDING_ITEM),
    "daily_fct_trending": _with(EV, STG_TRENDING_ITEM) + _FACT,
    "dq_not_null": _dq_not_null(),
    "dq_unique": _dq_unique(),
}

# --- the stored side ---------------------------------------------------------
_BEFORE_LAST = "WHERE trending_date < (SELECT max(snapshot_date) FROM ev)"
# every trending title has been fetched under its key's name, for the titles of the last two days
_GATED = """days AS (SELECT DISTINCT snapshot_date AS d FROM ev ORDER BY d DESC LIMIT 2),
wanted AS (SELECT DISTINCT tmdb_id, item_type AS media_type FROM ev WHERE snapshot_date IN (SELECT d FROM days) AND item_type IN ('movie', 'tv')),
det AS (SELECT tmdb_id, media_type, 'Title ' || media_type || ' ' || tmdb_id AS title, NULL::VARCHAR AS original_title,
  NULL::VARCHAR AS original_language, NULL::DATE AS release_date, NULL::BIGINT AS runtime, NULL::VARCHAR AS imdb_id FROM wanted),
cs AS (SELECT tmdb_id, media_type, 'Director of ' || tmdb_id AS director_name, NULL::VARCHAR AS top_cast FROM wanted),
gs AS (SELECT tmdb_id, media_type, NULL::VARCHAR AS genres FROM wanted),
st AS (SELECT * FROM st_all WHERE trending_date IN (SELECT d FROM days))"""

def _dq_all() -> str:
    ctes = [EV, STG_TRENDING_ALL, *_DETAIL_MODELS, *_CREDIT_MODELS, DIM]
    return (_with(*ctes, f"nn AS ({_dq_not_null().split(_with(*ctes))[1]})", f"uq AS ({_dq_unique().split(_with(*ctes))[1]})")
            + """SELECT 'not_null' AS "check", model, column_name AS columns, 0 AS failing_groups, failing_rows FROM nn
UNION ALL SELECT 'unique', model, key_columns, failing_groups, failing_rows FROM uq""")


ORACLE_SQL.update({
    "dq_all": _dq_all(),
    "stored_replace_after_crash": ORACLE_SQL["keyed_replace"],
    "credits_summary_split": ORACLE_SQL["credits_summary"],
    "raw_tables_by_name": _with(EV, DETAILS, LINES)
        + """SELECT d.tmdb_id, d.media_type, d.load_ts, c.pages, (SELECT count(DISTINCT snapshot_date) FROM ev) AS days
             FROM det d LEFT JOIN (SELECT tmdb_id, media_type, count(DISTINCT l_orderkey // 4096) AS pages FROM li GROUP BY ALL) c
             ON c.tmdb_id = d.tmdb_id AND c.media_type = d.media_type""",
    "copartitioned_dim": _dim(STG_TRENDING_ITEM),
    "indexed_missing_details": ORACLE_SQL["missing_keys_details"],
    "indexed_missing_credits": ORACLE_SQL["missing_keys_credits"],
    "missing_keys_sorted": _with(EV, LATEST, DETAILS, LINES, ASOF)
        + """SELECT tmdb_id, media_type, row_number() OVER (ORDER BY tmdb_id, media_type) AS place FROM (
               SELECT tmdb_id, media_type FROM lk EXCEPT SELECT tmdb_id, media_type FROM det_asof)""",
    "latest_keys_of_mixed_snapshots": _with(EV)
        + """SELECT DISTINCT tmdb_id, item_type AS media_type FROM ev WHERE item_type IN ('movie', 'tv')
             AND snapshot_date = (SELECT DISTINCT snapshot_date FROM ev ORDER BY 1 DESC LIMIT 1 OFFSET 2)""",
    "stamped_fact": _with(EV, STG_TRENDING_ALL)
        + """SELECT trending_date + 1 AS trending_date, time_window, tmdb_id, media_type, popularity, vote_count, vote_average, load_ts FROM st""",
    "stamped_now": _with(EV)
        + """SELECT CAST(now() AT TIME ZONE 'UTC' AS DATE) AS trending_date, CAST(now() AT TIME ZONE 'UTC' AS DATE) AS load_date,
             tmdb_id, value AS popularity FROM ev""",
    "routing_today": """WITH d AS (SELECT DISTINCT CAST(ts AS DATE) AS d FROM events), t AS (SELECT CAST(now() AT TIME ZONE 'UTC' AS DATE) AS t)
SELECT d AS requested_date, TRUE AS snapshot_exists, 'replay' AS action FROM d
UNION ALL SELECT t, FALSE, 'fetch' FROM t WHERE t NOT IN (SELECT d FROM d)
UNION ALL SELECT t + 1, FALSE, 'fail' FROM t""",
    "redelivered_stream": _with(EV, STG_TRENDING_ALL) + _FACT,
    "streamed_keyed_load": ORACLE_SQL["keyed_replace"],
    "named_documents": _with(EV, STG_TRENDING_ALL) + _FACT,
    "repaired_documents": _with(EV, STG_TRENDING_ALL) + "SELECT trending_date, tmdb_id, title || chr(65533) AS title FROM st",
    "malformed_load": _with(EV, STG_TRENDING_ALL) + _FACT + " " + _BEFORE_LAST,
    "gated_daily_dim": _with(EV, STG_TRENDING_ITEM.replace("st AS", "st_all AS"), _GATED, DIM) + "SELECT * FROM dim",
})
