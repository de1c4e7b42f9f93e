"""Intermediate models M6 (credits summary) and M7 (genres summary).

The credits summary needs, per content key: the alphabetically first
director (with that row's ``load_ts``), the names of cast members at order
0-2 joined by ``', '``, and every key that has any cast or crew row. All
three come out of ONE aggregation over ``crew UNION ALL cast`` grouped by the
key: one shuffle, partial aggregation before it, and no joins -- instead of
a window, an aggregate, a distinct union and two joins.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from snapreel.functions.aggregates import first_by_name, ordered_listagg, split_listagg
from snapreel.functions.variant import flatten, outer, vget, vnum, vstr
from snapreel.operators.joins import broadcast_if_small, match, restrict_to
from snapreel.session import stage

KEY = ["tmdb_id", "media_type"]
DIRECTOR_JOB = "Director"   # fixed value, case-sensitive
TOP_CAST_MAX_ORDER = 2      # fixed value: orders 0, 1, 2


def _people(stg_cast: DataFrame, stg_crew: DataFrame) -> DataFrame:
    crew = stg_crew.select(*KEY, "person_name", "load_ts", "job",
                           F.lit(None).cast("decimal(38,0)").alias("cast_order"),
                           F.lit(False).alias("is_cast"))
    cast = stg_cast.select(*KEY, "person_name", "load_ts",
                           F.lit(None).cast("string").alias("job"),
                           "cast_order", F.lit(True).alias("is_cast"))
    return crew.unionByName(cast)


_TOP_CAST_ROW = f"is_cast AND cast_order <= {TOP_CAST_MAX_ORDER}"


def _director_col():
    return first_by_name("person_name", ["load_ts"], where=F.col("job") == DIRECTOR_JOB)


def _top_cast_col():
    return ordered_listagg("person_name", ["cast_order", "person_name"], where=_TOP_CAST_ROW)


def people_from_raw(raw_credits: DataFrame) -> DataFrame:
    """The cast and crew rows that M6 depends on, of every credits document, from ONE scan.

    These are the rows of ``stg_credits_cast`` and ``stg_credits_crew`` (each list
    flattened with the same semantics) that are top cast or a director and, so
    that every key stays, the first entry of a document's cast or, where no cast
    is seen, of its crew. The raw table is read and its payload decoded once.
    """
    p = F.col("payload")
    lists = F.array(F.struct(F.lit(True).alias("is_cast"), F.lit(True).alias("marks"), vget(p, "cast").alias("members")),
                    F.struct(F.lit(False).alias("is_cast"), vget(p, "cast[0]").isNull().alias("marks"), vget(p, "crew").alias("members")))
    both = raw_credits.select(*KEY, "load_ts", F.inline(lists))
    flat = flatten(both, outer("members"), [*KEY, "load_ts", "is_cast", "marks"], "m", "pos")
    m = F.col("m")
    people = flat.select(*KEY, vstr(m, "name").alias("person_name"), "load_ts",
                         F.when(~F.col("is_cast"), vstr(m, "job")).alias("job"),
                         F.when(F.col("is_cast"), vnum(m, "order")).alias("cast_order"),
                         "is_cast", (F.col("marks") & (F.col("pos") == 0)).alias("marks"))
    needed = [F.col("marks"), F.expr(_TOP_CAST_ROW), F.col("job") == DIRECTOR_JOB]
    return people.where(reduce(lambda a, b: a | b, (F.coalesce(n, F.lit(False)) for n in needed))).drop("marks")


def credits_summary(stg_cast: DataFrame, stg_crew: DataFrame) -> DataFrame:
    """M6 ``int_tmdb_credits_summary``: (tmdb_id, media_type, director_name, top_cast, load_ts).

    ``load_ts`` is the chosen director row's, so NULL when there is no director.
    A key with a NULL part is kept but, as with an equality join, gets no
    director and no top cast.
    """
    return summarise_people(_people(stg_cast, stg_crew))


def credits_summary_from_raw(raw_credits: DataFrame) -> DataFrame:
    """M6 straight from the raw credits table with a single scan (see :func:`people_from_raw`)."""
    return summarise_people(people_from_raw(raw_credits))


def summarise_people(people: DataFrame) -> DataFrame:
    """The M6 aggregation over cast-and-crew rows: one shuffle on the key."""
    agg = (people
           .groupBy(*KEY)
           .agg(_director_col().alias("d"), _top_cast_col().alias("top_cast")))
    whole_key = F.col(KEY[0]).isNotNull() & F.col(KEY[1]).isNotNull()
    return agg.select(*KEY,
                      F.when(whole_key, F.col("d.person_name")).alias("director_name"),
                      F.when(whole_key, F.col("top_cast")).alias("top_cast"),
                      F.when(whole_key, F.col("d.load_ts")).alias("load_ts"))


HOT_PAGES = 16      # titles of more pages (65,536 orders) are looked at: one of
HOT_PEOPLE = 65536  # more people than this has its names aggregated in ranges


def credits_summary_split(raw_credits: DataFrame, pieces: int) -> DataFrame:
    """M6 for titles of any size: the names of a title's top cast are aggregated in ordered
    ranges on many tasks; the director is a minimum, which aggregates before the shuffle. The rows
    are written once: the ranges' bounds, the ranges and the directors would each build them anew."""
    return _split_people(stage(people_from_raw(raw_credits), "people"), pieces)


def _split_people(people: DataFrame, pieces: int) -> DataFrame:
    named = split_listagg(people.where(_TOP_CAST_ROW), KEY, "person_name", ["cast_order", "person_name"], "top_cast", pieces)
    directors = people.groupBy(*KEY).agg(_director_col().alias("d"))
    whole_key = F.col(f"d.{KEY[0]}").isNotNull() & F.col(f"d.{KEY[1]}").isNotNull()
    same = [F.col(f"d.{k}") == F.col(f"n.{k}") for k in KEY]               # a key with a NULL part gets no names
    return directors.alias("d").join(named.alias("n"), same[0] & same[1], "left").select(
        *[F.col(f"d.{k}").alias(k) for k in KEY], F.when(whole_key, F.col("d.d.person_name")).alias("director_name"),
        F.col("n.top_cast").alias("top_cast"), F.when(whole_key, F.col("d.d.load_ts")).alias("load_ts"))


def credits_summary_of_any(raw_credits: DataFrame) -> DataFrame:
    """M6 from a stored raw table: one aggregation, but for titles of more than ``HOT_PEOPLE`` people.

    Where a title has more than ``HOT_PAGES`` pages, the people are written once and counted by title:
    many pages may hold few people each, and such titles are aggregated like all others.
    """
    if raw_credits.where(F.col("pages") > HOT_PAGES).select("pages").first() is None:      # reads one narrow column
        return credits_summary_from_raw(raw_credits)
    people = stage(people_from_raw(raw_credits), "people")
    hot = stage(people.groupBy(*KEY).count().where(F.col("count") > HOT_PEOPLE).select(*KEY), "hot-titles")
    if hot.first() is None:
        return summarise_people(people)
    pieces = int(raw_credits.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    rest = match(people, broadcast_if_small(hot), KEY, "left_anti")
    return summarise_people(rest).unionByName(_split_people(restrict_to(people, hot, KEY), pieces))


def first_director(stg_crew: DataFrame) -> DataFrame:
    """W1 + O1: per key with a Director row, the first director by name and its load_ts."""
    agg = (stg_crew.where(F.col("job") == DIRECTOR_JOB)
           .groupBy(*KEY).agg(first_by_name("person_name", ["load_ts"]).alias("d")))
    return agg.select(*KEY, F.col("d.person_name").alias("director_name"),
                      F.col("d.load_ts").alias("load_ts"))


def top_cast(stg_cast: DataFrame) -> DataFrame:
    """P5 + A2 + O2: per key with cast at order <= 2, their names in order."""
    return (stg_cast.where(F.col("cast_order") <= TOP_CAST_MAX_ORDER)
            .groupBy(*KEY)
            .agg(ordered_listagg("person_name", ["cast_order", "person_name"]).alias("top_cast")))


def credits_keys(stg_cast: DataFrame, stg_crew: DataFrame) -> DataFrame:
    """U1 + A5: distinct keys that have any cast or crew row."""
    return stg_crew.select(*KEY).unionByName(stg_cast.select(*KEY)).distinct()


def genres_summary(stg_genres: DataFrame) -> DataFrame:
    """M7 ``int_tmdb_genres_summary``: genre names sorted and joined, duplicates kept."""
    return (stg_genres.groupBy(*KEY)
            .agg(ordered_listagg("genre_name", ["genre_name"]).alias("genres")))
