"""A music-streaming star: songs and play logs in, four dimensions and a fact out."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lakeloom import schemas
from lakeloom.functions.text import text_key
from lakeloom.functions.times import epoch_millis
from lakeloom.operators import quality
from lakeloom.operators.dedup import dimension_rows, one_per_key
from lakeloom.operators.layout import many_to_one
from lakeloom.operators.modeling import time_dimension
from lakeloom.sinks.files import write_parquet, write_partitioned
from lakeloom.sinks.publish import Release, publish_checked, read_published
from lakeloom.sources.files import json_tree

PLAY = "NextSong"

# How a play finds its song. Durations match as given, or rounded to whole seconds.
MATCH_RULES = ("title_artist", "title_artist_duration", "title_artist_seconds")


def events_from_logs(logs: DataFrame) -> DataFrame:
    """Log rows under one naming, with typed ids and the event time. Users who are not
    logged in have an empty id in the logs and none here."""
    return logs.select(
        F.col("userId").try_cast("bigint").alias("user_id"),
        F.col("firstName").alias("first_name"),
        F.col("lastName").alias("last_name"),
        "gender",
        "level",
        "page",
        "artist",
        "song",
        "length",
        F.col("sessionId").alias("session_id"),
        F.col("itemInSession").alias("item_in_session"),
        "location",
        F.col("userAgent").alias("user_agent"),
        "ts",
        epoch_millis(F.col("ts")).alias("start_time"),
    )


def plays_of(events: DataFrame) -> DataFrame:
    return events.where(F.col("page") == PLAY)


def users(events: DataFrame, policy: str = "latest") -> DataFrame:
    attributes = ["first_name", "last_name", "gender", "level"]
    order = ["ts", "session_id", "item_in_session"]
    return dimension_rows(plays_of(events), "user_id", attributes, policy, order)


def songs(song_rows: DataFrame, policy: str = "first_sorted") -> DataFrame:
    return dimension_rows(song_rows, "song_id", ["title", "artist_id", "year", "duration"], policy)


def artists(song_rows: DataFrame, policy: str = "first_sorted") -> DataFrame:
    named = song_rows.select(
        "artist_id",
        F.col("artist_name").alias("name"),
        F.col("artist_location").alias("location"),
        F.col("artist_latitude").alias("latitude"),
        F.col("artist_longitude").alias("longitude"),
    )
    return dimension_rows(named, "artist_id", ["name", "location", "latitude", "longitude"], policy)


def times(events: DataFrame, weekday_style: str = "sunday0") -> DataFrame:
    return time_dimension(plays_of(events), "ts", weekday_style)


def _duration_key(column: str, rule: str) -> list[Column]:
    if rule == "title_artist":
        return []
    if rule == "title_artist_duration":
        return [F.col(column).alias("_duration")]
    if rule == "title_artist_seconds":
        return [F.col(column).cast("decimal(18,0)").alias("_duration")]
    raise ValueError(f"unknown match rule {rule!r}; known: {MATCH_RULES}")


def songplays(
    events: DataFrame,
    song_dim: DataFrame,
    artist_dim: DataFrame,
    rule: str = "title_artist_duration",
    keep_unmatched: bool = True,
    first_match_only: bool = True,
) -> DataFrame:
    """One row per play with the song and artist it matched.

    ``keep_unmatched`` keeps plays of unknown songs with null ids. Where several songs
    match, the one with the smallest id counts, or with ``first_match_only=False`` each
    of them gives a row. The key covers session, time and item, so plays in the same
    millisecond stay apart; exact copies of a play count once.
    """
    catalog = song_dim.join(artist_dim.select("artist_id", F.col("name").alias("_artist")), "artist_id").select(
        F.col("title").alias("_title"), "_artist", *_duration_key("duration", rule), "song_id", "artist_id"
    )
    on = [c for c in catalog.columns if c.startswith("_")]
    if first_match_only:
        catalog = one_per_key(catalog, on, ["song_id"])
    start = F.col("start_time")
    event_key = ["session_id", "ts", "item_in_session", "user_id"]
    plays = one_per_key(plays_of(events), event_key, ["song"])
    keyed = plays.select("*", F.col("song").alias("_title"), F.col("artist").alias("_artist"), *_duration_key("length", rule))
    return many_to_one(keyed, catalog, on, "left" if keep_unmatched else "inner").select(
        text_key(F.col("session_id"), F.col("ts"), F.col("item_in_session"), F.col("user_id")).alias("songplay_id"),
        "start_time",
        "user_id",
        "level",
        "song_id",
        "artist_id",
        "session_id",
        "location",
        "user_agent",
        F.year(start).alias("year"),
        F.month(start).alias("month"),
    )


def build_star(logs: DataFrame, song_rows: DataFrame, user_policy: str = "latest", **fact_options) -> dict[str, DataFrame]:
    """All five tables as lazy frames."""
    events = events_from_logs(logs)
    song_dim, artist_dim = songs(song_rows), artists(song_rows)
    return {
        "users": users(events, user_policy),
        "songs": song_dim,
        "artists": artist_dim,
        "time": times(events),
        "songplays": songplays(events, song_dim, artist_dim, **fact_options),
    }


#: Key of each table of the star.
KEYS = {"users": "user_id", "songs": "song_id", "artists": "artist_id", "time": "start_time", "songplays": "songplay_id"}


def checks_of_keys(star: dict[str, DataFrame]) -> DataFrame:
    """Keys unique, references whole."""
    reports = [quality.unique_key(star[name], name, [key]) for name, key in KEYS.items()]
    for name in ("users", "songs", "artists", "time"):
        reports.append(quality.no_orphans(star["songplays"], "songplays", KEYS[name], star[name], KEYS[name]))
    return quality.all_of(reports)


def checks(star: dict[str, DataFrame]) -> DataFrame:
    """Rows present and ids not null, in one scan of each table, keys and references."""
    present = [quality.in_one_scan(star[name], name, [quality.rows_there(), quality.null_free(key)]) for name, key in KEYS.items()]
    return quality.all_of([*present, checks_of_keys(star)])


def watched(star: dict[str, DataFrame]) -> dict[str, quality.Observed]:
    """Checks that are taken in the passes that write the tables."""
    return {name: quality.Observed(name, [quality.rows_there(), quality.null_free(KEYS[name])]) for name in star}


def run(
    spark: SparkSession,
    song_root: str,
    log_root: str,
    out: str,
    song_folders: Sequence[str] = ("year",),
    keep: int = 2,
    **options,
) -> tuple[dict[str, DataFrame], DataFrame]:
    """Stage, build, write, check, publish; returns the published star and its load report.

    The JSON files are parsed once and staged as Parquet, from which every table reads
    just its columns. Rows are counted and nulls are looked for in the passes that write;
    keys and references are checked on the stored tables. All of it happens in a version
    of its own, and only then do readers (``published_star``) get to see it; if a check
    fails they keep the version before. ``song_folders`` may name ``artist_id`` too, which
    gives a folder per artist and suits small catalogues only.
    """
    sources = {"staging_songs": (song_root, schemas.SONG), "staging_logs": (log_root, schemas.LOG)}
    folders = {"songs": list(song_folders), "time": ["year", "month"], "songplays": ["year", "month"]}
    observed: dict[str, quality.Observed] = {}

    def build(release: Release) -> dict[str, DataFrame]:
        staged = {}
        for name, (root, schema) in sources.items():
            observed[name] = quality.Observed(name)
            write_parquet(json_tree(spark, root, schema), release.table(name), watch=observed[name])
            staged[name] = spark.read.schema(schema).parquet(release.table(name))
        star = build_star(staged["staging_logs"], staged["staging_songs"], **options)
        observed.update(watched(star))
        stored = {}
        for name, rows in star.items():
            if name in folders:
                write_partitioned(rows, release.table(name), folders[name], watch=observed[name])
            else:
                write_parquet(rows, release.table(name), watch=observed[name])
            stored[name] = spark.read.schema(rows.schema).parquet(release.table(name)).select(*rows.columns)
        return stored

    def checked(stored: dict[str, DataFrame]) -> DataFrame:
        return quality.all_of([*[observed[name].report() for name in stored], checks_of_keys(stored)])

    stored, _ = publish_checked(spark, out, build, checked, keep)
    return stored, quality.observed_counts(spark, list(observed.values()))


def published_star(spark: SparkSession, out: str) -> dict[str, DataFrame]:
    """The star that was published last, all tables of one run."""
    return read_published(spark, out, schemas.STAR)
