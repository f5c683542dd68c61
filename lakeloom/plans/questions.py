"""Questions to the play logs, and the tables shaped for them.

Frames have the columns of ``warehouse.events_from_logs``; ``user`` columns hold text
or numbers alike.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakeloom.functions.text import full_name
from lakeloom.operators.layout import keys_of
from lakeloom.operators.lookup import QueryTable
from lakeloom.operators.windows import mean_between_markers
from lakeloom.schemas import EVENT_CSV_KEPT


def clean_events(rows: DataFrame) -> DataFrame:
    """Rows of the event files that name an artist, cut to the columns in use. A CSV
    reader gives null for an empty field, a JSON reader an empty text; both go."""
    return rows.where(F.col("artist").isNotNull() & (F.col("artist") != "")).select(*EVENT_CSV_KEPT)


def session_item_table(events: DataFrame) -> QueryTable:
    """What was heard at an item of a session."""
    columns = ["sessionId", "itemInSession", "artist", "song", "length"]
    typed = _typed(events).select(*columns)
    return QueryTable.build(typed, columns[:2], columns[2:], columns=columns)


def user_session_table(events: DataFrame) -> QueryTable:
    """Songs and listener of a user's session, in the order of items."""
    typed = _typed(events).withColumn("user", full_name("firstName", "lastName"))
    columns = ["userId", "sessionId", "itemInSession", "artist", "song", "user"]
    return QueryTable.build(typed, columns[:2], columns[2:3], written_by=["artist", "song"], columns=columns)


def user_song_table(events: DataFrame) -> QueryTable:
    """Listeners of a song. The user id is part of the key: with the song alone only
    its last listener would remain."""
    typed = _typed(events).withColumn("user", full_name("firstName", "lastName"))
    columns = ["song", "userId", "user"]
    return QueryTable.build(typed.select(*columns), columns[:1], columns[1:2], written_by=["user"], columns=columns)


def _typed(events: DataFrame) -> DataFrame:
    integers = {c: F.col(c).try_cast("bigint") for c in ("sessionId", "itemInSession", "userId")}
    return events.withColumns({**integers, "length": F.col("length").try_cast("double")})


def pages_not_visited(logs: DataFrame, user: str) -> DataFrame:
    visited = keys_of(logs.where(F.col("userId") == user), "page")
    return keys_of(logs, "page").join(visited, "page", "left_anti")


def pages_visited(logs: DataFrame, user: str) -> DataFrame:
    visited = keys_of(logs.where(F.col("userId") == user), "page")
    return keys_of(logs, "page").join(visited, "page", "left_semi")


def count_users(logs: DataFrame, gender: str) -> DataFrame:
    return logs.where(F.col("gender") == gender).agg(F.countDistinct("userId").alias("n_users"))


def most_played_artist(logs: DataFrame) -> DataFrame:
    plays = logs.where(F.col("artist").isNotNull()).groupBy("artist").agg(F.count(F.lit(1)).alias("n_plays"))
    return plays.orderBy(F.desc("n_plays"), "artist").limit(1)


def songs_between_home_visits(logs: DataFrame, frame: str = "range") -> DataFrame:
    timed = logs.withColumn("time", F.timestamp_millis(F.col("ts")))
    page = F.col("page")
    ties = ["itemInSession"] if frame == "rows" else []
    return mean_between_markers(timed, "userId", "time", page == "NextSong", page == "Home", frame=frame, ties=ties)
