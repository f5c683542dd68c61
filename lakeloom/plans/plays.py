"""The music-streaming star over the tables: events as play logs, parts as songs."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakeloom.functions.text import timestamp_text
from lakeloom.plans import questions, warehouse
from lakeloom.plans.registry import query
from lakeloom.session import scratch_path
from lakeloom.sinks.files import write_documents
from lakeloom.sources.tables import Tables

# The page each kind of event stands for.
PAGES = {"click": "NextSong", "purchase": "NextSong", "view": "Home", "signup": "Login", "error": "Error"}


def song_rows(t: Tables) -> DataFrame:
    """Parts as songs, the brand as artist and the price as duration."""
    return t.part.select(
        F.lit(1).alias("num_songs"),
        F.col("p_brand").alias("artist_id"),
        F.lit(None).cast("double").alias("artist_latitude"),
        F.lit(None).cast("double").alias("artist_longitude"),
        F.col("p_type").alias("artist_location"),
        F.concat(F.lit("artist of "), F.col("p_brand")).alias("artist_name"),
        F.format_string("SO%012d", F.col("p_partkey")).alias("song_id"),
        F.col("p_name").alias("title"),
        F.col("p_retailprice").alias("duration"),
        F.col("p_size").alias("year"),
    )


def log_rows(t: Tables) -> DataFrame:
    """Events as log lines. The played song is the part whose key is the event's item;
    its length has the event's value in hundredths added, so a part of the plays
    differs from the catalogue by less than a second."""
    page = F.create_map(*[F.lit(x) for pair in PAGES.items() for x in pair])[F.col("event_type")]
    events = t.events.withColumn("page", page).withColumn("item", F.get_json_object("props", "$.k").try_cast("bigint"))
    parts = t.part.select(F.col("p_partkey").alias("item"), "p_name", "p_brand", "p_retailprice")
    played = F.col("page") == warehouse.PLAY
    listened = F.when(F.col("event_type") == "click", F.col("p_retailprice")).otherwise(F.col("p_retailprice") + 0.2)
    return events.join(parts, "item", "left").select(
        F.when(played, F.concat(F.lit("artist of "), F.col("p_brand"))).alias("artist"),
        F.lit("first").alias("firstName"),
        F.lit("last").alias("lastName"),
        F.when(F.col("user_id") % 2 == 0, "F").otherwise("M").alias("gender"),
        F.when(F.col("value") > 5, "paid").otherwise("free").alias("level"),
        "page",
        F.when(played, F.col("p_name")).alias("song"),
        F.when(played, listened).alias("length"),
        F.col("user_id").alias("sessionId"),
        F.col("event_id").alias("itemInSession"),
        F.lit("San Jose, CA").alias("location"),
        F.lit("browser").alias("userAgent"),
        F.unix_millis(F.col("ts").cast("timestamp")).alias("ts"),
        F.when(F.col("page") == "Login", "").otherwise(F.col("user_id").cast("string")).alias("userId"),
    )


_SONGS = """
    SELECT printf('SO%012d', p_partkey) AS song_id, p_name AS title, p_brand AS artist_id, p_size AS "year", p_retailprice AS duration
    FROM part"""
_LOGS = """
    SELECT e.*, epoch_us(ts) // 1000 AS ms, p_name AS song, p_brand AS artist_id,
           CASE WHEN event_type = 'click' THEN p_retailprice ELSE p_retailprice + 0.2 END AS length,
           CASE WHEN value > 5 THEN 'paid' ELSE 'free' END AS "level"
    FROM events e LEFT JOIN part ON TRY_CAST(e.props->>'$.k' AS BIGINT) = p_partkey"""


@query(_SONGS)
def star_songs(t: Tables) -> DataFrame:
    return warehouse.songs(song_rows(t))


@query("""
    SELECT p_brand AS artist_id, 'artist of ' || p_brand AS "name", MIN(p_type) AS location,
           CAST(NULL AS DOUBLE) AS latitude, CAST(NULL AS DOUBLE) AS longitude FROM part GROUP BY p_brand""")
def star_artists(t: Tables) -> DataFrame:
    return warehouse.artists(song_rows(t))


@query(f"""
    SELECT user_id, 'first' AS first_name, 'last' AS last_name, gender, "level" FROM (
        SELECT user_id, CASE WHEN user_id % 2 = 0 THEN 'F' ELSE 'M' END AS gender, "level",
               ROW_NUMBER() OVER (PARTITION BY user_id ORDER BY ms DESC, event_id DESC) AS rn
        FROM ({_LOGS}) WHERE event_type IN ('click', 'purchase')) WHERE rn = 1""")
def star_users(t: Tables) -> DataFrame:
    return warehouse.users(warehouse.events_from_logs(log_rows(t)))


@query(f"""
    SELECT DISTINCT strftime(s, '%Y-%m-%d %H:%M:%S.%f') AS start_time, hour(s) AS "hour", day(s) AS "day", week(s) AS "week",
           month(s) AS "month", year(s) AS "year", dayofweek(s) AS "weekday"
    FROM (SELECT make_timestamp(ms * 1000) AS s FROM ({_LOGS}) WHERE event_type IN ('click', 'purchase'))""")
def star_times(t: Tables) -> DataFrame:
    times = warehouse.times(warehouse.events_from_logs(log_rows(t)))
    return times.withColumn("start_time", timestamp_text(F.col("start_time")))


def _plays_sql(join: str, same_length: str) -> str:
    return f"""
    SELECT md5(concat_ws('|', CAST(l.user_id AS VARCHAR), CAST(ms AS VARCHAR), CAST(event_id AS VARCHAR), CAST(l.user_id AS VARCHAR)))
             AS songplay_id, strftime(make_timestamp(ms * 1000), '%Y-%m-%d %H:%M:%S.%f') AS start_time, l.user_id, l."level",
             s.song_id, s.artist_id, l.user_id AS session_id, 'San Jose, CA' AS location, 'browser' AS user_agent,
             year(ts) AS "year", month(ts) AS "month"
    FROM ({_LOGS}) l {join} JOIN (
        SELECT title, artist_id, {same_length.format("duration")} AS len, MIN(song_id) AS song_id FROM ({_SONGS}) GROUP BY 1, 2, 3) s
      ON l.song = s.title AND l.artist_id = s.artist_id AND {same_length.format("l.length")} = s.len
    WHERE event_type IN ('click', 'purchase')"""


def _plays(t: Tables, **options) -> DataFrame:
    plays = warehouse.build_star(log_rows(t), song_rows(t), **options)["songplays"]
    return plays.withColumn("start_time", timestamp_text(F.col("start_time")))


@query(_plays_sql("LEFT", "{}"))
def star_songplays(t: Tables) -> DataFrame:
    return _plays(t)


@query(_plays_sql("", "CAST({} AS DECIMAL(18,0))"))
def star_songplays_rounded(t: Tables) -> DataFrame:
    return _plays(t, rule="title_artist_seconds", keep_unmatched=False)


@query(f"""
    SELECT 'staging_logs' AS table_name, COUNT(*) AS row_count, CAST(NULL AS BIGINT) AS published_rows FROM events
    UNION ALL SELECT 'staging_songs', COUNT(*), NULL FROM part
    UNION ALL SELECT 'songs', COUNT(*), COUNT(*) FROM part
    UNION ALL SELECT 'artists', COUNT(DISTINCT p_brand), COUNT(DISTINCT p_brand) FROM part
    UNION ALL SELECT 'users', COUNT(DISTINCT user_id), COUNT(DISTINCT user_id) FROM ({_LOGS}) WHERE event_type IN ('click', 'purchase')
    UNION ALL SELECT 'time', COUNT(DISTINCT ms), COUNT(DISTINCT ms) FROM ({_LOGS}) WHERE event_type IN ('click', 'purchase')
    UNION ALL SELECT 'songplays', COUNT(*), COUNT(*) FROM ({_LOGS}) WHERE event_type IN ('click', 'purchase')""")
def star_run_report(t: Tables) -> DataFrame:
    """The whole run: JSON in, staged, built, checked, published; rows as counted while they
    were written, beside those of the star that readers find."""
    spark = t.spark
    songs, logs, out = (scratch_path(spark, n) for n in ("song_documents", "log_documents", "star"))
    write_documents(song_rows(t), songs)
    write_documents(log_rows(t), logs)
    _, report = warehouse.run(spark, songs, logs, out)
    found = [df.agg(F.count(F.lit(1)).alias("published_rows")).withColumn("table_name", F.lit(n)) for n, df in warehouse.published_star(spark, out).items()]
    return report.join(reduce(DataFrame.unionByName, found), "table_name", "left").select("table_name", "row_count", "published_rows")


_PAGE = "CASE event_type " + " ".join(f"WHEN '{kind}' THEN '{page}'" for kind, page in PAGES.items()) + " END"


@query(f"""
    SELECT DISTINCT {_PAGE} AS page FROM events WHERE {_PAGE} NOT IN (
        SELECT {_PAGE} FROM events WHERE user_id = 8 AND event_type <> 'signup')""")
def star_pages_not_visited(t: Tables) -> DataFrame:
    return questions.pages_not_visited(log_rows(t), "8")


@query("SELECT COUNT(DISTINCT user_id) + 1 AS n_users FROM events WHERE user_id % 2 = 0")
def star_count_users(t: Tables) -> DataFrame:
    # One more than there are users: those not logged in share the empty id.
    return questions.count_users(log_rows(t), "F")


@query(f"""
    SELECT 'artist of ' || artist_id AS artist, COUNT(*) AS n_plays FROM ({_LOGS})
    WHERE event_type IN ('click', 'purchase') GROUP BY artist_id ORDER BY n_plays DESC, artist LIMIT 1""")
def star_top_artist(t: Tables) -> DataFrame:
    return questions.most_played_artist(log_rows(t))


@query(f"""
    SELECT 'artist of ' || artist_id AS artist, song, length FROM ({_LOGS})
    WHERE event_type IN ('click', 'purchase') AND user_id = 8 AND event_id = (
        SELECT MIN(event_id) FROM events WHERE user_id = 8 AND event_type = 'click')""")
def session_item_lookup(t: Tables) -> DataFrame:
    item = t.events.where("user_id = 8 and event_type = 'click'").agg(F.min("event_id")).first()[0]
    heard = questions.session_item_table(questions.clean_events(log_rows(t)))
    return heard.where(sessionId=8, itemInSession=item).select("artist", "song", "length")


@query(f"""
    SELECT event_id AS item, 'artist of ' || artist_id AS artist, song, 'first last' AS "user" FROM ({_LOGS})
    WHERE event_type IN ('click', 'purchase') AND user_id = 8 AND artist_id IS NOT NULL""")
def user_session_lookup(t: Tables) -> DataFrame:
    heard = questions.user_session_table(questions.clean_events(log_rows(t)))
    return heard.where(userId=8, sessionId=8).select(F.col("itemInSession").alias("item"), "artist", "song", "user")


@query(f"""
    SELECT DISTINCT user_id AS listener, 'first last' AS "user" FROM ({_LOGS})
    WHERE event_type IN ('click', 'purchase') AND song = (SELECT MIN(p_name) FROM part)""")
def user_song_lookup(t: Tables) -> DataFrame:
    song = t.part.agg(F.min("p_name")).first()[0]
    heard = questions.user_song_table(questions.clean_events(log_rows(t)))
    return heard.where(song=song).select(F.col("userId").alias("listener"), "user")
