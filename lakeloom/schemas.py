"""Declared schemas of the inputs and of the star (fixed values: names and types)."""

from __future__ import annotations

from pyspark.sql import types as T

_TYPES = {
    "int": T.IntegerType(),
    "bigint": T.LongType(),
    "double": T.DoubleType(),
    "string": T.StringType(),
    "date": T.DateType(),
    "timestamp": T.TimestampType(),
    "timestamp_ntz": T.TimestampNTZType(),
    "decimal(1,0)": T.DecimalType(1, 0),
    "decimal(8,2)": T.DecimalType(8, 2),
}


def _columns(text: str) -> T.StructType:
    """A schema from ``name type`` pairs. ``StructType.fromDDL`` would need a session,
    and schemas are made when the module is imported."""
    pairs = (part.split(" ") for part in text.split(", "))
    return T.StructType([T.StructField(name, _TYPES[kind]) for name, kind in pairs])


SONG = _columns(
    "num_songs int, artist_id string, artist_latitude double, artist_longitude double, artist_location string, "
    "artist_name string, song_id string, title string, duration double, year int"
)

LOG = _columns(
    "artist string, auth string, firstName string, gender string, itemInSession bigint, lastName string, length double, "
    "level string, location string, method string, page string, registration double, sessionId bigint, song string, "
    "status bigint, ts bigint, userAgent string, userId string"
)

# The columns a cleaned event keeps, in order.
EVENT_CSV_KEPT = (
    "artist", "firstName", "gender", "itemInSession", "lastName", "length", "level", "location", "sessionId", "song", "userId",
)

STAR = {
    "users": _columns("user_id bigint, first_name string, last_name string, gender string, level string"),
    "songs": _columns("song_id string, title string, artist_id string, year int, duration double"),
    "artists": _columns("artist_id string, name string, location string, latitude double, longitude double"),
    "time": _columns("start_time timestamp, hour int, day int, week int, month int, year int, weekday int"),
    "songplays": _columns(
        "songplay_id string, start_time timestamp, user_id bigint, level string, song_id string, artist_id string, "
        "session_id bigint, location string, user_agent string, year int, month int"
    ),
}

PAYMENT = _columns("payment_id int, customer_id int, staff_id int, rental_id int, amount double, payment_date date")

TICKET = _columns(
    "id double, sporting_event_id double, sport_location_id double, seat_level decimal(1,0), seat_section string, "
    "seat_row string, seat string, ticketholder_id double, ticket_price decimal(8,2)"
)

# Tables of the analytic queries. A declared schema saves the job that reads footers
# to infer one, for every table of every query.
TABLES = {
    "region": _columns("r_regionkey int, r_name string"),
    "nation": _columns("n_nationkey int, n_name string, n_regionkey int"),
    "customer": _columns("c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string"),
    "supplier": _columns("s_suppkey bigint, s_name string, s_nationkey int, s_acctbal double"),
    "part": _columns("p_partkey bigint, p_name string, p_brand string, p_type string, p_size int, p_retailprice double"),
    "orders": _columns(
        "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, o_orderdate timestamp_ntz, "
        "o_orderpriority string"
    ),
    "lineitem": _columns(
        "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, l_quantity double, "
        "l_extendedprice double, l_discount double, l_tax double, l_returnflag string, l_linestatus string, "
        "l_shipdate timestamp_ntz"
    ),
    "events": _columns("event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string"),
    "pages": _columns("page_id bigint, url string, html string"),
}
