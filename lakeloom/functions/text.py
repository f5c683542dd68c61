"""Text expressions: keys, splitting, cleaning, log-line parsing."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Common Log Format (fixed values): nine groups, named below. The tail of the line is
# matched too, so a replacement of the match leaves only the groups.
LOG_FIELDS = (
    "host", "client_identd", "user_id", "date_time", "method", "endpoint", "protocol", "response_code", "content_size",
)
LOG_LINE = r'^(\S+) (\S+) (\S+) \[([\w:/]+\s[+\-]\d{4})\] "(\S+) (\S+)\s*(\S*)" (\d{3}) (\S+)'
LOG_TIME = "dd/MMM/yyyy:HH:mm:ss Z"


def full_name(*parts: Column | str) -> Column:
    """Parts joined by one blank; null parts are skipped."""
    return F.concat_ws(" ", *parts)


def text_key(*parts: Column, sep: str = "|") -> Column:
    """md5 over the parts as text. The separator keeps ('ab','c') and ('a','bc') apart; a
    separator or backslash inside a part is escaped, so no two lists of parts share a key.
    A null part has its own mark, which no text can spell, and does not make the key null."""

    def escaped(part: Column) -> Column:
        return F.replace(F.replace(part.cast("string"), F.lit("\\"), F.lit("\\\\")), F.lit(sep), F.lit("\\" + sep))

    marked = [F.coalesce(escaped(p), F.lit("\\N")) for p in parts]
    return F.md5(F.concat_ws(sep, *marked))


def timestamp_text(c: Column) -> Column:
    """One fixed spelling of a timestamp, to hash or compare as text."""
    return F.date_format(c, "yyyy-MM-dd HH:mm:ss.SSSSSS")


def integer_or_null(c: Column, type_name: str = "int") -> Column:
    return c.try_cast(type_name)


def zero_for_dash(c: Column) -> Column:
    return F.when(c == "-", F.lit("0")).otherwise(c)


def log_fields(line: Column) -> Column:
    """The nine fields of a log line as an array; null for a line of another shape.

    The pattern runs once per line: the match is replaced by its groups with line
    breaks between them, and a log line holds no line break of its own.
    """
    groups = "\n".join(f"${i + 1}" for i in range(len(LOG_FIELDS)))
    fields = F.split(F.regexp_replace(line, f"(?s){LOG_LINE}.*$", groups), "\n")
    one_line = F.when(~F.contains(line, F.lit("\n")), fields)
    # The one-element array lets the size test see the result without computing it again.
    return F.get(F.filter(F.array(one_line), lambda f: F.size(f) == len(LOG_FIELDS)), F.lit(0))


def log_map(line: Column) -> Column:
    """The fields of a log line as map<string,string>; null for a malformed line."""
    fields = log_fields(line)
    keys = F.array(*[F.lit(k) for k in LOG_FIELDS])
    return F.transform_values(
        F.map_from_arrays(keys, fields), lambda k, v: F.when(k == "content_size", zero_for_dash(v)).otherwise(v)
    )
