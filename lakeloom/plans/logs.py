"""Access logs and HTML pages."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakeloom.functions.text import LOG_LINE
from lakeloom.operators.lookup import expression_list
from lakeloom.operators.weblogs import largest_responses, parse_log, parse_log_map, top_counts
from lakeloom.plans.registry import query
from lakeloom.sources.html import page_links, page_titles
from lakeloom.sources.tables import Tables


def log_lines(t: Tables) -> DataFrame:
    """Every event as one log line. Cheap events give malformed lines, clicks have no
    size and sign-ups no protocol, so each case of the parser occurs."""
    kind = F.col("event_type")
    line = F.concat(
        F.lit("h"), F.col("user_id"), F.lit(".example.net - - ["),
        F.date_format("ts", "dd/MMM/yyyy:HH:mm:ss"), F.lit(' +0000] "'),
        F.when(kind == "purchase", "POST").otherwise("GET"),
        F.lit(" /"), kind, F.lit("/"), F.get_json_object("props", "$.k"),
        F.when(kind == "signup", "").otherwise(" HTTP/1.0"), F.lit('" '),
        F.when(kind == "error", "500").otherwise("200"), F.lit(" "),
        F.when(kind == "click", "-").otherwise(F.floor(F.col("value") * 100).cast("string")),
    )
    broken = F.concat(F.lit("garbled "), F.col("event_id"))
    return t.events.select("event_id", F.when(F.col("value") < 1, broken).otherwise(line).alias("value"))


_LINES = """
    SELECT event_id, CASE WHEN value < 1 THEN 'garbled ' || event_id ELSE
        'h' || user_id || '.example.net - - [' || strftime(ts, '%d/%b/%Y:%H:%M:%S') || ' +0000] "'
        || CASE event_type WHEN 'purchase' THEN 'POST' ELSE 'GET' END
        || ' /' || event_type || '/' || (props->>'$.k')
        || CASE event_type WHEN 'signup' THEN '' ELSE ' HTTP/1.0' END || '" '
        || CASE event_type WHEN 'error' THEN '500' ELSE '200' END || ' '
        || CASE event_type WHEN 'click' THEN '-' ELSE CAST(CAST(floor(value * 100) AS BIGINT) AS VARCHAR) END
        END AS line FROM events"""


def _group(n: int) -> str:
    return f"CASE WHEN ok THEN regexp_extract(line, '{LOG_LINE}', {n}) END"


_PARSED = f"""
    SELECT event_id, {_group(1)} AS host, {_group(4)} AS date_time, {_group(5)} AS "method", {_group(6)} AS endpoint,
           {_group(7)} AS protocol, {_group(8)} AS response_code,
           CAST(CASE WHEN {_group(9)} = '-' THEN '0' ELSE {_group(9)} END AS BIGINT) AS content_size_bytes,
           CASE WHEN NOT ok THEN line END AS corrupt
    FROM (SELECT event_id, line, regexp_matches(line, '{LOG_LINE}') AS ok FROM ({_LINES}))"""


@query(f"""
    SELECT event_id, host, "method", endpoint, protocol, response_code, content_size_bytes, corrupt,
           strftime(strptime(date_time, '%d/%b/%Y:%H:%M:%S +0000'), '%Y-%m-%d %H:%M:%S') AS log_time
    FROM ({_PARSED})""")
def access_log_parse(t: Tables) -> DataFrame:
    return parse_log(log_lines(t)).select(
        "event_id", "host", "method", "endpoint", "protocol", "response_code", "content_size_bytes", "corrupt",
        F.date_format("time", "yyyy-MM-dd HH:mm:ss").alias("log_time"),
    )


@query(f"""SELECT event_id, host, "method", endpoint, response_code, CAST(content_size_bytes AS VARCHAR) AS content_size
    FROM ({_PARSED})""")
def access_log_map(t: Tables) -> DataFrame:
    fields = ["host", "method", "endpoint", "response_code", "content_size"]
    return parse_log_map(log_lines(t)).selectExpr("event_id", *expression_list("parsed", fields))


def _top_sql(column: str) -> str:
    return f"""SELECT {column}, COUNT(*) AS n_rows FROM ({_PARSED}) WHERE {column} IS NOT NULL
    GROUP BY {column} ORDER BY n_rows DESC, {column} LIMIT 10"""


@query(_top_sql("host"))
def access_log_top(t: Tables) -> DataFrame:
    return top_counts(parse_log(log_lines(t)), "host", 10)


@query(_top_sql("endpoint"))
def access_log_endpoints(t: Tables) -> DataFrame:
    return top_counts(parse_log(log_lines(t)), "endpoint", 10)


@query(f"""SELECT endpoint, content_size_bytes FROM ({_PARSED})
    ORDER BY content_size_bytes DESC NULLS LAST, endpoint, host, date_time LIMIT 10""")
def access_log_largest(t: Tables) -> DataFrame:
    return largest_responses(parse_log(log_lines(t)), 10)


@query("""SELECT event_id, string_split(line, ' ')[1] AS first_token, CAST(len(string_split(line, ' ')) AS BIGINT) AS n_tokens
    FROM (""" + _LINES + ")")  # fmt: skip
def access_log_tokens(t: Tables) -> DataFrame:
    tokens = F.split("value", " ")
    return log_lines(t).select("event_id", tokens[0].alias("first_token"), F.size(tokens).cast("long").alias("n_tokens"))


def _unescaped(text: str) -> str:
    """SQL that resolves the entities of the pages. The HTML standard resolves these in
    text without the semicolon too, as where a title was cut off inside one."""
    for entity, character in (("lt", "<"), ("gt", ">"), ("quot", '"'), ("#39", "''"), ("amp", "&")):
        text = f"regexp_replace({text}, '&{entity};?', '{character}', 'g')"
    return text


@query(f"""
    SELECT page_id, {_unescaped("regexp_extract(html, '(?s)<title>(.*?)</title>', 1)")} AS title FROM pages""")
def html_titles(t: Tables) -> DataFrame:
    return page_titles(t.pages).select("page_id", "title")


@query(f"""
    SELECT page_id, CAST(pos AS INTEGER) AS pos, {_unescaped("regexp_extract(tag, 'href=\"([^\"]*)\"', 1)")} AS href,
           {_unescaped("regexp_extract(tag, '>([^<]*)$', 1)")} AS link_text FROM (
        SELECT page_id, unnest(range(len(tags))) AS pos, unnest(tags) AS tag
        FROM (SELECT page_id, regexp_extract_all(html, '<a href="[^"]*">[^<]*') AS tags FROM pages))""")
def html_links(t: Tables) -> DataFrame:
    return page_links(t.pages)
