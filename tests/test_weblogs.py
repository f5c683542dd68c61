import datetime as dt
import random
import re

import pytest
from conftest import plan_text, rows
from pyspark.sql import functions as F

from lakeloom.functions.text import LOG_LINE, log_fields
from lakeloom.operators.lookup import expression_list
from lakeloom.operators.weblogs import largest_responses, parse_log, parse_log_map, top_counts
from lakeloom.session import scratch_path
from lakeloom.sources.files import text_lines

LINES = [
    '199.72.81.55 - - [01/Jul/1995:00:00:01 -0400] "GET /history/apollo/ HTTP/1.0" 200 6245',
    'unicomp6.unicomp.net - - [01/Jul/1995:00:00:06 -0400] "GET /shuttle/countdown/ HTTP/1.0" 200 10',
    '199.72.81.55 - - [01/Jul/1995:00:00:09 -0400] "GET /history/apollo/ HTTP/1.0" 304 -',
    'burger.letters.com - - [01/Jul/1995:00:00:11 -0400] "GET /images/ksclogo.gif" 200 9 "http://ref/" agent',
    "this line is broken",
    "",
]


@pytest.fixture(scope="module")
def lines(spark):
    return spark.createDataFrame([(x,) for x in LINES], "value string")


@pytest.fixture(scope="module")
def parsed(lines):
    return parse_log(lines)


def test_fields(parsed):
    first = parsed.where("host = '199.72.81.55' and response_code = '200'").first()
    assert (first.method, first.endpoint, first.protocol, first.content_size_bytes) == ("GET", "/history/apollo/", "HTTP/1.0", 6245)
    assert (first.client_identd, first.user_id) == ("-", "-")
    assert parsed.where(F.col("time") == F.lit(dt.datetime(1995, 7, 1, 4, 0, 1))).count() == 1


def test_special_cases(parsed):
    assert rows(parsed.where("protocol = ''"), "endpoint", "content_size_bytes") == [("/images/ksclogo.gif", 9)]
    assert rows(parsed.where("response_code = '304'"), "content_size", "content_size_bytes") == [("0", 0)]
    assert rows(parsed.where("corrupt is not null"), "corrupt", "host") == [("", None), ("this line is broken", None)]


def test_reports(parsed):
    assert rows(top_counts(parsed, "host", 1)) == [("199.72.81.55", 2)]
    assert [r.content_size_bytes for r in largest_responses(parsed, 3).collect()] == [6245, 10, 9]


def test_map(lines):
    mapped = parse_log_map(lines)
    assert mapped.where("parsed is null").count() == 2
    named = mapped.selectExpr(*expression_list("parsed", ["host", "content_size"]))
    assert ("199.72.81.55", "0") in rows(named)


def test_from_gzip_text(spark, lines):
    path = scratch_path(spark, "log_text")
    lines.write.option("compression", "gzip").text(path)
    assert parse_log(text_lines(spark, path)).where("corrupt is null").count() == 4


def test_stays_in_the_jvm(parsed):
    assert "Python" not in plan_text(parsed)


def test_same_fields_as_one_search_per_line(spark):
    """The one-pass parser against Python's ``re`` on lines of random pieces."""
    rng = random.Random(11)
    pieces = [
        "h.net", "-", "u", "[01/Jul/1995:00:00:01 -0400]", "[x]", '"GET /a HTTP/1.0"', '"GET /a"', '"GET /a b c"', '"GET"', '"', "200",
        "20", "7", "$1", "\\", "", "\t", "é", '"POST /$2\\n/ x"', "12345", "[01/Jul/1995:00:00:01 +0000]",
    ]
    good = 'h.net - {} [01/Jul/1995:00:00:01 -0400] "GET {} {}" 200 {}'
    lines = [" ".join(rng.choice(pieces) for _ in range(rng.randint(1, 9))) for _ in range(3000)]
    lines += [good.format(*(rng.choice(pieces) for _ in range(4))) for _ in range(2000)]
    df = spark.createDataFrame([(i, x) for i, x in enumerate(lines)], "i int, value string")
    got = {r.i: r.f for r in df.select("i", log_fields(F.col("value")).alias("f")).collect()}
    matches = [re.search(LOG_LINE, x, re.ASCII) for x in lines]
    assert sum(m is not None for m in matches) > 300
    for i, m in enumerate(matches):
        assert got[i] == (None if m is None else list(m.groups())), lines[i]
