"""JSON lines held as text, URLs and credentials."""

import json

import pytest
from pyspark.sql import functions as F

from tidemark import operators as ops
from tidemark.functions import json_field, json_is_bad, month_number, redact, redact_columns, split_url


def profile(spark, lines, field="v", kind="integer"):
    df = spark.createDataFrame([(line,) for line in lines], "line string")
    return ops.profile_lines(df, "line", field, kind).first()


@pytest.mark.parametrize("n_blank", [0, 1, 4])
@pytest.mark.parametrize("n_objects", [0, 2, 5])
def test_blank_lines_are_not_counted(spark, n_blank, n_objects):
    blanks = ["", " \t ", "\t", "      "][:n_blank]
    objects = [f'{{"height": {h}}}' for h in range(n_objects)]
    assert profile(spark, blanks + objects + blanks)["n_lines"] == n_objects


@pytest.mark.parametrize(
    "values, expected",
    [
        ([str(n * n - 40) for n in range(12)], "81"),
        (["-271", "-28", "-1828"], "-28"),
        (["31", "4", "159"], "159"),
        ([str(2**64 - 1), str(2**63)], str(2**64 - 1)),
        (['"62"', "8", "[910]", '{"deep": 77}', "false"], "62"),
        (["44.75", "12"], "12"),
        (["null", "true", '"tall"'], None),
    ],
)
def test_integer_maximum(spark, values, expected):
    found = profile(spark, [f'{{"height":{value}}}' for value in values], "height")["max_value"]
    assert (None if found is None else str(found)) == expected


def test_datetimes_compare_in_time(spark):
    times = ["1999-12-31 23:59:58", "2031-07-04 06:15:00", "2031-07-04 06:14:59", "soon"]
    lines = [f'{{"seen":"{t}"}}' for t in times]
    assert str(profile(spark, lines, "seen", "datetime")["max_value"]) == "2031-07-04 06:15:00"


ONE_VALUE = ['{"height":1}', " [1, 2] ", "17", '"text"', "null", '{"a":{"b":[{}]}}', '"]"', '{"v":"}"}', "\t-2.5e3\t"]
NOT_ONE = ['{"height":5}{"height":9}', '{"height":5} junk}', "[1] x", "1 2", "1,2", "1]", "1}", "1],[2", '1,"w":2', '1},{"v":2',
           '"a" "b"', "{", "]", "tall", '{"a":1,}', "1 ] }", "nullnull", '{"a":1}]', '{"a":1}}']


def test_a_line_is_one_value_and_nothing_else(spark):
    lines = spark.createDataFrame([(x,) for x in ONE_VALUE + NOT_ONE], "line string")
    bad = {r["line"]: r["bad"] for r in lines.select("line", json_is_bad("line").alias("bad")).collect()}
    assert bad == {x: False for x in ONE_VALUE} | {x: True for x in NOT_ONE}
    assert profile(spark, NOT_ONE, "height")["max_value"] is None
    for line in ONE_VALUE:
        json.loads(line)
    for line in NOT_ONE:
        with pytest.raises(ValueError):
            json.loads(line)


def test_malformed_lines_are_skipped_and_counted(spark):
    got = profile(spark, ["not-json", '{"v":5}', '{"v":3}', '{"v":9} rest', '{"v":8', "", '{"w":7}'])
    assert (got["n_lines"], got["n_bad"], str(got["max_value"])) == (6, 3, "5")


def test_a_string_field_is_never_an_object(spark):
    df = spark.createDataFrame([('{"a":{"b":1}}',), ('{"a":"x"}',), ('{"a":true}',), ('{"a":4}',)], "line string")
    assert [r[0] for r in df.select(json_field("line", "a")).collect()] == [None, "x", None, "4"]


WHOLE = {"scheme": "lake", "user": "reader", "password": "s3same", "host": "db7.internal", "port": "5439", "path": "/harbour"}


def url_of(parts: dict) -> str:
    login = parts["user"] + (f":{parts['password']}" if parts["password"] else "")
    port = f":{parts['port']}" if parts["port"] else ""
    return f"{parts['scheme']}://{login}{'@' if login else ''}{parts['host']}{port}{parts['path']}?tz=UTC"


#: Each part is taken away in turn; what stands after it in the order of checks does not matter.
URLS = {
    url_of(WHOLE): None,
    url_of(WHOLE | {"scheme": "river"}): "wrong_scheme",
    url_of(WHOLE | {"host": ""}): "missing_host",
    url_of(WHOLE | {"port": ""}): "missing_port",
    url_of(WHOLE | {"port": "65535"}): None,
    url_of(WHOLE | {"port": "65536"}): "missing_port",
    url_of(WHOLE | {"port": "99999999999"}): "missing_port",
    url_of(WHOLE | {"user": "", "password": ""}): "missing_user",
    url_of(WHOLE | {"password": ""}): "missing_password",
    url_of(WHOLE | {"path": ""}): "missing_path",
    url_of(WHOLE | {"path": "/"}): "missing_path",
    "just words": "invalid_url",
}


def parts(spark, urls, scheme=None):
    df = spark.createDataFrame([(u,) for u in urls], "url string")
    return {r["url"]: r for r in df.select("url", split_url("url", scheme).alias("p")).select("url", "p.*").collect()}


def test_the_first_missing_part_is_named(spark):
    assert {u: r["error"] for u, r in parts(spark, URLS, "lake").items()} == URLS


def test_all_parts(spark):
    url = "Lake://writer:%5Bopen%5D+%qq@west.internal:7001/tides/low?mode=ro&n=2#top"
    row = parts(spark, [url])[url]
    assert (row["scheme"], row["user"], row["host"], row["port"]) == ("lake", "writer", "west.internal", 7001)
    assert (row["password"], row["path"], row["query"], row["error"]) == ("[open]+%qq", "/tides/low", "mode=ro&n=2", None)
    six = "store://u:a@b:c@[::1]:80/d"
    row = parts(spark, [six])
    assert (row[six]["password"], row[six]["host"], row[six]["port"]) == ("a@b:c", "[::1]", 80)


def test_malformed_escapes_stay(spark):
    url, mixed = "store://u:100%@h:1/d", "store://u:a%40b%zz+%2b@h:1/d"
    found = parts(spark, [url, mixed])
    assert (found[url]["password"], found[mixed]["password"]) == ("100%", "a@b%zz++")


@pytest.mark.parametrize(
    "text, masked, n",
    [
        ("GET /?user=a&password=abc&x=1", "GET /?user=a&password=***&x=1", 1),
        ("(password=abc) and password=d e", "(password=***) and password=*** e", 2),
        ("password=", "password=***", 1),
        ("store://u:p@h:1/d", "store://u:*****@h:1/d", 1),
        ("a://u:p@q@h and b://v:w@i", "a://u:*****@h and b://v:*****@i", 2),
        ('<a href="http://u:p@h/">x@y</a>', '<a href="http://u:*****@h/">x@y</a>', 1),
        ("http://host:80/a@b and nothing else", "http://host:80/a@b and nothing else", 0),
        ("", "", 0),
    ],
)
def test_redaction(spark, text, masked, n):
    row = redact_columns(spark.createDataFrame([(text,)], "t string"), ["t"]).first()
    assert (row["t"], row["n_redacted"]) == (masked, n)


def test_redaction_of_other_keys_and_nulls(spark):
    df = spark.createDataFrame([("token=abc password=x",), (None,)], "t string")
    rows = [r[0] for r in df.select(redact("t", ["token"])).collect()]
    assert rows == ["token=*** password=x", None]
    assert [r["n_redacted"] for r in redact_columns(df, ["t"], ["token"]).collect()] == [1, 0]


def test_keys_are_taken_literally(spark):
    df = spark.createDataFrame([("a.b=1 axb=2 a+=3",)], "t string")
    assert df.select(redact("t", ["a.b", "a+"])).first()[0] == "a.b=*** axb=2 a+=***"


def test_month_number(spark):
    df = spark.sql("SELECT date'2024-03-09' AS d")
    assert df.select(month_number("d")).first()[0] == 202403
    assert df.select(F.col("d"), month_number(F.col("d")).alias("m")).columns == ["d", "m"]
