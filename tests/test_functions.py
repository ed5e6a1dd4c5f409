"""Column functions on hand-made values."""

from datetime import datetime

import pytest
from pyspark.sql import functions as F

from tidemark.functions import (
    day_key, hour_key, interval_label, is_bot, is_present, level_label, parse_hour_key, parse_utc, payload_as_text,
    percent, prune_json, quoted_list, region,
)
from tidemark.functions.json_text import prune_text


def apply(spark, expr, values, ddl):
    df = spark.createDataFrame([(v,) for v in values], f"v {ddl}")
    return [r[0] for r in df.select(expr(F.col("v")).alias("r")).collect()]


def test_hour_and_day_keys(spark):
    values = ["2023-05-02T07:11:05Z", "not a time", None]
    assert apply(spark, lambda c: hour_key(parse_utc(c)), values, "string") == ["2023-05-02-07", None, None]
    assert apply(spark, lambda c: day_key(parse_utc(c)), values, "string") == ["2023-05-02", None, None]


def test_parse_utc_keeps_whole_seconds(spark):
    assert apply(spark, parse_utc, ["2023-04-12T14:26:29Z"], "string") == [datetime(2023, 4, 12, 14, 26, 29)]


def test_keys_do_not_depend_on_the_session_zone(spark):
    spark.conf.set("spark.sql.session.timeZone", "Asia/Shanghai")
    try:
        keys = apply(spark, lambda c: hour_key(parse_utc(c)), ["2023-05-02T07:11:05Z"], "string")
        back = apply(spark, parse_hour_key, ["2023-05-02-07"], "string")
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    assert keys == ["2023-05-02-07"]
    assert back == [datetime(2023, 5, 2, 7)]


def test_parse_hour_key(spark):
    assert apply(spark, parse_hour_key, ["2023-05-02-07", "2023-05-02-7", None], "string") == [
        datetime(2023, 5, 2, 7), None, None,
    ]


def test_region(spark):
    values = ["Paris, France", " Berlin ", "a,", "a,b, c ", "　Beijing,\tChina\n", None]
    assert apply(spark, region, values, "string") == ["France", "Berlin", "", "c", "China", None]


def test_presence(spark):
    assert apply(spark, is_present, [None, "null", "None", "", "x"], "string") == [False, False, False, True, True]


def test_bots(spark):
    assert apply(spark, is_bot, ["dependabot[bot]", "bot", None], "string") == [True, False, None]


def test_interval_bands(spark):
    values = [-5, 0, 1, 2, 7, 8, 30, 31, 90, 91, 180, 181, 365, 366, 730, 731, 1095, 1096, 1460, 1461, None]
    assert apply(spark, interval_label, values, "int") == [
        "I1", "I1", "I1", "I7", "I7", "I30", "I30", "I90", "I90", "I180", "I180", "I365", "I365", "I730", "I730",
        "I1095", "I1095", "I1460", "I1460", "others", "others",
    ]


def test_level_bands(spark):
    values = [0, 1, 10, 11, 100, 10**6, 10**6 + 1, None, -1]
    assert apply(spark, lambda c: level_label(c, "C"), values, "bigint") == [
        "C0", "C10", "C10", "C100", "C100", "C1000000", "others", "others", "C10",
    ]


def test_percent(spark):
    df = spark.createDataFrame([(1, 3), (0, 5), (1, 0)], "a int, b int")
    assert [r[0] for r in df.select(percent(F.col("a"), F.col("b"))).collect()] == [33.33, 0.0, None]


def test_quoted_list(spark):
    values = [None, [], ["a"], [f"t{i}" for i in range(25)]]
    expected = [None, "''", "'a'", "'" + "','".join(f"t{i}" for i in range(20)) + "'"]
    assert apply(spark, quoted_list, values, "array<string>") == expected


PRUNE_CASES = [
    ('{"a":"http://x","b":1}', '{"b":1}'),
    ('{"a":"see https://x for more"}', "{}"),
    ('{"a":["http://x","y"]}', '{"a":["http://x","y"]}'),
    ('{"a":[],"b":{},"c":null}', '{"c":null}'),
    ('{"a":{"u":"http://x"}}', '{"a":{}}'),
    ('{"a":[{"u":"http://x","k":[]},{},[]]}', '{"a":[{},{},[]]}'),
    ('{"n":12345678901234567890,"f":1.50,"t":"é"}', '{"n":12345678901234567890,"f":1.5,"t":"é"}'),
    ('"http://x"', '"http://x"'),
    ("not json", None),
    (None, None),
]


@pytest.mark.parametrize("text, expected", PRUNE_CASES)
def test_prune_text(text, expected):
    assert prune_text(text) == expected


def test_prune_json_column(spark):
    assert apply(spark, prune_json, [t for t, _ in PRUNE_CASES], "string") == [e for _, e in PRUNE_CASES]


def test_prune_reaches_any_depth():
    deep = '{"u":"http://x","k":' * 60 + "1" + "}" * 60
    assert prune_text(deep) == '{"k":' * 60 + "1" + "}" * 60


def test_payload_as_text(spark):
    out = apply(spark, payload_as_text, ['{"id":"1","payload":{"a":[1,{"b":"x"}]},"public":true}', "broken"], "string")
    assert out == ['{"id":"1","payload":"{\\"a\\":[1,{\\"b\\":\\"x\\"}]}","public":true}', None]


def test_pruning_has_no_depth_limit_and_keeps_odd_text():
    deep = '{"a":' * 5000 + '{"u":"https://x","b":1}' + "}" * 5000
    assert prune_text(deep) == '{"a":' * 5000 + '{"b":1}' + "}" * 5000
    assert prune_text("[" * 5000 + "]" * 5000) == "[" * 5000 + "]" * 5000
    assert prune_text('{"m":"cut \\ud83d","e":"\\u00e9"}') == '{"m":"cut \\ud83d","e":"é"}'
    assert prune_text('{"x":1e400,"k":1,"k":2, "n" : [ {} , "http://a" ] }') == '{"x":1e400,"k":1,"k":2,"n":[{},"http://a"]}'
    for broken in ("NaN", "[NaN]", '{"a":1,}', "[1,]", "[1 2]", '{"a"}', "{", "]", "", '"\n"', "1 2", "{1:2}", '{"a":1]', "01", "nul"):
        assert prune_text(broken) is None
    for plain in ("1", ' "a" ', "null", "[]", "{}", "-500.0"):
        assert prune_text(plain) == plain.strip()


def test_lone_surrogates_survive_the_job(spark):
    frame = spark.createDataFrame([('{"m":"cut \\ud83d","l":"http://x"}',), (None,), ("broken",)], "t string")
    assert [r[0] for r in frame.select(prune_json(F.col("t"))).collect()] == ['{"m":"cut \\ud83d"}', None, None]


def test_offsets_become_utc(spark):
    texts = ["2012-03-10T22:56:10-08:00", "2023-05-02T07:11:05Z", "2023-05-02T07:11:05+0530", "2023-05-02T07:11:05", "2023-05-02", "no"]
    frame = spark.createDataFrame([(t,) for t in texts], "t string").select(hour_key(parse_utc(F.col("t"))))
    assert [r[0] for r in frame.collect()] == ["2012-03-11-06", "2023-05-02-07", "2023-05-02-01", "2023-05-02-07", "2023-05-02-00", None]
