import json

import pytest
from pyspark.sql import functions as F

from skytally.functions import records as R
from skytally.plans.insights import in_air_domestic


def texts(df):
    return [r[0] for r in df.orderBy("record_ix").select(F.to_json("doc")).collect()]


@pytest.mark.parametrize("mode, payload, expected", [
    ("flights", '[{"a":1},{"b":2}]', ['{"a":1}', '{"b":2}']),
    ("flights", '[{"a":1},5]', ['{"a":1}', "5"]),
    ("flights", '{"data":[{"a":1}]}', ['{"a":1}']),
    ("flights", '{"results":[{"a":1}]}', ['{"a":1}']),
    ("flights", '{"data":{"x":1},"results":[{"a":1}]}', ['{"a":1}']),
    ("flights", '{"foo":"bar"}', ['{"foo":"bar"}']),
    ("flights", "{}", ["{}"]),
    ("flights", '"invalid"', []),
    ("flights", '{"data":[]}', []),
    ("reference", '[{"data":[{"a":1},7]},{"results":[{"b":2}]},{"c":3},9]',
     ['{"a":1}', "7", '{"b":2}', '{"c":3}']),
    ("insights", '{"data":[{"a":1},null,"x"]}', ['{"a":1}']),
    ("features", '{"results":[{"a":1}]}', ['{"results":[{"a":1}]}']),
    ("extractor", '{"foo":1}', []),
    ("extractor", '{"data":[{"a":1},2]}', ['{"a":1}']),
])
def test_unwrap(spark, mode, payload, expected):
    df = spark.createDataFrame([(payload,)], "p string").select(F.parse_json("p").alias("payload"))
    assert texts(R.unwrap(df, mode)) == expected


def test_unwrap_rejects_unknown_mode(spark):
    with pytest.raises(ValueError):
        R.record_list(F.col("payload"), "other")


@pytest.mark.parametrize("text, number, valid", [
    ('{"flight_date":"2026-02-27","flight":{"iata":"VN7091"}}', "VN7091", True),
    ('{"flight_date":"2026-02-27","flight":{"iata":"","icao":"HVN7091"}}', "HVN7091", True),
    ('{"flight_date":"2026-02-27","flight":{"number":"7091"}}', "7091", True),
    ('{"flight_date":"2026-02-27","flight":{"iata":"","number":""}}', "", True),
    ('{"flight":{"number":"7091"}}', "7091", False),
    ('{"flight_date":null,"flight":{"number":"7091"}}', "7091", False),
    ('{"flight_date":"2026-02-27","flight":null}', None, False),
    ("5", None, False),
])
def test_flight_key(docs, text, number, valid):
    row = R.with_keys(docs(text), "flights").first()
    assert (row.flight_number, row.is_valid) == (number, valid)


def test_reference_keys_need_one_field(docs):
    rows = R.with_keys(docs('{"icao_code":"AFR"}', '{"other":1}'), "airlines").orderBy("ix").collect()
    assert [(r.airline_icao, r.is_valid) for r in rows] == [("AFR", True), (None, False)]


@pytest.mark.parametrize("text, expected", [
    ('{"live":{"is_ground":false}}', True),
    ('{"live":{"is_ground":true},"flight_status":"active"}', False),
    ('{"live":{"is_ground":null},"flight_status":"active"}', False),
    ('{"live":{"is_ground":"false"}}', False),
    ('{"live":{},"flight_status":"active"}', True),
    ('{"live":null,"flight_status":"active"}', True),
    ('{"flight_status":"Active"}', False),
    ("{}", False),
])
def test_in_air(docs, text, expected):
    assert docs(text).select(R.is_in_air(F.col("doc"))).first()[0] is expected


@pytest.mark.parametrize("value, expected", [
    ("7", True), ("0.5", True), ("true", True), ("1e3", True), ("0", False), ("-3", False),
    ('"7"', False), ("null", False), ("false", False), ("[1]", False),
])
def test_positive_number_is_type_exact(docs, value, expected):
    df = docs(f'{{"d":{value}}}')
    assert df.select(R.is_positive_number(R.at(F.col("doc"), "d"))).first()[0] is expected


def test_first_truthy_keeps_text_zero(docs):
    chain = lambda: R.number_of(R.first_truthy_at(F.col("doc"), "a", "b"))
    rows = docs('{"a":0,"b":2}', '{"a":"0","b":2}', '{"a":false,"b":0}', '{"b":3}').orderBy("ix")
    assert [r[0] for r in rows.select(chain()).collect()] == [2.0, 0.0, 0.0, 3.0]


@pytest.mark.parametrize("doc, expected", [
    ({"a": None, "b": "", "c": [], "d": {}, "e": 0, "f": False}, {"e": 0, "f": False}),
    ({"a": {"b": {"c": ""}}, "x": ["", {"y": None}, "z"]}, {"x": ["z"]}),
    ({"a": ""}, {"a": ""}),
])
def test_prune_free_form(spark, doc, expected):
    df = spark.createDataFrame([(json.dumps(doc),)], "doc string")
    assert json.loads(R.prune_documents(df, "doc").first()[0]) == expected


def test_prune_typed_matches_free_form(spark):
    schema = "d struct<a:string,n:int,s:struct<x:string,l:array<string>>,t:array<struct<q:string>>>"
    records = [
        (("", 0, ("", ["", None]), [("",), ("v",)]),),
        (("k", None, None, None),),
        (("", None, ("", []), []),),
    ]
    df = spark.createDataFrame(records, schema)
    typed = [r[0] for r in df.select(R.pruned_json(F.col("d"), df.schema["d"].dataType)).collect()]
    free = [r[0] for r in R.prune_documents(df.select(F.to_json("d").alias("d")), "d").collect()]
    assert [json.loads(t) for t in typed[:2]] == [json.loads(t) for t in free[:2]]
    assert json.loads(typed[0]) == {"n": 0, "t": [{"q": "v"}]}


def test_extractor_keeps_in_air_flights_between_followed_airports(docs):
    flight = '{{"flight_status":"{s}","departure":{{"iata":"cdg","gate":""}},"arrival":{{"iata":"{a}"}}}}'
    rows = docs(
        flight.format(s="active", a="NCE"), flight.format(s="landed", a="NCE"),
        flight.format(s="active", a="JFK"),
    )
    kept = in_air_domestic(rows).collect()
    assert [r.ix for r in kept] == [0]
    assert json.loads(kept[0].doc)["departure"] == {"iata": "cdg"}


def test_first_text_skips_falsy_values_by_type(spark):
    cases = {"false": "CDG", "0": "CDG", "-0.0": "CDG", "{}": "CDG", "[]": "CDG", "null": "CDG", '""': "CDG",
             '"0"': "0", '"false"': "false", '"{}"': "{}", "7": "7", "true": "true", '"ORY"': "ORY"}
    rows = [(value, f'{{"departure": {{"iata": {value}}}, "dep": "CDG"}}') for value in cases]
    docs = spark.createDataFrame(rows, "value string, js string").withColumn("doc", F.parse_json("js"))
    got = docs.select("value", R.first_text_at(F.col("doc"), "departure.iata", "dep").alias("t")).collect()
    assert {r.value: r.t for r in got} == cases
