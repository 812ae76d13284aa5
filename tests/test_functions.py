import json
from datetime import datetime

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fleetpulse.functions import maps, messages as M, predicates as P, times as TM
from fleetpulse.functions.words import explode_words, words

PAIRS = "array<struct<code:string,alias:string,title:string,value:string>>"


def one(df):
    return df.first()


@pytest.mark.parametrize(
    "option,expected",
    [
        ("=", {"5": True, "5.0": True, "4.9": False, "5.1": False}),
        (">", {"5": False, "5.1": True}),
        (">=", {"5": True, "4.9": False}),
        ("<", {"5": False, "4.9": True}),
        ("<=", {"5": True, "5.1": False}),
        ("[between]", {"5": True, "9": True, "4.9": False, "9.1": False}),
        ("(between)", {"5": False, "9": False, "5.1": True, "8.9": True}),
        ("(between]", {"5": False, "9": True}),
        ("[between)", {"5": True, "5.0": True, "9": False}),
        ("?", {"5": False, "7": False}),
    ],
)
def test_rule_options(spark, option, expected):
    values = {**expected, "junk": False, "": False, "NaN": False, None: False}
    df = spark.createDataFrame([(option, v) for v in values], "o string, v string")
    got = df.select("v", P.holds(F.col("o"), F.col("v"), F.lit(5), F.lit(9)).alias("h")).collect()
    assert {r.v: r.h for r in got} == values


def test_infinite_values(spark):
    df = spark.createDataFrame([(">", "Infinity"), ("<", "Infinity"), ("<", "-Infinity")], "o string, v string")
    got = [r[0] for r in df.select(P.holds(F.col("o"), F.col("v"), F.lit(5), F.lit(9))).collect()]
    assert got == [True, False, True]


def message(**over):
    body = {
        "TIMESTAMP": 1486094706000,
        "DATIME_RX": "2017-02-03 04:05:06",
        "pairs": [
            {"code": "ENTITY_UNID", "alias": "", "title": "", "value": "V1"},
            {"code": "m01", "alias": "MILEAGE", "title": "", "value": "1200.5"},
            {"code": "s01", "alias": "SOC", "title": "", "value": "55"},
        ],
    }
    body.update(over)
    return json.dumps(body)


def parsed(spark, *texts):
    return M.parse_messages(spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "seq int, str string"))


def test_parse_valid_and_key_spelling(spark):
    lower = message().replace("TIMESTAMP", "timestamp").replace("DATIME_RX", "datime_RX")
    rows = parsed(spark, message(), lower, message(TIMESTAMP="2017-02-03 04:05:06"), message(extra=[1])).collect()
    assert [r.seq for r in rows] == [0, 1, 2, 3]
    assert {r.timestamp.replace(tzinfo=None) for r in rows if r.seq != 2} == {rows[0].timestamp.replace(tzinfo=None)}
    assert {r.datime_rx for r in rows} == {"2017-02-03 04:05:06"}
    assert rows[0].pairs[1].value == "1200.5"


def test_parse_drops_malformed_and_defaults_missing(spark):
    texts = ["{not json", "", message(pairs=[]), '{"TIMESTAMP": 1486094706000}', message(pairs=[{"code": "c"}])]
    rows = parsed(spark, *texts).orderBy("seq").collect()
    assert [r.seq for r in rows] == [2, 3, 4]
    assert rows[1].datime_rx == "" and rows[1].pairs == []
    assert tuple(rows[2].pairs[0]) == ("c", "", "", "0.0")


def test_null_value_is_not_a_missing_value(spark):
    row = one(parsed(spark, message(pairs=[{"code": "c", "value": None}])))
    assert row.pairs[0].value is None


def test_vehicle_is_required(spark):
    df = parsed(spark, message(), message(pairs=[{"code": "m", "alias": "MILEAGE", "value": "1"}]))
    assert [r.vehicle_id for r in M.with_vehicle(df).collect()] == ["V1"]


def test_metric_defaults_and_bad_numbers(spark):
    vehicle = {"code": "ENTITY_UNID", "value": "V1"}
    df = parsed(
        spark,
        message(pairs=[vehicle]),
        message(pairs=[vehicle, {"alias": "MILEAGE", "value": "junk"}]),
        message(pairs=[vehicle, {"alias": "FUEL_CONSUM_TOTAL", "value": "x"}]),
        message(pairs=[vehicle, {"alias": "MILEAGE", "value": "1"}, {"alias": "MILEAGE", "value": "2"}]),
        message(pairs=[vehicle, {"alias": "ChargeStatus", "value": "true"}, {"alias": "FUEL_CONSUM_TOTAL", "value": "3"}]),
    )
    rows = {r.seq: r for r in M.with_metrics(df).collect()}
    assert sorted(rows) == [0, 3, 4]
    empty = rows[0]
    assert (empty.mileage, empty.energy, empty.soc, empty.in_charge, empty.charge_all) == (0.0,) * 5
    assert (empty.fuel, empty.speed, empty.device_id, empty.charge_status) == (None, None, None, "0.0")
    assert rows[3].mileage == 1.0
    assert (rows[4].charge_status, rows[4].fuel) == ("false", 3.0)


def test_pair_by_code_takes_first_of_alias_or_code(spark):
    pairs = [("a", "x", "", "1"), ("x", "b", "", "2"), ("c", "c", "", "junk")]
    df = spark.createDataFrame([(pairs,)], f"pairs {PAIRS}")
    found = [M.pair_by_code(F.col("pairs"), c)["value"].alias(c) for c in ("x", "b", "none")]
    assert tuple(one(df.select(*found))) == ("1", "2", None)
    index = M.pair_index(F.col("pairs"))
    numbers = [M.indexed_number(index, F.lit(c)).alias(c) for c in ("x", "b", "none", "c")]
    x, b, none, junk = one(df.select(*numbers))
    assert (x, b, none) == (1.0, 2.0, None) and junk != junk


def test_times(spark):
    df = spark.createDataFrame([("2024-03-01 00:00:05", "V1"), ("soon", "V2")], "t string, v string")
    ts = TM.parse_second_text(F.col("t"))
    rows = df.select(
        TM.day_key(ts, F.col("v")).alias("d"),
        TM.previous_day_key(ts, F.col("v")).alias("p"),
        TM.millis_key(ts, F.col("v")).alias("m"),
        TM.month_suffix(ts).alias("s"),
        ts.isNull().alias("bad"),
    ).collect()
    assert tuple(rows[0]) == ("20240301-V1", "20240229-V1", "1709251205000-V1", "202403", False)
    assert rows[1].bad
    unid = one(df.limit(1).select(TM.episode_unid(F.col("v"), F.lit(1))))[0]
    assert len(unid) == 32 and unid == unid.upper()
    assert TM.micros("5 minutes") == 300_000_000
    with pytest.raises(ValueError):
        TM.micros("soon")


def test_words(spark):
    cases = {"a b": ["a", "b"], "a  b": ["a", "", "b"], " a": ["", "a"], "a  ": ["a"], "  ": [], "": [""], "a\nb c": ["a\nb", "c"]}
    df = spark.createDataFrame([(t,) for t in cases], "t string")
    assert {r.t: r.w for r in df.select("t", words(F.col("t")).alias("w")).collect()} == cases
    assert explode_words(df, "t").count() == sum(map(len, cases.values()))


def test_hash_fields(spark):
    df = spark.createDataFrame([({"a": "1", "b": "x"},), (None,)], "h map<string,string>")
    h = F.col("h")
    rows = df.select(
        maps.set_fields(h, {"b": F.lit("y"), "c": F.lit("z")}).alias("set"),
        maps.set_if_absent(h, "a", F.lit("9")).alias("nx"),
        maps.delete_fields(h, "a").alias("d"),
        maps.field_count(h).alias("n"),
        maps.has_field(h, "a").alias("has"),
        maps.map_to_struct(h, T.StructType().add("a", T.IntegerType()).add("b", T.IntegerType())).alias("s"),
    ).collect()
    assert rows[0]["set"] == {"a": "1", "b": "y", "c": "z"} and rows[1]["set"] == {"b": "y", "c": "z"}
    assert rows[0].nx == {"a": "1", "b": "x"} and rows[1].nx == {"a": "9"}
    assert rows[0].d == {"b": "x"} and (rows[0].n, rows[1].n) == (2, 0) and (rows[0].has, rows[1].has) == (True, False)
    assert tuple(rows[0].s) == (1, None)


def test_json_is_parsed_once(spark):
    """Filters on parsed fields must not repeat the parse below themselves."""
    df = M.with_metrics(M.with_event_time(M.with_vehicle(parsed(spark, message()))))
    plan = df._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("from_json") == 1
    assert datetime(2017, 2, 3, 4, 5, 6) == one(df.select(F.col("ts").cast("timestamp_ntz")))[0]


def test_json_text(spark):
    struct = T.StructType().add("a", T.IntegerType())
    df = spark.createDataFrame([('{"a": 1}', '[{"a": 1}, {"a": 2}]'), ("{bad", "{bad")], "o string, l string")
    objects = df.select(maps.from_text(F.col("o"), struct).alias("s"), maps.from_text(F.col("l"), T.ArrayType(struct)).alias("l"))
    good, bad = objects.collect()
    assert good.s.a == 1 and [x.a for x in good.l] == [1, 2] and bad.s is None and bad.l is None
    assert one(objects.select(maps.to_text(F.col("s")), maps.to_text(F.col("l")))) == ('{"a":1}', '[{"a":1},{"a":2}]')
