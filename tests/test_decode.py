import json

import pytest

from meterflow.operators import decode, encode
from meterflow.schemas import AREA, HOUSEHOLD, HOUSEHOLD_V1, HOUSEHOLD_V1_DOUBLE, LOCATION, without

GOOD = {
    "type": "household", "household_id": "A1B2C3", "device_id": "household-HCMC-Q1-261",
    "timestamp": "2024-09-29T10:00:00Z", "electricity_usage_kwh": 4.75, "voltage": 230, "current": 10.5,
    "location": {"house_number": "268", "ward": "phuong_14", "district": "quan_10", "city": "HCMC"},
    "price_per_kwh": 1800, "total_cost": 8550,
}
REQUIRED = ["household_id", "device_id", "timestamp"]


def messages(spark, *texts):
    return spark.createDataFrame([(bytearray(t, "utf8"),) for t in texts], "value binary")


def parsed(spark, *texts):
    return decode.decode_json(messages(spark, *texts), HOUSEHOLD, corrupt="raw")


def test_complete_message(spark):
    row = parsed(spark, json.dumps({**GOOD, "extra": 1})).first()
    assert row.household_id == "A1B2C3" and row.location.city == "HCMC" and row.raw is None
    assert row.timestamp.isoformat().startswith("2024-09-29T10:00")


def test_zone_offset_is_applied(spark):
    rows = parsed(spark, json.dumps({**GOOD, "timestamp": "2024-09-29T17:00:00+07:00"}), json.dumps(GOOD))
    assert rows.select("timestamp").distinct().count() == 1


def test_bad_records_are_kept_apart(spark):
    wrong_type = json.dumps({**GOOD, "voltage": "x"})
    no_key = json.dumps({k: v for k, v in GOOD.items() if k != "device_id"})
    rows = parsed(spark, json.dumps(GOOD), "not json", wrong_type, no_key)
    valid, refused = decode.split_valid(rows, REQUIRED, corrupt="raw")
    assert sorted(r.voltage or 0 for r in valid.collect()) == [0, 230] and "raw" not in valid.columns
    reasons = {r.raw: r.quarantine_reason for r in refused.collect()}
    assert reasons == {"not json": "malformed", None: "device_id"}
    strict, refused = decode.split_valid(rows, REQUIRED, corrupt="raw", strict=True)
    assert strict.count() == 1 and wrong_type in {r.raw for r in refused.collect()}


def test_a_message_is_parsed_once(spark):
    rows = parsed(spark, json.dumps(GOOD))
    for part in decode.split_valid(rows, REQUIRED, corrupt="raw"):
        plan = part._sc._jvm.PythonSQLUtils.explainString(part._jdf.queryExecution(), "simple")
        physical = plan[plan.index("Physical Plan"):] if "Physical Plan" in plan else plan
        assert physical.count("from_json") == 1


def test_null_and_empty_messages_are_refused(spark):
    df = spark.createDataFrame([(None,), (bytearray(b""),)], "value binary")
    valid, refused = decode.split_valid(decode.decode_json(df, HOUSEHOLD, corrupt="raw"), REQUIRED, corrupt="raw")
    assert valid.count() == 0 and refused.count() == 2


def test_nested_null_keeps_the_struct(spark):
    row = parsed(spark, json.dumps({**GOOD, "location": {"ward": None, "district": "d"}})).first()
    assert row.location is not None and row.location.ward is None and row.location.district == "d"


def test_flatten_and_address(spark):
    flat = decode.flatten_location(parsed(spark, json.dumps(GOOD)))
    assert flat.first().ward == "phuong_14" and "location" not in flat.columns
    assert decode.address_struct(flat).first().address == ("268", "phuong_14", "quan_10")


def test_schema_generations():
    assert "device_id" not in HOUSEHOLD_V1.names
    assert HOUSEHOLD_V1["location"].dataType.names == ["house_number", "ward", "district"]
    assert HOUSEHOLD_V1_DOUBLE["current"].dataType.simpleString() == "double"
    assert all(f.nullable for f in HOUSEHOLD_V1_DOUBLE.fields)
    assert AREA.names[-1] == "total_electricity_usage_kwh" and len(LOCATION) == 4
    with pytest.raises(ValueError):
        without(HOUSEHOLD, "nothing")


def test_row_json_keeps_floats_and_nesting(spark):
    rows = parsed(spark, json.dumps({**GOOD, "electricity_usage_kwh": 4.1})).drop("raw")
    out = json.loads(encode.with_row_json(rows).first().json)
    assert out["electricity_usage_kwh"] == 4.1 and out["location"]["ward"] == "phuong_14"
    assert out["timestamp"] == "2024-09-29T10:00:00.000000"


def test_group_json_splits_null_keys_too(spark):
    df = spark.range(5000).selectExpr("id", "if(id % 5 = 0, 'a', NULL) AS k")
    packed = encode.group_json(df, ["k"], "id", 100, ["id"]).collect()
    assert sum(p.rows for p in packed) == 5000
    assert max(p.rows for p in packed) < 200 and {p.k for p in packed} == {"a", None}
    whole = encode.group_json(df, ["k"], "id", None, ["id"]).collect()
    assert sorted(p.rows for p in whole) == [1000, 4000]


@pytest.mark.parametrize("per_array", [1000, 10])
def test_group_json_is_whole(spark, per_array):
    df = spark.range(300).selectExpr("id", "if(id < 250, 'hot', concat('k', id % 5)) AS k")
    packed = encode.group_json(df, ["k"], "id", per_array, ["id"]).collect()
    got = sorted(r["id"] for p in packed for r in json.loads(p.json))
    assert got == list(range(300))
    assert all(p.rows == len(json.loads(p.json)) for p in packed)
    assert max(p.rows for p in packed) <= (250 if per_array == 1000 else 40)
