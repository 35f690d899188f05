import json

from pyspark.sql.types import LongType, StringType, StructField, StructType, ArrayType

from stratum.plans import json_template as jt
from stratum.sources.json import parse_json_rescue

ITEM = StructType([StructField("table_id", StringType()), StructField("other_column", StringType()),
                   StructField("last_reported", LongType())])
SCHEMA = StructType([StructField("data", StructType([StructField("field", ArrayType(ITEM))])),
                     StructField("last_updated", LongType())])


def test_rescue_undeclared_and_malformed(spark):
    recs = [json.dumps({"data": {"field": [{"table_id": "1", "other_column": "x", "last_reported": 10}]},
                        "last_updated": 100}),
            json.dumps({"data": {"field": []}, "last_updated": 200, "extra": "e", "n": 5}),
            "{not json"]
    df = spark.createDataFrame([(r,) for r in recs], "value string")
    out = parse_json_rescue(df, "value", SCHEMA).collect()
    assert out[0]._rescued_data is None and out[0].last_updated == 100
    assert json.loads(out[1]._rescued_data) == {"extra": "e", "n": "5"}
    assert out[2]._rescued_data == "{not json" and out[2].last_updated is None


def test_rescue_nested_and_mistyped(spark):
    recs = [{"data": {"field": [{"table_id": "1", "last_reported": 5}, {"table_id": "2", "odd.one": 7}], "more": {"x": 1}},
             "last_updated": 1},
            {"data": {"field": [{"last_reported": "soon"}]}, "last_updated": "abc"},
            {"data": "text", "last_updated": 3}, {"data": None, "last_updated": None}, {}]
    df = spark.createDataFrame([(i, json.dumps(r)) for i, r in enumerate(recs)], "i int, value string")
    out = {r.i: r for r in parse_json_rescue(df, "value", SCHEMA, keep=["i"]).collect()}
    lost = {i: json.loads(r._rescued_data) if r._rescued_data else None for i, r in out.items()}
    assert lost[0] == {"data.field[1].odd\\.one": "7", "data.more": '{"x":1}'}
    assert [x.table_id for x in out[0].data.field] == ["1", "2"]
    assert "abc" in lost[1].values() and any("soon" in v for v in lost[1].values())
    assert lost[2] == {"data": "text"} and out[2].last_updated == 3
    assert lost[3] is None and lost[4] is None


def test_explode_expectations(spark):
    recs = [json.dumps({"data": {"field": [{"table_id": "1", "other_column": "x", "last_reported": 0},
                                           {"other_column": "y", "last_reported": 0},
                                           {"table_id": "3", "other_column": "z", "last_reported": 90000}]},
                        "last_updated": 100000}),
            json.dumps({"data": {"field": []}, "last_updated": 5}),
            json.dumps({"data": {}, "last_updated": 6})]
    raw = parse_json_rescue(spark.createDataFrame([(r,) for r in recs], "value string"), "value", SCHEMA)
    clean, obs = jt.clean(raw)
    rows = clean.collect()
    assert sorted(r.table_id for r in rows) == ["1", "3"]      # null id dropped; empty / null arrays vanish
    assert obs.get["violations_valid_id"] == 1 and obs.get["violations_over_24hr_old_data"] == 2
    r1 = [r for r in rows if r.table_id == "1"][0]
    assert r1.secs_since_last_reported == 100000 and str(r1.last_updated_ts) == "1970-01-02 03:46:40"
    assert r1.last_updated_hr == 97200                           # 03:46:40 truncated to 03:00


def test_infer_schema_sees_every_file(spark, tmp):
    from stratum.sources.files import infer_schema, read_csv
    from pyspark.sql import functions as F
    # integers in all files but the last ones, which hold fractions
    rows = spark.range(400).select("id", F.when(F.col("id") < 390, F.col("id").cast("string"))
                                   .otherwise(F.concat(F.col("id").cast("string"), F.lit(".5"))).alias("val"))
    rows.repartitionByRange(200, "id").write.option("header", True).csv(f"{tmp}/c")
    schema = infer_schema(spark, f"{tmp}/c", "csv")
    assert schema["val"].dataType.typeName() == "double"
    assert read_csv(spark, f"{tmp}/c", schema=schema).filter("val IS NULL").count() == 0
    spark.createDataFrame([(1, "x")], "a long, b string").write.json(f"{tmp}/j/p0")
    spark.createDataFrame([(1, 2.5)], "a long, late double").write.json(f"{tmp}/j/p1")
    assert infer_schema(spark, f"{tmp}/j/*", "json").fieldNames() == ["a", "b", "late"]
