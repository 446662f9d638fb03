"""Known answers for nested values, arrays, JSON text and scalars."""

from __future__ import annotations

import datetime as dt

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from millrace.functions import arrays, jsontext, nested, scalars
from millrace.sources.rows import explode_json, generated_arrays, json_to_df, local_rows


def one(df):
    rows = df.collect()
    assert len(rows) == 1
    return rows[0]


def value(spark, column):
    return one(spark.range(1).select(column.alias("v")))["v"]


def ints(*items):
    return F.array(*[F.lit(i).cast("int") for i in items])


# Structs, arrays and maps


def test_struct_and_map_by_dot(spark):
    text = '{"lamp":{"watts":40}}'
    for kind in ("struct<watts: int>", "map<string, int>"):
        assert one(json_to_df(spark, text, f"lamp {kind}").select("lamp.watts"))[0] == 40


def test_missing_map_key_and_item_are_null(spark):
    text = '{"stock":{"nails":30},"bays":[7,9]}'
    df = json_to_df(spark, text, "stock map<string, int>, bays array<int>")
    row = one(
        df.select(
            nested.entry_of("stock", "nails"),
            nested.entry_of("stock", "bolts"),
            nested.item_at("bays", 0),
            nested.item_at("bays", 5),
        )
    )
    assert tuple(row) == (30, None, 7, None)


def test_flatten_and_nest(spark):
    df = json_to_df(spark, '{"box":{"wide":12,"tall":8}}')
    flat = nested.flatten_struct(df, "box")
    assert flat.dtypes == [("tall", "bigint"), ("wide", "bigint")]
    assert one(nested.nest_all(flat, "size"))["size"].asDict() == {"wide": 12, "tall": 8}


def test_explode_drops_empty_and_null(spark):
    df = spark.createDataFrame([(1, [1, 2]), (2, []), (3, None)], "id int, a array<int>")
    assert [tuple(r) for r in df.select("id", F.explode("a")).collect()] == [(1, 1), (1, 2)]


def test_map_entries(spark):
    df = json_to_df(spark, '{"a":{"oak":14,"elm":3}}', "a map<string, int>")
    got = nested.entries(df, "a", "tree", "n").collect()
    assert sorted(map(tuple, got)) == [("elm", 3), ("oak", 14)]
    empty = spark.createDataFrame([({},), (None,)], "a map<string, int>")
    assert nested.entries(empty, "a").count() == 0


def test_field_of_each_item(spark):
    df = json_to_df(spark, '{"legs":[{"km":12},{"km":5},{"km":31}]}')
    assert one(df.select("legs.km"))[0] == [12, 5, 31]


def test_drop_elements_of_struct_and_array(spark):
    df = spark.createDataFrame(
        [(1, ("x", None, 3, True), 2), (2, None, 5)],
        "id int, info struct<a: string, b: string, c: int, d: boolean>, z int",
    )
    got = nested.drop_elements(df, 1, [0], "info")
    assert got.columns == ["id", "z", "info"]
    assert sorted(map(tuple, got.collect())) == [(1, 2, "None,3,true"), (2, 5, None)]

    lists = spark.createDataFrame(
        [(1, ["p", "q", None, "s"]), (2, []), (3, None)], "id int, info array<string>"
    )
    got = nested.drop_elements(lists, 1, [1, 9], "info")
    assert sorted(map(tuple, got.collect())) == [(1, "p,None,s"), (2, ""), (3, None)]


def test_drop_elements_takes_the_field_by_position(spark):
    """The field that is read and the column that is replaced may differ."""
    df = spark.createDataFrame([((1, 2), "old")], "pair struct<a: int, b: int>, text string")
    got = nested.drop_elements(df, 0, [0], "text")
    assert got.columns == ["pair", "text"]
    assert one(got)["text"] == "2"
    with pytest.raises(ValueError):
        nested.drop_elements(df, 1, [0], "text")


# Arrays


def test_lambda_rewrites(spark):
    values = ints(13, 85, 23, 40, 51)
    assert value(spark, F.transform(values, lambda x: x + 1)) == [14, 86, 24, 41, 52]
    assert value(spark, F.filter(values, lambda x: x > 50)) == [85, 51]
    assert value(spark, F.filter(values, lambda x: x > 500)) == []
    assert value(spark, F.exists(values, lambda x: x % 10 == 1)) is True
    assert value(spark, F.transform(values, lambda x: x > 30)) == [False, True, False, True, True]
    inner = F.array(ints(1, 2), ints(3, 4, 5))
    assert value(spark, arrays.add_inside(inner, F.lit(0))) == [[3, 4], [6, 7, 8]]


def test_reductions(spark):
    values = ints(13, 85, 23, 40, 51)
    assert value(spark, arrays.array_sum(values)) == 212
    assert value(spark, arrays.array_mean(values)) == 42
    assert value(spark, arrays.geometric_mean(values)) == pytest.approx(34.909534, abs=1e-6)
    assert value(spark, arrays.log_geometric_mean(values)) == pytest.approx(34.909534, abs=1e-6)
    assert value(spark, arrays.euclidean_norm(ints(3, 4))) == 5.0


@pytest.mark.parametrize(
    ("temp", "level", "first_f", "mean_f", "mean", "geo"),
    [
        ([20, 21, 19, 24], [1400, 1403, 1409], 68, 69, 1404, 1404.0),
        ([-3, 5, 0, 99], [900, 902, 1300], 27, 77, 1034, 1018.0),
    ],
)
def test_sensor_readings(spark, temp, level, first_f, mean_f, mean, geo):
    """Truncation happens at each division, as whole-number division does."""
    assert value(spark, F.transform(ints(*temp), arrays.to_fahrenheit))[0] == first_f
    assert value(spark, arrays.array_mean(ints(*temp), arrays.to_fahrenheit)) == mean_f
    assert value(spark, arrays.array_mean(ints(*level))) == mean
    assert value(spark, F.round(arrays.geometric_mean(ints(*level)))) == geo


def test_negative_mean_truncates_toward_zero(spark):
    assert value(spark, arrays.array_mean(ints(0, -1, 0))) == 0
    assert value(spark, arrays.array_mean(ints(-3, -4))) == -3


def test_empty_and_null_arrays(spark):
    none = F.lit(None).cast("array<int>")
    empty = F.array().cast("array<int>")
    assert value(spark, arrays.array_sum(empty)) == 0
    assert value(spark, arrays.array_mean(empty)) is None
    assert value(spark, arrays.geometric_mean(empty)) is None
    assert value(spark, arrays.array_sum(none)) is None
    assert value(spark, F.transform(none, lambda x: x + 1)) is None
    holed = F.array(F.lit(1), F.lit(None))
    assert value(spark, arrays.array_sum(holed)) is None
    assert value(spark, F.exists(holed, lambda x: x == 2)) is None
    assert value(spark, F.filter(holed, lambda x: x > 0)) == [1]


def test_long_geometric_mean_needs_logarithms(spark):
    long = F.array_repeat(F.lit(50.0), 1000)
    assert value(spark, arrays.geometric_mean(long)) == float("inf")
    assert value(spark, arrays.log_geometric_mean(long)) == pytest.approx(50.0)


def test_accumulator_must_keep_its_type(spark):
    """A running sum that starts as a decimal becomes another type with the first item."""
    sums = F.aggregate(
        F.array(F.lit(3.5), F.lit(4.25)),
        F.struct(F.lit(0).cast("decimal(4,1)").alias("sum"), F.lit(0).alias("count")),
        lambda so_far, item: F.struct(
            (so_far["sum"] + item).alias("sum"), (so_far["count"] + 1).alias("count")
        ),
    )
    with pytest.raises(AnalysisException):
        spark.range(1).select(sums)


def test_generated_arrays_do_not_depend_on_partitions(spark):
    ids = spark.range(1000)
    want = sorted(map(tuple, generated_arrays(ids, "id").collect()), key=lambda r: r[0])
    for n in (1, 7, 16):
        got = generated_arrays(ids.repartition(n), "id").collect()
        assert sorted(map(tuple, got), key=lambda r: r[0]) == want
    numbers = [x for row in want for x in row[1]]
    assert min(numbers) >= 0 and max(numbers) < 100 and len(set(numbers)) == 100
    assert 45 < sum(numbers) / len(numbers) < 55
    assert all(row[2] == [row[1][:2], row[1][2:]] for row in want)


# JSON text


def test_json_text_to_table(spark):
    df = json_to_df(spark, '[{"row":4,"seat":"f"},{"row":9,"seat":"c"},{"row":1}]')
    assert df.dtypes == [("row", "bigint"), ("seat", "string")]
    assert sorted(map(tuple, df.collect()))[1:] == [(4, "f"), (9, "c")]
    declared = json_to_df(spark, '[{"x":1},{"x":2,"t":951782400}]', "x int, t timestamp")
    assert sorted(declared.collect(), key=lambda r: r.x)[1]["t"] == dt.datetime.fromtimestamp(
        951782400
    )


def test_explode_json_takes_objects_and_arrays(spark):
    df = spark.createDataFrame(
        [(1, '{"x":1}'), (2, '[{"x":2},{"x":3}]'), (3, "[]"), (4, "broken")], "id int, t string"
    )
    got = explode_json(df, "t", "x int")
    assert sorted(map(tuple, got.collect())) == [(1, 1), (2, 2), (2, 3)]


def test_json_round_trip(spark):
    df = json_to_df(spark, '{"tap":{"litres":6,"hot":null}}', "tap struct<litres: int, hot: int>")
    text = df.select(F.to_json("tap").alias("tap"))
    assert one(text)[0] == '{"litres":6}'
    assert one(jsontext.parse_json(text, "tap", "litres int", "p").select("p.litres"))[0] == 6
    assert one(jsontext.as_message(text))["value"] == '{"tap":"{\\"litres\\":6}"}'


def test_inner_object_stays_text(spark):
    df = spark.createDataFrame([('{"car":{"doors":5,"radio":{"band":"fm"}}}',)], "t string")
    parsed = jsontext.parse_json(df, "t", "car struct<doors: int, radio: string>", "p")
    assert tuple(one(parsed.select("p.car.doors", "p.car.radio"))) == (5, '{"band":"fm"}')


def test_schema_comes_from_all_messages(spark):
    texts = ['{"n":1}', None, "broken", '{"n":2.5,"tags":["x"]}', '{"last":{"deep":true}}']
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    schema = jsontext.schema_of_messages(df, "t")
    assert set(schema.fieldNames()) == {"n", "tags", "last"}
    rows = df.select(F.from_json("t", schema).alias("j")).select("j.last.deep", "j.tags").collect()
    assert (rows[4]["deep"], rows[3]["tags"]) == (True, ["x"])
    assert jsontext.schema_of_messages(df.limit(0), "t").fieldNames() == []


def test_json_fields_and_broken_text(spark):
    df = spark.createDataFrame(
        [(1, '{"b":1}'), (2, '{"c":1}'), (3, "broken"), (4, None)], "id int, t string"
    )
    got = jsontext.json_fields(df, "t", ["b"]).orderBy("id").collect()
    assert [r["b"] for r in got] == ["1", None, None, None]
    parsed = jsontext.parse_json(df, "t", "b int", "p").orderBy("id").select("p.b").collect()
    assert [r["b"] for r in parsed] == [1, None, None, None]
    rows = jsontext.parsed_rows(df, "t", "b int, c int").orderBy("id").collect()
    want = [(1, 1, None), (2, None, 1), (3, None, None), (4, None, None)]
    assert [tuple(r) for r in rows] == want
    assert jsontext.parsed_rows(df, "t", "b int, c int", ["c"]).columns == ["id", "c"]


# Scalars


def test_timestamps(spark):
    def parsed(text, layout, **options):
        column = scalars.parse_ts(F.lit(text), layout, **options)
        return value(spark, column.cast("timestamp_ntz"))

    whole = dt.datetime(2020, 2, 29, 10, 11, 12)
    exact = whole.replace(microsecond=345000)
    assert parsed("2020-02-29T10:11:12", scalars.PLAIN_ISO) == whole
    assert parsed("2020-02-29T10:11:12.345Z", scalars.ZONED_ISO_MILLIS) == whole
    assert parsed("2020-02-29T12:11:12.345+02", scalars.ZONED_ISO_MILLIS) == whole
    assert parsed("2020/02/29 10:11:12.345", scalars.LOG_MILLIS) == whole
    assert parsed("2020/02/29 10:11:12.345", scalars.LOG_MILLIS, keep_fraction=True) == exact
    assert parsed("yesterday", scalars.PLAIN_ISO) is None
    millis = scalars.from_epoch_millis(F.lit(1582971072345).cast("bigint"))
    assert value(spark, millis.cast("timestamp_ntz")) == exact


def test_regular_expressions(spark):
    df = spark.createDataFrame([("room=12b",), ("room=7",), ("hall",)], "a string")
    got = [r[0] for r in df.select(F.regexp_extract("a", "room=([0-9]+)", 1)).collect()]
    assert got == ["12", "7", ""]
    assert value(spark, scalars.identifier(F.lit("Jan.K@x-y9"))) == "Jan_K_x_y9"
    assert value(spark, scalars.identifier(F.current_user())).replace("_", "").isalnum()


def test_local_rows(spark):
    df = local_rows(spark, [(1, "a"), (2, None)], "id int, t string")
    assert sorted(map(tuple, df.collect())) == [(1, "a"), (2, None)]


def test_schema_of_messages_leaves_names_alone(spark):
    rows = [('{"OBJECT<x": 1, "a b": {"OBJECT<": "t"}, "c`d": [{"e": 1.5}], "f": {}}',), ("bad",), (None,)]
    found = jsontext.schema_of_messages(spark.createDataFrame(rows, "value string"), "value")
    assert sorted(found.names) == ["OBJECT<x", "a b", "c`d", "f"]
    assert found["a b"].dataType.names == ["OBJECT<"]
    parsed = spark.createDataFrame(rows[:1], "value string").select(F.from_json("value", found).alias("j")).first()["j"]
    assert parsed["OBJECT<x"] == 1 and parsed["a b"]["OBJECT<"] == "t"
