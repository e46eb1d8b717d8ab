from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from tablewright.sources import delimited
from tablewright.workspace import named_cache, scratch_path


@pytest.fixture(scope="module")
def dirty(spark):
    path = scratch_path(spark, "dirty")
    lines = ["id;Rating (%);name", "1;9;a", "2;10;b", "3;x;c", "4;;d"]
    spark.createDataFrame([(line,) for line in lines], "value string").coalesce(1).write.text(path)
    return path


def test_without_schema_all_columns_are_strings(spark, dirty):
    df = delimited.read_delimited(spark, dirty, header=True, sep=";")
    assert set(dict(df.dtypes).values()) == {"string"}
    rating = F.col("`Rating (%)`")
    got = df.agg(F.max(rating).alias("text"), F.max(rating.try_cast("int")).alias("number"), F.count_if(rating.try_cast("int").isNull()).alias("bad")).first()
    assert (got.text, got.number, got.bad) == ("x", 10, 2)


def test_inference_picks_types(spark):
    path = scratch_path(spark, "typed")
    spark.createDataFrame([("a,b,c",), ("1,2.5,x",), ("2,3,y",)], "value string").coalesce(1).write.text(path)
    df = delimited.read_delimited(spark, path, header=True, infer=True)
    assert df.dtypes == [("a", "int"), ("b", "double"), ("c", "string")]


def test_declared_schema_without_header(spark):
    df = spark.createDataFrame([(1, "a"), (2, None)], "k int, s string")
    path = delimited.write_delimited(df, scratch_path(spark, "out"), header=False)
    back = delimited.read_delimited(spark, path, header=False, schema="k int, s string")
    assert sorted(map(tuple, back.collect())) == [(1, "a"), (2, None)]
    with pytest.raises(ValueError):
        delimited.read_delimited(spark, path, header=False, schema="k int", infer=True)


def test_single_file_only_on_request(spark):
    df = spark.range(0, 100, numPartitions=4)
    many = delimited.write_delimited(df, scratch_path(spark, "many"), header=True)
    one = delimited.write_delimited(df, scratch_path(spark, "one"), header=True, single_file=True)
    assert len(spark.read.csv(many).inputFiles()) == 4 and len(spark.read.csv(one).inputFiles()) == 1


def test_wide_file_becomes_one_array(spark):
    width = 21_000
    path = scratch_path(spark, "wide")
    lines = ["id," + ",".join(f"g{i}" for i in range(width)), "7," + ",".join(["1"] * width)]
    spark.createDataFrame([(line,) for line in lines], "value string").coalesce(1).write.text(path)
    df = spark.read.option("maxColumns", 25000).option("header", True).csv(path)
    assert len(df.columns) == width + 1
    schema = "id int, " + ", ".join(f"g{i} double" for i in range(50))
    narrow = delimited.read_delimited(spark, path, header=True, schema=schema, max_columns=25000)
    folded = delimited.fold_numeric(narrow, ["id"])
    assert folded.columns == ["id", "features"] and folded.select(F.size("features")).first()[0] == 50


def test_spread_is_the_inverse_of_fold(spark):
    df = spark.createDataFrame([(1, [0.5, 1.5])], "id int, v array<double>")
    wide = delimited.spread_array(df, "v", 2, "g")
    assert wide.first().asDict() == {"id": 1, "g0": 0.5, "g1": 1.5}
    assert delimited.fold_numeric(wide, ["id"], "v").first().v == [0.5, 1.5]


def test_wide_text_straight_to_an_array(spark):
    path = scratch_path(spark, "wide-text")
    lines = ['"id",g0,"g,1",g2', '"a ""b""",1,"2.5",x', ',"",-3,4', "c,1", "d,1,2,3,4", '"e,f",1e3,,"7"', ""]
    spark.createDataFrame([(line,) for line in lines], "value string").coalesce(1).write.text(path)
    got = {r.id: r.features for r in delimited.read_wide_numeric(spark, path, ["id"]).collect()}
    assert got == {
        'a "b"': [1.0, 2.5, None], None: [None, -3.0, 4.0], "c": [1.0, None, None],
        "d": [1.0, 2.0, 3.0], "e,f": [1000.0, None, 7.0],
    }
    every = delimited.read_wide_numeric(spark, path, []).collect()
    assert len(every) == 5 and all(len(r.features) == 4 for r in every)


def test_wide_text_equals_the_reader_at_full_width(spark):
    width, rows = 20_531, 12
    path = scratch_path(spark, "wide-text")
    text = spark.range(rows).selectExpr(
        f"concat(id, ',', array_join(transform(sequence(1, {width}), i -> cast(id * 0.25 + i as string)), ',')) AS value"
    )
    header = spark.createDataFrame([("id," + ",".join(f"g{i}" for i in range(width)),)], "value string")
    header.unionAll(text).coalesce(1).write.text(path)
    got = delimited.read_wide_numeric(spark, path, ["id"])
    assert got.columns == ["id", "features"]
    for r in got.collect():
        assert r.features == [int(r.id) * 0.25 + i for i in range(1, width + 1)]


def test_wide_text_needs_a_header(spark):
    path = scratch_path(spark, "empty-text")
    spark.createDataFrame([], "value string").write.text(path)
    with pytest.raises(ValueError, match="no header"):
        delimited.read_wide_numeric(spark, path, ["id"])


def test_named_cache_ends_with_its_block(spark):
    with named_cache(spark.range(3).toDF("k"), "three") as three:
        assert spark.catalog.isCached("three")
        assert three.count() == spark.sql("SELECT count(*) FROM three").first()[0] == 3
    assert not spark.catalog.tableExists("three")
