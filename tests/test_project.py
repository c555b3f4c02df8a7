import pytest
from pyspark.sql.types import LongType, StringType, StructField, StructType

from tidemart.operators import project as proj


def test_transfer_projection_constants_casts_and_date(spark):
    src = spark.createDataFrame([("x", "7", "2024-05-01 12:00:00")], "a string, b string, report_dt string")
    target = StructType([StructField("ctl_loading", LongType()), StructField("a", LongType()),
                         StructField("b", LongType()), StructField("report_dt", StringType())])
    # Q2: the constant does not exist in the source; F7: 'x' does not fit bigint
    r = proj.transfer_projection(src, target, {"ctl_loading": 99}).first()
    assert r.asDict() == {"ctl_loading": 99, "a": None, "b": 7, "report_dt": "2024-05-01"}


def test_transfer_projection_unknown_column_raises(spark):
    src = spark.createDataFrame([(1,)], "a long")
    with pytest.raises(ValueError):
        proj.transfer_projection(src, StructType([StructField("zz", LongType())]))


def test_conform_schema(spark):
    df = spark.createDataFrame([(1, "u")], "a long, extra string")
    schema = StructType([StructField("b", StringType()), StructField("a", LongType())])
    assert proj.conform_schema(df, schema).first().asDict() == {"b": None, "a": 1}
    with pytest.raises(ValueError):
        proj.conform_schema(df, schema, strict=True)


def test_rename_by_position(spark):
    df = spark.createDataFrame([(1, "u")], "x long, y string")
    schema = StructType([StructField("a", StringType()), StructField("b", StringType())])
    assert proj.rename_by_position(df, schema).first().asDict() == {"a": "1", "b": "u"}


def test_partition_filter_and_empty_spec(spark):
    df = spark.createDataFrame([("a", "1"), ("b", None), ("a", "2")], "k string, d string")
    assert proj.partition_filter(df, {}).count() == 3
    assert proj.partition_filter(df, {"k": "a", "d": "2"}).count() == 1
    assert proj.partition_filter(df, {"d": None}).count() == 1


def test_range_filter_boundary_and_null(spark):
    df = spark.createDataFrame([("2020-01-01",), ("2020-01-02",), (None,)], "d string")
    # Q7: the boundary day is inside because '2020-01-01' <= '2020-01-01 10:00:00'
    kept = [r[0] for r in proj.range_filter(df, "d", None, "2020-01-01 10:00:00").collect()]
    assert kept == ["2020-01-01"]
    assert proj.range_filter(df, "d").count() == 2  # NULL never matches


def test_visible_paths(spark):
    df = spark.createDataFrame([("/r/a=1",), ("/r/_tmp/a=1",), ("/r/.x",), ("/r/b=2",), ("/_r/a=3",)],
                               "p string")
    out = sorted(r[0] for r in proj.visible_paths(df, "p", "/r/", "/r/a=.*|/r/b=.*|/r/.*").collect())
    assert out == ["/r/a=1", "/r/b=2"]
