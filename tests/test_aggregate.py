import pytest
from pyspark.errors import PySparkException

from tidemart.operators import aggregate as A


def test_row_count_and_missing_target(spark):
    df = spark.range(10)
    assert A.row_count(df, "id >= 7").first()[0] == 3
    out = {r["table"]: r["row_count"] for r in A.table_row_counts(spark, {"t": df, "": None}).collect()}
    assert out == {"t": 10, "": 0}


def test_max_value_empty_is_null(spark):
    assert A.max_value(spark.range(5), "id", "id > 100").first()[0] is None
    assert A.max_value(spark.range(5), "id").first()[0] == 4


def test_run_marks_skip_nulls(spark):
    marks = spark.createDataFrame([("a", "2024-01-03", None), ("b", "2024-01-02", "x"),
                                   ("c", None, None)], "t string, business_date string, max_cdc_date string")
    r = A.run_marks(marks).first()
    assert (r["business_date"], r["max_cdc_date"]) == ("2024-01-02", "x")


def test_rows_per_table_default_and_groups(spark):
    empty = spark.createDataFrame([], "step int, table string, rows long")
    assert [tuple(r) for r in A.rows_per_table(empty).collect()] == [(0, None, 0)]
    e = spark.createDataFrame([(1, "a", 5), (1, "a", 2), (2, "b", 1)], "step int, table string, rows long")
    assert sorted(tuple(r) for r in A.rows_per_table(e).collect()) == [(1, "a", 7), (2, "b", 1)]
    assert sorted(r[0] for r in A.computed_tables(e).collect()) == ["a", "b"]


def test_resume_step(spark):
    ledger = spark.createDataFrame([
        ("t", 1, "2024-01-01 00:00:00", "r1"), ("t", 2, "2024-01-01 00:00:00", "r1"),
        ("t", 1, "2024-01-02 00:00:00", "r2"), ("t", 3, "2024-01-02 00:00:00", "r1"),
        ("u", 5, "2024-01-01 00:00:00", "r9"),
    ], "target string, step int, ctl_validfrom string, relevance_value string")
    assert A.resume_step(spark, ledger, "t", "r1", True).first()[0] == 3
    assert A.resume_step(spark, ledger, "t", "r2", True).first()[0] == 1
    assert A.resume_step(spark, ledger, "t", "r1", False).first()[0] == 0
    # Q12: no matching row gives 0, not NULL
    assert A.resume_step(spark, ledger, "u", "r1", True).first()[0] == 0
    assert A.resume_step(spark, ledger, "nobody", "r1", True).first()[0] == 0


def test_ordered_steps_rejects_negative(spark):
    ok = spark.createDataFrame([(13,), (1,), (2,)], "step int")
    assert [r[0] for r in A.ordered_steps(ok).collect()] == [1, 2, 13]
    with pytest.raises(PySparkException):
        A.ordered_steps(spark.createDataFrame([(1,), (-1,)], "step int")).collect()


def test_load_delta(spark, scratch):
    path = scratch("delta")
    state = {"df": None}

    def target():
        return spark.read.parquet(path)

    def load():
        spark.range(4).write.mode("overwrite").parquet(path)
    spark.range(2).write.parquet(path)
    r = A.load_delta(spark, target, load).first()
    assert (r["rows_before"], r["rows_after"]) == (2, 4)
    assert state["df"] is None


def test_max_values_one_pass(spark):
    df = spark.createDataFrame([(1, "a"), (5, "b"), (3, "a")], "v int, k string")
    r = A.max_values(df, {"all": ("v", None), "a": ("v", "k = 'a'"), "none": ("v", "k = 'z'")}).first()
    assert (r["all"], r["a"], r["none"]) == (5, 3, None)
