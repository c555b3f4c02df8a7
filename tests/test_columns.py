import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from tidemart.functions import columns as fn


def test_partition_value_and_missing_key(spark):
    df = spark.createDataFrame([("/m/event_type=click/dt=2024-01-02/part-0.parquet",),
                                ("/m/other=1/part-0.parquet",)], "p string")
    rows = df.select(fn.partition_value("p", "dt").alias("dt"),
                     fn.partition_value("p", "event_type").alias("et")).collect()
    assert rows[0]["dt"] == "2024-01-02" and rows[0]["et"] == "click"
    # H6: a missing key is NULL, never '' (so it never falls inside a range)
    assert rows[1]["dt"] is None


def test_partition_spec_map_decodes_escaped_values(spark):
    df = spark.createDataFrame([("k=a%3Db%2Fc/d=__HIVE_DEFAULT_PARTITION__/e=x+y%25",)], "p string")
    m = df.select(fn.partition_spec_map("p").alias("m")).first()["m"]
    assert m == {"k": "a=b/c", "d": None, "e": "x+y%"}


def test_default_location_rules(spark):
    df = spark.createDataFrame([("dm_sales_stg.orders",), ("dm_sales.orders",), ("other.t",)], "n string")
    out = [r[0] for r in df.select(fn.default_location("n", "dm_", "/data/marts/")).collect()]
    assert out == ["/data/marts/sales/stg/orders", "/data/marts/sales/pa/orders", ""]


def test_json_map_quotes_and_apostrophes(spark):
    df = spark.createDataFrame([("{'db.t': '365'}",), ('{"k": "it\'s"}',), ("not json",)], "j string")
    out = df.select(fn.json_map("j").alias("m")).collect()
    assert out[0]["m"] == {"db.t": "365"}
    assert out[1]["m"] == {"k": "it's"}  # Q14: apostrophes inside values survive
    assert out[2]["m"] is None


def test_map_default(spark):
    df = spark.createDataFrame([("{'a.t': '365'}",)], "j string").select(fn.json_map("j").alias("m"))
    r = df.select(fn.map_default("m", "a.t", "730").alias("a"),
                  fn.map_default("m", "b.t", "730").alias("b")).first()
    assert (r["a"], r["b"]) == ("365", "730")


def test_step_number_exactly_one_number(spark):
    ok = spark.createDataFrame([("stat1.sql",), ("12stat.sql",)], "n string")
    assert [r[0] for r in ok.select(fn.step_number("n")).collect()] == [1, 12]
    for bad in ("stat.sql", "stat1_1.sql"):
        with pytest.raises(PySparkException):
            spark.createDataFrame([(bad,)], "n string").select(fn.step_number("n")).collect()


def test_safe_cast_uncastable_is_null(spark):
    df = spark.createDataFrame([("x",), ("42",)], "v string")
    assert [r[0] for r in df.select(fn.safe_cast("v", "bigint")).collect()] == [None, 42]


def test_date_text_and_cutoff(spark):
    df = spark.createDataFrame([("2020-01-03 10:00:00",)], "t string")
    r = df.select(fn.date_text("t").alias("d"), fn.retention_cutoff("t", 2).alias("c")).first()
    assert r["d"] == "2020-01-03" and r["c"] == "2020-01-01 10:00:00"
    assert fn.cutoff_text("2020-01-03 10:00:00", 2) == "2020-01-01 10:00:00"


def test_epoch_text_is_utc_whatever_the_session_zone(spark):
    old = spark.conf.get("spark.sql.session.timeZone")
    try:
        spark.conf.set("spark.sql.session.timeZone", "America/New_York")
        r = spark.range(1).select(fn.epoch_text(F.lit(1704067201500)).alias("t")).first()
        assert r["t"] == "2024-01-01 00:00:01"
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)


def test_file_factor(spark):
    df = spark.createDataFrame([(0,), (1,), (100,), (185,), (370,)], "b long")
    out = [r[0] for r in df.select(fn.file_factor("b", 100, 1.85)).collect()]
    assert out == [0, 1, 1, 2, 3]  # zero bytes -> no files


def test_change_flag(spark):
    df = spark.createDataFrame([
        ("2024-01-01 00:00:00", "2024-01-02 00:00:00", False, 5),
        ("2024-01-03 00:00:00", "2024-01-02 00:00:00", False, 5),
        ("2024-01-03 00:00:00", "2024-01-02 00:00:00", True, 5),
        ("2024-01-01 00:00:00", "2024-01-02 00:00:00", True, 0),
        ("2024-01-01 00:00:00", None, False, 5),
    ], "load string, mod string, force boolean, rows long")
    out = [r[0] for r in df.select(fn.change_flag("load", "mod", F.col("force"), "rows")).collect()]
    assert out == [1, 0, 1, 0, 0]


def test_statistic_payload(spark):
    r = spark.range(1).select(fn.statistic_payload(5, 7, 11, F.lit("2024-01-01"))).first()[0]
    assert r == '{"loading_id":5,"entity_id":7,"stat_id":11,"avalue":["2024-01-01"]}'


def test_shared_dir_fallback_sets_a_checkpoint_dir_only_when_unset():
    from tidemart.session import shared_dir

    class Conf:
        def __init__(self, value):
            self.value = value

        def get(self, key, default=None):
            return self.value or default

    class Ctx:
        def __init__(self, master="local[2]"):
            self.dir, self.master = None, master

        def getConf(self):
            return Conf(None)

        def getCheckpointDir(self):
            return self.dir

        def setCheckpointDir(self, d):
            self.dir = "file:" + d + "/abc"

    class Session:
        def __init__(self, value, master="local[2]"):
            self.conf = Conf(value)
            self.sparkContext = Ctx(master)

    assert shared_dir(Session("/shared/ckpt/")) == "/shared/ckpt"
    s = Session(None)
    first = shared_dir(s)
    assert first.startswith("file:") and shared_dir(s) == first
    assert shared_dir(Session("/shared/ckpt", "spark://host:7077")) == "/shared/ckpt"
    for master in ("spark://host:7077", "yarn", "local-cluster[2,1,1024]"):
        with pytest.raises(ValueError, match="spark.checkpoint.dir"):
            shared_dir(Session(None, master))
