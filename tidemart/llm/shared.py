"""Small helpers that the operators of this package share."""

from __future__ import annotations

import shutil
import tempfile
from collections.abc import Iterable
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemart.plans.mart import delete_path
from tidemart.session import work_path

#: A-Z to a-z on UTF-8 bytes; every byte of a longer sequence is left alone.
LOWER = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))
#: The six ASCII white-space characters.
SPACES = b" \t\n\x0b\x0c\r"

#: Rows of an Arrow batch, at most.
BATCH_ROWS = 2000

_SHIPPED: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Send this package's code to the executors, once for each application, and keep the
    batches that Python tasks get small: a text may be long."""
    context = spark.sparkContext
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if int(spark.conf.get(key)) > BATCH_ROWS:
        spark.conf.set(key, str(BATCH_ROWS))
    if context.applicationId not in _SHIPPED:
        top = Path(__file__).resolve().parents[2]
        made = shutil.make_archive(f"{tempfile.mkdtemp(prefix='tidemart-code-')}/tidemart_code",
                                   "zip", top, "tidemart")
        context.addPyFile(made)
        _SHIPPED.add(context.applicationId)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def text_of(docs: DataFrame) -> Column:
    """The whole text; null counts as empty."""
    return F.coalesce(docs["text"], F.lit(""))


def saved(df: DataFrame, label: str) -> DataFrame:
    """Write to the cluster's shared folder and read back: cuts the lineage, and
    every later job sees one and the same result even if executors are lost."""
    path = work_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def discard(table: DataFrame) -> None:
    """Delete the files of a ``saved`` table that no later job reads."""
    for folder in {f.rsplit("/", 1)[0] for f in table.inputFiles()}:
        delete_path(table.sparkSession, folder)


def if_small(df: DataFrame, size: Column, limit: int) -> DataFrame:
    """``df`` with a broadcast hint if its summed ``size`` is at most ``limit`` bytes,
    else as it is (the join then shuffles).  ``df`` should be a saved table."""
    total = df.agg(F.sum(size)).first()[0] or 0
    return F.broadcast(df) if total <= limit else df


def shuffle_parts(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def roots(n: int, links: Iterable[tuple[int, int]]) -> np.ndarray:
    """Connected components of 0..n-1: for each the smallest member."""
    up = list(range(n))

    def top(a: int) -> int:
        while up[a] != a:
            up[a] = up[up[a]]
            a = up[a]
        return a

    for a, b in links:
        a, b = top(a), top(b)
        if a != b:
            up[max(a, b)] = min(a, b)
    return np.array([top(a) for a in range(n)], dtype=np.int64)


_ARROW = {"int": pa.int32(), "long": pa.int64(), "double": pa.float64(), "boolean": pa.bool_(),
          "string": pa.string(), "binary": pa.binary(), "array<int>": pa.list_(pa.int32()),
          "array<long>": pa.list_(pa.int64()), "array<binary>": pa.list_(pa.binary()),
          "array<string>": pa.list_(pa.string())}


def arrow_schema(ddl: str) -> pa.Schema:
    """Arrow schema of a plain "name type, name type" string."""
    return pa.schema([(n, _ARROW[t]) for n, t in (f.split(" ", 1) for f in ddl.split(", "))])


def record_batch(schema: pa.Schema, n: int, /, **columns) -> pa.RecordBatch:
    """``n`` rows of ``schema``: arrays, or one value for all rows; null where not given."""
    arrays = []
    for field in schema:
        value = columns.get(field.name)
        if isinstance(value, pa.ChunkedArray):
            value = value.combine_chunks()
        if isinstance(value, (pa.Array, list, np.ndarray)):
            arrays.append(pa.array(value, type=field.type) if not isinstance(value, pa.Array)
                          else value.cast(field.type))
        else:
            arrays.append(pa.array([value] * n, type=field.type))
    return pa.RecordBatch.from_arrays(arrays, schema=schema)
