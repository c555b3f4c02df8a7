"""A mart handle: where a partitioned parquet table lives and what it looks like.

The handle is a plain description (location, schema in positional order,
partition columns, optional catalog name).  Reads always pin the schema, so
partition values are never re-typed by inference (``m=01`` stays ``'01'``).
"""

from __future__ import annotations

from dataclasses import dataclass, replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType


@dataclass(frozen=True)
class Mart:
    path: str
    schema: StructType
    partition_by: tuple[str, ...] = ()
    table: str | None = None

    def __post_init__(self):
        names = self.schema.fieldNames()
        missing = [k for k in self.partition_by if k not in names]
        if missing:
            raise ValueError(f"partition columns {missing} are not in the schema")
        if list(self.partition_by) != names[len(names) - len(self.partition_by):]:
            raise ValueError("partition columns must be the last columns of the schema")

    @property
    def columns(self) -> list[str]:
        return self.schema.fieldNames()

    @property
    def data_columns(self) -> list[str]:
        return [c for c in self.columns if c not in self.partition_by]

    @property
    def is_partitioned(self) -> bool:
        return bool(self.partition_by)

    def with_table(self, table: str | None) -> "Mart":
        return replace(self, table=table)

    def with_path(self, path: str) -> "Mart":
        return replace(self, path=path)

    def located(self, spark: SparkSession) -> "Mart":
        """This mart at the place the catalog gives a registered flat mart now (compaction
        moves it to a new folder); other marts stay where they are."""
        if not self.table or self.is_partitioned:
            return self
        row = (spark.sql(f"DESC FORMATTED {self.table}")
               .where("col_name = 'Location'").select("data_type").first())
        return self if row is None else self.with_path(row[0])

    def read_files(self, spark: SparkSession) -> DataFrame:
        """Rows as they are on disk (pinned schema); empty when nothing was written.  A flat
        mart whose switch to a compacted copy was interrupted is read where it was put."""
        path = self.located(spark).path.rstrip("/")
        if not path_exists(spark, path):
            path = f"{path}__compacting"
            if self.is_partitioned or not path_exists(spark, path):
                return spark.createDataFrame([], self.schema)
        return spark.read.schema(self.schema).parquet(path)

    def read(self, spark: SparkSession) -> DataFrame:
        """Rows through the catalog when the mart is registered, else from files."""
        if self.table:
            return spark.table(self.table)
        return self.read_files(spark)


def path_exists(spark: SparkSession, path: str) -> bool:
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    fs = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return bool(fs.exists(p))


def delete_path(spark: SparkSession, path: str) -> bool:
    """Recursively delete one directory (partition folder or superseded copy)."""
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    fs = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return bool(fs.delete(p, True)) if fs.exists(p) else False
