"""The operators addressed by catalog table name.

For code that already works with registered tables (``schema.table``): every
method resolves the table to a :class:`Mart` (location, positional schema,
partition columns) and calls the DataFrame operators.  Methods that answer a
question return small Python values (a count, a max, a partition spec); the
work behind them is a Spark job.
"""

from __future__ import annotations

from typing import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemart.functions.columns import DEFAULT_BLOCKS_PER_FILE
from tidemart.operators import aggregate as agg
from tidemart.operators import partitions as parts
from tidemart.operators.project import transfer_projection
from tidemart.plans.mart import Mart
from tidemart.sources import tables as src


class TableOps:
    def __init__(self, spark: SparkSession, block_bytes: int | None = None,
                 blocks_per_file: float = DEFAULT_BLOCKS_PER_FILE):
        self.spark = spark
        self.block_bytes = block_bytes or src.block_size(spark)
        self.blocks_per_file = blocks_per_file

    # description ---------------------------------------------------------------
    def mart(self, table: str) -> Mart:
        return src.mart_for_table(self.spark, table)

    def columns(self, table: str) -> list[tuple[str, str]]:
        return src.column_plan(self.spark.table(table).schema)

    def location(self, table: str) -> str:
        return src.table_location(self.spark, table)

    def partitions(self, table: str) -> DataFrame:
        return parts.list_partitions(self.spark, self.mart(table))

    def last_modified(self, table: str) -> str | None:
        """UTC text of the newest data file of the table."""
        inv = parts.partition_inventory(self.spark, self.mart(table), with_rows=False)
        return inv.agg(F.max("modified_utc")).first()[0]

    # questions -------------------------------------------------------------------
    def count(self, table: str | None, condition: str | None = None) -> int:
        if not table:
            return 0
        return int(agg.row_count(self.spark.table(table), condition).first()[0])

    def max_value(self, table: str, column: str, condition: str | None = None):
        return agg.max_value(self.spark.table(table), column, condition).first()[0]

    def last_partition(self, table: str, column: str | None = None) -> dict:
        return parts.last_partition_spec(self.spark, self.mart(table), column)

    def scalar(self, sql: str, args: Mapping[str, object] | None = None,
               names: Mapping[str, str] | None = None) -> str | None:
        return src.scalar_value(self.spark, sql, args, names)

    def scalar_from_file(self, pattern: str, args: Mapping[str, object] | None = None,
                         names: Mapping[str, str] | None = None) -> str | None:
        return src.scalar_from_file(self.spark, pattern, args, names)

    # changes ---------------------------------------------------------------------
    def run_sql(self, statements: Sequence[str], args: Mapping[str, object] | None = None,
                names: Mapping[str, str] | None = None) -> DataFrame | None:
        return src.run_sql_script(self.spark, statements, args, names)

    def run_sql_files(self, pattern: str, args: Mapping[str, object] | None = None,
                      names: Mapping[str, str] | None = None) -> DataFrame | None:
        return src.run_sql_files(self.spark, pattern, args, names)

    def transfer(self, source_table: str, target_table: str, date_column: str | None = "report_dt",
                 condition: str | None = None, **constants) -> Mart:
        """Copy the source into the target's column order, replacing the
        partitions the data covers (``condition`` optionally limits the source)."""
        from tidemart.plans.refresh import write_load
        target = self.mart(target_table)
        source = self.spark.table(source_table)
        if condition:
            source = source.filter(F.expr(condition))
        loaded = transfer_projection(source, target.schema, constants, date_column=date_column)
        return write_load(self.spark, source, loaded, target, constants,
                          int(self.block_bytes * self.blocks_per_file))

    def append(self, table: str, **values) -> Mart:
        return src.append_rows(self.spark, [values], self.mart(table))

    def compact(self, table: str, column: str | None = None, start: str | None = None,
                end: str | None = None) -> DataFrame:
        return parts.compact(self.spark, self.mart(table), column, start, end,
                             self.block_bytes, self.blocks_per_file)

    def delete_partitions(self, table: str, column: str | None = None, start: str | None = None,
                          end: str | None = None, allow_full_delete: bool = False) -> DataFrame:
        return parts.delete_partitions(self.spark, self.mart(table), column, start, end,
                                       allow_full_delete)

    def expire(self, table: str, lifetime_days: int, column: str | None = None,
               now: str | None = None, allow_full_delete: bool = False) -> DataFrame:
        return parts.retention(self.spark, self.mart(table), lifetime_days, column, now,
                               allow_full_delete)
