"""Table functions for SQL: ``spark.sql("select ... from t, lateral tiles(t.w, t.h, 4, 2)")`` after ``register``."""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import SparkSession
from pyspark.sql import types as T
from pyspark.sql.udtf import AnalyzeArgument, AnalyzeResult, OrderingColumn, PartitioningColumn


class Tiles:
    """tiles(width, height, cols, rows): (k, x, y, w, h), an even grid of whole pixels."""

    def eval(self, width: int, height: int, cols: int, rows: int) -> Iterator[tuple]:
        if None in (width, height) or cols < 1 or rows < 1:
            return
        w, h = width // cols, height // rows
        for k in range(cols * rows):
            yield k, k % cols * w, k // cols * h, w, h


class Times:
    """times(duration, n): (k, at), n times from 0 to the duration; fewer than one are an error."""

    def eval(self, duration: float, n: int) -> Iterator[tuple]:
        if n < 1:
            raise ValueError("the number of timestamps must be positive")
        for k in range(n):
            yield k, k * duration / (n - 1) if n > 1 else 0.0


class Neighbours:
    """neighbours(table, 'group', 'order', 'item'): each row's item with that of the row before it in its group.

    The table is partitioned and ordered by the columns that are named, so each group is one ordered stream; a group of
    one row gives nothing. The columns of the result are the group, (before, item), of the kinds that the table has.
    """

    @staticmethod
    def analyze(table: AnalyzeArgument, group: AnalyzeArgument, order: AnalyzeArgument, item: AnalyzeArgument) -> AnalyzeResult:
        names = [x.value for x in (group, order, item)]
        if not table.isTable or None in names:
            raise ValueError("neighbours takes a table and the names of three of its columns")
        missing = [n for n in names if n not in table.dataType.names]
        if missing:
            raise ValueError(f"the table has no column {missing[0]}")
        kind = table.dataType[names[2]].dataType
        shape = T.StructType([T.StructField(names[0], table.dataType[names[0]].dataType), T.StructField("before", kind), T.StructField("item", kind)])
        return AnalyzeResult(shape, partitionBy=[PartitioningColumn(names[0])], orderBy=[OrderingColumn(names[1]), OrderingColumn(names[2])])

    def __init__(self):
        self.last = None

    def eval(self, row, group: str, order: str, item: str) -> Iterator[tuple]:
        if self.last is not None:
            yield row[group], self.last[0], row[item]
        self.last = (row[item],)


def register(spark: SparkSession) -> None:
    from pyspark.sql.functions import udtf

    spark.udtf.register("tiles", udtf(Tiles, returnType="k int, x int, y int, w int, h int"))
    spark.udtf.register("times", udtf(Times, returnType="k int, at double"))
    spark.udtf.register("neighbours", udtf(Neighbours))
