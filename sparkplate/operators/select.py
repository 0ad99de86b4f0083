"""Selection by position in a total order without ranking all rows (O1).

The rows at the front of an order are told apart by a histogram of a coarse prefix of the
first order column: counts per prefix (a partial aggregate) show in which prefix the n-th row
lies, and only the rows of that prefix are ordered. What comes out is the n-th row itself, and
from it a plain predicate over the order columns: no positions are stored and no row is
joined or written for them. A prefix that holds a large share of the rows is ordered by the
distributed ``global_row_number``.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sparkplate.operators.ids import global_row_number
from sparkplate.session import cut_lineage

#: A prefix with so few rows (its count is known) is ordered in one task.
SMALL_EDGE = 100_000


@dataclass(frozen=True)
class Key:
    """One column of an order; nulls come last when descending, first when ascending."""
    name: str
    descending: bool = False

    def column(self) -> Column:
        c = F.col(self.name)
        return c.desc_nulls_last() if self.descending else c.asc_nulls_first()

    def before(self, value) -> Column:
        """Whether a row's value comes before ``value``."""
        c = F.col(self.name)
        if self.descending:
            return c.isNotNull() if value is None else F.coalesce(c > F.lit(value), F.lit(False))
        return F.lit(False) if value is None else c.isNull() | (c < F.lit(value))


def up_to(order: Sequence[Key], row) -> Column:
    """Whether a row comes before ``row`` (a mapping by column name) or is it."""
    cond = F.lit(True)
    for key in reversed(order):
        cond = key.before(row[key.name]) | (F.col(key.name).eqNullSafe(F.lit(row[key.name])) & cond)
    return cond


class Front:
    """The first rows of ``df`` under ``order``, whose first column is a descending text.

    ``prefix`` characters of it make up the histogram: 10 for one row per calendar day of
    ``yyyy-MM-dd...`` dates. The order must be total over the rows.
    """

    def __init__(self, df: DataFrame, order: Sequence[Key], prefix: int = 10, num_partitions: int | None = None):
        self.df, self.order, self.num_partitions = df, list(order), num_partitions
        if not self.order[0].descending:
            raise ValueError("the first order column must be descending")
        self.bin = F.substring(F.col(self.order[0].name), 1, prefix)
        counts = df.groupBy(self.bin.alias("bin")).agg(F.count(F.lit(1)).alias("n"))
        # one row per prefix from here on
        running = Window.orderBy(F.col("bin").desc_nulls_last()).rowsBetween(Window.unboundedPreceding, 0)
        self.histogram = cut_lineage(counts.withColumn("upto", F.sum("n").over(running)))
        self.total = self.histogram.agg(F.max("upto")).first()[0] or 0
        self._ranked: dict = {}

    def first(self, n: int) -> Column:
        """A predicate that holds for the first ``n`` rows."""
        if n <= 0:
            return F.lit(False)
        if n >= self.total:
            return F.lit(True)
        edge = self.histogram.where(F.col("upto") >= n).orderBy("upto").first()
        if edge["bin"] not in self._ranked:
            rows = self.df.where(self.bin.eqNullSafe(F.lit(edge["bin"]))).select(*[k.name for k in self.order])
            columns = [k.column() for k in self.order]
            self._ranked[edge["bin"]] = (
                rows.withColumn("_pos", F.row_number().over(Window.orderBy(*columns))) if edge["n"] <= SMALL_EDGE
                else global_row_number(rows, columns, "_pos", self.num_partitions))
        place = n - (edge["upto"] - edge["n"])
        return up_to(self.order, self._ranked[edge["bin"]].where(F.col("_pos") == place).first().asDict())
