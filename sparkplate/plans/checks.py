"""Plan inspection for tests and tuning: the text of ``explain`` and a few plan facts."""

from __future__ import annotations

import io
import re
from contextlib import redirect_stdout

from pyspark.sql import DataFrame


def plan_text(df: DataFrame, mode: str = "formatted") -> str:
    buf = io.StringIO()
    with redirect_stdout(buf):
        df.explain(mode)
    return buf.getvalue()


def single_partition_exchanges(df: DataFrame) -> int:
    """Number of ``Exchange SinglePartition`` nodes (all rows of a stage into one task)."""
    return plan_text(df, "simple").count("SinglePartition")


def read_schemas(df: DataFrame) -> list[str]:
    """The ``ReadSchema`` of every scan: the columns actually read."""
    return re.findall(r"ReadSchema: (struct<[^\n]*>)", plan_text(df))


def pushed_filters(df: DataFrame) -> list[str]:
    return re.findall(r"PushedFilters: (\[[^\n]*\])", plan_text(df))
