"""Read what Spark planned, to check it in tests and while tuning."""

from __future__ import annotations

import contextlib
import io
import re

from pyspark.sql import DataFrame


def plan_text(frame: DataFrame, mode: str = "formatted") -> str:
    """What ``explain`` prints. After an action on the same frame this is AQE's final plan."""
    printed = io.StringIO()
    with contextlib.redirect_stdout(printed):
        frame.explain(mode=mode)
    return printed.getvalue()


def plan_steps(frame: DataFrame) -> list[str]:
    """Operator names of the physical plan, top first."""
    return re.findall(r"^[\s:+*\-]*(?:\* )?([A-Z]\w+)(?: \w+)* ?\(\d+\)", plan_text(frame), re.M)


def pushed_filters(frame: DataFrame) -> list[str]:
    return re.findall(r"^PushedFilters: \[(.*)\]$", plan_text(frame), re.M)


def read_columns(frame: DataFrame) -> list[set[str]]:
    """Columns that each file scan reads."""
    schemas = re.findall(r"^ReadSchema: struct<(.*)>$", plan_text(frame), re.M)
    return [set(re.findall(r"(\w+):", s)) for s in schemas]
