"""Read a DataFrame's physical plan through the public ``explain`` API."""

from __future__ import annotations

import contextlib
import io
import re

from pyspark.sql import DataFrame


def plan_text(df: DataFrame, mode: str = "formatted") -> str:
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain(mode)
    return buf.getvalue()


def count_nodes(df: DataFrame, name: str) -> int:
    """How many physical operators of a kind (e.g. ``Exchange``) the plan has."""
    text = plan_text(df, "simple")
    return len(re.findall(rf"\b{re.escape(name)}\b", text))


def has_python(df: DataFrame) -> bool:
    """True if any operator evaluates Python functions (UDFs)."""
    text = plan_text(df, "simple")
    return any(k in text for k in ("BatchEvalPython", "ArrowEvalPython", "PythonUDF", "FlatMapGroupsInPandas"))


def executed(df: DataFrame, op: str) -> int:
    """How many ``op`` operators ran inside whole-stage codegen (``*(n) op``)
    in an executed adaptive plan (run the DataFrame first). Initial plans
    carry no codegen ids, so they are not counted; every Parquet scan that
    ran shows up as ``*(n) ColumnarToRow``. Only the top-level final plan is
    read (the top-level initial plan re-prints subqueries)."""
    text = plan_text(df, "simple").split("\n+- == Initial Plan ==")[0]
    return len(re.findall(rf"\*\(\d+\) {re.escape(op)}\b", text))
