"""Metric tables as text."""

from __future__ import annotations

from pyspark.sql import DataFrame

from tessera.functions.text import human


def table_lines(title: str, df: DataFrame, top: int = 60) -> list[str]:
    """A title and the first rows as a Markdown table; the rest of a longer table is counted."""
    rows = df.limit(top + 1).collect()
    show = lambda v: human(v) if isinstance(v, int) and not isinstance(v, bool) else "" if v is None else f"{v:.4f}" if isinstance(v, float) else str(v)
    out = [f"## {title}", "", "| " + " | ".join(df.columns) + " |", "|" + "---|" * len(df.columns)]
    out += ["| " + " | ".join(map(show, r)) + " |" for r in rows[:top]]
    return [*out, "(more rows)", ""] if len(rows) > top else [*out, ""]


def report_lines(tables: dict[str, DataFrame]) -> list[str]:
    return [line for title, df in tables.items() for line in table_lines(title, df)]
