"""Choosing columns by name pattern, position or type.

A selector maps a DataFrame to a list of its column names, so that selectors
can be combined before any data is touched.
"""

from __future__ import annotations

import re
from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import types as T

Selector = Callable[[DataFrame], list[str]]


def contains(text: str) -> Selector:
    return lambda df: [c for c in df.columns if text in c]


def starts_with(text: str) -> Selector:
    return lambda df: [c for c in df.columns if c.startswith(text)]


def ends_with(text: str) -> Selector:
    return lambda df: [c for c in df.columns if c.endswith(text)]


def matches(pattern: str) -> Selector:
    rx = re.compile(pattern)
    return lambda df: [c for c in df.columns if rx.search(c)]


def span(first: str, last: str) -> Selector:
    """Every column from ``first`` to ``last`` in table order."""

    def choose(df: DataFrame) -> list[str]:
        cols = df.columns
        return cols[cols.index(first) : cols.index(last) + 1]

    return choose


def everything() -> Selector:
    return lambda df: list(df.columns)


def numeric() -> Selector:
    return lambda df: [f.name for f in df.schema if isinstance(f.dataType, T.NumericType)]


def nominal() -> Selector:
    return lambda df: [f.name for f in df.schema if isinstance(f.dataType, T.StringType)]


def names(df: DataFrame, *wanted: str | Selector) -> list[str]:
    """Resolve names and selectors, keeping the first mention of each column."""
    out: list[str] = []
    for item in wanted:
        for name in [item] if isinstance(item, str) else item(df):
            if name not in out:
                out.append(name)
    return out


def pick(df: DataFrame, *wanted: str | Selector) -> DataFrame:
    return df.select(*names(df, *wanted))


def omit(df: DataFrame, *unwanted: str | Selector) -> DataFrame:
    return df.drop(*names(df, *unwanted))
