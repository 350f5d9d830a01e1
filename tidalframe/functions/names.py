"""Column-name rules."""

from __future__ import annotations

import re
from collections.abc import Iterable

from pyspark.sql import DataFrame


def snake_names(names: Iterable[str]) -> list[str]:
    """Lower-case, underscore-joined, unique names.

    A name that starts with a digit gets an ``x`` in front; a name that is taken
    gets the first free of ``_2``, ``_3`` … in order of appearance.
    """
    # Symbols that are spelled out.
    spelled = {"%": "_percent_", "#": "_number_"}
    out: list[str] = []
    for name in names:
        for symbol, word in spelled.items():
            name = name.replace(symbol, word)
        name = re.sub(r"(?<=[a-z0-9])(?=[A-Z])", "_", name)
        name = re.sub(r"[^0-9A-Za-z]+", "_", name).strip("_").lower() or "x"
        if name[0].isdigit():
            name = "x" + name
        out.append(free_name(name, out))
    return out


def free_name(name: str, taken: Iterable[str]) -> str:
    """The name, or with the first number from 2 on that makes it a new one."""
    taken, number, out = set(taken), 1, name
    while out in taken:
        number += 1
        out = f"{name}_{number}"
    return out


def clean_names(df: DataFrame) -> DataFrame:
    return df.toDF(*snake_names(df.columns))
