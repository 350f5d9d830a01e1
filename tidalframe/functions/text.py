"""Text expressions. All are built-in expressions, so they stay in generated code."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: the first signed number in a text, thousands separators allowed.
NUMBER_PATTERN = r"-?[0-9,]*\.?[0-9]+"


def _col(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def to_number(x) -> Column:
    """Text to double; text that is no number gives null."""
    return _col(x).try_cast("double")


def parse_number(x) -> Column:
    """The number inside a text such as ``$1,234`` or ``12.5%``."""
    found = F.regexp_extract(_col(x), NUMBER_PATTERN, 0)
    return F.regexp_replace(found, ",", "").try_cast("double")


def remove_first(x, pattern: str) -> Column:
    """Drop the first match of a pattern; later matches stay."""
    return F.regexp_replace(_col(x), f"^(.*?)(?:{pattern})", "$1")


def replace_all(x, pattern: str, with_: str) -> Column:
    return F.regexp_replace(_col(x), pattern, with_)


def title(x) -> Column:
    return F.initcap(_col(x))
