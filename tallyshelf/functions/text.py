"""Text columns: keys, plain text and titles."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def key_text(column: str) -> Column:
    """A join key in one spelling: outer blanks off, upper case. A key of blanks becomes ''."""
    return F.upper(plain_text(column))


def plain_text(column: str) -> Column:
    return F.trim(F.col(column))


def title_text(column: str) -> Column:
    return F.initcap(plain_text(column))
