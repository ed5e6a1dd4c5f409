"""Text predicates and normalisation."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# Everything str.strip() removes, not only the blank that SQL trim removes.
WHITESPACE = "".join(c for c in map(chr, range(0x3001)) if c.isspace())

# Words that stand for a missing profile field.
ABSENT_WORDS = ("null", "None")

# Fixed value: marker inside the login of an automated account.
BOT_MARK = "[bot]"


def is_present(value: Column, absent: Sequence[str] = ABSENT_WORDS) -> Column:
    """Not NULL and none of the words for "missing"; an empty string is present."""
    return value.isNotNull() & ~value.isin(*absent)


def region(location: Column) -> Column:
    """Part after the last comma of a free-text location, trimmed."""
    return F.btrim(F.substring_index(location, ",", -1), F.lit(WHITESPACE))


def is_bot(login: Column) -> Column:
    return F.contains(login, F.lit(BOT_MARK))


def quoted_list(items: Column, limit: int = 20) -> Column:
    """First ``limit`` items as ``'a','b'``; an empty list gives two quotes."""
    return F.concat(F.lit("'"), F.array_join(F.slice(items, 1, limit), "','"), F.lit("'"))
