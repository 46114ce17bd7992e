"""Code and value lists as text: the forms the raw tables use, both ways."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# What counts as a member. The word pattern decides which codes an old table holds, so it must be this one.
QUOTED = r"'([^']+)'"
WORD = r"[-+]?\d+\.\d+|\b\w+\b"


def join_list(items: Column, separator: str = ",") -> Column:
    """``a,b,c``; NULL members are left out."""
    return F.array_join(items.cast("array<string>"), separator)


def bracket_list(items: Column) -> Column:
    """``[1.0,2.0]``."""
    return F.concat(F.lit("["), join_list(items), F.lit("]"))


def quote_list(items: Column) -> Column:
    """``['a','b']``."""
    quoted = F.transform(items.cast("array<string>"), lambda x: F.concat(F.lit("'"), x, F.lit("'")))
    return bracket_list(quoted)


def split_list(text: Column, separator: str = ",") -> Column:
    return F.split(text, separator)


def bracket_items(text: Column) -> Column:
    """Members of ``[1.0,2.0]`` as text, without blanks and stray letters of ``val``."""
    inner = F.btrim(text, F.lit("[]"))
    return F.transform(F.split(inner, ","), lambda x: F.btrim(x, F.lit("val ")))


def quoted_items(text: Column) -> Column:
    """Every single-quoted member."""
    return F.regexp_extract_all(text, F.lit(QUOTED), F.lit(1))


def word_items(text: Column) -> Column:
    """Every decimal number or word, quoted or not."""
    return F.regexp_extract_all(text, F.lit(WORD), F.lit(0))


def literal_items(text: Column) -> Column:
    """Members of a list literal; an unreadable text gives an empty list."""
    return F.coalesce(F.from_json(text, "array<string>"), F.array().cast("array<string>"))
