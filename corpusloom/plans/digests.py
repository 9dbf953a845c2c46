"""Token arrays and turns as texts whose MD5 any engine can compute, so that queries compare values in order and not only lengths."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def spelled(ids: Column) -> Column:
    """Bytes as two hexadecimal digits, -100 as a dot, other ids in brackets."""
    one = lambda x: F.when(x == -100, ".").when((x >= 0) & (x < 256), F.lpad(F.hex(x), 2, "0")).otherwise(F.concat(F.lit("["), x.cast("string"), F.lit("]")))
    return F.array_join(F.transform(ids, one), "")


def wide(ids: Column) -> Column:
    """Every id as four hexadecimal digits."""
    return F.array_join(F.transform(ids, lambda x: F.lpad(F.hex(x), 4, "0")), "")


def digest(ids: Column) -> Column:
    return F.md5(spelled(ids))


def listed(values: Column) -> Column:
    """Numbers of an array, in order."""
    return F.md5(F.array_join(F.transform(values, lambda x: x.cast("string")), ",", "~"))


def told(turns: Column) -> Column:
    """Turns with their roles."""
    return F.md5(F.array_join(F.transform(turns, lambda t: F.concat(t["role"], F.lit(":"), F.coalesce(t["content"], F.lit("~")))), "|"))


# The same in SQL, of texts, lists of numbers and lists of turns.
def sql_listed(values: str) -> str:
    return f"md5(array_to_string(list_transform({values}, lambda x: COALESCE(CAST(x AS VARCHAR), '~')), ','))"


def sql_told(turns: str) -> str:
    return f"md5(array_to_string(list_transform({turns}, lambda x: x.role || ':' || COALESCE(x.content, '~')), '|'))"
