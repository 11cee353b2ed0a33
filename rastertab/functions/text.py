"""Path and list text helpers (SCL-13, SCL-16)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def basename(path: Column) -> Column:
    return F.element_at(F.split(path, "/"), -1)


def strip_extension(name: Column) -> Column:
    return F.regexp_replace(name, r"\.[^./]*$", "")


def extension(name: Column) -> Column:
    """Text after the last dot (the whole name when there is none, like ``${f##*.}``)."""
    return F.element_at(F.split(name, r"\."), -1)


def first_field(text: Column, sep: str = "_") -> Column:
    """``cut -f1 -d SEP``."""
    return F.split(text, sep, 2).getItem(0)


def comma_list(text: Column) -> Column:
    return F.transform(F.split(text, ","), lambda s: F.trim(s))


def flatten_lists(col: Column) -> Column:
    """SCL-16: list of lists -> one list."""
    return F.flatten(col)
