"""Identifier normalisation."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def bare_qid(c: Column) -> Column:
    """``Q`` and digits out of any spelling (``q5``, ``wd:Q5``, ``entity/Q5``, blanks of any kind).

    Null, empty and blank strings give null; a string without such an identifier
    gives null too.
    """
    digits = F.regexp_extract(c, r"(?i)(?:^|[^\p{L}\p{N}])q\s*([0-9]+)[^\p{L}\p{N}]*$", 1)
    return F.when(digits != "", F.concat(F.lit("Q"), digits))


def bare_number(c: Column) -> Column:
    """Decimal digits of a numeric key in any spelling (``relation/5``, `` r5``); null without digits."""
    digits = F.regexp_extract(c.cast("string"), r"(-?[0-9]+)\D*$", 1)
    return F.when(digits != "", digits.cast("decimal(38,0)").cast("string"))
