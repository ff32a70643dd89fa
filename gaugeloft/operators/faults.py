"""Deliberate faults in lines of text, for resilience tests."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from gaugeloft.functions.naming import key_hash


def is_faulty(row_id: Column, percent: int) -> Column:
    """True for about ``percent`` of 100 rows, always the same ones."""
    return key_hash(row_id) % 100 < percent


def damage(line: Column, row_id: Column, percent: int) -> Column:
    """Comma-separated lines, some cut off after two fields, with letters in the last field, or with one field more."""
    kind = F.floor(key_hash(row_id) / 100) % 3
    cut = F.substring_index(line, ",", 2)
    lettered = F.concat(line, F.lit("abc"))
    longer = F.concat(line, F.lit(",extra"))
    damaged = F.when(kind == 0, cut).when(kind == 1, lettered).otherwise(longer)
    return F.when(is_faulty(row_id, percent), damaged).otherwise(line)
