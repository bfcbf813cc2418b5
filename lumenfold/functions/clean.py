"""Column expressions that clean, cap, weight and bin panel values."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

import numpy as np
from pyspark.sql import Column
from pyspark.sql import functions as F

# The text that marks a withheld number, the cap and the weights of
# the composite index, and the bin ends of the index map.
SENTINEL = "PrivacySuppressed"
COMPLETION_CAP = 0.493279
COMPLETION_WEIGHT = 1.0
INDEX_WEIGHTS = {"high_school": 0.4, "some_college": 0.6, "bachelor": 0.8}
NUMBER = r"^\s*[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?\s*$"
BIN_START, BIN_STOP, BIN_ENDS = 0.4, 0.6, 16


def is_blank(value: Column, sentinel: str | None = SENTINEL) -> Column:
    """Condition: null, empty text or the sentinel text."""
    marks = [""] if sentinel is None else ["", sentinel]
    return F.coalesce(value, F.lit("")).isin(*marks)


def blank_to_null(value: Column, sentinel: str | None = SENTINEL) -> Column:
    """Null for the sentinel text and for empty text."""
    filled = F.nullif(value, F.lit(""))
    return filled if sentinel is None else F.nullif(filled, F.lit(sentinel))


def to_number(value: Column) -> Column:
    """Double from text with thousands commas; null for any text that is no finite decimal number."""
    plain = F.replace(value, F.lit(","), F.lit(""))
    number = F.when(plain.rlike(NUMBER), plain.try_cast("double"))
    return F.nullif(F.nullif(number, F.lit(float("inf"))), F.lit(float("-inf")))


def code_prefix(value: Column, length: int = 5) -> Column:
    """Leading characters of a code as a whole number, null if they are not one."""
    return F.substring(value, 1, length).try_cast("long")


def code_text(value: Column, width: int | None = None) -> Column:
    """Numeric code as a text key, with leading zeros up to ``width`` if given."""
    text = value.cast("long").cast("string")
    return text if width is None else F.lpad(text, width, "0")


def completion_share(completions: Column, population: Column, cap: float | None = None) -> Column:
    """100 * completions / population, null for population 0, cut off at ``cap``."""
    share = F.try_divide(completions * 100.0, population)
    return share if cap is None else F.when(share > cap, F.lit(cap)).otherwise(share)


def composite_index(share: Column, parts: Mapping[str, Column], weights: Mapping[str, float] = INDEX_WEIGHTS) -> Column:
    """Weighted sum of the completion share and the attainment percentages, over 100."""
    total = share * COMPLETION_WEIGHT
    for name, weight in weights.items():
        total = total + parts[name] * weight
    return total / 100.0


def bin_ends(start: float = BIN_START, stop: float = BIN_STOP, ends: int = BIN_ENDS) -> Sequence[float]:
    """Equally spaced bin ends."""
    return [float(e) for e in np.linspace(start, stop, ends)]


def bin_number(value: Column, ends: Sequence[float] | None = None) -> Column:
    """Number of bin ends at or below the value: 0 below the first, ``len(ends)`` from the last on."""
    ends = bin_ends() if ends is None else ends
    reached = [(value >= F.lit(e)).cast("int") for e in ends]
    return sum(reached[1:], reached[0])
