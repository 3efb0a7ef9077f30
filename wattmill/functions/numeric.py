"""Scalar numeric expressions used by the cleaning and feature operators."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: The two inverse-transform clips in use: scoring in original space, and log-space scoring.
CLIP_SCRIPT = (0.0, None)
CLIP_TRAIN = (-10.0, 20.0)


def to_number(text: Column, kind: str = "double") -> Column:
    """Number held by a string; anything unparsable, and NaN, becomes null."""
    value = text.try_cast(kind)
    return F.when(~F.isnan(value), value)


def safe_ratio(top: Column, bottom: Column) -> Column:
    """``top / bottom`` with a zero denominator giving null instead of an error."""
    return top / F.nullif(bottom, F.lit(0).cast("double"))


def amperage(connection: Column) -> Column:
    """Phases times amperes of a connection label such as ``3x25`` (prefix match), else null."""
    label = F.trim(connection)
    phases = F.regexp_extract(label, r"^([0-9]+)x([0-9]+)", 1).try_cast("double")
    amperes = F.regexp_extract(label, r"^([0-9]+)x([0-9]+)", 2).try_cast("double")
    return phases * amperes


def share_of(count: Column, percent: Column) -> Column:
    """The part of ``count`` that ``percent`` (0-100) stands for."""
    return count * percent / F.lit(100.0)


def clamp(value: Column, low: float | None, high: float | None) -> Column:
    """``value`` limited to ``[low, high]``; null stays null."""
    out = value
    if high is not None:
        out = F.when(out.isNotNull(), F.least(out, F.lit(high)))
    if low is not None:
        out = F.when(out.isNotNull(), F.greatest(out, F.lit(low)))
    return out


def unit_interval(value: Column) -> Column:
    return clamp(value, 0.0, 1.0)


def from_log(prediction: Column, clip: tuple[float | None, float | None] = CLIP_SCRIPT) -> Column:
    """Undo ``log1p`` after clipping."""
    return F.expm1(clamp(prediction, *clip))
