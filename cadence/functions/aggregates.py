"""Caller-given figures of a run: what the reference hands each run's events to a callback for.

A figure is ``(kind, value)``: a whole-number expression of one event and how a run's
values become one: ``sum``, ``min``, ``max``, ``first`` or ``last`` (in the run's event order).
All five are mergeable, so the stream carries one number per open run and figure instead
of the run's events.  NULL values are left out of ``sum`` (0 if there is none), ``min`` and
``max`` (NULL if there is none); ``first`` and ``last`` take the event's value as it is.
"""

from __future__ import annotations

from collections.abc import Mapping

import numpy as np
from pyspark.sql import Column
from pyspark.sql import functions as F

KINDS = ("sum", "min", "max", "first", "last")
Figures = Mapping[str, tuple[str, Column]]

_LEAST, _GREATEST = np.iinfo(np.int64).min, np.iinfo(np.int64).max
# What stands for NULL while numbers are merged.
_EMPTY = {"sum": 0, "min": _GREATEST, "max": _LEAST, "first": _LEAST, "last": _LEAST}


def check_figures(figures: Figures) -> None:
    for name, (kind, _) in figures.items():
        if kind not in KINDS:
            raise ValueError(f"{name}: kind must be one of {KINDS}")


def over_run(kind: str, value: Column, order: Column) -> Column:
    """The figure as a Spark aggregate."""
    if kind == "sum":
        return F.coalesce(F.sum(value), F.lit(0)).cast("bigint")
    if kind in ("min", "max"):
        return (F.min if kind == "min" else F.max)(value)
    return (F.min_by if kind == "first" else F.max_by)(value, order)


def filled(kind: str, value: Column) -> Column:
    """The value of one event with NULL as the number that stands for it."""
    return F.coalesce(value.cast("bigint"), F.lit(_EMPTY[kind]))


def over_segments(kind: str, values: np.ndarray, firsts: np.ndarray, lasts: np.ndarray) -> np.ndarray:
    """The figure of each segment values[firsts[i] : lasts[i] + 1]; segments follow one another."""
    if kind == "sum":
        return np.add.reduceat(values, firsts)
    if kind == "min":
        return np.minimum.reduceat(values, firsts)
    if kind == "max":
        return np.maximum.reduceat(values, firsts)
    return values[firsts if kind == "first" else lasts].copy()


def shown(kind: str, value: Column) -> Column:
    """The merged number as a result: what stands for NULL becomes NULL again."""
    return value if kind == "sum" else F.when(value != F.lit(_EMPTY[kind]), value)
