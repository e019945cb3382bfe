from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, functions as F

from inplay.schema import FEATURE_DISPLAY_NAMES, HIT_EVENTS


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def hit_label(outcome: Column | str = "events", hits: Sequence[str] = HIT_EVENTS) -> Column:
    """True for an outcome on the list; an unknown outcome is False, never null."""
    return F.coalesce(_col(outcome).isin(*hits), F.lit(False))


def label_text(label: Column | str = "is_hit", yes: str = "Hit", no: str = "Non-Hit") -> Column:
    """Text of a boolean label; null stays null."""
    return F.when(_col(label), yes).when(~_col(label), no)


def sign_label(c: Column | str) -> Column:
    """``positive`` above zero, else ``negative`` (zero included)."""
    return F.when(_col(c) > 0, "positive").otherwise("negative")


def threshold_label(p: Column | str, threshold: float = 0.5, strict: bool = False) -> Column:
    """0/1 decision. Reports count ``p >= threshold``; a model's own decision is ``p > threshold``."""
    hit = _col(p) > F.lit(threshold) if strict else _col(p) >= F.lit(threshold)
    return hit.cast("int")


def as_label(c: Column | str) -> Column:
    """0/1 of a boolean or numeric label."""
    return _col(c).cast("int")


def count_where(condition: Column) -> Column:
    """Rows that satisfy the condition; a null condition counts as no."""
    return F.count(F.when(condition, 1))


def display_name(name: Column | str, names: Mapping[str, str] = FEATURE_DISPLAY_NAMES) -> Column:
    """Look a feature name up, keeping names that are not listed."""
    pairs = [F.lit(x) for item in names.items() for x in item]
    return F.coalesce(F.create_map(*pairs)[_col(name)], _col(name))
