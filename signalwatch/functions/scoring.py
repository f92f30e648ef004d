"""Business rules over trend features."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from signalwatch import constants as C
from signalwatch.functions.numeric import clip, weighted_sum


def emergence_score(weights: Mapping[str, float] = C.EMERGENCE_WEIGHTS) -> Column:
    """Weighted sum of the named features, each first limited to -1..1."""
    parts = {name: clip(F.col(name), -1, 1) for name in weights}
    return weighted_sum(parts, dict(weights))


def trend_phase(growth: Column, acceleration: Column,
                labels: Sequence[str] = C.PHASES) -> Column:
    """One of four phases, by the signs of growth and acceleration."""
    speeding, steady, recovering, declining = labels
    return (
        F.when((growth > 0) & (acceleration > 0), F.lit(speeding))
        .when((growth > 0) & (acceleration <= 0), F.lit(steady))
        .when((growth <= 0) & (acceleration > 0), F.lit(recovering))
        .otherwise(F.lit(declining))
    )


def alert_level(alert: Column, critical: float = C.CRITICAL_ALERT) -> Column:
    return F.when(alert > critical, F.lit("critical")).otherwise(F.lit("standard"))


def profile_of(category: Column, profiles: Mapping[str, Sequence[str]],
               default: str = C.DEFAULT_PROFILE) -> Column:
    """The first profile listing the category. A fixed list needs no join."""
    chosen = None
    for profile, members in profiles.items():
        hit = category.isin(list(members))
        chosen = F.when(hit, profile) if chosen is None else chosen.when(hit, profile)
    return F.lit(default) if chosen is None else chosen.otherwise(F.lit(default))
