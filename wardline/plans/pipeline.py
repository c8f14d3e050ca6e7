"""The whole pipeline as one plan, for batch and stream alike."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame

from wardline.operators.enrich import enrich
from wardline.operators.route import route
from wardline.operators.score import score_all, score_vital, union_scores, with_trust
from wardline.operators.totals import load_typed, totals
from wardline.operators.window import tumble_pivot
from wardline.plans import clocks


@dataclass(frozen=True)
class Clocks:
    """Stage clocks; a missing one means the clock of the batch."""

    enrichment: Column | None = None
    routing: Column | None = None
    scoring: Column | None = None
    union: Column | None = None
    aggregation: Column | None = None
    storage: Column | None = None


def fixed_clocks() -> Clocks:
    """Clocks computed from the row, for repeatable results."""
    return Clocks(
        clocks.enrichment(),
        clocks.routing(),
        clocks.scoring(),
        clocks.union(),
        clocks.aggregation(),
        clocks.storage(),
    )


def scored_readings(
    raw: DataFrame, at: Clocks = Clocks(), on_bad: str = "fail"
) -> DataFrame:
    """Enriched, routed and scored readings with trust, in one pass and without a shuffle."""
    enriched = enrich(raw, on_bad, at.enrichment)
    return with_trust(score_all(enriched, at.routing, at.scoring))


def scored_readings_by_branch(
    raw: DataFrame, at: Clocks = Clocks(), on_bad: str = "fail"
) -> DataFrame:
    """The same rows through six routed branches and a union: scans the input six times."""
    routed = route(enrich(raw, on_bad, at.enrichment), at.routing)
    parts = {code: score_vital(df, code, at.scoring) for code, df in routed.items()}
    return with_trust(union_scores(parts))


def early_warning(
    raw: DataFrame,
    at: Clocks = Clocks(),
    on_bad: str = "fail",
    lateness: str | None = None,
) -> DataFrame:
    """Raw readings to totals per patient and minute; one shuffle in all."""
    scores = tumble_pivot(scored_readings(raw, at, on_bad), lateness=lateness, clock=at.union)
    return totals(scores, at.aggregation)


def stored_table(raw: DataFrame, at: Clocks = Clocks()) -> DataFrame:
    """The totals in their stored form."""
    return load_typed(early_warning(raw, at), at.storage)
