"""Early-warning scores for patients from vital-sign readings, on Spark.

Every transform goes from DataFrame to DataFrame and works on batches and streams alike.
"""

from wardline.operators.enrich import enrich, split_bad
from wardline.operators.latest import apply_cdc, latest_per_key
from wardline.operators.lifecycle import tier_split, within_retention
from wardline.operators.metrics import (
    aggregate_by,
    counter_rate,
    instant,
    irate,
    label_values,
    sum_by,
    sum_without,
    topk,
    vector_add,
)
from wardline.operators.route import route, route_together, route_vital
from wardline.operators.score import (
    score_all,
    score_together,
    score_vital,
    union_scores,
    with_trust,
)
from wardline.operators.serve import (
    half_hour_all,
    half_hour_mean,
    max_latency,
    patients,
    stage_latency,
)
from wardline.operators.totals import load_typed, mean_trust, totals, with_risk
from wardline.operators.window import tumble_pivot
from wardline.plans.pipeline import Clocks, early_warning, stored_table
from wardline.session import build_session, prepare
from wardline.sources.ingest import copy_tables, incremental_copy, mock_readings, read_copy
from wardline.sources.tiered import TieredTable
from wardline.sources.upsert import UpsertTable
from wardline.streaming.pipeline import Staged, start_fused

__all__ = [
    "Clocks",
    "Staged",
    "TieredTable",
    "UpsertTable",
    "aggregate_by",
    "apply_cdc",
    "build_session",
    "copy_tables",
    "counter_rate",
    "early_warning",
    "enrich",
    "half_hour_all",
    "half_hour_mean",
    "incremental_copy",
    "instant",
    "irate",
    "label_values",
    "latest_per_key",
    "load_typed",
    "max_latency",
    "mean_trust",
    "mock_readings",
    "patients",
    "prepare",
    "read_copy",
    "route",
    "route_together",
    "route_vital",
    "score_all",
    "score_together",
    "score_vital",
    "split_bad",
    "stage_latency",
    "start_fused",
    "stored_table",
    "sum_by",
    "sum_without",
    "tier_split",
    "topk",
    "totals",
    "tumble_pivot",
    "union_scores",
    "vector_add",
    "with_risk",
    "with_trust",
    "within_retention",
]
