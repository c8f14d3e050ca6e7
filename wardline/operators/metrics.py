"""Queries over metric samples: rates of counters, instant values, aggregation by label.

Samples are rows ``(metric, <label columns>, ts, value)``; ``lift_labels`` turns a map of
labels into columns. A *series* is the list of columns that tell one time series from another.

Definitions used throughout: time is cut into epoch-aligned windows ``[start, end)`` and each
series is evaluated once per window, under the window's end (``eval_time``). Only samples inside the window
count, and nothing is extrapolated to its edges.
"""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def lift_labels(samples: DataFrame, names: Sequence[str], labels: str = "labels") -> DataFrame:
    """Turn the named entries of a label map into columns; the map itself goes."""
    rest = [c for c in samples.columns if c != labels]
    return samples.select(*rest, *(F.col(labels)[n].alias(n) for n in names))


def select_series(
    samples: DataFrame,
    equal: Mapping[str, str] | None = None,
    matching: Mapping[str, str] | None = None,
) -> DataFrame:
    """Keep samples whose columns equal a text or match a regular expression as a whole."""
    for name, text in (equal or {}).items():
        samples = samples.filter(F.col(name) == text)
    for name, pattern in (matching or {}).items():
        samples = samples.filter(F.col(name).rlike(f"^(?:{pattern})$"))
    return samples


def _windowed(samples: DataFrame, window: str, step: str | None = None) -> DataFrame:
    bounds = F.window("ts", window, step or window)
    return samples.withColumn("_w", bounds).withColumn("eval_time", F.col("_w.end").cast("timestamp_ntz"))


def window_seconds(window: str) -> int:
    """Length of a window like ``5 minutes`` in seconds."""
    amount, unit = window.split()
    sizes = {"second": 1, "minute": 60, "hour": 3600, "day": 86400}
    return int(amount) * sizes[unit.rstrip("s")]


def _one_per_time(samples: DataFrame, series: Sequence[str]) -> DataFrame:
    """One value per series and time, the largest; unknown values and times are no samples."""
    known = samples.filter(F.col("value").isNotNull() & F.col("ts").isNotNull())
    return known.groupBy(*series, "ts").agg(F.max(F.col("value").cast("double")).alias("value"))


def counter_rate(
    samples: DataFrame,
    series: Sequence[str],
    window: str,
    step: str | None = None,
    piece: str = "1 minute",
) -> DataFrame:
    """Increase per second of a counter in each window: ``<series>, eval_time, value``.

    A value below its predecessor in the series means the counter was reset, and counts in full.
    The step from one sample to the next belongs to the later one's window, so windows add up to
    the counter's growth. ``step`` evaluates windows that often, overlapping if it is shorter than
    they are. A window has a rate if a sample in it has a predecessor.

    A series is worked through in pieces of time, of length ``piece`` or what divides window and step,
    which are joined up by their first and last values; one busy series is many tasks' work.
    """
    length, hop = window_seconds(window), window_seconds(step or window)
    micros = math.gcd(length, hop, window_seconds(piece)) * 1_000_000
    at = F.unix_micros(F.col("ts").cast("timestamp"))
    cut = _one_per_time(samples, series).withColumn("_piece", F.floor(at / micros) * micros)
    inside = Window.partitionBy(*series, "_piece").orderBy("ts")
    steps = cut.withColumn("_step", _increase(F.lag("value").over(inside), F.col("value")))
    parts = steps.groupBy(*series, "_piece").agg(
        F.sum("_step").alias("_inside"),
        F.min_by("value", "ts").alias("_first"),
        F.max_by("value", "ts").alias("_last"),
    )
    along = Window.partitionBy(*series).orderBy("_piece")
    between = _increase(F.lag("_last").over(along), F.col("_first"))
    grown = parts.withColumn("_between", between).filter("_inside is not null or _between is not null")
    placed = grown.select(
        *series,
        F.timestamp_micros("_piece").cast("timestamp_ntz").alias("ts"),
        (F.coalesce("_inside", F.lit(0.0)) + F.coalesce("_between", F.lit(0.0))).alias("_grown"),
    )
    return (
        _windowed(placed, window, step)
        .groupBy(*series, "eval_time")
        .agg((F.sum("_grown") / length).alias("value"))
    )


def _increase(before: Column, now: Column) -> Column:
    return F.when(before.isNull(), None).when(now < before, now).otherwise(now - before)


def irate(samples: DataFrame, series: Sequence[str], window: str) -> DataFrame:
    """Increase per second between the last two samples of each window.

    Spark limits the ranked groups before it shuffles, so two rows per series, window and map
    task travel, however many samples there are.
    """
    order = Window.partitionBy(*series, "eval_time").orderBy(F.col("ts").desc())
    last_two = (
        _windowed(_one_per_time(samples, series), window)
        .select(*series, "eval_time", "ts", "value")
        .withColumn("_rank", F.row_number().over(order))
        .filter(F.col("_rank") <= 2)
    )

    def pick(column: str, rank: int) -> Column:
        return F.max(F.when(F.col("_rank") == rank, F.col(column)))

    pairs = last_two.groupBy(*series, "eval_time").agg(
        pick("value", 1).alias("_now"),
        pick("value", 2).alias("_before"),
        pick("ts", 1).alias("_t1"),
        pick("ts", 2).alias("_t2"),
    )
    micros = F.unix_micros(F.col("_t1").cast("timestamp")) - F.unix_micros(
        F.col("_t2").cast("timestamp")
    )
    return pairs.filter(F.col("_t2").isNotNull()).select(
        *series,
        "eval_time",
        (_increase(F.col("_before"), F.col("_now")) / (micros / 1_000_000)).alias("value"),
    )


def instant(
    samples: DataFrame, series: Sequence[str], at: str, lookback: str = "5 minutes"
) -> DataFrame:
    """The last value of each series at a time, no older than ``lookback``: ``<series>, value``."""
    moment = F.lit(at).cast("timestamp_ntz")
    recent = samples.filter(
        (F.col("ts") <= moment) & (F.col("ts") > moment - F.expr(f"INTERVAL {lookback}"))
    )
    return recent.groupBy(*series).agg(F.max_by("value", "ts").alias("value"))


def instant_range(
    samples: DataFrame,
    series: Sequence[str],
    step: str,
    lookback: str = "5 minutes",
    start: str | None = None,
    end: str | None = None,
    piece: int = 360,
) -> DataFrame:
    """The last value of each series at every step of a grid: ``<series>, eval_time, value``.

    Steps are multiples of ``step`` since the epoch, from ``start`` to ``end`` where they are given (both included). At a
    step counts the last sample at it or before, if it is younger than ``lookback``; of several at one time the largest.
    A series without such a sample has no row there.

    Only the last sample before each step matters, so samples combine to one per step before anything is
    ordered. What is left of a series is worked through in pieces of ``piece`` steps; a piece hands its last sample on to
    the steps before the next piece with a sample, so one busy series is many tasks' work.
    """
    micros, valid = window_seconds(step) * 1_000_000, window_seconds(lookback) * 1_000_000
    at = F.unix_micros(F.col("ts").cast("timestamp"))
    known = samples.filter(F.col("value").isNotNull() & F.col("ts").isNotNull())
    if end is not None:
        known = known.filter(F.col("ts") <= F.lit(end).cast("timestamp_ntz"))
    if start is not None:  # an older sample is stale at the first step
        oldest = F.lit(start).cast("timestamp_ntz") - F.expr(f"INTERVAL {lookback}")
        known = known.filter(F.col("ts") > oldest)
    value = F.col("value").cast("double")
    cells = (
        known.select(*series, value.alias("value"), at.alias("_at"))
        .withColumn("_first", F.ceil(F.col("_at") / micros) * micros)
        .groupBy(*series, "_first")
        .agg(F.max(F.struct("_at", "value")).alias("_last"))
        .select(*series, "_first", "_last.*")
        .withColumn("_piece", F.floor(F.col("_first") / (micros * piece)))
    )
    inside = Window.partitionBy(*series, "_piece").orderBy("_first")
    along = Window.partitionBy(*series).orderBy("_piece")
    # where the next piece with a sample begins
    nexts = cells.groupBy(*series, "_piece").agg(F.min("_first").alias("_begins"))
    nexts = nexts.withColumn("_handed", F.lead("_begins").over(along)).drop("_begins")
    same = [F.col(f"c.{c}").eqNullSafe(F.col(f"n.{c}")) for c in [*series, "_piece"]]
    condition = same[0]
    for one in same[1:]:
        condition = condition & one
    following = F.coalesce("_next", "_handed")
    # the last step that is reached: one before the next sample's, and before the sample is stale
    last = F.floor((F.col("_at") + valid - 1) / micros) * micros
    last = F.least(last, F.coalesce(following - micros, last))
    filled = (
        cells.withColumn("_next", F.lead("_first").over(inside))
        .alias("c")
        .join(nexts.alias("n"), condition)
        .select(*(F.col(f"c.{c}").alias(c) for c in series), "_first", "value", last.alias("_until"))
        .filter("_first <= _until")
        .select(*series, "value", F.explode(F.expr(f"sequence(_first, _until, {micros}L)")).alias("_step"))
    )
    grid = filled.select(*series, F.timestamp_micros("_step").cast("timestamp_ntz").alias("eval_time"), "value")
    if start is not None:
        grid = grid.filter(F.col("eval_time") >= F.lit(start).cast("timestamp_ntz"))
    if end is not None:
        grid = grid.filter(F.col("eval_time") <= F.lit(end).cast("timestamp_ntz"))
    return grid


def instant_per_window(samples: DataFrame, series: Sequence[str], window: str) -> DataFrame:
    """The last value of each series in each window: ``<series>, eval_time, value``."""
    return (
        _windowed(samples, window)
        .groupBy(*series, "eval_time")
        .agg(F.max_by("value", "ts").alias("value"))
    )


def aggregate_by(vector: DataFrame, how: str, by: Sequence[str] = ()) -> DataFrame:
    """``sum``, ``avg``, ``count``, ``min`` or ``max`` over the series of a vector, per label."""
    value = {"sum": F.sum, "avg": F.avg, "count": F.count, "min": F.min, "max": F.max}[how]
    grouped = vector.groupBy(*by) if by else vector.groupBy()
    return grouped.agg(value("value").alias("value"))


def sum_by(vector: DataFrame, by: Sequence[str]) -> DataFrame:
    """Sum over all series that agree in the given labels."""
    return aggregate_by(vector, "sum", by)


def sum_without(vector: DataFrame, drop: Sequence[str]) -> DataFrame:
    """Sum over the given labels: group by every other column of the vector."""
    return aggregate_by(vector, "sum", [c for c in vector.columns if c not in {*drop, "value"}])


def aggregate_sets(vector: DataFrame, how: str, sets: Mapping[str, Sequence[str]]) -> DataFrame:
    """Several aggregates by label at once: one scan, one exchange, a row per set and its labels.

    ``panel`` names the set; labels that a set does not have are null there. A label that is null in the
    vector forms a group of its own, as in ``aggregate_by``.
    """
    labels = list(dict.fromkeys(c for by in sets.values() for c in by))
    value = {"sum": F.sum, "avg": F.avg, "count": F.count, "min": F.min, "max": F.max}[how]
    grouped = vector.groupingSets([[F.col(c) for c in by] for by in sets.values()], *labels)
    found = grouped.agg(value("value").alias("value"), F.grouping_id(*labels).alias("_set"))
    # the set as Spark numbers it: a bit for each label that is left out, the first label's highest
    numbers = {
        name: sum(1 << (len(labels) - 1 - i) for i, c in enumerate(labels) if c not in by) for name, by in sets.items()
    }
    if len(set(numbers.values())) < len(numbers):
        raise ValueError("two sets have the same labels")
    panel = F.lit(None).cast("string")
    for name, number in numbers.items():
        panel = F.when(F.col("_set") == number, F.lit(name)).otherwise(panel)
    return found.select(panel.alias("panel"), *labels, "value")


def scaled(vector: DataFrame, factor: float) -> DataFrame:
    """Multiply every value by a number."""
    return vector.withColumn("value", F.col("value") * F.lit(factor))


def vector_add(left: DataFrame, right: DataFrame, on: Sequence[str]) -> DataFrame:
    """Add two vectors that have one value each per ``on``; others than pairs give nothing.

    Two values on one side stop the job: the match would not be one to one.
    """
    both = left.select(*on, F.col("value").alias("_l"), F.lit(None).cast("double").alias("_r"))
    both = both.unionByName(
        right.select(*on, F.lit(None).cast("double").alias("_l"), F.col("value").alias("_r"))
    )
    pairs = both.groupBy(*on).agg(
        F.max("_l").alias("_l"),
        F.max("_r").alias("_r"),
        F.count("_l").alias("_nl"),
        F.count("_r").alias("_nr"),
    )
    many = F.raise_error(F.lit("more than one value on one side of a match")).cast("double")
    value = F.when((F.col("_nl") > 1) | (F.col("_nr") > 1), many).otherwise(
        F.col("_l") + F.col("_r")
    )
    found = pairs.filter((F.col("_nl") > 0) & (F.col("_nr") > 0))
    return found.select(*on, value.alias("value"))


def topk(vector: DataFrame, k: int, per: Sequence[str], tie: Sequence[str]) -> DataFrame:
    """The ``k`` highest values per time; ``tie`` makes the choice among equal values fixed.

    Ranked groups are limited before the shuffle: ``k`` rows per time and map task travel.
    """
    order = Window.partitionBy(*per).orderBy(F.col("value").desc(), *tie)
    ranked = vector.withColumn("_rank", F.row_number().over(order))
    return ranked.filter(F.col("_rank") <= k).drop("_rank")


def label_values(samples: DataFrame, label: str, metric: str | None = None) -> DataFrame:
    """The distinct values of a label, optionally of one metric only."""
    chosen = samples if metric is None else samples.filter(F.col("metric") == metric)
    return chosen.select(F.col(label).alias("label_value")).distinct()


def range_reduce(samples: DataFrame, series: Sequence[str]) -> DataFrame:
    """Highest and last known value of each series over all its samples."""
    known = F.col("value").isNotNull()
    return samples.groupBy(*series).agg(
        F.max("value").alias("max_value"),
        F.max_by(F.col("value"), F.when(known, F.col("ts"))).alias("last_not_null"),
    )


def panel(
    samples: DataFrame, metrics: Sequence[str], label: str, window: str
) -> DataFrame:
    """Several plain selections at once: last value per metric, label and window."""
    chosen = samples.filter(F.col("metric").isin(*metrics))
    return instant_per_window(chosen, ["metric", label], window)
