"""Ingest: incremental copies of growing tables, and mock records."""

from __future__ import annotations

import uuid
from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from typing import Any

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wardline.sources.versions import Versions


def incremental_copy(source: DataFrame, id_column: str, target: str) -> Any:
    """Copy the rows whose strictly increasing id lies above what was copied before.

    The filter reaches the source (Parquet or JDBC). Rows and new high-water mark become valid
    in one commit, so a copy that stops half-way is simply done again; of two copies at a time
    one fails. The id may be a number, date, time or text. Gives the high-water mark, or None
    if nothing was ever copied.
    """
    spark = source.sparkSession
    versions = Versions(spark, target)
    version, state = versions.read()
    kind = source.schema[id_column].dataType
    fresh = source
    if state:
        mark = F.lit(state["high_water"]).cast(kind)
        fresh = source.filter(F.col(id_column) > mark)
    run = uuid.uuid4().hex
    folder = f"{target.rstrip('/')}/_run={run}"
    fresh.write.parquet(folder)
    # Taken from what was written: the source may have grown since.
    copied = spark.read.schema(fresh.schema).parquet(folder).agg(F.max(id_column).alias("top"))
    highest = copied.select("top", F.col("top").cast("string").alias("text")).first()
    if highest["top"] is None:
        versions.delete(folder)
        return spark.range(1).select(mark).first()[0] if state else None
    versions.commit(
        version,
        {
            "high_water": highest["text"],
            "runs": [*state.get("runs", []), run],
            "schema": fresh.schema.jsonValue(),
        },
    )
    return highest["top"]


def copy_tables(
    sources: Mapping[str, DataFrame], id_columns: Mapping[str, str], root: str, prefix: str = ""
) -> dict[str, Any]:
    """Incremental copies of several tables, each below ``root`` under a prefixed name."""
    return {
        name: incremental_copy(df, id_columns[name], f"{root.rstrip('/')}/{prefix}{name}")
        for name, df in sources.items()
    }


def read_copy(spark: SparkSession, target: str) -> DataFrame:
    """All rows copied so far."""
    _, state = Versions(spark, target).read()
    schema = T.StructType.fromJson(state["schema"])
    return spark.read.schema(schema).parquet(
        *(f"{target.rstrip('/')}/_run={n}" for n in state["runs"])
    )


@dataclass(frozen=True)
class Counting:
    """Field rule: start, start + step, start + 2 step, ... along the iterations."""

    start: int = 0
    step: int = 1


@dataclass(frozen=True)
class Choice:
    """Field rule: one of some texts."""

    options: tuple[str, ...]


@dataclass(frozen=True)
class Between:
    """Field rule: a whole number from low to high, divided by ``scale``."""

    low: int
    high: int
    scale: int = 1


@dataclass(frozen=True)
class Numbered:
    """Field rule: a prefix and a number, like ``User_7``: pattern ``prefix[low-high]``."""

    prefix: str
    low: int
    high: int


Rule = Counting | Choice | Between | Numbered

# Multipliers of the mixing step; any odd numbers of this size would do.
_MIX = (1_103_515_245, 69_069, 1_664_525)
_MODULUS = 2_147_483_648


def _mixed(i: Column, seed: int, field: int) -> Column:
    """A number below 2^31 that depends on iteration, seed and field alone."""
    x = i % F.lit(_MODULUS)
    for m in _MIX:
        x = (x * F.lit(m) + F.lit(seed * 12_345 + field * 7_919 + 1)) % F.lit(_MODULUS)
    return F.floor(x / 64)


def mock_records(
    iterations: DataFrame, i: str, rules: Mapping[str, Rule], seed: int = 0
) -> DataFrame:
    """Made-up records, one per iteration number, the same for the same seed.

    Works on a batch (``spark.range``), a table with a number column, or a rate stream.
    """
    at = F.col(i)
    columns = []
    for n, (name, rule) in enumerate(rules.items()):
        mixed = _mixed(at, seed, n)
        if isinstance(rule, Counting):
            value = F.lit(rule.start) + at * rule.step
        elif isinstance(rule, Choice):
            texts = F.array(*(F.lit(o) for o in rule.options))
            value = F.element_at(texts, (mixed % len(rule.options) + 1).cast("int"))
        else:
            number = F.lit(rule.low) + mixed % (rule.high - rule.low + 1)
            if isinstance(rule, Numbered):
                value = F.concat(F.lit(rule.prefix), number.cast("string"))
            else:
                value = number / rule.scale
        columns.append(value.alias(name))
    return iterations.select(*columns)


def mock_readings(
    spark: SparkSession, n: int, rules: Mapping[str, Rule], seed: int = 0
) -> DataFrame:
    """``n`` made-up records."""
    return mock_records(spark.range(n), "id", rules, seed)


READING_RULES: dict[str, Rule] = {
    "iteration": Counting(1, 1),
    "measurement_type": Choice(("HEART_RATE", "TEMPERATURE", "OXYGEN_SATURATION")),
    "value": Between(300, 1400, 10),
    "device_id": Numbered("MEDICAL_P", 1, 99),
    "battery": Between(0, 100),
}

__all__: Sequence[str] = [
    "READING_RULES",
    "Between",
    "Choice",
    "Counting",
    "Numbered",
    "Rule",
    "copy_tables",
    "incremental_copy",
    "mock_readings",
    "mock_records",
    "read_copy",
]
