"""Sources per run mode (O-07): each load lists, for INICIAL/INCREMENTAL, the readers
whose outputs are tagged with a source alias and unioned by name (O-67)."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass
from enum import Enum

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlake.operators.transforms import union_by_name


class RunMode(str, Enum):
    FULL = "INICIAL"
    INCREMENTAL = "INCREMENTAL"


@dataclass(frozen=True)
class SourceSpec:
    name: str
    alias: str                                      # value of the ``origen`` column
    reader: Callable[[SparkSession, dict], DataFrame]
    priority: int = 0                               # list order; first wins in dedups


def read_sources(spark: SparkSession, specs: Sequence[SourceSpec], params: dict | None = None,
                 origin_col: str = "origen", priority_col: str | None = None) -> DataFrame:
    frames = []
    for i, spec in enumerate(specs):
        df = spec.reader(spark, params or {}).withColumn(origin_col, F.lit(spec.alias))
        if priority_col:
            df = df.withColumn(priority_col, F.lit(spec.priority if spec.priority else i))
        frames.append(df)
    return union_by_name(frames)


def sources_for(registry: dict[RunMode, Sequence[SourceSpec]], mode: RunMode | str
                ) -> Sequence[SourceSpec]:
    return registry[RunMode(mode)]
