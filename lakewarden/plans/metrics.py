"""Metric specs: named dimensions and measures over one table, asked at any grain."""

from __future__ import annotations

from dataclasses import dataclass

import yaml
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class MetricSpec:
    source: str
    dims: dict[str, str]
    measures: dict[str, str]

    @classmethod
    def from_yaml(cls, text: str) -> MetricSpec:
        spec = yaml.safe_load(text)
        return cls(
            source=spec["source"],
            dims={x["name"]: x["expr"] for x in spec.get("dimensions", [])},
            measures={x["name"]: x["expr"] for x in spec["measures"]},
        )

    def _measures(self, names: list[str]) -> list:
        return [F.expr(self.measures[n]).alias(n) for n in names]

    def query(
        self, df: DataFrame, dims: list[str], measures: list[str],
        where: str | None = None, order_by: list[str] | None = None,
    ) -> DataFrame:
        """Measures by the chosen dimensions; with none, one grand-total row."""
        if where:
            df = df.filter(where)
        groups = [F.expr(self.dims[d]).alias(d) for d in dims]
        out = df.groupBy(*groups).agg(*self._measures(measures))
        return out.orderBy(*order_by) if order_by else out

    def cube(self, df: DataFrame, dims: list[str], measures: list[str]) -> DataFrame:
        """All grains of the dimensions in one pass; ``grain`` has a bit set for every rolled-up one."""
        own = {d: f"__dim_{i}" for i, d in enumerate(dims)}  # measures still see the source's columns
        projected = df.withColumns({own[d]: F.expr(self.dims[d]) for d in dims})
        cubed = projected.cube(*own.values()).agg(F.grouping_id().cast("bigint").alias("grain"), *self._measures(measures))
        return cubed.withColumnsRenamed({n: d for d, n in own.items()})
