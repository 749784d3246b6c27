"""Solution sequences: a DataFrame with a typed column for each variable."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.expressions import Typed, common
from ..terms import Kind


def column_name(var: str) -> str:
    return "?" + var


@dataclass
class Solutions:
    df: DataFrame
    kinds: dict[str, Kind]

    def typed(self, var: str) -> Typed:
        return F.col(column_name(var)), self.kinds[var]

    def columns(self) -> dict[str, Typed]:
        return {v: self.typed(v) for v in self.kinds}

    def select(self, columns: dict[str, Typed]) -> Solutions:
        return Solutions(self.df.select(*[c.alias(column_name(v)) for v, (c, _) in columns.items()]), {v: k for v, (_, k) in columns.items()})

    def where(self, condition: Column) -> Solutions:
        return Solutions(self.df.where(condition), self.kinds)

    def extend(self, var: str, value: Typed) -> Solutions:
        return Solutions(self.df.withColumn(column_name(var), value[0]), self.kinds | {var: value[1]})


def unit(spark: SparkSession) -> Solutions:
    """One solution that binds nothing."""
    return Solutions(spark.range(1).select(), {})


def empty(spark: SparkSession, kinds: dict[str, Kind], typed: dict[str, Column] | None = None) -> Solutions:
    """No solutions, of those variables."""
    df = spark.range(0)
    return Solutions(df.select(*[F.lit(None).cast("string").alias(column_name(v)) for v in kinds]), {v: Kind("node") for v in kinds})


def union(parts: list[Solutions]) -> Solutions:
    """All solutions of all parts; what a part does not bind is null there."""
    out = parts[0]
    for other in parts[1:]:
        names = list(dict.fromkeys([*out.kinds, *other.kinds]))
        left, right, kinds = {}, {}, {}
        for v in names:
            if v in out.kinds and v in other.kinds:
                x, y, kinds[v] = common(out.typed(v), other.typed(v))
                left[v], right[v] = (x, kinds[v]), (y, kinds[v])
            else:
                have = out if v in out.kinds else other
                kinds[v] = have.kinds[v].may_lack()
                null = F.lit(None).cast(have.df.schema[column_name(v)].dataType)
                left[v], right[v] = ((have.typed(v)[0], kinds[v]), (null, kinds[v]))[:: 1 if have is out else -1]
        out = Solutions(out.select(left).df.unionByName(other.select(right).df), kinds)
    return out
