"""Query registry shared by the driver entry point, the bench and the tests."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from locusframe.session import prepare


@dataclass(frozen=True)
class Query:
    """A Spark query and, where SQL can say the same, its text for another engine."""

    run: Callable[[SparkSession, str], DataFrame]
    oracle: str | None = None

    def __call__(self, spark: SparkSession, sf_dir: str) -> DataFrame:
        return self.run(prepare(spark), sf_dir)


def longs(df: DataFrame) -> DataFrame:
    """Integers as bigint, so that column types do not depend on literals."""
    return df.select(*[F.col(f"`{c}`").cast("bigint").alias(c) if t in ("int", "smallint", "tinyint") else F.col(f"`{c}`") for c, t in df.dtypes])


def all_queries() -> dict[str, Query]:
    from importlib import import_module

    out: dict[str, Query] = {}
    for name in ("intervals", "features", "variants", "methylation", "cerna", "conservation", "align", "convert", "quality", "tables"):
        module = import_module(f"locusframe.plans.q_{name}")
        for key, query in module.QUERIES.items():
            if key in out:
                raise ValueError(f"query {key} is registered twice")
            out[key] = query
    return out
