"""Registered queries: a Spark function over the test tables and, where SQL can say it, the same in SQL."""

import re
from collections.abc import Callable
from functools import cached_property
from typing import NamedTuple

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..functions.scalars import typed_events
from ..sources import adapter
from .sql_views import VIEWS


class Inputs:
    """Lazily built inputs of one query."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.sf_dir = spark, sf_dir

    def table(self, name: str) -> DataFrame:
        return adapter.table(self.spark, self.sf_dir, name)

    @cached_property
    def datasets(self):
        return adapter.load(self.spark, self.sf_dir)

    @property
    def portfolio(self) -> DataFrame:
        return self.datasets.portfolio

    @property
    def profile(self) -> DataFrame:
        return self.datasets.profile

    @property
    def transcript(self) -> DataFrame:
        return self.datasets.transcript

    @cached_property
    def events(self) -> DataFrame:
        return typed_events(self.transcript)

    @cached_property
    def clusters(self) -> DataFrame:
        """A given segmentation: unknown age is 0, the others take 1..3 in turn."""
        return self.profile.select("id", F.when(F.col("age") == 118, 0).otherwise(
            F.col("id").cast("int") % 3 + 1).cast("int").alias("cluster"))

    @cached_property
    def rules(self) -> DataFrame:
        return self.spark.createDataFrame(
            [(0, "informational", None), (1, "discount", "bogo"), (2, "bogo", "discount"), (3, "informational", None)],
            "cluster int, primary_offer string, secondary_offer string")

    @cached_property
    def features(self) -> DataFrame:
        from ..operators.features import customer_features
        return customer_features(self.profile, self.events, self.portfolio)

    @cached_property
    def scored(self) -> DataFrame:
        """Labels with scores in 0..1 taken from order lines."""
        return self.table("lineitem").select(
            (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("row_id"),
            (F.col("l_returnflag") == "R").cast("int").alias("label"),
            F.round((F.col("l_quantity") / 50 + F.col("l_discount") * 10) / 2, 4).alias("score"))


class Query(NamedTuple):
    run: Callable[[SparkSession, str], DataFrame]
    sql: str | None


QUERIES: dict[str, Query] = {}


def _rounding(doubles: str, coarse: str) -> dict[str, int]:
    return {**{c: 6 for c in doubles.split()}, **{c: 3 for c in coarse.split()}}


def with_views(body: str) -> str:
    """Prefix the views a statement mentions, and those they mention in turn."""
    needed, text = [], body
    for name in reversed(VIEWS):
        if re.search(rf"\b{name}\b", text):
            needed.insert(0, name)
            text += VIEWS[name]
    return ("WITH " + ",\n".join(f"{n} AS ({VIEWS[n].strip()})" for n in needed) + "\n" if needed else "") + body.strip()


def query(name: str, sql: str | None = None, doubles: str = "", coarse: str = ""):
    """Register a query. Floating columns are rounded in both engines, large deviations to three places."""
    places = _rounding(doubles, coarse)

    def register(build: Callable[[Inputs], DataFrame]):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            df = build(Inputs(spark, sf_dir))
            return df.withColumns({c: F.round(F.col(c), d) + 0.0 for c, d in places.items()}) if places else df

        text = None
        if sql is not None:
            replace = ", ".join(f"round({c}, {d}) + 0.0 AS {c}" for c, d in places.items())
            text = with_views(f"SELECT * REPLACE ({replace}) FROM ({sql.strip()})" if places else sql)
        assert name not in QUERIES, name
        QUERIES[name] = Query(run, text)
        return build

    return register
