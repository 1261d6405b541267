"""Inputs that follow a key are kept and summed once for each key; the model is that of the plain rows."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from offeranalytics.functions.scalars import column_stats, moments
from offeranalytics.operators import models as md, newton


def pairs(customers=60, offers=10):
    source = np.random.default_rng(4)
    a, b = source.normal(size=(customers, 6)), source.normal(size=(offers, 3))
    customer, offer = np.repeat(np.arange(customers), offers), np.tile(np.arange(offers), customers)
    return np.concatenate([a[customer], source.normal(size=(len(offer), 2)), b[offer]], 1), customer, offer, source.random(len(offer))


def test_products_by_key_are_those_by_row():
    x, customer, offer, weight = pairs()
    x[3, 0] = 9.0  # one row of a customer disagrees
    parts = newton.split_inputs(x, [customer, offer])
    assert [p.values.shape for p in parts] == [(60, 5), (10, 3), (600, 4)]
    full = np.concatenate([x, np.ones((len(x), 1))], 1)
    assert newton.curvature(parts, weight, 12) == pytest.approx((full * weight[:, None]).T @ full, abs=1e-9)


def test_blocks_hold_inputs_of_a_key_once_and_give_the_same_model(spark):
    x, customer, offer, luck = pairs()
    y = (x @ np.linspace(-1, 1, 11) + luck > 0.5).astype(int)
    rows = [(*map(float, v), f"c{c}" if c % 20 else None, f"o{o}", int(k)) for v, c, o, k in zip(x, customer, offer, y)]
    columns = [f"x{i}" for i in range(11)]
    df = spark.createDataFrame(rows, ", ".join(f"{c} double" for c in columns) + ", c string, o string, y int").coalesce(1)
    plain, keyed = (md.fit(md.logistic(), df, columns, "y", g).stages[-1] for g in ((), ("c", "o")))
    assert keyed.coefficients.toArray() == pytest.approx(plain.coefficients.toArray(), abs=1e-8) and keyed.intercept == pytest.approx(plain.intercept, abs=1e-8)
    hashed = df.filter("c is not null").select(F.array(*columns).alias("_x"), F.col("y").cast("double").alias("_y"), F.lit(0).alias("_f"), F.array(F.xxhash64("c"), F.xxhash64("o")).alias("_k"))
    size = newton.packed(hashed).agg(F.sum(F.length("x"))).first()[0]
    assert size == 8 * (57 * 6 + 10 * 3 + 570 * 3)


def test_moments_are_those_of_spark(spark):
    df = spark.range(1000).repartition(3).select(
        F.when(F.col("id") % 5 > 0, F.col("id") / 3).alias("some"), F.lit(0.1).alias("same"), F.lit(None).cast("double").alias("none"), (F.col("id") % 2).alias("a.b"))
    plain = df.withColumnRenamed("a.b", "ab")
    theirs = column_stats(plain, plain.columns, mean=F.avg, sd=F.stddev_pop)
    ours = moments(df, df.columns)
    assert ours["same"] == {"mean": 0.1, "sd": 0.0} and ours["none"] == {"mean": None, "sd": None}
    for c, t in (("some", "some"), ("a.b", "ab")):
        assert (ours[c]["mean"], ours[c]["sd"]) == pytest.approx((theirs[t]["mean"], theirs[t]["sd"]), rel=1e-12)
    assert moments(df.limit(0), ["some"]) == {"some": {"mean": None, "sd": None}}
