"""The paths taken on large or skewed data, forced on small tables and checked against brute force."""

import random

import pytest
from pyspark.sql import functions as F

from offeranalytics.functions import ordered, scale
from offeranalytics.operators import bootstrap, causal, funnel, models, segments


@pytest.fixture
def many_ranges(monkeypatch):
    monkeypatch.setattr(ordered, "ROWS_PER_RANGE", 5)


def skewed(n=300, seed=1):
    """A third of all values are equal."""
    r = random.Random(seed)
    return [(i, 7.0 if i % 3 == 0 else round(r.uniform(0, 20), 1)) for i in range(n)]


def test_average_ranks_over_ranges(spark, many_ranges):
    data = skewed()
    ranked = ordered.average_ranks(ordered.value_counts(spark.createDataFrame(data, "id int, v double"), "v"), "v")
    values = [v for _, v in data]
    for r in ranked.collect():
        assert r["rank"] == sum(x < r["v"] for x in values) + (values.count(r["v"]) + 1) / 2


def test_quantiles_over_ranges_and_groups(spark, many_ranges):
    data = [(i % 2, v) for i, v in skewed()]
    got = {r["g"]: r for r in ordered.exact_quantiles(spark.createDataFrame(data, "g int, v double"), ["v"], {"a": 0.1, "m": 0.5, "z": 1.0}, ["g"]).collect()}
    for g in (0, 1):
        values = sorted(v for x, v in data if x == g)
        for name, p in (("a", 0.1), ("m", 0.5), ("z", 1.0)):
            h = (len(values) - 1) * p
            low = int(h)
            high = min(low + 1, len(values) - 1)
            assert got[g][name] == pytest.approx(values[low] + (values[high] - values[low]) * (h - low))


def test_row_numbers_are_a_permutation_in_order(spark, many_ranges):
    data = skewed()
    places = {r["id"]: r["p"] for r in ordered.row_numbers(spark.createDataFrame(data, "id int, v double"), {"p": "v"}, "id").collect()}
    assert sorted(places.values()) == list(range(1, len(data) + 1))
    ordered_values = [v for _, v in sorted((places[i], v) for i, v in data)]
    assert ordered_values == sorted(ordered_values)


def test_tests_do_not_depend_on_ranges(spark, monkeypatch):
    from offeranalytics.operators import stats
    df = spark.createDataFrame([(i % 3, v) for i, v in skewed()], "g int, v double")
    one = (stats.mann_whitney(df, "v", F.col("g") == 1).first(), stats.kruskal_wallis(df, "v", "g").first())
    monkeypatch.setattr(ordered, "ROWS_PER_RANGE", 4)
    many = (stats.mann_whitney(df, "v", F.col("g") == 1).first(), stats.kruskal_wallis(df, "v", "g").first())
    assert [list(r) for r in one] == [pytest.approx(list(r)) for r in many]


def test_auc_over_ranges(spark, many_ranges):
    data = [(int(i % 4 == 0), v / 20) for i, v in skewed()]
    got = models.roc_auc(models.score_counts(spark.createDataFrame(data, "label int, score double"))).first()[0]
    pos, neg = [s for y, s in data if y], [s for y, s in data if not y]
    assert got == pytest.approx(sum((p > q) + (p == q) / 2 for p in pos for q in neg) / len(pos) / len(neg))


def test_catalogue_in_chunks_gives_every_pair(spark):
    left, right = spark.range(7).withColumnRenamed("id", "a"), spark.range(11).withColumnRenamed("id", "b")
    for chunk in (100, 3):
        pairs = scale.every_pair_with(left, right, "item", chunk).select("a", "item.b").collect()
        assert len(pairs) == len(set(map(tuple, pairs))) == 77


def test_hot_rows_are_copied_in_shares(spark):
    df = spark.createDataFrame([("hot", 25), ("cold", 2)], "k string, n int")
    got = {r["k"]: r["count"] for r in scale.copies(df, "n", ["k"], most=25, hot_rows=4).groupBy("k").count().collect()}
    assert got == {"hot": 25, "cold": 2}


def test_broadcast_only_below_the_limit(spark):
    plan = lambda df: df._jdf.queryExecution().logical().toString()
    assert "broadcast" in plan(scale.small_side(spark.range(5), 10)) and "broadcast" not in plan(scale.small_side(spark.range(50), 10))


def test_gaps_of_a_hot_key_match_brute_force(spark):
    r = random.Random(3)
    data = [("p", "offer received" if r.random() < 0.5 else "offer viewed", r.randrange(10), "o", None) for _ in range(400)]
    pairs = funnel.gap_pairs(spark.createDataFrame(data, "person string, event string, time int, offer_id string, amount double"), how="inner")
    assert pairs.count() <= 100
    gaps = sorted(v[2] - x[2] for x in data for v in data if x[1] == "offer received" and v[1] == "offer viewed")
    got = funnel.gap_statistics(pairs).first()
    mean = sum(gaps) / len(gaps)
    assert got["count"] == len(gaps) and got["mean"] == pytest.approx(mean) and (got["min"], got["max"]) == (gaps[0], gaps[-1])
    assert got["std"] == pytest.approx((sum((g - mean) ** 2 for g in gaps) / (len(gaps) - 1)) ** 0.5)


def units(n=120, seed=5, digits=2):
    r = random.Random(seed)
    return [(f"u{i}", int(r.random() < 0.4), 0.5 if i % 3 == 0 else round(r.random(), digits)) for i in range(n)]


def test_matching_with_replacement(spark, many_ranges):
    data = units()
    got = {r["treated_id"]: r for r in causal.match_with_replacement(spark.createDataFrame(data, "id string, treated int, score double"), 0.05).collect()}
    controls = [(s, i) for i, t, s in data if not t]
    for i, t, s in data:
        if t:
            d, cs, ci = min((abs(s - cs), cs, ci) for cs, ci in controls)
            assert (i in got) == (d < 0.05) and (i not in got or (got[i]["control_id"], got[i]["distance"]) == (ci, pytest.approx(d)))


def most_pairs(data, caliper):
    """The largest possible number of pairs: on a line, giving each unit the lowest partner still free is best."""
    t, c = (sorted(s for _, arm, s in data if arm == flag) for flag in (1, 0))
    i = j = n = 0
    while i < len(t) and j < len(c):
        if abs(t[i] - c[j]) < caliper:
            i, j, n = i + 1, j + 1, n + 1
        elif t[i] < c[j]:
            i += 1
        else:
            j += 1
    return n


def check_matching(data, pairs, caliper):
    """Each unit once, distances below the caliper, nobody left who has a free partner inside it."""
    import bisect

    score, arm = {i: s for i, _, s in data}, {i: t for i, t, _ in data}
    used = [p["treated_id"] for p in pairs] + [p["control_id"] for p in pairs]
    assert len(used) == len(set(used))
    for p in pairs:
        assert arm[p["treated_id"]] == 1 and arm[p["control_id"]] == 0
        assert p["distance"] == pytest.approx(abs(score[p["treated_id"]] - score[p["control_id"]])) and p["distance"] < caliper
    free = sorted(score[i] for i in set(score) - set(used) if arm[i] == 0)
    for i in set(score) - set(used):
        if arm[i] == 1:
            at = bisect.bisect_left(free, score[i])
            assert all(abs(score[i] - s) >= caliper for s in free[max(0, at - 1):at + 1])
    most = most_pairs(data, caliper)
    assert most / 2 <= len(pairs) <= most
    return len(pairs)


def match(spark, data, caliper):
    return causal.match_without_replacement(spark.createDataFrame(data, "id string, treated int, score double"), caliper).collect()


@pytest.mark.parametrize("seed, caliper", [(5, 0.1), (6, 0.013), (7, 0.03)])
def test_matching_without_replacement(spark, many_ranges, seed, caliper):
    data = units(200, seed, 3)
    check_matching(data, match(spark, data, caliper), caliper)


def test_no_partner_inside_the_caliper_is_lost(spark):
    assert len(match(spark, [("a", 0, 0.0), ("b", 0, 0.55), ("t", 1, 0.5)], 0.2)) == 1
    data = [(f"a{i}", 0, 0.0) for i in range(1000)] + [(f"t{i}", 1, 0.5) for i in range(100)] + [(f"b{i}", 0, 0.55) for i in range(100)]
    assert len(match(spark, data, 0.2)) == 100
    assert match(spark, [("a", 1, None), ("b", 0, None), ("c", 1, 0.1)], 0.2) == []


@pytest.mark.parametrize("arms", ["separated", "alternating", "tied"])
def test_matching_ten_thousand_units_takes_few_jobs(spark, arms):
    """Separated, alternating and tied arms all end in the same bounded number of jobs."""
    import time
    n = 10_000
    at = {"separated": lambda i: 0.3 * i / n + (0.31 if i % 2 else 0.0), "alternating": lambda i: i / n, "tied": lambda i: round(i % 7 / 10, 1)}[arms]
    data = [(f"u{i}", i % 2, at(i)) for i in range(n)]
    started = time.time()
    pairs = match(spark, data, 0.7)
    assert time.time() - started < 120
    check_matching(data, pairs, 0.7)


def test_silhouettes_match_brute_force(spark):
    r = random.Random(2)
    data = [(i, i % 3, [r.gauss(i % 3, 1), r.gauss(0, 1)]) for i in range(60)] + [(60, 9, [5.0, 5.0])]
    points = spark.createDataFrame(data, "k int, cluster int, features array<double>")

    def brute(dist):
        total = 0
        for i, c, x in data:
            mean = {o: [dist(x, y) for j, d, y in data if d == o and j != i] for o in {d for _, d, _ in data}}
            if not mean[c]:
                continue
            a, b = sum(mean[c]) / len(mean[c]), min(sum(v) / len(v) for o, v in mean.items() if o != c)
            total += (b - a) / max(a, b)
        return total / len(data)

    sq = lambda x, y: sum((p - q) ** 2 for p, q in zip(x, y))
    assert segments.silhouette_euclidean(points, "k", block_rows=10).first()["silhouette"] == pytest.approx(brute(lambda x, y: sq(x, y) ** 0.5))
    assert segments.labelling_quality(points).first()["silhouette_squared"] == pytest.approx(brute(sq))


def test_bootstrap_interval_covers_the_mean_and_has_the_right_width(spark):
    df = spark.range(20000).select(F.lit("a").alias("arm"), F.col("id"), (F.col("id") % 100).cast("double").alias("v"))
    row = bootstrap.mean_interval(df, "v", F.col("id").cast("string"), ["arm"], replicates=400).first()
    assert row["ci_lower"] < row["mean"] < row["ci_upper"]
    assert (row["ci_upper"] - row["ci_lower"]) / 2 == pytest.approx(1.96 * 28.87 / 20000 ** 0.5, rel=0.15)


def test_customers_of_the_pair_table_are_dealt_over_all_cores(spark):
    from offeranalytics.functions.scale import spread

    cores = spark.sparkContext.defaultParallelism
    one = spark.range(100).coalesce(1)
    assert spread(one, 2500, "id").rdd.getNumPartitions() == cores
    assert spread(one, 2500, "id", per_task=100).rdd.getNumPartitions() == 25 and spread(one, 2500, "id").count() == 100


def test_silhouette_sends_each_point_equally_often(spark, monkeypatch):
    """The number of blocks does not follow the rows, and blocks worked through in slices give the same value."""
    from offeranalytics.operators import segments as sg

    df = spark.range(300).select("id", (F.col("id") % 3).alias("cluster"), F.array((F.col("id") % 3 + F.rand(1)).alias("x"), F.rand(2)).alias("features")).cache()
    whole = sg.silhouette_euclidean(df, "id").first()
    monkeypatch.setattr(sg, "SILHOUETTE_BLOCKS", 2)
    sliced = sg.silhouette_euclidean(df, "id", block_rows=7)
    assert sliced.first()["silhouette"] == pytest.approx(whole["silhouette"], abs=1e-9) and sliced.first()["n"] == 300
    assert "sequence(0, 1" in sliced._jdf.queryExecution().analyzed().toString()
