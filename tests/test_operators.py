"""Small hand-computed cases."""

import math

import pytest
from pyspark.sql import functions as F

from offeranalytics.functions import constants as k, scalars as s, special
from offeranalytics.operators import features as ft, funnel as f, quality as q, segments as sg, star, stats as st
from offeranalytics.operators import targeting as tg
from offeranalytics.sources.readers import PORTFOLIO_SCHEMA, PROFILE_SCHEMA

PEOPLE = [("a", 25, 20180101, "M", 50000.0), ("b", 118, 20170101, None, None), ("c", 101, 20180726, "F", 60000.0)]
EVENTS = [("a", "offer received", 0, "o1", None), ("a", "offer viewed", 6, "o1", None), ("a", "offer completed", 12, "o1", None),
          ("a", "offer completed", 18, "o1", None), ("a", "transaction", 12, None, 10.0), ("a", "transaction", 300, None, 30.0),
          ("b", "offer viewed", 3, "o2", None), ("b", "offer received", 9, "o2", None), ("b", "surprise", 1, None, None)]


@pytest.fixture(scope="module")
def people(spark):
    return spark.createDataFrame(PEOPLE, PROFILE_SCHEMA)


@pytest.fixture(scope="module")
def offers(spark):
    return spark.createDataFrame([("o1", "bogo", 5, 5, 7.0, ["email", "mobile"]), ("o2", "discount", 10, 2, 10.0, ["email", "web"]),
                                  ("o3", "informational", 0, 0, 4.0, ["web"])], PORTFOLIO_SCHEMA)


@pytest.fixture(scope="module")
def events(spark):
    return spark.createDataFrame(EVENTS, "person string, event string, time int, offer_id string, amount double")


def by_id(df, key="id"):
    return {r[key]: r for r in df.collect()}


def test_negative_difficulty_is_reported(spark):
    bad = spark.createDataFrame([("1", "bogo", -5, 5, 7.0, ["email"])], PORTFOLIO_SCHEMA)
    issues = q.schema_issues(bad, "portfolio", k.PORTFOLIO_COLUMNS, {"offer_type": k.OFFER_TYPES}, ["difficulty", "reward"])
    assert [(r["issue"], r["column_name"]) for r in issues.collect()] == [("negative values", "difficulty")]


def test_missing_column_and_sentinel_are_reported(people):
    issues = q.schema_issues(people.drop("income"), "profile", k.PROFILE_COLUMNS, sentinel=("age", 118)).collect()
    assert {(r["issue"], r["column_name"], r["n_rows"]) for r in issues} == {("missing column", "income", None), ("sentinel value", "age", 1)}
    assert by_id(q.flag_sentinel(people))["b"]["age_missing"] == 1
    assert {r["column_name"]: r["n_distinct"] for r in q.distinct_counts(people, ["age", "gender"], approximate=True).collect()} == {"age": 3, "gender": 2}
    assert q.missing_columns(people, ["id", "x"]) == ["x"]


def test_demographics_outside_every_bin_are_null(people):
    rows = by_id(ft.demographic_features(people))
    assert rows["b"]["age_missing"] == 1 and rows["b"]["age_imputed"] == 63.0 and rows["b"]["income_imputed"] == 55000.0
    assert rows["c"]["age_bin"] is None and rows["c"]["tenure_bin"] is None and rows["c"]["tenure_days"] == 0
    assert (rows["a"]["gender_M"], rows["b"]["gender_Unknown"], rows["a"]["age_bin"]) == (1, 1, "18-25")


def test_offer_features(offers):
    row = by_id(ft.offer_features(offers))["o1"]
    assert (row["offer_type_bogo"], row["channel_mobile"], row["channel_social"], row["difficulty_x_reward"]) == (1, 1, 0, 25)


def test_standardise(spark):
    df = spark.createDataFrame([(float(i), 10.0 * i, 7.0) for i in range(1, 6)], "a double, b double, c double")
    row = s.standardise(df, ["a", "b", "c", "nope"]).agg(F.avg("a"), F.stddev_pop("a"), F.stddev_pop("b"), F.max("c")).first()
    assert row[0] == pytest.approx(0) and row[1] == pytest.approx(1) and row[2] == pytest.approx(1) and row[3] == 0


def test_two_kinds_of_response_time(people, events):
    stats = f.gap_statistics(f.gap_pairs(events, "offer viewed", "inner")).first()
    assert (stats["count"], stats["min"], stats["max"]) == (2, -6, 6)
    rows = by_id(ft.timing_features(people, events))
    assert rows["a"]["avg_time_to_view"] == 6 and rows["b"]["avg_time_to_view"] == 0 and rows["a"]["avg_time_to_complete"] == 12


def test_a_pair_repeats_once_per_completion(people, offers, events):
    pairs = ft.customer_offer_pairs(people.select("id"), offers.select("id"))
    assert pairs.count() == 9
    labelled = ft.labelled_pairs(pairs, events)
    assert labelled.count() == 10 and labelled.filter("completed = 1").count() == 2
    assert ft.labelled_pairs(pairs, events, dedupe=True).filter("completed = 1").count() == 1


def test_features_can_stop_at_a_cut_off(people, offers, events):
    full = by_id(ft.customer_features(people, events, offers))
    early = by_id(ft.customer_features(people, events, offers, as_of_hours=12))
    assert (full["a"]["offers_completed"], early["a"]["offers_completed"]) == (2, 1)
    assert (full["a"]["trans_total"], early["a"]["trans_total"]) == (40.0, 10.0)
    assert full["a"]["clv_proxy"] == pytest.approx(40 * 3) and len(full["a"]) == 55


def test_total_channels_stays_null_on_unviewed_pairs(people, offers, events):
    table = ft.interaction_features(people.select("id", "age"), events, offers)
    rows = {(r["customer_id"], r["offer_id"]): r for r in table.collect()}
    assert rows["a", "o1"]["viewed_via_mobile"] == 1 and rows["a", "o1"]["total_channels_used"] == 2
    assert rows["a", "o2"]["viewed_via_email"] == 0 and rows["a", "o2"]["total_channels_used"] is None
    pairs = ft.customer_offer_pairs(people.select("id", "age"), ft.offer_features(offers))
    joined = ft.with_view_flags(ft.labelled_pairs(pairs, events), ft.viewed_channels(events, offers))
    assert sorted(joined.columns) == sorted(table.columns)
    assert sorted(map(str, joined.select(sorted(table.columns)).collect())) == sorted(map(str, table.select(sorted(table.columns)).collect()))
    assert "age" in ft.numeric_features(table) and "completed" not in ft.numeric_features(table)


def test_folds_and_split_are_exact_and_disjoint(spark):
    df = spark.range(1000).select(F.col("id"), (F.col("id") % 4 == 0).cast("int").alias("y"))
    split = {(r["y"], r["is_test"]): r["count"] for r in ft.stratified_split(df, "y", "id").groupBy("y", "is_test").count().collect()}
    assert split == {(0, 0): 600, (0, 1): 150, (1, 0): 200, (1, 1): 50}
    folds = ft.stratified_folds(df, "y", "id").groupBy("y", "fold").count().collect()
    assert {r["count"] for r in folds if r["y"] == 1} == {50} and len(folds) == 10
    assert abs(ft.hash_split(df, "id").filter("is_test = 1").count() - 200) < 60


@pytest.mark.parametrize("x, dof, p", [(351.42, 2, 4.888e-77), (38.666, 2, 4.030e-9), (3.841459, 1, 0.05), (7.814728, 3, 0.05), (9.487729, 4, 0.05)])
def test_chi_squared_tail(spark, x, dof, p):
    got = spark.range(1).select(special.p_chi_squared(F.lit(x), F.lit(dof))).first()[0]
    assert got == pytest.approx(p, rel=2e-2)


@pytest.mark.parametrize("t, dof, p", [(2.228139, 10, 0.05), (12.7062, 1, 0.05), (1.959964, 1e7, 0.05), (2.0, 30, 0.0546), (0.0, 5, 1.0)])
def test_student_tail(spark, t, dof, p):
    assert spark.range(1).select(special.p_student(F.lit(t), F.lit(float(dof)))).first()[0] == pytest.approx(p, abs=1e-4)


def test_normal_tail(spark):
    assert spark.range(1).select(special.p_normal(F.lit(-1.959964))).first()[0] == pytest.approx(0.05, abs=1e-6)


def test_zero_standard_error_gives_zero_statistic(spark):
    row = st.with_normal_p(spark.range(1).select(st.two_proportion_z(F.lit(5), F.lit(5), F.lit(7), F.lit(7)).alias("z_statistic"))).first()
    assert (row["z_statistic"], row["p_value"], row["significant"]) == (0.0, 1.0, False)


def test_correlation_of_a_column_with_itself(spark):
    df = spark.createDataFrame([(1.0, 2.0), (2.0, 1.0), (3.0, 5.0), (4.0, 4.0)], "a double, b double")
    got = {(r["column_a"], r["column_b"]): (r["r"], r["p_value"]) for r in st.spearman(df, ["a", "b"]).collect()}
    assert got["a", "a"][0] == pytest.approx(1) and got["a", "a"][1] == 0
    assert got["a", "b"][0] == pytest.approx(0.6) and got["a", "b"][1] == pytest.approx(0.4)


def test_naming_uses_each_type_once(spark):
    shape = "cluster int, size long, " + ", ".join(f"{c}_mean double" for c in (
        "trans_total", "completion_rate", "view_rate", "bogo_completion_rate", "discount_completion_rate", "tenure_months", "income_imputed"))
    df = spark.createDataFrame([(0, 1, 90.0, 0.9, 0.9, 0.5, 0.4, 1.0, 1.0), (1, 1, 1.0, 0.1, 0.9, 0.1, 0.1, 1.0, 1.0), (2, 1, 2.0, 0.2, 0.9, 0.1, 0.1, 1.0, 1.0),
                                (3, 1, 1.5, 0.4, 0.9, 0.4, 0.8, 1.0, 1.0)], shape)
    kinds = {r["cluster"]: r["segment_type"] for r in sg.name_segments(df).collect()}
    assert kinds == {0: "high_value_loyalist", 1: "low_engagement", 2: "moderate_spender", 3: "discount_seeker"}


def test_business_metrics_with_reward_cost(spark):
    df = spark.createDataFrame([(0, 10.0, 0.5, 0.2, 0.2, 4.0), (0, 30.0, 0.5, 0.2, 0.2, 6.0)], "cluster int, trans_total double, view_rate double, completion_rate double, trans_count double, cost double")
    row = sg.business_metrics(df, "cost").first()
    assert row["offer_roi"] == pytest.approx(4) and row["churn_risk_proxy"] == pytest.approx(0.7) and sg.business_metrics(df).first()["offer_roi"] == 999


def test_equal_labels_agree_fully(spark):
    df = spark.range(60).select((F.col("id") % 3).alias("a"), ((F.col("id") + 1) % 3).alias("b"), (F.col("id") % 2).alias("c"))
    got = {(r["column_a"], r["column_b"]): r["ari"] for r in sg.adjusted_rand(df, ["a", "b", "c"]).collect()}
    assert got["a", "b"] == pytest.approx(1) and abs(got["a", "c"]) < 0.1


def test_calendar(spark):
    days = star.dim_date(spark)
    row = days.filter("date_key = '2018-07-01'").first()
    assert days.count() == 61 and len(days.columns) == 15
    assert (row["day_of_week"], row["day_name"], row["week_of_year"], row["is_holiday_period"], row["day_since_start"], row["fiscal_quarter"]) == (6, "Sunday", 26, True, 4, "FQ3")


def test_event_dates_run_backwards_unless_asked(events):
    back = star.fact_offer_interactions(events).filter("time_hours = 6").first()
    ahead = star.fact_offer_interactions(events, forward=True).filter("time_hours = 6").first()
    assert (back["event_date_key"], ahead["event_date_key"], back["day_since_start"]) == ("2018-07-25", "2018-07-26", 0)


def test_engagement_of_a_zero_rate_differs_between_tables(spark):
    df = spark.createDataFrame([(0.0,), (1.04,)], "completion_rate double")
    got = df.select(s.cut("completion_rate", *k.ENGAGEMENT_BINS), s.cut("completion_rate", *k.ENGAGEMENT_BINS_OPEN_ZERO)).collect()
    assert [tuple(r) for r in got] == [("Low", None), (None, None)]


def test_rules_as_a_table(spark):
    assert [tuple(r) for r in tg.rule_table(spark, {0: ("bogo", None)}).collect()] == [(0, "bogo", None)]


def test_quintiles_of_few_rows(spark):
    from offeranalytics.functions.ordered import quantile_bucket
    got = [r[0] for r in spark.range(1, 12).select(quantile_bucket(F.col("id"), F.lit(11))).collect()]
    assert got == [1, 1, 1, 2, 2, 3, 3, 4, 4, 5, 5]
    assert math.isclose(sum(got), 31)
