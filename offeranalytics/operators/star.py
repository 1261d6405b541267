"""Star schema, legacy BI tables and measures."""

from datetime import date

from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from ..functions import ordered
from ..functions.constants import (
    AS_OF, CHANNELS, CLUSTER_LABELS, ENGAGEMENT_BINS, ENGAGEMENT_BINS_OPEN_ZERO, OFFER_TYPES)
from ..functions.scalars import (
    cut, event_time, has_channel, is_offer_event, is_transaction, money_sum, offer_category, ratio_or_null, rfm_segment, select_existing, title_case)
from ..functions.scale import small_side

# Calendar limits
CALENDAR = (date(2018, 6, 1), date(2018, 7, 31))
CAMPAIGN_START = date(2018, 6, 27)
HOLIDAYS = (date(2018, 7, 1), date(2018, 7, 7))


def label_table(spark: SparkSession, labels: dict[int, str] = CLUSTER_LABELS) -> DataFrame:
    return spark.createDataFrame(list(labels.items()), "cluster int, cluster_label string")


def with_labels(df: DataFrame, labels: dict[int, str] = CLUSTER_LABELS) -> DataFrame:
    return df.join(F.broadcast(label_table(df.sparkSession, labels)), "cluster", "left")


def fact_offer_interactions(events: DataFrame, as_of=AS_OF, forward: bool = False) -> DataFrame:
    """Distinct offer events with date key and day index. Dates count back from ``as_of``, the day index forward."""
    when = event_time("time_hours", as_of, forward)
    facts = events.filter(is_offer_event()).select(
        F.col("person").alias("customer_id"), "offer_id", F.regexp_replace("event", "offer ", "").alias("event_type"),
        F.col("time").alias("time_hours")).distinct()
    return facts.withColumns({"event_date": when, "event_date_key": F.date_format(when, "yyyy-MM-dd"),
                              "day_since_start": F.floor(F.col("time_hours") / 24).cast("int")})


def dim_customers(features: DataFrame, clusters: DataFrame) -> DataFrame:
    joined = with_labels(features.join(clusters, "id", "left"))
    tiers = joined.withColumns({"engagement_level": cut("completion_rate", *ENGAGEMENT_BINS), "rfm_segment": rfm_segment()})
    names = ["age_imputed", "income_imputed", "gender", "tenure_months", "cluster", "cluster_label", "engagement_level", "rfm_segment", "clv_proxy",
             "completion_rate", "view_rate", "trans_total", "trans_avg", "trans_count"]
    return select_existing(tiers, {"id": "customer_id", **{n: n for n in names}})


def dim_offers(portfolio: DataFrame) -> DataFrame:
    return portfolio.select(
        F.col("id").alias("offer_id"), "offer_type", "difficulty", "reward", F.col("duration").alias("duration_days"),
        *[has_channel(c).cast("boolean").alias(f"channel_{c}") for c in CHANNELS],
        ratio_or_null("reward", "duration").alias("reward_per_day"), ratio_or_null("difficulty", "duration").alias("difficulty_per_day"),
        F.size("channels").alias("channel_count"), offer_category().alias("offer_type_category"))


def dim_date(spark: SparkSession, start=CALENDAR[0], end=CALENDAR[1], campaign_start: date = CAMPAIGN_START, holidays=HOLIDAYS) -> DataFrame:
    """One row per day from ``start`` to ``end`` (dates or one-value subqueries); Monday is 0, weeks are ISO weeks."""
    days = spark.range(1).select(F.explode(F.sequence(F.lit(start), F.lit(end), F.expr("interval 1 day"))).alias("date"))
    d = F.col("date")
    return days.select(
        "date", F.date_format(d, "yyyy-MM-dd").alias("date_key"), F.year(d).alias("year"), F.quarter(d).alias("quarter"),
        F.concat(F.lit("FQ"), F.quarter(d)).alias("fiscal_quarter"), F.month(d).alias("month"), F.date_format(d, "MMMM").alias("month_name"),
        F.dayofmonth(d).alias("day"), F.weekday(d).alias("day_of_week"), F.date_format(d, "EEEE").alias("day_name"), F.weekofyear(d).alias("week_of_year"),
        (F.weekday(d) >= 5).alias("is_weekend"), (F.weekday(d) < 5).alias("is_weekday"), d.between(*holidays).alias("is_holiday_period"),
        F.date_diff(d, F.lit(campaign_start)).alias("day_since_start"))


def dim_date_of(facts: DataFrame) -> DataFrame:
    """The calendar from the first to the last event date of a fact table."""
    edge = lambda f: facts.agg(f(F.to_date("event_date"))).toDF("d").scalar()
    return dim_date(facts.sparkSession, edge(F.min), edge(F.max))


def kpi_rows(features: DataFrame, effects: DataFrame, lift: DataFrame, auc: DataFrame | None = None) -> DataFrame:
    """KPIs as rows of name, value, category and format. ``effects`` are naive effects, ``lift`` a rule lift."""
    spark = features.sparkSession
    totals = features.agg(F.count(F.lit(1)).cast("double").alias("Total Customers"), money_sum("trans_total").alias("Total Revenue"),
                          F.avg("completion_rate").alias("Average Completion Rate"), F.avg("view_rate").alias("Average View Rate"),
                          F.avg("trans_avg").alias("Average Transaction Amount"))
    # Category and format of each KPI
    kinds = {"Total Customers": ("Customer", "Whole Number"), "Total Revenue": ("Financial", "Currency"),
             "Average Completion Rate": ("Engagement", "Percentage"), "Average View Rate": ("Engagement", "Percentage"),
             "Average Transaction Amount": ("Financial", "Currency"), "Model AUC-ROC": ("Model", "Decimal"), "Recommendation Lift %": ("Business", "Percentage")}
    values = ordered.unpivot(totals, totals.columns, metric="metric_name", value="metric_value").unionByName(
        lift.select(F.lit("Recommendation Lift %").alias("metric_name"), F.col("lift_percent").alias("metric_value")))
    if auc is not None:
        values = values.unionByName(auc.select(F.lit("Model AUC-ROC").alias("metric_name"), F.col(auc.columns[0]).alias("metric_value")))
    named = values.join(F.broadcast(spark.createDataFrame([(k, *v) for k, v in kinds.items()], "metric_name string, metric_category string, format string")), "metric_name")
    by_type = effects.filter(F.col("treatment").isin(OFFER_TYPES))
    label = F.concat(F.lit("ATE "), F.initcap("treatment"))
    causal = [by_type.select(n.alias("metric_name"), F.col(v).alias("metric_value"), F.lit("Causal Impact").alias("metric_category"), F.lit(f).alias("format"))
              for n, v, f in ((label, "ate", "Currency"), (F.concat(label, F.lit(" %")), "ate_percent", "Percentage"))]
    return ordered.union_all([named.select("metric_name", "metric_value", "metric_category", "format"), *causal])


def fact_segment_performance(features: DataFrame, clusters: DataFrame, rules: DataFrame, by_type: DataFrame) -> DataFrame:
    """Segment averages and revenue with the best offer type by rule and its person-level completion rate.

    The published rate is the informational, discount and bogo rate for segments 0, 1 and 2 and the largest rate otherwise.
    """
    seg = segment_averages(features, clusters).join(small_side(rules.select("cluster", "primary_offer")), "cluster", "left")
    rate = lambda t: F.coalesce(by_type.filter(F.col("offer_type") == t).select("completion_rate").scalar(), F.lit(0.0))
    best = F.coalesce(by_type.agg(F.max("completion_rate")).toDF("r").scalar(), F.lit(0.0))
    given = F.when(F.col("cluster") == 0, rate("informational")).when(F.col("cluster") == 1, rate("discount")).when(F.col("cluster") == 2, rate("bogo")).otherwise(best)
    return with_labels(seg).select(
        F.col("cluster").alias("cluster_id"), "cluster_label", "segment_size", "avg_completion_rate", "avg_view_rate", "avg_transaction_amount", "avg_income",
        "avg_age", "total_revenue", "revenue_per_customer", F.coalesce("primary_offer", F.lit("unknown")).alias("best_offer_type"),
        given.alias("best_offer_completion_rate"))


def segment_averages(features: DataFrame, clusters: DataFrame) -> DataFrame:
    return features.join(clusters, "id").groupBy("cluster").agg(
        F.count("id").alias("segment_size"), F.avg("completion_rate").alias("avg_completion_rate"), F.avg("view_rate").alias("avg_view_rate"),
        F.avg("trans_avg").alias("avg_transaction_amount"), F.avg("income_imputed").alias("avg_income"), F.avg("age_imputed").alias("avg_age"),
        money_sum("trans_total").alias("total_revenue")).withColumn("revenue_per_customer", F.col("total_revenue") / F.col("segment_size"))


def customers_table(features: DataFrame, clusters: DataFrame) -> DataFrame:
    """Legacy customer table; here a completion rate of 0 has no engagement level."""
    joined = with_labels(features.join(clusters, "id", "left")).withColumns({
        "customer_segment": F.col("cluster_label"), "engagement_level": cut("completion_rate", *ENGAGEMENT_BINS_OPEN_ZERO)})
    # Exported column names
    names = {"id": "customer_id", "age_imputed": "age", "income_imputed": "income", "tenure_months": "tenure_months", "gender_M": "is_male",
             "gender_F": "is_female", "gender_O": "is_other_gender", "gender_Unknown": "is_unknown_gender", "trans_count": "transaction_count",
             "trans_total": "total_spend", "trans_avg": "avg_transaction", "offers_received": "offers_received", "offers_viewed": "offers_viewed",
             "offers_completed": "offers_completed", "view_rate": "view_rate", "completion_rate": "completion_rate", "cluster": "cluster_id",
             "cluster_label": "cluster_label", "customer_segment": "customer_segment", "engagement_level": "engagement_level"}
    return select_existing(joined, names)


def offers_table(portfolio: DataFrame) -> DataFrame:
    """Legacy offer table, one row per offer and channel."""
    return portfolio.select(
        F.col("id").alias("offer_id"), "offer_type", "difficulty", "reward", F.col("duration").alias("duration_days"), F.explode_outer("channels").alias("channel"),
        F.upper("offer_type").alias("offer_type_upper"), (F.col("reward") / F.col("duration")).alias("reward_per_day"),
        (F.col("difficulty") / F.col("duration")).alias("difficulty_per_day"))


def transactions_table(events: DataFrame, as_of=AS_OF, forward: bool = False) -> DataFrame:
    when = event_time(as_of=as_of, forward=forward)
    return events.filter(is_transaction() & F.col("amount").isNotNull()).select(
        F.col("person").alias("customer_id"), F.col("amount").alias("transaction_amount"), F.col("time").alias("time_hours"),
        when.alias("transaction_date"), F.date_format(when, "EEEE").alias("day_of_week"), F.hour(when).alias("hour_of_day"))


def offer_events_table(events: DataFrame, as_of=AS_OF, forward: bool = False) -> DataFrame:
    when = event_time(as_of=as_of, forward=forward)
    return events.filter(is_offer_event()).select(
        F.col("person").alias("customer_id"), "offer_id", F.col("event").alias("event_type"), F.col("time").alias("time_hours"),
        when.alias("event_date"), F.date_format(when, "EEEE").alias("day_of_week"))


def long_cluster_profiles(profiles: DataFrame, metrics=("completion_rate", "view_rate", "trans_avg", "income_imputed", "age_imputed")) -> DataFrame:
    cells = [F.struct(F.lit(m).alias("m"), F.col(f"{m}_mean").alias("value")) for m in metrics if f"{m}_mean" in profiles.columns]
    return with_labels(profiles).select(F.col("cluster").alias("cluster_id"), "cluster_label", F.explode(F.array(*cells)).alias("c")).select(
        "cluster_id", "cluster_label", title_case("c.m").alias("metric"), "c.value")


def long_model_performance(comparison: DataFrame) -> DataFrame:
    # Metric names of the BI table
    names = {"auc_roc": "AUC-ROC", "precision": "Precision", "recall": "Recall", "f1": "F1-Score"}
    cells = [F.struct(F.lit(label).alias("metric"), F.col(c).alias("value")) for c, label in names.items() if c in comparison.columns]
    return comparison.select(F.col("model").alias("model_name"), F.explode(F.array(*cells)).alias("c")).select("model_name", "c.*")


def ate_results_table(effects: DataFrame) -> DataFrame:
    return effects.select(title_case("treatment").alias("offer_type"), "control_mean", "treatment_mean", F.col("ate").alias("ate_dollars"), "ate_percent")


def recommendation_results_table(lift: DataFrame) -> DataFrame:
    cells = F.array(F.struct(F.lit("Random Targeting").alias("method"), F.col("random_completion_rate").alias("completion_rate"), F.lit(0.0).alias("lift_percent")),
                    F.struct(F.lit("Rule-Based Targeting").alias("method"), F.col("rule_based_completion_rate").alias("completion_rate"), F.col("lift_percent")))
    return lift.select(F.explode(cells).alias("c")).select("c.*")


def customer_measures(customers: DataFrame) -> DataFrame:
    return customers.agg(
        F.count("customer_id").alias("total_customers"), F.avg("completion_rate").alias("avg_completion_rate"), F.avg("view_rate").alias("avg_view_rate"),
        F.avg("trans_avg").alias("avg_transaction"), F.count_if(F.col("engagement_level") == "High").alias("high_engagement_customers"))


def funnel_measures(facts: DataFrame, offers: DataFrame) -> DataFrame:
    """Offer funnel counts, rates and receipts by type."""
    counted = facts.groupBy("offer_id", "event_type").agg(F.count(F.lit(1)).alias("n")).join(small_side(offers.select("offer_id", "offer_type")), "offer_id", "left")
    total = lambda test: F.coalesce(F.sum(F.when(test, F.col("n"))), F.lit(0))
    stage = lambda s: F.col("event_type") == s
    names = {"bogo": "bogo", "discount": "discount", "informational": "info"}
    sums = counted.agg(total(F.lit(True)).alias("transaction_count"), *[total(stage(s)).alias(f"offers_{s}") for s in ("received", "viewed", "completed")],
                       *[total(stage("received") & (F.col("offer_type") == t)).alias(f"{n}_offers_received") for t, n in names.items()])
    return sums.withColumns({"view_rate_pct": ratio_or_null("offers_viewed", "offers_received"), "completion_rate_pct": ratio_or_null("offers_completed", "offers_received")})


def kpi_value(kpis: DataFrame, name: str) -> DataFrame:
    return kpis.filter(F.col("metric_name") == name).agg(F.sum("metric_value").alias("kpi_value"))


def selected_kpi(customers: DataFrame, facts: DataFrame, metric: str) -> DataFrame:
    """The measure a report parameter asks for; anything unknown falls back to the completion rate."""
    if metric == "Transaction Count":
        return facts.agg(F.count(F.lit(1)).cast("double").alias("selected_kpi"))
    column = {"View Rate": "view_rate", "Avg Spend": "trans_avg"}.get(metric, "completion_rate")
    return customers.agg(F.avg(column).alias("selected_kpi"))


def holiday_interactions(facts: DataFrame, dates: DataFrame) -> DataFrame:
    """Interactions on dates flagged as holiday period."""
    days = facts.groupBy(F.col("event_date_key").alias("date_key")).agg(F.count(F.lit(1)).alias("n"))
    return days.join(dates.filter("is_holiday_period").select("date_key"), "date_key", "left_semi").agg(F.coalesce(F.sum("n"), F.lit(0)).alias("holiday_interactions"))


def revenue_rank(segments: DataFrame) -> DataFrame:
    """Rank of segments by revenue and whether a segment is the best (one row per segment)."""
    order = Window.orderBy(F.desc("total_revenue"))
    return segments.select("cluster_id", "total_revenue", F.rank().over(order).alias("revenue_rank")).withColumn("is_best", F.col("revenue_rank") == 1)


def daily_spend(transactions: DataFrame) -> DataFrame:
    return transactions.groupBy(F.to_date("transaction_date").alias("date")).agg(money_sum("transaction_amount").alias("spend"))


def running_spend(transactions: DataFrame) -> DataFrame:
    """Year-to-date spend per day: days are summed first, so the window sees one row per day."""
    order = Window.partitionBy(F.year("date")).orderBy("date").rowsBetween(Window.unboundedPreceding, 0)
    return daily_spend(transactions).withColumn("running_spend", F.sum(F.col("spend").cast("decimal(38,2)")).over(order).cast("double"))


def trailing_interactions(facts: DataFrame, days: int = 7) -> DataFrame:
    """Interactions from ``days`` days before to the day itself, per day of the campaign."""
    daily = facts.groupBy("day_since_start").agg(F.count(F.lit(1)).alias("n_interactions"))
    order = Window.orderBy("day_since_start").rangeBetween(-days, 0)
    return daily.withColumn("trailing_interactions", F.sum("n_interactions").over(order))


def best_model(performance: DataFrame) -> DataFrame:
    """Largest AUC and the model that has it, ties by name."""
    auc = performance.filter("metric = 'AUC-ROC'")
    best = auc.agg(F.max("value").alias("best_auc_roc"))
    return auc.filter(F.col("value") == best.scalar()).agg(F.max("value").alias("best_auc_roc"), F.min("model_name").alias("best_model"))


def export_tables(portfolio: DataFrame, events: DataFrame, features: DataFrame, clusters: DataFrame, rules: DataFrame, profiles: DataFrame,
                  effects: DataFrame, lift: DataFrame, by_type: DataFrame, comparison: DataFrame | None = None) -> dict[str, DataFrame]:
    """Every BI table by name, ready for ``write_tables``."""
    tables = {
        "fact_offer_interactions": fact_offer_interactions(events), "dim_customers": dim_customers(features, clusters),
        "dim_offers": dim_offers(portfolio), "dim_date": dim_date(portfolio.sparkSession),
        "fact_segment_performance": fact_segment_performance(features, clusters, rules, by_type),
        "customers": customers_table(features, clusters), "offers": offers_table(portfolio), "transactions": transactions_table(events),
        "offer_events": offer_events_table(events), "cluster_profiles": long_cluster_profiles(profiles),
        "ate_results": ate_results_table(effects), "recommendation_results": recommendation_results_table(lift)}
    auc = None
    if comparison is not None:
        tables["model_performance"] = long_model_performance(comparison)
        auc = comparison.agg(F.max("auc_roc"))
    tables["fact_kpi_metrics"] = kpi_rows(features, effects, lift, auc)
    return tables

