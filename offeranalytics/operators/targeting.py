"""Targeting rules, their expected lift, recommendations per customer and business KPIs."""

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..functions.scalars import money_sum, ratio_or_null, safe_ratio
from ..functions.scale import small_side


def rule_table(spark: SparkSession, rules: dict[int, tuple[str, str | None]]) -> DataFrame:
    """Rules as a table: cluster, primary and secondary offer type."""
    return spark.createDataFrame([(k, *v) for k, v in rules.items()], "cluster int, primary_offer string, secondary_offer string")


def rules_from_effects(effects: DataFrame) -> DataFrame:
    """Rules derived from the data: the offer type with the largest and the second largest effect per segment."""
    ranked = effects.filter(F.col("ate").isNotNull()).groupBy("cluster").agg(
        F.array_sort(F.collect_list(F.struct((-F.round("ate", 6)).alias("a"), "offer_type"))).alias("r"))  # at most one entry per offer type
    return ranked.select("cluster", F.try_element_at("r", F.lit(1))["offer_type"].alias("primary_offer"),
                         F.try_element_at("r", F.lit(2))["offer_type"].alias("secondary_offer"))


def baseline_rate(by_type: DataFrame) -> DataFrame:
    """Expected completion under random targeting: the plain mean of the per-type person rates."""
    return by_type.agg(F.avg("completion_rate").alias("random_completion_rate"))


def rule_lift(features: DataFrame, clusters: DataFrame, rules: DataFrame, by_type: DataFrame) -> DataFrame:
    """Completion expected under the rules against random targeting.

    A segment contributes its mean rate for its primary type, or the type's overall rate where customers carry none.
    """
    joined = features.join(clusters, "id", "left")
    rated = [c[: -len("_completion_rate")] for c in features.columns if c.endswith("_completion_rate") and c != "view_to_completion_rate"]
    per_cluster = joined.groupBy("cluster").agg(F.count(F.lit(1)).alias("n"), *[F.avg(f"{t}_completion_rate").alias(t) for t in rated])
    ruled = per_cluster.join(small_side(rules), "cluster").join(
        small_side(by_type.select(F.col("offer_type").alias("primary_offer"), "completion_rate")), "primary_offer", "left")
    rate = F.coalesce(F.col("completion_rate"), F.lit(0.0))
    for t in rated:
        rate = F.when(F.col("primary_offer") == t, F.col(t)).otherwise(rate)
    everyone = features.agg(F.count(F.lit(1))).toDF("n").scalar()
    base = baseline_rate(by_type).scalar()
    lifted = ruled.agg((F.sum(F.col("n") * rate)).alias("completions")).select(
        base.alias("random_completion_rate"), (F.col("completions") / everyone).alias("rule_based_completion_rate"))
    return lifted.withColumn("lift_percent", (F.col("rule_based_completion_rate") / F.col("random_completion_rate") - 1) * 100)


def recommendations(features: DataFrame, clusters: DataFrame, rules: DataFrame, portfolio: DataFrame) -> DataFrame:
    """One recommended offer per customer: the first offer (by id) of the segment's primary type, with segment traits."""
    offers = portfolio.groupBy("offer_type").agg(F.min_by(F.struct("id", "reward", "difficulty", "duration"), "id").alias("o"))
    labelled = features.join(clusters, "id")
    total = features.agg(F.count(F.lit(1))).toDF("n").scalar()
    traits = labelled.groupBy("cluster").agg(
        F.count(F.lit(1)).alias("cluster_size"), F.avg("age_imputed").alias("avg_age"), F.avg("income_imputed").alias("avg_income"),
        F.avg("completion_rate").alias("cluster_completion_rate"), F.avg("view_rate").alias("cluster_view_rate"))
    plan = traits.join(small_side(rules), "cluster").join(offers.withColumnRenamed("offer_type", "primary_offer"), "primary_offer", "left")
    return labelled.select("id", "cluster").join(small_side(plan), "cluster").select(
        F.col("id").alias("customer_id"), "cluster", "cluster_size", (F.col("cluster_size") / total).alias("cluster_share"),
        F.col("primary_offer").alias("recommended_offer_type"), F.col("o.id").alias("recommended_offer_id"), "o.reward", "o.difficulty", "o.duration",
        "avg_age", "avg_income", "cluster_completion_rate", "cluster_view_rate")


def mean_rewards(portfolio: DataFrame) -> DataFrame:
    return portfolio.groupBy("offer_type").agg(F.avg("reward").alias("avg_reward"))


def segment_kpis(features: DataFrame, clusters: DataFrame, rules: DataFrame, portfolio: DataFrame) -> DataFrame:
    """Spend, completed offers, reward cost and return per segment; no return where nothing is paid out."""
    stats = features.join(clusters, "id").groupBy("cluster").agg(
        F.count(F.lit(1)).alias("size"), F.avg("trans_total").alias("avg_spend_30d"), F.avg("offers_received").alias("offers_received"),
        F.avg("completion_rate").alias("completion_rate"))
    costed = stats.join(small_side(rules), "cluster").join(
        small_side(mean_rewards(portfolio).withColumnRenamed("offer_type", "primary_offer")), "primary_offer", "left")
    completed = F.col("offers_received") * F.col("completion_rate")
    cost = completed * F.coalesce("avg_reward", F.lit(0.0))
    return costed.select(
        "cluster", "size", "primary_offer", "avg_spend_30d", "offers_received", "completion_rate", (F.col("avg_spend_30d") * 12).alias("annual_spend"),
        safe_ratio("avg_spend_30d", "offers_received").alias("revenue_per_offer"), completed.alias("completed_offers_30d"),
        F.coalesce("avg_reward", F.lit(0.0)).alias("reward_cost_per_offer"), cost.alias("total_reward_cost_30d"),
        ratio_or_null(F.col("avg_spend_30d"), cost).alias("offer_roi"))


def portfolio_kpis(segments: DataFrame, lift: DataFrame, portfolio: DataFrame, effect: DataFrame, high_value=(1, 2)) -> DataFrame:
    """Totals over segments, the value of the lift and the share of the high-value segments."""
    revenue, size = F.col("avg_spend_30d") * F.col("size"), F.col("size")
    top = F.col("cluster").isin(list(high_value))
    totals = segments.agg(F.sum(size).alias("n"), F.sum(revenue).alias("total_revenue_30d"), F.sum(F.when(top, size).otherwise(0)).alias("top_n"),
                          F.sum(F.when(top, revenue).otherwise(0.0)).alias("top_revenue"))
    gain = lift.select((F.col("rule_based_completion_rate") - F.col("random_completion_rate")).alias("g")).scalar()
    reward = portfolio.agg(F.avg("reward")).toDF("r").scalar()
    ate = effect.filter("treatment = 'any_offer'").select("ate").scalar()
    total = F.col("total_revenue_30d")
    incremental = F.col("n") * gain
    return totals.select(
        F.col("n").alias("total_customers"), "total_revenue_30d", (total / F.col("n")).alias("avg_revenue_per_customer_30d"),
        (total * 12).alias("annual_revenue_estimate"), incremental.alias("incremental_completions"), reward.alias("avg_reward_per_offer"),
        (incremental * reward).alias("incremental_reward_cost"), (F.col("top_n") / F.col("n") * 100).alias("high_value_segment_pct"),
        (F.col("top_revenue") / total * 100).alias("high_value_revenue_share"), (ate * F.col("n")).alias("incremental_revenue_30d"),
        (ate * F.col("n") * 12).alias("incremental_revenue_annual"))


def revenue_shares(features: DataFrame, clusters: DataFrame) -> DataFrame:
    """Revenue and its share per segment, from exact sums."""
    sums = features.join(clusters, "id").groupBy("cluster").agg(money_sum("trans_total").alias("revenue"))
    return sums.withColumn("revenue_share", F.col("revenue") / features.agg(money_sum("trans_total")).toDF("t").scalar())
