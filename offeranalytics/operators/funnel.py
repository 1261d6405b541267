"""Offer funnels, response times, cohorts and channels. ``events`` is the output of ``typed_events``."""

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..functions.constants import CHANNELS, COMPLETED, OFFER_TYPES, RECEIVED, VIEWED
from ..functions.ordered import exact_quantiles, quantiles_of_counts, union_all
from ..functions.scalars import (
    clean_age, has_channel, is_completed, is_event, is_received, is_transaction, is_viewed, member_date, money_mean,
    money_sum, ratio_or_null, safe_ratio, tenure_days)
from ..functions.scale import small_side

STAGES = {"received": RECEIVED, "viewed": VIEWED, "completed": COMPLETED}


def offer_columns(portfolio: DataFrame, columns: list[str]) -> DataFrame:
    return small_side(portfolio.select(F.col("id").alias("offer_id"), *columns))


def attach_offer(events: DataFrame, portfolio: DataFrame, columns: list[str]) -> DataFrame:
    """All events with attributes of their offer. Events without an offer are spread by person, not sent to one task."""
    spread = F.coalesce("offer_id", F.concat(F.lit("\0"), F.pmod(F.xxhash64("person"), F.lit(4096)).cast("string")))
    offers = offer_columns(portfolio, columns).withColumnRenamed("offer_id", "_key")
    return events.withColumn("_key", spread).join(offers, "_key", "left").drop("_key")


def with_offer(events: DataFrame, portfolio: DataFrame, columns: list[str]) -> DataFrame:
    """Offer events with attributes of their offer; unknown offers keep nulls."""
    return events.filter(F.col("offer_id").isNotNull()).join(offer_columns(portfolio, columns), "offer_id", "left")


def stage_counts(prefix: str = "n_", weight: str | None = None) -> list[Column]:
    if weight:
        return [F.sum(F.when(is_event(e), F.col(weight)).otherwise(0)).alias(prefix + s) for s, e in STAGES.items()]
    return [F.count_if(is_event(e)).alias(prefix + s) for s, e in STAGES.items()]


def per_offer_event(events: DataFrame) -> DataFrame:
    """Rows per (offer, event): the one pass over events behind every offer and channel table."""
    return events.filter(F.col("offer_id").isNotNull()).groupBy("offer_id", "event").agg(F.count(F.lit(1)).alias("n"))


def offer_funnel(events: DataFrame, portfolio: DataFrame) -> DataFrame:
    """Received, viewed and completed counts and three rates per offer."""
    counts = events.filter(F.col("offer_id").isNotNull()).groupBy("offer_id").agg(*stage_counts())
    return counts.join(offer_columns(portfolio, ["offer_type", "difficulty", "reward", "duration"]), "offer_id", "left").select(
        "offer_id", "offer_type", "difficulty", "reward", "duration", "n_received", "n_viewed", "n_completed",
        safe_ratio("n_viewed", "n_received").alias("view_rate"),
        safe_ratio("n_completed", "n_received").alias("completion_rate"),
        safe_ratio("n_completed", "n_viewed").alias("view_to_completion_rate"))


def rates_by_type(offer_stats: DataFrame) -> DataFrame:
    """Mean rate over the offers of each type, every offer counting once."""
    rates = ["view_rate", "completion_rate", "view_to_completion_rate"]
    return (offer_stats.filter(F.col("offer_type").isNotNull()).groupBy("offer_type")
            .agg(F.count(F.lit(1)).alias("n_offers"), *[F.avg(r).alias(r) for r in rates]))


def overall_funnel(events: DataFrame) -> DataFrame:
    totals = events.filter(F.col("offer_id").isNotNull()).agg(*stage_counts("total_"))
    return totals.select("*", ratio_or_null("total_viewed", "total_received").alias("view_rate"),
                         ratio_or_null("total_completed", "total_received").alias("completion_rate"),
                         ratio_or_null("total_completed", "total_viewed").alias("view_to_completion_rate"))


def funnel_by_type(events: DataFrame, portfolio: DataFrame) -> DataFrame:
    counted = with_offer(per_offer_event(events), portfolio, ["offer_type"])
    return counted.filter(F.col("offer_type").isNotNull()).groupBy("offer_type").agg(*stage_counts("", "n"))


def gap_pairs(events: DataFrame, later: str = VIEWED, how: str = "left") -> DataFrame:
    """Every receipt of an offer against every later-stage event of the same person and offer.

    Repeats within one hour are counted first, so a row stands for ``n_pairs`` pairs and a busy key yields at most
    hours x hours rows. Gaps may be negative.
    """
    def hourly(stage, time, n):
        return (events.filter(is_event(stage) & F.col("offer_id").isNotNull())
                .groupBy("person", "offer_id", F.col("time").alias(time)).agg(F.count(F.lit(1)).alias(n)))

    received = hourly(RECEIVED, "receive_time", "n_received")
    other = hourly(later, "later_time", "n_later")
    return received.join(other, ["person", "offer_id"], how).select(
        "person", "offer_id", "receive_time", "later_time", (F.col("later_time") - F.col("receive_time")).alias("gap_hours"),
        (F.col("n_received") * F.coalesce("n_later", F.lit(1))).alias("n_pairs"))


def gap_statistics(pairs: DataFrame) -> DataFrame:
    """Eight-number description of the gaps; the histogram over whole hours carries all of it."""
    histogram = (pairs.filter(F.col("gap_hours").isNotNull()).groupBy("gap_hours")
                 .agg(F.sum("n_pairs").alias("n")))
    g, n = F.col("gap_hours").cast("decimal(38,0)"), F.col("n")
    total, s1, s2 = F.sum(n), F.sum(g * n).cast("double"), F.sum(g * g * n).cast("double")
    moments = histogram.agg(
        total.alias("count"), (s1 / total).alias("mean"),
        F.sqrt((s2 - s1 * s1 / total) / F.when(total > 1, total - 1)).alias("std"),
        F.min("gap_hours").alias("min"), F.max("gap_hours").alias("max"))
    quartiles = quantiles_of_counts(histogram, "gap_hours", {"q25": 0.25, "q50": 0.5, "q75": 0.75}, splits=[])
    packed = quartiles.select(F.struct("q25", "q50", "q75").alias("q")).scalar()
    return moments.select("count", "mean", "std", "min", packed["q25"].alias("p25"), packed["q50"].alias("p50"),
                          packed["q75"].alias("p75"), "max")


def time_to_complete(events: DataFrame, portfolio: DataFrame) -> DataFrame:
    """Receipt x completion pairs with the offer's type."""
    pairs = gap_pairs(events, COMPLETED, "inner").withColumnsRenamed({"later_time": "complete_time", "gap_hours": "time_to_complete"})
    return pairs.join(offer_columns(portfolio, ["offer_type"]), "offer_id", "left")


def first_times(events: DataFrame) -> DataFrame:
    """First receipt, view and completion per (person, offer) in one pass."""
    first = lambda test, name: F.min(F.when(test, F.col("time"))).alias(name)
    return events.filter(F.col("offer_id").isNotNull()).groupBy("person", "offer_id").agg(
        first(is_received(), "received_time"), first(is_viewed(), "viewed_time"), first(is_completed(), "completed_time"))


def first_response_pairs(events: DataFrame, stage: str = "viewed") -> DataFrame:
    """First receipt with the first view (or completion) at or after it."""
    pairs = first_times(events).filter(F.col(f"{stage}_time") >= F.col("received_time"))
    return pairs.select("person", "offer_id", "received_time", f"{stage}_time",
                        (F.col(f"{stage}_time") - F.col("received_time")).alias("hours"))


def response_times(events: DataFrame) -> DataFrame:
    """Mean hours from first receipt to first view and to first completion, per person (null where none)."""
    gap = lambda s: F.when(F.col(f"{s}_time") >= F.col("received_time"), F.col(f"{s}_time") - F.col("received_time"))
    return first_times(events).groupBy("person").agg(
        F.avg(gap("viewed")).alias("avg_time_to_view"), F.avg(gap("completed")).alias("avg_time_to_complete"))


def describe(df: DataFrame, columns: list[str], by=()) -> DataFrame:
    """Count, mean, deviation, minimum, quartiles and maximum per column, all exact."""
    by = list(by)
    quartiles = exact_quantiles(df, columns, {"p25": 0.25, "p50": 0.5, "p75": 0.75}, by).drop("n")
    cells = [F.struct(F.lit(c).alias("metric"), F.col(c).cast("double").alias("v")) for c in columns]
    long = df.select(*by, F.explode(F.array(*cells)).alias("c")).select(*by, "c.*").filter(F.col("v").isNotNull())
    moments = long.groupBy(*by, "metric").agg(F.count("v").alias("count"), F.avg("v").alias("mean"),
                                              F.stddev_samp("v").alias("std"), F.min("v").alias("min"), F.max("v").alias("max"))
    return moments.join(quartiles, [*by, "metric"]).select(*by, "metric", "count", "mean", "std", "min", "p25", "p50", "p75", "max")


def demographic_summary(profile: DataFrame) -> DataFrame:
    """Age and income without missing values, and tenure: mean, median, minimum, maximum."""
    people = profile.select(clean_age().alias("age"), F.col("income"), tenure_days().cast("double").alias("tenure_days"))
    return describe(people, ["age", "income", "tenure_days"]).select(
        "metric", F.col("count").alias("n"), "mean", F.col("p50").alias("median"), "min", "max")


def responders(events: DataFrame) -> DataFrame:
    return events.filter(is_event(COMPLETED)).select("person").distinct()


def customer_transactions(events: DataFrame) -> DataFrame:
    """Spend per customer and whether the customer ever completed an offer, from one grouping."""
    paid = F.when(is_transaction(), F.col("amount"))
    grouped = events.filter(is_transaction() | is_event(COMPLETED)).groupBy("person").agg(
        F.count(paid).alias("trans_count"), money_sum(paid).alias("trans_total"), money_mean(paid).alias("trans_avg"),
        F.stddev_samp(paid).alias("trans_std"), F.max(is_event(COMPLETED).cast("int")).alias("is_responder"))
    return grouped.filter("trans_count > 0").withColumnRenamed("person", "customer_id")


def responder_comparison(transactions: DataFrame) -> DataFrame:
    return transactions.groupBy("is_responder").agg(
        F.count(F.lit(1)).alias("n_customers"), F.avg("trans_count").alias("avg_trans_count"),
        F.avg("trans_avg").alias("avg_trans_amount"), money_mean("trans_total").alias("avg_total_spend"))


def person_stage_counts(events: DataFrame) -> DataFrame:
    return events.groupBy("person").agg(*stage_counts())


def cohorts(profile: DataFrame, events: DataFrame) -> DataFrame:
    """Offer response by year of joining. Events count even without an offer id."""
    per_person = person_stage_counts(events).withColumnRenamed("person", "id")
    joined = profile.select("id", F.year(member_date()).alias("join_year")).join(per_person, "id", "left")
    total = lambda s: F.sum(F.coalesce(F.col(f"n_{s}"), F.lit(0))).alias(f"total_{s}")
    grouped = joined.groupBy("join_year").agg(F.count("id").alias("n_customers"), *[total(s) for s in STAGES])
    return grouped.select("*", ratio_or_null("total_completed", "total_received").alias("completion_rate"),
                          ratio_or_null("total_viewed", "total_received").alias("view_rate"),
                          (F.col("total_completed") / F.col("n_customers")).alias("avg_completed_per_person"))


def channel_effectiveness(events: DataFrame, portfolio: DataFrame, channels=CHANNELS) -> DataFrame:
    """View and completion rates of offers with and without each channel."""
    counted = with_offer(per_offer_event(events), portfolio, ["channels"]).filter(F.col("channels").isNotNull())
    cells = F.array(*[F.struct(F.lit(c).alias("channel"), has_channel(c).alias("used")) for c in channels])
    long = counted.select("event", "n", F.explode(cells).alias("c")).select("event", "n", "c.*")
    count = lambda stage, used: F.sum(F.when(is_event(STAGES[stage]) & (F.col("used") == used), F.col("n")).otherwise(0))
    sides = {"with": 1, "without": 0}
    grouped = long.groupBy("channel").agg(*[count(s, u).alias(f"{s}_{side}") for s in STAGES for side, u in sides.items()])
    rates = [ratio_or_null(f"{s}_{side}", f"received_{side}").alias(f"{name}_rate_{side}")
             for s, name in (("viewed", "view"), ("completed", "completion")) for side in sides]
    return grouped.select("channel", *rates, *[F.col(f"received_{s}").alias(f"n_received_{s}") for s in sides])


def channel_by_type(events: DataFrame, portfolio: DataFrame, channels=CHANNELS) -> DataFrame:
    """Rates per offer type and channel; a pair never used keeps a zero count and null rates."""
    counted = with_offer(per_offer_event(events), portfolio, ["offer_type", "channels"]).filter(F.col("offer_type").isNotNull())
    cells = F.array(*[F.struct(F.lit(c).alias("channel"), has_channel(c).alias("used")) for c in channels])
    long = counted.select("offer_type", "event", "n", F.explode(cells).alias("c")).select("offer_type", "event", "n", "c.*")
    grouped = long.withColumn("n", F.col("n") * F.col("used")).groupBy("offer_type", "channel").agg(*stage_counts("", "n"))
    return grouped.select("offer_type", "channel", ratio_or_null("viewed", "received").alias("view_rate"),
                          ratio_or_null("completed", "received").alias("completion_rate"),
                          F.col("received").alias("n_received"))


def channel_type_matrix(by_type: DataFrame, value: str = "view_rate", types=OFFER_TYPES) -> DataFrame:
    return by_type.groupBy("channel").pivot("offer_type", types).agg(F.first(value))


def channel_event_counts(events: DataFrame, portfolio: DataFrame) -> DataFrame:
    """Counts per (type, channel) with one column per event, plus the completion rate."""
    counted = with_offer(per_offer_event(events), portfolio, ["offer_type", "channels"])
    long = counted.select("offer_type", F.explode("channels").alias("channel"), "event", "n")
    table = long.groupBy("offer_type", "channel").agg(*stage_counts("", "n"))
    return table.withColumn("completion_rate", ratio_or_null("completed", "received"))


def completion_indicator(events: DataFrame, portfolio: DataFrame) -> DataFrame:
    """One row per (offer type, person): did the person complete any offer of that type."""
    return (with_offer(events, portfolio, ["offer_type"]).filter(F.col("offer_type").isNotNull())
            .groupBy("offer_type", "person").agg(
                F.max(is_event(COMPLETED).cast("int")).alias("completed"),
                F.count_if(is_event(RECEIVED)).alias("n_received"), F.count_if(is_event(COMPLETED)).alias("n_completed")))


def completion_rates(indicator: DataFrame) -> DataFrame:
    """Event-level rate beside the share of persons who completed; the two differ by design."""
    return indicator.groupBy("offer_type").agg(
        F.count(F.lit(1)).alias("n_persons"), F.avg("completed").alias("person_completion_rate"),
        safe_ratio(F.sum("n_completed"), F.sum("n_received")).alias("event_completion_rate"))


def persons_by_type(events: DataFrame, portfolio: DataFrame) -> DataFrame:
    """Distinct persons who received and completed each offer type, and their ratio."""
    per_person = (with_offer(events, portfolio, ["offer_type"]).filter(F.col("offer_type").isNotNull())
                  .groupBy("offer_type", "person").agg(F.max(is_event(RECEIVED).cast("int")).alias("received"),
                                                       F.max(is_event(COMPLETED).cast("int")).alias("completed")))
    return per_person.groupBy("offer_type").agg(
        F.sum("received").alias("n_received"), F.sum("completed").alias("n_completed")).withColumn(
        "completion_rate", safe_ratio("n_completed", "n_received"))


def funnel_stages(overall: DataFrame) -> DataFrame:
    """The overall funnel as one row per stage."""
    stages = [overall.select(F.lit(i + 1).alias("position"), F.lit(s).alias("stage"), F.col(f"total_{s}").alias("n_events"),
                             ratio_or_null(f"total_{s}", "total_received").alias("share_of_received"))
              for i, s in enumerate(STAGES)]
    return union_all(stages)


def largest(df: DataFrame, column: str, k: int, key: str) -> DataFrame:
    """Top k rows, ties by key."""
    return df.orderBy(F.desc(column), key).limit(k)


def best_per_group(df: DataFrame, group: str, column: str, key: str) -> DataFrame:
    """The row with the largest value in each (small) group, ties by key."""
    order = Window.partitionBy(group).orderBy(F.desc(column), key)
    return df.withColumn("_place", F.row_number().over(order)).filter("_place = 1").drop("_place")
