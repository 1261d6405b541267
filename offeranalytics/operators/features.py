"""Customer, offer and customer-offer features. ``events`` is the output of ``typed_events``."""

from pyspark.sql import Column, DataFrame, Window, functions as F, types as T

from ..functions import ordered, scale
from ..functions.constants import (
    AGE_BINS, AS_OF, CHANNELS, CLUSTERING_COLUMNS, COMPLETED, GENDERS, INCOME_BINS, OFFER_TYPES, RECEIVED, TENURE_BINS, VIEWED)
from ..functions.scalars import (
    clean_age, clv_proxy, cut, has_channel, is_completed, is_event, is_received, is_transaction, is_viewed, member_date,
    missing_flag, moments, money_mean, money_sum, one_hot, safe_ratio, standardise, tenure_days, tenure_months)
from .funnel import attach_offer, offer_columns, response_times

SHORT_TYPE = {"bogo": "bogo", "discount": "discount", "informational": "info"}
TYPE_STAGES = {"bogo": ["received", "viewed", "completed"], "discount": ["received", "viewed", "completed"],
               "informational": ["received", "viewed"]}
STAGE_EVENTS = {"received": RECEIVED, "viewed": VIEWED, "completed": COMPLETED}


def demographic_features(profile: DataFrame, as_of=AS_OF) -> DataFrame:
    """Cleaned and imputed age and income, bins, gender flags, tenure and joining date parts."""
    people = profile.select("id", clean_age().alias("age"), "income", "gender", "became_member_on")
    middle = ordered.medians(people, ["age", "income"])
    fill = lambda c: F.coalesce(F.col(c), F.lit(middle.get(c)).cast("double"))
    gender = F.coalesce("gender", F.lit("Unknown"))
    months = tenure_months(as_of=as_of)
    return people.select(
        "id", "age", missing_flag("age").alias("age_missing"), fill("age").alias("age_imputed"),
        cut(fill("age"), *AGE_BINS).alias("age_bin"),
        "income", missing_flag("income").alias("income_missing"), fill("income").alias("income_imputed"),
        cut(fill("income"), *INCOME_BINS).alias("income_bin"),
        gender.alias("gender"), *[one_hot(gender, g).alias(f"gender_{g}") for g in GENDERS],
        tenure_days(as_of=as_of).alias("tenure_days"), months.alias("tenure_months"), cut(months, *TENURE_BINS).alias("tenure_bin"),
        F.year(member_date()).alias("member_year"), F.month(member_date()).alias("member_month"))


def data_limits(events: DataFrame) -> Column:
    """Last hour of the data, first transaction and first receipt, as one struct-valued scalar."""
    return events.agg(F.struct(
        F.max("time").alias("end"), F.min(F.when(is_transaction(), F.col("time"))).alias("first_transaction"),
        F.min(F.when(is_event(RECEIVED), F.col("time"))).alias("first_receipt"))).toDF("limits").scalar()


def customer_activity(events: DataFrame, portfolio: DataFrame, windows=(7, 14)) -> DataFrame:
    """Everything counted or summed per person, in one grouping over events.

    Covers spend statistics, offer counts by stage and by type and stage, last activity and trailing spend.
    """
    typed = attach_offer(events, portfolio, ["offer_type"])
    typed = typed.withColumn("_end", data_limits(events)["end"])
    end = F.col("_end")
    paid = F.when(is_transaction(), F.col("amount"))
    stages = {"received": is_received(), "viewed": is_viewed(), "completed": is_completed()}
    by_type = [F.count_if(stages[s] & (F.col("offer_type") == t)).alias(f"{SHORT_TYPE[t]}_{s}")
               for t, names in TYPE_STAGES.items() for s in names]
    trailing = [money_sum("amount", is_transaction() & (F.col("time") >= end - d * 24)).alias(f"spend_last_{d}d") for d in windows]
    return typed.groupBy("person").agg(
        F.count(paid).alias("trans_count"), money_sum(paid).alias("trans_total"), money_mean(paid).alias("trans_avg"),
        F.stddev_samp(paid).alias("trans_std"), F.min(paid).alias("trans_min"), F.max(paid).alias("trans_max"),
        *[F.count_if(test).alias(f"offers_{s}") for s, test in stages.items()], *by_type, *trailing,
        F.count_if(is_transaction()).alias("frequency"),
        F.max(F.when(is_transaction(), F.col("time"))).alias("last_transaction"),
        F.max(F.when(is_event(RECEIVED), F.col("time"))).alias("last_receipt"))


RATES = {
    "view_rate": ("offers_viewed", "offers_received"), "completion_rate": ("offers_completed", "offers_received"),
    "view_to_completion_rate": ("offers_completed", "offers_viewed"),
    "bogo_view_rate": ("bogo_viewed", "bogo_received"), "bogo_completion_rate": ("bogo_completed", "bogo_received"),
    "discount_view_rate": ("discount_viewed", "discount_received"),
    "discount_completion_rate": ("discount_completed", "discount_received"), "info_view_rate": ("info_viewed", "info_received"),
}
SPEND = ["trans_count", "trans_total", "trans_avg", "trans_std", "trans_min", "trans_max"]
OFFERS = ["offers_received", "offers_viewed", "offers_completed"]
TYPE_COUNTS = [f"{SHORT_TYPE[t]}_{s}" for t, names in TYPE_STAGES.items() for s in names]


def _all_customers(profile: DataFrame, activity: DataFrame, columns: list[str]) -> DataFrame:
    joined = profile.select("id").join(activity.select(F.col("person").alias("id"), *columns), "id", "left")
    return joined


def behavioural_columns() -> list[Column]:
    """Counts and rates for a customer row already joined to its activity; no activity counts as zero."""
    zero = lambda c: F.coalesce(F.col(c), F.lit(0)).alias(c)
    rates = {name: safe_ratio(n, d).alias(name) for name, (n, d) in RATES.items()}
    return [*map(zero, SPEND), *map(zero, OFFERS), *[rates[r] for r in list(RATES)[:3]], *map(zero, TYPE_COUNTS),
            *[rates[r] for r in list(RATES)[3:]]]


def behavioural_features(profile: DataFrame, events: DataFrame, portfolio: DataFrame, activity: DataFrame | None = None) -> DataFrame:
    """``activity``: what ``customer_activity`` gave for the same events, if it is at hand."""
    activity = customer_activity(events, portfolio) if activity is None else activity
    return _all_customers(profile, activity, SPEND + OFFERS + TYPE_COUNTS).select("id", *behavioural_columns())


def recency_columns(limits: Column) -> list[Column]:
    """Days since the last transaction (the longest possible where none), number of transactions and spend."""
    end = limits["end"]
    days = lambda since: (end - since) / 24
    return [F.coalesce(days(F.col("last_transaction")), days(limits["first_transaction"])).alias("recency_days"),
            F.coalesce("frequency", F.lit(0)).alias("frequency"), F.coalesce("trans_total", F.lit(0.0)).alias("monetary")]


def decay_columns(limits: Column, windows=(7, 14)) -> list[Column]:
    end = limits["end"]
    days = lambda since: (end - since) / 24
    spent = {d: F.coalesce(F.col(f"spend_last_{d}d"), F.lit(0.0)) for d in windows}
    longest = max(windows)
    trend = F.when(F.col("trans_avg") > 0, spent[longest] / longest / F.col("trans_avg")).otherwise(0.0)
    return [*[spent[d].alias(f"spend_last_{d}d") for d in windows], trend.alias("spend_trend"),
            F.coalesce(days(F.col("last_receipt")), days(limits["first_receipt"])).alias("offer_recency_days")]


def rfm_scores(rf: DataFrame, q: int = 5) -> DataFrame:
    """Quintiles of recency (reversed), frequency and spend over all customers, and their sum."""
    rows = rf.agg(F.count(F.lit(1)).alias("n")).scalar()
    places = ordered.row_numbers(rf, {"_r": "recency_days", "_f": "frequency", "_m": "monetary"}, "id")
    scored = rf.join(places, "id")
    bucket = lambda n: ordered.quantile_bucket(F.col(f"_{n}"), rows, q)
    quintiles = {"r_quintile": q + 1 - bucket("r"), "f_quintile": bucket("f"), "m_quintile": bucket("m")}
    return scored.withColumns(quintiles).drop("_r", "_f", "_m").withColumn(
        "rfm_score", F.col("r_quintile") + F.col("f_quintile") + F.col("m_quintile"))


def rfm_features(profile: DataFrame, events: DataFrame, portfolio: DataFrame) -> DataFrame:
    joined = _all_customers(profile, customer_activity(events, portfolio), ["last_transaction", "frequency", "trans_total"])
    dated = joined.withColumn("_limits", data_limits(events))
    return rfm_scores(scale.durable(dated.select("id", *recency_columns(F.col("_limits")))))


def time_decay_features(profile: DataFrame, events: DataFrame, portfolio: DataFrame, windows=(7, 14)) -> DataFrame:
    activity = customer_activity(events, portfolio, windows)
    needed = [f"spend_last_{d}d" for d in windows] + ["trans_avg", "last_receipt"]
    dated = _all_customers(profile, activity, needed).withColumn("_limits", data_limits(events))
    return dated.select("id", *decay_columns(F.col("_limits"), windows))


def timing_features(profile: DataFrame, events: DataFrame) -> DataFrame:
    zero = lambda c: F.coalesce(F.col(c), F.lit(0.0)).alias(c)
    joined = _all_customers(profile, response_times(events), ["avg_time_to_view", "avg_time_to_complete"])
    return joined.select("id", zero("avg_time_to_view"), zero("avg_time_to_complete"))


def customer_features(profile: DataFrame, events: DataFrame, portfolio: DataFrame, as_of=AS_OF,
                      as_of_hours: int | None = None, activity: DataFrame | None = None) -> DataFrame:
    """All customer features. ``as_of_hours`` ignores later events, so features cannot see the outcome they predict.

    ``activity``: what ``customer_activity`` gave for the same events up to that hour, if it is at hand."""
    if as_of_hours is not None:
        events = events.filter(F.col("time") <= as_of_hours)
    activity = (customer_activity(events, portfolio) if activity is None else activity).withColumnRenamed("person", "id")
    timing = response_times(events).withColumnRenamed("person", "id")
    # One stored table of customer rows: the three rankings and the final join all read it.
    base = scale.durable(
        demographic_features(profile, as_of).join(activity, "id", "left").join(timing, "id", "left")
        .withColumn("_limits", data_limits(events)))
    limits = F.col("_limits")
    rfm = rfm_scores(base.select("id", *recency_columns(limits)))
    zero = lambda c: F.coalesce(F.col(c), F.lit(0.0)).alias(c)
    demographics = [c for c in base.columns[:base.columns.index("trans_count")]]
    rest = base.select(*demographics, *behavioural_columns(), *decay_columns(limits),
                       zero("avg_time_to_view"), zero("avg_time_to_complete"))
    rfm_columns = ["recency_days", "frequency", "monetary", "rfm_score"]
    joined = rest.join(rfm.select("id", *rfm_columns), "id", "left")
    decay = ["spend_last_7d", "spend_last_14d", "spend_trend", "offer_recency_days"]
    head = [c for c in rest.columns if c not in decay + ["avg_time_to_view", "avg_time_to_complete"]]
    return joined.select(*head, *rfm_columns, *decay, "avg_time_to_view", "avg_time_to_complete").withColumn("clv_proxy", clv_proxy())


def full_outer(demographics: DataFrame, behaviour: DataFrame) -> DataFrame:
    return demographics.join(behaviour, "id", "full_outer")


def join_features(base: DataFrame, *groups: DataFrame) -> DataFrame:
    """Left joins of feature groups on ``id``; all share the key, so one shuffle of each side."""
    for group in groups:
        base = base.join(group, "id", "left")
    return base


def offer_features(portfolio: DataFrame, channels=CHANNELS) -> DataFrame:
    return portfolio.select(
        "id", "offer_type", "difficulty", "reward", "duration",
        *[one_hot("offer_type", t).alias(f"offer_type_{t}") for t in OFFER_TYPES],
        *[has_channel(c).alias(f"channel_{c}") for c in channels],
        (F.col("difficulty") * F.col("reward")).alias("difficulty_x_reward"),
        (F.col("difficulty") * F.col("duration")).alias("difficulty_x_duration"),
        (F.col("reward") / F.col("duration")).alias("reward_per_day"),
        (F.col("difficulty") / F.col("duration")).alias("difficulty_per_day"))


def channel_universe(portfolio: DataFrame) -> DataFrame:
    return portfolio.select(F.explode("channels").alias("channel")).distinct().orderBy("channel")


def channels_used(events: DataFrame, portfolio: DataFrame) -> DataFrame:
    """Distinct channels over the offers a customer received: one flag per channel, so no set is collected."""
    received = events.filter(is_event(RECEIVED)).select("person", "offer_id").distinct()
    flagged = received.join(offer_columns(portfolio, ["channels"]), "offer_id", "left").select(
        F.col("person").alias("id"), F.explode("channels").alias("channel"))
    return flagged.distinct().groupBy("id").agg(F.count(F.lit(1)).alias("total_channels_used"))


def viewed_channels(events: DataFrame, portfolio: DataFrame, channels=CHANNELS) -> DataFrame:
    """Channels of each (customer, offer) that was viewed, with the customer's total beside them."""
    viewed = events.filter(is_event(VIEWED)).select("person", "offer_id").distinct()
    flags = offer_columns(portfolio.select("id", *[has_channel(c).alias(f"viewed_via_{c}") for c in channels]),
                          [f"viewed_via_{c}" for c in channels])
    totals = channels_used(events, portfolio).withColumnRenamed("id", "customer_id")
    return (viewed.withColumnRenamed("person", "customer_id").join(flags, "offer_id", "left")
            .join(totals, "customer_id", "left")
            .select("customer_id", "offer_id", *[f"viewed_via_{c}" for c in channels], "total_channels_used"))


def customer_offer_pairs(customers: DataFrame, offers: DataFrame) -> DataFrame:
    """Every customer with every offer, attributes of both sides attached."""
    renamed = offers.withColumnRenamed("id", "offer_id")
    paired = scale.every_pair_with(customers.withColumnRenamed("id", "customer_id"), renamed, "offer")
    rest = [c for c in customers.columns if c != "id"]
    return paired.select("customer_id", "offer.offer_id", *rest, *[F.col(f"offer.{c}") for c in renamed.columns if c != "offer_id"])


def completion_counts(events: DataFrame) -> DataFrame:
    return events.filter(is_completed()).groupBy(F.col("person").alias("customer_id"), "offer_id").agg(
        F.count(F.lit(1)).alias("n_completions"))


def labelled_pairs(pairs: DataFrame, events: DataFrame, dedupe: bool = False) -> DataFrame:
    """Pairs with a completion label. By default a pair repeats once per completion, as published; ``dedupe`` keeps one."""
    joined = pairs.join(completion_counts(events), ["customer_id", "offer_id"], "left")
    joined = joined.withColumn("completed", F.col("n_completions").isNotNull().cast("int"))
    if dedupe:
        return joined.drop("n_completions")
    hottest = completion_counts(events).agg(F.max("n_completions")).first()[0] or 0
    repeated = joined.withColumn("n_completions", F.coalesce("n_completions", F.lit(1)))
    return scale.copies(repeated, "n_completions", ["customer_id", "offer_id"], most=hottest)


def with_view_flags(pairs: DataFrame, viewed: DataFrame, channels=CHANNELS) -> DataFrame:
    """Adds channel flags of viewed pairs. ``total_channels_used`` stays null where the pair was not viewed."""
    joined = pairs.join(viewed, ["customer_id", "offer_id"], "left")
    return joined.withColumns({f"viewed_via_{c}": F.coalesce(F.col(f"viewed_via_{c}"), F.lit(0)) for c in channels})


def offer_history(label_events: DataFrame, events: DataFrame) -> DataFrame:
    """Per customer a map offer -> (completions, viewed); as many entries as offers, since offers are counted first."""
    done = completion_counts(label_events)
    seen = events.filter(is_viewed()).select(F.col("person").alias("customer_id"), "offer_id", F.lit(1).alias("viewed")).distinct()
    entry = F.struct("offer_id", F.struct(F.coalesce("n_completions", F.lit(0)).alias("n"), F.coalesce("viewed", F.lit(0)).alias("viewed")))
    return done.join(seen, ["customer_id", "offer_id"], "full_outer").groupBy(F.col("customer_id").alias("id")).agg(
        F.map_from_entries(F.collect_list(entry)).alias("_history"))


def interaction_features(features: DataFrame, events: DataFrame, portfolio: DataFrame, dedupe: bool = False,
                         label_events: DataFrame | None = None, channels=CHANNELS, store: bool = False) -> DataFrame:
    """The modelling table: pairs, labels and view flags. ``label_events`` may hold a later period than ``events``.

    Same rows as ``labelled_pairs`` and ``with_view_flags`` over ``customer_offer_pairs``, but history joins at customer
    level before the pairs are formed, so the wide pair table is never shuffled. With ``store`` the customer rows are dealt
    over all cores and stored: a few passes form the pairs anew, so the wide table need not be written for them.
    """
    labels = events if label_events is None else label_events
    totals = channels_used(events, portfolio).withColumnRenamed("total_channels_used", "_total")
    customers = features.join(offer_history(labels, events), "id", "left").join(totals, "id", "left")
    if store:
        portfolio = scale.durable(portfolio)
        customers = scale.durable(scale.spread(customers, features.count() * portfolio.count(), "id"))
    pairs = customer_offer_pairs(customers, offer_features(portfolio))
    past = F.try_element_at("_history", F.col("offer_id"))
    viewed = F.coalesce(past["viewed"], F.lit(0))
    flagged = pairs.withColumns({
        "n_completions": F.coalesce(past["n"], F.lit(0)), **{f"viewed_via_{c}": viewed * F.col(f"channel_{c}") for c in channels},
        "total_channels_used": F.when(viewed == 1, F.col("_total"))}).drop("_history", "_total")
    labelled = flagged.withColumn("completed", (F.col("n_completions") > 0).cast("int"))
    if dedupe:
        return labelled.drop("n_completions")
    hottest = completion_counts(labels).agg(F.max("n_completions")).first()[0] or 0
    repeated = labelled.withColumn("n_completions", F.greatest("n_completions", F.lit(1)))
    return scale.copies(repeated, "n_completions", ["customer_id", "offer_id"], most=hottest)


def pair_history(customers: DataFrame, offers: DataFrame, events: DataFrame) -> DataFrame:
    """Every customer with every offer and ``n_completions`` and ``viewed`` of the pair.

    History joins per customer before the pairs are formed; the pair table itself is not shuffled.
    """
    pairs = customer_offer_pairs(customers.join(offer_history(events, events), "id", "left"), offers)
    past = F.try_element_at("_history", F.col("offer_id"))
    return pairs.withColumns({"n_completions": F.coalesce(past["n"], F.lit(0)), "viewed": F.coalesce(past["viewed"], F.lit(0))}).drop("_history")


def all_labelled_pairs(customers: DataFrame, offers: DataFrame, events: DataFrame, dedupe: bool = False) -> DataFrame:
    """``labelled_pairs`` of every customer with every offer, without shuffling the pairs."""
    pairs = pair_history(customers, offers, events).withColumn("completed", (F.col("n_completions") > 0).cast("int")).drop("viewed")
    if dedupe:
        return pairs.drop("n_completions")
    hottest = completion_counts(events).agg(F.max("n_completions")).first()[0] or 0
    return scale.copies(pairs.withColumn("n_completions", F.greatest("n_completions", F.lit(1))), "n_completions", ["customer_id", "offer_id"], most=hottest)


def all_view_flags(customers: DataFrame, portfolio: DataFrame, events: DataFrame, channels=CHANNELS) -> DataFrame:
    """``with_view_flags`` of every customer with every offer, without shuffling the pairs."""
    totals = channels_used(events, portfolio).withColumnRenamed("total_channels_used", "_total")
    offers = portfolio.select("id", *[F.array_contains("channels", c).cast("int").alias(f"_{c}") for c in channels])
    pairs = pair_history(customers.join(totals, "id", "left"), offers, events)
    return pairs.withColumns({**{f"viewed_via_{c}": F.coalesce(F.col("viewed") * F.col(f"_{c}"), F.lit(0)) for c in channels},
                              "total_channels_used": F.when(F.col("viewed") == 1, F.col("_total"))}).drop(
        "n_completions", "viewed", "_total", *[f"_{c}" for c in channels])


def pair_label_counts(customers: DataFrame, offers: DataFrame, events: DataFrame) -> DataFrame:
    """Rows per label of ``all_labelled_pairs``, counted without forming a pair."""
    done = (completion_counts(events).join(customers.select(F.col("id").alias("customer_id")), "customer_id", "left_semi")
            .join(offers.select(F.col("id").alias("offer_id")), "offer_id", "left_semi"))
    counts = done.agg(F.coalesce(F.sum("n_completions"), F.lit(0)).alias("n"), F.count(F.lit(1)).alias("pairs"))
    rows = lambda df: df.agg(F.count(F.lit(1))).toDF("n").scalar()
    cells = F.array(F.struct(F.lit(0).alias("completed"), (rows(customers) * rows(offers) - F.col("pairs")).alias("n_rows")),
                    F.struct(F.lit(1).alias("completed"), F.col("n").alias("n_rows")))
    return counts.select(F.explode(cells).alias("c")).select("c.*").filter("n_rows > 0")


def feature_summary(tables: dict[str, DataFrame], keys: dict[str, list[str]]) -> DataFrame:
    """Rows and number of features per table; ``keys`` names the columns that are not features."""
    return ordered.union_all([
        df.agg(F.count(F.lit(1)).alias("n_rows")).select(
            F.lit(name).alias("table_name"), "n_rows",
            F.lit(len([c for c in df.columns if c not in keys.get(name, [])])).alias("n_features"))
        for name, df in tables.items()])


def label_distribution(pairs: DataFrame, label: str = "completed") -> DataFrame:
    return pairs.groupBy(label).agg(F.count(F.lit(1)).alias("n_rows"))


def clustering_matrix(features: DataFrame, columns=CLUSTERING_COLUMNS, keep=("id",)) -> DataFrame:
    """The segmentation columns that exist, nulls as zero, standardised."""
    columns = [c for c in columns if c in features.columns]
    filled = features.select(*keep, *[F.coalesce(F.col(c).cast("double"), F.lit(0.0)).alias(c) for c in columns])
    return standardise(filled, columns)


def numeric_features(df: DataFrame, exclude=("customer_id", "offer_id", "completed"), pattern: str = "_bin") -> list[str]:
    """Names of the model inputs: numeric columns that are neither keys, label nor bins."""
    return [f.name for f in df.schema
            if isinstance(f.dataType, T.NumericType) and f.name not in exclude and pattern not in f.name]


def model_matrix(df: DataFrame, keep=("customer_id", "offer_id", "completed")) -> DataFrame:
    columns = numeric_features(df)
    filled = df.select(*keep, *[F.coalesce(F.col(c).cast("double"), F.lit(0.0)).alias(c) for c in columns])
    return standardise(filled, columns, moments(filled, columns))


def stratified_numbers(df: DataFrame, label: str, key: str, seed: int = 42) -> DataFrame:
    """Position of each row inside its class in a seeded pseudo-random order.

    Rows are sliced by their md5 first, so no task orders a whole class.
    """
    hashed = df.withColumn("_hash", F.md5(F.concat(F.col(key).cast("string"), F.lit(f":{seed}")))).withColumn(
        "_slice", F.substring("_hash", 1, 3))
    sizes = scale.durable(hashed.groupBy(label, "_slice").agg(F.count(F.lit(1)).alias("_n")))
    order = Window.partitionBy(label).orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy(label)
    before = sizes.select(label, "_slice", F.coalesce(F.sum("_n").over(order), F.lit(0)).alias("_before"), F.sum("_n").over(whole).alias("class_rows"))
    inside = Window.partitionBy(label, "_slice").orderBy("_hash")
    return (hashed.join(before, [label, "_slice"])
            .withColumn("class_position", (F.row_number().over(inside) + F.col("_before")).cast("long"))
            .drop("_hash", "_slice", "_before"))


def stratified_split(df: DataFrame, label: str, key: str, test_share: float = 0.2, seed: int = 42) -> DataFrame:
    """Adds ``is_test``: an exact share of each class, the rows with the smallest seeded md5 of ``key``.

    Only counts per slice of the md5 and the rows of one slice per class are ordered, to find the class's last test
    row; every row then decides by its own hash, so the rows themselves are not shuffled.
    """
    hashed = F.md5(F.concat(F.col(key).cast("string"), F.lit(f":{seed}")))
    keys = df.select(F.col(label).alias("_label"), hashed.alias("_hash")).withColumn("_slice", F.substring("_hash", 1, 3))
    sizes = scale.durable(keys.groupBy("_label", "_slice").agg(F.count(F.lit(1)).alias("_n")))
    order = Window.partitionBy("_label").orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
    quota = F.round(F.sum("_n").over(Window.partitionBy("_label")) * F.lit(test_share))
    placed = sizes.select("_label", "_slice", "_n", F.coalesce(F.sum("_n").over(order), F.lit(0)).alias("_before"), quota.alias("_quota"))
    edge = placed.filter("_before < _quota and _before + _n >= _quota").select("_label", "_slice", (F.col("_quota") - F.col("_before")).alias("_take"))
    inside = Window.partitionBy("_label", "_slice").orderBy("_hash")
    near = keys.join(scale.small_side(edge), ["_label", "_slice"]).withColumn("_place", F.row_number().over(inside))
    # rows that repeat the key of the last test row share its hash: only as many of them as the quota leaves
    last = near.filter("_place = _take").select("_label", F.col("_hash").alias("_last"), "_take").join(
        near.groupBy("_label", F.col("_hash").alias("_last")).agg(F.min("_place").alias("_first")), ["_label", "_last"])
    joined = df.withColumn("_hash", hashed).join(scale.small_side(scale.durable(last)), F.col(label) == F.col("_label"), "left")
    clear = joined.filter("_last is null or _hash <> _last").withColumn("is_test", F.coalesce((F.col("_hash") < F.col("_last")).cast("int"), F.lit(0)))
    turn = F.row_number().over(Window.partitionBy("_label").orderBy(key))
    tied = joined.filter("_hash = _last").withColumn("is_test", (turn <= F.col("_take") - F.col("_first") + 1).cast("int"))
    # the few rows of one hash per class are stored, so that later passes go over the whole table once
    return clear.unionByName(scale.durable(tied)).drop("_label", "_last", "_take", "_first", "_hash")


def stratified_folds(df: DataFrame, label: str, key: str, k: int = 5, seed: int = 42) -> DataFrame:
    numbered = stratified_numbers(df, label, key, seed)
    return numbered.withColumn("fold", (F.col("class_position") % k).cast("int")).drop("class_position", "class_rows")


def hash_split(df: DataFrame, key: str, test_share: float = 0.2, seed: int = 42) -> DataFrame:
    """A split without any shuffle: each row decides by its own md5, shares hold on average."""
    uniform = F.conv(F.substring(F.md5(F.concat(F.col(key).cast("string"), F.lit(f":{seed}"))), 1, 8), 16, 10).cast("double") / 2**32
    return df.withColumn("is_test", (uniform < test_share).cast("int"))


def class_weights(df: DataFrame, label: str) -> DataFrame:
    positive = F.count_if(F.col(label) == 1)
    negative = F.count_if(F.col(label) == 0)
    return df.agg(negative.alias("n_negative"), positive.alias("n_positive"),
                  (negative / F.when(positive > 0, positive)).alias("positive_weight"))


def sample_ids(df: DataFrame, key: str, n: int, seed: int = 42) -> DataFrame:
    """A repeatable sample of ids: the n smallest seeded hashes."""
    return df.select(key).orderBy(F.md5(F.concat(F.col(key).cast("string"), F.lit(f":{seed}"))), key).limit(n)
