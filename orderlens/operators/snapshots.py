"""Point-in-time customer snapshots and forward labels.

Plan shape, in the order Spark runs it:

1. Orders collapse to (customer, day, category) with map-side combine. The shuffle key
   spreads a dominant customer over all partitions.
2. What remains is shuffled once by customer. A customer now has at most one row per
   calendar day and category, however many orders it holds, so no partition can grow
   with the volume of a single customer. Nothing after this step shuffles or sorts again.
3. Windows over these days give the running state (lifetime, first and previous day,
   last gaps, next order) and the purchases of the trailing year, an array of at most
   one entry per day and category.
4. Each day is handed to the score dates for which it is the last day before: every
   snapshot comes from exactly one row, with no as-of join and no aggregation.
5. Array expressions turn the trailing year into the features of the snapshot.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from orderlens import config as fixed
from orderlens.config import RunConfig
from orderlens.functions import expressions as E

KEYS = ("customer_id", "score_date")
LABELS = ("purchase_within_30d", "next_category", "days_to_next_purchase")
CATEGORICAL_FEATURES = (
    "acquisition_channel",
    "region",
    "lifecycle_segment",
    "last_category",
    "favorite_category",
)
REQUIRED_COLUMNS = (
    "customer_id",
    "order_date",
    "category",
    "order_value",
    "contribution_margin",
    "used_discount",
    "acquisition_channel",
    "region",
)


# Ends of the frames of the running state: nothing after the current day.
_LAST_ROW = Window.currentRow
_LAST_DAY = "CURRENT ROW"


def order_view(transactions: DataFrame) -> DataFrame:
    """Columns the snapshots need, with dates as DATE and an order id for ties.

    Without ``order_id`` a digest of the row decides between orders of one day.
    """
    missing = sorted(set(REQUIRED_COLUMNS) - set(transactions.columns))
    if missing:
        raise ValueError(f"Missing transaction columns: {missing}")
    if "order_id" in transactions.columns:
        order_id = F.col("order_id")
    else:
        order_id = F.sha2(
            F.concat_ws("|", *[F.col(c).cast("string") for c in REQUIRED_COLUMNS]), 256
        )
    return transactions.select(
        order_id.alias("order_id"),
        *[c for c in REQUIRED_COLUMNS if c != "order_date"],
        F.col("order_date").cast("date").alias("order_date"),
    )


def customer_days(orders: DataFrame) -> DataFrame:
    """One row per customer and day, hash-partitioned by customer.

    ``purchases`` holds the day's orders per category, ``last_order`` and
    ``first_order`` the orders with the largest and smallest id of the day.
    """
    per_category = orders.groupBy("customer_id", "order_date", "category").agg(
        F.count(F.lit(1)).alias("orders"),
        F.sum(E.money("order_value")).alias("order_value"),
        F.sum(E.money("contribution_margin")).alias("margin"),
        F.sum(F.col("used_discount").cast("long")).alias("discounted"),
        F.min("order_id").alias("first_id"),
        F.max(
            F.struct(
                "order_id",
                "order_value",
                "contribution_margin",
                "acquisition_channel",
                "region",
            )
        ).alias("last"),
    )
    purchase = F.struct(
        "category", "order_date", "first_id", "orders", "order_value", "margin", "discounted"
    )
    return (
        per_category.repartition("customer_id")
        .groupBy("customer_id", "order_date")
        .agg(
            F.sum("orders").alias("day_orders"),
            F.collect_list(purchase).alias("purchases"),
            F.max(F.struct("last", "category")).alias("last_order"),
            F.min(F.struct("first_id", "category")).alias("first_order"),
        )
    )


def running_state(days: DataFrame) -> DataFrame:
    """Add what is known at the end of each day, and the next order after it.

    ``trailing`` covers every score date up to the next order: the earliest of them is
    the following day, whose trailing year starts 364 days before this one.
    """
    by_day = Window.partitionBy("customer_id").orderBy("order_date")
    so_far = by_day.rowsBetween(Window.unboundedPreceding, _LAST_ROW)
    # A range over a DATE counts days; only SQL accepts whole numbers for it.
    trailing_year = F.expr(
        f"""flatten(collect_list(purchases) OVER (PARTITION BY customer_id ORDER BY order_date
            RANGE BETWEEN {fixed.LONG_WINDOW_DAYS - 1} PRECEDING AND {_LAST_DAY}))"""
    )
    # A day with n orders closes n gaps: one to the previous day, the others of length
    # zero. More than eight zeros per day can never be among the last eight gaps.
    day_gaps = F.expr(
        f"""concat(
            if(previous_date IS NULL, CAST(array() AS array<double>),
                array(CAST(datediff(order_date, previous_date) AS double))),
            array_repeat(0D, CAST(least(day_orders - 1, {fixed.RECENT_GAPS}) AS int)))"""
    )
    last_days = by_day.rowsBetween(1 - fixed.RECENT_GAPS, _LAST_ROW)
    recent = F.flatten(F.collect_list("day_gaps").over(last_days))
    return (
        days.withColumn("previous_date", F.lag("order_date").over(by_day))
        .withColumn("day_gaps", day_gaps)
        .select(
            "customer_id",
            "order_date",
            F.lead("order_date").over(by_day).alias("next_date"),
            F.lead("first_order.category").over(by_day).alias("next_category"),
            F.sum("day_orders").over(so_far).alias("orders_lifetime"),
            F.min("order_date").over(so_far).alias("first_date"),
            recent.alias("recent_gaps"),
            trailing_year.alias("trailing"),
            F.col("last_order.category").alias("last_category"),
            F.col("last_order.last").alias("last"),
            # Lineage: the latest day that each kind of aggregate has read, by its own frame.
            F.max("order_date").over(so_far).alias("state_until"),
            F.max("order_date").over(last_days).alias("gaps_until"),
        )
    )


def _with_gap_stats(states: DataFrame) -> DataFrame:
    """Median and population deviation of the last eight gaps."""
    last_eight = F.when(
        F.size("recent_gaps") > fixed.RECENT_GAPS,
        F.slice("recent_gaps", -fixed.RECENT_GAPS, fixed.RECENT_GAPS),
    ).otherwise(F.col("recent_gaps"))
    gaps = F.col("gaps")
    return (
        states.withColumn("gaps", F.sort_array(last_eight))
        .withColumn(
            "typical_gap",
            F.coalesce(E.median_of_sorted(gaps), F.lit(fixed.DEFAULT_GAP_DAYS)),
        )
        .withColumn(
            "gap_spread", F.coalesce(E.population_spread(gaps), F.lit(fixed.DEFAULT_GAP_SPREAD))
        )
        .drop("gaps", "recent_gaps")
    )


def _last_index(orders: DataFrame, config: RunConfig) -> Column:
    """Last grid index whose full outcome window is covered by the data."""
    covered = (
        F.datediff(F.max("order_date"), F.lit(config.snapshot_start).cast("date"))
        - config.target_horizon_days
    ) / config.snapshot_frequency_days
    data_limit = orders.agg(F.floor(covered).cast("int")).scalar()
    return F.least(F.lit(config.last_grid_index()), data_limit)


def score_date_grid(transactions: DataFrame, config: RunConfig) -> DataFrame:
    """Score dates from start to end whose outcome window lies inside the data."""
    orders = order_view(transactions)
    spark = transactions.sparkSession
    return (
        spark.range(config.last_grid_index() + 1)
        .filter(F.col("id") <= _last_index(orders, config))
        .select(_grid_date(F.col("id"), config).alias("score_date"))
    )


def _grid_date(index: Column, config: RunConfig) -> Column:
    return F.date_add(
        F.lit(config.snapshot_start).cast("date"),
        (index * config.snapshot_frequency_days).cast("int"),
    )


def _grid_snapshots(transactions: DataFrame, config: RunConfig) -> DataFrame:
    """One row per eligible (customer, score date): the state of the last day before it."""
    orders = order_view(transactions)
    states = running_state(customer_days(orders))
    start = F.lit(config.snapshot_start).cast("date")
    step = config.snapshot_frequency_days
    offset = F.datediff("order_date", start)
    first = F.greatest(F.floor(offset / step).cast("int") + 1, F.lit(0))
    last = F.least(
        F.floor((offset + fixed.MAX_RECENCY_DAYS) / step).cast("int"),
        F.coalesce(F.floor(F.datediff("next_date", start) / step).cast("int"), F.lit(2**31 - 1)),
        _last_index(orders, config),
    )
    useful = (
        states.filter(F.col("orders_lifetime") >= config.min_history_orders)
        .withColumn("first_index", first)
        .withColumn("last_index", last)
        .filter("first_index <= last_index")
    )
    return (
        _with_gap_stats(useful)
        .withColumn("index", F.explode(F.sequence("first_index", "last_index")))
        .withColumn("score_date", _grid_date(F.col("index"), config))
    )


def _date_snapshots(transactions: DataFrame, score_date: str, config: RunConfig) -> DataFrame:
    """The same rows at one score date, from strictly earlier orders only."""
    day = F.lit(score_date).cast("date")
    history = order_view(transactions).filter(F.col("order_date") < day)
    latest = (
        running_state(customer_days(history))
        .filter(F.col("next_date").isNull())
        .filter(F.col("orders_lifetime") >= config.min_history_orders)
        .filter(F.col("order_date") >= F.date_sub(day, fixed.MAX_RECENCY_DAYS))
    )
    return _with_gap_stats(latest).withColumn("score_date", day)


def _with_year(rows: DataFrame) -> DataFrame:
    """Add ``year``, the purchases within the trailing year, and their sums ``total``;
    ``bought`` lists each category with its orders, first and last purchase."""
    year = f"filter(trailing, p -> p.order_date >= date_sub(score_date, {fixed.LONG_WINDOW_DAYS}))"
    total = f"""aggregate(year,
        named_struct('orders', 0L, 'mid', 0L, 'short', 0L, 'discounted', 0L, 'weekend', 0L,
            'order_value', CAST(0 AS decimal(38,8)), 'margin', CAST(0 AS decimal(38,8))),
        (t, p) -> named_struct(
            'orders', t.orders + p.orders,
            'mid', t.mid + if(p.order_date >= date_sub(score_date, {fixed.MID_WINDOW_DAYS}),
                p.orders, 0L),
            'short', t.short + if(p.order_date >= date_sub(score_date, {fixed.SHORT_WINDOW_DAYS}),
                p.orders, 0L),
            'discounted', t.discounted + p.discounted,
            'weekend', t.weekend + if(weekday(p.order_date) >= 5, p.orders, 0L),
            'order_value', CAST(t.order_value + p.order_value AS decimal(38,8)),
            'margin', CAST(t.margin + p.margin AS decimal(38,8))))"""
    # ``year`` is ordered by day, so the first match is a category's first purchase.
    bought = """transform(array_distinct(transform(year, p -> p.category)), c -> aggregate(
        filter(year, p -> p.category = c),
        named_struct('negative', 0L, 'first_seen', CAST(NULL AS struct<day: date, id: string>),
            'category', c, 'last_date', CAST(NULL AS date)),
        (b, p) -> named_struct(
            'negative', b.negative - p.orders,
            'first_seen', coalesce(b.first_seen, named_struct('day', p.order_date,
                'id', p.first_id)),
            'category', c,
            'last_date', p.order_date)))"""
    return (
        rows.withColumn("year", F.expr(year))
        .withColumn("total", F.expr(total))
        .withColumn("bought", F.expr(bought))
    )


def category_features(transactions: DataFrame, config: RunConfig) -> DataFrame:
    """Long form on the grid: orders, share and recency of each category bought."""
    return (
        _with_year(_grid_snapshots(transactions, config))
        .select(*KEYS, "total", F.explode("bought").alias("bought"))
        .select(
            *KEYS,
            F.col("bought.category").alias("category"),
            (-F.col("bought.negative")).alias("category_orders_365d"),
            (-F.col("bought.negative") / F.col("total.orders")).alias("category_share_365d"),
            F.datediff("score_date", "bought.last_date").alias("category_recency_days"),
        )
    )


def _features(snapshots: DataFrame, config: RunConfig, *others: Column) -> DataFrame:
    """Every feature of each snapshot row, followed by ``others``."""
    prepared = (
        _with_year(snapshots)
        .withColumn("favourite", F.array_min("bought"))
        # Materialised by ``transform``: a plain field access would be inlined into every search.
        .withColumn("names", F.transform("bought", lambda entry: entry["category"]))
        .withColumns(
            {
                f"_place_{at}": F.array_position("names", F.lit(name)).cast("int")
                for at, name in enumerate(config.categories)
            }
        )
        .withColumn("recency_days", F.datediff("score_date", "order_date"))
        .withColumn("tenure_days", F.datediff("score_date", "first_date"))
    )
    recency, gap = F.col("recency_days"), F.col("typical_gap")
    orders, mid = F.col("total.orders"), F.col("total.mid")
    columns: list[Column] = [
        F.col("customer_id"),
        F.col("score_date"),
        F.col("last.acquisition_channel"),
        F.col("last.region"),
        E.lifecycle_segment(
            F.col("tenure_days"), F.col("orders_lifetime"), mid, recency, gap
        ).alias("lifecycle_segment"),
        F.col("last_category"),
        F.col("favourite.category").alias("favorite_category"),
        F.col("tenure_days").alias("customer_tenure_days"),
        recency,
        F.col("orders_lifetime"),
        orders.alias("orders_365d"),
        mid.alias("orders_90d"),
        F.col("total.short").alias("orders_30d"),
        E.order_momentum(mid, orders).alias("order_momentum"),
        F.expr("CAST(total.order_value AS double) / total.orders AS average_order_value_365d"),
        F.expr("CAST(total.margin AS double) AS total_margin_365d"),
        F.expr("total.discounted / total.orders AS discount_share_365d"),
        F.expr("total.weekend / total.orders AS weekend_share_365d"),
        F.expr("CAST(size(bought) AS long) AS category_diversity_365d"),
        F.expr("-favourite.negative / total.orders AS favorite_category_share_365d"),
        gap.alias("average_gap_days"),
        F.col("gap_spread").alias("gap_variability_days"),
        E.cadence_progress(recency, gap).alias("cadence_progress"),
        F.col("last.order_value").alias("last_order_value"),
        F.col("last.contribution_margin").alias("last_order_margin"),
        F.month("score_date").alias("score_month"),
        F.quarter("score_date").alias("score_quarter"),
    ]
    for at, name in enumerate(config.categories):
        key = name.lower()
        # Place 0, a category not bought, is no index of ``get`` and gives NULL.
        entry = f"get(bought, _place_{at} - 1)"
        bought = f"coalesce(-{entry}.negative, 0L)"
        columns += [
            F.expr(bought).alias(f"{key}_orders_365d"),
            F.expr(f"{bought} / total.orders").alias(f"{key}_share_365d"),
            F.expr(
                f"coalesce(datediff(score_date, {entry}.last_date), "
                f"{fixed.ABSENT_CATEGORY_RECENCY})"
            ).alias(f"{key}_recency_days"),
        ]
    return prepared.select(*columns, *others)


def _labels(config: RunConfig) -> list[Column]:
    days = F.datediff("next_date", "score_date")
    observed = F.coalesce(days <= config.target_horizon_days, F.lit(False))
    return [
        F.coalesce(days <= config.readiness_horizon_days, F.lit(False))
        .cast("int")
        .alias("purchase_within_30d"),
        F.when(observed, F.col("next_category")).alias("next_category"),
        F.when(observed, days).alias("days_to_next_purchase"),
    ]


def labeled_snapshots(transactions: DataFrame, config: RunConfig) -> DataFrame:
    """Features strictly before, labels from each score date of the grid on."""
    return _features(_grid_snapshots(transactions, config), config, *_labels(config))


def leakage_by_date(transactions: DataFrame, config: RunConfig) -> DataFrame:
    """Every row of the labeled grid audited by lineage, one result row per score date.

    The running state, the last gaps and the purchases of the year each carry the days they have
    read; the label side carries the day of the next order. A breach is a feature that has read the
    score date or later, a purchase older than the year, or a label from before the score date.
    """
    year_days = F.transform("year", lambda purchase: purchase["order_date"])
    rows = _with_year(_grid_snapshots(transactions, config)).select(
        "score_date",
        "state_until",
        "gaps_until",
        F.array_max(F.transform("trailing", lambda purchase: purchase["order_date"])).alias(
            "year_until"
        ),
        F.array_min(year_days).alias("year_from"),
        "next_date",
    )
    day = F.col("score_date")
    oldest = F.date_sub(day, fixed.LONG_WINDOW_DAYS)
    return rows.groupBy("score_date").agg(
        F.count(F.lit(1)).alias("snapshots"),
        F.max(F.greatest("state_until", "gaps_until", "year_until")).alias("latest_read"),
        F.min("year_from").alias("earliest_in_year"),
        F.count_if(F.col("state_until") >= day).alias("state_breaches"),
        F.count_if(F.col("gaps_until") >= day).alias("gap_breaches"),
        F.count_if((F.col("year_until") >= day) | (F.col("year_from") < oldest)).alias(
            "year_breaches"
        ),
        F.count_if(F.col("next_date") < day).alias("label_breaches"),
    )


def scoring_snapshot(transactions: DataFrame, score_date: str, config: RunConfig) -> DataFrame:
    """One unlabeled row per customer that is eligible at ``score_date``."""
    return _features(_date_snapshots(transactions, score_date, config), config)


def feature_columns(snapshots: DataFrame) -> list[str]:
    return [c for c in snapshots.columns if c not in KEYS + LABELS]


def require_rows(frame: DataFrame, message: str) -> DataFrame:
    if frame.isEmpty():
        raise RuntimeError(message)
    return frame
