"""Customer, sales and event analytics.

All operators are lazy DataFrame -> DataFrame functions.  Column names and
thresholds are parameters; the documented literals are the defaults.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.time import days_between, duration_micros, epoch_micros, month_start, to_day
from ..plans.ranking import global_positions, ntile_expr
from ..plans.segments import DEFAULT_ROWS_PER_SEGMENT, seg_lag, seg_running_sum, segment, unsegment
from ..session import materialize
from ._util import ranked_values


def _cols(cols: str | Sequence[str] | None) -> list[str]:
    if cols is None:
        return []
    return [cols] if isinstance(cols, str) else list(cols)


# ---------------------------------------------------------------- A01
def burst_events(df: DataFrame, user: str, ts: str, window="1 minute", min_count: int = 5,
                 count_col: str = "events_in_window", bucket=None,
                 rows_per_segment: int = DEFAULT_ROWS_PER_SEGMENT) -> DataFrame:
    """Rows whose user has >= ``min_count`` events in the trailing ``window``
    (inclusive at both ends, equal timestamps count each other).

    Scale: users with more than ``rows_per_segment`` rows (decided by one
    aggregate job; at most rows / rows_per_segment such users) are counted by
    differences of prefix positions: their distinct instants, with row counts,
    and their window starts are sorted together in segments (plans.segments),
    the running count at an instant less the one before its window start is
    the count, and rows meet it by (user, instant).  So neither a hot user nor
    a burst denser than any bucket is one task.  Other users have the plain
    RANGE window.  An explicit ``bucket`` width instead splits every user into
    time buckets, each with the last ``window`` of the one before as context."""
    w = duration_micros(window)
    base = df.withColumn("_tk_t", epoch_micros(df, ts))
    if bucket is None:
        plain = Window.partitionBy(user).orderBy("_tk_t").rangeBetween(-w, Window.currentRow)
        hot = base.groupBy(user).agg(F.count(F.lit(1)).alias("_tk_n")).filter(F.col("_tk_n") > rows_per_segment)
        hot = hot.select(F.col(user).alias("_tk_u"))
        if hot.isEmpty():
            counted = base.withColumn(count_col, F.count(F.lit(1)).over(plain))
        else:
            hot = materialize(hot, "hot-users")
            same = base[user].eqNullSafe(hot["_tk_u"])
            counted = (base.join(hot, same, "left_anti").withColumn(count_col, F.count(F.lit(1)).over(plain))
                       .unionByName(_counts_by_prefix(base.join(hot, same, "left_semi"), user, w, count_col, rows_per_segment)))
        return counted.filter(F.col(count_col) >= min_count).drop("_tk_t")
    b = duration_micros(bucket)
    if b < w:
        raise ValueError("bucket must be >= window")
    bucket_id = ((F.col("_tk_t") - F.pmod(F.col("_tk_t"), F.lit(b))) / b).cast("long")
    keyed = base.withColumn("_tk_b", bucket_id)
    own = keyed.withColumn("_tk_own", F.lit(True))
    ctx = (keyed.filter(F.col("_tk_t") >= (F.col("_tk_b") + 1) * F.lit(b) - F.lit(w))
                .withColumn("_tk_b", F.col("_tk_b") + 1)
                .withColumn("_tk_own", F.lit(False)))
    frame = (Window.partitionBy(user, "_tk_b").orderBy("_tk_t")
             .rangeBetween(-w, Window.currentRow))
    counted = own.unionByName(ctx).withColumn(count_col, F.count(F.lit(1)).over(frame))
    return (counted.filter(F.col("_tk_own") & (F.col(count_col) >= min_count))
            .drop("_tk_t", "_tk_b", "_tk_own"))


def _counts_by_prefix(rows: DataFrame, user: str, w: int, count_col: str, rows_per_segment: int) -> DataFrame:
    """``rows`` (with ``_tk_t``) plus the rows of their user in [t - w, t]; rows
    without a time count each other, as in a RANGE frame."""
    instants = materialize(rows.groupBy(F.col(user).alias("_tk_u"), F.col("_tk_t").alias("_tk_at"))
                           .agg(F.count(F.lit(1)).alias("_tk_n")), "instants")
    timed = instants.filter(F.col("_tk_at").isNotNull())
    # at one place in time a window start comes before the rows there
    places = (timed.select("_tk_u", "_tk_at", F.col("_tk_at").alias("_tk_p"), F.lit(1).alias("_tk_kind"), "_tk_n")
              .unionByName(timed.select("_tk_u", "_tk_at", (F.col("_tk_at") - w).alias("_tk_p"), F.lit(0).alias("_tk_kind"),
                                        F.lit(0).cast("long").alias("_tk_n"))))
    seg = segment(places, ["_tk_u"], F.col("_tk_p"), rows_per_segment, ["_tk_kind", "_tk_at"])
    run = unsegment(seg_running_sum(seg, ["_tk_u"], ["_tk_t", "_tk_kind", "_tk_at"], "_tk_n", "_tk_run"), ["_tk_u"])
    counts = (run.groupBy("_tk_u", "_tk_at")
              .agg(F.sum(F.when(F.col("_tk_kind") == 1, F.col("_tk_run")).otherwise(-F.col("_tk_run"))).alias(count_col))
              .unionByName(instants.filter(F.col("_tk_at").isNull()).select("_tk_u", "_tk_at", F.col("_tk_n").alias(count_col))))
    counts = counts.withColumnRenamed(count_col, "_tk_count")
    return (rows.join(counts, rows[user].eqNullSafe(counts["_tk_u"]) & rows["_tk_t"].eqNullSafe(counts["_tk_at"]))
            .withColumn(count_col, F.col("_tk_count")).drop("_tk_u", "_tk_at", "_tk_count"))


# ---------------------------------------------------------------- A02
DEFAULT_TIER_LABELS = ("High Value", "Medium Value", "Low Value")


def customer_tiers(df: DataFrame, customer: str, amount: str,
                   labels: Sequence[str] = DEFAULT_TIER_LABELS,
                   revenue_col: str = "total_revenue", segment_col: str = "customer_segment",
                   round_to: int | None = 2, num_partitions: int | None = None) -> DataFrame:
    """Total revenue per customer cut into ``len(labels)`` equal-count tiers
    (SQL NTILE over revenue descending, customer ascending as tie-break).

    The global NTILE is computed from distributed positions (plans.ranking),
    not a single-task window."""
    total = F.sum(amount)
    if round_to is not None:
        total = F.round(total, round_to)
    rev = df.groupBy(customer).agg(total.alias(revenue_col))
    k = len(labels)
    ranked = global_positions(rev, [F.col(revenue_col).desc_nulls_last(), F.col(customer).asc()],
                              pos_col="_tk_pos", total_col="_tk_n", num_partitions=num_partitions)
    tile = ntile_expr(F.col("_tk_pos"), F.col("_tk_n"), k)
    seg = F.lit(labels[-1])
    for i in range(k - 2, -1, -1):
        seg = F.when(tile == i + 1, F.lit(labels[i])).otherwise(seg)
    return ranked.select(customer, revenue_col, seg.alias(segment_col))


# ---------------------------------------------------------------- A03
def first_purchase(df: DataFrame, customer: str, ts: str,
                   tie_break: Sequence[str] = ()) -> DataFrame:
    """Earliest order row per customer.  ``row_number() = 1`` is planned as a
    partial (map-side) + final WindowGroupLimit, so a hot customer is cut to
    one row per input partition before the shuffle."""
    w = Window.partitionBy(customer).orderBy(F.col(ts).asc_nulls_last(), *_cols(tie_break))
    return (df.withColumn("_tk_rn", F.row_number().over(w))
              .filter(F.col("_tk_rn") == 1).drop("_tk_rn"))


# ---------------------------------------------------------------- A04
def outliers_sigma(df: DataFrame, user: str, amount: str, k: float = 3.0,
                   avg_col: str = "avg_amount", std_col: str = "std_amount",
                   round_stats: int | None = 6) -> DataFrame:
    """Rows whose amount exceeds the user's mean + k sample standard
    deviations (strict).  Users with one row have NULL deviation and drop out.

    The statistics are a partially aggregated groupBy (a hot user collapses
    map-side) joined back on the user; AQE's skew join splits a hot user's
    rows on the probe side."""
    stats = df.groupBy(user).agg(F.avg(amount).alias("_tk_avg"),
                                 F.stddev_samp(amount).alias("_tk_std"))
    out = (df.join(stats, user)
             .filter(F.col(amount) > F.col("_tk_avg") + F.lit(k) * F.col("_tk_std")))
    a, s = F.col("_tk_avg"), F.col("_tk_std")
    if round_stats is not None:
        a, s = F.round(a, round_stats), F.round(s, round_stats)
    return out.withColumn(avg_col, a).withColumn(std_col, s).drop("_tk_avg", "_tk_std")


# ---------------------------------------------------------------- A05
def purchase_funnel(stages: Sequence[tuple[str, DataFrame, str]],
                    rate_suffix: str = "_rate") -> DataFrame:
    """Distinct users per stage and the conversion rate between consecutive
    stages, as one row.  ``stages`` = [(name, df, user_col), ...].

    One union of (stage, user) pairs, one distinct (partial, so hot users
    collapse map-side) and one global aggregate: no cross join.  A stage
    with zero users gives a NULL rate."""
    if not stages:
        raise ValueError("at least one stage")
    parts = [sdf.select(F.lit(i).alias("_tk_stage"), F.col(ucol).alias("_tk_user"))
             for i, (_, sdf, ucol) in enumerate(stages)]
    u = parts[0]
    for p in parts[1:]:
        u = u.unionByName(p)
    u = u.filter(F.col("_tk_user").isNotNull()).distinct()
    counts = [F.count_if(F.col("_tk_stage") == i).alias(f"total_{name}")
              for i, (name, _, _) in enumerate(stages)]
    out = u.agg(*counts)
    names = [name for name, _, _ in stages]
    rates = [F.try_divide(F.col(f"total_{b}").cast("double"), F.col(f"total_{a}").cast("double"))
             .alias(f"{a}_to_{b}{rate_suffix}") for a, b in zip(names, names[1:])]
    return out.select("*", *rates)


# ---------------------------------------------------------------- A06
def inactive_customers(customers: DataFrame, orders: DataFrame, as_of: str,
                       customer: str = "customer_id", order_customer: str | None = None,
                       order_ts: str = "order_date", days: int = 90) -> DataFrame:
    """Customers whose last order is more than ``days`` before ``as_of``,
    with the day count, longest first.  Customers without orders never
    appear (inner join)."""
    oc = order_customer or customer
    last = orders.groupBy(F.col(oc).alias(customer)).agg(F.max(order_ts).alias("last_order"))
    gap = days_between(F.lit(as_of).cast("date"), F.col("last_order"))
    return (customers.select(customer).join(last, customer)
            .withColumn("days_inactive", gap)
            .filter(F.col("days_inactive") > days)
            .orderBy(F.col("days_inactive").desc(), F.col(customer)))


# ---------------------------------------------------------------- A08
ROWS_PER_TASK = 1_000_000  # lines, or pairs, that one task of A08 joins or counts


def _spread(df: DataFrame, rows: int, *keys: str) -> DataFrame:
    """``df`` by ``keys`` in tasks of about ``ROWS_PER_TASK`` of its ``rows``, if
    the session's number of shuffle partitions is too few for that."""
    n = -(-rows // ROWS_PER_TASK)
    return df.repartition(n, *keys) if n > int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")) else df


def market_basket_pairs(items: DataFrame, order: str, product: str, max_rank: int = 10,
                        distinct_lines: bool = False, block_size: int = 2000) -> DataFrame:
    """Unordered product pairs bought in the same order, counted, and the
    pairs ranked <= ``max_rank`` by count (RANK keeps ties).

    Exact pruning instead of enumerating every pair of every basket:
      1. lines collapse to (order, product, multiplicity m);
      2. count(a, b) = sum_o m_a * m_b, at most the sum over a's baskets of
         m_a times the basket's largest multiplicity;
      3. a lower bound T of the ``max_rank``-th best count comes from exact
         counts of pairs among the most frequent products;
      4. only products whose bound reaches T can be in the answer, so pairs
         are enumerated among those alone.
    Hot baskets: an order with more than ``block_size`` candidate products
    has its products hashed into g blocks and its self-join runs as g*g tasks
    of (order, block_i, block_j), so no task holds a hot basket's pairs
    whole.  Ranks are taken over the distinct counts, so ties stay spread.
    The number of tasks grows with the lines and with the pairs, so a task's
    memory does not.  Many pairs then meet without a count before the shuffle;
    those of the most frequent products, the only ones that could crowd one
    task, are taken from step 3."""
    lines = items.select(F.col(order).alias("_tk_o"), F.col(product).alias("_tk_p")) \
                 .filter(F.col("_tk_o").isNotNull() & F.col("_tk_p").isNotNull())
    lines = _spread(lines, lines.count(), "_tk_o", "_tk_p")
    if distinct_lines:
        per = lines.distinct().withColumn("_tk_m", F.lit(1).cast("long"))
    else:
        per = lines.groupBy("_tk_o", "_tk_p").agg(F.count(F.lit(1)).alias("_tk_m"))

    # read several times below (bounds, pairs): written once as Parquet in the
    # shared folder so the item table is scanned and aggregated a single time
    per = materialize(per, "basket_lines")
    bounded = per
    n_lines, most = per.agg(F.count(F.lit(1)), F.max("_tk_m")).first()
    if (most or 1) > 1:
        by_order = _spread(per, n_lines, "_tk_o")
        largest = by_order.groupBy("_tk_o").agg(F.max("_tk_m").alias("_tk_mx")).filter("_tk_mx > 1")
        bounded = by_order.join(largest, "_tk_o", "left").withColumn("_tk_m", F.col("_tk_m") * F.coalesce("_tk_mx", F.lit(1)))
    totals = materialize(bounded.groupBy("_tk_p").agg(F.sum("_tk_m").alias("_tk_tot")), "basket_totals")

    def self_join_on(left: DataFrame, right: DataFrame, keys: list[str], n_rows: int, n_pairs: int = 0) -> DataFrame:
        a = left.select(*keys, F.col("_tk_p").alias("product_a"), F.col("_tk_m").alias("_tk_ma"))
        b = right.select(*keys, F.col("_tk_p").alias("product_b"), F.col("_tk_m").alias("_tk_mb"))
        met = (_spread(a, n_rows, *keys).join(_spread(b, n_rows, *keys), keys).filter(F.col("product_a") < F.col("product_b"))
               .select("product_a", "product_b", (F.col("_tk_ma") * F.col("_tk_mb")).alias("pair_count")))
        spread = _spread(met, n_pairs, "product_a", "product_b")
        if spread is met:
            return met.groupBy("product_a", "product_b").agg(F.sum("pair_count").alias("pair_count"))
        # no count before this shuffle: pairs of two seed products, already counted, stay out of it
        for c in ("product_a", "product_b"):
            met = met.join(F.broadcast(seed_products.select(F.col("_tk_p").alias(c), F.lit(True).alias(f"_tk_{c}"))), c, "left")
        met = met.filter(F.col("_tk_product_a").isNull() | F.col("_tk_product_b").isNull()).select("product_a", "product_b", "pair_count")
        return (_spread(met, n_pairs, "product_a", "product_b").groupBy("product_a", "product_b")
                .agg(F.sum("pair_count").alias("pair_count")).unionByName(seed_counts))

    def grid_pairs(sub: DataFrame) -> DataFrame:
        sizes = sub.groupBy("_tk_o").agg(F.count(F.lit(1)).alias("_tk_n"))
        hot = (sizes.filter(F.col("_tk_n") > block_size)
                    .select("_tk_o", F.ceil(F.col("_tk_n") / F.lit(block_size)).cast("int").alias("_tk_g")))
        n = F.col("_tk_n")
        n_copies, n_pairs, largest = sizes.agg(F.sum(n * F.ceil(n / F.lit(block_size))), F.sum(F.expr("_tk_n * (_tk_n - 1) div 2")), F.max(n)).first()
        if (largest or 0) <= block_size:
            return self_join_on(sub, sub, ["_tk_o"], n_copies or 0, n_pairs or 0)
        blk = (sub.join(hot, "_tk_o", "left")
                  .withColumn("_tk_g", F.coalesce(F.col("_tk_g"), F.lit(1)))
                  .withColumn("_tk_blk", F.pmod(F.xxhash64("_tk_p"), F.col("_tk_g")).cast("int")))
        fan = F.explode(F.sequence(F.lit(0), F.col("_tk_g") - 1))
        # left copy of block i meets every block j, right copy of block j
        # meets every block i: each (order, i, j) cell is one join group
        a = blk.select("_tk_o", "_tk_p", "_tk_m", F.col("_tk_blk").alias("_tk_i"), fan.alias("_tk_j"))
        b = blk.select("_tk_o", "_tk_p", "_tk_m", F.col("_tk_blk").alias("_tk_j"), fan.alias("_tk_i"))
        return self_join_on(a, b, ["_tk_o", "_tk_i", "_tk_j"], n_copies, n_pairs)

    # lower bound from the most frequent products: at most seed_n products per
    # basket, so this self-join is bounded per order and needs no grid
    seed_n = max(4 * max_rank, 64)
    seed_products = materialize(totals.orderBy(F.col("_tk_tot").desc(), F.col("_tk_p")).limit(seed_n), "basket_seeds")
    # at most seed_n rows
    seed_lines = per.join(F.broadcast(seed_products.select("_tk_p")), "_tk_p")
    seed_counts = materialize(self_join_on(seed_lines, seed_lines, ["_tk_o"], n_lines), "basket_seed_counts")
    kth = (seed_counts.select("pair_count").orderBy(F.col("pair_count").desc())
           .offset(max_rank - 1).limit(1).first())
    threshold = kth[0] if kth is not None else 0
    # the bound is a plain number now: the candidate filter is a literal
    # predicate and the plan below carries no subquery
    keep = totals.filter(F.col("_tk_tot") >= F.lit(threshold)).select("_tk_p")
    pairs = grid_pairs(per.join(keep, "_tk_p", "left_semi")).filter(F.col("pair_count") >= F.lit(threshold))
    # distinct counts with their number of pairs; RANK <= max_rank lies within the max_rank highest
    counts = pairs.groupBy("pair_count").agg(F.count(F.lit(1)).alias("_tk_c"))
    top = counts.orderBy(F.col("pair_count").desc()).limit(max_rank)
    before = Window.orderBy(F.col("pair_count").desc()).rowsBetween(Window.unboundedPreceding, -1)
    ranks = (top.select("pair_count", (F.coalesce(F.sum("_tk_c").over(before), F.lit(0)) + 1).cast("int").alias("rank"))
                .filter(F.col("rank") <= max_rank))
    # at most max_rank rows
    return pairs.join(F.broadcast(ranks), "pair_count").select("product_a", "product_b", "pair_count", "rank")


# ---------------------------------------------------------------- A09
def monthly_revenue_growth(df: DataFrame, ts: str, amount: str, round_to: int | None = 2) -> DataFrame:
    """Revenue per calendar month, the previous month present, and growth %
    to 2 decimals (NULL for the first month or a zero previous month).

    The lag runs after the aggregate, over one row per month."""
    rev = F.sum(amount)
    if round_to is not None:
        rev = F.round(rev, round_to)
    monthly = df.groupBy(month_start(ts).alias("month")).agg(rev.alias("revenue"))
    w = Window.orderBy(F.col("month").asc_nulls_last())
    prev = F.lag("revenue").over(w)
    growth = F.round(F.try_divide(F.col("revenue") - F.col("previous_month"),
                                  F.col("previous_month")) * 100, 2)
    return (monthly.withColumn("previous_month", prev)
                   .withColumn("growth_percent", growth))


# ---------------------------------------------------------------- A10
def churn_risk(orders: DataFrame, customer: str, ts: str, as_of: str,
               factor: float = 2.0) -> DataFrame:
    """Customers whose days since the last order exceed ``factor`` times
    their average gap between consecutive orders.

    The average of consecutive gaps telescopes to (last - first) / (n - 1),
    so this is a single partially aggregated groupBy: no window, no join,
    and a hot customer collapses map-side.  One-order customers drop out."""
    day = to_day(ts)
    agg = orders.groupBy(customer).agg(F.min(day).alias("_tk_first"),
                                       F.max(day).alias("_tk_last"),
                                       F.count(day).alias("_tk_n"))
    avg_gap = (F.datediff("_tk_last", "_tk_first").cast("double") / (F.col("_tk_n") - 1))
    since = F.datediff(F.lit(as_of).cast("date"), F.col("_tk_last"))
    return (agg.filter(F.col("_tk_n") > 1)
               .select(customer, avg_gap.alias("avg_gap"), since.alias("days_since_last_order"))
               .filter(F.col("days_since_last_order") > F.col("avg_gap") * F.lit(factor)))


# ---------------------------------------------------------------- A11
def activity_streaks(df: DataFrame, user: str, day: str, min_len: int = 5) -> DataFrame:
    """Runs of >= ``min_len`` consecutive active days per user (gaps and
    islands).  Activity is first reduced to distinct (user, day): per-user
    rows are then bounded by the number of calendar days, whatever the event
    volume of a hot user."""
    days = df.select(F.col(user), to_day(day).alias("_tk_d")).filter(F.col("_tk_d").isNotNull()).distinct()
    w = Window.partitionBy(user).orderBy(F.col("_tk_d").asc_nulls_last())
    islands = days.withColumn("_tk_g", F.date_sub(F.col("_tk_d"), F.row_number().over(w)))
    return (islands.groupBy(user, "_tk_g")
                   .agg(F.min("_tk_d").alias("start_streak"), F.max("_tk_d").alias("end_streak"),
                        F.count(F.lit(1)).alias("streak_length"))
                   .filter(F.col("streak_length") >= min_len)
                   .drop("_tk_g"))


# ---------------------------------------------------------------- A17
def time_between_purchases(df: DataFrame, user: str, day: str, tie_break: Sequence[str] = (),
                           rows_per_segment: int = DEFAULT_ROWS_PER_SEGMENT) -> DataFrame:
    """Previous purchase and whole days since it, per row.  A user with more
    than ``rows_per_segment`` rows is split into time segments
    (plans.segments), so no task holds a hot user whole."""
    seg = segment(df, [user], epoch_micros(df, day), rows_per_segment, _cols(tie_break))
    out = seg_lag(seg, [user], ["_tk_t", *_cols(tie_break)], day, "previous_purchase")
    return unsegment(out.withColumn("days_between", days_between(F.col(day), F.col("previous_purchase"))),
                     [user])


# ---------------------------------------------------------------- A18
def top_n_dense_rank(df: DataFrame, group: str | Sequence[str], measure: str, n: int = 3,
                     rank_col: str = "rank") -> DataFrame:
    """Rows whose measure is among the ``n`` highest distinct values of their
    group (ties kept, however many)."""
    return ranked_values(df, _cols(group), measure, n, rank_col, dense=True)


# ---------------------------------------------------------------- A19
def top_products_by_category(items: DataFrame, products: DataFrame, product: str = "product_id",
                             category: str = "category", quantity: str = "quantity",
                             item_product: str | None = None, n: int = 3) -> DataFrame:
    """Total quantity per product within its category, rank <= ``n``.

    Items are aggregated per product *before* the join, so the join sees one
    row per product instead of one per line.  No broadcast hint: the product
    table grows with the data, so AQE picks broadcast only from the measured
    size of the aggregated side at run time."""
    ip = item_product or product
    sold = items.groupBy(F.col(ip).alias(product)).agg(F.sum(quantity).alias("total_sold"))
    joined = sold.join(products.select(product, category), product).select(category, product, "total_sold")
    return ranked_values(joined, [category], "total_sold", n, "rank_in_category", dense=False)


# ---------------------------------------------------------------- A20
def top_customers_per_month(orders: DataFrame, customer: str = "customer_id",
                            ts: str = "order_date", amount: str = "amount", n: int = 5,
                            round_to: int | None = 2) -> DataFrame:
    """Spend per customer and month, RANK <= ``n`` within the month, ordered
    by month and rank."""
    spent = F.sum(amount)
    if round_to is not None:
        spent = F.round(spent, round_to)
    monthly = (orders.groupBy(month_start(ts).alias("month"), F.col(customer))
                     .agg(spent.alias("total_spent")))
    return ranked_values(monthly, ["month"], "total_spent", n, "rank", dense=False).orderBy("month", "rank", customer)


# ---------------------------------------------------------------- A21
def sessionize(df: DataFrame, user: str, ts: str, gap="30 minutes",
               tie_break: Sequence[str] = (),
               rows_per_segment: int = DEFAULT_ROWS_PER_SEGMENT) -> DataFrame:
    """Session number per event: a gap strictly greater than ``gap`` opens a
    new session; ids restart at 1 per user.  Adds prev_event, new_session,
    session_id.  Hot users are split into time segments; the previous event
    and the session count of earlier segments cross the borders through
    per-segment summaries (plans.segments), so the result is exact."""
    g = duration_micros(gap)
    order = ["_tk_t", *_cols(tie_break)]
    seg = segment(df, [user], epoch_micros(df, ts), rows_per_segment, _cols(tie_break))
    seg = seg.withColumn("_tk_cur", F.struct(F.col(ts).alias("ts"), F.col("_tk_t").alias("t")))
    lagged = seg_lag(seg, [user], order, "_tk_cur", "_tk_prev")
    flagged = (lagged.withColumn("prev_event", F.col("_tk_prev.ts"))
                     .withColumn("new_session",
                                 F.when(F.col("_tk_prev").isNull(), 1)
                                  .when(F.col("_tk_t") - F.col("_tk_prev.t") > g, 1).otherwise(0)))
    out = seg_running_sum(flagged, [user], order, "new_session", "session_id")
    return unsegment(out.drop("_tk_cur", "_tk_prev"), [user])
