"""Experiment assignment and readout, and daily business metrics.

Assignment is a stable hash of (experiment, user): the same user always lands
in the same cell, on any engine, without storing an assignment table.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cairn.functions.hashing import md5_bucket


def assign_cells(users: DataFrame, experiment: str, *, user: str = "user_id",
                 cells: Sequence[tuple[str, int]] = (("control", 50), ("test", 50))) -> DataFrame:
    """``bucket`` in 0..99 from md5(experiment:user); cells take consecutive bucket ranges by weight."""
    if sum(w for _, w in cells) != 100:
        raise ValueError("cell weights must add up to 100")
    b = md5_bucket(F.col(user), 100, salt=f"{experiment}:")
    expr, upper = None, 0
    for name, w in cells:
        upper += w
        expr = F.when(b < upper, name) if expr is None else expr.when(b < upper, name)
    return users.select(user, b.alias("bucket"), expr.alias("cell"))


def readout(assigned: DataFrame, converted: DataFrame, experiment: str, *, user: str = "user_id",
            control: str = "control") -> DataFrame:
    """Per cell: users, conversions, rate, lift over control and the pooled two-proportion z score."""
    a = assigned.join(converted.select(user, F.lit(1).alias("_c")), user, "left")
    per = a.groupBy("cell").agg(F.count(F.lit(1)).alias("users"),
                                F.coalesce(F.sum("_c"), F.lit(0)).cast("bigint").alias("conversions"))
    per = per.withColumn("experiment", F.lit(experiment))
    ctl = per.where(F.col("cell") == control).select("experiment", F.col("users").alias("_nc"),
                                                     F.col("conversions").alias("_xc"))
    j = per.join(ctl, "experiment", "left")
    rate = F.col("conversions") / F.col("users")
    crate = F.col("_xc") / F.col("_nc")
    pooled = (F.col("conversions") + F.col("_xc")) / (F.col("users") + F.col("_nc"))
    se = F.sqrt(pooled * (1 - pooled) * (1 / F.col("users") + 1 / F.col("_nc")))
    z = F.when(F.col("cell") == control, F.lit(0.0)).when(se > 0, (rate - crate) / se).otherwise(F.lit(0.0))
    lift = F.when(crate > 0, rate / crate - 1)
    return j.select("experiment", "cell", "users", "conversions", F.round(rate, 6).alias("conversion_rate"),
                    F.round(lift, 6).alias("lift"), F.round(z, 6).alias("z_score"))


def daily_business_metrics(orders: DataFrame) -> DataFrame:
    """Per day: orders, revenue (cents), active and new customers.

    ``orders``: order_id, customer_id, order_date, net_cents. New customers are
    those whose first order falls on the day (one partial aggregate per customer).
    """
    daily = orders.groupBy("order_date").agg(F.count(F.lit(1)).alias("orders"),
                                             F.sum("net_cents").cast("bigint").alias("revenue_cents"),
                                             F.count_distinct("customer_id").alias("active_customers"))
    first = orders.groupBy("customer_id").agg(F.min("order_date").alias("order_date")) \
        .groupBy("order_date").agg(F.count(F.lit(1)).alias("new_customers"))
    return daily.join(first, "order_date", "left").select(
        "order_date", "orders", "revenue_cents", "active_customers",
        F.coalesce("new_customers", F.lit(0)).cast("bigint").alias("new_customers"))


def daily_engagement(events: DataFrame, *, user: str = "user_id", ts: str = "event_time") -> DataFrame:
    """Per day: active users, events and events per active user (the engagement table)."""
    e = events.where(F.col(user).isNotNull())
    daily = e.groupBy(F.to_date(ts).alias("activity_date")).agg(
        F.count_distinct(user).alias("active_users"), F.count(F.lit(1)).alias("events"))
    return daily.withColumn("events_per_user", F.col("events") / F.col("active_users"))


def monthly_business_metrics(orders: DataFrame) -> DataFrame:
    """Per month: orders, revenue (cents), distinct active customers and new customers
    (aggregate reporting; customers are counted distinct over the month, not summed per day)."""
    o = orders.withColumn("month", F.trunc("order_date", "month"))
    monthly = o.groupBy("month").agg(F.count(F.lit(1)).alias("orders"),
                                     F.sum("net_cents").cast("bigint").alias("revenue_cents"),
                                     F.count_distinct("customer_id").alias("active_customers"))
    first = (orders.groupBy("customer_id").agg(F.trunc(F.min("order_date"), "month").alias("month"))
             .groupBy("month").agg(F.count(F.lit(1)).alias("new_customers")))
    return monthly.join(first, "month", "left").select(
        "month", "orders", "revenue_cents", "active_customers",
        F.coalesce("new_customers", F.lit(0)).cast("bigint").alias("new_customers"))


# ------------------------------------------------------------ leading and lagging metrics ---

def cell_moments(assigned: DataFrame, per_user: DataFrame, metrics: Sequence[tuple[str, str, str, str | None]], *,
                 user: str = "user_id") -> DataFrame:
    """Per (metric, cell): users and the sums that means, variances and covariances follow from.

    ``metrics``: (name, kind, numerator, denominator) over integer columns of ``per_user``; without a
    denominator the metric is a mean per user. Users without a row count as zeros. Sums of parts
    (days, shards) add up, so moments can be kept and merged.
    """
    j = assigned.select(user, "cell").join(per_user, user, "left")
    sides = []
    for name, kind, num, den in metrics:
        x = F.coalesce(F.col(num), F.lit(0)).cast("bigint")
        y = F.lit(1).cast("bigint") if den is None else F.coalesce(F.col(den), F.lit(0)).cast("bigint")
        sides.append(F.struct(F.lit(name).alias("metric"), F.lit(kind).alias("kind"), F.lit(den is not None).alias("ratio"),
                              x.alias("x"), y.alias("y")))
    rows = j.select("cell", F.explode(F.array(*sides)).alias("m")).select("cell", "m.*")
    x, y = F.col("x"), F.col("y")
    sums = {"sx": x, "sy": y, "sxx": x * x, "syy": y * y, "sxy": x * y}
    return rows.groupBy("metric", "kind", "ratio", "cell").agg(
        F.count(F.lit(1)).alias("users"), *[F.sum(c).cast("bigint").alias(n) for n, c in sums.items()])


def merged_moments(moments: DataFrame) -> DataFrame:
    """Moments of parts of the users, added up."""
    names = ["users", "sx", "sy", "sxx", "syy", "sxy"]
    return moments.groupBy("metric", "kind", "ratio", "cell").agg(*[F.sum(n).cast("bigint").alias(n) for n in names])


def metric_readout(moments: DataFrame, *, control: str = "control") -> DataFrame:
    """Per metric and cell: value, standard error, difference to control, its t score and the
    degrees of freedom.

    A mean's error is its sample standard deviation over sqrt(n); a ratio's follows from the delta
    method. Scores are Welch's (no equal variances assumed), degrees of freedom Satterthwaite's.
    They are NULL where a cell has fewer than two users or a difference has no error.
    """
    n = F.col("users").cast("double")
    r = F.col("sx") / F.when(F.col("sy") != 0, F.col("sy"))
    # sum over users of (x - r y)^2: the spread of the linearised metric about its mean, which is 0
    spread = F.col("sxx") - 2 * r * F.col("sxy") + r * r * F.col("syy")
    mean_y = F.col("sy") / n
    error2 = F.when(n >= 2, spread / (n - 1) / (n * mean_y * mean_y))
    per = moments.select("metric", "kind", "cell", "users", r.alias("value"), error2.alias("_e2"))
    c = per.where(F.col("cell") == control).select("metric", F.col("value").alias("_cv"), F.col("_e2").alias("_ce2"),
                                                   F.col("users").alias("_cn"))
    j = per.join(c, "metric", "left")
    other = F.col("cell") != control
    both = F.col("_e2") + F.col("_ce2")
    t = F.when(other & (both > 0), (F.col("value") - F.col("_cv")) / F.sqrt(both))
    df = F.when(other & (both > 0), both * both / (F.col("_e2") * F.col("_e2") / (F.col("users") - 1)
                                                  + F.col("_ce2") * F.col("_ce2") / (F.col("_cn") - 1)))
    return j.select("metric", "kind", "cell", "users", F.round("value", 6).alias("value"), F.round(F.sqrt("_e2"), 6).alias("std_error"),
                    F.round(F.when(other, F.col("value") - F.col("_cv")), 6).alias("difference"),
                    F.round(t, 4).alias("t_score"), F.round(df, 3).alias("degrees"))
