"""Aggregates behind data exploration: completeness, distributions, activity, user behaviour."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F, types as T

from ..config import DEFAULTS, ScaleLimits
from ..functions.numbers import mean, micros, ratio, rounded, total
from .skew import distinct_estimate, lookup, quantiles

FIELDS = ["timestamp", "user_id", "transaction_type", "amount", "currency", "location", "device"]
_DAY = 24 * 3600 * 1_000_000


def _long(row: DataFrame, name: str, value: str, columns: list[str]) -> DataFrame:
    return row.select(F.inline(F.array(*[
        F.struct(F.lit(c).alias(name), F.col(f"`{c}`").alias(value)) for c in columns])))


def completeness(df: DataFrame, fields: list[str] | None = None) -> DataFrame:
    """Non-null and missing share per field, and the mean over all fields."""
    fields = [f for f in FIELDS if f in df.columns] if fields is None else fields
    share = lambda c: F.coalesce(ratio(F.count(c), F.count(F.lit(1))) * 100, F.lit(0.0))
    row = df.agg(*[share(f).alias(f) for f in fields])
    row = row.withColumn("overall", sum((F.col(f) for f in fields), F.lit(0.0)) / len(fields))
    return _long(row, "field", "completeness", [*fields, "overall"]).withColumn(
        "missing", F.lit(100.0) - F.col("completeness"))


def value_frequencies(df: DataFrame, column: str, n: int | None = None) -> DataFrame:
    """Non-null values by count; the ``n`` most frequent ones where ``n`` is given."""
    counts = df.filter(F.col(column).isNotNull()).groupBy(F.col(column).alias("value")).agg(
        F.count(F.lit(1)).alias("n"))
    ordered = counts.orderBy(F.col("n").desc(), "value")
    return ordered if n is None else ordered.limit(n)


def describe(df: DataFrame, columns: list[str], limits: ScaleLimits = DEFAULTS.limits) -> DataFrame:
    """Count, mean, std, minimum, exact quartiles and maximum per column."""
    q = {c: quantiles(df, c, [0.25, 0.5, 0.75], limits).select("q").scalar() for c in columns}
    row = df.agg(*[
        F.struct(
            F.count(c).alias("count"), F.avg(c).alias("mean"), F.stddev_samp(c).alias("std"),
            F.min(c).cast("double").alias("min"), F.max(c).cast("double").alias("max")).alias(c)
        for c in columns]).withColumns({f"_q_{c}": q[c] for c in columns})
    return row.select(F.inline(F.array(*[
        F.struct(
            F.lit(c).alias("column"), F.col(f"{c}.count").alias("count"), F.col(f"{c}.mean").alias("mean"),
            F.col(f"{c}.std").alias("std"), F.col(f"{c}.min").alias("min"),
            F.col(f"_q_{c}")[0].alias("q25"), F.col(f"_q_{c}")[1].alias("q50"), F.col(f"_q_{c}")[2].alias("q75"),
            F.col(f"{c}.max").alias("max")) for c in columns])))


def overview(df: DataFrame) -> DataFrame:
    return df.agg(
        F.count(F.lit(1)).alias("transactions"),
        F.count_distinct("user_id").alias("users"),
        F.count_distinct("transaction_type").alias("transaction_types"),
        F.count_distinct("location").alias("locations"),
        F.count_distinct("currency").alias("currencies"),
        F.count_distinct("device").alias("devices"),
        F.to_date(F.min("timestamp")).alias("first_day"),
        F.to_date(F.max("timestamp")).alias("last_day"),
        mean(F.col("amount")).alias("avg_amount"),
        total(F.col("amount")).alias("total_amount"),
    )


def histogram(df: DataFrame, column: str, bins: int) -> DataFrame:
    """Equal-width bins over the range of the values, empty bins included."""
    c = F.col(column).cast("double")
    values = df.select(c.alias("_v")).filter(F.col("_v").isNotNull())
    span = values.agg(F.min("_v").alias("lo"), F.max("_v").alias("hi")).select(
        F.when(F.col("lo") == F.col("hi"), F.col("lo") - 0.5).otherwise(F.col("lo")).alias("lo"),
        F.when(F.col("lo") == F.col("hi"), F.col("hi") + 0.5).otherwise(F.col("hi")).alias("hi"))
    at = (F.col("_v") - F.col("_r.lo")) / (F.col("_r.hi") - F.col("_r.lo")) * bins
    counts = (
        values.withColumn("_r", span.select(F.struct("lo", "hi")).scalar())
        .groupBy(F.least(F.floor(at), F.lit(bins - 1)).cast("int").alias("bin")).agg(F.count(F.lit(1)).alias("n"))
    )
    frame = span.select("lo", "hi", F.explode(F.sequence(F.lit(0), F.lit(bins - 1))).alias("bin"))
    width = (F.col("hi") - F.col("lo")) / bins
    return frame.join(counts, "bin", "left").select(
        "bin", (F.col("lo") + width * F.col("bin")).alias("bin_start"),
        (F.col("lo") + width * (F.col("bin") + 1)).alias("bin_end"), F.coalesce("n", F.lit(0)).alias("n"))


def daily_counts(df: DataFrame, fill: bool = False) -> DataFrame:
    """Transactions per day; with ``fill`` also the days without any."""
    day = F.to_date("timestamp")
    counts = df.filter(F.col("timestamp").isNotNull()).groupBy(day.alias("day")).agg(F.count(F.lit(1)).alias("n"))
    if not fill:
        return counts
    days = df.agg(F.to_date(F.min("timestamp")).alias("a"), F.to_date(F.max("timestamp")).alias("b")).select(
        F.explode(F.sequence("a", "b")).alias("day"))
    return days.join(counts, "day", "left").select("day", F.coalesce("n", F.lit(0)).alias("n"))


def daily_summary(df: DataFrame) -> DataFrame:
    """The busiest day (the first of equals), its count, and the mean per active day."""
    return daily_counts(df).agg(
        F.min_by("day", F.struct(-F.col("n"), F.col("day"))).alias("peak_day"),
        F.max("n").alias("peak_count"), F.avg("n").alias("avg_daily"))


def hourly_counts(df: DataFrame) -> DataFrame:
    hour = F.hour(F.col("timestamp").cast("timestamp"))
    return df.filter(F.col("timestamp").isNotNull()).groupBy(hour.alias("hour")).agg(F.count(F.lit(1)).alias("n"))


def weekday_counts(df: DataFrame) -> DataFrame:
    day = F.weekday("timestamp")
    return df.filter(F.col("timestamp").isNotNull()).groupBy(day.alias("day_of_week")).agg(
        F.count(F.lit(1)).alias("n"))


def _known(df: DataFrame) -> DataFrame:
    return df.filter(F.col("user_id").isNotNull())


def user_recency(df: DataFrame) -> DataFrame:
    """Whole days from each user's last transaction to the last of all."""
    latest = df.agg(F.max(micros(F.col("timestamp")))).scalar()
    last = _known(df).groupBy("user_id").agg(F.max(micros(F.col("timestamp"))).alias("_last"))
    return last.select("user_id", F.floor((latest - F.col("_last")) / _DAY).alias("days_since_last"))


def recency_metrics(df: DataFrame) -> DataFrame:
    d = F.col("days_since_last")
    return user_recency(df).agg(
        F.avg(d).alias("avg_days_since_last_transaction"),
        F.count_if(d <= 7).alias("recent_users_7_days"),
        F.count_if(d <= 30).alias("recent_users_30_days"),
        F.count_if(d > 90).alias("inactive_users_90_days"))


def activity_span_metrics(df: DataFrame) -> DataFrame:
    t = micros(F.col("timestamp"))
    span = F.floor((F.max(t) - F.min(t)) / _DAY)
    users = _known(df).groupBy("user_id").agg(span.alias("d"))
    return users.agg(
        F.avg("d").alias("avg_activity_span_days"), F.max("d").alias("max_activity_span_days"),
        F.count_if(F.col("d") == 0).alias("users_with_span_1_day"))


def diversity_metrics(df: DataFrame) -> DataFrame:
    users = _known(df).groupBy("user_id").agg(
        F.count_distinct("location").alias("l"), F.count_distinct("device").alias("d"),
        F.count_distinct("transaction_type").alias("t"))
    return users.agg(
        F.avg("l").alias("avg_unique_locations"),
        F.count_if(F.col("l") > 1).alias("mobile_users_multiple_locations"),
        F.avg("d").alias("avg_unique_devices"),
        F.count_if(F.col("d") > 1).alias("multi_device_users"),
        F.avg("t").alias("avg_unique_transaction_types"),
        F.count_if(F.col("t") > 1).alias("diverse_transaction_users"))


def monetary_metrics(df: DataFrame, limits: ScaleLimits = DEFAULTS.limits) -> DataFrame:
    """Mean total per user, users above the 90 % quantile of totals, mean of user means."""
    users = _known(df).groupBy("user_id").agg(
        F.coalesce(total(F.col("amount")), F.lit(0.0)).alias("total"), mean(F.col("amount")).alias("avg"))
    cut = quantiles(users, "total", [0.9], limits).select("q").scalar()
    return users.withColumn("_q", cut[0]).agg(
        F.avg("total").alias("avg_total_value_per_user"),
        F.count_if(F.col("total") > F.col("_q")).alias("high_value_users_90th_percentile"),
        F.avg("avg").alias("avg_transaction_amount"))


def behaviour_summary(df: DataFrame, limits: ScaleLimits = DEFAULTS.limits) -> DataFrame:
    """One row of structs: overall, recency, activity span, diversity and monetary metrics."""
    pack = lambda d: d.select(F.struct(*d.columns)).scalar()
    overall = df.agg(
        F.count_distinct("user_id").alias("total_users"), F.count(F.lit(1)).alias("total_transactions"),
        ratio(F.count(F.lit(1)), F.count_distinct("user_id")).alias("avg_transactions_per_user"),
        F.concat(F.to_date(F.min("timestamp")), F.lit(" to "), F.to_date(F.max("timestamp"))).alias("date_range"))
    return overall.select(
        F.struct(*overall.columns).alias("overall_statistics"),
        pack(recency_metrics(df)).alias("recency_metrics"),
        pack(activity_span_metrics(df)).alias("activity_span_metrics"),
        pack(diversity_metrics(df)).alias("diversity_metrics"),
        pack(monetary_metrics(df, limits)).alias("monetary_metrics"))


def behaviour_vectors(df: DataFrame) -> DataFrame:
    """Per user: count, mean, std and active days, each also as a z-score over all users."""
    t = micros(F.col("timestamp"))
    users = _known(df).groupBy("user_id").agg(
        F.count("amount").cast("double").alias("transaction_count"), mean(F.col("amount")).alias("avg_amount"),
        F.stddev_samp("amount").alias("amount_std"),
        F.floor((F.max(t) - F.min(t)) / _DAY).cast("double").alias("activity_span")).fillna(0.0)
    return zscaled(users, ["transaction_count", "avg_amount", "amount_std", "activity_span"])


def zscaled(df: DataFrame, columns: list[str], source: DataFrame | None = None) -> DataFrame:
    """Add ``<column>_scaled``: z-scores with the population std; a constant column becomes 0."""
    source = df if source is None else source
    stats = source.agg(*[F.struct(F.avg(c).alias("m"), F.stddev_pop(c).alias("s")).alias(c) for c in columns])
    z = lambda c: F.coalesce(ratio(F.col(c) - F.col(f"_z.{c}.m"), F.col(f"_z.{c}.s")), F.lit(0.0))
    return df.withColumn("_z", stats.select(F.struct(*columns)).scalar()).withColumns(
        {f"{c}_scaled": z(c) for c in columns}).drop("_z")


def boxplot(df: DataFrame, column: str, group: str, limits: ScaleLimits = DEFAULTS.limits) -> DataFrame:
    """Per group: quartiles, and whiskers at the outermost values within 1.5 box lengths."""
    rows = df.select(group, column).filter(F.col(group).isNotNull() & F.col(column).isNotNull())
    q = quantiles(rows, column, [0.25, 0.5, 0.75], limits, keys=(group,)).select(
        group, F.col("q")[0].alias("q1"), F.col("q")[1].alias("median"), F.col("q")[2].alias("q3"))
    groups = distinct_estimate(rows, F.col(group))
    c, reach = F.col(column), (F.col("q3") - F.col("q1")) * 1.5
    inside = (c >= F.col("q1") - reach) & (c <= F.col("q3") + reach)
    return lookup(rows, q, [group], groups, limits).groupBy(group).agg(
        F.count(F.lit(1)).alias("n"), F.first("q1").alias("q1"), F.first("median").alias("median"),
        F.first("q3").alias("q3"),
        F.min(F.when(inside, c)).alias("whisker_low"), F.max(F.when(inside, c)).alias("whisker_high"),
        F.count_if(~inside).alias("outliers"))


def amount_by_group(df: DataFrame, group: str) -> DataFrame:
    return df.filter(F.col(group).isNotNull()).groupBy(group).agg(
        mean(F.col("amount")).alias("mean"), F.stddev_samp("amount").alias("std"), F.count("amount").alias("count"))


def feature_profile(df: DataFrame) -> DataFrame:
    """Per column: type, nulls, and range and mean of numeric columns. One pass."""
    def part(f: T.StructField) -> Column:
        c = F.col(f"`{f.name}`")
        number = isinstance(f.dataType, T.NumericType)
        stat = lambda fn: (fn(c) if number else F.max(F.lit(None))).cast("double")
        return F.struct(
            F.lit(f.name).alias("feature"), F.lit(f.dataType.simpleString()).alias("data_type"),
            F.count(c).alias("non_null"), (F.count(F.lit(1)) - F.count(c)).alias("nulls"),
            F.coalesce(ratio(F.count(F.lit(1)) - F.count(c), F.count(F.lit(1))) * 100, F.lit(0.0)).alias("null_percentage"),
            stat(F.min).alias("min"), stat(F.max).alias("max"), stat(F.avg).alias("mean"),
        ).alias(f.name)

    row = df.agg(*[part(f) for f in df.schema.fields])
    return row.select(F.inline(F.array(*[F.col(f"`{c}`") for c in df.columns])))


def top_values(df: DataFrame, columns: list[str], n: int = 3) -> DataFrame:
    """The ``n`` most frequent values of each column, from one grouping of all of them."""
    pairs = df.select(F.inline(F.array(*[
        F.struct(F.lit(c).alias("feature"), F.col(c).cast("string").alias("value")) for c in columns])))
    counts = pairs.filter(F.col("value").isNotNull()).groupBy("feature", "value").agg(F.count(F.lit(1)).alias("n"))
    w = Window.partitionBy("feature").orderBy(F.col("n").desc(), "value")
    return counts.withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= n)


def user_amount_pattern(df: DataFrame) -> DataFrame:
    return _known(df).groupBy("user_id").agg(
        F.coalesce(mean(F.col("amount")), F.lit(0.0)).alias("mean"),
        F.coalesce(F.stddev_samp("amount"), F.lit(0.0)).alias("std"))


def scatter_points(df: DataFrame, x: str, y: str, flag: str = "is_anomaly") -> DataFrame:
    hover = [c for c in ("user_id", "transaction_type", "amount") if c in df.columns and c not in (x, y)]
    return df.select(F.col(x).alias("x"), F.col(y).alias("y"), F.col(flag).alias("flag"), *hover)


def anomalies_by(top: DataFrame, column: str) -> DataFrame:
    """Counts of the given (top-N) anomalies by location, hour or any other column."""
    return value_frequencies(top, column)
