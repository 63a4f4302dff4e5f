"""Source profiles: cardinality, collapse, widths, formats, signs and series."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyproof.plans.storage import written


def cardinality(df: DataFrame, code: str, description: str) -> DataFrame:
    """Distinct codes and descriptions; two levels, so that no task holds all values."""
    pairs = df.select(F.trim(code).alias("c"), F.trim(description).alias("d")).distinct()
    return pairs.agg(F.countDistinct("c").alias("codes"), F.countDistinct("d").alias("descriptions"), F.count(F.lit(1)).alias("pairs"))


def rare_codes(df: DataFrame, code: str, under: int = 100_000, top: int = 15) -> DataFrame:
    return df.groupBy(F.col(code).alias("code")).agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") < under).orderBy("n", "code").limit(top)


def collapsed(df: DataFrame, code: str, description: str) -> DataFrame:
    """Descriptions that cover more than one code."""
    pairs = df.select(F.col(code).alias("code"), F.col(description).alias("description")).distinct()
    return pairs.groupBy("description").agg(F.count("code").alias("codes")).filter("codes > 1")


def collapsed_codes(df: DataFrame, code: str, description: str) -> DataFrame:
    """The distinct codes that a description shared with another one makes ambiguous."""
    pairs = df.select(F.col(code).alias("code"), F.col(description).alias("description")).distinct()
    return pairs.join(collapsed(df, code, description), "description", "left_semi").select("code").distinct()


def widths(df: DataFrame, text: Column) -> DataFrame:
    return df.groupBy(F.length(text).alias("width")).agg(F.count(F.lit(1)).alias("n"))


def formats(df: DataFrame, raw: Column) -> DataFrame:
    """How values look: digits only, other text, left aligned in their field; swappable ones are digits in one column and text in the other."""
    return df.agg(
        F.count(F.when(raw.rlike(r"^\d+\z"), 1)).alias("digits_only"),
        F.count(F.when(~F.trim(raw).rlike(r"^\d+\z"), 1)).alias("textual"),
        F.count(F.when(raw.rlike(r"^\S.*\s\z"), 1)).alias("left_aligned"),
    )


def grammar(df: DataFrame, raw: Column, parsed: Column, samples: int = 10) -> DataFrame:
    """Accepted, refused, the number of places met and a few refused samples, the least ones.

    Counts are summed where rows are read; samples come from a sorted limit, so no task holds more than that many.
    """
    rows = df.select(raw.alias("raw"), parsed.isNotNull().alias("ok"))
    places = rows.withColumn("scale", F.when(F.col("ok"), F.length(F.regexp_extract("raw", r"[,.](\d+)\s*$", 1))))
    counts = places.groupBy("scale").agg(F.count(F.when(F.col("ok"), 1)).alias("accepted"), F.count(F.when(~F.col("ok"), 1)).alias("refused"))
    summed = counts.agg(F.coalesce(F.sum("accepted"), F.lit(0)).alias("accepted"), F.coalesce(F.sum("refused"), F.lit(0)).alias("refused"), F.sort_array(F.collect_set(F.when(F.col("accepted") > 0, F.col("scale")))).alias("scales"))
    least = rows.filter(~F.col("ok") & F.col("raw").isNotNull()).select(F.substring("raw", 1, 40).alias("s")).distinct().orderBy("s").limit(samples)
    return summed.crossJoin(least.agg(F.sort_array(F.collect_list("s")).alias("samples")))  # one row and one row


def swappable(df: DataFrame, one: Column, two: Column) -> DataFrame:
    """(swappable): rows in which the first column is digits only and the second is not, or the other way round."""
    digits = lambda c: F.coalesce(F.trim(c).rlike(r"^\d+\z"), F.lit(False))
    return df.agg(F.count(F.when(digits(one) != digits(two), 1)).alias("swappable"))


def mean_delta(stats: DataFrame, by: str, first: str, second: str) -> DataFrame:
    """The difference of the means of two configurations of ``run_stats``, to four places."""
    of = lambda name: F.max(F.when(F.col(by) == name, F.col("mean")))
    return stats.agg(F.round(of(first) - of(second), 4).alias("delta"))


def signs(df: DataFrame, amount: Column) -> DataFrame:
    value = amount.cast("decimal(18,2)")
    return df.agg(F.count(F.when(value < 0, 1)).alias("negatives"), F.count(F.when(value == 0, 1)).alias("zeros"), F.min(value).alias("least"), F.max(value).alias("greatest"), F.sum(value).cast("decimal(38,2)").alias("total"), (F.length(F.floor(F.abs(F.sum(value))).cast("string")) + 3).alias("precision"))


def running_peak(df: DataFrame, order: list[Column], amount: Column, partitions: int | None = None) -> DataFrame:
    """The total and the greatest running total in order.

    Rows are ranged over partitions in order and summed inside each; a partition's greatest running
    sum is shifted by the sums of the partitions before, of which there is one row each.
    """
    value = amount.cast("decimal(18,2)")
    keys = [c.alias(f"o{i}") for i, c in enumerate(order)]
    names = [f"o{i}" for i in range(len(order))]
    n = partitions or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ranged = df.select(*keys, value.alias("v")).repartitionByRange(n, *names).withColumn("p", F.spark_partition_id())
    run = F.sum("v").over(Window.partitionBy("p").orderBy(*names).rowsBetween(Window.unboundedPreceding, 0))
    per = written(ranged.withColumn("run", run).groupBy("p").agg(F.max("run").alias("peak"), F.sum("v").alias("s")), "peaks")
    before = F.coalesce(F.sum("s").over(Window.orderBy("p").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))  # over one row a partition
    shifted = per.select((F.col("peak") + before).alias("p"), "s")
    return shifted.agg(F.sum("s").cast("decimal(38,2)").alias("total"), F.max("p").cast("decimal(38,2)").alias("peak"))


def series_steps(points: DataFrame, period: str, value: str, limit: float = 5.0) -> DataFrame:
    """Change in percent from the period before, flagged beyond ``limit``; one row a period."""
    before = F.lag(value).over(Window.orderBy(period))
    change = F.round((F.col(value) - before).cast("double") * 100 / before.cast("double"), 6)
    return points.select(period, value, change.alias("change_percent"), F.coalesce(F.abs(change) > limit, F.lit(False)).alias("flagged"))


def cumulative(points: DataFrame, period: str, count: str, amount: str) -> DataFrame:
    """Running count and sum over periods."""
    w = Window.orderBy(period).rowsBetween(Window.unboundedPreceding, 0)
    return points.select(period, F.sum(count).over(w).alias("rows_so_far"), F.sum(amount).over(w).cast("decimal(38,2)").alias("sum_so_far"))


def run_stats(df: DataFrame, by: str, value: Column) -> DataFrame:
    """Mean, sample deviation (0 for one run), least and greatest, to four places."""
    return df.groupBy(by).agg(F.round(F.avg(value), 4).alias("mean"), F.round(F.coalesce(F.stddev_samp(value), F.lit(0.0)), 4).alias("stddev"), F.round(F.min(value), 4).alias("least"), F.round(F.max(value), 4).alias("greatest"), F.count(F.lit(1)).alias("n"))
