"""Daily profiles of a table that add up, and the rule that holds a day against those before.

A profile is a set of counts: rows, nulls, and for a numeric column how many values fall
into each of its steps. A step is a sign, an order of magnitude and the first two digits, so a
quantile read off the steps is within 5 % of the exact one. Counts of two loads, or of
several days, add up; the values themselves are not read again. A column has some hundred steps
at most, whatever the number of rows.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Decimal places that count; digits of a step.
PLACES, DIGITS = 2, 2
#: Days a day is held against, and how many of them there have to be.
HISTORY_DAYS, LEAST_DAYS = 7, 3
#: What is an anomaly: relative change of a quantile or of the rows, change of the null share.
MOST_CHANGE, MOST_NULLS = 0.5, 0.1
QUANTILES = (50, 90)


def step(value: Column) -> Column:
    """Step of a number: its first digits, zeros behind them, in units of the last place."""
    units = F.floor(F.abs(value) * 10**PLACES + F.lit(0.5)).cast("decimal(38,0)")
    text = units.cast("string")
    tail = F.greatest(F.length(text) - DIGITS, F.lit(0))
    rounded = F.concat(F.substring(text, 1, DIGITS), F.repeat(F.lit("0"), tail)).cast("decimal(38,0)")
    return F.when(value < 0, -rounded).otherwise(rounded)


def profile(df: DataFrame, day: str, columns: Sequence[str], numeric: Sequence[str] = ()) -> DataFrame:
    """(day, column, kind, step, n): counts by day. NaN counts as null."""
    none = F.lit(None).cast("decimal(38,0)")

    def fact(column: str, kind: str, at: Column, n: Column) -> Column:
        return F.struct(F.lit(column).alias("column"), F.lit(kind).alias("kind"), at.alias("step"), n.alias("n"))

    facts = [fact("*", "rows", none, F.lit(1))]
    for name in dict.fromkeys([*columns, *numeric]):
        empty = F.col(name).isNull()
        if name in numeric:
            number = F.col(name).cast("double")
            empty = empty | F.isnan(number)
            facts.append(F.when(~empty, fact(name, "step", step(number), F.lit(1))))
        facts.append(fact(name, "null", none, empty.cast("int")))
    each = df.select(F.to_date(day).alias("day"), F.explode(F.array_compact(F.array(*facts))).alias("f"))
    return each.groupBy("day", "f.column", "f.kind", "f.step").agg(F.sum("f.n").alias("n"))


def merged(profiles: DataFrame) -> DataFrame:
    """One profile of several, such as of the loads of a day."""
    return profiles.groupBy("day", "column", "kind", "step").agg(F.sum("n").alias("n"))


def measures(profiles: DataFrame) -> DataFrame:
    """(day, column, metric, value): rows, null share, quantiles.

    A quantile of n values is the least step that has at least q % of them up to it.
    """
    total = profiles.filter("kind = 'rows'").select("day", F.col("n").alias("total"))
    rows = total.select("day", F.lit("*").alias("column"), F.lit("rows").alias("metric"), F.col("total").cast("double").alias("value"))
    empty = profiles.filter("kind = 'null'").join(total, "day")
    share = F.round(F.col("n") / F.col("total"), 6)
    nulls = empty.select("day", "column", F.lit("null_share").alias("metric"), share.alias("value"))
    along = Window.partitionBy("day", "column").orderBy("step")
    steps = profiles.filter("kind = 'step'").withColumn("upto", F.sum("n").over(along))
    steps = steps.withColumn("all", F.sum("n").over(Window.partitionBy("day", "column")))
    out = rows.unionByName(nulls)
    for q in QUANTILES:
        least = steps.filter(F.col("upto") * 100 >= F.col("all") * q).groupBy("day", "column").agg(F.min("step").alias("s"))
        value = (F.col("s") / 10**PLACES).cast("double")
        out = out.unionByName(least.select("day", "column", F.lit(f"p{q}").alias("metric"), value.alias("value")))
    return out


def anomalies(profiles: DataFrame) -> DataFrame:
    """Every measure of a day beside the mean of the days before, and whether it is too far off.

    (day, column, metric, value, expected, days, status). Status is `pass`, `warn`, or
    `new` where fewer than LEAST_DAYS of the HISTORY_DAYS days before have the measure.
    """
    number = F.unix_date("day")
    before = Window.partitionBy("column", "metric").orderBy(number).rangeBetween(-HISTORY_DAYS, -1)
    rows = measures(merged(profiles)).withColumns(
        {"expected": F.avg("value").over(before), "days": F.count("value").over(before)}
    )
    far = F.abs(F.col("value") - F.col("expected"))
    off = F.when(F.col("metric") == "null_share", far > MOST_NULLS).otherwise(far > F.abs("expected") * MOST_CHANGE)
    status = F.when(F.col("days") < LEAST_DAYS, "new").when(off, "warn").otherwise("pass")
    return rows.withColumn("expected", F.round("expected", 6)).withColumn("status", status)
