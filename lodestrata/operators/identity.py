"""Which records are one thing: records that share a code, directly or through others."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lodestrata.session import stage


def same_by_code(holders: DataFrame, record: str, code: str) -> DataFrame:
    """(record, least): the least record that is reachable over shared codes, itself included.

    Each round, every group of records that are known to be one thing looks up the
    least group of each of its codes and joins the least of these; chains of such choices
    are followed to their end at once by doubling. A group joins another or is the least
    among its neighbours, so their number at least halves each round, and a chain of records takes
    as many joins as the logarithm of its length.

    Only (group, code) pairs go on to the next round, without those codes that have one
    group left. A code that very many records hold is a sum with a map-side part, and a
    join of a skewed key. Null records and null codes are left out.
    """
    pairs = holders.select(F.col(record).alias("g"), F.col(code).alias("c"))
    pairs = stage(pairs.filter("g IS NOT NULL AND c IS NOT NULL").distinct(), "pairs")
    home = pairs.select(F.col("g").alias("record"), F.col("g").alias("least")).distinct()
    while True:
        spread = pairs.groupBy("c").agg(F.min("g").alias("low"), F.max("g").alias("high")).filter("low <> high")
        pairs = stage(pairs.join(spread.select("c", "low"), "c"), "pairs")
        if pairs.isEmpty():
            return home.select(F.col("record").alias(record), "least")
        choice = pairs.groupBy("g").agg(F.min("low").alias("to"))
        choice = _ends(stage(choice, "choice"))
        moved = home.join(choice, F.col("least") == F.col("g"), "left")
        home = stage(moved.select("record", F.coalesce("to", "least").alias("least")), "home")
        pairs = pairs.join(choice, "g").select(F.col("to").alias("g"), "c").distinct()


def _ends(choice: DataFrame) -> DataFrame:
    """(g, to) with every chain of choices followed to the group that chose itself."""
    while True:
        further = choice.select(F.col("g").alias("to"), F.col("to").alias("end"))
        choice = choice.join(further, "to", "left").select(
            "g", F.coalesce("end", "to").alias("next"), (F.col("end") < F.col("to")).alias("went")
        )
        choice = stage(choice, "choice")
        went = choice.filter("went").isEmpty()
        choice = choice.select("g", F.col("next").alias("to"))
        if went:
            return choice
