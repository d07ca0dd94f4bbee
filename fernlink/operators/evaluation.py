"""Evaluation: exact stratified samples, reviews and golden labels, and progress by level."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from fernlink.operators.matchers import require

REVIEW = ("manufacturer_match", "manufacturer_comment", "device_match", "device_comment")


def allocation(counts: DataFrame, group: str, total: int, least: int = 1) -> DataFrame:
    """group and n: rows to draw from each group of ``counts`` (group, c); proportional, at least ``least``, ``total`` in sum.

    A group's share is rounded down; what is then left goes to the largest fractions,
    and no group gives more rows than it has. A difference that these two bounds leave
    is settled in rounds of one row for each group that still has room, larger groups
    first. Equal fractions and sizes go by group. Raises where the least shares alone
    are over the total, so there are never more groups than ``total / least`` in the
    one partition of the windows.
    """
    every = Window.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    row = counts.agg(F.coalesce(F.sum("c"), F.lit(0)).alias("size"), F.coalesce(F.sum(F.least("c", F.lit(least))), F.lit(0)).alias("needed")).first()
    if total >= row["size"]:
        return counts.select(group, F.col("c").alias("n"))
    if row["needed"] > total:
        raise ValueError("total is below the least number of rows of all groups")
    share = F.col("c").cast("double") / F.lit(row["size"]) * F.lit(total)
    first = counts.select(group, "c", share.alias("share")).withColumn("base", F.greatest(F.floor("share"), F.lit(least)))
    by_fraction = Window.orderBy(F.desc(F.col("share") - F.floor("share")), group)
    topped = F.when(F.row_number().over(by_fraction) <= F.lit(total) - F.sum("base").over(every), 1).otherwise(0)
    second = first.withColumn("n", F.least(F.col("base") + topped, F.col("c"))).withColumn("gap", F.lit(total) - F.sum("n").over(every))
    room = F.when(F.col("gap") > 0, F.col("c") - F.col("n")).when(F.col("gap") < 0, F.greatest(F.col("n") - F.lit(least), F.lit(0))).otherwise(0)
    third = second.withColumn("room", room).withColumn("need", F.abs("gap"))
    # whole rounds: between two neighbouring rooms, each round moves one row of every group with more room
    by_room = Window.orderBy("room", group)
    before = F.coalesce(F.lag("room").over(by_room), F.lit(0))
    groups = F.count("*").over(every) - F.row_number().over(by_room) + 1
    moved = F.coalesce(F.sum("room").over(by_room.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)) + before * groups
    rounds = F.when(moved <= F.col("need"), F.least(F.col("room"), before + F.floor((F.col("need") - moved) / groups)))
    fourth = third.withColumn("rounds", rounds).withColumn("rounds", F.max("rounds").over(every)).withColumn("whole", F.least("room", "rounds"))
    more = F.col("room") > F.col("rounds")
    turn = F.row_number().over(Window.partitionBy(more).orderBy(F.desc("c"), group))
    step = F.col("whole") + F.when(more & (turn <= F.col("need") - F.sum("whole").over(every)), 1).otherwise(0)
    return fourth.select(group, (F.col("n") + F.signum("gap").cast("long") * step).cast("long").alias("n"))


def stratified_proportional_sample(rows: DataFrame, group: str, key: str, total_n: int = 500, min_per_group: int = 1, seed: int = 42, drop_na: bool = False) -> tuple[DataFrame, DataFrame]:
    """(sample, allocation). A group's rows are drawn in the order of md5("seed:key"), then key. Null groups are UNKNOWN, or left out.

    No group gives more than ``total_n`` rows, so a task passes on that many rows of a group at most.
    """
    require(rows, group, key)
    named = rows.where(F.col(group).isNotNull()) if drop_na else rows.withColumn(group, F.coalesce(F.col(group).cast("string"), F.lit("UNKNOWN")))
    share = allocation(named.groupBy(group).agg(F.count("*").alias("c")), group, total_n, min_per_group)
    draw = F.md5(F.concat(F.lit(f"{seed}:"), F.col(key).cast("string")).cast("binary"))
    drawn = named.withColumn("__r", F.row_number().over(Window.partitionBy(group).orderBy(draw, key))).where(F.col("__r") <= total_n)
    return drawn.join(share, group).where("__r <= n").select(*rows.columns), share


def apply_reviews(rows: DataFrame, reviews: DataFrame, key: str, only_reviewed: bool = True) -> DataFrame:
    """Rows with their annotations; a review without any entry counts as none."""
    require(reviews, key, *REVIEW)
    given = reviews.where(" or ".join(f"coalesce({c}, '') <> ''" for c in REVIEW)).select(key, *REVIEW)
    return rows.drop(*REVIEW).join(given, key, "inner" if only_reviewed else "left")


def unlabelled(rows: DataFrame, label: str = "golden_label") -> DataFrame:
    return rows.where(F.col(label).isNull()) if label in rows.columns else rows.withColumn(label, F.lit(None).cast("string"))


def merge_labels(rows: DataFrame, labelled: DataFrame, on: str, label: str = "golden_label") -> DataFrame:
    """Rows with the labels of another frame; a column of that name stays, and the new one gets the suffix _new."""
    new = f"{label}_new" if label in rows.columns else label
    return rows.join(labelled.select(on, F.col(label).alias(new)), on, "left")


def level_counts(rows: DataFrame, label: str, level: str) -> DataFrame:
    """Rows at each level, and the share of all rows without a label in per cent."""
    return rows.groupBy(F.coalesce(level, F.lit("unmatched")).alias("level")).agg(F.count("*").alias("n"), F.sum(F.col(label).isNull().cast("long")).alias("open"))


def unmatched_pct(rows: DataFrame, label: str) -> DataFrame:
    return rows.agg(F.count("*").alias("n_rows"), F.coalesce(F.sum(F.col(label).isNull().cast("long")), F.lit(0)).alias("n_unmatched"), F.round(100 * F.avg(F.col(label).isNull().cast("double")), 6).alias("pct_unmatched"))
