"""Exact top-k search over binary codes by incremental multi-index hashing.

A code's bits are the signs of the embedding's values. Codes of one length are cut
into segments of about log2(n) bits, n being the number of different codes, so a
bucket (a segment and its value) holds about one code. Buckets are rows, found by
equality: in round r, each query that is still open probes in every segment the
values that differ from its own in r bits. A code that none of the first j segments
shows to radius r, nor any of the m segments to radius r - 1, is at distance m * r + j
at least. So a query whose kth verified distance is d probes the first d - m * r + 1
segments in round r, and ends when there are none. No query looks through all
codes; the radii can only grow to the segments' widths.

All of it is DataFrame operations. A bucket with many codes is cut into pieces, and
what probes it is repeated for each, so no task holds all of it. A candidate pair
counts in the first round and segment that finds it.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from fernlink.llm import common

WORD = 64  # bits of a code's words


def binary_codes(rows: DataFrame, id_col: str, vector: str) -> DataFrame:
    """id, bits and code of each row with a vector and an id; bit i is vector[i] > 0, NaN and null count as 0.

    ``bits`` is the number of values; ``code`` holds the bits in words of 64, the lowest first.
    """
    v, n = F.col("v"), F.size("v")
    sign = F.transform(v, lambda x: F.when((x > 0) & ~F.isnan(x.cast("double")), F.lit(1)).otherwise(F.lit(0)).cast("long"))
    first = lambda w: F.aggregate(
        F.sequence(F.lit(0), F.least(n - w * WORD, F.lit(WORD)) - 1), F.lit(0).cast("long"), lambda a, i: a.bitwiseOR(F.call_function("shiftleft", F.get("sign", w * WORD + i), i))
    )
    code = F.when(n == 0, F.array().cast("array<bigint>")).otherwise(F.transform(F.sequence(F.lit(0), F.greatest(F.ceil(n / WORD).cast("int") - 1, F.lit(0))), first))
    given = rows.where(F.col(vector).isNotNull() & F.col(id_col).isNotNull()).select(F.col(id_col).alias("id"), F.col(vector).alias("v"))
    return given.withColumn("sign", sign).select("id", n.alias("bits"), code.alias("code"))


def segments(m: Column) -> Column:
    """(width, value) of the ``m`` segments of ``code``: their borders are spread evenly over the ``bits``."""
    border = lambda s: F.floor(s * F.col("bits") / m).cast("int")
    bit = lambda p: F.call_function("shiftright", F.get("code", F.floor(p / WORD).cast("int")), p % WORD).bitwiseAND(F.lit(1).cast("long"))
    value = lambda lo, hi: F.when(hi > lo, F.aggregate(F.sequence(lo, F.greatest(hi - 1, lo)), F.lit(0).cast("long"), lambda a, p: F.call_function("shiftleft", a, F.lit(1)).bitwiseOR(bit(p)))).otherwise(F.lit(0).cast("long"))
    return F.transform(F.sequence(F.lit(0), m - 1), lambda s: F.struct((border(s + 1) - border(s)).alias("width"), value(border(s), border(s + 1)).alias("value")))


@dataclass(frozen=True)
class Trace:
    """What a search looked at: rounds, and for each the probes and the candidates verified."""

    probes: list[int]
    candidates: list[int]


def top_k(rows: DataFrame, is_query: Column, k: int = 10, id_col: str = "vec_id", vector: str = "embedding", piece: int = 4096, trace: Trace | None = None) -> DataFrame:
    """The k other rows nearest to each query row: query_id, rank (from 1), neighbor_id, distance.

    Distances are Hamming distances of the codes; ties go to the smaller id. Rows
    without a vector or an id take no part; vectors of another length have codes of
    another length and are never compared. A repeated id with the same code counts
    once. With fewer than k other rows, all of them are returned. Equal codes are
    searched once: each different code stands for its k + 1 smallest ids. Other columns
    are ignored; an empty table gives no rows.
    """
    coded = common.staged(binary_codes(rows, id_col, vector).distinct(), "codes")
    same = ("bits", "code")
    members = coded.withColumn("_r", F.row_number().over(Window.partitionBy(*same).orderBy("id"))).where(F.col("_r") <= k + 1).drop("_r")
    members = common.staged(members, "members")
    distinct = members.groupBy(*same).agg(F.min("id").alias("tie"), F.count("*").alias("held"))
    sizes = distinct.groupBy("bits").agg(F.count("*").alias("n"))
    many = F.greatest(F.ceil(F.col("bits") / F.greatest(F.log2("n"), F.lit(1.0))).cast("int"), F.lit(1))
    cut = distinct.join(sizes.select("bits", many.alias("m")), "bits").withColumn("segments", segments(F.col("m"))).drop("m")
    cut = common.staged(cut, "segments")
    # buckets, and the pieces of those with many codes
    laid = cut.select("bits", "code", "tie", "held", "segments", F.posexplode("segments").alias("s", "_v")).select("*", F.col("_v.value").alias("value")).drop("_v")
    bucket = ("bits", "s", "value")
    buckets = laid.groupBy(*bucket).agg(F.count("*").alias("c")).select(*bucket, F.ceil(F.col("c") / piece).cast("int").alias("pieces"))
    own = F.when(F.col("pieces") > 1, F.pmod(F.xxhash64("code"), F.col("pieces")).cast("int")).otherwise(0)
    index = common.staged(laid.join(buckets, [*bucket]).select(*bucket, own.alias("piece"), "code", "tie", "held", "segments"), "buckets")
    buckets = common.staged(buckets, "bucket-pieces")
    queries = coded.where(is_query)
    asked = queries.select(*same).distinct().join(cut.select("bits", F.col("code"), "segments"), [*same])
    asked = asked.select("bits", F.col("code").alias("q"), F.col("segments").alias("q_segments"), F.col("bits").alias("kth"))
    open_ = common.staged(asked, "open-0")  # kth: a distance within which k others are known
    if not open_.head(1):
        return rows.sparkSession.createDataFrame([], "query_id long, rank int, neighbor_id long, distance int")
    start = open_.select("bits", "q", F.posexplode("q_segments").alias("s", "_v")).select("bits", "q", "s", F.col("_v.width").alias("width"), F.col("_v.value").alias("value"), F.lit(-1).alias("top"))
    frontier, found, radius = common.staged(start, "probes-0"), None, 0
    while True:
        hit = frontier.select(*bucket, "q").join(buckets, [*bucket]).withColumn("piece", F.explode(F.sequence(F.lit(0), F.col("pieces") - 1)))
        hit = hit.select(*bucket, "piece", "q").join(open_, ["bits", "q"])
        apart = F.zip_with("segments", "q_segments", lambda a, b: F.bit_count(a["value"].bitwiseXOR(b["value"])))
        distance = F.aggregate(F.zip_with("code", "q", lambda a, b: F.bit_count(a.bitwiseXOR(b))), F.lit(0), lambda a, x: a + x)
        pairs = hit.join(index, [*bucket, "piece"])
        if trace is not None:
            trace.probes.append(frontier.count())
            trace.candidates.append(pairs.count())
        new = pairs.where(distance <= F.col("kth")).where((F.array_min(apart) == radius) & (F.array_position(apart, F.lit(radius)) == F.col("s") + 1))
        seen = new.select("bits", "q", "code", "tie", "held", distance.alias("distance"))
        order = Window.partitionBy("bits", "q").orderBy("distance", "tie")
        best = seen if found is None else found.unionByName(seen)
        found = common.staged(best.withColumn("_r", F.row_number().over(order)).where(F.col("_r") <= k + 1).drop("_r"), f"found-{radius}")
        reach = Window.partitionBy("bits", "q").orderBy("distance").rangeBetween(Window.unboundedPreceding, Window.currentRow)
        covered = found.withColumn("upto", F.sum("held").over(reach)).where(F.col("upto") >= k + 1).groupBy("bits", "q").agg(F.min("distance").alias("now"))
        radius += 1
        now = open_.join(covered, ["bits", "q"], "left").withColumn("kth", F.least("kth", "now")).drop("now")
        open_ = common.staged(now.where(F.col("kth") >= F.size("q_segments") * radius), f"open-{radius}")
        grown = frontier.join(open_.select("bits", "q", (F.col("kth") - F.size("q_segments") * radius).alias("last")), ["bits", "q"])
        grown = grown.where((F.col("s") <= F.col("last")) & (F.col("top") + 1 < F.col("width")))
        grown = grown.withColumn("bit", F.explode(F.sequence(F.col("top") + 1, F.col("width") - 1)))
        flipped = F.col("value").bitwiseXOR(F.call_function("shiftleft", F.lit(1).cast("long"), F.col("bit")))
        frontier = common.staged(grown.select("bits", "q", "s", "width", flipped.alias("value"), F.col("bit").alias("top")), f"probes-{radius}")
        if not frontier.head(1):
            break
    near = found.select("bits", "q", "code", "distance")
    listed = near.join(members, [*same]).select("bits", "q", "distance", F.col("id").alias("neighbor_id"))
    nearest = Window.partitionBy("bits", "q").orderBy("distance", "neighbor_id")
    listed = listed.withColumn("_r", F.row_number().over(nearest)).where(F.col("_r") <= k + 1).drop("_r")
    got = queries.select(F.col("id").alias("query_id"), "bits", F.col("code").alias("q")).join(listed, ["bits", "q"]).where("query_id <> neighbor_id")
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy("distance", "neighbor_id"))
    return got.select("query_id", rank.alias("rank"), "neighbor_id", F.col("distance").cast("int").alias("distance")).where(F.col("rank") <= k)


def op9_topk_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return top_k(common.table(spark, sf_dir, "embeddings"), F.col("id") % 100 == 0)


SQL = """
with p as (
  select q.vec_id as query_id, e.vec_id as neighbor_id,
    cast(list_sum(list_transform(range(1, 65), lambda i: case when (q.embedding[i] > 0) <> (e.embedding[i] > 0) then 1 else 0 end)) as int) as distance
  from embeddings q join embeddings e on e.vec_id <> q.vec_id where q.vec_id % 100 = 0
), r as (select query_id, cast(row_number() over (partition by query_id order by distance, neighbor_id) as int) as rank, neighbor_id, distance from p)
select query_id, rank, neighbor_id, distance from r where rank <= 10
"""
