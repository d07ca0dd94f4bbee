"""Product codes in free text: NPC, then MPC, then EAN."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fernlink.functions.text import as_text
from fernlink.operators.matchers import apply_hits, open_keys, require

LEAST = 5  # characters of a code that is looked for


def _starts(probe: DataFrame) -> DataFrame:
    """key, whole, at: each position of the text where a word begins or ends."""
    border = F.filter(F.sequence(F.lit(1), F.length("whole")), lambda i: F.regexp_like(F.substring(F.col("whole"), i, F.lit(1)), F.lit(r"(?U)\w")) != F.coalesce(F.when(i > 1, F.regexp_like(F.substring(F.col("whole"), i - 1, F.lit(1)), F.lit(r"(?U)\w"))), F.lit(False)))
    return probe.where("whole <> ''").withColumn("at", F.explode(border))


def npc_hits(probe: DataFrame, codes: DataFrame) -> DataFrame:
    """key and hit: the first place where a known prefix, a separator or none, and digits stand between word borders."""
    prefixes = codes.where("code is not null").groupBy(F.lower(F.substring("code", 1, 3)).alias("prefix"), F.length(F.substring("code", 1, 3)).alias("n")).agg(F.min("ord").alias("ord"))
    spots = _starts(probe).withColumn("n", F.explode(F.array(*map(F.lit, (1, 2, 3)))))
    found = spots.withColumn("prefix", F.lower(F.substring(F.col("whole"), F.col("at"), F.col("n")))).join(prefixes, ["prefix", "n"])
    rest = F.regexp_extract(F.substring(F.col("whole"), F.col("at") + F.col("n"), F.length("whole")), r"(?U)^([- ]?[0-9]+)\b", 1)
    found = found.withColumn("rest", rest).where("rest <> ''").withColumn("hit", F.concat(F.substring(F.col("whole"), F.col("at"), F.col("n")), F.col("rest")))
    return found.groupBy("key").agg(F.min_by("hit", F.struct("at", "ord")).alias("hit"))


def listed_hits(probe: DataFrame, codes: DataFrame) -> DataFrame:
    """key and hit: the first place where a code of the list stands, with a separator or none after its third character.

    Windows of the codes' lengths meet the codes by equality, so the list may be of any length.
    """
    known = codes.where(F.length("code") >= LEAST).groupBy(F.lower("code").alias("low")).agg(F.min("ord").alias("ord"), F.first(F.length("code")).alias("n"))
    lengths = [r.n for r in known.select("n").distinct().limit(257).collect()]  # code lengths, not codes
    if len(lengths) > 256:
        raise ValueError("codes of more than 256 different lengths")
    if not lengths:
        return probe.select("key", F.lit(None).cast("string").alias("hit")).limit(0)
    spots = _starts(probe).withColumn("n", F.explode(F.array(*map(F.lit, sorted(lengths))))).withColumn("gap", F.explode(F.array(F.lit(1), F.lit(0))))
    spots = spots.withColumn("hit", F.substring(F.col("whole"), F.col("at"), F.col("n") + F.col("gap"))).where(F.length("hit") == F.col("n") + F.col("gap"))
    spots = spots.where((F.col("gap") == 0) | F.substring("hit", 4, 1).isin("-", " "))
    low = F.lower(F.when(F.col("gap") == 1, F.concat(F.substring("hit", 1, 3), F.substring(F.col("hit"), F.lit(5), F.col("n")))).otherwise(F.col("hit")))
    last = F.regexp_like(F.substring(F.col("hit"), F.length("hit"), F.lit(1)), F.lit(r"(?U)\w"))
    after = F.coalesce(F.regexp_like(F.substring(F.col("whole"), F.col("at") + F.length("hit"), F.lit(1)), F.lit(r"(?U)\w")), F.lit(False))
    found = spots.withColumn("low", low).where(last != after).join(known.drop("n"), "low")
    return found.groupBy("key").agg(F.min_by("hit", F.struct("at", "ord", -F.col("gap"))).alias("hit"))


def code_hits(keys: DataFrame, key: str, catalogue: DataFrame, npc: str = "NPC", mpc: str = "MPC", ean: str = "EAN/GTIN", order: str = "ref_ord") -> DataFrame:
    """key, label, kind (npc, mpc, ean) and failed: the code that was found but leads nowhere, of the last kind tried.

    Codes are found in any case but looked up as they are, without separators; an MPC
    or EAN counts only if one catalogue row has it.
    """
    require(catalogue, npc, mpc, ean, order)
    probe = keys.select(F.col(key).alias("key")).distinct().withColumn("whole", as_text(F.col("key")))
    ref = catalogue.select(F.col(npc).alias("npc"), F.col(mpc).alias("mpc"), F.col(ean).cast("string").alias("ean"), F.col(order).alias("ord"))
    strip = lambda c: F.regexp_replace(c, "[- ]", "")
    out = probe.select("key")
    n = npc_hits(probe, ref.select(F.col("npc").alias("code"), "ord")).select(F.col("key").alias("k"), strip("hit").alias("n_code"))
    out = out.join(n, F.col("key").eqNullSafe(F.col("k")), "left").drop("k")
    listed = ref.where(F.length("npc") >= LEAST).select(F.col("npc").alias("n_code")).distinct().withColumn("n_ok", F.lit(True))
    out = out.join(listed, "n_code", "left")
    for short in ("mpc", "ean"):
        h = listed_hits(probe, ref.select(F.col(short).alias("code"), "ord")).select(F.col("key").alias("k"), strip("hit").alias(f"{short}_code"))
        out = out.join(h, F.col("key").eqNullSafe(F.col("k")), "left").drop("k")
        of = ref.groupBy(F.col(short).alias(f"{short}_code")).agg(F.count("*").alias(f"{short}_rows"), F.min("npc").alias(f"{short}_npc"))
        out = out.join(of, f"{short}_code", "left")
    ok = lambda s: F.col(f"{s}_rows") == 1
    bad = lambda s: F.col(f"{s}_rows") > 1
    failed = F.when(F.col("n_ok").isNull(), F.col("n_code"))
    after_mpc = F.when(bad("mpc"), F.col("mpc_code")).otherwise(failed)
    after_ean = F.when(bad("ean"), F.col("ean_code")).otherwise(after_mpc)
    return out.select(
        "key",
        F.when(F.col("n_ok"), F.col("n_code")).when(ok("mpc"), F.col("mpc_npc")).when(ok("ean"), F.col("ean_npc")).alias("label"),
        F.when(F.col("n_ok"), "npc").when(ok("mpc"), "mpc").when(ok("ean"), "ean").alias("kind"),
        F.when(F.col("n_ok") | ok("mpc") | ok("ean"), F.lit(None)).otherwise(after_ean).alias("codes_failed_to_match"),
    )


def device_code_level_matching(rows: DataFrame, catalogue: DataFrame, label: str, text: str, order: str = "ref_ord") -> DataFrame:
    hits = code_hits(open_keys(rows, label, text), text, catalogue, order=order)
    level = F.when(F.col("kind").isNotNull(), F.concat("kind", F.lit(f"_code_match_{text}")))
    hits = hits.withColumn("found_level", level)
    out = apply_hits(rows.withColumn("__free", F.col(label).isNull()), hits, {text: "key"}, label, "__level", "", extra=("codes_failed_to_match", "found_level"))
    old = F.col("device_level") if "device_level" in rows.columns else F.lit(None).cast("string")
    return out.withColumn("device_level", F.when(F.col("__free"), F.col("found_level")).otherwise(old)).drop("__free", "__level", "found_level")
