"""The two cascades: ordered matchers, each for the rows that have no label yet.

All matchers but the term vectors depend on a row's key and the reference alone,
so they run on distinct keys; the first hit in the order of steps counts. Keys are
written down between groups of steps, cheap steps first, so the dear ones see only
keys that are still open. Term vectors weigh the rows that are still open.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fernlink.functions.text import DEVICE_STOP, MANUFACTURER_STOP, as_text, clean_tokens, token_list
from fernlink.operators import codes, matchers, tfidf
from fernlink.sources.tables import written


Progress = Callable[[str, int, int], None]


@dataclass(frozen=True)
class Config:
    jw_threshold: float = 0.9
    overlap_threshold: float = 0.5
    first_similarity: float = 0.5
    second_similarity: float = 0.3


def manufacturer_reference(catalogue: DataFrame, order: str = "ref_ord") -> DataFrame:
    """Distinct (Supplier, Brand) with the order of their first row as label."""
    return catalogue.groupBy("Supplier", "Brand").agg(F.min(order).alias("catalogue_manufacturers_index"))


def _first_hits(keys: DataFrame, steps: list[tuple[str, str, DataFrame]]) -> DataFrame:
    """keys with label and level of the first step that has a hit; steps: (level, key column, hits)."""
    out = keys
    for i, (_, key, hits) in enumerate(steps):
        h = hits.select(F.col("key").alias(f"__k{i}"), F.col("label").alias(f"__l{i}"))
        out = out.join(h, F.col(key).eqNullSafe(F.col(f"__k{i}")), "left").drop(f"__k{i}")
    label = F.coalesce(F.col("label"), *(F.col(f"__l{i}") for i in range(len(steps))))
    level = F.col("level")
    for i in reversed(range(len(steps))):
        level = F.when(F.col("label").isNull() & F.col(f"__l{i}").isNotNull() & F.coalesce(*(F.col(f"__l{j}") for j in range(i)), F.lit(None)).isNull(), F.lit(steps[i][0])).otherwise(level)
    return out.withColumns({"label": label, "level": level}).drop(*(f"__l{i}" for i in range(len(steps))))


def manufacturer_cascade(devices: DataFrame, catalogue: DataFrame, missing: DataFrame, config: Config = Config(), order: str = "ref_ord", log: Progress | None = None) -> DataFrame:
    """Devices with tokens, Manufacturer_label, level and Supplier_score.

    Labels: -99 for no manufacturer, -1 for one that is known to be missing, else the
    catalogue's index. ``log`` is told the levels, all rows and the open rows after
    each group of steps.
    """
    ref = manufacturer_reference(catalogue, order)
    idx = "catalogue_manufacturers_index"
    cleaned = lambda df, col: df.withColumn(f"{col}_tokens", clean_tokens(F.col(col), MANUFACTURER_STOP)).withColumn(f"{col}_tokens_list", token_list(F.col(f"{col}_tokens")))
    ref = cleaned(cleaned(ref, "Supplier"), "Brand")
    absent = cleaned(missing.select("Supplier_missing").distinct(), "Supplier_missing").withColumn(idx, F.lit(-1).cast("long")).withColumn("o", F.xxhash64("Supplier_missing"))
    ref = ref.withColumn("o", F.col(idx))
    rows = cleaned(devices, "CLN_Manufacturer")
    keys = rows.groupBy(F.col("CLN_Manufacturer_tokens").alias("tokens"), F.col("CLN_Manufacturer_Device_Name").alias("name")).agg(F.count("*").alias("n"))
    blank = F.col("tokens") == ""
    keys = keys.withColumn("list", token_list(F.col("tokens"))).withColumn("label", F.when(blank, F.lit(-99)).cast("long")).withColumn("level", F.when(blank, F.lit("null_level")))
    keys = written(keys, "keys")

    def settle(keys: DataFrame, steps: list) -> DataFrame:
        """Keys after the steps, which see only those that are still open; steps: (level, key column, hits of the open keys)."""
        free = keys.where("label is null")
        out = written(_first_hits(keys, [(level, column, hits(free)) for level, column, hits in steps]), "keys")
        if log is not None:
            n, still = out.agg(F.coalesce(F.sum("n"), F.lit(0)), F.coalesce(F.sum(F.when(F.col("label").isNull(), F.col("n"))), F.lit(0))).first()
            log(", ".join(level for level, *_ in steps), int(n), int(still))
        return out

    exact = lambda r, text: (f"exact_match_{text}", "tokens", lambda free: matchers.exact_hits(r, text, idx, "o"))
    substring = lambda r, text: (f"substring_match_{text}", "tokens", lambda free: matchers.substring_hits(free, "tokens", r, text, idx, "o"))
    similar = lambda r, text: (f"jaro_winkler_match_{text}", "tokens", lambda free: matchers.jaro_winkler_hits(free, "tokens", r, text, idx, "o", config.jw_threshold))
    overlap = lambda r, text: (f"token_overlap_match_{text}_list", "list", lambda free: matchers.token_overlap_hits(free, "list", r, f"{text}_list", idx, "o", config.overlap_threshold))
    phrase = lambda r, text: (f"catalogue_manufacturer_in_device_name_match_{text}", "name", lambda free: matchers.phrase_hits(free, "name", r, text, idx, "o"))
    missing_text, supplier_text, brand_text = "Supplier_missing_tokens", "Supplier_tokens", "Brand_tokens"
    keys = settle(keys, [exact(absent, missing_text)])
    keys = settle(keys, [similar(absent, missing_text), overlap(absent, missing_text), phrase(absent, missing_text)])
    keys = settle(keys, [exact(ref, supplier_text), substring(ref, supplier_text)])
    early = settle(keys, [similar(ref, supplier_text), overlap(ref, supplier_text)])
    texts = early.where("label is null").groupBy(F.col("tokens").alias("text")).agg(F.sum("n").alias("n"))
    vector = written(tfidf.supplier_hits(texts, ref, supplier_text, idx, "o"), "vectors")
    asked = early.where("label is null").select("tokens").distinct().join(vector.select(F.col("key").alias("tokens"), "score"), "tokens", "left").select("tokens", F.coalesce("score", F.lit(0.0)).alias("Supplier_score"))
    keys = settle(early, [(f"bag_of_words_match_{supplier_text}", "tokens", lambda free: vector.where("label is not null"))])
    keys = settle(keys, [phrase(ref, supplier_text), exact(ref, brand_text)])
    late = settle(keys, [similar(ref, brand_text), overlap(ref, brand_text), phrase(ref, brand_text)])
    still = early.where("label is null").select("tokens", "name").join(asked, "tokens").withColumnsRenamed({"tokens": "__t", "name": "__n"})
    scored = late.join(still, F.col("tokens").eqNullSafe(F.col("__t")) & F.col("name").eqNullSafe(F.col("__n")), "left").drop("__t", "__n")
    found = scored.select(F.col("tokens").alias("__t"), F.col("name").alias("__n"), F.col("label").alias("Manufacturer_label"), "level", "Supplier_score")
    return rows.join(found, F.col("CLN_Manufacturer_tokens").eqNullSafe(F.col("__t")) & F.col("CLN_Manufacturer_Device_Name").eqNullSafe(F.col("__n")), "left").drop("__t", "__n")


def device_cascade(labelled: DataFrame, catalogue: DataFrame, config: Config = Config(), order: str = "ref_ord", log: Progress | None = None) -> DataFrame:
    """Rows of the first cascade with matched_device (a product code, or why there is none) and device_level; ``log`` as there."""

    def settled(rows: DataFrame, label: str) -> DataFrame:
        out = written(rows, label)
        if log is not None:
            n, still = out.agg(F.count("*"), F.coalesce(F.sum(F.col("matched_device").isNull().cast("long")), F.lit(0))).first()
            log(label, int(n), int(still))
        return out

    ref = manufacturer_reference(catalogue, order).select(F.col("catalogue_manufacturers_index").alias("__i"), "Supplier", "Brand")
    rows = labelled.join(ref, F.col("Manufacturer_label") == F.col("__i"), "left").drop("__i")
    name = F.col("CLN_Manufacturer_Device_Name")
    rows = rows.withColumn("matched_device", F.when(F.col("Manufacturer_label") == -1, "manufacturer not in catalogue").when(name.isNull() | (name == ""), "null device"))
    rows = rows.withColumn("device_level", F.when(F.col("Manufacturer_label") == -1, "not_in_catalogue"))
    joined = lambda *c: F.concat_ws(" ", *(as_text(F.col(f"`{x}`")) for x in c))
    tokens = lambda c: clean_tokens(c, DEVICE_STOP, split_numbers=False)
    rows = rows.withColumns({"device_name_and_manufacturer_tokens": tokens(joined("Supplier", "CLN_Manufacturer_Device_Name")), "device_name_tokens": tokens(name)})
    cat = catalogue.withColumns({"catalogue_device_name_and_manufacturer_tokens": tokens(joined("Supplier", "Base Description", "Secondary Description")), "catalogue_device_tokens": tokens(joined("Base Description", "Secondary Description")), "primary_description_tokens": tokens(F.col("`Base Description`")), "secondary_description_tokens": tokens(F.col("`Secondary Description`"))})
    rows = matchers.exact_match(cat, rows, "catalogue_device_name_and_manufacturer_tokens", "NPC", "device_name_and_manufacturer_tokens", "matched_device", order, device_match=True)
    for text in ("CLN_Device_Serial_Number", "CLN_Manufacturer_Device_Name"):
        rows = settled(codes.device_code_level_matching(rows, cat, "matched_device", text, order), f"codes_{text}")
    for text in ("primary_description_tokens", "secondary_description_tokens"):
        rows = matchers.exact_match_with_supplier_filter(cat, rows, text, "NPC", "device_name_tokens", "matched_device", "Supplier", "Supplier", order)
    rows = settled(rows, "exact_supplier")
    rows = settled(tfidf.bag_of_words_matching(cat, rows, "catalogue_device_name_and_manufacturer_tokens", "device_name_and_manufacturer_tokens", config.first_similarity, order=order), "bag_of_words")
    return tfidf.bag_of_words_matching(cat, rows, "catalogue_device_tokens", "device_name_tokens", config.second_similarity, order=order)
