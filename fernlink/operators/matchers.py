"""Matchers: each finds a label for probe keys in a reference, and ``apply_hits`` writes labels to rows that have none.

A reference has an explicit order column (``ord``), which decides between equal
candidates. Hits have one row for each key that matched.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf
from pyspark.sql.types import DoubleType

from fernlink.functions.text import as_text
from fernlink.sources.tables import written


def require(df: DataFrame, *columns: str) -> None:
    missing = [c for c in columns if c not in df.columns]
    if missing:
        raise ValueError(f"missing columns: {', '.join(missing)}")


def keep_first(ref: DataFrame, text: str, label: str, order: str) -> DataFrame:
    """One row (text, label, ord) for each text: the first in order."""
    require(ref, text, label, order)
    return ref.groupBy(F.col(text).alias("text")).agg(F.min_by(F.struct(F.col(label).alias("l")), order).alias("_s"), F.min(order).alias("ord")).select("text", F.col("_s.l").alias("label"), "ord")


def keep_last(ref: DataFrame, text: str, label: str, order: str) -> DataFrame:
    """One row for each text: the order of the first, but the label of the last."""
    require(ref, text, label, order)
    return ref.groupBy(F.col(text).alias("text")).agg(F.max_by(F.struct(F.col(label).alias("l")), order).alias("_s"), F.min(order).alias("ord")).select("text", F.col("_s.l").alias("label"), "ord")


def open_keys(rows: DataFrame, label: str, *keys: str) -> DataFrame:
    """Distinct keys of the rows that have no label yet."""
    require(rows, label, *keys)
    return rows.where(F.col(label).isNull()).select(*keys).distinct()


def apply_hits(rows: DataFrame, hits: DataFrame, keys: dict[str, str], label: str, level: str, level_name: str, overwrite: bool = False, extra: tuple[str, ...] = ()) -> DataFrame:
    """Rows with the hits' labels where there was none; rows stay, and labelled rows do not change.

    ``keys``: probe column -> hit column; null equals null. ``overwrite``: the level
    of unlabelled rows without a hit becomes null, else it stays. ``extra`` columns of
    the hits are written to all unlabelled rows.
    """
    require(rows, label, *keys)
    taken = hits.select(*(F.col(h).alias(f"__m_{h}") for h in keys.values()), F.col("label").alias("__m_label"), *(F.col(x).alias(f"__m_{x}") for x in extra))
    on = [F.col(p).eqNullSafe(F.col(f"__m_{h}")) for p, h in keys.items()]
    condition = on[0]
    for c in on[1:]:
        condition = condition & c
    free = F.col(label).isNull()
    old = F.col(level) if level in rows.columns else F.lit(None).cast("string")
    hit = free & F.col("__m_label").isNotNull()
    new = {label: F.coalesce(F.col(label), F.col("__m_label")), level: F.when(hit, F.lit(level_name)).when(free & F.lit(overwrite), F.lit(None)).otherwise(old)}
    new |= {x: F.when(free, F.col(f"__m_{x}")).otherwise(F.col(x) if x in rows.columns else F.lit(None)) for x in extra}
    joined = rows.join(taken, condition, "left").withColumns(new)
    return joined.drop(*(c for c in joined.columns if c.startswith("__m_")))


def exact_hits(ref: DataFrame, text: str, label: str, order: str) -> DataFrame:
    return keep_first(ref, text, label, order).select(F.col("text").alias("key"), "label")


def exact_match(ref: DataFrame, rows: DataFrame, ref_text: str, ref_label: str, row_text: str, row_label: str, order: str, device_match: bool = False) -> DataFrame:
    """Equal texts; of repeated reference texts the first counts."""
    return apply_hits(rows, exact_hits(ref, ref_text, ref_label, order), {row_text: "key"}, row_label, "device_level" if device_match else "level", f"exact_match_{ref_text}", overwrite=True)


def exact_match_with_supplier_filter(ref: DataFrame, rows: DataFrame, ref_text: str, ref_label: str, row_text: str, row_label: str, row_supplier: str, ref_supplier: str, order: str) -> DataFrame:
    """Equal text and supplier; only the first reference row of a text can match, whatever its supplier."""
    require(ref, ref_text, ref_label, ref_supplier, order)
    first = ref.groupBy(F.col(ref_text).alias("key")).agg(F.min_by(F.struct(F.col(ref_label).alias("label"), F.col(ref_supplier).alias("supplier")), order).alias("s")).select("key", "s.*")
    return apply_hits(rows, first, {row_text: "key", row_supplier: "supplier"}, row_label, "device_level", f"exact_match_supplier_and_{ref_text}", overwrite=True)


def _code_points(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """A row of code points for each text, filled up with zeros, and the lengths."""
    lengths = np.fromiter(map(len, texts), np.int64, len(texts))
    wide = max(int(lengths.max(initial=0)), 1)
    out = np.zeros((len(texts), wide), np.uint32)
    out[np.arange(wide) < lengths[:, None]] = np.frombuffer("".join(texts).encode("utf-32-le", "surrogatepass"), "<u4")
    return out, lengths


def _similarities(left: list[str], right: list[str]) -> np.ndarray:
    """Textbook Jaro-Winkler similarities of pairs: all pairs take the steps over the left text's characters together."""
    a, n = _code_points(left)
    b, k = _code_points(right)
    rows, at = np.arange(len(a)), np.arange(b.shape[1])
    reach = np.maximum(np.maximum(n, k) // 2 - 1, 0)
    free = at < k[:, None]
    hit = np.zeros(a.shape, bool)
    for i in range(a.shape[1]):
        fits = free & (b == a[:, i, None]) & (np.abs(at - i) <= reach[:, None]) & (i < n)[:, None]
        first = fits.argmax(1)
        hit[:, i] = fits[rows, first]
        free[rows[hit[:, i]], first[hit[:, i]]] = False
    taken = ~free & (at < k[:, None])
    m = hit.sum(1)
    swaps = np.bincount(np.nonzero(hit)[0], a[hit] != b[taken], len(a)) / 2
    prefix = min(4, a.shape[1], b.shape[1])
    same = (a[:, :prefix] == b[:, :prefix]) & (np.arange(prefix) < np.minimum(n, k)[:, None])
    with np.errstate(divide="ignore", invalid="ignore"):
        jaro = np.where(m > 0, (m / n + m / k + (m - swaps) / m) / 3, 0.0)
    return jaro + 0.1 * np.logical_and.accumulate(same, 1).sum(1) * (1 - jaro)


def jaro_winkler_all(left: list[str], right: list[str], cells: int = 2_000_000) -> np.ndarray:
    """Textbook Jaro-Winkler similarity of each pair: common prefix of four at most, weight 0.1; 0 if a text is empty.

    Pairs go by their lengths in slices of a bounded number of characters.
    """
    out = np.zeros(len(left))
    size = np.fromiter((max(len(x), len(y)) for x, y in zip(left, right, strict=True)), np.int64, len(left))
    order = np.argsort(size, kind="stable")
    at = 0
    while at < len(order):
        end = at + 1
        while end < len(order) and (end + 1 - at) * size[order[end]] <= cells and size[order[end]] <= 2 * size[order[at]] + 8:
            end += 1
        some = order[at:end]
        out[some] = _similarities([left[i] for i in some], [right[i] for i in some])
        at = end
    return out


def jaro_winkler(a: str, b: str) -> float:
    return float(jaro_winkler_all([a], [b])[0])


@pandas_udf(DoubleType())
def _jaro_winkler(a, b):
    import pandas as pd

    return pd.Series(jaro_winkler_all(a.tolist(), b.tolist()))


def _marked(c: Column) -> Column:
    """The characters of a text, each with how often it occurred before: sets of these overlap in the number of common characters."""
    chars = F.filter(F.split(c, ""), lambda x: x != "")
    return F.transform(chars, lambda x, i: F.concat(x, F.size(F.filter(F.slice(chars, 1, i + 1), lambda y: y == x)).cast("string")))


def jaro_winkler_candidates(probe: DataFrame, refs: DataFrame, threshold: float) -> DataFrame:
    """Pairs of probe (key) and refs (text, label, ord) that may reach the threshold, each once; none that does is missing.

    A pair whose first p characters agree (four at most) needs a Jaro similarity of
    (threshold - p / 10) / (1 - p / 10), so with lengths a and b at least
    (3 jaro - 1) a b / (a + b) common characters. Pairs with p of 3 or 4 meet at these
    characters. The others meet at them, both lengths and the two least common of
    their shared marks (a character and its count so far), which are among the first
    few marks of either text by rarity. All marks are then compared.
    """
    texts = probe.select(F.col("key").alias("text")).unionByName(refs.select("text")).distinct()
    marks = texts.select("text", F.explode(_marked(F.col("text"))).alias("mark"))
    often = marks.groupBy("mark").agg(F.count("*").alias("n"))
    ranked = marks.join(often, "mark").groupBy("text").agg(F.array_sort(F.collect_list(F.struct("n", "mark"))).getField("mark").alias("marks"))
    ranked = written(ranked, "marks")
    left = probe.join(ranked.withColumnRenamed("text", "key"), "key").select("key", F.col("marks").alias("key_marks"), F.size("marks").alias("a"))
    right = refs.join(ranked, "text").select("text", "label", "ord", F.col("marks").alias("text_marks"), F.size("marks").alias("b"))
    most = ranked.agg(F.coalesce(F.max(F.size("marks")), F.lit(0))).first()[0]
    needs = [3 * (threshold - 0.1 * p) / (1 - 0.1 * p) - 1 for p in range(5)]
    common = lambda p: F.greatest(F.ceil(F.lit(needs[p]) * F.col("a") * F.col("b") / (F.col("a") + F.col("b")) - F.lit(1e-9)).cast("int"), F.lit(1))

    def met(side: DataFrame, text: str, own: str, other: str, p: int) -> DataFrame:
        """The side's rows with each length of the other text and each pair of marks (one, if one must be common) at which they can meet."""
        share = needs[p] - 1
        lo, hi = (F.ceil(F.col(own) * share - 1e-9), F.floor(F.col(own) / share + 1e-9)) if share > 0 else (F.lit(1), F.lit(most))
        lo, hi = F.greatest(lo.cast("int"), F.lit(1)), F.least(hi.cast("int"), F.lit(most))
        rows = side.where(hi >= lo).withColumn(other, F.explode(F.sequence(lo, hi))).withColumn("o", common(p)).where("o <= least(a, b)")
        first = F.slice(f"{text}_marks", F.lit(1), F.least(F.col(own), F.col(own) - F.col("o") + F.when(F.col("o") > 1, 2).otherwise(1)))
        pairs = F.flatten(F.transform(first, lambda x, i: F.transform(F.slice(first, i + 2, F.size(first)), lambda y: F.concat_ws(" ", x, y))))
        rows = rows.withColumn(f"{text}_first", first).withColumn("at", F.explode(F.when(F.col("o") > 1, pairs).otherwise(first)))
        return rows.withColumn("head", F.substring(text, 1, p)).where(F.length("head") == p)

    def headed(side: DataFrame, text: str, p: int) -> DataFrame:
        return side.withColumn("head", F.substring(text, 1, p)).where(F.length("head") == p).withColumn("p", F.lit(p))

    def each(ps: tuple[int, ...], make) -> DataFrame:
        first, *rest = (make(p).withColumn("p", F.lit(p)) for p in ps)
        for x in rest:
            first = first.unionByName(x)
        return first

    short = each((0, 1, 2), lambda p: met(left, "key", "a", "b", p))
    short = short.join(each((0, 1, 2), lambda p: met(right, "text", "b", "a", p).drop("o")), ["p", "head", "a", "b", "at"])
    shared = F.array_intersect("key_first", "text_first")
    owner = F.when(F.col("o") > 1, F.concat_ws(" ", F.slice(shared, 1, 2))).otherwise(F.get(shared, F.lit(0)))
    short = short.where(F.col("at") == owner)
    long_ = each((3, 4), lambda p: headed(left, "key", p)).join(each((3, 4), lambda p: headed(right, "text", p)), ["p", "head"])
    long_ = long_.withColumn("o", F.when(F.col("p") == 3, common(3)).otherwise(common(4))).where("o <= least(a, b)")
    wanted = ("key", "text", "label", "ord", "p", "o", "key_marks", "text_marks")
    agree = sum((F.when((F.substring("key", 1, n) == F.substring("text", 1, n)) & (F.least(F.length("key"), F.length("text")) >= n), 1).otherwise(0) for n in range(1, 5)), F.lit(0))
    every = short.select(*wanted).unionByName(long_.select(*wanted)).where(agree == F.col("p"))
    return every.where(F.size(F.array_intersect("key_marks", "text_marks")) >= F.col("o")).select("key", "text", "label", "ord")


def jaro_winkler_hits(keys: DataFrame, key: str, ref: DataFrame, text: str, label: str, order: str, threshold: float = 0.86, decimals: int | None = None) -> DataFrame:
    """key, label and score of the most similar reference text, if it reaches the threshold; the first of equals."""
    refs = keep_first(ref, text, label, order).where("text <> ''")
    probe = keys.select(F.col(key).alias("key")).where("key is not null and key <> ''").distinct()
    slack = 0.0 if decimals is None else 0.5 * 10**-decimals
    scored = jaro_winkler_candidates(probe, refs, threshold - slack).withColumn("score", _jaro_winkler("key", "text"))
    if decimals is not None:
        scored = scored.withColumn("score", F.round("score", decimals))
    best = scored.where(F.col("score") >= threshold).groupBy("key").agg(F.max_by(F.struct("label", "score"), F.struct("score", -F.col("ord"))).alias("b"))
    return best.select("key", "b.label", "b.score")


def jaro_winkler_match(rows: DataFrame, ref: DataFrame, label: str, text: str, ref_text: str, ref_label: str, order: str, threshold: float = 0.86) -> DataFrame:
    hits = jaro_winkler_hits(open_keys(rows, label, text), text, ref, ref_text, ref_label, order, threshold)
    return apply_hits(rows, hits, {text: "key"}, label, "level", f"jaro_winkler_match_{ref_text}")


def token_overlap_hits(keys: DataFrame, key: str, ref: DataFrame, tokens: str, label: str, order: str, threshold: float = 0.5) -> DataFrame:
    """key, label and score of the reference row of which the largest share of tokens is in the key's; a tie of rows matches none.

    ``key`` and ``tokens`` are lists. The share is of the reference's list, with its repeats.
    """
    probe = keys.select(F.col(key).alias("key")).where("key is not null").distinct()
    refs = ref.select(F.col(order).alias("ord"), F.col(label).alias("label"), F.col(tokens).alias("tokens"), F.greatest(F.coalesce(F.size(tokens), F.lit(0)), F.lit(1)).alias("n"))
    common = probe.withColumn("t", F.explode(F.array_distinct("key"))).join(refs.select("ord", "label", "n", F.explode(F.array_distinct("tokens")).alias("t")), "t")
    scored = common.groupBy("key", "ord", "label", "n").agg(F.count("*").alias("c")).withColumn("score", F.col("c") / F.col("n"))
    best = scored.groupBy("key").agg(F.max("score").alias("score"), F.max_by("label", "score").alias("label"), F.max(F.struct("score", "ord")).alias("hi"), F.min(F.struct(-F.col("score"), F.col("ord"))).alias("lo"))
    return best.where((F.col("hi.ord") == F.col("lo.ord")) & (F.col("score") > threshold)).select("key", "label", "score")


def number_of_tokens_match(rows: DataFrame, ref: DataFrame, label: str, tokens: str, ref_tokens: str, ref_label: str, order: str, threshold: float = 0.5) -> DataFrame:
    hits = token_overlap_hits(open_keys(rows, label, tokens), tokens, ref, ref_tokens, ref_label, order, threshold)
    return apply_hits(rows, hits, {tokens: "key"}, label, "level", f"token_overlap_match_{ref_tokens}")


def _containing(probe: DataFrame, text: str, refs: DataFrame, part: str) -> DataFrame:
    """Pairs where ``text`` contains the (not empty) ``part``: they meet at the part's first characters."""
    width = F.least(F.length(part), F.lit(4))
    grams = F.explode(F.array_distinct(F.flatten(F.transform(F.sequence(F.lit(1), F.lit(4)), lambda w: F.when(F.length(text) >= w, F.transform(F.sequence(F.lit(1), F.length(text) - w + 1), lambda i: F.substring(F.col(text), i, w))).otherwise(F.array().cast("array<string>"))))))
    return probe.where(F.length(text) > 0).withColumn("gram", grams).join(refs.where(F.length(part) > 0).withColumn("gram", F.substring(F.col(part), F.lit(1), width)), "gram").where(F.contains(text, part)).drop("gram")


def substring_hits(keys: DataFrame, key: str, ref: DataFrame, text: str, label: str, order: str, allow_empty: bool = True) -> DataFrame:
    """key and label of the first reference text that the key contains, case aside; its last row's label. An empty reference text is in every text."""
    refs = keep_last(ref.where(F.col(text).isNotNull()), text, label, order).withColumn("part", F.lower("text"))
    probe = keys.select(F.col(key).alias("key")).distinct().withColumn("whole", F.trim(F.lower(as_text(F.col("key"))))).where("whole <> ''")
    pairs = _containing(probe, "whole", refs, "part").select("key", "label", "ord")
    if allow_empty:
        empty = refs.where("part = ''").agg(F.min(F.struct("ord", "label")).alias("e")).where("e is not null").select(F.col("e.label").alias("label"), F.col("e.ord").alias("ord"), F.lit(0).alias("_"))
        pairs = pairs.unionByName(probe.withColumn("_", F.lit(0)).join(F.broadcast(empty), "_").select("key", "label", "ord"))  # one row at most
    return pairs.groupBy("key").agg(F.min_by(F.struct("label"), "ord").alias("b")).select("key", "b.label")


def substring_match(rows: DataFrame, ref: DataFrame, label: str, text: str, ref_text: str, ref_label: str, level: str, order: str, allow_empty: bool = True) -> DataFrame:
    return apply_hits(rows, substring_hits(open_keys(rows, label, text), text, ref, ref_text, ref_label, order, allow_empty), {text: "key"}, label, level, f"substring_match_{ref_text}")


def phrase_hits(keys: DataFrame, key: str, ref: DataFrame, text: str, label: str, order: str) -> DataFrame:
    """key and label of the longest reference phrase that stands between word borders in the key; the first of equal length."""
    refs = ref.where(F.col(text).isNotNull() & (F.trim(F.regexp_replace(text, r"\s", " ")) != "")).groupBy(F.lower(text).alias("part"), F.col(label).alias("label")).agg(F.min(order).alias("ord"))
    probe = keys.select(F.col(key).alias("key")).where("key is not null").distinct().withColumn("whole", F.lower("key"))
    quoted = F.concat(F.lit(r"(?U)\b\Q"), F.replace(F.col("part"), F.lit(r"\E"), F.lit(r"\E\\E\Q")), F.lit(r"\E\b"))
    pairs = _containing(probe, "whole", refs, "part").where(F.regexp_like("whole", quoted))
    return pairs.groupBy("key").agg(F.max_by(F.struct("label"), F.struct(F.length("part"), -F.col("ord"))).alias("b")).select("key", "b.label")


def catalogue_manufacturer_in_device_name_matching(rows: DataFrame, ref: DataFrame, label: str, text: str, ref_text: str, ref_label: str, order: str) -> DataFrame:
    return apply_hits(rows, phrase_hits(open_keys(rows, label, text), text, ref, ref_text, ref_label, order), {text: "key"}, label, "level", f"catalogue_manufacturer_in_device_name_match_{ref_text}", overwrite=True)
