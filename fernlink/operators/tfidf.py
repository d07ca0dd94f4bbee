"""TF-IDF cosine similarity by an inverted-index join over weighted terms."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from fernlink.functions.text import ENGLISH_STOP
from fernlink.operators.matchers import apply_hits, require
from fernlink.sources.tables import written


def terms(c: Column) -> Column:
    """Words of two characters and more without stop words, and pairs of neighbours among these."""
    words = F.filter(F.regexp_extract_all(F.lower(F.coalesce(c, F.lit(""))), F.lit(r"(?U)\b(\w\w+)\b"), 1), lambda w: ~w.isin(*ENGLISH_STOP))
    pairs = F.when(F.size(words) > 1, F.zip_with(F.slice(words, 1, F.size(words) - 1), F.slice(words, 2, F.size(words)), lambda a, b: F.concat_ws(" ", a, b))).otherwise(F.array().cast("array<string>"))
    return F.concat(words, pairs)


def vectors(texts: DataFrame, corpus: DataFrame) -> DataFrame:
    """text, term, weight of unit length for the distinct ``texts``; ``corpus``: text and n, how many rows have it."""
    every = corpus.groupBy("text").agg(F.sum("n").alias("n"))
    counted = every.withColumn("term", F.explode(F.array_distinct(terms(F.col("text"))))).groupBy("term").agg(F.sum("n").alias("df"))
    total = every.agg(F.sum("n").alias("total")).first().total or 0
    idf = counted.select("term", (F.log((F.lit(1.0) + total) / (F.lit(1.0) + F.col("df"))) + 1).alias("idf"))
    tf = texts.select("text").distinct().withColumn("term", F.explode(terms(F.col("text")))).groupBy("text", "term").agg(F.count("*").alias("tf"))
    raw = tf.join(idf, "term").withColumn("w", F.col("tf") * F.col("idf"))
    norm = raw.groupBy("text").agg(F.sqrt(F.sum(F.col("w") * F.col("w"))).alias("norm"))
    return raw.join(norm, "text").select("text", "term", (F.col("w") / F.col("norm")).alias("weight"))


def similarities(left: DataFrame, right: DataFrame, corpus: DataFrame) -> DataFrame:
    """text, ref_text and score (12 digits) of each pair with a common term."""
    a = vectors(left, corpus).withColumnsRenamed({"weight": "wa"})
    b = vectors(right, corpus).withColumnsRenamed({"weight": "wb", "text": "ref_text"})
    return a.join(b, "term").groupBy("text", "ref_text").agg(F.round(F.sum(F.col("wa") * F.col("wb")), 12).alias("score"))


def supplier_hits(texts: DataFrame, ref: DataFrame, text: str, label: str, order: str, threshold: float = 0.7) -> DataFrame:
    """key, label and score for ``texts`` (text, n): the most similar reference, the first of equals, over the threshold; else a null label."""
    refs = ref.select(F.coalesce(text, F.lit("")).alias("text"), F.col(label).alias("label"), F.col(order).alias("ord"))
    corpus = texts.select(F.coalesce("text", F.lit("")).alias("text"), "n").unionByName(refs.groupBy("text").agg(F.count("*").alias("n")))
    first = refs.groupBy(F.col("text").alias("ref_text")).agg(F.min_by(F.struct("label"), "ord").alias("l"), F.min("ord").alias("ord"))
    best = similarities(texts.where("text is not null"), refs, corpus).join(first, "ref_text").groupBy("text").agg(F.max_by(F.struct("l", "score"), F.struct("score", -F.col("ord"))).alias("b"))
    return best.select(F.col("text").alias("key"), F.when(F.col("b.score") > threshold, F.col("b.l.label")).alias("label"), F.col("b.score").alias("score"))


def bag_of_words_supplier_matching(rows: DataFrame, ref: DataFrame, label: str, score: str, text: str, ref_text: str, ref_label: str, level: str, order: str) -> DataFrame:
    require(rows, label, text)
    texts = rows.where(F.col(label).isNull()).groupBy(F.col(text).alias("text")).agg(F.count("*").alias("n"))
    hits = supplier_hits(texts, ref, ref_text, ref_label, order).withColumnRenamed("score", score)
    out = apply_hits(rows.withColumn("__free", F.col(label).isNull()), hits, {text: "key"}, label, level, f"bag_of_words_match_{ref_text}", extra=(score,))
    return out.withColumn(score, F.when(F.col("__free"), F.coalesce(score, F.lit(0.0))).otherwise(F.col(score))).drop("__free")


def _ties(asked: DataFrame, posts: DataFrame) -> DataFrame:
    """key, wide, scope, score and ref_texts: of each posting chunk that a probe asks for, the best score and the references that have it."""
    on = ["wide", "scope", "term", "chunk"]
    needed = asked.select(*on).distinct().withColumnsRenamed({c: f"__{c}" for c in on})
    same = [F.col(c).eqNullSafe(F.col(f"__{c}")) for c in on]
    lists = posts.join(needed, same, "left_semi").groupBy(*on).agg(F.collect_list(F.struct("ref_text", "bag")).alias("refs")).withColumnsRenamed({c: f"__{c}" for c in on})

    def score(r: Column) -> Column:
        return F.round(F.aggregate("terms", F.lit(0.0), lambda s, x: s + x["wa"] * F.coalesce(F.try_element_at(r["bag"], x["term"]), F.lit(0.0))), 12)

    scored = asked.join(lists, same).select("key", "wide", "scope", F.transform("refs", lambda r: F.struct(score(r).alias("score"), r["ref_text"].alias("ref_text"))).alias("refs"))
    best = scored.select("key", "wide", "scope", "refs", F.array_max(F.transform("refs", lambda r: r["score"])).alias("score"))
    return best.select("key", "wide", "scope", "score", F.transform(F.filter("refs", lambda r: r["score"] == F.col("score")), lambda r: r["ref_text"]).alias("ref_texts"))


def nearest(probes: DataFrame, members: DataFrame, vec: DataFrame, chunk: int = 256, first: int = 64) -> DataFrame:
    """key, wide, scope, ref_text and best: for each probe (key, wide, scope) the members of its scope (wide, scope, ref_text) of highest score, all of equals.

    Exact, and without all pairs of a common term. A probe's terms are taken from the
    rarest of its scope on. Members without any of the terms so far score at most the
    sum over the other terms of the probe's weight times the highest weight there, and
    at most the length of the probe's vector in these terms. The rarest terms (``first``
    postings, or one term) give a score that is surely reached; further terms are looked
    up only while what they could reach is not below it. Postings are met in chunks of
    about ``chunk`` members, so a common term is spread. ``vec``: text, term and weight.
    """
    words = vec.select(F.col("text").alias("ref_text"), "term", F.col("weight").alias("wb"))
    bags = words.groupBy("ref_text").agg(F.map_from_entries(F.collect_list(F.struct("term", "wb"))).alias("bag"))
    listed = members.join(words, "ref_text")
    stats = listed.groupBy("wide", "scope", "term").agg(F.count("*").alias("n"), F.max("wb").alias("most"))
    chunks = F.ceil(F.col("n") / chunk).cast("int")
    stat = written(stats, "term-stats").withColumnsRenamed({c: f"__{c}" for c in ("wide", "scope", "term")})
    same = [F.col(c).eqNullSafe(F.col(f"__{c}")) for c in ("wide", "scope", "term")]
    met = probes.join(vec.select(F.col("text").alias("key"), "term", F.col("weight").alias("wa")), "key").join(stat, same).select("key", "wide", "scope", "term", "wa", "n", "most")
    # what the terms from each on can reach: terms of a probe in order, the rarest first
    order = Window.partitionBy("key", "wide", "scope").orderBy("n", "term")
    later = order.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    reach = F.least(F.sum(F.col("wa") * F.col("most")).over(later), F.sqrt(F.sum(F.col("wa") * F.col("wa")).over(later)))
    whole = order.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    met = met.withColumns({"reach": reach, "early": (F.row_number().over(order) == 1) | (F.sum("n").over(order.rowsBetween(Window.unboundedPreceding, Window.currentRow)) <= first), "terms": F.collect_list(F.struct("term", "wa")).over(whole)})
    met = written(met, "probe-terms")
    posts = listed.join(stat, same).select("wide", "scope", "term", "ref_text", F.pmod(F.xxhash64("ref_text"), chunks).cast("int").alias("chunk")).join(bags, "ref_text")
    dealt = lambda rows: rows.withColumn("chunk", F.explode(F.sequence(F.lit(0), chunks - 1)))
    early = written(_ties(dealt(met.where("early")), posts), "probe-ties")
    reached = early.groupBy(F.col("key").alias("__key"), F.col("wide").alias("__wide"), F.col("scope").alias("__scope")).agg(F.max("score").alias("reached"))
    probe = [F.col(c).eqNullSafe(F.col(f"__{c}")) for c in ("key", "wide", "scope")]
    open_terms = met.where("not early").join(reached, probe).where(F.col("reach") > F.col("reached") - 1e-9).select(*met.columns)  # far above the errors of sums
    every = early.unionByName(_ties(dealt(open_terms), posts))
    top = every.withColumn("best", F.max("score").over(Window.partitionBy("key", "wide", "scope"))).where("score = best")
    return written(top.select("key", "wide", "scope", F.explode("ref_texts").alias("ref_text"), "best").distinct(), "nearest")  # a member may be met by several terms


def device_hits(probe: DataFrame, catalogue: DataFrame, text: str, threshold: float, supplier: str = "Supplier", npc: str = "NPC", order: str = "ref_ord") -> DataFrame:
    """For probe rows (text, supplier, n): best_similarity, best_match_devices, n_best_matches, and label if the best is unique.

    Candidates are the catalogue rows of the same supplier; all rows where the supplier
    is null or not in the catalogue. Without a common term the similarity is 0. The
    devices are the codes of all catalogue rows that share the best similarity, in the
    catalogue's order. An empty catalogue has no hits.
    """
    refs = catalogue.select(F.coalesce(text, F.lit("")).alias("ref_text"), F.col(supplier).alias("supplier"), F.col(npc).alias("npc"), F.col(order).alias("ord"))
    texts = probe.select(F.coalesce("text", F.lit("")).alias("text"), "n")
    corpus = texts.unionByName(refs.groupBy(F.col("ref_text").alias("text")).agg(F.count("*").alias("n")))
    known = refs.where("supplier is not null").select("supplier").distinct().withColumn("known", F.lit(True))
    asked = probe.select(F.coalesce("text", F.lit("")).alias("key"), "supplier").distinct().join(known, "supplier", "left")
    asked = asked.select("key", "supplier", F.col("known").isNull().alias("wide"), F.when(F.col("known"), F.col("supplier")).alias("scope"))
    own = refs.where("supplier is not null").select(F.lit(False).alias("wide"), F.col("supplier").alias("scope"), "ref_text")
    members = own.unionByName(refs.select(F.lit(True).alias("wide"), F.lit(None).cast(refs.schema["supplier"].dataType).alias("scope"), "ref_text")).distinct()
    members = written(members, "members")
    vec = written(vectors(corpus, corpus), "term-vectors")
    top = nearest(asked.select("key", "wide", "scope").distinct(), members, vec)
    by = ["key", "wide", "scope"]
    over = top.where(F.col("best") > threshold).drop("best")  # only these name their devices
    devices = over.where("not wide").join(refs.withColumnRenamed("supplier", "scope"), ["scope", "ref_text"]).select(*by, "ord", "npc")
    devices = devices.unionByName(over.where("wide").join(refs.drop("supplier"), "ref_text").select(*by, "ord", "npc"))
    same = lambda x: [F.col(c).eqNullSafe(F.col(f"__{c}{x}")) for c in by]
    named = lambda x: [F.col(c).alias(f"__{c}{x}") for c in by]
    npcs = devices.groupBy(*named(1)).agg(F.array_sort(F.collect_list(F.struct("ord", "npc"))).getField("npc").alias("npcs"), F.count("*").alias("count"))
    best = top.groupBy(*named(2)).agg(F.max("best").alias("best"))
    some = asked.join(refs.limit(1).select(F.lit(True).alias("__any")), F.lit(True))  # one row at most: nothing is asked of an empty catalogue
    listed = some.join(best, same(2), "left").join(npcs, same(1), "left")
    ok = F.coalesce(F.col("best") > threshold, F.lit(False))
    return listed.select(
        "key", "supplier", F.coalesce("best", F.lit(0.0)).alias("best_similarity"),
        F.when(ok, F.col("npcs")).otherwise(F.array().cast("array<string>")).alias("best_match_devices"),
        F.when(ok, F.col("count")).otherwise(F.lit(0)).cast("long").alias("n_best_matches"),
        F.when(ok & (F.col("count") == 1), F.get("npcs", F.lit(0))).alias("label"),
    )


def bag_of_words_matching(catalogue: DataFrame, rows: DataFrame, catalogue_text: str, text: str, threshold: float = 0.7, label: str = "matched_device", supplier: str = "Supplier", order: str = "ref_ord") -> DataFrame:
    """Unique best by similarity; an empty catalogue leaves the rows as they are, with a null similarity.

    ``best_match_devices`` names the product code of every catalogue row that ties for
    the best. Rows that have a label keep what an earlier call found for them.
    """
    require(rows, label, text, supplier)
    extra = ("best_similarity", "n_best_matches", "best_match_devices")
    probe = rows.where(F.col(label).isNull()).groupBy(F.col(text).alias("text"), F.col(supplier).alias("supplier")).agg(F.count("*").alias("n"))
    hits = device_hits(probe, catalogue, catalogue_text, threshold, supplier, order=order)
    keyed = rows.withColumn("__text", F.coalesce(text, F.lit("")))
    return apply_hits(keyed, hits, {"__text": "key", supplier: "supplier"}, label, "device_level", f"bag_of_words_match_{threshold}", extra=extra).drop("__text")
