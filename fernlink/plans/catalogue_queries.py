"""Queries of the record-linkage operators over catalogue and device views of the TPC-H-like tables, with SQL for DuckDB."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fernlink.functions.text import ENGLISH_STOP, MANUFACTURER_STOP, clean_tokens, token_list
from fernlink.operators import codes, evaluation, matchers, tfidf
from fernlink.plans import cascade

_CATALOGUE = """
select p_partkey as ref_ord, p_name as supplier, p_brand as brand,
  concat('ABC', lpad(cast(p_partkey as varchar(20)), 5, '0')) as npc,
  concat('MPX', lpad(cast(p_partkey + case when p_partkey % 10 = 0 then 1 else 0 end as varchar(20)), 5, '0')) as mpc,
  concat('50', lpad(cast(p_partkey as varchar(20)), 11, '0')) as ean,
  p_type as base_description, p_name as secondary_description
from {part}
"""
_DEVICES = """
select o_orderkey as row_id,
  case o_orderkey % 8 when 0 then upper(p_name) when 1 then concat(p_name, ' Ltd.') when 2 then concat('x', p_name, 'y') when 3 then replace(p_name, 'd', 'dd')
    when 4 then concat(split_part(p_name, ' ', 2), ' ', split_part(p_name, ' ', 1)) when 5 then null when 6 then 'NHS (UK)' else p_brand end as manufacturer,
  case o_orderkey % 6 when 0 then concat('model ABC-', lpad(cast(p_partkey as varchar(20)), 5, '0'), ' v') when 1 then concat('kit MPX ', lpad(cast(p_partkey as varchar(20)), 5, '0'))
    when 2 then concat('EAN 50', lpad(cast(p_partkey as varchar(20)), 11, '0')) when 3 then concat('The ', upper(p_name), ', large') when 4 then null else concat(p_name, 'like') end as device_name
from {orders} join {part} on p_partkey = o_orderkey % {n}
"""


def catalogue(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = spark.sql(_CATALOGUE, part=spark.read.parquet(f"{sf_dir}/part.parquet"))
    return df.withColumnsRenamed({"supplier": "Supplier", "brand": "Brand", "npc": "NPC", "mpc": "MPC", "ean": "EAN/GTIN", "base_description": "Base Description", "secondary_description": "Secondary Description"})


def devices(spark: SparkSession, sf_dir: str) -> DataFrame:
    part = spark.read.parquet(f"{sf_dir}/part.parquet")
    return spark.sql(_DEVICES.replace("{n}", str(max(part.count(), 1))), part=part, orders=spark.read.parquet(f"{sf_dir}/orders.parquet"))


def _clean_sql(c: str) -> str:
    stop = ", ".join(f"'{t}'" for t in MANUFACTURER_STOP)
    steps = f"lower(coalesce({c}, ''))"
    for pattern, new in (("[^a-z0-9]", " "), (r"non\s+", "non"), ("([0-9]+)", r" \1 ")):
        steps = f"regexp_replace({steps}, '{pattern}', '{new}', 'g')"
    return f"array_to_string(list_filter(regexp_split_to_array(trim({steps}), '\\s+'), lambda x: x <> '' and x not in ({stop})), ' ')"


_WITH = f"""
with catalogue as ({_CATALOGUE.format(part="part")}), devices as ({_DEVICES.format(orders="orders", part="part", n="(select count(*) from part)")}),
  ref as (select *, {_clean_sql("supplier")} as text from catalogue),
  probe as (select *, {_clean_sql("manufacturer")} as tokens from devices),
  firsts as (select text, min(ref_ord) as first, max(ref_ord) as last from ref group by text)
"""


def _ref(spark: SparkSession, sf_dir: str) -> DataFrame:
    return catalogue(spark, sf_dir).withColumn("text", clean_tokens(F.col("Supplier"), MANUFACTURER_STOP)).withColumn("list", token_list(F.col("text")))


def _probe(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = devices(spark, sf_dir).withColumn("tokens", clean_tokens(F.col("manufacturer"), MANUFACTURER_STOP))
    return d.withColumn("list", token_list(F.col("tokens"))).withColumn("label", F.lit(None).cast("long"))


def _labelled(spark: SparkSession, sf_dir: str, hits: DataFrame, key: str = "tokens") -> DataFrame:
    return matchers.apply_hits(_probe(spark, sf_dir), hits, {key: "key"}, "label", "level", "hit").select("row_id", "label")


def q_clean_tokens(spark, sf_dir):
    return _probe(spark, sf_dir).select("row_id", "tokens", F.size("list").cast("long").alias("n_tokens"))


def q_exact_first(spark, sf_dir):
    return matchers.exact_match(_ref(spark, sf_dir), _probe(spark, sf_dir), "text", "ref_ord", "tokens", "label", "ref_ord").select("row_id", "label", "level")


def q_exact_supplier(spark, sf_dir):
    ref = catalogue(spark, sf_dir).withColumn("d", clean_tokens(F.col("Secondary Description"), MANUFACTURER_STOP))
    rows = _probe(spark, sf_dir).withColumn("brand", F.when(F.col("row_id") % 2 == 0, F.lit("Brand#13")).otherwise(F.lit("Brand#21"))).withColumn("code", F.lit(None).cast("string"))
    return matchers.exact_match_with_supplier_filter(ref, rows, "d", "NPC", "tokens", "code", "brand", "Brand", "ref_ord").select("row_id", "code", F.col("device_level").alias("level"))


def q_substring_first(spark, sf_dir):
    p = _probe(spark, sf_dir)
    return _labelled(spark, sf_dir, matchers.substring_hits(p.select("tokens"), "tokens", _ref(spark, sf_dir), "text", "ref_ord", "ref_ord"))


def q_phrase_longest(spark, sf_dir):
    return _labelled(spark, sf_dir, matchers.phrase_hits(devices(spark, sf_dir), "device_name", _ref(spark, sf_dir), "Supplier", "ref_ord", "ref_ord"), "device_name")


def q_jw_best(spark, sf_dir):
    hits = matchers.jaro_winkler_hits(_probe(spark, sf_dir), "tokens", _ref(spark, sf_dir), "text", "ref_ord", "ref_ord", 0.9)
    return hits.select("key", "label", F.round("score", 9).alias("score"))


def _overlap(spark, sf_dir, distinct: bool):
    ref = _ref(spark, sf_dir)
    if distinct:
        ref = ref.groupBy("text").agg(F.min("ref_ord").alias("ref_ord")).withColumn("list", token_list(F.col("text")))
    hits = matchers.token_overlap_hits(_probe(spark, sf_dir), "list", ref, "list", "ref_ord", "ref_ord", 0.5)
    return hits.select(F.array_join("key", " ").alias("key"), "label", F.round("score", 9).alias("score"))


def q_token_overlap_unique(spark, sf_dir):
    return _overlap(spark, sf_dir, True)


def q_token_overlap_ties(spark, sf_dir):
    return _overlap(spark, sf_dir, False)


def q_tfidf_argmax(spark, sf_dir):
    texts = _probe(spark, sf_dir).groupBy(F.col("tokens").alias("text")).agg(F.count("*").alias("n"))
    return tfidf.supplier_hits(texts, _ref(spark, sf_dir), "text", "ref_ord", "ref_ord").where("label is not null").select("key", "label", F.round("score", 9).alias("score"))


def q_tfidf_blocked_unique(spark, sf_dir):
    cat = catalogue(spark, sf_dir).withColumn("t", F.lower(F.concat_ws(" ", "Secondary Description", "Base Description", F.substring("NPC", 4, 4))))
    probe = cat.groupBy(F.lower(F.concat_ws(" ", "Secondary Description", F.substring("NPC", 4, 4))).alias("text"), F.when(F.col("ref_ord") % 2 == 0, F.col("Supplier")).alias("supplier")).agg(F.count("*").alias("n"))
    return tfidf.device_hits(probe, cat, "t", 0.3).select("key", "supplier", F.round("best_similarity", 9).alias("best_similarity"), "n_best_matches", "label", F.array_join("best_match_devices", ",").alias("devices"))


def _codes(spark, sf_dir):
    return codes.code_hits(devices(spark, sf_dir), "device_name", catalogue(spark, sf_dir))


def _code(kind: str):
    return lambda spark, sf_dir: _codes(spark, sf_dir).where(F.col("kind") == kind).select("key", "label")


def q_code_priority(spark, sf_dir):
    return _codes(spark, sf_dir).where("kind is not null or codes_failed_to_match is not null").select("key", "label", "kind", F.col("codes_failed_to_match").alias("failed"))


def q_distinct_keep_first(spark, sf_dir):
    return matchers.keep_first(_ref(spark, sf_dir), "text", "ref_ord", "ref_ord").select("text", "label")


def q_distinct_keep_last(spark, sf_dir):
    return matchers.keep_last(_ref(spark, sf_dir), "text", "ref_ord", "ref_ord").select("text", "label")


def q_null_label_flags(spark, sf_dir):
    return _probe(spark, sf_dir).select("row_id", F.when(F.col("tokens") == "", F.lit(-99)).cast("long").alias("label"))


def q_label_left_join(spark, sf_dir):
    ref = cascade.manufacturer_reference(catalogue(spark, sf_dir)).withColumnRenamed("catalogue_manufacturers_index", "label")
    return q_exact_first(spark, sf_dir).select("row_id", "label").join(ref, "label", "left").select("row_id", "label", F.col("Supplier").alias("supplier"), F.col("Brand").alias("brand"))


def q_level_counts(spark, sf_dir):
    return evaluation.level_counts(q_exact_first(spark, sf_dir), "label", "level")


def q_unmatched_pct(spark, sf_dir):
    return evaluation.unmatched_pct(q_exact_first(spark, sf_dir), "label")


def _stratified(spark, sf_dir):
    return evaluation.stratified_proportional_sample(spark.read.parquet(f"{sf_dir}/customer.parquet"), "c_mktsegment", "c_custkey", 100)


def q_stratified_allocation(spark, sf_dir):
    return _stratified(spark, sf_dir)[1].select(F.col("c_mktsegment").alias("segment"), "n")


def q_stratified_sample(spark, sf_dir):
    return _stratified(spark, sf_dir)[0].select("c_custkey", "c_mktsegment")


def q_review_merge(spark, sf_dir):
    rows = devices(spark, sf_dir)
    given = rows.where("row_id % 5 = 0").select("row_id", F.when(F.col("row_id") % 10 == 0, F.lit("yes")).otherwise(F.lit("")).alias("manufacturer_match"), F.lit("").alias("manufacturer_comment"), F.when(F.col("row_id") % 15 == 0, F.lit("no")).alias("device_match"), F.lit(None).cast("string").alias("device_comment"))
    return evaluation.apply_reviews(rows, given, "row_id").select("row_id", "manufacturer_match", "device_match")


def q_label_merge_back(spark, sf_dir):
    rows = devices(spark, sf_dir)
    labelled = rows.where("row_id % 3 = 0").select("row_id", F.concat(F.lit("g"), F.col("row_id").cast("string")).alias("golden_label"))
    return evaluation.merge_labels(rows, labelled, "row_id").select("row_id", "golden_label")


def _cascade_rows(spark, sf_dir):
    d = devices(spark, sf_dir).select(F.col("row_id").alias("index"), F.col("manufacturer").alias("CLN_Manufacturer"), F.col("device_name").alias("CLN_Manufacturer_Device_Name"), F.when(F.col("row_id") % 4 == 0, F.concat(F.lit("sn "), F.col("device_name"))).alias("CLN_Device_Serial_Number"))
    missing = spark.createDataFrame([("Acme Devices",), ("Nowhere Medical Ltd",)], "Supplier_missing string")
    return cascade.manufacturer_cascade(d, catalogue(spark, sf_dir), missing)


def q_manufacturer_cascade(spark, sf_dir):
    return _cascade_rows(spark, sf_dir).select("index", "CLN_Manufacturer", "CLN_Manufacturer_tokens", F.col("Manufacturer_label").alias("label"), "level")


def q_device_cascade(spark, sf_dir):
    return cascade.device_cascade(_cascade_rows(spark, sf_dir), catalogue(spark, sf_dir)).select("index", "Manufacturer_label", "matched_device", "device_level", "codes_failed_to_match", F.round("best_similarity", 9).alias("best_similarity"), "n_best_matches")


QUERIES = {name[2:]: f for name, f in list(globals().items()) if name.startswith("q_")}
QUERIES |= {"code_npc": _code("npc"), "code_mpc": _code("mpc"), "code_ean": _code("ean")}

_STOP_SQL = ", ".join(f"'{w}'" for w in ENGLISH_STOP)


def _terms_sql(c: str) -> str:
    words = f"list_filter(regexp_extract_all(lower({c}), '\\w\\w+'), lambda w: w not in ({_STOP_SQL}))"
    return f"(select list_concat(w, list_transform(range(1, greatest(len(w), 1)), lambda i: w[i] || ' ' || w[i + 1])) from (select {words} as w))"


_VECTORS = f"""
  corpus as (select 'p' as side, text from asked_rows union all select 'r', text from ref_rows),
  total as (select count(*) as n from corpus),
  texts as (select distinct text from corpus),
  term_lists as (select text, {_terms_sql("text")} as ts from texts),
  tf as (select text, term, count(*) as tf from (select text, unnest(ts) as term from term_lists) group by all),
  dfs as (select term, count(*) as df from corpus join (select distinct text, term from tf) using (text) group by term),
  raw as (select text, term, tf * (ln((1.0 + n) / (1.0 + df)) + 1) as w from tf join dfs using (term), total),
  vec as (select r.text, r.term, r.w / norm as w from raw r join (select text, sqrt(sum(w * w)) as norm from raw group by text) using (text)),
  sims as (select a.text as key, b.text as ref_text, round(sum(a.w * b.w), 12) as score from vec a join vec b using (term)
    where a.text in (select text from asked_rows) and b.text in (select text from ref_rows) group by all)
"""
_BEST_JW = """, scored as (select tokens as key, first, jaro_winkler_similarity(tokens, text) as s from (select distinct tokens from probe where tokens <> '') cross join firsts where text <> ''),
  best as (select key, first, s, row_number() over (partition by key order by s desc, first) as k from scored where s >= 0.9)"""


def _overlap_sql(refs: str) -> str:
    return (
        _WITH
        + f""", refs as ({refs}), keys as (select distinct tokens as key, list_filter(string_split(tokens, ' '), lambda x: x <> '') as kl from probe),
  scored as (select key, ref_ord, len(list_intersect(kl, rl))::double / greatest(len(rl), 1) as s from keys cross join (select ref_ord, list_filter(string_split(text, ' '), lambda x: x <> '') as rl from refs)),
  best as (select key, max(s) as s from scored where s > 0 group by key)
select key, any_value(ref_ord) as label, round(any_value(s), 9) as score from scored join best using (key, s) where s > 0.5 group by key having count(*) = 1"""
    )


_CODE_SQL = (
    _WITH
    + """, keys as (select distinct device_name as key, coalesce(device_name, 'nan') as t from devices),
  f as (select key, nullif(regexp_extract(t, '(?i)\\bABC[- ]?[0-9]+\\b'), '') as nh, nullif(regexp_extract(t, '(?i)\\bMPX[- ]?[0-9]{5}\\b'), '') as mh, nullif(regexp_extract(t, '(?i)\\b50[0-9][- ]?[0-9]{10}\\b'), '') as eh from keys),
  g as (select key, regexp_replace(nh, '[- ]', '', 'g') as n, regexp_replace(mh, '[- ]', '', 'g') as m, regexp_replace(eh, '[- ]', '', 'g') as e from f),
  nk as (select npc from catalogue), mk as (select mpc, count(*) as c, min(npc) as npc from catalogue group by mpc), ek as (select ean, count(*) as c, min(npc) as npc from catalogue group by ean),
  h as (select key, n, m, e, exists (select 1 from nk where npc = n) as n_ok, (select c from mk where mpc = m) as mc, (select npc from mk where mpc = m) as mn, (select c from ek where ean = e) as ec, (select npc from ek where ean = e) as en from g),
  r as (select key, case when n_ok then n when mc = 1 then mn when ec = 1 then en end as label, case when n_ok then 'npc' when mc = 1 then 'mpc' when ec = 1 then 'ean' end as kind,
    case when n_ok or mc = 1 or ec = 1 then null when ec > 1 then e when mc > 1 then m else n end as failed from h)
"""
)



def _cascade_steps(name: str, refs: str) -> str:
    """Hits of each matcher for one reference ``refs`` (idx, o, text): tables exact, jw, ov and ph with the name's suffix."""
    return f"""
  exact_{name} as (select text as tokens, arg_min(idx, o) as label from {refs} where text <> '' group by text),
  jw_{name} as (select tokens, arg_min(label, (-s, o)) as label from (select tokens, r.idx as label, o, jaro_winkler_similarity(tokens, text) as s from tk cross join (select text, arg_min(idx, o) as idx, min(o) as o from {refs} where text <> '' group by text) r) where s >= 0.9 group by tokens),
  ovs_{name} as (select tokens, idx, len(list_intersect(kl, rl))::double / greatest(len(rl), 1) as s from tk cross join (select idx, list_filter(string_split(text, ' '), lambda x: x <> '') as rl from {refs})),
  ov_{name} as (select tokens, any_value(idx) as label from ovs_{name} join (select tokens, max(s) as s from ovs_{name} where s > 0 group by tokens) using (tokens, s) where s > 0.5 group by tokens having count(*) = 1),
  ph_{name} as (select device_name, arg_min(idx, (-length(text), o)) as label from (select distinct device_name from devices where device_name is not null) join {refs} on text <> '' and contains(lower(device_name), text) and regexp_matches(lower(device_name), '\\b' || text || '\\b') group by device_name)"""


def _first_sql(steps: list[tuple[str, str]], label: str = "label", level: str = "level") -> str:
    """Columns with the first hit of the steps (column, level name)."""
    whens = " ".join(f"when {c} is not null then '{n}'" for c, n in steps)
    return f"coalesce({', '.join(c for c, _ in steps)}) as {label}, case {whens} end as {level}"


_PHRASE = "catalogue_manufacturer_in_device_name_match"
_EARLY = [
    ("b", "null_level"), ("exact_miss.label", "exact_match_Supplier_missing_tokens"), ("jw_miss.label", "jaro_winkler_match_Supplier_missing_tokens"), ("ov_miss.label", "token_overlap_match_Supplier_missing_tokens_list"),
    ("ph_miss.label", f"{_PHRASE}_Supplier_missing_tokens"), ("exact_sup.label", "exact_match_Supplier_tokens"), ("sub.label", "substring_match_Supplier_tokens"), ("jw_sup.label", "jaro_winkler_match_Supplier_tokens"), ("ov_sup.label", "token_overlap_match_Supplier_tokens_list"),
]
_LATE = [
    ("early.label", ""), ("bow.label", "bag_of_words_match_Supplier_tokens"), ("ph_sup.label", f"{_PHRASE}_Supplier_tokens"), ("exact_brd.label", "exact_match_Brand_tokens"),
    ("jw_brd.label", "jaro_winkler_match_Brand_tokens"), ("ov_brd.label", "token_overlap_match_Brand_tokens_list"), ("ph_brd.label", f"{_PHRASE}_Brand_tokens"),
]
_MANUFACTURERS = (
    _WITH
    + f""", mref as (select supplier, brand, min(ref_ord) as idx from catalogue group by all),
  miss as (select {_clean_sql("s")} as text, -1 as idx, s as o from (values ('Acme Devices'), ('Nowhere Medical Ltd')) as t(s)),
  sup as (select {_clean_sql("supplier")} as text, idx, idx as o from mref), brd as (select {_clean_sql("brand")} as text, idx, idx as o from mref),
  tk as (select tokens, list_filter(string_split(tokens, ' '), lambda x: x <> '') as kl from (select distinct tokens from probe where tokens <> '')),
  {_cascade_steps("miss", "miss")}, {_cascade_steps("sup", "sup")}, {_cascade_steps("brd", "brd")},
  sub as (select tokens, arg_min(label, o) as label from tk join (select text, arg_max(idx, o) as label, min(o) as o from sup group by text) on contains(tokens, text) group by tokens),
  early as (select row_id, manufacturer, tokens, device_name, {_first_sql(_EARLY)} from (select *, case when tokens = '' then -99 end as b from probe)
    left join exact_miss using (tokens) left join jw_miss using (tokens) left join ov_miss using (tokens) left join ph_miss using (device_name)
    left join exact_sup using (tokens) left join sub using (tokens) left join jw_sup using (tokens) left join ov_sup using (tokens)),
  asked_rows as (select tokens as text from early where label is null), ref_rows as (select text from sup), {_VECTORS},
  bow as (select key as tokens, arg_min(idx, (-score, o)) as label from sims join (select text, arg_min(idx, o) as idx, min(o) as o from sup group by text) on text = ref_text where score > 0.7 group by key),
  linked as (select row_id, manufacturer, early.tokens, early.device_name, {_first_sql(_LATE, level="late")}, early.level as early_level from early left join bow on early.label is null and bow.tokens = early.tokens
    left join ph_sup on ph_sup.device_name = early.device_name left join exact_brd on exact_brd.tokens = early.tokens left join jw_brd on jw_brd.tokens = early.tokens left join ov_brd on ov_brd.tokens = early.tokens left join ph_brd on ph_brd.device_name = early.device_name),
  manufacturers as (select row_id, manufacturer, early_tokens as tokens, device_name, cast(label as bigint) as label, coalesce(early_level, nullif(late, '')) as level from (select *, tokens as early_tokens from linked))"""
)


def _device_clean(c: str) -> str:
    return f"array_to_string(list_filter(regexp_split_to_array(trim(regexp_replace(regexp_replace(lower(coalesce({c}, '')), '[^a-z0-9]', ' ', 'g'), 'non\\s+', 'non', 'g')), '\\s+'), lambda x: x <> '' and x not in ('and', 'hcted')), ' ')"


def _codes_sql(name: str, rows: str, text: str) -> str:
    """codes_{name}: key, label, kind and failed for the distinct texts of rows."""
    inner = _CODE_SQL[len(_WITH) :].lstrip(", \n")
    for t in ("keys", "f", "g", "nk", "mk", "ek", "h", "r"):
        inner = re.sub(rf"\b{t} as \(", f"{name}_{t} as (", inner)
        inner = re.sub(rf"\b(from|join) {t}\b", rf"\1 {name}_{t}", inner)
    return inner.replace("select distinct device_name as key, coalesce(device_name, 'nan') as t from devices", f"select distinct {text} as key, coalesce({text}, 'nan') as t from {rows} where md is null")


def _bag_sql(n: int, rows: str, text: str, ref_text: str, least: float) -> str:
    """bag{n}: the rows after a step of term vectors."""
    vectors = _VECTORS
    for t in ("corpus", "total", "texts", "term_lists", "tf", "dfs", "raw", "vec", "sims", "asked_rows", "ref_rows"):
        vectors = re.sub(rf"\b{t} as \(", f"v{n}_{t} as (", vectors)
        vectors = re.sub(rf"\b(from|join) {t}\b", rf"\1 v{n}_{t}", vectors).replace("(term), total", f"(term), v{n}_total")
    return f"""v{n}_asked_rows as (select {text} as text, sup from {rows} where md is null), v{n}_ref_rows as (select {ref_text} as text, supplier, npc from cat), {vectors},
  v{n}_keys as (select distinct text as key, sup, sup in (select supplier from cat) as known from v{n}_asked_rows),
  v{n}_cand as (select k.key, k.sup, s.score, r.npc from v{n}_keys k join v{n}_sims s using (key) join v{n}_ref_rows r on r.text = s.ref_text and (not coalesce(k.known, false) or r.supplier = k.sup)),
  v{n}_got as (select key, sup, best, count(*) as c, min(npc) as npc from (select *, max(score) over (partition by key, sup) as best from v{n}_cand) where score = best group by key, sup, best),
  bag{n} as (select r.* exclude (md, level, best, n_best), coalesce(md, case when g.best > {least} and c = 1 then npc end) as md, case when md is null and g.best > {least} and c = 1 then 'bag_of_words_match_{least}' else level end as level,
    case when md is null then coalesce(g.best, 0) else r.best end as best, case when md is null then case when g.best > {least} then c else 0 end else n_best end as n_best
    from {rows} r left join v{n}_got g on r.{text} = g.key and r.sup is not distinct from g.sup)"""


def _code_step(name: str, rows: str, text: str, column: str) -> str:
    return f"""{_codes_sql(name, rows, text)},
  {name}_rows as (select d.* exclude (md, level, failed), coalesce(md, c.label) as md, case when md is not null then level else c.kind || '_code_match_{column}' end as level, case when md is not null then d.failed else c.failed end as failed
    from {rows} d left join {name}_r c on d.{text} is not distinct from c.key)"""


def _supplier_step(name: str, rows: str, text: str) -> str:
    return f"""{name} as (select d.* exclude (md, level), coalesce(md, x.npc) as md, case when md is not null then level when x.npc is not null then 'exact_match_supplier_and_{text}_description_tokens' end as level
    from {rows} d left join (select {text} as t, arg_min(npc, ref_ord) as npc, arg_min(supplier, ref_ord) as s from cat group by {text}) x on d.name_tokens = x.t and d.sup = x.s)"""


_DEVICES_LINKED = (
    _MANUFACTURERS
    + f""",
  cat as (select *, {_device_clean("concat_ws(' ', coalesce(supplier, 'nan'), coalesce(base_description, 'nan'), coalesce(secondary_description, 'nan'))")} as full_tokens,
    {_device_clean("concat_ws(' ', coalesce(base_description, 'nan'), coalesce(secondary_description, 'nan'))")} as only_tokens, {_device_clean("base_description")} as "primary", {_device_clean("secondary_description")} as secondary from catalogue),
  d0 as (select m.row_id, m.label, m.device_name as name, case when m.row_id % 4 = 0 then 'sn ' || m.device_name end as serial, r.supplier as sup,
    {_device_clean("concat_ws(' ', coalesce(r.supplier, 'nan'), coalesce(m.device_name, 'nan'))")} as both_tokens, {_device_clean("m.device_name")} as name_tokens,
    case when m.label = -1 then 'manufacturer not in catalogue' when coalesce(m.device_name, '') = '' then 'null device' end as md0, case when m.label = -1 then 'not_in_catalogue' end as level0
    from manufacturers m left join mref r on m.label = r.idx),
  d1 as (select d0.* exclude (md0, level0), coalesce(md0, x.npc) as md, case when md0 is not null then level0 when x.npc is not null then 'exact_match_catalogue_device_name_and_manufacturer_tokens' end as level, cast(null as varchar) as failed, cast(null as double) as best, cast(null as bigint) as n_best
    from d0 left join (select full_tokens, arg_min(npc, ref_ord) as npc from cat group by full_tokens) x on both_tokens = x.full_tokens),
  {_code_step("c1", "d1", "serial", "CLN_Device_Serial_Number")},
  {_code_step("c2", "c1_rows", "name", "CLN_Manufacturer_Device_Name")},
  {_supplier_step("s1", "c2_rows", '"primary"').replace('and_"primary"_', "and_primary_")},
  {_supplier_step("s2", "s1", "secondary")},
  {_bag_sql(1, "s2", "both_tokens", "full_tokens", 0.5)},
  {_bag_sql(2, "bag1", "name_tokens", "only_tokens", 0.3)}
select row_id as "index", label as "Manufacturer_label", md as matched_device, level as device_level, failed as codes_failed_to_match, round(best, 9) as best_similarity, cast(n_best as bigint) as n_best_matches from bag2"""
)

ORACLE_SQL = {
    "clean_tokens": _WITH + "select row_id, tokens, cast(len(list_filter(string_split(tokens, ' '), lambda x: x <> '')) as bigint) as n_tokens from probe",
    "exact_first": _WITH + "select row_id, first as label, case when first is not null then 'exact_match_text' end as level from probe left join firsts on text = tokens",
    "exact_supplier": _WITH
    + """, r as (select text, arg_min(npc, ref_ord) as npc, arg_min(brand, ref_ord) as brand from ref group by text),
  p as (select row_id, tokens, case when row_id % 2 = 0 then 'Brand#13' else 'Brand#21' end as b from probe)
select row_id, npc as code, case when npc is not null then 'exact_match_supplier_and_d' end as level from p left join r on text = tokens and brand = b""",
    "substring_first": _WITH
    + """, hit as (select tokens, arg_min(last, first) as label from (select distinct tokens from probe where tokens <> '') join firsts on contains(tokens, text) group by tokens)
select row_id, label from probe left join hit using (tokens)""",
    "phrase_longest": _WITH
    + """, names as (select lower(supplier) as p, min(ref_ord) as o from catalogue group by 1), keys as (select distinct device_name from devices where device_name is not null),
  hit as (select device_name, p, o, row_number() over (partition by device_name order by length(p) desc, o) as k from keys join names on contains(lower(device_name), p) and regexp_matches(lower(device_name), '\\b' || p || '\\b'))
select row_id, o as label from devices left join (select * from hit where k = 1) using (device_name)""",
    "jw_best": _WITH + _BEST_JW + " select key, first as label, round(s, 9) as score from best where k = 1",
    "token_overlap_unique": _overlap_sql("select text, first as ref_ord from firsts"),
    "token_overlap_ties": _overlap_sql("select text, ref_ord from ref"),
    "tfidf_argmax": _WITH
    + f""", asked_rows as (select tokens as text from probe), ref_rows as (select text, ref_ord from ref), {_VECTORS},
  best as (select key, first, score, row_number() over (partition by key order by score desc, first) as k from sims join firsts on text = ref_text)
select key, first as label, round(score, 9) as score from best where k = 1 and score > 0.7""",
    "tfidf_blocked_unique": _WITH
    + f""", ref_rows as (select lower(concat_ws(' ', secondary_description, base_description, substring(npc, 4, 4))) as text, supplier, npc, ref_ord from catalogue),
  asked_rows as (select lower(concat_ws(' ', secondary_description, substring(npc, 4, 4))) as text, case when ref_ord % 2 = 0 then supplier end as supplier from catalogue), {_VECTORS},
  asked as (select distinct text as key, supplier from asked_rows),
  cand as (select a.key, a.supplier, s.score, r.npc, r.ref_ord from asked a join sims s using (key) join ref_rows r on r.text = s.ref_text and (a.supplier is null or a.supplier = r.supplier)),
  top as (select *, max(score) over (partition by key, supplier) as best from cand),
  got as (select key, supplier, best, count(*) as c, min(npc) as npc, string_agg(npc, ',' order by ref_ord) as devices from top where score = best group by key, supplier, best)
select a.key, a.supplier, round(coalesce(best, 0), 9) as best_similarity, cast(case when best > 0.3 then c else 0 end as bigint) as n_best_matches, case when best > 0.3 and c = 1 then npc end as label,
  case when best > 0.3 then devices else '' end as devices from asked a left join got g on a.key = g.key and a.supplier is not distinct from g.supplier""",
    "code_npc": _CODE_SQL + "select key, label from r where kind = 'npc'",
    "code_mpc": _CODE_SQL + "select key, label from r where kind = 'mpc'",
    "code_ean": _CODE_SQL + "select key, label from r where kind = 'ean'",
    "code_priority": _CODE_SQL + "select key, label, kind, failed from r where kind is not null or failed is not null",
    "distinct_keep_first": _WITH + "select text, first as label from firsts",
    "distinct_keep_last": _WITH + "select text, last as label from firsts",
    "null_label_flags": _WITH + "select row_id, cast(case when tokens = '' then -99 end as bigint) as label from probe",
    "label_left_join": _WITH
    + """, mref as (select supplier, brand, min(ref_ord) as label from catalogue group by all), e as (select row_id, first as label from probe left join firsts on text = tokens)
select row_id, label, supplier, brand from e left join mref using (label)""",
    "level_counts": _WITH + "select case when first is not null then 'exact_match_text' else 'unmatched' end as level, count(*) as n, cast(sum((first is null)::int) as bigint) as open from probe left join firsts on text = tokens group by 1",
    "unmatched_pct": _WITH + "select count(*) as n_rows, cast(sum((first is null)::int) as bigint) as n_unmatched, round(100 * avg((first is null)::int), 6) as pct_unmatched from probe left join firsts on text = tokens",
    "review_merge": _WITH
    + "select row_id, case when row_id % 10 = 0 then 'yes' else '' end as manufacturer_match, case when row_id % 15 = 0 then 'no' end as device_match from devices where row_id % 10 = 0 or row_id % 15 = 0",
    "label_merge_back": _WITH + "select row_id, case when row_id % 3 = 0 then concat('g', cast(row_id as varchar)) end as golden_label from devices",
    "stratified_sample": """
with c as (select c_mktsegment as segment, count(*) as n from customer group by 1), t as (select *, n * 100.0 / sum(n) over () as x from c),
  f as (select segment, n, greatest(cast(floor(x) as bigint), 1) as base, x - floor(x) as frac from t),
  o as (select *, row_number() over (order by frac desc, segment) as k, 100 - sum(base) over () as left_over from f),
  a as (select segment, base + case when k <= left_over then 1 else 0 end as drawn from o),
  r as (select c_custkey, c_mktsegment, row_number() over (partition by c_mktsegment order by md5('42:' || c_custkey), c_custkey) as k from customer)
select c_custkey, c_mktsegment from r join a on segment = c_mktsegment where k <= drawn""",
    "manufacturer_cascade": _MANUFACTURERS + ' select row_id as "index", manufacturer as "CLN_Manufacturer", tokens as "CLN_Manufacturer_tokens", label, level from manufacturers',
    "device_cascade": _DEVICES_LINKED,
    "stratified_allocation": """
with c as (select c_mktsegment as segment, count(*) as n from customer group by 1), t as (select *, n * 100.0 / sum(n) over () as x from c),
  f as (select segment, n, greatest(cast(floor(x) as bigint), 1) as base, x - floor(x) as frac from t),
  o as (select *, row_number() over (order by frac desc, segment) as k, 100 - sum(base) over () as left_over from f)
select segment, cast(base + case when k <= left_over then 1 else 0 end as bigint) as n from o""",
}
