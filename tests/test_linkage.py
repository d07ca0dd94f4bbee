from __future__ import annotations

import hashlib
import random

import pytest
from pyspark.sql import functions as F

from fernlink.functions.text import MANUFACTURER_STOP, clean_tokens, token_list
from fernlink.operators import codes, evaluation, matchers, tfidf
from fernlink.plans import cascade


def labels(df, key, label="label"):
    return {r[key]: r[label] for r in df.collect()}


def rows_of(spark, names, label=None):
    return spark.createDataFrame([(i, n, label) for i, n in enumerate(names)], "id int, name string, label long")


@pytest.mark.parametrize(
    ("raw", "stop", "want"),
    [("Canon Medical", MANUFACTURER_STOP, "canonmedical"), ("W. L. Gore & Assoc", (), "wl gore assoc"), ("3M UK", (), "3 m uk"), ("3M UK", MANUFACTURER_STOP, "3 m"), ("non  sterile", (), "nonsterile"), (None, (), ""), ("new new x", ("new",), "x"), ("é£", (), "")],
)
def test_clean(spark, raw, stop, want):
    assert spark.createDataFrame([(raw,)], "t string").select(clean_tokens(F.col("t"), stop)).first()[0] == want


def test_exact_keeps_first_and_labelled_rows(spark):
    ref = spark.createDataFrame([(0, "abbott", 0), (1, "covidien", 1), (2, "smith nephew", 2), (3, "covidien", 9), (4, None, 7)], "ord int, text string, l long")
    rows = spark.createDataFrame([(0, "smith nephew", None, "old"), (1, "covidien", None, None), (2, "polaris", None, "old"), (3, "abbott", 42, "kept"), (4, None, None, None)], "id int, name string, label long, level string")
    out = matchers.exact_match(ref, rows, "text", "l", "name", "label", "ord")
    assert labels(out, "id") == {0: 2, 1: 1, 2: None, 3: 42, 4: 7}
    assert labels(out, "id", "level") == {0: "exact_match_text", 1: "exact_match_text", 2: None, 3: "kept", 4: "exact_match_text"}


def test_supplier_filter_only_first_supplier(spark):
    ref = spark.createDataFrame([(0, "pump", "A", "N1"), (1, "pump", "B", "N2")], "ord int, text string, s string, npc string")
    rows = spark.createDataFrame([(0, "pump", "A", None), (1, "pump", "B", None)], "id int, name string, sup string, code string")
    assert labels(matchers.exact_match_with_supplier_filter(ref, rows, "text", "npc", "name", "code", "sup", "s", "ord"), "id", "code") == {0: "N1", 1: None}


def test_jaro_winkler(spark):
    assert abs(matchers.jaro_winkler("polar", "polaris") - 0.942857) < 1e-6
    assert matchers.jaro_winkler("", "x") == 0 and matchers.jaro_winkler("martha", "marhta") == pytest.approx(0.961111, abs=1e-6)
    ref = spark.createDataFrame([(0, "polar", 3), (1, "zzz", 4)], "ord int, text string, l long")
    rows = rows_of(spark, ["polaris", "q", None, ""])
    assert labels(matchers.jaro_winkler_match(rows, ref, "label", "name", "text", "l", "ord"), "id") == {0: 3, 1: None, 2: None, 3: None}
    more = ref.unionByName(spark.createDataFrame([(2, "polaris", 1)], ref.schema))
    assert labels(matchers.jaro_winkler_match(rows, more, "label", "name", "text", "l", "ord"), "id")[0] == 1


def plain_jaro_winkler(a, b):
    """The definition, a character at a time."""
    if not a or not b:
        return 0.0
    reach = max(max(len(a), len(b)) // 2 - 1, 0)
    free, left = [True] * len(b), []
    for i, x in enumerate(a):
        j = next((j for j in range(max(0, i - reach), min(len(b), i + reach + 1)) if free[j] and b[j] == x), None)
        if j is not None:
            free[j] = False
            left.append(x)
    if not left:
        return 0.0
    m, right = len(left), [y for y, f in zip(b, free, strict=True) if not f]
    jaro = (m / len(a) + m / len(b) + (m - sum(x != y for x, y in zip(left, right, strict=True)) / 2) / m) / 3
    prefix = next((i for i, (x, y) in enumerate(zip(a[:4], b[:4], strict=False)) if x != y), min(len(a), len(b), 4))
    return jaro + 0.1 * prefix * (1 - jaro)


def made_up_names(n, seed, parts=("al", "be", "cor", "dex", "el", "fin", "gra", "hu", "ix", "jo", "kan", "lum", "med", "nor", "ox", "pra", "qui", "ros", "sun", "tek", "ul", "vor", "wes", "yl", "zen")):
    r = random.Random(seed)
    return sorted({" ".join("".join(r.choice(parts) for _ in range(r.randint(1, 3))) for _ in range(r.randint(1, 3))) for _ in range(n)})


def test_jaro_winkler_scores():
    r = random.Random(5)
    pairs = [("".join(r.choice("abcé🙂 ") for _ in range(r.choice([0, 1, 2, 5, 9, 40]))), "".join(r.choice("abcé🙂 ") for _ in range(r.choice([0, 1, 3, 6, 9, 30])))) for _ in range(800)]
    pairs += [("polar", "polaris"), ("martha", "marhta"), ("a", "a"), ("ab", "ba"), ("x" * 500, "x" * 499 + "y")]
    got = matchers.jaro_winkler_all([a for a, _ in pairs], [b for _, b in pairs], cells=300)
    assert got.tolist() == pytest.approx([plain_jaro_winkler(a, b) for a, b in pairs])


@pytest.mark.parametrize(("alphabet", "threshold"), [("abcd", 0.86), ("abcd", 0.7), ("ab", 0.95), ("abcdefghijklmnop", 0.5)])
def test_jaro_winkler_meets_all_pairs(spark, alphabet, threshold):
    r = random.Random(3)
    words = sorted({"".join(r.choice(alphabet) for _ in range(r.randint(1, 9))) for _ in range(120)})
    ref = spark.createDataFrame([(i, w, i) for i, w in enumerate(words[::2])], "ord int, text string, l long")
    got = labels(matchers.jaro_winkler_hits(spark.createDataFrame([(w,) for w in words], "k string"), "k", ref, "text", "l", "ord", threshold), "key", "score")
    want = {w: max(plain_jaro_winkler(w, x) for x in words[::2]) for w in words}
    assert got == pytest.approx({w: s for w, s in want.items() if s >= threshold})


def test_jaro_winkler_candidates_are_few_and_once(spark):
    names = made_up_names(900, 1)
    typos = [n.replace("or", "ro").replace("e", "", 1) for n in names[::3]]
    probe = spark.createDataFrame([(n,) for n in sorted({*typos, *made_up_names(600, 2)})], "key string")
    refs = spark.createDataFrame([(n, i, i) for i, n in enumerate(names)], "text string, label long, ord int")
    got = [(r.key, r.text) for r in matchers.jaro_winkler_candidates(probe, refs, 0.9).select("key", "text").collect()]
    assert len(got) == len(set(got)) and len(got) < 0.02 * probe.count() * len(names)
    keys = [r.key for r in probe.collect()]
    left, right = [k for k in keys for _ in names], names * len(keys)
    scores = matchers.jaro_winkler_all(left, right)
    assert {(a, b) for a, b, s in zip(left, right, scores, strict=True) if s >= 0.9} <= set(got)


def test_token_overlap(spark):
    ref = spark.createDataFrame([(0, ["smith", "nephew"], 5), (1, ["acme"], 6), (2, ["acme"], 7), (3, [], 8)], "ord int, toks array<string>, l long")
    rows = spark.createDataFrame([(0, ["smith", "nephew", "uk"], None), (1, ["acme"], None), (2, ["smith"], None), (3, [], None), (4, None, None)], "id int, toks array<string>, label long")
    assert labels(matchers.number_of_tokens_match(rows, ref, "label", "toks", "toks", "l", "ord"), "id") == {0: 5, 1: None, 2: None, 3: None, 4: None}


def test_substring(spark):
    ref = spark.createDataFrame([(0, "Laptop", "A"), (1, "monitor", "B"), (2, "laptop", "C"), (3, "laptop", "D")], "ord int, text string, l string")
    rows = spark.createDataFrame([(0, "laptop monitor gaming", None), (1, "MONITORS", None), (2, None, None), (3, "  ", None), (4, "desk", "kept")], "id int, name string, label string")
    assert labels(matchers.substring_match(rows, ref, "label", "name", "text", "l", "level", "ord"), "id") == {0: "A", 1: "B", 2: None, 3: None, 4: "kept"}
    with_empty = ref.unionByName(spark.createDataFrame([(9, "", "E"), (10, "nan", "N")], ref.schema))
    out = matchers.substring_match(rows, with_empty, "label", "name", "text", "l", "level", "ord")
    assert labels(out, "id") == {0: "A", 1: "B", 2: "E", 3: None, 4: "kept"}


def test_phrase(spark):
    ref = spark.createDataFrame([(0, "Philips", 1), (1, "Philips Healthcare", 2), (2, "coil", 3), (3, None, 4), (4, " \t", 5), (5, "a.b", 6)], "ord int, text string, l long")
    rows = rows_of(spark, ["Philips Healthcare Monitor", "Philipslike device", "Fiber recoil", None, "", "x A.B y", "axb"])
    assert labels(matchers.catalogue_manufacturer_in_device_name_matching(rows, ref, "label", "name", "text", "l", "ord"), "id") == {0: 2, 1: None, 2: None, 3: None, 4: None, 5: 6, 6: None}


def test_codes(spark):
    cat = spark.createDataFrame([(0, "ABC12345", "MPX-1", "5000000000001"), (1, "ABC99999", "QRS77777", "5000000000002"), (2, "DEF11111", "DUP55555", "5000000000003"), (3, "DEF22222", "DUP55555", "5000000000004")], "ref_ord int, NPC string, MPC string, `EAN/GTIN` string")
    rows = spark.createDataFrame([(i, n, None) for i, n in enumerate(["kit ABC-12345 x", "abc 12345", "ABC 000", "see QRS 77777.", "DUP55555", "n 500 0000000003", None, "xABC12345"])], "id int, t string, m string")
    out = codes.device_code_level_matching(rows, cat, "m", "t")
    assert labels(out, "id", "m") == {0: "ABC12345", 1: None, 2: None, 3: "ABC99999", 4: None, 5: "DEF11111", 6: None, 7: None}
    assert labels(out, "id", "codes_failed_to_match") == {0: None, 1: "abc12345", 2: "ABC000", 3: None, 4: "DUP55555", 5: None, 6: None, 7: None}
    assert labels(out, "id", "device_level")[3] == "mpc_code_match_t"


def test_term_vectors(spark):
    cat = spark.createDataFrame([(0, "infusion pump blue", "S1", "N1"), (1, "infusion pump red", "S1", "N2"), (2, "knee brace", "S2", "N3"), (3, "knee brace", "S2", "N4")], "ref_ord int, t string, Supplier string, NPC string")
    rows = spark.createDataFrame([(0, "pump red", "S1", None), (1, "knee brace", "S2", None), (2, "knee brace", "S1", None), (3, "pump red", None, None), (4, "x", "S1", "kept")], "id int, t string, Supplier string, matched_device string")
    out = tfidf.bag_of_words_matching(cat, rows, "t", "t", 0.3)
    assert labels(out, "id", "matched_device") == {0: "N2", 1: None, 2: None, 3: "N2", 4: "kept"}
    assert labels(out, "id", "n_best_matches")[1] == 2
    assert labels(out, "id", "best_similarity")[2] == 0 and labels(out, "id", "n_best_matches")[2] == 0  # no common term with the supplier's rows
    assert labels(out, "id", "best_similarity")[4] is None and all(0 <= r.best_similarity <= 1 for r in out.where("id < 4").collect())
    same = tfidf.bag_of_words_matching(cat.limit(0), rows, "t", "t", 0.3)
    assert labels(same, "id", "matched_device") == {0: None, 1: None, 2: None, 3: None, 4: "kept"}


@pytest.mark.parametrize(
    ("counts", "total", "least", "want"),
    [
        ({"a": 90, "b": 9, "c": 1}, 10, 1, {"a": 8, "b": 1, "c": 1}),  # the least shares are taken back from the largest
        ({"a": 2, "b": 2}, 10, 1, {"a": 2, "b": 2}),
        ({"a": 50, "b": 30, "c": 20}, 10, 1, {"a": 5, "b": 3, "c": 2}),
        ({"a": 5, "b": 5, "c": 5}, 10, 1, {"a": 4, "b": 3, "c": 3}),  # equal fractions go by group
        ({"a": 100, "b": 60, "c": 2, "d": 2}, 41, 9, {"a": 23, "b": 14, "c": 2, "d": 2}),  # c and d have no more
        ({"a": 1000, "b": 7, "c": 6, "d": 5}, 30, 4, {"a": 18, "b": 4, "c": 4, "d": 4}),
        ({"a": 40, "b": 39, "c": 21}, 90, 25, {"a": 35, "b": 34, "c": 21}),  # the difference goes round, larger groups first
    ],
)
def test_allocation(spark, counts, total, least, want):
    got = evaluation.allocation(spark.createDataFrame(list(counts.items()), "g string, c long"), "g", total, least)
    assert {r.g: r.n for r in got.collect()} == want


def test_allocation_that_cannot_be_met(spark):
    with pytest.raises(ValueError, match="least"):
        evaluation.allocation(spark.createDataFrame([("a", 5), ("b", 5), ("c", 5)], "g string, c long"), "g", 2)


def test_sample_is_exact(spark):
    rows = spark.range(200).withColumn("g", F.when(F.col("id") % 10 == 0, None).otherwise((F.col("id") % 3).cast("string")))
    sample, allocation = evaluation.stratified_proportional_sample(rows, "g", "id", 30)
    n = {r.g: r.n for r in allocation.collect()}
    group = lambda i: "UNKNOWN" if i % 10 == 0 else str(i % 3)
    want = {g: sorted((i for i in range(200) if group(i) == g), key=lambda i: hashlib.md5(f"42:{i}".encode()).hexdigest())[: n[g]] for g in ("0", "1", "2", "UNKNOWN")}
    assert sum(n.values()) == 30 and {(r.g, r.id) for r in sample.collect()} == {(g, i) for g, ids in want.items() for i in ids}


def test_reviews_and_labels(spark):
    rows = rows_of(spark, ["a", "b", "c"])
    reviews = spark.createDataFrame([(0, "yes", "", None, None), (1, "", "", "", "")], "id int, manufacturer_match string, manufacturer_comment string, device_match string, device_comment string")
    assert [r.id for r in evaluation.apply_reviews(rows, reviews, "id").collect()] == [0]
    assert evaluation.apply_reviews(rows, reviews, "id", only_reviewed=False).count() == 3
    merged = evaluation.merge_labels(rows, spark.createDataFrame([(1, "g")], "id int, golden_label string"), "id")
    assert labels(merged, "id", "golden_label") == {0: None, 1: "g", 2: None}


def test_cascades(spark):
    cat = spark.createDataFrame([(0, "Acme Surgical", "Zed", "ABC12345", "MP00001", "5000000000001", "scalpel fine", "blade"), (1, "Bravo", "Bolt", "ABC99999", "MP00002", "5000000000002", "knee brace", "large")], "ref_ord long, Supplier string, Brand string, NPC string, MPC string, `EAN/GTIN` string, `Base Description` string, `Secondary Description` string")
    devices = spark.createDataFrame([(1, "ACME surgical Ltd", "x", "ABC-12345"), (2, None, "y", None), (3, "Gone Co", "z", None), (4, "bolt", None, None), (5, "whatever", "the bravo thing", None), (6, "bravo", "knee brace", None)], "index long, CLN_Manufacturer string, CLN_Manufacturer_Device_Name string, CLN_Device_Serial_Number string")
    said = []
    out = cascade.manufacturer_cascade(devices, cat, spark.createDataFrame([("Gone Co",)], "Supplier_missing string"), log=lambda *x: said.append(x))
    assert said[0] == ("exact_match_Supplier_missing_tokens", 6, 4) and said[-1][1:] == (6, 0)
    assert labels(out, "index", "Manufacturer_label") == {1: 0, 2: -99, 3: -1, 4: 1, 5: 1, 6: 1}
    assert labels(out, "index", "level")[4] == "exact_match_Brand_tokens"
    done = cascade.device_cascade(out, cat)
    assert labels(done, "index", "matched_device") == {1: "ABC12345", 2: None, 3: "manufacturer not in catalogue", 4: "null device", 5: None, 6: "ABC99999"}
    assert done.count() == 6


def test_token_list(spark):
    assert spark.createDataFrame([("",)], "t string").select(token_list(F.col("t"))).first()[0] == []
