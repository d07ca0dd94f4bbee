from __future__ import annotations

import collections
import math
import re

from fernlink.functions.text import ENGLISH_STOP
from fernlink.operators import tfidf
from fernlink.plans import catalogue_queries


def test_ties_name_every_code(spark):
    cat = spark.createDataFrame([(0, "knee brace", "S2", "N9"), (1, "knee brace", "S2", "N3"), (2, "knee brace", "S1", "N5"), (3, "pump", "S1", "N4")], "ref_ord int, t string, Supplier string, NPC string")
    rows = spark.createDataFrame([(0, "knee brace", "S2", None), (1, "knee brace", None, None), (2, "pump", "S1", None), (3, "zzz", "S1", None)], "id int, t string, Supplier string, matched_device string")
    got = {r.id: r for r in tfidf.bag_of_words_matching(cat, rows, "t", "t", 0.3).collect()}
    assert got[0].best_match_devices == ["N9", "N3"] and got[1].best_match_devices == ["N9", "N3", "N5"]
    assert got[2].best_match_devices == ["N4"] and got[2].matched_device == "N4" and got[0].matched_device is None
    assert all(len(got[i].best_match_devices) == got[i].n_best_matches for i in range(3))


def test_blocked_query_covers_the_whole_catalogue(spark):
    """tfidf_blocked_unique against brute force over every catalogue row of sf0.001."""
    sf = "/root/testdata/sf0.001"
    cat = [(r["ref_ord"], r["Supplier"], r["NPC"], r["Base Description"], r["Secondary Description"]) for r in catalogue_queries.catalogue(spark, sf).collect()]

    def terms(t):
        w = [x for x in re.findall(r"\w\w+", t.lower()) if x not in ENGLISH_STOP]
        return collections.Counter([*w, *(f"{a} {b}" for a, b in zip(w, w[1:], strict=False))])

    refs = [(o, s, n, terms(f"{d} {b} {n[3:7]}".lower())) for o, s, n, b, d in sorted(cat)]
    asked = collections.Counter((f"{d} {n[3:7]}".lower(), s if o % 2 == 0 else None) for o, s, n, b, d in cat)
    corpus = [t for *_, t in refs] + [terms(k) for (k, _), c in asked.items() for _ in range(c)]
    df = collections.Counter(x for t in corpus for x in t)

    def unit(t):
        v = {x: c * (math.log((1 + len(corpus)) / (1 + df[x])) + 1) for x, c in t.items()}
        norm = math.sqrt(sum(w * w for w in v.values()))
        return {x: w / norm for x, w in v.items()}

    vecs, suppliers = [unit(t) for *_, t in refs], {s for _, s, *_ in refs}
    want = {}
    for key, s in asked:
        q = unit(terms(key))
        scores = [(round(sum(w * v.get(x, 0) for x, w in q.items()), 9), n) for (_, rs, n, _), v in zip(refs, vecs, strict=True) if s not in suppliers or rs == s]
        best = max(x for x, _ in scores)
        want[key, s] = (best, [n for x, n in scores if x == best] if best > 0.3 else [])
    got = {(r.key, r.supplier): r for r in catalogue_queries.QUERIES["tfidf_blocked_unique"](spark, sf).collect()}
    assert set(got) == set(want)
    for k, (best, npcs) in want.items():
        assert abs(got[k].best_similarity - best) < 2e-9
        assert got[k].n_best_matches == len(npcs) and got[k].devices == ",".join(npcs)
