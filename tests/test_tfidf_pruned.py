from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from fernlink.operators import tfidf


def _brute(spark, probes, members, vec):
    """Best score and all members that have it, of every probe, over all pairs."""
    v: dict = {}
    for r in vec.collect():
        v.setdefault(r.text, {})[r.term] = r.weight
    out = {}
    for key, wide, scope in probes:
        scores = {m: round(sum(w * v[m].get(t, 0.0) for t, w in v[key].items()), 10) for w2, s2, m in members if (w2, s2) == (wide, scope) and v.get(m) and v.get(key, {}).keys() & v[m].keys()}
        if scores:
            best = max(scores.values())
            out[key, wide, scope] = (best, sorted(m for m, s in scores.items() if s == best))
    return out


@pytest.mark.parametrize(("chunk", "first"), [(1, 0), (3, 2), (256, 64)])
def test_nearest_is_that_of_all_pairs(spark, chunk, first):
    """Rare and common words, copies of words, unit vectors of equal weight, scopes and none; chunks and early terms change nothing."""
    r = random.Random(chunk)
    word = lambda: r.choice(["pump", "knee"] * 6 + ["brace", "bolt", "gear"] * 2 + [f"w{i}" for i in range(12)])
    refs = sorted({" ".join(word() for _ in range(r.randint(1, 5))) for _ in range(60)} | {"pump", "knee"})
    keys = sorted({" ".join(word() for _ in range(r.randint(1, 6))) for _ in range(40)} | {"pump", "pump knee", "nothing alike", ""})
    members = [(True, None, t) for t in refs] + [(False, f"s{i % 3}", t) for i, t in enumerate(refs)]
    probes = [(k, w, s) for k in keys for w, s in ((True, None), (False, "s0"), (False, "s2"))]
    corpus = spark.createDataFrame([(t, 1 + i % 3) for i, t in enumerate(sorted({*refs, *keys}))], "text string, n long")
    vec = tfidf.vectors(corpus, corpus).cache()
    got: dict = {}
    rows = tfidf.nearest(spark.createDataFrame(probes, "key string, wide boolean, scope string"), spark.createDataFrame(members, "wide boolean, scope string, ref_text string"), vec, chunk, first)
    for x in rows.collect():
        got.setdefault((x.key, x.wide, x.scope), (round(x.best, 10), []))[1].append(x.ref_text)
    want = _brute(spark, probes, members, vec)
    assert len(want) > 90
    assert {k: (b, sorted(m)) for k, (b, m) in got.items()} == want


def test_a_common_word_does_not_make_all_pairs(spark, monkeypatch):
    """600 rows share words and differ by a number: their 360,000 pairs are not all looked at."""
    looked, ties = [], tfidf._ties

    def spy(asked, posts):
        same = [asked[c].eqNullSafe(posts[c]) for c in ("wide", "scope", "term", "chunk")]
        looked.append(asked.join(posts, same).count())
        return ties(asked, posts)

    monkeypatch.setattr(tfidf, "_ties", spy)
    n = 600
    cat = spark.createDataFrame([(i, f"knee brace large {i:05d}", "S1", f"N{i}") for i in range(n)], "ref_ord int, t string, Supplier string, NPC string")
    probe = cat.select(F.concat(F.lit("knee brace "), F.substring("t", 18, 5)).alias("text"), F.when(F.col("ref_ord") % 2 == 0, F.col("Supplier")).alias("supplier"), F.lit(1).alias("n"))
    got = {(r.key, r.supplier): r for r in tfidf.device_hits(probe, cat, "t", 0.3).collect()}
    assert len(got) == n and all(r.label == f"N{int(k.split()[-1])}" and r.n_best_matches == 1 for (k, _), r in got.items())
    assert 0 < sum(looked) < 10 * n
