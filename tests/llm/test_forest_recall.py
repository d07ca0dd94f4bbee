from __future__ import annotations

import random
from collections import Counter, defaultdict

import pytest

from fernlink.llm import common, shingle_join


def links_of(rows):
    """Number of links of each row, by counting the shingles of all pairs that share one."""
    sets, holders = [], defaultdict(list)
    for i, (_, text) in enumerate(rows):
        w = common.WORD.findall(text or "")
        sets.append({tuple(w[k : k + 5]) for k in range(len(w) - 4)} if len(w) > 4 else {tuple(w)} if w else set())
        for x in sets[-1]:
            holders[x].append(i)
    both = Counter((a, b) for held in holders.values() for k, a in enumerate(held) for b in held[k + 1 :])
    out = [0] * len(rows)
    for (a, b), c in both.items():
        if 5 * c >= 4 * (len(sets[a]) + len(sets[b]) - c):
            out[a] += 1
            out[b] += 1
    return out


def pairs(changes, seed):
    draw = random.Random(seed)
    rows = []
    for k, c in enumerate(changes):
        words = [f"w{draw.randrange(10**6)}" for _ in range(400)]
        other = list(words)
        for at in draw.sample(range(20, 380), c):
            other[at] = f"x{at}"
        rows += [(2 * k, " ".join(words)), (2 * k + 1, " ".join(other))]
    return rows


@pytest.mark.parametrize("trees", [16, 4])
def test_no_link_of_any_similarity_is_missed(spark, trees):
    rows = pairs([k % 10 for k in range(300)], 7)
    how = shingle_join.Forest(trees=trees)
    got = {r.doc_id: r.n_links for r in shingle_join.join(spark.createDataFrame(rows, "doc_id long, text string"), how).collect()}
    want = links_of(rows)
    assert sum(want) > 500 and all(got[i] <= w for (i, _), w in zip(rows, want, strict=True))
    assert sum(got.values()) >= 0.995 * sum(want)


def test_prefixes_are_nested():
    how = shingle_join.Forest()
    sets = shingle_join.shingles([t for _, t in pairs([0, 2, 9], 3)], 5)
    keys = shingle_join.prefixes(sets, how)
    assert keys.shape == (6, how.longest - how.shortest() + 1, how.trees)
    equal = keys[:, None] == keys
    assert (equal[:, :, 1:] <= equal[:, :, :-1]).all() and equal[0, 1].all()


def test_shortening_ends_with_the_target(spark, monkeypatch):
    """Links far above the threshold are all seen by the longest prefixes; near it, prefixes are shortened to the end."""
    seen = []
    mapped = common.mapped
    monkeypatch.setattr(common, "mapped", lambda df, run, schema, *who: seen.append(run.__name__) or mapped(df, run, schema, *who))
    for changes, levels in (([1] * 200, 1), ([8] * 20, 3)):
        seen.clear()
        shingle_join.join(spark.createDataFrame(pairs(changes, 5), "doc_id long, text string"))
        assert seen.count("verify") == levels


def test_pairs_of_documents_table(spark):
    rows = [(r.doc_id, r.text) for r in common.table(spark, "/root/testdata/sf0.001", "documents").select("doc_id", "text").collect()]
    got = {r.doc_id: r.n_links for r in shingle_join.join(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert [got[i] for i, _ in rows] == links_of(rows)
