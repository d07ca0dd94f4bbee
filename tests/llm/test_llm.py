from __future__ import annotations

import collections
import hashlib
import math
import random
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from fernlink.llm import attention_lm, bwt, common, fertility_rules, packing, piece_codec, pieces, quality_classifier, shingle_join, style_tree, suffix_dedup, token_counts, topk_search

WORD = re.compile(r"[^\x20\x09-\x0D]+")
PIECES = common.tokenizer_path("piece_bpe_32k.model")
BYTES = common.tokenizer_path("byte_bpe_multi_50k.tiktoken")
WORDS = common.tokenizer_path("word_bpe_49k.json")
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, keys string, digest string, score double, block int"


def prose(seed: int, n: int) -> str:
    r = random.Random(seed)
    return " ".join("".join(r.choice(["th", "er", "on", "an", "re"]) for _ in range(r.randint(1, 4))) for _ in range(n))


LONG = prose(1, 20_000)
TEXTS = {
    1: prose(2, 120), 2: prose(2, 120), 3: prose(2, 119) + " changed", 4: "", 5: None, 6: "one two", 7: "one two", 8: LONG, 9: "same line\n" * 80,
    10: prose(3, 60) + "\n" + prose(4, 40) + "\n" + prose(3, 60), 11: "Straße İ ΑΣ 中文 🙂 naïve <|endoftext|> ▁ a▁b 3.14 don't", 12: prose(5, 90) + " " + prose(4, 40), 13: "\t \n ", 14: "x" * 3000, 15: "###*** $$$ " * 60,
}
ROWS = [*TEXTS.items(), (8, LONG), (None, prose(6, 80)), (None, None)]


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame([(i, t, "en" if i != 3 else None, "s", 1, "clash", "clash", 0.5, 3) for i, t in ROWS], SCHEMA).repartition(3)


@pytest.fixture(scope="module")
def nothing(spark):
    return spark.createDataFrame([], SCHEMA)


def by_id(rows):
    out = collections.defaultdict(list)
    for r in rows:
        out[r.doc_id].append(r)
    return out


def test_empty_tables(spark, nothing):
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert quality_classifier.score(nothing, quality_classifier.train(nothing, labels)).count() == 0
    assert suffix_dedup.removals(nothing).count() == 0
    assert fertility_rules.rules(nothing, PIECES, BYTES).count() == 0
    assert shingle_join.join(nothing).count() == 0
    assert token_counts.token_counts(nothing, PIECES).count() == 0
    assert piece_codec.digests(nothing, PIECES).count() == 0
    assert style_tree.extract(spark.createDataFrame([], "page_id long, url string, html string")).count() == 0
    assert attention_lm.lm_scores(nothing, BYTES).count() == 0
    assert packing.pack(nothing, WORDS).count() == 0
    assert topk_search.top_k(spark.createDataFrame([], "vec_id long, embedding array<float>"), F.col("id") % 100 == 0).count() == 0


def test_classifier(spark, docs):
    good = [(i, prose(i, 100), 1) for i in range(100, 400)]
    bad = [(i, (prose(i, 100).upper() + "!! ") * 2, 0) for i in range(400, 500)]
    table = spark.createDataFrame([(i, t) for i, t, _ in good + bad], "doc_id long, text string")
    labels = spark.createDataFrame([(i, q, 0) for i, _, q in good + bad] + [(1, None, None), (None, 1, 0)], "doc_id long, quality int, toxic int")
    forest = quality_classifier.train(table, labels)
    got = {r.doc_id: r for r in quality_classifier.score(table, forest).collect()}
    held = [(i, q) for i, _, q in good + bad if zlib.crc32(str(i).encode()) % 4 == 2]
    assert len(held) > 50 and np.mean([got[i].predicted == q for i, q in held]) > 0.97
    scored = quality_classifier.score(docs, forest).collect()
    assert len(scored) == len(ROWS) and all(0 <= r.score <= 1 for r in scored)
    one = quality_classifier.train(table, labels.where("quality = 1"))
    assert quality_classifier.score(table.limit(3), one).where("predicted = 1").count() == 3


def brute_removed(rows, length):
    seen, out = set(), collections.defaultdict(list)
    for i, t in sorted(rows, key=lambda x: (-math.inf if x[0] is None else x[0], x[1] or "")):
        raw = (t or "").encode()
        gone = np.zeros(len(raw), bool)
        for k in range(len(raw) - length + 1):
            if raw[k : k + length] in seen:
                gone[k : k + length] = True
            seen.add(raw[k : k + length])
        out[i].append((len(raw), int(gone.sum()), int((np.diff(gone.astype(int), prepend=0) == 1).sum()), hashlib.sha256(np.frombuffer(raw, np.uint8)[~gone].tobytes()).hexdigest()))
    return {i: sorted(v) for i, v in out.items()}


@pytest.mark.parametrize("most", [8192, 1])
def test_suffix_dedup(docs, most):
    got = by_id(suffix_dedup.removals(docs, most=most).collect())
    assert {i: sorted((r.n_bytes, r.n_removed, r.n_spans, hashlib.sha256(r.kept).hexdigest()) for r in v) for i, v in got.items()} == brute_removed(ROWS, 100)


def test_transforms():
    r = random.Random(0)
    for _ in range(60):
        letters = r.choice([b"ab", b"abcdef", bytes(range(256)), b"a"])
        strings = [bytes(r.choice(letters) for _ in range(r.randint(0, 60))) for _ in range(r.randint(1, 12))]
        strings += [strings[0] + strings[-1]]
        depth = r.choice([4, 6, 10])
        want = collections.defaultdict(list)
        for i, x in enumerate(strings):
            for j in range(len(x) - depth + 1):
                want[x[j : j + depth]].append((i, j))
        got = collections.defaultdict(list)
        for i, j, g in zip(*(v.tolist() for v in bwt.repeated(strings, depth, r.choice([10, 50, 10_000]))), strict=True):
            got[g].append((i, j))
        assert sorted(map(sorted, got.values())) == sorted(sorted(v) for v in want.values() if len(v) > 1)


def test_fertility(docs):
    got = by_id(fertility_rules.rules(docs, PIECES, BYTES).collect())
    for i, t in ROWS:
        words = WORD.findall(t or "")
        windows = collections.Counter(zip(words, words[1:], words[2:], strict=False))
        inside = {k + d for k in range(len(words) - 2) if windows[tuple(words[k : k + 3])] > 1 for d in range(3)}
        lines = [x for x in (t or "").split("\n") if WORD.search(x)]
        want = (len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", t or "")), len(lines) - len(set(lines)), len(inside))
        failed = len(words) < 50 or 100 * len(inside) > 50 * len(words)
        assert any((r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == want and r.base_failed == failed and not (failed and r.kept) for r in got[i]), i
    assert sum(map(len, got.values())) == len(ROWS) and got[8][0].kept


def brute_links(rows):
    sets = []
    for _, t in rows:
        w = WORD.findall(t or "")
        sets.append({tuple(w[i : i + 5]) for i in range(len(w) - 4)} if len(w) > 4 else {tuple(w)} if w else set())
    return [[j for j, b in enumerate(sets) if i != j and a and b and 5 * len(a & b) >= 4 * len(a | b)] for i, a in enumerate(sets)]


@pytest.mark.parametrize("block", [512, 2])
def test_shingle_join(spark, docs, block):
    near = [(1000 + k, " ".join([*prose(9, 200).split()[: 200 - k], *(["end"] * 1)])) for k in range(12)]
    rows = [(i, t) for i, t in ROWS if i is not None] + near
    table = spark.createDataFrame(rows, "doc_id long, text string")
    got = by_id(shingle_join.join(table, shingle_join.Forest(block=block)).collect())
    links = brute_links(rows)
    for k, (i, _) in enumerate(rows):
        component, todo = {k}, [k]
        while todo:
            for j in links[todo.pop()]:
                if j not in component:
                    component.add(j)
                    todo.append(j)
        assert all((r.n_links, r.class_id) == (len(links[k]), min(rows[j][0] for j in component)) for r in got[i]), (i, got[i])
    assert shingle_join.join(docs).where("doc_id is null and class_id is null and n_links = 0").count() == 2


def brute_best(p, word):
    """Score, number of ids of the best segmentation, the longer last piece first."""
    score = {}
    text_of = {}
    for k, chars in p.chars.items():
        for row, i in zip(chars, p.ids[k], strict=True):
            text_of["".join(map(chr, row))] = i
    best = [(0.0, 0)]
    for e in range(1, len(word) + 1):
        top = (-math.inf, 0)
        for k in range(min(e, p.longest), 0, -1):
            piece = word[e - k : e]
            i = text_of.get(piece)
            if i is None and k > 1:
                continue
            s = best[e - k][0] + (p.score[i] if i is not None else p.unknown)
            if s > top[0]:
                top = (s, best[e - k][1] + (1 if i is not None else len(piece.encode())))
        best.append(top)
    del score
    return best[-1]


def test_pieces():
    p = pieces.load(PIECES)
    words = sorted({w for _, t in ROWS if t for w in p.words(t[:3000]) if len(w) < 40})[:120] + ["▁", "▁▁▁x", "🙂🙂", "中"]
    ids, counts = pieces.viterbi(p, words), pieces.trie_counts(p, words)
    for w, x, n in zip(words, ids, counts.tolist(), strict=True):
        assert len(x) == n == brute_best(p, w)[1]


def test_codec_and_counts(docs):
    got = by_id(piece_codec.digests(docs, PIECES).collect())
    counts = by_id(token_counts.token_counts(docs, PIECES).collect())
    for i, t in ROWS:
        assert any(r.round_trip for r in got[i]) == ("▁" not in (t or ""))
        assert sorted(r.n_pieces for r in got[i]) == sorted(r.n_tokens for r in counts[i])
    back = by_id(piece_codec.decode(piece_codec.encode(docs, PIECES), PIECES).collect())
    assert all((t or "").replace("▁", " ") in [r.text for r in back[i]] for i, t in ROWS)


def test_packing(docs):
    from tokenizers import Tokenizer

    whole = Tokenizer.from_file(WORDS)
    special = [(20, "a<|endoftext|>b <|startoftext|> <|ENDOFTEXT|>"), (21, "<|endoftext|><|endoftext|>. x<|")]
    docs = docs.unionByName(docs.sparkSession.createDataFrame(special, "doc_id long, text string"), allowMissingColumns=True)
    got = packing.pack(docs, WORDS, with_ids=True).collect()
    rows = [*ROWS, *special]
    want = collections.Counter((i, tuple([*whole.encode(t or "", add_special_tokens=False).ids, 2])) for i, t in rows)
    assert sum(r.length for r in got) == sum(len(ids) * n for (_, ids), n in want.items())
    once = [i for i, n in collections.Counter(i for i, _ in rows).items() if n == 1]
    for i in once:
        ids = tuple(x for r in sorted((r for r in got if r.doc_id == i), key=lambda r: r.start) for x in r.ids)
        assert want[i, ids] == 1, i
    assert whole.token_to_id("<|endoftext|>") in {x for r in got for x in r.ids}
    sequences, pieces_of = collections.defaultdict(list), by_id(got)
    for r in got:
        sequences[r.sequence_id].append(r)
        assert r.ids_crc32 == zlib.crc32(np.array(r.ids, "<u4").tobytes())
    for rows in sequences.values():
        at = 0
        for r in sorted(rows, key=lambda r: r.offset):
            assert r.offset == at
            at += r.length
        assert at == 4096 or at & (at - 1) == 0 and at < 4096
    for i, t in TEXTS.items():
        want = [*whole.encode(t or "", add_special_tokens=False).ids, 2]
        if i != 8:
            assert [x for r in sorted(pieces_of[i], key=lambda r: r.start) for x in r.ids] == want


def test_word_ids_equal_the_tokenizer():
    fast = packing.FastWords(WORDS)
    r = random.Random(5)
    words = ["".join(r.choice("abcDEéÈñß0123'sdtm.,-_!#½²ªşŁ") for _ in range(r.randint(1, 12))) for _ in range(3000)] + ["中文", "ΑΣ", "é"]
    assert [list(x) for x in fast(words)] == [e.ids for e in fast.whole.encode_batch_fast(words, add_special_tokens=False)]


def test_style_tree(spark):
    page = "<html><head><title>T</title></head><body><nav><a href='/a'>Home</a></nav><div class='cookie-notice'>We use</div><article><h1>Head {0}</h1><p>Body  {0}\n&amp; more<br>x</p><ul><li>a<li>b</ul></article><section id='comments'><p>nice</p></section><footer>&copy; us</footer></body></html>"
    plain = "<div class='top'>Shared banner of all pages</div><div><p>Own words {0}</p></div>"
    rows = [(i, f"http://h.example/{i}", page.format(i)) for i in range(6)] + [(100 + i, f"http://p.example/{i}", plain.format(i)) for i in range(40)]
    rows += [(200, None, None), (201, "http://x/", ""), (202, "bad url", "<p>cut <b"), (203, "http://x/", "just text &lt;"), (0, "http://h.example/0", page.format(0))]
    out = collections.defaultdict(list)
    for r in style_tree.extract(spark.createDataFrame([(*r, 1) for r in rows], "page_id long, url string, html string, known int")).collect():
        out[r.page_id].append(r.text)
        assert r.n_chars == len(r.text)
    assert out[0] == ["Head 0\n\nBody 0 & more x\n\na\n\nb"] * 2
    assert out[105] == ["Own words 5"]
    assert (out[200], out[201], out[202], out[203]) == ([""], [""], ["cut"], ["just text <"])


def tiny_model(seed=3):
    """16 ids in clusters of up to 4, of which 0, 3, 5 and 6 begin a word or are the end."""
    begins = np.isin(np.arange(16), [0, 3, 5, 6])
    shape = attention_lm.Shape(ranks=15, cluster=4, width=4, window=6, context=2, frame=2)
    model = attention_lm.Model(shape, attention_lm.clusters(np.arange(16)[::-1].copy(), begins, 4), seed)
    model.w = {n: p.astype(np.float64) for n, p in model.w.items()}
    return model, begins


def dense(model, x):
    """A plain forward pass of one window: a row of probabilities of all ids for each position."""
    w, d, out = model.w, model.shape.width, []
    e = np.array([w["emb"][i] + w["pos"][t] for t, i in enumerate(x)])
    q, k, v = (e @ w["qkv"][:, i * d : (i + 1) * d] for i in range(3))
    for t in range(len(x)):
        a = np.exp([q[t] @ k[j] / math.sqrt(d) for j in range(t + 1)])
        r = e[t] + (a / a.sum()) @ v[: t + 1]
        h = r + np.maximum(r @ w["h1"], 0) @ w["h2"]
        c = np.exp(h @ w["c"] + w["cb"])
        z = np.exp(np.einsum("d,kde->ke", h, w["i"]) + w["ib"])
        p = (c / c.sum())[:, None] * z / z.sum(1, keepdims=True)
        out.append([p[model.clusters.of[i], model.clusters.within[i]] for i in range(model.shape.ids)])
    return np.array(out)


def test_attention_gradients():
    model, _ = tiny_model()
    r = np.random.default_rng(1)
    x, y, scored = r.integers(0, 16, (3, 6)), r.integers(0, 16, (3, 6)), r.random((3, 6)) < 0.7
    loss = lambda: -np.mean(-np.log([dense(model, a)[t, b[t]] for a, b, c in zip(x, y, scored, strict=True) for t in range(6) if c[t]]) * -1)
    for n, g in model.gradients(x, y, scored).items():
        at = tuple(r.integers(0, s) for s in g.shape)
        keep = model.w[n][at]
        model.w[n][at] = keep + 1e-5
        up = loss()
        model.w[n][at] = keep - 1e-5
        down = loss()
        model.w[n][at] = keep
        assert (up - down) / 2e-5 == pytest.approx(g[at], abs=1e-4), n


def test_attention_scores_equal_a_plain_pass_in_every_window():
    model, begins = tiny_model()
    r = np.random.default_rng(5)
    docs = []
    for n in (0, 1, 3, 9):  # words of an id that begins one and some that do not
        docs.append([[int(r.choice([3, 5, 6])), *map(int, r.choice(np.flatnonzero(~begins), r.integers(0, 4)))] for _ in range(n)])
    flat = [i for words in docs for i in [*(x for w in words for x in w), 0]]
    ends = np.cumsum([0, *(sum(map(len, words)) + 1 for words in docs)])
    got = attention_lm.word_log_probs(model, np.array(flat), ends, begins)
    want = []
    for lo, hi in zip(ends[:-1], ends[1:], strict=True):
        own, before, at = flat[lo:hi], [0, *flat[lo : hi - 1]], 0
        p = np.empty((len(own), 16))
        while at < len(own):  # windows of six, of which later ones begin with two ids of context
            start = max(0, at - 2) if at else 0
            rows = dense(model, before[start : start + 6])
            p[at : start + len(rows)] = rows[at - start :]
            at = start + len(rows)
        starts = [t for t, i in enumerate(own) if begins[i]]
        for t, after in zip(starts, [*starts[1:], None], strict=True):
            x = p[t, own[t]] / p[t, begins].sum()
            for u in range(t + 1, after if after else t + 1):
                x *= p[u, own[u]]
            want.append(math.log(x * (p[after, begins].sum() if after else 1)))
    assert np.allclose(got, want)


def test_attention_words_sum_to_one():
    """Over all words of up to six ids, the probabilities sum to 1 less that of longer words."""
    model, begins = tiny_model()
    model.w["c"][:, model.clusters.begins] *= 3
    first, other = np.flatnonzero(begins), np.flatnonzero(~begins)
    total, longer = 0.0, 0.0
    todo = [([0], 1.0)]
    while todo:
        ids, p = todo.pop()
        row = dense(model, ids)[-1]
        if len(ids) == 1:
            row = np.where(begins, row / row[begins].sum(), 0)
            total += row[0]  # the end
            todo += [([0, int(i)], row[i]) for i in first if i]
            continue
        total += p * row[begins].sum()
        if len(ids) < 5 and p > 1e-7:
            todo += [([*ids, int(i)], p * row[i]) for i in other]
        else:
            longer += p * row[other].sum()
    assert total + longer == pytest.approx(1, abs=1e-9) and total > 0.5


@pytest.mark.parametrize("text", ["", "ABC xyz", "ÀÉ Straße İ K \ud800Z", "\x00A\u00a0B"])
def test_folding_is_of_ascii_letters_only(text):
    assert attention_lm._lower(text) == "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text)


def test_attention_scores(docs):
    got = by_id(attention_lm.lm_scores(docs, BYTES).collect())
    lower = lambda t: WORD.findall((t or "").translate({c: c + 32 for c in range(65, 91)})) + [""]
    c = collections.Counter()
    for i, t in ROWS:
        if i is not None and zlib.crc32(str(i).encode()) % 7 != 2:
            c.update(lower(t))
    n, v = sum(c.values()), len(c)
    assert sum(map(len, got.values())) == len(ROWS)
    for i, t in ROWS:
        want = sum(math.log10((c[w] + 1) / (n + v + 1)) for w in lower(t))
        assert any(r.base_score == pytest.approx(want) and r.n_tokens == len(lower(t)) and r.n_known == sum(c[w] > 0 for w in lower(t)) and r.train_tokens == n and r.score < 0 for r in got[i])


def nearest(vectors, q, k):
    """(distance, id) of the k nearest vectors of q's length, by sign."""
    near = [(sum((x > 0) != (y > 0) for x, y in zip(vectors[q], v, strict=True)), i) for i, v in vectors.items() if i != q and len(v) == len(vectors[q])]
    return sorted(near)[:k]


def listed(found):
    got = collections.defaultdict(list)
    for x in found.orderBy("query_id", "rank").collect():
        assert x["rank"] == len(got[x.query_id]) + 1
        got[x.query_id].append((x.distance, x.neighbor_id))
    return got


def test_topk(spark):
    r = np.random.default_rng(2)
    base = r.standard_normal((40, 40))
    vectors = {i: (base[i % 40] * (r.random(40) > 0.05)).tolist() for i in range(600)}
    vectors |= {700 + i: r.standard_normal(45).tolist() for i in range(9)}  # another length, fewer than k
    vectors |= {800: [1.0], 900: [], 1000: vectors[0], 1001: vectors[0], 1100: r.standard_normal(130).tolist(), 1101: r.standard_normal(130).tolist()}
    rows = [*vectors.items(), (5, vectors[5]), (1200, None), (None, vectors[0])]
    table = spark.createDataFrame([(*x, "x", 1) for x in rows], "vec_id long, embedding array<double>, code string, bits int")
    trace = topk_search.Trace([], [])
    got = listed(topk_search.top_k(table, F.col("id") % 100 == 0, k=7, piece=8, trace=trace))
    for q in (i for i in vectors if i % 100 == 0):
        assert got[q] == nearest(vectors, q, 7), q
    assert 1200 not in got and not got[800] and not got[900]


def test_topk_looks_at_few_codes(spark):
    """No query looks through the table: the candidates of all rounds are a small part of all pairs."""
    r = np.random.default_rng(4)
    near = r.standard_normal((30, 64))
    vectors = {i: (near[i % 30] + 0.3 * r.standard_normal(64)).tolist() for i in range(3000)}
    trace = topk_search.Trace([], [])
    got = listed(topk_search.top_k(spark.createDataFrame(list(vectors.items()), "vec_id long, embedding array<double>"), F.col("id") % 100 == 0, k=5, trace=trace))
    assert all(got[q] == nearest(vectors, q, 5) for q in range(0, 3000, 100))
    assert sum(trace.candidates) < 0.15 * 30 * 3000, trace


def test_topk_binary_codes(spark):
    rows = [(1, [1.0, -1.0, 0.0, float("nan"), None, 2.0]), (2, [0.5] * 70), (3, []), (4, None)]
    got = {r.id: (r.bits, list(r.code)) for r in topk_search.binary_codes(spark.createDataFrame(rows, "vec_id long, embedding array<double>"), "vec_id", "embedding").collect()}
    assert got == {1: (6, [0b100001]), 2: (70, [-1, 63]), 3: (0, [])}


def test_pipeline(spark, docs, tmp_path):
    good = [(i, prose(i, 120)) for i in range(100, 160)]
    rows = [*good, (160, good[0][1]), (161, good[1][1] + " tail"), *((170 + k, (prose(k, 80).upper() + "!! ") * 2) for k in range(20)), (200, None), (201, "")]
    spark.createDataFrame([(i, t, "en", "s", len(t or "")) for i, t in rows], "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(i, 0 if 170 <= i < 190 else 1, 0) for i, _ in rows if i < 190], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    out = by_id(corpus_pipeline.run(spark, str(tmp_path)).collect())
    assert set(out) == {i for i, _ in good}
    assert 4 <= len(corpus_pipeline.STAGES) <= 5
