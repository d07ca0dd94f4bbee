from __future__ import annotations

import math
import random

import numpy as np
import pytest

from fernlink.llm import common, fertility_rules

PIECES = common.tokenizer_path("piece_bpe_32k.model")
BYTES = common.tokenizer_path("byte_bpe_multi_50k.tiktoken")
HINDI = "यह एक सरल वाक्य है जो हमारे गाँव की नदी और पुराने पेड़ के बारे में बताता मौसम आज बहुत अच्छा सुबह बच्चे स्कूल जाते किताब पढ़ते".split()
THAI = "วันนี้ อากาศ ดี มาก เด็ก ไป โรงเรียน ตอน เช้า แม่น้ำ ใน หมู่บ้าน สวย งาม ต้นไม้ ใหญ่ หนังสือ เล่ม ใหม่ เขา อ่าน ทุก".split()


@pytest.mark.parametrize("n", [1, 5, 29, 31])
@pytest.mark.parametrize("lang", [True, False])
def test_rare_scripts_are_judged_by_their_own_median(spark, n, lang):
    r = random.Random(n)
    english = [(i, " ".join(r.choice(["the", "river", "children", "morning", "school", "reading", "and", "old", "village", "weather"]) for _ in range(300)), "en") for i in range(60)]
    rare = [(1000 * k + i, " ".join(r.choice(words) for _ in range(300)), name if lang else None) for k, (words, name) in enumerate([(HINDI, "hi"), (THAI, "th")], 1) for i in range(n)]
    table = spark.createDataFrame(english + rare, "doc_id long, text string, lang string")
    got = {x.doc_id: x for x in fertility_rules.rules(table, PIECES, BYTES).collect()}
    assert all(got[i].kept for i, *_ in english + rare if not got[i].base_failed)
    assert not any(got[i].base_failed for i, *_ in rare)


def test_verdicts_follow_from_the_measures(spark):
    """``kept`` of every document from its own row and the quartiles of its group, computed anew."""
    r = random.Random(8)
    words = ["the", "river", "children", "morning", "school", "reading", "and", "old", "village", "weather"]
    odd = ["xq" + "".join(r.choice("zkwvj0123") for _ in range(9)) for _ in range(400)]
    table = [(i, " ".join(r.choice(odd if i % 17 == 0 else words) for _ in range(r.randint(20, 400))), r.choice(["en", "fr", None])) for i in range(300)]
    table += [(400, None, "en"), (401, "", "fr"), (5, table[5][1], table[5][2]), (None, table[6][1], "en")]
    got = fertility_rules.rules(spark.createDataFrame(table, "doc_id long, text string, lang string").repartition(3), PIECES, BYTES, keep=("lang",)).collect()
    bands, verdicts = fertility_rules.Bands(), []
    assert len(got) == len(table)
    for x in got:
        group = [y for y in got if y.lang == x.lang and not y.base_failed]
        fine = not x.base_failed
        assert x.base_failed == (x.n_words < 50 or 100 * x.n_repeat_words > 50 * x.n_words)
        for m, least in zip(fertility_rules.MEASURES, bands.least, strict=True):
            q = np.percentile([round(y[m], 3) for y in group], [25, 50, 75])
            half = max(least, bands.width / 1.349 * (q[2] - q[0])) * math.sqrt((1 + bands.short / max(x.n_tokens, 1)) * (1 + bands.few / len(group)))
            fine = fine and abs(x[m] - q[1]) <= half
        assert x.kept == fine, x.doc_id
        verdicts.append((x.base_failed, x.kept))
    assert {(False, True), (False, False), (True, False)} <= set(verdicts)
