"""Quality rules from tokeniser fertility: characters per token, byte-fallback share and token entropy.

Public vocabularies split every distinct word once. The measures of all
documents give a median and a spread for each language (documents without a
language: their script); a document is rejected when a measure lies outside the
band around its group's median. Short documents get wider bands, as their
measures vary more, and so do the bands of groups of few documents, whose median
is less certain. A group is judged by its own median at every size.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fernlink.llm import common

SYMBOLS = b"#*$%&|<>"
MEASURES = ("piece_chars", "byte_chars", "fallback", "entropy")
#: Letters beyond Latin: (first, last code point, script).
SCRIPTS = ((0x370, 0x3FF, "greek"), (0x400, 0x52F, "cyrillic"), (0x530, 0x58F, "armenian"), (0x590, 0x5FF, "hebrew"), (0x600, 0x6FF, "arabic"), (0x900, 0x97F, "devanagari"), (0x980, 0x9FF, "bengali"), (0xA00, 0xA7F, "gurmukhi"), (0xA80, 0xAFF, "gujarati"), (0xB00, 0xB7F, "oriya"), (0xB80, 0xBFF, "tamil"), (0xC00, 0xC7F, "telugu"), (0xC80, 0xCFF, "kannada"), (0xD00, 0xD7F, "malayalam"), (0xD80, 0xDFF, "sinhala"), (0xE00, 0xE7F, "thai"), (0xE80, 0xEFF, "lao"), (0xF00, 0xFFF, "tibetan"), (0x1000, 0x109F, "myanmar"), (0x10A0, 0x10FF, "georgian"), (0x1200, 0x137F, "ethiopic"), (0x1780, 0x17FF, "khmer"), (0x1800, 0x18AF, "mongolian"), (0x3040, 0x30FF, "kana"), (0x4E00, 0x9FFF, "han"), (0xAC00, 0xD7AF, "hangul"))


@dataclass(frozen=True)
class Bands:
    """Band half-widths in robust standard deviations of the group, and the least half-widths.

    A measure of n tokens in a group of m sound documents gets its half-width times
    sqrt((1 + short / n) * (1 + few / m)).
    """

    width: float = 6.0
    least: tuple[float, float, float, float] = (0.35, 0.35, 0.05, 0.8)
    short: float = 200.0
    few: float = 30.0
    salts: int = 64


class _Vocabularies:
    def __init__(self, piece_path: str, byte_path: str):
        import base64

        import sentencepiece
        import tiktoken

        sp = sentencepiece.SentencePieceProcessor(model_file=piece_path)
        with open(byte_path, "rb") as f:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        tk = tiktoken.Encoding("bytes", pat_str=r"[^\S]*\S+", mergeable_ranks=ranks, special_tokens={})
        self.fallback = np.array([sp.is_byte(i) for i in range(sp.vocab_size())])
        one = tk._core_bpe.encode_single_piece
        self.pieces = common.WordIds(lambda words: [x + [len(one(b" " + w.encode("utf-8", "replace")))] for x, w in zip(sp.encode(words, num_threads=1), words, strict=True)], 250_000)


def _script(text: str) -> str:
    """Script of most letters; latin if there are none."""
    if text.isascii():
        return "latin"
    points = np.frombuffer(text.encode("utf-32-le", "replace"), np.uint32)
    counts = {s: 0 for *_, s in SCRIPTS}
    for lo, hi, s in SCRIPTS:
        counts[s] += int(((points >= lo) & (points <= hi)).sum())
    best = max(counts, key=lambda s: counts[s])
    return best if 2 * counts[best] > len(points) else "latin"


def _repeat_words(codes: np.ndarray) -> int:
    """Words inside three-word windows that occur twice or more in this text."""
    n = len(codes)
    if n < 4:
        return 0
    _, local = np.unique(codes, return_inverse=True)
    key = (local[:-2] * n + local[1:-1]) * n + local[2:] if n < 2_000_000 else np.unique(np.column_stack([local[:-2], local[1:-1], local[2:]]), axis=0, return_inverse=True)[1].ravel()
    order = np.argsort(key, kind="stable")
    k = key[order]
    same = k[1:] == k[:-1]
    hit = np.zeros(n - 2, bool)
    hit[order[1:][same]] = hit[order[:-1][same]] = True
    inside = np.zeros(n, bool)
    inside[:-2] |= hit
    inside[1:-1] |= hit
    inside[2:] |= hit
    return int(inside.sum())


def _entropies(ids: np.ndarray, offs: np.ndarray, vocabulary: int) -> np.ndarray:
    """Bits of entropy of the ids in each segment."""
    doc = np.repeat(np.arange(len(offs) - 1), np.diff(offs))
    key = np.sort(doc * vocabulary + ids)
    if not len(key):
        return np.zeros(len(offs) - 1)
    first = np.flatnonzero(np.r_[True, key[1:] != key[:-1]])
    count = np.diff(np.r_[first, len(key)])
    n = np.maximum(np.diff(offs), 1)
    s = np.bincount(key[first] // vocabulary, count * np.log2(count), len(offs) - 1)
    return np.log2(n) - s / n


def measure(docs: DataFrame, piece_path: str, byte_path: str, *keep: str) -> DataFrame:
    """Counts and fertility measures of every whole text (null: empty), one row each."""
    counts = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_tokens")
    schema = "doc_id long, _group string, " + ", ".join(f"{c} long" for c in counts) + "".join(f", {m} double" for m in MEASURES) + "".join(f", `{c}` {docs.schema[c].dataType.simpleString()}" for c in keep)

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        held = common.memory("fertility_rules")
        if (at := (piece_path, byte_path)) not in held:
            held[at] = _Vocabularies(*at)
        v = held[at]
        for batch in batches:
            for part, some in common.text_slices(batch):
                words, n_words = common.split_words(some)
                codes = v.pieces.codes(words)
                w_offs = common.offsets(n_words)
                ids = v.pieces.expand(codes)
                t_offs = common.offsets(v.pieces.lengths[codes])
                last = np.zeros(len(ids), bool)
                last[t_offs[1:] - 1] = True  # the last value of a word is its number of byte-level tokens
                byte_tokens = common.segment_sum(ids[last].astype(np.int64), w_offs)
                p_offs = t_offs[w_offs] - w_offs
                ids = ids[~last]
                n_tokens = np.diff(p_offs)
                chars = common.segment_sum(np.fromiter(map(len, words), np.int64, len(words)), w_offs)
                symbols, dup = np.zeros(len(some), np.int64), np.zeros(len(some), np.int64)
                for i, t in enumerate(some):
                    symbols[i] = sum(t.count(chr(c)) for c in SYMBOLS)
                    if "\n" in t:
                        lines = [x for x in t.split("\n") if common.WORD.search(x)]
                        dup[i] = len(lines) - len(set(lines))
                repeat = np.array([_repeat_words(codes[a:b]) for a, b in zip(w_offs[:-1], w_offs[1:], strict=True)], np.int64).reshape(-1)
                lang = part.column("_lang").to_pylist()
                group = [x if x else f"script:{_script(t)}" for x, t in zip(lang, some, strict=True)]
                some_tokens = np.maximum(n_tokens, 1)
                cols = [part.column("doc_id"), pa.array(group, pa.string()), *map(pa.array, (n_words, chars, symbols, dup, repeat, n_tokens))]
                cols += [pa.array(x) for x in (chars / some_tokens, chars / np.maximum(byte_tokens, 1), common.segment_sum(v.fallback[ids].astype(np.int64), p_offs) / some_tokens, _entropies(ids, p_offs, len(v.fallback)))]
                yield pa.RecordBatch.from_arrays([*cols, *(part.column(c) for c in keep)], ["doc_id", "_group", *counts, *MEASURES, *keep])

    lang = F.col("lang") if "lang" in docs.columns else F.lit(None).cast("string")
    rows = common.texts(docs, *(c for c in keep if c != "text"), lang.alias("_lang"))
    return common.mapped(rows, run, schema, "fertility_rules")


def rules(docs: DataFrame, piece_path: str, byte_path: str, bands: Bands = Bands(), keep: tuple[str, ...] = ()) -> DataFrame:
    """Counts, measures and verdict of every document.

    A null or empty text has no words and fails the base rule. ``lang`` may be
    absent or null; then the script groups the documents. Repeated rows are judged
    each. An empty table gives no rows. Other columns are
    ignored, but for those named in ``keep``.
    """
    spread = F.when(F.col("n_tokens") > 0, F.sqrt(F.lit(1) + F.lit(bands.short) / F.col("n_tokens"))).otherwise(F.lit(1.0))
    base_failed = (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    measured = common.staged(measure(docs, piece_path, byte_path, *keep), "fertility").withColumn("base_failed", base_failed)

    # quartiles of the measures in thousandths, from the counts of their values: exact, however rows are dealt
    sound = measured.where("not base_failed")
    values = sound.select("_group", F.posexplode(F.array(*(F.round(m, 3) for m in MEASURES))).alias("k", "v")).groupBy("_group", "k", "v").agg(F.count("*").alias("c"))
    quartiles = values.groupBy("_group", "k").agg(F.sum("c").alias("_n"), F.expr("percentile(v, array(0.25, 0.5, 0.75), c)").alias("q"))
    groups = quartiles.groupBy("_group").agg(F.max("_n").alias("_n"), *(F.max(F.when(F.col("k") == i, F.col("q"))).alias(f"_{m}") for i, m in enumerate(MEASURES)))
    spread = spread * F.sqrt(F.lit(1) + F.lit(bands.few) / F.col("_n"))
    salted = groups.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(bands.salts - 1))))  # a language may hold most rows
    rows = measured.withColumn("_salt", F.pmod(F.xxhash64("doc_id"), F.lit(bands.salts)).cast("int")).join(salted, ["_group", "_salt"], "left")
    inside = F.lit(True)
    for m, least in zip(MEASURES, bands.least, strict=True):
        q = F.col(f"_{m}")  # null only where the whole group fails the base rule
        half = F.greatest(F.lit(least), F.lit(bands.width / 1.349) * (q[2] - q[0])) * spread
        inside = inside & F.coalesce(F.abs(F.col(m) - q[1]) <= half, F.lit(True))
    return rows.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", (~F.col("base_failed") & inside).alias("kept"), "n_tokens", *MEASURES, *keep)


def op3_fertility_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rules(common.table(spark, sf_dir, "documents"), common.tokenizer_path("piece_bpe_32k.model"), common.tokenizer_path("byte_bpe_multi_50k.tiktoken"))
