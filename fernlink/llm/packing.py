"""Packing documents into token sequences of bounded length, balanced by attention cost.

Each window of documents is packed on its own where it lies, without a shuffle.
A document is cut into full pieces of ``capacity`` and a rest. The rests fill as
many sequences as their tokens need: by descending cost, each goes to the
sequence of lowest cost that still has room, and is cut only if none has. What
remains after the full sequences goes to sequences of powers of two, which are
not padded, so that no sequence needs any padding.
"""

from __future__ import annotations

import json
import os
import re
import zlib
from collections.abc import Iterator
from pathlib import Path

import numpy as np
from pyspark.sql import DataFrame, SparkSession

from fernlink.llm import common


def _byte_of_char() -> dict[str, int]:
    """The byte that each character of a byte-level vocabulary stands for: printable ones themselves, the rest from U+0100."""
    own = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in own]
    return {chr(b): b for b in own} | {chr(256 + i): b for i, b in enumerate(rest)}


class FastWords:
    """The ids of words, as the tokenizer file gives them, from merges over bytes.

    A byte 0xFF, which UTF-8 never has, stands for the word end; it joins the last
    byte before any merge. Words with characters beyond U+024F go to the tokenizer
    itself, so Unicode normalisation is never imitated.
    """

    PLAIN = re.compile("[\x21-\x7e\xa1-\u012f\u0131-\u024f]+")
    #: The split pattern of the vocabulary file.
    SPLIT = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"

    def __init__(self, path: str, limit: int = 150_000):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        import regex
        import tiktoken
        from tokenizers import Tokenizer

        self.whole = Tokenizer.from_file(path)
        model = json.loads(Path(path).read_text())["model"]
        to_byte = _byte_of_char()
        as_bytes = lambda t: bytes(to_byte[c] for c in t.removesuffix("</w>")) + b"\xff" * t.endswith("</w>")
        merged = [m.split(" ") if isinstance(m, str) else m for m in model["merges"]]
        ranks = {bytes([b]): b for b in range(256)} | {bytes([b, 255]): 256 + b for b in range(255)}
        for a, b in merged:
            ranks.setdefault(as_bytes(a) + as_bytes(b), 256 + 255 + len(ranks))
        ids = {as_bytes(t): i for t, i in model["vocab"].items() if set(t.removesuffix("</w>")) <= to_byte.keys()}
        self.id_of = {r: ids[t] for t, r in ranks.items() if t in ids}
        self.bpe = tiktoken.Encoding("merges", pat_str=r"\S+", mergeable_ranks=ranks, special_tokens={})._core_bpe
        self.split = regex.compile(self.SPLIT)
        self.limit = limit
        self.parts: dict[str, tuple[int, ...]] = {}

    def part(self, p: str) -> tuple[int, ...]:
        if len(self.parts) > self.limit:
            self.parts.clear()
        got = self.parts[p] = tuple(map(self.id_of.__getitem__, self.bpe.encode_single_piece(p.encode() + b"\xff")))
        return got

    def __call__(self, words: list[str]) -> list[list[int]]:
        out: list = [None] * len(words)
        other, parts = [], self.parts
        for i, w in enumerate(words):
            if "<|" in w or not self.PLAIN.fullmatch(w):  # the strings of special ids start so
                other.append(i)
                continue
            low = w.lower()
            split = [low] if low.isalpha() else self.split.findall(low)
            if len(split) == 1:
                out[i] = parts.get(split[0]) or self.part(split[0])
            else:
                out[i] = [x for p in split for x in (parts.get(p) or self.part(p))]
        if other:
            for i, e in zip(other, self.whole.encode_batch_fast([words[i] for i in other], add_special_tokens=False), strict=True):
                out[i] = e.ids
        return out


def word_encoder(path: str) -> common.WordIds:
    """Encoder of words for the vocabulary with word ends, whose pre-tokens never hold white space."""
    held = common.memory("packing")
    if path not in held:
        held[path] = common.WordIds(FastWords(path), 400_000, 16_000_000)
    return held[path]


def attention_cost(tokens: np.ndarray, linear: float, quadratic: float) -> np.ndarray:
    return linear * tokens + quadratic * tokens.astype(float) ** 2


def capacities(total: int, capacity: int) -> np.ndarray:
    """Sequence sizes for ``total`` tokens: full ones, then falling powers of two."""
    rest = total % capacity
    return np.array([capacity] * (total // capacity) + [1 << b for b in range(rest.bit_length() - 1, -1, -1) if rest >> b & 1], np.int64)


def pack_window(lengths: np.ndarray, capacity: int, linear: float = 1.0, quadratic: float = 1 / 4096) -> list[tuple[int, int, int, int, int]]:
    """Pieces (document, start, length, sequence, offset) of documents of these lengths."""
    pieces, sequences = [], 0
    rest = lengths % capacity
    for d in np.flatnonzero(lengths >= capacity).tolist():
        for start in range(0, int(lengths[d]) - capacity + 1, capacity):
            pieces.append((d, start, capacity, sequences, 0))
            sequences += 1
    room = capacities(int(rest.sum()), capacity)
    size, cost = room.copy(), np.zeros(len(room))
    weights = attention_cost(rest, linear, quadratic)
    for d in np.lexsort((np.arange(len(rest)), -weights)).tolist():
        start, left = int(lengths[d] - rest[d]), int(rest[d])
        while left:
            fits = room >= left
            if fits.any():
                s, n = int(np.argmin(np.where(fits, cost, np.inf))), left
            else:
                s = int(np.argmin(np.where(room > 0, cost, np.inf)))
                n = int(room[s])
            pieces.append((d, start, n, sequences + s, int(size[s] - room[s])))
            room[s] -= n
            cost[s] += linear * n + quadratic * n * n
            start, left = start + n, left - n
    return pieces


def pack(docs: DataFrame, path: str, capacity: int = 4096, end_id: int = 2, linear: float = 1.0, quadratic: float = 1 / 4096, window_tokens: int = 1_000_000, with_ids: bool = False) -> DataFrame:
    """Pieces of all documents, packed into sequences of at most ``capacity`` tokens.

    Reads doc_id and text; other columns are ignored. A null or empty text is its
    end id alone. Every row is a document of its own, even if its doc_id repeats
    or is null. An empty table gives no rows. ``window_tokens`` bounds the memory of
    a task. ``with_ids`` adds the piece's ids.
    """
    spark = docs.sparkSession
    schema = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"
    if with_ids:
        schema += ", ids array<int>"

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa
        from pyspark import TaskContext

        base = TaskContext.get().partitionId() << 32
        encoder = word_encoder(path)
        held: list[tuple] = []
        used, waiting = 0, 0

        def flush():
            nonlocal used, waiting
            doc_ids = [i for x in held for i in x[0]]
            lengths = np.concatenate([x[2] for x in held])
            flat = np.concatenate([x[1] for x in held])
            at = common.offsets(lengths)
            pieces = pack_window(lengths, capacity, linear, quadratic)
            d, start, n, seq, off = (np.array(x, np.int64) for x in zip(*pieces, strict=True))
            lo = at[d] + start
            raw = memoryview(flat.astype("<u4")).cast("B")
            crc = [zlib.crc32(raw[4 * a : 4 * b]) for a, b in zip(lo.tolist(), (lo + n).tolist(), strict=True)]
            cols = [pa.array([doc_ids[i] for i in d.tolist()], pa.int64()), start, n, np.array(crc, np.int64), lengths[d], base + used + seq, off]
            names = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]
            if with_ids:
                offs = common.offsets(n).astype(np.int32)
                cols.append(pa.ListArray.from_arrays(pa.array(offs), pa.array(flat[common.ranges(lo, n)].astype(np.int32))))
                names.append("ids")
            used += int(seq.max()) + 1
            held.clear()
            waiting = 0
            return pa.RecordBatch.from_arrays([x if isinstance(x, pa.Array) else pa.array(x) for x in cols], names)

        for batch in batches:
            for part, some in common.text_slices(batch):
                words, counts = common.split_words(some)
                codes = encoder.codes(words)
                per_word = common.offsets(encoder.lengths[codes])
                ends = per_word[common.offsets(counts)]
                flat = encoder.expand(codes)
                lengths = np.diff(ends) + 1
                flat = np.insert(flat, ends[1:], end_id)
                held.append((part.column("doc_id").to_pylist(), flat, lengths))
                waiting += len(flat)
                if waiting >= window_tokens:
                    yield flush()
        if held:
            yield flush()

    return common.mapped(common.texts(docs), run, schema, "packing")


def op10_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(common.table(spark, sf_dir, "documents"), common.tokenizer_path("word_bpe_49k.json"))
