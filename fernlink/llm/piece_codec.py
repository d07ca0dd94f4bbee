"""SentencePiece encoding and decoding by a Viterbi search over batches of words."""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fernlink.llm import common, pieces


def encoder(path: str) -> common.WordIds:
    held = common.memory("piece_codec")
    if path not in held:
        p = pieces.load(path)
        held[path] = common.WordIds(lambda words: pieces.viterbi(p, words), 400_000)
    return held[path]


def _encoded(some: list[str], path: str) -> tuple[np.ndarray, np.ndarray]:
    """Flat ids, and the offsets of each text's."""
    p, enc = pieces.load(path), encoder(path)
    each = [p.words(t) for t in some]
    codes = enc.codes([w for x in each for w in x])
    per_word = common.offsets(enc.lengths[codes])
    return enc.expand(codes).astype(np.int32), per_word[common.offsets(np.fromiter(map(len, each), np.int64, len(each)))]


def encode(docs: DataFrame, path: str) -> DataFrame:
    """doc_id and ids (array) of every whole text; null or empty: no ids. Repeated rows are encoded each."""

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        for batch in batches:
            for part, some in common.text_slices(batch):
                ids, offs = _encoded(some, path)
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), pa.ListArray.from_arrays(pa.array(offs.astype(np.int32)), pa.array(ids))], ["doc_id", "ids"])

    return common.mapped(common.texts(docs), run, "doc_id long, ids array<int>", "piece_codec", "pieces")


def decode(encoded: DataFrame, path: str) -> DataFrame:
    """doc_id and text of every row of ids; null or empty ids give an empty text."""
    common.ship(encoded.sparkSession)

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        p = pieces.load(path)
        for batch in batches:
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array([p.decode(np.array(x, np.int64)) for x in batch.column("ids").to_pylist()], pa.string())], ["doc_id", "text"])

    ids = F.coalesce("ids", F.array().cast("array<int>")).alias("ids")
    return common.mapped(encoded.select("doc_id", ids), run, "doc_id long, text string", "piece_codec", "pieces")


def digests(docs: DataFrame, path: str) -> DataFrame:
    """Sizes and digests of the ids of every whole text, and of the text that they decode to.

    ``round_trip`` says whether decoding gives the text again; it does unless the text
    itself holds the character that stands for a space. Empty tables give no rows.
    """

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        p = pieces.load(path)
        for batch in batches:
            for part, some in common.text_slices(batch):
                ids, offs = _encoded(some, path)
                raw = memoryview(ids.astype("<u4")).cast("B")
                crc = [zlib.crc32(raw[4 * a : 4 * b]) for a, b in zip(offs[:-1].tolist(), offs[1:].tolist(), strict=True)]
                back = [p.decode(ids[a:b]) for a, b in zip(offs[:-1].tolist(), offs[1:].tolist(), strict=True)]
                cols = [pa.array(np.diff(offs)), pa.array(common.segment_sum(p.is_byte[ids].astype(np.int64), offs)), pa.array(crc, pa.int64()), pa.array([hashlib.sha256(t.encode()).hexdigest() for t in back]), pa.array([a == b for a, b in zip(back, some, strict=True)], pa.bool_())]
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), *cols], ["doc_id", "n_pieces", "n_byte_pieces", "ids_crc32", "decoded_sha256", "round_trip"])

    schema = "doc_id long, n_pieces long, n_byte_pieces long, ids_crc32 long, decoded_sha256 string, round_trip boolean"
    return common.mapped(common.texts(docs), run, schema, "piece_codec", "pieces")


def op6_piece_codec(spark: SparkSession, sf_dir: str) -> DataFrame:
    return digests(common.table(spark, sf_dir, "documents"), common.tokenizer_path("piece_bpe_32k.model"))
