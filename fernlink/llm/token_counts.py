"""Token counts of documents by dynamic programming over a trie of distinct pre-tokens."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
from pyspark.sql import DataFrame, SparkSession

from fernlink.llm import common, pieces


def _counter(path: str) -> common.WordIds:
    held = common.memory("token_counts")
    if path not in held:
        p = pieces.load(path)
        held[path] = common.WordIds(lambda words: [(n,) for n in pieces.trie_counts(p, words).tolist()], 500_000, 16_000_000)
    return held[path]


def token_counts(docs: DataFrame, path: str) -> DataFrame:
    """doc_id, n_pretokens and n_tokens of every whole text.

    A null or empty text has none of either. Repeated rows are counted each. Other
    columns are ignored; an empty table gives no rows.
    """

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        p, counter = pieces.load(path), _counter(path)
        for batch in batches:
            for part, some in common.text_slices(batch, 4_000_000):
                each = [p.words(t) for t in some]
                n = np.fromiter(map(len, each), np.int64, len(each))
                codes = counter.codes([w for x in each for w in x])
                total = common.segment_sum(counter.ids[counter.starts[codes]].astype(np.int64), common.offsets(n))
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), pa.array(n), pa.array(total)], ["doc_id", "n_pretokens", "n_tokens"])

    return common.mapped(common.texts(docs), run, "doc_id long, n_pretokens long, n_tokens long", "token_counts", "pieces")


def op5_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts(common.table(spark, sf_dir, "documents"), common.tokenizer_path("piece_bpe_32k.model"))
