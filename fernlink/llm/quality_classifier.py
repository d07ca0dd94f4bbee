"""Quality classifier: histogram gradient-boosted trees over statistics of a document's text.

The trees are trained on the driver from a bounded sample of labelled rows
(``Training.sample``), grown level by level over binned features, and flattened
into arrays of complete binary trees, which numpy walks for many documents at
once. Statistics are computed of every whole text in one pass without a shuffle.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fernlink.llm import common

#: Byte classes whose shares are features.
CLASSES = {
    "upper": range(0x41, 0x5B), "lower": range(0x61, 0x7B), "digit": range(0x30, 0x3A), "high": range(0x80, 0x100), "blank": b" \t", "newline": b"\n",
    "symbol": b"#*$%&<>", "bar": b"|", "exclaim": b"!?", "stop": b".", "comma": b",;:", "quote": b"'\"", "bracket": b"()[]{}", "mark": b"@_/\\=+~^`-", "control": [*range(9), *range(11, 32), 127],
}
MORE = ("log_bytes", "log_words", "word_bytes", "long_words", "distinct_words", "repeat_pairs", "repeat_lines", "line_words", "compressed", "byte_entropy", "symbol_words", "caps_words", "ended_lines")
FEATURES = (*CLASSES, *MORE)
_CLASS = np.zeros((256, len(CLASSES)))
for _j, _bytes in enumerate(CLASSES.values()):
    _CLASS[list(_bytes), _j] = 1


def statistics(some: list[str]) -> np.ndarray:
    """A row of FEATURES for each whole text; zeros for an empty one."""
    out = np.zeros((len(some), len(FEATURES)))
    for i, text in enumerate(some):
        raw = text.encode("utf-8", "replace")
        words = text.split()
        if not words:
            out[i, len(CLASSES)] = np.log1p(len(raw))
            continue
        n, m = len(raw), len(words)
        hist = np.bincount(np.frombuffer(raw, np.uint8), minlength=256)
        p = hist[hist > 0] / n
        lines = [x for x in text.split("\n") if x.strip()]
        pairs = set(zip(words, words[1:], strict=False))
        distinct = set(words)
        out[i] = [
            *(hist @ _CLASS / n), np.log1p(n), np.log1p(m), (n - m + 1) / m, sum(len(w) > 18 for w in distinct) / len(distinct), len(distinct) / m, 1 - len(pairs) / max(m - 1, 1), 1 - len(set(lines)) / len(lines),
            np.log1p(m / len(lines)), len(zlib.compress(raw, 1)) / n, -(p * np.log2(p)).sum(), sum(not w[-1].isalnum() and w[-1] not in ".,;:!?'\"" for w in distinct) / len(distinct), sum(w.isupper() for w in distinct) / len(distinct), sum(x.rstrip()[-1] in ".!?" for x in lines) / len(lines),
        ]
    return out


@dataclass(frozen=True)
class Training:
    """``sample`` bounds the labelled rows that are fetched to the driver: those of smallest id hash."""

    sample: int = 20_000
    trees: int = 80
    depth: int = 4
    rate: float = 0.15
    bins: int = 64
    l2: float = 5.0
    least: float = 10.0


@dataclass(frozen=True)
class Forest:
    """Complete trees in arrays: node k has children 2k + 1 and 2k + 2; a node without a split sends all left."""

    feature: np.ndarray
    threshold: np.ndarray
    leaf: np.ndarray
    base: float

    def score(self, x: np.ndarray) -> np.ndarray:
        """Probability of label 1 for each row, all rows walking a tree together."""
        total = np.full(len(x), self.base)
        rows, inner = np.arange(len(x)), self.feature.shape[1]
        for f, t, v in zip(self.feature, self.threshold, self.leaf, strict=True):
            node = np.zeros(len(x), np.int64)
            while len(node) and node[0] < inner:
                node = 2 * node + 1 + (x[rows, f[node]] > t[node])
            total += v[node - inner]
        return 1 / (1 + np.exp(-total))


def fit(x: np.ndarray, y: np.ndarray, how: Training) -> Forest:
    """Boost logistic loss. Without rows, or with one label only, the score is constant."""
    inner = 2**how.depth - 1
    share = (y.sum() + 1) / (len(y) + 2)
    base = float(np.log(share / (1 - share)))
    if len(np.unique(y)) < 2:
        return Forest(np.zeros((0, inner), np.int64), np.zeros((0, inner)), np.zeros((0, inner + 1)), base)
    edges = [np.unique(np.quantile(x[:, j], np.linspace(0, 1, how.bins + 1)[1:-1])) for j in range(x.shape[1])]
    binned = np.column_stack([np.searchsorted(e, x[:, j], side="left") for j, e in enumerate(edges)])  # bin <= k: x <= edge k
    n, wide = binned.shape
    cells = binned + np.arange(wide) * how.bins
    total = np.full(n, base)
    trees = []
    for _ in range(how.trees):
        p = 1 / (1 + np.exp(-total))
        grad, hess = y - p, p * (1 - p)
        feature, cut, at = np.zeros(inner, np.int64), np.full(inner, how.bins), np.zeros(n, np.int64)
        threshold = np.full(inner, np.inf)
        for level in range(how.depth):
            first, many = 2**level - 1, 2**level
            where = ((at - first)[:, None] * (wide * how.bins) + cells).ravel()
            shape = (many, wide, how.bins)
            g = np.bincount(where, np.repeat(grad, wide), many * wide * how.bins).reshape(shape).cumsum(2)
            h = np.bincount(where, np.repeat(hess, wide), many * wide * how.bins).reshape(shape).cumsum(2)
            gr, hr = g[:, :, -1:] - g, h[:, :, -1:] - h
            gain = g**2 / (h + how.l2) + gr**2 / (hr + how.l2) - g[:, :, -1:] ** 2 / (h[:, :, -1:] + how.l2)
            gain[(h < how.least) | (hr < how.least)] = 0
            best = gain.reshape(many, -1).argmax(1)
            for k in range(many):
                if gain[k].ravel()[best[k]] > 1e-9:
                    f, b = divmod(int(best[k]), how.bins)
                    feature[first + k], cut[first + k], threshold[first + k] = f, b, edges[f][b]
            at = 2 * at + 1 + (binned[np.arange(n), feature[at]] > cut[at])
        leaf = at - inner
        g, h = (np.bincount(leaf, v, inner + 1) for v in (grad, hess))
        value = how.rate * g / (h + how.l2)
        total += value[leaf]
        trees.append((feature, threshold, value))
    return Forest(*(np.array(v) for v in zip(*trees, strict=True)), base)


def train(docs: DataFrame, labels: DataFrame, how: Training = Training(), fold: tuple[int, int] = (4, 2)) -> Forest:
    """Learn from labelled rows outside the held-out fold.

    Labels that repeat for a document count by their mean; an even split or a null
    label is left out. A document that repeats is learned from each time.
    """
    known = (
        labels.where("quality is not null and doc_id is not null").where(~common.held_out(F.col("doc_id"), *fold))
        .groupBy("doc_id").agg(F.avg("quality").alias("_y")).where("_y <> 0.5")
        .orderBy(F.xxhash64("doc_id"), "doc_id").limit(how.sample)
    )
    rows = common.texts(docs).join(F.broadcast(known), "doc_id").select("doc_id", "text", (F.col("_y") > 0.5).alias("_y"))

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        for batch in batches:
            for part, some in common.text_slices(batch):
                x = pa.array(list(statistics(some)), pa.list_(pa.float64()))
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), part.column("_y"), x], ["doc_id", "y", "x"])

    known = common.mapped(rows, run, "doc_id long, y boolean, x array<double>", "quality_classifier")
    got = known.orderBy(F.xxhash64("doc_id"), "doc_id", "x").limit(how.sample).collect()  # a bounded sample
    x = np.array([r.x for r in got]).reshape(-1, len(FEATURES))
    return fit(x, np.array([float(r.y) for r in got]), how)


def score(docs: DataFrame, forest: Forest, threshold: float = 0.7, *keep: str) -> DataFrame:
    """doc_id, held_out, score and predicted of every row, and the columns named in ``keep``.

    A null or empty text is scored by its (zero) statistics. Repeated rows are
    scored each. An empty table gives no rows.
    """
    rows = common.texts(docs, *(c for c in keep if c != "text"))
    schema = "doc_id long, score double, predicted int" + "".join(f", `{c}` {docs.schema[c].dataType.simpleString()}" for c in keep)

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        for batch in batches:
            for part, some in common.text_slices(batch):
                p = forest.score(statistics(some))
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), pa.array(p), pa.array((p >= threshold).astype(np.int32)), *(part.column(c) for c in keep)], ["doc_id", "score", "predicted", *keep])

    return common.mapped(rows, run, schema, "quality_classifier")


def op1_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = common.table(spark, sf_dir, "documents")
    forest = train(docs, common.table(spark, sf_dir, "labels"))
    return score(docs, forest).select("doc_id", common.held_out(F.col("doc_id"), 4, 2).alias("held_out"), "score", "predicted")
