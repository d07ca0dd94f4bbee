"""Helpers shared by the text operators."""

from __future__ import annotations

import contextlib
import gc
import os
import re
import tempfile
import uuid
import zipfile
from collections.abc import Iterator
from itertools import chain
from pathlib import Path

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

WORD = re.compile(r"[^\x20\x09-\x0D]+")
TOKENIZER_DIR = "/opt/tokenizers"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def tokenizer_path(name: str, folder: str | None = None) -> str:
    """Path of a vocabulary file that every executor has; ``folder`` overrides the installed place."""
    if folder is None:
        try:
            import public_tokenizers

            return public_tokenizers.path(name)
        except ImportError:
            folder = TOKENIZER_DIR
    return os.path.join(folder, name)


def id_remainder(doc_id: Column, modulus: int) -> Column:
    """crc32 of the id as text, modulo ``modulus``; null for a null id."""
    return F.crc32(doc_id.cast("string").cast("binary")) % F.lit(modulus)


def held_out(doc_id: Column, modulus: int, remainder: int) -> Column:
    """True for the held-out fold. A null id counts as held out, so nothing is learned from it."""
    return F.coalesce(id_remainder(doc_id, modulus) == remainder, F.lit(True))


def ship(spark: SparkSession) -> None:
    """Send this package's code to the executors, once a session."""
    sc = spark.sparkContext
    if getattr(sc, "_fernlink_shipped", False):
        return
    root = Path(__file__).resolve().parents[1]
    out = Path(tempfile.mkdtemp(prefix="fernlink-code-")) / "fernlink_code.zip"
    with zipfile.ZipFile(out, "w") as z:
        for f in sorted(root.rglob("*.py")):
            z.write(f, f.relative_to(root.parent))
    sc.addPyFile(str(out))
    sc._fernlink_shipped = True


def texts(docs: DataFrame, *more: str) -> DataFrame:
    """doc_id, text (null: empty) and the named further columns, nothing else."""
    ship(docs.sparkSession)
    return docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"), *more)


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share. Without one, a temporary folder serves where both are one process; a cluster must name it."""
    where = spark.conf.get("spark.checkpoint.dir", None)
    if not where:
        if not spark.sparkContext.master.startswith("local[") and spark.sparkContext.master != "local":
            raise ValueError("spark.checkpoint.dir must name a folder that the driver and all executors share")
        where = getattr(spark, "_fernlink_shared", None)
        if where is None:
            where = spark._fernlink_shared = tempfile.mkdtemp(prefix="fernlink-")
    return f"{where.rstrip('/')}/fernlink"


def staged(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` as Parquet in the shared folder and read it back: cuts lineage and survives lost executors."""
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/{label}-{uuid.uuid4().hex}"
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


#: What workers remember between batches, by operator; a task empties what other operators left.
_MEMORY: dict[str, dict] = {}
_OWNERS: list[tuple[str, ...]] = []
#: glibc's mallopt options and values: arrays up to 32 MiB come from the heap, of which up to 256 MiB stay for the next arrays of the task.
_MALLOC = ((-3, 32 << 20), (-1, 256 << 20))


def memory(owner: str) -> dict:
    """What the named operator remembers in this process."""
    return _MEMORY.setdefault(owner, {})


def _libc():
    import ctypes

    try:
        return ctypes.CDLL("libc.so.6")
    except OSError:  # another C library: its own ways of keeping memory stay
        return None


def _give_back() -> None:
    """Return what is free in this process to the system."""
    import pyarrow as pa

    pa.default_memory_pool().release_unused()
    if (c := _libc()) is not None:
        c.malloc_trim(0)


@contextlib.contextmanager
def working(*owners: str) -> Iterator[None]:
    """A task of the named operators in a Python worker.

    Workers outlive stages, so a task first forgets what other operators left there,
    and gives free memory back at its end. Python's cycle search, which would walk
    the remembered words again and again, is held meanwhile.
    """
    if _OWNERS != [owners]:
        for name, held in _MEMORY.items():
            if name not in owners:
                held.clear()
        if not _OWNERS and (c := _libc()) is not None:
            for option, value in _MALLOC:
                c.mallopt(option, value)
        _OWNERS[:] = [owners]
        gc.collect()
        _give_back()
    gc.disable()
    try:
        yield
    finally:
        gc.enable()
        _give_back()


def mapped(df: DataFrame, run, schema: str, *owners: str) -> DataFrame:
    """``df.mapInArrow(run, schema)`` as tasks of the named operators."""

    def task(batches: Iterator) -> Iterator:
        with working(*owners):
            yield from run(batches)

    return df.mapInArrow(task, schema)


def slices(sizes: np.ndarray, limit: int) -> Iterator[slice]:
    """Consecutive slices whose sizes sum to about ``limit``; every item is in one slice."""
    start, total = 0, 0
    for i, n in enumerate(sizes.tolist()):
        if total and total + n > limit:
            yield slice(start, i)
            start, total = i, 0
        total += n
    if start < len(sizes):
        yield slice(start, len(sizes))


def text_slices(batch, limit: int = 2_000_000, column: str = "text") -> Iterator[tuple]:
    """(batch slice, list of texts) for bounded amounts of text in ``column`` of an Arrow batch."""
    import pyarrow.compute as pc

    sizes = pc.binary_length(batch.column(column)).to_numpy(zero_copy_only=False) + 16
    for s in slices(sizes, limit):
        part = batch.slice(s.start, s.stop - s.start)
        yield part, part.column(column).to_pylist()


def ranges(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Indices of the concatenated ranges [start, start + length)."""
    total = int(lengths.sum())
    if not total:
        return np.empty(0, np.int64)
    ends = np.cumsum(lengths)
    return np.arange(total, dtype=np.int64) + np.repeat(starts - (ends - lengths), lengths)


class _Codes(dict):
    """Numbers its keys from 0 in the order of their first look-up; ``new`` collects them."""

    def __init__(self):
        super().__init__()
        self.new: list[str] = []

    def __missing__(self, word: str) -> int:
        self.new.append(word)
        n = self[word] = len(self)
        return n


class WordIds:
    """Ids of words under a tokenizer that never crosses the split, remembered for distinct words.

    ``encode`` takes a list of distinct words and returns a list of id lists. At most
    ``limit`` words and ``chars`` characters are remembered, then the memory starts
    anew, so a Python worker stays bounded however many words the corpus has.
    """

    def __init__(self, encode, limit: int = 300_000, chars: int = 8_000_000):
        self.encode, self.limit, self.chars = encode, limit, chars
        self.reset()

    def reset(self) -> None:
        self.code = _Codes()
        self.held = 0
        self.ids = np.empty(0, np.uint32)
        self.starts = np.empty(0, np.int64)
        self.lengths = np.empty(0, np.int64)

    def codes(self, words: list[str]) -> np.ndarray:
        """A code for each word; starts, lengths and ids are indexed by it until the next call."""
        if len(self.code) > self.limit or self.held > self.chars:
            self.reset()
        codes = np.fromiter(map(self.code.__getitem__, words), np.int64, len(words))
        if new := self.code.new:
            got = self.encode(new)
            lengths = np.fromiter(map(len, got), np.int64, len(got))
            flat = np.fromiter(chain.from_iterable(got), np.uint32, int(lengths.sum()))
            self.starts = np.concatenate([self.starts, len(self.ids) + np.cumsum(lengths) - lengths])
            self.lengths = np.concatenate([self.lengths, lengths])
            self.ids = np.concatenate([self.ids, flat])
            self.held += sum(map(len, new))
            self.code.new = []
        return codes

    def expand(self, codes: np.ndarray) -> np.ndarray:
        return self.ids[ranges(self.starts[codes], self.lengths[codes])]


def split_words(docs: list[str]) -> tuple[list[str], np.ndarray]:
    """All words of the texts in order, and the number of each text."""
    each = [WORD.findall(t) for t in docs]
    return [w for x in each for w in x], np.fromiter(map(len, each), np.int64, len(each))


def offsets(lengths: np.ndarray) -> np.ndarray:
    return np.concatenate([[0], np.cumsum(lengths)]).astype(np.int64)


def segment_sum(values: np.ndarray, offs: np.ndarray) -> np.ndarray:
    """Sums of values[offs[i]:offs[i + 1]]; empty segments give 0."""
    total = np.concatenate([[0], np.cumsum(values)])
    return total[offs[1:]] - total[offs[:-1]]


def runs(batches: Iterator, key: str) -> Iterator:
    """Tables of the rows of one key each, from batches that are sorted by it."""
    import pyarrow as pa

    held: list = []
    for batch in batches:
        if not batch.num_rows:
            continue
        k = batch.column(key).to_numpy(zero_copy_only=False)
        cuts = np.flatnonzero(k[1:] != k[:-1]) + 1
        if held and held[-1].column(key)[0].as_py() != k[0]:
            yield pa.Table.from_batches(held)
            held = []
        at = 0
        for c in cuts.tolist():
            yield pa.Table.from_batches([*held, batch.slice(at, c - at)])
            held, at = [], c
        held.append(batch.slice(at))
    if held:
        yield pa.Table.from_batches(held)


def list_column(table, name: str) -> tuple[np.ndarray, np.ndarray]:
    """Flat values and offsets of a list column without nulls."""
    col = table.column(name)
    col = col.combine_chunks() if hasattr(col, "combine_chunks") else col
    if hasattr(col, "chunks"):
        col = col.chunk(0)
    offs = col.offsets.to_numpy()
    return col.values.to_numpy(zero_copy_only=False)[offs[0] : offs[-1]], offs - offs[0]


def components(edges: DataFrame, label: str) -> DataFrame:
    """node and its component's least node, for every node of the edges (columns a, b).

    Alternates large-star and small-star steps until the edges form stars. Each step
    is a sum over the edges of a node and a join, so a node of any degree is spread.
    """

    def star(e: DataFrame) -> DataFrame:
        least = e.groupBy("u").agg(F.min("v").alias("m"))
        return e.join(least, "u")

    now = staged(edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).where("u <> v").distinct(), label)
    mark = None
    while True:
        both = now.unionByName(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        large = star(both).withColumn("m", F.least("m", "u")).where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = large.where("u <> v").distinct()
        small = star(large)
        small = small.select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(small.select("u", F.col("m").alias("v"))).where("u <> v").distinct()
        now = staged(small, label)
        was, mark = mark, tuple(now.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())
        if was == mark:
            return now.select(F.col("u").alias("node"), F.col("v").alias("least")).unionByName(now.select(F.col("v").alias("node"), F.col("v").alias("least")).distinct())


def whole_runs(batches: Iterator, key: str) -> Iterator:
    """Tables of whole runs of equal keys, about a batch each, from batches that are sorted by the key."""
    import pyarrow as pa

    held: list = []
    for batch in batches:
        if not batch.num_rows:
            continue
        k = batch.column(key).to_numpy(zero_copy_only=False)
        if held and held[-1].column(key)[0].as_py() != k[0] and k[0] == k[-1]:
            yield pa.Table.from_batches(held).combine_chunks()
            held = []
        if k[0] != k[-1]:
            cut = int(np.argmax(k == k[-1]))
            yield pa.Table.from_batches([*held, batch.slice(0, cut)]).combine_chunks()
            held, batch = [], batch.slice(cut)
        held.append(batch)
    if held:
        yield pa.Table.from_batches(held).combine_chunks()
