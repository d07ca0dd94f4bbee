"""N-gram Jaccard join with a MinHash LSH forest and exact verification.

Documents of one set of word shingles are one class from the start. The signature of
a class holds ``longest`` MinHash values for each of ``trees`` prefix tries. A trie is
kept as its sorted keys: a node of level d is the run of classes whose first d values
there agree. Classes are matched by their longest prefixes first; level by level the
prefixes are shortened, and a node that does not branch has nothing new and is passed
over. A pair belongs to the level of its longest match and to the first trie that has
it there, and is verified in that node, once, on the whole shingle sets.

After each level the verified pairs tell how many links are still unseen: a link of
similarity J is seen with probability p = 1 - (1 - J^d)^trees, so it stands for
(1 - p) / p unseen ones. Shortening ends when the classes with links, and one more
whose link has the least similarity, reach the target recall on average, and at the
latest at ``shortest()``, where every pair at the least similarity reaches it by itself.

A run is dealt in cells of two blocks at most, so a run of any length is spread over
tasks. Pairs never become rows: a cell gives each member its links, summed, and a
spanning edge.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fernlink.llm import common

_WIDE = np.uint64(0x9E3779B97F4A7C15)


@dataclass(frozen=True)
class Forest:
    words: int = 5
    percent: int = 80  # least Jaccard similarity, in hundredths
    trees: int = 16
    longest: int = 6  # prefix, in values of the signature
    recall: float = 0.9995
    block: int = 512
    broadcast: int = 2_000_000

    def shortest(self) -> int:
        """The longest prefix at which a pair at the least similarity is found with the target recall."""
        d = self.longest
        while d > 1 and 1 - (1 - (self.percent / 100) ** d) ** self.trees < self.recall:
            d -= 1
        return d

    def unseen(self, similarity, level: int):
        """Unseen links for each seen one of a similarity, when prefixes of ``level`` values and more are matched."""
        p = 1 - (1 - similarity**level) ** self.trees
        return (1 - p) / p


def mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def _word_hashes(words: list[str]) -> np.ndarray:
    held = common.memory("shingle_join")
    if not held:
        import xxhash

        def halves(some: list[str]) -> list[tuple[int, int]]:
            h = [xxhash.xxh64_intdigest(w.encode("utf-8", "surrogatepass")) for w in some]
            return [(x & 0xFFFFFFFF, x >> 32) for x in h]

        held["words"] = common.WordIds(halves, 250_000)
    codes = held["words"].codes(words)
    return held["words"].ids.view(np.uint64)[codes]


def shingles(some: list[str], n: int) -> list[np.ndarray]:
    """Sorted distinct 64-bit hashes of the n-word shingles of each text; all its words make one if there are fewer than n."""
    words, counts = common.split_words(some)
    h = _word_hashes(words)
    offs = common.offsets(counts)
    rolled = np.zeros(max(len(h) - n + 1, 0), np.uint64)
    for i in range(n):
        rolled = rolled * _WIDE + h[i : i + len(rolled)]
    rolled = mixed(rolled)
    out = []
    for a, b in zip(offs[:-1].tolist(), offs[1:].tolist(), strict=True):
        if b - a >= n:
            out.append(np.unique(rolled[a : b - n + 1]))
        elif b > a:
            x = np.array([b - a], np.uint64)
            for i in range(a, b):
                x = x * _WIDE + h[i]
            out.append(mixed(x))
        else:
            out.append(np.empty(0, np.uint64))
    return out


def prefixes(sets: list[np.ndarray], how: Forest) -> np.ndarray:
    """Keys of the signature's prefixes of each set (not empty): by set, level from ``how.shortest()`` up, and tree."""
    low, deep = how.shortest(), how.longest
    rng = np.random.default_rng(20_240_607)
    a = rng.integers(1, 1 << 63, how.trees * deep, dtype=np.uint64) | np.uint64(1)
    b = rng.integers(0, 1 << 63, how.trees * deep, dtype=np.uint64)
    out = np.empty((len(sets), deep - low + 1, how.trees), np.uint64)
    tree = np.arange(how.trees, dtype=np.uint64)
    for i, s in enumerate(sets):
        sig = np.full(len(a), np.iinfo(np.uint64).max, np.uint64)
        for at in range(0, len(s), 2048):
            np.minimum(sig, ((s[at : at + 2048, None] * a + b) >> np.uint64(24)).min(0), out=sig)
        key = tree + np.uint64(1)
        for d in range(deep):
            key = mixed(key * _WIDE + sig[d::deep])
            if d + 1 >= low:
                out[i, d + 1 - low] = key
    return out


def _new_pairs(keys: np.ndarray, tree: int, side: np.ndarray, cross: bool) -> np.ndarray:
    """Matrix of the pairs (i < j) of a cell that no longer prefix and no earlier tree has; across sides only, where the cell joins two blocks.

    ``keys``: by member, level (that of the cell and, if there is one, the next) and tree.
    """
    g = len(keys)
    new = np.triu(np.ones((g, g), bool), 1)
    if cross:
        new &= side[:, None] != side
    for known in (*keys[:, 0, :tree].T, *keys[:, 1:].reshape(g, -1).T):
        new &= known[:, None] != known
    return new


def _alike(sizes: np.ndarray, percent: int) -> np.ndarray:
    return 100 * np.minimum(sizes[:, None], sizes) >= percent * np.maximum(sizes[:, None], sizes)


def common_counts(flat: np.ndarray, owner: np.ndarray, g: int, width: int = 4096) -> np.ndarray:
    """Sizes of the intersections of g sets, given all elements and their owners."""
    order = np.argsort(flat, kind="stable")
    f, o = flat[order], owner[order]
    start = np.flatnonzero(np.r_[True, f[1:] != f[:-1]]) if len(f) else np.empty(0, np.int64)
    size = np.diff(np.r_[start, len(f)])
    shared = size > 1
    rows = o[common.ranges(start[shared], size[shared])]
    cols = np.repeat(np.arange(int(shared.sum())), size[shared])
    out = np.zeros((g, g), np.float64)
    edges = np.searchsorted(cols, np.arange(0, int(shared.sum()) + width, width))
    for k in range(len(edges) - 1):
        lo, hi = edges[k], edges[k + 1]
        m = np.zeros((g, width), np.float32)
        m[rows[lo:hi], cols[lo:hi] - k * width] = 1
        out += m @ m.T
    return np.rint(out).astype(np.int64)


def _stars(linked: np.ndarray) -> np.ndarray:
    """For each row of a symmetric matrix, the least index of its component."""
    label = np.arange(len(linked))
    while True:
        low = np.where(linked, label, len(linked)).min(1)
        new = np.minimum(label, low)
        new = new[new]
        if (new == label).all():
            return label
        label = new


def join(docs: DataFrame, how: Forest = Forest()) -> DataFrame:
    """doc_id, class_id and n_links of every row.

    Documents link when the Jaccard similarity of their word-shingle sets is at least
    ``how.percent`` hundredths; class_id is the least doc_id of the linked
    documents, n_links the number of other documents with a link. A text of one to
    four words is one shingle. A null or empty text, or one without words, links
    with nothing. A repeated row is a document of its own; rows that share
    an id share a class if either is linked. A row without an id has a
    null class and no links, and gives none. Other columns are ignored.
    """
    pieces = common.texts(docs).where("doc_id is not null")
    trees, percent, n, block, low = how.trees, how.percent, how.words, how.block, how.shortest()
    levels = how.longest - low + 1

    def signed(batches: Iterator) -> Iterator:
        import pyarrow as pa

        for batch in batches:
            for part, some in common.text_slices(batch):
                sets = shingles(some, n)
                kept = [i for i, s in enumerate(sets) if len(s)]
                keys = prefixes([sets[i] for i in kept], how).view(np.int64)
                digest = [hashlib.blake2b(sets[i].tobytes(), digest_size=16).digest() for i in kept]
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id").take(pa.array(kept, pa.int64())), pa.array(digest, pa.binary()), pa.array([len(sets[i]) for i in kept], pa.int32()), pa.ListArray.from_arrays(pa.array(np.arange(len(kept) + 1, dtype=np.int32) * (levels * trees)), pa.array(keys.ravel()))],
                    ["doc_id", "digest", "size", "keys"],
                )

    signed_docs = common.staged(common.mapped(pieces, signed, "doc_id long, digest binary, size int, keys array<long>", "shingle_join"), "signed")
    classes = common.staged(signed_docs.groupBy("digest").agg(F.min("doc_id").alias("rep"), F.count("*").alias("copies"), F.first("size").alias("size"), F.first("keys").alias("keys")), "classes")
    # nodes of two classes and more at the shortest prefix; all longer matches are below them
    tries = classes.select("rep", "digest", F.explode(F.sequence(F.lit(0), F.lit(trees - 1))).alias("tree"), "keys")
    tries = tries.withColumn("path", F.expr(f"transform(sequence(0, {levels - 1}), i -> keys[i * {trees} + tree])")).drop("keys").withColumn("key", F.col("path")[0])
    matched = common.staged(tries.join(tries.groupBy("key").agg(F.count("*").alias("run")).where("run > 1").select("key"), "key").drop("key"), "matched")
    fields = "rep long, digest binary, tree int, cell long, side int, cross boolean, copies long, size int, keys array<long>"

    def cells_of(level: int) -> DataFrame:
        """Members of the cells of all nodes of the level that branch; at the longest prefix, of all nodes."""
        at = level - low
        here = matched.withColumn("key", F.col("path")[at])
        nodes = here.groupBy("key").agg(F.count("*").alias("run"), *((F.min(F.col("path")[at + 1]).alias("a"), F.max(F.col("path")[at + 1]).alias("b")) if level < how.longest else ()))
        nodes = nodes.where("a <> b" if level < how.longest else "run > 1").select("key", "run")
        spread = here.join(nodes, "key").withColumn("blocks", F.ceil(F.col("run") / block).cast("int"))
        spread = spread.withColumn("own", F.pmod(F.xxhash64("rep"), F.col("blocks")).cast("int"))
        spread = spread.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
        cells = spread.select("rep", "digest", "tree", F.xxhash64("key", F.least("own", "other"), F.greatest("own", "other")).alias("cell"), (F.col("own") >= F.col("other")).cast("int").alias("side"), (F.col("own") != F.col("other")).alias("cross"))
        known = F.slice("keys", at * trees + 1, min(2, levels - at) * trees).alias("keys")
        light = cells.join(classes.select("digest", "copies", "size", known), "digest").repartition("cell").sortWithinPartitions("cell", "rep")
        return light.select(*(f.split()[0] for f in fields.split(", ")))

    def grid(t):
        keys = common.list_column(t, "keys")[0].reshape(t.num_rows, -1, trees)
        return keys, int(t.column("tree")[0].as_py()), t.column("side").to_numpy(), bool(t.column("cell")[0].is_valid and t.column("cross").to_numpy(zero_copy_only=False).any())

    def wanted(batches: Iterator) -> Iterator:
        """The members of cells that have a pair to verify there."""
        import pyarrow as pa

        for t in common.runs(batches, "cell"):
            if t.num_rows > 1:
                new = _new_pairs(*grid(t)) & _alike(t.column("size").to_numpy().astype(np.int64), percent)
                if (some := new.any(0) | new.any(1)).any():
                    yield from t.filter(pa.array(some)).combine_chunks().to_batches()

    def sets_of(batches: Iterator) -> Iterator:
        import pyarrow as pa

        for batch in batches:
            for part, some in common.text_slices(batch):
                sets = shingles(some, n)
                offs = common.offsets(np.fromiter(map(len, sets), np.int64, len(sets))).astype(np.int32)
                digest = [hashlib.blake2b(x.tobytes(), digest_size=16).digest() for x in sets]
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), pa.array(digest, pa.binary()), pa.ListArray.from_arrays(pa.array(offs), pa.array(np.concatenate(sets).view(np.int64)))], ["rep", "digest", "set"])

    # shingle sets only of the classes that meet others; texts that share a document's id, but not its set, fall away by the digest
    wanted_ids = matched.select(F.col("rep").alias("doc_id")).distinct()
    if wanted_ids.count() <= how.broadcast:  # at most so many ids of eight bytes; more are joined by a shuffle of the texts
        wanted_ids = F.broadcast(wanted_ids)
    heavy = common.mapped(pieces.join(wanted_ids, "doc_id", "left_semi"), sets_of, "rep long, digest binary, set array<long>", "shingle_join")
    heavy = common.staged(heavy.dropDuplicates(["rep", "digest"]), "sets")

    def verify(batches: Iterator) -> Iterator:
        import pyarrow as pa

        for t in common.runs(batches, "cell"):
            if t.num_rows < 2:
                continue
            new = _new_pairs(*grid(t))
            flat, offs = common.list_column(t, "set")
            size, g = np.diff(offs).astype(np.int64), t.num_rows
            both = common_counts(flat, np.repeat(np.arange(g), size), g)
            union = size[:, None] + size - both
            linked = new & (100 * both >= percent * union)
            linked |= linked.T
            if linked.any():
                rep, copies = t.column("rep").to_numpy(), t.column("copies").to_numpy()
                some = linked.any(1)
                unseen = [np.where(linked, how.unseen(np.where(linked, both / union, 1.0), low + i), 0.0).dot(copies)[some] for i in range(levels)]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(rep[some]), t.column("digest").combine_chunks().filter(pa.array(some)), pa.array(rep[_stars(linked)][some]), pa.array((linked @ copies)[some]), pa.array(list(np.stack(unseen, 1)), pa.list_(pa.float64()))],
                    ["rep", "digest", "least", "links", "unseen"],
                )

    links = None
    for level in range(how.longest, low - 1, -1):
        needed = common.staged(common.mapped(cells_of(level), wanted, fields, "shingle_join"), "cells")
        filled = needed.join(heavy, ["rep", "digest"]).repartition("cell").sortWithinPartitions("cell", "rep")
        found = common.staged(common.mapped(filled.select(*(f.split()[0] for f in fields.split(", ")), "set"), verify, "rep long, digest binary, least long, links long, unseen array<double>", "shingle_join"), "links")
        links = found if links is None else links.unionByName(found)
        each = links.groupBy("digest").agg((F.sum(F.col("unseen")[level - low]) / F.sum("links")).alias("unseen"))
        row = each.agg(F.count("*").alias("n"), F.coalesce(F.sum("unseen"), F.lit(0.0)).alias("unseen")).first()
        if row["unseen"] + how.unseen(percent / 100, level) <= (1 - how.recall) * row["n"]:
            break
    total = links.groupBy("digest").agg(F.sum("links").alias("links"))
    found = common.components(links.select(F.col("rep").alias("a"), F.col("least").alias("b")), "components")
    per_class = classes.select("digest", "rep", "copies").join(total, "digest", "left").join(found.withColumnRenamed("node", "rep"), "rep", "left")
    per_class = per_class.select("digest", F.coalesce("least", "rep").alias("class_id"), (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"))
    done = signed_docs.select("doc_id", "digest").join(per_class, "digest").select("doc_id", "class_id", "n_links")
    rest = common.texts(docs).where("doc_id is null or not regexp_like(text, r'[^\\x20\\x09-\\x0D]')").select("doc_id", F.col("doc_id").alias("class_id"), F.lit(0).cast("long").alias("n_links"))
    return done.unionByName(rest)


def op4_shingle_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return join(common.table(spark, sf_dir, "documents"))
