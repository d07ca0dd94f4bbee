"""Removal of repeated byte strings by merged Burrows-Wheeler transforms.

Every string of ``length`` bytes (a window) has an anchor: the first position
whose hash of ``seed`` bytes is least among those in the window. Equal windows
have equal anchors, so only the surroundings of repeated anchors (the windows
that have them) need sorting. Equal surroundings of an anchor are one string, known by two hashes of 64 bits: all
but the first occurrence are removed whole. The different surroundings of one
anchor meet in a bucket; there, shards' transforms are merged by interleave
refinement, the groups of rotations with a common prefix of ``length`` bytes are
the repeated windows, and each group's first stays.

An anchor with very many different surroundings (a passage that a large share of
documents quotes) does not go to one bucket: its surroundings are cut to fewer
windows, keyed by the bytes that these share, down to single windows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from fernlink.llm import bwt, common
from fernlink.llm.shingle_join import mixed

_A = np.uint64(0x9E3779B97F4A7C15)
_B = np.uint64(0xC2B2AE3D27D4EB4F)
_NO_ID = -(1 << 63)
#: A part of a document: ``windows`` windows from byte ``start``; ``rel`` is the first's place among those of its anchor.
PLACE = "did long, copy int, start int, windows int, rel int"


class _Hash:
    """Polynomial hashes of all substrings of some bytes."""

    def __init__(self, raw: np.ndarray, base: np.uint64):
        n = len(raw)
        inverse = pow(int(base), -1, 1 << 64)
        up, down = self._powers(int(base), n + 1), self._powers(inverse, n + 1)
        self.sums = np.zeros(n + 1, np.uint64)
        np.cumsum((raw.astype(np.uint64) + np.uint64(1)) * down[:n], out=self.sums[1:])
        self.up = up

    @classmethod
    def _powers(cls, base: int, n: int) -> np.ndarray:
        held = common.memory("suffix_dedup")
        if len(held.get(base, ())) < n:
            p = np.full(max(n, 1 << 16), base, np.uint64)
            p[0] = 1
            held[base] = np.multiply.accumulate(p)
        return held[base]

    def of(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        return mixed((self.sums[end] - self.sums[start]) * self.up[start] + (end - start).astype(np.uint64))

    def rolling(self, k: int) -> np.ndarray:
        n = len(self.sums) - k
        return mixed((self.sums[k:] - self.sums[:-k]) * self.up[:n])


def _sliding(h: np.ndarray, w: int, op) -> np.ndarray:
    """op over every w neighbours, by doubling."""
    out, have = h, 1
    while have < w:
        step = min(have, w - have)
        out = op(out[: len(out) - step], out[step:])
        have += step
    return out


def anchors(raw: np.ndarray, length: int, seed: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The anchors of a text of at least ``length`` bytes: position, and the first and last of the windows that have it.

    A window's anchor is the first of its positions with the least hash, so each
    window has one, at the same place wherever the window occurs.
    """
    bits = np.uint64(31)  # of the position; Spark's strings are shorter
    h = _Hash(raw, _A).rolling(seed)
    owner = _sliding((h >> bits << bits) | np.arange(len(h), dtype=np.uint64), length - seed + 1, np.minimum)
    owner = (owner & ((np.uint64(1) << bits) - np.uint64(1))).astype(np.int64)
    lo = np.flatnonzero(np.r_[True, owner[1:] != owner[:-1]])
    return owner[lo], lo, np.r_[lo[1:], len(owner)] - 1


def _first_of(keys: list[np.ndarray], places: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Rows in order of keys and places, and which of them is the first of its keys."""
    order = np.lexsort([*reversed(places), *reversed(keys)])
    same = np.ones(max(len(order) - 1, 0), bool)
    for k in keys:
        k = k[order]
        same &= k[1:] == k[:-1]
    return order, np.r_[True, ~same][: len(order)]


def _numbered(docs: DataFrame, *keep: str) -> DataFrame:
    """did (a null id: before all), copy and text; ``copy`` tells the rows of one id apart, in the order of their text."""
    rows = common.texts(docs, *keep).select("doc_id", F.coalesce("doc_id", F.lit(_NO_ID)).alias("did"), "text", *keep)
    twice = rows.groupBy("did").agg(F.count("*").alias("c")).where("c > 1").limit(1).count()
    if not twice:
        return rows.withColumn("copy", F.lit(0))
    return rows.withColumn("copy", F.row_number().over(Window.partitionBy("did").orderBy(F.xxhash64("text"), "text")) - 1)


def repeats(docs: DataFrame, length: int = 100, seed: int = 32, most: int = 8192) -> DataFrame:
    """did, copy, lo and hi of byte ranges to remove; they may overlap. ``docs`` is numbered; ``most`` bounds a bucket's strings of one anchor."""
    span = length - seed  # an anchor's windows start up to so many bytes before it

    def rows_of(batch):
        """(did, copy, bytes) of the texts with a window, a bounded amount at a time."""
        for part, some in common.text_slices(batch, 8_000_000):
            yield zip(part.column("did").to_pylist(), part.column("copy").to_pylist(), (np.frombuffer(t.encode(), np.uint8) for t in some), range(part.num_rows), strict=True), part

    def emit(kind, key, ctx, place):
        import pyarrow as pa

        return pa.RecordBatch.from_arrays([pa.array(np.asarray(kind, np.int32)), pa.array(key.view(np.int64)), pa.array(ctx.view(np.int64)), *(pa.array(p.astype(np.int64 if i == 0 else np.int32)) for i, p in enumerate(place))], ["kind", "key", "ctx", "did", "copy", "start", "windows", "rel"])

    found = "kind int, key long, ctx long, " + PLACE

    def reduced(parts: list[tuple]):
        """Of equal surroundings in a slice, the first goes on (kind 1) and the others are removed (kind 0)."""
        key, ctx, *place = (np.concatenate(x) for x in zip(*parts, strict=True))
        order, first = _first_of([key, ctx], place[:3])
        kind = np.empty(len(key), np.int32)
        kind[order] = first
        return emit(kind, key, ctx, place)

    def surroundings(batches: Iterator) -> Iterator:
        for batch in batches:
            for rows, _ in rows_of(batch):
                parts = []
                for did, copy, raw, _i in rows:
                    n = len(raw)
                    if n < length:
                        continue
                    at, lo, hi = anchors(raw, length, seed)
                    h = _Hash(raw, _A).of(at, at + seed)
                    ctx = _Hash(raw, _B).of(lo, hi + length)
                    rel = lo - (at - span)
                    parts.append((h, mixed(ctx + rel.astype(np.uint64)), np.full(len(at), did, np.int64), np.full(len(at), copy), lo, hi - lo + 1, rel))
                if parts:
                    yield reduced(parts)

    def judged(batches: Iterator) -> Iterator:
        """From rows in order of (lot, ctx, place): later equal surroundings (kind 0), and the firsts of keys with several (1), or very many (2)."""
        import pyarrow as pa

        for t in common.whole_runs(batches, "lot"):
            lot, ctx, kind = (t.column(c).to_numpy() for c in ("lot", "ctx", "kind"))
            asked = kind == 1
            head = np.r_[True, lot[1:] != lot[:-1]]
            first = asked & np.r_[True, head[1:] | (ctx[1:] != ctx[:-1]) | ~asked[:-1]]
            run = np.cumsum(head) - 1
            several = np.bincount(run, first)[run]
            kind = np.where(~asked | ~first, 0, np.where(several > most, 2, 1))
            keep = (kind == 0) | (several > 1)
            if keep.any():
                t = t.drop(["kind", "lot"]).add_column(0, "kind", pa.array(kind.astype(np.int32)))
                yield from t.filter(pa.array(keep)).combine_chunks().to_batches()

    def judge(rows: DataFrame, label: str) -> DataFrame:
        """The verdicts on (kind, key, ctx, place) rows; those that are decided only pass, spread by their place."""
        lot = F.when(F.col("kind") == 1, F.col("key")).otherwise(F.xxhash64("did", "copy", "start"))
        rows = rows.withColumn("lot", lot).repartition("lot").sortWithinPartitions("lot", F.desc("kind"), "ctx", "did", "copy", "start")
        return common.staged(common.mapped(rows, judged, found, "suffix_dedup"), label)

    first = docs.select("did", "copy", "text").where(F.octet_length("text") >= length)
    verdict = judge(common.mapped(first, surroundings, found, "suffix_dedup"), "repeats")
    removed = [verdict.where("kind = 0")]
    open_ = [verdict.where("kind = 1")]
    hot = verdict.where("kind = 2")
    for width in (24, 8, 1):
        if hot.limit(1).count() == 0:
            break

        def finer(rows: list[dict], raw: np.ndarray, did: int, copy: int, width: int = width):
            key = np.array([r["key"] for r in rows], np.int64).view(np.uint64)
            lo, n, rel = (np.array([r[c] for r in rows], np.int64) for c in ("start", "windows", "rel"))
            g0, g1 = rel // width, (rel + n - 1) // width
            row = np.repeat(np.arange(len(rows)), g1 - g0 + 1)
            g = common.ranges(g0, g1 - g0 + 1)
            a, b = np.maximum(g * width, rel[row]), np.minimum(g * width + width, rel[row] + n[row])  # windows a .. b - 1
            start = lo[row] + a - rel[row]
            zero = lo[row] - rel[row]  # where window 0 of the anchor would start
            core = _Hash(raw, _A).of(zero + np.minimum((g + 1) * width, span + 1) - 1, zero + g * width + length)
            ctx = _Hash(raw, _B).of(start, start + (b - a) + length - 1)
            return mixed(mixed(key[row] + g.astype(np.uint64)) ^ core), mixed(ctx + a.astype(np.uint64)), np.full(len(row), did, np.int64), np.full(len(row), copy), start, b - a, a

        def cut(batches: Iterator, finer=finer) -> Iterator:
            for batch in batches:
                for rows, part in rows_of(batch):
                    wanted = part.column("parts").to_pylist()
                    yield reduced([finer(wanted[i], raw, did, copy) for did, copy, raw, i in rows])

        verdict = judge(common.mapped(_with_text(docs, hot, ["key", "start", "windows", "rel"]), cut, found, "suffix_dedup"), f"repeats-{width}")
        removed.append(verdict.where("kind = 0"))
        open_.append(verdict.where("kind = 1"))
        hot = verdict.where("kind = 2")

    if len(open_) > 3 and hot.limit(1).count():
        raise RuntimeError("single windows of equal hashes differ")  # they are one string unless two hashes of 64 bits collide

    def strings(batches: Iterator) -> Iterator:
        import pyarrow as pa

        for batch in batches:
            for rows, part in rows_of(batch):
                wanted = part.column("parts").to_pylist()
                out = [(r["key"], did, copy, r["start"], raw[r["start"] : r["start"] + r["windows"] + length - 1].tobytes()) for did, copy, raw, i in rows for r in wanted[i]]
                key, did, copy, start, piece = zip(*out, strict=True)
                yield pa.RecordBatch.from_arrays([pa.array(key, pa.int64()), pa.array(did, pa.int64()), pa.array(copy, pa.int32()), pa.array(start, pa.int32()), pa.array(piece, pa.binary())], ["key", "did", "copy", "start", "piece"])

    def merged(batches: Iterator) -> Iterator:
        """Transforms of the buckets' strings, a batch of whole buckets at a time."""
        import pyarrow as pa

        for t in common.whole_runs(batches, "key"):
            did, copy, start = (t.column(c).to_numpy().astype(np.int64) for c in ("did", "copy", "start"))
            s, o, g = bwt.repeated(t.column("piece").to_pylist(), length)
            place = (did[s], copy[s], start[s] + o)
            order = np.lexsort((*reversed(place), g))
            s, g = s[order], g[order]
            place = [p[order] for p in place]
            head = np.flatnonzero(np.r_[True, g[1:] != g[:-1]]) if len(g) else np.empty(0, np.int64)
            of = np.repeat(head, np.diff(np.r_[head, len(g)]))
            later = np.zeros(len(g), bool)
            for p in place:
                later |= p != p[of]
            d, c, lo = (p[later] for p in place)
            order = np.lexsort((lo, c, d))
            d, c, lo = d[order], c[order], lo[order]
            new = np.r_[True, (d[1:] != d[:-1]) | (c[1:] != c[:-1]) | (lo[1:] > lo[:-1] + length)][: len(d)]
            end = np.flatnonzero(np.r_[new[1:], True][: len(d)])
            yield pa.RecordBatch.from_arrays([pa.array(d[new]), pa.array(c[new].astype(np.int32)), pa.array(lo[new].astype(np.int32)), pa.array((lo[end] + length).astype(np.int32))], ["did", "copy", "lo", "hi"])

    rest = open_[0]
    for x in open_[1:]:
        rest = rest.unionByName(x)
    pieces = common.mapped(_with_text(docs, rest, ["key", "start", "windows", "rel"]), strings, "key long, did long, copy int, start int, piece binary", "suffix_dedup")
    out = common.mapped(pieces.repartition("key").sortWithinPartitions("key"), merged, "did long, copy int, lo int, hi int", "suffix_dedup")
    for x in removed:
        out = out.unionByName(x.select("did", "copy", F.col("start").alias("lo"), (F.col("start") + F.col("windows") + (length - 1)).cast("int").alias("hi")))
    return out


def _with_text(docs: DataFrame, rows: DataFrame, columns: list[str]) -> DataFrame:
    """did, copy, text and the parts of each document that has any; a document's parts are bounded by its size."""
    parts = rows.groupBy("did", "copy").agg(F.collect_list(F.struct(*columns)).alias("parts"))
    return docs.select("did", "copy", "text").join(parts, ["did", "copy"])


def removals(docs: DataFrame, length: int = 100, seed: int = 32, most: int = 8192, keep: tuple[str, ...] = (), as_text: bool = False) -> DataFrame:
    """Every row with what is left of its text: doc_id, n_bytes, n_removed, n_spans, kept (binary) and the
    columns in ``keep``; ``as_text`` gives text, without broken characters, in place of ``kept``.

    Removed is each byte covered by a string of ``length`` bytes that also starts
    earlier: in a smaller doc_id, or in the same text at an earlier start. Texts
    count as UTF-8 bytes; a null or empty text has none, and matches never cross
    documents. Rows that share an id are in the order of their text, a null id
    before all. Other columns are ignored; an empty table gives no rows.
    """
    rows = _numbered(docs, *keep)
    ranges = repeats(rows, length, seed, most).groupBy("did", "copy").agg(F.collect_list(F.struct("lo", "hi")).alias("ranges"))
    joined = rows.join(ranges, ["did", "copy"], "left").select("doc_id", "text", "ranges", *keep)

    last = "text string" if as_text else "kept binary"

    def clean(batches: Iterator) -> Iterator:
        import pyarrow as pa

        for batch in batches:
            for part, some in common.text_slices(batch):
                out = []
                for t, got in zip(some, part.column("ranges").to_pylist(), strict=True):
                    raw = t.encode()
                    if not got:
                        out.append((len(raw), 0, 0, raw))
                        continue
                    edge = np.zeros(len(raw) + 1, np.int64)
                    np.add.at(edge, [r["lo"] for r in got], 1)
                    np.subtract.at(edge, [r["hi"] for r in got], 1)
                    gone = np.cumsum(edge[:-1]) > 0
                    out.append((len(raw), int(gone.sum()), int((np.diff(gone.astype(np.int8), prepend=0) == 1).sum()), np.frombuffer(raw, np.uint8)[~gone].tobytes()))
                n, m, k, left = zip(*out, strict=True)
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), pa.array(n, pa.int64()), pa.array(m, pa.int64()), pa.array(k, pa.int64()), pa.array([x.decode("utf-8", "ignore") for x in left], pa.string()) if as_text else pa.array(left, pa.binary()), *(part.column(c) for c in keep)], ["doc_id", "n_bytes", "n_removed", "n_spans", last.split()[0], *keep])

    return common.mapped(joined, clean, f"doc_id long, n_bytes long, n_removed long, n_spans long, {last}" + "".join(f", `{c}` {docs.schema[c].dataType.simpleString()}" for c in keep), "suffix_dedup")


def op2_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    left = removals(common.table(spark, sf_dir, "documents"))
    return left.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))
