"""A SentencePiece vocabulary read as a unigram lattice, with numpy probes for substrings.

The pieces and scores of the model file are used as a unigram model: a text is
split into the pieces of highest total score. Between equal scores the longer
last piece wins. A character that no piece covers is written as its bytes.
"""

from __future__ import annotations

import re
from itertools import pairwise

import numpy as np

from fernlink.llm.common import memory, ranges

SPACE = "▁"
_BASE = np.uint64(0x9E3779B97F4A7C15 | 1)
_INVERSE = np.uint64(pow(int(_BASE), -1, 1 << 64))


def _powers(base: np.uint64, n: int) -> np.ndarray:
    out = np.full(n, base, np.uint64)
    if n:
        out[0] = 1
    return np.multiply.accumulate(out)


def code_points(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """All code points in a row, and the start of each word with the end of the last."""
    flat = np.frombuffer("".join(words).encode("utf-32-le", "surrogatepass"), np.uint32)
    return flat, np.concatenate([[0], np.cumsum(np.fromiter(map(len, words), np.int64, len(words)))])


class Pieces:
    def __init__(self, path: str):
        import sentencepiece

        sp = sentencepiece.SentencePieceProcessor(model_file=path)
        n = sp.vocab_size()
        text = [sp.id_to_piece(i) for i in range(n)]
        normal = [i for i in range(n) if not (sp.is_byte(i) or sp.is_control(i) or sp.is_unknown(i) or sp.is_unused(i))]
        if any(re.search(f"[^{SPACE}]{SPACE}|\n", text[i]) for i in normal):
            raise ValueError(f"{path}: a piece crosses a word boundary, so words cannot be split on their own")
        self.score = np.array([sp.get_score(i) for i in range(n)] + [0.0])
        self.unknown = float(self.score[normal].min()) - 10.0
        self.byte_id = np.zeros(256, np.int64)
        for i in range(n):
            if sp.is_byte(i):
                self.byte_id[int(text[i][1:-1], 16)] = i
        kept = set(normal)
        self.is_byte = np.array([sp.is_byte(i) for i in range(n)])
        as_bytes = [bytes([int(t[1:-1], 16)]) if sp.is_byte(i) else b"" if i not in kept else t.replace(SPACE, " ").encode() for i, t in enumerate(text)]
        self.bytes = np.frombuffer(b"".join(as_bytes), np.uint8)
        self.byte_len = np.fromiter(map(len, as_bytes), np.int64, n)
        self.byte_start = np.cumsum(self.byte_len) - self.byte_len
        by_length: dict[int, list[int]] = {}
        for i in normal:
            by_length.setdefault(len(text[i]), []).append(i)
        self.longest = max(by_length)
        self.keys, self.ids, self.chars = {}, {}, {}
        self.may = np.zeros(1 << 21, bool)
        for k, ids in by_length.items():
            flat, _ = code_points([text[i] for i in ids])
            chars = flat.reshape(-1, k)
            h = (chars.astype(np.uint64) * _powers(_INVERSE, k)).sum(1, dtype=np.uint64)
            order = np.argsort(h)
            if len(np.unique(h)) < len(h):
                raise ValueError(f"{path}: two pieces of {k} characters share a hash")
            self.keys[k], self.ids[k], self.chars[k] = h[order], np.array(ids)[order], chars[order]
            self.may[self._slot(h, k)] = True
        self.size = {int(i): k for k, v in self.ids.items() for i in v}
        self.split = re.compile(f"{SPACE}+[^{SPACE}\n]*|\n|[^{SPACE}\n]+")

    @staticmethod
    def _slot(h: np.ndarray, k: int) -> np.ndarray:
        return ((h * np.uint64(0xD6E8FEB86659FD93 + 2 * k)) >> np.uint64(43)).astype(np.int64)

    def words(self, text: str) -> list[str]:
        """Pre-tokens of a text; no piece lies across their borders. An empty text has none."""
        return self.split.findall(SPACE + text.replace(" ", SPACE)) if text else []

    def probe(self, flat: np.ndarray) -> list[np.ndarray]:
        """For each piece length k (from 1), the id of the piece that starts at each position, or -1.

        Substring hashes look up the sorted keys of their length; equal hashes are
        compared character by character. A piece may run past the end of its word,
        so callers look at lengths within the word only.
        """
        n = len(flat)
        sums = np.zeros(n + 1, np.uint64)
        np.cumsum(flat * _powers(_INVERSE, n), out=sums[1:])
        scale = _powers(_BASE, n)
        out = []
        for k in range(1, self.longest + 1):
            found = np.full(n, -1, np.int32)
            out.append(found)
            if k not in self.keys or k > n:
                continue
            h = (sums[k:] - sums[:-k]) * scale[: n - k + 1]
            at = np.flatnonzero(self.may[self._slot(h, k)])
            row = np.minimum(np.searchsorted(self.keys[k], h[at]), len(self.keys[k]) - 1)
            same = self.keys[k][row] == h[at]
            at, row = at[same], row[same]
            same = (flat[at[:, None] + np.arange(k)] == self.chars[k][row]).all(1)
            found[at[same]] = self.ids[k][row[same]]
        return out

    def decode(self, ids: np.ndarray) -> str:
        """The text of ids; the space put before the text goes."""
        raw = self.bytes[ranges(self.byte_start[ids], self.byte_len[ids])].tobytes()
        return raw.decode("utf-8", "replace").removeprefix(" ")


def load(path: str) -> Pieces:
    held = memory("pieces")
    if path not in held:
        held[path] = Pieces(path)
    return held[path]


def viterbi(p: Pieces, words: list[str], chunk: int = 500_000) -> list[np.ndarray]:
    """Ids of the best segmentation of each word; words of equal length advance together."""
    out: list = [None] * len(words)
    sizes = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)))
    cuts = [0, *(np.flatnonzero(np.diff(sizes // chunk)) + 1).tolist(), len(words)]
    for lo, hi in pairwise(cuts):
        flat, offs = code_points(words[lo:hi])
        hits = p.probe(flat)
        length = np.diff(offs)
        for n in np.unique(length).tolist():
            rows = np.flatnonzero(length == n)
            start = offs[rows]
            best = np.full((n + 1, len(rows)), -np.inf)
            best[0] = 0
            back = np.zeros((n + 1, len(rows)), np.int16)
            piece = np.full((n + 1, len(rows)), -1, np.int32)
            for e in range(1, n + 1):
                top, used, which = best[e], back[e], piece[e]
                for k in range(min(e, p.longest), 0, -1):
                    ids = hits[k - 1][start + (e - k)]
                    if k > 1 and not (ids >= 0).any():
                        continue
                    s = best[e - k] + np.where(ids >= 0, p.score[ids], p.unknown if k == 1 else -np.inf)
                    better = s > top
                    np.copyto(top, s, where=better)
                    np.copyto(used, np.int16(k), where=better)
                    np.copyto(which, ids, where=better)
            pos, steps = np.full(len(rows), n), []
            cols = np.arange(len(rows))
            while (pos > 0).any():
                live = pos > 0
                steps.append(np.where(live, piece[pos, cols], -2))
                pos = np.where(live, pos - back[pos, cols], 0)
            for r, ids in zip(rows.tolist(), np.column_stack(steps)[:, ::-1] if steps else [[]] * len(rows), strict=True):
                ids = ids[ids != -2] if len(ids) else np.empty(0, np.int32)
                if (ids < 0).any():
                    ids = _with_bytes(p, words[lo + r], ids)
                out[lo + r] = ids
    return out


def _with_bytes(p: Pieces, word: str, ids: np.ndarray) -> np.ndarray:
    """Put the bytes of uncovered characters in their places."""
    size, done, at = p.size, [], 0
    for i in ids.tolist():
        if i < 0:
            done += p.byte_id[list(word[at].encode("utf-8", "replace"))].tolist()
            at += 1
        else:
            done.append(i)
            at += size[i]
    return np.array(done, np.int32)


def trie_counts(p: Pieces, words: list[str]) -> np.ndarray:
    """Number of tokens of each distinct word.

    Sorted words form a trie: a word makes nodes only below the prefix that it shares
    with the word before it. Level by level, a node's best score and its number of
    tokens come from its ancestors, once for all words below it; a word's count is
    read at its terminal node.
    """
    order = sorted(range(len(words)), key=words.__getitem__)
    flat, offs = code_points([words[i] for i in order])
    hits, length, start = p.probe(flat), np.diff(offs), offs[:-1]
    utf8 = 1 + (flat >= 0x80).astype(np.int64) + (flat >= 0x800) + (flat >= 0x10000)
    counts = np.zeros(len(words), np.int64)
    rows = np.flatnonzero(length > 0)
    same = np.zeros(len(words), bool)
    same[1:] = True
    levels = [(np.zeros(1), np.zeros(1, np.int64), np.zeros(len(words), np.int64))]  # score, tokens, node of each word; of the last depths
    depth = 0
    while len(rows):
        depth += 1
        before = np.maximum(rows - 1, 0)
        here = start[rows] + depth - 1
        there = start[before] + depth - 1
        same[rows] &= (length[before] >= depth) & (flat[np.minimum(there, len(flat) - 1)] == flat[here])
        own = rows[~same[rows]]  # the words that make this level's nodes
        node = np.empty(len(words), np.int64)
        node[rows] = np.cumsum(~same[rows]) - 1
        best, tokens = np.full(len(own), -np.inf), np.zeros(len(own), np.int64)
        for k in range(min(depth, p.longest), 0, -1):
            score, many, nodes = levels[-k]
            ids = hits[k - 1][start[own] + depth - k]
            if k > 1 and not (ids >= 0).any():
                continue
            up = nodes[own]
            s = score[up] + np.where(ids >= 0, p.score[ids], p.unknown if k == 1 else -np.inf)
            better = s > best
            best[better] = s[better]
            more = np.where(ids >= 0, 1, utf8[start[own] + depth - 1])
            tokens[better] = (many[up] + more)[better]
        levels = [*levels[1 - p.longest :], (best, tokens, node)]
        ended = rows[length[rows] == depth]
        counts[ended] = tokens[node[ended]]
        rows = rows[length[rows] > depth]
    out = np.zeros(len(words), np.int64)
    out[order] = counts
    return out
