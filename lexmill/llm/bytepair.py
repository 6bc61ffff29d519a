"""Byte-level BPE with a public vocabulary: pre-split pieces, merge ranks, two exact encoders.

PrefixEncoder keeps for every byte prefix of a piece the one last token that the encoding of that prefix ends with, so a
piece can be appended to without starting again. MergeTable applies lowest-ranked merges to many pieces at once."""

from __future__ import annotations

import functools
import json
import os

import numpy as np
import regex

#: Fixed value: the public pattern that splits text before merges.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
VOCABULARY = "byte_bpe_50k.json"
#: Pieces kept in one worker's memory; beyond it the store starts anew. It bounds memory, not results.
STORE = 1_000_000


def folder() -> str:
    """The folder of the vocabulary files; LEXMILL_TOKENIZERS names another."""
    return os.environ.get("LEXMILL_TOKENIZERS", "/opt/tokenizers")


def vocabulary_path(name: str = VOCABULARY) -> str:
    return name if os.path.isabs(name) else os.path.join(folder(), name)


def byte_letters() -> list[str]:
    """The printable character by which byte-level vocabularies write each byte: itself if visible, else the next free one from U+0100."""
    visible = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    spare = iter(range(0x100, 0x200))
    return [chr(b) if b in visible else chr(next(spare)) for b in range(256)]


class Vocabulary:
    """Tokens as bytes and the merges between their ids. A token's id grows with its merge rank."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            model = json.load(f)["model"]
        of_letter = {c: b for b, c in enumerate(byte_letters())}
        special = {"<|endoftext|>"}
        self.ids: dict[bytes, int] = {bytes(of_letter[c] for c in t): i for t, i in model["vocab"].items() if t not in special}
        size = max(self.ids.values()) + 1
        self.tokens: list[bytes] = [b""] * size
        for t, i in self.ids.items():
            self.tokens[i] = t
        self.byte_ids = np.array([self.ids[bytes([b])] for b in range(256)], np.int64)
        self.left, self.right = [-1] * size, [-1] * size
        self.pair: dict[int, int] = {}
        for merge in model["merges"]:
            a, b = (self.ids[bytes(of_letter[c] for c in x)] for x in (merge.split(" ") if isinstance(merge, str) else merge))
            new = self.ids[self.tokens[a] + self.tokens[b]]
            if (a << 17 | b) not in self.pair:
                self.pair[a << 17 | b] = new
                if self.left[new] < 0:
                    self.left[new], self.right[new] = a, b
        #: Tokens by their bytes read backwards: nested tables, the id under -1.
        self.backwards: dict = {}
        for t, i in self.ids.items():
            at = self.backwards
            for b in reversed(t):
                at = at.setdefault(b, {})
            at[-1] = i


@functools.lru_cache(maxsize=4)
def vocabulary(path: str) -> Vocabulary:
    return Vocabulary(path)


class PrefixEncoder:
    """The exact BPE of a piece by dynamic programming over its byte prefixes.

    `last[i]` is the last token of the encoding of the first i bytes. It is the only token t ending at i for which the token
    before it, last[i - len(t)], and t stay apart when their bytes are encoded together; so it never depends on later bytes."""

    def __init__(self, voc: Vocabulary):
        self.voc = voc
        self.apart: dict[int, bool] = {}

    def stay_apart(self, a: int, b: int) -> bool:
        """Whether the bytes of a and b, encoded together, come out as a, b again.

        Undoes the merges of both in the reverse of their order and looks whether, in the time two neighbours stood at the
        border, a merge across it was due first. Of equal ranks the left one is done first."""
        key = a << 17 | b
        known = self.apart.get(key)
        if known is not None:
            return known
        pair, left, right = self.voc.pair, self.voc.left, self.voc.right
        until, ok = 1 << 30, True
        while True:
            new = pair.get(a << 17 | b)
            if new is not None and new < until:
                ok = False
                break
            if a > b:
                until, a = a, right[a]
                if a < 0:
                    break
            else:
                until, b = b + 1, left[b]
                if b < 0:
                    break
        self.apart[key] = ok
        return ok

    def extend(self, piece: bytes, last: list[int] | None = None) -> list[int]:
        """last for the whole piece, given last of some prefix of it (one entry more than its bytes; the first is unused)."""
        last = [-1] if last is None else last
        tokens, backwards = self.voc.tokens, self.voc.backwards
        for i in range(len(last), len(piece) + 1):
            at, j, found = backwards, i, -1
            while j:
                at = at.get(piece[j - 1])
                if at is None:
                    break
                j -= 1
                t = at.get(-1)
                if t is not None and (j == 0 or self.stay_apart(last[j], t)):
                    found = t
                    if j == 0:
                        break
            last.append(found)
        return last

    def tokens_of(self, last: list[int]) -> list[int]:
        """The ids behind last, read from its end."""
        out, i = [], len(last) - 1
        while i > 0:
            out.append(last[i])
            i -= len(self.voc.tokens[last[i]])
        return out[::-1]

    def encode(self, piece: bytes) -> list[int]:
        whole = self.voc.ids.get(piece)
        return [whole] if whole is not None else self.tokens_of(self.extend(piece))


class Store(dict):
    """Ids of pieces as packed int32, worked out once for each distinct piece."""

    def __init__(self, path: str):
        super().__init__()
        self.encoder = PrefixEncoder(vocabulary(path))

    def __missing__(self, piece: str) -> bytes:
        if len(self) >= STORE:
            self.clear()
            self.encoder.apart.clear()
        got = self[piece] = np.array(self.encoder.encode(piece.encode()), np.int32).tobytes()
        return got


@functools.lru_cache(maxsize=4)
def store(path: str) -> Store:
    return Store(path)


@functools.lru_cache(maxsize=2)
def splitter(pattern: str = PATTERN):
    return regex.compile(pattern).findall


class Edited:
    """A text with its pieces and ids that follows edits by encoding again only what an edit can reach."""

    def __init__(self, text: str, path: str | None = None):
        self.store, self.split = store(path or vocabulary_path()), splitter()
        self.text = text
        self.pieces = self.split(text)

    @property
    def ids(self) -> list[int]:
        return np.frombuffer(b"".join([self.store[p] for p in self.pieces]), np.int32).tolist()

    def replace(self, start: int, end: int, new: str) -> int:
        """Puts new in place of text[start:end]; returns how many pieces were split again.

        Split points before the edit hold up to the piece that ends two pieces ahead of it, as a piece looks one character on.
        Behind it, the old split is taken up where an old and a new boundary meet."""
        at, k = 0, 0
        while k < len(self.pieces) and at + len(self.pieces[k]) < start - 1:
            at += len(self.pieces[k])
            k += 1
        k, at = (k - 1, at - len(self.pieces[k - 1])) if k else (k, at)
        shift = len(new) - (end - start)
        old_ends, pos = {}, 0
        for n, p in enumerate(self.pieces):
            pos += len(p)
            if pos >= end:
                old_ends.setdefault(pos + shift, n + 1)
        self.text = self.text[:start] + new + self.text[end:]
        fresh, pos, tail = [], at, len(self.pieces)
        for m in regex.compile(PATTERN).finditer(self.text, at):
            fresh.append(m.group())
            pos = m.end()
            if pos > start + len(new) and pos in old_ends:
                tail = old_ends[pos]
                break
        self.pieces[k:] = fresh + (self.pieces[tail:] if pos in old_ends else [])
        return len(fresh)


class MergeTable:
    """Merge ranks as sorted arrays, joined with adjacent symbols of many pieces at a time."""

    def __init__(self, voc: Vocabulary):
        keys = np.fromiter(voc.pair.keys(), np.int64, len(voc.pair))
        order = np.argsort(keys)
        self.keys, self.new = keys[order], np.fromiter(voc.pair.values(), np.int64, len(voc.pair))[order]
        self.byte_ids = voc.byte_ids

    def counts(self, pieces: list[bytes]) -> np.ndarray:
        """Tokens of each piece. Every round joins adjacent symbols with the ranks and merges each piece's lowest pair, until none is left."""
        sizes = np.fromiter(map(len, pieces), np.int64, len(pieces))
        result = np.zeros(len(pieces), np.int64)
        symbols = self.byte_ids[np.frombuffer(b"".join(pieces), np.uint8)]
        owner = np.repeat(np.arange(len(pieces)), sizes)
        while len(symbols) > 1:
            key = symbols[:-1] << 17 | symbols[1:]
            at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
            rank = np.where((self.keys[at] == key) & (owner[:-1] == owner[1:]), self.new[at], 1 << 40)
            starts = np.flatnonzero(np.r_[True, owner[1:] != owner[:-1]])
            lowest = np.minimum.reduceat(np.r_[rank, 1 << 40], starts)
            size = np.diff(np.r_[starts, len(symbols)])
            done = lowest == 1 << 40
            result[owner[starts[done]]] = size[done]
            least = np.repeat(lowest, size)
            hit = (rank == least[:-1]) & (rank < 1 << 40)
            # of overlapping equal pairs (aaa) the first, third, ... of a run is merged
            where = np.flatnonzero(hit)
            if len(where):
                new_run = np.r_[True, (np.diff(where) != 1)]
                first = np.maximum.accumulate(np.where(new_run, where, 0))
                where = where[(where - first) % 2 == 0]
            symbols = symbols.copy()
            symbols[where] = rank[where]
            keep = ~np.repeat(done, size)
            keep[where + 1] = False
            symbols, owner = symbols[keep], owner[keep]
        if len(symbols):
            result[owner[0]] = 1
        return result


class Counts(dict):
    """Token counts of distinct pieces by MergeTable."""

    def __init__(self, path: str):
        super().__init__()
        self.table = MergeTable(vocabulary(path))

    def learn(self, pieces: set[str]) -> None:
        if len(self) >= STORE:
            self.clear()
        new = [p for p in pieces if p not in self]
        if new:
            self.update(zip(new, self.table.counts([p.encode() for p in new]).tolist(), strict=True))


@functools.lru_cache(maxsize=4)
def counts(path: str) -> Counts:
    return Counts(path)
