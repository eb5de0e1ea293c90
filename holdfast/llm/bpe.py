"""Byte-pair encoding by speculation and verification, and decoding.

Every distinct piece of text (a match of the split pattern) is first cut greedily into the longest vocabulary tokens.
A sequence of tokens is the true encoding exactly if every adjacent pair is: no merge across the boundary would have
been taken while the two sides grew. That is checked for all distinct pairs of a slice at once with array operations,
by taking back the merges at the boundary in reverse order of rank. Only pieces with a failing pair are merged exactly.

The work is one pass over the documents without a shuffle; a worker keeps the pieces it has met in a bounded table.
"""

from __future__ import annotations

import json
import re
import struct
from collections.abc import Iterable, Iterator
from functools import lru_cache
from heapq import heapify, heappop, heappush
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame

from holdfast.llm.common import id_and_text, slices

#: Fixed value: the split pattern of the byte-level vocabulary, white space spelled out.
PATTERN = (
    r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\p{White_Space}\p{L}\p{N}]+"
    r"|\p{White_Space}+(?=\p{White_Space}|$)|\p{White_Space}+"
)
#: The same split for texts of ASCII and Latin-1 letters only, without properties and so much faster.
_LETTERS = "A-Za-zªµºÀ-ÖØ-öø-ÿ"
_PLAIN = re.compile(
    rf"'s|'t|'re|'ve|'m|'ll|'d| ?[{_LETTERS}]+| ?[0-9]+| ?[^ \t-\r0-9{_LETTERS}]+|[ \t-\r]+(?![^ \t-\r])|[ \t-\r]+"
)
_OTHER = re.compile("[^\x00-\x1b\x20-\x7fªµºÀ-ÖØ-öø-ÿ]")
KEPT_PIECES = 400_000


def byte_letters() -> dict[str, int]:
    """The printable stand-in of every byte: itself where printable, else the next letter from U+0100 on."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(0x100 + i): b for i, b in enumerate(rest)}


class ByteBpe:
    """A byte-level vocabulary with its merges, read from a tokenizer file."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        letters = byte_letters()
        to_bytes = lambda s: bytes(letters[c] for c in s)
        vocab, added = spec["model"]["vocab"], spec["added_tokens"]
        self.ids = {to_bytes(s): i for s, i in vocab.items()}
        size = 1 + max([*vocab.values(), *(a["id"] for a in added)])
        self.bytes = [b""] * size
        for b, i in self.ids.items():
            self.bytes[i] = b
        self.special = {a["content"]: a["id"] for a in added}
        for s, i in self.special.items():
            self.bytes[i] = s.encode()
        self.size = size
        #: How long a token with these first four bytes may be.
        self.reach: dict[bytes, int] = {}
        for b in self.ids:
            if len(b) >= 4:
                self.reach[b[:4]] = max(len(b), self.reach.get(b[:4], 0))
        pairs = [m if isinstance(m, list) else m.split(" ") for m in spec["model"]["merges"]]
        self.left, self.right = np.full(size, -1, np.int64), np.full(size, -1, np.int64)
        self.rank = np.full(size, -1, np.int64)
        self.merges: dict[int, int] = {}  # rank by left * size + right
        self.made: list[int] = []
        for r, (a, b) in enumerate(pairs):
            x, y, z = vocab[a], vocab[b], vocab[a + b]
            self.merges[x * size + y] = r
            self.made.append(z)
            self.left[z], self.right[z], self.rank[z] = x, y, r
        keys, ranks = np.array(list(self.merges), np.int64), np.array(list(self.merges.values()), np.int64)
        order = np.argsort(keys)
        self._keys, self._ranks = keys[order], ranks[order]
        # A token proposed on its own must be what its bytes merge into: no other merge comes first inside it.
        made = np.flatnonzero(self.rank >= 0)
        self.whole = np.ones(size, bool)
        limit = self.rank[made]
        self.whole[made] = self._boundary_holds(self.left[made], self.right[made], limit, limit - 1)
        for t in made[np.argsort(limit)]:
            self.whole[t] &= self.whole[self.left[t]] and self.whole[self.right[t]]
        self._split = regex.compile(PATTERN)
        self._special = regex.compile("(" + "|".join(map(regex.escape, sorted(self.special, key=len, reverse=True))) + ")") if self.special else None
        self._known: dict[str, bytes] = {}  # ids as little-endian 32-bit numbers

    def _boundary_holds(self, x: np.ndarray, y: np.ndarray, before_x: np.ndarray, before_y: np.ndarray) -> np.ndarray:
        """Whether no merge across the boundary of x and y precedes the merges that take up x or y.

        x and y step back through the tokens that stood at the boundary. The one formed last is undone first; equal
        ranks form from left to right, so y is then the later one.
        """
        x, y, before_x, before_y = x.copy(), y.copy(), before_x.copy(), before_y.copy()
        holds = np.ones(len(x), bool)
        live = np.arange(len(x))
        while len(live):
            a, b = x[live], y[live]
            key = a * self.size + b
            at = np.minimum(np.searchsorted(self._keys, key), len(self._keys) - 1)
            r = np.where(self._keys[at] == key, self._ranks[at], np.iinfo(np.int64).max)
            bad = (r < before_x[live]) & (r <= before_y[live]) & (r < np.iinfo(np.int64).max)
            holds[live[bad]] = False
            undo_x = self.rank[a] > self.rank[b]
            go = ~bad & ((self.rank[a] >= 0) | (self.rank[b] >= 0))
            i = live[go & undo_x]
            before_x[i], x[i] = self.rank[x[i]], self.right[x[i]]
            i = live[go & ~undo_x]
            before_y[i], y[i] = self.rank[y[i]], self.left[y[i]]
            live = live[go]
        return holds

    def compatible(self, x: np.ndarray, y: np.ndarray) -> np.ndarray:
        """Whether tokens x and y, side by side, are the encoding of their joined bytes."""
        never = np.full(len(x), np.iinfo(np.int64).max)
        return self._boundary_holds(x, y, never, never) & self.whole[x] & self.whole[y]

    def propose(self, piece: bytes) -> list[int]:
        """Greedy longest match. Every single byte is a token."""
        out, i, n, get, reach = [], 0, len(piece), self.ids.get, self.reach.get
        while i < n:
            j = i + reach(piece[i : i + 4], 3)
            while (t := get(piece[i:j])) is None:
                j -= 1
            out.append(t)
            i = min(j, n)
        return out

    def merge(self, piece: bytes) -> list[int]:
        """Exact merging: the pair of lowest rank first, the leftmost of equals. Takes n log n steps for n bytes.

        Pairs wait in a heap by rank and place; one whose two tokens are no longer neighbours is skipped when it comes up.
        """
        size, rank_of, n = self.size, self.merges.get, len(piece)
        parts: list[int] = [self.ids[piece[i : i + 1]] for i in range(n)]
        after, before, gone = list(range(1, n + 1)), list(range(-1, n - 1)), -1
        waiting = [(rank, i) for i in range(n - 1) if (rank := rank_of(parts[i] * size + parts[i + 1])) is not None]
        heapify(waiting)
        while waiting:
            rank, i = heappop(waiting)
            j = after[i]
            if parts[i] == gone or j >= n or rank_of(parts[i] * size + parts[j]) != rank:
                continue
            parts[i], parts[j], after[i] = self.made[rank], gone, after[j]
            if after[i] < n:
                before[after[i]] = i
                if (right := rank_of(parts[i] * size + parts[after[i]])) is not None:
                    heappush(waiting, (right, i))
            if (left := before[i]) >= 0 and (rank := rank_of(parts[left] * size + parts[i])) is not None:
                heappush(waiting, (rank, left))
        return [t for t in parts if t != gone]

    def learn(self, pieces: Iterable[str]) -> None:
        """Encode pieces that are not in the table yet."""
        new = [p for p in pieces if p not in self._known]
        if not new:
            return
        raw = [p.encode() for p in new]
        guesses = [self.propose(b) for b in raw]
        flat = np.fromiter(chain.from_iterable(guesses), np.int64)
        owner = np.repeat(np.arange(len(new)), [len(g) for g in guesses])
        inside = np.flatnonzero(owner[1:] == owner[:-1])
        keys, inverse = np.unique(flat[inside] * self.size + flat[inside + 1], return_inverse=True)
        bad = ~self.compatible(keys // self.size, keys % self.size)[inverse]
        failing = set(owner[inside[bad]].tolist()) | set(owner[~self.whole[flat]].tolist())
        for i in failing:
            guesses[i] = self.merge(raw[i])
        self._known.update((p, struct.pack(f"<{len(g)}i", *g)) for p, g in zip(new, guesses, strict=True))

    def split(self, text: str) -> list[str]:
        return (self._split if _OTHER.search(text) else _PLAIN).findall(text)

    def encode_all(self, texts: list[str]) -> list[bytes]:
        """The ids of every text as little-endian 32-bit numbers."""
        cut = [self._special.split(t) if self._special and "<|" in t else [t] for t in texts]
        found = [[p if p in self.special else self.split(p) for p in parts] for parts in cut]
        if len(self._known) > KEPT_PIECES:
            self._known.clear()
        self.learn(set(chain.from_iterable(p for parts in found for p in parts if isinstance(p, list))))
        known = self._known.__getitem__
        special = {s: struct.pack("<i", i) for s, i in self.special.items()}
        return [b"".join(b"".join(map(known, p)) if isinstance(p, list) else special[p] for p in parts) for parts in found]

    def decode_one(self, ids: list[int]) -> str:
        return b"".join(map(self.bytes.__getitem__, ids)).decode("utf-8", "replace")


@lru_cache(maxsize=2)
def vocabulary(path: str) -> ByteBpe:
    return ByteBpe(path)


def encode(docs: DataFrame, path: str) -> DataFrame:
    """(doc_id, ids) of every whole text; a null text counts as empty. ``path`` names the tokenizer file on every node.

    Strings of special tokens inside a text become those tokens. Repeated rows stay, further columns are left out.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = vocabulary(path)
        for batch in slices(batches, most=2 << 20):
            ids = bpe.encode_all([t or "" for t in batch.column("text").to_pylist()])
            flat = np.frombuffer(b"".join(ids), "<i4")
            ends = np.cumsum([0, *map(len, ids)]).astype(np.int32) // 4
            lists = pa.ListArray.from_arrays(pa.array(ends), pa.array(flat))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), lists], ["doc_id", "ids"])

    return id_and_text(docs).mapInArrow(run, "doc_id long, ids array<int>")


def decode(encoded: DataFrame, path: str) -> DataFrame:
    """Add ``text``, the text of ``ids``; null ids give an empty text. Bytes that are not UTF-8 become U+FFFD."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = vocabulary(path)
        for batch in batches:
            for at in range(0, batch.num_rows, 512):  # a batch may hold many ids: go on in smaller parts
                part = batch.slice(at, 512)
                lists = part.column("ids")
                flat = lists.flatten().to_numpy()
                ends = np.cumsum([0, *pc.fill_null(pc.list_value_length(lists), 0).to_pylist()]).tolist()
                texts = [bpe.decode_one(flat[i:j].tolist()) for i, j in zip(ends, ends[1:], strict=False)]
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), lists, pa.array(texts, pa.string())], ["doc_id", "ids", "text"])

    return encoded.select("doc_id", "ids").mapInArrow(run, "doc_id long, ids array<int>, text string")
