"""Alignment of two tokenizers' tokens over the same bytes.

Offsets where tokens of both end cut a text into groups. Groups form a monoid: a chunk of the two token streams is a
:class:`Fragment` with an open prefix (before its first common offset), closed groups, and an open suffix, and joining two
fragments closes what suffix and prefix make together. Joining is associative, so a very long document is cut into byte
ranges that different tasks tokenise, each tokenizer at the next offset that is safe for it, and a tree of joins
composes the fragments. Other documents are one chunk. Within a chunk both tokenizers are known to end at a space
between two other characters, so the units between such spaces are closed on both sides, and a block of documents
encodes each of its distinct units once.

Documents leave in blocks: one row with their figures, their distinct id pairs as places in the block's sorted list of
pairs, and how many documents hold each. Only those lists are exchanged: partial sums count the documents of each
pair over the corpus, and every block gets the counts of its own pairs back.
"""

from __future__ import annotations

import hashlib
import json
import os
import re
import uuid
from collections import Counter
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, fields
from functools import lru_cache, reduce
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from holdfast.llm import bpe
from holdfast.llm.common import release, slices
from holdfast.session import materialize

#: A space between two characters that are no white space: no token of either kind goes across the place before it.
_UNIT = re.compile(r" (?<=\S )(?=\S)")
_SAFE_A = re.compile(r"[ \t\n\r](?<=\S.)", re.DOTALL)
#: Bytes of text in a block. A block's distinct units are encoded once.
BLOCK_BYTES = 2 << 20
FAN_IN = 8
Group = tuple[tuple[int, ...], tuple[int, ...]]


@dataclass(frozen=True)
class Tokens:
    ids: np.ndarray
    ends: np.ndarray

    def __add__(self, other: Tokens) -> Tokens:
        return Tokens(np.concatenate((self.ids, other.ids)), np.concatenate((self.ends, other.ends)))

    def __getitem__(self, part: slice) -> Tokens:
        return Tokens(self.ids[part], self.ends[part])


NONE = Tokens(np.zeros(0, np.int64), np.zeros(0, np.int64))


@dataclass(frozen=True)
class Fragment:
    """Two token streams over a byte range. ``split``: whether the range has a common offset; if not, all is in the head."""

    split: bool
    head_a: Tokens
    head_b: Tokens
    a: np.ndarray
    b: np.ndarray
    sizes_a: np.ndarray
    sizes_b: np.ndarray
    tail_a: Tokens
    tail_b: Tokens

    @staticmethod
    def of(a: Tokens, b: Tokens) -> Fragment:
        common = np.intersect1d(a.ends, b.ends, assume_unique=True)
        none = NONE.ids
        if not len(common):
            return Fragment(False, a, b, none, none, none, none, NONE, NONE)
        i, j = np.searchsorted(a.ends, common, side="right"), np.searchsorted(b.ends, common, side="right")
        return Fragment(
            True, a[: i[0]], b[: j[0]], a.ids[i[0] : i[-1]], b.ids[j[0] : j[-1]], np.diff(i), np.diff(j), a[i[-1] :], b[j[-1] :]
        )

    def join(self, other: Fragment) -> Fragment:
        left_a, left_b = (self.tail_a, self.tail_b) if self.split else (self.head_a, self.head_b)
        middle = Fragment.of(left_a + other.head_a, left_b + other.head_b)
        parts = [middle]
        if self.split:
            # What the middle begins with is closed on the left by this fragment's last common offset.
            head_a, head_b = middle.head_a, middle.head_b
            if not middle.split:
                return Fragment(True, self.head_a, self.head_b, self.a, self.b, self.sizes_a, self.sizes_b, head_a, head_b)
            first = Fragment(True, NONE, NONE, head_a.ids, head_b.ids, np.array([len(head_a.ids)]), np.array([len(head_b.ids)]), NONE, NONE)
            parts = [self, first, middle]
        if other.split:
            parts.append(other)
        closed = [np.concatenate([getattr(p, name) for p in parts]) for name in ("a", "b", "sizes_a", "sizes_b")]
        last = parts[-1]
        return Fragment(any(p.split for p in parts), parts[0].head_a, parts[0].head_b, *closed, last.tail_a, last.tail_b)

    def groups(self) -> list[Group]:
        """All groups of a whole text, whose beginning and end are common offsets."""
        out: list[Group] = [(tuple(self.head_a.ids.tolist()), tuple(self.head_b.ids.tolist()))] if len(self.head_a.ids) else []
        a, b = self.a.tolist(), self.b.tolist()
        i = j = 0
        for n, m in zip(self.sizes_a.tolist(), self.sizes_b.tolist(), strict=True):
            out.append((tuple(a[i : i + n]), tuple(b[j : j + m])))
            i, j = i + n, j + m
        return out

    def pack(self) -> bytes:
        flat: list[np.ndarray] = []
        for f in fields(self)[1:]:
            value = getattr(self, f.name)
            flat += [value.ids, value.ends] if isinstance(value, Tokens) else [value]
        sizes = np.array([self.split, *map(len, flat)], "<i8")
        return sizes.tobytes() + b"".join(x.astype("<i8" if i in (1, 3, 9, 11) else "<i4").tobytes() for i, x in enumerate(flat))

    @staticmethod
    def unpack(raw: bytes) -> Fragment:
        split, *sizes = np.frombuffer(raw, "<i8", 13).tolist()
        flat, at = [], 13 * 8
        for i, n in enumerate(sizes):
            kind = np.dtype("<i8" if i in (1, 3, 9, 11) else "<i4")
            flat.append(np.frombuffer(raw, kind, n, at).astype(np.int64))
            at += n * kind.itemsize
        t = lambda i: Tokens(flat[i], flat[i + 1])
        return Fragment(bool(split), t(0), t(2), *flat[4:8], t(8), t(10))


def group_text(groups: Iterable[Group]) -> bytes:
    return ";".join(f"{','.join(map(str, a))}|{','.join(map(str, b))}" for a, b in groups).encode()


def group_pairs(groups: Iterable[Group], width: int) -> Counter:
    """How often each pair of ids is linked, by a * width + b. Equal ids of a group are multiplied, not paired one by one."""
    linked: Counter = Counter()
    for (a, b), times in Counter(groups).items():
        if len(a) == len(b) == 1:
            linked[a[0] * width + b[0]] += times
            continue
        right = Counter(b).items()
        for x, n in Counter(a).items():
            for y, m in right:
                linked[x * width + y] += n * m * times
    return linked


def _ranges(begin: np.ndarray, many: np.ndarray) -> np.ndarray:
    """The numbers from each begin on, as many as told, end to end."""
    return np.arange(many.sum()) + np.repeat(begin - np.cumsum(many) + many, many)


@dataclass(frozen=True)
class Units:
    """Many units: whether both tokenizers give the bytes back; n_a, n_b and n_groups; the groups as text, each ending in
    a semicolon; and the linked pairs of all units end to end, ``links`` of each, with weights unless all are 1."""

    good: np.ndarray
    figures: np.ndarray
    texts: list[bytes]
    links: np.ndarray
    code: np.ndarray
    weights: np.ndarray | None


class TwoTokenizers:
    """A byte-level tokenizer of the tokenizers library and a sentencepiece model, with the bytes of their tokens."""

    def __init__(self, path_a: str, path_b: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        import sentencepiece
        import tiktoken
        from tokenizers import Tokenizer

        self._a = Tokenizer.from_file(path_a)
        self._a.no_truncation()
        self._a.no_padding()
        self._a.encode_special_tokens = True
        self._rule = bpe.vocabulary(path_a)
        spec = json.loads(self._a.to_str())
        splitter = spec["pre_tokenizer"] or {}
        if spec["normalizer"] or splitter.get("type") != "ByteLevel" or splitter.get("add_prefix_space") or not splitter.get("use_regex", True):
            raise ValueError("the first tokenizer must be byte-level, with the usual split and without a normaliser")
        letters = bpe.byte_letters()
        entries = self._a.get_vocab(with_added_tokens=False)
        self.bytes_a = [b""] * (1 + max(self._a.get_vocab().values()))
        for text, i in entries.items():
            self.bytes_a[i] = bytes(letters[c] for c in text)
        self._length_a = np.array(list(map(len, self.bytes_a)), np.int64)
        self._b = sentencepiece.SentencePieceProcessor(model_file=path_b)
        self.width = self._b.get_piece_size()
        if len(self.bytes_a) * self.width >= 1 << 63:
            raise ValueError("id pairs must fit 63 bits")
        pieces = [self._b.id_to_piece(i) for i in range(self.width)]
        plain = [not (self._b.is_byte(i) or self._b.is_control(i) or self._b.is_unknown(i)) for i in range(self.width)]
        self.bytes_b = [
            bytes([int(p[3:5], 16)]) if self._b.is_byte(i) else p.replace("▁", " ").encode() if plain[i] else b"" for i, p in enumerate(pieces)
        ]
        #: Adjacent characters within a piece: no token of the second kind goes across any other two.
        self._inside = {p[i : i + 2] for p, ok in zip(pieces, plain, strict=True) if ok for i in range(len(p) - 1)}
        if any(s[1] == "▁" and s[0] != "▁" for s in self._inside) or self._b.encode("x  y") == self._b.encode("x y"):
            raise ValueError("the second tokenizer must begin words, not end them, with its space, and keep all white space")
        # The same merges for the faster library, whose ranks are the places of the merges; single bytes come first.
        byte_ids = [i for b, i in self._rule.ids.items() if len(b) == 1]
        self._by_rank = np.array(byte_ids + [i for i in self._rule.made if len(self.bytes_a[i]) > 1])
        ranks: dict[bytes, int] = {}
        for rank, i in enumerate(self._by_rank.tolist()):
            ranks.setdefault(self.bytes_a[i], rank)
        self._fast = tiktoken.Encoding("merges", pat_str=bpe.PATTERN, mergeable_ranks=ranks, special_tokens={})
        #: The number of every token with what may follow it: a comma, or the end of its side of the group.
        sides = ((len(self.bytes_a), b"|"), (self.width, b";"))
        self._written = [x for n, end in sides for i in range(n) for x in (b"%d," % i, b"%d%b" % (i, end))]

    def _ids_a(self, texts: list[str]) -> list[list[int]]:
        return [e.ids for e in self._a.encode_batch_fast(texts, add_special_tokens=False)]

    def _ids_b(self, texts: list[str]) -> list[list[int]]:
        return self._b.encode(texts, num_threads=1)

    def _units_a(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """The first kind's ids of all units end to end, and how many each has.

        Units of Latin letters are proposed by the faster library as one text. It may merge a pair that the merge list
        does not name, so every adjacent pair is verified, and units with a failing one are encoded by the slower library.
        """
        plain = np.fromiter((bpe._OTHER.search(u) is None for u in words), bool, len(words))
        many = np.zeros(len(words), np.int64)
        chosen = np.flatnonzero(plain)
        text = "".join(" " + words[i] for i in chosen.tolist())
        ids = self._by_rank[self._fast.encode_to_numpy(text)] if text else NONE.ids
        size = np.fromiter((1 + len(words[i].encode()) for i in chosen.tolist()), np.int64, len(chosen))
        stop, end = np.cumsum(size), np.cumsum(self._length_a[ids])
        owner = np.searchsorted(stop, end)
        inside = np.flatnonzero(owner[1:] == owner[:-1])
        keys, at = np.unique(ids[inside] * len(self.bytes_a) + ids[inside + 1], return_inverse=True)
        bad = ~self._rule.compatible(*np.divmod(keys, len(self.bytes_a)))[at]
        failing = np.zeros(len(chosen), bool)
        failing[owner[inside[bad]]] = True
        failing[owner[~self._rule.whole[ids]]] = True
        failing |= ~np.isin(stop, end)
        many[chosen] = np.bincount(owner, minlength=len(chosen))[: len(chosen)]
        plain[chosen[failing]] = False
        slow = np.flatnonzero(~plain)
        kept = ids[~failing[np.minimum(owner, len(chosen) - 1)]] if len(chosen) else ids
        if not len(slow):
            return kept, many
        found: list[list[int]] = []
        for i in range(0, len(slow), 4096):
            found += self._ids_a([" " + words[u] for u in slow[i : i + 4096].tolist()])
        many[slow] = np.fromiter(map(len, found), np.int64, len(found))
        begin = np.cumsum(many) - many
        out = np.empty(int(many.sum()), np.int64)
        for which, values in ((plain, kept), (~plain, np.fromiter(chain.from_iterable(found), np.int64))):
            out[_ranges(begin[which], many[which])] = values
        return out, many

    @staticmethod
    def _tokens(ids: list[int], table: list[bytes], at: int) -> tuple[bytes, Tokens]:
        parts = [table[i] for i in ids]
        return b"".join(parts), Tokens(np.array(ids, np.int64), at + np.cumsum(np.array(list(map(len, parts)), np.int64)))

    @staticmethod
    def _given_back(ids: np.ndarray, many: np.ndarray, table: list[bytes], raw: bytes, begin: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The bytes' lengths of ids, and which units give their bytes back."""
        parts = [table[i] for i in ids.tolist()]
        length = np.fromiter(map(len, parts), np.int64, len(parts))
        total = np.zeros(len(many), np.int64)
        np.add.at(total, np.repeat(np.arange(len(many)), many), length)
        got, good = b"".join(parts), total == size
        if got != raw:
            place = np.cumsum(total) - total
            for u in np.flatnonzero(good).tolist():
                good[u] = got[place[u] : place[u] + size[u]] == raw[begin[u] : begin[u] + size[u]]
        return length, good

    def align_units(self, words: list[str]) -> Units:
        """The groups of many units at once. A unit is text between two cuts, without the space that comes before it."""
        ids_a, many_a = self._units_a(words)
        found: list[list[int]] = []
        for at in range(0, len(words), 4096):
            found += self._ids_b(words[at : at + 4096])
        many_b = np.fromiter(map(len, found), np.int64, len(found))
        ids_b = np.fromiter(chain.from_iterable(found), np.int64, int(many_b.sum()))
        del found
        raw = "".join(" " + u for u in words).encode()
        size = np.fromiter((1 + len(u.encode()) for u in words), np.int64, len(words))
        begin = np.cumsum(size) - size
        length_a, good_a = self._given_back(ids_a, many_a, self.bytes_a, raw, begin, size)
        length_b, good_b = self._given_back(ids_b, many_b, self.bytes_b, raw, begin, size)
        good = good_a & good_b
        keep_a, keep_b = np.repeat(good, many_a), np.repeat(good, many_b)
        ids_a, ids_b = ids_a[keep_a], ids_b[keep_b]
        many_a, many_b = many_a * good, many_b * good
        end_a, end_b = np.cumsum(length_a[keep_a]), np.cumsum(length_b[keep_b])
        marked = np.zeros((2, int((size * good).sum()) + 1), bool)
        marked[0, end_a], marked[1, end_b] = True, True
        last_a, last_b = marked[1, end_a], marked[0, end_b]
        group_a, group_b = np.cumsum(last_a) - last_a, np.cumsum(last_b) - last_b
        n_groups = int(last_a.sum())
        in_a, in_b = np.bincount(group_a, minlength=n_groups), np.bincount(group_b, minlength=n_groups)
        from_a, from_b = np.cumsum(in_a) - in_a, np.cumsum(in_b) - in_b
        # Texts: the tokens of both in the order they are written in, each with the sign that follows it.
        order = np.empty(len(ids_a) + len(ids_b), np.int64)
        order[np.arange(len(ids_a)) + from_b[group_a]] = 2 * ids_a + last_a
        order[np.arange(len(ids_b)) + (from_a + in_a)[group_b]] = 2 * (len(self.bytes_a) + ids_b) + last_b
        written = [self._written[i] for i in order.tolist()]
        stop = np.cumsum(many_a + many_b).tolist()
        texts = [b"".join(written[i:j]) for i, j in zip([0, *stop], stop, strict=False)]
        # Links: every token of the first kind with every one of the second in its group, but for very large groups.
        large = in_a * in_b > 4096
        times = np.where(large, 0, in_b)[group_a]
        spot = np.repeat(np.arange(len(ids_a)), times)
        inner = np.arange(len(spot)) - np.repeat(np.cumsum(times) - times, times)
        code = ids_a[spot] * self.width + ids_b[from_b[group_a[spot]] + inner]
        unit_a = np.repeat(np.arange(len(words)), many_a)
        units, weights = unit_a[spot], None
        if large.any():
            more = [np.zeros((0, 3), np.int64)]
            for g in np.flatnonzero(large).tolist():
                i, j = from_a[g], from_b[g]
                group = tuple(ids_a[i : i + in_a[g]].tolist()), tuple(ids_b[j : j + in_b[g]].tolist())
                more.append(np.array([(unit_a[i], c, n) for c, n in group_pairs([group], self.width).items()], np.int64))
            extra = np.concatenate(more)
            weights = np.concatenate((np.ones(len(code), np.int64), extra[:, 2]))
            units, code = np.concatenate((units, extra[:, 0])), np.concatenate((code, extra[:, 1]))
            turn = np.argsort(units, kind="stable")
            units, code, weights = units[turn], code[turn], weights[turn]
        groups = np.bincount(unit_a[last_a], minlength=len(words))
        return Units(good, np.stack((many_a, many_b, groups)), texts, np.bincount(units, minlength=len(words)), code, weights)

    def safe_a(self, text: str, at: int) -> int:
        """The first place from ``at`` on, at white space after another character, that no token of the first kind crosses."""
        m = _SAFE_A.search(text, max(at, 1))
        return m.start() if m else len(text)

    def safe_b(self, text: str, at: int) -> int:
        """The first place from ``at`` on that no token of the second kind crosses and at which it can begin anew."""
        inside = self._inside
        for i in range(max(at, 1), len(text)):
            x, y = text[i - 1], text[i]
            if x != " " and (y == " " or (x + y not in inside and "▁" + y not in inside)):
                return i
        return len(text)

    def fragment(self, a: str, from_a: int, first_a: bool, b: str, from_b: int) -> Fragment | None:
        """The fragment of a chunk: the first kind's text and byte offset, and the second's. None if bytes are changed."""
        want_a, want_b = (" " + a if first_a else a).encode(), (" " + b if from_b == 0 else b).encode()
        ids_a = self._ids_a([want_a.decode()])[0] if a or first_a else []
        ids_b: list[int] = []
        if b:
            spaced = from_b == 0 or b[0] == " "
            ids_b = self._ids_b([b[1:] if spaced and from_b else b])[0]
            if not spaced:  # the model puts a space before the text, which stays a token by itself at such a place
                if not ids_b or self.bytes_b[ids_b[0]] != b" ":
                    return None
                ids_b = ids_b[1:]
            elif from_b and len(b) == 1:
                ids_b = [self._b.piece_to_id("▁")]
        got_a, tokens_a = self._tokens(ids_a, self.bytes_a, from_a)
        got_b, tokens_b = self._tokens(ids_b, self.bytes_b, from_b)
        return Fragment.of(tokens_a, tokens_b) if got_a == want_a and got_b == want_b else None


@lru_cache(maxsize=2)
def two_tokenizers(path_a: str, path_b: str) -> TwoTokenizers:
    return TwoTokenizers(path_a, path_b)


def chunks(both: TwoTokenizers, text: str, size: int) -> Iterator[tuple[str, int, str, int]]:
    """(text and byte offset for the first kind, the same for the second) of ranges of about ``size`` characters.

    Offsets count the space that both put before the text. Each kind is cut at its own next safe place.
    """
    at_a = at_b = off_a = off_b = 0
    goal = size
    while at_a < len(text) or at_b < len(text):
        to_a = max(at_a, both.safe_a(text, goal)) if goal < len(text) else len(text)
        to_b = max(at_b, both.safe_b(text, goal)) if goal < len(text) else len(text)
        a, b = text[at_a:to_a], text[at_b:to_b]
        if a or b:
            yield a, off_a, b, off_b
        off_a += len(a.encode()) + (off_a == 0 and bool(a))
        off_b += len(b.encode()) + (off_b == 0 and bool(b))
        at_a, at_b, goal = to_a, to_b, goal + size


_BLOCK = pa.schema(
    [("block", pa.string()), ("doc_id", pa.list_(pa.int64())), ("copies", pa.list_(pa.int64())), ("n_a", pa.list_(pa.int64())),
     ("n_b", pa.list_(pa.int64())), ("n_groups", pa.list_(pa.int64())), ("n_links", pa.list_(pa.int64())), ("digest", pa.list_(pa.string())),
     ("sizes", pa.binary()), ("places", pa.binary()), ("times", pa.binary()), ("pairs", pa.binary()), ("docs", pa.binary())]
)
_BLOCK_SQL = (
    "block string, doc_id array<long>, copies array<long>, n_a array<long>, n_b array<long>, n_groups array<long>, n_links array<long>, "
    "digest array<string>, sizes binary, places binary, times binary, pairs binary, docs binary"
)
_CHUNK = "doc_id long, key string, copies long, k long, a string, off_a long, b string, off_b long"
_PART = "doc_id long, key string, copies long, k long, fragment binary"
_OUT = "doc_id long, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, digest string"


def _small(x: np.ndarray) -> bytes:
    return pa.compress(x.tobytes(), "zstd", asbytes=True)


def _block(
    ids: list, copies: np.ndarray, figures: np.ndarray, digests: list[str], doc: np.ndarray, place: np.ndarray, weights: np.ndarray | None, pairs: np.ndarray
) -> pa.RecordBatch:
    """A block row of documents from entries (document, place of the pair in ``pairs``, how often), in which pairs may repeat."""
    width = max(len(pairs), 1)
    key = doc * width + place
    if weights is None:
        key.sort()
    else:
        turn = np.argsort(key)
        key, weights = key[turn], weights[turn]
    new = np.flatnonzero(np.diff(key, prepend=-1))
    many = np.diff(np.append(new, len(key))) if weights is None else np.add.reduceat(weights, new) if len(new) else weights
    owner, place = np.divmod(key[new], width)
    links = np.zeros(len(ids), np.int64)
    np.add.at(links, owner, many)
    docs = np.zeros(len(pairs), np.int64)
    np.add.at(docs, place, copies[owner])
    n_a, n_b, n_groups = figures
    row = [
        uuid.uuid4().hex, ids, copies.tolist(), n_a.tolist(), n_b.tolist(), n_groups.tolist(), links.tolist(), digests,
        np.bincount(owner, minlength=len(ids)).astype("<i4").tobytes(), _small(place.astype("<i4")), _small(many.astype("<i8")),
        pairs.astype("<i8").tobytes(), docs.astype("<i8").tobytes(),
    ]
    return pa.RecordBatch.from_arrays([pa.array([v], t) for v, t in zip(row, _BLOCK.types, strict=True)], schema=_BLOCK)


def _short_blocks(path_a: str, path_b: str):
    def block(both: TwoTokenizers, ids: list, texts: list[str | None]) -> pa.RecordBatch:
        parts = [_UNIT.split(t) if t else [] for t in texts]
        ends = np.cumsum([0, *map(len, parts)])
        coded = pa.array(list(chain.from_iterable(parts)), pa.string()).dictionary_encode()
        del parts
        units, at = both.align_units(coded.dictionary.to_pylist()), coded.indices.to_numpy()
        ok = np.array([j > i and bool(units.good[at[i:j]].all()) for i, j in zip(ends, ends[1:], strict=False)], bool)
        text_of = units.texts
        digests = [
            hashlib.sha256(b"".join([text_of[u] for u in at[i:j].tolist()])[:-1]).hexdigest() if right else ""
            for i, j, right in zip(ends.tolist(), ends[1:].tolist(), ok.tolist(), strict=False)
        ]
        owner = np.repeat(np.arange(len(texts)), np.diff(ends))
        valid = ok[owner]
        owner, at = owner[valid], at[valid]
        figures = np.zeros((3, len(texts)), np.int64)
        for i in range(3):
            np.add.at(figures[i], owner, units.figures[i, at])
        pairs, place = np.unique(units.code, return_inverse=True)
        spread = _ranges((np.cumsum(units.links) - units.links)[at], units.links[at])
        weights = None if units.weights is None else units.weights[spread]
        return _block(ids, np.ones(len(texts), np.int64), figures, digests, np.repeat(owner, units.links[at]), place[spread], weights, pairs)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        both = two_tokenizers(path_a, path_b)
        for batch in slices(batches, most=BLOCK_BYTES):
            yield block(both, batch.column("doc_id").to_pylist(), batch.column("text").to_pylist())
            release()

    return run


def _cut(path_a: str, path_b: str, size: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        both = two_tokenizers(path_a, path_b)
        names = [c.split()[0] for c in _CHUNK.split(", ")]
        for batch in batches:
            for doc_id, key, copies, text in zip(*(batch.column(c).to_pylist() for c in ("doc_id", "key", "copies", "text")), strict=True):
                for k, part in enumerate(chunks(both, text, size)):
                    yield pa.RecordBatch.from_pydict(
                        dict(zip(names, ([x] for x in (doc_id, key, copies, k, *part)), strict=True)),
                        schema=pa.schema([(n, pa.string() if n in ("key", "a", "b") else pa.int64()) for n in names]),
                    )

    return run


def _part_batch(rows: list[tuple]) -> pa.RecordBatch:
    schema = pa.schema([("doc_id", pa.int64()), ("key", pa.string()), ("copies", pa.int64()), ("k", pa.int64()), ("fragment", pa.binary())])
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), schema.types, strict=True)], schema=schema)


def _fragments(path_a: str, path_b: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        both = two_tokenizers(path_a, path_b)
        for batch in batches:
            for doc_id, key, copies, k, a, off_a, b, off_b in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                found = both.fragment(a, off_a, off_a == 0 and k == 0, b, off_b)
                yield _part_batch([(doc_id, key, copies, k, found and found.pack())])

    return run


def _joined(rows: pa.Table) -> pa.Table:
    """One level of the tree: the fragments of a document that follow each other; none if one of them is none."""
    rows = rows.sort_by("k")
    packed = rows.column("fragment").to_pylist()
    whole = None if None in packed else reduce(Fragment.join, map(Fragment.unpack, packed)).pack()
    first = [rows.column(c)[0].as_py() for c in ("doc_id", "key", "copies", "k")]
    return pa.Table.from_batches([_part_batch([(*first[:3], first[3] // FAN_IN, whole)])])


def _long_blocks(path_a: str, path_b: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        width = two_tokenizers(path_a, path_b).width
        for batch in batches:
            for doc_id, copies, packed in zip(*(batch.column(c).to_pylist() for c in ("doc_id", "copies", "fragment")), strict=True):
                groups = Fragment.unpack(packed).groups() if packed else []
                linked = group_pairs(groups, width)
                code, times = np.array(list(linked), np.int64), np.array(list(linked.values()), np.int64)
                pairs, place = np.unique(code, return_inverse=True)
                figures = np.array([[sum(len(g[0]) for g in groups)], [sum(len(g[1]) for g in groups)], [len(groups)]], np.int64)
                digest = hashlib.sha256(group_text(groups)).hexdigest() if groups else ""
                yield _block([doc_id], np.array([copies], np.int64), figures, [digest], np.zeros(len(code), np.int64), place, times, pairs)

    return run


def _listed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    two_tokenizers.cache_clear()  # not needed any more by this worker
    bpe.vocabulary.cache_clear()
    release()
    for batch in batches:
        for block, pairs, docs in zip(*(batch.column(c).to_pylist() for c in ("block", "pairs", "docs")), strict=True):
            pair, n = np.frombuffer(pairs, "<i8"), np.frombuffer(docs, "<i8")
            yield pa.RecordBatch.from_arrays([pa.array([block] * len(pair), pa.string()), pa.array(pair), pa.array(n)], ["block", "pair", "docs"])


def _settled(blocks: pa.Table, answers: pa.Table) -> pa.Table:
    """The documents of a block with the sums over their links; ``answers`` has the count of each pair of the block."""
    two_tokenizers.cache_clear()
    bpe.vocabulary.cache_clear()
    pair = answers.column("pair").to_numpy()
    order = np.argsort(pair)
    count, best = answers.column("count").to_numpy()[order], answers.column("best").to_numpy()[order].astype(np.int64)
    row = blocks.to_pylist()[0]
    sizes = np.frombuffer(row["sizes"], "<i4")
    n = int(sizes.sum())
    place, times = (np.frombuffer(pa.decompress(row[c], n * w, "zstd", asbytes=True), f"<i{w}") for c, w in (("places", 4), ("times", 8)))
    owner = np.repeat(np.arange(len(sizes)), sizes)
    total, top = np.zeros(len(sizes), np.int64), np.zeros(len(sizes), np.int64)
    if len(place):
        np.add.at(total, owner, count[place] * times)
        np.add.at(top, owner, best[place] * times)
    copies = np.array(row["copies"], np.int64)
    columns = [pa.array(row[c], pa.int64()) for c in ("doc_id", "n_a", "n_b", "n_groups", "n_links")] + [pa.array(top), pa.array(total), pa.array(row["digest"])]
    names = [c.split()[0] for c in _OUT.split(", ")]
    return pa.table(columns, names=names).take(pa.array(np.repeat(np.arange(len(copies)), copies)))


def align(docs: DataFrame, path_a: str, path_b: str, id_col: str = "doc_id", text_col: str = "text", chunk: int = 1 << 16) -> DataFrame:
    """(doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, digest) of every row of ``docs``.

    ``path_a`` names a byte-level file of the tokenizers library, ``path_b`` a sentencepiece model, on every node. Texts
    are encoded whole, without special tokens, with a space before them. A null or empty text, and one whose bytes a
    tokenizer does not give back, has zeros and an empty digest. Every row is a document; a null id stays null; an empty
    table gives no rows; columns besides id and text are not read.

    ``chunk`` is the number of bytes above which a text counts as very long and is cut into ranges of as many
    characters, dealt to different tasks; it steers the work, not the result. A text without a safe place to cut (one
    word of any length) stays one chunk. Repeated rows of a very long text are worked on once.
    """
    paths = (path_a, path_b)
    spark = docs.sparkSession
    parts = 4 * int(spark.conf.get("spark.sql.shuffle.partitions"))
    rows = docs.select(docs[id_col].cast("long").alias("doc_id"), docs[text_col].cast("string").alias("text"))
    longest = rows.agg(F.max(F.octet_length("text"))).first()[0] or 0
    size = F.coalesce(F.octet_length("text"), F.lit(0))
    blocks = rows.where(size <= chunk).mapInArrow(_short_blocks(*paths), _BLOCK_SQL)
    if longest > chunk:
        very = rows.where(size > chunk).groupBy("doc_id", F.sha2("text", 256).alias("key")).agg(F.first("text").alias("text"), F.count("*").alias("copies"))
        cut = very.mapInArrow(_cut(*paths, chunk), _CHUNK).repartition(parts, "doc_id", "key", "k")
        tree, left = cut.mapInArrow(_fragments(*paths), _PART), longest // chunk + 1
        while left > 1:
            tree = tree.groupBy("doc_id", "key", F.floor(F.col("k") / FAN_IN)).applyInArrow(_joined, _PART)
            left = -(-left // FAN_IN)
        blocks = blocks.unionByName(tree.mapInArrow(_long_blocks(*paths), _BLOCK_SQL))
    blocks = materialize(blocks, "blocks")
    width = two_tokenizers(*paths).width
    listed = blocks.mapInArrow(_listed, "block string, pair long, docs long")
    counts = materialize(listed.groupBy("pair").agg(F.sum("docs").alias("count")), "pairs").withColumn("a", F.expr(f"pair div {width}L"))
    # One row per id of the first vocabulary: some 50,000.
    most = counts.groupBy("a").agg(F.max("count").alias("most"))
    known = counts.join(F.broadcast(most), "a").select("pair", "count", (F.col("count") == F.col("most")).alias("best"))
    answers = listed.select("block", "pair").join(known, "pair")
    return blocks.drop("pairs", "docs").groupBy("block").cogroup(answers.groupBy("block")).applyInArrow(_settled, _OUT)
