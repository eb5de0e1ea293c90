"""Packing of documents into training sequences along a space-filling curve.

A document's hashed token counts, scaled to length one, are projected to a few dimensions and quantised; the Hilbert
key of that point orders the corpus so that similar documents are neighbours. The ordered documents form one stream
of tokens, cut every ``length`` tokens: every sequence is full but the very last.

Tokens are stored once. Keys carry a hash of the id in their low bits, so copies, however many, spread over the
ranges that the work is dealt by. Where a range starts in the stream follows from the token totals of the ranges
before it, so each range is laid out by itself, in order, holding one document at a time.
"""

from __future__ import annotations

import json
import os
import unicodedata
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from holdfast.llm.common import as_bytes, id_and_text, release, slices
from holdfast.session import materialize

DIMENSIONS, BITS, BUCKETS, SPREAD = 4, 10, 512, 23
KEPT_WORDS = 400_000
#: ASCII signs but the apostrophe, which may begin a contraction.
_SIGNS = bytes(b for b in range(33, 127) if not chr(b).isalnum() and b != 39)


def hilbert_keys(points: np.ndarray, bits: int) -> np.ndarray:
    """The place of integer points (rows, with ``bits`` bits in each dimension) along the Hilbert curve.

    The axes are turned into the curve's transposed index: from the highest bit down, a set bit inverts the lower
    bits of the first axis and a clear one exchanges them with it; Gray-coding the axes then gives the digits.
    """
    x = points.astype(np.int64).T.copy()
    n = len(x)
    for level in range(bits - 1, 0, -1):
        q, low = 1 << level, (1 << level) - 1
        for i in range(n):
            high = (x[i] & q) != 0
            swap = np.where(high, 0, (x[0] ^ x[i]) & low)
            x[0] ^= np.where(high, low, swap)
            x[i] ^= swap
    for i in range(1, n):
        x[i] ^= x[i - 1]
    turn = np.zeros_like(x[0])
    for level in range(bits - 1, 0, -1):
        turn ^= np.where(x[n - 1] & (1 << level), (1 << level) - 1, 0)
    x ^= turn
    key = np.zeros_like(x[0])
    for level in range(bits - 1, -1, -1):
        for i in range(n):
            key = (key << 1) | ((x[i] >> level) & 1)
    return key


def token_projection() -> np.ndarray:
    """BUCKETS x DIMENSIONS, fixed by a seed."""
    return np.random.default_rng(11).standard_normal((BUCKETS, DIMENSIONS))


def document_point(ids: np.ndarray, projection: np.ndarray) -> np.ndarray:
    """Coordinates between 0 and 1 of a document's hashed, scaled and projected token counts."""
    counts = np.bincount((ids.astype(np.int64) * 40503 >> 4) % BUCKETS, minlength=BUCKETS)
    spot = (counts @ projection) / np.sqrt(np.dot(counts, counts))
    return 1.0 / (1.0 + np.exp(-1.702 * spot))


class WordTokens:
    """Ids by the tokenizers library, kept by word: the tokenizer drops white space and never looks across it.

    It also splits letters from what is not a letter and ends the last token of every such part with a mark, so many
    words of letters can be encoded as one text and signs behind a word by themselves. Capital ASCII
    letters are lowered first, as the tokenizer does, unless a combining mark could join one or a special token occur.
    """

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self._tokenizer = Tokenizer.from_file(path)
        self._tokenizer.no_truncation()
        self._tokenizer.no_padding()
        spec = json.loads(self._tokenizer.to_str())
        if '"Lowercase"' not in json.dumps(spec["normalizer"]) or spec["model"].get("end_of_word_suffix") != "</w>":
            raise ValueError("packing needs a tokenizer that lowers case and marks the ends of words")
        vocabulary = self._tokenizer.get_vocab()
        self._ends = np.zeros(max(vocabulary.values()) + 1, bool)
        self._ends[[i for s, i in vocabulary.items() if s.endswith("</w>")]] = True
        self._known: dict[bytes, bytes] = {}

    def _encode(self, words: list[str]) -> list[bytes]:
        return [np.array(e.ids, "<u2").tobytes() for e in self._tokenizer.encode_batch_fast(words, add_special_tokens=False)]

    def _encode_letters(self, words: list[str]) -> list[bytes]:
        ids = np.array(self._tokenizer.encode_batch_fast([" ".join(words)], add_special_tokens=False)[0].ids, "<u2")
        ends = np.flatnonzero(self._ends[ids]) + 1
        if len(ends) != len(words):
            return self._encode(words)
        raw, at = ids.tobytes(), (2 * ends).tolist()
        return [raw[i:j] for i, j in zip([0, *at], at, strict=False)]

    def _learn(self, words: list[bytes]) -> None:
        """Add words; one of letters with signs behind it is put together from its two parts."""
        known = self._known
        letters: dict[bytes, str] = {}
        others: dict[bytes, str] = {}
        joined = []
        for w in words:
            stem = w.rstrip(_SIGNS)
            text = stem.decode()
            # A letter that the tokenizer's normaliser turns into letter and mark would be joined with the signs behind it.
            if not text.isalpha() or not (text.isascii() or unicodedata.normalize("NFC", text).lower().isalpha()):
                others[w] = w.decode()
                continue
            if stem not in known:
                letters[stem] = text
            if len(stem) < len(w):
                tail = w[len(stem) :]
                joined.append((w, stem, tail))
                if tail not in known:
                    others[tail] = tail.decode()
        for chosen, encode in ((letters, self._encode_letters), (others, self._encode)):
            keys, texts = list(chosen), list(chosen.values())
            for at in range(0, len(keys), 2000):
                known.update(zip(keys[at : at + 2000], encode(texts[at : at + 2000]), strict=True))
        known.update((w, known[stem] + known[tail]) for w, stem, tail in joined)

    def encode_all(self, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts, one after the other, and where each text's begin (with the end of all)."""
        low = pa.array([t if b"\xcc" in t or b"\xcd" in t or b"<|" in t else t.lower() for t in texts], pa.string())
        parts = pc.ascii_split_whitespace(low)
        coded = parts.flatten().dictionary_encode()
        words = coded.dictionary.cast(pa.binary()).to_numpy(zero_copy_only=False).tolist()
        if len(self._known) > KEPT_WORDS:
            self._known.clear()
        known = self._known
        known[b""] = b""
        self._learn([w for w in words if w not in known])
        raw = [known[w] for w in words]
        sizes = np.fromiter(map(len, raw), np.int64, len(raw)) // 2
        starts = np.cumsum(sizes) - sizes
        at = coded.indices.to_numpy()
        many = sizes[at]
        ends = np.concatenate(([0], np.cumsum(many)))
        place = np.arange(ends[-1]) + np.repeat(starts[at] - ends[:-1], many)
        return np.frombuffer(b"".join(raw), "<u2")[place], ends[parts.offsets.to_numpy()]


@lru_cache(maxsize=2)
def word_tokens(path: str) -> WordTokens:
    return WordTokens(path)


def tokenised(docs: DataFrame, path: str, end_id: int) -> DataFrame:
    """(doc_id, key, n, ids): ids as 16-bit numbers with ``end_id`` last; key is the Hilbert key with a hash of the id."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens, projection, end = word_tokens(path), token_projection(), np.array([end_id], "<u2").tobytes()
        for batch in slices(batches):
            flat, edges = tokens.encode_all([t or b"" for t in as_bytes(batch.column("text"))])
            ids = [flat[i:j].tobytes() + end for i, j in zip(edges.tolist(), edges[1:].tolist(), strict=False)]
            points = np.array([document_point(np.frombuffer(x, "<u2"), projection) for x in ids])
            key = hilbert_keys(np.minimum(points * (1 << BITS), (1 << BITS) - 1), BITS) << SPREAD
            n = pa.array([len(x) // 2 for x in ids], pa.int64())
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(key), n, pa.array(ids, pa.binary())], ["doc_id", "key", "n", "ids"])
            del flat, ids
        release()

    rows = id_and_text(docs).mapInArrow(run, "doc_id long, key long, n long, ids binary")
    spread = F.xxhash64("doc_id", "n").bitwiseAND((1 << SPREAD) - 1)
    return rows.select("doc_id", F.col("key").bitwiseOR(spread).alias("key"), "n", "ids")


def pack(docs: DataFrame, path: str, length: int = 4096, end_id: int = 2, ranges: int | None = None) -> DataFrame:
    """One row per piece of a document: doc_id, start, length, ids (binary: unsigned little-endian 32-bit), doc_tokens,
    sequence_id, offset.

    A null text is an empty document, which still has its end id. Repeated rows are packed one by one. Documents of
    equal key follow each other by id, then by a hash of their content. Vocabularies above 65,536 ids are not supported.
    """
    spark = docs.sparkSession
    stored = materialize(tokenised(docs, path, end_id), "tokens")
    ranges = ranges or 4 * int(spark.conf.get("spark.sql.shuffle.partitions"))
    cuts = ", ".join(f"{i / ranges}D" for i in range(1, ranges)) or "0.5D"
    edges = np.array(stored.agg(F.expr(f"percentile_approx(key, array({cuts}), {20 * ranges})")).first()[0] or [], np.int64)

    @F.pandas_udf("long")
    def range_of(key: pd.Series) -> pd.Series:
        return pd.Series(np.searchsorted(edges, key.to_numpy(), side="right"))

    dealt = stored.withColumn("part", range_of("key"))
    # One row per range: their number is set by the shuffle partitions, not by the data.
    totals = dict(dealt.groupBy("part").agg(F.sum("n")).collect())
    begin, at = {}, 0
    for part in sorted(totals):
        begin[part], at = at, at + totals[part]

    def lay_out(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, place = None, 0
        names = ["doc_id", "start", "length", "ids", "doc_tokens", "sequence_id", "offset"]
        for whole in batches:
            for batch in slices([whole], text="ids", most=2 << 20):
                rows = []
                for doc_id, own, n, ids in zip(*(batch.column(c).to_pylist() for c in ("doc_id", "part", "n", "ids")), strict=True):
                    if own != part:
                        part, place = own, begin[own]
                    wide, start = np.frombuffer(ids, "<u2").astype("<u4").tobytes(), 0
                    while start < n:
                        sequence, offset = divmod(place, length)
                        size = min(n - start, length - offset)
                        rows.append((doc_id, start, size, wide[4 * start : 4 * (start + size)], n, sequence, offset))
                        start, place = start + size, place + size
                types = [pa.int64(), pa.int64(), pa.int64(), pa.binary(), pa.int64(), pa.int64(), pa.int64()]
                columns = [pa.array(c, t) for c, t in zip(zip(*rows, strict=True), types, strict=True)]
                del rows
                yield pa.RecordBatch.from_arrays(columns, names)
        word_tokens.cache_clear()  # not needed any more by this worker
        release()

    ordered = dealt.repartition("part").sortWithinPartitions("part", "key", "doc_id", "n", F.xxhash64("ids"))
    return ordered.mapInArrow(lay_out, "doc_id long, start long, length long, ids binary, doc_tokens long, sequence_id long, offset long")
