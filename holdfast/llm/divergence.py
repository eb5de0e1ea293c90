"""Audit of how the sources of a language differ in their word use, by single-pass in-memory indexing.

Each task reads its documents once and builds block postings in memory: occurrences and documents by language, source
and term. When the memory set for it is full, the postings leave as a run of pieces sorted by term, one series of pieces
for every hash shard. Per shard the pieces of all runs arrive in the order of their first terms and are merged over a
heap: a piece is opened when its first term is due, so a shard holds one piece of each run and not its whole content.

Probabilities are fixed-point integers, so every sum is exact. With ``b`` the probability of an absent term, the
distance of two sources is ``V * |b - b'|`` where neither has the term, what a source's own terms change (from a
histogram of its probabilities), and a correction for terms that both have. Corrections stream over the terms and
are added up in the task, so no pair of sources is ever emitted per term.
"""

from __future__ import annotations

import zlib
from collections import Counter, defaultdict
from collections.abc import Iterator
from heapq import heappop, heappush

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from holdfast.llm.common import as_bytes, slices
from holdfast.session import materialize

#: Fixed value: what may be part of a term are ASCII letters, lowered, and all that is not ASCII; the rest separates.
_LETTERS = bytes(b + 32 if 65 <= b <= 90 else b if 97 <= b <= 122 or b >= 128 else 32 for b in range(256))
_PIECE_TERMS = 2048
_RUN = "shard int, lang string, first binary, terms binary, sizes binary, places binary, sources array<string>, tf binary, df binary"
_ARROW = pa.schema(
    [("shard", pa.int32()), ("lang", pa.string()), ("first", pa.binary()), ("terms", pa.binary()), ("sizes", pa.binary()),
     ("places", pa.binary()), ("sources", pa.list_(pa.string())), ("tf", pa.binary()), ("df", pa.binary())]
)
_TERM = pa.schema(
    [("lang", pa.string()), ("term", pa.string()), ("docs", pa.int64()), ("sources", pa.list_(pa.string())), ("counts", pa.list_(pa.int64()))]
)


def terms_in(text: bytes, most: int = 4 << 20) -> Iterator[list[bytes]]:
    """The terms of a UTF-8 text in order, a few megabytes of text at a time."""
    text = text.translate(_LETTERS)
    at = 0
    while at < len(text):
        end = text.find(b" ", at + most)
        end = len(text) if end < 0 else end
        yield text[at:end].split()
        at = end


class Postings:
    """Block postings: occurrences and documents of each term, by (language, source)."""

    def __init__(self, shards: int):
        self.shards = shards
        self.clear()

    def clear(self) -> None:
        self.tf: dict[tuple[str, str], Counter] = defaultdict(Counter)
        self.df: dict[tuple[str, str], Counter] = defaultdict(Counter)
        self.size = 0

    def add(self, lang: str, source: str, text: bytes) -> None:
        tf, df = self.tf[lang, source], self.df[lang, source]
        before, own = len(tf), set()
        for terms in terms_in(text):
            tf.update(terms)
            own.update(terms)
        df.update(own)
        self.size += len(tf) - before

    def run(self) -> Iterator[pa.RecordBatch]:
        """All postings as pieces sorted by term within language and shard. The empty term marks that a group occurs."""
        by_lang: dict[str, list[str]] = defaultdict(list)
        for lang, source in self.tf:
            by_lang[lang].append(source)
        for lang, sources in by_lang.items():
            salt = zlib.crc32(lang.encode())
            dealt: dict[int, list[tuple[bytes, int]]] = defaultdict(list)
            for i, source in enumerate(sources):
                for term in (b"", *self.tf[lang, source]):
                    dealt[zlib.crc32(term, salt) % self.shards].append((term, i))
            rows = []
            for shard, entries in dealt.items():
                entries.sort()
                rows += self._pieces(shard, lang, sources, entries)
            for at in range(0, len(rows), 256):
                columns = [pa.array(c, t) for c, t in zip(zip(*rows[at : at + 256], strict=True), _ARROW.types, strict=True)]
                yield pa.RecordBatch.from_arrays(columns, schema=_ARROW)
        self.clear()

    def _pieces(self, shard: int, lang: str, sources: list[str], entries: list[tuple[bytes, int]]) -> Iterator[tuple]:
        at = 0
        while at < len(entries):
            end = min(at + _PIECE_TERMS, len(entries))
            while end < len(entries) and entries[end][0] == entries[end - 1][0]:
                end += 1
            part = entries[at:end]
            terms = list(dict.fromkeys(t for t, _ in part))
            sizes = Counter(t for t, _ in part)
            used = sorted({i for _, i in part})
            place = {i: n for n, i in enumerate(used)}
            yield (
                shard, lang, terms[0], b" ".join(terms), np.array([sizes[t] for t in terms], "<i4").tobytes(),
                np.array([place[i] for _, i in part], "<i4").tobytes(), [sources[i] for i in used],
                np.array([self.tf[lang, sources[i]][t] for t, i in part], "<i8").tobytes(),
                np.array([self.df[lang, sources[i]][t] for t, i in part], "<i8").tobytes(),
            )
            at = end


def _entries(terms: bytes, sizes: bytes, places: bytes, sources: list[str], tf: bytes, df: bytes) -> Iterator[tuple[bytes, list[str], list[int], int]]:
    """(term, sources, occurrences by source, documents) of one piece, in order."""
    z = np.cumsum(np.frombuffer(sizes, "<i4")).tolist()
    who, n = [sources[i] for i in np.frombuffer(places, "<i4").tolist()], np.frombuffer(tf, "<i8").tolist()
    docs = np.add.reduceat(np.frombuffer(df, "<i8"), [0, *z[:-1]]).tolist()
    for term, i, j, d in zip(terms.split(b" "), [0, *z], z, docs, strict=False):
        yield term, who[i:j], n[i:j], d


def merged(pieces: Iterator[tuple], least: int) -> Iterator[tuple]:
    """Terms of at least ``least`` documents, and group markers, from pieces sorted by shard, language and first term."""
    heap: list = []
    at, number = None, 0

    def due(limit: bytes | None) -> Iterator[tuple]:
        while heap and (limit is None or heap[0][0] < limit):
            term, counts, docs = heap[0][0], Counter(), 0
            while heap and heap[0][0] == term:
                _, n, (_, who, tf, d), rest = heappop(heap)
                for s, c in zip(who, tf, strict=True):
                    counts[s] += c
                docs += d
                if (following := next(rest, None)) is not None:
                    heappush(heap, (following[0], n, following, rest))
            if docs >= least or not term:
                yield at[1], term.decode(), docs, list(counts), list(counts.values())

    for shard, lang, first, *content in pieces:
        if (shard, lang) != at:
            yield from due(None)
            at = (shard, lang)
        yield from due(first)
        rest = _entries(*content)
        entry, number = next(rest), number + 1
        heappush(heap, (entry[0], number, entry, rest))
    yield from due(None)


def term_counts(docs: DataFrame, least: int = 30, memory: int = 300_000) -> DataFrame:
    """(lang, term, docs, sources, counts): the terms of a language in ``least`` of its documents or more, with their
    occurrences in each source that has them; and one row with the empty term per language that lists all its sources.

    ``docs`` has text, lang and source; a null of any counts as empty. ``memory`` is how many (source, term) pairs a
    task holds before it lets a run go.
    """
    shards = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))

    def index(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        postings = Postings(shards)
        for batch in slices(batches):
            for lang, source, text in zip(batch.column("lang").to_pylist(), batch.column("source").to_pylist(), as_bytes(batch.column("text")), strict=True):
                postings.add(lang, source, text)
                if postings.size > memory:
                    yield from postings.run()
        yield from postings.run()

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = []
        pieces = (p for b in batches for p in zip(*(b.column(c).to_pylist() for c in _ARROW.names), strict=True))
        for row in merged(pieces, least):
            rows.append(row)
            if len(rows) == 4096:
                yield _batch(rows)
                rows = []
        if rows:
            yield _batch(rows)

    def _batch(rows: list[tuple]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), _TERM.types, strict=True)], schema=_TERM)

    texts = docs.select(*(F.coalesce(docs[c].cast("string"), F.lit("")).alias(c) for c in ("text", "lang", "source")))
    runs = texts.mapInArrow(index, _RUN).repartition(shards, "shard").sortWithinPartitions("shard", "lang", "first")
    return runs.mapInArrow(merge, "lang string, term string, docs long, sources array<string>, counts array<long>")


def share(count: Column, total: Column) -> Column:
    """1 + floor(1000000000 * (count + 5) / total) in whole numbers, in two steps of long division.

    Totals up to 2.8 * 10^14 are exact; above, Spark's checked arithmetic stops the query. A total of 0 gives null.
    """
    scaled = (count + 5) * F.lit(31_250).cast("long")
    total = F.when(total > 0, total)
    rest = (scaled % total) * 32_000
    return 1 + F.call_function("div", scaled, total) * 32_000 + F.call_function("div", rest, total)


def _correct(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Per (lang, source, item): what terms that both have change, over rows (lang, term, source, p, b) sorted by term."""
    names = ["lang", "source", "item", "value"]
    held: list[tuple[str, str, int, int]] = []
    lang, term, terms = None, None, 0

    def settle() -> Iterator[pa.RecordBatch]:
        nonlocal terms
        place: dict[str, int] = {}
        base: list[int] = []
        row, column, p = np.empty(len(held), np.int64), np.empty(len(held), np.int64), np.empty(len(held), np.int64)
        previous, n = None, -1
        for i, (t, s, x, b) in enumerate(held):
            n += t != previous
            previous = t
            if s not in place:
                place[s] = len(base)
                base.append(b)
            row[i], column[i], p[i] = n, place[s], x
        held.clear()
        terms = 0
        b, k = np.array(base, np.int64), len(base)
        total, met = np.zeros((k, k), np.int64), np.zeros((k, k), bool)
        step = max(1, (1 << 20) // max(k, 1))
        for at in range(0, n + 1, step):
            i, j = np.searchsorted(row, (at, at + step))
            grid = np.full((min(step, n + 1 - at), k), -1, np.int64)
            grid[row[i:j] - at, column[i:j]] = p[i:j]
            for s in range(k):
                own = grid[grid[:, s] >= 0]
                mine = own[:, s : s + 1]
                change = np.abs(own - mine) - np.abs(mine - b) - np.abs(own - b[s]) + np.abs(b - b[s])
                both = own >= 0
                total[s] += np.where(both, change, 0).sum(0)
                met[s] |= both.any(0)
        np.fill_diagonal(met, False)
        who = list(place)
        for s in range(k):
            others = np.flatnonzero(met[s]).tolist()
            if others:
                columns = [[lang] * len(others), [who[s]] * len(others), [who[o] for o in others], total[s, others].tolist()]
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, [pa.string()] * 3 + [pa.int64()], strict=True)], names)

    for batch in batches:
        for at, t, s, p, b in zip(*(batch.column(c).to_pylist() for c in ("lang", "term", "source", "p", "b")), strict=True):
            if held and (at != lang or (t != term and len(held) > 200_000)):
                yield from settle()
            lang, term = at, t
            held.append((t, s, p, b))
    if held:
        yield from settle()


def audit(docs: DataFrame, least: int = 30, top: int = 50, lang_col: str = "lang", source_col: str = "source", text_col: str = "text") -> DataFrame:
    """(lang, source, part, item, value, rank) for every (lang, source) group of ``docs``.

    Part ``pair``: the other sources of the language by distance, all of them. Part ``term``: the kept terms that the
    group uses more than its language does, ``top`` of them. Ranks go by falling value, then by the item's UTF-8.

    A null text, language or source counts as empty; a group without terms takes part. Every row is a document of its
    own, repeated ones too. An empty table gives no rows. Texts may be of any length and further columns are not
    read. A task that adds corrections holds the square of a language's number of sources, as many values as the result has.
    """
    columns = docs.select(docs[text_col].alias("text"), docs[lang_col].alias("lang"), docs[source_col].alias("source"))
    kept = materialize(term_counts(columns, least), "terms")
    groups = kept.where("term = ''").select("lang", F.explode("sources").alias("source"))
    terms = kept.where("term <> ''")
    total = F.aggregate("counts", F.lit(0).cast("long"), lambda a, x: a + x)
    posts = terms.select("lang", "term", total.alias("all"), F.explode(F.arrays_zip("sources", "counts")).alias("e")).select(
        "lang", "term", "all", F.col("e.sources").alias("source"), F.col("e.counts").alias("n")
    )
    sizes = terms.groupBy("lang").agg(F.count("*").alias("v"), F.sum(total).alias("all_n"))
    own = posts.groupBy("lang", "source").agg(F.sum("n").alias("n"))
    zero = F.lit(0).cast("long")
    stats = groups.join(own, ["lang", "source"], "left").join(sizes, "lang", "left").select(
        "lang", "source", F.coalesce("v", zero).alias("v"), (F.coalesce("n", zero) + 5 * F.coalesce("v", zero)).alias("d"),
        (F.coalesce("all_n", zero) + 5 * F.coalesce("v", zero)).alias("d_all"),
    )
    stats = materialize(stats.withColumn("b", F.coalesce(share(zero, F.col("d")), zero)), "groups")
    scored = posts.join(stats, ["lang", "source"]).select(
        "lang", "term", "source", "b", share(F.col("n"), F.col("d")).alias("p"), share(F.col("all"), F.col("d_all")).alias("q")
    )
    scored = materialize(scored, "shares")

    other = stats.select("lang", F.col("source").alias("item"), F.col("b").alias("b2"))
    pairs = stats.select("lang", "source", "b", "v").join(other, "lang").where("source <> item")
    alone = (
        scored.groupBy("lang", "source", "b", "p").agg(F.count("*").alias("times")).join(other, "lang").where("source <> item")
        .groupBy("lang", "source", "item").agg(F.sum(F.expr("times * (abs(p - b2) - abs(b - b2))")).alias("value"))
    )
    both = scored.select("lang", "term", "source", "p", "b").repartition("lang", "term").sortWithinPartitions("lang", "term")
    both = both.mapInArrow(_correct, "lang string, source string, item string, value long")
    parts = (
        pairs.select("lang", "source", "item", F.expr("v * abs(b - b2)").alias("value"))
        .unionByName(alone)
        .unionByName(alone.select("lang", F.col("item").alias("source"), F.col("source").alias("item"), "value"))
        .unionByName(both)
    )
    far = parts.groupBy("lang", "source", "item").agg(F.sum("value").alias("value")).withColumn("part", F.lit("pair"))
    used = scored.where("p > q").select("lang", "source", F.col("term").alias("item"), F.expr("p - q").alias("value"), F.lit("term").alias("part"))
    window = Window.partitionBy("lang", "source", "part").orderBy(F.desc("value"), "item")
    columns = ["lang", "source", "part", "item", "value", F.row_number().over(window).alias("rank")]
    return far.select(columns).unionByName(used.select(columns).where(F.col("rank") <= top))
