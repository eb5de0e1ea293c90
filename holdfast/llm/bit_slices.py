"""Exact top-k by inner product over a bit-sliced index.

Candidates are dealt into tiles by a hash of their id. In a tile every quantised attribute is stored as bit slices,
one bitmap over the rows per binary digit; the lowest digits are left out. For a query, the slices are added by
carry-save bitmap arithmetic, shifted by the binary digits of the query's own attribute (complemented where that is
negative), which gives the digits of every row's coarse score as bitmaps again. Going from the most significant
slice downward finds the k-th best coarse score; every row that the omitted digits could lift to it is a boundary
row, and boundary rows are resolved exactly. Each tile returns at most k rows per query, so merging is a small rank.

Queries and candidates meet as tiles of bounded size on both sides; nothing is broadcast or gathered whole.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

LIMIT = 1 << 31


def quantise(column: pa.ChunkedArray, scale: int, width: int | None = None) -> tuple[np.ndarray, np.ndarray]:
    """floor(scale * x) of every vector, and which vectors are whole: neither null nor holding nulls or non-finite values.

    Shorter vectors are filled up with zeros to ``width`` (the longest, if not given), longer ones cut there.
    """
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    if column.null_count:
        column = pa.array(column.to_pylist(), column.type)  # so that null rows hold no hidden values
    lengths = np.diff(column.offsets.to_numpy())
    flat = column.flatten().cast(pa.float64()).to_numpy(zero_copy_only=False)
    owner = np.repeat(np.arange(len(lengths)), lengths)
    good = np.ones(len(lengths), bool)
    good[owner[~np.isfinite(flat)]] = False
    if column.null_count:
        good &= column.is_valid().to_numpy(zero_copy_only=False)
    width = int(lengths.max(initial=0)) if width is None else width
    at = np.arange(len(flat)) - np.repeat(np.cumsum(lengths) - lengths, lengths)
    out = np.zeros((len(lengths), width), np.int64)
    use = (at < width) & good[owner]
    out[owner[use], at[use]] = np.clip(np.floor(scale * flat[use]), -LIMIT, LIMIT - 1).astype(np.int64)
    return out, good


class SlicedTile:
    """Bit slices of the rows of one tile; rows are in ascending order of their ids."""

    def __init__(self, ids: np.ndarray, values: np.ndarray, omitted: int = 1):
        order = np.argsort(ids, kind="stable")
        self.ids, self.values, self.omitted = ids[order], values[order], omitted
        n, self.width = values.shape
        coarse = (self.values - self.values.min(initial=0)) >> omitted
        self.digits = max(1, int(coarse.max(initial=0)).bit_length())
        self.words = (n + 63) // 64
        bits = np.zeros((self.width, self.digits, self.words * 64), np.uint8)
        for b in range(self.digits):
            bits[:, b, :n] = ((coarse >> b) & 1).T
        plain = np.packbits(bits, axis=2, bitorder="little").view(np.uint64)
        self.slices = np.stack([plain, ~plain])  # by sign of the query's attribute
        everyone = np.zeros(self.words * 64, np.uint8)
        everyone[:n] = 1
        self.everyone = np.packbits(everyone, bitorder="little").view(np.uint64)

    def scores(self, query: np.ndarray) -> list[np.ndarray]:
        """Bitmaps of the binary digits of the coarse scores, least significant first."""
        size, sign = np.abs(query), (query < 0).astype(np.int64)
        digits = int(size.max(initial=0)).bit_length()
        levels: list[list[np.ndarray]] = [[] for _ in range(digits + self.digits + 70)]
        for j in range(digits):
            dims = np.flatnonzero((size >> j) & 1)
            for b in range(self.digits):
                levels[j + b].append(self.slices[sign[dims], dims, b])
        out = []
        for p, parts in enumerate(levels):
            if not parts:
                if p >= digits + self.digits and not any(levels[p:]):
                    break
                out.append(np.zeros(self.words, np.uint64))
                continue
            stack = np.concatenate(parts)
            while len(stack) > 1:
                if len(stack) == 2:
                    carry, stack = stack[:1] & stack[1:], stack[:1] ^ stack[1:]
                else:
                    k = len(stack) // 3
                    a, b, c = stack[:k], stack[k : 2 * k], stack[2 * k : 3 * k]
                    either = a ^ b
                    carry, stack = (a & b) | (c & either), np.concatenate((either ^ c, stack[3 * k :]))
                levels[p + 1].append(carry)
            out.append(stack[0])
        return out

    def top(self, query_id: int, query: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
        """Ids and exact scores of the k best rows but those of the query's own id; ties go to the smaller id."""
        alive = self.everyone.copy()
        for i in range(*np.searchsorted(self.ids, [query_id, query_id + 1])):
            alive[i >> 6] &= ~np.uint64(1 << (i & 63))
        count = lambda bits: int(np.bitwise_count(bits).sum())
        if count(alive) > k:
            digits = self.scores(query)
            sure, open_, bound = np.zeros_like(alive), alive, 0
            for p in range(len(digits) - 1, -1, -1):
                upper = open_ & digits[p]
                if count(sure | upper) >= k:
                    open_, bound = upper, bound | (1 << p)
                else:
                    sure, open_ = sure | upper, open_ & ~digits[p]
            # The k-th best coarse score is ``bound``; the omitted digits change a score by less than this:
            bound -= ((((1 << self.omitted) - 1) * int(np.abs(query).sum())) >> self.omitted) + 1
            if bound > 0:
                more, equal = np.zeros_like(alive), alive
                for p in range(len(digits) - 1, -1, -1):
                    if bound >> p & 1:
                        equal = equal & digits[p]
                    else:
                        more, equal = more | (equal & digits[p]), equal & ~digits[p]
                alive = more | equal
        rows = np.flatnonzero(np.unpackbits(alive.view(np.uint8), bitorder="little"))
        exact = self.values[rows] @ query
        best = np.lexsort((self.ids[rows], -exact))[:k]
        return self.ids[rows][best], exact[best]


def top_k(
    vectors: DataFrame, is_query: Column, k: int = 5, scale: int = 256, rows: int = 8192, queries: int = 1024,
    id_col: str = "vec_id", vector_col: str = "embedding",
) -> DataFrame:
    """(query_id, rank, vec_id, score): the k rows of highest inner product for every query row, itself left out.

    ``is_query`` is a condition on ``vec_id``. Attributes are floor(scale * x), held within 32 bits; scores are
    64-bit. A vector that is null, or holds a null or non-finite value, and a row without an id take no part. Vectors
    of different length are compared over the common part. Rows of the query's own id are never its results; equal
    query rows count once, repeated candidates stay. An empty table gives no rows. ``rows`` and ``queries`` bound a tile.
    """
    all_rows = vectors.select(vectors[id_col].cast("long").alias("vec_id"), vectors[vector_col].cast("array<double>").alias("v"))
    all_rows = all_rows.filter("vec_id IS NOT NULL AND v IS NOT NULL")
    asked = all_rows.filter(is_query)
    n, m = all_rows.agg(F.count(F.lit(1)), F.count_if(is_query)).first()
    tiles, query_tiles = max(1, -(-n // rows)), max(1, -(-m // queries))
    tile = F.pmod(F.xxhash64("vec_id"), F.lit(tiles).cast("long"))
    query_tile = F.pmod(F.xxhash64("vec_id", F.lit(1)), F.lit(query_tiles).cast("long"))
    left = all_rows.select(tile.alias("t"), F.explode(F.sequence(F.lit(0).cast("long"), F.lit(query_tiles - 1).cast("long"))).alias("s"), "vec_id", "v")
    right = asked.select(F.explode(F.sequence(F.lit(0).cast("long"), F.lit(tiles - 1).cast("long"))).alias("t"), query_tile.alias("s"), "vec_id", "v")

    def search(rows_in: pa.Table, asked_in: pa.Table) -> pa.Table:
        values, good = quantise(rows_in.column("v"), scale)
        ids = rows_in.column("vec_id").to_numpy()
        found: list[tuple[int, int, int]] = []
        if good.any() and asked_in.num_rows:
            index = SlicedTile(ids[good], values[good])
            wanted, whole = quantise(asked_in.column("v"), scale, index.width)
            own = asked_in.column("vec_id").to_numpy()
            pairs = {(int(own[i]), wanted[i].tobytes()): i for i in np.flatnonzero(whole).tolist()}
            for i in pairs.values():
                got, score = index.top(int(own[i]), wanted[i], k)
                found += [(int(own[i]), a, b) for a, b in zip(got.tolist(), score.tolist(), strict=True)]
        columns = [pa.array([r[c] for r in found], pa.int64()) for c in range(3)]
        return pa.table(columns, names=["query_id", "vec_id", "score"])

    best = left.groupBy("t", "s").cogroup(right.groupBy("t", "s")).applyInArrow(search, "query_id long, vec_id long, score long")
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    ranked = best.select("query_id", F.row_number().over(order).cast("int").alias("rank"), "vec_id", "score")
    return ranked.filter(F.col("rank") <= k)
