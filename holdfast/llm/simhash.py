"""SimHash near-duplicates through a segment-popcount embedding.

A fingerprint is cut into segments of two bits; the bit counts of the segments are its point in a grid. The Manhattan
distance of two points never exceeds the Hamming distance of the fingerprints. Points are filed under cells, each
given by the counts in some of the segments, and points that share a cell are compared, first by Manhattan distance,
then by exact Hamming distance.

``EXACT`` finds every pair of 64-bit fingerprints at a distance of at most 4: of six groups of segments, such points
agree in at least two whole ones, so the 15 pairs of groups are the cells.

Copies meet first: every distinct fingerprint is one point. A cell with more points than ``block`` is cut into
blocks, and every pair of its blocks is compared in a task of its own. What a comparison hands on is a spanning
forest of the links it found, at most one row per point, so dense groups do not grow as their square.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from holdfast.llm.common import as_bytes, id_and_text, slices
from holdfast.llm.components import connected_components
from holdfast.session import materialize

SEGMENTS, BITS, SEED = 32, 2, 42
_LOW = 0x5555555555555555
_LAST = (1 << 63) - 1
__all__ = ["EXACT", "Scheme", "fingerprint", "keep_first", "near_duplicates"]


def shingle_hashes(text: bytes | None, width: int) -> np.ndarray:
    """Hashes of the runs of ``width`` words in their order; a shorter text is one run, one without words has none."""
    words = (text or b"").lower().split()
    if not words:
        return np.array([], "<u8")
    joined = b" ".join(words)
    if len(words) <= width:
        return np.array([xxhash.xxh64_intdigest(joined, SEED)], "<u8")
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1)
    starts = np.concatenate(([0], ends[:-1]))[: len(words) - width + 1].tolist()
    digest = xxhash.xxh64_intdigest
    return np.array([digest(joined[a:b], SEED) for a, b in zip(starts, (ends[width - 1 :] - 1).tolist(), strict=True)], "<u8")


def _signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


@dataclass(frozen=True)
class Scheme:
    """Words in a shingle, 64-bit lanes of a fingerprint, bits that linked ones may differ in; the masks of the cells."""

    width: int
    lanes: int
    distance: int
    masks: tuple[tuple[int, ...], ...]


def grouped_masks(distance: int) -> tuple[tuple[int, ...], ...]:
    """Every pair of ``distance + 2`` groups of segments of one lane."""
    groups = distance + 2
    edges = [round(i * SEGMENTS / groups) * BITS for i in range(groups + 1)]
    parts = [(1 << b) - (1 << a) for a, b in zip(edges, edges[1:], strict=False)]
    return tuple((a | b,) for a, b in combinations(parts, 2))


EXACT = Scheme(4, 1, 4, grouped_masks(4))


def fingerprint(text: bytes | None, width: int, lanes: int = 1) -> list[int]:
    """The lanes of the fingerprint as unsigned numbers; zero for a text without words."""
    h = shingle_hashes(text, width)
    if not len(h):
        return [0] * lanes
    out = []
    for lane in range(lanes):
        if lane:  # further lanes mix the hash anew
            h = (h ^ (h >> np.uint64(31))) * np.uint64(0x9E3779B97F4A7C15)
            h = (h ^ (h >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
            h ^= h >> np.uint64(32)
        bits = np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        most = bits.sum(0, dtype=np.int64) * 2 > len(h)
        out.append(int(np.packbits(most, bitorder="little").view("<u8")[0]))
    return out


def fingerprints(docs: DataFrame, scheme: Scheme) -> DataFrame:
    """(doc_id, mark, node, f0, ...): the lanes as signed longs, a number for the fingerprint, and one for the text."""
    lanes = [f"f{i}" for i in range(scheme.lanes)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            found = np.array([fingerprint(t, scheme.width, scheme.lanes) for t in as_bytes(batch.column("text"))], np.uint64).view(np.int64)
            columns = [pa.array(found[:, i]) for i in range(scheme.lanes)]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("mark"), *columns], ["doc_id", "mark", *lanes])

    marked = id_and_text(docs).select("doc_id", F.xxhash64("text").alias("mark"), "text")
    rows = marked.mapInArrow(run, "doc_id long, mark long, " + ", ".join(f"{c} long" for c in lanes))
    return rows.withColumn("node", F.col("f0") if scheme.lanes == 1 else F.xxhash64(*lanes))


def embed(fp: np.ndarray) -> np.ndarray:
    """Bit counts of the segments, each in unary in its own two bits: an xor then counts Manhattan distance."""
    low = np.uint64(_LOW)
    a, b = fp & low, (fp >> np.uint64(1)) & low
    return (a | b) | ((a & b) << np.uint64(1))


def forest(lanes: list[np.ndarray], run_end: np.ndarray, most: int) -> tuple[np.ndarray, np.ndarray]:
    """Compare every point with those after it up to ``run_end``; (point, smallest point linked to it) of the linked ones."""
    points = [embed(f) for f in lanes]
    n = len(run_end)
    left, right = [], []
    here = np.arange(n)
    step = 1

    def near(words: list[np.ndarray], i: np.ndarray) -> np.ndarray:
        apart = np.bitwise_count(words[0][i] ^ words[0][i + step]).astype(np.int64)
        for w in words[1:]:
            apart += np.bitwise_count(w[i] ^ w[i + step])
        return i[apart <= most]

    while len(here := here[run_end[here] > here + step]):
        linked = near(lanes, near(points, here))
        left.append(linked)
        right.append(linked + step)
        step += 1
    if not left:
        return here, here
    a, b = np.concatenate(left), np.concatenate(right)
    label = np.arange(n)
    while True:
        low = np.minimum(label[a], label[b])
        new = label.copy()
        np.minimum.at(new, a, low)
        np.minimum.at(new, b, low)
        new = new[new]
        if np.array_equal(new, label):
            break
        label = new
    child = np.flatnonzero(label != np.arange(n))
    return child, label[child]


def links(points: DataFrame, scheme: Scheme, block: int = 1024) -> DataFrame:
    """Edges (a, b) between nodes of ``points`` (node, f0, ...) that connect what the links found in the cells connect."""
    lanes = [f"f{i}" for i in range(scheme.lanes)]
    low = F.lit(_LOW)

    def point(lane: str):  # noqa: ANN202
        x, y = F.col(lane).bitwiseAND(low), F.shiftrightunsigned(F.col(lane), 1).bitwiseAND(low)
        return x.bitwiseOR(y).bitwiseOR(F.shiftleft(x.bitwiseAND(y), 1))

    def cell(masks: tuple[int, ...]):  # noqa: ANN202
        parts = [F.col(f"p{i}").bitwiseAND(F.lit(_signed(m))) for i, m in enumerate(masks)]
        return parts[0] if len(parts) == 1 else F.xxhash64(*parts)

    def linked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Rows (cell table, cell, block pair, node, lanes) arrive sorted; a cell's rows may span batches."""
        held: list[np.ndarray] = []

        def compare(columns: list[np.ndarray]) -> pa.RecordBatch:
            keys, node, prints = columns[:4], columns[4], [c.view(np.uint64) for c in columns[5:]]
            new = np.concatenate(([True], np.any([k[1:] != k[:-1] for k in keys], axis=0)))
            start = np.flatnonzero(new)
            end = np.repeat(np.append(start[1:], len(node)), np.diff(np.append(start, len(node))))
            child, root = forest(prints, end, scheme.distance)
            return pa.RecordBatch.from_arrays([pa.array(node[child]), pa.array(node[root])], ["a", "b"])

        for batch in batches:
            if batch.num_rows == 0:
                continue
            columns = [c.to_numpy(zero_copy_only=False) for c in batch.columns]
            if held:
                columns = [np.concatenate(x) for x in zip(held, columns, strict=True)]
            same = np.all([c == c[-1] for c in columns[:4]], axis=0)
            cut = len(same) - int(np.argmin(same[::-1])) if not same.all() else 0
            held = [c[cut:] for c in columns]
            if cut:
                yield compare([c[:cut] for c in columns])
        if held:
            yield compare(held)

    cells = F.array(*[F.struct(F.lit(t).alias("t"), cell(m).alias("cell")) for t, m in enumerate(scheme.masks)])
    embedded = points.select("node", *lanes, *[point(c).alias(f"p{i}") for i, c in enumerate(lanes)])
    filed = embedded.select("node", *lanes, F.explode(cells).alias("c")).select("c.t", "c.cell", "node", *lanes)
    crowded = filed.groupBy("t", "cell").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > block)
    blocks = F.coalesce(F.ceil(F.col("n") / block), F.lit(1))
    own = F.pmod(F.xxhash64("node", F.lit(7)), blocks).cast("int")
    other = F.explode(F.sequence(F.lit(0), (blocks - 1).cast("int")))
    dealt = filed.join(crowded, ["t", "cell"], "left").select("t", "cell", "node", *lanes, own.alias("own"), other.alias("other"))
    dealt = dealt.select("t", "cell", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"), "node", *lanes)
    keys = ["t", "cell", "i", "j"]
    return dealt.repartition(*keys).sortWithinPartitions(*keys).mapInArrow(linked, "a long, b long")


def grouped(docs: DataFrame, scheme: Scheme, block: int = 1024) -> tuple[DataFrame, DataFrame]:
    """Stored tables: the fingerprints of all rows, and (node, first, first_mark): of each node's group, the smallest
    document (a null id counts as the largest) and the number of its text."""
    marked = materialize(fingerprints(docs, scheme), "fingerprints")
    lanes = [f"f{i}" for i in range(scheme.lanes)]
    order = F.struct(F.coalesce("doc_id", F.lit(_LAST)).alias("doc"), "mark")
    points = materialize(marked.groupBy("node").agg(*[F.first(c).alias(c) for c in lanes], F.min(order).alias("least")), "points")
    roots = connected_components(links(points.select("node", *lanes), scheme, block))
    member = points.join(roots, "node", "left").select("node", F.coalesce("root", "node").alias("root"), "least")
    member = materialize(member, "members")
    least = materialize(member.groupBy("root").agg(F.min("least").alias("least")), "groups")
    return marked, materialize(member.join(least.withColumnRenamed("least", "head"), "root").select("node", "head"), "classes")


def near_duplicates(docs: DataFrame, scheme: Scheme = EXACT, block: int = 1024) -> DataFrame:
    """One row per row of ``docs``: doc_id, fingerprint (hex), component_id.

    component_id is the smallest doc_id that links reach. Null and blank texts share fingerprint zero and link like
    any other. Repeated rows stay; a null doc_id names a component only if all its members are null. An empty table
    gives an empty result.
    """
    marked, classes = grouped(docs, scheme, block)
    digits = F.concat(*[F.lower(F.lpad(F.hex(f"f{i}"), 16, "0")) for i in range(scheme.lanes)])
    return marked.join(classes, "node").select("doc_id", digits.alias("fingerprint"), F.nullif("head.doc", F.lit(_LAST)).alias("component_id"))


def keep_first(docs: DataFrame, scheme: Scheme = EXACT, block: int = 1024) -> DataFrame:
    """``docs`` with all its columns, and of each group of linked fingerprints one row: that of the smallest id (a null id
    counts as the largest), which of equal ids has the smaller text number. Rows repeated whole count as one. Null and
    blank texts are one group with what links to fingerprint zero. An empty table gives an empty result.
    """
    _, classes = grouped(docs, scheme, block)
    heads = classes.select("head.doc", "head.mark").distinct()
    doc, mark = F.coalesce(F.col("doc_id").cast("long"), F.lit(_LAST)), F.xxhash64(F.col("text").cast("string"))
    tagged = docs.select(F.struct("*").alias("row"), doc.alias("doc"), mark.alias("mark"))
    return tagged.join(heads, ["doc", "mark"], "left_semi").dropDuplicates(["doc", "mark"]).select("row.*")
