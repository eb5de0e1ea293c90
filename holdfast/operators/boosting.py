"""Boosted regression trees from histograms of binned rows, one job for a level of all ensembles that grow side by side.

Trees are those of Spark ML's booster (variance gain, feature subsets by seed and place, log loss), so they become its model.
Rows are binned once for all ensembles and stay with their task; margins stay beside them, so boosting goes on tree by tree
until it stops, a finished tree is measured by the job that begins the next, and what returns follows bins and nodes, never rows.
"""

from __future__ import annotations

import math
import pickle
from collections.abc import Callable, Generator, Iterable, Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import RDD, StorageLevel
from pyspark.serializers import BatchedSerializer, CPickleSerializer
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Rows in the sample that candidate thresholds come from, as in Spark ML (the square of the bins, if larger).
SAMPLE_ROWS = 10_000
#: Finished trees after which the margins are checkpointed.
CHECKPOINT_TREES = 10
#: Cells of a histogram over several features at once, and rows per cell that make one worth while.
JOINT_CELLS, ROWS_PER_CELL = 4096, 64
#: Rows of a task up to which features are counted one by one, which adds up in Spark ML's order and decides ties as it does.
SINGLE_ROWS = 50_000
_MASK = (1 << 64) - 1


@dataclass(frozen=True)
class Space:
    """The binned features: ascending ``thresholds`` of a continuous one, the number of levels of a categorical one."""

    thresholds: tuple[np.ndarray | None, ...]
    levels: tuple[int, ...]

    @property
    def bins(self) -> np.ndarray:
        return np.array([n if t is None else len(t) + 1 for t, n in zip(self.thresholds, self.levels, strict=True)])

    @property
    def kind(self) -> np.dtype:
        return np.dtype(np.uint8 if self.bins.max(initial=1) <= 256 else np.uint16)

    def binned(self, values: np.ndarray) -> np.ndarray:
        """(rows, features): a value on a threshold lies below it."""
        out = np.empty(values.shape, self.kind)
        for i, t in enumerate(self.thresholds):
            out[:, i] = values[:, i] if t is None else np.searchsorted(t, values[:, i], "left")
        return out


@dataclass(frozen=True)
class Plan:
    """What one ensemble is grown with; the seed of a tree is ``seed`` and its place."""

    trees: int
    rate: float
    depth: int
    least: int
    subset: int
    seed: int
    patience: int


@dataclass(frozen=True)
class Tree:
    """Nodes from the root on. ``feature`` is -1 at a leaf, ``left`` the bins that go left, ``stats`` count, sum and sum of squares."""

    feature: np.ndarray
    left: np.ndarray
    children: np.ndarray
    stats: np.ndarray
    impurity: np.ndarray
    gain: np.ndarray

    @property
    def depth(self) -> int:
        """Steps from the root to the deepest leaf; a child comes after its parent."""
        depths = np.zeros(len(self.feature), int)
        for node in np.flatnonzero(self.feature >= 0):
            depths[self.children[node]] = depths[node] + 1
        return int(depths.max())

    @property
    def value(self) -> np.ndarray:
        return self.stats[:, 1] / np.where(self.stats[:, 0] == 0, 1, self.stats[:, 0])


def thresholds(values: np.ndarray, bins: int) -> np.ndarray:
    """Candidate thresholds of a continuous feature: midpoints between values, at about equal counts where values are many."""
    distinct, counts = np.unique(values, return_counts=True)
    middles = (distinct[:-1] + distinct[1:]) / 2.0
    if len(middles) < bins:
        return middles
    stride = len(values) / bins
    found, seen, target = [], float(counts[0]), stride
    for i, count in enumerate(counts[1:].tolist()):
        before, seen = seen, seen + count
        if abs(before - target) < abs(seen - target):
            found.append(middles[i])
            target += stride
    return np.array(found)


# --- Feature subsets ---------------------------------------------------------------------------------


def _rotl(x: int, r: int) -> int:
    return (x << r | x >> (32 - r)) & 0xFFFFFFFF


def _murmur(data: bytes, seed: int) -> int:
    """MurmurHash3 of whole four-byte words, as Spark seeds its generator with."""
    h = seed
    for i in range(0, len(data), 4):
        k = int.from_bytes(data[i : i + 4], "little") * 0xCC9E2D51 & 0xFFFFFFFF
        h = (_rotl(h ^ _rotl(k, 15) * 0x1B873593 & 0xFFFFFFFF, 13) * 5 + 0xE6546B64) & 0xFFFFFFFF
    h ^= len(data)
    h = (h ^ h >> 16) * 0x85EBCA6B & 0xFFFFFFFF
    h = (h ^ h >> 13) * 0xC2B2AE35 & 0xFFFFFFFF
    return h ^ h >> 16


class Subsets:
    """Features drawn for one node after another, as Spark ML draws them for a tree of this seed."""

    def __init__(self, seed: int, features: int, size: int) -> None:
        self._state, self.features, self.size = (seed ^ 0x5DEECE66D) & ((1 << 48) - 1), features, size

    def _next(self) -> int:
        self._state = (self._state * 0x5DEECE66D + 0xB) & ((1 << 48) - 1)
        value = self._state >> 16
        return value - (1 << 32) if value >= 1 << 31 else value

    def draw(self) -> list[int]:
        if self.size >= self.features:
            return list(range(self.features))
        data = (((self._next() << 32) + self._next()) & _MASK).to_bytes(8, "big")
        low = _murmur(data, 0x3C074A61)
        x = _murmur(data, low) << 32 | low
        chosen = list(range(self.size))
        for item in range(self.size, self.features):
            words = []
            for bits in (26, 27):
                x ^= x << 21 & _MASK
                x ^= x >> 35
                x ^= x << 4 & _MASK
                words.append(x & ((1 << bits) - 1))
            place = int(((words[0] << 27) + words[1]) * 2.0**-53 * (item + 1))
            if place < self.size:
                chosen[place] = item
        return chosen


# --- One task's rows ---------------------------------------------------------------------------------


class Rows:
    """The rows of a task: those of training first, then those that are held out.

    Features whose cells are few are counted together, so a row is a code for each group of features. Labels are 1, 0, or -1 for none.
    """

    def __init__(self, space: Space, bins: np.ndarray, labels: np.ndarray, train: np.ndarray) -> None:
        order = np.argsort(~train, kind="stable")
        self.space, self.n, self.train = space, len(order), int(train.sum())
        self.labels = np.where(labels == 1, 1, np.where(labels == 0, 0, -1)).astype(np.int8)[order]
        self.groups = self._grouped(min(JOINT_CELLS, self.train // ROWS_PER_CELL) if self.train > SINGLE_ROWS else 0)
        self.codes = np.empty((len(self.groups), self.n), np.uint16 if any(len(g) > 1 for g in self.groups) else space.kind)
        for features, code in zip(self.groups, self.codes, strict=True):
            code[:] = bins[:, features[0]][order]
            for f in features[1:]:
                code *= code.dtype.type(space.bins[f])
                code += bins[:, f][order]

    def _grouped(self, cells: int) -> list[list[int]]:
        bins, groups = self.space.bins.tolist(), []
        for f in sorted(range(len(bins)), key=lambda f: -bins[f]):
            fits = [g for g in groups if math.prod(bins[x] for x in g) * bins[f] <= cells]
            max(fits, key=lambda g: math.prod(bins[x] for x in g)).append(f) if fits else groups.append([f])
        return groups

    def histograms(self, slots: np.ndarray | None, nodes: int, g: np.ndarray) -> np.ndarray:
        """(count, sum, sum of squares) of g by node and bin of every feature; a slot below 0 is no node."""
        kept = None
        if slots is not None and len(slots) and slots.min() < 0:
            kept = np.flatnonzero(slots >= 0)
            slots, g = slots[kept], g[kept]
        squares, width = g * g, int(self.space.bins.max())
        out = np.zeros((3, nodes, len(self.space.bins), width))
        for features, code in zip(self.groups, self.codes[:, : self.train], strict=True):
            sizes = [int(self.space.bins[f]) for f in features]
            cells = math.prod(sizes)
            at = (code if kept is None else code[kept]).astype(np.int64)
            if slots is not None:
                at += slots * np.int64(cells)
            for k, weights in enumerate((None, g, squares)):
                found = np.bincount(at, weights, nodes * cells).reshape(nodes, *sizes)
                for i, f in enumerate(features):
                    others = tuple(j + 1 for j in range(len(features)) if j != i)
                    out[k, :, f, : sizes[i]] = found.sum(axis=others) if others else found
        return out

    def placed(self, tree: Tree, rows: int) -> np.ndarray:
        """The leaf of each of the first rows."""
        at, each, codes = np.zeros(rows, np.int64), np.arange(rows), self.codes.reshape(-1)
        inner = np.flatnonzero(tree.feature >= 0)
        group, left = np.zeros(len(tree.feature), np.int64), np.zeros((len(tree.feature), 1 if not len(inner) else self._cells()), bool)
        for node in inner:
            f = int(tree.feature[node])
            group[node], bins = self._decoded(f)
            left[node, : len(bins)] = tree.left[node][bins]
        stays = tree.feature < 0
        for _ in range(tree.depth):
            goes = left[at, codes[group[at] * self.n + each]]
            at = np.where(stays[at], at, tree.children[at, np.where(goes, 0, 1)])
        return at

    def _cells(self) -> int:
        """Codes that a group can have, padding included; a leaf reads a code of the first group and stays."""
        return max(math.prod(self.space.bins[f] for f in g) for g in self.groups)

    def _decoded(self, f: int) -> tuple[int, np.ndarray]:
        """The group of a feature, and its bin for each code."""
        i = next(i for i, g in enumerate(self.groups) if f in g)
        sizes = [int(self.space.bins[x]) for x in self.groups[i]]
        k = self.groups[i].index(f)
        return i, np.arange(math.prod(sizes)) // math.prod(sizes[k + 1 :]) % sizes[k]


@dataclass(frozen=True)
class Ask:
    """What an ensemble asks of every task: to add the finished tree ``last`` to the margins and tally them, and the histograms of
    the ``nodes`` of the tree that grows."""

    fit: int
    last: Tree | None
    weight: float
    tree: Tree | None
    nodes: list[int]


Asking = Generator[Ask, list, tuple]


def _spread(stats: np.ndarray) -> np.ndarray:
    """Variance of (..., count, sum, sum of squares) along the first axis; 0 without rows."""
    count = np.where(stats[0] == 0, 1, stats[0])
    return np.where(stats[0] == 0, 0.0, (stats[2] - stats[1] * stats[1] / count) / count)


def _best(space: Space, sums: np.ndarray, subsets: Sequence[list[int]], known: np.ndarray | None, least: int) -> list[tuple | None]:
    """For each node (feature, bins that go left, gain, impurity, left and right stats); None where no split is allowed.

    Levels of a categorical feature are ordered by their mean. Of equal gains the first counts: the subset's order, then bins.
    """
    bins, width = space.bins, sums.shape[-1]
    mean = np.where(sums[0] == 0, np.finfo(float).max, sums[1] / np.where(sums[0] == 0, 1, sums[0]))
    place = np.broadcast_to(np.arange(width), mean.shape)
    levels = np.array([t is None for t in space.thresholds])[None, :, None]
    rank = np.where(place >= bins[:, None], np.inf, np.where(levels, mean, place.astype(float)))
    order = np.argsort(rank, axis=-1, kind="stable")
    run = np.cumsum(np.take_along_axis(sums, order[None], -1), axis=-1)
    ends = np.broadcast_to((bins - 1)[None, None, :, None], (*run.shape[:3], 1))
    left, right = run, np.take_along_axis(run, ends, -1) - run
    allowed = (place < bins[:, None] - 1) & (left[0] >= least) & (right[0] >= least)
    out: list[tuple | None] = []
    if known is None:
        whole = left[:, :, :, 0] + right[:, :, :, 0]
        firsts = [next((f for f in subset if bins[f] > 1), 0) for subset in subsets]
        known = np.array([_spread(whole[:, i, f]) for i, f in enumerate(firsts)])
    total = left[0] + right[0]
    total = np.where(total == 0, 1, total)
    gain = known[:, None, None] - left[0] / total * _spread(left) - right[0] / total * _spread(right)
    gain = np.where(allowed & (gain >= 0), gain, -1.0)
    cut = gain.argmax(-1)
    top = np.take_along_axis(gain, cut[..., None], -1)[..., 0]
    for i, subset in enumerate(subsets):
        f = subset[int(np.argmax(top[i, subset]))]
        if top[i, f] <= 0:
            out.append(None)
            continue
        s = int(cut[i, f])
        goes = np.zeros(width, bool)
        goes[order[i, f, : s + 1]] = True
        out.append((f, goes, top[i, f], known[i], left[:, i, f, s], right[:, i, f, s]))
    return out


def _tree(space: Space, plan: Plan, seed: int) -> Generator[tuple[Tree, list[int]], list, Tree]:
    """Grows one tree, a level at a time: asks for histograms of the nodes of the tree so far, and is told those of all tasks."""
    bins, width = space.bins, int(space.bins.max())
    real = np.arange(width) < bins[:, None]
    subsets = Subsets(seed, len(bins), plan.subset)
    feature, left, children, stats, impurity, gain = [-1], [np.zeros(width, bool)], [(0, 0)], [np.zeros(3)], [0.0], [0.0]
    level, depth = [0], 0

    def tree() -> Tree:
        return Tree(*map(np.array, (feature, left, children, stats, impurity, gain)))

    while level:
        parts = yield tree(), level
        sums = np.zeros((3, len(level), *real.shape))
        sums[0][:, real], sums[1:, :, real] = sum(p[0].astype(float) for p in parts), sum(p[1] for p in parts)
        drawn = [subsets.draw() for _ in level]
        if depth == 0:
            stats[0] = sums[:, 0, 0].sum(-1)
        known = None if depth == 0 else np.array([impurity[i] for i in level])
        after = []
        for node, found in zip(level, _best(space, sums, drawn, known, plan.least), strict=True):
            if found is None:
                continue
            feature[node], left[node], gain[node], impurity[node], *sides = found
            children[node] = (len(feature), len(feature) + 1)
            for side in sides:
                spread = float(_spread(side))
                if depth + 1 < plan.depth and abs(spread) >= np.finfo(float).eps:
                    after.append(len(feature))
                feature.append(-1), left.append(np.zeros(width, bool)), children.append((0, 0)), stats.append(side), impurity.append(spread), gain.append(0.0)
        if depth == 0 and feature[0] < 0:
            impurity[0] = float(_spread(stats[0]))
        level, depth = after[::-1], depth + 1
    return tree()


def rounded(margins: np.ndarray, digits: int) -> np.ndarray:
    """Margins as whole steps of ``digits`` decimals; halves go away from zero."""
    return np.copysign(np.floor(np.abs(margins) * 10**digits + 0.5), margins).astype(np.int64)


def tally(margins: np.ndarray, labels: np.ndarray, digits: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, float]:
    """(steps, positives, negatives, summed log loss) of a margin; a label that is neither adds to the loss alone, as a 0 does."""
    if not len(margins):
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.int64), 0.0
    step = rounded(margins, digits)
    low = step.min()
    pos, neg = (np.bincount(step[labels == k] - low, minlength=int(step.max() - low) + 1) for k in (1, 0))
    seen = np.flatnonzero(pos + neg)
    x = np.where(labels == 1, -2.0, 2.0) * margins
    return seen + low, pos[seen].astype(np.uint32), neg[seen].astype(np.uint32), float(np.sum(np.maximum(x, 0.0) + np.log1p(np.exp(-np.abs(x)))))


def _metrics(parts: list[tuple]) -> tuple[float, float | None]:
    """(auc, logloss) of the tallies of all tasks."""
    steps, at = np.unique(np.concatenate([p[0] for p in parts]), return_inverse=True)
    pos, neg = (np.bincount(at, np.concatenate([p[k] for p in parts]), len(steps)) for k in (1, 2))
    pairs, rows = pos.sum() * neg.sum(), pos.sum() + neg.sum()
    wins = float(np.sum(pos * (np.cumsum(neg) - neg / 2.0)))
    return float(wins / pairs) if pairs else 0.0, float(sum(p[3] for p in parts) / rows) if rows else None


def patient_stop(values: Sequence[float], patience: int) -> tuple[int, int | None]:
    """(best, stop) of a metric that should rise, counted from 1: the first best iteration up to the stop, and the first
    iteration that comes ``patience`` after the best without a gain; None if there is none yet."""
    best = 0
    for i, value in enumerate(values):
        if value > values[best]:
            best = i
        if i - best >= patience:
            return best + 1, i + 1
    return best + 1, None


def _ensemble(space: Space, plan: Plan, fit: int, held: bool) -> Asking:
    """(trees, metrics of the held-out rows after each): on until these stop to rise, or the ensemble is whole."""
    trees: list[Tree] = []
    metrics: list[tuple[int, float, float | None]] = []
    while True:
        growing, more = _tree(space, plan, plan.seed + len(trees)), len(trees) < plan.trees
        tree, nodes = next(growing)
        told = yield Ask(fit, trees[-1] if trees else None, plan.rate if len(trees) > 1 else 1.0, tree, nodes if more else [])
        if trees and held:
            metrics.append((len(trees), *_metrics([x[0] for x in told])))
            more = more and patient_stop([m[1] for m in metrics], plan.patience)[1] is None
        if not more:
            return trees, metrics
        while True:
            try:
                tree, nodes = growing.send([x[1] for x in told])
            except StopIteration as end:
                trees.append(end.value)
                break
            told = yield Ask(fit, None, 0.0, tree, nodes)


def side_by_side(asking: Sequence[Asking], answers: Callable[[list[Ask]], list[list]], most: int) -> list:
    """What each returns; ``most`` of them ask at a time, and what they ask is answered together."""
    results: list = [None] * len(asking)
    queued, waiting = list(range(len(asking)))[::-1], {}
    while queued or waiting:
        while queued and len(waiting) < most:
            i = queued.pop()
            waiting[i] = next(asking[i])
        told, after = answers(list(waiting.values())), {}
        for k, i in enumerate(waiting):
            try:
                after[i] = asking[i].send([x[k] for x in told])
            except StopIteration as end:
                results[i] = end.value
        waiting = after
    return results


def _answer(asks: Sequence[Ask], digits: int) -> Callable[[tuple], tuple]:
    """From (rows, (margins, _)) of a task to (margins of the ensembles that ask, what each is told)."""
    def run(pair: tuple) -> tuple:
        rows, (margins, _) = pair[0] if isinstance(pair[0], Rows) else pickle.loads(pair[0]), pair[1]
        kept, told = {}, []
        real = np.arange(rows.space.bins.max()) < rows.space.bins[:, None]
        y = np.where(rows.labels[: rows.train] == 1, 1.0, -1.0)
        for ask in asks:
            own, tallied, found = margins.get(ask.fit), None, None
            if ask.last is not None:
                own = (0.0 if own is None else own) + ask.last.value[rows.placed(ask.last, rows.n)] * ask.weight
                tallied = tally(own[rows.train :], rows.labels[rows.train :], digits)
            if ask.nodes:
                g, slots = y if own is None else 4.0 * y / (1.0 + np.exp(2.0 * y * own[: rows.train])), None
                if len(ask.tree.feature) > 1:
                    places = np.full(len(ask.tree.feature), -1)
                    places[ask.nodes] = np.arange(len(ask.nodes))
                    slots = places[rows.placed(ask.tree, rows.train)]
                sums = rows.histograms(slots, len(ask.nodes), g)[:, :, real]
                found = sums[0].astype(np.uint32), sums[1:]
            kept[ask.fit] = own
            told.append((tallied, found))
        return kept, told

    return run


def _singly(rdd: RDD) -> RDD:
    """One object to a batch, which lets two RDDs be zipped as they are stored."""
    return rdd._reserialize(BatchedSerializer(CPickleSerializer(), 1))


class Tasks:
    """Answers what ensembles ask, from stored rows and the margins after the trees that are finished."""

    def __init__(self, packed: DataFrame, digits: int) -> None:
        self.rows = _singly(packed.rdd.map(lambda row: bytes(row[0]))).persist(StorageLevel.MEMORY_AND_DISK)
        self.state = _singly(self.rows.map(lambda _: ({}, None)))
        self.digits, self.steps, self.written = digits, 0, None

    def __call__(self, asks: list[Ask]) -> list[list]:
        after = _singly(self.rows.zip(self.state).map(_answer(asks, self.digits)))
        if all(ask.last is None for ask in asks):
            return after.map(lambda x: x[1]).collect()
        after.persist(StorageLevel.MEMORY_AND_DISK)
        self.steps += 1
        if self.steps % CHECKPOINT_TREES == 0:
            after.checkpoint()
        told = after.map(lambda x: x[1]).collect()
        if self.state.is_cached:
            self.state.unpersist()
        self.state = after
        if after.isCheckpointed():
            self._forget()
            self.written = after.getCheckpointFile()
        return told

    def _forget(self) -> None:
        if self.written:
            context = self.rows.context
            path = context._jvm.org.apache.hadoop.fs.Path(self.written)
            path.getFileSystem(context._jsc.hadoopConfiguration()).delete(path, True)

    def close(self) -> None:
        self._forget()
        self.state.unpersist()
        self.rows.unpersist()


GROWN = "fit BIGINT, grown BINARY"


def _alone(space: Space, plans: Sequence[Plan], held: bool, digits: int) -> Callable[[Iterable[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """From (fit, all rows as one value) to the grown ensembles."""
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for fit, packed in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                rows, margins = pickle.loads(packed), [{}]

                def answers(asks: list[Ask], rows: Rows = rows, margins: list[dict] = margins) -> list[list]:
                    margins[0], told = _answer(asks, digits)((rows, (margins[0], None)))
                    return [told]

                (found,) = side_by_side([_ensemble(space, plans[fit], fit, held)], answers, 1)
                yield pa.RecordBatch.from_arrays([pa.array([fit], pa.int64()), pa.array([pickle.dumps(found)], pa.binary())], names=["fit", "grown"])

    return run


def grow(packed: DataFrame, space: Space, plans: Sequence[Plan], held: bool, most: int, digits: int, small: bool) -> list[tuple]:
    """(trees, metrics) of an ensemble for each plan; ``packed`` has the rows of a task as one value.

    Of ``small`` data, one value, each of ``most`` tasks gets a copy and grows ensembles from start to end.
    """
    if small:
        fits = packed.sparkSession.range(0, len(plans), 1, min(most, len(plans)))
        own = fits.crossJoin(F.broadcast(packed)).mapInArrow(_alone(space, plans, held, digits), GROWN)
        return [pickle.loads(r.grown) for r in sorted(own.collect(), key=lambda r: r.fit)]
    tasks = Tasks(packed, digits)
    try:
        return side_by_side([_ensemble(space, plan, i, held) for i, plan in enumerate(plans)], tasks, most)
    finally:
        tasks.close()


def binner(space: Space) -> Callable[[Iterable[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """From (train, label, features) to the same with the bins of a row as bytes."""
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        width = len(space.levels)
        for batch in batches:
            binned = space.binned(batch.column(2).flatten().to_numpy(zero_copy_only=False).reshape(-1, width))
            size = width * space.kind.itemsize
            ends = pa.py_buffer(np.arange(0, (len(binned) + 1) * size, size, dtype=np.int32)[: len(binned) + 1])
            packed = pa.Array.from_buffers(pa.binary(), len(binned), [None, ends, pa.py_buffer(binned.tobytes())])
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), packed], names=["train", "label", "bins"])

    return run


BINNED = "train BOOLEAN, label DOUBLE, bins BINARY"


def _bytes(column: pa.Array) -> np.ndarray:
    ends = np.frombuffer(column.buffers()[1], np.int32, len(column) + 1, column.offset * 4)
    return np.frombuffer(column.buffers()[2], np.uint8)[ends[0] : ends[-1]] if len(column) else np.zeros(0, np.uint8)


PACKED = "rows BINARY"


def packer(space: Space) -> Callable[[Iterable[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """From the binned rows of a task to one value with all of them."""
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bins, labels, train = [np.zeros(0, np.uint8)], [np.zeros(0)], [np.zeros(0, bool)]
        for batch in batches:
            bins.append(_bytes(batch.column(2)).copy())
            labels.append(batch.column(1).to_numpy(zero_copy_only=False).astype(float))
            train.append(batch.column(0).to_numpy(zero_copy_only=False).astype(bool))
        held = np.concatenate(bins).view(space.kind).reshape(-1, len(space.levels))
        bins.clear()
        packed = pickle.dumps(Rows(space, held, np.concatenate(labels), np.concatenate(train)), protocol=5)
        yield pa.RecordBatch.from_arrays([pa.array([packed], pa.binary())], names=["rows"])

    return run


TALLIED = "dataset STRING, iteration INT, step BIGINT, pos BIGINT, neg BIGINT, loss DOUBLE"
#: Rows that are measured at a time: more share more steps and take more memory.
MEASURED_ROWS = 1 << 18


def measurer(space: Space, trees: Sequence[Tree], rate: float, digits: int) -> Callable[[Iterable[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """From (dataset, label, features) to tallies of the margins after each tree; the loss is in the first row of each."""
    def measured(name: str, bins: np.ndarray, labels: np.ndarray) -> Iterator[pa.RecordBatch]:
        rows = Rows(space, bins, labels, np.zeros(len(labels), bool))
        margins = np.zeros(rows.n)
        for i, tree in enumerate(trees):
            margins += tree.value[rows.placed(tree, rows.n)] * (rate if i else 1.0)
            steps, pos, neg, loss = tally(margins, rows.labels, digits)
            steps, pos, neg = (steps, pos, neg) if len(steps) else (np.zeros(1, np.int64),) * 3
            losses = np.zeros(len(steps))
            losses[0] = loss
            columns = [pa.array([name] * len(steps), pa.string()), pa.array(np.full(len(steps), i + 1, np.int32)), pa.array(steps.astype(np.int64))]
            columns += [pa.array(pos.astype(np.int64)), pa.array(neg.astype(np.int64)), pa.array(losses)]
            yield pa.RecordBatch.from_arrays(columns, names=["dataset", "iteration", "step", "pos", "neg", "loss"])

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        width, held, size = len(space.levels), {}, {}
        for batch in batches:
            names = batch.column(0).to_numpy(zero_copy_only=False)
            labels = batch.column(1).to_numpy(zero_copy_only=False).astype(float)
            bins = space.binned(batch.column(2).flatten().to_numpy(zero_copy_only=False).reshape(-1, width))
            for name in dict.fromkeys(names.tolist()):
                own = names == name
                held.setdefault(name, []).append((bins[own], labels[own]))
                size[name] = size.get(name, 0) + int(own.sum())
                if size[name] >= MEASURED_ROWS:
                    yield from measured(name, *map(np.concatenate, zip(*held.pop(name), strict=True)))
                    del size[name]
        for name, parts in held.items():
            yield from measured(name, *map(np.concatenate, zip(*parts, strict=True)))

    return run
