"""Quality classifier from weak labels.

Overlapping heuristic labellers vote good, poor or not at all. Expectation-maximisation over the counts of vote
patterns (all documents, at most 3^labellers rows) estimates how often each labeller gives each vote to good, poor
and abusive documents, and so the chance that a document is good given its votes. Those posteriors are the targets
of a logistic scorer over hashed features, fitted on a bounded sample; the scorer alone decides.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from functools import lru_cache
from itertools import product

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from holdfast.llm.common import SPACES, as_bytes, id_and_text, release, slices
from holdfast.llm.line_rules import SYMBOLS, labelled_sample

#: Fixed value: common English insults.
INSULTS = frozenset(
    b"bastard bitch clown coward creep disgusting dumb dumbass filthy fool freak hateful idiot idiotic imbecile jerk loser "
    b"lowlife moron moronic pathetic pig rubbish scum scumbag sleazy stupid trash ugly vermin vile whore worthless".split()
)
POOR, GOOD, NONE = 0, 1, 2
LABELLERS = ("symbols", "repeats", "variety", "shape", "shouting", "insults", "stems")
#: The kinds of documents that the votes tell apart, with the labellers expected to see them.
KINDS = {"good": (), "cluttered": ("symbols",), "repetitive": ("repeats", "variety"), "shouting": ("shouting",), "abusive": ("insults", "stems")}
#: Lengths of the word beginnings that serve as features, and how often one must occur in a text to count again.
STEMS = (4, 5, 7)
LEVELS = (1, 2, 4)
BUCKETS = 1 << 18
STYLES = 1 << 10
DIMENSIONS = len(LEVELS) * BUCKETS + STYLES
KEPT_WORDS = 150_000
_LETTERS = bytes(b if b >= 128 or chr(b).isalpha() else 32 for b in range(256))
_UPPER = bytes(range(0x41, 0x5B))
_LOWER = bytes(range(0x61, 0x7B))


def measures(text: bytes, words: list[bytes]) -> tuple[float, ...]:
    """Shares by which the labellers judge: symbols, adjacent repeats, distinct words, mean word length, capitals."""
    n, size = len(words), max(1, len(text))
    symbols = (len(text) - len(text.translate(None, SYMBOLS))) / size
    repeats = sum(map(bytes.__eq__, words, words[1:])) / max(1, n)
    capitals, small = len(text) - len(text.translate(None, _UPPER)), len(text) - len(text.translate(None, _LOWER))
    return symbols, repeats, len(set(words)) / max(1, n), len(text.translate(None, SPACES)) / max(1, n), capitals / max(1, capitals + small)


def votes(text: bytes, n: int, measured: tuple[float, ...], plain: list[bytes], marks: int) -> tuple[int, ...]:
    """What each labeller says of a text of ``n`` words with these measures and ``marks`` abusive stems."""
    symbols, repeats, variety, width, capitals = measured
    return (
        POOR if symbols > 0.03 else GOOD if symbols < 0.005 else NONE,
        NONE if n < 10 else POOR if repeats > 0.2 else GOOD if repeats < 0.03 else NONE,
        NONE if n < 30 else POOR if variety < 0.15 else GOOD if variety > 0.35 else NONE,
        NONE if n < 3 else GOOD if 2.5 <= width <= 12 and text.rstrip()[-1:] in (b".", b"!", b"?") else NONE if width <= 14 else POOR,
        NONE if n < 10 else POOR if capitals > 0.5 else GOOD if capitals < 0.2 else NONE,
        POOR if not INSULTS.isdisjoint(plain) else GOOD,
        POOR if marks >= 3 else NONE if marks else GOOD,
    )


def pattern_number(found: tuple[int, ...]) -> int:
    number = 0
    for v in found:
        number = number * 3 + v
    return number


def fit_labellers(counts: dict[int, int], rounds: int = 100) -> dict[int, float]:
    """Expectation-maximisation; the posterior chance of ``good`` for every possible pattern of votes.

    A labeller that does not vote says nothing; only votes enter the likelihood.
    """
    patterns = np.array(list(product((POOR, GOOD, NONE), repeat=len(LABELLERS))))
    weight = np.array([counts.get(i, 0) for i in range(len(patterns))], float)
    total = max(1.0, weight.sum())
    # Where the estimation starts: chance of a poor and of a good vote by kind and labeller.
    poor = np.array([[0.7 if name in seen else 0.002 if kind == "good" else 0.02 for name in LABELLERS] for kind, seen in KINDS.items()])
    table = np.stack([poor, 1 - poor], axis=2)
    share = np.array([0.8] + [0.2 / (len(KINDS) - 1)] * (len(KINDS) - 1))
    one_hot = (patterns[:, :, None] == np.arange(2)).astype(float)

    def posterior() -> np.ndarray:
        log = np.log(share) + np.einsum("plv,clv->pc", one_hot, np.log(np.maximum(table, 1e-9)))
        p = np.exp(log - log.max(1, keepdims=True))
        return p / p.sum(1, keepdims=True)

    prior = table * (np.array([0.2] + [0.01] * (len(KINDS) - 1)) * total)[:, None, None]  # good documents rarely get a poor vote
    for _ in range(rounds):
        mass = posterior() * weight[:, None]
        if not weight.any():
            break
        table = np.einsum("pc,plv->clv", mass, one_hot) + prior
        table /= table.sum(2, keepdims=True)
        share = (mass.sum(0) + 1) / (total + len(KINDS))
    return dict(enumerate(posterior()[:, 0].tolist()))


class Hasher:
    """Feature buckets of words, kept by word."""

    def __init__(self) -> None:
        self._place: dict[bytes, int] = {}
        self._table = np.zeros((1024, len(STEMS)), np.int32)

    def read(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """The buckets of the words' beginnings, ascending, and how often each occurs; shorter words have none."""
        place = self._place
        if len(place) > KEPT_WORDS:
            place.clear()
        counted = Counter(words)
        new = [w for w in counted if w not in place]
        if new:
            start, end = len(place), len(place) + len(new)
            place.update(zip(new, range(start, end), strict=True))
            while end > len(self._table):
                self._table = np.concatenate((self._table, np.zeros_like(self._table)))
            letters = [w if w.isascii() else w.decode("utf-8", "replace").lower() for w in new]  # ASCII is lower-cased already
            for i, n in enumerate(STEMS):
                self._table[start:end, i] = [xxhash.xxh32_intdigest(x[:n], n) % BUCKETS if len(x) >= n else -1 for x in letters]
        found = self._table[np.fromiter(map(place.__getitem__, counted), np.int64, len(counted))].ravel()
        times = np.repeat(np.fromiter(counted.values(), np.int64, len(counted)), len(STEMS))[found >= 0]
        found = found[found >= 0]
        order = np.argsort(found)
        found, times = found[order], times[order]
        first = np.flatnonzero(np.concatenate((np.ones(min(1, len(found)), bool), found[1:] != found[:-1])))
        return found[first], np.add.reduceat(times, first) if len(first) else times


@lru_cache(maxsize=1)
def hasher() -> Hasher:
    return Hasher()


def stem_features(plain: list[bytes]) -> np.ndarray:
    bucket, times = hasher().read(plain)
    return np.concatenate([level * BUCKETS + bucket[times >= least] for level, least in enumerate(LEVELS)])


def document(text: bytes, stems: np.ndarray) -> tuple[int, np.ndarray]:
    """The vote pattern and the feature numbers of a text. ``stems`` are the features that mark abuse, ascending."""
    words = text.split()
    plain = text.lower().translate(_LETTERS).split()
    features = stem_features(plain)
    at = np.searchsorted(stems, features)
    marks = int((stems[np.minimum(at, len(stems) - 1)] == features).sum()) if len(stems) else 0
    symbols, repeats, variety, width, capitals = measured = measures(text, words)
    style = (
        f"symbols {min(9, int(symbols * 100))}", f"repeats {min(9, int(repeats * 20))}", f"variety {int(variety * 10) if len(words) >= 30 else -1}",
        f"width {min(20, int(width))}", f"capitals {int(capitals * 10)}", f"words {min(6, int(math.log2(len(words) + 1)))}", "bias",
    )
    styles = [len(LEVELS) * BUCKETS + xxhash.xxh32_intdigest(s, 2) % STYLES for s in style]
    return pattern_number(votes(text, len(words), measured, plain, marks)), np.concatenate((features, styles)).astype(np.int32)


_MIXES = np.random.default_rng(3).integers(1, 1 << 31, 12, np.int64) * 2 + 1


def least_hash(features: np.ndarray) -> int:
    """Twelve least hashes of the features in one number, which close copies often share and other texts hardly ever."""
    if not len(features):
        return 0
    least = ((features.astype(np.int64)[:, None] + 1) * _MIXES % ((1 << 31) - 1)).min(0)
    return xxhash.xxh64_intdigest(least.tobytes()) >> 1


def telling_features(flat: np.ndarray, owner: np.ndarray, target: np.ndarray) -> np.ndarray:
    """Whether the mean target of the rows with a feature differs clearly from the overall mean; styles always count.

    Five standard errors tell a difference from chance; in larger samples up to twelve are asked for, because there
    the words of a few close copies also differ by more than chance.
    """
    n = np.bincount(flat, minlength=DIMENSIONS)
    rate = float(target.mean()) if len(target) else 0.5
    apart = np.bincount(flat, target[owner], DIMENSIONS) - n * rate
    least = np.clip(np.sqrt(len(target)) / 9, 5, 12)
    keep = (n >= 10) & (np.abs(apart) > least * np.sqrt(np.maximum(n, 1) * max(rate * (1 - rate), 1e-6)))
    keep[len(LEVELS) * BUCKETS :] = True
    return keep


def fit_scorer(
    flat: np.ndarray, ends: np.ndarray, target: np.ndarray, epochs: int = 12, rate: float = 0.1, ridge: float = 1e-5, batch: int = 64
) -> np.ndarray:
    """Logistic regression on soft targets by adaptive mini-batch steps; ``flat[ends[i]:ends[i + 1]]`` are a row's features."""
    weights, square = np.zeros(DIMENSIONS), np.full(DIMENSIONS, 1e-4)
    dice = np.random.default_rng(5)
    for _ in range(epochs if len(target) else 0):
        order = dice.permutation(len(target))
        for at in range(0, len(target), batch):
            part = order[at : at + batch]
            rows = [flat[ends[i] : ends[i + 1]] for i in part]
            owner = np.repeat(np.arange(len(part)), list(map(len, rows)))
            used = np.concatenate(rows)
            margin = np.bincount(owner, weights[used], len(part))
            error = target[part] - 1 / (1 + np.exp(-np.clip(margin, -30, 30)))
            touched, inverse = np.unique(used, return_inverse=True)
            slope = np.bincount(inverse, error[owner]) / len(part) - ridge * weights[touched]
            square[touched] += slope**2
            weights[touched] += rate * slope / np.sqrt(square[touched])
    return weights


def learn_stems(docs: DataFrame, labels: DataFrame, bad: int = 1500, fine: int = 4500) -> np.ndarray:
    """Features that mark abusive documents, from at most ``bad`` and ``fine`` documents of the toxicity labels.

    Near copies would make any of their words look telling, so documents with the same least feature hash count once.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            found = [stem_features((t or b"").lower().translate(_LETTERS).split()) for t in as_bytes(batch.column("text"))]
            least = [least_hash(x) for x in found]
            columns = [batch.column("label"), pa.array(least, pa.int64()), pa.array(found, pa.list_(pa.int32()))]
            yield pa.RecordBatch.from_arrays(columns, ["label", "least", "stems"])

    rows = labelled_sample(docs, labels, "toxic", fine, bad).mapInArrow(run, "label int, least long, stems array<int>")
    counted = rows.select("label", "least", F.explode("stems").alias("stem")).distinct().groupBy("stem").agg(
        F.count_if(F.col("label") == 1).alias("bad"), F.count_if(F.col("label") == 0).alias("fine")
    )
    # Few stems pass: each needs ten abusive documents of the bounded sample, and one in fifty of them.
    known = min(bad, labels.filter("toxic = 1").select("doc_id").distinct().count())
    telling = counted.filter((F.col("bad") >= max(10, known // 50)) & (F.col("bad") > 20 * F.col("fine")))
    return np.array(sorted(r.stem for r in telling.collect()), np.int64)


class Judge:
    """What was learned: abusive stems, posteriors by vote pattern and the weights of the scorer."""

    def __init__(self, stems: np.ndarray, posterior: dict[int, float], weights: np.ndarray):
        self.stems, self.posterior, self.weights = stems, posterior, weights

    def of(self, text: bytes | None) -> tuple[int | None, float | None, float]:
        """(votes, posterior, score); a text without words scores 0."""
        if not text or not text.split():
            return None, None, 0.0
        pattern, buckets = document(text, self.stems)
        margin = np.clip(self.weights[buckets].sum(dtype=np.float64), -30, 30)
        return pattern, self.posterior[pattern], float(1 / (1 + np.exp(-margin)))


def fit(docs: DataFrame, labels: DataFrame, sample: int = 12_000) -> Judge:
    """Learn from ``docs``; the scorer from about ``sample`` of them, chosen by a hash."""
    plain = id_and_text(docs)
    stems = learn_stems(plain, labels)

    def vote(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            found = Counter(document(t, stems)[0] for t in as_bytes(batch.column("text")) if t)
            yield pa.RecordBatch.from_arrays([pa.array(list(found), pa.int64()), pa.array(list(found.values()), pa.int64())], ["votes", "n"])

    # At most 3^labellers rows.
    tallied = plain.select("text").mapInArrow(vote, "votes long, n long").groupBy("votes").agg(F.sum("n").alias("n")).collect()
    counts = {r.votes: r.n for r in tallied}
    posterior = fit_labellers(counts)
    total = max(1, sum(counts.values()))

    def features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            found = [document(t, stems) for t in as_bytes(batch.column("text")) if t]
            columns = [pa.array([x for x, _ in found], pa.int64()), pa.array([x for _, x in found], pa.list_(pa.int32()))]
            yield pa.RecordBatch.from_arrays(columns, ["votes", "buckets"])

    share = min(1.0, sample / total)
    picked = plain.filter(F.pmod(F.xxhash64("doc_id", "text"), F.lit(1 << 20)) < int(share * (1 << 20)) + (share == 1.0))
    rows = picked.select("text").mapInArrow(features, "votes long, buckets array<int>").toArrow()
    lists = rows.column("buckets").combine_chunks()
    flat, ends, pattern = lists.values.to_numpy().astype(np.int64), lists.offsets.to_numpy(), rows.column("votes").to_pylist()
    # In an order that does not depend on Spark's; near copies count once, or any of their words would look telling.
    first: dict[int, int] = {}
    for i in sorted(range(rows.num_rows), key=lambda i: flat[ends[i] : ends[i + 1]].tobytes()):
        words = flat[ends[i] : ends[i + 1]]
        first.setdefault(least_hash(words[words < len(LEVELS) * BUCKETS]), i)
    picked_rows = list(first.values())
    parts = [flat[ends[i] : ends[i + 1]] for i in picked_rows]
    target = np.array([posterior[pattern[i]] for i in picked_rows])
    sizes = np.array([len(x) for x in parts], np.int64)
    flat, owner = (np.concatenate(parts) if parts else flat[:0]), np.repeat(np.arange(len(parts)), sizes)
    keep = telling_features(flat, owner, target)[flat]
    sizes = np.bincount(owner[keep], minlength=len(parts))
    weights = fit_scorer(flat[keep], np.concatenate(([0], np.cumsum(sizes))), target).astype(np.float32)

    return Judge(stems, posterior, weights)


def classify(docs: DataFrame, labels: DataFrame, sample: int = 12_000, threshold: float = 0.5) -> DataFrame:
    """(doc_id, votes, posterior, score, kept) for every row of ``docs``; kept if the scorer gives at least ``threshold``.

    A null text or one without words scores 0 and is not kept. Equal texts are judged alike; repeated rows stay.
    Further columns are left out.
    """
    judge = fit(docs, labels, sample)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            out = [(*x, x[2] >= threshold) for x in map(judge.of, as_bytes(batch.column("text")))]
            types = [pa.int64(), pa.float64(), pa.float64(), pa.bool_()]
            columns = [pa.array(c, t) for c, t in zip(zip(*out, strict=True), types, strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), *columns], ["doc_id", "votes", "posterior", "score", "kept"])

    return id_and_text(docs).mapInArrow(run, "doc_id long, votes long, posterior double, score double, kept boolean")


def keep_good(docs: DataFrame, labels: DataFrame, sample: int = 12_000, threshold: float = 0.5, text_col: str = "text") -> DataFrame:
    """The rows of ``docs``, with all their columns, that :func:`classify` keeps."""
    judge = fit(docs.select("doc_id", F.col(text_col).alias("text")), labels, sample)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, text=text_col):
            good = [judge.of(t)[2] >= threshold for t in as_bytes(batch.column(text_col))]
            yield batch.filter(pa.array(good, pa.bool_()))
        release()

    return docs.mapInArrow(run, docs.schema)
