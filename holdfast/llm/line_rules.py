"""Quality rules: a linear-chain conditional random field marks every line as content or boilerplate.

Lines are turned into a few binary features; weights are fitted by maximum likelihood (forward-backward) on a
bounded sample of labelled documents; Viterbi decoding labels the lines of every document, and the share of
words on content lines decides retention, after two plain rules (too few words, too many repeated windows).

Everything is one pass over the documents. Texts are handled in slices of a few MB, so memory does not grow with
the table or with one very long text beyond that text itself.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from holdfast.llm.common import SPACES, as_bytes, id_and_text, slices

SYMBOLS = b"#*$%&|<>"
WINDOW = 8
FEATURES = 12
SCHEMA = (
    "doc_id long, n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, "
    "base_failed boolean, kept boolean, n_lines long, n_content_lines long, content_share double"
)


def line_features(line: bytes, words: list[bytes], repeated: bool) -> int:
    """The binary features of a line as a bit set; bit 0 is the bias."""
    n = len(words)
    if n == 0:
        return 1 | 2
    size = len(line)
    symbols = size - len(line.translate(None, SYMBOLS))
    again = n - len(set(words))
    bits = 1
    if symbols * 50 > size:
        bits |= 4
    if symbols * 10 > size:
        bits |= 8
    if n >= 6 and again * 2 > n:
        bits |= 16
    if n >= 2 and sum(map(bytes.__eq__, words, words[1:])) * 5 > n:
        bits |= 32
    if words[-1][-1:] in (b".", b"!", b"?"):
        bits |= 64
    if n <= 3:
        bits |= 128
    if repeated:
        bits |= 256
    if sum(line.count(d) for d in (b"0", b"1", b"2", b"3", b"4", b"5", b"6", b"7", b"8", b"9")) * 3 > size:
        bits |= 512
    if line.count(b"|") >= 3:
        bits |= 1024
    if b"http" in line or b"www." in line:
        bits |= 2048
    return bits


def document_lines(text: bytes) -> tuple[list[int], list[int], int]:
    """Feature bits and word count of every line, and how many lines with a word equal an earlier line."""
    seen: set[bytes] = set()
    bits, counts, repeats = [], [], 0
    for line in text.split(b"\n"):
        words = line.split()
        repeated = False
        if words:
            repeated = line in seen
            repeats += repeated
            seen.add(line)
        bits.append(line_features(line, words, repeated))
        counts.append(len(words))
    return bits, counts, repeats


def _dense(bits: list[int]) -> np.ndarray:
    return ((np.asarray(bits, np.int64)[:, None] >> np.arange(FEATURES)) & 1).astype(np.float64)


class LineField:
    """A two-label chain: ``emit`` (2 x FEATURES) and ``move`` (2 x 2). Label 0 is content, label 1 boilerplate."""

    def __init__(self, emit: np.ndarray | None = None, move: np.ndarray | None = None):
        self.emit = np.zeros((2, FEATURES)) if emit is None else emit
        self.move = np.zeros((2, 2)) if move is None else move

    def fit(
        self, sequences: list[tuple[list[int], int | list[int]]], rounds: int = 40, rate: float = 0.5, ridge: float = 1e-3, caution: float = 2.0
    ) -> LineField:
        """Likelihood weighted by label, by full-batch adaptive gradient steps; a sequence is (feature bits, its label or one per line).

        Both labels weigh the same however many lines they have, but losing a content line costs ``caution`` times as much
        as keeping one of boilerplate; a pair of neighbours weighs the mean of its two lines.
        """
        data = [(_dense(bits), np.broadcast_to(label, len(bits))) for bits, label in sequences if bits]
        lines = sum(len(x) for x, _ in data)
        poor = sum(int(label.sum()) for _, label in data)
        if poor in (0, lines):
            return self
        cost = np.array([caution / (lines - poor), 1 / poor]) / (caution + 1)
        total = [np.zeros_like(self.emit), np.zeros_like(self.move)]
        for _ in range(rounds):
            step = [-ridge * self.emit, -ridge * self.move]
            for x, label in data:
                weight = cost[label]
                between = (weight[:-1] + weight[1:]) / 2
                unary, pairs = self._marginals(x, between)
                step[0] += ((np.stack((1 - label, label), axis=1) - unary) * weight[:, None]).T @ x
                step[1] += np.bincount(2 * label[:-1] + label[1:], between, minlength=4).reshape(2, 2) - pairs
            for value, gradient, square in zip((self.emit, self.move), step, total, strict=True):
                square += gradient**2
                value += rate * gradient / np.sqrt(square + 1e-12)
        return self

    def _marginals(self, x: np.ndarray, weight: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Label probabilities of every line, and expected counts of label pairs; ``weight`` is that of each pair of neighbours."""
        score = np.exp(x @ self.emit.T)
        jump = np.exp(self.move)
        n = len(x)
        ahead, back = np.empty((n, 2)), np.ones((n, 2))
        ahead[0] = score[0] / score[0].sum()
        for i in range(1, n):
            v = (ahead[i - 1] @ jump) * score[i]
            ahead[i] = v / v.sum()
        for i in range(n - 2, -1, -1):
            v = jump @ (score[i + 1] * back[i + 1])
            back[i] = v / v.sum()
        unary = ahead * back
        unary /= unary.sum(1, keepdims=True)
        if n == 1:
            return unary, np.zeros((2, 2))
        pair = ahead[:-1, :, None] * jump * (score[1:] * back[1:])[:, None, :]
        return unary, (pair * (weight / pair.sum((1, 2)))[:, None, None]).sum(0)

    def table(self) -> list[float]:
        """By feature bits: how much better label 1 is than label 0 on such a line."""
        return (_dense(list(range(1 << FEATURES))) @ (self.emit[1] - self.emit[0])).tolist()

    def viterbi(self, bits: list[int], gain: list[float]) -> list[bool]:
        """For every line, whether it is boilerplate on the best path; a tie goes to content."""
        (cc, cb), (bc, bb) = self.move.tolist()
        if not bits:
            return []
        lead = gain[bits[0]]  # score of the best path that ends in boilerplate, less that of the one ending in content
        from_c, from_b = [], []  # does the best path into content (boilerplate) come from boilerplate?
        for b in bits[1:]:
            to_c, to_b = lead + bc > cc, lead + bb > cb
            from_c.append(to_c)
            from_b.append(to_b)
            lead = gain[b] + (lead + bb if to_b else cb) - (lead + bc if to_c else cc)
        path = [lead > 0]
        for to_c, to_b in zip(reversed(from_c), reversed(from_b), strict=True):
            path.append(to_b if path[-1] else to_c)
        return path[::-1]


def repeated_words(codes: np.ndarray, owner: np.ndarray, n_docs: int) -> np.ndarray:
    """Per document: words inside a window of 8 words that occurs twice or more in it. ``owner`` is ascending.

    Windows are named exactly by doubling: a pair of names gets a new name, three times over.
    """
    n = len(codes)
    if n < WINDOW:
        return np.zeros(n_docs, np.int64)
    names, width = codes.astype(np.int64), 1
    while width < WINDOW:
        key = names[:-width] * (int(names.max()) + 1) + names[width:]
        names = np.unique(key, return_inverse=True)[1]
        width *= 2
    start = np.flatnonzero(owner[: len(names)] == owner[WINDOW - 1 : WINDOW - 1 + len(names)])
    key = owner[start].astype(np.int64) * (int(names.max()) + 1) + names[start]
    _, inverse, count = np.unique(key, return_inverse=True, return_counts=True)
    hit = start[count[inverse] > 1]
    edge = np.zeros(n + 1, np.int64)
    np.add.at(edge, hit, 1)
    np.add.at(edge, hit + WINDOW, -1)
    return np.bincount(owner[np.cumsum(edge[:-1]) > 0], minlength=n_docs)


def _measure(texts: list[bytes | None]) -> tuple[list[list[bytes]], np.ndarray]:
    words = [(t or b"").split() for t in texts]
    names: dict[bytes, int] = {}
    codes = np.fromiter((names.setdefault(w, len(names)) for doc in words for w in doc), np.int64)
    owner = np.repeat(np.arange(len(texts)), [len(w) for w in words])
    return words, repeated_words(codes, owner, len(texts))


def apply_rules(docs: DataFrame, field: LineField, share: float = 0.5) -> DataFrame:
    """One row per document with the base measures and the verdict of the field.

    A null text has no words and one empty line. A document that passes the base rules is kept if at least
    ``share`` of its words lie on content lines. Repeated rows are judged one by one.
    """

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        gain = field.table()
        for batch in slices(batches):
            texts = as_bytes(batch.column("text"))
            words, repeats = _measure(texts)
            rows = []
            for text, w, again in zip(texts, words, repeats.tolist(), strict=True):
                text = text or b""
                bits, counts, dup = document_lines(text)
                marks = field.viterbi(bits, gain)
                content = sum(c for c, m in zip(counts, marks, strict=True) if not m)
                n = len(w)
                glyphs = len(text.decode()) - (len(text) - len(text.translate(None, SPACES)))
                failed = n < 20 or 100 * again > 30 * n
                portion = content / n if n else 0.0
                rows.append((
                    n, glyphs, len(text) - len(text.translate(None, SYMBOLS)), dup, again, failed,
                    not failed and portion >= share, len(bits), len(bits) - sum(marks), portion,
                ))
            names = [c.split()[0] for c in SCHEMA.split(", ")]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), *map(pa.array, zip(*rows, strict=True))], names)

    return id_and_text(docs).mapInArrow(judge, SCHEMA)


def labelled_sample(docs: DataFrame, labels: DataFrame, column: str, zeros: int, ones: int) -> DataFrame:
    """(doc_id, label, text) of at most ``zeros`` and ``ones`` documents of class 0 and 1, chosen by a hash of the id."""
    known = labels.select(labels["doc_id"].cast("long").alias("doc_id"), labels[column].cast("int").alias("label"))
    known = known.filter("doc_id IS NOT NULL AND label IN (0, 1)").groupBy("doc_id").agg(F.min("label").alias("label"))
    picked = [
        known.filter(F.col("label") == c).orderBy(F.xxhash64("doc_id"), "doc_id").limit(n) for c, n in ((0, zeros), (1, ones))
    ]
    # At most zeros + ones short rows, by the limits above.
    return id_and_text(docs).join(F.broadcast(picked[0].union(picked[1])), "doc_id").select("doc_id", "label", "text")


def fit_line_field(docs: DataFrame, labels: DataFrame, per_class: int = 400, lines: int = 1000) -> LineField:
    """Fit on at most ``per_class`` documents of either quality label, each with all its lines.

    Lines of a document of good quality count as content, those of a poor one as boilerplate. Good and poor documents
    are joined in pairs, so that chains show both labels and where they change. A sampled document of more than
    ``lines`` lines does not teach. Without labelled documents of both kinds the weights stay zero and every line is
    content.
    """

    def extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            texts = as_bytes(batch.column("text"))
            bits = [document_lines(t)[0] if t and t.count(b"\n") < lines else [] for t in texts]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("label"), pa.array(bits, pa.list_(pa.int32()))], ["doc_id", "label", "bits"]
            )

    sample = labelled_sample(docs, labels, "quality", per_class, per_class).mapInArrow(extract, "doc_id long, label int, bits array<int>")
    rows = sorted((r.doc_id, r.label, r.bits) for r in sample.collect() if r.bits)
    return LineField().fit(joined([bits for _, label, bits in rows if label == 1], [bits for _, label, bits in rows if label == 0]))


def joined(good: list[list[int]], poor: list[list[int]]) -> list[tuple[list[int], list[int]]]:
    """Chains of one good and one poor document, in turns either first; what has no partner is a chain of its own."""
    pairs = min(len(good), len(poor))
    chains = [(g + p, [0] * len(g) + [1] * len(p)) if i % 2 else (p + g, [1] * len(p) + [0] * len(g)) for i, (g, p) in enumerate(zip(good, poor, strict=False))]
    return chains + [(x, [0] * len(x)) for x in good[pairs:]] + [(x, [1] * len(x)) for x in poor[pairs:]]
