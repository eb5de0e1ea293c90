"""Scan for secrets: fixed patterns, and a battery of randomness tests under false-discovery control.

Besides the fixed patterns, every run of 20 or more characters that keys are written in is a candidate. Its encoding is
inferred as the smallest alphabet that holds it, and three tests ask whether it could be uniformly random in it:
chi-squared for the use of the alphabet, Wald-Wolfowitz runs about its middle, and serial correlation. Fisher's method
joins their p-values.

Not being rejected says little about a short string, so the level to pass depends on the length. Each candidate
is matched with a decoy of equal length, made of ordinary words near it without their spaces, and put to the same
battery. In every band of lengths the most lenient level is taken at which decoys that pass, scaled to the number of
candidates, are at most ``rate`` of the candidates that pass. Levels come from all candidates and decoys of the corpus.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from holdfast.llm.common import as_bytes, id_and_text, slices
from holdfast.session import materialize

#: The patterns, in the order of their kinds, and the least length of what counts of each match.
_ASSIGN = re.compile(rb"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.IGNORECASE)
_ACCESS = re.compile(rb"AKIA[A-Z0-9]+")
_HEX = re.compile(rb"[0-9a-f]{16,}")
KINDS = ("assign", "access", "hex", "random")

_CANDIDATE = re.compile(rb"[A-Za-z0-9+/_=-]{20,}")
_SPACING = re.compile(rb"[^A-Za-z0-9+/_=-]+")
_LOWER, _UPPER, _DIGITS = b"abcdefghijklmnopqrstuvwxyz", b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"0123456789"
ALPHABETS = sorted(
    [_DIGITS, _DIGITS + _LOWER[:6], _DIGITS + _UPPER[:6], _LOWER, _UPPER, _UPPER + b"234567", _DIGITS + _LOWER, _DIGITS + _UPPER,
     _UPPER + _LOWER, _UPPER + _LOWER + _DIGITS, _UPPER + _LOWER + _DIGITS + b"+/", _UPPER + _LOWER + _DIGITS + b"-_", _UPPER + _LOWER + _DIGITS + b"+/-_"],
    key=len,
)
#: Lengths at which a new band begins, and the worst level: tenths of a decade of p, so 30 stands for p = 0.001.
BANDS = (20, 28, 36, 48, 64, 96, 128, 256, 1024)
WORST = 30


def battery(string: bytes) -> tuple[float, float, float]:
    """p-values of uniformity, runs and serial correlation of ``string``, random in the smallest alphabet that holds it."""
    string = string.rstrip(b"=").replace(b"=", b"") or b"0"
    letters = set(string)
    alphabet = next(a for a in ALPHABETS if letters <= set(a))
    place = np.zeros(256, np.int64)
    place[np.frombuffer(alphabet, np.uint8)] = np.arange(len(alphabet))
    x = place[np.frombuffer(string, np.uint8)]
    n, k = len(x), len(alphabet)
    if n < 2:
        return 0.0, 0.0, 0.0
    count = np.bincount(x, minlength=k)
    df = k - 1
    chi2 = float(((count - n / k) ** 2).sum() * k / n)
    chi2 = df + (chi2 - df) / math.sqrt(1 - 1 / n)  # few characters for many cells: the exact variance
    z = (max(chi2, 0.0) / df) ** (1 / 3) - (1 - 2 / (9 * df))
    uniform = 0.5 * math.erfc(z / math.sqrt(2 / (9 * df)) / math.sqrt(2))
    high = x >= k / 2
    a = int(high.sum())
    b = n - a
    mean = 2 * a * b / n + 1
    spread = (mean - 1) * (mean - 2) / (n - 1)
    if a == 0 or b == 0 or spread <= 0:
        runs = 2.0 ** max(1 - n, -1000)
    else:
        runs = math.erfc(abs(1 + int((high[1:] != high[:-1]).sum()) - mean) / math.sqrt(spread) / math.sqrt(2))
    off = x - x.mean()
    square = float((off * off).sum())
    serial = math.erfc(abs(float((off[1:] * off[:-1]).sum()) / square + 1 / n) * math.sqrt(n) / math.sqrt(2)) if square else 0.0
    return uniform, runs, serial


def level(string: bytes) -> int:
    """How little random the string looks: Fisher's joint p-value in tenths of a decade, at most ``WORST`` + 1."""
    half = -sum(math.log(max(p, 1e-300)) for p in battery(string))
    joint = math.exp(-half) * (1 + half + half * half / 2)
    return min(WORST + 1, math.ceil(-10 * math.log10(max(joint, 1e-300))))


def band(length: int) -> int:
    return sum(length >= b for b in BANDS) - 1


def base_spans(text: bytes) -> list[tuple[int, int, int]]:
    """(start, kind, end) in bytes, sorted."""
    found = [(m.start(), 0, m.end()) for m in _ASSIGN.finditer(text) if m.end(2) - m.start(2) >= 12]
    found += [(m.start(), 1, m.end()) for m in _ACCESS.finditer(text) if m.end() - m.start() >= 18]
    found += [(m.start(), 2, m.end()) for m in _HEX.finditer(text)]
    return sorted(found)


def decoy(text: bytes, start: int, end: int) -> bytes | None:
    """Words near a candidate, joined to its length; None if there are too few."""
    n = end - start
    for near in (text[end : end + 4 * n + 200], text[max(0, start - 4 * n - 200) : start]):
        words = _SPACING.sub(b"", _CANDIDATE.sub(b"", near))
        if len(words) >= n:
            return words[:n]
    return None


def _place(text: bytes, spans: list[tuple]) -> list[tuple]:
    """Spans (start, kind, end, ...) sorted by start, with byte offsets turned into code points."""
    marks = sorted({x for s in spans for x in (s[0], s[2])})
    points, at, count = {}, 0, 0
    for m in marks:
        part = text[at:m]
        count += len(part) - sum(part.count(bytes((b,))) for b in range(0x80, 0xC0)) if not part.isascii() else len(part)
        at, points[m] = m, count
    return [(points[s[0]], s[1], points[s[2]], *s[3:]) for s in spans]


_SPAN = pa.struct([("start", pa.int64()), ("kind", pa.int32()), ("end", pa.int64())])
_SUSPECT = pa.struct([("start", pa.int64()), ("kind", pa.int32()), ("end", pa.int64()), ("band", pa.int32()), ("level", pa.int32()), ("decoy", pa.int32()), ("free", pa.bool_())])
_FOUND = (
    "doc_id long, base array<struct<start: long, kind: int, end: long>>, "
    "suspects array<struct<start: long, kind: int, end: long, band: int, level: int, decoy: int, free: boolean>>"
)


def scanned(docs: DataFrame) -> DataFrame:
    """(doc_id, base, suspects): spans of the fixed patterns, and candidates with their own and their decoy's level."""

    def scan(text: bytes) -> tuple[list, list]:
        base = base_spans(text)
        taken: list[list[int]] = []  # what the base spans cover, without overlaps
        for s, _, e in base:
            if taken and s < taken[-1][1]:
                taken[-1][1] = max(e, taken[-1][1])
            else:
                taken.append([s, e])
        suspects, at = [], 0
        for m in _CANDIDATE.finditer(text):
            a, z = m.span()
            while at < len(taken) and taken[at][1] <= a:
                at += 1
            free = at == len(taken) or taken[at][0] >= z
            d = decoy(text, a, z)
            suspects.append((a, 3, z, band(z - a), level(text[a:z]), None if d is None else level(d), free))
        return _place(text, base), _place(text, suspects)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            found = [scan(t or b"") for t in as_bytes(batch.column("text"))]
            columns = []
            for i, kind in ((0, _SPAN), (1, _SUSPECT)):
                names = [f.name for f in kind]
                columns.append(pa.array([[dict(zip(names, s, strict=True)) for s in f[i]] for f in found], pa.list_(kind)))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), *columns], ["doc_id", "base", "suspects"])

    return id_and_text(docs).mapInArrow(run, _FOUND)


def passing_levels(found: DataFrame, rate: float) -> dict[int, int]:
    """The most lenient level of each band of lengths that keeps the share of false discoveries within ``rate``.

    Only a table of bands times levels, at most 9 x 32 x 33 rows, reaches the driver.
    """
    suspects = found.select(F.explode("suspects").alias("s")).select("s.*")
    counted: dict[int, tuple[np.ndarray, np.ndarray]] = {}
    for b, own, other, n in suspects.groupBy("band", "level", "decoy").agg(F.count("*")).collect():
        real, fake = counted.setdefault(b, (np.zeros(WORST + 2, np.int64), np.zeros(WORST + 2, np.int64)))
        real[own] += n
        if other is not None:
            fake[other] += n
    chosen = {}
    for b, (real, fake) in counted.items():
        if not fake.sum():
            continue
        passed = np.cumsum(real)[: WORST + 1]
        false = (np.cumsum(fake)[: WORST + 1] + 1) * real.sum() / fake.sum()
        good = np.flatnonzero(false <= rate * passed)
        if len(good):
            chosen[b] = int(good[-1])
    return chosen


def _joined(spans: Column) -> Column:
    kind = F.array(*map(F.lit, KINDS))
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", kind[s["kind"]], s["start"].cast("string"), s["end"].cast("string"))), ",")


def find_secrets(docs: DataFrame, rate: float = 0.05) -> DataFrame:
    """(doc_id, n_assign, n_access, n_hex, base, spans) of every row; base and spans name kind:start:end in code points.

    ``base`` is what the fixed patterns find. ``spans`` adds the kind ``random``: candidates that overlap no such span
    and pass the battery at their length's level. A null or empty text has none; repeated rows are scanned one by one;
    an empty table gives no rows. Texts may be of any length, and columns besides id and text are not read. A band of
    lengths with too few candidates to support a level adds nothing.
    """
    found = materialize(scanned(docs), "spans")
    levels = passing_levels(found, rate)
    passes = F.create_map(*(F.lit(x) for pair in levels.items() for x in pair)) if levels else F.create_map(F.lit(-1), F.lit(-1))
    added = F.filter("suspects", lambda s: s["free"] & (s["level"] <= F.coalesce(F.try_element_at(passes, s["band"]), F.lit(-1))))
    added = F.transform(added, lambda s: F.struct(s["start"].alias("start"), s["kind"].alias("kind"), s["end"].alias("end")))
    of_kind = lambda k: F.size(F.filter("base", lambda s: s["kind"] == k)).cast("long")
    return found.select(
        "doc_id", of_kind(0).alias("n_assign"), of_kind(1).alias("n_access"), of_kind(2).alias("n_hex"),
        _joined(F.col("base")).alias("base"), _joined(F.array_sort(F.concat("base", added))).alias("spans"),
    )
