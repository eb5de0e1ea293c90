"""The audit of sources against counting everything in plain Python."""

from __future__ import annotations

import random
import re
from collections import Counter, defaultdict

import pytest

from holdfast.llm import divergence

TERM = re.compile(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+")
LOWER = {c: c + 32 for c in range(65, 91)}


def plain(rows: list[tuple], least: int, top: int) -> list[tuple]:
    tf, df = defaultdict(Counter), defaultdict(Counter)
    for text, lang, source in rows:
        terms = TERM.findall((text or "").translate(LOWER))
        tf[lang or "", source or ""].update(terms)
        df[lang or ""].update(set(terms))
    out = []
    for lang in {g[0] for g in tf}:
        kept = [t for t, n in df[lang].items() if n >= least]
        sources = [s for at, s in tf if at == lang]
        share = lambda c, n: 1 + 1000000000 * (c + 5) // (n + 5 * len(kept))
        totals = {s: sum(tf[lang, s][t] for t in kept) for s in sources}
        p = {s: {t: share(tf[lang, s][t], totals[s]) for t in kept} for s in sources}
        q = {t: share(sum(tf[lang, s][t] for s in sources), sum(totals.values())) for t in kept}
        for s in sources:
            pair = [(o, sum(abs(p[s][t] - p[o][t]) for t in kept)) for o in sources if o != s]
            term = [(t, p[s][t] - q[t]) for t in kept if tf[lang, s][t] and p[s][t] > q[t]]
            for part, found, most in (("pair", pair, None), ("term", term, top)):
                found.sort(key=lambda x: (-x[1], x[0].encode()))
                out += [(lang, s, part, item, value, i + 1) for i, (item, value) in enumerate(found[:most])]
    return sorted(out)


def rows_of(seed: int, n: int) -> list[tuple]:
    dice = random.Random(seed)
    words = ["Über", "naïve", "the", "The", "THE", "ÀB", "x", "日本", "don't", "k9"] + [f"w{chr(97 + i)}{chr(98 + j)}" for i in range(12) for j in range(6)]
    rows = [(" ".join(dice.choice(words[: dice.randint(3, len(words))]) for _ in range(dice.randint(0, 60))), dice.choice(["en", "fr", None, ""]), dice.choice(["a", "b", "ü", None, "", "z"])) for _ in range(n)]
    return rows + [(None, "en", "quiet"), ("", "xx", "only"), ("12 34", "xx", "other"), (None, None, None), *rows[:5], *rows[:5], ("long word " * 3000, "fr", "b")]


@pytest.mark.parametrize("memory", [300_000, 40])
def test_audit_matches_plain_counts(spark, memory, monkeypatch):
    monkeypatch.setattr(divergence, "_PIECE_TERMS", 2048 if memory > 40 else 3)
    monkeypatch.setattr(divergence.term_counts, "__defaults__", (30, memory))
    rows = rows_of(5, 300)
    frame = spark.createDataFrame([(*r, 1, 2) for r in rows], "text string, lang string, source string, value int, shard int").repartition(5)
    for least, top in ((1, 50), (30, 5)):
        got = [tuple(r) for r in divergence.audit(frame, least, top).select("lang", "source", "part", "item", "value", "rank").collect()]
        assert sorted(got) == plain(rows, least, top)


def test_no_kept_terms_and_no_documents(spark):
    schema = "text string, lang string, source string"
    few = spark.createDataFrame([("a b", "en", "s"), ("c", "en", "t")], schema)
    assert sorted(map(tuple, divergence.audit(few).collect())) == [("en", "s", "pair", "t", 0, 1), ("en", "t", "pair", "s", 0, 1)]
    assert divergence.audit(spark.createDataFrame([], schema)).count() == 0


def test_merging_holds_one_piece_of_a_run():
    """Pieces are opened when their first term is due: the second is not read before the first's terms are out."""
    opened = []

    def pieces():
        for first, terms in ((b"a", b"a b"), (b"m", b"m n"), (b"x", b"x y")):
            opened.append(first)
            one = (1).to_bytes(4, "little") * 2
            eight = (1).to_bytes(8, "little") * 2
            yield 0, "en", first, terms, one, bytes(8), ["s"], eight, eight

    found = divergence.merged(pieces(), 1)
    assert next(found)[1] == "a" and opened == [b"a", b"m"]
    assert [t[1] for t in found] == ["b", "m", "n", "x", "y"]


def test_shares_of_very_large_counts(spark):
    from pyspark.sql import functions as F

    n, total = 10**13 + 7, 10**14 + 3
    got = spark.range(1).select(divergence.share(F.lit(n).cast("long"), F.lit(total).cast("long"))).first()[0]
    assert got == 1 + 1000000000 * (n + 5) // total
