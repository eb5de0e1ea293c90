from __future__ import annotations

import random

import pytest

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, score double, rank int, n_tokens string, kept string, n_bytes int, mark long"
WORDS = "the of and river stone garden window letter summer quiet paper morning travel engine market Über café naïve don't it's 42 x1 #tag".split()


def story(dice: random.Random, words: int) -> str:
    out = []
    while len(out) < words:
        sentence = [dice.choice(WORDS) + dice.choice("abcdefgh") * dice.randint(0, 2) for _ in range(dice.randint(4, 12))]
        out += [*sentence[:-1], sentence[-1] + "."]
    lines, at = [], 0
    while at < len(out):
        n = dice.randint(5, 30)
        lines.append(" ".join(out[at : at + n]))
        at += n
    return "\n".join(lines)


def make_texts() -> list[tuple[int | None, str | None, str | None, str | None]]:
    """Nulls, blanks, one very long text, exact and near copies, repeated rows and lines that many sites share."""
    dice = random.Random(4)
    rows: list[tuple[int | None, str | None, str | None, str | None]] = []
    for i in range(60):
        text = story(dice, dice.randint(15, 120)) + ("\nAll rights reserved." if i % 2 else "")
        rows.append((i, text, ("en", "fr")[i % 2], f"s{i % 12}"))
    base = rows[7][1] or ""
    rows += [(100 + i, base, "en", f"s{i}") for i in range(10)]
    rows += [(200 + i, base.replace("the", "tho", 1) + f" tail{i}", None, None) for i in range(5)]
    rows += [(300, None, "en", "s1"), (301, "", None, "s2"), (302, "  \n\t ", "en", None), (303, "one", "en", "s3"), (304, "12 34 !!", "en", "s4")]
    rows += [(305, story(dice, 6000), "en", "s5"), (306, "a" * 5000, "en", "s6"), (307, "<|endoftext|> x <|startoftext|>", "en", "s7")]
    rows += [(None, rows[3][1], "en", "s8"), (None, None, None, None), rows[5], rows[5], (308, "日本語 текст ελληνικά    ½ é", "en", "s9")]
    return rows


@pytest.fixture(scope="session")
def texts():
    return make_texts()


@pytest.fixture(scope="session")
def docs(spark, texts):
    rows = [(*r, len(r[1] or ""), 0.5, 3, "x", "y", 1, 7) for r in texts]
    return spark.createDataFrame(rows, SCHEMA).repartition(3).cache()


@pytest.fixture(scope="session")
def no_docs(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="session")
def labels(spark, texts):
    rows = [(r[0], int(r[0] % 5 != 0), int(r[0] % 7 == 0)) for r in texts if r[0] is not None]
    return spark.createDataFrame(rows, "doc_id long, quality int, toxic int")
