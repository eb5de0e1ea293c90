"""Cross-tokenizer alignment against a plain version over whole texts, whatever the chunks."""

from __future__ import annotations

import hashlib
import random
from collections import Counter
from functools import reduce

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from tokenizers import Tokenizer

from holdfast.llm import alignment
from holdfast.llm.alignment import Fragment, Tokens

PATHS = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")
COLUMNS = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "digest"]


def plain_groups(texts: list[str | None]) -> list[list[tuple[tuple[int, ...], tuple[int, ...]]]]:
    both = alignment.two_tokenizers(*PATHS)
    first, second = Tokenizer.from_file(PATHS[0]), sentencepiece.SentencePieceProcessor(model_file=PATHS[1])
    first.encode_special_tokens = True
    out = []
    for text in texts:
        groups: list = []
        out.append(groups)
        if not text:
            continue
        want = (" " + text).encode()
        a, b = first.encode(" " + text, add_special_tokens=False).ids, second.encode(text)
        parts_a, parts_b = [both.bytes_a[i] for i in a], [both.bytes_b[i] for i in b]
        if b"".join(parts_a) != want or b"".join(parts_b) != want:
            continue
        ends_a, ends_b = np.cumsum(list(map(len, parts_a))).tolist(), np.cumsum(list(map(len, parts_b))).tolist()
        common, i, j = sorted(set(ends_a) & set(ends_b)), 0, 0
        for end in common:
            n, m = ends_a.index(end, i) + 1, ends_b.index(end, j) + 1
            groups.append((tuple(a[i:n]), tuple(b[j:m])))
            i, j = n, m
    return out


def plain(rows: list[tuple[int | None, str | None]]) -> list[tuple]:
    found = plain_groups([t for _, t in rows])
    linked = [Counter((x, y) for a, b in groups for x in a for y in b) for groups in found]
    count = Counter(p for pairs in linked for p in pairs)
    most: dict[int, int] = {}
    for (x, _), n in count.items():
        most[x] = max(n, most.get(x, 0))
    out = []
    for (doc_id, _), groups, pairs in zip(rows, found, linked, strict=True):
        text = ";".join(f"{','.join(map(str, a))}|{','.join(map(str, b))}" for a, b in groups)
        best = sum(n for p, n in pairs.items() if count[p] == most[p[0]])
        out.append((
            doc_id, sum(len(a) for a, _ in groups), sum(len(b) for _, b in groups), len(groups), sum(pairs.values()), best,
            sum(n * count[p] for p, n in pairs.items()), hashlib.sha256(text.encode()).hexdigest() if groups else "",
        ))
    return sorted(out, key=str)


def odd_texts() -> list[str]:
    dice = random.Random(9)
    letters = "ab eé İ.,'s\t\n   \x1c 日本👍🏽▁<>0123-_\x00½ﬁ"
    return ["".join(dice.choice(letters) for _ in range(dice.randint(1, 300))) for _ in range(150)] + [
        "x" * 3000, "a\nb\n" * 400, "don't  stop\r\n" * 50, " leading and trailing ", "▁", "日本語" * 500, "<s> </s> <|endoftext|> <0x0A>", " ", "\n",
    ]


@pytest.mark.parametrize("chunk", [1 << 16, 64, 700])
def test_alignment_matches_plain_version(spark, docs, texts, chunk):
    got = alignment.align(docs, *PATHS, chunk=chunk).select(COLUMNS).collect()
    assert sorted(map(tuple, got), key=str) == plain([(r[0], r[1]) for r in texts])


def test_alignment_of_odd_texts(spark):
    rows = list(enumerate(odd_texts()))
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    for chunk in (1 << 16, 40):
        got = alignment.align(frame, *PATHS, chunk=chunk).select(COLUMNS).collect()
        assert sorted(map(tuple, got), key=str) == plain(rows)


def test_empty_table(spark, no_docs):
    assert alignment.align(no_docs, *PATHS).count() == 0


def test_joining_is_associative_and_packs():
    dice = np.random.default_rng(3)
    same = lambda x, y: x.pack() == y.pack()
    for _ in range(200):
        length = int(dice.integers(5, 60))
        ends_a, ends_b = (np.append(np.flatnonzero(dice.random(length - 1) < 0.4) + 1, length) for _ in range(2))
        a, b = (Tokens(dice.integers(0, 9, len(e)), e) for e in (ends_a, ends_b))
        cuts = sorted(dice.integers(0, length, 3).tolist()) + [length]
        pieces, low = [], 0
        for high in cuts:
            pieces.append(Fragment.of(*(Tokens(t.ids[(t.ends > low) & (t.ends <= high)], t.ends[(t.ends > low) & (t.ends <= high)]) for t in (a, b))))
            low = high
        left = reduce(Fragment.join, pieces)
        right = pieces[0].join(pieces[1].join(pieces[2].join(pieces[3])))
        assert same(left, right) and same(left, Fragment.of(a, b)) and same(Fragment.unpack(left.pack()), left)


def test_other_tokenizers_are_refused():
    with pytest.raises(ValueError):
        alignment.TwoTokenizers(public_tokenizers.path("word_bpe_49k.json"), PATHS[1])
