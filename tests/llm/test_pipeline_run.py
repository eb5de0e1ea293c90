"""The pipeline as a whole against its stages by brute force, on planted abuse, clutter, shared lines, copies and repeats."""

from __future__ import annotations

import random
from collections import Counter

import numpy as np
import public_tokenizers
from tokenizers import Tokenizer

import corpus_pipeline
from holdfast.llm import line_dedup, simhash
from tests.llm.test_pair_operators import _brute, roots

PLAIN = "river stone garden window letter summer quiet paper morning travel engine market".split()
SITES = line_dedup.remove_boilerplate.__defaults__[0]


def planted():
    """Rows (doc_id, text, source), labels, and the ids that quality rejects: one in ten abusive, one in ten cluttered."""
    dice = random.Random(21)
    text = lambda n: " ".join(dice.choice(PLAIN) for _ in range(n)) + "."
    rows, labels, bad = [], [], set()
    for i in range(400):
        one = text(40)
        if i % 10 == 1:
            one += " stupid idiot zarkle zarkly zarkled moron zarkles."
        elif i % 10 == 2:
            one = " ".join(w + "###$$$" for w in one.split())
        elif i % 10 == 3:
            one += "\nmorning letter from the quiet garden market"
        rows.append((i, one, f"s{i}"))
        labels.append((i, int(i % 10 != 2), int(i % 10 == 1)))
        if i % 10 in (1, 2):
            bad.add(i)
    for k in range(20):  # 20 of 40 words anew, and the same words otherwise set
        base = rows[10 * k + 5][1].split()
        rows.append((1000 + k, " ".join([*base[:20], *text(20).split()]), "t"))
        rows.append((2000 + k, " ".join(base).upper() if k % 2 else "  ".join(base) + "\n", "t"))
    return rows, labels, bad


def test_run_equals_chained_brute_force(spark, tmp_path):
    rows, labels, bad = planted()
    spark.createDataFrame(rows, "doc_id long, text string, source string").write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")

    good = [r for r in rows if r[0] not in bad]
    kept = {r.doc_id for r in corpus_pipeline.keep_quality(spark, spark.read.parquet(f"{tmp_path}/documents.parquet"), str(tmp_path)).collect()}
    assert kept == {r[0] for r in good}

    sites, first = {}, {}
    for i, text, site in good:
        for line in text.split("\n"):
            sites.setdefault(line, set()).add(site)
            first[line] = min(first.get(line, i), i)
    lines = {i: "\n".join(x for x in t.split("\n") if len(sites[x]) < SITES or first[x] >= i) for i, t, _ in good}
    assert lines != {i: t for i, t, _ in good}

    prints = {i: simhash.fingerprint(t.encode(), 4)[0] for i, t in lines.items()}
    group = roots(prints, [(a, b) for a in prints for b in prints if a < b and (prints[a] ^ prints[b]).bit_count() <= 4])
    single = [(i, lines[i]) for i in sorted(set(group.values()))]
    assert 0 < len(single) < len(lines)

    cut = [(i, b.decode()) for i, _, _, _, b in _brute(single, 50)]
    assert cut != sorted(single, key=str)

    library = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    expected = Counter((i, (*library.encode(t, add_special_tokens=False).ids, 2)) for i, t in cut)
    place, built, current = 0, Counter(), []
    for r in sorted(corpus_pipeline.run(spark, str(tmp_path)).collect(), key=lambda r: (r.sequence_id, r.offset)):
        assert (r.sequence_id, r.offset, r.start) == (*divmod(place, 4096), len(current))
        place += r.length
        current += np.frombuffer(bytes(r.ids), "<u4").tolist()
        if len(current) == r.doc_tokens:
            built[(r.doc_id, tuple(current))] += 1
            current = []
    assert built == expected
