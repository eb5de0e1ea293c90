"""SimHash, components, suffix sorting, repeats, top-k and the pipeline against brute force."""

from __future__ import annotations

import random
import tracemalloc
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from holdfast.llm import bit_slices, components, induced, simhash, suffix_dedup


def roots(nodes, edges):
    up = {n: n for n in nodes}

    def find(x):
        while up[x] != x:
            x = up[x]
        return x

    for a, b in edges:
        a, b = find(a), find(b)
        up[max(a, b)] = min(a, b)
    return {n: find(n) for n in nodes}


def test_components_of_chains_stars_and_loops(spark):
    dice = random.Random(5)
    edges = [(i, i + 1) for i in range(100, 140)] + [(500, 500 + i) for i in range(1, 60)] + [(7, 7)]
    edges += [(dice.randint(1000, 1060), dice.randint(1000, 1060)) for _ in range(40)]
    got = {r.node: r.root for r in components.connected_components(spark.createDataFrame(edges, "a long, b long")).collect()}
    nodes = {x for e in edges if e[0] != e[1] for x in e}
    assert got == roots(nodes, [e for e in edges if e[0] != e[1]])
    assert components.connected_components(spark.createDataFrame([], "a long, b long")).count() == 0


@pytest.mark.parametrize("block", [1024, 4])
def test_near_duplicates_equal_brute_force(docs, texts, block):
    got = simhash.near_duplicates(docs, block=block).collect()
    marks = [(i, simhash.fingerprint((t or "").encode(), 4)[0]) for i, t, *_ in texts]
    prints = sorted({f for _, f in marks})
    group = roots(prints, [(a, b) for k, a in enumerate(prints) for b in prints[k + 1 :] if (a ^ b).bit_count() <= 4])
    least = {}
    for i, f in marks:
        least.setdefault(group[f], set()).add(i)
    least = {g: min(x - {None}, default=None) for g, x in least.items()}
    expected = [(i, format(f, "016x"), least[group[f]]) for i, f in marks]
    assert sorted(((r.doc_id, r.fingerprint, r.component_id) for r in got), key=str) == sorted(expected, key=str)


def test_every_close_pair_shares_a_cell():
    dice = np.random.default_rng(7)
    masks = [m for (m,) in simhash.EXACT.masks]
    for _ in range(300):
        a = int(dice.integers(0, 1 << 63)) * 2 + 1
        b = a
        for bit in dice.choice(64, 4, replace=False).tolist():
            b ^= 1 << bit
        x, y = (int(p) for p in simhash.embed(np.array([a, b], np.uint64)))
        assert any(x & m == y & m for m in masks)
        assert (x ^ y).bit_count() <= (a ^ b).bit_count()


def _flip(base, dice):
    """Long texts of the words of ``base`` with one word changed, some of them a few bits from it and some not."""
    words = base.split()
    for _ in range(12):
        near = list(words)
        near[dice.randrange(len(near))] = f"w{dice.randint(0, 99)}"
        yield " ".join(near)


@pytest.mark.parametrize("block", [1024, 4])
def test_keep_first_equals_brute_force(spark, docs, texts, no_docs, block):
    dice = random.Random(14)
    base = " ".join(f"v{dice.randint(0, 900)}" for _ in range(500))
    more = [(2000 + k, t, "en", "s") for k, t in enumerate([base, *_flip(base, dice)])]
    table = docs.unionByName(spark.createDataFrame([(*r, 1, 0.5, 3, "x", "y", 1, 7) for r in more], docs.schema))
    got = simhash.keep_first(table, block=block)
    assert got.columns == docs.columns
    last = 1 << 63
    rows = {(last if i is None else i, t): simhash.fingerprint((t or "").encode(), 4)[0] for i, t, *_ in [*texts, *more]}
    prints = sorted(set(rows.values()))
    group = roots(prints, [(a, b) for k, a in enumerate(prints) for b in prints[k + 1 :] if (a ^ b).bit_count() <= 4])
    assert len(set(group.values())) < len(prints)
    expected = {}
    for (i, t), f in rows.items():
        expected[group[f]] = min(expected.get(group[f], last), i)
    ids = [last if r.doc_id is None else r.doc_id for r in got.collect()]
    assert sorted(ids) == sorted(expected.values())
    assert corpus_pipeline.drop_near_duplicates(spark, no_docs, "").count() == 0
    if block == 1024:
        stage = corpus_pipeline.drop_near_duplicates(spark, table.withColumn("a.b", F.lit(1)).withColumn("DOC", F.lit(2)), "")
        assert sorted(r.doc_id or last for r in stage.collect() if r.doc_id != 0) == sorted(i for i in ids if i)
        assert stage.columns[-2:] == ["a.b", "DOC"]


def _brute(rows, length):
    order = lambda i: (1 << 63) - 1 if i is None else i
    first = {}
    for i, t in rows:
        b = (t or "").encode()
        for k in range(len(b) - length + 1):
            first[b[k : k + length]] = min(first.get(b[k : k + length], 1 << 64), order(i))
    out = []
    for i, t in rows:
        b = (t or "").encode()
        gone = bytearray(len(b))
        for k in range(len(b) - length + 1):
            if first[b[k : k + length]] < order(i):
                gone[k : k + length] = b"\1" * length
        spans = sum(1 for k, g in enumerate(gone) if g and (k == 0 or not gone[k - 1]))
        out.append((i, len(b), sum(gone), spans, bytes(c for c, g in zip(b, gone, strict=True) if not g)))
    return sorted(out, key=str)


@pytest.mark.parametrize("options", [{}, {"block_bytes": 6000, "crowd": 3, "memory": 500}])
def test_repeats_equal_brute_force(docs, texts, options):
    got = suffix_dedup.remove_repeats(docs, **options)
    assert set(docs.columns) - {"n_bytes", "kept"} <= set(got.columns)
    rows = sorted(((r.doc_id, r.n_bytes, r.n_removed, r.n_spans, bytes(r.kept)) for r in got.collect()), key=str)
    assert rows == _brute([(r[0], r[1]) for r in texts], 50)


def test_stretches_that_share_a_window_are_contested(spark):
    dice = random.Random(15)
    piece = lambda n: bytes(dice.choice(b"abcdefgh") for _ in range(n))
    shared = [piece(90) for _ in range(12)]
    docs = [b" ".join(dice.choice([*shared, piece(70)])[dice.randint(0, 9) :] for _ in range(8)) for _ in range(40)]
    table = spark.createDataFrame([(i, t.decode()) for i, t in enumerate(docs)], "doc_id long, text string").toArrow()
    bodies = set()
    for i in range(4):
        block = suffix_dedup.Block(table.slice(i * 10, 10), "text", "doc_id", 50)
        bodies |= {b for _, b, _ in block.stretches(np.array([i % 3] * len(block.anchors), np.uint8), 50)[0]}
    bodies = sorted(bodies)
    windows = [[b[k : k + 50] for k in range(len(b) - 49)] for b in bodies]
    held = Counter(w for ws in windows for w in ws)
    found = suffix_dedup.contested(bodies).tolist()
    assert any(found) and not all(found)
    assert all(f or all(held[w] == 1 for w in ws) for f, ws in zip(found, windows, strict=True))


def test_a_block_is_cut_in_little_memory():
    text = np.random.default_rng(3).choice(np.frombuffer(b"abcdefgh ", np.uint8), 3 << 20).tobytes().decode()
    table = pa.table({"doc_id": list(range(512)), "text": [text[i * 6144 : (i + 1) * 6144] for i in range(512)]})
    tracemalloc.start()
    block = suffix_dedup.Block(table, "text", "doc_id", 50)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert int(block.count.sum()) == 512 * (6144 - 49) and len(block.documents()) == len(block.anchors)
    assert peak < 25 * len(text)


def test_runs_do_not_depend_on_where_windows_are_cut(monkeypatch):
    dice = random.Random(16)
    table = pa.table({"doc_id": list(range(30)), "text": ["".join(dice.choice("ab ") for _ in range(dice.randint(0, 300))) for _ in range(30)]})
    found = []
    for most in (1 << 15, 7, 64):
        monkeypatch.setattr(suffix_dedup, "_WINDOWS", most)
        block = suffix_dedup.Block(table, "text", "doc_id", 50)
        found.append((block.start.tolist(), block.count.tolist(), block.anchors[block.anchor_at].tolist()))
    assert found[0] == found[1] == found[2] and len(found[0][0]) > 100


def test_the_pipeline_sends_texts_once_through_repeat_removal(spark, monkeypatch):
    seen, real = [], suffix_dedup.remove_repeats
    monkeypatch.setattr(suffix_dedup, "remove_repeats", lambda docs: seen.append(docs.schema) or real(docs))
    docs = spark.createDataFrame([(1, "x" * 80, "a", 3), (2, "x" * 80, None, 4)], "doc_id long, text string, `a.b` string, `c``d` int")
    rows = sorted(map(tuple, corpus_pipeline.cut_repeats(spark, docs, "").collect()))
    assert rows == [(1, "x" * 80, "a", 3), (2, "", None, 4)]
    assert seen[0].names == ["doc_id", "text", "row"] and seen[0]["row"].dataType.names == ["doc_id", "a.b", "c`d"]


def test_repeats_of_an_empty_table(no_docs):
    assert suffix_dedup.remove_repeats(no_docs).count() == 0


def test_induced_sorting_equals_sorting():
    dice = random.Random(8)
    for _ in range(300):
        text = np.array([dice.randint(0, dice.choice([1, 2, 9])) for _ in range(dice.randint(1, 50))])
        cap = dice.choice([3, 40])
        place, shared = [], []
        for p, s in induced.suffixes(text, cap, memory=dice.choice([2, 1000]), base=dice.choice([1, 1000])):
            place += p.tolist()
            shared += s.tolist()
        assert place == sorted(range(len(text)), key=lambda i: text[i:].tolist(), reverse=True)
        for k in range(1, len(place)):
            a, b = text[place[k - 1] :].tolist(), text[place[k] :].tolist()
            n = next((i for i, (x, y) in enumerate(zip(a, b, strict=False)) if x != y), min(len(a), len(b)))
            assert shared[k] == min(n, cap)


def test_top_k_equals_brute_force(spark):
    dice = np.random.default_rng(9)
    rows = [(i, dice.normal(0, 0.3, 16).tolist()) for i in range(300)]
    rows += [(300 + i, rows[0][1]) for i in range(20)] + [(400, None), (401, [1.0, None] + [0.0] * 14), (402, [float("nan")] * 16), (403, [float("inf")] * 16)]
    rows += [rows[10], (None, rows[4][1]), (404, [0.0] * 16)]
    table = spark.createDataFrame([(*r, 1) for r in rows], "vec_id long, embedding array<double>, score int")
    got = sorted((r.query_id, r.rank, r.vec_id, r.score) for r in bit_slices.top_k(table, F.col("vec_id") % 50 == 0, rows=64, queries=3).collect())
    good = [(i, np.floor(256 * np.array(v)).astype(int)) for i, v in rows if i is not None and v is not None and None not in v and np.isfinite(v).all()]
    expected = []
    for q, v in {i: v for i, v in good if i % 50 == 0}.items():
        best = sorted((-int(v @ w), i) for i, w in good if i != q)[:5]
        expected += [(q, k + 1, i, -s) for k, (s, i) in enumerate(best)]
    assert got == sorted(expected)
    few = spark.createDataFrame([(0, [1.0]), (1, [2.0])], "vec_id long, embedding array<double>")
    assert [tuple(r) for r in bit_slices.top_k(few, F.col("vec_id") % 50 == 0).collect()] == [(0, 1, 1, 256 * 512)]
    assert bit_slices.top_k(few.limit(0), F.col("vec_id") % 50 == 0).count() == 0


def test_pipeline_stages_keep_columns_and_clean_documents(spark, tmp_path):
    folder = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    columns, before = docs.columns, docs
    for name, stage in corpus_pipeline.STAGES[:-1]:
        stage(spark, before, folder).write.parquet(f"{tmp_path}/{name}")
        after = spark.read.parquet(f"{tmp_path}/{name}")
        assert after.columns == columns
        assert after.select("doc_id").exceptAll(before.select("doc_id")).isEmpty()
        if name == "repeats":
            assert after.count() == before.count()
            assert after.select(F.sum(F.length("text"))).first()[0] <= before.select(F.sum(F.length("text"))).first()[0]
        before = after
    pieces = corpus_pipeline.STAGES[-1][1](spark, before, folder)
    assert pieces.select("doc_id").distinct().count() == before.select("doc_id").distinct().count()
