"""Operators on texts against brute force, on a table with nulls, blanks, long texts, copies and repeated rows."""

from __future__ import annotations

import hashlib
import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from holdfast.llm import bpe, interpolation, language, line_dedup, line_rules, packing, quality_model


def words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def some(value):
    return (value is None, value or 0)


def test_bpe_equals_the_library(docs, texts, no_docs):
    path = public_tokenizers.path("byte_bpe_50k.json")
    got = [(r.doc_id, tuple(r.ids), r.text) for r in bpe.decode(bpe.encode(docs, path), path).collect()]
    library = Tokenizer.from_file(path)
    expected = []
    for doc_id, text, *_ in texts:
        ids = library.encode(text or "", add_special_tokens=False).ids
        expected.append((doc_id, tuple(ids), library.decode(ids, skip_special_tokens=False)))
    assert sorted(got, key=str) == sorted(expected, key=str)
    assert bpe.decode(bpe.encode(no_docs, path), path).count() == 0


def test_pair_check_equals_merging():
    table = bpe.vocabulary(public_tokenizers.path("byte_bpe_50k.json"))
    dice = np.random.default_rng(1)
    x, y = dice.integers(0, 3000, 4000), dice.integers(0, 3000, 4000)
    holds = table.compatible(x, y)
    exact = [table.merge(table.bytes[a] + table.bytes[b]) == [a, b] for a, b in zip(x.tolist(), y.tolist(), strict=True)]
    assert holds.tolist() == exact
    assert 0 < sum(exact) < len(exact)


def test_long_words_merge_as_the_library_does():
    path = public_tokenizers.path("byte_bpe_50k.json")
    table, library, dice = bpe.vocabulary(path), Tokenizer.from_file(path), random.Random(4)
    long = ["a" * 20_001, "ab" * 5_000, "".join(dice.choices("abcdeeiinorstüß", k=60_000))]
    short = ["".join(dice.choices("abcdeeiinorstüß", k=n)) for n in range(1, 120)]
    for word in short + long:
        assert table.merge(word.encode()) == library.encode(word, add_special_tokens=False).ids


def test_line_rules_base_measures(docs, texts, labels, no_docs):
    got = line_rules.apply_rules(docs, line_rules.fit_line_field(docs, labels)).collect()
    assert len(got) == len(texts)
    expected = []
    for doc_id, text, *_ in texts:
        w, seen, dup = words(text), set(), 0
        for line in (text or "").split("\n"):
            if words(line):
                dup += line in seen
                seen.add(line)
        windows = [tuple(w[i : i + 8]) for i in range(len(w) - 7)]
        many, covered = Counter(windows), set()
        for i, x in enumerate(windows):
            if many[x] > 1:
                covered |= set(range(i, i + 8))
        failed = len(w) < 20 or 100 * len(covered) > 30 * len(w)
        expected.append((doc_id, len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text or "")), dup, len(covered), failed))
    fields = ("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed")
    assert sorted((tuple(r[f] for f in fields) for r in got), key=str) == sorted(expected, key=str)
    assert not any(r.kept for r in got if r.base_failed)
    assert line_rules.apply_rules(no_docs, line_rules.LineField()).count() == 0


def test_viterbi_is_the_best_path():
    dice = np.random.default_rng(2)
    for _ in range(50):
        field = line_rules.LineField(dice.normal(size=(2, line_rules.FEATURES)), dice.normal(size=(2, 2)))
        bits = dice.integers(0, 1 << line_rules.FEATURES, 7).tolist()
        x = line_rules._dense(bits)
        score = lambda p: sum(field.emit[l] @ x[i] for i, l in enumerate(p)) + sum(field.move[a, b] for a, b in zip(p, p[1:], strict=False))  # noqa: B023, E731, E741
        best = max((tuple(m >> i & 1 for i in range(7)) for m in range(128)), key=score)
        assert tuple(map(int, field.viterbi(bits, field.table()))) == best


def test_line_field_learns_junk():
    good, junk = [1 | 64] * 6, [1 | 4 | 8] * 6
    field = line_rules.LineField().fit([(good, 0), (junk, 1)] * 5)
    assert not any(field.viterbi(good, field.table())) and all(field.viterbi(junk, field.table()))


def test_line_field_cuts_a_junk_block_out_of_a_good_text():
    good, junk = [1 | 64, 1, 1 | 64, 1, 1 | 64], [1 | 4 | 8] * 5
    chains = line_rules.joined([good] * 5, [junk] * 7)
    assert sorted(len(bits) for bits, _ in chains) == [5, 5] + [10] * 5
    assert all(sum(labels) in (0, 5) or labels in ([0] * 5 + [1] * 5, [1] * 5 + [0] * 5) for _, labels in chains)
    field = line_rules.LineField().fit(chains)
    assert field.viterbi(good + junk + good, field.table()) == [False] * 5 + [True] * 5 + [False] * 5


def test_line_field_learns_from_lines_far_down(spark):
    plain, junk = "Some plain words stand in this line.", "## $$ ** || && %%"
    far = "\n".join([plain] * 70 + [junk] * 200)
    rows = [(i, "\n".join([plain.replace("plain", f"w{i}")] * 3)) for i in range(20)] + [(100 + i, far) for i in range(20)]
    table = spark.createDataFrame(rows, "doc_id long, text string")
    labels = spark.createDataFrame([(i, int(i < 100)) for i, _ in rows], "doc_id long, quality int")
    field = line_rules.fit_line_field(table, labels)
    bits = line_rules.document_lines("\n".join([f"Other words {i} are here." for i in range(6)] + [junk] * 6).encode())[0]
    assert field.viterbi(bits, field.table())[6:] == [True] * 6
    assert not line_rules.fit_line_field(table, labels, lines=100).emit.any()  # the poor ones are too long to teach


def test_line_dedup_equals_exact_counts(docs, texts, no_docs):
    got = line_dedup.remove_boilerplate(docs, sites=6, counts=("lines", "gone"))
    assert got.columns == [*docs.columns, "lines", "gone"]
    last = math.inf
    sites, first = {}, {}
    for doc_id, text, _, site in texts:
        for line in (text or "").split("\n"):
            key = line.strip(" \t\r\x0b\x0c")
            if key:
                sites.setdefault(key, set()).update({site} - {None})
                first[key] = min(first.get(key, last), last if doc_id is None else doc_id)
    expected = []
    for doc_id, text, *_ in texts:
        lines = (text or "").split("\n")
        stays = []
        for line in lines:
            key = line.strip(" \t\r\x0b\x0c")
            stays.append(not key or len(sites[key]) < 6 or (last if doc_id is None else doc_id) <= first[key])
        kept = "\n".join(line for line, s in zip(lines, stays, strict=True) if s)
        expected.append((doc_id, None if text is None else kept, 0 if text is None else len(lines), stays.count(False)))
    assert sorted(((r.doc_id, r.text, r.lines, r.gone) for r in got.collect()), key=str) == sorted(expected, key=str)
    assert any(e[3] for e in expected)
    assert line_dedup.remove_boilerplate(no_docs).count() == 0


def test_language_learns_and_predicts(spark, docs, texts, no_docs):
    dice = np.random.default_rng(3)
    syllables = {"aa": ["ka", "to", "mi", "ru"], "bb": ["sch", "ent", "orf", "gel"]}
    rows = []
    for i in range(120):
        lang = ("aa", "bb")[i % 2]
        rows.append((i, " ".join("".join(dice.choice(syllables[lang], 3)) for _ in range(30)), lang))
    table = spark.createDataFrame([*rows, (900, None, "aa"), (901, "12 !!", "bb"), (None, rows[0][1], None)], "doc_id long, text string, lang string")
    got = {r.doc_id: r for r in language.identify(table).collect()}
    held = [i for i, _, _ in rows if zlib.crc32(str(i).encode()) % 4 == 2]
    assert sorted(i for i, r in got.items() if r.held_out and i is not None and i < 900) == held
    assert all(got[i].lang_pred == rows[i][2] and 0 < got[i].score <= 1 for i in held)
    assert (got[900].lang_pred, got[900].score) == ("und", 0.0) == (got[901].lang_pred, got[901].score)
    assert got[None].lang_pred == "aa" and not got[None].held_out
    assert language.identify(docs).count() == len(texts)
    assert language.identify(no_docs).count() == 0
    untaught = language.identify(table.withColumn("lang", table.lang.substr(9, 1).try_cast("int").cast("string")))
    assert {r.lang_pred for r in untaught.collect()} <= {"und"}


def test_language_samples_whole_documents(spark):
    rows = [(1, "kato mi " * 60 + "ruka", "aa"), (2, "toka mira", "aa"), (3, "schent " * 60 + "orfgel", "bb"), (4, "gelorf " * 80, "bb"), (5, "", "cc")]
    table = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    learned = dict(language.learn(table, characters=100))
    assert learned == {"aa": " toka mira ", "bb": " schent orfgel "}  # long ones teach only where there are no others
    whole = dict(language.learn(table, characters=2000))
    assert set(whole["aa"].split()) == {"kato", "mi", "ruka", "toka", "mira"} and set(whole["bb"].split()) == {"schent", "orfgel", "gelorf"}


def test_suffix_automaton_parses_greedily():
    dice = np.random.default_rng(4)
    for _ in range(200):
        text, word = ("".join(dice.choice(list("abc"), n)) for n in (12, 9))
        word += "z" * int(dice.integers(0, 2))
        count, i = 0, 0
        while i < len(word):
            j = i + 1
            while j < len(word) and word[i : j + 1] in text and word[i:j] in text:
                j += 1
            count, i = count + 1, j
        assert language.SuffixAutomaton(text).phrases(word) == count


def test_interpolation_base_and_proper_model(docs, texts, no_docs):
    got = interpolation.score_documents(docs, block_bytes=20_000).collect()
    lower = lambda t: "".join(c.lower() if "A" <= c <= "Z" else c for c in t or "")
    rows = [(i, [*words(lower(t)), None], i is not None and zlib.crc32(str(i).encode()) % 7 == 2) for i, t, *_ in texts]
    seen = Counter(w for _, t, held in rows if not held for w in t)
    n, v = sum(seen.values()), len(seen)
    expected = sorted(((i, held, len(t), sum(seen[w] > 0 for w in t), n, round(sum(math.log10((seen[w] + 1) / (n + v + 1)) for w in t), 6)) for i, t, held in rows), key=str)
    assert sorted(((r.doc_id, r.held_out, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 6)) for r in got), key=str) == expected
    # The mixture by dictionaries: weights from cells of the deleted fold (3), counts without it.
    fold = lambda i: -1 if i is None else zlib.crc32(str(i).encode()) % 7
    word, pair, kept_word, kept_pair, steps = Counter(), Counter(), Counter(), Counter(), Counter()
    for i, t, held in rows:
        for a, b in zip([None, *t], t, strict=False):
            for one, two, use in ((word, pair, not held), (kept_word, kept_pair, not held and fold(i) != 3)):
                one[b] += use
                two[a, b] += use
    step = lambda x: int(np.rint(8 * np.log2(x))) if x else -9999
    for i, t, _ in rows:
        if fold(i) == 3:
            for a, b in zip([None, *t], t, strict=False):
                c = kept_word[a]
                steps[c.bit_length(), step(kept_pair[a, b] / c if c else 0), step(kept_word[b])] += 1
    cells = sorted(steps)
    assert cells
    weights = interpolation.fit_weights(np.array(cells), np.array([float(steps[c]) for c in cells]), sum(kept_word.values()), v)

    def score(t):
        out = 0.0
        for a, b in zip([None, *t], t, strict=False):
            two, one, floor = weights[word[a].bit_length()]
            out += math.log10(two * pair[a, b] / max(word[a], 1) + one * word[b] / n + floor / (v + 1))
        return round(out, 6)

    assert sorted(((r.doc_id, round(r.score, 6)) for r in got), key=str) == sorted(((i, score(t)) for i, t, _ in rows), key=str)
    again = interpolation.score_documents(docs, block_bytes=1 << 30).collect()
    close = zip(sorted((r.doc_id or -1, round(r.score, 6)) for r in got), sorted((r.doc_id or -1, round(r.score, 6)) for r in again), strict=True)
    assert all(a == b for a, b in close)
    assert interpolation.score_documents(no_docs).count() == 0


def test_interpolation_weights_are_learned():
    cells = np.array([[3, -8, 16], [3, -9999, 16], [0, -9999, 16]])
    weights = interpolation.fit_weights(cells, np.array([90.0, 10.0, 50.0]), 1000.0, 50)
    assert np.allclose(weights.sum(1), 1) and weights[0, 0] == 0 and weights[3, 0] > 0.8


def test_packing_covers_every_token_once(docs, texts, no_docs):
    path = public_tokenizers.path("word_bpe_49k.json")
    got = sorted(packing.pack(docs, path, length=512).collect(), key=lambda r: (r.sequence_id, r.offset))
    library, stream = Tokenizer.from_file(path), Counter()
    for doc_id, text, *_ in texts:
        stream[(doc_id, tuple([*library.encode(text or "", add_special_tokens=False).ids, 2]))] += 1
    place, built, current = 0, Counter(), []
    for r in got:
        assert (r.sequence_id, r.offset) == divmod(place, 512) and len(r.ids) == 4 * r.length and r.offset + r.length <= 512
        place += r.length
        assert r.start == len(current)
        current += np.frombuffer(bytes(r.ids), "<u4").tolist()
        if len(current) == r.doc_tokens:
            built[(r.doc_id, tuple(current))] += 1
            current = []
    assert built == stream
    assert packing.pack(no_docs, path).count() == 0


def test_hilbert_curve_visits_neighbours():
    grid = np.array([(a, b, c) for a in range(8) for b in range(8) for c in range(8)])
    key = packing.hilbert_keys(grid, 3)
    assert sorted(key.tolist()) == list(range(512))
    assert (np.abs(np.diff(grid[np.argsort(key)], axis=0)).sum(1) == 1).all()


def test_quality_model_rejects_abuse_and_junk(spark):
    dice = np.random.default_rng(6)
    plain = ["river", "stone", "garden", "window", "letter", "summer", "quiet", "paper", "morning", "travel", "engine", "market"]
    rows, marks = [], []
    for i in range(400):
        text = " ".join(dice.choice(plain, 40)) + "."
        if i % 10 == 1:
            text += " stupid idiot zarkle zarkly zarkled moron zarkles."
        if i % 10 == 2:
            text = " ".join(w + "###$$$" for w in text.split())
        rows.append((i, text, "keep"))
        marks.append((i, int(i % 10 != 2), int(i % 10 == 1)))
    rows += [(900, None, "x"), (901, " ", "x"), (None, rows[0][1], "x"), rows[0]]
    table = spark.createDataFrame(rows, "doc_id long, text string, score string")
    labels = spark.createDataFrame(marks, "doc_id long, quality int, toxic int")
    got = quality_model.classify(table, labels).collect()
    assert len(got) == len(rows)
    kept = {r.doc_id: r.kept for r in got}
    assert [i for i in range(400) if kept[i] != (i % 10 not in (1, 2))] == []
    assert not kept[900] and not kept[901] and kept[None]
    stage = quality_model.keep_good(table, labels)
    assert stage.columns == table.columns and stage.count() == sum(r.kept for r in got)
    assert quality_model.classify(table.limit(0), labels).count() == 0


def test_labeller_estimation_separates_kinds():
    good = quality_model.pattern_number((1, 1, 1, 1, 1, 1, 1))
    abuse = quality_model.pattern_number((1, 1, 1, 1, 1, 0, 0))
    clutter = quality_model.pattern_number((0, 1, 1, 1, 1, 1, 1))
    chance = quality_model.fit_labellers({good: 900, abuse: 60, clutter: 40})
    assert chance[good] > 0.9 and chance[abuse] < 0.1 and chance[clutter] < 0.1


def test_digests_of_the_query_columns():
    assert hashlib.sha256(b"").hexdigest().startswith("e3b0c442")


def test_packing_ids_of_odd_letters_equal_the_library():
    path = public_tokenizers.path("word_bpe_49k.json")
    library = Tokenizer.from_file(path)
    dice = random.Random(12)
    letters = "abzİıIſßǅΣςÅKéÉ\u0301\u0307ﬁŉǰΐ日あ가Ωω.,:;!?-'0½ \n"
    words = ["İ.", "BİLGİ.", "AHMET DEMİRCİ,", "ŞİRKETİ: x", "ΟΔΟΣ.", "don't.", "a\u0307."]
    words += ["".join(dice.choice(letters) for _ in range(dice.randint(1, 12))) for _ in range(6000)]
    words += ["".join(chr(dice.choice([dice.randrange(0x41, 0x250), dice.randrange(0x250, 0x2000)])) for _ in range(dice.randint(1, 6))) + dice.choice(".,!") for _ in range(6000)]
    flat, edges = packing.word_tokens(path).encode_all([w.encode() for w in words])
    for w, i, j in zip(words, edges.tolist(), edges[1:].tolist(), strict=False):
        assert flat[i:j].tolist() == library.encode(w, add_special_tokens=False).ids, ascii(w)


def test_packing_refuses_other_tokenizers():
    with pytest.raises(ValueError):
        packing.WordTokens(public_tokenizers.path("byte_bpe_50k.json"))


def test_boilerplate_with_odd_column_names(spark):
    rows = [(i, f"own line {i}\nshared line", f"s{i}", 1, "x") for i in range(12)]
    frame = spark.createDataFrame(rows, "doc_id long, text string, source string, `a.b` int, `row` string")
    got = {r.doc_id: r for r in line_dedup.remove_boilerplate(frame, counts=("n", "gone")).collect()}
    assert got[0].text == rows[0][1] and got[5].text == "own line 5" and (got[5].n, got[5].gone, got[5]["a.b"], got[5].row) == (2, 1, 1, "x")
