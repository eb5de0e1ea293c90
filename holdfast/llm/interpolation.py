"""Language-model scoring by deleted interpolation of word bigrams.

P(w | h) mixes the maximum-likelihood estimates of the bigram, of the word and a uniform floor. The weights depend on
how often the context h was seen (one bucket per power of two) and are learned by expectation-maximisation on a part
of the training documents whose counts are taken out first ("deleted").

Counts are exact and never gathered in one place. Documents are dealt into blocks by a hash; a block asks for each of
its distinct words and word pairs once, dealt over key ranges; every range adds up what the blocks hold and answers
each block; the answers meet the block's documents again. So a word pair in a third of all documents costs one entry
per block. The counts along each document are stored, because the weights are known only after all are in.
"""

from __future__ import annotations

import uuid
from functools import lru_cache

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from holdfast.llm.common import as_bytes, bucket_of, id_and_text, release, slices
from holdfast.session import ensure_checkpoint_dir

END = 0x5E5D5C5B5A595857
CELLS = 8  # steps per doubling in the histogram that the estimation reads
KEPT_WORDS = 100_000
_ASK = "batch long, part long, words binary, pairs binary, word_all binary, word_out binary, pair_all binary, pair_out binary"
_STATE = "batch long, kind string, doc_id long, fold long, n long, known long, logs double, a binary, b binary"


class WordHashes:
    def __init__(self) -> None:
        self._known: dict[bytes, int] = {}

    def of(self, words: list[bytes]) -> np.ndarray:
        known = self._known
        if len(known) > KEPT_WORDS:
            known.clear()
        digest = xxhash.xxh64_intdigest
        for w in [w for w in set(words) if w not in known]:
            known[w] = digest(w, 9)
        return np.fromiter(map(known.__getitem__, words), np.uint64, len(words))


@lru_cache(maxsize=1)
def word_hashes() -> WordHashes:
    return WordHashes()


def pair_hashes(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    x = left * np.uint64(0x9E3779B97F4A7C15) + right
    for shift, factor in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB)):
        x = (x ^ (x >> np.uint64(shift))) * np.uint64(factor)
    return x ^ (x >> np.uint64(31))


def pair_keys(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """The 56 leading bits, which leave room for 10^8 pairs without a likely clash and travel more tightly."""
    return pair_hashes(left, right) & ~np.uint64(0xFF)


def put(values: np.ndarray) -> bytes:
    """Unsigned numbers with equal bytes of all of them side by side, which compresses well."""
    return np.ascontiguousarray(values.astype("<u8").view(np.uint8).reshape(-1, 8).T).tobytes()


def take(raw: bytes) -> np.ndarray:
    return np.ascontiguousarray(np.frombuffer(raw, np.uint8).reshape(8, -1).T).view("<u8").ravel()


def put_sorted(values: np.ndarray) -> bytes:
    return put(np.diff(values, prepend=np.uint64(0)))


def take_sorted(raw: bytes) -> np.ndarray:
    return np.cumsum(take(raw), dtype=np.uint64)


class Block:
    """The documents of a block as hashes: distinct words and pairs, and where each token finds them."""

    def __init__(self, docs: pa.Table):
        hashes, ends = [], [0]
        for text in as_bytes(docs.column("text")):
            words = (text or b"").lower().split()
            hashes.append(np.append(word_hashes().of(words), np.uint64(END)))
            ends.append(ends[-1] + len(words) + 1)
        self.ends = np.array(ends)
        tokens = np.concatenate(hashes) if hashes else np.zeros(0, np.uint64)
        before = np.roll(tokens, 1)
        before[self.ends[:-1]] = END
        self.words, self.word_at = np.unique(tokens, return_inverse=True)
        self.pairs, self.pair_at = np.unique(pair_keys(before, tokens), return_inverse=True)
        self.fold = np.repeat(docs.column("fold").to_numpy(), np.diff(self.ends))


def cuts(keys: np.ndarray, digits: int) -> np.ndarray:
    """Where the ranges of the leading ``digits`` bits begin and end among ascending keys."""
    inner = np.arange(1, 1 << digits, dtype=np.uint64) << np.uint64(64 - digits) if digits else np.zeros(0, np.uint64)
    return np.concatenate(([0], np.searchsorted(keys, inner), [len(keys)]))


def bucket(seen: np.ndarray) -> np.ndarray:
    """The context's bucket: 0 if never seen, else one more than the whole binary logarithm."""
    return np.frexp(seen.astype(np.float64))[1]


def fit_weights(cells: np.ndarray, times: np.ndarray, retained: float, vocabulary: int, rounds: int = 60) -> np.ndarray:
    """Weights (bucket, 3) of bigram, word and floor, by expectation-maximisation.

    A cell is (bucket, step of log2 of the bigram estimate, step of log2 of the word's count), -9999 for none.
    """
    weights = np.full((66, 3), 1 / 3)
    if len(cells) == 0 or retained <= 0:
        weights[:] = (0.4, 0.4, 0.2)
        weights[0] = (0.0, 0.8, 0.2)
        return weights
    none = cells == -9999
    p = np.stack([
        np.where(none[:, 1], 0.0, np.exp2(cells[:, 1] / CELLS)), np.where(none[:, 2], 0.0, np.exp2(cells[:, 2] / CELLS) / retained),
        np.full(len(cells), 1 / (vocabulary + 1)),
    ], axis=1)
    at = cells[:, 0]
    for _ in range(rounds):
        mass = weights[at] * p
        mass *= (times / mass.sum(1))[:, None]
        new = np.stack([np.bincount(at, mass[:, i], 66) for i in range(3)], axis=1) + 1e-3
        weights = new / new.sum(1, keepdims=True)
    used = np.bincount(at, minlength=66) > 0
    filled = np.where(used, np.arange(66), 0)
    weights = weights[np.maximum.accumulate(filled)]  # an unused bucket takes the weights of the next one below
    if not used[0]:
        weights[0] = (0.0, 0.9, 0.1)
    weights[0, 0] = 0.0
    return weights / weights.sum(1, keepdims=True)


def score_documents(
    docs: DataFrame, folds: int = 7, test_fold: int = 2, deleted_fold: int = 3, block_bytes: int = 8 << 20
) -> DataFrame:
    """(doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score) for every row of ``docs``.

    Folds are crc32(id as text) modulo ``folds``; rows of ``test_fold`` teach nothing, those of ``deleted_fold`` are
    the ones the weights are learned on. A null text is empty and consists of the end token. A row without an id is
    not held out. Repeated rows count each. Without any training document all counts are zero, and the base score
    is zero per token. Words are told apart by 64-bit hashes, pairs by 56 bits; pairs enter the
    model only, never the base score.
    """
    spark = docs.sparkSession
    rows = id_and_text(docs)
    size, count = rows.agg(F.sum(F.octet_length("text") + 32), F.count(F.lit(1))).first()
    batches = max(1, -(-int(size or count or 1) // block_bytes))
    digits = (batches - 1).bit_length()
    batch = F.pmod(F.xxhash64("doc_id", "text"), F.lit(batches).cast("long"))
    dealt = rows.select(batch.alias("batch"), "doc_id", bucket_of("doc_id", folds).alias("fold"), "text")
    ask_names = [c.split()[0] for c in _ASK.split(", ")]
    state_names = [c.split()[0] for c in _STATE.split(", ")]

    def ask(docs: pa.Table) -> pa.Table:
        block = Block(docs)
        teaches, deleted = block.fold != test_fold, block.fold == deleted_fold
        columns: dict[str, list] = {c: [] for c in ask_names}
        sides = []
        for keys, at in ((block.words, block.word_at), (block.pairs, block.pair_at)):
            sides.append((keys, *(np.bincount(at[use], minlength=len(keys)) for use in (teaches, deleted)), cuts(keys, digits)))
        (w, w_all, w_out, w_cut), (p, p_all, p_out, p_cut) = sides
        for part in range(1 << digits):
            i, j, k, m = w_cut[part], w_cut[part + 1], p_cut[part], p_cut[part + 1]
            row = (
                docs.column("batch")[0].as_py(), part, put_sorted(w[i:j]), put_sorted(p[k:m]), put(w_all[i:j]), put(w_out[i:j]),
                put(p_all[k:m]), put(p_out[k:m]),
            )
            for name, value in zip(ask_names, row, strict=True):
                columns[name].append(value)
        del block, sides, w, w_all, w_out, p, p_all, p_out
        release()
        return pa.table(columns, schema=ask_schema)

    def answer(asked: pa.Table) -> pa.Table:
        out, distinct = {}, 0
        for keys, kept in (("words", ("word_all", "word_out")), ("pairs", ("pair_all", "pair_out"))):
            parts = [take_sorted(x) for x in asked.column(keys).to_pylist()]
            edges = np.cumsum([0, *map(len, parts)])
            unique, at = np.unique(np.concatenate(parts), return_inverse=True)
            del parts
            for name in kept:
                counts = np.concatenate([take(x) for x in asked.column(name).to_pylist()])
                total = np.bincount(at, counts, len(unique)).astype(np.int64)  # exact up to 2^53
                out[name] = [put(total[at[i:j]]) for i, j in zip(edges, edges[1:], strict=False)] + [None]
                if name == "word_all":
                    distinct = int((total > 0).sum())
        release()
        part, n = asked.column("part")[0].as_py(), asked.num_rows
        # A block number beyond the last carries how many of this range's words were seen in training.
        out |= {"batch": asked.column("batch").to_pylist() + [batches + part], "part": [part] * n + [distinct]}
        return pa.table({c: out.get(c, [None] * (n + 1)) for c in ask_names}, schema=ask_schema)

    def look_up(docs: pa.Table, answers: pa.Table) -> pa.Table:
        if docs.num_rows == 0:
            rows = [(r["batch"], "distinct", None, None, r["part"], None, None, None, None) for r in answers.select(["batch", "part"]).to_pylist()]
            return pa.Table.from_pylist([dict(zip(state_names, r, strict=True)) for r in rows], schema=state_schema)
        block = Block(docs)
        answers = answers.sort_by("part")
        found = {c: np.concatenate([take(x) for x in answers.column(c).to_pylist()]).astype(np.int64) for c in ask_names[4:]}
        word, pair = found["word_all"][block.word_at], found["pair_all"][block.pair_at]
        number = docs.column("batch")[0].as_py()
        rows = []
        for i, (doc_id, fold) in enumerate(zip(docs.column("doc_id").to_pylist(), docs.column("fold").to_pylist(), strict=True)):
            here = slice(block.ends[i], block.ends[i + 1])
            w = word[here]
            rows.append((
                number, "document", doc_id, fold, len(w), int((w > 0).sum()), float(np.log10(w + 1.0).sum()),
                put(w), put(pair[here]),
            ))
        use = np.flatnonzero(block.fold == deleted_fold)
        if len(use):
            kept_word = (found["word_all"] - found["word_out"])[block.word_at]
            kept_pair = (found["pair_all"] - found["pair_out"])[block.pair_at][use]
            before = np.roll(kept_word, 1)
            before[block.ends[:-1]] = kept_word[block.ends[1:] - 1]  # a text begins after an end token
            context, kept_word = before[use], kept_word[use]
            with np.errstate(divide="ignore", invalid="ignore"):
                two = np.where(kept_pair > 0, np.rint(CELLS * np.log2(kept_pair / context)), -9999)
                one = np.where(kept_word > 0, np.rint(CELLS * np.log2(kept_word)), -9999)
            cells, times = np.unique(np.stack([bucket(context), two, one], axis=1).astype(np.int64), axis=0, return_counts=True)
            rows.append((number, "cells", None, None, len(use), None, None, cells.astype("<i8").tobytes(), times.astype("<i8").tobytes()))
        del block, found, word, pair, answers
        table = pa.table(dict(zip(state_names, map(list, zip(*rows, strict=True)), strict=True)), schema=state_schema)
        del rows
        release()
        return table

    kinds = {"long": pa.int64(), "binary": pa.binary(), "string": pa.string(), "double": pa.float64()}
    ask_schema, state_schema = (pa.schema([(n, kinds[t]) for n, t in map(str.split, s.split(", "))]) for s in (_ASK, _STATE))
    answers = dealt.groupBy("batch").applyInArrow(ask, _ASK).groupBy("part").applyInArrow(answer, _ASK)
    state = dealt.groupBy("batch").cogroup(answers.groupBy("batch")).applyInArrow(look_up, _STATE)
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/holdfast-{uuid.uuid4().hex}/counts"
    state.write.option("compression", "zstd").parquet(path)
    state = spark.read.schema(_STATE).parquet(path)

    def unpack(batches):  # noqa: ANN001, ANN202
        for batch in batches:
            cells = [np.frombuffer(x, "<i8").reshape(-1, 3) for x in batch.column("a").to_pylist()]
            times = [np.frombuffer(x, "<i8") for x in batch.column("b").to_pylist()]
            if cells:
                c = np.concatenate(cells)
                yield pa.RecordBatch.from_arrays([*(pa.array(c[:, i]) for i in range(3)), pa.array(np.concatenate(times))], ["bucket", "two", "one", "n"])

    cells = state.filter("kind = 'cells'").select("a", "b").mapInArrow(unpack, "bucket long, two long, one long, n long")
    # At most 66 x 600 x 600 cells, however large the corpus; a few ten thousand occur.
    table = cells.groupBy("bucket", "two", "one").agg(F.sum("n").alias("n")).orderBy("bucket", "two", "one").toArrow()
    vocabulary = int(state.filter("kind = 'distinct'").agg(F.sum("n")).first()[0] or 0)
    by_fold = {r.fold: r.n for r in state.filter("kind = 'document'").groupBy("fold").agg(F.sum("n").alias("n")).collect()}
    trained = sum(n for fold, n in by_fold.items() if fold != test_fold)
    grid = np.stack([table.column(c).to_numpy() for c in ("bucket", "two", "one")], axis=1)
    weights = fit_weights(grid, table.column("n").to_numpy().astype(float), trained - by_fold.get(deleted_fold, 0), vocabulary)

    def score(batches):  # noqa: ANN001, ANN202
        for whole in batches:
            for batch in slices([whole], text="a"):
                out = []
                for raw_word, raw_pair in zip(batch.column("a").to_pylist(), batch.column("b").to_pylist(), strict=True):
                    word, pair = take(raw_word).view(np.int64), take(raw_pair).view(np.int64)
                    context = np.roll(word, 1)  # the last token is the end token, which is also the first one's context
                    w = weights[bucket(context)]
                    p = w[:, 0] * pair / np.maximum(context, 1) + w[:, 1] * word / max(1, trained) + w[:, 2] / (vocabulary + 1)
                    out.append(float(np.log10(p).sum()))
                yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in ("doc_id", "fold", "n", "known", "logs")), pa.array(out, pa.float64())], ["doc_id", "fold", "n", "known", "logs", "score"])
            release()

    scored = state.filter("kind = 'document'").select("doc_id", "fold", "n", "known", "logs", "a", "b")
    scored = scored.mapInArrow(score, "doc_id long, fold long, n long, known long, logs double, score double")
    floor = float(np.log10(trained + vocabulary + 1))
    return scored.select(
        "doc_id", (F.col("fold") == test_fold).alias("held_out"), F.col("n").alias("n_tokens"), F.col("known").alias("n_known"),
        F.lit(trained).cast("long").alias("train_tokens"), (F.col("logs") - F.col("n") * F.lit(floor)).alias("base_score"), "score",
    )
