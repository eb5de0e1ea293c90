"""Language identification by cross-parsing against suffix automata.

Per language, a suffix automaton of labelled text answers how far a text can be followed as a substring of it. A
word with its borders is parsed greedily into longest matches; a language in which the words of a text fall into few
phrases resembles it. Phrases are normalised to bits per character (phrases times the log of the automaton's text
length, over the characters), and the least value wins. Phrases end at word borders, so a distinct word is parsed
once per worker, whatever the number of its occurrences.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from holdfast.llm.common import bucket_of, slices

UNDETERMINED = "und"
KEPT_WORDS = 300_000
_LETTER = regex.compile(r"\p{L}")


class SuffixAutomaton:
    """The minimal automaton of all substrings of a text, built character by character."""

    def __init__(self, text: str):
        step: list[dict[str, int]] = [{}]
        link, length, last = [-1], [0], 0
        for c in text:
            new = len(step)
            step.append({})
            length.append(length[last] + 1)
            link.append(0)
            p = last
            while p >= 0 and c not in step[p]:
                step[p][c] = new
                p = link[p]
            if p >= 0:
                q = step[p][c]
                if length[p] + 1 == length[q]:
                    link[new] = q
                else:
                    clone = len(step)
                    step.append(step[q].copy())
                    length.append(length[p] + 1)
                    link.append(link[q])
                    while p >= 0 and step[p].get(c) == q:
                        step[p][c] = clone
                        p = link[p]
                    link[q] = link[new] = clone
            last = new
        self.step, self.bits = step, math.log2(len(text) + 1)

    def phrases(self, word: str) -> int:
        """Greedy longest matches that cover the word; an unknown character is a phrase of its own."""
        step, root, count = self.step, self.step[0], 1
        here = root
        for c in word:
            to = here.get(c)
            if to is None:
                count += here is not root
                to = root.get(c)
                if to is None:
                    count += 1
                    here = root
                    continue
            here = step[to]
        return count - (here is root)


#: ASCII characters other than letters part words; so do the white space and punctuation that ``lower`` leaves in ASCII.
_PARTING = bytes(b if b >= 128 or chr(b).isalpha() else 32 for b in range(256))


def words_of(text: str) -> list[bytes]:
    return text.lower().encode().translate(_PARTING).split()


class CrossParser:
    """The automata of all learned languages, with the phrase counts of words already met."""

    def __init__(self, texts: tuple[tuple[str, str], ...]):
        self.names = [name for name, _ in texts]
        self.automata = [SuffixAutomaton(text) for _, text in texts]
        self.bits = np.array([a.bits for a in self.automata])
        self._place: dict[bytes, int] = {}
        self._counts = np.zeros((1024, len(texts)), np.int64)

    def predict(self, text: str | None) -> tuple[str, float]:
        if not self.names or text is None or not _LETTER.search(text):
            return UNDETERMINED, 0.0
        words = words_of(text)
        place = self._place
        if len(place) > KEPT_WORDS:
            place.clear()
        for w in [w for w in set(words) if w not in place]:
            i = place[w] = len(place)
            if i == len(self._counts):
                self._counts = np.concatenate((self._counts, np.zeros_like(self._counts)))
            self._counts[i] = [a.phrases(f" {w.decode()} ") for a in self.automata]
        total = self._counts[np.fromiter(map(place.__getitem__, words), np.int64, len(words))].sum(0)
        cost = total * self.bits
        best = int(np.argmin(cost))
        if len(cost) == 1:
            return self.names[0], 1.0
        second = float(np.partition(cost, 1)[1])
        return self.names[best], (second - float(cost[best])) / second if second > 0 else 0.0


@lru_cache(maxsize=1)
def cross_parser(texts: tuple[tuple[str, str], ...]) -> CrossParser:
    return CrossParser(texts)


def learn(docs: DataFrame, documents: int = 150, characters: int = 60_000) -> tuple[tuple[str, str], ...]:
    """Per language, the distinct words of a bounded sample: at most ``documents`` rows, the least by a hash of id and
    text, each read whole. A document that would take the sample above ``characters`` bytes of distinct words is left
    out whole, and texts of more than ``characters`` bytes do not teach, unless a language has no others: then its
    shortest one does. ``docs`` has text and lang, both not null."""
    size = F.octet_length("text")
    order = Window.partitionBy("lang").orderBy(F.greatest(size - characters, F.lit(0)), F.xxhash64("doc_id", "text"), "doc_id")
    rows = docs.select("lang", "doc_id", "text", F.row_number().over(order).alias("r"))
    # A plain limit on the rank lets Spark keep the first rows of each language before the shuffle.
    rows = rows.filter(F.col("r") <= documents).filter((F.col("r") == 1) | (size <= characters)).select("lang", "r", "text")
    sample: dict[str, list[str]] = {}
    for row in sorted(rows.collect(), key=lambda x: (x.lang, x.r)):
        sample.setdefault(row.lang, []).append(row.text)
    out = []
    for lang, texts in sorted(sample.items()):
        parts = dict.fromkeys(words_of(texts[0]))
        used = sum(map(len, parts)) + len(parts)
        for text in texts[1:]:
            new = dict.fromkeys(w for w in words_of(text) if w not in parts)
            more = sum(map(len, new)) + len(new)
            if used + more <= characters:
                parts |= new
                used += more
        if parts:
            out.append((lang, f" {b' '.join(parts).decode()} "))
    return tuple(out)


def identify(docs: DataFrame, documents: int = 150, characters: int = 60_000) -> DataFrame:
    """(doc_id, held_out, lang_pred, score) for every row of ``docs`` (doc_id, text, lang).

    Rows whose crc32(id as text) is 2 modulo 4 are held out; the others teach, where text and lang are not null. A
    text that is null or without letters is ``und`` with score 0, as is every text if nothing could be learned. The
    score is the relative lead over the second-best language; equal costs go to the name that sorts first, with
    score 0. Only ``text`` is read for a prediction. Repeated rows stay.
    """
    rows = docs.select(docs["doc_id"].cast("long").alias("doc_id"), docs["text"].cast("string").alias("text"), docs["lang"].cast("string").alias("lang"))
    fold = bucket_of("doc_id", 4) == 2
    texts = learn(rows.filter(~fold & F.col("text").isNotNull() & F.col("lang").isNotNull()), documents, characters)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parser = cross_parser(texts)
        for batch in slices(batches):
            found = [parser.predict(t) for t in batch.column("text").to_pylist()]
            columns = [batch.column("doc_id"), batch.column("held_out"), pa.array([x for x, _ in found]), pa.array([x for _, x in found], pa.float64())]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "held_out", "lang_pred", "score"])

    return rows.select("doc_id", fold.alias("held_out"), "text").mapInArrow(run, "doc_id long, held_out boolean, lang_pred string, score double")
