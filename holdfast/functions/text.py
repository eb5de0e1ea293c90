"""Text column expressions: accent folding, words, n-grams, titles, previews."""

from __future__ import annotations

import unicodedata
from collections.abc import Callable, Sequence
from functools import lru_cache

from pyspark.sql import Column
from pyspark.sql import functions as F

# Hangul syllables decompose by arithmetic into a leading consonant, a vowel and, mostly, a trailing consonant.
_SYLLABLES = (0xAC00, 0xD7A4)
_LEADS = "".join(map(chr, range(0x1100, 0x1113)))
_VOWELS = "".join(map(chr, range(0x1161, 0x1176)))
_TRAILS = "".join(map(chr, range(0x11A8, 0x11C3)))


@lru_cache(maxsize=1)
def _fold_rules() -> tuple[str, str, tuple[tuple[str, str], ...]]:
    """Compatibility decomposition of every character without marks of a combining class, as 1:1 and 1:n rules.

    Marks stand at the end of the source without a target, so that ``translate`` deletes them. Vowel signs have no
    combining class and stay.
    """
    source, target, longer, marks = [], [], [], []
    for code in range(0xA0, 0x30000):
        if 0xD800 <= code < 0xE000 or _SYLLABLES[0] <= code < _SYLLABLES[1]:
            continue
        char = chr(code)
        folded = "".join(c for c in unicodedata.normalize("NFKD", char) if not unicodedata.combining(c))
        if folded == char:
            continue
        if not folded:
            marks.append(char)
        elif len(folded) == 1:
            source.append(char)
            target.append(folded)
        else:
            longer.append((char, folded))
    return "".join(source + marks), "".join(target), tuple(longer)


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """Evaluate ``value`` once per row and use it many times in ``body`` without repeating its expression tree."""
    return F.transform(F.array(value), body)[0]


def _is_ascii(text: Column) -> Column:
    return F.octet_length(text) == F.char_length(text)


def fold_accents(c: Column | str) -> Column:
    """Strip accents in one ``translate`` pass, which ASCII texts need not. Texts with a character that expands to several
    (ligatures, Hangul and the like) take a guarded rare path over their characters."""
    value = F.col(c) if isinstance(c, str) else c
    source, target, longer = _fold_rules()
    expansions = F.create_map(*[F.lit(x) for pair in longer for x in pair])
    rare = "".join(char for char, _ in longer) + "".join(map(chr, range(*_SYLLABLES)))

    def spell(char: Column) -> Column:
        place = F.ascii(char) - _SYLLABLES[0]
        lead = F.substring(F.lit(_LEADS), (place / 588).cast("int") + 1, F.lit(1))
        vowel = F.substring(F.lit(_VOWELS), (place % 588 / 28).cast("int") + 1, F.lit(1))
        trail = F.when(place % 28 > 0, F.substring(F.lit(_TRAILS), place % 28, F.lit(1))).otherwise("")
        return F.when(place.between(0, 11171), F.concat(lead, vowel, trail)).otherwise(F.coalesce(F.try_element_at(expansions, char), char))

    def expand(text: Column) -> Column:
        spelled = F.transform(F.split(text, ""), spell)
        # Deleting the rare characters is a much faster test than a regex class of them.
        return F.when(_is_ascii(text), text).when(F.translate(text, rare, "") != text, F.array_join(spelled, "")).otherwise(text)

    return let(value, lambda text: F.when(_is_ascii(text), text).otherwise(let(F.translate(text, source, target), expand)))


def normalise(c: Column | str) -> Column:
    """Lower case, then without accents."""
    return fold_accents(F.lower(F.col(c) if isinstance(c, str) else c))


def words(c: Column | str, stop_words: Sequence[str] = ()) -> Column:
    """Runs of two or more word characters in order, stop words out, repeats kept.

    The stop words are a look-ahead of the same pattern, so one regex pass does both.
    """
    value = F.col(c) if isinstance(c, str) else c
    char = r"[\p{L}\p{N}_]"
    skip = rf"(?!(?:{'|'.join(stop_words)})(?!{char}))" if stop_words else ""
    return F.regexp_extract_all(value, F.lit(rf"(?<!{char}){skip}({char}{{2,}})"), F.lit(1))


def with_bigrams(tokens: Column) -> Column:
    """The tokens followed by every pair of neighbours."""
    def pairs(words_: Column) -> Column:
        count = F.greatest(F.size(words_) - 1, F.lit(0))
        joined = F.zip_with(F.slice(words_, F.lit(1), count), F.slice(words_, F.lit(2), count), lambda a, b: F.concat(a, F.lit(" "), b))
        return F.concat(words_, joined)

    return let(tokens, pairs)


def preview(c: Column | str, length: int = 700) -> Column:
    value = F.col(c) if isinstance(c, str) else c
    return F.substring(F.trim(F.regexp_replace(value, r"\s+", " ")), 1, length)


def heading(text: Column | str, stem: Column | str) -> Column:
    """First line that starts with ``#``, without the hashes; else the file stem in title case."""
    value = F.col(text) if isinstance(text, str) else text
    name = F.col(stem) if isinstance(stem, str) else stem
    has_heading = value.rlike(r"(?m)^[ \t]*#")
    found = F.trim(F.regexp_extract(value, r"(?m)^[ \t]*#+[ \t]*([^\r\n]*)$", 1))
    return F.when(has_heading, found).otherwise(F.initcap(F.translate(name, "_", " ")))
