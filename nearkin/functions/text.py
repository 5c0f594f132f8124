"""Text cleaning and tokenizing as native column expressions.

Java's default ``\\s`` and ``\\w`` are ASCII-only, so whitespace and word characters are
spelled out as the Unicode classes below.
"""

from __future__ import annotations

import html
import unicodedata
from collections.abc import Callable

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

WS = r"[\p{IsWhite_Space}\x1c-\x1f]"
NON_WS = r"[^\p{IsWhite_Space}\x1c-\x1f]"
WORD = r"[\p{L}\p{N}_]"
NON_WORD = r"[^\p{L}\p{N}_\p{IsWhite_Space}\x1c-\x1f]"
# Runs without word characters, other than one blank: those need no replacement by one. The letters a to z come first since most are.
NO_WORDS = r"\x20[^a-z\p{L}\p{N}_]+|[^a-z\x20\p{L}\p{N}_][^a-z\p{L}\p{N}_]*"

# What counts as markup and as a URL, and what stands for a URL.
TAG = r"<[^>]+>"
URL = rf"(?i)(?:https?://|www\.){NON_WS}+"
URL_TOKEN = "<URL>"

# Irregular English contractions and their expansions.
IRREGULAR_CONTRACTIONS = {
    "ain't": "are not",
    "can't": "cannot",
    "let's": "let us",
    "ma'am": "madam",
    "o'clock": "of the clock",
    "shan't": "shall not",
    "won't": "will not",
    "y'all": "you all",
    "'cause": "because",
    "'tis": "it is",
    "'twas": "it was",
}
# Words after which 's stands for "is" (elsewhere it is a possessive).
IS_CONTRACTION_WORDS = [
    "he", "here", "how", "it", "she", "that", "there", "this", "what", "when", "where", "who", "why",
]
# Contracted endings and their expansions.
CONTRACTED_ENDINGS = {
    "n't": " not",
    "'re": " are",
    "'ve": " have",
    "'ll": " will",
    "'d": " would",
    "'m": " am",
}


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """Bind ``value`` once and use it several times inside ``body``."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def strip(text: Column) -> Column:
    """Remove leading and trailing whitespace of any Unicode kind."""
    return F.regexp_replace(text, f"^{WS}+|{WS}+$", "")


def collapse(text: Column) -> Column:
    """Turn every run of whitespace into one space and strip the ends."""
    return F.trim(F.regexp_replace(text, f"{WS}+", " "))


def is_blank(text: Column) -> Column:
    return text.isNull() | (F.length(strip(text)) == 0)


@F.pandas_udf(T.StringType())
def _unescape(texts: pd.Series) -> pd.Series:
    return texts.map(html.unescape, na_action="ignore")


def remove_html(text: Column) -> Column:
    """Decode entities, then replace tags by a space; script and style bodies stay.

    Only rows holding an ampersand hand their text to the Python decoder.
    """
    decoded = F.coalesce(_unescape(F.when(text.contains("&"), text)), text)
    return collapse(F.regexp_replace(decoded, TAG, " "))


def remove_urls(text: Column) -> Column:
    return F.regexp_replace(text, URL, URL_TOKEN)


def expand_contractions(text: Column) -> Column:
    """Expand English contractions in texts that hold an apostrophe."""
    straight = F.regexp_replace(text, "[’`]", "'")
    out = straight
    for short, full in IRREGULAR_CONTRACTIONS.items():
        out = F.regexp_replace(out, rf"(?i)(?<!{WORD}){short}(?!{WORD})", full)
    words = "|".join(IS_CONTRACTION_WORDS)
    out = F.regexp_replace(out, rf"(?i)(?<!{WORD})({words})'s(?!{WORD})", "$1 is")
    for ending, full in CONTRACTED_ENDINGS.items():
        out = F.regexp_replace(out, rf"(?i)(?<={WORD}){ending}(?!{WORD})", full)
    return F.when(text.contains("'") | text.contains("’") | text.contains("`"), out).otherwise(text)


def plain_text(text: Column) -> Column:
    """Text without markup and URLs, from which both cleaners go on."""
    return remove_urls(remove_html(text))


def classical_of(plain: Column) -> Column:
    """Lower-case words of a plain text without punctuation."""
    return F.coalesce(F.trim(F.regexp_replace(F.lower(expand_contractions(plain)), NO_WORDS, " ")), F.lit(""))


def transformer_of(plain: Column) -> Column:
    return F.coalesce(collapse(plain), F.lit(""))


def clean_classical(text: Column) -> Column:
    """Lower-case words without markup, URLs or punctuation; blank or null gives ``""``."""
    return classical_of(plain_text(text))


def clean_transformer(text: Column) -> Column:
    """Text without markup and URLs, case and punctuation kept; blank or null gives ``""``."""
    return transformer_of(plain_text(text))


CLEANERS: dict[str, Callable[[Column], Column]] = {
    "classical": clean_classical,
    "transformer": clean_transformer,
}


def words(text: Column) -> Column:
    """Whitespace-separated words."""
    return F.filter(F.split(text, f"{WS}+"), lambda w: w != "")


def word_count(text: Column) -> Column:
    return F.size(words(text))


def bm25_tokens(text: Column) -> Column:
    """Runs of word characters of the lower-cased text; null gives an empty array."""
    return F.coalesce(
        F.regexp_extract_all(F.lower(text), F.lit(f"({WORD}+)"), F.lit(1)),
        F.array().cast("array<string>"),
    )


# The Hangul syllables and the first of their leading, middle and trailing letters.
HANGUL, HANGUL_END = 0xAC00, 0xD7A3
LEADING, MIDDLE, TRAILING = (0x1100, 19), (0x1161, 21), (0x11A8, 27)
# Code points from here on have no compatibility decomposition.
DECOMPOSED_END = 0x2FA20
_PAGE = 256


def _decompositions() -> tuple[dict[str, str], str]:
    """What each character becomes without marks in compatibility decomposition, and the marks; Hangul is left to a rule."""
    becomes, marks = {}, []
    for char in map(chr, (*range(0x80, 0xAC00), *range(0xE000, DECOMPOSED_END))):
        base = "".join(c for c in unicodedata.normalize("NFKD", char) if not unicodedata.combining(c))
        if not base:
            marks.append(char)
        elif base != char:
            becomes[char] = base
    return becomes, "".join(marks)


def _class_of(codes: list[int], gap: int = 1) -> str:
    """A regular expression class of code points, as ranges; codes up to ``gap`` apart share a range."""
    ranges: list[list[int]] = []
    for code in codes:
        if ranges and code <= ranges[-1][1] + gap:
            ranges[-1][1] = code
        else:
            ranges.append([code, code])
    return "[" + "".join(f"\\x{{{low:x}}}-\\x{{{high:x}}}" for low, high in ranges) + "]"


def _pages(longer: dict[str, str]) -> tuple[list[int], list[str]]:
    """Where the page of each code point begins in a list of values, and that list; page 0 is empty."""
    starts, values = [0] * (DECOMPOSED_END // _PAGE + 1), [""] * _PAGE
    for char, value in sorted(longer.items()):
        page, place = divmod(ord(char), _PAGE)
        if not starts[page]:
            starts[page] = len(values)
            values += [""] * _PAGE
        values[starts[page] + place] = value
    return starts, values


_BECOMES, _MARKS = _decompositions()
_ACCENTED = "".join(c for c, base in _BECOMES.items() if len(base) == 1) + _MARKS
_BASES = "".join(base for base in _BECOMES.values() if len(base) == 1)
_LONGER = {c: base for c, base in _BECOMES.items() if len(base) > 1}
_LONG_CODES = sorted([*map(ord, _LONGER), *range(HANGUL, HANGUL_END + 1)])
_LONG = _class_of(_LONG_CODES)
# A few ranges around all of them: most texts hold no character of these and skip the many ranges above.
_MAYBE_LONG = _class_of(_LONG_CODES, 64)
_STARTS, _VALUES = _pages(_LONGER)


def _constant(values: list[str]) -> Column:
    """A constant array of texts, folded by the optimizer."""
    return F.split(F.lit("\u0001".join(values)), "\u0001", -1)


def _decomposed(char: Column) -> Column:
    """One character as the characters of its decomposition, by its place in a table or the rule for Hangul."""
    code = F.ascii(char)
    start = F.get(_constant([str(x) for x in _STARTS]).cast("array<int>"), F.shiftright(code, 8))
    listed = F.get(_constant(_VALUES), start + code.bitwiseAND(_PAGE - 1))

    def letters(of: tuple[int, int]) -> list[str]:
        return [chr(of[0] + i) for i in range(of[1])]

    syllable = code - HANGUL
    tails = TRAILING[1] + 1
    parts = ((LEADING, F.floor(syllable / (MIDDLE[1] * tails))), (MIDDLE, F.floor(syllable / tails) % MIDDLE[1]))
    hangul = F.concat(
        *[F.get(_constant(letters(of)), at.cast("int")) for of, at in parts],
        F.get(_constant(["", *letters(TRAILING)]), syllable % tails))
    return F.when(code.between(HANGUL, HANGUL_END), hangul).otherwise(F.coalesce(F.nullif(listed, F.lit("")), char))


def strip_accents(text: Column) -> Column:
    """Compatibility decomposition without combining marks.

    Ligatures, fractions, Hangul and other characters that become several are taken apart only in
    texts that hold one; the rest is one translation.
    """
    apart = F.concat_ws("", F.transform(F.split(text, ""), _decomposed))
    whole = F.when(text.rlike(_MAYBE_LONG) & text.rlike(_LONG), apart).otherwise(text)
    return F.when(text.rlike(r"[^\x00-\x7f]"), F.translate(whole, _ACCENTED, _BASES)).otherwise(text)


def bigrams(tokens: Column) -> Column:
    """Adjacent token pairs joined by one space."""
    return let(
        tokens,
        lambda t: F.filter(
            F.zip_with(t, F.slice(t, F.lit(2), F.greatest(F.size(t), F.lit(1))),
                       lambda a, b: F.concat(a, F.lit(" "), b)),
            lambda g: g.isNotNull(),
        ),
    )


def tfidf_terms(text: Column) -> Column:
    """Words of two or more characters without accents, followed by their bigrams."""
    tokens = F.regexp_extract_all(
        strip_accents(F.lower(F.coalesce(text, F.lit("")))), F.lit(f"({WORD}{{2,}})"), F.lit(1)
    )
    return let(tokens, lambda t: F.concat(t, bigrams(t)))


def term_counts(tokens: Column) -> Column:
    """``array<struct<term, tf>>`` of one row's tokens, counted inside the row.

    Sorting puts equal terms next to each other, so a count is the distance between two run
    starts. No shuffle is needed to count the terms of a document.
    """
    def runs(s: Column) -> Column:
        starts = F.filter(
            F.when(F.size(s) > 0, F.sequence(F.lit(0), F.size(s) - 1)).otherwise(F.array().cast("array<int>")),
            lambda i: (i == 0) | (F.get(s, i) != F.get(s, i - 1)),
        )
        return let(starts, lambda st: F.transform(
            st,
            lambda at, j: F.struct(
                F.get(s, at).alias("term"),
                (F.coalesce(F.get(st, j + 1), F.size(s)) - at).alias("tf"),
            ),
        ))

    return let(F.sort_array(tokens), runs)


# Sorts before every character a token can hold.
SIDE_MARK = "\u0001"


def two_sided_counts(left: Column, right: Column) -> Column:
    """Term counts of two token arrays of one row, as ``array<struct<here, next>>``.

    Right-hand terms carry a trailing mark. Sorting makes the two counts of a shared term
    neighbours, and every entry comes with its successor, so that the counts of a term can be
    paired row by row after an explode.
    """
    marked = F.transform(right, lambda t: F.concat(t, F.lit(SIDE_MARK)))
    return let(
        term_counts(F.concat(left, marked)),
        lambda c: F.arrays_zip(
            c.alias("here"), F.slice(c, F.lit(2), F.greatest(F.size(c), F.lit(1))).alias("next")),
    )


def is_right(marked_term: Column) -> Column:
    return marked_term.endswith(SIDE_MARK)


def unmarked(marked_term: Column) -> Column:
    return F.rtrim(marked_term, F.lit(SIDE_MARK))
