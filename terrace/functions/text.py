"""Text clean-up: accents, white space, zip codes, missing-value tokens.

The accent rule is Unicode compatibility decomposition (NFKD) followed by dropping
combining marks. Because every dropped mark is the only thing canonical ordering
can move, the rule works one character at a time, which lets it run as built-in
Spark expressions. The per-character tables are derived from ``unicodedata``.
"""

from __future__ import annotations

import functools
import sys
import unicodedata

from pyspark.sql import Column
from pyspark.sql import functions as F

from terrace import config

# Every character Python's str.strip() removes.
WHITE_SPACE = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680"
    "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)

_HANGUL_FIRST, _HANGUL_LAST = 0xAC00, 0xD7A3


def _fold(char: str) -> str:
    return "".join(c for c in unicodedata.normalize("NFKD", char) if not unicodedata.combining(c))


@functools.cache
def _fold_tables() -> tuple[str, str, dict[str, str]]:
    """(characters with one or no replacement, their replacements, one-to-many map).

    ``translate`` deletes characters of its first text that have no partner in
    the second, so deletions come last. Hangul syllables are left out: they are
    composed arithmetically.
    """
    single, target, deleted, expanded = [], [], [], {}
    for code in range(0x80, sys.maxunicode + 1):
        if 0xD800 <= code <= 0xDFFF or _HANGUL_FIRST <= code <= _HANGUL_LAST:
            continue
        char = chr(code)
        folded = _fold(char)
        if folded == char:
            continue
        if not folded:
            deleted.append(char)
        elif len(folded) == 1:
            single.append(char)
            target.append(folded)
        else:
            expanded[char] = folded
    return "".join(single + deleted), "".join(target), expanded


@functools.cache
def _expanding_class() -> str:
    """Regex class of the characters that fold to several characters."""
    codes = sorted(ord(c) for c in _fold_tables()[2])
    spans: list[list[int]] = [[_HANGUL_FIRST, _HANGUL_LAST]]
    for code in codes:
        if code == spans[-1][1] + 1:
            spans[-1][1] = code
        else:
            spans.append([code, code])
    return "[" + "".join(f"\\x{{{lo:X}}}-\\x{{{hi:X}}}" for lo, hi in spans) + "]"


def _hangul(char: Column) -> Column:
    """Decompose one Hangul syllable into its two or three letters."""
    index = F.ascii(char) - F.lit(_HANGUL_FIRST)
    lead = F.lit("".join(chr(0x1100 + i) for i in range(19)))
    vowel = F.lit("".join(chr(0x1161 + i) for i in range(21)))
    tail = F.lit("".join(chr(0x11A8 + i) for i in range(27)))
    lead_at = F.floor(index / 588).cast("int") + 1
    vowel_at = F.floor((index % 588) / 28).cast("int") + 1
    tail_at = (index % 28).cast("int")
    return F.concat(
        F.substring(lead, lead_at, F.lit(1)),
        F.substring(vowel, vowel_at, F.lit(1)),
        F.when(tail_at > 0, F.substring(tail, tail_at, F.lit(1))).otherwise(F.lit("")),
    )


def strip_accents(text: Column) -> Column:
    """NFKD without combining marks; null stays null.

    Three lanes: plain ASCII passes untouched, most other text needs one
    ``translate``, and only text holding a character that expands (a ligature, a
    fraction, a Hangul syllable) is taken apart character by character.
    """
    source, target, expanded = _fold_tables()
    expanding = F.lit("".join(expanded))
    expansions = F.split(F.lit("\n".join(expanded.values())), "\n")

    def fold_char(char: Column) -> Column:
        at = F.instr(expanding, char)
        return (
            F.when(char <= "\x7f", char)
            .when(char.between(chr(_HANGUL_FIRST), chr(_HANGUL_LAST)), _hangul(char))
            .when(at > 0, F.element_at(expansions, at))
            .otherwise(char)
        )

    per_char = F.array_join(F.transform(F.split(text, ""), fold_char), "")
    return (
        F.when(~text.rlike(r"[^\x00-\x7F]"), text)
        .when(text.rlike(_expanding_class()),
              F.translate(per_char, source, target))
        .otherwise(F.translate(text, source, target))
    )


def strip_space(text: Column) -> Column:
    """Trim every kind of Unicode white space, not only blanks."""
    return F.btrim(text, F.lit(WHITE_SPACE))


def clean_city(text: Column) -> Column:
    return strip_space(F.lower(strip_accents(text)))


def clean_code(text: Column) -> Column:
    """State codes: upper case, trimmed."""
    return strip_space(F.upper(text))


def clean_label(text: Column) -> Column:
    """Statuses and payment types: lower case, trimmed."""
    return strip_space(F.lower(text))


def zero_pad(value: Column, width: int = config.ZIP_WIDTH) -> Column:
    """Left-pad with zeros after an optional sign; longer text is kept whole."""
    text = value.cast("string")
    signed = F.substring(text, 1, 1).isin("+", "-")
    padded = F.lpad(text, F.greatest(F.length(text), F.lit(width)), F.lit("0"))
    digits = F.substring(text, F.lit(2), F.length(text))
    after_sign = F.concat(
        F.substring(text, 1, 1),
        F.lpad(digits, F.greatest(F.length(digits), F.lit(width - 1)), F.lit("0")),
    )
    return F.when(signed, after_sign).otherwise(padded)


def blank_to_null(text: Column) -> Column:
    """Missing-value tokens of the raw files become null."""
    return F.when(~text.isin(*config.NA_TOKENS), text)
