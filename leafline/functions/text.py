"""Column functions for text views (T9-T13, A1) and simple text rules.

All of them are JVM expressions.  Unicode NFKC has no Spark function; it
comes from ICU4J (shipped with Spark for collations) through the built-in
``reflect``, and only on rows holding a character NFKC can change.
"""

from __future__ import annotations

import sys
import unicodedata
from functools import lru_cache

from pyspark.sql import Column
from pyspark.sql import functions as F

# Characters one by one, not as ranges: Java looks them up in one table of bits.
LETTERS = "abcdefghijklmnopqrstuvwxyz"
DIGITS = "0123456789"


def _ranges_class(codepoints: list[int]) -> str:
    """Java regex character class for a sorted list of code points."""
    parts = []
    start = prev = None
    for c in codepoints:
        if start is None:
            start = prev = c
        elif c == prev + 1:
            prev = c
        else:
            parts.append((start, prev))
            start = prev = c
    if start is not None:
        parts.append((start, prev))
    out = []
    for a, b in parts:
        out.append(f"\\x{{{a:X}}}" if a == b else f"\\x{{{a:X}}}-\\x{{{b:X}}}")
    return "[" + "".join(out) + "]"


@lru_cache(maxsize=1)
def nfkc_trigger_class() -> str:
    """Characters whose presence may make NFKC change a string (a superset).

    Built by rule from the running Python's Unicode tables: below U+0300 the
    exact code points that are not NFKC-stable on their own; from U+0300 up
    everything (combining marks start there).  A short class keeps the JVM
    check cheap for the common Latin texts; the UDF itself is exact."""
    cps = [c for c in range(0x80, 0x300) if unicodedata.normalize("NFKC", chr(c)) != chr(c)]
    return _ranges_class(cps)[:-1] + "\\x{300}-\\x{10FFFF}]"


@lru_cache(maxsize=1)
def py_space_class() -> str:
    """Characters Python's ``str.isspace`` accepts (its ``strip``/``\\s``)."""
    return _ranges_class([c for c in range(sys.maxunicode + 1) if chr(c).isspace()])


def nfkc(col: Column) -> Column:
    """Unicode NFKC (ICU ``Normalizer.compose(s, compat=true)``), evaluated
    only where the text holds a trigger character; elsewhere it is a no-op.

    The class has many ranges and none below U+00A0, so it only looks at what is
    left of the text without those characters."""
    needs = F.regexp_replace(col, "[\\x{0}-\\x{9F}]+", "").rlike(nfkc_trigger_class())
    normalized = F.call_function("reflect", F.lit("com.ibm.icu.text.Normalizer"), F.lit("compose"), col, F.lit(True))
    return F.when(needs, normalized).otherwise(col)


@lru_cache(maxsize=1)
def py_space_chars() -> str:
    """The characters Python's ``str.isspace`` accepts, as one string."""
    return "".join(chr(c) for c in range(sys.maxunicode + 1) if chr(c).isspace())


def py_strip(col: Column) -> Column:
    """Python ``str.strip()``: remove Unicode whitespace at both ends (a
    character-set trim, no regex)."""
    return F.btrim(col, F.lit(py_space_chars()))


def normalize_text(col: Column) -> Column:
    """NFKC, lower case, nbsp -> space, collapse whitespace, strip."""
    ws = py_space_class()
    t = F.lower(nfkc(col))
    t = F.regexp_replace(t, "\u00a0", " ")
    t = F.regexp_replace(t, f"{ws}+", " ")
    return py_strip(t)


def compact_text(col: Column) -> Column:
    """Normalised text with everything outside [a-z0-9] removed.

    Whitespace steps of T9 cannot change the result, so they are skipped."""
    return F.regexp_replace(F.lower(nfkc(col)), f"[^{LETTERS}{DIGITS}]+", "")


def digits_view(col: Column) -> Column:
    """Keep Unicode decimal digits only (Python's ``\\D`` is Unicode).

    No decimal digit lies between ``9`` and U+0660, so a plain class drops most characters first."""
    return F.regexp_replace(F.regexp_replace(col, f"[^{DIGITS}\\x{{660}}-\\x{{10FFFF}}]+", ""), "(?U)\\D+", "")


def number_view(col: Column) -> Column:
    """A text without what lies between its numbers.

    Of a stretch without digits the middle goes: its signs ``.,$#%-`` next to a digit stay, and so do
    the first and the last other character.  A text of digits and these signs that holds a digit
    therefore occurs in the view where it occurs in ``col``, next to the same characters."""
    other = f"([^{DIGITS}.,$#%-])"
    return F.regexp_replace(col, f"{other}[^{DIGITS}]*{other}", "$1$2")


def lower_view(col: Column) -> Column:
    """T12."""
    return F.lower(col)


def text_views(col: Column) -> Column:
    """A1: the five views of a text as one struct, computed once per row."""
    return F.struct(
        col.alias("raw"),
        lower_view(col).alias("lower"),
        normalize_text(col).alias("normalized"),
        compact_text(col).alias("compact"),
        digits_view(col).alias("digits"),
    )


def marker_count(col: Column, marker: str) -> Column:
    """Non-overlapping occurrences of a literal marker."""
    m = F.lit(marker)
    return F.floor(
        (F.length(col) - F.length(F.replace(col, m, F.lit("")))) / F.length(m)
    ).cast("bigint")


def strip_fences(col: Column) -> Column:
    """Drop a leading ``` line and the last trailing ```, then trim.

    Mirrors: strip, drop a first line that starts with ```, drop a final ```."""
    t = py_strip(col)
    t = F.when(
        t.startswith("```"),
        F.when(t.contains("\n"), F.regexp_replace(t, "^[^\\n]*\\n", "")).otherwise(F.substring(t, 4, 1 << 30)),
    ).otherwise(t)
    t = F.when(t.endswith("```"), F.regexp_replace(t, "```\\z", "")).otherwise(t)
    return py_strip(t)


def regex_quote(col: Column) -> Column:
    """Quote a column's text for use as a literal inside a Java regex."""
    return F.concat(F.lit("\\Q"), F.replace(col, F.lit("\\E"), F.lit("\\E\\\\E\\Q")), F.lit("\\E"))


def is_alnum_char(col: Column) -> Column:
    """Python ``str.isalnum`` for a one-character column."""
    return col.rlike("^[\\p{L}\\p{N}]$")


def bounded_search(candidate: Column, target: Column) -> Column:
    """If the candidate starts and ends with an alphanumeric character it
    must not touch [A-Za-z0-9] on either side; otherwise a plain substring.
    ``contains`` runs first so the regex only runs on real hits."""
    first = F.substring(candidate, 1, 1)
    last = F.substring(candidate, -1, 1)
    bounded = is_alnum_char(first) & is_alnum_char(last)
    # the candidate comes first and its left neighbour is looked at last, so that most places fail at one character
    quoted = regex_quote(candidate)
    pattern = F.concat(quoted, F.lit("(?![A-Za-z0-9])(?<![A-Za-z0-9]"), quoted, F.lit(")"))
    hit = target.contains(candidate)
    return (F.length(candidate) > 0) & hit & (~bounded | F.rlike(target, pattern))
