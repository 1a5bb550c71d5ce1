"""A2-A5: the texts under which an extracted value may appear in its page.

Each function returns ``array<struct<text string, kind string>>`` in the
order the audit tries them; the first candidate found in the text decides.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from leafline.functions.numbers import py_fixed, py_float_repr, strip_float_text
from leafline.functions.text import compact_text, digits_view, py_strip

# Fixed values (must equal the reference's): month abbreviations, in order.
MONTH_ABBREVIATIONS = ["jan", "feb", "mar", "apr", "may", "jun", "jul", "aug", "sep", "oct", "nov", "dec"]
# Tokens that support a value of "NA", in the order tried.
NA_TOKENS = ["n/a", "a/v", "na", "not available"]

CAND_T = "array<struct<text:string,kind:string>>"


def _c(text: Column, kind: str, cond: Column | None = None) -> Column:
    s = F.struct(text.alias("text"), F.lit(kind).alias("kind"))
    return s if cond is None else F.when(cond, s)


def _let(value: Column, body) -> Column:
    """``body(value)`` with ``value`` computed once a row, however often the body names it."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def _compact_nulls(arr: Column) -> Column:
    return F.filter(arr, lambda c: c.isNotNull())


def dedupe_candidates(arr: Column, strip: bool = False) -> Column:
    """A5: key = stripped text; empty keys dropped; first kind wins.

    An element stays where its key stands for the first time.  The generators here
    build every candidate from the already stripped value, so stripping
    again is skipped unless ``strip`` (for candidate arrays from elsewhere)."""
    if strip:
        arr = F.transform(arr, lambda c: F.struct(py_strip(c["text"]).alias("text"), c["kind"].alias("kind")))
    nonempty = F.filter(arr, lambda c: c["text"] != "")
    return _let(nonempty, lambda kept: _let(F.transform(kept, lambda c: c["text"]), lambda texts: F.filter(
        kept, lambda c, i: F.array_position(texts, c["text"]) == i + 1)))


def group_thousands(int_text: Column) -> Column:
    """``f"{v:,}"`` for an integer given as text (any size)."""
    return F.regexp_replace(int_text, "(\\d)(?=(\\d{3})+$)", "$1,")


def int_candidates(int_text: Column) -> Column:
    """A2 ints: exact, thousands-grouped, currency, rank.  Not deduplicated."""
    g = F.when(F.length(int_text) < 4, int_text).otherwise(group_thousands(int_text))
    return F.array(
        _c(int_text, "exact"),
        _c(g, "formatted"),
        _c(F.concat(F.lit("$"), g), "currency"),
        _c(F.concat(F.lit("#"), int_text), "rank"),
    )


def bool_candidates(b: Column) -> Column:
    return F.array(_c(F.when(b, F.lit("true")).otherwise(F.lit("false")), "exact"))


def _strip_zeros(s: Column, legacy_zero_strip: bool) -> Column:
    if legacy_zero_strip:
        # the reference's formatting strips zeros even without a point ("20" -> "2")
        return F.regexp_replace(F.regexp_replace(s, "0+$", ""), "\\.$", "")
    return strip_float_text(s)


def float_candidates(d: Column, legacy_zero_strip: bool = False) -> Column:
    """A2 floats: repr with zeros trimmed; for 0 <= v <= 1 also 100*v at
    0..3 decimals, with and without ``%``; then A5."""

    def percents(pct: Column) -> Column:
        forms = F.transform(F.array(*[py_fixed(pct, n) for n in range(4)]), lambda f: _strip_zeros(f, legacy_zero_strip))
        kept = F.filter(forms, lambda f: f != "")
        return F.flatten(F.transform(kept, lambda f: F.array(_c(F.concat(f, F.lit("%")), "percent"), _c(f, "percent_plain"))))

    def candidates(v: Column) -> Column:
        raw = _let(py_float_repr(v), strip_float_text)
        share = F.when((v >= 0) & (v <= 1), _let(v * F.lit(100.0), percents))
        return dedupe_candidates(F.concat(F.array(_c(raw, "exact")), F.coalesce(share, F.array().cast(CAND_T))))

    return _let(d, candidates)


def month_variants(v: Column) -> Column:
    """A4: ``Mon dd`` (optional dot) -> ``mm/dd``, ``m/d``, ``mon dd``; empty for other texts."""
    pat = "(?U)^([A-Za-z]{3})\\.?\\s+(\\d{1,2})$"
    names = F.array(*[F.lit(m) for m in MONTH_ABBREVIATIONS])

    def forms(d: Column) -> Column:
        mon = F.array_position(names, d["name"])
        texts = _let(mon.cast("string"), lambda m: F.array(
            F.concat(F.lpad(m, 2, "0"), F.lit("/"), d["dd"]), F.concat(m, F.lit("/"), d["day"]), F.concat(d["name"], F.lit(" "), d["dd"])))
        return F.when((mon > 0) & d["day"].isNotNull(), texts)

    return _dates(F.when(v.rlike(pat), _let(_date_parts(F.lower(F.regexp_extract(v, pat, 1)), F.regexp_extract(v, pat, 2)), forms)))


def slash_date_variants(v: Column) -> Column:
    """A4: ``m/d`` -> ``mon. dd``, ``mon. d``, ``mon dd``; a month outside
    1..12 gives no variants (the reference raises there), as do other texts."""
    pat = "(?U)^(\\d{1,2})/(\\d{1,2})$"
    names = F.array(*[F.lit(m) for m in MONTH_ABBREVIATIONS])

    def forms(d: Column) -> Column:
        texts = _let(F.get(names, d["name"].try_cast("int") - 1), lambda name: F.array(
            F.concat(name, F.lit(". "), d["dd"]), F.concat(name, F.lit(". "), d["day"]), F.concat(name, F.lit(" "), d["dd"])))
        return F.when(d["name"].try_cast("int").between(1, 12) & d["day"].isNotNull(), texts)

    return _dates(F.when(v.rlike(pat), _let(_date_parts(F.regexp_extract(v, pat, 1), F.regexp_extract(v, pat, 2)), forms)))


def _date_parts(name: Column, digits: Column) -> Column:
    """The parts of a date text: the month as it stands, the day without and with its leading zero."""
    day = digits.try_cast("int").cast("string")
    return F.struct(name.alias("name"), day.alias("day"), F.lpad(day, 2, "0").alias("dd"))


def _dates(texts: Column) -> Column:
    """``date_variant`` candidates of a list of texts; none for NULL."""
    return F.coalesce(F.transform(texts, lambda t: _c(t, "date_variant")), F.array().cast(CAND_T))


def string_candidates(s: Column) -> Column:
    """A3: exact (lower), compact, NA tokens, digits (>= 7), date variants; A5."""
    none = F.array().cast(CAND_T)

    def candidates(v: Column) -> Column:
        first = F.array(
            _c(F.lower(v), "exact"), _c(compact_text(v), "compact"),
            *[_c(F.lit(t), "na_token", v == "NA") for t in NA_TOKENS],
            _let(digits_view(v), lambda d: _c(d, "digits", F.length(d) >= 7)),
        )
        return dedupe_candidates(F.concat(_compact_nulls(first), month_variants(v), slash_date_variants(v)))

    return _let(py_strip(s), lambda v: F.when(v == "", none).otherwise(candidates(v)))


def leaf_candidates(kind: Column, value, value_text: Column, legacy_zero_strip: bool = False) -> Column:
    """Candidates for a leaf given its Python kind (see ``scalar_kind``)."""
    return (
        F.when(kind == "str", string_candidates(value_text))
        .when(kind == "int", int_candidates(value_text))
        .when(kind == "bool", bool_candidates(F.variant_get(value, "$", "boolean")))
        .when(kind == "float", float_candidates(F.variant_get(value, "$", "double"), legacy_zero_strip))
        .otherwise(F.array().cast(CAND_T))
    )
