"""Audit (A2-A8): verdicts written by hand, the bounded match as a property, and the report."""

import json
import random

import pytest
from pyspark.sql import functions as F

from leafline.functions.text import bounded_search
from leafline.operators import audit as A

NO = ("unsupported", None)

#: (value as JSON, page text, verdict: kind and the candidate that was found)
CASES = [
    # whole numbers: as they are, grouped, as money, as a rank; never inside a longer run of letters or digits
    ("46", "46 students", ("exact", "46")),
    ("46", "no 460", NO),
    ("46", "rank #460", ("rank", "#46")),  # begins in no letter or digit, so it may be part of a run
    ("46", "a46", NO),
    ("46", "46.5 points", ("exact", "46")),
    ("234", "in all 1,234", ("exact", "234")),
    ("1234", "in all 1,234", ("formatted", "1,234")),
    ("1234", "in all 1234", ("exact", "1234")),
    ("1234", "for $1,234 a year", ("formatted", "1,234")),
    ("12", "no. 112 or 121", NO),
    ("12", "place #12", ("exact", "12")),
    ("123456789012345678901234567890", "123456789012345678901234567890", ("exact", "123456789012345678901234567890")),
    ("1", "1.0", ("exact", "1")),
    # fractions: without trailing zeros; from 0 to 1 as a percentage of up to three decimals
    ("1.0", "level 1 only", ("exact", "1")),
    ("0.2", "20% of them", ("percent", "20%")),
    ("0.2", "20 of them", ("percent_plain", "20")),
    ("0.2", "2% of them", NO),
    ("0.1", "exactly 0.1", ("exact", "0.1")),
    ("0.0", "0% left", ("exact", "0")),
    ("0.205", "20.5%", ("percent_plain", "20")),  # no decimals come first, and a point ends a run
    ("0.205", "the 20.5%", ("percent_plain", "20")),
    ("0.215", "21.5%", ("percent", "21.5%")),  # 22 without decimals
    ("0.4565", "45.65 %", ("percent_plain", "45.65")),
    ("2.5", "250%", NO),
    ("-0.5", "-50%", NO),
    # truth values
    ("true", "This is TRUE.", ("exact", "true")),
    ("false", "untrue or falsehood", NO),
    # strings: whole, run together, digits only, stand-ins of NA, dates the other way round
    ('"73%"', "share 173%", ("exact", "73%")),
    ('"Private"', "a private school", ("exact", "private")),
    ('"No"', "none known", NO),
    ('"No"', "NO!", ("exact", "no")),
    ('"New York"', "in NewYork", ("compact", "newyork")),
    ('"10-20"', "from 1020", ("compact", "1020")),
    ('"(555) 123-4567"', "Call 555.123.4567", ("compact", "5551234567")),
    ('"tel (555) 123-4567"', "555 123 4567", ("digits", "5551234567")),
    ('"no. 12-34"', "1234", NO),
    ('"NA"', "value n/a", ("na_token", "n/a")),
    ('"NA"', "Not available yet", ("na_token", "not available")),
    ('"NA"', "NA", ("exact", "na")),
    ('"n/a"', "value NA", ("compact", "na")),
    ('"May. 13"', "opens 05/13", ("date_variant", "05/13")),
    ('"May 3"', "opens 5/3", ("date_variant", "5/3")),
    ('"May. 3"', "opens May 03", ("date_variant", "may 03")),
    ('"05/13"', "opens May. 13", ("date_variant", "may. 13")),
    ('"5/3"', "opens may 03", ("date_variant", "may 03")),
    ('"13/05"', "opens May. 13", NO),
    ('"Mar 40"', "3/40", ("date_variant", "3/40")),
    ('""', "anything", NO),
    ('"   "', "anything", NO),
    ('" tidy "', "all tidy", ("exact", "tidy")),
    ('"ﬁle"', "the file", ("compact", "file")),
    ('"ＡBC"', "the abc", ("compact", "abc")),
    ("null", "null", ("unsupported_type", None)),
]


def verdicts(spark, cases, **options):
    recs = spark.createDataFrame([(i, '{"v": %s}' % v) for i, (v, _, _) in enumerate(cases)], "id long, json string")
    texts = spark.createDataFrame([(i, t) for i, (_, t, _) in enumerate(cases)], "id long, text string")
    rows = A.audit_leaves(A.audit_records(recs, texts, "id", **options), "id").collect()
    return {r["id"]: (r["match_type"], r["matched_candidate"]) for r in rows}


def test_hand_written_verdicts(spark):
    got = verdicts(spark, CASES)
    wrong = [(v, t, want, got.get(i)) for i, (v, t, want) in enumerate(CASES) if got.get(i) != want]
    assert not wrong


def plain(c):
    return c.isascii() and c.isalnum()


def stands_alone(needle, text):
    """Whether ``needle`` occurs; if it begins and ends in a letter or digit, not as part of a longer run."""
    for at in range(len(text) - len(needle) + 1):
        if all(text[at + k] == needle[k] for k in range(len(needle))):
            before = at > 0 and plain(text[at - 1])
            after = at + len(needle) < len(text) and plain(text[at + len(needle)])
            if not (needle[0].isalnum() and needle[-1].isalnum()) or not (before or after):
                return True
    return False


def test_bounded_match_equals_a_character_loop(spark):
    rng = random.Random(11)
    rows = []
    for _ in range(600):
        text = "".join(rng.choice("ab1%.,# $*(é") for _ in range(rng.randint(0, 14)))
        needle = "".join(rng.choice("ab1%.*(") for _ in range(rng.randint(1, 3)))
        rows.append((needle, text))
    df = spark.createDataFrame(rows, "n string, t string").select("n", "t", bounded_search(F.col("n"), F.col("t")).alias("hit"))
    assert [(r["n"], r["t"]) for r in df.collect() if r["hit"] != stands_alone(r["n"], r["t"])] == []


def test_report_and_summary(spark):
    record = {"a": {"x": 46, "y": "Private"}, "list": [1, "gone", None, [2, 3]], "z": 0.5}
    text = "A private school of 46; 1, 2 and 50%."
    # x, y, list[0], list[3][0] and z stand in the text; "gone", null and 3 don't
    recs = spark.createDataFrame([(1, json.dumps(record)), (2, '{"a": 1}'), (3, "{bad")], "id long, json string")
    texts = spark.createDataFrame([(1, text), (3, "x")], "id long, text string")
    rep = A.audit_entity(A.audit_records(recs, texts, "id"), "id")
    one = rep.where("id = 1").first()
    assert (one["total_fields"], one["supported_fields"], one["support_rate"]) == (8, 5, pytest.approx(0.625))
    assert one["match_types"]["exact"] == 4 and one["match_types"]["percent"] == 1 and one["match_types"]["unsupported_type"] == 1
    assert rep.where("id = 3").first()["match_types"] == {"invalid_json": 1}
    s = A.audit_summary(rep, recs, "id").first()
    assert s["missing_text"] == 1 and s["entities_audited"] == 2


def test_legacy_zero_strip(spark):
    case = [("0.2", "only 2% here", None)]
    assert verdicts(spark, case) == {0: NO}
    assert verdicts(spark, case, legacy_zero_strip=True) == {0: ("percent", "2%")}


def test_a_value_is_stripped_once_for_all_its_candidates(spark):
    from leafline.functions.candidates import string_candidates

    df = spark.createDataFrame([(" May. 5 ",), ("5/13",), ("13/05",), ("NA",), ("  ",), (None,)], "s string")
    got = df.select(string_candidates(F.col("s")).alias("c"))
    assert str(got._jdf.queryExecution().analyzed()).count("trim(") == 1
    assert [[c["text"] for c in r["c"]] for r in got.collect()] == [
        ["may. 5", "may5", "05/05", "5/5", "may 05"], ["5/13", "513", "may. 13", "may 13"], ["13/05", "1305"],
        ["na", "n/a", "a/v", "not available"], [], []]


def test_numbers_stand_in_the_number_view_where_they_stand_in_the_text(spark):
    from leafline.functions.text import compact_text, digits_view, number_view

    rng = random.Random(5)
    parts = ["1", "12", "0", ".", ",", "$", "#", "%", "-", " ", "\n", "a", "word", "é", "中", "😀", "٣", "e"]
    texts = ["", "no number at all " * 50, "12", "x12", "12x", "$12", "a...12", "1,234.5%"]
    texts += ["".join(rng.choice(parts) for _ in range(rng.randrange(1, 25))) for _ in range(400)]
    wanted = ["1", "12", "0", "1.0", "1,2", "$1", "#12", "12%", "-1", "0.12%", "1..0"]
    df = spark.createDataFrame([(t, w) for t in texts for w in wanted], "t string, w string").select(
        "t", "w", bounded_search(F.col("w"), F.col("t")).alias("text"), bounded_search(F.col("w"), number_view(F.col("t"))).alias("view"))
    got = df.collect()
    assert sum(r["text"] for r in got) > 100 and [r for r in got if r["text"] != r["view"]] == []
    one = spark.createDataFrame([("no number at all " * 50 + "or 12, in words. " * 2,)], "t string")
    assert one.select(number_view(F.col("t"))).first()[0] == "n 12,  12,  "
    odd = spark.createDataFrame([("ﬁ①a１٣-4 É",)], "t string").select(digits_view(F.col("t")), compact_text(F.col("t")))
    assert tuple(odd.first()) == ("１٣4", "fi1a14")


def test_the_audit_has_as_many_tasks_as_its_work_asks(spark):
    recs = spark.range(40).select("id", F.lit('{"a": 46}').alias("json"))
    audited = A.audit_records(recs, spark.range(40).select("id", F.lit("46 of them").alias("text")), "id")
    assert audited.rdd.getNumPartitions() == A.work_partitions(recs)  # few bytes, but not one task


def test_a_float_is_read_once_for_all_its_candidates(spark):
    from leafline.functions.candidates import float_candidates

    df = spark.createDataFrame([(0.205,), (0.0,), (-0.0,), (1.0,), (12.5,), (-0.5,), (1e-05,), (float("nan"),)], "d double")
    got = df.select(float_candidates(F.col("d") + 0.0).alias("c"))
    assert str(got._jdf.queryExecution().analyzed()).count("+ 0.0") <= 2  # the plan names it once, the schema may again
    assert [[c["text"] for c in r["c"]] for r in got.collect()][:3] == [
        ["0.205", "20%", "20", "20.5%", "20.5"], ["0", "0%"], ["0", "0%"]]
    plain = df.select(float_candidates(F.col("d"), legacy_zero_strip=True).alias("c")).collect()
    assert [c["text"] for c in plain[3]["c"]] == ["1", "1%", "100%", "100"] and len(plain[4]["c"]) == 1
