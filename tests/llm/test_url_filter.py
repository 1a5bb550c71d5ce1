import itertools
import math
import random
import re
from collections import Counter

from pyspark.sql import functions as F

import leafline.llm.url_filter as U
from leafline.llm.url_filter import RULES, judge_urls, segment_runs, split_url, viterbi, word_counts

SCHEMA = "page_id long, url string, html string, host string, path string, rule string, uid string, n string, token string"
WORDS = {"cheap": 50, "pills": 20, "pill": 30, "news": 90, "new": 80, "s": 40, "paper": 60, "a": 200, "town": 25, "\u00e9t\u00e9": 9}


def table(spark, urls):
    return spark.createDataFrame([(i, u, "<p>x", *"xxxxxx") for i, u in urls], SCHEMA)


def lexicon(spark, words=None):
    return spark.createDataFrame(list((WORDS if words is None else words).items()), "word string, n bigint")


def rules_of(spark, rules=RULES):
    return spark.createDataFrame(rules, "action string, rule string") if rules else spark.createDataFrame([], "action string, rule string")


def parsed(url):
    if url is None or "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    host, path = re.match(r"([^/?#]*)([^?#]*)", rest).groups()
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in host), path


def ruled(host, path, rules):
    best = None
    for action, rule in rules:
        h, p = rule.split("/", 1) if "/" in rule else (rule, None)
        if (host == h or host.endswith("." + h)) and (p is None or path.startswith("/" + p)):
            best = max(best or (0, "", ""), (len(rule), action, rule))
    return best


def split_word(run, words):
    """Best of all splits, by the same tie rules."""
    total = sum(words.values())

    def logp(w):
        return math.log(words[w] / (total + 1)) if w in words else -math.log(total + 1) - (len(w) - 1) * math.log(10)

    best = None
    for cuts in itertools.product([0, 1], repeat=len(run) - 1):
        parts, at = [], 0
        for k, c in enumerate(cuts):
            if c:
                parts.append(run[at : k + 1])
                at = k + 1
        parts.append(run[at:])
        key = (sum(map(logp, parts)), -len(parts))
        if best is None or key > best[0]:
            best = (key, parts)
    return best[0][0], best[1]


def probability(parts, words):
    total = sum(words.values())
    return sum(math.log(words[w] / (total + 1)) if w in words else -math.log(total + 1) - (len(w) - 1) * math.log(10) for w in parts)


URLS = [
    "http://a.example.org/es/1", "https://EXAMPLE.org/en/17", "http://example.org/en/2", "http://x.org", "http://x.org?y", "http://x.org/",
    "http://b.com/fr/7", "http://b.com/de/7", "http://notexample.org/es/1", "HTTP://C.COM/fr?x", "ftp://c.com/fr", "no url", None, "", "://",
    "http://u:p@h.org:80/es", "x://y://z/a", "http://\u00c9T\u00c9.org/A/B#c?d", "http://cheap-pills.net/x", "http://cheappills.net/1/2",
    "http://newspaper.town.net/a", "http:///only/path", "http://com/fr/", "http://org/", "http://a..org/es\nline", "http://" + "ab." * 300 + "org/" + "p/" * 500,
]


def test_split_url(spark):
    host, path = split_url(F.col("url"))
    got = table(spark, enumerate(URLS)).select("url", host.alias("h"), path.alias("p")).collect()
    assert all((r["h"], r["p"]) == parsed(r["url"]) for r in got)


def test_rules_and_rows(spark):
    urls = [(i, u) for i, u in enumerate(URLS)] + [(3, URLS[3]), (None, URLS[0]), (None, URLS[0])]
    more = RULES + [("block", "example.org/en/2"), ("allow", "example.org/en/2"), ("allow", "town.net"), ("deny", "net/"), ("block", None)]
    got = judge_urls(table(spark, urls), rules_of(spark, more), lexicon(spark)).collect()
    assert sorted(str(r["page_id"]) for r in got) == sorted(str(i) for i, _ in urls)
    valid = [r for r in more if r[0] != "deny" and r[1]]
    want = Counter()
    for i, u in urls:
        want[(i, *parsed(u), (ruled(*parsed(u), valid) or (0, None, None))[2])] += 1
    assert Counter((r["page_id"], r["host"], r["path"], r["rule"]) for r in got) == want
    for r in got:
        best = ruled(r["host"], r["path"], valid)
        assert r["verdict"] == (best[1] if best else "block" if r["score"] > 0 else "allow")


def test_viterbi_is_the_best_split():
    rng = random.Random(5)
    for _ in range(60):
        run = "".join(rng.choice(["cheap", "pill", "s", "new", "a", "x", "town"]) for _ in range(rng.randint(1, 4)))[:13]
        known = {(i, j - i): WORDS[run[i:j]] for i in range(len(run)) for j in range(i + 1, len(run) + 1) if run[i:j] in WORDS}
        got = viterbi(run, known, sum(WORDS.values()))
        assert "".join(got) == run
        assert abs(probability(got, WORDS) - split_word(run, WORDS)[0]) < 1e-6


def test_segment_runs(spark):
    runs = ["cheappills", "newspaper", "zzz", "\u00e9t\u00e9town", "x" * 2000, "cheappills"]
    got = {r["run"]: r["words"] for r in segment_runs(spark.createDataFrame([(r,) for r in runs], "run string"), lexicon(spark)).collect()}
    assert got["cheappills"] == ["cheap", "pills"] and got["newspaper"] == ["news", "paper"] and got["zzz"] == ["zzz"]
    assert got["\u00e9t\u00e9town"] == ["\u00e9t\u00e9", "town"] and "".join(got["x" * 2000]) == "x" * 2000 and len(got) == 5


def tokens(host, path, words):
    low = lambda s: "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in s)
    out = []
    for run in re.findall(U.RUNS, low(host)):
        out += ["host:#"] if run[0].isdigit() else ["host:" + w for w in split_word(run, words)[1]]
    return out + ["path:" + ("#" if run[0].isdigit() else run) for run in re.findall(U.RUNS, low(path))]


def test_scores_equal_brute_force(spark):
    rng = random.Random(2)
    hosts = ["news.com", "cheappills.com", "newtown.org", "paper.net", "a.net", "pillpaper.net", "example.org"]
    urls = [(i, f"http://{rng.choice(hosts)}/{rng.choice(['de', 'fr', 'en', 'es'])}/{rng.choice(['news', 'pills', '12'])}") for i in range(200)]
    got = {r["page_id"]: r for r in judge_urls(table(spark, urls).repartition(5), rules_of(spark), lexicon(spark), seeds=()).collect()}
    counts, rows = {"block": Counter(), "allow": Counter()}, Counter()
    for _, u in urls:
        if best := ruled(*parsed(u), RULES):
            counts[best[1]].update(tokens(*parsed(u), WORDS))
            rows[best[1]] += 1
    known = set(counts["block"]) | set(counts["allow"])
    for i, u in urls:
        score = math.log(rows["block"] / rows["allow"])
        for t in tokens(*parsed(u), WORDS):
            if t in known:
                for c, sign in (("block", 1), ("allow", -1)):
                    score += sign * math.log((counts[c][t] + U.ALPHA) / (sum(counts[c].values()) + U.ALPHA * len(known)))
        assert abs(got[i]["score"] - score) < 1e-6
    assert {r["verdict"] for r in got.values() if r["rule"] is None} == {"allow", "block"}


def test_seeds_block_unseen_hosts(spark):
    urls = [(i, f"http://news{'' if i % 2 else 'paper'}.org/fr/{i}") for i in range(20)] + [(50 + i, f"http://town.com/de/{i}") for i in range(20)]
    urls += [(100, "http://freecasino.net/x"), (101, "http://news.net/x")]
    got = {r["page_id"]: r for r in judge_urls(table(spark, urls), rules_of(spark), lexicon(spark)).collect()}
    assert got[100]["words"] == "free casino net" and got[100]["verdict"] == "block" and got[101]["verdict"] == "allow"


def test_word_counts(spark):
    df = spark.createDataFrame([(1, "<p class='hidden'>One two</p><script>var three</script>ONE"), (2, None), (3, ""), (4, "<b>two &amp; one")], "page_id int, html string")
    assert {r["word"]: r["n"] for r in word_counts(df).collect()} == {"one": 3, "two": 2}


def test_empty_tables(spark):
    assert judge_urls(table(spark, []), rules_of(spark), lexicon(spark)).collect() == []
    got = judge_urls(table(spark, enumerate(URLS)), rules_of(spark, []), lexicon(spark, {"x": 1}).where("n > 5"), seeds=()).collect()
    assert len(got) == len(URLS) and {r["verdict"] for r in got} == {"allow"}
