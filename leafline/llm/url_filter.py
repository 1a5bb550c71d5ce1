"""URL filter: rules, and naive Bayes over segmented host and path words for the rest.

Rules name a host and the beginning of a path; the longest that fits decides.  URLs that
rules decide are the training rows of a multinomial naive Bayes classifier, which judges all others.

Segmentation.  Names of hosts run words together.  Word frequencies come from the text of
all pages; every run of letters in a host is split by Viterbi into the words of greatest
joint probability.  A run's substrings meet the frequency table in a join, so neither hosts nor frequencies
have to fit into one task; equal hosts, runs and URLs are worked on once.

All sums of log-odds are decimal, so a verdict doesn't depend on the order of rows."""

from __future__ import annotations

import math
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from leafline.llm.common import measured_side, read_table, shared_table, text_or_empty
from leafline.llm.terms import COUNTED, term_counter

# The rules of the query.
RULES = [
    ("allow", "org/"),
    ("block", "example.org/es/"),
    ("block", "example.org/en/1"),
    ("allow", "com/fr/"),
    ("block", "com/de/"),
]
# Words that speak for blocking wherever they stand in a host or path.
SEED_WORDS = [
    "ads", "adult", "bet", "bets", "betting", "casino", "cheap", "farm", "free", "gamble", "gambling", "loan", "loans",
    "lottery", "malware", "phishing", "pills", "poker", "porn", "sex", "spam", "track", "tracker", "viagra", "win", "xxx",
]
#: weight of one seed word, as a share of all training tokens
SEED_SHARE = 0.001
#: weight of one seed word among the word frequencies, as a share of all words
SEED_WORD_SHARE = 0.00001
#: code points of the longest word a host is split into
MAX_WORD = 24
#: added to each token's count in a class
ALPHA = 0.5
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
MARKUP = r"(?is)<(script|style)\b[^>]*>.*?</\1\s*>|<!--.*?-->|<[^>]*>|&#?\w+;"
#: runs of letters, or of digits, in a host or path
RUNS = r"[^\x00-\x60\x7B-\x7F]+|[0-9]+"


def split_url(url: Column) -> tuple[Column, Column]:
    """Host (A-Z lower-cased) and path; both empty without ``://``."""
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.substring(url, at + 3, F.char_length(url)))
    part = lambda i: F.coalesce(F.regexp_extract(rest, r"^([^/?#]*)([^?#]*)", i), F.lit(""))
    return F.translate(part(1), UPPER, LOWER), part(2)


def word_counts(pages: DataFrame, html_col: str = "html") -> DataFrame:
    """``(word, n)``: how often each word stands in the text of the pages."""
    holder = F.array(F.struct(F.lit("").alias("source"), F.lit(1).cast("bigint").alias("n")))
    texts = pages.select(
        F.lit("").alias("lang"), F.regexp_replace(text_or_empty(html_col), MARKUP, " ").cast("binary").alias("text"), holder.alias("holders")
    )
    counted = texts.mapInArrow(term_counter(), COUNTED)
    return counted.groupBy(F.col("term").alias("word")).agg(F.sum("n").alias("n"))


def _substrings(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Every substring of a run of at most ``MAX_WORD`` code points, with its place."""
    held: list[tuple[int, int, str]] = []
    for batch in batches:
        for rid, run in zip(batch["rid"], batch["run"], strict=True):
            for at in range(len(run)):
                held += [(rid, at, run[at:end]) for end in range(at + 1, min(at + MAX_WORD, len(run)) + 1)]
                if len(held) > 20_000:
                    yield pd.DataFrame(held, columns=["rid", "at", "word"])
                    held = []
    yield pd.DataFrame(held, columns=["rid", "at", "word"])


def viterbi(run: str, known: dict[tuple[int, int], int], total: int) -> list[str]:
    """The split of ``run`` of greatest unigram probability.

    ``known``: count of the word at (place, length).  An unknown word of k letters has probability
    10^(1-k) / total; of equal splits that with fewer words, then with the longer last word, wins."""
    rest = math.log(total + 1)
    best: list[tuple[float, int, int]] = [(0.0, 0, 0)]
    for end in range(1, len(run) + 1):
        options = []
        for size in range(1, min(MAX_WORD, end) + 1):
            n = known.get((end - size, size))
            logp = math.log(n) - rest if n else -rest - (size - 1) * math.log(10)
            before = best[end - size]
            options.append((round(before[0] + logp, 9), before[1] - 1, size))
        best.append(max(options))
    words, end = [], len(run)
    while end:
        size = best[end][2]
        words.append(run[end - size : end])
        end -= size
    return words[::-1]


def segment_runs(runs: DataFrame, words: DataFrame) -> DataFrame:
    """``(run, words)`` for each distinct ``run`` of letters, split by the counts ``(word, n)``."""
    runs = shared_table(runs.select("run").distinct().withColumn("rid", F.monotonically_increasing_id()), "url-runs")
    total = int(words.agg(F.sum("n")).first()[0] or 0)
    found = (
        runs.mapInPandas(_substrings, "rid bigint, at int, word string")
        .join(words, "word")
        .groupBy("rid").agg(F.collect_list(F.struct("at", F.char_length("word").alias("size"), "n")).alias("known"))
    )

    def split(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out = []
            for run, known in zip(batch["run"], batch["known"], strict=True):
                of = {(k["at"], k["size"]): k["n"] for k in known} if known is not None else {}
                out.append(viterbi(run, of, total))
            yield pd.DataFrame({"run": batch["run"], "words": out})

    return runs.join(found, "rid", "left").mapInPandas(split, "run string, words array<string>")


def match_rules(urls: DataFrame, rules: DataFrame) -> DataFrame:
    """``(uid, rule, action)`` of the longest rule that fits each of ``(uid, host, path)``.

    A URL's keys are the ends of its host by as many labels as rules have, each with the beginnings of its
    path by as many characters as rules have; a rule fits if it equals a key."""
    rules = rules.where(F.col("rule").isNotNull() & F.col("action").isin("allow", "block"))
    rules = rules.groupBy("rule").agg(F.max("action").alias("action"))  # block before allow
    host = F.substring_index("rule", "/", 1)
    shape = rules.select(F.size(F.split(host, r"\.")).alias("labels"), (F.char_length("rule") - F.char_length(host)).alias("chars"))
    labels = sorted(r[0] for r in shape.select("labels").distinct().collect())
    chars = sorted(r[0] for r in shape.select("chars").distinct().collect())
    if not labels:
        return urls.select("uid", F.lit("").alias("rule"), F.lit("").alias("action")).where(F.lit(False))
    ends = [F.when(F.size(F.split("host", r"\.")) >= k, F.substring_index("host", ".", -k)) for k in labels]
    starts = [F.when(F.char_length("path") >= k, F.substring("path", 1, k)) for k in chars]
    keys = F.array(*[F.concat(e, s) for e in ends for s in starts])
    fits = urls.select("uid", F.explode(F.array_distinct(F.array_compact(keys))).alias("rule")).join(measured_side(rules), "rule")
    first = F.max(F.struct(F.char_length("rule").alias("size"), F.col("action"), F.col("rule"))).alias("m")
    return fits.groupBy("uid").agg(first).select("uid", "m.rule", "m.action")


def _tokens(urls: DataFrame, words: DataFrame) -> tuple[DataFrame, DataFrame]:
    """``(host, token)`` per distinct host and ``(uid, token)`` per distinct URL."""
    runs = lambda c: F.regexp_extract_all(F.translate(c, UPPER, LOWER), F.lit(RUNS), F.lit(0))
    pieces = shared_table(
        urls.select("host").distinct().select("host", F.posexplode(runs(F.col("host"))).alias("place", "run")), "url-pieces"
    )
    digits = F.col("run").rlike("^[0-9]")
    split = segment_runs(pieces.where(~digits), words)
    letters = pieces.where(~digits).join(split, "run").select("host", "place", "words")
    numbers = pieces.where(digits).select("host", "place", F.array(F.lit("#")).alias("words"))
    of_host = shared_table(letters.unionByName(numbers), "url-words")
    token = F.when(F.col("t").rlike("^[0-9]"), "#").otherwise(F.col("t"))
    of_path = urls.select("uid", F.explode(runs(F.col("path"))).alias("t")).select("uid", F.concat(F.lit("path:"), token).alias("token"))
    return of_host, of_path


def judge_urls(
    pages: DataFrame, rules: DataFrame, words: DataFrame, seeds: list[str] | tuple[str, ...] = tuple(SEED_WORDS),
    id_col: str = "page_id", url_col: str = "url",
) -> DataFrame:
    """``(page_id, host, path, rule, verdict, words, score)`` for every row.

    ``rules``: ``(action, rule)``; ``words``: ``(word, n)``, the frequencies for the segmentation; ``seeds``: words that
    count as ``SEED_SHARE`` of all training tokens in blocked URLs, and as ``SEED_WORD_SHARE`` of all words.  ``words`` of the result are the host's, ``score``
    the log-odds of block; 0 and less is allow.

    Defined cases: a null URL or one without ``://`` has empty host and path; a URL is trained on as often as
    it occurs; tokens that no training row or seed has say nothing; without training rows of both classes
    the prior is even; a rule given with both actions blocks; numbers are one token ``#``; empty
    tables give no rows; repeated ids are rows of their own; other columns are not read."""
    spark = pages.sparkSession
    if seeds:
        heard = int(words.agg(F.sum("n")).first()[0] or 0)
        extra = [(w, max(1, round(SEED_WORD_SHARE * heard))) for w in seeds]
        words = words.unionByName(spark.createDataFrame(extra, "word string, n bigint")).groupBy("word").agg(F.sum("n").alias("n"))
    host, path = split_url(F.col(url_col).cast("string"))
    rows = pages.select(F.col(id_col).alias("page_id"), host.alias("host"), path.alias("path"))
    urls = rows.groupBy("host", "path").agg(F.count(F.lit(1)).alias("n")).withColumn("uid", F.monotonically_increasing_id())
    urls = shared_table(urls, "url-urls", 10_000)
    ruled = shared_table(urls.join(match_rules(urls, rules), "uid", "left"), "url-ruled", 10_000)
    of_host, of_path = _tokens(urls, words)
    host_tokens = of_host.select("host", F.explode("words").alias("t")).select("host", F.concat(F.lit("host:"), "t").alias("token"))

    # training counts, weighted by rows
    blocked = F.sum(F.when(F.col("action") == "block", F.col("n")).otherwise(0)).alias("b")
    allowed = F.sum(F.when(F.col("action") == "allow", F.col("n")).otherwise(0)).alias("a")
    known = ruled.where(F.col("action").isNotNull())
    by_host = known.groupBy("host").agg(blocked, allowed)
    counts = host_tokens.join(by_host, "host").select("token", "b", "a").unionByName(
        of_path.join(known.select("uid", "n", "action"), "uid").groupBy("token").agg(blocked, allowed)
    )
    counts = shared_table(counts.groupBy("token").agg(F.sum("b").alias("b"), F.sum("a").alias("a")), "url-counts", 10_000)
    prior = known.agg(blocked, allowed).first()
    trained = counts.agg(F.sum(F.col("a") + F.col("b"))).first()[0] or 0
    weight = max(1, round(SEED_SHARE * trained))
    seeded = [(f"{where}:{w}", weight, 0) for w in seeds for where in ("host", "path")]
    if seeded:
        counts = counts.unionByName(spark.createDataFrame(seeded, "token string, b bigint, a bigint"))
        counts = counts.groupBy("token").agg(F.sum("b").alias("b"), F.sum("a").alias("a"))
    sums = counts.agg(F.sum("b").alias("b"), F.sum("a").alias("a"), F.count(F.lit(1)).alias("v")).first()
    base = {c: math.log((sums[c] or 0) + ALPHA * (sums["v"] or 1)) for c in "ab"}
    exact = "decimal(38,9)"
    odds = F.log(F.col("b") + ALPHA) - base["b"] - F.log(F.col("a") + ALPHA) + base["a"]
    model = shared_table(counts.select("token", F.round(odds, 9).cast(exact).alias("odds")), "url-model", 10_000)
    lean = round(math.log(prior["b"] / prior["a"]), 9) if prior["a"] and prior["b"] else 0.0

    near = measured_side(model)
    host_odds = host_tokens.join(near, "token").groupBy("host").agg(F.sum("odds").alias("host_odds"))
    host_words = of_host.groupBy("host").agg(F.flatten(F.transform(F.sort_array(F.collect_list(F.struct("place", "words"))), lambda s: s["words"])).alias("words"))
    hosts = shared_table(host_words.join(host_odds, "host", "left"), "url-hosts", 10_000)
    path_odds = of_path.join(near, "token").groupBy("uid").agg(F.sum("odds").alias("path_odds"))
    zero = lambda c: F.coalesce(F.col(c), F.lit(0)).cast(exact)
    judged = (
        ruled.join(path_odds, "uid", "left").join(measured_side(hosts.select("host", "host_odds")), "host", "left")
        .withColumn("score", (zero("host_odds") + zero("path_odds") + F.lit(lean).cast(exact)).cast("double"))
        .withColumn("verdict", F.coalesce(F.col("action"), F.when(F.col("score") > 0, "block").otherwise("allow")))
        .select(F.col("host").alias("_host"), F.col("path").alias("_path"), "rule", "verdict", "score")
    )
    judged = shared_table(judged, "url-judged", 10_000)
    names = hosts.select(F.col("host").alias("_named"), F.array_join("words", " ").alias("words"))
    out = rows.join(measured_side(judged), (F.col("host") == F.col("_host")) & (F.col("path") == F.col("_path")))
    out = out.join(measured_side(names), F.col("host") == F.col("_named"), "left")
    return out.select("page_id", "host", "path", "rule", "verdict", F.coalesce("words", F.lit("")).alias("words"), "score")


def op11_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Verdicts on every URL of ``pages``; words are counted in the text of all pages."""
    pages = read_table(spark, sf_dir, "pages")
    words = shared_table(word_counts(pages), "url-lexicon")
    return judge_urls(pages, spark.createDataFrame(RULES, "action string, rule string"), words)


#: the Viterbi split has no SQL here; tested against brute force
ORACLES: dict[str, str] = {}
