"""Near-duplicates by improved consistent weighted sampling.

A text is a set of five-word shingles, weighted by occurrences times inverse
document frequency.  Improved consistent weighted sampling draws ``BANDS *
ROWS`` samples of it; two texts agree in a sample with the probability of
their weighted Jaccard similarity.  Texts that agree in all rows of a band
are candidates; a candidate pair is a link if its exact weighted Jaccard
similarity is at least ``THRESHOLD``.  Classes are the connected components.

Document frequencies are counted over all rows in ``2^DF_BITS`` hashed cells, so
the table has a fixed size and shares below about one per cell count alike at
every corpus size.  The random numbers of a sample come from 16-bit hash
fields through tables of the distributions' quantiles.

Copies of a text are one node from the start.  Nodes of one bucket meet in
rounds: all members of other classes meet the node that shares buckets with most others,
the middle of a group of near copies, and classes are joined.  Once few pairs are
apart, or a round no longer helps, everything outside a bucket's largest class meets
all others of the bucket.  A large group of near copies that are links of
its middle costs a few tests per node; where a group's members are alike just below the
threshold, all its pairs are tested.

Every candidate pair of two classes is tested exactly; only a pair whose total weights alone
rule a link out is left.  The last pass deals each bucket to chunks of ``CHUNK_BYTES`` and takes the
overlap of one text with all others of two chunks from one inverted index, so its pairs are never
rows.  Pairs already in one class are not tested, so the links are those that join classes.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from leafline.llm import shingles as sh
from leafline.llm.common import giving_back, read_table, shared_table, small_side, text_or_empty
from leafline.llm.components import components

BANDS, ROWS, THRESHOLD = 8, 3, 0.8
DF_BITS = 18
#: bytes of sets in a chunk of a bucket; two chunks are in memory at a time
CHUNK_BYTES = 8_000_000
#: rounds of leaders end when at most so many pairs per member are still apart
SPARE = 4


def gamma_quantiles() -> tuple[np.ndarray, np.ndarray]:
    """Quantiles of Gamma(2, 1) at the 2^16 cell centres, and their logarithms."""
    grid = np.concatenate([np.linspace(0, 1, 4001)[1:], np.linspace(1, 30, 30001)[1:]])
    cdf = 1 - np.exp(-grid) * (1 + grid)
    q = np.interp((np.arange(1 << 16) + 0.5) / (1 << 16), cdf, grid)
    return q, np.log(q)


def _df_counter(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    table, held = sh.word_table(), np.zeros(1 << DF_BITS, np.int64)
    for batch in batches:
        texts = batch["text"].tolist()
        for a, b in sh.slices(texts):
            _, val, _ = sh.shingles(texts[a:b], table)
            held += np.bincount((val >> np.uint64(64 - DF_BITS)).astype(np.int64), minlength=len(held))
    at = np.flatnonzero(held)
    yield pd.DataFrame({"cell": at, "df": held[at]})


def idf_table(rows: DataFrame) -> np.ndarray:
    """ln(1 + N / df) of each hashed cell, from all rows."""
    n = rows.count()
    parts = rows.select("text").mapInPandas(giving_back(_df_counter), "cell int, df bigint")
    cells = parts.groupBy("cell").agg(F.sum("df").alias("df")).toArrow()
    df = np.ones(1 << DF_BITS)
    df[cells["cell"].to_numpy().astype(np.int64)] = cells["df"].to_numpy().astype(np.float64)
    return np.log1p(max(n, 1) / df)


def weigh(val: np.ndarray, tf: np.ndarray, idf: np.ndarray) -> np.ndarray:
    return tf * idf[(val >> np.uint64(64 - DF_BITS)).astype(np.int64)]


def _samples(doc, val, weight, n_docs, tables, samples):
    """Consistent weighted samples of every text: keys [sample, text].

    Texts without shingles get zeros; ``doc`` is sorted."""
    r_of, ln_of = tables
    has, first = np.unique(doc, return_index=True)
    out = np.zeros((samples, n_docs), np.uint64)
    if not len(has):
        return out
    ln_w = np.log(weight)
    span = np.diff(np.concatenate([first, [len(doc)]]))
    for k in range(samples):
        z = sh.mix(val ^ np.uint64((k * 0xD1B54A32D192ED03 + 0x8CB92BA72F3D8DD7) % (1 << 64)))
        r = r_of[(z & np.uint64(0xFFFF)).astype(np.int64)]
        beta = ((z >> np.uint64(32)) & np.uint64(0xFFFF)).astype(np.float64) / 65536.0
        t = np.floor(ln_w / r + beta)
        a = ln_of[((z >> np.uint64(16)) & np.uint64(0xFFFF)).astype(np.int64)] - r * (t - beta + 1.0)
        low = np.minimum.reduceat(a, first)
        hit = np.flatnonzero(a == np.repeat(low, span))
        hit = hit[np.unique(doc[hit], return_index=True)[1]]
        out[k, has] = sh.mix(val[hit] * sh.ODD + t[hit].astype(np.int64).astype(np.uint64))
    return out


def _signer(idf) -> Callable:
    def sign(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        table, quantiles = sh.word_table(), gamma_quantiles()
        for batch in batches:
            texts = batch["text"].tolist()
            for a, b in sh.slices(texts):
                doc, val, tf = sh.shingles(texts[a:b], table)
                w = weigh(val, tf, idf.value)
                s = _samples(doc, val, w, b - a, quantiles, BANDS * ROWS)
                keys = []
                for band in range(BANDS):
                    key = np.full(b - a, band + 1, np.uint64)
                    for row in range(band * ROWS, (band + 1) * ROWS):
                        key = sh.mix(key * sh.ODD + s[row])
                    keys.append(key.view(np.int64))
                total = np.bincount(doc, weights=w, minlength=b - a)
                bands = list(np.array(keys).T) if b > a else []
                for i in np.flatnonzero(total == 0):
                    bands[i] = np.zeros(0, np.int64)
                yield pd.DataFrame({
                    "_id": batch["_id"].iloc[a:b], "_g": batch["_g"].iloc[a:b], "_weight": total, "_bands": bands,
                })

    return sign


def _packer(idf) -> Callable:
    def pack(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        table = sh.word_table()
        for batch in batches:
            texts = batch["text"].tolist()
            for a, b in sh.slices(texts):
                doc, val, tf = sh.shingles(texts[a:b], table)
                w = weigh(val, tf, idf.value)
                cut = np.searchsorted(doc, np.arange(b - a + 1))
                yield pd.DataFrame({
                    "_g": batch["_g"].iloc[a:b],
                    "_len": np.diff(cut),
                    "_set": [val[i:j].tobytes() for i, j in zip(cut[:-1], cut[1:], strict=True)],
                    "_w": [w[i:j].tobytes() for i, j in zip(cut[:-1], cut[1:], strict=True)],
                })

    return pack


def _verifier(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        out = np.zeros(len(batch))
        cols = [batch[c].tolist() for c in ("_set_a", "_w_a", "_set_b", "_w_b")]
        for i, (sa, wa, sb, wb) in enumerate(zip(*cols, strict=True)):
            xa, xb = np.frombuffer(sa, np.uint64), np.frombuffer(sb, np.uint64)
            va, vb = np.frombuffer(wa), np.frombuffer(wb)
            _, ia, ib = np.intersect1d(xa, xb, assume_unique=True, return_indices=True)
            both = np.minimum(va[ia], vb[ib]).sum()
            out[i] = both / (va.sum() + vb.sum() - both)
        yield pd.DataFrame({"a": batch["a"], "b": batch["b"], "similarity": out})


def _joins(left, right, same, sets, weights, total, comp, threshold) -> list[tuple[int, int]]:
    """Links of texts ``left`` with texts ``right`` that join two classes; ``comp`` is updated.

    If ``same``, ``right`` begins with ``left`` and each pair is met once."""
    out: list[tuple[int, int]] = []
    if not len(left) or not len(right):
        return out
    doc = np.repeat(np.arange(len(right)), [len(sets[r]) for r in right])
    val = np.concatenate([sets[r] for r in right])
    order = np.argsort(val, kind="stable")
    doc, weight = doc[order], np.concatenate([weights[r] for r in right])[order]
    known, start = np.unique(val[order], return_index=True)
    stop = np.append(start[1:], len(val))
    for x in left:
        at, mine = np.searchsorted(known, sets[x]), weights[x]
        if same:
            start[at] += 1  # its own entries are the first of those that are left
        else:
            at = np.minimum(at, len(known) - 1)
            there = known[at] == sets[x]
            at, mine = at[there], mine[there]
        if (comp[right] == comp[x]).all():
            continue
        span = stop[at] - start[at]
        entry = np.repeat(start[at] - np.cumsum(span) + span, span) + np.arange(span.sum())
        both = np.bincount(doc[entry], np.minimum(weight[entry], np.repeat(mine, span)), len(right))
        for y in right[both >= (threshold - 1e-9) * (total[x] + total[right] - both)]:
            if comp[y] != comp[x]:
                comp[comp == comp[y]] = comp[x]
                out.append((x, y))
    return out


def _block(rows: pd.DataFrame, threshold: float) -> list[tuple[str, str]]:
    """Links within one chunk of a bucket, or between two, that join classes."""
    sets = [np.frombuffer(x, np.uint64) for x in rows["_set"]]
    weights = [np.frombuffer(x) for x in rows["_w"]]
    total = np.array([w.sum() for w in weights])
    comp, _ = pd.factorize(rows["_c"])
    outer = (rows["_c"] != rows["_big"]).to_numpy()
    lo, hi = rows["_lo"].iloc[0], rows["_hi"].iloc[0]
    held = sets, weights, total, comp, threshold
    if lo == hi:
        left, rest = np.flatnonzero(outer), np.flatnonzero(~outer)
        found = _joins(left, np.concatenate([left, rest]), True, *held)
    else:
        here = (rows["_own"] == lo).to_numpy()
        found = _joins(np.flatnonzero(here & outer), np.flatnonzero(~here), False, *held)
        found += _joins(np.flatnonzero(here & ~outer), np.flatnonzero(~here & outer), False, *held)
    g = rows["_g"].tolist()
    return [(min(g[x], g[y]), max(g[x], g[y])) for x, y in found]


def _blocks(threshold: float) -> Callable:
    """Links of blocks, whose rows follow each other."""
    def link(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held: list[pd.DataFrame] = []
        at = None
        for batch in batches:
            keys = batch[["_key", "_lo", "_hi"]].to_numpy(np.int64)
            cuts = [0, *(np.flatnonzero((keys[1:] != keys[:-1]).any(axis=1)) + 1), len(keys)]
            out = []
            for i, j in zip(cuts[:-1], cuts[1:], strict=True):
                if i == j:
                    continue
                if held and at != tuple(keys[i]):
                    out += _block(pd.concat(held), threshold)
                    held = []
                at = tuple(keys[i])
                held.append(batch.iloc[i:j])
            yield pd.DataFrame(out, columns=["a", "b"])
        if held:
            yield pd.DataFrame(_block(pd.concat(held), threshold), columns=["a", "b"])

    return link


def _verify(pairs: DataFrame, sets: DataFrame, threshold: float) -> DataFrame:
    """The pairs (``a``, ``b``) whose exact weighted Jaccard reaches the threshold."""
    def side(s):
        return sets.select(F.col("_g").alias(f"_g{s}"), F.col("_set").alias(f"_set{s}"), F.col("_w").alias(f"_w{s}"))

    full = pairs.join(side("_b"), F.col("b") == F.col("_g_b")).join(side("_a"), F.col("a") == F.col("_g_a"))
    out = full.select("a", "b", "_set_a", "_w_a", "_set_b", "_w_b").mapInPandas(
        giving_back(_verifier), "a string, b string, similarity double"
    )
    return shared_table(out.where(F.col("similarity") >= threshold - 1e-9).select("a", "b"), "near-links", batch_rows=500)


def _apart(bucket: DataFrame, classes: DataFrame | None) -> tuple[DataFrame, int, int]:
    """The members of buckets that hold several classes, with class ``_c``, the
    bucket's largest class ``_big`` and number of chunks ``_chunks``; the
    number of pairs across classes at most, and the number of members."""
    member = bucket.withColumn("_c", F.col("_g"))
    if classes is not None:
        of = classes.select(F.col("node").alias("_cn"), "comp")
        member = bucket.join(of, F.col("_g") == F.col("_cn"), "left").withColumn("_c", F.coalesce("comp", "_g"))
    member = member.select("_key", "_g", "_weight", "_len", "_pop", "_c")
    shares = member.groupBy("_key", "_c").agg(F.count(F.lit(1)).alias("_n"), F.sum("_len").alias("_l")).groupBy("_key").agg(
        F.max_by("_c", F.struct("_n", "_c")).alias("_big"), F.max("_n").alias("_most"), F.sum("_n").alias("_all"),
        F.ceil(F.sum("_l") * 16 / CHUNK_BYTES).cast("int").alias("_chunks"),
    ).where("_all > _most").select(F.col("_key").alias("_sk"), "_big", "_most", "_all", "_chunks")
    shares = shared_table(shares, "near-shares")
    pairs, rows = shares.agg(
        F.coalesce(F.sum(F.col("_all") * (F.col("_all") - F.col("_most"))), F.lit(0)), F.coalesce(F.sum("_all"), F.lit(0))
    ).first()
    out = member.join(shares.select("_sk", "_big", "_chunks"), F.col("_key") == F.col("_sk")).drop("_sk")
    return shared_table(out, "near-apart"), pairs, rows


def near_links(rows: DataFrame, threshold: float = THRESHOLD) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Signed rows, links between different texts, and classes of linked texts.

    ``rows`` has ``_id``, ``_g`` (text digest) and ``text``.  Returns ``signed``
    (``_id``, ``_g``), ``links`` that join classes (``a``, ``b``) and ``classes``
    (``node``, ``comp``) over text digests."""
    spark = rows.sparkSession
    idf = spark.sparkContext.broadcast(idf_table(rows))
    signed = shared_table(
        rows.mapInPandas(giving_back(_signer(idf)), "_id bigint, _g string, _weight double, _bands array<bigint>"),
        "near-signed", batch_rows=2000,
    )
    nodes = signed.groupBy("_g").agg(
        F.min("_id").alias("_min"), *[F.first(c).alias(c) for c in ("_weight", "_bands")]
    )
    banded = nodes.select("_g", "_min", "_weight", F.explode("_bands").alias("_key"))
    sizes = banded.groupBy("_key").agg(F.count(F.lit(1)).alias("_n")).where("_n > 1").select(F.col("_key").alias("_bk"), "_n")
    shared = shared_table(
        banded.join(sizes, F.col("_key") == F.col("_bk")).drop("_bk"), "near-shared"
    )
    # a text in the middle of its near copies shares buckets with most of them
    middle = shared.groupBy(F.col("_g").alias("_pg")).agg(F.sum("_n").alias("_pop"))
    involved = shared_table(shared.select(F.col("_g").alias("_ig"), F.col("_min").alias("_imin")).distinct(), "near-nodes")
    texts = rows.join(
        small_side(involved, 200_000), (F.col("_g") == F.col("_ig")) & F.col("_id").eqNullSafe(F.col("_imin"))
    ).select("_g", "text")
    sets = shared_table(
        texts.mapInPandas(giving_back(_packer(idf)), "_g string, _len bigint, _set binary, _w binary").dropDuplicates(["_g"]),
        "near-sets",
    )
    idf.destroy()

    known = sets.select(F.col("_g").alias("_kg"), "_len")
    bucket = shared_table(
        shared.join(middle, F.col("_g") == F.col("_pg")).join(known, F.col("_g") == F.col("_kg")).drop("_pg", "_kg", "_n"),
        "near-buckets",
    )

    def likely(weight_a, weight_b):
        return F.least(weight_a, weight_b) >= threshold * F.greatest(weight_a, weight_b) * (1 - 1e-9)

    tested = links = classes = None
    before = None
    while True:
        member, apart, rows_apart = _apart(bucket, classes)
        if tested is not None and (apart <= SPARE * rows_apart or apart > 0.7 * before):
            break
        # a round: each bucket's leader, the most shared node outside its largest class, meets the others
        before = apart
        best = F.max_by(F.struct("_g", "_weight", "_c"), F.struct("_pop", "_g"))
        outside = member if tested is None else member.where(F.col("_c") != F.col("_big"))
        leads = outside.groupBy("_key").agg(best.alias("_lead")).select(F.col("_key").alias("_lk"), "_lead")
        pairs = member.join(
            leads,
            (F.col("_key") == F.col("_lk")) & (F.col("_c") != F.col("_lead._c"))
            & likely(F.col("_weight"), F.col("_lead._weight")),
        ).select(F.least("_lead._g", "_g").alias("a"), F.greatest("_lead._g", "_g").alias("b")).distinct()
        if tested is not None:
            pairs = pairs.join(tested, ["a", "b"], "left_anti")
        pairs = shared_table(pairs, "near-pairs")
        tested = pairs if tested is None else tested.union(pairs)
        found = _verify(pairs, sets, threshold)
        links = found if links is None else links.union(found)
        classes = components(links)

    # what is still apart in a bucket: everything outside its largest class meets all others
    if apart:
        own = F.pmod(F.xxhash64("_g"), F.col("_chunks")).cast("int")
        dealt = member.select("_key", "_g", "_c", "_big", own.alias("_own"), F.explode(F.sequence(F.lit(0), F.col("_chunks") - 1)).alias("_to"))
        dealt = dealt.select("_key", "_g", "_c", "_big", "_own", F.least("_own", "_to").alias("_lo"), F.greatest("_own", "_to").alias("_hi"))
        side = sets.select(F.col("_g").alias("_sg"), "_set", "_w")
        whole = dealt.join(side, F.col("_g") == F.col("_sg")).drop("_sg")
        whole = whole.repartition("_key", "_lo", "_hi").sortWithinPartitions("_key", "_lo", "_hi")
        found = shared_table(whole.mapInPandas(giving_back(_blocks(threshold)), "a string, b string"), "near-links", batch_rows=500)
        links = links.union(found)
        classes = components(links)
    return signed.select("_id", "_g"), links, classes


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """Class of every row: ``_id``, ``_g`` (text digest), ``class_id``, ``kept_g``.

    ``class_id`` is the smallest id of the class, ``kept_g`` the digest of the text
    of the document to keep (smallest digest among rows of that id).

    Defined cases: null texts are empty; texts without words are only classed with equal texts;
    null ids are larger than any id; repeated rows share a class; an empty table gives
    none; other columns are not read."""
    rows = docs.select(
        F.col(id_col).cast("bigint").alias("_id"),
        F.md5(text_or_empty(text_col).cast("binary")).alias("_g"),
        text_or_empty(text_col).alias("text"),
    )
    signed, _, classes = near_links(rows, threshold)
    nodes = signed.groupBy("_g").agg(F.min("_id").alias("_min"))
    nodes = nodes.join(classes, F.col("_g") == F.col("node"), "left").withColumn("_c", F.coalesce("comp", "_g"))
    order = F.struct(F.col("_min").isNull(), F.col("_min"), F.col("_g"))
    kept = nodes.groupBy("_c").agg(F.min(order).alias("_k")).select(
        F.col("_c").alias("_kc"), F.col("_k._min").alias("class_id"), F.col("_k._g").alias("kept_g")
    )
    nodes = nodes.join(kept, F.col("_c") == F.col("_kc")).select(F.col("_g").alias("_ng"), "class_id", "kept_g")
    return signed.join(nodes, F.col("_g") == F.col("_ng")).drop("_ng")


def op4_near_duplicates(spark, sf_dir: str) -> DataFrame:
    """Near-duplicate class of all ``documents``; ``keep`` marks the one that stays."""
    out = near_duplicates(read_table(spark, sf_dir, "documents"))
    return out.select(
        F.col("_id").alias("doc_id"), "class_id",
        F.coalesce(F.col("_id") == F.col("class_id"), F.col("class_id").isNull()).alias("keep"),
    )
