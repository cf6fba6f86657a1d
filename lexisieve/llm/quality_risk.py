"""Quality rules with risk-controlled thresholds.

Every document gets counts (one vectorised pass over whole texts) and six
rule values, each a share in whole percent where higher is worse. A rule may
reject at ``value >= cutoff``. Cutoffs are chosen per stratum (language) from
labelled documents: the candidates 100, 99, ... 1 are fixed before the data
are seen and tested from lax to strict; a cutoff passes when the exact
binomial (Clopper-Pearson) upper bound of its false-rejection rate among good
documents is at most ``alpha / rules``. Testing stops at the first failure
(fixed-sequence); of those that passed, the one that separates the labels
best is used. The level is ``delta / (strata * rules)``
(Bonferroni), so with probability 1 - delta, in every stratum at once, all
rules together reject at most a share ``alpha`` of good documents. A stratum
with too few labels gets no cutoff: nothing is rejected there.

Defined results: null text or no word: all counts 0, ``base_failed``. Null
``lang`` is a stratum of its own. Null label rows are ignored; a document
with several labels is good only if all say so; labels of unknown documents
count nowhere; documents sharing an id are each joined to that id's label.
Empty tables give an empty result. Extra columns are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lexisieve.llm import words as W
from lexisieve.llm.tasks import map_arrow
from lexisieve.session import materialize

RULES = ("symbols", "dup_lines", "repeats", "capitals", "punctuation", "sameness")
COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
MIN_WORDS = 50
MAX_REPEAT_PERCENT = 50
_FEATURES = "doc_id long, lang string, text_hash long, " + ", ".join(f"{c} long" for c in COUNTS) + ", " + \
    ", ".join(f"{r} int" for r in RULES)


def _byte_set(chars: str) -> np.ndarray:
    out = np.zeros(256, bool)
    out[[ord(c) for c in chars]] = True
    return out


_SYMBOL = _byte_set("#*$%&|<>")
_CAPITAL = _byte_set("ABCDEFGHIJKLMNOPQRSTUVWXYZ")
_PUNCT = _byte_set("!\"'(),-./:;?[]^_`{}~+=@\\")
_HEAD = np.ones(256, bool)  # first bytes of code points
_HEAD[0x80:0xC0] = False


def _percent(part: np.ndarray, whole: np.ndarray) -> np.ndarray:
    return np.minimum(100, (100 * part) // np.maximum(whole, 1)).astype(np.int32)


def _lines(text: str | None) -> tuple[int, int]:
    """(lines with a word, those equal to an earlier one)."""
    if not text:
        return 0, 0
    found = [x for x in text.split("\n") if x.strip(" \t\n\x0b\x0c\r")]
    return len(found), len(found) - len(set(found))


def _repeats(h: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Per row, the words inside 3-word windows that the row has twice or more."""
    rows = len(first) - 1
    out = np.zeros(rows, np.int64)
    if len(h) < 3:
        return out
    row = np.repeat(np.arange(rows), np.diff(first))
    whole = row[2:] == row[:-2]
    at = np.flatnonzero(whole)
    if not len(at):
        return out
    win = h[at] * np.uint64(3) + W.mix(h[at + 1]) * np.uint64(5) + W.mix(W.mix(h[at + 2])) * np.uint64(7)
    key = W.mix(win) ^ W.mix(row[at].astype(np.uint64) + np.uint64(1))
    order = np.argsort(key)
    k = key[order]
    same = np.zeros(len(k) + 1, bool)
    same[1:-1] = k[1:] == k[:-1]
    twice = at[order[same[1:] | same[:-1]]]
    hit = np.zeros(len(h), bool)
    for i in range(3):
        hit[twice + i] = True
    return np.bincount(row[hit], minlength=rows).astype(np.int64)


def _distinct(h: np.ndarray, first: np.ndarray) -> np.ndarray:
    rows = len(first) - 1
    row = np.repeat(np.arange(rows), np.diff(first))
    order = np.lexsort((h, row))
    r, k = row[order], h[order]
    new = np.ones(len(k), bool)
    if len(k):
        new[1:] = (k[1:] != k[:-1]) | (r[1:] != r[:-1])
    return np.bincount(r[new], minlength=rows).astype(np.int64)


def _features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        texts = batch.column("text")
        raw, offsets = W.text_bytes(texts)
        for a, b in W.pieces(offsets):
            off, part = offsets[a:b + 1] - offsets[a], raw[offsets[a]:offsets[b]]
            starts, ends, first = W.spans(part, off, "space")
            h = W.hashes(part, starts, ends, lower=False)
            n = np.diff(first)

            def count(mask):
                return np.diff(np.concatenate([[0], np.cumsum(mask[part])])[off])
            chars = count(_HEAD & W.CLASSES["space"])
            sym, caps, punct = count(_SYMBOL), count(_CAPITAL), count(_PUNCT)
            lines = np.array([_lines(x) for x in texts.slice(a, b - a).to_pylist()], np.int64).reshape(-1, 2)
            rep, dist = _repeats(h, first), _distinct(h, first)
            same = np.where(n >= MIN_WORDS, _percent(n - dist, n), 0)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id").slice(a, b - a), batch.column("lang").slice(a, b - a),
                 batch.column("text_hash").slice(a, b - a)]
                + [pa.array(x.astype(np.int64)) for x in (n, chars, sym, lines[:, 1], rep)]
                + [pa.array(x.astype(np.int32)) for x in (
                    _percent(sym, chars), _percent(lines[:, 1], lines[:, 0]), _percent(rep, n),
                    _percent(caps, chars), _percent(punct, chars), same)],
                ["doc_id", "lang", "text_hash", *COUNTS, *RULES])


def measure(docs: DataFrame) -> DataFrame:
    """(doc_id, lang, text_hash, counts, rule values, base_failed) of every document."""
    lang = F.col("lang").cast("string") if "lang" in docs.columns else F.lit(None).cast("string")
    text = F.col("text").cast("string")
    out = map_arrow(docs.select(F.col("doc_id").cast("long"), lang.alias("lang"), F.xxhash64(text).alias("text_hash"),
                                text.alias("text")), _features, _FEATURES)
    failed = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words"))
    return out.withColumn("base_failed", failed)


def binomial_tail(k: int, n: int, p: float) -> float:
    """P(X <= k) for X ~ Binomial(n, p), summed exactly in log space."""
    if k >= n:
        return 1.0
    logs = [math.lgamma(n + 1) - math.lgamma(i + 1) - math.lgamma(n - i + 1)
            + i * math.log(p) + (n - i) * math.log1p(-p) for i in range(k + 1)]
    top = max(logs)
    return min(1.0, math.exp(top) * math.fsum(math.exp(x - top) for x in logs))


def choose_cutoff(rejected: list[int], bad: list[int], alpha: float, level: float, price: float) -> int | None:
    """The most useful cutoff of those that pass. ``rejected[c]`` / ``bad[c]``
    are the good / bad documents with value >= c. Cutoffs are tested from 100
    down until one fails; the Clopper-Pearson upper bound is at most alpha
    exactly when P(X <= k; n, alpha) <= level. All that pass hold their bound
    at once, so any may be taken: the one with the best share of bad documents
    rejected less ``price`` times that of good ones; of equals the middle one.
    Without a bad document rejected there is no cutoff."""
    n, n_bad, passed = rejected[0], max(bad[0], 1), []
    for c in range(100, 0, -1):
        k = rejected[c]
        if k > alpha * n or binomial_tail(k, n, alpha) > level:
            break
        passed.append((bad[c] / n_bad - price * k / n, c))
    best = max(passed, default=(0, 0))[0]
    if best <= 0:
        return None
    equal = [c for gain, c in passed if gain == best]
    return equal[len(equal) // 2]


def learn_cutoffs(features: DataFrame, labels: DataFrame, alpha: float, delta: float, price: float = 20.0) -> dict:
    """{(lang, rule): cutoff}. Labelled documents are counted per (stratum,
    rule, value, label) by Spark; only those counts (at most 1,212 for each
    stratum able to pass) come to the driver."""
    known = labels.where(F.col("doc_id").isNotNull() & F.col("quality").isNotNull()).groupBy("doc_id") \
        .agg((F.min("quality") >= 1).alias("good")).select(F.col("doc_id").cast("long").alias("doc_id"), "good")
    rows = features.where(~F.col("base_failed")).select("doc_id", "lang", *RULES).join(known, "doc_id")
    pairs = F.explode(F.array(*[F.struct(F.lit(r).alias("rule"), F.col(r).alias("value")) for r in RULES]))
    counts = rows.select("lang", "good", pairs.alias("_p")).groupBy("lang", "good", "_p.rule", "_p.value") \
        .agg(F.count(F.lit(1)).alias("n"))
    # Fewest good documents with which even no rejection passes at level delta / rules.
    least = math.ceil(math.log(delta / len(RULES)) / math.log1p(-alpha / len(RULES)))
    able = rows.where("good").groupBy("lang").agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") >= least)
    counts = counts.join(able.select(F.col("lang").alias("_l")), F.col("lang").eqNullSafe(F.col("_l")), "left_semi")
    table: dict[tuple, dict] = {}
    for r in counts.toLocalIterator():
        table.setdefault((r["lang"], r["rule"]), {True: [0] * 101, False: [0] * 101})[r["good"]][r["value"]] += r["n"]
    strata = len({lang for lang, _ in table})
    found = {}
    for key, by_value in table.items():
        good, bad = ([int(x) for x in np.cumsum(by_value[g][::-1])[::-1]] for g in (True, False))
        cut = choose_cutoff(good, bad, alpha / len(RULES), delta / (len(RULES) * strata), price)
        if cut is not None:
            found[key] = cut
    return found


def judge(features: DataFrame, cutoffs: dict) -> DataFrame:
    """Adds ``broken`` (names of rules that reject) and ``kept``."""
    by_lang: dict = {}
    for (lang, rule), cut in cutoffs.items():
        by_lang.setdefault(lang, {})[rule] = cut
    spark = features.sparkSession
    schema = "_lang string, " + ", ".join(f"_{r} int" for r in RULES)
    table = spark.createDataFrame([(k, *[v.get(r) for r in RULES]) for k, v in by_lang.items()], schema)
    # One row per stratum with cutoffs: at most (labelled documents / least) rows.
    out = features.join(table, F.col("lang").eqNullSafe(F.col("_lang")), "left")
    broken = F.array_compact(F.array(*[F.when(F.col(r) >= F.col(f"_{r}"), F.lit(r)) for r in RULES]))
    out = out.withColumn("broken", broken)
    return out.withColumn("kept", ~F.col("base_failed") & (F.size("broken") == 0)) \
        .drop("_lang", *[f"_{r}" for r in RULES])


def quality_rules(docs: DataFrame, labels: DataFrame, alpha: float = 0.03, delta: float = 0.05) -> DataFrame:
    """Counts, rule values and verdict of every document; cutoffs learnt from
    ``labels`` (doc_id, quality). Features are written once and read by both
    the learning and the judging step."""
    features = materialize(measure(docs), "quality-features")
    return judge(features, learn_cutoffs(features, labels, alpha, delta))
