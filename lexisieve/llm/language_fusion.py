"""Language identification by Bayesian evidence fusion, in DataFrame functions.

For every page the log posterior of a language is the sum of four parts:

- text: naive Bayes over the page's words, the word counts being those of all
  labelled documents (add-one smoothing; tags, scripts and entities removed);
- declared: the markup's ``lang`` attribute, right with probability 0.9;
- suffix and host: priors from a first decision by the other parts, smoothed
  hierarchically (host towards suffix towards all pages) by grouped counts.

Words are 64-bit hashes. Words that make up at least one part in ``HOT_WORDS``
of the labelled words, and hosts with at least one part in ``HOT_HOSTS`` of the
pages, are broadcast: there are at most that many. The others are joined by
shuffle, so a hot word or host never lands in one task.

Defined results: null html or url, or no known word, leaves the other parts to
decide; ties go to the first language by name; equal page_ids are separate
rows; without labelled documents the language is null; empty pages give no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lexisieve.session import broadcast_if_small, materialize

DECLARED = 0.9
WEIGHT = 5.0
HOT_WORDS = 262_144
HOT_HOSTS = 4_096


def _words(text: Column) -> Column:
    return F.regexp_extract_all(F.lower(text), F.lit(r"\p{L}+"), 0)


def _best(scores: DataFrame, total: Column) -> DataFrame:
    order = Window.partitionBy("row").orderBy(F.desc("_total"), "lang")
    return scores.withColumn("_total", F.round(total, 6)).withColumn("_r", F.row_number().over(order)).where("_r = 1")


def _two_ways(rows: DataFrame, table: DataFrame, weight: str, bound: float, key: str, how: str) -> DataFrame:
    """``rows`` joined to ``table`` on ``key``: broadcast where ``weight`` reaches
    ``bound``, by shuffle for the other keys."""
    hot = table.where(F.col(weight) >= bound).drop(weight)
    rest = table.where(F.col(weight) < bound).drop(weight)
    others = rows.join(F.broadcast(hot.select(key)), key, "left_anti")
    return rows.join(F.broadcast(hot), key).unionByName(others.join(rest, key, how))


def word_gains(docs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The labelled documents' words ``(w, gains, n)``, ``gains`` a list of
    (lang, log(1 + count)), and ``(lang, size)``: smoothed words of a language."""
    labelled = docs.select("lang", F.col("text").cast("string").alias("text")).where("lang is not null")
    counts = labelled.select("lang", F.explode(_words(F.col("text"))).alias("word")) \
        .select("lang", F.xxhash64("word").alias("w")).groupBy("lang", "w").agg(F.count(F.lit(1)).alias("n"))
    counts = materialize(counts, "language-words")
    # A language without words still takes part.
    sizes = counts.groupBy("lang").agg((F.sum("n") + F.count(F.lit(1)) + 1).alias("size"))
    sizes = labelled.select("lang").distinct().join(sizes, "lang", "left").select("lang", F.coalesce("size", F.lit(1)).alias("size"))
    words = counts.groupBy("w").agg(F.collect_list(F.struct("lang", F.log1p("n").alias("gain"))).alias("gains"),
                                    F.sum("n").alias("n"))
    return materialize(words, "language-gains"), materialize(sizes, "languages")


def identify(pages: DataFrame, docs: DataFrame) -> DataFrame:
    """(page_id, lang, declared, score) of every page; ``score`` is the log posterior part sum."""
    words, sizes = word_gains(docs)
    total = words.agg(F.sum("n")).first()[0] or 0
    langs = sorted((r["lang"], r["size"]) for r in sizes.collect())  # one row per language
    html = F.coalesce(F.col("html").cast("string"), F.lit(""))
    plain = F.regexp_replace(html, r"(?is)<script.*?</script>|<style.*?</style>|<[^>]*>|&\w+;", " ")
    host = F.lower(F.regexp_extract(F.coalesce(F.col("url").cast("string"), F.lit("")), r"^[a-zA-Z]+://([^/:?#]+)", 1))
    rows = materialize(pages.select(
        F.monotonically_increasing_id().alias("row"), "page_id", host.alias("host"),
        F.lower(F.regexp_extract(html, r"(?i)<html[^>]*\blang=[\"']?([a-z]{2})", 1)).alias("declared"),
        _words(plain).alias("words")), "page-words").withColumn("suffix", F.regexp_extract("host", r"([^.]*)$", 1))
    if not langs:
        return rows.select("page_id", F.lit(None).cast("string").alias("lang"), "declared", F.lit(0.0).alias("score"))

    found = _two_ways(rows.select("row", F.explode("words").alias("word")).select("row", F.xxhash64("word").alias("w")),
                      words, "n", max(1.0, total / HOT_WORDS), "w", "inner")
    text = found.select("row", F.explode("gains").alias("g")).groupBy("row", "g.lang").agg(F.sum("g.gain").alias("gain"))

    options = F.explode(F.array(*[F.struct(F.lit(x).alias("lang"), F.lit(n).alias("size")) for x, n in langs]))
    every = rows.select("row", "page_id", "host", "suffix", "declared", F.size("words").alias("len"), options.alias("o")) \
        .select("*", "o.lang", "o.size").drop("o")
    other = F.log(F.lit((1 - DECLARED) / max(1, len(langs) - 1)))
    said = F.when(F.col("declared") == "", 0.0).when(F.col("declared") == F.col("lang"), F.log(F.lit(DECLARED))).otherwise(other)
    scores = materialize(every.join(text, ["row", "lang"], "left").select(
        "row", "page_id", "host", "suffix", "declared", "lang",
        (F.coalesce("gain", F.lit(0.0)) - F.col("len") * F.log("size") + said).alias("own")), "language-scores")

    first = _best(scores, F.col("own")).groupBy("host", "suffix", "lang").agg(F.count(F.lit(1)).alias("nh"))
    first = materialize(first, "first-decisions")  # one row per host and language
    by_all = first.groupBy("lang").agg(F.sum("nh").alias("na"))
    by_suffix = first.groupBy("suffix", "lang").agg(F.sum("nh").alias("ns"))
    by_host = first.groupBy("host").agg(F.map_from_entries(F.collect_list(F.struct("lang", "nh"))).alias("hosts"),
                                        F.sum("nh").alias("pages"))
    n = first.agg(F.sum("nh")).first()[0] or 0
    full = _two_ways(scores, by_host, "pages", max(1.0, n / HOT_HOSTS), "host", "left") \
        .withColumn("nh", F.col("hosts")[F.col("lang")]) \
        .join(broadcast_if_small(by_suffix), ["suffix", "lang"], "left").join(F.broadcast(by_all), "lang", "left")

    def c(x):
        return F.coalesce(x, F.lit(0))
    base = (c("na") + 1) / F.lit(float(n + len(langs)))
    prior = c("nh") + WEIGHT * (c("ns") + WEIGHT * base)
    return _best(full, F.col("own") + F.log(prior)).select("page_id", "lang", "declared", F.col("_total").alias("score"))
