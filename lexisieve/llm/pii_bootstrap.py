"""Personal data by fixed kinds and bootstrapped contextual extraction, in
DataFrame functions only.

Fixed kinds (email, ip, card, phone) are regular expressions with a check on
each match. Their matches seed the bootstrap: an identifier-shaped string
(six characters or more, one a digit) is an instance, the two words before it
in the text, of any length, are its lexical pattern. Scores pass between patterns and instances over the
distinct (pattern, instance) edges:

    pattern  = sum of its instances' scores / (instances + 1)
    instance = 1 for a seed, else 1 - product over patterns (1 - pattern)

for ``ROUNDS`` rounds. A pattern that scores ``CONFIDENT`` or more on
``SUPPORT`` seeds or more is used: every instance behind it that does not
touch a span of a fixed kind becomes a span of kind "ident".

One pass over the texts writes the matches with the lengths between them;
positions come from running sums, so nothing but that pass sees a text, and
each expression is gated by a cheap test. The expressions are possessive and
start at the first character of a run only, which finds the same matches in
linear time. Edges are aggregated before every join; no group is collected
but one document's spans.

Defined results: null or empty text: no spans; rows sharing an id, or equal
rows, are separate; positions count code points, end exclusive; an empty
table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lexisieve.llm.names import free
from lexisieve.session import broadcast_if_small, materialize

KINDS = ("email", "ip", "card", "phone")
IDENT = "ident"
ROUNDS = 3
SUPPORT = 3
CONFIDENT = 0.5
PATTERNS = {
    "email": r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
    IDENT: r"(?<![A-Za-z0-9._@+-])(?=[A-Za-z._@+-]*+[0-9])[A-Za-z0-9._@+-]{6,}+",
}
GATES = {"email": r"@[A-Za-z0-9-]", "ip": r"[0-9]\.[0-9]", "card": r"[0-9][\x20-]?[0-9]", "phone": r"\+[0-9]",
         IDENT: r"[0-9]"}
#: The last two words and what follows them; it starts at the start of a word only, so it is linear.
_LAST_WORDS = r"(?<!\S)\S++\s++\S++\s*+$"


def _valid(kind: str, m: Column) -> Column:
    """The check of each fixed kind."""
    if kind == "ip":
        parts = F.transform(F.split(m, r"\."), lambda p: F.regexp_replace(p, "^0+", ""))
        return F.forall(parts, lambda p: (F.length(p) <= 3) & (F.coalesce(p.try_cast("int"), F.lit(0)) <= 255))
    if kind == "card":
        digits = F.regexp_replace(m, r"[\x20-]", "")
        return F.length(digits).between(13, 19) & F.call_function("luhn_check", digits)
    if kind == "phone":
        return F.length(F.regexp_replace(m, "[^0-9]", "")).between(9, 15)
    return F.lit(True)


def _matches(kind: str) -> Column:
    """array<struct<kind, gap, match, before>> of one kind: ``gap`` is the
    number of code points since the match before, ``before`` the last two words
    of all the text before the match, earlier matches included (the second may
    touch it), or what there is if that is less."""
    gaps = F.split("text", PATTERNS[kind], -1)
    found = F.regexp_extract_all("text", F.lit(PATTERNS[kind]), 0)
    both = F.filter(F.arrays_zip(gaps.alias("g"), found.alias("m")), lambda z: z["m"].isNotNull())
    item = "struct<kind:string,gap:int,match:string,before:string>"

    def step(acc, z):
        text = F.concat(acc["tail"], z["g"])
        last = F.regexp_extract(text, _LAST_WORDS, 0)
        before = F.when(last != "", last).otherwise(text)
        one = F.struct(F.lit(kind).alias("kind"), F.length(z["g"]).alias("gap"), z["m"].alias("match"), before.alias("before"))
        return F.struct(F.concat(acc["out"], F.array(one)).cast(f"array<{item}>").alias("out"),
                        F.concat(before, z["m"]).alias("tail"))
    start = F.struct(F.array().cast(f"array<{item}>").alias("out"), F.lit("").alias("tail"))
    return F.when(F.col("text").rlike(GATES[kind]), F.aggregate(both, start, step, lambda acc: acc["out"]))


def _found(docs: DataFrame) -> DataFrame:
    """(row, doc_id, text_hash, all matches) of every row, written once."""
    kinds = [*KINDS, IDENT]
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    rows = rows.select("doc_id", F.xxhash64("text").alias("text_hash"), *[_matches(k).alias(k) for k in kinds])
    rows = rows.withColumn("row", F.monotonically_increasing_id())
    return materialize(rows, "pii-matches")


def _mentions(found: DataFrame, kind: str) -> DataFrame:
    """(row, kind, start, end, match, before, pos) of one kind's matches."""
    one = found.where(F.size(kind) > 0).select("row", F.posexplode(kind).alias("pos", "z")) \
        .select("row", "pos", "z.*")
    upto = Window.partitionBy("row").orderBy("pos").rowsBetween(Window.unboundedPreceding, 0)
    length = F.length("match")
    one = one.withColumn("end", F.sum(F.col("gap") + length).over(upto)).withColumn("start", F.col("end") - length)
    return one.select("row", "kind", "start", "end", "match", "before")


def _pattern(before: Column) -> Column:
    """The last two words before an instance, lower-case; null if fewer."""
    words = F.regexp_extract(before, r"(\S+\s+\S+)\s*$", 1)
    return F.when(words != "", F.lower(F.regexp_replace(words, r"\s+", " ")))


def _confident(mentions: DataFrame, rounds: int, support: int, confident: float) -> DataFrame:
    """(pattern): those that the bootstrap trusts."""
    edges = mentions.where(F.col("pattern").isNotNull()).groupBy("pattern", "value") \
        .agg(F.max(F.col("seed").cast("int")).alias("seed"))
    edges = materialize(edges, "pii-edges")
    seeds = edges.groupBy("value").agg(F.max("seed").cast("double").alias("score"), F.max("seed").alias("seed"))
    scores = seeds
    patterns = None
    for i in range(rounds):
        joined = edges.select("pattern", "value").join(scores, "value")
        patterns = joined.groupBy("pattern").agg(
            (F.sum("score") / (F.count(F.lit(1)) + 1)).alias("p"), F.sum("seed").alias("seeds"))
        if i + 1 < rounds:
            patterns = materialize(patterns, "pii-patterns")
            # log1p keeps the product of (1 - p) a sum; p is below 1 by its denominator.
            miss = edges.select("pattern", "value").join(patterns, "pattern").groupBy("value") \
                .agg(F.sum(F.log1p(-F.col("p"))).alias("miss"))
            scores = materialize(seeds.select("value", "seed").join(miss, "value").select(
                "value", "seed", F.when(F.col("seed") == 1, F.lit(1.0)).otherwise(1 - F.exp("miss")).alias("score")),
                "pii-instances")
    return patterns.where((F.col("p") >= confident) & (F.col("seeds") >= support)).select("pattern")


def find_pii(docs: DataFrame, rounds: int = ROUNDS, support: int = SUPPORT, confident: float = CONFIDENT) -> DataFrame:
    """(doc_id, text_hash, spans) of every row; ``spans`` is an array of
    (rank, start, end, kind) in order of kind, then start."""
    found = _found(docs)
    base = None
    for rank, kind in enumerate(KINDS):
        one = _mentions(found, kind).where(_valid(kind, F.col("match"))).withColumn("rank", F.lit(rank))
        base = one if base is None else base.unionByName(one)
    base = materialize(base, "pii-base")
    ident = _mentions(found, IDENT).withColumn("rank", F.lit(len(KINDS)))

    # Base spans that touch an identifier, by running bounds over each row's spans.
    both = base.unionByName(ident)
    is_base = F.col("rank") < len(KINDS)
    order = Window.partitionBy("row").orderBy("start", "rank")
    before = F.max(F.when(is_base, F.col("end"))).over(order.rowsBetween(Window.unboundedPreceding, -1))
    after = F.min(F.when(is_base, F.col("start"))).over(order.rowsBetween(1, Window.unboundedFollowing))
    touched = F.coalesce(before > F.col("start"), F.lit(False)) | F.coalesce(after < F.col("end"), F.lit(False))
    both = both.withColumn("touched", touched)
    mentions = materialize(both.select(
        "row", "rank", "kind", "start", "end", "touched", F.lower("match").alias("value"),
        _pattern(F.col("before")).alias("pattern"), is_base.alias("seed")), "pii-mentions")
    graph = mentions.where(F.col("seed") | ~F.col("touched"))
    trusted = _confident(graph, rounds, support, confident)
    fresh = mentions.where(~F.col("seed") & ~F.col("touched")).join(broadcast_if_small(trusted), "pattern", "left_semi")
    spans = mentions.where("seed").select("row", "rank", "start", "end", "kind") \
        .unionByName(fresh.select("row", "rank", "start", "end", "kind"))
    grouped = spans.groupBy("row").agg(F.array_sort(F.collect_list(F.struct(
        "rank", F.col("start").cast("long").alias("start"), F.col("end").cast("long").alias("end"), "kind"))).alias("spans"))
    empty = F.array().cast("array<struct<rank:int,start:bigint,end:bigint,kind:string>>")
    return found.select("row", "doc_id", "text_hash").join(grouped, "row", "left") \
        .select("doc_id", "text_hash", F.coalesce("spans", empty).alias("spans"))


def spans_text(spans: Column) -> Column:
    """kind:start:end, comma-joined."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(
        ":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def mask(docs: DataFrame, found: DataFrame, lengths: str | None = None) -> DataFrame:
    """``docs`` with every span replaced by its kind in brackets (overlapping
    spans as one, named after the first). Texts without spans pass unchanged; ``lengths`` names a
    column to set to a masked text's length, if there is one."""
    key, id_, hash_, json = free(docs, "_key", "_id", "_h", "_j")
    hits = found.where(F.size("spans") > 0).select(
        F.col("doc_id").alias(id_), F.col("text_hash").alias(hash_), "spans").dropDuplicates([id_, hash_])
    rows = docs.withColumn(key, F.xxhash64(F.col("text").cast("string")))
    rows = rows.join(broadcast_if_small(hits.select(id_, hash_, F.to_json("spans").alias(json))),
                     F.col("doc_id").cast("long").eqNullSafe(F.col(id_)) & (F.col(key) == F.col(hash_)), "left")
    spans = F.array_sort(F.transform(F.from_json(json, "array<struct<rank:int,start:bigint,end:bigint,kind:string>>"),
                                     lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end"), s["kind"].alias("kind"))))
    zero = F.struct(F.lit("").alias("out"), F.lit(0).cast("long").alias("at"))

    def step(acc, s):
        piece = F.concat(acc["out"], F.substring(F.col("text"), acc["at"].cast("int") + 1,
                                                 F.greatest(s["start"] - acc["at"], F.lit(0)).cast("int")),
                         F.when(s["start"] >= acc["at"], F.concat(F.lit("["), s["kind"], F.lit("]"))).otherwise(F.lit("")))
        return F.struct(piece.alias("out"), F.greatest(s["end"], acc["at"]).alias("at"))
    masked = F.aggregate(spans, zero, step, lambda acc: F.concat(
        acc["out"], F.substring(F.col("text"), acc["at"].cast("int") + 1, F.length("text"))))
    rows = rows.withColumn("text", F.when(F.col(json).isNull(), F.col("text")).otherwise(masked))
    if lengths in docs.columns:
        kind = docs.schema[lengths].dataType
        rows = rows.withColumn(lengths, F.when(F.col(json).isNull(), F.col(lengths)).otherwise(F.length("text").cast(kind)))
    return rows.select(*docs.columns)
