"""Language identification against a plain version, and its held-out accuracy."""

import math
from collections import Counter

import regex

from lexisieve.llm import language_fusion as L

PAGES = ("page_id long, url string, html string, lang string, w string, row long")


def _plain(pages, docs):
    counts = {}
    for lang, text in docs:
        if lang is not None:
            counts.setdefault(lang, Counter()).update(regex.findall(r"\p{L}+", (text or "").lower()))
    sizes = {k: sum(c.values()) + len(c) + 1 for k, c in counts.items()}
    rows = []
    for pid, url, html in pages:
        plain = regex.sub(r"(?is)<script.*?</script>|<style.*?</style>|<[^>]*>|&\w+;", " ", html or "")
        m = regex.search(r"(?i)<html[^>]*\blang=[\"']?([a-z]{2})", html or "")
        declared = m[1].lower() if m else ""
        h = regex.match(r"[a-zA-Z]+://([^/:?#]+)", url or "")
        host = h[1].lower() if h else ""
        words = regex.findall(r"\p{L}+", plain.lower())
        own = {}
        for lang in counts:
            s = sum(math.log1p(counts[lang][w]) - math.log(sizes[lang]) for w in words)
            if declared:
                s += math.log(0.9 if declared == lang else 0.1 / max(1, len(counts) - 1))
            own[lang] = s
        rows.append((pid, declared, host, host.rsplit(".", 1)[-1], own))

    def best(scores):
        return min(scores, key=lambda k: (-round(scores[k], 6), k))
    first = [(host, suffix, best(own)) for _, _, host, suffix, own in rows]
    na, ns, nh = (Counter(x[2] for x in first), Counter(x[1:] for x in first), Counter((x[0], x[2]) for x in first))
    out = []
    for pid, declared, host, suffix, own in rows:
        post = {k: s + math.log(nh[host, k] + L.WEIGHT * (ns[suffix, k] + L.WEIGHT * (na[k] + 1) / (len(rows) + len(counts))))
                for k, s in own.items()}
        k = best(post)
        out.append((pid, k, declared, round(post[k], 4)))
    return sorted(out, key=str)


DOCS = [("en", "the house and the garden, the cat"), ("de", "das Haus und der Garten, die Katze"), ("fr", "la maison et le jardin"),
        ("fr", None), (None, "unlabelled words"), ("xx", "")]
CASES = [(1, "http://a.de/x", "<html lang='de'>das Haus</html>"), (2, "http://a.de/y", "qq"), (3, "http://a.de/z", None),
         (4, None, "the cat <script>das das das</script>"), (5, None, None), (5, "no url", "la maison &amp; le jardin"),
         (None, "https://b.fr:80/", "<HTML LANG=EN>la maison</HTML>"), (7, "https://b.fr/", ""), (8, "https://c.fr", "the " * 50_000)]
CASES += [(100 + i, "http://hot.com/%d" % i, "the garden") for i in range(40)]


def test_matches_plain_version(spark, monkeypatch):
    pages = spark.createDataFrame([(*c, "zz", "clash", 0) for c in CASES], PAGES)
    docs = spark.createDataFrame(DOCS, "lang string, text string").selectExpr("*", "1 as w", "2 as row", "3 as host")
    want = _plain(CASES, DOCS)
    for words, hosts in ((L.HOT_WORDS, L.HOT_HOSTS), (4, 2)):  # nearly all broadcast; most joined by shuffle
        monkeypatch.setattr(L, "HOT_WORDS", words)
        monkeypatch.setattr(L, "HOT_HOSTS", hosts)
        got = sorted(((*r[:3], round(r[3], 4)) for r in L.identify(pages, docs).collect()), key=str)
        assert got == want


def test_empty_tables(spark):
    pages = spark.createDataFrame([(*c, "zz", "clash", 0) for c in CASES], PAGES)
    docs = spark.createDataFrame(DOCS, "lang string, text string")
    out = L.identify(pages, docs.limit(0))
    assert out.count() == len(CASES) and out.where("lang is not null").count() == 0
    assert L.identify(pages.limit(0), docs).count() == 0


def test_held_out_accuracy(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").where("lang is not null")
    held = docs.where("doc_id % 5 = 1")
    pages = held.selectExpr("doc_id as page_id", "cast(null as string) as url", "text as html")
    out = L.identify(pages, docs.where("doc_id % 5 != 1")).withColumnRenamed("lang", "guess")
    joined = out.join(held, out.page_id == held.doc_id).selectExpr("avg(cast(guess = lang as int)) a").first()["a"]
    print("held-out accuracy", joined)
    assert joined > 0.9
