"""The training-data operators against plain versions on small fixtures with
nulls, empty and long texts, repeated rows, an empty table and extra columns."""

import hashlib
import io
import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from lexisieve.llm import words as W

SCHEMA = "doc_id long, text string, lang string, n int, key string, u long"
LONG = "alpha beta gamma " * 3000
BASE = " ".join(f"w{i}" for i in range(60))
ROWS = [(1, BASE), (2, BASE + " x"), (3, BASE), (3, BASE), (4, None), (5, ""), (6, " \n\t "), (7, LONG), (8, "One two"),
        (9, "one  TWO\n"), (None, BASE), (10, "Émile a@b.cd 1.2.3.4 +49 30 1234567 x 4111 1111 1111 1111 ß")]


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame([(i, t, "en", 1, "k", 2) for i, t in ROWS], SCHEMA)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def _lower(t):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t or "")


def test_words_match_the_patterns():
    rng = random.Random(1)
    alphabet = "aZé中😀09 .\t\n\x0b-_\x00\x7f"
    texts = [None, "", "x" * 5000] + ["".join(rng.choice(alphabet) for _ in range(rng.randint(0, 40))) for _ in range(300)]
    for kind, pattern in (("space", r"[^\x20\x09-\x0D]+"), ("alnum", r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")):
        for text, h in zip(texts, W.row_words(pa.array(texts), kind)):
            assert h.tolist() == W.hash_words(re.findall(pattern, _lower(text))).tolist()


def test_token_blocks(spark, docs, empty, tmp_path):
    public_tokenizers = pytest.importorskip("public_tokenizers")
    from tokenizers import Tokenizer

    from lexisieve.llm import token_blocks as T
    rng = np.random.default_rng(1)
    for ids in (np.zeros(1, np.uint32), rng.integers(0, 1 << 32, 777, dtype=np.uint32), np.append(
            rng.integers(5, 9, 2000, dtype=np.uint32), np.uint32(2**32 - 1)), np.full(65535, 7, np.uint32)):
        assert (T.unpack_block(T.pack_block(ids)) == ids).all()
    spec = T.tokenizer_spec(public_tokenizers.path("word_bpe_49k.json"))
    got = [tuple(r) for r in T.read_token_shards(T.write_token_shards(docs, spec, str(tmp_path / "a"))).collect()]
    t = Tokenizer.from_str(spec)
    t.encode_special_tokens = True
    want = Counter((i, (*t.encode(x or "", add_special_tokens=False).ids, 1)) for i, x in ROWS)
    assert Counter((i, tuple(np.frombuffer(b, np.uint32).tolist())) for i, _, _, b in got) == want
    at = 0
    for i, start, n, _ in sorted(got, key=lambda r: r[1]):
        assert start == at
        at += n
    assert [r[0] for r in sorted(got, key=lambda r: r[1])] == sorted((i for i, _ in ROWS), key=lambda i: (i is not None, i))
    assert T.read_token_shards(T.write_token_shards(empty, spec, str(tmp_path / "b"))).count() == 0


def test_license_scan(spark, empty):
    from lexisieve.llm import license_scan as L
    texts = {1: "Licensed under the Apache License, Version 2.0. All rights reserved", 2: "gnu affero general public license",
             3: None, 4: "CC BY 4.0, cc by!", 5: "mit freundlichen", 6: "MIT License"}
    df = spark.createDataFrame([(k, v, 1) for k, v in texts.items()], "doc_id long, text string, labels int")
    got = {r["doc_id"]: r for r in L.scan(df).collect()}
    assert got[1]["labels"] == ["apache-2.0", "reserved"] and [b["word"] for b in got[1]["base"]] == [8]
    assert got[2]["labels"] == ["agpl", "gpl"] and [f["label"] for f in got[2]["found"]] == ["agpl"]
    assert got[3]["n_words"] == 0 and got[3]["score"] == 0 and not got[5]["labels"]
    assert sorted(b["word"] for b in got[4]["base"]) == [0, 4] and got[4]["labels"] == ["cc-by", "cc-by-4.0"]
    assert got[6]["labels"] == ["mit"] and all(0 <= r["score"] <= 1 for r in got.values())
    assert L.scan(empty).count() == 0


def _phrases(tree):
    """Texts that match a parsed pattern: every branch, each repeat at its least and once more."""
    out = [""]
    for op, x in tree:
        op = str(op)
        if op == "LITERAL":
            more = [chr(x)]
        elif op == "IN":
            more = [chr(v) if str(k) == "LITERAL" else chr(v[0]) if str(k) == "RANGE" else "z" for k, v in x]
        elif op == "SUBPATTERN":
            more = _phrases(x[-1])
        elif op == "BRANCH":
            more = [p for branch in x[1] for p in _phrases(branch)]
        else:
            assert op == "MAX_REPEAT", op
            least, most, part = x
            more = [p * n for n in {least, min(int(most), least + 1)} for p in _phrases(part)]
        out = [a + b for a in out for b in more]
    return out


def test_license_gate_loses_no_match(spark):
    from lexisieve.llm import license_scan as L
    from lexisieve.llm.license_rules import RULES
    texts = set()
    for line in RULES.strip().splitlines():
        pattern = line.split(";", 3)[3].strip().replace(",?", "")
        texts |= {" ".join(p.split()) for p in _phrases(re._parser.parse(pattern))}
    texts = sorted(texts)
    want = {i: [(d.first, d.end - 1, d.label, d.priority) for d in L.detect(t.split(), list(range(len(L.rules()))))]
            for i, t in enumerate(texts)}
    assert all(want.values())
    got = {r["doc_id"]: [tuple(f) for f in r["found"]] for r in L.scan(
        spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).collect()}
    assert {texts[i]: (got[i], want[i]) for i in want if got[i] != want[i]} == {}


def test_personal_data(spark, docs, empty):
    from pyspark.sql import functions as F

    from lexisieve.llm import pii_bootstrap as P
    found = P.find_pii(docs)
    got = {r[0]: r[1] for r in found.select("doc_id", P.spans_text(F.col("spans"))).collect()}
    assert got[10] == "email:6:12,ip:13:20,card:38:57,phone:21:35" and got[4] == got[5] == got[7] == ""
    assert found.count() == len(ROWS)
    masked = {r["doc_id"]: r for r in P.mask(docs, found).collect()}
    assert masked[10]["text"] == "Émile [email] [ip] [phone] x [card] ß" and masked[4]["text"] is None
    assert P.find_pii(empty).count() == 0


def test_bootstrap_discovers_unseen_identifiers(spark):
    from lexisieve.llm import pii_bootstrap as P
    rows = [(i, f"please write to user{i}x@mail.example now") for i in range(8)] + \
        [(100, "please write to agent77-desk now"), (101, "plain prose write nothing agent99-desk")]
    got = {r["doc_id"]: [s["kind"] for s in r["spans"]] for r in P.find_pii(
        spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got[0] == ["email"] and got[100] == ["ident"] and got[101] == []


def test_archives(spark):
    from lexisieve.llm import warc_convert as A
    pages = [(1, "http://a/ b", "x"), (2, None, "x"), (3, "http://c", None), (4, "http://d", ""), (None, "e", "x"), (5, "f", "HTTP/é\r\n\r\n")]
    df = spark.createDataFrame([(*p, "u") for p in pages], "page_id long, url string, html string, content string")
    got = {r["page_id"]: r for r in A.read_warc(A.convert(A.arc_archives(df))).collect()}
    import base64
    for i, _, html in pages:
        data = (html or "").encode()
        assert got[i]["payload_bytes"] == len(data)
        assert got[i]["payload_digest"] == base64.b32encode(hashlib.sha1(data).digest()).decode()
    kinds = {i: (r["record_type"], r["refers_to"]) for i, r in got.items()}
    assert kinds == {1: ("revisit", 2), 2: ("response", None), 3: ("revisit", 4), 4: ("response", None),
                     None: ("revisit", 2), 5: ("response", None)}
    assert A.read_warc(A.convert(A.arc_archives(df.limit(0)))).count() == 0
    records = [A.ArcRecord("http://a", "1.2.3.4", "19990102030405", "text/html", b"HTTP/1.0 200 OK\r\n\r\nhi"),
               A.ArcRecord("dns:a", "1.2.3.4", "1999", "text/dns", b"a\nb\n")]
    for version in (1, 2):
        assert list(A.parse_arc(io.BytesIO(A.write_arc(records, version)))) == records
    with pytest.raises(ValueError):
        list(A.parse_arc(io.BytesIO(A.write_arc(records, 1)[:-6])))


def _components(rows):
    sets = {}
    for i, t in rows:
        w = re.findall(r"[^\x20\x09-\x0D]+", _lower(t))
        s = {tuple(w[k:k + 5]) for k in range(max(1, len(w) - 4))} if w else set()
        sets.setdefault(i, []).append(s)
    label = {i: i for i in sets if i is not None}
    while True:
        before = dict(label)
        for a in label:
            for b in label:
                if any(x and y and 100 * len(x & y) >= 75 * len(x | y) for x in sets[a] for y in sets[b]):
                    label[a] = label[b] = min(label[a], label[b])
        if label == before:
            return label, sets


def test_near_duplicates(spark, docs, empty, monkeypatch):
    from lexisieve.llm import ngram_join as J
    monkeypatch.setattr(J, "FREQUENT", 3)  # many tokens are frequent: combinations are used
    rng = random.Random(5)
    shared = [f"s{i}" for i in range(30)]
    rows = list(ROWS)
    for i in range(20, 70):
        w = shared[:] if rng.random() < 0.6 else [f"v{rng.randint(0, 60)}" for _ in range(40)]
        for _ in range(rng.randint(0, 6)):
            w[rng.randrange(len(w))] = f"z{rng.randint(0, 9)}"
        rows.append((i, " ".join(w)))
    got = J.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    label, sets = _components(rows)
    assert len(got) == len(rows)
    for r in got:
        assert r["component_id"] == label.get(r["doc_id"]) and r["n_shingles"] in {len(s) for s in sets[r["doc_id"]]}
    assert J.near_duplicates(empty).count() == 0


def test_decontamination(spark, docs, empty):
    from lexisieve.llm import decontaminate as D
    items = [(1, " ".join(f"w{i}" for i in range(10, 30))), (2, "two"), (3, None), (None, "alpha beta"), (4, "..."), (1, "one two")]
    bench = spark.createDataFrame(items, "item_id long, text string")
    rows = {}
    for slice_bytes in (D.SLICE_BYTES, 40):
        out = D.contamination(docs, bench, slice_bytes=slice_bytes).collect()
        rows[slice_bytes] = sorted((str(r["doc_id"]), r["n_words"], tuple(sorted(r["hits"])), tuple(r["items"]), r["contaminated"]) for r in out)
    assert rows[40] == rows[D.SLICE_BYTES] and len(rows[40]) == len(ROWS)
    got = {r[0]: r for r in rows[40]}
    assert got["1"][2] == tuple(range(10, 30)) and got["1"][3] == ("1",) and got["1"][4]
    assert got["8"][2:] == ((0, 1), ("1", "2"), True) and got["4"][1:] == (0, (), (), False)
    assert not any(r["hits"] for r in D.contamination(docs, bench.limit(0)).collect())
    assert D.contamination(empty, bench).count() == 0
    index = D.build_index(docs)
    near = D.proximity_hits(index, [("q", W.hash_words(["w3", "w5"]))], 3).where("doc_id = 1").collect()
    assert [(r["doc_id"], r["at"]) for r in near] == [(1, 3)]


def test_byte_bpe(spark, docs, empty):
    public_tokenizers = pytest.importorskip("public_tokenizers")
    import tiktoken

    from lexisieve.llm import byte_bpe as B
    raw = B.load_ranks(spark, public_tokenizers.path("byte_bpe_multi_50k.tiktoken"))
    reference = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=B.read_ranks(raw), special_tokens={})
    codec = B.Codec(B.read_ranks(raw), public_tokenizers.PATTERN)
    rng = random.Random(3)
    for _ in range(3000):
        s = "".join(rng.choice(" \n\tab'sté1中😀\xa0.,-\rthing") for _ in range(rng.randint(0, 25)))
        assert codec.encode(s).tolist() == reference.encode_ordinary(s) and codec.decode(codec.encode(s)) == s.encode()
    out = B.encode(docs, raw, public_tokenizers.PATTERN, decode=True)
    assert Counter((r["doc_id"], tuple(r["ids"]), bytes(r["decoded"])) for r in out.collect()) == Counter(
        (i, tuple(reference.encode_ordinary(t or "")), (t or "").encode()) for i, t in ROWS)
    assert Counter(tuple(r) for r in B.decode(out, raw, public_tokenizers.PATTERN).collect()) == Counter((i, t or "") for i, t in ROWS)
    assert B.encode(empty, raw, public_tokenizers.PATTERN).count() == 0
    data = "aé中😀".encode() + b"\xff" + "é".encode()[:1]
    stream = B.Utf8Stream()
    assert "".join(stream.feed(data[i:i + 1]) for i in range(len(data))) + stream.close() == data.decode(errors="replace")


def test_backoff_scores(spark, docs, empty, monkeypatch):
    from lexisieve.llm import backoff_lm as L
    monkeypatch.setattr(L, "MAX_WORDS", 8)  # most words go through the join
    held = {i: i is not None and zlib.crc32(str(i).encode()) % 5 == 1 for i, _ in ROWS}
    tokens = [(i, re.findall(r"[^\x20\x09-\x0D]+", _lower(t)) + [None]) for i, t in ROWS]
    counts = Counter(w for i, x in tokens if i is not None and not held[i] for w in x)
    total, distinct = sum(counts.values()), len(counts)
    want = Counter((i, held[i], len(x), sum(counts[w] > 0 for w in x), total, round(sum(
        math.log10((counts[w] + .5) / (total + .5 * (distinct + 1))) for w in x), 4)) for i, x in tokens)
    out = L.score(docs).collect()
    assert Counter((r[0], r[1], r[2], r[3], r[4], round(r[5], 4)) for r in out) == want
    assert all(r["score"] < 0 for r in out) and L.score(empty).count() == 0


@pytest.mark.parametrize("words, arcs", [(1 << 20, 1 << 21), (8, 4), (1 << 20, 4), (8, 1 << 21), (0, 0)])
def test_every_state_and_arc_counts(spark, monkeypatch, words, arcs):
    from lexisieve.llm import backoff_lm as L
    monkeypatch.setattr(L, "MAX_WORDS", words)
    monkeypatch.setattr(L, "MAX_ARCS", arcs)
    rng = random.Random(5)
    texts = [(i, " ".join(f"w{min(int(rng.expovariate(.08)), 60)}" for _ in range(rng.randrange(40)))) for i in range(60)]
    texts += [(None, "w1 w2 new w3"), (7, None)]
    tokens = [(i, [None, *(t or "").split(), None]) for i, t in texts]
    learnt = [x for i, x in tokens if i is not None and zlib.crc32(str(i).encode()) % 5 != 1]
    one = Counter(w for x in learnt for w in x[1:])
    two = {p: n for p, n in Counter(p for x in learnt for p in zip(x, x[1:])).items() if n >= L.MIN_ARC}
    seen = Counter()
    for (u, _), n in two.items():
        seen[u] += (n - L.DISCOUNT) / one[u]
    floor = sum(one.values()) + .5 * (len(one) + 1)

    def p(u, v):
        return ((two[u, v] - L.DISCOUNT) / one[u] if (u, v) in two else 0) + (1 - seen[u]) * (one[v] + .5) / floor
    want = Counter((i, round(sum(math.log10(p(u, v)) for u, v in zip(x, x[1:])), 4)) for i, x in tokens)
    got = L.score(spark.createDataFrame(texts, "doc_id long, text string")).collect()
    assert Counter((r["doc_id"], round(r["score"], 4)) for r in got) == want


def test_automaton_is_a_distribution():
    from lexisieve.llm.backoff_lm import Automaton
    words = np.sort(np.array([3, 5, 9], np.uint64))
    counts = np.array([4, 3, 2])
    arcs = np.array([(0 << 32) | 1, (0 << 32) | 2], np.uint64)
    model = Automaton(words, counts, words, counts, arcs, np.array([2, 2]), 9, 3)
    seen = sum(10 ** model.walk(np.array([3, w], np.uint64), np.zeros(2, int))[1][1] for w in (3, 5, 9))
    unseen = 10 ** (model.failure[0] + math.log10(0.5 / model.floor))
    assert abs(seen + unseen - 1) < 1e-9


def test_quality_rules(spark, docs, empty):
    from lexisieve.llm import quality_risk as Q
    labels = spark.createDataFrame([(1, 1), (None, 0), (2, None)], "doc_id long, quality int")
    got = Q.quality_rules(docs, labels).collect()
    assert len(got) == len(ROWS)
    by = {r["doc_id"]: r for r in got}
    assert by[4]["n_words"] == 0 and by[4]["base_failed"] and not by[4]["kept"]
    assert by[1]["kept"] and not by[7]["kept"] and by[7]["n_repeat_words"] == 9000
    assert Q.quality_rules(empty, labels).count() == 0
    rng = random.Random(2)
    for _ in range(200):
        text = "".join(rng.choice(["a", "b", " ", "\n", "#", "é", "|", "A"]) for _ in range(rng.randint(0, 60)))
        w = re.findall(r"[^\x20\x09-\x0D]+", text)
        seen = Counter(tuple(w[i:i + 3]) for i in range(len(w) - 2))
        hit = {i + k for i in range(len(w) - 2) if seen[tuple(w[i:i + 3])] > 1 for k in range(3)}
        lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
        batch = pa.RecordBatch.from_arrays([pa.array([1]), pa.array(["en"]), pa.array([0]), pa.array([text])],
                                           ["doc_id", "lang", "text_hash", "text"])
        r = next(Q._features(iter([batch]))).to_pylist()[0]
        assert [r[c] for c in Q.COUNTS] == [len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text)),
                                            len(lines) - len(set(lines)), len(hit)]


def test_risk_bound_holds():
    from lexisieve.llm.quality_risk import binomial_tail, choose_cutoff
    assert abs(binomial_tail(2, 10, 0.3) - sum(math.comb(10, k) * .3**k * .7**(10 - k) for k in range(3))) < 1e-12
    good, bad = [1000] * 101, [1000] * 101
    for c in range(1, 101):
        good[c], bad[c] = (0 if c > 40 else 500), (900 if c <= 60 else 0)
    assert choose_cutoff(good, bad, 0.01, 0.01, 20) == 50
    assert choose_cutoff([10] + [0] * 100, bad, 0.01, 0.01, 20) is None  # too few labels


def test_pipeline_stages(spark, docs, tmp_path):
    corpus_pipeline = pytest.importorskip("corpus_pipeline")
    spark.createDataFrame([(1, 1)], "doc_id long, quality int").write.parquet(str(tmp_path / "labels.parquet"))
    spark.createDataFrame([(1, "alpha beta gamma")], "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    d = str(tmp_path)
    kept = corpus_pipeline.quality(spark, docs, d)
    assert kept.columns == docs.columns and sorted(str(r["doc_id"]) for r in kept.collect()) == ["1", "2", "3", "3", "None"]
    assert sorted(str(r["doc_id"]) for r in corpus_pipeline.near_duplicate(spark, kept, d).collect()) == ["1", "None"]
    clean = corpus_pipeline.decontaminate(spark, docs, d)
    assert 7 not in {r["doc_id"] for r in clean.collect()} and clean.count() == len(ROWS) - 1
    assert corpus_pipeline.personal_data(spark, docs, d).columns == docs.columns


def test_repeated_ids_lose_no_clean_text(spark):
    corpus_pipeline = pytest.importorskip("corpus_pipeline")
    other, third = (" ".join(f"{c}{i}" for i in range(60)) for c in "xy")
    rows = [(1, BASE, "a"), (2, other, "a"), (2, BASE + " x", "a"), (2, third, "a"), (2, third, "a"), (3, third + " z", "a"),
            (4, None, "a"), (4, "", "a"), (None, BASE, "a")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    kept = corpus_pipeline.near_duplicate(spark, docs, "")
    assert kept.columns == docs.columns
    assert Counter(tuple(r) for r in kept.collect()) == Counter(
        [(1, BASE, "a"), (2, other, "a"), (2, third, "a"), (4, None, "a"), (4, "", "a"), (None, BASE, "a")])
