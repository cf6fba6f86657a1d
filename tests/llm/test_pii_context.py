"""Contexts of identifiers without cuts, base spans against plain expressions,
and masking beside clashing columns."""

import random
import re

from lexisieve.llm import pii_bootstrap as P


def _luhn(digits):
    total = 0
    for k, c in enumerate(reversed(digits)):
        d = int(c) * (1 + k % 2)
        total += d - 9 * (d > 9)
    return total % 10 == 0


def _base(text):
    out = []
    for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text):
        out.append(("email", *m.span()))
    for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text):
        if all(int(x) <= 255 for x in m[0].split(".")):
            out.append(("ip", *m.span()))
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", text):
        d = re.sub(r"[\x20-]", "", m[0])
        if 13 <= len(d) <= 19 and _luhn(d):
            out.append(("card", *m.span()))
    for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", text):
        if 9 <= len(re.sub("[^0-9]", "", m[0])) <= 15:
            out.append(("phone", *m.span()))
    return out


def test_base_spans_of_random_texts(spark):
    rng = random.Random(11)
    bits = ["a@b.cd", "x.y+z@q-r.s.t", "@", ".", "1.2.3.4", "300.1.1.1", "1.2.3", "4111 1111 1111 1111", "4111111111111112",
            "+49 30 1234567", "+1 (2", "-", " ", " ", "\n", "é", "中", "9", "00", "word", "a1b2c3", "+", "("]
    rows = [(i, "".join(rng.choice(bits) for _ in range(rng.randint(0, 25)))) for i in range(1500)] + [(1500, None), (1501, "")]
    found = P.find_pii(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    got = {r["doc_id"]: sorted((s["kind"], s["start"], s["end"]) for s in r["spans"] if s["rank"] < len(P.KINDS)) for r in found}
    assert got == {i: sorted(_base(t or "")) for i, t in rows}


def _idents(spark, texts):
    found = P.find_pii(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).collect()
    return {texts[r["doc_id"]][s["start"]:s["end"]] for r in found for s in r["spans"] if s["kind"] == P.IDENT}


def test_context_runs_over_earlier_matches(spark):
    seeds = [f"room4711 mail user{i}x@mail.example" for i in range(8)]
    assert _idents(spark, [*seeds, "room4711 mail agent77-desk"]) == {"agent77-desk"}
    seeds = [f"1a2b3c4d,5e6f7a8b {i} user{i}x@mail.example" for i in [5] * 4]
    assert _idents(spark, ["at the " + t.replace("user5x", f"user{k}x") for k, t in enumerate(seeds)]
                   + ["at the 1a2b3c4d,5e6f7a8b 5 agent77-desk"]) >= {"agent77-desk"}


def test_long_words_are_whole(spark):
    """Eight different words that share their last 64 letters are eight patterns."""
    texts = [chr(97 + i) * 26 + "z" * 64 + f" is user{i}x@mail.example" for i in range(8)]
    assert _idents(spark, [*texts, "q" * 26 + "z" * 64 + " is agent77-desk"]) == set()
    assert _idents(spark, [("z" * 90 + f" is user{i}x@mail.example") for i in range(8)] + ["z" * 90 + " is agent77-desk"]) \
        == {"agent77-desk"}


def test_mask_keeps_clashing_columns(spark):
    schema = "doc_id long, text string, _key string, _id string, _h int, _j string, _KEY_ int"
    docs = spark.createDataFrame([(1, "write a@b.cd now", "k", "i", 3, "j", 4), (2, "none", "k2", "i2", 5, "j2", 6)], schema)
    got = sorted(map(tuple, P.mask(docs, P.find_pii(docs)).collect()))
    assert got == [(1, "write [email] now", "k", "i", 3, "j", 4), (2, "none", "k2", "i2", 5, "j2", 6)]
