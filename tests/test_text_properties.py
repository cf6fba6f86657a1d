"""Text functions against plain Python models on random strings."""

from __future__ import annotations

import random
import re

from lexisieve.functions.text import alnum_count, lower_ascii, tokens
from lexisieve.plans.requests import parse_requests
from lexisieve.schemas import REQUESTS

ALPHABET = (list("abcXYZ019 _-.,\t\n\r\x0b\x0c") + ["é", "ß", "İ", "K", "ǅ", "ﬀ", "日", "😀", " ", "Ω"])
C_SPACE = " \t\n\x0b\x0c\r"
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def _rand(rng, n):
    return "".join(rng.choice(ALPHABET) for _ in range(n))


def test_tokens_lower_and_alnum_match_model(spark):
    rng = random.Random(5)
    texts = [_rand(rng, rng.randint(0, 40)) for _ in range(400)]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i bigint, t string")
    got = df.select("i", tokens("t").alias("w"), lower_ascii("t").alias("l"), alnum_count("t").alias("n")).collect()
    for r in got:
        t = texts[r["i"]]
        assert r["w"] == re.findall(r"[a-z0-9]+", t.translate(LOWER)), t
        assert r["l"] == t.translate(LOWER)
        assert r["n"] == len(re.findall(r"[A-Za-z0-9]", t))


def _model_request(line):
    """(cmd, words, error): a known command is kept even when it errs."""
    toks = [x for x in re.split("[" + re.escape(C_SPACE) + "]+", line) if x]
    cmd = toks[0] if toks else ""
    rest = [w.translate(LOWER) for w in toks[1:]]
    if cmd == "SEARCH_ONE":
        return (cmd, rest[:1], None if rest else "ERROR Missing word for SEARCH_ONE")
    if cmd in ("SEARCH_ALL", "SEARCH_ANY"):
        return (cmd, rest, None if rest else "ERROR No words provided")
    return (None, None, "ERROR Unknown command")


def test_parse_requests_matches_model(spark):
    rng = random.Random(9)
    cmds = ["SEARCH_ONE", "SEARCH_ALL", "SEARCH_ANY", "search_any", "FIND", ""]
    lines = []
    for _ in range(300):
        pre = rng.choice(["", " ", "\t ", "\n"])
        words = " ".join(_rand(rng, rng.randint(1, 6)) for _ in range(rng.randint(0, 4)))
        lines.append(pre + rng.choice(cmds) + rng.choice([" ", "\x0b", "\r\n", ""]) + words)
    df = spark.createDataFrame(list(enumerate(lines)), REQUESTS)
    got = {r["req_id"]: (r["cmd"], r["words"], r["error"]) for r in parse_requests(df).collect()}
    for i, line in enumerate(lines):
        cmd, words, err = got[i]
        m_cmd, m_words, m_err = _model_request(line)
        assert (cmd, words, err) == (m_cmd, m_words, m_err), repr(line)
