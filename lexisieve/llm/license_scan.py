"""License scan by ordered signature rules.

A text becomes its lower-case words ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+``.
Word hashes are looked up in the rules' keywords; texts without any end there.
For the others every rule of which a keyword occurs is matched against the words
joined by spaces. Detections carry word intervals; one that lies inside the
interval of a better detection (higher priority, then longer, then earlier
rule) is suppressed, so "gnu general public license" inside "gnu affero
general public license" is not reported. Three base phrases are found word by
word in every text; base labels always stay. The score is
1 - product(1 - priority / 100) over the surviving detections' labels (best
detection of each; a base label counts with its ``BASE_PRIORITY``).

Defined results: a null, empty or wordless text has no words, places or
labels, null first and last word, and score 0; rows are independent, so
repeated rows or ids stay; an empty table gives an empty result; other
columns are ignored.
"""

from __future__ import annotations

import functools
from bisect import bisect_right
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lexisieve.llm import words as W
from lexisieve.llm.license_rules import RULES
from lexisieve.llm.tasks import batch_rows, map_arrow

BASE = (("cc by", "cc-by"), ("general public license", "gpl"), ("all rights reserved", "reserved"))
BASE_PRIORITY = 40
_WORD = regex.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
_LOWER = {i: i + 32 for i in range(65, 91)}


class Rule(NamedTuple):
    label: str
    priority: int
    keywords: tuple[str, ...]
    pattern: regex.Pattern


class Detection(NamedTuple):
    first: int  # word interval, end exclusive
    end: int
    priority: int
    order: int
    label: str


@functools.cache
def rules(table: str = RULES) -> tuple[Rule, ...]:
    out = []
    for line in table.strip().splitlines():
        label, priority, keywords, pattern = (x.strip() for x in line.split(";", 3))
        out.append(Rule(label, int(priority), tuple(keywords.split("|")),
                        regex.compile(r"(?<![^ ])(?:" + pattern.replace(",?", "") + r")(?![^ ])")))
    return tuple(out)


@functools.cache
def _keywords(table: str = RULES) -> tuple[np.ndarray, tuple[tuple[int, ...], ...]]:
    """(sorted keyword hashes, the rules of each)."""
    by: dict[str, list[int]] = {}
    for i, r in enumerate(rules(table)):
        for keyword in r.keywords:
            by.setdefault(keyword, []).append(i)
    names = list(by)
    h = W.hash_words(names)
    order = np.argsort(h)
    return h[order], tuple(tuple(by[names[i]]) for i in order)


def detect(words: list[str], numbers: list[int], table: str = RULES) -> list[Detection]:
    """All matches of the given rules, contained ones suppressed."""
    text, starts, at = " ".join(words), [], 0
    for w in words:
        starts.append(at)
        at += len(w) + 1
    begin = np.array(starts)
    found = []
    for i in numbers:
        r = rules(table)[i]
        for m in r.pattern.finditer(text):
            a, b = np.searchsorted(begin, [m.start(), m.end() - 1], "right")
            found.append(Detection(int(a) - 1, int(b), r.priority, i, r.label))
    return suppress(found)


def suppress(found: list[Detection]) -> list[Detection]:
    """Detections not inside a better one, in text order. They are taken from
    best to worst; ``starts`` and ``ends``, both increasing, are the outermost
    intervals that already stand."""
    kept: list[Detection] = []
    starts: list[int] = []
    ends: list[int] = []
    for d in sorted(set(found), key=lambda d: (-d.priority, d.first - d.end, d.order, d.first)):
        i = bisect_right(starts, d.first)
        if i and ends[i - 1] >= d.end:
            continue
        kept.append(d)
        # Drop frontier intervals that lie inside the new one; starts and ends stay increasing.
        j = i
        while j < len(starts) and ends[j] <= d.end:
            j += 1
        if i and starts[i - 1] == d.first:
            i -= 1
        starts[i:j], ends[i:j] = [d.first], [d.end]
    return sorted(kept)


def _base_places(h: np.ndarray) -> list[tuple[np.ndarray, str]]:
    out = []
    for phrase, label in BASE:
        want = W.hash_words(phrase.split())
        n = len(want)
        if len(h) >= n:
            ok = h[:len(h) - n + 1] == want[0]
            if ok.any():
                for k in range(1, n):
                    ok &= h[k:len(h) - n + 1 + k] == want[k]
                at = np.flatnonzero(ok)
                if len(at):
                    out.append((at, label))
    return out


_SCAN = pa.schema([
    ("doc_id", pa.int64()), ("n_words", pa.int64()), ("base", pa.list_(pa.struct(
        [("word", pa.int64()), ("label", pa.string())]))),
    ("found", pa.list_(pa.struct([("first", pa.int64()), ("last", pa.int64()), ("label", pa.string()),
                                  ("priority", pa.int32())])))])


def _scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    keys, by_key = _keywords()
    for batch in batches:
        ids, texts = batch.column("doc_id").to_pylist(), batch.column("text")
        for a, b, h, first in W.word_runs(texts, "alnum"):
            at = np.minimum(np.searchsorted(keys, h), len(keys) - 1)
            hit = np.flatnonzero(keys[at] == h)
            cut = np.searchsorted(hit, first)
            out = []
            for i in range(b - a):
                n = int(first[i + 1] - first[i])
                base, found = [], []
                if cut[i + 1] > cut[i]:
                    base = [{"word": int(w), "label": x} for at_, x in _base_places(h[first[i]:first[i + 1]]) for w in at_]
                    numbers = sorted({r for k in np.unique(at[hit[cut[i]:cut[i + 1]]]) for r in by_key[k]})
                    words = _WORD.findall(texts[a + i].as_py().translate(_LOWER))
                    found = [{"first": d.first, "last": d.end - 1, "label": d.label, "priority": d.priority}
                             for d in detect(words, numbers)]
                out.append((ids[a + i], n, base, found))
            yield batch_rows(_SCAN, out)


def scan(docs: DataFrame) -> DataFrame:
    """(doc_id, n_words, base, found, labels, score) of every document:
    ``base`` the places of base phrases (word, label), ``found`` the surviving
    detections (first and last word, label, priority). Every
    base phrase has a keyword of the table among its words."""
    out = map_arrow(docs.select(F.col("doc_id").cast("long"), "text"), _scan,
                    "doc_id long, n_words long, base array<struct<word:long,label:string>>, "
                    "found array<struct<first:long,last:long,label:string,priority:int>>")
    labels = F.array_sort(F.array_distinct(F.concat(F.col("base.label"), F.col("found.label"))))
    best = F.transform(labels, lambda x: F.greatest(
        F.when(F.array_contains("base.label", x), F.lit(BASE_PRIORITY)).otherwise(F.lit(0)),
        F.coalesce(F.array_max(F.transform(F.filter("found", lambda d: d["label"] == x), lambda d: d["priority"])),
                   F.lit(0))))
    miss = F.aggregate(best, F.lit(1.0), lambda acc, p: acc * (1 - p / F.lit(100.0)))
    return out.withColumn("labels", labels).withColumn("score", 1 - miss)
