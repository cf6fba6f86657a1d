"""Two states of a folder to a change log, with files that cannot be read."""

import os
import random

from lexisieve.operators.changes import apply_changes
from lexisieve.operators.index import doc_words
from lexisieve.sources import snapshots as S

FILE = "path string, content binary, modified timestamp"
MANIFEST = "path string, length long, modified timestamp, hash string"


def _ops(df):
    return {r["path"]: (r["op"], r["text"]) for r in df.collect()}


def _write(root, files):
    for name, data in files.items():
        os.makedirs(os.path.dirname(f"{root}/{name}"), exist_ok=True)
        with open(f"{root}/{name}", "wb") as f:
            f.write(data)


def test_a_folder_of_files(spark, tmp_path):
    root = str(tmp_path / "files")
    _write(root, {"a.txt": b"one", "b/b.txt": b"two", "c.txt": "café 中".encode(), "d.txt": b"", "skip.bin": b"x"})
    before = S.materialize(S.snapshot(S.folder_files(spark, root, "*.txt")), "manifest")
    assert before.count() == 4
    assert S.folder_changes(before, S.folder_files(spark, root, "*.txt")).count() == 0
    os.utime(f"{root}/a.txt", (1, 1))  # another time, the same contents
    os.remove(f"{root}/d.txt")
    _write(root, {"b/b.txt": b"two!", "e.txt": b"\xff\xfebad utf8"})
    log = S.folder_changes(before, S.folder_files(spark, root, "*.txt"), start=10)
    got = {os.path.basename(p): x for p, x in _ops(log).items()}
    assert got["b.txt"] == ("REINDEX", "two!") and got["d.txt"] == ("REMOVE", None) and got["e.txt"][0] == "ADD"
    assert len(got) == 3 and sorted(r["seq"] for r in log.collect()) == [10, 11, 12]


def test_a_file_that_vanishes_after_the_listing(spark, tmp_path):
    root = str(tmp_path / "files")
    _write(root, {"a.txt": b"one", "b.txt": b"two"})
    files = S.folder_files(spark, root)
    os.remove(f"{root}/b.txt")
    read = {os.path.basename(r["path"]): r["content"] for r in files.collect()}
    assert read == {"a.txt": bytearray(b"one"), "b.txt": None}
    before = spark.createDataFrame([], MANIFEST)
    log = S.folder_changes(before, files)
    assert {os.path.basename(p): x for p, x in _ops(log).items()} == {"a.txt": ("ADD", "one"), "b.txt": ("ADD", None)}
    assert {r["word"] for r in apply_changes(log).collect()} == {"one"}  # R14


def test_rescans_follow_any_change(spark, tmp_path):
    """Random states, scanned one after the other: the index of the log is
    that of the last state's files."""
    rng = random.Random(8)
    before, log, state, start = spark.createDataFrame([], MANIFEST), None, {}, 1
    for k in range(4):
        for name in rng.sample([f"f{i}" for i in range(12)], 6):
            state[name] = rng.choice([b"", b"a b", f"t{k} a".encode(), b"c"])
        for name in rng.sample(sorted(state), 2):
            del state[name]
        S.write_shards(spark.createDataFrame([(n, bytearray(t), None) for n, t in state.items()], FILE), str(tmp_path / f"s{k}"), 3)
        files = S.read_shards(spark, str(tmp_path / f"s{k}"))
        part = S.materialize(S.folder_changes(before, files, start), "log")
        log, start, before = part if log is None else log.unionByName(part), start + part.count(), S.snapshot(files)
        want = doc_words(files.selectExpr("path", "cast(content as string) text"))
        assert sorted(map(tuple, apply_changes(log).collect())) == sorted(map(tuple, want.select("path", "word").collect()))


def test_unreadable_now_and_before(spark):
    old = [("a", 1, None, "h"), ("b", 1, None, None), ("c", 1, None, "h")]
    new = [("a", 1, None, None), ("b", 1, None, "h"), ("c", 2, None, "h")]
    got = S.differences(spark.createDataFrame(old, MANIFEST), spark.createDataFrame(new, MANIFEST))
    assert dict(map(tuple, got.collect())) == {"a": "REINDEX", "b": "REINDEX", "c": "REINDEX"}
    empty = spark.createDataFrame([], MANIFEST)
    assert S.differences(empty, empty).count() == 0
