"""What a Python worker holds beside the JVM: the size of its batches, and what it gives back."""

from __future__ import annotations

from types import SimpleNamespace

import pyarrow as pa
import public_tokenizers
from pyspark.sql import functions as F

from lexisieve.llm import byte_bpe as B
from lexisieve.llm import tasks as T


def test_batches_of_long_texts_are_bounded(spark):
    def sizes(batches):
        for batch in batches:
            found = len(batch.column("text").buffers()[2])
            yield pa.RecordBatch.from_arrays([pa.array([batch.num_rows]), pa.array([found])], ["n", "size"])

    rows, length = 4000, 8000
    docs = spark.range(0, rows, 1, 1).select(F.repeat(F.lit("x"), length).alias("text"))
    got = T.map_arrow(docs, sizes, "n long, size long").collect()
    assert sum(r["n"] for r in got) == rows and sum(r["size"] for r in got) >= rows * length
    assert max(r["size"] for r in got) <= T.ARROW_BYTES + 2 * length


def test_a_task_gives_the_pool_back_at_its_end_and_if_cut_short(monkeypatch):
    calls = []
    pool = SimpleNamespace(release_unused=lambda: calls.append(1))
    monkeypatch.setattr(T, "pa", SimpleNamespace(default_memory_pool=lambda: pool))
    run = T.released(lambda batches: (b + 1 for b in batches))
    assert list(run(iter([1, 2]))) == [2, 3] and len(calls) == 1
    cut = run(iter([1, 2]))
    assert next(cut) == 2 and len(calls) == 1
    cut.close()
    assert len(calls) == 2


def test_the_cuts_of_a_column_are_gone_when_its_pieces_are_made(monkeypatch):
    with open(public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), "rb") as f:
        codec = B.Codec(B.read_ranks(f.read()), public_tokenizers.PATTERN)
    texts, held, plain = pa.array(["some words and some more\n \nof it " * 4000] * 4), [], codec._table
    before = pa.total_allocated_bytes()
    monkeypatch.setattr(codec, "_table", lambda names: held.append(pa.total_allocated_bytes() - before) or plain(names))
    codec.encode_column(texts)
    assert held[0] < texts.nbytes // 4
