"""The stored dictionary against a plain model, over many calls and restarts."""

import random

import pytest

from lexisieve.operators.stored_dictionary import StoredDictionary


class _Plain:
    def __init__(self):
        self.ids, self.counter = {}, 0

    def intern(self, values):
        for v in values:
            if v is not None and v not in self.ids:
                self.counter += 1
                self.ids[v] = self.counter

    def remove(self, values):
        for v in values:
            self.ids.pop(v, None)

    def clear(self):
        self.__init__()


def _values(spark, values):
    return spark.createDataFrame([(i, v, 0) for i, v in enumerate(values)], "seq long, value string, id int")


def _entries(store):
    return sorted((r["id"], r["value"]) for r in store.table().collect())


@pytest.mark.parametrize("compact_every", [2, 50])
def test_random_calls(spark, scratch, compact_every):
    rng = random.Random(compact_every)
    plain = _Plain()
    for k in range(9):
        store = StoredDictionary(spark, f"{scratch}/d", compact_every)  # a new run each time
        values = [rng.choice([None, "é", *(f"v{i}" for i in range(9))]) for _ in range(rng.randint(0, 6))]
        if k == 6:
            store.clear()
            plain.clear()
        elif k % 3 == 2:
            store.remove(_values(spark, values))
            plain.remove(values)
        else:
            store.intern(_values(spark, values), ["seq"])
            plain.intern(values)
        assert _entries(store) == sorted((i, v) for v, i in plain.ids.items())
        assert store.counter() == plain.counter
    assert {r["value"] for r in store.lookup(_values(spark, ["v1", "nosuch"])).collect()} == {"v1"} & plain.ids.keys()


def test_an_unfinished_version_is_passed_over(spark, scratch):
    store = StoredDictionary(spark, f"{scratch}/d")
    assert _entries(store) == [] and store.counter() == 0
    store.intern(_values(spark, ["a", "b"]), ["seq"])
    # a run that ended after its entries and before its manifest row
    spark.createDataFrame([(3, "lost", True)], "id long, value string, live boolean").write.parquet(f"{scratch}/d/entries/2")
    assert _entries(store) == [(1, "a"), (2, "b")]
    store.intern(_values(spark, ["c"]), ["seq"])
    assert _entries(store) == [(1, "a"), (2, "b"), (3, "c")]
