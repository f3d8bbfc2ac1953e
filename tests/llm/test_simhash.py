"""Fingerprints and components against brute force, and edge cases."""

import random

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from buildlens.llm import simhash
from buildlens.llm.common import written
from buildlens.llm.queries import QUERIES


def plain(text):
    words = (text or "").encode().lower().split()
    shingles = [b" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))] if words else []
    hashes = [xxhash.xxh64(s, seed=42).intdigest() for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def classes(prints):
    """The least place reachable from each fingerprint."""
    values, root = np.array(prints, np.uint64), list(range(len(prints)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(prints)):
        for j in np.flatnonzero(np.bitwise_count(values[i + 1 :] ^ values[i]) <= 3) + i + 1:
            a, b = sorted((find(i), find(int(j))))
            root[b] = a
    return [find(i) for i in range(len(prints))]


def expected(rows):
    prints = [plain(r.text) for r in rows]
    places = classes(prints)
    least = {}
    for r, p in zip(rows, places):
        least[p] = min((x for x in (least.get(p), r.doc_id) if x is not None), default=None)
    return sorted(((r.doc_id, f"{f:016x}", least[p]) for r, f, p in zip(rows, prints, places)), key=str)


def test_given_documents(spark, sf_dir):
    rows = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()
    found = sorted((tuple(r) for r in QUERIES["op13_simhash"](spark, sf_dir).collect()), key=str)
    assert found == expected(rows) and any(i != c for i, _, c in found)


def test_edges(spark):
    long = "the quick brown fox jumps over a lazy dog and runs on " * 3000
    rows = [(9, None), (4, ""), (5, " \n\t\x0b "), (1, "One two"), (2, "one  TWO"), (3, "one"), (6, long), (7, long), (7, long),
            (None, long + "x"), (None, "alone in here"), (None, None), (8, "é b c d e ÄÖ"), (10, "x" * 20000)]
    frame = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    frame = frame.withColumns({c: F.lit("-") for c in ("fp", "key", "home", "root", "least", "size", "component_id", "fingerprint")})
    found = sorted((tuple(r) for r in simhash.components(frame).collect()), key=str)
    assert found == expected(frame.select("doc_id", "text").collect())
    by = {}
    for i, f, c in found:
        by.setdefault(i, []).append((f, c))
    assert by[9] == by[4] == by[5] == [("0" * 16, 4)] and by[2][0][1] == 1 and len(by[7]) == 2 and by[7][0][1] == 6
    assert sorted(map(str, (c for _, c in by[None]))) == ["4", "6", "None"]
    assert simhash.components(frame.limit(0)).count() == 0


def test_anchors_are_all_within_two_bits():
    near = simhash.errors()
    assert sorted(map(len, near)) == [1] + [16] * 31
    for s, patterns in enumerate(near):
        assert len(set(patterns)) == len(patterns)
        for e in patterns:
            assert e.bit_count() <= 2
            assert sum((e & c).bit_count() % 2 << j for j, c in enumerate(simhash._COVERED)) == s


@pytest.mark.parametrize("crowd", [60, 3000])
def test_planted_prints(spark, crowd):
    """Chains, random prints, and a crowd around one value: with 3,000, anchors are split twice."""
    rng = random.Random(crowd)
    prints = {rng.getrandbits(64) for _ in range(300)} | {0, 7, (1 << 64) - 1}
    for x in list(prints)[:100]:
        for _ in range(6):
            for _ in range(rng.randint(1, 4)):
                x ^= 1 << rng.randrange(64)
            prints.add(x)
    centre, size = rng.getrandbits(64), len(prints) + crowd
    while len(prints) < size:
        x = centre
        for _ in range(rng.randint(1, 5)):
            x ^= 1 << rng.randrange(64)
        prints.add(x)
    prints = sorted(prints)
    signed = np.array(prints, np.uint64).view(np.int64).tolist()
    frame = written(spark.createDataFrame([(x,) for x in signed], "fp long"), "test")
    root = {r.node: r.root for r in simhash.roots(simhash.linked(frame)).collect()}
    found, exact = {}, {}
    for x, place in zip(signed, classes(prints)):
        exact.setdefault(place, set()).add(x)
        found.setdefault(root.get(x, x), set()).add(x)
    assert sorted(map(sorted, found.values())) == sorted(map(sorted, exact.values()))


def test_forest_keeps_components_only():
    rng = random.Random(2)
    values = np.array([rng.getrandbits(6) | rng.getrandbits(1) << 40 for _ in range(300)], np.int64)
    links = simhash.forest(values[:150], values[150:], False, 3)
    assert len(links) < 300 and all((a ^ b).bit_count() <= 3 for a, b in links)
