"""The manifest against a plain tree, and its edge cases."""

import hashlib
import zlib

import pytest
from pyspark.sql import functions as F

from buildlens.llm import merkle

COLUMNS = ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def digest(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def leaf(row, text):
    own = (row.doc_id, row.source, row.lang, row.n_chars, text)
    return digest(*["-" if v is None else f"{len(str(v).encode())}:{v}" for v in own])


def tree(nodes):
    levels = [nodes]
    while len(levels[-1]) > 1:
        levels.append([digest(*levels[-1][i : i + 16]) for i in range(0, len(levels[-1]), 16)])
    return levels


def path(levels, at):
    for nodes in levels[:-1]:
        first = at // 16 * 16
        yield nodes[first:at], nodes[at + 1 : first + 16]
        at //= 16


def plain(rows):
    groups = {}
    for r in rows:
        groups.setdefault(r.source, []).append((r.doc_id is not None, r.doc_id or 0, leaf(r, r.text), r))
    names = sorted(groups, key=lambda s: (s is not None, (s or "").encode()))
    trees = {}
    for s in names:
        groups[s].sort(key=lambda t: t[:3])
        trees[s] = tree([t[2] for t in groups[s]])
    top = tree([trees[s][-1][0] for s in names])
    for k, s in enumerate(names):
        for i, (_, _, own, r) in enumerate(groups[s]):
            steps = [*path(trees[s], i), *path(top, k)]
            folded = own
            if r.doc_id is not None and zlib.crc32(str(r.doc_id).encode()) % 5 == 0 and r.text is not None:
                folded = leaf(r, r.text.encode().lower().decode())
            for before, after in steps:
                folded = digest(*before, folded, *after)
            proof = digest(*[x for before, after in steps for x in before + after])
            yield r.doc_id, own, trees[s][-1][0], top[-1][0], proof, folded, folded == top[-1][0]


def same(frame):
    def key(t):
        return tuple(map(str, t))

    found = sorted((tuple(r) for r in merkle.manifest(frame).select(*COLUMNS).collect()), key=key)
    expected = sorted(plain(frame.select("doc_id", "text", "lang", "source", "n_chars").collect()), key=key)
    assert found == expected
    return found


def test_given_documents(spark, sf_dir):
    found = same(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    assert 0 < sum(not r[-1] for r in found) < len(found) / 2


@pytest.fixture(scope="module")
def edge(spark):
    rows = [
        (i if i % 7 else None, f"Text {i % 3}", None if i % 2 else "L", None if i % 5 == 0 else ("a" if i % 3 else "é"), i % 2)
        for i in range(700)
    ]
    rows += [(5, "Same", None, "a", 1)] * 5000
    rows += [(k * (1 << 40) - (1 << 62), None if k % 2 else "", "l", "a", None) for k in range(50)]
    rows += [(1, "Zz " * 60_000, "l", "lone", 2), (2, "x", "l", "", 2), ((1 << 63) - 1, "Y", None, "a", 0), (-(1 << 63), "Y", None, "a", 0)]
    frame = spark.createDataFrame(rows, SCHEMA).repartition(5)
    clash = "group leaf slot width copies rank total at piece copy path members digest root n kinds _id _n".split()
    return frame.withColumns({c: F.lit("-") for c in clash})


def test_nulls_ties_repeated_rows_and_clashing_names(edge):
    assert len(same(edge)) == 5754


@pytest.mark.parametrize("where", ["source = 'a'", "source IS NULL", "source = 'lone'", "doc_id IS NULL", "false"])
def test_parts(edge, where):
    same(edge.filter(where))


def test_many_sources_are_in_byte_order(spark):
    names = ["s" + chr(i) for i in (*range(33, 127), 0x7FF, 0xFFFD, 0x10000, 0x1F600)] + ["", None, "s"]
    same(spark.createDataFrame([(i, "A", None, s, None) for i, s in enumerate(names * 3)], SCHEMA).repartition(4))


def test_ranks_are_weights_of_smaller_values(spark):
    import random

    rng = random.Random(5)
    items = {(rng.choice("ab"), v): rng.choice([1, 1, 3]) for k in (4, 10, 20, 40, 62) for v in (rng.getrandbits(k) - (1 << k - 1) for _ in range(300))}
    items |= {("a", None): 7}
    frame = spark.createDataFrame([(g, v, w) for (g, v), w in items.items()], "g string, v long, w long")
    for r in merkle.ranks(frame, ["g"], "v", "w").collect():
        of = [(x, w) for (g, x), w in items.items() if g == r.g]
        before = sum(w for x, w in of if r.v is not None and (x is None or x < r.v))
        assert (r["rank"], r.total) == (before, sum(w for _, w in of))
