"""SimHash near duplicates by covering-code anchors.

1. Every text becomes a fingerprint of 64 bits, the majority of the bits of its shingles' hashes.
2. Fingerprints that differ in at most three bits differ in at most one bit of one of their halves. The anchors of a half
   are the words of the perfect Hamming code over 31 of its 32 bits: their covering radius is one, each of the 2**31 values
   is within one bit of exactly one anchor, its home.
3. Every fingerprint goes to all anchors within covering radius plus threshold, that is two bits, of each half: 15.5 each
   on average. If x and y differ in one bit of a half, y is within two bits of x's home; so they meet there.
4. The fingerprints at an anchor are compared. An anchor with many takes their other half's bytes as further keys (of at
   most three different bits, at least one of four bytes is equal) and then works on blocks, a bounded number of
   fingerprints each. A comparison hands on a forest of its links, never all pairs.
5. Links are contracted to components; equal fingerprints were one node from the start.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import arrow_udf

from buildlens.llm.common import handed_back, slices, written
from buildlens.llm.near_duplicates import roots

#: Words of a shingle, and the bits in which linked fingerprints may differ.
WIDTH, DISTANCE = 3, 3
SEED = 42
#: Coded bits of a half, and the parity checks of the code.
CODED, CHECKS = 31, 5
#: Fingerprints in a block, and the number at an anchor beyond which further keys are taken.
BLOCK = 1024
#: Hashes whose bits are counted at once.
CHUNK = 1 << 14

_UPPER = bytes(range(65, 91))
_TO_LOWER = bytes.maketrans(_UPPER, _UPPER.lower())
#: Check j covers the places (from one) whose number has bit j.
_COVERED = [sum(1 << (place - 1) for place in range(1, CODED + 1) if place >> j & 1) for j in range(CHECKS)]


def shingle_hashes(text: bytes, width: int = WIDTH) -> np.ndarray:
    """XXH64 of every shingle of a text, in order, repeats included."""
    words = text.translate(_TO_LOWER).split()
    if not words:
        return np.zeros(0, np.uint64)
    joint = b" ".join(words)
    if len(words) <= width:
        return np.array([xxhash.xxh64_intdigest(joint, SEED)], np.uint64)
    ends = np.cumsum([len(w) + 1 for w in words]) - 1
    starts = np.concatenate([[0], ends[: -width] + 1]).tolist()
    of, ends = xxhash.xxh64_intdigest, ends[width - 1 :].tolist()
    return np.fromiter((of(joint[a:b], SEED) for a, b in zip(starts, ends)), np.uint64, len(starts))


def fingerprint_of(hashes: np.ndarray) -> int:
    """The bits set in more than half of the hashes, as an unsigned integer; zero for none."""
    counts = np.zeros(64, np.int64)
    for at in range(0, len(hashes), CHUNK):
        bits = np.unpackbits(hashes[at : at + CHUNK].astype(">u8").view(np.uint8).reshape(-1, 8), axis=1)
        counts += bits.sum(0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * counts > len(hashes)).tobytes(), "big")


def fingerprint(text: Column, width: int = WIDTH) -> Column:
    """The fingerprint as a signed 64-bit integer; a null text counts as empty."""

    def of(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for texts in (part for batch in batches for part in slices(batch)):
            own = [fingerprint_of(shingle_hashes(x.as_buffer().to_pybytes(), width)) for x in texts]
            yield pa.array(np.array(own, np.uint64).view(np.int64))

    of.__annotations__ = {"batches": Iterator[pa.Array], "return": Iterator[pa.Array]}
    return arrow_udf(of, "long")(text)


def errors() -> list[list[int]]:
    """For each syndrome, the patterns of at most two bits that have it: a value's differences to the anchors near it."""
    single = [0] + [1 << (place - 1) for place in range(1, CODED + 1)]
    near = [[0]]
    for s in range(1, CODED + 1):
        near.append([single[s]] + [single[q] | single[q ^ s] for q in range(1, CODED + 1) if q != s and q < q ^ s])
    return near


def at_anchors(prints: DataFrame) -> DataFrame:
    """key, fp, home: every fingerprint at every anchor within two bits of each half; home tells the nearest one.

    The key is the anchor, with the half in bit 32.
    """
    near = F.array(*[F.array(*[F.lit(e).cast("long") for e in own]) for own in errors()])
    halves = F.array(
        F.struct(F.lit(0).cast("long").alias("half"), F.col("fp").bitwiseAND(F.lit((1 << CODED) - 1)).alias("value")),
        F.struct(F.lit(1 << 32).alias("half"), F.shiftrightunsigned("fp", 32).bitwiseAND(F.lit((1 << CODED) - 1)).alias("value")),
    )
    each = prints.select("fp", F.explode(halves).alias("own")).select("fp", "own.*")
    parities = [F.bit_count(F.col("value").bitwiseAND(F.lit(c))).bitwiseAND(F.lit(1)) * (1 << j) for j, c in enumerate(_COVERED)]
    syndrome = sum(parities[1:], parities[0])
    each = each.withColumn("near", F.element_at(near, syndrome + 1))
    placed = each.select("fp", "half", "value", F.posexplode("near").alias("at", "error"))
    return placed.select(
        F.col("value").bitwiseXOR(F.col("error")).bitwiseOR(F.col("half")).alias("key"), "fp", (F.col("at") == 0).alias("home")
    )


def _hot_keys(placed: DataFrame) -> DataFrame:
    """key, fp of crowded anchors, with a byte of the other half as part of the key: four rows for each one."""
    other = F.when(F.col("key") < 1 << 32, F.shiftrightunsigned("fp", 32)).otherwise(F.col("fp"))
    places = F.explode(F.array(*[F.lit(j) for j in range(4)])).alias("place")
    rows = placed.select("key", "fp", other.bitwiseAND(F.lit((1 << 32) - 1)).alias("other"), places)
    byte = F.call_function("shiftright", F.col("other"), F.col("place") * 8).bitwiseAND(F.lit(255))
    return rows.select((F.col("key") + (F.col("place") + 1) * (1 << 33) + byte * (1 << 36)).alias("key"), "fp")


def forest(left: np.ndarray, right: np.ndarray, same: bool, distance: int) -> list[tuple[int, int]]:
    """Links of a spanning forest of the pairs within the distance, one fingerprint of each side (of ``left`` if same).

    Only fingerprints that are still in different trees can add a link.
    """
    n = len(left)
    members = (left if same else np.concatenate([left, right])).view(np.uint64)
    names = members.view(np.int64).tolist()
    root = np.arange(len(members))
    links = []
    for i in range(n):
        others = np.arange(i + 1, n) if same else np.arange(n, len(members))
        near = others[np.bitwise_count(members[others] ^ members[i]) <= distance]
        near = near[root[near] != root[i]]
        while len(near):
            j = near[0]
            links.append((names[i], names[j]))
            root[root == root[j]] = root[i]
            near = near[root[near] != root[i]]
    return links


def _crowded(placed: DataFrame, sizes: DataFrame, distance: int) -> DataFrame:
    """a, b: links at keys (key, c: their number of fingerprints), found block by block."""
    blocks = F.ceil(F.col("c") / BLOCK).cast("long")
    marked = placed.join(sizes.select("key", blocks.alias("blocks")), "key")
    packed = marked.groupBy("key", F.pmod(F.xxhash64("fp"), "blocks").alias("block")).agg(F.collect_list("fp").alias("fps"))
    left = packed.select("key", F.col("block").alias("l_block"), F.col("fps").alias("l_fps"))
    pairs = left.join(packed, (left["key"] == packed["key"]) & (left["l_block"] <= packed["block"]))

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            links = []
            for l_fps, r_fps, same in zip(*batch.columns):
                links += forest(l_fps.values.to_numpy(), r_fps.values.to_numpy(), same.as_py(), distance)
            yield pa.RecordBatch.from_arrays([pa.array([x[k] for x in links], pa.int64()) for k in (0, 1)], ["a", "b"])

    own = pairs.select("l_fps", "fps", (F.col("l_block") == F.col("block")).alias("same"))
    return own.mapInArrow(compare, "a long, b long")


def linked(prints: DataFrame, distance: int = DISTANCE) -> DataFrame:
    """a, b: fingerprints of the written table ``prints`` (fp, all different) that differ in at most ``distance`` bits
    (three or fewer): enough of these links to connect all that are connected."""
    placed = at_anchors(prints)
    sizes = placed.groupBy("key").agg(
        F.count("*").alias("c"), F.max("home").alias("home"), F.min("fp").alias("a"), F.max("fp").alias("b")
    )
    # a link shows at the home of either of its two: an anchor that is nobody's home has nothing to say
    sizes = written(sizes.filter("c > 1 AND home"), "anchors")
    near = F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= distance
    pairs = sizes.filter((F.col("c") == 2) & near).select("a", "b")
    few = _crowded(placed, sizes.filter((F.col("c") > 2) & (F.col("c") <= BLOCK)), distance)
    hot = _hot_keys(placed.join(sizes.filter(F.col("c") > BLOCK).select("key"), "key", "left_semi"))
    # few anchors are that crowded: these are counted once more by their further keys
    hot_sizes = hot.groupBy("key").agg(F.count("*").alias("c")).filter("c > 1")
    return pairs.union(few).union(_crowded(hot, hot_sizes, distance))


def components(documents: DataFrame, width: int = WIDTH, distance: int = DISTANCE) -> DataFrame:
    """doc_id, fingerprint (16 hex digits), component_id of every row of ``documents`` (doc_id, text).

    component_id is the least doc_id reachable over links, that is fingerprints that differ in at most ``distance`` bits
    (three or fewer). A text without words, empty or null, has the fingerprint zero and is linked like any other. A row
    with a null doc_id links as others do, but is nobody's component_id: a group of only such rows has a null one. Repeated
    rows come as often as they are there. Other columns are not looked at. An empty table gives an empty result.
    """
    if not 0 <= distance <= DISTANCE:
        raise ValueError(f"the anchors find differences of up to {DISTANCE} bits")
    signed = written(documents.select("doc_id", fingerprint(F.col("text"), width).alias("fp")), "fingerprints")
    classes = written(signed.groupBy("fp").agg(F.min("doc_id").alias("least"), F.count("*").alias("size")), "prints")
    moved = written(roots(linked(classes.select("fp"), distance)), "moved")
    groups = classes.join(moved.withColumnRenamed("node", "fp"), "fp", "left").withColumn("root", F.coalesce("root", "fp"))
    groups = written(groups, "groups")
    # of components of several prints only: most prints are alone
    joined = groups.join(moved.select("root").distinct(), "root", "left_semi")
    least = joined.groupBy("root").agg(F.min("least").alias("component_id"), F.count("*").alias("prints"))
    least = written(least, "components")
    alone = groups.join(least.select("root"), "root", "left_anti").select("fp", "size", F.col("least").alias("component_id"))
    several = handed_back(joined.select("root", "fp", "size"), least, "root", "prints").select("fp", "size", "component_id")
    labels = written(alone.union(several), "labels")
    found = handed_back(signed, labels, "fp", "size")
    return found.select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")
