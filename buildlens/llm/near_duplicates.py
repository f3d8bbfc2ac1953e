"""Near duplicates by MinHash bands with sequential Bayesian verification.

1. Every text becomes its set of word shingles, hashed to 64 bits; of the set: a digest, a MinHash signature, band keys.
2. Equal sets are one class, stood for by its smallest id. Only classes are compared.
3. Classes that share a band key are candidates. In the first rounds, a bucket's members are compared with one of them,
   its hub, only, and not at all if links already join them; a large group of copies is joined by as many comparisons as
   it has members. A last round compares what is still apart in a bucket: all members outside its largest component with
   all others. So no pair of a bucket that could join two components is left out. That round works on blocks of members,
   a bounded number each, and only pairs that pass the next step leave a task.
4. A pair's signatures are compared in batches. After each, the pair is dropped if the posterior probability that the
   similarity reaches the threshold is below the miss probability. Then the parities of the sets are compared: every odd
   cell of the two together stands for a shingle that only one has, so a pair with too many is dropped for certain. The
   rest is confirmed on the full sets.
5. Links are contracted to components by alternating star operations.

A pair of similarity 0.8 shares no band with probability (1 - 0.8 ** 6) ** 56 = 4e-8.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import arrow_udf

from buildlens.llm.common import SPACES, handed_back, raw, slices, tidied, written

BANDS, ROWS = 56, 6
HASHES = BANDS * ROWS
#: Signature hashes compared before each posterior test, and the posterior below which a pair is dropped.
BATCH, MISS = 48, 1e-8
#: Bytes of text hashed at once: each takes about 50 bytes of memory for a moment.
SLICE = 1 << 19
#: Cells of a set's parity: each tells whether it holds an odd number of shingles.
CELLS = 2048
#: Members of a bucket in a block of the last round.
BLOCK = 512
#: Rounds in which buckets are compared with a hub.
HUB_ROUNDS = 3
#: Bits of the filter that tells which texts a verification reads: a multiple of the ids', within these bounds.
LEAST_BITS, MOST_BITS = 1 << 15, 1 << 27

_U = np.uint64
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_SPACE = np.zeros(256, bool)
_SPACE[list(SPACES)] = True


def _mixed(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit integers that spreads every bit."""
    x = (x ^ (x >> _U(30))) * _U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> _U(27))) * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(31))


def _constants(n: int, salt: int) -> np.ndarray:
    return _mixed(np.arange(1, n + 1, dtype=_U) * _U(0x9E3779B97F4A7C15) + _U(salt)) | _U(1)


def word_hashes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """A hash of every word of all texts, lower-cased in A-Z, and the number of words of each text.

    A word's hash comes from the differences of a running polynomial sum over all bytes.
    """
    data, offsets = raw(texts)
    data = _LOWER[data]
    if not len(data):
        return np.zeros(0, _U), np.zeros(len(texts), np.int64)
    space = _SPACE[data]
    first = np.zeros(len(data) + 1, bool)
    first[offsets] = True
    start = np.flatnonzero(~space & (first[:-1] | np.concatenate([[True], space[:-1]])))
    end = np.flatnonzero(~space & (first[1:] | np.concatenate([space[1:], [True]]))) + 1
    base = 0x9E3779B97F4A7C15
    powers, inverse = (np.full(len(data), x, _U) for x in (base, pow(base, -1, 1 << 64)))
    powers[0] = inverse[0] = 1
    powers, inverse = np.cumprod(powers, dtype=_U), np.cumprod(inverse, dtype=_U)
    sums = np.concatenate([np.zeros(1, _U), np.cumsum(_constants(256, 1)[data] * powers, dtype=_U)])
    hashes = _mixed((sums[end] - sums[start]) * inverse[start] + (end - start).astype(_U))
    return hashes, np.bincount(np.searchsorted(offsets, start, "right") - 1, minlength=len(texts))


def shingle_sets(texts: pa.Array, width: int) -> list[np.ndarray]:
    """The sorted distinct shingle hashes of each text: of ``width`` words, or of all words if there are fewer."""
    hashes, sizes = word_hashes(texts)
    factors = _constants(width, 2)
    spans = max(0, len(hashes) - width + 1)
    joint = np.zeros(spans, _U)
    for k in range(width):
        joint += hashes[k : k + spans] * factors[k]
    joint = _mixed(joint)
    out, at = [], 0
    for n in sizes.tolist():
        if n >= width:
            out.append(np.unique(joint[at : at + n - width + 1]))
        else:
            out.append(_mixed((hashes[at : at + n] * factors[:n]).sum(keepdims=True, dtype=_U) + _U(n))[: min(n, 1)])
        at += n
    return out


_FACTORS = (_constants(HASHES, 3) >> _U(32)).astype(np.uint32) | np.uint32(1)
_FLIPS = (_constants(HASHES, 4) >> _U(32)).astype(np.uint32)


def minima(shingles: np.ndarray) -> np.ndarray:
    """The least value of each of the HASHES hash functions over a set that is not empty."""
    short = (shingles >> _U(32)).astype(np.uint32)
    least = np.full(HASHES, 0xFFFFFFFF, np.uint32)
    for at in range(0, len(short), 1024):
        np.minimum(least, ((short[at : at + 1024, None] ^ _FLIPS) * _FACTORS).min(0), out=least)
    return least


def parity(shingles: np.ndarray) -> np.ndarray:
    return np.packbits((np.bincount((shingles & _U(CELLS - 1)).astype(np.int64), minlength=CELLS) & 1).astype(np.uint8))


def band_keys(least: np.ndarray) -> np.ndarray:
    rows = least.reshape(BANDS, ROWS).astype(_U)
    return _mixed((rows * _constants(ROWS, 5)).sum(1, dtype=_U) + _constants(BANDS, 6)).astype(np.int64)


def signature(text: Column, width: int) -> Column:
    """``struct<n, digest, sig, keys>``: set size, digest, a byte of each minimum and then the parity, band keys.

    Without words the size is 0, digest and signature are null and there are no keys.
    """
    kind = pa.struct(
        [("n", pa.int64()), ("digest", pa.binary()), ("sig", pa.binary()), ("keys", pa.list_(pa.int64()))]
    )

    def signed(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for texts in (part for batch in batches for part in slices(batch, SLICE)):
            n, digest, sig, keys = [], [], [], []
            for shingles in shingle_sets(texts, width):
                n.append(len(shingles))
                if not len(shingles):
                    digest.append(None)
                    sig.append(None)
                    keys.append([])
                    continue
                least = minima(shingles)
                digest.append(hashlib.blake2b(shingles.tobytes(), digest_size=16).digest())
                sig.append(least.astype(np.uint8).tobytes() + parity(shingles).tobytes())
                keys.append(band_keys(least))
            yield pa.StructArray.from_arrays(
                [pa.array(x, f.type) for x, f in zip((n, digest, sig, keys), kind)], fields=list(kind)
            )

    signed = tidied(signed)
    signed.__annotations__ = {"batches": Iterator[pa.Array], "return": Iterator[pa.Array]}
    return arrow_udf(signed, "struct<n long, digest binary, sig binary, keys array<long>>")(text)


def least_matches(share: float, total: int = HASHES, batch: int = BATCH, miss: float = MISS) -> list[tuple[int, int]]:
    """(hashes compared, least number of matches to go on) for each batch.

    Under a uniform prior, the posterior that the match probability reaches t after m matches of n is the probability
    of at most m successes in n + 1 trials at t. Two bytes also match by chance.
    """
    t = share + (1 - share) / 256
    bounds = []
    for n in [*range(batch, total, batch), total]:
        below, m = 0.0, -1
        while True:
            term = math.exp(
                math.lgamma(n + 2) - math.lgamma(m + 2) - math.lgamma(n + 1 - m)
                + (m + 1) * math.log(t) + (n - m) * math.log1p(-t)
            )
            if below + term >= miss:
                break
            below, m = below + term, m + 1
        bounds.append((n, m + 1))
    return bounds


def passing(
    left: np.ndarray, right: np.ndarray, sizes: np.ndarray, percent: int, bounds: list[tuple[int, int]]
) -> np.ndarray:
    """Places of the pairs of signatures (rows of bytes) that nothing rules out; sizes: of both sets together.

    Of sets with A and B shingles, 100 * intersection >= percent * union means that at most
    (100 - percent) * (A + B) / (100 + percent) shingles are in one set only.
    """
    open_, matches, at = np.arange(len(left)), np.zeros(len(left), np.int64), 0
    for n, least in bounds:
        matches = matches + (left[open_, at:n] == right[open_, at:n]).sum(1)
        open_, matches, at = open_[matches >= least], matches[matches >= least], n
    odd = np.bitwise_count(left[open_, HASHES:] ^ right[open_, HASHES:]).sum(1, dtype=np.int64)
    return open_[(100 + percent) * odd <= (100 - percent) * sizes[open_]]


def _signatures(column: pa.Array) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), np.uint8).reshape(-1, HASHES + CELLS // 8)


def plausible(pairs: DataFrame, signatures: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) that their signatures (id, n, sig) do not rule out."""
    bounds = least_matches(percent / 100)

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes = batch.column(4).to_numpy() + batch.column(5).to_numpy()
            good = passing(_signatures(batch.column(2)), _signatures(batch.column(3)), sizes, percent, bounds)
            yield batch.select(["a", "b"]).take(pa.array(good))

    def side(name: str) -> DataFrame:
        return signatures.select(*[F.col(c).alias(d) for c, d in (("id", name), ("sig", "sig_" + name), ("n", "n_" + name))])

    joined = pairs.join(side("a"), "a").join(side("b"), "b")
    return joined.select("a", "b", "sig_a", "sig_b", "n_a", "n_b").mapInArrow(tidied(compare), pairs.select("a", "b").schema)


def _sets_of(ids: DataFrame, documents: DataFrame, width: int) -> DataFrame:
    """id, shingles for the documents (id, text) whose id is among ``ids``, and for a few others.

    A bitmap of hashed ids keeps most other texts from being read into Python. Its size is bounded, so it is broadcast:
    MOST_BITS / 8 bytes at most, in parts of 32,768 bits.
    """
    bits = min(MOST_BITS, max(LEAST_BITS, 1 << (16 * ids.count()).bit_length()))

    def bit(id: Column) -> Column:
        return F.pmod(F.xxhash64(id), F.lit(bits))

    parts = (
        ids.select(bit(F.col("id")).alias("bit"))
        .groupBy(F.bitmap_bucket_number("bit").alias("part"))
        .agg(F.bitmap_construct_agg(F.bitmap_bit_position("bit")).alias("bits"))
    )

    def sets(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for texts in (part for batch in batches for part in slices(batch, SLICE)):
            yield pa.array([x.tobytes() for x in shingle_sets(texts, width)], pa.binary())

    sets = tidied(sets)
    sets.__annotations__ = {"batches": Iterator[pa.Array], "return": Iterator[pa.Array]}
    own = documents.withColumn("bit", bit(F.col("id")))
    own = own.withColumns({"part": F.bitmap_bucket_number("bit"), "at": F.bitmap_bit_position("bit")})
    byte = F.conv(F.hex(F.substr("bits", F.floor(F.col("at") / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("long")
    there = own.join(F.broadcast(parts), "part").filter(F.getbit(byte, (F.col("at") % 8).cast("int")) == 1)
    return there.select("id", arrow_udf(sets, "binary")(F.col("text")).alias("shingles"))


def confirmed(pairs: DataFrame, documents: DataFrame, width: int, percent: int) -> DataFrame:
    """The pairs whose full shingle sets have 100 * intersection >= percent * union."""

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            good = []
            for i, (x, y) in enumerate(zip(batch.column(2), batch.column(3))):
                left, right = np.frombuffer(x.as_buffer(), _U), np.frombuffer(y.as_buffer(), _U)
                both = len(np.intersect1d(left, right, assume_unique=True))
                if 100 * both >= percent * (len(left) + len(right) - both):
                    good.append(i)
            yield batch.select(["a", "b"]).take(pa.array(good, pa.int64()))

    ids = pairs.select(F.col("a").alias("id")).union(pairs.select("b")).distinct()
    # either side of a pair joins them: read and hashed once, of the round's texts only
    sets = written(_sets_of(ids, documents, width).join(ids, "id", "left_semi"), "sets")
    joined = pairs.join(sets.select(F.col("id").alias("a"), F.col("shingles").alias("set_a")), "a")
    joined = joined.join(sets.select(F.col("id").alias("b"), F.col("shingles").alias("set_b")), "b")
    return joined.select("a", "b", "set_a", "set_b").mapInArrow(tidied(compare), pairs.select("a", "b").schema)


def roots(edges: DataFrame) -> DataFrame:
    """node, root for every node of the edges (a, b) but the roots; a root is the least node of its component.

    Alternating large-star and small-star operations: every node passes the least node it sees to its neighbours, until
    nothing changes. Each step is a join and an aggregate; tables are written between steps.
    """
    edges = written(
        edges.filter("a != b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(), "links"
    )
    state = _state(edges)
    while state[0]:
        both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.join(least, "u").filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u").select(
            F.explode(F.array(F.struct(F.col("u").alias("u"), F.col("m").alias("v")), F.struct(F.col("v").alias("u"), F.col("m").alias("v")))).alias("e")
        )
        edges = written(small.select("e.u", "e.v").filter("u != v").distinct(), "links")
        before, state = state, _state(edges)
        if state == before:
            break
    return edges.select(F.col("u").alias("node"), F.col("v").alias("root"))


def _state(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(20,0)"))).first())


def _hub_pairs(buckets: DataFrame, percent: int, turn: int) -> DataFrame:
    """Each member of a bucket with the bucket's hub, if they are in different components.

    In the first round the same documents are hubs of many buckets, so a document meets few. In later rounds each bucket
    draws its own: what is still apart then meets as many hubs as it has buckets, still no more than its own number.
    """
    chance = F.col("key") + F.lit(turn) if turn else F.lit(0)
    hubs = (
        buckets.groupBy("key")
        .agg(
            F.min("comp").alias("lo"),
            F.max("comp").alias("hi"),
            F.min(F.struct(F.xxhash64("id", chance), "id", "comp", "n")).alias("hub"),
        )
        .filter("lo != hi")
        .select("key", F.col("hub.id").alias("hub"), F.col("hub.comp").alias("hub_comp"), F.col("hub.n").alias("hub_n"))
    )
    near = (F.least("n", "hub_n") * 100 >= F.greatest("n", "hub_n") * percent) & (F.col("comp") != F.col("hub_comp"))
    return buckets.join(hubs, "key").filter(near).select(F.least("id", "hub").alias("a"), F.greatest("id", "hub").alias("b"))


def _open_pairs(buckets: DataFrame, signatures: DataFrame, percent: int) -> DataFrame:
    """The pairs of a bucket that are in different components and that their signatures do not rule out: members outside
    its largest component with all others. Members are packed in blocks, blocks meet by their bucket."""
    sizes = buckets.groupBy("key", "comp").agg(F.count("*").alias("size"))
    main = (
        sizes.groupBy("key")
        .agg(F.max(F.struct("size", "comp")).alias("main"), F.sum("size").alias("all"), F.count("*").alias("comps"))
        # a bucket of two is done by its hub
        .filter("comps > 1 AND all > 2")
        .select("key", F.col("main.comp").alias("main"), F.ceil(F.col("all") / BLOCK).alias("blocks"))
    )
    marked = buckets.join(main, "key").join(signatures.select("id", "sig"), "id")
    blocks = marked.groupBy(
        "key", (F.col("comp") != F.col("main")).alias("stray"), F.pmod(F.xxhash64("id"), "blocks").alias("block")
    ).agg(*[F.collect_list(c).alias(c) for c in ("id", "comp", "n", "sig")])
    left = blocks.filter("stray").select("key", F.col("block").alias("l_block"), *[F.col(c).alias("l_" + c) for c in _MEMBER])
    once = ~F.col("stray") | (F.col("block") >= F.col("l_block"))
    pairs = left.join(blocks, (left["key"] == blocks["key"]) & once)
    bounds = least_matches(percent / 100)

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in range(len(batch)):
                (l_id, l_comp, l_n, l_sig), (r_id, r_comp, r_n, r_sig) = (
                    [*[batch.column(at + k)[row].values.to_numpy() for k in range(3)], _signatures(batch.column(at + 3)[row].values)]
                    for at in (0, 4)
                )
                for i in range(len(l_id)):
                    near = 100 * np.minimum(l_n[i], r_n) >= percent * np.maximum(l_n[i], r_n)
                    j = np.flatnonzero(near & (r_comp != l_comp[i]))
                    same = np.broadcast_to(l_sig[i], (len(j), l_sig.shape[1]))
                    good = j[passing(same, r_sig[j], l_n[i] + r_n[j], percent, bounds)]
                    if len(good):
                        a, b = np.minimum(l_id[i], r_id[good]), np.maximum(l_id[i], r_id[good])
                        yield pa.RecordBatch.from_arrays([pa.array(a), pa.array(b)], ["a", "b"])

    kind = buckets.schema["id"].dataType.simpleString()
    sides = [*["l_" + c for c in _MEMBER], *_MEMBER]
    return pairs.select(*sides).mapInArrow(tidied(compare), f"a {kind}, b {kind}")


_MEMBER = ("id", "comp", "n", "sig")


def find(
    documents: DataFrame, id: str = "doc_id", text: str = "text", width: int = 5, percent: int = 80
) -> DataFrame:
    """id, n_shingles, component for every row of ``documents``.

    component is the least id reachable over links, that is pairs of sets with 100 * intersection >= percent * union.
    A null or empty text has the empty set and no links. Rows with the same id are one document, linked as any of its
    rows. A row with a null id is on its own, with a null component. An empty table gives an empty result.
    """
    texts = documents.select(F.col(id).alias("id"), F.col(text).alias("text"))
    signed = written(texts.select("id", signature(F.col("text"), width).alias("s")).select("id", "s.*"), "signatures")
    full = signed.filter("n > 0 AND id IS NOT NULL")
    classes = written(full.groupBy("digest").agg(F.min("id").alias("rep"), F.count("*").alias("size")), "classes")
    heads = full.join(classes.select("digest", F.col("rep").alias("id")), ["digest", "id"], "left_semi")
    bands = heads.select("id", "n", F.explode("keys").alias("key"))
    shared = bands.groupBy("key").agg(F.count("*").alias("c")).filter("c > 1").select("key")
    buckets = written(bands.join(shared, "key"), "buckets")
    labels = None
    for turn in range(HUB_ROUNDS + 1):
        if labels is None:
            labelled = buckets.withColumn("comp", F.col("id"))
        else:
            labelled = buckets.join(labels, "id", "left").withColumn("comp", F.coalesce("comp", "id"))
        if turn < HUB_ROUNDS:
            likely = plausible(_hub_pairs(labelled, percent, turn).distinct(), full, percent)
        else:
            likely = _open_pairs(labelled, full, percent).distinct()
        likely = written(likely, "likely-pairs")
        if likely.isEmpty():
            continue
        links = confirmed(likely, texts, width, percent)
        if labels is None:
            labels = written(roots(links).select(F.col("node").alias("id"), F.col("root").alias("comp")), "labels")
            continue
        for side in ("a", "b"):
            own = labels.select(F.col("id").alias(side), F.col("comp").alias("c" + side))
            links = links.join(own, side, "left").withColumn("c" + side, F.coalesce("c" + side, side))
        moved = roots(links.select(F.col("ca").alias("a"), F.col("cb").alias("b")))
        labels = written(_relabelled(labels, moved), "labels")
    if labels is None:
        classes = classes.withColumn("component", F.col("rep"))
    else:
        own = labels.select(F.col("id").alias("rep"), "comp")
        classes = classes.join(own, "rep", "left").withColumn("component", F.coalesce("comp", "rep"))
    known = written(classes.select("digest", "size", "component"), "classes")
    rows = signed.select("id", F.col("n").alias("n_shingles"), "digest")
    alone = rows.filter("n_shingles = 0 OR id IS NULL").select("id", "n_shingles", F.col("id").alias("component"))
    named = handed_back(rows.filter("n_shingles > 0 AND id IS NOT NULL"), known, "digest", "size")
    return alone.union(named.select("id", "n_shingles", "component"))


def _relabelled(labels: DataFrame, moved: DataFrame) -> DataFrame:
    """id, comp after components moved to new roots; a node that only moved gets its first label."""
    old = labels.join(moved, labels["comp"] == moved["node"], "left").select("id", F.coalesce("root", "comp").alias("comp"))
    # a root of the earlier labels, or a document without one, is named by itself
    new = moved.select(F.col("node").alias("id"), F.col("root").alias("comp"))
    return old.union(new)


def components(documents: DataFrame, width: int = 4, percent: int = 80) -> DataFrame:
    """doc_id, n_shingles, component_id, kept of every row of ``documents``."""
    return find(documents, width=width, percent=percent).select(
        F.col("id").alias("doc_id"),
        "n_shingles",
        F.col("component").alias("component_id"),
        F.col("id").eqNullSafe(F.col("component")).alias("kept"),
    )


def deduplicated(documents: DataFrame, id: str = "doc_id", text: str = "text", width: int = 5, percent: int = 80) -> DataFrame:
    """One row of each group of near duplicates, with its columns: the one with the least id.

    Rows with an empty text or a null id stay. Of several rows with a kept id, that whose text hashes least stays.
    """
    found = find(documents, id, text, width, percent)
    kept = found.filter("id = component").groupBy(F.col("id").alias("_id")).agg(F.count("*").alias("_rows"))
    rows = documents.select(F.col(id).alias("_id"), F.struct(*documents.columns).alias("row"))
    single = rows.join(kept.filter("_rows = 1"), "_id", "left_semi").select("row")
    first = F.min_by("row", F.xxhash64(F.col("row")[text])).alias("row")
    several = rows.join(kept.filter("_rows > 1"), "_id", "left_semi").groupBy("_id").agg(first).select("row")
    unnamed = rows.filter("_id IS NULL").select("row")
    return single.union(several).union(unnamed).select("row.*")
