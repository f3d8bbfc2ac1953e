"""Exact top-k search by inner product with a table of distances to pivots.

The distance of two vectors is at least the difference of their distances to any pivot. The largest of these lower bounds
over all pivots bounds the inner product from above. Vectors near each other are packed into blocks, which also hold the
range of their distances to each pivot, so whole blocks fall to the same bound. In a block that stays, each query takes
the candidates in the order of their bounds and stops at the first whose bound is below its k-th best score.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from buildlens.llm.common import written

#: Pivots, components in a block of vectors and of queries, and candidates scored at once.
PIVOTS, BLOCK, QUERIES, STEP = 24, 1 << 17, 1 << 14, 32
#: Parts that the descriptions of the data blocks are dealt to.
LANES = 16
#: Vectors that a query's first threshold comes from (expected number; chosen by hash).
SEEN = 2048

_BLOCK_TYPE = "ids binary, vectors binary, table binary, low binary, high binary"


def quantised(vectors: DataFrame, id: str = "vec_id", vector: str = "embedding", scale: int = 256) -> DataFrame:
    """id, v: floor(scale * component) as integers. Rows with a null id or vector, a null component or one that is not
    finite are left out. A shorter vector counts as ending in zeros."""
    v = F.col("v")
    good = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return (
        vectors.select(F.col(id).cast("long").alias("id"), F.col(vector).cast("array<double>").alias("v"))
        .filter(F.col("id").isNotNull() & v.isNotNull())
        .filter(F.coalesce(good, F.lit(True)))
        .select("id", F.transform(v, lambda x: F.floor(x * scale).cast("long")).alias("v"))
    )


def _matrix(column: pa.ChunkedArray | pa.Array, width: int) -> np.ndarray:
    """Lists of integers as rows, padded by zeros."""
    out = np.zeros((len(column), width), np.int64)
    sizes = np.array([len(x) for x in column], np.int64)
    out[np.arange(width) < sizes[:, None]] = column.flatten().to_numpy(zero_copy_only=False)
    return out


def _distances(vectors: np.ndarray, pivots: np.ndarray) -> np.ndarray:
    """Distances of each vector to each pivot, without the loss of a difference of squares."""
    out = np.empty((len(vectors), len(pivots)))
    for k, pivot in enumerate(pivots):
        out[:, k] = np.sqrt(((vectors - pivot).astype(float) ** 2).sum(1))
    return out


def blocks(rows: DataFrame, count: int, pivots: np.ndarray, size: int) -> DataFrame:
    """The vectors in numbered blocks of ``size``, neighbours together: sorted by nearest pivot and distance to it.

    Spark deals the sorted rows out by range, so that a frequent vector fills as many blocks as it needs. The table is
    written: a block keeps its number.
    """
    width = pivots.shape[1]

    def located(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            far = _distances(_matrix(batch.column(1), width), pivots)
            near = far.argmin(1)
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(near.astype(np.int32)), pa.array(far[np.arange(len(far)), near])],
                ["id", "v", "cell", "far"],
            )

    def packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def pack(ids: np.ndarray, vectors: np.ndarray) -> list:
            table = np.column_stack([_distances(vectors, pivots), np.sqrt((vectors.astype(float) ** 2).sum(1))])
            parts = (ids, vectors, table, table.min(0), table.max(0))
            return [x.tobytes() for x in parts]

        held: list[tuple[np.ndarray, np.ndarray]] = []
        count = 0
        for batch in batches:
            held.append((batch.column(0).to_numpy(), _matrix(batch.column(1), width)))
            count += len(batch)
            while count >= size:
                ids, vectors = (np.concatenate(x) for x in zip(*held))
                yield _block_rows([pack(ids[:size], vectors[:size])])
                held, count = [(ids[size:], vectors[size:])], count - size
        if count:
            ids, vectors = (np.concatenate(x) for x in zip(*held))
            yield _block_rows([pack(ids, vectors)])

    placed = rows.mapInArrow(located, "id long, v array<long>, cell int, far double")
    dealt = placed.repartitionByRange("cell", "far", "id").coalesce(max(1, -(-count // (4 * size))))
    ordered = dealt.sortWithinPartitions("cell", "far", "id").select("id", "v")
    numbered = ordered.mapInArrow(packed, _BLOCK_TYPE).withColumn("block", F.monotonically_increasing_id())
    return written(numbered, "top-blocks")


def _block_rows(rows: list[list]) -> pa.RecordBatch:
    names = [x.split()[0] for x in _BLOCK_TYPE.split(", ")]
    return pa.RecordBatch.from_arrays([pa.array(x, pa.binary()) for x in zip(*rows)], names)


def upper_bounds(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """No inner product of a vector of the left table and one of the right is larger.

    Tables hold distances to the pivots and, last, the vector's length. The slack covers rounding.
    """
    apart = np.zeros((len(left), len(right)))
    for k in range(left.shape[1]):
        np.maximum(apart, np.abs(left[:, k, None] - right[None, :, k]), out=apart)
    squares = left[:, -1, None] ** 2 + right[None, :, -1] ** 2
    return np.minimum(
        (squares - apart**2) / 2, left[:, -1, None] * right[None, :, -1]
    ) + squares * 1e-9 + 1e-6


def _best(scores: np.ndarray, ids: np.ndarray, k: int) -> np.ndarray:
    """Places of the k highest scores, ties to smaller ids."""
    return np.lexsort((ids, -scores))[:k]


def search_block(queries: tuple, candidates: tuple, least: np.ndarray, k: int) -> list[tuple[int, int, int]]:
    """(query id, id, score) of the candidates that may be among the k best of a query.

    queries, candidates: ids, vectors, table. least: a score that the query's k-th best is not below.
    """
    bounds = upper_bounds(queries[2], candidates[2])
    out = []
    for i, own in enumerate(queries[0].tolist()):
        open_ = np.flatnonzero(bounds[i] >= least[i])
        open_ = open_[candidates[0][open_] != own]
        open_ = open_[np.argsort(-bounds[i][open_], kind="stable")]
        ids, scores = np.zeros(0, np.int64), np.zeros(0, np.int64)
        for at in range(0, len(open_), STEP):
            part = open_[at : at + STEP]
            if len(scores) == k and bounds[i][part[0]] < scores[-1]:
                break
            ids = np.concatenate([ids, candidates[0][part]])
            scores = np.concatenate([scores, candidates[1][part] @ queries[1][i]])
            best = _best(scores, ids, k)
            ids, scores = ids[best], scores[best]
        out += [(own, a, b) for a, b in zip(ids.tolist(), scores.tolist()) if b >= least[i]]
    return out


def search(vectors: DataFrame, queries: str = "id % 50 = 0", k: int = 5, **names: str) -> DataFrame:
    """query_id, rank, vec_id, score: the k best of all rows but its own for every row that ``queries`` names.

    Scores are inner products of integers, ties go to the smaller id; a query with fewer candidates gets all. Rows of
    equal vectors tie. Rows that share an id are no candidates of each other, and the one with the least vector is the
    query. An empty table gives an empty result. Products must fit 64 bits.
    """
    spark = vectors.sparkSession
    rows = written(quantised(vectors, **names), "top-vectors")
    shape = "query_id long, rank int, vec_id long, score long"
    count, width = rows.agg(F.count("*"), F.coalesce(F.max(F.size("v")), F.lit(0))).first()
    if not count:
        return spark.createDataFrame([], shape)
    width = max(width, 1)
    # pivots and first thresholds come from a few rows chosen by hash; the results do not depend on them
    draw = F.pmod(F.xxhash64("id", "v"), F.lit(1 << 30)) / float(1 << 30)
    seen = rows.filter(draw < 2.0 * SEEN / count).orderBy(F.xxhash64("id", "v"), "id").limit(SEEN).toArrow()
    if not len(seen):
        seen = rows.orderBy("id").limit(SEEN).toArrow()
    seen_ids, seen_vectors = seen.column(0).to_numpy(), _matrix(seen.column(1).combine_chunks(), width)
    pivots = spread(seen_vectors, PIVOTS)
    data = blocks(rows, count, pivots, max(64, BLOCK // width))
    own = rows.filter(queries).groupBy("id").agg(F.min("v").alias("v"))
    asked = blocks(own, own.count(), pivots, max(16, QUERIES // width))

    def unpacked(batch: pa.RecordBatch, at: int, row: int) -> tuple:
        ids, vecs, table = (np.frombuffer(batch.column(at + j)[row].as_py(), t) for j, t in enumerate((np.int64, np.int64, float)))
        return ids, vecs.reshape(-1, width), table.reshape(-1, PIVOTS + 1)

    def opened(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """A query block with its thresholds: the k-th best scores among the seen rows."""
        for batch in batches:
            least = []
            for row in range(len(batch)):
                ids, vecs, _ = unpacked(batch, 1, row)
                scores = vecs @ seen_vectors.T if len(seen_ids) else np.zeros((len(ids), 0), np.int64)
                scores[ids[:, None] == seen_ids[None, :]] = np.iinfo(np.int64).min
                scores = np.sort(scores, 1)[:, -k] if scores.shape[1] >= k else np.full(len(ids), np.iinfo(np.int64).min)
                least.append(scores.astype(np.int64).tobytes())
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(least, pa.binary())], [*batch.schema.names, "least"]
            )

    fields = ["block", "ids", "vectors", "table"]
    asked = asked.select(*fields).mapInArrow(opened, "block long, ids binary, vectors binary, table binary, least binary")
    asked = written(asked, "top-queries").select(*[F.col(x).alias(f"q_{x}") for x in (*fields, "least")])

    def bounded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Pairs of a query block and a data block of which some query can find something."""
        for batch in batches:
            good = []
            for row in range(len(batch)):
                table = np.frombuffer(batch.column(1)[row].as_py(), float).reshape(-1, PIVOTS + 1)
                least = np.frombuffer(batch.column(2)[row].as_py(), np.int64)
                low, high = (np.frombuffer(batch.column(j)[row].as_py(), float) for j in (4, 5))
                apart = np.maximum(0, np.maximum(low - table, table - high)).max(1)
                squares = table[:, -1] ** 2 + high[-1] ** 2
                if ((squares - apart**2) / 2 + squares * 1e-9 + 1e-6 >= least).any():
                    good.append(row)
            yield batch.select(["q_block", "block"]).take(pa.array(good, pa.int64()))

    # the query blocks meet the short descriptions of the data blocks; only pairs that pass move vectors
    lanes = F.explode(F.sequence(F.lit(0), F.lit(LANES - 1))).alias("lane")
    described = data.select("block", "low", "high", F.pmod("block", F.lit(LANES)).alias("lane"))
    pairs = (
        asked.select("q_block", "q_table", "q_least", lanes)
        .join(described, "lane")
        .select("q_block", "q_table", "q_least", "block", "low", "high")
        .mapInArrow(bounded, "q_block long, block long")
    )

    def searched(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = []
            for row in range(len(batch)):
                least = np.frombuffer(batch.column(3)[row].as_py(), np.int64)
                found += search_block(unpacked(batch, 0, row), unpacked(batch, 4, row), least, k)
            columns = list(zip(*found)) or [(), (), ()]
            yield pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in columns], ["query_id", "vec_id", "score"])

    found = (
        pairs.join(asked, "q_block")
        .join(data.select("block", "ids", "vectors", "table"), "block")
        .select("q_ids", "q_vectors", "q_table", "q_least", "ids", "vectors", "table")
        .mapInArrow(searched, "query_id long, vec_id long, score long")
    )
    best = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    ranked = found.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")


def spread(vectors: np.ndarray, count: int) -> np.ndarray:
    """Pivots far from each other: each the farthest from those before. Repeated if there are too few vectors."""
    chosen = [0]
    far = _distances(vectors, vectors[:1])[:, 0]
    while len(chosen) < count:
        chosen.append(int(far.argmax()))
        far = np.minimum(far, _distances(vectors, vectors[chosen[-1:]])[:, 0])
    return vectors[chosen]
