"""Byte-level BPE encoding and decoding with the ranks of a public vocabulary.

A text is split by the pattern; each part is encoded by itself. The pattern never joins anything across a single space
but the space itself, so texts are cut at spaces and the pattern is applied to distinct chunks; only texts with a space
before other white space or at their end are matched whole. Distinct parts are put into padded matrices of token ids,
one for each range of lengths. In every round each row merges its leftmost pair of least rank, found by a hashed
pair lookup; rows without a mergeable pair leave the matrix.
"""

from __future__ import annotations

import base64
import heapq
import re
from collections import defaultdict
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import public_tokenizers
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import arrow_udf

from buildlens.llm.common import slices, tidied

VOCABULARY = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
#: No pair: larger than any rank.
NONE = np.int64(1 << 40)
#: Parts of more bytes are merged one by one with a heap: the rounds of a matrix would cost the square of the length.
MATRIX_BYTES = 512
#: Rows of a matrix, and distinct chunks remembered by a task.
ROWS, KNOWN_CHUNKS = 1 << 14, 150_000
_OPEN_SPACE = re.compile(r" (?:\s|\Z)")


@dataclass
class Tokenizer:
    """tokens[id]: the bytes of a token. slots, merged: a hash table from pairs of ids to the id of the merged token."""

    tokens: list[bytes]
    byte_ids: np.ndarray
    slots: np.ndarray
    merged: np.ndarray

    def ranks(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Id, which is the rank, of each merged pair; NONE where there is none or an id is negative."""
        key = left.astype(np.int64) * len(self.tokens) + right
        key[(left < 0) | (right < 0)] = -2
        out = np.full(key.shape, NONE)
        at, todo = _slot(key, len(self.slots)), np.arange(len(key))
        while len(todo):
            there = self.slots[at]
            hit = there == key[todo]
            out[todo[hit]] = self.merged[at[hit]]
            more = ~hit & (there >= 0)
            todo, at = todo[more], (at[more] + 1) & (len(self.slots) - 1)
        return out


def _slot(key: np.ndarray, size: int) -> np.ndarray:
    mixed = key.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    return (mixed >> np.uint64(64 - size.bit_length() + 1)).astype(np.int64)


def load(path: str = VOCABULARY) -> Tokenizer:
    with open(path, "rb") as file:
        ids = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, file)}
    tokens = [b""] * (max(ids.values()) + 1)
    for token, rank in ids.items():
        tokens[rank] = token
    pairs = {}
    for token, rank in ids.items():
        for cut in range(1, len(token)):
            left, right = ids.get(token[:cut]), ids.get(token[cut:])
            if left is not None and right is not None:
                pairs[left * len(tokens) + right] = rank
    key, value = np.array(list(pairs), np.int64), np.array(list(pairs.values()), np.int64)
    size = 1 << (2 * len(key) + 2).bit_length()
    slots, merged = np.full(size, -1, np.int64), np.zeros(size, np.int64)
    at = _slot(key, size)
    while len(key):
        at = np.where(slots[at] >= 0, (at + 1) & (size - 1), at)
        free = np.flatnonzero(slots[at] < 0)
        _, first = np.unique(at[free], return_index=True)
        won = free[first]
        slots[at[won]], merged[at[won]] = key[won], value[won]
        left = np.ones(len(key), bool)
        left[won] = False
        key, value, at = key[left], value[left], at[left]
    return Tokenizer(tokens, np.array([ids[bytes([i])] for i in range(256)], np.int64), slots, merged)


def _merge_rows(grid: np.ndarray, known: Tokenizer) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Merge the rows of a matrix of ids, padded by -1. Yields row numbers and their merged rows as they end."""
    rows = np.arange(len(grid))
    rank = known.ranks(grid[:, :-1].ravel(), grid[:, 1:].ravel()).reshape(len(grid), -1)
    while len(rows):
        if rank.shape[1] == 0:
            yield rows, grid
            return
        at = rank.argmin(1)
        least = rank[np.arange(len(rows)), at]
        ended = least == NONE
        if ended.any():
            yield rows[ended], grid[ended]
            rows, grid, rank, at, least = rows[~ended], grid[~ended], rank[~ended], at[~ended], least[~ended]
            if not len(rows):
                return
        each = np.arange(len(rows))
        grid[each, at] = least
        columns = np.arange(grid.shape[1] - 1)
        grid = np.take_along_axis(grid, columns + (columns > at[:, None]), 1)
        columns = columns[:-1]
        rank = np.take_along_axis(rank, columns + (columns >= at[:, None]), 1)
        if rank.shape[1] == 0:
            continue
        for near in (at - 1, at):
            good = np.flatnonzero((near >= 0) & (near < rank.shape[1]))
            here = near[good]
            rank[good, here] = known.ranks(grid[good, here], grid[good, here + 1])


def _merge_long(ids: list[int], known: Tokenizer) -> list[int]:
    """The same merges for one long row: a heap of pairs, and links between the ids that are left."""

    def rank(i: int, j: int) -> int:
        return int(known.ranks(np.array([ids[i]]), np.array([ids[j]]))[0])

    n = len(ids)
    before, after = list(range(-1, n - 1)), list(range(1, n + 1))
    first = known.ranks(np.array(ids[:-1]), np.array(ids[1:])).tolist()
    heap = [(r, i, ids[i], ids[i + 1]) for i, r in enumerate(first) if r < NONE]
    heapq.heapify(heap)
    while heap:
        r, i, left, right = heapq.heappop(heap)
        j = after[i] if ids[i] == left else n
        if j >= n or ids[j] != right:
            continue
        ids[i], ids[j], after[i] = r, -1, after[j]
        if after[i] < n:
            before[after[i]] = i
        for a, b in ((before[i], i), (i, after[i])):
            if a >= 0 and b < n and (least := rank(a, b)) < NONE:
                heapq.heappush(heap, (least, a, ids[a], ids[b]))
    return [x for x in ids if x >= 0]


def encode_parts(parts: list[str], known: Tokenizer, whole: dict[bytes, int]) -> list[bytes]:
    """Ids of each part as little-endian 32-bit integers. A part that is a token is that token."""
    data = [x.encode("utf-8") for x in parts]
    out: list[bytes] = [b""] * len(data)
    by_width = defaultdict(list)
    for i, part in enumerate(data):
        if (token := whole.get(part)) is not None:
            out[i] = token.to_bytes(4, "little")
        elif len(part) > MATRIX_BYTES:
            ids = _merge_long(known.byte_ids[np.frombuffer(part, np.uint8)].tolist(), known)
            out[i] = np.array(ids, "<u4").tobytes()
        else:
            by_width[-(-len(part) // 4) * 4 if len(part) <= 32 else 1 << (len(part) - 1).bit_length()].append(i)
    for width, index in by_width.items():
        step = max(1, min(ROWS, (1 << 20) // width))
        for at in range(0, len(index), step):
            own = index[at : at + step]
            sizes = np.array([len(data[i]) for i in own])
            grid = np.full((len(own), width), -1, np.int64)
            grid[np.arange(width) < sizes[:, None]] = known.byte_ids[
                np.frombuffer(b"".join([data[i] for i in own]), np.uint8)
            ]
            for rows, merged in _merge_rows(grid, known):
                filled = merged >= 0
                stream = merged[filled].astype("<u4").tobytes()
                ends = (4 * np.cumsum(filled.sum(1))).tolist()
                for row, begin, end in zip(rows.tolist(), [0, *ends], ends):
                    out[own[row]] = stream[begin:end]
    return out


def encode(text: Column, tokenizer: Tokenizer, pattern: str = public_tokenizers.PATTERN) -> Column:
    """Ids of each text as binary: little-endian unsigned 32-bit integers. A null text counts as empty."""
    return _udf(_encoder(tokenizer, pattern), "binary")(text)


def _udf(function: Callable, returned: str) -> Callable:
    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        yield from function(batches)

    run.__annotations__ = {"batches": Iterator[pa.Array], "return": Iterator[pa.Array]}
    return arrow_udf(run, returned)


def _encoder(tokenizer: Tokenizer, pattern: str) -> Callable[[Iterator[pa.Array]], Iterator[pa.Array]]:
    def ids(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        split = regex.compile(pattern).findall
        whole = {token: i for i, token in enumerate(tokenizer.tokens) if token}

        def encoded(texts: list[str]) -> list[bytes]:
            per_text = [split(x) for x in texts]
            parts = list(set().union(*per_text))
            found = dict(zip(parts, encode_parts(parts, tokenizer, whole)))
            return [b"".join(map(found.__getitem__, x)) for x in per_text]

        known: dict[str, bytes] = {}
        for texts in (part for batch in batches for part in slices(batch)):
            texts = texts.to_pylist()
            odd = [i for i, x in enumerate(texts) if _OPEN_SPACE.search(x)]
            odd_ids = encoded([texts[i] for i in odd])
            for i in odd:
                texts[i] = ""
            chunks = [x.split(" ") for x in texts]
            first = encoded([x.pop(0) for x in chunks])
            new = set().union(*chunks).difference(known)
            if len(known) + len(new) > KNOWN_CHUNKS:
                known, new = {}, set().union(*chunks)
            new = list(new)
            known.update(zip(new, encoded([" " + x for x in new])))
            out = [begin + b"".join(map(known.__getitem__, x)) for begin, x in zip(first, chunks)]
            for i, x in zip(odd, odd_ids):
                out[i] = x
            yield pa.array(out, pa.binary())

    return ids


def decode(ids: Column, tokenizer: Tokenizer) -> Column:
    """The bytes that such ids stand for. Null for null; an id outside the vocabulary raises an error."""
    return _udf(_decoder(tokenizer), "binary")(ids)


def _decoder(tokenizer: Tokenizer) -> Callable[[Iterator[pa.Array]], Iterator[pa.Array]]:
    tokens = tokenizer.tokens

    def data(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            for at in range(0, len(batch), 500):
                part = batch.slice(at, 500).to_pylist()
                out = [x and b"".join(map(tokens.__getitem__, np.frombuffer(x, "<u4").tolist())) for x in part]
                yield pa.array(out, pa.binary())

    return data


def coded(text: Column, tokenizer: Tokenizer, pattern: str = public_tokenizers.PATTERN) -> Column:
    """``struct<ids, decoded>``: a text's ids and the bytes they decode to, in one pass and one Python worker a task."""
    encoder, decoder = _encoder(tokenizer, pattern), _decoder(tokenizer)

    def both(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for ids in encoder(batches):
            for at in range(0, len(ids), 500):
                part = ids.slice(at, 500)
                for decoded in decoder(iter([part])):
                    yield pa.StructArray.from_arrays([part, decoded], ["ids", "decoded"])

    return _udf(tidied(both), "struct<ids binary, decoded binary>")(text)


def round_trip(documents: DataFrame, path: str = VOCABULARY) -> DataFrame:
    """doc_id, n_tokens, and the digests of ids and decoded bytes, for every row."""
    tokenizer = load(path)
    ids = documents.select("doc_id", encode(F.col("text"), tokenizer).alias("ids"))
    both = ids.select("doc_id", "ids", decode(F.col("ids"), tokenizer).alias("decoded"))
    return both.select(
        "doc_id",
        (F.octet_length("ids") / 4).cast("long").alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )
