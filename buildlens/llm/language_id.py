"""Language identification by segmentation-marginalised unigrams.

Every language has a probability for each piece of a fixed public byte vocabulary. A word's probability is the sum over
all its segmentations into pieces (a forward pass over its bytes), a text's the product over its words. The piece
probabilities are learned by expectation maximisation over all segmentations.
"""

from __future__ import annotations

import base64
import re
from collections import Counter, defaultdict
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import public_tokenizers
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import arrow_udf

from buildlens.llm.common import fold, slices, tidied, written

VOCABULARY = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
#: Longest piece of the vocabulary in bytes.
LONGEST = 33
#: Bytes of the words of one length whose pieces are held at once, of one word as well, and after how many bytes sums over
#: segmentations are scaled.
TOGETHER, STARTS, SCALED = 1 << 16, 1 << 12, 16
#: Documents of each language that the piece probabilities are fitted on (expected number; chosen by hash).
SAMPLE = 500
ROUNDS = 3
FLOOR = 1e-9
#: Scores of words (words x languages) that a task remembers.
KNOWN_SCORES = 600_000
_LETTER = re.compile(r"[^\W\d_]")


@dataclass
class Pieces:
    """keys[k], ids[k]: sorted 64-bit keys of the pieces of k bytes, and their numbers. size: number of pieces.

    A key is the piece itself up to 8 bytes, then a hash.

    maybe[k] says for 18 bits of a key's hash whether any piece has them, so that most keys need no search.
    """

    keys: list[np.ndarray]
    ids: list[np.ndarray]
    maybe: list[np.ndarray]
    size: int

    def find(self, key: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
        """The places of the keys that are pieces, and the numbers of these pieces."""
        at = np.flatnonzero(self.maybe[k][_hash(key)])
        near = np.minimum(np.searchsorted(self.keys[k], key[at]), len(self.keys[k]) - 1)
        good = self.keys[k][near] == key[at]
        return at[good], self.ids[k][near[good]]


def _hash(key: np.ndarray) -> np.ndarray:
    return (key * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(46)


def _longer(key: np.ndarray, byte: np.ndarray, k: int) -> np.ndarray:
    """Keys of k bytes from those of the first k - 1 and the last byte."""
    return (key << np.uint64(8)) | byte if k <= 8 else (key * np.uint64(0xD6E8FEB86659FD93) + byte) ^ (key >> np.uint64(29))


def _key(piece: bytes) -> int:
    key = np.zeros(1, np.uint64)
    for k, byte in enumerate(np.frombuffer(piece, np.uint8).astype(np.uint64), 1):
        key = _longer(key, byte, k)
    return int(key[0])


def pieces(path: str = VOCABULARY) -> Pieces:
    """The pieces of a rank file; all 256 single bytes are among them."""
    by_length = defaultdict(set)
    with open(path, "rb") as file:
        for line in file:
            piece = base64.b64decode(line.split()[0])
            by_length[len(piece)].add(int.from_bytes(piece, "big") if len(piece) <= 8 else _key(piece))
    if max(by_length) > LONGEST:
        raise ValueError(f"{path} has a piece of {max(by_length)} bytes")
    by_length[1] |= set(range(256))
    keys = [np.array(sorted(by_length[k]), np.uint64) for k in range(LONGEST + 1)]
    starts = np.cumsum([0] + [len(x) for x in keys[1:]])
    ids = [np.zeros(1, np.int64)] + [np.arange(a, b) for a, b in zip(starts, starts[1:])]
    maybe = [np.zeros(1 << 18, bool) for _ in keys]
    for flags, own in zip(maybe, keys):
        flags[_hash(own)] = True
    return Pieces(keys, ids, maybe, int(starts[-1]))


@dataclass
class LanguageModel:
    """p: piece probabilities, a row for each piece, a column for each language."""

    languages: list[str]
    pieces: Pieces
    p: np.ndarray


def _by_length(words: list[bytes], languages: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """The indexes of words of one length and their bytes, a column for each word."""
    by_length = defaultdict(list)
    for i, word in enumerate(words):
        by_length[len(word)].append(i)
    for n, index in by_length.items():
        step = max(1, min(8192, _cells(languages) // n))
        for at in range(0, len(index), step):
            part = index[at : at + step]
            grid = np.frombuffer(b"".join([words[i] for i in part]), np.uint8).reshape(len(part), n)
            yield np.array(part), np.ascontiguousarray(grid.T)


def _cells(languages: int) -> int:
    """Bytes of words whose edges are held at once: fewer for many languages."""
    return max(256, TOGETHER * 4 // max(4, languages))


@dataclass
class Edges:
    """Pieces found in words, by their start: edges bounds[i] to bounds[i + 1] start at byte first + i."""

    first: int
    bounds: list[int]
    length: np.ndarray
    word: np.ndarray
    ids: np.ndarray

    def starts(self) -> range:
        return range(self.first, self.first + len(self.bounds) - 1)

    def at(self, start: int) -> slice:
        return slice(self.bounds[start - self.first], self.bounds[start - self.first + 1])


def _edges(grid: np.ndarray, known: Pieces, first: int, last: int) -> Edges:
    """All pieces that start at the bytes first to last - 1 of the words; they may end beyond."""
    n, m = grid.shape
    rows = min(last, n) - first
    own = grid[first : first + rows + LONGEST - 1].astype(np.uint64)
    starts, lengths, places, numbers = [], [], [], []
    key = np.zeros((rows, m), np.uint64)
    for k in range(1, min(n - first, LONGEST) + 1):
        rows = min(rows, n - first - k + 1)
        key = _longer(key[:rows], own[k - 1 : k - 1 + rows], k)
        place, ids = known.find(key.ravel(), k)
        starts.append(place // m)
        places.append(place % m)
        lengths.append(np.full(len(place), k, np.int64))
        numbers.append(ids)
    start = np.concatenate(starts)
    order = np.argsort(start.astype(np.uint16), kind="stable")
    bounds = np.searchsorted(start[order], np.arange(min(last, n) - first + 1)).tolist()
    return Edges(first, bounds, *(np.concatenate(x)[order] for x in (lengths, places, numbers)))


def _blocks(grid: np.ndarray, languages: int) -> list[tuple[int, int]]:
    """Ranges of starts whose edges are held at once."""
    n, m = grid.shape
    step = min(STARTS, max(1, _cells(languages) // m))
    return [(a, min(n, a + step)) for a in range(0, n, step)]


def log_likelihoods(words: list[bytes], model: LanguageModel) -> np.ndarray:
    """A row for each word (1 byte or more), a column for each language.

    The sums over the segmentations of the first bytes are held for as many bytes as a piece can have. After each SCALED
    bytes they are divided by the one there, so time grows with a word's length and memory does not.
    """
    languages = model.p.shape[1]
    out = np.zeros((len(words), languages))
    for index, grid in _by_length(words, languages):
        n, m = grid.shape
        sums, scale = np.zeros((LONGEST + 1, m, languages)), np.zeros((m, languages))
        sums[0] = 1
        for first, last in _blocks(grid, languages):
            edges = _edges(grid, model.pieces, first, last)
            p = model.p[edges.ids]
            for start in edges.starts():
                here, own = sums[start % (LONGEST + 1)], edges.at(start)
                if start and start % SCALED == 0:
                    by = here.copy()
                    sums /= by
                    scale += np.log(by)
                word = edges.word[own]
                # a word has one piece of a length from here, so no place occurs twice
                sums[(start + edges.length[own]) % (LONGEST + 1), word] += here[word] * p[own]
                here[:] = 0
        out[index] = np.log(sums[n % (LONGEST + 1)]) + scale
    return out


def expected_counts(words: list[bytes], weight: np.ndarray, lang: np.ndarray, model: LanguageModel) -> np.ndarray:
    """How often each piece is expected in the words, over all segmentations: pieces x languages."""
    size, langs = model.p.shape
    total = np.zeros(size * langs)
    for index, grid in _by_length(words, 1):
        n, m = grid.shape
        own, heavy = lang[index], weight[index]
        # sums over the segmentations of the first bytes, each under the scale of its place
        alpha, scale, now = np.zeros((n + 1, m)), np.zeros((n + 1, m)), np.zeros(m)
        alpha[0] = 1
        blocks = _blocks(grid, 1)
        for block in blocks:
            edges = _edges(grid, model.pieces, *block)
            p = model.p[edges.ids, own[edges.word]]
            for start in edges.starts():
                if start and start % SCALED == 0:
                    by = alpha[start].copy()
                    alpha[start : start + LONGEST + 1] /= by
                    now = now + np.log(by)
                scale[start] = now
                part = edges.at(start)
                word = edges.word[part]
                alpha[start + edges.length[part], word] += alpha[start, word] * p[part]
        whole = np.log(alpha[n]) + now
        # the same from the end, one scale for the window in use
        beta, behind = np.zeros((n + 1, m)), np.zeros(m)
        beta[n] = 1
        for block in reversed(blocks):
            edges = _edges(grid, model.pieces, *block)
            p = model.p[edges.ids, own[edges.word]]
            share = np.zeros(len(p))
            for start in reversed(edges.starts()):
                part = edges.at(start)
                word = edges.word[part]
                on = p[part] * beta[start + edges.length[part], word]
                share[part] = alpha[start, word] * on * np.exp(scale[start] + behind - whole)[word]
                beta[start] = np.bincount(word, on, m)
                if (n - start) % SCALED == 0:
                    by = beta[start].copy()
                    beta[start : start + LONGEST + 1] /= by
                    behind = behind + np.log(by)
            np.add.at(total, edges.ids * langs + own[edges.word], share * heavy[edges.word])
    return total.reshape(size, langs)


def encoded(word: str) -> bytes:
    """A word's bytes, with the space before it."""
    return b" " + word.encode("utf-8", "replace")


def word_scores(words: list[str], model: LanguageModel) -> np.ndarray:
    """Log-likelihoods of words of any length, a row for each."""
    return log_likelihoods([encoded(x) for x in words], model)


def fit(
    documents: DataFrame, text: str = "text", lang: str = "lang", sample: int = SAMPLE, path: str = VOCABULARY
) -> LanguageModel:
    """Learn from the rows with a language and a text.

    Of each language ``sample`` documents are expected in the fit, with their whole texts: a row is taken if the hash
    of its text falls below ``sample`` over the language's row count. With no usable row there are no languages. The
    model takes 0.4 MB for each language.
    """
    rows = documents.select(F.col(lang).alias("lang"), F.col(text).alias("text")).filter(
        "lang IS NOT NULL AND text IS NOT NULL"
    )
    sizes = rows.groupBy("lang").count().collect()
    languages = sorted(row["lang"] for row in sizes)
    known = pieces(path)
    if not languages:
        return LanguageModel([], known, np.zeros((known.size, 0)))
    number = {x: i for i, x in enumerate(languages)}
    rate = F.create_map(*[F.lit(x) for r in sizes for x in (r["lang"], float(min(1.0, sample / r["count"])))])
    column = F.create_map(*[F.lit(x) for r in sizes for x in (r["lang"], number[r["lang"]])])
    draw = F.pmod(F.xxhash64("text", F.lit(7)), F.lit(1 << 30)) / float(1 << 30)
    chosen = rows.filter(draw < rate[F.col("lang")]).select(column[F.col("lang")].alias("lang"), "text")

    def count_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            counts: dict[int, Counter] = defaultdict(Counter)
            for own, whole in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                for word, n in Counter(whole.lower().split()).items():
                    counts[own][encoded(word)] += n
            for own, found in counts.items():
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([own] * len(found), pa.int32()),
                        pa.array(list(found), pa.binary()),
                        pa.array(list(found.values()), pa.int64()),
                    ],
                    ["lang", "word", "n"],
                )

    words = written(
        chosen.mapInArrow(tidied(count_words), "lang int, word binary, n long").groupBy("lang", "word").agg(F.sum("n").alias("n")),
        "lang-words",
    )
    model = LanguageModel(languages, known, np.full((known.size, len(languages)), 1.0 / known.size))
    for _ in range(ROUNDS):
        model = LanguageModel(languages, known, _maximised(words, model))
    return model


def _maximised(words: DataFrame, model: LanguageModel) -> np.ndarray:
    """Piece probabilities from one round of expected counts, which Spark sums per piece and language."""

    def expect(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(model.p.shape)
        for batch in batches:
            total += expected_counts(
                batch.column(1).to_pylist(),
                batch.column(2).to_numpy().astype(float),
                batch.column(0).to_numpy().astype(np.int64),
                model,
            )
        piece, lang = np.nonzero(total)
        yield pa.RecordBatch.from_arrays(
            [pa.array(piece, pa.int32()), pa.array(lang, pa.int32()), pa.array(total[piece, lang])], ["piece", "lang", "n"]
        )

    sums = words.mapInArrow(tidied(expect), "piece int, lang int, n double").groupBy("piece", "lang").agg(F.sum("n")).toPandas()
    count = np.full(model.p.shape, 0.01)
    np.add.at(count, (sums["piece"].to_numpy(), sums["lang"].to_numpy()), sums.iloc[:, 2].to_numpy())
    return np.maximum(count / count.sum(0), FLOOR)


def predict(text: Column, model: LanguageModel) -> Column:
    """``struct<lang, score>`` of a text column: the likeliest language and its posterior under equal priors.

    ``und`` with score 0 if the text is null, has no letter, or no language was learned. Equal likelihoods go to the
    first language by code point.
    """
    languages = pa.array([*model.languages, "und"])

    def scores(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        row: dict[str, int] = {}
        known = np.zeros((0, len(model.languages)))
        for batch in batches:
            best, score = [], []
            for texts in slices(batch):
                per_text = [x.lower().split() if _LETTER.search(x) else [] for x in texts.to_pylist()]
                if not model.languages:
                    per_text = [[] for _ in per_text]
                words = [word for x in per_text for word in x]
                new = list(set(words).difference(row))
                if (len(row) + len(new)) * len(model.languages) > KNOWN_SCORES:
                    row, new, known = {}, list(set(words)), known[:0]
                if new:
                    row.update(zip(new, range(len(known), len(known) + len(new))))
                    known = np.concatenate([known, word_scores(new, model)])
                sizes = np.array([len(x) for x in per_text])
                choice, sure = np.full(len(sizes), len(model.languages)), np.zeros(len(sizes))
                if full := np.flatnonzero(sizes).tolist():
                    each = known[np.fromiter(map(row.__getitem__, words), np.int64, len(words))]
                    total = np.add.reduceat(each, (np.cumsum(sizes) - sizes)[full], axis=0)
                    choice[full] = total.argmax(1)
                    sure[full] = 1 / np.exp(total - total.max(1, keepdims=True)).sum(1)
                best.append(choice)
                score.append(sure)
            best = np.concatenate(best) if best else np.zeros(0, np.int64)
            score = np.concatenate(score) if score else np.zeros(0)
            yield pa.StructArray.from_arrays([languages.take(pa.array(best)), pa.array(score)], ["lang", "score"])

    return _iterator_udf(scores, "struct<lang string, score double>")(text)


def _iterator_udf(function, returned: str):
    function = tidied(function)
    function.__annotations__ = {"batches": Iterator[pa.Array], "return": Iterator[pa.Array]}
    return arrow_udf(function, returned)


def identify(documents: DataFrame, folds: int = 5) -> DataFrame:
    """doc_id, held_out, lang_pred, score of every row of ``documents``; fold 0 is held out of the fit."""
    held_out = fold("doc_id", folds) == 0
    model = fit(documents.filter(~held_out))
    return documents.select("doc_id", held_out.alias("held_out"), predict(F.col("text"), model).alias("found")).select(
        "doc_id", "held_out", F.col("found.lang").alias("lang_pred"), F.col("found.score").alias("score")
    )


def recognised(documents: DataFrame, least: float = 0.5) -> DataFrame:
    """The rows whose language is found with a score of ``least`` or more, with their columns.

    Only rows whose text is null or has no letter, or whose best language is less likely than ``least``, go.
    """
    model = fit(documents.filter(fold("doc_id", 5) != 0))
    found = predict(F.col("text"), model)
    return documents.filter((found["lang"] != "und") & (found["score"] >= least))
