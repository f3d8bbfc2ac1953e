"""Class-based n-gram scoring in the manner of Brown.

Exchange clustering puts words into classes that predict each other best. The most frequent words are exchanged first, in
turn; then every other word that was found more than once, however many there are, moves to the class that raises the
likelihood most, by what stands before and after it in all training texts, summed in Spark. Words found once stand for the
unknown ones and share their class; the end of a text has its own. A token's probability is that of its class after the
class before it, times that of the word in its class. The frequent words travel with the model, whose size is bounded;
counts and classes of all others are joined.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import arrow_udf

from buildlens.llm.common import fold, slices, written
from buildlens.session import scratch_dir

#: Words that are exchanged first, in turn, and the classes of all words.
CORE, CLASSES = 1000, 32
#: Most frequent words, whose counts and classes travel with the model; those of all others are joined. Words found once are
#: always left to the last class: what they take of the training texts tells what unknown words take.
HEAD = 200_000
SWEEPS = 8
#: Octaves of counts: what the words outside the core are to their neighbours before they have a class.
OCTAVES = 63
#: Pseudo-count of the class unigram in a class transition.
BACKOFF = 5.0
#: Distinct words that a task counts before it hands them on, and neighbours of words.
HELD_WORDS = 300_000
HELD_CELLS = 2_000_000

# units: the core words, the end of a text, the octaves, the tail
END, TAIL = CORE, CORE + 1 + OCTAVES
UNITS = TAIL + 1
# a word outside the core has the unit of its class, which comes after these; the code of words whose class is joined
JOINED = 255


def tokens(data: bytes) -> list[bytes]:
    """The words of a text in UTF-8, lower-cased in A-Z; the end, which follows, is not listed."""
    return data.lower().split()


@dataclass
class ClassModel:
    """counts: the table (word, n) of all training tokens but the ends. total, distinct: of all training tokens.

    words, count, unit: the head words by rank, their counts and units. classes: the table (word, n, class) of all words
    outside the head. group: the class of each unit. transition: log10 probabilities, a row for each class before.
    in_class: log10 of each class's emission denominator.
    """

    counts: DataFrame
    classes: DataFrame
    total: int
    distinct: int
    ends: int
    words: list[bytes]
    count: np.ndarray
    unit: np.ndarray
    group: np.ndarray
    transition: np.ndarray
    in_class: np.ndarray


def count_words(documents: DataFrame, text: str = "text") -> DataFrame:
    """word, n for all words of all texts: counted in each task, then summed."""

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows(held: Counter) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays(
                [pa.array(list(held), pa.binary()), pa.array(list(held.values()), pa.int64())], ["word", "n"]
            )

        held: Counter = Counter()
        for batch in batches:
            for texts in slices(batch.column(0)):
                held.update(word for x in texts.cast(pa.binary()).to_pylist() for word in tokens(x))
                if len(held) > HELD_WORDS:
                    yield rows(held)
                    held = Counter()
        yield rows(held)

    found = documents.select(F.col(text).alias("text")).mapInArrow(counted, "word binary, n long")
    return found.groupBy("word").agg(F.sum("n").alias("n"))


def _indexed(text: Column, words: list[bytes]) -> Column:
    """``struct<index, tail>``: the head index of each token of a text as 32-bit integers, ``len(words)`` for a word outside
    the head and one more for the end; the words outside the head in their order."""
    kind = pa.struct([("index", pa.binary()), ("tail", pa.list_(pa.binary()))])

    def indexed(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        at, last = {word: i for i, word in enumerate(words)}, len(words)
        for batch in batches:
            parts = []
            for texts in slices(batch):
                rows, tails = [], []
                for x in texts.cast(pa.binary()).to_pylist():
                    listed = tokens(x)
                    own = [at.get(w, last) for w in listed]
                    tails.append([w for w, i in zip(listed, own) if i == last])
                    own.append(last + 1)
                    rows.append(np.array(own, np.int32).tobytes())
                columns = (pa.array(rows, pa.binary()), pa.array(tails, pa.list_(pa.binary())))
                parts.append(pa.StructArray.from_arrays(columns, fields=list(kind)))
            yield pa.concat_arrays(parts) if parts else pa.array([], kind)

    indexed.__annotations__ = {"batches": Iterator[pa.Array], "return": Iterator[pa.Array]}
    return arrow_udf(indexed, "struct<index binary, tail array<binary>>")(text)


def _parts(documents: DataFrame, words: list[bytes], text: str, learn: Column) -> DataFrame:
    """row, key, learn, index, tail of every text, written. ``row`` holds the columns but the text, ``key`` numbers the rows."""
    kept = F.struct(*[c for c in documents.columns if c != text]) if len(documents.columns) > 1 else F.struct(F.lit(0))
    key = F.monotonically_increasing_id()
    found = documents.select(kept.alias("row"), key.alias("key"), learn.alias("learn"), _indexed(F.col(text), words).alias("p"))
    return _packed(found.select("row", "key", "learn", "p.index", "p.tail"), "lm-parts")


def _packed(df: DataFrame, label: str) -> DataFrame:
    path = scratch_dir(df.sparkSession, label)
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def _sequence(values: pa.Array, kind: type) -> tuple[np.ndarray, np.ndarray]:
    """All tokens of the texts in a row, and the place of each text's first. Every text has its end at least."""
    lengths = pc.binary_length(values).to_numpy(zero_copy_only=False).astype(np.int64) // np.dtype(kind).itemsize
    return np.frombuffer(b"".join(values.to_pylist()), kind).astype(np.int64), np.cumsum(lengths) - lengths


def _filled(codes: pa.Array, classes: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The classes of all tokens in a row, and the place of each text's first."""
    found, starts = _sequence(codes, np.uint8)
    found[found == JOINED] = classes.flatten().to_numpy(zero_copy_only=False)
    return found, starts


def _sliced(first: pa.Array, second: pa.Array) -> Iterator[tuple[pa.Array, pa.Array]]:
    at = 0
    for part in slices(first):
        yield part, second.slice(at, len(part))
        at += len(part)


def _head(counts: DataFrame) -> DataFrame:
    """The most frequent words, at most HEAD: all above a count. Words are counted by the size of their count first, in
    steps of a 64th of an octave, so that the driver gets no more than the steps and the head itself."""
    often = counts.filter("n > 1")
    step = F.floor(F.log2("n") * 64).cast("long")
    sizes = sorted((r["step"], r["count"]) for r in often.groupBy(step.alias("step")).count().collect())
    least, held = None, 0
    for own, n in reversed(sizes):
        if (held := held + n) > HEAD:
            break
        least = own
    return often.filter(step >= least) if least is not None else often.limit(0)


def _pairs(texts: DataFrame, units: Callable[[pa.RecordBatch], Iterator[np.ndarray]], end: int, size: int) -> np.ndarray:
    """How often each of ``size`` units follows each: every text begins after an ``end``. Summed by Spark, ``size ** 2`` cells
    at most. ``units`` tells those of the tokens of a batch, by whole texts."""

    def paired(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(size * size, np.int64)
        for batch in batches:
            for found in units(batch):
                before = np.concatenate([[end], found[:-1]])
                total += np.bincount(before * size + found, minlength=size * size)
        cells = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(cells), pa.array(total[cells])], ["cell", "n"])

    sums = texts.mapInArrow(paired, "cell long, n long").groupBy("cell").agg(F.sum("n").alias("n")).toPandas()
    pairs = np.zeros(size * size)
    pairs[sums["cell"].to_numpy(np.int64)] = sums["n"].to_numpy()
    return pairs.reshape(size, size)


def _neighbours(parts: DataFrame, words: list[bytes], core: int, of: np.ndarray, size: int) -> DataFrame:
    """word, rank, n, found: for each word outside the core, what stands before and after it how often.

    ``rank`` is the head index, NULL outside the head. ``found`` holds pairs of bytes, as many strings as tasks handed the word
    on: the number of a neighbour, ``size`` more for what comes after the word, and how often, repeated where over 255.
    """

    def listed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last = len(words)

        def rows(keys: list[np.ndarray], others: list[bytes]) -> pa.RecordBatch:
            cells, n = np.unique(np.concatenate(keys), return_counts=True) if keys else (np.zeros(0, np.int64),) * 2
            times = -(-n // 255)
            cells = np.repeat(cells, times)
            held = np.full(len(cells), 255)
            held[np.cumsum(times) - 1] = n - 255 * (times - 1)
            starts = np.flatnonzero(np.diff(cells >> 8, prepend=-1))
            own = (cells[starts] >> 8).tolist()
            before = np.where((cells & 255) < size, held, 0)
            data = np.column_stack([cells & 255, held]).astype(np.uint8).tobytes()
            ends = (2 * np.append(starts, len(cells))).astype(np.int32)
            return pa.RecordBatch.from_arrays(
                [
                    pa.array([words[i] if i < last else others[i - last] for i in own], pa.binary()),
                    pa.array([i if i < last else None for i in own], pa.int32()),
                    pa.array(np.add.reduceat(before, starts) if own else [], pa.int64()),
                    pa.Array.from_buffers(pa.binary(), len(own), [None, pa.py_buffer(ends.tobytes()), pa.py_buffer(data)]),
                ],
                ["word", "rank", "n", "found"],
            )

        keys, others, ids, held = [], [], {}, 0
        for batch in batches:
            for index, tail in _sliced(batch.column(0), batch.column(1)):
                # what is behind a text's last word is its end, what is before its first the end of another
                number = _sequence(index, np.int32)[0]
                units = of[number]
                before, after = np.concatenate([[of[-1]], units[:-1]]), np.concatenate([units[1:], [of[-1]]])
                at = np.flatnonzero((number >= core) & (number <= last))
                number = number[at]
                rare = tail.flatten().to_pylist()
                for word in rare:
                    if word not in ids:
                        ids[word] = last + len(others)
                        others.append(word)
                number[number == last] = np.fromiter((ids[w] for w in rare), np.int64, len(rare))
                keys += [number << 8 | before[at], number << 8 | (after[at] + size)]
                held += 2 * len(at)
                if held > HELD_CELLS:
                    yield rows(keys, others)
                    keys, others, ids, held = [], [], {}, 0
        yield rows(keys, others)

    found = parts.select("index", "tail").mapInArrow(listed, "word binary, rank int, n long, found binary")
    # dealt out as they are: few words come twice from a task
    dealt = found.repartition("word", "rank")
    return dealt.groupBy("word", "rank").agg(F.sum("n").alias("n"), F.collect_list("found").alias("found"))


def best_classes(found: np.ndarray, joint: np.ndarray, classes: int = CLASSES) -> np.ndarray:
    """The class that raises the likelihood of the pairs most, for each of the words. ``found`` has a row for each word: how
    often each unit of ``joint`` is before it, then after it; the first ``classes`` units of ``joint`` are the classes."""
    size = len(joint)
    gain = np.zeros((len(found), classes))
    n = found[:, :size].sum(1)
    for k in range(classes):
        for part, base in ((found[:, :size], joint[:, k]), (found[:, size:], joint[k])):
            gain[:, k] += (_g(base + part) - _g(base)).sum(1)
        for whole in (joint[:, k].sum(), joint[k].sum()):
            gain[:, k] -= _g(whole + n) - _g(whole)
    return gain.argmax(1)


def _assigned(neighbours: DataFrame, joint: np.ndarray, unknown: int) -> DataFrame:
    """word, rank, n, class of all words outside the core, written; words found once have the class ``unknown``."""
    size = len(joint)

    def chosen(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            best = np.full(batch.num_rows, unknown, np.int32)
            often = np.flatnonzero(batch.column(2).to_numpy() > 1)
            for start in range(0, len(often), 1000):
                at = often[start : start + 1000]
                lists = batch.column(3).take(pa.array(at))
                strings = lists.flatten()
                row = np.repeat(np.arange(len(at)), pc.list_value_length(lists).to_numpy())
                row = np.repeat(row, pc.binary_length(strings).to_numpy() // 2)
                cells, n = np.frombuffer(b"".join(strings.to_pylist()), np.uint8).reshape(-1, 2).T
                found = np.bincount(row * 2 * size + cells, n, len(at) * 2 * size).reshape(len(at), 2 * size)
                best[at] = best_classes(found, joint)
            yield pa.RecordBatch.from_arrays([*batch.columns[:3], pa.array(best)], ["word", "rank", "n", "class"])

    return written(neighbours.mapInArrow(chosen, "word binary, rank int, n long, class int"), "lm-classes")


def _classed(index: Column, of: np.ndarray, count: np.ndarray, ends: int) -> Column:
    """``struct<codes, n_tokens, n_known, logs>``: the class of each token of a text as a byte, JOINED for words outside the
    head, the number of tokens, and of the end and the head words those known and the sum of log10(c + 0.5)."""
    code = of.copy()
    code[-2] = JOINED
    log_count = np.concatenate([np.log10(count + 0.5), [0.0, np.log10(ends + 0.5)]])
    known = np.concatenate([np.ones(len(count), np.int64), [0, int(ends > 0)]])
    fields = [("codes", pa.binary()), ("n_tokens", pa.int64()), ("n_known", pa.int64()), ("logs", pa.float64())]
    kind = pa.struct(fields)

    def classed(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            parts = []
            for part in slices(batch):
                found, starts = _sequence(part, np.int32)
                lengths = np.diff(starts, append=len(found))
                places = np.append(starts, len(found)).astype(np.int32)
                data = code[found].astype(np.uint8).tobytes()
                columns = (
                    pa.Array.from_buffers(pa.binary(), len(part), [None, pa.py_buffer(places.tobytes()), pa.py_buffer(data)]),
                    pa.array(lengths),
                    pa.array(np.add.reduceat(known[found], starts)),
                    pa.array(np.add.reduceat(log_count[found], starts)),
                )
                parts.append(pa.StructArray.from_arrays(columns, fields=list(kind)))
            yield pa.concat_arrays(parts) if parts else pa.array([], kind)

    classed.__annotations__ = {"batches": Iterator[pa.Array], "return": Iterator[pa.Array]}
    return arrow_udf(classed, "struct<codes binary, n_tokens long, n_known long, logs double>")(index)


def _coded(parts: DataFrame, classes: DataFrame, of: np.ndarray, count: np.ndarray, ends: int) -> DataFrame:
    """row, learn, codes, classes, n_tokens, n_known, logs of every text: see ``_classed``; ``classes`` are those of the words
    outside the head in their order, whose counts are in the sums."""
    rare = parts.select("key", F.posexplode("tail").alias("at", "word"))
    n = F.coalesce(F.col("n"), F.lit(0))
    own = F.struct("at", F.coalesce("class", F.lit(int(of[-2]))).cast("byte").alias("class"))
    summed = (
        rare.join(classes.select("word", "n", "class"), "word", "left")
        .groupBy("key")
        .agg(
            F.sum(F.log10(n + 0.5)).alias("logs"),
            F.sum((n > 0).cast("long")).alias("known"),
            F.transform(F.array_sort(F.collect_list(own)), lambda x: x["class"]).alias("classes"),
        )
    )
    head = parts.select("row", "key", "learn", _classed(F.col("index"), of, count, ends).alias("p"))
    return head.join(summed, "key", "left").select(
        "row",
        "learn",
        "p.codes",
        "classes",
        "p.n_tokens",
        (F.col("p.n_known") + F.coalesce("known", F.lit(0))).alias("n_known"),
        (F.col("p.logs") + F.coalesce("logs", F.lit(0.0))).alias("logs"),
    )


def _g(x: np.ndarray) -> np.ndarray:
    return x * np.log(np.maximum(x, 1))


def exchange(pairs: np.ndarray, core: int, classes: int = CLASSES, sweeps: int = SWEEPS) -> np.ndarray:
    """Class of each unit. The first ``core`` units, by falling count, are moved to the class that raises the
    likelihood of the pairs most, in turn, until a sweep moves none; all other units keep a class of their own."""
    units = len(pairs)
    group = np.concatenate([np.arange(core) % classes, classes + np.arange(units - core)])
    count = classes + units - core
    member = np.zeros((units, count))
    member[np.arange(units), group] = 1
    left, right = pairs.T @ member, pairs @ member
    joint = member.T @ right
    for _ in range(sweeps):
        moved = 0
        for w in range(core):
            own, twice = group[w], pairs[w, w]
            after, before = right[w].copy(), left[w].copy()
            joint[own] -= after
            joint[:, own] -= before
            joint[own, own] += twice
            after[own] -= twice
            before[own] -= twice
            rows, columns = joint.sum(1)[:classes], joint.sum(0)[:classes]
            out, into = joint[:classes], joint[:, :classes].T
            gain = (_g(out + after) - _g(out)).sum(1) + (_g(into + before) - _g(into)).sum(1)
            same = np.diag(joint)[:classes]
            gain += _g(same + after[:classes] + before[:classes] + twice) + _g(same)
            gain -= _g(same + after[:classes]) + _g(same + before[:classes])
            gain -= _g(rows + after.sum() + twice) - _g(rows) + _g(columns + before.sum() + twice) - _g(columns)
            to = int(gain.argmax())
            if gain[to] <= gain[own] + 1e-9:
                to = own
            after[to] += twice
            before[to] += twice
            joint[to] += after
            joint[:, to] += before
            joint[to, to] -= twice
            if to != own:
                moved += 1
                group[w] = to
                left[:, own] -= pairs[w]
                left[:, to] += pairs[w]
                right[:, own] -= pairs[:, w]
                right[:, to] += pairs[:, w]
        if not moved:
            break
    return group


def train(documents: DataFrame, text: str = "text") -> ClassModel:
    """A model of the texts, whole; null texts are empty. Without documents every probability is uniform."""
    return _train(documents, text, F.lit(True))[0]


def _train(documents: DataFrame, text: str, learn: Column) -> tuple[ClassModel, DataFrame]:
    """A model of the texts where ``learn``, and all texts by its classes, written."""
    trained = documents.filter(learn)
    counts = written(count_words(trained, text), "lm-counts")
    ends = trained.count()
    words_total, words_distinct = counts.agg(F.coalesce(F.sum("n"), F.lit(0)), F.count("*")).first()
    head = _head(counts).toPandas().sort_values(["n", "word"], ascending=[False, True])
    words = [bytes(x) for x in head["word"]]
    count = head["n"].to_numpy().astype(np.int64)
    core = min(CORE, len(words))
    parts = _parts(documents, words, text, learn)
    learned = parts.filter("learn").select("index", "tail")
    # the core first, among octaves of counts
    octave = np.log2(np.maximum(count, 1)).astype(np.int64)
    unit = np.where(np.arange(len(words)) < core, np.arange(len(words)), CORE + 1 + octave)
    of = np.concatenate([unit, [TAIL, END]]).astype(np.int64)
    pairs = _pairs(learned, lambda batch: (of[_sequence(x, np.int32)[0]] for x in slices(batch.column(0))), END, UNITS)
    group = exchange(pairs, CORE)
    size = int(group.max()) + 1
    member = np.zeros((UNITS, size))
    member[np.arange(UNITS), group] = 1
    # then all others among the classes of the core
    unknown = CLASSES + 1
    neighbours = _neighbours(learned, words, core, group[of], size)
    classes = _assigned(neighbours, member.T @ pairs @ member, unknown)
    ranked = classes.filter("rank IS NOT NULL").select("rank", "class").toPandas()
    unit[ranked["rank"].to_numpy(np.int64)] = UNITS + ranked["class"].to_numpy(np.int64)
    classes = classes.filter("rank IS NULL").drop("rank")
    group = np.concatenate([group[:CORE], [CLASSES], np.full(OCTAVES + 1, unknown), np.arange(CLASSES)])
    size = unknown + 1
    of = group[np.concatenate([unit, [TAIL, END]])]
    coded = _packed(_coded(parts, classes, of, count, ends), "lm-coded")
    listed = coded.filter("learn").select("codes", "classes")
    joint = _pairs(listed, lambda batch: (_filled(*x)[0] for x in _sliced(*batch.columns)), CLASSES, size)
    total = joint.sum()
    unigram = (joint.sum(0) + 0.5) / (total + 0.5 * size)
    transition = np.log10((joint + BACKOFF * unigram) / (joint.sum(1, keepdims=True) + BACKOFF))
    mass = np.bincount(of[:-2], count, size)
    kinds = np.bincount(of[:-2], minlength=size).astype(float)
    for own in classes.groupBy("class").agg(F.sum("n").alias("mass"), F.count("*").alias("kinds")).collect():
        mass[own["class"]] += own["mass"]
        kinds[own["class"]] += own["kinds"]
    # one more word stands for all unknown ones
    kinds[unknown] += 1
    mass[group[END]] += ends
    kinds[group[END]] += 1
    in_class = np.log10(np.maximum(mass + 0.5 * kinds, 0.5))
    model = ClassModel(
        counts,
        classes,
        int(words_total) + ends,
        int(words_distinct) + (ends > 0),
        ends,
        words,
        count,
        unit,
        group,
        transition,
        in_class,
    )
    return model, coded


def _path(codes: Column, classes: Column, model: ClassModel) -> Column:
    """The sum of the log10 probabilities of each class after the one before, less the classes' emission denominators."""
    transition, in_class, end = model.transition, model.in_class, int(model.group[END])

    def summed(batches: Iterator[tuple[pa.Array, pa.Array]]) -> Iterator[pa.Array]:
        for every, listed in batches:
            parts = []
            for part, own in _sliced(every, listed):
                found, starts = _filled(part, own)
                before = np.concatenate([[end], found[:-1]])
                parts.append(pa.array(np.add.reduceat(transition[before, found] - in_class[found], starts)))
            yield pa.concat_arrays(parts) if parts else pa.array([], pa.float64())

    summed.__annotations__ = {"batches": Iterator[tuple[pa.Array, pa.Array]], "return": Iterator[pa.Array]}
    return arrow_udf(summed, "double")(codes, classes)


def score(documents: DataFrame, model: ClassModel, text: str = "text") -> DataFrame:
    """row, n_tokens, n_known, base_score, score for every row: log10 probabilities under unigrams and classes.

    ``row`` holds the row's columns but the text, whatever their names. A null or empty text is its end alone. The words
    outside the head are joined with the counts and classes of all words; the rows are numbered and written before.
    """
    of = model.group[np.concatenate([model.unit, [TAIL, END]])]
    parts = _parts(documents, model.words, text, F.lit(False))
    return _rated(_coded(parts, model.classes, of, model.count, model.ends), model)


def _rated(coded: DataFrame, model: ClassModel) -> DataFrame:
    denominator = float(np.log10(model.total + 0.5 * (model.distinct + 1)))
    return coded.select(
        "row",
        "n_tokens",
        "n_known",
        (F.col("logs") - F.col("n_tokens") * denominator).alias("base_score"),
        (_path(F.col("codes"), F.col("classes"), model) + F.col("logs")).alias("score"),
    )


def perplexity(scored: DataFrame) -> DataFrame:
    """``scored`` with the perplexity per token."""
    return scored.withColumn("perplexity", F.pow(F.lit(10.0), -F.col("score") / F.col("n_tokens")))


def scores(documents: DataFrame, folds: int = 5) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score, perplexity; fold 1 is held out."""
    held_out = fold("doc_id", folds) == 1
    model, coded = _train(documents.select("doc_id", "text"), "text", ~held_out)
    found = perplexity(_rated(coded, model))
    return found.select(F.col("row.doc_id").alias("doc_id"), "*").select(
        "doc_id",
        held_out.alias("held_out"),
        "n_tokens",
        "n_known",
        F.lit(model.total).cast("long").alias("train_tokens"),
        "base_score",
        "score",
        "perplexity",
    )
