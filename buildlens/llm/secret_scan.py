"""Secret scans: fixed patterns, and strings that a battery of randomness tests takes for random.

A candidate is a long run of encoding characters. Its encoding is inferred from its characters; then three tests ask
whether it could be uniform noise in that encoding: chi-squared over the alphabet, the number of runs above and below
the alphabet's middle, and the correlation of neighbours. Fisher's method joins their p-values. Random strings have
uniform p-values, all others have small ones; so the count of high p-values tells how many candidates of an encoding and
length range are random, and the lowest threshold is taken above which the share of other strings stays under a rate.
The rate is stricter for short strings, whose tests have little power.
"""

from __future__ import annotations

import bisect
import hashlib
import math
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import arrow_udf

from buildlens.llm.common import raw, slices, tidied

# fixed values: the patterns of the known kinds, in the order in which spans at one place are listed
KINDS = ("assign", "access", "hex")
ASSIGN = re.compile(
    r"""((?ai:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]+")
LEAST = {"assign": 6, "access": 20, "hex": 24}
# end of fixed values

#: A text without any of these, in lower case, holds no assignment.
_WORDS = ("password", "passwd", "secret", "token", "apikey", "api_key")
#: Candidates of the randomness tests: alphabets by encoding, the first that holds all characters is inferred.
ALPHABETS = {
    "hex": "0123456789abcdef",
    "upper_hex": "0123456789ABCDEF",
    "base32": "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567",
    "base36": "0123456789abcdefghijklmnopqrstuvwxyz",
    "base62": "0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz",
    "base64": "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/",
    "base64url": "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789-_",
}
RUN = 20
CANDIDATE = re.compile(r"[A-Za-z0-9+/_-]{%d,}" % RUN)
#: p-values are counted in so many bins for each encoding and doubling of the length.
BINS = 50
#: Share of other strings allowed among the found ones of 32 characters or more; less for shorter ones.
RATE = 0.05
#: Bins of low p-values that are taken only where the candidates themselves tell the noise.
LOW = 2

_ENCODING = np.zeros(256, bool)
_ENCODING[np.frombuffer(b"ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_-", np.uint8)] = True


def known_spans(text: str) -> list[tuple[int, int, str]]:
    """(start, end, kind) of the fixed patterns, by start, then by kind as listed."""
    spans = []
    low = text.lower()
    if any(x in low for x in _WORDS):
        spans += [
            (*m.span(), "assign") for m in ASSIGN.finditer(text) if m.end(2) - m.start(2) >= LEAST["assign"]
        ]
    if "AKIA" in text:
        spans += [(*m.span(), "access") for m in ACCESS.finditer(text) if m.end() - m.start() >= LEAST["access"]]
    spans += [(*m.span(), "hex") for m in HEX.finditer(text) if m.end() - m.start() >= LEAST["hex"]]
    return sorted(spans, key=lambda x: (x[0], KINDS.index(x[2])))


def encoding_of(run: str) -> str | None:
    """The first alphabet that holds the run and of which it uses each kind of character; None if it is no code.

    A run without a digit or without a letter, such as a long word, number or ruler, is no code. One of mixed case must
    hold both cases and digits.
    """
    if not (re.search("[0-9]", run) and re.search("[A-Za-z]", run)):
        return None
    held = set(run)
    return next((name for name, alphabet in ALPHABETS.items() if held <= set(alphabet)), None)


def p_value(run: str, encoding: str) -> float:
    """Fisher's joint p-value of the three tests: near 0 if the run is not uniform noise in its encoding."""
    alphabet = ALPHABETS[encoding]
    size, n = len(alphabet), len(run)
    at = np.array([alphabet.index(x) for x in run], float)
    counts = np.bincount(at.astype(int), minlength=size)
    statistic = ((counts - n / size) ** 2).sum() * size / n
    tests = [_chi_squared_tail(statistic, size - 1)]
    high = at >= size / 2
    ones, runs = int(high.sum()), 1 + int((high[1:] != high[:-1]).sum())
    expected = 1 + 2 * ones * (n - ones) / n
    spread = (expected - 1) * (expected - 2) / (n - 1)
    tests.append(math.erfc(abs(runs - expected) / math.sqrt(2 * spread)) if spread > 0 else 2.0 ** (1 - n))
    centred = at - (size - 1) / 2
    correlation = (centred[1:] * centred[:-1]).sum() / ((size * size - 1) / 12)
    tests.append(math.erfc(abs(correlation) / math.sqrt(2 * (n - 1))))
    joint = -2 * sum(math.log(max(p, 1e-300)) for p in tests)
    half = joint / 2
    return min(1.0, math.exp(-half) * sum(half**k / math.factorial(k) for k in range(len(tests))))


def _chi_squared_tail(statistic: float, degrees: int) -> float:
    """Wilson and Hilferty's normal approximation."""
    spread = 2 / (9 * degrees)
    return 0.5 * math.erfc(((statistic / degrees) ** (1 / 3) - 1 + spread) / math.sqrt(2 * spread))


def key_of(run: str) -> int:
    return int.from_bytes(hashlib.blake2b(run.encode(), digest_size=8).digest(), "big", signed=True)


def length_range(n: int) -> int:
    return min(n.bit_length(), 12)


def scan(text: Column) -> Column:
    """``struct<known array<struct<start, end, kind>>, runs array<struct<start, end, encoding, p, key>>>`` of a text column.

    Places count code points, ends are exclusive. A null text is empty. Runs are the candidates of the tests; ``key`` is
    a 64-bit hash of the run.
    """
    span = pa.struct([("start", pa.int32()), ("end", pa.int32()), ("kind", pa.string())])
    run = pa.struct(
        [("start", pa.int32()), ("end", pa.int32()), ("encoding", pa.string()), ("p", pa.float64()), ("key", pa.int64())]
    )

    def scanned(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            known: list[list] = []
            runs: list[list] = []
            for texts in slices(batch):
                base = len(known)
                known += [[] for _ in range(len(texts))]
                runs += [[] for _ in range(len(texts))]
                for i in _worth_reading(texts):
                    whole = texts[i].as_py()
                    known[base + i] = known_spans(whole)
                    for m in CANDIDATE.finditer(whole):
                        if encoding := encoding_of(m.group()):
                            p = p_value(m.group(), encoding)
                            runs[base + i].append((*m.span(), encoding, p, key_of(m.group())))
            yield pa.StructArray.from_arrays(
                [_lists(known, span), _lists(runs, run)], ["known", "runs"]
            )

    scanned.__annotations__ = {"batches": Iterator[pa.Array], "return": Iterator[pa.Array]}
    return arrow_udf(
        scanned,
        "struct<known array<struct<start int, end int, kind string>>,"
        " runs array<struct<start int, end int, encoding string, p double, key long>>>",
    )(text)


def _lists(values: list[list[tuple]], kind: pa.StructType) -> pa.Array:
    offsets = np.cumsum([0] + [len(x) for x in values]).astype(np.int32)
    flat = [dict(zip(kind.names, x)) for y in values for x in y]
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat, kind))


def _worth_reading(texts: pa.Array) -> list[int]:
    """Places of the texts that may hold a span: those with a word of an assignment, or a long run.

    The runs are found in the bytes of all texts at once; one that crosses from a text to the next marks both.
    """
    keyed = pc.match_substring_regex(texts, "(?i)passw(?:or)?d|secret|token|api_?key|AKIA").to_numpy(zero_copy_only=False)
    data, offsets = raw(texts)
    breaks = np.flatnonzero(~_ENCODING[data])
    starts, ends = np.concatenate([[0], breaks + 1]), np.concatenate([breaks, [len(data)]])
    long = ends - starts >= RUN
    first = np.searchsorted(offsets, starts[long], "right") - 1
    last = np.searchsorted(offsets, ends[long] - 1, "right") - 1
    marked = keyed.astype(bool)
    for a, b in zip(first.tolist(), last.tolist()):
        marked[a : b + 1] = True
    return np.flatnonzero(marked).tolist()


def thresholds(runs: DataFrame) -> dict[tuple[str, int], float]:
    """The least p-value taken for a secret, by encoding and range of lengths; from all candidates
    (encoding, n, p, key).

    A string counts once, however often it occurs: copies of one would pile up in its bin. Spark counts the strings in
    bins, which are few however many candidates there are. Noise fills the upper half of the bins
    evenly, so twice that half tells the noise; what is found beyond it is other strings. The threshold is the lowest
    bin, going down from the middle, from which on other strings are at most the allowed share of what is found.
    """
    size = F.least(F.length(F.bin("n")), F.lit(12))
    bins = F.least(F.floor(F.col("p") * BINS), F.lit(BINS - 1))
    strings = runs.select("encoding", size.alias("size"), bins.alias("bin"), "key").distinct()
    counted = strings.groupBy("encoding", "size", "bin").count().collect()
    by_kind: dict[tuple[str, int], np.ndarray] = {}
    for row in counted:
        by_kind.setdefault((row["encoding"], row["size"]), np.zeros(BINS))[row["bin"]] = row["count"]
    return {kind: threshold(counts, kind[1]) for kind, counts in by_kind.items()}


def threshold(counts: np.ndarray, size: int) -> float:
    """The threshold of one range, from the counts of its bins.

    To the counts comes one noise string a bin. So a few candidates, which tell nothing of the noise, are taken down to
    a low p-value of ``LOW`` bins, and with more of them their own counts prevail.
    """
    allowed = RATE * min(1.0, 2.0 ** (size - 6))
    own = 2 * counts[BINS // 2 :].sum() / BINS
    noise = own + 1
    found = (counts + 1)[::-1].cumsum()[::-1]
    # what is found beyond the noise, but for a standard deviation of the count
    other = found - noise * np.arange(BINS, 0, -1) - np.sqrt(found)
    good = other <= allowed * found
    lowest, least = BINS // 2, 0 if own >= 1 else LOW
    while lowest > least and good[lowest - 1]:
        lowest -= 1
    return lowest / BINS


def _least(documents: DataFrame, text: str) -> dict[tuple[str, int], float]:
    runs = documents.select(F.explode(scan(F.col(text))["runs"]).alias("r"))
    return thresholds(runs.select("r.encoding", (F.col("r.end") - F.col("r.start")).cast("long").alias("n"), "r.p", "r.key"))


def find(documents: DataFrame, text: str = "text") -> DataFrame:
    """known, random, row for every row: its spans of the fixed patterns, and those that the tests add.

    ``row`` holds the row's columns, whatever their names. A run that overlaps a known span is not added again. Nulls
    and empty texts have no spans; equal texts have equal spans; an empty table gives an empty result. The texts are
    scanned twice, as the thresholds need all candidates before any is judged: the first time only hashes of candidates,
    each once, leave a task.
    """
    least = _least(documents, text)
    scanned = documents.select(F.struct(*documents.columns).alias("row"), scan(F.col(text)).alias("s"))

    def taken(run: Column) -> Column:
        n = F.least(F.length(F.bin((run["end"] - run["start"]).cast("long"))), F.lit(12))
        bar = F.lit(2.0)
        for (encoding, size), value in least.items():
            bar = F.when((run["encoding"] == encoding) & (n == size), value).otherwise(bar)
        clear = ~F.exists(F.col("s.known"), lambda k: (k["start"] < run["end"]) & (run["start"] < k["end"]))
        return (run["p"] >= bar) & clear

    return scanned.select(
        F.col("s.known").alias("known"),
        F.transform(
            F.filter("s.runs", taken),
            lambda r: F.struct(r["start"].alias("start"), r["end"].alias("end"), F.lit("random").alias("kind")),
        ).alias("random"),
        "row",
    )


def listed(spans: Column) -> Column:
    """``kind:start:end`` of each span, joined by commas."""
    return F.array_join(F.transform(spans, lambda x: F.concat_ws(":", x["kind"], x["start"], x["end"])), ",")


def report(documents: DataFrame) -> DataFrame:
    """doc_id, n_assign, n_access, n_hex, base_sha256, spans of every row of ``documents``."""
    found = find(documents.select("doc_id", "text"))

    def count(kind: str) -> Column:
        return F.size(F.filter("known", lambda x: x["kind"] == kind)).cast("long").alias(f"n_{kind}")

    order = F.array(*[F.lit(x) for x in (*KINDS, "random")])
    ranked = F.transform(
        F.concat("known", "random"),
        lambda x: F.struct(x["start"], F.array_position(order, x["kind"]).alias("rank"), x["end"], x["kind"]),
    )
    return found.select(
        "row.doc_id",
        *map(count, KINDS),
        F.sha2(F.encode(listed(F.col("known")), "UTF-8"), 256).alias("base_sha256"),
        listed(F.array_sort(ranked)).alias("spans"),
    )


def masked(text: str, spans: list[tuple[int, int]], mark: str) -> str:
    """The text with ``mark`` in the place of spans that are in order; one pass, however many there are."""
    parts, at = [], 0
    for start, end in spans:
        if start > at or not at:
            parts += [text[at:start], mark]
        at = max(at, end)
    return "".join([*parts, text[at:]])


def _mask(text: Column, least: dict[tuple[str, int], float], mark: str) -> Column:
    """``struct<clean, n>``: texts with spans after masking, and their length; null for others."""

    def clean(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for texts in (part for batch in batches for part in slices(batch)):
            out: list[str | None] = [None] * len(texts)
            for i in _worth_reading(texts):
                whole = texts[i].as_py()
                spans = [x[:2] for x in known_spans(whole)]
                known = _apart(spans)
                for m in CANDIDATE.finditer(whole):
                    if not (encoding := encoding_of(m.group())):
                        continue
                    bar = least.get((encoding, length_range(len(m.group()))), 2.0)
                    if p_value(m.group(), encoding) >= bar and not _meets(known, *m.span()):
                        spans.append(m.span())
                if spans:
                    out[i] = masked(whole, sorted(spans), mark)
            sizes = pa.array([x if x is None else len(x) for x in out], pa.int64())
            yield pa.StructArray.from_arrays([pa.array(out, pa.string()), sizes], ["clean", "n"])

    clean = tidied(clean)
    clean.__annotations__ = {"batches": Iterator[pa.Array], "return": Iterator[pa.Array]}
    return arrow_udf(clean, "struct<clean string, n long>")(text)


def _apart(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """What the spans cover, as spans in order that do not overlap."""
    out: list[tuple[int, int]] = []
    for start, end in sorted(spans):
        if out and start < out[-1][1]:
            out[-1] = (out[-1][0], max(end, out[-1][1]))
        else:
            out.append((start, end))
    return out


def _meets(covered: list[tuple[int, int]], start: int, end: int) -> bool:
    at = bisect.bisect_left(covered, (end,))
    return at > 0 and covered[at - 1][1] > start


def redact(documents: DataFrame, text: str = "text", mark: str = "[secret]", size: str = "n_chars") -> DataFrame:
    """``documents`` with each secret replaced by ``mark``; spans that touch or overlap become one mark.

    A column named ``size``, if there is one, gets the new length of changed texts. All rows stay.
    """
    found = documents.select(F.struct(*documents.columns).alias("row"))
    found = found.withColumn("new", _mask(F.col(f"row.{text}"), _least(documents, text), mark))
    row = F.col("row").withField(text, F.coalesce("new.clean", f"row.{text}"))
    if size in documents.columns:
        row = row.withField(size, F.coalesce(F.col("new.n").cast(documents.schema[size].dataType), F.col(f"row.{size}")))
    return found.select(row.alias("row")).select("row.*")
