"""Whole results where an operator once gave less."""

import base64
import hashlib
import math
import random
from fractions import Fraction

import numpy as np
import pytest

from buildlens.llm import language_id, licenses, secret_scan


def random_strings(seed, n, encoding="base62", size=40, least=0.0, below=1.01):
    """Random strings of an encoding whose p-values lie in a range."""
    rng, out = random.Random(seed), []
    while len(out) < n:
        own = "".join(rng.choice(secret_scan.ALPHABETS[encoding]) for _ in range(size))
        if secret_scan.encoding_of(own) == encoding and least <= secret_scan.p_value(own, encoding) < below:
            out.append(own)
    return out


def masked(spark, strings):
    """How many of the strings are found, each in a text of its own."""
    frame = spark.createDataFrame([(i, f"see {x} end") for i, x in enumerate(strings)], "doc_id long, text string")
    return {strings[r.doc_id] for r in secret_scan.report(frame).collect() if "random" in r.spans}


def test_a_repeated_secret_is_found_everywhere(spark):
    singles, (leaked,) = random_strings(1, 1000), random_strings(2, 1, least=0.28, below=0.32)
    found = masked(spark, singles + [leaked] * 400)
    assert leaked in found and len(found) >= 950


def test_a_lone_secret_is_found_whatever_its_p(spark):
    kinds = [("hex", 40), ("upper_hex", 40), ("base32", 40), ("base62", 40), ("base64", 300), ("base64url", 200)]
    lone = [random_strings(3, 1, kind, size, 0.1, 0.4)[0] for kind, size in kinds[1:]]
    assert masked(spark, lone) == set(lone)
    word = "path2" + "/index/of/the/pages2/and/more/of/it/" * 2
    assert masked(spark, [word, *lone]) == set(lone)


def licenses_of(text):
    return [(name, text[a:b]) for name, a, b, _, _ in licenses.Scanner().find(text)]


def test_all_licenses_of_a_block_are_found():
    mit, cc = "Released under the MIT License.", "This work is licensed under a Creative Commons Attribution 4.0 International License."
    gpl = "This work is licensed under the GNU General Public License, version 2."
    assert licenses_of(f"{mit} {cc}") == [("MIT", mit), ("CC-BY-4.0", cc)]
    assert licenses_of(f"Dual license\n{mit}\n{gpl}") == [("MIT", mit), ("GPL-2.0", gpl)]
    assert licenses_of(f"License: {mit} {mit} {gpl}\n") == [("MIT", mit), ("MIT", mit), ("GPL-2.0", gpl)]
    lines = [(name, line) for name, line in licenses.TEMPLATES if len(line) < 100]
    assert licenses_of("License " + " ".join(line for _, line in lines)) == lines


def test_licenses_in_capitals_and_odd_spaces_are_found():
    for name, line in licenses.TEMPLATES:
        for own in (line.upper(), line.lower(), line.title(), line.replace(" ", " \t ")):
            assert licenses_of(own) == [(name, own)]
            assert licenses_of(f"Some words before it\n{own}\nand others after it") == [(name, own)]


def test_words_are_summed_over_all_pieces_of_the_vocabulary():
    known = language_id.pieces()
    with open(language_id.VOCABULARY, "rb") as file:
        whole = {base64.b64decode(line.split()[0]) for line in file} | {bytes([i]) for i in range(256)}
    assert known.size == len(whole)
    even = language_id.LanguageModel(["a"], known, np.full((known.size, 1), 1e-3))
    for word in (b" international", " правительство".encode(), b" which" * 30):
        # sums over the segmentations of the first bytes, as fractions
        sums = [Fraction(1)]
        for end in range(1, len(word) + 1):
            sums.append(sum(sums[a] for a in range(max(0, end - 33), end) if word[a:end] in whole) * Fraction(1, 1000))
        log = math.log(sums[-1].numerator) - math.log(sums[-1].denominator)
        assert language_id.log_likelihoods([word], even)[0, 0] == pytest.approx(log)
        counts = language_id.expected_counts([word], np.ones(1), np.zeros(1, np.int64), even)
        lengths = np.zeros(known.size)
        for k in range(1, language_id.LONGEST + 1):
            lengths[known.ids[k]] = k
        assert counts[:, 0] @ lengths == pytest.approx(len(word))


def test_a_word_of_a_million_bytes():
    known = language_id.pieces()
    rng = np.random.default_rng(4)
    model = language_id.LanguageModel(["a", "b"], known, rng.random((known.size, 2)) / known.size)
    part, n = "international правительство 政府的工作".encode().replace(b" ", b""), 20_000
    whole = language_id.log_likelihoods([part, part * n], model)
    assert whole[1] / n == pytest.approx(whole[0], rel=0.05)
    counts = language_id.expected_counts([part * 200], np.ones(1), np.zeros(1, np.int64), model)
    lengths = np.zeros(known.size)
    for k in range(1, language_id.LONGEST + 1):
        lengths[known.ids[k]] = k
    assert counts[:, 0] @ lengths == pytest.approx(len(part) * 200)


def test_any_number_of_languages(spark):
    names = [f"l{i:03}" for i in range(300)]
    rows = [(i * 10 + k, f"wort{i} nur{i} hier{i} so{i}", x) for i, x in enumerate(names) for k in range(3)]
    frame = spark.createDataFrame(rows, "doc_id long, text string, lang string").repartition(4)
    assert language_id.fit(frame).languages == names


def test_spans_that_touch_become_one_mark():
    text = "ab\U0001f600 cd " * 3000
    spans = [(0, 2), (2, 4), (3, 6), *[(100 + 10 * k, 105 + 10 * k) for k in range(2000)], (len(text) - 1, len(text))]
    plain, covered = [], set().union(*[range(a, b) for a, b in spans])
    for i, c in enumerate(text):
        plain.append(c if i not in covered else "" if i - 1 in covered else "#")
    assert secret_scan.masked(text, spans, "#") == "".join(plain)


def test_masks_are_the_reported_spans(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir.replace('0.001', '0.01')}/documents.parquet")
    found = {r.doc_id: r.spans for r in secret_scan.report(docs).collect()}
    clean = {r.doc_id: r.text for r in secret_scan.redact(docs).collect()}
    assert any(found.values())
    for r in docs.collect():
        spans = sorted(tuple(map(int, x.split(":")[1:])) for x in found[r.doc_id].split(",") if x)
        assert clean[r.doc_id] == (secret_scan.masked(r.text, spans, "[secret]") if spans else r.text)


def test_a_text_of_many_secrets(spark):
    text = " ".join(f"password = {hashlib.sha256(str(i).encode()).hexdigest()}" for i in range(20_000))
    frame = spark.createDataFrame([(1, text, len(text))], "doc_id long, text string, n_chars long")
    row = secret_scan.redact(frame).first()
    assert row.text.split() == ["[secret]"] * 20_000 and row.n_chars == len(row.text)
