"""License scans by conditional compression.

A block of text, in lower case and with single spaces, is compressed alone and with each license template, written
alike, as raw dictionary. The templates that make it
smaller are its likely licenses; the one whose wording is in the block best, but for a few words, is confirmed. Words that
tell licenses apart (names, variants, versions, denials) must be the template's own, none more or less. Then the rest of the block, before and behind it, is judged anew, until nothing is confirmed.
"""

from __future__ import annotations

import bisect
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import arrow_udf

from buildlens.llm.common import slices

# fixed values: notices and license texts in common use
TEMPLATES = (
    ("MIT", "Released under the MIT License."),
    ("MIT", "Licensed under the MIT License."),
    ("MIT", "This project is licensed under the terms of the MIT license."),
    (
        "MIT",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
        "documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation "
        "the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and "
        "to permit persons to whom the Software is furnished to do so, subject to the following conditions:",
    ),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    (
        "Apache-2.0",
        "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance "
        "with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0",
    ),
    ("GPL-2.0", "This work is licensed under the GNU General Public License, version 2."),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    (
        "GPL-3.0",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public "
        "License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any "
        "later version.",
    ),
    ("LGPL-3.0", "This library is licensed under the GNU Lesser General Public License, version 3."),
    ("AGPL-3.0", "This work is licensed under the GNU Affero General Public License, version 3."),
    (
        "BSD",
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the "
        "following conditions are met:",
    ),
    ("BSD", "Released under the BSD License."),
    (
        "ISC",
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby "
        "granted, provided that the above copyright notice and this permission notice appear in all copies.",
    ),
    (
        "MPL-2.0",
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not "
        "distributed with this file, You can obtain one at https://mozilla.org/MPL/2.0/.",
    ),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("CC-BY-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-NC-4.0", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License."),
    ("CC0-1.0", "Released under CC0 1.0."),
    ("CC0-1.0", "This work is dedicated to the public domain under CC0 1.0 Universal."),
    ("EPL-2.0", "This program and the accompanying materials are made available under the terms of the Eclipse Public License 2.0."),
    ("BSL-1.0", "Distributed under the Boost Software License, Version 1.0."),
    ("BSD-2-Clause", "Released under the BSD 2-Clause License."),
    ("BSD-3-Clause", "Released under the BSD 3-Clause License."),
    (
        "GPL-2.0",
        "This program is free software; you can redistribute it and/or modify it under the terms of the GNU General Public "
        "License as published by the Free Software Foundation; either version 2 of the License, or (at your option) any "
        "later version.",
    ),
    ("Unlicense", "This is free and unencumbered software released into the public domain."),
    ("Proprietary", "All rights reserved. No part of this work may be reproduced without permission."),
)
GNU = (("GPL", "GNU", "1 2 3"), ("LGPL", "GNU Lesser", "2.1 3"), ("AGPL", "GNU Affero", "3"))
CREATIVE = (
    ("BY", "Attribution"),
    ("BY-SA", "Attribution-ShareAlike"),
    ("BY-NC", "Attribution-NonCommercial"),
    ("BY-ND", "Attribution-NoDerivatives"),
    ("BY-NC-SA", "Attribution-NonCommercial-ShareAlike"),
    ("BY-NC-ND", "Attribution-NonCommercial-NoDerivatives"),
)
CREATIVE_VERSIONS = (("2.0", "Generic"), ("3.0", "Unported"), ("4.0", "International"))
IDENTIFIERS = "MIT Apache-2.0 BSD-2-Clause BSD-3-Clause ISC MPL-2.0 EPL-2.0 BSL-1.0 CC0-1.0 Unlicense"
#: Words that tell licenses apart, besides those with a digit.
TELLING = frozenset(
    "mit apache bsd isc gnu gpl lgpl agpl lesser affero general public mozilla mpl eclipse epl boost cc cc0 by sa nc nd "
    "creative commons attribution noncommercial sharealike noderivatives noderivs spdx unlicense clause domain proprietary".split()
)
#: Words that turn a notice into its opposite.
DENIALS = frozenset("not no never neither nor isn't aren't wasn't cannot can't".split())
#: Nearly every template has one of these; those without are found by their rarest telling word.
CUES = r"licen[sc]e|permission|redistribution|public\W+domain|all\W+rights\W+reserved"
# end of fixed values

#: Share of a template's words that may differ; telling words and denials may not.
TOLERANCE = 0.1
#: Words before a notice in which a denial counts, as far as its sentence goes.
BEFORE = 4
_TOKEN = re.compile(r"\S+")
_EDGE = re.compile(r"^\W+|\W+$")


def _notices() -> Iterator[tuple[str, str]]:
    """The templates that differ in name and version alone."""
    for short, name, versions in GNU:
        for version in versions.split():
            whole = version if "." in version else f"{version}.0"
            for kind in ("work", "program", "library"):
                yield f"{short}-{whole}", f"This {kind} is licensed under the {name} General Public License, version {version}."
            yield f"{short}-{whole}", f"SPDX-License-Identifier: {short}-{whole}"
            for clause in ("only", "or-later"):
                yield f"{short}-{whole}", f"SPDX-License-Identifier: {short}-{whole}-{clause}"
    for short, name in CREATIVE:
        for version, kind in CREATIVE_VERSIONS:
            yield f"CC-{short}-{version}", f"Licensed under CC {short} {version}."
            yield f"CC-{short}-{version}", f"This work is licensed under a Creative Commons {name} {version} {kind} License."
            yield f"CC-{short}-{version}", f"SPDX-License-Identifier: CC-{short}-{version}"
    for name in IDENTIFIERS.split():
        yield name, f"SPDX-License-Identifier: {name}"


def tells(word: str) -> bool:
    """Whether a word in plain form may not differ. Addresses may: they are written in many ways."""
    if "://" in word:
        return False
    return word in DENIALS or any(c.isdigit() for c in word) or any(part in TELLING for part in word.split("-"))


def cue_pattern(templates: tuple[tuple[str, str], ...]) -> str:
    """A pattern that every template matches: the common cues, and a word of each template that has none of them."""
    lacking = [text for _, text in templates if not re.search(CUES, text, re.IGNORECASE)]
    words = set()
    for text in lacking:
        own = [x for x in map(plain, text.split()) if x]
        words.add(max([x for x in own if tells(x)] or own or [""], key=len))
    # looked for alone, in the templates' own spelling; a template without any word finds nothing
    return "|".join([CUES, *(r"\b" + re.escape(x) for x in sorted(words) if x)])


def plain(word: str) -> str:
    """A word without case and outer marks, in one of the two spellings of license."""
    return _EDGE.sub("", word).lower().replace("licence", "license")


def normal(words: list[str]) -> str:
    return " ".join(words).lower()


def differences(template: list[str], block: list[str]) -> tuple[int, int, int]:
    """Least number of words to insert, drop or replace to find the template in the block; the first and the last word
    of the place, exclusive. The first of equal places."""
    n = len(block)
    cost, begin = np.zeros(n + 1, np.int64), np.arange(n + 1)
    for word in template:
        match = np.array([word != other for other in block], np.int64)
        replaced, dropped = cost[:-1] + match, cost[1:] + 1
        next_cost, next_begin = np.empty_like(cost), np.empty_like(begin)
        next_cost[0], next_begin[0] = cost[0] + 1, 0
        take = replaced <= dropped
        next_cost[1:], next_begin[1:] = np.where(take, replaced, dropped), np.where(take, begin[:-1], begin[1:])
        # words of the block that the template lacks cost one each
        run = next_cost - np.arange(n + 1)
        best = np.minimum.accumulate(run)
        first = np.maximum.accumulate(np.where(run == best, np.arange(n + 1), 0))
        cost, begin = best + np.arange(n + 1), next_begin[first]
    end = int(cost.argmin())
    return int(cost[end]), int(begin[end]), end


#: All built-in templates; a text that stands there twice counts once.
ALL = tuple(dict.fromkeys((*TEMPLATES, *_notices())))


def denied(text: str, spans: list[tuple[int, int]], first: int) -> bool:
    """Whether the sentence of a notice denies it before it begins."""
    for start, end in spans[max(0, first - BEFORE) : first][::-1]:
        word = text[start:end]
        if word[-1] in ".!?;:":
            return False
        if plain(word).replace("\u2019", "'") in DENIALS:
            return True
    return False


class Scanner:
    """Finds licenses in texts; remembers equal blocks."""

    def __init__(self, templates: tuple[tuple[str, str], ...] = ALL) -> None:
        self.names = [name for name, _ in templates]
        self.words = [[plain(x) for x in text.split()] for _, text in templates]
        self.telling = [[x for x in own if tells(x)] for own in self.words]
        # words taken before and after a cue: as many as the longest template can have in a text
        self.reach = max([100, *(int(len(own) * (1 + TOLERANCE)) + 1 for own in self.words)])
        settings = {"level": 3, "write_content_size": False, "write_checksum": False}
        self.alone = zstandard.ZstdCompressor(**settings)
        self.given = [
            zstandard.ZstdCompressor(
                dict_data=zstandard.ZstdCompressionDict(
                    normal(text.split()).encode(), dict_type=zstandard.DICT_TYPE_RAWCONTENT
                ),
                **settings,
            )
            for _, text in templates
        ]
        self.cue = re.compile(cue_pattern(templates), re.IGNORECASE)
        self.known: dict[str, list] = {}

    def gains(self, block: str) -> np.ndarray:
        """Bytes that each template saves of a block in normal form."""
        data = block.encode()
        size = len(self.alone.compress(data))
        return np.array([size - len(x.compress(data)) for x in self.given])

    def judge(self, block: str, words: list[str]) -> tuple[int, int, int, int, int] | None:
        """template, gain, differences, first and last word of the license that the block holds; of those confirmed,
        the one with the largest share of words in place, then the longest."""
        gains, confirmed, held = self.gains(block), [], set(words)
        for k in np.flatnonzero(gains > 0).tolist():
            own = self.words[k]
            # a word that the block lacks is a difference wherever the template is put; a telling one may not be lacking
            if any(word not in held for word in self.telling[k]):
                continue
            if sum(word not in held for word in own) > TOLERANCE * len(own):
                continue
            wrong, first, last = differences(own, words)
            # the words that tell licenses apart are the template's, in its order, and none is added
            if wrong <= TOLERANCE * len(own) and [x for x in words[first:last] if tells(x)] == self.telling[k]:
                confirmed.append((wrong / len(own), -len(own), -int(gains[k]), k, wrong, first, last))
        if not confirmed:
            return None
        _, _, less, k, wrong, first, last = min(confirmed)
        return k, -less, wrong, first, last

    def judged(self, text: str, spans: list[tuple[int, int]], a: int, b: int) -> tuple[int, int, int, int, int] | None:
        """``judge`` of the words a to b of a text, whose words count from its start."""
        words = [text[start:end] for start, end in spans[a:b]]
        block = normal(words)
        if block not in self.known:
            if len(self.known) > 20_000:
                self.known.clear()
            self.known[block] = self.judge(block, [plain(x) for x in words])
        if not (found := self.known[block]):
            return None
        return *found[:3], a + found[3], a + found[4]

    def search(
        self, text: str, spans: list[tuple[int, int]], a: int, b: int, left: int, right: int
    ) -> list[tuple[int, int, int, int, int]]:
        """template, gain, differences, first and last word of every license in the words a to b; each is looked for in
        what those found before it leave free. One with differences that the block may have cut is judged again with the
        words before and behind it, from left to right at most."""
        out, free = [], [(a, b, left, right)]
        while free:
            a, b, left, right = free.pop()
            if a >= b or not (found := self.judged(text, spans, a, b)):
                continue
            k, _, wrong, first, last = found
            if wrong and (first == a > left or last == b < right):
                size = len(self.words[k])
                found = self.judged(text, spans, max(left, first - size), min(right, last + size)) or found
                first, last = found[3:]
            out.append(found)
            free += [(a, first, left, first), (last, b, last, right)]
        return out

    def find(self, text: str) -> list[tuple[str, int, int, int, int]]:
        """(license, start, end, gain, differences) by place; places count code points, ends are exclusive.

        A block is a line, or the words about a cue if the line has more, as far as no license was found in it yet. A
        license over several lines is looked for in the words about each cue that is in none so far.
        """
        out: list[tuple[str, int, int, int, int]] = []
        taken: list[tuple[int, int]] = []
        spans = None
        for cue in self.cue.finditer(text):
            if spans is None:
                spans = [m.span() for m in _TOKEN.finditer(text)]
                starts = np.array([a for a, _ in spans])
            at = int(np.searchsorted(starts, cue.start(), "right")) - 1
            line = (text.rfind("\n", 0, cue.start()) + 1, (text.find("\n", cue.end()) + 1 or len(text) + 1) - 1)
            low, high = (int(x) for x in np.searchsorted(starts, line))
            for a, b in ((low, high), (0, len(spans))):
                near = bisect.bisect(taken, (at, len(spans)))
                left = taken[near - 1][1] if near else 0
                right = taken[near][0] if near < len(taken) else len(spans)
                if left > at:
                    break
                a, b = max(a, left, at - self.reach), min(b, right, at + self.reach)
                for k, gain, wrong, first, last in self.search(text, spans, a, b, left, right):
                    bisect.insort(taken, (first, last))
                    if not denied(text, spans, first):
                        out.append((self.names[k], spans[first][0], spans[last - 1][1], gain, wrong))
        return sorted(out, key=lambda x: x[1])


def scan(text: Column, templates: tuple[tuple[str, str], ...] = ALL) -> Column:
    """``array<struct<license, start, end, gain, differences>>`` of a text column; empty for null and empty texts."""
    kind = pa.list_(
        pa.struct(
            [(x, pa.string() if x == "license" else pa.int64()) for x in ("license", "start", "end", "gain", "differences")]
        )
    )

    def scanned(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        scanner = Scanner(templates)
        pattern = f"(?i){cue_pattern(templates)}"
        names = [x.name for x in kind.value_type]
        for texts in (part for batch in batches for part in slices(batch)):
            out: list[list[dict]] = [[] for _ in range(len(texts))]
            cued = pc.match_substring_regex(texts, pattern).to_numpy(zero_copy_only=False)
            for i in np.flatnonzero(cued).tolist():
                out[i] = [dict(zip(names, x)) for x in scanner.find(texts[i].as_py())]
            yield pa.array(out, kind)

    scanned.__annotations__ = {"batches": Iterator[pa.Array], "return": Iterator[pa.Array]}
    return arrow_udf(
        scanned, "array<struct<license string, start long, end long, gain long, differences long>>"
    )(text)


def found(documents: DataFrame) -> DataFrame:
    """doc_id, license, start, end, gain, differences: a row for each license found in a text, whole texts read.

    Rows with a null or empty text give none; equal rows give equal results; an empty table an empty one.
    """
    return documents.select("doc_id", F.explode(scan(F.col("text"))).alias("found")).select("doc_id", "found.*")
