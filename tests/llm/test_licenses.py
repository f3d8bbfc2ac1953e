"""Licenses are right or silent: words that tell them apart are never taken for one another."""

import pytest

from buildlens.llm import licenses

GPL = "This work is licensed under the GNU General Public License, version 2."
CC = "This work is licensed under a Creative Commons Attribution{} International License."

WRONG_ONCE = {
    "This work is licensed under the GNU General Public License, version 1.": ["GPL-1.0"],
    "This work is licensed under the GNU General Public License, version 4.": [],
    "This library is licensed under the GNU Lesser General Public License, version 2.": [],
    CC.format("-NoDerivatives 4.0"): ["CC-BY-ND-4.0"],
    CC.format("-ShareAlike 4.0"): ["CC-BY-SA-4.0"],
    CC.format(" 3.0"): ["CC-BY-3.0"],
    CC.format(" 5.0"): [],
    GPL.replace("is licensed", "is not licensed"): [],
    GPL.replace("GNU", "Eclipse"): [],
    "This was not released under the MIT License.": [],
    "It was not hard. Released under the MIT License.": ["MIT"],
    "Released under the XYZ License.": [],
    "Released under the MIT Licence.": ["MIT"],
    "Released under CC0 1.0.": ["CC0-1.0"],
    "SPDX-License-Identifier: MIT": ["MIT"],
    "// SPDX-License-Identifier: GPL-2.0-or-later": ["GPL-2.0"],
    f"{GPL} {CC.format('-NonCommercial 4.0')}": ["GPL-2.0", "CC-BY-NC-4.0"],
}


@pytest.mark.parametrize("line", list(WRONG_ONCE))
def test_the_right_license_or_none(line):
    assert [x[0] for x in licenses.Scanner().find(line)] == WRONG_ONCE[line]


def test_every_template_is_found_as_itself():
    scanner = licenses.Scanner()
    for name, text in licenses.ALL:
        for block in (text, f"Some words. {text.upper()}", f"before\n{text}\nafter", text.replace(" ", "\n")):
            found = scanner.find(block)
            assert [(x[0], x[4]) for x in found] == [(name, 0)], block


def plain_differences(template, block):
    """Edit distance to the best place of the block, by the textbook table."""
    above = [0] * (len(block) + 1)
    for i, word in enumerate(template, 1):
        row = [i]
        for j, other in enumerate(block, 1):
            row.append(min(above[j - 1] + (word != other), above[j] + 1, row[j - 1] + 1))
        above = row
    return min(above)


def test_differences_equal_a_plain_alignment():
    words = "a b c".split()
    blocks = [[words[(i * k + i // 3) % 3] for i in range(n)] for n in range(9) for k in (1, 2, 5)]
    for template in blocks:
        for block in blocks:
            cost, first, last = licenses.differences(template, block)
            assert cost == plain_differences(template, block)
            assert template == [] or plain_differences(template, block[first:last]) == cost


def test_own_templates_of_any_length_and_wording():
    long = " ".join(f"clause{'abcdefghij'[i % 10]}{'klmnopqrst'[i // 10 % 10]}{'uvwxyz'[i // 100]}" for i in range(500))
    scanner = licenses.Scanner((("Long", long), ("Short", "Take it, it is yours.")))
    text = f"Intro.\n{long}\nOutro. Take it, it is yours."
    found = scanner.find(text)
    assert [x[0] for x in found] == ["Long", "Short"]
    assert text[found[0][1] : found[0][2]] == long
    assert scanner.find("") == [] and licenses.Scanner(()).find(GPL) == []


def test_small_differences_are_taken_and_reported():
    name, text = licenses.TEMPLATES[3]
    changed = text.replace("free of charge", "free of any charge").replace("a copy", "copies")
    (found,) = licenses.Scanner().find(changed)
    assert found[0] == name and 0 < found[4] <= 4
