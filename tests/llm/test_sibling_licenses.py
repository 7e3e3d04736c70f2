"""Licences that differ in a word or a number are told apart, or not named."""

from __future__ import annotations

import pytest

from tabsmith.llm import license_scan

SCANNER = license_scan.Scanner(license_scan.TEMPLATES, license_scan.COVERAGE)
AROUND = "The hills were green and the road went on for many miles without a house. "


def named(text):
    return {hit[0] for hit in SCANNER.scan(AROUND + text + " " + AROUND)}


GNU = "This program is free software: you can redistribute it and/or modify it under the terms of the GNU {}General Public License as published by the Free Software Foundation, either version 3 of the License, or any later version."


@pytest.mark.parametrize(
    "text,want",
    [
        ("Released under the MIT License.", {"MIT"}),
        ("Released under the BSD License.", {"BSD-line"}),
        ("Released under the XYZ License.", set()),
        ("This work is licensed under the GNU General Public License, version 3.", {"GPL-3.0"}),
        ("This work is licensed under the GNU General Public License, version 2.", {"GPL-2.0"}),
        ("This work is licensed under the GNU General Public License, version 1.", set()),
        ("This work is licensed under the GNU Lesser General Public License, version 2.1.", {"LGPL-2.1"}),
        ("This work is licensed under the GNU Affero General Public License, version 3.0.", {"AGPL-3.0"}),
        (GNU.format(""), {"GPL-header"}),
        (GNU.format("Lesser "), {"LGPL-header"}),
        (GNU.format("Affero "), {"AGPL-header"}),
        (GNU.format("Library "), set()),
        ("Licensed under the Apache License, Version 2.0.", {"Apache-2.0"}),
        ("Licensed under the Apache License, Version 1.1.", {"Apache-1.1"}),
        ("Licensed under the Apache License, Version 1.0.", set()),
        ("Licensed under CC BY 4.0.", {"CC-BY-4.0-short"}),
        ("Licensed under CC BY-ND 4.0.", {"CC-BY-ND-4.0"}),
        ("Licensed under CC BY-NC 4.0.", {"CC-BY-NC-4.0"}),
        ("Licensed under CC BY-NC-SA 4.0.", {"CC-BY-NC-SA-4.0"}),
        ("This work is licensed under a Creative Commons Attribution 4.0 International License.", {"CC-BY-4.0"}),
        ("This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.", {"CC-BY-SA-4.0-long"}),
        ("This work is licensed under a Creative Commons Attribution-NonCommercial-NoDerivatives 4.0 International License.", {"CC-BY-NC-ND-4.0-long"}),
        ("This work is licensed under a Creative Commons Attribution 2.5 International License.", set()),
    ],
)
def test_siblings(text, want):
    assert named(text) == want


@pytest.mark.parametrize("name", ["MIT-full", "BSD-2-Clause", "BSD-3-Clause", "ISC-full", "Apache-2.0-full-header"])
def test_full_notices_win_over_their_parts(name):
    text = license_scan.TEMPLATES[name]
    assert named(text) == {name}
    assert name in named(text.replace(" software ", " program ").replace("copyright holders", "holders"))


def test_scattered_words_are_no_notice():
    words = license_scan.TEMPLATES["MIT"].split()
    assert named(" on and on ".join(words)) == set()
    assert license_scan.trim([(0, 0), (1, 9), (2, 10), (3, 11), (4, 30)], 0.8) == [(1, 9), (2, 10), (3, 11)]


def test_every_template_names_itself():
    for name, text in license_scan.TEMPLATES.items():
        same = {n for n, t in license_scan.TEMPLATES.items() if license_scan.words_of(t) == license_scan.words_of(text)}
        assert named(text) & same, name
