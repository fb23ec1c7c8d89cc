import random
import textwrap
import time

import pytest
import zstandard

from tests.llm.helpers import ODD, documents
from tillbook.llm import licenses


@pytest.fixture(scope="module")
def loaded():
    return licenses.Templates(licenses.TEMPLATES)


def test_every_template_finds_itself(loaded):
    for name, text in licenses.TEMPLATES:
        said = loaded.look(f"{text}")
        assert (said["license"], said["exact"], said["confirmed"], said["missing"], said["added"]) == (name, True, True, [], [])


@pytest.mark.parametrize(
    ("block", "license", "confirmed", "missing"),
    [
        ("LICENSED under the apache licence, version 2.0", "Apache-2.0", True, ["license"]),
        ("This work is licensed under the GNU General Public License, version 9.", "GPL-2.0", False, ["2"]),
        ("/* All rights reserved. */", "All-Rights-Reserved", True, []),
        ("we got a license to drive last year", None, False, None),
    ],
)
def test_wording(loaded, block, license, confirmed, missing):
    said = loaded.look(block)
    assert said["confirmed"] == confirmed
    if license:
        assert said["license"] == license and said["missing"] == missing


def test_reduction_is_what_zstandard_says(loaded):
    text = licenses.TEMPLATES[3][1]
    own = zstandard.ZstdCompressor(level=licenses.LEVEL, write_content_size=False, dict_data=zstandard.ZstdCompressionDict(text.encode(), dict_type=zstandard.DICT_TYPE_RAWCONTENT))
    alone = zstandard.ZstdCompressor(level=licenses.LEVEL, write_content_size=False)
    assert loaded.reductions(text)[3] == 1 - len(own.compress(text.encode())) / len(alone.compress(text.encode()))
    assert max(loaded.reductions(text)) == loaded.reductions(text)[3]


def test_fit_against_every_stretch():
    rng = random.Random(0)

    def distance(a, b):
        row = list(range(len(b) + 1))
        for i, x in enumerate(a, 1):
            new = [i]
            for j, y in enumerate(b, 1):
                new.append(min(row[j] + 1, new[-1] + 1, row[j - 1] + (x != y)))
            row = new
        return row[-1]

    for _ in range(150):
        template = [rng.choice("abc") for _ in range(rng.randint(1, 6))]
        text = [rng.choice("abcd") for _ in range(rng.randint(0, 9))]
        edits, begin, end = licenses.fit(template, text)
        assert edits == min(distance(template, text[a:b]) for a in range(len(text) + 1) for b in range(a, len(text) + 1))
        assert distance(template, text[begin:end]) == edits


def test_blocks_of_lines():
    text = "a\nThis project is licensed\nunder the terms\nof the MIT license.\nfoo\n\nAll rights reserved.\nCopyright x"
    assert licenses.blocks(text) == [(1, 3), (6, 6), (7, 7)]


def test_scan(spark):
    rows = ODD + [(20, "x\nReleased under the MIT License.\ny"), (20, "x\nReleased under the MIT License.\ny"), (None, "This project is licensed\nunder the terms\nof the MIT license."), (21, "word " * 30000 + "copyright")]
    got = sorted((str(r.doc_id), r.first_line, r.n_lines, str(r.license), r.confirmed) for r in licenses.scan(documents(spark, rows)).collect())
    assert [g for g in got if g[4]] == [("20", 1, 1, "MIT", True), ("20", 1, 1, "MIT", True), ("None", 0, 3, "MIT", True)]
    assert [g[0] for g in got if not g[4]] == ["21"]
    assert licenses.scan(documents(spark, [])).count() == 0


def test_planted_lines_of_the_given_tables(spark):
    path = "/root/testdata/sf0.01"
    wanted = {"Licensed under CC BY-NC 4.0.": "CC-BY-NC-4.0", "Released under the MIT License.": "MIT", "All rights reserved.": "All-Rights-Reserved"}
    docs = spark.read.parquet(f"{path}/documents.parquet").collect()
    expected = sorted((r.doc_id, n, wanted[line]) for r in docs for n, line in enumerate((r.text or "").split("\n")) if line in wanted)
    got = sorted((r.doc_id, r.first_line, r.license) for r in licenses.op9_licenses(spark, path).where("exact").collect() if r.license in wanted.values())
    assert got == expected


@pytest.mark.parametrize("width", [40, 60, 66, 72, 80])
@pytest.mark.parametrize("mark", ["", " * ", "# "])
def test_every_wrapped_template_finds_itself(loaded, width, mark):
    for name, text in licenses.TEMPLATES:
        notice = textwrap.wrap(text, width, break_long_words=False, break_on_hyphens=False)
        lines = ["int x = 1;", "some words of the file", *(mark + line for line in notice), mark, "other words follow here"]
        got = [(a, b, said["exact"], said["confirmed"]) for a, b, said in loaded.scan("\n".join(lines)) if said["license"] == name]
        assert got == [(2, len(notice) + 1, True, True)], (name, text)


def test_wrapped_notices_over_blank_lines(spark):
    apache = 'Licensed under the Apache License, Version 2.0 (the "License");\nyou may not use this file except in compliance with the License.\nYou may obtain a copy of the License at\n\n    http://www.apache.org/licenses/LICENSE-2.0\n'
    bsd = "Copyright 2020 A. All rights reserved. Redistribution and use in\nsource and binary forms, with or without modification, are\npermitted provided that these conditions are met:"
    gpl = "This work is licensed\nunder the GNU General Public\nLicense, version 9."
    rows = [(1, apache), (2, bsd), (3, gpl), (4, "free and unencumbered software released into the public\n# domain")]
    got = {(r.doc_id, r.first_line, r.n_lines, r.license, r.n_changes) for r in licenses.scan(documents(spark, rows)).where("confirmed").collect()}
    assert got == {(1, 0, 5, "Apache-2.0", 0), (2, 0, 1, "All-Rights-Reserved", 0), (2, 0, 3, "BSD", 2), (4, 0, 2, "Unlicense", 2)}


def verdicts(loaded, text):
    return [(a, b, said["license"]) for a, b, said in loaded.scan(text) if said["confirmed"]]


@pytest.mark.parametrize(
    "text",
    [
        "This project is not licensed under the terms of the MIT license.",
        "This file is not\nlicensed under CC BY 4.0.",
        "It was never released under the MIT License.",
        "It isn't licensed under the Apache License, Version 2.0.",
        "Permission is not hereby granted, free of charge, to any person.",
        "Not all rights reserved.",
    ],
)
def test_a_negated_notice_is_not_confirmed(loaded, text):
    assert verdicts(loaded, text) == []


@pytest.mark.parametrize("text", ["This is not mine. Released under the MIT License.", "It is not.\nReleased under the MIT License.", "not\n\nReleased under the MIT License."])
def test_a_negation_in_another_sentence_does_not_count(loaded, text):
    assert [v[2] for v in verdicts(loaded, text)] == ["MIT"]


def test_licenses_of_one_family_are_told_apart(loaded):
    whole = {name: text for name, text in licenses.TEMPLATES}  # the longest of each family comes last
    for two, three in (("BSD-2-Clause", "BSD-3-Clause"), ("0BSD", "ISC"), ("GPL-2.0-or-later", "GPL-3.0-or-later"), ("LGPL-3.0-or-later", "AGPL-3.0-or-later"), ("CC-BY-4.0", "CC-BY-SA-4.0"), ("CC-BY-NC-4.0", "CC-BY-NC-SA-4.0")):
        for name in (two, three):
            for width in (60, 500, 5000):
                text = "\n".join(textwrap.wrap(whole[name], width, break_on_hyphens=False))
                assert [v[2] for v in verdicts(loaded, text)] == [name], (name, width)
    renamed = whole["BSD-3-Clause"].replace("the copyright holder nor", "Example University nor").replace("COPYRIGHT HOLDERS", "REGENTS")
    assert {v[2] for v in verdicts(loaded, "\n".join(textwrap.wrap(renamed, 70)))} == {"BSD-3-Clause"}
    dropped = whole["BSD-3-Clause"].replace(" to endorse or promote products", "")
    assert "BSD-3-Clause" not in {v[2] for v in verdicts(loaded, "\n".join(textwrap.wrap(dropped, 70)))}


@pytest.mark.parametrize(
    ("text", "license"),
    [
        ("This work is licensed under the GNU General Public License, version 2.", "GPL-2.0"),
        ("This work is licensed under the GNU General Public License, version 2 or later.", "GPL-2.0-or-later"),
        ("This work is licensed under the GNU General Public License, version 2\nor any later version.", "GPL-2.0-or-later"),
    ],
)
def test_only_and_or_later(loaded, text, license):
    assert {v[2] for v in verdicts(loaded, text)} <= {license}


def test_cost_grows_with_the_text(loaded):
    text = "\n".join(["a line of other words that says nothing of it."] * 3 + ["copyright held by somebody else, 1999"]) + "\n"
    loaded.scan(text * 10)

    def seconds(n):
        begin = time.perf_counter()
        loaded.scan(text * n)
        return time.perf_counter() - begin

    short = min(seconds(100) for _ in range(3))
    assert min(seconds(800) for _ in range(2)) < 24 * short  # 8 in proportion, 64 if quadratic


def test_query_against_plain_scan_of_every_text(spark):
    path = "/root/testdata/sf0.01"
    loaded = licenses.Templates(licenses.TEMPLATES)
    expected = sorted((r.doc_id, n, a, b - a + 1, str(said["license"]), said["confirmed"]) for r in spark.read.parquet(f"{path}/documents.parquet").collect() for n, (a, b, said) in enumerate(loaded.scan(r.text or "")))
    got = sorted((r.doc_id, r.block, r.first_line, r.n_lines, str(r.license), r.confirmed) for r in licenses.op9_licenses(spark, path).collect())
    assert got == expected
