import random
import re

import pytest

from florapipe.llm.license_scan import FILLER, TEMPLATES, Scanner, changes, scan_licenses

LINES = {r"Licensed under CC BY-NC \d(?:\.\d)?": "CC-BY-NC", r"This work is licensed under the GNU General Public License, version \d": "GPL",
         r"Licensed under the Apache License, Version \d(?:\.\d)?": "Apache-2.0", r"Released under the MIT License": "MIT"}


def test_finds_the_lines_of_a_table(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    want = sorted((r["doc_id"], m.start(), name) for r in docs.collect() for p, name in LINES.items() for m in re.finditer(p, r["text"]))
    found = scan_licenses(docs).collect()
    assert want and sorted((r["doc_id"], r["start"], r["license"]) for r in found) == want
    assert all(r["agreement"] == 1.0 and r["differences"] == [] for r in found)


def test_every_template_is_found_and_differences_are_told():
    scanner = Scanner(TEMPLATES)
    for name, texts in TEMPLATES.items():
        for text in texts:
            found = scanner.scan("Words before it.\n\n\n\n" + text.replace("*", "4.0") + "\n\n\n\nand after it.")
            assert [(f.license, f.agreement, f.differences) for f in found] == [(name, 1.0, [])], text
    [f] = scanner.scan(TEMPLATES["MIT"][1].replace("sublicense", "lease"))
    assert f.license == "MIT" and f.differences == ["-sublicense +lease"] and f.agreement < 1.0
    assert [(f.license, f.version) for f in scanner.scan("Licensed under CC BY 3.0\nLicensed under CC BY-SA 4.0")] == [
        ("CC-BY", "3.0"), ("CC-BY-SA", "4.0")]


def test_clean_texts_are_left_alone():
    scanner = Scanner(TEMPLATES)
    for text in ("We got permission to go home.", "A driving license is a license to drive.", "The copyright of 1999 is long gone, without warranty.",
                 "", None, "license", "Software is licensed by its authors under many terms."):
        assert scanner.scan(text) == []


class Unranked(Scanner):
    """Brute force: every template is compared with every window, however little it does to its size."""

    def rank(self, words, among):
        data = " ".join(words).encode()
        return [(self.reduction(self.templates[i], data), i) for i in among]


class Uncompressed(Scanner):
    """Compression switched off: nothing makes anything smaller."""

    def reduction(self, template, data, alone=None):
        return 0.0 if alone is not None else super().reduction(template, data)


def said(found):
    return [(f.start, f.end, f.license, f.version, f.agreement, f.differences) for f in found]


def test_the_ranking_decides():
    """Of a template's own words it is that template which makes them smallest, against its size; without compression
    nothing is found."""
    scanner = Scanner(TEMPLATES)
    for longest, among in scanner.classes.items():
        for i in among:
            words = ["4.0" if w == "*" else w for w in scanner.templates[i].wanted]
            ranked = scanner.rank([*FILLER[:5], *words, *FILLER[5:10]], among)
            assert scanner.templates[ranked[0][1]].wanted == scanner.templates[i].wanted
            assert 0.0 < scanner.templates[i].floor < ranked[0][0]
    off = Uncompressed(TEMPLATES)
    assert not any(off.scan(t.replace("*", "4.0")) for texts in TEMPLATES.values() for t in texts)


@pytest.mark.parametrize("seed", range(3))
def test_changed_notices_against_brute_force(seed):
    """Admitted and unadmitted changes, in prose, several to a text: the floors lose nothing."""
    rng = random.Random(seed)
    scanner, brute = Scanner(TEMPLATES), Unranked(TEMPLATES)
    hits = 0
    for template in scanner.templates:
        words = ["2.0" if w == "*" else w for w in template.wanted]
        for many in (0, changes(len(words)) // 2, changes(len(words)), changes(len(words)) + 1):
            own = list(words)
            for _ in range(many):
                at = rng.randrange(len(own))
                own[at:at + 1] = rng.choice([[], [rng.choice(FILLER)], [own[at], rng.choice(FILLER)]])
            other = rng.choice(scanner.templates).wanted
            text = " ".join([*rng.sample(FILLER, 9), "license", *own, *rng.sample(FILLER, rng.randrange(9)), *other, "copyright"])
            found = scanner.scan(text)
            assert said(found) == said(brute.scan(text))
            hits += len(found)
    assert hits > 100


def test_given_texts_against_brute_force(spark):
    scanner, brute = Scanner(TEMPLATES), Unranked(TEMPLATES)
    texts = [r["text"] for r in spark.read.parquet("/root/testdata/sf0.01/documents.parquet").filter("text is not null").collect()]
    found = [said(scanner.scan(t)) for t in texts]
    assert any(found) and found == [said(brute.scan(t)) for t in texts]


def test_odd_rows(spark, odd, empty):
    assert scan_licenses(odd).count() == 0 and scan_licenses(empty).count() == 0
    notice = "x\n" * 30_000 + "Released under the MIT License.\n" + "y " * 30_000
    df = spark.createDataFrame([(1, notice, "z"), (1, notice, "z"), (None, notice, "z")], "doc_id bigint, text string, license string")
    assert [(r["start"], r["license"]) for r in scan_licenses(df).collect()] == [(60_000, "MIT")] * 3


PROSE = ("Seven herons crossed a quiet lagoon while Martha sketched both banks in charcoal; nobody spoke, since evening "
         "wind carried every whisper toward distant mills, and grain dust hung golden above their porch until dusk fell. ")


def test_notices_within_paragraphs():
    scanner = Scanner(TEMPLATES)
    for notice, name in (("Released under the MIT License.", "MIT"), ("SPDX-License-Identifier: MIT", "MIT"), ("Licensed under CC BY 4.0.", "CC-BY"),
                         ("This work is licensed under a Creative Commons Attribution 4.0 International License.", "CC-BY")):
        for before, after in ((60, 60), (200, 300), (30_000, 30_000)):
            text = (PROSE * 200)[:before] + " " + notice + " " + (PROSE * 200)[:after]
            assert [(f.license, f.start, f.agreement) for f in scanner.scan(text)] == [(name, before + 1, 1.0)], (notice, before)


def test_every_notice_of_a_list_of_licenses():
    notices = [(name, t.replace("*", "4.0")) for name, texts in TEMPLATES.items() for t in texts]
    for between in (" ", " " + PROSE, "\n"):
        found = Scanner(TEMPLATES).scan(between.join(t for _, t in notices * 2))
        assert [f.license for f in found] == [name for name, _ in notices * 2]
    lines = "SPDX-License-Identifier: MIT\n" * 50
    assert [f.start for f in Scanner(TEMPLATES).scan(lines)] == list(range(0, len(lines), 29))


MIT = """Permission is hereby granted, free of charge, to any person obtaining a copy
of this software and associated documentation files (the "Software"), to deal
in the Software without restriction, including without limitation the rights
to use, copy, modify, merge, publish, distribute, sublicense, and/or sell
copies of the Software, and to permit persons to whom the Software is
furnished to do so, subject to the following conditions:

The above copyright notice and this permission notice shall be included in all
copies or substantial portions of the Software."""
BSD = """Redistribution and use in source and binary forms, with or without
modification, are permitted provided that the following conditions are met:

1. Redistributions of source code must retain the above copyright notice, this
   list of conditions and the following disclaimer.

2. Redistributions in binary form must reproduce the above copyright notice,
   this list of conditions and the following disclaimer in the documentation
   and/or other materials provided with the distribution.

3. Neither the name of the copyright holder nor the names of its
   contributors may be used to endorse or promote products derived from
   this software without specific prior written permission."""
GPL = """This program is free software: you can redistribute it and/or modify
it under the terms of the GNU General Public License as published by
the Free Software Foundation, either version 3 of the License, or
(at your option) any later version."""
LGPL = """This library is free software; you can redistribute it and/or
modify it under the terms of the GNU Lesser General Public
License as published by the Free Software Foundation; either
version 2.1 of the License, or (at your option) any later version."""
PUBLISHED = {"MIT": MIT, "BSD-3-Clause": BSD, "GPL": GPL, "LGPL": LGPL}


def test_published_layouts():
    scanner = Scanner(TEMPLATES)
    for name, notice in PUBLISHED.items():
        for mark in ("", "# ", "// ", " * ", "    "):
            lines = "\n".join(mark + line for line in notice.split("\n"))
            for text in (lines, f"Some Tool\n\n\n\n\n{lines}\n\n\n\n\nint main()\n", PROSE * 100 + "\n\n" + lines + "\n\n" + PROSE * 100,
                         lines.replace("\n", "\r\n"), lines.replace("\n", "\n\n\n\n\n")):
                [f] = scanner.scan(text)
                assert (f.license, f.agreement, f.differences) == (name, 1.0, []), (name, mark)
                assert text[f.start:f.end].split()[-1].strip(".") == notice.split()[-1].strip(".")
    both = "\n\n".join(PUBLISHED.values())
    assert [f.license for f in scanner.scan(both)] == list(PUBLISHED)


def test_blocks_hold_the_longest_notice_on_either_side_of_a_cue():
    words = [f"w{i}" for i in range(3_000)]
    words[1_000] = words[1_003] = words[2_900] = "licensed"
    text = " ".join(words)
    scanner = Scanner(TEMPLATES)
    blocks = list(scanner.candidates(text))
    assert [text[a:b].split() for a, b in blocks] == [words[1_000 - scanner.reach + 0:1_003 + scanner.reach], words[2_900 - scanner.reach:]]
    assert list(scanner.candidates("license " * 50_000)) == [(0, 399_999)]
