"""License scan by conditional compression (operator 6).

Blocks of a document that speak of licensing are cut into overlapping windows,
for each class of template lengths windows in which every notice of the class
stands whole.  A window's words are compressed alone and once with each
template of the class as zstandard's raw dictionary.  The templates are ranked
by how much smaller they make it, against their own size, and confirmed in that
order by exact comparison of the wording.  The ranking ends at the floor of a
template: half of the least reduction that the template's own text leaves when
as many of its words are changed as an agreement admits.  A template whose
reduction is below its floor has no text in the window that agrees with it.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Callable, Iterator
from difflib import SequenceMatcher
from heapq import heappop, heappush
from itertools import islice
from typing import NamedTuple

import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: License notices in their published wording; ``*`` stands for one word that varies (a version, a year).
TEMPLATES = {
    "Apache-2.0": [
        "Licensed under the Apache License, Version *.",
        "Licensed under the Apache License, Version * (the \"License\"); you may not use this file except in compliance "
        "with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless "
        "required by applicable law or agreed to in writing, software distributed under the License is distributed on an "
        "\"AS IS\" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the "
        "specific language governing permissions and limitations under the License.",
    ],
    "AGPL": [
        "This work is licensed under the GNU Affero General Public License, version *.",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU Affero General "
        "Public License as published by the Free Software Foundation, either version * of the License, or (at your option) any "
        "later version.",
    ],
    "BSD-2-Clause": [
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the "
        "following conditions are met: 1. Redistributions of source code must retain the above copyright notice, this list "
        "of conditions and the following disclaimer. 2. Redistributions in binary form must reproduce the above copyright "
        "notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided "
        "with the distribution.",
    ],
    "BSL-1.0": [
        "Distributed under the Boost Software License, Version *.",
        "Permission is hereby granted, free of charge, to any person or organization obtaining a copy of the software and "
        "accompanying documentation covered by this license (the \"Software\") to use, reproduce, display, distribute, execute, "
        "and transmit the Software, and to prepare derivative works of the Software, and to permit third-parties to whom the "
        "Software is furnished to do so, all subject to the following:",
    ],
    "BSD-3-Clause": [
        "Released under the BSD License.",
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the "
        "following conditions are met: 1. Redistributions of source code must retain the above copyright notice, this list "
        "of conditions and the following disclaimer. 2. Redistributions in binary form must reproduce the above copyright "
        "notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided "
        "with the distribution. 3. Neither the name of the copyright holder nor the names of its contributors may be used to "
        "endorse or promote products derived from this software without specific prior written permission.",
    ],
    "CC-BY": ["Licensed under CC BY *.", "This work is licensed under a Creative Commons Attribution * International License."],
    "CC-BY-NC": ["Licensed under CC BY-NC *.",
                 "This work is licensed under a Creative Commons Attribution-NonCommercial * International License."],
    "CC-BY-NC-ND": ["Licensed under CC BY-NC-ND *.",
                    "This work is licensed under a Creative Commons Attribution-NonCommercial-NoDerivatives * International License."],
    "CC-BY-NC-SA": ["Licensed under CC BY-NC-SA *.",
                    "This work is licensed under a Creative Commons Attribution-NonCommercial-ShareAlike * International License."],
    "CC-BY-ND": ["Licensed under CC BY-ND *.",
                 "This work is licensed under a Creative Commons Attribution-NoDerivatives * International License."],
    "CC-BY-SA": ["Licensed under CC BY-SA *.",
                 "This work is licensed under a Creative Commons Attribution-ShareAlike * International License."],
    "CC0-1.0": ["To the extent possible under law, the author has waived all copyright and related or neighboring rights to this work."],
    "EPL-2.0": ["This program and the accompanying materials are made available under the terms of the Eclipse Public License *.",
                "This program and the accompanying materials are made available under the terms of the Eclipse Public License * which "
                "is available at https://www.eclipse.org/legal/epl-2.0."],
    "GPL": [
        "This work is licensed under the GNU General Public License, version *.",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public "
        "License as published by the Free Software Foundation, either version * of the License, or (at your option) any later "
        "version.",
    ],
    "LGPL": [
        "This work is licensed under the GNU Lesser General Public License, version *.",
        "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General "
        "Public License as published by the Free Software Foundation; either version * of the License, or (at your option) any "
        "later version.",
    ],
    "ISC": ["Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby "
            "granted, provided that the above copyright notice and this permission notice appear in all copies."],
    "MIT": [
        "Released under the MIT License.",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
        "documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation the "
        "rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit "
        "persons to whom the Software is furnished to do so, subject to the following conditions: The above copyright notice "
        "and this permission notice shall be included in all copies or substantial portions of the Software.",
    ],
    "MPL-2.0": ["This Source Code Form is subject to the terms of the Mozilla Public License, v. *. If a copy of the MPL was not "
                "distributed with this file, You can obtain one at http://mozilla.org/MPL/2.0/."],
    "Unlicense": [
        "This is free and unencumbered software released into the public domain.",
        "Anyone is free to copy, modify, publish, use, compile, sell, or distribute this software, either in source code form or "
        "as a compiled binary, for any purpose, commercial or non-commercial, and by any means.",
    ],
    "WTFPL": ["Everyone is permitted to copy and distribute verbatim or modified copies of this license document, and changing it is "
              "allowed as long as the name is changed."],
    "Zlib": [
        "This software is provided 'as-is', without any express or implied warranty. In no event will the authors be held liable "
        "for any damages arising from the use of this software. Permission is granted to anyone to use this software for any "
        "purpose, including commercial applications, and to alter it and redistribute it freely, subject to the following "
        "restrictions: 1. The origin of this software must not be misrepresented; you must not claim that you wrote the original "
        "software. If you use this software in a product, an acknowledgment in the product documentation would be appreciated but "
        "is not required. 2. Altered source versions must be plainly marked as such, and must not be misrepresented as being the "
        "original software. 3. This notice may not be removed or altered from any source distribution.",
    ],
}
#: Disclaimers that end a license's full text; each of these licenses has its notice with it as one more template.
MIT_DISCLAIMER = (
    " THE SOFTWARE IS PROVIDED \"AS IS\", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE "
    "WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR "
    "COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, "
    "ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.")
BSD_DISCLAIMER = (
    " THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS \"AS IS\" AND ANY EXPRESS OR IMPLIED WARRANTIES, "
    "INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. "
    "IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR "
    "CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR "
    "PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR "
    "TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE "
    "POSSIBILITY OF SUCH DAMAGE.")
ISC_DISCLAIMER = (
    " THE SOFTWARE IS PROVIDED \"AS IS\" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED "
    "WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR "
    "CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, "
    "NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE.")
for _name, _text in (("MIT", MIT_DISCLAIMER), ("BSD-2-Clause", BSD_DISCLAIMER), ("BSD-3-Clause", BSD_DISCLAIMER), ("ISC", ISC_DISCLAIMER)):
    TEMPLATES[_name].append(TEMPLATES[_name][-1] + _text)
#: Identifiers of the short form ``SPDX-License-Identifier: <id>``, by the name above.
IDENTIFIERS = {
    "AGPL": ["AGPL-3.0-only", "AGPL-3.0-or-later"], "Apache-2.0": ["Apache-2.0"], "BSD-2-Clause": ["BSD-2-Clause"], "BSL-1.0": ["BSL-1.0"],
    "EPL-2.0": ["EPL-2.0"], "Zlib": ["Zlib"], "BSD-3-Clause": ["BSD-3-Clause"], "CC-BY": ["CC-BY-4.0"], "CC-BY-NC": ["CC-BY-NC-4.0"],
    "CC-BY-SA": ["CC-BY-SA-4.0"], "CC0-1.0": ["CC0-1.0"], "GPL": ["GPL-2.0-only", "GPL-2.0-or-later", "GPL-3.0-only", "GPL-3.0-or-later"],
    "LGPL": ["LGPL-2.1-only", "LGPL-2.1-or-later", "LGPL-3.0-only"], "ISC": ["ISC"], "MIT": ["MIT"], "MPL-2.0": ["MPL-2.0"],
    "Unlicense": ["Unlicense"],
}
for _name, _ids in IDENTIFIERS.items():
    TEMPLATES[_name] += [f"SPDX-License-Identifier: {_id}" for _id in _ids]

#: What speaks of licensing.
CUE = r"(?i)licen[cs]|copyright|permission|warrant|redistribut|public domain|creative commons|unencumbered|\bCC BY|all rights|anyone is free"
WORD = re.compile(r"[^\W_]+(?:[.'/&-][^\W_]+)*|\*")

#: A level of zstandard that leaves literals uncompressed.
LEVEL = -1
#: The share of a template's words that must agree.
AGREEMENT = 0.9
#: A class holds the templates of up to twice as many words as its shortest; windows begin half a class's longest apart.
SHORTEST = 4
#: The floor of a template, as a share of the least reduction that admitted changes leave.
SAFETY = 0.5
#: Prose that a changed template stands in when its floor is measured, and what its words are changed to.
FILLER = ("seven herons crossed a quiet lagoon while martha sketched both banks in charcoal nobody spoke since evening wind carried "
          "every whisper toward distant mills and grain dust hung golden above their porch until dusk fell over fields").split()
#: Characters between two cues of one block, at most: farther apart, each has words around it of its own.
APART = 4_096

FOUND = ("doc_id bigint, start bigint, length bigint, license string, version string, reduction double, agreement double, "
         "differences array<string>, wording string")


class Finding(NamedTuple):
    start: int
    end: int
    license: str
    version: str | None
    reduction: float
    agreement: float
    differences: list[str]


class Template(NamedTuple):
    license: str
    wanted: list[str]
    compress: Callable[[bytes], bytes]
    size: int
    floor: float


def changes(words: int) -> int:
    """Words of a template that a text may lack and still agree with it; a replaced word counts as two."""
    n = 0
    while words - n - 1 >= AGREEMENT * words:
        n += 1
    return n


class Scanner:
    """The templates' dictionaries, words and floors, made once per task; by class, from the longest one."""

    def __init__(self, templates: dict[str, list[str]]):
        self.cue = re.compile(CUE)
        # literals stay as they are, so that what a template has of a text comes off its size byte by byte
        settings = zstandard.ZstdCompressionParameters.from_level(LEVEL, min_match=4, write_content_size=False, write_dict_id=False)
        self.plain = zstandard.ZstdCompressor(compression_params=settings).compress
        self.templates = []
        #: Words of the longest template of a class, and the class's templates.
        self.classes: dict[int, list[int]] = {}
        for name, texts in sorted(templates.items()):
            for text in texts:
                wanted = [w.lower() for w in WORD.findall(text)]
                own = " ".join(w for w in wanted if w != "*").encode()
                content = zstandard.ZstdCompressionDict(own, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
                content.precompute_compress(compression_params=settings)
                compress = zstandard.ZstdCompressor(compression_params=settings, dict_data=content).compress
                longest = SHORTEST
                while longest < len(wanted):
                    longest *= 2
                self.classes.setdefault(longest, []).append(len(self.templates))
                bare = Template(name, wanted, compress, max(1, len(self.plain(own))), 0.0)
                self.templates.append(bare._replace(floor=SAFETY * self._least(bare, longest)))
        self.classes = dict(sorted(self.classes.items(), reverse=True))
        #: Words from a cue to the end of its notice, at most, with those of the window around it.
        self.reach = max((len(t.wanted) + 4 + len(t.wanted) // 5 for t in self.templates), default=0)

    def _least(self, template: Template, longest: int) -> float:
        """The least share of its size by which the template makes a window smaller that holds it with all changes it admits,
        spread evenly, as words left out and as words replaced, at the window's start, middle and end."""
        n, least = len(template.wanted), 1.0
        words = [w if w != "*" else FILLER[-1] for w in template.wanted]
        room = max(0, window_words(longest) - n)
        filler = (FILLER * (1 + room // len(FILLER)))[:room]
        for replaced in (False, True):
            count = changes(n) // (1 + replaced)
            for shift in range(4 if count else 1):
                places = {(2 * i + 1) * n // (2 * count) + shift for i in range(count)} if count else set()
                changed = [FILLER[i % len(FILLER)] if i in places else w for i, w in enumerate(words) if replaced or i not in places]
                for before in (0, room // 2, room):
                    least = min(least, self.reduction(template, " ".join([*filler[:before], *changed, *filler[before:]]).encode()))
        return least

    def reduction(self, template: Template, data: bytes, alone: int | None = None) -> float:
        """How much smaller the template makes a text, as a share of the template's own compressed size."""
        alone = len(self.plain(data)) if alone is None else alone
        return (alone - len(template.compress(data))) / template.size

    def rank(self, words: list[str], among: list[int]) -> list[tuple[float, int]]:
        """The templates whose reduction of a window reaches their floor, the largest reduction first: reduction, number."""
        data = " ".join(words).encode("utf-8", "replace")
        alone = len(self.plain(data))
        found = [(self.reduction(self.templates[i], data, alone), -i) for i in among]
        return [(r, -i) for r, i in sorted(found, reverse=True) if r >= self.templates[-i].floor]

    def candidates(self, text: str) -> Iterator[tuple[int, int]]:
        """Blocks that speak of licensing: the cues, and around them the words of the longest template."""
        start = end = None
        for first, last in self._cues(text):
            first, last = _before(text, first, self.reach), _after(text, last, self.reach)
            if start is not None and first > end:
                yield start, end
                start = None
            start, end = first if start is None else min(start, first), last
        if start is not None:
            yield start, end

    def _cues(self, text: str) -> Iterator[tuple[int, int]]:
        """From the first to the last of cues near each other."""
        first = last = None
        for m in self.cue.finditer(text):
            if first is not None and m.start() - last > APART:
                yield first, last
                first = None
            first, last = m.start() if first is None else first, m.end()
        if first is not None:
            yield first, last

    def scan(self, text: str | None) -> list[Finding]:
        return sorted(f for start, end in (self.candidates(text) if text else ()) for f in self._block(text, start, end))

    def _block(self, text: str, start: int, end: int) -> Iterator[Finding]:
        """The notices of a block, the best first: what ranks high in a window is compared with the window's words."""
        words = _words(text, start, end)
        have = [w for w, _, _ in words]
        free = bytearray(b"\1") * len(have)
        best: list = []
        for longest, among in self.classes.items():
            for low in range(0, max(1, len(have) - longest // 2), max(1, longest // 2)):
                high = min(len(have), low + window_words(longest))
                for reduction, template in self.rank(have[low:high], among):
                    self._weigh(best, have, template, reduction, low, high)
        seen = set()
        while best:
            _, template, (share, first, last, version, differences), reduction, low, high = heappop(best)
            if (template, first, last, low, high) in seen:
                continue
            seen.add((template, first, last, low, high))
            if all(free[first:last]):
                free[first:last] = bytes(last - first)
                yield Finding(words[first][1], words[last - 1][2], self.templates[template].license, version, round(reduction, 6),
                              round(share, 6), differences)
            # a notice has some of the window's words: those beside it are compared again
            for a, b in _gaps(free, low, high):
                self._weigh(best, have, template, reduction, a, b)

    def _weigh(self, best: list, have: list[str], template: int, reduction: float, low: int, high: int) -> None:
        wanted = self.templates[template].wanted
        if (Counter(wanted) & Counter(have[low:high])).total() + wanted.count("*") < AGREEMENT * len(wanted):
            return
        first, last = _span(wanted, have, low, high)
        hit = max((h for h in (_confirm(wanted, have, low, high), _confirm(wanted, have, first, last)) if h), key=lambda h: h[0], default=None)
        if hit and hit[0] >= AGREEMENT:
            # most agreement, then the longer template, then the larger reduction
            heappush(best, ((-hit[0], -len(wanted), -round(reduction, 9), hit[1]), template, hit, reduction, low, high))


def window_words(longest: int) -> int:
    """Words of a window of a class: wherever a notice of the class begins, with what changes may add to it, one holds it whole."""
    return longest + longest // 2 + changes(longest) + 2


def _words(text: str, start: int, end: int) -> list[tuple[str, int, int]]:
    """The words of a part of a text: lower case, start, end. The star that begins a line of a comment is none."""
    return [(m.group().lower(), m.start(), m.end()) for m in WORD.finditer(text, start, end)
            if m.group() != "*" or text[text.rfind("\n", 0, m.start()) + 1:m.start()].strip(" \t\r/*")]


def _after(text: str, at: int, count: int) -> int:
    """Where the next ``count`` words end, with the word that ``at`` stands in."""
    words = islice((m.end() for m in WORD.finditer(text, at) if m.group() != "*"), count)
    return max(words, default=len(text))


def _before(text: str, at: int, count: int) -> int:
    """Where the last ``count`` words begin, with the word that ``at`` stands in."""
    size = 16 * count + 64
    while True:
        words = [m.start() for m in WORD.finditer(text, max(0, at - size), at) if m.group() != "*"]
        if len(words) > count:         # the first one may begin before this part
            return words[-count]
        if size >= at:
            return words[-count] if len(words) == count else 0
        size *= 2


def _gaps(free: bytearray, low: int, high: int) -> Iterator[tuple[int, int]]:
    at = low
    while (at := free.find(1, at, high)) >= 0:
        end = free.find(0, at, high)
        yield at, (high if end < 0 else end)
        if end < 0:
            return
        at = end


def _span(wanted: list[str], have: list[str], low: int, high: int) -> tuple[int, int]:
    """The words of a window that agree most with a template, of which every further word takes one off."""
    row = [(0, j) for j in range(low, high + 1)]           # most agreement up to a word, and where that begins
    for w in wanted:
        left = row[0]
        next_row = [left]
        for j in range(low, high):
            value, begin = left
            best = max(row[j - low + 1], (value - 1, begin))
            if w == "*" or w == have[j]:
                best = max(best, (row[j - low][0] + 1, row[j - low][1]))
            next_row.append(best)
            left = best
        row = next_row
    (_, begin), _, end = max((best, -j, j) for j, best in enumerate(row, low))
    return begin, end


def _confirm(wanted: list[str], have: list[str], low: int, high: int):
    """Compare a template with a window of words: the share of the template's words that agree, the first word and
    the one after the last, the varying word and the differences."""
    steps = SequenceMatcher(None, wanted, have[low:high], autojunk=False).get_opcodes()
    equal = [s for s in steps if s[0] == "equal"]
    if not equal:
        return None
    agree, version, differences = 0, None, []
    first, last = low + equal[0][3], low + equal[-1][4]
    if wanted[-1] == "*" and last < high:
        last += 1
    for kind, a, b, c, d in steps:
        if kind == "equal":
            agree += b - a
            continue
        old, new = wanted[a:b], [have[low + i] for i in range(c, d) if first <= low + i < last]
        if "*" in old and new:
            agree += 1
            version = new[old.index("*")] if old.index("*") < len(new) else new[-1]
            new.remove(version)
            old = [w for w in old if w != "*"]
        if old or new:
            differences.append(f"-{' '.join(old)} +{' '.join(new)}")
    extra = sum(len(x.partition(" +")[2].split()) for x in differences)
    return max(0, agree - extra) / len(wanted), first, last, version, differences


def _scan(templates: dict[str, list[str]]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scanner = Scanner(templates)
        for batch in batches:
            rows = [(doc_id, f.start, f.end - f.start, f.license, f.version, f.reduction, f.agreement, f.differences, text[f.start:f.end])
                    for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist())
                    for f in scanner.scan(text)]
            kinds = (pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.string(), pa.float64(), pa.float64(),
                     pa.list_(pa.string()), pa.string())
            columns = list(zip(*rows)) if rows else [()] * len(kinds)
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, k) for c, k in zip(columns, kinds)],
                ["doc_id", "start", "length", "license", "version", "reduction", "agreement", "differences", "wording"])
    return run


def scan_licenses(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                  templates: dict[str, list[str]] | None = None) -> DataFrame:
    """One row per confirmed notice: ``doc_id, start, length`` (code points), ``license, version, reduction,
    agreement, differences, wording``.

    ``reduction`` is that of the window by the template, as a share of the template's own compressed size.
    Documents without a notice, null and empty texts give no row; a document
    may have several notices.  Of templates that agree equally the longer one
    is named.  Repeated rows give repeated rows, extra columns are ignored.
    Documents are independent: a built-in filter passes those that mention
    licensing to the tasks' scanners, and nothing is shuffled."""
    rows = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return rows.filter(F.col("text").rlike(CUE)).mapInArrow(_scan(templates or TEMPLATES), FOUND)
