"""License scans by conditional compression (operator 4).

Each template has cue words, as many of its rarer words that a wording with an allowed number
of differences keeps one of them at least. Around the cue words of a template, blocks of bounded length
are compressed with zstandard alone and with the template as a raw dictionary. The templates
of a block are ranked by the bytes saved; every one whose dictionary saves ``LEAST_GAIN``
of the template's own compressed size, and every one of fewer than ``SHORT`` words, where a
few bytes tell nothing, is confirmed by the exact wording: a stretch of the block is the
template's if at most ``ALLOWED`` of the template's words differ, and the differences are reported.

Scale: one pass without a shuffle. An Aho-Corasick automaton seeks the cue words in the whole
text, and texts without one cost no more; the work for others is their cue words times
those words' templates, and a task holds an Arrow batch.

Cases: null and empty texts have no blocks; upper case and white space, line breaks
too, do not matter; the line is that of the match's first cue word; of overlapping
matches the one with most words less twice the differences wins, then the
earliest, and all that do not overlap are reported; a template without words matches
nothing; repeated rows repeat.
"""

from __future__ import annotations

import re
from bisect import bisect_left
from collections.abc import Iterator
from functools import lru_cache
from math import floor

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import as_bytes, read

ALLOWED, LEAST_GAIN, SHORT, WINDOW = 0.2, 0.1, 10, 4
#: Words that are no cues as long as a template has others.
COMMON = frozenset(
    "a all an and any are as at be but by file following for free from if in is it may must no not of on or other otherwise "
    "person possible public shall software that the these this to under use used version with without work you your".split()
)
#: Wordings by which public licenses are declared.
TEMPLATES = {
    "Apache-2.0": "Licensed under the Apache License, Version 2.0.",
    "Apache-2.0 notice": 'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the License.',
    "MIT": "Released under the MIT License.",
    "MIT text": 'Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the "Software"), to deal in the Software without restriction',
    "GPL-3.0": "This work is licensed under the GNU General Public License, version 3.",
    "GPL-2.0": "This work is licensed under the GNU General Public License, version 2.",
    "LGPL-3.0": "This work is licensed under the GNU Lesser General Public License, version 3.",
    "AGPL-3.0": "This work is licensed under the GNU Affero General Public License, version 3.",
    "BSD": "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:",
    "MPL-2.0": "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
    "CC-BY-4.0": "Licensed under CC BY 4.0.",
    "CC-BY-SA-4.0": "Licensed under CC BY-SA 4.0.",
    "CC-BY-NC-4.0": "Licensed under CC BY-NC 4.0.",
    "CC-BY-NC-SA-4.0": "Licensed under CC BY-NC-SA 4.0.",
    "CC0-1.0": "To the extent possible under law, the author has waived all copyright and related rights to this work. Dedicated to the public domain under CC0 1.0.",
    "Proprietary": "All rights reserved.",
    "MIT full": (
        'Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the "Software"), '
        "to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, "
        "and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions: "
        "The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software. "
        'THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, '
        "FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER "
        "LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER "
        "DEALINGS IN THE SOFTWARE."
    ),
    "ISC": (
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above "
        'copyright notice and this permission notice appear in all copies. THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH '
        "REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, "
        "DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, "
        "NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE."
    ),
    "BSD-2-Clause": (
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met: "
        "1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer. "
        "2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the "
        'documentation and/or other materials provided with the distribution. THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" '
        "AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR "
        "PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, "
        "OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS "
        "INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) "
        "ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE."
    ),
    "Zlib": (
        "This software is provided 'as-is', without any express or implied warranty. In no event will the authors be held liable for any damages arising "
        "from the use of this software. Permission is granted to anyone to use this software for any purpose, including commercial applications, and to "
        "alter it and redistribute it freely, subject to the following restrictions: 1. The origin of this software must not be misrepresented; you must "
        "not claim that you wrote the original software. If you use this software in a product, an acknowledgment in the product documentation would be "
        "appreciated but is not required. 2. Altered source versions must be plainly marked as such, and must not be misrepresented as being the original "
        "software. 3. This notice may not be removed or altered from any source distribution."
    ),
    "Apache-2.0 header": (
        'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the License. You may obtain a '
        "copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to in writing, software distributed "
        'under the License is distributed on an "AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for '
        "the specific language governing permissions and limitations under the License."
    ),
    "GPL-3.0-or-later": (
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free "
        "Software Foundation, either version 3 of the License, or (at your option) any later version. This program is distributed in the hope that it will be "
        "useful, but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU General "
        "Public License for more details. You should have received a copy of the GNU General Public License along with this program. If not, see "
        "<https://www.gnu.org/licenses/>."
    ),
}
_WORDS = re.compile(r"[^\W_]+(?:[-.][^\W_]+)*")


def words(text: str) -> list[str]:
    return _WORDS.findall(text.lower())


def cue_words(want: list[str]) -> set[str]:
    """Words that stand in more of the template's places than may differ, the longest that
    are not ``COMMON``: whatever differs within the bound, one of them stays."""
    out, places = set(), 0
    for w in sorted(set(want), key=lambda w: (w in COMMON, -len(w), w)):
        if places > floor(ALLOWED * len(want)):
            break
        out.add(w)
        places += want.count(w)
    return out


class Scanner:
    def __init__(self, templates: dict[str, str]):
        import ahocorasick
        import zstandard

        self.words = {name: w for name, t in templates.items() if (w := words(t))}
        self.plain = zstandard.ZstdCompressor(level=3, write_content_size=False)
        self.size = {name: len(self.plain.compress(" ".join(w).encode())) for name, w in self.words.items()}
        self.with_template = {
            name: zstandard.ZstdCompressor(
                level=3, write_content_size=False,
                dict_data=zstandard.ZstdCompressionDict((" ".join(w) + " ").encode() * 2, dict_type=zstandard.DICT_TYPE_RAWCONTENT),
            )
            for name, w in self.words.items()
        }
        self.cues: dict[str, list[str]] = {}
        for name, want in self.words.items():
            for w in cue_words(want):
                self.cues.setdefault(w, []).append(name)
        self.seeker = ahocorasick.Automaton()
        for w in self.cues:
            self.seeker.add_word(w, len(w))
        if self.cues:
            self.seeker.make_automaton()

    def has_cue(self, text: str) -> bool:
        """Whether a cue word may stand in the lower-case text, not inside another word."""
        if not self.cues:
            return False
        for last, n in self.seeker.iter(text):
            if not text[last + 1 : last + 2].isalnum() and not (last >= n and text[last - n].isalnum()):
                return True
        return False

    def blocks(self, at: list[int], name: str, end: int) -> Iterator[tuple[int, int]]:
        """Stretches of at most ``WINDOW`` times the longest match that hold every match around the cues ``at``."""
        want = len(self.words[name])
        longest = want + floor(ALLOWED * want)
        first = last = None
        for cue in [*at, None]:
            if first is not None and (cue is None or cue - longest > last):
                while True:
                    stop = min(last, first + WINDOW * longest)
                    yield first, stop
                    if stop == last:
                        break
                    first = stop - longest
                first = None
            if cue is not None:
                first = max(0, cue - longest + 1) if first is None else first
                last = min(end, cue + longest)

    def gain(self, block: list[str], name: str) -> float:
        """Bytes that the template's dictionary saves, as a share of the template's size."""
        data = " ".join(block).encode()
        return (len(self.plain.compress(data)) - len(self.with_template[name].compress(data))) / self.size[name]

    def stretches(self, block: list[str], name: str) -> list[tuple[int, int, int]]:
        """(words that differ, first, end) of the closest stretch of the block for each end that is close enough."""
        want = self.words[name]
        cost, first, out = list(range(len(want) + 1)), [0] * (len(want) + 1), []
        for j, word in enumerate(block):
            below, at = [0], [j + 1]
            for i, w in enumerate(want):
                n, k = min((cost[i] + (w != word), -first[i]), (cost[i + 1] + 1, -first[i + 1]), (below[i] + 1, -at[i]))
                below.append(n)
                at.append(-k)
            cost, first = below, at
            if cost[-1] <= ALLOWED * len(want):
                out.append((cost[-1], first[-1], j + 1))
        return out

    def differences(self, got: list[str], name: str) -> list[str]:
        """What differs between the template and a stretch, by a least number of changed words."""
        want = self.words[name]
        left = [[0] * (len(got) + 1) for _ in range(len(want) + 1)]  # of what is still to come
        for i in range(len(want), -1, -1):
            for j in range(len(got), -1, -1):
                if i < len(want) and j < len(got):
                    left[i][j] = min(left[i + 1][j + 1] + (want[i] != got[j]), left[i + 1][j] + 1, left[i][j + 1] + 1)
                else:
                    left[i][j] = len(want) - i + len(got) - j
        i = j = a = c = 0
        told = []
        while True:
            over = i == len(want) and j == len(got)
            if over or (i < len(want) and j < len(got) and want[i] == got[j] and left[i][j] == left[i + 1][j + 1]):
                if (a, c) != (i, j):
                    told.append(f"{' '.join(want[a:i])} > {' '.join(got[c:j])}")
                if over:
                    return told
                i, j = i + 1, j + 1
                a, c = i, j
            elif i < len(want) and j < len(got) and left[i][j] == left[i + 1][j + 1] + 1:
                i, j = i + 1, j + 1
            elif i < len(want) and left[i][j] == left[i + 1][j] + 1:
                i += 1
            else:
                j += 1

    def scan(self, text: str) -> list[tuple]:
        """(line, template, gain, words that differ, the differences) of confirmed matches."""
        text = text.lower()
        if not self.has_cue(text):
            return []
        at, every = [], []
        for m in _WORDS.finditer(text):
            at.append(m.start())
            every.append(m.group())
        cues: dict[str, list[int]] = {}
        for i, w in enumerate(every):
            for name in self.cues.get(w, ()):
                cues.setdefault(name, []).append(i)
        ranked = sorted(
            ((self.gain(every[first:stop], name), name, first, stop) for name, places in cues.items() for first, stop in self.blocks(places, name, len(every))),
            key=lambda r: (-r[0], r[1:]),
        )
        found: dict[tuple, float] = {}
        for gain, name, first, stop in ranked:
            want, block = self.words[name], every[first:stop]
            if gain < LEAST_GAIN and len(want) >= SHORT:
                continue
            held = set(block)
            if sum(w not in held for w in want) > ALLOWED * len(want):  # each differs
                continue
            for n, a, b in self.stretches(block, name):
                found.setdefault((2 * n - len(want), first + a, first + b, name, n), gain)
        out, taken = [], []  # taken: sorted (first, end) without overlaps
        for key in sorted(found):
            _, a, b, name, n = key
            k = bisect_left(taken, (a, b))
            if (k and taken[k - 1][1] > a) or (k < len(taken) and taken[k][0] < b):
                continue
            taken.insert(k, (a, b))
            start = next(i for i in cues[name][bisect_left(cues[name], a) :])
            out.append((a, text.count("\n", 0, at[start]), name, found[key], n, self.differences(every[a:b], name)))
        return [row[1:] for row in sorted(out)]


@lru_cache(maxsize=4)
def _scanner(templates: tuple) -> Scanner:
    return Scanner(dict(templates))


def scan_licenses(docs: DataFrame, templates: dict[str, str] | None = None, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """``(doc_id, line, license, gain, n_differences, differences)`` for each confirmed match."""
    key = tuple((templates or TEMPLATES).items())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scanner = _scanner(key)
        for batch in batches:
            at, rows = [], []
            for i, t in enumerate(batch.column(1)):
                for row in scanner.scan(t.as_py().decode()):
                    at.append(i)
                    rows.append(row)
            kinds = (pa.int64(), pa.string(), pa.float64(), pa.int64(), pa.list_(pa.string()))
            columns = [pa.array([r[k] for r in rows], kind) for k, kind in enumerate(kinds)]
            yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(at, pa.int64())), *columns], ["doc_id", "line", "license", "gain", "n_differences", "differences"])

    kind = docs.schema[doc_id].dataType.simpleString()
    rows = docs.where(F.col(text) != "").select(F.col(doc_id).alias("doc_id"), as_bytes(F.col(text)).alias("text"))
    return rows.mapInArrow(run, f"doc_id {kind}, line long, license string, gain double, n_differences long, differences array<string>")


def op4_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = scan_licenses(read(spark, sf_dir, "documents"))
    return found.withColumn("differences", F.array_join("differences", "; "))
