"""Licence scan: passages compared to licence templates by the Dice coefficient over word bigrams.

A passage may begin and end at any word. The best one that begins at a word begins and ends with bigrams of the template,
so only places of such bigrams matter. The coefficient bounds a passage's size from both sides, and with it the number of
the template's bigrams that a passage must hold: places with fewer of them ahead, which is nearly all of ordinary prose,
are told by one comparison. From each that is left the shared bigrams are counted along all possible ends at once.
"""

from __future__ import annotations

from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from .common import Words, grams, text_batches
from .decontaminate import normalised

LEAST_DICE = 0.8
_BSD = (
    "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met: "
    "1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer. 2. "
    "Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the "
    "documentation and/or other materials provided with the distribution. ",
    "3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this "
    "software without specific prior written permission. ",
    "THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS \"AS IS\" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT "
    "LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER "
    "OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, "
    "PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF "
    "LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS "
    "SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE.")
#: Templates: fixed values, the usual wording of notices and short licences. Texts of long licences are passed as an argument.
TEMPLATES = {
    "Apache-2.0": (
        "Licensed under the Apache License, Version 2.0.",
        "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License. "
        "You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0. Unless required by applicable law or agreed to in "
        "writing, software distributed under the License is distributed on an \"AS IS\" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either "
        "express or implied. See the License for the specific language governing permissions and limitations under the License.",
        "SPDX-License-Identifier: Apache-2.0"),
    "MIT": (
        "Released under the MIT License.",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the "
        "\"Software\"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, "
        "distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to "
        "the following conditions: The above copyright notice and this permission notice shall be included in all copies or substantial portions "
        "of the Software. THE SOFTWARE IS PROVIDED \"AS IS\", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE "
        "WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE "
        "LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION "
        "WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.",
        "SPDX-License-Identifier: MIT"),
    "ISC": (
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the "
        "above copyright notice and this permission notice appear in all copies. THE SOFTWARE IS PROVIDED \"AS IS\" AND THE AUTHOR DISCLAIMS ALL "
        "WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE "
        "LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, "
        "WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS "
        "SOFTWARE.",),
    "GPL-3.0": (
        "This work is licensed under the GNU General Public License, version 3.",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by "
        "the Free Software Foundation, either version 3 of the License, or (at your option) any later version.",
        "SPDX-License-Identifier: GPL-3.0-or-later"),
    "GPL-2.0": (
        "This work is licensed under the GNU General Public License, version 2.",
        "This program is free software; you can redistribute it and/or modify it under the terms of the GNU General Public License as published by "
        "the Free Software Foundation; either version 2 of the License, or (at your option) any later version."),
    "MPL-2.0": (
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with this "
        "file, You can obtain one at https://mozilla.org/MPL/2.0/.",),
    "BSD": ("Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:",),
    "BSD-2-Clause": (_BSD[0] + _BSD[2], "SPDX-License-Identifier: BSD-2-Clause"),
    "BSD-3-Clause": (_BSD[0] + _BSD[1] + _BSD[2], "SPDX-License-Identifier: BSD-3-Clause"),
    "LGPL-3.0": (
        "This library is free software: you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as "
        "published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.",),
    "AGPL-3.0": (
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU Affero General Public License as "
        "published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.",),
    "Zlib": (
        "This software is provided 'as-is', without any express or implied warranty. In no event will the authors be held liable for any damages "
        "arising from the use of this software. Permission is granted to anyone to use this software for any purpose, including commercial "
        "applications, and to alter it and redistribute it freely, subject to the following restrictions: 1. The origin of this software must not be "
        "misrepresented; you must not claim that you wrote the original software. If you use this software in a product, an acknowledgment in the "
        "product documentation would be appreciated but is not required. 2. Altered source versions must be plainly marked as such, and must not be "
        "misrepresented as being the original software. 3. This notice may not be removed or altered from any source distribution.",),
    "Unlicense": ("This is free and unencumbered software released into the public domain.",),
    "CC-BY-4.0": ("Licensed under CC BY 4.0.", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    "CC-BY-SA-4.0": ("Licensed under CC BY-SA 4.0.", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License."),
    "CC-BY-NC-4.0": ("Licensed under CC BY-NC 4.0.", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License."),
}


class Templates:
    """Templates as multisets of bigrams, and all their bigrams in one sorted list."""

    def __init__(self, templates: dict[str, tuple[str, ...]], least: float):
        pairs = [(name, text) for name, texts in templates.items() for text in texts]
        w = normalised([text.encode() for _, text in pairs])
        hashes = w.hashes()
        self.least, self.names, counts = least, [name for name, _ in pairs], []
        for a, b in zip(w.first, w.first[1:], strict=False):
            if b - a < 4:
                raise ValueError("a template needs four words at least")
            counts.append(Counter(grams(hashes[a:b], 2).tolist()))
        self.size = np.array([c.total() for c in counts])
        self.all = np.unique(np.array([g for c in counts for g in c], np.uint64))
        #: how often each of all bigrams stands in each template
        self.times = np.zeros((len(counts), len(self.all)), np.int32)
        for row, c in zip(self.times, counts, strict=True):
            row[np.searchsorted(self.all, np.array(list(c), np.uint64))] = list(c.values())
        # a passage of n bigrams shares at most the smaller number, so the coefficient bounds n on both sides
        self.low = np.ceil(self.size * least / (2 - least) - 1e-9).astype(int)
        self.high = np.floor(self.size * (2 - least) / least + 1e-9).astype(int)

    def scan(self, w: Words) -> list[tuple[int, str, float, int, int]]:
        """Passages of some texts (text, licence, coefficient, first word, end): of each text the best first, none overlapping."""
        number = grams(w.hashes(), 2)
        if not len(number):
            return []
        at = np.minimum(np.searchsorted(self.all, number), len(self.all) - 1)
        place = np.flatnonzero(self.all[at] == number)
        text = np.searchsorted(w.first, place, side="right") - 1
        inside = place + 1 < w.first[text + 1]  # not from one text to the next
        place, text = place[inside], text[inside]
        gram = at[place]
        found = []
        for t in range(len(self.names)):
            own = np.flatnonzero(self.times[t][gram] > 0)
            found += self._passages(t, place[own], text[own], gram[own])
        out, taken = [], {}
        for dice, a, b, t, d in sorted(found, key=lambda x: (x[0], x[1], -x[2], x[3])):
            spans = taken.setdefault(d, [])
            if all(b <= x or a >= y for x, y in spans):
                spans.append((a, b))
                first = int(w.first[d])
                out.append((d, self.names[t], -dice, a - first, b - first))
        return out

    def _passages(self, t: int, place: np.ndarray, text: np.ndarray, gram: np.ndarray) -> list[tuple]:
        """For each place that begins one, the best passage of a template: (-coefficient, begin, end, template, text)."""
        size, times = int(self.size[t]), self.times[t]
        last = np.searchsorted(place, place + self.high[t])  # places that a passage from here may hold
        last = np.minimum(last, np.searchsorted(text, text, side="right"))
        need = self.least * (max(int(self.low[t]), 1) + size) / 2
        starts = np.flatnonzero(last - np.arange(len(place)) >= need - 1e-9)
        if not len(starts):
            return []
        # how often the same bigram stands before each place, over all texts
        order = np.argsort(gram, kind="stable")
        ranked = gram[order]
        new = np.concatenate([[True], ranked[1:] != ranked[:-1]])
        before = np.empty(len(gram), np.int64)
        before[order] = np.arange(len(gram)) - np.maximum.accumulate(np.where(new, np.arange(len(gram)), 0))
        base, at, out = np.zeros(len(times), np.int64), 0, []
        for i in starts.tolist():
            np.add.at(base, gram[at:i], 1)
            at, j = i, int(last[i])
            own = gram[i:j]
            shared = np.cumsum(before[i:j] - base[own] < times[own])
            dice = 2 * shared / (place[i:j] - place[i] + 1 + size)
            best = int(dice.argmax())
            if dice[best] >= self.least - 1e-12:
                out.append((-float(dice[best]), int(place[i]), int(place[i + best]) + 2, t, int(text[i])))
        return out


def scan(docs: DataFrame, id: str = "doc_id", text: str = "text", templates: dict | None = None, least: float = LEAST_DICE) -> DataFrame:
    """Rows (id, license, dice, begin, end): passages that match a licence template.

    Words have no case and no ASCII punctuation; a passage is any run of words, ``dice`` is twice the bigrams it shares
    with the template (repeats included) over the bigrams of both, ``least`` or more. For each place and template the
    best passage from there counts, of equals the shortest. Passages of a text do not overlap: the better goes first, then
    the earlier, then the longer, then the earlier template. Words are numbered from 0, ``end`` is past the last. Whole texts are read. Null
    and empty texts hold nothing; rows that repeat an id each report their own; other columns are not read. No rows: an
    empty result.
    """
    if not 0.5 <= least <= 1:
        raise ValueError("the least coefficient must lie between 0.5 and 1")
    known, name = Templates(templates or TEMPLATES, least), id

    def run(batches):
        for batch, texts in text_batches(batches, text):
            found = known.scan(normalised(texts))
            kinds = (pa.string(), pa.float64(), pa.int64(), pa.int64())
            rows = pa.array([p[0] for p in found], pa.int64())
            yield pa.RecordBatch.from_arrays([batch.column(name).take(rows), *(pa.array([p[c] for p in found], kind) for c, kind in enumerate(kinds, 1))],
                                             names=[name, "license", "dice", "begin", "end"])

    schema = T.StructType([docs.schema[id], *T._parse_datatype_string("license string, dice double, begin long, end long").fields])
    return docs.select(id, text).mapInArrow(run, schema)
