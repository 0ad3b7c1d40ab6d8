"""License scans: Dice coefficient over word bigrams against licence templates.

Text and templates are normalised to lower-case words; every run of words is a
candidate passage, wherever lines and sentences end.  Dice(A, B) =
2 |A and B| / (|A| + |B|) over bigram multisets is at most
2 min(|A|, |B|) / (|A| + |B|), so a template of m bigrams can only reach the
threshold t on passages of t m / (2 - t) to (2 - t) m / t bigrams.  A bigram at
the edge of a run that is not in the template only lowers its Dice, so the best
runs begin and end with bigrams of the template: those, where enough of them
lie close together, are the only runs whose multisets are counted.

Related licences share their wording.  A run gives way to a longer overlapping
run of another licence that exceeds the threshold by more bigrams
(2 |A and B| - t (|A| + |B|)): the opening of a three-clause BSD text with its
holder's name put in fits the two-clause template exactly, but the longer one
explains more of the text.
"""

from __future__ import annotations

import re
from bisect import bisect_left, bisect_right
from collections import Counter
from heapq import heappop, heappush
from math import ceil

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import own_columns

THRESHOLD = 0.8

_BSD = ("Redistribution and use in source and binary forms, with or without modification, are permitted provided "
        "that the following conditions are met: Redistributions of source code must retain the above copyright notice, this list of "
        "conditions and the following disclaimer. Redistributions in binary form must reproduce the above copyright notice, this list of "
        "conditions and the following disclaimer in the documentation and/or other materials provided with the distribution.")
_BSD_THIRD = (" Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived "
              "from this software without specific prior written permission.")
_BSD_FOURTH = (" All advertising materials mentioning features or use of this software must display the following acknowledgement: This "
               "product includes software developed by the organization.")
_BSD_END = (" THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS \"AS IS\" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, "
            "BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT "
            "SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL "
            "DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS "
            "INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE "
            "OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE.")


def _gnu(kind: str, version: str, what: str = "program") -> str:
    """The header the Free Software Foundation gives for files under one of its licences."""
    return (f"This {what} is free software: you can redistribute it and/or modify it under the terms of the GNU {kind} "
            f"Public License as published by the Free Software Foundation, either version {version} of the License, or (at your option) any later version. "
            f"This {what} is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of "
            f"MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU {kind} Public License for more details.")


def _gnu_opening(kind: str, version: str, what: str = "program") -> str:
    return _gnu(kind, version, what).partition(f" This {what} is distributed")[0]


def _gnu_only(kind: str, version: str) -> str:
    return (f"This program is free software; you can redistribute it and/or modify it under the terms of the GNU {kind} "
            f"Public License version {version} as published by the Free Software Foundation.")


_MIT = ("Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
        "documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation the rights to use, "
        "copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software "
        "is furnished to do so")
_CC_KINDS = [("BY", "permissive", "Attribution"), ("BY-SA", "copyleft", "Attribution-ShareAlike"), ("BY-ND", "no derivatives", "Attribution-NoDerivatives"),
             ("BY-NC", "noncommercial", "Attribution-NonCommercial"), ("BY-NC-SA", "noncommercial", "Attribution-NonCommercial-ShareAlike"),
             ("BY-NC-ND", "noncommercial", "Attribution-NonCommercial-NoDerivatives")]
_CC_VERSIONS = [("4.0", " International"), ("3.0", " Unported"), ("2.5", " Generic"), ("2.0", " Generic"), ("1.0", " Generic")]

#: Licence, family, notice or licence text (opening or operative paragraphs of the public texts).
TEMPLATES = [
    ("Apache-2.0", "permissive", "Licensed under the Apache License, Version 2.0."),
    ("Apache-1.1", "permissive", "Licensed under the Apache License, Version 1.1."),
    ("Apache", "permissive", "Licensed under the Apache License."),
    ("Apache-2.0", "permissive", "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in "
     "compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless required by "
     "applicable law or agreed to in writing, software distributed under the License is distributed on an \"AS IS\" BASIS, WITHOUT "
     "WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language governing permissions and "
     "limitations under the License."),
    ("BSD-2-Clause", "permissive", _BSD),
    ("BSD-2-Clause", "permissive", _BSD + _BSD_END),
    ("BSD-3-Clause", "permissive", _BSD + _BSD_THIRD),
    ("BSD-3-Clause", "permissive", _BSD + _BSD_THIRD + _BSD_END),
    ("BSD-4-Clause", "permissive", _BSD + _BSD_FOURTH + _BSD_THIRD),
    ("BSD-4-Clause", "permissive", _BSD + _BSD_FOURTH + _BSD_THIRD + _BSD_END),
    ("BSD-2-Clause", "permissive", "Licensed under the BSD 2-Clause License."),
    ("BSD-3-Clause", "permissive", "Licensed under the BSD 3-Clause License."),
    ("BSD", "permissive", "Released under the BSD License."),
    *[(f"CC-{kind}-{v}", family, f"This work is licensed under a Creative Commons {long} {v}{port} License.")
      for kind, family, long in _CC_KINDS for v, port in _CC_VERSIONS],
    *[(f"CC-{kind}-{v}", family, f"Licensed under CC {kind} {v}.") for kind, family, _ in _CC_KINDS for v, _ in _CC_VERSIONS],
    *[(f"CC-{kind}", family, f"This work is licensed under a Creative Commons {long} License.") for kind, family, long in _CC_KINDS],
    ("CC0-1.0", "public domain", "To the extent possible under law, the author has waived all copyright and related or neighboring rights to "
     "this work."),
    ("CC0-1.0", "public domain", "This work is marked with CC0 1.0 Universal."),
    ("CC0-1.0", "public domain", "Licensed under CC0 1.0."),
    *[(f"GPL-{v}.0", "copyleft", f"This work is licensed under the GNU General Public License, version {v}.") for v in "23"],
    *[(f"GPL-{v}.0", "copyleft", form("General", v)) for v in "23" for form in (_gnu, _gnu_opening, _gnu_only)],
    ("GPL", "copyleft", "This work is licensed under the GNU General Public License."),
    *[(name, "copyleft", form(kind, v, what)) for name, kind, v in [("LGPL-2.0", "Library General", "2"), ("LGPL-2.1", "Lesser General", "2.1"),
                                                                    ("LGPL-3.0", "Lesser General", "3")]
      for form in (_gnu, _gnu_opening) for what in ("library", "program")],
    ("LGPL-2.1", "copyleft", "This work is licensed under the GNU Lesser General Public License, version 2.1."),
    ("LGPL-3.0", "copyleft", "This work is licensed under the GNU Lesser General Public License, version 3."),
    ("LGPL", "copyleft", "This work is licensed under the GNU Lesser General Public License."),
    *[("AGPL-3.0", "copyleft", form("Affero General", "3")) for form in (_gnu, _gnu_opening)],
    ("AGPL-3.0", "copyleft", "This work is licensed under the GNU Affero General Public License, version 3."),
    ("AGPL", "copyleft", "This work is licensed under the GNU Affero General Public License."),
    ("GFDL", "copyleft", "This work is licensed under the GNU Free Documentation License."),
    ("GFDL-1.3", "copyleft", "Permission is granted to copy, distribute and/or modify this document under the terms of the GNU Free "
     "Documentation License, Version 1.3 or any later version published by the Free Software Foundation; with no Invariant Sections, no "
     "Front-Cover Texts, and no Back-Cover Texts."),
    ("ISC", "permissive", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby "
     "granted, provided that the above copyright notice and this permission notice appear in all copies."),
    ("MIT", "permissive", "Released under the MIT License."),
    ("MIT", "permissive", _MIT + ", subject to the following conditions: The above copyright notice and this permission notice shall be included "
     "in all copies or substantial portions of the Software."),
    ("MIT", "permissive", _MIT + ", subject to the following conditions:"),
    ("MIT-0", "permissive", _MIT + "."),
    ("MPL-2.0", "copyleft", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was "
     "not distributed with this file, You can obtain one at http://mozilla.org/MPL/2.0/."),
    ("Unlicense", "public domain", "This is free and unencumbered software released into the public domain."),
    ("EPL-1.0", "copyleft", "This program and the accompanying materials are made available under the terms of the Eclipse Public License "
     "v1.0 which accompanies this distribution, and is available at http://www.eclipse.org/legal/epl-v10.html"),
    ("EPL-2.0", "copyleft", "This program and the accompanying materials are made available under the terms of the Eclipse Public License "
     "2.0 which is available at https://www.eclipse.org/legal/epl-2.0"),
    ("Artistic-2.0", "permissive", "Under the terms of the Artistic License 2.0."),
    ("Artistic-2.0", "permissive", "Licensed under the Artistic License 2.0."),
    ("Zlib", "permissive", "This software is provided 'as-is', without any express or implied warranty. In no event will the authors be held "
     "liable for any damages arising from the use of this software. Permission is granted to anyone to use this software for any purpose, "
     "including commercial applications, and to alter it and redistribute it freely, subject to the following restrictions: The origin of "
     "this software must not be misrepresented; you must not claim that you wrote the original software. If you use this software in a "
     "product, an acknowledgment in the product documentation would be appreciated but is not required. Altered source versions must be "
     "plainly marked as such, and must not be misrepresented as being the original software. This notice may not be removed or altered from "
     "any source distribution."),
    ("BSL-1.0", "permissive", "Distributed under the Boost Software License, Version 1.0."),
    ("0BSD", "permissive", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby "
     "granted. THE SOFTWARE IS PROVIDED \"AS IS\" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED "
     "WARRANTIES OF MERCHANTABILITY AND FITNESS."),
    ("WTFPL", "public domain", "Do What The Fuck You Want To Public License"),
    ("All rights reserved", "proprietary", "All rights reserved."),
]

MATCHES = "array<struct<license:string,family:string,dice:double,c0:int,c1:int>>"

_WORD = re.compile(r"[^\W_]+")


def words_of(text: str | None) -> list[str]:
    return _WORD.findall((text or "").lower())


def dice(a: Counter, b: Counter) -> float:
    """Dice coefficient of two multisets; 0 if both are empty."""
    n = a.total() + b.total()
    return 2 * (a & b).total() / n if n else 0.0


class Scanner:
    """Templates as bigram multisets, with an index from bigram to templates."""

    def __init__(self, templates: list[tuple[str, str, str]] = TEMPLATES, threshold: float = THRESHOLD):
        if not 0 < threshold <= 1:
            raise ValueError("threshold must lie in (0, 1]")
        self.threshold, self.templates, self.index = threshold, [], {}
        for name, family, text in templates:
            w = words_of(text)
            grams = Counter(zip(w, w[1:]))
            if not grams:
                continue
            for g, c in grams.items():
                self.index.setdefault(g, []).append((len(self.templates), c))
            self.templates.append((name, family, grams, grams.total()))

    def _best(self, k: int, at: list[int], x: int, w: list[str], end: int) -> tuple | None:
        """The best run from hit ``x`` of template ``k`` that ends by word ``end``, as (-dice, -words, first word, hit, template)."""
        grams, m = self.templates[k][2:]
        t, s, best = self.threshold, at[x], None
        most, seen, shared = (2 - t) * m / t, {}, 0
        for y in range(x, len(at)):
            i = at[y]
            n = i - s + 1
            if n > most or i + 2 > end:
                break
            g = (w[i], w[i + 1])
            seen[g] = c = seen.get(g, 0) + 1
            if c <= grams[g]:
                shared += 1
                d = 2 * shared / (n + m)
                if d >= t and (best is None or (-d, -n - 1) < best[:2]):
                    best = (-d, -n - 1, s, x, k)
        return best

    def _gain(self, run: tuple) -> float:
        """What the run shares beyond the threshold."""
        return (-run[0] - self.threshold) * (-run[1] - 1 + self.templates[run[4]][3])

    def _leaders(self, runs: list[tuple]) -> list[tuple]:
        """The runs of highest gain, without overlaps, by first word."""
        starts, out = [], []
        for r in sorted(runs, key=lambda r: (-self._gain(r), r)):
            i = bisect_left(starts, r[2] - r[1])
            if not i or out[i - 1][2] - out[i - 1][1] <= r[2]:
                starts.insert(i, r[2]), out.insert(i, r)
        return out

    def _beaten(self, r: tuple, leaders: list[tuple]) -> bool:
        """Whether a longer overlapping leader of another licence explains more than ``r``."""
        i = bisect_left(leaders, r[2] - r[1], key=lambda x: x[2])
        while i and leaders[i - 1][2] - leaders[i - 1][1] > r[2]:
            i -= 1
            x = leaders[i]
            if x[1] < r[1] and self.templates[x[4]][0] != self.templates[r[4]][0] and self._gain(x) > self._gain(r):
                return True
        return False

    def scan(self, text: str | None) -> list[tuple[str, str, float, int, int]]:
        """Matches as (license, family, dice, first character, past the last), in text order; overlapping runs: the best."""
        text = text or ""
        w = words_of(text)
        places: dict[tuple[str, str], list[int]] = {}
        for i, g in enumerate(zip(w, w[1:])):
            if g in self.index:
                places.setdefault(g, []).append(i)
        shared: Counter = Counter()                                 # bigrams that any run can share with a template at most
        for g, at in places.items():
            for k, c in self.index[g]:
                shared[k] += min(len(at), c)
        t = self.threshold
        runs, hits, close, tried = [], {}, {}, set()
        for k, most_shared in shared.items():
            _, _, grams, m = self.templates[k]
            need, most = max(1, ceil(t * m / (2 - t) - 1e-9)), (2 - t) * m / t      # hits and length of a run
            if most_shared < need:
                continue
            hits[k] = at = sorted(i for g in grams for i in places.get(g, ()))
            a = np.array(at)
            close[k] = a[need - 1:] - a[:len(a) - need + 1] < most
            for x in np.nonzero(close[k])[0].tolist():
                i = at[x] - 1
                if x and at[x - 1] == i:
                    # one bigram more to the left is better, unless runs from here can hold enough of it already
                    g = (w[i], w[i + 1])
                    p = places[g]
                    if bisect_right(p, i + most) - bisect_right(p, i) < grams[g]:
                        continue
                tried.add((k, x))
                run = self._best(k, at, x, w, len(w))
                if run:
                    runs.append(run)
        if not runs:
            return []
        leaders = self._leaders(runs)
        heap, weaker = [], []

        def add(run: tuple | None, first: bool) -> None:
            if run:
                heappush(weaker if first and self._beaten(run, leaders) else heap, run)
        for run in runs:
            add(run, True)
        # the best run first; one that meets a taken word is cut short to the best run before it
        taken, out, first = bytearray(len(w)), [], True
        while heap or weaker:
            if not heap:
                heap, weaker, first = weaker, [], False
            d, words, s, x, k = heappop(heap)
            e = s - words
            stop = taken.find(1, s, e)
            if stop < 0:
                taken[s:e] = b"\1" * (e - s)
                out.append((s, e, k, -d))
                for j, at in hits.items():                          # runs that were better with words now taken
                    y = bisect_left(at, e)
                    if y < len(close[j]) and close[j][y] and (j, y) not in tried:
                        tried.add((j, y))
                        add(self._best(j, at, y, w, len(w)), first)
            elif stop > s:
                add(self._best(k, hits[k], x, w, stop), first)
        lowered = text.lower()
        plain = text if len(lowered) == len(text) else lowered       # rare letters change length when lowered
        spans = [m.span() for m in _WORD.finditer(plain.lower())]
        return [(*self.templates[k][:2], d, spans[s][0], spans[e - 1][1]) for s, e, k, d in sorted(out)]


def matches(text: Column, templates: list[tuple[str, str, str]] = TEMPLATES, threshold: float = THRESHOLD) -> Column:
    """Array of the licence passages of a text; empty for null, empty or unlicensed texts.

    Whole texts are scanned; offsets are code points of the text.  The template
    list is the only thing sent to the executors.
    """
    scanner = Scanner(templates, threshold)

    @F.pandas_udf(MATCHES)
    def of(texts: pd.Series) -> pd.Series:
        return pd.Series([[dict(zip(("license", "family", "dice", "c0", "c1"), m)) for m in scanner.scan(t)] for t in texts], dtype=object)
    return of(text)


@own_columns("text_col")
def scan(docs: DataFrame, text_col: str = "text", name: str = "licenses", **kw) -> DataFrame:
    """``docs`` plus the array ``name``; rows and their number stay, a column of that name is replaced.

    Null and empty texts have no matches, an empty table stays empty, equal texts match alike.  Of two templates that fit a
    passage the same the first by Dice, length and name wins."""
    return docs.withColumn(name, matches(F.col(text_col), **kw))
