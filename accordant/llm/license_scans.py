"""License scans: base phrases, and an exact set-similarity join against license templates.

The tokens of the join are runs of SHINGLE words, ordered by how many documents hold them, rarest first.
The blocks of a text are, for each template, windows of twice its words that start at every multiple of
them, so that any passage of the template's length lies whole in a block. A block meets a template
where it holds at least a threshold's share of the template's distinct tokens. It must then hold one of
the template's first tokens (prefix filter) and enough tokens of the template's vocabulary at all
(length filter), and behind the first one they share enough must be left on both sides (positional
filter); what passes is verified token by token.

The templates are the small side of the join and a fixed table, whose words and tokens are all that
executors are sent; texts stream through one pass for the frequencies and one for the join, without a
shuffle of texts.

Defined results: a null text is empty, has no words, null word positions, empty labels and score 0;
a null id stays null beside any other; repeated rows are scanned each; of tokens that are equally
frequent the lesser in order of words comes first, which changes no result; an empty table gives no rows;
long texts are cut into blocks, never shortened. Other columns are not looked at.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from itertools import repeat

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import id_columns, ids_of

#: Words are runs of digits, letters a-z and everything beyond ASCII.
WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
_LOWER = {c: c + 32 for c in range(65, 91)}

#: The base phrases and their labels.
PHRASES = {"under the mit license": "mit", "apache license version 2": "apache-2", "cc by nc": "cc-by-nc"}

#: Public license texts and the notices by which works refer to them. Names are the labels.
TEMPLATES = {
    "mit-text": """Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files
(the "Software"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish,
distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the
following conditions: The above copyright notice and this permission notice shall be included in all copies or substantial portions of the
Software. THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF
MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY
CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE
SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.""",
    "bsd-2-text": """Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following
conditions are met: 1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following
disclaimer. 2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer
in the documentation and/or other materials provided with the distribution. THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS
"AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A
PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL,
SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA,
OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING
NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE.""",
    "bsd-3-third-condition": """Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products
derived from this software without specific prior written permission.""",
    "isc-text": """Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that
the above copyright notice and this permission notice appear in all copies. THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL
WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE
FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN
ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE.""",
    "zlib-text": """This software is provided 'as-is', without any express or implied warranty. In no event will the authors be held liable for any
damages arising from the use of this software. Permission is granted to anyone to use this software for any purpose, including commercial
applications, and to alter it and redistribute it freely, subject to the following restrictions: 1. The origin of this software must not be
misrepresented; you must not claim that you wrote the original software. If you use this software in a product, an acknowledgment in the product
documentation would be appreciated but is not required. 2. Altered source versions must be plainly marked as such, and must not be misrepresented
as being the original software. 3. This notice may not be removed or altered from any source distribution.""",
    "unlicense-text": """This is free and unencumbered software released into the public domain. Anyone is free to copy, modify, publish, use, compile,
sell, or distribute this software, either in source code form or as a compiled binary, for any purpose, commercial or non-commercial, and by any
means. In jurisdictions that recognize copyright laws, the author or authors of this software dedicate any and all copyright interest in the
software to the public domain. We make this dedication for the benefit of the public at large and to the detriment of our heirs and successors.
We intend this dedication to be an overt act of relinquishment in perpetuity of all present and future rights to this software under copyright
law.""",
    "bsl-1-text": """Permission is hereby granted, free of charge, to any person or organization obtaining a copy of the software and accompanying
documentation covered by this license (the "Software") to use, reproduce, display, distribute, execute, and transmit the Software, and to prepare
derivative works of the Software, and to permit third-parties to whom the Software is furnished to do so, all subject to the following: The
copyright notices in the Software and this entire statement, including the above license grant, this restriction and the following disclaimer,
must be included in all copies of the Software, in whole or in part, and all derivative works of the Software, unless such copies or derivative
works are solely in the form of machine-executable object code generated by a source language processor.""",
    "apache-2-header": """Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the
License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to in
writing, software distributed under the License is distributed on an "AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express
or implied. See the License for the specific language governing permissions and limitations under the License.""",
    "gpl-header": """This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as
published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version. This program is distributed
in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR
PURPOSE. See the GNU General Public License for more details. You should have received a copy of the GNU General Public License along with this
program. If not, see""",
    "mpl-2-header": """This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed
with this file, You can obtain one at""",
    "cc-by-notice": "This work is licensed under the Creative Commons Attribution 4.0 International License. To view a copy of this license, visit",
    "mit-notice": "released under the MIT License",
    "apache-2-notice": "licensed under the Apache License, Version 2.0",
    "gpl-3-notice": "licensed under the GNU General Public License, version 3",
    "cc-by-nc-notice": "licensed under CC BY-NC 4.0",
}
#: Share of a template's distinct tokens that a block must hold, and words of a token.
THRESHOLD, SHINGLE = 0.8, 3


def words_of(text: str) -> list[str]:
    return WORD.findall(text.translate(_LOWER))


class TemplateIndex:
    """Templates by their tokens, numbered in global frequency order, with an inverted index over their prefixes.

    `counts` are how many documents hold each token, in the order of `codes`.
    """

    def __init__(self, templates: dict[str, str], counts: np.ndarray | None = None, threshold: float = THRESHOLD, shingle: int = SHINGLE):
        words = {name: words_of(text) for name, text in templates.items()}
        if any(len(w) < shingle for w in words.values()):
            raise ValueError(f"a template has {shingle} words at least")
        self.shingle, self.sizes = shingle, {name: len(w) for name, w in words.items()}
        self.word_ids = {w: n for n, w in enumerate(sorted({w for own in words.values() for w in own}))}
        each = {name: np.unique(self._codes(self._ids(w))) for name, w in words.items()}
        self.codes = np.unique(np.concatenate([*each.values(), np.empty(0, dtype=np.int64)]))
        counts = np.zeros(len(self.codes), dtype=np.int64) if counts is None else counts
        self.numbers = np.empty(len(self.codes), dtype=np.int64)  # of each code its place in the order, rarest first
        self.numbers[np.lexsort((self.codes, counts))] = np.arange(len(self.codes))
        self.sets = {name: np.sort(self.numbers[np.searchsorted(self.codes, own)]) for name, own in each.items()}
        self.need = {name: max(1, -(-round(threshold * 1000) * len(own) // 1000)) for name, own in self.sets.items()}  # in integers: a share times a size is not exact in floats
        self.prefixes: dict[int, list[str]] = {}
        for name, own in self.sets.items():
            for token in own[: len(own) - self.need[name] + 1].tolist():
                self.prefixes.setdefault(token, []).append(name)
        self.in_prefix = np.isin(np.arange(len(self.codes)), list(self.prefixes))

    def _ids(self, words: list[str]) -> np.ndarray:
        return np.fromiter(map(self.word_ids.get, words, repeat(-1)), np.int64, len(words))

    def _codes(self, ids: np.ndarray) -> np.ndarray:
        """The code of the token that starts at each word, -1 where it holds a word of no template."""
        n = len(ids) - self.shingle + 1
        code, known = np.zeros(max(0, n), dtype=np.int64), np.ones(max(0, n), dtype=bool)
        for k in range(self.shingle if n > 0 else 0):
            code = code * len(self.word_ids) + ids[k : k + n]
            known &= ids[k : k + n] >= 0
        return np.where(known, code, -1)

    def tokens(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Places in `words` where a template's token starts, and the tokens' numbers."""
        codes = self._codes(self._ids(words))
        if not len(self.codes):
            return codes[:0], codes[:0]
        at = np.minimum(np.searchsorted(self.codes, codes), len(self.codes) - 1)
        places = np.flatnonzero(self.codes[at] == codes)
        return places, self.numbers[at[places]]

    def blocks(self, name: str, places: np.ndarray) -> np.ndarray:
        """The first words of the blocks of a template that hold a token at one of these places."""
        size = self.sizes[name]
        own = np.unique(np.concatenate((places // size, places // size - 1))) * size
        return own[own >= 0]

    def match(self, words: list[str]) -> dict[str, float]:
        """The best containment of each template over the blocks of a text, where it reaches the threshold."""
        best: dict[str, float] = {}
        places, tokens = self.tokens(words)
        rare = self.in_prefix[tokens]
        met: dict[str, list[int]] = {}
        for place, token in zip(places[rare].tolist(), tokens[rare].tolist()):  # prefix filter
            for name in self.prefixes[token]:
                met.setdefault(name, []).append(place)
        for name, hits in met.items():
            own, need = self.sets[name], self.need[name]
            for start in self.blocks(name, np.array(hits)).tolist():
                a, b = np.searchsorted(places, [start, start + 2 * self.sizes[name] - self.shingle + 1])
                block = np.unique(tokens[a:b])
                if len(block) < need:  # length filter
                    continue
                at = np.minimum(np.searchsorted(own, block), len(own) - 1)
                shared = np.flatnonzero(own[at] == block)
                # Positional filter: behind the first shared token, itself included.
                if not len(shared) or min(len(own) - at[shared[0]], len(block) - shared[0]) < need or len(shared) < need:
                    continue
                best[name] = max(best.get(name, 0.0), len(shared) / len(own))
        return best


def base_matches(words: list[str], phrases: dict[str, str] = PHRASES) -> list[tuple[int, str]]:
    """(word position, label) of every place where a phrase's words stand consecutively."""
    joined, found = f" {' '.join(words)} ", []
    for phrase, label in phrases.items():
        wanted = f" {phrase} "
        at, counted, word = joined.find(wanted), 0, 0
        while at >= 0:
            word += joined.count(" ", counted, at)
            counted = at
            found.append((word, label))
            at = joined.find(wanted, at + 1)
    return found


def token_counts(docs: DataFrame, templates: dict[str, str], text: str = "text") -> np.ndarray:
    """How many rows hold each token of the templates, in the order of TemplateIndex.codes: as many rows reach the driver."""
    index = TemplateIndex(templates)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        counts = np.zeros(len(index.codes), dtype=np.int64)
        for batch in batches:
            for value in batch["t"]:
                _, tokens = index.tokens(words_of(value))
                counts[np.unique(tokens)] += 1
        held = np.flatnonzero(counts)
        yield pd.DataFrame({"token": held, "n": counts[held]})

    rows = docs.select(F.coalesce(F.col(f"`{text}`"), F.lit("")).alias("t")).mapInPandas(run, "token long, n long")
    out = np.zeros(len(index.codes), dtype=np.int64)
    for r in rows.groupBy("token").agg(F.sum("n").alias("n")).collect():
        out[r["token"]] = r["n"]  # without counts, numbers are in the order of the codes
    return out


SCHEMA = "key long, n_words long, n_base long, first_word long, last_word long, base_labels string, labels string, score double"


def scan(docs: DataFrame, key: str = "doc_id", text: str = "text", templates: dict[str, str] = TEMPLATES, phrases: dict[str, str] = PHRASES, threshold: float = THRESHOLD) -> DataFrame:
    """Per row: n_words, base places and their positions, labels of both kinds, and a score: 1 with a base
    place, else the best template's containment (0 below the threshold)."""
    index = TemplateIndex(templates, token_counts(docs, templates, text), threshold)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = []
            for value in batch["t"]:
                words = words_of(value)
                found, shares = base_matches(words, phrases), index.match(words)
                own, places = {label for _, label in found}, [p for p, _ in found]
                labels = own | set(shares)
                score = 1.0 if found else max(shares.values(), default=0.0)
                rows.append((len(words), len(found), min(places, default=None), max(places, default=None), ",".join(sorted(own)), ",".join(sorted(labels)), score))
            out = pd.DataFrame(rows, columns=[c.split()[0] for c in SCHEMA.split(", ")][1:])
            out.insert(0, "key", ids_of(batch))
            yield out.astype({"first_word": "Int64", "last_word": "Int64"})

    rows = docs.select(*id_columns(key), F.coalesce(F.col(f"`{text}`"), F.lit("")).alias("t"))
    return rows.mapInPandas(run, SCHEMA).withColumnRenamed("key", key)
