"""Licence scan: windows of a text's words compared to licence templates by the Dice coefficient over word bigrams.

Both sides are lower-cased and reduced to words of letters and digits, so line breaks and comment marks do not matter. Bigrams
count as often as they occur. For each template, every window of the whole text competes; the best windows begin and end with one of
the template's bigrams. Sizes alone bound the coefficient by 2 min(a, b) / (a + b): a window of a template with n bigrams has at most
(2 - t) / t * n of its own and shares at least t / (2 - t) * n. So any choice of template bigrams that is larger than what a window
may lack shows up in each match; a text without any of them is done after one regular expression. Everything is one projection over
each document: no shuffle.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, functions as F

from watchspan.llm.common import unused

_DISCLAIMER = (
    "THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS \"AS IS\" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT "
    "LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT "
    "HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT "
    "LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY "
    "THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF "
    "THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE."
)
_BSD = (
    "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met: "
    "1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer. "
    "2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the "
    "documentation and/or other materials provided with the distribution. "
)
_MIT = (
    "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), "
    "to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, "
    "and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions:"
)
_ISC = (
    "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above "
    "copyright notice and this permission notice appear in all copies."
)

# Customary licence notices, and whole licences where these are short.
NOTICES = {
    "Apache-2.0": "Licensed under the Apache License, Version 2.0.",
    "Apache-2.0 header": "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License.",
    "Apache-2.0 header full": "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an \"AS IS\" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language governing permissions and limitations under the License.",
    "BSD": "Use of this source code is governed by a BSD-style license that can be found in the LICENSE file.",
    "BSD redistribution": "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:",
    "BSD-2-Clause full": _BSD + _DISCLAIMER,
    "BSD-3-Clause full": _BSD + "3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission. " + _DISCLAIMER,
    "CC-BY-4.0": "This work is licensed under a Creative Commons Attribution 4.0 International License.",
    "CC-BY-NC-4.0": "Licensed under CC BY-NC 4.0.",
    "CC-BY-SA-4.0": "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.",
    "GPL-3.0": "This work is licensed under the GNU General Public License, version 3.",
    "GPL later": "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.",
    "ISC": _ISC,
    "ISC full": _ISC + " THE SOFTWARE IS PROVIDED \"AS IS\" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE.",
    "MIT": "Released under the MIT License.",
    "MIT full": _MIT + " The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software. THE SOFTWARE IS PROVIDED \"AS IS\", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.",
    "MIT grant": _MIT,
    "MPL-2.0": "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
    "Zlib full": "This software is provided 'as-is', without any express or implied warranty. In no event will the authors be held liable for any damages arising from the use of this software. Permission is granted to anyone to use this software for any purpose, including commercial applications, and to alter it and redistribute it freely, subject to the following restrictions: 1. The origin of this software must not be misrepresented; you must not claim that you wrote the original software. If you use this software in a product, an acknowledgment in the product documentation would be appreciated but is not required. 2. Altered source versions must be plainly marked as such, and must not be misrepresented as being the original software. 3. This notice may not be removed or altered from any source distribution.",
}


def words_of(text: str) -> list[str]:
    return "".join(c if c.isascii() and c.isalnum() else " " for c in text).lower().split()


def tagged_bigrams(words: list[str]) -> list[str]:
    """Bigrams, those met before with their occurrence number, so that a set of them stands for a bag."""
    met: Counter = Counter()
    out = []
    for pair in zip(words, words[1:]):
        b = " ".join(pair)
        met[b] += 1
        out.append(b if met[b] == 1 else f"{b} {met[b]}")
    return out


class _Template:
    """A template's bigrams, and what its size allows of a window that reaches the threshold."""

    def __init__(self, name: str, text: str, threshold: float):
        words = words_of(text)
        self.name, self.bag = name, tagged_bigrams(words)
        self.counts = Counter(" ".join(p) for p in zip(words, words[1:]))
        self.n = len(self.bag)
        if not self.n:
            raise ValueError(f"template {name} has fewer than two words")
        self.shared = max(1, -int(-(threshold * self.n / (2 - threshold) - 1e-9) // 1))
        self.most = int(self.n * (2 - threshold) / threshold + 1e-9)

    def telling(self) -> list[str]:
        """Bigrams, the longest ones first, of which every match has one: together they occur more often than a match may lack."""
        lack, chosen = self.n - self.shared, []
        for gram in sorted(self.counts, key=lambda g: (-len(g), g)):
            chosen.append(gram)
            lack -= self.counts[gram]
            if lack < 0:
                return chosen
        return chosen


def _known(templates: dict[str, str] | None, threshold: float) -> list[_Template]:
    if not 0 < threshold <= 1:
        raise ValueError("the threshold must be above 0 and at most 1")
    return [_Template(name, text, threshold) for name, text in sorted((NOTICES if templates is None else templates).items())]


def _any_of(grams: set[str]) -> str:
    """A regular expression for one of the bigrams between blanks, by their first letters."""
    heads = sorted({g[0] for g in grams})
    return "(?<![^ ])(?:" + "|".join(f"{h}(?:{'|'.join(sorted(g[1:] for g in grams if g[0] == h))})" for h in heads) + ")(?![^ ])"


def scan(docs: DataFrame, templates: dict[str, str] | None = None, threshold: float = 0.8, text: str = "text") -> DataFrame:
    """docs with license_matches: array of (license, place, words, score), by license and place; place counts words from 1.

    For each template and each word, the best window that begins there is taken, the shortest one of equals, if it reaches the
    threshold; those that share a bigram with a better one of the same template (with an earlier one of equals) are left out. Null,
    empty and blank texts have no match; one word is no bigram. Rows that repeat are scanned each; a column of that name is replaced.
    """
    known = _known(templates, threshold)
    names = [c for c in docs.columns if c != "license_matches"]
    clean = F.trim(F.lower(F.regexp_replace(F.coalesce(F.col(f"`{text}`"), F.lit("")), "[^A-Za-z0-9]+", " ")))
    column = unused("_clean", names)
    none = F.array().cast("array<struct<license:string,place:int,words:int,score:double>>")
    if not known:
        return docs.select(*(F.col(f"`{c}`") for c in names), none.alias("license_matches"))
    every = sorted({g for t in known for g in t.counts})
    found = _let(_hits(F.col(column), every), lambda hits: F.flatten(F.array(*(_matches(hits, t, threshold) for t in known))))
    telling = F.col(column).rlike(_any_of({g for t in known for g in t.telling()}))
    base = docs.select(*(F.col(f"`{c}`") for c in names), clean.alias(column))
    return base.select(*(F.col(f"`{c}`") for c in names), F.when(telling, found).otherwise(none).alias("license_matches"))


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """The body with a value that is computed once, however often the body names it."""
    return F.element_at(F.transform(F.array(value), body), 1)


def _hits(clean: Column, grams: list[str]) -> Column:
    """The bigrams of a text that templates have, with their places, in order."""

    def placed(words: Column) -> Column:
        pairs = F.zip_with(F.slice(words, F.lit(1), F.size(words) - 1), F.slice(words, F.lit(2), F.size(words) - 1), lambda a, b: F.concat_ws(" ", a, b))
        return F.filter(F.transform(pairs, lambda g, i: F.struct((i + 1).cast("int").alias("place"), g.alias("gram"))), lambda h: h["gram"].isin(grams))

    return _let(F.split(clean, " "), placed)


def _matches(hits: Column, t: _Template, threshold: float) -> Column:
    """The matches of one template among the hits of all."""

    def starts(own: Column) -> Column:
        """Numbers of the hits from which enough others lie near enough."""
        all_of = F.when(F.size(own) >= t.shared, F.sequence(F.lit(1), F.size(own) - (t.shared - 1))).otherwise(F.array().cast("array<int>"))
        return F.filter(all_of, lambda k: F.element_at(own, k + (t.shared - 1))["place"] - F.element_at(own, k)["place"] < t.most)

    def best_from(near: Column) -> Column:
        """The best window from the first of the near hits."""
        first = F.element_at(near, 1)["place"]
        tags = _let(F.transform(near, lambda h: h["gram"]), _bag)
        flags = F.zip_with(near, tags, lambda h, tag: F.struct(h["place"].alias("place"), tag.isin(t.bag).cast("int").alias("counts")))
        zero = F.struct(F.lit(0).alias("shared"), F.lit(0.0).alias("score"), F.lit(0).alias("last"))

        def longer(best: Column, h: Column) -> Column:
            shared = best["shared"] + h["counts"]
            score = 2.0 * shared / (h["place"] - first + (1 + t.n))
            better = score > best["score"]
            return F.struct(shared.alias("shared"), F.greatest(score, best["score"]).alias("score"), F.when(better, h["place"]).otherwise(best["last"]).alias("last"))

        return F.aggregate(flags, zero, longer, lambda best: F.struct(first.alias("first"), best["last"].alias("last"), best["score"].alias("score")))

    def windows(own: Column) -> Column:
        def near(k: Column) -> Column:
            return F.filter(F.slice(own, k, F.lit(t.most)), lambda h: h["place"] - F.element_at(own, k)["place"] < t.most)

        return F.filter(F.transform(starts(own), lambda k: _let(near(k), best_from)), lambda w: w["score"] >= threshold)

    def not_beaten(found: Column) -> Column:
        """Windows begin at different words, so those that overlap one lie at most `most` before or after it."""

        def alone(w: Column, i: Column) -> Column:
            begin = F.greatest(i + 1 - t.most, F.lit(1))
            return ~F.exists(
                F.slice(found, begin, F.lit(2 * t.most)),
                lambda v: (v["first"] <= w["last"]) & (w["first"] <= v["last"]) & ((v["score"] > w["score"]) | ((v["score"] == w["score"]) & (v["first"] < w["first"]))),
            )

        return F.filter(found, alone)

    own = F.filter(hits, lambda h: h["gram"].isin(list(t.counts)))
    return F.transform(
        _let(_let(own, windows), not_beaten),
        lambda w: F.struct(F.lit(t.name).alias("license"), w["first"].alias("place"), (w["last"] - w["first"] + 2).alias("words"), w["score"].alias("score")),
    )


def _bag(pairs: Column) -> Column:
    """Bigrams, those met before with their occurrence number."""
    tagged = F.transform(pairs, lambda b, i: F.when(F.array_position(pairs, b) == i + 1, b).otherwise(F.concat_ws(" ", b, F.size(F.filter(F.slice(pairs, F.lit(1), i + 1), lambda x: x == b)).cast("string"))))
    return F.when(F.size(F.array_distinct(pairs)) == F.size(pairs), pairs).otherwise(tagged)


def license_sql(templates: dict[str, str] | None = None, threshold: float = 0.8) -> str:
    """Best licence and number of matches of each document in DuckDB: every window between two bigrams of a template, without bounds
    but for the size that a window may have."""
    known = _known(templates, threshold)
    values = ", ".join(f"('{t.name}', {t.n}, {t.most}, '{g}', {c})" for t in known for g, c in sorted(t.counts.items()))
    return f"""
WITH templates(name, n, most, gram, cap) AS (VALUES {values}),
clean AS (SELECT row_number() OVER () AS rid, doc_id, string_split(trim(lower(regexp_replace(coalesce(text, ''), '[^A-Za-z0-9]+', ' ', 'g'))), ' ') AS w FROM documents),
grams AS (SELECT rid, unnest(list_zip(w[:len(w) - 1], w[2:])) AS p, generate_subscripts(w[2:], 1) AS place FROM clean WHERE len(w) > 1),
hits AS (SELECT rid, place, name, n, most, gram, cap FROM (SELECT rid, place, p[1] || ' ' || p[2] AS gram FROM grams) JOIN templates USING (gram)),
numbered AS (SELECT *, row_number() OVER (PARTITION BY rid, name, gram ORDER BY place) AS nth FROM hits),
-- a bigram counts in the windows that begin after the one which is cap occurrences before it
counted AS (SELECT b.*, coalesce(a.place, 0) AS after FROM numbered b LEFT JOIN numbered a ON a.rid = b.rid AND a.name = b.name AND a.gram = b.gram AND a.nth = b.nth - b.cap),
scores AS (
  SELECT a.rid, a.name, a.place AS first, b.place AS last,
         2.0::DOUBLE * sum((b.after < a.place)::INT) OVER (PARTITION BY a.rid, a.name, a.place ORDER BY b.place) / (b.place - a.place + 1 + a.n) AS score
  FROM counted a JOIN counted b ON a.rid = b.rid AND a.name = b.name AND b.place >= a.place AND b.place < a.place + a.most),
best AS (SELECT rid, name, first, max(score) AS score, arg_min(last, (-score, last)) AS last FROM scores GROUP BY rid, name, first HAVING max(score) >= {threshold}::DOUBLE),
kept AS (
  SELECT * FROM best w WHERE NOT EXISTS (
    SELECT 1 FROM best v WHERE v.rid = w.rid AND v.name = w.name AND v.first <= w.last AND w.first <= v.last
      AND (v.score > w.score OR (v.score = w.score AND v.first < w.first)))),
told AS (SELECT rid, count(*) AS n, max(score) AS score, arg_min(name, (-score, name)) AS name FROM kept GROUP BY rid)
SELECT doc_id, coalesce(t.n, 0)::BIGINT AS n_matches, t.name AS license, t.score AS score FROM clean c LEFT JOIN told t USING (rid)"""
