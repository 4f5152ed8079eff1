"""Licence scan: Dice coefficient over word bigrams, in DataFrame operations only.

Texts are normalised to lower-case words of ASCII letters and digits. A unit is a line,
a paragraph of several lines, or a whole text of several paragraphs; it matches a
template when twice the number of common distinct bigrams is at least ``LEAST`` of the
sum of both numbers. Two sets of sizes a and b can only reach that if neither is larger
than (2 - LEAST) / LEAST times the other, so a template is compared with units of such
sizes alone; most units have the size of no template, or not one bigram of any, and
go at once. A unit of one word is its own bigram.

A notice may also share its line with other words. What no unit serves is searched once
more by windows (``notices``): for every template and every word at which one of its
bigrams starts, as many words as the template has, across line breaks. These windows
know the standard headers and the full texts of the short licences (``HEADERS``) besides
the templates. Of windows that overlap the one with most common bigrams stays.

Null text is empty. Units without words match nothing. Rows are judged one by one, so
repeated rows and ids do no harm; an empty table gives no rows; further columns are
not read. Ties go to the template that sorts first.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from rankloom.llm.common import query, table

LEAST = 0.8

#: Short notices and standard headers of public licences, as their stewards publish them.
TEMPLATES = {
    "AGPL-3.0": "This work is licensed under the GNU Affero General Public License, version 3.",
    "Apache-2.0": "Licensed under the Apache License, Version 2.0.",
    "Apache-2.0-header": (
        'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the License. '
        "You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 "
        'Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an "AS IS" BASIS, '
        "WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. "
        "See the License for the specific language governing permissions and limitations under the License."
    ),
    "BSD-3-Clause": "Released under the BSD 3-Clause License.",
    "CC-BY-4.0": "Licensed under CC BY 4.0.",
    "CC-BY-NC-4.0": "Licensed under CC BY-NC 4.0.",
    "CC-BY-SA-4.0": "Licensed under CC BY-SA 4.0.",
    "GPL-2.0": "This work is licensed under the GNU General Public License, version 2.",
    "GPL-3.0": "This work is licensed under the GNU General Public License, version 3.",
    "ISC": (
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, "
        "provided that the above copyright notice and this permission notice appear in all copies."
    ),
    "LGPL-3.0": "This work is licensed under the GNU Lesser General Public License, version 3.",
    "MIT": "Released under the MIT License.",
    "MIT-grant": (
        'Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the "Software"), '
        "to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, "
        "and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions: "
        "The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software."
    ),
    "MPL-2.0": "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
}


_NO_WARRANTY = (
    "This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of "
    "MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU {kind}General Public License for more details."
)


def _gnu(kind: str, version: str) -> str:
    return (
        "This program is free software: you can redistribute it and/or modify it under the terms of the "
        f"GNU {kind}General Public License as published by the Free Software Foundation, either version {version} of the License, "
        "or (at your option) any later version. " + _NO_WARRANTY.format(kind=kind)
    )


_BSD_2 = (
    "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met: "
    "1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer. "
    "2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer "
    "in the documentation and/or other materials provided with the distribution. "
)
_BSD_3 = (
    "3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products "
    "derived from this software without specific prior written permission. "
)
_BSD_END = (
    'THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, '
    "THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS "
    "BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE "
    "GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT "
    "LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE."
)

#: Standard headers and full texts of the short licences, for windows only.
HEADERS = {
    "AGPL-3.0-header": _gnu("Affero ", "3"),
    "BSD-2-Clause-text": _BSD_2 + _BSD_END,
    "BSD-3-Clause-text": _BSD_2 + _BSD_3 + _BSD_END,
    "GPL-2.0-header": _gnu("", "2"),
    "GPL-3.0-header": _gnu("", "3"),
    "ISC-text": TEMPLATES["ISC"]
    + ' THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY '
    "AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM "
    "LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR "
    "PERFORMANCE OF THIS SOFTWARE.",
    "LGPL-3.0-header": _gnu("Lesser ", "3"),
    "MIT-text": TEMPLATES["MIT-grant"]
    + ' THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS '
    "FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER "
    "IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.",
    "MPL-2.0-header": (
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with this file, "
        "You can obtain one at https://mozilla.org/MPL/2.0/."
    ),
}
#: Stands for a unit that is served; no template has the word.
SERVED = "servedbyaunit"


def words_of(text: Column) -> Column:
    lowered = F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    return F.filter(F.split(F.regexp_replace(lowered, "[^a-z0-9]+", " "), " "), lambda w: w != "")


def bigrams_of(words: Column) -> Column:
    pairs = F.zip_with(words, F.slice(words, 2, F.greatest(F.size(words), F.lit(1))), lambda a, b: F.concat_ws(" ", a, b))
    return F.array_distinct(F.when(F.size(words) > 1, F.slice(pairs, 1, F.size(words) - 1)).otherwise(words))


def _words(text: str) -> list[str]:
    return "".join(c.lower() if c.isascii() and c.isalnum() else " " for c in text).split()


def _sides(name: str, text: str) -> tuple[str, list[str]]:
    """Bigrams of a template, by the rule of the columns."""
    words = _words(text)
    return name, list(dict.fromkeys(" ".join(p) for p in zip(words, words[1:])) if len(words) > 1 else dict.fromkeys(words))


def units(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(row, id, unit, words): lines, paragraphs of several lines, texts of several paragraphs."""
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    named = docs.select(F.col(id_col), text.alias("_text")).withColumn("_paragraphs", F.split("_text", r"\n[ \t]*\n"))
    lines = F.transform(F.split("_text", "\n"), lambda t, i: F.struct(F.concat(F.lit("line "), i + 1).alias("unit"), t.alias("t")))
    blocks = F.transform("_paragraphs", lambda t, i: F.struct(F.concat(F.lit("paragraph "), i + 1).alias("unit"), t.alias("t")))
    blocks = F.filter(blocks, lambda u: u["t"].contains("\n"))
    whole = F.when(F.size("_paragraphs") > 1, F.array(F.struct(F.lit("text").alias("unit"), F.col("_text").alias("t")))).otherwise(F.array().cast("array<struct<unit:string,t:string>>"))
    return named.withColumn("_units", F.concat(lines, blocks, whole))


def _unit_matches(docs: DataFrame, id_col: str, text_col: str, templates: dict[str, str], least: float) -> DataFrame:
    """One row per document row: id, ``_text``, ``_kept`` (unit, text, dice, licence)."""
    known = [_sides(n, t) for n, t in sorted(templates.items())]
    ratio = (2 - least) / least
    every = F.lit(sorted({b for _, bs in known for b in bs}))
    most = max(len(bs) for _, bs in known) * ratio

    def best(grams: Column) -> Column:
        """Highest (dice, licence) among templates of a fitting size."""
        n = F.size(grams)
        found = []
        for name, bs in known:
            fits = (n <= len(bs) * ratio + 1e-9) & (n * ratio + 1e-9 >= len(bs))
            dice = F.size(F.array_intersect(grams, F.lit(bs))) * 2.0 / (n + len(bs))
            found.append(F.when(fits, F.struct(dice.alias("dice"), F.lit(name).alias("licence"))))
        kept = F.filter(F.array_compact(F.array(*found)), lambda m: m["dice"] >= least)
        return F.aggregate(kept, F.struct(F.lit(0.0).alias("dice"), F.lit("").alias("licence")), lambda a, m: F.when(m["dice"] > a["dice"], m).otherwise(a))

    def grams(words: Column) -> Column:
        # n different words make n - 1 different bigrams at least, so long units go before their bigrams are made.
        return F.when(F.size(F.array_distinct(words)) - 1 <= most, bigrams_of(words)).otherwise(F.array().cast("array<string>"))

    def match(u: Column) -> Column:
        # Over an array of one, so that the words are made once.
        return F.transform(F.array(words_of(u["t"])), lambda w: F.struct(u["unit"].alias("unit"), u["t"].alias("t"), grams(w).alias("g")))[0]

    with_grams = F.transform("_units", match)
    possible = F.filter(with_grams, lambda u: F.size(u["g"]).between(1, F.lit(most)) & F.arrays_overlap(u["g"], every))
    df = units(docs, id_col, text_col).select(id_col, "_text", possible.alias("_possible"))
    scored = F.transform("_possible", lambda u: F.struct(u["unit"].alias("unit"), u["t"].alias("t"), best(u["g"]).alias("b")))
    kept = F.filter(scored, lambda u: u["b"]["licence"] != "")
    return df.select(id_col, "_text", kept.alias("_kept"))


def _as_matches(kept: Column) -> Column:
    return F.transform(kept, lambda u: F.struct(u["unit"].alias("unit"), u["b"]["licence"].alias("licence"), u["b"]["dice"].alias("dice")))


def licence_matches(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", templates: dict[str, str] = TEMPLATES, least: float = LEAST) -> DataFrame:
    """One row per document row: ``matches``, an array of (unit, licence, dice) in the order of the units."""
    return _unit_matches(docs, id_col, text_col, templates, least).select(id_col, _as_matches(F.col("_kept")).alias("matches"))


def all_matches(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    templates: dict[str, str] = TEMPLATES,
    headers: dict[str, str] = HEADERS,
    least: float = LEAST,
) -> DataFrame:
    """The rows of :func:`licence_matches` with ``notices`` besides: windows outside the matching units, in their order."""
    df = _unit_matches(docs, id_col, text_col, templates, least)
    served = F.transform("_kept", lambda u: u["t"])
    lines = lambda p: F.transform(F.split(p, "\n"), lambda t: F.when(F.array_contains(served, t), F.lit(SERVED)).otherwise(t))
    paragraphs = F.transform(F.split("_text", r"\n[ \t]*\n"), lambda p: F.when(F.array_contains(served, p), F.lit(SERVED)).otherwise(F.array_join(lines(p), "\n")))
    rest = F.when(F.size("_kept") == 0, F.col("_text")).when(F.array_contains(served, F.col("_text")), F.lit("")).otherwise(F.array_join(paragraphs, "\n"))
    df = df.select(id_col, _as_matches(F.col("_kept")).alias("matches"), words_of(rest).alias("_w"))
    return _with_notices(df, {**templates, **headers}, least).select(id_col, "matches", "notices")


def _with_notices(df: DataFrame, templates: dict[str, str], least: float) -> DataFrame:
    known = [(*_sides(n, t), len(_words(t))) for n, t in sorted(templates.items())]
    known = [k for k in known if k[2] > 1]
    every = sorted({b for _, bs, _ in known for b in bs})
    pairs = F.zip_with("_w", F.slice("_w", 2, F.greatest(F.size("_w"), F.lit(1))), lambda a, b: F.concat_ws(" ", a, b))
    placed = F.filter(F.transform(pairs, lambda b, i: F.when(b.isin(every), F.struct(i.alias("i"), b.alias("b")))), lambda s: s.isNotNull())
    df = df.withColumn("_at", placed)
    # A window of no more bigrams than the common ones and the rest must share this part of the template.
    part = least / (2 - least)
    met = F.array_distinct(F.transform("_at", lambda s: s["b"]))
    df = df.withColumn("_met", met)
    can = [F.when(F.size("_met") >= part * len(bs) - 1e-9, F.when(F.size(F.array_intersect("_met", F.lit(bs))) >= part * len(bs) - 1e-9, F.lit(n))) for n, bs, _ in known]
    df = df.withColumn("_can", F.array_compact(F.array(*can)))
    grams = F.create_map(*[x for n, bs, _ in known for x in (F.lit(n), F.lit(bs))])
    width = F.create_map(*[x for n, _, m in known for x in (F.lit(n), F.lit(m))])

    def windows(name: Column, own: Column, m: Column) -> Column:
        def window(s: Column) -> Column:
            mine = F.array(bigrams_of(F.slice("_w", s["i"] + 1, m)))
            counts = F.transform(mine, lambda g: F.struct(F.size(F.array_intersect(g, own)).alias("common"), F.size(g).alias("n")))
            return F.transform(
                counts,
                lambda c: F.struct(
                    (-c["common"]).alias("fewer"),
                    (-(c["common"] * 2.0 / (c["n"] + F.size(own)))).alias("less"),
                    name.alias("licence"),
                    s["i"].alias("start"),
                    F.least(s["i"] + m, F.size("_w")).alias("end"),
                ),
            )[0]

        return F.filter(F.transform(F.filter("_at", lambda s: F.array_contains(own, s["b"])), window), lambda x: -x["less"] >= least)

    found = F.flatten(F.transform("_can", lambda n: windows(n, F.element_at(grams, n), F.element_at(width, n))))
    kind = "array<struct<fewer:int,less:double,licence:string,start:int,end:int>>"
    df = df.withColumn("_found", F.when(F.size("_can") > 0, F.array_sort(found)).cast(kind))
    clear = lambda a, x: ~F.exists(a, lambda y: (x["start"] < y["end"]) & (y["start"] < x["end"]))
    taken = F.aggregate(F.coalesce("_found", F.array().cast(kind)), F.array().cast(kind), lambda a, x: F.when(clear(a, x), F.concat(a, F.array(x))).otherwise(a))
    by_start = F.array_sort(F.transform(taken, lambda x: F.struct(x["start"].alias("start"), x["end"].alias("end"), x["licence"].alias("licence"), (-x["less"]).alias("dice"))))
    unit = lambda x: F.concat(F.lit("words "), x["start"] + 1, F.lit("-"), x["end"])
    return df.withColumn("notices", F.transform(by_start, lambda x: F.struct(unit(x).alias("unit"), x["licence"].alias("licence"), x["dice"].alias("dice"))))


_W = "list_filter(string_split(regexp_replace(translate({t}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^a-z0-9]+', ' ', 'g'), ' '), lambda x: x <> '')"
_G = "list_distinct(CASE WHEN len(w) > 1 THEN list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1]) ELSE w END)"


def _sql() -> str:
    rows = ", ".join("('{}', '{}')".format(n, t.replace("'", "''")) for n, t in sorted(TEMPLATES.items()))
    return f"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS text FROM documents),
p AS (SELECT r, text, string_split_regex(text, '\\n[ \\t]*\\n') AS ps FROM d),
u AS (
  SELECT r, unnest(string_split(text, chr(10))) AS t FROM p
  UNION ALL SELECT r, t FROM (SELECT r, unnest(ps) AS t FROM p) WHERE contains(t, chr(10))
  UNION ALL SELECT r, text FROM p WHERE len(ps) > 1),
g AS (SELECT r, row_number() OVER () AS unit, {_G} AS g FROM (SELECT r, {_W.format(t="t")} AS w FROM u)),
k AS (SELECT licence, {_G} AS k FROM (SELECT licence, {_W.format(t="body")} AS w FROM (VALUES {rows}) v(licence, body))),
m AS (SELECT r, unit, licence, 2.0::DOUBLE * len(list_intersect(g, k)) / (len(g) + len(k)) AS dice FROM g JOIN k ON list_has_any(g, k)),
b AS (SELECT r, unit, max(dice) AS dice FROM m WHERE dice >= {LEAST} GROUP BY r, unit),
n AS (SELECT r, unit, b.dice, min(licence) AS licence FROM m JOIN b USING (r, unit) WHERE m.dice = b.dice GROUP BY r, unit, b.dice),
s AS (SELECT r, count(*) AS c, string_agg(DISTINCT licence, ',' ORDER BY licence) AS licences, max(dice) AS dice FROM n GROUP BY r)
SELECT doc_id, coalesce(c, 0)::BIGINT AS n_matches, coalesce(licences, '') AS licences, coalesce(dice, 0.0)::DOUBLE AS best_dice
FROM d LEFT JOIN s USING (r)
"""


@query("op7_licence_dice", _sql())
def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = all_matches(table(spark, sf_dir, "documents")).select("doc_id", F.concat("matches", "notices").alias("matches"))
    names = F.array_sort(F.array_distinct(F.transform("matches", lambda m: m["licence"])))
    return found.select(
        "doc_id",
        F.size("matches").cast("bigint").alias("n_matches"),
        F.array_join(names, ",").alias("licences"),
        F.coalesce(F.array_max(F.transform("matches", lambda m: m["dice"])), F.lit(0.0)).alias("best_dice"),
    )
