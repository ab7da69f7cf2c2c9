"""Licence scans: Dice coefficient over word bigrams against licence templates.

Compared are the whole text, its paragraphs (between blank lines) and its lines. Each
is lower-cased in A-Z and cut into runs of a-z and 0-9. A unit of n bigrams (all of
them count) can only reach the coefficient ``least`` with a template of between
n * least / (2 - least) and n * (2 - least) / least bigrams; these bounds are laid out
as a table from n to templates, so that a unit meets no other one.

Rows: documents without a match, null and empty texts give none. Rows that share a
doc_id count as one document. Columns other than doc_id and text are not read.
"""

from __future__ import annotations

import math
import re

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Notices by which licences are granted (fixed values).
TEMPLATES = {
    "Apache-2.0": "Licensed under the Apache License, Version 2.0.",
    "Apache-2.0-header": (
        "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in "
        "compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 "
        "Unless required by applicable law or agreed to in writing, software distributed under the License is distributed "
        "on an \"AS IS\" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License "
        "for the specific language governing permissions and limitations under the License."
    ),
    "MIT": "Released under the MIT License.",
    "MIT-text": (
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
        "documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation "
        "the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and "
        "to permit persons to whom the Software is furnished to do so, subject to the following conditions: The above "
        "copyright notice and this permission notice shall be included in all copies or substantial portions of the "
        "Software. THE SOFTWARE IS PROVIDED \"AS IS\", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT "
        "LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT "
        "SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION "
        "OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER "
        "DEALINGS IN THE SOFTWARE."
    ),
    "GPL-3.0": "This work is licensed under the GNU General Public License, version 3.",
    "GPL-header": (
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public "
        "License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any "
        "later version. This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without "
        "even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU General Public "
        "License for more details. You should have received a copy of the GNU General Public License along with this "
        "program. If not, see <https://www.gnu.org/licenses/>."
    ),
    "CC-BY-NC-4.0": "Licensed under CC BY-NC 4.0.",
    "CC-BY-4.0": "This work is licensed under a Creative Commons Attribution 4.0 International License.",
    "CC-BY-SA-4.0": "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.",
    "MPL-2.0": (
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not "
        "distributed with this file, You can obtain one at https://mozilla.org/MPL/2.0/."
    ),
    "BSD-header": "Use of this source code is governed by a BSD-style license that can be found in the LICENSE file.",
    "ISC": (
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby "
        "granted, provided that the above copyright notice and this permission notice appear in all copies."
    ),
}
LEAST = 0.85
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: Rows of the broadcast table of bounds; a larger set of templates is joined by a shuffle.
BROADCAST_ROWS = 20_000


def template_bigrams(text: str) -> list[str]:
    words = re.findall("[a-z0-9]+", text.lower())
    return sorted({f"{a} {b}" for a, b in zip(words, words[1:])})


def bounds(templates: dict[str, str], least: float) -> list[tuple[int, str, list[str]]]:
    """For each number of bigrams, the templates that a unit of this size may match."""
    return [
        (n, name, grams)
        for name, grams in ((k, template_bigrams(v)) for k, v in templates.items())
        for n in range(math.ceil(len(grams) * least / (2 - least)), math.floor(len(grams) * (2 - least) / least) + 1)
        if n
    ]


def license_scan(docs: DataFrame, templates: dict[str, str] | None = None, least: float = LEAST) -> DataFrame:
    """Best match of each document and licence: doc_id, license_id, dice, n_units (units that match)."""
    rows = bounds(templates or TEMPLATES, least)
    sizes = docs.sparkSession.createDataFrame(rows, "n long, license_id string, grams array<string>")
    if len(rows) <= BROADCAST_ROWS:
        sizes = F.broadcast(sizes)
    text = F.translate("text", UPPER, LOWER)
    units = F.array_distinct(F.concat(F.array(text), F.split(text, r"\n[ \t\r]*\n"), F.split(text, r"\n")))
    words = F.split(F.trim(F.regexp_replace("unit", "[^a-z0-9]+", " ")), " ")
    pairs = F.zip_with(
        F.slice("words", 1, F.size("words") - 1),
        F.slice("words", 2, F.size("words") - 1),
        lambda a, b: F.concat_ws(" ", a, b),
    )
    dice = 2.0 * F.size(F.array_intersect("pairs", "grams")) / (F.col("n") + F.size("grams"))
    return (
        docs.where("text is not null")
        .select("doc_id", F.explode(units).alias("unit"))
        .select("doc_id", words.alias("words"))
        .where(F.size("words") > 1)
        .withColumn("n", (F.size("words") - 1).cast("long"))
        .join(sizes, "n")
        .withColumn("pairs", pairs)
        .withColumn("dice", dice)
        .where(F.col("dice") >= least)
        .groupBy("doc_id", "license_id")
        .agg(F.max("dice").alias("dice"), F.count(F.lit(1)).alias("n_units"))
    )


def license_sql(templates: dict[str, str] | None = None, least: float = LEAST) -> str:
    """The same in DuckDB."""
    values = ",\n".join(
        "('{}', [{}])".format(k, ", ".join(f"'{g}'" for g in template_bigrams(v)))
        for k, v in (templates or TEMPLATES).items()
    )
    return f"""with templates(license_id, grams) as (values {values}),
low as (select doc_id, translate(text, '{UPPER}', '{LOWER}') as t from documents where text is not null),
units as (
  select doc_id, unnest(list_distinct(list_concat([t],
         regexp_split_to_array(t, '\\n[ \\t\\r]*\\n'), regexp_split_to_array(t, '\\n')))) as unit, row_id
  from (select *, row_number() over () as row_id from low) x),
words as (
  select doc_id, string_split(trim(regexp_replace(unit, '[^a-z0-9]+', ' ', 'g')), ' ') as w from units),
pairs as (
  select doc_id, len(w) - 1 as n,
         list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1]) as p
  from words where len(w) > 1),
scored as (
  select doc_id, license_id,
         cast(2.0 as double) * len(list_intersect(list_distinct(p), grams)) / (n + len(grams)) as dice
  from pairs join templates
    on n between len(grams) * {least} / (2 - {least}) and len(grams) * (2 - {least}) / {least})
select doc_id, license_id, max(dice) as dice, count(*) as n_units
from scored where dice >= {least} group by 1, 2"""
