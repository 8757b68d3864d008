"""License scans by sentences, with built-in functions only.

A text is normalised (lower case, letters and digits, single spaces, signs for the ends of
lines and sentences), and known licence sentences are looked for in it. The identifiers found, in order, are
matched against ordered rules, longest first: a rule that fits takes its sentences away, so
a short rule never claims a part of a longer licence. What no rule takes is reported.

Only texts with one of the anchor words are cut up; every known sentence has one.

Defined cases: a known sentence negated in its line is none; a null or empty text has no sentence and no licence; a licence named twice is
reported once; repeated rows are judged each; other columns are left out; an empty
table gives an empty table.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Words of which every known sentence has one.
ANCHORS = "licen[sc]e|permission|warrant|redistribut|copyright|public domain|liable|endorse|implied"

# Sentences of public licence texts and notices, by identifier.
SENTENCES = {
    "apache-notice": "Licensed under the Apache License, Version 2.0.",
    "apache-grant": 'Licensed under the Apache License, Version 2.0 (the "License");',
    "apache-comply": "you may not use this file except in compliance with the License.",
    "apache-copy": "You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0",
    "apache-as-is": "Unless required by applicable law or agreed to in writing, software distributed under the License is "
    'distributed on an "AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied.',
    "apache-see": "See the License for the specific language governing permissions and limitations under the License.",
    "mit-notice": "Released under the MIT License.",
    "mit-licensed": "Licensed under the MIT License.",
    "mit-grant": "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and "
    'associated documentation files (the "Software"), to deal in the Software without restriction, including without '
    "limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the "
    "Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions:",
    "mit-condition": "The above copyright notice and this permission notice shall be included in all copies or "
    "substantial portions of the Software.",
    "as-is-implied": 'THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT '
    "NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT.",
    "not-liable": "IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, "
    "WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE "
    "USE OR OTHER DEALINGS IN THE SOFTWARE.",
    "bsd-grant": "Redistribution and use in source and binary forms, with or without modification, are permitted provided "
    "that the following conditions are met:",
    "bsd-source": "Redistributions of source code must retain the above copyright notice, this list of conditions and the "
    "following disclaimer.",
    "bsd-binary": "Redistributions in binary form must reproduce the above copyright notice, this list of conditions and "
    "the following disclaimer in the documentation and/or other materials provided with the distribution.",
    "bsd-endorse": "Neither the name of the copyright holder nor the names of its contributors may be used to endorse or "
    "promote products derived from this software without specific prior written permission.",
    "isc-grant": "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is "
    "hereby granted, provided that the above copyright notice and this permission notice appear in all copies.",
    "gpl3-notice": "This work is licensed under the GNU General Public License, version 3.",
    "gpl-share": "This program is free software: you can redistribute it and/or modify it under the terms of the GNU "
    "General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your "
    "option) any later version.",
    "gpl-hope": "This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY;",
    "gpl-merchant": "without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE.",
    "gpl-see": "See the GNU General Public License for more details.",
    "cc-by-nc-notice": "Licensed under CC BY-NC 4.0.",
    "cc-by-notice": "Licensed under CC BY 4.0.",
    "cc0-notice": "This work is dedicated to the public domain under CC0 1.0.",
}

# Licences by the order of their sentences; longer orders come first.
RULES = (
    ("GPL-3.0-or-later", ("gpl-share", "gpl-hope", "gpl-merchant", "gpl-see")),
    ("Apache-2.0", ("apache-grant", "apache-comply", "apache-copy", "apache-as-is", "apache-see")),
    ("BSD-3-Clause", ("bsd-grant", "bsd-source", "bsd-binary", "bsd-endorse")),
    ("MIT", ("mit-grant", "mit-condition", "as-is-implied", "not-liable")),
    ("BSD-2-Clause", ("bsd-grant", "bsd-source", "bsd-binary")),
    ("MIT", ("mit-grant", "mit-condition")),
    ("GPL-3.0-or-later", ("gpl-share",)),
    ("Apache-2.0", ("apache-grant",)),
    ("ISC", ("isc-grant",)),
    ("GPL-3.0-only", ("gpl3-notice",)),
    ("Apache-2.0", ("apache-notice",)),
    ("MIT", ("mit-notice",)),
    ("MIT", ("mit-licensed",)),
    ("CC-BY-NC-4.0", ("cc-by-nc-notice",)),
    ("CC-BY-4.0", ("cc-by-notice",)),
    ("CC0-1.0", ("cc0-notice",)),
)

# Words that turn a known sentence after them, with at most eight words between, into another one.
NEGATIONS = "not|[a-z]+n t|cannot|never|neither|nor|no longer|formerly|previously"


def normal(sentence: str) -> str:
    return re.sub("[^a-z0-9]+", " ", sentence.lower()).strip()


def _signed(text: Column) -> Column:
    """Normalised text in which E stands for the end of a sentence and L for that of a line."""
    ends = F.regexp_replace(F.regexp_replace(F.lower(text), r"[.!?;:]\s+", "E"), "\n", "L")
    return F.trim(F.regexp_replace(F.regexp_replace(ends, "[^a-z0-9EL]+", " "), " ?([EL]) ?", "$1"))


def _pattern() -> str:
    """Any known sentence, the longest first, or one that is negated before it in its line.

    It may begin inside a line, but ends with a line or sentence of the text: what goes on, as
    in "version 3 or later", says something else. Its words may run over lines, also empty ones and those of
    comment marks, and over an end of a sentence where it has one itself.
    """
    by_first: dict[str, list[str]] = {}
    for sentence in sorted(SENTENCES.values(), key=lambda s: -len(normal(s))):
        parts = [normal(part) for part in re.split(r"(?<=[.!?;:])\s+", sentence)]
        first, _, rest = "[ LE]+".join(part.replace(" ", "[ L]+") for part in parts).partition("[ L]+")
        by_first.setdefault(first, []).append(rest)
    known = "|".join(f"{first}[ L]+(?:{'|'.join(rest)})" for first, rest in by_first.items())
    return f"(?<![a-z0-9])(?:(?:{NEGATIONS}) (?:[a-z0-9]+ ){{0,8}}?)?(?:{known})(?![a-z0-9 ])"


def sentence_ids(text: Column) -> Column:
    """Identifiers of the known sentences of a text, in order."""
    pairs = [F.lit(x) for name, sentence in SENTENCES.items() for x in (normal(sentence), name)]
    known = F.create_map(*pairs)
    spans = F.regexp_extract_all(_signed(text), F.lit(_pattern()), F.lit(0))
    found = F.transform(spans, lambda s: known[F.regexp_replace(s, "[EL ]+", " ")])
    anchored = F.filter(found, lambda name: name.isNotNull())
    none = F.array().cast("array<string>")
    return F.when(F.coalesce(text, F.lit("")).rlike(f"(?i)({ANCHORS})"), anchored).otherwise(none)


def matched(ids: Column) -> Column:
    """Struct with the licences found and the identifiers that no rule took."""
    table = F.array(
        *[F.struct(F.lit(name).alias("name"), F.lit(_sequence(order)).alias("order")) for name, order in RULES]
    )
    start = F.struct(
        F.concat_ws("", F.transform(ids, lambda i: F.concat(F.lit("<"), i, F.lit(">")))).alias("left"),
        F.array().cast("array<string>").alias("found"),
    )
    return F.aggregate(
        table,
        start,
        lambda s, rule: F.when(
            F.contains(s["left"], rule["order"]),
            F.struct(
                F.replace(s["left"], rule["order"], F.lit("|")).alias("left"),
                F.array_union(s["found"], F.array(rule["name"])).alias("found"),
            ),
        ).otherwise(s),
    )


def _sequence(order: tuple[str, ...]) -> str:
    return "".join(f"<{name}>" for name in order)


def scan(df: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Key, number of known sentences, ``sentences``, ``licenses`` and ``unmatched`` of every row.

    The last three are lists joined by commas, null if empty; licences stand in the order of the rules.
    """
    found = df.select(F.col(key), sentence_ids(F.col(text)).alias("ids"))
    answer = found.withColumn("match", F.when(F.size("ids") > 0, matched(F.col("ids"))))

    def joined(values: Column) -> Column:
        return F.when(F.size(values) > 0, F.concat_ws(",", values))

    left = F.filter(F.split(F.col("match")["left"], "[<>|]+"), lambda name: name != "")
    return answer.select(
        key,
        F.size("ids").cast("long").alias("n_sentences"),
        joined(F.col("ids")).alias("sentences"),
        joined(F.col("match")["found"]).alias("licenses"),
        joined(left).alias("unmatched"),
    )


def scan_sql() -> str:
    """The same scan as SQL over ``documents``: a step for each rule."""
    known = ", ".join(f"('{normal(sentence)}', '{name}')" for name, sentence in SENTENCES.items())
    norm = "trim(regexp_replace(lower({}), '[^a-z0-9]+', ' ', 'g'))".format
    steps, last = [], "s0"
    for n, (name, order) in enumerate(RULES, 1):
        seq = _sequence(order)
        steps.append(
            f"s{n} AS (SELECT row, doc_id, ids, CASE WHEN contains(rest, '{seq}') AND NOT list_contains(found, '{name}') "
            f"THEN list_append(found, '{name}') ELSE found END AS found, replace(rest, '{seq}', '|') AS rest FROM {last})"
        )
        last = f"s{n}"
    return f"""
WITH known(sentence, name) AS (VALUES {known}),
docs AS (SELECT row_number() OVER () AS row, doc_id, text FROM documents),
pieces AS (SELECT row, unnest(p) AS piece, unnest(range(len(p))) AS place FROM (SELECT row, string_split(
    regexp_replace(text, '([.!?;:])\\s+|\\n\\s*\\n', '\\1' || chr(31), 'g'), chr(31)) AS p
    FROM docs WHERE regexp_matches(text, '(?i)({ANCHORS})'))),
single AS (SELECT row, place, unnest(l) AS line, unnest(range(len(l))) AS part FROM (
    SELECT row, place, CASE WHEN k.name IS NULL THEN string_split(piece, chr(10)) ELSE [piece] END AS l
    FROM pieces LEFT JOIN known k ON k.sentence = {norm('piece')})),
hits AS (SELECT row, list(name ORDER BY place, part) AS ids FROM single JOIN known ON sentence = {norm('line')} GROUP BY row),
s0 AS (SELECT d.row, doc_id, coalesce(ids, []) AS ids, []::VARCHAR[] AS found,
    array_to_string(list_transform(coalesce(ids, []), lambda x: '<' || x || '>'), '') AS rest FROM docs d LEFT JOIN hits h ON d.row = h.row),
{', '.join(steps)}
SELECT doc_id, len(ids)::BIGINT AS n_sentences, nullif(array_to_string(ids, ','), '') AS sentences,
    nullif(array_to_string(found, ','), '') AS licenses,
    nullif(array_to_string(list_filter(string_split_regex(rest, '[<>|]+'), lambda x: x <> ''), ','), '') AS unmatched FROM {last}"""
