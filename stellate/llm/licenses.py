"""Licence recognition from sentences, with DataFrame functions only.

A text is cut into pieces (at line ends, and at marks followed by a blank),
each is normalised (lower case, other characters, comment marks too, squeezed
to one blank).  A known licence sentence is a run of whole pieces of one
paragraph, so it may be wrapped over lines and hold marks itself; the longest
one counts.  A line without a letter or digit ends a paragraph.  The
identifiers found, in order, are matched from left to right against ordered licence rules, longer ones
first, so a full licence header wins over its first sentence alone.

Only texts that hold one of the ``ANCHORS`` are cut up; every known sentence
holds one, so no text is lost by that.  Null and empty texts and texts without
a known sentence give no row; rows are independent, so repeated ones give
equal rows; an empty table gives none.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

ANCHORS = ("licen", "permission", "warrant", "redistribut", "copyright", "public domain")

#: Normalised licence sentences and their identifiers.
SENTENCES = {
    "released under the mit license": "mit-name",
    "licensed under the mit license": "mit-name",
    "this project is licensed under the mit license": "mit-name",
    "the mit license mit": "mit-title",
    "mit license": "mit-title",
    "permission is hereby granted free of charge to any person obtaining a copy of this software and associated "
    "documentation files the software to deal in the software without restriction including without limitation the "
    "rights to use copy modify merge publish distribute sublicense and or sell copies of the software and to permit "
    "persons to whom the software is furnished to do so subject to the following conditions": "mit-grant",
    "the above copyright notice and this permission notice shall be included in all copies or substantial portions of "
    "the software": "mit-notice",
    "the software is provided as is without warranty of any kind express or implied including but not limited to the "
    "warranties of merchantability fitness for a particular purpose and noninfringement": "mit-warranty",
    "licensed under the apache license version 2 0": "apache-2",
    "licensed under the apache license version 2 0 the license": "apache-2",
    "you may not use this file except in compliance with the license": "apache-use",
    "you may obtain a copy of the license at": "apache-copy",
    "distributed under the license is distributed on an as is basis": "apache-basis",
    "see the license for the specific language governing permissions and limitations under the license": "apache-see",
    "this work is licensed under the gnu general public license version 3": "gpl-3-name",
    "this program is free software you can redistribute it and or modify it under the terms of the gnu general public "
    "license as published by the free software foundation either version 3 of the license or at your option any later "
    "version": "gpl-3-later",
    "this program is free software you can redistribute it and or modify it under the terms of the gnu general public "
    "license as published by the free software foundation either version 2 of the license or at your option any later "
    "version": "gpl-2-later",
    "see the gnu general public license for more details": "gpl-see",
    "you should have received a copy of the gnu general public license along with this program": "gpl-received",
    "licensed under cc by nc 4 0": "cc-by-nc-4",
    "licensed under cc by 4 0": "cc-by-4",
    "licensed under cc by sa 4 0": "cc-by-sa-4",
    "this work is licensed under a creative commons attribution 4 0 international license": "cc-by-4",
    "redistribution and use in source and binary forms with or without modification are permitted provided that the "
    "following conditions are met": "bsd-grant",
    "redistributions of source code must retain the above copyright notice this list of conditions and the following "
    "disclaimer": "bsd-source",
    "redistributions in binary form must reproduce the above copyright notice this list of conditions and the "
    "following disclaimer in the documentation and or other materials provided with the distribution": "bsd-binary",
    "neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote "
    "products derived from this software without specific prior written permission": "bsd-endorse",
    "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted "
    "provided that the above copyright notice and this permission notice appear in all copies": "isc-grant",
    "this source code form is subject to the terms of the mozilla public license v 2 0": "mpl-2",
    "this is free and unencumbered software released into the public domain": "unlicense",
    "all rights reserved under copyright": "reserved",
}

#: Ordered rules; a rule is a run of sentence identifiers.
RULES = (
    ("MIT", ("mit-title", "mit-grant", "mit-notice", "mit-warranty")),
    ("MIT", ("mit-grant", "mit-notice", "mit-warranty")),
    ("MIT", ("mit-grant", "mit-notice")),
    ("MIT", ("mit-grant",)),
    ("MIT", ("mit-name",)),
    ("Apache-2.0", ("apache-2", "apache-use", "apache-copy", "apache-basis", "apache-see")),
    ("Apache-2.0", ("apache-2", "apache-use", "apache-copy")),
    ("Apache-2.0", ("apache-2", "apache-use")),
    ("Apache-2.0", ("apache-2",)),
    ("GPL-3.0-or-later", ("gpl-3-later", "gpl-see", "gpl-received")),
    ("GPL-3.0-or-later", ("gpl-3-later",)),
    ("GPL-2.0-or-later", ("gpl-2-later", "gpl-see", "gpl-received")),
    ("GPL-2.0-or-later", ("gpl-2-later",)),
    ("GPL-3.0-only", ("gpl-3-name",)),
    ("CC-BY-NC-4.0", ("cc-by-nc-4",)),
    ("CC-BY-4.0", ("cc-by-4",)),
    ("CC-BY-SA-4.0", ("cc-by-sa-4",)),
    ("BSD-3-Clause", ("bsd-grant", "bsd-source", "bsd-binary", "bsd-endorse")),
    ("BSD-2-Clause", ("bsd-grant", "bsd-source", "bsd-binary")),
    ("ISC", ("isc-grant",)),
    ("MPL-2.0", ("mpl-2",)),
    ("Unlicense", ("unlicense",)),
)


def _run(ids) -> str:
    return "".join(f"{i}|" for i in ids)


def _patterns() -> str:
    longest_first = sorted((ids for _, ids in RULES), key=lambda ids: -len(ids))
    return "|".join(_run(ids).replace("|", "[|]") for ids in longest_first)


def _lookup(pairs: dict[str, str]) -> Column:
    return F.create_map(*[F.lit(x) for pair in pairs.items() for x in pair])


def _sentences() -> str:
    longest_first = sorted(SENTENCES, key=lambda s: -len(s))
    return "|".join(s.replace(" ", "[ |]") for s in longest_first)


def _pieces(text: Column) -> Column:
    """Normalised pieces, each between bars; two bars where a paragraph ends."""
    out = F.concat(F.lit("\n"), F.translate(F.lower(text), "|", "*"), F.lit("\n"))
    for pattern, new in ((r"[.!?;:][ \t]+", "|"), (r"[^a-z0-9|\n]+", " "), (r" ?([|\n]) ?", "$1"),
                         (r"[|]*\n[|]*", "\n"), (r"[|]+", "|"), (r"\n\n+", "||"), (r"\n", "|")):
        out = F.regexp_replace(out, pattern, new)
    return out


def scan_licenses(docs: DataFrame) -> DataFrame:
    """doc_id, n_sentences, sentence_ids and licenses (sorted) of the texts with a known sentence."""
    texts = docs.select("doc_id", F.col("text").alias("text")).filter(
        F.col("text").rlike("(?i)" + "|".join(ANCHORS).replace(" ", "[^a-zA-Z0-9]+")))
    known = _lookup(SENTENCES)
    runs = F.regexp_extract_all(_pieces(F.col("text")), F.lit(f"(?<=[|])({_sentences()})(?=[|])"), 1)
    ids = F.transform(runs, lambda s: F.element_at(known, F.translate(s, "|", " ")))
    found = texts.select("doc_id", ids.alias("ids")).filter(F.size("ids") > 0)
    joined = F.concat(F.array_join("ids", "|"), F.lit("|"))
    named = _lookup({_run(ids): name for name, ids in RULES})
    licenses = F.transform(F.regexp_extract_all(joined, F.lit(f"({_patterns()})"), 1), lambda x: F.element_at(named, x))
    return found.select("doc_id", F.size("ids").cast("long").alias("n_sentences"),
                        F.array_join("ids", "|").alias("sentence_ids"),
                        F.array_join(F.array_sort(F.array_distinct(licenses)), ",").alias("licenses"))


def _sql_map(pairs: dict[str, str]) -> str:
    return "MAP {" + ", ".join(f"'{k}': '{v}'" for k, v in pairs.items()) + "}"


def oracle() -> str:
    """The same result for DuckDB."""
    return f"""
WITH cut AS (
  SELECT doc_id, list_filter(list_transform(
           string_split(regexp_replace(text, '([.!?;:])[ \\t]+', '\\1' || chr(10), 'g'), chr(10)),
           lambda s: {_sql_map(SENTENCES)}[trim(regexp_replace(lower(s), '[^a-z0-9]+', ' ', 'g'))]), lambda x: x IS NOT NULL) AS ids
  FROM documents WHERE regexp_matches(lower(text), '{"|".join(ANCHORS)}')),
found AS (SELECT doc_id, ids FROM cut WHERE len(ids) > 0)
SELECT doc_id, CAST(len(ids) AS BIGINT) AS n_sentences, array_to_string(ids, '|') AS sentence_ids,
       array_to_string(list_sort(list_distinct(list_transform(
         regexp_extract_all(array_to_string(ids, '|') || '|', '({_patterns()})', 1),
         lambda x: {_sql_map({_run(ids): name for name, ids in RULES})}[x]))), ',') AS licenses
FROM found"""
