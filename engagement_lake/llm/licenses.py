"""License scans by sentence rules, in built-in functions only.

A text is split into sentences, each normalised sentence that is known maps to its identifier, and
the identifiers, in the order of the text, are matched against ordered rules: a rule takes the runs
of identifiers that spell its license, longer rules before shorter ones. A sentence that speaks of
licensing but is not known counts as unknown.

Licenses are often wrapped over lines and as often a line of their own. So a text is read twice,
with line ends as sentence ends and as spaces, and the reading that recognises more sentences
counts (the first, if equal).

Cases: a null or empty text has no license; repeated rows are scanned each; all columns but the key
are left out. An empty table gives no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from engagement_lake.llm.store import read

_GNU = (
    "you can redistribute it and or modify it under the terms of the gnu {}general public license as published"
    " by the free software foundation {}"
)
_LATER = " of the license or at your option any later version"
_ENDORSE = (
    " the names of its contributors may be used to endorse or promote products derived from this software"
    " without specific prior written permission"
)
# Normalised sentences (lower case, runs of other than a-z and 0-9 as one space) by
# which licenses are granted, and the licenses they spell, one after another.
SENTENCES = {
    "a1": "licensed under the apache license version 2 0",
    "a2": "licensed under the apache license version 2 0 the license",
    "a3": "you may not use this file except in compliance with the license",
    "a4": "you may obtain a copy of the license at",
    "m1": "released under the mit license",
    "m2": "licensed under the mit license",
    "m3": "permission is hereby granted free of charge to any person obtaining a copy of this software",
    "g1": "this work is licensed under the gnu general public license version 3",
    "g2": "this program is free software you can redistribute it and or modify it under the terms of the"
    " gnu general public license as published by the free software foundation either version 3 of the"
    " license or at your option any later version",
    "g3": "this program is licensed under the gnu general public license version 2",
    "c1": "licensed under cc by nc 4 0",
    "c2": "licensed under cc by 4 0",
    "c3": "licensed under cc by sa 4 0",
    "c4": "this work is licensed under a creative commons attribution 4 0 international license",
    "b1": "redistribution and use in source and binary forms with or without modification are permitted"
    " provided that the following conditions are met",
    "b2": "redistributions of source code must retain the above copyright notice this list of conditions"
    " and the following disclaimer",
    "b3": "redistributions in binary form must reproduce the above copyright notice",
    # Of the standard texts and headers, as splitting at marks leaves them.
    "a5": "unless required by applicable law or agreed to in writing software distributed under the license is"
    " distributed on an as is basis without warranties or conditions of any kind either express or implied",
    "a6": "see the license for the specific language governing permissions and limitations under the license",
    "a7": "this project is licensed under the apache license 2 0",
    "m4": "permission is hereby granted free of charge to any person obtaining a copy of this software and"
    " associated documentation files the software to deal in the software without restriction including"
    " without limitation the rights to use copy modify merge publish distribute sublicense and or sell copies"
    " of the software and to permit persons to whom the software is furnished to do so subject to the"
    " following conditions",
    "m5": "the above copyright notice and this permission notice shall be included in all copies or"
    " substantial portions of the software",
    "m6": "this project is licensed under the mit license",
    "m7": "this project is licensed under the mit license see the license file for details",
    "g4": "this program is free software",
    "g5": _GNU.format("", "either version 3" + _LATER),
    "g6": _GNU.format("", "either version 2" + _LATER),
    "g7": _GNU.format("", "version 2"),
    "g8": "this library is free software",
    "l1": _GNU.format("lesser ", "either version 2 1" + _LATER),
    "l2": _GNU.format("lesser ", "either version 3" + _LATER),
    "l3": _GNU.format("affero ", "either version 3" + _LATER),
    "g9": "see the gnu general public license for more details",
    "b4": "redistributions in binary form must reproduce the above copyright notice this list of conditions"
    " and the following disclaimer in the documentation and or other materials provided with the distribution",
    "b5": "neither the name of the copyright holder nor" + _ENDORSE,
    "b6": "nor" + _ENDORSE,
    "i1": "permission to use copy modify and or distribute this software for any purpose with or without fee is"
    " hereby granted provided that the above copyright notice and this permission notice appear in all copies",
    "p1": "this source code form is subject to the terms of the mozilla public license v",
    "z1": "all rights reserved",
    "z2": "no license is granted",
}
RULES = (
    (("a2", "a3", "a4"), "Apache-2.0"),
    (("b1", "b2", "b4", "b5"), "BSD-3-Clause"),
    (("b1", "b2", "b4", "b6"), "BSD-3-Clause"),
    (("b1", "b2", "b4"), "BSD-2-Clause"),
    (("b1", "b2", "b3"), "BSD-2-Clause"),
    (("a2", "a3"), "Apache-2.0"),
    (("a1", "a3"), "Apache-2.0"),
    (("a1",), "Apache-2.0"),
    (("m1",), "MIT"),
    (("m2",), "MIT"),
    (("m3",), "MIT"),
    (("g1",), "GPL-3.0-only"),
    (("g2",), "GPL-3.0-or-later"),
    (("g3",), "GPL-2.0-only"),
    (("c1",), "CC-BY-NC-4.0"),
    (("c2",), "CC-BY-4.0"),
    (("c4",), "CC-BY-4.0"),
    (("c3",), "CC-BY-SA-4.0"),
    (("a7",), "Apache-2.0"),
    (("m4",), "MIT"),
    (("m6",), "MIT"),
    (("m7",), "MIT"),
    (("g5",), "GPL-3.0-or-later"),
    (("g6",), "GPL-2.0-or-later"),
    (("g7",), "GPL-2.0-only"),
    (("l1",), "LGPL-2.1-or-later"),
    (("l2",), "LGPL-3.0-or-later"),
    (("l3",), "AGPL-3.0-or-later"),
    (("i1",), "ISC"),
    (("p1",), "MPL-2.0"),
    (("z1",), "Proprietary"),
    (("z2",), "Proprietary"),
)
# What follows a grant as well as a refusal: it names a licence only where no other rule has matched before.
YIELDING = (("z1",),)
# A sentence without any of these is never known, so it need not be normalised.
CUES = ("licens", "compliance", "permission", "free software", "redistribution", "rights reserved")
_BREAK = "\x0b"


def _sentences(text: Column, line_ends: bool) -> Column:
    """Sentences that hold a cue, normalised."""
    ended = F.regexp_replace(text, r"([.!?;:])[ \t\r\n\f]+", "$1" + _BREAK)
    ended = F.regexp_replace(ended, r"\n" if line_ends else r"\n[ \t\r]*\n", _BREAK)
    parts = F.filter(F.split(ended, _BREAK), lambda s: F.lower(s).rlike("|".join(CUES)))
    return F.transform(parts, lambda s: F.trim(F.regexp_replace(F.lower(s), "[^a-z0-9]+", " ")))


def scan_licenses(
    docs: DataFrame, key: str = "doc_id", text: str = "text", sentences=SENTENCES, rules=RULES
) -> DataFrame:
    """(key, licenses, n_known, n_unknown) of every row; licenses are sorted and joined by a comma."""
    unseen = [s for s in sentences.values() if not any(c in s for c in CUES)]
    if unseen:
        raise ValueError(f"sentence without a cue: {unseen[0]}")
    known = F.create_map(*[F.lit(x) for i, s in sentences.items() for x in (s, i)])

    def identified(read_text: Column) -> Column:
        ids = F.transform(read_text, lambda s: F.coalesce(F.try_element_at(known, s), F.lit("?")))
        return F.concat(F.lit(","), F.array_join(ids, ",,"), F.lit(","))

    has_cue = F.lower(text).rlike("|".join(CUES))
    rows = docs.select(F.col(key).alias("key"), F.when(has_cue, F.col(text)).alias("text"))
    rows = rows.select(
        "key",
        identified(_sentences(F.col("text"), True)).alias("lines"),
        identified(_sentences(F.col("text"), False)).alias("joined"),
    )

    def recognised(ids: str) -> Column:
        return F.regexp_count(F.col(ids), F.lit(",[a-z][0-9]+,"))

    better = F.when(recognised("joined") > recognised("lines"), F.col("joined"))
    rows = rows.select("key", F.coalesce(better, F.col("lines"), F.lit("")).alias("ids"))
    counted = rows.select(
        F.col("key"),
        recognised("ids").alias("n_known"),
        F.regexp_count("ids", F.lit(",[?],")).alias("n_unknown"),
        F.col("ids").alias("left_0"),
    )
    # Each rule takes its runs out of what the rules before have left.
    found = []
    for n, (ids, _) in enumerate(rules):
        run = "".join(f",{i}," for i in ids)
        counted = counted.withColumn(f"left_{n + 1}", F.replace(f"left_{n}", F.lit(run), F.lit("|")))
        hit = F.col(f"left_{n + 1}") != F.col(f"left_{n}")
        found.append(hit & (F.col(f"left_{n}") == F.col("left_0")) if ids in YIELDING else hit)
    names = F.array(*[F.when(hit, F.lit(name)) for hit, (_, name) in zip(found, rules)])
    licenses = F.array_join(F.array_sort(F.array_distinct(F.array_compact(names))), ",")
    return counted.select(F.col("key").alias(key), licenses.alias("licenses"), "n_known", "n_unknown")


def op6_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan_licenses(read(spark, sf_dir, "documents"))


def _oracle() -> str:
    """The same over ``documents`` in DuckDB: sentences as lists, rules as list slices found in order."""
    cues = "|".join(CUES)
    known = "MAP {" + ", ".join(f"'{s}': '{i}'" for i, s in SENTENCES.items()) + "}"

    def ids(pattern: str) -> str:
        ended = r"regexp_replace(text, '([.!?;:])[ \t\r\n\f]+', '\1' || chr(11), 'g')"
        parts = f"string_split(regexp_replace({ended}, '{pattern}', chr(11), 'g'), chr(11))"
        cued = f"list_filter({parts}, lambda s: regexp_matches(lower(s), '{cues}'))"
        normal = f"list_transform({cued}, lambda s: trim(regexp_replace(lower(s), '[^a-z0-9]+', ' ', 'g')))"
        return f"list_transform({normal}, lambda s: coalesce({known}[s], '?'))"

    left, steps = "base", []
    for n, (run, name) in enumerate(RULES):
        text = "".join(f",{i}," for i in run)
        yields = " AND len(names) = 0" if run in YIELDING else ""
        steps.append(
            f"s{n} AS (SELECT * REPLACE (replace(ids, '{text}', '|') AS ids, CASE WHEN contains(ids,"
            f" '{text}'){yields} THEN list_append(names, '{name}') ELSE names END AS names) FROM {left})"
        )
        left = f"s{n}"
    return f"""
WITH readings AS (
  SELECT doc_id, {ids(chr(92) + "n")} AS a, {ids(chr(92) + "n[ " + chr(92) + "t" + chr(92) + "r]*" + chr(92) + "n")} AS b
  FROM (SELECT doc_id, coalesce(text, '') AS text FROM documents)
), chosen AS (
  SELECT doc_id, CASE WHEN len(list_filter(b, lambda x: x <> '?')) > len(list_filter(a, lambda x: x <> '?'))
    THEN b ELSE a END AS c FROM readings
), base AS (
  SELECT doc_id, len(list_filter(c, lambda x: x <> '?')) AS n_known, len(list_filter(c, lambda x: x = '?')) AS n_unknown,
    ',' || array_to_string(c, ',,') || ',' AS ids, CAST([] AS VARCHAR[]) AS names FROM chosen
), {", ".join(steps)}
SELECT doc_id, array_to_string(list_sort(list_distinct(names)), ',') AS licenses,
  CAST(n_known AS INTEGER) AS n_known, CAST(n_unknown AS INTEGER) AS n_unknown FROM {left}
"""


ORACLE = _oracle()
