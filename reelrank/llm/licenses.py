"""Licence scan by sentence rules, in DataFrame functions only.

A text is normalised (lower case, dots inside numbers kept, other signs as
spaces) and split into sentences. Sentences that are known licence sentences
become one-letter identifiers, all others a dash, so a document is a string of
letters, and a licence rule is a run of letters in that string. Rules are
ordered: full texts before references, so the first match names the licence.
Licence expressions that a text declares by an SPDX tag are listed beside the rules.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from reelrank.llm.common import read

#: Normalised licence sentences by identifier.
SENTENCES = {
    "a": "released under the mit license",
    "b": "licensed under the mit license",
    "c": "licensed under the apache license version 2.0",
    "d": "this work is licensed under the gnu general public license version 3",
    "e": "licensed under cc by nc 4.0",
    "f": "licensed under cc by 4.0",
    "g": "licensed under cc by sa 4.0",
    "h": "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files the software to deal in the software without restriction including without limitation the rights to use copy modify merge publish distribute sublicense and or sell copies of the software and to permit persons to whom the software is furnished to do so subject to the following conditions",
    "i": "the above copyright notice and this permission notice shall be included in all copies or substantial portions of the software",
    "j": "the software is provided as is without warranty of any kind express or implied including but not limited to the warranties of merchantability fitness for a particular purpose and noninfringement",
    "k": "redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met",
    "l": "redistributions of source code must retain the above copyright notice this list of conditions and the following disclaimer",
    "m": "redistributions in binary form must reproduce the above copyright notice this list of conditions and the following disclaimer in the documentation and or other materials provided with the distribution",
    "n": "neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission",
    "o": "you may not use this file except in compliance with the license",
    "p": "you may obtain a copy of the license at",
    "q": "this program is free software you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation either version 3 of the license or at your option any later version",
    "r": "all rights reserved",
    "A": "you can redistribute it and or modify it under the terms of the gnu affero general public license as published by the free software foundation either version 3 of the license or at your option any later version",
    "B": "permission is hereby granted free of charge to any person or organization obtaining a copy of the software and accompanying documentation covered by this license the software to use reproduce display distribute execute and transmit the software and to prepare derivative works of the software and to permit third parties to whom the software is furnished to do so all subject to the following",
    "D": "distributed under the boost software license version 1.0",
    "E": "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted",
    "G": "you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation",
    "H": "either version 2 of the license or at your option any later version",
    "I": "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted provided that the above copyright notice and this permission notice appear in all copies",
    "J": "permission to use copy modify and distribute this software for any purpose with or without fee is hereby granted provided that the above copyright notice and this permission notice appear in all copies",
    "K": "you can redistribute it and or modify it under the terms of the gnu general public license version 2 as published by the free software foundation",
    "L": "you can redistribute it and or modify it under the terms of the gnu lesser general public license as published by the free software foundation",
    "M": "this source code form is subject to the terms of the mozilla public license v",
    "N": "either version 2.1 of the license or at your option any later version",
    "P": "you can redistribute it and or modify it under the terms of the gnu lesser general public license as published by the free software foundation either version 3 of the license or at your option any later version",
}

#: Ordered rules: (licence, run of sentence identifiers).
RULES = (
    ("BSD-3-Clause", "klmn"), ("BSD-2-Clause", "klm"), ("MIT", "hij"), ("Apache-2.0", "cop"),
    ("Apache-2.0", "co"), ("GPL-3.0-or-later", "q"), ("AGPL-3.0-or-later", "A"),
    ("LGPL-3.0-or-later", "P"), ("LGPL-2.1-or-later", "LN"), ("GPL-2.0-or-later", "GH"),
    ("GPL-2.0-only", "K"), ("MPL-2.0", "M"), ("ISC", "I"), ("ISC", "J"), ("0BSD", "E"),
    ("BSL-1.0", "B"), ("BSL-1.0", "D"), ("MIT-permission", "h"),
    ("GPL-3.0", "d"), ("Apache-2.0", "c"), ("CC-BY-NC-4.0", "e"), ("CC-BY-SA-4.0", "g"),
    ("CC-BY-4.0", "f"), ("MIT", "a"), ("MIT", "b"), ("BSD-conditions", "k"),
    ("All-rights-reserved", "r"),
)

#: Sentences as the licences' own texts have them, and the runs that stand for runs of
#: RULES; both for texts whose lines are joined.
WRAPPED = {
    "C": "licensed under the apache license version 2.0 the license",
    "s": "this program is free software",
    "Q": "you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation either version 3 of the license or at your option any later version",
}
WRAPPED_RUNS = {"cop": "Cop", "co": "Co", "c": "C", "q": "sQ"}

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_END = r"[.!?:;]+(?:[\s\"')\]]+|$)|\n+"    # a stop before white space, or a line end
#: In joined lines: a stop before white space, or a line that is blank but for comment signs.
_PARAGRAPH_END = r"[.!?:;]+(?:[\s\"')\]]+|$)|\n(?:[^\S\n]*[#*/;%!-]*[^\S\n]*\n)+"
_BULLET = r"^(?:\d{1,2}|[a-z]|[ivx]+)$"      # a normalised sentence that only numbers the next
_SIGNS = r"[^a-z0-9.\x{80}-\x{10FFFF}]+"   # neither letter, digit nor dot


_TAG = "SPDX-License-Identifier:"
_EXPRESSION = _TAG + r"[ \t]*([A-Za-z0-9.+() \t-]*[A-Za-z0-9.+)])"   # to the last sign of an expression in the line


def declared(text: Column) -> Column:
    """The distinct licence expressions after SPDX tags, sorted and comma-joined; empty without any."""
    found = F.regexp_extract_all(text, F.lit(_EXPRESSION), F.lit(1))
    return F.when(text.contains(_TAG), F.array_join(F.array_sort(F.array_distinct(found)), ",")).otherwise("")


def sentences(text: Column) -> Column:
    return F.split(F.translate(F.coalesce(text, F.lit("")), _UPPER, _LOWER), _END)


def sentence_letter(sentence: Column) -> Column:
    """The identifier of a sentence, ``-`` for an unknown one, nothing for a blank one.
    Only sentences with a licence word are normalised; every known one has such a word."""
    plain = F.trim(F.regexp_replace(sentence, _SIGNS, " "))
    known = F.create_map(*[F.lit(x) for k, s in SENTENCES.items() for x in (s, k)])
    likely = sentence.rlike("licen|permi|copyright|warrant|redistribut|rights reserved")
    return F.when(likely, F.coalesce(F.element_at(known, plain), F.lit("-"))) \
        .when(F.trim(sentence) == "", F.lit("")).otherwise(F.lit("-"))


def joined_letters(text: Column) -> Column:
    """Identifiers of the sentences of a text whose single line ends are joined: licences are
    wrapped, indented, numbered and in comments. Comment signs fall away with all signs;
    sentences that only number the next one give nothing."""
    low = F.regexp_replace(F.translate(F.coalesce(text, F.lit("")), _UPPER, _LOWER), r"\r\n?", "\n")
    known = F.create_map(*[F.lit(x) for k, s in {**SENTENCES, **WRAPPED}.items() for x in (s, k)])

    def letter(sentence: Column) -> Column:
        plain = F.trim(F.regexp_replace(sentence, _SIGNS, " "))
        likely = sentence.rlike("licen|permi|copyright|warrant|redistribut|rights\\W+reserved|free\\W+software")
        return F.when(likely, F.coalesce(F.element_at(known, plain), F.lit("-"))) \
            .when((F.length(sentence) < 40) & ((plain == "") | plain.rlike(_BULLET)), F.lit("")).otherwise(F.lit("-"))

    return F.array_join(F.transform(F.split(low, _PARAGRAPH_END), letter), "")


def scan(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text",
         rules=RULES) -> DataFrame:
    """Per row: id, ``n_sentences``, ``n_known`` (licence sentences), ``sequence`` (the known
    ones' identifiers with one dash for each run of others), ``licence`` (the first
    rule's that matches), ``licences`` (all, comma-joined in rule order, each once) and
    ``declared`` (expressions of SPDX tags as written, which no rule judges).

    A rule matches a run of consecutive sentences, of the text as its lines stand (which is
    what the counts and the sequence tell) or with its lines joined, which finds wrapped
    licences. Null and empty texts have no
    sentences, an empty sequence, null ``licence``, empty ``licences`` and ``declared``. Whole
    texts are read; every row stands alone, so repeats, other columns and empty
    tables need no care, and nothing is shuffled.
    """
    letters = F.array_join(F.transform(sentences(F.col(text_col)), sentence_letter), "")
    seq, joined = F.col("__letters"), F.col("__joined")

    def matches(run: str) -> Column:
        more = WRAPPED_RUNS.get(run)
        hit = seq.contains(run) | joined.contains(run)
        return hit | joined.contains(more) if more else hit

    found = F.array_distinct(F.filter(F.array(*[
        F.when(matches(run), F.lit(name)) for name, run in rules]), F.isnotnull))
    return docs.select(F.col(id_col), letters.alias("__letters"),
                       joined_letters(F.col(text_col)).alias("__joined"),
                       declared(F.col(text_col)).alias("__declared")).select(
        id_col, F.length(seq).cast("long").alias("n_sentences"),
        F.length(F.translate(seq, "-", "")).cast("long").alias("n_known"),
        F.regexp_replace(seq, "-+", "-").alias("sequence"), found.alias("__found"), "__declared").select(
        id_col, "n_sentences", "n_known", "sequence",
        F.get("__found", F.lit(0)).alias("licence"),
        F.array_join("__found", ",").alias("licences"), F.col("__declared").alias("declared"))


def op5_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan(read(spark, sf_dir, "documents"))


def _sql() -> str:
    known = ", ".join(f"('{k}', '{s}')" for k, s in SENTENCES.items())
    rules = ", ".join(f"({i}, '{n}', '{r}')" for i, (n, r) in enumerate(RULES))
    return rf"""
WITH known(letter, sentence) AS (VALUES {known}), rules(k, licence, run) AS (VALUES {rules}),
d AS (SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS text,
             translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}') AS t FROM documents),
s AS (SELECT r, unnest(x) AS s, generate_subscripts(x, 1) AS i
      FROM (SELECT r, regexp_split_to_array(t, '[.!?:;]+(?:[\s"'')\]]+|$)|\n+') AS x FROM d)),
l AS (SELECT r, string_agg(CASE WHEN letter IS NOT NULL THEN letter WHEN trim(s) = '' THEN '' ELSE '-' END, '' ORDER BY i) AS q
      FROM s LEFT JOIN known ON known.sentence = trim(regexp_replace(s, '[^a-z0-9.\x{{80}}-\x{{10FFFF}}]+', ' ', 'g'))
      GROUP BY r),
m AS (SELECT r, licence, min(k) AS k FROM l, rules WHERE contains(q, run) GROUP BY r, licence),
n AS (SELECT r, min_by(licence, k) AS licence, string_agg(licence, ',' ORDER BY k) AS licences FROM m GROUP BY r)
SELECT d.doc_id, CAST(length(q) AS BIGINT) AS n_sentences,
       CAST(length(replace(q, '-', '')) AS BIGINT) AS n_known,
       regexp_replace(q, '-+', '-', 'g') AS sequence, licence, coalesce(licences, '') AS licences,
       array_to_string(list_sort(list_distinct(regexp_extract_all(text, '{_EXPRESSION}', 1))), ',') AS declared
FROM d JOIN l ON d.r = l.r LEFT JOIN n ON d.r = n.r
"""


SQL = _sql()
