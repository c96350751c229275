"""License scan by sentence rules.

Sentence ends and line breaks of a text are marked and its words normalised. Known licence
sentences, which may go on over line breaks, colons and semicolons, get their identifiers,
and the identifiers, in the order of the text, are matched against ordered rules. All of it
is one expression on the row: no shuffle, no Python.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sievelake.llm.common import LOWER, UPPER

# Well-known licence sentences, normalised: lower case, words of letters,
# digits and plus signs, with one space between.
SENTENCES = {
    "apache-header": "licensed under the apache license version 2 0",
    "apache-may-not-use": "you may not use this file except in compliance with the license",
    "apache-copy": "you may obtain a copy of the license at http www apache org licenses license 2 0",
    "apache-as-is": "unless required by applicable law or agreed to in writing software distributed under the license is distributed on an as is basis without warranties or conditions of any kind either express or implied",
    "mit-released": "released under the mit license",
    "mit-licensed": "licensed under the mit license",
    "mit-grant": "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files the software to deal in the software without restriction including without limitation the rights to use copy modify merge publish distribute sublicense and or sell copies of the software and to permit persons to whom the software is furnished to do so subject to the following conditions",
    "mit-notice": "the above copyright notice and this permission notice shall be included in all copies or substantial portions of the software",
    "as-is": "the software is provided as is without warranty of any kind express or implied including but not limited to the warranties of merchantability fitness for a particular purpose and noninfringement",
    "bsd-source": "redistributions of source code must retain the above copyright notice this list of conditions and the following disclaimer",
    "bsd-binary": "redistributions in binary form must reproduce the above copyright notice this list of conditions and the following disclaimer in the documentation and or other materials provided with the distribution",
    "bsd-endorse": "neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission",
    "gpl3-work": "this work is licensed under the gnu general public license version 3",
    "gpl-redistribute": "this program is free software you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation either version 3 of the license or at your option any later version",
    "gpl-warranty": "this program is distributed in the hope that it will be useful but without any warranty without even the implied warranty of merchantability or fitness for a particular purpose",
    "cc-by-nc": "licensed under cc by nc 4 0",
    "cc-by": "licensed under cc by 4 0",
    "cc-by-sa": "licensed under cc by sa 4 0",
    "reserved": "all rights reserved",
}

# Licence, and the sentences that state it, in this order.
RULES = [
    ("Apache-2.0", ["apache-header"]),
    ("Apache-2.0", ["apache-may-not-use", "apache-copy", "apache-as-is"]),
    ("MIT", ["mit-released"]),
    ("MIT", ["mit-licensed"]),
    ("MIT", ["mit-grant", "mit-notice", "as-is"]),
    ("BSD-2-Clause", ["bsd-source", "bsd-binary"]),
    ("BSD-3-Clause", ["bsd-source", "bsd-binary", "bsd-endorse"]),
    ("GPL-3.0", ["gpl3-work"]),
    ("GPL-3.0-or-later", ["gpl-redistribute", "gpl-warranty"]),
    ("CC-BY-4.0", ["cc-by"]),
    ("CC-BY-NC-4.0", ["cc-by-nc"]),
    ("CC-BY-SA-4.0", ["cc-by-sa"]),
    ("LicenseRef-all-rights-reserved", ["reserved"]),
]

_COPY, _AS_IS = SENTENCES["apache-copy"], SENTENCES["apache-as-is"]
_COPY_HTTPS = _COPY.replace(" http ", " https ")
# Other wordings of known sentences, and what they state. Where a notice is
# written without line breaks, nothing ends the sentence with the URL.
WORDINGS = {
    SENTENCES["apache-header"] + " the license": ["apache-header"],
    _COPY_HTTPS: ["apache-copy"],
    f"{_COPY} {_AS_IS}": ["apache-copy", "apache-as-is"],
    f"{_COPY_HTTPS} {_AS_IS}": ["apache-copy", "apache-as-is"],
}

# A sentence ends at a line break, or at . ! ? ; : before white space or the end.
BREAK = r"[\x0A\x0D]+|[.!?;:]+(?:[\x09\x0A\x0D\x20]+|$)"
NOT_WORD = r"[^a-z0-9+]+"


# The same ends, once line breaks are marks L and R: a colon or semicolon alone, any other.
PAUSE = r"(?<![.!?;:])[;:]++(?:[\x09\x20LR]+|$)"
END = r"[.!?;:]++(?:[\x09\x20LR]+|$)"
NOT_WORD_OR_MARK = r"[^a-z0-9+HLRS]+"
# Between two words of one sentence: a space, a pause or one line break; before a URL any number.
GAP, URL_GAP = "(?: ?(?:RL|[SLR]) ?| )", "[ SLR]+"


def _marked(text: Column) -> Column:
    """The normalised words of a text between marks: H for an end of a sentence, S for a
    colon or semicolon, L and R for a line break. Capitals are free, as the text has none."""
    lower = F.translate(text, UPPER + "\n\r", LOWER + "LR")
    return F.regexp_replace(F.regexp_replace(F.regexp_replace(lower, PAUSE, "S"), END, "H"), NOT_WORD_OR_MARK, " ")


def _pattern(known: list[str]) -> str:
    """Any of the known sentences from one mark to another, the longest first."""
    found = []
    for sentence in sorted(known, key=len, reverse=True):
        first, *rest = map(re.escape, sentence.split(" "))
        found.append(first + "".join((URL_GAP if w in ("http", "https") else GAP) + w for w in rest))
    return f"(?:^|[HLRS]) ?({'|'.join(found)})(?= ?(?:[HLRS]|$))"


def scan(
    docs: DataFrame,
    known: dict[str, str] | None = None,
    rules: list[tuple[str, list[str]]] | None = None,
) -> DataFrame:
    """``(doc_id, n_sentences, sentence_ids, licenses)`` for each row of ``docs``.

    ``sentence_ids`` are the identifiers of known sentences in the order of the text,
    comma-joined; unknown sentences between them are skipped. A rule matches where its
    identifiers follow each other in that sequence; ``licenses`` are the licences of all
    rules that match, sorted and comma-joined. Null and empty texts have no sentences and
    empty strings. A known sentence may be broken over lines of one paragraph and may hold
    colons and semicolons; it begins and ends where the text's sentences or lines do. Where
    known sentences overlap, the first counts, and the longest of those that begin there.
    Repeated rows are scanned each; other columns are ignored.
    """
    wordings = WORDINGS if known is None else {}
    known = SENTENCES if known is None else known
    rules = RULES if rules is None else rules
    for sentence in known.values():
        if sentence != re.sub(NOT_WORD, " ", sentence).strip():
            raise ValueError(f"not a normalised sentence: {sentence!r}")
    number = {s: i for i, s in known.items() if s} | {s: ",".join(ids) for s, ids in wordings.items()}
    none = F.array().cast("array<string>")
    if number:
        found = F.regexp_extract_all(_marked(F.col("text")), F.lit(_pattern(list(number))), F.lit(1))
        names = F.create_map(*[F.lit(x) for pair in number.items() for x in pair])
        ids = F.transform(found, lambda s: F.split(F.element_at(names, F.regexp_replace(s, "[ LRS]+", " ")), ","))
        ids = F.coalesce(F.flatten(ids), none)
    else:
        ids = none
    rows = docs.select("doc_id", ids.alias("ids"))
    padded = F.concat(F.lit(","), F.array_join("ids", ","), F.lit(","))
    licenses = F.array_sort(
        F.array_distinct(
            F.filter(
                F.array(*[F.when(padded.contains(f",{','.join(ids)},"), F.lit(name)) for name, ids in rules]),
                lambda x: x.isNotNull(),
            )
        )
    )
    return rows.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_sentences"),
        F.array_join("ids", ",").alias("sentence_ids"),
        F.array_join(licenses, ",").alias("licenses"),
    )
