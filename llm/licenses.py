"""License scans by sentence rules, with DataFrame functions only.

A text is cut into pieces (at line ends, and after ``.``, ``;``, ``:``, ``!`` or ``?`` before white space), each of which is
normalised: lower case, ``licence`` spelt ``license``, all but letters, digits and dots within a token one space. A known
sentence begins and ends with a piece; within it, a line end that leaves no blank line counts as a space, so texts may be
wrapped at any column, and a mark stands where the public text has one (``free software: you can``). Known sentences have an
identifier, the same for all wordings; of those that begin at a piece the longest counts. The identifiers of a document, in
order, form its sequence, in which other pieces count as gaps. A rule is an ordered sequence of identifiers and matches where
its sentences follow one another without a gap.

Only documents with one of the trigger words are cut into sentences; every known sentence holds one, which is checked when
the module is loaded. A null or empty text has no sentence; repeated sentences and rows count each time.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Sentences of public licences and notices as they stand after normalisation, and the order in which a licence has them.
SENTENCES = {
    "apache-notice": "licensed under the apache license version 2.0",
    "apache-use": "you may not use this file except in compliance with the license",
    "apache-copy": "you may obtain a copy of the license at",
    "apache-basis": "distributed under the license is distributed on an as is basis",
    "mit-short": "released under the mit license",
    "mit-title": "the mit license",
    "mit-grant": "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files the software to deal in the software without restriction",
    "mit-condition": "the above copyright notice and this permission notice shall be included in all copies or substantial portions of the software",
    "gpl3-work": "this work is licensed under the gnu general public license version 3",
    "gpl-free": "this program is free software you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation either version 3 of the license or at your option any later version",
    "gpl-copy": "you should have received a copy of the gnu general public license along with this program",
    "lgpl-work": "licensed under the gnu lesser general public license version 3",
    "cc-by-nc": "licensed under cc by nc 4.0",
    "cc-by": "licensed under cc by 4.0",
    "cc-by-sa": "licensed under cc by sa 4.0",
    "cc-by-work": "this work is licensed under a creative commons attribution 4.0 international license",
    "cc-by-sa-work": "this work is licensed under a creative commons attribution sharealike 4.0 international license",
    "cc-by-nc-work": "this work is licensed under a creative commons attribution noncommercial 4.0 international license",
    "bsd-terms": "redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met",
    "bsd-short": "released under the bsd license",
    "mpl-terms": "this source code form is subject to the terms of the mozilla public license v. 2.0",
    "reserved": "all rights reserved",
}
RULES = {
    "apache-2.0-notice": ("apache-notice",),
    "apache-2.0-header": ("apache-notice", "apache-use", "apache-copy"),
    "mit-notice": ("mit-short",),
    "mit-text": ("mit-grant", "mit-condition"),
    "mit-titled-text": ("mit-title", "mit-grant", "mit-condition"),
    "gpl-3.0-notice": ("gpl3-work",),
    "gpl-3.0-header": ("gpl-free", "gpl-copy"),
    "lgpl-3.0-notice": ("lgpl-work",),
    "cc-by-nc-4.0": ("cc-by-nc",),
    "cc-by-4.0": ("cc-by",),
    "cc-by-sa-4.0": ("cc-by-sa",),
    "cc-by-4.0-work": ("cc-by-work",),
    "cc-by-sa-4.0-work": ("cc-by-sa-work",),
    "cc-by-nc-4.0-work": ("cc-by-nc-work",),
    "bsd-text": ("bsd-terms",),
    "bsd-notice": ("bsd-short",),
    "mpl-2.0-header": ("mpl-terms",),
    "rights-reserved": ("reserved",),
}
TRIGGERS = ("license", "licence", "licensed", "permission", "permitted", "redistribute", "copyright", "rights reserved")
# end of fixed values

# The sentences of the public texts, verbatim; a name of SENTENCES stands for the same sentence, others are new.
WORDINGS = {
    "apache-notice": ('Licensed under the Apache License, Version 2.0 (the "License");',),
    "apache-basis": (
        'Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an "AS IS" BASIS, '
        "WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied.",
    ),
    "mit-title": ("MIT License", "The MIT License (MIT)"),
    "mit-grant": (
        'Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the "Software"), '
        "to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, "
        "and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions:",
    ),
    "gpl-free": (
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the "
        "Free Software Foundation, either version 3 of the License, or (at your option) any later version.",
        "This program is free software; you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the "
        "Free Software Foundation; either version 3 of the License, or (at your option) any later version.",
    ),
    "gpl-warranty": (
        "This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or "
        "FITNESS FOR A PARTICULAR PURPOSE. See the GNU General Public License for more details.",
    ),
    "mpl-terms": ("This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",),
    "cc-by-work": ("This work is licensed under the Creative Commons Attribution 4.0 International License.",),
    "cc-by-sa-work": (
        "This work is licensed under the Creative Commons Attribution-ShareAlike 4.0 International License.",
        "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.",
    ),
    "cc-by-nc-work": (
        "This work is licensed under the Creative Commons Attribution-NonCommercial 4.0 International License.",
        "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License.",
    ),
}
#: Further sequences of a rule: the public text has sentences in between.
ALSO = {"gpl-3.0-header": (("gpl-free", "gpl-warranty", "gpl-copy"),)}

IDS = {name: k for k, name in enumerate(SENTENCES)}
NUMBER = IDS | {name: len(IDS) + k for k, name in enumerate(x for x in WORDINGS if x not in IDS)}
assert all(any(t in s for t in TRIGGERS) for s in SENTENCES.values())
assert all(any(t in s.lower() for t in TRIGGERS) for texts in WORDINGS.values() for s in texts)
assert len(set(SENTENCES.values())) == len(SENTENCES)

#: Marks of a normalised text: a sentence end in a line, a line end, a paragraph's end.
STOP, LINE, PARAGRAPH = "|", "/", "#"
#: Steps from a lower-case text to a marked one, in Java's and Python's notation; \x01 is a line end, \x02 a sentence end.
STEPS = (
    ("licence", "license"),
    (r"(?<=[.;:!?])[ \t\r\f\x0b]+", "\x02"),
    (r"\n", "\x01"),
    (r"[^a-z0-9.\x01\x02]+", " "),
    (r"\.+(?=[ \x01\x02]|$)", ""),  # dots stay within a token (4.0) and go at its end
    (r"[ \x02]*\x01[ \x02]*\x01[ \x01\x02]*", PARAGRAPH),
    (r"[ \x02]*\x01[ \x02]*", LINE),
    (r" *\x02[ \x02]*", STOP),
    (r" +", " "),
    (r"^[ #/|]+|[ #/|]+$", ""),
)
TRIGGER = "(?i)licen[sc]e|permi(ssion|tted)|redistribute|copyright|rights[^a-z0-9]+reserved"


def marked(text: str) -> str:
    """What ``_marked`` makes of ``text``."""
    text = text.lower()
    for pattern, other in STEPS:
        text = re.sub(pattern, other, text)
    return text


def _marked(text: Column) -> Column:
    text = F.lower(text)
    for pattern, other in STEPS:
        text = F.regexp_replace(text, pattern, other)
    return text


def plain(wording: str) -> str:
    return re.sub(r"[ /|]+", " ", wording)


def _known() -> tuple[dict[str, int], str]:
    """Identifiers of the known sentences without marks; the pattern of a known sentence, or else of a piece."""
    texts = [(NUMBER[name], s) for name, s in SENTENCES.items()] + [(NUMBER[name], marked(s)) for name, more in WORDINGS.items() for s in more]
    ids = {plain(s): k for k, s in texts}
    # longest first; a space may be a line end, a mark may be missing
    ways = sorted({s.replace(".", r"\.").replace("|", "~").replace(" ", "[ /]").replace("~", "[ /|]") for _, s in texts}, key=lambda s: (-len(s), s))
    return ids, f"(?:{'|'.join(ways)})(?=[#/|]|$)|[^#/|]+"


def sequences() -> list[tuple[str, tuple[str, ...]]]:
    return [(name, names) for name in sorted(RULES) for names in (RULES[name], *ALSO.get(name, ()))]


def scan(docs: DataFrame) -> DataFrame:
    """doc_id, n_sentences (known ones), sentence_ids (in order, a gap as -1 between them), licenses (sorted rule names), n_matches."""
    numbers, pattern = _known()
    known = F.create_map(*[x for s, k in numbers.items() for x in (F.lit(s), F.lit(k))])
    sentences = F.when(F.col("text").rlike(TRIGGER), F.regexp_extract_all(_marked(F.col("text")), F.lit(pattern), F.lit(0)))
    ids = F.transform(sentences, lambda s: F.coalesce(known[F.trim(F.translate(s, "/|", "  "))], F.lit(-1)))
    found = docs.select("doc_id", F.coalesce(ids, F.array().cast("array<int>")).alias("ids"))
    # each identifier between commas; a run of gaps is no identifier
    found = found.withColumn("line", F.concat(F.lit(","), F.array_join(F.col("ids").cast("array<string>"), ",,"), F.lit(",")))
    matches = []
    for name, names in sequences():
        rule = "," + ",,".join(str(NUMBER[s]) for s in names) + ","
        times = ((F.length("line") - F.length(F.replace(F.col("line"), F.lit(rule), F.lit("")))) / len(rule)).cast("int")
        matches.append(F.when(times > 0, F.struct(F.lit(name).alias("name"), times.alias("times"))))
    found = found.withColumn("hits", F.filter(F.array(*matches), lambda m: m.isNotNull()))
    return found.select(
        "doc_id", F.size(F.filter("ids", lambda k: k >= 0)).cast("long").alias("n_sentences"),
        F.array_join(F.transform(F.filter("ids", lambda k: k >= 0), lambda k: k.cast("string")), ",").alias("sentence_ids"),
        F.array_join(F.array_distinct(F.transform("hits", lambda m: m["name"])), ",").alias("licenses"),
        F.aggregate("hits", F.lit(0), lambda t, m: t + m["times"]).cast("long").alias("n_matches"),
    )
