"""Licence scans by recognised sentences and ordered rules over their identifiers."""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Known licence sentences, normalised (lower case, runs of other characters than
# a-z, 0-9 and full stops made one blank, no full stop at an end), with their identifiers.
TEXTS: dict[str, str] = {
    "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files the software to deal in the software without restriction including without limitation the rights to use copy modify merge publish distribute sublicense and or sell copies of the software and to permit persons to whom the software is furnished to do so subject to the following conditions": "mit_grant",
    "the above copyright notice and this permission notice shall be included in all copies or substantial portions of the software": "mit_notice",
    "the software is provided as is without warranty of any kind express or implied including but not limited to the warranties of merchantability fitness for a particular purpose and noninfringement": "mit_as_is",
    "in no event shall the authors or copyright holders be liable for any claim damages or other liability whether in an action of contract tort or otherwise arising from out of or in connection with the software or the use or other dealings in the software": "mit_liability",
    "licensed under the apache license version 2.0 the license": "apache2_ref",
    "you may not use this file except in compliance with the license": "apache2_comply",
    "you may obtain a copy of the license at": "apache2_copy_at",
    "this work is licensed under the gnu general public license version 3": "gpl3_ref",
    "this work is licensed under the gnu general public license version 2": "gpl2_ref",
    "this program is free software you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation either version 3 of the license or at your option any later version": "gpl3_plus_grant",
    "this program is free software you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation either version 2 of the license or at your option any later version": "gpl2_plus_grant",
    "this program is distributed in the hope that it will be useful but without any warranty without even the implied warranty of merchantability or fitness for a particular purpose": "gpl_no_warranty",
    "see the gnu general public license for more details": "gpl_see",
    "this work is licensed under a creative commons attribution 4.0 international license": "cc_by4_ref",
    "this work is licensed under a creative commons attribution noncommercial 4.0 international license": "cc_by_nc4_ref",
    "this work is licensed under a creative commons attribution sharealike 4.0 international license": "cc_by_sa4_ref",
    "this work is licensed under a creative commons attribution noderivatives 4.0 international license": "cc_by_nd4_ref",
    "this work is licensed under a creative commons attribution noncommercial sharealike 4.0 international license": "cc_by_nc_sa4_ref",
    "this work is licensed under a creative commons attribution noncommercial noderivatives 4.0 international license": "cc_by_nc_nd4_ref",
    "this library is free software you can redistribute it and or modify it under the terms of the gnu lesser general public license as published by the free software foundation either version 2.1 of the license or at your option any later version": "lgpl21_plus_grant",
    "this library is free software you can redistribute it and or modify it under the terms of the gnu lesser general public license as published by the free software foundation either version 3 of the license or at your option any later version": "lgpl3_plus_grant",
    "this program is free software you can redistribute it and or modify it under the terms of the gnu affero general public license as published by the free software foundation either version 3 of the license or at your option any later version": "agpl3_plus_grant",
    "redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met": "bsd_grant",
    "redistributions of source code must retain the above copyright notice this list of conditions and the following disclaimer": "bsd_source",
    "redistributions in binary form must reproduce the above copyright notice this list of conditions and the following disclaimer in the documentation and or other materials provided with the distribution": "bsd_binary",
    "neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission": "bsd_endorse",
    "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted provided that the above copyright notice and this permission notice appear in all copies": "isc_grant",
    "this source code form is subject to the terms of the mozilla public license v": "mpl2_ref",
    "this software is provided as is without any express or implied warranty": "zlib_as_is",
    "permission is granted to anyone to use this software for any purpose including commercial applications and to alter it and redistribute it freely subject to the following restrictions": "zlib_grant",
    "permission is hereby granted free of charge to any person or organization obtaining a copy of the software and accompanying documentation covered by this license the software to use reproduce display distribute execute and transmit the software": "bsl1_grant",
    "this is free and unencumbered software released into the public domain": "unlicense_ref",
    "all rights reserved": "reserved",
}

# Names of licences, normalised likewise, with the identifier of a sentence that refers to one.
NAMES: dict[str, str] = {
    "mit license": "mit_ref",
    "isc license": "isc_ref",
    "zlib license": "zlib_ref",
    "bsd 2 clause license": "bsd2_ref",
    "bsd 3 clause license": "bsd3_ref",
    "apache license version 2.0": "apache2_ref",
    "apache license 2.0": "apache2_ref",
    "apache 2.0 license": "apache2_ref",
    "mozilla public license version 2.0": "mpl2_ref",
    "mozilla public license 2.0": "mpl2_ref",
    "eclipse public license 2.0": "epl2_ref",
    "boost software license version 1.0": "bsl1_ref",
    "gnu general public license version 2": "gpl2_ref",
    "gnu general public license version 3": "gpl3_ref",
    "gnu lesser general public license version 2.1": "lgpl21_ref",
    "gnu lesser general public license version 3": "lgpl3_ref",
    "gnu affero general public license version 3": "agpl3_ref",
    "cc0 1.0": "cc0_ref",
    "cc by 4.0": "cc_by4_ref",
    "cc by sa 4.0": "cc_by_sa4_ref",
    "cc by nc 4.0": "cc_by_nc4_ref",
    "cc by nc sa 4.0": "cc_by_nc_sa4_ref",
    "cc by nd 4.0": "cc_by_nd4_ref",
    "cc by nc nd 4.0": "cc_by_nc_nd4_ref",
}
# How texts refer to a licence.
REFERENCES = ("licensed under", "licensed under the", "released under", "released under the", "distributed under", "distributed under the", "available under", "available under the")

# Licence rules in the order they are tried; each names the identifiers that must
# follow one another among a document's recognised sentences.
RULES: tuple[tuple[str, tuple[str, ...]], ...] = (
    ("MIT", ("mit_grant", "mit_notice", "mit_as_is", "mit_liability")),
    ("BSD-3-Clause", ("bsd_grant", "bsd_source", "bsd_binary", "bsd_endorse")),
    ("BSD-2-Clause", ("bsd_grant", "bsd_source", "bsd_binary")),
    ("Apache-2.0", ("apache2_ref", "apache2_comply", "apache2_copy_at")),
    ("GPL-3.0-or-later", ("gpl3_plus_grant", "gpl_no_warranty", "gpl_see")),
    ("GPL-2.0-or-later", ("gpl2_plus_grant", "gpl_no_warranty", "gpl_see")),
    ("GPL-3.0-or-later", ("gpl3_plus_grant",)),
    ("GPL-2.0-or-later", ("gpl2_plus_grant",)),
    ("MIT", ("mit_grant", "mit_notice")),
    ("MIT", ("mit_ref",)),
    ("Apache-2.0", ("apache2_ref",)),
    ("GPL-3.0-only", ("gpl3_ref",)),
    ("GPL-2.0-only", ("gpl2_ref",)),
    ("CC-BY-NC-SA-4.0", ("cc_by_nc_sa4_ref",)),
    ("CC-BY-NC-4.0", ("cc_by_nc4_ref",)),
    ("CC-BY-SA-4.0", ("cc_by_sa4_ref",)),
    ("CC-BY-ND-4.0", ("cc_by_nd4_ref",)),
    ("CC-BY-4.0", ("cc_by4_ref",)),
    ("CC-BY-NC-ND-4.0", ("cc_by_nc_nd4_ref",)),
    ("CC0-1.0", ("cc0_ref",)),
    ("ISC", ("isc_grant",)),
    ("ISC", ("isc_ref",)),
    ("LGPL-2.1-or-later", ("lgpl21_plus_grant",)),
    ("LGPL-3.0-or-later", ("lgpl3_plus_grant",)),
    ("AGPL-3.0-or-later", ("agpl3_plus_grant",)),
    ("LGPL-2.1-only", ("lgpl21_ref",)),
    ("LGPL-3.0-only", ("lgpl3_ref",)),
    ("AGPL-3.0-only", ("agpl3_ref",)),
    ("BSD-2-Clause", ("bsd2_ref",)),
    ("BSD-3-Clause", ("bsd3_ref",)),
    ("Zlib", ("zlib_as_is", "zlib_grant")),
    ("Zlib", ("zlib_ref",)),
    ("BSL-1.0", ("bsl1_grant",)),
    ("BSL-1.0", ("bsl1_ref",)),
    ("EPL-2.0", ("epl2_ref",)),
    ("MPL-2.0", ("mpl2_ref",)),
    ("Unlicense", ("unlicense_ref",)),
)



def normalised(text: str) -> str:
    """A sentence as it stands in ``SENTENCES``."""
    return re.sub("[^A-Za-z0-9.]+", " ", text).strip(" .").lower()


#: Known sentences with their identifiers: texts, references by name, and the identifiers that source files bear.
SENTENCES: dict[str, str] = TEXTS | {f"{r} {n}": i for r in REFERENCES for n, i in NAMES.items()} | {normalised(f"SPDX-License-Identifier: {n}"): f"spdx {n}" for n in dict(RULES)}
RULES += tuple((n, (f"spdx {n}",)) for n in dict(RULES))


def cues(sentences: Iterable[str]) -> tuple[str, ...]:
    """A few long words such that each sentence has one: time and again the word in most of the rest, of several the longest.

    Words of seven letters, which few other texts have, come first; a sentence without any gives its longest ones.
    """
    left, out = [{w for w in s.split() if len(w) >= min(7, max(map(len, s.split())))} for s in sentences], []
    while left:
        n = Counter(w for s in left for w in s)
        out.append(max(n, key=lambda w: (n[w], len(w), w)))
        left = [s for s in left if out[-1] not in s]
    return tuple(out)


CUES = cues(SENTENCES)


def cue_pattern(found: Iterable[str] = CUES) -> str:
    """Matches every text that may hold one of the sentences with these cues; others need no closer look."""
    return "(?i)(?:" + "|".join(w.replace(".", "\\.") for w in found) + ")"


def normalised_lines(text: Column) -> Column:
    """A text's lines, each with all but ASCII letters, digits and inner full stops made one blank, in lower case.

    An empty line is where a sentence surely ends: at full stops, ``!`` or ``?`` before a blank or the end, and at lines
    that hold no letters, which may be comment marks. At other line ends, which are put at semicolons, and at
    colons before a blank or the end, too, it may end or go on.
    """
    stopped = F.regexp_replace(text, "[;:]*+[.!?][.!?;:]*+([ \\t\\n\\r]+|\\z)", "\n\n")
    ends = F.split(F.regexp_replace(stopped, "[;:]+([ \\t\\n\\r]+|\\z)|;", "\n"), "\n")
    return F.array_join(F.transform(ends, lambda x: F.trim(F.lower(F.regexp_replace(x, "[^A-Za-z0-9.]+", " ")))), "\n")


def sentence_pattern(sentences: Iterable[str]) -> str:
    """Matches a known sentence, alone or within a longer one, on one or more lines; of two that start alike the longer one."""
    return "\\b(?:" + "|".join(s.replace(".", "\\.").replace(" ", "[ \n]") for s in sorted(sentences, key=lambda s: (-len(s), s))) + ")\\b"


def scan_licenses(docs: DataFrame, sentences: Mapping[str, str] = SENTENCES, rules: Sequence[tuple[str, Sequence[str]]] = RULES) -> DataFrame:
    """``docs`` with ``sentence_ids``, ``licenses`` and ``unmatched_ids`` (arrays of strings).

    ``sentence_ids`` are the known sentences of the whole text in their order, repeats kept, be they
    whole or part of a longer sentence, on one line or wrapped over several, with or without comment marks. Keys of
    ``sentences`` are ``normalised``.
    Rules are tried in their order, each wherever its identifiers follow one another; sentences
    that a rule took are gone for later ones. ``licenses`` are the licences found, each once, in
    the order of their places; ``unmatched_ids`` are the sentences that no rule took. Null and
    empty texts have none; texts may be of any length. Rows are independent: no shuffle, repeated rows come back as often,
    and an empty table gives no rows. The three replace columns of their names; other columns are kept.
    """
    known = F.create_map(*(F.lit(x) for kv in sentences.items() for x in kv))
    said = F.regexp_extract_all(normalised_lines(F.col("text")), F.lit(sentence_pattern(sentences)), F.lit(0))
    ids = F.transform(said, lambda s: known[F.translate(s, "\n", " ")])
    hit = F.coalesce(F.col("text").rlike(cue_pattern(cues(sentences))), F.lit(False)) if sentences else F.lit(False)
    out = docs.withColumn("sentence_ids", F.when(hit, ids).otherwise(F.array().cast("array<string>")) if sentences else F.array().cast("array<string>"))
    state = F.concat(F.lit("<"), F.array_join("sentence_ids", "><"), F.lit(">"))
    for name, sequence in rules:
        state = F.replace(state, F.lit("<" + "><".join(sequence) + ">"), F.lit(f"<={name}>"))
    parts = lambda take: F.filter(F.split(state, "[<>]+"), take)
    return out.withColumns(
        {
            "licenses": F.array_distinct(F.transform(parts(lambda x: x.startswith("=")), lambda x: x.substr(F.lit(2), F.length(x)))),
            "unmatched_ids": parts(lambda x: (x != "") & ~x.startswith("=")),
        }
    )
