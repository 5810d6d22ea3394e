"""Licence recognition by sentences and rules.

Texts are cut into sentences; a normalised sentence that is known becomes its identifier, any other one a gap.
A rule is an ordered list of identifiers; it matches where they follow one another without a gap.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Licence sentences as their licences word them, normalised (lower case, words only), by identifier.
SENTENCES = {
    "mit-name": ["released under the mit license", "licensed under the mit license", "this project is licensed under the mit license",
                 "the mit license mit", "mit license"],
    "mit-grant": ["permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files the software to deal in the software without restriction including without limitation the rights to use copy modify merge publish distribute sublicense and or sell copies of the software and to permit persons to whom the software is furnished to do so subject to the following conditions"],
    "mit-notice": ["the above copyright notice and this permission notice shall be included in all copies or substantial portions of the software"],
    "mit-warranty": ["the software is provided as is without warranty of any kind express or implied including but not limited to the warranties of merchantability fitness for a particular purpose and noninfringement"],
    "apache-name": ["licensed under the apache license version 2 0", "licensed under the apache license version 2 0 the license",
                    "released under the apache license version 2 0", "apache license version 2 0"],
    "apache-use": ["you may not use this file except in compliance with the license"],
    "apache-copy": ["you may obtain a copy of the license at"],
    "gpl3-name": ["this work is licensed under the gnu general public license version 3", "licensed under the gnu general public license version 3",
                  "released under the gnu general public license version 3"],
    "gpl2-name": ["this work is licensed under the gnu general public license version 2", "licensed under the gnu general public license version 2"],
    "gpl-free": ["this program is free software you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation either version 3 of the license or at your option any later version"],
    "gpl-hope": ["this program is distributed in the hope that it will be useful but without any warranty without even the implied warranty of merchantability or fitness for a particular purpose"],
    # the usual texts cut these at a colon or semicolon
    "gpl-free-begin": ["this program is free software"],
    "gpl3-free-end": ["you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation either version 3 of the license or at your option any later version"],
    "gpl2-free-end": ["you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation either version 2 of the license or at your option any later version"],
    "lgpl3-name": ["licensed under the gnu lesser general public license version 3"],
    "mpl2-name": ["this source code form is subject to the terms of the mozilla public license v 2 0", "licensed under the mozilla public license version 2 0"],
    "bsd-grant": ["redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met"],
    "bsd-source": ["redistributions of source code must retain the above copyright notice this list of conditions and the following disclaimer"],
    "bsd-binary": ["redistributions in binary form must reproduce the above copyright notice this list of conditions and the following disclaimer in the documentation and or other materials provided with the distribution"],
    "bsd-neither": ["neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission"],
    "bsd-name": ["licensed under the bsd 3 clause license", "released under the bsd license"],
    "cc-by-nc-name": ["licensed under cc by nc 4 0", "this work is licensed under cc by nc 4 0"],
    "cc-by-name": ["licensed under cc by 4 0", "this work is licensed under cc by 4 0", "this work is licensed under a creative commons attribution 4 0 international license"],
    "cc-by-sa-name": ["licensed under cc by sa 4 0", "this work is licensed under cc by sa 4 0"],
    "cc0-name": ["released under cc0 1 0", "licensed under cc0 1 0"],
    "unlicense": ["this is free and unencumbered software released into the public domain"],
    "mit-file": ["this project is licensed under the mit license see the license file",
                 "this project is licensed under the mit license see the license file for details"],
    "apache-file": ["this project is licensed under the apache license 2 0", "licensed under the apache license 2 0",
                    "this project is licensed under the apache license version 2 0 see the license file for details"],
    "mit-liable": ["in no event shall the authors or copyright holders be liable for any claim damages or other liability whether in an action of contract tort or otherwise arising from out of or in connection with the software or the use or other dealings in the software"],
    "isc-grant": ["permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted provided that the above copyright notice and this permission notice appear in all copies"],
    "0bsd-grant": ["permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted"],
    "isc-name": ["licensed under the isc license", "isc license", "released under the isc license"],
    "bsl-grant": ["boost software license version 1 0", "distributed under the boost software license version 1 0"],
    "zlib-grant": ["this software is provided as is without any express or implied warranty"],
    "zlib-event": ["in no event will the authors be held liable for any damages arising from the use of this software"],
    "agpl3-name": ["licensed under the gnu affero general public license version 3", "this work is licensed under the gnu affero general public license version 3"],
    "agpl3-free-end": ["you can redistribute it and or modify it under the terms of the gnu affero general public license as published by the free software foundation either version 3 of the license or at your option any later version"],
    "lgpl21-name": ["licensed under the gnu lesser general public license version 2 1"],
    "epl2-name": ["licensed under the eclipse public license 2 0", "this program and the accompanying materials are made available under the terms of the eclipse public license 2 0"],
}
# Rules with their SPDX identifier; new ones go to the end, so that the numbers of the others stay.
RULES = [
    ("MIT", ["mit-name", "mit-grant", "mit-notice", "mit-warranty"]),
    ("MIT", ["mit-grant", "mit-notice", "mit-warranty"]),
    ("MIT", ["mit-grant", "mit-notice"]),
    ("MIT", ["mit-name"]),
    ("Apache-2.0", ["apache-name", "apache-use", "apache-copy"]),
    ("Apache-2.0", ["apache-name"]),
    ("GPL-3.0-or-later", ["gpl-free", "gpl-hope"]),
    ("GPL-3.0-or-later", ["gpl-free"]),
    ("GPL-3.0", ["gpl3-name"]),
    ("GPL-2.0", ["gpl2-name"]),
    ("LGPL-3.0", ["lgpl3-name"]),
    ("MPL-2.0", ["mpl2-name"]),
    ("BSD-2-Clause", ["bsd-grant", "bsd-source", "bsd-binary"]),
    ("BSD-3-Clause", ["bsd-name"]),
    ("CC-BY-NC-4.0", ["cc-by-nc-name"]),
    ("CC-BY-4.0", ["cc-by-name"]),
    ("CC-BY-SA-4.0", ["cc-by-sa-name"]),
    ("CC0-1.0", ["cc0-name"]),
    ("Unlicense", ["unlicense"]),
    ("BSD-3-Clause", ["bsd-grant", "bsd-source", "bsd-binary", "bsd-neither"]),
    ("GPL-3.0-or-later", ["gpl-free-begin", "gpl3-free-end"]),
    ("GPL-2.0-or-later", ["gpl-free-begin", "gpl2-free-end"]),
    ("MIT", ["mit-file"]),
    ("Apache-2.0", ["apache-file"]),
    ("MIT", ["mit-grant", "mit-notice", "mit-warranty", "mit-liable"]),
    ("MIT", ["mit-name", "mit-grant", "mit-notice", "mit-warranty", "mit-liable"]),
    ("ISC", ["isc-grant"]),
    ("0BSD", ["0bsd-grant"]),
    ("ISC", ["isc-name"]),
    ("BSL-1.0", ["bsl-grant"]),
    ("Zlib", ["zlib-grant", "zlib-event"]),
    ("AGPL-3.0", ["agpl3-name"]),
    ("AGPL-3.0-or-later", ["gpl-free-begin", "agpl3-free-end"]),
    ("LGPL-2.1", ["lgpl21-name"]),
    ("EPL-2.0", ["epl2-name"]),
]
#: Every known sentence holds one of these (words of one may stand on two lines), so a text without them has none.
HINTS = "(?i)licens|released[^a-z0-9]+under[^a-z0-9]+cc0|permission|copyright|warrant|redistribut|free[^a-z0-9]+software|public[^a-z0-9]+domain|held[^a-z0-9]+liable"
#: Ends of sentences within a line: a full stop, colon, semicolon, exclamation or question mark before white space; and line breaks.
ENDS = r"[\r\n]+|[.:;!?]+\s+"
#: Ends that also hold in a wrapped text: the same marks, and lines without a letter or digit.
_FIRM = r"\n[^A-Za-z0-9\n]*+\n[^A-Za-z0-9]*+|[.:;!?]+\s+"
_MARKER = r"(?m)(^[^A-Za-z0-9\n]*+|[.:;!?]\s+)\(?(?:[0-9]{1,2}|[a-h]|i{1,3}|iv|vi?)[.)][ \t]+(?=[A-Za-z])"
#: The third BSD clause names the holder; each beginning is followed by what stands up to the next one.
_NEITHER = r"(?i)\bneither\s+the\s+names?\s+of\s"
_HOLDER = r"(?is)\A(?>[^:;]*?\snor\s+the\s+names\s+of\s)[^:;]*?\bcontributors\b"


def _normal(text: Column) -> Column:
    return F.trim(F.regexp_replace(F.lower(text), "[^a-z0-9]+", " "))


def _pieces(text: Column, known: dict[str, int]) -> Column:
    """Normalised sentences of a text, the empty ones left out.

    Single line breaks are ends, but count as spaces where lines in a row give a known sentence: from each line on that
    begins like one, as many lines as the longest has words are tried, and the most that give one are joined.
    """
    table = F.create_map(*[F.lit(x) for pair in known.items() for x in pair])
    begins = F.array(*[F.lit(w) for w in sorted({s.split()[0] for s in known})])
    most = max(len(s.split()) for s in known)
    plain = F.regexp_replace(F.regexp_replace(text, "\r\n?", "\n"), _MARKER, "$1")
    parts = F.split(plain, _NEITHER, -1)
    holder = "the copyright holder nor the names of its contributors"
    plain = F.array_join(F.transform(parts, lambda p, i: F.when(i > 0, F.regexp_replace(p, _HOLDER, holder)).otherwise(p)), "neither the name of ")

    def lines(part: Column) -> Column:
        return F.filter(F.transform(F.split(part, "\n", -1), _normal), lambda s: s != "")

    def span(rows: Column, i: Column) -> Column:
        counts = F.sequence(F.least(F.size(rows) - i, F.lit(most)), F.lit(1), F.lit(-1))
        whole = F.filter(counts, lambda k: F.element_at(table, F.array_join(F.slice(rows, i + 1, k), " ")).isNotNull())
        begun = F.array_contains(begins, F.substring_index(F.get(rows, i), " ", 1))
        return F.when(begun, F.coalesce(F.get(whole, F.lit(0)), F.lit(1))).otherwise(F.lit(1))

    def joined(rows: Column) -> Column:
        spans = F.transform(rows, lambda _, i: F.struct(i.alias("at"), span(rows, i).alias("n")))
        long = F.filter(spans, lambda x: x["n"] > 1)

        def step(state: Column, x: Column) -> Column:
            between = F.when(x["at"] > state["next"], F.slice(rows, state["next"] + 1, x["at"] - state["next"])).otherwise(F.array().cast("array<string>"))
            one = F.array(F.array_join(F.slice(rows, x["at"] + 1, x["n"]), " "))
            return F.when(x["at"] < state["next"], state).otherwise(F.struct(
                (x["at"] + x["n"]).alias("next"), F.concat(state["out"], between, one).alias("out")))

        start = F.struct(F.lit(0).alias("next"), F.array().cast("array<string>").alias("out"))
        rest = F.aggregate(long, start, step, lambda s: F.concat(
            s["out"], F.when(s["next"] < F.size(rows), F.slice(rows, s["next"] + 1, F.size(rows) - s["next"])).otherwise(F.array().cast("array<string>"))))
        return F.when(F.size(rows) < 2, rows).otherwise(rest)

    return F.flatten(F.transform(F.transform(F.split(plain, _FIRM, -1), lines), joined))


def _places(rank: int, name: str, wanted: list[int]) -> Column:
    """Where the sequence ``wanted`` stands in ``ids``."""
    sought = F.array(*[F.lit(w) for w in wanted])
    starts = F.filter(F.sequence(F.lit(0), F.size("ids") - 1), lambda i: F.slice("ids", i + 1, len(wanted)) == sought)
    return F.transform(starts, lambda i: F.struct(
        F.lit(name).alias("license"), F.lit(rank).alias("rule"), i.alias("first_sentence"), F.lit(len(wanted)).alias("n_sentences")))


def scan(docs: DataFrame) -> DataFrame:
    """Columns ``doc_id, license, rule, first_sentence, n_sentences``: one row per place of ``docs(doc_id, text)`` where a rule matches.

    ``rule`` is its number from 0, ``first_sentence`` counts the text's non-empty sentences from 0. Of rules that
    match at overlapping sentences the one of more sentences, then of lower number, counts for each of its places. Null, empty and
    unlicensed texts give no row; repeated rows give repeated results; other columns are ignored. Sentences are
    compared whole, so a known one inside a longer sentence is not recognised; hard-wrapped ones are joined, and list
    markers are left out.
    """
    known = {s: i for i, name in enumerate(SENTENCES) for s in SENTENCES[name]}
    number = {name: i for i, name in enumerate(SENTENCES)}
    table = F.create_map(*[F.lit(x) for pair in known.items() for x in pair])
    slim = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).where(F.col("text").rlike(HINTS))
    found = slim.select("doc_id", _pieces(F.col("text"), known).alias("sentences")).withColumn(
        "ids", F.transform("sentences", lambda s: F.coalesce(F.element_at(table, s), F.lit(-1)))).where("exists(ids, x -> x >= 0)")
    matches = [_places(rank, name, [number[p] for p in parts]) for rank, (name, parts) in enumerate(RULES)]
    every = F.flatten(F.array(*matches))
    best = F.filter("m", lambda x: ~F.exists("m", lambda y: ((y["n_sentences"] > x["n_sentences"]) | (
        (y["n_sentences"] == x["n_sentences"]) & (y["rule"] < x["rule"]))) & (y["first_sentence"] < x["first_sentence"] + x["n_sentences"])
                                             & (x["first_sentence"] < y["first_sentence"] + y["n_sentences"])))
    return found.withColumn("m", every).select("doc_id", F.explode(best).alias("x")).select("doc_id", "x.*")
