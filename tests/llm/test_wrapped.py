"""Licence sentences wrapped anywhere, long holders, and benchmark items copied in capitals."""
import re

import pytest

from trailkeep.llm import decontaminate, licenses

UNLICENSE = "This is free and unencumbered software released into the public\ndomain."
BSD = ("Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:\n"
       "1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer.\n"
       "2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the "
       "documentation and/or other materials provided with the distribution.\n"
       "3. Neither the name of %s nor the names of its contributors may be used to endorse or promote products derived from this software without "
       "specific prior written permission.")


def found(spark, text):
    docs = spark.createDataFrame([(1, text)], "doc_id long, text string")
    return [(r.license, r.first_sentence) for r in licenses.scan(docs).orderBy("first_sentence").collect()]


@pytest.mark.parametrize("text, expected", [
    (UNLICENSE, [("Unlicense", 0)]),
    ("My Tool\nLicensed under the Apache License,\nVersion 2.0\nCopyright by X", [("Apache-2.0", 1)]),
    ("a\nLicensed under the\nMIT license\nb\nreleased under the\nBSD license\nc", [("MIT", 1), ("BSD-3-Clause", 3)]),
    ("\n".join(["line"] * 100) + "\nmit\nlicense\n" + "\n".join(["line"] * 100), [("MIT", 100)]),
    (BSD % "X", [("BSD-3-Clause", 0)]),
    (BSD % ("The Very Long Holder Inc. " * 30), [("BSD-3-Clause", 0)]),
    (re.sub(r"(?<![0-9]\.) ", "\n", BSD) % "X", [("BSD-3-Clause", 0)]),
    ("This project is licensed under the MIT license - see the LICENSE file.", [("MIT", 0)]),
    ("Permission to use, copy, modify, and/or distribute this software for any\npurpose with or without fee is hereby granted.", [("0BSD", 0)]),
    ("licensed under\n\nthe MIT license", []),
    ("copyright\n" * 3_000, []),
    ("neither the name of " * 20_000 + "licence", [])])
def test_sentences_wrapped_anywhere(spark, text, expected):
    assert found(spark, text) == expected


ITEM = "the river crosses the old stone bridge where two hundred people gather every spring to watch the boats go by slowly"


@pytest.mark.parametrize("copy", [str.upper, str.title, str, lambda t: "Intro words here. " + t.upper() + ". More words follow it."])
def test_items_in_capitals_are_found(spark, copy):
    docs = spark.createDataFrame([(1, copy(ITEM)), (2, "nothing of the kind stands in this text about " + "other things " * 9)], "doc_id long, text string")
    items = spark.createDataFrame([(7, ITEM)], "item_id long, text string")
    hits = {(r.doc_id, r.item_id) for r in decontaminate.find(docs, items).collect()}
    assert hits == ({(1, 7)} if copy is not str.title else hits & {(1, 7)})
