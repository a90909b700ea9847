"""Licence recognition by sentences and ordered rules.

A text is cut into sentences, which are normalised (lower case, letters and digits only)
and looked up among known licence sentences.  A sentence starts and ends at punctuation
or at a line; line breaks inside it, with comment marks around them, are spaces, so that
wrapped and commented notices are found as well; tags are line breaks.  A licence named by its
identifier in the usual comment counts under that name.  The text's sequence of sentence
identifiers is then matched against rules in their order: a rule that finds its
identifiers one after the other takes them, so that a full licence wins over a mere
mention and no sentence serves two rules.  Identifiers that no rule took are reported.

Every sentence of every whole text is looked at.  A null text is empty and has no
licence.  Repeated rows are scanned one by one; an empty table gives no rows.
Texts of any length are read whole; further columns play no part, whatever their names.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from censa.llm.shared import steps

# Sentences of public licence notices, by identifier.
SENTENCES = {
    "rights": "All rights reserved.",
    "mit-released": "Released under the MIT License.",
    "mit-licensed": "Licensed under the MIT License.",
    "mit-grant": "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions:",
    "mit-notice": "The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software.",
    "apache-2": "Licensed under the Apache License, Version 2.0.",
    "apache-2-header": "Licensed under the Apache License, Version 2.0 (the \"License\");",
    "apache-compliance": "you may not use this file except in compliance with the License.",
    "apache-copy": "You may obtain a copy of the License at",
    "apache-as-is": "Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an \"AS IS\" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied.",
    "gpl-3": "This work is licensed under the GNU General Public License, version 3.",
    "gpl-free": "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.",
    "gpl-hope": "This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY;",
    "cc-by-nc-4": "Licensed under CC BY-NC 4.0.",
    "cc-by-4": "Licensed under CC BY 4.0.",
    "cc-by-sa-4": "Licensed under CC BY-SA 4.0.",
    "bsd-redistribution": "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:",
    "bsd-names": "Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission.",
    "public-domain": "This work is in the public domain.",
    "mit-warranty": "THE SOFTWARE IS PROVIDED \"AS IS\", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT.",
    "mit-liability": "IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.",
    "isc-grant": "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies.",
    "gpl-2-free": "This program is free software; you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation; either version 2 of the License, or (at your option) any later version.",
    "lgpl-2.1-free": "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation; either version 2.1 of the License, or (at your option) any later version.",
    "lgpl-hope": "This library is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY;",
    "agpl-3-free": "This program is free software: you can redistribute it and/or modify it under the terms of the GNU Affero General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.",
    "mpl-2": "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
    "mpl-2-copy": "If a copy of the MPL was not distributed with this file, You can obtain one at",
    "unlicense": "This is free and unencumbered software released into the public domain.",
    "zlib-warranty": "This software is provided 'as-is', without any express or implied warranty.",
    "zlib-grant": "Permission is granted to anyone to use this software for any purpose, including commercial applications, and to alter it and redistribute it freely, subject to the following restrictions:",
    "boost-1": "Distributed under the Boost Software License, Version 1.0.",
    "cc0-dedicated": "To the extent possible under law, the author(s) have dedicated all copyright and related and neighboring rights to this software to the public domain worldwide.",
}
# Rules in their order, each a licence and the identifiers it takes.
RULES = [
    ("Apache-2.0", ("apache-2-header", "apache-compliance", "apache-copy", "apache-as-is")),
    ("Apache-2.0", ("apache-2-header", "apache-compliance")),
    ("Apache-2.0", ("apache-2",)),
    ("MIT", ("mit-grant", "mit-notice", "mit-warranty", "mit-liability")),
    ("MIT", ("mit-grant", "mit-notice", "mit-warranty")),
    ("MIT", ("mit-grant", "mit-notice")),
    ("MIT", ("mit-released",)),
    ("MIT", ("mit-licensed",)),
    ("GPL-3.0-or-later", ("gpl-free", "gpl-hope")),
    ("GPL-3.0-or-later", ("gpl-free",)),
    ("GPL-3.0", ("gpl-3",)),
    ("GPL-2.0-or-later", ("gpl-2-free", "gpl-hope")),
    ("GPL-2.0-or-later", ("gpl-2-free",)),
    ("LGPL-2.1-or-later", ("lgpl-2.1-free", "lgpl-hope")),
    ("LGPL-2.1-or-later", ("lgpl-2.1-free",)),
    ("AGPL-3.0-or-later", ("agpl-3-free", "gpl-hope")),
    ("AGPL-3.0-or-later", ("agpl-3-free",)),
    ("MPL-2.0", ("mpl-2", "mpl-2-copy")),
    ("MPL-2.0", ("mpl-2",)),
    ("ISC", ("isc-grant",)),
    ("Unlicense", ("unlicense",)),
    ("Zlib", ("zlib-warranty", "zlib-grant")),
    ("Zlib", ("zlib-grant",)),
    ("BSL-1.0", ("boost-1",)),
    ("CC0-1.0", ("cc0-dedicated",)),
    ("BSD-3-Clause", ("bsd-redistribution", "bsd-names")),
    ("BSD-2-Clause", ("bsd-redistribution",)),
    ("CC-BY-NC-4.0", ("cc-by-nc-4",)),
    ("CC-BY-SA-4.0", ("cc-by-sa-4",)),
    ("CC-BY-4.0", ("cc-by-4",)),
    ("public-domain", ("public-domain",)),
    ("all-rights-reserved", ("rights",)),
]

#: A sentence ends at punctuation, with what closes quotes, brackets or marks after it.
END = re.compile(r"(?<=[.!?;:])[)\]}\"'”’»*_`]*\s+")
TAG = re.compile(r"</?[A-Za-z][^<>]{0,200}>")
#: A licence by its name of the common list, which is taken as it is.
NAMED = re.compile(r"SPDX-License-Identifier:[ \t]*([A-Za-z0-9.+() -]*[A-Za-z0-9.+)])")
NAME = "spdxid"
LINE = re.compile(r"[\r\n\x0b\x0c\x85\u2028\u2029]+")
OTHER = re.compile(r"[\W_]+")
FIRST = re.compile(r"[^\W_]+")
#: Comment marks that are words; all others hold no letter and fall out by themselves.
MARKS = {"dnl", "rem"}


def normal(sentence: str) -> str:
    return OTHER.sub(" ", sentence.lower()).strip()


def lines(sentence: str) -> list[tuple[str, str]]:
    """The lines of a sentence that hold words, each after its first word in lower case."""
    out = []
    for line in LINE.split(sentence):
        first = FIRST.search(line)
        if first and first[0].lower() in MARKS:
            line = line[first.end() :]
            first = FIRST.search(line)
        if first:
            out.append((first[0].lower(), line))
    return out


class Scanner:
    """Sentences and rules made ready for lookup."""

    def __init__(self, sentences: dict[str, str], rules: list[tuple[str, tuple[str, ...]]]) -> None:
        # By its first word: a known text may itself be cut, at a colon say.
        self.known: dict[str, list[tuple[list[str], str]]] = {}
        for name, text in sentences.items():
            parts = [p for p in map(normal, END.split(text)) if p]
            self.known.setdefault(parts[0].split(" ", 1)[0], []).append((parts, name))
        for found in self.known.values():  # the longest first: one may start like another
            found.sort(key=lambda f: -sum(map(len, f[0])))
        self.rules = rules

    @staticmethod
    def _end(sentence: list[tuple[str, str]], at: int, part: str) -> int:
        """The line after those from ``at`` that together are ``part``, or -1."""
        rest = part
        while at < len(sentence):
            line = normal(sentence[at][1])
            at += 1
            if line == rest:
                return at
            if not rest.startswith(line + " "):
                return -1
            rest = rest[len(line) + 1 :]
        return -1

    def _after(self, sentences: list[list[tuple[str, str]]], row: int, at: int, parts: list[str]) -> tuple[int, int] | None:
        """The place after a known text that starts at a line of a sentence, if it does."""
        for k, part in enumerate(parts):
            if k:  # the part before must have taken its sentence to the end
                if at < len(sentences[row]) or row + 1 == len(sentences):
                    return None
                row, at = row + 1, 0
            at = self._end(sentences[row], at, part)
            if at < 0:
                return None
        return row, at

    def identifiers(self, text: str) -> list[str]:
        """Known sentences of a text in their order."""
        found = []
        if "<" in text:
            text = TAG.sub("\n", text)
        if "SPDX-" in text:
            text = NAMED.sub(lambda m: f"\n.\n{NAME} {m[1].strip('() ')}\n.\n", text)
        sentences = [x for x in map(lines, END.split(text)) if x]
        row, at = 0, 0
        while row < len(sentences):
            if at == len(sentences[row]):
                row, at = row + 1, 0
                continue
            after = None
            if sentences[row][at][0] == NAME:
                found.append(f"spdx:{sentences[row][at][1].split(NAME, 1)[1].strip()}")
            # Few lines start like a known text; only they are normalised as a whole.
            for parts, name in self.known.get(sentences[row][at][0], ()):
                after = self._after(sentences, row, at, parts)
                if after:
                    found.append(name)
                    break
            row, at = after or (row, at + 1)
        return found

    def licences(self, identifiers: list[str]) -> tuple[list[str], list[str]]:
        """Licences in the order of their place, and the identifiers that no rule took."""
        named = [(at, i.split(":", 1)[1]) for at, i in enumerate(identifiers) if i.startswith("spdx:")]
        free = [(at, i) for at, i in enumerate(identifiers) if not i.startswith("spdx:")]
        found = named
        for licence, wanted in self.rules:
            at = 0
            while at + len(wanted) <= len(free):
                if tuple(i for _, i in free[at : at + len(wanted)]) == wanted:
                    found.append((free[at][0], licence))
                    del free[at : at + len(wanted)]
                else:
                    at += 1
        return [x for _, x in sorted(found)], [i for _, i in free]


def scanned(documents: DataFrame, sentences: dict[str, str] = SENTENCES, rules: list[tuple[str, tuple[str, ...]]] = RULES) -> DataFrame:
    """``doc_id``, ``licences`` (in order), ``sentences`` (identifiers in order) and ``unmatched`` of every row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scanner = Scanner(sentences, rules)
        for batch, texts in steps(batches):
            ids = [scanner.identifiers(t) for t in texts]
            both = [scanner.licences(i) for i in ids]
            lists = [pa.array(x, pa.list_(pa.string())) for x in ([b[0] for b in both], ids, [b[1] for b in both])]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), *lists], ["doc_id", "licences", "sentences", "unmatched"])

    rows = documents.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return rows.mapInArrow(run, "doc_id long, licences array<string>, sentences array<string>, unmatched array<string>")
