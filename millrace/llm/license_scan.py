"""Licence notices in documents by conditional compression against notice templates."""

from __future__ import annotations

import difflib
import math
import re
from bisect import bisect_right
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm.tables import map_batches
from millrace.llm.text import texts

# Wording of public licence notices.
TEMPLATES = {
    "MIT": "Released under the MIT License.",
    "MIT-grant": (
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
        "documentation files, to deal in the Software without restriction, including without limitation the rights to "
        "use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software."
    ),
    "Apache-2.0": "Licensed under the Apache License, Version 2.0.",
    "Apache-2.0-notice": (
        "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in "
        "compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0"
    ),
    "GPL-3.0": "This work is licensed under the GNU General Public License, version 3.",
    "GPL-3.0-notice": (
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General "
        "Public License as published by the Free Software Foundation, either version 3 of the License, or (at your "
        "option) any later version."
    ),
    "LGPL": "This library is licensed under the GNU Lesser General Public License.",
    "BSD": (
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that "
        "the following conditions are met."
    ),
    "MPL-2.0": "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
    "CC-BY-4.0": "Licensed under CC BY 4.0.",
    "CC-BY-SA-4.0": "Licensed under CC BY-SA 4.0.",
    "CC-BY-NC-4.0": "Licensed under CC BY-NC 4.0.",
    "CC-BY-notice": "This work is licensed under a Creative Commons Attribution 4.0 International License.",
    "CC0": "To the extent possible under law, the author has waived all copyright and related rights to this work.",
    "reserved": "All rights reserved.",
}
HINT = re.compile(
    r"licen[sc]e|copyright|spdx|warrant(y|ies)|redistribut|creative commons|public domain|rights reserved|\bcc[ -]by|"
    r"hereby granted|without restriction",
    re.IGNORECASE,
)
SENTENCE = re.compile(r"(?<=[.;!?])[ \t]+|\n+")
BLANK = re.compile(r"\n[ \t\r]*(?=\n)")
WORD = re.compile(r"\w+(?:[.-]\w+)*")


class Scanner:
    def __init__(self, templates: dict[str, str], level: int = 9) -> None:
        from zstandard import DICT_TYPE_RAWCONTENT, ZstdCompressionDict, ZstdCompressor

        quiet = {"level": level, "write_content_size": False, "write_checksum": False, "write_dict_id": False}
        self.plain = ZstdCompressor(**quiet)
        self.names = list(templates)
        self.words = [self.split(t) for t in templates.values()]
        self.bags = [Counter(w) for w in self.words]
        self.given = [
            ZstdCompressor(dict_data=ZstdCompressionDict(t.lower().encode(), dict_type=DICT_TYPE_RAWCONTENT), **quiet)
            for t in templates.values()
        ]

    @staticmethod
    def split(text: str) -> list[str]:
        return WORD.findall(text.lower())

    def ranked(self, block: str) -> list[tuple[float, int]]:
        """Share of the compressed size that each template saves, the largest first."""
        raw = block.lower().encode("utf-8", "surrogatepass")
        alone = len(self.plain.compress(raw))
        saving = [(1 - len(c.compress(raw)) / alone, k) for k, c in enumerate(self.given)]
        return sorted(saving, key=lambda s: (-s[0], s[1]))

    def confirmed(self, block: str, tries: int, least: float) -> tuple | None:
        """Best-ranked template of which at least ``least`` of the words stand in the block in order."""
        words = self.split(block)
        for saving, k in self.ranked(block)[:tries]:
            matcher = difflib.SequenceMatcher(None, words, self.words[k], autojunk=False)
            same = sum(m.size for m in matcher.get_matching_blocks())
            if saving > 0 and same >= least * len(self.words[k]):
                return self.names[k], saving, same / len(self.words[k]), len(self.words[k]) - same
        return None

    def blocks(self, text: str) -> Iterator[tuple[int, str]]:
        """Sentences that hint at a licence with their place, and runs of such sentences as one."""
        if not HINT.search(text):
            return
        parts, at = [], 0
        for gap in SENTENCE.finditer(text):
            parts.append((at, text[at : gap.start()]))
            at = gap.end()
        parts.append((at, text[at:]))
        run: list[int] = []
        for k in [*[k for k, p in enumerate(parts) if HINT.search(p[1])], len(parts) + 2]:
            if run and k - run[-1] > 2:
                if len(run) > 1:
                    yield parts[run[0]][0], text[parts[run[0]][0] : parts[run[-1]][0] + len(parts[run[-1]][1])]
                run = []
            if k < len(parts):
                run.append(k)
                yield parts[k]

    def wrapped(self, text: str, least: float) -> Iterator[tuple]:
        """Notices over several lines: name, start, saving, wording and missing words.

        Looked for around hints, as far as the longest template on either side and not over
        blank lines. Of templates confirmed at one place that with the most words counts.
        """
        reach = max(map(len, self.words))
        edges = [0, *[g.end() for g in BLANK.finditer(text)], len(text)]
        for begin, end in zip(edges[:-1], edges[1:], strict=True):
            part = text[begin:end]
            if "\n" not in part.strip() or not HINT.search(part):
                continue
            found = list(WORD.finditer(part))
            starts = [m.start() for m in found]
            spans: list[list[int]] = []
            for hint in HINT.finditer(part):
                at = bisect_right(starts, hint.start())
                if spans and at - reach <= spans[-1][1]:
                    spans[-1][1] = min(at + reach, len(found))
                else:
                    spans.append([max(at - reach, 0), min(at + reach, len(found))])
            hits = []
            for lo, hi in spans:
                words = [m[0].lower() for m in found[lo:hi]]
                bag = Counter(words)
                for k, known in enumerate(self.words):
                    if sum((bag & self.bags[k]).values()) < least * len(known):
                        continue
                    anchor = difflib.SequenceMatcher(None, words, known, autojunk=False).find_longest_match()
                    slack = math.ceil((1 - least) * len(known))
                    first = max(anchor.a - anchor.b - slack, 0)
                    near = words[first : anchor.a - anchor.b + len(known) + slack]
                    same = [m for m in difflib.SequenceMatcher(None, near, known, autojunk=False).get_matching_blocks() if m.size]
                    size = sum(m.size for m in same)
                    if size >= least * len(known):
                        hits.append((size, k, lo + first + same[0].a, lo + first + same[-1].a + same[-1].size))
            taken: list[tuple[int, int]] = []
            for size, k, a, b in sorted(hits, key=lambda h: (-h[0], h[1])):
                if any(a < y and x < b for x, y in taken):
                    continue
                taken.append((a, b))
                raw = " ".join(m[0] for m in found[a:b]).lower().encode("utf-8", "surrogatepass")
                saving = 1 - len(self.given[k].compress(raw)) / len(self.plain.compress(raw))
                yield self.names[k], begin + starts[a], saving, size / len(self.words[k]), len(self.words[k]) - size


def license_notices(
    documents: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    *,
    templates: dict[str, str] | None = None,
    tries: int = 3,
    least: float = 0.8,
) -> DataFrame:
    """One row per notice found: ``key``, ``license``, ``start``, ``saving``, ``wording``, ``missing``.

    Candidate blocks are sentences with a licence word and runs of such sentences. Each is
    compressed in lower case, alone and with each template as raw dictionary; templates are ranked by the
    share of the size saved, and the best three are confirmed by the words they have in
    common with the block, in order; notices wrapped over lines are looked for by the words
    around each hint and all templates: ``wording`` is the share of the template's words found
    and ``missing`` the number not found. A licence is reported once per document, at its
    first place (``start``, in characters) with the best wording.

    Null, empty and unrelated texts give no rows, repeated rows each their own, an empty
    table none; other columns are ignored. There is no shuffle.
    """
    known = templates or TEMPLATES

    def make():
        scanner = Scanner(known)

        def work(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
            rows, found = [], []
            for row, body in enumerate(texts(batch.column(1))):
                best: dict[str, tuple] = {}
                for start, block in scanner.blocks(body):
                    hit = scanner.confirmed(block, tries, least)
                    if hit and (hit[0] not in best or hit[2] > best[hit[0]][2]):
                        best[hit[0]] = (start, hit[1], hit[2], hit[3])
                for name, start, *rest in scanner.wrapped(body, least) if HINT.search(body) else ():
                    if name not in best or rest[1] > best[name][2]:
                        best[name] = (start, *rest)
                for name in sorted(best):
                    rows.append(row)
                    found.append((name, *best[name]))
            if rows:
                columns = list(zip(*found, strict=True))
                kinds = [pa.string(), pa.int64(), pa.float64(), pa.float64(), pa.int64()]
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).take(pa.array(rows))] + [pa.array(c, k) for c, k in zip(columns, kinds, strict=True)],
                    [key, "license", "start", "saving", "wording", "missing"],
                )

        return work

    rows = documents.select(F.col(key), F.col(text).cast("string"))
    kind = rows.schema[key].dataType.simpleString()
    return map_batches(rows, make, f"`{key}` {kind}, license string, start bigint, saving double, wording double, missing bigint")
