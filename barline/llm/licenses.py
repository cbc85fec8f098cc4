"""License scans: normalised text against templates by Dice coefficient over word bigrams (operator 1).

Texts are lower-cased and cut into words of letters and digits.  What is compared with the templates is
each line of a document, the document as a whole, and every passage: every window of consecutive words,
across lines.  The coefficient of two sets of bigrams is 2 |A and B| / (|A| + |B|); at least ``least`` needs
sizes within a factor least / (2 - least) of each other, and as large a share of the template's bigrams in
the document, which leaves few documents and templates to compare.  A unit of one word has that word as
its only bigram.

A best window begins and ends with a bigram of the template that stands nowhere else in the window, or it
could be shortened without loss; only such windows are tried.

Templates are notices, and the bodies of the licenses in ``license_bodies``.

Defined results: dice is that of lines and the whole text, 0 if none reaches least; license is theirs, or
else the passage's, with unit ``passage`` and the line it begins in; a document without a match has null
license, unit and line and dice 0.  Ties go to the higher coefficient, then the earlier line (the whole
text last), then the first license by name.  passage_license, passage_dice, passage_at (its first word, from
0) and passage_words are of the best passage; ties go to the earlier, then shorter one, then the first
license by name.  Passages have two words at least.  Null and empty texts match nothing; repeated rows get
equal rows; an empty table gives an empty result; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from . import textkit as tk
from .shared import bounded_batches

LEAST = 0.8

# Notices of public licenses, as they stand in files.
TEMPLATES = {
    "MIT": (
        "Released under the MIT License.",
        "Licensed under the MIT License.",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions: The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software.",
    ),
    "Apache-2.0": (
        "Licensed under the Apache License, Version 2.0.",
        "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0",
    ),
    "GPL-3.0": (
        "This work is licensed under the GNU General Public License, version 3.",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.",
    ),
    "GPL-2.0": (
        "This work is licensed under the GNU General Public License, version 2.",
        "This program is free software; you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation; either version 2 of the License, or (at your option) any later version.",
    ),
    "LGPL-3.0": ("This work is licensed under the GNU Lesser General Public License, version 3.",),
    "AGPL-3.0": ("This work is licensed under the GNU Affero General Public License, version 3.",),
    "MPL-2.0": ("This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with this file, You can obtain one at http://mozilla.org/MPL/2.0/.",),
    "BSD-3-Clause": (
        "Released under the BSD 3-Clause License.",
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:",
    ),
    "ISC": ("Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies.",),
    "Unlicense": ("This is free and unencumbered software released into the public domain.",),
    "CC0-1.0": ("Released into the public domain under CC0 1.0 Universal.",),
    "CC-BY-4.0": ("Licensed under CC BY 4.0.", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    "CC-BY-SA-4.0": ("Licensed under CC BY-SA 4.0.", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License."),
    "CC-BY-NC-4.0": ("Licensed under CC BY-NC 4.0.", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License."),
}

for _body in sorted(Path(__file__).with_name("license_bodies").glob("*.txt")):
    TEMPLATES[_body.stem] = (*TEMPLATES.get(_body.stem, ()), _body.read_text())


def _bigrams(data: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray, tk.Words]:
    """Bigram hashes of each unit data[offs[k]:offs[k + 1]], in order, with their bounds, and the words."""
    data = tk.LOWER[data]
    words = tk.find_words(data, offs, tk.ALNUM)
    names = tk.word_hashes(data, words)
    size = np.diff(words.bounds)
    count = np.where(size > 1, size - 1, size)
    unit = np.repeat(np.arange(len(size)), count)
    bounds = np.concatenate(([0], np.cumsum(count)))
    at = words.bounds[unit] + np.arange(int(bounds[-1])) - bounds[unit]
    return tk.seq_hash(names, at, np.minimum(size, 2)[unit]), bounds, words


@dataclass
class Templates:
    names: list[str]
    sets: list[np.ndarray]
    known: np.ndarray  # all templates' bigrams, sorted
    owners: np.ndarray  # the templates that have each of them
    bounds: np.ndarray
    short: np.ndarray  # whether a template is one word

    @staticmethod
    def of(texts: dict[str, tuple[str, ...]]) -> Templates:
        names, sets, short = [], [], []
        for name, notices in sorted(texts.items()):
            for notice in notices:
                data = np.frombuffer(notice.encode(), np.uint8)
                keys, _, words = _bigrams(data, np.array([0, len(data)]))
                names.append(name)
                sets.append(np.unique(keys))
                short.append(len(words) < 2)
        flat, owner = np.concatenate(sets), np.repeat(np.arange(len(sets)), [len(t) for t in sets])
        by = np.lexsort((owner, flat))
        known, first = np.unique(flat[by], return_index=True)
        return Templates(names, sets, known, owner[by], np.append(first, len(flat)), np.array(short))

    def likely(self, keys: np.ndarray, at: np.ndarray, least: float) -> list[tuple[int, np.ndarray]]:
        """Documents with templates of which they have so many bigrams as any match in them needs."""
        place = np.minimum(np.searchsorted(self.known, keys), len(self.known) - 1)
        hit = np.flatnonzero(self.known[place] == keys)
        pair = np.unique(tk.doc_of(at)[hit] * len(self.known) + place[hit])
        doc, one = np.divmod(pair, len(self.known))
        many = self.bounds[one + 1] - self.bounds[one]
        nth = np.arange(int(many.sum())) - np.repeat(np.cumsum(many) - many, many)
        owner = self.owners[np.repeat(self.bounds[one], many) + nth]
        n, t = len(at) - 1, len(self.sets)
        count = np.bincount(np.repeat(doc, many) * t + owner, minlength=n * t).reshape(n, t)
        enough = count >= np.array([len(x) for x in self.sets]) * (least / (2 - least)) - 1e-9
        enough |= self.short & (np.diff(at) > 0)[:, None]
        return [(d, np.flatnonzero(enough[d])) for d in np.flatnonzero(enough.any(1)).tolist()]

    def best(self, bigrams: np.ndarray, least: float, which: np.ndarray) -> tuple[float, str] | None:
        """Highest coefficient of a set with one of these templates, if it reaches least."""
        n, found = len(bigrams), None
        bound = least / (2 - least)
        for k in which.tolist():
            name, t = self.names[k], self.sets[k]
            if min(n, len(t)) < bound * max(n, len(t)):
                continue
            dice = 2 * len(np.intersect1d(bigrams, t, assume_unique=True)) / (n + len(t))
            if dice >= least and (found is None or (-dice, name) < (-found[0], found[1])):
                found = dice, name
        return found

    def passage(self, keys: np.ndarray, least: float, which: np.ndarray) -> tuple[float, int, int, str] | None:
        """Coefficient, first word, number of words and license of the best window of a document's bigrams."""
        by = np.argsort(keys, kind="stable")
        same = keys[by[1:]] == keys[by[:-1]]
        before, after = np.full(len(keys), -1), np.full(len(keys), len(keys))
        before[by[1:][same]], after[by[:-1][same]] = by[:-1][same], by[1:][same]
        found: tuple = (-least, 0, 0, "")
        any_ = False
        for k in which.tolist():
            t = self.sets[k]
            n = len(t)
            if self.short[k]:
                continue
            place = np.minimum(np.searchsorted(t, keys), n - 1)
            mine = t[place] == keys
            starts = np.flatnonzero(mine)
            total = len(np.unique(place[starts]))
            if 2 * total / (total + n) < -found[0]:
                continue
            most, chunk = n * (2 - least) / least, int(n * (2 - least) / least) + 2
            for a in starts.tolist():
                # Up to where the first bigram comes again, or the window has too many.
                size = common = 0
                at, end = a, int(after[a])
                while at < end and size <= most:
                    to = min(at + chunk, end)
                    new = before[at:to] < a
                    sizes = size + np.cumsum(new)
                    new &= mine[at:to]
                    shared = common + np.cumsum(new)
                    last = np.flatnonzero(new)
                    if len(last):
                        dice = 2 * shared[last] / (sizes[last] + n)
                        j = int(dice.argmax())
                        rank = (-float(dice[j]), a, at + int(last[j]) - a + 2, self.names[k])
                        if -rank[0] >= least and (not any_ or rank < found):
                            found, any_ = rank, True
                    size, common, at = int(sizes[-1]), int(shared[-1]), to
        return (-found[0], *found[1:]) if any_ else None


def _units(piece: tk.Piece) -> tuple[np.ndarray, np.ndarray]:
    """Bounds of all lines of the piece, and each document's first line."""
    breaks = np.flatnonzero(piece.data == 0x0A) + 1
    offs = np.unique(np.concatenate([breaks, piece.offs]))
    return offs, np.searchsorted(offs, piece.offs)


MATCH = "doc_id long, license string, dice double, unit string, line long, n_matches long, passage_license string, passage_dice double, passage_at long, passage_words long"


def license_scan(documents: DataFrame, least: float = LEAST, texts: dict[str, tuple[str, ...]] | None = None) -> DataFrame:
    """(doc_id, license, dice, unit, line, n_matches, and its best passage) of each document: its best
    match, and how many of its lines match a template."""
    bounded_batches(documents.sparkSession)
    templates = documents.sparkSession.sparkContext.broadcast(Templates.of(texts or TEMPLATES))

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        t = templates.value
        longest = max(map(len, t.sets)) * (2 - least) / least
        for batch in batches:
            out = []
            for piece in tk.pieces(batch.column("text")):
                found: list[tuple] = [(None, 0.0, None, None, 0, None, 0.0, None, None)] * piece.n
                keys, at, words = _bigrams(piece.data, piece.offs)
                likely = t.likely(keys, at, least)
                if likely:
                    offs, first = _units(piece)
                    line_keys, line_at, _ = _bigrams(piece.data, offs)
                for d, which in likely:
                    best, matches = None, 0
                    units = [(int(u), False) for u in range(first[d], first[d + 1]) if line_at[u] < line_at[u + 1]]
                    for u, whole in [*units, (d, True)]:
                        unit = np.unique(keys[at[d] : at[d + 1]] if whole else line_keys[line_at[u] : line_at[u + 1]])
                        match = t.best(unit, least, which) if len(unit) <= longest else None
                        if match is None:
                            continue
                        matches += not whole
                        line = None if whole else u - int(first[d])
                        rank = (-match[0], whole, line or 0, match[1])
                        if best is None or rank < best[0]:
                            best = (rank, match[1], match[0], "text" if whole else "line", line)
                    window = t.passage(keys[at[d] : at[d + 1]], least, which) if words.bounds[d + 1] - words.bounds[d] > 1 else None
                    if best is None and window is not None:
                        begin = words.start[words.bounds[d] + window[1]]
                        best = (None, window[3], 0.0, "passage", int(np.searchsorted(offs, begin, "right")) - 1 - int(first[d]))
                    dice, word, count, name = window or (0.0, None, None, None)
                    found[d] = (*(best[1:] if best else found[d][:4]), matches, name, dice, word, count)
                out += found
            names = [x.split()[0] for x in MATCH.split(", ")]
            cols = list(zip(*out, strict=True)) if out else [[]] * 9
            kinds = (pa.string(), pa.float64(), pa.string(), pa.int64(), pa.int64(), pa.string(), pa.float64(), pa.int64(), pa.int64())
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), *(pa.array(c, k) for c, k in zip(cols, kinds, strict=True))], names=names)

    return documents.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(scan, MATCH)
