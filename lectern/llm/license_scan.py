"""License scan by conditional compression.

Lines that speak of licences (CUE) are seeds only: a region is a run of them with the lines around it, as many as the longest template
could reach over on either side, blank lines too, so a wrapped notice is seen whole. Every template whose words are in a region is
confirmed by the exact wording: `exact` if its words stand there in a row, `close` if all but a share MISS of them do in order, with the
words that are missing or different listed, and few others come between: a share MISS or one, and one for each line, as comment marks
make; any number inside a run of cue lines (in windows of six times the longest template, if it is longer).

Where several fit the same words, exact ones go first (save those inside a longer notice that is close), the longest before others, then
those that explain most words beyond their differences, and then those that shorten the words most. For that the words are compressed by
zstandard once plainly and once with the template as raw dictionary; a template that does not shorten them is no match.

A block is a run of cue lines, or several with what lies between if one notice spans them. It gives, in order, a row for each notice found
in it with the lines of that notice, and a row `unknown` for each stretch of it that speaks of licences outside every notice: whole lines, or
the part of a line that a notice leaves. A changed first or last word of a notice belongs to it if it has a cue.

Lines are told apart on the JVM, so only texts with a cue reach Python; a task remembers what it found for equal regions, up to a fixed
number. Whole texts are read. Defined results: null and empty texts and texts without a cue have no block and give no row; repeated
blocks, notices and rows give rows too; an empty table gives none.
"""
import difflib
import hashlib
import re
from collections import Counter
from collections.abc import Iterator
from itertools import accumulate

import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, functions as F

from lectern.llm.frames import pick

#: Notices of public licences, in the wording their stewards publish.
TEMPLATES = {
    "MIT": "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the "
           "\"Software\"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, "
           "distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the "
           "following conditions: The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software.",
    "MIT-notice": "Released under the MIT License.",
    "Apache-2.0": "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License. You may "
                  "obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0",
    "Apache-2.0-notice": "Licensed under the Apache License, Version 2.0.",
    "GPL-3.0": "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the "
               "Free Software Foundation, either version 3 of the License, or (at your option) any later version.",
    "GPL-3.0-notice": "This work is licensed under the GNU General Public License, version 3.",
    "GPL-2.0-notice": "This work is licensed under the GNU General Public License, version 2.",
    "LGPL-2.1": "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published "
                "by the Free Software Foundation; either version 2.1 of the License, or (at your option) any later version.",
    "MPL-2.0": "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with this file, "
               "You can obtain one at http://mozilla.org/MPL/2.0/.",
    "BSD": "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met: "
           "Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer.",
    "ISC": "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above "
           "copyright notice and this permission notice appear in all copies.",
    "Unlicense": "This is free and unencumbered software released into the public domain.",
    "CC-BY-4.0": "Licensed under CC BY 4.0.",
    "CC-BY-SA-4.0": "Licensed under CC BY-SA 4.0.",
    "CC-BY-NC-4.0": "Licensed under CC BY-NC 4.0.",
    "CC0-1.0": "To the extent possible under law, the author has waived all copyright and related or neighboring rights to this work.",
}
CUE = r"(?i)licen[cs]|copyright|permission is hereby|permission to use|redistribut|public domain|warranty|spdx|unencumbered|waived all"
CUES = re.compile(CUE, re.ASCII)  # letters as the JVM takes them
MISS = 0.15
REMEMBER = 50_000
WORD = re.compile(r"[^\W_]+(?:[.\-/][^\W_]+)*")


def words(text: str) -> list[str]:
    return [w.lower() for w in WORD.findall(text)]


def _spots(line: str) -> list[tuple[int, int]]:
    """Where its words stand."""
    return [m.span() for m in WORD.finditer(line)]


class Scanner:
    def __init__(self, templates: dict[str, str]):
        self.plain = zstandard.ZstdCompressor(level=3)
        self.words = {name: words(t) for name, t in templates.items()}
        self.by_template = {name: zstandard.ZstdCompressor(level=3, dict_data=zstandard.ZstdCompressionDict(
            " ".join(own).encode(), dict_type=zstandard.DICT_TYPE_RAWCONTENT)) for name, own in self.words.items()}
        self.counts = {name: Counter(own) for name, own in self.words.items()}
        self.by_start: dict[str, list[str]] = {}
        for name in sorted(templates, key=lambda n: (-len(self.words[n]), n)):
            self.by_start.setdefault(self.words[name][0], []).append(name)
        self.matchers = {name: difflib.SequenceMatcher(None, [], own, autojunk=False) for name, own in self.words.items()}
        #: Templates in whose words another's stand in a row.
        self.longer = {name: [n for n, theirs in self.words.items() if len(theirs) > len(own) and f" {' '.join(own)} " in f" {' '.join(theirs)} "]
                       for name, own in self.words.items()}
        # Each word on a line of its own behind a comment mark, and the others that may come between.
        self.reach = max((2 * len(own) + int(max(1, MISS * len(own))) for own in self.words.values()), default=0)
        self.known: dict[bytes, list[tuple]] = {}

    def saved(self, own: list[str], name: str) -> float:
        """Share of the compressed size that the template saves. Its dictionary id and header are in both sizes alike."""
        data = " ".join(own).encode()
        return 1 - len(self.by_template[name].compress(data)) / len(self.plain.compress(data))

    def exact(self, own: list[str], line: list[int]) -> list[tuple]:
        """(lo, hi, name, saved, []) of templates whose words stand in a row and that shorten these words in compression; of those that
        overlap the longest. What is close to a longer template that holds these words is left out."""
        every = [(i, i + len(self.words[n]), n) for i, w in enumerate(own) for n in self.by_start.get(w, ()) if own[i:i + len(self.words[n])] == self.words[n]]
        taken, found = bytearray(len(own)), []
        for lo, hi, name in sorted(every, key=lambda x: (x[0] - x[1], x)):
            if any(taken[lo:hi]) or (saved := self.saved(own[lo:hi], name)) <= 0:
                continue
            taken[lo:hi] = b"\1" * (hi - lo)
            a, b = max(0, lo - self.reach), hi + self.reach
            more = [x for n in self.longer[name] for x in [self._fits(own[a:b], n, line[a:b], Counter(own[a:b]))] if x and x[0] <= lo - a and x[1] >= hi - a]
            if not more:
                found.append((lo, hi, name, saved, []))
        return found

    def _aligned(self, own: list[str], name: str, shown: list[str]) -> tuple[int, int, int, int, list[str]] | None:
        """(lo, hi, words missing, words between, changes as `-word` and `+word`) of the template in own, or None if it is not there. shown: own with
        the words that are not to be met."""
        theirs, m = self.words[name], self.matchers[name]
        m.set_seq1(own)
        same = m.get_matching_blocks()[:-1]
        missing = len(theirs) - sum(x.size for x in same)
        if not same or missing > MISS * len(theirs):
            return None
        for outer, inner in ((0, 1), (-1, -2)):  # words met by chance, further off than they are many, are missing ones
            while len(same) > 1 and missing + same[outer].size <= MISS * len(theirs):
                left, right = sorted((same[outer], same[inner]))
                if right.a - left.a - left.size <= same[outer].size:
                    break
                missing += same[outer].size
                same = same[1:] if outer == 0 else same[:-1]
        first, last = same[0], same[-1].a + same[-1].size
        lost = len(theirs) - same[-1].b - same[-1].size
        # As many words before and after as the template misses there stand for them, from the outermost with a cue on.
        lo = next((i for i in range(max(0, first.a - first.b), first.a) if CUES.search(shown[i])), first.a)
        hi = next((i for i in range(min(len(own), last + lost), last, -1) if CUES.search(shown[i - 1])), last)
        changes, a, b = [], lo, 0
        for x in same:
            changes += [f"-{w}" for w in theirs[b:x.b]] + [f"+{w}" for w in shown[a:x.a]]
            a, b = x.a + x.size, x.b + x.size
        changes += [f"-{w}" for w in theirs[b:]] + [f"+{w}" for w in shown[last:hi]]
        between = last - first.a - sum(x.size for x in same)
        return lo, hi, missing, between, changes

    def _fits(self, own: list[str], name: str, line: list[int] | None, counts: Counter) -> tuple[int, int, int, int, list[str]] | None:
        """What _aligned gives, or None if too many words are missing (told by counts first) or come between. Where words of several places were
        aligned together, the words about the longest run are tried alone, then those without that run."""
        theirs, masked, extra = self.words[name], own, max(1, MISS * len(self.words[name]))
        while sum(min(n, counts[w]) for w, n in self.counts[name].items()) >= (1 - MISS) * len(theirs):
            x = self._aligned(masked, name, own)
            if x and (line is None or x[3] <= extra + line[x[1] - 1] - line[x[0]]):
                return x
            run = max(self.matchers[name].get_matching_blocks(), key=lambda r: r.size)
            if not run.size:
                return None
            if line is not None:
                lo, hi = run.a, run.a + run.size
                left, right = run.b + extra, len(theirs) - run.b - run.size + extra
                while lo and left >= 1:
                    left += line[lo] - line[lo - 1] - 1
                    lo -= 1
                while hi < len(own) and right >= 1:
                    right += line[hi] - line[hi - 1] - 1
                    hi += 1
                x = self._aligned(masked[lo:hi], name, own[lo:hi])
                if x and x[3] <= extra + line[lo + x[1] - 1] - line[lo + x[0]]:
                    return lo + x[0], lo + x[1], *x[2:]
            counts = counts - Counter(masked[run.a:run.a + run.size])
            masked = masked[:run.a] + [""] * run.size + masked[run.a + run.size:]
        return None

    def close(self, own: list[str], line: list[int] | None) -> list[tuple]:
        """(lo, hi, name, saved, changes), best first, each in what its predecessors left. line: of each word; None if any number may come between."""
        found, left, step = [], [(0, len(own))], 2 * self.reach
        while left:
            lo, hi = left.pop()
            # A notice is no longer than `reach`, so long parts are gone through window by window.
            more = hi - lo > step + self.reach
            end = lo + step + self.reach if more else hi
            part, lines, best = own[lo:end], line and line[lo:end], None
            here = Counter(part)
            for name, theirs in self.words.items():
                x = self._fits(part, name, lines, here)
                while more and x and x[0] >= step:
                    x = self._fits(part[:x[0]], name, lines, Counter(part[:x[0]]))
                if not x:
                    continue
                saved = self.saved(part[x[0]:x[1]], name)
                rank = (len(x[4]) + x[2] - len(theirs), x[2], -saved, name)
                if saved > 0 and (best is None or rank < best[0]):
                    best = rank, (lo + x[0], lo + x[1], name, saved, x[4])
            if best:
                found.append(best[1])
                left += [(lo, best[1][0]), (best[1][1], hi)]
            elif more:
                left.append((lo + step, hi))
        return found

    def notices(self, region: list[tuple[bool, list[str]]]) -> list[tuple]:
        """Lines as (has a cue, words) to (first line, its word, last line, words of it up to the end, status, license, saved share, differences),
        in order."""
        key = hashlib.blake2b("\n".join(f"{cue:d}{' '.join(own)}" for cue, own in region).encode("utf-8", "surrogatepass"), digest_size=16).digest()
        if key not in self.known:
            if len(self.known) >= REMEMBER:
                self.known.clear()
            self.known[key] = self._notices(region)
        return self.known[key]

    def _notices(self, region: list[tuple[bool, list[str]]]) -> list[tuple]:
        own = [w for _, ws in region for w in ws]
        line = [i for i, (_, ws) in enumerate(region) for _ in ws]
        filled = list(accumulate(bool(ws) for _, ws in region))
        nth = [filled[i] for i in line]
        found = self.exact(own, nth)

        def rest(parts):
            """The parts (lo, hi) of own without what is found."""
            spans = sorted(x[:2] for x in found)
            for lo, hi in parts:
                for a, b in spans:
                    if a < hi and b > lo:
                        if a > lo:
                            yield lo, a
                        lo = b
                if lo < hi:
                    yield lo, hi

        cue = [region[i][0] for i in line]
        edges = [i for i in range(len(own) + 1) if (0 < i and cue[i - 1]) != (i < len(own) and cue[i])]
        for parts, strict in (([(0, len(own))], True), (zip(edges[::2], edges[1::2]), False)):
            found += [(lo + a, lo + b, *x) for lo, hi in list(rest(parts)) for a, b, *x in self.close(own[lo:hi], nth[lo:hi] if strict else None)]
        before = [0, *accumulate(len(ws) for _, ws in region)]
        return [(line[lo], lo - before[line[lo]], line[hi - 1], hi - before[line[hi - 1]], "close" if changes else "exact", name, round(saved, 6), changes)
                for lo, hi, name, saved, changes in sorted(found)]

    def scan_text(self, text: str, cues: list[int]) -> list[tuple]:
        """Rows (block_no, block, status, license, saved share, differences) of a text whose lines `cues` (ascending) have a cue."""
        lines, has, own = text.split("\n"), set(cues), {}

        def of(i):
            if i not in own:
                own[i] = words(lines[i])
            return own[i]

        regions: list[list[int]] = []
        for i in cues:
            if regions and i - 1 in has:
                lo = regions.pop()[0]
            else:
                lo, n = i, 0
                floor = regions[-1][1] if regions else 0
                while lo > floor and n < self.reach:
                    lo -= 1
                    n += len(of(lo))
            hi, n = i, 0
            if i + 1 not in has:
                while hi < len(lines) - 1 and n < self.reach:
                    hi += 1
                    n += len(of(hi))
            if regions and lo <= regions[-1][1]:
                lo, _ = regions.pop()
            regions.append([lo, hi])
        spans = []
        for lo, hi in regions:
            part, skip = [(i in has, of(i)) for i in range(lo, hi + 1)], 0
            if not part[-1][0]:
                part[-1] = (False, part[-1][1][:self.reach])
            if not part[0][0]:
                skip = max(0, len(part[0][1]) - self.reach)
                part[0] = (False, part[0][1][skip:])
            spans += [(lo + a, at + (0 if a else skip), lo + b, end + (0 if b else skip), x) for a, at, b, end, *x in self.notices(part)]
        spans = sorted(spans + self._unknown(lines, cues, spans), key=lambda x: x[:4])
        # Rows that share a line share it out, so that no part of the text is in several rows.
        starts = [0, *accumulate(len(x) + 1 for x in lines)]
        begins = [starts[a] + (_spots(lines[a])[at][0] if n and spans[n - 1][2] == a else 0) for n, (a, at, *_) in enumerate(spans)]
        ends = [begins[n + 1] if n + 1 < len(spans) and spans[n + 1][0] == x[2] else starts[x[2] + 1] - 1 for n, x in enumerate(spans)]
        blocks: list[list] = []
        runs = [(i, i + (i + 1 in has), None) for i in cues]
        for lo, hi, row in sorted(runs + [(a, b, (text[begin:end], *x)) for (a, _, b, _, x), begin, end in zip(spans, begins, ends)], key=lambda x: x[:2]):
            if blocks and lo <= blocks[-1][1]:
                blocks[-1][1] = max(blocks[-1][1], hi)
            else:
                blocks.append([lo, hi, []])
            if row:
                blocks[-1][2].append(row)
        return [(n, *row) for n, (_, _, found) in enumerate(blocks) for row in found]

    @staticmethod
    def _unknown(lines: list[str], cues: list[int], notices: list[tuple]) -> list[tuple]:
        """Stretches of cue lines outside the notices, as these are given: lines without a notice, and what one leaves of a line if a cue is in it."""
        on: dict[int, list[tuple[int, int]]] = {}
        for a, at, b, end, _ in notices:
            for i in range(a, b + 1):
                on.setdefault(i, []).append((at if i == a else 0, end if i == b else len(_spots(lines[i]))))
        parts: list[list[int]] = []  # line, word, line, words up to the end, whether that is all of its line
        for i in cues:
            spots = _spots(lines[i])
            edges = [0, *[e for span in on.get(i, ()) for e in span], len(spots)]
            for lo, hi in zip(edges[::2], edges[1::2]):
                if i in on and (lo == hi or not CUES.search(lines[i][spots[lo][0]:spots[hi - 1][1]])):
                    continue
                if parts and parts[-1][2] == i - 1 and parts[-1][4] and not lo:
                    parts[-1][2:] = i, hi, hi == len(spots)
                else:
                    parts.append([i, lo, i, hi, hi == len(spots)])
        return [(a, at, b, end, ["unknown", None, 0.0, []]) for a, at, b, end, _ in parts]

    def scan(self, block: str) -> tuple[str, str | None, float, list[str]]:
        """(status, license, saved share, differences) of the first notice in a text of cue lines, or `unknown` if it has none"""
        rows = self.scan_text(block, list(range(block.count("\n") + 1)))
        return next((x for x in rows if x[3]), rows[0])[2:]


def scanned(docs: DataFrame, templates: dict[str, str] | None = None) -> DataFrame:
    """docs (doc_id, text) to a row per notice or unknown block: (doc_id, block_no, block, status, license, saved, differences)."""
    templates = TEMPLATES if templates is None else templates
    rows = pick(docs, "doc_id", "text").filter(F.col("text").rlike(CUE))
    kind = rows.schema["doc_id"].dataType.simpleString()
    cues = F.filter(F.transform(F.split("text", "\n"), lambda s, i: F.when(s.rlike(CUE), i)), lambda i: i.isNotNull())

    def task(batches) -> Iterator[pa.RecordBatch]:
        scanner = Scanner(templates)
        types = [pa.int32(), pa.string(), pa.string(), pa.string(), pa.float64(), pa.list_(pa.string())]
        for b in batches:
            for lo in range(0, b.num_rows, 500):
                part = b.slice(lo, 500)
                found = [(i, *x) for i in range(part.num_rows) for x in scanner.scan_text(part.column(1)[i].as_py(), part.column(2)[i].as_py())]
                if found:
                    at, *columns = zip(*found)
                    yield pa.RecordBatch.from_arrays([part.column(0).take(pa.array(at)), *[pa.array(x, t) for x, t in zip(columns, types)]],
                                                     names=["doc_id", "block_no", "block", "status", "license", "saved", "differences"])

    return (rows.select("doc_id", "text", cues.alias("cues"))
            .mapInArrow(task, f"doc_id {kind}, block_no int, block string, status string, license string, saved double, differences array<string>"))
