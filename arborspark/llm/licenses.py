"""License scans: fuzzy search for short notices.

A notice of which at most k edits are allowed is split into k + 1 pieces; by
the pigeonhole principle one of them stands unchanged in every match.  One
automaton finds the pieces of all notices, and only around those seeds the
regex library's bounded-error matching verifies the notice and gives its span.
Each seed has its own window, so a match hides no worse one beside it.  A match
begins and ends at borders of words.
Text is matched as its words joined by one space, so punctuation and line
breaks between words cost no edits.
"""

from __future__ import annotations

import bisect
import heapq
import re
from collections.abc import Iterator, Sequence
from functools import cached_property
from itertools import accumulate

import ahocorasick
import pandas as pd
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# fixed values: base phrases and labels
BASE = {"gnu general public license": "gpl", "apache license": "apache", "cc by": "cc-by", "mit license": "mit"}

#: Notices searched with errors; a label of their own where the base has none.
NOTICES = {
    "gnu general public license": "gpl",
    "gnu lesser general public license": "lgpl",
    "apache license version 2": "apache",
    "licensed under the apache license": "apache",
    "released under the mit license": "mit",
    "permission is hereby granted free of charge": "mit",
    "creative commons attribution": "cc-by",
    "redistribution and use in source and binary forms": "bsd",
    "mozilla public license": "mpl",
    "all rights reserved": "proprietary",
    "this work is dedicated to the public domain": "public-domain",
    "gnu affero general public license": "agpl",
    "under the terms of the gnu general public license": "gpl",
    "distributed under the apache license": "apache",
    "licensed under the mit license": "mit",
    "the software is provided as is without warranty of any kind": "mit",
    "permission to use copy modify and or distribute this software": "isc",
    "neither the name of the copyright holder nor the names of its contributors": "bsd",
    "subject to the terms of the mozilla public license": "mpl",
    "eclipse public license": "epl",
    "boost software license": "bsl",
    "creative commons attribution sharealike": "cc-by-sa",
    "creative commons attribution noncommercial": "cc-by-nc",
    "creative commons zero": "cc0",
    "no rights reserved": "cc0",
    "this is free and unencumbered software released into the public domain": "unlicense",
    "may not be reproduced without permission": "proprietary",
}

_WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
_LOWER = {c: c + 32 for c in range(0x41, 0x5B)}


class Scanner:
    """Compiled phrases, seeds and fuzzy patterns."""

    def __init__(self, base: dict[str, str], notices: dict[str, str], letters_per_edit: int):
        self.base, self.notices, self.letters_per_edit = base, list(notices.items()), letters_per_edit

    def edits(self, notice: str) -> int:
        return len(notice) // self.letters_per_edit

    @cached_property
    def seeds(self) -> ahocorasick.Automaton:
        """Piece -> [(notice number, offset of the piece in the notice)]."""
        found: dict[str, list[tuple[int, int]]] = {}
        for i, (notice, _) in enumerate(self.notices):
            parts = self.edits(notice) + 1
            cuts = [len(notice) * p // parts for p in range(parts + 1)]
            for lo, hi in zip(cuts, cuts[1:]):
                found.setdefault(notice[lo:hi], []).append((i, lo))
        out = ahocorasick.Automaton()
        for piece, where in found.items():
            out.add_word(piece, (len(piece), where))
        out.make_automaton()
        return out

    @cached_property
    def patterns(self) -> list[regex.Pattern]:
        return [regex.compile(f"(?<![^ ])(?:{regex.escape(n)}){{e<={self.edits(n)}}}(?![^ ])", regex.BESTMATCH) for n, _ in self.notices]

    def fuzzy(self, joined: str) -> list[tuple[int, int, int, int]]:
        """(notice, start, end, edits) of verified matches in joined words; those of one notice never overlap."""
        windows: dict[int, set[tuple[int, int]]] = {}
        for end, (size, where) in self.seeds.iter(joined):
            for i, offset in where:
                notice, k = self.notices[i][0], self.edits(self.notices[i][0])
                lo, hi = max(0, end + 1 - size - offset - k), end + 1 - size - offset + len(notice) + k
                windows.setdefault(i, set()).add((lo, min(hi, len(joined))))
        out = [(i, *m) for i, spans in windows.items() for m in self._apart(joined, i, spans)]
        return sorted(out, key=lambda m: (m[1], m[0]))

    def _apart(self, joined: str, i: int, windows: set[tuple[int, int]]) -> list[tuple[int, int, int]]:
        """(start, end, edits) of one notice: fewest edits first, and what a match leaves of a window is searched again."""
        notice, k = self.notices[i][0], self.edits(self.notices[i][0])
        queue: list[tuple[int, int, int, int, int]] = []

        def search(lo: int, hi: int) -> None:
            # a match holds whole words, so words cut by the window are left out
            if lo and joined[lo - 1] != " ":
                lo = joined.find(" ", lo, hi) + 1 or hi
            if hi < len(joined) and joined[hi] != " ":
                hi = max(joined.rfind(" ", lo, hi), lo)
            if hi - lo < len(notice) - k:
                return
            at = joined.find(notice, lo, hi)
            while at >= 0 and not ((not at or joined[at - 1] == " ") and joined[at + len(notice) : at + len(notice) + 1] in ("", " ")):
                at = joined.find(notice, at + 1, hi)
            if at >= 0:
                heapq.heappush(queue, (0, at, at + len(notice), lo, hi))
            elif k and (m := self.patterns[i].search(joined, lo, hi)):
                heapq.heappush(queue, (sum(m.fuzzy_counts), m.start(), m.end(), lo, hi))

        for lo, hi in windows:
            search(lo, hi)
        taken: list[tuple[int, int, int]] = []  # by start, and apart, so by end too
        while queue:
            edits, start, end, lo, hi = heapq.heappop(queue)
            first = bisect.bisect_right(taken, lo, key=lambda m: m[1])
            last = bisect.bisect_left(taken, hi, key=lambda m: m[0])
            inside = taken[first:last]
            if all(end <= a or b <= start for a, b, _ in inside):
                bisect.insort(taken, (start, end, edits))
                inside = sorted([*inside, (start, end, edits)])
            for a, b, _ in inside:
                search(lo, a)
                lo = b
            search(lo, hi)
        return taken

    def scan(self, text: str | None) -> tuple:
        low = (text or "").translate(_LOWER) if text and not text.islower() else text or ""
        words = _WORD.findall(low)
        joined = " ".join(words)
        framed, places, labels = f" {joined} ", [], set()
        for phrase, label in self.base.items():
            at = framed.find(f" {phrase} ")
            while at >= 0:
                places.append((at, label))
                at = framed.find(f" {phrase} ", at + 1)
        labels = {label for _, label in places}
        found = self.fuzzy(joined)
        starts = [m.start() for m in _WORD.finditer(low)] if found else []
        # where each word begins in the joined text
        begins = list(accumulate((len(w) + 1 for w in words), initial=0))[:-1] if found or places else []
        spans = []
        for i, lo, hi, edits in found:
            first, last = bisect.bisect_right(begins, lo) - 1, bisect.bisect_right(begins, max(lo, hi - 1)) - 1
            spans.append((self.notices[i][1], self.notices[i][0], starts[first], starts[last] + len(words[last]), first, last, edits))
        near = max((1 - e / len(self.notices[i][0]) for i, _, _, e in found), default=0.0)
        at_word = sorted(bisect.bisect_left(begins, at) for at, _ in places)
        return (
            len(words), len(places), at_word[0] if places else None, at_word[-1] if places else None,
            ",".join(sorted(labels)), ",".join(sorted(labels | {s[0] for s in spans})), 1.0 if places else near, spans,
        )


COLUMNS = "n_words long, n_base long, first_word long, last_word long, base_labels string, labels string, score double, spans array<struct<label:string,notice:string,start:int,end:int,first_word:int,last_word:int,edits:int>>"


def scan(docs: DataFrame, base: dict[str, str] = BASE, notices: dict[str, str] = NOTICES, letters_per_edit: int = 12, text: str = "text", keep: Sequence[str] = ("doc_id",)) -> DataFrame:
    """``keep`` columns plus the scan of every whole text.

    n_words, n_base (places of base phrases), first_word and last_word (their
    smallest and largest start word from 0), base_labels, labels (base and
    fuzzy, distinct, sorted), score (1 for a base phrase, else 1 - edits per
    letter of the best fuzzy match, 0 without any) and spans: label, notice,
    start and end in code points of the text, first and last word, edits.  A
    notice may hold one edit for every ``letters_per_edit`` letters.  A null
    text is empty; repeated rows are scanned each; columns of the result names
    in ``docs`` are not read.
    """
    keep = list(keep)
    scanner = Scanner(base, notices, letters_per_edit)

    @F.pandas_udf(f"struct<{','.join(p.strip().replace(' ', ':', 1) for p in COLUMNS.split(', '))}>")
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        names = [p.strip().split(" ")[0] for p in COLUMNS.split(", ")]
        for texts in batches:
            rows = [scanner.scan(t) for t in texts]
            out = pd.DataFrame({n: [r[i] for r in rows] for i, n in enumerate(names)})
            out["spans"] = [[dict(zip(("label", "notice", "start", "end", "first_word", "last_word", "edits"), s)) for s in v] for v in out["spans"]]
            yield out.astype({"first_word": "Int64", "last_word": "Int64"})

    return docs.select(*keep, run(F.col(text)).alias("_scan")).select(*keep, "_scan.*")
