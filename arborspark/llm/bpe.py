"""Tables of a word-level BPE vocabulary file and its exact merging.

The file (``path``, JSON of the tokenizers library) is read by the driver; the
tables go to the tasks as one broadcast whose size is that of the vocabulary.
Pre-tokens of texts below U+0250 come from a plain pattern with the same
character classes; other texts use the library's own normaliser and splitter.
"""

from __future__ import annotations

import json
import re
import unicodedata
from functools import cached_property
from heapq import heapify, heappop, heappush

#: Beyond so many words, a worker's memo of word results is emptied.
MEMO_WORDS = 1 << 18
#: Symbols of a word up to which merging scans it for its lowest pair.
SCANNED = 64
END = "</w>"
#: Stands before byte characters; no valid text holds it.
MARK = "\ud800"
_WIDE = re.compile("[^\x00-ɏ]")


def _byte_chars() -> dict[int, str]:
    """Printable character that stands for each byte."""
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in set(shown)]
    return {b: chr(b) for b in shown} | {b: chr(256 + i) for i, b in enumerate(rest)}


BYTE_CHARS = _byte_chars()
CHAR_BYTES = {c: b for b, c in BYTE_CHARS.items()}


def _narrow_pattern() -> re.Pattern:
    of = {"L": "", "N": ""}
    for code in range(0x250):
        kind = unicodedata.category(chr(code))[0]
        if kind in of:
            of[kind] += chr(code)
    letters, numbers = of["L"], of["N"]
    space = "\t\n\x0b\x0c\r \x85\xa0"
    return re.compile(f"'s|'t|'re|'ve|'m|'ll|'d|[{letters}]+|[{numbers}]|[^{space}{letters}{numbers}]+")


class WordBpe:
    """Vocabulary, merge ranks and splitter; small enough to broadcast."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        model = spec["model"]
        if model.get("end_of_word_suffix") != END or model.get("continuing_subword_prefix") or model.get("byte_fallback") or model.get("ignore_merges"):
            raise ValueError("a BPE vocabulary with word ends is needed")
        self.ids: dict[str, int] = model["vocab"]
        pairs = [tuple(m) if isinstance(m, list) else tuple(m.split(" ")) for m in model["merges"]]
        self.ranks: dict[tuple[str, str], int] = {}
        for rank, pair in enumerate(pairs):
            self.ranks[pair] = rank
        self.specials: dict[str, int] = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.strings: list[str] = [""] * (1 + max([*self.ids.values(), *self.specials.values()]))
        for token, i in [*self.ids.items(), *self.specials.items()]:
            self.strings[i] = token
        self.splitter = json.dumps(spec | {"added_tokens": [], "model": model | {"vocab": {}, "merges": []}})

    def __getstate__(self):
        return {k: v for k, v in self.__dict__.items() if k not in ("library", "narrow", "special")}

    @cached_property
    def library(self):
        from tokenizers import Tokenizer

        return Tokenizer.from_str(self.splitter)

    @cached_property
    def narrow(self) -> re.Pattern:
        return _narrow_pattern()

    @cached_property
    def special(self) -> re.Pattern:
        return re.compile("(" + "|".join(map(re.escape, sorted(self.specials, key=len, reverse=True))) + ")")

    def pieces(self, text: str) -> list[str]:
        """Pre-tokens as plain text, in order; for wide texts as byte characters behind a mark."""
        low = text.lower()
        if not _WIDE.search(low):
            return self.narrow.findall(low)
        tok = self.library
        return [MARK + w for w, _ in tok.pre_tokenizer.pre_tokenize_str(tok.normalizer.normalize_str(text))]

    def parts(self, text: str) -> list[str]:
        """Special strings and the texts between them."""
        return [x for x in self.special.split(text) if x] if any(s in text for s in self.specials) else [text]

    @staticmethod
    def symbols(piece: str) -> str:
        """Byte characters of a pre-token."""
        if piece[0] == MARK:
            return piece[1:]
        return "".join(map(BYTE_CHARS.__getitem__, piece.encode("utf-8")))

    def merge(self, word: str) -> list[str]:
        """Exact merging: the lowest rank first, the leftmost of equal ranks.

        Short words are scanned for their lowest pair; long ones keep their pairs
        in a heap over a linked list, so a word of any length takes n log n steps.
        """
        tokens = [*word[:-1], word[-1] + END]
        if len(tokens) > SCANNED or not self.ordered:
            return self._merge_by_heap(tokens)
        ranks = self.ranks
        while len(tokens) > 1:
            found = [ranks.get(p, 1 << 60) for p in zip(tokens, tokens[1:])]
            low = min(found)
            if low == 1 << 60:
                break
            at, merged, i = found.index(low), [], 0
            left, right = tokens[at], tokens[at + 1]
            while i < len(tokens):
                if i + 1 < len(tokens) and tokens[i] == left and tokens[i + 1] == right:
                    merged.append(left + right)
                    i += 2
                else:
                    merged.append(tokens[i])
                    i += 1
            tokens = merged
        return tokens

    def _merge_by_heap(self, tokens: list[str | None]) -> list[str]:
        size, rank = len(tokens), self.ranks.get
        after, before = list(range(1, size + 1)), list(range(-1, size - 1))
        heap = [(r, i) for i, p in enumerate(zip(tokens, tokens[1:])) if (r := rank(p)) is not None]
        heapify(heap)
        while heap:
            r, i = heappop(heap)
            j = after[i]
            if tokens[i] is None or j >= size or rank((tokens[i], tokens[j])) != r:
                continue  # one of the two has been merged since
            tokens[i], tokens[j] = tokens[i] + tokens[j], None
            after[i] = after[j]
            if after[i] < size:
                before[after[i]] = i
                if (r := rank((tokens[i], tokens[after[i]]))) is not None:
                    heappush(heap, (r, i))
            if before[i] >= 0 and (r := rank((tokens[before[i]], tokens[i]))) is not None:
                heappush(heap, (r, before[i]))
        return [t for t in tokens if t is not None]

    @cached_property
    def ordered(self) -> bool:
        """Every merge joins tokens that lower ranks made, so ranks only rise while merging."""
        made = {a + b: r for (a, b), r in reversed(self.ranks.items())}
        return all(made.get(a, -1) < r and made.get(b, -1) < r for (a, b), r in self.ranks.items())
