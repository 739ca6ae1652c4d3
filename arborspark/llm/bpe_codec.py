"""BPE encoding and decoding: speculate and verify.

For every new pre-token the longest vocabulary strings are taken greedily from
the left.  The guess is the true encoding exactly if each of its tokens encodes
alone as itself and no merge across any adjacent pair would have come before
the merges that built the two tokens at their border.  The second test runs for
all adjacent pairs of a batch at once, walking the border of both merge trees
in NumPy.  Words with a failing pair are merged exactly.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import chain

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from arborspark.llm.bpe import END, MEMO_WORDS, WordBpe


class Speculator:
    """Batch encoder of pre-tokens with a memo."""

    def __init__(self, book: WordBpe):
        self.book = book
        self.memo: dict[str, tuple[int, ...]] = {}
        ids = book.ids
        size = len(book.strings)
        far = np.iinfo(np.int64).max
        self.left, self.right = np.full(size, -1), np.full(size, -1)
        self.made = np.full(size, -1)
        keys, ranks = [], []
        for (a, b), rank in book.ranks.items():
            merged = ids[a + b]
            keys.append(ids[a] * size + ids[b])
            ranks.append(rank)
            if self.made[merged] < 0:
                self.made[merged], self.left[merged], self.right[merged] = rank, ids[a], ids[b]
        order = np.argsort(keys)
        self.keys, self.key_ranks, self.size, self.far = np.array(keys)[order], np.array(ranks)[order], size, far
        # tokens that encode alone as themselves; without rising ranks nothing may be guessed
        self.sound = {t for t in ids if book.ordered and self._alone(t)}
        self.longest = max(map(len, self.sound), default=1)

    def _alone(self, token: str) -> bool:
        if token.endswith(END) and len(token) > len(END):
            return self.book.merge(token[: -len(END)]) == [token]
        # inside a word the token has no word end: merge its letters as such
        parts = list(token)
        while len(parts) > 1:
            found = [self.book.ranks.get(p, self.far) for p in zip(parts, parts[1:])]
            low = min(found)
            if low == self.far:
                return False
            at = found.index(low)
            parts[at : at + 2] = [parts[at] + parts[at + 1]]
        return True

    def _guess(self, word: str) -> list[int] | None:
        text, i, out = word, 0, []
        n = len(text)
        while i < n:
            for j in range(min(n, i + self.longest), i, -1):
                token = text[i:j] + END if j == n else text[i:j]
                if token in self.sound:
                    out.append(self.book.ids[token])
                    i = j
                    break
            else:
                return None
        return out

    def compatible(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """For each pair of tokens: no merge across the border precedes the merges beside it."""
        good = np.ones(len(a), dtype=bool)
        x, y = a.copy(), b.copy()
        # rank at which x and y vanish into their parents at the border
        x_until, y_until = np.full(len(a), self.far), np.full(len(a), self.far)
        live = np.arange(len(a))
        while len(live):
            key = x[live] * self.size + y[live]
            at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
            across = np.where(self.keys[at] == key, self.key_ranks[at], self.far)
            # equal ranks go left first: x's own merge lies further left, y's further right
            bad = (across < self.far) & (across < x_until[live]) & (across <= y_until[live])
            good[live[bad]] = False
            live = live[~bad]
            # undo the later of the two youngest merges
            later_x = self.made[x[live]] > self.made[y[live]]
            same = self.made[x[live]] == self.made[y[live]]
            undo_x = later_x
            undo_y = ~later_x & (self.made[y[live]] >= 0)
            undo_y |= same & (self.made[x[live]] >= 0)
            done = ~undo_x & ~undo_y
            ix, iy = live[undo_x], live[undo_y]
            x_until[ix], x[ix] = self.made[x[ix]], self.right[x[ix]]
            y_until[iy], y[iy] = self.made[y[iy]], self.left[y[iy]]
            live = live[~done]
        return good

    def learn(self, words: list[str]) -> int:
        """Encode new pre-tokens into the memo; the number that had to be merged."""
        symbols = [self.book.symbols(w) for w in words]
        guesses = [self._guess(s) for s in symbols]
        flat = np.fromiter(chain.from_iterable(g or () for g in guesses), dtype=np.int64)
        owner = np.repeat(np.arange(len(words)), [len(g or ()) for g in guesses])
        bad = np.array([g is None for g in guesses], dtype=bool)
        inner = owner[1:] == owner[:-1]
        pairs, back = np.unique(flat[:-1][inner] * self.size + flat[1:][inner], return_inverse=True)
        wrong = ~self.compatible(pairs // self.size, pairs % self.size)
        bad[owner[1:][inner][wrong[back]]] = True
        for i, w in enumerate(words):
            self.memo[w] = tuple(self.book.ids[t] for t in self.book.merge(symbols[i])) if bad[i] else tuple(guesses[i])
        return int(bad.sum())

    def encode(self, texts: list[str | None]) -> list[np.ndarray]:
        """Ids of whole texts; a null gives none."""
        out, held, size = [], [], 0
        for t in texts:
            held.append(t or "")
            size += len(held[-1])
            if size > 1 << 20:
                out += self._encode(held)
                held, size = [], 0
        return out + self._encode(held)

    def _encode(self, texts: list[str]) -> list[np.ndarray]:
        book = self.book
        cut = [[(p, None) if p in book.specials else (None, book.pieces(p)) for p in book.parts(t)] if t else [] for t in texts]
        if len(self.memo) > MEMO_WORDS:
            self.memo = {}
        fresh = {w for doc in cut for _, words in doc if words for w in words}.difference(self.memo)
        if fresh:
            self.learn(list(fresh))
        look = self.memo.__getitem__
        return [
            np.fromiter(chain.from_iterable((book.specials[s],) if words is None else chain.from_iterable(map(look, words)) for s, words in doc), dtype=np.int32)
            for doc in cut
        ]


def _strings(rows: list[np.ndarray], table: np.ndarray) -> list[str]:
    return [" ".join(table[row[(row >= 0) & (row < len(table))]].tolist()) for row in rows]


def encode(docs: DataFrame, path: str, text: str = "text", ids: str = "ids", decoded: str | None = None, keep_text: bool = True) -> DataFrame:
    """``docs`` plus an ``array<int>`` of token ids of the whole text and, if named, the ids' decoded text.

    Ids are those of the library's ``encode(text, add_special_tokens=False)``;
    special strings inside texts are special tokens.  A null or empty text has
    an empty array; repeated rows are encoded each; an empty table stays empty;
    columns named as ``ids`` or ``decoded`` are replaced.  Rows come back in
    slices of about a million characters, so memory follows one slice, the
    memo and the longest text.
    """
    book = WordBpe(path)
    shared = docs.sparkSession.sparkContext.broadcast(book)
    kept = [c for c in docs.columns if c not in (ids, decoded) and (keep_text or c != text)]
    fields = [docs.schema[c] for c in kept] + [T.StructField(ids, T.ArrayType(T.IntegerType()))] + ([T.StructField(decoded, T.StringType())] if decoded else [])
    source = docs.select(*kept, F.col(text).alias("_coded_text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        speculator = Speculator(shared.value)
        table = np.array(shared.value.strings, dtype=object)
        for batch in batches:
            sizes = pc.fill_null(pc.binary_length(batch.column("_coded_text")), 0).to_numpy(zero_copy_only=False).astype(np.int64)
            slot = (np.cumsum(sizes) - sizes) >> 20
            cuts = np.flatnonzero(np.r_[True, slot[1:] != slot[:-1], True]) if len(slot) else []
            for lo, hi in zip(cuts, cuts[1:]):
                part = batch.slice(int(lo), int(hi - lo))
                rows = speculator.encode(part.column("_coded_text").to_pylist())
                ends = np.cumsum([0, *map(len, rows)]).astype(np.int32)
                columns = [part.column(c) for c in kept] + [pa.ListArray.from_arrays(ends, np.concatenate([*rows, np.empty(0, np.int32)]).astype(np.int32))]
                if decoded:
                    columns.append(pa.array(_strings(rows, table), pa.string()))
                yield pa.RecordBatch.from_arrays(columns, names=[f.name for f in fields])

    return source.mapInArrow(run, T.StructType(fields))


def decode(docs: DataFrame, path: str, ids: str = "ids", text: str = "decoded") -> DataFrame:
    """``docs`` plus the text of its ids: token strings joined by one space, special ones included.

    A null array gives null, an empty one an empty text; an id outside the
    vocabulary is skipped, as the library does.
    """
    shared = docs.sparkSession.sparkContext.broadcast(np.array(WordBpe(path).strings, dtype=object))

    @F.pandas_udf("string")
    def to_text(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for rows in batches:
            held = rows.map(lambda r: np.empty(0, np.int64) if r is None else np.asarray(r, dtype=np.int64))
            yield pd.Series(_strings(held.tolist(), shared.value), dtype=object).where(rows.notna().to_numpy(), None)

    return docs.withColumn(text, to_text(F.col(ids)))
