"""Token counts by the whole-token shortcut.

Offline, every vocabulary string with a word end is encoded alone; those that
come back as one token are whole tokens.  In the scan a pre-token among them
counts as one without being merged; only the rest is merged, each distinct
pre-token once per worker and memo (``bpe.MEMO_WORDS``).
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from arborspark.llm.bpe import CHAR_BYTES, END, MEMO_WORDS, WordBpe


def whole_tokens(vocabulary: WordBpe) -> set[str]:
    """Pre-tokens that are proven to encode as exactly one token."""
    proven = set()
    for token in vocabulary.ids:
        if not token.endswith(END) or len(token) == len(END) or any(c not in CHAR_BYTES for c in token[: -len(END)]):
            continue
        word = token[: -len(END)]
        if vocabulary.merge(word) != [token]:
            continue
        try:
            proven.add(bytes(map(CHAR_BYTES.__getitem__, word)).decode("utf-8"))
        except UnicodeDecodeError:
            continue
    return proven


class _Counts(dict):
    def __init__(self, vocabulary: WordBpe, whole: set[str]):
        super().__init__(dict.fromkeys(whole, 1))
        self.vocabulary, self.whole = vocabulary, whole

    def __missing__(self, piece: str) -> int:
        if len(self) > MEMO_WORDS + len(self.whole):
            self.clear()
            self.update(dict.fromkeys(self.whole, 1))
        n = self[piece] = len(self.vocabulary.merge(self.vocabulary.symbols(piece)))
        return n

    def of(self, text: str | None) -> int:
        if not text:
            return 0
        book = self.vocabulary
        return sum(1 if part in book.specials else sum(map(self.__getitem__, book.pieces(part))) for part in book.parts(text))


def count_tokens(docs: DataFrame, path: str, text: str = "text", limit: int = 2048) -> DataFrame:
    """``docs`` plus n_bytes, n_tokens and over_limit (more than ``limit`` tokens).

    Counts are those of the library's ``encode(text, add_special_tokens=False)``.
    A null or empty text has 0 bytes and 0 tokens; repeated rows are counted
    each; an empty table stays empty.  Columns of the same names are replaced.
    """
    book = WordBpe(path)
    shared = docs.sparkSession.sparkContext.broadcast((book, whole_tokens(book)))

    @F.pandas_udf("long")
    def tokens(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        counts = _Counts(*shared.value)
        for texts in batches:
            yield pd.Series([counts.of(t) for t in texts], dtype="int64")

    counted = docs.withColumn("n_tokens", tokens(F.col(text)))
    return counted.withColumns({"n_bytes": F.coalesce(F.octet_length(text), F.lit(0)).cast("long"), "over_limit": F.col("n_tokens") > limit})
