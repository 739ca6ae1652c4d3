"""Language identification by word-first backoff.

A known word is scored by its log frequency in each language.  An unseen word
backs off to its character n-grams, the longest length of which any is known,
down to single letters.  The model is fitted on at most ``max_docs`` labelled
rows, chosen by a hash of the document id, and therefore fits a broadcast.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from arborspark.llm.words import slices
from arborspark.session import land

_LETTERS = re.compile(r"[^\W\d_]+")
#: Beyond so many words, a worker's memo of word scores is emptied.
MEMO_WORDS = 1 << 18
UNKNOWN = "und"


def words(text: str) -> list[str]:
    """Runs of letters in lower case; a run of signs that are no letters (``²``, ``½``) is none."""
    return [w for w in _LETTERS.findall(text.lower()) if w.isalpha() or any(map(str.isalpha, w))]


def grams(word: str, n: int) -> list[str]:
    """Character n-grams of a word with marked ends."""
    framed = f"^{word}$"
    return [framed[i : i + n] for i in range(len(framed) - n + 1)] if n > 1 else list(word)


class Table:
    """Items with one row of log frequencies per language."""

    def __init__(self, items: list[str], values: np.ndarray):
        self.at, self.values = {w: i for i, w in enumerate(items)}, values


class Model:
    """Log frequencies per language; a worker keeps a memo of word scores."""

    def __init__(self, languages: list[str], tables: list[Table]):
        self.languages, self.tables = languages, tables
        self._forget()

    def __getstate__(self):
        return {"languages": self.languages, "tables": self.tables}

    def __setstate__(self, state):
        self.__dict__.update(state)
        self._forget()

    def _forget(self) -> None:
        self.memo: dict[str, int] = {}
        self.scores = np.zeros((0, len(self.languages)), dtype=np.float32)

    def score(self, fresh: list[str]) -> np.ndarray:
        """Log frequencies of words in each language, words first, then ever shorter n-grams."""
        out = np.zeros((len(fresh), len(self.languages)))
        known, open_ = self.tables[0].at, []
        for i, word in enumerate(fresh):
            row = known.get(word)
            if row is None:
                open_.append(i)
            else:
                out[i] = self.tables[0].values[row]
        for n in range(len(self.tables) - 1, 0, -1):
            at, found, owner, left = self.tables[n].at, [], [], []
            for i in open_:
                rows = [r for r in map(at.get, grams(fresh[i], n)) if r is not None]
                if rows:
                    found += rows
                    owner.append((i, len(rows)))
                else:
                    left.append(i)
            if owner:
                places, sizes = np.array(owner).T
                starts = np.cumsum(sizes) - sizes
                out[places] = np.add.reduceat(self.tables[n].values[found], starts, axis=0) / sizes[:, None]
            open_ = left
        return out

    def _learn(self, fresh: list[str]) -> None:
        if len(self.memo) > MEMO_WORDS:
            self._forget()
        begin = len(self.memo)
        if begin + len(fresh) > len(self.scores):
            grown = np.zeros((2 * (begin + len(fresh)), len(self.languages)), dtype=np.float32)
            grown[:begin] = self.scores[:begin]
            self.scores = grown
        self.scores[begin : begin + len(fresh)] = self.score(fresh)
        self.memo.update(zip(fresh, range(begin, begin + len(fresh))))

    def predict(self, texts: list[str | None]) -> list[tuple[str, float]]:
        out, held, size = [], [], 0
        for t in texts:
            held.append(words(t) if t else [])
            size += len(held[-1])
            if size > 1 << 16:
                out += self._predict(held)
                held, size = [], 0
        return out + self._predict(held)

    def _predict(self, docs: list[list[str]]) -> list[tuple[str, float]]:
        out: list[tuple[str, float]] = [(UNKNOWN, 0.0)] * len(docs)
        sizes = np.array([len(d) for d in docs])
        full = np.flatnonzero(sizes)
        if not len(full) or not self.languages:
            return out
        if len(self.memo) > MEMO_WORDS:
            self._forget()
        fresh = list({w for d in docs for w in d if w not in self.memo})
        if fresh:
            self._learn(fresh)
        look = self.memo.__getitem__
        at = np.fromiter((r for d in docs for r in map(look, d)), dtype=np.int64, count=int(sizes.sum()))
        mean = np.add.reduceat(self.scores[at].astype(np.float64), (np.cumsum(sizes) - sizes)[full], axis=0) / sizes[full][:, None]
        # sharpened by the evidence of more words
        mean = mean * np.minimum(20.0, 1 + np.sqrt(sizes[full]))[:, None]
        weights = np.exp(mean - mean.max(axis=1, keepdims=True))
        best = weights.argmax(axis=1)
        share = weights[np.arange(len(full)), best] / weights.sum(axis=1)
        for i, b, p in zip(full, best, share):
            out[i] = (self.languages[b], float(p))
        return out


def _count_words(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for pdf in batches:
        by: dict[str, Counter] = {}
        for lang, text in zip(pdf["lang"], pdf["text"]):
            by.setdefault(lang, Counter()).update(words(text))
        yield pd.DataFrame([(g, w, n) for g, c in by.items() for w, n in c.items()], columns=["lang", "item", "n"])


def fit(docs: DataFrame, max_docs: int = 2000, longest: int = 5, least_words: int = 2, least_grams: int = 4) -> Model:
    """Model from (doc_id, text, lang): rows without text, lang or doc_id are not used.

    Learns from the ``max_docs`` rows with the smallest hash of doc_id (ties at
    the last hash included), taken with their whole texts.  Spark counts their
    words and n-grams; only counts that the model keeps reach the driver.  Words need ``least_words`` and
    n-grams ``least_grams`` occurrences.
    """
    usable = docs.filter("text is not null and lang is not null and doc_id is not null").select(F.xxhash64("doc_id").alias("_h"), "text", "lang")
    last = usable.select("_h").orderBy("_h").limit(max_docs).agg(F.max("_h")).first()[0]
    if last is None:
        return Model([], [])
    sample = usable.filter(F.col("_h") <= last).select("lang", "text")
    counts = land(sample.mapInPandas(_count_words, "lang string, item string, n long").groupBy("lang", "item").agg(F.sum("n").alias("n")), "words")
    languages = sorted(r.lang for r in counts.select("lang").distinct().collect())
    if not languages:
        return Model([], [])
    framed = F.concat(F.lit("^"), F.col("item"), F.lit("$"))
    cut = lambda text, n: F.transform(F.sequence(F.lit(1), F.length(text) - n + 1), lambda i: F.substring(text, i, F.lit(n)))
    sized = [F.struct(F.lit(0).alias("size"), F.array("item").alias("items")), F.struct(F.lit(1).alias("size"), cut(F.col("item"), 1).alias("items"))]
    sized += [F.struct(F.lit(n).alias("size"), F.when(F.length("item") + 2 >= n, cut(framed, n)).otherwise(F.array().cast("array<string>")).alias("items")) for n in range(2, longest + 1)]
    spread = counts.select("lang", "n", F.explode(F.array(*sized)).alias("s")).select("lang", "n", "s.size", F.explode("s.items").alias("item"))
    each = [F.sum(F.when(F.col("lang") == x, F.col("n")).otherwise(0)).alias(f"c{i}") for i, x in enumerate(languages)]
    wide = land(spread.groupBy("size", "item").agg(*each, F.sum("n").alias("all")), "counts")
    sums = {r.size: r for r in wide.groupBy("size").agg(*[F.sum(f"c{i}").alias(f"c{i}") for i in range(len(languages))]).collect()}
    kept = wide.filter(F.col("all") >= F.when(F.col("size") == 0, least_words).otherwise(least_grams)).drop("all").toArrow().to_pandas().sort_values("item")
    columns = [f"c{i}" for i in range(len(languages))]
    tables = []
    for n in range(longest + 1):
        # smoothed log frequencies, shifted so that only differences count
        own = kept[kept["size"] == n]
        totals = np.array([sums[n][c] for c in columns]) + 0.5 * len(own) + 1.0 if n in sums else 1.0
        values = np.log((own[columns].to_numpy() + 0.5) / totals)
        tables.append(Table(own["item"].tolist(), (values - values.mean(axis=1, keepdims=True)).astype(np.float32)))
    return Model(languages, tables)


def identify(docs: DataFrame, model: Model, text: str = "text") -> DataFrame:
    """``docs`` plus lang_pred and score (the share of the predicted language, 0 to 1).

    A null text or one without letters is ``und`` with score 0; ties go to the
    first language by code point.  Repeated rows get the same answer; columns
    of the result names are replaced.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)

    others = [c for c in docs.columns if c not in ("lang_pred", "score")]
    schema = T.StructType([docs.schema[c] for c in others] + [T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = shared.value
        for batch in batches:
            for start, texts in slices(batch.column(text)):
                told = own.predict([b.decode("utf-8", "replace") for b in texts])
                part = batch.slice(start, len(texts))
                yield pa.RecordBatch.from_arrays([*map(part.column, others), pa.array([x for x, _ in told], pa.string()), pa.array([p for _, p in told], pa.float64())], names=schema.names)
        own._forget()

    return docs.select(others).mapInArrow(run, schema)


def held_out(doc_id: Column) -> Column:
    """Whether crc32 of the id as text leaves 2 modulo 4; a null id is not held out."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 4 == 2, F.lit(False))
