import random
import time

import pytest
from tokenizers import Tokenizer

import public_tokenizers
from arborspark.llm.bpe import WordBpe
from arborspark.llm.bpe_codec import Speculator, decode, encode
from arborspark.llm.token_counts import count_tokens, whole_tokens

PATH = public_tokenizers.path("word_bpe_49k.json")


def odd_texts():
    r = random.Random(1)
    letters = "ab'sStrè ́éÀǅßİΣς日本٣²½ \x85 \x1c\t\n!?<|endoftext|>0123456789lld've"
    mixed = ["".join(r.choice(letters) for _ in range(r.randint(0, 60))) for _ in range(500)]
    repeats = [r.choice("abcdefgh") * r.randint(1, 40) for _ in range(50)]
    short = ["".join(r.choice("abn") for _ in range(r.randint(1, 30))) for _ in range(500)]
    return [None, "", " ", "<|endoftext|>a<|startoftext|>", "".join(map(chr, range(0x250))), " ".join(map(chr, range(0x250))), "word " * 30000, *mixed, *repeats, *short]


@pytest.fixture(scope="module")
def book():
    return WordBpe(PATH)


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(PATH)


def test_ids_and_round_trip_equal_the_library(spark, library):
    texts = odd_texts()
    docs = spark.createDataFrame([(i, t, 5) for i, t in enumerate(texts)], "doc_id long, text string, ids int")
    rows = decode(encode(docs, PATH), PATH).orderBy("doc_id").collect()
    for text, row in zip(texts, rows, strict=True):
        want = library.encode(text or "", add_special_tokens=False).ids
        assert row.ids == want
        assert row.decoded == library.decode(want, skip_special_tokens=False)
    fused = encode(docs, PATH, decoded="decoded", keep_text=False).orderBy("doc_id").collect()
    assert [(r.ids, r.decoded) for r in fused] == [(r.ids, r.decoded) for r in rows] and "text" not in fused[0]
    odd = spark.createDataFrame([(None,), ([],), ([5, 10**7, -1],)], "ids array<int>")
    assert [r.decoded for r in decode(odd, PATH).collect()] == [None, "", library.decode([5], skip_special_tokens=False)]
    assert encode(docs.limit(0), PATH).count() == 0


def test_counts_equal_the_library(spark, library):
    texts = odd_texts()
    docs = spark.createDataFrame([(i, t, 0) for i, t in enumerate(texts)], "doc_id long, text string, n_tokens int")
    for row in count_tokens(docs, PATH, limit=40).collect():
        text = texts[row.doc_id] or ""
        n = len(library.encode(text, add_special_tokens=False).ids)
        assert (row.n_tokens, row.n_bytes, row.over_limit) == (n, len(text.encode()), n > 40)
    assert count_tokens(docs.limit(0), PATH).count() == 0


def test_whole_tokens_are_single(book, library):
    for word in random.Random(2).sample(sorted(whole_tokens(book)), 300):
        if len(book.pieces(word)) == 1:
            assert len(library.encode(word, add_special_tokens=False).ids) == 1


def test_guesses_pass_only_when_right(book):
    speculator, r = Speculator(book), random.Random(3)
    words = sorted({"".join(r.choice(["th", "an", "er", "ing", "ed", "on", "z", "aa"]) for _ in range(r.randint(1, 6))) for _ in range(2000)})
    merged = speculator.learn(words)
    assert 0 < merged < len(words)
    for word in words:
        assert [book.strings[i] for i in speculator.memo[word]] == book.merge(word)


def test_very_long_words_equal_the_library(book):
    rng, library = random.Random(9), Tokenizer.from_file(PATH)
    texts = ["".join(rng.choice("etaoinsrhldcum") for _ in range(n)) for n in (65, 300, 5000)] + ["ab" * 2000, "a" * 3001, "thethe" * 700, "été" * 900]
    for text in texts:
        want = library.encode(text, add_special_tokens=False).tokens
        assert [t for p in book.pieces(text) for t in book.merge(book.symbols(p))] == want
        short = text[:60]
        assert book._merge_by_heap([*book.symbols(short)[:-1], book.symbols(short)[-1] + "</w>"]) == book.merge(book.symbols(short))
    started = time.time()
    book.merge("".join(rng.choice("acgt") for _ in range(1_000_000)))
    assert time.time() - started < 30
