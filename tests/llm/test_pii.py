import random
import re

import numpy as np
import pytest

from arborspark.llm import pii, tagger

PLAIN = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def by_hand(text):
    out = []
    for kind, pattern in PLAIN.items():
        for m in re.finditer(pattern, text):
            digits = [int(c) for c in m.group() if c.isascii() and c.isdigit()]
            if kind == "ip" and any(int(p) > 255 for p in m.group().split(".")):
                continue
            if kind == "card":
                total = sum(d if i % 2 == 0 else (2 * d if d < 5 else 2 * d - 9) for i, d in enumerate(reversed(digits)))
                if not 12 <= len(digits) <= 19 or total % 10:
                    continue
            if kind == "phone" and not 9 <= len(digits) <= 15:
                continue
            out.append((kind, *m.span()))
    return sorted(out, key=lambda s: (s[1], list(PLAIN).index(s[0])))


def test_patterns_equal_plain_search():
    rng = random.Random(4)
    pieces = ["a", "B.c", "@", ".", "-", " ", "1", "25", "300", "1.2.3.4", "+1", "(", ")", "x@y.z", "4111111111111111", "4111 1111 1111 1111", "+49 30 1234567", "é", "\n", "_", "%", "٣", "000"]
    for _ in range(20_000):
        text = "".join(rng.choice(pieces) for _ in range(rng.randint(0, 14)))
        assert pii.patterns(text) == by_hand(text), text


@pytest.mark.parametrize("text", ["a" * 2_000_000, "1" * 2_000_000, "1." * 1_000_000, "@" * 1_000_000, "+1" * 1_000_000, "a@" * 500_000, "1 " * 1_000_000, "0" * 100_000 + ".1.1.1", "+1" + "(" * 1_000_000])
def test_long_runs_take_linear_time(text):
    import time

    started = time.time()
    pii.patterns(text)
    assert time.time() - started < 10


def test_gradients():
    rng = np.random.default_rng(1)
    model = tagger.Tagger.fresh(pii._ALLOWED, ~pii._INNER, hidden=3, embed=4, seed=2, dtype=np.float64)
    x, lengths = tagger.padded(["ab 1", "q@x.io 22", "z"], 9)
    tags = np.array([[0, 1, 2, 0, 0, 0, 0, 0, 0], [1, 2, 2, 2, 2, 2, 0, 5, 6], [0] * 9])
    model.weights["chain"] += rng.normal(0, 0.3, model.weights["chain"].shape)
    value, grads = model.loss(x, lengths, tags)
    for name, w in model.weights.items():
        flat = w.reshape(-1)
        for at in rng.choice(len(flat), min(25, len(flat)), replace=False):
            keep, h = flat[at], 1e-5
            flat[at] = keep + h
            up = model.loss(x, lengths, tags)[0]
            flat[at] = keep - h
            down = model.loss(x, lengths, tags)[0]
            flat[at] = keep
            assert abs((up - down) / (2 * h) - grads[name].reshape(-1)[at]) < 1e-5, (name, at)


def test_chain_against_all_paths():
    from itertools import product

    model = tagger.Tagger.fresh(np.array([[True, True, False], [True, True, True], [True, True, True]]), np.array([True, True, False]), hidden=2, embed=2, seed=3)
    model.weights["chain"] += np.random.default_rng(0).normal(0, 1, (3, 3))
    x, lengths = tagger.padded(["abc1", "x"], 4)
    scores, (inside, *_) = model.scores(x, lengths)
    for row, n in enumerate(lengths):
        worth = {}
        for path in product(range(3), repeat=int(n)):
            worth[path] = sum(scores[row, t, p] for t, p in enumerate(path)) + sum(model._chain()[a, b] for a, b in zip(path, path[1:]))
        total = np.log(sum(np.exp(v) for v in worth.values()))
        chances, _, logs = model.marginals(scores, inside)
        assert abs(logs[row] - total) < 1e-9
        assert tuple(model.best(scores, inside)[row, :n]) == max(worth, key=worth.get)
        for t in range(n):
            for k in range(3):
                want = sum(np.exp(v - total) for p, v in worth.items() if p[t] == k)
                assert abs(chances[row, t, k] - want) < 1e-9


def test_windows_cover_every_sign():
    rng = random.Random(6)
    for _ in range(500):
        text = "".join(rng.choice("abcde fgh" * 6 + "7@") for _ in range(rng.randint(0, 700)))
        got = pii.windows_of(text)
        last = max(0, -(-(len(text) - pii.WIDTH) // pii.STRIDE))
        want = [k * pii.STRIDE for k in range(last + 1) if re.search("[0-9@]", text[k * pii.STRIDE : k * pii.STRIDE + pii.WIDTH])]
        assert got == want


def test_reconcile_joins_cut_pieces_and_picks_the_best():
    text = "x" * 29 + " 020 555 1234 99 " + "y" * 200
    whole = ("phone", 30, 45, 0.95, False)
    assert pii.reconcile([("phone", 30, 40, 0.99, True), whole], text) == [("phone", 30, 45)]
    assert pii.reconcile([("phone", 30, 40, 0.99, True), ("phone", 36, 45, 0.93, True)], text) == [("phone", 30, 45)]
    assert pii.reconcile([("phone", 30, 42, 0.97, False), whole, ("email", 41, 60, 0.99, False)], text) == [("phone", 30, 45)]
    assert pii.reconcile([("phone", 30, 45, 0.5, False)], text) == []


def docs():
    rng = random.Random(11)
    word = lambda: "".join(rng.choice("etaoinshrdlu") for _ in range(rng.randint(2, 9)))
    prose = lambda n: " ".join(word() for _ in range(n))

    def card():
        digits = "4" + "".join(rng.choice("0123456789") for _ in range(14))
        return next(digits + c for c in "0123456789" if pii.luhn(digits + c))

    makers = [lambda: f"{word()}.{rng.randint(1, 99)}@mail{rng.randint(1, 9)}.example.com", lambda: ".".join(str(rng.randint(10, 250)) for _ in range(4)), card, lambda: f"+1 ({rng.randint(200, 999)}) 555-{rng.randint(1000, 9999)}"]
    return [(i, f"{prose(rng.randint(0, 60))} {rng.choice(makers)()} {prose(rng.randint(0, 60))}") for i in range(600)]


def test_learns_forms_beyond_the_patterns(spark):
    model = pii.fit(spark.createDataFrame(docs(), "doc_id long, text string"), per_kind=120)
    tests = ["nahte rolis (212) 555-9876 eth sonit lade", "sin laho marta.12(at)mail3.example.com reth tin", "eo an 10[.]20[.]30[.]40 tah sole"]
    got = pii.added(tests, [pii.patterns(t) for t in tests], model)
    assert [[(k, t[lo:hi]) for k, lo, hi in g] for g, t in zip(got, tests)] == [[("phone", "(212) 555-9876")], [("email", "marta.12(at)mail3.example.com")], [("ip", "10[.]20[.]30[.]40")]]
    clean = ["on 2024-05-17 at 10:45:00 they ran version 3.11.2", "see pages 120-135 and 1,299.00 of 300", "no signs at all here"]
    assert pii.added(clean, [[]] * 3, model) == [[], [], []]
    held = docs()[:50]
    rows = {r["doc_id"]: r for r in pii.scan(spark.createDataFrame([(i, t, "x", 1) for i, t in held], "doc_id long, text string, spans string, n_ip int"), model).collect()}
    for i, text in held:
        base = by_hand(text)
        assert rows[i]["base_spans"] == pii.named(base) and set(pii.named(base).split(",")) <= set(rows[i]["spans"].split(","))
        assert [rows[i][f"n_{k}"] for k in PLAIN] == [sum(s[0] == k for s in base) for k in PLAIN]


def test_null_empty_repeated_and_long(spark):
    rows = [(1, None), (2, ""), (None, "a@b.cd"), (3, "a@b.cd"), (3, "a@b.cd"), (4, "x" * 500_000 + " +49 30 1234567 y" + "7" * 500_000)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    assert pii.fit(df.filter("text is null")) is None
    got = sorted(((r["doc_id"], r["n_email"], r["n_phone"], r["spans"]) for r in pii.scan(df, None).collect()), key=str)
    assert got == [(1, 0, 0, ""), (2, 0, 0, ""), (3, 1, 0, "email:0:6"), (3, 1, 0, "email:0:6"), (4, 0, 1, "phone:500001:500015"), (None, 1, 0, "email:0:6")]
    assert pii.scan(df.limit(0), None).count() == 0
