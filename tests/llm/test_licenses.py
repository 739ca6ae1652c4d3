import time
import re

import pytest

from arborspark.llm import licenses

TEXTS = [
    None, "", "!!! \n", "This is under the MIT License, or the mit  license.", "GNU General\nPublic-License! cc by", "gnu general publc licence v3",
    "Released under teh MIT license", "xcc by", "cc bye", "cc", "by cc", "Apache License, Versoin 2.0 " * 3, "cc by cc by", "mit license " * 20000, "ähnlich cc by ß",
    "permission is hereby granted, free of charge", "the general public of an apache", "l'apache license",
]


def base(text):
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", "".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))
    at, labels = [], set()
    for phrase, label in licenses.BASE.items():
        p = phrase.split(" ")
        hits = [i for i in range(len(words)) if words[i : i + len(p)] == p]
        at += hits
        labels |= {label} if hits else set()
    return len(words), len(at), min(at, default=None), max(at, default=None), ",".join(sorted(labels))


@pytest.fixture(scope="module")
def rows(spark):
    df = spark.createDataFrame([(i, t, "clash") for i, t in enumerate(TEXTS)], "doc_id long, text string, labels string")
    assert licenses.scan(df.limit(0)).count() == 0
    return {r.doc_id: r for r in licenses.scan(df).collect()}


def test_base_equals_brute_force(rows):
    for i, t in enumerate(TEXTS):
        r = rows[i]
        assert (r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels) == base(t), t
        assert set(r.base_labels.split(",")) - {""} <= set(r.labels.split(",")) and 0 <= r.score <= 1


def test_fuzzy_spans(rows):
    r = rows[5]
    assert r.labels == "gpl" and r.base_labels == "" and 0.8 < r.score < 1
    span = r.spans[0]
    assert TEXTS[5][span.start : span.end] == "gnu general publc licence" and span.edits == 2
    assert rows[6].labels == "mit" and rows[11].labels == "apache" and len(rows[11].spans) >= 3
    assert rows[16].labels == "" and rows[16].score == 0


def distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        row, old = [i], row
        for j, y in enumerate(b, 1):
            row.append(min(row[-1] + 1, old[j] + 1, old[j - 1] + (x != y)))
    return row[-1]


def test_seeds_lose_no_match():
    import random

    r, scanner = random.Random(4), licenses.Scanner(licenses.BASE, licenses.NOTICES, 12)
    for _ in range(300):
        i = r.randrange(len(scanner.notices))
        notice = scanner.notices[i][0]
        broken = list(notice)
        for _ in range(scanner.edits(notice)):
            at = r.randrange(len(broken))
            broken[at : at + r.randint(0, 1)] = r.choice(["", "x", broken[at] + "q"])
        broken = "".join(broken)
        assert distance(broken, notice) > scanner.edits(notice) or any(m[0] == i for m in scanner.fuzzy(f"some words {broken} and more"))


def test_better_match_hides_no_worse_one():
    scanner = licenses.Scanner(licenses.BASE, licenses.NOTICES, 12)
    good, bad = "mozilla public license", "mozilla publik license"
    for parts in ([bad, good], [good, bad], [bad, bad, good], [bad, good, bad, good], [bad, good] * 500):
        for gap in (" ", " x "):
            found = scanner.fuzzy(gap.join(parts))
            assert [m[3] for m in found] == [int(p == bad) for p in parts]
            assert all(a[2] <= b[1] for a, b in zip(found, found[1:]))


def test_dense_notices_are_all_found():
    import random

    r, scanner = random.Random(9), licenses.Scanner(licenses.BASE, licenses.NOTICES, 12)
    for i, (notice, _) in enumerate(scanner.notices):
        for _ in range(20):
            parts, allowed = [], scanner.edits(notice)
            for _ in range(8):
                broken = list(notice)
                for at in r.sample(range(2, len(notice) - 2), r.randint(0, allowed)):
                    broken[at] = "q"
                parts.append("".join(broken))
            found = [m for m in scanner.fuzzy(" ".join(parts)) if m[0] == i]
            assert len(found) == len(parts)
            for m, part in zip(found, parts):
                assert m[3] == distance(part, notice)


def test_matches_hold_whole_words():
    scanner = licenses.Scanner(licenses.BASE, licenses.NOTICES, 12)
    for text in ("overall rights reservedly", "premozilla public licenses", "xall rights reserved", "small rights reserved x"):
        assert scanner.scan(text)[5:] == ("", 0.0, []), text
    for text, edits in (("so all rights reserved", 0), ("all right reserved.", 1), ("mozilla publik license", 1), ("all rights reservedly all rights reserved", 0)):
        (span,) = scanner.scan(text)[7]
        assert span[6] == edits, text
        assert text[span[2] : span[3]].split()[0] == "all" or text[span[2] : span[3]] == "mozilla publik license"


def test_dense_notices_take_linear_time():
    scanner = licenses.Scanner(licenses.BASE, licenses.NOTICES, 12)
    scanner.scan("warm up all rights reserved")
    for phrase in ("mit license ", "all rights reserved. "):
        text = phrase * (2_000_000 // len(phrase))
        began = time.perf_counter()
        n, base, first, last, *_, spans = scanner.scan(text)
        took = time.perf_counter() - began
        assert took < 30
        assert (base or len(spans)) == 2_000_000 // len(phrase)
