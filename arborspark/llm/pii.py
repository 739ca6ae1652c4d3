"""Personal data: exact patterns, and a character tagger for what they miss.

The patterns find e-mail addresses, IPv4 addresses, card and phone numbers.
Their matches, and copies of them rewritten into forms that the patterns don't
read (``(at)``, ``[.]``, no country code), are the labelled spans from which a
bidirectional character LSTM with CRF transitions is trained.  It reads every
text in windows that overlap by half; the spans decoded in all windows of a
text are reconciled together: pieces cut by a window's edge are joined, then
the set of disjoint spans of the greatest total probability is taken, and what
meets no match of a pattern is added.

A span has to hold a digit, an ``@`` or a bracketed ``at`` to be one
(``plausible``), so windows without any of these can't give one and aren't
scored; texts of any length are read whole.

Defined results: a null text counts as empty; repeated rows each give their
own; without any labelled span nothing is added to the patterns' matches; other
columns, whatever their names, are ignored.  The fit uses at most ``per_kind``
labelled windows of each kind and as many without a span, drawn by hash from
all texts.
"""

from __future__ import annotations

import re
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from arborspark.llm.tagger import Tagger, padded, train

Span = tuple[str, int, int]

# Kinds in the order in which equal starts are listed, and their patterns.
KINDS = ("email", "ip", "card", "phone")
_LOCAL = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-"
_DOMAIN = re.compile(r"[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++")
_IP = re.compile(r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++")
_CARD = re.compile(r"[0-9](?:[ -]?[0-9])++")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")

WIDTH, STRIDE = 96, 48
LESSON = 64  # characters of a training window
BATCH = 256
SURE = 0.9  # least mean probability of an added span's characters
_AT = r"[(\[{] ?at ?[)\]}]"
_SIGNS = "[0-9@]|" + _AT
_TRIGGER = re.compile(_SIGNS)
_NOT_DIGIT = re.compile("[^0-9]")
_NUMBERS = re.compile("[0-9]+")


def luhn(digits: str) -> bool:
    values = [int(d) for d in reversed(digits)]
    return sum(values[::2]) % 10 == sum((2 * v) // 10 + (2 * v) % 10 for v in values[1::2]) * 9 % 10


def _emails(text: str) -> Iterator[tuple[int, int]]:
    """Matches around each ``@``: what precedes it is a run of local characters, so no start is tried twice."""
    free, at = 0, text.find("@")
    while at >= 0:
        behind = at + 1
        domain = _DOMAIN.match(text, behind)
        if domain:
            before = text[free:at]
            start = free + len(before.rstrip(_LOCAL))
            if start < at:
                yield start, domain.end()
                behind = domain.end()
        free = behind
        at = text.find("@", behind)


def patterns(text: str) -> list[Span]:
    """Matches of the four patterns, by start and kind."""
    out: list[Span] = [("email", *m) for m in _emails(text)]
    out += [("ip", *m.span()) for m in _IP.finditer(text) if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in m.group().split("."))]
    for kind, pattern, low, high in (("card", _CARD, 12, 19), ("phone", _PHONE, 9, 15)):
        for m in pattern.finditer(text):
            digits = _NOT_DIGIT.sub("", m.group())
            if low <= len(digits) <= high and (kind == "phone" or luhn(digits)):
                out.append((kind, *m.span()))
    return listed(out)


def listed(spans: Sequence[Span]) -> list[Span]:
    return sorted(spans, key=lambda s: (s[1], KINDS.index(s[0]), s[2]))


def named(spans: Sequence[Span]) -> str:
    return ",".join(f"{kind}:{start}:{end}" for kind, start, end in spans)


def plausible(kind: str, text: str) -> bool:
    """Whether a decoded span can be of its kind: its digits or signs have to bear it out."""
    digits = _NOT_DIGIT.sub("", text)
    if kind == "email":
        return ("@" in text or re.search(_AT, text) is not None) and len(text) >= 6
    if kind == "ip":
        numbers = _NUMBERS.findall(text)
        return len(numbers) == 4 and all(len(p) <= 3 and int(p) <= 255 for p in numbers)
    if kind == "card":
        return 12 <= len(digits) <= 19 and luhn(digits)
    return 7 <= len(digits) <= 15


def trimmed(kind: str, lo: int, hi: int, text: str) -> tuple[int, int] | None:
    """The span without words before an address's local part; None if it isn't plausible or ends inside a word."""
    at = re.search(rf" ?(?:@|{_AT})", text[lo:hi]) if kind == "email" else None
    if at:
        lo = text.rfind(" ", lo, lo + at.start()) + 1 or lo
    inside = (lo > 0 and text[lo - 1].isalnum()) or (hi < len(text) and text[hi].isalnum())
    return (lo, hi) if not inside and plausible(kind, text[lo:hi]) else None


# ----------------------------------------------------------------- training

# tag 0 is outside; kind k begins with 1 + 2k and goes on with 2 + 2k
_TAGS = 1 + 2 * len(KINDS)
_INNER = (np.arange(_TAGS) % 2 == 0) & (np.arange(_TAGS) > 0)
_ALLOWED = np.array([[not _INNER[b] or a in (b, b - 1) for b in range(_TAGS)] for a in range(_TAGS)])


def labelled_windows(docs: DataFrame, per_kind: int) -> DataFrame:
    """(kind, text, start, end): at most ``per_kind`` windows around a match of each kind, and around plain digits (kind null)."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows: list[tuple] = []
            for text in _with_signs(batch.column(0)):
                found = patterns(text)
                taken = 0
                for kind, start, end in found:
                    if end - start <= WIDTH - 16:
                        lo = max(0, start - (WIDTH - end + start) // 2)
                        rows.append((kind, text[lo : lo + WIDTH], start - lo, end - lo))
                for m in _TRIGGER.finditer(text):
                    if m.start() >= taken and not any(s - 8 < m.start() < e + 8 for _, s, e in found):
                        lo = max(0, m.start() - WIDTH // 2)
                        rows.append((None, text[lo : lo + WIDTH], 0, 0))
                        taken = m.start() + WIDTH
            yield pa.RecordBatch.from_pylist([dict(zip(("kind", "text", "start", "end"), r)) for r in rows], pa.schema([("kind", pa.string()), ("text", pa.string()), ("start", pa.int32()), ("end", pa.int32())]))

    found = docs.select("text").mapInArrow(cut, "kind string, text string, start int, end int")
    place = Window.partitionBy("kind").orderBy("draw", "text", "start")
    drawn = found.withColumn("draw", F.xxhash64("text", "start")).withColumn("place", F.row_number().over(place))
    return drawn.filter(F.col("place") <= per_kind).drop("draw", "place")


def _with_signs(texts: pa.Array) -> list[str]:
    """Texts that hold a digit, an @ or a bracketed at."""
    held = texts.filter(pc.fill_null(pc.match_substring_regex(texts, _SIGNS), False))
    return held.to_pylist()


def _rewritten(kind: str, said: str, rng: np.random.Generator) -> str:
    """The span in a form that the patterns don't match."""
    pick = lambda *ways: ways[rng.integers(len(ways))]
    if kind == "email":
        return said.replace("@", pick(" @ ", "(at)", "[at]", " (at) ", " [at] ")).replace(".", pick(".", ".", "[.]", "(.)"))
    if kind == "ip":
        return said.replace(".", pick("[.]", "(.)", " . ", ". "))
    digits = _NOT_DIGIT.sub("", said)
    if kind == "card":
        return pick(".", "/", "_", "  ").join(digits[i : i + 4] for i in range(0, len(digits), 4))
    area, rest, last = digits[-10:-7], digits[-7:-4], digits[-4:]
    return pick(f"({area}) {rest}-{last}", f"{area}-{rest}-{last}", f"{area}.{rest}.{last}", f"00{digits[:-10]} {area} {rest} {last}", f"{area} {rest} {last}")


def _harmless(rng: np.random.Generator) -> str:
    """Digits that are no personal data: dates, times, versions, amounts, page ranges, hashes."""
    n = lambda lo, hi: int(rng.integers(lo, hi))
    ways = (
        lambda: f"{n(1900, 2030)}-{n(1, 13):02d}-{n(1, 29):02d}", lambda: f"{n(1, 29)}.{n(1, 13)}.{n(1900, 2030)}", lambda: f"{n(0, 24):02d}:{n(0, 60):02d}:{n(0, 60):02d}",
        lambda: f"{n(0, 20)}.{n(0, 20)}.{n(0, 40)}", lambda: f"{n(1, 1000)},{n(0, 1000):03d}.{n(0, 100):02d}", lambda: f"{n(1, 400)}-{n(400, 900)}", lambda: "".join(rng.choice(list("0123456789abcdef"), n(12, 40))),
        lambda: str(n(0, 10 ** n(1, 9))), lambda: f"{n(1, 1000)} {n(1, 1000)} {n(1, 1000)}", lambda: f"@{''.join(rng.choice(list('abcdehlnorst'), n(3, 9)))}",
    )
    return ways[n(0, len(ways))]()


def training_set(windows: Sequence[tuple], seed: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Codes, lengths and tags: each window as it is, rewritten, and with harmless digits in the span's place."""
    rng, texts, marks = np.random.default_rng(seed), [], []
    for kind, text, start, end in windows:
        forms = [(text, [s for s in patterns(text) if s[2] - s[1] <= WIDTH])]
        if kind is not None and len(forms[0][1]) == 1:
            for said in (_rewritten(kind, text[start:end], rng), _rewritten(kind, text[start:end], rng)):
                forms.append((text[:start] + said + text[end:], [(kind, start, start + len(said))]))
            forms.append((text[:start] + _harmless(rng) + text[end:], []))
        for form, spans in forms:
            reach = max((hi for *_, hi in spans), default=end)
            least = max(0, reach + 4 - LESSON)
            shift = int(rng.integers(least, max(least, start - 4) + 1))
            tags = np.zeros(max(len(form), LESSON + shift), dtype=np.int64)
            for k, lo, hi in reversed(spans):
                tags[lo:hi] = 2 + 2 * KINDS.index(k)
                tags[lo] -= 1
            cut = form[shift : shift + LESSON]
            if cut and not _INNER[tags[shift]]:
                texts.append(cut)
                marks.append(tags[shift : shift + LESSON])
    x, lengths = padded(texts, LESSON)
    return x, lengths, np.array(marks).reshape(len(texts), LESSON)


def fit(docs: DataFrame, per_kind: int = 200, epochs: int = 10, seed: int = 7) -> Tagger | None:
    """Tagger from the labelled windows of ``docs`` (text); None if there are none."""
    windows = sorted((tuple(r) for r in labelled_windows(docs, per_kind).collect()), key=lambda r: (r[0] or "", r[1], r[2]))
    if not any(kind for kind, *_ in windows):
        return None
    tagger = Tagger.fresh(_ALLOWED, ~_INNER, hidden=24, seed=seed)
    train(tagger, *training_set(windows, seed), epochs=epochs, batch=32, seed=seed)
    return tagger


# ----------------------------------------------------------------- decoding

def windows_of(text: str) -> list[int]:
    """Starts of the windows of a text that hold a sign of personal data."""
    last = max(0, -(-(len(text) - WIDTH) // STRIDE))
    starts: list[int] = []
    for m in _TRIGGER.finditer(text):
        lo = max(0, -(-(m.end() - WIDTH) // STRIDE))
        for k in range(max(lo, (starts[-1] // STRIDE + 1) if starts else 0), min(m.start() // STRIDE, last) + 1):
            starts.append(k * STRIDE)
    return starts


def _spans(tags: np.ndarray, chance: np.ndarray, length: int) -> Iterator[tuple[str, int, int, float]]:
    at = 0
    while at < length:
        if tags[at] == 0:
            at += 1
            continue
        inner, lo = tags[at] + 1, at
        at += 1
        while at < length and tags[at] == inner:
            at += 1
        yield KINDS[(inner - 2) // 2], lo, at, float(chance[lo:at].mean())


def reconcile(pieces: Sequence[tuple[str, int, int, float, bool]], text: str) -> list[Span]:
    """One set of disjoint spans from all windows' (kind, start, end, probability, cut by an edge)."""
    joined: list[tuple[str, int, int, float]] = []
    for kind in KINDS:
        own = sorted({p for p in pieces if p[0] == kind}, key=lambda p: (p[1], p[2], p[3], p[4]))
        joined += [p[:4] for p in own if not p[4]]
        run = None
        for _, lo, hi, chance, cut in own:
            if run and lo < run[1] and (cut or run[3]):
                run = (run[0], max(run[1], hi), min(run[2], chance), True)
            else:
                if run and run[3]:
                    joined.append((kind, *run[:3]))
                run = (lo, hi, chance, cut)
        if run and run[3]:
            joined.append((kind, *run[:3]))
    cut = {(kind, *own, chance) for kind, lo, hi, chance in joined if chance >= SURE and (own := trimmed(kind, lo, hi, text))}
    sure = sorted(cut, key=lambda p: (p[2], p[1], KINDS.index(p[0]), p[3]))
    ends = [p[2] for p in sure]
    best: list[tuple[float, tuple[int, ...]]] = [(0.0, ())]
    for i, (_, lo, hi, chance) in enumerate(sure):
        before = best[int(np.searchsorted(ends[:i], lo, side="right"))]
        worth = before[0] + chance * (hi - lo)
        best.append((worth, (i,)) if worth > best[-1][0] else (best[-1][0], ()))
    chosen, i = [], len(sure)
    while i > 0:
        if best[i][1]:
            chosen.append(sure[i - 1][:3])
            i = int(np.searchsorted(ends[: i - 1], sure[i - 1][1], side="right"))
        else:
            i -= 1
    return chosen


def added(texts: Sequence[str], bases: Sequence[Sequence[Span]], tagger: Tagger) -> list[list[Span]]:
    """Spans that the tagger adds to each text's pattern matches."""
    places = [(row, start) for row, text in enumerate(texts) for start in windows_of(text)]
    pieces: list[list] = [[] for _ in texts]
    for at in range(0, len(places), BATCH):
        part = places[at : at + BATCH]
        cuts = [texts[row][start : start + WIDTH] for row, start in part]
        tags, chances = tagger.tag(cuts, WIDTH)
        for (row, start), cut, tag, chance in zip(part, cuts, tags, chances):
            for kind, lo, hi, p in _spans(tag, chance, len(cut)):
                edge = (lo == 0 and start > 0) or (hi == len(cut) and start + hi < len(texts[row]))
                pieces[row].append((kind, start + lo, start + hi, p, edge))
    out = []
    for text, base, own in zip(texts, bases, pieces):
        found = reconcile(own, text) if own else []
        out.append([(k, lo, hi) for k, lo, hi in found if not any(lo < e and s < hi for _, s, e in base)])
    return out


def scan(docs: DataFrame, tagger: Tagger | None, key: str = "doc_id") -> DataFrame:
    """(key, n_email, n_ip, n_card, n_phone, base_spans, spans) of every row; the counts are the patterns'."""
    kinds = [f"n_{kind}" for kind in KINDS]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            held = np.flatnonzero(pc.fill_null(pc.match_substring_regex(batch.column(1), _SIGNS), False).to_numpy(zero_copy_only=False))
            counts = np.zeros((len(KINDS), batch.num_rows), dtype=np.int64)
            base, full = np.full(batch.num_rows, "", dtype=object), np.full(batch.num_rows, "", dtype=object)
            for part in np.array_split(held, max(1, -(-len(held) // BATCH))):
                texts = batch.column(1).take(pa.array(part)).to_pylist()
                bases = [patterns(t) for t in texts]
                more = added(texts, bases, tagger) if tagger is not None else [[] for _ in texts]
                for row, own, new in zip(part, bases, more):
                    for kind, *_ in own:
                        counts[KINDS.index(kind), row] += 1
                    base[row], full[row] = named(own), named(listed([*own, *new]))
            yield pa.RecordBatch.from_arrays([batch.column(0), *map(pa.array, counts), pa.array(base, pa.string()), pa.array(full, pa.string())], ["key", *kinds, "base_spans", "spans"])

    kind = docs.schema[key].dataType.simpleString()
    schema = ", ".join([f"key {kind}", *[f"{c} long" for c in kinds], "base_spans string", "spans string"])
    return docs.select(key, "text").mapInArrow(run, schema).withColumnRenamed("key", key)
