"""Personal data: high-recall generators, boosted trees, calibrated thresholds.

Rules find the base spans (email, ip, card, phone); these are always redacted. Generators propose
many more, overlapping spans: everything around an at-sign or its written forms, and everything
that looks like grouped digits. For every kind, gradient-boosted trees read a candidate's format
(digits, groups, separators, length) and its context (the words before it, what surrounds it) and
give a margin; a logistic fit on held-out candidates calibrates it to a probability. A candidate is
added if its probability reaches the kind's threshold, the least one at which held-out candidates
are right ``PRECISION`` of the time, and if it overlaps neither a base span nor a likelier one.

There are no labels for personal data, so base spans teach, but never as they stand, since what can be
added is what the base rules miss. Each base span of the sample is written in ``VARIANTS`` other ways
(at and dot in words or brackets, bracketed points, other separators, no plus sign), in its own
context: candidates that match a rewriting are positives of its kind. Negatives are the candidates
that stand in the texts beside base spans, and near misses (numbers that fail their checks, versions,
dates, an at-sign in prose) put between words. A document's rows are all for fitting or all held out,
if both parts can have enough. A threshold also lets pass at most ``NATURAL`` of the held-out
candidates that stand in the texts. Training uses at most ``MAX_DOCS`` documents in expectation, drawn
by a hash, and at most ``MAX_CANDIDATES`` candidates, in one task; the trees are a few thousand
numbers. Finding and scoring cover every whole text, in the tasks that read them.

Cases: null and empty texts have no spans; a text of any length is read whole; a kind of which the
sample has hardly any base span (fewer than ``LEAST_ROWS`` rewritings in either part) adds none; a row
that repeats gives a row each; an empty table gives no rows; other
columns are left as they are.
"""

from __future__ import annotations

import bisect
import hashlib
import random
import re
import zlib
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lexigate.llm.words import blocks, strings

KINDS = ("email", "ip", "card", "phone")
MAX_DOCS = 4096
MAX_CANDIDATES = 40_000
VARIANTS, MISSES = 16, 3  # rewritings of a base span, near misses per document
TREES, DEPTH, RATE, BINS, LEAST_ROWS = 40, 3, 0.3, 32, 20
PRECISION, NATURAL = 0.95, 0.005
AROUND = 60  # characters of context that a rewriting keeps
SEED = 11
CUES = 64  # hashed places for the word before a candidate
RESULT = (
    "struct<n_email: bigint, n_ip: bigint, n_card: bigint, n_phone: bigint,"
    " base_sha256: string, spans: string>"
)

Span = tuple[int, int]

# --- base rules -------------------------------------------------------------------------------
# Each finds what its rule finds leftmost, without overlap, in time that is linear in the text.

_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
# a start inside a run of digits never fares better than the run's start
_IP = re.compile(r"(?<![0-9])[0-9]+(?:\.[0-9]+){3}")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_DIGIT = re.compile(r"[0-9]")


def _back(text: str, start: int, floor: int) -> int:
    while start > floor and text[start - 1] in _LOCAL:
        start -= 1
    return start


def emails(text: str) -> Iterator[Span]:
    floor = 0
    for match in _DOMAIN.finditer(text):
        start = _back(text, match.start(), floor)
        if start < match.start():
            yield start, match.end()
            floor = match.end()


def luhn(digits: str) -> bool:
    total = 0
    for place, digit in enumerate(reversed(digits)):
        value = int(digit) * (1 + place % 2)
        total += value - 9 * (value > 9)
    return total % 10 == 0


def digits_of(text: str) -> str:
    return "".join(_DIGIT.findall(text))


def base_spans(text: str) -> list[list[Span]]:
    """Per kind, in order."""
    found: list[list[Span]] = [list(emails(text)) if "@" in text else [], [], [], []]
    for match in _IP.finditer(text):
        if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in match[0].split(".")):
            found[1].append(match.span())
    for match in _CARD.finditer(text):
        if match.end() - match.start() >= 13:
            digits = digits_of(match[0])
            if 13 <= len(digits) <= 19 and luhn(digits):
                found[2].append(match.span())
    if "+" in text:
        for match in _PHONE.finditer(text):
            if 9 <= len(digits_of(match[0])) <= 15:
                found[3].append(match.span())
    return found


# --- candidates -------------------------------------------------------------------------------

_AT = re.compile(
    r" ?(?:@|[(\[]at[)\]]) ?[A-Za-z0-9-]+(?: ?(?:\.|[(\[]dot[)\]]) ?[A-Za-z0-9-]+)+"
)
_GROUPED = re.compile(r"\+?\(?[0-9](?:[ ().-]{0,2}[0-9]){6,}")
# four numbers with points that may be spaced or bracketed
_QUAD = re.compile(r"(?<![0-9])[0-9]{1,3}(?: ?(?:\.|[(\[](?:\.|dot)[)\]]) ?[0-9]{1,3}){3}(?![0-9])")
_LAST = re.compile(r"[A-Za-z]*\Z")
_BEFORE = re.compile(r"(\S+)\s*\Z")
_DIGITS, _SEPARATORS = frozenset("0123456789"), " -.()["
_PLAIN = 27
FEATURES = _PLAIN + CUES


def candidates(text: str) -> list[tuple[bool, int, int]]:
    """(has an at-sign, start, end); those of one generator do not overlap, those of two may."""
    found = []
    if "@" in text or "at]" in text or "at)" in text:
        floor = 0
        for match in _AT.finditer(text):
            start = _back(text, match.start(), floor)
            if start < match.start():
                found.append((True, start, match.end()))
                floor = match.end()
    for match in _GROUPED.finditer(text):
        found.append((False, *match.span()))
        plain = re.sub(r"\A[+(]+", "", match[0])
        if len(plain) < len(match[0]):
            found.append((False, match.end() - len(plain), match.end()))
    found += [(False, *match.span()) for match in _QUAD.finditer(text)]
    return found


def describe(text: str, at: bool, start: int, end: int) -> np.ndarray:
    span, row = text[start:end], np.zeros(FEATURES, dtype=np.float32)
    groups = re.findall(r"[0-9]+", span)
    digits = "".join(groups)
    sizes = [len(g) for g in groups] or [0]
    before, after = text[max(0, start - 40) : start], text[end : end + 20]
    cue, last = _BEFORE.search(before), _LAST.search(span)[0]
    word = cue[1].lower().strip(".,;:()[]") if cue else ""
    row[:_PLAIN] = (
        at,
        len(span),
        len(digits),
        len(groups),
        max(sizes),
        min(sizes),
        sizes[0],
        sizes[-1],
        *(span.count(s) for s in _SEPARATORS),
        span[:1] == "+",
        len(digits) >= 13 and luhn(digits),
        sum(int(g[-4:]) <= 255 for g in groups if len(g) <= 4) if groups else 0,
        len(word),
        before[-2:].strip()[-1:] == ":",
        sum(c in _DIGITS for c in before),
        sum(c in _DIGITS for c in after),
        before[-1:].isalnum(),
        after[:1].isalnum(),
        len(groups) == 4 and all(len(g) <= 3 and int(g) <= 255 for g in groups),
        len(last),
        last.islower(),
        ". " in span,
    )
    if word and not any(c in _DIGITS for c in word):
        row[_PLAIN + zlib.crc32(word.encode()) % CUES] = 1
    return row


# --- examples ---------------------------------------------------------------------------------


def rewritten(kind: str, span: str, rng: random.Random) -> str:
    """The same personal data in a form that the base rules miss, mostly."""
    if kind == "email":
        local, _, domain = span.rpartition("@")
        # other people and hosts: some without the numbers, first names or subdomains of this one
        plain = re.sub(r"[0-9]+", "", local).strip(".") or local
        local = rng.choice([local, plain, plain.split(".")[0] or local, f"{plain[:3]}.{plain[3:]}".strip(".")])
        labels = [re.sub(r"[0-9]+", "", x) or x for x in domain.split(".")]
        domain = rng.choice([domain, ".".join(labels), ".".join(labels[-2:]), ".".join([labels[0], "co", "uk"])])
        at, dots = rng.choice(
            [(" @ ", " . "), (" @ ", "."), *((a, d) for a in (" (at) ", " [at] ", "(at)", "[at]")
             for d in (" (dot) ", " [dot] ", "(dot)", "[dot]"))]
        )
        return local + at + domain.replace(".", dots)
    digits = digits_of(span)
    if kind == "ip":
        return rng.choice(["[.]", "(.)", " . ", "[dot]", "(dot)", ". "]).join(span.split("."))
    if kind == "card":
        groups = [digits[i : i + 4] for i in range(0, len(digits), 4)]
        return rng.choice(["  ", ".", "- ", " -"]).join(groups)
    area, first, rest = digits[-10:-7], digits[-7:-4], digits[-4:]
    country = digits[:-10]
    mark = rng.choice(["-", " ", "."])
    return rng.choice(
        [
            digits,
            f"00{digits}",
            mark.join(filter(None, (country, area, first, rest))),
            f"({area}) {first}{mark}{rest}",
            mark.join((area, first, rest)),
        ]
    )


def near_miss(text: str, rng: random.Random) -> str:
    """What a generator proposes and is no personal data."""

    def digits(n: int) -> str:
        return "".join(rng.choice("0123456789") for _ in range(n))

    def unlucky() -> str:
        number = digits(16)
        return number if not luhn(number) else number[:-1] + str((int(number[-1]) + 1) % 10)

    def words(n: int) -> list[str]:
        at = rng.randrange(max(1, len(text)))
        return [w for w in re.findall(r"[A-Za-z]+", text[at : at + 200])[:n]] or ["then"]

    number = unlucky()
    year, month, day = rng.randrange(1950, 2040), rng.randrange(1, 13), rng.randrange(1, 29)
    points = rng.choice(["[.]", ".", " . ", "(.)", "[dot]"])
    said = words(3)
    return rng.choice(
        [
            number,
            rng.choice(["  ", ".", "- ", " "]).join(number[i : i + 4] for i in range(0, 16, 4)),
            points.join(str(rng.randrange(256, 1000)) for _ in range(4)),
            points.join(str(rng.randrange(30)) for _ in range(rng.choice([5, 6]))),
            f"{year}-{month:02d}-{day:02d} {rng.randrange(24):02d}.{rng.randrange(60):02d}",
            f"{day:02d}.{month:02d}.{year} {rng.randrange(24):02d}.{rng.randrange(60):02d}",
            digits(rng.randrange(9, 16)),
            f"{digits(2)}-{digits(3)}-{digits(3)}",
            f"{said[0]} @ {said[-1]}. {said[0].title()}",
            f"{said[0]} (at) {said[-1]}. {said[0].title()}",
        ]
    )


def examples(text: str) -> Iterator[tuple[np.ndarray, int, bool]]:
    """(features, kind's number or -1, whether the candidate stands in the text as it is)."""
    rng = random.Random(zlib.crc32(text.encode("utf-8", "replace")))
    base = base_spans(text)
    taken = Taken([span for spans in base for span in spans])
    for candidate in candidates(text):
        if not taken.overlaps(*candidate[1:]):
            yield describe(text, *candidate), -1, True
    planted = [
        (k, start, end, rewritten(kind, text[start:end], rng))
        for k, kind in enumerate(KINDS)
        for start, end in base[k]
        for _ in range(VARIANTS)
    ]
    for _ in range(MISSES if text.strip() else 0):
        at = text.find(" ", rng.randrange(len(text)))
        if at >= 0:
            planted.append((-1, at + 1, at + 1, f"{near_miss(text, rng)} "))
    for k, start, end, piece in planted:
        before = text[max(0, start - AROUND) : start]
        window = before + piece + text[end : end + AROUND]
        lo, hi = len(before), len(before) + len(piece.rstrip())
        own = Taken([span for spans in base_spans(window) for span in spans])
        for at, a, b in candidates(window):
            shared = min(b, hi) - max(a, lo)
            if 2 * shared >= max(b, hi) - min(a, lo) and not own.overlaps(a, b):
                yield describe(window, at, a, b), k, False


class Taken:
    """Spans in order, without overlap; those added that overlap are merged."""

    def __init__(self, spans: list[Span] = ()):
        self.starts: list[int] = []
        self.ends: list[int] = []
        for start, end in sorted(spans):
            if self.ends and start < self.ends[-1]:
                self.ends[-1] = max(self.ends[-1], end)
            else:
                self.starts.append(start)
                self.ends.append(end)

    def overlaps(self, start: int, end: int) -> bool:
        first = bisect.bisect_right(self.ends, start)
        return first < len(self.starts) and self.starts[first] < end

    def add(self, start: int, end: int) -> None:
        place = bisect.bisect_left(self.starts, start)
        self.starts.insert(place, start)
        self.ends.insert(place, end)


# --- boosted trees ----------------------------------------------------------------------------


class Trees(NamedTuple):
    """Complete binary trees in level order, and the calibration of their margins."""

    feature: np.ndarray  # trees x inner nodes
    cut: np.ndarray
    leaf: np.ndarray  # trees x leaves
    start: float
    slope: float
    offset: float
    threshold: float

    def margin(self, x: np.ndarray) -> np.ndarray:
        total = np.full(len(x), self.start)
        rows = np.arange(len(x))
        for feature, cut, leaf in zip(self.feature, self.cut, self.leaf, strict=True):
            node = np.zeros(len(x), dtype=np.int64)
            for _ in range(DEPTH):
                node = 2 * node + 1 + (x[rows, feature[node]] > cut[node])
            total += leaf[node - len(cut)]
        return total

    def probability(self, x: np.ndarray) -> np.ndarray:
        return sigmoid(self.slope * self.margin(x) + self.offset)


def sigmoid(value: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(value, -40, 40)))


def boost(x: np.ndarray, y: np.ndarray) -> Trees:
    """Trees on second-order gains of the logistic loss, over quantile bins."""
    cuts = np.quantile(x, np.linspace(0, 1, BINS + 1)[1:-1], axis=0)
    binned = np.stack([np.searchsorted(cuts[:, j], x[:, j]) for j in range(x.shape[1])], axis=1)
    start = float(np.log((y.sum() + 1) / (len(y) - y.sum() + 1)))
    margin = np.full(len(y), start)
    inner, leaves = 2**DEPTH - 1, 2**DEPTH
    columns = np.arange(x.shape[1])
    trees = []
    for _ in range(TREES):
        p = sigmoid(margin)
        gradient, curve = p - y, p * (1 - p) + 1e-6
        node = np.zeros(len(y), dtype=np.int64)
        feature, cut = np.zeros(inner, dtype=np.int64), np.full(inner, np.inf)
        for level in range(DEPTH):
            for number in range(2**level - 1, 2 ** (level + 1) - 1):
                own = np.flatnonzero(node == number)
                if len(own) >= 2 * LEAST_ROWS:
                    place = (binned[own] + columns * BINS).ravel()
                    sums = [
                        np.bincount(place, np.repeat(v[own], len(columns)), len(columns) * BINS)
                        .reshape(-1, BINS)
                        .cumsum(axis=1)
                        for v in (gradient, curve, np.ones(len(y)))
                    ]
                    g, h, n = sums
                    rest = [s[:, -1:] - s for s in sums]
                    gain = g**2 / (h + 1) + rest[0] ** 2 / (rest[1] + 1) - g[:, -1:] ** 2 / (h[:, -1:] + 1)
                    gain[(n < LEAST_ROWS) | (rest[2] < LEAST_ROWS)] = 0
                    gain[:, -1] = 0
                    j, b = divmod(int(gain.argmax()), BINS)
                    if gain[j, b] > 1e-6:
                        feature[number], cut[number] = j, cuts[b, j]
                node[own] = 2 * number + 1 + (x[own, feature[number]] > cut[number])
        at = node - inner
        leaf = -RATE * np.bincount(at, gradient, leaves) / (np.bincount(at, curve, leaves) + 1)
        margin += leaf[at]
        trees.append((feature, cut, leaf))
    return Trees(*(np.stack(part) for part in zip(*trees)), start, 1.0, 0.0, 2.0)


def calibrated(trees: Trees, x: np.ndarray, y: np.ndarray, natural: np.ndarray | None = None) -> Trees:
    """Logistic fit of held-out margins, and the least threshold that meets ``PRECISION``.

    Of the rows marked ``natural``, at most a share of ``NATURAL`` may reach it.
    """
    margin = trees.margin(x)
    target = np.where(y == 1, (y.sum() + 1) / (y.sum() + 2), 1 / (len(y) - y.sum() + 2))
    slope, offset = 1.0, 0.0
    for _ in range(25):
        p = sigmoid(slope * margin + offset)
        w, error = p * (1 - p) + 1e-9, p - target
        hessian = np.array(
            [[(w * margin**2).sum() + 1e-3, (w * margin).sum()], [(w * margin).sum(), w.sum() + 1e-3]]
        )
        step = np.linalg.solve(hessian, [(error * margin).sum() + 1e-3 * (slope - 1), error.sum()])
        slope, offset = slope - step[0], offset - step[1]
        if not (np.isfinite(slope) and slope > 0.05):
            slope, offset = 1.0, 0.0
            break
    trees = trees._replace(slope=float(slope), offset=float(offset))
    p = trees.probability(x)
    order = np.argsort(-p)
    right = np.cumsum(y[order]) / (np.arange(len(y)) + 1)
    last = np.append(p[order][1:] != p[order][:-1], True)
    good = np.flatnonzero((right >= PRECISION) & last)
    threshold = max(0.5, float(p[order][good[-1]])) if len(good) else 2.0
    if natural is not None and natural.any():
        most = np.sort(p[natural])[::-1][int(NATURAL * natural.sum())]
        threshold = max(threshold, float(np.nextafter(most, 2)))
    return trees._replace(threshold=threshold)


# --- training and redaction -------------------------------------------------------------------


def train(docs: DataFrame, max_docs: int = MAX_DOCS) -> list[Trees | None]:
    """One calibrated model per kind, or none where the sample cannot teach it."""
    total = docs.count()
    part = int(min(1.0, max_docs / max(total, 1)) * (1 << 20))
    share = F.pmod(F.xxhash64(F.lit(SEED), "doc_id", "text"), F.lit(1 << 20)) < part

    def propose(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for _, data, offsets in blocks(batch.column(0)):
                rows, labels = [], []
                for text in strings(data, offsets):
                    held = zlib.crc32(text[:1000].encode("utf-8", "replace"), len(text)) % 3 == 0
                    for x, kind, natural in examples(text):
                        rows.append(x.tobytes())
                        labels.append(kind + 1 | natural << 3 | held << 4)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(rows, pa.binary()), pa.array(labels, pa.int64())], names=["x", "y"]
                )

    def fit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = pa.Table.from_batches(list(batches))
        if not table.num_rows:
            return
        x = np.frombuffer(b"".join(table["x"].to_pylist()), np.float32).reshape(-1, FEATURES)
        marks = table["y"].to_numpy()
        natural = marks & 8 > 0
        for k, kind in enumerate(KINDS):
            y = ((marks & 7) == k + 1).astype(float)
            held = marks & 16 > 0
            if min(y[held].sum(), y[~held].sum()) < LEAST_ROWS:
                held = np.arange(len(x)) % 3 == 0  # too few documents to hold some out
            if min(y[held].sum(), y[~held].sum()) < LEAST_ROWS or y.all():
                continue
            trees = calibrated(boost(x[~held], y[~held]), x[held], y[held], natural[held])
            numbers = [*trees[:3], np.array(trees[3:])]
            yield pa.RecordBatch.from_arrays(
                [pa.array([kind]), pa.array([[n.astype(float).ravel().tolist() for n in numbers]])],
                names=["kind", "parts"],
            )

    fitted = (
        docs.filter(share)
        .select("text")
        .mapInArrow(propose, "x binary, y bigint")
        .orderBy(F.xxhash64("x"), "x", "y")
        .limit(MAX_CANDIDATES)
        .repartition(1)
        .sortWithinPartitions(F.xxhash64("x"), "x", "y")
        .mapInArrow(fit, "kind string, parts array<array<double>>")
        .collect()
    )
    models: dict[str, Trees] = {}
    for kind, (feature, cut, leaf, rest) in fitted:
        models[kind] = Trees(
            np.array(feature).reshape(TREES, -1).astype(np.int64),
            np.array(cut).reshape(TREES, -1),
            np.array(leaf).reshape(TREES, -1),
            *rest,
        )
    return [models.get(kind) for kind in KINDS]


def added_spans(text: str, base: list[list[Span]], models: list[Trees | None]) -> list[list[Span]]:
    """Spans that the models add, per kind."""
    added: list[list[Span]] = [[] for _ in KINDS]
    taken = Taken([span for spans in base for span in spans])
    proposed = [c for c in candidates(text) if not taken.overlaps(c[1], c[2])]
    if proposed and any(models):
        x = np.stack([describe(text, *c) for c in proposed])
        offers = []
        for k, model in enumerate(models):
            if model is not None:
                p = model.probability(x)
                offers += [(-p[i], *proposed[i][1:], k) for i in np.flatnonzero(p >= model.threshold)]
        for _, start, end, k in sorted(offers):
            if not taken.overlaps(start, end):
                taken.add(start, end)
                added[k].append((start, end))
    return added


def found_spans(texts: pa.Array, models: list[Trees | None]) -> Iterator[tuple[str, list, list]]:
    """(text, base spans, added spans) of every row."""
    for _, data, offsets in blocks(texts):
        for text in strings(data, offsets):
            base = base_spans(text)
            yield text, base, added_spans(text, base, models)


def joined(spans: list[list[Span]]) -> str:
    return ",".join(
        f"{kind}:{start}:{end}"
        for kind, own in zip(KINDS, spans, strict=True)
        for start, end in sorted(own)
    )


def private_spans(text: Column, models: list[Trees | None]) -> Column:
    """Counts of the base kinds, digest of the base spans, and all spans, as a struct."""

    @F.arrow_udf(RESULT)
    def spans(texts: pa.Array) -> pa.Array:
        rows = []
        for _, base, added in found_spans(texts, models):
            both = [a + b for a, b in zip(base, added, strict=True)]
            digest = hashlib.sha256(joined(base).encode()).hexdigest()
            rows.append((*map(len, base), digest, joined(both)))
        names = [*(f"n_{kind}" for kind in KINDS), "base_sha256", "spans"]
        types = [pa.int64()] * len(KINDS) + [pa.string()] * 2
        columns = zip(*rows, strict=True) if rows else [[]] * len(names)
        return pa.StructArray.from_arrays(
            [pa.array(c, t) for c, t in zip(columns, types, strict=True)], names=names
        )

    return spans(text)


def redacted(text: Column, models: list[Trees | None]) -> Column:
    """The text with every span replaced by its kind in brackets; overlaps become one; null stays."""

    @F.arrow_udf("string")
    def redact(texts: pa.Array) -> pa.Array:
        rows = []
        for whole, base, added in found_spans(texts, models):
            spans = sorted(
                (start, end, kind)
                for kind, a, b in zip(KINDS, base, added, strict=True)
                for start, end in a + b
            )
            parts, done = [], 0
            for start, end, kind in spans:
                if start >= done:
                    parts += [whole[done:start], f"[{kind.upper()}]"]
                done = max(done, end)
            rows.append("".join([*parts, whole[done:]]) if spans else whole)
        return pc.if_else(texts.is_null(), None, pa.array(rows, pa.string()))

    return redact(text)
