"""Secret scan with a trigram inverted index.

Every rule's pattern is turned into a Boolean trigram query: literal stretches of the pattern must
occur in a matching text, so their trigrams must too. Texts are indexed in segments (runs of rows
of about ``SEGMENT_BYTES``): one pass over the bytes gives, for each trigram that some query
names, the list of rows that hold it. Queries are answered by intersecting and joining these
lists, and only candidate rows are searched with the pattern. A rule without a mandatory trigram
scans every row. Segments never need each other, so nothing is shuffled and a lost task is redone
by itself.

Trigrams are compared with A-Z lower-cased; a candidate list may be too long, never too short.

Cases: null and empty texts have no spans; every row gives one row, so repeated rows repeat;
an empty table gives no rows; other columns are left as they are.
"""

from __future__ import annotations

import hashlib
import re
from re import _constants as sre
from re import _parser as sre_parser
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F

from lexigate.llm.words import LOWER, blocks

SEGMENT_BYTES = 4 << 20
STRINGS_AT_MOST = 64  # alternatives of one literal stretch before it is cut
RESULT = (
    "struct<n_assign: bigint, n_access: bigint, n_hex: bigint, base_sha256: string, spans: string>"
)


class Rule(NamedTuple):
    """``kind``, the pattern, and the least length of ``group`` (0: the whole match)."""

    kind: str
    pattern: str
    group: int = 0
    least: int = 1


# Base kinds first, in the order in which ties are listed.
BASE_RULES = (
    Rule(
        "assign",
        r"([Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]"
        r"|[Tt][Oo][Kk][Ee][Nn]|[Aa][Pp][Ii]_?[Kk][Ee][Yy])"
        r"[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)",
        2,
        8,
    ),
    Rule("access", r"AKIA[A-Z0-9]+", 0, 16),
    # a maximal run either has the length or is dropped, so the length can stand in the pattern
    Rule("hex", r"[0-9a-f]{32,}", 0, 32),
)
MORE_RULES = (
    Rule("private_key", r"-----BEGIN (?:[A-Z0-9]+ ){0,3}PRIVATE KEY-----"),
    Rule("bearer", r"eyJ[A-Za-z0-9_-]{8,}\.eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]+"),
    Rule("forge_token", r"gh[pousr]_[A-Za-z0-9]{36,}"),
    Rule("chat_token", r"xox[abprs]-[A-Za-z0-9-]{10,}"),
)
RULES = (*BASE_RULES, *MORE_RULES)

Clause = tuple[frozenset[str], ...]  # one of these sets must be there in full


def trigram_query(pattern: str) -> tuple[Clause, ...]:
    """Clauses that all hold in any text that the pattern matches; none: scan every text."""
    clauses: list[Clause] = []

    def flush(strings: set[str]) -> set[str]:
        sets = {frozenset(s[i : i + 3] for i in range(len(s) - 2)) for s in strings}
        if all(sets):
            clauses.append(tuple(s for s in sets if not any(t < s for t in sets)))
        return {""}

    def exact(items: list) -> set[str] | None:
        """All strings that the items match, if they are few."""
        found = {""}
        for op, value in items:
            if op is sre.LITERAL:
                more = {chr(value).lower() if value < 128 else chr(value)}
            elif op is sre.IN and all(o is sre.LITERAL for o, _ in value):
                more = {chr(v).lower() if v < 128 else chr(v) for _, v in value}
            elif op is sre.SUBPATTERN:
                more = exact(list(value[3]))
            elif op is sre.BRANCH:
                parts = [exact(list(part)) for part in value[1]]
                more = None if None in parts else set().union(*parts)
            elif op is sre.MAX_REPEAT and tuple(value[:2]) == (0, 1):
                more = exact(list(value[2]))
                more = more if more is None else more | {""}
            else:
                more = None
            if more is None or len(found) * len(more) > STRINGS_AT_MOST:
                return None
            found = {a + b for a in found for b in more}
        return found

    def walk(items: list) -> None:
        stretch = {""}
        for item in items:
            op, value = item
            more = exact([item])
            if more is not None and len(stretch) * len(more) <= STRINGS_AT_MOST:
                stretch = {a + b for a in stretch for b in more}
                continue
            stretch = flush(stretch)
            if more is not None:
                stretch = more
            elif op is sre.SUBPATTERN:
                walk(list(value[3]))
            elif op is sre.MAX_REPEAT and value[0] >= 1:
                walk(list(value[2]))
        flush(stretch)

    walk(list(sre_parser.parse(pattern)))
    return tuple(clauses)


class Index:
    """Postings of the trigrams that the rules' queries name, for one segment at a time."""

    def __init__(self, queries: list[tuple[Clause, ...]]):
        grams = sorted({g for q in queries for c in q for s in c for g in s})
        self.slots = {g: i for i, g in enumerate(grams, 1)}
        self.table = np.zeros(1 << 24, dtype=np.uint16)
        for gram, slot in self.slots.items():
            code = gram.encode("utf-8")[:3]  # a prefix in bytes is mandatory as well
            self.table[int.from_bytes(code, "big")] = slot

    def postings(self, data: np.ndarray, offsets: np.ndarray) -> dict[int, np.ndarray]:
        if len(data) < 3:
            return {}
        low = LOWER[data].astype(np.uint32)
        slot = self.table[(low[:-2] << 16) | (low[1:-1] << 8) | low[2:]]
        at = np.flatnonzero(slot)
        row = np.searchsorted(offsets, at, side="right") - 1
        whole = at + 3 <= offsets[row + 1]
        pairs = np.unique(slot[at[whole]].astype(np.int64) * len(offsets) + row[whole])
        slots, rows = np.divmod(pairs, len(offsets))
        cuts = np.flatnonzero(np.diff(slots)) + 1
        return {int(s[0]): r for s, r in zip(np.split(slots, cuts), np.split(rows, cuts)) if len(s)}

    def candidates(self, query: tuple[Clause, ...], found: dict, rows: int) -> np.ndarray:
        none = np.zeros(0, dtype=np.int64)
        left = np.arange(rows)
        for clause in query:
            either = none
            for grams in clause:
                both = left
                for gram in sorted(grams, key=lambda g: len(found.get(self.slots[g], none))):
                    both = np.intersect1d(both, found.get(self.slots[gram], none), True)
                either = np.union1d(either, both)
            left = either
        return left


def matches(rule: Rule, pattern: re.Pattern, text: str) -> list[tuple[int, int]]:
    return [
        m.span() for m in pattern.finditer(text) if m.end(rule.group) - m.start(rule.group) >= rule.least
    ]


def joined(spans: list[tuple[int, int, int, str]]) -> str:
    return ",".join(f"{kind}:{start}:{end}" for start, _, end, kind in sorted(spans))


def scan(texts: pa.Array, rules: tuple[Rule, ...] = RULES) -> list[list[tuple[int, int, int, str]]]:
    """Per text, ``(start, place of the rule, end, kind)`` in code points."""
    queries = [trigram_query(rule.pattern) for rule in rules]
    patterns = [re.compile(rule.pattern) for rule in rules]
    index = Index(queries)
    found: list[list[tuple[int, int, int, str]]] = []
    for _, data, offsets in blocks(texts, SEGMENT_BYTES):
        rows = len(offsets) - 1
        lists = index.postings(data, offsets)
        raw = data.tobytes()
        by_row: list[list] = [[] for _ in range(rows)]
        wanted: list[list[int]] = [[] for _ in range(rows)]
        for place, query in enumerate(queries):
            for row in index.candidates(query, lists, rows).tolist():
                wanted[row].append(place)
        for row, places in enumerate(wanted):
            if places and offsets[row + 1] > offsets[row]:
                text = raw[offsets[row] : offsets[row + 1]].decode("utf-8", "replace")
                for place in places:
                    by_row[row] += [
                        (start, place, end, rules[place].kind)
                        for start, end in matches(rules[place], patterns[place], text)
                    ]
        found += by_row
    return found


def secret_spans(text: Column) -> Column:
    """Counts of the base kinds, digest of the base spans, and all spans, as a struct."""

    @F.arrow_udf(RESULT)
    def spans(texts: pa.Array) -> pa.Array:
        rows = []
        for found in scan(texts):
            base = [s for s in found if s[1] < len(BASE_RULES)]
            rows.append(
                {
                    **{f"n_{r.kind}": sum(s[1] == i for s in base) for i, r in enumerate(BASE_RULES)},
                    "base_sha256": hashlib.sha256(joined(base).encode()).hexdigest(),
                    "spans": joined(found),
                }
            )
        kinds = [(f"n_{r.kind}", pa.int64()) for r in BASE_RULES]
        fields = [*kinds, ("base_sha256", pa.string()), ("spans", pa.string())]
        return pa.array(rows, type=pa.struct(fields))

    return spans(text)
