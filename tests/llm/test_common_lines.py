"""Passages around a line that more texts share than a suffix has neighbours."""

from __future__ import annotations

import random

from test_operators import collected, plain_passages

from lexigate.llm import suffixes


def test_passages_around_a_common_line_match_plain_version(spark):
    rng = random.Random(21)

    def fresh(n: int) -> list[str]:
        return [f"w{rng.randrange(10**6)}" for _ in range(n)]

    line, texts = fresh(45), []
    for pair in range(20):
        before, after = fresh(10), fresh(10)
        for _ in range(2):
            # ten words before the line, or after it, that only two texts share
            texts.append(fresh(30) + (before + line if pair % 2 else line + after) + fresh(30))
    texts += [fresh(30) + line + fresh(30) for _ in range(300)]
    chorus = fresh(3) * 30
    texts += [fresh(k) + chorus[k:] + fresh(5) for k in range(12)]
    rows = [(i, " ".join(t)) for i, t in enumerate(texts)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    expected = [
        (i, a, b)
        for (i, _), own in zip(rows, plain_passages([t for _, t in rows]), strict=True)
        for a, b in own
    ]
    found = collected(suffixes.repeated(docs), "doc_id", "start_word", "stop_word")
    assert sorted(found) == sorted(expected)
    assert len({i for i, *_ in expected}) >= 40
