"""Every stage of the pipeline against a plain version, on its predecessor's rows."""

from __future__ import annotations

from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F
from test_operators import (
    bench_words,
    plain_classes,
    plain_fingerprint,
    plain_private,
    words,
)

import corpus_pipeline
from lexigate.llm import pii, quality

TABLES = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    """The smallest tables, with nulls, an empty text, repeats and clashing columns added."""
    path = tmp_path_factory.mktemp("tables")
    docs = spark.read.parquet(f"{TABLES}/documents.parquet")
    odd = spark.createDataFrame(
        [
            (900001, None, "en", "web", None),
            (900002, "", None, None, 0),
            (900002, "", None, None, 0),
            (None, "an id is missing here, call +49 30 1234 5678", "en", None, 44),
            (900003, "mail bob@example.org from 10.0.0.1", "en", "web", 34),
        ],
        docs.schema,
    )
    clashing = {name: F.lit(1) for name in ("row", "size", "taken", "text_key", "fingerprint")}
    docs.unionByName(odd).withColumns(clashing).write.parquet(str(path / "documents.parquet"))
    for name in ("labels", "benchmark"):
        spark.read.parquet(f"{TABLES}/{name}.parquet").write.parquet(str(path / f"{name}.parquet"))
    return str(path)


@pytest.fixture(scope="module")
def steps(spark, folder, tmp_path_factory):
    """What every stage read and wrote; the first entry is the table itself."""
    path = tmp_path_factory.mktemp("stages")
    frames = [spark.read.parquet(f"{folder}/documents.parquet")]
    for place, (_, stage) in enumerate(corpus_pipeline.STAGES):
        stage(spark, frames[-1], folder).write.parquet(str(path / str(place)))
        frames.append(spark.read.parquet(str(path / str(place))))
    return frames


def rows(frame, *columns):
    return Counter(tuple(r[c] for c in columns) for r in frame.collect())


def test_all_but_the_last_keep_the_columns(steps):
    for frame in steps[1:-1]:
        assert frame.dtypes == steps[0].dtypes
    assert steps[-1].columns == [
        *steps[0].columns, "mix_size", "source_size", "target", "mix_taken",
    ]


def test_rejected_documents_go(spark, folder, steps):
    model = quality.train(steps[0], spark.read.parquet(f"{folder}/labels.parquet"))
    expected = Counter()
    for r in steps[0].collect():
        data = np.frombuffer((r.text or "").encode(), dtype=np.uint8)
        score = float(model.score(data, np.array([0, len(data)]))[0])
        expected[r.doc_id, r.text] += score >= 0.3
    assert rows(steps[1], "doc_id", "text") == +expected
    assert 0 < steps[1].count() < steps[0].count()


def test_one_of_each_group_stays(steps):
    found = sorted(
        ((r.doc_id is None, r.doc_id or 0, r.text) for r in steps[1].collect()), key=repr
    )
    found.sort(key=lambda r: r[:2])
    label = plain_classes([plain_fingerprint(text) for *_, text in found])
    first = {own: r[:2] for own, r in reversed(list(zip(label, found, strict=True)))}
    expected = Counter(None if missing else number for missing, number in first.values())
    assert Counter(r.doc_id for r in steps[2].collect()) == expected
    assert steps[2].count() < steps[1].count()


def test_benchmark_passages_go(spark, folder, steps):
    windows: dict[int, set] = {}
    for r in spark.read.parquet(f"{folder}/benchmark.parquet").collect():
        w = bench_words(r.text)
        n = min(10, len(w))
        for i in range(len(w) - n + 1 if w else 0):
            windows.setdefault(n, set()).add(tuple(w[i : i + n]))

    def clean(text):
        w = bench_words(text)
        return not any(
            tuple(w[i : i + n]) in some for n, some in windows.items() for i in range(len(w) - n + 1)
        )

    expected = Counter((r.doc_id, r.text) for r in steps[2].collect() if clean(r.text))
    assert rows(steps[3], "doc_id", "text") == expected
    assert steps[3].count() < steps[2].count()


def test_personal_data_is_replaced(steps):
    models = pii.train(steps[3])
    expected, changed = Counter(), 0
    for r in steps[3].collect():
        text = r.text
        if text is not None:
            base = plain_private(text)
            added = pii.added_spans(text, base, models)
            spans = sorted(
                (a, b, kind)
                for kind, x, y in zip(pii.KINDS, base, added, strict=True)
                for a, b in x + y
            )
            cover, at = [], 0
            for a, b, kind in spans:
                if a >= at:
                    cover.append((a, b, kind))
                else:
                    cover[-1] = (cover[-1][0], max(cover[-1][1], b), cover[-1][2])
                at = max(at, b)
            for a, b, kind in reversed(cover):
                text = f"{text[:a]}[{kind.upper()}]{text[b:]}"
            changed += bool(spans)
        expected[r.doc_id, text, r.n_chars if text is None else len(text)] += 1
    assert rows(steps[4], "doc_id", "text", "n_chars") == expected
    assert changed
    assert not any(any(plain_private(r.text or "")) for r in steps[4].collect())


def test_mix_meets_the_targets(steps):
    sizes = Counter()
    for r in steps[4].collect():
        sizes[r.source] += len(words(r.text))
    names = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: (5, 2, 1)[i % 3] for i, s in enumerate(names)}
    targets, left, free = {}, 1.5 * sum(sizes.values()), set(names)
    while free:
        level = left / sum(weight[s] for s in free)
        over = {s for s in free if level * weight[s] > 2 * sizes[s]}
        targets |= {s: min(level * weight[s], 2.0 * sizes[s]) for s in over or free}
        left -= sum(2.0 * sizes[s] for s in over)
        free = free - over if over else set()
    taken = Counter()
    for r in steps[5].collect():
        assert r.mix_size == len(words(r.text)) and 0 < r.mix_taken <= 2 * r.mix_size
        assert r.target == pytest.approx(targets[r.source])
        taken[r.source] += r.mix_taken
    assert taken == +Counter({s: round(t) for s, t in targets.items()})
    assert not rows(steps[5], "doc_id", "text") - rows(steps[4], "doc_id", "text")


def test_run_chains_the_stages(spark, folder, steps):
    columns = ("doc_id", "text", "target", "mix_taken")
    assert rows(corpus_pipeline.run(spark, folder), *columns) == rows(steps[5], *columns)
