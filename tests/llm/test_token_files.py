"""Token files: exact round trips, random access, and the same ids as the tokenizer alone gives."""

from __future__ import annotations

import random
import zlib

import numpy as np
import pyarrow as pa
import pytest

from lexigate.llm import token_files as tf

public_tokenizers = pytest.importorskip("public_tokenizers")
PATH = public_tokenizers.path("word_bpe_49k.json")
BYTE_PATH = public_tokenizers.path("byte_bpe_50k.json")
SCHEMA = "doc_id bigint, text string, part int, place string, row_key double"
TEXTS = [
    None,
    "",
    " \t\n\x0b",
    "It's don't we'll X'S 42 naïve STRASSE straße ﬁne Σίσυφος ΟΔΟΣ",
    "a b c\x1cd\x85e ́x é J̌ İ",
    "<|endoftext|> a<|startoftext|>b <|endof text|>",
    "日本語 テキスト 🙂🙂 ‍ x",
    "spam " * 5000,
    "aaaa" * 3000,
    "end. (end) end, End!! ... İstanbul. İİ, ÉTÉ. Été, J̌. straße! ŉ. Ǆ, Σ. ǅ; ĳ: Ŀ? ..!",
]


def tokenizer(path=PATH):
    from tokenizers import Tokenizer

    return Tokenizer.from_file(path)


def plain(rows, path=PATH):
    """Rows are in the order of their ids."""
    own, at, found = tokenizer(path), 0, []
    for doc, text in rows:
        ids = own.encode(text or "", add_special_tokens=False).ids + [1]
        found.append((doc, at, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        at += len(ids)
    return found


def collected(frame):
    return [tuple(r) for r in frame.select("doc_id", "start", "n_tokens", "ids_crc32").collect()]


def prose(seed: int) -> str:
    rng = random.Random(seed)
    return " ".join(rng.choice(["alpha", "Beta,", "x9", "naïve", "ção."]) for _ in range(rng.randrange(300)))


@pytest.mark.parametrize("shard_ids", [1, 700, 1 << 20])
def test_files_hold_the_ids_in_order(spark, shard_ids):
    rows = [(3 * i - 7, text) for i, text in enumerate(TEXTS)]
    rows += [(100 + i, prose(i)) for i in range(200)]
    frame = spark.createDataFrame([(*r, 1, "x", 0.5) for r in random.Random(1).sample(rows, len(rows))], SCHEMA)
    out = collected(tf.round_trip(frame.repartition(6), PATH, shard_ids=shard_ids))
    assert sorted(out) == plain(sorted(rows, key=lambda r: r[0]))


def test_repeats_nulls_and_ties_are_kept(spark):
    rows = [(5, "b b"), (5, "b b"), (5, "a"), (None, "z"), (None, None), (1, "first")]
    frame = spark.createDataFrame([(*r, 1, "x", 0.5) for r in rows], SCHEMA).repartition(3)
    out = sorted(collected(tf.round_trip(frame, PATH)), key=lambda r: r[1])
    assert [r[0] for r in out] == [1, 5, 5, 5, None, None]
    assert [r[1] for r in out] == [sum(o[2] for o in out[:i]) for i in range(len(out))]
    expected = sorted((r[0], *p[2:]) for r, p in zip(rows, plain(rows)) if r[0] is not None)
    assert sorted((r[0], *r[2:]) for r in out if r[0] is not None) == expected


def test_empty_table_gives_no_rows(spark):
    assert collected(tf.round_trip(spark.createDataFrame([], SCHEMA), PATH)) == []


def test_tokenizers_that_keep_spaces_take_whole_texts(spark):
    rows = list(enumerate(TEXTS[1:]))
    frame = spark.createDataFrame([(*r, 1, "x", 0.5) for r in rows], SCHEMA)
    assert sorted(collected(tf.round_trip(frame, BYTE_PATH, plain_words=False))) == plain(rows, BYTE_PATH)


def test_very_long_text_is_one_document(spark):
    text = " ".join(prose(i) for i in range(6000))
    assert len(text) > 4_000_000
    frame = spark.createDataFrame([(2, text, 1, "x", 0.5), (1, "short", 1, "x", 0.5)], SCHEMA)
    assert sorted(collected(tf.round_trip(frame, PATH, shard_ids=1000))) == plain([(1, "short"), (2, text)])


def test_cache_of_words_may_be_small():
    with open(PATH, encoding="utf-8") as file:
        encoder = tf.Encoder(file.read(), True, cached=3)
    for text in TEXTS[1:]:
        ids, counts = encoder.encode(pa.array([text, "", text]))
        own = tokenizer().encode(text, add_special_tokens=False).ids + [1]
        assert ids.tolist() == own + [1] + own and counts.tolist() == [len(own), 1, len(own)]


def test_tokenizers_that_tell_case_apart_are_refused():
    with open(BYTE_PATH, encoding="utf-8") as file, pytest.raises(ValueError, match="apart"):
        tf.Encoder(file.read(), True)


@pytest.mark.parametrize("base", [50, 49_408, 70_000])
def test_grammar_is_lossless_and_shrinks_repeats(base):
    rng = np.random.default_rng(3)
    ids = np.concatenate(
        [np.tile([7, 8, 9, 10], 500), np.full(999, 4), rng.integers(0, 50, 4000), [], [49]]
    ).astype(np.uint32)
    counts = np.array([2000, 0, 999, 4000, 1])
    shard = tf.Shard.of(np.arange(5), np.zeros(5, bool), counts, ids, base)
    raw = shard.to_bytes()
    again = tf.Shard.from_bytes(raw)
    assert again.ids(0, len(ids)).tolist() == ids.tolist()
    assert len(shard.rules) and len(shard.symbols) < 0.7 * len(ids)
    assert shard.lengths.max() > 8  # rules of rules
    for rule, length in zip(shard.rules.tolist(), shard.lengths.tolist()):
        assert length == sum(1 if s < shard.base else shard.lengths[s - shard.base] for s in rule)
    at = 0
    for place, count in enumerate(counts.tolist()):
        assert again.document(place).tolist() == ids[at : at + count].tolist()
        at += count
    for _ in range(200):
        a, b = sorted(rng.integers(0, len(ids) + 1, 2).tolist())
        assert again.ids(a, b).tolist() == ids[a:b].tolist()


def test_random_access_reads_few_symbols():
    ids = np.random.default_rng(1).integers(0, 50, 100_000).astype(np.uint32)
    shard = tf.Shard.of(np.arange(1), np.zeros(1, bool), np.array([len(ids)]), ids, 50)
    lo, hi = (int(np.searchsorted(shard.after, x)) for x in (70_000, 70_100))
    assert hi - lo < 110 and shard.ids(70_000, 70_100).tolist() == ids[70_000:70_100].tolist()


def test_damaged_shards_are_noticed():
    ids = np.arange(40, dtype=np.uint32)
    raw = tf.Shard.of(np.arange(1), np.zeros(1, bool), np.array([40]), ids, 50).to_bytes()
    with pytest.raises(ValueError, match="no shard"):
        tf.Shard.from_bytes(b"x" + raw[1:])
    with pytest.raises(ValueError):
        tf.Shard.from_bytes(raw[:-2])
