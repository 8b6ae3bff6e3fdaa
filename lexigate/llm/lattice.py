"""Document likelihood under a unigram model over subwords, summed over all segmentations.

The vocabulary is an existing tokenizer's file (``vocabulary``, a parameter). Its scores rank the
pieces, and a piece of rank r has probability proportional to 1 / (r + 2.7), pieces for single bytes
ranking last. A word is spelled by every segmentation into pieces, with bytes standing in for
characters that the vocabulary lacks; a forward recursion adds them up. Pieces never cross words, so a
text's log probability is the sum over its words plus the end symbol's, and each distinct word is
worked out once.

With ``fitted`` the training rows teach it. Each distinct training token is spelled by the ranks'
probabilities, and the pieces' expected numbers of uses, by a forward and a backward recursion over all
of them, plus ``PRIOR`` uses a piece dealt by rank, are the new probabilities. Every training token is
then a piece of its own besides: with c its count, N that of all, T one more than the distinct ones and q
its spelled probability, a token has probability (c + T * q) / (N + T). Without training rows c and N are 0
and the ranks' probabilities stay.

From the corpus come the tokens with their counts. A token is told by a 64-bit hash of its bytes.
Tokens that make up at least one in ``HEAD`` of all tokens (so at most ``HEAD`` of them) go to every
task; a document's other tokens are joined with the counts by shuffle. So the frequent tokens, which
nearly every document holds, never meet in one task, and the rare ones are few per key.

Cases: null and empty texts are the end token alone; a null doc_id is a training row; a doc_id
that repeats gives a row each; without training rows every count is 0; an empty table gives no rows;
other columns are not read.
"""

from __future__ import annotations

import copy
import math
from collections.abc import Iterable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lexigate.llm.words import LOWER, NOT_SPACE, Words, blocks, hashed_words
from lexigate.scratch import new_path

VOCABULARY = "/opt/tokenizers/piece_bpe_32k.model"
HEAD = 1 << 20
RANK_SHIFT = 2.7
SPACE = "▁"
HELD_OUT, FOLDS = 2, 7
PRIOR = 0.1
SHORT, LEAST, NO_SHARE = 40, 1e-280, 1e-12  # letters and probability that doubles hold; a share left out
_UNIT = 1 << 24  # uses are added up in whole numbers of this fraction, in any order alike
_KEPT = 1 << 20  # distinct tokens that a task holds before it passes them on


class Lattice:
    """Log10 probabilities of words from a vocabulary file's pieces."""

    def __init__(self, vocabulary: str):
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=vocabulary)
        pieces, single = {}, []
        for i in range(model.get_piece_size()):
            if model.is_byte(i):
                single.append(int(model.id_to_piece(i)[3:5], 16))
            elif not (model.is_control(i) or model.is_unknown(i) or model.is_unused(i)):
                if model.get_score(i) > -1e6:  # pieces that are only ever typed by users have none
                    pieces[model.id_to_piece(i)] = 1 - model.get_score(i)
        last = max(pieces.values(), default=0)
        weights = {piece: 1 / (rank + RANK_SHIFT) for piece, rank in pieces.items()}
        byte = {b: 1 / (last + k + RANK_SHIFT) for k, b in enumerate(sorted(single), 1)}
        end = 1 / (1 + RANK_SHIFT)
        total = sum(weights.values()) + sum(byte.values()) + end
        least = 1 / (last + 256 + RANK_SHIFT)
        self._set([w / total for w in weights.values()], [byte.get(b, least) / total for b in range(256)], weights)
        self.end = math.log10(end / total)
        self.longest = max(map(len, self.pieces), default=1)

    def _set(self, pieces: Iterable[float], single: Iterable[float], names: Iterable[str]) -> None:
        self.chance, self.byte_chance = dict(zip(names, pieces, strict=True)), list(single)
        self.pieces = {piece: math.log(p) for piece, p in self.chance.items()}
        self.bytes = [math.log(p) for p in self.byte_chance]
        # of every beginning of a piece, 0 where it is none itself: a search ends where there is no entry
        self.beginnings = {piece[:k]: 0.0 for piece in self.chance for k in range(1, len(piece))} | self.chance
        self.letters: dict[str, float] = {}

    def taught(self, uses: np.ndarray) -> Lattice:
        """The same pieces by their expected uses: of the pieces in order, then of the 256 bytes."""
        ranked = np.array([*self.chance.values(), *self.byte_chance])
        weights = uses + PRIOR * len(ranked) * ranked / ranked.sum()
        weights *= (1 - 10**self.end) / weights.sum()
        found, many = copy.copy(self), len(self.chance)
        found._set(weights[:many].tolist(), weights[many:].tolist(), self.chance)
        return found

    def _spelled(self, letter: str) -> float:
        if (chance := self.letters.get(letter)) is None:
            chance = math.prod(self.byte_chance[b] for b in letter.encode("utf-8", "replace"))
            self.letters[letter] = chance
        return chance

    def word(self, word: str) -> float:
        """Log10 of the summed probability of all segmentations of a word after a space."""
        text = SPACE + word
        if len(text) <= SHORT and (found := self._forward(text)[-1]) > LEAST:
            return math.log10(found)
        return self._log_forward(text)[-1] / math.log(10)

    def _forward(self, text: str) -> list[float]:
        """Summed probabilities of all ways to each place."""
        find, letters, size = self.beginnings.get, self.letters, len(text)
        forward = [1.0, *[0.0] * size]
        for start in range(size):
            here, letter = forward[start], text[start]
            if (spelled := letters.get(letter)) is None:
                spelled = self._spelled(letter)
            forward[start + 1] += here * spelled
            for stop in range(start + 1, size + 1):
                if (chance := find(text[start:stop])) is None:
                    break
                if chance:
                    forward[stop] += here * chance
        return forward

    def _log_forward(self, text: str) -> list[float]:
        """The same in logarithms, for texts that a double cannot hold."""
        find = self.pieces.get
        forward = [0.0]
        for stop in range(1, len(text) + 1):
            ways = [
                forward[start] + score
                for start in range(max(0, stop - self.longest), stop)
                if (score := find(text[start:stop])) is not None
            ]
            letter = text[stop - 1].encode("utf-8", "replace")
            ways.append(forward[-1] + sum(self.bytes[b] for b in letter))
            top = max(ways)
            forward.append(
                top if len(ways) == 1 else top + math.log(sum(math.exp(w - top) for w in ways))
            )
        return forward

    def add_uses(self, word: str, uses: dict[str, float], spelled: dict[str, float]) -> None:
        """Add the expected numbers of pieces and of letters taken by their bytes that a segmentation of
        the word has."""
        text = SPACE + word
        if len(text) <= SHORT and (forward := self._forward(text))[-1] > LEAST:
            self._add_short(text, forward, uses, spelled)
            return
        forward, find = self._log_forward(text), self.pieces.get
        reached = [0.0] * len(text) + [1.0]  # the share of segmentations that cut at a place
        for stop in range(len(text), 0, -1):
            share, here = reached[stop], forward[stop]
            left = share
            for start in range(max(0, stop - self.longest), stop):
                piece = text[start:stop]
                if (score := find(piece)) is not None:
                    use = share * math.exp(forward[start] + score - here)
                    reached[start] += use
                    uses[piece] = uses.get(piece, 0.0) + use
                    left -= use
            if left > NO_SHARE:  # the rest of them take the last letter by its bytes
                reached[stop - 1] += left
                letter = text[stop - 1]
                spelled[letter] = spelled.get(letter, 0.0) + left

    def _add_short(self, text: str, forward: list[float], uses: dict[str, float], spelled: dict[str, float]) -> None:
        find, size = self.beginnings.get, len(text)
        backward = [*[0.0] * size, 1 / forward[size]]
        for start in range(size - 1, -1, -1):
            here, letter = forward[start], text[start]
            total = self.letters[letter] * backward[start + 1]
            spelled[letter] = spelled.get(letter, 0.0) + here * total
            for stop in range(start + 1, size + 1):
                piece = text[start:stop]
                if (chance := find(piece)) is None:
                    break
                if chance:
                    way = chance * backward[stop]
                    total += way
                    uses[piece] = uses.get(piece, 0.0) + here * way
            backward[start] = total


@lru_cache(maxsize=2)
def lattice(vocabulary: str) -> Lattice:
    return Lattice(vocabulary)


def is_training(doc_id: Column) -> Column:
    return ~(F.coalesce(F.crc32(doc_id.cast("string")) % FOLDS, F.lit(-1)) == HELD_OUT)


def _tokens(data: np.ndarray, words: Words, at: np.ndarray) -> pa.Array:
    """The lower-cased bytes of the words at the positions ``at``."""
    start, length = words.start[at], (words.end - words.start)[at]
    offsets = np.zeros(len(at) + 1, dtype=np.int64)
    np.cumsum(length, out=offsets[1:])
    where = np.arange(offsets[-1]) + np.repeat(start - offsets[:-1], length)
    raw = LOWER[data[where]]
    return pa.LargeBinaryArray.from_buffers(
        pa.large_binary(), len(at), [None, pa.py_buffer(offsets), pa.py_buffer(raw)]
    )


def token_counts(docs: DataFrame) -> DataFrame:
    """``token, word, n, n_train`` over all documents."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []

        def merged() -> pa.RecordBatch:
            token, at, inverse = np.unique(
                np.concatenate([h[0] for h in held]), return_index=True, return_inverse=True
            )
            sums = [
                np.bincount(inverse, weights=np.concatenate([h[k] for h in held])).astype(np.int64)
                for k in (2, 3)
            ]
            words = pa.concat_arrays([h[1] for h in held]).take(pa.array(at))
            columns = [pa.array(token.view(np.int64)), words, *map(pa.array, sums)]
            held.clear()
            held.append((token, words, *sums))
            return pa.RecordBatch.from_arrays(columns, names=["token", "word", "n", "n_train"])

        entries = 0
        for batch in batches:
            train = batch.column("train").to_numpy(zero_copy_only=False).astype(float)
            for row, data, offsets in blocks(batch.column("text")):
                words = hashed_words(data, offsets, NOT_SPACE, lower=True)
                if not len(words.hash):
                    continue
                token, at, inverse = np.unique(words.hash, return_index=True, return_inverse=True)
                learnt = np.bincount(inverse, weights=train[row + words.doc])
                held.append((token, _tokens(data, words, at), np.bincount(inverse), learnt))
                entries += len(token)
                if entries >= 2 * _KEPT:
                    done = merged()
                    entries = done.num_rows
                    if entries >= _KEPT:
                        yield from _sliced(done)
                        held.clear()
                        entries = 0
        if held:
            yield from _sliced(merged())

    counted = docs.select(is_training(F.col("doc_id")).alias("train"), "text").mapInArrow(
        count, "token bigint, word binary, n bigint, n_train bigint"
    )
    return counted.groupBy("token").agg(
        F.first("word").alias("word"), F.sum("n").alias("n"), F.sum("n_train").alias("n_train")
    )


def _sliced(batch: pa.RecordBatch, rows: int = 50_000) -> Iterator[pa.RecordBatch]:
    columns = [c.cast(pa.binary()) if pa.types.is_large_binary(c.type) else c for c in batch.columns]
    for lo in range(0, batch.num_rows, rows):
        yield pa.RecordBatch.from_arrays([c.slice(lo, rows) for c in columns], batch.schema.names)


def vocabulary_scores(
    counts: DataFrame, vocabulary: str, uses: np.ndarray | None = None, kinds: int = 0
) -> DataFrame:
    """``token, n, n_train, weight``: counts with a token's log10 probability. Given the ``uses`` of
    pieces, that of a token whose count it is not yet divided by: log10(c + kinds * q)."""

    def weigh(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = lattice(vocabulary)
        if uses is not None:
            model = model.taught(uses)
        for batch in batches:
            words = (w.decode("utf-8", "replace") for w in batch.column("word").to_pylist())
            weights = np.array([model.word(w) for w in words], dtype=np.float64)
            if uses is not None:
                weights = _with_count(batch.column("n_train").to_numpy(), kinds, weights)
            columns = [batch.column(name) for name in ("token", "n", "n_train")]
            yield pa.RecordBatch.from_arrays(
                [*columns, pa.array(weights, pa.float64())],
                names=["token", "n", "n_train", "weight"],
            )

    return counts.mapInArrow(weigh, "token bigint, n bigint, n_train bigint, weight double")


def _with_count(count: np.ndarray, kinds: int, spelled: np.ndarray) -> np.ndarray:
    """log10(count + kinds * 10**spelled), where the latter may be too small for a double."""
    with np.errstate(divide="ignore"):
        counted = np.log(np.asarray(count, dtype=np.float64))
    return np.logaddexp(counted, math.log(kinds) + np.asarray(spelled) * math.log(10)) / math.log(10)


def expected_uses(counts: DataFrame, vocabulary: str) -> np.ndarray:
    """How often the distinct training tokens use each piece, in the vocabulary's order, and each byte."""

    def expect(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = lattice(vocabulary)
        place = {piece: k for k, piece in enumerate(model.chance)}
        uses: dict[str, float] = {}
        letters: dict[str, float] = {}
        for batch in batches:
            for word in batch.column("word").to_pylist():
                model.add_uses(word.decode("utf-8", "replace"), uses, letters)
        found = {place[piece]: use for piece, use in uses.items()}
        for letter, use in letters.items():
            for b in letter.encode("utf-8", "replace"):
                found[len(place) + b] = found.get(len(place) + b, 0.0) + use
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(list(found), pa.int32()),
                pa.array([round(use * _UNIT) for use in found.values()], pa.int64()),
            ],
            names=["piece", "uses"],
        )

    told = counts.filter("n_train > 0").select("word").mapInArrow(expect, "piece int, uses bigint")
    model = lattice(vocabulary)
    total = np.zeros(len(model.chance) + 256)
    # at most a row per piece of the vocabulary
    for row in told.groupBy("piece").agg(F.sum("uses").alias("uses")).collect():
        total[row["piece"]] = row["uses"] / _UNIT
    return total


DOCUMENT = (
    "doc_id bigint, n_words bigint, known bigint, base double, weight double,"
    " rare array<struct<token: bigint, n: bigint>>"
)


def likelihoods(
    docs: DataFrame, vocabulary: str = VOCABULARY, head: int = HEAD, fitted: bool = False
) -> DataFrame:
    """``doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score`` per document; ``score``
    is that of the vocabulary's ranks, or with ``fitted`` of the model that the training rows teach."""
    spark = docs.sparkSession
    path = new_path(spark, "tokens")
    counts = token_counts(docs)
    if fitted:
        counts.write.parquet(path)
        counts = spark.read.parquet(path)
    else:
        vocabulary_scores(counts, vocabulary).write.parquet(path)
    known = spark.read.parquet(path)
    ends = docs.filter(is_training(F.col("doc_id"))).count()
    total, learnt, distinct = known.agg(
        F.sum("n"), F.sum("n_train"), F.count(F.when(F.col("n_train") > 0, 1))
    ).first()
    train_tokens = (learnt or 0) + ends
    kinds = distinct + (ends > 0) + 1
    divisor = math.log10(train_tokens + kinds)
    end, score_divisor = lattice(vocabulary).end, 0.0
    if fitted:
        path = new_path(spark, "weighed-tokens")
        uses = expected_uses(counts, vocabulary)
        vocabulary_scores(counts, vocabulary, uses, kinds).write.parquet(path)
        known = spark.read.parquet(path)
        end, score_divisor = float(_with_count(ends, kinds, end)), divisor

    # at most `head` tokens can each make up one in `head`
    frequent = known.filter(F.col("n") * head >= (total or 0)).orderBy("token").toPandas()
    tokens = frequent["token"].to_numpy(dtype=np.int64).view(np.uint64)
    order = np.argsort(tokens)
    tokens = tokens[order]
    trained = frequent["n_train"].to_numpy(dtype=np.int64)[order]
    weights = frequent["weight"].to_numpy(dtype=np.float64)[order]

    def look_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        base = np.log10(trained + 1.0)
        for batch in batches:
            for row, data, offsets in blocks(batch.column("text")):
                rows = len(offsets) - 1
                words = hashed_words(data, offsets, NOT_SPACE, lower=True)
                at = np.minimum(np.searchsorted(tokens, words.hash), max(len(tokens) - 1, 0))
                hit = tokens[at] == words.hash if len(tokens) else np.zeros(len(at), dtype=bool)
                doc, at = words.doc[hit], at[hit]
                sums = [
                    np.bincount(doc, weights=values[at], minlength=rows)
                    for values in (trained > 0, base, weights)
                ]
                doc, token = words.doc[~hit], words.hash[~hit]
                by = np.lexsort((token, doc))
                doc, token = doc[by], token[by]
                opens = np.flatnonzero(
                    np.concatenate([[True], (doc[1:] != doc[:-1]) | (token[1:] != token[:-1])])[: len(doc)]
                )
                times = np.diff(np.append(opens, len(doc)))
                rare = pa.StructArray.from_arrays(
                    [pa.array(token[opens].view(np.int64)), pa.array(times, pa.int64())],
                    names=["token", "n"],
                )
                edges = np.searchsorted(doc[opens], np.arange(rows + 1)).astype(np.int32)
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("doc_id").slice(row, rows).cast(pa.int64()),
                        pa.array(np.bincount(words.doc, minlength=rows), pa.int64()),
                        pa.array(sums[0].astype(np.int64)),
                        # (numpy counts nothing in whole numbers)
                        pa.array(sums[1].astype(float)),
                        pa.array(sums[2].astype(float)),
                        pa.ListArray.from_arrays(pa.array(edges), rare),
                    ],
                    names=["doc_id", "n_words", "known", "base", "weight", "rare"],
                )

    path = new_path(spark, "document-tokens")
    docs.select("doc_id", "text").mapInArrow(look_up, DOCUMENT).withColumn(
        "row_key", F.monotonically_increasing_id()
    ).write.parquet(path)
    looked_up = spark.read.parquet(path)
    rest = (
        looked_up.select("row_key", F.inline("rare").alias("token", "times"))
        .join(known.filter(F.col("n") * head < (total or 0)).drop("n"), "token")
        .groupBy("row_key")
        .agg(
            F.sum(F.when(F.col("n_train") > 0, F.col("times")).otherwise(0)).alias("rare_known"),
            F.sum(F.col("times") * F.log10(F.col("n_train") + 1.0)).alias("rare_base"),
            F.sum(F.col("times") * F.col("weight")).alias("rare_weight"),
        )
    )

    def plus(name: str, constant: float) -> Column:
        return F.col(name) + F.coalesce(f"rare_{name}", F.lit(0)) + F.lit(constant)

    n_tokens = F.col("n_words") + 1
    return looked_up.join(rest, "row_key", "left").select(
        "doc_id",
        (~is_training(F.col("doc_id"))).alias("held_out"),
        n_tokens.alias("n_tokens"),
        plus("known", int(ends > 0)).cast("long").alias("n_known"),
        F.lit(train_tokens).cast("long").alias("train_tokens"),
        (plus("base", math.log10(ends + 1)) - n_tokens * divisor).alias("base_score"),
        (plus("weight", end) - n_tokens * score_divisor).alias("score"),
    )
