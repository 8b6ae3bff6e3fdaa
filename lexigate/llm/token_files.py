"""Token ids in binary files, compressed by a Re-Pair grammar per shard.

Documents are sorted by id over ranges; every range is tokenised where it was sorted and cut into
shards of about ``SHARD_IDS`` ids, always between documents. A shard's ids are compressed by
replacing frequent pairs of symbols by new ones, again and again: each round counts all pairs, takes
the most frequent ones (at least ``LEAST`` places each), and replaces them where they stand, of
places that overlap every second one from the left. Rounds end when they shorten the shard by less
than ``GAIN``, or when symbols would no longer fit two bytes.

A shard holds its documents' ids and lengths, the rules, every rule's expansion length, and the
symbols left. Running sums of the expansion lengths tell which symbols cover a span of ids, so a
document is decoded without those before it (``Shard.ids``). Shards are written one after another
into files of at most about ``FILE_BYTES``; a manifest has a row per shard with its place, and the
number of ids before it follows from sums per range.

File names are new in every task attempt, and only those that a finished task reports are used, so
an attempt that was lost or doubled leaves an unused file at most. Files go to the shared folder by
its URI, through Arrow's file systems. The tokenizer's description, a few MB, is sent to the tasks.

Words are tokenised once per worker's cache of about twice ``CACHED`` words, for tokenizers that take
them one by one (``plain_words``, which is tried on a phrase); for others whole texts are encoded.

Cases: null and empty texts have the end id alone; a null doc_id sorts last and stays null; rows of
equal id are in the order of their texts' hash, then their place; a text of any length is one
document of one shard, held by the task that has its row; an empty table writes no file and gives no
rows; other columns are not read.
"""

from __future__ import annotations

import json
import os
import re
import struct
import uuid
import zlib
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyarrow import fs as pafs
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lexigate.scratch import new_path

END = 1
SHARD_IDS = 1 << 20
FILE_BYTES = 256 << 20
TEXT_BYTES = 1 << 23  # of text tokenised at once; a longer single text is taken alone
CACHED = 500_000
# letters that are one letter each when small, and a tail of punctuation
LATIN_WORD = re.compile("([A-Za-z\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u012f\u0131-\u024f]+)([.,;:!?]*)")
JOINED = 100
LEAST, PER_ROUND, GAIN = 8, 16_384, 0.03
SYMBOLS = 1 << 16  # that fit two bytes
MAGIC = b"LXREPAIR"
HEADER = struct.Struct("<8sHHIQQQQ")

MANIFEST = (
    "part bigint, place bigint, path string, offset bigint, length bigint, first bigint,"
    " n_ids bigint, n_docs bigint"
)
DOCUMENTS = "doc_id bigint, start bigint, n_tokens bigint, ids_crc32 bigint"


# --- tokens -----------------------------------------------------------------------------------


class Encoder:
    """Ids of whole texts; words that it has seen are looked up.

    ``plain_words``: the tokenizer drops white space, ignores case, and never joins across white
    space or letters with punctuation. Then a text's ids are those of its words, and a word of Latin
    letters and a tail of punctuation is looked up as the two, its letters small.
    """

    def __init__(self, description: str, plain_words: bool, cached: int = CACHED):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_str(description)
        self.plain_words, self.cached = plain_words, cached
        # what was looked up lately, and what was before that
        self.known: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}
        ends = json.loads(description)["model"].get("end_of_word_suffix")
        self.ends = np.zeros(1 + max(self.tokenizer.get_vocab().values(), default=0), dtype=bool)
        if ends:
            self.ends[[i for word, i in self.tokenizer.get_vocab(False).items() if word.endswith(ends)]] = True
        if plain_words:
            whole, *parts = self._encoded(["Say it.", "say", "it", "."])
            if whole != b"".join(parts):
                raise ValueError("this tokenizer tells case, white space or joined punctuation apart")

    def _encoded(self, texts: list[str]) -> list[bytes]:
        found = [e.ids for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]
        flat = np.fromiter(chain.from_iterable(found), dtype=np.uint32).tobytes()
        ends = np.cumsum([4 * len(ids) for ids in found]).tolist()
        return [flat[a:b] for a, b in zip([0, *ends], ends)]

    def _letters(self, words: list[str]) -> list[bytes]:
        """Ids of words that are letters alone; a hundred at once, cut where a word's last token is."""
        found: list[bytes] = []
        lines = [words[i : i + JOINED] for i in range(0, len(words), JOINED)]
        coded = self.tokenizer.encode_batch_fast([" ".join(line) for line in lines], add_special_tokens=False)
        for line, one in zip(lines, coded, strict=True):
            ids = np.array(one.ids, dtype=np.uint32)
            cuts = (4 * (np.flatnonzero(self.ends[ids]) + 1)).tolist()
            if len(cuts) != len(line) or cuts[-1] != ids.nbytes:
                found += self._encoded(line)
                continue
            raw = ids.tobytes()
            found += [raw[a:b] for a, b in zip([0, *cuts], cuts)]
        return found

    def _words(self, words: list[str]) -> list[bytes]:
        if len(self.known) > self.cached:
            self.known, self.older = {}, self.known
        known, older, shaped = self.known, self.older, LATIN_WORD.fullmatch
        known.update({w: older[w] for w in words if w in older and w not in known})
        asked, split = set(), []
        for w in words:
            if w not in known:
                found = shaped(w)
                low = found[1].lower() if found else w
                if low == w:
                    asked.add(w)
                else:
                    split.append((w, low, found[2]))
                    asked.add(low)
                    asked.add(found[2])
        fresh = [w for w in asked if w not in known]
        letters = [w for w in fresh if (found := shaped(w)) and not found[2]]
        known.update(zip(letters, self._letters(letters), strict=True))
        fresh = [w for w in fresh if w not in known]
        known.update(zip(fresh, self._encoded(fresh), strict=True))
        known.update({w: known[low] + known[tail] for w, low, tail in split})
        return [known[w] for w in words]

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all texts, each followed by the end id; number of ids of each)."""
        if self.plain_words:
            split = pc.ascii_split_whitespace(texts)
            edges = split.offsets.to_numpy()
            coded = split.flatten().dictionary_encode()
            parts = self._words(coded.dictionary.to_numpy(zero_copy_only=False).tolist())
            place = coded.indices.to_numpy()
            edges = edges - edges[0]
        else:
            parts = self._encoded(texts.to_pylist())
            place, edges = np.arange(len(parts)), np.arange(len(parts) + 1)
        flat = np.frombuffer(b"".join(parts), dtype=np.uint32)
        size = np.array([len(p) >> 2 for p in parts], dtype=np.int64)
        begin = np.cumsum(size) - size
        length = size[place]
        after = np.cumsum(length)
        total = np.concatenate([[0], after])[edges]
        shift = begin[place] - (after - length)
        ids = flat[np.arange(int(total[-1])) + np.repeat(shift, length)]
        return np.insert(ids, total[1:], END), np.diff(total) + 1


_ENCODERS: dict[tuple, Encoder] = {}


def _encoder(description: str, plain_words: bool) -> Encoder:
    """One per worker process and tokenizer: words known from earlier tasks stay known."""
    key = (zlib.crc32(description.encode()), len(description), plain_words)
    if key not in _ENCODERS:
        _ENCODERS.clear()
        _ENCODERS[key] = Encoder(description, plain_words)
    return _ENCODERS[key]


# --- grammar ----------------------------------------------------------------------------------


def frequent_pairs(code: np.ndarray, most: int) -> np.ndarray:
    """The most frequent codes, sorted; none that has fewer than ``LEAST`` places."""
    code = np.sort(code)
    edges = np.concatenate([[0], np.flatnonzero(code[1:] != code[:-1]) + 1, [len(code)]])
    count = np.diff(edges)
    good = np.flatnonzero(count >= LEAST)
    if len(good) > most:
        good = good[np.argsort(-count[good], kind="stable")[:most]]
    return np.sort(code[edges[good]])


def places_of(code: np.ndarray, pairs: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(places, number of the pair there, pairs): pairs that share a slot of the table are left out."""
    bits = np.uint64(64 - max(10, (8 * len(pairs)).bit_length()))
    spread = np.uint64(0x9E3779B97F4A7C15)
    slot = (pairs * spread) >> bits
    _, only = np.unique(slot, return_index=True)
    pairs, slot = pairs[np.sort(only)], slot[np.sort(only)]
    table = np.full(1 << (64 - int(bits)), -1, dtype=np.int32)
    table[slot] = np.arange(len(pairs))
    number = table[(code * spread) >> bits]
    at = np.flatnonzero(number >= 0)
    at = at[pairs[number[at]] == code[at]]
    # of places that overlap, every second one
    opens = np.flatnonzero(np.diff(at, prepend=-2) != 1)
    turn = np.arange(len(at)) - np.repeat(opens, np.diff([*opens, len(at)]))
    at = at[turn % 2 == 0]
    return at, number[at], pairs


def compress(ids: np.ndarray, base: int) -> tuple[np.ndarray, np.ndarray]:
    """(symbols, rules): symbol ``base + i`` stands for the two symbols of rule ``i``."""
    symbols, rules = ids.astype(np.uint32), np.zeros((0, 2), dtype=np.uint32)
    room = SYMBOLS if base < SYMBOLS else 1 << 32
    while len(symbols) > 1 and base + len(rules) < room:
        code = symbols[:-1].astype(np.uint64) << np.uint64(32) | symbols[1:]
        pairs = frequent_pairs(code, min(PER_ROUND, room - base - len(rules)))
        if not len(pairs):
            break
        at, number, pairs = places_of(code, pairs)
        used = np.bincount(number, minlength=len(pairs)) >= LEAST
        at, number = at[used[number]], number[used[number]]
        if not len(at):
            break
        symbols[at] = base + len(rules) + (np.cumsum(used) - 1)[number]
        kept = np.ones(len(symbols), dtype=bool)
        kept[at + 1] = False
        low = pairs[used] & np.uint64(0xFFFFFFFF)
        new = np.stack([pairs[used] >> np.uint64(32), low], axis=1)
        rules = np.concatenate([rules, new.astype(np.uint32)])
        before, symbols = len(symbols), symbols[kept]
        if before - len(symbols) < GAIN * before:
            break
    return symbols, rules


def expansion_lengths(rules: np.ndarray, base: int) -> np.ndarray:
    """A rule only names earlier ones."""
    lengths = np.ones(len(rules), dtype=np.int64)
    for i, (a, b) in enumerate(rules.tolist()):
        lengths[i] = sum(lengths[s - base] if s >= base else 1 for s in (a, b))
    return lengths


class Shard:
    """A shard as it is stored."""

    def __init__(self, doc_ids, missing, counts, base, rules, lengths, symbols):
        self.doc_ids, self.missing, self.counts = doc_ids, missing, counts
        self.base, self.rules, self.lengths, self.symbols = base, rules, lengths, symbols
        coded = symbols >= base
        size = np.ones(len(symbols), dtype=np.int64)
        size[coded] = lengths[symbols[coded].astype(np.int64) - base]
        self.after = np.cumsum(size)  # ids up to and with every symbol
        self.ends = np.cumsum(counts.astype(np.int64))

    @classmethod
    def of(cls, doc_ids: np.ndarray, missing: np.ndarray, counts: np.ndarray, ids: np.ndarray, base: int):
        base = max(base, int(ids.max(initial=0)) + 1)
        symbols, rules = compress(ids, base)
        return cls(doc_ids, missing, counts, base, rules, expansion_lengths(rules, base), symbols)

    def to_bytes(self) -> bytes:
        wide = 2 if self.base + len(self.rules) <= SYMBOLS else 4
        header = HEADER.pack(
            MAGIC, 1, wide, self.base, len(self.counts), int(self.ends[-1]), len(self.rules), len(self.symbols)
        )
        parts = (
            self.doc_ids.astype("<i8"),
            self.missing.astype("u1"),
            self.counts.astype("<u8"),
            self.rules.astype("<u4"),
            self.lengths.astype("<u4"),
            self.symbols.astype(f"<u{wide}"),
        )
        return header + b"".join(p.tobytes() for p in parts)

    @classmethod
    def from_bytes(cls, raw: bytes) -> Shard:
        magic, version, wide, base, docs, total, rules, symbols = HEADER.unpack_from(raw)
        if magic != MAGIC or version != 1:
            raise ValueError("these bytes are no shard of token ids")
        at, parts = HEADER.size, []
        for kind, count in (
            ("<i8", docs), ("u1", docs), ("<u8", docs), ("<u4", 2 * rules), ("<u4", rules), (f"<u{wide}", symbols),
        ):
            parts.append(np.frombuffer(raw, kind, count, at))
            at += parts[-1].nbytes
        doc_ids, missing, counts, pairs, lengths, held = parts
        found = cls(doc_ids, missing.astype(bool), counts, base, pairs.reshape(-1, 2), lengths.astype(np.int64), held)
        if at != len(raw) or (len(held) and found.after[-1] != total) or found.ends[-1] != total:
            raise ValueError("a shard of token ids is damaged")
        return found

    def ids(self, start: int, stop: int) -> np.ndarray:
        """The ids from ``start`` up to ``stop``, decoded from the symbols that cover them."""
        lo = int(np.searchsorted(self.after, start, side="right"))
        hi = int(np.searchsorted(self.after, stop, side="left")) + 1
        found = self.symbols[lo:hi].astype(np.uint32)
        while (coded := found >= self.base).any():
            pairs = self.rules[found[coded].astype(np.int64) - self.base]
            found = np.repeat(found, 1 + coded)
            first = (np.cumsum(1 + coded) - 2)[coded]
            found[first], found[first + 1] = pairs[:, 0], pairs[:, 1]
        skipped = start - (int(self.after[lo - 1]) if lo else 0)
        return found[skipped : skipped + stop - start]

    def document(self, place: int) -> np.ndarray:
        return self.ids(int(self.ends[place] - self.counts[place]), int(self.ends[place]))


# --- files ------------------------------------------------------------------------------------


def _slices(texts: pa.Array) -> Iterator[tuple[int, int]]:
    """Runs of rows of at most about ``TEXT_BYTES``."""
    after = np.cumsum(pc.binary_length(texts).to_numpy(zero_copy_only=False).astype(np.int64))
    row = 0
    while row < len(texts):
        done = int(after[row - 1]) if row else 0
        last = max(row + 1, int(np.searchsorted(after, done + TEXT_BYTES, side="right")))
        yield row, last
        row = last


def write_shards(
    docs: DataFrame, folder: str, description: str, plain_words: bool = True, shard_ids: int = SHARD_IDS
) -> DataFrame:
    """Write all ids in the order of ``doc_id``; a row per shard. Evaluate it once."""
    spark = docs.sparkSession
    base = 1 + max(
        (t["id"] for t in json.loads(description).get("added_tokens", ())), default=0
    )
    sent = spark.sparkContext.broadcast(description)

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = _encoder(sent.value, plain_words)
        held: list[tuple] = []
        out = path = None
        offset = place = first = waiting = 0

        def flush() -> pa.RecordBatch:
            nonlocal out, path, offset, place, first, waiting
            if out is None:
                path = f"{folder}/{uuid.uuid4().hex}.repair"
                system, name = pafs.FileSystem.from_uri(path)
                system.create_dir(name.rpartition("/")[0], recursive=True)
                out, offset = system.open_output_stream(name, compression=None), 0
            ids, missing, counts, tokens = (np.concatenate(c) for c in zip(*held, strict=True))
            raw = Shard.of(ids, missing, counts, tokens, base).to_bytes()
            out.write(raw)
            row = (part, place, path, offset, len(raw), first, len(tokens), len(ids))
            offset, place, first, waiting = offset + len(raw), place + 1, first + len(tokens), 0
            held.clear()
            if offset >= FILE_BYTES:
                out.close()
                out = None
            return pa.RecordBatch.from_arrays(
                [pa.array([v], f.type) for v, f in zip(row, _MANIFEST, strict=True)], schema=_MANIFEST
            )

        for batch in batches:
            if not batch.num_rows:
                continue
            part = batch.column("part")[0].as_py()
            texts = pc.fill_null(batch.column("text"), "")
            numbers = batch.column("doc_id")
            missing = numbers.is_null().to_numpy(zero_copy_only=False)
            numbers = numbers.fill_null(0).to_numpy()
            for lo, hi in _slices(texts):
                tokens, counts = encoder.encode(texts.slice(lo, hi - lo))
                held.append((numbers[lo:hi], missing[lo:hi], counts, tokens))
                waiting += len(tokens)
                if waiting >= shard_ids:
                    yield flush()
        if held:
            yield flush()
        if out is not None:
            out.close()

    order = (F.asc_nulls_last("doc_id"), F.col("text_key"), F.col("row_key"))
    return (
        docs.select(
            F.col("doc_id").cast("long"),
            "text",
            F.xxhash64("text").alias("text_key"),
            F.monotonically_increasing_id().alias("row_key"),
        )
        .repartitionByRange(*order)
        .sortWithinPartitions(*order)
        .select("doc_id", "text", F.spark_partition_id().cast("long").alias("part"))
        .mapInArrow(write, MANIFEST)
    )


_MANIFEST = pa.schema(
    [
        (name, pa.string() if kind == "string" else pa.int64())
        for name, kind in (part.split() for part in MANIFEST.split(", "))
    ]
)


def read_shard(path: str, offset: int, length: int) -> Shard:
    system, name = pafs.FileSystem.from_uri(path)
    with system.open_input_file(name) as file:
        file.seek(offset)
        return Shard.from_bytes(file.read(length))


def read_documents(manifest: DataFrame) -> DataFrame:
    """Every document of the shards: its id, first place among all ids, length and checksum."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                shard = read_shard(row["path"], row["offset"], row["length"])
                ids = shard.ids(0, int(shard.ends[-1])).astype("<u4")
                begin = shard.ends - shard.counts.astype(np.int64)
                raw = memoryview(ids.tobytes())
                sums = [
                    zlib.crc32(raw[4 * a : 4 * b])
                    for a, b in zip(begin.tolist(), shard.ends.tolist(), strict=True)
                ]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(shard.doc_ids, mask=shard.missing),
                        pa.array(begin + row["before"]),
                        pa.array(shard.counts.astype(np.int64)),
                        pa.array(sums, pa.int64()),
                    ],
                    names=["doc_id", "start", "n_tokens", "ids_crc32"],
                )

    # a row per range of documents
    earlier = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    ranges = manifest.groupBy("part").agg(F.sum("n_ids").alias("n"))
    ranges = ranges.select("part", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("ids_before"))
    shards = manifest.join(F.broadcast(ranges), "part").select(
        "path", "offset", "length", (F.col("first") + F.col("ids_before")).alias("before")
    )
    tasks = int(manifest.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return shards.repartition(tasks, "path", "offset").mapInArrow(read, DOCUMENTS)


def round_trip(docs: DataFrame, tokenizer: str, plain_words: bool = True, shard_ids: int = SHARD_IDS) -> DataFrame:
    """Write the ids of all documents to the shared folder and read them back."""
    spark = docs.sparkSession
    with open(tokenizer, encoding="utf-8") as file:
        description = file.read()
    folder, path = new_path(spark, "token-files"), new_path(spark, "token-manifest")
    write_shards(docs, folder, description, plain_words, shard_ids).write.parquet(path)
    return read_documents(spark.read.parquet(path))
