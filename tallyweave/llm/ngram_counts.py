"""Exact counts of words, word pairs and triples over a whole corpus, sent to where its texts are read.

Texts are cut into words once and packed into chunks of whole documents, as
distinct words and places among them. Each chunk sends its distinct
keys, sorted by hash and cut by the hash's leading bits, to the buckets of the
count table; a bucket adds up what all chunks counted and answers each chunk
with the sums in the order of its keys. Both the number of buckets and of
chunks grow with the corpus, so that no task holds more than a bucket or a
chunk, and nothing is broadcast. A key that stands in every chunk adds one
entry a chunk, however often it occurs.

Beside the bits that name its bucket a word has 48 bits of hash, so that no two
words are likely to be taken for one; pairs, triples and words in a topic have
28: one in some five hundred keys that the corpus lacks is taken for another
that it has, at every size.
"""

from __future__ import annotations

import zlib
from collections import Counter, defaultdict
from collections.abc import Collection, Iterator, Sequence
from dataclasses import dataclass
from functools import cached_property

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import durable
from .texthash import mixed

#: UTF-8 bytes of text in a chunk (more only if one document has more), and for each bucket of the count table.
CHUNK_BYTES, BUCKET_BYTES = 5 << 19, 1 << 23
END = b"\n"
START = np.uint64(0x5851F42D4C957F2D)
ODD1, ODD2 = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F)
#: Characters that are cut into words at a time.
STRETCH_CHARS = 1 << 20
#: Compression level of what is kept while the counts are made.
DENSE = 1
#: Distinct words whose counts a task holds before it passes them on.
HELD_WORDS = 200_000
#: Bits of a key of each kind beside those that name its bucket.
WIDTHS = (48, 28, 28, 28)
#: Chunk number of a bucket's totals.
TOTALS = -2
ANSWERS = "chunk long, bucket int, data binary"


def tokens(text: str | None) -> list[bytes]:
    """Words between ASCII white space, A-Z lower-cased, and the end."""
    return [*(text or "").encode().lower().split(), END]


def token_stretches(text: bytes) -> Iterator[list[bytes]]:
    """`tokens` of an encoded text, some at a time."""
    at = 0
    while len(text) - at > STRETCH_CHARS:
        stop = at + STRETCH_CHARS
        while stop < len(text) and text[stop] not in b" \t\n\r\x0b\x0c":
            stop += 1
        yield text[at:stop].lower().split()
        at = stop
    yield [*text[at:].lower().split(), END]


def byte_hashes(words: Sequence[bytes]) -> np.ndarray:
    """64-bit hash of each (non-empty) word."""
    return hashes_of(*word_arrays(words))


def hashes_of(lengths: np.ndarray, data: np.ndarray) -> np.ndarray:
    """`byte_hashes` of words whose bytes stand one after the other."""
    lengths = lengths.astype(np.int64)
    starts = np.cumsum(lengths) - lengths
    position = (np.arange(len(data)) - np.repeat(starts, lengths)).astype(np.uint64)
    return mixed(np.add.reduceat(mixed(data + (position << np.uint64(8))), starts) + lengths.astype(np.uint64))


def pack(arrays: Sequence[np.ndarray], level: int = 1) -> bytes:
    """Arrays as one compressed blob; equal bytes of the numbers stand together."""
    parts = [np.array([len(a) for a in arrays], dtype=np.int64).tobytes()]
    parts += [np.ascontiguousarray(np.ascontiguousarray(a).view(np.uint8).reshape(-1, a.itemsize).T).tobytes() for a in arrays]
    raw = b"".join(parts)
    return len(raw).to_bytes(8, "little") + pa.Codec("zstd", compression_level=level).compress(raw, asbytes=True)


def unpack(blob: bytes, kinds: Sequence[type]) -> list[np.ndarray]:
    raw = pa.Codec("zstd").decompress(blob[8:], int.from_bytes(blob[:8], "little"), asbytes=True)
    lengths, at, out = np.frombuffer(raw, np.int64, len(kinds)), 8 * len(kinds), []
    for n, kind in zip(lengths.tolist(), kinds, strict=True):
        size = np.dtype(kind).itemsize
        planes = np.frombuffer(raw, np.uint8, n * size, at).reshape(size, n)
        out.append(np.ascontiguousarray(planes.T).view(kind).ravel())
        at += n * size
    return out


@dataclass
class Parsed:
    """Some texts as tokens: lengths and bytes of the distinct words, each token's place among them, and each text's tokens and CRC-32."""

    widths: np.ndarray
    letters: np.ndarray
    word: np.ndarray
    lengths: np.ndarray
    crc: np.ndarray

    KINDS = (np.uint32, np.uint8, np.uint32, np.uint32, np.uint32)

    @cached_property
    def names(self) -> list[bytes]:
        return words_of(self.widths, self.letters)

    def names_at(self, places: np.ndarray) -> list[bytes]:
        return some_words(self.widths, self.letters, places)

    def blob(self) -> bytes:
        arrays = [self.widths, self.letters, self.word, self.lengths, self.crc]
        return pack([a.astype(kind, copy=False) for a, kind in zip(arrays, self.KINDS, strict=True)], DENSE)

    @classmethod
    def from_blob(cls, blob: bytes) -> Parsed:
        widths, letters, word, lengths, crc = unpack(blob, cls.KINDS)
        return cls(widths, letters, word.view(np.int32), lengths.astype(np.int64), crc.astype(np.int64))


def parse(texts: Sequence[bytes]) -> Parsed:
    places: defaultdict[bytes, int] = defaultdict()
    places.default_factory = places.__len__  # a new word gets the next place
    parts, lengths = [], []
    for t in texts:
        n = 0
        for own in token_stretches(t):
            parts.append(np.fromiter(map(places.__getitem__, own), np.int32, len(own)))
            n += len(own)
        lengths.append(n)
    return Parsed(*word_arrays(places), np.concatenate(parts), np.array(lengths), np.fromiter(map(zlib.crc32, texts), np.int64, len(texts)))


def word_arrays(words: Collection[bytes]) -> list[np.ndarray]:
    return [np.fromiter(map(len, words), np.uint32, len(words)), np.frombuffer(b"".join(words), np.uint8)]


def words_of(lengths: np.ndarray, data: np.ndarray) -> list[bytes]:
    raw, ends = data.tobytes(), np.cumsum(lengths, dtype=np.int64).tolist()
    return [raw[e - n : e] for e, n in zip(ends, lengths.tolist(), strict=True)]


def some_words(lengths: np.ndarray, data: np.ndarray, places: np.ndarray) -> list[bytes]:
    raw, ends = data.tobytes(), np.cumsum(lengths, dtype=np.int64)
    return [raw[e - n : e] for e, n in zip(ends[places].tolist(), lengths[places].tolist(), strict=True)]


def in_order(code: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Whole numbers, none negative, in rising order, and the place of each; equal ones keep theirs."""
    code, low = code.astype(np.uint64, copy=False), max(1, len(code)).bit_length()
    if int(code.max(initial=0)) >> (64 - low):  # number and place do not fit one sort key
        order = np.argsort(code, kind="stable")
        return code[order], order
    own = np.sort((code << np.uint64(low)) | np.arange(len(code), dtype=np.uint64))
    return own >> np.uint64(low), (own & np.uint64((1 << low) - 1)).view(np.int64)


def starts_of(own: np.ndarray) -> np.ndarray:
    """Where each run of equal numbers begins."""
    return np.flatnonzero(np.append(True, own[1:] != own[:-1])) if len(own) else np.zeros(0, np.int64)


def distinct(code: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The numbers that occur, in rising order, and each one's place among them."""
    own, order = in_order(code)
    starts = starts_of(own)
    at = np.empty(len(code), dtype=np.int32)
    at[order] = np.repeat(np.arange(len(starts), dtype=np.int32), np.diff(np.append(starts, len(own))))
    return own[starts], at


@dataclass
class Chunk:
    """Tokens of some texts: each one's text, place in it and word, and its keys by kind.

    A kind is (sorted distinct keys, each token's place among them): words,
    words in their topic, pairs with the word before, triples with both before.
    """

    parsed: Parsed
    word: np.ndarray
    hashes: np.ndarray
    text: np.ndarray
    place: np.ndarray
    topic: np.ndarray
    lengths: np.ndarray
    kinds: list[tuple[np.ndarray, np.ndarray]]
    topic_keys: np.ndarray

    @property
    def names(self) -> list[bytes]:
        return self.parsed.names

    @property
    def first(self) -> np.ndarray:
        return self.place == 0


def topics(word: np.ndarray, text: np.ndarray, function: np.ndarray, size: int) -> np.ndarray:
    """The two function words that the text has used most so far, as one number: a guess at its language and style."""
    code = function[word]
    at = np.flatnonzero(code >= 0)
    out = np.full(len(word), size * (size + 1), dtype=np.int64)
    if not len(at):
        return out
    opens = np.flatnonzero(np.append(True, text[at][1:] != text[at][:-1]))
    sizes = np.diff(np.append(opens, len(at)))
    used = code[at]
    # a word's count so far, ties to the first listed, as one number: count * size + (size - 1 - rank)
    most, second = np.zeros(len(at), dtype=np.int64), np.zeros(len(at), dtype=np.int64)
    for j in range(size):
        seen = np.cumsum(used == j)
        before = np.zeros(len(opens), dtype=np.int64)
        before[1:] = seen[opens[1:] - 1]
        seen -= np.repeat(before, sizes)
        own = np.where(seen > 0, seen * size + (size - 1 - j), 0)
        np.maximum(second, np.minimum(most, own), out=second)
        np.maximum(most, own, out=most)
    rank = lambda best: np.where(best > 0, size - 1 - best % size, size)
    pair = rank(most) * (size + 1) + rank(second)
    last = np.cumsum(code >= 0) - 1
    last[1:], last[0] = last[:-1].copy(), -1
    known = (last >= 0) & (text[at[np.maximum(last, 0)]] == text)
    return np.where(known, pair[np.maximum(last, 0)], out)


def shifts(bucket_bits: int) -> list[np.uint64]:
    """For each kind: bits of the hash that a key leaves out."""
    return [np.uint64(max(0, 64 - w - bucket_bits)) for w in WIDTHS]


def read_chunk(texts: Sequence[bytes], listed: Sequence[bytes], bucket_bits: int) -> Chunk:
    """listed: the function words."""
    return chunk_of(parse(texts), listed, bucket_bits)


def chunk_of(parsed: Parsed, listed: Sequence[bytes], bucket_bits: int) -> Chunk:
    shift = shifts(bucket_bits)
    word, lengths, n_names = parsed.word, parsed.lengths, len(parsed.widths)
    text = np.repeat(np.arange(len(lengths), dtype=np.int32), lengths)
    place = np.arange(len(word), dtype=np.int32) - np.repeat(np.cumsum(lengths) - lengths, lengths).astype(np.int32)
    hashes = hashes_of(parsed.widths, parsed.letters)
    function = np.full(n_names, -1, dtype=np.int64)
    rank = {w: j for j, w in enumerate(listed)}
    maybe = np.flatnonzero(np.isin(hashes, byte_hashes(listed))) if listed else np.zeros(0, np.int64)
    for i, w in zip(maybe.tolist(), parsed.names_at(maybe), strict=True):
        if w in rank:
            function[i] = rank[w]
    own = hashes[word]
    one, two = np.roll(own, 1), np.roll(own, 2)
    one[place == 0] = START
    two[place == 1], two[place == 0] = START, START
    topic = topics(word, text, function, len(listed))
    by_hash = np.argsort(hashes)
    back = np.empty(n_names, dtype=np.int32)
    back[by_hash] = np.arange(n_names)
    kinds = [(hashes[by_hash] >> shift[0], back[word])]
    pair = mixed(one * ODD1 + own)
    for key, s in zip((mixed(own + topic.astype(np.uint64) * ODD2 + ODD1), pair, mixed(two * ODD2 + pair)), shift[1:], strict=True):
        kinds.append(distinct(key >> s))
    return Chunk(parsed, word, hashes, text, place, topic, lengths, kinds, topic_total_keys(len(listed), shift[1]))


def topic_total_keys(size: int, shift: np.uint64) -> np.ndarray:
    """Key of the total of each topic."""
    return mixed(np.arange(size * (size + 1) + 1, dtype=np.uint64) * ODD2 + START) >> shift


def with_totals(chunk: Chunk, counts: np.ndarray, by_topic: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Keys and counts of words in topics, and of whole topics, in the order of the keys."""
    used = np.unique(chunk.topic)
    keys = np.concatenate([chunk.kinds[1][0], chunk.topic_keys[used]])
    order = np.argsort(keys, kind="stable")
    return keys[order], np.concatenate([counts, by_topic[used]])[order]


def requests(chunk: Chunk, trains: np.ndarray, bucket_bits: int) -> Iterator[tuple[int, bytes]]:
    """For each bucket that holds a key of the chunk: keys and training counts of all four kinds."""
    weights = trains[chunk.text].astype(np.float64)
    counted = [np.bincount(at, weights=weights, minlength=len(keys)).astype(np.uint32) for keys, at in chunk.kinds]
    by_topic = np.bincount(chunk.topic, weights=weights, minlength=len(chunk.topic_keys)).astype(np.uint32)
    keys = [k for k, _ in chunk.kinds]
    keys[1], counted[1] = with_totals(chunk, counted[1], by_topic)
    widths = [64 - int(s) for s in shifts(bucket_bits)]
    edges = [cuts(k, w, bucket_bits) for k, w in zip(keys, widths, strict=True)]
    rest = [np.uint64((1 << (w - bucket_bits)) - 1) for w in widths]
    for b in range(1 << bucket_bits):
        spans = [slice(e[b], e[b + 1]) for e in edges]
        if any(s.start < s.stop for s in spans):
            short = [np.diff((k[s] & r).astype(np.int64), prepend=0).astype(kind) for k, s, r, kind in zip(keys, spans, rest, KEYS, strict=True)]
            yield b, pack([*short, *(c[s] for c, s in zip(counted, spans, strict=True))])


def cuts(keys: np.ndarray, width: int, bucket_bits: int) -> list[int]:
    """Where each bucket's keys begin among the sorted ones."""
    if not bucket_bits:
        return [0, len(keys)]
    starts = np.arange(1, 1 << bucket_bits, dtype=np.uint64) << np.uint64(width - bucket_bits)
    return [0, *np.searchsorted(keys, starts).tolist(), len(keys)]


def by_group(batches: Iterator[pd.DataFrame], key: str) -> Iterator[list[tuple]]:
    """Rows of a sorted stream with the same `key`."""
    held: list[tuple] = []
    for batch in batches:
        at = batch.columns.get_loc(key)
        for row in batch.itertuples(index=False, name=None):
            if held and held[0][at] != row[at]:
                yield held
                held = []
            held.append(row)
    if held:
        yield held


KEYS = (np.uint64, np.uint32, np.uint32, np.uint32)
COUNTS = (np.uint32, np.uint32, np.uint32, np.uint32)
#: Sums of each kind, and whether a word is the chunk's own to teach the spelling.
SUMS = (np.int64, np.uint32, np.uint32, np.uint32, np.uint8)


def answers(rows: list[tuple], bucket: int) -> Iterator[tuple[int, int, bytes]]:
    """Sums of a bucket for each of its (chunk, blob), and the bucket's training tokens and distinct words.

    Each distinct training word is the own of one chunk, the first that counted it.
    """
    blobs = [unpack(blob, KEYS + COUNTS) for _, blob in rows]
    found: list[list[np.ndarray]] = [[] for _ in rows]
    totals = np.zeros(2, dtype=np.int64)
    owned: list[np.ndarray] = []
    for kind in range(4):
        keys = [np.cumsum(own[kind], dtype=np.uint64) for own in blobs]
        ends = np.cumsum([len(k) for k in keys])
        _, at = distinct(np.concatenate(keys))
        counted = np.concatenate([own[4 + kind] for own in blobs])
        sums = np.bincount(at, weights=counted)
        if kind == 0:
            totals += [int(sums.sum()), int((sums > 0).sum())]
            counting = np.flatnonzero(counted)[::-1]
            first = np.full(len(sums), -1)
            first[at[counting]] = counting
            flags = np.zeros(len(at), dtype=np.uint8)
            flags[first[first >= 0]] = 1
            owned = np.split(flags, ends[:-1])
        else:
            sums = np.minimum(sums, 0xFFFFFFFF)
        for own, part in zip(found, np.split(sums.astype(SUMS[kind])[at], ends[:-1]), strict=True):
            own.append(part)
    for (chunk, _), own, flags in zip(rows, found, owned, strict=True):
        yield chunk, bucket, pack([*own, flags])
    yield TOTALS, bucket, pack([totals])


def packed(docs: DataFrame) -> DataFrame:
    """Rows of docs(doc_id, held_out, text) in chunks: chunk, ids, held, data (the texts as `Parsed`), size (their UTF-8 bytes, and eight for each that is not null), tokens (of the training texts)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        chunk, held, size = TaskContext.get().partitionId() << 32, [], 0
        for batch in batches:
            ids = batch.column("doc_id")
            for i, out, text in zip(ids.to_pylist(), batch.column("held_out").to_pylist(), batch.column("text").to_pylist(), strict=True):
                held.append((i, out, text or b"", text is not None))
                size += len(held[-1][2]) + 8
                if size >= CHUNK_BYTES:
                    yield row(chunk, held, ids.type)
                    chunk, held, size = chunk + 1, [], 0
        if held:
            yield row(chunk, held, ids.type)

    def row(chunk: int, held: list[tuple], kind: pa.DataType) -> pa.RecordBatch:
        ids, out, texts, real = zip(*held, strict=True)
        size, parsed = sum(map(len, texts)) + 8 * sum(real), parse(texts)
        trains = int(parsed.lengths[~np.array(out, dtype=bool)].sum())
        columns = [pa.array([chunk], pa.int64()), pa.array([list(ids)], pa.list_(kind)), pa.array([list(out)], pa.list_(pa.bool_())), pa.array([parsed.blob()], pa.binary()), pa.array([size], pa.int64()), pa.array([trains], pa.int64())]
        return pa.RecordBatch.from_arrays(columns, names=["chunk", "ids", "held", "data", "size", "tokens"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return durable(docs.select("doc_id", "held_out", F.col("text").cast("binary").alias("text")).mapInArrow(run, f"chunk long, ids array<{kind}>, held array<boolean>, data binary, size long, tokens long"))


def word_counts(chunks: DataFrame, share: float = 0.0, only: Sequence[bytes] | None = None) -> DataFrame:
    """Training tokens of words, ends left out, summed over all chunks in which a word has more than `share` of the tokens: word, n.

    only: of these words alone.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: Counter[bytes] = Counter()
        wanted, exact = (None, None) if only is None else (byte_hashes(only), set(only))
        for batch in batches:
            for held, data in zip(batch.column("held").to_pylist(), batch.column("data"), strict=True):
                parsed = Parsed.from_blob(data.as_py())
                trains = np.repeat(~np.array(held, dtype=bool), parsed.lengths)
                counted = np.bincount(parsed.word[trains], minlength=len(parsed.widths))
                some = counted > share * int(trains.sum())
                if wanted is not None:
                    some &= np.isin(hashes_of(parsed.widths, parsed.letters), wanted)
                for word, n in zip(parsed.names_at(np.flatnonzero(some)), counted[some].tolist(), strict=True):
                    if exact is None or word in exact:
                        counts[word] += n
                if len(counts) > HELD_WORDS:
                    yield rows(counts)
                    counts.clear()
        yield rows(counts)

    def rows(counts: Counter[bytes]) -> pa.RecordBatch:
        counts.pop(END, None)
        return pa.RecordBatch.from_arrays([pa.array(list(counts), pa.binary()), pa.array(list(counts.values()), pa.int64())], names=["word", "n"])

    return chunks.select("held", "data").mapInArrow(run, "word binary, n long").groupBy("word").agg(F.sum("n").alias("n"))


def count_everywhere(chunks: DataFrame, listed: Sequence[bytes], bucket_bits: int) -> DataFrame:
    """ANSWERS, tokens, types: for each chunk and bucket the training counts of the chunk's keys; the buckets' totals."""

    def ask(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for chunk, held, data in zip(batch["chunk"], batch["held"], batch["data"], strict=True):
                own = chunk_of(Parsed.from_blob(data), listed, bucket_bits)
                rows = requests(own, ~np.array(held, dtype=bool), bucket_bits)
                yield pd.DataFrame([(chunk, b, blob) for b, blob in rows], columns=["chunk", "bucket", "data"])

    def answer(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for rows in by_group(batches, "bucket"):
            found = pd.DataFrame(answers([(c, d) for c, _, d in rows], rows[0][1]), columns=["chunk", "bucket", "data"])
            last = found["chunk"] == TOTALS
            tokens, types = unpack(found["data"][last].iloc[0], (np.int64,))[0].tolist()
            yield found.assign(tokens=np.where(last, tokens, 0), types=np.where(last, types, 0))

    asked = chunks.select("chunk", "held", "data").mapInPandas(ask, ANSWERS)
    dealt = asked.repartition(1 << bucket_bits, "bucket").sortWithinPartitions("bucket", "chunk")
    return durable(dealt.mapInPandas(answer, ANSWERS + ", tokens long, types long"))


def joined(blobs: Sequence[bytes]) -> list[np.ndarray]:
    """SUMS of a chunk's keys, from its answers in bucket order."""
    parts = [unpack(b, SUMS) for b in blobs]
    return [np.concatenate([p[k] for p in parts]) for k in range(len(SUMS))]


def bucket_bits_for(n_bytes: int) -> int:
    return min(24, max(0, (max(1, n_bytes // BUCKET_BYTES) - 1).bit_length()))
