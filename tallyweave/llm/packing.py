"""Packing documents into windows of tokens by best-fit decreasing.

Overlong documents are first cut into full windows. What is left of a document
has one of a few thousand lengths, so best-fit decreasing over all documents
needs only the number of documents of each length: a run of equal lengths goes
into the tightest open windows at once, which gives the same windows as one
document after the other. A segment tree over remaining capacities finds them.
The driver holds that histogram and the rules made of it, both of a size that
the window bounds; Spark numbers the documents of a length in two levels and
joins them to the rules.

Gaps that best-fit leaves (many documents of one length) are filled by cutting
the documents of the emptiest windows; what remains at last, less than a
window of gaps, is cut at powers of two, which need no padding.
"""

from __future__ import annotations

import os
import re
from array import array
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field
from functools import lru_cache

import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, BooleanType, IntegerType, LongType, StructField, StructType
from pyspark.sql.window import Window

from .common import durable

TOKENIZER = "/opt/tokenizers/word_bpe_49k.json"
WINDOW = 2048
#: The id that ends each document.
END = 1
#: Windows with fewer free places than this stay as they are.
LEAST_GAP = 16
#: Characters of the texts whose pieces a task hands on together.
CHARS_TOGETHER = 4 << 20
#: Encoded words that a worker remembers (some 200 bytes each), and the longest of them in bytes.
WORDS_KEPT, LONGEST_KEPT = 1_200_000, 40
#: Punctuation that is a token of its own after a letter or digit.
CLOSING = b".,;:!?"
#: Words of letters with one code point each, which the tokenizer takes as one piece.
LETTERS = re.compile("[a-zA-Z\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u00ff]+")
RULE = "of int, low long, high long, at int, size int, window long, each int, place int"


# -- the plan: counts of lengths to rules ------------------------------------------------------


@dataclass
class Lot:
    """`n` windows that are filled alike.

    held: (of, at, size, rank, each, place): every window holds `each` pieces in
    a row from `place` on; a piece is the stretch of `size` from `at` of a
    document of length `of`, the first window's from number `rank` on.
    """

    n: int
    used: int = 0
    held: list[tuple[int, int, int, int, int, int]] = field(default_factory=list)

    def split(self, n: int) -> Lot:
        """The first n windows; this lot keeps the others."""
        own = Lot(n, self.used, list(self.held))
        self.held = [(of, at, size, rank + n * each, each, place) for of, at, size, rank, each, place in self.held]
        self.n -= n
        return own

    def put(self, run: Run, each: int) -> None:
        """The next n * each pieces of a run."""
        self.held.append((run.of, run.at, run.size, run.rank, each, self.used))
        self.used += each * run.size
        run.rank += self.n * each
        run.count -= self.n * each


@dataclass
class Run:
    """`count` documents of length `of` from number `rank` on, of each the stretch of `size` from `at`."""

    of: int
    at: int
    size: int
    rank: int
    count: int


class OpenWindows:
    """Lots by remaining capacity, in a segment tree that finds the tightest one for a size."""

    def __init__(self, window: int) -> None:
        self.window, self.leaves = window, 1 << window.bit_length()
        self.lots: list[list[Lot]] = [[] for _ in range(window + 1)]
        self.below = [0] * (2 * self.leaves)

    def _count(self, left: int, by: int) -> None:
        node = self.leaves + left
        while node:
            self.below[node] += by
            node >>= 1

    def add(self, lot: Lot) -> None:
        left = self.window - lot.used
        self.lots[left].append(lot)
        self._count(left, 1)

    def take(self, least: int) -> Lot | None:
        """A lot of the smallest capacity that is at least `least`."""
        node = self.leaves + least
        while not self.below[node]:
            while node & 1:
                node >>= 1
            if not node:
                return None
            node += 1
            if node & (node - 1) == 0:  # past the right edge
                return None
        while node < self.leaves:
            node = 2 * node if self.below[2 * node] else 2 * node + 1
        return self._pop(node - self.leaves)

    def widest(self, below: int | None = None) -> Lot | None:
        """A lot of the largest capacity, under `below` if given."""
        for left in range(self.window if below is None else min(below - 1, self.window), 0, -1):
            if self.lots[left]:
                return self._pop(left)
        return None

    def _pop(self, left: int) -> Lot:
        self._count(left, -1)
        return self.lots[left].pop()

    def place(self, run: Run) -> None:
        """Puts a run into the tightest windows, new ones where none has room."""
        while run.count:
            lot = self.take(run.size)
            if lot is None:
                each = min(self.window // run.size, run.count)
                lot = Lot(run.count // each)
            each = min((self.window - lot.used) // run.size, run.count)
            n = min(lot.n, run.count // each)
            own = lot if n == lot.n else lot.split(n)
            if own is not lot:
                self.add(lot)
            own.put(run, each)
            self.add(own)

    def gaps(self, least: int) -> int:
        return sum(left * sum(lot.n for lot in lots) for left, lots in enumerate(self.lots) if left >= least)

    def place_cut(self, run: Run, least: int) -> None:
        """Puts a run into windows with room for it, else cuts it to fill the widest gaps of `least` or more."""
        todo = [run]
        while todo:
            run = todo.pop()
            fits = any(self.lots[left] for left in range(run.size, self.window + 1))
            gap = None if fits else self.widest(run.size)
            if gap is None or self.window - gap.used < least:
                if gap is not None:
                    self.add(gap)
                self.place(run)
                continue
            room = self.window - gap.used
            cuts = min(run.size // room, gap.n)
            n = min(run.count, gap.n // cuts)
            for k in range(cuts):
                own = gap if gap.n == n else gap.split(n)
                own.put(Run(run.of, run.at + k * room, room, run.rank, n), 1)
                self.add(own)
            if own is not gap:
                self.add(gap)
            if run.count > n:
                todo.append(Run(run.of, run.at, run.size, run.rank + n, run.count - n))
            if run.size > cuts * room:
                todo.append(Run(run.of, run.at + cuts * room, run.size - cuts * room, run.rank, n))

    def fill_gaps(self, least: int) -> None:
        """Empties the emptiest windows into the gaps of the others, until less than one window can be saved."""
        while (saved := self.gaps(least) // self.window) > 0:
            before = sum(lot.n for lots in self.lots for lot in lots)
            lot = self.widest()
            n = min(lot.n, saved)
            own = lot if n == lot.n else lot.split(n)
            if own is not lot:
                self.add(lot)
            for of, at, size, rank, each, _ in sorted(own.held, key=lambda h: -h[2]):
                self.place_cut(Run(of, at, size, rank, each * own.n), least)
            if sum(lot.n for lots in self.lots for lot in lots) >= before:
                return

    def cut_at_powers(self, least: int) -> None:
        """Cuts windows with gaps of `least` or more into sequences whose lengths are powers of two."""
        for left in range(least, self.window):
            lots, self.lots[left] = self.lots[left], []
            self._count(left, -len(lots))
            for lot in lots:
                while lot.n:
                    one = lot if lot.n == 1 else lot.split(1)
                    self._cut_one(one)
                    if one is lot:
                        break

    def _cut_one(self, one: Lot) -> None:
        start = 0
        while start < one.used:
            size = 1 << ((one.used - start).bit_length() - 1)
            stop, part = start + size, Lot(1)
            for of, at, length, rank, each, place in one.held:
                low, high = max(start, place), min(stop, place + each * length)
                while low < high:
                    k, inside = divmod(low - place, length)
                    whole = (high - low) // length if not inside else 0
                    if whole:
                        part.held.append((of, at, length, rank + k, whole, low - start))
                        low += whole * length
                    else:
                        upto = min(high, place + (k + 1) * length)
                        part.held.append((of, at + inside, upto - low, rank + k, 1, low - start))
                        low = upto
            part.used = size
            self.lots[self.window - size].append(part)
            start = stop

    def rules(self) -> tuple[list[tuple], int]:
        """What all windows hold, as rows of RULE, and the number of windows."""
        out, first = [], 0
        for lot in (lot for lots in self.lots for lot in lots):
            out += [(of, rank, rank + lot.n * each, at, size, first, each, place) for of, at, size, rank, each, place in lot.held]
            first += lot.n
        return out, first


def plan(counts: dict[int, int], window: int = WINDOW, least_gap: int = LEAST_GAP) -> tuple[list[tuple], int]:
    """Rules (as RULE) that place counts[length] documents of each length under `window`, and the number of sequences."""
    opened = OpenWindows(window)
    for size in sorted(counts, reverse=True):
        opened.place(Run(size, 0, size, 0, counts[size]))
    opened.fill_gaps(least_gap)
    opened.cut_at_powers(least_gap)
    return opened.rules()


# -- encoding ----------------------------------------------------------------------------------


class WordIds(dict):
    """Token ids of words as little-endian 32-bit bytes, encoded when first asked for.

    The tokenizer lowers letters, drops white space and lets no token cross it,
    so a text's ids are those of its words.
    """

    def __init__(self, tokenizer: str) -> None:
        super().__init__()
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer
        from tokenizers.pre_tokenizers import ByteLevel

        self.encoder = Tokenizer.from_str(tokenizer)
        self.model = self.encoder.model
        spelled = ByteLevel(add_prefix_space=False, use_regex=False)
        self.spelling = {ord(c): spelled.pre_tokenize_str(c)[0][0] for c in map(chr, range(128, 256)) if LETTERS.fullmatch(c)}

    def __missing__(self, word: bytes) -> bytes:
        stem = word.rstrip(CLOSING)
        if len(stem) < len(word) and stem[-1:].isalnum():
            found = self[stem] + self[word[len(stem) :]]
        else:
            found = array("I", self.encoded(word.decode())).tobytes()
        if len(word) <= LONGEST_KEPT:
            if len(self) >= WORDS_KEPT:
                self.clear()
            self[word] = found
        return found

    def encoded(self, word: str) -> list[int]:
        """A word of Latin letters alone, which nothing normalises but the lowering, goes straight to the model."""
        if LETTERS.fullmatch(word):
            return [x.id for x in self.model.tokenize(word.lower().translate(self.spelling))]
        return self.encoder.encode(word, add_special_tokens=False).ids

    def ids(self, text: str | None) -> bytes:
        # a mark like <|endoftext|> is one token only as it is written
        raw = (text or "").encode()
        return b"".join(map(self.__getitem__, (raw if b"<|" in raw else raw.lower()).split()))


@lru_cache(maxsize=1)
def word_ids(tokenizer: str) -> WordIds:
    """One for all tasks of a worker."""
    return WordIds(tokenizer)


def in_slices(batch: pa.RecordBatch, chars: int) -> Iterator[pa.RecordBatch]:
    """A batch in stretches of at most so many characters, or one row."""
    sizes = pc.fill_null(pc.utf8_length(batch.column("text")), 0).to_pylist()
    start, held = 0, 0
    for i, size in enumerate(sizes):
        if i > start and held + size > chars:
            yield batch.slice(start, i - start)
            start, held = i, 0
        held += size
    if len(sizes) > start:
        yield batch.slice(start)


def encoded(docs: DataFrame, tokenizer_path: str = TOKENIZER, window: int = WINDOW, end: int = END) -> DataFrame:
    """Documents as token ids, cut into full windows and a rest: one row for each.

    doc_id, start, length, ids (binary), doc_tokens; part and nth number the
    rows of one length in a task. The tokenizer (a file of fixed size, some
    MB) is broadcast.
    """
    with open(tokenizer_path, encoding="utf-8") as file:
        shared = docs.sparkSession.sparkContext.broadcast(file.read())
    mark = end.to_bytes(4, "little")
    names = ("start", "length", "ids", "doc_tokens", "part", "nth")
    kinds = (pa.int64(), pa.int32(), pa.binary(), pa.int64(), pa.int32(), pa.int64())

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words, part = word_ids(shared.value), TaskContext.get().partitionId()
        seen: Counter[int] = Counter()
        for batch in (own for whole in batches for own in in_slices(whole, CHARS_TOGETHER)):
            rows, columns = [], [[] for _ in names]
            for i, text in enumerate(batch.column("text").to_pylist()):
                ids = words.ids(text) + mark
                total = len(ids) // 4
                for start in range(0, total, window):
                    length = min(window, total - start)
                    rows.append(i)
                    for column, value in zip(columns, (start, length, ids[4 * start : 4 * (start + length)], total, part, seen[length]), strict=True):
                        column.append(value)
                    seen[length] += 1
            own = [batch.column("doc_id").take(pa.array(rows, pa.int64()))]
            yield pa.RecordBatch.from_arrays(own + [pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=["doc_id", *names])

    types = (LongType(), IntegerType(), BinaryType(), LongType(), IntegerType(), LongType())
    schema = StructType([StructField("doc_id", docs.schema["doc_id"].dataType), *(StructField(n, t) for n, t in zip(names, types, strict=True))])
    return docs.select("doc_id", "text").mapInArrow(encode, schema)


# -- the operator ------------------------------------------------------------------------------


def pack(docs: DataFrame, tokenizer_path: str = TOKENIZER, window: int = WINDOW, end: int = END, least_gap: int = LEAST_GAP) -> DataFrame:
    """doc_id, start, length, ids, doc_tokens, sequence_id and offset of every piece of docs(doc_id, text).

    A document's tokens are its text's ids and `end`; null and empty texts are
    that one id. Pieces of a document cover its tokens without overlap; ids are
    little-endian 32-bit numbers. Pieces of a sequence follow each other from
    offset 0 on and fill at most `window` places. Repeated rows are packed one
    by one; other columns are left out; an empty table gives no rows.
    """
    spark = docs.sparkSession
    pieces = durable(encoded(docs, tokenizer_path, window, end))
    full, rest = pieces.filter(F.col("length") == window), pieces.filter(F.col("length") < window)
    counts = durable(rest.groupBy("length", "part").agg(F.count(F.lit(1)).alias("n")))
    totals = {r["length"]: r["n"] for r in counts.groupBy("length").agg(F.sum("n").alias("n")).collect()}
    made, n_sequences = plan(totals, window, least_gap)
    rules = spark.createDataFrame(made, RULE)
    earlier = Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.select("length", "part", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("before"))
    ranked = rest.join(starts, ["length", "part"]).withColumn("rank", F.col("before") + F.col("nth"))
    placed = ranked.join(F.broadcast(rules), (ranked["length"] == rules["of"]) & (F.col("rank") >= F.col("low")) & (F.col("rank") < F.col("high")))
    n = F.col("rank") - F.col("low")
    of_rest = placed.select(
        "doc_id",
        (F.col("start") + F.col("at")).alias("start"),
        F.col("size").cast("long").alias("length"),
        F.substring("ids", 4 * F.col("at") + 1, 4 * F.col("size")).alias("ids"),
        "doc_tokens",
        (F.col("window") + F.expr("(rank - low) div each")).alias("sequence_id"),
        (F.col("place") + F.pmod(n, F.col("each")) * F.col("size")).cast("long").alias("offset"),
    )
    own = F.lit(n_sequences) + F.shiftleft(F.col("part").cast("long"), 40) + F.col("nth")
    of_full = full.select("doc_id", "start", F.col("length").cast("long").alias("length"), "ids", "doc_tokens", own.alias("sequence_id"), F.lit(0).cast("long").alias("offset"))
    return of_full.unionByName(of_rest)


def sequences(pieces: DataFrame) -> DataFrame:
    """sequence_id, length and ids (binary) of the sequences that pieces(sequence_id, offset, ids) make up."""
    inside = F.transform(F.array_sort(F.collect_list(F.struct("offset", "ids"))), lambda x: x["ids"])
    joined = F.aggregate(inside, F.lit(b""), lambda a, x: F.concat(a, x))
    return pieces.groupBy("sequence_id").agg(joined.alias("ids")).select("sequence_id", F.expr("octet_length(ids) div 4").alias("length"), "ids")


def padded_length(length: Column, window: int = WINDOW) -> Column:
    """Places that a sequence takes: its length if that is a power of two, else the window."""
    return F.when(F.bit_count(length) == 1, length).otherwise(F.lit(window).cast("long"))
