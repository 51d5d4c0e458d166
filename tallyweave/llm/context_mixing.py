"""Log-probabilities of texts by online logistic mixing of hashed-context bit predictors.

A word is coded as bits. The first ask, one context after another, whether the
word is among those that the corpus and the text so far have in this context:
after the last two words, after the last word, in the text's topic (the two
function words that it has used most), anywhere. The first yes ends these
bits, and the word is then chosen by the context's own exact counts; a word that
nothing knows is spelled, eight bits a byte. Every bit is predicted by several
predictors, each with counts kept under a hash of its own context, whose
stretched probabilities are summed under weights that a gate picks and refined
by an adaptive probability map. So all bits of a text have a code length, and
bits per byte and log10 probabilities follow.

While a text is scored its weights and map go on learning, block by block, and
the counts of words, pairs and triples grow with what has been read of it. A
training text is scored by what the other texts tell: its own counts are taken
out before it starts.

Spark counts all training texts exactly (`ngram_counts`) and brings each chunk
of texts the counts that it needs. Start weights, maps and predictors' counts
are learned from all training texts, the spelling from all their distinct
words, a generation after the other: each is predicted by what the ones before
it taught and then adds its counts, its hits and one Newton step of the
weights. What came while nothing was known comes again at the end, each text
predicted by what the others taught. All these are sums of whole numbers, of a fixed size, so that a score
depends on the rows alone, not on how they are partitioned.
"""

from __future__ import annotations

import math
import zlib
from collections import Counter
from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from functools import cached_property, reduce
from itertools import chain

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import durable, fold
from .ngram_counts import DENSE, ODD1, ODD2, TOTALS, Chunk, Parsed, bucket_bits_for, by_group, byte_hashes, chunk_of, count_everywhere, hashes_of, in_order, joined, pack, packed, read_chunk, some_words, starts_of, tokens, unpack, with_totals, word_arrays, word_counts, words_of
from .texthash import mixed

FOLDS, HELD_OUT = 7, 2
#: Shares of the training texts, and of their distinct words, that have taught after each generation.
GENERATIONS = (1 / 64, 1 / 16, 1 / 4, 1.0)
#: Distinct words that one task spells to teach.
SPELLED_WORDS = 200_000
FUNCTION_WORDS = 32
#: Share of a chunk's tokens that makes a word worth counting among the first.
COMMON = 1 / 10_000
#: Tokens of a text between two steps of its weights and map.
BLOCK = 128
#: log2 of the slots of a predictor of the asking and of the spelling bits.
ASK_BITS, SPELL_BITS = 16, 19
#: Words that are spelled at a time.
SPELL_STEP = 3000
#: Bits that are tallied at a time.
STEP = 1 << 16
#: Whole numbers that a log odds, a probability's gap and a curvature's root count as 1.
ODDS_UNIT, GAP_UNIT, ROOT_UNIT = 256, 4096, 1024
#: Curvature that each weight starts with.
STIFFNESS = 30.0
#: Cells of a predictor's counts that are added up together.
SLICE = 1 << 15
LEVELS = 4
ASK_GATES, SPELL_GATES, MAP_CELLS = 16, 16, 33
RATE, MOST_WEIGHT, TRUST, BIAS = 0.02, 3.0, 40.0, 0.3
SPELLED = LEVELS


def squash(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -18, 18)))


def stretched(counts: np.ndarray) -> np.ndarray:
    """Log odds of counts (..., 2) of a bit's values."""
    return np.log((counts[..., 1] + 0.4) / (counts[..., 0] + 0.4))


def cell(dot: np.ndarray) -> np.ndarray:
    return np.clip(np.rint(dot * 2) + MAP_CELLS // 2, 0, MAP_CELLS - 1).astype(np.int64)


CENTRES = squash((np.arange(MAP_CELLS) - MAP_CELLS // 2) / 2)


@dataclass(frozen=True)
class Mixer:
    """Predictors' counts (predictors x slots x 2), weights (gates x predictors and a bias), map (gates x cells x 2: ones, bits), curvature of the weights."""

    counts: np.ndarray
    weights: np.ndarray
    map: np.ndarray
    curve: np.ndarray

    @cached_property
    def odds(self) -> np.ndarray:
        """Stretched probability of every slot, once learning is over."""
        return stretched(self.counts).astype(np.float32)

    @cached_property
    def counted(self) -> bool:
        return bool(self.counts.any())

    @cached_property
    def seen(self) -> np.ndarray:
        """Bits seen in every slot, 255 at most."""
        return np.minimum(self.counts.sum(axis=2), 255).astype(np.uint8)

    @cached_property
    def odds_less(self) -> np.ndarray:
        """`odds` of every slot once a bit of either value is taken out (predictors x 2 * slots)."""
        out = np.empty((len(self.counts), self.counts[0].size), dtype=np.float32)
        for own, row in zip(self.counts, out, strict=True):
            less = np.maximum(own - 1, 0)
            row[0::2] = stretched(np.stack([less[:, 0], own[:, 1]], axis=1))
            row[1::2] = stretched(np.stack([own[:, 0], less[:, 1]], axis=1))
        return out

    @cached_property
    def seen_less(self) -> np.ndarray:
        """`seen` of every slot once a bit of either value is taken out."""
        rest = np.maximum(self.counts - 1, 0) + self.counts[:, :, ::-1]
        return np.minimum(rest, 255).astype(np.uint8).reshape(len(rest), -1)

    @cached_property
    def shares(self) -> np.ndarray:
        """The map's share of ones in every gate and cell."""
        return np.clip(self.map[:, :, 0] / self.map[:, :, 1], 1e-4, 1 - 1e-4)

    def inputs(self, slots: np.ndarray) -> np.ndarray:
        return with_bias([np.take(own, s) for own, s in zip(self.odds, slots, strict=True)])


def with_bias(inputs: Sequence[np.ndarray]) -> np.ndarray:
    return np.stack([*inputs, np.full(len(inputs[0]), BIAS, dtype=np.float32)])


def first_mixer(predictors: int, gates: int, bits: int) -> Mixer:
    weights = np.tile([1.2 / predictors] * predictors + [0.0], (gates, 1))
    start = np.stack([TRUST * CENTRES, np.full(MAP_CELLS, TRUST)], axis=1)
    curve = np.tile(STIFFNESS * np.eye(predictors + 1), (gates, 1, 1))
    return Mixer(np.zeros((predictors, 1 << bits, 2), dtype=np.float32), weights, np.tile(start, (gates, 1, 1)), curve)


def weighted(weights: np.ndarray, gate: np.ndarray, x: np.ndarray) -> np.ndarray:
    dot = weights[gate, 0] * x[0]
    for c in range(1, len(x)):
        dot += weights[gate, c] * x[c]
    return dot


def graded(seen: np.ndarray, edges: Sequence[int]) -> np.ndarray:
    """How many of the edges, 255 at most, each count reaches."""
    return np.take(np.digitize(np.arange(256), edges), np.minimum(seen, 255).astype(np.uint8))


def price(p: np.ndarray, bit: np.ndarray) -> np.ndarray:
    return -np.log2(np.where(bit == 1, p, 1 - p))


def refined(dot: np.ndarray, hits: np.ndarray) -> np.ndarray:
    """Probability of a one: half the mix's own, half the map's; hits holds ones and bits of the mix's cell."""
    return 0.5 * squash(dot) + 0.5 * np.clip(hits[:, 0] / hits[:, 1], 1e-4, 1 - 1e-4)


class Seen:
    """`Mixer.seen` at some slots, looked up for the predictors that are asked for."""

    def __init__(self, seen: np.ndarray, slots: Sequence[np.ndarray]) -> None:
        self.seen, self.slots = seen, slots

    def __getitem__(self, k: int) -> np.ndarray:
        return np.take(self.seen[k], self.slots[k])


def count_bits(sums: np.ndarray, at: np.ndarray, times: np.ndarray | None) -> None:
    """Adds 1, or `times`, to the places `at` of whole numbers."""
    if 4 * len(at) < len(sums):
        np.add.at(sums, at, np.ones(len(at), sums.dtype) if times is None else times.astype(sums.dtype))
    else:
        sums += np.bincount(at, weights=times, minlength=len(sums)).astype(sums.dtype)


class Tally:
    """What bits tell a mixer: their counts, the hits of its map, slope and curvature of its weights, all whole numbers."""

    def __init__(self, mixer: Mixer) -> None:
        gates, n = mixer.weights.shape
        self.counts = np.zeros(mixer.counts.shape, dtype=np.uint32)
        self.hits = np.zeros((gates, MAP_CELLS, 2), dtype=np.int64)
        self.slope, self.curve = np.zeros((gates, n), dtype=np.int64), np.zeros((gates, n, n), dtype=np.int64)

    def add(self, slots: np.ndarray, kind: np.ndarray, bit: np.ndarray, mixer: Mixer, gate_of, owner: np.ndarray | None = None, times: np.ndarray | None = None) -> None:
        """A mixer that has counted nothing predicts nothing, so its weights and map learn nothing.

        owner: the bits were counted before; each is predicted without those of the same owner.
        times: how often each bit stands for itself.
        """
        if owner is None:
            for own, s in zip(self.counts, slots, strict=True):
                count_bits(own.reshape(-1), 2 * s.astype(np.int64, copy=False) + bit, times)
            taken = []
        else:
            taken = [own_counts(owner, s, bit) for s in slots]
        if not mixer.counted:
            return
        gates = len(mixer.weights)
        for at in range(0, len(bit), STEP):
            s, y, n = slots[:, at : at + STEP], bit[at : at + STEP], None if times is None else times[at : at + STEP]
            if owner is None:
                seen, x = Seen(mixer.seen, s), mixer.inputs(s)
            else:
                others = [np.maximum(c[p] - t[at : at + STEP], 0) for c, p, t in zip(mixer.counts, s, taken, strict=True)]
                seen, x = [o.sum(axis=1) for o in others], with_bias([stretched(o) for o in others])
            gate = gate_of(seen, kind[at : at + STEP])
            dot = weighted(mixer.weights, gate, x)
            p = squash(dot)
            place = gate * MAP_CELLS + cell(dot)
            ones = y if n is None else y * n
            for k, told in enumerate((ones, n)):
                self.hits[:, :, k] += np.bincount(place, weights=told, minlength=gates * MAP_CELLS).astype(np.int64).reshape(gates, MAP_CELLS)
            order = np.argsort(gate.astype(np.uint8), kind="stable")
            odds = np.take(x, order, axis=1).astype(np.float64)
            gap, root = np.rint((y - p)[order] * GAP_UNIT), np.rint(odds * np.sqrt(p * (1 - p))[order] * ROOT_UNIT)
            odds = np.rint(odds * ODDS_UNIT)
            gap, roots = (gap, root) if n is None else (gap * n[order], root * n[order])
            ends = np.searchsorted(gate[order], np.arange(gates + 1)).tolist()
            for g, (begin, stop) in enumerate(zip(ends[:-1], ends[1:], strict=True)):
                if begin < stop:
                    self.slope[g] += (odds[:, begin:stop] @ gap[begin:stop]).astype(np.int64)
                    self.curve[g] += (roots[:, begin:stop] @ root[:, begin:stop].T).astype(np.int64)

    def rows(self) -> Iterator[tuple[int, bytes]]:
        """(key, blob): key -1 has all but the counts, each other key a slice of the counts that are not 0."""
        yield -1, pack([np.concatenate([self.hits.ravel(), self.slope.ravel(), self.curve.ravel()])])
        for key, part in enumerate(self.counts.reshape(-1, min(SLICE, self.counts[0].size))):
            some = np.flatnonzero(part)
            if len(some):
                yield key, pack([some.astype(np.uint16), part[some].astype(np.int64)])


def added(rows: list[tuple[int, bytes]]) -> tuple[int, bytes]:
    """Sum of `Tally.rows` with the same key."""
    key = rows[0][0]
    if key < 0:
        return key, pack([np.sum([unpack(blob, (np.int64,))[0] for _, blob in rows], axis=0)])
    sums = np.zeros(SLICE, dtype=np.int64)
    for _, blob in rows:
        some, counted = unpack(blob, (np.uint16, np.int64))
        sums[some] += counted
    some = np.flatnonzero(sums)
    return key, pack([some.astype(np.uint16), sums[some]])


def advanced(mixer: Mixer, rows: list[tuple[int, bytes]]) -> Mixer:
    """The mixer after a generation, whose rows are `added` ones."""
    gates, n = mixer.weights.shape
    counts, hits, slope, curve = mixer.counts.copy(), mixer.map, 0.0, mixer.curve
    parts = counts.reshape(-1, min(SLICE, counts[0].size))
    for key, blob in sorted(rows):
        if key < 0:
            told = unpack(blob, (np.int64,))[0]
            own, slope, bent = np.split(told, [gates * MAP_CELLS * 2, gates * (MAP_CELLS * 2 + n)])
            hits, curve = hits + own.reshape(hits.shape), curve + bent.reshape(curve.shape) / ROOT_UNIT**2
            slope = slope.reshape(gates, n) / (ODDS_UNIT * GAP_UNIT)
        else:
            some, counted = unpack(blob, (np.uint16, np.int64))
            parts[key][some] += counted
    step = np.linalg.solve(curve, np.broadcast_to(slope, (gates, n))[:, :, None])[:, :, 0]
    return Mixer(counts, np.clip(mixer.weights + step, -MOST_WEIGHT, MOST_WEIGHT), hits, curve)


def after_generations(mixer: Mixer, tell) -> Mixer:
    """The mixer after all generations; tell(mixer, generations, again) gives the `Tally.rows` of some, each key once."""
    blind = []
    for g in range(len(GENERATIONS)):
        if not mixer.counts.any():
            blind.append(g)
        mixer = advanced(mixer, tell(mixer, [g], False))
    return advanced(mixer, tell(mixer, blind, True))


def generation_of(hashes: np.ndarray) -> np.ndarray:
    """Generation of each 32-bit hash."""
    return np.searchsorted(np.array(GENERATIONS[:-1]) * 2.0**32, hashes, side="right")


# ---- spelling


def spelling_contexts(words: Sequence[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray, list[np.ndarray]]:
    """The words' bytes with a closing space each; each byte's place in its word; the words' lengths; hashes of what each predictor knows before a byte."""
    data = np.frombuffer(b"".join(w + b" " for w in words), dtype=np.uint8).astype(np.uint64)
    lengths = np.fromiter(map(len, words), np.int64, len(words)) + 1
    first = np.repeat(np.cumsum(lengths) - lengths, lengths)
    inside = np.arange(len(data)) - first
    back = [np.where(inside >= k, np.roll(data, k), 0).astype(np.uint64) for k in range(1, 6)]
    running = np.concatenate([[np.uint64(0)], np.cumsum(mixed(data + (inside.astype(np.uint64) << np.uint64(8))))])
    so_far = running[:-1] - running[first]
    contexts, own = [], np.zeros(len(data), np.uint64)
    for k in range(5):
        own = own + (back[k] << np.uint64(8 * k))
        contexts.append(mixed(own + (np.uint64(k + 1) << np.uint64(56))))
    contexts[0] = mixed(back[0] + (np.minimum(inside, 12).astype(np.uint64) << np.uint64(16)) + (np.uint64(1) << np.uint64(56)))
    contexts.append(mixed(so_far + ODD2))
    return data, inside, lengths, contexts


def bits_of_bytes(data: np.ndarray, contexts: Sequence[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Slots of each predictor, and bits, of some bytes, highest bit first."""
    value = data.astype(np.int64) | 256
    shifts = np.arange(8, 0, -1)
    own_node = (value[:, None] >> shifts).astype(np.uint64) * ODD1
    bit = ((value[:, None] >> (shifts - 1)) & 1).ravel()
    slots = np.empty((len(contexts), len(data), 8), dtype=np.uint64)
    for c, row in zip(contexts, slots, strict=True):
        np.bitwise_xor(c[:, None], own_node, out=row)
        row *= ODD2
        row >>= np.uint64(64 - SPELL_BITS)
    return slots.view(np.int64).reshape(len(contexts), -1), bit


def spelling_bits(words: Sequence[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(slots of each predictor, bits, word) of the words' bytes and a closing space, highest bit first; and their places in bytes."""
    data, inside, lengths, contexts = spelling_contexts(words)
    slots, bit = bits_of_bytes(data, contexts)
    word = np.repeat(np.repeat(np.arange(len(words)), lengths), 8)
    return slots, bit, word, np.repeat(inside, 8)


def spelling_edges(words: Sequence[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Slots and bits of the words' bytes, those that a word shares with the one before it (as a beginning) once; each byte's place among them and its word.

    All that a bit's predictors know is the beginning of its word, so words that begin alike, side by side, share those bits.
    """
    data, inside, lengths, contexts = spelling_contexts(words)
    first, word = np.cumsum(lengths) - lengths, np.repeat(np.arange(len(words)), lengths)
    before = np.concatenate([[0], first[:-1]])[word] + inside
    same = inside < np.concatenate([[0], lengths[:-1]])[word]
    same &= data[np.where(same, before, 0)] == data
    alike = np.minimum.reduceat(np.where(same, len(data), inside), first)
    new = inside >= alike[word]
    by_place = np.argsort(inside.astype(np.uint16) if len(data) < 1 << 16 or inside.max() < 1 << 16 else inside, kind="stable")
    edge = np.empty(len(data), dtype=np.int64)
    edge[by_place] = np.cumsum(new[by_place]) - 1
    some = by_place[new[by_place]]
    return *bits_of_bytes(data[some], [c[some] for c in contexts]), edge, word


def spelling_gate(seen: Sequence[np.ndarray], _kind: np.ndarray | None = None) -> np.ndarray:
    """How well the word so far and the last three bytes are known."""
    return graded(seen[5], (1, 3, 12)) * 4 + graded(seen[2], (1, 3, 12))


def tally_words(words: Sequence[bytes], tally: Tally, mixer: Mixer, again: bool = False) -> None:
    words = sorted(words)
    for at in range(0, len(words), SPELL_STEP):
        some = words[at : at + SPELL_STEP]
        if again:
            slots, bit, word, inside = spelling_bits(some)
            tally.add(slots, inside, bit, mixer, spelling_gate, word)
        else:
            slots, bit, edge, _ = spelling_edges(some)
            tally.add(slots, bit, bit, mixer, spelling_gate, times=np.repeat(np.bincount(edge).astype(np.float64), 8))


def learn_spelling(words: Sequence[bytes]) -> Mixer:
    own = generation_of(byte_hashes(words) >> np.uint64(32))

    def tell(mixer: Mixer, some: list[int], again: bool) -> list[tuple[int, bytes]]:
        tally = Tally(mixer)
        tally_words([words[i] for i in np.flatnonzero(np.isin(own, some))], tally, mixer, again)
        return list(tally.rows())

    return after_generations(first_mixer(6, SPELL_GATES, SPELL_BITS), tell)


def spelling_costs(words: Sequence[bytes], taught: np.ndarray, mixer: Mixer) -> np.ndarray:
    """Code lengths in bits; a `taught` word's own counts are taken out first."""
    out = np.zeros(len(words))
    for own in (False, True):
        which = sorted(np.flatnonzero(taught == own).tolist(), key=words.__getitem__)
        for at in range(0, len(which), SPELL_STEP):
            some = which[at : at + SPELL_STEP]
            slots, bit, edge, word = spelling_edges([words[i] for i in some])
            if own:
                places = 2 * slots + bit
                x, gate = with_bias([np.take(o, s) for o, s in zip(mixer.odds_less, places, strict=True)]), spelling_gate(Seen(mixer.seen_less, places))
            else:
                x, gate = mixer.inputs(slots), spelling_gate(Seen(mixer.seen, slots))
            dot = weighted(mixer.weights, gate, x)
            p = 0.5 * squash(dot) + 0.5 * mixer.shares[gate, cell(dot)]
            cost = -np.log2(np.where(bit == 1, p, 1 - p).reshape(-1, 8).prod(axis=1))
            out[some] = np.bincount(word, weights=cost[edge], minlength=len(some))
    return out


# ---- asking bits


def ranks(code: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each element: how many equal ones stand before it, and how many there are."""
    own, order = in_order(code)
    starts = starts_of(own)
    sizes = np.diff(np.append(starts, len(own)))
    before, total = np.empty(len(code), np.int32), np.empty(len(code), np.int32)
    before[order] = np.arange(len(code)) - np.repeat(starts, sizes)
    total[order] = np.repeat(sizes, sizes)
    return before, total


def counts_at(chunk: Chunk, sums: list[np.ndarray], trains: np.ndarray, n_train: int) -> tuple[np.ndarray, np.ndarray]:
    """(of the context, of the word in it) at each level and token: other texts' counts and the text's own so far."""
    own = trains[chunk.text].astype(np.float64)

    def others(kind_sums: np.ndarray, code: np.ndarray, size: int) -> np.ndarray:
        before, total = ranks(code.astype(np.int64) + chunk.text.astype(np.int64) * size)
        return np.maximum(kind_sums[code] - own * total, 0) + before

    n_keys = len(chunk.kinds[1][0])
    totals_keys, source = with_totals(chunk, np.arange(n_keys), np.full(len(chunk.topic_keys), n_keys))
    of_topic = sums[1][np.searchsorted(totals_keys, chunk.topic_keys[chunk.topic])]
    of_word_in_topic = sums[1][source < n_keys]
    word, pair, triple = (others(sums[k].astype(np.float64), chunk.kinds[k][1], len(chunk.kinds[k][0])) for k in (0, 2, 3))
    in_topic = others(of_word_in_topic.astype(np.float64), chunk.kinds[1][1], len(chunk.kinds[1][0]))
    before, total = ranks(chunk.topic + chunk.text.astype(np.int64) * len(chunk.topic_keys))
    topic = np.maximum(of_topic - own * total, 0) + before
    end = np.flatnonzero(chunk.place == chunk.lengths[chunk.text] - 1)
    starts = (sums[0][chunk.kinds[0][1][end]] - own[end])[chunk.text]
    last = lambda x: np.concatenate([[0.0], x[:-1]])
    context = np.stack([np.where(chunk.first, 0, last(pair)), np.where(chunk.first, starts, last(word)), topic, n_train - own * chunk.lengths[chunk.text] + chunk.place])
    return context, np.minimum(np.stack([triple, pair, in_topic, word]), context)


@dataclass
class Reading:
    """All that learning and scoring need of some texts, once their tokens have met the counts.

    By token: the level that knew it (`outcome`), log2 of each level's context,
    topic, word (a place among the distinct ones, whose lengths and bytes stand
    one after the other). By text: tokens, known ones, bytes, base score, code
    length of the choices. Spelled tokens: text and place in `names`.
    """

    lengths: np.ndarray
    outcome: np.ndarray
    sizes: np.ndarray
    topic: np.ndarray
    word: np.ndarray
    widths: np.ndarray
    letters: np.ndarray
    known: np.ndarray
    n_bytes: np.ndarray
    base: np.ndarray
    choice: np.ndarray

    KINDS = (np.int64, np.uint8, np.uint8, np.uint16, np.uint32, np.uint32, np.uint8, np.int64, np.int64, np.float64, np.float64)

    @cached_property
    def text(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.lengths), dtype=np.int32), self.lengths)

    @cached_property
    def place(self) -> np.ndarray:
        return np.arange(len(self.outcome), dtype=np.int32) - np.repeat(np.cumsum(self.lengths) - self.lengths, self.lengths).astype(np.int32)

    @cached_property
    def hashes(self) -> np.ndarray:
        """Of each distinct word."""
        return hashes_of(self.widths, self.letters)

    @cached_property
    def spelled_text(self) -> np.ndarray:
        return self.text[self.outcome == SPELLED]

    @cached_property
    def _spelled(self) -> tuple[np.ndarray, np.ndarray]:
        return compact(self.word[self.outcome == SPELLED], len(self.widths))

    @property
    def spelled(self) -> np.ndarray:
        return self._spelled[1]

    @cached_property
    def names(self) -> list[bytes]:
        """The distinct spelled words."""
        return some_words(self.widths, self.letters, self._spelled[0])

    def of(self, some: np.ndarray) -> Reading:
        """The texts for which `some` is true."""
        mine = some[self.text]
        used, word = compact(self.word[mine], len(self.widths))
        stays = np.zeros(len(self.widths), dtype=bool)
        stays[used] = True
        letters = self.letters[np.repeat(stays, self.widths)]
        by_text = (a[some] for a in (self.known, self.n_bytes, self.base, self.choice))
        return Reading(self.lengths[some], self.outcome[mine], self.sizes[:, mine], self.topic[mine], word, self.widths[used], letters, *by_text)

    def blob(self) -> bytes:
        arrays = [self.lengths, self.outcome, self.sizes.ravel(), self.topic, self.word, self.widths, self.letters, self.known, self.n_bytes, self.base, self.choice]
        return pack([a.astype(kind, copy=False) for a, kind in zip(arrays, self.KINDS, strict=True)], DENSE)

    @classmethod
    def from_blob(cls, blob: bytes) -> Reading:
        arrays = unpack(blob, cls.KINDS)
        arrays[2] = arrays[2].reshape(LEVELS, -1)
        return cls(*arrays)


def compact(places: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """The places below n that occur, and each one's rank among them."""
    occurs = np.zeros(n, dtype=bool)
    occurs[places] = True
    return np.flatnonzero(occurs), (np.cumsum(occurs) - 1)[places]


def read(chunk: Chunk, sums: list[np.ndarray], trains: np.ndarray, n_train: int, n_types: int) -> Reading:
    context, here = counts_at(chunk, sums, trains, n_train)
    n, text, widths = len(chunk.lengths), chunk.text, chunk.parsed.widths
    outcome, of, among = np.full(len(text), SPELLED, dtype=np.uint8), np.ones(len(text)), np.ones(len(text))
    for k in reversed(range(LEVELS)):
        found = here[k] > 0
        outcome[found] = k
        np.copyto(of, here[k], where=found)
        np.copyto(among, context[k], where=found)
    choice = np.log2(among) - np.log2(of)
    sizes = np.where(context > 0, ((context + 1).view(np.int64) >> 52) - 1023, 0).astype(np.uint8)  # whole log2, a double's exponent
    counted = sums[0][chunk.kinds[0][1]]
    base = np.log10((sums[0] + 1) / (n_train + n_types + 1))[chunk.kinds[0][1]]
    by_text = lambda weights: np.bincount(text, weights=weights, minlength=n)
    return Reading(
        chunk.lengths.astype(np.int64), outcome, sizes, chunk.topic, chunk.word, widths, chunk.parsed.letters,
        by_text(counted > 0).astype(np.int64), by_text(widths[chunk.word] + 1.0).astype(np.int64), by_text(base), by_text(choice),
    )


@dataclass
class Asked:
    """The asking bits of some texts in reading order."""

    token: np.ndarray
    level: np.ndarray
    bit: np.ndarray
    slots: np.ndarray


def ask(reading: Reading) -> Asked:
    n, outcome, size = len(reading.outcome), reading.outcome, reading.sizes
    asked = (size > 0) & (np.arange(LEVELS, dtype=np.uint8)[:, None] <= outcome)
    at = np.flatnonzero(asked.T.ravel())
    token, level = at // LEVELS, at % LEVELS
    own = np.take(outcome, token)
    bit = (own == level).astype(np.int64)
    place, lv = np.take(reading.place, token), level.view(np.uint64)
    padded = np.concatenate([np.zeros(3, np.uint8), outcome])
    past = [np.where(place >= k, np.take(padded, token + (3 - k)), SPELLED + 1) for k in (1, 2, 3)]
    before = np.where(place == 0, np.uint64(0), np.take(np.roll(reading.hashes[reading.word], 1), token))
    sizes = [np.take(size.ravel(), level * n + token), *(np.take(row, token) for row in size[:2])]
    past, sizes = ([a.astype(np.uint64) for a in some] for some in (past, sizes))
    wide = lambda *parts: sum(p << np.uint64(10 * i + 2) for i, p in enumerate(parts))
    contexts = [
        wide(sizes[0], past[0]) + lv,
        mixed(before + lv),
        wide(*past) + lv,
        wide(sizes[1], sizes[2], past[0]) + lv,
        wide(np.take(reading.topic, token).astype(np.uint64), past[0]) + lv,
    ]
    slots = np.stack([(mixed(c + salt) >> np.uint64(64 - ASK_BITS)).astype(np.int32) for c, salt in zip(contexts, mixed(np.arange(1, len(contexts) + 1, dtype=np.uint64)), strict=True)])
    return Asked(token, level, bit, slots)


def ask_gate(seen: Sequence[np.ndarray], level: np.ndarray) -> np.ndarray:
    """The level, and how well the word before is known."""
    return level * 4 + graded(seen[1], (1, 8, 64))


def own_runs(text: np.ndarray, slot: np.ndarray, bit: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Bits ordered so that those of a text and slot stand together: their order, where each run begins, and the runs' sizes and ones."""
    if len(slot) and slot.max() < 1 << 16 and (text[1:] >= text[:-1]).all():  # stands by text already
        order = np.argsort(slot.astype(np.uint16), kind="stable")
        ones, own = bit[order], (slot[order].astype(np.int64) << 32) + text[order]
    else:
        width = np.uint64(int(slot.max(initial=0)).bit_length() + 1)
        own, order = in_order((text.astype(np.uint64) << width) | (slot.astype(np.uint64) << np.uint64(1)) | bit.astype(np.uint64))
        ones, own = own & np.uint64(1), own >> np.uint64(1)
    starts = starts_of(own)
    sizes = np.diff(np.append(starts, len(bit))).astype(np.int32)
    return order, starts, sizes, np.add.reduceat(ones.astype(np.int32), starts) if len(bit) else sizes


def own_counts(text: np.ndarray, slot: np.ndarray, bit: np.ndarray) -> np.ndarray:
    """For each bit: how often each value stands at its slot in its own text (bits x 2)."""
    order, _, sizes, ones = own_runs(text, slot, bit)
    out = np.empty((len(bit), 2), dtype=np.float32)
    out[order] = np.repeat(np.stack([sizes - ones, ones], axis=1), sizes, axis=0)
    return out


def predicted(reading: Reading, asked: Asked, mixer: Mixer, own_out: bool) -> tuple[np.ndarray, np.ndarray]:
    """(gate, inputs) of the asking bits; own_out: without what the bits' own text taught."""
    if not own_out:
        return ask_gate(Seen(mixer.seen, asked.slots), asked.level), mixer.inputs(asked.slots)
    text, inputs, seen = reading.text[asked.token], [], {}
    for k, (counts, slot) in enumerate(zip(mixer.counts, asked.slots, strict=True)):
        order, starts, sizes, ones = own_runs(text, slot, asked.bit)
        others = np.maximum(counts[slot[order[starts]]] - np.stack([sizes - ones, ones], axis=1).astype(np.float32), 0)
        inputs.append(np.empty(len(slot), dtype=np.float32))
        inputs[k][order] = np.repeat(stretched(others), sizes)
        if k == 1:
            seen[k] = np.empty(len(slot), dtype=np.uint8)
            seen[k][order] = np.repeat(np.minimum(others.sum(axis=1), 255).astype(np.uint8), sizes)
    return ask_gate(seen, asked.level), with_bias(inputs)


def asking_costs(reading: Reading, asked: Asked, mixer: Mixer, own_out: bool = False) -> np.ndarray:
    """Code length in bits of each text's asking bits; each text's weights and map learn as it goes."""
    n_texts, cost = len(reading.lengths), np.zeros(len(reading.lengths))
    weights = np.tile(mixer.weights[None], (n_texts, 1, 1)).reshape(n_texts * ASK_GATES, -1)
    ones, bits = (np.zeros(n_texts * ASK_GATES * MAP_CELLS, dtype=np.float32) for _ in range(2))
    start = (mixer.map / mixer.map[:, :, 1:] * np.minimum(mixer.map[:, :, 1:], 255)).reshape(-1, 2)
    start_ones, start_bits = start[:, 0].copy(), start[:, 1].copy()
    gates, inputs = predicted(reading, asked, mixer, own_out)
    block = reading.place[asked.token] // BLOCK
    order = np.argsort(block.astype(np.uint16) if block.max(initial=0) < 1 << 16 else block, kind="stable")
    ends = np.searchsorted(block[order], np.arange(block.max(initial=-1) + 2))
    texts, ys, gates, inputs = reading.text[asked.token[order]].astype(np.int64), asked.bit[order], gates[order], np.take(inputs, order, axis=1)
    for begin, stop in zip(ends[:-1].tolist(), ends[1:].tolist(), strict=True):
        text, y, gate, x = texts[begin:stop], ys[begin:stop], gates[begin:stop], inputs[:, begin:stop]
        place = text * ASK_GATES + gate
        dot = weighted(weights, place, x)
        here = cell(dot)
        spot, first = place * MAP_CELLS + here, gate * MAP_CELLS + here
        p = squash(dot)
        share = (start_ones[first] + ones[spot]) / (start_bits[first] + bits[spot])
        cost += np.bincount(text, weights=price(0.5 * p + 0.5 * np.clip(share, 1e-4, 1 - 1e-4), y), minlength=n_texts)
        np.add.at(ones, spot, y.astype(np.float32))
        np.add.at(bits, spot, np.ones(len(y), dtype=np.float32))
        occurs = np.bincount(place, minlength=len(weights)) if len(place) > len(weights) // 8 else None
        if occurs is None:
            touched, at = np.unique(place, return_inverse=True)
        else:
            touched = np.flatnonzero(occurs)
            at = (np.cumsum(occurs > 0) - 1)[place]
        gap = y - p
        pull = np.stack([np.bincount(at, weights=gap * row, minlength=len(touched)) for row in x], axis=1)
        weights[touched] = np.clip(weights[touched] + RATE * pull, -MOST_WEIGHT, MOST_WEIGHT)
    return cost


@dataclass(frozen=True)
class Model:
    """What is learned from training texts; `taught`: sorted hashes of their words, None if they are all training texts of the corpus."""

    asking: Mixer
    spelling: Mixer
    taught: np.ndarray | None
    listed: list[bytes]


def function_words(texts: Sequence[bytes]) -> list[bytes]:
    counts: Counter[bytes] = Counter()
    for t in texts:
        counts.update(t.lower().split())
    return [w for w, _ in sorted(counts.items(), key=lambda x: (-x[1], x[0]))[:FUNCTION_WORDS]]


def text_generations(texts: Sequence[bytes]) -> np.ndarray:
    return generation_of(np.fromiter(map(zlib.crc32, texts), np.int64, len(texts)))


def learn_model(texts: Sequence[bytes], listed: list[bytes], sums: list[np.ndarray] | None, bucket_bits: int, n_train: int) -> Model:
    """The model of texts that fit one task; sums: training counts of their keys, of which the texts are part."""
    first = first_mixer(5, ASK_GATES, ASK_BITS)
    if not texts or sums is None:
        return Model(first, first_mixer(6, SPELL_GATES, SPELL_BITS), np.zeros(0, np.uint64), listed)
    chunk, own = read_chunk(texts, listed, bucket_bits), text_generations(texts)
    reading = read(chunk, sums, np.ones(len(texts), dtype=bool), n_train, 0)

    def tell(mixer: Mixer, some: list[int], again: bool) -> list[tuple[int, bytes]]:
        tally = Tally(mixer)
        tally_texts(reading.of(np.isin(own, some)), tally, mixer, again)
        return list(tally.rows())

    return Model(after_generations(first, tell), learn_spelling(chunk.names), np.sort(chunk.hashes), listed)


def tally_texts(reading: Reading, tally: Tally, mixer: Mixer, again: bool = False) -> None:
    asked = ask(reading)
    tally.add(asked.slots, asked.level, asked.bit, mixer, ask_gate, reading.text[asked.token] if again else None)


def score_reading(reading: Reading, held: bool, model: Model) -> dict[str, np.ndarray]:
    """Scores of texts that are all held out or all training texts."""
    n = len(reading.lengths)
    bits = asking_costs(reading, ask(reading), model.asking, own_out=model.taught is None and not held) + reading.choice
    if held or model.taught is None:
        taught = np.full(len(reading.names), not held)
    else:
        taught = np.isin(byte_hashes(reading.names), model.taught) if reading.names else np.zeros(0, dtype=bool)
    if reading.names:
        bits += np.bincount(reading.spelled_text, weights=spelling_costs(reading.names, taught, model.spelling)[reading.spelled], minlength=n)
    return {"n_tokens": reading.lengths, "n_known": reading.known, "base_score": reading.base, "score": -math.log10(2) * bits, "n_bytes": reading.n_bytes}


def score_chunk(texts: Sequence[bytes], held: np.ndarray, sums: list[np.ndarray], model: Model, bucket_bits: int, n_train: int, n_types: int) -> dict[str, np.ndarray]:
    reading = read(read_chunk(texts, model.listed, bucket_bits), sums, ~held, n_train, n_types)
    parts = [(held == out, score_reading(reading.of(held == out), out, model)) for out in (False, True)]
    found = {name: np.zeros(len(texts), dtype=a.dtype) for name, a in parts[0][1].items()}
    for some, own in parts:
        for name, a in own.items():
            found[name][some] = a
    return found


def most_used_words(chunks: DataFrame) -> list[bytes]:
    """`function_words` of all training texts in chunks.

    Counted first are words that are frequent in a chunk. What others have, or
    these in further chunks, is less than COMMON of the tokens; all that can
    still be among the first are then counted exactly.
    """
    first = lambda counted: counted.orderBy(F.desc("n"), "word").limit(FUNCTION_WORDS)
    rough = word_counts(chunks, COMMON)
    found = first(rough).collect()
    n_train = chunks.agg(F.coalesce(F.sum("tokens"), F.lit(0))).first()[0]
    least = found[-1].n - COMMON * n_train - 1 if len(found) == FUNCTION_WORDS else 0
    if least > 0:
        likely = [bytes(r.word) for r in rough.filter(F.col("n") >= least).select("word").collect()]
        found = first(word_counts(chunks, only=likely)).collect()
    else:
        found = first(word_counts(chunks)).collect()
    return [bytes(r.word) for r in found]


def tally_readings(blobs: Iterator[bytes], tally: Tally, mixer: Mixer, again: bool) -> None:
    for blob in blobs:
        tally_texts(Reading.from_blob(blob), tally, mixer, again)


def tally_word_lists(blobs: Iterator[bytes], tally: Tally, mixer: Mixer, again: bool) -> None:
    """Words are gathered first, as many as a task is to spell: the more there are, the more begin alike."""
    held: list[bytes] = []
    for blob in blobs:
        held += words_of(*unpack(blob, (np.uint32, np.uint8)))
        if len(held) >= SPELLED_WORDS:
            tally_words(held, tally, mixer, again)
            held = []
    tally_words(held, tally, mixer, again)


def learn_generations(rows_of, mixer: Mixer, tally_blobs) -> Mixer:
    """`after_generations` by Spark; rows_of(generations): their rows' `data`, which tally_blobs(blobs, tally, mixer, again) reads."""

    def tell(mixer: Mixer, some: list[int], again: bool) -> list[tuple[int, bytes]]:
        rows = rows_of(some)
        shared = rows.sparkSession.sparkContext.broadcast(mixer)

        def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            blobs = (blob for batch in batches for blob in batch["data"])
            first = next(blobs, None)
            if first is not None:
                tally = Tally(shared.value)
                tally_blobs(chain([first], blobs), tally, shared.value, again)
                yield pd.DataFrame(tally.rows(), columns=["key", "data"])

        def total(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            for own in by_group(batches, "key"):
                yield pd.DataFrame([added(own)], columns=["key", "data"])

        told = rows.mapInPandas(run, TOLD).repartition("key").sortWithinPartitions("key").mapInPandas(total, TOLD)
        found = [(r.key, bytes(r.data)) for r in told.collect()]
        shared.destroy()
        return found

    return after_generations(mixer, tell)


#: Columns of a generation's tallies, and kinds of the rows that reading leaves.
TOLD = "key int, data binary"
TEXTS, WORDS = 0, 1


def score_texts(docs: DataFrame) -> DataFrame:
    """One row for each row of docs(doc_id, text): token counts, base score, model score, bits per byte.

    Returns doc_id, held_out, n_tokens, n_known, train_tokens, base_score,
    score (log10 of the model's probability of the tokens), n_bytes (of the
    tokens, each with one separator) and bits_per_byte. Learns from rows whose
    crc32(doc_id) mod 7 is not 2. Null and empty texts are their end alone.
    Repeated rows are scored one by one, and each is another text to the
    others; without training rows the words so far and spelling with even odds
    are all there is; an empty table gives no rows. Memory grows with the
    longest text (about 250 bytes a word), never with the number of texts.
    """
    spark = docs.sparkSession
    docs = docs.select("doc_id", (fold("doc_id", FOLDS) == HELD_OUT).alias("held_out"), "text")
    chunks = packed(docs)
    n_chunks, n_bytes = chunks.agg(F.count("*"), F.coalesce(F.sum("size"), F.lit(0))).first()
    bucket_bits = bucket_bits_for(n_bytes)
    listed = most_used_words(chunks)
    answered = count_everywhere(chunks, listed, bucket_bits)
    n_train, n_types = answered.agg(*(F.coalesce(F.sum(c), F.lit(0)) for c in ("tokens", "types"))).first()
    kind = docs.schema["doc_id"].dataType.simpleString()

    def read_rows(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for rows in by_group(batches, "chunk"):
            _, _, data, ids, held = rows[0]
            parsed, held, ids = Parsed.from_blob(data), np.array(held, dtype=bool), list(ids)
            sums, chunk = joined([r[2] for r in rows[1:]]), chunk_of(parsed, listed, bucket_bits)
            reading, out = read(chunk, sums, ~held, n_train, n_types), []
            own = np.where(held, -1, generation_of(parsed.crc))
            for g in np.unique(own).tolist():
                out.append((TEXTS, g, [ids[i] for i in np.flatnonzero(own == g)], reading.of(own == g).blob()))
            new = np.argsort(chunk.hashes)[sums[4] == 1]
            own = generation_of(chunk.hashes[new] >> np.uint64(32))
            for g in np.unique(own).tolist():
                out.append((WORDS, g, None, pack(word_arrays([chunk.names[i] for i in new[own == g]]))))
            yield pd.DataFrame(out, columns=["kind", "generation", "ids", "data"])

    both = chunks.select("chunk", F.lit(-1).alias("bucket"), "data", "ids", "held").unionByName(answered.filter(F.col("chunk") >= 0).select("chunk", "bucket", "data"), allowMissingColumns=True)
    n_tasks = max(1, n_chunks // 2)
    dealt = both.repartition(n_tasks, "chunk").sortWithinPartitions("chunk", "bucket")
    readings = durable(dealt.mapInPandas(read_rows, f"kind int, generation int, ids array<{kind}>, data binary"))
    n_spelling = 1 + n_types // SPELLED_WORDS
    last = len(GENERATIONS) - 1
    words = durable(readings.filter(F.col("kind") == WORDS).select("generation", "data").coalesce(max(1, n_tasks // 4)))
    earlier = durable(readings.filter((F.col("kind") == TEXTS) & F.col("generation").between(0, last - 1)).select("generation", "data").coalesce(max(1, n_tasks // 4)))
    later = readings.filter((F.col("kind") == TEXTS) & (F.col("generation") == last)).select("generation", "data")

    def texts_of(some: list[int]) -> DataFrame:
        parts = [part.filter(F.col("generation").isin(own)) for part, own in ((earlier, [g for g in some if g < last]), (later, [g for g in some if g == last])) if own]
        return reduce(DataFrame.unionByName, parts or [later.limit(0)]).select("data")

    words_in = lambda some: words.filter(F.col("generation").isin(some)).select("data").repartition(n_spelling)
    asking = learn_generations(texts_of, first_mixer(5, ASK_GATES, ASK_BITS), tally_readings)
    spelling = learn_generations(words_in, first_mixer(6, SPELL_GATES, SPELL_BITS), tally_word_lists)
    shared = spark.sparkContext.broadcast(Model(asking, spelling, None, listed))

    def score(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for g, ids, data in zip(batch["generation"], batch["ids"], batch["data"], strict=True):
                found = score_reading(Reading.from_blob(data), g < 0, shared.value)
                yield pd.DataFrame({"doc_id": list(ids), "held_out": g < 0} | found)

    scored = readings.filter(F.col("kind") == TEXTS).mapInPandas(score, f"doc_id {kind}, held_out boolean, n_tokens long, n_known long, base_score double, score double, n_bytes long")
    return scored.select(
        "doc_id",
        "held_out",
        "n_tokens",
        "n_known",
        F.lit(n_train).cast("long").alias("train_tokens"),
        "base_score",
        "score",
        "n_bytes",
        (-F.col("score") / F.lit(math.log10(2)) / F.col("n_bytes")).alias("bits_per_byte"),
    )
