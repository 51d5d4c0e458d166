"""Language of every word of a text by a linear-chain conditional random field.

Emissions are sums of learned weights of hashed character n-grams (those with
the word's edges are its affixes) and of lexicon entries; transitions are
learned from code-switched sequences of sample segments. Forward-backward runs
on whole texts: words are laid out in chunks of a fixed length, the chunks'
transfer matrices are chained along each text, and all chunks of a batch are
worked on side by side, so the result is exact and a long text takes one step
of a loop for each chunk, not for each word.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import fold

FOLDS = 5
#: Bounds of the sample the model is fitted on: rows a language, characters a row.
ROWS_PER_LANGUAGE, CHARACTERS_PER_ROW = 250, 20_000
NGRAMS = (1, 2, 3, 4)
SLOTS = 1 << 16
LEXICON_WORDS, LEXICON_LEAST = 3000, 3
CHUNK = 48
#: Words of several texts that are worked on together.
TOGETHER = 200_000
ROUNDS, RATE, DECAY = 50, 0.1, 1e-6
UNDETERMINED = "und"
EDGE = 1


@dataclass(frozen=True)
class Model:
    languages: list[str]
    weights: np.ndarray  # SLOTS x languages, of n-grams
    lexicon: np.ndarray  # sorted word hashes
    lexicon_weights: np.ndarray  # as many x languages
    transitions: np.ndarray


def mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0x9E3779B97F4A7C15)
    return x ^ (x >> np.uint64(29))


def word_features(words: Sequence[str]) -> tuple[list[tuple[np.ndarray, np.ndarray]], np.ndarray]:
    """For each n: slots of the n-grams of all words and their words' places; hashes of the whole words."""
    text = "".join(f"\x01{w}\x01" for w in words)
    codes = np.frombuffer(text.encode("utf-32-le"), dtype=np.uint32).astype(np.uint64)
    lengths = np.array([len(w) + 2 for w in words])
    owner = np.repeat(np.arange(len(words)), lengths)
    grams = []
    h = np.zeros(len(codes), dtype=np.uint64)
    for n in range(1, max(NGRAMS) + 1):
        end = len(codes) - n + 1
        if end <= 0:
            break
        h = h[:end] * np.uint64(1_000_003) + codes[n - 1 :]
        if n in NGRAMS:
            inside = owner[:end] == owner[n - 1 :]
            grams.append(((mixed(h[inside] * np.uint64(8) + np.uint64(n)) & np.uint64(SLOTS - 1)).astype(np.int64), owner[:end][inside]))
    starts = np.concatenate([[0], np.cumsum(lengths)[:-1]])
    position = np.arange(len(codes)) - starts[owner]
    whole = np.add.reduceat(mixed(codes * np.uint64(0x100000001B3) + mixed(position.astype(np.uint64) + np.uint64(7))), starts)
    return grams, whole


def scores(words: Sequence[str], model: Model) -> np.ndarray:
    """Emission scores, words x languages; words without a letter get zeros."""
    n_langs = len(model.languages)
    grams, whole = word_features(words)
    total = np.zeros((len(words), n_langs))
    for slots, owner in grams:
        for k in range(n_langs):
            total[:, k] += np.bincount(owner, weights=model.weights[slots, k], minlength=len(words))
    if len(model.lexicon):
        at = np.minimum(np.searchsorted(model.lexicon, whole), len(model.lexicon) - 1)
        total += np.where((model.lexicon[at] == whole)[:, None], model.lexicon_weights[at], 0)
    return total * np.array([any(map(str.isalpha, w)) for w in words])[:, None]


def scaled(x: np.ndarray, axes: tuple[int, ...]) -> np.ndarray:
    return x / np.maximum(x.sum(axis=axes, keepdims=True), 1e-300)


def marginals(emissions: np.ndarray, lengths: np.ndarray, transitions: np.ndarray) -> np.ndarray:
    """Posterior of each word's label, for the words of several texts one after another."""
    ahead, behind, _ = messages(emissions, lengths, transitions)
    return scaled(ahead * behind, (1,))


def messages(emissions: np.ndarray, lengths: np.ndarray, transitions: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For each word and label, up to a factor: what is told by the words so far, by the later ones, by this and the later ones."""
    n_langs = emissions.shape[1]
    chunks = np.maximum(1, -(-lengths // CHUNK))
    first = np.concatenate([[0], np.cumsum(chunks)])
    n_chunks, starts = first[-1], np.concatenate([[0], np.cumsum(lengths)[:-1]])
    place = np.arange(len(emissions)) - np.repeat(starts, lengths)
    chunk, step = np.repeat(first[:-1], lengths) + place // CHUNK, place % CHUNK
    there = np.zeros((CHUNK, n_chunks), dtype=bool)
    there[step, chunk] = True
    e = np.ones((CHUNK, n_chunks, n_langs))
    e[step, chunk] = np.exp(emissions - emissions.max(axis=1, keepdims=True))
    move = np.exp(transitions - transitions.max())
    transfer = np.broadcast_to(np.eye(n_langs), (n_chunks, n_langs, n_langs)).copy()
    for t in range(CHUNK):
        on = there[t]
        transfer[on] = scaled((transfer[on] @ move) * e[t][on][:, None, :], (1, 2))
    ahead, behind = np.full((n_chunks, n_langs), 1 / n_langs), np.full((n_chunks, n_langs), 1 / n_langs)
    for k in range(1, chunks.max(initial=0)):
        c = first[:-1][chunks > k] + k
        ahead[c] = scaled((ahead[c - 1][:, None, :] @ transfer[c - 1])[:, 0, :], (1,))
        c = first[1:][chunks > k] - 1 - k
        behind[c] = scaled((transfer[c + 1] @ behind[c + 1][:, :, None])[:, :, 0], (1,))
    forward, backward, own_and_later = np.empty_like(e), np.empty_like(e), np.empty_like(e)
    now = ahead
    for t in range(CHUNK):
        now = np.where(there[t][:, None], scaled((now @ move) * e[t], (1,)), now)
        forward[t] = now
    now = behind
    for t in range(CHUNK - 1, -1, -1):
        backward[t], own_and_later[t] = now, e[t] * now
        now = np.where(there[t][:, None], scaled(own_and_later[t] @ move.T, (1,)), now)
    return forward[step, chunk], backward[step, chunk], own_and_later[step, chunk]


def transition_gap(ahead: np.ndarray, own_and_later: np.ndarray, truth: np.ndarray, lengths: np.ndarray, transitions: np.ndarray) -> np.ndarray:
    """Gradient of the log-likelihood by the transitions: those of the truth less those expected.

    A text's first label follows one that is not seen and may be any.
    """
    n_langs = transitions.shape[0]
    move = np.exp(transitions - transitions.max())
    opens = np.cumsum(lengths)[lengths > 0] - lengths[lengths > 0]
    follows = np.ones(len(truth), dtype=bool)
    follows[opens] = False
    after = np.flatnonzero(follows)
    seen = np.zeros((n_langs, n_langs))
    np.add.at(seen, (truth[after - 1], truth[after]), 1)
    seen += (scaled(move, (0,)) * np.bincount(truth[opens], minlength=n_langs))
    pairs = scaled(ahead[after - 1][:, :, None] * move * own_and_later[after][:, None, :], (1, 2)).sum(axis=0)
    first = scaled(move * own_and_later[opens][:, None, :], (1, 2)).sum(axis=0)
    return seen - pairs - first


def fit(samples: dict[str, list[str]], seed: int = 11) -> Model:
    """Maximise the likelihood of code-switched sequences made of the samples' segments."""
    languages = sorted(samples)
    n_langs, random = len(languages), np.random.default_rng(seed)
    words: dict[str, int] = {}
    texts = [[[words.setdefault(w, len(words)) for w in t.lower().split()] for t in samples[lang]] for lang in languages]
    streams = [[w for t in own for w in t] for own in texts]
    if not words:
        return Model(languages, np.zeros((SLOTS, n_langs)), np.zeros(0, np.uint64), np.zeros((0, n_langs)), np.zeros((n_langs, n_langs)))
    pieces, labels = [], []
    ends = [0] * n_langs
    while True:
        left = np.array([len(s) - e for s, e in zip(streams, ends, strict=True)])
        if not left.any():
            break
        lang = int(random.choice(n_langs, p=left / left.sum()))
        size = int(random.integers(4, 60))
        piece = streams[lang][ends[lang] : ends[lang] + size]
        ends[lang] += size if len(piece) == size else len(piece)
        pieces += piece
        labels += [lang] * len(piece)
    sequence, truth = np.array(pieces), np.array(labels)
    names = list(words)
    grams, whole = word_features(names)
    lexicon: Counter[str] = Counter()
    for own in streams:
        lexicon.update({names[w]: n for w, n in Counter(own).most_common(LEXICON_WORDS) if n >= LEXICON_LEAST})
    listed = np.array([w in lexicon for w in names])
    hashes = np.unique(whole[listed])
    at = np.searchsorted(hashes, whole[listed])
    model = Model(languages, np.zeros((SLOTS, n_langs)), hashes, np.zeros((len(hashes), n_langs)), np.zeros((n_langs, n_langs)))
    lengths = np.full(-(-len(sequence) // (8 * CHUNK)), 8 * CHUNK)
    lengths[-1] = len(sequence) - lengths[:-1].sum()
    params = [model.weights, model.lexicon_weights, model.transitions]
    means, squares = [np.zeros_like(p) for p in params], [np.zeros_like(p) for p in params]
    has_letter = np.array([any(map(str.isalpha, w)) for w in names])
    one_hot = np.eye(n_langs)[truth]
    for t in range(1, ROUNDS + 1):
        by_word = scores(names, model)
        ahead, behind, own_and_later = messages(by_word[sequence], lengths, model.transitions)
        gap = (one_hot - scaled(ahead * behind, (1,))) / len(sequence)
        by_type = np.stack([np.bincount(sequence, weights=gap[:, k], minlength=len(names)) for k in range(n_langs)], axis=1) * has_letter[:, None]
        g_weights = np.zeros_like(model.weights)
        for slots, owner in grams:
            for k in range(n_langs):
                g_weights[:, k] += np.bincount(slots, weights=by_type[owner, k], minlength=SLOTS)
        g_lexicon = np.zeros_like(model.lexicon_weights)
        np.add.at(g_lexicon, at, by_type[listed])
        g_transitions = transition_gap(ahead, own_and_later, truth, lengths, model.transitions) / len(sequence)
        for i, (p, g) in enumerate(zip(params, (g_weights, g_lexicon, g_transitions), strict=True)):
            g = g - DECAY * p
            means[i] = 0.9 * means[i] + 0.1 * g
            squares[i] = 0.99 * squares[i] + 0.01 * g * g
            p += RATE * (means[i] / (1 - 0.9**t)) / (np.sqrt(squares[i] / (1 - 0.99**t)) + 1e-9)
    return Model(languages, model.weights.astype(np.float32), hashes, model.lexicon_weights, model.transitions)


def train(docs: DataFrame, rows_per_language: int = ROWS_PER_LANGUAGE) -> Model:
    """A model from whole texts with a language outside fold 0: of each language, those first by a hash of doc_id.

    Rows without an id, a language or a text, and longer texts, teach nothing.
    Of rows with the same id and language the least text teaches, once. With no
    rows left the model knows no language.
    """
    usable = docs.filter((fold("doc_id", FOLDS) != 0) & F.col("lang").isNotNull() & F.col("doc_id").isNotNull() & (F.length("text") <= CHARACTERS_PER_ROW))
    order = Window.partitionBy("lang").orderBy(F.xxhash64("doc_id", F.lit("language")), "doc_id")
    ids = usable.select("doc_id", "lang").distinct().withColumn("k", F.row_number().over(order)).filter(F.col("k") <= rows_per_language).drop("k")
    chosen = docs.sparkSession.createDataFrame([tuple(r) for r in ids.collect()], ids.schema)
    samples: dict[str, list[str]] = {}
    texts = docs.filter(F.length("text") <= CHARACTERS_PER_ROW).join(F.broadcast(chosen), ["doc_id", "lang"]).groupBy("doc_id", "lang").agg(F.min("text").alias("text"))
    for r in sorted(texts.select("doc_id", "lang", "text").collect()):
        samples.setdefault(r.lang, []).append(r.text)
    return fit(samples)


def label_texts(texts: Sequence[str | None], model: Model) -> list[tuple[str, float]]:
    """The language with the largest share of the word posteriors, and that share."""
    out: list[tuple[str, float]] = [(UNDETERMINED, 0.0)] * len(texts)
    tokens = [(i, t.lower().split()) for i, t in enumerate(texts) if t and any(map(str.isalpha, t))] if model.languages else []
    while tokens:
        some, n = [], 0
        while tokens and (not some or n + len(tokens[-1][1]) <= TOGETHER):
            some.append(tokens.pop())
            n += len(some[-1][1])
        words: dict[str, int] = {}
        flat = np.array([words.setdefault(w, len(words)) for _, own in some for w in own])
        names = list(words)
        lengths = np.array([len(own) for _, own in some])
        posterior = marginals(scores(names, model)[flat], lengths, model.transitions)
        posterior *= np.array([any(map(str.isalpha, w)) for w in names])[flat][:, None]
        sums = np.add.reduceat(posterior, np.concatenate([[0], np.cumsum(lengths)[:-1]]))
        shares = scaled(sums, (1,))
        for (i, _), share in zip(some, shares, strict=True):
            k = int(share.argmax())
            out[i] = (model.languages[k], float(min(1.0, share[k])))
    return out


def language(docs: DataFrame, model: Model, text: str = "text") -> Column:
    """struct(lang, score) of the whole text; `und` and 0 where it is null or has no letter.

    Each row is labelled by its text alone, so repeated rows agree; of languages
    with equal shares the first in code point order is given. A model without
    languages gives `und`. Memory grows with the longest text.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)

    @F.pandas_udf("lang string, score double")
    def label(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            yield pd.DataFrame(label_texts(list(batch), shared.value), columns=["lang", "score"])

    return label(F.col(text))
