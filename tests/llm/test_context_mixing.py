from __future__ import annotations

import math
import random
import zlib
from collections import Counter

import numpy as np
import pytest

from tallyweave.llm import context_mixing as C
from tallyweave.llm import ngram_counts as N
from tallyweave.llm.texthash import mixed


def words(rng, parts, n):
    return " ".join("".join(rng.choices(parts, k=rng.randint(1, 3))) for _ in range(n))


def held(i) -> bool:
    return zlib.crc32(str("" if i is None else i).encode()) % 7 == 2


def sample_rows():
    rng = random.Random(3)
    vocabulary = [words(rng, ["th", "an", "er", "on"], 1) for _ in range(60)]
    rows = [(i, " ".join(rng.choices(vocabulary, weights=range(1, 61), k=60))) for i in range(250)]
    rows += [(400 + i, rows[i][1]) for i in range(20)]
    rows += [(900, None), (900, None), (901, ""), (902, "The\x0bTHE\u00a0x the"), (None, "the a"), (903, "word" * 5000), (904, "new words " * 3000), (905, " " * 100_000 + "the\n"), (906, rows[1][1] + " zq\u0141\u00df unheard-of")]
    return rows


def count(chunks, listed, bucket_bits):
    """What Spark does with chunks of (texts, held): the answers of each, tokens and distinct words."""
    sent, out, totals = {}, {}, np.zeros(2, int)
    for k, (texts, out_of) in enumerate(chunks):
        for b, blob in N.requests(N.read_chunk(texts, listed, bucket_bits), ~np.array(out_of), bucket_bits):
            sent.setdefault(b, []).append((k, blob))
    for b in sorted(sent):
        for chunk, _, blob in N.answers(sent[b], b):
            if chunk == N.TOTALS:
                totals += N.unpack(blob, (np.int64,))[0]
            else:
                out.setdefault(chunk, []).append(blob)
    return [N.joined(out[k]) for k in range(len(chunks))], *totals.tolist()


def plain_bits(texts, out_of, model):
    """Code lengths by plain loops over words, contexts and bits."""
    salt = mixed(np.arange(1, 6, dtype=np.uint64))
    rank = {w: j for j, w in enumerate(model.listed)}

    def keys(own):
        one = two = "start"
        used = Counter()
        for w in own:
            order = sorted(range(len(model.listed)), key=lambda j: (-used[j], j))
            some = [j for j in order if used[j]]
            size = len(model.listed)
            topic = some[0] * (size + 1) + (some[1] if len(some) > 1 else size) if some else size * (size + 1)
            yield w, [("w", w), ("p", one, w), ("t", two, one, w), ("in", topic, w), ("topic", topic)], one, topic
            if w in rank:
                used[rank[w]] += 1
            one, two = w, one

    parsed = [list(keys(C.tokens(t.decode()))) for t in texts]
    everywhere = Counter(k for own, h in zip(parsed, out_of) if not h for _, ks, _, _ in own for k in ks)
    n_train = sum(len(own) for own, h in zip(parsed, out_of) if not h)
    for own, h in zip(parsed, out_of):
        known = everywhere.copy()
        if not h:
            known.subtract(Counter(k for _, ks, _, _ in own for k in ks))
        total = 0.0 if h else -len(own)
        weights, ones, seen = model.asking.weights.copy(), {}, {}
        cost, pending, past, last = 0.0, [], [C.SPELLED + 1] * 3, None
        n_end = known["w", N.END]
        for i, (w, ks, before, topic) in enumerate(own):
            word, pair, triple, inside, of_topic = (known[k] for k in ks)
            context = [0 if i == 0 else last[1], n_end if i == 0 else last[0], of_topic, n_train + total]
            here = [min(a, c) for a, c in zip((triple, pair, inside, word), context)]
            size = [int(math.log2(c + 1)) for c in context]
            outcome = next((k for k in range(4) if here[k] > 0), C.SPELLED)
            prior = 0 if i == 0 else int(N.byte_hashes([before])[0])
            for k in range(min(outcome, 3) + 1):
                if context[k] <= 0:
                    continue
                wide = lambda *parts: sum(p << (10 * j + 2) for j, p in enumerate(parts))
                values = [wide(size[k], past[0]) + k, int(mixed(np.array([prior], np.uint64) + np.uint64(k))[0]), wide(*past) + k, wide(size[0], size[1], past[0]) + k, wide(topic, past[0]) + k]
                slots = [int(mixed(np.array([v], np.uint64) + s)[0] >> np.uint64(64 - C.ASK_BITS)) for v, s in zip(values, salt)]
                pending.append((k, slots, int(outcome == k)))
            if outcome < C.SPELLED:
                cost += math.log2(context[outcome] / here[outcome])
            else:
                taught = not h and N.byte_hashes([w])[0] in model.taught
                cost += C.spelling_costs([w], np.array([taught]), model.spelling)[0]
            last, past = (word, pair), [outcome, *past[:2]]
            for key in ks:
                known[key] += 1
            total += 1
            if (i + 1) % C.BLOCK == 0 or i + 1 == len(own):
                learned, hits = Counter(), []
                for k, slots, y in pending:
                    gate = k * 4 + sum(min(255, model.asking.counts[1][slots[1]].sum()) >= x for x in (1, 8, 64))
                    x = [float(C.stretched(c[s])) for c, s in zip(model.asking.counts, slots)] + [C.BIAS]
                    dot = sum(a * b for a, b in zip(weights[gate], x))
                    at = int(C.cell(np.array([dot]))[0])
                    first = model.asking.map[gate, at]
                    trust = min(first[1], 255)
                    share = (first[0] / first[1] * trust + ones.get((gate, at), 0)) / (trust + seen.get((gate, at), 0))
                    p = 1 / (1 + math.exp(-dot))
                    final = 0.5 * p + 0.5 * min(max(share, 1e-4), 1 - 1e-4)
                    cost -= math.log2(final if y else 1 - final)
                    hits.append((gate, at, y))
                    for c in range(6):
                        learned[gate, c] += (y - p) * x[c]
                for gate, at, y in hits:
                    ones[gate, at] = ones.get((gate, at), 0) + y
                    seen[gate, at] = seen.get((gate, at), 0) + 1
                for (gate, c), pull in learned.items():
                    weights[gate, c] = min(max(weights[gate, c] + C.RATE * pull, -C.MOST_WEIGHT), C.MOST_WEIGHT)
                pending = []
        yield cost


def test_scores_against_plain_loops():
    rows = sample_rows()[:60] + [(904, "new words an " * 130), (906, "an er zq\u0141\u00df unheard-of"), (901, "")]
    texts, out_of = [t.encode() for _, t in rows], np.array([held(i) for i, _ in rows])
    taught = [t for t, h in zip(texts, out_of) if not h][:40]
    listed = C.function_words(taught)
    cut = 17
    for bucket_bits in (0, 3):
        chunks = [(texts[:cut], out_of[:cut]), (texts[cut:], out_of[cut:]), (taught, [True] * len(taught))]
        answers, n_train, n_types = count(chunks, listed, bucket_bits)
        model = C.learn_model(taught, listed, answers[2], bucket_bits, n_train)
        assert np.abs(model.asking.weights - C.first_mixer(5, C.ASK_GATES, 1).weights).max() > 0.01
        got = np.concatenate([C.score_chunk(t, np.array(h), a, model, bucket_bits, n_train, n_types)["score"] for (t, h), a in zip(chunks[:2], answers)])
        want = -math.log10(2) * np.array(list(plain_bits(texts, out_of, model)))
        assert np.allclose(got, want, rtol=1e-4), np.abs(got / want - 1).max()


def test_spelling_is_a_distribution():
    """The bits of a byte share one unit of probability, and taught words spell cheaper than others."""
    rng = random.Random(5)
    taught = sorted({w.encode() for w in words(rng, ["th", "an", "er", "on"], 3000).split()})
    mixer = C.learn_spelling(taught)
    ends = [bytes([b]) for b in range(256)]
    slots, bit, word, _ = C.spelling_bits(ends)
    x, gate = mixer.inputs(slots), C.spelling_gate([s[p] for s, p in zip(mixer.seen, slots)])
    dot = C.weighted(mixer.weights, gate, x)
    p = C.refined(dot, mixer.map[gate, C.cell(dot)]).reshape(256, 2, 8)[:, 0]
    bits = bit.reshape(256, 2, 8)[:, 0]
    assert abs(np.where(bits == 1, p, 1 - p).prod(axis=1).sum() - 1) < 1e-6
    cost = C.spelling_costs([b"thaner", b"thaner", b"xqzvwk"], np.array([False, b"thaner" in taught, False]), mixer)
    assert cost[0] <= cost[1] < cost[2]


@pytest.mark.parametrize("limit", [1 << 12, 1 << 23])
def test_counts_against_counter(limit):
    rng = random.Random(9)
    texts = [words(rng, ["a", "b", "c"], n).encode() for n in (0, 1, 2, 50, 400)]
    out_of = np.array([False, False, True, False, False])
    old, N.STRETCH_CHARS = N.STRETCH_CHARS, 64 if limit < 5000 else N.STRETCH_CHARS
    try:
        answers, n_train, n_types = count([(texts[:3], out_of[:3]), (texts[3:], out_of[3:])], [b"a"], 2)
        chunk = N.read_chunk(texts[3:], [b"a"], 2)
    finally:
        N.STRETCH_CHARS = old
    parsed = [C.tokens(t.decode()) for t in texts]
    once = Counter(w for own, h in zip(parsed, out_of) if not h for w in own)
    pairs = Counter(p for own, h in zip(parsed, out_of) if not h for p in zip(["start", *own], own))
    assert (n_train, n_types) == (sum(once.values()), len(once))
    flat = [w for own in parsed[3:] for w in own]
    both = [p for own in parsed[3:] for p in zip(["start", *own], own)]
    assert answers[1][0][chunk.kinds[0][1]].tolist() == [once[w] for w in flat]
    assert answers[1][2][chunk.kinds[2][1]].tolist() == [pairs[p] for p in both]


def test_scores_end_to_end(spark):
    rows = sample_rows()
    docs = spark.createDataFrame([(i, t, 0.5) for i, t in rows], "doc_id long, text string, score double")
    out = C.score_texts(docs.repartition(5)).collect()
    counts: Counter = Counter()
    for i, t in rows:
        if not held(i):
            counts.update(C.tokens(t))
    n, v = sum(counts.values()), len(counts)
    want = sorted((str(i), held(i), len(C.tokens(t)), sum(counts[w] > 0 for w in C.tokens(t)), n, round(sum(math.log10((counts[w] + 1) / (n + v + 1)) for w in C.tokens(t)), 6)) for i, t in rows)
    assert sorted((str(r.doc_id), r.held_out, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 6)) for r in out) == want
    assert all(r.score < 0 and math.isfinite(r.score) and abs(r.bits_per_byte + r.score / math.log10(2) / r.n_bytes) < 1e-9 for r in out)
    score = {r.doc_id: r.score for r in out}
    copies = [i for i in range(20) if not held(i) and not held(400 + i)]
    alone = [i for i in range(20, 250) if not held(i)]
    assert np.mean([score[i] for i in copies]) > 0.8 * np.mean([score[i] for i in alone])  # a text that occurs twice is foretold by its copy
    again = C.score_texts(docs.repartition(1)).collect()
    order = lambda rows: sorted((str(r.doc_id), r.n_bytes, r.score) for r in rows)
    assert order(out) == order(again)


def test_scores_without_training_rows(spark):
    docs = spark.createDataFrame([(i, "a b") for i in range(40) if zlib.crc32(str(i).encode()) % 7 == 2], "doc_id long, text string")
    out = C.score_texts(docs).collect()
    assert len(out) == docs.count() and all(r.train_tokens == 0 and r.n_known == 0 and r.score < 0 for r in out)
    assert C.score_texts(docs.limit(0)).count() == 0


def test_all_training_texts_and_words_teach(spark):
    """The query's model is the one of all training texts at once, texts of more than 20,000 bytes included."""
    rows = [(i, t) for i, t in sample_rows() if i is not None]
    texts, out_of = [(t or "").encode() for _, t in rows], np.array([held(i) for i, _ in rows])
    training = [t for t, h in zip(texts, out_of) if not h]
    assert max(map(len, training)) > 20_000
    listed = C.function_words(training)
    answers, n_train, n_types = count([(texts, out_of), (training, [True] * len(training))], listed, 0)
    model = C.learn_model(training, listed, answers[1], 0, n_train)
    chunk = N.read_chunk(training, listed, 0)
    asked = C.ask(C.read(chunk, answers[1], np.ones(len(training), dtype=bool), n_train, n_types))
    assert (model.asking.counts.sum(axis=(1, 2)) == len(asked.bit)).all()
    assert (model.spelling.counts.sum(axis=(1, 2)) == 8 * sum(len(w) + 1 for w in {w for t in training for w in C.tokens(t.decode())})).all()
    want = C.score_chunk(texts, out_of, answers[0], C.Model(model.asking, model.spelling, None, listed), 0, n_train, n_types)["score"]
    out = C.score_texts(spark.createDataFrame(rows, "doc_id long, text string").repartition(3)).collect()
    assert sorted((r.doc_id, round(r.score, 6)) for r in out) == sorted((i, round(float(s), 6)) for (i, _), s in zip(rows, want))


def test_a_training_text_is_scored_without_its_own_bits():
    rows = sample_rows()[:60]
    texts = [t.encode() for i, t in rows if not held(i)]
    listed = C.function_words(texts)
    answers, n_train, n_types = count([(texts, [False] * len(texts))], listed, 0)
    model = C.learn_model(texts, listed, answers[0], 0, n_train)
    reading = C.read(N.read_chunk(texts, listed, 0), answers[0], np.ones(len(texts), dtype=bool), n_train, n_types)
    got = C.asking_costs(reading, C.ask(reading), model.asking, own_out=True)
    for i in (0, 7, len(texts) - 1):
        one = reading.of(np.arange(len(texts)) == i)
        tally = C.Tally(model.asking)
        C.tally_texts(one, tally, model.asking)
        a = model.asking
        others = C.Mixer(a.counts - tally.counts, a.weights, a.map, a.curve)
        assert abs(C.asking_costs(one, C.ask(one), others)[0] - got[i]) < 1e-6 * got[i]


def test_tallies_add_up_whatever_the_cut():
    rows = sample_rows()[:40]
    texts = [t.encode() for _, t in rows]
    listed = C.function_words(texts)
    answers, n_train, n_types = count([(texts, [False] * len(texts))], listed, 0)
    mixer = C.learn_model(texts, listed, answers[0], 0, n_train).asking
    reading = C.read(N.read_chunk(texts, listed, 0), answers[0], np.ones(len(texts), dtype=bool), n_train, n_types)

    def sums(size):
        told = {}
        for at in range(0, len(texts), size):
            tally = C.Tally(mixer)
            which = np.arange(len(texts))
            C.tally_texts(C.Reading.from_blob(reading.of((which >= at) & (which < at + size)).blob()), tally, mixer)
            for key, blob in tally.rows():
                told.setdefault(key, []).append((key, blob))
        return {key: C.added(own)[1] for key, own in told.items()}

    assert sums(len(texts)) == sums(7) == sums(1)


def test_no_generation_is_left_out_of_weights_and_map():
    """Each bit is counted once and hits the map once, whichever generation its text is in."""
    texts = [t.encode() for _, t in sample_rows()[:90]]
    listed = C.function_words(texts)
    answers, n_train, n_types = count([(texts, [False] * len(texts))], listed, 0)
    model = C.learn_model(texts, listed, answers[0], 0, n_train)
    asked = C.ask(C.read(N.read_chunk(texts, listed, 0), answers[0], np.ones(len(texts), dtype=bool), n_train, n_types))
    spelled = 8 * sum(len(w) + 1 for w in {w for t in texts for w in C.tokens(t.decode())})
    for mixer, first, bits in ((model.asking, C.first_mixer(5, C.ASK_GATES, 1), len(asked.bit)), (model.spelling, C.first_mixer(6, C.SPELL_GATES, 1), spelled)):
        assert (mixer.map - first.map)[:, :, 1].sum() == bits and (mixer.counts.sum(axis=(1, 2)) == bits).all()


def test_words_that_begin_alike_are_spelled_once(monkeypatch):
    """Shared bits are tallied once, with the sums of all of them; costs are those of each word spelled by itself."""
    rng = random.Random(7)
    some = sorted({("stemword" + w).encode() for w in words(rng, ["th", "an", "er", "on"], 400).split()} | {b"x", b"z" * 70_000})
    rng.shuffle(some)
    mixer, bits = C.learn_spelling(some[: len(some) // 2]), []
    shared, plain = C.Tally(mixer), C.Tally(mixer)
    slots, bit, _, inside = C.spelling_bits(some)
    plain.add(slots, inside, bit, mixer, C.spelling_gate)
    add = C.Tally.add
    monkeypatch.setattr(C.Tally, "add", lambda self, s, k, b, *rest, **more: (bits.append(len(b)), add(self, s, k, b, *rest, **more))[1])
    C.tally_words(some, shared, mixer)
    assert sum(bits) < 8 * 71_000 + 0.6 * (len(bit) - 8 * 70_000)
    for name in ("counts", "hits", "slope", "curve"):
        assert (getattr(shared, name) == getattr(plain, name)).all(), name
    taught = np.array([i < len(some) // 2 for i in range(len(some))])
    together = C.spelling_costs(some, taught, mixer)
    assert together.tolist() == [C.spelling_costs([w], taught[i : i + 1], mixer)[0] for i, w in enumerate(some)]


def test_kept_texts_are_small():
    """A text is kept for reading again in less than its own size, nearly all its words being different."""
    rng = random.Random(8)
    texts = [" ".join("".join(rng.choices("etaoinshrdlu", k=rng.randint(4, 9))) for _ in range(300)).encode() for _ in range(40)]
    answers, n_train, n_types = count([(texts, [False] * len(texts))], [], 0)
    reading = C.read(N.read_chunk(texts, [], 0), answers[0], np.ones(len(texts), dtype=bool), n_train, n_types)
    assert len(reading.blob()) < sum(map(len, texts))


@pytest.mark.parametrize("common", [0.0, 1e-3, 1e-2, 0.9])
def test_most_used_words(spark, monkeypatch, common):
    monkeypatch.setattr(C, "COMMON", common)
    monkeypatch.setattr(N, "CHUNK_BYTES", 2000)
    rng = random.Random(11)
    vocabulary = [f"w{i}" for i in range(200)]
    rows = [(i, held(i), " ".join(rng.choices(vocabulary, weights=[1 / (j + 3) for j in range(200)], k=50))) for i in range(60)]
    rows += [(100, False, None), (101, False, "\x0bW5 w5\n")]
    listed = C.most_used_words(N.packed(spark.createDataFrame(rows, "doc_id long, held_out boolean, text string")))
    assert listed == C.function_words([(t or "").encode() for _, h, t in rows if not h])
