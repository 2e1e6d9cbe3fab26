import math
import zlib
from collections import Counter

import numpy as np
import pytest
from conftest_llm import ODD, documents

from tamis.llm import lm_scoring as M
from tamis.llm import recurrent as R
from tamis.llm.words import spaced_words


TOKENS = 1024
EDGES = R.class_edges(np.array([0.1, 0.2, *(0.7 / np.arange(1, TOKENS - 1) / sum(1 / np.arange(1, TOKENS - 1)))]))


@pytest.fixture(scope="module")
def model():
    rng = np.random.default_rng(1)
    return {k: rng.normal(0, 0.3, s).astype(np.float32) for k, s in R.shapes(EDGES).items()}


def sequences(seed, n=9):
    rng = np.random.default_rng(seed)
    return [np.append(rng.integers(1, TOKENS, rng.integers(0, 150)), R.END).astype(np.int16) for _ in range(n)]


def step_by_step(p, edges, words):
    """Log likelihood of one text by the definition of the cell, one step at a time."""
    h, given, total = np.zeros(R.HIDDEN), R.END, 0.0
    H = R.HIDDEN
    for wanted in words:
        a = p["embed"][given] @ p["input"] + p["gate_bias"]
        b = h @ p["state"]
        z = 1 / (1 + np.exp(-(a[:H] + b[:H])))
        r = 1 / (1 + np.exp(-(a[H : 2 * H] + b[H : 2 * H])))
        n = np.tanh(a[2 * H :] + r * b[2 * H :])
        h = (1 - z) * n + z * h
        c = next(i for i in range(len(edges) - 1) if edges[i] <= wanted < edges[i + 1])
        own = p["word_out"][edges[c] : edges[c + 1]]
        classes = p["class_out"][:, :-1] @ h + p["class_out"][:, -1]
        words_of = own[:, :-1] @ h + own[:, -1]
        total += classes[c] - np.log(np.exp(classes).sum())
        total += words_of[wanted - edges[c]] - np.log(np.exp(words_of).sum())
        given = wanted
    return total


def test_classes_of_rare_tokens_are_larger():
    sizes = np.diff(EDGES)
    assert EDGES[0] == R.END and EDGES[-1] == TOKENS and sizes[:2].tolist() == [1, 1]
    assert sizes.min() > 0 and sizes[2] < sizes[len(sizes) // 2] < sizes[-2]
    assert R.class_edges(np.array([0.5, 0.5])).tolist() == [0, 1, 2]


def test_whole_texts_across_windows(model):
    given = sequences(2)
    found = R.log_likelihoods(model, EDGES, given)
    assert np.allclose(found, [step_by_step(model, EDGES, s) for s in given], rtol=1e-4)


def test_gradients_match_differences(model):
    p = {k: v.astype(np.float64) for k, v in model.items()}
    streams = R.laid_out(sequences(3, 5))
    given, wanted, first, text = next(streams.windows())
    h = np.random.default_rng(4).normal(0, 0.5, (given.shape[1], R.HIDDEN))
    real = text >= 0

    def loss(q):
        return R.gradients(q, EDGES, given, wanted, first, real, h)[2] / real.sum()

    g = {k: np.zeros_like(v) for k, v in p.items()}
    for k, rows, x in R.gradients(p, EDGES, given, wanted, first, real, h)[0].parts():
        g[k][rows] = x
    for k in g:
        for at in np.argsort(-np.abs(g[k]).ravel())[:3]:
            at = np.unravel_index(at, p[k].shape)
            up, down = ({**p, k: p[k].copy()} for _ in range(2))
            up[k][at] += 1e-4
            down[k][at] -= 1e-4
            assert g[k][at] == pytest.approx((loss(up) - loss(down)) / 2e-4, rel=2e-2, abs=1e-5)


def test_likelihoods_of_all_tokens_sum_to_one(model):
    every = [np.array([w], np.int16) for w in range(TOKENS)]
    assert np.exp(R.log_likelihoods(model, EDGES, every)).sum() == pytest.approx(1, abs=1e-4)


def in_fold(doc_id, fold):
    return doc_id is not None and zlib.crc32(str(doc_id).encode()) % 5 == fold


def check_counts(found, rows):
    train = [spaced_words(t) + [b""] for d, t, *_ in rows if d is not None and not in_fold(d, 1)]
    counts = Counter(w for words in train for w in words)
    total, types = sum(counts.values()), len(counts)
    expected = []
    for doc_id, text, *_ in rows:
        words = spaced_words(text) + [b""]
        base = sum(math.log10((counts[w] + 0.5) / (total + 0.5 * (types + 1))) for w in words)
        known = sum(counts[w] > 0 for w in words)
        expected.append((str(doc_id), in_fold(doc_id, 1), len(words), known, total, round(base, 6)))
    got = [(str(r.doc_id), r.held_out, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 6)) for r in found]
    assert sorted(got) == sorted(expected)
    assert all(np.isfinite(r.score) and r.score < 0 for r in found)


@pytest.mark.parametrize("head", [M.HEAD, 3])
def test_counts_match_brute_force(spark, head, monkeypatch):
    rows = ODD + [(50 + i, f"the word {i % 4} of the day and the rest {'x' * (i % 3)}") for i in range(30)]
    original = M.head_of
    monkeypatch.setattr(M, "head_of", lambda counts: original(counts, head))
    check_counts(M.op8_lm(documents(spark, rows)).collect(), rows)


def test_empty_tables(spark, none):
    assert M.op8_lm(none).collect() == []
    alone = next(d for d in range(100) if in_fold(d, 1))
    rows = [(alone, "no training text"), (None, "none at all"), (alone, None)]
    check_counts(M.op8_lm(documents(spark, rows)).collect(), rows)


def test_better_than_counts_on_held_out_texts(spark):
    found = M.op8_lm(spark.read.parquet("/root/testdata/sf0.01/documents.parquet")).collect()
    held = [r for r in found if r.held_out]
    assert sum(r.score for r in held) > 0.98 * sum(r.base_score for r in held)
    assert np.mean([r.score > r.base_score for r in held]) > 0.9


def reference(rows, ids, vocabulary, replicas):
    """The model trained in this process: round by round, replica by replica, in the order of the
    hashes (``ids``: place of every training row)."""
    edges, p = vocabulary.edges, R.initial(vocabulary.shares)
    for k in range(M.ROUNDS):
        changes, seen = [], []
        for replica in range(replicas):
            own = sorted((place, t or "") for place, t in ids if place % replicas == replica)
            own = [t for place, t in own if (place % 2**64 >> 32) % M.ROUNDS == k]
            trainer = R.Trainer(p, edges)
            for t in own:
                trainer.add(vocabulary.token[vocabulary.places(spaced_words(t))])
            trainer.learn()
            changes.append({key: (trainer.p[key] - p[key]).astype(np.float16) for key in p})
            seen.append(trainer.seen)
        if sum(seen):
            p = {
                key: (p[key] + sum(c[key].astype(float) * n for c, n in zip(changes, seen)) / sum(seen)).astype(np.float32)
                for key in p
            }
    return p


def test_scores_match_one_process_and_do_not_depend_on_partitions(spark, monkeypatch):
    monkeypatch.setattr(M, "REPLICA_TOKENS", 3000)
    rng = np.random.default_rng(7)
    rows = [(d, " ".join(f"w{int(w)}" for w in rng.zipf(1.3, rng.integers(0, 90)))) for d in range(300)]
    rows += [(300, "a long text of few words " * 2000), (301, None)]
    docs = documents(spark, rows)
    one, many = (M.op8_lm(docs.repartition(n, "doc_id")).collect() for n in (1, 31))
    score = {r.doc_id: r.score for r in one}
    assert {r.doc_id: r.score for r in many} == pytest.approx(score, rel=1e-6)

    counts = Counter(w for d, t in rows if not in_fold(d, 1) for w in spaced_words(t) + [b""])
    pairs = sorted(counts.items(), key=lambda x: (-x[1], x[0]))
    total = sum(counts.values())
    vocabulary = M.Vocabulary([w for w, _ in pairs], np.array([float(c) for _, c in pairs]), total, len(counts))
    places = docs.selectExpr("doc_id", "text", "xxhash64(doc_id, text) AS place").collect()
    replicas = M.replicas_for(total)
    assert replicas > 2
    p = reference(rows, [(r.place, r.text) for r in places if not in_fold(r.doc_id, 1)], vocabulary, replicas)
    for d, t in rows[::7] + rows[-2:]:
        words = spaced_words(t) + [b""]
        tokens = [vocabulary.token[vocabulary.place.get(w, -1)] for w in words]
        expected = step_by_step(p, vocabulary.edges, tokens) / math.log(10)
        expected += sum(
            math.log10(counts[w] + 0.5) - vocabulary.rest for w, k in zip(words, tokens) if k == R.UNKNOWN
        )
        assert score[d] == pytest.approx(expected, rel=1e-4)


def test_every_frequent_word_has_a_token_of_its_own():
    words = [b"", *(b"w%d" % i for i in range(5000))]
    counts = np.array([900.0] + [50.0] * 4000 + [1.0] * 1000)
    vocabulary = M.Vocabulary(words, counts, int(counts.sum()), len(words))
    own = vocabulary.token[1:4001]
    assert len(set(own)) == 4000 and R.UNKNOWN not in own
    assert set(vocabulary.token[4001:]) == {R.UNKNOWN}
    assert R.initial(vocabulary.shares)["embed"].shape[0] > own.max()


def test_order_of_words_beyond_the_smallest_model_counts(spark):
    rng = np.random.default_rng(5)
    # The frequent words fill the smallest model; each of the others stands before its partner.
    frequent = " ".join(f"f{i}" for i in range(R.SIZE + 76))
    pairs = [[f"a{i} b{i}" for i in rng.permutation(60)] for _ in range(40)]
    train = [d for d in range(200) if not in_fold(d, 1)][:40]
    alone = [d for d in range(200, 300) if in_fold(d, 1)][:2]
    rows = [(d, f"{frequent} {frequent} {' '.join(own)}") for d, own in zip(train, pairs)]
    text = pairs[0]
    rows += [(alone[0], " ".join(text)), (alone[1], " ".join(" ".join(reversed(p.split())) for p in text))]
    score = {r.doc_id: r.score for r in M.op8_lm(documents(spark, rows)).collect()}
    assert abs(score[alone[0]] - score[alone[1]]) > 0.01
