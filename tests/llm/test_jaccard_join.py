import random

import numpy as np
import pytest
from conftest_llm import ODD, documents

from tamis.llm import jaccard_join as M
from tamis.llm.words import spaced_words


def grams(text):
    words = spaced_words(text)
    if len(words) < 5:
        return frozenset([tuple(words)] if words else [])
    return frozenset(tuple(words[i : i + 5]) for i in range(len(words) - 4))


def components(rows):
    """The component of every row, as the index of one of its rows."""
    sets = [grams(t) for _, t, *_ in rows]
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if both and 100 * both >= 80 * (len(sets[i]) + len(sets[j]) - both):
                root[find(i)] = find(j)
    return [find(i) for i in range(len(rows))]


def brute(rows):
    of, out = components(rows), []
    for i, (doc_id, text, *_) in enumerate(rows):
        own = [rows[j][0] for j in range(len(rows)) if of[j] == of[i] and rows[j][0] is not None]
        n = len(grams(text))
        out.append((doc_id, n, min(own, default=None) if n else doc_id))
    return sorted(out, key=repr)


def rows(df):
    return sorted(map(tuple, df.collect()), key=repr)


def corpus(seed, n=260):
    """Random texts of all sizes, near copies at and around the threshold, chains of edits, and
    a passage that many texts share."""
    rng = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(4000)]
    passage = rng.choices(vocabulary, k=60)
    texts = []
    for _ in range(n // 4):
        texts.append(rng.choices(vocabulary, k=rng.choice([1, 3, 4, 5, 6, 8, 9, 13, 30, 60, 66, 70, 130, 300])))
    for _ in range(n // 4):
        texts.append(passage + rng.choices(vocabulary, k=rng.choice([10, 14, 17, 20, 40, 200])))
    for _ in range(n // 2):
        base = list(rng.choice(texts))
        edits = rng.choice([0, 1, 1, 2, 3, max(1, len(base) // 45), max(1, len(base) // 40)])
        for _ in range(edits):
            at = rng.randrange(len(base))
            if rng.random() < 0.5:
                base[at] = rng.choice(vocabulary)
            else:
                base[at:at] = rng.choices(vocabulary, k=rng.choice([1, 5]))
        if rng.random() < 0.3:
            base = base[: max(1, int(len(base) * rng.choice([0.79, 0.8, 0.82, 0.95])))]
        texts.append(base)
    return [(i * 7 % 1009, " ".join(t)) for i, t in enumerate(texts)]


@pytest.mark.parametrize("seed", [1, 2])
def test_matches_brute_force(spark, seed):
    given = corpus(seed)
    assert rows(M.op5_jaccard_join(documents(spark, given))) == brute(given)


def test_every_way_gives_the_same(spark, monkeypatch):
    monkeypatch.setattr(M, "ID_BYTES", -1)  # ids shuffled
    monkeypatch.setattr(M, "PAIRS_PER_ROW", 0)  # stars as long as they help
    given = corpus(3)
    assert rows(M.op5_jaccard_join(documents(spark, given))) == brute(given)


@pytest.mark.parametrize("bits", [8, 9])
def test_clashing_numbers_of_sets_are_told_apart(spark, monkeypatch, bits):
    monkeypatch.setattr(M, "NODE_BITS", bits)
    given = corpus(6, 80)
    assert rows(M.op5_jaccard_join(documents(spark, given))) == brute(given)
    of_sets = {M.shingles(t).tobytes() for _, t in given}
    one_hash = {M.node_of(np.frombuffer(s, np.uint64), bits=bits) for s in of_sets}
    assert len(one_hash) < len(of_sets)  # there were clashes


def test_odd_rows(spark, odd):
    assert rows(M.op5_jaccard_join(odd)) == brute(ODD)


def test_one_of_each(spark):
    given = corpus(4) + ODD
    docs = documents(spark, given)
    kept = M.one_of_each(docs)
    assert kept.columns == docs.columns
    of = components(given)
    names = []  # one for each component with words
    for root in set(of):
        own = [given[i][0] for i in range(len(given)) if of[i] == root]
        if grams(given[root][1]):
            names.append(min((d for d in own if d is not None), default=None))
    found = kept.collect()
    with_words = [r.doc_id for r in found if grams(r.text)]
    assert sorted(with_words, key=repr) == sorted(names, key=repr)
    assert len(found) - len(with_words) == sum(not grams(t) for _, t, *_ in given)


def test_sketches_differ_in_at_most_the_symmetric_difference():
    rng = random.Random(5)
    for _ in range(200):
        a = [f"w{rng.randrange(99999)}" for _ in range(rng.randrange(70, 400))]
        b = list(a)
        for _ in range(rng.randrange(1, 8)):
            b[rng.randrange(len(b))] = "new"
        x, y = (M.shingles(" ".join(t)) for t in (a, b))
        apart = len(set(x.tolist()) ^ set(y.tolist()))
        bits = [np.unpackbits(M.parity_bits(s).view(np.uint8)) for s in (x, y)]
        assert (bits[0] != bits[1]).sum() <= apart
        for band in set(M.bands(len(x))) & set(M.bands(len(y))):
            kx, ky = set(M.sketch(x, band).tolist()), set(M.sketch(y, band).tolist())
            assert max(len(kx - ky), len(ky - kx)) <= apart


def test_pieces_change_nothing(monkeypatch):
    text = " ".join(f"Wörd{i}\t\n{'x' * (i % 50)}" for i in range(500)) + "  "
    whole = M.word_hashes(text)
    assert len(whole) == len(spaced_words(text)) and len(set(whole.tolist())) == len(set(spaced_words(text)))
    for piece in (1, 7, 1000):
        monkeypatch.setattr(M, "PIECE", piece)
        assert M.word_hashes(text).tolist() == whole.tolist()


def test_empty_table(none):
    assert M.op5_jaccard_join(none).collect() == []
