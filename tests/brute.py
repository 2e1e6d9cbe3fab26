"""Plain Python versions of the model and the score, for small fixtures."""

from __future__ import annotations

import math
from collections import Counter, defaultdict

BOS, EOS, UNK = "<s>", "</s>", "<unk>"


def vocabulary(texts):
    counts = Counter(w for t in texts for w in t.split())
    return {w for w, c in counts.items() if c > 1}


def train(texts, vocab, order=5, fallback=(0.5, 1.0, 1.5)):
    sentences = []
    for text in texts:
        words = [w for w in text.split() if w in vocab and w not in (BOS, EOS, UNK)]
        sentences.append([BOS, *words, EOS])
    raw = Counter()
    for s in sentences:
        for i in range(len(s)):
            for n in range(1, order + 1):
                if i + n <= len(s):
                    raw[tuple(s[i : i + n])] += 1
    before = defaultdict(set)
    for g in raw:
        before[g[1:]].add(g[0])
    a = {}
    for g, c in raw.items():
        if g == (BOS,):
            continue
        a[g] = c if len(g) == order or g[0] == BOS else len(before[g])
    disc = {}
    for n in range(1, order + 1):
        t = Counter(v for g, v in a.items() if len(g) == n)
        disc[n] = fallback
        if t[1] and t[2] and t[3]:
            y = t[1] / (t[1] + 2 * t[2])
            d = tuple(k - (k + 1) * y * t[k + 1] / t[k] for k in (1, 2, 3))
            if all(0 < x <= k for k, x in zip((1, 2, 3), d)):
                disc[n] = d
    total, mass = Counter(), Counter()
    for g, v in a.items():
        total[g[:-1]] += v
        mass[g[:-1]] += disc[len(g)][min(v, 3) - 1]
    b = {h: mass[h] / total[h] for h in total}
    types = sum(1 for g in a if len(g) == 1) + 1
    p = {(UNK,): b[()] / types}
    for g in sorted(a, key=len):
        lower = p[g[1:]] if len(g) > 1 else 1 / types
        p[g] = (a[g] - disc[len(g)][min(a[g], 3) - 1]) / total[g[:-1]] + b[g[:-1]] * lower
    return {"p": p, "b": b, "discounts": disc, "adjusted": a, "order": order}


def score(text, model):
    """Positions, total log10 probability and unknown words, by search for the longest gram."""
    words = [UNK if w in (BOS, EOS, UNK) else w for w in (text or "").split()] or [UNK]
    s = [BOS, *words, EOS]
    p, b, order = model["p"], model["b"], model["order"]
    total, oov = 0.0, 0
    for e in range(1, len(s)):
        longest = 0
        for n in range(1, order + 1):
            start = e - n + 1
            if start < 0 or UNK in s[start : e + 1]:
                break
            if tuple(s[start : e + 1]) in p:
                longest = n
        if longest:
            total += math.log10(p[tuple(s[e - longest + 1 : e + 1])])
        else:
            total += math.log10(p[(UNK,)])
            oov += 1
            longest = 1
        for m in range(longest, order):
            start = e - m
            if start >= 0 and tuple(s[start:e]) in b and UNK not in s[start:e]:
                total += math.log10(b[tuple(s[start:e])])
    return len(s) - 1, total, oov


def rank(rows, ascending=False):
    """``rows`` of (seg_id, score, src, tgt) without repeats, best first."""
    kept = {}
    for seg_id, value, src, tgt in rows:
        key = (value, src.encode(), tgt.encode())
        kept[key] = min(seg_id, kept.get(key, seg_id))
    ordered = sorted(kept, reverse=not ascending)
    return [kept[key] for key in ordered]
