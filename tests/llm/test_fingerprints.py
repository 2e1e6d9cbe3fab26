import hashlib
import re
import zlib

import pytest
from conftest_llm import LONG, ODD, documents

from tamis.llm import fingerprints as M

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LOWER = {c: c + 32 for c in range(65, 91)}


def codes(text):
    words = WORD.findall(text.translate(LOWER))
    content = [i for i, w in enumerate(words) if w not in M.ANCHORS]
    pairs = list(zip(content, content[1:]))
    found = [
        f"{words[i - 1]} {words[i]} {words[j]} " for i, j in pairs if i and words[i - 1] in M.ANCHORS
    ] or [f"{words[i]} {words[j]} " for i, j in pairs]
    if not found and words:
        found = [f" {' '.join(words)} "]
    return sorted({zlib.crc32(s.encode()) for s in found})


def likeness(a, b):
    if not a and not b:
        return 1.0
    small, large = sorted((len(a), len(b)))
    both = len(set(a) & set(b))
    return 0.0 if small < large * M.LEAST else both / (small + large - both)


def brute(rows):
    ids = sorted({d for d, *_ in rows}, key=lambda d: (d is not None, d))
    texts = {d: [t or "" for e, t, *_ in rows if e == d] for d in ids}
    out = []
    for doc_id, text, *_ in rows:
        text = text or ""
        following = texts[ids[(ids.index(doc_id) + 1) % len(ids)]]
        options = []
        for other in following:
            q = len(text) // 4
            edited = text[: len(text) - q] + other[:q]
            own, changed, nxt = codes(text), codes(edited), codes(other)
            options.append(
                (
                    doc_id, len(text), hashlib.sha256(edited.encode()).hexdigest(),
                    "".join(f"{c:08x}" for c in own), "".join(f"{c:08x}" for c in changed),
                    likeness(own, changed), likeness(own, nxt),
                )
            )
        out.append(options)
    return out


PROSE = [
    (30, "The fox and the hound went to the river in the morning for a swim with the otter."),
    (31, "The fox and the hound went to the river in the evening for a swim with the badger."),
    (32, "le chat de la maison et le chien dans les champs pour une promenade"),
    (33, "nothing"),
    (34, "of the and"),
    (35, "The cat sat on the mat. " * 50),
]


@pytest.mark.parametrize("broadcast", [True, False])
def test_matches_brute_force(spark, broadcast, monkeypatch):
    if not broadcast:
        monkeypatch.setattr(M, "NEIGHBOUR_BYTES", -1)
    given = ODD + PROSE
    found = sorted((tuple(r) for r in M.op3_fingerprints(documents(spark, given)).collect()), key=repr)
    assert len(found) == len(given)
    # Of rows that share an id, any may stand for it, but the same for all that precede them.
    expected = brute(given)
    assert all(any(tuple(f) in options for options in expected) for f in found)


def test_equal_texts_have_equal_fingerprints(spark):
    given = [(i, ("The same fox in the same wood", LONG, "")[i % 3]) for i in range(9)]
    found = M.op3_fingerprints(documents(spark, given)).collect()
    for k in range(3):
        assert len({r.fingerprint for r in found if r.doc_id % 3 == k}) == 1


def test_one_document_is_its_own_next(spark):
    row = M.op3_fingerprints(documents(spark, [(1, "The fox and the hound in the wood")])).first()
    assert row.near_next == 1.0


def test_partitions_only_leave_out_unlike_sizes(spark):
    found = M.fingerprints(documents(spark, PROSE)).select("signatures", "partition").collect()
    assert all(len(r.signatures) >= (1 / M.LEAST) ** r.partition * 0.999 for r in found if r.signatures)


def test_empty_table(none):
    assert M.op3_fingerprints(none).collect() == []
