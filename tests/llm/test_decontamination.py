import hashlib
import re

from conftest_llm import ODD, documents

from tamis.llm.decontamination import drop_contaminated, find_passages, op2_decontamination

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LOWER = {c: c + 32 for c in range(65, 91)}
ITEMS = [
    (1, "The quick brown fox jumps over the lazy dog while eleven cats watch it go."),
    (2, "Short item"),
    (3, "the quick brown FOX jumps over the lazy dog while nobody sees"),
    (4, None),
    (5, "... !"),
    (None, "item without an id"),
    (2, "Short item"),
    (10, "one two three four five six seven eight nine ten eleven"),
]
DOCS = ODD + [
    (20, "A short  ITEM, and so on."),
    (21, "Yes: The quick,brown fox\njumps over the lazy dog while - here it ends. Short item short item"),
    (22, "the quick brown fox jumps over the lazy cat while eleven cats watch"),
    (23, "an item without an id stands here"),
    (24, "Short Êitem"),
]


def words(text):
    return WORD.findall((text or "").translate(LOWER))


def brute(doc_id, text):
    own, hit, items = words(text), set(), set()
    for item, item_text in ITEMS:
        of = words(item_text)
        size = min(10, len(of))
        for i in range(len(of) - size + 1 if of else 0):
            for j in range(len(own) - size + 1):
                if own[j : j + size] == of[i : i + size]:
                    hit |= set(range(j, j + size))
                    items |= set() if item is None else {str(item)}
    digest = hashlib.sha256(",".join(sorted(items)).encode()).hexdigest()
    return doc_id, len(own), len(hit), len(items), digest, bool(hit)


def benchmark(spark):
    return spark.createDataFrame([(i, t, "x") for i, t in ITEMS], "item_id long, text string, passages string")


def rows(df):
    return sorted(map(tuple, df.collect()), key=repr)


def test_matches_brute_force(spark):
    expected = sorted((brute(*d[:2]) for d in DOCS), key=repr)
    assert rows(op2_decontamination(documents(spark, DOCS), benchmark(spark))) == expected


def test_blocks_of_items_change_nothing(spark):
    docs = documents(spark, DOCS)
    one = find_passages(docs, benchmark(spark), keep=["doc_id"])
    for held_bytes in (1, 1 << 26):
        many = find_passages(docs, benchmark(spark), keep=["doc_id"], block_bytes=20, held_bytes=held_bytes)
        assert rows(one) == rows(many)


def test_automata_of_a_task_are_built_once_for_many_batches(spark, monkeypatch):
    import pyarrow as pa

    from tamis.llm.decontamination import Automaton, held

    batches = [pa.RecordBatch.from_pydict({"t": ["x" * 100] * 10}) for _ in range(50)]
    assert [len(g) for g in held(iter(batches), 1 << 26)] == [50]
    sizes = [len(g) for g in held(iter(batches), 5000)]
    assert sum(sizes) == 50 and 5 <= min(sizes[:-1]) + 1 and max(sizes) <= 5
    # windows with words that no text has are left out, others keep their places
    items = [("a", "one two three four"), ("b", "three four five"), ("c", "two"), ("d", "six")]
    numbers = {b"one": 1, b"two": 2, b"three": 3, b"four": 4}
    found = list(Automaton(items, 2, numbers).scan([4, 1, 2, 3, 4]))
    assert sorted((s, e, *sorted(o)) for s, e, o in found) == [
        (1, 3, "a"), (2, 3, "c"), (2, 4, "a"), (3, 5, "a", "b")
    ]


def test_spans_are_places_in_the_original_text(spark):
    found = find_passages(documents(spark, DOCS), benchmark(spark), keep=["doc_id", "text"])
    by_id = {r.doc_id: [r.text[s.start : s.end] for s in r.passages.spans] for r in found.collect()}
    assert by_id[20] == ["short  ITEM"]
    assert by_id[21] == ["The quick,brown fox\njumps over the lazy dog while", "Short item short item"]
    assert by_id[22] == [] and by_id[24] == []


def test_clean_documents_stay_as_they_are(spark):
    docs = documents(spark, DOCS).withColumnRenamed("t", "passages")
    kept = drop_contaminated(docs, benchmark(spark))
    assert kept.columns == docs.columns
    clean = [d for d in DOCS if not brute(*d[:2])[5]]
    assert sorted(((r.doc_id, r.text) for r in kept.collect()), key=repr) == sorted((d[:2] for d in clean), key=repr)


def test_empty_tables(spark, odd, none):
    assert op2_decontamination(none, benchmark(spark)).collect() == []
    found = op2_decontamination(odd, benchmark(spark).where("false")).collect()
    assert len(found) == len(ODD) and not any(r.contaminated for r in found)
