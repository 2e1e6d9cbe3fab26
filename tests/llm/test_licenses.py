import re

from conftest_llm import ODD, documents
from hypothesis import given, settings
from hypothesis import strategies as st

from tamis.llm.licenses import PHRASES, TEMPLATES, Matcher, SuffixAutomaton, find_licenses, op4_licenses
from tamis.llm.words import alnum_words

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LOWER = {c: c + 32 for c in range(65, 91)}
MIT = next(t for label, t in TEMPLATES if label == "mit" and t.startswith("Permission"))
DOCS = ODD + [
    (40, "See the GNU General Public License. The GNU general public-license!"),
    (41, "CC BY CC BY cc by"),
    (42, "Licensed under CC BY-NC 4.0."),
    (43, "Preface. " + MIT.upper() + " The end. " + MIT),
    (44, "Permission is hereby granted to nobody. mit licenses, the mitlicense"),
    (45, "/* " + " ".join(MIT.split()[:60]) + " [..] " + " ".join(MIT.split()[64:]) + " */"),
    (46, "This work is licensed under the GNU General Public License, version 3."),
]

letters = st.lists(st.sampled_from([b"a", b"b", b"c"]), max_size=12)


@settings(max_examples=150, deadline=None)
@given(st.lists(letters, max_size=4), st.lists(st.sampled_from([b"a", b"b", b"c", b"d"]), max_size=25))
def test_runs_are_the_longest_common_ones(sequences, words):
    automaton = SuffixAutomaton(sequences)
    inside = {tuple(s[i:j]) for s in sequences for i in range(len(s)) for j in range(i + 1, len(s) + 1)}

    def longest(stop):
        return max([k for k in range(stop + 1) if tuple(words[stop - k : stop]) in inside], default=0)

    expected = []
    for stop in range(1, len(words) + 1):
        k = longest(stop)
        if k >= 2 and (stop == len(words) or longest(stop + 1) != k + 1):
            expected.append((stop, k))
    found = list(automaton.runs(words, 2))
    assert [(stop, k) for stop, k, _ in found] == expected
    for stop, k, state in found:
        ends = {(t, j) for t, s in enumerate(sequences) for j in range(k, len(s) + 1) if s[j - k : j] == words[stop - k : stop]}
        assert set(automaton.ends[state]) == ends


def test_base_columns_match_brute_force(spark):
    found = {(r.doc_id, r.n_words): r for r in op4_licenses(documents(spark, DOCS)).collect()}
    for doc_id, text, *_ in DOCS:
        own = WORD.findall((text or "").translate(LOWER))
        places = [
            (i, label) for phrase, label in PHRASES.items() for i in range(len(own))
            if own[i : i + len(phrase.split())] == phrase.split()
        ]
        row = found[doc_id, len(own)]
        assert row.n_base == len(places)
        assert row.first_word == min((i for i, _ in places), default=None)
        assert row.last_word == max((i for i, _ in places), default=None)
        assert row.base_labels == ",".join(sorted({label for _, label in places}))
        assert set(filter(None, row.base_labels.split(","))) <= set(row.labels.split(","))
        assert 0 <= row.score <= 1


def test_notices_are_found_whole_and_with_gaps(spark):
    rows = {r.doc_id: r for r in find_licenses(documents(spark, DOCS)).collect() if (r.doc_id or 0) >= 40}
    assert rows[42].license.labels == ["cc-by", "cc-by-nc-4.0"]
    assert [s.label for s in rows[43].license.spans] == ["mit", "mit"]
    assert all(s.coverage > 0.99 for s in rows[43].license.spans)
    first = rows[43].license.spans[0]
    assert rows[43].text[first.start : first.stop].startswith("PERMISSION IS HEREBY")
    assert rows[44].license.labels == []
    assert rows[45].license.labels == ["mit"] and len(rows[45].license.spans) == 1
    assert rows[46].license.labels == ["gpl", "gpl-3.0"]


def test_many_notices_in_one_text():
    matcher = Matcher([(label, alnum_words(t)) for label, t in TEMPLATES])
    spans = matcher.spans(alnum_words((MIT + " and so on ") * 200))
    assert len(spans) == 200


def test_empty_table(none):
    assert op4_licenses(none).collect() == []


def test_a_template_inside_a_longer_run_of_another(spark):
    short = 'Licensed under the Apache License, Version 2.0'
    whole = next(t for label, t in TEMPLATES if label == "apache-2.0" and len(t) > 100)
    gapped = whole.replace("Unless required by applicable law", "Except where forbidden")
    docs = [
        (1, f'{short} (the "License"); see LICENSE file'),
        (2, f"Before. {whole} After."),
        (3, f"Before. {gapped} After."),
        (4, 'under the Apache License, Version 2.0 (the "License")'),
    ]
    found = {r.doc_id: (r.text, r.license) for r in find_licenses(documents(spark, docs)).collect()}
    assert all(lic.labels == ["apache", "apache-2.0"] and len(lic.spans) == 1 for _, lic in found.values())
    spans = {d: (text[lic.spans[0].start : lic.spans[0].stop], lic.score) for d, (text, lic) in found.items()}
    assert spans[1] == (short, 1.0)
    assert spans[2][1] == 1.0 and spans[2][0] == whole.rstrip(".")
    assert spans[3][1] == 1.0 and spans[3][0] == gapped.rstrip(".")
    assert spans[4] == ("under the Apache License, Version 2.0", 7 / 8)
    matcher = Matcher([("outer", alnum_words("a b c d e f g h i j k l m n o p")), ("inner", alnum_words("d e f g h"))])
    assert matcher.spans(alnum_words("x b c d e f g h i x")) == [("inner", 3, 8, 1.0)]
