"""Words as numbers, in Arrow batches: cutting texts into numbered tokens, and walking over sorted grams.

Spark deals out, shuffles and sorts the rows; a task sees them in order, some hundred thousand at a
time, as arrays. A row holds the words of a gram as numbers, two in a long (``vocabulary.packed``); 0
stands for no word. Words and their numbers, which ``fits_words``, are all that is broadcast.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator, Mapping, Sequence
from functools import cached_property
from itertools import islice, repeat

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import Broadcast
from pyspark.sql import DataFrame

from ..functions.text import BOS, EOS, LONG_BYTES, SYMBOLS
from .vocabulary import HALF

LOW = (1 << HALF) - 1
# Rows or tokens that a task works on at once.
CHUNK = 1 << 17
# So many weights of 2^49 units at most are added up in a long.
RUN = 1 << 12
# Kinds of the rows of a segment, in the place of a pair of words: its weights, and its counts.
WEIGHTS, COUNTS = -1, -2
# What ``str.split`` makes: a run of characters that are not whitespace.
TOKEN = re.compile(r"\S+")

Batches = Iterator[pa.RecordBatch]


class Words:
    """Known words by the keys ``by``: an entry from 1 for each, with its number and its values."""

    def __init__(self, table: pa.Table, by: Sequence[str] = ()):
        self.table, self.by = table.combine_chunks(), tuple(by)

    @cached_property
    def keys(self) -> dict[tuple, int]:
        """The place of each key in an order that all tasks share."""
        if not self.by:
            return {(): 0}
        distinct = self.table.group_by(list(self.by)).aggregate([]).to_pylist()
        found = [tuple(row[c] for c in self.by) for row in distinct]
        return {key: k for k, key in enumerate(sorted(found, key=repr))}

    @cached_property
    def entries(self) -> list[dict[str, int]]:
        """For each key, its words and their entries."""
        grams = self.table["gram"].to_pylist()
        if not self.by:
            return [dict(zip(grams, range(1, len(grams) + 1)))]
        found: list[dict[str, int]] = [{} for _ in self.keys]
        of = [self.keys[key] for key in zip(*[self.table[c].to_pylist() for c in self.by])]
        for entry, (k, gram) in enumerate(zip(of, grams), 1):
            found[k][gram] = entry
        return found

    @cached_property
    def symbols(self) -> list[dict[str, int]]:
        """For each key, the entries of the reserved symbols, which are none of its words."""
        return [{s: words[s] for s in SYMBOLS if s in words} for words in self.entries]

    @cached_property
    def known(self) -> list[dict[str, int]]:
        """For each key, the words that a token may be."""
        for words in self.entries:
            for s in SYMBOLS:
                words.pop(s, None)
        return self.entries

    def values(self, name: str) -> np.ndarray:
        """A column of the table by entry, with 0 for none."""
        return np.concatenate([[0], self.table[name].to_numpy()]).astype(np.int64)

    def ready(self) -> Words:
        """With everything worked out, in an order that holds."""
        self.keys, self.symbols, self.known  # noqa: B018
        return self


def shared(frame: DataFrame, by: Sequence[str] = ()) -> Broadcast:
    """A written table of words that ``fits_words``, broadcast to Python; without an ``id``, words get one."""
    table = frame.toArrow()
    if "id" not in frame.columns:
        ids = pc.add(table["gram"].combine_chunks().dictionary_encode().indices, 1)
        table = table.append_column("id", ids)
    return frame.sparkSession.sparkContext.broadcast(Words(table, by))


def pack(values: Sequence[np.ndarray]) -> list[np.ndarray]:
    """Arrays of numbers as ``vocabulary.packed``."""
    values = [v.astype(np.int64, copy=False) for v in values]
    if len(values) % 2:
        values = [*values, np.zeros_like(values[0])]
    return [(high << HALF) | low for high, low in zip(values[::2], values[1::2])]


def unpack(pairs: Sequence[np.ndarray], number: int) -> list[np.ndarray]:
    halves = [half for pair in pairs for half in (pair >> HALF, pair & LOW)]
    return halves[:number]


def pairs_of(number: int) -> list[str]:
    """The names of the columns that hold so many packed values."""
    return [f"pair_{k}" for k in range((number + 1) // 2)]


def columns_of(table: pa.Table, names: Sequence[str]) -> list[np.ndarray]:
    return [table[name].to_numpy() for name in names]


def codes(table: pa.Table, by: Sequence[str]) -> tuple[np.ndarray, list[tuple]]:
    """A number for the key of each row, and the keys in the order of their numbers."""
    code, keys = np.zeros(table.num_rows, np.int64), [()]
    for name in by:
        found = table[name].combine_chunks().dictionary_encode("encode")
        values = found.dictionary.to_pylist()
        code = code * len(values) + found.indices.to_numpy()
        keys = [(*key, value) for key in keys for value in values]
    return code, keys


def starts_of(*arrays: np.ndarray) -> np.ndarray:
    """Whether a row differs from the one before it in any of the arrays."""
    new = np.zeros(len(arrays[0]), bool)
    if len(new):
        new[0] = True
    for values in arrays:
        new[1:] |= values[1:] != values[:-1]
    return new


def prefixes(code: np.ndarray, words: Sequence[np.ndarray]) -> dict[int, np.ndarray]:
    """For each length m from 2, whether a row's first m words are other ones than those before it."""
    new = starts_of(code, *words[:2])
    found = {2: new}
    for m in range(3, len(words) + 1):
        new = new | starts_of(words[m - 1])
        found[m] = new
    return found


def whole_groups(batches: Batches, by: Sequence[str]) -> Iterator[pa.Table]:
    """Sorted rows in tables of at least ``CHUNK`` rows, in which no pair of words is cut in two."""
    held, rows, wanted = [], 0, CHUNK
    for batch in batches:
        held.append(batch)
        rows += batch.num_rows
        if rows < wanted:
            continue
        table = pa.Table.from_batches(held).combine_chunks()
        new = np.flatnonzero(starts_of(table["pair_0"].to_numpy(), codes(table, by)[0]))
        cut = int(new[-1])
        if cut:
            yield table.slice(0, cut)
        held, rows = table.slice(cut).to_batches(), table.num_rows - cut
        wanted = max(CHUNK, 2 * rows)
    if rows:
        yield pa.Table.from_batches(held).combine_chunks()


def batches_of(arrays: Mapping[str, object]) -> Iterator[pa.RecordBatch]:
    table = pa.table({name: pa.array(a) if isinstance(a, np.ndarray) else a for name, a in arrays.items()})
    yield from table.combine_chunks().to_batches(max_chunksize=CHUNK // 2)


def numbers_of(text: str | None, known: Mapping[str, int]) -> Iterator[np.ndarray]:
    """The entries of the tokens of a text, 0 for an unknown one; of a long one in pieces, as it is read."""
    text = text or ""
    if len(text) <= LONG_BYTES:
        words = text.split()
        yield np.fromiter(map(known.get, words, repeat(0)), np.int64, len(words))
        return
    found = (known.get(m[0], 0) for m in TOKEN.finditer(text))
    while len(piece := np.fromiter(islice(found, CHUNK), np.int64)):
        yield piece


def token_stream(
    batch: pa.RecordBatch, words: Words, order: int
) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """The entries of padded ``pieces`` of texts one after the other, the row of each, or -1 for tokens
    before a piece, and the number of positions of a segment at its end symbol. The first ``order - 1``
    of each part are those before it."""
    of = [words.keys.get(key, -1) for key in zip(*[batch.column(c).to_pylist() for c in words.by])]
    pieces = zip(*[batch.column(c).to_pylist() for c in ("text", "before", "first", "last", "rest")])
    nothing = np.zeros(order - 1, np.int64)
    parts, rows, places, held = [nothing], [nothing - 1], [], 0

    def part():
        found = [np.concatenate(parts), np.concatenate(rows), np.zeros(sum(map(len, parts)), np.int64)]
        if places:
            at, positions = zip(*places)
            found[2][list(at)] = positions
        return found

    for row, (text, front, first, last, rest) in enumerate(pieces):
        k = of[row] if words.by else 0
        if k < 0:
            continue  # a key that has no words
        symbols, get = words.symbols[k], words.known[k].get
        tokens, back = text.split(), front.split()
        lead = [get(word, 0) for word in back[len(back) - order + 1 :]] if back else []
        lead = [*[0] * (order - 1 - len(lead)), *lead]
        size = len(tokens)
        number = np.zeros(order + 1 + max(size, 1), np.int64)
        number[: order - 1] = lead
        if first:
            number[order - 1] = symbols.get(BOS, 0)
        number[order : order + size] = np.fromiter(map(get, tokens, repeat(0)), np.int64, size)
        # A segment without tokens is one unknown word, a last piece without tokens is none.
        size = size or int(bool(first and last))
        end = order + size
        number = number[: end + 1] if last else number[:end]
        if last:
            number[end] = symbols.get(EOS, 0)
            places.append((held + order - 1 + end, rest + size + 1))
        if not first:  # no start symbol between the tokens before and the piece
            number = np.delete(number, order - 1)
            if last:
                places[-1] = (places[-1][0] - 1, places[-1][1])
        parts.append(number)
        rows.append(np.where(np.arange(len(number)) < order - 1, -1, row))
        held += len(number)
        if held >= CHUNK:
            yield part()
            parts, rows, places, held = [nothing], [nothing - 1], [], 0
    yield part()


def before(entries: np.ndarray, ids: np.ndarray | None, order: int) -> list[np.ndarray]:
    """For each token of a part, its number and those of the tokens before it."""
    numbers = entries if ids is None else ids[entries]
    return [numbers[order - 1 - k : len(numbers) - k] for k in range(order)]


# --- training ------------------------------------------------------------------------


def sentence_numbers(words: Broadcast, by: Sequence[str]) -> Callable[[Batches], Batches]:
    """Texts to the numbers of their known words, in order."""

    def run(batches: Batches) -> Batches:
        known = words.value.ready()
        ids = known.values("id")
        for batch in batches:
            of = [known.keys.get(key, -1) for key in zip(*[batch.column(c).to_pylist() for c in known.by])]
            found = []
            for row, text in enumerate(batch.column("text").to_pylist()):
                k = of[row] if known.by else 0
                entries = np.concatenate([*numbers_of(text, known.known[k] if k >= 0 else {}), [0]]).astype(np.int64)
                found.append(ids[entries[entries > 0]])
            sizes = np.cumsum([0, *map(len, found)])
            values = np.concatenate(found) if found else np.zeros(0, np.int64)
            numbers = pa.ListArray.from_arrays(pa.array(sizes, pa.int32()), pa.array(values, pa.int32()))
            kept = [*by, "seg_id"]
            yield pa.RecordBatch.from_arrays([*[batch.column(c) for c in kept], numbers], [*kept, "words"])

    return run


def sentence_endings(order: int, by: Sequence[str], start: int, end: int) -> Callable[[Batches], Batches]:
    """Sentences of numbers to the longest gram that ends at each token, but for the start symbol."""

    def run(batches: Batches) -> Batches:
        for batch in batches:
            values, sizes = batch.column("words"), pc.list_value_length(batch.column("words")).to_numpy()
            begins = np.cumsum(sizes) - sizes
            words = pc.list_flatten(values).to_numpy()
            low = 0
            while low < len(sizes):
                high = max(low + 1, int(np.searchsorted(begins, begins[low] + CHUNK)))
                # Padding: what lies before a sentence, its start, and its end.
                size = sizes[low:high] + order + 1
                at = np.cumsum(size) - size
                found = np.zeros(int(size.sum()), np.int64)
                rows = np.repeat(np.arange(low, high), size)
                found[at + order - 1], found[at + size - 1] = start, end
                inside = np.arange(len(found)) - at[rows - low]
                chosen = words[begins[low] : begins[high - 1] + sizes[high - 1]]
                found[(inside >= order) & (inside < size[rows - low] - 1)] = chosen
                ends = before(found, None, order)
                keep = np.flatnonzero((ends[0] > 0) & (ends[1] > 0))
                row = pa.array(rows[order - 1 :][keep])
                pairs = dict(zip(pairs_of(order), pack([t[keep] for t in ends])))
                yield from batches_of({**{c: batch.column(c).take(row) for c in by}, **pairs})
                low = high

    return run


def counted_endings(order: int, by: Sequence[str], start: int) -> Callable[[Batches], Batches]:
    """Adjusted counts of all orders from distinct longest grams, sorted from the last word backwards.

    Grams that share an ending are neighbours, and each order is counted on the rows of the next
    longer one: a gram that begins a sentence keeps its count, any other has one for each token before it.
    """

    def run(batches: Batches) -> Batches:
        for table in whole_groups(batches, by):
            words = unpack(columns_of(table, pairs_of(order)), order)
            count = table["cnt"].to_numpy()
            code = codes(table, by)[0]
            new = prefixes(code, words)
            new[order] = np.ones(len(count), bool)
            at, numbers, values = [], [], []
            for n in range(order, 1, -1):
                first = np.flatnonzero(new[n])
                own = count[first]
                if n < order:
                    longer = np.add.reduceat(new[n + 1].astype(np.int64), first)
                    own = np.where(words[n - 1][first] == start, own, longer)
                there = words[n - 1][first] > 0
                at.append(first[there])
                values.append(own[there])
                numbers.append(np.full(len(at[-1]), n))
            single = np.flatnonzero(starts_of(code, words[0]))
            at.append(single)
            values.append(np.add.reduceat(new[2].astype(np.int64), single))
            numbers.append(np.ones(len(single), np.int64))
            at, n, a = (np.concatenate(each) for each in (at, numbers, values))
            backwards = [t[at] for t in words]
            forwards = [np.zeros(len(at), np.int64) for _ in words]
            for m in range(1, order + 1):
                of = n == m
                for k in range(m):
                    forwards[k][of] = backwards[m - 1 - k][of]
            pairs = dict(zip(pairs_of(order + 1), pack([*forwards, n])))
            row = pa.array(at)
            yield from batches_of(
                {**{c: table[c].take(row) for c in by}, "n": n.astype(np.int32), **pairs, "a": a}
            )

    return run


Discounts = Mapping[tuple, tuple[float, float, float]]


def contexts_and_shares(order: int, by: Sequence[str], disc: Discounts) -> Callable[[Batches], Batches]:
    """Grams of two words or more, sorted by their words, with what their contexts tell: the ``share``
    of their own, the back-off weight ``b`` of the context, and ``own`` as a context of longer ones."""

    def run(batches: Batches) -> Batches:
        for table in whole_groups(batches, by):
            *words, n = unpack(columns_of(table, pairs_of(order + 1)), order + 1)
            a = table["a"].to_numpy()
            code, keys = codes(table, by)
            new = prefixes(code, words)
            d = np.full((3, len(keys), order + 2), np.nan)
            for k, key in enumerate(keys):
                for m in range(1, order + 1):
                    d[:, k, m] = disc.get((*key, m), (np.nan,) * 3)
            s, b = table["s_1"].to_numpy().copy(), table["b_1"].to_numpy().copy()
            own = np.full(len(a), np.nan)
            for m in range(2, order):
                first = np.flatnonzero(new[m])
                group = np.cumsum(new[m]) - 1
                longer = n == m + 1
                counts = [np.where(longer, a, 0), longer & (a == 1), longer & (a == 2), longer & (a >= 3)]
                total, *of = (np.add.reduceat(x.astype(np.int64), first)[group] for x in counts)
                d1, d2, d3 = d[:, code, m + 1]
                with np.errstate(divide="ignore", invalid="ignore"):
                    mass = (d1 * of[0] + d2 * of[1] + d3 * of[2]) / total
                s = np.where(longer, total, s)
                b = np.where(longer, mass, b)
                own = np.where((n == m) & (total > 0), mass, own)
            d1, d2, d3 = d[:, code, n]
            share = (a - np.where(a == 1, d1, np.where(a == 2, d2, d3))) / s
            every, last = np.stack([*words, np.zeros_like(n)]), np.arange(len(n))
            backwards = [every[np.where(n > k, n - 1 - k, order), last] for k in range(order)]
            pairs = dict(zip(pairs_of(order + 1), pack([*backwards, n])))
            yield from batches_of(
                {
                    **{c: table[c] for c in by}, **pairs, "share": share, "b": b,
                    "own": pa.array(own, mask=np.isnan(own)), "p_1": table["p_1"],
                }
            )

    return run


class Spelling:
    """Numbers back to words."""

    def __init__(self, words: Words):
        self.grams = words.table["gram"].combine_chunks()
        self.place = np.zeros(words.table.num_rows + 1, np.int64)
        self.place[words.table["id"].to_numpy()] = np.arange(words.table.num_rows)

    def grams_of(self, words: Sequence[np.ndarray]) -> pa.Array:
        """Words in order as one string each; 0 is left out."""
        parts = [self.grams.take(pa.array(self.place[w], mask=w == 0)) for w in words]
        return pc.binary_join_element_wise(*parts, " ", null_handling="skip")


def spelled(words: Broadcast, order: int, by: Sequence[str]) -> Callable[[Batches], Batches]:
    """Grams of numbers to ``n, gram, a``."""

    def run(batches: Batches) -> Batches:
        spelling = Spelling(words.value)
        for batch in batches:
            table = pa.Table.from_batches([batch])
            gram = spelling.grams_of(unpack(columns_of(table, pairs_of(order)), order))
            yield from batches_of({**{c: table[c] for c in by}, "n": table["n"], "gram": gram, "a": table["a"]})

    return run


def probabilities(words: Broadcast, order: int, by: Sequence[str]) -> Callable[[Batches], Batches]:
    """The same grams, sorted from the last word backwards, where each stands behind its suffixes:
    ``p`` and, for the suffix, ``low``; words are put back in the place of numbers."""

    def run(batches: Batches) -> Batches:
        spelling = Spelling(words.value)
        for table in whole_groups(batches, by):
            *ends, n = unpack(columns_of(table, pairs_of(order + 1)), order + 1)
            share, b = columns_of(table, ["share", "b"])
            low = np.where(n == 2, table["p_1"].to_numpy(), np.nan)  # of the word that a pair ends with
            p, at = np.full(len(n), np.nan), np.arange(len(n))
            new = prefixes(codes(table, by)[0], ends)
            for m in range(2, order + 1):
                of = n == m
                p = np.where(of, share + b * low, p)
                if m < order:
                    suffix = np.maximum.accumulate(np.where(of, at, -1))
                    there = suffix >= np.maximum.accumulate(np.where(new[m], at, 0))
                    low = np.where((n == m + 1) & there, p[suffix], low)
            gram = spelling.grams_of(ends[::-1])
            yield from batches_of(
                {
                    **{c: table[c] for c in by}, "n": n.astype(np.int32), "gram": gram,
                    "p": pa.array(p, mask=np.isnan(p)), "low": low, "b": b, "own": table["own"],
                }
            )

    return run


# --- scoring -------------------------------------------------------------------------

Hot = Sequence[tuple[int, int]]


def columns(order: int) -> list[str]:
    """The columns of rows that are matched: words and order, packed, where they go, and a value."""
    first, *further = pairs_of(max(order + 1, 5))  # a row of a segment holds two values beside its kind
    return [first, "place", *further, "x"]


def matched_row(words: Sequence[np.ndarray], n: np.ndarray) -> list[np.ndarray]:
    """Words and order as pairs."""
    return pack([*words, n, *[np.zeros_like(n)] * max(0, 4 - len(words))])


def _place(key: np.ndarray, pair: np.ndarray, any_of: np.ndarray, hot: Hot, salts: int) -> np.ndarray:
    """Where rows go beside their pair of words: by key, and rows of a frequent pair further."""
    place = key * salts
    for k in {k for k, _ in hot}:
        frequent = np.sort(np.array([pair_0 for of, pair_0 in hot if of == k], np.int64))
        found = np.searchsorted(frequent, pair) % len(frequent)
        dealt = (key == k) & (frequent[found] == pair)
        place = np.where(dealt, place + any_of % salts, place)
    return place


def _any_of(*values: np.ndarray) -> np.ndarray:
    """Some number below 2^15 that follows from the values."""
    mixed = np.zeros(len(values[0]), np.uint64)
    for v in values:
        mixed = (mixed ^ v.astype(np.uint64)) * np.uint64(0x9E3779B97F4A7C15)
        mixed ^= mixed >> np.uint64(29)
    return (mixed >> np.uint64(49)).astype(np.int64)


def segment_tokens(words: Broadcast, order: int, hot: Hot, salts: int) -> Callable[[Batches], Batches]:
    """Texts to the known tokens with the known words right before them, and two rows for what is
    known of a segment by its words alone: the sums of their weights, and their numbers.

    Rows have ``pair_0``, ``place``, further pairs and ``x``, which is the segment.
    """
    names = columns(order)

    def run(batches: Batches) -> Batches:
        known = words.value.ready()
        ids, *values = (known.values(c) for c in ("id", "w_s", "w_g", "known_s", "known_g"))
        for batch in batches:
            seg_id = batch.column("seg_id").to_numpy()
            of = [known.keys.get(key, -1) for key in zip(*[batch.column(c).to_pylist() for c in known.by])]
            key_of = np.array(of if known.by else [0] * batch.num_rows, np.int64)
            for entries, rows, places in token_stream(batch, known, order):
                ends = before(entries, ids, order)
                entries, rows, places = (each[order - 1 :] for each in (entries, rows, places))
                all_rows, own = rows, rows >= 0
                keep = np.flatnonzero(own & (ends[0] > 0) & (ends[1] > 0))
                entries, rows, places = (each[own] for each in (entries, rows, places))
                if not len(entries):
                    continue
                kept = [t[keep] for t in ends]
                for k in range(2, order):  # up to the first unknown word
                    kept[k] = np.where(kept[k - 1] > 0, kept[k], 0)
                row = all_rows[keep]
                x, key = seg_id[row], key_of[row]
                first, *further = matched_row(kept, np.full(len(keep), 2 * order + 2))
                place = _place(key, first, _any_of(x, *further), hot, salts)
                yield from batches_of(dict(zip(names, [first, place, *further, x])))
                new = starts_of(rows)
                new[::RUN] = True
                first = np.flatnonzero(new)
                w_s, w_g, known_s, known_g = (np.add.reduceat(v[entries], first) for v in values)
                single = np.add.reduceat((ids[entries] > 0).astype(np.int64), first)
                positions = np.maximum.reduceat(places, first)
                x, key = seg_id[rows[first]], key_of[rows[first]]
                place = key * salts + _any_of(x) % salts
                nothing = [np.zeros_like(x)] * (len(names) - 5)
                for kind, high, low in (
                    (WEIGHTS, w_s, w_g),
                    (COUNTS, (positions << HALF) | single, (known_s << HALF) | known_g),
                ):
                    row = [np.full(len(x), kind), place, high, low, *nothing, x]
                    yield from batches_of(dict(zip(names, row)))

    return run


def model_grams(words: Broadcast, order: int, tag: int, hot: Hot, salts: int) -> Callable[[Batches], Batches]:
    """Grams of a model to the rows that ``segment_tokens`` of the same last words stand behind; ``x`` is
    the weight. Those of frequent pairs go to all of their places."""
    names = columns(order)

    def run(batches: Batches) -> Batches:
        known = words.value.ready()
        ids = known.values("id")
        for batch in batches:
            n = batch.column("n").to_numpy().astype(np.int64)
            if not len(n):
                continue
            of = [known.keys.get(key, -1) for key in zip(*[batch.column(c).to_pylist() for c in known.by])]
            key = np.array(of if known.by else [0] * len(n), np.int64)
            parts = " ".join(batch.column("gram").to_pylist()).split(" ")
            entries = np.zeros(len(parts), np.int64)
            of = np.repeat(key, n)
            for k in np.unique(key[key >= 0]).tolist():
                mine = np.flatnonzero(of == k)
                chosen = parts if len(mine) == len(parts) else [parts[i] for i in mine.tolist()]
                found = np.fromiter(map(known.known[k].get, chosen, repeat(0)), np.int64, len(chosen))
                for i in np.flatnonzero(found == 0).tolist():
                    found[i] = known.symbols[k].get(chosen[i], 0)
                entries[mine] = found
            numbers, last = ids[entries], np.cumsum(n) - 1
            ends = [np.where(n > k, numbers[np.maximum(last - k, 0)], 0) for k in range(order)]
            there = np.logical_and.reduce([(n <= k) | (t > 0) for k, t in enumerate(ends)])
            first, *further = matched_row(ends, 2 * n + tag)
            w = batch.column("w").to_numpy()
            x = np.where(np.abs(w) < 2.0**51, np.sign(w) * np.floor(np.abs(w) + 0.5), w).astype(np.int64)
            place = _place(key, first, np.zeros_like(n), hot, salts)
            dealt = _place(key, first, np.ones_like(n), hot, salts) != place
            copies = np.where(there, np.where(dealt, salts, 1), 0)
            at = np.repeat(np.arange(len(n)), copies)
            place = place[at] + np.arange(len(at)) - np.repeat(np.cumsum(copies) - copies, copies)
            row = [first[at], place, *[p[at] for p in further], x[at]]
            yield from batches_of(dict(zip(names, row)))

    return run


def found_weights(order: int, salts: int) -> Callable[[Batches], Batches]:
    """Rows of ``segment_tokens`` and ``model_grams``, sorted from the last word backwards, to the
    weights of the grams that end at the tokens, added up for each segment.

    A gram stands before all tokens it ends at, and is the only one of its order and model among rows
    that share its words. Rows have ``key, seg_id, kind, high, low``, as the rows of a segment.
    """
    names = columns(order)
    out = ["key", "seg_id", "kind", "high", "low"]

    def rows_of(key, seg_id, kind, high, low):
        arrays = [key.astype(np.int32), seg_id, np.full(len(key), kind, np.int32), high, low]
        return batches_of(dict(zip(out, arrays)))

    def found(held: list[pa.RecordBatch], carried: list[np.ndarray]) -> tuple[list, list[np.ndarray]]:
        rows = [np.concatenate(each) for each in zip(carried, columns_of(pa.Table.from_batches(held), names))]
        done = []
        for kind in (COUNTS, WEIGHTS):
            at = rows[0] == kind
            if at.any():
                _, place, high, low, *_, x = (each[at] for each in rows)
                done += rows_of(place // salts, x, kind, high, low)
                rows = [each[~at] for each in rows]
        pair_0, place, *rest, x = rows
        if not len(x):
            return done, rows
        *words, n = unpack([pair_0, *rest], order + 1)
        new = prefixes(place, words)
        at = np.arange(len(x))
        token = n == 2 * order + 2
        sums = {0: np.zeros(len(x), np.int64), 1: np.zeros(len(x), np.int64)}
        some = np.zeros(len(x), bool)
        last = []
        for m in range(2, order + 1):
            group = np.maximum.accumulate(np.where(new[m], at, 0))
            for tag in (0, 1):
                gram = np.maximum.accumulate(np.where(n == 2 * m + tag, at, -1))
                known = gram >= group
                sums[tag] += np.where(known, x[gram], 0)
                some |= known
                if known[-1]:
                    last.append(gram[-1])
        # What ends here may go on with the rows to come.
        carried = [each[last] for each in rows]
        some &= token
        seg_id, key = x[some], place[some] // salts
        if len(seg_id):
            order_of = np.lexsort((seg_id, key)) if key.any() else np.argsort(seg_id, kind="stable")
            seg_id, key = seg_id[order_of], key[order_of]
            new = starts_of(seg_id, key)
            begin = np.maximum.accumulate(np.where(new, np.arange(len(new)), 0))
            new |= (np.arange(len(new)) - begin) % RUN == 0
            first = np.flatnonzero(new)
            w_s, w_g = (np.add.reduceat(sums[tag][some][order_of], first) for tag in (0, 1))
            done += rows_of(key[first], seg_id[first], WEIGHTS, w_s, w_g)
        return done, carried

    def run(batches: Batches) -> Batches:
        held, rows = [], 0
        carried = [np.zeros(0, np.int64) for _ in names]
        for batch in batches:
            held.append(batch)
            rows += batch.num_rows
            if rows >= 2 * CHUNK:
                done, carried = found(held, carried)
                yield from done
                held, rows = [], 0
        if rows:
            yield from found(held, carried)[0]

    return run
