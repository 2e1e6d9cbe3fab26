"""Passages of benchmark items in documents, by one Aho-Corasick automaton.

The patterns are the windows of the items: ``WINDOW`` consecutive words, or all words of a
shorter item. Words are numbered, so the automaton steps from word to word; each text is read
once, whole, and no document is shuffled.
"""

from __future__ import annotations

from array import array
from collections.abc import Iterator, Sequence
from itertools import repeat

import ahocorasick
import pyarrow as pa
from pyspark.broadcast import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tamis.llm.common import plain, quoted, restored
from tamis.llm.words import alnum_spans, alnum_words, texts
from tamis.sources.staging import materialize

WINDOW = 10
# Bytes of item texts in one automaton; it takes about a hundred times that in memory. A larger
# set of items is dealt into blocks of that size. Then a task holds one automaton at a time, and
# scans by one after the other what it has read of the documents: batches of so many bytes, cut
# into words once. Both set the order of the work, not its result.
BLOCK_BYTES = 512 * 1024
HELD_BYTES = 64 * 1024 * 1024

Items = list[tuple[str | None, str]]


class Automaton:
    """The windows of some items; ``scan`` finds them in the numbers of a text's words.

    Words are numbered from 1 as they come. With given ``numbers``, windows that hold a word
    without one can't occur and are left out.
    """

    def __init__(self, items: Items, window: int, numbers: dict[bytes, int] | None = None) -> None:
        self.numbers: dict[bytes, int] = {} if numbers is None else numbers
        owners: dict[tuple[int, ...], set[str]] = {}
        for item, text in items:
            if numbers is None:
                words = [self.numbers.setdefault(w, len(self.numbers) + 1) for w in alnum_words(text)]
            else:
                words = self.numbered(alnum_words(text))
            size = min(window, len(words))
            clear = 0  # how many words in a row up to this one have a number
            for last, number in enumerate(words):
                clear = clear + 1 if number else 0
                if last + 1 < size or clear < size:
                    continue
                owner = owners.setdefault(tuple(words[last + 1 - size : last + 1]), set())
                if item is not None:
                    owner.add(item)
        self.matcher = ahocorasick.Automaton(ahocorasick.STORE_ANY, ahocorasick.KEY_SEQUENCE)
        for pattern, owner in owners.items():
            self.matcher.add_word(pattern, (len(pattern), owner))
        self.empty = not owners
        if not self.empty:
            self.matcher.make_automaton()

    def numbered(self, words: list[bytes]) -> list[int]:
        """Their numbers, 0 for words without one."""
        return list(map(self.numbers.get, words, repeat(0)))

    def scan(self, words: Sequence[int]) -> Iterator[tuple[int, int, set[str]]]:
        """First word, word after the last, and owners of every occurrence, by last word."""
        if words and not self.empty:
            for last, (size, owner) in self.matcher.iter(tuple(words)):
                yield last + 1 - size, last + 1, owner


def held(batches: Iterator[pa.RecordBatch], limit: int) -> Iterator[list[pa.RecordBatch]]:
    """Batches in groups that end with the batch that brings them to ``limit`` bytes."""
    group: list[pa.RecordBatch] = []
    size = 0
    for batch in batches:
        group.append(batch)
        size += batch.nbytes
        if size >= limit:
            yield group
            group, size = [], 0
    if group:
        yield group


def merged(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Overlapping or touching spans made one."""
    out: list[tuple[int, int]] = []
    for start, end in sorted(spans):
        if out and start <= out[-1][1]:
            out[-1] = (out[-1][0], max(end, out[-1][1]))
        else:
            out.append((start, end))
    return out


def item_blocks(benchmark: DataFrame, item_id: str, text: str, limit: int) -> list[Broadcast]:
    """The items in blocks of at most ``limit`` bytes of text (or one item), each broadcast.

    Items pass the driver one block at a time. Repeated rows count once; null ids stay null.
    """
    spark = benchmark.sparkSession
    items = materialize(
        benchmark.select(
            F.col(item_id).cast("string").alias("id"), F.col(text).alias("words")
        ).where(F.col("words").isNotNull()).distinct(),
        "items",
    )
    blocks: list[Broadcast] = []
    block: Items = []
    held = 0
    for row in items.toLocalIterator():
        size = len(row.words.encode())
        if block and held + size > limit:
            blocks.append(spark.sparkContext.broadcast(block))
            block, held = [], 0
        block.append((row.id, row.words))
        held += size
    if block:
        blocks.append(spark.sparkContext.broadcast(block))
    return blocks


def find_passages(
    docs: DataFrame,
    benchmark: DataFrame,
    text: str = "text",
    item_id: str = "item_id",
    item_text: str = "text",
    window: int = WINDOW,
    keep: list[str] | None = None,
    block_bytes: int = BLOCK_BYTES,
    held_bytes: int = HELD_BYTES,
) -> DataFrame:
    """The columns ``keep`` (all, if not given) of every document, and what was found in it.

    ``passages``: struct of ``n_words``, ``n_hit`` (words inside any occurrence of a window),
    ``spans`` (start and end of each hit passage in characters of the original text; touching
    occurrences are one) and ``items`` (ids of the items, as sorted strings).

    A null or empty text has no words and nothing in it. An item without words, or with a null
    text, has no window. An item with a null id marks words but is not listed. Repeated rows
    of either table change nothing. Without items, nothing is found.
    """
    blocks = item_blocks(benchmark, item_id, item_text, block_bytes)
    kept = docs.columns if keep is None else keep
    found = "struct<n_words:bigint,n_hit:bigint,spans:array<struct<start:int,end:int>>,items:array<string>>"
    source = f"c{kept.index(text)}" if text in kept else "t"
    inner = docs.select(
        *[docs[quoted(c)].alias(f"c{i}") for i, c in enumerate(kept)],
        *([] if text in kept else [docs[quoted(text)].alias(source)]),
    )
    schema = ", ".join(
        [f"c{i} {docs.schema[c].dataType.simpleString()}" for i, c in enumerate(kept)]
        + [f"passages {found}"]
    )
    kind = pa.struct(
        [
            ("n_words", pa.int64()),
            ("n_hit", pa.int64()),
            ("spans", pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))),
            ("items", pa.list_(pa.string())),
        ]
    )

    Found = tuple[int, list[tuple[int, int]], set[str]]

    def by_one(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.RecordBatch, list[Found]]]:
        automaton = Automaton(blocks[0].value if blocks else [], window)
        for batch in batches:
            found = []
            for value in texts(batch, source):
                words = alnum_words(value)
                places = list(automaton.scan(automaton.numbered(words)))
                items = set().union(*[owner for _, _, owner in places])
                found.append((len(words), merged([(start, end) for start, end, _ in places]), items))
            yield batch, found

    def by_each(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.RecordBatch, list[Found]]]:
        for group in held(batches, held_bytes):
            numbers: dict[bytes, int] = {}
            cut = [
                array("I", [numbers.setdefault(w, len(numbers) + 1) for w in alnum_words(value)])
                for batch in group
                for value in texts(batch, source)
            ]
            found: list[Found] = [(len(words), [], set()) for words in cut]
            for block in blocks:
                automaton = Automaton(block.value, window, numbers)
                for i, words in enumerate(cut):
                    n, hits, items = found[i]
                    for start, end, owner in automaton.scan(words):
                        hits.append((start, end))
                        items |= owner
                    found[i] = (n, merged(hits), items)
            at = 0
            for batch in group:
                yield batch, found[at : at + batch.num_rows]
                at += batch.num_rows

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, found in by_each(batches) if len(blocks) > 1 else by_one(batches):
            rows = []
            for value, (n_words, hits, items) in zip(texts(batch, source), found):
                places = alnum_spans(value) if hits else []
                rows.append(
                    {
                        "n_words": n_words,
                        "n_hit": sum(end - start for start, end in hits),
                        "spans": [
                            {"start": places[start][0], "end": places[end - 1][1]}
                            for start, end in hits
                        ],
                        "items": sorted(items),
                    }
                )
            columns = batch.columns[: len(kept)]
            names = batch.schema.names[: len(kept)]
            yield pa.RecordBatch.from_arrays([*columns, pa.array(rows, kind)], [*names, "passages"])

    return inner.mapInArrow(scan, schema).select(
        *[F.col(f"c{i}").alias(c) for i, c in enumerate(kept)], "passages"
    )


def drop_contaminated(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The documents that hold no benchmark passage, with their columns as they were, whatever
    their names."""
    inner = plain(docs, "text")
    found = find_passages(inner, benchmark)
    return restored(found.where(F.col("passages.n_hit") == 0), inner, docs)


def op2_decontamination(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """Per document, how many of its words lie in benchmark windows, and of which items."""
    found = find_passages(docs, benchmark, keep=["doc_id"])
    items = F.col("passages.items")
    return found.select(
        "doc_id",
        F.col("passages.n_words").alias("n_words"),
        F.col("passages.n_hit").alias("n_hit"),
        F.size(items).cast("long").alias("n_items"),
        F.sha2(F.concat_ws(",", items), 256).alias("items_sha256"),
        (F.col("passages.n_hit") > 0).alias("contaminated"),
    )

