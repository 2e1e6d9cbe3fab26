"""Near duplicates by Jaccard similarity of word n-grams, by a join of parity sketches.

A document is its set of shingles (64-bit hashes of five consecutive words). Documents with the
same set form a class; everything below works on one node per class.

**Sketch.** Documents are put into bands by set size. A band's sketch has a fixed number of
blocks. Every shingle falls into one block and flips one bit there; a block is a bit string of
2^64 places of which only the parity of the few that were flipped matters, and it is kept as the
XOR of the hashes of its shingles. A shingle that two sets do not share changes one block, so the
number of unequal blocks, like the Hamming distance of the bits, is at most the size of the
symmetric difference. Sets with similarity t differ in at most D = (1 - t) / t of the size of the
smaller, so two linked documents agree in all but D blocks.

**Join.** A document has M blocks that are not empty, and a linked one agrees with it in M - D of
them at least. Blocks that no other node has (the bulk) are found by one count and dropped. A
node that shares fewer than M - D blocks has no link and is dropped. The rest look for partners
by the rarest of their shared blocks: all but M - D - 1, by the pigeonhole principle in the form
of prefix filtering. Passages that many documents hold make frequent blocks and are passed over.
To be in one band with each partner, a document whose partners may be large enough for the next
band is sketched there too.

**Links.** A pair of candidates must agree in size and in a second sketch of 512 bits, whose
Hamming distance bounds the symmetric difference from below; the join tests that, so that only
such pairs come out of it. They are verified on their shingles. Only components are wanted, so
members of a block are first compared with one of them and what is linked is joined; then only
pairs still in different components are compared, all of them.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from functools import partial

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tamis.llm.common import FILE, ROW, in_files, plain, restored, stored
from tamis.llm.words import texts
from tamis.sources.staging import fits_broadcast, materialize

WORDS = 5
PERCENT = 80  # similarity of a link, in hundredths
SMALL = 64  # sets below this size are their own sketch: every shingle is a block
PER_BLOCK = 3  # shingles per block, at the upper end of a band
# Counted size up to which ids are broadcast to filter texts; beyond it they are shuffled.
ID_BYTES = 64 * 1024 * 1024
# Comparisons of sketches per row of the candidate table beyond which another round of stars
# comes first, as long as that helps. These only set the order of the work.
PAIRS_PER_ROW = 1000
STAR_ROUNDS = 6
LINKS_PER_ROW = 0.01  # links found in a round beyond which the next is one of stars again
LONGS = 8  # of the second sketch
NODE_BITS = 62  # of a set's number; sets that clash are found and get others
HELD_KEYS = 100_000  # keys a task holds before it hands them on

FACTOR = np.uint64(0x9E3779B97F4A7C15)  # any odd number with its bits well spread
PIECE = 1 << 22  # bytes of text whose words are hashed at once


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads them (finaliser with two multiplications)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


_VALUES = mixed(np.arange(1, 257, dtype=np.uint64) * FACTOR)  # of the 256 bytes
_IN_WORD = np.array([b not in b" \t\n\x0b\x0c\r" for b in range(256)])
_LOWER = bytes(range(65)) + bytes(range(97, 123)) + bytes(range(91, 256))


def _powers(n: int) -> np.ndarray:
    return np.multiply.accumulate(np.full(n, FACTOR))


def word_hashes(text: str) -> np.ndarray:
    """A 64-bit hash of every word (A-Z lower-cased, cut at white space), in order: the sum of
    its bytes' values, each times a power for its place."""
    data = text.encode().translate(_LOWER)
    out, at = [], 0
    while at < len(data):
        stop = at + PIECE
        while stop < len(data) and _IN_WORD[data[stop]]:  # to the end of a word
            stop += 1
        octets = np.frombuffer(data, np.uint8, min(stop, len(data)) - at, at)
        at = stop
        inside = _IN_WORD[octets]
        edges = np.flatnonzero(np.diff(inside, prepend=False, append=False))
        lengths = edges[1::2] - edges[::2]
        if len(lengths):
            first = np.cumsum(lengths) - lengths
            place = np.arange(int(lengths.sum())) - np.repeat(first, lengths)
            values = _VALUES[octets[inside]] * _powers(int(lengths.max()))[place]
            out.append(mixed(np.add.reduceat(values, first)))
    return np.concatenate(out) if out else np.zeros(0, np.uint64)


def shingles(text: str | None, size: int = WORDS) -> np.ndarray:
    """The distinct shingles of a text as sorted 64-bit hashes; fewer words are one shingle."""
    h = word_hashes(text or "")
    if not len(h):
        return h
    size = min(size, len(h))
    n = len(h) - size + 1
    total = np.full(n, size, np.uint64)
    for k in range(size):  # a polynomial of the words' hashes
        total *= FACTOR
        total += h[k : k + n]
    total = np.sort(mixed(total))
    return total[np.concatenate([[True], total[1:] != total[:-1]])]


def links(a: np.ndarray, b: np.ndarray, percent: int = PERCENT) -> bool:
    """Whether two sorted sets are similar enough."""
    if not len(a) or not len(b):
        return False
    both = len(np.intersect1d(a, b, assume_unique=True))
    return 100 * both >= percent * (len(a) + len(b) - both)


def node_of(found: np.ndarray, clashing: frozenset[int] = frozenset(), bits: int = NODE_BITS) -> int:
    """A signed number of a set, its lowest bit 0; equal sets have equal numbers. Of a chain of
    hashes the first that is not among the clashing ones."""
    data, turn = found.tobytes(), 0
    while True:
        node = xxhash.xxh3_64_intdigest(data, turn) >> (64 - bits) << 1
        if node not in clashing:
            return node
        turn += 1


def proof_of(found: np.ndarray) -> int:
    """A signed 64-bit number by which sets with the same node are told apart."""
    high = xxhash.xxh3_128_intdigest(found.tobytes(), 1) >> 64
    return high - (1 << 64) if high >> 63 else high


def slack(n: int, percent: int = PERCENT) -> int:
    """The most blocks in which a set of this size and a linked one can differ."""
    return n * (100 - percent) // percent


def bands(n: int, percent: int = PERCENT) -> list[int]:
    """The bands in which a set of this size is sketched: its own, and the next if a linked set
    may lie there. A pair meets in the band of its larger set."""
    own = n.bit_length()
    largest = (n * 100 // percent).bit_length()
    return [own] if largest == own else [own, own + 1]


def sketch(found: np.ndarray, band: int) -> np.ndarray:
    """The keys of the blocks that are not empty. A key tells band, block and content.

    ``found`` is sorted."""
    salt = mixed(np.array([band], np.uint64))[0]
    if 1 << band <= SMALL:
        return mixed(found ^ salt)
    # The upper half of a hash picks the block, so sorted shingles lie block by block.
    blocks = (1 << band) // PER_BLOCK + 1
    at = ((found >> np.uint64(32)) * np.uint64(blocks)) >> np.uint64(32)
    first = np.flatnonzero(np.diff(at, prepend=np.uint64(blocks)))
    content = np.bitwise_xor.reduceat(found, first)
    filled = content != 0
    return mixed(content[filled] ^ mixed(at[first][filled] + salt))


def parity_bits(found: np.ndarray) -> np.ndarray:
    """The second sketch: every shingle flips one of ``64 * LONGS`` bits."""
    at = (found & np.uint64(64 * LONGS - 1)).astype(np.int64)
    odd = np.bincount(at, minlength=64 * LONGS) & 1
    return np.packbits(odd.astype(np.uint8)).view(np.int64)


def _signed(x: np.ndarray) -> np.ndarray:
    return x.astype(np.uint64).view(np.int64)


def measured(rows: DataFrame, percent: int, name: Callable[[np.ndarray], int]) -> DataFrame:
    """Per row: ``n`` (shingles), ``node`` and ``proof`` (null if none), and ``need_0``, ``need_1``: how many
    blocks a linked set must share in the own and in the next band (null if not sketched)."""
    keep = [c for c in rows.columns if c != "t"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for value in texts(batch, "t"):
                found = shingles(value)
                n = len(found)
                need: list[int | None] = [None, None]
                for k, band in enumerate(bands(n, percent) if n else []):
                    need[k] = max(len(sketch(found, band)) - slack(n, percent), 1)
                out.append((n, *((name(found), proof_of(found)) if n else (None, None)), *need))
            columns = list(zip(*out)) if out else [()] * 5
            kinds = (pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.int32())
            yield pa.RecordBatch.from_arrays(
                [*[batch.column(c) for c in keep], *[pa.array(c, k) for c, k in zip(columns, kinds)]],
                [*keep, "n", "node", "proof", "need_0", "need_1"],
            )

    kept = [f"{c} {rows.schema[c].dataType.simpleString()}" for c in keep]
    return rows.mapInArrow(run, ", ".join([*kept, "n long, node long, proof long, need_0 int, need_1 int"]))


def block_keys(rows: DataFrame, percent: int, name: Callable[[np.ndarray], int]) -> DataFrame:
    """``key``, ``member`` for every block of every text; the lowest bit of ``member`` says that
    the sketch is that of the next band. A task emits a set once, however often it meets it."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[int] = set()
        keys: list[np.ndarray] = []
        members: list[np.ndarray] = []
        held = 0

        def handed_on() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays(
                [pa.array(_signed(np.concatenate(keys))), pa.array(np.concatenate(members))], ["key", "member"]
            )

        for batch in batches:
            for value in texts(batch, "t"):
                found = shingles(value)
                if not len(found) or (node := name(found)) in seen:
                    continue
                seen.add(node)
                for k, band in enumerate(bands(len(found), percent)):
                    keys.append(sketch(found, band))
                    members.append(np.full(len(keys[-1]), node + k, np.int64))
                    held += len(keys[-1])
                if held > HELD_KEYS:
                    yield handed_on()
                    keys, members, held = [], [], 0
        if held:
            yield handed_on()

    return rows.select("t").mapInArrow(run, "key long not null, member long not null")


def shared_blocks(keys: DataFrame) -> DataFrame:
    """``key``, ``member``, ``df`` of the blocks that several nodes have. The rows are shuffled by
    key once; count and lookup both stream over that. (The columns are declared not null: else
    a filter is inferred for one of the two uses, and the shuffle is not shared.)"""
    n = int(keys.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = keys.repartition(n, "key")
    counts = (
        dealt.groupBy("key")
        .agg(F.count("*").alias("df"), F.min("member").alias("low"), F.max("member").alias("high"))
        .where("low <> high")
        .select("key", "df")
    )
    return dealt.join(counts.hint("shuffle_hash"), "key")


def searched_blocks(shared: DataFrame, nodes: DataFrame) -> DataFrame:
    """``key``, ``node``: the blocks by which a node looks for partners; those it shares, rarest
    first, but for the ``need - 1`` most frequent. A node's list is as long as its sketch."""
    node = F.col("member").bitwiseAND(-2)
    after = F.col("member").bitwiseAND(1)
    lists = (
        shared.distinct()
        .groupBy("member")
        .agg(F.sort_array(F.collect_list(F.struct("df", "key"))).alias("blocks"))
        .select(node.alias("node"), after.alias("after"), "blocks")
    )
    need = F.when(F.col("after") == 0, F.col("need_0")).otherwise(F.col("need_1"))
    size = F.size("blocks")
    return (
        lists.join(nodes.select("node", "need_0", "need_1"), "node")
        .where(size >= need)
        .select("node", F.explode(F.slice("blocks", F.lit(1), size - need + 1)).alias("b"))
        .select(F.col("b.key").alias("key"), F.col("b.df").alias("df"), "node")
    )


def candidate_texts(rows: DataFrame, wanted: DataFrame) -> DataFrame:
    """``node``, ``n``, ``bits`` (second sketch) and ``t`` of the rows named by ``wanted``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n, bits = [], []
            for value in texts(batch, "t"):
                found = shingles(value)
                n.append(len(found))
                bits.append(parity_bits(found))
            yield pa.RecordBatch.from_arrays(
                [batch.column("node"), pa.array(n, pa.int64()), pa.array(bits, pa.list_(pa.int64())), batch.column("t")],
                ["node", "n", "bits", "t"],
            )

    found = rows.join(wanted, [FILE, ROW]).select("node", "t")
    return found.mapInArrow(run, "node long, n long, bits array<bigint>, t string")


def may_link(percent: int) -> Column:
    """Whether sizes ``n``, ``x_n`` and second sketches ``bits``, ``x_bits`` allow a link."""
    apart = sum(
        (F.bit_count(F.col("bits")[i].bitwiseXOR(F.col("x_bits")[i])) for i in range(LONGS)), F.lit(0)
    )
    total = F.col("n") + F.col("x_n")
    return (
        (F.col("n") * 100 >= F.col("x_n") * percent)
        & (F.col("x_n") * 100 >= F.col("n") * percent)
        & (apart * (100 + percent) <= total * (100 - percent))
    )


def verified(pairs: DataFrame, texts_of: DataFrame, percent: int) -> DataFrame:
    """The pairs ``a``, ``b`` whose sets are linked. ``texts_of``: ``node``, ``t``, one per node."""
    a = texts_of.select(F.col("node").alias("a"), F.col("t").alias("ta"))
    b = texts_of.select(F.col("node").alias("b"), F.col("t").alias("tb"))
    both = pairs.join(b, "b").join(a, "a")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            last, left = None, None
            keep = []
            for node, ta, tb in zip(batch.column("a").to_pylist(), texts(batch, "ta"), texts(batch, "tb")):
                if node != last:
                    last, left = node, shingles(ta)
                keep.append(links(left, shingles(tb), percent))
            yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

    return both.select("a", "b", "ta", "tb").mapInArrow(run, "a long, b long")


def components(edges: DataFrame) -> DataFrame:
    """``node``, ``label``: the smallest node reachable, for all nodes in edges ``a``, ``b``.

    Every round takes the smallest label among neighbours and then the label's own label, so
    the number of rounds grows with the logarithm of the longest path, as a rule. Each round is
    written to the shared folder.
    """
    both = materialize(
        edges.select("a", "b").union(edges.select(F.col("b"), F.col("a"))).distinct(), "edges"
    )
    labels = materialize(
        both.groupBy("a").agg(F.min("b").alias("low")).select(
            F.col("a").alias("node"), F.least("a", "low").alias("label")
        ),
        "labels",
    )
    while True:
        of = labels.select(F.col("node").alias("b"), "label")
        lowest = both.join(of, "b").groupBy("a").agg(F.min("label").alias("low"))
        taken = labels.join(lowest, F.col("node") == F.col("a")).select(
            "node", F.col("label").alias("old"), F.least("label", "low").alias("mid")
        )
        own = labels.select(F.col("node").alias("mid"), F.col("label").alias("further"))
        stepped = materialize(
            taken.join(own, "mid").select("node", "old", F.least("mid", "further").alias("label")), "labels"
        )
        changed = stepped.where("label <> old").limit(1).count()
        labels = stepped.select("node", "label")
        if not changed:
            return labels


def merged(labels: DataFrame | None, new: DataFrame) -> DataFrame:
    """``node``, ``label`` after new links ``a``, ``b``: the components so far are single nodes of
    a smaller graph, whose components take their place."""
    if labels is None:
        return components(new)
    for end in ("a", "b"):
        own = labels.select(F.col("node").alias(end), F.col("label").alias(f"of_{end}"))
        new = new.join(own, end, "left")
    ends = new.select(F.coalesce("of_a", "a").alias("a"), F.coalesce("of_b", "b").alias("b"))
    over = components(ends.where("a <> b").distinct())
    step = over.select(F.col("node").alias("label"), F.col("label").alias("next"))
    known = labels.join(step, "label", "left").select("node", F.coalesce("next", "label").alias("label"))
    return materialize(known.union(over).groupBy("node").agg(F.min("label").alias("label")), "merged")


def _groups(searched: DataFrame, labels: DataFrame) -> DataFrame:
    """``key``, ``node``, ``n``, ``bits``, ``comp`` of the blocks whose nodes are not all in one
    component, with ``main``, the component that has most of them, and how many there are."""
    placed = searched.join(labels, "node", "left").withColumn("comp", F.coalesce("label", "node"))
    sizes = placed.groupBy("key", "comp").agg(F.count("*").alias("k"))
    open_keys = (
        sizes.groupBy("key")
        .agg(
            F.max_by("comp", F.struct("k", "comp")).alias("main"),
            F.sum("k").alias("all"),
            F.max("k").alias("most"),
            F.count("*").alias("comps"),
        )
        .where("comps > 1")
    )
    return placed.drop("label").join(open_keys, "key")


def _paired(groups: DataFrame, others: DataFrame, percent: int) -> DataFrame:
    """Pairs of a block in different components that may link. ``others`` has ``key`` and, as
    ``x``, ``x_comp``, ``x_n``, ``x_bits``, the second members."""
    found = groups.join(
        others.withColumnRenamed("key", "x_key"),
        (F.col("key") == F.col("x_key")) & (F.col("comp") != F.col("x_comp")) & may_link(percent),
    )
    return found.select(F.least("node", "x").alias("a"), F.greatest("node", "x").alias("b")).distinct()


def _as_x(members: DataFrame) -> DataFrame:
    return members.select(
        "key",
        F.col("node").alias("x"),
        F.col("comp").alias("x_comp"),
        F.col("n").alias("x_n"),
        F.col("bits").alias("x_bits"),
    )


def _stars(groups: DataFrame, turn: int, percent: int) -> DataFrame:
    """One member of each block, another in each turn, with those of other components."""
    order = F.xxhash64("node", F.lit(turn))
    pivot = groups.groupBy("key").agg(F.min_by("node", order).alias("node"))
    return _paired(groups, _as_x(groups.join(pivot, ["key", "node"])), percent)


def _all_pairs(groups: DataFrame, percent: int) -> DataFrame:
    """All pairs of a block in different components: one side is outside the main one."""
    return _paired(groups, _as_x(groups.where("comp <> main")), percent)


def numbered_sets(
    rows: DataFrame, percent: int
) -> tuple[DataFrame, DataFrame, Callable[[np.ndarray], int]]:
    """The measured rows, one row per node, and the function that names a set's node.

    No two sets have one node: where a second hash shows that they would, the sets of that node
    take the next hash of their chains, and all rows are measured again. With 62 bits that is not
    expected below 10^9 different sets; what comes to the driver are the numbers that clash.
    """
    clashing: frozenset[int] = frozenset()
    while True:
        name = partial(node_of, clashing=clashing, bits=NODE_BITS)
        counted = materialize(measured(rows, percent, name), "shingled")
        by_node = counted.where(F.col("node").isNotNull()).groupBy("node")
        nodes = materialize(
            by_node.agg(
                F.min(F.struct(FILE, ROW)).alias("at"),
                F.first("need_0").alias("need_0"),
                F.first("need_1").alias("need_1"),
                (F.min("proof") != F.max("proof")).alias("clash"),
            ),
            "nodes",
        )
        found = frozenset(r["node"] for r in nodes.where("clash").select("node").collect())
        if not found:
            return counted.drop("proof"), nodes.drop("clash"), name
        clashing |= found


def linked_nodes(rows: DataFrame, percent: int) -> tuple[DataFrame, DataFrame]:
    """``rows``: ``t`` and identity. Returns the measured rows and the components' labels."""
    spark = rows.sparkSession
    counted, nodes, name = numbered_sets(rows, percent)
    searched = materialize(
        searched_blocks(shared_blocks(block_keys(rows, percent, name)), nodes), "searched-blocks"
    )
    wanted = nodes.join(searched.select("node").distinct(), "node").select("node", "at.*")
    wanted = materialize(wanted, "candidates")
    if fits_broadcast(wanted, ID_BYTES):
        wanted = F.broadcast(wanted)
    texts_of = materialize(candidate_texts(rows, wanted), "candidate-texts")
    searched = searched.join(texts_of.select("node", "n", "bits"), "node")
    # A block that one node alone searches by can link nothing.
    common = searched.groupBy("key").agg(F.count("*").alias("k")).where("k > 1").select("key")
    searched = materialize(searched.join(common, "key"), "common-blocks")

    nothing = spark.createDataFrame([], "node long, label long")
    labels: DataFrame | None = None
    done: DataFrame | None = None

    def joined(pairs: DataFrame, name: str) -> int:
        nonlocal labels, done
        if done is not None:
            pairs = pairs.join(done, ["a", "b"], "left_anti")
        pairs = materialize(pairs, f"pairs-{name}")
        done = pairs if done is None else done.union(pairs)
        new = materialize(verified(pairs, texts_of, percent), f"links-{name}")
        if linked := new.count():
            labels = merged(labels, new)
        return linked

    # Rounds of stars: one member of each block with the others. The first brings most of what is
    # linked together; more follow while too many pairs would be open. Then those, all of them.
    size, before = searched.count(), None
    groups = searched.withColumn("comp", F.col("node"))
    for turn in range(STAR_ROUNDS + 1):
        linked = joined(_stars(groups, turn, percent), f"star-{turn}")
        groups = materialize(_groups(searched, labels or nothing), f"open-{turn}")
        each = groups.groupBy("key").agg(F.first("all").alias("k"), F.first("most").alias("m"))
        left = each.agg(F.sum((F.col("k") - F.col("m")) * F.col("k").cast("double"))).first()[0] or 0
        few = left <= PAIRS_PER_ROW * size and linked <= LINKS_PER_ROW * size
        if few or (before is not None and left > 0.9 * before):
            break
        before = left
    if left:
        joined(_all_pairs(groups, percent), "rest")
    return counted, labels or nothing


def near_duplicates(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", percent: int = PERCENT
) -> DataFrame:
    """``FILE``, ``ROW``, ``doc_id``, ``n_shingles``, ``component`` of every row.

    Two documents are linked if 100 times the size of the intersection of their shingle sets is
    at least ``percent`` times that of the union; ``component`` names the set of documents
    reachable over links, null for texts without words (null and empty ones), which link with
    nothing. A text of fewer than five words is one shingle. Repeated rows are linked. Shingles are
    64-bit hashes; links are exact but for their collisions. Sets are told apart by 126 bits.
    """
    rows = stored(docs, doc_id, text).select(
        F.col(doc_id).alias("doc_id"), F.col(text).alias("t"), FILE, ROW
    )
    counted, labels = linked_nodes(rows, percent)
    return (
        counted.join(labels, "node", "left")
        .select(
            FILE, ROW, "doc_id", F.col("n").alias("n_shingles"), F.coalesce("label", "node").alias("component")
        )
    )


def op5_jaccard_join(docs: DataFrame) -> DataFrame:
    """The component of every document, named by its smallest ``doc_id``.

    A document without words is its own component. Null ids are not considered for the name.
    """
    found = materialize(near_duplicates(docs), "components")
    names = found.where(F.col("component").isNotNull()).groupBy("component").agg(F.min("doc_id").alias("name"))
    return found.join(names, "component", "left").select(
        "doc_id",
        "n_shingles",
        F.when(F.col("component").isNull(), F.col("doc_id")).otherwise(F.col("name")).alias("component_id"),
    )


def one_of_each(docs: DataFrame) -> DataFrame:
    """One document of every component, that with the smallest ``doc_id`` (of several rows with
    it the first in storage; null ids come last), and all without words; columns as they were,
    whatever their names."""
    inner = in_files(plain(docs, "doc_id", "text"))
    found = materialize(near_duplicates(inner), "components")
    order = F.struct(F.col("doc_id").isNull(), "doc_id", FILE, ROW)
    grouped = found.where(F.col("component").isNotNull())
    first = grouped.groupBy("component").agg(F.min(order).alias("first"), F.count("*").alias("k")).where("k > 1")
    dropped = materialize(
        grouped.join(first, "component")
        .where((F.col(FILE) != F.col(f"first.{FILE}")) | (F.col(ROW) != F.col(f"first.{ROW}")))
        .select(FILE, ROW),
        "dropped",
    )
    if fits_broadcast(dropped, ID_BYTES):
        dropped = F.broadcast(dropped)
    return restored(stored(inner).join(dropped, [FILE, ROW], "left_anti"), inner, docs)
