import zlib

from conftest_llm import ODD, documents

from tamis.llm.sharding import ROW_OVERHEAD, op1_sharding


def brute(rows, shards):
    sized = sorted(
        (
            (d is not None, d or 0, zlib.crc32((t or "").encode()), d, len((t or "").encode()) + ROW_OVERHEAD)
            for d, t, *_ in rows
        ),
        key=lambda r: r[:3],
    )
    total, before, out, slots = sum(r[4] for r in sized), 0, [], [0] * shards
    for _, _, crc, doc_id, size in sized:
        shard = min((2 * before + size) * shards // (2 * total), shards - 1)
        out.append((doc_id, size, crc, "bytes", shard, slots[shard], None))
        slots[shard] += 1
        before += size
    return out


def rows(df):
    return sorted(map(tuple, df.collect()), key=repr)


def test_matches_brute_force_on_odd_rows(spark, odd):
    assert rows(op1_sharding(odd, 5)) == sorted(brute(ODD, 5), key=repr)


def test_balance_and_contiguity(spark):
    texts = [(i * 3 % 500, "x" * (i * 37 % 91)) for i in range(500)]
    found = op1_sharding(documents(spark, texts)).collect()
    sizes = [sum(r["size"] for r in found if r["shard"] == s) for s in range(40)]
    assert max(sizes) - min(sizes) <= 2 * max(r["size"] for r in found)
    by_id = sorted(found, key=lambda r: r["doc_id"])
    assert [r["shard"] for r in by_id] == sorted(r["shard"] for r in by_id)
    for s in range(40):
        assert sorted(r["slot"] for r in found if r["shard"] == s) == list(range(len([r for r in found if r["shard"] == s])))


def test_one_id_for_all_rows(spark):
    found = op1_sharding(documents(spark, [(1, "same")] * 400)).collect()
    assert sorted(r["shard"] for r in found) == sorted(i // 10 for i in range(400))


def test_empty_table(none):
    assert op1_sharding(none).collect() == []
