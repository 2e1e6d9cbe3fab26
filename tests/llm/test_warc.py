import glob
import gzip
import hashlib
import random
import re

import pytest
from pyspark.sql import functions as F

from tamis.llm import warc as M

FAKE = "WARC/1.1\r\nWARC-Type: response\r\nContent-Length: 5\r\n\r\nhello\r\n\r\n"
LONG = "WARC/1.0\r\nContent-Length: 999999\r\n\r\n"
ROWS = [
    (None, None, None),
    (None, "http://a b\r\nX: 1", FAKE * 3),
    (1, "u", ""),
    (1, "u", ""),
    (2, "u", "x" * 200),
    (3, "u", "x" * 200),
    (3, "u", "x" * 200),
    (None, "u", "x" * 200),
    (5, None, LONG + "WARC/1." * 50 + "é" * 100),
    (6, "u", "y" * 99),
    (7, "u", "y" * 99),
    (8, "u", "WARC/1."),
    (9, "u", "one long text " * 100_000),
    (10, "u", "é" * 50),
    (11, "u", "é" * 50),
]


def pieces(n, seed):
    rng = random.Random(seed)
    parts = ["WARC/1.", "WARC/", FAKE, LONG, "\r\n\r\n", "texte é ", "\r\nContent-Length: 3"]
    return [(100 + i, f"http://h/{i}", "".join(rng.choices(parts, k=rng.randrange(30)))) for i in range(n)]


def table(spark, rows):
    """Columns beyond the three have names that the operator uses itself."""
    df = spark.createDataFrame(rows, "page_id long, url string, html string")
    names = ("a.b", "_metadata", "__file", "__row", "digest", "place")
    return df.withColumns({n: F.lit(i) for i, n in enumerate(names)})


def brute(rows):
    """By page: bytes, digest, type, response. Of repeated rows one is the response."""
    first, had, out = {}, set(), []
    for page_id, _, html in rows:
        if len((html or "").encode()) >= 100 and page_id is not None:
            first[html] = min(first.get(html, page_id), page_id)
    for page_id, _, html in rows:
        data = (html or "").encode()
        again = len(data) >= 100 and (html in had if first.get(html) == page_id else True)
        had.add(html) if first.get(html) == page_id else None
        if first.get(html) is None:
            again = False
        kind = ("revisit", first.get(html)) if again else ("response", None)
        out.append((page_id, len(data), hashlib.sha256(data).hexdigest(), *kind))
    return sorted(out, key=repr)


def one_after_another(data):
    """Records of an archive, read from its start."""
    at, out = 0, []
    while at < len(data):
        end = data.index(b"\r\n\r\n", at)
        n = int(re.search(rb"\r\nContent-Length: (\d+)", data[at:end])[1])
        out.append((data[at + len("WARC/1.") : end].decode(), data[end + 4 : end + 4 + n]))
        at = end + 4 + n + 4
    return out


def found(lines):
    return sorted((r.header, bytes(r.content)) for r in M.records(lines).collect())


def rows(df):
    return sorted(map(tuple, df.collect()), key=repr)


def test_round_trip(spark):
    given = ROWS + pieces(20, 1)
    assert rows(M.op12_warc(table(spark, given))) == brute(given)


def test_one_payload_for_most_pages(spark):
    given = [(i, "u", "z" * 150 if i % 3 else f"{i}" * 100) for i in range(300)]
    assert rows(M.op12_warc(table(spark, given))) == brute(given)


@pytest.mark.parametrize("split_bytes", [200, 1500, 1 << 26])
def test_records_across_splits(spark, tmp_path, split_bytes):
    path = str(tmp_path / "archives")
    M.write_warc(table(spark, pieces(12, split_bytes)).repartition(2), path)
    expected = sorted(r for f in glob.glob(f"{path}/part*") for r in one_after_another(open(f, "rb").read()))
    assert found(M.scan(spark, path, split_bytes)) == expected


def test_compressed_archives_of_others(spark, tmp_path):
    """Members of a file are compressed one by one; fields in other cases, bytes that are no text."""
    record = b"WARC/1.0\r\nwarc-type: resource\r\nwarc-record-id: <urn:x>\r\ncontent-length:%d\r\n\r\n%s\r\n\r\n"
    contents = [b"", b"\xff\xfe\x00WARC/1.", b"text"]
    with open(tmp_path / "a.warc.gz", "wb") as f:
        for c in contents:
            f.write(gzip.compress(record % (len(c), c)))
    (tmp_path / "b.warc").write_bytes(record % (4, b"more"))
    (tmp_path / "empty.warc").write_bytes(b"")
    read = M.read_warc(spark, str(tmp_path)).collect()
    assert sorted(bytes(r.payload) for r in read) == sorted([*contents, b"more"])
    assert {(r.record_type, r.record_id, r.target_uri) for r in read} == {("resource", "<urn:x>", None)}


@pytest.mark.parametrize("broken", [b"no archive", LONG.encode(), FAKE.encode() + b"rest", FAKE.encode()[:-3]])
def test_broken_chains_are_an_error(spark, tmp_path, broken):
    (tmp_path / "a.warc").write_bytes(broken)
    with pytest.raises(ValueError, match="no whole chain"):
        M.records(M.scan(spark, str(tmp_path)))


def test_fields(spark, tmp_path):
    M.write_warc(table(spark, [(4, "http://a b\r\nX: 1", "t")]), str(tmp_path / "w"), date="2001-02-03T04:05:06Z")
    (r,) = M.read_warc(spark, str(tmp_path / "w")).collect()
    assert (r.record_type, r.target_uri, r.date, r.page_id) == (
        "response", "http://a%20b%0D%0AX:%201", "2001-02-03T04:05:06Z", "4"
    )
    assert r.digest == "sha256:" + hashlib.sha256(b"t").hexdigest() and bytes(r.payload) == b"t"


def test_empty_table(spark):
    assert M.op12_warc(table(spark, [])).collect() == []
