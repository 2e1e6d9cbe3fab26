import os

import pytest
from pyspark.sql import functions as F

from tamis.operators import ranking as R
from tamis.operators import sampling as N
from tamis.sources import corpus, sinks
from tamis.sources.staging import materialize, new_path, scratch, shared_dir


@pytest.fixture
def folder(spark, tmp_path):
    """Files whose order by name differs from their sizes, with names that need quoting."""
    import pyarrow as pa
    import pyarrow.parquet as pq

    names = {"b": 3, "a": 5, "a b": 2, "a+c": 4, "c": 40, "ä": 1, "10": 2, "9": 3}
    start = 0
    for name in sorted(names, key=lambda n: f"{n}.parquet"):
        ids = list(range(start, start + names[name]))
        start += names[name]
        table = pa.table({
            "place": ids,
            "en": [None if i % 5 == 0 else f"line {i}" for i in ids],
            "de": [f"zeile {i}" for i in ids],
            "tokens": [["a", f"b{i}"] for i in ids],
        })
        pq.write_table(table, f"{tmp_path}/{name}.parquet", row_group_size=7)
    os.makedirs(f"{tmp_path}/deeper")
    pq.write_table(table, f"{tmp_path}/deeper/z.parquet")
    return str(tmp_path)


def test_rows_are_numbered_in_path_order(spark, folder):
    pairs = corpus.read_corpus(spark, folder, "en", "de").orderBy("seg_id").collect()
    assert [r["seg_id"] for r in pairs] == list(range(60))
    for r in pairs:
        assert r["src"] == ("" if r["seg_id"] % 5 == 0 else f"line {r['seg_id']}")
        assert r["tgt"] == f"zeile {r['seg_id']}"


def test_prefix(spark, folder):
    pairs = corpus.read_corpus(spark, f"{folder}/a", "en", "de")
    assert sorted(r["seg_id"] for r in pairs.collect()) == list(range(5 + 2 + 4))
    assert corpus.read_corpus(spark, folder + "/", "en", "de").count() == 60


@pytest.mark.parametrize("n", [0, 1, 5, 6, 11, 59, 60, 100])
def test_head_reads_the_same_rows(spark, folder, n):
    whole = corpus.read_corpus(spark, folder, "en", "de")
    head = corpus.read_corpus_head(spark, folder, "en", "de", n)
    assert sorted(map(tuple, head.collect())) == sorted(map(tuple, N.sample_first_n(whole, n).collect()))


def test_token_columns_and_errors(spark, folder):
    pairs = corpus.read_corpus(spark, folder, "tokens", "de").orderBy("seg_id")
    assert pairs.first()["src"] == "a b0"
    with pytest.raises(TypeError, match="bigint"):
        corpus.read_corpus(spark, folder, "place", "de")
    with pytest.raises(ValueError, match="no column"):
        corpus.read_corpus(spark, folder, "en", "fr")
    for nowhere in (f"{folder}/nothing", f"{folder}/deeper/none"):
        with pytest.raises(FileNotFoundError):
            corpus.read_corpus(spark, nowhere, "en", "de")


def test_columns_of_any_name(spark, tmp_path):
    import pyarrow as pa
    import pyarrow.parquet as pq

    names = ("file", "row", "seg_id", "size", "skip", "_metadata", "a.b")
    for k, start in enumerate((0, 4)):
        columns = {name: [f"{name} {i}" for i in range(start, start + 4)] for name in names}
        pq.write_table(pa.table(columns), f"{tmp_path}/{k}.parquet")
    for name in names:
        rows = corpus.read_corpus(spark, str(tmp_path), name, "row").collect()
        assert sorted(map(tuple, rows)) == [(i, f"{name} {i}", f"row {i}") for i in range(8)]
    numbered = corpus.seg_ids(spark.read.parquet(str(tmp_path)))
    assert sorted((r["seg_id"], r["file"], r["row"]) for r in numbered.collect()) == [
        (i, f"file {i}", f"row {i}") for i in range(8)
    ]


@pytest.fixture
def odd_names(folder):
    """The files of ``folder``, and two whose names Spark's reader passes over."""
    import pyarrow as pa
    import pyarrow.parquet as pq

    # In order by name: .c, 10, 9, _b, a b, a+c, a, ...
    for name, size in ((".c", 20), ("_b", 9)):
        table = pa.table({
            "en": [None if i == 3 else f"{name} {i}" for i in range(size)],
            "de": [f"{name} zeile {i}" for i in range(size)],
            "tokens": [["x", None, f"{name}{i}"] for i in range(size)],
            "place": list(range(size)),
        })
        pq.write_table(table, f"{folder}/{name}.parquet", row_group_size=7)
    return folder


def test_files_that_spark_passes_over_are_read(spark, odd_names):
    rows = corpus.read_corpus(spark, odd_names, "en", "de").orderBy("seg_id").collect()
    assert [r["seg_id"] for r in rows] == list(range(60 + 20 + 9))
    dots = [("" if i == 3 else f".c {i}", f".c zeile {i}") for i in range(20)]
    lines = [("" if i == 3 else f"_b {i}", f"_b zeile {i}") for i in range(9)]
    assert [(r["src"], r["tgt"]) for r in rows[:20]] == dots
    # 10.parquet and 9.parquet come between: two rows and three
    assert [(r["src"], r["tgt"]) for r in rows[25:34]] == lines


def test_odd_names_by_prefix_and_alone(spark, odd_names):
    assert corpus.read_corpus(spark, f"{odd_names}/_", "en", "de").count() == 9
    tokens = corpus.read_corpus(spark, f"{odd_names}/.c", "tokens", "en").orderBy("seg_id").first()
    assert tuple(tokens) == (0, "x .c0", ".c 0")
    with pytest.raises(Exception, match="not string"):
        corpus.read_corpus(spark, f"{odd_names}/_", "place", "de").collect()


@pytest.mark.parametrize("n", [0, 7, 20, 27, 89, 100])
def test_head_with_odd_names(spark, odd_names, n):
    whole = corpus.read_corpus(spark, odd_names, "en", "de")
    head = corpus.read_corpus_head(spark, odd_names, "en", "de", n)
    assert sorted(map(tuple, head.collect())) == sorted(map(tuple, N.sample_first_n(whole, n).collect()))


def test_the_first_rows_are_read_from_their_files_alone(spark, folder):
    opened = corpus.open_corpus(spark, folder, "en", "de")

    def files_read(df):
        plan = df._jdf.queryExecution().executedPlan()
        df.collect()
        scans = plan.collectLeaves()
        found = [scans.apply(i).metrics().get("numFiles") for i in range(scans.size())]
        return max(m.get().value() for m in found if m.isDefined())

    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        assert files_read(opened.first(3)) == 2  # 10 and 9 hold the first two and three rows
        assert files_read(opened.pairs) == 8
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")


def test_parallel_text_whatever_the_splits(spark, tmp_path):
    lines = [f"line {i}" for i in range(20000)]
    for lang in ("en", "de"):
        (tmp_path / f"c.{lang}").write_text("".join(f"{lang} {x}\n" for x in lines))
    key = "spark.sql.files.maxPartitionBytes"
    old = spark.conf.get(key)
    spark.conf.set(key, "9000")
    try:
        pairs = corpus.read_parallel_text(spark, f"{tmp_path}/c", "en", "de")
        spark.conf.set(key, "31000")  # other splits when the frame is run
        rows = pairs.orderBy("seg_id").collect()
    finally:
        spark.conf.set(key, old)
    assert [tuple(r) for r in rows] == [(i, f"en {x}", f"de {x}") for i, x in enumerate(lines)]


def test_parallel_text(spark, tmp_path):
    lines = [f"line {i}\r" if i % 3 else "" for i in range(20000)]
    (tmp_path / "c.en").write_text("\n".join(lines) + "\n")
    (tmp_path / "c.de").write_text("\n".join(x.upper() for x in lines) + "\n")
    key = "spark.sql.files.maxPartitionBytes"
    old = spark.conf.get(key)
    spark.conf.set(key, "9000")  # many splits per file
    try:
        pairs = corpus.read_parallel_text(spark, f"{tmp_path}/c", "en", "de")
        rows = pairs.orderBy("seg_id").collect()
    finally:
        spark.conf.set(key, old)
    assert [(r["seg_id"], r["src"], r["tgt"]) for r in rows] == [
        (i, x, x.upper()) for i, x in enumerate(lines)
    ]
    (tmp_path / "d.en").write_text("a\nb\nc\n")
    (tmp_path / "d.de").write_text("a\nb\n")
    with pytest.raises(ValueError, match="3 en lines, 2 de lines"):
        corpus.read_parallel_text(spark, f"{tmp_path}/d", "en", "de")


def test_write_ranked(spark):
    rows = [(i, float(i % 7), f"s\t{i}\r\nnext", "" if i % 4 == 0 else f"t{i}") for i in range(100)]
    frame = spark.createDataFrame(rows, "seg_id long, score double, src string, tgt string")
    ranked = R.rank(frame)
    dest = new_path(spark, "sorted")
    sinks.write_ranked(ranked, dest, "en", "de", parts=7, parquet=True)
    expected = [(r["src"].replace("\r\n", " "), r["tgt"]) for r in ranked.orderBy("rank").collect()]
    texts = []
    for lang in ("en", "de"):
        path = f"{dest}/general_corpus_sorted.{lang}"
        parts = sorted(p for p in os.listdir(path) if p.startswith("part-"))
        assert len(parts) == 7
        texts.append("".join(open(f"{path}/{p}", newline="").read() for p in parts).split("\n")[:-1])
    assert list(zip(*texts)) == expected
    assert spark.read.parquet(f"{dest}/general_corpus_sorted.parquet").count() == 100
    with pytest.raises(Exception, match="(?i)exists"):
        sinks.write_ranked(ranked, dest, "en", "de")
    sinks.write_ranked(ranked, dest, "en", "de", mode="overwrite")
    assert sorted(os.listdir(dest)) == [
        "general_corpus_sorted.de", "general_corpus_sorted.en", "general_corpus_sorted.parquet"
    ]
    whole = "".join(
        open(f"{dest}/general_corpus_sorted.en/{p}", newline="").read()
        for p in sorted(os.listdir(f"{dest}/general_corpus_sorted.en")) if p.startswith("part-")
    )
    assert whole.split("\n")[:-1] == [r[0] for r in expected]
    sinks.write_ranked(ranked.filter("false"), dest, "en", "de", mode="overwrite")
    assert corpus.numbered_lines(spark, f"{dest}/general_corpus_sorted.en").count() == 0
    with pytest.raises(ValueError):
        sinks.write_ranked(ranked, dest, "en", "en")


def test_a_failed_rename_leaves_both_earlier_sides(spark, monkeypatch):
    frames = [
        spark.createDataFrame([(1, 0.0, 0, f"{name} src", f"{name} tgt")], "rank long, score double, seg_id long, src string, tgt string")
        for name in ("old", "new")
    ]
    dest = new_path(spark, "sorted")
    rename = sinks._rename

    def failing(session, source, target):
        if "writing" in source and target.endswith(".de"):
            raise OSError("no rename")
        rename(session, source, target)

    def texts():
        return [corpus.numbered_lines(spark, f"{dest}/general_corpus_sorted.{x}").first()["text"] for x in ("en", "de")]

    sinks.write_ranked(frames[0], dest, "en", "de")
    with monkeypatch.context() as m, pytest.raises(OSError, match="no rename"):
        m.setattr(sinks, "_rename", failing)
        sinks.write_ranked(frames[1], dest, "en", "de", mode="overwrite")
    assert texts() == ["old src", "old tgt"]
    assert len(os.listdir(dest)) == 2
    sinks.write_ranked(frames[1], dest, "en", "de", mode="overwrite")
    assert texts() == ["new src", "new tgt"] and len(os.listdir(dest)) == 2


def test_shared_folder_is_the_one_the_session_names(spark):
    assert shared_dir(spark) == spark.conf.get("spark.checkpoint.dir").rstrip("/")


def test_scratch_tables_are_removed(spark, tmp_path):
    with scratch(spark) as folder:
        kept = materialize(spark.range(10), "numbers")
        with scratch(spark):
            materialize(spark.range(10), "numbers")
        kept.write.parquet(f"{tmp_path}/kept")
        assert os.path.isdir(folder) and len(os.listdir(folder)) == 1
    assert not os.path.exists(folder)
    assert spark.read.parquet(f"{tmp_path}/kept").count() == 10
    assert not new_path(spark, "x").startswith(folder)


def test_project_text_keeps_ids(spark):
    frame = spark.createDataFrame([(1, "a", None)], "seg_id long, x string, y string")
    assert tuple(corpus.project_text(frame, "x", "y").first()) == (1, "a", "")
    assert corpus.project_text(frame, "y", "x").select(F.col("src")).first()[0] == ""
