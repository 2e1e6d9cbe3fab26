import pytest

from tamis.llm import urls as M

URLS = [
    None, "", "no scheme", "http://", "https://EN.Example.ORG/fr/1?x=/de/#y", "http://example.net",
    "http://example.net/en/5", "http://www.example.net/de/5", "http://notexample.net/en/", "ftp://a.b#c/d",
    "x://y://z/fr/", "http://example.com/de/é数?q", "http://myexample.com/de/1", "http://org/fr/", "http://org?/fr/",
    "http://a.example.com/DE/1",
] + ["https://same.example.org/fr/1"] * 3


def pages(spark, urls):
    return spark.createDataFrame(
        [(None if i == 2 else i, u, "<p>", 5) for i, u in enumerate(urls)], "page_id long, url string, html string, uid int"
    )


def brute(url):
    host = path = ""
    if url and "://" in url:
        rest = url.split("://", 1)[1]
        end = min([rest.find(c) for c in "/?#" if c in rest], default=len(rest))
        host = "".join(c.lower() if c.isascii() else c for c in rest[:end])
        path = rest[end:]
        path = path[: min([path.find(c) for c in "?#" if c in path], default=len(path))]
    fits = [
        r for r in M.RULES if (host == r.host or host.endswith("." + r.host)) and path.startswith(r.path)
    ]
    best = max(fits, key=lambda r: len(r.name), default=None)
    return host, path, best.name if best else None, best.verdict if best else None


def test_parts_and_rules_match_brute_force(spark):
    found = M.op7_urls(pages(spark, URLS)).collect()
    expected = sorted([(None if i == 2 else i, *brute(u)) for i, u in enumerate(URLS)], key=repr)
    assert sorted([(r.page_id, r.host, r.path, r.rule, r.verdict if r.rule else None) for r in found], key=repr) == expected
    assert {r.verdict for r in found} <= {"allow", "block"}


def test_score_is_the_ratio_of_the_two_models(spark):
    """Against a direct evaluation of the smoothed models, character by character."""
    import math

    from pyspark.sql import functions as F

    urls = [f"http://{h}.example.org/fr/{i}" for i, h in enumerate(["alpha", "beta", "gamma"] * 4)]
    urls += [f"http://{h}.spam.net/{i}" for i, h in enumerate(["pills", "bets", "cash"] * 4)]
    urls += ["http://alpha.example.com/7", "http://pills.example.com/7", "http://zz.example.com/ü"]
    rows = M.parsed_pages(pages(spark, urls), "page_id", "url", M.RULES)
    training = rows.where(F.col("decided").isNotNull())
    scored = {r.uid: r.total / M.MILLION for r in M.scored_urls(rows, M.gram_weights(training)).collect()}
    local = {r.uid: (M.START + r.host + r.path + M.END, r.decided) for r in rows.collect()}

    def model(kind):
        texts = [t for t, d in local.values() if d == kind]

        def n(gram):
            return sum(t[i : i + len(gram)] == gram for t in texts for i in range(len(t) - len(gram) + 1))

        def p(context, c):
            shorter = p(context[1:], c) if context else 1 / M.ALPHABET
            after = sum(t[i : i + len(context)] == context for t in texts for i in range(len(t) - len(context)))
            return (n(context + c) + M.SMOOTHING * shorter) / (after + M.SMOOTHING)

        return p

    allow, block = model("allow"), model("block")
    for uid, (text, _) in local.items():
        ratio = sum(
            math.log(allow(text[max(0, i - M.GRAM + 1) : i], c) / block(text[max(0, i - M.GRAM + 1) : i], c))
            for i, c in enumerate(text)
        )
        assert scored[uid] == pytest.approx(ratio, abs=1e-3)


def test_shuffled_weights_give_the_same(spark, monkeypatch):
    docs = spark.read.parquet("/root/testdata/sf0.01/pages.parquet")
    one = sorted(map(tuple, M.judge_urls(docs).collect()))
    monkeypatch.setattr(M, "WEIGHT_BYTES", -1)
    assert sorted(map(tuple, M.judge_urls(docs).collect())) == one
    assert {r[4] for r in one if r[3] is None} == {"allow", "block"}


def test_empty_table(spark):
    assert M.op7_urls(pages(spark, URLS).where("false")).collect() == []
