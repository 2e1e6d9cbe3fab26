"""The registered queries: a Spark callable and, where there is one, the SQL for its result.

Every query reads whole tables. Columns are named alike on both sides; probabilities and
scores are rounded to six decimals.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import text as X
from ..operators import ngram_model as M
from ..operators import ranking as R
from ..operators import sampling as N
from ..operators import scoring as S
from ..operators import vocabulary as V
from ..plans import select as P
from ..sources import corpus, sinks
from ..sources.staging import materialize, new_path
from . import oracle as O
from .corpora import dialogues, documents, segments, table

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}


def register(name: str, sql: str) -> Callable[[Query], Query]:
    def add(query: Query) -> Query:
        QUERIES[name] = query
        SQL[name] = sql
        return query

    return add


def six(*names: str) -> list[Column]:
    return [S.rounded(F.col(name)).alias(name) for name in names]


def sql_six(*names: str) -> str:
    return ", ".join(f"round({name}, 6) + 0.0 AS {name}" for name in names)


# --- sources and sinks ---------------------------------------------------------------

ONE_LINE = "regexp_replace({0}, '\r\n|\r|\n', ' ', 'g')"


@register("read_corpus", "SELECT doc_id AS seg_id, text AS src, lang AS tgt FROM documents")
def read_corpus(spark, sf_dir):
    return corpus.read_corpus(spark, f"{sf_dir}/documents", "text", "lang")


@register(
    "read_corpus_odd_names",
    "SELECT row_number() OVER (ORDER BY doc_id) - 1 AS seg_id, text AS src, lang AS tgt FROM documents",
)
def read_corpus_odd_names(spark, sf_dir):
    """All documents from a folder in which the first files bear names that Spark passes over."""
    dest = new_path(spark, "odd")
    docs = table(spark, sf_dir, "documents").repartitionByRange(6, "doc_id")
    docs.sortWithinPartitions("doc_id").write.parquet(dest)
    folder = spark._jvm.org.apache.hadoop.fs.Path(dest)
    store = folder.getFileSystem(spark._jsc.hadoopConfiguration())
    parts = sorted(f.getPath().getName() for f in store.listStatus(folder))
    parts = [name for name in parts if name.startswith("part-")]
    for name in parts[: len(parts) // 2]:
        old, new = (spark._jvm.org.apache.hadoop.fs.Path(folder, n) for n in (name, f"_{name}"))
        store.rename(old, new)
    return corpus.read_corpus(spark, dest, "text", "lang")


@register(
    "project_text",
    "SELECT CASE WHEN quality = 1 THEN text ELSE '' END AS src, coalesce(nullif(lang, 'en'), '') AS tgt"
    " FROM documents LEFT JOIN labels USING (doc_id)",
)
def project_text(spark, sf_dir):
    # texts of documents that are not known to be good are null, and so is the main language
    good = table(spark, sf_dir, "labels").select("doc_id", "quality")
    docs = table(spark, sf_dir, "documents").join(good, "doc_id", "left")
    some = docs.select(F.expr("CASE WHEN quality = 1 THEN text END AS text"), F.expr("nullif(lang, 'en') AS lang"))
    return corpus.project_text(some, "text", "lang")


@register(
    "seg_ids",
    "SELECT row_number() OVER (ORDER BY conv_id, turn) - 1 AS seg_id, conv_id, turn, role, text"
    " FROM conversations",
)
def seg_ids(spark, sf_dir):
    return corpus.seg_ids(table(spark, sf_dir, "conversations"))


@register(
    "read_parallel_text",
    O.query(
        "SELECT row_number() OVER (ORDER BY seg_id) - 1 AS seg_id,"
        f" {ONE_LINE.format('src')} AS src, {ONE_LINE.format('tgt')} AS tgt FROM gen_pairs",
        O.DIALOGUES,
    ),
)
def read_parallel_text(spark, sf_dir):
    pairs = materialize(dialogues(spark, sf_dir).general, "pairs")
    prefix = f"{new_path(spark, 'parallel')}/corpus"
    sinks.write_lines(pairs, "seg_id", "src", f"{prefix}.asked")
    sinks.write_lines(pairs, "seg_id", "tgt", f"{prefix}.answered")
    return corpus.read_parallel_text(spark, prefix, "asked", "answered")


@register(
    "write_ranked",
    O.query(
        f"SELECT rank - 1 AS seg_id, {ONE_LINE.format('src')} AS src,"
        f" {ONE_LINE.format('tgt')} AS tgt FROM ranked",
        *O.scored(O.DIALOGUES), O.diffs(O.LOGPROB), O.ranking(),
    ),
)
def write_ranked(spark, sf_dir):
    dest = new_path(spark, "sorted")
    sinks.write_ranked(P.select(*dialogues(spark, sf_dir)), dest, "asked", "answered")
    return corpus.read_parallel_text(spark, f"{dest}/general_corpus_sorted", "asked", "answered")


def sql_masked(source: str) -> str:
    return f"""
masked AS (
  SELECT s.seg_id, coalesce(string_agg(CASE WHEN v.tok IS NULL THEN '<unk>' ELSE t.tok END, ' '
                                       ORDER BY t.pos) FILTER (t.tok IS NOT NULL), '') AS text
  FROM {source} s LEFT JOIN ({O.split(source)}) t ON s.seg_id = t.seg_id
  LEFT JOIN vocab v ON t.tok = v.tok GROUP BY s.seg_id)"""


def specific_words(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The vocabulary of the specific documents."""
    return V.vocab(V.token_counts(segments(documents(spark, sf_dir).specific)))


@register(
    "write_filtered_text",
    O.query(
        "SELECT row_number() OVER (ORDER BY seg_id) - 1 AS seg_id, text FROM masked",
        O.DOCUMENTS, O.COUNTS, O.FIRST, sql_masked("sample"),
    ),
)
def write_filtered_text(spark, sf_dir):
    docs = documents(spark, sf_dir)
    n = V.count_segments(docs.specific).first()["n"]
    dest = new_path(spark, "masked")
    sinks.write_filtered_text(segments(docs.general), specific_words(spark, sf_dir), dest, n)
    return corpus.numbered_lines(spark, dest)


MODELS = f"SELECT model, side, n::INTEGER AS n, gram, {sql_six('logp', 'bow')} FROM models"


def models_of(pairs) -> DataFrame:
    return P.train_models(pairs.general, pairs.specific, ("src", "tgt"))


@register("save_model", O.query(MODELS, *O.trained(O.DIALOGUES)))
def save_model(spark, sf_dir):
    path = new_path(spark, "saved")
    sinks.save_model(models_of(dialogues(spark, sf_dir)), path)
    kept = spark.read.parquet(path)
    return kept.select("model", "side", "n", "gram", *six("logp", "bow"))


@register("load_model", O.query(MODELS, *O.trained(O.DIALOGUES)))
def load_model(spark, sf_dir):
    path = new_path(spark, "saved")
    sinks.save_model(models_of(dialogues(spark, sf_dir)), path)
    return sinks.load_model(spark, path).select("model", "side", "n", "gram", *six("logp", "bow"))


# --- text functions ------------------------------------------------------------------


def per_token(words: DataFrame, *steps) -> DataFrame:
    for step in steps:
        words = words.withColumn("w", step(F.col("w")))
    # A plain explode has its array worked out once more, to filter out rows whose array is empty.
    tokens = words.select("doc_id", F.posexplode_outer("w").alias("pos", "tok"))
    return tokens.filter(F.col("pos").isNotNull())


def document_words(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents").select("doc_id", X.tokenize(F.col("text")).alias("w"))


def masked_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """General documents with words unknown to the specific ones masked: with reserved symbols,
    and some without any other word."""
    general = segments(documents(spark, sf_dir).general)
    masked = V.masked_words(general, specific_words(spark, sf_dir))
    return masked.select(F.col("seg_id").alias("doc_id"), F.col("words").alias("w"))


def sql_per_token(words: str) -> str:
    return (
        "SELECT doc_id, (generate_subscripts(w, 1) - 1)::INTEGER AS pos, unnest(w) AS tok FROM"
        f" (SELECT doc_id, {words} AS w FROM (SELECT doc_id, {O.words('text')} AS w FROM documents))"
    )


@register("tokenize", sql_per_token("w"))
def tokenize(spark, sf_dir):
    return per_token(document_words(spark, sf_dir))


SKIPPED = f"""
skipped AS (
  SELECT t.seg_id AS doc_id, t.tok,
         (row_number() OVER (PARTITION BY t.seg_id ORDER BY t.pos) - 1)::INTEGER AS pos
  FROM ({O.split('gen')}) t JOIN vocab v ON t.tok = v.tok
  WHERE t.tok NOT IN ('<s>', '</s>', '<unk>'))"""


@register(
    "empty_to_unk",
    O.query(
        "SELECT doc_id, pos, tok FROM skipped UNION ALL SELECT seg_id, 0, '<unk>' FROM gen"
        " WHERE seg_id NOT IN (SELECT doc_id FROM skipped)",
        O.DOCUMENTS, O.COUNTS, SKIPPED,
    ),
)
def empty_to_unk(spark, sf_dir):
    return per_token(masked_documents(spark, sf_dir), X.skip_symbols, X.empty_to_unk)


@register(
    "skip_symbols",
    O.query("SELECT doc_id, pos, tok FROM skipped", O.DOCUMENTS, O.COUNTS, SKIPPED),
)
def skip_symbols(spark, sf_dir):
    return per_token(masked_documents(spark, sf_dir), X.skip_symbols)


@register("pad_sentence", sql_per_token("['<s>'] || w || ['</s>']"))
def pad_sentence(spark, sf_dir):
    return per_token(document_words(spark, sf_dir), X.pad_sentence)


@register(
    "ngrams",
    f"""WITH t AS (SELECT conv_id, turn, {O.words('text')} AS w FROM conversations),
s AS (SELECT conv_id, turn, w, unnest(range(1, len(w) + 1)) AS i FROM t),
g AS (SELECT *, unnest(range(1, 6)) AS n FROM s)
SELECT conv_id, n::INTEGER AS n, array_to_string(w[i:i + n - 1], ' ') AS gram, count(*) AS cnt
FROM g WHERE i + n - 1 <= len(w) GROUP BY ALL""",
)
def ngrams(spark, sf_dir):
    words = table(spark, sf_dir, "conversations").select("conv_id", X.tokenize(F.col("text")).alias("w"))
    grams = words.select("conv_id", F.inline(X.ngrams(F.col("w"))))
    return grams.groupBy("conv_id", "n", "gram").agg(F.count(F.lit(1)).alias("cnt"))


@register(
    "mask_oov",
    O.query("SELECT seg_id, text FROM masked", O.DOCUMENTS, O.COUNTS, sql_masked("gen")),
)
def mask_oov(spark, sf_dir):
    docs = documents(spark, sf_dir)
    return V.mask_oov(segments(docs.general), specific_words(spark, sf_dir))


# --- samples -------------------------------------------------------------------------


def sampled(spark: SparkSession, sf_dir: str, draw) -> DataFrame:
    docs = documents(spark, sf_dir)
    n = V.count_segments(docs.specific).first()["n"]
    return draw(segments(docs.general), n)


SAMPLE = "SELECT seg_id, text FROM sample"


@register("sample_first_n", O.query(SAMPLE, O.DOCUMENTS, O.FIRST))
def sample_first_n(spark, sf_dir):
    return sampled(spark, sf_dir, N.sample_first_n)


@register("sample_random_n", O.query(SAMPLE, O.DOCUMENTS, O.RANDOM))
def sample_random_n(spark, sf_dir):
    return sampled(spark, sf_dir, N.sample_random_n)


@register(
    "top_n",
    O.query(
        "SELECT rank, score, seg_id, src, tgt FROM ranked WHERE rank <= 100",
        *O.scored(O.DOCUMENTS), O.diffs(O.LOGPROB), O.ranking(),
    ),
)
def top_n(spark, sf_dir):
    return N.top_n(P.select(*documents(spark, sf_dir), rank_tgt=False, top=200), 100)


# --- counts and models ---------------------------------------------------------------


@register("count_segments", O.query("SELECT count(*) AS n FROM spec", O.DOCUMENTS))
def count_segments(spark, sf_dir):
    return V.count_segments(documents(spark, sf_dir).specific)


@register(
    "token_counts",
    f"SELECT tok, count(*) AS cnt FROM (SELECT unnest({O.words('text')}) AS tok FROM documents)"
    " GROUP BY tok",
)
def token_counts(spark, sf_dir):
    return V.token_counts(table(spark, sf_dir, "documents"))


@register("vocab", O.query("SELECT tok, cnt FROM vocab", O.DOCUMENTS, O.COUNTS))
def vocab(spark, sf_dir):
    return specific_words(spark, sf_dir)


@register(
    "vocab_stats",
    O.query(
        "SELECT (SELECT count(*) FROM spec) AS rows, count(*) AS types,"
        " count(*) FILTER (cnt > 1) AS kept FROM token_counts",
        O.DOCUMENTS, O.COUNTS,
    ),
)
def vocab_stats(spark, sf_dir):
    return V.vocab_stats(segments(documents(spark, sf_dir).specific))


@register(
    "vocab_lookup",
    O.query(
        "SELECT t.seg_id, t.pos::INTEGER AS pos, t.tok, v.tok IS NOT NULL AS known"
        f" FROM ({O.split('gen')}) t LEFT JOIN vocab v ON t.tok = v.tok",
        O.DOCUMENTS, O.COUNTS,
    ),
)
def vocab_lookup(spark, sf_dir):
    found = V.vocab_lookup(segments(documents(spark, sf_dir).general), specific_words(spark, sf_dir))
    return found.filter("tok IS NOT NULL")


def specific_sentences(spark: SparkSession, sf_dir: str) -> DataFrame:
    segs = segments(documents(spark, sf_dir).specific)
    return M.training_sentences(segs, specific_words(spark, sf_dir))


def specific_adjusted(spark: SparkSession, sf_dir: str) -> DataFrame:
    counts = M.ngram_counts(specific_sentences(spark, sf_dir))
    return materialize(M.adjusted_counts(counts), "adjusted")


def of_specific(columns: str, source: str) -> str:
    return O.query(f"SELECT {columns} FROM {source} WHERE model = 'specific'", *O.trained(O.DOCUMENTS))


@register("ngram_counts", of_specific("n::INTEGER AS n, gram, cnt", "ngram_counts"))
def ngram_counts(spark, sf_dir):
    return M.ngram_counts(specific_sentences(spark, sf_dir))


@register("adjusted_counts", of_specific("n::INTEGER AS n, gram, a", "adjusted"))
def adjusted_counts(spark, sf_dir):
    return M.adjusted_counts(M.ngram_counts(specific_sentences(spark, sf_dir)))


@register("discounts", of_specific(f"n::INTEGER AS n, {sql_six('d1', 'd2', 'd3')}", "discounts"))
def discounts(spark, sf_dir):
    return M.discounts(specific_adjusted(spark, sf_dir)).select("n", *six("d1", "d2", "d3"))


@register("context_stats", of_specific(f"n::INTEGER AS n, ctx, s, {sql_six('b')}", "contexts"))
def context_stats(spark, sf_dir):
    adjusted = specific_adjusted(spark, sf_dir)
    return M.context_stats(adjusted, M.discounts(adjusted)).select("n", "ctx", "s", *six("b"))


@register("lm_probs", of_specific(f"n::INTEGER AS n, gram, {sql_six('p')}", "probs"))
def lm_probs(spark, sf_dir):
    return M.lm_probs(specific_adjusted(spark, sf_dir)).select("n", "gram", *six("p"))


@register("train_lm", of_specific(f"n::INTEGER AS n, gram, {sql_six('logp', 'bow')}", "models"))
def train_lm(spark, sf_dir):
    segs = segments(documents(spark, sf_dir).specific)
    model = M.train_lm(segs, specific_words(spark, sf_dir))
    return model.select("n", "gram", *six("logp", "bow"))


@register(
    "train_lm_closed",
    O.query(
        f"SELECT n::INTEGER AS n, gram, {sql_six('logp', 'bow')} FROM models WHERE model = 'general'",
        *O.trained(O.DOCUMENTS, training=O.CLOSED),
    ),
)
def train_lm_closed(spark, sf_dir):
    # the model that lacks words of the vocabulary
    models = P.train_models(*documents(spark, sf_dir), ("src",), settings=P.Settings(closed=True))
    return models.filter("model = 'general'").select("n", "gram", *six("logp", "bow"))


# --- scores --------------------------------------------------------------------------


def document_models(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    models = P.train_models(*documents(spark, sf_dir), ("src",)).drop("side")
    return tuple(models.filter(F.col("model") == m).drop("model") for m in ("specific", "general"))


def document_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    segs = segments(documents(spark, sf_dir).general)
    return S.score_lm(segs, *document_models(spark, sf_dir))


def dialogue_diffs(spark: SparkSession, sf_dir: str) -> list[DataFrame]:
    """The differences of both sides of the dialogues."""
    pairs = dialogues(spark, sf_dir)
    diffs = materialize(P.side_diffs(pairs.general, models_of(pairs), ("src", "tgt")), "diffs")
    return [diffs.filter(F.col("side") == s).drop("side") for s in ("src", "tgt")]


def scored_dialogues(spark: SparkSession, sf_dir: str) -> DataFrame:
    diffs = dialogue_diffs(spark, sf_dir)
    return R.build_scored_pairs(dialogues(spark, sf_dir).general, S.score_sum(*diffs))


def scored_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    models = P.train_models(*docs, ("src",))
    scores = materialize(P.score_pairs(docs.general, models, ("src",)), "scores")
    return R.build_scored_pairs(docs.general, scores)


@register(
    "model_lookup",
    O.query(
        "SELECT seg_id, n::INTEGER AS n, gram, count(*) AS cnt FROM candidates"
        " WHERE gram IN (SELECT gram FROM models WHERE gram <> '<unk>') GROUP BY ALL",
        *O.scored(O.DOCUMENTS),
    ),
)
def model_lookup(spark, sf_dir):
    weights = materialize(S.joint_weights(*document_models(spark, sf_dir)), "weights")
    found = S.model_lookup(segments(documents(spark, sf_dir).general), weights)
    return found.groupBy("seg_id", "n", "gram").agg(F.count(F.lit(1)).alias("cnt"))


@register(
    "score_lm",
    O.query(
        f"SELECT seg_id, positions, {sql_six('logp_s', 'logp_g')}, oov_s, oov_g FROM scores",
        *O.scored(O.DOCUMENTS),
    ),
)
def score_lm(spark, sf_dir):
    scores = document_scores(spark, sf_dir)
    return scores.select("seg_id", "positions", *six("logp_s", "logp_g"), "oov_s", "oov_g")


@register("oov_rate", O.query("SELECT seg_id, oov_s, oov_g FROM scores", *O.scored(O.DOCUMENTS)))
def oov_rate(spark, sf_dir):
    return S.oov_rate(document_scores(spark, sf_dir))


@register(
    "perplexity",
    O.query(
        "SELECT seg_id, round(pow(10, -logp_s / positions), 6) + 0.0 AS ppl_s,"
        " round(pow(10, -logp_g / positions), 6) + 0.0 AS ppl_g FROM scores",
        *O.scored(O.DOCUMENTS),
    ),
)
def perplexity(spark, sf_dir):
    scores = document_scores(spark, sf_dir)
    ppl = [
        S.rounded(X.perplexity(F.col(f"logp_{m}"), F.col("positions"))).alias(f"ppl_{m}")
        for m in ("s", "g")
    ]
    return scores.select("seg_id", *ppl)


@register(
    "align_scores",
    O.query(f"SELECT seg_id, {sql_six('logp_s', 'logp_g')} FROM scores", *O.scored(O.DOCUMENTS)),
)
def align_scores(spark, sf_dir):
    scores = materialize(document_scores(spark, sf_dir), "scores")
    halves = [scores.select("seg_id", F.col(f"logp_{m}").alias("logp")) for m in ("s", "g")]
    return S.align_scores(*halves).select("seg_id", *six("logp_s", "logp_g"))


@register(
    "score_diff",
    O.query("SELECT seg_id, diff FROM diffs", *O.scored(O.DOCUMENTS), O.diffs(O.LOGPROB)),
)
def score_diff(spark, sf_dir):
    return S.score_diff(document_scores(spark, sf_dir))


@register(
    "align_sides",
    O.query(
        "SELECT s.seg_id, s.diff AS src_diff, t.diff AS tgt_diff FROM diffs s JOIN diffs t"
        " ON s.seg_id = t.seg_id WHERE s.side = 'src' AND t.side = 'tgt'",
        *O.scored(O.DIALOGUES), O.diffs(O.LOGPROB),
    ),
)
def align_sides(spark, sf_dir):
    return S.align_sides(*dialogue_diffs(spark, sf_dir))


@register(
    "score_sum",
    O.query("SELECT seg_id, score FROM summed", *O.scored(O.DIALOGUES), O.diffs(O.LOGPROB)),
)
def score_sum(spark, sf_dir):
    return S.score_sum(*dialogue_diffs(spark, sf_dir))


@register(
    "check_complete",
    O.query(
        "SELECT count(*) AS segments, count(score) AS scored FROM gen_pairs"
        " LEFT JOIN summed USING (seg_id)",
        *O.scored(O.DOCUMENTS), O.diffs(O.LOGPROB),
    ),
)
def check_complete(spark, sf_dir):
    segs = segments(documents(spark, sf_dir).general)
    scores = materialize(document_scores(spark, sf_dir), "scores")
    S.check_complete(segs, scores)
    tallied = segs.join(scores, "seg_id", "left")
    return tallied.agg(F.count("seg_id").alias("segments"), F.count("logp_s").alias("scored"))


# --- ranking -------------------------------------------------------------------------

SCORED = "SELECT seg_id, score, src, tgt FROM scored"


@register(
    "build_scored_pairs", O.query(SCORED, *O.scored(O.DIALOGUES), O.diffs(O.LOGPROB))
)
def build_scored_pairs(spark, sf_dir):
    return scored_dialogues(spark, sf_dir)


@register("align_text", O.query(SCORED, *O.scored(O.DOCUMENTS), O.diffs(O.LOGPROB)))
def align_text(spark, sf_dir):
    return scored_documents(spark, sf_dir)


@register(
    "sort_ranked",
    O.query(
        "SELECT row_number() OVER (ORDER BY score DESC, src DESC, tgt DESC) AS index, seg_id, score,"
        " src, tgt FROM scored",
        *O.scored(O.DIALOGUES), O.diffs(O.LOGPROB),
    ),
)
def sort_ranked(spark, sf_dir):
    # the place of a row in the sorted frame, so that the order is compared too
    return R.numbered(R.sort_ranked(scored_dialogues(spark, sf_dir)), "sorted")


@register(
    "dedup_ranked",
    O.query(
        "SELECT min(seg_id) AS seg_id, score, src, tgt FROM scored GROUP BY score, src, tgt",
        *O.scored(O.DOCUMENTS), O.diffs(O.LOGPROB),
    ),
)
def dedup_ranked(spark, sf_dir):
    return R.dedup_ranked(scored_documents(spark, sf_dir))


@register("rank", O.selected(O.DOCUMENTS))
def rank(spark, sf_dir):
    return R.rank(scored_documents(spark, sf_dir))


@register("select", O.selected(O.DIALOGUES))
def select(spark, sf_dir):
    return P.select(*dialogues(spark, sf_dir))


@register("select_documents", O.selected(O.DOCUMENTS))
def select_documents(spark, sf_dir):
    return P.select(*documents(spark, sf_dir), rank_tgt=False)


@register("select_perplexity", O.selected(O.DIALOGUES, O.PERPLEXITY, direction="ASC"))
def select_perplexity(spark, sf_dir):
    return P.select(*dialogues(spark, sf_dir), metric="perplexity")


@register("select_closed", O.selected(O.DIALOGUES, O.PERPLEXITY, direction="ASC", training=O.CLOSED))
def select_closed(spark, sf_dir):
    return P.select(*dialogues(spark, sf_dir), metric="perplexity", settings=P.Settings(closed=True))


@register("select_kept_models", O.selected(O.DIALOGUES))
def select_kept_models(spark, sf_dir):
    pairs, path = dialogues(spark, sf_dir), new_path(spark, "kept")
    sinks.save_models(P.fit(*pairs), path)
    return P.select(pairs.general, models=sinks.load_models(spark, path))


@register("select_random_sample", O.selected(O.DIALOGUES, sample=O.RANDOM))
def select_random_sample(spark, sf_dir):
    return P.select(*dialogues(spark, sf_dir), sample="random")


def sql_rank_mode(side: str) -> str:
    diff = O.diffs(O.LOGPROB).replace("FROM scores)", f"FROM scores WHERE side = '{side}')")
    return O.query(O.RANKED, *O.scored(O.DIALOGUES), diff, O.ranking())


@register("rank_mode_src", sql_rank_mode("src"))
def rank_mode_src(spark, sf_dir):
    return P.select(*dialogues(spark, sf_dir), rank_src=True, rank_tgt=False)


@register("rank_mode_tgt", sql_rank_mode("tgt"))
def rank_mode_tgt(spark, sf_dir):
    return P.select(*dialogues(spark, sf_dir), rank_src=False, rank_tgt=True)
