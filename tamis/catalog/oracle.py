"""The same results in plain SQL, for comparison.

Training follows the definitions (distinct predecessors are counted, not handed on) and
scoring searches the longest gram at each position, so neither shares its method with the
engine.
"""

from __future__ import annotations

from ..functions.text import WHITESPACE


def words(text: str) -> str:
    return f"list_filter(regexp_split_to_array({text}, '{WHITESPACE}'), lambda x: x <> '')"


# Corpora, as in ``corpora``: spec and gen hold one row per side and segment.
DOCUMENTS = """
spec AS MATERIALIZED (
  SELECT 'src' AS side, doc_id AS seg_id, text FROM documents
  WHERE lang = 'fr' AND doc_id IN (SELECT doc_id FROM labels WHERE quality = 1)),
gen AS MATERIALIZED (
  SELECT 'src' AS side, doc_id AS seg_id, text FROM documents
  WHERE doc_id NOT IN (SELECT seg_id FROM spec)),
gen_pairs AS MATERIALIZED (SELECT seg_id, text AS src, '' AS tgt FROM gen)"""

DIALOGUES = """
pairs AS MATERIALIZED (
  SELECT a.conv_id, a.conv_id * 1000000 + a.turn AS seg_id, a.text AS src, b.text AS tgt
  FROM conversations a JOIN conversations b ON a.conv_id = b.conv_id AND b.turn = a.turn + 1
  WHERE a.role = 'user' AND b.role = 'assistant'),
guided AS MATERIALIZED (SELECT DISTINCT conv_id FROM conversations WHERE role = 'system'),
spec_pairs AS MATERIALIZED (
  SELECT seg_id, src, tgt FROM pairs WHERE conv_id IN (SELECT conv_id FROM guided)),
gen_pairs AS MATERIALIZED (
  SELECT seg_id, src, tgt FROM pairs WHERE conv_id NOT IN (SELECT conv_id FROM guided)),
spec AS MATERIALIZED (
  SELECT 'src' AS side, seg_id, src AS text FROM spec_pairs
  UNION ALL SELECT 'tgt', seg_id, tgt FROM spec_pairs),
gen AS MATERIALIZED (
  SELECT 'src' AS side, seg_id, src AS text FROM gen_pairs
  UNION ALL SELECT 'tgt', seg_id, tgt FROM gen_pairs)"""


def split(source: str) -> str:
    """Tokens of a frame ``side, seg_id, text`` with their positions from 0."""
    return f"""SELECT side, seg_id, unnest(w) AS tok, generate_subscripts(w, 1) - 1 AS pos
  FROM (SELECT side, seg_id, {words('text')} AS w FROM {source})"""


COUNTS = f"""
spec_tokens AS MATERIALIZED ({split('spec')}),
token_counts AS MATERIALIZED (
  SELECT side, tok, count(*) AS cnt FROM spec_tokens GROUP BY ALL),
vocab AS MATERIALIZED (SELECT side, tok, cnt FROM token_counts WHERE cnt > 1)"""

FIRST = """
sample AS MATERIALIZED (
  SELECT side, seg_id, text FROM gen
  QUALIFY row_number() OVER (PARTITION BY side ORDER BY seg_id)
          <= (SELECT count(DISTINCT seg_id) FROM spec))"""

RANDOM = """
sample AS MATERIALIZED (
  SELECT side, seg_id, text FROM gen
  QUALIFY row_number() OVER (PARTITION BY side ORDER BY md5('0:' || seg_id))
          <= (SELECT count(DISTINCT seg_id) FROM spec))"""

TRAINING = f"""
train AS MATERIALIZED (
  SELECT 'specific' AS model, side, seg_id, text FROM spec
  UNION ALL SELECT 'general', side, seg_id, text FROM sample),
train_words AS MATERIALIZED (
  SELECT model, side, seg_id, {words('text')} AS w FROM train),
train_tokens AS MATERIALIZED (
  SELECT model, side, seg_id, unnest(w) AS tok, generate_subscripts(w, 1) AS pos
  FROM train_words),
kept AS MATERIALIZED (
  SELECT t.model, t.side, t.seg_id, list(t.tok ORDER BY t.pos) AS w
  FROM train_tokens t JOIN vocab v ON t.side = v.side AND t.tok = v.tok
  WHERE t.tok NOT IN ('<s>', '</s>', '<unk>') GROUP BY ALL),
sentences AS MATERIALIZED (
  SELECT t.model, t.side, t.seg_id, coalesce(k.w, []) AS w,
         ['<s>'] || coalesce(k.w, []) || ['</s>'] AS s
  FROM train_words t LEFT JOIN kept k
    ON t.model = k.model AND t.side = k.side AND t.seg_id = k.seg_id),
starts AS (SELECT model, side, s, unnest(range(1, len(s) + 1)) AS i FROM sentences),
spans AS (SELECT model, side, s, i, unnest(range(1, 6)) AS n FROM starts),
ngram_counts AS MATERIALIZED (
  SELECT model, side, n, array_to_string(s[i:i + n - 1], ' ') AS gram, count(*) AS cnt
  FROM spans WHERE i + n - 1 <= len(s) GROUP BY ALL),
adjusted AS MATERIALIZED (
  SELECT model, side, n, gram, cnt AS a FROM ngram_counts
  WHERE n = 5 OR gram LIKE '<s> %'
  UNION ALL
  SELECT model, side, n - 1, gram[instr(gram, ' ') + 1:], count(DISTINCT split_part(gram, ' ', 1))
  FROM ngram_counts WHERE n > 1 GROUP BY 1, 2, 3, 4),
tallies AS (
  SELECT model, side, n, count(*) FILTER (a = 1) AS t1, count(*) FILTER (a = 2) AS t2,
         count(*) FILTER (a = 3) AS t3, count(*) FILTER (a = 4) AS t4
  FROM adjusted GROUP BY ALL),
estimates AS (
  SELECT *, 1 - 2 * y * t2 / t1 AS e1, 2 - 3 * y * t3 / t2 AS e2, 3 - 4 * y * t4 / t3 AS e3
  FROM (SELECT *, t1::DOUBLE / (t1 + 2 * t2) AS y FROM tallies)),
discounts AS MATERIALIZED (
  SELECT model, side, n, CASE WHEN ok THEN e1 ELSE 0.5 END AS d1,
         CASE WHEN ok THEN e2 ELSE 1.0 END AS d2, CASE WHEN ok THEN e3 ELSE 1.5 END AS d3
  FROM (SELECT *, coalesce(t1 > 0 AND t2 > 0 AND t3 > 0 AND e1 > 0 AND e1 <= 1
                  AND e2 > 0 AND e2 <= 2 AND e3 > 0 AND e3 <= 3, FALSE) AS ok FROM estimates)),
discounted AS MATERIALIZED (
  SELECT a.model, a.side, a.n, gram, a,
         CASE WHEN a.n = 1 THEN '' ELSE regexp_replace(gram, ' [^ ]*$', '') END AS ctx,
         CASE WHEN a.n = 1 THEN '' ELSE gram[instr(gram, ' ') + 1:] END AS suffix,
         CASE a WHEN 1 THEN d1 WHEN 2 THEN d2 ELSE d3 END AS d
  FROM adjusted a JOIN discounts USING (model, side, n)),
contexts AS MATERIALIZED (
  SELECT model, side, n, ctx, sum(a)::BIGINT AS s, sum(d) / sum(a) AS b
  FROM discounted GROUP BY ALL),
p1 AS MATERIALIZED (
  SELECT model, side, 1 AS n, gram, (a - d) / s + b / v AS p
  FROM discounted JOIN contexts USING (model, side, n, ctx)
  JOIN (SELECT model, side, count(*) + 1 AS v FROM adjusted WHERE n = 1 GROUP BY ALL)
    USING (model, side) WHERE n = 1
  UNION ALL
  SELECT model, side, 1, '<unk>', b / v FROM contexts
  JOIN (SELECT model, side, count(*) + 1 AS v FROM adjusted WHERE n = 1 GROUP BY ALL)
    USING (model, side) WHERE n = 1)""" + "".join(
    f""",
p{n} AS MATERIALIZED (
  SELECT x.model, x.side, {n} AS n, x.gram, (a - d) / s + b * q.p AS p
  FROM discounted x JOIN contexts c
    ON x.model = c.model AND x.side = c.side AND x.n = c.n AND x.ctx = c.ctx
  JOIN p{n - 1} q ON x.model = q.model AND x.side = q.side AND x.suffix = q.gram
  WHERE x.n = {n})"""
    for n in range(2, 6)
) + """,
probs AS MATERIALIZED (
  SELECT * FROM p1 UNION ALL SELECT * FROM p2 UNION ALL SELECT * FROM p3
  UNION ALL SELECT * FROM p4 UNION ALL SELECT * FROM p5),
models AS MATERIALIZED (
  SELECT p.model, p.side, p.n, p.gram, log10(p.p) AS logp, coalesce(log10(c.b), 0) AS bow
  FROM probs p LEFT JOIN contexts c
    ON p.model = c.model AND p.side = c.side AND c.n = p.n + 1 AND c.ctx = p.gram
  UNION ALL
  SELECT model, side, 1, '<s>', NULL, log10(b) FROM contexts WHERE n = 2 AND ctx = '<s>')"""

# The vocabulary is told to the estimator: the lowest probability is spread over all of its words.
_SEEN = "(SELECT model, side, count(*) + 1 AS v FROM adjusted WHERE n = 1 GROUP BY ALL)\n    USING (model, side)"
_GIVEN = """(SELECT side, count(*) + 2 AS v FROM vocab WHERE tok NOT IN ('<s>', '</s>', '<unk>') GROUP BY side)
    USING (side)"""
_UNSEEN = f"""
  UNION ALL
  SELECT model, side, 1, tok, b / v FROM contexts JOIN vocab USING (side) JOIN {_GIVEN}
  WHERE n = 1 AND tok NOT IN ('<s>', '</s>', '<unk>') AND (model, side, tok) NOT IN (
    SELECT (model, side, gram) FROM adjusted WHERE n = 1)"""
_LAST = f"{_GIVEN} WHERE n = 1"
CLOSED = TRAINING.replace(_SEEN, _GIVEN).replace(f"{_LAST}),\np2 ", f"{_LAST}{_UNSEEN}),\np2 ")

SCORING = f"""
gen_words AS (
  SELECT side, seg_id,
         list_transform({words('text')},
           lambda x: CASE WHEN x IN ('<s>', '</s>', '<unk>') THEN '<unk>' ELSE x END) AS w
  FROM gen),
gen_sentences AS MATERIALIZED (
  SELECT side, seg_id,
         ['<s>'] || CASE WHEN len(w) = 0 THEN ['<unk>'] ELSE w END || ['</s>'] AS s
  FROM gen_words),
ends AS MATERIALIZED (
  SELECT side, seg_id, unnest(s) AS t0, generate_subscripts(s, 1) AS e FROM gen_sentences),
tails AS (
  SELECT side, seg_id, e, t0, lag(t0, 1) OVER w AS t1, lag(t0, 2) OVER w AS t2,
         lag(t0, 3) OVER w AS t3, lag(t0, 4) OVER w AS t4
  FROM ends WINDOW w AS (PARTITION BY side, seg_id ORDER BY e)),
candidates AS (
  SELECT side, seg_id, e, 1 AS n, t0 AS gram FROM tails
  UNION ALL SELECT side, seg_id, e, 2, t1 || ' ' || t0 FROM tails
  UNION ALL SELECT side, seg_id, e, 3, t2 || ' ' || t1 || ' ' || t0 FROM tails
  UNION ALL SELECT side, seg_id, e, 4, t3 || ' ' || t2 || ' ' || t1 || ' ' || t0 FROM tails
  UNION ALL SELECT side, seg_id, e, 5, t4 || ' ' || t3 || ' ' || t2 || ' ' || t1 || ' ' || t0
  FROM tails),
hits AS MATERIALIZED (
  SELECT c.side, c.seg_id, c.e, c.n, c.gram, m.model, m.logp, m.bow
  FROM candidates c JOIN models m ON c.side = m.side AND c.n = m.n AND c.gram = m.gram
  WHERE m.gram <> '<unk>'),
longest AS MATERIALIZED (
  SELECT side, seg_id, e, model, max(n) AS n, arg_max(logp, n) AS logp
  FROM hits WHERE e > 1 GROUP BY ALL),
names AS (SELECT DISTINCT model, side FROM models),
positions AS MATERIALIZED (
  SELECT side, seg_id, e, model FROM ends JOIN names USING (side) WHERE e > 1),
unknown AS (SELECT model, side, logp AS unk FROM models WHERE gram = '<unk>'),
placed AS MATERIALIZED (
  SELECT p.side, p.seg_id, p.e, p.model, coalesce(l.n, 1) AS n,
         coalesce(l.logp, u.unk) AS logp, l.n IS NULL AS oov
  FROM positions p JOIN unknown u ON p.model = u.model AND p.side = u.side
  LEFT JOIN longest l
    ON p.side = l.side AND p.seg_id = l.seg_id AND p.e = l.e AND p.model = l.model),
backed AS (
  SELECT p.side, p.seg_id, p.e, p.model, any_value(p.logp) + coalesce(sum(h.bow), 0) AS logp,
         any_value(p.oov) AS oov
  FROM placed p LEFT JOIN hits h
    ON p.side = h.side AND p.seg_id = h.seg_id AND h.e = p.e - 1 AND p.model = h.model
    AND h.n BETWEEN p.n AND 4
  GROUP BY p.side, p.seg_id, p.e, p.model),
totals AS MATERIALIZED (
  SELECT side, seg_id, model, count(*) AS positions, sum(logp) AS logp,
         count(*) FILTER (oov) AS oov
  FROM backed GROUP BY ALL),
scores AS MATERIALIZED (
  SELECT side, seg_id, s.positions, s.logp AS logp_s, g.logp AS logp_g,
         s.oov AS oov_s, g.oov AS oov_g
  FROM (SELECT * FROM totals WHERE model = 'specific') s
  JOIN (SELECT * FROM totals WHERE model = 'general') g USING (side, seg_id))"""

LOGPROB = "round(logp_s - logp_g, 6) + 0.0"
PERPLEXITY = "round(pow(10, -logp_s / positions) - pow(10, -logp_g / positions), 6) + 0.0"


def diffs(metric: str) -> str:
    return f"""
diffs AS MATERIALIZED (SELECT side, seg_id, {metric} AS diff FROM scores),
summed AS MATERIALIZED (
  SELECT seg_id, round(sum(diff), 6) + 0.0 AS score FROM diffs GROUP BY seg_id),
scored AS MATERIALIZED (SELECT seg_id, score, src, tgt FROM gen_pairs JOIN summed USING (seg_id))"""


def ranking(direction: str = "DESC") -> str:
    return f"""
ranked AS (
  SELECT row_number() OVER (ORDER BY score {direction}, src {direction}, tgt {direction}) AS rank,
         score, seg_id, src, tgt
  FROM (SELECT score, src, tgt, min(seg_id) AS seg_id FROM scored GROUP BY ALL))"""


def query(final: str, *parts: str) -> str:
    return "WITH " + ",".join(parts) + "\n" + final if parts else final


def trained(corpora: str, sample: str = FIRST, training: str = TRAINING) -> tuple[str, ...]:
    return corpora, COUNTS, sample, training


def scored(corpora: str, sample: str = FIRST, training: str = TRAINING) -> tuple[str, ...]:
    return *trained(corpora, sample, training), SCORING


RANKED = "SELECT rank, score, seg_id, src, tgt FROM ranked"


def selected(
    corpora: str,
    metric: str = LOGPROB,
    sample: str = FIRST,
    direction: str = "DESC",
    training: str = TRAINING,
) -> str:
    return query(RANKED, *scored(corpora, sample, training), diffs(metric), ranking(direction))
