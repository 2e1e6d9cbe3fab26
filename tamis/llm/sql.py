"""DuckDB SQL for the queries that SQL can express, on the tables as views."""

from __future__ import annotations

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

# Words after lower-casing A-Z: runs of digits, letters and anything beyond ASCII.
ALNUM = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"

# The table of the reflected polynomial 0xEDB88320, and a fold over the bytes of a string.
CRC_TABLE = """
crc_steps AS (
  SELECT b, b AS c, 0 AS k FROM (SELECT unnest(range(256)) AS b)
  UNION ALL
  SELECT b, CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END, k + 1
  FROM crc_steps WHERE k < 8
),
crc_table AS (SELECT list(c::BIGINT ORDER BY b) AS t FROM crc_steps WHERE k = 8)
"""


def crc32(text: str, t: str = "(SELECT t FROM crc_table)") -> str:
    """An expression for the unsigned CRC-32 of the UTF-8 bytes of a string."""
    octets = f"list_transform(regexp_extract_all(hex({text}), '..'), lambda h: ('0x' || h)::BIGINT)"
    step = "lambda a, b: xor(a >> 8, t[(xor(a, b) & 255) + 1])"
    return f"xor(list_reduce(list_prepend(4294967295::BIGINT, {octets}), {step}), 4294967295)"


OP1 = f"""
WITH RECURSIVE {CRC_TABLE},
sizes AS (
  SELECT doc_id, (strlen(coalesce(text, '')) + 16)::BIGINT AS size,
         {crc32("coalesce(text, '')")}::BIGINT AS text_crc32
  FROM documents, crc_table
),
summed AS (
  SELECT *, sum(size) OVER (ORDER BY doc_id, text_crc32) - size AS before, sum(size) OVER () AS total
  FROM sizes
),
cut AS (
  SELECT *, least(((2 * before + size) * 40) // (2 * total), 39)::INTEGER AS shard FROM summed
)
SELECT doc_id, size, text_crc32, 'bytes' AS law, shard,
       row_number() OVER (PARTITION BY shard ORDER BY doc_id, text_crc32) - 1 AS slot,
       NULL::INTEGER AS grown_shard
FROM cut
"""

OP2 = f"""
WITH item_words AS (
  SELECT CAST(item_id AS VARCHAR) AS item,
         regexp_extract_all(translate(text, '{UPPER}', '{LOWER}'), '{ALNUM}') AS w
  FROM benchmark WHERE text IS NOT NULL
),
sized AS (SELECT *, least(10, len(w)) AS n FROM item_words WHERE len(w) > 0),
windows AS (
  SELECT DISTINCT item, n, array_to_string(w[i:i + n - 1], ' ') AS win
  FROM (SELECT *, unnest(range(1, len(w) - n + 2)) AS i FROM sized)
),
words AS (
  SELECT row_number() OVER () AS r, doc_id,
         regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '{ALNUM}') AS w
  FROM documents
),
places AS (
  SELECT r, i, n, array_to_string(w[i:i + n - 1], ' ') AS win
  FROM (SELECT r, w, n, unnest(range(1, len(w) - n + 2)) AS i
        FROM words, (SELECT DISTINCT n FROM sized) WHERE len(w) >= n)
),
found AS (SELECT r, i, n, item FROM places JOIN windows USING (n, win)),
hit AS (
  SELECT r, count(DISTINCT k) AS n_hit
  FROM (SELECT r, unnest(range(i, i + n)) AS k FROM found) GROUP BY r
),
items AS (
  SELECT r, count(DISTINCT item) AS n_items,
         array_to_string(list_sort(list(DISTINCT item)), ',') AS ids
  FROM found GROUP BY r
)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit,
       coalesce(n_items, 0)::BIGINT AS n_items, sha256(coalesce(ids, '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AS contaminated
FROM words LEFT JOIN hit USING (r) LEFT JOIN items USING (r)
"""

def op9() -> str:
    from tamis.llm.secrets import BASE_RULES, MORE_RULES

    rules = []
    for rank, rule in enumerate(BASE_RULES + MORE_RULES):
        pattern = rule.pattern.replace("'", "''")
        rules.append(f"""
  SELECT r, {rank} AS rank, '{rule.kind}' AS kind, {rule.least} AS least,
         regexp_extract_all(t, '{pattern}', 0) AS m, regexp_extract_all(t, '{pattern}', {rule.group}) AS v,
         string_split_regex(t, '{pattern}') AS p
  FROM docs""")
    every = " UNION ALL ".join(rules)
    base = ", ".join(f"'{rule.kind}'" for rule in BASE_RULES)
    counts = ", ".join(
        f"coalesce(count(*) FILTER (kind = '{rule.kind}'), 0)::BIGINT AS n_{rule.kind}"
        for rule in BASE_RULES
    )
    return f"""
WITH docs AS (SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS t FROM documents),
matched AS ({every}
),
listed AS (
  SELECT r, rank, kind, least, i, length(m[i]) AS size, length(v[i]) AS tested, length(p[i]) AS gap
  FROM (SELECT *, unnest(range(1, len(m) + 1)) AS i FROM matched WHERE len(m) > 0)
),
placed AS (
  SELECT *, sum(gap + size) OVER (PARTITION BY r, rank ORDER BY i) AS stop FROM listed
),
spans AS (
  SELECT r, rank, kind, stop - size AS start, kind || ':' || (stop - size) || ':' || stop AS place
  FROM placed WHERE tested >= least
),
summed AS (
  SELECT r, {counts},
         string_agg(place, ',' ORDER BY start, rank) FILTER (kind IN ({base})) AS base,
         string_agg(place, ',' ORDER BY start, rank) AS spans
  FROM spans GROUP BY r
)
SELECT doc_id, coalesce(n_assign, 0) AS n_assign, coalesce(n_access, 0) AS n_access,
       coalesce(n_hex, 0) AS n_hex, sha256(coalesce(base, '')) AS base_sha256,
       coalesce(spans, '') AS spans
FROM docs LEFT JOIN summed USING (r)
"""


def op7() -> str:
    from tamis.llm import urls as U

    ordered = sorted(U.RULES, key=lambda r: (-len(r.name), r.name))

    def rule(of: str) -> str:
        cases = " ".join(
            f"WHEN (host = '{r.host}' OR ends_with(host, '.{r.host}')) AND starts_with(path, '{r.path}')"
            f" THEN '{getattr(r, of)}'"
            for r in ordered
        )
        return f"CASE {cases} END"

    m, letters = U.SMOOTHING, 1 / U.ALPHABET
    fold = f"""(SELECT {crc32("CAST(page_id AS VARCHAR)", "t")} % 5 FROM crc_table)"""
    levels = ""
    for n in range(1, U.GRAM + 1):
        shorter = (
            f"(SELECT {letters} AS sa, {letters} AS sr)"
            if n == 1
            else f"(SELECT gram AS suffix, pa AS sa, pr AS sr FROM level{n - 1}) ON substring(gram, 2) = suffix"
        )
        levels += f""",
level{n} AS MATERIALIZED (
  SELECT gram, ca, cr, sa, sr, (a + {m} * sa) / (ca + {m}) AS pa, (r + {m} * sr) / (cr + {m}) AS pr
  FROM counted JOIN contexts ON left(gram, length(gram) - 1) = context
  {"CROSS JOIN" if n == 1 else "JOIN"} {shorter}
  WHERE length(gram) = {n}
)"""
    every = " UNION ALL ".join(
        f"""SELECT gram, ln(pa / ({m} / (ca + {m}) * sa)) - ln(pr / ({m} / (cr + {m}) * sr)) AS w
  FROM level{n}"""
        for n in range(1, U.GRAM + 1)
    )
    return f"""
WITH RECURSIVE {CRC_TABLE},
split AS (
  SELECT row_number() OVER () AS uid, page_id,
         CASE WHEN contains(url, '://') THEN substring(url, instr(url, '://') + 3) ELSE '' END AS rest
  FROM (SELECT page_id, coalesce(url, '') AS url FROM pages)
),
parts AS (
  SELECT uid, page_id,
         translate(regexp_extract(rest, '^([^/?#]*)', 1), '{UPPER}', '{LOWER}') AS host,
         regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path
  FROM split
),
rows AS MATERIALIZED (
  SELECT *, {rule("name")} AS rule, {rule("verdict")} AS decided, {fold} AS fold,
         chr(2) || host || path || chr(3) AS marked
  FROM parts
),
ends AS (SELECT *, unnest(range(1, length(marked) + 1)) AS e FROM rows),
grams AS MATERIALIZED (
  SELECT uid, decided, fold, substring(marked, e - n + 1, n) AS gram
  FROM ends, (SELECT unnest(range(1, {U.GRAM} + 1)) AS n) WHERE e >= n
),
counted AS MATERIALIZED (
  SELECT gram, count(*) FILTER (decided = 'allow') AS a, count(*) FILTER (decided = 'block') AS r
  FROM grams WHERE decided IS NOT NULL AND fold <> {U.CALIBRATION} GROUP BY gram
),
contexts AS MATERIALIZED (
  SELECT left(gram, length(gram) - 1) AS context, sum(a) AS ca, sum(r) AS cr FROM counted GROUP BY 1
){levels},
weights AS MATERIALIZED (
  SELECT gram, sum(round(w * {U.MILLION})::BIGINT) AS weight FROM (
    {every}
    UNION ALL
    SELECT context, ln({m} / (ca + {m})) - ln({m} / (cr + {m})) FROM contexts
  ) GROUP BY gram
),
scored AS MATERIALIZED (
  SELECT uid, page_id, host, path, rule, decided, fold,
         greatest(least(floor((coalesce(s, 0) + n * coalesce(base, 0)) / n / {U.BIN}), {U.WIDEST}), -{U.WIDEST})::INTEGER
           AS bin
  FROM (SELECT *, length(marked) AS n FROM rows)
  LEFT JOIN (SELECT uid, sum(weight) AS s FROM grams JOIN weights USING (gram) GROUP BY uid) USING (uid)
  CROSS JOIN (SELECT max(weight) AS base FROM weights WHERE gram = '')
),
bins AS (
  SELECT bin, count(*) FILTER (decided = 'allow') AS good, count(*) FILTER (decided = 'block') AS bad
  FROM scored WHERE decided IS NOT NULL AND fold = {U.CALIBRATION} GROUP BY bin
),
errors AS (
  SELECT bin, (sum(good) OVER (ORDER BY bin) - good) * sum(bad) OVER ()
            + (sum(bad) OVER () - sum(bad) OVER (ORDER BY bin) + bad) * sum(good) OVER () AS error,
         sum(good) OVER () AS goods, sum(bad) OVER () AS bads
  FROM bins
),
cut AS (SELECT first(bin ORDER BY error, bin) AS cut FROM errors WHERE goods > 0 AND bads > 0)
SELECT page_id, host, path, rule,
       coalesce(decided, CASE WHEN cut IS NULL OR bin >= cut THEN 'allow' ELSE 'block' END) AS verdict
FROM scored CROSS JOIN cut
"""


def op3() -> str:
    from tamis.llm.fingerprints import ANCHORS, LEAST, SEPARATORS

    anchors = ", ".join(f"'{a}'" for a in ANCHORS)
    band = f"floor(ln(greatest(k, 1)) / ln(1 / {LEAST}))"
    other = band.replace("greatest(k", "greatest(j")
    return f"""
WITH RECURSIVE {CRC_TABLE},
docs AS (
  SELECT doc_id, coalesce(text, '') AS text,
         coalesce(lead(doc_id) OVER (ORDER BY doc_id), first(doc_id) OVER (ORDER BY doc_id)) AS next_id
  FROM documents
),
edited AS (
  SELECT d.doc_id, d.next_id, d.text,
         substring(d.text, 1, length(d.text) - length(d.text) // 4)
           || substring(coalesce(n.text, ''), 1, length(d.text) // 4) AS edited
  FROM docs d JOIN docs n ON n.doc_id = d.next_id
),
variants AS (
  SELECT doc_id, kind,
         regexp_replace(' ' || translate(t, '{UPPER}', '{LOWER}') || ' ', '{SEPARATORS}', ' ', 'g') AS norm
  FROM (SELECT doc_id, 'own' AS kind, text AS t FROM edited
        UNION ALL SELECT doc_id, 'edited', edited FROM edited)
),
words AS (
  SELECT doc_id, kind, unnest(string_split(trim(norm, ' '), ' ')) AS w,
         generate_subscripts(string_split(trim(norm, ' '), ' '), 1) AS i
  FROM variants WHERE norm <> ' '
),
marked AS (
  SELECT *, w IN ({anchors}) AS anchor,
         lag(w) OVER (PARTITION BY doc_id, kind ORDER BY i) AS before
  FROM words
),
content AS (
  SELECT *, lead(w) OVER (PARTITION BY doc_id, kind ORDER BY i) AS next FROM marked WHERE NOT anchor
),
pairs AS (
  SELECT doc_id, kind, coalesce(before IN ({anchors}), false) AS anchored, before, w, next
  FROM content WHERE next IS NOT NULL
),
chosen AS (
  SELECT doc_id, kind, before || ' ' || w || ' ' || next || ' ' AS s FROM pairs WHERE anchored
  UNION ALL
  SELECT doc_id, kind, w || ' ' || next || ' ' FROM pairs
  WHERE (doc_id, kind) NOT IN (SELECT (doc_id, kind) FROM pairs WHERE anchored)
  UNION ALL
  SELECT doc_id, kind, norm FROM variants
  WHERE norm <> ' ' AND (doc_id, kind) NOT IN (SELECT (doc_id, kind) FROM pairs)
),
distinct_s AS (SELECT DISTINCT s FROM chosen),
coded AS (SELECT s, {crc32("s", "t")} AS code FROM distinct_s, crc_table),
codes AS MATERIALIZED (SELECT DISTINCT doc_id, kind, code FROM chosen JOIN coded USING (s)),
prints AS (
  SELECT doc_id, kind, count(code) AS k,
         coalesce(string_agg(printf('%08x', code), '' ORDER BY code), '') AS print
  FROM variants LEFT JOIN codes USING (doc_id, kind) GROUP BY doc_id, kind
),
compared AS (
  SELECT doc_id, doc_id AS other, 'edited' AS kind FROM edited
  UNION ALL SELECT doc_id, next_id, 'own' FROM edited
),
common AS (
  SELECT c.doc_id, c.other, c.kind, count(*) AS shared
  FROM compared c JOIN codes a ON a.doc_id = c.doc_id AND a.kind = 'own'
  JOIN codes b ON b.doc_id = c.other AND b.kind = c.kind AND b.code = a.code
  GROUP BY ALL
),
near AS (
  SELECT c.doc_id, c.kind,
         CASE WHEN greatest(a.k, b.k) = 0 THEN 1.0::DOUBLE
              WHEN abs({band.replace("k, 1", "a.k, 1")} - {other.replace("j, 1", "b.k, 1")}) > 1
                OR least(a.k, b.k) < greatest(a.k, b.k) * {LEAST}::DOUBLE THEN 0.0::DOUBLE
              ELSE coalesce(shared, 0)::DOUBLE / (a.k + b.k - coalesce(shared, 0))::DOUBLE END AS likeness
  FROM compared c
  JOIN prints a ON a.doc_id = c.doc_id AND a.kind = 'own'
  JOIN prints b ON b.doc_id = c.other AND b.kind = c.kind
  LEFT JOIN common m ON m.doc_id = c.doc_id AND m.other = c.other AND m.kind = c.kind
)
SELECT e.doc_id, length(e.text)::BIGINT AS n_chars, sha256(e.edited) AS edited_sha256,
       o.print AS fingerprint, x.print AS edited_fingerprint,
       ne.likeness AS near_edited, nn.likeness AS near_next
FROM edited e
JOIN prints o ON o.doc_id = e.doc_id AND o.kind = 'own'
JOIN prints x ON x.doc_id = e.doc_id AND x.kind = 'edited'
JOIN near ne ON ne.doc_id = e.doc_id AND ne.kind = 'edited'
JOIN near nn ON nn.doc_id = e.doc_id AND nn.kind = 'own'
"""


def op10() -> str:
    """Slot by slot: the released block with the earliest deadline, and weights anew when a group
    has run out. Groups are numbered from 1, the sources with a weight first."""
    from tamis.llm.mixing import BLOCK_ROWS, OTHERS_WEIGHT, OWN_SOURCES, WEIGHTS

    names = ", ".join(f"'{name}'" for name in WEIGHTS)
    each = "range(1, len(w) + 1)"
    return f"""
WITH RECURSIVE others AS (
  SELECT source, CASE WHEN m > {OWN_SOURCES} THEN 1 ELSE k END AS k, CASE WHEN m > {OWN_SOURCES} THEN 1 ELSE m END AS m
  FROM (SELECT source, row_number() OVER (ORDER BY source NULLS LAST) AS k, count(*) OVER () AS m
        FROM (SELECT DISTINCT source FROM documents WHERE source IS NULL OR source NOT IN ({names})))
),
own AS (SELECT unnest([{names}]) AS source, unnest(range(1, {len(WEIGHTS) + 1})) AS g, unnest({list(WEIGHTS.values())}) AS w),
parts AS (
  SELECT source, g, w * (SELECT coalesce(max(m), 1) FROM others) AS w, source AS name FROM own
  UNION ALL
  SELECT source, {len(WEIGHTS)} + k, {OTHERS_WEIGHT},
         CASE WHEN (SELECT count(*) FROM others) <= {OWN_SOURCES} THEN source END FROM others
),
blocked AS (
  SELECT doc_id, d.source, g, name, row_number() OVER (PARTITION BY g ORDER BY doc_id, d.source) - 1 AS i
  FROM documents d JOIN parts p ON d.source IS NOT DISTINCT FROM p.source
),
sizes AS (SELECT g, count(*) AS c FROM blocked GROUP BY g),
counts AS (
  SELECT list(coalesce((c + {BLOCK_ROWS} - 1) // {BLOCK_ROWS}, 0)::BIGINT ORDER BY p.g) AS n,
         list(p.w::BIGINT ORDER BY p.g) AS w
  FROM (SELECT DISTINCT g, w FROM parts) p LEFT JOIN sizes s ON s.g = p.g
),
run AS (
  SELECT 0::BIGINT AS next, 0::BIGINT AS start, list_transform({each}, lambda k: 0::BIGINT) AS had, n AS rest, n, w,
         NULL::BIGINT AS slot, NULL::BIGINT AS g, NULL::BIGINT AS block, NULL::BIGINT AS release, NULL::BIGINT AS deadline
  FROM counts
  UNION ALL
  SELECT next + 1, CASE WHEN rest[p] = 1 THEN next + 1 ELSE start END,
         CASE WHEN rest[p] = 1 THEN list_transform({each}, lambda k: 0::BIGINT)
              ELSE list_transform({each}, lambda k: had[k] + (k = p)::BIGINT) END,
         list_transform({each}, lambda k: rest[k] - (k = p)::BIGINT), n, w,
         next, p, n[p] - rest[p], start + had[p] * total // w[p], start + best // 100
  FROM (
    SELECT *, best % 100 AS p FROM (
      SELECT *, list_min(list_transform({each}, lambda k: CASE
        WHEN rest[k] > 0 AND had[k] * total // w[k] <= next - start
        THEN ((had[k] + 1) * total + w[k] - 1) // w[k] * 100 + k END)) AS best
      FROM (
        SELECT run.*, list_sum(list_transform({each}, lambda k: CASE WHEN rest[k] > 0 THEN w[k] ELSE 0 END))::BIGINT
                 AS total
        FROM run
      ) WHERE total > 0
    )
  )
)
SELECT doc_id, source, b.name AS mix_group, block, release, deadline, slot,
       row_number() OVER (ORDER BY slot, i) - 1 AS position
FROM blocked b JOIN run ON run.g = b.g AND run.block = i // {BLOCK_ROWS}
"""


OP11 = """
WITH r AS MATERIALIZED (
  SELECT row_number() OVER () AS u, vec_id,
         CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
         list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS v
  FROM embeddings WHERE label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(CAST(x AS DOUBLE)))) = 0),
s AS MATERIALIZED (
  SELECT a.u AS a, a.vec_id AS anchor_id, r.u, r.vec_id, a.label = r.label AS same,
         list_sum(list_transform(list_zip(a.v, r.v), lambda z: z[1] * z[2]))::BIGINT AS score
  FROM r a JOIN r ON a.u <> r.u WHERE a.vec_id % 100 = 0),
p AS (SELECT * FROM s WHERE same
      QUALIFY row_number() OVER (PARTITION BY a ORDER BY score DESC, vec_id, u) <= 5),
n AS (SELECT p.anchor_id, p.vec_id AS positive_id, s.vec_id AS negative_id, p.score AS positive_score,
             s.score AS negative_score,
             row_number() OVER (PARTITION BY p.a, p.u ORDER BY s.score DESC, s.vec_id, s.u) AS rank
      FROM p JOIN s ON p.a = s.a AND NOT s.same
       AND 80 * p.score <= 100 * s.score AND 100 * s.score <= 100 * p.score)
SELECT anchor_id, positive_id, rank::INTEGER AS rank, negative_id, positive_score, negative_score
FROM n WHERE rank <= 5
"""

OP12 = """
WITH payloads AS (
  SELECT page_id, strlen(coalesce(html, '')) AS n, sha256(coalesce(html, '')) AS digest FROM pages
),
firsts AS (SELECT *, min(page_id) OVER (PARTITION BY digest) AS first FROM payloads)
SELECT page_id, n::BIGINT AS payload_bytes, digest AS payload_digest,
       CASE WHEN n >= 100 AND first <> page_id THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN n >= 100 AND first <> page_id THEN first END AS refers_to
FROM firsts
"""


def op13(clusters: int = 8, rounds: int = 10, width: int = 64) -> str:
    """Every round written out: every vector against every centroid."""
    x = "CAST(floor(1024 * CAST(x AS DOUBLE)) AS BIGINT)"
    steps = [f"""v AS MATERIALIZED (
  SELECT row_number() OVER () AS u, vec_id, list_transform(embedding, lambda x: {x}) AS c FROM embeddings
  WHERE len(embedding) = {width}
    AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(CAST(x AS DOUBLE)))) = {width})""",
    f"""c0 AS MATERIALIZED (
  SELECT row_number() OVER (ORDER BY h, c) - 1 AS cluster, c FROM (
    SELECT sha256('3:' || vec_id) AS h, c FROM v WHERE vec_id IS NOT NULL) ORDER BY h, c LIMIT {clusters})""",
    f"long AS MATERIALIZED (SELECT u, unnest(c) AS x, unnest(range({width})) AS i FROM v)"]
    for k in range(rounds + 1):
        steps.append(f"""a{k} AS MATERIALIZED (
  SELECT u, arg_min(cluster, (d, cluster)) AS cluster, min(d) AS d FROM (
    SELECT v.u, m.cluster,
           list_sum(list_transform(list_zip(v.c, m.c), lambda z: (z[1] - z[2]) * (z[1] - z[2])))::BIGINT AS d
    FROM v, c{k} m) GROUP BY u)""")
        if k < rounds:
            steps.append(f"""c{k + 1} AS MATERIALIZED (
  SELECT o.cluster, coalesce(n.c, o.c) AS c FROM c{k} o LEFT JOIN (
    SELECT cluster, list(m ORDER BY i) AS c FROM (
      SELECT cluster, i, (sum(x)::BIGINT - ((sum(x)::BIGINT % count(*)) + count(*)) % count(*)) // count(*) AS m
      FROM long JOIN a{k} USING (u) GROUP BY cluster, i) GROUP BY cluster) n USING (cluster))""")
    return "WITH " + ",\n".join(steps) + f"""
SELECT v.vec_id, a.cluster::INTEGER AS cluster, a.d AS distance,
       (sum(a.d) OVER (PARTITION BY a.cluster))::BIGINT AS cluster_inertia, (sum(a.d) OVER ())::BIGINT AS inertia,
       sha256(array_to_string(c.c, ',')) AS centroid_sha256
FROM a{rounds} a JOIN v USING (u) JOIN c{rounds} c ON c.cluster = a.cluster"""


# op4, op5, op6, op8 and the pipeline have no SQL: an automaton, components, learned models. They
# are tested against brute force.
SQL: dict[str, str] = {
    "op1_sharding": OP1,
    "op2_decontamination": OP2,
    "op3_fingerprints": op3(),
    "op7_urls": op7(),
    "op9_secrets": op9(),
    "op10_mixing": op10(),
    "op11_hard_negatives": OP11,
    "op12_warc": OP12,
    "op13_centroids": op13(),
}
