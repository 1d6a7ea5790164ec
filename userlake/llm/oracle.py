"""SQL for DuckDB that gives the rows of the queries that SQL can express."""

from __future__ import annotations

import corpus_pipeline

OP2 = r"""
WITH turns AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -1, 0, 'user', '<|im_end|><|im_start|>assistant ok'
  UNION ALL SELECT -1, 1, 'assistant', '<|im_end|><|im_start|>assistant ok'
), placed AS (
  SELECT *, row_number() OVER w AS place, lag(role) OVER w AS before
  FROM turns WINDOW w AS (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text)
), sized AS (
  SELECT *,
    length(replace(replace(text, '\', '\\'), '<|', '<\|')) AS text_chars,
    CASE WHEN before IS NULL OR before <> role
         THEN length(replace(replace(replace(role, '\', '\\'), '<|', '<\|'), chr(10), '<\n|'))
              + length('<|im_start|>') + 1 + length('<|im_end|>') + 1
         ELSE length('<|im_turn|>') END AS mark_chars
  FROM placed
)
SELECT conv_id, count(*) AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY place)) AS turns_sha256,
  coalesce(sum(length(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY place) FILTER (role = 'assistant'), '')) AS loss_sha256,
  sum(text_chars + mark_chars)::BIGINT AS formatted_chars
FROM sized GROUP BY conv_id
"""

OP4 = r"""
WITH split AS (
  SELECT row_number() OVER () AS r, doc_id, source, coalesce(text, '') AS text,
    list_filter(regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS words,
    list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS lines
  FROM documents
), windows AS (
  SELECT r, i, words[i] || ' ' || words[i + 1] || ' ' || words[i + 2] AS w
  FROM (SELECT r, words, unnest(range(1, len(words) - 1)) AS i FROM split)
), twice AS (
  SELECT r, unnest(list(i)) AS i FROM windows GROUP BY r, w HAVING count(*) > 1
), covered AS (
  SELECT r, count(DISTINCT i + k) AS n FROM twice, (SELECT unnest([0, 1, 2]) AS k) GROUP BY r
), figures AS (
  SELECT doc_id, source, len(words)::BIGINT AS n_words,
    length(array_to_string(words, ''))::BIGINT AS word_chars,
    (length(text) - length(regexp_replace(text, '[#*$%&|<>]', '', 'g')))::BIGINT AS n_symbols,
    (len(lines) - len(list_distinct(lines)))::BIGINT AS n_dup_lines, len(lines)::BIGINT AS n_lines,
    coalesce(n, 0)::BIGINT AS n_repeat_words
  FROM split LEFT JOIN covered USING (r)
), judged AS (
  SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed FROM figures
), hosts AS (
  SELECT source, count(*) AS n, [
    count(*) FILTER (n_words < 50), count(*) FILTER (100 * n_repeat_words > 50 * n_words),
    count(*) FILTER (100 * n_symbols > 10 * n_words), count(*) FILTER (100 * n_dup_lines > 30 * n_lines)
  ] AS failures
  FROM judged WHERE source IS NOT NULL GROUP BY source
), by_rule AS (
  SELECT source, n, unnest([1, 2, 3, 4]) AS rule, unnest(failures) AS x FROM hosts
), moments AS (
  SELECT rule, count(*) AS k, sum(n)::DOUBLE AS n, sum(n * n)::DOUBLE AS squares, sum(x)::DOUBLE AS x,
    sum(x * x / n) AS s, sum(x) / sum(n) AS m
  FROM by_rule GROUP BY rule
), spreads AS (
  SELECT rule, m, s - x * x / n - m * (1 - m) * (k - 1) AS between_hosts, m * (1 - m) * (n - squares / n - (k - 1) + 100) AS room
  FROM moments
), priors AS (
  SELECT rule, m, least(greatest(CASE WHEN between_hosts > 0 THEN room / between_hosts - 1 ELSE 1e6 END, 1e-6), 1e6) AS strength
  FROM spreads
), rejected AS (
  SELECT DISTINCT source FROM by_rule JOIN priors USING (rule) WHERE (x + m * strength) / (n + strength) > 0.5
)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, n_lines, base_failed,
  NOT base_failed AND NOT coalesce(source IN (SELECT source FROM rejected), false) AS kept
FROM judged
"""

OP6 = r"""
WITH hashed AS (
  SELECT page_id, coalesce(html, '') AS html, sha1(coalesce(html, '')) AS h FROM pages
), placed AS (
  SELECT *, min(page_id) OVER (PARTITION BY html) AS first,
    row_number() OVER (PARTITION BY html, page_id) AS repeat
  FROM hashed
)
SELECT page_id, octet_length(encode(html))::BIGINT AS payload_bytes,
  array_to_string(list_transform(range(32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
    1 + ((('0x' || substr(h, 1 + 5 * (i // 4), 5))::BIGINT >> (15 - 5 * (i % 4))::BIGINT) % 32)::BIGINT, 1)), '') AS payload_digest,
  CASE WHEN first IS NULL OR (page_id = first AND repeat = 1) THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN first IS NULL OR (page_id = first AND repeat = 1) THEN NULL ELSE first END AS refers_to
FROM placed
"""

OP11 = r"""
WITH docs AS (
  SELECT doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS text FROM documents
), split AS (
  SELECT *, list_filter(regexp_split_to_array(text, '[\x20\x09-\x0D]+'), lambda x: x <> '') AS words,
    min(doc_id) OVER (PARTITION BY text) AS first
  FROM docs
), flags AS (
  SELECT doc_id, part,
    len(words) < 100 AS a,
    100 * len(list_distinct(words)) < 80 * len(words) AS b,
    100 * (length(text) - length(regexp_replace(text, '[A-Z]', '', 'g'))) > 10 * length(text) AS c,
    regexp_matches(text, '[#$%&*|]') AS d,
    coalesce(first < doc_id, false) AS e
  FROM split
), labelled AS (
  SELECT f.part, f.a::INT + 2 * f.b::INT + 4 * f.c::INT + 8 * f.d::INT + 16 * f.e::INT AS mask,
    coalesce(l.good, false) AS good, coalesce(l.toxic, false) AS toxic
  FROM flags f LEFT JOIN (
    SELECT doc_id, bool_or(quality = 1) AS good, bool_or(toxic = 1) AS toxic FROM labels GROUP BY doc_id
  ) l USING (doc_id)
), cells AS (
  SELECT part, mask, count(*) AS n, count(*) FILTER (good) AS good, count(*) FILTER (toxic) AS toxic
  FROM labelled GROUP BY part, mask
), letters AS (
  SELECT * FROM (VALUES ('A', 1), ('B', 2), ('C', 4), ('D', 8), ('E', 16)) t(f, bit)
), orders AS (
  SELECT p.f || q.f || r.f || s.f || t.f AS filter_order, [p.bit, q.bit, r.bit, s.bit, t.bit] AS bits
  FROM letters p, letters q, letters r, letters s, letters t
  WHERE p.bit + q.bit + r.bit + s.bit + t.bit = 31 AND (p.bit | q.bit | r.bit | s.bit | t.bit) = 31
), steps AS (
  SELECT filter_order, step, bits[step] AS bit, coalesce(list_sum(bits[1:step - 1]), 0)::INT AS before
  FROM orders, range(1, 6) g(step)
), counts AS (
  SELECT part, filter_order, step, bit,
    sum(CASE WHEN mask & (before | bit) = 0 THEN n ELSE 0 END)::BIGINT AS kept,
    sum(CASE WHEN mask & bit <> 0 AND mask & before = 0 THEN n ELSE 0 END)::BIGINT AS removed,
    sum(CASE WHEN mask & bit <> 0 AND mask & before <> 0 THEN n ELSE 0 END)::BIGINT AS redundant,
    sum(CASE WHEN mask = bit THEN n ELSE 0 END)::BIGINT AS unique_fails,
    sum(CASE WHEN mask & bit <> 0 AND mask & before = 0 THEN good ELSE 0 END)::BIGINT AS good_lost,
    sum(CASE WHEN mask & bit <> 0 AND mask & before = 0 THEN toxic ELSE 0 END)::BIGINT AS toxic_lost
  FROM cells, steps GROUP BY ALL
)
SELECT * EXCLUDE (bit, step), step::INT AS step, sum(removed) OVER (PARTITION BY part, bit)::BIGINT AS shapley FROM counts
"""

OP12 = """
WITH vectors AS (
  SELECT row_number() OVER () AS uid, vec_id, [floor(64 * x::DOUBLE)::BIGINT for x in embedding] AS v
  FROM embeddings
  WHERE embedding IS NOT NULL AND len([x for x in embedding if x IS NULL OR NOT isfinite(x)]) = 0
), scores AS (
  SELECT q.uid AS query, q.vec_id AS query_id, x.uid, x.vec_id, list_sum(list_transform(list_zip(q.v, x.v), lambda p: p[1] * p[2]))::BIGINT AS score
  FROM vectors q JOIN vectors x ON q.uid <> x.uid AND len(q.v) = len(x.v) WHERE q.vec_id % 20 = 0
), ranked AS (
  SELECT *, row_number() OVER (PARTITION BY query ORDER BY score DESC, vec_id NULLS LAST, uid) AS rank FROM scores
)
SELECT query_id, rank::INTEGER AS rank, vec_id, coalesce(score, 0) AS score FROM ranked WHERE rank <= 20
"""

OP13 = r"""
WITH docs AS (
  SELECT row_number() OVER () AS r, coalesce(lang, '') AS lang, coalesce(source, '') AS source, coalesce(text, '') AS text
  FROM documents
), words AS (
  SELECT r, lang, source, unnest(regexp_extract_all(
    translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x40\x5B-\x60\x7B-\x7F]+')) AS term
  FROM docs
), kept AS (
  SELECT lang, term, count(*) AS total FROM words GROUP BY lang, term HAVING count(DISTINCT r) >= 30
), counts AS (
  SELECT lang, source, term, count(*) AS c FROM words JOIN kept USING (lang, term) GROUP BY ALL
), langs AS (
  SELECT lang, count(*)::HUGEINT AS v, sum(total)::HUGEINT AS n FROM kept GROUP BY lang
), groups AS (
  SELECT g.lang, g.source, coalesce(v, 0) AS v, coalesce(s.n, 0)::HUGEINT AS n
  FROM (SELECT DISTINCT lang, source FROM docs) g LEFT JOIN langs USING (lang)
  LEFT JOIN (SELECT lang, source, sum(c) AS n FROM counts GROUP BY lang, source) s USING (lang, source)
), shares AS (
  SELECT g.lang, g.source, term, coalesce(c, 0) AS c, total,
    1 + 1000000000::HUGEINT * (coalesce(c, 0) + 5) // (g.n + 5 * g.v) AS p
  FROM groups g JOIN kept USING (lang) LEFT JOIN counts USING (lang, source, term)
), pairs AS (
  SELECT a.lang, a.source, b.source AS item, sum(abs(a.p - b.p)) AS value
  FROM shares a JOIN shares b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL
), all_pairs AS (
  SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(value, 0) AS value
  FROM groups a JOIN groups b ON a.lang = b.lang AND a.source <> b.source
  LEFT JOIN pairs p ON p.lang = a.lang AND p.source = a.source AND p.item = b.source
), terms AS (
  SELECT lang, source, 'term' AS part, term AS item,
    p - (1 + 1000000000::HUGEINT * (total + 5) // (l.n + 5 * l.v)) AS value
  FROM shares JOIN langs l USING (lang) WHERE c > 0
), ranked AS (
  SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item COLLATE "C") AS rank
  FROM (FROM all_pairs UNION ALL FROM terms WHERE value > 0)
)
SELECT lang, source, part, item, value::BIGINT AS value, rank::INTEGER AS rank
FROM ranked WHERE part = 'pair' OR rank <= 50
"""

STATEMENTS: dict[str, str] = {
    "op2_chat_format": OP2,
    "op4_quality_rules": OP4,
    "op6_warc": OP6,
    "op11_filter_audit": OP11,
    "op12_metric_search": OP12,
    "op13_divergence": OP13,
}


def statements() -> dict[str, str]:
    return dict(STATEMENTS) | ({"pipeline": corpus_pipeline.ORACLE_SQL} if corpus_pipeline.ORACLE_SQL else {})
