"""DuckDB's SQL for the queries that SQL can express."""

from __future__ import annotations

from .quality_rules import POLICIES, RULES

WORDS = r"regexp_extract_all(coalesce({0}, ''), '[^\x20\x09-\x0D]+')"

OP1 = f"""
WITH RECURSIVE words AS (SELECT doc_id, {WORDS.format("translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')")} AS w FROM documents),
sets AS (SELECT doc_id, CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 5 THEN [array_to_string(w, ' ')]
  ELSE list_distinct([array_to_string(w[i:i+4], ' ') FOR i IN range(1, len(w) - 3)]) END AS s FROM words),
sizes AS (SELECT doc_id, len(s)::BIGINT AS n FROM sets),
each AS (SELECT doc_id, unnest(s) AS x FROM sets),
often AS (SELECT x FROM each GROUP BY x HAVING count(*) > 1),
shared AS (SELECT doc_id, x FROM each JOIN often USING (x)),
pairs AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS k FROM shared a JOIN shared b ON a.x = b.x AND a.doc_id <> b.doc_id GROUP BY 1, 2),
links AS (SELECT a, b FROM pairs JOIN sizes p ON a = p.doc_id JOIN sizes q ON b = q.doc_id WHERE 100 * k >= 75 * (p.n + q.n - k)),
reach AS (SELECT doc_id AS a, doc_id AS b FROM sizes UNION SELECT reach.a, links.b FROM reach JOIN links ON reach.b = links.a)
SELECT doc_id, n AS n_shingles, (SELECT min(b) FROM reach WHERE a = doc_id) AS component_id FROM sizes
"""

OP4 = f"""
WITH sized AS (SELECT doc_id, source, text, len({WORDS.format('text')})::BIGINT AS size FROM documents),
keyed AS (SELECT doc_id, source, size, -ln((('0x' || substr(md5('7:' || coalesce(doc_id::VARCHAR, '')), 1, 12))::BIGINT::DOUBLE + 1.0::DOUBLE) / 281474976710656.0::DOUBLE)
  / greatest(0.25::DOUBLE, 1.0::DOUBLE / (1.0::DOUBLE + len(regexp_extract_all(coalesce(text, ''), '[#*$%&|<>]'))::DOUBLE / greatest(size, 1)::DOUBLE)) AS key FROM sized),
by_source AS (SELECT source, sum(size)::BIGINT AS source_size FROM keyed GROUP BY source),
weighed AS (SELECT *, [3.0::DOUBLE, 1.0::DOUBLE, 2.0::DOUBLE][((row_number() OVER (ORDER BY source IS NULL, source) - 1) % 3 + 1)::BIGINT] AS weight, source_size * 2.0::DOUBLE AS cap FROM by_source),
filled AS (SELECT *, coalesce(sum(cap) OVER (o ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS capped, sum(weight) OVER (o ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS open_weight,
  sum(source_size) OVER () * 1.5::DOUBLE AS total FROM weighed WINDOW o AS (ORDER BY cap / weight, source IS NULL, source)),
levels AS (SELECT *, (total - capped) / open_weight AS level FROM filled),
chosen AS (SELECT arg_min(level, cap / weight) AS level FROM levels WHERE level * weight <= cap),
plan AS (SELECT source, source_size, least(cap, coalesce(chosen.level * weight, cap)) AS target FROM levels, chosen),
epochs AS (SELECT keyed.*, source_size, target, CASE WHEN source_size > 0 THEN floor(target / source_size) ELSE 0 END::BIGINT AS epochs FROM keyed JOIN plan ON keyed.source IS NOT DISTINCT FROM plan.source),
started AS (SELECT *, coalesce(sum(size) OVER (PARTITION BY source ORDER BY key, doc_id, size ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS start FROM epochs)
SELECT doc_id, size, source_size, target, (size * (epochs + CASE WHEN epochs < 2 AND (2 * start + size)::DOUBLE <= 2.0::DOUBLE * (target - epochs * source_size) THEN 1 ELSE 0 END))::BIGINT AS taken FROM started
"""

CONTROL = r"(\\*)(### |</turn>)"
OP6 = rf"""
WITH rows AS (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, turn, role, '\### Assistant: </turn> ok' FROM (VALUES (0, 'user'), (1, 'assistant')) t(turn, role))
SELECT conv_id, count(*) AS n_turns, sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
  coalesce(sum(length(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars, sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
  sum(length('### ' || role || ':' || chr(10) || regexp_replace(text, '{CONTROL}', '\\\1\2', 'g') || chr(10) || '</turn>' || chr(10)))::BIGINT AS formatted_chars
FROM rows GROUP BY conv_id
"""

BITS = " + ".join(f"CASE WHEN {fails} THEN {1 << i} ELSE 0 END" for i, (_, fails) in enumerate(RULES))
OP9 = rf"""
WITH words AS (SELECT doc_id, coalesce(text, '') AS text, {WORDS.format('text')} AS w FROM documents),
each AS (SELECT doc_id, unnest(range(1, len(w) - 1)) AS p, w FROM words WHERE len(w) >= 3),
windows AS (SELECT doc_id, p, md5(w[p] || ' ' || w[p + 1] || ' ' || w[p + 2]) AS k FROM each),
twice AS (SELECT doc_id, p, count(*) OVER (PARTITION BY doc_id, k) AS n FROM windows),
covered AS (SELECT doc_id, count(DISTINCT p + o)::BIGINT AS n_repeat_words FROM twice, (VALUES (0), (1), (2)) t(o) WHERE n > 1 GROUP BY doc_id),
lines AS (SELECT doc_id, list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS l FROM words),
measured AS (SELECT doc_id, len(w)::BIGINT AS n_words, length(array_to_string(w, ''))::BIGINT AS word_chars, len(regexp_extract_all(text, '[#*$%&|<>]'))::BIGINT AS n_symbols,
  len(l)::BIGINT AS n_lines, (len(l) - len(list_distinct(l)))::BIGINT AS n_dup_lines, coalesce(n_repeat_words, 0) AS n_repeat_words,
  len(regexp_extract_all(text, '[A-Z]'))::BIGINT AS n_upper, len(regexp_extract_all(text, '!'))::BIGINT AS n_exclaim
  FROM words JOIN lines USING (doc_id) LEFT JOIN covered USING (doc_id)),
judged AS (SELECT *, ({BITS})::BIGINT AS bits FROM measured)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, (bits & {POLICIES['base']}) <> 0 AS base_failed, (bits & {POLICIES['v1']}) = 0 AS kept, bits, n_lines, n_upper, n_exclaim FROM judged
"""

OP8 = """
WITH bytes AS (SELECT doc_id, hex(encode(coalesce(text, ''))) AS h FROM documents),
starts AS (SELECT doc_id, unnest(range(0, length(h) // 2 - 199)) AS p, h FROM bytes WHERE length(h) >= 400),
hashed AS (SELECT doc_id, p, md5(substr(h, 2 * p + 1, 400)) AS k FROM starts),
again AS (SELECT doc_id, p FROM (SELECT doc_id, p, count(*) OVER (PARTITION BY k) AS n FROM hashed) WHERE n > 1),
marked AS (SELECT doc_id, p, p > lag(p) OVER (PARTITION BY doc_id ORDER BY p) + 200 AS gap FROM again),
numbered AS (SELECT doc_id, p, sum(CASE WHEN gap IS NULL OR gap THEN 1 ELSE 0 END) OVER (PARTITION BY doc_id ORDER BY p) AS run FROM marked),
spans AS (SELECT doc_id, run, min(p) AS a, max(p) + 200 AS z FROM numbered GROUP BY ALL),
kept AS (SELECT doc_id, a, z, coalesce(lag(z) OVER (PARTITION BY doc_id ORDER BY a), 0) AS before FROM spans),
cut AS (SELECT doc_id, sum(z - a) AS n, count(*) AS k, max(z) AS last, string_agg(substr(h, 2 * before + 1, 2 * (a - before)), '' ORDER BY a) AS front FROM kept JOIN bytes USING (doc_id) GROUP BY doc_id)
SELECT doc_id, (length(h) // 2)::BIGINT AS n_bytes, coalesce(n, 0)::BIGINT AS n_removed, coalesce(k, 0)::BIGINT AS n_spans,
  sha256(unhex(CASE WHEN k IS NULL THEN h ELSE front || substr(h, 2 * last + 1) END)) AS kept_sha256 FROM bytes LEFT JOIN cut USING (doc_id)
"""

OP11 = r"""
WITH said AS (SELECT coalesce(lang, 'und') AS lang, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS t FROM documents),
pieces AS (SELECT lang, unnest(regexp_split_to_array(t, '[.,;:!?\x0A-\x0D]')) AS piece FROM said),
split AS (SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w FROM pieces),
runs AS (SELECT lang, unnest(list_concat([w[i:i] FOR i IN range(1, len(w) + 1)], [w[i:i+1] FOR i IN range(1, len(w))], [w[i:i+2] FOR i IN range(1, len(w) - 1)], [w[i:i+3] FOR i IN range(1, len(w) - 2)])) AS g FROM split),
counted AS (SELECT lang, g, count(*) AS f FROM runs GROUP BY ALL),
totals AS (SELECT lang, sum(len(w))::BIGINT AS n FROM split GROUP BY lang),
candidates AS (SELECT lang, g, f AS a FROM counted WHERE len(g) > 1 AND f >= 30),
cuts AS (SELECT lang, g, a, unnest(range(1, len(g))) AS k FROM candidates),
sides AS (SELECT c.lang, c.g, c.a, c.k, x.f AS l, y.f AS r, ((2000000::HUGEINT * c.a) // (x.f + y.f))::BIGINT AS score
  FROM cuts c JOIN counted x ON x.lang = c.lang AND x.g = c.g[1:c.k] JOIN counted y ON y.lang = c.lang AND y.g = c.g[c.k+1:]),
lowest AS (SELECT lang, g, a, arg_min({'l': l, 'r': r, 'score': score}, (score, k)) AS cut FROM sides GROUP BY ALL),
inner_ones AS (SELECT lang, a, unnest(list_concat([g[i:i+1] FOR i IN range(1, len(g))], CASE WHEN len(g) = 4 THEN [g[1:3], g[2:4]] ELSE [] END)) AS g FROM candidates WHERE len(g) > 2),
contained AS (SELECT lang, g, max(a) AS longer FROM inner_ones GROUP BY ALL),
kept AS (SELECT w.lang, array_to_string(w.g, ' ') AS phrase, w.a, cut.l AS l, cut.r AS r, cut.score AS score FROM lowest w LEFT JOIN contained c ON c.lang = w.lang AND c.g = w.g
  WHERE longer IS NULL OR 100::HUGEINT * longer < 80::HUGEINT * w.a),
placed AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM kept)
SELECT lang, rank, phrase, a, l, r, n, score FROM placed JOIN totals USING (lang) WHERE rank <= 2000
"""

ORACLES = {
    "op1_ngram_join": OP1,
    "op4_source_mixing": OP4,
    "op6_chat_formatting": OP6,
    "op8_suffix_dedup": OP8,
    "op9_quality_rules": OP9,
    "op11_phrase_collocations": OP11,
}
