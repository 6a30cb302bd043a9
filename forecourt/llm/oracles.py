"""SQL for the queries that SQL can express.

None for op1 (page structure), op3 (tokenizer files), op4 (byte-pair merges), op5 (sketches; its
classes need all pairs), op6 (CRC-32 word buckets), op8 (fitted model) and op13 (piece merges): their
tests compare them with brute force, a round trip or held-out labels.
"""

from __future__ import annotations

from forecourt.llm import collocations, filter_audit, mixing
from forecourt.llm import secret_scan as secrets

ORACLES: dict[str, str] = {}


def _quoted(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def _matches(kind: str, pattern: str) -> str:
    """doc_id, kind, start, end and text of all matches of a pattern."""
    return f"""
    SELECT doc_id, '{kind}' AS kind, hit AS run,
           list_sum(list_transform(pieces[1:i], lambda x: length(x)))
             + coalesce(list_sum(list_transform(hits[1:i - 1], lambda x: length(x))), 0) AS first_char
    FROM (SELECT doc_id, hits, pieces, unnest(hits) AS hit, generate_subscripts(hits, 1) AS i
          FROM (SELECT doc_id, regexp_extract_all(text, {_quoted(pattern)}) AS hits,
                       string_split_regex(text, {_quoted(pattern)}) AS pieces
                FROM texts WHERE regexp_matches(text, {_quoted(pattern)})))"""


def _secret_scan() -> str:
    base = {
        "assign": secrets.ASSIGN,
        "access": secrets.ACCESS,
        "hex": secrets.HEX,
    }
    value = f"length(regexp_extract(run, {_quoted(secrets.ASSIGN)}, 2)) >= {secrets.ASSIGN_VALUE_CHARS}"
    limits = " ".join(f"WHEN '{c.kind}' THEN {secrets.most_repetition(c.bits)}" for c in secrets.CLASSES)
    order = " ".join(f"WHEN '{kind}' THEN {i}" for i, kind in enumerate(secrets.KINDS))
    written = "kind || ':' || first_char || ':' || past_char, ',' ORDER BY first_char, place"
    inside = "o.doc_id = e.doc_id AND o.first_char <= e.first_char AND e.past_char <= o.past_char"
    first, second = (c.kind for c in secrets.CLASSES)
    counted = ", ".join(f"count(*) FILTER (kind = '{k}') AS n_{k}" for k in secrets.BASE_KINDS)
    return f"""
WITH texts AS (SELECT doc_id, coalesce(text, '') AS text FROM documents),
base AS (
    SELECT doc_id, kind, first_char, first_char + length(run) AS past_char
    FROM ({" UNION ALL ".join(_matches(k, p) for k, p in base.items())}) m
    WHERE kind <> 'assign' OR {value}
), runs AS (
    SELECT doc_id, kind, run, first_char, first_char + length(run) AS past_char
    FROM ({" UNION ALL ".join(_matches(c.kind, c.pattern) for c in secrets.CLASSES)}) m
), parts AS (
    SELECT DISTINCT kind, run, unnest(string_split_regex(run, {_quoted(secrets.MARKED)})) AS part FROM runs
), windows AS (
    SELECT kind, run, part, place, substr(part, place, {secrets.WINDOW}) AS seen
    FROM (SELECT *, unnest(range(1, length(part) - {secrets.WINDOW} + 2)) AS place FROM parts)
    WHERE regexp_matches(seen, '[0-9]') AND regexp_matches(seen, '[A-Za-z]')
), letters AS (
    SELECT kind, run, part, place, unnest(string_split(seen, '')) AS letter FROM windows
), repetition AS (
    SELECT kind, run, part, place, sum(round(n * log2(n) * {secrets.SCALE})) AS bits
    FROM (SELECT kind, run, part, place, letter, count(*) AS n FROM letters GROUP BY ALL) GROUP BY ALL
), dense AS (
    SELECT kind, run FROM repetition GROUP BY ALL HAVING min(bits) <= CASE kind {limits} END
), entropy AS (
    SELECT doc_id, kind, first_char, past_char FROM runs SEMI JOIN dense USING (kind, run)
), hexes AS (
    SELECT * FROM entropy e WHERE kind = '{first}' AND NOT EXISTS (SELECT 1 FROM base o WHERE {inside})
), others AS (
    SELECT * FROM entropy e WHERE kind = '{second}'
      AND NOT EXISTS (SELECT 1 FROM base o WHERE {inside}) AND NOT EXISTS (SELECT 1 FROM hexes o WHERE {inside})
), spans AS (
    SELECT *, CASE kind {order} END AS place
    FROM (SELECT * FROM base UNION ALL SELECT * FROM hexes UNION ALL SELECT * FROM others)
), found AS (
    SELECT doc_id, {counted},
           coalesce(string_agg({written}) FILTER (place < {len(secrets.BASE_KINDS)}), '') AS base_spans,
           string_agg({written}) AS spans
    FROM spans GROUP BY doc_id
)
SELECT doc_id, {", ".join(f"coalesce(n_{k}, 0) AS n_{k}" for k in secrets.BASE_KINDS)},
       sha256(coalesce(base_spans, '')) AS base_sha256, coalesce(spans, '') AS spans
FROM texts LEFT JOIN found USING (doc_id)
"""


ORACLES["op2_secret_scan"] = _secret_scan()

ORACLES["op7_warc"] = """
WITH payloads AS (
    SELECT page_id, coalesce(html, '') AS html FROM pages
), digests AS (
    SELECT page_id, strlen(html) AS payload_bytes, sha1(html) AS digest, max(page_id) OVER (PARTITION BY html) AS last
    FROM payloads
)
SELECT page_id, payload_bytes,
       array_to_string(list_transform(range(32), lambda i:
           substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
                  1 + ((('0x' || substr(digest, 1 + 5 * (i // 4)::INT, 5))::INT >> (5 * (3 - i % 4))::INT) & 31), 1)), '')
         AS payload_digest,
       CASE WHEN last = page_id THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN last <> page_id THEN last END AS refers_to
FROM digests
"""

ORACLES["op9_nearest"] = """
WITH vectors AS (
    SELECT DISTINCT vec_id, embedding::DOUBLE[] AS v FROM embeddings
    WHERE len(list_filter(embedding, lambda x: x IS NULL OR isnan(x) OR isinf(x))) = 0
      AND len(list_filter(embedding, lambda x: x <> 0)) > 0
), scored AS (
    SELECT q.vec_id AS query_id, q.v, c.vec_id, list_inner_product(q.v, c.v) AS score
    FROM vectors q JOIN vectors c ON q.vec_id <> c.vec_id OR q.v <> c.v WHERE q.vec_id % 20 = 0
)
SELECT query_id, row_number() OVER (PARTITION BY query_id, v ORDER BY score DESC, vec_id)::INT AS rank, vec_id, score
FROM scored QUALIFY rank <= 20
"""

ORACLES["op10_mixing"] = f"""
WITH RECURSIVE sizes AS (
    SELECT source, coalesce(sum(length(text)), 0)::DOUBLE AS n_chars FROM documents GROUP BY source
), rates AS (
    SELECT source,
           CASE WHEN n_chars > 0
                THEN (SELECT sum(n_chars) FROM sizes) * (sqrt(n_chars) / (SELECT sum(sqrt(n_chars)) FROM sizes)) / n_chars
                ELSE 1.0 END AS rate
    FROM sizes
), parts AS (
    SELECT source, greatest(1, ceil(rate / {mixing.PART_RATE}))::INT AS n_parts,
           rate / greatest(1, ceil(rate / {mixing.PART_RATE})) AS rate
    FROM rates
), poisson AS (
    SELECT source, rate, 0 AS k, exp(-rate) AS p, exp(-rate) AS upto FROM parts
    UNION ALL
    SELECT source, rate, k + 1, p * rate / (k + 1), upto + p * rate / (k + 1) FROM poisson WHERE k < {mixing.ENTRIES - 1}
), draws AS (
    SELECT doc_id, source,
           ('0x' || substr(md5('{mixing.SEED}:' || coalesce(doc_id::VARCHAR, '') || ':' || part), 1, 13))::BIGINT / 16.0::DOUBLE ** 13 AS u
    FROM (SELECT DISTINCT doc_id, source FROM documents) d JOIN parts USING (source), range(1, n_parts + 1) r(part)
), counts AS (
    SELECT draws.doc_id, draws.source, count(poisson.k) AS n_copies
    FROM draws LEFT JOIN poisson ON poisson.source = draws.source AND poisson.upto <= draws.u
    GROUP BY draws.doc_id, draws.source
)
SELECT d.*, n_copies::INT AS n_copies, copy::INT AS copy,
       md5('{mixing.SEED}|' || coalesce(d.doc_id::VARCHAR, '') || '|' || copy) AS position
FROM documents d JOIN counts c ON c.doc_id = d.doc_id AND c.source = d.source, range(1, n_copies + 1) r(copy)
"""

ORACLES["op11_collocations"] = f"""
WITH pieces AS (
    SELECT coalesce(lang, 'und') AS lang,
           unnest(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                     '[.,;:!?\\x0A-\\x0D]')) AS piece
    FROM documents
), words AS (
    SELECT lang, list_filter(string_split_regex(piece, '[\\x20\\x09]+'), lambda w: w <> '') AS words FROM pieces
), places AS (
    SELECT lang, words, size::INT AS size, unnest(range(1, len(words) - size::INT + 2)) AS place FROM words, range(1, 6) s(size)
), counts AS (
    SELECT lang, size, array_to_string(words[place:place + size - 1], ' ') AS phrase, count(*) AS n
    FROM places GROUP BY ALL HAVING count(*) >= {collocations.LEAST_COUNT}
), totals AS (
    SELECT lang, sum(len(words)) AS n FROM words GROUP BY lang
), phrases AS (
    SELECT *, string_split(phrase, ' ') AS words FROM counts WHERE size >= 2
), inner_phrases AS (
    SELECT lang, array_to_string(words[first:first + length - 1], ' ') AS phrase, max(n) AS longest
    FROM (SELECT *, unnest(range(1, size - length + 2)) AS first
          FROM (SELECT lang, words, n, size, unnest(range(2, size)) AS length FROM phrases))
    GROUP BY ALL
), kept AS (
    SELECT p.* FROM phrases p LEFT JOIN inner_phrases i USING (lang, phrase) WHERE longest IS NULL OR 100 * longest < 100 * n
), cuts AS (
    SELECT lang, phrase, n AS a, k::INT AS k, array_to_string(words[1:k], ' ') AS first_words, array_to_string(words[k + 1:], ' ') AS rest
    FROM (SELECT *, unnest(range(1, size)) AS k FROM kept)
), scored AS (
    SELECT c.lang, c.phrase, c.a, f.n AS l, r.n AS r, t.n::BIGINT AS n,
           ((1000::HUGEINT * c.a * t.n::HUGEINT) // (f.n::HUGEINT * r.n))::BIGINT AS score
    FROM cuts c JOIN counts f ON f.lang = c.lang AND f.phrase = c.first_words
      JOIN counts r ON r.lang = c.lang AND r.phrase = c.rest JOIN totals t ON t.lang = c.lang
    QUALIFY row_number() OVER (PARTITION BY c.lang, c.phrase ORDER BY score, c.k) = 1
)
SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, encode(phrase)) AS rank, phrase, a, l, r, n, score
FROM scored QUALIFY rank <= {collocations.PER_LANG}
"""

_LETTERS = ", ".join(f"'{letter}'" for letter in filter_audit.FILTERS)
ORACLES["op12_filter_audit"] = f"""
WITH docs AS (
    SELECT doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS text, min(doc_id) OVER (PARTITION BY text) AS original
    FROM (SELECT doc_id, lang, coalesce(text, '') AS text FROM documents)
), measured AS (
    SELECT doc_id, part, text, original, list_filter(string_split_regex(text, '[\\x20\\x09-\\x0D]+'), lambda w: w <> '') AS words
    FROM docs
), failed AS (
    SELECT doc_id, part,
           CASE WHEN len(words) < 100 THEN 'A' ELSE '' END
             || CASE WHEN 100 * len(list_distinct(words)) < 80 * len(words) THEN 'B' ELSE '' END
             || CASE WHEN 100 * length(regexp_replace(text, '[^A-Z]', '', 'g')) > 10 * length(text) THEN 'C' ELSE '' END
             || CASE WHEN regexp_matches(text, '[#$%&*|]') THEN 'D' ELSE '' END
             || CASE WHEN original < doc_id THEN 'E' ELSE '' END AS fails
    FROM measured
), marked AS (
    SELECT doc_id, bool_or(quality = 1) AS good, bool_or(toxic = 1) AS toxic FROM labels GROUP BY doc_id
), masks AS (
    SELECT part, fails, count(*) AS n, count(*) FILTER (good) AS good, count(*) FILTER (toxic) AS toxic
    FROM failed LEFT JOIN marked USING (doc_id) GROUP BY part, fails
), letters AS (
    SELECT unnest([{_LETTERS}]) AS f
), orders AS (
    SELECT a.f || b.f || c.f || d.f || e.f AS filter_order
    FROM letters a JOIN letters b ON b.f <> a.f JOIN letters c ON c.f NOT IN (a.f, b.f)
      JOIN letters d ON d.f NOT IN (a.f, b.f, c.f) JOIN letters e ON e.f NOT IN (a.f, b.f, c.f, d.f)
), steps AS (
    SELECT filter_order, step::INT AS step, filter_order[step] AS f, left(filter_order, step - 1) AS earlier
    FROM orders, range(1, 6) r(step)
), figures AS (
    SELECT part, filter_order, step, f,
           coalesce(sum(n) FILTER (translate(fails, earlier || f, '') = fails), 0)::BIGINT AS kept,
           coalesce(sum(n) FILTER (contains(fails, f) AND translate(fails, earlier, '') = fails), 0)::BIGINT AS removed,
           coalesce(sum(n) FILTER (contains(fails, f) AND translate(fails, earlier, '') <> fails), 0)::BIGINT AS redundant,
           coalesce(sum(n) FILTER (fails = f), 0)::BIGINT AS unique_fails,
           coalesce(sum(good) FILTER (contains(fails, f) AND translate(fails, earlier, '') = fails), 0)::BIGINT AS good_lost,
           coalesce(sum(toxic) FILTER (contains(fails, f) AND translate(fails, earlier, '') = fails), 0)::BIGINT AS toxic_lost
    FROM masks, steps GROUP BY ALL
)
SELECT * EXCLUDE (f), (sum(removed) OVER (PARTITION BY part, f))::BIGINT AS shapley FROM figures
"""
