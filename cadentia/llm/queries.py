"""Registered queries of this subpackage, and the SQL that states the same rows where SQL can."""

from __future__ import annotations

from cadentia.llm.bpe import op11_byte_bpe
from cadentia.llm.extraction import op1_html_extraction
from cadentia.llm.mixing import op7_mixing
from cadentia.llm.near_dup import op2_minhash_near_dedup
from cadentia.llm.neighbours import op3_collision_counting
from cadentia.llm.phrases import op13_collocations
from cadentia.llm.pieces import op5_sentencepiece
from cadentia.llm.pii import op9_pii_pseudonyms
from cadentia.llm.rules import op8_quality_rules
from cadentia.llm.token_counts import op6_token_counts
from cadentia.llm.toxicity import op4_toxicity
from cadentia.llm.turns import op12_turn_repair
from cadentia.llm.warc import op10_warc_revisits

QUERIES = {
    "op1_html_extraction": op1_html_extraction,
    "op2_minhash_near_dedup": op2_minhash_near_dedup,
    "op3_collision_counting": op3_collision_counting,
    "op4_toxicity": op4_toxicity,
    "op5_sentencepiece": op5_sentencepiece,
    "op6_token_counts": op6_token_counts,
    "op7_mixing": op7_mixing,
    "op8_quality_rules": op8_quality_rules,
    "op9_pii_pseudonyms": op9_pii_pseudonyms,
    "op10_warc_revisits": op10_warc_revisits,
    "op11_byte_bpe": op11_byte_bpe,
    "op12_turn_repair": op12_turn_repair,
    "op13_collocations": op13_collocations,
}

#: Words of a whole text, A-Z lower-cased, as a list column ``w``.
_WORDS = r"""regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
    'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+')"""

ORACLES = {
    "op2_minhash_near_dedup": f"""
WITH RECURSIVE words AS (SELECT doc_id, {_WORDS} AS w FROM documents),
loose AS (
    SELECT doc_id, unnest(CASE WHEN len(w) = 0 THEN []
        WHEN len(w) < 5 THEN [array_to_string(w, ' ')]
        ELSE [array_to_string(w[i:i + 4], ' ') FOR i IN range(1, len(w) - 3)] END) AS shingle
    FROM words),
shingles AS (SELECT DISTINCT doc_id, shingle FROM loose),
sizes AS (SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id),
pairs AS (
    SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS common
    FROM shingles a JOIN shingles b ON a.shingle = b.shingle AND a.doc_id <> b.doc_id GROUP BY 1, 2),
links AS (
    SELECT a, b FROM pairs JOIN sizes x ON a = x.doc_id JOIN sizes y ON b = y.doc_id
    WHERE 100 * common >= 85 * (x.n + y.n - common)),
reach(doc_id, seen) AS (
    SELECT doc_id, doc_id FROM documents
    UNION SELECT reach.doc_id, links.b FROM reach JOIN links ON links.a = reach.seen),
least AS (SELECT doc_id, min(seen) AS component_id FROM reach GROUP BY doc_id)
SELECT d.doc_id, coalesce(n, 0) AS n_shingles, component_id, d.doc_id = component_id AS kept
FROM documents d JOIN least USING (doc_id) LEFT JOIN sizes USING (doc_id)
""",
    "op10_warc_revisits": """
WITH payloads AS (
    SELECT page_id, strlen(coalesce(html, '')) AS payload_bytes, sha1(coalesce(html, '')) AS payload_digest FROM pages),
last AS (SELECT *, max(page_id) OVER (PARTITION BY payload_digest) AS held FROM payloads),
marked AS (SELECT *, coalesce(payload_bytes >= 1000 AND page_id < held, false) AS again FROM last)
SELECT page_id, payload_bytes, payload_digest, CASE WHEN again THEN 'revisit' ELSE 'response' END AS record_type,
    CASE WHEN again THEN held END AS refers_to
FROM marked
""",
    "op13_collocations": """
WITH pieces AS (
    SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array(translate(coalesce(text, ''),
        'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\\x0A-\\x0D]')) AS piece FROM documents),
words AS (SELECT lang, regexp_extract_all(piece, '[^\\x20\\x09]+') AS w FROM pieces),
places AS (SELECT lang, w, unnest(range(1, len(w) + 1)) AS i FROM words),
f1 AS (SELECT lang, w[i] AS x, count(*) AS n FROM places GROUP BY ALL),
f2 AS (SELECT lang, w[i] AS x, w[i + 1] AS y, count(*) AS n FROM places WHERE i < len(w) GROUP BY ALL HAVING count(*) >= 10),
f3 AS (SELECT lang, w[i] AS x, w[i + 1] AS y, w[i + 2] AS z, count(*) AS n FROM places WHERE i + 1 < len(w)
    GROUP BY ALL HAVING count(*) >= 10),
inside AS (SELECT lang, x, y, n FROM f3 UNION ALL SELECT lang, y, z, n FROM f3),
longer AS (SELECT lang, x, y, max(n) AS most FROM inside GROUP BY ALL),
cuts AS (
    SELECT lang, x || ' ' || y AS phrase, f2.n AS a, 1 AS k, p.n AS l, q.n AS r
    FROM f2 JOIN f1 p USING (lang, x) JOIN f1 q ON q.lang = f2.lang AND q.x = f2.y LEFT JOIN longer USING (lang, x, y)
    WHERE 100 * coalesce(most, 0) < 50 * f2.n
    UNION ALL
    SELECT f3.lang, f3.x || ' ' || f3.y || ' ' || z, f3.n, 1, p.n, q.n
    FROM f3 JOIN f1 p ON p.lang = f3.lang AND p.x = f3.x JOIN f2 q ON q.lang = f3.lang AND q.x = f3.y AND q.y = z
    UNION ALL
    SELECT f3.lang, f3.x || ' ' || f3.y || ' ' || z, f3.n, 2, p.n, q.n
    FROM f3 JOIN f2 p ON p.lang = f3.lang AND p.x = f3.x AND p.y = f3.y JOIN f1 q ON q.lang = f3.lang AND q.x = z),
scored AS (SELECT *, CAST((CAST(1000000 AS HUGEINT) * a * a) // (CAST(l AS HUGEINT) * r) AS BIGINT) AS score FROM cuts),
lowest AS (SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1),
ranked AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM lowest),
totals AS (SELECT lang, sum(n)::BIGINT AS n FROM f1 GROUP BY lang)
SELECT lang, rank, phrase, a, l, r, n, score FROM ranked JOIN totals USING (lang) WHERE rank <= 2000
""",
}
