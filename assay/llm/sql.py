"""DuckDB SQL for the operators' queries that SQL can express on whole tables."""

from __future__ import annotations

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def lowered(text: str) -> str:
    return f"translate({text}, '{UPPER}', '{LOWER}')"


TERM = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"

LEXICAL = f"""
WITH words AS (SELECT row_number() OVER () AS d, doc_id, regexp_extract_all({lowered("text")}, '{TERM}') AS w FROM documents),
lens AS (SELECT d, doc_id, len(w) AS n FROM words WHERE len(w) > 0),
totals AS (SELECT count(*) AS big_n, sum(n)::BIGINT AS big_l FROM lens),
tf AS (SELECT d, t, count(*) AS tf FROM (SELECT d, unnest(w) AS t FROM words) GROUP BY d, t),
item_terms AS (SELECT DISTINCT item_id, unnest(regexp_extract_all({lowered("text")}, '{TERM}')) AS t FROM benchmark),
weights AS (SELECT t, floor(1000 * ln(CAST(2 * big_n + 2 AS DOUBLE) / CAST(2 * count(*) + 1 AS DOUBLE)))::BIGINT AS w
            FROM tf, totals WHERE t IN (SELECT t FROM item_terms) GROUP BY t, big_n),
sized AS (SELECT d, doc_id, 10 + (90 * n * big_n) // big_l AS m FROM lens, totals),
scored AS (SELECT item_id, doc_id, d, sum(w * ((1000000000 * tf) // (1000 * tf + 8 * m)))::BIGINT AS score
           FROM item_terms JOIN tf USING (t) JOIN weights USING (t) JOIN sized USING (d) GROUP BY item_id, doc_id, d),
ranked AS (SELECT item_id, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id ASC NULLS LAST)::INTEGER AS rank,
                  doc_id, score FROM scored WHERE score > 0)
SELECT item_id, rank, doc_id, score FROM ranked WHERE rank <= 10
"""

# A page's payload; SHA-1 in base 32: four times ten hexadecimal digits are eight of its characters.
DIGITS, BASE32 = "0123456789ABCDEFGHIJKLMNOPQRSTUV", "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"
_QUARTERS = " || ".join(f"to_base(CAST('0x' || substr(h, {at}, 10) AS BIGINT), 32, 8)" for at in (1, 11, 21, 31))

WARC = f"""
WITH p AS (SELECT page_id, coalesce(html, '') AS payload, sha1(coalesce(html, '')) AS h FROM pages),
k AS (SELECT *, max(page_id) OVER (PARTITION BY payload) AS keeper FROM p)
SELECT page_id, CAST(octet_length(encode(payload)) AS BIGINT) AS payload_bytes,
       translate({_QUARTERS}, '{DIGITS}', '{BASE32}') AS payload_digest,
       CASE WHEN page_id = keeper THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id <> keeper THEN keeper END AS refers_to
FROM k
"""

SPACES = "chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"

LINES = f"""
WITH l AS (SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line,
                  unnest(range(1, len(string_split(coalesce(text, ''), chr(10))) + 1)) AS pos FROM documents),
keyed AS (SELECT *, {lowered(f"trim(line, {SPACES})")} AS k FROM l),
gone AS (SELECT k, max(doc_id) AS keeper FROM keyed WHERE length(k) >= 40 GROUP BY k HAVING count(DISTINCT doc_id) >= 5),
marked AS (SELECT keyed.*, gone.k IS NOT NULL AND doc_id <> keeper AS dropped FROM keyed LEFT JOIN gone ON keyed.k = gone.k)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (WHERE dropped) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (WHERE NOT dropped), '')) AS kept_sha256
FROM marked GROUP BY doc_id
"""

WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"

OVERLAPS = f"""
WITH i AS (SELECT item_id, regexp_extract_all({lowered("coalesce(text, '')")}, '{WORD}') AS w FROM benchmark),
d AS (SELECT doc_id, regexp_extract_all({lowered("coalesce(text, '')")}, '{WORD}') AS w FROM documents),
sized AS (SELECT item_id, w, least(len(w), 10) AS k FROM i WHERE len(w) > 0),
windows AS (SELECT DISTINCT item_id, k, array_to_string(list_slice(w, o, o + k - 1), ' ') AS t
            FROM (SELECT *, unnest(range(1, len(w) - k + 2)) AS o FROM sized)),
places AS (SELECT doc_id, k, o, array_to_string(list_slice(w, o, o + k - 1), ' ') AS t
           FROM (SELECT doc_id, w, k, unnest(range(1, len(w) - k + 2)) AS o FROM d, (SELECT DISTINCT k FROM sized) WHERE len(w) >= k)),
found AS (SELECT doc_id, o, k, item_id FROM places JOIN windows USING (k, t)),
hit AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(range(o, o + k)) AS p FROM found) GROUP BY doc_id),
met AS (SELECT doc_id, count(DISTINCT item_id) AS n_items,
               array_to_string(list_sort(list(DISTINCT CAST(item_id AS VARCHAR))), ',') AS items FROM found GROUP BY doc_id)
SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN hit USING (doc_id) LEFT JOIN met USING (doc_id)
"""

TOPK = """
WITH v AS (SELECT vec_id, [floor(256 * CAST(x AS DOUBLE)) for x in embedding] AS q FROM embeddings
           WHERE embedding IS NOT NULL AND len([x for x in embedding if x IS NULL OR NOT isfinite(x)]) = 0),
s AS (SELECT a.vec_id AS query_id, b.vec_id, CAST(list_dot_product(a.q, b.q) AS BIGINT) AS score
      FROM v a JOIN v b ON a.vec_id <> b.vec_id WHERE a.vec_id % 50 = 0),
r AS (SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank, vec_id, score FROM s)
SELECT * FROM r WHERE rank <= 5
"""


def near(k: int, num: int, more: str = "") -> str:
    """Shingle sets of ``k`` words, links at ``num`` of 100, and their components."""
    word = r"[^\x20\x09-\x0D]+"
    return f"""
WITH RECURSIVE d AS (SELECT doc_id, regexp_extract_all({lowered("coalesce(text, '')")}, '{word}') AS w FROM documents),
sh AS (SELECT DISTINCT doc_id, array_to_string(list_slice(w, o, o + {k - 1}), ' ') AS t
       FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - {k - 1}, 1) + 1)) AS o FROM d WHERE len(w) > 0)),
n AS (SELECT doc_id, count(*) AS n FROM sh GROUP BY doc_id),
both_ AS (SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS c FROM sh a JOIN sh b ON a.t = b.t AND a.doc_id < b.doc_id GROUP BY 1, 2),
link AS (SELECT x, y FROM both_ JOIN n p ON p.doc_id = x JOIN n q ON q.doc_id = y WHERE 100 * c >= {num} * (p.n + q.n - c)),
edge AS (SELECT x, y FROM link UNION ALL SELECT y, x FROM link),
reach AS (SELECT doc_id AS x, doc_id AS y FROM n UNION SELECT r.x, e.y FROM reach r JOIN edge e ON r.y = e.x),
comp AS (SELECT x AS doc_id, min(y) AS c FROM reach GROUP BY x)
SELECT d.doc_id, coalesce(n.n, 0) AS n_shingles, coalesce(c, d.doc_id) AS component_id{more}
FROM d LEFT JOIN n USING (doc_id) LEFT JOIN comp USING (doc_id)
"""


ORACLE_SQL = {
    "op3_warc": WARC,
    "op4_jaccard": near(3, 90),
    "op8_linededup": LINES,
    "op9_decontam": OVERLAPS,
    "op10_topk": TOPK,
    "op12_setsketch": near(2, 80, ", coalesce(c, d.doc_id) = d.doc_id AS kept"),
    "op13_lexical": LEXICAL,
}
