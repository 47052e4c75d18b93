"""SQL of the registered queries, where SQL can express them. The text runs in DuckDB.

Every number in it is written out here, not taken from the operators.
"""

LOWER_AZ = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

OP3 = rf"""
WITH RECURSIVE
w AS (SELECT doc_id, regexp_extract_all({LOWER_AZ.format("coalesce(text, '')")}, '[^\x20\x09-\x0D]+') AS ws
      FROM documents),
s AS (SELECT DISTINCT doc_id, CASE WHEN len(ws) < 5 THEN array_to_string(ws, ' ')
        ELSE array_to_string(ws[i:i + 4], ' ') END AS shingle
      FROM w, unnest(range(1, greatest(len(ws) - 4, 1) + 1)) AS t(i) WHERE len(ws) > 0),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
c AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS common
      FROM s a JOIN s b ON a.shingle = b.shingle AND a.doc_id < b.doc_id GROUP BY ALL),
l AS (SELECT a, b FROM c JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b
      WHERE 100 * common >= 75 * (x.n + y.n - common)),
e AS (SELECT a, b FROM l UNION ALL SELECT b, a FROM l),
r AS (SELECT doc_id, doc_id AS root FROM documents
      UNION SELECT e.b, r.root FROM r JOIN e ON e.a = r.doc_id WHERE r.root < e.b)
SELECT d.doc_id, coalesce(n.n, 0)::BIGINT AS n_shingles, m.root AS component_id, d.doc_id = m.root AS kept
FROM documents d LEFT JOIN n USING (doc_id)
JOIN (SELECT doc_id, min(root) AS root FROM r GROUP BY doc_id) m USING (doc_id)
"""

OP6 = rf"""
WITH
d AS (SELECT doc_id, regexp_extract_all({LOWER_AZ.format("coalesce(text, '')")},
        '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS ws FROM documents),
b AS (SELECT item_id, regexp_extract_all({LOWER_AZ.format("coalesce(text, '')")},
        '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS ws FROM benchmark),
win AS (SELECT DISTINCT item_id, least(len(ws), 10) AS size, array_to_string(ws[i:i + least(len(ws), 10) - 1], ' ') AS win
        FROM b, unnest(range(1, greatest(len(ws) - 9, 1) + 1)) AS t(i) WHERE len(ws) > 0),
sizes AS (SELECT DISTINCT size FROM win),
g AS (SELECT doc_id, i, size, array_to_string(ws[i:i + size - 1], ' ') AS win
      FROM d, sizes, unnest(range(1, len(ws) - size + 2)) AS t(i) WHERE len(ws) >= size),
o AS (SELECT doc_id, i, g.size, item_id FROM g JOIN win USING (size, win)),
h AS (SELECT doc_id, count(DISTINCT k) AS n_hit FROM o, unnest(range(i, i + size)) AS t(k) GROUP BY doc_id),
f AS (SELECT doc_id, count(*) AS n_items, string_agg(item_id::VARCHAR, ',' ORDER BY item_id::VARCHAR) AS ids
      FROM (SELECT DISTINCT doc_id, item_id FROM o) GROUP BY doc_id)
SELECT d.doc_id, len(ws)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit,
  coalesce(n_items, 0)::BIGINT AS n_items, sha256(coalesce(ids, '')) AS items_sha256,
  coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN h USING (doc_id) LEFT JOIN f USING (doc_id)
"""

OP11 = rf"""
WITH
d AS (SELECT doc_id, {LOWER_AZ.format("unnest(regexp_extract_all(coalesce(text, ''), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+'))")} AS term
      FROM documents),
tf AS (SELECT doc_id, term, count(*) AS tf FROM d GROUP BY ALL),
n AS (SELECT doc_id, count(*) AS n FROM d GROUP BY ALL),
s AS (SELECT count(*) AS docs, sum(n)::BIGINT AS terms FROM n),
b AS (SELECT DISTINCT item_id, {LOWER_AZ.format("unnest(regexp_extract_all(coalesce(text, ''), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+'))")} AS term
      FROM benchmark),
w AS (SELECT term, floor(1000 * ln((2 * docs + 2)::DOUBLE / (2 * count(*) + 1)::DOUBLE))::BIGINT AS w
      FROM tf, s WHERE term IN (SELECT term FROM b) GROUP BY term, docs),
m AS (SELECT doc_id, 100 - 50 + ((50 * n * docs) // terms) AS m FROM n, s),
r AS (SELECT item_id, doc_id, sum(w * ((1000000000 * tf) // (1000 * tf + 20 * m)))::BIGINT AS score
      FROM b JOIN w USING (term) JOIN tf USING (term) JOIN m USING (doc_id) GROUP BY ALL)
SELECT item_id, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id)::INTEGER AS rank, doc_id, score
FROM r WHERE score > 0
QUALIFY rank <= 50
"""


def all_oracles() -> dict[str, str]:
    return {"op3_minhash": OP3, "op6_decontamination": OP6, "op11_lexical_search": OP11}
