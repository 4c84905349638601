"""DuckDB SQL of the operators that SQL can express."""

from __future__ import annotations

from lumenfold.llm import words as W
from lumenfold.llm.simhash import TERM_BITS

#: RE2 class of :data:`words.ALNUM` words in lower-cased text.
WORD = r"[a-z0-9\x{80}-\x{10FFFF}]+"


def _sketch(pairs: bool) -> str:
    """CTEs up to ``own(doc_id, fp[, fp2])`` with UBIGINT fingerprints."""

    def bits(name: str, terms: str) -> str:
        each = ", ".join(f"sum(CASE WHEN (vote >> {b}) & 1 = 1 THEN weight ELSE -weight END) AS b{b}" for b in range(64))
        whole = " + ".join(f"(CASE WHEN b{b} > 0 THEN {1 << b}::HUGEINT ELSE 0 END)" for b in range(64))
        return f"""
{name}_tf AS (SELECT doc_id, t, 1 + floor(log2(count(*)))::INT AS weight FROM (SELECT doc_id, h >> {64 - TERM_BITS} AS t FROM {terms}) GROUP BY ALL),
{name}_bits AS (SELECT doc_id, {each} FROM (SELECT doc_id, weight, {W.mix_sql("t")} AS vote FROM {name}_tf) GROUP BY doc_id),
{name} AS (SELECT doc_id, ({whole})::UBIGINT AS fp FROM {name}_bits)"""

    sql = f"""
seq AS MATERIALIZED (SELECT doc_id, regexp_extract_all(lower(text), '{WORD}') AS l FROM documents),
pos AS (SELECT doc_id, i, l[i] AS w FROM (SELECT doc_id, l, unnest(range(1, len(l) + 1)) AS i FROM seq)),
vocab AS MATERIALIZED (SELECT w, {W.hash_sql("w")} AS h FROM (SELECT DISTINCT w FROM pos)),
uni AS MATERIALIZED (SELECT doc_id, i, h FROM pos JOIN vocab USING (w)),{bits("one", "uni")}"""
    if pairs:
        two = W.combine_sql(["x.h", "y.h"], 2)
        sql += f""",
bi AS (SELECT x.doc_id, {two} AS h FROM uni x JOIN uni y ON x.doc_id = y.doc_id AND y.i = x.i + 1),{bits("two", "bi")},
own AS MATERIALIZED (SELECT doc_id, coalesce(one.fp, 0::UBIGINT) AS fp, coalesce(two.fp, 0::UBIGINT) AS fp2 FROM (SELECT doc_id FROM documents WHERE text IS NOT NULL) LEFT JOIN one USING (doc_id) LEFT JOIN two USING (doc_id))"""
    else:
        sql += ",\nown AS MATERIALIZED (SELECT doc_id, fp FROM documents LEFT JOIN one USING (doc_id))"
    return sql


def _signed(x: str) -> str:
    return f"(CASE WHEN {x} >= {1 << 63}::UBIGINT THEN ({x})::HUGEINT - {1 << 64}::HUGEINT ELSE ({x})::HUGEINT END)::BIGINT"


def op3(radius: int = 3) -> str:
    return f"""WITH RECURSIVE {_sketch(False)},
fps AS MATERIALIZED (SELECT fp, count(*) AS n FROM own WHERE fp IS NOT NULL GROUP BY fp),
link AS MATERIALIZED (SELECT a.fp AS u, b.fp AS v FROM fps a JOIN fps b ON a.fp <> b.fp AND bit_count(xor(a.fp, b.fp)) <= {radius}),
near AS (SELECT u AS fp, count(*) AS n_near FROM link GROUP BY u),
reach AS (SELECT fp AS u, fp AS v FROM fps UNION SELECT r.u, l.v FROM reach r JOIN link l ON l.u = r.v),
class AS (SELECT u AS fp, min({_signed("v")}) AS class_id FROM reach GROUP BY u)
SELECT doc_id, {_signed("own.fp")} AS fingerprint, coalesce(n, 0)::BIGINT AS n_same, coalesce(n_near, 0)::BIGINT AS n_near, class_id
FROM own LEFT JOIN fps USING (fp) LEFT JOIN near USING (fp) LEFT JOIN class USING (fp)"""


def op10(radius: int = 7, radius2: int = 14) -> str:
    return f"""WITH RECURSIVE {_sketch(True)},
link AS MATERIALIZED (SELECT a.doc_id AS u, b.doc_id AS v FROM own a JOIN own b ON a.doc_id <> b.doc_id AND bit_count(xor(a.fp, b.fp)) <= {radius} AND bit_count(xor(a.fp2, b.fp2)) <= {radius2}),
reach AS (SELECT doc_id AS u, doc_id AS v FROM documents UNION SELECT r.u, l.v FROM reach r JOIN link l ON l.u = r.v)
SELECT u AS doc_id, min(v) AS group_id, u = min(v) AS keep FROM reach GROUP BY u"""


def op7(window: int = 50) -> str:
    return f"""WITH seq AS (SELECT DISTINCT doc_id, text, regexp_extract_all(text, '[^\\t\\n\\x0B\\f\\r ]+') AS l FROM documents WHERE doc_id IS NOT NULL AND text IS NOT NULL),
win AS (SELECT doc_id, i, md5(array_to_string(l[i:i + {window - 1}], ' ')) AS k FROM (SELECT doc_id, l, unnest(range(1, len(l) - {window - 2})) AS i FROM seq WHERE len(l) >= {window})),
rep AS (SELECT doc_id, i, row_number() OVER (PARTITION BY k ORDER BY doc_id, i) > 1 AS removed FROM win QUALIFY count(*) OVER (PARTITION BY k) > 1),
isl AS (SELECT *, CASE WHEN i - lag(i) OVER w <= {window} THEN 0 ELSE 1 END AS new FROM rep WINDOW w AS (PARTITION BY doc_id, removed ORDER BY i)),
grp AS (SELECT *, sum(new) OVER (PARTITION BY doc_id, removed ORDER BY i) AS part FROM isl)
SELECT doc_id, (min(i) - 1)::INT AS start_word, (max(i) - 1 + {window})::INT AS end_word, removed FROM grp GROUP BY doc_id, removed, part"""


def op9(window: int = 3) -> str:
    return f"""WITH line AS (SELECT doc_id, k, l[k] AS line FROM (SELECT doc_id, l, unnest(range(1, len(l) + 1)) AS k FROM (SELECT doc_id, string_split(text, chr(10)) AS l FROM documents))),
own AS (SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY k) AS i FROM line WHERE line <> ''),
win AS (SELECT doc_id, i, list(line) OVER w AS l FROM own WINDOW w AS (PARTITION BY doc_id ORDER BY i ROWS BETWEEN CURRENT ROW AND {window - 1} FOLLOWING)),
later AS (SELECT doc_id, i FROM (SELECT doc_id, i, row_number() OVER (PARTITION BY l ORDER BY doc_id, i) AS n FROM win WHERE len(l) = {window}) WHERE n > 1),
gone AS (SELECT DISTINCT o.doc_id, o.k FROM own o JOIN later x ON x.doc_id = o.doc_id AND o.i BETWEEN x.i AND x.i + {window - 1}),
kept AS (SELECT doc_id, string_agg(line, chr(10) ORDER BY k) AS text FROM line l WHERE NOT EXISTS (SELECT 1 FROM gone g WHERE g.doc_id = l.doc_id AND g.k = l.k) GROUP BY doc_id),
n AS (SELECT doc_id, count(*) AS n FROM gone GROUP BY doc_id)
SELECT d.doc_id, CASE WHEN d.text IS NULL THEN NULL ELSE coalesce(kept.text, '') END AS text, coalesce(n.n, 0)::INT AS n_removed FROM documents d LEFT JOIN kept USING (doc_id) LEFT JOIN n USING (doc_id)"""


def op2(threshold: float, smoothing: float, pair_smoothing: float, buckets: int, pair_buckets: int, prefixes: tuple[int, ...]) -> str:
    more = " ".join(f"UNION ALL SELECT doc_id, ({W.combine_sql([f'h{k}'], k)} & {buckets - 1}::UBIGINT)::INT AS b FROM uni WHERE h{k} IS NOT NULL" for k in prefixes)
    short = ", ".join(f"CASE WHEN octet_length(encode(w)) > {k} THEN {W.hash_sql('w', k)} END AS h{k}" for k in prefixes)
    names = ", ".join(f"h{k}" for k in prefixes)
    return f"""WITH seq AS MATERIALIZED (SELECT doc_id, regexp_extract_all(text, '[A-Za-z0-9\\x{{80}}-\\x{{10FFFF}}]+|[^A-Za-z0-9\\x{{80}}-\\x{{10FFFF}}\\t\\n\\x0B\\f\\r ]+') AS l FROM documents),
pos AS (SELECT doc_id, i, l[i] AS w FROM (SELECT doc_id, l, unnest(range(1, len(l) + 1)) AS i FROM seq)),
vocab AS MATERIALIZED (SELECT w, {W.hash_sql("w")} AS h, {short} FROM (SELECT DISTINCT w FROM pos)),
uni AS MATERIALIZED (SELECT doc_id, i, h, {names} FROM pos JOIN vocab USING (w)),
two AS (SELECT x.doc_id, x.h AS h, y.h AS o FROM uni x JOIN uni y ON x.doc_id = y.doc_id AND y.i = x.i + 1),
pair AS MATERIALIZED (SELECT h, o, {buckets} + ({W.combine_sql(["h", "o"], 2)} & {pair_buckets - 1}::UBIGINT)::INT AS b FROM (SELECT DISTINCT h, o FROM two)),
gram AS MATERIALIZED (SELECT doc_id, (h & {buckets - 1}::UBIGINT)::INT AS b FROM uni {more} UNION ALL SELECT doc_id, b FROM two JOIN pair USING (h, o)),
good AS (SELECT doc_id FROM labels WHERE doc_id IS NOT NULL AND quality IS NOT NULL AND toxic IS NOT NULL GROUP BY doc_id HAVING bool_and(quality = 1 AND toxic = 0)),
corpus AS (SELECT b, count(*) AS n, CASE WHEN b < {buckets} THEN {smoothing}::DOUBLE ELSE {pair_smoothing}::DOUBLE END AS s FROM gram GROUP BY b),
target AS (SELECT b, count(*) AS n FROM gram SEMI JOIN good USING (doc_id) GROUP BY b),
ratio AS (SELECT b, ln(coalesce(target.n, 0) + s) - ln(corpus.n * (coalesce((SELECT sum(n) FROM target), 0)::DOUBLE / (SELECT sum(n) FROM corpus)::DOUBLE) + s) AS r FROM corpus LEFT JOIN target USING (b)),
score AS (SELECT doc_id, round(avg(r), 6) + 0.0 AS score FROM gram JOIN ratio USING (b) GROUP BY doc_id)
SELECT doc_id, score::DOUBLE AS score, coalesce(score >= {threshold}::DOUBLE, false) AS keep FROM documents LEFT JOIN score USING (doc_id)"""
