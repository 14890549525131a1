"""Registered queries of the training-data operators, and their SQL where SQL can say it."""

from __future__ import annotations

from rillet.llm.common import tables
from rillet.llm.exact_dedup import exact_groups
from rillet.llm.lexical_search import search
from rillet.llm.minhash import near_groups
from rillet.llm.mixing import mix_table
from rillet.llm.packing import pack_table
from rillet.llm.pii_tagger import pii_table
from rillet.llm.quality_gam import quality_scores
from rillet.llm.quality_rules import quality_table
from rillet.llm.sharding import shard_table
from rillet.llm.spelling_variants import variant_table
from rillet.llm.suffix_dedup import repeat_table
from rillet.llm.token_counts import token_table
from rillet.llm.url_filter import url_verdicts


def op1_url_filters(spark, d):
    return url_verdicts(tables(spark, d, "pages"))


def op2_token_counts(spark, d):
    return token_table(tables(spark, d, "documents"))


def op3_sharding(spark, d):
    return shard_table(tables(spark, d, "documents"), 24)


def op4_suffix_dedup(spark, d):
    return repeat_table(tables(spark, d, "documents"))


def op5_quality_classifier(spark, d):
    return quality_scores(tables(spark, d, "documents"), tables(spark, d, "labels"))


def op6_packing(spark, d):
    return pack_table(tables(spark, d, "documents"))


def op7_exact_dedup(spark, d):
    return exact_groups(tables(spark, d, "documents"))


def op8_mixing(spark, d):
    return mix_table(tables(spark, d, "documents"))


def op9_quality_rules(spark, d):
    return quality_table(tables(spark, d, "documents"), tables(spark, d, "labels"))


def op10_minhash(spark, d):
    return near_groups(tables(spark, d, "documents"))


def op11_lexical_search(spark, d):
    return search(tables(spark, d, "documents"), tables(spark, d, "benchmark"))


def op12_pii_tagger(spark, d):
    return pii_table(tables(spark, d, "documents"))


def op13_spelling_variants(spark, d):
    return variant_table(tables(spark, d, "documents"))


QUERIES = {f.__name__: f for f in (op1_url_filters, op2_token_counts, op3_sharding, op4_suffix_dedup, op5_quality_classifier, op6_packing, op7_exact_dedup, op8_mixing, op9_quality_rules, op10_minhash,
                                   op11_lexical_search, op12_pii_tagger, op13_spelling_variants)}

LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

WORD = r"[^\x20\x09-\x0D]+"
TERM = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"

ORACLE_SQL = {
    "op7_exact_dedup": f"""
WITH d AS (SELECT doc_id, {LOWER} AS t FROM documents),
g AS (SELECT t, max(doc_id) AS keep_id, count(*) AS group_size FROM d GROUP BY t)
SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, sha256(t) AS text_sha256
FROM d JOIN g USING (t)""",
    "op11_lexical_search": f"""
WITH words AS (SELECT doc_id, unnest(regexp_extract_all({LOWER}, '{TERM}')) AS term FROM documents),
tf AS (SELECT doc_id, term, CAST(count(*) AS BIGINT) AS tf FROM words GROUP BY doc_id, term),
size AS (SELECT doc_id, CAST(sum(tf) AS BIGINT) AS terms FROM tf GROUP BY doc_id),
corpus AS (SELECT CAST(count(*) AS BIGINT) AS docs, CAST(sum(terms) AS BIGINT) AS total FROM size),
df AS (SELECT term, count(*) AS df FROM tf GROUP BY term),
w AS (SELECT term, CAST(floor(1000 * ln((2.0::DOUBLE * docs + 2) / (2 * df + 1))) AS BIGINT) AS w FROM df, corpus),
m AS (SELECT doc_id, 100 - 50 + ((50 * terms * docs) // total) AS m FROM size, corpus),
item AS (SELECT DISTINCT item_id, unnest(regexp_extract_all({LOWER}, '{TERM}')) AS term FROM benchmark),
scored AS (SELECT item_id, doc_id, CAST(sum(w * ((1000000000 * tf) // (1000 * tf + 20 * m))) AS BIGINT) AS score
           FROM item JOIN w USING (term) JOIN tf USING (term) JOIN m USING (doc_id) GROUP BY item_id, doc_id),
ranked AS (SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS rank FROM scored WHERE score > 0)
SELECT item_id, CAST(rank AS INTEGER) AS rank, doc_id, score FROM ranked WHERE rank <= 50""",
    # Every 400-byte string of the hexadecimal texts, in segments of 1,024 positions, told apart by MD5.
    "op4_suffix_dedup": """
WITH d AS (SELECT doc_id, hex(encode(coalesce(text, ''))) AS h, octet_length(encode(coalesce(text, ''))) AS n FROM documents),
seg AS (SELECT doc_id, n, unnest(range(0, greatest(n - 399, 0), 1024)) AS beg, h FROM d),
cut AS (SELECT doc_id, n, beg, substr(h, 2 * beg + 1, 2 * 1423) AS part FROM seg),
pos AS (SELECT doc_id, beg + k AS i, md5(substr(part, 2 * k + 1, 800)) AS s
        FROM (SELECT *, unnest(range(0, least(1024, n - 399 - beg))) AS k FROM cut)),
twice AS (SELECT s FROM pos GROUP BY s HAVING count(*) > 1),
hit AS (SELECT doc_id, i FROM pos SEMI JOIN twice USING (s)),
mark AS (SELECT *, CASE WHEN i <= lag(i) OVER (PARTITION BY doc_id ORDER BY i) + 400 THEN 0 ELSE 1 END AS b FROM hit),
isle AS (SELECT *, sum(b) OVER (PARTITION BY doc_id ORDER BY i) AS k FROM mark),
span AS (SELECT doc_id, min(i) AS a, max(i) + 400 AS e FROM isle GROUP BY doc_id, k),
gap AS (SELECT doc_id, coalesce(lag(e) OVER (PARTITION BY doc_id ORDER BY a), 0) AS a, a AS e FROM span
        UNION ALL SELECT d.doc_id, coalesce(max(span.e), 0), any_value(d.n) FROM d LEFT JOIN span USING (doc_id) GROUP BY d.doc_id),
kept AS (SELECT doc_id, string_agg(substr(h, 2 * a + 1, 2 * (e - a)), '' ORDER BY a) AS h FROM gap JOIN d USING (doc_id) GROUP BY doc_id),
total AS (SELECT doc_id, sum(e - a) AS removed, count(*) AS spans FROM span GROUP BY doc_id)
SELECT doc_id, CAST(n AS BIGINT) AS n_bytes, CAST(coalesce(removed, 0) AS BIGINT) AS n_removed, CAST(coalesce(spans, 0) AS BIGINT) AS n_spans,
       sha256(unhex(kept.h)) AS kept_sha256
FROM d JOIN kept USING (doc_id) LEFT JOIN total USING (doc_id)""",
    "op10_minhash": f"""
WITH RECURSIVE w AS (SELECT doc_id, regexp_extract_all({LOWER}, '{WORD}') AS w FROM documents),
sets AS (SELECT doc_id, CASE WHEN len(w) = 0 THEN [] WHEN len(w) = 1 THEN w
                ELSE list_distinct(list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1])) END AS s FROM w),
items AS (SELECT doc_id, unnest(s) AS x FROM sets),
shared AS (SELECT a.doc_id AS u, b.doc_id AS v, count(*) AS n FROM items a JOIN items b USING (x) WHERE a.doc_id <> b.doc_id GROUP BY u, v),
link AS (SELECT u, v FROM shared JOIN sets p ON p.doc_id = u JOIN sets q ON q.doc_id = v WHERE 100 * n >= 80 * (len(p.s) + len(q.s) - n)),
reach AS (SELECT doc_id, doc_id AS r FROM sets UNION SELECT reach.doc_id, link.v FROM reach JOIN link ON link.u = reach.r),
lowest AS (SELECT doc_id, min(r) AS component_id FROM reach GROUP BY doc_id)
SELECT doc_id, CAST(len(s) AS BIGINT) AS n_shingles, component_id, doc_id = component_id AS kept,
       CASE WHEN len(s) = 0 THEN 1 ELSE count(*) OVER (PARTITION BY list_sort(s)) END AS class_size
FROM sets JOIN lowest USING (doc_id)""",
    # crc32 by its table; near words meet at the string that both are with one position left open or taken out.
    "op13_spelling_variants": f"""
WITH RECURSIVE crc_table AS (SELECT list_transform(range(256), lambda x: list_reduce([x, 0, 0, 0, 0, 0, 0, 0, 0],
        lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END)) AS t),
runs AS (SELECT doc_id, unnest(regexp_extract_all({LOWER}, '[A-Za-zÀ-ÿ]+')) AS run FROM documents),
per AS (SELECT doc_id, run, count(*) AS n, hex(encode(doc_id || ':' || run)) AS h FROM runs WHERE length(run) >= 6 GROUP BY doc_id, run),
crc AS (SELECT run, n, xor(4294967295, list_reduce(list_concat([4294967295], list_transform(range(length(h) // 2),
        lambda i: CAST('0x' || substr(h, 2 * i + 1, 2) AS BIGINT))), lambda c, b: xor(c >> 8, t[(xor(c, b) & 255) + 1]))) AS c FROM per, crc_table),
spelt AS (SELECT CASE WHEN c % 199 = 0 THEN substr(run, 1, c % length(run)) || substr(run, c % length(run) + 2) ELSE run END AS word, n FROM crc),
v AS (SELECT word, CAST(sum(n) AS BIGINT) AS n FROM spelt WHERE length(word) >= 6 GROUP BY word HAVING sum(n) >= 5),
spot AS (SELECT word, n, unnest(range(length(word))) AS i FROM v),
dropped AS (SELECT DISTINCT word, n, substr(word, 1, i) || substr(word, i + 2) AS x FROM spot),
blanked AS (SELECT word, n, substr(word, 1, i) || '_' || substr(word, i + 2) AS x FROM spot),
pairs AS (SELECT a.word, b.word AS near, b.n AS near_n FROM blanked a JOIN blanked b USING (x) WHERE a.word <> b.word
          UNION SELECT v.word, dropped.word, dropped.n FROM v JOIN dropped ON dropped.x = v.word
          UNION SELECT dropped.word, v.word, v.n FROM v JOIN dropped ON dropped.x = v.word),
best AS (SELECT word, count(*) AS n_near, max(near_n) AS m FROM pairs GROUP BY word),
top1 AS (SELECT word, any_value(n_near) AS n_near, any_value(m) AS m, min(near) AS form FROM best JOIN pairs USING (word) WHERE near_n = m GROUP BY word),
forms AS (SELECT v.word, v.n, coalesce(n_near, 0) AS n_near, CASE WHEN m >= 5 * v.n THEN form END AS form, CASE WHEN m >= 5 * v.n THEN m END AS form_n
          FROM v LEFT JOIN top1 USING (word)),
walk AS (SELECT word, word AS here, 0 AS step FROM forms UNION ALL
         SELECT walk.word, forms.form, step + 1 FROM walk JOIN forms ON forms.word = walk.here WHERE forms.form IS NOT NULL),
ends AS (SELECT word, arg_max(here, step) AS root FROM walk GROUP BY word)
SELECT word, form, root, n, n_near, form_n FROM forms JOIN ends USING (word)""",
}
