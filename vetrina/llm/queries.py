"""The registered queries of the corpus operators and their SQL twins."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vetrina.llm import bpe, decontamination, exact_dedup, jaccard, language_id, line_dedup, phrases, pii, quality, resampling, secrets, sharding, url_filter
from vetrina.llm.common import table

Query = Callable[[SparkSession, str], DataFrame]


def vocabulary(name: str = "word_bpe_49k.json") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language_id.digest(table(spark, sf_dir, "documents"))


def op2_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.digest(table(spark, sf_dir, "documents"))


def op3_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.digest(table(spark, sf_dir, "documents"))


def op4_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.classes(table(spark, sf_dir, "documents"))


def op5_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.digests(table(spark, sf_dir, "documents"), vocabulary())


def op6_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The outcomes are the labels whose doc_id is a page's id: bad is low quality or toxic."""
    pages = table(spark, sf_dir, "pages").select("page_id", "url")
    labels = table(spark, sf_dir, "labels").select(F.col("doc_id").alias("page_id"), ((F.col("quality") == 0) | (F.col("toxic") == 1)).alias("bad"))
    return url_filter.judge(pages, pages.join(labels, "page_id").select("url", "bad"))


def op7_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontamination.report(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op8_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.judge(table(spark, sf_dir, "documents"))


def op9_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_dedup.digest(table(spark, sf_dir, "documents"))


def op10_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.digest(table(spark, sf_dir, "documents"))


def op11_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return resampling.digest(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op12_phrases(spark: SparkSession, sf_dir: str) -> DataFrame:
    return phrases.collocations(table(spark, sf_dir, "documents"))


def op13_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.digest(table(spark, sf_dir, "documents"))


def queries() -> dict[str, Query]:
    return {"op1_language": op1_language, "op2_secrets": op2_secrets, "op3_sharding": op3_sharding, "op4_jaccard": op4_jaccard, "op5_bpe": op5_bpe, "op6_url_filter": op6_url_filter, "op7_decontamination": op7_decontamination, "op8_quality": op8_quality, "op9_line_dedup": op9_line_dedup, "op10_pii": op10_pii,
            "op11_resampling": op11_resampling, "op12_phrases": op12_phrases, "op13_exact_dedup": op13_exact_dedup}


def spans_sql(text: str, pattern: str, kind: str, rank: int, keep: str = "true", group: int = 0) -> str:
    """A DuckDB list of {s, k, e, kind} structs; keep is a condition over m, the match's group."""
    quoted = pattern.replace("'", "''")
    between, found, part = f"string_split_regex({text}, '{quoted}')", f"regexp_extract_all({text}, '{quoted}')", f"regexp_extract_all({text}, '{quoted}', {group})"
    upto = lambda xs, n: f"coalesce(list_sum(list_transform(({xs})[1:{n}], lambda z: length(z))), 0)"
    return (f"list_transform(list_filter(list_transform(generate_series(1, len({found})), lambda i: {{'s': ({upto(between, 'i')} + {upto(found, 'i - 1')})::BIGINT, 'k': {rank}, "
            f"'e': ({upto(between, 'i')} + {upto(found, 'i')})::BIGINT, 'kind': '{kind}', 'm': ({part})[i]}}), lambda x: {keep.replace('m', 'x.m', 1) if keep != 'true' else keep}), "
            "lambda x: {'s': x.s, 'k': x.k, 'e': x.e, 'kind': x.kind})")


def joined_sql(spans: str) -> str:
    return f"coalesce(array_to_string(list_transform({spans}, lambda x: concat_ws(':', x.kind, x.s, x.e)), ','), '')"


_RULES = secrets.BASE + secrets.MORE
OP2_SQL = (
    "WITH d AS (SELECT doc_id, coalesce(text, '') AS t FROM documents), r AS (SELECT doc_id, "
    + ", ".join(f"{spans_sql('t', r.pattern, r.kind, k, f'length(m) >= {r.least}' if r.least else 'true', r.group)} AS r{k}" for k, r in enumerate(_RULES))
    + " FROM d), a AS (SELECT *, list_sort(flatten([" + ", ".join(f"r{k}" for k in range(len(_RULES))) + "])) AS every FROM r) SELECT doc_id, len(r0)::BIGINT AS n_assign, len(r1)::BIGINT AS n_access, len(r2)::BIGINT AS n_hex, "
    + "sha256(" + joined_sql("list_filter(every, lambda x: x.k < 3)") + ") AS base_sha256, " + joined_sql("every") + " AS spans FROM a"
)

OP8_SQL = r"""
WITH d AS (
  SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS t, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS ws FROM documents),
w AS (SELECT r, generate_subscripts(ws, 1) AS i, unnest(ws) AS w FROM d),
g AS (
  SELECT r, i, CASE WHEN lead(w, 4) OVER o IS NOT NULL THEN concat_ws(' ', w, lead(w, 1) OVER o, lead(w, 2) OVER o, lead(w, 3) OVER o, lead(w, 4) OVER o) END AS g
  FROM w WINDOW o AS (PARTITION BY r ORDER BY i)),
rep AS (SELECT r, i FROM (SELECT r, i, count(*) OVER (PARTITION BY r, g) AS n FROM g WHERE g IS NOT NULL) WHERE n >= 2),
cov AS (SELECT r, count(DISTINCT i + k) AS n FROM rep, (SELECT unnest(range(5)) AS k) GROUP BY r),
l AS (SELECT r, unnest(string_split(t, chr(10))) AS line FROM d),
ln AS (SELECT r, count(*) AS n_lines, count(*) - count(DISTINCT line) AS dup FROM l WHERE regexp_matches(line, '[^\x20\x09-\x0D]') GROUP BY r),
m AS (
  SELECT doc_id, len(ws)::BIGINT AS n_words, length(array_to_string(ws, ''))::BIGINT AS word_chars,
    (length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')))::BIGINT AS n_symbols, coalesce(dup, 0)::BIGINT AS n_dup_lines,
    coalesce(cov.n, 0)::BIGINT AS n_repeat_words, coalesce(n_lines, 0) AS n_lines, length(t) - length(regexp_replace(t, '[A-Z]', '', 'g')) AS n_upper
  FROM d LEFT JOIN cov USING (r) LEFT JOIN ln USING (r)),
k AS (
  SELECT *, ((n_words < 10)::INT + 2 * (100 * n_repeat_words > 20 * n_words)::INT + 4 * (100 * n_symbols > 30 * n_words)::INT
    + 8 * (100 * n_dup_lines > 50 * n_lines)::INT + 16 * (100 * n_upper > 60 * word_chars)::INT + 32 * (word_chars > 40 * n_words)::INT)::BIGINT AS mask
  FROM m)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, (mask & 3) <> 0 AS base_failed, mask = 0 AS kept, mask FROM k
"""


OP9_SQL = r"""
WITH d AS (SELECT DISTINCT doc_id, text, string_split(text, chr(10)) AS ls FROM documents WHERE text IS NOT NULL),
x AS (SELECT doc_id, text, unnest(ls) AS line, generate_subscripts(ls, 1) - 1 AS pl FROM d),
l AS (SELECT *, row_number() OVER (PARTITION BY doc_id, text ORDER BY pl) AS i, len(regexp_extract_all(line, '[^\x20\x09-\x0D]+')) AS w FROM x WHERE regexp_matches(line, '[^\x20\x09-\x0D]')),
a AS (SELECT doc_id, text, list(line ORDER BY i) AS ls, list(pl ORDER BY i) AS pls, list(w ORDER BY i) AS ws FROM l GROUP BY doc_id, text),
p AS (SELECT *, unnest(range(1, len(ls) + 1)) AS s FROM a),
f AS (SELECT *, list_first(list_filter(range(1, least(50, len(ws) - s + 1) + 1), lambda n: list_sum(ws[s:s + n - 1]) >= 50)) AS fw,
  list_first(list_filter(range(1, least(50, s) + 1), lambda n: list_sum(ws[s - n + 1:s]) >= 50)) AS bw FROM p),
r AS (
  SELECT doc_id, text, pls, s, fw AS n, array_to_string(ls[s:s + fw - 1], chr(10)) AS run FROM f WHERE fw IS NOT NULL
  UNION SELECT doc_id, text, pls, s - bw + 1, bw, array_to_string(ls[s - bw + 1:s], chr(10)) FROM f WHERE bw IS NOT NULL),
k AS (SELECT *, min(doc_id) OVER (PARTITION BY run) AS fd, min({'d': doc_id, 's': s}) OVER (PARTITION BY run) AS fs FROM r),
c AS (SELECT DISTINCT doc_id, text, unnest(pls[s:s + n - 1]) AS pl FROM k WHERE doc_id <> fs.d OR s <> fs.s),
g AS (SELECT doc_id, text, list(pl ORDER BY pl) AS removed FROM c GROUP BY doc_id, text),
o AS (SELECT documents.doc_id, documents.text, string_split(documents.text, chr(10)) AS ls, coalesce(removed, []) AS removed FROM documents LEFT JOIN g ON g.doc_id = documents.doc_id AND g.text = documents.text)
SELECT doc_id, coalesce(len(ls), 0)::BIGINT AS n_lines, len(removed)::BIGINT AS n_removed, coalesce(array_to_string(removed, ','), '') AS removed,
  sha256(coalesce(array_to_string(list_transform(list_filter(range(0, len(ls)), lambda i: NOT list_contains(removed, i)), lambda i: ls[i + 1]), chr(10)), '')) AS text_sha256
FROM o
"""


def _strength_sql(groups: str) -> str:
    return (f"(SELECT CASE WHEN b > 0 THEN greatest(1.0, least(1000.0, (p * (1 - p) - s) / b)) ELSE 1000.0 END FROM (SELECT p, s, s - p * (1 - p) * m / tn AS b FROM ("
            f"SELECT tb / tn AS p, (sq - tb * tb / tn) / tn AS s, m, tn FROM (SELECT sum(n)::DOUBLE AS tn, sum(bad)::DOUBLE AS tb, count(*) AS m, sum((bad * bad / n)::DECIMAL(38, 9))::DOUBLE AS sq FROM {groups} WHERE n > 0))))")


OP4_SQL = r"""
WITH RECURSIVE d AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS ws FROM documents),
s AS (SELECT DISTINCT doc_id, array_to_string(ws[p:p + 4], ' ') AS g FROM (SELECT doc_id, ws, unnest(range(1, greatest(1, len(ws) - 4) + 1)) AS p FROM d WHERE len(ws) > 0)),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
i AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS n FROM s a JOIN s b USING (g) WHERE a.doc_id <> b.doc_id GROUP BY 1, 2),
e AS (SELECT a, b FROM i JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * i.n >= 80 * (x.n + y.n - i.n)),
r AS (SELECT doc_id, doc_id AS c FROM d UNION SELECT e.b, r.c FROM r JOIN e ON e.a = r.doc_id)
SELECT d.doc_id, coalesce(n.n, 0)::BIGINT AS n_shingles, c AS component_id FROM d LEFT JOIN n USING (doc_id) JOIN (SELECT doc_id, min(c) AS c FROM r GROUP BY doc_id) m ON m.doc_id = d.doc_id
"""

OP6_SQL = rf"""
WITH p AS (
  SELECT page_id, CASE WHEN contains(coalesce(url, ''), '://') THEN translate(regexp_extract(url, '(?s)^.*?://([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') ELSE '' END AS host,
    CASE WHEN contains(coalesce(url, ''), '://') THEN regexp_extract(url, '(?s)^.*?://[^/?#]*([^?#]*)', 1) ELSE '' END AS path FROM pages),
o AS (SELECT host, (quality = 0 OR toxic = 1) AS bad FROM p JOIN labels ON doc_id = page_id),
h AS (SELECT host, regexp_extract(host, '(?:^|\.)((?:[^.]*\.)?{url_filter.SUFFIX})\z', 1) AS domain, regexp_extract(host, '(?:^|\.)({url_filter.SUFFIX})\z', 1) AS suffix, count(bad) AS n, coalesce(sum(bad::INT), 0)::BIGINT AS bad
  FROM (SELECT host, NULL::BOOLEAN AS bad FROM p UNION ALL SELECT * FROM o) GROUP BY host),
d AS (SELECT domain, suffix, sum(n)::BIGINT AS n, sum(bad)::BIGINT AS bad FROM h GROUP BY domain, suffix),
s AS (SELECT suffix, sum(n)::BIGINT AS n, sum(bad)::BIGINT AS bad FROM h GROUP BY suffix),
k AS (SELECT {_strength_sql('s')} AS ks, {_strength_sql('d')} AS kd, {_strength_sql('h')} AS kh, (SELECT sum(bad) / nullif(sum(n), 0) FROM h) AS p0),
sp AS (SELECT suffix, (ks * p0 + bad) / (ks + n) AS ps FROM s, k),
dp AS (SELECT domain, (kd * ps + bad) / (kd + n) AS pd FROM d JOIN sp USING (suffix), k),
hp AS (SELECT host, (kh * pd + bad) / (kh + n) AS m, kh + n AS t FROM h JOIN dp USING (domain), k),
r AS (SELECT p.*, m - sqrt(m * (1 - m) / (t + 1)) > 0.35 AS blocked,
  CASE WHEN (host = 'www.example.com' OR ends_with(host, '.www.example.com')) AND starts_with(path, '/en/') THEN 'www.example.com/en/'
    WHEN (host = 'example.com' OR ends_with(host, '.example.com')) AND starts_with(path, '/en/') THEN 'example.com/en/'
    WHEN (host = 'net' OR ends_with(host, '.net')) AND starts_with(path, '/es/') THEN 'net/es/'
    WHEN (host = 'net' OR ends_with(host, '.net')) AND starts_with(path, '/fr/') THEN 'net/fr/'
    WHEN (host = 'com' OR ends_with(host, '.com')) AND starts_with(path, '/') THEN 'com/' END AS rule
  FROM p JOIN hp USING (host))
SELECT page_id, host, path, rule, CASE WHEN rule IN ('com/', 'www.example.com/en/') THEN 'allow' WHEN rule IS NOT NULL THEN 'block' WHEN blocked THEN 'block' ELSE 'allow' END AS verdict FROM r
"""

OP7_SQL = r"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS ws FROM documents),
i AS (SELECT item_id::VARCHAR AS item, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS ws FROM benchmark),
iw AS (SELECT DISTINCT item, ws[p:p + 12] AS w FROM (SELECT item, ws, unnest(range(1, greatest(1, len(ws) - 12) + 1)) AS p FROM i WHERE len(ws) > 0)),
sizes AS (SELECT DISTINCT len(w) AS n FROM iw),
dg AS (SELECT r, p, n, ws[p:p + n - 1] AS w FROM (SELECT r, n, ws, unnest(range(1, len(ws) - n + 2)) AS p FROM d, sizes WHERE len(ws) >= n)),
hit AS (SELECT r, p, dg.n, item FROM dg JOIN iw USING (w)),
cov AS (SELECT r, count(DISTINCT q) AS n_hit FROM (SELECT r, unnest(range(p, p + n)) AS q FROM hit) GROUP BY r),
its AS (SELECT r, count(*) AS n_items, array_to_string(list(item ORDER BY item), ',') AS items FROM (SELECT DISTINCT r, item FROM hit) GROUP BY r),
dw AS (SELECT r, unnest(ws) AS term, generate_subscripts(ws, 1) AS pos FROM d),
tf AS (SELECT term, count(*) AS n FROM dw GROUP BY term),
ww AS (SELECT w, unnest(w) AS term, generate_subscripts(w, 1) AS off FROM (SELECT DISTINCT w FROM iw)),
an AS (SELECT * FROM (SELECT w, term, off, row_number() OVER (PARTITION BY w ORDER BY coalesce(n, 0), off) AS k FROM ww LEFT JOIN tf USING (term)) WHERE k <= 2),
po AS (SELECT DISTINCT r, w, k, pos - off AS s FROM dw JOIN an USING (term)),
nr AS (SELECT r, count(DISTINCT a.w) AS n_near FROM po a JOIN po b USING (r, w) WHERE a.k = 1 AND b.k = 2 AND abs(a.s - b.s) BETWEEN 1 AND 3 GROUP BY r)
SELECT doc_id, len(ws)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items, sha256(coalesce(items, '')) AS items_sha256,
  coalesce(n_near, 0)::BIGINT AS n_near, coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(ws) AS contaminated
FROM d LEFT JOIN cov USING (r) LEFT JOIN its USING (r) LEFT JOIN nr USING (r)
"""


OP12_SQL = r"""
WITH d AS (SELECT coalesce(lang, 'und') AS lang, string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]') AS pieces FROM documents),
p AS (SELECT lang, unnest(pieces) AS piece FROM d),
w AS (SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS ws FROM p),
t AS (SELECT lang, sum(len(ws))::BIGINT AS n FROM w GROUP BY lang),
s AS (SELECT lang, ws, unnest(range(1, len(ws) + 1)) AS i FROM w WHERE len(ws) > 0),
g AS (SELECT lang, k, array_to_string(ws[i:i + k - 1], ' ') AS phrase FROM (SELECT lang, ws, i, unnest(range(1, least(5, len(ws) - i + 1) + 1)) AS k FROM s)),
f AS (SELECT lang, k, phrase, count(*) AS f FROM g GROUP BY lang, k, phrase HAVING count(*) >= 100),
c AS (SELECT lang, k, phrase, f, string_split(phrase, ' ') AS ws FROM f WHERE k >= 2),
x AS (SELECT lang, unnest([array_to_string(ws[1:k - 1], ' '), array_to_string(ws[2:k], ' ')]) AS phrase, f FROM c WHERE k > 2),
gone AS (SELECT DISTINCT c.lang, c.phrase FROM c JOIN x ON x.lang = c.lang AND x.phrase = c.phrase WHERE x.f >= c.f),
u AS (SELECT c.lang, c.phrase, ws, c.f AS a, unnest(range(1, k)) AS cut FROM c LEFT JOIN gone ON gone.lang = c.lang AND gone.phrase = c.phrase WHERE gone.phrase IS NULL),
v AS (
  SELECT u.lang, u.phrase, a, cut, l.f AS l, r.f AS r, n, ((1000::HUGEINT * a::HUGEINT * n::HUGEINT) // (l.f::HUGEINT * r.f::HUGEINT))::BIGINT AS score
  FROM u JOIN f l ON l.lang = u.lang AND l.phrase = array_to_string(ws[1:cut], ' ') JOIN f r ON r.lang = u.lang AND r.phrase = array_to_string(ws[cut + 1:len(ws)], ' ') JOIN t ON t.lang = u.lang),
b AS (SELECT *, row_number() OVER (PARTITION BY lang, phrase ORDER BY score, cut) AS i FROM v),
o AS (SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank, phrase, a, l, r, n, score FROM b WHERE i = 1)
SELECT lang, rank, phrase, a, l, r, n, score FROM o WHERE rank <= 2000
"""

OP13_SQL = """
WITH d AS (SELECT doc_id, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS t FROM documents),
g AS (SELECT t, max(doc_id) AS keep_id, count(*) AS group_size FROM d GROUP BY t)
SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, sha256(d.t) AS text_sha256 FROM d JOIN g ON g.t = d.t
"""


def oracle_sql() -> dict[str, str]:
    return {"op2_secrets": OP2_SQL, "op4_jaccard": OP4_SQL, "op6_url_filter": OP6_SQL, "op7_decontamination": OP7_SQL, "op8_quality": OP8_SQL, "op9_line_dedup": OP9_SQL,
            "op12_phrases": OP12_SQL, "op13_exact_dedup": OP13_SQL}
