"""The same results as plain SQL over the given tables, for the operators SQL can express."""

from __future__ import annotations

import math

from talmir.llm.licenses import NEEDED, PHRASES, TEMPLATES, THRESHOLD, families

WARC = """WITH p AS (
  SELECT page_id, coalesce(html, '') AS html, sha1(encode(coalesce(html, ''))) AS h FROM pages),
q AS (SELECT *, max(page_id) OVER (PARTITION BY html) AS last FROM p)
SELECT page_id, octet_length(encode(html))::BIGINT AS payload_bytes,
  list_aggregate(list_transform(range(32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
    ((('0x' || substr(h, ((i // 4) * 5 + 1)::INT, 5))::INT >> (15 - 5 * (i % 4))::INT) & 31) + 1, 1)),
    'string_agg', '') AS payload_digest,
  CASE WHEN page_id = last OR last IS NULL THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN page_id = last OR last IS NULL THEN NULL ELSE last END AS refers_to
FROM q"""

# (kind, pattern, characters of the tested part's least length); kinds in their order.
_ASSIGN = (
    r"""([Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]|"""
    r"""[Tt][Oo][Kk][Ee][Nn]|[Aa][Pp][Ii]_?[Kk][Ee][Yy])["'']?\x20*[:=]\x20*["'']?([A-Za-z0-9+/_.=-]+)"""
)
_KINDS = [
    ("assign", _ASSIGN, 2, 6),
    ("access", "AKIA[A-Z0-9]+", 0, 20),
    ("hex", "[0-9a-f]+", 0, 24),
    ("github", "gh[pousr]_[A-Za-z0-9]+", 0, 40),
    ("jwt", r"eyJ[A-Za-z0-9_-]+\.[A-Za-z0-9_-]+\.[A-Za-z0-9_-]+", 0, 1),
    ("private_key", "-----BEGIN [A-Z ]*PRIVATE KEY-----", 0, 1),
]


def _secret_spans() -> str:
    parts = [
        f"""SELECT doc_id, {place} AS place, '{kind}' AS kind,
    string_split_regex(text, '{pattern}') AS gaps,
    regexp_extract_all(text, '{pattern}', 0) AS found,
    list_transform(regexp_extract_all(text, '{pattern}', {group}), lambda x: length(x) >= {least}) AS good
  FROM d"""
        for place, (kind, pattern, group, least) in enumerate(_KINDS)
    ]
    return "\n  UNION ALL ".join(parts)


SECRETS = f"""WITH d AS (SELECT doc_id, coalesce(text, '') AS text FROM documents),
m AS ({_secret_spans()}),
s AS (
  SELECT doc_id, place, kind, i,
    list_sum(list_transform(gaps[1:i], lambda x: length(x)))
      + coalesce(list_sum(list_transform(found[1:i - 1], lambda x: length(x))), 0) AS start,
    length(found[i]) AS size
  FROM (SELECT *, unnest(range(1, len(found) + 1)) AS i FROM m WHERE len(found) > 0)
  WHERE good[i]),
g AS (
  SELECT doc_id, count(*) FILTER (kind = 'assign') AS a, count(*) FILTER (kind = 'access') AS b,
    count(*) FILTER (kind = 'hex') AS c,
    string_agg(kind || ':' || start::BIGINT || ':' || (start + size)::BIGINT, ',' ORDER BY start, place) AS every,
    string_agg(kind || ':' || start::BIGINT || ':' || (start + size)::BIGINT, ',' ORDER BY start, place)
      FILTER (place < 3) AS base
  FROM s GROUP BY doc_id)
SELECT doc_id, coalesce(a, 0) AS n_assign, coalesce(b, 0) AS n_access, coalesce(c, 0) AS n_hex,
  sha256(coalesce(base, '')) AS base_sha256, coalesce(every, '') AS spans
FROM d LEFT JOIN g USING (doc_id)"""

SEPARATORS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
_LOWER = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"


def _words(text: str) -> str:
    split = f"string_split_regex({_LOWER.format(text)}, '{SEPARATORS}')"
    return f"list_filter({split}, lambda x: x <> '')"


def _phrases() -> str:
    cases = []
    for phrase, label in PHRASES.items():
        parts = phrase.split(" ")
        same = " AND ".join(f"w[i + {j + 1}] = '{x}'" for j, x in enumerate(parts))
        cases.append(f"WHEN {same} THEN '{label}'")
    return "CASE " + " ".join(cases) + " END"


def _templates() -> str:
    rows = []
    for number, (span, labels) in enumerate(families(TEMPLATES, THRESHOLD)):
        for label in labels:
            words = sorted(set(TEMPLATES[label].split()))
            least = math.ceil(THRESHOLD * len(words) - 1e-9)
            lists = (", ".join(f"'{w}'" for w in x) for x in (words, NEEDED[label]))
            rows.append("({}, {}, '{}', [{}], [{}], {})".format(number, span, label, *lists, least))
    return "t(family, span, label, words, needed, least) AS (VALUES " + ", ".join(rows) + ")"


LICENSES = f"""WITH {_templates()},
d AS (SELECT doc_id, coalesce(text, '') AS text, {_words("coalesce(text, '')")} AS w FROM documents),
p AS (
  SELECT doc_id, i, {_phrases()} AS label
  FROM (SELECT doc_id, w, unnest(range(len(w))) AS i FROM d)),
b AS (
  SELECT doc_id, count(*) AS n, min(i) AS first, max(i) AS last,
    list_sort(list_distinct(list(label))) AS labels
  FROM p WHERE label IS NOT NULL GROUP BY doc_id),
x AS (
  SELECT doc_id, i, family, label, words, needed, least, list_distinct(w[i + 1:i + span]) AS block
  FROM (SELECT doc_id, w, t.*, unnest(range(len(w))) AS i FROM d JOIN t ON list_has_all(w, needed))),
y AS (
  SELECT doc_id, i, family, label, len(words) AS size, len(list_intersect(block, words)) / len(words) AS score
  FROM x WHERE list_has_all(block, needed) AND len(list_intersect(block, words)) >= least),
z AS (
  SELECT *, row_number() OVER (
    PARTITION BY doc_id, i, family ORDER BY score DESC, size DESC, label) AS place FROM y),
m AS (SELECT doc_id, label, max(score) AS score FROM z WHERE place = 1 GROUP BY doc_id, label),
ml AS (SELECT doc_id, list(label) AS labels, max(score) AS score FROM m GROUP BY doc_id)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n, 0)::BIGINT AS n_base, first::BIGINT AS first_word,
  last::BIGINT AS last_word, coalesce(array_to_string(b.labels, ','), '') AS base_labels,
  array_to_string(list_sort(list_distinct(list_concat(coalesce(b.labels, []), coalesce(ml.labels, [])))), ',') AS labels,
  CASE WHEN n > 0 THEN 1.0 ELSE coalesce(ml.score, 0.0) END::DOUBLE AS score
FROM d LEFT JOIN b USING (doc_id) LEFT JOIN ml USING (doc_id)"""

# Every template that a block contains, with no choice among them.
LICENSE_PAIRS = f"""WITH {_templates()},
d AS (SELECT row_number() OVER () AS r, doc_id, {_words("coalesce(text, '')")} AS w FROM documents),
x AS (
  SELECT r, doc_id, label, words, needed, least, list_distinct(w[i + 1:i + span]) AS block
  FROM (SELECT r, doc_id, w, t.*, unnest(range(len(w))) AS i
    FROM d JOIN t ON len(list_intersect(list_distinct(w), words)) >= least))
SELECT doc_id, label, max(len(list_intersect(block, words)) / len(words))::DOUBLE AS containment,
  bool_or(list_has_all(block, needed)) AS told
FROM x WHERE len(list_intersect(block, words)) >= least GROUP BY r, doc_id, label"""

def _shingles(key: str, table_name: str) -> str:
    grams = "list_transform(range(greatest(len(w) - 4, 1)), lambda i: array_to_string(w[i + 1:i + 5], ' '))"
    return f"""SELECT DISTINCT {key}, unnest({grams}) AS gram
  FROM (SELECT {key}, {_words("coalesce(text, '')")} AS w FROM {table_name}) WHERE len(w) > 0"""


LEAKS = f"""WITH i AS ({_shingles("item_id", "benchmark")}),
s AS (SELECT item_id, count(*) AS n_shingles FROM i GROUP BY item_id),
d AS ({_shingles("doc_id", "documents")})
SELECT doc_id, item_id, any_value(n_shingles) AS n_shingles, count(*) AS n_shared,
  count(*) / any_value(n_shingles) AS containment
FROM d JOIN i USING (gram) JOIN s USING (item_id) GROUP BY doc_id, item_id
HAVING count(*) >= ceil(0.8 * any_value(n_shingles) - 1e-9)"""

# Windows as joined words, first places by a window function, covered words by a range join.
REPEATS = r"""WITH d AS (
  SELECT doc_id, list_filter(string_split_regex(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w
  FROM documents),
s AS (
  SELECT doc_id, i, md5(array_to_string(w[i + 1:i + 20], ' ')) AS h
  FROM (SELECT doc_id, w, unnest(range(len(w) - 19)) AS i FROM d WHERE len(w) >= 20)),
r AS (
  SELECT doc_id, i FROM (
    SELECT doc_id, i, row_number() OVER (PARTITION BY h ORDER BY doc_id, i) AS n FROM s)
  WHERE n > 1),
c AS (SELECT DISTINCT doc_id, i + j AS i FROM r, range(20) x(j)),
g AS (SELECT doc_id, list(i) AS gone, count(*) AS n FROM c GROUP BY doc_id)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n, 0)::BIGINT AS n_removed,
  sha256(array_to_string(CASE WHEN n IS NULL THEN w ELSE list_transform(
    list_filter(range(len(w)), lambda i: NOT list_contains(gone, i)), lambda i: w[i + 1]) END, ' ')) AS kept_sha256
FROM d LEFT JOIN g USING (doc_id)"""

# Each document against each order and step.
AUDIT = r"""WITH l(x) AS (SELECT unnest(['A', 'B', 'C', 'D', 'E'])),
o AS (
  SELECT a.x || b.x || c.x || d.x || e.x AS filter_order FROM l a, l b, l c, l d, l e
  WHERE len(list_distinct([a.x, b.x, c.x, d.x, e.x])) = 5),
t AS (
  SELECT doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS text,
    list_filter(string_split_regex(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w
  FROM documents),
f AS (
  SELECT doc_id, part,
    CASE WHEN len(w) < 100 THEN 'A' ELSE '' END
    || CASE WHEN 100 * len(list_distinct(w)) < 80 * len(w) THEN 'B' ELSE '' END
    || CASE WHEN 100 * length(regexp_replace(text, '[^A-Z]', '', 'g')) > 10 * length(text) THEN 'C' ELSE '' END
    || CASE WHEN regexp_matches(text, '[#$%&*|]') THEN 'D' ELSE '' END
    || CASE WHEN doc_id > min(doc_id) OVER (PARTITION BY text) THEN 'E' ELSE '' END AS fails
  FROM t),
k AS (
  SELECT doc_id, coalesce(bool_or(quality = 1), false) AS good, coalesce(bool_or(toxic = 1), false) AS bad
  FROM labels GROUP BY doc_id),
c AS (
  SELECT part, fails, count(*) AS n, count(*) FILTER (good) AS good, count(*) FILTER (bad) AS bad
  FROM f LEFT JOIN k USING (doc_id) GROUP BY part, fails),
s AS (
  SELECT part, filter_order, step::INT AS step, n, good, bad, fails,
    contains(fails, filter_order[step]) AS here,
    len(list_filter(range(1, step), lambda i: contains(fails, filter_order[i]))) > 0 AS gone
  FROM c, o, range(1, 6) r(step)),
g AS (
  SELECT part, filter_order, step,
    sum(CASE WHEN NOT here AND NOT gone THEN n ELSE 0 END)::BIGINT AS kept,
    sum(CASE WHEN here AND NOT gone THEN n ELSE 0 END)::BIGINT AS removed,
    sum(CASE WHEN here AND gone THEN n ELSE 0 END)::BIGINT AS redundant,
    sum(CASE WHEN here AND length(fails) = 1 THEN n ELSE 0 END)::BIGINT AS unique_fails,
    sum(CASE WHEN here AND NOT gone THEN good ELSE 0 END)::BIGINT AS good_lost,
    sum(CASE WHEN here AND NOT gone THEN bad ELSE 0 END)::BIGINT AS toxic_lost
  FROM s GROUP BY part, filter_order, step)
SELECT *, (sum(removed) OVER (PARTITION BY part, filter_order[step]))::BIGINT AS shapley FROM g"""

# All pairs of a label, and what each vector reaches by links.
VECTORS = """WITH RECURSIVE v AS (
  SELECT vec_id, label, embedding::DOUBLE[] AS e FROM embeddings
  WHERE label IS NOT NULL AND len(embedding) > 0
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
l AS (
  SELECT a.vec_id AS a, b.vec_id AS b FROM v a JOIN v b
    ON a.label = b.label AND len(a.e) = len(b.e) AND a.vec_id <> b.vec_id
  WHERE list_cosine_similarity(a.e, b.e) >= 0.98),
r(a, b) AS (SELECT a, b FROM l UNION SELECT r.a, l.b FROM r JOIN l ON r.b = l.a),
n AS (SELECT a, count(*) AS n FROM l GROUP BY a),
m AS (SELECT a, min(b) AS least FROM r GROUP BY a)
SELECT vec_id, coalesce(n, 0)::BIGINT AS n_links, least(vec_id, coalesce(least, vec_id)) AS component_id,
  vec_id <= coalesce(least, vec_id) AS kept
FROM embeddings LEFT JOIN n ON n.a = vec_id LEFT JOIN m ON m.a = vec_id"""

ORACLE_SQL = {
    "op1_warc": WARC,
    "op2_secret_scan": SECRETS,
    "op3_license_scan": LICENSES,
    "op9_decontamination": LEAKS,
    "op10_phrases": REPEATS,
    "op11_filter_audit": AUDIT,
    "op12_embedding_dedup": VECTORS,
    "license_pairs": LICENSE_PAIRS,
}
