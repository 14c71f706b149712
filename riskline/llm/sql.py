"""DuckDB SQL for the queries that SQL can express."""

from __future__ import annotations

_WORD = r"[^\x20\x09-\x0D]+"
_GAP = r"[\x20\x09-\x0D]+"

DEDUP = rf"""
WITH norm AS (SELECT doc_id, regexp_replace(coalesce(text, ''), '{_GAP}', ' ', 'g') AS t FROM documents),
grp AS (SELECT doc_id, t, count(*) OVER (PARTITION BY t) AS group_size,
          min(doc_id) OVER (PARTITION BY t) AS keep_id,
          row_number() OVER (PARTITION BY t ORDER BY doc_id NULLS LAST) AS rn FROM norm)
SELECT doc_id, keep_id, group_size, rn = 1 AS kept, sha256(t) AS text_sha256 FROM grp
"""

# The water level: sources are capped in order of cap / weight as long as the cap lies under
# the level that is left for the others.
_MIX = rf"""
size AS (SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '{_WORD}'))::BIGINT AS size FROM {{docs}}),
src AS (SELECT source, sum(size)::BIGINT AS source_size FROM size GROUP BY source),
wgt AS (SELECT source, source_size, 3.0::DOUBLE * source_size AS cap,
          list_extract([5.0, 2.0, 1.0], ((row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1)::INT)::DOUBLE AS w FROM src),
lvl AS (SELECT *, sum(source_size) OVER ()::DOUBLE AS total,
          coalesce(sum(cap) OVER (ORDER BY cap / w, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0.0) AS cap_before,
          sum(w) OVER () - coalesce(sum(w) OVER (ORDER BY cap / w, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0.0) AS w_left FROM wgt),
cpd AS (SELECT *, (total - cap_before) / w_left AS level, cap <= w * ((total - cap_before) / w_left) AS capped FROM lvl),
fin AS (SELECT level FROM cpd WHERE NOT capped ORDER BY cap / w, source LIMIT 1),
tgt AS (SELECT source, source_size,
          CASE WHEN capped OR (SELECT count(*) FROM fin) = 0 THEN cap ELSE w * (SELECT level FROM fin) END AS target,
          ('0x' || substr(md5('mix-1|' || coalesce(source, '')), 1, 8))::UBIGINT::DOUBLE / 4294967296.0 AS off FROM cpd),
exp AS (SELECT *, CASE WHEN source_size > 0 THEN target / source_size ELSE 0.0 END AS e FROM tgt),
rnk AS (SELECT s.doc_id, s.size, s.source, x.source_size, x.target, x.e, x.off,
          row_number() OVER (PARTITION BY s.source ORDER BY s.size DESC, s.doc_id NULLS LAST) AS r,
          s.size > 0.05 * x.target AS big
        FROM size s JOIN exp x ON s.source IS NOT DISTINCT FROM x.source),
fst AS (SELECT *, least(floor(r * e + off) - floor((r - 1) * e + off), 3)::BIGINT AS k1 FROM rnk),
ovr AS (SELECT source, count(*) FILTER (big) AS n_big, coalesce(sum(k1 * size) FILTER (big), 0)::DOUBLE AS got,
          coalesce(sum(size) FILTER (NOT big), 0)::DOUBLE AS rest FROM fst GROUP BY source),
mix AS (SELECT f.*, o.n_big, CASE WHEN o.rest > 0 THEN greatest(0.0, least(3.0, (f.target - o.got) / o.rest)) ELSE 0.0 END AS e2
        FROM fst f JOIN ovr o ON f.source IS NOT DISTINCT FROM o.source)
"""
_COPIES = """CASE WHEN big THEN k1 ELSE least(floor(n_big * e + (r - n_big) * e2 + off)
          - floor(n_big * e + (r - n_big - 1) * e2 + off), 3)::BIGINT END"""

MIX = "WITH " + _MIX.format(docs="documents") + f"SELECT doc_id, size, source_size, target, {_COPIES} * size AS taken FROM mix"

def license_sql() -> str:
    """op10; the templates are those of the operator."""
    from riskline.llm.licenses import CUE, NOTICE_WORDS, TEMPLATES, TERM, THRESHOLD

    quoted = ", ".join("({}, '{}', '{}')".format(k, i, t.replace("'", "''")) for k, (i, t) in enumerate(TEMPLATES))
    return rf"""
WITH tpl(template, license, notice) AS (VALUES {quoted}),
doc AS (SELECT doc_id, coalesce(text, '') AS t, coalesce(source, '_') || '/' || coalesce(lang, '_') AS home,
          regexp_matches(coalesce(text, ''), '{CUE}') AND len(regexp_extract_all(coalesce(text, ''), '{_WORD}')) <= {NOTICE_WORDS} AS lic FROM documents),
fil AS (SELECT *, home || CASE WHEN lic THEN '' ELSE '/' || coalesce((doc_id // 50)::VARCHAR, '_') END || '/' || coalesce(doc_id::VARCHAR, '_') AS path FROM doc),
dirs AS (SELECT *, regexp_extract(path, '^(.*)/', 1) AS dir FROM fil),
said AS (SELECT doc_id, CASE WHEN lic THEN t ELSE array_to_string(list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '{CUE}')), chr(10)) END AS notice FROM fil),
tf AS (SELECT doc_id, term, count(*) AS tf FROM (SELECT doc_id, unnest(regexp_extract_all(lower(notice), '{TERM}')) AS term FROM said WHERE regexp_matches(notice, '{CUE}')) GROUP BY ALL),
ttf AS (SELECT template, license, term, count(*) AS tf FROM (SELECT template, license, unnest(regexp_extract_all(lower(notice), '{TERM}')) AS term FROM tpl) GROUP BY ALL),
n AS (SELECT (SELECT count(DISTINCT doc_id) FROM tf) + (SELECT count(*) FROM tpl) AS n),
idf AS (SELECT term, ln((SELECT n FROM n)::DOUBLE / count(*)) + 1.0 AS idf FROM (SELECT term FROM tf UNION ALL SELECT term FROM ttf) GROUP BY term),
tvec AS (SELECT template, license, term, tf * idf AS w FROM ttf JOIN idf USING (term)),
tnorm AS (SELECT template, sqrt(sum(w * w)) AS tn FROM tvec GROUP BY template),
vec AS (SELECT doc_id, term, tf * idf AS w FROM tf JOIN idf USING (term)),
norm AS (SELECT doc_id, sqrt(sum(w * w)) AS dn FROM vec GROUP BY doc_id),
near AS (SELECT v.doc_id, t.license, round(sum(v.w * t.w) / (any_value(dn) * any_value(tn)), 6) AS score
         FROM vec v JOIN tvec t USING (term) JOIN tnorm USING (template) JOIN norm m ON m.doc_id = v.doc_id GROUP BY v.doc_id, template, t.license),
own AS (SELECT doc_id, license AS own_license, score FROM (SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY score DESC, license) AS r FROM near WHERE score >= {THRESHOLD}) WHERE r = 1),
plc AS (SELECT d.*, own_license, score FROM dirs d LEFT JOIN own USING (doc_id)),
bydir AS (SELECT dir AS anc, own_license AS dir_license FROM (SELECT dir, own_license, row_number() OVER (PARTITION BY dir ORDER BY score DESC, own_license) AS r FROM plc WHERE lic AND own_license IS NOT NULL) WHERE r = 1),
up AS (SELECT dir, k AS depth, array_to_string(list_slice(string_split(dir, '/'), 1, k), '/') AS anc FROM (SELECT DISTINCT dir FROM plc), unnest(range(0, len(string_split(dir, '/')) + 1)) AS u(k)),
best AS (SELECT dir, anc, dir_license FROM (SELECT *, row_number() OVER (PARTITION BY dir ORDER BY depth DESC) AS r FROM up JOIN bydir USING (anc)) WHERE r = 1)
SELECT doc_id, path, own_license, score, coalesce(own_license, dir_license) AS license, CASE WHEN own_license IS NULL THEN anc END AS inherited_from
FROM plc LEFT JOIN best USING (dir)
"""


QUALITY = rf"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS t, regexp_extract_all(coalesce(text, ''), '{_WORD}') AS w FROM documents),
win AS (SELECT doc_id, i, array_to_string(list_slice(w, i, i + 7), ' ') AS g FROM d, unnest(range(1, len(w) - 6)) AS u(i)),
rep AS (SELECT doc_id, i FROM (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, g) AS n FROM win) WHERE n > 1),
cov AS (SELECT doc_id, count(DISTINCT i + k)::BIGINT AS n_repeat_words FROM rep, unnest(range(0, 8)) AS v(k) GROUP BY doc_id),
lin AS (SELECT doc_id, count(*) AS n_lines, count(*) - count(DISTINCT l) AS n_dup_lines
        FROM (SELECT doc_id, unnest(string_split(t, chr(10))) AS l FROM d) WHERE regexp_matches(l, '[^\x20\x09-\x0D]') GROUP BY doc_id),
f AS (SELECT d.doc_id, len(w)::BIGINT AS n_words, length(regexp_replace(t, '{_GAP}', '', 'g'))::BIGINT AS word_chars,
        length(regexp_replace(t, '[^#*$%&|<>]+', '', 'g'))::BIGINT AS n_symbols, coalesce(n_lines, 0)::BIGINT AS n_lines,
        coalesce(n_dup_lines, 0)::BIGINT AS n_dup_lines, coalesce(n_repeat_words, 0)::BIGINT AS n_repeat_words,
        length(regexp_replace(t, '[^A-Z]+', '', 'g')) AS n_capitals, length(regexp_replace(t, '[^!]+', '', 'g')) AS n_exclamations,
        len(list_filter(range(2, len(w) + 1), lambda i: w[i] = w[i - 1])) AS n_stutters
      FROM d LEFT JOIN cov USING (doc_id) LEFT JOIN lin USING (doc_id)),
b AS (SELECT *, n_words < 20 OR 100 * n_repeat_words > 30 * n_words AS base_failed FROM f)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
  NOT (base_failed OR 10 * n_symbols > n_words OR 100 * n_dup_lines > 50 * n_lines OR word_chars < 3 * n_words
       OR word_chars > 10 * n_words OR 100 * n_capitals > 40 * word_chars OR 100 * n_exclamations > 30 * n_words OR 100 * n_stutters > 30 * n_words) AS kept
FROM b
"""

INTERACTION = rf"""
WITH d AS (SELECT *, coalesce(source, '') AS part, coalesce(text, '') AS t, regexp_extract_all(coalesce(text, ''), '{_WORD}') AS w FROM documents),
lab AS (SELECT doc_id, coalesce(max((quality = 1)::INT), 0) AS good, coalesce(max((toxic = 1)::INT), 0) AS toxic FROM labels GROUP BY doc_id),
f AS (SELECT part, coalesce(good, 0) AS good, coalesce(toxic, 0) AS toxic, (len(w) < 50)::INT + 2 * (100 * len(list_distinct(w)) < 65 * len(w))::INT
        + 4 * (100 * length(regexp_replace(t, '[^A-Z]+', '', 'g')) > 5 * length(t))::INT + 8 * regexp_matches(t, '[#$%&*|]')::INT
        + 16 * coalesce(d.doc_id > min(d.doc_id) OVER (PARTITION BY t), false)::INT AS mask FROM d LEFT JOIN lab USING (doc_id)),
c AS (SELECT part, mask, count(*) AS n, sum(good) AS good, sum(toxic) AS toxic FROM f GROUP BY part, mask),
l AS (SELECT chr((65 + k)::INT) AS x, 1 << k AS b FROM range(5) AS r(k)),
o AS (SELECT l1.x || l2.x || l3.x || l4.x || l5.x AS filter_order, [l1.b, l2.b, l3.b, l4.b, l5.b] AS bits FROM l l1, l l2, l l3, l l4, l l5
      WHERE l1.b + l2.b + l3.b + l4.b + l5.b = 31 AND l1.b | l2.b | l3.b | l4.b | l5.b = 31),
s AS (SELECT filter_order, step, bits[step] AS own, list_sum(list_concat([0], bits[:step - 1]))::BIGINT AS prior FROM o, range(1, 6) AS r(step))
SELECT part, filter_order, step::INT AS step, coalesce(sum(n) FILTER (mask & (prior | own) = 0), 0)::BIGINT AS kept,
  coalesce(sum(n) FILTER (mask & prior = 0 AND mask & own <> 0), 0)::BIGINT AS removed, coalesce(sum(n) FILTER (mask & prior <> 0 AND mask & own <> 0), 0)::BIGINT AS redundant,
  coalesce(sum(n) FILTER (mask = own), 0)::BIGINT AS unique_fails, coalesce(sum(good) FILTER (mask & prior = 0 AND mask & own <> 0), 0)::BIGINT AS good_lost,
  coalesce(sum(toxic) FILTER (mask & prior = 0 AND mask & own <> 0), 0)::BIGINT AS toxic_lost,
  coalesce(sum(n * (120 // greatest(bit_count(mask), 1))) FILTER (mask & own <> 0), 0)::BIGINT AS shapley
FROM c, s GROUP BY part, filter_order, step
"""

_LATIN_RUN = r"[A-Za-z\x{00C0}-\x{00FF}]+"

# crc32 by its table; near words meet where they are equal without one letter.
SPELLING = rf"""
WITH RECURSIVE tab AS (SELECT list_transform(range(256), lambda b: list_reduce([b, 0, 0, 0, 0, 0, 0, 0, 0],
          lambda c, z: xor(c >> 1, CASE WHEN c & 1 = 1 THEN 3988292384 ELSE 0 END))) AS tab),
run AS (SELECT doc, run, count(*) AS n FROM (SELECT coalesce(doc_id::VARCHAR, '') AS doc, translate(unnest(regexp_extract_all(text, '{_LATIN_RUN}')),
          'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS run FROM documents) WHERE len(run) >= 7 GROUP BY doc, run),
byt AS (SELECT *, flatten(list_transform(string_split(doc || ':' || run, ''),
          lambda ch: CASE WHEN ord(ch) < 128 THEN [ord(ch)::BIGINT] ELSE [192 + (ord(ch)::BIGINT >> 6), 128 + (ord(ch)::BIGINT & 63)] END)) AS bytes FROM run),
crc AS (SELECT run, n, xor(list_reduce(list_prepend(4294967295::BIGINT, bytes), lambda c, b: xor(c >> 8, tab[(xor(c, b) & 255) + 1])), 4294967295) AS h FROM byt, tab),
voc AS (SELECT word, sum(n)::BIGINT AS n FROM (SELECT n, CASE WHEN h % 31 = 0 THEN left(run, (h % len(run))::INT) || substr(run, (h % len(run))::INT + 2) ELSE run END AS word FROM crc)
        WHERE len(word) >= 7 GROUP BY word HAVING sum(n) >= 2),
cut AS (SELECT word, k, left(word, k::INT - 1) || substr(word, k::INT + 1) AS rest FROM voc, unnest(range(1, len(word) + 1)) AS u(k)),
near AS (SELECT a.word, b.word AS near FROM cut a JOIN cut b ON a.k = b.k AND a.rest = b.rest AND a.word <> b.word
         UNION SELECT c.word, v.word FROM cut c JOIN voc v ON v.word = c.rest UNION SELECT v.word, c.word FROM cut c JOIN voc v ON v.word = c.rest),
best AS (SELECT p.word, count(*) AS n_near, min((-v.n, encode(near))) AS b, max(v.n) AS best_n FROM near p JOIN voc v ON v.word = near GROUP BY p.word),
frm AS (SELECT v.word, v.n, coalesce(n_near, 0) AS n_near, CASE WHEN best_n >= 10 * v.n THEN decode(b[2]) END AS form, CASE WHEN best_n >= 10 * v.n THEN best_n END AS form_n
        FROM voc v LEFT JOIN best USING (word)),
up AS (SELECT word, word AS top, 0 AS step FROM frm UNION ALL SELECT u.word, f.form, step + 1 FROM up u JOIN frm f ON f.word = u.top WHERE f.form IS NOT NULL)
SELECT word, form, root, n, n_near::BIGINT AS n_near, form_n FROM frm JOIN (SELECT word, arg_max(top, step) AS root FROM up GROUP BY word) USING (word)
"""


def url_sql() -> str:
    """op11; a level of the tree after the other."""
    from riskline.llm import urls as u

    url = "'://([^/?#]*)([^?#]*)'"
    host = f"translate(coalesce(regexp_extract(url, {url}, 1), ''), '{u._UPPER}', '{u._LOWER}')"
    path = f"coalesce(regexp_extract(url, {url}, 2), '')"
    rules = "".join(
        f" WHEN (host = '{h}' OR ends_with(host, '.{h}')) AND starts_with(path, '{p}') THEN {{{v}}}".replace("{" + v + "}", f"{{'rule': '{h + p}', 'verdict': '{v}'}}")
        for v, h, p in sorted(u.RULES, key=lambda r: -len(r[1] + r[2]))
    )
    levels = ""
    for k in range(1, u.LEVELS + 1):
        levels += f"""
a{k} AS MATERIALIZED (SELECT host, template, parts[{k}] AS child, max(node_n) AS node_n, sum(n) AS n, sum(good) AS good, sum(labelled) AS labelled,
       sum(CASE WHEN len(parts) = {k} THEN n ELSE 0 END) AS ends FROM t{k - 1} WHERE len(parts) >= {k} GROUP BY ALL),
v{k} AS (SELECT *, CASE WHEN n >= {u.SUPPORT} AND 100 * n >= {u.SHARE} * node_n THEN child ELSE '*' END AS value FROM a{k}),
b{k} AS (SELECT *, sum(good) OVER w AS g, sum(labelled) OVER w AS l FROM (SELECT host, template, value, sum(n) AS n, sum(good)::DOUBLE AS good, sum(labelled)::DOUBLE AS labelled, sum(ends) AS ends
       FROM v{k} GROUP BY ALL) WINDOW w AS (PARTITION BY host, template)),
s{k} AS MATERIALIZED (SELECT *, good * (l - labelled) - (g - good) * labelled AS gap, 2 * ends >= n AS leaf,
       CASE WHEN gap * gap * l > {u.DIFFERENT} * (labelled * (l - labelled) * g * (l - g)) THEN sign(gap) ELSE 0 END AS side FROM b{k}),
m{k} AS (SELECT host, template, side, leaf, sum(n - ends) AS below, list_sort(list(value)) AS alike FROM s{k} GROUP BY ALL),
n{k} AS (SELECT host, template, value, below, CASE WHEN len(alike) = 1 THEN value ELSE '{{' || array_to_string(alike, '|') || '}}' END AS name FROM s{k} JOIN m{k} USING (host, template, side, leaf)),
t{k} AS MATERIALIZED (SELECT t.host, shape, parts, t.n, t.good, t.labelled, t.template || '/' || name AS template, below AS node_n
       FROM t{k - 1} t JOIN v{k} v ON t.host = v.host AND t.template = v.template AND parts[{k}] = child JOIN n{k} m ON m.host = v.host AND m.template = v.template AND m.value = v.value
       WHERE len(parts) >= {k} UNION ALL SELECT * FROM t{k - 1} WHERE len(parts) < {k}),"""
    return rf"""
WITH lab AS (SELECT doc_id, NOT coalesce(min(quality) = 0, false) AND NOT coalesce(max(toxic) = 1, false) AS good FROM labels
        WHERE quality IS NOT NULL OR toxic IS NOT NULL GROUP BY doc_id),
pag AS (SELECT page_id, url, {host} AS host, {path} AS path FROM pages),
shp AS (SELECT *, regexp_replace(path, '[0-9]+', '#', 'g') AS shape, try_cast(regexp_extract(path, '/([0-9]+)', 1) AS BIGINT) AS doc_id FROM pag),
one AS (SELECT host, shape, sum(n) AS n, sum(good) AS good, sum(labelled) AS labelled FROM (SELECT host, shape, 1 AS n, 0 AS good, 0 AS labelled FROM shp
        UNION ALL SELECT host, shape, 0, good::INT, 1 FROM shp JOIN lab USING (doc_id)) GROUP BY ALL),
prt AS (SELECT *, CASE WHEN shape = '' THEN []::VARCHAR[] ELSE string_split(substr(shape, 2), '/') END AS parts FROM one),
t0 AS MATERIALIZED (SELECT host, shape, parts, n, good, labelled, '' AS template, sum(CASE WHEN len(parts) > 0 THEN n ELSE 0 END) OVER (PARTITION BY host) AS node_n FROM prt),{levels}
fin AS (SELECT host, shape, good, labelled, template || CASE WHEN len(parts) > {u.LEVELS} THEN '/**' ELSE '' END AS template FROM t{u.LEVELS}),
bas AS (SELECT (sum(good) + 1.0::DOUBLE) / (sum(labelled) + 1.0::DOUBLE) AS base FROM fin),
per AS (SELECT host, template, sum(good)::DOUBLE AS good, sum(labelled)::DOUBLE AS labelled FROM fin GROUP BY ALL),
hst AS (SELECT host, (sum(good) + {u.PRIOR}::DOUBLE * (SELECT base FROM bas)) / (sum(labelled) + {u.PRIOR}::DOUBLE) AS host_purity FROM per GROUP BY host),
pur AS (SELECT host, template, (good + {u.PRIOR}::DOUBLE * host_purity) / (labelled + {u.PRIOR}::DOUBLE) AS purity FROM per JOIN hst USING (host)),
jud AS (SELECT page_id, host, path, template, purity, CASE{rules} END AS fit FROM shp JOIN (SELECT host, shape, template FROM fin) USING (host, shape) JOIN pur USING (host, template))
SELECT page_id, host, path, fit.rule AS rule, coalesce(fit.verdict, CASE WHEN purity < {u.MIN_PURITY} THEN 'block' ELSE 'allow' END) AS verdict, template, purity FROM jud
"""


SQL = {"op10_license_scan": license_sql(), "op11_url_templates": url_sql(), "op12_filter_interaction": INTERACTION, "op13_spelling_variants": SPELLING, "op4_quality_cascade": QUALITY, "op7_content_sort_dedup": DEDUP, "op8_systematic_mixing": MIX}
