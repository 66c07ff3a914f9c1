"""DuckDB forms of the corpus queries that SQL can express."""

from __future__ import annotations

from loamline.llm.licenses import NOTICES, TEMPLATES, Template

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
LOWERED = f"translate(coalesce(text, ''), '{UPPER}', '{UPPER.lower()}')"
PLAIN = r"[^\x20\x09-\x0D]+"
ALNUM = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
SEED = 20240607

OP2 = rf"""
WITH RECURSIVE docs AS (
  SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '{PLAIN}')) AS size, md5(coalesce(text, '')) AS digest FROM documents
), sizes AS (
  SELECT source, sum(size)::BIGINT AS source_size, [5.0, 2.0, 1.0][(row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1]::DOUBLE AS weight FROM docs GROUP BY source
), levels AS (
  SELECT *, source_size * 2.0::DOUBLE AS cap, source_size * 2.0::DOUBLE / weight AS level FROM sizes
), reaches AS (
  SELECT *, (sum(source_size) OVER () * 1.5::DOUBLE - coalesce(sum(cap) OVER w, 0)) / (sum(weight) OVER () - coalesce(sum(weight) OVER w, 0)) AS reach
  FROM levels WINDOW w AS (ORDER BY level, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
), water AS (SELECT arg_min(reach, level) FILTER (reach < level) AS water FROM reaches
), aims AS (
  SELECT *, round(target)::BIGINT AS words, greatest(1, ceil(sum(source_size) OVER () / 4096))::BIGINT AS width
  FROM (SELECT source, source_size, CASE WHEN water IS NULL THEN cap ELSE least(cap, water * weight) END AS target FROM reaches, water)
), placed AS (
  SELECT d.doc_id, d.source, d.size, a.source_size, a.target, a.words AS aim, a.width,
    sum(size) OVER (PARTITION BY d.source ORDER BY md5('{SEED}:' || coalesce(d.doc_id::VARCHAR, '') || ':' || digest), d.doc_id, size ROWS UNBOUNDED PRECEDING) - size AS pos
  FROM docs d JOIN aims a ON d.source IS NOT DISTINCT FROM a.source
), held AS (
  SELECT source, aim, (pos // width)::BIGINT AS block, sum(size)::BIGINT AS words, min(pos) AS start FROM placed GROUP BY ALL HAVING sum(size) > 0
), offered AS (
  SELECT *, coalesce(sum(words) OVER (PARTITION BY source ORDER BY pass, md5('{SEED}:draw:' || pass || ':' || coalesce(source, '') || ':' || (source IS NULL) || ':' || block), block ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS before
  FROM held, range(0, 2) AS passes(pass)
), drawn AS (
  SELECT source, block, start, pass, least(words, aim - before) AS room,
    row_number() OVER (PARTITION BY source ORDER BY md5('{SEED}:deal:' || pass || ':' || coalesce(source, '') || ':' || (source IS NULL) || ':' || block), pass, block) AS place
  FROM offered WHERE before < aim
), tokens AS (
  SELECT source, unnest(range(1, blocks + 1)) AS token, sum(blocks) OVER () AS every FROM (SELECT source, count(*) AS blocks FROM drawn GROUP BY source)
), tree0 AS (
  SELECT *, row_number() OVER (ORDER BY md5('{SEED}:tree:0:' || coalesce(source, '') || ':' || (source IS NULL) || ':' || token)) <= floor(every * 4 / 8) AS left_ FROM tokens
), tree1 AS (
  SELECT source, token, every, CASE WHEN left_ THEN 0 ELSE 4 END AS low FROM tree0
), tree1d AS (
  SELECT *, row_number() OVER (PARTITION BY low ORDER BY md5('{SEED}:tree:1:' || coalesce(source, '') || ':' || (source IS NULL) || ':' || token)) <= floor(every * (low + 2) / 8) - floor(every * low / 8) AS left_ FROM tree1
), tree2 AS (
  SELECT source, token, every, CASE WHEN left_ THEN low ELSE low + 2 END AS low FROM tree1d
), tree2d AS (
  SELECT *, row_number() OVER (PARTITION BY low ORDER BY md5('{SEED}:tree:2:' || coalesce(source, '') || ':' || (source IS NULL) || ':' || token)) <= floor(every * (low + 1) / 8) - floor(every * low / 8) AS left_ FROM tree2
), slots AS (
  SELECT source, CASE WHEN left_ THEN low ELSE low + 1 END AS shard, row_number() OVER (PARTITION BY source ORDER BY CASE WHEN left_ THEN low ELSE low + 1 END) AS place FROM tree2d
), dealt AS (
  SELECT d.source, d.block, d.start, d.pass, d.room, s.shard FROM drawn d JOIN slots s ON d.source IS NOT DISTINCT FROM s.source AND d.place = s.place
), taken AS (
  SELECT p.doc_id, p.size, p.source_size, p.target, d0.shard AS s0, d1.shard AS s1,
    CASE WHEN d0.room IS NULL THEN 0 ELSE greatest(0, least(size, d0.room - pos + d0.start)) END AS take0, CASE WHEN d1.room IS NULL THEN 0 ELSE greatest(0, least(size, d1.room - pos + d1.start)) END AS take1
  FROM placed p
  LEFT JOIN dealt d0 ON d0.pass = 0 AND p.source IS NOT DISTINCT FROM d0.source AND pos // width = d0.block
  LEFT JOIN dealt d1 ON d1.pass = 1 AND p.source IS NOT DISTINCT FROM d1.source AND pos // width = d1.block
)
SELECT doc_id, size::BIGINT AS size, source_size, target, (take0 + take1)::BIGINT AS taken,
  (CASE WHEN take0 > 0 THEN s0 END)::INTEGER AS shard0, (CASE WHEN take1 > 0 THEN s1 END)::INTEGER AS shard1 FROM taken
"""

OP3 = rf"""
WITH RECURSIVE words AS (
  SELECT doc_id, regexp_extract_all({LOWERED}, '{PLAIN}') AS w FROM documents
), shingles AS (
  SELECT doc_id, unnest(CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 4 THEN [array_to_string(w, ' ')]
    ELSE list_distinct(list_transform(range(1, len(w) - 2), lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2] || ' ' || w[i + 3])) END) AS s FROM words
), sizes AS (SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id
), common AS (
  SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS shared FROM shingles a JOIN shingles b ON a.s = b.s AND a.doc_id < b.doc_id GROUP BY ALL
), links AS (
  SELECT a, b FROM common JOIN sizes x ON x.doc_id = a JOIN sizes y ON y.doc_id = b WHERE 100 * shared >= 80 * (x.n + y.n - shared)
), edges AS (SELECT a, b FROM links UNION ALL SELECT b, a FROM links
), reach AS (
  SELECT a AS doc_id, a AS other FROM edges UNION SELECT r.doc_id, e.b FROM reach r JOIN edges e ON r.other = e.a
), component AS (SELECT doc_id, min(other) AS component_id FROM reach GROUP BY doc_id)
SELECT d.doc_id, coalesce(n, 0)::BIGINT AS n_shingles, coalesce(component_id, d.doc_id) AS component_id, d.doc_id = coalesce(component_id, d.doc_id) AS kept
FROM documents d LEFT JOIN sizes s ON d.doc_id = s.doc_id LEFT JOIN component c ON d.doc_id = c.doc_id
"""

OP4 = rf"""
WITH docs AS (
  SELECT row_number() OVER () AS r, doc_id, source, coalesce(text, '') AS text, regexp_extract_all(coalesce(text, ''), '{PLAIN}') AS w,
    list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '{PLAIN}')) AS lines FROM documents
), windows AS (
  SELECT r, unnest(range(1, len(w) - 1)) AS i, unnest(list_transform(range(1, len(w) - 1), lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2])) AS t FROM docs
), repeated AS (
  SELECT r, count(DISTINCT i + k) AS n_repeat_words FROM (SELECT r, i, count(*) OVER (PARTITION BY r, t) AS c FROM windows), range(3) AS ks(k) WHERE c >= 2 GROUP BY r
), lines AS (
  SELECT r, source, unnest(list_transform(lines, lambda x: regexp_replace(trim(regexp_replace(lower(x), '[\x20\x09-\x0D]+', ' ', 'g'), ' '), '[0-9]', '0', 'g'))) AS line,
    unnest(list_transform(lines, lambda x: len(regexp_extract_all(x, '{PLAIN}')))) AS n FROM docs
), hosts AS (SELECT source, count(*) AS host_docs FROM docs GROUP BY source
), often AS (
  SELECT l.source, line FROM (SELECT source, line, count(DISTINCT r) AS c FROM lines GROUP BY source, line) l JOIN hosts h ON l.source IS NOT DISTINCT FROM h.source WHERE c > 50 AND c > 0.05::DOUBLE * host_docs
), removed AS (
  SELECT r, sum(n)::BIGINT AS n_removed FROM lines l WHERE EXISTS (FROM often o WHERE o.line = l.line AND o.source IS NOT DISTINCT FROM l.source) GROUP BY r
), figures AS (
  SELECT doc_id, len(w)::BIGINT AS n_words, length(array_to_string(w, ''))::BIGINT AS word_chars, (length(text) - length(regexp_replace(text, '[#*$%&|<>]', '', 'g')))::BIGINT AS n_symbols,
    (len(lines) - len(list_distinct(lines)))::BIGINT AS n_dup_lines, coalesce(n_repeat_words, 0)::BIGINT AS n_repeat_words, coalesce(n_removed, 0)::BIGINT AS n_removed
  FROM docs LEFT JOIN repeated USING (r) LEFT JOIN removed USING (r)
), judged AS (SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed FROM figures)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
  NOT base_failed AND NOT (n_removed > 0 AND (n_words - n_removed < 0.3::DOUBLE * n_words OR n_words - n_removed < 20)) AS kept, n_removed FROM judged
"""

OP8 = rf"""
WITH docs AS (
  SELECT row_number() OVER () AS r, doc_id, regexp_extract_all({LOWERED}, '{ALNUM}') AS w FROM documents
), items AS (
  SELECT coalesce(item_id::VARCHAR, '') AS item_id, regexp_extract_all({LOWERED}, '{ALNUM}') AS w FROM benchmark
), windows AS (
  SELECT DISTINCT item_id, least(len(w), 10) AS k, unnest(list_transform(range(1, greatest(len(w) - 9, 1) + 1), lambda i: array_to_string(w[i : i + least(len(w), 10) - 1], ' '))) AS t FROM items WHERE len(w) > 0
), sizes AS (SELECT DISTINCT k FROM windows
), places AS (
  SELECT r, k, unnest(range(1, len(w) - k + 2)) AS i, unnest(list_transform(range(1, len(w) - k + 2), lambda i: array_to_string(w[i : i + k - 1], ' '))) AS t FROM docs, sizes WHERE len(w) >= k
), hits AS (SELECT r, i, p.k, item_id FROM places p JOIN windows USING (k, t)
), hit AS (SELECT r, count(DISTINCT place) AS n_hit FROM (SELECT r, unnest(range(i, i + k)) AS place FROM (SELECT DISTINCT r, i, k FROM hits)) GROUP BY r
), named AS (SELECT r, count(*) AS n_items, string_agg(item_id, ',' ORDER BY item_id) AS ids FROM (SELECT DISTINCT r, item_id FROM hits) GROUP BY r)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items, sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM docs LEFT JOIN hit USING (r) LEFT JOIN named USING (r)
"""


#: Fixed values of the contract, written out here and not taken from the operator.
PHRASES = (("under the mit license", "mit"), ("apache license version 2", "apache-2"), ("cc by nc", "cc-by-nc"))


def stands(words: list[str], at: str) -> str:
    """Whether ``words`` stand at the 0-based place ``at``."""
    return " AND ".join(f"w[{at} + {j + 1}] = '{x}'" for j, x in enumerate(words))


def starts(template: Template) -> str:
    """SQL for the list of a template's starts."""
    words = template.words.split()
    need = max(1, int(template.share * len(words) + 0.999))
    (first, phrase), *others = template.keys
    found = f"list_transform(list_filter(range(0, len(w)), lambda p: {stands(phrase.split(), 'p')}), lambda p: p - {first})"
    whole = "".join(f" AND {stands(x.split(), f's + {at}')}" for at, x in others)
    return f"list_filter({found}, lambda s: {in_place(words, 's')} >= {need}{whole})"


def in_place(words: list[str], s: str) -> str:
    return "(" + " + ".join(f"CASE WHEN {s} + {j} >= 0 AND w[{s} + {j + 1}] = '{x}' THEN 1 ELSE 0 END" for j, x in enumerate(words)) + ")"


def op7(templates: tuple[Template, ...] = TEMPLATES, notices: tuple[Template, ...] = NOTICES) -> str:
    columns = [f"list_filter(range(0, len(w)), lambda p: {stands(p.split(), 'p')}) AS b{k}" for k, (p, _) in enumerate(PHRASES)]
    columns += [f"{starts(t)} AS t{k}" for k, t in enumerate(templates)]
    columns += [f"contains(flat, ' {t.words} ') AS c{k}" for k, t in enumerate(notices)]
    every = " || ".join(f"b{k}" for k in range(len(PHRASES)))
    from_base = [f"CASE WHEN len(b{k}) > 0 THEN ['{label}'] ELSE [] END" for k, (_, label) in enumerate(PHRASES)]
    from_method = [f"CASE WHEN len(t{k}) > 0 THEN ['{t.label}'] ELSE [] END" for k, t in enumerate(templates)] + [f"CASE WHEN c{k} THEN ['{t.label}'] ELSE [] END" for k, t in enumerate(notices)]
    shares = [f"coalesce(list_max(list_transform(t{k}, lambda s: {in_place(t.words.split(), 's')} / {len(t.words.split())}::DOUBLE)), 0.0::DOUBLE)" for k, t in enumerate(templates)]
    whole = " OR ".join([f"len({every}) > 0", *[f"c{k}" for k in range(len(notices))]])
    return f"""
WITH docs AS (SELECT doc_id, w, ' ' || array_to_string(w, ' ') || ' ' AS flat FROM (SELECT doc_id, regexp_extract_all({LOWERED}, '{ALNUM}') AS w FROM documents)
), found AS (SELECT doc_id, w, {", ".join(columns)} FROM docs)
SELECT doc_id, len(w)::BIGINT AS n_words, len({every})::BIGINT AS n_base, list_min({every})::BIGINT AS first_word, list_max({every})::BIGINT AS last_word,
  coalesce(array_to_string(list_sort(list_distinct({" || ".join(from_base)})), ','), '') AS base_labels,
  coalesce(array_to_string(list_sort(list_distinct({" || ".join(from_base + from_method)})), ','), '') AS labels,
  CASE WHEN {whole} THEN 1.0::DOUBLE ELSE greatest({", ".join(shares)}) END AS score
FROM found
"""


#: Holds where, as in the tables at hand, a page's main text is one article element with paragraphs, headings, bold text and line ends.
OP10 = r"""
WITH inside AS (
  SELECT page_id, url, regexp_replace(regexp_extract(coalesce(html, ''), '(?s)<article[^>]*>(.*)</article>', 1), '(?s)<!--.*?-->|<script.*?</script>|<style.*?</style>|</?b>', '', 'g') AS h FROM pages
), bare AS (
  SELECT page_id, url, replace(replace(replace(replace(regexp_replace(h, '<[^>]*>', ' ', 'g'), '&lt;', '<'), '&gt;', '>'), '&quot;', '"'), '&#x27;', chr(39)) AS t FROM inside
), texts AS (SELECT page_id, url, trim(regexp_replace(regexp_replace(t, '&amp;?', '&', 'g'), '\s+', ' ', 'g')) AS text FROM bare)
SELECT page_id, url, text, length(text)::BIGINT AS n_chars FROM texts
"""

ORACLES = {"op2_mixing": OP2, "op3_near_dedup": OP3, "op4_quality": OP4, "op7_licenses": op7(), "op8_decontamination": OP8, "op10_html_extraction": OP10}
