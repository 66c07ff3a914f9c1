"""The registered queries of the entity engine, each over whole tables, with their DuckDB forms.  Those of file formats are in ``formats``."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loamline.functions import language
from loamline.functions import text as T
from loamline.model import entity_id, merge_values
from loamline.operators import relational as R
from loamline.plans import formats, ingest, streams  # noqa: F401  formats and streams register their own queries
from loamline.plans.analyze import analyze
from loamline.plans.analyze import returned_ids as analyzed_ids
from loamline.plans.registered import ORACLES, QUERIES, query, table
from loamline.registry import EXTRACTORS, FAMILY_BIDS
from loamline.sources.base import File
from loamline.sources.documents import header_fields, json_strings, read_page
from loamline.sources.mail import rfc822

def found_sql(pattern: str) -> str:
    return f"""SELECT doc_id, unnest(m) AS match, unnest(range(0, len(m)))::INTEGER AS pos FROM (SELECT doc_id, regexp_extract_all(text, '(?i){pattern}', 0) AS m FROM documents)"""


def found(spark: SparkSession, sf_dir: str, pattern: str) -> DataFrame:
    return table(spark, sf_dir, "documents").select("doc_id", F.posexplode(T.matches(F.col("text"), pattern)).alias("pos", "match"))


@query(found_sql(T.EMAIL))
def pattern_email(spark: SparkSession, sf_dir: str) -> DataFrame:
    return found(spark, sf_dir, T.EMAIL)


@query(found_sql(T.PHONE))
def pattern_phone(spark: SparkSession, sf_dir: str) -> DataFrame:
    return found(spark, sf_dir, T.PHONE)


@query(found_sql(T.IBAN))
def pattern_iban(spark: SparkSession, sf_dir: str) -> DataFrame:
    return found(spark, sf_dir, T.IBAN)


IBAN_OK = """(length(flat) BETWEEN 15 AND 34 AND list_reduce(list_prepend(0, list_transform(string_split(flat[5:34] || flat[1:4], ''), lambda c: CASE WHEN c BETWEEN '0' AND '9' THEN ascii(c) - 48 ELSE ascii(c) - 55 END)),
  lambda a, d: (a * (CASE WHEN d < 10 THEN 10 ELSE 100 END) + d) % 97) = 1)"""
CODES_SQL = "(VALUES " + ", ".join(f"('{k}', '{v}')" for k, v in T.CALLING_CODES.items()) + ")"
TAGS_SQL = f"""
WITH found AS (
  SELECT doc_id, 'emailMentioned' AS prop, 0::BIGINT AS kind, regexp_extract_all(text, '(?i){T.EMAIL}', 0) AS m FROM documents
  UNION ALL SELECT doc_id, 'phoneMentioned', 1::BIGINT, regexp_extract_all(text, '(?i){T.PHONE}', 0) FROM documents
  UNION ALL SELECT doc_id, 'ibanMentioned', 2::BIGINT, regexp_extract_all(text, '(?i){T.IBAN}', 0) FROM documents
), matches AS (SELECT doc_id, prop, kind, unnest(m) AS match, unnest(range(0, len(m))) AS i FROM found
), bare AS (
  SELECT *, lower(split_part(match, '@', -1)) AS domain, split_part(match, '@', 1) AS name, upper(replace(match, ' ', '')) AS flat,
    regexp_replace(regexp_replace(regexp_replace(match, '\\(0\\)', '', 'g'), '[^\\d+]', '', 'g'), '^00', '+') AS number FROM matches
), clean AS (
  SELECT doc_id, prop, 2 * (kind * 1099511627776 + i) AS pos, CASE
    WHEN prop = 'emailMentioned' AND length(name) <= 64 AND regexp_full_match(domain, '[a-z0-9]([a-z0-9-]*[a-z0-9])?(\\.[a-z0-9]([a-z0-9-]*[a-z0-9])?)*\\.[a-z]{{2,63}}') THEN name || '@' || domain
    WHEN prop = 'phoneMentioned' AND regexp_full_match(number, '\\+[1-9]\\d{{7,14}}') THEN number
    WHEN prop = 'ibanMentioned' AND {IBAN_OK} THEN flat END AS value FROM bare
), hints AS (
  SELECT c.doc_id, 'detectedCountry' AS prop, pos + 1 AS pos, CASE WHEN prop = 'ibanMentioned' THEN lower(value[1:2]) ELSE coalesce(three.country, two.country) END AS value
  FROM clean c LEFT JOIN {CODES_SQL} three(code, country) ON prop = 'phoneMentioned' AND value[2:4] = three.code LEFT JOIN {CODES_SQL} two(code, country) ON prop = 'phoneMentioned' AND value[2:3] = two.code
  WHERE prop <> 'emailMentioned'
), tags AS (SELECT * FROM clean WHERE value IS NOT NULL UNION ALL SELECT * FROM hints WHERE value IS NOT NULL)
"""


def doc_tags(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return R.pattern_tags(docs.select(F.col("doc_id").alias("entity_id"), "text"))


@query(TAGS_SQL + "SELECT doc_id, prop, count(DISTINCT lower(value)) AS n_keys, count(*) AS n_values FROM tags GROUP BY doc_id, prop")
def tag_counts_by_doc(spark: SparkSession, sf_dir: str) -> DataFrame:
    groups = R.group_tags(doc_tags(spark, sf_dir))
    return groups.groupBy(F.col("entity_id").alias("doc_id"), "prop").agg(F.count(F.lit(1)).alias("n_keys"), F.sum("n").alias("n_values"))


@query(TAGS_SQL + "SELECT doc_id, prop, lower(value) AS key, arg_min(value, pos) AS label FROM tags GROUP BY ALL")
def tag_first_label(spark: SparkSession, sf_dir: str) -> DataFrame:
    return R.group_tags(doc_tags(spark, sf_dir)).select(F.col("entity_id").alias("doc_id"), "prop", "key", "label")


@query("""
WITH tags AS (SELECT source, doc_id, key, row_number() OVER (PARTITION BY source ORDER BY first_pos, key) AS place
  FROM (SELECT source, lower(lang) || '-' || n_chars AS key, min(doc_id) AS first_pos, min(doc_id) AS doc_id FROM documents WHERE source IS NOT NULL AND lang IS NOT NULL AND n_chars IS NOT NULL GROUP BY ALL))
SELECT source, key, doc_id AS first_pos FROM tags WHERE place <= 21""")
def tag_cap(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The cap on tag keys of an entity at work: each source's first 20 + 1 keys of language and length."""
    value = F.concat_ws("-", "lang", F.col("n_chars").cast("string"))
    tags = table(spark, sf_dir, "documents").where("source is not null and lang is not null and n_chars is not null").select(F.col("source").alias("entity_id"), F.col("doc_id").alias("pos"), F.lit("tag").alias("prop"), value.alias("value"))
    return R.group_tags(tags, cap=20).select(F.col("entity_id").alias("source"), "key", "first_pos")


@query(TAGS_SQL + """, grouped AS (SELECT doc_id, prop, lower(value) AS key FROM tags WHERE prop IN ('emailMentioned', 'ibanMentioned') GROUP BY ALL
), countries AS (SELECT doc_id, string_agg(DISTINCT value, ',' ORDER BY value) AS countries FROM tags WHERE prop = 'detectedCountry' GROUP BY doc_id)
SELECT sha1('mention' || chr(31) || doc_id || chr(31) || prop || chr(31) || key) AS id, doc_id AS document, sha1(key) AS resolved, CASE prop WHEN 'emailMentioned' THEN 'Person' ELSE 'Organization' END AS schema, coalesce(countries, '') AS countries
FROM grouped LEFT JOIN countries USING (doc_id)""")
def mention_rollup(spark: SparkSession, sf_dir: str) -> DataFrame:
    tags = doc_tags(spark, sf_dir)
    groups = tags.withColumn("key", R.node_key(F.col("value"))).groupBy("entity_id", "prop", "key").agg(F.collect_set("value").alias("values"))
    schemas = table(spark, sf_dir, "documents").select(F.col("doc_id").alias("entity_id"), F.lit("PlainText").alias("schema")).distinct()
    out = R.mentions(groups, schemas, R.countries(tags), {"emailMentioned": "Person", "ibanMentioned": "Organization"})
    return out.select("id", "document", "resolved", F.col("detectedSchema").alias("schema"), F.array_join("contextCountry", ",").alias("countries"))


@query(r"""SELECT doc_id, k::INTEGER AS pos, length(chunk)::INTEGER AS n, sha1(chunk) AS digest FROM (
  SELECT doc_id, k, flat[k * 25000 + 1 : k * 25000 + 25000] AS chunk FROM (SELECT doc_id, trim(regexp_replace(text, '\s+', ' ', 'g')) AS flat FROM documents), range(0, 1000) AS r(k)
  WHERE length(flat) >= 5 AND k * 25000 < length(flat))""")
def text_chunks(spark: SparkSession, sf_dir: str) -> DataFrame:
    pieces = table(spark, sf_dir, "documents").select("doc_id", F.posexplode(T.chunks(F.col("text"))).alias("pos", "chunk"))
    return pieces.select("doc_id", "pos", F.length("chunk").alias("n"), F.sha1(F.col("chunk").cast("binary")).alias("digest"))


@query(rf"""SELECT o_orderkey, value FROM (SELECT o_orderkey, unnest([o_orderkey::VARCHAR, o_orderstatus, o_totalprice::VARCHAR, o_orderpriority, ' ', '1_000', 'nan', '12d', '-.5e3', 'Infinity']) AS value FROM orders)
WHERE value IS NOT NULL AND trim(value) <> '' AND NOT regexp_matches(value, '(?i){T.NUMBER}')""")
def filter_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    fixed = [F.lit(x) for x in (" ", "1_000", "nan", "12d", "-.5e3", "Infinity")]
    texts = F.array(F.col("o_orderkey").cast("string"), "o_orderstatus", F.col("o_totalprice").cast("string"), "o_orderpriority", *fixed)
    return table(spark, sf_dir, "orders").select("o_orderkey", F.explode(T.filter_texts(texts)).alias("value"))


@query("SELECT n_nationkey, n_name AS texts FROM nation WHERE n_name IS NOT NULL AND trim(n_name) <> ''")
def row_text_fragments(spark: SparkSession, sf_dir: str) -> DataFrame:
    nation = table(spark, sf_dir, "nation")
    return R.row_fragments(nation, ["n_nationkey"]).select("n_nationkey", F.array_join("texts", " | ").alias("texts"))


def metadata_sql(name: str, columns: list[str]) -> str:
    line = " || ',' || ".join(f"""'"' || replace(coalesce({c}::VARCHAR, ''), '"', '""') || '"'""" for c in columns)
    header = "[" + ", ".join(f'"Column {k + 1}"' for k in range(len(columns))) + "]"
    return f"""SELECT '{name}' AS title, '{header}' AS columns, count(*) + 1 AS "rowCount", coalesce(sum(('0x' || sha1({line})[1:15])::BIGINT::HUGEINT), 0)::VARCHAR AS digest FROM {name}"""


@query(" UNION ALL ".join([metadata_sql("region", ["r_regionkey", "r_name"]), metadata_sql("nation", ["n_nationkey", "n_name", "n_regionkey"]), metadata_sql("labels", ["doc_id", "quality", "toxic"])]))
def table_metadata(spark: SparkSession, sf_dir: str) -> DataFrame:
    first, *others = (R.table_metadata(table(spark, sf_dir, t), t) for t in ("region", "nation", "labels"))
    for o in others:
        first = first.unionByName(o)
    return first


@query("SELECT 's' || s_suppkey AS id, s_name AS texts FROM supplier WHERE s_name IS NOT NULL AND trim(s_name) <> '' UNION ALL SELECT 'r' || r_regionkey, r_name FROM region WHERE r_name IS NOT NULL AND trim(r_name) <> ''")
def more_row_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = [R.row_fragments(table(spark, sf_dir, t), [k]).select(F.concat(F.lit(k[0]), F.col(k).cast("string")).alias("id"), F.array_join("texts", " | ").alias("texts")) for t, k in (("supplier", "s_suppkey"), ("region", "r_regionkey"))]
    return rows[0].unionByName(rows[1])


@query(metadata_sql("supplier", ["s_suppkey", "s_name", "s_nationkey"]) + " UNION ALL " + metadata_sql("customer", ["c_custkey", "c_name", "c_nationkey", "c_mktsegment"]))
def more_table_metadata(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tables less their amounts, whose text differs between engines."""
    supplier, customer = (R.table_metadata(table(spark, sf_dir, t).drop(c), t) for t, c in (("supplier", "s_acctbal"), ("customer", "c_acctbal")))
    return supplier.unionByName(customer)


BIDS_SQL = "(VALUES " + ", ".join(
    [f"('mime', '{m.lower()}', '{e.name}', {e.score}, {k})" for k, e in enumerate(EXTRACTORS) for m in e.mimes] + [f"('ext', '{x}', '{e.name}', {e.score}, {k})" for k, e in enumerate(EXTRACTORS) for x in e.extensions]
) + ") b(kind, key, extractor, score, ordinal)"
FAMILY_SQL = " UNION ALL ".join(
    f"SELECT id, '{name}', {score}, {[e.name for e in EXTRACTORS].index(name)} FROM files f WHERE mime LIKE '{family}%' AND NOT EXISTS (FROM regular r WHERE r.id = f.id AND r.extractor = '{name}')" for name, family, score in FAMILY_BIDS
)
MIMES = ("text/plain", "application/zip", "image/webp", "text/javascript", "application/vnd.ms-outlook", "audio/x-aiff", "application/octet-stream")
SUFFIXES = ("txt", "json", "ics", "msg", "otp", "xls", "eml", "7z", "unknown", "html", "dbf")
MIME_OF = "[" + ", ".join(f"'{m}'" for m in MIMES) + f", NULL][doc_id % {len(MIMES) + 1} + 1]"
SUFFIX_OF = "[" + ", ".join(f"'{m}'" for m in SUFFIXES) + f"][doc_id % {len(SUFFIXES)} + 1]"


@query(f"""
WITH files AS (
  SELECT 'p' || page_id AS id, regexp_extract(url, '([^/?#]*)(?:[?#].*)?$', 1) AS name, NULL AS mime, 1 AS n FROM pages
  UNION ALL SELECT 'd' || doc_id, 'file-' || doc_id || '.' || {SUFFIX_OF}, {MIME_OF}, coalesce(n_chars, 0) FROM documents
), offers AS (
  SELECT id, extractor, score, ordinal FROM files JOIN {BIDS_SQL} ON (kind = 'mime' AND key = mime) OR (kind = 'ext' AND key = lower(regexp_extract(name, '\\.([^./\\\\]+)$', 1)))
), regular AS (SELECT * FROM offers
), every AS (SELECT * FROM offers UNION ALL {FAMILY_SQL} UNION ALL SELECT id, 'ignore', 200, 0 FROM files WHERE n = 0)
SELECT f.id, arg_max(extractor, score * 1000 - ordinal) AS extractor, max(score)::INTEGER AS score FROM files f LEFT JOIN every e USING (id) GROUP BY f.id""")
def auction(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages").select(
        F.concat(F.lit("p"), "page_id").alias("id"), F.regexp_extract("url", r"([^/?#]*)(?:[?#].*)?$", 1).alias("file_name"), F.lit(None).cast("string").alias("mime"), F.lit(1).cast("long").alias("file_size")
    )
    pick = lambda values: F.get(F.array(*[F.lit(v) for v in values]), (F.col("doc_id") % len(values)).cast("int"))
    docs = table(spark, sf_dir, "documents").select(
        F.concat(F.lit("d"), "doc_id").alias("id"), F.concat(F.lit("file-"), "doc_id", F.lit("."), pick(SUFFIXES)).alias("file_name"), pick([*MIMES, None]).alias("mime"), F.coalesce("n_chars", F.lit(0)).alias("file_size")
    )
    return R.auction(pages.unionByName(docs)).select("id", "extractor", "score")


def page_fields(spark: SparkSession, sf_dir: str) -> DataFrame:
    """page_id, title, lang, text of each page, from one parse."""
    import pyarrow as pa

    def run(batches):
        for batch in batches:
            pages = [read_page(h or "") for h in batch.column(1).to_pylist()]
            heads = [header_fields(p) for p in pages]
            columns = [batch.column(0), pa.array([(h.get("title") or [None])[0] for h in heads], pa.string()), pa.array([p.lang for p in pages], pa.string()), pa.array([p.text() for p in pages], pa.string())]
            yield pa.RecordBatch.from_arrays(columns, names=["page_id", "title", "lang", "text"])

    return table(spark, sf_dir, "pages").select("page_id", "html").mapInArrow(run, "page_id long, title string, lang string, text string")


@query(r"""SELECT page_id, trim(regexp_replace(replace(replace(replace(replace(regexp_extract(html, '<title>([^<]*)</title>', 1), '&lt;', '<'), '&gt;', '>'), '&quot;', '"'), '&amp;', '&'), '\s+', ' ', 'g')) AS title FROM pages""")
def html_title(spark: SparkSession, sf_dir: str) -> DataFrame:
    return page_fields(spark, sf_dir).select("page_id", "title")


@query("SELECT page_id, regexp_extract(html, '<html lang=\"([^\"]*)\"', 1) AS lang FROM pages")
def html_lang(spark: SparkSession, sf_dir: str) -> DataFrame:
    return page_fields(spark, sf_dir).select("page_id", F.coalesce("lang", F.lit("")).alias("lang"))


#: Text of the pages of the tables at hand: all outside the head, comments too, without tags.
PAGE_TEXT_SQL = r"""(SELECT page_id, html, trim(regexp_replace(replace(replace(replace(replace(replace(replace(
  regexp_replace(regexp_replace(regexp_replace(coalesce(html, ''), '(?s)<head>.*?</head>', ' '), '(?s)<!--(.*?)-->', ' \1 ', 'g'), '<[^>]*>', ' ', 'g'),
  '&copy;', '©'), '&middot;', '·'), '&lt;', '<'), '&gt;', '>'), '&quot;', '"'), '&amp;', '&'), '[\s\p{Z}]+', ' ', 'g')) AS text FROM pages)"""


@query(f"SELECT page_id, text FROM {PAGE_TEXT_SQL}")
def html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return page_fields(spark, sf_dir).select("page_id", "text")


@query("SELECT conv_id, turn, unnest([role, text, role])  AS value, unnest([0, 1, 2])::INTEGER AS pos FROM conversations WHERE role IS NOT NULL AND text IS NOT NULL")
def json_string_values(spark: SparkSession, sf_dir: str) -> DataFrame:
    """String values, depth first, of objects that hold texts, numbers and lists."""

    @F.pandas_udf("array<string>")
    def values(raw):
        return raw.map(json_strings)

    packed = F.to_json(F.struct("role", F.array("text").alias("parts"), "turn", F.struct(F.col("role").alias("r"), F.lit(1.5).alias("x")).alias("more")))
    rows = table(spark, sf_dir, "conversations").where("role is not null and text is not null")
    return rows.select("conv_id", "turn", F.posexplode(values(packed)).alias("pos", "value"))


@query("SELECT sha1(text) AS content_hash, count(*) AS copies, min(doc_id) AS first_doc FROM documents GROUP BY 1")
def content_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select(F.sha1(F.col("text").cast("binary")).alias("content_hash"), "doc_id")
    return docs.groupBy("content_hash").agg(F.count(F.lit(1)).alias("copies"), F.min("doc_id").alias("first_doc"))


def messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Conversations as messages: each turn replies to the one before."""
    rows = table(spark, sf_dir, "conversations")
    mid = lambda t: F.concat(F.lit("<turn-"), t.cast("string"), F.lit("@"), F.col("conv_id").cast("string"), F.lit(".example>"))
    return rows.select("conv_id", "turn", "text", mid(F.col("turn")).alias("id_header"), F.concat(F.lit("<x> "), mid(F.col("turn") - 1)).alias("references"))


@query("SELECT DISTINCT a.conv_id || ':' || a.turn AS entity_id, b.conv_id || ':' || b.turn AS reply_to FROM conversations a JOIN conversations b ON a.conv_id = b.conv_id AND a.turn - 1 = b.turn")
def thread_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = messages(spark, sf_dir).select(
        F.lit("all").alias("collection"), F.concat_ws(":", "conv_id", "turn").alias("entity_id"), F.get(T.message_ids(F.col("id_header")), F.lit(0)).alias("message_id"),
        T.reply_target(F.col("references"), F.lit(None).cast("string")).alias("in_reply_to"),
    )
    return R.thread_links(rows).select("entity_id", "reply_to")


@query("""SELECT conv_id, turn, 'Turn ' || turn AS subject, 'turn-' || turn || '@' || conv_id || '.example' AS message_id, 'turn-' || (turn - 1) || '@' || conv_id || '.example' AS in_reply_to,
  'Ann Smith <ann@example.org>' AS sender FROM conversations""")
def mail_fields(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fields of conversations sent as mail, through the message extractor."""
    import pyarrow as pa

    def run(batches):
        for batch in batches:
            mails = [rfc822(File("m", None, raw)).props for raw in batch.column(2).to_pylist()]
            first = lambda prop: pa.array([m.get(prop, [None])[0] for m in mails], pa.string())  # noqa: B023, E731
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), first("subject"), first("messageId"), first("inReplyTo"), first("from")], names=["conv_id", "turn", "subject", "message_id", "in_reply_to", "sender"])

    lines = F.concat(F.lit("From: Ann Smith <ann@example.org>\nSubject: Turn "), F.col("turn").cast("string"), F.lit("\nMessage-ID: "), "id_header", F.lit("\nReferences: "), "references", F.lit("\nContent-Type: text/plain; charset=utf-8\nContent-Transfer-Encoding: 8bit\n\n"), F.coalesce("text", F.lit("")))
    rows = messages(spark, sf_dir).select("conv_id", "turn", lines.cast("binary").alias("raw"))
    return rows.mapInArrow(run, "conv_id long, turn long, subject string, message_id string, in_reply_to string, sender string")


TREE_SQL = """nodes AS (
  SELECT 'r' || r_regionkey AS id, NULL AS parent FROM region UNION ALL SELECT 'n' || n_nationkey, 'r' || n_regionkey FROM nation
  UNION ALL SELECT 'c' || c_custkey, 'n' || c_nationkey FROM customer UNION ALL SELECT 'o' || o_orderkey, 'c' || o_custkey FROM orders)"""


@query(f"""WITH RECURSIVE {TREE_SQL}, up AS (
  SELECT id, parent AS ancestor, 1 AS distance FROM nodes WHERE parent IS NOT NULL UNION ALL SELECT u.id, n.parent, distance + 1 FROM up u JOIN nodes n ON u.ancestor = n.id WHERE n.parent IS NOT NULL)
SELECT id, ancestor, distance FROM up""")
def folder_ancestors(spark: SparkSession, sf_dir: str) -> DataFrame:
    level = lambda t, p, key, q, up: table(spark, sf_dir, t).select(F.concat(F.lit(p), F.col(key).cast("string")).alias("id"), (F.concat(F.lit(q), F.col(up).cast("string")) if up else F.lit(None).cast("string")).alias("parent"))
    nodes = level("region", "r", "r_regionkey", "", None).unionByName(level("nation", "n", "n_nationkey", "r", "n_regionkey"))
    return R.ancestors(nodes.unionByName(level("customer", "c", "c_custkey", "n", "c_nationkey")).unionByName(level("orders", "o", "o_orderkey", "c", "o_custkey")))


@query(r"""WITH paths AS (SELECT DISTINCT regexp_replace(regexp_replace(url, '^https?://', ''), '[?#].*$', '') AS path FROM pages
), parts AS (SELECT string_split(path, '/') AS p FROM paths
), cuts AS (SELECT p, unnest(range(1, len(p))) AS k FROM parts
), named AS (SELECT p, k, list_filter(range(1, k), lambda j: p[j] NOT IN ('en', 'de')) AS above FROM cuts WHERE p[k] NOT IN ('en', 'de'))
SELECT DISTINCT array_to_string(p[1:k], '/') AS folder, CASE WHEN len(above) > 0 THEN array_to_string(p[1:list_max(above)], '/') END AS parent, p[k] AS name FROM named""")
def folder_closure(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = F.regexp_replace(F.regexp_replace("url", "^https?://", ""), "[?#].*$", "")
    return R.folder_closure(table(spark, sf_dir, "pages").select(path.alias("path")).distinct(), ("en", "de"))


MERGE_SQL = """
SELECT entity_id, prop, array_to_string(list_sort(list_distinct(list(value))), '|') AS vals FROM (
  SELECT doc_id AS entity_id, 'language' AS prop, lang AS value FROM documents UNION ALL SELECT doc_id, 'source', source FROM documents
  UNION ALL SELECT doc_id, 'quality', quality::VARCHAR FROM labels UNION ALL SELECT conv_id, 'role', role FROM conversations UNION ALL SELECT page_id, 'sourceUrl', url FROM pages) WHERE value IS NOT NULL GROUP BY ALL"""


@query(MERGE_SQL)
def fragment_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    part = lambda t, key, prop, value: table(spark, sf_dir, t).select(F.col(key).alias("entity_id"), F.lit(prop).alias("prop"), F.col(value).cast("string").alias("value"))
    parts = [part("documents", "doc_id", "language", "lang"), part("documents", "doc_id", "source", "source"), part("labels", "doc_id", "quality", "quality"), part("conversations", "conv_id", "role", "role"), part("pages", "page_id", "sourceUrl", "url")]
    rows = parts[0]
    for p in parts[1:]:
        rows = rows.unionByName(p)
    return merge_values(rows.where("value is not null")).select("entity_id", "prop", F.array_join("values", "|").alias("vals"))


@query("SELECT l_orderkey, l_linenumber, o_orderstatus, o_orderpriority FROM lineitem LEFT JOIN orders ON l_orderkey = o_orderkey")
def inherit_metadata(spark: SparkSession, sf_dir: str) -> DataFrame:
    sheets = table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("parent_id"), "l_linenumber")
    books = table(spark, sf_dir, "orders").withColumnRenamed("o_orderkey", "id")
    return R.inherit(sheets, books, ["o_orderstatus", "o_orderpriority"]).withColumnRenamed("parent_id", "l_orderkey")


@query("""SELECT coalesce(lang, 'none') AS extractor, count(*) FILTER (octet_length(encode(text)) BETWEEN 1 AND 4194304) AS succeeded, count(*) FILTER (text IS NULL OR octet_length(encode(text)) NOT BETWEEN 1 AND 4194304) AS failed,
  coalesce(sum(octet_length(encode(text))), 0)::BIGINT AS bytes, """ + ", ".join(f"count(*) FILTER (octet_length(encode(text)) / 20000.0::DOUBLE <= {b}) AS le_{str(b).replace('.', '_')}" for b in R.DURATION_BOUNDS) + " FROM documents GROUP BY 1")
def status_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    size = F.octet_length("text")
    runs = table(spark, sf_dir, "documents").select(
        F.col("lang").alias("extractor"), F.when(size.between(1, 4 << 20), F.lit("success")).otherwise(F.lit("failure")).alias("status"), size.cast("long").alias("file_size"), (size / 20000.0).alias("seconds")
    )
    return R.metrics(runs)


@query("SELECT o_orderkey, CASE WHEN o_orderkey % 8 >= 6 THEN date_trunc('day', o_orderdate) ELSE date_trunc('second', o_orderdate) END AS ts FROM orders")
def timestamp_formats(spark: SparkSession, sf_dir: str) -> DataFrame:
    forms = ["yyyy-MM-dd'T'HH:mm:ss", "yyyy-MM-dd HH:mm:ss.SSS", "yyyy:MM:dd HH:mm:ss", "yyyy-MM-dd'T'HH:mm:ss'Z'", "yyyy:MM:dd HH:mm:ss'Z'", "'UTC' yyyy-MM-dd HH:mm:ss", "yyyy-MM-dd", "yyyyMMdd"]
    rows = table(spark, sf_dir, "orders").select("o_orderkey", F.col("o_orderdate").cast("timestamp").alias("at"))
    raw = F.get(F.array(*[F.date_format("at", f) for f in forms]), (F.col("o_orderkey") % 8).cast("int"))
    return rows.select("o_orderkey", T.parse_timestamp(raw).cast("timestamp_ntz").alias("ts"))


@query()
def language_detect(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    chunks = docs.select(F.col("doc_id").cast("string").alias("entity_id"), F.posexplode(T.chunks(F.col("text"))).alias("pos", "chunk"))
    found_ = language.first_confident(language.detect_chunks(chunks, language.profiles(docs)))
    return found_.select(F.col("entity_id").cast("long").alias("doc_id"), "language", language.name_model(F.col("language")).alias("name_model"))


@query("SELECT sha1(text) AS key, EXISTS (FROM labels l JOIN documents c USING (doc_id) WHERE sha1(c.text) = sha1(d.text)) AS cached, count(*) AS n FROM documents d WHERE text IS NOT NULL GROUP BY ALL")
def cached_vs_todo(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents whose result a cache holds (that of the labelled ones), and those to do."""
    docs = table(spark, sf_dir, "documents").where("text is not null").select("doc_id", F.sha1(F.col("text").cast("binary")).alias("key"))
    cache = docs.join(table(spark, sf_dir, "labels"), "doc_id").select("key").distinct()
    cached, todo = R.split_by_cache(docs, cache, "key")
    both = cached.select("key", F.lit(True).alias("cached")).unionByName(todo.select("key", F.lit(False).alias("cached")))
    return both.groupBy("key", "cached").agg(F.count(F.lit(1)).alias("n"))


@query(r"""SELECT conv_id, turn, replace(trim(regexp_replace(replace(replace(replace(replace(replace(text, '&', '&amp;'), '<', '&lt;'), '>', '&gt;'), '"', '&quot;'), '''', '&#x27;'), '^\s+|\s+$', '', 'g')), chr(10), '<br>') AS html FROM conversations""")
def html_alternative(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "conversations").select("conv_id", "turn", T.html_escape(F.col("text")).alias("html"))


@query("""WITH w AS (SELECT l_suppkey AS key, l_returnflag AS label, count(*) AS n FROM lineitem GROUP BY ALL), p AS (SELECT *, n / sum(n) OVER (PARTITION BY key) AS p FROM w)
SELECT key, arg_max(label, n * 1000 + ascii(label)) AS label, round(1 + sum(p * ln(p)) / ln(3), 6) AS confidence FROM p GROUP BY key""")
def type_confidence(spark: SparkSession, sf_dir: str) -> DataFrame:
    counts = table(spark, sf_dir, "lineitem").groupBy(F.col("l_suppkey").alias("key"), F.col("l_returnflag").alias("label")).agg(F.count(F.lit(1)).alias("weight"))
    return R.type_confidence(counts, 3).select("key", "label", F.round("confidence", 6).alias("confidence"))


@query("""SELECT c_nationkey::VARCHAR AS entity_id, lower(c_mktsegment) AS key, count(DISTINCT c_name) AS n FROM customer WHERE c_mktsegment IS NOT NULL AND c_name IS NOT NULL GROUP BY ALL
HAVING bool_and(c_mktsegment <> 'trash' AND c_acctbal >= -990)""")
def confident_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Groups of names of which one doubtful value rejects all."""
    rows = table(spark, sf_dir, "customer").where("c_mktsegment is not null and c_name is not null")
    tags = rows.select(F.col("c_nationkey").cast("string").alias("entity_id"), F.col("c_mktsegment").alias("value"), F.col("c_name").alias("prop"), F.col("c_mktsegment").alias("label"), F.col("c_acctbal").alias("confidence"))
    sound = tags.withColumn("key", R.node_key(F.col("value"))).groupBy("entity_id", "key").agg(F.count_distinct("prop").alias("n"), F.every((F.col("label") != "trash") & (F.col("confidence") >= -990)).alias("ok"))
    return sound.where("ok").drop("ok")


@query("SELECT DISTINCT id FROM (SELECT sha1('doc' || chr(31) || doc_id) AS id FROM documents UNION ALL SELECT sha1('page' || chr(31) || page_id) FROM pages)")
def emitted_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select(entity_id(F.lit("doc"), F.col("doc_id")).alias("id"))
    return docs.unionByName(table(spark, sf_dir, "pages").select(entity_id(F.lit("page"), F.col("page_id")).alias("id"))).distinct()


@query("SELECT c_custkey, n_name AS country FROM customer JOIN nation ON c_nationkey = n_nationkey WHERE c_custkey % 9 <> 0")
def place_country(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Places, in any case and with any blanks, looked up in a gazetteer; places that it lacks have no country."""
    nation = table(spark, sf_dir, "nation")
    named = table(spark, sf_dir, "customer").join(nation, F.col("c_nationkey") == F.col("n_nationkey"))
    text = F.when(F.col("c_custkey") % 9 == 0, F.lit("nowhere")).when(F.col("c_custkey") % 2 == 0, F.concat(F.lit("  "), F.lower("n_name"), F.lit(" "))).otherwise(F.col("n_name"))
    found_ = R.place_countries(named.select(F.col("c_custkey").alias("entity_id"), text.alias("value")), nation.select(F.col("n_name").alias("name"), F.col("n_name").alias("country")))
    return found_.select(F.col("entity_id").alias("c_custkey"), "country")


@query("SELECT doc_id, CASE lang WHEN 'en' THEN 'eng' WHEN 'de' THEN 'deu' WHEN 'fr' THEN 'fra' WHEN 'es' THEN 'spa' END AS model FROM documents")
def name_models(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The model of names that a document's language chooses."""
    return table(spark, sf_dir, "documents").select("doc_id", language.name_model(F.col("lang")).alias("model"))


@query("SELECT o_orderkey, CASE o_orderkey % 4 WHEN 0 THEN strftime(o_orderdate, '%Y-%m-%dT00:00:00') WHEN 1 THEN strftime(o_orderdate, '%Y-%m-%dT%H:%M:%S') WHEN 2 THEN 'about ' || o_orderpriority END AS ts FROM orders")
def timestamp_or_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Timestamps as ISO text; what is none comes back as it is, blank text as null."""
    at = F.col("o_orderdate").cast("timestamp")
    raw = F.array(F.date_format(at, "yyyyMMdd"), F.date_format(at, "yyyy:MM:dd HH:mm:ss.SSS"), F.concat(F.lit("about "), "o_orderpriority"), F.lit("  "))
    return table(spark, sf_dir, "orders").select("o_orderkey", T.timestamp_or_raw(F.get(raw, (F.col("o_orderkey") % 4).cast("int"))).alias("ts"))


CHUNKS_SQL = r"""chunked AS (
  SELECT doc_id, k, flat[k * 25000 + 1 : k * 25000 + 25000] AS text FROM (SELECT doc_id, trim(regexp_replace(text, '\s+', ' ', 'g')) AS flat FROM documents WHERE text IS NOT NULL), range(0, 1000) AS r(k)
  WHERE length(flat) >= 5 AND k * 25000 < length(flat))"""
CHUNK_TAGS_SQL = "WITH " + CHUNKS_SQL + ", " + TAGS_SQL.strip().removeprefix("WITH ").replace("FROM documents", "FROM chunked").replace("SELECT doc_id, '", "SELECT doc_id, k, '").replace("SELECT doc_id, prop, kind, unnest", "SELECT doc_id, k, prop, kind, unnest").replace(
    "2 * (kind * 1099511627776 + i) AS pos", "2 * (k * 8796093022208 + kind * 1099511627776 + i) AS pos"
)


def doc_fragments(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents as texts, beside a table and a person with the same texts, which are not analysed."""
    text = lambda prop: F.create_map(F.lit(prop), F.array("text"))
    kinds = F.array(*[F.struct(F.lit(kind).alias("schema"), text(prop).alias("props"), F.lit(before).alias("before")) for kind, prop, before in (("PlainText", "bodyText", ""), ("Table", "indexText", "t"), ("Person", "summary", "p"))])
    rows = table(spark, sf_dir, "documents").where("text is not null").select("doc_id", F.explode(kinds).alias("k"))
    return rows.select(F.concat("k.before", F.col("doc_id").cast("string")).alias("entity_id"), F.lit("").alias("fragment"), "k.schema", "k.props")


@query(CHUNK_TAGS_SQL + ", keyed AS (SELECT doc_id, prop, lower(value) AS key, arg_min(value, pos) AS label FROM tags GROUP BY ALL) SELECT doc_id::VARCHAR AS entity_id, prop, label AS value, 'PlainText' AS schema FROM keyed")
def analyzed_tags(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The whole analysis of documents, chunk by chunk: each tag by its first value; tables and persons are left out."""
    return analyze(doc_fragments(spark, sf_dir)).tags.select("entity_id", "prop", "value", "schema")


def names_in(chunks: DataFrame) -> DataFrame:
    """Stands for a model of names: two words of which the first begins with a capital, with a label and a confidence by length."""
    found_ = chunks.select("entity_id", F.explode(F.regexp_extract_all("chunk", F.lit("[A-Z][a-z]+ [a-z]+"), F.lit(0))).alias("name"))
    named = found_.select("entity_id", T.clean_name(F.col("name")).alias("value")).where("value is not null")
    n = F.length("value")
    return named.select("entity_id", F.when(n % 2 == 0, "peopleMentioned").otherwise("companiesMentioned").alias("prop"), "value", F.when(n % 11 == 0, "trash").otherwise("person").alias("label"), (F.lit(0.8) + (n % 7) * 0.03).alias("confidence"))


MENTIONS_SQL = CHUNK_TAGS_SQL + """, countries AS (SELECT doc_id, string_agg(DISTINCT value, ',' ORDER BY value) AS countries FROM tags WHERE prop = 'detectedCountry' GROUP BY doc_id
), named AS (SELECT doc_id, unnest(regexp_extract_all(text, '[A-Z][a-z]+ [a-z]+')) AS value FROM chunked
), grouped AS (
  SELECT doc_id, CASE WHEN length(value) % 2 = 0 THEN 'peopleMentioned' ELSE 'companiesMentioned' END AS prop, lower(value) AS key, list_aggregate(list_sort(list(DISTINCT value)), 'string_agg', '|') AS names
  FROM named WHERE length(value) BETWEEN 5 AND 100 GROUP BY ALL HAVING bool_and(length(value) % 11 <> 0 AND length(value) % 7 >= 2)
), mentions AS (
  SELECT sha1('mention' || chr(31) || doc_id || chr(31) || prop || chr(31) || key) AS id, doc_id::VARCHAR AS document, sha1(key) AS resolved, names, CASE prop WHEN 'peopleMentioned' THEN 'Person' ELSE 'Organization' END AS schema, coalesce(countries, '') AS countries
  FROM grouped LEFT JOIN countries USING (doc_id))"""


@query(MENTIONS_SQL + " SELECT * FROM mentions")
def analyzed_mentions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Mentions of the names that a model gives: cleaned, grouped, doubtful groups dropped whole, with the countries of their document."""
    out = analyze(doc_fragments(spark, sf_dir), names=names_in).mentions
    return out.select("id", "document", "resolved", F.array_join("names", "|").alias("names"), F.col("detectedSchema").alias("schema"), F.array_join("contextCountry", ",").alias("countries"))


@query(MENTIONS_SQL + " SELECT id FROM mentions UNION SELECT doc_id::VARCHAR FROM documents")
def returned_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the analysis hands on: the ids that it was given, and those of the mentions."""
    given = table(spark, sf_dir, "documents").select(F.col("doc_id").cast("string").alias("entity_id"))
    return analyzed_ids(analyze(doc_fragments(spark, sf_dir), names=names_in), given).select(F.col("entity_id").alias("id"))


@query(f"""
SELECT sha1('doc-' || doc_id || '.txt' || chr(31) || sha1(coalesce(text, ''))) AS entity_id, CASE WHEN coalesce(text, '') = '' THEN 'Document' ELSE 'PlainText' END AS schema, 'success' AS status,
  octet_length(encode(coalesce(text, '')))::BIGINT AS file_size, CASE WHEN text <> '' THEN length(text)::INTEGER END AS n_text FROM documents
UNION ALL SELECT sha1('page-' || page_id || '.html' || chr(31) || sha1(html)), 'HyperText', 'success', octet_length(encode(html))::BIGINT, length(text)::INTEGER FROM {PAGE_TEXT_SQL}""")
def ingest_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents and pages as files through the whole of ingestion: one row for each entity."""
    docs = table(spark, sf_dir, "documents").select(F.concat(F.lit("doc-"), "doc_id", F.lit(".txt")).alias("file_name"), F.coalesce("text", F.lit("")).cast("binary").alias("content"))
    pages = table(spark, sf_dir, "pages").select(F.concat(F.lit("page-"), "page_id", F.lit(".html")).alias("file_name"), F.coalesce("html", F.lit("")).cast("binary").alias("content"))
    rows = docs.unionByName(pages).select(
        entity_id(F.col("file_name"), F.sha1("content")).alias("entity_id"), F.lit("Document").alias("schema"), "file_name", F.lit(None).cast("string").alias("mime"), "content",
        F.lit(None).cast("string").alias("parent"), F.array().cast("array<string>").alias("ancestors"),
    )
    out = ingest.ingest_files(rows)
    props = F.col("props")
    return out.fragments.select("entity_id", "schema", F.get(props["processingStatus"], F.lit(0)).alias("status"), F.get(props["fileSize"], F.lit(0)).cast("long").alias("file_size"), F.length(F.get(F.coalesce(props["bodyText"], props["indexText"]), F.lit(0))).alias("n_text"))
