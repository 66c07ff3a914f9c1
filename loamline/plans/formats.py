"""Queries that run each extractor, through the whole of ingestion, on files made of all rows of a table; their DuckDB forms tell from the rows
what must come out."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from loamline.model import merge
from loamline.operators.relational import auction
from loamline.functions import text as T
from loamline.plans import files as M
from loamline.plans.ingest import crawl, ingest, ingest_files
from loamline.plans.registered import query, table
from loamline.storage import shared_dir

US = "chr(31)"


def entities(files: DataFrame) -> DataFrame:
    """Merged entities of all that is in ``files``."""
    return merge(ingest_files(files).fragments)


def p(prop: str, sep: str = "|") -> Column:
    """The values of a property, sorted and joined; empty if there are none."""
    return F.array_join(F.coalesce(F.col("props")[prop], F.array().cast("array<string>")), sep)


def key(column: str = "fileName") -> Column:
    return F.regexp_replace(p(column), r"\..*$", "")


def rows_by(df: DataFrame, by: Column, into: str = "rows", **columns: str) -> DataFrame:
    """``key`` and the rows of each key in order of their first column, which all go into one file."""
    own = F.struct(*[F.col(c).alias(n) for n, c in columns.items()])
    return df.groupBy(by.cast("string").alias("key")).agg(F.array_sort(F.collect_list(own)).alias(into))


def block(by: Column, number: Column, size: int) -> Column:
    """``by`` and a block of ``size`` numbers, so that a file, which one task makes and reads, does not grow with the table."""
    return F.concat_ws(".", by.cast("string"), F.floor(number / size).cast("string"))


def customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rows_by(table(spark, sf_dir, "customer"), F.col("c_nationkey"), id="c_custkey", name="c_name", segment="c_mktsegment")


def tables_in(every: DataFrame) -> DataFrame:
    """Tables with the ``key`` of the workbook that they are in."""
    books = every.where("schema = 'Workbook'").select(F.col("entity_id").alias("parent"), key().alias("key"))
    return every.where("schema = 'Table'").withColumn("parent", p("parent")).join(books, "parent")


# Tables


@query("""SELECT c_nationkey::VARCHAR AS key, (count(*) + 1)::VARCHAR AS "rowCount", '["Column 1", "Column 2", "Column 3"]' AS columns, 'Table' AS schema,
  sha1(string_agg('"' || c_custkey || '","' || c_name || '","' || c_mktsegment || '"' || chr(10), '' ORDER BY c_custkey)) AS "csvHash" FROM customer GROUP BY c_nationkey""")
def csv_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    """CSV files without a header: width by the first row, empty rows dropped, hash of the table written anew."""
    out = entities(M.made(customers(spark, sf_dir), M.csv_of, ".csv"))
    return out.select(key().alias("key"), p("rowCount").alias("rowCount"), p("columns").alias("columns"), "schema", p("csvHash").alias("csvHash"))


@query("""SELECT c_nationkey::VARCHAR AS key, (row_number() OVER (PARTITION BY c_nationkey ORDER BY c_custkey))::VARCHAR AS fragment, c_name || '|' || c_mktsegment AS texts FROM customer""")
def csv_row_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A fragment for each row of a table: its texts without numbers."""
    fragments = ingest_files(M.made(customers(spark, sf_dir), M.csv_of, ".csv")).fragments
    named = fragments.where("fragment = ''").select("entity_id", key().alias("key"))
    return fragments.where("fragment <> ''").join(named, "entity_id").select("key", "fragment", p("indexText").alias("texts"))


@query("""WITH rows_ AS (
  SELECT n_regionkey AS r, 'nations' AS title, n_nationkey AS k, '"' || n_nationkey || '","' || n_name || '"' AS line FROM nation
  UNION ALL SELECT n_regionkey, 'all suppliers', s_suppkey, '"' || s_suppkey || '","' || s_name || '",""' FROM supplier JOIN nation ON s_nationkey = n_nationkey
), found AS (SELECT r, title, count(*) AS n, sha1(string_agg(line || chr(10), '' ORDER BY k)) AS h FROM rows_ GROUP BY ALL)
SELECT r_name AS key, title, (coalesce(n, 0) + 1)::VARCHAR AS "rowCount", CASE title WHEN 'nations' THEN '["n_key", "n_name"]' ELSE '["s_key", "s_name", "none"]' END AS columns, coalesce(h, '') AS "csvHash"
FROM region CROSS JOIN (VALUES ('nations'), ('all suppliers')) t(title) LEFT JOIN found ON r = r_regionkey AND found.title = t.title""".replace("SELECT r_name AS key, title", "SELECT r_name AS key, t.title").replace("CASE title", "CASE t.title"))
def sqlite_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Databases of a region's nations and suppliers: every table whose name is long enough."""
    nations = table(spark, sf_dir, "nation")
    own = rows_by(nations, F.col("n_regionkey"), "nations", id="n_nationkey", name="n_name")
    sold = rows_by(table(spark, sf_dir, "supplier").join(nations, F.col("s_nationkey") == F.col("n_nationkey")), F.col("n_regionkey"), "suppliers", id="s_suppkey", name="s_name")
    regions = table(spark, sf_dir, "region").select(F.col("r_regionkey").cast("string").alias("key"), "r_name").join(own, "key", "left").join(sold, "key", "left")
    empty = F.array().cast("array<struct<id:long,name:string>>")
    files = regions.select(F.col("r_name").alias("key"), F.coalesce(F.col("nations").cast("array<struct<id:long,name:string>>"), empty).alias("nations"), F.coalesce("suppliers", empty).alias("suppliers"))
    return tables_in(entities(M.made(files, M.sqlite_of, ".sqlite"))).select("key", p("title").alias("title"), p("rowCount").alias("rowCount"), p("columns").alias("columns"), p("csvHash").alias("csvHash"))


@query("""SELECT s_nationkey::VARCHAR AS key, (count(*) FILTER (s_suppkey % 7 <> 0) + 1)::VARCHAR AS "rowCount", '["ID", "NAME", "DAY"]' AS columns,
  coalesce(sha1(string_agg('"' || s_suppkey || '","' || s_name || '","2020-01-02"' || chr(10), '' ORDER BY s_suppkey) FILTER (s_suppkey % 7 <> 0)), '') AS "csvHash" FROM supplier GROUP BY s_nationkey""")
def dbf_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    """dBase files: named columns, days, and rows marked as deleted."""
    files = rows_by(table(spark, sf_dir, "supplier"), F.col("s_nationkey"), id="s_suppkey", name="s_name")
    return entities(M.made(files, M.dbf_of, ".dbf")).select(key().alias("key"), p("rowCount").alias("rowCount"), p("columns").alias("columns"), p("csvHash").alias("csvHash"))


DAY = "strftime(DATE '2020-01-01' + (k % 300)::INTEGER, '%Y-%m-%d') || 'T12:00:00'"


@query(f"""WITH rows_ AS (SELECT c_nationkey AS n, 'Customers' AS title, c_custkey AS k, c_name AS name FROM customer UNION ALL SELECT s_nationkey, 'Suppliers', s_suppkey, s_name FROM supplier)
SELECT n_nationkey::VARCHAR AS key, title, (count(*) + 1)::VARCHAR AS "rowCount", '["Column 1", "Column 2", "Column 3", "Column 4"]' AS columns,
  sha1(string_agg('"' || k || '","' || name || '","in-' || k % 3 || '","' || {DAY} || '"' || chr(10), '' ORDER BY k)) AS "csvHash", list_aggregate(list_sort(['Editor', any_value(n_name)]), 'string_agg', '|') AS author,
  '2020-01-02T03:04:05' AS "authoredAt", '2021-01-02T03:04:05' AS "modifiedAt", 'About Book ' || n_nationkey AS summary
FROM nation JOIN rows_ ON n = n_nationkey GROUP BY n_nationkey, title""")
def xlsx_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Workbooks of a nation's customers and suppliers: cells of each kind, chart sheets left out, the book's metadata on its sheets."""
    both = table(spark, sf_dir, "nation").select(F.col("n_nationkey").cast("string").alias("key"), F.col("n_name").alias("author"))
    sold = rows_by(table(spark, sf_dir, "supplier"), F.col("s_nationkey"), "suppliers", id="s_suppkey", name="s_name")
    own = rows_by(table(spark, sf_dir, "customer"), F.col("c_nationkey"), "customers", id="c_custkey", name="c_name")
    empty = F.array().cast("array<struct<id:long,name:string>>")
    files = both.join(own, "key", "left").join(sold, "key", "left").select("key", "author", F.coalesce("customers", empty).alias("customers"), F.coalesce("suppliers", empty).alias("suppliers"))
    out = tables_in(entities(M.made(files, M.xlsx_of, ".xlsx"))).where(p("csvHash") != "")
    return out.select("key", *[p(c).alias(c) for c in ("title", "rowCount", "columns", "csvHash", "author", "authoredAt", "modifiedAt", "summary")])


@query("""SELECT r_name AS key, n_name AS title, (count(*) + 1)::VARCHAR AS "rowCount", '["Column 1", "Column 2", "Column 3", "Column 4"]' AS columns,
  sha1(string_agg('"' || c_custkey || ' EUR","' || c_name || '","' || c_mktsegment || '","' || c_mktsegment || '"' || chr(10), '' ORDER BY c_custkey)) AS "csvHash", r_name AS author, 'Maker/1' AS generator, '2021-01-02T03:04:05' AS date
FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey GROUP BY r_name, n_name""")
def ods_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Workbooks of a region, a sheet for each nation: amounts with their currency, repeated cells, and the book's metadata on its sheets."""
    named = customers(spark, sf_dir).join(table(spark, sf_dir, "nation"), F.col("key") == F.col("n_nationkey").cast("string")).join(table(spark, sf_dir, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
    files = named.groupBy(F.col("r_name").alias("key")).agg(F.array_sort(F.collect_list(F.struct(F.col("n_name").alias("title"), "rows"))).alias("sheets"))
    return tables_in(entities(M.made(files, M.ods_of, ".ods"))).select("key", *[p(c).alias(c) for c in ("title", "rowCount", "columns", "csvHash", "author", "generator", "date")])


# Archives


def texts_by(spark: SparkSession, sf_dir: str, by: str, folder: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").where(F.col("text").isNotNull() & F.col(by).isNotNull() & F.col(folder).isNotNull())
    return rows_by(docs.withColumn("name", F.col("doc_id").cast("string")), block(F.col(by), F.col("doc_id"), 250), id="doc_id", name="name", folder=folder, text="text")


def members(files: DataFrame) -> DataFrame:
    """Texts of archives: the archive, the folder and the file that each is in."""
    every = entities(files)
    at = every.select(F.col("entity_id").alias("id"), p("fileName").alias("name"), p("parent").alias("up"), "schema")
    folders = at.where("schema = 'Folder'").alias("f").join(at.where("schema = 'Package'").alias("a"), F.col("f.up") == F.col("a.id")).select(F.col("f.id").alias("parent"), F.col("f.name").alias("folder"), F.col("a.name").alias("archive"))
    docs = every.where("schema = 'PlainText'").select(p("parent").alias("parent"), p("fileName").alias("name"), F.size(F.col("props")["ancestors"]).alias("depth"), F.sha1(p("bodyText").cast("binary")).alias("digest"))
    return docs.join(folders, "parent", "left").select(F.split("archive", r"\.")[0].alias("archive"), "folder", "name", "depth", "digest")


def members_sql(by: str, folder: str) -> str:
    return f"SELECT {by} AS archive, {folder} AS folder, doc_id || '.txt' AS name, 2::INTEGER AS depth, sha1(text) AS digest FROM documents WHERE text IS NOT NULL AND {by} IS NOT NULL AND {folder} IS NOT NULL"


@query(members_sql("source", "lang"))
def zip_members(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each source's documents in ZIP archives with folders, 250 numbers in each, beside members whose paths lead out of it or that a crawl leaves out."""
    return members(M.made(texts_by(spark, sf_dir, "source", "lang"), M.zip_of, ".zip"))


@query(members_sql("lang", "source"))
def tar_members(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each language's documents in tar archives, 250 numbers in each, beside a link."""
    return members(M.made(texts_by(spark, sf_dir, "lang", "source"), M.tar_of, ".tar"))


@query(members_sql("source", "lang"))
def tgz_members(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Compressed tar archives, which are unpacked as archives."""
    return members(M.made(texts_by(spark, sf_dir, "source", "lang"), M.tgz_of, ".tgz"))


def single_members(spark: SparkSession, sf_dir: str, build, ending: str) -> DataFrame:
    files = M.made(table(spark, sf_dir, "supplier").select(F.concat(F.lit("s"), "s_suppkey", F.lit(".txt")).alias("key"), F.concat(F.lit("text of "), "s_name").alias("text")), build, ending)
    every = entities(files)
    outer = every.where("schema = 'Package'").select(F.col("entity_id").alias("parent"), p("fileName").alias("archive"))
    return every.where("schema = 'PlainText'").select(p("parent").alias("parent"), p("fileName").alias("name"), p("bodyText").alias("text")).join(outer, "parent").drop("parent")


@query("SELECT 's' || s_suppkey || '.txt.gz' AS archive, 's' || s_suppkey || '.txt' AS name, 'text of ' || s_name AS text FROM supplier")
def gzip_members(spark: SparkSession, sf_dir: str) -> DataFrame:
    return single_members(spark, sf_dir, M.gzip_of, ".gz")


@query("SELECT 's' || s_suppkey || '.txt.bz2' AS archive, 's' || s_suppkey || '.txt' AS name, 'text of ' || s_name AS text FROM supplier")
def bzip2_members(spark: SparkSession, sf_dir: str) -> DataFrame:
    return single_members(spark, sf_dir, M.bzip2_of, ".bz2")


@query("""SELECT 'region=' || n_regionkey AS folder, count(*) AS n_lines, sha1(string_agg(n_name || chr(10), '' ORDER BY n_name)) AS digest, 'PlainText' AS schema, 1::INTEGER AS depth FROM nation GROUP BY n_regionkey""")
def crawled_folders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A folder tree written here and crawled: its folders, and its files below them."""
    path = f"{shared_dir(spark)}/loamline/crawl-{spark.sparkContext.applicationId}-{abs(hash(sf_dir))}"
    lines = table(spark, sf_dir, "nation").select(F.col("n_regionkey").alias("region"), F.col("n_name").alias("value"))
    lines.repartition(1).sortWithinPartitions("region", "value").write.mode("overwrite").partitionBy("region").text(path)
    every = merge(ingest(spark, path).fragments)
    folders = every.where("schema = 'Folder'").select(F.col("entity_id").alias("parent"), p("fileName").alias("folder"))
    docs = every.where("schema = 'PlainText'").select(p("parent").alias("parent"), "schema", F.size(F.col("props")["ancestors"]).alias("depth"), p("bodyText").alias("text"))
    return docs.join(folders, "parent").select("folder", (F.size(F.split("text", "\n")) - 1).cast("long").alias("n_lines"), F.sha1(F.col("text").cast("binary")).alias("digest"), "schema", "depth")


# Messages


def turns(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "conversations").where("text is not null and role is not null and conv_id is not null and turn is not null")


TURNS = "(SELECT * FROM conversations WHERE text IS NOT NULL AND role IS NOT NULL AND conv_id IS NOT NULL AND turn IS NOT NULL)"
MAIL_SQL = f"""SELECT conv_id || ':' || turn AS subject, 'turn-' || conv_id || '-' || turn || '@mail.example' AS message_id, role || '@example.org' AS sender, sha1(role || '@example.org') AS emitters, sha1(text) AS digest,"""


def mails(every: DataFrame) -> DataFrame:
    # Texts in transport end with a line end.
    return every.where("schema = 'Email'").select(
        p("subject").alias("subject"), p("messageId").alias("message_id"), p("from").alias("sender"), p("emitters").alias("emitters"), F.sha1(p("bodyText").cast("binary")).alias("digest"), p("parent").alias("parent"), p("fileName").alias("name"),
    )


@query(MAIL_SQL + f" conv_id || '.mbox' AS box FROM {TURNS}")
def mbox_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each conversation as a box of messages, which become entities below it."""
    every = entities(M.made(rows_by(turns(spark, sf_dir), F.col("conv_id"), turn="turn", conv_id="conv_id", role="role", text="text"), M.mbox_of, ".mbox"))
    boxes = every.where("schema = 'Package'").select(F.col("entity_id").alias("parent"), p("fileName").alias("box"))
    return mails(every).join(boxes, "parent").drop("parent", "name")


@query(MAIL_SQL + f" conv_id || '-' || turn || '.emlx' AS name FROM {TURNS}")
def emlx_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each turn as a message whose first line tells its length."""
    rows = turns(spark, sf_dir).select(F.concat_ws("-", "conv_id", "turn").alias("key"), "conv_id", "turn", "role", "text")
    return mails(entities(M.made(rows, M.emlx_of, ".emlx"))).drop("parent")


@query("""WITH c AS (SELECT c_custkey AS k, c_name AS n, c_mktsegment AS s FROM customer), own AS (
  SELECT *, CASE k % 4 WHEN 0 THEN n || ' <c' || k || '@Example.org>' WHEN 1 THEN 'c' || k || '@example.org' WHEN 2 THEN 'other' || k || '@example.org' ELSE n END AS label,
    CASE k % 4 WHEN 0 THEN 'c' || k || '@example.org' WHEN 1 THEN 'c' || k || '@example.org' WHEN 2 THEN 'other' || k || '@example.org' ELSE n END AS who FROM c)
SELECT k AS id, label AS sender, sha1(who) AS emitters, list_aggregate(list_sort(['Team One <team@example.org>', 'c' || k || '@example.org']), 'string_agg', '|') AS cc,
  list_aggregate(list_sort([sha1('all@example.org'), sha1('team@example.org'), sha1('c' || k || '@example.org')]), 'string_agg', '|') AS recipients,
  CASE WHEN k % 4 IN (0, 3) THEN n || '|Team One' ELSE 'Team One' END AS names,
  CASE WHEN k % 5 = 0 THEN '' ELSE '2020-01-02T' || lpad((k % 24)::VARCHAR, 2, '0') || ':04:05+01:00' END AS date, 'own-' || k || '@mail.example' AS message_id,
  CASE WHEN k % 3 = 0 THEN 'else-' ELSE 'last-' END || k || '@mail.example' AS reply_to, 'Pigeon ' || k % 2 AS generator, s AS keywords, 'About ' || n AS subject FROM own""")
def mail_headers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Headers of messages: identities from names and addresses in their roles, dates, ids and what they reply to."""
    rows = table(spark, sf_dir, "customer").select(F.col("c_custkey").cast("string").alias("key"), F.col("c_custkey").alias("id"), F.col("c_name").alias("name"), F.col("c_mktsegment").alias("segment"))
    mail = entities(M.made(rows, M.addressed_of, ".eml")).where("schema = 'Email'")
    named = {"from": "sender", "emitters": "emitters", "cc": "cc", "recipients": "recipients", "namesMentioned": "names", "date": "date", "messageId": "message_id", "inReplyTo": "reply_to", "generator": "generator", "keywords": "keywords", "subject": "subject"}
    return mail.select(key().cast("long").alias("id"), *[p(a).alias(b) for a, b in named.items()])


@query("""WITH c AS (SELECT c_custkey AS k, c_name AS n FROM customer), seen AS (
  SELECT CASE k % 4 WHEN 3 THEN n ELSE CASE k % 4 WHEN 2 THEN 'other' ELSE 'c' END || k || '@example.org' END AS who, CASE WHEN k % 4 IN (0, 3) THEN n END AS name,
    CASE k % 4 WHEN 0 THEN 'c' || k || '@Example.org' WHEN 1 THEN 'c' || k || '@example.org' WHEN 2 THEN 'other' || k || '@example.org' END AS email FROM c
  UNION ALL SELECT 'c' || k || '@example.org', NULL, 'c' || k || '@example.org' FROM c UNION ALL SELECT 'team@example.org', 'Team One', 'team@example.org' UNION ALL SELECT 'all@example.org', NULL, 'all@example.org')
SELECT sha1(who) AS id, coalesce(string_agg(DISTINCT name, '|' ORDER BY name), '') AS name, coalesce(string_agg(DISTINCT email, '|' ORDER BY email), '') AS email FROM seen GROUP BY who""")
def mail_people(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The persons that messages name, one for each address or, without one, name."""
    rows = table(spark, sf_dir, "customer").select(F.col("c_custkey").cast("string").alias("key"), F.col("c_custkey").alias("id"), F.col("c_name").alias("name"), F.col("c_mktsegment").alias("segment"))
    return entities(M.made(rows, M.addressed_of, ".eml")).where("schema = 'Person'").select(F.col("entity_id").alias("id"), p("name").alias("name"), p("email").alias("email"))


@query(f"""SELECT conv_id || '-' || turn AS key, list_aggregate(list_sort(['Plain ' || conv_id || '-' || turn, 'It''s <' || role || '>' || chr(10) || 'and & so on', 'Page ' || conv_id || '-' || turn, 'From: c@example.org' || chr(10) || 'Subject: Inner ' || conv_id || '-' || turn, 'Inner body ' || conv_id || '-' || turn]), 'string_agg', '|') AS body,
  list_aggregate(list_sort(['<b>Rich</b> ' || conv_id || '-' || turn, 'It&#x27;s &lt;' || role || '&gt;<br>and &amp; so on', '<p>Page <i>' || conv_id || '-' || turn || '</i></p>', 'From: c@example.org<br>Subject: Inner ' || conv_id || '-' || turn, 'Inner body ' || conv_id || '-' || turn]), 'string_agg', '|') AS html,
  'a-' || conv_id || '-' || turn || '.txt' AS attachment, sha1(text) AS digest FROM {TURNS}""")
def mail_parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Messages of many parts: of an alternative each form once, a message inside with its headers, attachments as files."""
    rows = turns(spark, sf_dir).select(F.concat_ws("-", "conv_id", "turn").alias("key"), "role", "text")
    every = entities(M.made(rows, M.parted_of, ".eml"))
    attached = every.where("schema = 'PlainText'").select(p("parent").alias("entity_id"), p("fileName").alias("attachment"), F.sha1(p("bodyText").cast("binary")).alias("digest"))
    return every.where("schema = 'Email'").select("entity_id", key().alias("key"), p("bodyText").alias("body"), p("bodyHtml").alias("html")).join(attached, "entity_id").drop("entity_id")


@query(f"""SELECT conv_id || ':' || turn AS subject, 'turn-' || turn || '@x' AS message_id, role || ' of the talk <' || role || '@example.org>' AS sender, sha1(role || '@example.org') AS emitters, '2020-01-02T03:04:05' AS date, sha1(text) AS digest,
  CASE WHEN turn % 2 = 1 THEN '<p>Rich</p>' ELSE '' END AS html, 'Inbox ' || conv_id AS folder, 'Accounts' AS account, 'note-' || conv_id || '-' || turn || '.txt' AS attachment, 'note of ' || role AS note FROM {TURNS}""")
def olm_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each conversation as an archive of stored messages: folders by their paths, fields, rich text by a flag, attachments."""
    every = entities(M.made(rows_by(turns(spark, sf_dir), F.col("conv_id"), turn="turn", conv_id="conv_id", role="role", text="text"), M.olm_of, ".olm"))
    at = every.where("schema = 'Folder'").select(F.col("entity_id").alias("id"), p("fileName").alias("name"), p("parent").alias("up"))
    folders = at.alias("f").join(at.alias("a"), F.col("f.up") == F.col("a.id")).select(F.col("f.id").alias("parent"), F.col("f.name").alias("folder"), F.col("a.name").alias("account"))
    notes = every.where("schema = 'PlainText'").select(p("parent").alias("entity_id"), p("fileName").alias("attachment"), p("bodyText").alias("note"))
    mail = every.where("schema = 'Email'").select(
        "entity_id", p("subject").alias("subject"), p("messageId").alias("message_id"), p("from").alias("sender"), p("emitters").alias("emitters"), p("date").alias("date"), F.sha1(p("bodyText").cast("binary")).alias("digest"),
        p("bodyHtml").alias("html"), p("parent").alias("parent"),
    )
    return mail.join(folders, "parent").join(notes, "entity_id").drop("parent", "entity_id")


@query("""SELECT sha1('last' || c_custkey || '@example.org') AS id, list_aggregate(list_sort(list_distinct([c_name, c_name[1:8] || ' ' || c_name[9:]])), 'string_agg', '|') AS name, '+1781555' || lpad((c_custkey % 10000)::VARCHAR, 4, '0') AS phone,
  list_aggregate(list_sort(['Last' || c_custkey || '@Example.org', 'first' || c_custkey || '@example.org']), 'string_agg', '|') AS email, c_mktsegment AS position FROM customer""")
def vcard_people(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cards of a nation's customers, some 400 in a file: folded lines, grouped items, and the last address telling who it is; no address, no person."""
    cards = rows_by(table(spark, sf_dir, "customer"), block(F.col("c_nationkey"), F.col("c_custkey"), 10_000), id="c_custkey", name="c_name", segment="c_mktsegment")
    out = entities(M.made(cards, M.vcf_of, ".vcf")).where("schema = 'Person'")
    return out.select(F.col("entity_id").alias("id"), *[p(c).alias(c) for c in ("name", "phone", "email", "position")])


@query("""SELECT sha1('event-' || event_id) AS id, event_type || ', number ' || event_id AS name, '2024-01-02' AS "startDate", '2024-01-02T03:04:05+00:00' AS "endDate", sha1('u' || user_id % 20 || '@example.org') AS organizer, sha1(event_type || '@example.org') AS involved
FROM events WHERE event_id IS NOT NULL AND user_id IS NOT NULL AND event_type IS NOT NULL""")
def calendar_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Calendars of events with organisers and guests, some 500 events in each."""
    rows = table(spark, sf_dir, "events").where("event_id is not null and user_id is not null and event_type is not null")
    out = entities(M.made(rows_by(rows, block(F.col("user_id") % 20, F.col("event_id"), 10_000), id="event_id", kind="event_type"), M.ics_of, ".ics")).where("schema = 'Event'")
    return out.select(F.col("entity_id").alias("id"), *[p(c).alias(c) for c in ("name", "startDate", "endDate", "organizer", "involved")])


# Texts and markup


@query("""SELECT doc_id::VARCHAR AS key, sha1(text) AS digest, CASE WHEN doc_id % 3 = 1 THEN 'utf-16' WHEN doc_id % 3 = 2 AND regexp_matches(text, '[^\\x00-\\x7F]') AND NOT regexp_matches(text, '[^\\x{00}-\\x{FF}]') THEN 'windows-1252' ELSE 'utf-8' END AS encoding
FROM documents WHERE text IS NOT NULL AND text <> ''""")
def plain_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Texts in three encodings, told by their bytes."""
    rows = table(spark, sf_dir, "documents").where("text is not null and text <> ''").select(F.col("doc_id").cast("string").alias("key"), F.col("doc_id").alias("id"), "text")
    return entities(M.made(rows, M.encoded_of, ".txt")).select(key().alias("key"), F.sha1(p("bodyText").cast("binary")).alias("digest"), p("encoding").alias("encoding"))


@query("""SELECT p_partkey AS id, CASE WHEN p_partkey % 10 = 0 THEN 'failure' ELSE 'success' END AS status, CASE WHEN p_partkey % 10 = 0 THEN 'XML with entity definitions is not read.' ELSE '' END AS error,
  CASE WHEN p_partkey % 10 = 0 THEN '' ELSE p_name || ' < ' || p_brand || ' ' || p_size END AS text, CASE WHEN p_partkey % 10 = 0 THEN '' ELSE '<table><tr><td><p>part</p></td><td><table><tr><td><p>name</p></td><td><p>' || p_name || ' &lt;</p></td></tr>'
  || '<tr><td><p>more</p></td><td><table><tr><td><p>brand</p></td><td><p>' || p_brand || '</p></td></tr><tr><td><p>size</p></td><td><p>' || p_size || '</p></td></tr></table></td></tr></table></td></tr></table>' END AS html FROM part""")
def xml_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Text and nested table of XML files; entity definitions make a file fail."""
    rows = table(spark, sf_dir, "part").select(F.col("p_partkey").cast("string").alias("key"), F.col("p_partkey").alias("id"), F.col("p_name").alias("name"), F.col("p_brand").alias("brand"), F.col("p_size").alias("size"))
    return entities(M.made(rows, M.xml_of, ".xml")).select(key().cast("long").alias("id"), p("processingStatus").alias("status"), p("processingError").alias("error"), p("bodyText").alias("text"), p("bodyHtml").alias("html"))


@query("""SELECT p_partkey AS id, CASE WHEN p_partkey % 2 = 1 THEN list_aggregate(list_sort(list_distinct([p_name || ' ' || p_partkey, 'Part ' || p_partkey])), 'string_agg', '|') ELSE 'Part ' || p_partkey END AS title,
  CASE WHEN p_partkey % 3 = 0 THEN 'By name' ELSE 'What ' || p_name || ' is' END AS summary, 'A. Author' AS author, list_aggregate(list_sort([p_brand, 'widget', p_size::VARCHAR]), 'string_agg', '|') AS keywords,
  '2020-01-' || lpad((1 + p_partkey % 28)::VARCHAR, 2, '0') || 'T03:04:05' AS "publishedAt", 'about noon' AS "modifiedAt", 'Hello ' || p_name || ' page. Size ' || p_size || ' noted end' AS "indexText", 'HyperText' AS schema FROM part""")
def html_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages with fields by property and by name, keywords of two fields, dates that parse and that don't, and text that is not shown."""
    rows = table(spark, sf_dir, "part").select(F.col("p_partkey").cast("string").alias("key"), F.col("p_partkey").alias("id"), F.col("p_name").alias("name"), F.col("p_brand").alias("brand"), F.col("p_size").alias("size"))
    return entities(M.made(rows, M.page_of, ".html")).select(key().cast("long").alias("id"), *[p(c).alias(c) for c in ("title", "summary", "author", "keywords", "publishedAt", "modifiedAt", "indexText")], "schema")


@query("""SELECT s_suppkey AS id, pos::VARCHAR AS fragment, value AS text FROM supplier, LATERAL (VALUES (0, s_name), (2, 'nation ' || s_nationkey), (3, upper(s_name))) v(pos, value)""")
def json_fragments(spark: SparkSession, sf_dir: str) -> DataFrame:
    """String values of JSON files, numbered with those that are not worth indexing."""
    rows = table(spark, sf_dir, "supplier").select(F.col("s_suppkey").cast("string").alias("key"), F.col("s_name").alias("name"), F.col("s_nationkey").alias("nation"))
    fragments = ingest_files(M.made(rows, M.json_of, ".json")).fragments
    named = fragments.where("fragment = ''").select("entity_id", key().cast("long").alias("id"))
    return fragments.where("fragment <> ''").join(named, "entity_id").select("id", "fragment", p("indexText").alias("text"))


@query("""SELECT n_nationkey AS id, 'Drawing ' || n_nationkey AS title, n_name || ' of ' || n_nationkey AS text, n_name || ' of ' || n_nationkey AS "indexText" FROM nation""")
def svg_drawings(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "nation").select(F.col("n_nationkey").cast("string").alias("key"), F.col("n_name").alias("name"))
    return entities(M.made(rows, M.svg_of, ".svg")).select(key().cast("int").alias("id"), p("title").alias("title"), p("bodyText").alias("text"), p("indexText").alias("indexText"))


def nation_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "nation").join(table(spark, sf_dir, "region"), F.col("n_regionkey") == F.col("r_regionkey")).groupBy(F.col("r_name").alias("key")).agg(F.array_sort(F.collect_list("n_name")).alias("texts"))


def pages_of(every: DataFrame) -> DataFrame:
    docs = every.where("schema = 'Pages'").select(F.col("entity_id").alias("document"), key().alias("key"), *[p(c).alias(c) for c in ("title", "author", "summary")])
    return every.where("schema = 'Page'").select(p("document").alias("document"), p("index").cast("int").alias("page"), p("bodyText").alias("text")).join(docs, "document").drop("document")


@query("""SELECT r_name AS key, 1::INTEGER AS page, string_agg(n_name || ' !', chr(10) ORDER BY n_name) AS text, 'Doc ' || r_name AS title, list_aggregate(list_sort(['Editor', r_name]), 'string_agg', '|') AS author, 'About Doc ' || r_name AS summary
FROM nation JOIN region ON n_regionkey = r_regionkey GROUP BY r_name""")
def docx_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents of Office Open XML with their metadata."""
    return pages_of(entities(M.made(nation_texts(spark, sf_dir), M.docx_of, ".docx")))


@query("""SELECT r_name AS key, (row_number() OVER (PARTITION BY r_name ORDER BY n_name))::INTEGER AS page, n_name AS text, 'Slides ' || r_name AS title, list_aggregate(list_sort(['Editor', r_name]), 'string_agg', '|') AS author, 'About Slides ' || r_name AS summary
FROM nation JOIN region ON n_regionkey = r_regionkey""")
def pptx_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Presentations, a page for each slide in the order of their numbers."""
    return pages_of(entities(M.made(nation_texts(spark, sf_dir), M.pptx_of, ".pptx")))


@query("""SELECT r_name AS key, 1::INTEGER AS page, string_agg(n_name || chr(10) || 'in ' || n_name, chr(10) ORDER BY n_name) AS text, 'Text ' || r_name AS title, r_name AS author, 'About it' AS summary
FROM nation JOIN region ON n_regionkey = r_regionkey GROUP BY r_name""")
def odt_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """OpenDocument texts with their metadata."""
    return pages_of(entities(M.made(nation_texts(spark, sf_dir), M.odt_of, ".odt")))


# Routing and status

SIGNED = "[" + ", ".join(f"'{e}'" for _, e in M.SIGNS) + "]"


@query(f"SELECT p_partkey AS id, {SIGNED}[(p_partkey % {len(M.SIGNS)})::INTEGER + 1] AS extractor FROM part")
def sniffed_types(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Files without a type or an ending are routed by their first bytes."""
    files = M.made(table(spark, sf_dir, "part").select(F.col("p_partkey").cast("string").alias("key"), F.col("p_partkey").alias("id")), M.signed_of)
    return auction(files.withColumn("sniffed", T.sniff(F.col("content"))), "sniffed").select(F.col("file_name").cast("long").alias("id"), "extractor")


BROKEN_SQL = "(VALUES " + ", ".join(f"({k}, '{status}', '{error or ''}')" for k, (_, _, status, error) in enumerate(M.BROKEN)) + ") b(k, status, error)"


@query(f"""SELECT c_custkey AS id, status, error, length(raw)::VARCHAR AS size FROM customer JOIN {BROKEN_SQL} ON c_custkey % {len(M.BROKEN)} = k
JOIN (VALUES {", ".join(f"({k}, '{'x' * len(raw)}')" for k, (_, raw, _, _) in enumerate(M.BROKEN))}) r(j, raw) ON j = k""")
def file_statuses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Files broken in many ways: each is an entity that says so, and none stops the others."""
    endings = F.array(*[F.lit(e) for e, _, _, _ in M.BROKEN])
    name = F.concat(F.col("c_custkey").cast("string"), F.get(endings, (F.col("c_custkey") % len(M.BROKEN)).cast("int")))
    files = M.made(table(spark, sf_dir, "customer").select(name.alias("key"), F.col("c_custkey").alias("id")), M.broken_of)
    return entities(files).select(key().cast("long").alias("id"), p("processingStatus").alias("status"), p("processingError").alias("error"), p("fileSize").alias("size"))


@query("""SELECT r_name AS key, (row_number() OVER (PARTITION BY r_name ORDER BY n_name))::INTEGER AS page, 'Page ' || n_name || chr(10) || 'Second line' AS text, '' AS title, '' AS author, '' AS summary FROM nation JOIN region ON n_regionkey = r_regionkey""")
def pdf_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages of PDF files, in fonts of a known encoding and of one of their own."""
    return pages_of(entities(M.made(nation_texts(spark, sf_dir), M.pdf_of, ".pdf")))


@query(f"""SELECT c_nationkey::VARCHAR AS key, 'Sheet' AS title, (count(*) + 1)::VARCHAR AS "rowCount", 'nation ' || c_nationkey AS author, '2020-01-02T03:04:05' AS "authoredAt",
  sha1(string_agg('"' || k || '.0","' || c_name || '","' || (k % 1000 / 100.0::DOUBLE)::VARCHAR || '","' || {DAY} || '",""' || chr(10), '' ORDER BY k)) AS "csvHash" FROM (SELECT *, c_custkey AS k FROM customer) GROUP BY c_nationkey""")
def xls_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Workbooks of the older Excel: cells of each kind, days, and the metadata of the file on its sheets."""
    out = tables_in(entities(M.made(customers(spark, sf_dir), M.xls_of, ".xls"))).where(p("csvHash") != "")
    return out.select("key", *[p(c).alias(c) for c in ("title", "rowCount", "author", "authoredAt", "csvHash")])


@query(f"""SELECT conv_id || ':' || turn AS subject, 'turn-' || turn || '@mail.example' AS message_id, role || ' of the talk <' || role || '@example.org>' AS sender, sha1(role || '@example.org') AS emitters, '2020-01-02T03:04:05' AS date, sha1(text) AS digest,
  'talk ' || conv_id AS topic, 'Team One <team0@example.org>' AS "to", 'Team Two <team1@example.org>' AS cc, 'note-' || conv_id || '-' || turn || '.txt' AS attachment, 'note of ' || role AS note FROM {TURNS}""")
def outlook_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Outlook messages: fields, recipients by their kind, rich text and attachments as files."""
    rows = turns(spark, sf_dir).select(F.concat_ws("-", "conv_id", "turn").alias("key"), "conv_id", "turn", "role", "text")
    every = entities(M.made(rows, M.msg_of, ".msg"))
    notes = every.where("schema = 'PlainText'").select(p("parent").alias("entity_id"), p("fileName").alias("attachment"), p("bodyText").alias("note"))
    mail = every.where("schema = 'Email'").select(
        "entity_id", p("subject").alias("subject"), p("messageId").alias("message_id"), p("sender").alias("sender"), p("emitters").alias("emitters"), p("date").alias("date"), F.sha1(p("bodyText").cast("binary")).alias("digest"),
        p("threadTopic").alias("topic"), p("to").alias("to"), p("cc").alias("cc"),
    )
    return mail.join(notes, "entity_id").drop("entity_id")
