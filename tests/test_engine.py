"""Operators without a query of their own, the analysis plan, and the streams."""

import datetime

import pytest
from pyspark.sql import functions as F

from loamline.functions import language
from loamline.functions import text as T
from loamline.model import FRAGMENT, entity_id, is_a, latest, make_id, merge
from loamline.operators import relational as R
from loamline.plans.analyze import analyze, returned_ids
from loamline.streaming.live import ingest_stream, thread_links_stream

PHONES = ["+1-800-784-2433", "(800) 784 2433", "+91-9999-111222", "00491739341784", "+44 (0) 20 7946 0958"]
IBANS = ["DE44500105175407324931", "GB29NWBK60161331926819", "gb29 NWBK 6016133 1926819"]


def one(spark, column, value):
    return spark.createDataFrame([(value,)], "x string").select(column(F.col("x"))).first()[0]


def test_ids_and_schemata(spark):
    row = spark.createDataFrame([("a", None, 3)], "a string, b string, c int").select(entity_id(F.col("a"), F.col("b"), F.col("c")), entity_id(F.col("b")), is_a(F.lit("Email"), "Document"), is_a(F.lit("Person"), "Document")).first()
    assert tuple(row) == (make_id("a", None, 3), None, True, False)


def test_merge_does_not_depend_on_order(spark):
    rows = [("e", "1", "Document", {"a": ["x", "y"]}), ("e", "2", "PlainText", {"a": ["y"], "b": ["z"]}), ("f", "", "Folder", {})]
    schema = "entity_id string, fragment string, schema string, props map<string,array<string>>"
    got = [sorted(map(tuple, merge(spark.createDataFrame(r, schema)).collect()), key=str) for r in (rows, rows[::-1])]
    assert got[0] == got[1] == [("e", "PlainText", {"a": ["x", "y"], "b": ["z"]}), ("f", "Folder", {})]
    newer = spark.createDataFrame([("e", "1", "old", 1), ("e", "1", "new", 2)], "entity_id string, fragment string, v string, at int")
    assert [r.v for r in latest(newer, "at").collect()] == ["new"]


def test_merge_of_one_fragment_sorts_and_drops_nulls(spark):
    rows = [("a", "", "Document", {"x": ["b", "a", None, "b"], "y": [], "z": None}), ("b", "", "Document", {}), ("c", "1", "Document", {"x": ["q"]}), ("c", "2", "Email", {"x": ["p", "q"]}), ("d", "", "Page", None)]
    got = {r.entity_id: (r.schema, r.props) for r in merge(spark.createDataFrame(rows, FRAGMENT)).collect()}
    assert got == {"a": ("Document", {"x": ["a", "b"]}), "b": ("Document", {}), "c": ("Email", {"x": ["p", "q"]}), "d": ("Page", {})}


@pytest.mark.parametrize("pattern, texts", [(T.PHONE, PHONES), (T.IBAN, IBANS), (T.EMAIL, ["a.b+c@Example.co.uk", "x_y%1@sub-d.example.org"])])
def test_patterns_match_once(spark, pattern, texts):
    for t in texts:
        assert spark.createDataFrame([(f"see {t} there",)], "x string").select(F.size(T.matches(F.col("x"), pattern))).first()[0] == 1


def test_words_end_at_letters_beyond_ascii(spark):
    """As in the SQL form: 'est' after an accented letter begins a word of its own."""
    got = spark.createDataFrame([("pré\u00e9st 4189586171755930 x",), ("best 4189586171755930 x",)], "t string").select(T.matches(F.col("t"), T.IBAN)).collect()
    assert [r[0] for r in got] == [["st 4189586171755930"], []]


def test_cleaning_and_countries(spark):
    assert one(spark, T.clean_iban, "de44 5001 0517 5407 3249 31") == "DE44500105175407324931" and one(spark, T.clean_iban, "DE45500105175407324931") is None
    assert one(spark, T.clean_phone, "0049 173 9341784") == "+491739341784" and one(spark, T.clean_phone, "123456") is None
    assert one(spark, T.phone_country, "+919988111222") == "in" and one(spark, T.phone_country, "+35312345678") == "ie" and one(spark, T.phone_country, "+12125550100") is None
    assert one(spark, T.clean_email, "Ann@EXAMPLE.org") == "Ann@example.org" and one(spark, T.clean_email, "a@-x.org") is None
    assert one(spark, T.clean_name, " -John  Smith, ") == "John Smith" and one(spark, T.clean_name, "Mononym") is None


def test_text_functions(spark):
    assert one(spark, lambda c: T.chunks(c, size=4), " ab  cdef\ng ") == ["ab c", "def ", "g"] and one(spark, T.chunks, " a\n") == []
    assert one(spark, T.parse_timestamp, "2020-01-02T03:04:05.678Z") == datetime.datetime(2020, 1, 2, 3, 4, 5) and one(spark, T.parse_timestamp, "soon") is None
    assert one(spark, T.message_ids, "<a@b> < long-one@x > <y@zzz>") == ["long-one@x", "y@zzz"]
    assert one(spark, lambda c: T.sniff(c.cast("binary")), "%PDF-1") == "application/pdf" and one(spark, lambda c: T.sniff(c.cast("binary")), "  <!DOCTYPE HTML>") == "text/html"


def test_prose_that_begins_as_other_formats_do_is_text(spark):
    kind = lambda text: one(spark, lambda c: T.sniff(c.cast("binary")), text)
    for prose in ("From of. Thoronre it 73.122.29.74 the +1 (885) 555-0172\nThis", "From +1 (282) 555-5833 on\nx", "BMW of 2020", "ID3 tags", "BZh is"):
        assert kind(prose) == "text/plain", prose
    for line in ("From - Thu Jan  2 03:04:05 2020\n", "From a@b.c Thu Jan 2 03:04:05 +0100 2020\r\n", "From a@b Sat Jan 3 01:05:34 1996 GMT\nx", "From a Mon Jan 2 03:04 PST 1990 remote from b\n", "From - Thu Jan 2 2020\n"):
        assert kind(line) == "application/mbox", line
    assert kind("BM\x01\x02\x00\x00\x00\x00\x00\x00\x36\x00\x00\x00\x28\x00\x00\x00") == "image/bmp" and kind("ID3\x03\x00") == "audio/mpeg"


def test_files_are_dealt_to_many_tasks(spark):
    from loamline.storage import tasks

    assert tasks(spark) >= 4 * spark.sparkContext.defaultParallelism and tasks(spark) >= int(spark.conf.get("spark.sql.shuffle.partitions"))


def test_trigrams_are_counted_in_pieces():
    import tracemalloc

    import pyarrow as pa

    texts = [f"word{k} {k * 7} " * 300 for k in range(2000)]
    batch = pa.RecordBatch.from_arrays([pa.array(texts), pa.array(["x", "y"] * 1000)], names=["text", "lang"])
    tracemalloc.start()
    counts: dict = {}
    for b in language.count_grams(iter([batch])):
        for lang, code, n in zip(*(c.to_pylist() for c in b.columns), strict=True):
            counts[lang, code] = counts.get((lang, code), 0) + n
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 60 << 20 and sum(counts.values()) == sum(len(language.codes(t)) for t in texts)


def test_chunks_collapse_a_text_once(spark):
    plan = spark.range(1).select(T.chunks(F.col("id").cast("string")).alias("c"))._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("regexp_replace") == 1


def test_auction_ties_families_and_empty_files(spark):
    rows = [("a.msg", None, 1), ("a.xyz", "image/webp", 1), ("a.html", "text/plain", 1), ("x.csv", None, 0), ("none", None, 1), ("pic", "IMAGE/PNG; x=1", 1)]
    got = R.auction(spark.createDataFrame(rows, "file_name string, mime string, file_size long")).collect()
    assert {r.file_name: (r.extractor, r.score) for r in got} == {"a.msg": ("olemsg", 10), "a.xyz": ("image", 9), "a.html": ("html", 6), "x.csv": ("ignore", 200), "none": (None, None), "pic": ("image", 10)}


def test_confident_groups_drop_whole(spark):
    rows = [("e", "p", "Ann Smith", "person", 0.9), ("e", "p", "ann  smith", "person", 0.95), ("e", "p", "Bob Jones", "person", 0.9), ("e", "p", "bob jones", "trash", 0.99), ("e", "p", "Low One", "person", 0.5)]
    got = R.group_confident(spark.createDataFrame(rows, "entity_id string, prop string, value string, label string, confidence double")).collect()
    assert [tuple(r) for r in got] == [("e", "p", "ann smith", ["Ann Smith", "ann  smith"])]


def test_tag_cap_spans_properties(spark):
    rows = [("e", k, "p" if k % 2 else "q", f"v{k}") for k in range(9)] + [("e", 20, "p", "v0")]
    got = R.group_tags(spark.createDataFrame(rows, "entity_id string, pos long, prop string, value string"), cap=4).collect()
    assert sorted(r.label for r in got) == ["v0", "v1", "v2", "v3", "v4"]


def test_analysis_tags_documents_and_not_tables(spark):
    text = "Call +91 99881 11222 or write to Ann@Example.org"
    schema = "entity_id string, fragment string, schema string, props map<string,array<string>>"
    rows = [("d", "", "PlainText", {"bodyText": [text]}), ("t", "", "Table", {"indexText": [text]}), ("p", "", "Person", {"summary": [text]}), ("quiet", "", "PlainText", {"bodyText": ["nothing to tag here"]})]
    people = lambda chunks: chunks.select("entity_id", F.lit("peopleMentioned").alias("prop"), F.lit("Ann Smith").alias("value"), F.lit("person").alias("label"), F.lit(0.9).alias("confidence")).where("entity_id = 'd'")
    out = analyze(spark.createDataFrame(rows, schema), profiles={"en": {"the": -1.0}}, names=people)
    got = {(r.entity_id, r.prop, r.value) for r in out.tags.collect()}
    assert got == {("d", "phoneMentioned", "+919988111222"), ("d", "detectedCountry", "in"), ("d", "emailMentioned", "Ann@example.org"), ("d", "peopleMentioned", "Ann Smith"), ("d", "detectedLanguage", "en")}
    mention, = out.mentions.collect()
    assert mention.document == "d" and mention.detectedSchema == "Person" and mention.contextCountry == ["in"] and mention.id == make_id("mention", "d", "peopleMentioned", "ann smith")
    assert returned_ids(out, spark.createDataFrame([("d",)], "entity_id string")).count() == 2


def test_language_profiles(spark):
    rows = spark.createDataFrame([("the cat and the dog " * 5, "en"), ("der hund und die katze " * 5, "de"), (None, "fr")], "text string, lang string")
    known = language.profiles(rows)
    assert set(known) == {"en", "de"} and language.detect("und der", known)[0] == "de" and language.detect("", known) == (None, 0.0)
    assert one(spark, language.name_model, "de") == "deu" and one(spark, language.name_model, "xx") is None


def test_thread_links_are_symmetric_and_skip_self(spark):
    rows = [("c", "1", "m1", None), ("c", "2", "m2", "m1"), ("c", "3", "m3", "m3"), ("other", "4", "m4", "m1"), ("c", "5", "m1", None)]
    got = R.thread_links(spark.createDataFrame(rows, "collection string, entity_id string, message_id string, in_reply_to string"))
    assert sorted(map(tuple, got.collect())) == [("c", "2", "1"), ("c", "2", "5")]


def test_ancestors_refuse_cycles(spark):
    nodes = spark.createDataFrame([("a", "b"), ("b", "a")], "id string, parent string")
    with pytest.raises(ValueError):
        R.ancestors(nodes, max_depth=4)
    with pytest.raises(ValueError):
        R.ancestors(nodes)
    path = spark.range(1, 5).selectExpr("cast(id as string) id", "cast(id - 1 as string) parent")
    assert R.ancestors(path).count() == 10


@pytest.mark.parametrize("order", [[0, 1, 2], [2, 1, 0]])
def test_thread_stream_in_any_order(spark, tmp_path, order):
    # Else time-outs by the clock make one empty batch after another, and the stream has no end.
    spark.conf.set("spark.sql.streaming.noDataMicroBatches.enabled", "false")
    schema = "collection string, entity_id string, message_id string, in_reply_to string"
    rows = [("c", "1", "m1", None), ("c", "2", "m2", "m1"), ("c", "3", "m3", "m2")]
    for k, i in enumerate(order):
        spark.createDataFrame([rows[i]], schema).coalesce(1).write.mode("append").parquet(str(tmp_path / "in" / str(k)))
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "in" / "*"))
    q = thread_links_stream(stream).writeStream.format("memory").queryName(f"links{order[0]}").option("checkpointLocation", str(tmp_path / "c")).outputMode("append").trigger(availableNow=True).start()
    assert q.awaitTermination(60)
    assert sorted(map(tuple, spark.table(f"links{order[0]}").collect())) == [("c", "2", "1"), ("c", "3", "2")]


def test_ingest_stream_appends(spark, tmp_path):
    (tmp_path / "in").mkdir()
    for k in range(2):
        (tmp_path / "in" / f"{k}.txt").write_text(f"text {k}")
        ingest_stream(spark, str(tmp_path / "in"), str(tmp_path / "out"), str(tmp_path / "check")).awaitTermination(60)
    got = spark.read.parquet(str(tmp_path / "out")).select(F.col("props")["bodyText"][0]).collect()
    assert sorted(r[0] for r in got) == ["text 0", "text 1"]
