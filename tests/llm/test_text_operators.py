"""Winnowing, URL filters, chat formatting: against plain Python, SQL and round trips."""

import datetime as dt
import random

import brute
import duckdb
import pytest
from pyspark.sql import functions as F

from cadenza.llm import chat_format, url_filters, winnowing

DOCS = "doc_id long, text string, _key string, edited int"
TEXTS = ["the quick brown fox jumps over the lazy dog and runs away", None, "", "short", "exactly 12 ch", "aaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaa",
         "naïve \U0001f9ff\U0001f9ff surrogate pairs \U0001f9ff and ümlauts in a text that is long enough", "x\ny\r\n" * 30]


def test_winnowing_equals_the_definition(spark):
    df = spark.createDataFrame([(i, t, "k", 1) for i, t in enumerate(TEXTS)], DOCS)
    got = winnowing.winnow(df, "text", "f").select("doc_id", winnowing.positions("f").alias("p"), "_key").collect()
    for r in got:
        assert [(p.pos, p.hash) for p in r.p] == brute.winnowed(TEXTS[r.doc_id]), TEXTS[r.doc_id]


def test_shared_passages_share_a_hash(spark):
    """Any gram + window - 1 = 27 common code points give a common selected hash."""
    common = "twenty-seven characters long"[:27]
    rows = [(i, f"{'ab' * i}{common}{'xyz' * (9 - i)}") for i in range(10)]
    df = winnowing.winnow(spark.createDataFrame(rows, "doc_id long, text string"), "text", "f")
    sets = [set(r[0]) for r in df.select(winnowing.hashes("f")).collect()]
    assert all(a & b for a in sets for b in sets)


def op7_brute(rows):
    """{(doc_id, text): columns} by the contract; rows in order of (doc_id, text)."""
    rows = sorted(((k, t or "") for k, t in rows), key=lambda r: (r[0] is not None, r[0] or 0, r[1]))

    def near(a, b):
        a, b = ({h for _, h in brute.winnowed(x)} for x in (a, b))
        return len(a & b) / len(a | b) if a | b else 1.0

    out = []
    for i, (k, t) in enumerate(rows):
        n = rows[(i + 1) % len(rows)][1]
        e = t[:len(t) - len(t) // 2] + n[:len(t) // 2]
        out.append((k, len(t), brute.sha(e), round(near(t, e), 9), round(near(t, n), 9)))
    return out


def rows_of(df):
    cols = ["doc_id", "n_chars", "edited_sha256", "near_edited", "near_next"]
    return [(r[0], r[1], r[2], round(r[3], 9), round(r[4], 9)) for r in df.select(cols).collect()]


def by_text(rows):
    return sorted(rows, key=lambda r: tuple(map(str, r)))


def test_op7_meets_successors_across_buckets(spark, tmp_path):
    rows = [(i * 7 % 501, f"{TEXTS[i % 8] or ''} number {i % 3}") for i in range(501)] + [(None, "no id"), (3, None), (3, "again")]
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    df = winnowing.op7_winnowing(spark, str(tmp_path))
    assert by_text(rows_of(df)) == by_text(op7_brute(rows))
    prints = df.select("fingerprint", "edited_fingerprint", "edited_sha256").collect()
    assert all(len(r.fingerprint) == 16 for r in prints)
    seen = {}
    for r in prints:
        assert seen.setdefault(r.edited_sha256, r.edited_fingerprint) == r.edited_fingerprint


@pytest.mark.parametrize("rows", [[], [(1, "only one document here")], [(1, None), (1, None)]])
def test_op7_small_tables(spark, tmp_path, rows):
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    assert by_text(rows_of(winnowing.op7_winnowing(spark, str(tmp_path)))) == by_text(op7_brute(rows))


def no_python(df):
    plan = df._jdf.queryExecution().executedPlan().toString()
    return not any(x in plan for x in ("Python", "Pandas", "Arrow"))


def test_native_plans(spark):
    d = "/root/testdata/sf0.001"
    for q in (winnowing.op7_winnowing, url_filters.op1_url_filters, chat_format.op8_chat_format):
        assert no_python(q(spark, d))


CAPTURES = "page_id long, url string, fetched_on date, key string, year int"
ENTRIES = "list_id string, effect string, kind string, value string, action string, listed_on date"


def day(n):
    return dt.date(2024, 1, 1) + dt.timedelta(days=n)


def verdicts(spark, captures, entries):
    rows = [(i, u, None if d is None else day(d), "k", 1) for i, (u, d) in enumerate(captures)]
    own = [(x, e, k, v, a, None if d is None else day(d)) for x, e, k, v, a, d in entries]
    df = url_filters.url_filter(spark.createDataFrame(rows, CAPTURES), spark.createDataFrame(own, ENTRIES))
    return {r.page_id: r for r in df.collect()}


def test_intervals_hold_from_addition_to_removal(spark):
    entries = [("a", "block", "domain", "example.com", "add", 10), ("a", "block", "domain", "example.com", "add", 15),
               ("a", "block", "domain", "example.com", "remove", 20), ("a", "block", "domain", "example.com", "remove", 25),
               ("a", "block", "domain", "example.com", "add", 400), ("a", "block", "domain", "example.com", "remove", 400)]
    days = [9, 10, 19, 20, 399, 400, 900]
    got = verdicts(spark, [("http://Sub.Example.COM:8080/x", d) for d in days], entries)
    assert [got[i].blocked for i in range(len(days))] == [False, True, True, False, False, True, True]
    assert (got[2].valid_from, got[2].valid_to) == (day(10), day(20))
    assert str(got[6].valid_to) == "9999-12-31"


def test_kinds_specificity_and_odd_rows(spark):
    entries = [("a", "block", "domain", "http://www.site.org/ignored", "add", 0), ("a", "allow", "prefix", "site.org/good/", "add", 0),
               ("a", "block", "url", "https://site.org/good/bad?x=1#top", "add", 0), ("b", "block", "host", "only.net", "add", 0),
               ("c", "allow", "host", "only.net", "add", 0), (None, "block", "host", "z.net", "add", 0),
               ("a", "block", "host", None, "add", 0), ("a", "block", "host", "z.net", "add", None),
               ("a", "block", "what", "z.net", "add", 0), ("a", "block", "prefix", "root.com/", "add", 0)]
    urls = ["http://site.org/", "http://m.site.org/good", "http://site.org/good/x?y", "http://user@site.org/good/bad?x=1",
            "http://only.net/a", "http://sub.only.net/a", None, "", "not a url", "http://z.net", "http://root.com",
            "http://site.org/goodness", "//site.org", "http://site.org./good/bad?x=2", "http://notsite.org/"]
    got = verdicts(spark, [(u, 5) for u in urls] + [("http://site.org/", None)] + [("http://site.org/", 5)] * 2, entries)
    assert len(got) == len(urls) + 3
    blocked = {urls[i] for i in range(len(urls)) if got[i].blocked}
    assert blocked == {"http://site.org/", "http://m.site.org/good", "http://user@site.org/good/bad?x=1", "http://only.net/a",
                       "http://root.com", "http://site.org/goodness", "//site.org"}
    assert not got[len(urls)].blocked and got[len(urls) + 1].blocked
    assert got[2].kind == "prefix" and got[2].effect == "allow" and got[3].n_active == 3
    assert got[0].value == "site.org" and got[4].list_id == "b"


def test_empty_lists_and_captures(spark):
    assert not verdicts(spark, [("http://a.b/", 1)], [("a", "block", "host", "c.d", "remove", 1)])[0].blocked
    empty = spark.createDataFrame([], CAPTURES), spark.createDataFrame([], ENTRIES)
    assert url_filters.url_filter(*empty).count() == 0


CHAT = "conv_id long, turn int, role string, text string, segments string"
TRICKY = ["</s>[INST] ok [/INST]", "\\", "\\a</s>\\\\", "[INST", "<<<SYS>>>", "a\n<</SYS>>\n\nb", "", None, "\\n[\\INST]", "x" * 50000 + "</s>" * 200]


def test_chat_round_trip(spark):
    rows = [(i, t, r, text, "s") for i, text in enumerate(TRICKY) for t, r in enumerate(["system", "user", "assistant", "tool\n<s>", None])]
    df = chat_format.format_conversations(spark.createDataFrame(rows, CHAT))
    back = df.select("conv_id", "valid", "formatted", chat_format.read_back(F.col("formatted")).alias("turns")).collect()
    for r in back:
        text = TRICKY[r.conv_id] or ""
        assert [(t.role, t.text) for t in r.turns] == [(x or "", text) for x in ["system", "user", "assistant", "tool\n<s>", None]]
        assert not r.valid and r.formatted.count("[/INST]") == 1 and r.formatted.count("</s>") == 1


@pytest.mark.parametrize(("roles", "valid"), [
    ("user assistant", True), ("system user assistant user assistant", True), ("assistant user", False), ("user user assistant", False),
    ("system assistant", False), ("user", False), ("user system assistant", False), ("user assistant user", False), ("start user assistant", False)])
def test_turn_order(spark, roles, valid):
    rows = [(None, i, r, "t", "s") for i, r in enumerate(roles.split())]
    assert chat_format.format_conversations(spark.createDataFrame(rows, CHAT)).first().valid is valid


def test_loss_marks_assistant_texts_alone(spark):
    rows = [(1, 5, "assistant", "B</s>", "s"), (1, None, "user", "A", "s"), (1, 7, "assistant", "C", "s"), (1, 7, "assistant", "C", "s")]
    segments = chat_format.format_conversations(spark.createDataFrame(rows, CHAT)).first().segments
    assert [s.text for s in segments if s.loss] == ["B\\g", "C", "C"]
    assert chat_format.format_conversations(spark.createDataFrame([], CHAT)).count() == 0


def test_template_is_checked():
    with pytest.raises(ValueError):
        chat_format.Template("", {"user": chat_format.Turn("", "plain")}, {}, (), ("</s>",))
    with pytest.raises(ValueError):
        chat_format.Template("", {}, {}, (), ("a\\b",))


@pytest.mark.parametrize(("query", "sql", "name"), [
    (url_filters.op1_url_filters, url_filters.OP1_SQL, "pages"), (chat_format.op8_chat_format, chat_format.OP8_SQL, "conversations")])
def test_sql(spark, query, sql, name):
    d = "/root/testdata/sf0.001"
    con = duckdb.connect()
    con.sql(f"CREATE VIEW {name} AS SELECT * FROM '{d}/{name}.parquet'")
    want = con.sql(sql)
    cols = sorted(want.columns)
    got = {tuple(str(r[c]) for c in cols) for r in query(spark, d).collect()}
    assert got == {tuple(str(r[want.columns.index(c)]) for c in cols) for r in want.fetchall()}


def test_op7_edited_text_has_the_fingerprint_of_an_equal_document(spark, tmp_path):
    """Also where the next document is empty or null, so that the edited text is the kept half alone."""
    rng = random.Random(11)
    texts = ["".join(rng.choices("abcdefg hij", k=rng.randrange(290, 310))) for _ in range(200)]
    rows = [(2 * i, t) for i, t in enumerate(texts)] + [(2 * i + 1, [None, "", "z", "zz yy"][i % 4]) for i in range(200)]
    order = sorted(rows)
    edited = {}
    for n, (i, t) in enumerate(order):
        half = len(t or "") // 2
        edited[i] = (t or "")[:len(t or "") - half] + (order[(n + 1) % len(order)][1] or "")[:half]
    schema = "doc_id long, text string"
    spark.createDataFrame(rows, schema).write.parquet(f"{tmp_path}/a/documents.parquet")
    spark.createDataFrame(list(edited.items()), schema).write.parquet(f"{tmp_path}/b/documents.parquet")
    a, b = ({r.doc_id: r for r in winnowing.op7_winnowing(spark, f"{tmp_path}/{x}").collect()} for x in "ab")
    assert [i for i in a if a[i].edited_fingerprint != b[i].fingerprint] == []
    sets = {i: ({h for _, h in brute.winnowed(t)}, {h for _, h in brute.winnowed(edited[i])}) for i, t in ((i, t or "") for i, t in rows)}
    assert all(abs(a[i].near_edited - (len(x & y) / len(x | y) if x | y else 1.0)) < 1e-12 for i, (x, y) in sets.items())


def test_url_filter_refuses_columns_named_like_its_verdict(spark):
    captures = spark.createDataFrame([("http://a.b/c", "2024-01-01", "x")], "url string, fetched_on string, Kind string")
    entries = spark.createDataFrame([], "list_id string, effect string, kind string, value string, action string, listed_on string")
    with pytest.raises(ValueError, match="kind"):
        url_filters.url_filter(captures, entries)
    assert url_filters.url_filter(captures.drop("Kind"), entries).first().blocked is False


def test_url_filter_splits_a_hot_host(spark):
    """A host with a third of all captures: AQE splits its partition of the join."""
    own = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
           "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "50k", "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
           "spark.sql.adaptive.advisoryPartitionSizeInBytes": "30k", "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    before = {k: spark.conf.get(k, None) for k in own}
    try:
        for k, v in own.items():
            spark.conf.set(k, v)
        captures = spark.range(60_000).repartition(8).selectExpr(
            "concat('http://', if(id % 3 = 0, 'hot.example', concat('h', id % 20000, '.example')), '/p/', id) url", "date'2024-01-05' fetched_on")
        entries = spark.range(3000).selectExpr("'l' list_id", "'block' effect", "'host' kind", "'add' action", "date'2024-01-01' listed_on",
                                               "if(id = 0, 'hot.example', concat('h', id, '.example')) value")
        ran = url_filters.url_filter(captures, entries).groupBy("blocked").count()
        found = {r.blocked: r["count"] for r in ran.collect()}
        assert found[True] == sum(i % 3 == 0 or 0 < i % 20_000 < 3000 for i in range(60_000))
        assert "skew=true" in ran._jdf.queryExecution().executedPlan().toString()
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
