import datetime

import pytest
from pyspark.sql import functions as F

from millrace.functions import dates, urls
from millrace.operators import guards, records, snapshots
from millrace.sources import raw
from millrace.streaming.guarded import guarded_sink


def one(df):
    return [tuple(r) for r in df.collect()]


@pytest.mark.parametrize(
    ("text", "fiscal", "want"),
    [
        ("11/8,15", 2026, ["2026-11-08", "2026-11-15"]), ("1/10", 2026, ["2027-01-10"]), ("1/24、3/14", 2026, ["2027-01-24", "2027-03-14"]),
        ("PDF", 2026, []), ("2/30", 2026, []), ("4/1", 2026, ["2026-04-01"]),
    ],
)
def test_days_in(spark, text, fiscal, want):
    got = spark.createDataFrame([(text, fiscal)], "t string, f int").select(F.array_compact(dates.days_in(F.col("t"), F.col("f")))).first()[0]
    assert [str(d) for d in got] == want


def test_weekday_contradiction_leaves_the_deadline_unset(spark):
    rows = spark.createDataFrame([(datetime.date(2026, 10, 12), 0), (datetime.date(2026, 10, 12), 2), (datetime.date(2026, 10, 12), None)], "d date, w int")
    assert [r[0] is None for r in rows.select(dates.checked_deadline(F.col("d"), F.col("w"))).collect()] == [False, True, False]


def test_weekday_contradiction_keeps_the_raw_text_and_a_note(spark):
    day = datetime.date(2026, 10, 12)
    rows = spark.createDataFrame([(day, 0, "10/12(月)", ["a"]), (day, 2, "10/12(水)", ["a"]), (day, 2, "10/12(水)", None), (day, None, "10/12", None)], "d date, w int, t string, n array<string>")
    got = one(rows.select(dates.noted_deadline(F.col("d"), F.col("w"), F.col("t"), F.col("n")).alias("x")).select("x.*"))
    note = "stated weekday contradicts the date"
    assert got == [(day, "10/12(月)", ["a"]), (None, "10/12(水)", ["a", note]), (None, "10/12(水)", [note]), (day, "10/12", [])]


def test_entry_lists_and_results_are_no_entry_links(spark):
    rows = [("申込", "a", True), ("エントリーリスト", "b", False), ("結果報告", "c", False), ("練習会", "d", False), ("Entry list", "e", False), ("PDF", None, False), ("PDF", " ", False), (None, "f", True)]
    got = spark.createDataFrame(rows, "label string, link string, want boolean").select(urls.is_entry_link(F.col("label"), F.col("link")), "want").collect()
    assert all(r[0] == r[1] for r in got)


def test_null_is_a_source(spark):
    old = spark.createDataFrame([(None, 1), ("a", 1)], "source string, x int")
    new = spark.createDataFrame([(None, 2), (None, 3)], "source string, x int")
    assert sorted(one(guards.last_good(old, new, "source")), key=repr) == [("a", 1, True), (None, 2, False), (None, 3, False)]
    assert sorted(one(guards.report(old, new, "source").select("source", "reason")), key=repr) == [("a", "missing"), (None, "")]
    assert one(guards.last_good(new, old, "source").where("source is null").select("x", "served_from_previous").orderBy("x")) == [(2, True), (3, True)]


def test_details_double_no_row(spark):
    rows = spark.createDataFrame([(1, None, 7), (2, None, 8), (3, "own", 9)], "k int, v string, matched int")
    details = spark.createDataFrame([(1, "a"), (1, "b"), (2, "c"), (2, "c"), (3, "other"), (None, "d")], "k int, v string")
    got = sorted(one(records.enriched(rows, details, ["k"], ["v"]).select("k", "v", "matched", "conflict", "enriched_matched")))
    assert got == [(1, None, 7, True, True), (2, "c", 8, False, True), (3, "own", 9, True, True)]
    assert sorted(one(records.located(rows.select("k"), details, "k"))) == [(1, None), (2, "c"), (3, "other")]


def test_links_in_any_quotes(spark):
    html = """<a href="x y">1</a><a HREF='b"c'>2</a><a href = d/e>3</a><a data-href="no">4</a><td>PDF</td>"""
    assert spark.createDataFrame([(html,)], "h string").select(urls.links_in(F.col("h"))).first()[0] == ["x y", 'b"c', "d/e"]


def test_an_empty_first_batch_publishes_nothing(spark, tmp_path):
    root, rows = f"file://{tmp_path}/state", spark.createDataFrame([("a", 1)], "source string, x int")
    write = guarded_sink(root, "source")
    write(rows.limit(0), 0)
    assert snapshots.read_last_good(spark, root) is None
    write(rows, 1)
    assert one(snapshots.read_last_good(spark, root)) == [("a", 1)]


def test_versions(spark):
    names = spark.createDataFrame([("v0.8.9",), ("v0.8.14",), ("other-1",)], "n string")
    assert snapshots.latest(names, "n", "v").first()[0] == "v0.8.14"
    assert snapshots.latest(names, "n", "v", numeric=False).first()[0] == "v0.8.9"
    assert one(snapshots.outdated(names, "n", "v", "v0.8.14")) == [("v0.8.9",)]


def test_guard_keeps_last_good(spark):
    old = spark.createDataFrame([("a", 1), ("a", 2), ("b", 1)], "source string, x int")
    new = spark.createDataFrame([("a", 3), ("b", 4), ("b", 5), ("c", 6)], "source string, x int")
    got = sorted(one(guards.last_good(old, new, "source").select("source", "x", "served_from_previous")))
    assert got == [("a", 1, True), ("a", 2, True), ("b", 4, False), ("b", 5, False), ("c", 6, False)]
    reasons = {r["source"]: r["reason"] for r in guards.report(old, new.where("source <> 'b'"), "source").collect()}
    assert reasons == {"a": "fewer rows", "b": "missing", "c": ""}
    other = new.withColumn("y", F.lit(1))
    assert {r["served_from_previous"] for r in guards.last_good(old, other, "source").collect()} == {True}
    bad = guards.report(old, new, "source", "x", 0, 5).where("reason = 'bad dates'")
    assert [r["source"] for r in bad.collect()] == ["c"]


def test_enrichment_marks_conflicts_and_never_borrows(spark):
    rows = spark.createDataFrame([("x", 2026, "12/1", None), ("y", 2026, "5/5", "hall"), ("z", 2026, "6/6", None)], "name string, fiscal int, day string, venue string")
    details = spark.createDataFrame([("x", 2026, "12/1", "court"), ("y", 2026, "5/5", "park"), ("z", 2026, "7/7", "field")], rows.schema)
    got = {r["name"]: (r["venue"], r["matched"], r["conflict"]) for r in records.enriched(rows, details, ["name", "fiscal", "day"], ["venue"]).collect()}
    assert got == {"x": ("court", True, False), "y": ("hall", True, True), "z": (None, False, False)}


def test_plan_and_notice_are_one(spark):
    rows = spark.createDataFrame([("x", 1, "plan"), ("x", 2, "notice"), ("y", 1, "plan")], "k string, detail int, what string")
    assert sorted(one(records.first_of_each(rows, ["k"], [F.desc("detail")]).select("k", "what"))) == [("x", "notice"), ("y", "plan")]


def test_links_and_routes(spark):
    rows = spark.createDataFrame([("<td>PDF</td>",), ('<td><a href="a.pdf">PDF</a></td>',)], "h string")
    assert [len(r[0]) for r in rows.select(urls.links_in(F.col("h"))).collect()] == [0, 1]
    asked = spark.createDataFrame([("POST", "https://a/x", "cors"), ("GET", "https://b/x", "cors"), ("GET", "https://a/x", "navigate"), ("GET", "https://a/d?q#f", "cors"), ("GET", "https://a/s", "cors"), ("GET", "https://a/o", "cors")], "m string, u string, o string")
    got = [r[0] for r in asked.select(urls.route(F.col("m"), F.col("u"), F.col("o"), "https://a/", "https://a/d", ["https://a/s", "https://a/d"])).collect()]
    assert got == ["skip: method", "skip: origin", "navigation", "data", "shell", "skip: unknown"]
    assert [r[0] for r in spark.createDataFrame([("not a url",), (None,)], "u string").select(urls.on_hosts(F.col("u"), ["a"])).collect()] == [False, False]


def test_snapshots_publish_all_or_nothing(spark, tmp_path):
    root, rows = f"file://{tmp_path}/s", spark.createDataFrame([(1,)], "x int")
    assert snapshots.read_last_good(spark, root) is None
    assert snapshots.guarded_publish(rows, root, "v1", 1, True)
    assert not snapshots.guarded_publish(rows.limit(0), root, "v2", 2, False)
    assert snapshots.published(spark, root) == "v1"
    assert one(snapshots.read_last_good(spark, root)) == [(1,)]


def test_raw_sources(spark, tmp_path):
    (tmp_path / "a.html").write_bytes("<table><tr><td> 安城 </td><td><b>1</b></td></tr></table>".encode("cp932"))
    got = raw.files(spark, f"file://{tmp_path}", "*.html").select(raw.table_cells(raw.decoded(F.col("content")))).first()[0]
    assert got == [["安城", "1"]]
    assert raw.fetched(lambda: b"x") == b"x"
    assert raw.fetched(lambda: 1 / 0) is None
    import time

    assert raw.fetched(lambda: time.sleep(1), 0.05) is None


def test_guarded_stream(spark, tmp_path):
    (tmp_path / "in").mkdir()
    schema = "source string, x int"
    stream = spark.readStream.schema(schema).json(f"file://{tmp_path}/in")
    root = f"file://{tmp_path}/out"

    def run():
        q = stream.writeStream.foreachBatch(guarded_sink(root, "source")).option("checkpointLocation", f"file://{tmp_path}/cp").trigger(availableNow=True).start()
        q.awaitTermination()

    (tmp_path / "in/1.json").write_text('{"source": "a", "x": 1}\n{"source": "a", "x": 2}\n{"source": "b", "x": 1}\n')
    run()
    (tmp_path / "in/2.json").write_text('{"source": "a", "x": 9}\n{"source": "b", "x": 7}\n{"source": "b", "x": 8}\n')
    run()
    assert sorted(one(snapshots.read_last_good(spark, root).select("source", "x"))) == [("a", 1), ("a", 2), ("b", 7), ("b", 8)]
