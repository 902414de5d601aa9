import gzip
import json
import os
import sys

from pyspark.sql import functions as F

from rollcall.sources import files, records, sinks
from rollcall.sources.listing import ListingSource


def test_reports_follow_the_manifest(spark, tmp_path):
    (tmp_path / "a.json").write_text(json.dumps({"records": [{"house": "rs", "session": 1, "date_iso": "2001-01-02", "type": "STARRED"}], "count": 1}))
    (tmp_path / "manifest.json").write_text(json.dumps({"shards": {"rs": [{"file": "a.json"}, {"file": "gone.json"}]}}))
    got = files.read_reports(spark, str(tmp_path), "rs", files.RS_BUNDLE)
    assert got.columns == ["house", "session", "date_iso", "date", "type", "pdf_url", "subject"] and got.count() == 1
    assert files.read_reports(spark, str(tmp_path), "ls", files.LS_QUESTION).count() == 0
    assert files.read_reports(spark, str(tmp_path / "none"), "ls", files.LS_DEBATE).count() == 0


def test_shards_round_trip(spark, tmp_path):
    df = spark.createDataFrame([("f1.json", "b", "text ह"), ("f1.json", "a", None), ("f2.json", "c", "z")], "file string, k string, v string")
    sinks.export_shards(df, str(tmp_path / "out"), "file", "k", "v")
    assert list(json.loads((tmp_path / "out" / "f1.json").read_text())["records"]) == ["a", "b"]
    got = {tuple(r) for r in files.read_text_shards(spark, [str(tmp_path / "out" / "f1.json"), str(tmp_path / "out" / "f2.json")]).collect()}
    assert got == {("a", None, True), ("b", "text ह", False), ("c", "z", False)}


def test_shards_keep_what_they_hold(spark, tmp_path):
    one = lambda *rows: spark.createDataFrame(list(rows), "file string, k string, v string")
    out = str(tmp_path / "out")
    sinks.export_shards(one(("f.json", "b", "old"), ("f.json", "c", "old")), out, "file", "k", "v")
    sinks.export_shards(one(("f.json", "a", "new"), ("f.json", "b", "new")), out, "file", "k", "v")
    read = lambda: list(json.loads((tmp_path / "out" / "f.json").read_text())["records"].items())
    assert read() == [("a", "new"), ("b", "new"), ("c", "old")]
    sinks.export_shards(one(("f.json", "d", "only")), out, "file", "k", "v", overlay=False)
    assert read() == [("d", "only")]


def test_tuples_markers_histories_texts(spark, tmp_path):
    with gzip.open(tmp_path / "GE_2020.csv.gz", "wt") as f:
        f.write("pid,Year,State_Name,Constituency_Name,Party,Candidate,Sex\np,2019,S,C,P,N,M\n")
    assert files.read_tuples(spark, str(tmp_path)).first()["Year"] == 2019
    (tmp_path / "m.json").write_text(json.dumps({"markers": {"a": "empty"}}))
    assert [tuple(r) for r in files.read_markers(spark, str(tmp_path / "m.json")).collect()] == [("a", "empty")]
    os.mkdir(tmp_path / "h")
    (tmp_path / "h" / "1.json").write_text(json.dumps({"mpsno": 1, "house": "ls", "ge_pid": "", "ae_pid": "AE1"}))
    (tmp_path / "h" / "2.json").write_text("{broken")
    assert [tuple(r) for r in files.read_histories(spark, str(tmp_path / "h")).collect()] == [("ls", 1, "AE1")]
    os.mkdir(tmp_path / "t")
    (tmp_path / "t" / "LS16_S10_U_1.txt").write_text("x\ny")
    (tmp_path / "t" / "notes.md").write_text("no")
    assert [tuple(r) for r in files.read_texts(spark, str(tmp_path / "t")).collect()] == [("LS16_S10_U_1", "x\ny")]


def test_listing_stops_after_a_page_without_news(spark):
    here = os.path.dirname(os.path.abspath(__file__))
    sys.path.insert(0, here)
    spark.sparkContext.addPyFile(os.path.join(here, "listing_stub.py"))
    spark.dataSource.register(ListingSource)
    got = spark.read.format("rollcall_listing").options(record_schema="id int, title string", fetch="listing_stub:fetch", scopes="[1, 2]", keys="id").load()
    assert sorted({r.id for r in got.collect()}) == [11, 12, 21, 22]


def test_terms():
    assert files.parse_terms("3-5", []) == [3, 4, 5] and files.parse_terms("7,3", []) == [3, 4, 5, 6, 7] and files.parse_terms("all", [1]) == [1]


def test_sinks(spark, tmp_path):
    df = spark.createDataFrame([("ls", 1, "x"), ("ls", 2, "y"), ("rs", 3, "z")], "house string, n int, at string")
    manifest = sinks.write_reports(df, str(tmp_path / "r"), ["house"], [F.desc("n")])
    assert {tuple(r) for r in manifest.collect()} == {("ls", 2), ("rs", 1)}
    p = str(tmp_path / "i")
    assert sinks.write_idempotent(df, p, ["at"]) and not sinks.write_idempotent(df.withColumn("at", F.lit("later")), p, ["at"])
    assert sinks.write_idempotent(df.where("n < 3"), str(tmp_path / "j"))
    assert sinks.cooled_down(None, 0) and not sinks.cooled_down(0, 100) and sinks.may_replace(df, 9) and not sinks.may_replace(df.limit(0), 9)


def test_bills_and_bundled_ids(spark, tmp_path):
    (tmp_path / "index-1.json").write_text(json.dumps({"records": [{"billNumber": "7", "billYear": 2001, "compositeId": "b|7"}, {"billNumber": None}]}))
    (tmp_path / "other.json").write_text("{}")
    assert {(r.billNumber, r.billYear) for r in files.read_bills(spark, str(tmp_path)).collect()} == {("7", 2001), (None, None)}
    assert files.read_bills(spark, str(tmp_path / "none")).count() == 0 == files.read_bundled_ids(spark, str(tmp_path / "none")).count()
    new, old = tmp_path / "new", tmp_path / "old"
    new.mkdir(), old.mkdir()
    (new / "texts-a.json").write_text(json.dumps({"shard": "a", "records": {"x": "text", "y": {"r2": True}}}))
    (new / "manifest.json").write_text(json.dumps({"schema": 2}))
    (old / "manifest.json").write_text(json.dumps({"record_to_shard": {"p": "a", "q": "b"}}))
    assert {r[0] for r in files.read_bundled_ids(spark, str(new)).collect()} == {"x", "y"} and {r[0] for r in files.read_bundled_ids(spark, str(old)).collect()} == {"p", "q"}


def test_debate_days_bundles_and_rosters(spark):
    rows = [
        (1, "02/01/2001", "Floor version", "http:\\\\h\\02012001.pdf", 1), (1, "02/01/2001", "Floor", "http://h/20010102b.pdf", 2), (1, "02/01/2001", "English", "http://h/03012001.pdf", 3),
        (1, "31/02/2001", "Floor", "http://h/31022001.pdf", 4), (2, "05.06.2003", "English", None, 1), (None, None, None, None, None),
    ]
    days = {(r.session, r.date_iso): [tuple(v) for v in r.file_versions] for r in records.debate_days(spark.createDataFrame(rows, "session int, date string, version string, url string, place int")).collect()}
    assert days == {(1, "2001-01-02"): [("floor", "http://h/02012001.pdf")], (2, "2003-06-05"): []}
    raw = spark.createDataFrame([(1, "02.01.2001", "starred", " u "), (1, "x", "starred", "u"), (1, "02.01.2001", "Unstarred", " "), (1, "02.01.2001", None, None)], "session int, date string, type string, pdf_url string")
    assert [(r.date_iso, r.type, r.pdf_url) for r in records.question_bundles(raw).collect()] == [("2001-01-02", "STARRED", "u")]
    assert records.question_scopes([17, 18], [1]) == [{"term": 17, "session": 1, "type": "STARRED"}, {"term": 17, "session": 1, "type": "UNSTARRED"}, {"term": 18, "session": 1, "type": "STARRED"}, {"term": 18, "session": 1, "type": "UNSTARRED"}]
    own = sorted({f for pair in records.ROSTER_FIELDS.values() for f in pair if f})
    ls_schema = "mpsno int, age int, noOfTerms int, loksabha int, sitting boolean, " + ", ".join(f"{f} string" for f in own)
    rs_schema = "mpsno int, age int, termCount int, mpFlag int, " + ", ".join(f"{f} string" for f in own)
    ls = [(5, 40, 2, term, sitting, *[f" {f} " if f != "email" else None for f in own]) for term, sitting in ((17, True), (18, False), (18, True))]
    rs = [(5, 50, 1, flag, *[f for f in own]) for flag in (0, 1)]
    terms = records.roster_terms(spark.createDataFrame(ls, ls_schema), spark.createDataFrame(rs, rs_schema))
    assert len(terms.columns) == 21 and terms.count() == 5
    master = {r.house: r for r in records.roster_master(terms).collect()}
    assert (master["ls"].loksabha, master["ls"].sitting, master["ls"].constituency, master["ls"].email) == (18, True, "constName", "")
    assert (master["rs"].sitting, master["rs"].constituency, master["rs"].full_name_lastfirst, master["rs"].full_name_firstlast) == (True, None, "name", "")
    linked = records.with_history(terms, spark.createDataFrame([("ls", 5, None), ("ls", 5, "GE1")], "house string, mpsno int, link string"))
    assert {(r.house, r.link) for r in linked.collect()} == {("ls", "GE1"), ("rs", None)} and linked.count() == 5


def test_listing_reads_known_keys_and_totals(spark, tmp_path):
    from rollcall.sources.listing import ListingReader

    here = os.path.dirname(os.path.abspath(__file__))
    sys.path.insert(0, here)
    spark.createDataFrame([("1", 11), ("1", 12), ("2", 21)], "scope string, id int").write.parquet(str(tmp_path / "known"))
    options = {"fetch": "listing_stub:fetch", "scopes": "[1, 2]", "keys": "id", "known": str(tmp_path / "known")}
    reader = ListingReader(options, ["id"])
    got = [[r[0] for r in reader.read(p)] for p in reader.partitions()]
    import listing_stub

    # a first page without news ends a scope
    assert got == [[11], [21]]
    listing_stub.total = lambda scope, page: {"records": [{"id": 10 * page + i} for i in range(2)], "total": 5}
    reader = ListingReader({"fetch": "listing_stub:total", "scopes": "[1]", "keys": "id", "page_size": "2"}, ["id"])
    assert [r[0] for r in reader.read(reader.partitions()[0])] == [10, 11, 20, 21, 30, 31]
