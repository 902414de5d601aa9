import pytest
from pyspark.sql import functions as F

from rollcall.functions import bodies, dates, keys, names, places, text


def value(spark, column, **row):
    schema = ", ".join(f"{k} string" for k in row)
    return spark.createDataFrame([tuple(row.values())], schema).select(column.alias("x")).first()["x"]


@pytest.mark.parametrize("key,bucket,group", [
    ("ls|LS16_S10_U_1", "ls-LS16-S10", "ls-LS16-S10-0000"),
    ("rs|RS241_2016-12-07_U", "rs-RS241-2016-12-07", "rs-RS241-2016-12-07-0000"),
    ("rs|RS239_2016-05-03|floor", "rs-RS239-2016-05-03", "rs-RS239-2016-05-03-0000"),
    ("ls|LS18_S7_S_12750", "ls-LS18-S7", "ls-LS18-S7-0051"),
    ("||", "misc", "misc"), ("", "misc", "misc"), ("note", "note", "note"),
])
def test_keys(spark, key, bucket, group):
    assert value(spark, keys.bucket(F.col("k")), k=key) == bucket
    assert value(spark, keys.shard_group(F.col("k")), k=key) == group


@pytest.mark.parametrize("name,bag,slug", [
    ("Joshi, Dr. Murli Manohar", "joshi manohar murli", "joshi-murli-manohar"), ("Prof. S P Singh Baghel", "baghel p s singh", "s-p-singh-baghel"),
    (None, "", "anon"), ("", "", "anon"), ("Shri Ram Ram", "ram ram", "ram-ram"),
])
def test_names(spark, name, bag, slug):
    assert value(spark, names.name_bag(F.col("n")), n=name) == bag
    assert value(spark, names.name_slug(F.col("n")), n=name) == slug


@pytest.mark.parametrize("a,b,score", [("purandeswari", "purandheshwari", 0.6), ("rajnath", "raj nath", 0.6), ("dharmendra yadav", "mulayam singh yadav", 0.0), ("lalu prasad", "prasad lalu", 1.0), ("lalu x", "lalu y gopal", 0.8)])
def test_name_score(spark, a, b, score):
    assert value(spark, names.name_score(F.split("a", " "), F.split("b", " ")), a=a, b=b) == score


@pytest.mark.parametrize("raw,normal", [("Shri Smt. Ram Lal Dr.", "ram lal"), ("श्री राम", "राम"), (None, ""), ("  ", "")])
def test_normal_form(spark, raw, normal):
    assert value(spark, names.normal_form(F.col("n")), n=raw) == normal


def test_places(spark):
    assert value(spark, places.same_constituency(F.col("a"), F.col("b")), a="bangalore cent", b="bangalore central") is True
    assert value(spark, places.same_constituency(F.col("a"), F.col("b")), a="delhi", b="delhi north") is False
    assert value(spark, places.title_case(F.col("a")), a="o'brien-foo d.n. (sc)") == "O'Brien-Foo D.N. (SC)"
    assert value(spark, places.constituency(F.col("a")), a="Trivandrum (GEN)") == "thiruvananthapuram"
    assert value(spark, places.party(F.col("a")), a=" Ind.. ") == "IND"


@pytest.mark.parametrize("raw,day", [
    ("2007-07-10", "2007-07-10"), ("1/2/1996", "1996-02-01"), ("31.12.1982", "1982-12-31"), ("01-Apr-2025", "2025-04-01"), ("  01  August 2024", "2024-08-01"),
    ("1960-08-04T00:00:00", "1960-08-04"), ("1977-02-30", None), ("31/06/1984", None), ("unknown", None), ("", None), (None, None), ("0000-00-00", None), ("5 May 2001", "2001-05-05"),
])
def test_parse_day(spark, raw, day):
    got = value(spark, dates.parse_day(F.col("d")), d=raw)
    assert (got and got.isoformat()) == day


def test_day_readings(spark):
    assert value(spark, dates.slash_day(F.col("d")), d="31/2/2001") == "2001-02-31"
    assert value(spark, dates.strict_dob(F.col("d")), d="1/2/2001") is None
    assert value(spark, dates.lenient_dob(F.col("d")), d=" junk ") == "junk"
    assert value(spark, dates.sort_key(F.col("d"), "."), d="14.02.2022") == "2022-02-14"
    assert value(spark, dates.term_year(dates.term_number(F.col("d"))), d="LS17") == 2019


def test_text(spark):
    assert value(spark, text.tokens(F.col("t")), t="Ab abc 12345 नमस्ते xyz1") == ["abc", "12345", "xyz1"]
    assert bodies.html_text("<p>One</p><style>x</style><div>Two &amp;   three</div>") == "One\nTwo & three"
    assert bodies.html_text(None) == "" and bodies.extract(b"") == (None, "empty")


def test_word_and_broken_files(spark, tmp_path):
    import zipfile

    p = tmp_path / "a.docx"
    w = "http://schemas.openxmlformats.org/wordprocessingml/2006/main"
    with zipfile.ZipFile(p, "w") as z:
        z.writestr("word/document.xml", f'<w:document xmlns:w="{w}"><w:body><w:p><w:r><w:t>Hello</w:t></w:r></w:p><w:p><w:r><w:t>World</w:t></w:r></w:p></w:body></w:document>')
    assert bodies.extract(p.read_bytes()) == ("Hello\nWorld", "text")
    assert bodies.extract(b"PKbroken") == (None, "error")
    df = spark.createDataFrame([(bytearray(p.read_bytes()),), (None,)], "content binary").select(bodies.extracted(F.col("content")).alias("x")).select("x.*")
    assert {tuple(r) for r in df.collect()} == {("Hello\nWorld", "text"), (None, "empty")}
