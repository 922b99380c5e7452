"""Readers and writers on files made in a fresh folder."""

import pytest
from pyspark.sql import functions as F

from plenary import schemas
from plenary.operators.dedup import distinct_values
from plenary.operators.filters import flag_procedural
from plenary.sources import landed, sinks, tables


def write(path, text, encoding="utf-8"):
    path.write_bytes(text.encode(encoding))
    return str(path)


def rows(df, *order):
    return [tuple(r) for r in df.orderBy(*(order or df.columns)).collect()]


def test_csv_with_byte_order_mark_and_quotes(spark, tmp_path):
    path = write(tmp_path / "m.csv", 'monaCode,이름,정당,선거구,성별\n00A1,강,"a, ""b""",울산 울주군,남\nB2,김,,,여\n', "utf-8-sig")
    df = tables.read_csv(spark, path, schemas.MEMBER)
    assert df.columns[0] == "monaCode"
    assert rows(df) == [("00A1", "강", 'a, "b"', "울산 울주군", "남"), ("B2", "김", None, None, "여")]


def test_lenient_csv_drops_long_rows_and_pads_short_ones(spark, tmp_path):
    path = write(tmp_path / "p.csv", 'party,color\na,#1\nb\nc,#2,extra\n"d,e",#3\n"f",#4,"x,y"\n')
    df = tables.read_csv_lenient(spark, path, schemas.PARTY_COLOR)
    assert rows(df) == [("a", "#1"), ("b", None), ("d,e", "#3")]
    assert df.select("color").where("color IS NOT NULL").count() == 2


def test_csv_encodings(spark, tmp_path):
    utf = write(tmp_path / "a.csv", "party,color\n무소속,#a5aaa3\n")
    korean = write(tmp_path / "b.csv", "party,color\n국민의힘,#e61e2b\n", "cp949")
    assert rows(tables.read_csv_any_encoding(spark, [utf, korean], schemas.PARTY_COLOR)) == [
        ("국민의힘", "#e61e2b"), ("무소속", "#a5aaa3")]
    (tmp_path / "c.csv").write_bytes(b"party,color\n\xff\xff\xff,x\n")
    with pytest.raises(ValueError, match="c.csv"):
        tables.read_csv_any_encoding(spark, str(tmp_path / "c.csv"), schemas.PARTY_COLOR)


def test_terms_from_file_names(spark, tmp_path):
    for term in (20, 21):
        write(tmp_path / f"members{term}_v3.csv", f"monaCode,이름,정당,선거구,성별\nM{term},가,나,다,남\n", "utf-8-sig")
    df = tables.read_terms(spark, str(tmp_path / "*.csv"), schemas.MEMBER)
    assert rows(df.select("age", "monaCode")) == [(20, "M20"), (21, "M21")]
    assert [r[0] for r in tables.terms_present(spark, str(tmp_path)).collect()] == [20, 21]


def test_key_list_lines_and_rows(spark, tmp_path):
    path = write(tmp_path / "ids.csv", "bill_id\nPRC_A\nPRC_B\n")
    assert rows(tables.read_key_list(spark, path)) == [("PRC_A",), ("PRC_B",)]
    assert tables.read_lines(spark, path).count() == 3
    made = tables.rows_to_table(spark, [("u", None), (None, None), ("u", "t")], schemas.MISSING_TITLE)
    assert rows(distinct_values(made, "url")) == [("u",)]


def test_binary_files(spark, tmp_path):
    (tmp_path / "a.pdf").write_bytes(b"%PDF-1.4 x")
    (tmp_path / "b.pdf").write_bytes(b"<html>")
    got = tables.read_binary(spark, str(tmp_path), "*.pdf").select(F.substring_index("path", "/", -1), "is_pdf")
    assert sorted(tuple(r) for r in got.collect()) == [("a.pdf", True), ("b.pdf", False)]


def test_landed_id_and_vote_pages(spark, tmp_path):
    path = write(tmp_path / "pages.json", "\n".join([
        '{"BILLRCP":[{"head":[{"list_total_count":3}]},{"row":[{"BILL_ID":"A","PROC_RSLT":"원안가결","X":1},{"PROC_RSLT":"폐기"}]}]}',
        '{"BILLRCP":[{"head":[{"list_total_count":3}]}]}',
        '{"RESULT":{"CODE":"INFO-200"}}',
        "not json",
        '{"BILLRCP":[{"head":[]},{"row":[{"BILL_ID":"B","PROC_RSLT":"수정가결"},{"BILL_ID":"A","PROC_RSLT":"원안가결"}]}]}',
    ]))
    bills = landed.bill_rows(landed.read_pages(spark, path))
    assert rows(bills.na.fill("-")) == [("-", "폐기"), ("A", "원안가결"), ("A", "원안가결"), ("B", "수정가결")]
    votes = spark.createDataFrame([(
        '{"nojepdqqaweusdfbi":[{"head":[]},{"row":[{"AGE":"22","MONA_CD":"M1","BILL_ID":"A","VOTE_DATE":"20241114 101112"}]}]}',)], "body string")
    got = landed.vote_rows(votes).first()
    assert (got["AGE"], got["MONA_CD"], got["BILL_ID"], got["RESULT_VOTE_MOD"]) == ("22", "M1", "A", None)


def test_geojson(spark, tmp_path):
    path = write(tmp_path / "g.json", """{"type": "FeatureCollection", "features": [
      {"properties": {"SGG_Code": "2110101", "SGG": "종로"}, "geometry": {"type": "Point", "coordinates": [1, 2.5]}},
      {"properties": {"SGG_Code": 2110201}, "geometry": null},
      {"properties": {"SGG_Code": "2110101"}, "geometry": {"type": "Point", "n": "가"}}]}""")
    assert rows(landed.read_geojson(spark, path).na.fill("null")) == [("2110101", '{"type":"Point","n":"가"}'), ("2110201", "null")]


def test_geojson_files_and_lines(spark, tmp_path):
    feature = '{"properties": {"SGG_Code": "%s"}, "geometry": {"n": %d}}'
    for name, numbers in (("a", (1, 2)), ("b", (3,))):
        write(tmp_path / f"{name}.json", '{"features": [' + ", ".join(feature % ("1", n) for n in numbers) + "]}")
        write(tmp_path / f"{name}.lines", "\n".join(feature % (k, n) + "," for k, n in (("1", numbers[-1]), (name, 0))))
    assert rows(landed.read_geojson(spark, str(tmp_path / "*.json"))) == [("1", '{"n":3}')]
    assert rows(landed.read_feature_lines(spark, str(tmp_path / "*.lines"))) == [("1", '{"n":3}'), ("a", '{"n":0}'), ("b", '{"n":0}')]


def test_landing_report(spark):
    pages = spark.createDataFrame([
        ('{"BILLRCP":[{"head":[{"list_total_count":3}]},{"row":[{"BILL_ID":"A"},{"BILL_ID":"B"}]}]}',),
        ('{"BILLRCP":[{"head":[{"list_total_count":4}]}]}',), ("not json",), (None,)], "body string")
    assert tuple(landed.page_report(pages, landed.BILL_SERVICE).first()) == (4, 2, 1, 2, 4)


def test_rejected_rows(spark, tmp_path):
    path = write(tmp_path / "p.csv", 'party,color\na,#1\nb\nc,#2,extra\n"d,e",#3\n')
    got = tables.csv_rejects(spark, path, schemas.PARTY_COLOR)
    assert [(r["path"].split("/")[-1], r["row"], r["fields"]) for r in got.collect()] == [("p.csv", "c,#2,extra", 3)]


def test_csv_writers(spark, tmp_path):
    df = spark.createDataFrame([("a,b", None, 1), ('q"', "", 2)], "x string, y string, n int").coalesce(1)

    def lines(folder):
        part = next(p for p in (tmp_path / folder).iterdir() if p.name.startswith("part-"))
        return part.read_text().splitlines()

    sinks.write_csv(df, str(tmp_path / "plain"), null_as="NULL")
    assert lines("plain") == ["x,y,n", '"a,b",NULL,1', '"q""",,2']
    sinks.write_csv(df, str(tmp_path / "quoted"), quote_all=True)
    assert lines("quoted")[0:2] == ['"x","y","n"', '"a,b","","1"']
    sinks.write_unquoted(df, str(tmp_path / "bare"))
    assert lines("bare") == ["x,y,n", r"a\,b,,1", 'q",,2']


def test_csv_round_trip(spark, tmp_path):
    texts = ["a,b", 'say "x"', "two\nlines", "carriage\r\nreturn", " lead", "tail ", "\\", "한글", "#", "'"]
    df = spark.createDataFrame(list(enumerate(texts)), "i string, content string")
    df = df.select(F.col("i").alias("party"), F.col("content").alias("color"))
    sinks.write_csv(df, str(tmp_path / "csv"))
    back = tables.read_csv(spark, str(tmp_path / "csv"), schemas.PARTY_COLOR)
    got = {r[0]: r[1] for r in back.collect()}
    missing = spark.createDataFrame([("a", None), ("b", "NULL"), ("c", "nan"), ("d", "")], schemas.PARTY_COLOR)
    sinks.write_csv(missing, str(tmp_path / "missing"), null_as="NULL")
    assert tables.read_csv(spark, str(tmp_path / "missing"), schemas.PARTY_COLOR).where("color IS NULL").count() == 4
    assert got == {str(i): t for i, t in enumerate(texts)}


def test_partitioned_writers(spark, tmp_path):
    bills = spark.createDataFrame([(20, "예산안 심사"), (21, "법률안"), (21, None)], "age int, title string")
    sinks.write_by_value(bills, str(tmp_path / "terms"), "age")
    assert spark.read.parquet(str(tmp_path / "terms")).where("age = 21").count() == 2
    sinks.write_by_value(bills, str(tmp_path / "terms_csv"), "age", "csv")
    assert (tmp_path / "terms_csv" / "age=20").is_dir()
    sinks.write_split(flag_procedural(bills), str(tmp_path / "split"))
    split = spark.read.parquet(str(tmp_path / "split"))
    assert split.where("removed = 'true'").count() == 1 and split.where("removed = 'false'").count() == 2
    kept = sinks.write_backup(bills, str(tmp_path / "backup"))
    assert rows(kept.na.fill("")) == rows(bills.na.fill(""))
    sinks.write_stages({"a": bills, "b": bills.limit(1)}, str(tmp_path / "stages"))
    assert spark.read.parquet(str(tmp_path / "stages" / "a")).count() == 3
