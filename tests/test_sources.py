"""Scans and sinks over files written by hand and by the sinks themselves."""

import json

import pandas as pd
import pytest

from tarjuman.operators import shape
from tarjuman.sources import scans, sinks

QUOTED = 'id,note,size,flag,path\n1,"say ""hi"", ok\nline2",1.5,True,C:\\x\n2,NA,NaN,,\n3,  padded ,2e3,False,x\n'


def rows(df, *columns):
    return sorted(tuple(r) for r in df.select(*columns).collect())


def test_csv_quotes_newlines_missing_and_types(spark, tmp_path):
    (tmp_path / "a.csv").write_text(QUOTED)
    df = scans.scan_csv(spark, str(tmp_path / "a.csv"))
    assert [f.dataType.simpleString() for f in df.schema] == [
        "bigint", "string", "double", "boolean", "string"]
    assert rows(df, *df.columns) == [
        (1, 'say "hi", ok\nline2', 1.5, True, "C:\\x"),
        (2, None, None, None, None),
        (3, "  padded ", 2000.0, False, "x"),
    ]


def test_csv_with_schema_skips_inference(spark, tmp_path):
    (tmp_path / "a.csv").write_text("id,v\n1,07\n2,x\n")
    from pyspark.sql.types import LongType, StringType, StructType
    schema = StructType().add("id", LongType()).add("v", StringType())
    assert rows(scans.scan_csv(spark, str(tmp_path), schema), "id", "v") == [(1, "07"), (2, "x")]


def test_csv_options_save_the_profile(spark, tmp_path, monkeypatch):
    (tmp_path / "a.csv").write_bytes("id,t\n1,café\n".encode("latin-1"))
    monkeypatch.delattr(scans, "csv_profile")
    df = scans.scan_csv(spark, str(tmp_path), encoding="ISO-8859-1", spans_lines=False)
    assert rows(df, "id", "t") == [(1, "café")]


def test_numbers_that_only_java_knows_stay_text(spark, tmp_path):
    (tmp_path / "a.csv").write_text("v,w\n1d,99999999999999999999\n2f,1\n")
    kinds = dict(scans.scan_csv(spark, str(tmp_path)).dtypes)
    assert kinds == {"v": "string", "w": "double"}


def test_latin1_fallback_is_per_file(spark, tmp_path):
    (tmp_path / "u.csv").write_bytes("id,t\n1,café\n".encode("utf-8"))
    (tmp_path / "l é.csv").write_bytes("id,t\n2,café\n3,plain\n".encode("latin-1"))
    flags = {r["path"].rsplit("/", 1)[-1][0]: r["is_utf8"] for r in
             scans.csv_profile(spark, str(tmp_path)).collect()}
    assert flags == {"u": True, "l": False}
    assert rows(scans.scan_csv(spark, str(tmp_path)), "id", "t") == [
        (1, "café"), (2, "café"), (3, "plain")]


def test_only_files_with_open_quotes_are_read_whole(spark, tmp_path):
    (tmp_path / "a.csv").write_text('id,t\n1,"x ""y"" z"\n')
    (tmp_path / "b.csv").write_text('id,t\n2,"x\ny"\n')
    flags = {r["path"][-5]: r["spans_lines"] for r in
             scans.csv_profile(spark, str(tmp_path)).collect()}
    assert flags == {"a": False, "b": True}
    assert rows(scans.scan_csv(spark, str(tmp_path)), "id", "t") == [(1, 'x "y" z'), (2, "x\ny")]


def test_headers_in_any_order_and_of_any_length(spark, tmp_path):
    (tmp_path / "deep").mkdir()
    for i in range(3):
        (tmp_path / f"a{i}.csv").write_text(f"id,t,v\n{i},t{i},{i}.5\n")
    (tmp_path / "b.csv").write_text("v,id,t\n9.5,9,t9\n")
    (tmp_path / "deep/c é.csv").write_text('t,"more, ""x""",id\n"t,8",m,8\n')
    (tmp_path / "d.csv").write_bytes("größe,id\n1,7\n".encode("latin-1"))
    df = scans.scan_csv(spark, str(tmp_path))
    assert dict(df.dtypes) == {"id": "bigint", "t": "string", "v": "double", 'more, "x"': "string", "größe": "bigint"}
    assert rows(df, "id", "t", "v", "`more, \"x\"`", "größe") == [
        (0, "t0", 0.5, None, None), (1, "t1", 1.5, None, None), (2, "t2", 2.5, None, None),
        (7, None, None, None, 1), (8, "t,8", None, "m", None), (9, "t9", 9.5, None, None)]


def test_most_files_are_not_listed(spark, tmp_path):
    for i in range(4):
        (tmp_path / f"a{i}.csv").write_text(f"id,t\n{i},x\n")
    (tmp_path / "z.csv").write_text("t,id\nx,4\n")
    files = scans.Files.of(str(tmp_path))
    profile = scans.csv_profile(spark, files)
    (_, most), (_, other) = scans._alike(profile, ["header"], files)
    assert most.paths == files.paths and len(most.without) == 1 and len(other.paths) == 1


@pytest.mark.parametrize("line, names", [
    ("a,b", ["a", "b"]), ('"a ""q""",b', ['a "q"', "b"]), ("a,,A", ["a0", "_c1", "A2"]), ('"a', None), ("\ufeffid,t", ["id", "t"]),
])
def test_header_names(line, names):
    assert scans.header_names(line, ",") == names


def test_a_quoted_newline_in_a_header(spark, tmp_path):
    (tmp_path / "a.csv").write_text('id,"two\nlines"\n1,x\n')
    (tmp_path / "b.csv").write_text("id,t\n2,y\n")
    df = scans.scan_csv(spark, str(tmp_path))
    assert set(df.columns) == {"id", "two\nlines", "t"} and rows(df, "id", "t") == [(1, None), (2, "y")]


@pytest.mark.parametrize("ending, body", [
    ("csv", "id\n{0}\n"), ("tsv", "id\n{0}\n"), ("jsonl", '{{"id": {0}}}\n'), ("json", '[\n{{"id": {0}}}\n]'),
])
def test_partition_folders_of_any_format(spark, tmp_path, ending, body):
    places = [("en", 2023), ("a b/ü+%", 2024), (None, 2024)]
    for i, (lang, year) in enumerate(places):
        name = "__HIVE_DEFAULT_PARTITION__" if lang is None else lang.replace("%", "%25").replace("/", "%2F")
        folder = tmp_path / "of=root" / f"lang={name}" / f"year={year}"
        folder.mkdir(parents=True)
        (folder / f"x.{ending}").write_text(body.format(i))
    df = scans.scan_files(spark, str(tmp_path / "of=root"))
    assert dict(df.dtypes) == {"id": "bigint", "lang": "string", "year": "int"}
    got = {r["id"]: (r["lang"], r["year"]) for r in df.collect()}
    assert got == {i: place for i, place in enumerate(places)}
    assert dict(scans.scan_files(spark, str(tmp_path / "of=root"), ending).dtypes) == dict(df.dtypes)


def test_partition_folders_of_mixed_formats(spark, tmp_path):
    spark.createDataFrame([(1, "en"), (2, "de")], "id long, lang string").write.partitionBy("lang").parquet(str(tmp_path / "t"))
    (tmp_path / "t/lang=en/more.jsonl").write_text('{"id": 3}\n')
    (tmp_path / "t/lang=fr").mkdir()
    (tmp_path / "t/lang=fr/x.csv").write_text("id\n4\n")
    (tmp_path / "t/x.csv").write_text("id\n5\n")
    (tmp_path / "t/y.csv").write_text("lang,id\nes,6\n")
    df = scans.scan_files(spark, str(tmp_path / "t"))
    assert rows(df, "id", "lang") == [(1, "en"), (2, "de"), (3, "en"), (4, "fr"), (5, None), (6, "es")]


def test_split_names(spark, tmp_path):
    folder = tmp_path / "user" / "set"
    folder.mkdir(parents=True)
    for i, name in enumerate(["train.parquet", "train-0.parquet", "train-00001-of-00002.parquet", "trainer.parquet", "train-x.parquet"]):
        pd.DataFrame({"id": [i]}).to_parquet(folder / name)
    assert rows(scans.scan_split(spark, str(tmp_path), "user/set"), "id") == [(0,), (1,), (2,)]


def test_header_only_and_empty_files(spark, tmp_path):
    (tmp_path / "a.csv").write_text("id,t\n")
    assert scans.scan_csv(spark, str(tmp_path / "a.csv")).columns == ["id", "t"]


def test_json_array_and_lines(spark, tmp_path):
    records = [{"id": i, "t": f"x\n{i}"} for i in range(5)]
    (tmp_path / "indented.json").write_text(json.dumps(records[:2], indent=2))
    (tmp_path / "one_line.json").write_text(json.dumps(records[2:3]))
    (tmp_path / "lines.json").write_text("\n".join(map(json.dumps, records[3:])))
    expected = [(r["id"], r["t"]) for r in records]
    assert rows(scans.scan_json(spark, str(tmp_path)), "id", "t") == expected


def test_mixed_folder_of_all_formats(spark, tmp_path):
    pd.DataFrame({"id": [1], "t": ["csv"]}).to_csv(tmp_path / "a.CSV", index=False)
    pd.DataFrame({"id": [2], "t": ["tsv"]}).to_csv(tmp_path / "b.tsv", sep="\t", index=False)
    (tmp_path / "c.json").write_text('[\n{"id": 3, "t": "json"}\n]')
    (tmp_path / "d.jsonl").write_text('{"id": 4, "t": "jsonl"}\n')
    (tmp_path / "e.ndjson").write_text('{"id": 5, "t": "ndjson"}\n')
    pd.DataFrame({"id": [6], "t": ["parquet"]}).to_parquet(tmp_path / "f.parquet")
    (tmp_path / "none").write_text("id,t\n7,none\n")
    got = rows(scans.load_table(spark, str(tmp_path)), "id", "t")
    assert got == list(enumerate(["csv", "tsv", "json", "jsonl", "ndjson", "parquet", "none"], 1))


def test_types_that_differ_between_formats_become_text(spark, tmp_path):
    (tmp_path / "a.csv").write_text("id,v\n1,5\n")
    (tmp_path / "b.jsonl").write_text('{"id": 2, "v": "x", "w": 1}\n')
    df = scans.scan_files(spark, str(tmp_path))
    assert rows(df, "id", "v") == [(1, "5"), (2, "x")]
    assert {r["w"] for r in df.collect()} == {None, 1}


def test_unsupported_format(spark, tmp_path):
    (tmp_path / "a.csv").write_text("id\n1\n")
    with pytest.raises(ValueError, match="Unsupported format: xml"):
        scans.scan_files(spark, str(tmp_path), "xml")


def test_resolution_order(spark, tmp_path):
    hub, shop = tmp_path / "hub", tmp_path / "shop"
    for split, value in (("train", 1), ("test", 2)):
        folder = hub / "user" / "set" / "v1"
        folder.mkdir(parents=True, exist_ok=True)
        pd.DataFrame({"id": [value]}).to_parquet(folder / f"{split}-0.parquet")
    (shop / "user/set/deep").mkdir(parents=True)
    (shop / "user/set/deep/a.md").write_text("no table")
    (shop / "user/set/deep/b.csv").write_text("id\n3\n")
    (shop / "user/set/z.jsonl").write_text('{"id": 4}\n')
    (shop / "user/only").mkdir(parents=True)
    (shop / "user/only/x.csv").write_text("id\n5\n")
    roots = {"huggingface": str(hub), "kaggle": str(shop)}

    def load(source, **options):
        return [r["id"] for r in scans.load_table(spark, source, roots=roots, **options).collect()]

    assert load("huggingface:user/set", subset="v1") == [1]
    assert load("huggingface:user/set", subset="v1", split="test") == [2]
    assert load("user/set", subset="v1") == [1]
    assert load("kaggle:user/set") == [3]
    assert load("kaggle:user/set", file_name="z.jsonl") == [4]
    assert load("user/only") == [5]
    assert load(str(shop / "user/set/z.jsonl")) == [4]
    with pytest.raises(FileNotFoundError):
        load("kaggle:user/set", file_name="absent.csv")
    with pytest.raises(ValueError, match="Could not load"):
        load("no/where")


@pytest.mark.parametrize("kind", ["csv", "json", "parquet"])
def test_sink_round_trip(spark, tmp_path, kind):
    texts = [' padded\t', 'a "q", b', "line\nbreak\r\nend", "\\", "مرحبا", None, "x,y", "'"]
    df = spark.createDataFrame(list(enumerate(texts)), "id long, t string")
    path = str(tmp_path / f"out.{kind}")
    assert sinks.write_table(df, path) == kind
    back = {r["id"]: r["t"] for r in scans.scan_files(spark, path).collect()}
    assert back == dict(enumerate(texts))


def test_output_format_rule():
    assert sinks.output_format("a/x.json") == "json"
    assert sinks.output_format("a/x.csv", "parquet") == "parquet"
    assert sinks.output_format("a/x.weird") == "csv"
    assert sinks.statistics_path("data/out.csv") == "data/out_stats.json"
    assert sinks.statistics_path("out") == "out_stats.json"
    with pytest.raises(ValueError):
        sinks.output_format("x", "xlsx")


def test_dense_row_id_over_files(spark, tmp_path):
    for name, values in (("a", range(3)), ("b", range(3, 10)), ("c", range(10, 12))):
        pd.DataFrame({"v": list(values)}).to_parquet(tmp_path / f"{name}.parquet")
    df = shape.with_row_id(spark.read.parquet(str(tmp_path)), dense="n")
    assert all(r["v"] == r["n"] for r in df.collect())
    assert df.columns == ["v", "source_file", "source_row", "n"]
