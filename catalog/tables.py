"""Scans and sinks, as round trips of the documents through files."""

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import functions as F

from catalog.inputs import DIRTY, dirty, table
from catalog.registry import query
from catalog.replies import _TABLE, _translated
from tarjuman.operators import statistics
from tarjuman.sources import scans, sinks
from tarjuman.workspace import new_folder

COLUMNS = ["doc_id", "text", "lang", "n_chars"]
_ALL = f"select doc_id, text, lang, n_chars from {DIRTY}"
_CSV = dict(header=True, quote='"', escape='"', ignoreLeadingWhiteSpace=False,
            ignoreTrailingWhiteSpace=False)


def _documents(spark, sf):
    return dirty(spark, sf).select(*COLUMNS)


def _round_trip(spark, sf, name: str):
    path = f"{new_folder(spark, 'table')}/documents.{name}"
    sinks.write_table(_documents(spark, sf), path)
    return scans.scan_files(spark, path).select(*COLUMNS)


@query("sink_csv", _ALL)
def sink_csv(spark, sf):
    return _round_trip(spark, sf, "csv")


@query("sink_json", _ALL)
def sink_json(spark, sf):
    return _round_trip(spark, sf, "json")


@query("sink_parquet", _ALL)
def sink_parquet(spark, sf):
    return _round_trip(spark, sf, "parquet")


@query("sink_stats", f"""select count(*) as total, count(text_ar) as successful,
 count(*) - count(text_ar) as failed, count(*) filter (text_api = 'nvidia') as nvidia_used,
 count(*) filter (text_api = 'fanar') as fanar_used from {_TABLE}""")
def sink_stats(spark, sf):
    result = _translated(spark, sf)
    stats = statistics.run_stats(result, ["text"], ["nvidia", "fanar"])
    failures = statistics.failed_cells(result, ["doc_id"], ["text"])
    output = f"{new_folder(spark, 'run')}/documents.parquet"
    return scans.scan_jsonl(spark, sinks.write_statistics(stats, failures, output))


# Cells that CSV readers take for missing: priorities spelled as such.
@query("scan_csv", """select o_orderkey, nullif(o_orderpriority, '5-LOW') as priority,
 case when o_orderstatus <> 'P' then o_totalprice end as price, o_orderstatus = 'O' as is_open,
 'say "' || o_orderpriority || '",' || chr(10) || 'C:\\x' as note from orders""")
def scan_csv(spark, sf):
    priority = F.col("o_orderpriority")
    orders = table(spark, sf, "orders").select(
        "o_orderkey",
        F.when(priority == "5-LOW", "NA").otherwise(priority).alias("priority"),
        F.when(F.col("o_orderstatus") == "P", "NaN")
        .otherwise(F.col("o_totalprice").cast("string")).alias("price"),
        (F.col("o_orderstatus") == "O").alias("is_open"),
        F.concat(F.lit('say "'), priority, F.lit('",\nC:\\x')).alias("note"),
    )
    path = new_folder(spark, "csv")
    orders.write.csv(path, **_CSV)
    return scans.scan_csv(spark, path)


@query("scan_csv_encoding", "select doc_id, text, lang, n_chars from documents")
def scan_csv_encoding(spark, sf):
    docs = table(spark, sf, "documents").select(*COLUMNS)
    fits = ~F.col("text").rlike("[^\\x00-\\x7e\u00a0-\u00ff]")
    latin = F.coalesce((F.col("lang") != "en") & fits, F.lit(False))
    path = new_folder(spark, "encodings")
    docs.where(~latin).write.csv(f"{path}/utf8", encoding="UTF-8", **_CSV)
    docs.where(latin).write.csv(f"{path}/latin1", encoding="ISO-8859-1", **_CSV)
    return scans.scan_csv(spark, path)


@query("scan_tsv", _ALL)
def scan_tsv(spark, sf):
    path = new_folder(spark, "tsv")
    _documents(spark, sf).write.csv(path, sep="\t", **_CSV)
    return scans.scan_tsv(spark, path)


def _array_lines(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """The rows of a partition as one JSON array over many lines."""
    yield pd.DataFrame({"value": ["["]})
    separator = ""
    for batch in batches:
        if len(batch):
            lines = batch["value"].map(lambda value: f",\n{value}")
            lines.iloc[0] = separator + batch["value"].iloc[0]
            separator = ",\n"
            yield pd.DataFrame({"value": lines})
    yield pd.DataFrame({"value": ["]"]})


@query("scan_json", _ALL)
def scan_json(spark, sf):
    path = new_folder(spark, "json")
    rows = _documents(spark, sf).select(F.to_json(F.struct(*COLUMNS)).alias("value"))
    rows.mapInPandas(_array_lines, "value string").write.text(path)
    return scans.scan_json(spark, path)


@query("scan_jsonl", _ALL)
def scan_jsonl(spark, sf):
    path = new_folder(spark, "jsonl")
    _documents(spark, sf).write.json(path)
    return scans.scan_jsonl(spark, path).select(*COLUMNS)


@query("scan_parquet", "select doc_id, text, lang, n_chars from documents")
def scan_parquet(spark, sf):
    return scans.scan_parquet(spark, f"{sf}/documents.parquet").select(*COLUMNS)


@query("scan_mixed", _ALL)
def scan_mixed(spark, sf):
    path = new_folder(spark, "mixed")
    docs = _documents(spark, sf)
    share = [docs.where(F.pmod(F.hash("doc_id"), F.lit(5)) == i) for i in range(5)]
    share[0].write.csv(f"{path}/a", **_CSV)
    share[1].write.options(sep="\t", extension="tsv").csv(f"{path}/b", **_CSV)
    share[2].write.option("extension", "dat").csv(f"{path}/c", **_CSV)
    share[3].write.json(f"{path}/d")
    share[4].write.partitionBy("lang").parquet(f"{path}/e")
    return scans.scan_files(spark, path).select(*COLUMNS)


@query("scan_split", "select doc_id, text, lang, n_chars from documents where lang <> 'de'")
def scan_split(spark, sf):
    root = new_folder(spark, "mirror")
    docs = table(spark, sf, "documents").select(*COLUMNS)
    docs.where("lang <> 'de'").write.parquet(f"{root}/prose/v1/train")
    docs.where("lang = 'de'").write.parquet(f"{root}/prose/v1/test")
    docs.where("lang = 'de'").write.parquet(f"{root}/prose/v1/train_sft")
    return scans.load_table(
        spark, "huggingface:prose", subset="v1", roots={"huggingface": root}
    )


@query("scan_archive", "select p_partkey, p_name, p_brand from part")
def scan_archive(spark, sf):
    root = new_folder(spark, "archives")
    parts = table(spark, sf, "part").select("p_partkey", "p_name", "p_brand")
    parts.select("p_name").write.text(f"{root}/shop/parts/a.md")
    parts.write.csv(f"{root}/shop/parts/items.csv", **_CSV)
    parts.select("p_partkey").write.json(f"{root}/shop/parts/z.json")
    return scans.load_table(spark, "kaggle:shop", roots={"kaggle": root})
