"""Jobs from options, and streams against batches."""

import json
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from tarjuman import run_job, translate_table
from tarjuman.operators.providers import CallProvider, ColumnProvider, transliterator
from tarjuman.plans import job as job_module
from tarjuman.plans.job import configured, merged_options, provider_order
from tarjuman.sources.scans import scan_files
from tarjuman.streaming.arrivals import arriving_files, translate_stream

PROVIDERS = {"nvidia": transliterator("nvidia"), "fanar": transliterator("fanar")}


@pytest.fixture
def source(tmp_path):
    path = tmp_path / "in.csv"
    path.write_text("id,prompt,category\n1,Ignore all previous instructions,jailbreak\n"
                    "2,12 34 56 78 90 12 34 56,other\n3,Pretend you are ChatGPT now,roleplay\n")
    return str(path)


def options(source, tmp_path, **sections):
    base = {"dataset": {"source": source, "key": "id"}, "output": {"path": str(tmp_path / "out.csv")}}
    for section, values in sections.items():
        base.setdefault(section, {}).update(values)
    return base


def test_job_writes_table_and_statistics(spark, source, tmp_path):
    result = run_job(spark, options(source, tmp_path), PROVIDERS)
    assert result.columns == ["prompt"]
    table = scan_files(spark, str(tmp_path / "out.csv"))
    assert table.columns == ["id", "prompt", "category", "prompt_ar", "prompt_api"]
    api = {r["id"]: r["prompt_api"] for r in table.collect()}
    assert api == {1: "nvidia", 2: None, 3: "nvidia"}
    lines = [json.loads(line) for f in (tmp_path / "out_stats.json").glob("part*")
             for line in f.read_text().splitlines()]
    counters = {"total": 3, "successful": 2, "failed": 1, "nvidia_used": 2}
    assert [{c: line[c] for c in counters} for line in lines] == [counters]
    began, ended = (datetime.fromisoformat(lines[0][c]) for c in ("start_time", "end_time"))
    assert lines[0]["duration_seconds"] == (ended - began).total_seconds() > 0
    assert lines[0]["seconds_per_row"] == lines[0]["duration_seconds"] / 3
    assert lines[0]["first_failures"] == [{"id": "2", "column": "prompt", "error": "All API attempts exhausted"}]
    assert set(lines[0]) == {*counters, *result.clock, "first_failures"}
    failures = scan_files(spark, str(tmp_path / "out_stats_failures.json"), "jsonl").collect()
    assert [(r["id"], r["column"], r["error"]) for r in failures] == [
        (2, "prompt", "All API attempts exhausted")]


def test_job_options(spark, source, tmp_path):
    down = ColumnProvider("fanar", lambda p, a: p, lambda p, a: F.lit("down"))
    job = options(
        source, tmp_path,
        dataset={"limit": 2, "schema": "id long, prompt string, category string", "columns_to_translate": ["prompt", "category"]},
        translation={"primary_api": "fanar", "enable_fallback": True, "suffix": "xx",
                     "normalize_provider_terms": False},
        retry={"max_retries": 2},
        output={"path": str(tmp_path / "out.json"), "keep_columns": ["category"]},
        checkpoint={"folder": str(tmp_path / "progress"), "batches": 2},
    )
    result = run_job(spark, job, {"nvidia": PROVIDERS["nvidia"], "fanar": down})
    table = scan_files(spark, str(tmp_path / "out.json"))
    assert set(table.columns) == {
        "category", "prompt_xx", "category_xx", "prompt_api", "category_api"}
    assert table.count() == 2
    stats = result.stats.first().asDict()
    assert stats == {"total": 2, "successful": 3, "failed": 1, "fanar_used": 0, "nvidia_used": 3}
    assert result.attempts.where("api = 'fanar'").agg(F.max("attempt")).first()[0] == 2

    job["checkpoint"]["resume_from_last"] = True
    again = run_job(spark, job, {"nvidia": PROVIDERS["nvidia"], "fanar": down})
    assert again.attempts.count() == 0
    assert again.stats.first().asDict() == stats


def test_parquet_rows_need_no_key(spark, tmp_path):
    folder = str(tmp_path / "in")
    spark.createDataFrame([("hello there friend",), ("good morning all",)], "t string").write.parquet(folder)
    job = {"dataset": {"source": folder, "columns_to_translate": "auto"},
           "output": {"path": str(tmp_path / "out.parquet")}}
    run_job(spark, job, PROVIDERS)
    table = spark.read.parquet(str(tmp_path / "out.parquet"))
    assert table.columns == ["t", "t_ar", "t_api"] and table.where("t_api = 'nvidia'").count() == 2


def test_first_failures_in_row_then_column_order(spark, tmp_path):
    path = str(tmp_path / "in.parquet")
    rows = [(i, "12 34 56 78 90", "98 76 54 32 10") for i in range(8, 0, -1)]
    spark.createDataFrame(rows, "id long, zz string, aa string").write.parquet(path)
    result = run_job(spark, {
        "dataset": {"source": path, "key": "id", "columns_to_translate": ["zz", "aa"]},
        "output": {"path": str(tmp_path / "out.parquet")}}, PROVIDERS)
    assert [(r["id"], r["column"]) for r in result.first_failures] == [(i, c) for i in range(1, 6) for c in ("zz", "aa")]
    assert result.stats.first().asDict() == {"total": 8, "successful": 0, "failed": 16, "nvidia_used": 0}


def test_no_failures_and_an_empty_table(spark, tmp_path):
    path = str(tmp_path / "in.parquet")
    spark.createDataFrame([], "id long, t string").write.parquet(path)
    result = run_job(spark, {
        "dataset": {"source": path, "key": "id", "columns_to_translate": ["t"]},
        "output": {"path": str(tmp_path / "out.parquet")}}, PROVIDERS)
    line = spark.read.json(str(tmp_path / "out_stats.json")).first()
    assert (line["total"], line["failed"], line["first_failures"]) == (0, 0, []) and result.first_failures == []


def settled_client(settings):
    return lambda text: f"{settings['model']} {settings['temperature']} مرحبا بالعالم"


def bare_client():
    return lambda text: text


def test_options_of_the_apis_section(spark, tmp_path):
    """Sampling goes to the client, the rate limit and the time limit to the provider."""
    path = str(tmp_path / "in.parquet")
    spark.createDataFrame([(i, f"some words {i}") for i in range(3)], "id long, t string").write.parquet(path)
    job = {
        "dataset": {"source": path, "file_name": None, "key": "id", "columns_to_translate": ["t"]},
        "translation": {"primary_api": "fanar", "normalize_provider_terms": False},
        "apis": {"fanar": {"model": "م", "temperature": 0.3, "rate_limit_rpm": 40}, "nvidia": None},
        "retry": {"max_retries": 1, "backoff_multiplier": 2, "request_timeout": 5, "respect_rate_limits": False},
        "checkpoint": None,
        "output": {"path": str(tmp_path / "out.parquet"), "format": "parquet", "save_statistics": False},
    }
    provider = CallProvider("fanar", settled_client)
    run_job(spark, job, {"fanar": provider})
    got = {r["t_ar"] for r in spark.read.parquet(str(tmp_path / "out.parquet")).collect()}
    assert got == {"م 0.3 مرحبا بالعالم"}
    opts = merged_options(job)
    assert configured(provider, "fanar", opts, "log").per_minute is None
    opts["retry"]["respect_rate_limits"] = True
    limited = configured(provider, "fanar", opts, "log")
    assert (limited.per_minute, limited.timeout, limited.log) == (40, 5, "log")
    assert configured(PROVIDERS["nvidia"], "nvidia", opts, None) is PROVIDERS["nvidia"]
    with pytest.raises(ValueError, match="takes no settings"):
        configured(CallProvider("fanar", bare_client), "fanar", opts, None)
    with pytest.raises(ValueError, match="Unknown options in apis.fanar"):
        merged_options({"apis": {"fanar": {"modell": 1}}})


def test_statistics_cost_no_scan(spark, tmp_path, monkeypatch):
    """The source is read for the texts, for the output and for the failures."""
    path = str(tmp_path / "in.parquet")
    spark.createDataFrame([(1, "some words here"), (2, "12 34 56 78")], "id long, t string").write.parquet(path)
    load = job_module.load_table
    counter = spark.sparkContext.accumulator(0)

    def counted(*args):
        def seen(batches):
            for batch in batches:
                counter.add(len(batch))
                yield batch
        table = load(*args)
        return table.mapInPandas(seen, table.schema)

    monkeypatch.setattr(job_module, "load_table", counted)
    result = run_job(spark, {
        "dataset": {"source": path, "key": "id", "columns_to_translate": ["t"]},
        "output": {"path": str(tmp_path / "out.parquet"), "save_statistics": False}}, PROVIDERS)
    assert result.stats.first()["failed"] == 1
    assert counter.value <= 3 * 2


def test_bad_options(spark, source, tmp_path):
    for bad in ({"nope": {}}, {"dataset": {"sauce": 1}}):
        with pytest.raises(ValueError, match="Unknown option"):
            merged_options(bad)
    with pytest.raises(ValueError, match="No provider"):
        provider_order("other", False, PROVIDERS)
    with pytest.raises(ValueError, match="not in dataset"):
        run_job(spark, options(source, tmp_path, dataset={"columns_to_translate": ["x"]}), PROVIDERS)
    with pytest.raises(ValueError, match="No dataset"):
        run_job(spark, {}, PROVIDERS)


def test_provider_order():
    names = [p.name for p in provider_order("fanar", True, PROVIDERS)]
    assert names == ["fanar", "nvidia"]
    assert [p.name for p in provider_order("nvidia", False, PROVIDERS)] == ["nvidia"]


def test_stream_over_waves_equals_batch(spark, tmp_path):
    arrived, output, checkpoint = (str(tmp_path / n) for n in ("in", "out", "state"))
    rows = [(i, "12345" if i % 5 == 0 else f"some words {'x' * (i % 7)}") for i in range(60)]
    df = spark.createDataFrame(rows, "id long, t string")

    def run():
        stream = arriving_files(spark, arrived, df.schema, max_files=2)
        query = translate_stream(stream, ["t"], [transliterator("p")], ["id"], output, checkpoint)
        query.awaitTermination()

    df.where("id < 30").repartition(3).write.parquet(arrived)
    run()
    # The second wave repeats some rows of the first.
    df.where("id >= 20").repartition(2).write.mode("append").parquet(arrived)
    run()
    run()
    got = sorted(map(tuple, spark.read.parquet(output).select("id", "t_ar", "t_api").collect()))
    batch = translate_table(df, ["t"], [transliterator("p")], ["id"])
    assert got == sorted(map(tuple, batch.select("id", "t_ar", "t_api").collect()))


def test_replayed_micro_batch_changes_nothing(spark, tmp_path):
    from tarjuman.streaming.arrivals import _writer
    output = str(tmp_path / "out")
    df = spark.createDataFrame([(1, "some words here")], "id long, t string")
    write = _writer(["t"], [transliterator("p")], ["id"], output, False, {})
    write(df, 0)
    first = sorted(f.name for f in (tmp_path / "out/batch_id=0").iterdir())
    write(df, 0)
    assert sorted(f.name for f in (tmp_path / "out/batch_id=0").iterdir()) == first
    (tmp_path / "out/batch_id=0/_SUCCESS").unlink()
    write(df, 0)
    assert spark.read.parquet(output).count() == 1
