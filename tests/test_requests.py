"""Request and response tables, and the shared folder."""

import json
from types import SimpleNamespace

import pytest
from pyspark.sql import functions as F

from tarjuman.operators import requests
from tarjuman.workspace import shared_folder


def test_request_bodies(spark):
    df = spark.createDataFrame([(7, 'say "hi"\n')], "id long, p string")
    built = requests.build_requests(
        df, F.col("id"), F.col("p"), ["nvidia", "fanar"], {"fanar": {"max_tokens": 5}}
    )
    bodies = {r["api"]: (r["request_id"], json.loads(r["body"])) for r in built.collect()}
    request_id, body = bodies["nvidia"]
    assert request_id == "7" and body["stream"] is False and body["top_p"] == 0.7
    assert [m["role"] for m in body["messages"]] == ["system", "user"]
    assert body["messages"][1]["content"] == (
        'What is the Arabic translation of the sentence: say "hi"\n?')
    fanar = bodies["fanar"][1]
    assert fanar["max_tokens"] == 5 and "top_p" not in fanar
    assert fanar["messages"][1]["content"] == 'Translate to Arabic: say "hi"\n'


def reply(content):
    return json.dumps({"choices": [{"message": {"role": "assistant", "content": content}}]})


CASES = [
    # body, transport error, strict outcome (stripped replies), lenient outcome
    (reply(" نعم\n"), None, (True, "نعم", None), (True, " نعم\n", None)),
    (reply("  "), None, (False, None, "API returned None"), (True, "  ", None)),
    (reply(None), None, (False, None, "API returned None"), (True, None, None)),
    ('{"choices": []}', None, (False, None, "API returned None"),
     (False, None, "no message in response")),
    ("not json", None, (False, None, "API returned None"),
     (False, None, "no message in response")),
    (None, "timeout", (False, None, "API returned None"), (False, None, "timeout")),
]


def test_response_outcomes(spark):
    asked = [(str(i), api) for api in ("fanar", "nvidia") for i in range(len(CASES) + 1)]
    answered = [
        (str(i), api, body, error) for api in ("fanar", "nvidia")
        for i, (body, error, _, _) in enumerate(CASES)
    ]
    got = requests.parse_responses(
        spark.createDataFrame(asked, "request_id string, api string"),
        spark.createDataFrame(answered, "request_id string, api string, body string, error string"),
    )
    rows = got.collect()
    outcome = {f"{r['api']}-{r['request_id']}": (r["success"], r["translation"], r["error"]) for r in rows}
    assert len(rows) == len(outcome) == len(asked)
    for i, (_, _, strict, lenient) in enumerate(CASES):
        assert outcome[f"fanar-{i}"] == strict
        assert outcome[f"nvidia-{i}"] == lenient
    assert outcome[f"nvidia-{len(CASES)}"] == (False, None, "no response")


def session(master, folder=None, checkpoint=None):
    return SimpleNamespace(
        conf=SimpleNamespace(get=lambda name, default: folder),
        sparkContext=SimpleNamespace(
            master=master, applicationId=f"app-{master}", getCheckpointDir=lambda: checkpoint),
    )


def test_shared_folder():
    assert shared_folder(session("yarn", "hdfs:///x/")) == "hdfs:///x"
    assert shared_folder(session("yarn", None, "hdfs:///y")) == "hdfs:///y"
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        shared_folder(session("yarn"))
    local = session("local[2]")
    assert shared_folder(local) == shared_folder(local)
