"""Requests, providers and whole translation runs."""

from pyspark.sql import functions as F

from catalog import inputs
from catalog.inputs import DIRTY, dirty, documents, table
from catalog.registry import query
from tarjuman.functions.text import preprocess, trim_text
from tarjuman.operators import rate, requests
from tarjuman.operators.calls import call_log
from tarjuman.operators.providers import (
    CallProvider, ColumnProvider, MemoryProvider, transliterated, transliterating_client,
    transliterating_lists, transliterator,
)
from tarjuman.plans.job import run_job
from tarjuman.plans.translate import translate_table
from tarjuman.streaming.arrivals import arriving_files, translate_stream
from tarjuman.workspace import materialize, new_folder

_CHATS = {
    "nvidia": ("""json_object('model', 'nvidia/riva-translate-4b-instruct-v1.1', 'messages',
 [{'role': 'system', 'content': 'You are an expert at translating text from English to Arabic.'},
  {'role': 'user', 'content': 'What is the Arabic translation of the sentence: ' || prompt || '?'}],
 'temperature', 0.1::double, 'max_tokens', 512, 'top_p', 0.7::double, 'stream', false)"""),
    "fanar": ("""json_object('model', 'Fanar', 'messages',
 [{'role': 'system', 'content': 'You are an expert translator. Translate the following English text to fluent, natural Arabic. Provide only the translation without any explanations.'},
  {'role': 'user', 'content': 'Translate to Arabic: ' || prompt}],
 'temperature', 0.3::double, 'max_tokens', 1024)"""),
}
_PROMPTS = f"(select doc_id, {inputs.sql_preprocess('text')} as prompt from {DIRTY})"


@query("build_requests", " union all ".join(
    f"select doc_id::varchar as request_id, '{api}' as api, {body}::varchar as body from {_PROMPTS}"
    for api, body in _CHATS.items()
))
def build_requests(spark, sf):
    prompt = preprocess(F.col("text"))
    return requests.build_requests(dirty(spark, sf), F.col("doc_id"), prompt, list(_CHATS))


# A response per document, by its id: content, padded content, blank, null
# content, no choices, broken JSON, transport error, none at all.
_GOOD = inputs.sql_transliterated("text")


@query("parse_responses", f"""select request_id, api, case
  when kind in (0, 1) then true when kind in (2, 3) then api = 'nvidia' else false end as success,
 case when kind = 0 then good
  when kind = 1 then case when api = 'nvidia' then '  ' || good || chr(10) else good end
  when kind = 2 and api = 'nvidia' then '   ' end as translation,
 case when kind < 2 or (kind < 4 and api = 'nvidia') then null when api = 'fanar'
  then 'API returned None' when kind in (4, 5) then 'no message in response'
  when kind = 6 then 'timeout' else 'no response' end as error
 from (select doc_id::varchar as request_id, doc_id % 8 as kind, api,
  api || ': ' || {inputs.sql_trim(_GOOD)} as good
  from documents cross join (select unnest(['fanar', 'nvidia']) as api))""")
def parse_responses(spark, sf):
    source = table(spark, sf, "documents")
    apis = ["fanar", "nvidia"]
    docs = source.select(
        F.col("doc_id").cast("string").alias("request_id"),
        F.explode(F.array(*map(F.lit, apis))).alias("api"),
        (F.col("doc_id") % 8).alias("kind"),
        trim_text(transliterated(F.col("text"))).alias("good"),
    ).withColumn("good", F.concat("api", F.lit(": "), "good"))
    content = (
        F.when(F.col("kind") == 0, F.col("good"))
        .when(F.col("kind") == 1, F.concat(F.lit("  "), "good", F.lit("\n")))
        .when(F.col("kind") == 2, F.lit("   "))
    )
    message = F.struct(F.lit("assistant").alias("role"), content.alias("content"))
    body = F.to_json(
        F.struct(F.array(F.struct(message.alias("message"))).alias("choices")),
        {"ignoreNullFields": "false"},
    )
    responses = docs.where("kind < 7").select(
        "request_id", "api",
        F.when(F.col("kind") < 4, body).when(F.col("kind") == 4, '{"choices": []}')
        .when(F.col("kind") == 5, '{"choices": [{"mess').alias("body"),
        F.when(F.col("kind") == 6, "timeout").alias("error"),
    )
    asked = requests.build_requests(source, F.col("doc_id"), F.col("text"), apis)
    return requests.parse_responses(asked, responses)


_REPLIES = f"""select doc_id, true as success, {inputs.sql_transliterated("text")} as translation,
 null::varchar as error from documents"""


def _prompts(spark, sf):
    return documents(spark, sf).select("doc_id", F.col("text").alias("prompt"))


@query("provider_map", _REPLIES)
def provider_map(spark, sf):
    provider = CallProvider("local", transliterating_client)
    return provider.answer(_prompts(spark, sf)).drop("prompt")


@query("provider_map_batch", _REPLIES)
def provider_map_batch(spark, sf):
    provider = CallProvider("local", transliterating_lists, many=True, max_items=50, in_flight=2)
    return provider.answer(_prompts(spark, sf)).drop("prompt")


def _throttled(prompts) -> CallProvider:
    """Lists of ten texts, a quarter of them per second: the limit binds at any size."""
    quarter = max(1, prompts.count() // 40)
    return CallProvider("local", transliterating_lists, per_minute=quarter, window=1, lanes=8,
                        many=True, max_items=10, max_chars=10_000_000, in_flight=2)


@query("provider_throttled", _REPLIES)
def provider_throttled(spark, sf):
    prompts = _prompts(spark, sf)
    return _throttled(prompts).answer(prompts).drop("prompt")


# Two rounds under one limit. The log tells the calls of any window of a second, and
# that they lasted more than six windows, as eight quarters do.
@query("throttled_calls", """select 2 * count(*) as texts, 0::bigint as over_limit, true as binds
 from documents""")
def throttled_calls(spark, sf):
    prompts = _prompts(spark, sf)
    provider = _throttled(prompts)
    texts = sum(provider.answer(prompts, attempt).count() for attempt in (1, 2))
    log = call_log(spark, provider.log_folder(spark)).where("made").select(
        "api", F.round(F.col("start") * 1_000_000).cast("long").alias("micros"),
        F.monotonically_increasing_id().alias("call"))
    near = rate.trailing_calls(materialize(log, "log"), "call", "api", "micros", 1)
    lasted = (F.max("micros") - F.min("micros")) / 1_000_000
    return near.agg(
        F.lit(texts).cast("long").alias("texts"),
        F.count_if(F.col("calls") > provider.per_minute).alias("over_limit"), (lasted > 6).alias("binds"))


# The memory: texts of the documents labelled as good, whatever their id.
@query("memory_lookup", f"""select d.doc_id, m.text is not null as success, m.translation,
 case when m.text is null then 'not in memory' end as error
 from documents d left join (select distinct text, {inputs.sql_transliterated("text")} as translation
  from documents join labels using (doc_id) where quality = 1) m on m.text = d.text""")
def memory_lookup(spark, sf):
    docs = table(spark, sf, "documents")
    good = table(spark, sf, "labels").where("quality = 1").select("doc_id")
    memory = docs.join(good, "doc_id", "left_semi").select(
        "text", transliterated(F.col("text")).alias("translation")
    )
    return MemoryProvider("memory", memory).answer(_prompts(spark, sf)).drop("prompt")


_NVIDIA = f"case when {inputs.sql_valid('text', 'reply')} then"
_RUN = f"""select doc_id, {_NVIDIA} {inputs.sql_postprocess("reply")} end as text_ar,
 {_NVIDIA} 'nvidia' end as text_api
 from (select doc_id, text, {inputs.sql_transliterated("prompt")} as reply
  from (select doc_id, text, {inputs.sql_preprocess("text")} as prompt from {DIRTY}))"""


@query("translate_documents", _RUN)
def translate_documents(spark, sf):
    docs = dirty(spark, sf).select("doc_id", "text")
    result = translate_table(docs, ["text"], [transliterator("nvidia")], ["doc_id"])
    return result.drop("text")


def _column_sql(c: str) -> str:
    reply = inputs.sql_transliterated(inputs.sql_preprocess(c))
    valid = inputs.sql_valid(c, reply)
    return (f"case when {valid} then {inputs.sql_postprocess(reply)} end as {c}_ar, "
            f"case when {valid} then 'nvidia' end as {c}_api")


@query("translate_multi_column", f"""select p_partkey, p_name, p_brand, p_type, p_size,
 p_retailprice, {_column_sql("p_name")}, {_column_sql("p_brand")}, {_column_sql("p_type")}
 from part""")
def translate_multi_column(spark, sf):
    parts = table(spark, sf, "part")
    return translate_table(
        parts, ["p_name", "p_brand", "p_type"], [transliterator("nvidia")], ["p_partkey"]
    )


_CONV = "case when turn % 3 = 0 then null else conv_id end"


@query("translate_repeated_keys", f"""select {_CONV} as conv_id, turn, role, text,
 {_column_sql("role")}, {_column_sql("text")} from conversations""")
def translate_repeated_keys(spark, sf):
    turns = table(spark, sf, "conversations").select(F.expr(_CONV).alias("conv_id"), "turn", "role", "text")
    return translate_table(turns, ["role", "text"], [transliterator("nvidia")], ["conv_id"])


@query("job_csv", f"""select p_partkey, p_name, p_type, {_column_sql("p_name")}, {_column_sql("p_type")}
 from part""")
def job_csv(spark, sf):
    source, output = new_folder(spark, "plain-csv"), f"{new_folder(spark, 'job')}/out.parquet"
    parts = table(spark, sf, "part").select("p_partkey", "p_name", "p_type")
    parts.write.csv(source, header=True, quote='"', escape='"')
    run_job(spark, {
        "dataset": {"source": source, "columns_to_translate": ["p_name", "p_type"]},
        "output": {"path": output},
    }, {"nvidia": transliterator("nvidia")})
    return spark.read.parquet(output)


_JUDGED = f"""(select doc_id, {inputs.sql_valid("text", "reply")} as ok
 from (select doc_id, text, {inputs.sql_transliterated(inputs.sql_preprocess("text"))} as reply from documents))"""


_STATS = """total long, successful long, failed long, nvidia_used long, start_time string,
 end_time string, duration_seconds double, seconds_per_row double,
 first_failures array<struct<doc_id: string>>"""


@query("job_statistics", f"""select count(*) as total, count_if(ok)::bigint as successful,
 count_if(not ok)::bigint as failed, count_if(ok)::bigint as nvidia_used, true as clock,
 (select string_agg(doc_id, ',' order by doc_id) from (select doc_id from {_JUDGED} where not ok
  order by doc_id limit 10)) as first_failed
 from {_JUDGED}""")
def job_statistics(spark, sf):
    folder = new_folder(spark, "job")
    run_job(spark, {
        "dataset": {"source": f"{sf}/documents.parquet", "key": "doc_id", "columns_to_translate": ["text"]},
        "output": {"path": f"{folder}/out.parquet"},
    }, {"nvidia": transliterator("nvidia")})
    stats = spark.read.schema(_STATS).json(f"{folder}/out_stats.json")
    seconds = (F.unix_micros(F.to_timestamp("end_time")) - F.unix_micros(F.to_timestamp("start_time"))) / 1_000_000
    clock = (
        (F.col("duration_seconds") > 0) & (F.abs(seconds - F.col("duration_seconds")) < 1e-5)
        & (F.abs(F.col("seconds_per_row") * F.col("total") - seconds) < 1e-3))
    return stats.select(
        "total", "successful", "failed", "nvidia_used", clock.alias("clock"),
        F.nullif(F.array_join("first_failures.doc_id", ","), F.lit("")).alias("first_failed"))


@query("translate_only_columns", f"""select conv_id, turn, {_column_sql("text")}
 from conversations""")
def translate_only_columns(spark, sf):
    turns = table(spark, sf, "conversations")
    return translate_table(
        turns, ["text"], [transliterator("nvidia")], ["conv_id", "turn"], preserve=False
    )


# A term per order, merged with the default ones: finished orders become a default term,
# which is replaced in turn where it applies later, as it is the shorter or later one.
_ORDERED = """case when o_orderstatus <> 'F' then 'customer ' || o_custkey
 when length('order' || o_orderkey) > 7 then 'the AI assistant' else 'ChatGPT' end"""
_ORDER_REPLY = inputs.sql_transliterated(f"'Please send ' || {_ORDERED} || ' to the yard'")


@query("translate_many_terms", f"""select o_orderkey, text,
 case when {inputs.sql_valid("text", "reply")} then {inputs.sql_postprocess("reply")} end as text_ar,
 case when {inputs.sql_valid("text", "reply")} then 'nvidia' end as text_api
 from (select o_orderkey, 'Please send ORDER' || o_orderkey || ' to the yard' as text,
  {_ORDER_REPLY} as reply from orders)""")
def translate_many_terms(spark, sf):
    orders = table(spark, sf, "orders")
    name = F.concat(F.lit("order"), F.col("o_orderkey").cast("string"))
    customer = F.concat(F.lit("customer "), F.col("o_custkey").cast("string"))
    custom = orders.select(
        name.alias("term"), F.when(F.col("o_orderstatus") == "F", "ChatGPT").otherwise(customer).alias("replacement"),
        F.col("o_orderkey").alias("rank"))
    texts = orders.select("o_orderkey", F.concat(F.lit("Please send ORDER"), "o_orderkey", F.lit(" to the yard")).alias("text"))
    return translate_table(texts, ["text"], [transliterator("nvidia")], ["o_orderkey"], custom_terms=custom)


def _scripted(name: str, rank: int) -> ColumnProvider:
    def code(prompt, attempt):
        return (F.length(prompt) * 7 + rank * 3 + attempt * 5) % 8

    return ColumnProvider(
        name,
        lambda prompt, attempt: inputs.scripted_reply(code(prompt, attempt), prompt),
        lambda prompt, attempt: F.when(code(prompt, attempt) == 0, F.lit("timeout")),
    )


_CODE = "(length(prompt) * 7 + api_rank * 3 + attempt * 5) % 8"


@query("retry_rounds", f"""with tries as (
  select doc_id, text, prompt, api, api_rank, attempt,
   {inputs.sql_scripted_reply(_CODE, "prompt")} as reply
  from (select doc_id, text, {inputs.sql_preprocess("text")} as prompt from {DIRTY})
  cross join (select 'fanar' as api, 1 as api_rank union all select 'nvidia', 2)
  cross join (select unnest([1, 2, 3]) as attempt)),
 accepted as (select * from tries where {inputs.sql_valid("text", "reply")}
  qualify row_number() over (partition by doc_id order by api_rank, attempt) = 1)
 select d.doc_id, {inputs.sql_postprocess("a.reply")} as text_ar, a.api as text_api
 from documents d left join accepted a using (doc_id)""")
def retry_rounds(spark, sf):
    docs = dirty(spark, sf).select("doc_id", "text")
    order = [_scripted("fanar", 1), _scripted("nvidia", 2)]
    return translate_table(docs, ["text"], order, ["doc_id"]).drop("text")


@query("translate_stream", _RUN)
def translate_arriving(spark, sf):
    arrived, output = new_folder(spark, "arrived"), new_folder(spark, "translated")
    docs = dirty(spark, sf).select("doc_id", "text")
    docs.repartition(4, "doc_id").write.parquet(arrived)
    run = translate_stream(
        arriving_files(spark, arrived, docs.schema, max_files=2),
        ["text"], [transliterator("nvidia")], ["doc_id"],
        output, new_folder(spark, "stream"),
    )
    run.awaitTermination()
    return spark.read.parquet(output).select("doc_id", "text_ar", "text_api")
