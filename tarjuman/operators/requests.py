"""Chat requests and responses as tables, for batch inference outside Spark."""

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tarjuman import fixed
from tarjuman.functions.text import trim_text


def request_body(prompt: Column, api: str, **overrides) -> Column:
    """The JSON payload that asks provider ``api`` to translate ``prompt``.

    ``overrides`` replaces template entries: ``model``, ``system``, ``before``,
    ``after``, ``temperature``, ``max_tokens``, ``top_p``.
    """
    chat = {**fixed.CHAT_TEMPLATES[api], **overrides}
    question = F.concat(F.lit(chat["before"]), prompt, F.lit(chat["after"]))
    messages = F.array(*[
        F.struct(F.lit(role).alias("role"), content.alias("content"))
        for role, content in (("system", F.lit(chat["system"])), ("user", question))
    ])
    fields = [
        F.lit(chat["model"]).alias("model"),
        messages.alias("messages"),
        F.lit(chat["temperature"]).alias("temperature"),
        F.lit(chat["max_tokens"]).alias("max_tokens"),
    ]
    if chat["top_p"] is not None:
        fields += [F.lit(chat["top_p"]).alias("top_p"), F.lit(False).alias("stream")]
    return F.to_json(F.struct(*fields))


def build_requests(
    df: DataFrame, request_id: Column, prompt: Column, apis: Sequence[str],
    overrides: Mapping[str, Mapping] | None = None,
) -> DataFrame:
    """``(request_id, api, body)`` per row and provider, from one pass over the rows."""
    bodies = [
        F.struct(
            F.lit(api).alias("api"),
            request_body(F.col("_prompt"), api, **(overrides or {}).get(api, {})).alias("body"),
        )
        for api in apis
    ]
    prompts = df.select(request_id.cast("string").alias("request_id"), prompt.alias("_prompt"))
    return prompts.select("request_id", F.inline(F.array(*bodies)))


def reply_of_body(body: Column, api: str, transport_error: Column | None = None) -> Column:
    """``struct(success, translation, error)`` read from a response body.

    A provider whose template strips replies treats an empty or unreadable one as
    an error; the other passes its content on as it is, even when null.
    """
    message = F.get_json_object(body, "$.choices[0].message")
    content = F.get_json_object(body, "$.choices[0].message.content")
    failed = transport_error if transport_error is not None else F.lit(None).cast("string")
    if fixed.CHAT_TEMPLATES[api]["strip_reply"]:
        text = trim_text(content)
        good = failed.isNull() & (F.coalesce(F.length(text), F.lit(0)) > 0)
        reason = F.lit(fixed.EMPTY_REPLY)
    else:
        text = content
        good = failed.isNull() & message.isNotNull()
        reason = F.coalesce(failed, F.lit("no message in response"))
    return F.struct(
        good.alias("success"),
        F.when(good, text).alias("translation"),
        F.when(~good, reason).alias("error"),
    )


def parse_responses(requests: DataFrame, responses: DataFrame) -> DataFrame:
    """Requests with the outcome of each.

    ``responses`` holds ``(request_id, api, body, error)``, where ``error`` tells why no
    body came back. A request without a response failed. A request id is unique per api.
    """
    paired = requests.select("request_id", "api").join(
        responses.select("request_id", "api", F.col("body").alias("_body"), F.col("error").alias("_lost"),
                         F.lit(True).alias("_answered")),
        ["request_id", "api"], "left",
    )
    lost = F.when(F.col("_answered").isNull(), F.lit("no response")).otherwise(F.col("_lost"))
    reply = F.lit(None).cast("struct<success:boolean,translation:string,error:string>")
    for api in fixed.CHAT_TEMPLATES:
        reply = F.when(F.col("api") == api, reply_of_body(F.col("_body"), api, lost)).otherwise(reply)
    return paired.withColumn("_reply", reply).select("request_id", "api", "_reply.*")
