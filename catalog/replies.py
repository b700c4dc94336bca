"""Reply validation, post-processing, attempts and statistics over them."""

from pyspark.sql import functions as F

from catalog import inputs
from catalog.inputs import ACCEPTED, CANDIDATES, DIRTY, attempts, candidates, dirty
from catalog.registry import query
from tarjuman.functions import quality as Q
from tarjuman.operators import rounds, statistics

CELL = ["doc_id", "column"]
ATTEMPT = ["doc_id", "api", "attempt"]


@query("has_script", f"""select doc_id, regexp_matches(text, '[{inputs.AR}]') as value
 from {DIRTY}""")
def has_script(spark, sf):
    return dirty(spark, sf).select("doc_id", Q.has_script(F.col("text")).alias("value"))


@query("script_ratio", f"select doc_id, {inputs.sql_script_ratio('text')} as value from {DIRTY}")
def script_ratio(spark, sf):
    return dirty(spark, sf).select("doc_id", Q.script_ratio(F.col("text")).alias("value"))


@query("has_mojibake", f"""select doc_id, regexp_matches(text, '{inputs.SQL_MOJIBAKE}') as value
 from {DIRTY}""")
def has_mojibake(spark, sf):
    return dirty(spark, sf).select("doc_id", Q.has_mojibake(F.col("text")).alias("value"))


@query("length_ratio", f"""select doc_id, api, attempt, length(translation) / length(raw) as value
 from {CANDIDATES}""")
def length_ratio(spark, sf):
    ratio = Q.length_ratio(F.col("original_length"), F.col("translation"))
    return candidates(spark, sf).select(*ATTEMPT, ratio.alias("value"))


@query("validate_pairs", f"""select doc_id, api, attempt, {", ".join(Q.CHECKS)}, is_valid
 from {CANDIDATES}""")
def validate_pairs(spark, sf):
    return candidates(spark, sf).select(*ATTEMPT, *Q.CHECKS, "is_valid")


@query("validation_summary", f"""select api, count(*) as replies,
 {", ".join(f"count(*) filter (not {c}) as failed_{c}" for c in Q.CHECKS)}
 from {CANDIDATES} where success and translation is not null group by api""")
def validation_summary(spark, sf):
    return rounds.validation_summary(candidates(spark, sf))


@query("normalize_arabic", f"""select doc_id, {inputs.sql_postprocess("text")} as value
 from {DIRTY}""")
def normalize_arabic(spark, sf):
    return dirty(spark, sf).select("doc_id", Q.normalize_arabic(F.col("text")).alias("value"))


@query("postprocess", f"""select doc_id, api, attempt,
 coalesce({inputs.sql_postprocess("translation")}, '') as value from {CANDIDATES}""")
def postprocess(spark, sf):
    return candidates(spark, sf).select(
        *ATTEMPT, Q.postprocess(F.col("translation")).alias("value")
    )


@query("first_valid", f"""select doc_id, api, attempt, translation from {ACCEPTED}""")
def first_valid(spark, sf):
    return rounds.first_valid(attempts(spark, sf), CELL).select(*ATTEMPT, "translation")


@query("exhausted_cells", f"""select doc_id, 'text' as "column",
 'All API attempts exhausted' as error from documents
 where doc_id not in (select doc_id from {ACCEPTED})""")
def exhausted_cells(spark, sf):
    docs = inputs.table(spark, sf, "documents").select("doc_id", F.lit("text").alias("column"))
    return rounds.exhausted_cells(docs, rounds.first_valid(attempts(spark, sf), CELL), CELL)


# Attempts a cell-by-cell run makes: up to and including the first valid one.
_MADE = f"""(select c.* from {CANDIDATES} c left join {ACCEPTED} a using (doc_id)
 where a.doc_id is null or (c.api_rank, c.attempt) <= (a.api_rank, a.attempt))"""


@query("attempt_outcomes", f"""select api,
 case when is_valid then 'accepted' when success then 'rejected' else 'error' end as outcome,
 count(*) as attempts from {_MADE} group by 1, 2""")
def attempt_outcomes(spark, sf):
    return rounds.attempt_outcomes(rounds.attempts_made(attempts(spark, sf), CELL))


@query("backoff_seconds", f"""select doc_id, "column", count(*) as attempts,
 sum(case when not is_valid and attempt < 3 then 2.0 ** (attempt - 1) else 0 end)::double
  as backoff_seconds from {_MADE} group by 1, 2""")
def backoff_seconds(spark, sf):
    return rounds.backoff_seconds(attempts(spark, sf), CELL)


def _translated(spark, sf):
    """Documents with what the scripted attempts made of their text."""
    kept = rounds.first_valid(attempts(spark, sf), CELL).select(
        "doc_id", F.col("translation").alias("text_ar"), F.col("api").alias("text_api")
    )
    docs = inputs.table(spark, sf, "documents").select("doc_id", "text", "lang")
    return docs.join(kept, "doc_id", "left")


_TABLE = f"""(select d.doc_id, d.text, d.lang, a.translation as text_ar, a.api as text_api
 from documents d left join {ACCEPTED} a using (doc_id))"""


@query("run_stats", f"""select count(*) as total, count(text_ar) as successful,
 count(*) - count(text_ar) as failed, count(*) filter (text_api = 'nvidia') as nvidia_used,
 count(*) filter (text_api = 'fanar') as fanar_used from {_TABLE}""")
def run_stats(spark, sf):
    return statistics.run_stats(_translated(spark, sf), ["text"], ["nvidia", "fanar"])


@query("failed_cells", f"""select doc_id, 'text' as "column",
 'All API attempts exhausted' as error from {_TABLE} where text_ar is null""")
def failed_cells(spark, sf):
    failures = statistics.failed_cells(_translated(spark, sf), ["doc_id"], ["text"])
    return failures.drop("column_rank")


@query("top_failures", f"""select doc_id, 'text' as "column",
 'All API attempts exhausted' as error from {_TABLE} where text_ar is null
 order by doc_id limit 10""")
def top_failures(spark, sf):
    failures = statistics.failed_cells(_translated(spark, sf), ["doc_id"], ["text"])
    return statistics.top_failures(failures, ["doc_id"]).drop("column_rank")


@query("provider_usage", f"""select api, "column", count(*) as used
 from {ACCEPTED} group by rollup (api, "column")""")
def provider_usage(spark, sf):
    return statistics.provider_usage(rounds.first_valid(attempts(spark, sf), CELL))
