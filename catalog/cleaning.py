"""Text cleaning, term normalisation and content flags."""

from pyspark.sql import functions as F

from catalog import inputs
from catalog.inputs import DIRTY, dirty
from catalog.registry import query
from tarjuman.functions import text as T
from tarjuman.operators import terms


def _mapped(function):
    """A query that applies ``function`` to every dirty document."""
    return lambda spark, sf: dirty(spark, sf).select(
        "doc_id", function(F.col("text")).alias("value")
    )


def _sql(expression: str) -> str:
    return f"select doc_id, {expression} as value from {DIRTY}"


query("strip_control", _sql(inputs.sql_strip_control("text")))(_mapped(T.strip_control))
query("collapse_blanks", _sql(inputs.sql_collapse_blanks("text")))(_mapped(T.collapse_blanks))
query("collapse_newlines", _sql(inputs.sql_collapse_newlines("text")))(_mapped(T.collapse_newlines))
query("trim_text", _sql(inputs.sql_trim("text")))(_mapped(T.trim_text))
query("clean_text", _sql(inputs.sql_clean("text")))(_mapped(T.clean_text))
query("normalize_terms", _sql(inputs.sql_terms("text")))(_mapped(T.normalize_terms))
query("preprocess", _sql(inputs.sql_preprocess("text")))(_mapped(T.preprocess))

SQL_CODE = (r"contains(text, '```') or "
            r"regexp_matches(text, '\b(def|class|function|import|const|var|let)\b')")
SQL_URLS = "regexp_matches(text, 'https?://')"
SQL_EMAILS = r"regexp_matches(text, '\b[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+\.[A-Z|a-z]{2,}\b')"
_SPECIAL = inputs.sub("text", f"[a-zA-Z0-9{inputs.WS}]")
SQL_SPECIAL = f"length({_SPECIAL}) / greatest(length(text), 1)"

query("flag_code", _sql(SQL_CODE))(_mapped(T.contains_code))
query("flag_urls", _sql(SQL_URLS))(_mapped(T.contains_urls))
query("flag_emails", _sql(SQL_EMAILS))(_mapped(T.contains_emails))
query("special_char_ratio", _sql(SQL_SPECIAL))(_mapped(T.special_char_ratio))

SQL_ISSUES = f"""concat_ws(',', case when {SQL_CODE} then 'contains_code' end,
 case when {SQL_URLS} then 'contains_urls' end,
 case when {SQL_EMAILS} then 'contains_emails' end,
 case when {SQL_SPECIAL} > 0.3 then 'high_special_char_ratio' end)"""


@query("content_issues", f"select doc_id, {SQL_ISSUES} as issues from {DIRTY}")
def content_issues(spark, sf):
    found = T.content_issues(F.col("text"))
    return dirty(spark, sf).select("doc_id", F.array_join(found, ",").alias("issues"))


@query("issue_summary", f"""select issue, count(*) as cells from (
 select unnest(string_split({SQL_ISSUES}, ',')) as issue from {DIRTY})
 where issue <> '' group by issue""")
def issue_summary(spark, sf):
    found = dirty(spark, sf).select(F.explode(T.content_issues(F.col("text"))).alias("issue"))
    return found.groupBy("issue").agg(F.count(F.lit(1)).alias("cells"))


# A custom mapping: overrides two defaults, adds two terms; one replacement
# holds characters that are special in a replacement pattern.
CUSTOM = {"ChatGPT": "the helper", "GPT-4": "model $4\\", "the class": "a class", "end": "finis"}
CUSTOM_SQL = (
    ("ChatGPT API", "the AI API"), ("OpenAI API", "the AI API"), ("the class", "a class"),
    ("Chat GPT", "the AI assistant"), ("OpenAI''s", "the AI provider''s"),
    ("ChatGPT", "the helper"), (r"GPT-3\.5", "the language model"),
    ("OpenAI", "the AI provider"), ("GPT-4", r"model $4\\"),
    ("GPT-3", "the language model"), ("end", "finis"),
)

query("normalize_terms_custom", _sql(inputs.sql_terms("text", CUSTOM_SQL)))(
    _mapped(lambda text: T.normalize_terms(text, CUSTOM))
)

_DEFAULTS = ", ".join(
    "('{}', '{}', {})".format(t.replace("'", "''"), r.replace("'", "''"), i)
    for i, (t, r) in enumerate([
        ("ChatGPT", "the AI assistant"), ("chatgpt", "the AI assistant"),
        ("Chat GPT", "the AI assistant"), ("OpenAI", "the AI provider"),
        ("openai", "the AI provider"), ("OpenAI's", "the AI provider's"),
        ("GPT-4", "the advanced language model"), ("GPT-3.5", "the language model"),
        ("GPT-3", "the language model"), ("gpt-4", "the advanced language model"),
        ("gpt-3.5", "the language model"), ("OpenAI API", "the AI API"),
        ("ChatGPT API", "the AI API"),
    ])
)


@query("merge_terms", f"""with custom as (
  select case when p_name = 'red widget' then 'ChatGPT' else p_name end as term,
   'the ' || lower(min(p_type)) || ' part' as replacement, min(p_partkey) as place
  from part group by 1),
 base(term, replacement, place) as (values {_DEFAULTS})
 select term, coalesce(c.replacement, b.replacement) as replacement,
  coalesce(b.place, 13 + c.place) as "rank", length(term) as term_length
 from base b full outer join custom c using (term)""")
def merge_terms(spark, sf):
    named = F.when(F.col("p_name") == "red widget", "ChatGPT").otherwise(F.col("p_name"))
    custom = inputs.table(spark, sf, "part").groupBy(named.alias("term")).agg(
        F.concat(F.lit("the "), F.lower(F.min("p_type")), F.lit(" part")).alias("replacement"),
        F.min("p_partkey").alias("rank"),
    )
    return terms.merge_terms(terms.default_terms(spark), custom)
