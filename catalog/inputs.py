"""Input tables of the queries, and the same inputs and rules as DuckDB SQL.

The given texts are clean: no provider terms, control characters, addresses or
broken encodings. DIRT appends some to every document, by its id, with an
expression both engines accept.
"""

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tarjuman.operators.providers import LATIN, LETTERS, transliterated
from tarjuman.operators.rounds import judged
from tarjuman.operators.shape import spread
from tarjuman.workspace import materialize

DIRT = """concat(text, case doc_id % 12
 when 0 then concat(chr(10), ' ', chr(9), chr(10), chr(10), 'Ask ChatGPT API or chatgpt about GPT-4o, GPT-3.5.')
 when 1 then concat('  ', chr(9), ' OpenAI', chr(39), 's gpt-4 ', chr(7), chr(127))
 when 2 then concat(' see https://example.com/a?b=1 ', chr(160))
 when 3 then ' mail a.b+c@example.org now'
 when 4 then concat(chr(10), '```', chr(10), 'def f(x): return x', chr(10), '```')
 when 5 then ' import the class'
 when 6 then concat(' caf', chr(195), chr(169), ' ', chr(195), ' x')
 when 7 then concat(chr(13), chr(10), chr(13), chr(10), 'end', chr(13), chr(10))
 when 8 then ' مرحبا إلى أهل آل'
 when 9 then repeat('#$%', 2000)
 when 10 then ' \ufffd'
 else '' end)"""


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def documents(spark: SparkSession, sf: str) -> DataFrame:
    return spread(table(spark, sf, "documents"), ["doc_id"])


def dirty(spark: SparkSession, sf: str) -> DataFrame:
    """``(doc_id, text, lang, source, n_chars)`` with dirt in the text."""
    return documents(spark, sf).withColumn("text", F.expr(DIRT))


DIRTY = f"(select doc_id, {DIRT} as text, lang, source, n_chars from documents)"

# The rules of cleaning, in RE2 spelling.
WS = (r"\t\n\x{0b}\x{0c}\r \x{1c}-\x{1f}\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}"
      r"\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}")
AR = r"\x{0600}-\x{06ff}\x{0750}-\x{077f}\x{08a0}-\x{08ff}"


def sub(text: str, pattern: str, replacement: str = "''") -> str:
    return f"regexp_replace({text}, '{pattern}', {replacement}, 'g')"


def sql_strip_control(text: str) -> str:
    return sub(text, r"[\x{00}-\x{08}\x{0b}\x{0c}\x{0e}-\x{1f}\x{7f}-\x{9f}]")


def sql_collapse_blanks(text: str) -> str:
    return sub(text, r"[ \t]+", "' '")


def sql_collapse_newlines(text: str) -> str:
    return sub(text, rf"\n[{WS}]*\n", "chr(10) || chr(10)")


def sql_trim(text: str) -> str:
    return sub(sub(text, rf"^[{WS}]+"), rf"[{WS}]+$")


def sql_clean(text: str) -> str:
    inner = sql_collapse_newlines(sql_collapse_blanks(sql_strip_control(text)))
    return f"coalesce({sql_trim(inner)}, '')"


# Longest term first; terms equal but for case need one entry.
SQL_TERMS = (
    ("ChatGPT API", "the AI API"), ("OpenAI API", "the AI API"),
    ("Chat GPT", "the AI assistant"), ("OpenAI''s", "the AI provider''s"),
    ("ChatGPT", "the AI assistant"), (r"GPT-3\.5", "the language model"),
    ("OpenAI", "the AI provider"), ("GPT-4", "the advanced language model"),
    ("GPT-3", "the language model"),
)


def sql_terms(text: str, terms: tuple[tuple[str, str], ...] = SQL_TERMS) -> str:
    for term, replacement in terms:
        text = sub(text, rf"(?i)\b{term}\b", f"'{replacement}'")
    return text


def sql_preprocess(text: str) -> str:
    return sql_terms(sql_clean(text))


def sql_transliterated(text: str) -> str:
    return f"translate(lower({text}), '{LATIN}', '{LETTERS}')"


def sql_script_ratio(text: str) -> str:
    script, visible = sub(text, f"[^{AR}]"), sub(text, f"[{WS}]")
    return f"length({script}) / greatest(length({visible}), 1)"


SQL_MOJIBAKE = "Ã©|Ã¨|Ã |Ã§|â€™|â€œ|" + r"\x{fffd}"


def sql_checks(original: str, reply: str) -> dict[str, str]:
    ratio = f"length({reply}) / length({original})"
    return {
        "not_empty": f"length({sql_trim(reply)}) >= 1",
        "has_arabic": f"regexp_matches({reply}, '[{AR}]')",
        "arabic_ratio_ok": f"{sql_script_ratio(reply)} >= 0.5",
        "reasonable_length": f"(length({original}) = 0 or {ratio} between 0.3 and 3.0)",
        "no_encoding_errors": f"not regexp_matches({reply}, '{SQL_MOJIBAKE}')",
    }


def sql_valid(original: str, reply: str) -> str:
    return "coalesce(" + " and ".join(f"({c})" for c in sql_checks(original, reply).values()) + ", false)"


def sql_postprocess(reply: str) -> str:
    folded = sub(f"translate({reply}, 'إأآ', 'ااا')", f"[{WS}]+", "' '")
    return f"trim({folded})"


# Replies with scripted failures. Code: 0 error, 1 no text, 2 blank, 3 echo,
# 4 broken encoding, 5 too long, 6 and 7 good.
def scripted_reply(code: Column, prompt: Column, good: Column | None = None) -> Column:
    good = transliterated(prompt) if good is None else good
    return (
        F.when(code == 2, F.lit("   ")).when(code == 3, prompt)
        .when(code == 4, F.concat(good, F.lit("Ã©"))).when(code == 5, F.repeat(good, F.lit(4)))
        .when(code > 5, good)
    )


def sql_scripted_reply(code: str, prompt: str) -> str:
    good = sql_transliterated(prompt)
    return (f"case {code} when 0 then null when 1 then null when 2 then '   ' when 3 then {prompt}"
            f" when 4 then {good} || 'Ã©' when 5 then repeat({good}, 4) else {good} end")


def candidates(spark: SparkSession, sf: str) -> DataFrame:
    """Six judged replies per document: two providers, three attempts each."""
    text = F.col("text")
    docs = documents(spark, sf).select("doc_id", text.alias("raw"), transliterated(text).alias("good"))
    tries = docs.select(
        "*", F.explode(F.sequence(F.lit(1), F.lit(2))).alias("api_rank")
    ).select("*", F.explode(F.sequence(F.lit(1), F.lit(3))).alias("attempt"))
    code = (F.col("doc_id") * 7 + F.col("api_rank") * 3 + F.col("attempt") * 5) % 8
    asked = tries.withColumn("code", code).select(
        "doc_id", F.lit("text").alias("column"),
        F.when(F.col("api_rank") == 1, "nvidia").otherwise("fanar").alias("api"),
        "api_rank", "attempt",
        F.length("raw").alias("original_length"),
        (F.col("code") != 0).alias("success"),
        scripted_reply(F.col("code"), F.col("raw"), F.col("good")).alias("translation"),
        F.when(F.col("code") == 0, "timeout").alias("error"),
    )
    return judged(asked)


def attempts(spark: SparkSession, sf: str) -> DataFrame:
    """The candidates as a run leaves them: written, with accepted texts only."""
    accepted = F.when(F.col("is_valid"), F.col("translation")).alias("translation")
    kept = candidates(spark, sf).select(
        "doc_id", "column", "api", "api_rank", "attempt", "success", "is_valid", accepted
    )
    return materialize(kept, "attempts")


_CHECKS = ", ".join(f'{sql} as "{name}"' for name, sql in sql_checks("raw", "translation").items())
CANDIDATES = f"""(select *, success and {sql_valid("raw", "translation")} as is_valid, {_CHECKS} from (
 select doc_id, 'text' as "column", api, api_rank, attempt, raw, code <> 0 as success,
  {sql_scripted_reply("code", "raw")} as translation,
  case when code = 0 then 'timeout' end as error
 from (select doc_id, text as raw, api, api_rank, attempt,
        (doc_id * 7 + api_rank * 3 + attempt * 5) % 8 as code
       from documents
       cross join (select 'nvidia' as api, 1 as api_rank union all select 'fanar', 2)
       cross join (select unnest([1, 2, 3]) as attempt))))"""
# The first valid attempt of each document, if any.
ACCEPTED = f"""(select * from {CANDIDATES} where is_valid
 qualify row_number() over (partition by doc_id order by api_rank, attempt) = 1)"""
