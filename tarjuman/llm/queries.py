"""The registered queries of this subpackage, each beside the SQL that states its result."""

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tarjuman.llm import conversations, decontaminate, jaccard, language, lines, mixing, pseudonyms, quality, sharding, tokens, toxicity, urls, whitening
from tarjuman.llm.common import documents
from tarjuman.workspace import new_folder

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def register(run):
        QUERIES[name] = run
        if sql is not None:
            SQL[name] = sql
        return run

    return register


@query("op3_mixing", r"""
    with sized as (
        select doc_id, md5(coalesce(cast(doc_id as varchar), '')) h, coalesce(md5(text), '') t,
               case when source is null then '1' else '0' || source end s,
               coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::bigint size
        from documents),
    sources as (
        select s, sum(size)::bigint source_size, (row_number() over (order by s) - 1) % 3 + 1 w
        from sized group by s),
    filled as (
        select *, 3 * source_size most,
               coalesce(sum(3 * source_size) over before, 0) full_, coalesce(sum(w) over before, 0) past,
               sum(source_size) over () total, sum(w) over () weights
        from sources
        window before as (order by 3 * source_size / w, s rows between unbounded preceding and 1 preceding)),
    targets as (
        select s, source_size, w,
               least(most::double, max((total - full_)::double / (weights - past)::double) over () * w) target
        from filled),
    placed as (
        select doc_id, size, source_size, target, w, coalesce(sum(size) over (
                   partition by s order by h, doc_id nulls first, t
                   rows between unbounded preceding and 1 preceding), 0) + size / 2 middle
        from sized join targets using (s)),
    -- The first training time: the demand curve of the source's weight class, two straight
    -- pieces of half the time each, inverted at the document's share of the target.
    timed as (
        select *, [1.5, 1.0, 0.5][w] a, 1.0::double b, [0.5, 1.0, 1.5][w] c,
               middle / target * ((a + b) / 2 * 0.5::double + (b + c) / 2 * 0.5::double) used,
               (a + b) / 2 * 0.5::double early
        from placed),
    rooted as (
        select *, sqrt(greatest(a * a + 2 * ((b - a) / 0.5::double) * used, 0.0::double)) r1,
               sqrt(greatest(b * b + 2 * ((c - b) / 0.5::double) * (used - early), 0.0::double)) r2
        from timed)
    select doc_id, size, source_size, target,
           (size * ((middle < target)::int + (middle + source_size < target)::int
                    + (middle + 2 * source_size < target)::int))::bigint taken,
           case when middle < target then round(1e6 * case
                when used < early then 2 * used / (a + r1)
                else 0.5::double + 2 * (used - early) / (b + r2) end)::bigint end first_micros
    from rooted""")
def op3_mixing(spark, sf_dir):
    mixed = mixing.mix(documents(spark, sf_dir))
    taken = (F.col("size") * F.size("positions")).cast("long")
    first = F.round(F.get("positions", F.lit(0)) * 1e6).cast("long")
    ordered = mixed.withColumn("first_micros", first)
    # In training order; what the mix leaves out comes first.
    ordered = ordered.repartitionByRange("first_micros").sortWithinPartitions("first_micros")
    return ordered.select("doc_id", "size", "source_size", "target", taken.alias("taken"), "first_micros")


@query("op10_url_filter")
def op10_url_filter(spark, sf_dir):
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet")
    return urls.judge(pages.select("page_id", "url")).select("page_id", "host", "path", "rule", "verdict", "score")


def held_out(divisor: int, remainder: int):
    """Rows a model must not learn from, by the crc32 of the id as text (null: no id, never held out)."""
    return F.coalesce(F.crc32(F.col("doc_id").cast("string")) % divisor == remainder, F.lit(False))


@query("op1_language_id")
def op1_language_id(spark, sf_dir):
    docs = documents(spark, sf_dir)
    model = language.learn(docs.where(~held_out(4, 2)))
    found = language.identify(docs.select("doc_id", "text"), model)
    return found.select("doc_id", held_out(4, 2).alias("held_out"), "lang_pred", "score")


@query("op6_quality")
def op6_quality(spark, sf_dir):
    docs = documents(spark, sf_dir)
    judged = quality.judge(docs.select("doc_id", "text"), quality.learn(docs))
    return judged.select("doc_id", *quality.OUTPUT)


@query("op9_toxicity")
def op9_toxicity(spark, sf_dir):
    docs = documents(spark, sf_dir).select("doc_id", "text")
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet").select("doc_id", F.col("toxic").alias("label"))
    scorer = toxicity.learn(docs.where(~held_out(3, 1)).join(labels, "doc_id"))
    scored = toxicity.score(docs, scorer)
    return scored.select(
        "doc_id", held_out(3, 1).alias("held_out"), "score", (F.col("score") >= 0.7).cast("int").alias("predicted")
    )


@query("op2_line_dedup", r"""
    with lines as (select doc_id, string_split(text, chr(10)) l from documents where text is not null),
    keyed as (
        select doc_id, unnest(range(0, len(l) - 2)) i,
               unnest([l[i + 1] || chr(10) || l[i + 2] || chr(10) || l[i + 3] for i in range(0, len(l) - 2)]) w
        from lines where len(l) >= 3),
    later as (
        select doc_id, i from keyed where regexp_matches(w, '[^\x20\x09-\x0D]')
        qualify row_number() over (partition by w order by doc_id, i) > 1),
    gone as (
        select doc_id, list(distinct i + k) g from later, range(3) t(k) group by doc_id)
    select d.doc_id, case when g is null then text else array_to_string(
               list_filter(l, lambda x, i: not list_contains(g, i - 1)), chr(10)) end as text,
           coalesce(len(g), 0)::bigint n_removed
    from documents d left join gone using (doc_id) left join lines using (doc_id)""")
def op2_line_dedup(spark, sf_dir):
    return lines.drop_repeated_lines(documents(spark, sf_dir).select("doc_id", "text"))


@query("op8_decontaminate", r"""
    with words as (
        select doc_id, coalesce(regexp_extract_all(
            translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
            '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+'), []) w from documents),
    items as (
        select item_id, regexp_extract_all(
            translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
            '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') w, least(13, len(w)) m from benchmark),
    item_windows as (
        select distinct item_id, m, t from (
            select item_id, m, unnest([array_to_string(w[i:i + m - 1], ' ') for i in range(1, len(w) - m + 2)]) t
            from items where m > 0)),
    doc_windows as (
        select doc_id, m, unnest(range(1, len(w) - m + 2)) i,
               unnest([array_to_string(w[i:i + m - 1], ' ') for i in range(1, len(w) - m + 2)]) t
        from words, (select distinct m from items where m > 0)),
    hits as (select doc_id, i, m, item_id from doc_windows join item_windows using (m, t)),
    places as (
        select doc_id, count(distinct p) n_hit
        from (select doc_id, unnest(range(i, i + m)) p from hits) group by doc_id),
    named as (
        select doc_id, count(*) n_items, sha256(string_agg(item, ',' order by item)) h
        from (select distinct doc_id, item_id::varchar item from hits) group by doc_id)
    select doc_id, len(w)::bigint n_words, coalesce(n_hit, 0)::bigint n_hit, coalesce(n_items, 0)::bigint n_items,
           coalesce(h, sha256('')) items_sha256, coalesce(n_hit, 0) > 0 and 20 * n_hit >= len(w) contaminated
    from words left join places using (doc_id) left join named using (doc_id)""")
def op8_decontaminate(spark, sf_dir):
    benchmark = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    found = decontaminate.find_contamination(documents(spark, sf_dir).select("doc_id", "text"), benchmark)
    return found.select(
        "doc_id", "n_words", "n_hit", F.size("item_ids").cast("long").alias("n_items"),
        F.sha2(F.array_join("item_ids", ","), 256).alias("items_sha256"), "contaminated",
    )


@query("op4_token_output")
def op4_token_output(spark, sf_dir):
    folder = new_folder(spark, "token-files")
    tokens.write_tokens(documents(spark, sf_dir), folder, public_tokenizers.path("byte_bpe_50k.json"))
    return tokens.read_tokens(spark, folder)


@query("op5_jaccard_join")
def op5_jaccard_join(spark, sf_dir):
    return jaccard.near_duplicates(documents(spark, sf_dir)).select("doc_id", "n_shingles", "component_id")


#: A key for the registered query; a user passes a secret one.
SAMPLE_KEY = "sample key, not a secret"


@query("op7_pii")
def op7_pii(spark, sf_dir):
    return pseudonyms.pseudonymize(documents(spark, sf_dir).select("doc_id", "text"), SAMPLE_KEY)


def _crc32(text: str) -> str:
    """DuckDB SQL for the crc32 of an ASCII string."""
    byte = "list_reduce(list_prepend(xor(c, b), range(8)), lambda v, k: xor(v >> 1, 3988292384 * (v & 1)))"
    codes = f"[ascii(x)::bigint for x in string_split({text}, '')]"
    return f"xor(list_reduce(list_prepend(4294967295::bigint, {codes}), lambda c, b: {byte}), 4294967295)"


def _edit(cost: int, letter: str, rest: str, line: str = "''") -> str:
    """The struct of a row's edit in front of ``rest``; a truncated row that stays costs 1."""
    stays = " + cut" if letter in "KR" else ""
    return (f"{{'cost': {cost}{stays} + {rest}.cost, 'audit': '{letter}' || {rest}.audit, "
            f"'lines': {line} || {rest}.lines}}")


def _least(*options: str) -> str:
    return f"list_sort([{', '.join(options)}])[1]"


def _walk(state: int, keeps: dict[str, int], put: str, then: int) -> str:
    """The least of deleting, keeping (role initial and next state) and giving a role."""
    own = [_edit(3, "D", f"h{state}")]
    for initial, after in keeps.items():
        kept = _edit(0, "K", f"h{after}", "chr(10) || role || ':' || text")
        own.append(f"case when not gone and role[1] = '{initial}' then {kept} end")
    given = _edit(2, "R", f"h{then}", f"chr(10) || '{put}:' || text")
    own.append(f"case when not gone then {given} end")
    return f"list_sort(list_filter([{', '.join(own)}], lambda x: x is not null))[1]"


# A row's cheapest rest, from the last row to the first, per state: 0 nothing said, 1 after
# the system, 2 after the user, 3 after the assistant; b before, h after inserts.
@query("op11_conversation_repair", rf"""
    with recursive raw as (
        select conv_id, turn, coalesce(role, ' ') as role, coalesce(text, ' ') as text,
               {_crc32("coalesce(conv_id::varchar, ' ') || ':' || coalesce(turn::varchar, ' ')")} % 20 as kind
        from conversations),
    damaged as (
        select conv_id, turn, case kind when 4 then 'user' else role end as role,
               case kind when 1 then '' when 2 then translate(text, '.!?', '') else text end as text
        from raw, range(case kind when 3 then 2 else 1 end) where kind <> 0),
    placed as (
        select *, row_number() over (partition by conv_id order by turn nulls first, role, md5(text)) as i,
               rtrim(text, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)) as seen
        from damaged),
    faults as (
        select *, seen = '' as blank,
               seen <> '' and row_number() over (partition by conv_id, role, text order by i) > 1 as duplicate,
               not blank and not duplicate and right(seen, 1) not in ('.', '!', '?') as truncated,
               blank or duplicate as gone, truncated::int as cut,
               lag(role) over (partition by conv_id order by i) as former
        from placed),
    walk as (
        select conv_id, max(i) + 1 as i, {{'cost': 0, 'audit': '', 'lines': ''}} as h0,
               {{'cost': 4, 'audit': 'II', 'lines': chr(10) || 'user:' || chr(10) || 'assistant:'}} as h1,
               {{'cost': 2, 'audit': 'I', 'lines': chr(10) || 'assistant:'}} as h2,
               {{'cost': 0, 'audit': '', 'lines': ''}} as h3
        from placed group by conv_id
        union all
        select conv_id, i, {_least("b0", _edit(2, "I", "h2", "chr(10) || 'user:'"))},
               {_least("b1", _edit(2, "I", "h2", "chr(10) || 'user:'"))}, h2, h3
        from (
            select conv_id, i, b0, b1, {_least("b2", _edit(2, "I", "b3", "chr(10) || 'assistant:'"))} as h2,
                   {_least("b3", _edit(2, "I", "b2", "chr(10) || 'user:'"))} as h3
            from (
                select f.conv_id, f.i, {_walk(0, {"s": 1, "u": 2}, "user", 2)} as b0,
                       {_walk(1, {"u": 2}, "user", 2)} as b1, {_walk(2, {"a": 3}, "assistant", 3)} as b2,
                       {_walk(3, {"u": 2}, "user", 2)} as b3
                from walk w join faults f on f.conv_id is not distinct from w.conv_id and f.i = w.i - 1))),
    counted as (
        select conv_id, coalesce(max(turn) - min(turn) + 1 - count(distinct turn), 0)::bigint as gaps,
               count_if(blank)::bigint as blank, count_if(duplicate)::bigint as duplicate,
               count_if(truncated)::bigint as truncated,
               count_if(former is not null and former[1] || role[1] not in ('su', 'ua', 'au'))::bigint as illegal
        from faults group by conv_id)
    select o.conv_id, coalesce(gaps, 0)::bigint as gaps, coalesce(blank, 0)::bigint as blank,
           coalesce(duplicate, 0)::bigint as duplicate, coalesce(truncated, 0)::bigint as truncated,
           coalesce(illegal, 0)::bigint as illegal, coalesce(h0.cost, 0)::bigint as cost,
           coalesce(h0.audit, '') as audit, sha256(coalesce(substr(h0.lines, 2), '')) as repaired_sha256
    from (select distinct conv_id from conversations) o
    left join counted c on c.conv_id is not distinct from o.conv_id
    left join walk w on w.conv_id is not distinct from o.conv_id and w.i = 1""")
def op11_conversation_repair(spark, sf_dir):
    turns = spark.read.parquet(f"{sf_dir}/conversations.parquet")
    damaged, lost = conversations.damage(turns)
    return conversations.audit(damaged, lost)


#: Number of shards of the registered query.
SHARDS = 8


@query("op12_sharding")
def op12_sharding(spark, sf_dir):
    placed = sharding.place_rows(documents(spark, sf_dir).select("doc_id", "text"), SHARDS)
    return placed.select(
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )


#: Number of components of the registered query.
COMPONENTS = 4


@query("op13_whitening")
def op13_whitening(spark, sf_dir):
    vectors = spark.read.parquet(f"{sf_dir}/embeddings.parquet").select("vec_id", "embedding")
    model = whitening.fit(vectors, components=COMPONENTS)
    rows, deviation, whitened = whitening.whiten(vectors, model)
    shares = F.array(*[F.lit(float(v) / model.trace) for v in model.values], F.lit(None).cast("double"))
    return rows.select("vec_id", deviation, F.posexplode(whitened).alias("place", "whitened")).select(
        "vec_id", (F.col("place") + 1).cast("int").alias("component"), F.lit(model.n).cast("long").alias("n"),
        F.col(deviation).try_cast("long").alias("deviation"), "whitened",
        F.get(shares, F.col("place")).alias("explained"), F.lit(model.identity_error).alias("identity_error"),
    )
