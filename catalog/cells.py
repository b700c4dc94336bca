"""Columns, rows and cells of a table."""

from pyspark.sql import functions as F

from catalog import inputs
from catalog.inputs import table
from catalog.registry import query
from tarjuman.operators import shape


def _is_text(columns: list[str], source: str) -> str:
    parts = [
        f"select '{c}' as \"column\", avg(length(coalesce({c}, 'nan'))) as avg_len from {source}"
        for c in columns
    ]
    return (f"select \"column\", avg_len, avg_len > 10 as is_text from ("
            f"{' union all '.join(parts)})")


_PARTIES = "(select *, nullif(c_mktsegment, 'BUILDING') as segment from customer)"


@query("detect_text_columns", _is_text(["c_name", "c_mktsegment", "segment"], _PARTIES))
def detect_text_columns(spark, sf):
    parties = table(spark, sf, "customer").withColumn(
        "segment", F.nullif("c_mktsegment", F.lit("BUILDING"))
    )
    return shape.detect_text_columns(parties)


@query("profile_columns", """select * from (
 select 'o_orderkey' as "column", 'bigint' as type, true as present,
  count(*) - count(o_orderkey) as null_count from orders union all
 select 'o_orderpriority', 'string', true, count(*) - count(nullif(o_orderpriority, '5-LOW'))
  from orders union all
 select 'o_totalprice', 'double', true, count(*) - count(o_totalprice) from orders union all
 select 'o_comment', null, false, null)""")
def profile_columns(spark, sf):
    orders = table(spark, sf, "orders").withColumn(
        "o_orderpriority", F.nullif("o_orderpriority", F.lit("5-LOW"))
    )
    return shape.profile_columns(
        orders, ["o_orderkey", "o_orderpriority", "o_totalprice", "o_comment"]
    )


@query("limit_rows", """select o_orderkey, o_custkey, o_totalprice from orders
 order by o_orderkey limit 100""")
def limit_rows(spark, sf):
    orders = table(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_totalprice")
    return shape.limit_rows(orders, "o_orderkey", 100)


@query("limit_ties", "select l_orderkey from lineitem order by l_orderkey limit 1003")
def limit_ties(spark, sf):
    return shape.limit_rows(table(spark, sf, "lineitem"), "l_orderkey", 1003).select("l_orderkey")


_PART_AR = ", ".join(f"{inputs.sql_transliterated(c)} as {c}_ar" for c in ("p_name", "p_type"))


@query("keep_columns", f"""select p_partkey, {_PART_AR}, 'nvidia' as p_name_api from part""")
def keep_columns(spark, sf):
    parts = table(spark, sf, "part").withColumns({
        "p_type_ar": inputs.transliterated(F.col("p_type")),
        "p_name_api": F.lit("nvidia"),
        "p_name_ar": inputs.transliterated(F.col("p_name")),
    })
    return shape.keep_columns(parts, ["p_partkey", "p_color"], ["p_name", "p_type"])


@query("with_row_id", """select doc_id, row_number() over (order by doc_id) - 1 as source_row,
 row_number() over (order by doc_id) - 1 as row_id from documents""")
def with_row_id(spark, sf):
    return shape.with_row_id(table(spark, sf, "documents"), dense="row_id").select(
        "doc_id", "source_row", "row_id"
    )


PART_TEXTS = ["p_name", "p_brand", "p_type"]
_CELLS = " union all ".join(
    f"select p_partkey, '{c}' as \"column\", {c} as text from part" for c in PART_TEXTS
)


@query("cells_unpivot", _CELLS.replace("p_type as text", "nullif(p_type, 'SMALL') as text"))
def cells_unpivot(spark, sf):
    parts = table(spark, sf, "part").withColumn("p_type", F.nullif("p_type", F.lit("SMALL")))
    return shape.unpivot_cells(parts, ["p_partkey"], PART_TEXTS)


@query("cells_pivot", f"""select p.p_partkey, p_size,
 {", ".join(f'''max(case when "column" = '{c}' then translation end) as {c}_ar,
  max(case when "column" = '{c}' then api end) as {c}_api''' for c in PART_TEXTS)}
 from part p left join (select p_partkey, "column", {inputs.sql_transliterated("text")} as translation,
  case when length(text) > 8 then 'nvidia' else 'fanar' end as api
  from ({_CELLS}) where length(text) <> 7) d on d.p_partkey = p.p_partkey
 group by p.p_partkey, p_size""")
def cells_pivot(spark, sf):
    parts = table(spark, sf, "part")
    cells = shape.unpivot_cells(parts, ["p_partkey"], PART_TEXTS)
    done = cells.where(F.length("text") != 7).select(
        "p_partkey", "column", inputs.transliterated(F.col("text")).alias("translation"),
        F.when(F.length("text") > 8, "nvidia").otherwise("fanar").alias("api"),
    )
    wide = shape.pivot_cells(done, ["p_partkey"], PART_TEXTS)
    return shape.attach_translations(parts.select("p_partkey", "p_size"), wide, ["p_partkey"])


@query("cell_text", """select o_orderkey, cast(o_custkey as varchar) as custkey,
 coalesce(nullif(o_orderstatus, 'F'), 'nan') as spelled, nullif(o_orderstatus, 'F') as kept
 from orders""")
def cell_text(spark, sf):
    status = F.nullif("o_orderstatus", F.lit("F"))
    return table(spark, sf, "orders").select(
        "o_orderkey", shape.cell_text(F.col("o_custkey")).alias("custkey"),
        shape.cell_text(status, "literal").alias("spelled"), shape.cell_text(status).alias("kept"),
    )
