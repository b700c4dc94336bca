"""Progress tables: checkpoints and resuming."""

from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from catalog import inputs
from catalog.inputs import table, transliterated
from catalog.registry import query
from tarjuman.operators import progress
from tarjuman.operators.shape import unpivot_cells
from tarjuman.sources.scans import list_files
from tarjuman.workspace import new_folder

CELL = ["doc_id", "column"]
SCHEMA = (
    StructType().add("doc_id", "long").add("column", "string")
    .add("translation", "string").add("api", "string")
)


def _finished(spark, sf):
    """Finished cells: the text of every labelled document."""
    labelled = table(spark, sf, "labels").select("doc_id", "quality")
    return table(spark, sf, "documents").join(labelled, "doc_id").select(
        "doc_id", F.lit("text").alias("column"),
        transliterated(F.col("text")).alias("translation"), F.lit("nvidia").alias("api"), "quality",
    )


_DONE = f"""(select doc_id, 'text' as "column", {inputs.sql_transliterated("text")} as translation,
 'nvidia' as api, quality from documents join labels using (doc_id))"""


def _written(spark, sf) -> str:
    """A progress table in two batches; the first is written twice, as a retry does."""
    folder = new_folder(spark, "progress")
    done = _finished(spark, sf)
    for batch_id, quality in ((9, 1), (9, 1), (10, 0)):
        batch = done.where(F.col("quality") == quality).drop("quality")
        progress.write_batch(batch, folder, batch_id)
    return folder


@query("checkpoint_write", f"""select case quality when 1 then 9 else 10 end::bigint as batch_id,
 doc_id, "column", translation, api from {_DONE}""")
def checkpoint_write(spark, sf):
    done = progress.read_progress(spark, _written(spark, sf), SCHEMA)
    return done.select("batch_id", *CELL, "translation", "api")


@query("named_checkpoint", f"""select 9::bigint as batch_id, doc_id, "column", translation, api
 from {_DONE} where quality = 1""")
def named_checkpoint(spark, sf):
    done = progress.read_progress(spark, _written(spark, sf), SCHEMA, upto=9)
    return done.select("batch_id", *CELL, "translation", "api")


@query("latest_checkpoint", f"""select max(case quality when 1 then 9 else 10 end)::bigint as latest
 from {_DONE}""")
def latest_checkpoint(spark, sf):
    return progress.latest_number(list_files(spark, _written(spark, sf)))


def _cells(spark, sf):
    return unpivot_cells(table(spark, sf, "documents"), ["doc_id"], ["text", "source"])


@query("resume_pending", f"""select doc_id, "column", text from (
  select doc_id, 'text' as "column", text from documents
  union all select doc_id, 'source', source from documents) c
 where (doc_id, "column") not in (select (doc_id, "column") from {_DONE})""")
def resume_pending(spark, sf):
    return progress.pending(_cells(spark, sf), _finished(spark, sf), CELL)


@query("resume_restore", f"""select d.doc_id, d.lang, d.n_chars, f.translation as text_ar,
 f.api as text_api from documents d left join {_DONE} f on f.doc_id = d.doc_id""")
def resume_restore(spark, sf):
    done = _finished(spark, sf).select(
        "doc_id", F.col("translation").alias("text_ar"), F.col("api").alias("text_api")
    )
    docs = table(spark, sf, "documents").select("doc_id", "lang", "n_chars").withColumns({
        "text_ar": F.lit(None).cast("string"), "text_api": F.lit(None).cast("string"),
    })
    return progress.restore(docs, done, ["doc_id"], ["text_ar", "text_api"])
