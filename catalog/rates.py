"""Rate-limit analytics over the event log: a lane per event type, one-hour windows."""

from pyspark.sql import functions as F

from catalog.inputs import table
from catalog.registry import query
from tarjuman.operators import rate, statistics

HOUR = 3600
LIMIT = 5


def _calls(spark, sf):
    # Event times carry no zone; read them as UTC whatever the session's zone is.
    utc = F.from_utc_timestamp(F.col("ts").cast("timestamp"), F.current_timezone())
    micros = F.unix_micros(utc).alias("micros")
    return table(spark, sf, "events").select("event_id", F.col("event_type").alias("lane"), micros)


_CALLS = "(select event_id, event_type as lane, epoch_us(ts) as micros from events)"
_FRAME = f"""(partition by lane order by micros
 range between {HOUR * 1_000_000} preceding and current row)"""
_TRAILING = f"""(select *, count(*) over {_FRAME} as calls, min(micros) over {_FRAME} as oldest
 from {_CALLS})"""


@query("trailing_calls", f"select event_id, lane, micros, calls, oldest from {_TRAILING}")
def trailing_calls(spark, sf):
    return rate.trailing_calls(_calls(spark, sf), "event_id", "lane", "micros", HOUR)


@query("wait_time", f"""select event_id, lane, micros, calls, case when calls >= {LIMIT}
 then greatest({HOUR * 1_000_000} - (micros - oldest), 0) / 1000000 else 0 end as wait_seconds
 from {_TRAILING}""")
def wait_time(spark, sf):
    return rate.wait_time(_calls(spark, sf), "event_id", "lane", "micros", LIMIT, HOUR)


# The rule as it stands: a call starts when it arrives, or one window after the
# start of the call LIMIT places before it.
@query("admission_times", f"""with recursive numbered as materialized (
  select *, row_number() over (partition by lane order by micros, event_id) - 1 as i from {_CALLS}),
 started as (
  select event_id, lane, micros, i, micros as start_micros from numbered where i < {LIMIT}
  union all
  select n.event_id, n.lane, n.micros, n.i, greatest(n.micros, s.start_micros + {HOUR * 1_000_000})
  from started s join numbered n on n.lane = s.lane and n.i = s.i + {LIMIT})
 select event_id, lane, micros, start_micros, (start_micros - micros) / 1000000 as delay_seconds
 from started""")
def admission_times(spark, sf):
    return rate.admission_times(_calls(spark, sf), "event_id", "lane", "micros", LIMIT, HOUR)


@query("run_duration", f"""select lane, count(*) as total,
 (max(micros) - min(micros)) / 1000000 as seconds,
 (max(micros) - min(micros)) / 1000000 / greatest(count(*), 1) as mean_seconds
 from {_CALLS} group by lane""")
def run_duration(spark, sf):
    return statistics.run_duration(_calls(spark, sf), "lane", "micros")
