"""Calls of a Python client: lists of texts, several in flight, time limits, a call schedule.

Texts are packed into calls of bounded size. Within a task, daemon threads make the
calls, each with a client of its own, and replies go back in the order of their texts.

Under a rate limit calls are scheduled before they are made. Every call has a rank over
the whole table, and its start follows the recurrence of an admission log: no earlier
than it arrives, nor than one window after the call ``limit`` ranks before it. Along the
ranks that are equal modulo the limit this is a sum, so starts are an expression and need
no talk between tasks. A task owns some places in the window, and a place is free again one
window later. A call takes the next own place that has not passed, so a task that came
late, is slower than planned or is run again goes on at later times of its places, and one
pass sends everything. So any number of tasks, lost ones included, keep the limit, if
clocks agree to within the slack and speculation is off.
"""

import heapq
import inspect
import math
import threading
import time
from collections.abc import Callable, Iterable, Iterator, Mapping
from dataclasses import dataclass, field, replace
from functools import partial
from itertools import pairwise
from queue import SimpleQueue

import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import Window as W
from pyspark.sql.types import BooleanType, DoubleType, LongType, StringType, StructField, StructType

from tarjuman import fixed
from tarjuman.sources.scans import path_exists
from tarjuman.workspace import materialize, new_folder

REPLY_FIELDS = (
    StructField("success", BooleanType()),
    StructField("translation", StringType()),
    StructField("error", StringType()),
)
Reply = tuple[bool, str | None, str | None]
LATE = "late"
NO_PROMPT = "no prompt"
#: The call log below ``pass=N/state=planned`` and ``state=done``: starts, and whether calls were made.
LOG = StructType([
    StructField("api", StringType()), StructField("start", DoubleType()), StructField("made", BooleanType()),
    StructField("pass", LongType()), StructField("state", StringType()),
])


def pack(lengths: Iterable[int], max_items: int, max_chars: int) -> Iterator[int]:
    """The call number of each text: as many in a row as the bounds allow, one at least."""
    number, items, chars = -1, max_items, 0
    for length in lengths:
        if items == max_items or chars + length > max_chars:
            number, items, chars = number + 1, 0, 0
        items, chars = items + 1, chars + length
        yield number


class Call:
    """Texts for one call, when it may start, and its replies."""

    def __init__(
        self, texts: list[str], start: float = 0.0, slack: float | None = None, places: "Places | None" = None,
    ):
        self.texts, self.start, self.slack, self.places = texts, start, slack, places
        self.replies: list[Reply] | None = None
        self.began: float | None = None
        self.done = threading.Event()
        self._lock = threading.Lock()

    def settle(self, replies: list[Reply]) -> None:
        """Keep the first outcome; a thread that was given up changes nothing any more."""
        with self._lock:
            if self.replies is None:
                self.replies = replies
                self.done.set()

    def all_failed(self, error: str) -> list[Reply]:
        return [(False, None, error)] * len(self.texts)

    def make(self, client, many: bool) -> None:
        while self.start:
            start = self.places.take(time.time()) if self.places else self.start
            time.sleep(max(0.0, start - time.time()))
            if self.slack is None or time.time() <= start + self.slack:
                break
            if self.places is None:
                return self.settle(self.all_failed(LATE))
        self.began = time.time()
        try:
            replies = client(self.texts) if many else [client(self.texts[0])]
            replies = list(replies)
        except Exception as problem:
            return self.settle(self.all_failed(str(problem)))
        if len(replies) != len(self.texts):
            return self.settle(self.all_failed(f"{len(replies)} replies for {len(self.texts)} texts"))
        self.settle([as_reply(r) for r in replies])


class Places:
    """The places of a task in the window: each may be taken once every ``span`` seconds."""

    def __init__(self, span: float, slack: float, since: float | None = None):
        self.span, self.slack, self.since = span, slack, since
        self._free: list[float] = []
        self._lock = threading.Lock()

    def add(self, starts: Iterable[float]) -> None:
        with self._lock:
            for start in starts:
                heapq.heappush(self._free, start)

    def take(self, now: float) -> float:
        """The next start that has not passed; none before ``since`` is taken."""
        with self._lock:
            open_from = now - self.slack if self.since is None else max(now - self.slack, self.since)
            while True:
                start = self._free[0]
                if start >= open_from:
                    heapq.heapreplace(self._free, start + self.span)
                    return start
                missed = max(1, math.ceil((open_from - start) / self.span))
                heapq.heapreplace(self._free, start + missed * self.span)


def pieces(batches: Iterable[pd.DataFrame], rows: int, chars: int = 2_000_000) -> Iterator[pd.DataFrame]:
    """The batches in parts of up to so many rows and prompt characters, one row at least."""
    for batch in batches:
        lengths = [len(p) if isinstance(p, str) else 0 for p in batch["prompt"]]
        cuts = [0, *(i for i, (a, b) in enumerate(pairwise(pack(lengths, rows, chars)), 1) if a != b), len(batch)]
        for low, high in pairwise(cuts):
            yield batch.iloc[low:high].reset_index(drop=True)


def as_reply(reply) -> Reply:
    """A translation, a mapping with ``success``, ``translation`` and ``error``, or an exception."""
    if isinstance(reply, Exception):
        return False, None, str(reply)
    if isinstance(reply, dict):
        return bool(reply.get("success")), reply.get("translation"), reply.get("error")
    return True, reply, None


class Pool:
    """Threads that make calls; one whose call outlasts ``timeout`` is given up and replaced."""

    def __init__(self, connect, width: int, many: bool, timeout: float | None):
        self.connect, self.width, self.many, self.timeout = connect, width, many, timeout
        self.queue: SimpleQueue = SimpleQueue()
        self.busy: dict[int, Call] = {}
        self.spawned = 0

    def _spawn(self) -> None:
        self.spawned += 1
        threading.Thread(target=self._work, args=(self.spawned,), daemon=True).start()

    def _work(self, own: int) -> None:
        client = None
        while (call := self.queue.get()) is not None:
            self.busy[own] = call
            if client is None:
                call.began = time.time()
                try:
                    client = self.connect()
                    call.began = None
                except Exception as problem:
                    call.settle(call.all_failed(str(problem)))
            if client is not None:
                call.make(client, self.many)
            if self.busy.pop(own, None) is None:
                return  # given up

    def _give_up(self) -> None:
        now = time.time()
        for own, call in list(self.busy.items()):
            if call.began is not None and now - call.began > self.timeout and self.busy.pop(own, None):
                call.settle(call.all_failed(f"timeout after {self.timeout:g} s"))
                self._spawn()

    def run(self, calls: list[Call]) -> None:
        """Make the calls; return when each has its replies."""
        while self.spawned < min(self.width, len(calls)):
            self._spawn()
        for call in calls:
            self.queue.put(call)
        for call in calls:
            if self.timeout is None:
                call.done.wait()
            while not call.done.wait(min(self.timeout or 1.0, 1.0) / 4):
                self._give_up()

    def close(self) -> None:
        for _ in range(self.spawned):
            self.queue.put(None)


@dataclass(frozen=True)
class CallProvider:
    """Replies from a Python client.

    ``connect`` returns a function from a text to a reply: a translation, or a mapping
    with ``success``, ``translation`` and ``error``. With ``many`` it is a function from
    a list of texts to the list of their replies; lists hold up to ``max_items`` texts
    and ``max_chars`` characters. A task has up to ``in_flight`` calls under way, each
    thread with a client of its own. An exception counts as an error of the call's
    texts, an exception in place of a reply as an error of that text, and so does a call
    that takes more than ``timeout`` seconds; a null prompt is not sent.

    Without a limit, texts whose call failed are tried up to ``tries`` times inside the
    task, after ``backoff ** k`` seconds, in lists of half the size.

    ``per_minute`` limits the calls started in any ``window`` seconds (a minute) over
    ``lanes`` tasks. Starts are ``pace`` seconds apart, by default even over the window;
    0 starts as many as the limit allows at once. The first start of a pass is ``lead``
    seconds off, for tasks to begin. ``log`` is the folder of a lasting call log, so that
    the limit holds over rounds, runs and processes.
    """

    name: str
    connect: Callable[[], Callable]
    per_minute: int | None = None
    lanes: int = 1
    window: float = fixed.RATE_WINDOW_SECONDS
    remote: bool = True
    many: bool = False
    max_items: int = 64
    max_chars: int = 100_000
    in_flight: int = 1
    timeout: float | None = fixed.REQUEST_TIMEOUT_SECONDS
    tries: int = 1
    backoff: float = fixed.BACKOFF_MULTIPLIER
    pace: float | None = None
    slack: float | None = None
    lead: float = 2.0
    log: str | None = None
    _own_log: list[str] = field(default_factory=list, compare=False, repr=False)

    def configured(
        self, per_minute: int | None, timeout: float | None = None, settings: Mapping | None = None,
        log: str | None = None,
    ) -> "CallProvider":
        """The provider with other limits. ``settings`` (model, sampling) go to ``connect``, which
        must take them; a limit, time limit or log that is not given stays."""
        connect = self.connect
        if settings:
            if not inspect.signature(connect).parameters:
                raise ValueError(f"The client of '{self.name}' takes no settings: {sorted(settings)}")
            connect = partial(connect, dict(settings))
        return replace(
            self, connect=connect, per_minute=per_minute, timeout=self.timeout if timeout is None else timeout,
            log=self.log or log)

    def answer(self, prompts: DataFrame, attempt: int = 1) -> DataFrame:
        if self.per_minute:
            return self._scheduled(prompts)
        schema = StructType([*prompts.schema.fields, *REPLY_FIELDS])
        return prompts.mapInPandas(self._caller(), schema)

    def _bounds(self) -> tuple[int, int]:
        return (self.max_items, self.max_chars) if self.many else (1, 0)

    def _piece(self) -> int:
        """Rows that a task answers at a time: they keep all calls in flight busy."""
        return max(1000, 4 * self._bounds()[0] * self.in_flight)

    def _pool(self) -> Callable[[], Pool]:
        connect, width, many, timeout = self.connect, self.in_flight, self.many, self.timeout
        return lambda: Pool(connect, width, many, timeout)

    def _caller(self):
        new_pool, bounds, tries, backoff = self._pool(), self._bounds(), self.tries, self.backoff
        rows = self._piece()

        def call(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            pool = new_pool()
            try:
                for batch in pieces(batches, rows):
                    replies = answer_all(pool, batch["prompt"].tolist(), bounds, tries, backoff)
                    yield with_replies(batch, replies)
            finally:
                pool.close()

        return call

    # Under a limit.

    def log_folder(self, spark: SparkSession) -> str:
        """Where the calls of this provider are logged."""
        if self.log:
            return self.log
        if not self._own_log:
            self._own_log.append(new_folder(spark, f"calls-{self.name}"))
        return self._own_log[0]

    def _scheduled(self, prompts: DataFrame) -> DataFrame:
        """Rank, schedule, call."""
        slack = self.slack if self.slack is not None else min(1.0, self.window / 20)
        calls, n = ranked_calls(prompts, *self._bounds())
        if not n:
            return prompts.select("*", *[F.lit(None).cast(f.dataType).alias(f.name) for f in REPLY_FIELDS])
        told = self._one_pass(calls, n, slack, max(self.lead, 2 * slack))
        return told.select(*prompts.columns, "success", "translation", "error")

    def _one_pass(self, calls: DataFrame, n: int, slack: float, lead: float) -> DataFrame:
        spark, folder = calls.sparkSession, self.log_folder(calls.sparkSession)
        limit, span, now = self.per_minute, self.window + slack, time.time()
        number, prior = next_pass(spark, folder), recent_calls(spark, folder, self.name, limit, now - span, now + slack)
        planned = calls.withColumn("_slot", F.col("_rank") % limit).join(prior, "_slot", "left")
        pace = span / limit if self.pace is None else min(self.pace, span / limit)
        first = time.time() + lead
        arrival = F.lit(first) + F.col("_slot") * pace
        start = F.floor(F.col("_rank") / limit) * span + F.greatest(arrival, F.col("_last") + span)
        planned = planned.withColumn("_start", start.cast("double"))
        # What is scheduled counts as made until its pass is over: a run that dies may have made it.
        planned.where("_first").select(
            F.lit(self.name).alias("api"), F.col("_start").alias("start"), F.lit(True).alias("made"),
        ).write.parquet(f"{folder}/pass={number}/state=planned")

        lanes = max(1, min(self.lanes, limit, n))
        # A place in the window belongs to one task; its first calls tell where it is.
        planned = planned.withColumn("_place", F.when(F.col("_rank") < limit, F.col("_start")))
        dealt = planned.repartitionById(lanes, (F.col("_slot") % lanes).cast("int")).drop("_slot", "_last")
        dealt = dealt.sortWithinPartitions("_rank", "_at")
        more = [StructField("_late", BooleanType()), StructField("_began", DoubleType())]
        schema = StructType([*dealt.schema.fields, *REPLY_FIELDS, *more])
        told = materialize(dealt.mapInPandas(_on_time(self._pool(), slack, span, self._piece()), schema), "answered")
        told.where("_first").select(
            F.lit(self.name).alias("api"), F.coalesce("_began", "_start").alias("start"),
            (~F.col("_late")).alias("made"),
        ).write.parquet(f"{folder}/pass={number}/state=done")
        return told


def ranked_calls(prompts: DataFrame, max_items: int, max_chars: int) -> tuple[DataFrame, int]:
    """The prompts with the ``_rank`` of their call over the table, their place ``_at`` in it and
    ``_first`` of it; and the number of calls. The table is written."""
    fields = [StructField("_part", LongType()), StructField("_call", LongType()), StructField("_at", LongType()),
              StructField("_first", BooleanType())]

    def number(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        part, base = TaskContext.get().partitionId(), 0
        for batch in batches:
            lengths = [len(p) if isinstance(p, str) else 0 for p in batch["prompt"]]
            call = pd.Series(list(pack(lengths, max_items, max_chars)), index=batch.index, dtype="int64") + base
            yield batch.assign(
                _part=part, _call=call, _at=range(len(batch)), _first=call.ne(call.shift()).astype("boolean"))
            base = int(call.iloc[-1]) + 1 if len(call) else base

    schema = StructType([*prompts.schema.fields, *fields])
    numbered = materialize(prompts.mapInPandas(number, schema), "calls")
    sizes = numbered.groupBy("_part").agg((F.max("_call") + 1).alias("_calls"))
    # One row per partition.
    before = W.orderBy("_part").rowsBetween(W.unboundedPreceding, -1)
    offsets = sizes.select("_part", F.coalesce(F.sum("_calls").over(before), F.lit(0)).alias("_offset"))
    n = sizes.agg(F.coalesce(F.sum("_calls"), F.lit(0))).first()[0]
    ranked = numbered.join(F.broadcast(offsets), "_part").withColumn("_rank", F.col("_offset") + F.col("_call"))
    return ranked.drop("_part", "_call", "_offset"), n


def _logged(spark: SparkSession, folder: str) -> DataFrame:
    if not path_exists(spark, folder):
        return spark.createDataFrame([], LOG)
    return spark.read.schema(LOG).parquet(folder)


def next_pass(spark: SparkSession, folder: str) -> int:
    last = _logged(spark, folder).agg(F.max("pass")).first()[0]
    return 0 if last is None else last + 1


def call_log(spark: SparkSession, folder: str) -> DataFrame:
    """``(api, start, made, pass)``: the calls of finished passes as they were, of others as planned."""
    return _calls_logged(spark, folder).drop("state")


def _calls_logged(spark: SparkSession, folder: str) -> DataFrame:
    logged = _logged(spark, folder)
    done = logged.where("state = 'done'")
    open_ones = logged.where("state = 'planned'").join(F.broadcast(done.select("pass").distinct()), "pass", "left_anti")
    return done.unionByName(open_ones)


def recent_calls(spark: SparkSession, folder: str, api: str, limit: int, since: float, until: float) -> DataFrame:
    """``(_slot, _last)``: the last ``limit`` calls between the times, the latest in the last slot.
    The table is written, as the log goes on."""
    # A run that died may have used its places again, until now.
    span = until - since
    again = F.col("start") + F.greatest(F.lit(0.0), F.floor((F.lit(until) - F.col("start")) / span) * span)
    start = F.when(F.col("state") == "planned", again).otherwise(F.col("start"))
    near = _calls_logged(spark, folder).where((F.col("api") == api) & F.col("made"))
    near = near.select(start.alias("start")).where(F.col("start").between(since, until))
    # As many rows as one window admits calls.
    place = F.row_number().over(W.orderBy(F.col("start").desc()))
    last = near.orderBy(F.col("start").desc()).limit(limit)
    return materialize(last.select((F.lit(limit) - place).cast("long").alias("_slot"), F.col("start").alias("_last")), "recent")


def _on_time(new_pool, slack: float, span: float | None = None, most: int = 1000):
    """Calls at their starts. With ``span``, at the next own place that has not passed;
    without, a call whose start has passed is not made."""
    def answered(pool: Pool, rows: pd.DataFrame, places: Places | None) -> pd.DataFrame:
        calls = []
        for _, own in rows.groupby("_rank", sort=False):
            prompts = own["prompt"].tolist()
            texts = [p for p in prompts if isinstance(p, str)]
            calls.append((Call(texts, float(own["_start"].iloc[0]), slack, places), prompts))
        pool.run([c for c, _ in calls if c.texts])
        replies, began = [], []
        # Rows of a call follow one another, so the calls are in the order of the rows.
        for call, prompts in calls:
            own = iter(call.replies or ())
            replies += [next(own) if isinstance(p, str) else (False, None, NO_PROMPT) for p in prompts]
            began += [call.began] * len(prompts)
        return with_replies(rows, replies).assign(
            _late=pd.Series([r[2] == LATE for r in replies], index=rows.index, dtype="boolean"),
            _began=pd.Series(began, index=rows.index, dtype="float64"))

    def call(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        task = TaskContext.get()
        pool, again, held = new_pool(), task is not None and task.attemptNumber() > 0, None
        # An earlier attempt may have used what was before now.
        since = time.time() if again else None
        places = None if span is None else Places(span, slack, since)
        try:
            for batch in pieces(batches, most):
                if places:
                    places.add(batch.loc[batch["_first"], "_place"].dropna())
                rows = batch if held is None else pd.concat([held, batch], ignore_index=True)
                # The last call may go on in the next batch.
                last = rows["_rank"] == rows["_rank"].iloc[-1] if len(rows) else rows["_first"]
                held = rows[last].reset_index(drop=True)
                if not last.all():
                    yield answered(pool, rows[~last].reset_index(drop=True), places)
            if held is not None and len(held):
                yield answered(pool, held, places)
            if again and span:
                # The log does not have the calls of that attempt; the next pass begins after their window.
                time.sleep(max(0.0, since + span - time.time()))
        finally:
            pool.close()

    return call


def answer_all(pool: Pool, prompts: list, bounds: tuple[int, int], tries: int, backoff: float) -> list[Reply]:
    """Replies in the order of the prompts; what failed is tried again in smaller calls."""
    replies: list[Reply] = [(False, None, NO_PROMPT)] * len(prompts)
    open_ones = [i for i, p in enumerate(prompts) if isinstance(p, str)]
    items, chars = bounds
    for turn in range(tries):
        if turn:
            time.sleep(backoff ** (turn - 1))
            items = max(1, items // 2)
        numbers = list(pack([len(prompts[i]) for i in open_ones], items, chars))
        groups: list[list[int]] = [[] for _ in range(numbers[-1] + 1 if numbers else 0)]
        for i, number in zip(open_ones, numbers):
            groups[number].append(i)
        calls = [Call([prompts[i] for i in group]) for group in groups]
        pool.run(calls)
        for group, call in zip(groups, calls):
            for i, reply in zip(group, call.replies):
                replies[i] = reply
        open_ones = [i for i in open_ones if not replies[i][0]]
        if not open_ones:
            break
    return replies


def with_replies(batch: pd.DataFrame, replies: list[Reply]) -> pd.DataFrame:
    success, translation, error = list(zip(*replies)) or [(), (), ()]
    return batch.assign(
        success=pd.Series(success, index=batch.index, dtype="boolean"),
        translation=pd.Series(translation, index=batch.index, dtype=object),
        error=pd.Series(error, index=batch.index, dtype=object),
    )
