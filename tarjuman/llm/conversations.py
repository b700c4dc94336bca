"""Conversation structure repair: faults of rows, cheapest edits, repaired rows.

A row's first fault counts: *blank* (no visible character), *duplicate* (role and text
seen earlier in the conversation), *truncated* (the last visible character ends no
sentence). Rows are kept, deleted, given a new role or inserted so that roles read
``(s?(ua)+)?``; ``role_blocks`` finds the cheapest edits, ties to the ASCII-least letters.

Rows are range-partitioned in order, ties split, so a conversation of any length is cut
into *pieces* of at most ``ROWS`` rows and ``CHARACTERS`` characters. A conversation that
begins and ends inside one partition is one whole piece, settled where it is. Only those
over a border, two per partition, and long ones go on as pieces: first places of their
rows are found by an aggregate, every piece gives a 4 x 4 matrix of least costs, the
matrices of one conversation are chained from its end (one small row per piece), and with
the costs behind it known each piece is traced by itself.

Defined cases: a null role or text is one blank, so a null text is a blank row; rows
without a turn come first, equal turns by role, then by the md5 of the text; rows with a
null conversation id are one conversation; repeated rows are duplicates; an empty table
gives no pieces; only the four named columns are read, whatever the others are called.
"""

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tarjuman.llm.common import batches_of
from tarjuman.llm.role_blocks import COSTS, CUT, GONE, ROLES, closing, kept_state, next_state, role_at, tables
from tarjuman.workspace import materialize

ROWS, CHARACTERS = 512, 4 << 20
BLANKS = " \t\n\x0b\f\r"
LEGAL = ("su", "ua", "au")
_PLACE_BITS = 10  # more than ROWS needs

PIECE = (
    "conv string, part int, seq long, whole boolean, symbols binary, n_blank long, n_duplicate long, "
    "n_truncated long, n_illegal long, first string, last string, turns long, low long, high long, "
    "roles array<string>, texts array<string>, digests array<string>"
)
REPAIR = "audit string, cost long, rows array<struct<edits:string,role:string,text:string>>, lines string"


def conversation_key(conv: Column) -> Column:
    """The id as text, null-safe."""
    return F.coalesce(F.concat(F.lit("="), conv.cast("string")), F.lit(""))


def gather(turns: DataFrame, conv: str, turn: str, role: str, text: str) -> DataFrame:
    """Pieces of the conversations, in order of (part, seq)."""
    visible = F.rtrim(F.col("text"), F.lit(BLANKS))
    rows = turns.select(
        conversation_key(F.col(f"`{conv}`")).alias("conv"), F.col(f"`{turn}`").try_cast("long").alias("turn"),
        F.coalesce(F.col(f"`{role}`"), F.lit(" ")).alias("role"),
        F.coalesce(F.col(f"`{text}`"), F.lit(" ")).alias("text"),
    ).select(
        "conv", "turn", "role", "text", F.md5("text").alias("digest"),
        F.when(visible == "", 2).when(F.right(visible, F.lit(1)).isin(".", "!", "?"), 0).otherwise(1).alias("fault"),
        F.monotonically_increasing_id().alias("at"),
    )
    # Nothing but the place tells equal rows apart; without it they would all meet in one task.
    order = ["conv", "turn", "role", "digest", "at"]
    ordered = rows.repartitionByRange(*order).sortWithinPartitions(*order)
    ordered = ordered.select(
        "conv", F.coalesce("turn", F.lit(0)).alias("turn"), F.col("turn").isNotNull().alias("dated"),
        "role", "text", "digest", "fault",
    )

    names = ordered.columns

    def cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        part, seq = TaskContext.get().partitionId(), 0
        done, held, size, opened = [], [], 0, False
        for batch in batches:
            for row in zip(*(batch[c] for c in names)):
                if held and row[0] != held[0][0]:
                    # The first piece of a partition may have begun in the one before it.
                    done.append(_piece(held, part, seq, seq > 0 and not opened))
                    held, size, opened, seq = [], 0, False, seq + 1
                elif len(held) == ROWS or size > CHARACTERS:
                    done.append(_piece(held, part, seq, False))
                    held, size, opened, seq = [], 0, True, seq + 1
                held.append(row)
                size += len(row[4])
            if done:
                yield pd.DataFrame(done)
                done = []
        if held:
            yield pd.DataFrame([_piece(held, part, seq, False)])

    return ordered.mapInPandas(cut, PIECE)


def _piece(held: list[tuple], part: int, seq: int, whole: bool) -> dict:
    """One piece; duplicates are known here only if the conversation is whole."""
    conv, turns, dated, roles, texts, digests, faults = zip(*held)
    seen, symbols, n = set(), [], [0, 0, 0]
    for role, digest, fault in zip(roles, digests, faults):
        if fault == 2:
            n[0] += 1
            symbols.append(GONE)
        elif whole and (role, digest) in seen:
            n[1] += 1
            symbols.append(GONE)
        else:
            n[2] += fault
            symbols.append(2 * (ROLES + role[:1]).index(role[:1]) + fault if role[:1] else 6 + fault)
        seen.add((role, digest))
    initials = [role[:1] for role in roles]
    days = [turn for turn, known in zip(turns, dated) if known]
    return {
        "conv": conv[0], "part": part, "seq": seq, "whole": whole, "symbols": bytes(symbols),
        "n_blank": n[0], "n_duplicate": n[1], "n_truncated": n[2],
        "n_illegal": sum(a + b not in LEGAL for a, b in zip(initials, initials[1:])),
        "first": initials[0], "last": initials[-1],
        "turns": len(set(days)), "low": min(days, default=0), "high": max(days, default=0),
        "roles": list(roles), "texts": list(texts),
        "digests": None if whole else [None if f == 2 else d for d, f in zip(digests, faults)],
    }


def _with_duplicates(pieces: DataFrame) -> DataFrame:
    """``(conv, part, seq, symbols, n_duplicate, n_truncated)`` with later copies of a row as ``GONE``."""
    place = (F.shiftleft("part", 32 + _PLACE_BITS) + F.shiftleft("seq", _PLACE_BITS) + F.col("i"))
    rows = pieces.select(
        "conv", F.col("part").cast("long").alias("part"), "seq", F.posexplode(F.arrays_zip("roles", "digests")).alias("i", "row"))
    rows = rows.where(F.col("row.digests").isNotNull())
    firsts = rows.groupBy("conv", "row.roles", "row.digests").agg(F.min(place).alias("place"))
    own = firsts.groupBy(F.shiftright("place", _PLACE_BITS).alias("piece")).agg(
        F.collect_list(F.col("place").bitwiseAND((1 << _PLACE_BITS) - 1).cast("int")).alias("firsts"))
    narrow = pieces.select("conv", "part", "seq", "symbols", "n_truncated",
                           (F.shiftleft(F.col("part").cast("long"), 32) + F.col("seq")).alias("piece"))
    joined = narrow.join(own, "piece", "left").drop("piece")

    def mark(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = []
            for row in batch.itertuples():
                symbols = np.frombuffer(row.symbols, np.uint8).copy()
                later = symbols != GONE
                later[row.firsts if row.firsts is not None else []] = False
                cut = int((symbols[later] % 2).sum())
                symbols[later] = GONE
                rows.append((row.conv, row.part, row.seq, symbols.tobytes(), int(later.sum()), row.n_truncated - cut))
            yield pd.DataFrame(rows, columns=["conv", "part", "seq", "symbols", "n_duplicate", "n_truncated"])

    return joined.mapInPandas(
        mark, "conv string, part int, seq long, symbols binary, n_duplicate long, n_truncated long")


def _entries(marked: DataFrame) -> DataFrame:
    """``(part, seq, end, entry, closes)``: the vector behind each piece and the state it is entered in.

    A conversation's pieces meet in one group twice, as one small row for up to ``ROWS`` rows.
    """
    @F.pandas_udf("array<int>")
    def matrix(symbols: pd.Series) -> pd.Series:
        return pd.Series([tables().matrix(np.frombuffer(s, np.uint8)) for s in symbols], dtype=object)

    @F.pandas_udf("array<int>")
    def exits(symbols: pd.Series, end: pd.Series) -> pd.Series:
        known = tables()
        return pd.Series([
            [known.trace(np.frombuffer(s, np.uint8), e, state)[1] for state in range(4)] for s, e in zip(symbols, end)
        ], dtype=object)

    def chain(group: pd.DataFrame) -> pd.DataFrame:
        group, ends, end = group.sort_values(["part", "seq"], ascending=False), [], 0
        for matrix_of in group["matrix"]:
            ends.append(end)
            end = tables().through(list(matrix_of), end)
        return group[["part", "seq"]].assign(end=ends, closes=[i == 0 for i in range(len(ends))])

    def enter(group: pd.DataFrame) -> pd.DataFrame:
        group, entries, state = group.sort_values(["part", "seq"]), [], 0
        for own in group["exits"]:
            entries.append(state)
            state = int(own[state])
        return group[["part", "seq", "end", "closes"]].assign(entry=entries)

    costs = marked.select("conv", "part", "seq", matrix("symbols").alias("matrix"))
    ends = costs.groupBy("conv").applyInPandas(chain, "part int, seq long, end int, closes boolean")
    passed = marked.join(ends, ["part", "seq"]).select(
        "conv", "part", "seq", "end", "closes", exits("symbols", "end").alias("exits"))
    return passed.groupBy("conv").applyInPandas(enter, "part int, seq long, end int, closes boolean, entry int")


def repair(
    turns: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text",
) -> DataFrame:
    """The conversations' pieces with faults, edits and repaired rows.

    Per piece: the columns of ``PIECE`` but for its inner ones, ``audit`` (edit letters),
    ``cost``, ``rows`` (letters, repaired role and text; inserted rows have letter I) and
    ``lines`` (the rows as ``role:text``, joined by newlines).
    """
    with batches_of(turns.sparkSession, 512, "8MB"):
        pieces = materialize(gather(turns, conv, turn, role, text), "pieces")
        cut = pieces.where("not whole")
        marked = materialize(_with_duplicates(cut), "marked")
        plan = materialize(_entries(marked), "entries")
    own = F.struct(F.col("end"), F.col("entry"), F.col("closes"))
    settled = pieces.where("whole").drop("digests").withColumn(
        "own", F.struct(F.lit(0).alias("end"), F.lit(0).alias("entry"), F.lit(True).alias("closes")))
    rest = marked.join(plan, ["part", "seq"]).withColumn("own", own).drop("conv", "end", "entry", "closes")
    rest = cut.drop("digests", "symbols", "n_duplicate", "n_truncated").join(rest, ["part", "seq"])
    both = settled.unionByName(rest)
    fixed = both.withColumn("fixed", F.pandas_udf(_repaired, REPAIR)("symbols", "roles", "texts", "own"))
    return fixed.select(*[c for c in both.columns if c not in ("symbols", "roles", "texts", "own")], "fixed.*")


def _repaired(symbols: pd.Series, roles: pd.Series, texts: pd.Series, own: pd.DataFrame) -> pd.DataFrame:
    known, found = tables(), []
    for row in zip(symbols, roles, texts, own["end"], own["entry"], own["closes"]):
        signs, names, bodies, end, state, closes = row
        signs = np.frombuffer(signs, np.uint8)
        traced, last = known.trace(signs, int(end), int(state))
        rows = []

        def insert(letters: str, state: int) -> int:
            for _ in range(letters.count("I")):
                rows.append(("I", role_at(state), ""))
                state = next_state(state)
            return state

        cost = 0
        for letters, sign, name, body in zip(traced, signs.tolist(), names, bodies):
            state, letter = insert(letters, state), letters[-1]
            cost += sum(COSTS[x] for x in letters) + (CUT if letter != "D" and sign % 2 else 0)
            if letter == "R":
                rows.append(("R", role_at(state), body))
                state = next_state(state)
            elif letter == "K":
                rows.append(("K", name, body))
                state = kept_state(state, sign)
        audit = "".join(traced)
        if closes:
            insert(closing(last), last)
            audit += closing(last)
            cost += COSTS["I"] * len(closing(last))
        found.append((audit, cost, rows, "\n".join(f"{r}:{t}" for _, r, t in rows)))
    columns = ["audit", "cost", "rows", "lines"]
    return pd.DataFrame(found, columns=columns) if found else pd.DataFrame({c: [] for c in columns})


def repaired_rows(pieces: DataFrame) -> DataFrame:
    """``(conv, part, seq, place, edit, role, text)``, a row per repaired row, in order of the first four."""
    rows = pieces.select("conv", "part", "seq", F.posexplode("rows").alias("place", "row"))
    return rows.select("conv", "part", "seq", "place", F.col("row.edits").alias("edit"), "row.role", "row.text")


SUMMARY = (
    "conv string, gaps long, blank long, duplicate long, truncated long, illegal long, cost long, "
    "audit string, repaired_sha256 string"
)


def summaries(pieces: DataFrame) -> DataFrame:
    """One row per conversation: its faults, gaps, cost, letters and the digest of its repaired rows.

    A digest runs over one conversation's rows in order, so those of a conversation of many
    pieces are streamed through one task; nothing but its letters is kept there.
    """
    gaps = F.when(F.col("turns") > 0, F.col("high") - F.col("low") + 1 - F.col("turns")).otherwise(F.lit(0))
    whole = pieces.where("whole").select(
        "conv", gaps.alias("gaps"), F.col("n_blank").alias("blank"), F.col("n_duplicate").alias("duplicate"),
        F.col("n_truncated").alias("truncated"), F.col("n_illegal").alias("illegal"), "cost", "audit",
        F.sha2("lines", 256).alias("repaired_sha256"),
    )

    def follow(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        kept, own = None, []
        for batch in batches:
            for row in batch.itertuples():
                if kept is None or kept["conv"] != row.conv:
                    if kept is not None:
                        own.append(_closed(kept))
                    kept = {"conv": row.conv, "sums": np.zeros(6, np.int64), "low": None, "high": None, "last": None,
                            "audit": [], "digest": hashlib.sha256(), "any": False}
                _add(kept, row)
            if own:
                yield pd.DataFrame(own)
                own = []
        if kept is not None:
            yield pd.DataFrame([_closed(kept)])

    rest = pieces.where("not whole").select(
        "conv", "part", "seq", "n_blank", "n_duplicate", "n_truncated", "n_illegal", "cost", "turns",
        "low", "high", "first", "last", "audit", "lines", (F.size("rows") > 0).alias("some"),
    ).repartition("conv").sortWithinPartitions("conv", "part", "seq")
    return whole.unionByName(rest.mapInPandas(follow, SUMMARY))


def _add(kept: dict, row) -> None:
    crossing = int(kept["last"] is not None and kept["last"] + row.first not in LEGAL)
    # Turns ascend: only a piece's lowest can be the highest of the piece before it.
    repeated = int(row.turns > 0 and kept["high"] == row.low)
    kept["sums"] += [row.n_blank, row.n_duplicate, row.n_truncated, row.n_illegal + crossing, row.cost,
                     row.turns - repeated]
    if row.turns > 0:
        kept["low"] = row.low if kept["low"] is None else kept["low"]
        kept["high"] = row.high
    kept["last"] = row.last
    kept["audit"].append(row.audit)
    if row.some:
        kept["digest"].update(("\n" if kept["any"] else "").encode() + row.lines.encode())
        kept["any"] = True


def _closed(kept: dict) -> dict:
    blank, duplicate, truncated, illegal, cost, turns = kept["sums"].tolist()
    gaps = 0 if kept["low"] is None else int(kept["high"]) - int(kept["low"]) + 1 - turns
    return {
        "conv": kept["conv"], "gaps": gaps, "blank": blank, "duplicate": duplicate, "truncated": truncated,
        "illegal": illegal, "cost": cost, "audit": "".join(kept["audit"]),
        "repaired_sha256": kept["digest"].hexdigest(),
    }


def damage(turns: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text"):
    """Reproducible faults, by the crc32 of ``conv:turn``: of twenty rows one is lost, one
    emptied, one stripped of sentence ends, one repeated and one given to the user."""
    names = {conv: "conv_id", turn: "turn", role: "role", text: "text"}
    known = {n: F.col(f"`{c}`") for c, n in names.items()}
    spelled = {n: F.coalesce(c.cast("string"), F.lit(" ")) for n, c in known.items()}
    kind = F.crc32(F.concat(spelled["conv_id"], F.lit(":"), spelled["turn"])) % 20
    rows = turns.select(
        known["conv_id"].alias("conv_id"), known["turn"].alias("turn"),
        F.when(kind == 4, "user").otherwise(spelled["role"]).alias("role"),
        F.when(kind == 1, "").when(kind == 2, F.translate(spelled["text"], ".!?", "")).otherwise(spelled["text"]).alias("text"),
        kind.alias("_kind"),
    )
    copies = F.sequence(F.lit(0), F.when(F.col("_kind") == 3, 1).otherwise(0))
    kept = rows.where("_kind <> 0").withColumn("_copy", F.explode(copies)).drop("_kind", "_copy")
    return kept, rows.where("_kind = 0").select("conv_id")


def audit(turns: DataFrame, everyone: DataFrame, conv: str = "conv_id") -> DataFrame:
    """:func:`summaries` of ``turns``, with a row of zeros for each id of ``everyone`` that has no rows there."""
    kind = everyone.schema[conv].dataType
    found = materialize(summaries(repair(turns, conv)), "audits")
    named = found.select(
        F.when(F.col("conv") != "", F.substring("conv", 2, 1 << 30)).cast(kind).alias("conv_id"),
        *[c for c in found.columns if c != "conv"])
    lost = everyone.select(conversation_key(F.col(f"`{conv}`")).alias("conv"), F.col(f"`{conv}`").alias("conv_id"))
    lost = lost.distinct().join(found, "conv", "left_anti").select(
        "conv_id", *[F.lit(0).cast("long").alias(c) for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")],
        F.lit("").alias("audit"), F.lit(hashlib.sha256().hexdigest()).alias("repaired_sha256"))
    return named.unionByName(lost)
