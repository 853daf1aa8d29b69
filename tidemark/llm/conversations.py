"""Cheapest repair of conversations whose turns are faulty or out of order, by Four-Russians tables.

A repaired conversation is empty, or an optional system turn followed by pairs of a user and an
assistant turn. Edits keep, rerole or delete a turn or insert an empty one; `KEEP`, `REROLE`,
`DELETE` and `INSERT` are their prices. Four states say what may follow, so the cost of mending
the rest of a conversation is a vector of four numbers, and after its smallest entry is subtracted
only some dozens of vectors exist. A table holds, for every such vector behind a block of `BLOCK`
turns and every content of the block, the vector before it, the cost, and the state in which each
state leaves the block. Conversations are processed from their ends by lookups in that table.

Tracing goes through the blocks again. A block is expanded backward, turn by turn from the vector
behind it, and its letters are then read forward: in a given state the first letter of D, I, K, R
that loses nothing is taken. A letter and a state fix the next state, so this gives the least of the
cheapest edit texts; ties are settled by costs that are still exact, never by a stored path.

Distribution. Equal turns of one time are one row with a count. Rows without texts are sorted by
conversation and time over all tasks and cut into segments; a conversation of any length is a list
of segments. Where there are several, every segment is summarised for all vectors that may stand
behind it, the summaries are chained, and each segment is traced on its own. The texts are shuffled
once, to be digested in order.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.llm.arrays import column
from tidemark.scratch import ensure_checkpoint_dir

# Fixed values of the contract: prices, blanks and the characters that end a sentence.
KEEP, REROLE, DELETE, INSERT, TRUNCATED = 0, 3, 4, 3, 3
BLANK = r"^[\x20\x09-\x0D]*$"
ENDED = r"[.!?][\x20\x09-\x0D]*\z"

BLOCK = 4
SEGMENT_BITS = 16  # a segment has at most 65,536 rows

# States: nothing yet, after the system turn, after a user turn, after an assistant turn.
_START, _SYSTEM, _USER, _ASSISTANT = range(4)
_INSERTED = {_START: _USER, _SYSTEM: _USER, _USER: _ASSISTANT, _ASSISTANT: _USER}
_KEPT = {
    "s": {_START: _SYSTEM},
    "u": {_START: _USER, _SYSTEM: _USER, _ASSISTANT: _USER},
    "a": {_USER: _ASSISTANT},
    "o": {},
}
# What a turn is to the repair: its initial (s, u, a, other), upper case where it is truncated,
# "d" where it must go, and "-" for no turn at all, which fills up the last block.
_SYMBOLS = "suaoSUAOd-"
_MISSING = len(_SYMBOLS) - 1


def _turn_options(symbol: str, state: int) -> list[tuple[str, int, int]]:
    """Letter, price and next state of every way to deal with a turn, letters in rising order.

    Rerole is written U or A by its new role; both count as R. A state allows only one of them."""
    if symbol == "-":
        return [("", 0, state)]
    options = [("D", DELETE, state)]
    if symbol != "d":
        extra = TRUNCATED if symbol.isupper() else 0
        kept = _KEPT[symbol.lower()].get(state)
        if kept is not None:
            options.append(("K", KEEP + extra, kept))
        new = _INSERTED[state]
        options.append(("U" if new == _USER else "A", REROLE + extra, new))
    return options


def _closed(costs: tuple[int, ...]) -> tuple[int, ...]:
    """Costs when turns may be inserted first."""
    out = list(costs)
    for _ in range(3):
        for state, after in _INSERTED.items():
            out[state] = min(out[state], INSERT + out[after])
    return tuple(out)


def _before(symbol: str, after: tuple[int, ...]) -> tuple[int, ...]:
    """Costs of the rest in front of a turn, given those behind it."""
    direct = tuple(min(price + after[new] for _, price, new in _turn_options(symbol, q)) for q in range(4))
    return direct if symbol == "-" else _closed(direct)


def _letters(symbol: str, after: tuple[int, ...], state: int) -> tuple[str, int]:
    """The least letters from a state up to and with a turn that cost no more than they must, and
    the state behind it. Inserted turns are written u or a and count as I."""
    costs, written = _before(symbol, after), ""
    while True:
        options = [(letter, price + after[new], new) for letter, price, new in _turn_options(symbol, state)]
        if symbol != "-":
            new = _INSERTED[state]
            options.append(("u" if new == _USER else "a", INSERT + costs[new], new))
            options.sort(key=lambda o: _AUDIT.get(o[0], o[0]))
        letter, _, new = next(o for o in options if o[1] == costs[state])
        written, state = written + letter, new
        if letter not in ("u", "a"):
            return written, state


_AUDIT = {"U": "R", "A": "R", "u": "I", "a": "I"}
_END = _closed((0, 10**6, 10**6, 0))  # an empty conversation or one that ends with an assistant turn
_TAIL = ("", "ua", "a", "")  # what is inserted at the end, by state


@dataclass(frozen=True)
class Tables:
    """Transitions of normalised vectors over single turns and over blocks of `BLOCK` turns.

    All are indexed by the vector behind and the content: ``vector`` before it, ``cost`` added,
    ``exits`` the state behind it per state before it."""

    end: int
    end_cost: int
    costs: np.ndarray  # vector, state
    turn_vector: np.ndarray
    block_vector: np.ndarray
    block_cost: np.ndarray
    block_exits: np.ndarray
    letters: list[list[list[str]]]
    turn_exits: np.ndarray


@lru_cache(maxsize=1)
def tables() -> Tables:
    def normal(costs: tuple[int, ...]) -> tuple[tuple[int, ...], int]:
        return tuple(c - min(costs) for c in costs), min(costs)

    known = {normal(_END)[0]: 0}
    waiting = list(known)
    vector, cost = [], []
    for after in waiting:
        steps = [normal(_before(s, after)) for s in _SYMBOLS]
        for before, _ in steps:
            if before not in known:
                known[before] = len(waiting)
                waiting.append(before)
        vector.append([known[b] for b, _ in steps])
        cost.append([c for _, c in steps])
    traced = [[[_letters(s, after, q) for q in range(4)] for s in _SYMBOLS] for after in waiting]
    letters = [[[t[0] for t in by_state] for by_state in by_symbol] for by_symbol in traced]
    exits = np.array([[[t[1] for t in by_state] for by_state in by_symbol] for by_symbol in traced], np.int8)
    one_vector, one_cost = np.array(vector, np.int16), np.array(cost, np.int32)

    n, k = one_vector.shape
    blocks, costs, outs = np.arange(n, dtype=np.int16)[:, None], np.zeros((n, 1), np.int32), np.tile(np.arange(4, dtype=np.int8), (n, 1, 1))
    for _ in range(BLOCK):
        # A turn more in front: contents are numbers to the base of the symbols, first turn first.
        size = blocks.shape[1]
        costs = (one_cost[blocks].transpose(0, 2, 1) + costs[:, None, :]).reshape(n, k * size)
        first = exits[blocks].transpose(0, 2, 1, 3)  # vector, symbol, rest, state
        rest = np.broadcast_to(outs[:, None], (n, k, size, 4))
        outs = np.take_along_axis(rest, first.astype(np.int64), axis=3).reshape(n, k * size, 4)
        blocks = one_vector[blocks].transpose(0, 2, 1).reshape(n, k * size)
    return Tables(0, min(_END), np.array(waiting), one_vector, blocks, costs, outs, letters, exits)


def _block_contents(symbols: str) -> np.ndarray:
    """The blocks of a text of symbols as numbers; the last one is filled up."""
    codes = np.full(-(-len(symbols) // BLOCK) * BLOCK, _MISSING, np.int64)
    codes[: len(symbols)] = [_SYMBOLS.index(s) for s in symbols]
    return codes.reshape(-1, BLOCK) @ len(_SYMBOLS) ** np.arange(BLOCK - 1, -1, -1)


def summarise(symbols: str) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Vector before, cost, and state behind per state before, for every vector behind a segment."""
    t = tables()
    n = len(t.costs)
    vector, cost, exits = np.arange(n), np.zeros(n, np.int64), np.tile(np.arange(4), (n, 1))
    for content in _block_contents(symbols)[::-1]:
        out = t.block_exits[vector, content].astype(np.int64)
        exits = np.take_along_axis(exits, out, axis=1)
        cost += t.block_cost[vector, content]
        vector = t.block_vector[vector, content].astype(np.int64)
    return vector, cost, exits


def trace(symbols: str, behind: int, state: int) -> tuple[list[str], int, int, int]:
    """The letters of every turn, the vector before them, the cost up to the vector behind, and the
    last state."""
    t = tables()
    contents = _block_contents(symbols)
    vector, cost, stack = behind, 0, []
    for content in contents[::-1].tolist():
        stack.append(vector)
        cost += int(t.block_cost[vector, content])
        vector = int(t.block_vector[vector, content])
    codes = [_SYMBOLS.index(s) for s in symbols]
    written = []
    for b, after in enumerate(stack[::-1]):
        block = codes[b * BLOCK : (b + 1) * BLOCK]
        vectors = [after]
        for code in block[:0:-1]:
            vectors.append(int(t.turn_vector[vectors[-1], code]))
        for code, behind_turn in zip(block, vectors[::-1]):
            written.append(t.letters[behind_turn][code][state])
            state = int(t.turn_exits[behind_turn, code, state])
    return written, vector, cost, state


def audit_of(letters: Column) -> Column:
    """Edit letters D, I, K and R from the internal ones, which also tell the new roles."""
    return F.translate(letters, "UAua", "RRII")


# --- over a table ----------------------------------------------------------------------


def _row_keys(turns: DataFrame, conv_col: str, turn_col: str, role_col: str, text_col: str) -> DataFrame:
    """Conversation, turn, role, text and a digest of the last two; null roles and texts are one space."""
    role = F.coalesce(F.col(f"`{role_col}`").cast("string"), F.lit(" "))
    text = F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit(" "))
    named = turns.select(
        F.col(f"`{conv_col}`").alias("conv"), F.col(f"`{turn_col}`").alias("turn"), role.alias("role"), text.alias("text")
    )
    both = F.concat(F.length("role").cast("string"), F.lit(":"), F.col("role"), F.col("text"))
    return named.withColumn("digest", F.unhex(F.sha2(both, 256)))


def _light_rows(keyed: DataFrame) -> DataFrame:
    """One row without text for equal turns of one time: how many they are, what they are."""
    initial = F.substring("role", 1, 1)
    kind = F.when(initial.isin("s", "u", "a"), initial).otherwise("o")
    light = keyed.select(
        "conv",
        "turn",
        "role",
        "digest",
        kind.alias("kind"),
        F.col("text").rlike(BLANK).alias("blank"),
        (~F.col("text").rlike(ENDED)).alias("cut"),
    )
    light = light.groupBy("conv", "turn", "role", "digest").agg(
        F.count(F.lit(1)).alias("copies"), *[F.first(c).alias(c) for c in ("kind", "blank", "cut")]
    )
    when = F.struct(F.col("turn").isNotNull().alias("known"), F.col("turn").alias("turn"))
    firsts = light.groupBy("conv", "role", "digest").agg(F.min(when).alias("first"))
    firsts = firsts.select(
        F.col("conv").alias("c"), F.col("role").alias("r"), F.col("digest").alias("d"), F.col("first.turn").alias("t"), F.lit(True).alias("is_first")
    )
    # Keyed by time as well, so both sides have one row per key, however often a text is repeated.
    same = F.col("conv").eqNullSafe(F.col("c")) & F.col("turn").eqNullSafe(F.col("t"))
    same &= (F.col("role") == F.col("r")) & (F.col("digest") == F.col("d"))
    joined = light.join(firsts, same, "left").drop("c", "r", "d", "t")
    repeated = F.col("is_first").isNull()
    symbol = (
        F.when(F.col("blank") | repeated, "d").when(F.col("cut"), F.upper("kind")).otherwise(F.col("kind"))
    )
    return joined.select("conv", "turn", "role", "digest", "copies", "kind", "blank", "cut", repeated.alias("repeated"), symbol.alias("symbol"))


def _segments(light: DataFrame) -> DataFrame:
    """Rows in order, cut into segments: ``(conv, segment, rows)``."""
    spark = light.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    order = [F.col("conv").asc_nulls_first(), F.col("turn").asc_nulls_first(), F.col("role"), F.col("digest")]
    placed = (
        light.repartitionByRange(parts, *order)
        .sortWithinPartitions(*order)
        .withColumn("place", F.monotonically_increasing_id())
        .checkpoint()
    )
    segment = F.shiftright("place", SEGMENT_BITS).alias("segment")
    row = F.struct("place", "turn", "role", "digest", "copies", "kind", "symbol")
    return placed.groupBy("conv", segment).agg(
        F.array_sort(F.collect_list(row)).alias("rows"),
        F.sum(F.when(F.col("blank"), F.col("copies")).otherwise(0)).alias("blank"),
        F.sum(F.when(F.col("blank"), 0).when(F.col("repeated"), F.col("copies")).otherwise(F.col("copies") - 1)).alias("duplicate"),
        F.sum(F.when(F.col("cut") & ~F.col("blank") & ~F.col("repeated"), 1).otherwise(0)).alias("truncated"),
        F.sum(F.col("copies") - 1).alias("extra"),
        F.min("turn").alias("low"),
        F.max("turn").alias("high"),
    )


def repair(
    turns: DataFrame,
    conv_col: str = "conv_id",
    turn_col: str = "turn",
    role_col: str = "role",
    text_col: str = "text",
) -> tuple[DataFrame, DataFrame]:
    """The cheapest repair of every conversation: ``(conversations, edits)``.

    ``conversations`` has conv, gaps, blank, duplicate, truncated, illegal, cost and audit.
    ``edits`` has a row per turn that is kept, reroled or inserted: conv, at_end, turn, role and
    digest name the turn of the table (``at_end``: behind the last turn), and letters say what
    is inserted before it (u, a) and what becomes of it (K, or U and A for a new role).

    Turns of one time are taken in the order of role and of the digest of role and text; equal ones
    of one time stand together. A null role or text is one space, a null conversation is a
    conversation of its own, null times come first. Texts of any length are only read by built-in
    functions here. Other columns are left out whatever their names, and an empty table gives two
    empty ones. A conversation may be longer than what a task can hold, except for its audit, which
    is one cell.
    """
    spark = turns.sparkSession
    ensure_checkpoint_dir(spark)
    keyed = _row_keys(turns, conv_col, turn_col, role_col, text_col)
    segments = _segments(_light_rows(keyed)).checkpoint()
    bounds = segments.groupBy("conv").agg(F.min("segment").alias("first"), F.max("segment").alias("last"))
    bounds = bounds.select(F.col("conv").alias("c"), "first", "last")
    placed = segments.join(bounds, F.col("conv").eqNullSafe(F.col("c"))).drop("c")
    symbols = F.array_join(F.transform("rows", lambda r: r["symbol"]), "").alias("symbols")
    many = placed.where("first < last").select("conv", "segment", "first", "last", symbols)
    chained = _chained(many)
    chained = chained.select(F.col("conv").alias("c"), F.col("segment").alias("s"), "behind", "state")
    traced = placed.join(
        chained, F.col("conv").eqNullSafe(F.col("c")) & (F.col("segment") == F.col("s")), "left"
    ).drop("c", "s")
    alone = tables().end
    traced = traced.select(
        "*", symbols, F.coalesce("behind", F.lit(alone)).alias("_behind"), F.coalesce("state", F.lit(_START)).alias("_state")
    ).drop("behind", "state")
    done = _traced(traced).checkpoint()
    return _conversations(done), _edits(done)


def _chained(many: DataFrame) -> DataFrame:
    """The vector behind and the state before every segment of conversations with several."""
    narrow = T.StructType([many.schema["conv"]] + T.StructType.fromDDL("segment bigint, vectors binary, exits binary").fields)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [summarise(s) for s in column(batch, "symbols").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [
                    column(batch, "conv"),
                    column(batch, "segment"),
                    pa.array([v.astype(np.int16).tobytes() for v, _, _ in found], pa.binary()),
                    pa.array([x.astype(np.int8).tobytes() for _, _, x in found], pa.binary()),
                ],
                names=narrow.names,
            )

    def chain(group: pd.DataFrame) -> pd.DataFrame:
        """One row per segment, each as large as the number of vectors."""
        group = group.sort_values("segment").reset_index(drop=True)
        vectors = [np.frombuffer(v, np.int16) for v in group["vectors"]]
        exits = [np.frombuffer(x, np.int8).reshape(-1, 4) for x in group["exits"]]
        behind, states = [tables().end], [_START]
        for v in vectors[:0:-1]:
            behind.append(int(v[behind[-1]]))
        behind.reverse()
        for x, b in zip(exits[:-1], behind):
            states.append(int(x[b, states[-1]]))
        return pd.DataFrame({"conv": group["conv"], "segment": group["segment"], "behind": behind, "state": states})

    out = T.StructType([many.schema["conv"]] + T.StructType.fromDDL("segment bigint, behind int, state int").fields)
    return many.mapInArrow(run, narrow).groupBy("conv").applyInPandas(chain, out)


def _traced(segments: DataFrame) -> DataFrame:
    """Letters of every row, the cost, and what is inserted at the end of the conversation."""
    kept = [c for c in segments.columns if c not in ("symbols", "_behind", "_state")]
    schema = T.StructType(
        [segments.schema[c] for c in kept] + T.StructType.fromDDL("letters array<string>, cost bigint, tail string").fields
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        t = tables()
        for batch in batches:
            letters, costs, tails = [], [], []
            asked = [column(batch, c).to_pylist() for c in ("symbols", "_behind", "_state", "segment", "last")]
            for symbols, behind, state, segment, last in zip(*asked):
                written, before, cost, left = trace(symbols, behind, state)
                letters.append(written)
                # What the whole rest costs from here, less what it costs from the end of the segment.
                costs.append(int(t.costs[before, state]) + cost - int(t.costs[behind, left]))
                tails.append(_TAIL[left] if segment == last else "")
            yield pa.RecordBatch.from_arrays(
                [
                    *(column(batch, c) for c in kept),
                    pa.array(letters, pa.list_(pa.string())),
                    pa.array(costs, pa.int64()),
                    pa.array(tails, pa.string()),
                ],
                names=[*kept, "letters", "cost", "tail"],
            )

    return segments.mapInArrow(run, schema)


def _conversations(done: DataFrame) -> DataFrame:
    def pairs(rows: Column) -> Column:
        """Neighbouring rows of a segment whose initials may not follow each other."""
        kinds = F.transform(rows, lambda r: r["kind"])
        joined = F.zip_with(F.slice(kinds, 1, F.size(kinds) - 1), F.slice(kinds, 2, F.size(kinds)), lambda a, b: F.concat(a, b))
        return F.size(F.filter(joined, lambda p: ~p.isin("su", "ua", "au")))

    edits = F.zip_with(
        "letters", "rows", lambda w, r: F.concat(audit_of(w), F.repeat(F.lit("D"), (r["copies"] - 1).cast("int")))
    )
    times = F.filter(F.transform("rows", lambda r: r["turn"]), lambda t: t.isNotNull())
    per_segment = done.select(
        "conv",
        "segment",
        "low",
        "high",
        F.size(F.array_distinct(times)).alias("turns"),
        "blank",
        "duplicate",
        "truncated",
        # Copies of one turn stand next to each other, and equal initials never may.
        (F.when(F.size("rows") > 1, pairs(F.col("rows"))).otherwise(0) + F.col("extra")).alias("illegal"),
        (F.col("cost") + INSERT * F.length("tail") + DELETE * F.col("extra")).alias("cost"),
        F.concat(F.array_join(edits, ""), audit_of(F.col("tail"))).alias("audit"),
        F.element_at("rows", 1)["kind"].alias("from_kind"),
        F.element_at("rows", -1)["kind"].alias("to_kind"),
    )
    part = F.array_sort(F.collect_list(F.struct("segment", "audit", "low", "high", "from_kind", "to_kind")))
    totals = per_segment.groupBy("conv").agg(
        *[F.sum(c).alias(c) for c in ("blank", "duplicate", "truncated", "illegal", "cost", "turns")],
        F.min("low").alias("low"),
        F.max("high").alias("high"),
        part.alias("parts"),
    )
    before, after = F.slice("parts", 1, F.size("parts") - 1), F.slice("parts", 2, F.size("parts"))
    borders = F.when(F.size("parts") > 1, F.zip_with(before, after, lambda a, b: F.concat(a["to_kind"], b["from_kind"])))
    bad = F.coalesce(F.size(F.filter(borders, lambda p: ~p.isin("su", "ua", "au"))), F.lit(0))
    # Rows of one time may stand in two segments, which both count it.
    shared = F.when(F.size("parts") > 1, F.zip_with(before, after, lambda a, b: F.coalesce(a["high"] == b["low"], F.lit(False))))
    twice = F.coalesce(F.size(F.filter(shared, lambda s: s)), F.lit(0))
    gaps = F.col("high") - F.col("low") + 1 - (F.col("turns") - twice)
    return totals.select(
        "conv",
        F.coalesce(gaps, F.lit(0)).cast("bigint").alias("gaps"),
        "blank",
        "duplicate",
        "truncated",
        (F.col("illegal") + bad).cast("bigint").alias("illegal"),
        "cost",
        F.array_join(F.transform("parts", lambda p: p["audit"]), "").alias("audit"),
    )


def _edits(done: DataFrame) -> DataFrame:
    rows = done.select("conv", F.explode(F.arrays_zip("letters", "rows")).alias("edit")).where("edit.letters <> 'D'")
    rows = rows.select(
        "conv",
        F.lit(False).alias("at_end"),
        F.col("edit.rows.turn").alias("turn"),
        F.col("edit.rows.role").alias("role"),
        F.col("edit.rows.digest").alias("digest"),
        F.col("edit.letters").alias("letters"),
    )
    end = done.where("tail <> ''").select(
        "conv",
        F.lit(True).alias("at_end"),
        F.lit(None).cast(rows.schema["turn"].dataType).alias("turn"),
        F.lit("").alias("role"),
        F.lit(None).cast("binary").alias("digest"),
        F.col("tail").alias("letters"),
    )
    return rows.unionByName(end)


def repaired_lines(
    turns: DataFrame,
    edits: DataFrame,
    conv_col: str = "conv_id",
    turn_col: str = "turn",
    role_col: str = "role",
    text_col: str = "text",
) -> DataFrame:
    """The turns of the table that stay, with what is inserted around them: conv, at_end, turn,
    role, digest, text, letters, in no order. Equal turns of one time may all be there; only the
    first of them is meant. Nulls are as in `repair`."""
    keyed = _row_keys(turns, conv_col, turn_col, role_col, text_col)
    marked = edits.select("*", F.lit(None).cast("string").alias("text"))
    return marked.unionByName(
        keyed.select("conv", F.lit(False).alias("at_end"), "turn", "role", "digest", F.lit(None).cast("string").alias("letters"), "text")
    )


def digests(turns: DataFrame, edits: DataFrame, *columns: str) -> DataFrame:
    """``(conv, repaired_sha256)`` of conversations of which something stays.

    SHA-256 reads its input in order, so all texts of a conversation pass through one task; they are
    sorted on disk and streamed, none but the digest is held. Conversations that are empty after
    their repair have the digest of an empty text, and those without a row in ``turns`` no row.
    """
    lines = repaired_lines(turns, edits, *columns)
    order = [F.col("conv"), F.col("at_end"), F.col("turn").asc_nulls_first(), F.col("role"), F.col("digest"), F.col("letters").asc_nulls_last()]
    lines = lines.repartition(F.col("conv")).sortWithinPartitions(*order)
    schema = T.StructType([lines.schema["conv"], T.StructField("repaired_sha256", T.StringType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        conv, open_, sha, waiting, empty = None, False, None, None, True
        for batch in batches:
            out: list[tuple] = []
            names = ("conv", "letters", "role", "text")
            for c, letters, role, text in zip(*(column(batch, n).to_pylist() for n in names)):
                if not open_ or c != conv:
                    if open_:
                        out.append((conv, sha.hexdigest()))
                    conv, open_, sha, waiting, empty = c, True, hashlib.sha256(), None, True
                # An edit stands before the turns it is about; without one they are deleted.
                if letters is not None:
                    spoken = [("user:" if x == "u" else "assistant:") for x in letters if x in "ua"]
                    waiting = letters[-1] if letters[-1] in "KUA" else None
                elif waiting is not None:
                    name = {"K": role, "U": "user", "A": "assistant"}[waiting]
                    spoken, waiting = [f"{name}:{text}"], None
                else:
                    continue
                for line in spoken:
                    sha.update((line if empty else "\n" + line).encode("utf-8", "surrogatepass"))
                    empty = False
            yield _pairs(out, schema.names, batch)
        if open_:
            yield _pairs([(conv, sha.hexdigest())], schema.names, batch)

    return lines.select("conv", "letters", "role", "text").mapInArrow(run, schema)


def _pairs(rows: list[tuple], names: list[str], like: pa.RecordBatch) -> pa.RecordBatch:
    kind = column(like, "conv").type
    return pa.RecordBatch.from_arrays(
        [pa.array([r[0] for r in rows], kind), pa.array([r[1] for r in rows], pa.string())], names=names
    )
