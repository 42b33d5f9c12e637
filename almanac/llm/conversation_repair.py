"""Cheapest repair of the role structure of conversations.

The rows of a conversation, in order, are kept (cost 0), given another role (1) or deleted (2), and empty rows are
inserted (5), so that the roles left read: an optional system row, then pairs of user and assistant. Blank and repeated
rows must go; a row that ends without ``.``, ``!`` or ``?`` costs 5 more unless it goes. Of all cheapest edits the one
whose initials (K, R, D, I) are least in ASCII is taken.

The repair is a dynamic programme over the rows with four states, the role put out last. Backward vectors, the cost to
the end from each state, are stored only at checkpoints; walking forward, the vectors of one block at a time are
computed again, and the first tight edit in ASCII order is taken. Checkpoints have two levels. The ordered rows are cut
into chunks of about the square root of their number, whichever conversation they belong to, so that a conversation
with a third of all rows is many tasks' work. A chunk is a 4 x 4 matrix of costs; accumulated from the end, the
matrices give the vector at the end of every chunk. A chunk is then walked by itself from each state it may be entered
in, with checkpoints at the square root of its length.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache
from math import isqrt

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from almanac.llm.batches import map_batches
from almanac.sources import materialise, table

# fixed values: costs of the edits, and of a truncated row that stays
REROLE, DELETE, INSERT, TRUNCATED = 1, 2, 5, 5
# fixed values: white space of blank rows, ends of whole sentences
WHITE = " \t\n\x0b\f\r"
ENDS = (".", "!", "?")

# States: what was put out last.
NOTHING, SYSTEM, USER, ASSISTANT = range(4)
NEXT = (USER, USER, ASSISTANT, USER)  # by a user or assistant row
NAMES = {USER: "user", ASSISTANT: "assistant"}
FINAL = (0, 2 * INSERT, INSERT, 0)
NEVER = 1 << 50
LEAST_SHIFT = 12
SHORT = 64

Vector = tuple[int, int, int, int]

# A row is one letter: its role (s, u, a, other) and whether it is whole, truncated or has to go.
LETTERS = "ABCDEFGHIJKL"


def _with_inserts(v: Vector) -> Vector:
    user, assistant = min(v[USER], INSERT + v[ASSISTANT]), min(v[ASSISTANT], INSERT + v[USER])
    return min(v[NOTHING], INSERT + user), min(v[SYSTEM], INSERT + user), user, assistant


def _stays(letter: str) -> tuple[int | None, str]:
    """Cost of a row that is not deleted, None if it has to be, and its role."""
    role, fault = divmod(LETTERS.index(letter), 3)
    return (0, TRUNCATED, None)[fault], "sua-"[role]


STAYS = {letter: _stays(letter) for letter in LETTERS}


def _kept(state: int, role: str) -> int | None:
    """The state after a row that keeps its role, None where the role may not follow."""
    if role == "s":
        return SYSTEM if state == NOTHING else None
    after = NEXT[state]
    return after if (role, after) in (("u", USER), ("a", ASSISTANT)) else None


def _before(letter: str, after: Vector) -> Vector:
    """The vector before a row from the one after it."""
    cost, role = STAYS[letter]
    best = [DELETE + c for c in after]
    if cost is not None:
        for state in range(4):
            best[state] = min(best[state], cost + REROLE + after[NEXT[state]])
            keep = _kept(state, role)
            if keep is not None:
                best[state] = min(best[state], cost + after[keep])
    return _with_inserts((best[0], best[1], best[2], best[3]))


def matrix(rows: str) -> tuple[int, ...]:
    """Least cost from each state before the rows to each state after them, row by row of the matrix."""
    return _short_matrix(rows) if len(rows) <= SHORT else _matrix(rows)


def _matrix(rows: str) -> tuple[int, ...]:
    columns = []
    for to in range(4):
        v: Vector = tuple(0 if state == to else NEVER for state in range(4))  # type: ignore[assignment]
        for letter in reversed(rows):
            v = _before(letter, v)
        columns.append(v)
    return tuple(min(columns[to][state], NEVER) for state in range(4) for to in range(4))


# Most conversations are short and many of them alike.
_short_matrix = lru_cache(maxsize=10_000)(_matrix)


def through(chunk: tuple[int, ...] | list[int], after: Vector) -> Vector:
    """The vector before a chunk, from its matrix and the vector after it."""
    return tuple(min(chunk[4 * state + to] + after[to] for to in range(4)) for state in range(4))  # type: ignore[return-value]


def walk(rows: str, after: Vector, state: int, last: bool) -> tuple[str, int]:
    """The tight edits from a state, least in ASCII, and the state they end in; ``last`` adds the closing inserts."""
    block = isqrt(len(rows)) + 1
    starts = range(0, len(rows), block)
    stored = {len(rows): after}
    v = after
    for i in range(len(rows) - 1, -1, -1):
        v = _before(rows[i], v)
        if i % block == 0:
            stored[i] = v
    edits: list[str] = []
    for start in starts:
        stop = min(start + block, len(rows))
        vectors = [stored[stop]]
        for i in range(stop - 1, start - 1, -1):
            vectors.append(_before(rows[i], vectors[-1]))
        vectors.reverse()
        for i in range(start, stop):
            now, then = vectors[i - start], vectors[i - start + 1]
            cost, role = STAYS[rows[i]]
            while True:
                if now[state] == DELETE + then[state]:
                    edits.append("D")
                elif now[state] == INSERT + now[NEXT[state]]:
                    edits.append("I")
                    state = NEXT[state]
                    continue
                elif (keep := _kept(state, role)) is not None and now[state] == cost + then[keep]:
                    edits.append("K")
                    state = keep
                else:
                    edits.append("R")
                    state = NEXT[state]
                break
    while last and after[state] == INSERT + after[NEXT[state]]:
        edits.append("I")
        state = NEXT[state]
    return "".join(edits), state


def _map(rows: DataFrame, added: str, run) -> DataFrame:
    """All columns, and those that ``run`` makes of the rows of a batch, given as tuples without the first column."""
    schema = T.StructType(rows.schema.fields + T._parse_datatype_string(added).fields)
    names = schema.names
    kinds = [_arrow(field.dataType) for field in schema.fields[len(rows.columns):]]

    def batches(found: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in found:
            values = [run(*row) for row in zip(*[column.to_pylist() for column in batch.columns[1:]])]
            new = [pa.array([v[i] for v in values], kind) for i, kind in enumerate(kinds)]
            yield pa.RecordBatch.from_arrays([*batch.columns, *new], names)

    return map_batches(rows, batches, schema)


def _arrow(kind: T.DataType) -> pa.DataType:
    if isinstance(kind, T.ArrayType):
        return pa.list_(_arrow(kind.elementType))
    return {T.LongType: pa.int64(), T.StringType: pa.string(), T.IntegerType: pa.int32()}[type(kind)]


def _joined(left: DataFrame, right: DataFrame, *keys: str) -> DataFrame:
    """Inner join in which null keys meet."""
    renamed = right.select(*[F.col(k).alias(f"_right_{k}") for k in keys], *[c for c in right.columns if c not in keys])
    on = [F.col(k).eqNullSafe(F.col(f"_right_{k}")) for k in keys]
    return left.join(renamed, on).drop(*[f"_right_{k}" for k in keys])


def ordered_rows(
    rows: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text"
) -> DataFrame:
    """conv, turn, role, text and place, a number that grows in the order of conversations, turns (nulls first), roles, texts.

    A null role or text counts as one space. The rows are dealt by range of the whole order, equal rows by their position,
    so no conversation and no repeated row meets in one task; written, so that places stay.
    """
    named = rows.select(
        F.col(conv).alias("conv"), F.col(turn).alias("turn"), F.coalesce(F.col(role), F.lit(" ")).alias("role"),
        F.coalesce(F.col(text), F.lit(" ")).alias("text"), F.monotonically_increasing_id().alias("tie"),
    )
    order = [F.asc_nulls_first("conv"), F.asc_nulls_first("turn"), "role", "text", "tie"]
    dealt = named.repartitionByRange(*order).sortWithinPartitions(*order).drop("tie")
    return materialise(dealt.withColumn("place", F.monotonically_increasing_id()), "conversation-rows")


def row_faults(ordered: DataFrame) -> DataFrame:
    """conv, place, first (initial of the role) and fault: blank, duplicate, truncated or null."""
    tail = F.rtrim("text", F.lit(WHITE))
    key = F.sha2(F.concat(F.char_length("role").cast("string"), F.lit(":"), "role", "text"), 256)
    slim = ordered.select(
        "conv", "place", F.substring("role", 1, 1).alias("first"), key.alias("key"), (tail == "").alias("blank"),
        (~F.right(tail, F.lit(1)).isin(*ENDS)).alias("open"),
    )
    # Only what occurs twice is joined back; the earliest of it is found by partial minima, whatever its number.
    earliest = slim.groupBy("conv", "key").agg(F.min("place").alias("earliest"), F.count("*").alias("n")).filter("n > 1")
    on = F.col("conv").eqNullSafe(F.col("conv_of")) & (F.col("key") == F.col("key_of"))
    found = slim.join(earliest.select(F.col("conv").alias("conv_of"), F.col("key").alias("key_of"), "earliest"), on, "left")
    fault = F.when(F.col("blank"), "blank").when(F.col("place") > F.col("earliest"), "duplicate").when(F.col("open"), "truncated")
    return found.select("conv", "place", "first", fault.alias("fault"))


def _chunks(faults: DataFrame, shift: int) -> DataFrame:
    """conv, chunk, the rows of the chunk as letters, the first of their places and the number of rows by fault."""
    role = F.when(F.col("first") == "s", 0).when(F.col("first") == "u", 1).when(F.col("first") == "a", 2).otherwise(3)
    kind = F.when(F.col("fault").isNull(), 0).when(F.col("fault") == "truncated", 1).otherwise(2)
    letter = F.substring(F.lit(LETTERS), role * 3 + kind + 1, F.lit(1))
    lettered = faults.select("conv", "place", "fault", F.shiftright("place", shift).alias("chunk"), letter.alias("letter"))
    number = [F.count_if(F.col("fault") == f).alias(f) for f in ("blank", "duplicate", "truncated")]
    grouped = lettered.groupBy("conv", "chunk").agg(
        F.array_sort(F.collect_list(F.struct("place", "letter"))).alias("listed"), F.min("place").alias("start"), *number
    )
    return grouped.select(
        "conv", "chunk", "start", F.array_join("listed.letter", "").alias("letters"), "blank", "duplicate", "truncated"
    )


def _illegal(letters: str) -> int:
    roles = [STAYS[x][1] for x in letters]
    return sum(a + b not in ("su", "ua", "au") for a, b in zip(roles, roles[1:]))


def _checkpoints(chunks: list[int], matrices: list[list[int]], edges: list[str]) -> tuple:
    """Vectors after each chunk, whether it is the first (1) or last (2), the cost of all, illegal pairs between chunks."""
    ends, v = [], FINAL
    for m in reversed(matrices):
        ends.append(list(v))
        v = through(m, v)
    between = sum(_illegal(a[1] + b[0]) for a, b in zip(edges, edges[1:]))
    border = [(i == 0) + 2 * (i == len(chunks) - 1) for i in range(len(chunks))]
    return ends[::-1], border, v[NOTHING], between


def _entered(chunks: list[int], ends: list[list[int]]) -> tuple:
    """The state in which each chunk is entered, from the states that each chunk leaves by."""
    states, state = [], NOTHING
    for by_start in ends:
        states.append(state)
        state = by_start[state]
    return (states,)


def _listed(rows: DataFrame, *columns: str) -> DataFrame:
    """conv and, in the order of the chunks, an array of chunks and of each column."""
    listed = rows.groupBy("conv").agg(F.array_sort(F.collect_list(F.struct("chunk", *columns))).alias("listed"))
    return listed.select("conv", *[F.col(f"listed.{c}").alias(c) for c in ("chunk", *columns)])


def _steps(letters: str, start: int, state: int, audit: str) -> tuple:
    """Places, steps at a place (inserts count from zero), edits and roles put out, of a chunk's edits.

    Inserts stand before the row of their place, closing ones after that of the last.
    """
    places, steps, edits, roles = [], [], [], []
    row, step = 0, 0
    for edit in audit:
        name = None
        if edit == "K":
            state = _kept(state, STAYS[letters[row]][1])  # type: ignore[assignment]
        elif edit != "D":
            state = NEXT[state]
            name = NAMES[state]
        closing = row == len(letters)
        places.append(start + row - closing)
        steps.append(step)
        edits.append(edit)
        roles.append(name)
        step += 1
        if edit != "I":
            row += 1
            step = 0 if row < len(letters) else step
    return places, steps, edits, roles


def repaired(ordered: DataFrame, shift: int | None = None) -> tuple[DataFrame, DataFrame]:
    """Edits and summary of ``ordered_rows``; the summary is that of ``planned``.

    Edits: conv, place, step, edit (K, R, D or I), role and text, ordered within a conversation by place and step; rows
    with edit D are the deleted ones, the others make the repaired conversation.
    """
    steps, summary = planned(ordered, shift)
    single = steps.select(F.col("place").alias("at"), "step", "edit", "named")
    edits = ordered.join(single, F.col("place") == F.col("at")).select(
        "conv", "place", "step", "edit", F.coalesce("named", "role").alias("role"),
        F.when(F.col("edit") == "I", "").otherwise(F.col("text")).alias("text"),
    )
    return edits, summary


def planned(ordered: DataFrame, shift: int | None = None) -> tuple[DataFrame, DataFrame]:
    """Steps and summary of ``ordered_rows``.

    Steps: conv, place, step, edit (K, R, D or I) and named, the role that the edit gives. Summary: conv, blank, duplicate,
    truncated (rows by their first fault), illegal (neighbours whose roles may not follow each other), cost.

    A null conv is a conversation like any other. Without rows both are empty. ``shift`` is the binary logarithm of the
    rows of a chunk, by default about half that of all rows.
    """
    if shift is None:
        shift = max(LEAST_SHIFT, min(30, (ordered.count().bit_length() + 1) // 2))
    chunks = materialise(_chunks(row_faults(ordered), shift), "conversation-chunks")
    measured = _map(
        chunks.select("conv", "letters", "chunk"), "matrix array<long>, edges string, within long",
        lambda letters, chunk: (matrix(letters), letters[0] + letters[-1], _illegal(letters)),
    ).select("conv", "chunk", "matrix", "edges")
    ends = _map(
        _listed(measured, "matrix", "edges"), "ends array<array<long>>, border array<long>, cost long, between long", _checkpoints
    )
    ends = materialise(ends.select("conv", "chunk", "ends", "border", "cost", "between"), "conversation-ends")
    each = ends.select("conv", F.explode(F.arrays_zip("chunk", "ends", "border")).alias("e")).select(
        "conv", "e.chunk", F.col("e.ends").alias("end"), "e.border"
    )

    def walks(letters: str, chunk: int, start: int, end: list[int], border: int) -> tuple:
        states = [NOTHING] if border % 2 else range(4)
        found = [walk(letters, tuple(end), state, border >= 2) for state in states]  # type: ignore[arg-type]
        return [audit for audit, _ in found], [state for _, state in found]

    walked = materialise(
        _map(
            _joined(chunks.select("conv", "letters", "chunk", "start"), each, "conv", "chunk"),
            "audits array<string>, leaves array<long>", walks,
        ).drop("end", "border"),
        "conversation-walks",
    )
    entered = _map(_listed(walked, "leaves"), "states array<long>", _entered).select(
        "conv", F.explode(F.arrays_zip("chunk", "states")).alias("e")
    ).select("conv", "e.chunk", F.col("e.states").alias("state"))
    chosen = _joined(walked, entered, "conv", "chunk").select(
        "conv", "letters", "start", "state", F.get("audits", F.col("state").cast("int")).alias("audit")
    )
    steps = _map(chosen, "places array<long>, steps array<long>, edits array<string>, roles array<string>", _steps)
    single = steps.select("conv", F.explode(F.arrays_zip("places", "steps", "edits", "roles")).alias("e")).select(
        "conv", F.col("e.places").alias("place"), F.col("e.steps").alias("step"), F.col("e.edits").alias("edit"),
        F.col("e.roles").alias("named"),
    )
    counted = _map(chunks.select("conv", "letters"), "within long", lambda letters: (_illegal(letters),))
    sums = _joined(
        chunks.groupBy("conv").agg(*[F.sum(c).alias(c) for c in ("blank", "duplicate", "truncated")]),
        counted.groupBy("conv").agg(F.sum("within").alias("within")), "conv",
    )
    summary = _joined(sums, ends.select("conv", "cost", "between"), "conv").select(
        "conv", "blank", "duplicate", "truncated", (F.col("within") + F.col("between")).alias("illegal"), "cost"
    )
    return single, summary


def turn_gaps(ordered: DataFrame) -> DataFrame:
    """conv and gaps: how many turns between its first and last no row has. Null turns count for nothing."""
    turns = ordered.groupBy("conv", "turn").agg(F.lit(1).alias("one")).groupBy("conv")
    gaps = F.max("turn") - F.min("turn") + 1 - F.count("turn")
    return turns.agg(F.coalesce(gaps, F.lit(0)).cast("long").alias("gaps"))


def conversation_digests(ordered: DataFrame, steps: DataFrame) -> DataFrame:
    """conv, audit (initials of all edits) and repaired_sha256 of the rows ``role:text`` left, joined by newlines.

    A digest is a single pass over its conversation, so the rows, each before its steps, stream by in order and only the
    initials are held. The texts are dealt once for it.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, started, audit, digest, rows = None, False, [], hashlib.sha256(), 0
        own_role = own_text = ""

        def closed() -> tuple:
            return current, "".join(audit), digest.hexdigest()

        for batch in batches:
            done, kind = [], batch.schema.field(0).type
            for conv, edit, role, text in zip(*[batch.column(i).to_pylist() for i in range(4)]):
                if not started or conv != current:
                    if started:
                        done.append(closed())
                    current, started, audit, digest, rows = conv, True, [], hashlib.sha256(), 0
                if edit is None:
                    own_role, own_text = role, text
                    continue
                audit.append(edit)
                if edit != "D":
                    line = f"{role}:" if edit == "I" else f"{role or own_role}:{own_text}"
                    digest.update(("\n" * (rows > 0) + line).encode())
                    rows += 1
            if done:
                yield batch_of(done, kind)
        if started:
            yield batch_of([closed()], kind)

    def batch_of(done: list[tuple], kind: pa.DataType) -> pa.RecordBatch:
        kinds = (kind, pa.string(), pa.string())
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*done), kinds)], schema.names)

    added = T._parse_datatype_string("audit string, repaired_sha256 string").fields
    schema = T.StructType([ordered.schema["conv"], *added])
    none = F.lit(None).cast("string")
    both = ordered.select("conv", "place", F.lit(-1).cast("long").alias("step"), none.alias("edit"), "role", "text").unionByName(
        steps.select("conv", "place", "step", "edit", F.col("named").alias("role"), none.alias("text"))
    )
    streamed = both.repartition(F.col("conv")).sortWithinPartitions(F.asc_nulls_first("conv"), "place", "step")
    return map_batches(streamed.select("conv", "edit", "role", "text"), run, schema)


def with_planted_damage(
    rows: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text"
) -> DataFrame:
    """The rows damaged by a hash of conversation and turn, as the query's contract has it: dropped, emptied, without the
    ends of sentences, repeated or given to the user. Nulls become one space in the key, the role and the text."""
    one = F.lit(" ")
    key = F.concat(F.coalesce(F.col(conv).cast("string"), one), F.lit(":"), F.coalesce(F.col(turn).cast("string"), one))
    marked = rows.select(
        F.col(conv), F.col(turn), F.coalesce(F.col(role), one).alias(role), F.coalesce(F.col(text), one).alias(text),
        (F.crc32(key) % 20).alias("_kind"),
    )
    kind = F.col("_kind")
    damaged = F.when(kind == 1, "").when(kind == 2, F.regexp_replace(F.col(text), "[.!?]", "")).otherwise(F.col(text))
    copies = F.explode(F.array_repeat(F.lit(1), F.when(kind == 0, 0).when(kind == 3, 2).otherwise(1)))
    return marked.select(
        F.col(conv), F.col(turn), F.when(kind == 4, "user").otherwise(F.col(role)).alias(role), damaged.alias(text),
        copies.alias("_copy"),
    ).drop("_copy")


def repair_report(rows: DataFrame, original: DataFrame, shift: int | None = None) -> DataFrame:
    """Every conv_id of ``original`` with the measures, audit and digest of the repair of ``rows``.

    Of conversations without rows the measures are zero, the audit is empty and the digest that of the empty string.
    """
    ordered = ordered_rows(rows)
    steps, summary = planned(ordered, shift)
    told = _joined(_joined(summary, turn_gaps(ordered), "conv"), conversation_digests(ordered, steps), "conv")
    named = original.select("conv_id").distinct()
    measures = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")
    return named.join(told, F.col("conv_id").eqNullSafe(F.col("conv")), "left").select(
        "conv_id", *[F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in measures],
        F.coalesce("audit", F.lit("")).alias("audit"),
        F.coalesce("repaired_sha256", F.sha2(F.lit(""), 256)).alias("repaired_sha256"),
    )


def op12_conversation_repair(spark: SparkSession, folder: str) -> DataFrame:
    rows = table(spark, folder, "conversations", "conv_id", "turn", "role", "text")
    return repair_report(with_planted_damage(rows), rows)


QUERIES = {"op12_conversation_repair": op12_conversation_repair}
ORACLES: dict[str, str] = {}
