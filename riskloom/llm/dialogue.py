"""Repair of conversations by Hirschberg's divide and conquer over a four-state cost.

A good conversation's role initials are `(s?(ua)+)?`: nothing, or an optional system message and pairs of user and
assistant. A reader of it is in one of four states: at the start, after s, after u, after a. Each message may be kept
(0), given the role that comes next (2), or deleted (3); messages that are blank or repeat an earlier one must go, kept
ones that are cut off cost 1 more. An empty message of the role that comes next may be inserted anywhere (2). The
initials of the edits (D, I, K, R) in order are the audit; of the cheapest repairs the one with the ASCII-least audit is taken.

The audit falls into one word for each message, its insertions and then its own edit, and one for the end. No word begins
another, so two audits differ at the first word that differs, and audits that lead to different states do differ. A
forward vector therefore needs, for each of the four states, the least cost and the rank of its least audit among the
four. Forward and backward vectors meet in the middle of a conversation; the state with the least sum and then the least rank
is where the repair crosses, and both halves are solved alike. Memory is linear in the messages.

Conversations are sorted over range partitions and read as a stream. One that lies whole in a task and in one piece of
PIECE messages is solved there. Others are cut into pieces; each piece gives a 4 x 4 matrix of costs and ranks, which is a step
like a single message's, so the same divide and conquer finds the states at the borders of pieces, and then every piece
is solved by itself.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator, Sequence
from functools import lru_cache

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

START, SYSTEM, USER, ASSISTANT = range(4)
#: The state after the message that may be inserted, or be made of another, in each state.
NEXT = (USER, USER, ASSISTANT, USER)
ROLES = {USER: "user", ASSISTANT: "assistant"}
#: What the end costs and adds to the audit in each state.
END_COST, END_WORD = (0, 4, 2, 0), ("", "II", "I", "")
DELETE, INSERT, RENAME, CUT_OFF = 3, 2, 2, 1
WORDS = sorted("I" * n + edit for n in range(3) for edit in "DKR")
FINE, TRUNCATED, BLANK, DUPLICATE = range(4)
INITIALS = "sua"
LEGAL = {"su", "ua", "au"}

PIECE = 1000  # messages
PIECE_BYTES = 4 << 20  # and characters of text, but for a single longer message
BATCH = 500  # records written at once
BLANKS = " \t\n\x0b\x0c\r"


def _moves(initial: int, fault: int) -> tuple:
    """Per state the (state after, cost, rank of the word) of a message, the best for each state after."""
    out = []
    for state in range(4):
        best: dict[int, tuple[int, int]] = {}
        for n in range(3):
            choices = [("D", state, DELETE)]
            if fault in (FINE, TRUNCATED):
                extra = CUT_OFF if fault == TRUNCATED else 0
                choices.append(("R", NEXT[state], RENAME + extra))
                kept = {0: SYSTEM if state == START else None, 1: USER, 2: ASSISTANT, 3: None}[initial]
                if kept == SYSTEM or kept == NEXT[state]:
                    choices.append(("K", kept, extra))
            for edit, to, cost in choices:
                move = (n * INSERT + cost, WORDS.index("I" * n + edit))
                best[to] = min(best.get(to, move), move)
            state = NEXT[state]
        out.append(tuple((to, *move) for to, move in best.items()))
    return tuple(out)


#: By code: 4 * fault + initial.
MOVES = [_moves(code % 4, code // 4) for code in range(16)]


def at(state: int) -> list[tuple[int, int] | None]:
    """The forward vector of a known state."""
    return [(0, 0) if q == state else None for q in range(4)]


def forward(steps: Sequence[tuple], low: int, high: int, vector: list) -> list:
    """(cost, rank) of the least audit to each state after the steps from low to high."""
    for i in range(low, high):
        new: list = [None] * 4
        for reached, moves in zip(vector, steps[i], strict=True):
            if reached is not None:
                for to, cost, word in moves:
                    key = (reached[0] + cost, reached[1], word)
                    if new[to] is None or key < new[to]:
                        new[to] = key
        order = sorted(key[1:] for key in new if key)
        vector = [key and (key[0], order.index(key[1:])) for key in new]
    return vector


def backward(steps: Sequence[tuple], low: int, high: int, state: int) -> list[float]:
    """The least cost from each state before the steps to `state` after them."""
    costs = [0.0 if q == state else math.inf for q in range(4)]
    for i in range(high - 1, low - 1, -1):
        costs = [min(cost + costs[to] for to, cost, _ in moves) for moves in steps[i]]
    return costs


def crossings(steps: Sequence[tuple], start: int, end: int) -> list[int]:
    """The states before, between and after the steps of the cheapest, then audit-least way."""
    path = [start] * len(steps) + [end]
    parts = [(0, len(steps))]
    while parts:
        low, high = parts.pop()
        if high - low > 1:
            middle = (low + high) // 2
            to = forward(steps, low, middle, at(path[low]))
            rest = backward(steps, middle, high, path[high])
            path[middle] = min((to[q][0] + rest[q], to[q][1], q) for q in range(4) if to[q])[2]
            parts += [(low, middle), (middle, high)]
    return path


def best_end(steps: Sequence[tuple], start: int = START) -> int:
    """The state in which the cheapest, then audit-least repair comes to the end of all steps."""
    vector = forward(steps, 0, len(steps), at(start))
    return min((vector[q][0] + END_COST[q], vector[q][1], q) for q in range(4) if vector[q])[2]


def words_between(codes: bytes, start: int, end: int) -> list[str]:
    """The audit's words for messages by code, between two states."""
    path = crossings([MOVES[c] for c in codes], start, end)
    return [
        WORDS[next(word for to, _, word in MOVES[code][path[i]] if to == path[i + 1])] for i, code in enumerate(codes)
    ]


@lru_cache(maxsize=1 << 16)
def _short(codes: bytes) -> tuple[list[str], int]:
    return _whole(codes)


def _whole(codes: bytes) -> tuple[list[str], int]:
    end = best_end([MOVES[c] for c in codes])
    return words_between(codes, START, end), end


def solve(codes: bytes) -> tuple[list[str], int]:
    """Words and last state of a whole conversation. Short ones repeat and are remembered."""
    return _short(codes) if len(codes) <= 16 else _whole(codes)


def matrix(codes: bytes) -> list[int]:
    """A piece as one step, flat: for each state before and after the cost (-1 for none) and the rank."""
    steps = [MOVES[c] for c in codes]
    out = []
    for state in range(4):
        for reached in forward(steps, 0, len(steps), at(state)):
            out += reached or (-1, -1)
    return out


def as_step(flat: Sequence[int]) -> tuple:
    """A step like those in MOVES from `matrix`."""
    return tuple(
        tuple((to, flat[8 * q + 2 * to], flat[8 * q + 2 * to + 1]) for to in range(4) if flat[8 * q + 2 * to] >= 0)
        for q in range(4)
    )


def _codes(roles: list[str], faults: list[int]) -> bytes:
    return bytes(4 * fault + (INITIALS.find(role[:1]) if role[:1] in ("s", "u", "a") else 3) for role, fault in zip(roles, faults, strict=True))


def _repaired(rows: dict, faults: list[int], words: list[str], state: int, tail: str) -> dict:
    """What a piece has to tell once its words are known."""
    messages, cost = [], 0
    for word, role, text, fault in zip([*words, tail], [*rows["role"], ""], [*rows["text"], ""], [*faults, FINE], strict=True):
        for edit in word:
            if edit == "D":
                cost += DELETE
                continue
            if edit == "K":
                state = {"s": SYSTEM, "u": USER, "a": ASSISTANT}[role[0]]
                messages.append({"role": role, "text": text})
            else:
                state = NEXT[state]
                messages.append({"role": ROLES[state], "text": text if edit == "R" else ""})
                cost += RENAME if edit == "R" else INSERT
            cost += CUT_OFF if edit != "I" and fault == TRUNCATED else 0
    turns = [t for t in rows["turn"] if t is not None]
    first = [role[:1] for role in rows["role"]]
    return {
        "blank": faults.count(BLANK),
        "duplicate": faults.count(DUPLICATE),
        "truncated": faults.count(TRUNCATED),
        "illegal": sum(a + b not in LEGAL for a, b in zip(first, first[1:], strict=False)),
        "first_initial": first[0],
        "last_initial": first[-1],
        "least_turn": turns[0] if turns else None,
        "last_turn": turns[-1] if turns else None,
        "turns": len(set(turns)),
        "cost": cost,
        "audit": "".join(words) + tail,
        "messages": messages,
    }


def gaps(least: int | None, last: int | None, turns: int) -> int:
    return 0 if least is None else min(last - least + 1 - turns, (1 << 63) - 1)


ROWS = "array<struct<turn: bigint, role: string, text: string, tag: string, fault: int>>"
TOLD = (
    "blank bigint, duplicate bigint, truncated bigint, illegal bigint, first_initial string, last_initial string, "
    "least_turn bigint, last_turn bigint, turns bigint, cost bigint, audit string, messages array<struct<role: string, text: string>>"
)
TOLD_NAMES = [field.split()[0] for field in TOLD.replace("<role: string, text: string>", "").split(", ")]


def _batches(records: Iterator[tuple[dict, int]], schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    kept, size = [], 0
    for record, length in records:
        kept.append(record)
        size += length
        if len(kept) >= BATCH or size >= PIECE_BYTES:
            yield pa.RecordBatch.from_pylist(kept, schema)
            kept, size = [], 0
    if kept:
        yield pa.RecordBatch.from_pylist(kept, schema)


def _schema(df: DataFrame, fields: str) -> tuple[str, pa.Schema]:
    """The type of conv_id before the given fields, for Spark and for Arrow."""
    from pyspark.sql.pandas.types import to_arrow_schema

    text = f"conv_id {df.schema['conv_id'].dataType.simpleString()}, {fields}"
    return text, to_arrow_schema(df.sparkSession.createDataFrame([], text).schema)


def _cut(schema: pa.Schema):
    """Sorted rows to records: conversations solved where they lie whole, else pieces with their rows."""

    def records(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[dict, int]]:
        part, seq = TaskContext.get().partitionId(), 0  # the number of a piece in its task
        now, seen, size, first, begun = None, set(), 0, True, False
        rows: dict[str, list] = {}
        names = ("turn", "role", "text", "tag", "fault")

        def record(whole: bool) -> tuple[dict, int]:
            out = {"conv_id": now, "part": part, "seq": seq, "whole": whole}
            if not whole:
                return {**out, "rows": [dict(zip(names, r, strict=True)) for r in zip(*(rows[n] for n in names), strict=True)]}, size
            faults = _faults(rows, seen)
            words, end = solve(_codes(rows["role"], faults))
            return {**out, **_repaired(rows, faults, words, START, END_WORD[end])}, size

        for batch in batches:
            for conv, *values in zip(*(column.to_pylist() for column in batch.columns), strict=True):
                if not rows or conv != now:
                    if rows:
                        # The first conversation may have begun in the task before.
                        yield record(whole=not (first or begun))
                        first, begun, seq = False, False, seq + 1
                    now, rows, size, seen = conv, {n: [] for n in names}, 0, set()
                elif len(rows["turn"]) >= PIECE or size >= PIECE_BYTES:
                    yield record(whole=False)
                    rows, size, seq, begun = {n: [] for n in names}, 0, seq + 1, True
                for name, value in zip(names, values, strict=True):
                    rows[name].append(value)
                size += len(values[2]) + 100
        if rows:
            yield record(whole=False)  # may go on in the next task

    return lambda batches: _batches(records(batches), schema)


def _faults(rows: dict, seen: set) -> list[int]:
    """The first fault of each message, `seen` being the earlier (role, tag)."""
    out = []
    for role, tag, fault in zip(rows["role"], rows["tag"], rows["fault"], strict=True):
        out.append(DUPLICATE if fault != BLANK and (role, tag) in seen else fault)
        seen.add((role, tag))
    return out


def _unpacked(record: dict) -> tuple[dict, list[int]]:
    """Columns and faults of a piece's rows, with what earlier pieces had marked as repeated."""
    rows = {name: [r[name] for r in record["rows"]] for name in ("turn", "role", "text", "tag", "fault")}
    faults = _faults(rows, set())
    for place in record["repeated"] or []:
        faults[place] = DUPLICATE if faults[place] != BLANK else BLANK
    return rows, faults


def repair(conversations: DataFrame, place: str) -> DataFrame:
    """The repaired conversations of (conv_id, turn, role, text), in pieces of at most about PIECE messages.

    (conv_id, part, seq, whole, ...): part and seq name a piece and order those of a conversation, `whole` tells that there is but
    one. Of each piece: its counts of faults (a message's first fault counts: blank, then role and text seen earlier in
    the conversation, then cut off), `illegal` neighbours within it, its first and last role initial, its first, last
    and number of turns, cost, audit and the repaired messages (role, text). `place` is a folder for what is written
    in between.

    Messages are ordered by turn, NULL first, of one turn by role and md5 of the text; NULL roles and texts count as one
    blank. Rows of a NULL conv_id are one conversation; equal rows repeat each other. Other columns are left out, an
    empty table gives no rows. A message is never cut, so a very long text makes a piece of its own.
    """
    spark = conversations.sparkSession
    text = F.coalesce(F.col("text").cast("string"), F.lit(" "))
    solid = F.rtrim(text, F.lit(BLANKS))
    fault = F.when(solid == "", BLANK).when(F.right(solid, F.lit(1)).isin(".", "!", "?"), FINE).otherwise(TRUNCATED)
    rows = conversations.select(
        "conv_id",
        F.col("turn").cast("long").alias("turn"),
        F.coalesce(F.col("role").cast("string"), F.lit(" ")).alias("role"),
        text.alias("text"),
        F.md5(text).alias("tag"),
        fault.alias("fault"),
    )
    order = ["conv_id", "turn", "role", "tag"]
    # Equal rows without number would all be dealt to one task.
    dealt = rows.withColumn("number", F.monotonically_increasing_id()).repartitionByRange(*order, "number")
    fields, schema = _schema(rows, f"part int, seq int, whole boolean, rows {ROWS}, {TOLD}")
    dealt.drop("number").sortWithinPartitions(*order).mapInArrow(_cut(schema), fields).write.parquet(f"{place}/pieces")
    pieces = spark.read.schema(fields).parquet(f"{place}/pieces")
    columns = ["conv_id", "part", "seq", "whole", *TOLD_NAMES]
    done = pieces.where("whole").select(*columns)
    return done.unionByName(_long(pieces.where("NOT whole").select("conv_id", "part", "seq", "rows"), place).select(*columns))


def _long(pieces: DataFrame, place: str) -> DataFrame:
    """Pieces of conversations that are longer or lie in several tasks, solved between the states at their borders."""
    spark = pieces.sparkSession
    rows = pieces.select("conv_id", "part", "seq", F.posexplode("rows").alias("place", "r"))
    rows = rows.select("conv_id", F.col("r.role").alias("role"), F.col("r.tag").alias("tag"), F.struct("part", "seq", "place").alias("at"))
    first = rows.groupBy(F.col("conv_id").alias("of"), F.col("role").alias("by"), F.col("tag").alias("text"))
    first = first.agg(F.min("at").alias("first"), F.count("*").alias("n")).where("n > 1")
    same = F.col("conv_id").eqNullSafe(F.col("of")) & (F.col("role") == F.col("by")) & (F.col("tag") == F.col("text"))
    again = rows.join(first, same).where("at <> first").select("at.*")
    again = again.groupBy("part", "seq").agg(F.collect_list("place").alias("repeated"))  # at most a piece's rows
    marked = pieces.join(again, ["part", "seq"], "left").select("conv_id", "part", "seq", "rows", "repeated")
    marked.write.parquet(f"{place}/marked")
    marked = spark.read.parquet(f"{place}/marked")

    step_fields, step_schema = _schema(pieces, "part int, seq int, step array<bigint>")

    def steps(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for record in batch.to_pylist():
                rows, faults = _unpacked(record)
                one = {name: record[name] for name in ("conv_id", "part", "seq")}
                yield pa.RecordBatch.from_pylist([{**one, "step": matrix(_codes(rows["role"], faults))}], step_schema)

    def between(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for group in _groups(batches):
            kept = [as_step(r["step"]) for r in group]
            path = crossings(kept, START, best_end(kept))
            last = len(group) - 1
            yield pa.RecordBatch.from_pylist(
                [{"part": r["part"], "seq": r["seq"], "before": path[i], "after": path[i + 1], "last": i == last} for i, r in enumerate(group)],
                BORDER_SCHEMA,
            )

    matrices = marked.mapInArrow(steps, step_fields).repartition("conv_id").sortWithinPartitions("conv_id", "part", "seq")
    borders = matrices.mapInArrow(between, BORDERS)
    borders.write.parquet(f"{place}/borders")
    fields, schema = _schema(pieces, f"part int, seq int, whole boolean, {TOLD}")

    def records(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[dict, int]]:
        for batch in batches:
            for record in batch.to_pylist():
                rows, faults = _unpacked(record)
                words = words_between(_codes(rows["role"], faults), record["before"], record["after"])
                tail = END_WORD[record["after"]] if record["last"] else ""
                one = {"conv_id": record["conv_id"], "part": record["part"], "seq": record["seq"], "whole": False}
                yield {**one, **_repaired(rows, faults, words, record["before"], tail)}, sum(map(len, rows["text"]))

    solved = marked.join(spark.read.parquet(f"{place}/borders"), ["part", "seq"])
    return solved.mapInArrow(lambda batches: _batches(records(batches), schema), fields)


BORDERS = "part int, seq int, before int, after int, last boolean"
BORDER_SCHEMA = pa.schema(
    [("part", pa.int32()), ("seq", pa.int32()), ("before", pa.int32()), ("after", pa.int32()), ("last", pa.bool_())]
)


def _groups(batches: Iterator[pa.RecordBatch]) -> Iterator[list[dict]]:
    """Rows with one conv_id, in sorted batches. For matrices only, one row for a piece."""
    group: list[dict] = []
    for batch in batches:
        for record in batch.to_pylist():
            if group and group[0]["conv_id"] != record["conv_id"]:
                yield group
                group = []
            group.append(record)
    if group:
        yield group


DIGEST = (
    "gaps bigint, blank bigint, duplicate bigint, truncated bigint, illegal bigint, cost bigint, audit string, repaired_sha256 string"
)


def digest(pieces: DataFrame, place: str) -> DataFrame:
    """One row per conversation of what `repair` returned, which is written to `place` first.

    (conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit, repaired_sha256). `gaps` are the turns missing
    between the least and the last, NULLs aside. The hash is that of the repaired messages as `role:text`, joined
    by newlines; the pieces of a long conversation go through it one after the other, as a hash needs them,
    and are not held together.
    """
    spark = pieces.sparkSession
    pieces.write.parquet(f"{place}/repaired")
    pieces = spark.read.parquet(f"{place}/repaired")
    lines = F.transform("messages", lambda m: F.concat(m["role"], F.lit(":"), m["text"]))
    missing = F.col("last_turn").cast("decimal(20,0)") - F.col("least_turn") + 1 - F.col("turns")
    whole = pieces.where("whole").select(
        "conv_id",
        F.when(missing.isNull(), 0).otherwise(F.least(missing, F.lit((1 << 63) - 1)).cast("long")).alias("gaps"),
        *("blank", "duplicate", "truncated", "illegal", "cost", "audit"),
        F.sha2(F.array_join(lines, "\n"), 256).alias("repaired_sha256"),
    )
    fields, schema = _schema(pieces, DIGEST)

    def records(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[dict, int]]:
        now, out, audit = None, None, []
        for batch in batches:
            for r in batch.to_pylist():
                if out is None or r["conv_id"] != now["conv_id"]:
                    if out is not None:
                        yield _closed(now, out, audit)
                    out, audit = dict.fromkeys(("blank", "duplicate", "truncated", "illegal", "cost"), 0), []
                    now = {"conv_id": r["conv_id"], "hash": hashlib.sha256(), "last": None, "lines": 0, "turns": 0, "from": None, "to": None}
                for name in out:
                    out[name] += r[name]
                if now["last"] is not None:
                    out["illegal"] += now["last"] + r["first_initial"] not in LEGAL
                now["last"] = r["last_initial"]
                if r["turns"]:
                    now["turns"] += r["turns"] - (now["to"] == r["least_turn"])
                    now["from"] = r["least_turn"] if now["from"] is None else now["from"]
                    now["to"] = r["last_turn"]
                audit.append(r["audit"])
                for m in r["messages"]:
                    now["hash"].update((("\n" if now["lines"] else "") + m["role"] + ":" + m["text"]).encode())
                    now["lines"] += 1
        if out is not None:
            yield _closed(now, out, audit)

    ordered = pieces.where("NOT whole").repartition("conv_id").sortWithinPartitions("conv_id", "part", "seq")
    return whole.unionByName(ordered.mapInArrow(lambda batches: _batches(records(batches), schema), fields))


def _closed(now: dict, out: dict, audit: list[str]) -> tuple[dict, int]:
    missing = gaps(now["from"], now["to"], now["turns"])
    joined = "".join(audit)
    return {"conv_id": now["conv_id"], "gaps": missing, **out, "audit": joined, "repaired_sha256": now["hash"].hexdigest()}, len(joined)
