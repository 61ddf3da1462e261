"""Conversation structure repair: the cheapest edits that make a conversation
alternate, ties decided by the ASCII-least audit.

A conversation is its rows by turn (nulls first; equal turns by role, then by
a hash of the text). Wanted is a sequence of role initials ``(s?(ua)+)?``. Edits:
Keep (0), Rerole to user or assistant (1), Delete (2), Insert an empty user or
assistant turn (5); a truncated row that stays costs 5 more; blank rows and
repeats of an earlier row must go. The automaton has four states, so the cost
to the end is a vector of four numbers at each row.

**Square-root checkpointed DP.** ``walk`` goes backward once and keeps the
vectors of every √n-th row only; then it goes forward block by block,
recomputes the block's vectors from the checkpoint behind it and takes at each
step the ASCII-least edit that is on a cheapest path. Each edit leads to one
state, so taking the least letter each time gives the least audit.

**Long conversations.** Rows are range-partitioned by (conversation, turn, ...),
so a hot conversation lies in many tasks. A task repairs the conversations that
lie in it whole; the others (the first and last of a task, and those beyond
``PIECE_ROWS`` rows) are cut into pieces. A piece is a 4 x 4 matrix of costs
from state to state; a conversation's matrices alone, 16 numbers for up to
4,096 rows, are multiplied from its end, which gives the vector behind each
piece: the checkpoint from which the piece is recomputed. The forward pass
takes the pieces of a conversation in order and one at a time: where a piece
starts depends on the one before, and the digest of a conversation runs over
its whole text in order.

Defined results: null roles and texts are one space (so are null ids and turns
in the damage's checksum); all rows of null conv_id are one conversation;
repeated rows are duplicates from the second on; an empty table gives an empty
result; extra columns are ignored.
"""

from __future__ import annotations

import hashlib
from math import isqrt

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import materialize, read_table, small_batches

PIECE_ROWS = 4096
PIECE_BYTES = 1 << 20
REROLE, DELETE, INSERT, TRUNCATED = 1, 2, 5, 5
FAR = 1 << 50
SPACE = " \t\n\v\f\r"
LEGAL = {"su", "ua", "au"}
# states: 0 nothing yet, 1 after s, 2 after u, 3 after a
NEXT = (2, 2, 3, 2)  # where an added or reroled turn leads
KEEP = {0: {0: 1}, 1: {0: 2, 1: 2, 3: 2}, 2: {2: 3}, 3: {}}  # initial (s, u, a, other) -> from state -> to state
ROLE = {2: "user", 3: "assistant"}
END = (0, 10, 5, 0)  # cost to the end behind the last row
MUST_GO, CUT_OFF = 4, 8  # bits of a row's code besides the number of its initial


def damage(rows: DataFrame) -> DataFrame:
    """The rows after the fixed faults; a dropped row stays as ``gone``, so
    that its conversation is known."""
    one = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    fault = F.crc32(F.concat(one("conv_id"), F.lit(":"), one("turn")).cast("binary")) % 20
    x = rows.select("conv_id", F.col("turn").cast("long").alias("turn"), one("role").alias("role"), one("text").alias("text"),
                    fault.alias("fault"))
    text = F.when(F.col("fault") <= 1, F.lit("")).when(F.col("fault") == 2, F.translate("text", ".!?", "")).otherwise(F.col("text"))
    times = F.explode(F.when(F.col("fault") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0))))
    return (x.select("conv_id", "turn", F.when(F.col("fault") == 4, F.lit("user")).otherwise(F.col("role")).alias("role"),
                     text.alias("text"), (F.col("fault") == 0).alias("gone"), times.alias("copy")).drop("copy"))


def initial(role: str) -> int:
    return {"s": 0, "u": 1, "a": 2}.get(role[:1], 3)


def ending(text: str) -> str:
    """"blank", "truncated" or ""."""
    kept = text.rstrip(SPACE)
    return "blank" if not kept else "" if kept[-1] in ".!?" else "truncated"


def back(code: int, after: tuple) -> tuple:
    """Costs to the end before a row, from those behind it."""
    out = [DELETE + v for v in after]
    if not code & MUST_GO:
        extra = TRUNCATED if code & CUT_OFF else 0
        keep = KEEP[code & 3]
        for s in range(4):
            best = extra + REROLE + after[NEXT[s]]
            if s in keep:
                best = min(best, extra + after[keep[s]])
            if best < out[s]:
                out[s] = best
    u, a = min(out[2], INSERT + out[3]), min(out[3], INSERT + out[2])
    return min(out[0], INSERT + u), min(out[1], INSERT + u), u, a


def walk(codes: bytes, state: int, end: tuple, last: bool) -> tuple[str, int, int]:
    """(audit, cost, state behind) of the cheapest, ASCII-least edits of the
    rows ``codes`` from ``state``; ``end``: costs to the end behind them;
    ``last``: turns may be added behind them too."""
    n = len(codes)
    step = isqrt(n) + 1
    checkpoints, v = {}, end
    for i in range(n - 1, -1, -1):
        if (i + 1) % step == 0:
            checkpoints[i + 1] = v
        v = back(codes[i], v)
    audit, cost = [], 0
    for lo in range(0, n, step):
        hi = min(lo + step, n)
        block = [checkpoints[hi] if hi < n else end]
        for i in range(hi - 1, lo - 1, -1):
            block.append(back(codes[i], block[-1]))
        for i in range(lo, hi):
            code, here, after = codes[i], block[hi - i], block[hi - i - 1]
            extra = TRUNCATED if code & CUT_OFF else 0
            while True:
                now = here[state]
                if now == DELETE + after[state]:
                    audit.append("D")
                    cost += DELETE
                    break
                if now == INSERT + here[NEXT[state]]:
                    audit.append("I")
                    cost, state = cost + INSERT, NEXT[state]
                    continue
                to = KEEP[code & 3].get(state)
                if to is not None and now == extra + after[to]:
                    audit.append("K")
                    cost, state = cost + extra, to
                else:
                    audit.append("R")
                    cost, state = cost + extra + REROLE, NEXT[state]
                break
    while last and state not in (0, 3):
        audit.append("I")
        cost, state = cost + INSERT, NEXT[state]
    return "".join(audit), cost, state


def matrix(codes: bytes) -> list[int]:
    """Costs from each state before the rows to each state behind them."""
    columns = []
    for t in range(4):
        v = tuple(0 if s == t else FAR for s in range(4))
        for code in reversed(codes):
            v = back(code, v)
        columns.append(v)
    return [min(columns[t][s], FAR) for s in range(4) for t in range(4)]


def repaired(audit: str, state: int, roles: list[str], texts: list[str]) -> tuple[list[str], list[str]]:
    """The turns that ``audit`` leaves, starting from ``state``."""
    to_roles, to_texts, i = [], [], 0
    for edit in audit:
        if edit in "RI":
            state = NEXT[state]
            to_roles.append(ROLE[state])
            to_texts.append(texts[i] if edit == "R" else "")
        elif edit == "K":
            state = KEEP[initial(roles[i])][state]
            to_roles.append(roles[i])
            to_texts.append(texts[i])
        i += edit != "I"
    return to_roles, to_texts


STATS = ("n", "blank", "duplicate", "truncated", "illegal", "turns")


def read_rows(turns: list, roles: list[str], texts: list[str], repeated) -> tuple[bytes, dict]:
    """(codes, counts) of rows in order; ``repeated(i)``: seen before."""
    codes, x = bytearray(), dict.fromkeys(STATS, 0) | {"first": None, "last": None, "low": None, "high": None}
    for i, (turn, role, text) in enumerate(zip(turns, roles, texts)):
        fault = ending(text)
        if repeated(i) and fault != "blank":
            fault = "duplicate"
        codes.append(initial(role) | (MUST_GO if fault in ("blank", "duplicate") else CUT_OFF if fault else 0))
        if fault:
            x[fault] += 1
        if i:
            x["illegal"] += roles[i - 1][:1] + role[:1] not in LEGAL
        if turn is not None:
            x["turns"] += turn != x["high"]
            x["low"], x["high"] = turn if x["low"] is None else x["low"], turn
    x["n"] = len(codes)
    if roles:
        x["first"], x["last"] = roles[0][:1], roles[-1][:1]
    return bytes(codes), x


def seen_before(roles: list[str], texts: list[str]):
    held: set = set()

    def ask(i: int) -> bool:
        row = roles[i], texts[i]
        return row in held or held.add(row) is not None
    return ask


STATS_SCHEMA = ", ".join(f"{s} long" for s in STATS) + ", first string, last string, low long, high long"
STATS_NAMES = [f.split()[0] for f in STATS_SCHEMA.split(", ")]
PLACE = ["part", "place"]


def _frame(rows: list[dict], schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_pylist(rows, schema=schema)


def _arrow(schema: str, ids) -> pa.Schema:
    kinds = {"long": pa.int64(), "string": pa.string(), "boolean": pa.bool_(), "binary": pa.binary(), "array<string>": pa.list_(pa.string()),
             "array<long>": pa.list_(pa.int64())}
    return pa.schema([("conv_id", ids), *[(f.split()[0], kinds[f.split()[1]]) for f in schema.split(", ")]])


def cut(rows: DataFrame, piece_rows: int = PIECE_ROWS) -> DataFrame:
    """Damaged rows in order: conversations that lie whole in a task, repaired,
    and pieces of the others with their rows as they are."""
    ids = rows.schema["conv_id"].dataType.simpleString()
    fields = (f"part long, place long, whole boolean, audit string, cost long, roles array<string>, texts array<string>, "
              f"turn_of array<long>, {STATS_SCHEMA}")

    def run(batches):
        schema, held, place, ready, part = None, {"turn": [], "role": [], "text": []}, 0, [], 0
        conv, nothing, whole, size = None, True, False, 0

        def flush(ended: bool) -> dict:
            nonlocal place, held, size, whole
            row = {"conv_id": conv, "part": part, "place": place, "whole": whole and ended}
            if row["whole"]:
                codes, stats = read_rows(held["turn"], held["role"], held["text"], seen_before(held["role"], held["text"]))
                audit, cost, _ = walk(codes, 0, END, True)
                roles, texts = repaired(audit, 0, held["role"], held["text"])
                row |= stats | {"audit": audit, "cost": cost, "roles": roles, "texts": texts}
            else:
                row |= {"roles": held["role"], "texts": held["text"], "turn_of": held["turn"]}
            place, size, held = place + 1, 0, {"turn": [], "role": [], "text": []}
            whole = whole and ended
            return row

        for batch in batches:
            schema = schema or _arrow(fields, batch.schema.field("conv_id").type)
            columns = [batch.column(batch.schema.get_field_index(c)).to_pylist() for c in ("conv_id", "turn", "role", "text", "gone", "part")]
            for c, turn, role, text, gone, part in zip(*columns):
                if nothing:
                    conv, nothing = c, False
                elif c != conv:
                    ready.append(flush(True))  # not whole if it is the task's first
                    conv, whole = c, True
                elif len(held["role"]) >= piece_rows or size >= PIECE_BYTES:
                    ready.append(flush(False))
                if not gone:
                    held["turn"].append(turn)
                    held["role"].append(role)
                    held["text"].append(text)
                    size += len(text)
            if ready:
                yield _frame(ready, schema)
                ready = []
        if not nothing:
            whole = False  # the task's last conversation may go on in the next task
            yield _frame([flush(True)], schema)

    order = ["conv_id", "turn", "role", "h"]
    x = rows.withColumn("h", F.xxhash64("text")).repartitionByRange(*order).sortWithinPartitions(*order, "text")
    x = x.select("conv_id", "turn", "role", "text", "gone", F.spark_partition_id().cast("long").alias("part"))
    return x.mapInArrow(run, f"conv_id {ids}, {fields}")


def piece_codes(pieces: DataFrame) -> DataFrame:
    """Per piece its codes, counts and matrix. Repeats are found over all of a
    conversation's pieces by the digests of their rows."""
    ids = pieces.schema["conv_id"].dataType.simpleString()
    each = pieces.select("conv_id", *PLACE, F.posexplode(F.arrays_zip("roles", "texts")).alias("i", "row"))
    each = each.select("conv_id", *PLACE, "i", F.sha2(F.concat_ws(":", F.length("row.roles").cast("string"), "row.roles", "row.texts"), 256).alias("row"))
    again = Window.partitionBy("conv_id", "row").orderBy(*PLACE, "i")
    repeats = (each.withColumn("k", F.row_number().over(again)).where(F.col("k") > 1)
               .groupBy(*PLACE).agg(F.collect_list(F.col("i").cast("long")).alias("repeats")))
    fields = f"part long, place long, codes binary, {STATS_SCHEMA}, costs array<long>"

    def run(batches):
        for batch in batches:
            schema, out = _arrow(fields, batch.schema.field("conv_id").type), []
            for r in batch.to_pylist():
                codes, stats = read_rows(r["turn_of"], r["roles"], r["texts"], set(r["repeats"] or ()).__contains__)
                out.append({"conv_id": r["conv_id"], "part": r["part"], "place": r["place"], "codes": codes, "costs": matrix(codes)} | stats)
            yield _frame(out, schema)

    return (pieces.select("conv_id", *PLACE, "roles", "texts", "turn_of").join(repeats, PLACE, "left")
            .mapInArrow(run, f"conv_id {ids}, {fields}"))


def ends(coded: DataFrame) -> DataFrame:
    """Per piece the costs to the end behind it: a conversation's matrices (16
    numbers a piece, no rows) multiplied from its last piece."""
    def chain(group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values(PLACE, ascending=False)
        v, found = np.array(END, np.int64), []
        for costs in group["costs"]:
            found.append(v.tolist())
            v = (np.asarray(costs, np.int64).reshape(4, 4) + v).min(axis=1)
        return pd.DataFrame({"part": group["part"], "place": group["place"], "behind": found,
                             "final": [True] + [False] * (len(found) - 1)})

    return coded.select("conv_id", *PLACE, "costs").groupBy("conv_id").applyInPandas(chain, "part long, place long, behind array<long>, final boolean")


def walk_pieces(pieces: DataFrame, coded: DataFrame) -> DataFrame:
    """The pieces repaired, each conversation's in order and one at a time."""
    ids = pieces.schema["conv_id"].dataType.simpleString()
    fields = f"part long, place long, whole boolean, audit string, cost long, roles array<string>, texts array<string>, {STATS_SCHEMA}"
    x = (pieces.select("conv_id", *PLACE, "roles", "texts").join(coded.drop("costs", "conv_id"), PLACE).join(ends(coded), PLACE)
         .repartition("conv_id").sortWithinPartitions("conv_id", *PLACE))

    def run(batches):
        conv, state = object(), 0
        for batch in batches:
            schema, out = _arrow(fields, batch.schema.field("conv_id").type), []
            for r in batch.to_pylist():
                if r["conv_id"] != conv:
                    conv, state = r["conv_id"], 0
                audit, cost, to = walk(r["codes"], state, tuple(r["behind"]), r["final"])
                roles, texts = repaired(audit, state, r["roles"], r["texts"])
                state = to
                out.append({c: r[c] for c in ("conv_id", *PLACE, *STATS_NAMES)} | {"whole": False, "audit": audit, "cost": cost, "roles": roles, "texts": texts})
            yield _frame(out, schema)

    return x.mapInArrow(run, f"conv_id {ids}, {fields}")


def repair(rows: DataFrame, piece_rows: int = PIECE_ROWS) -> DataFrame:
    """Damaged ``rows`` repaired: a row per conversation, or per piece of it
    in the order (part, place), with the repaired roles and texts, the audit,
    its cost and the counts of faults."""
    small_batches(rows.sparkSession)
    found = materialize(cut(rows, piece_rows), "conversations")
    pieces = found.where(~F.col("whole"))
    coded = materialize(piece_codes(pieces), "conversation-pieces")
    return found.where("whole").drop("turn_of").unionByName(walk_pieces(pieces, coded))


RESULT = "gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string, repaired_sha256 string"


def digest(rows: DataFrame) -> DataFrame:
    """One row per conversation from its repaired pieces. Whole conversations
    are digested where they lie, the others after a shuffle of their pieces."""
    ids = rows.schema["conv_id"].dataType.simpleString()

    def run(batches):
        conv, x, schema = object(), None, None

        def done() -> dict:
            low, high = x["low"], x["high"]
            return {"conv_id": conv, "gaps": 0 if low is None else high - low + 1 - x["turns"], "audit": "".join(x["audit"]),
                    "repaired_sha256": x["sha"].hexdigest()} | {c: x[c] for c in ("blank", "duplicate", "truncated", "illegal", "cost")}

        for batch in batches:
            schema, out = _arrow(RESULT, batch.schema.field("conv_id").type), []
            for r in batch.to_pylist():
                if x is None or r["whole"] or r["conv_id"] != conv:
                    if x is not None:
                        out.append(done())
                    conv = r["conv_id"]
                    x = {"low": None, "high": None, "last": None, "audit": [], "sha": hashlib.sha256(), "any": False, "cost": 0} | dict.fromkeys(STATS, 0)
                for c in (*STATS, "cost"):
                    x[c] += r[c]
                if r["n"]:
                    if x["last"] is not None:
                        x["illegal"] += x["last"] + r["first"] not in LEGAL
                    x["last"] = r["last"]
                if r["low"] is not None:
                    x["turns"] -= r["low"] == x["high"]
                    x["low"], x["high"] = r["low"] if x["low"] is None else x["low"], r["high"]
                x["audit"].append(r["audit"])
                for role, text in zip(r["roles"], r["texts"]):
                    x["sha"].update((f"\n{role}:{text}" if x["any"] else f"{role}:{text}").encode())
                    x["any"] = True
            yield _frame(out, schema)
        if x is not None:
            yield _frame([done()], schema)

    schema = f"conv_id {ids}, {RESULT}"
    pieces = rows.where(~F.col("whole")).repartition("conv_id").sortWithinPartitions("conv_id", *PLACE)
    return rows.where("whole").mapInArrow(run, schema).unionByName(pieces.mapInArrow(run, schema))


def op12_conversations(spark, sf_dir: str) -> DataFrame:
    return digest(repair(damage(read_table(spark, sf_dir, "conversations"))))
