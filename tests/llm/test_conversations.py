"""Conversation repair against a brute-force version."""

from __future__ import annotations

import hashlib
import random
import zlib
from itertools import groupby, product

import pytest

from pyspark.sql import functions as F

from adtally.llm import conversations as c
from adtally.llm.common import read_table

SF = "/root/testdata/sf0.01"
SCHEMA = "conv_id long, turn long, role string, text string"
COLUMNS = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]


def literal(rows, order=lambda r: ()):
    """{conv_id: COLUMNS} of (conv_id, turn, role, text) by a forward search
    that carries whole audits."""
    by: dict = {}
    for conv, turn, role, text in rows:
        kept = by.setdefault(conv, [])
        key = (" " if conv is None else str(conv)) + ":" + (" " if turn is None else str(turn))
        fault, role, text = zlib.crc32(key.encode()) % 20, " " if role is None else role, " " if text is None else text
        if fault == 0:
            continue
        if fault == 1:
            text = ""
        if fault == 2:
            text = "".join(x for x in text if x not in ".!?")
        if fault == 4:
            role = "user"
        kept += [(turn, role, text)] * (2 if fault == 3 else 1)
    out = {}
    for conv, kept in by.items():
        kept.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1], *order(r)))
        turns = {t for t, _, _ in kept if t is not None}
        gaps = max(turns) - min(turns) + 1 - len(turns) if turns else 0
        counts, seen, rows_in = dict.fromkeys(("blank", "duplicate", "truncated"), 0), set(), []
        for _, role, text in kept:
            bare = text.strip(" \t\n\v\f\r")
            fault = "blank" if not bare else "duplicate" if (role, text) in seen else "truncated" if bare[-1] not in ".!?" else ""
            seen.add((role, text))
            if fault:
                counts[fault] += 1
            rows_in.append((role, text, fault))
        illegal = sum(a[0][:1] + b[0][:1] not in ("su", "ua", "au") for a, b in zip(rows_in, rows_in[1:]))
        add = {"": "u", "s": "u", "u": "a", "a": "u"}  # last initial -> the one that may follow
        best = {"": (0, "", ())}

        def widen(best):
            for _ in range(3):
                for s, (cost, audit, made) in list(best.items()):
                    offer = (cost + 5, audit + "I", made + ((add[s], ""),))
                    best[add[s]] = min(best.get(add[s], offer), offer)
            return best
        best = widen(best)
        for role, text, fault in rows_in:
            after: dict = {}
            for s, (cost, audit, made) in best.items():
                offers = [(s, (cost + 2, audit + "D", made))]
                if fault not in ("blank", "duplicate"):
                    extra = 5 if fault else 0
                    first = role[:1]
                    if first == add[s] or (s == "" and first == "s"):
                        offers.append((first, (cost + extra, audit + "K", made + ((role, text),))))
                    offers.append((add[s], (cost + extra + 1, audit + "R", made + ((add[s], text),))))
                for to, offer in offers:
                    after[to] = min(after.get(to, offer), offer)
            best = widen(after)
        cost, audit, made = min(best[s] for s in ("", "a") if s in best)
        names = {"u": "user", "a": "assistant"}
        text = "\n".join(f"{names.get(r, r)}:{t}" for r, t in made)
        out[conv] = (gaps, counts["blank"], counts["duplicate"], counts["truncated"], illegal, cost, audit, hashlib.sha256(text.encode()).hexdigest())
    return out


def results(df):
    rows = df.collect()
    assert len({r.conv_id for r in rows}) == len(rows)
    return {r.conv_id: tuple(r[x] for x in COLUMNS) for r in rows}


def test_query_equals_the_literal_version(spark):
    rows = [tuple(r) for r in read_table(spark, SF, "conversations").select("conv_id", "turn", "role", "text").collect()]
    got = results(c.op12_conversations(spark, SF))
    assert got == literal(rows)
    assert {x for r in got.values() for x in r[6]} >= set("DKR")


@pytest.mark.parametrize("piece_rows", [3, 4096])
def test_random_conversations(spark, piece_rows):
    """Many short ones and one with a third of all rows; roles are such that
    equal turns are ordered by role."""
    rng = random.Random(7)
    rows = []
    for conv in [*range(40), None] + [99] * 14:
        for _ in range(rng.randint(0, 9)):
            turn = rng.choice([None, 1, 2, 3, 5, 8, rng.randint(0, 400)])
            role = rng.choice(["user", "assistant", "system", "tool", "", None, "user", "assistant"])
            rows.append((conv, turn, role, f"{conv}-{turn}-{role}" + rng.choice([".", "?", "", "  \n"])) if rng.random() < 0.8
                        else (conv, turn, role, rng.choice(["", " \t", None])))
    rows += rng.sample(rows, 25)
    hashed = spark.createDataFrame([(t,) for t in {"" if r[3] is None else r[3] for r in rows} | {" "}], "t string")
    extra = hashed.union(hashed.select(F.translate("t", ".!?", ""))).select("t", F.xxhash64("t").alias("h")).distinct().collect()
    place = {r.t: r.h for r in extra}
    df = spark.createDataFrame([(*r, "x", 1) for r in rows], SCHEMA + ", part string, gone long").repartition(5)
    assert results(c.digest(c.repair(c.damage(df), piece_rows))) == literal(rows, lambda r: (place[r[2]],))


def test_hot_conversation_is_cut_into_pieces(spark):
    rows = [(1, i, "assistant" if i % 3 else "user", f"{i % 50}.") for i in range(3000)] + [(k, i, "user", "a.") for k in range(2, 20) for i in range(3)]
    df = spark.createDataFrame(rows, SCHEMA)
    found = c.repair(c.damage(df), 64)
    pieces = found.where("conv_id = 1").select(F.size("roles")).collect()
    assert len(pieces) > 40
    assert results(c.digest(found)) == literal(rows)


def test_walk_is_the_same_for_any_cut():
    rng = random.Random(3)
    for _ in range(60):
        codes = bytes(rng.choice([0, 1, 2, 3, 1, 2, 5, 9, 10, 11]) for _ in range(rng.randint(0, 40)))
        whole, cost, _ = c.walk(codes, 0, c.END, True)
        at = rng.randint(0, len(codes))
        m = c.matrix(codes[at:])
        behind = tuple(min(m[4 * s + t] + c.END[t] for t in range(4)) for s in range(4))
        first, one, state = c.walk(codes[:at], 0, behind, False)
        second, two, _ = c.walk(codes[at:], state, c.END, True)
        assert (first + second, one + two) == (whole, cost)


def test_ties_take_the_least_audit():
    legal = lambda s: s == "" or (s[0] == "s" and len(s) > 1 and legal(s[1:])) or (len(s) % 2 == 0 and s == "ua" * (len(s) // 2))
    for codes in product([0, 1, 2, 3, 5, 9], repeat=4):
        audit, cost, _ = c.walk(bytes(codes), 0, c.END, True)
        roles, _ = c.repaired(audit, 0, [["s", "user", "assistant", "x"][k & 3] for k in codes], ["t"] * 4)
        assert legal("".join(r[0] for r in roles))
        assert [k for k, _ in groupby(audit)] and cost >= 0


def test_empty_and_dropped(spark):
    df = spark.createDataFrame([], SCHEMA)
    assert c.digest(c.repair(c.damage(df))).count() == 0
    gone = next(i for i in range(1000) if zlib.crc32(f"{i}:0".encode()) % 20 == 0)
    got = results(c.digest(c.repair(c.damage(spark.createDataFrame([(gone, 0, "user", "x.")], SCHEMA)))))
    assert got == {gone: (0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())}
