"""Conversation repair against a search over all audits and a plain dynamic program."""

from __future__ import annotations

import hashlib
import random
import zlib
from itertools import product

import pytest
from conftest import rows
from llm_cases import TINY, workers_find_the_package  # noqa: F401
from pyspark.sql import functions as F

from palate.llm import conversations, queries

SPACE = " \t\n\x0b\x0c\r"
NEXT = {"": "u", "s": "u", "u": "a", "a": "u"}
NAME = {"u": "user", "a": "assistant"}
SCHEMA = "conv_id long, turn long, role string, text string"


def order(turns: list[tuple]) -> list[tuple]:
    def key(t):
        return hashlib.md5(f"{len(t[1])}:{t[1]}{t[2]}".encode()).digest()

    return sorted(turns, key=lambda t: (t[0] is not None, t[0] or 0, t[1].encode(), key(t)))


def faults(turns: list[tuple]) -> list[str]:
    out, seen = [], set()
    for _, role, text in turns:
        end = text.rstrip(SPACE)
        out.append("blank" if not end else "duplicate" if (role, text) in seen else "truncated" if end[-1] not in ".!?" else "")
        seen.add((role, text))
    return out


def after(state: str, role: str) -> str | None:
    first = role[:1]
    if first == "s":
        return "s" if state == "" else None
    return first if first in "ua" and first == NEXT[state] else None


def best_repair(turns: list[tuple], bad: list[str]) -> tuple:
    """(cost, audit, turns) least in this order, over states by a plain dynamic program."""

    def inserted(table):
        for _ in range(2):
            for state, (cost, audit, made) in list(table.items()):
                to = NEXT[state]
                new = (cost + 5, audit + "I", [*made, (NAME[to], "")])
                table[to] = min(table.get(to, new), new)
        return table

    now = inserted({"": (0, "", [])})
    for (_, role, text), fault in zip(turns, bad, strict=True):
        then = {}
        for state, (cost, audit, made) in now.items():
            extra = 5 if fault == "truncated" else 0
            options = [(state, cost + 2, "D", made)]
            if fault not in ("blank", "duplicate"):
                to = NEXT[state]
                options.append((to, cost + 1 + extra, "R", [*made, (NAME[to], text)]))
                if (to := after(state, role)) is not None:
                    options.append((to, cost + extra, "K", [*made, (role, text)]))
            for to, price, letter, written in options:
                new = (price, audit + letter, written)
                then[to] = min(then.get(to, new), new)
        now = inserted(then)
    return min(now[state] for state in ("", "a") if state in now)


def search(turns: list[tuple], bad: list[str]) -> tuple[int, str]:
    """The least (cost, audit) of all audits with up to two inserts between rows."""
    best = None
    gaps = product(range(3), repeat=len(turns) + 1)
    for inserts in gaps:
        for letters in product("DKR", repeat=len(turns)):
            audit = "I" * inserts[0] + "".join(c + "I" * n for c, n in zip(letters, inserts[1:], strict=True))
            state, cost, row = "", 0, 0
            for c in audit:
                if c == "I":
                    state, cost = NEXT[state], cost + 5
                    continue
                (_, role, _), fault = turns[row], bad[row]
                row += 1
                if c == "D":
                    cost += 2
                    continue
                to = NEXT[state] if c == "R" else after(state, role)
                if to is None or fault in ("blank", "duplicate"):
                    break
                state, cost = to, cost + (c == "R") + (5 if fault == "truncated" else 0)
            else:
                if state in ("", "a") and (best is None or (cost, audit) < best):
                    best = cost, audit
    return best


def report(conv, turns: list[tuple]) -> tuple:
    turns = order(turns)
    bad = faults(turns)
    known = [t[0] for t in turns if t[0] is not None]
    gaps = max(known) - min(known) + 1 - len(set(known)) if known else 0
    pairs = [a[1][:1] + b[1][:1] for a, b in zip(turns, turns[1:], strict=False)]
    cost, audit, made = best_repair(turns, bad)
    text = "\n".join(f"{role}:{text}" for role, text in made)
    illegal = sum(p not in ("su", "ua", "au") for p in pairs)
    return conv, gaps, *(bad.count(f) for f in ("blank", "duplicate", "truncated")), illegal, cost, audit, hashlib.sha256(text.encode()).hexdigest()


def damaged(table: list[tuple]) -> list[tuple]:
    out = []
    for conv, turn, role, text in table:
        kind = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        role, text = " " if role is None else role, " " if text is None else text
        if kind == 0:
            continue
        text = "" if kind == 1 else "".join(c for c in text if c not in ".!?") if kind == 2 else text
        out += [(conv, turn, "user" if kind == 4 else role, text)] * (2 if kind == 3 else 1)
    return out


def by_hand(table: list[tuple]) -> list[tuple]:
    groups = {row[0]: [] for row in table}
    for conv, *turn in damaged(table):
        groups[conv].append(tuple(turn))
    return sorted((report(conv, turns) for conv, turns in groups.items()), key=repr)


def invented(seed: int, sizes: list[int]) -> list[tuple]:
    pick, table = random.Random(seed), []
    texts = ["Yes.", "No!", "so", " ", "", "Why?\n", "a b.", None, "x.", "y", "Ω."]
    roles = ["system", "user", "user", "assistant", "assistant", "tool", None, "", "User"]
    for conv, size in enumerate(sizes):
        for turn in range(size):
            shown = None if pick.random() < 0.05 else turn + (pick.random() < 0.1)
            fair = pick.random() < 0.6
            role = ("user", "assistant")[turn % 2] if fair else pick.choice(roles)
            text = f"{turn}." if fair else pick.choice(texts)
            table.append((conv or None, shown, role, text))
    return table


def run(spark, table: list[tuple], monkeypatch) -> list[tuple]:
    frame = spark.createDataFrame(table, SCHEMA).withColumn("at", F.lit("clash")).withColumn("part", F.lit("clash")).repartition(3)
    monkeypatch.setattr(queries, "_read", lambda *_: frame)
    return rows(queries.op12_path_ranking(spark, ""))


def test_query(spark):
    table = [tuple(r) for r in spark.read.parquet(f"{TINY}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    assert rows(queries.op12_path_ranking(spark, TINY)) == by_hand(table)


def test_the_plain_program_finds_the_least_audit():
    pick = random.Random(5)
    for _ in range(300):
        turns = order([(i, pick.choice(["system", "user", "assistant", "x"]), pick.choice(["a.", "b", "", f"{i}."])) for i in range(pick.randint(0, 4))])
        assert best_repair(turns, faults(turns))[:2] == search(turns, faults(turns))


@pytest.mark.parametrize("bits", [12, 3, 1])
def test_parts_of_all_sizes(spark, monkeypatch, bits):
    """With blocks of 8 and 2 rows most conversations span several blocks, some many."""
    monkeypatch.setattr(conversations, "BLOCK_BITS", bits)
    table = invented(bits, [7, 1, 2, 60, 3, 25, 8, 8, 0, 1, 40, 16])
    assert run(spark, table, monkeypatch) == by_hand(table)


def test_one_conversation_of_many_rows(spark, monkeypatch):
    monkeypatch.setattr(conversations, "BLOCK_BITS", 6)
    table = invented(9, [3, 1500, 2])
    assert run(spark, table, monkeypatch) == by_hand(table)


def test_equal_turns_and_no_rows(spark, monkeypatch):
    table = [(1, 0, "user", "a."), (1, 0, "user", "a."), (1, 0, "assistant", "a."), (1, None, None, None), (None, None, "user", "?"), (2, 5, "assistant", None)]
    assert run(spark, table, monkeypatch) == by_hand(table)
    assert run(spark, [], monkeypatch) == []


def test_repaired_rows(spark):
    turns = [(1, 0, "system", "Be brief."), (1, 1, "user", "Hello."), (1, 2, "user", "Are you there?"), (1, 3, "assistant", "cut"), (1, 4, "assistant", "Yes.")]
    found, repaired = conversations.repair(spark.createDataFrame(turns, SCHEMA))
    assert [r["audit"] for r in found.collect()] == ["KDKDK"]
    got = [(r["role"], r["text"]) for r in repaired.orderBy("ordinal").collect()]
    assert got == [("system", "Be brief."), ("user", "Are you there?"), ("assistant", "Yes.")]
