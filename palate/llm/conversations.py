"""Repair of the structure of conversations by cheapest edits.

A conversation should read `(system? (user assistant)+)?`. Rows are kept, given another role or deleted, and empty
turns inserted, each at a price; of the cheapest audits (a letter per edit) the least in ASCII order is taken.

Rows are sorted into ranges and cut into blocks of BLOCK rows, so a conversation of any length spreads over
tasks. A block costs its part of a conversation from every state to every state. Parts of one conversation are
put together by doubling: after k rounds a part knows the costs of the next 2^k. Inside a block, the nodes (row,
state) on optimal arcs are ranked by the next 1, 2, 4, ... letters of their least audit; ranks choose the arcs,
and the doubled pointers name the nodes on the path.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator
from math import ceil, log2

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from palate.llm.common import group_places, in_order, stage

#: Rows of a block, as a power of two.
BLOCK_BITS = 12
#: The states: nothing written yet, behind a system, a user, an assistant turn. The next turn's state in each.
START, SYSTEM, USER, ASSISTANT = range(4)
NEXT = np.array([USER, USER, ASSISTANT, USER])
OTHER = 0
#: Faults of a row, and prices of edits.
BLANK, DUPLICATE, TRUNCATED = 1, 2, 3
DELETE_COST, INSERT_COST, REROLE_COST, TRUNCATED_COST = 2, 5, 1, 5
#: What it costs to end in each state: a user turn lacks its answer, a system turn the whole pair.
END = np.array([0, 2 * INSERT_COST, INSERT_COST, 0])
NEVER = 1 << 40
LETTERS = np.frombuffer(b"\0DIKR", np.uint8)
SPACE = " \t\n\x0b\x0c\r"
EDIT = "struct<turn:bigint,role:string,key:binary,kind:int,ordinal:int,made:string>"


def damage(conversations: DataFrame) -> DataFrame:
    """(conv_id, turn, role, text) with faults put in, by the CRC-32 of `conv_id:turn` modulo 20: 0 drops a row,
    1 empties its text, 2 removes its full stops, 3 repeats it, 4 makes it a user's. Nulls count as one space
    in that key, in roles and in texts; ids and turns stay null."""

    def shown(name: str) -> Column:
        return F.coalesce(F.col(name).cast("string"), F.lit(" "))

    kind = F.crc32(F.concat(shown("conv_id"), F.lit(":"), shown("turn")).cast("binary")) % 20
    text = F.when(kind == 1, "").when(kind == 2, F.regexp_replace(shown("text"), "[.!?]", "")).otherwise(shown("text"))
    role = F.when(kind == 4, "user").otherwise(shown("role"))
    copies = F.when(kind == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    rows = conversations.filter(kind != 0).select("conv_id", F.col("turn").cast("long").alias("turn"), role.alias("role"), text.alias("text"), F.explode(copies))
    return rows.drop("col")


def _keyed(rows: DataFrame) -> DataFrame:
    """rows without nulls in role and text, and a key of the two."""
    role, text = (F.coalesce(F.col(name), F.lit(" ")) for name in ("role", "text"))
    key = F.unhex(F.md5(F.concat(F.length(role).cast("string"), F.lit(":"), role, text).cast("binary")))
    return rows.select("conv_id", "turn", role.alias("role"), text.alias("text"), key.alias("key"))


def with_faults(rows: DataFrame) -> DataFrame:
    """The rows without their texts, in order and staged: conv_id, turn, role, key, at, initial, fault.

    A conversation's rows are ordered by turn (null first), then by role and key. A row's first fault counts:
    blank (nothing but white space), duplicate (its role and text came before), truncated (its last other
    character is no full stop). First rows are found by a grouped minimum; only keys that come twice are joined."""
    end = F.rtrim(F.col("text"), F.lit(SPACE))
    initial = F.substring("role", 1, 1)
    code = F.when(initial == "s", SYSTEM).when(initial == "u", USER).when(initial == "a", ASSISTANT).otherwise(OTHER)
    own = F.when(end == "", BLANK).when(~F.right(end, F.lit(1)).isin(".", "!", "?"), TRUNCATED).otherwise(0)
    slim = _keyed(rows).select("conv_id", "turn", "role", "key", code.alias("initial"), own.alias("own"))
    order = [F.asc_nulls_first("turn"), F.asc("role"), F.asc("key"), F.asc("tie")]
    placed = in_order(slim.withColumn("tie", F.monotonically_increasing_id()), "conv_id", order, "turns").drop("tie")
    groups = placed.groupBy(F.col("conv_id").alias("_conv"), F.col("key").alias("_key")).agg(F.min("at").alias("_first"), F.count("*").alias("_rows"))
    again = groups.filter("_rows > 1")
    met = placed.join(again, F.col("conv_id").eqNullSafe(F.col("_conv")) & (F.col("key") == F.col("_key")), "left")
    fault = F.when(F.col("own") == BLANK, BLANK).when(F.col("at") > F.col("_first"), DUPLICATE).otherwise(F.col("own"))
    return stage(met.select("conv_id", "turn", "role", "key", "at", "initial", fault.alias("fault")), "faults")


class Parts:
    """Parts of conversations, one after another in the same arrays: `starts` are their first rows."""

    def __init__(self, starts: np.ndarray, initial: np.ndarray, fault: np.ndarray) -> None:
        self.starts, self.n = starts, len(initial)
        self.sizes = np.diff(np.append(starts, self.n))
        self.owner = np.repeat(np.arange(len(starts)), self.sizes)
        usable = (fault != BLANK) & (fault != DUPLICATE)
        extra = np.where(fault == TRUNCATED, TRUNCATED_COST, 0)
        never = np.full((self.n, 4), NEVER)
        self.delete = np.full((self.n, 4), DELETE_COST)
        self.rerole = np.where(usable[:, None], REROLE_COST + extra[:, None], never)
        fits = (initial[:, None] == NEXT) | ((initial[:, None] == SYSTEM) & (np.arange(4) == START))
        self.keep = np.where(usable[:, None] & fits, extra[:, None], never)
        self.kept_as = np.where((initial[:, None] == SYSTEM) & (np.arange(4) == START), SYSTEM, NEXT)

    def costs(self) -> np.ndarray:
        """[row, state, state behind the part]: the least cost from before a row (turns may be inserted there) to
        the end of its part."""
        out = np.empty((self.n, 4, 4), np.int64)
        after = np.broadcast_to(np.where(np.eye(4, dtype=bool), 0, NEVER), (len(self.starts), 4, 4)).copy()
        for back in range(1, int(self.sizes.max(initial=0)) + 1):
            live = np.flatnonzero(self.sizes >= back)
            row, then = self.starts[live] + self.sizes[live] - back, after[live]
            kept = np.take_along_axis(then, self.kept_as[row][:, :, None], 1)
            now = np.minimum(self.delete[row][:, :, None] + then, self.rerole[row][:, :, None] + then[:, NEXT])
            now = np.minimum(now, self.keep[row][:, :, None] + kept)
            user, assistant = now[:, USER], now[:, ASSISTANT]
            now[:, USER], now[:, ASSISTANT] = np.minimum(user, INSERT_COST + assistant), np.minimum(assistant, INSERT_COST + user)
            now[:, :USER] = np.minimum(now[:, :USER], INSERT_COST + now[:, USER : USER + 1])
            out[row] = after[live] = np.minimum(now, NEVER)
        return out

    def least_paths(self, costs: np.ndarray, tail: np.ndarray, last: np.ndarray, entry: np.ndarray) -> tuple[np.ndarray, ...]:
        """The least of the cheapest audits of each part from its state `entry`, given what each state behind it costs
        (`tail`) and whether the conversation ends there (`last`): (ends of the parts' edits, letter, row, state
        behind the edit, state behind the part).

        Nodes are (row or end of part, state). A letter leads from a state to one state only, so a node's least
        audit of 2L letters is its least one of L letters and that of the node it leads to."""
        parts = len(self.starts)
        layer = np.arange(self.n) + self.owner  # each part has one more layer, its end
        ends = self.starts + np.arange(parts) + self.sizes
        layers = self.n + parts
        best = np.empty((layers, 4), np.int64)
        best[layer] = (costs + tail[self.owner][:, None, :]).min(2)
        best[ends] = tail
        node, sink = 4 * np.arange(layers)[:, None] + np.arange(4), 4 * layers
        flat = np.append(best.ravel(), 0)
        is_row = np.zeros(layers, bool)
        is_row[layer] = True
        may_insert = is_row.copy()
        may_insert[ends] = last

        def arcs(cost: np.ndarray, to: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
            price, target = np.full((layers, 4), NEVER), np.full((layers, 4), sink)
            price[layer], target[layer] = cost, to
            return price, target

        below = node[layer] + 4  # the same state at the next layer
        to_next = below - np.arange(4) + NEXT
        insert = np.where(may_insert[:, None], INSERT_COST, NEVER), np.where(may_insert[:, None], node - np.arange(4) + NEXT, sink)
        choices = [arcs(self.delete, below), insert, arcs(self.keep, below - np.arange(4) + self.kept_as), arcs(self.rerole, to_next)]
        known = best < NEVER
        optimal = [known & (price < NEVER) & (price + flat[to] == best) for price, to in choices]

        def pick(rank: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
            """The optimal arc of the least letter, then of the target of least rank; none at an end."""
            letter, pointer = np.zeros(sink + 1, np.int64), np.full(sink + 1, sink)
            least = np.full((layers, 4), np.iinfo(np.int64).max)
            for number, (able, (_, to)) in enumerate(zip(optimal, choices, strict=True), 1):  # in ASCII order
                score = np.where(able, number * (sink + 1) + rank[to], least)
                better = able & (score < least)
                least[better] = score[better]
                letter[:-1].reshape(layers, 4)[better] = number
                pointer[:-1].reshape(layers, 4)[better] = to[better]
            return letter, pointer

        letter, pointer = pick(np.zeros(sink + 1, np.int64))
        rank = letter
        while (pointer != sink).any():
            rank = np.unique(rank * (int(rank.max()) + 1) + rank[pointer], return_inverse=True)[1]
            pointer = pointer[pointer]
        letter, pointer = pick(rank)
        length, doubled = (letter > 0).astype(np.int64), [pointer]
        while (doubled[-1] != sink).any():
            length = length + length[doubled[-1]]
            doubled.append(doubled[-1][doubled[-1]])
        on = np.zeros(sink + 1, bool)
        on[4 * (self.starts + np.arange(parts)) + entry] = True
        for step in reversed(doubled):
            on[step[on]] = True
        on[sink] = False
        on = np.flatnonzero(on)
        part = np.searchsorted(ends, on // 4)
        on = on[np.lexsort((-length[on], part))]
        part = np.searchsorted(ends, on // 4)
        out = np.full(parts, -1)
        stop = letter[on] == 0
        out[part[stop]] = on[stop] % 4
        moves, part = on[~stop], part[~stop]
        target = doubled[0][moves]
        return np.searchsorted(part, np.arange(parts), "right"), letter[moves], moves // 4 - part, target % 4, out


def _edits(parts: Parts, found: tuple[np.ndarray, ...], table: pa.Table) -> pa.Array:
    """Lists of the edits that write a turn: the row they stand at (kind 1: keeps or reroles it, 0: inserted before it,
    2: inserted behind it), their place among edits, and what role is made (null: its own)."""
    ends, letter, row, state, _ = found
    owner = np.repeat(np.arange(len(ends)), np.diff(np.append(0, ends)))
    trailing = row == parts.starts[owner] + parts.sizes[owner]
    at = row - trailing
    kind = np.where(letter != 2, 1, np.where(trailing, 2, 0))
    wanted = letter != 1
    made = np.where(letter == 3, None, np.where(state == USER, "user", "assistant"))[wanted]
    rows = table.select(["turn", "role", "key"]).take(pa.array(at[wanted]))
    columns = [c.combine_chunks() for c in rows.columns]
    columns += [pa.array(kind[wanted], pa.int32()), pa.array(np.flatnonzero(wanted).astype(np.int32)), pa.array(made, pa.string())]
    values = pa.StructArray.from_arrays(columns, ["turn", "role", "key", "kind", "ordinal", "made"])
    kept = np.concatenate([[0], np.cumsum(wanted)])[np.concatenate([[0], ends])]
    return pa.ListArray.from_arrays(pa.array(kept.astype(np.int32)), values)


def _audits(found: tuple[np.ndarray, ...]) -> pa.Array:
    text, ends = LETTERS[found[1]].tobytes().decode(), [0, *found[0].tolist()]
    return pa.array([text[a:b] for a, b in zip(ends, ends[1:], strict=False)], pa.string())


def _cut(table: pa.Table) -> tuple[pa.Table, Parts]:
    table = table.sort_by("at").combine_chunks()
    codes = np.asarray(table["conv_id"].combine_chunks().dictionary_encode().indices.fill_null(-1))
    starts = np.flatnonzero(np.append(True, codes[1:] != codes[:-1]))
    return table, Parts(starts, table["initial"].to_numpy(), table["fault"].to_numpy())


def _solve_whole(table: pa.Table) -> pa.Table:
    """A block's parts: their faults, costs between states, and the audit if the part is a whole conversation."""
    table, parts = _cut(table)
    costs, n = parts.costs(), len(parts.starts)
    found = parts.least_paths(costs, np.broadcast_to(END, (n, 4)), np.ones(n, bool), np.zeros(n, np.int64))
    initial, fault = table["initial"].to_numpy(), table["fault"].to_numpy()
    same = parts.owner[1:] == parts.owner[:-1]
    wrong = same & (_illegal(initial[:-1], initial[1:]))
    first, final = costs[parts.starts], parts.starts + parts.sizes - 1

    def count(what: np.ndarray) -> np.ndarray:
        return np.bincount(parts.owner[what], minlength=n)

    columns = {
        "conv_id": table["conv_id"].take(pa.array(parts.starts)),
        "first_at": table["at"].take(pa.array(parts.starts)),
        "blank": count(fault == BLANK), "duplicate": count(fault == DUPLICATE), "truncated": count(fault == TRUNCATED),
        "illegal": np.bincount(parts.owner[1:][wrong], minlength=n),
        "first_initial": initial[parts.starts], "last_initial": initial[final],
        "costs": pa.ListArray.from_arrays(pa.array(np.arange(0, 16 * n + 1, 16, dtype=np.int32)), pa.array(first.reshape(-1))),
        "cost": (first[:, START] + END).min(1),
        "audit": _audits(found), "edits": _edits(parts, found, table),
    }
    return pa.table({k: v if isinstance(v, (pa.Array, pa.ChunkedArray)) else pa.array(v.astype(np.int64)) for k, v in columns.items()})


def _illegal(before: np.ndarray, after: np.ndarray) -> np.ndarray:
    """Neighbours other than system-user, user-assistant and assistant-user."""
    return ~(((before == SYSTEM) & (after == USER)) | ((before == USER) & (after == ASSISTANT)) | ((before == ASSISTANT) & (after == USER)))


def _solve_part(table: pa.Table) -> pa.Table:
    """Parts of longer conversations: from each state the audit, its edits and the state behind."""
    table, parts = _cut(table)
    costs, n = parts.costs(), len(parts.starts)
    tail = np.stack(table["tail"].take(pa.array(parts.starts)).to_pylist())
    last = table["last"].take(pa.array(parts.starts)).to_numpy()
    out = []
    for entry in range(4):
        found = parts.least_paths(costs, tail, last, np.full(n, entry))
        named = [table[c].take(pa.array(parts.starts)) for c in ("conv_id", "part")]
        out.append(pa.table([*named, pa.array(np.full(n, entry, np.int32)), pa.array(found[-1].astype(np.int32)), _audits(found), _edits(parts, found, table)], ["conv_id", "part", "entry", "leaves", "audit", "edits"]))
    return pa.concat_tables(out)


def _behind(a: Column, b: Column) -> Column:
    """The 4 x 4 costs of one part and then another, as arrays of 16."""

    def through(i: Column) -> Column:
        ways = F.transform(F.sequence(F.lit(0), F.lit(3)), lambda k: F.get(a, i - i % 4 + k) + F.get(b, k * 4 + i % 4))
        return F.least(F.array_min(ways), F.lit(NEVER).cast("long"))

    return F.transform(F.sequence(F.lit(0), F.lit(15)), through)


def _double(parts: DataFrame, value: str, rounds: int, step: int, put: Callable[[Column, Column], Column], label: str) -> DataFrame:
    """parts (base, part, value, ...) with value combined over all parts from each on (step 1) or up to it (-1)."""
    for k in range(rounds):
        other = parts.select("base", (F.col("part") - step * (1 << k)).alias("part"), F.col(value).alias("other"))
        joined = parts.join(other, ["base", "part"], "left")
        both = F.when(F.col("other").isNull(), F.col(value)).otherwise(put(F.col(value), F.col("other")))
        parts = stage(joined.withColumn(value, both).drop("other"), f"{label}-{k}")
    return parts


def _across_blocks(rows: DataFrame, long: DataFrame, most: int) -> tuple[DataFrame, DataFrame]:
    """Conversations of several parts, long (their parts, with place and number): (conv_id, cost, more illegal
    neighbours) of each, and the (conv_id, first_at, audit, edits) of each part."""
    rounds = ceil(log2(most))
    parts = _double(long.withColumn("total", F.col("costs")), "total", rounds, 1, _behind, "suffix")
    end = F.array(*(F.lit(int(x)).cast("long") for x in END))

    def finished(total: Column) -> Column:
        return F.transform(F.sequence(F.lit(0), F.lit(3)), lambda s: F.array_min(F.transform(F.sequence(F.lit(0), F.lit(3)), lambda t: F.get(total, s * 4 + t) + F.get(end, t))))

    following = parts.select("base", (F.col("part") - 1).alias("part"), finished(F.col("total")).alias("tail"), F.col("first_initial").alias("_next"), F.col("first_at").alias("_stop"))
    parts = parts.join(following, ["base", "part"], "left")
    last = F.col("tail").isNull()
    pair = F.concat(F.col("last_initial").cast("string"), F.col("_next").cast("string"))
    legal = pair.isin(f"{SYSTEM}{USER}", f"{USER}{ASSISTANT}", f"{ASSISTANT}{USER}")
    parts = stage(parts.withColumn("last", last).withColumn("tail", F.coalesce("tail", end)).withColumn("more", F.when(F.col("last") | legal, 0).otherwise(1)), "parts")
    whole = parts.filter("part = 0").select("base", "conv_id", F.get(finished(F.col("total")), F.lit(START)).alias("cost"))
    more = parts.groupBy("base").agg(F.sum("more").alias("more"))

    block = F.shiftright("at", BLOCK_BITS)
    named = parts.select(F.shiftright("first_at", BLOCK_BITS).alias("_block"), F.col("conv_id").alias("_conv"), "part", "tail", "last")
    own = rows.join(named, (block == F.col("_block")) & F.col("conv_id").eqNullSafe(F.col("_conv")))
    kind = dict(rows.dtypes)["conv_id"]
    solved = own.select("conv_id", "turn", "role", "key", "at", "initial", "fault", "part", "tail", "last", "_block").groupBy("_block").applyInArrow(
        _solve_part, f"conv_id {kind}, part long, entry int, leaves int, audit string, edits array<{EDIT}>"
    )
    solved = stage(solved, "part-audits")
    maps = solved.groupBy("conv_id", "part").agg(F.transform(F.sort_array(F.collect_list(F.struct("entry", "leaves"))), lambda x: x["leaves"]).alias("leads"))
    keyed = parts.select("base", "part", F.col("conv_id").alias("_conv"), "first_at")
    mapped = keyed.join(maps.withColumnRenamed("part", "_part"), (F.col("part") == F.col("_part")) & F.col("_conv").eqNullSafe(F.col("conv_id")))
    mapped = mapped.select("base", "part", "conv_id", "first_at", "leads")

    def then(now: Column, before: Column) -> Column:
        return F.transform(before, lambda s: F.when(s < 0, F.lit(-1)).otherwise(F.get(now, s)))

    reached = _double(mapped, "leads", rounds, -1, then, "prefix")
    entered = reached.select("base", (F.col("part") + 1).alias("part"), F.get("leads", F.lit(START)).alias("_entry"))
    entries = reached.select("base", "part", F.col("conv_id").alias("_conv"), "first_at").join(entered, ["base", "part"], "left")
    entries = entries.select("_conv", F.col("part").alias("_part"), "first_at", F.coalesce("_entry", F.lit(START)).alias("_entry"))
    chosen = solved.join(entries, F.col("conv_id").eqNullSafe(F.col("_conv")) & (F.col("part") == F.col("_part")) & (F.col("entry") == F.col("_entry")))
    return whole.join(more, "base").select("conv_id", "cost", "more"), chosen.select("conv_id", "first_at", "audit", "edits")


def repair(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The report and the repaired conversations of rows (conv_id, turn, role, text).

    Report, a row per conversation: conv_id, gaps (turns that are missing between the first and the last), blank,
    duplicate, truncated, illegal (neighbours whose roles do not follow each other), cost and audit of the cheapest
    edits (K keep, R rerole, D delete, I insert an empty turn). Repaired: conv_id, ordinal, role, text, each
    conversation in order within one partition.

    A null conv_id is a conversation, null turns come first and are no gap, null roles and texts count as one space.
    Rows of one turn are ordered by role, then by a checksum of the text; equal rows count each. Roles go by their
    first letter; any but s, u and a can not be kept. An empty table gives no rows; other columns are ignored."""
    kind = dict(rows.dtypes)["conv_id"]
    faults = with_faults(rows)
    schema = f"conv_id {kind}, first_at long, blank long, duplicate long, truncated long, illegal long, first_initial long, last_initial long, costs array<bigint>, cost long, audit string, edits array<{EDIT}>"
    blocks = faults.withColumn("block", F.shiftright("at", BLOCK_BITS)).groupBy("block")
    pieces = stage(blocks.applyInArrow(_solve_whole, schema), "pieces")
    counts = pieces.groupBy("conv_id").agg(F.count("*").alias("parts"), *(F.sum(c).alias(c) for c in ("blank", "duplicate", "truncated", "illegal")), F.max("cost").alias("cost"))
    split = counts.filter("parts > 1").select(F.col("conv_id").alias("_conv"), "parts")
    most = split.agg(F.max("parts")).first()[0]
    if most:
        many = split.select("_conv")
        same = F.col("conv_id").eqNullSafe(F.col("_conv"))
        ordered = in_order(pieces.join(many, same, "left_semi").drop("audit", "edits"), "conv_id", [F.asc("first_at")], "parts-order")
        long = stage(group_places(ordered, "conv_id").withColumnRenamed("place", "part").drop("at", "cost"), "long")
        whole, audits = _across_blocks(faults, long, most)
        whole = whole.select(F.col("conv_id").alias("_conv"), F.col("cost").alias("_cost"), "more")
        counts = counts.join(whole, same, "left").withColumn("cost", F.coalesce("_cost", "cost")).withColumn("illegal", F.col("illegal") + F.coalesce("more", F.lit(0)))
        counts = counts.drop("_conv", "_cost", "more")
        audits = stage(pieces.join(many, same, "left_anti").select("conv_id", "first_at", "audit", "edits").unionByName(audits), "audits")
    else:
        audits = pieces.select("conv_id", "first_at", "audit", "edits")

    turns = faults.groupBy("conv_id").agg((F.max("turn") - F.min("turn") + 1 - F.count_distinct("turn")).alias("gaps"))
    written = audits.groupBy("conv_id").agg(F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("first_at", "audit"))), lambda x: x["audit"]), "").alias("audit"))
    report = counts.drop("parts")
    for more in (turns, written):
        more = more.withColumnRenamed("conv_id", "_conv")
        report = report.join(more, F.col("conv_id").eqNullSafe(F.col("_conv"))).drop("_conv")
    report = report.select("conv_id", F.coalesce("gaps", F.lit(0)).cast("long").alias("gaps"), "blank", "duplicate", "truncated", "illegal", "cost", "audit")
    return report, _repaired(rows, audits, kind)


def _repaired(rows: DataFrame, audits: DataFrame, kind: str) -> DataFrame:
    """Texts and edits meet by conversation, sorted by the rows' order; the merge holds a row at a time."""
    edits = audits.select("conv_id", "first_at", F.explode("edits").alias("e")).select("conv_id", "e.turn", "e.role", "e.key", "e.kind", "first_at", "e.ordinal", "e.made", F.lit(None).cast("string").alias("text"))
    texts = _keyed(rows).select("conv_id", "turn", "role", "key", F.lit(1).alias("kind"), F.lit(None).cast("long").alias("first_at"), F.lit(None).cast("int").alias("ordinal"), F.lit(None).cast("string").alias("made"), "text")
    # An edit of its own row (kind 1) comes before the row's text, which has no ordinal.
    order = [F.asc_nulls_first("conv_id"), F.asc_nulls_first("turn"), "role", "key", "kind", F.asc_nulls_last("first_at"), F.asc_nulls_last("ordinal")]
    merged = edits.unionByName(texts).repartition("conv_id").sortWithinPartitions(*order)
    return merged.select("conv_id", "role", "made", "kind", "ordinal", "text").mapInArrow(_merge, f"conv_id {kind}, ordinal long, role string, text string")


def _merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    waiting, conv, place = None, object(), 0
    for batch in batches:
        out = []
        for now, role, made, kind, ordinal, text in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            if now != conv:
                conv, place = now, 0
            if ordinal is None:
                if waiting is None:
                    continue  # deleted, or a copy of the row before
                turn, waiting = (conv, place, waiting or role, text), None
            elif kind == 1:
                waiting = made or ""
                continue
            else:
                turn = (conv, place, made, "")
            out.append(turn)
            place += 1
        columns = zip(*out, strict=True) if out else ([], [], [], [])
        types = (batch.schema.field("conv_id").type, pa.int64(), pa.string(), pa.string())
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)], ["conv_id", "ordinal", "role", "text"])


def digests(repaired: DataFrame) -> DataFrame:
    """(conv_id, repaired_sha256): the sha256 of each conversation's `role:text` lines. The rows stream through as
    `repair` leaves them, a conversation in order within one partition; a digest of one text can not be split."""
    kind = dict(repaired.dtypes)["conv_id"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        conv, state, at = None, None, None
        for batch in batches:
            at, done = batch.schema.field("conv_id").type, []
            for now, ordinal, role, text in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if ordinal == 0:
                    if state is not None:
                        done.append((conv, state.hexdigest()))
                    conv, state = now, hashlib.sha256()
                else:
                    state.update(b"\n")
                state.update(f"{role}:{text}".encode())
            yield _pairs(done, at)
        if state is not None:
            yield _pairs([(conv, state.hexdigest())], at)

    return repaired.select("conv_id", "ordinal", "role", "text").mapInArrow(run, f"conv_id {kind}, repaired_sha256 string")


def _pairs(found: list[tuple], kind: pa.DataType) -> pa.RecordBatch:
    ids, values = zip(*found, strict=True) if found else ([], [])
    return pa.RecordBatch.from_arrays([pa.array(ids, kind), pa.array(values, pa.string())], ["conv_id", "repaired_sha256"])
