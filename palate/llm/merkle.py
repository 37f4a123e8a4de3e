"""A Merkle manifest of a dataset: a digest per record, per group and for all, and a proof per record.

A node carries the interval [lo, hi) of the leaf places that it covers in its group, so labels nest as
nodes do. A level is built by one grouping on the bucket `lo div width`, which holds at most `fanout` nodes
whatever the size of the group. Proofs go down again: a node meets its parent in the parent's bucket, where the
parent's interval contains its own; what the parent covers besides that interval are the siblings.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from palate.llm.common import group_places, in_order, stage

FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
FANOUT = 3
#: Levels that one plan goes down; the paths found so far are staged between.
LEVELS_A_PLAN = 3
_PATH = "cast(array() as array<struct<before:string,after:string>>)"


def digest(*values: Column) -> Column:
    """Lower-case hex sha256 of texts put one after another."""
    return F.sha2(F.concat(*values).cast("binary"), 256)


def record_digest(fields: Sequence[Column]) -> Column:
    """The digest of a record: each field is `-` if null, else its UTF-8 byte count, a colon and its value."""
    texts = [f.cast("string") for f in fields]
    return digest(*(F.coalesce(F.concat(F.octet_length(t).cast("string"), F.lit(":"), t), F.lit("-")) for t in texts))


def fold(leaf: Column, path: str) -> Column:
    """The root that a leaf leads to along the siblings of its path."""
    return F.aggregate(path, leaf, lambda own, step: digest(step["before"], own, step["after"]))


def _levels(leaves: DataFrame, fanout: int, label: str) -> list[DataFrame]:
    """The levels above leaves (base, n, lo, hi, digest): nodes of the groups that have several nodes below,
    with their children. Each is staged, and a group ends where one node is left."""
    largest = leaves.agg(F.max("n")).first()[0] or 0
    levels, below, width = [], leaves, 1
    while width < largest:
        runs = below.filter(F.col("n") > width).groupBy("base", "n", F.expr(f"lo div {width * fanout}L").alias("bucket"))
        nodes = runs.agg(F.min("lo").alias("lo"), F.max("hi").alias("hi"), F.sort_array(F.collect_list(F.struct("lo", "hi", "digest"))).alias("children"))
        own = digest(F.array_join(F.transform("children", lambda c: c["digest"]), ""))
        levels.append(stage(nodes.select("base", "n", "lo", "hi", own.alias("digest"), "children"), f"{label}-{len(levels) + 1}"))
        below, width = levels[-1], width * fanout
    return levels


def _paths(leaves: DataFrame, levels: list[DataFrame], tops: DataFrame, fanout: int) -> DataFrame:
    """leaves with their path of siblings, from themselves up, and the columns of tops (base, path, ...), which says
    how each group's last node goes on. `top` is that node's digest."""
    carried = [name for name in tops.columns if name not in ("base", "path")]
    found = None
    for k in range(len(levels), -1, -1):
        width, nodes = fanout**k, (levels[k - 1] if k else leaves)
        last = F.col("n") <= width if not k else (F.col("n") <= width) & (F.col("n") > width // fanout)
        done = nodes.filter(last).join(tops.hint("merge"), "base").withColumn("top", F.col("digest"))
        if found is not None:
            bucket = F.expr(f"lo div {width * fanout}L")
            parents = found.select("base", bucket.alias("bucket"), F.col("lo").alias("from"), F.col("hi").alias("to"), F.col("children").alias("run"), "path", "top", *carried)
            # Never broadcast: few rows, but their paths are long once they are unpacked.
            inner = nodes.filter(F.col("n") > width).withColumn("bucket", bucket).join(parents.hint("merge"), ["base", "bucket"])
            inner = inner.filter((F.col("from") <= F.col("lo")) & (F.col("hi") <= F.col("to")))

            def rest(test):
                return F.array_join(F.transform(F.filter("run", test), lambda c: c["digest"]), "")

            step = F.struct(rest(lambda c: c["hi"] <= F.col("lo")).alias("before"), rest(lambda c: c["lo"] >= F.col("hi")).alias("after"))
            done = done.unionByName(inner.withColumn("path", F.concat(F.array(step), "path")).select(done.columns))
        found = stage(done, "merkle-paths") if k and (len(levels) - k) % LEVELS_A_PLAN == LEVELS_A_PLAN - 1 else done
    return found


def _as_leaves(placed: DataFrame) -> DataFrame:
    return placed.withColumnRenamed("place", "lo").withColumn("hi", F.col("lo") + 1)


def manifest(leaves: DataFrame, group: str, order: str, fanout: int = FANOUT) -> DataFrame:
    """Every row of leaves (with its `digest`, hex text) with `subroot`, `root` and `path`: leaves of a group ascend by
    order, every `fanout` consecutive nodes become their digest until one is left, the subroot; subroots, in the order
    of their groups, likewise give the root. `path` lists, from the leaf to the root, the siblings before and after.

    Nulls in group are one group, the first; nulls in order come first, ties go by digest. Equal rows are leaves
    each. An empty table gives no rows. Other columns pass through; names used here are refused."""
    used = {"at", "n", "base", "lo", "hi", "path", "top", "subroot", "root", "children", "run", "bucket", "from", "to", "tie"}
    if clash := used & set(leaves.columns):
        raise ValueError(f"columns {sorted(clash)} are used by the manifest")
    own = stage(leaves.withColumn("tie", F.monotonically_increasing_id()), "merkle-leaves")
    placed = in_order(own, group, [F.asc_nulls_first(order), F.asc("digest"), F.asc("tie")], "merkle-order")
    bottom = stage(_as_leaves(group_places(placed.drop("tie"), group)), "merkle-places")
    levels = _levels(bottom, fanout, "merkle-level")

    last = None  # the node that each group ends with
    for k in range(len(levels), -1, -1):
        width, nodes = fanout**k, (levels[k - 1] if k else bottom)
        ends = nodes.filter((F.col("n") <= width) & (F.col("n") > (width // fanout if k else 0))).select(F.col("base").alias("group"), "digest")
        last = ends if last is None else last.unionByName(ends)
    groups = in_order(last.withColumn("all", F.lit(0)), "all", [F.asc("group")], "merkle-groups")
    tops = stage(_as_leaves(group_places(groups, "all")), "merkle-subroots")
    upper = _levels(tops, fanout, "merkle-upper")
    empty = F.expr(_PATH)
    end = (upper[-1] if upper else tops).filter(F.col("n") <= fanout ** len(upper)).select("base", empty.alias("path"))
    ways = stage(_paths(tops, upper, end, fanout).select(F.col("group").alias("base"), "path", F.col("top").alias("root")), "merkle-ways")

    found = _paths(bottom, levels, ways, fanout)
    return found.select(*leaves.columns, F.col("top").alias("subroot"), "root", "path")


def with_proofs(records: DataFrame, changed: Column, new_text: Column, fields: Sequence[str] = FIELDS, group: str = "source", id_col: str = "doc_id", text_col: str = "text", fanout: int = FANOUT) -> DataFrame:
    """(doc_id, leaf, subroot, root, path, folded_root) of every record. The folded root starts at the record's digest
    as it is now, with new_text where `changed` holds, and goes up through the siblings of the manifest.

    A null text stays null; null fields count as `-`. Records without an id come first in their group. Texts
    are digested where they are read and never shuffled. Columns besides fields are not looked at."""
    now = [F.when(changed, new_text).otherwise(F.col(text_col)) if name == text_col else F.col(name) for name in fields]
    leaves = records.select(
        F.col(id_col).alias("doc_id"), F.col(group).alias("group_of"),
        record_digest([F.col(name) for name in fields]).alias("digest"),
        F.when(changed, record_digest(now)).alias("digest_now"),
    )
    made = manifest(leaves, "group_of", "doc_id", fanout)
    return made.select("doc_id", F.col("digest").alias("leaf"), "subroot", "root", "path", fold(F.coalesce("digest_now", "digest"), "path").alias("folded_root"))


def proof_digest(path: str) -> Column:
    """The digest of all siblings of a path, level by level, left to right."""
    return digest(F.array_join(F.transform(path, lambda s: F.concat(s["before"], s["after"])), ""))
