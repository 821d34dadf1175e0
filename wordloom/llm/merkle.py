"""Merkle manifest of a dataset: leaf digests, subtree roots, a root and a proof per row.

A row is a leaf. Per group (language) the leaves stand in the order of their
ids; every ``fanout`` consecutive nodes have their digest as parent, until one
node, the group's subroot, remains. The subroots, ordered by group, are the
leaves of the top tree, whose last node is the root.

The work is dealt into partitions of ``fanout ** depth`` consecutive leaves. A
partition hashes its own subtree; then partitions swap roots in a butterfly:
in round r aligned groups of ``fanout`` neighbours (those that differ in digit
r of their number alone) give each other the ancestor that each holds, and
every one of them hashes the common parent itself. The redundant hashes cost
one digest per partition and round; in return every partition holds all its
upper siblings and the root after the last round, and no pass leads down again.
Where a short last run leaves a partner number unused, the members of that
run answer for it in turn. The top tree is built the same way from subroots.

A level of a proof is the pair (digests left of the node, digests right of it)
within its run, so a parent is ``H(left + node + right)``.

Defined results: a null value of a leaf is written ``-``, another as its UTF-8
byte count, ``:`` and itself. A null group is a group of its own and comes
first; null ids come first in their group. Rows of the same group and id follow
each other by leaf digest; repeated rows are leaves of their own. A lone row's
leaf is its subroot and, alone in the table, the root; its proof is the digest
of no siblings. An empty table gives no rows. Further columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from hashlib import sha256

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from wordloom.llm import common

DEPTH = 12   # a partition's subtree has fanout ** DEPTH leaves
Level = tuple[str, str]


def hashed(text: str) -> str:
    return sha256(text.encode()).hexdigest()


def field(c: Column) -> Column:
    """A leaf field: byte count, colon and value; ``-`` for null."""
    s = c.cast("string")
    return F.coalesce(F.concat(F.octet_length(s).cast("string"), F.lit(":"), s), F.lit("-"))


def leaf(*fields: Column) -> Column:
    return F.sha2(F.concat(*map(field, fields)), 256)


# --- hashing inside a partition -------------------------------------------------
def subtree(nodes: list[str], fanout: int, rounds: int | None) -> list[list[str]]:
    """The levels over ``nodes``, from themselves on; up to one node, or exactly ``rounds`` above them."""
    levels = [nodes]
    while (len(levels[-1]) > 1) if rounds is None else len(levels) <= rounds:
        at = levels[-1]
        levels.append([hashed("".join(at[i: i + fanout])) for i in range(0, len(at), fanout)])
    return levels


def path(levels: list[list[str]], i: int, fanout: int) -> list[Level]:
    """The siblings of node ``i`` of the lowest level, level by level."""
    out = []
    for at in levels[:-1]:
        low = i - i % fanout
        out.append(("".join(at[low:i]), "".join(at[i + 1: low + fanout])))
        i //= fanout
    return out


def folded(node: str, levels: list[Level]) -> str:
    for left, right in levels:
        node = hashed(left + node + right)
    return node


# --- numbering and partitions -----------------------------------------------------
def _numbered(names: list[str], fields: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, last, k = TaskContext.get().partitionId(), None, 0
        for b in batches:
            numbers = []
            for g in b.column(0).to_pylist():
                k = k + 1 if g == last else 0
                last = g
                numbers.append(k)
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array([part] * b.num_rows, pa.int64()), pa.array(numbers, pa.int64())], names=[*names, "part", "k"])
    return run, f"{fields}, part long, k long"


def partitions(rows: DataFrame, order: list[Column], folder: str, size: int) -> DataFrame:
    """(g, n, block, leaves) of ``rows`` (g first, digest and more): a row per ``size`` consecutive rows of a group; n: the group's rows."""
    ordered = rows.withColumn("tie", F.monotonically_increasing_id()).orderBy("g", *order, "tie").drop("tie")
    run, schema = _numbered(rows.columns, ", ".join(f"{c} {t}" for c, t in rows.dtypes))
    held = common.written(ordered.mapInArrow(run, schema), f"{folder}/ordered")
    counts = held.groupBy("g", "part").agg(F.count("*").alias("c"))   # a row per group and task
    group = Window.partitionBy("g")
    starts = counts.select("g", "part", (F.sum("c").over(group.orderBy("part")) - F.col("c")).alias("start"), F.sum("c").over(group).alias("n"))
    at = held.join(starts, ["g", "part"]).withColumn("i", F.col("start") + F.col("k"))
    one = F.struct("i", *(c for c in rows.columns if c != "g"))
    return common.written(at.groupBy("g", "n", F.floor(F.col("i") / size).alias("block")).agg(F.sort_array(F.collect_list(one)).alias("leaves")), f"{folder}/partitions")


def _roots(fanout: int, depth: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in common.slices(batches, 8):
            tops = [subtree(x, fanout, depth if n > fanout ** depth else None)[-1][0] for n, x in zip(b.column(1).to_pylist(), b.column(3).to_pylist(), strict=True)]
            yield pa.RecordBatch.from_arrays([*b.columns[:3], pa.array(tops, pa.string())], names=["g", "n", "block", "node"])
    return run


# --- butterfly ----------------------------------------------------------------------
def butterfly(state: DataFrame, fanout: int, size: int, folder: str) -> DataFrame:
    """(g, n, block, node, ups) of partition roots (g, n, block, node): all levels above each partition; ``node`` is then the group's root."""
    last = F.floor((F.col("n") - 1) / size)   # number of the group's last partition
    state = state.withColumn("ups", F.array().cast("array<struct<l:string,r:string>>"))
    most = state.agg(F.max(last)).first()[0]
    width, r = 1, 0
    while most is not None and width <= most:
        own, run = F.floor(F.col("block") / width) % fanout, F.floor(F.col("block") / (width * fanout)) * fanout
        # the partner partition of every other run member: the one at the same place, or in a short last run the members in turn
        asked = state.where(last >= width).select("g", "block", last.alias("last"), run.alias("run"), own.alias("own")).withColumn("j", F.explode(F.sequence(F.lit(0), F.lit(fanout - 1)))).where("j != own")
        first = (F.col("run") + F.col("j")) * width
        asked = asked.where(first <= F.col("last")).withColumn("partner", first + F.col("block") % F.least(F.lit(width), F.col("last") - first + 1))
        given = state.select("g", F.col("block").alias("partner"), F.col("node").alias("of"))
        swapped = asked.join(given, ["g", "partner"]).groupBy("g", "block").agg(F.sort_array(F.collect_list(F.struct("j", "of"))).alias("others"))
        side = lambda test: F.array_join(F.transform(F.filter(F.col("others"), test), lambda x: x["of"]), "")
        level = F.struct(F.coalesce(side(lambda x: x["j"] < own), F.lit("")).alias("l"), F.coalesce(side(lambda x: x["j"] > own), F.lit("")).alias("r"))
        joined = state.join(swapped, ["g", "block"], "left").withColumn("level", level)
        goes_on = last >= width
        state = common.written(joined.select(
            "g", "n", "block", F.when(goes_on, F.sha2(F.concat("level.l", "node", "level.r"), 256)).otherwise(F.col("node")).alias("node"),
            F.when(goes_on, F.concat("ups", F.array("level"))).otherwise(F.col("ups")).alias("ups")), f"{folder}/round-{r}")
        width, r = width * fanout, r + 1
    return state


def _proved(names: list[str], fanout: int, depth: int, whole: bool):
    """Rows of the partitions with their proofs; ``whole``: the levels themselves."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for at in range(b.num_rows):
                n, root = b["n"][at].as_py(), b["root"][at].as_py()
                rows = pa.RecordBatch.from_struct_array(b["leaves"][at].values)
                ups = [(x["l"], x["r"]) for x in b["ups"][at].as_py()]
                above = "".join(x + y for x, y in ups)
                digests = rows["digest"].to_pylist()
                levels = subtree(digests, fanout, depth if n > fanout ** depth else None)
                own = [path(levels, i, fanout) for i in range(len(digests))]
                out = {c: rows[c] for c in names}
                if whole:
                    out["levels"] = pa.array([[{"l": x, "r": y} for x, y in [*p, *ups]] for p in own], pa.list_(pa.struct([("l", pa.string()), ("r", pa.string())])))
                else:
                    out["proof_sha256"] = pa.array([hashed("".join([x + y for x, y in p]) + above) for p in own], pa.string())
                    out["folded_root"] = pa.array([folded(folded(x, p), ups) for x, p in zip(rows["check"].to_pylist(), own, strict=True)], pa.string())
                for c in ("g", "subroot", "root"):
                    out[c] = pa.array([b[c][at].as_py()] * len(digests), pa.string())
                yield pa.RecordBatch.from_arrays(list(out.values()), names=list(out))
    return run


def group_key(c: Column) -> Column:
    """A group's value as a string that is never null and sorts bytewise after the null group."""
    return F.coalesce(F.concat(F.lit("="), c.cast("string")), F.lit("-"))


def manifest(leaves: DataFrame, folder: str, fanout: int = 2, depth: int = DEPTH) -> DataFrame:
    """(doc_id, leaf, subroot, root, proof_sha256, folded_root) of ``leaves`` (doc_id, g, digest, check).

    ``g`` is a ``group_key``; ``check`` is the leaf digest that is folded up to
    ``folded_root``, the row's own or that of a later copy of the row.
    """
    size = fanout ** depth
    leaves = leaves.select("g", F.col("doc_id").cast("long").alias("doc_id"), "digest", "check")
    parts = partitions(leaves, [F.asc_nulls_first("doc_id"), F.col("digest"), F.col("check")], f"{folder}/leaves", size)
    digests = parts.select("g", "n", "block", F.col("leaves.digest").alias("nodes"))
    state = butterfly(common.written(digests.mapInArrow(_roots(fanout, depth), "g string, n long, block long, node string"), f"{folder}/roots"), fanout, size, folder)
    # the top tree: a leaf per group
    tops = state.where("block = 0").select(F.lit("").alias("g"), F.col("node").alias("digest"), F.col("g").alias("of"))
    top_parts = partitions(tops, [F.col("of")], f"{folder}/top", size)
    top = top_parts.select("g", "n", "block", F.col("leaves.digest").alias("nodes"))
    top_state = butterfly(common.written(top.mapInArrow(_roots(fanout, depth), "g string, n long, block long, node string"), f"{folder}/top-roots"), fanout, size, f"{folder}/top")
    held = top_parts.join(top_state.select("block", "ups", F.col("node").alias("root")), "block").withColumn("subroot", F.lit(""))
    groups = held.mapInArrow(_proved(["of"], fanout, depth, True), "of string, levels array<struct<l:string,r:string>>, g string, subroot string, root string")
    groups = common.written(groups.select(F.col("of").alias("g"), "levels", "root"), f"{folder}/groups")
    # every partition: its leaves, the levels above it in its group, those of its group in the top tree
    held = (parts.join(state.select("g", "block", "ups", F.col("node").alias("subroot")), ["g", "block"]).join(groups, "g")
            .withColumn("ups", F.concat("ups", "levels")))
    out = held.mapInArrow(_proved(["doc_id", "digest"], fanout, depth, False), "doc_id long, digest string, proof_sha256 string, folded_root string, g string, subroot string, root string")
    return out.select("doc_id", F.col("digest").alias("leaf"), "subroot", "root", "proof_sha256", "folded_root")
