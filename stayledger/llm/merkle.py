"""A Merkle manifest of a table: content-addressed records, and proofs by descent.

A row's leaf is the hash of its fields. Within a group (a language) leaves stand in the order
of a key; runs of ``fanout`` consecutive nodes become their hash, level by level, until one
is left, the subroot. Subroots in the order of their groups make the root in the same way.

The store holds records from a digest to its children, in segments: a segment is a subtree
of ``levels`` levels, so it has a bounded size, and a tree of any number of rows is a few
rounds of segments. A place in the order of the whole table comes from a range partitioning
that is written down; only counts of partitions and groups are added up, no group of rows
meets in one task, and equal rows are told apart by a stored number. Proofs come from
descent: from the root by the digits of the wanted place, picking a child of each record and
keeping the others, segment by segment; the segments' parts, turned round, are the path from
the leaf to the root. Whole segments descend together, and only those of the last round meet
the leaves.

Defined results: a missing field is ``-``; a missing group is a group of its own and comes
first, missing keys come first in their group; rows that repeat a key stand in the order of
their leaves, equal rows take places of their own; an empty table has no root. Only the
named fields are used.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field
from functools import reduce

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stayledger.storage import stage_table

FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
FANOUT = 2
# A segment spans so many levels: 1024 nodes at its lower end.
LEVELS = 10
# Rows of one partition while places are counted; a row has about 100 bytes.
RANGE_ROWS = 1 << 18


def encoded(value: Column) -> Column:
    """``-`` for a missing value, else its length in bytes, a colon and the value."""
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaf_of(columns: Sequence[Column]) -> Column:
    return F.sha2(F.concat(*[encoded(c) for c in columns]).cast("binary"), 256)


def _hash(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


@dataclass
class Tree:
    """The segments of all trees of one kind, by round from the leaves up."""

    fanout: int
    levels: int
    rounds: list[DataFrame] = field(default_factory=list)

    @property
    def wide(self) -> int:
        """Nodes at the lower end of a segment."""
        return self.fanout**self.levels


@dataclass
class Manifest:
    leaves: DataFrame
    lower: Tree
    upper: Tree
    root: str | None


def placed(df: DataFrame, keys: Sequence[str], within: str) -> DataFrame:
    """Rows with their ``place`` in the order of the keys within each group, and the group's ``size``.

    ``keys`` must tell rows apart, or rows equal in them must be equal in all that matters.
    """
    rows = df.count()
    parts = max(1, math.ceil(rows / RANGE_ROWS))
    order = [F.col(c).asc_nulls_first() for c in (within, *keys)]
    # The number of a row counts through its partition from partition << 33 on.
    ordered = df.repartitionByRange(parts, *order).sortWithinPartitions(*order)
    stored = stage_table(ordered.withColumn("_at", F.monotonically_increasing_id()), "merkle-order")
    part = F.shiftright("_at", 33)
    pieces = stored.groupBy(within, part.alias("_part")).agg(F.min("_at").alias("_first"), F.count(F.lit(1)).alias("_n"))
    whole = Window.partitionBy(within)
    before = F.coalesce(F.sum("_n").over(whole.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    pieces = pieces.select(
        F.col(within).alias("_within"), "_part", (before - F.col("_first")).alias("_shift"), F.sum("_n").over(whole).alias("size")
    )
    same = stored[within].eqNullSafe(pieces["_within"]) & (part == pieces["_part"])
    joined = stored.join(pieces, same).withColumn("place", F.col("_at") + F.col("_shift"))
    return joined.drop("_at", "_within", "_part", "_shift")


SEGMENT = "tree long, place long, size long, digest binary, height int, records array<struct<digest:binary,children:array<binary>>>"


def climb(nodes: DataFrame, largest: int, fanout: int, levels: int) -> Tree:
    """Segments over nodes ``tree, place, size, digest``; ``largest`` is the greatest size."""
    tree = Tree(fanout, levels)
    wide = tree.wide

    def run(key: tuple, part: pa.Table) -> pa.Table:
        part = part.sort_by("place")
        size = part.column("size")[0].as_py()
        height = 0
        while fanout**height < min(size, wide):
            height += 1
        now = [d.hex() for d in part.column("digest").to_pylist()]
        records: dict[str, list[str]] = {}
        for _ in range(height):
            runs = [now[i : i + fanout] for i in range(0, len(now), fanout)]
            now = [_hash("".join(r)) for r in runs]
            records.update(zip(now, runs))
        if len(now) != 1:
            raise ValueError(f"places of tree {key[0]} have a gap")
        held = [{"digest": bytes.fromhex(d), "children": list(map(bytes.fromhex, c))} for d, c in records.items()]
        columns = [[key[0].as_py()], [key[1].as_py()], [-(-size // wide)], [bytes.fromhex(now[0])], [height], [held]]
        return pa.table([pa.array(c, t) for c, t in zip(columns, kinds)], names=names)

    record = pa.struct([("digest", pa.binary()), ("children", pa.list_(pa.binary()))])
    kinds = [pa.int64(), pa.int64(), pa.int64(), pa.binary(), pa.int32(), pa.list_(record)]
    names = ["tree", "place", "size", "digest", "height", "records"]
    while not tree.rounds or largest > 1:
        grouped = nodes.select("tree", "place", "size", "digest", _segment(wide).alias("segment")).groupBy("tree", "segment")
        nodes = stage_table(grouped.applyInArrow(run, SEGMENT), "merkle-records")
        tree.rounds.append(nodes)
        largest = math.ceil(largest / wide)
    return tree


def build(
    docs: DataFrame,
    fields: Sequence[str] = FIELDS,
    group: str = "lang",
    order: str = "doc_id",
    tampered: Mapping[str, str] | None = None,
    fanout: int = FANOUT,
    levels: int = LEVELS,
) -> Manifest:
    """The manifest of a table. ``tampered`` names columns to take for fields in changed leaves.

    Such leaves take no part in the manifest; proofs try them where they differ.
    """
    own = [F.col(f"`{f}`") for f in fields]
    other = [F.col(f"`{(tampered or {}).get(f, f)}`") for f in fields]
    changed = [~a.eqNullSafe(b) for f, a, b in zip(fields, own, other) if f in (tampered or {})]
    differs = F.array_contains(F.array(*changed), True) if changed else F.lit(False)
    leaves = docs.select(
        F.col(f"`{order}`").alias("key"),
        F.col(f"`{group}`").alias("group"),
        F.unhex(leaf_of(own)).alias("digest"),
        F.when(differs, F.unhex(leaf_of(other))).alias("changed"),
    )
    # The number tells equal rows apart; once written it stays the same for a task that runs again.
    leaves = stage_table(leaves.withColumn("number", F.monotonically_increasing_id()), "merkle-leaves")
    ranked = placed(leaves, ["key", "digest", "number"], "group")
    groups = leaves.groupBy("group").count()
    groups = placed(groups.withColumn("all", F.lit(0)), ["group"], "all")
    groups = stage_table(groups.select(F.col("group").alias("_group"), "count", F.col("place").alias("tree"), F.col("size").alias("trees")), "merkle-groups")
    most, trees = groups.agg(F.max("count"), F.max("trees")).first()
    joined = ranked.join(groups, ranked["group"].eqNullSafe(groups["_group"]))
    nodes = stage_table(joined.select("key", "group", "tree", "trees", "place", "size", "digest", "changed"), "merkle-places")
    lower = climb(nodes, most or 0, fanout, levels)
    subroots = lower.rounds[-1].join(groups.select("tree", "trees"), "tree")
    subroots = subroots.select(F.lit(0).cast("long").alias("tree"), F.col("tree").alias("place"), F.col("trees").alias("size"), "digest")
    upper = climb(subroots, trees or 0, fanout, levels)
    top = upper.rounds[-1].select("digest").first()
    return Manifest(nodes, lower, upper, top[0].hex() if top else None)


PATH = "array<struct<before:string,after:string>>"
_STEPS = pa.list_(pa.struct([("before", pa.string()), ("after", pa.string())]))


def descend(records: Mapping[str, list[str]], root: str, place: int, height: int, fanout: int) -> tuple[str, list[dict]]:
    """The node at a place below a segment's root, and its siblings from there up to the root."""
    node, path = root, []
    for level in range(height - 1, -1, -1):
        digit = place // fanout**level % fanout
        children = records[node]
        path.append({"before": "".join(children[:digit]), "after": "".join(children[digit + 1 :])})
        node = children[digit]
    return node, path[::-1]


def _opened(held: pa.Table) -> tuple[dict[str, list[str]], str, int, list[dict]]:
    """Records, root, height and upper path of the one segment of a group."""
    if held.num_rows != 1:
        raise ValueError("the manifest lacks a segment")
    row = held.to_pylist()[0]
    records = {r["digest"].hex(): [c.hex() for c in r["children"]] for r in row["records"]}
    return records, row["digest"].hex(), row["height"], row["path"]


def _segment(wide: int) -> Column:
    return F.floor(F.col("place") / wide).cast("long")


def _found(wanted: DataFrame, held: DataFrame, tree: Tree) -> DataFrame:
    """Paths of the nodes ``tree, place, digest`` at the lower end of segments with a path of their own."""
    fanout, wide = tree.fanout, tree.wide

    def run(wanted: pa.Table, held: pa.Table) -> pa.Table:
        records, root, height, upper = _opened(held)
        paths = []
        for place, digest in zip(wanted.column("place").to_pylist(), wanted.column("digest").to_pylist()):
            node, path = descend(records, root, place % wide, height, fanout)
            if node != digest.hex():
                raise ValueError("the manifest has another node at a place")
            paths.append(path + upper)
        return pa.table([wanted.column("tree"), wanted.column("place"), pa.array(paths, _STEPS)], names=["tree", "place", "path"])

    held = held.select("tree", F.col("place").alias("segment"), "digest", "height", "records", "path")
    wanted = wanted.select("tree", "place", "digest", _segment(wide).alias("segment"))
    both = wanted.groupBy("tree", "segment").cogroup(held.groupBy("tree", "segment"))
    return stage_table(both.applyInArrow(run, f"tree long, place long, path {PATH}"), "merkle-paths")


def _lowest(tree: Tree, above: DataFrame) -> DataFrame:
    """Segments of the first round with the path from their root up; ``above``: the path of each tree."""
    found = above.withColumn("place", F.lit(0).cast("long"))
    for now, below in zip(tree.rounds[:0:-1], tree.rounds[-2::-1]):
        found = _found(below, now.join(found, ["tree", "place"]), tree)
    return tree.rounds[0].join(found, ["tree", "place"])


def fold(node: str, path: list[dict]) -> str:
    """The hash that a node and its siblings give at the end of the path."""
    for step in path:
        node = _hash(step["before"] + node + step["after"])
    return node


def prove(manifest: Manifest, wanted: DataFrame | None = None, paths: bool = False) -> DataFrame:
    """Proofs of the wanted leaves (rows of ``manifest.leaves``), of all by default.

    Returns ``key``, ``group``, ``leaf``, ``subroot``, ``root``, ``proof`` (hash of all
    siblings from the leaf up), ``folded`` (the root that the changed leaf, or else the leaf,
    and the siblings give) and ``verified``; with ``paths`` also the siblings.
    """
    wanted = manifest.leaves if wanted is None else wanted
    spark, root = wanted.sparkSession, manifest.root
    plain = " string, ".join("leaf subroot root proof folded".split()) + " string, verified boolean" + (f", path {PATH}" if paths else "")
    schema = T.StructType([*wanted.select("key", "group").schema.fields, *T.StructType.fromDDL(plain).fields])
    if root is None:
        return spark.createDataFrame([], schema)
    lower, upper = manifest.lower, manifest.upper
    fanout, wide, names = lower.fanout, lower.wide, schema.names
    subroots = lower.rounds[-1].select("tree", "digest")
    at_top = spark.range(1).select(F.lit(0).cast("long").alias("tree"), F.array().cast(PATH).alias("path"))
    placed_subroots = subroots.select(F.lit(0).cast("long").alias("tree"), F.col("tree").alias("place"), "digest")
    above = _found(placed_subroots, _lowest(upper, at_top), upper).select(F.col("place").alias("tree"), "path")
    held = _lowest(lower, above).join(subroots.select("tree", F.col("digest").alias("subroot")), "tree")
    held = held.select("tree", F.col("place").alias("segment"), "digest", "height", "records", "path", "subroot")

    def run(asked: pa.Table, held: pa.Table) -> pa.Table:
        records, top, height, upper_path = _opened(held) if asked.num_rows else ({}, "", 0, [])
        # The way from the segment's root up is the same for all its leaves.
        siblings_above = "".join(s["before"] + s["after"] for s in upper_path)
        top_folds = fold(top, upper_path)
        leaves, proofs, folds, rows = [], [], [], []
        for place, digest, changed in zip(*(asked.column(c).to_pylist() for c in ("place", "digest", "changed"))):
            path = descend(records, top, place % wide, height, fanout)[1]
            leaves.append(digest.hex())
            proofs.append(_hash("".join(s["before"] + s["after"] for s in path) + siblings_above))
            now = fold((changed or digest).hex(), path)
            folds.append(top_folds if now == top else fold(now, upper_path))
            rows.append(path + upper_path if paths else None)
        n = len(leaves)
        subroot = held.column("subroot")[0].as_py().hex() if n else ""
        text = [leaves, [subroot] * n, [root] * n, proofs, folds]
        columns = [asked.column("key"), asked.column("group"), *(pa.array(c, pa.string()) for c in text)]
        columns += [pa.array([f == root for f in folds], pa.bool_())] + ([pa.array(rows, _STEPS)] if paths else [])
        return pa.table(columns, names=names)

    asked = wanted.select("key", "group", "tree", "place", "digest", "changed", _segment(wide).alias("segment"))
    both = asked.groupBy("tree", "segment").cogroup(held.groupBy("tree", "segment"))
    return both.applyInArrow(run, schema)


def records(tree: Tree) -> DataFrame:
    """The store as plain records: ``digest`` and its ``children``."""
    held = [r.select(F.inline("records")) for r in tree.rounds]
    return reduce(DataFrame.unionByName, held)


def digest(proved: DataFrame) -> DataFrame:
    return proved.select(
        F.col("key").alias("doc_id"), "leaf", "subroot", "root", F.col("proof").alias("proof_sha256"),
        F.col("folded").alias("folded_root"), "verified",
    )
