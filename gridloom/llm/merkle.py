"""Merkle manifest of a dataset: leaves, roots, proofs and their verification.

Every row is a leaf, a SHA-256 over its length-prefixed fields.  The leaves of a
group, ordered by key, are reduced ``ARITY`` neighbours at a time to the group's
subroot, and the subroots, ordered by group, to the root.  A leaf's proof are the
siblings on its way up; folding a leaf with its proof has to give the root.

Texts are hashed once by Spark, which leaves a narrow table.  Its rows are dealt by
range of (group, key), numbered inside each range and shifted by the counts of the
ranges before, so that no task holds a group.  A superblock are ``WIDTH`` neighbouring
nodes, a power of ``ARITY``.  On the way up each superblock is reduced to one node,
and these nodes again, until every group has one.  On the way down a superblock's nodes
and the outer nodes that its proofs need (the siblings of the superblock's own node up to
the root) are cogrouped: one call reduces the superblock once more, joins inner
and outer siblings and, for leaves, folds.  Outer nodes are a ``WIDTH``-th of the leaves, so
a group of 10^12 leaves takes four steps.

Groups: null is one of its own, before all others; then by UTF-8 bytes.  Null keys come
first in their group; rows of one key are ordered by leaf, equal rows by place in the
written table, which changes no result as a whole.  Null fields count as ``-``, so null
and empty text differ.  Texts of any length are hashed whole.  An empty table has no
root and gives an empty result.  Only the key, the group and the named fields are read;
other columns, whatever their names, neither count nor clash.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from functools import partial, reduce
from hashlib import sha256

import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F
from pyspark.sql.types import IntegerType, LongType, StructField, StructType

from gridloom.llm.common import Scratch, table

ARITY = 3
#: Nodes of a superblock, a power of ARITY.
WIDTH = ARITY**7

FIELDS = ("doc_id", "source", "lang", "n_chars", "text")

_NODE = "tree string, position long, total long, node binary"
_PATH = "tree string, position long, left array<string>, right array<string>, subroot binary"


def framed(fields: Sequence[Column]) -> Column:
    """The fields as one text: byte count, colon and value of each, or ``-``."""
    parts = []
    for field in fields:
        text = field.cast("string")
        parts.append(F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-")))
    return F.concat(*parts)


def leaf_digest(fields: Sequence[Column]) -> Column:
    return F.unhex(F.sha2(framed(fields), 256))


def _runs(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Number sorted rows inside their tree, and name the range they are in."""
    cut, tree, count = TaskContext.get().partitionId(), None, 0
    for batch in rows:
        local = []
        for name in batch.column("tree").to_pylist():
            tree, count = name, count + 1 if name == tree else 0
            local.append(count)
        extra = [pa.array([cut] * len(local), pa.int32()), pa.array(local, pa.int64())]
        yield pa.RecordBatch.from_arrays([*batch.columns, *extra], [*batch.schema.names, "_cut", "_local"])


def numbered(rows: DataFrame, order: Sequence[str], scratch: Scratch) -> DataFrame:
    """Add ``position`` in the tree, from 0, and ``total``, the size of the tree.

    ``rows`` is a table, as Spark samples it to find the ranges.
    """
    ranges = rows.repartitionByRange("tree", *order).sortWithinPartitions("tree", *order)
    schema = StructType([*rows.schema.fields, StructField("_cut", IntegerType()), StructField("_local", LongType())])
    local = scratch.settle(ranges.mapInArrow(_runs, schema))
    cuts = local.groupBy("tree", "_cut").agg(F.count("*").alias("_n"))
    whole = Window.partitionBy("tree")
    before = whole.orderBy("_cut").rowsBetween(Window.unboundedPreceding, -1)
    shifts = cuts.select(
        "tree", "_cut", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"), F.sum("_n").over(whole).alias("total")
    )
    placed = local.join(shifts, ["tree", "_cut"]).withColumn("position", F.col("_local") + F.col("_before"))
    out = scratch.settle(placed.drop("_cut", "_local", "_before"))
    scratch.drop(local)
    return out


def _hex(nodes: Sequence[bytes]) -> list[bytes]:
    return [node.hex().encode() for node in nodes]


def levels(nodes: list[bytes], total: int, width: int) -> list[list[bytes]]:
    """A superblock's nodes as hex text, level by level.

    The only superblock of its tree is reduced until one node remains, any other to
    the level of the next superblocks, even where it has a single node.
    """
    out, steps = [nodes], 0
    while len(out[-1]) > 1 or total > width and ARITY**steps < width:
        below = out[-1]
        runs = (b"".join(below[at : at + ARITY]) for at in range(0, len(below), ARITY))
        out.append([sha256(run).hexdigest().encode() for run in runs])
        steps += 1
    return out


def siblings(tree: list[list[bytes]], place: int) -> tuple[list[str], list[str]]:
    """Per level up to the superblock's node, the hex text left and right of the way up."""
    left, right = [], []
    for level in tree[:-1]:
        first = place - place % ARITY
        left.append(b"".join(level[first:place]).decode())
        right.append(b"".join(level[place + 1 : first + ARITY]).decode())
        place //= ARITY
    return left, right


def fold(leaf: str, left: Sequence[str], right: Sequence[str]) -> str:
    for before, after in zip(left, right):
        leaf = sha256(f"{before}{leaf}{after}".encode()).hexdigest()
    return leaf


def _block(width: int) -> Column:
    return F.call_function("div", F.col("position"), F.lit(width)).alias("block")


def _reduced(block: pa.Table, width: int) -> pa.Table:
    rows = block.sort_by("position")
    total = rows.column("total")[0].as_py()
    top = levels(_hex(rows.column("node").to_pylist()), total, width)[-1]
    return pa.table(
        {
            "tree": rows.column("tree")[:1],
            "position": pa.array([rows.column("position")[0].as_py() // width], pa.int64()),
            "total": pa.array([-(-total // width)], pa.int64()),
            "node": pa.array([bytes.fromhex(top[0].decode())], pa.binary()),
        }
    )


def forest(nodes: DataFrame, scratch: Scratch, width: int) -> list[DataFrame]:
    """The nodes of every step up; a tree's root is its row with ``total`` 1 above the first."""
    steps, rest = [nodes], nodes
    task = partial(_reduced, width=width)
    while True:
        narrow = rest.select("tree", "position", "total", "node", _block(width))
        steps.append(scratch.settle(narrow.groupBy("tree", "block").applyInArrow(lambda block: task(block), _NODE)))
        rest = steps[-1].where("total > 1")
        if not rest.take(1):
            return steps


def _exchanged(
    members: pd.DataFrame,
    outer: pd.DataFrame,
    node: str,
    finish: Callable[[pd.DataFrame, list, list, bytes], pd.DataFrame],
    width: int,
) -> pd.DataFrame:
    """Reduce a superblock, join its siblings with the outer ones, hand both to ``finish``."""
    members = members.sort_values("position")
    tree = levels(_hex(members[node]), int(members["total"].iloc[0]), width)
    above = list(outer["left"].iloc[0]), list(outer["right"].iloc[0])
    lefts, rights = [], []
    for place in range(len(members)):
        left, right = siblings(tree, place)
        lefts.append(left + above[0])
        rights.append(right + above[1])
    return finish(members, lefts, rights, outer["subroot"].iloc[0])


def _paths(members: pd.DataFrame, left: list, right: list, subroot: bytes) -> pd.DataFrame:
    return pd.DataFrame(
        {"tree": members["tree"], "position": members["position"]}
    ).assign(left=left, right=right, subroot=[subroot] * len(members))


def _folded(members: pd.DataFrame, left: list, right: list, subroot: bytes) -> pd.DataFrame:
    leaf = [x.hex() for x in members["leaf"]]
    given = [x.hex() if isinstance(x, bytes) else mine for x, mine in zip(members["changed"], leaf)]
    return pd.DataFrame({"key": members["key"]}).assign(
        leaf=leaf,
        subroot=subroot.hex(),
        proof=[[x for pair in zip(a, b) for x in pair if x] for a, b in zip(left, right)],
        folded_root=[fold(*way) for way in zip(given, left, right)],
    )


def _named(members: pd.DataFrame, left: list, right: list, subroot: bytes) -> pd.DataFrame:
    return pd.DataFrame({"tree": members["name"]}).assign(left=left, right=right)


def exchange(members: DataFrame, outer: DataFrame, node: str, finish: Callable, schema: str, width: int) -> DataFrame:
    """Cogroup the nodes of each superblock with the outer nodes of its proofs."""
    task = partial(_exchanged, node=node, finish=finish, width=width)
    inner = members.withColumn("block", _block(width)).groupBy("tree", "block")
    above = outer.withColumnRenamed("position", "block").groupBy("tree", "block")
    # A plain function of two tables is what Spark's cogroup accepts.
    return inner.cogroup(above).applyInPandas(lambda a, b: task(a, b), schema)


def _descend(steps: list[DataFrame], finished: DataFrame, scratch: Scratch, width: int) -> DataFrame:
    """Paths of all nodes of the first step up, from the paths of the trees' roots."""
    out = None
    for nodes in reversed(steps[1:]):
        ended = (
            nodes.where("total = 1")
            .select("tree", "position", F.col("node").alias("subroot"))
            .join(finished, "tree")
            .select("tree", "position", "left", "right", "subroot")
        )
        if out is not None:
            ended = ended.unionByName(exchange(nodes.where("total > 1"), out, "node", _paths, _PATH, width))
        before, out = out, scratch.settle(ended)
        if before is not None:
            scratch.drop(before)
    return out


def manifest(
    docs: DataFrame,
    key: str = "doc_id",
    group: str = "source",
    fields: Sequence[str] = FIELDS,
    given: Sequence[Column] | None = None,
    width: int = WIDTH,
) -> DataFrame:
    """Per row: key, leaf, its group's subroot, the root, its proof and the folded root.

    ``given`` are the fields as they are found when they are verified (as they are,
    without it); the proof is that of the manifest.  ``proof`` lists the siblings,
    from the leaf up, left to right, each entry the hex text of one side of one level.
    """
    scratch = Scratch(docs.sparkSession, "merkle")
    fields = [F.col(f"`{f}`") for f in fields]
    found = leaf_digest(given) if given else F.lit(None).cast("binary")
    group_of = F.col(f"`{group}`").cast("string")
    hashed = docs.select(
        # As text: pandas would make numbers with nulls inexact.
        F.col(f"`{key}`").cast("string").alias("key"),
        F.col(f"`{key}`").alias("ordered"),
        F.when(group_of.isNull(), F.lit("0")).otherwise(F.concat(F.lit("1"), group_of)).alias("tree"),
        leaf_digest(fields).alias("leaf"),
        found.alias("changed"),
        F.monotonically_increasing_id().alias("row"),
    ).withColumn("changed", F.when(F.col("changed") != F.col("leaf"), F.col("changed")))
    written = scratch.settle(hashed)
    leaves = numbered(written, ["ordered", "leaf", "row"], scratch)
    scratch.drop(written)
    steps = forest(leaves.withColumnRenamed("leaf", "node"), scratch, width)
    ends = [step.where("total = 1").select(F.lit("").alias("tree"), F.col("tree").alias("name"), "node") for step in steps[1:]]
    tops = numbered(scratch.settle(reduce(DataFrame.unionByName, ends)), ["name"], scratch)
    above = forest(tops, scratch, width)
    # The root is one row.
    root = above[-1].first()
    nothing = F.array().cast("array<string>")
    start = above[-1].select("tree", nothing.alias("left"), nothing.alias("right"))
    ways = "tree string, left array<string>, right array<string>"
    by_name = exchange(tops, _descend(above, start, scratch, width), "node", _named, ways, width)
    outer = _descend(steps, scratch.settle(by_name), scratch, width)
    schema = "key string, leaf string, subroot string, proof array<string>, folded_root string"
    rows = exchange(leaves.drop("ordered", "row"), outer, "leaf", _folded, schema, width)
    kind = docs.schema[key].dataType
    digest = root["node"].hex() if root else None
    return rows.select(
        F.col("key").cast(kind).alias(key), "leaf", "subroot", F.lit(digest).cast("string").alias("root"), "proof", "folded_root"
    )


def digests(docs: DataFrame, width: int = WIDTH) -> DataFrame:
    """The manifest's digests, and whether rows whose line ends were deleted still verify."""
    odd = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 2 == 0
    text = F.when(odd, F.replace("text", F.lit("\n"), F.lit(""))).otherwise(F.col("text"))
    given = [text if name == "text" else F.col(name) for name in FIELDS]
    return manifest(docs, given=given, width=width).select(
        "doc_id",
        "leaf",
        "subroot",
        "root",
        F.sha2(F.array_join("proof", ""), 256).alias("proof_sha256"),
        "folded_root",
        (F.col("folded_root") == F.col("root")).alias("verified"),
    )


def op12_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return digests(table(spark, sf_dir, "documents"))


_FRAME = " || ".join(f"coalesce(strlen({c}::varchar) || ':' || {c}::varchar, '-')" for c in FIELDS)
_STEP = "list_reduce([xor(c, b), 0, 0, 0, 0, 0, 0, 0, 0], lambda x, y: xor(x >> 1, 3988292384::ubigint * (x & 1)))"
_CRC = f"""list_reduce(list_concat([4294967295::ubigint],
    list_transform(string_split(doc_id::varchar, ''), lambda s: ascii(s)::ubigint)), lambda c, b: {_STEP})"""

ORACLE_SQL = f"""
with recursive given as (
  select row_number() over () r, *, xor({_CRC}, 4294967295::ubigint) % 2 = 0 as odd from documents),
hashed as (
  select r, doc_id, source, sha256({_FRAME}) leaf,
    sha256({_FRAME.replace("text::varchar", "(case when odd then replace(text, chr(10), '') else text end)")}) changed
  from given),
leaves as (
  select *, row_number() over (partition by source order by doc_id nulls first, leaf, r) - 1 pos,
    count(*) over (partition by source) n from hashed),
nodes as (
  select 0 lvl, source, pos, leaf node, n from leaves
  union all
  select lvl + 1, source, pos // {ARITY}, sha256(string_agg(node, '' order by pos)), any_value((n + {ARITY - 1}) // {ARITY})
  from nodes where n > 1 group by lvl, source, pos // {ARITY}),
subroots as (
  select source, node subroot, row_number() over (order by source nulls first) - 1 pos, count(*) over () n
  from nodes where n = 1),
tops as (
  select 0 lvl, pos, subroot node, n from subroots
  union all
  select lvl + 1, pos // {ARITY}, sha256(string_agg(node, '' order by pos)), any_value((n + {ARITY - 1}) // {ARITY})
  from tops where n > 1 group by lvl, pos // {ARITY}),
ways as (
  select r, m.lvl,
    coalesce(string_agg(node, '' order by m.pos) filter (m.pos < l.pos // ({ARITY} ** m.lvl)::bigint), '') a,
    coalesce(string_agg(node, '' order by m.pos) filter (m.pos > l.pos // ({ARITY} ** m.lvl)::bigint), '') b
  from leaves l join nodes m on l.source is not distinct from m.source and m.n > 1
    and m.pos // {ARITY} = l.pos // ({ARITY} ** (m.lvl + 1))::bigint
  group by r, m.lvl
  union all
  select r, 1000 + t.lvl,
    coalesce(string_agg(t.node, '' order by t.pos) filter (t.pos < s.pos // ({ARITY} ** t.lvl)::bigint), ''),
    coalesce(string_agg(t.node, '' order by t.pos) filter (t.pos > s.pos // ({ARITY} ** t.lvl)::bigint), '')
  from leaves l join subroots s on l.source is not distinct from s.source
    join tops t on t.n > 1 and t.pos // {ARITY} = s.pos // ({ARITY} ** (t.lvl + 1))::bigint
  group by r, t.lvl),
placed as (select *, row_number() over (partition by r order by lvl) step from ways),
proofs as (select r, sha256(string_agg(a || b, '' order by step)) proof, max(step) steps from placed group by r),
folds as (
  select r, 0::bigint step, changed cur from leaves
  union all
  select f.r, p.step, sha256(p.a || f.cur || p.b) from folds f join placed p on p.r = f.r and p.step = f.step + 1)
select l.doc_id, l.leaf, s.subroot, (select node from tops where n = 1) as root,
  coalesce(p.proof, sha256('')) as proof_sha256, f.cur as folded_root, f.cur = (select node from tops where n = 1) as verified
from leaves l join subroots s on l.source is not distinct from s.source left join proofs p on p.r = l.r
  join folds f on f.r = l.r and f.step = coalesce(p.steps, 0)
"""
