"""Centroid clustering: Lloyd's rounds over vectors that are cut by columns.

Vectors become integers, ``floor(SCALE * x)``, and are written once as column
blocks: a row holds ``COLUMNS`` components of one chunk of vectors.  The blocks
are dealt to shards of one column block each, so that a task needs only the slice
of the centroids that its columns have.  A round is

1. every shard: exact squared distances of its columns to its centroid slices,
2. ``reduceByKey`` by chunk: blocks are added up, the nearest centroid is taken
   (ties: the smaller number),
3. the chosen numbers, a byte per vector, go back to the shards of the chunk, and
   every shard sums its own columns and updates its own centroid slice.

Components are moved once, by the first dealing; Spark keeps its shuffle output for
all rounds, and writes it again from the written blocks where an executor is lost.
A round moves one small matrix (vectors x centroids) per block.  The driver holds
the centroids, nothing that grows with the vectors.

All numbers are exact.  Blocks with components so large that a distance might
not fit 64 bits are reckoned in Python's integers; a distance or a sum beyond the
largest long is reported as the largest long.

Vectors that are null, have another number of components, or a component that is
null or not finite (also after scaling) are left out.  Every other row is returned,
repeated ones each; a null vec_id is hashed as empty text.  Equal starting
vectors leave the later centroids empty, and these stay where they are.  Fewer
vectors than clusters start fewer centroids; an empty table gives an empty result.
Only the id and the vector are read; further columns, whatever their names, are not.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator
from functools import partial
from typing import Any

import numpy as np
import pyarrow as pa
from pyspark import RDD, TaskContext
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from gridloom.llm.common import Scratch, table

COMPONENTS = 64
SCALE = 1024
CLUSTERS = 8
ROUNDS = 10
SEED = 3

#: Components of one column block, and chunks that a shard has at most.
COLUMNS = 32
CHUNKS_PER_SHARD = 64

LARGEST = (1 << 63) - 1

Centroids = list[list[int]]
Block = tuple[np.ndarray, list | None]


def kept(vectors: DataFrame, components: int, scale: int, vector: str = "embedding") -> Column:
    """Whether a row has a vector of the right length and of finite numbers."""
    finite = lambda x: x.isNotNull() & (F.abs(x.cast("double") * float(scale)) < float("inf"))
    return F.coalesce((F.size(vector) == components) & F.forall(vector, finite), F.lit(False))


def start_vectors(vectors: DataFrame, clusters: int, seed: int, scale: int) -> Centroids:
    """The vectors whose hashed ids come first; ``vectors`` has ``_id`` and ``_v``."""
    name = F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("_id").cast("string"), F.lit("")))
    first = vectors.select(F.sha2(name, 256).alias("_hash"), "_v").orderBy("_hash", "_v").limit(clusters)
    return [[math.floor(scale * float(x)) for x in row["_v"]] for row in first.collect()]


def _cut(rows: Iterator[pa.RecordBatch], scale: int, columns: int, narrow: int) -> Iterator[pa.RecordBatch]:
    """A row per chunk and column block; block 0 also carries the ids."""
    part, chunk = TaskContext.get().partitionId() << 33, 0
    for batch in rows:
        if not batch.num_rows:
            continue
        values = batch.column("_v").flatten().to_numpy(zero_copy_only=False).astype(np.float64)
        grid = np.floor(values.reshape(batch.num_rows, -1) * scale)
        cuts = [grid[:, at : at + columns] for at in range(0, grid.shape[1], columns)]
        # Rounded down, a double is a whole number, so it is stored exactly either way.
        small = [bool((np.abs(cut) < narrow).all()) for cut in cuts]
        yield pa.RecordBatch.from_pydict(
            {
                "chunk": pa.array([part + chunk] * len(cuts), pa.int64()),
                "block": pa.array(range(len(cuts)), pa.int32()),
                "narrow": pa.array(small),
                "data": pa.array([c.astype("<i4" if s else "<f8").tobytes() for c, s in zip(cuts, small)], pa.binary()),
                "ids": pa.array([batch.column("_id").to_pylist()] + [None] * (len(cuts) - 1), pa.list_(pa.int64())),
                "n": pa.array([batch.num_rows] * len(cuts), pa.int32()),
            }
        )
        chunk += 1


def _block(row: Any) -> tuple[tuple[int, int], Block]:
    data = np.frombuffer(row["data"], "<i4" if row["narrow"] else "<f8").reshape(row["n"], -1)
    if not row["narrow"]:
        data = np.array([[int(x) for x in line] for line in data], dtype=object)
    return (row["block"], row["chunk"]), (data, row["ids"])


def distances(block: np.ndarray, centroids: Centroids, blocks: int, narrow: int) -> np.ndarray:
    """Squared distances of rows to centroid slices, in the narrowest exact type."""
    if block.dtype == object or any(abs(x) >= narrow for c in centroids for x in c):
        wide = block.astype(object)
        return np.stack([((wide - np.array(c, dtype=object)) ** 2).sum(axis=1) for c in centroids], axis=1)
    rows = block.astype(np.int64)
    out = np.empty((len(rows), len(centroids)), np.int64)
    for number, centroid in enumerate(centroids):
        apart = rows - np.array(centroid, np.int64)
        np.einsum("ij,ij->i", apart, apart, out=out[:, number])
    # Below this bound the sum over all blocks fits 32 bits, too.
    return out.astype(np.int32) if out.max(initial=0) <= (1 << 31) // blocks - 1 else out


def _partial(
    item: tuple[tuple[int, int], Block], slices: list[Centroids], narrow: int
) -> tuple[int, tuple[np.ndarray, list | None]]:
    (block, chunk), (data, ids) = item
    return chunk, (distances(data, slices[block], len(slices), narrow), ids)


def _add(one: tuple, other: tuple) -> tuple:
    return one[0] + other[0], one[1] if one[1] is not None else other[1]


def _nearest(found: tuple[np.ndarray, list | None]) -> np.ndarray:
    return np.argmin(found[0], axis=1).astype(np.int32 if found[0].shape[1] > 255 else np.uint8)


def _sums(items: Iterator[tuple[tuple[int, int], Any]], clusters: int) -> Iterator[tuple[int, np.ndarray]]:
    """Per column block of a partition, each cluster's count and component sums.

    Numbers and blocks of one chunk meet here whichever comes first.
    """
    waiting: dict[tuple[int, int], Any] = {}
    sums: dict[int, np.ndarray] = {}
    for key, value in items:
        if key not in waiting:
            waiting[key] = value
            continue
        other = waiting.pop(key)
        numbers, (data, _) = (other, value) if isinstance(value, tuple) else (value, other)
        total = sums.setdefault(key[0], np.zeros((clusters, data.shape[1] + 1), dtype=object))
        for number in np.unique(numbers).tolist():
            mine = data[numbers == number]
            add = mine.sum(axis=0) if mine.dtype == object else mine.sum(axis=0, dtype=np.int64)
            total[number] += np.array([len(mine), *add.tolist()], dtype=object)
    if waiting:
        raise RuntimeError(f"{len(waiting)} blocks or numbers without their counterpart")
    yield from sums.items()


def _place(key: tuple[int, int], per: int) -> int:
    """The shard of a block: shards of different column blocks are different."""
    return key[0] * per + (key[1] ^ key[1] >> 33) % per


class Lloyd:
    """The rounds over one set of shards."""

    def __init__(self, vectors: DataFrame, scratch: Scratch, components: int, scale: int, columns: int) -> None:
        self.spark = vectors.sparkSession
        self.columns = columns
        self.blocks = -(-components // columns)
        # Differences under twice this bound, squared and summed, fit 62 bits.
        self.narrow = min(1 << 31, math.isqrt((1 << 62) // components) // 2)
        schema = "chunk long, block int, narrow boolean, data binary, ids array<long>, n int"
        cut = partial(_cut, scale=scale, columns=columns, narrow=self.narrow)
        self.written = scratch.settle(vectors.mapInArrow(cut, schema))
        chunks = self.written.where("block = 0").count()
        cores = self.spark.sparkContext.defaultParallelism
        per = max(1, -(-chunks // CHUNKS_PER_SHARD), min(chunks, -(-cores // self.blocks)))
        self.parts, self.place = per * self.blocks, partial(_place, per=per)
        self.shards: RDD = self.written.rdd.map(_block).partitionBy(self.parts, self.place)

    def slices(self, centroids: Centroids) -> list[Centroids]:
        at = range(0, self.blocks * self.columns, self.columns)
        return [[c[i : i + self.columns] for c in centroids] for i in at]

    def measured(self, centroids: Centroids, ids: bool = False) -> RDD:
        """Per chunk its distances to all centroids, added up over the column blocks."""
        task = partial(_partial, slices=self.slices(centroids), narrow=self.narrow)
        shards = self.shards if ids else self.shards.mapValues(lambda block: (block[0], None))
        return shards.map(task).reduceByKey(_add, numPartitions=self.parts)

    def round(self, centroids: Centroids) -> Centroids:
        """One assignment and update; a cluster without vectors keeps its centroid."""
        blocks, clusters = self.blocks, len(centroids)
        numbers = (
            self.measured(centroids)
            .mapValues(_nearest)
            .flatMap(lambda item: [((block, item[0]), item[1]) for block in range(blocks)])
            .partitionBy(self.parts, self.place)
        )
        # Dealt alike, numbers and shards meet without moving the shards.
        sums = numbers.union(self.shards).mapPartitions(partial(_sums, clusters=clusters))
        updated = sums.reduceByKey(lambda a, b: a + b, numPartitions=blocks).mapValues(np.ndarray.tolist).collectAsMap()
        out: Centroids = []
        for number, before in enumerate(centroids):
            lines = [updated[block][number] for block in range(blocks)]
            out.append([total // line[0] for line in lines for total in line[1:]] if lines[0][0] else before)
        return out

    def assigned(self, centroids: Centroids) -> DataFrame:
        """``vec_id``, ``cluster`` and ``distance`` of every vector."""

        def rows(item: tuple[int, tuple[np.ndarray, list]]) -> list[tuple]:
            found, ids = item[1]
            least = [min(x, LARGEST) for x in found.min(axis=1).tolist()]
            return list(zip(ids, _nearest((found, None)).tolist(), least))

        found = self.measured(centroids, ids=True).flatMap(rows)
        return self.spark.createDataFrame(found, "vec_id long, cluster int, distance long", verifySchema=False)


def cluster(
    vectors: DataFrame,
    clusters: int = CLUSTERS,
    rounds: int = ROUNDS,
    components: int = COMPONENTS,
    scale: int = SCALE,
    seed: int = SEED,
    columns: int = COLUMNS,
    id_column: str = "vec_id",
    vector: str = "embedding",
) -> tuple[DataFrame, Centroids]:
    """Every kept vector with its cluster and squared distance, and the final centroids."""
    scratch = Scratch(vectors.sparkSession, "clustering")
    rows = vectors.where(kept(vectors, components, scale, vector)).select(
        F.col(id_column).cast("long").alias("_id"), F.col(vector).alias("_v")
    )
    centroids = start_vectors(rows, clusters, seed, scale)
    if not centroids:
        return vectors.sparkSession.createDataFrame([], "vec_id long, cluster int, distance long"), []
    lloyd = Lloyd(rows, scratch, components, scale, columns)
    for _ in range(rounds):
        centroids = lloyd.round(centroids)
    assigned = scratch.settle(lloyd.assigned(centroids))
    scratch.drop(lloyd.written)
    return assigned, centroids


def op11_centroid_clustering(spark: SparkSession, sf_dir: str) -> DataFrame:
    assigned, centroids = cluster(table(spark, sf_dir, "embeddings"))
    exact = F.sum(F.col("distance").cast("decimal(38,0)"))
    sums = {r["cluster"]: int(r["total"]) for r in assigned.groupBy("cluster").agg(exact.alias("total")).collect()}
    inertia = min(sum(sums.values()), LARGEST)
    named = [
        (number, min(sums.get(number, 0), LARGEST), hashlib.sha256(",".join(map(str, c)).encode()).hexdigest())
        for number, c in enumerate(centroids)
    ]
    # A row per centroid.
    per = spark.createDataFrame(named, "cluster int, cluster_inertia long, centroid_sha256 string")
    return assigned.join(F.broadcast(per), "cluster").select(
        "vec_id", "cluster", "distance", "cluster_inertia", F.lit(inertia).cast("long").alias("inertia"), "centroid_sha256"
    )


def _oracle() -> str:
    """The same rounds in SQL, on rows of (vector, component)."""
    steps = [
        f"""kept as (select row_number() over () r, vec_id,
          list_transform(embedding, lambda x: floor({SCALE} * x::double)::bigint) v from embeddings
          where len(embedding) = {COMPONENTS} and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0)""",
        f"""c0 as (select row_number() over (order by sha256('{SEED}:' || vec_id::varchar), v) - 1 c, v from kept
          qualify c < {CLUSTERS})""",
    ]
    for n in range(ROUNDS + 1):
        steps.append(
            f"""d{n} as (select r, c, list_sum(list_transform(list_zip(kept.v, c{n}.v),
              lambda z: (z[1] - z[2]) * (z[1] - z[2])))::bigint distance from kept cross join c{n}),
          a{n} as materialized (select r, c, distance from d{n}
              qualify row_number() over (partition by r order by distance, c) = 1)"""
        )
        if n < ROUNDS:
            steps.append(
                f"""p{n} as (select c, unnest(kept.v) x, unnest(range({COMPONENTS})) i from a{n} join kept using (r)),
          s{n} as (select c, i, sum(x)::bigint s, count(*) n from p{n} group by all),
          u{n} as (select c, list((s - ((s % n) + n) % n) // n order by i) v from s{n} group by c),
          c{n + 1} as materialized (select c{n}.c c, coalesce(u{n}.v, c{n}.v) v from c{n} left join u{n} using (c))"""
            )
    last = ROUNDS
    return (
        "with "
        + ",\n".join(steps)
        + f""" select vec_id, a.c::int as cluster, distance, sum(distance) over (partition by a.c)::bigint as cluster_inertia,
        sum(distance) over ()::bigint as inertia,
        sha256(array_to_string(list_transform(z.v, lambda x: x::varchar), ',')) as centroid_sha256
        from a{last} a join kept using (r) join c{last} z on z.c = a.c"""
    )


ORACLE_SQL = _oracle()
