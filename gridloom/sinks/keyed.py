"""A table with one current row per key, kept up by the batches of a stream.

Batches append, nothing is rewritten for a key that changes.  Rows lie in units, a
partition value (a day, say) and a bucket of the key's hash; a batch adds one run to each
unit that it touches.  When a unit has ``FAN`` runs of one level, they are merged to one
run of the next level with the newest row of each key, so a unit has a few runs
per level however many batches came, and a row is rewritten once per level.

A manifest lists the runs that count, which batches they hold included.  Data is
written first, then a new manifest takes the old one's place by a rename: a
batch counts whole or not at all, and a batch that is sent again after its commit changes
nothing.  Runs that neither of the last two manifests lists are removed.  A table has
one writer; readers read what the manifest lists when they begin.

Callers follow one order: ask ``done``, write the batch's output by an idempotent sink,
``commit`` the rows last.
"""

from __future__ import annotations

import json
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import BooleanType, LongType, StructField, StructType

FAN = 8
WHOLE = "all"
#: Manifests that stay, so that a reader of the one before still finds its files.
KEPT_MANIFESTS = 2

_OWN = [StructField("_seq", LongType()), StructField("_gone", BooleanType())]


class KeyedTable:
    """Rows by ``keys``; of one key the greatest by ``order`` counts, then the latest batch's.

    ``partition`` names a column that the key determines, with values that stay as they
    are in a path (days, numbers); units of its values are read and expired apart.  Column ``_gone`` in a committed batch marks keys to remove.
    """

    def __init__(
        self,
        spark: SparkSession,
        path: str,
        schema: StructType,
        keys: Sequence[str],
        order: Sequence[str] = (),
        partition: str | None = None,
        buckets: int = 8,
        fan: int = FAN,
    ) -> None:
        self.spark, self.path = spark, path.rstrip("/")
        self.schema, self.keys, self.order = schema, list(keys), list(order)
        self.partition, self.buckets, self.fan = partition, buckets, fan

    # --- manifests

    def _files(self):
        where = self.spark._jvm.org.apache.hadoop.fs.Path(self.path)
        return where.getFileSystem(self.spark._jsc.hadoopConfiguration())

    def _at(self, *parts: str):
        return self.spark._jvm.org.apache.hadoop.fs.Path("/".join([self.path, *parts]))

    def _names(self, folder: str) -> list[str]:
        files, where = self._files(), self._at(folder)
        return sorted(s.getPath().getName() for s in files.listStatus(where)) if files.exists(where) else []

    def manifest(self) -> dict:
        """The newest: ``batches`` done by run, and ``units`` with their runs as [folder, level]."""
        versions = [n for n in self._names("manifests") if n.startswith("v")]
        if not versions:
            return {"version": 0, "seq": 0, "batches": {}, "units": {}, "notes": {}}
        return self._load(versions[-1])

    def _load(self, name: str) -> dict:
        stream = self._files().open(self._at("manifests", name))
        try:
            return json.loads(bytes(stream.readAllBytes()).decode())
        finally:
            stream.close()

    def _swap(self, manifest: dict) -> None:
        files = self._files()
        manifest["version"] += 1
        name = f"v{manifest['version']:012d}"
        draft = self._at("manifests", f"_draft-{name}")
        out = files.create(draft, True)
        try:
            out.write(json.dumps(manifest).encode())
        finally:
            out.close()
        if not files.rename(draft, self._at("manifests", name)):
            raise OSError(f"{self.path}: another writer made manifest {name}")
        self._clean()

    def _clean(self) -> None:
        """Remove what the last manifests do not list: old, replaced and never committed runs."""
        files = self._files()
        versions = [n for n in self._names("manifests") if n.startswith("v")]
        for name in versions[:-KEPT_MANIFESTS]:
            files.delete(self._at("manifests", name), False)
        listed = {
            folder
            for name in versions[-KEPT_MANIFESTS:]
            for runs in self._load(name)["units"].values()
            for folder, _ in runs
        }
        for name in self._names("data"):
            if name not in listed:
                files.delete(self._at("data", name), True)

    # --- reading

    def _unit_folder(self, folder: str, unit: str) -> str:
        value, bucket = unit.rsplit("/", 1)
        return f"{self.path}/data/{folder}/_p={value}/_b={bucket}"

    def _runs(self, units: dict[str, list]) -> DataFrame | None:
        paths = [self._unit_folder(folder, unit) for unit, runs in units.items() for folder, _ in runs]
        if not paths:
            return None
        stored = StructType([*self.schema.fields, *_OWN])
        return self.spark.read.schema(stored).parquet(*paths)

    def _newest(self, rows: DataFrame) -> DataFrame:
        rest = [c for c in [*self.schema.names, "_gone"] if c not in self.keys]
        row = F.max_by(F.struct(*rest), F.struct(*self.order, "_seq")).alias("_row")
        seq = F.max_by("_seq", F.struct(*self.order, "_seq")).alias("_seq")
        return rows.groupBy(*self.keys).agg(row, seq).select(
            *[F.col(c) if c in self.keys else F.col("_row")[c].alias(c) for c in self.schema.names],
            "_seq",
            F.col("_row._gone").alias("_gone"),
        )

    def units(self, partitions: Sequence[str] | None = None) -> dict[str, list]:
        wanted = None if partitions is None else set(partitions)
        found = self.manifest()["units"]
        return {u: runs for u, runs in found.items() if wanted is None or u.rsplit("/", 1)[0] in wanted}

    def partitions(self) -> list[str]:
        return sorted({u.rsplit("/", 1)[0] for u in self.manifest()["units"]})

    def current(self, partitions: Sequence[str] | None = None) -> DataFrame:
        """One row per key, of all or of the named partition values (as text)."""
        runs = self._runs(self.units(partitions))
        if runs is None:
            return self.spark.createDataFrame([], self.schema)
        return self._newest(runs).where("not _gone").select(*self.schema.names)

    # --- writing

    def done(self, run: str, batch_id: int) -> bool:
        return self.manifest()["batches"].get(run, -1) >= batch_id

    def note(self, name: str):
        """A small value that came with a batch, or None."""
        return self.manifest()["notes"].get(name)

    def commit(self, rows: DataFrame, run: str, batch_id: int, **notes) -> None:
        """Add a batch; several rows of a key are reduced to the newest first.

        ``notes`` are small values that count from the same moment on as the rows.
        """
        manifest = self.manifest()
        if manifest["batches"].get(run, -1) >= batch_id:
            return
        manifest["seq"] += 1
        if "_gone" not in rows.columns:
            rows = rows.withColumn("_gone", F.lit(False))
        rows = rows.select(
            *self.schema.names, F.lit(manifest["seq"]).cast("long").alias("_seq"), F.coalesce("_gone", F.lit(False)).alias("_gone")
        )
        folder = f"batch-{manifest['seq']:012d}"
        for unit in self._write(self._newest(rows), folder):
            manifest["units"].setdefault(unit, []).append([folder, 0])
        manifest["batches"][run] = batch_id
        manifest["notes"].update(notes)
        self._swap(manifest)
        self.compact()

    def _write(self, rows: DataFrame, folder: str) -> list[str]:
        """Write a run and name the units that it has."""
        value = F.coalesce(F.col(self.partition).cast("string"), F.lit("none")) if self.partition else F.lit(WHOLE)
        bucket = F.pmod(F.xxhash64(*self.keys), F.lit(self.buckets)).cast("int")
        placed = rows.withColumns({"_p": value, "_b": bucket}).hint("rebalance", "_p", "_b")
        path = f"{self.path}/data/{folder}"
        placed.write.mode("overwrite").partitionBy("_p", "_b").parquet(path)
        files, units = self._files(), []
        for part in files.listStatus(self._at("data", folder)):
            if part.isDirectory():
                name = part.getPath().getName().removeprefix("_p=")
                units += [f"{name}/{b.getPath().getName().removeprefix('_b=')}" for b in files.listStatus(part.getPath())]
        return units

    def compact(self) -> int:
        """Merge units with ``fan`` runs of a level, in one job per level; how many were merged.

        A merge of all runs of a unit also forgets removed keys, unless an ``order``
        may still rank a later row below the removal.
        """
        merged, level = 0, 0
        while True:
            manifest = self.manifest()
            due: dict[str, list] = {}
            for unit, runs in manifest["units"].items():
                same = [r for r in runs if r[1] == level]
                if len(same) >= self.fan:
                    due[unit] = same
            if not due:
                if level >= max((r[1] for runs in manifest["units"].values() for r in runs), default=0):
                    return merged
                level += 1
                continue
            whole = {unit for unit, same in due.items() if len(same) == len(manifest["units"][unit])}
            rows = self._newest(self._runs(due))
            if len(whole) == len(due) and not self.order:
                rows = rows.where("not _gone")
            folder = f"merge-{manifest['version']:012d}-{level}"
            written = set(self._write(rows, folder))
            for unit, same in due.items():
                rest = [r for r in manifest["units"][unit] if r not in same]
                manifest["units"][unit] = rest + ([[folder, level + 1]] if unit in written else [])
                if not manifest["units"][unit]:
                    del manifest["units"][unit]
            self._swap(manifest)
            merged += len(due)

    def expire(self, before: str) -> list[str]:
        """Drop the partition values that sort before the given one; rows are not read."""
        manifest = self.manifest()
        old = sorted({u.rsplit("/", 1)[0] for u in manifest["units"] if u.rsplit("/", 1)[0] < before})
        if old:
            manifest["units"] = {u: r for u, r in manifest["units"].items() if u.rsplit("/", 1)[0] >= before}
            self._swap(manifest)
        return old
