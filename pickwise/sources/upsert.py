"""Upserts as a log: deltas, a base laid out by key, and compaction by key range.

    <table>/delta/<column>=<name>/   rows as they came; a writer that runs again overwrites its own delta
    <table>/base/<run>/bucket=<b>/   merged rows, one per key, of the keys in bucket b, as of a compaction
    <table>/manifests/<id>           which run holds each bucket's current rows, and the deltas merged in
    <table>/CURRENT                  the manifest in use, replaced by one atomic rename

A key's merged row has its latest values (by the ``order`` columns) and, for ``first`` columns, the least value
ever. Merging is associative, so a merged row and later deltas give what all deltas together would.

A compaction reads the new deltas and only those buckets of the base that they touch, and writes those buckets anew; the
others stay where they are. So its work follows the delta, not the table. It changes nothing that a reader may hold:
if it dies before the pointer moves, the old manifest stays in use and the next compaction does the work again.
``retire`` deletes what the newest manifests don't need.

A read takes the base as it is, and merges in the deltas that aren't in it: only the buckets that they touch are
grouped again. One compaction of a table runs at a time; reads and appends run beside it."""

from __future__ import annotations

import json
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pickwise.sources.keyed import BUCKETS, bucket_of
from pickwise.sources.versions import POINTER, folder_names, hadoop_path, read_small, replace_small

DELTA, BASE, MANIFESTS = "delta", "base", "manifests"
EMPTY = {"buckets": 0, "files": {}, "covered": []}


class UpsertLog:
    """``keys``: a row's identity. ``latest``: columns (with types) taken from the latest row. ``order``: long columns
    that say which row is the latest; the first may be the deltas' partition column. ``first``: {merged column: delta
    column} whose least value is kept. ``bucket_key``: the key column by whose hash the base is laid out."""

    def __init__(self, spark: SparkSession, table: str, keys: list[str], latest: dict[str, T.DataType], order: list[str],
                 bucket_key: str, first: dict[str, str] | None = None, buckets: int = BUCKETS,
                 key_type: T.DataType | None = None):
        self.spark, self.table = spark, table.rstrip("/")
        self.keys, self.latest, self.order, self.first = keys, latest, order, first or {}
        self.bucket_key, self.new_buckets = bucket_key, buckets
        kt = key_type or T.IntegerType()
        self.schema = T.StructType([*[T.StructField(k, kt) for k in keys], *[T.StructField(c, t) for c, t in latest.items()],
                                    *[T.StructField(c, T.LongType()) for c in [*order, *self.first]]])

    # --- what is there

    def manifest(self) -> tuple[str | None, dict]:
        name = read_small(self.spark, f"{self.table}/{POINTER}")
        return (name, json.loads(read_small(self.spark, f"{self.table}/{MANIFESTS}/{name}"))) if name else (None, EMPTY)

    def deltas(self) -> list[str]:
        """Finished deltas."""
        names = folder_names(self.spark, f"{self.table}/{DELTA}")
        return [n for n in names if "=" in n and "_SUCCESS" in folder_names(self.spark, f"{self.table}/{DELTA}/{n}")]

    def _delta_rows(self, names: list[str]) -> DataFrame:
        root = f"{self.table}/{DELTA}"
        raw = self.spark.read.option("basePath", root).parquet(*[f"{root}/{n}" for n in names])
        kept = [F.col(f.name).cast(f.dataType).alias(f.name) for f in self.schema.fields if f.name not in self.first]
        return raw.select(*kept, *[F.col(src).cast("long").alias(c) for c, src in self.first.items()])

    def _base_rows(self, manifest: dict, buckets: list[int] | None = None) -> DataFrame:
        """Merged rows of the given buckets (None: of all)."""
        runs = [(int(b), run) for b, run in manifest["files"].items() if buckets is None or int(b) in buckets]
        if not runs:
            return self.spark.createDataFrame([], self.schema)
        return self.spark.read.schema(self.schema).parquet(*[f"{self.table}/{BASE}/{run}/bucket={b}" for b, run in runs])

    def _merged(self, rows: DataFrame) -> DataFrame:
        newest: Column = F.struct(*self.order, *self.latest)  # rows of equal order: the greater values
        row = F.max_by(F.struct(*self.latest, *self.order), newest).alias("row")
        return rows.groupBy(*self.keys).agg(row, *[F.min(c).alias(c) for c in self.first]).select(
            *self.keys, "row.*", *self.first).select(*self.schema.names)

    def _touched(self, rows: DataFrame, buckets: int) -> list[int]:
        return sorted(r[0] for r in rows.select(bucket_of(self.bucket_key, buckets)).distinct().collect())

    # --- reads and writes

    def append(self, rows: DataFrame, column: str, name: str | int) -> None:
        """Write one delta; the same name again replaces it (unless it has been merged in already)."""
        rows.write.mode("overwrite").parquet(f"{self.table}/{DELTA}/{column}={name}")

    def read(self) -> DataFrame:
        """One row per key."""
        _, manifest = self.manifest()
        new = [d for d in self.deltas() if d not in set(manifest["covered"])]
        if not new:
            return self._base_rows(manifest)
        rows = self._delta_rows(new)
        if not manifest["files"]:
            return self._merged(rows)
        touched = set(self._touched(rows, manifest["buckets"]))
        rest = [int(b) for b in manifest["files"] if int(b) not in touched]
        changed = self._merged(self._base_rows(manifest, sorted(touched)).unionByName(rows))
        return changed.unionByName(self._base_rows(manifest, rest)) if rest else changed

    def compact(self) -> int:
        """Merge the new deltas into the base; returns how many there were."""
        _, manifest = self.manifest()
        new = [d for d in self.deltas() if d not in set(manifest["covered"])]
        if not new:
            return 0
        buckets = manifest["buckets"] or self.new_buckets
        rows = self._delta_rows(new)
        touched = self._touched(rows, buckets)
        merged = self._merged(self._base_rows(manifest, touched).unionByName(rows))
        run = uuid.uuid4().hex
        (merged.withColumn("bucket", bucket_of(self.bucket_key, buckets)).repartition("bucket")
         .write.partitionBy("bucket").parquet(f"{self.table}/{BASE}/{run}"))
        files = {**manifest["files"], **{str(b): run for b in touched}}
        # a delta that is gone needs no entry: merging it once more, were it written again, changes nothing
        self._publish({"buckets": buckets, "files": files,
                       "covered": sorted({*manifest["covered"], *new} & {*self.deltas()})})
        return len(new)

    def _publish(self, manifest: dict) -> None:
        taken = folder_names(self.spark, f"{self.table}/{MANIFESTS}")
        name = f"{1 + max((int(n.split('-')[0]) for n in taken), default=0):08d}-{uuid.uuid4().hex[:8]}"
        replace_small(self.spark, f"{self.table}/{MANIFESTS}/{name}", json.dumps(manifest))
        replace_small(self.spark, f"{self.table}/{POINTER}", name)

    def retire(self, keep: int = 2, drop_deltas: bool = False) -> int:
        """Delete manifests older than the newest ``keep`` up to the one in use, and the buckets that only they
        name; with ``drop_deltas`` also the deltas that all kept manifests have merged in (not where another job reads the
        deltas as its stream). Returns how many folders went."""
        now, _ = self.manifest()
        if now is None:
            return 0
        names = [n for n in folder_names(self.spark, f"{self.table}/{MANIFESTS}") if n <= now and not n.endswith(".tmp")]
        kept = [json.loads(read_small(self.spark, f"{self.table}/{MANIFESTS}/{n}")) for n in names[-keep:]]
        old = {n: json.loads(read_small(self.spark, f"{self.table}/{MANIFESTS}/{n}")) for n in names[:-keep]}
        needed = {(b, run) for m in kept for b, run in m["files"].items()}
        gone = {f"{BASE}/{run}/bucket={b}" for m in old.values() for b, run in m["files"].items() if (b, run) not in needed}
        if drop_deltas:
            merged = set.intersection(*[set(m["covered"]) for m in kept])
            gone |= {f"{DELTA}/{d}" for d in self.deltas() if d in merged}
        for name in sorted(gone) + [f"{MANIFESTS}/{n}" for n in old]:
            p, fs = hadoop_path(self.spark, f"{self.table}/{name}")
            fs.delete(p, True)
        return len(gone)
