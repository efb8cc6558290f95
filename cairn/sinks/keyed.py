"""Upsert by key into Parquet: copy-on-write buckets and a manifest per version.

Rows lie in buckets by a hash of their key. A merge reads only the buckets its changes fall into,
decides insert, update, delete or keep for every row in one join, and writes only those buckets,
into a new folder. A manifest then names the folder of every bucket; it is the commit: readers see
the latest manifest that was written completely, and a merge that dies before it leaves the table as it
was. Folders are never changed afterwards, so older versions stay readable until ``vacuum``.

Every row carries the version that last changed it (``VERSION``), which gives an incremental read
(``changes_since``) that skips unchanged buckets. A merge whose rows change nothing rewrites nothing,
and a merge with the id of an earlier one (a replayed batch) is skipped.

One writer at a time: a merge that finds another version committed since it began fails.
Lists on the driver are bounded by the number of buckets.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Iterable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cairn.operators.core import dedupe
from cairn.session import written

VERSION = "row_version"
_BUCKET = "_bucket"
_MANIFEST = "bucket int, folder string, merge_id string, table_schema string"
_ONE_KEY = "spark.sql.requireAllClusterKeysForCoPartition"


@dataclass(frozen=True)
class KeyedTable:
    spark: SparkSession
    path: str
    key: tuple[str, ...]
    buckets: int = 16

    # ------------------------------------------------------------- versions ---

    def version(self) -> int:
        """The latest committed version, 0 before the first."""
        jvm = self.spark.sparkContext._jvm
        pattern = jvm.org.apache.hadoop.fs.Path(f"{self.path}/manifest/v=*/_SUCCESS")
        fs = pattern.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration())
        found = fs.globStatus(pattern) or []
        return max((int(f.getPath().getParent().getName()[2:]) for f in found), default=0)

    def manifest(self, version: int | None = None) -> DataFrame:
        """bucket, folder, merge_id and schema of one version."""
        v = self.version() if version is None else version
        if v == 0:
            return self.spark.createDataFrame([], _MANIFEST)
        return self.spark.read.schema(_MANIFEST).parquet(f"{self.path}/manifest/v={v}")

    def applied(self, merge_id: str) -> bool:
        """Whether a committed version carries this merge id."""
        paths = [f"{self.path}/manifest/v={v}" for v in range(1, self.version() + 1)]
        return bool(paths) and not self.spark.read.schema(_MANIFEST).parquet(*paths).where(F.col("merge_id") == merge_id).isEmpty()

    # ---------------------------------------------------------------- reads ---

    def read(self, version: int | None = None) -> DataFrame:
        """The table as of a version (the latest by default), ``VERSION`` included."""
        return self._read(self.manifest(version).collect())

    def changes_since(self, version: int) -> DataFrame:
        """Rows inserted or updated after ``version``; buckets not rewritten since are not read."""
        later = [r for r in self.manifest().collect() if int((r.folder or "0").split("-")[0]) > version]
        if not later:
            return self.read().limit(0)
        return self._read(later).where(F.col(VERSION) > version)

    def _read(self, rows: Iterable) -> DataFrame:
        rows = list(rows)
        if not rows:
            raise ValueError(f"no table at {self.path}")
        schema = T.StructType.fromJson(json.loads(rows[0].table_schema))
        paths = [f"{self.path}/data/{r.folder}/{_BUCKET}={r.bucket}" for r in rows if r.folder]
        if not paths:
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).parquet(*paths)

    # --------------------------------------------------------------- writes ---

    def create(self, rows: DataFrame, merge_id: str = "create", prefer: Sequence[str] = ()) -> int:
        """The first version. Of several rows with one key the greatest by ``prefer``, then by all
        columns, stays."""
        if self.version():
            raise ValueError(f"a table exists at {self.path}")
        rows = dedupe(rows, list(self.key), prefer=list(prefer)).select(*rows.columns, F.lit(1).cast("bigint").alias(VERSION))
        folder = self._folder(1)
        self._write(rows.withColumn(_BUCKET, self._bucket()).repartition(self.buckets, _BUCKET), folder)
        filled = self._buckets_of(folder)
        self._commit(1, {b: folder for b in filled}, merge_id, rows.schema)
        return 1

    def merge(self, changes: DataFrame, merge_id: str | None = None, *, prefer: Sequence[str] = (),
              delete: Column | None = None) -> int:
        """Upsert ``changes`` (the table's columns): rows of a known key replace its row, others are
        inserted. Changes that hold ``delete`` remove their key. Returns the version that holds them.

        Of several changes with one key the greatest by ``prefer``, then by all columns, counts.
        """
        merge_id = merge_id or uuid.uuid4().hex
        base = self.version()
        if self.applied(merge_id):
            return base
        manifest = {r.bucket: r for r in self.manifest(base).collect()}
        schema = T.StructType.fromJson(json.loads(next(iter(manifest.values())).table_schema))
        cols = [f.name for f in schema.fields if f.name != VERSION]
        gone = F.lit(False) if delete is None else F.coalesce(delete, F.lit(False))
        told = changes.select(*[F.col(f.name).cast(f.dataType) for f in schema.fields if f.name != VERSION], gone.alias("_gone"))
        told = written(dedupe(told, list(self.key), prefer=list(prefer)).withColumn(_BUCKET, self._bucket()), "merge-changes")
        touched = sorted(r[0] for r in told.select(_BUCKET).distinct().collect())          # at most ``buckets``
        present = [manifest[b] for b in touched if manifest[b].folder]
        current = self._read(present) if present else self.spark.createDataFrame([], schema)
        current = current.withColumn(_BUCKET, self._bucket())
        folder = self._folder(base + 1)
        before = self.spark.conf.get(_ONE_KEY, "true")
        self.spark.conf.set(_ONE_KEY, "false")                   # both sides are dealt by bucket, once
        try:
            merged = self._merged(current, told, cols, base + 1, max(1, len(touched)))
            self._write(merged, folder)
        finally:
            self.spark.conf.set(_ONE_KEY, before)
        old = {r[0]: r[1] for r in current.groupBy(_BUCKET).count().collect()}
        now = self._buckets_of(folder)
        changed = {b for b, (n, v) in now.items() if v == base + 1 or n != old.get(b)} | (old.keys() - now.keys())
        folders = {b: r.folder for b, r in manifest.items()} | {b: folder if b in now else None for b in changed}
        self._commit(base + 1, folders, merge_id, schema)
        return base + 1

    def _merged(self, current: DataFrame, told: DataFrame, cols: list[str], version: int, parts: int) -> DataFrame:
        a, b = current.repartition(parts, _BUCKET).alias("a"), told.repartition(parts, _BUCKET).alias("b")
        cond = F.col(f"a.{_BUCKET}") == F.col(f"b.{_BUCKET}")
        for k in self.key:
            cond = cond & F.col(f"a.{k}").eqNullSafe(F.col(f"b.{k}"))
        both = a.join(b, cond, "full_outer")
        given, known = F.col("b._gone").isNotNull(), F.col(f"a.{VERSION}").isNotNull()
        same = known & given
        for c in cols:
            same = same & F.col(f"a.{c}").eqNullSafe(F.col(f"b.{c}"))
        take = given & ~same
        out = both.where(~F.coalesce(F.col("b._gone"), F.lit(False)))
        return out.select(*[F.when(take, F.col(f"b.{c}")).otherwise(F.col(f"a.{c}")).alias(c) for c in cols],
                          F.when(take, F.lit(version)).otherwise(F.col(f"a.{VERSION}")).cast("bigint").alias(VERSION),
                          F.coalesce(f"b.{_BUCKET}", f"a.{_BUCKET}").alias(_BUCKET))

    def _bucket(self) -> Column:
        return F.pmod(F.xxhash64(*self.key), F.lit(self.buckets)).cast("int")

    @staticmethod
    def _folder(version: int) -> str:
        return f"{version}-{uuid.uuid4().hex[:12]}"

    def _write(self, rows: DataFrame, folder: str) -> None:
        rows.write.partitionBy(_BUCKET).parquet(f"{self.path}/data/{folder}")

    def _buckets_of(self, folder: str) -> dict[int, tuple[int, int]]:
        """Rows and newest row version of each bucket a write made (none where it wrote no rows)."""
        schema = T.StructType([T.StructField(VERSION, T.LongType()), T.StructField(_BUCKET, T.IntegerType())])
        rows = self.spark.read.schema(schema).parquet(f"{self.path}/data/{folder}")
        return {r[0]: (r.n, r.v) for r in rows.groupBy(_BUCKET).agg(F.count(F.lit(1)).alias("n"), F.max(VERSION).alias("v")).collect()}

    def _commit(self, version: int, folders: dict[int, str | None], merge_id: str, schema: T.StructType) -> None:
        if self.version() != version - 1:
            raise RuntimeError(f"version {version} of {self.path} was committed by another writer")
        rows = [(b, folders.get(b), merge_id, schema.json()) for b in range(self.buckets)]
        # what a writer left behind that died before its commit is replaced
        self.spark.createDataFrame(rows, _MANIFEST).coalesce(1).write.mode("overwrite").parquet(f"{self.path}/manifest/v={version}")

    def vacuum(self, keep: int = 1) -> list[str]:
        """Delete data folders that none of the ``keep`` latest versions names; returns them."""
        last = self.version()
        used = {r.folder for v in range(max(1, last - keep + 1), last + 1) for r in self.manifest(v).collect()}
        jvm = self.spark.sparkContext._jvm
        root = jvm.org.apache.hadoop.fs.Path(f"{self.path}/data")
        fs = root.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration())
        dead = [f.getPath() for f in fs.listStatus(root) if f.getPath().getName() not in used]
        for p in dead:
            fs.delete(p, True)
        return [p.getName() for p in dead]
