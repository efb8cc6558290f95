"""Several outputs of one stream, committed together, with an audit of late rows.

One streaming query reads the source once. Each micro-batch writes every output into a folder of its
own and then one manifest; the manifest is the commit, and readers see only batches that have one. A
batch that died between two outputs is written again from the start when the stream is restarted,
and one that was committed is not written twice.

Windowed counts are kept as partial counts per batch, which add up, so two aggregations of
different keys can share a query without a state store. A row is dropped if its window ended at or
before the greatest event time of all earlier batches less the delay (Spark's own watermark lags one
batch more). That bound is kept in the manifests, so a replayed batch is judged as before. Dropped
rows are an output too, and each manifest counts rows in time, late but counted, and dropped.

``compact`` folds committed batches of an output into one folder, so reading does not slow down with the
number of batches.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass

from pyspark import StorageLevel
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cairn.plans.cache import cached

_MANIFEST = "batch long, bound_us long, in_time long, late long, dropped long"
LATE = "late_rows"


@dataclass(frozen=True)
class BatchStore:
    spark: SparkSession
    path: str

    def _committed(self, kind: str) -> list[int]:
        """Numbers ``n`` with a complete ``<kind>/n=<n>`` folder, in order (metadata only)."""
        pattern = self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{self.path}/{kind}/n=*/_SUCCESS")
        fs = pattern.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration())
        return sorted(int(f.getPath().getParent().getName()[2:]) for f in fs.globStatus(pattern) or [])

    def batches(self) -> list[int]:
        return self._committed("manifest")

    def audit(self) -> DataFrame:
        """batch, bound_us, in_time, late, dropped: one row per committed batch."""
        paths = [f"{self.path}/manifest/n={n}" for n in self.batches()]
        return self.spark.read.schema(_MANIFEST).parquet(*paths) if paths else self.spark.createDataFrame([], _MANIFEST)

    def _bound_before(self, n: int) -> int | None:
        """Greatest event time (microseconds) of the batches before ``n``; manifests carry it along."""
        earlier = [b for b in self.batches() if b < n]
        return self.spark.read.schema(_MANIFEST).parquet(f"{self.path}/manifest/n={earlier[-1]}").first().bound_us if earlier else None

    def writer(self, outputs: Mapping[str, Callable[[DataFrame], DataFrame]], *, ts: str, window_seconds: int,
               delay_seconds: int) -> Callable[[DataFrame, int], None]:
        """The ``foreachBatch`` function: every output's function gets the batch's rows that are not
        dropped; dropped rows go to the output ``LATE``. Rows without a time are dropped."""
        def write(batch: DataFrame, n: int) -> None:
            if n in self.batches():
                return
            bound = self._bound_before(n)
            us = F.unix_micros(F.col(ts).cast("timestamp"))
            size = window_seconds * 1_000_000
            edge = F.lit(None if bound is None else bound - delay_seconds * 1_000_000).cast("bigint")
            state = (F.when(us.isNull(), "dropped").when(us - F.pmod(us, F.lit(size)) + size <= edge, "dropped")
                     .when(us < edge, "late").otherwise("in_time"))
            with cached(batch.select("*", us.alias("_us"), state.alias("_state")), StorageLevel.MEMORY_AND_DISK) as rows:
                seen = Observation()
                counted = rows.observe(seen, F.max("_us").alias("top"),
                                       *[F.count_if(F.col("_state") == s).alias(s) for s in ("in_time", "late", "dropped")])
                self._put(counted.where("_state = 'dropped'").select(*batch.columns), LATE, n)
                kept = rows.where("_state <> 'dropped'").select(*batch.columns)
                for name, made in outputs.items():
                    self._put(made(kept), name, n)
                got = seen.get
            tops = [x for x in (bound, got["top"]) if x is not None]
            row = (n, max(tops) if tops else None, got["in_time"], got["late"], got["dropped"])
            self._commit("manifest", n, self.spark.createDataFrame([row], _MANIFEST))
        return write

    def _put(self, rows: DataFrame, name: str, n: int) -> None:
        rows.write.mode("overwrite").parquet(f"{self.path}/out/{name}/n={n}")

    def _commit(self, kind: str, n: int, rows: DataFrame) -> None:
        rows.coalesce(1).write.mode("overwrite").parquet(f"{self.path}/{kind}/n={n}")

    def read(self, name: str, schema: T.StructType) -> DataFrame:
        """All committed rows of an output: the latest compaction and the batches after it."""
        upto = max(self._committed(f"compact/{name}"), default=-1)
        paths = [f"{self.path}/compact/{name}/n={upto}"] if upto >= 0 else []
        paths += [f"{self.path}/out/{name}/n={n}" for n in self.batches() if n > upto]
        return self.spark.read.schema(schema).parquet(*paths) if paths else self.spark.createDataFrame([], schema)

    def compact(self, name: str, schema: T.StructType, merge: Callable[[DataFrame], DataFrame] = lambda df: df) -> int:
        """Fold an output's committed batches, merged by ``merge`` (e.g. partial counts added up), into
        one folder; returns the last batch in it. Readers switch when it is complete."""
        done = self.batches()
        if not done or done[-1] in self._committed(f"compact/{name}"):
            return done[-1] if done else -1
        merge(self.read(name, schema)).select(*schema.names).write.mode("overwrite").parquet(f"{self.path}/compact/{name}/n={done[-1]}")
        return done[-1]


def partial_counts(keys: Sequence[str], *, ts: str, size: str = "5 minutes", count_col: str = "host",
                   out: str = "num_hits", start: str = "event_hour") -> Callable[[DataFrame], DataFrame]:
    """Output function: counts per tumbling window and keys of one batch."""
    def made(rows: DataFrame) -> DataFrame:
        g = rows.groupBy(F.window(ts, size).alias("_w"), *keys).agg(F.count(count_col).alias(out))
        return g.select(F.col("_w.start").alias(start), *keys, out)
    return made


def added_up(keys: Sequence[str], out: str = "num_hits", start: str = "event_hour") -> Callable[[DataFrame], DataFrame]:
    """Merge of ``partial_counts`` rows: one row per window and keys."""
    return lambda rows: rows.groupBy(start, *keys).agg(F.sum(out).cast("bigint").alias(out))
