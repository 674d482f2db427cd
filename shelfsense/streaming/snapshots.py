"""Totals kept as a compacted snapshot and the batches since, under a manifest that is switched in one step.

A call writes only the new batch; the totals of all earlier batches are not read. When the batches since the snapshot
have grown to a share of it, they are merged into a new one, so each row is rewritten a bounded number of times.

Layout below the store's folder: ``parts/<name>`` are tables that never change; ``manifests/<number>`` are small
texts. The manifest with the highest number says which parts count and which batch was the last. A writer puts
its parts down first and then creates the next manifest under a name that must not exist yet: until then
readers see the old state, and of two writers one fails.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable, Sequence
from dataclasses import asdict, dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfsense.streaming.increments import KEYS, batch_totals, merge_totals

NO_BATCH = -1


@dataclass(frozen=True)
class Manifest:
    """What counts: a snapshot (none at first), the parts since, rows of both, and the last batch taken."""

    number: int = 0
    snapshot: str | None = None
    snapshot_rows: int = 0
    parts: list[str] = field(default_factory=list)
    part_rows: int = 0
    last_batch: int = NO_BATCH


class _Files:
    """Small texts and folders through the file system that Spark itself uses."""

    def __init__(self, spark: SparkSession, root: str):
        self._spark, self._path = spark, spark._jvm.org.apache.hadoop.fs.Path
        self._fs = self._path(root).getFileSystem(spark._jsc.hadoopConfiguration())

    def names(self, folder: str) -> list[str]:
        at = self._path(folder)
        return [s.getPath().getName() for s in self._fs.listStatus(at)] if self._fs.exists(at) else []

    def create(self, path: str, text: str) -> None:
        """Write a text under a name that must be free: first aside, then by one rename."""
        aside = self._path(f"{path}.{uuid.uuid4().hex}.new")
        out = self._fs.create(aside, False)
        try:
            out.write(bytearray(text.encode()))
        finally:
            out.close()
        if self._fs.exists(self._path(path)) or not self._fs.rename(aside, self._path(path)):
            self._fs.delete(aside, False)
            raise FileExistsError(f"another writer has made {path}")

    def read(self, path: str) -> str:
        return "\n".join(row.value for row in self._spark.read.text(path, wholetext=True).collect())  # one small file

    def delete(self, path: str) -> None:
        self._fs.delete(self._path(path), True)


class TotalsStore:
    """Totals per user and item that grow batch by batch.

    ``compact_at``: the share of the snapshot's rows that later batches may hold before they are merged into it.
    """

    def __init__(self, spark: SparkSession, path: str, keys: Sequence[str] = tuple(KEYS), compact_at: float = 0.5):
        self.spark, self.path, self.keys, self.compact_at = spark, path.rstrip("/"), list(keys), compact_at
        self._files = _Files(spark, path)

    # --- state --------------------------------------------------------------------------------------------

    def manifest(self) -> Manifest:
        numbers = [int(n) for n in self._files.names(f"{self.path}/manifests") if n.isdigit()]
        if not numbers:
            return Manifest()
        return Manifest(**json.loads(self._files.read(f"{self.path}/manifests/{max(numbers):012d}")))

    def _switch(self, old: Manifest, **changes) -> Manifest:
        new = Manifest(**asdict(old) | changes | {"number": old.number + 1})
        self._files.create(f"{self.path}/manifests/{new.number:012d}", json.dumps(asdict(new)))
        return new

    def _write(self, df: DataFrame, name: str) -> tuple[str, int]:
        """A new part under a name of its own, and its rows, counted from what was written."""
        part = f"{name}-{uuid.uuid4().hex}"
        df.write.parquet(f"{self.path}/parts/{part}")
        return part, self._read([part]).count()

    def _read(self, parts: Sequence[str]) -> DataFrame:
        return self.spark.read.parquet(*[f"{self.path}/parts/{p}" for p in parts])

    # --- work ---------------------------------------------------------------------------------------------

    def absorb(self, purchases: DataFrame, batch_id: int) -> Manifest:
        """Take in one batch, once: a batch with a number up to the last one taken changes nothing."""
        old = self.manifest()
        if batch_id <= old.last_batch:
            return old
        part, rows = self._write(batch_totals(purchases), f"batch-{batch_id}")
        new = self._switch(old, parts=[*old.parts, part], part_rows=old.part_rows + rows, last_batch=batch_id)
        return self.compact() if new.part_rows > self.compact_at * max(new.snapshot_rows, 1) and len(new.parts) > 1 else new

    def compact(self) -> Manifest:
        """Merge snapshot and later parts into a new snapshot."""
        old = self.manifest()
        if not old.parts:
            return old
        part, rows = self._write(self.totals(), "snapshot")
        return self._switch(old, snapshot=part, snapshot_rows=rows, parts=[], part_rows=0)

    def totals(self) -> DataFrame | None:
        """Totals of all batches taken; None before the first."""
        now = self.manifest()
        if not now.parts:
            return self._read([now.snapshot]) if now.snapshot else None
        return merge_totals(self._read([*([now.snapshot] if now.snapshot else []), *now.parts]))

    def changed(self) -> DataFrame | None:
        """Totals of the keys in the newest batch alone; None when it has just been compacted.

        The snapshot is met by a join on the keys, so a batch that is small is sent to it and the rest is not shuffled.
        """
        now = self.manifest()
        if not now.parts:
            return None
        touched = self._read(now.parts[-1:]).select(*self.keys).distinct()
        everything = self._read([*([now.snapshot] if now.snapshot else []), *now.parts])
        return merge_totals(everything.join(touched, self.keys, "left_semi"))

    def vacuum(self) -> list[str]:
        """Delete parts that no longer count: merged ones, and those of writers that failed. Returns their names.

        Only for times when nobody writes or still reads an older state.
        """
        now = self.manifest()
        live = {now.snapshot, *now.parts}
        gone = [p for p in self._files.names(f"{self.path}/parts") if p not in live]
        for part in gone:
            self._files.delete(f"{self.path}/parts/{part}")
        return gone


def absorb_stream(
    arrivals: DataFrame, to_purchases: Callable[[DataFrame], DataFrame], store: TotalsStore, progress_path: str
) -> DataFrame:
    """Take in all that arrived since the last call, then return the totals so far.

    ``arrivals`` is a streaming DataFrame. A micro-batch that is replayed after a failure has the number it had before, so
    it counts once, whether the failure came before the manifest was switched or after. Before anything has arrived
    the totals are an empty table.
    """
    job = (
        arrivals.writeStream.foreachBatch(lambda batch, number: store.absorb(to_purchases(batch), number))
        .option("checkpointLocation", progress_path)
        .trigger(availableNow=True)
        .start()
    )
    job.awaitTermination()
    totals = store.totals()
    if totals is not None:
        return totals
    nothing = arrivals.sparkSession.createDataFrame([], arrivals.schema)
    return batch_totals(to_purchases(nothing)).where(F.lit(False))
