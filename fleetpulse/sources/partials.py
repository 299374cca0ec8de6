"""Stored partial aggregates and windows kept up to date from them (O-17).

Every batch of events leaves its pane histogram (key, pane, value -> count,
first / last time) in a folder named by the batch's id, and the windows that
its panes touch, computed anew over everything stored up to that batch, in
another. A window's current result is the one of its latest batch, so late
panes replace the results of the windows they touch and of no others. A batch
that is written again overwrites its own folders: replays change nothing.

Only the panes that can reach a touched window are read, by static
filters on the panes' dates; the events themselves are never read
again. ``fold`` merges the batches up to one into a base, so that neither the
number of folders nor the partials of one pane grow with the number of
batches.

Batch ids are integers that rise with every new batch, as Structured
Streaming numbers its own; one writer per table is assumed.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ..operators.windows import pane_partials, parse_duration_ms, windows_from_partials
from ..session import delete_path, path_exists, read_number, write_number

DAY_MS = 86_400_000


class WindowStore:
    """Pane partials and window results in a (shared) folder."""

    def __init__(self, spark: SparkSession, path: str, size, slide=None, keys: Sequence[str] = ("device_id",),
                 value: str = "cpu_usage", time: str = "timestamp"):
        self.spark, self.path = spark, path.rstrip("/")
        self.size_ms = parse_duration_ms(size)
        self.slide_ms = self.size_ms if slide is None else parse_duration_ms(slide)
        self.pane_ms = math.gcd(self.size_ms, self.slide_ms)
        self.keys, self.value, self.time = list(keys), value, time

    # ------------------------------------------------------------------
    # Folders: panes/batch_id=N/pane_date=D, base/upto=N/pane_date=D, windows/batch_id=N.

    def _at(self, *parts: str) -> str:
        return "/".join([self.path, *parts])

    def _folded(self) -> int:
        """The batch up to which partials are merged in the base (-1: none)."""
        n = read_number(self.spark, self._at("_folded"))
        return -1 if n is None else n

    def _read(self, kind: str, schema: StructType, partitions: str) -> DataFrame:
        schema = StructType(schema.fields + StructType.fromDDL(partitions).fields)
        if not path_exists(self.spark, self._at(kind)):
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).parquet(self._at(kind))

    def _schemas(self) -> tuple[StructType, StructType]:
        """Schemas of the stored panes and windows, as the first batch left them."""
        return tuple(self.spark.read.parquet(self._at(f"schema-{kind}")).schema for kind in ("panes", "windows"))

    def _partials_of(self, events: DataFrame) -> DataFrame:
        # Rows with a null key or time are in no window.
        for c in [*self.keys, self.time]:
            events = events.filter(F.col(c).isNotNull())
        return pane_partials(events, self.pane_ms, self.keys, self.value, self.time)

    def _rolled(self, partials: DataFrame, touched: str | None = None) -> DataFrame:
        return windows_from_partials(partials, self.size_ms, self.slide_ms, self.pane_ms, self.keys, self.value,
                                     touched=touched)

    # ------------------------------------------------------------------

    def partials(self, schema: StructType | None = None, upto: int | None = None, of: int | None = None) -> DataFrame:
        """All stored partials (the base and the batches after it), up to a
        batch if one is named; ``of`` adds whether a row is that batch's
        (column ``_mine``)."""
        schema = schema or self._schemas()[0]
        folded = self._folded()
        fresh = self._read("panes", schema, "batch_id long, pane_date date").filter(F.col("batch_id") > F.lit(folded))
        if upto is not None:
            fresh = fresh.filter(F.col("batch_id") <= F.lit(upto))
        if of is not None:
            fresh = fresh.withColumn("_mine", F.col("batch_id") == F.lit(of))
        fresh = fresh.drop("batch_id")
        if folded < 0:
            return fresh
        base = self._read("base", schema, "upto long, pane_date date").filter(F.col("upto") == F.lit(folded))
        if of is not None:
            base = base.withColumn("_mine", F.lit(False))
        return base.drop("upto").unionByName(fresh)

    def append(self, events: DataFrame, batch_id: int) -> None:
        """Store a batch's partials, then the windows it touches. A batch
        that a fold has merged already is stored; it is passed over."""
        if batch_id <= self._folded():
            return
        part = self._partials_of(events)
        for kind, like in (("panes", part), ("windows", self._rolled(part))):
            if not path_exists(self.spark, self._at(f"schema-{kind}", "_SUCCESS")):
                self.spark.createDataFrame([], like.schema).write.mode("overwrite").parquet(self._at(f"schema-{kind}"))
        where = self._at("panes", f"batch_id={batch_id}")
        (part.withColumn("pane_date", F.to_date(F.timestamp_millis("pane_start")))
         .repartitionByRange("pane_date", *self.keys, "pane_start", self.value)
         .write.mode("overwrite").partitionBy("pane_date").parquet(where))
        self._refresh(batch_id)

    def _refresh(self, batch_id: int) -> None:
        pane_schema, window_schema = self._schemas()
        mine = self._read("panes", pane_schema, "batch_id long, pane_date date") \
            .filter(F.col("batch_id") == F.lit(batch_id))
        dates = sorted(r[0] for r in mine.select("pane_date").distinct().collect())
        out = self._at("windows", f"batch_id={batch_id}")
        if not dates:
            self.spark.createDataFrame([], window_schema).write.mode("overwrite").parquet(out)
            return
        # Panes within a window's size of a touched pane: whole dates around the
        # batch's own, and of those the keys' tiles of that size beside a touched one.
        days = -(-self.size_ms // DAY_MS)
        near = set()
        for d in dates:
            near.update(d.toordinal() + k for k in range(-days, days + 1))
        reach = [type(dates[0]).fromordinal(n) for n in sorted(near)]
        tile = F.col("pane_start") - F.pmod("pane_start", F.lit(self.size_ms))
        tiles = mine.select(*self.keys, tile.alias("_tile")).distinct().select(*self.keys, F.explode(F.array(*[
            F.col("_tile") + F.lit(k * self.size_ms) for k in (-1, 0, 1)])).alias("_tile")).distinct()
        kept = self.partials(pane_schema, batch_id, of=batch_id).filter(F.col("pane_date").isin(reach)) \
            .drop("pane_date").withColumn("_tile", tile).join(tiles, on=[*self.keys, "_tile"], how="left_semi")
        (self._rolled(kept.drop("_tile"), touched="_mine").select(*[f.name for f in window_schema.fields])
         .write.mode("overwrite").parquet(out))

    def _results(self) -> DataFrame:
        """Every stored result with its batch: the base and what came after."""
        schema, folded = self._schemas()[1], self._folded()
        fresh = self._read("windows", schema, "batch_id long").filter(F.col("batch_id") > F.lit(folded))
        if folded < 0:
            return fresh
        base = self._read("window-base", fresh.schema, "upto long").filter(F.col("upto") == F.lit(folded))
        return base.drop("upto").unionByName(fresh)

    def _latest(self) -> DataFrame:
        rows = self._results()
        gkeys = [*self.keys, "win_start"]
        rest = [c for c in rows.columns if c not in gkeys]
        # One row a window and batch, so its columns may be taken one by one; numbers alone are hashed, not sorted.
        return rows.groupBy(*gkeys).agg(*[F.max_by(c, "batch_id").alias(c) for c in rest]).select(*rows.columns)

    def windows(self) -> DataFrame:
        """Every window's current result: that of its latest batch."""
        return self._latest().drop("batch_id")

    def touched_by(self, batch_id: int) -> DataFrame:
        """The windows that a batch replaced, as of that batch (none once it is folded)."""
        return self._read("windows", self._schemas()[1], "batch_id long") \
            .filter(F.col("batch_id") == F.lit(batch_id)).drop("batch_id")

    def fold(self, upto: int) -> None:
        """Merge the partials and results of the batches up to ``upto``, the
        latest that was appended, into the base. The mark is set after the
        base is written whole; a fold that was cut off is written again.
        Folders that the mark makes superfluous go last, when readers leave
        them out already."""
        before = self._folded()
        if upto <= before:
            return
        sums = (self.partials().groupBy(*self.keys, "pane_start", self.value, "pane_date")
                .agg(F.sum("c").alias("c"), F.min("mn").alias("mn"), F.max("mx").alias("mx")))
        (sums.repartitionByRange("pane_date", *self.keys, "pane_start", self.value)
         .write.mode("overwrite").partitionBy("pane_date").parquet(self._at("base", f"upto={upto}")))
        self._latest().write.mode("overwrite").parquet(self._at("window-base", f"upto={upto}"))
        write_number(self.spark, self._at("_folded"), upto)
        for n in range(before + 1, upto + 1):
            delete_path(self.spark, self._at("panes", f"batch_id={n}"))
            delete_path(self.spark, self._at("windows", f"batch_id={n}"))
        if before >= 0:
            delete_path(self.spark, self._at("base", f"upto={before}"))
            delete_path(self.spark, self._at("window-base", f"upto={before}"))
