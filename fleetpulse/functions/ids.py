"""Deterministic result ids (§2.9-5).

The reference draws a random UUID per emission; a Spark task can run twice,
so the id is a hash of what the emission is: device, true window bounds and
revision (the number of values in the window when it was emitted; it grows
with every re-emission).
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def result_id(device: Column, win_start: Column, win_end: Column, revision: Column) -> Column:
    return F.sha2(F.concat_ws("|", device.cast("string"), win_start.cast("string"),
                              win_end.cast("string"), revision.cast("string")), 256)
