"""Neighbourhood alerts on a stream.

The first step keeps the last cell and value of every sensor and turns readings into
changes of cell sums. What follows is a running sum over the changes of a cell, in two
levels: changes of a cell and a stretch of time are sorted and summed in tasks of their own
and packed into blocks; the state of the cell gives every block, in order of time, the sum
before it; and the blocks are unpacked again wherever there is room. So a cell with very
many readings in a micro-batch passes one task only as a few rows.

Values are summed exactly, as whole numbers and ten digits after the point.
"""

from __future__ import annotations

from collections.abc import Iterator
from decimal import Decimal

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

from rivulet.operators.neighbors import VALUE, comparable_readings, deviation_alerts, fits
from rivulet.session import use_rocksdb

# Parts of a value: one whole number, and this many parts of one.
PARTS = 10**10
# Readings in a block at most, and the stretch of time that one task sums.
BLOCK_ROWS = 4096
STRETCH_SECONDS = 60
# Groups for each shuffle partition, in which its stretches are packed; and readings sent on together.
PACK_GROUPS = 16
BATCH_ROWS = 65_536

_CHANGE = (
    "timestamp timestamp, cell bigint, sensorid string, conValue double, "
    "whole bigint, part bigint, step bigint, probe boolean"
)
_BLOCK = "cell bigint, stretch bigint, number bigint, whole bigint, part bigint, step bigint, rows binary"
_CARRIED = "cell bigint, whole string, part bigint, step bigint, rows binary"
_MEAN = "timestamp timestamp, sensorid string, gridCell bigint, conValue double, cellMean double"


class SensorChange(StatefulProcessor):
    """Last cell and value of one sensor."""

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.last = handle.getValueState("last", "time timestamp, cell bigint, whole bigint, part bigint")

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        batch = pd.concat(list(rows), ignore_index=True)
        order = np.argsort(batch["timestamp"].to_numpy(), kind="stable")
        # Plain arrays: frames take most of the time where a sensor has few readings.
        times, values = batch["timestamp"].to_numpy()[order], batch["conValue"].to_numpy("float64")[order]
        cells, wholes, parts = (batch[name].to_numpy("int64")[order] for name in ("gridCell", "whole", "part"))
        time, cell, whole, part = tuple(self.last.get() or (None, None, 0, 0))
        # Older than what the cell already knows: compared, but not stored.
        late = times < np.datetime64(time) if time is not None else np.zeros(len(times), dtype=bool)
        old, new = np.flatnonzero(late), np.flatnonzero(~late)
        none = np.zeros(len(old), dtype="int64")
        out = [(old, cells[old], none, none, none, True)]
        if len(new):
            own, whole_now, part_now = cells[new], wholes[new], parts[new]
            had = np.arange(len(new)) > (-1 if cell is not None else 0)
            own_before = _shifted(own, cell if cell is not None else 0)
            whole_before, part_before = _shifted(whole_now, whole), _shifted(part_now, part)
            stays = had & (own_before == own)
            moved = had & ~stays
            out.append((new, own, whole_now - stays * whole_before, part_now - stays * part_before, (~stays).astype("int64"), True))
            gone = np.full(int(moved.sum()), -1, dtype="int64")
            out.append((new[moved], own_before[moved], -whole_before[moved], -part_before[moved], gone, False))
            self.last.update((pd.Timestamp(times[new[-1]]).to_pydatetime(), int(own[-1]), int(whole_now[-1]), int(part_now[-1])))
        at = np.concatenate([rows for rows, *_ in out])
        probe = np.concatenate([np.full(len(rows), probe) for rows, *_, probe in out])
        cell, whole, part, step = (np.concatenate([group[i] for group in out]) for i in range(1, 5))
        yield pd.DataFrame(
            {
                "timestamp": times[at],
                "cell": cell,
                "sensorid": key[0],
                "conValue": values[at],
                "whole": whole,
                "part": part,
                "step": step,
                "probe": probe,
            }
        )


def _shifted(values: np.ndarray, first: int) -> np.ndarray:
    """The value before each, in integers: cell ids do not fit into floats."""
    return np.concatenate([[first], values[:-1]]).astype("int64")


def pack_blocks(changes: pd.DataFrame, block_rows: int) -> pd.DataFrame:
    """Changes of cells and stretches of time, those of each in order, as blocks with their own running sums."""
    own = changes.groupby(["cell", "stretch"], dropna=False, sort=False).ngroup()
    changes = changes.assign(own=own).sort_values(["own", "timestamp", "sensorid"], kind="stable", ignore_index=True)
    own = changes["own"].to_numpy()
    first = np.flatnonzero(np.diff(own, prepend=-1))
    # Running sums of a block stay within 64 bits.
    largest = np.maximum.reduceat(np.abs(changes["whole"].to_numpy("int64")), first)
    size = np.maximum(1, np.minimum(block_rows, (1 << 62) // np.maximum(1, largest)))
    number = np.arange(len(own)) - first[own]
    starts = np.flatnonzero(number % size[own] == 0)
    ends = np.append(starts[1:], len(own))
    block = np.repeat(np.arange(len(starts)), ends - starts)
    sums = {}
    for name in ("whole", "part", "step"):
        # Sums over all wrap around; the difference of two is right again.
        total = changes[name].to_numpy("int64").cumsum()
        sums[name] = total - np.where(starts > 0, total[starts - 1], 0)[block]
    probe = changes["probe"].to_numpy(bool)
    rows = pa.record_batch(
        [
            pa.array(changes["timestamp"].to_numpy("datetime64[us]").astype("int64")[probe]),
            pa.array(changes["sensorid"].to_numpy(object)[probe], pa.string()),
            pa.array(changes["conValue"].to_numpy("float64")[probe]),
            *(pa.array(total[probe]) for total in sums.values()),
        ],
        ["time", "sensorid", "value", *sums],
    )
    counts = np.bincount(block[probe], minlength=len(starts)).tolist()
    offsets = np.append(0, np.cumsum(counts)).tolist()
    return pd.DataFrame(
        {
            "cell": changes["cell"].to_numpy()[starts],
            "stretch": changes["stretch"].to_numpy()[starts],
            "number": number[starts],
            **{name: total[ends - 1] for name, total in sums.items()},
            "rows": [_packed(rows.slice(at, count)) for at, count in zip(offsets, counts, strict=False)],
        }
    )


def _packed(rows: pa.RecordBatch) -> bytes:
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, rows.schema) as writer:
        writer.write_batch(rows)
    return sink.getvalue().to_pybytes()


class CellSum(StatefulProcessor):
    """Sum and number of the latest values in one cell; blocks come out with those before them."""

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.state = handle.getValueState("sum", "whole decimal(38,0), part bigint, sensors bigint")

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        blocks = pd.concat(list(rows), ignore_index=True).sort_values(["stretch", "number"], ignore_index=True)
        whole, part, sensors = tuple(self.state.get() or (0, 0, 0))
        whole, out = int(whole), {"whole": [], "part": [], "step": []}
        for more, more_part, step in zip(blocks["whole"], blocks["part"], blocks["step"], strict=True):
            for name, value in (("whole", str(whole)), ("part", part), ("step", sensors)):
                out[name].append(value)
            carry, part = divmod(part + int(more_part), PARTS)
            whole, sensors = whole + int(more) + carry, sensors + int(step)
        self.state.update((Decimal(whole), part, sensors))
        columns = {"cell": key[0], **out, "rows": blocks["rows"].to_numpy(object)}
        yield pd.DataFrame(columns, dtype=object)


def unpack_blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Readings of blocks with the mean of their cell, those of small blocks together."""
    held, count = [], 0
    for rows in _unpacked(batches):
        held.append(rows)
        count += rows.num_rows
        if count >= BATCH_ROWS:
            yield from pa.Table.from_batches(held).combine_chunks().to_batches()
            held, count = [], 0
    if held:
        yield from pa.Table.from_batches(held).combine_chunks().to_batches()


def _unpacked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for block in batch.to_pylist():
            rows = pa.ipc.open_stream(block["rows"]).read_next_batch()
            if not rows.num_rows:
                continue
            before = int(block["whole"]) * PARTS + block["part"]
            means = [
                (before + whole * PARTS + part) / PARTS / count if count > 0 else None
                for whole, part, count in zip(
                    rows["whole"].to_pylist(),
                    rows["part"].to_pylist(),
                    (rows["step"].to_numpy() + block["step"]).tolist(),
                    strict=True,
                )
            ]
            yield pa.RecordBatch.from_arrays(
                [
                    rows["time"].cast(pa.timestamp("us")).cast(pa.timestamp("us", "UTC")),
                    rows["sensorid"],
                    pa.array([block["cell"]] * rows.num_rows, pa.int64()),
                    rows["value"],
                    pa.array(means, pa.float64()),
                ],
                ["timestamp", "sensorid", "gridCell", "conValue", "cellMean"],
            )


def neighbor_mean_stream(
    readings: DataFrame,
    include_unconverted: bool = False,
    stretch_seconds: int = STRETCH_SECONDS,
    block_rows: int = BLOCK_ROWS,
) -> DataFrame:
    """Readings with the mean of their cell as of their arrival.

    Inside a micro-batch readings are taken in event-time order. Readings that
    come later than newer ones of their sensor are compared, but do not change
    what is known. None is dropped or held back but those without a time, so no
    watermark is needed.
    Values that cannot be summed exactly come out with a NULL mean. A task sums
    the readings of one cell in ``stretch_seconds``.
    """
    use_rocksdb(readings.sparkSession)
    every = comparable_readings(readings, include_unconverted).where(F.col("timestamp").isNotNull())
    odd = every.where(~fits()).select(
        "timestamp", "sensorid", "gridCell", "conValue", F.lit(None).cast("double").alias("cellMean")
    )
    exact = F.col("conValue").cast(VALUE)
    below = (exact - F.floor(exact)).cast("decimal(11,10)")
    rows = every.where(fits()).select(
        "sensorid",
        "timestamp",
        "gridCell",
        "conValue",
        F.floor(exact).cast("bigint").alias("whole"),
        (below * F.lit(PARTS)).cast("bigint").alias("part"),
    )
    changes = rows.groupBy("sensorid").transformWithStateInPandas(
        statefulProcessor=SensorChange(),
        outputStructType=_CHANGE,
        outputMode="Append",
        timeMode="None",
    )
    stretch = F.floor(F.unix_seconds("timestamp") / stretch_seconds)
    partitions = int(readings.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    # Stretches may be many and small, so a group of them is packed in one call.
    group = F.pmod(F.xxhash64("cell", "stretch"), F.lit(partitions * PACK_GROUPS))
    blocks = (
        changes.withColumn("stretch", stretch)
        .groupBy(group.alias("group"))
        .applyInPandas(lambda frame: pack_blocks(frame, block_rows), _BLOCK)
    )
    carried = blocks.groupBy("cell").transformWithStateInPandas(
        statefulProcessor=CellSum(),
        outputStructType=_CARRIED,
        outputMode="Append",
        timeMode="None",
    )
    return carried.repartition(partitions).mapInArrow(unpack_blocks, _MEAN).unionByName(odd)


def neighbor_alerts_stream(
    readings: DataFrame, threshold: float = 10.0, include_unconverted: bool = False
) -> DataFrame:
    """Alerts for readings further than ``threshold`` from the mean of their cell."""
    return deviation_alerts(neighbor_mean_stream(readings, include_unconverted), threshold)
