"""Running sums of a hot cell in two levels."""

import random
from fractions import Fraction

import numpy as np
import pandas as pd
import pyarrow as pa
import pytest
from conftest import at
from pyspark.sql import functions as F
from test_streaming import CELLS, run, stream, write

from rivulet.operators import neighbors
from rivulet.streaming.neighbors import PARTS, CellSum, neighbor_mean_stream, pack_blocks, unpack_blocks


class Value:
    value = None

    def exists(self):
        return self.value is not None

    def get(self):
        return self.value

    def update(self, value):
        self.value = value


class Handle:
    def getValueState(self, *_):
        return Value()


def changes(n, seed, largest, stretch=60):
    rng = np.random.default_rng(seed)
    micros = np.sort(rng.integers(0, 600_000_000, n))
    return pd.DataFrame(
        {
            "timestamp": pd.to_datetime(micros, unit="us"),
            "cell": 5,
            "sensorid": [f"s{i}" for i in rng.integers(0, 50, n)],
            "conValue": 1.0,
            "whole": rng.integers(-largest, largest, n, endpoint=True),
            "part": rng.integers(-PARTS + 1, PARTS, n),
            "step": rng.integers(0, 2, n),
            "probe": rng.random(n) < 0.9,
            "stretch": micros // (stretch * 1_000_000),
        }
    )


def through(frame, state, block_rows):
    """The blocks of every stretch, packed apart and given in any order, then their means."""
    packed = [pack_blocks(own, block_rows) for _, own in frame.groupby("stretch")]
    random.Random(0).shuffle(packed)
    [carried] = state.handleInputRows((5,), iter(packed), None)
    batch = pa.RecordBatch.from_pandas(carried.astype({"cell": "int64"}))
    return packed, pd.concat([b.to_pandas() for b in unpack_blocks(iter([batch]))], ignore_index=True)


def exact_means(frame, total=Fraction(0), count=0):
    out = []
    for whole, part, step, probe in zip(frame.whole.tolist(), frame.part.tolist(), frame.step.tolist(), frame.probe, strict=True):
        total, count = total + whole + Fraction(part, PARTS), count + step
        if probe:
            out.append(float(total) / count if count > 0 else None)
    return out, total, count


@pytest.mark.parametrize("largest", [100, 2 * 10**18])
def test_blocks_give_exact_running_means(largest):
    frame = changes(3000, 1, largest).sort_values(["timestamp", "sensorid"], kind="stable", ignore_index=True)
    state = CellSum()
    state.init(Handle())
    _, first = through(frame, state, 64)
    wanted, total, count = exact_means(frame)
    got = [None if pd.isna(m) else m for m in first.sort_values("timestamp", kind="stable").cellMean]
    assert sorted(map(repr, got)) == sorted(map(repr, wanted))
    _, then = through(frame, state, 4096)  # state carries over
    wanted, _, _ = exact_means(frame, total, count)
    assert sorted(map(repr, then.cellMean.tolist())) == sorted(map(repr, wanted))


def test_a_million_readings_pass_the_cell_as_few_rows():
    frame = changes(1_000_000, 2, 1000)
    state = CellSum()
    state.init(Handle())
    packed, means = through(frame, state, 4096)
    assert len(packed) == 10 and max(len(p) for p in packed) < 30  # ten tasks; blocks of a stretch
    assert sum(map(len, packed)) < 300 and len(means) == int(frame.probe.sum())


def test_hot_cell_equals_batch(spark, rows, tmp_path):
    rng = random.Random(3)
    data = [(f"s{rng.randrange(40)}", at(i * 0.02), 1, rng.randrange(10**13) / 10**10) for i in range(20_000)]
    data += [(f"t{i % 3}", at(i), 2, float(i)) for i in range(30)]
    folder = write(spark, data, CELLS, tmp_path / "hot", files=2)
    batch = neighbors.neighbor_mean(spark.read.parquet(folder))
    means = neighbor_mean_stream(stream(spark, folder, CELLS), stretch_seconds=30, block_rows=500)
    out = run(spark, means.withColumn("task", F.spark_partition_id()), "hot", tmp_path)
    columns = ["sensorid", "timestamp", "gridCell", "conValue", "cellMean"]
    assert rows(out, *columns) == rows(batch, *columns)  # to the last digit
    tasks = [r["count"] for r in out.where("gridCell = 1").groupBy("task").count().collect()]
    assert len(tasks) == 4 and max(tasks) < 0.5 * len(data)
