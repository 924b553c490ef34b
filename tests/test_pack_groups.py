"""Stretches of several cells packed in one call."""

import pandas as pd
import pyarrow as pa
from test_neighbor_stream import changes

from rivulet.streaming.neighbors import pack_blocks

ORDER = ["cell", "stretch", "number"]


def contents(blocks):
    """Blocks in order, and the rows in them: sliced rows may be laid out otherwise."""
    blocks = blocks.sort_values(ORDER, ignore_index=True)
    return blocks.drop(columns="rows"), [pa.ipc.open_stream(rows).read_all().to_pylist() for rows in blocks["rows"]]


def test_many_stretches_in_one_call_are_as_packed_apart():
    frames = [changes(400, seed, largest).assign(cell=cell) for cell, seed, largest in ((1, 4, 100), (2, 5, 2 * 10**18))]
    together = pd.concat(frames, ignore_index=True).sample(frac=1, random_state=1)
    apart = pd.concat([pack_blocks(own, 16) for _, own in together.groupby(["cell", "stretch"])], ignore_index=True)
    packed = pack_blocks(together, 16)
    assert len(packed) > 40
    (got, got_rows), (want, want_rows) = contents(packed), contents(apart)
    pd.testing.assert_frame_equal(got, want)
    assert got_rows == want_rows
