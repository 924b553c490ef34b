"""Time buckets, for keys that are too large for one task.

A window function sorts every key group in one task, and adaptive execution
cannot split it. Operators that need such an order therefore cut every group
into time buckets and carry the state from bucket to bucket in rows of its own.
What a task sorts is then one key's rows of one bucket, however long the key's
history; a narrower bucket bounds it further and costs more carried rows.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# One day. A key with a thousand rows a second has 86 million in it: take less then.
BUCKET_SECONDS = 86_400


def bucket_of(time: str, seconds: int) -> Column:
    return F.floor(F.unix_seconds(F.col(time).cast("timestamp")) / seconds)


def bucket_start(bucket: str, seconds: int) -> Column:
    return F.timestamp_seconds(F.col(bucket) * seconds)
