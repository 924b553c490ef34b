import sys
from datetime import datetime, timedelta, timezone
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parent.parent
sys.path.insert(0, str(ROOT))

from rivulet.session import build_session  # noqa: E402

START = datetime(2024, 1, 1, tzinfo=timezone.utc)


def at(seconds: float) -> datetime:
    return START + timedelta(seconds=seconds)


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    home = tmp_path_factory.mktemp("spark")
    session = build_session(
        "local[4]",
        "rivulet-tests",
        **{
            "spark.sql.shuffle.partitions": "4",
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
            "spark.driver.memory": "4g",
            "spark.sql.warehouse.dir": str(home / "warehouse"),
            "spark.checkpoint.dir": str(home / "checkpoints"),
            "spark.log.level": "ERROR",
        },
    )
    yield session
    session.stop()


@pytest.fixture
def rows():
    """Collected rows as sorted dicts; times become seconds since the test start."""

    def collect(df, *columns):
        out = []
        for row in df.select(*columns).collect() if columns else df.collect():
            record = row.asDict(recursive=True)
            for key, value in record.items():
                if isinstance(value, datetime):
                    seconds = (value.replace(tzinfo=timezone.utc) - START).total_seconds()
                    record[key] = int(seconds) if seconds == int(seconds) else seconds
            out.append(record)
        return sorted(out, key=lambda r: [repr(v) for v in r.values()])

    return collect
