import pathlib
import sys

import pytest

sys.path.insert(0, str(pathlib.Path(__file__).resolve().parents[1]))

from titlepulse.session import build_session


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = build_session(
        "titlepulse-tests",
        "local[4]",
        **{
            "spark.checkpoint.dir": str(tmp_path_factory.mktemp("shared")),
            "spark.sql.shuffle.partitions": "4",
            "spark.sql.adaptive.coalescePartitions.initialPartitionNum": "4",
            "spark.driver.memory": "4g",
        },
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def seed(spark):
    from titlepulse import schemas

    rows = [
        ("fortnite", "Fortnite", None, "Fortnite", "Fortnite", "FortNiteBR", "Fortnite", ["epic"]),
        ("dota-2", "Dota 2", 570, "Dota 2", "Dota_2", "DotA2", "Dota 2", ["steam"]),
    ]
    return spark.createDataFrame(rows, schemas.SEED)


@pytest.fixture
def bronze(spark):
    """Makes raw-table rows from (source, entity_key, day, payload) and an optional arrival time."""
    import datetime as dt
    import json

    from titlepulse import schemas

    def make(*rows):
        out = []
        for n, (source, key, day, payload, *rest) in enumerate(rows):
            text = payload if payload is None or isinstance(payload, str) else json.dumps(payload)
            date = dt.date.fromisoformat(day) if day else None
            arrived = rest[0] if rest else dt.datetime(2026, 5, 1, 12, 0, n)
            out.append((source, key, date, arrived, "b", text))
        return spark.createDataFrame(out, schemas.BRONZE)

    return make


def rows_of(df, *columns):
    return sorted([tuple(r) for r in df.select(*columns).collect()], key=lambda r: tuple((v is None, str(v)) for v in r))
