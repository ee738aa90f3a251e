import sys
from pathlib import Path

import duckdb
import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))
from gridloom.session import local_session  # noqa: E402

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    s = local_session(cores=4, shuffle_partitions=4, memory="6g")
    s.sparkContext.setLogLevel("ERROR")
    return s


@pytest.fixture(scope="session")
def small():
    return SMALL


@pytest.fixture(scope="session")
def duck():
    db = duckdb.connect()
    db.execute("SET TimeZone='UTC'")
    for p in Path(SMALL).glob("*.parquet"):
        db.execute(f"CREATE VIEW {p.stem} AS SELECT * FROM '{p}'")
    return db
