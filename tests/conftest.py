"""Shared session and the three-line order file."""

from __future__ import annotations

import csv
import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from tillstar.schemas import RAW, RAW_COLUMNS  # noqa: E402
from tillstar.session import local_session  # noqa: E402

ROWS = [
    ("1", "ORD-77-1", "2022-05-10", "2022-05-14", "Standard Class", "NL-204", "Nora Lind", "Corporate", "United States",
     "Los Angeles", "California", "90012", "West", "PH-1", "Technology", "Phones", "Model \"T\", desk phone", "250.00", "2", "0.0", "50.00"),
    ("2", "ORD-77-1", "2022-05-10", "2022-05-14", "Standard Class", "NL-204", "Nora Lind", "Corporate", "United States",
     "Los Angeles", "California", "90012", "West", "CH-2", "Furniture", "Chairs", "Oak chair, low back", "120.00", "1", "0.1", "10.00"),
    ("3", "ORD-77-2", "2022-06-15", "2022-06-18", "First Class", "IM-311", "Ivo Marek", "Consumer", "United States",
     "New York City", "New York", "10001", "East", "BI-3", "Office Supplies", "Binders", "Ring binder A4", "15.50", "5", "0.0", "3.20"),
]


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = local_session(4, shuffle_partitions=4, app="tillstar-tests")
    session.sparkContext.setLogLevel("ERROR")
    session.sparkContext.setCheckpointDir(str(tmp_path_factory.mktemp("scratch")))
    yield session
    session.stop()


@pytest.fixture
def raw(spark):
    return spark.createDataFrame(ROWS, RAW)


def write_csv(path, rows, encoding="utf-8", columns=RAW_COLUMNS):
    with open(path, "w", newline="", encoding=encoding) as out:
        writer = csv.writer(out)
        writer.writerow(columns)
        writer.writerows(rows)
    return str(path)


@pytest.fixture
def csv_file(tmp_path):
    return write_csv(tmp_path / "sales.csv", ROWS)


def changed(row, **values):
    """A copy of a raw row with some columns replaced; underscores stand for blanks."""
    fields = dict(zip(RAW_COLUMNS, row))
    fields.update({name.replace("_", " "): value for name, value in values.items()})
    return tuple(fields[c] for c in RAW_COLUMNS)
