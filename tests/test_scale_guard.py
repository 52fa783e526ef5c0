"""What must not appear in the library, whatever the data."""

import pathlib
import re

import pytest

PACKAGE = pathlib.Path(__file__).parent.parent / "millrace"
FILES = sorted(p for p in PACKAGE.rglob("*.py") if "llm" not in p.relative_to(PACKAGE).parts)

# Files that may bring a few rows to the driver: column names of one table, one load mark, paths of files to be read,
# which Spark's own readers hold on the driver as well.
BOUNDED = {
    "operators/columns.py": 1,  # business names: at most one row per column
    "sources/registry.py": 2,  # columns of one table
    "sources/load_log.py": 1,  # one mark
    "sources/ingest.py": 2,  # one row of sums, the paths of one read
    "streaming/ingest.py": 2,  # batch numbers, the paths of one batch
    "sources/versioned.py": 3,  # one row per live file or change
    "sources/kept_totals.py": 1,  # months of a load
    "operators/digests.py": 1,  # nodes of a tree
}


@pytest.mark.parametrize("path", FILES, ids=lambda p: str(p.relative_to(PACKAGE)))
def test_forbidden_calls(path):
    text = path.read_text()
    name = str(path.relative_to(PACKAGE))
    if name == "testing/oracle.py":
        return
    rows_to_driver = re.findall(r"\.(?:collect|first|head|take|toPandas|toLocalIterator)\(\)", text)
    assert len(rows_to_driver) <= BOUNDED.get(name, 0), rows_to_driver
    for word in ("localCheckpoint", "crossJoin", ".rdd", "F.udf", "pandas_udf", "now()", "current_date("):
        assert word not in text, word


@pytest.mark.parametrize("path", FILES, ids=lambda p: str(p.relative_to(PACKAGE)))
def test_every_window_has_keys(path):
    assert not re.search(r"Window\.(orderBy|rowsBetween|rangeBetween)\(", path.read_text())


# The only hints: one row per calendar period, the heavy keys, 8 per join partition at most, and one
# row per bucket of digests.
BROADCASTS = {"operators/snapshots.py": 1, "plans/orders.py": 1, "operators/skew.py": 1, "operators/digests.py": 1}


@pytest.mark.parametrize("path", FILES, ids=lambda p: str(p.relative_to(PACKAGE)))
def test_broadcast_hints_are_bounded(path):
    assert path.read_text().count("broadcast(") == BROADCASTS.get(str(path.relative_to(PACKAGE)), 0)
