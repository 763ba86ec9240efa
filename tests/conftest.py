import os
import sys
import tempfile

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

SF_SMALL = "/root/testdata/sf0.001"
SF_MID = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from orderlens.session import build_session

    s = build_session(master="local[4]", app_name="orderlens-tests", extra={
        "spark.driver.memory": "4g", "spark.sql.shuffle.partitions": "4",
        "spark.checkpoint.dir": tempfile.mkdtemp(prefix="orderlens-test-shared-")})
    yield s
    s.stop()


@pytest.fixture()
def scratch(spark):
    from orderlens.session import Scratch

    with Scratch(spark) as s:
        yield s


@pytest.fixture()
def workdir():
    """A fresh scratch folder per test (never reused, never cleared)."""
    return tempfile.mkdtemp(prefix="orderlens-test-")


def write_wide(path: str, rows: list[str], header: bool = True, blank_lines: bool = False) -> str:
    """Write hand-made wide lines (fields joined by tabs) into one file."""
    os.makedirs(path, exist_ok=True)
    hdr = "\t".join(["Name", "Address", "City", "Country", "Region", "ProductName",
                     "ProductCategory", "ProductCategoryDescription", "ProductUnitPrice",
                     "QuantityOrdered", "OrderDate"])
    lines = (["", "   "] if blank_lines else []) + ([hdr] if header else [])
    for r in rows:
        lines.append(r)
        if blank_lines:
            lines.append("")
    with open(os.path.join(path, "data.tsv"), "w") as f:
        f.write("\n".join(lines) + "\n")
    return path
