import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    from sqlyard.session import build_session

    session = build_session(
        "tests", "local[4]", spark__sql__shuffle__partitions=4, spark__ui__enabled="false",
        spark__driver__memory="4g", spark__checkpoint__dir=tmp_path_factory.mktemp("shared"),
    )
    session.sparkContext.setLogLevel("ERROR")
    return session


@pytest.fixture(scope="session")
def sf():
    return SF


@pytest.fixture(scope="session")
def eval_column(spark):
    """Values of a column expression over a list of row tuples."""
    def run(rows, columns, expression):
        numbered = [(i, *r) for i, r in enumerate(rows)]
        schema = "i int, " + ", ".join(f"{c} string" for c in columns)
        found = spark.createDataFrame(numbered, schema).select("i", expression.alias("v")).collect()
        return [r["v"] for r in sorted(found, key=lambda r: r["i"])]

    return run
