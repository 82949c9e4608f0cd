import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from conftest_llm import edge_docs, no_docs  # noqa: E402, F401


@pytest.fixture(scope="session", autouse=True)
def package_on_workers(spark):
    from pluvio.llm.shipping import ship_package
    ship_package(spark)
