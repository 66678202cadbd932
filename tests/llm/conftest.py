from __future__ import annotations

import pytest

from tallyshelf.llm.common import ship_code


@pytest.fixture(scope="module", autouse=True)
def code_on_executors(spark):
    ship_code(spark)
