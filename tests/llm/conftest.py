from __future__ import annotations

import pytest

from opinio.llm.common import table


@pytest.fixture(scope="session")
def documents(spark, data):
    return table(spark, data, "documents")
