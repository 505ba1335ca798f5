"""The driver contract in __spark_entry__.py."""

from __future__ import annotations

import __spark_entry__ as entry
from tallyspark.constants import FINAL_COLS


def test_contract(spark):
    qs, sqls = entry.queries(), entry.oracle_sql()
    assert set(sqls) <= set(qs)
    own = {q for q in qs if not q.startswith("op") and q != "pipeline"}
    assert own == own & set(sqls)
    assert len(own) == 35
    df = entry.entry(spark)
    assert df.columns == FINAL_COLS
    assert df.count() > 0
