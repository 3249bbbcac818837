"""Table scans: pruning and pushdown reach the files, no shuffle is added."""

import contextlib
import io

from pyspark.sql import functions as F

from revlens.sources.tables import read_table
from tests.conftest import SF_SMALL


def test_scan_prunes_pushes_and_does_not_shuffle(spark):
    df = read_table(spark, SF_SMALL, "lineitem", ["l_orderkey", "l_quantity"])
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.where(F.col("l_quantity") > 10).explain()
    p = buf.getvalue()
    assert "Exchange" not in p
    assert "PushedFilters: [IsNotNull(l_quantity), GreaterThan(l_quantity,10.0)]" in p
    assert "ReadSchema: struct<l_orderkey:bigint,l_quantity:double>" in p
