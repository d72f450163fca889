"""Values outside the list of a cross table are not dropped in silence."""

import pytest

from tallyloom.operators import aggregates as ag


@pytest.mark.parametrize("other", ["X", None])
def test_cross_tab_raises_on_unlisted_values(spark, other):
    rows = spark.createDataFrame([(1, "F"), (1, "O"), (2, "F")], "k bigint, s string")
    assert sorted(map(tuple, ag.cross_tab(rows, "k", "s", ["F", "O"]).collect())) == [(1, 1, 1), (2, 1, 0)]
    with pytest.raises(Exception, match="not listed"):
        ag.cross_tab(rows.union(spark.createDataFrame([(2, other)], rows.schema)), "k", "s", ["F", "O"]).collect()
