"""Metrics of journals: a paper's own values first, then those of its ISSN; null factors and ties."""

import pytest
from pyspark.sql import functions as F

from corvina.operators import edges, relations


def test_the_largest_factor_of_an_issn_counts(spark):
    papers = spark.createDataFrame(
        [(1, "i1", None, None), (2, "i1", "9.5", None), (3, "i2", None, None), (4, "i3", None, None), (5, "", None, None), (6, "i9", None, None), (7, None, None, "Q2")],
        "id int, issn string, impact_factor string, quartile string",
    )
    journals = spark.createDataFrame(
        [("i1", None, "Q1"), ("i1", "2.5", "Q3"), ("i1", "7.25", "Q2"), ("i1", "7.25", "Q1"), ("i2", None, "Q4"), ("i2", None, "Q2"), ("i3", "0.5", None)],
        "issn string, factor string, quartile string",
    )
    rows = {r.id: (r.impact_factor, r.quartile, r.metric_source) for r in edges.journal_metrics(papers, journals).collect()}
    assert rows == {
        1: (7.25, "Q1", "issn"),
        2: (9.5, None, "inline"),
        3: (None, "Q2", "issn"),
        4: (0.5, None, "issn"),
        5: (None, None, "missing_issn"),
        6: (None, None, "issn_not_found"),
        7: (None, "Q2", "inline"),
    }


@pytest.mark.parametrize("order", ["desc", "asc", "desc_nulls_last", "asc_nulls_first"])
def test_first_by_refuses_sort_directions(spark, order):
    df = spark.createDataFrame([("a", 1)], "k string, v int")
    with pytest.raises(ValueError, match="without sort directions"):
        relations.first_by(df, ["k"], getattr(F.col("v"), order)())
