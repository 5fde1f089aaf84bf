"""The registered queries of the llm part that SQL can say, against their SQL on DuckDB, over whole tables."""

import pandas as pd
import pytest

from glycotide.llm import queries
from tests.test_queries import SMALL, duck, normal  # noqa: F401


def test_names():
    assert len(queries.QUERIES) == 14 and set(queries.ORACLES) == {"op4_hamming_top_k", "op5_line_dedup", "op6_exact_dedup", "op7_warc_shards", "op11_vector_codes", "op13_prefix_trie"}


@pytest.mark.parametrize("name", sorted(queries.ORACLES))
def test_query_equals_sql(spark, duck, name):  # noqa: F811
    ours, theirs = normal(queries.QUERIES[name](spark, SMALL).toPandas()), normal(duck.execute(queries.ORACLES[name]).df())
    assert list(ours.columns) == list(theirs.columns)
    pd.testing.assert_frame_equal(ours, theirs)
