"""Registered queries against their SQL on the smallest tables."""

import sys

import pytest
from conftest import SF_SMALL

import __spark_entry__ as E

sys.path.insert(0, __file__.rsplit("/", 2)[0])
import oracle  # noqa: E402


def test_all_and_the_pipeline_are_registered():
    names = [n for n in E.queries() if n.startswith("op") or n == "pipeline"]
    assert len(names) == 14 and {n.split("_")[0] for n in names} == {"pipeline", *(f"op{k}" for k in range(1, 14))}


@pytest.mark.parametrize("name", ["op4_embedding_dedup", "op8_mixing", "op10_exact_dedup", "op11_hard_negatives", "op12_divergence", "op13_quality_rules"])
def test_query_matches_its_sql(spark, name):
    assert oracle.compare(spark, SF_SMALL, [name], verbose=False)[name][0] == "ok"
