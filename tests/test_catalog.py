"""Registry checks: every query has a callable, the flagship runs, and a
fast subset matches its DuckDB SQL on the smallest tables."""

import sys

import pytest

import __spark_entry__ as E
from conftest import SF_SMALL

from moodstream.catalog import ORACLE_SQL, QUERIES

sys.path.insert(0, __file__.rsplit("/", 1)[0])
import oracle  # noqa: E402

FAST = ["bucket_counts", "kpis", "detect_spikes", "parse_raw", "ttl_join", "join_outcomes",
        "eval_summary", "dataset_split", "clean_texts", "token_ids", "roc_auc", "normalized_texts",
        "alert_overlay", "alert_table", "join_dlq", "late_sliding_share", "eval_report", "report_lines", "ingest_raw",
        "alert_input", "classification_report", "dataset_union", "alert_intervals"]


def test_registry_is_complete():
    qs, sql = E.queries(), E.oracle_sql()
    assert set(sql) <= set(qs)
    # Every query of the library itself has SQL; the others have tests of their own.
    assert set(QUERIES) == set(ORACLE_SQL) and set(QUERIES) <= set(qs)


@pytest.mark.parametrize("sf", ["sf0.001", "sf0.01"])
def test_alerts_exist_at_every_scale(spark, sf):
    assert QUERIES["alert_table"](spark, SF_SMALL.replace("sf0.001", sf)).count() > 0


def test_plans_do_not_depend_on_the_size_of_a_table(spark):
    from moodstream.sources.tables import table

    assert "Repartition" not in table(spark, SF_SMALL, "documents")._jdf.queryExecution().optimizedPlan().toString()


def test_entry_runs(spark):
    df = E.entry(spark)
    assert {"seq", "total", "negative", "negative_share", "window_start", "window_end"} <= set(df.columns)
    assert df.count() > 0


@pytest.mark.parametrize("name", FAST)
def test_matches_oracle(spark, name):
    res = oracle.compare(spark, SF_SMALL, [name], verbose=False)
    assert res[name][0] == "ok", res


@pytest.mark.parametrize("blocked", ["zstandard", "moodstream.llm", "corpus_pipeline"])
def test_library_queries_do_without_the_other_part(blocked):
    import subprocess

    code = f"import sys, warnings; warnings.simplefilter('ignore'); sys.modules[{blocked!r}] = None; import __spark_entry__ as e; print(len(e.queries()), len(e.oracle_sql()))"
    out = subprocess.run([sys.executable, "-c", code], cwd=E.__file__.rsplit("/", 1)[0], capture_output=True, text=True, check=True).stdout
    assert out.split() == [str(len(QUERIES)), str(len(ORACLE_SQL))]
