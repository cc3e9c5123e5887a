"""Physical plans: what must reach the scan, and what must not appear."""

import pathlib
import re

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from bankweave.operators import tables as K
from bankweave.operators import windows as W
from bankweave.operators import aggregates as A
from bankweave.operators.predict import customer_features, customer_rank
from bankweave.session import new_folder
from bankweave.sources import files
from bankweave.sources import fixtures as fx

ROOT = pathlib.Path(__file__).resolve().parent.parent
LAZY = [n for n in entry.queries() if re.match(r"(a|j|w|t|m10|m11|m12|u2|p1[2-8]|r6_sliding_velocity|r7_sessions$)", n)
        and n not in ("a15_reconcile_closes", "j5_follow_up_stream")]


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def detail(df) -> str:
    return df.sparkSession._jvm.PythonSQLUtils.explainString(df._jdf.queryExecution(), "formatted")


@pytest.mark.parametrize("name", LAZY)
def test_no_pairwise_join_and_no_global_window(spark, sf_dir, name):
    text = plan(entry.queries()[name](spark, sf_dir))
    assert "CartesianProduct" not in text and "BroadcastNestedLoopJoin" not in text
    assert not re.search(r"Exchange SinglePartition.*\n.*Sort.*\n.*Window", text)
    assert "BatchEvalPython" not in text and "ArrowEvalPython" not in text


def test_source_rules():
    for path in (ROOT / "bankweave").rglob("*.py"):
        text = path.read_text()
        for banned in ("localCheckpoint", "broadcast(", "crossJoin", ".toPandas(", "@F.udf", "pandas_udf", ".rdd"):
            assert banned not in text, f"{banned} in {path}"


def test_table_filters_reach_the_scan(spark, sf_dir):
    path = new_folder(spark, "plan")
    K.write_transactions(fx.tx(spark, sf_dir), path)
    table = files.read_table(spark, path)
    text = detail(A.daily_summary(table, fx.TODAY, "bank-03"))
    assert re.search(r"PartitionFilters: \[[^\]]*tx_date", text)
    assert "EqualTo(bank_entity,bank-03)" in text and "GreaterThanOrEqual(transaction_timestamp" in text
    assert "latitude" not in text and "device_id" not in text
    for df in (W.top_customers(table, fx.AS_OF), files.lookback(table, fx.AS_OF, 7), files.since_hours(table, fx.AS_OF, 5)):
        assert re.search(r"PartitionFilters: \[[^\]]*tx_date", detail(df))


def test_reports_read_the_transactions_once(spark, sf_dir):
    path = new_folder(spark, "scans")
    K.write_transactions(fx.tx(spark, sf_dir), path)
    table = files.read_table(spark, path)
    for df in (A.branch_volume(table), A.branch_utilization(A.branch_metrics(table)), A.consolidated_report(table)):
        df.collect()
        final = plan(df).split("== Initial Plan ==")[0]
        assert final.count("FileScan parquet") == 1


def test_top_n_is_cut_before_the_shuffle(spark, sf_dir):
    text = plan(W.top_suspects(fx.tx(spark, sf_dir), 3))
    assert re.search(r"WindowGroupLimit.*Partial", text)


def test_rank_windows_are_sliced(spark, sf_dir):
    text = plan(customer_rank(customer_features(fx.tx(spark, sf_dir))))
    rank_windows = [w for w in re.findall(r"Window \[.*", text) if "_lower" in w or "_n#" in w]
    assert rank_windows and all("_cell" in w for w in rank_windows)


def test_message_text_is_parsed_once(spark, sf_dir):
    from bankweave.functions import ts_lit
    from bankweave.operators import validate as V

    text = plan(V.clean_and_score(fx.messages(spark, sf_dir), ts_lit(fx.AS_OF), fx.BANKS))
    assert text.count("from_json") == 1


def test_reports_pages_use_top_k(spark, sf_dir):
    assert "TakeOrderedAndProject" in plan(W.fx_page(fx.fx_ticks(spark, sf_dir)).select(F.col("pair_id"), F.col("rate")))
