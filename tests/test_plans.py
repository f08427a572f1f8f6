"""What the plans of the costly queries may contain."""

import re

import __spark_entry__ as entry
from tests.conftest import SF
from weekloom.functions.ranks import rank_in_group
from weekloom.operators import profile as PR
from weekloom.plans.modelling import Modelling
from weekloom.session import pin
from weekloom.sources.retail import RetailTables

QUERIES = entry.queries()


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_panel_and_features_read_the_lines_once(spark):
    model = Modelling(RetailTables(spark, SF))
    assert "lineitem" not in plan(model.panel)
    scans = re.findall(r"FileScan parquet \[([^\]]*)\][^\n]*lineitem", plan(model.dataset))
    # the weekly table is written; of the lines only the parts that were sold are still asked for
    assert len(scans) == 1 and scans[0].startswith("l_partkey") and "," not in scans[0]


def test_one_row_tables_meet_without_a_join(spark):
    for name in ("describe_units", "safety_stock_summary"):
        assert "CartesianProduct" not in plan(QUERIES[name](spark, SF))


def test_few_groups_leave_the_numbered_rows_in_place(spark):
    df = spark.range(1000).selectExpr("id % 3 AS g", "id AS v")
    text = plan(rank_in_group(df, ["g"], ["v"], "r", few_groups=True))
    assert "BroadcastHashJoin" in text and "SortMergeJoin" not in text
    assert "Join" not in plan(rank_in_group(df, [], ["v"], "r", "n")).replace("BroadcastHashJoin [_part", "")


def broadcast_rows(node) -> list[int]:
    """Rows that each broadcast of an executed plan has sent."""
    kind = node.getClass().getSimpleName()
    inner = node.executedPlan() if kind == "AdaptiveSparkPlanExec" else node.plan() if kind.endswith("QueryStageExec") else None
    children = [inner] if inner else [node.children().apply(i) for i in range(node.children().size())]
    found = [node.metrics().apply("numOutputRows").value()] if kind == "BroadcastExchangeExec" else []
    return found + [n for child in children for n in broadcast_rows(child)]


def test_only_sampled_series_are_broadcast(spark):
    """the whole unpacked panel was gathered on the driver, as its packed series look small."""
    packed = spark.range(400).selectExpr("concat('s', id) AS unique_id", "if(id % 2 = 0, 'lumpy', 'smooth') AS demand_type",
                                         "sequence(date'2020-01-06', date'2021-12-27', interval 7 days) AS weeks")
    panel = pin(packed).selectExpr("unique_id", "demand_type", "explode(weeks) AS ds", "1L AS y")
    grid = PR.sampled_grid(panel, PR.sample_series(panel, 5, 42))
    rows = grid.collect()
    assert len(rows) == 10 * 104 and all(r["y"] == 1 for r in rows)
    assert max(broadcast_rows(grid._jdf.queryExecution().executedPlan())) <= 10 * 104
