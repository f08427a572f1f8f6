"""Raw lines with faults: none is lost, none raises, each has its reason."""

import datetime as dt

from weekloom.sources import bronze as B

LINES = """week,supplier,product,region,units,a,b,c
2024-01-01,7,p1,ASIA,5,x,y,z
2024-02-30,7,p1,ASIA,5,x,y,z
2024-01-01,seven,p1,ASIA,5.5,x,y,z
2024-01-01,7,,ASIA,,x,y,z
2024-01-01,7,p1
2024-01-01,7,p1,ASIA,5,x,y,z,more
2024-01-08,8,"p,2",,-3,,,
"""


def test_rejects_hold_line_and_reason(spark, tmp_path):
    (tmp_path / "raw.csv").write_text(LINES)
    checked = B.read_checked_csv(spark, str(tmp_path))
    assert sorted(tuple(r) for r in B.rejects(checked).collect()) == [
        ("2024-01-01,7,,ASIA,,x,y,z", "missing product_id, missing units_sold"),
        ("2024-01-01,7,p1", "columns"),
        ("2024-01-01,7,p1,ASIA,5,x,y,z,more", "columns"),
        ("2024-01-01,seven,p1,ASIA,5.5,x,y,z", "unreadable supplier_id, unreadable units_sold"),
        ("2024-02-30,7,p1,ASIA,5,x,y,z", "unreadable week_date")]
    assert sorted(tuple(r) for r in B.accepted(checked).collect()) == [
        (dt.date(2024, 1, 1), 7, "p1", "ASIA", 5, "x", "y", "z"), (dt.date(2024, 1, 8), 8, "p,2", None, -3, None, None, None)]
    counts = {r["reason"]: (r["n_rows"], r["units_sold"]) for r in B.ingest_counts(checked).collect()}
    assert counts["accepted"] == (2, 2) and counts["columns"] == (2, None) and sum(n for n, _ in counts.values()) == 7


def test_an_empty_file_has_no_rows(spark, tmp_path):
    (tmp_path / "raw.csv").write_text(LINES.splitlines()[0] + "\n")
    assert B.read_checked_csv(spark, str(tmp_path)).count() == 0
