"""Queries over all rows of their inputs."""

from __future__ import annotations

from quire.plans import issues, links, packaging


def test_no_input_row_is_left_out(spark, tmp_path):
    orders = spark.range(1, 31).selectExpr("id * 10000 AS o_orderkey", "id % 7 + 1 AS o_custkey")
    orders.write.parquet(f"{tmp_path}/orders.parquet")
    spark.range(1, 8).selectExpr("id AS c_custkey", "id + 100 AS c_nationkey").write.parquet(f"{tmp_path}/customer.parquet")
    spark.createDataFrame([(3, 999), (4, 105)], "s_suppkey long, s_nationkey long").write.parquet(f"{tmp_path}/supplier.parquet")
    at = str(tmp_path)
    assert {tuple(r) for r in links.overlap_join(spark, at).collect()} == {(3, 3), (4, 4), (4, 5)}
    found = {r["o_orderkey"]: r["ord"] for r in issues.order_value(spark, at).collect()}
    assert len(found) == 30
    assert found[300000] == "00003"  # its pid ends in 00000 and the other id is 0: the first page
    spark.range(1, 31).selectExpr("id AS o_orderkey", "id % 7 + 1 AS o_custkey").write.mode("overwrite").parquet(f"{tmp_path}/orders.parquet")
    out = {r["journal_id"]: r["issues"] for r in packaging.journal_issue_links(spark, at).collect()}
    assert sum(len(str(x).split(",")) for x in out.values()) == 30
