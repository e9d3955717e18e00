"""The command-line entry point runs the whole pipeline on the driver's tables."""

from conftest import SMOKE_DIR

from tierwise.__main__ import main


def test_cli_run_and_health(spark, capsys):
    assert main(["run", "--testdata", SMOKE_DIR, "--database", "cli_test"]) == 0
    out = capsys.readouterr().out
    assert "'bronze_rows': 6000" in out and "'silver_rows': 4506" in out
    assert spark.table("cli_test.vw_sales_kpis").count() == 4431
    assert main(["health", "--database", "cli_test"]) == 0
    assert "fact_orders" in capsys.readouterr().out
