"""Command-line runner for registered queries."""

from uvlens.plans import run
from uvlens.session import scratch_path


def test_run_writes_results(spark, capsys):
    out = scratch_path(spark, "cli-out")
    run.main(["uv_exact_day", "pv_counter", "--tables", "/root/testdata/sf0.001", "--out", out])
    assert spark.read.parquet(f"{out}/uv_exact_day").count() > 0
    assert spark.read.parquet(f"{out}/pv_counter").count() > 0
    run.main(["--list"])
    listed = capsys.readouterr().out
    assert "uv_exact" in listed and "derive_keys" in listed
