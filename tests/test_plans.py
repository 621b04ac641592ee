"""Layer jobs and the dashboard over written gold tables."""

from __future__ import annotations

import subprocess
import sys

import pytest

from conftest import ROOT, SF_SMALL
from tarmac import registry
from tarmac.plans import build_bronze, build_gold, build_silver
from tarmac.plans.dashboard import Dashboard


@pytest.fixture(scope="module")
def built(spark, tmp_path_factory):
    from tarmac.config import default_config

    cfg = default_config(spark, f"tests/plans/{tmp_path_factory.mktemp('b').name}")
    build_bronze(spark, cfg, registry.export_sources(spark, SF_SMALL, cfg)).collect()
    build_silver(spark, cfg).collect()
    build_gold(spark, cfg).collect()
    return cfg


def rows(df):
    return sorted(map(repr, df.collect()))


def test_dashboard_matches_lazy_queries(spark, built):
    board = Dashboard(spark, built)
    try:
        everything = board.revenue_tab(None)
        assert rows(everything["table"]) == rows(registry.QUERIES["revenue_table"](spark, SF_SMALL))
        assert rows(everything["bookings"]) == rows(registry.QUERIES["chart_bookings"](spark, SF_SMALL))
        perf = board.performance_tab()
        assert rows(perf["kpis"]) == rows(registry.QUERIES["performance_kpis"](spark, SF_SMALL))
        assert rows(perf["booking_range"].select("airport_name").distinct()) == rows(
            registry.QUERIES["selected_airport_performance"](spark, SF_SMALL).select("airport_name")
        )
        cleared = board.revenue_tab([])
        assert cleared["table"].count() == 0 and cleared["kpis"].collect()[0].airports == 0
    finally:
        board.close()


def test_cli_runs_all_layers(spark, tmp_path_factory):
    from tarmac.config import default_config

    cfg = default_config(spark, f"tests/cli/{tmp_path_factory.mktemp('c').name}")
    paths = registry.export_sources(spark, SF_SMALL, cfg)
    args = [sys.executable, "-m", "tarmac.plans.cli", "all", "--master", "local[2]", "--root", cfg.root]
    for name, path in paths.items():
        args += ["--source", f"{name}={path}"]
    res = subprocess.run(args, cwd=ROOT, capture_output=True, text=True, timeout=900)
    assert res.returncode == 0, res.stderr[-3000:]
    assert "gold_peak_travel_days" in res.stdout and "bookings_obt" in res.stdout
    board = [sys.executable, "-m", "tarmac.plans.cli", "dashboard", "--master", "local[2]", "--root", cfg.root]
    res = subprocess.run(board, cwd=ROOT, capture_output=True, text=True, timeout=900)
    assert res.returncode == 0, res.stderr[-3000:]
    assert "revenue_share" in res.stdout and "pax_per_flight_share" in res.stdout


def test_empty_sources_build_empty_layers(spark, tmp_path_factory):
    from conftest import write_text
    from tarmac.config import default_config
    from tarmac.operators import marts
    from tarmac.sources.tables import load_table

    cfg = default_config(spark, f"tests/empty/{tmp_path_factory.mktemp('e').name}")
    headers = {
        "bookings": "booking_id,passenger_id,flight_id,airport_id,amount,booking_date",
        "passengers": "passenger_id,name,gender,nationality",
        "airports": "airport_id,airport_name,city,country",
    }
    paths = {n: write_text(f"{cfg.root}/in/{n}.csv", h + "\n") for n, h in headers.items()}
    assert {r.row_count for r in build_bronze(spark, cfg, paths).collect()} == {0}
    assert build_silver(spark, cfg).collect()[0].row_count == 0
    assert {r.row_count for r in build_gold(spark, cfg).collect()} == {0}
    board = Dashboard(spark, cfg)
    try:
        assert all(df.count() == (1 if name == "kpis" else 0) for name, df in board.revenue_tab(None).items())
    finally:
        board.close()
    assert load_table(spark, cfg, "gold", marts.MARTS[0].name).columns == marts.MARTS[0].columns
