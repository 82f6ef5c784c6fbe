"""The command line runs the layers in order and passes its parameters on."""

import datetime

import pytest
from landing_files import land

from tierwell.plans import main


def test_layers_run_in_order_whatever_the_order_given(spark, tmp_path, capsys):
    as_of = datetime.date(2022, 11, 4)
    land(tmp_path / "landing", as_of, periods=("2022M10",), years=(2021,))
    missing = tmp_path / "landing" / "elpris" / "elomrade=SE1" / "ar=2022" / "2022-11-01.json"
    missing.rename(tmp_path / "kept.json")
    main.main([
        "gold", "silver", "bronze", "--landing", str(tmp_path / "landing"), "--storage", str(tmp_path / "storage"),
        "--prefix", "cli_", "--run-id", "r", "--as-of", "2022-11-04", "--known-missing", "SE1:2022-11-01",
    ])
    lines = capsys.readouterr().out.splitlines()
    assert [line.split()[0] for line in lines] == ["bronze"] * 3 + ["silver"] * 7 + ["gold"] * 8
    assert "bronze electricity_prices: 15" in lines
    assert spark.table("cli_gold.charging_station_candidates").count() == 290
    assert {row.run_id for row in spark.table("cli_ops.quality_check_results").collect()} == {"r"}


def test_parameters_are_checked():
    with pytest.raises(SystemExit):
        main.parse(["bronze", "--landing", "a", "--storage", "b", "--known-missing", "SE1:soon"])
    with pytest.raises(SystemExit):
        main.parse(["copper", "--landing", "a", "--storage", "b"])
