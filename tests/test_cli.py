"""The command line, step by step and in one go."""

from __future__ import annotations

import pytest
import retail

from terrace.__main__ import main


@pytest.fixture(scope="module")
def folders(spark, tmp_path_factory):
    root = tmp_path_factory.mktemp("cli")
    return retail.write(root / "raw"), str(root / "lake")


def test_steps(folders, capfd):
    raw, root = folders
    common = ["--root", root, "--date", "2026-01-01"]
    assert main(["land", "--raw", raw, *common]) == 0
    assert main(["gate", *common]) == 0
    assert main(["silver", *common]) == 0
    assert main(["gold", *common]) == 0
    assert main(["test", *common]) == 0
    assert main(["profile", *common]) == 0
    printed = capfd.readouterr().out
    assert "fact_orders 4" in printed and "FAIL" not in printed


def test_failed_gate_is_an_exit_code(spark, tmp_path, capfd):
    bad = retail.FILES["customers.csv"].replace("c2,", "c1,")
    arguments = ["--raw", retail.write(tmp_path / "raw", customers=bad), "--root", str(tmp_path / "lake")]
    assert main(["run", *arguments, "--date", "2026-01-01"]) == 1
    assert "customers.customer_id unique (1)" in capfd.readouterr().out


def test_missing_arguments():
    with pytest.raises(SystemExit):
        main(["land", "--root", "x"])
