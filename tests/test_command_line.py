import pytest

from conftest import TESTDATA
from stardw import __main__ as command
from stardw.session import scratch_dir


def test_load_and_ask(spark, capsys):
    root = ["--warehouse", scratch_dir(spark, "cli")]
    command.main([*root, "load", "--parquet", TESTDATA, "--as-of", "2001-12-31"])
    command.main([*root, "ask", "q3_marginal_products", "NATION_3", "1998"])
    assert "pct_ca" in capsys.readouterr().out
    command.main([*root, "order", "--parquet", TESTDATA, "--id", "5"])
    assert "montant_marge" in capsys.readouterr().out
    command.main([*root, "log", "--last", "3"])
    assert "commande 5: fait_ventes" in capsys.readouterr().out
    command.main([*root, "verify"])
    assert "fait_ventes(commande_id, numero_ligne)" in capsys.readouterr().out
    command.main([*root, "skipped", "--parquet", TESTDATA])
    assert "jours_avant_marque" in capsys.readouterr().out
    command.main([*root, "wipe"])
    command.main([*root, "expire", "--keep", "1"])
    assert "_manifest/" in capsys.readouterr().out


def test_a_load_needs_one_source():
    with pytest.raises(SystemExit):
        command.parser().parse_args(["--warehouse", "x", "load"])
