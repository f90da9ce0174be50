import pytest
from compare import SF_SMALL

from hangarline import __main__ as cli
from hangarline.sources.sample_tables import sample_tables
from hangarline.sources.tables import JDBC_TABLES
from hangarline.warehouse import Warehouse


@pytest.fixture(scope="module")
def options(spark, tmp_path_factory):
    folder = tmp_path_factory.mktemp("source")
    src = sample_tables(spark, SF_SMALL)
    for name in JDBC_TABLES:
        getattr(src, name).write.parquet(str(folder / name))
    src.aircraft_lookup.write.csv(str(folder / "lookup"), header=True, ignoreLeadingWhiteSpace=False)
    src.personnel.coalesce(1).write.csv(str(folder / "personnel"), header=True)
    return [
        *("--tables", str(folder), "--lookup", str(folder / "lookup"), "--personnel", str(folder / "personnel")),
        *("--warehouse", str(folder / "warehouse")),
    ]


def test_build_and_compare(spark, options, capsys):
    cli.main(["build", *options])
    assert Warehouse.open(spark, options[-1]).table("aircraft").count() == 9
    cli.main(["compare", *options])
    shown = capsys.readouterr().out
    assert "rule BR-21" in shown
    assert "utilization, warehouse: 14 rows" in shown and "reporting per role, difference: " in shown


def test_failure_is_raised(options):
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        cli.main(["build", *options[:3], "/nowhere/lookup.csv", *options[4:]])


def test_jdbc_needs_settings(monkeypatch, options):
    for key in ("NAME", "USER", "PASSWORD", "HOST", "PORT"):
        monkeypatch.delenv(f"FLEET_DB_{key}", raising=False)
    with pytest.raises(FileNotFoundError, match="missing database settings"):
        cli.main(["build", *options[2:]])


def test_default_start_goes_as_far_as_the_database(monkeypatch, options):
    """Without --tables the build opens the database; no driver is installed here, so that is where it ends."""
    for key, value in {"NAME": "ops", "USER": "me", "PASSWORD": "x", "HOST": "localhost", "PORT": "1"}.items():
        monkeypatch.setenv(f"FLEET_DB_{key}", value)
    with pytest.raises(Exception, match="org.postgresql.Driver"):
        cli.main(["build", *options[2:]])
