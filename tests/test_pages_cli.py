"""Page compositions and the job command line."""

import pytest

from livepulse import cli
from livepulse.operators import broadcasts as Fq
from livepulse.operators import catalogue as G
from livepulse.operators.transitions import detect_transitions
from livepulse.plans import profiles as P
from livepulse.session import scratch_dir

SF = "/root/testdata/sf0.001"


def test_broadcast_page(spark):
    s = P.e_silver(spark, SF)
    page = Fq.broadcast_page(s, P.e_tags(spark, SF), detect_transitions(P.e_snapshots(spark, SF)),
                             at="2024-01-03 00:00:00", languages=["NATION_1", "NATION_2"], grain="day")
    assert page["top_games"].count() > 0
    langs = {r.language for r in page["streams_by_language"].collect()}
    assert langs <= {"NATION_1", "NATION_2"}
    assert page["event_feed"].count() <= 10


def test_catalogue_page(spark):
    page = G.catalogue_page(P.s_games(spark, SF), Fq.latest_snapshot(P.s_silver(spark, SF)),
                            filters={"themes": ["red"]}, order=P.CATALOGUE_ORDER)
    assert page["kpis"].count() == 1 and "frequency_theme" in page
    assert all("red" in r.themes for r in page["explorer"].collect())


def test_cli_argument_contract(spark):
    with pytest.raises(ValueError):
        cli.run(["compact", "--layer", "bronze", "--path", "/nowhere", "--year", "2024"], spark)
    with pytest.raises(SystemExit):
        cli.run(["compact", "--layer", "gold", "--path", "/x"], spark)


def test_cli_validate_silver(spark):
    root = scratch_dir(spark, "test", "cli")
    P.e_silver(spark, SF).write.parquet(f"{root}/streams")
    P.e_tags(spark, SF).write.parquet(f"{root}/tags")
    detect_transitions(P.e_snapshots(spark, SF)).write.parquet(f"{root}/transitions")
    P.s_games(spark, SF).write.parquet(f"{root}/games")
    from livepulse.operators.quality import QualityError
    # profile E plants null users, so the silver gate must halt
    with pytest.raises(QualityError):
        cli.run(["validate", "--layer", "silver", "--streams", f"{root}/streams", "--tags", f"{root}/tags",
                 "--transitions", f"{root}/transitions", "--games", f"{root}/games"], spark)
