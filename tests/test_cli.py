import json

import pytest

from starloom.__main__ import main
from starloom.plans.layers import DIMENSIONS, FACTS, INTERMEDIATE, MODELS, STAGING, select_models
from starloom.sources.sinks import read_layer


def test_cli_build_then_test(spark, sf_small, tmp_path, capsys):
    out = str(tmp_path / "wh")
    assert main(["build", "--input", sf_small, "--output", out,
                 "--select", "stg_line_scores,stg_games,int_team_performance,int_games_enriched"]) == 0
    built = json.loads(capsys.readouterr().out.strip().splitlines()[-1])
    assert built["int_games_enriched"] == "table" and built["sources"] == "landed"
    fails = str(tmp_path / "failures")
    assert main(["test", "--input", sf_small, "--layers", out, "--store-failures", fails]) == 0
    rows = [json.loads(x) for x in capsys.readouterr().out.strip().splitlines()]
    names = {r["check_name"]: r for r in rows}
    assert len(rows) == 41
    # the derived games have soft-deleted rows and NULL visitors: these tests warn
    assert names["not_null_games_visitor_team"]["status"] == "warn"
    assert names["unique_stg_games_game_id"]["status"] == "pass"
    assert spark.read.parquet(f"{fails}/004_not_null_games_visitor_team").count() == \
        names["not_null_games_visitor_team"]["failures"]


def test_cli_build_from_sources_and_seeds(spark, sf_small, tmp_path, capsys):
    from starloom.plans.layers import RAW_SOURCES, SEED_SCHEMAS, Warehouse
    from starloom.plans.raw import Raw
    raw = Raw(spark, sf_small)
    for name in RAW_SOURCES:
        df = getattr(raw, name)
        if name in SEED_SCHEMAS:
            df.select(*reversed(df.columns)).coalesce(1).write.csv(str(tmp_path / "seeds" / f"{name}.csv"), header=True)
        else:
            df.write.parquet(str(tmp_path / "src" / f"{name}.parquet"))
    fails = str(tmp_path / "failures")
    sides = ["--sources", str(tmp_path / "src"), "--seeds", str(tmp_path / "seeds")]
    assert main(["test", *sides, "--store-failures", fails]) == 0
    told = {r["check_name"]: r for r in map(json.loads, capsys.readouterr().out.strip().splitlines())}
    assert len(told) == 41 and told["not_null_games_visitor_team"]["status"] == "warn"
    # severity and conditions, declared and from the command line
    (tmp_path / "rules.json").write_text(json.dumps({"not_null_games_*": {"severity": "error"}, "*_team": {"error_if": "> 1000000"}}))
    assert main(["test", *sides, "--config", str(tmp_path / "rules.json")]) == 0
    assert main(["test", *sides, "--severity", "error", "--error-if", "> 1000000", "--warn-if", "> 1000000"]) == 0
    capsys.readouterr()
    (tmp_path / "rules.json").write_text(json.dumps({"not_null_games_visitor_team": {"severity": "error", "error_if": ">= 1"}}))
    assert main(["test", *sides, "--config", str(tmp_path / "rules.json")]) == 1
    status = [r["status"] for r in map(json.loads, capsys.readouterr().out.strip().splitlines())]
    assert status.count("error") == 1
    with pytest.raises(SystemExit):
        main(["test", "--sources", str(tmp_path / "src")])
    out = str(tmp_path / "wh")
    assert main(["build", "--sources", str(tmp_path / "src"), "--seeds", str(tmp_path / "seeds"), "--output", out,
                 "--select", "stg_line_scores,stg_games,dim_teams"]) == 0
    assert json.loads(capsys.readouterr().out.strip().splitlines()[-1]) == {n: "table" for n in ("stg_line_scores", "stg_games", "dim_teams")}
    w = Warehouse(spark, sf_small)
    for name in ("stg_games", "dim_teams"):
        got = read_layer(spark, f"{out}/{name}")
        assert ("loaded_at" in got.columns) == (name == "stg_games")
        want = getattr(w, name)
        assert got.select(*want.columns).exceptAll(want).count() == 0 and got.count() == want.count()


def test_selection_by_layer_and_tag():
    assert select_models(["tag:staging"]) == select_models(["bronze"]) == STAGING
    assert select_models(["intermediate"]) == INTERMEDIATE and select_models(["tag:dimension", "dim_teams"]) == DIMENSIONS
    assert select_models(["tag:fact"]) == FACTS and select_models(["gold"]) == DIMENSIONS + FACTS
    assert select_models(["facts", "staging", "silver", "dimensions"]) == MODELS and select_models([]) == []
    with pytest.raises(ValueError, match="nothing is named"):
        select_models(["stg_gams"])


def test_cli_selects_layers_and_refreshes_in_full(spark, sf_small, tmp_path, capsys):
    out = str(tmp_path / "wh")

    def build(*more):
        assert main(["build", "--input", sf_small, "--output", out, *more]) == 0
        return json.loads(capsys.readouterr().out.strip().splitlines()[-1])

    first = build("--select", "tag:staging,intermediate,dimensions,fct_game_results")
    assert first["fct_game_results"] == "full" and first["stg_team_game_adv_stats"] == "view" and "fct_quarter_scoring" not in first
    rows = read_layer(spark, f"{out}/fct_game_results")
    want = sorted(r.game_key for r in rows.select("game_key").collect())
    assert build("--select", "fct_game_results") == {"fct_game_results": "incremental"}
    assert build("--select", "fct_game_results", "--full-refresh") == {"fct_game_results": "full"}
    assert sorted(r.game_key for r in read_layer(spark, f"{out}/fct_game_results").select("game_key").collect()) == want
    with pytest.raises(SystemExit):
        main(["build", "--input", sf_small, "--output", out, "--select", "nonsense"])
