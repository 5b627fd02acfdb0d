"""The project's schema tests (the "test" command of the reference project).

Column tests declared on the raw sources, the staging models and the
intermediate models: ``not_null``, ``unique`` and ``relationships``. Two
declared tests name a ``unique_key`` column that no model outputs; their
evident intent (one row per game and player / game and team) is checked as
a unique combination of columns instead.

Results follow the project's configuration: severity ``warn``, failing rows
stored (``store_failures``), one summary row per test.
"""

from __future__ import annotations

from pyspark.sql import DataFrame

from ..operators import quality as Q
from ..operators.quality import Check
from .layers import Warehouse

# (relation, test, column(s), parent relation, parent column)
SPEC = [
    ("games", "unique", "game_id", None, None),
    ("games", "not_null", "game_id", None, None),
    ("games", "not_null", "date", None, None),
    ("games", "not_null", "home_team", None, None),
    ("games", "not_null", "visitor_team", None, None),
    ("line_scores", "not_null", "game_id", None, None),
    ("line_scores", "relationships", "game_id", "games", "game_id"),
    ("line_scores", "not_null", "team", None, None),
    ("player_game_basic_stats", "not_null", "game_id", None, None),
    ("player_game_basic_stats", "not_null", "player_id", None, None),
    ("player_game_adv_stats", "not_null", "game_id", None, None),
    ("player_game_adv_stats", "not_null", "player_id", None, None),
    ("team_game_basic_stats", "not_null", "game_id", None, None),
    ("team_game_basic_stats", "not_null", "team", None, None),
    ("team_game_adv_stats", "not_null", "game_id", None, None),
    ("team_game_adv_stats", "not_null", "team", None, None),
    ("stg_games", "unique", "game_id", None, None),
    ("stg_games", "not_null", "game_id", None, None),
    ("stg_games", "not_null", "game_date", None, None),
    ("stg_line_scores", "not_null", "game_id", None, None),
    ("stg_line_scores", "not_null", "team", None, None),
    ("stg_player_game_basic_stats", "not_null", "game_id", None, None),
    ("stg_player_game_basic_stats", "not_null", "player_id", None, None),
    ("stg_player_game_adv_stats", "not_null", "game_id", None, None),
    ("stg_player_game_adv_stats", "not_null", "player_id", None, None),
    ("stg_team_game_basic_stats", "not_null", "game_id", None, None),
    ("stg_team_game_basic_stats", "not_null", "team", None, None),
    ("stg_team_game_adv_stats", "not_null", "game_id", None, None),
    ("stg_team_game_adv_stats", "not_null", "team", None, None),
    ("int_player_performance", "not_null", "game_id", None, None),
    ("int_player_performance", "not_null", "player_id", None, None),
    ("int_player_performance", "unique_combination", ("game_id", "player_id"), None, None),
    ("int_team_performance", "not_null", "game_id", None, None),
    ("int_team_performance", "not_null", "team", None, None),
    ("int_team_performance", "unique_combination", ("game_id", "team"), None, None),
    ("int_games_enriched", "unique", "game_id", None, None),
    ("int_games_enriched", "not_null", "game_id", None, None),
    ("int_games_enriched", "not_null", "home_team", None, None),
    ("int_games_enriched", "relationships", "home_team", "int_team_performance", "team"),
    ("int_games_enriched", "not_null", "visitor_team", None, None),
    ("int_games_enriched", "relationships", "visitor_team", "int_team_performance", "team"),
]


def _relation(w: Warehouse, name: str) -> DataFrame:
    return getattr(w, name) if hasattr(type(w), name) else w.src(name)


def project_checks(w: Warehouse) -> list[Check]:
    checks = []
    for rel, kind, col, parent, pcol in SPEC:
        df = _relation(w, rel)
        if kind == "unique":
            ch = Q.unique(df, col)
        elif kind == "not_null":
            ch = Q.not_null(df, col)
        elif kind == "relationships":
            ch = Q.relationships(df, col, _relation(w, parent), pcol)
        else:
            ch = Q.unique_combination_of_columns(df, list(col))
        label = "_".join(col) if isinstance(col, tuple) else col
        ch.name = f"{kind}_{rel}_{label}"
        checks.append(ch)
    return checks


def run_project_tests(w: Warehouse) -> DataFrame:
    """One summary row per declared test (failures, warn/pass)."""
    return Q.run_suite(project_checks(w))


def oracle_sql() -> str:
    """The same summary as DuckDB SQL over the oracle's model CTEs."""
    from .oracle_models import with_models
    parts = []
    for i, (rel, kind, col, parent, pcol) in enumerate(SPEC):
        src = f"raw_{rel}" if not rel.startswith(("stg_", "int_")) else rel
        label = "_".join(col) if isinstance(col, tuple) else col
        name = f"{kind}_{rel}_{label}"
        if kind == "unique":
            cnt = (f"(SELECT count(*) FROM (SELECT {col} FROM {src} WHERE {col} IS NOT NULL "
                   f"GROUP BY {col} HAVING count(*) > 1) x)")
        elif kind == "not_null":
            cnt = f"(SELECT count(*) FROM {src} WHERE {col} IS NULL)"
        elif kind == "relationships":
            psrc = f"raw_{parent}" if not parent.startswith(("stg_", "int_")) else parent
            cnt = (f"(SELECT count(*) FROM {src} c WHERE c.{col} IS NOT NULL AND NOT EXISTS "
                   f"(SELECT 1 FROM {psrc} p WHERE p.{pcol} = c.{col}))")
        else:
            cols = ", ".join(col)
            cnt = f"(SELECT count(*) FROM (SELECT {cols} FROM {src} GROUP BY {cols} HAVING count(*) > 1) x)"
        parts.append(f"SELECT {i} AS check_index, '{name}' AS check_name, {cnt} AS failures, "
                     f"CASE WHEN {cnt} <> 0 THEN 'warn' ELSE 'pass' END AS status")
    return with_models("\nUNION ALL\n".join(parts))
