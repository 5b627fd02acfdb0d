"""The model graph, wired lazily: ``Warehouse(spark, dir).fct_game_results``.

Each attribute is a lazy DataFrame built from its inputs (memoised per
instance so one plan reuses the same sub-plans, which lets Spark reuse
their exchanges). ``build`` writes every layer to storage in dependency
order (see ``sources.sinks``), which is how the layers are materialised on
a cluster: the written tables cut the lineage between layers.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from ..session import ensure_checkpoint_dir, settings_of_layers
from .models import dimensions as D
from .models import facts as FCT
from .models import intermediate as I
from .models import staging as S
from .raw import Raw


class Warehouse:
    def __init__(self, spark: SparkSession, base: str, raw: Raw | None = None,
                 sources: dict[str, DataFrame] | None = None):
        settings_of_layers(spark)
        self.spark = spark
        self.raw = raw or Raw(spark, base)
        self._sources = dict(sources or {})
        self._memo: dict[str, DataFrame] = {}

    def use(self, name: str, df: DataFrame) -> None:
        """Replace a model by a stored copy (e.g. the table just written)."""
        self._memo[name] = df

    def stored(self, df: DataFrame, name: str) -> DataFrame:
        """``df`` computed once: written to the shared folder and read from there."""
        path = f"{ensure_checkpoint_dir(self.spark).rstrip('/')}/kept-{name}-{uuid.uuid4().hex}"
        df.write.parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)

    def keep(self, *names: str, columns: list[str] | None = None) -> Warehouse:
        """Compute models (or raw tables) that several others read once: each is
        written to the shared folder, and whatever is built from now on reads it. With
        ``columns`` only these are kept: every row, but nothing else can be read."""
        for name in names:
            model = hasattr(type(self), name)
            df = getattr(self, name) if model else self.src(name)
            stored = self.stored(df.select(*columns) if columns else df, name)
            if model:
                self.use(name, stored)
            else:
                self._sources[name] = stored
        return self

    def src(self, name: str) -> DataFrame:
        """A raw or seed table (overridable, e.g. by already-written tables)."""
        if name in self._sources:
            return self._sources[name]
        return getattr(self.raw, name)

    # staging
    @property
    def stg_line_scores(self):
        if "stg_line_scores" not in self._memo:
            self._memo["stg_line_scores"] = S.stg_line_scores(self.src("line_scores"))
        return self._memo["stg_line_scores"]

    @property
    def stg_games(self):
        if "stg_games" not in self._memo:
            self._memo["stg_games"] = S.stg_games(self.src("games"), self.stg_line_scores)
        return self._memo["stg_games"]

    @property
    def stg_player_game_basic_stats(self):
        if "stg_player_game_basic_stats" not in self._memo:
            self._memo["stg_player_game_basic_stats"] = S.stg_player_game_basic_stats(self.src("player_game_basic_stats"))
        return self._memo["stg_player_game_basic_stats"]

    @property
    def stg_player_game_adv_stats(self):
        if "stg_player_game_adv_stats" not in self._memo:
            self._memo["stg_player_game_adv_stats"] = S.stg_player_game_adv_stats(self.src("player_game_adv_stats"))
        return self._memo["stg_player_game_adv_stats"]

    @property
    def stg_player_game_adv_stats_extended(self):
        if "stg_player_game_adv_stats_extended" not in self._memo:
            self._memo["stg_player_game_adv_stats_extended"] = S.stg_player_game_adv_stats_extended(self.src("player_game_adv_stats"))
        return self._memo["stg_player_game_adv_stats_extended"]

    @property
    def stg_team_game_basic_stats(self):
        if "stg_team_game_basic_stats" not in self._memo:
            self._memo["stg_team_game_basic_stats"] = S.stg_team_game_basic_stats(self.src("team_game_basic_stats"))
        return self._memo["stg_team_game_basic_stats"]

    @property
    def stg_team_game_adv_stats(self):
        if "stg_team_game_adv_stats" not in self._memo:
            self._memo["stg_team_game_adv_stats"] = S.stg_team_game_adv_stats(self.src("team_game_adv_stats"))
        return self._memo["stg_team_game_adv_stats"]

    # intermediate
    @property
    def int_player_performance(self):
        if "int_player_performance" not in self._memo:
            self._memo["int_player_performance"] = I.int_player_performance(self.stg_player_game_basic_stats,
                                        self.stg_player_game_adv_stats, self.stg_games,
                                        self.src("team_abbreviation_mappings"),
                                        self.src("team_mappings"))
        return self._memo["int_player_performance"]

    @property
    def int_team_performance(self):
        if "int_team_performance" not in self._memo:
            self._memo["int_team_performance"] = I.int_team_performance(self.stg_team_game_basic_stats,
                                      self.stg_team_game_adv_stats, self.stg_games,
                                      self.src("team_abbreviation_mappings"),
                                      self.src("team_mappings"))
        return self._memo["int_team_performance"]

    @property
    def int_games_enriched(self):
        if "int_games_enriched" not in self._memo:
            self._memo["int_games_enriched"] = I.int_games_enriched(self.stg_games, self.int_team_performance,
                                    self.src("team_mappings"), self.src("arena_mappings"))
        return self._memo["int_games_enriched"]

    # dimensions
    @property
    def dim_arenas(self):
        if "dim_arenas" not in self._memo:
            self._memo["dim_arenas"] = D.dim_arenas(self.src("arena_mappings"))
        return self._memo["dim_arenas"]

    @property
    def dim_dates(self):
        if "dim_dates" not in self._memo:
            self._memo["dim_dates"] = D.dim_dates(self.stg_games)
        return self._memo["dim_dates"]

    @property
    def dim_player_game_archetypes(self):
        if "dim_player_game_archetypes" not in self._memo:
            self._memo["dim_player_game_archetypes"] = D.dim_player_game_archetypes(self.int_player_performance)
        return self._memo["dim_player_game_archetypes"]

    @property
    def dim_players(self):
        if "dim_players" not in self._memo:
            self._memo["dim_players"] = D.dim_players(self.stg_player_game_basic_stats, self.stg_games)
        return self._memo["dim_players"]

    @property
    def dim_seasons(self):
        if "dim_seasons" not in self._memo:
            self._memo["dim_seasons"] = D.dim_seasons(self.int_games_enriched)
        return self._memo["dim_seasons"]

    @property
    def dim_teams(self):
        if "dim_teams" not in self._memo:
            self._memo["dim_teams"] = D.dim_teams(self.src("team_mappings"))
        return self._memo["dim_teams"]

    # facts (full refresh; ``fact(name, since)`` for an incremental window)
    def fact(self, name: str, since: DataFrame | None = None) -> DataFrame:
        if name == "fct_game_results":
            return FCT.fct_game_results(self.int_games_enriched, self.dim_dates, self.dim_seasons,
                                        self.dim_arenas, self.dim_teams, since)
        if name == "fct_player_game_stats":
            return FCT.fct_player_game_stats(self.int_player_performance, self.int_games_enriched,
                                             self.dim_player_game_archetypes, self.dim_players,
                                             self.dim_teams, self.dim_dates, self.dim_seasons,
                                             self.dim_arenas, since)
        if name == "fct_quarter_scoring":
            return FCT.fct_quarter_scoring(self.stg_line_scores, self.int_games_enriched,
                                           self.src("team_abbreviation_mappings"), self.dim_teams,
                                           self.dim_dates, self.dim_seasons, since)
        if name == "fct_team_game_stats":
            return FCT.fct_team_game_stats(self.int_team_performance, self.int_games_enriched,
                                           self.dim_teams, self.dim_dates, self.dim_seasons,
                                           self.dim_arenas, since)
        raise KeyError(name)

    @property
    def fct_game_results(self):
        return self.fact("fct_game_results")

    @property
    def fct_player_game_stats(self):
        return self.fact("fct_player_game_stats")

    @property
    def fct_quarter_scoring(self):
        return self.fact("fct_quarter_scoring")

    @property
    def fct_team_game_stats(self):
        return self.fact("fct_team_game_stats")


STAGING = ["stg_line_scores", "stg_games", "stg_player_game_basic_stats",
           "stg_player_game_adv_stats", "stg_player_game_adv_stats_extended",
           "stg_team_game_basic_stats", "stg_team_game_adv_stats"]
INTERMEDIATE = ["int_player_performance", "int_team_performance", "int_games_enriched"]
DIMENSIONS = ["dim_arenas", "dim_dates", "dim_player_game_archetypes", "dim_players",
              "dim_seasons", "dim_teams"]
FACTS = ["fct_game_results", "fct_player_game_stats", "fct_quarter_scoring",
         "fct_team_game_stats"]
MODELS = STAGING + INTERMEDIATE + DIMENSIONS + FACTS

# Materialisation of the layers. As in the reference, intermediate and
# dimension models are tables, facts are incremental and one staging model is
# a table. Staging models that feed several downstream models are written
# too (one scan of the sources instead of one per consumer); the others stay
# lazy views.
RAW_SOURCES = ["games", "line_scores", "player_game_basic_stats", "player_game_adv_stats",
               "team_game_basic_stats", "team_game_adv_stats", "team_mappings",
               "team_abbreviation_mappings", "arena_mappings"]
TABLE_MODELS = (["stg_line_scores", "stg_games", "stg_player_game_basic_stats",
                 "stg_player_game_adv_stats_extended"] + INTERMEDIATE + DIMENSIONS)
FACT_KEYS = {"fct_game_results": "game_key", "fct_player_game_stats": "player_game_key",
             "fct_quarter_scoring": "quarter_scoring_key", "fct_team_game_stats": "team_game_key"}


def land_sources(spark: SparkSession, base: str, out_dir: str) -> dict[str, DataFrame]:
    """Write the raw source and seed tables (derived from the test tables)
    once; the models then read them like the reference reads its sources."""
    from ..sources.sinks import read_layer, write_layer
    raw = Raw(spark, base)
    stored = {}
    for name in RAW_SOURCES:
        path = f"{out_dir.rstrip('/')}/raw/{name}"
        write_layer(getattr(raw, name), path)
        stored[name] = read_layer(spark, path)
    return stored


SEED_SCHEMAS = {
    "team_mappings": "team_abbr string, full_name string",
    "team_abbreviation_mappings": "source_abbr string, team_abbr string",
    "arena_mappings": "arena_name string, city string, state_or_country string, location string",
}


def read_sources(spark: SparkSession, sources_dir: str, seeds_dir: str) -> dict[str, DataFrame]:
    """The six source tables (Parquet) and the three seeds (CSV with a header,
    columns by name in any order)."""
    from ..sources.tables import read_seed_csv
    return {n: read_seed_csv(spark, f"{seeds_dir.rstrip('/')}/{n}.csv", SEED_SCHEMAS[n]) if n in SEED_SCHEMAS
            else spark.read.parquet(f"{sources_dir.rstrip('/')}/{n}.parquet") for n in RAW_SOURCES}


#: What ``--select`` may name besides a model: the layers and their tags.
LAYERS = {"staging": STAGING, "bronze": STAGING, "intermediate": INTERMEDIATE, "silver": INTERMEDIATE,
          "dimensions": DIMENSIONS, "dimension": DIMENSIONS, "facts": FACTS, "fact": FACTS,
          "marts": DIMENSIONS + FACTS, "gold": DIMENSIONS + FACTS}


def select_models(names: list[str]) -> list[str]:
    """The models that ``names`` select, in dependency order: models, layers, or
    tags (``tag:staging``). An unknown name is an error."""
    chosen: set[str] = set()
    for name in names:
        bare = name.removeprefix("tag:")
        if bare in LAYERS:
            chosen.update(LAYERS[bare])
        elif name in MODELS:
            chosen.add(name)
        else:
            raise ValueError(f"nothing is named {name!r}; models: {', '.join(MODELS)}; layers and tags: {', '.join(LAYERS)}")
    return [m for m in MODELS if m in chosen]


def stored_warehouse(spark: SparkSession, base: str, out_dir: str, sources: dict[str, DataFrame] | None = None,
                     but: set[str] | frozenset = frozenset()) -> Warehouse:
    """A warehouse that reads the layers stored under ``out_dir``, except ``but``."""
    from ..sources.sinks import layer_exists, read_layer
    w = Warehouse(spark, base, sources=sources)
    for name in TABLE_MODELS:
        path = f"{out_dir.rstrip('/')}/{name}"
        if name not in but and layer_exists(spark, path):
            w.use(name, read_layer(spark, path).drop("loaded_at"))
    return w


def build_warehouse(spark: SparkSession, base: str, out_dir: str, models: list[str] | None = None,
                    sources_dir: str = "", seeds_dir: str = "", full_refresh: bool = False) -> dict[str, str]:
    """Write every layer under ``out_dir`` in dependency order.

    Each written table is read back and used downstream, so every model is
    computed once and each job's lineage starts at the previous layer's
    files. Facts are loaded with the incremental sink (full on the first run or
    with ``full_refresh``, look-back upsert otherwise). ``models`` may name models,
    layers and tags. Already written sources and layers that are not selected are
    reused. Written staging tables carry ``loaded_at``. With ``sources_dir`` and
    ``seeds_dir`` the real tables are read instead of those derived from ``base``.
    Returns {model: how it was written} (a view is not).
    """
    from ..sources.sinks import incremental_refresh, layer_exists, read_layer, with_load_time, write_layer

    root = out_dir.rstrip("/")
    done: dict[str, str] = {}
    wanted = select_models(models) if models else MODELS
    if sources_dir:
        sources = read_sources(spark, sources_dir, seeds_dir)
    elif models is None or not all(layer_exists(spark, f"{root}/raw/{n}") for n in RAW_SOURCES):
        sources = land_sources(spark, base, root)
        done["sources"] = "landed"
    else:
        sources = {n: read_layer(spark, f"{root}/raw/{n}") for n in RAW_SOURCES}
    w = stored_warehouse(spark, base, root, sources, but=set(wanted))
    for name in wanted:
        path = f"{root}/{name}"
        if name in FACTS:
            done[name] = incremental_refresh(spark, path, lambda since, _n=name: w.fact(_n, since), FACT_KEYS[name],
                                             full_refresh=full_refresh)
        elif name in TABLE_MODELS:
            df = getattr(w, name)
            # date-bearing layers are clustered by date inside each file, so the
            # look-back filter of incremental runs skips old row groups
            write_layer(with_load_time(df) if name in STAGING else df, path,
                        sort_within=["game_date"] if "game_date" in df.columns else ())
            w.use(name, read_layer(spark, path).drop("loaded_at"))
            done[name] = "table"
        elif models:
            done[name] = "view"
    return done
