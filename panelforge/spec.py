"""Panel description shared by every operator.

A *panel* has one row per (entity, period).  Operators never hard-code the
entity or period column; they read them from a :class:`PanelSpec`, so the
same code runs on a customer-year, supplier-year or user-day panel.
"""

from __future__ import annotations

from dataclasses import dataclass, field, replace

# ---------------------------------------------------------------------------
# Fixed values (must equal the reference's for equal results).
# ---------------------------------------------------------------------------

# Statistics that get a NEXT_<stat> target, in the reference's order.
TARGET_STATS = (
    "PTS", "AST", "REB", "BLK", "STL", "TOV",
    "MIN", "FG3M", "FGA", "FTA", "FG_PCT", "FT_PCT",
)

# Box statistics lagged 1..3 periods, then the advanced ones.
LAG_STATS = (
    "PTS", "AST", "REB", "STL", "BLK", "TOV",
    "MIN", "FG3M", "FGA", "FTA", "FG_PCT", "FT_PCT",
    "FGM", "FTM", "FG3A", "GP",
)
ADVANCED_LAG_STATS = ("ADV_USG_PCT", "ADV_TS_PCT", "ADV_AST_PCT", "ADV_REB_PCT", "ADV_PIE")
LAG_PERIODS = (1, 2, 3)

# Rolling-average, trend and consistency statistic lists.
ROLLING_STATS = ("PTS", "AST", "REB", "STL", "BLK", "MIN", "TOV", "FG3M", "FGA", "FTA")
TREND_STATS = ("PTS", "AST", "REB", "MIN", "FG_PCT", "ADV_TS_PCT")
CONSISTENCY_STATS = ("PTS", "MIN", "GP")

# Columns never treated as features.
METADATA_COLS = (
    "PLAYER_ID", "PLAYER_NAME", "TEAM_ID", "TEAM_NAME",
    "TEAM_ABBREVIATION", "SEASON", "SEASON_ORDER",
    "BIRTHDATE", "SCHOOL", "COUNTRY", "DRAFT_YEAR",
    "HEIGHT", "TEAM_CITY",
)

# Columns kept from the bio table, and from the team and advanced tables.
BIO_COLS = (
    "PLAYER_ID", "POSITION", "HEIGHT", "HEIGHT_INCHES",
    "WEIGHT", "YEARS_EXPERIENCE", "DRAFT_YEAR", "DRAFT_ROUND",
    "DRAFT_NUMBER", "SCHOOL", "COUNTRY",
)
TEAM_COLS = ("TEAM_NAME", "SEASON", "PACE", "OFF_RATING", "DEF_RATING", "NET_RATING", "W", "L", "W_PCT")
TEAM_OPTIONAL_COLS = ("TS_PCT", "EFG_PCT", "FTA_RATE", "TM_TOV_PCT", "OREB_PCT", "PIE")
ADVANCED_COLS = (
    "PLAYER_ID", "SEASON", "USG_PCT", "AST_PCT", "AST_TO",
    "OREB_PCT", "DREB_PCT", "REB_PCT", "TM_TOV_PCT",
    "EFG_PCT", "TS_PCT", "PACE", "PIE",
)
ADVANCED_OPTIONAL_COLS = (
    "OFF_RATING", "DEF_RATING", "NET_RATING",
    "POSS", "PCT_FGA_2PT", "PCT_FGA_3PT",
    "AST_RATIO", "PCT_PTS_2PT", "PCT_PTS_3PT",
)

# Team abbreviation -> team name lookup (30 entries).
TEAM_ABBREVIATIONS = {
    "ATL": "Atlanta Hawks", "BOS": "Boston Celtics", "BKN": "Brooklyn Nets",
    "CHA": "Charlotte Hornets", "CHI": "Chicago Bulls", "CLE": "Cleveland Cavaliers",
    "DAL": "Dallas Mavericks", "DEN": "Denver Nuggets", "DET": "Detroit Pistons",
    "GSW": "Golden State Warriors", "HOU": "Houston Rockets", "IND": "Indiana Pacers",
    "LAC": "LA Clippers", "LAL": "Los Angeles Lakers", "MEM": "Memphis Grizzlies",
    "MIA": "Miami Heat", "MIL": "Milwaukee Bucks", "MIN": "Minnesota Timberwolves",
    "NOP": "New Orleans Pelicans", "NYK": "New York Knicks", "OKC": "Oklahoma City Thunder",
    "ORL": "Orlando Magic", "PHI": "Philadelphia 76ers", "PHX": "Phoenix Suns",
    "POR": "Portland Trail Blazers", "SAC": "Sacramento Kings", "SAS": "San Antonio Spurs",
    "TOR": "Toronto Raptors", "UTA": "Utah Jazz", "WAS": "Washington Wizards",
}

# Season label -> ordinal used by the reference's configuration.
SEASON_ORDER = {"2020-21": 1, "2021-22": 2, "2022-23": 3, "2023-24": 4, "2024-25": 5}

MAX_GAMES = 82          # games in a full season
MIN_GAMES = 10          # GP threshold for a kept row

# Fantasy scoring weights (documented formula).
FANTASY_WEIGHTS = {
    "PTS": 1.0, "REB": 1.0, "AST": 2.0, "STL": 4.0, "BLK": 4.0,
    "FGM": 2.0, "FGA": -1.0, "TOV": -2.0, "FG3M": 1.0, "FT_MISSED": -1.0,
}
# Games in the three shortened seasons (documented); others use MAX_GAMES.
SHORT_SEASON_GAMES = {"2011-12": 66, "2019-20": 63, "2020-21": 72}

# Fixed value: columns of the raw player table that are kept.
PLAYER_KEEP = ("PLAYER_ID", "PLAYER_NAME", "TEAM_ID", "TEAM_ABBREVIATION", "AGE", "GP", "MIN", "PTS", "REB",
               "AST", "STL", "BLK", "TOV", "FGM", "FGA", "FG_PCT", "FG3M", "FG3A", "FG3_PCT", "FTM", "FTA",
               "FT_PCT", "SEASON")


@dataclass(frozen=True)
class PanelSpec:
    """Names that describe a panel; every operator takes one."""

    entity: str = "PLAYER_ID"
    period: str = "SEASON"
    period_order: str = "SEASON_ORDER"
    name: str = "PLAYER_NAME"
    group: str = "POSITION"
    target_stats: tuple = TARGET_STATS
    lag_stats: tuple = LAG_STATS + ADVANCED_LAG_STATS
    lag_periods: tuple = LAG_PERIODS
    metadata_cols: tuple = METADATA_COLS
    max_games: int = MAX_GAMES
    extra: dict = field(default_factory=dict)

    @property
    def keys(self) -> list[str]:
        return [self.entity, self.period]

    @property
    def targets(self) -> list[str]:
        return [f"NEXT_{s}" for s in self.target_stats]

    def with_(self, **kw) -> "PanelSpec":
        return replace(self, **kw)


DEFAULT_SPEC = PanelSpec()
