"""Fixed values of the league: names, abbreviations, ids, conferences, divisions."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

# Full team name -> abbreviation (two names for each Los Angeles team).
TEAM_ABBREVIATIONS = {
    "Atlanta Hawks": "ATL", "Boston Celtics": "BOS", "Brooklyn Nets": "BKN", "Charlotte Hornets": "CHA", "Chicago Bulls": "CHI",
    "Cleveland Cavaliers": "CLE", "Dallas Mavericks": "DAL", "Denver Nuggets": "DEN", "Detroit Pistons": "DET",
    "Golden State Warriors": "GSW", "Houston Rockets": "HOU", "Indiana Pacers": "IND", "LA Clippers": "LAC",
    "Los Angeles Clippers": "LAC", "Los Angeles Lakers": "LAL", "LA Lakers": "LAL", "Memphis Grizzlies": "MEM", "Miami Heat": "MIA",
    "Milwaukee Bucks": "MIL", "Minnesota Timberwolves": "MIN", "New Orleans Pelicans": "NOP", "New York Knicks": "NYK",
    "Oklahoma City Thunder": "OKC", "Orlando Magic": "ORL", "Philadelphia 76ers": "PHI", "Phoenix Suns": "PHX",
    "Portland Trail Blazers": "POR", "Sacramento Kings": "SAC", "San Antonio Spurs": "SAS", "Toronto Raptors": "TOR",
    "Utah Jazz": "UTA", "Washington Wizards": "WAS",
}

# Team id -> division.
DIVISIONS = {
    "Atlantic": (1610612738, 1610612751, 1610612752, 1610612755, 1610612761),
    "Central": (1610612741, 1610612739, 1610612765, 1610612754, 1610612749),
    "Southeast": (1610612737, 1610612766, 1610612748, 1610612753, 1610612764),
    "Northwest": (1610612743, 1610612750, 1610612760, 1610612757, 1610612762),
    "Pacific": (1610612744, 1610612746, 1610612747, 1610612756, 1610612758),
    "Southwest": (1610612742, 1610612745, 1610612763, 1610612740, 1610612759),
}
EAST = ("Atlantic", "Central", "Southeast")

# Abbreviations of the historical box-score site -> team id.
HISTORY_TEAM_IDS = {
    "ATL": 1610612737, "BOS": 1610612738, "BRK": 1610612751, "CHA": 1610612766, "CHI": 1610612741, "CLE": 1610612739,
    "DAL": 1610612742, "DEN": 1610612743, "DET": 1610612765, "GSW": 1610612744, "HOU": 1610612745, "IND": 1610612754,
    "LAC": 1610612746, "LAL": 1610612747, "MEM": 1610612763, "MIA": 1610612748, "MIL": 1610612749, "MIN": 1610612750,
    "NOP": 1610612740, "NYK": 1610612752, "OKC": 1610612760, "ORL": 1610612753, "PHI": 1610612755, "PHO": 1610612756,
    "POR": 1610612757, "SAC": 1610612758, "SAS": 1610612759, "TOR": 1610612761, "UTA": 1610612762, "WAS": 1610612764,
}


def league_teams(spark: SparkSession) -> DataFrame:
    """(team_id, conference, division) of the league's teams."""
    rows = [(t, "East" if d in EAST else "West", d) for d, ids in DIVISIONS.items() for t in ids]
    return spark.createDataFrame(rows, "team_id long, conference string, division string")
