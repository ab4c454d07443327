"""Injury reports from landed HTML pages.

Pages arrive as rows (html, capture_date, captured_at); tables are taken apart
with regular expressions inside Spark, one output row per reported player.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.numeric import nvl
from .constants import TEAM_ABBREVIATIONS
from .contracts import CONTRACTS, conform

ROW, CELL, ANY_CELL = r"(?is)<tr\b[^>]*>(.*?)</tr>", r"(?is)<td\b[^>]*>(.*?)</td>", r"(?is)<t[dh]\b[^>]*>(.*?)</t[dh]>"
TITLE = r"(?is)class=\"[^\"]*(?:Table__Title|headline)[^\"]*\"[^>]*>(.*?)</(?:h2|div)>"
SECTION = r"(?i)<(?:div|section)\b[^>]*class=\"[^\"]*(?:ResponsiveTable|Card)[^\"]*\"[^>]*>"


def text_of(html: Column) -> Column:
    """Text of a fragment: tags out, common entities resolved, blanks trimmed."""
    t = F.regexp_replace(html, r"(?s)<[^>]+>", "")
    for entity, ch in (("&nbsp;", " "), ("&#39;", "'"), ("&quot;", '"'), ("&lt;", "<"), ("&gt;", ">"), ("&amp;", "&")):
        t = F.replace(t, F.lit(entity), F.lit(ch))
    return F.trim(t)


# Status words by priority; the second site also reports availability.
WORDS = (("out", "Out"), ("doubtful", "Doubtful"), ("questionable", "Questionable"), ("probable", "Probable"), ("day-to-day", "Day-to-Day"))
AVAILABLE = (("available", "Available"), ("active", "Active"))


def status_of(text: Column, words=WORDS) -> Column:
    low = F.lower(text)
    out = F.when(low.contains(words[0][0]), words[0][1])
    for word, status in words[1:]:
        out = out.when(low.contains(word), status)
    return out.otherwise(text)


def abbreviation_map(names: dict[str, str] | None = None) -> Column:
    pairs = [F.lit(x) for kv in (names or TEAM_ABBREVIATIONS).items() for x in kv]
    return F.create_map(*pairs)


def _report_id(*parts: Column) -> Column:
    return F.concat_ws("_", *parts)


def _with_marker(pages: DataFrame, rows: Column, suffix: str) -> DataFrame:
    """Explode the row array; a page without rows yields one marker row."""
    day = F.col("capture_date").cast("string")
    marker = F.struct(
        _report_id(day, F.lit(suffix)).alias("injury_id"), F.lit("_NO_INJURIES_FOUND").alias("player_name"),
        F.lit(None).cast("string").alias("player_espn_id"), F.lit("N/A").alias("team_name"), F.lit("N/A").alias("team_abbrev"),
        F.lit("N/A").alias("status"), F.lit("No injuries found or page structure changed").alias("status_raw"),
        F.lit("Check page structure").alias("injury_details"))
    found = pages.withColumn("_rows", rows)
    out = found.select("capture_date", "captured_at", F.explode(F.when(F.size("_rows") > 0, F.col("_rows")).otherwise(F.array(marker))).alias("r"))
    return conform(out.select("capture_date", "captured_at", "r.*"), CONTRACTS["injuries"])


def injuries_by_team(pages: DataFrame, names: dict[str, str] | None = None) -> DataFrame:
    """Pages with one titled table per team: name | status | comment."""
    abbr = abbreviation_map(names)
    day = F.col("capture_date").cast("string")

    def row(team: Column, tr: Column) -> Column:
        cells = F.regexp_extract_all(tr, F.lit(CELL), 1)
        first = F.get(cells, F.lit(0))
        link = F.regexp_extract(first, r"(?is)<a\b[^>]*>(.*?)</a>", 1)
        name = F.when(first.rlike("(?i)<a[ >]"), text_of(link)).otherwise(text_of(first))
        eid = F.regexp_extract(first, r"/id/(\d+)/", 1)
        raw = text_of(F.get(cells, F.lit(1)))
        ab = nvl(abbr[team], "UNK")
        return F.struct(
            _report_id(day, ab, F.replace(name, F.lit(" "), F.lit("_"))).alias("injury_id"), name.alias("player_name"),
            F.when(eid != "", eid).alias("player_espn_id"), team.alias("team_name"), ab.alias("team_abbrev"), status_of(raw).alias("status"),
            raw.alias("status_raw"), text_of(F.get(cells, F.lit(2))).alias("injury_details"))

    def section(sec: Column) -> Column:
        team = text_of(F.regexp_extract(sec, TITLE, 1))
        trs = F.filter(F.regexp_extract_all(sec, F.lit(ROW), 1),
                       lambda tr: ~tr.rlike(r"(?i)<th\b") & (F.size(F.regexp_extract_all(tr, F.lit(CELL), 1)) >= 3))
        return F.when(team != "", F.transform(trs, lambda tr: row(team, tr))).otherwise(F.array())

    parts = F.split("html", SECTION)
    sections = F.slice(parts, F.lit(2), F.size(parts))
    return _with_marker(pages, F.flatten(F.transform(sections, section)), "NO_INJURIES")


def injuries_by_row(pages: DataFrame, names: dict[str, str] | None = None) -> DataFrame:
    """Pages with one flat table: team and status stand in any cell of a row."""
    known = names or TEAM_ABBREVIATIONS
    abbr = abbreviation_map(known)
    full = abbreviation_map({a: n for n, a in reversed(known.items())})
    codes = F.array(*[F.lit(c) for c in dict.fromkeys(known.values())])
    day = F.col("capture_date").cast("string")
    keyword = r"(?i)out|questionable|doubtful|probable|available"

    def row(tr: Column) -> Column:
        cells = F.transform(F.regexp_extract_all(tr, F.lit(CELL), 1), text_of)
        team_cells = F.filter(cells, lambda c: F.array_contains(codes, F.upper(c)) | abbr[c].isNotNull())
        team_cell = F.when(F.size(team_cells) > 0, F.element_at(team_cells, -1))
        ab = F.coalesce(F.when(F.array_contains(codes, F.upper(team_cell)), F.upper(team_cell)), abbr[team_cell], F.lit("UNK"))
        name_full = F.when(abbr[team_cell].isNotNull(), team_cell).otherwise(full[ab])
        hits = F.filter(cells, lambda c: c.rlike(keyword))
        raw = F.when(F.size(hits) > 0, F.element_at(hits, -1)).otherwise("Unknown")
        notes = F.filter(cells, lambda c: ~c.rlike(keyword) & (F.length(c) > 10) & F.lower(c).contains("injury"))
        player = F.get(cells, F.lit(0))
        return F.struct(
            _report_id(day, ab, F.replace(player, F.lit(" "), F.lit("_"))).alias("injury_id"), player.alias("player_name"),
            F.lit(None).cast("string").alias("player_espn_id"), nvl(name_full, "Unknown").alias("team_name"), ab.alias("team_abbrev"),
            status_of(raw, WORDS[:4] + AVAILABLE + WORDS[4:]).alias("status"), raw.alias("status_raw"),
            F.when(F.size(notes) > 0, F.element_at(notes, -1)).otherwise("").alias("injury_details"))

    trs = F.filter(F.regexp_extract_all("html", F.lit(ROW), 1), lambda tr: ~tr.rlike(r"(?i)<th\b") & (F.size(F.regexp_extract_all(tr, F.lit(CELL), 1)) >= 3))
    return _with_marker(pages, F.transform(trs, row), "NO_INJURIES_ROTOWIRE")


def injuries_on(pages: DataFrame, day: str, names: dict[str, str] | None = None) -> DataFrame:
    """Archived pages read as the report of a given past day."""
    return injuries_by_team(pages.withColumn("capture_date", F.lit(day).cast("date")), names)
