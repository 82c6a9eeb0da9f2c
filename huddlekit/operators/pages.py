"""Page text -> 0..N role rows (one per role whose field is present, non-blank
and not bled). One pass: ``inline`` over an array of (role, raw) structs, then
a filter; no UDF, no per-page Python."""
from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from huddlekit.functions import markup as M

# Wiki infobox field per coordinator role.
WIKI_ROLE_FIELDS = {"OC": "off_coach", "DC": "def_coach"}


# Team abbreviation -> franchise name as used in the title of
# its season page.
TEAM_PAGE_NAMES = {
    "ARI": "Arizona Cardinals", "ATL": "Atlanta Falcons", "BAL": "Baltimore Ravens",
    "BUF": "Buffalo Bills", "CAR": "Carolina Panthers", "CHI": "Chicago Bears",
    "CIN": "Cincinnati Bengals", "CLE": "Cleveland Browns", "DAL": "Dallas Cowboys",
    "DEN": "Denver Broncos", "DET": "Detroit Lions", "GB": "Green Bay Packers",
    "HOU": "Houston Texans", "IND": "Indianapolis Colts", "JAX": "Jacksonville Jaguars",
    "KC": "Kansas City Chiefs", "LV": "Las Vegas Raiders", "LAC": "Los Angeles Chargers",
    "LAR": "Los Angeles Rams", "MIA": "Miami Dolphins", "MIN": "Minnesota Vikings",
    "NE": "New England Patriots", "NO": "New Orleans Saints", "NYG": "New York Giants",
    "NYJ": "New York Jets", "PHI": "Philadelphia Eagles", "PIT": "Pittsburgh Steelers",
    "SF": "San Francisco 49ers", "SEA": "Seattle Seahawks", "TB": "Tampa Bay Buccaneers",
    "TEN": "Tennessee Titans", "WAS": "Washington Commanders",
}


def page_title(season, team) -> Column:
    """'<season>_<Franchise_Name>_season'; NULL for an unknown team. The
    32-entry table is a literal map, so no join is needed."""
    s = F.col(season) if isinstance(season, str) else season
    t = F.col(team) if isinstance(team, str) else team
    names = F.create_map(*[F.lit(x) for kv in TEAM_PAGE_NAMES.items() for x in kv])
    name = F.try_element_at(names, t)
    return F.when(name.isNotNull(), F.concat_ws("_", s.cast("string"),
                                                 F.replace(name, F.lit(" "), F.lit("_")), F.lit("season")))


def role_rows(pages: DataFrame, text_col: str, roles: dict[str, str], *, syntax: str = "wiki",
              keep: tuple[str, ...] = ()) -> DataFrame:
    if syntax == "wiki":
        pattern, strip, single = M.infobox_pattern, M.strip_wiki, M.SINGLE_WIKILINK
    elif syntax == "html":
        pattern, strip, single = M.tag_pattern, M.strip_html, M.SINGLE_HTML_LINK
    else:
        raise ValueError(f"unknown markup syntax {syntax!r}")
    text = F.col(text_col)
    pairs = F.array(*[F.struct(F.lit(role).alias("role"), M.extract(text, pattern(field)).alias("raw"))
                      for role, field in roles.items()])
    exploded = pages.select(*keep, F.inline(pairs))
    cleaned = strip(F.col("raw"))
    return (exploded
            .where(F.col("raw").isNotNull())
            .select(*keep, "role", cleaned.alias("name"),
                    M.confidence(F.col("raw"), single).alias("confidence"))
            .where((F.col("name") != "") & ~M.looks_like_bleed(F.col("name"))))


def coordinators(pages: DataFrame, text_col: str = "wikitext",
                 keep: tuple[str, ...] = ("season", "team")) -> DataFrame:
    """OC/DC rows from team-season infobox pages."""
    return role_rows(pages, text_col, WIKI_ROLE_FIELDS, syntax="wiki", keep=keep)
