"""Hand-made raw CSV inputs for the end-to-end tests.

Every raw file of the pipeline is written here in its source layout (header
CSVs, ranking snapshots with differing columns, two-level-header statistics).
They contain the rows the jobs must cope with: a null score, a shoot-out, a venue without a comma, an unparsable date,
a null team, an unparsable minute, stoppage and extra time, own goals,
penalties and scorers absent from the player list.  Team totals follow the
golden values of the served checks: France 2018 = 14, Argentina 2022 = 15,
Spain 2018 = 7.
"""

from __future__ import annotations

import csv
import os

MATCH_HEADER = ["Year", "Date", "Round", "home_team", "away_team", "home_score", "away_score",
                "home_xg", "away_xg", "home_penalty", "away_penalty", "Attendance", "Venue", "Host",
                "Referee", "home_goal", "away_goal", "home_penalty_goal", "away_penalty_goal",
                "home_own_goal", "away_own_goal"]


def _m(year, date, rnd, home, away, hs, as_, venue, host, hg="", ag="", hp="", ap="",
       hpen="", apen="", hog="", aog="", att="45000", hxg="", axg=""):
    return [year, date, rnd, home, away, hs, as_, hxg, axg, hpen, apen, att, venue, host,
            "Ref Eree", hg, ag, hp, ap, hog, aog]


MATCHES = [
    # France 2018: 2+1+0+4+2+1+4 = 14
    _m(2018, "2018-06-16", "Group stage", "France", "Australia", 2, 1, "Kazan Arena, Kazan", "Russia",
       hg="Paul Pogba · 81", hp="Antoine Griezmann (P) · 58", ag="Mile Jedinak (P) · 62", hxg="1.8", axg="0.9"),
    _m(2018, "2018-06-21", "Group stage", "France", "Peru", 1, 0, "Ekaterinburg Arena, Yekaterinburg",
       "Russia", hg="Kylian Mbappé · 34"),
    _m(2018, "2018-06-26", "Group stage", "Denmark", "France", 0, 0, "Luzhniki Stadium, Moscow", "Russia"),
    _m(2018, "2018-06-30", "Round of 16", "France", "Argentina", 4, 3, "Kazan Arena, Kazan", "Russia",
       hg="Benjamin Pavard · 57|Kylian Mbappé · 64|Kylian Mbappé · 68",
       hp="Antoine Griezmann (P) · 13", ag="Ángel Di María · 41|Gabriel Mercado · 48|Sergio Agüero · 90+3"),
    _m(2018, "2018-07-06", "Quarter-finals", "Uruguay", "France", 0, 2, "Nizhny Novgorod Stadium, Nizhny Novgorod",
       "Russia", ag="Raphaël Varane · 40|Antoine Griezmann · 61"),
    _m(2018, "2018-07-10", "Semi-finals", "France", "Belgium", 1, 0, "Krestovsky Stadium, Saint Petersburg",
       "Russia", hg="Samuel Umtiti · 51"),
    _m(2018, "2018-07-15", "Final", "France", "Croatia", 4, 2, "Luzhniki Stadium, Moscow", "Russia",
       hg="Paul Pogba · 59|Kylian Mbappé · 65", hp="Antoine Griezmann (P) · 38",
       ag="Ivan Perišić · 28|Mario Mandžukić · 69", hog="Mario Mandžukić · 18"),
    # Spain 2018: 3+1+2+1 = 7, with a shoot-out
    _m(2018, "2018-06-15", "Group stage", "Portugal", "Spain", 3, 3, "Fisht Olympic Stadium, Sochi", "Russia",
       hg="Cristiano Ronaldo · 44|Cristiano Ronaldo · 88", hp="Cristiano Ronaldo (P) · 4",
       ag="Diego Costa · 24|Diego Costa · 55|Nacho · 58"),
    _m(2018, "2018-06-20", "Group stage", "IR Iran", "Spain", 0, 1, "Kazan Arena, Kazan", "Russia",
       ag="Diego Costa · 54"),
    _m(2018, "2018-06-25", "Group stage", "Spain", "Morocco", 2, 2, "Kaliningrad Stadium, Kaliningrad", "Russia",
       hg="Isco · 19|Iago Aspas · 90+1", ag="Khalid Boutaïb · 14|Youssef En-Nesyri · 81"),
    _m(2018, "2018-07-01", "Round of 16", "Spain", "Russia", 1, 1, "Luzhniki Stadium, Moscow", "Russia",
       hog="Sergei Ignashevich · 12", ap="Artem Dzyuba (P) · 41", hpen=3, apen=4),
    # Argentina 2022: 1+2+2+2+2+3+3 = 15, two shoot-outs, extra time
    _m(2022, "2022-11-22", "Group stage", "Argentina", "Saudi Arabia", 1, 2, "Lusail Stadium, Lusail", "Qatar",
       hp="Lionel Messi (P) · 10", ag="Saleh Al-Shehri · 48|Salem Al-Dawsari · 53"),
    _m(2022, "2022-11-26", "Group stage", "Argentina", "Mexico", 2, 0, "Lusail Stadium, Lusail", "Qatar",
       hg="Lionel Messi · 64|Enzo Fernández · 87"),
    _m(2022, "2022-11-30", "Group stage", "Poland", "Argentina", 0, 2, "Stadium 974, Doha", "Qatar",
       ag="Alexis Mac Allister · 46|Julián Álvarez · 67"),
    _m(2022, "2022-12-03", "Round of 16", "Argentina", "Australia", 2, 1, "Ahmad bin Ali Stadium, Al Rayyan",
       "Qatar", hg="Lionel Messi · 35|Julián Álvarez · 57", aog="Enzo Fernández · 77"),
    _m(2022, "2022-12-09", "Quarter-finals", "Netherlands", "Argentina", 2, 2, "Lusail Stadium, Lusail", "Qatar",
       hg="Wout Weghorst · 83|Wout Weghorst · 90+11", ag="Nahuel Molina · 35", ap="Lionel Messi (P) · 73",
       hpen=3, apen=4),
    _m(2022, "2022-12-13", "Semi-finals", "Argentina", "Croatia", 3, 0, "Lusail Stadium, Lusail", "Qatar",
       hg="Julián Álvarez · 39|Julián Álvarez · 69", hp="Lionel Messi (P) · 34"),
    _m(2022, "2022-12-18", "Final", "Argentina", "France", 3, 3, "Lusail Stadium, Lusail", "Qatar",
       hg="Ángel Di María · 36|Lionel Messi · 108", hp="Lionel Messi (P) · 23",
       ag="Kylian Mbappé · 81", ap="Kylian Mbappé (P) · 80|Kylian Mbappé (P) · 118", hpen=4, apen=2),
    # Edge rows
    _m(2002, "2002-06-18", "Round of 16", "Korea Republic", "Italy", 2, 1,
       "Daejeon World Cup Stadium, Daejeon", "Korea Republic, Japan",
       hg="Seol Ki-hyeon · 88|Ahn Jung-hwan · 117", ag="Christian Vieri · 18"),
    _m(1950, "1950-07-16", "Final round", "Uruguay", "Brazil", "", "", "Maracanã", "Brazil",
       att="173850"),
    _m(1966, "not a date", "Group stage", "West Germany", "Soviet Union", 2, 1, "Roker Park, Sunderland",
       "England", hg="Helmut Haller · xx|Franz Beckenbauer · 60", ag="Valeriy Porkujan · 88"),
    _m(1974, "1974-06-18", "Group stage", "Türkiye", "", 1, 0, "Waldstadion, Frankfurt", "West Germany",
       hg="   Old Scorer   ·  45+2 "),
]

DUPLICATE_MATCH = MATCHES[1]


def write_csv(path: str, header: list, rows: list) -> None:
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w", newline="", encoding="utf-8") as f:
        w = csv.writer(f)
        w.writerow(header)
        w.writerows(rows)


def write_multiheader(path: str, index_names: list, groups: list, rows: list) -> None:
    os.makedirs(os.path.dirname(path), exist_ok=True)
    blank = [""] * len(index_names)
    with open(path, "w", newline="", encoding="utf-8") as f:
        w = csv.writer(f)
        w.writerow(blank + [g for g, _ in groups])
        w.writerow(blank + [s for _, s in groups])
        w.writerow(index_names + [""] * len(groups))
        w.writerows(rows)


PLAYER_GROUPS = [("nation", ""), ("pos", ""), ("age", ""), ("Playing Time", "MP"),
                 ("Playing Time", "Min"), ("Performance", "Gls"), ("Performance", "G+A"),
                 ("Per 90 Minutes", "Gls")]
PLAYER_ROWS = [
    ["INT-World Cup", 2018, "France", "Kylian Mbappé", "FRA", "FW", 19, 7, 590, 4, 4, 0.61],
    ["INT-World Cup", 2018, "France", "Antoine Griezmann", "FRA", "FW", 27, 7, 588, 4, 6, 0.61],
    ["INT-World Cup", 2018, "Spain", "Diego Costa", "ESP", "FW", 29, 4, 372, 3, 3, 0.73],
    ["INT-World Cup", 2018, "Spain", "Isco", "ESP", "MF", 26, 4, 390, 1, 2, 0.23],
    ["INT-World Cup", 2022, "Argentina", "Lionel Messi", "ARG", "FW", 35, 7, 690, 7, 10, 0.91],
    ["INT-World Cup", 2022, "Argentina", "Julián Álvarez", "ARG", "FW", 22, 7, 460, 4, 4, 0.78],
    ["INT-World Cup", 2022, "France", "Kylian Mbappé", "FRA", "FW", 23, 7, 598, 8, 10, 1.2],
    ["INT-World Cup", 2022, "Korea Republic", "Son Heung-min", "KOR", "FW", 30, 4, 360, "", "", ""],
]
SHOOTING_GROUPS = [("nation", ""), ("Standard", "Sh"), ("Standard", "SoT%")]
SHOOTING_ROWS = [
    ["INT-World Cup", 2022, "Argentina", "Lionel Messi", "ARG", 32, 40.6],
    ["INT-World Cup", 2022, "France", "Kylian Mbappé", "FRA", 31, 45.2],
]
FBREF_HEADER = ["round", "week", "date", "time", "home_team", "away_team", "score", "attendance",
                "venue", "referee", "game_id"]
FBREF_ROWS = [
    ["Group stage", 1, "2022-11-20", "19:00 (19:00)", "Qatar", "Ecuador", "0–2", 67372,
     "Al Bayt Stadium (Neutral Site)", "Daniele Orsato", "g1"],
    ["Final", 7, "2022-12-18", "18:00 (18:00)", "Argentina", "France", "(4) 3–3 (2)", 88966,
     "Lusail Iconic Stadium", "Szymon Marciniak", "g2"],
    ["Group stage", 1, "2022-11-21", "25:00", "USA", "Wales", "", "", "Ahmad bin Ali Stadium", "", "g3"],
    ["Group stage", 2, "bad", "9:00", "IR Iran", "Wales", "0–2", "40,875", "Ahmad bin Ali Stadium", "", "g4"],
]


EDITION_HEADER = ["Year", "Host", "Teams", "Champion", "Runner-Up", "TopScorrer", "Attendance",
                  "AttendanceAvg", "Matches"]
EDITIONS = [
    [2022, "Qatar", 32, "Argentina", "France", "Kylian Mbappé - 8", 3404252, 53191, 64],
    [2018, "Russia", 32, "France", "Croatia", "Harry Kane - 6", 3031768, 47371, 64],
    [2002, "Korea Republic, Japan", 32, "Brazil", "Germany", "Ronaldo - 8", 2705337, 42269, 64],
    [1974, "West Germany", 16, "West Germany", "Netherlands", "Grzegorz Lato - 7", 1865753, 49099, 38],
    [1966, "England", 16, "England", "West Germany", "Eusébio - 9", 1563135, 48848, 32],
    [1950, "Brazil", 13, "Uruguay", "Brazil", "Ademir - 8", 1045246, 47511, 22],
]
RANKING_HEADER = ["team", "team_code", "association", "rank", "previous_rank", "points", "previous_points"]
RANKING_2022 = [
    ["Brazil", "BRA", "CONMEBOL", 1, 1, 1841.3, 1837.56],
    ["Argentina", "ARG", "CONMEBOL", 3, 3, 1773.88, 1770.65],
    ["France", "FRA", "UEFA", 4, 4, 1759.78, 1764.85],
    ["Spain", "ESP", "UEFA", 7, 7, 1715.22, 1709.19],
    ["USA", "USA", "CONCACAF", 16, 15, 1627.48, 1635.01],
    ["IR Iran", "IRN", "AFC", 20, 22, 1564.61, 1559.59],
    ["Korea Republic", "KOR", "AFC", 28, 29, 1530.3, 1526.2],
]
RANKING_2026 = [
    ["Argentina", "ARG", "CONMEBOL", 1, 3, 1876.118331, 1874.814835, 59],
    ["Spain", "ESP", "UEFA", 2, 2, 1873.013187, 1876.395199, 56],
    ["France", "FRA", "UEFA", 3, 1, 1870.0, 1871.5, 58],
    ["Türkiye", "TUR", "UEFA", 25, 26, 1580.2, 1575.9, 51],
    ["Korea Republic", "KOR", "AFC", 22, 23, 1590.1, 1588.0, 55],
]
SCHEDULE_HEADER = ["Round", "Day", "Date", "Time", "Score", "Referee", "Notes", "Year", "home_team", "away_team"]
SCHEDULE_2026 = [
    ["Group stage", "Thu", "2026-06-11", "13:00 (22:00)", "", "", "", 2026, "Mexico", "South Africa"],
    ["Group stage", "Thu", "2026-06-11", "20:00 (05:00)", "", "", "", 2026, "Korea Republic", "Czechia"],
    ["Group stage", "Fri", "2026-06-12", "9:00 (18:00)", "", "", "", 2026, "USA", "Paraguay"],
]
TEAM_GROUPS = [("players_used", ""), ("Age", ""), ("Poss", ""), ("Playing Time", "MP"),
               ("Performance", "Gls"), ("Performance", "G+A"), ("Per 90 Minutes", "Gls"),
               ("Per 90 Minutes", "G+A-PK"), ("url", "")]
TEAM_ROWS = [
    ["INT-World Cup", 2014, "Algeria", 20, 25.9, 39.5, 4, 7, 13, 1.62, 2.77, "/squads/a/2014"],
    ["INT-World Cup", 2014, "Bosnia & Herz.", 19, 26.1, 51.2, 3, 4, 7, 1.33, 2.0, "/squads/b/2014"],
    ["INT-World Cup", 2018, "IR Iran", 21, 27.5, 30.1, 3, 2, 3, 0.67, 0.67, "/squads/c/2018"],
]


def make_raw_tree(root: str, with_duplicate: bool = False) -> str:
    """Write the raw folder: kaggle/ and soccerdata/ subfolders plus a loose file."""
    kaggle = os.path.join(root, "kaggle")
    soccer = os.path.join(root, "soccerdata")
    rows = MATCHES + ([DUPLICATE_MATCH] if with_duplicate else [])
    write_csv(os.path.join(kaggle, "matches_1930_2022.csv"), MATCH_HEADER, rows)
    write_csv(os.path.join(kaggle, "world_cup.csv"), EDITION_HEADER, EDITIONS)
    write_csv(os.path.join(kaggle, "fifa_ranking_2022-10-06.csv"), RANKING_HEADER, RANKING_2022)
    write_csv(os.path.join(kaggle, "fifa_ranking_2026-06-08.csv"), RANKING_HEADER + ["rated_matches"],
              RANKING_2026)
    write_csv(os.path.join(kaggle, "schedule_2026.csv"), SCHEDULE_HEADER, SCHEDULE_2026)
    write_csv(os.path.join(soccer, "schedule.csv"), FBREF_HEADER, FBREF_ROWS)
    write_multiheader(os.path.join(soccer, "player_stats.csv"), ["league", "season", "team", "player"],
                      PLAYER_GROUPS, PLAYER_ROWS)
    write_multiheader(os.path.join(soccer, "player_shooting.csv"), ["league", "season", "team", "player"],
                      SHOOTING_GROUPS, SHOOTING_ROWS)
    write_multiheader(os.path.join(soccer, "team_stats.csv"), ["league", "season", "team"],
                      TEAM_GROUPS, TEAM_ROWS)
    write_csv(os.path.join(root, "notes.csv"), ["a"], [[1]])
    return root
