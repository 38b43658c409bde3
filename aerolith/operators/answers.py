"""Direct answers (2.10): one answer row per answer kind, computed from the latest readings.

Questions are matched to a kind by keyword (``functions.text.first_group``) and
joined to this table, which has exactly one row per kind (seven rows).
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from aerolith import constants as K
from aerolith.operators import serving

T, H, W = "temperature_fahrenheit", "humidity_percent", "wind_speed_mph"


def fill(template: str, **parts: Column) -> Column:
    """Render a ``{name}`` template with column values (literal text stays literal)."""
    pieces, pos = [], 0
    for m in re.finditer(r"\{(\w+)\}", template):
        if m.start() > pos:
            pieces.append(F.lit(template[pos:m.start()]))
        pieces.append(parts[m.group(1)])
        pos = m.end()
    if pos < len(template):
        pieces.append(F.lit(template[pos:]))
    return F.concat(*pieces)


def place() -> Column:
    """'city, country' when a country is known, else the city."""
    c = F.col("country")
    return F.when(c.isNotNull() & (c != ""), F.concat_ws(", ", "city", "country")).otherwise(F.col("city"))


def r1(c: str) -> Column:
    return F.round(F.col(c), 1).cast("string")


def api_place() -> Column:
    return F.concat_ws(", ", "city", F.coalesce("state", F.lit("None")))


def _top5(latest: DataFrame, desc: bool, head: str, line: str = K.ANSWER_TOP_LINE, place=place) -> DataFrame:
    order = [F.col(T).desc() if desc else F.col(T).asc(), F.col("city")]
    top = serving.with_rank(serving.top_k(latest, 5, *order), *order)
    text = fill(line, rank=F.col("rank").cast("string"), place=place(), t=r1(T))
    rows = top.select("rank", text.alias("line"), place().alias("place"), r1(T).alias("t"))
    agg = rows.agg(F.array_sort(F.collect_list(F.struct("rank", "line", "place", "t"))).alias("_r"))
    first = F.col("_r")[0]
    lines = F.concat_ws("\n", F.transform("_r", lambda s: s["line"]))
    return agg.select(fill(head, place=first["place"], t=first["t"], lines=lines).alias("answer"))


def _arg_max(latest: DataFrame, value: str, template: str, key: str, place=place) -> DataFrame:
    top = serving.top_k(latest, 1, F.col(value).desc_nulls_last(), F.col("city"))
    return top.select(fill(template, place=place(), **{key: r1(value)}, t=r1(T)).alias("answer"))


def _conditions(latest: DataFrame) -> dict:
    cols = set(latest.columns)
    return {"extreme": F.col("is_extreme_weather") == 1,
            "heatwave": (F.col("is_heatwave") == 1) if "is_heatwave" in cols else (F.col(T) > 100),
            "cold": (F.col("is_extreme_cold") == 1) if "is_extreme_cold" in cols else (F.col(T) < 10)}


def _opening(latest: DataFrame, cond: Column, template: str, none: str) -> DataFrame:
    """The answer up to its list of cities, which has a row per city in ``listed_cities``."""
    n = latest.filter(cond).agg(F.count(F.lit(1)).alias("n"))
    text = fill(template.split("{list}")[0], n=F.col("n").cast("string"))
    return n.select(F.when(F.col("n") == 0, F.lit(none)).otherwise(text).alias("answer"))


def listed_cities(latest: DataFrame) -> DataFrame:
    """(kind, city, item): the cities that the list answers name."""
    kinds = [F.when(cond, F.lit(kind)) for kind, cond in _conditions(latest).items()]
    return latest.select(F.explode(F.array_compact(F.array(*kinds))).alias("kind"), "city",
                         fill(K.ANSWER_LIST_ITEM, place=place(), t=r1(T)).alias("item"))


def direct_answers(latest: DataFrame) -> DataFrame:
    """(kind, answer) for the seven kinds; every part is a small aggregate over latest rows."""
    cond = _conditions(latest)
    parts = {
        "hottest": _top5(latest, True, K.ANSWER_HOTTEST),
        "coldest": _top5(latest, False, K.ANSWER_COLDEST),
        "humid": _arg_max(latest, H, K.ANSWER_HUMID, "h"),
        "windy": _arg_max(latest, W, K.ANSWER_WINDY, "w"),
        "extreme": _opening(latest, cond["extreme"], K.ANSWER_EXTREME, K.ANSWER_EXTREME_NONE),
        "heatwave": _opening(latest, cond["heatwave"], K.ANSWER_HEATWAVE, K.ANSWER_HEATWAVE_NONE),
        "cold": _opening(latest, cond["cold"], K.ANSWER_COLD, K.ANSWER_COLD_NONE),
    }
    return _by_kind(parts)


def api_answers(latest: DataFrame) -> DataFrame:
    """(kind, answer) for the five kinds of the API, in its wording; the extreme list is rows of ``listed_cities``."""
    return _by_kind({
        "hottest": _top5(latest, True, K.API_HOTTEST, K.API_TOP_LINE, api_place),
        "coldest": _top5(latest, False, K.API_COLDEST, K.API_TOP_LINE, api_place),
        "extreme": _opening(latest, _conditions(latest)["extreme"], K.API_EXTREME, K.API_EXTREME_NONE),
        "humid": _arg_max(latest, H, K.API_HUMID, "h", api_place),
        "windy": _arg_max(latest, W, K.API_WINDY, "w", api_place)})


def _by_kind(parts: dict) -> DataFrame:
    out = None
    for kind, df in parts.items():
        df = df.select(F.lit(kind).alias("kind"), "answer")
        out = df if out is None else out.unionByName(df)
    return out


# --- SQL twin ---------------------------------------------------------------------

def fill_sql(template: str, **parts: str) -> str:
    out, pos = [], 0

    def lit(text: str):
        for i, chunk in enumerate(text.split("\n")):
            if i:
                out.append("chr(10)")
            if chunk:
                out.append("'" + chunk.replace("'", "''") + "'")

    for m in re.finditer(r"\{(\w+)\}", template):
        lit(template[pos:m.start()])
        out.append(parts[m.group(1)])
        pos = m.end()
    lit(template[pos:])
    return "(" + " || ".join(out) + ")"


PLACE_SQL = "CASE WHEN country IS NOT NULL AND country <> '' THEN city || ', ' || country ELSE city END"


API_PLACE_SQL = "city || ', ' || coalesce(state, 'None')"


def r1_sql(c: str) -> str:
    return f"CAST(round({c}, 1) AS VARCHAR)"


def direct_answers_sql(latest: str, api: bool = False) -> str:
    where, top_line = (API_PLACE_SQL, K.API_TOP_LINE) if api else (PLACE_SQL, K.ANSWER_TOP_LINE)

    def top5(desc: bool, head: str) -> str:
        d = "DESC" if desc else "ASC"
        line = fill_sql(top_line, rank="CAST(rank AS VARCHAR)", place="place", t="t")
        body = fill_sql(head, place="max(CASE WHEN rank = 1 THEN place END)", t="max(CASE WHEN rank = 1 THEN t END)",
                        lines=f"string_agg({line}, chr(10) ORDER BY rank)")
        return (f"SELECT {body} AS answer FROM (SELECT row_number() OVER (ORDER BY {T} {d}, city) AS rank, "
                f"{where} AS place, {r1_sql(T)} AS t FROM {latest} ORDER BY {T} {d}, city LIMIT 5) x")

    def arg_max(value: str, template: str, key: str) -> str:
        body = fill_sql(template, place=where, t=r1_sql(T), **{key: r1_sql(value)})
        return f"SELECT {body} AS answer FROM {latest} ORDER BY {value} DESC NULLS LAST, city LIMIT 1"

    def listing(cond: str, template: str, none: str) -> str:
        text = fill_sql(template.split("{list}")[0], n="CAST(count(*) AS VARCHAR)")
        return (f"SELECT CASE WHEN count(*) = 0 THEN '{none}' ELSE {text} END AS answer "
                f"FROM {latest} WHERE {cond}")

    if api:
        parts = [("hottest", top5(True, K.API_HOTTEST)), ("coldest", top5(False, K.API_COLDEST)),
                 ("extreme", listing("is_extreme_weather = 1", K.API_EXTREME, K.API_EXTREME_NONE)),
                 ("humid", arg_max(H, K.API_HUMID, "h")), ("windy", arg_max(W, K.API_WINDY, "w"))]
        return "\nUNION ALL\n".join(f"SELECT '{k}' AS kind, answer FROM ({q}) {k}_q" for k, q in parts)
    parts = [("hottest", top5(True, K.ANSWER_HOTTEST)), ("coldest", top5(False, K.ANSWER_COLDEST)),
             ("humid", arg_max(H, K.ANSWER_HUMID, "h")), ("windy", arg_max(W, K.ANSWER_WINDY, "w")),
             ("extreme", listing("is_extreme_weather = 1", K.ANSWER_EXTREME, K.ANSWER_EXTREME_NONE)),
             ("heatwave", listing("is_heatwave = 1", K.ANSWER_HEATWAVE, K.ANSWER_HEATWAVE_NONE)),
             ("cold", listing("is_extreme_cold = 1", K.ANSWER_COLD, K.ANSWER_COLD_NONE))]
    return "\nUNION ALL\n".join(f"SELECT '{k}' AS kind, answer FROM ({q}) {k}_q" for k, q in parts)


def listed_cities_sql(latest: str) -> str:
    item = fill_sql(K.ANSWER_LIST_ITEM, place=PLACE_SQL, t=r1_sql(T))
    flags = (("extreme", "is_extreme_weather"), ("heatwave", "is_heatwave"), ("cold", "is_extreme_cold"))
    return "\nUNION ALL\n".join(f"SELECT '{k}' AS kind, city, {item} AS item FROM {latest} WHERE {flag} = 1" for k, flag in flags)
