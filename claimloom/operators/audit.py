"""Audit rules over sites. Each is a predicate; all are found in one pass over the rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from claimloom.functions.geo import BOX
from claimloom.functions.names import display
from claimloom.functions.scalar import haversine_m
from claimloom.functions.vocab import AUTHORITY_ONLY, AXES, CATEGORIES, PERIODS, SITE_TYPES
from claimloom.operators.merge import era, registered_summary

# Names that are designations, marker words, and the tails of inverted names.
DESIGNATIONS = [
    "מבנה לשימור", "בלוק מבנה לשימור", "אתר לשימור", "אתר/מתחם לשימור", "אתר מוכרז", "אתר עתיקות", "שטח עתיקות/הסטורי לשימור", "אתר עתיקות/אתר הסטורי",
    "שיקום/התחדשות", "רשת חלוקה", "שימור נופי", "ללא שם", "גן לאומי", "שמורת טבע",
]
MARKERS = ["תל", "חורבת", "בית", "גן", "לאומי", "שמורת", "נחל", "עין", "כפר", "מערת", "קבר", "חירבת", "אתר", "מוזיאון", "ארכיון"]
INVERTED = r",\s*(ח'|ח|תל|ע'|חר'|כ'|ג'|אל|מערת)\s*$"


def _markers(text: Column) -> Column:
    return F.size(F.array_intersect(F.split(text, r"[\s\-־,.()]+"), F.array(*map(F.lit, MARKERS))))


# Fixed value: words that may stand twice in a name.
ORDINARY = ["בית", "עין", "כפר", "תל", "גן", "של", "ה"]


def name_rules(name: Column) -> dict[str, tuple[str, Column]]:
    """kind: (severity, predicate) of rules on names, trimmed. A blank name is only missing."""
    name = F.regexp_replace(name, r"^\s+|\s+$", "")
    there = F.coalesce(name != "", F.lit(False))
    number = F.regexp_extract(name, r"\s(\d{3,6})$", 1)
    words = F.filter(F.split(name, r"\s+"), lambda w: ~w.isin(ORDINARY))
    shown = F.array(*(display(F.lit(d), normalise=False) for d in DESIGNATIONS))
    rules = {
        "name_missing": ("high", ~there),
        "name_is_designation": ("high", F.array_contains(shown, display(name, normalise=False))),
        "name_inverted": ("medium", name.rlike(INVERTED)),
        "name_trailing_number": ("medium", (number != "") & ~F.coalesce(number.try_cast("int").between(1000, 2100), F.lit(False))),
        "name_reversed": ("high", (_markers(F.reverse(name)) >= 2) & (_markers(F.reverse(name)) > _markers(name))),
        "name_latin_only": ("medium", name.rlike("[A-Za-z]{4,}") & ~name.rlike("[\u0590-\u05ff]")),
        "name_repeated_word": ("low", F.size(words) > F.size(F.array_distinct(words))),
        "name_too_long": ("low", F.length(name) > 90),
    }
    return {k: (s, p if k == "name_missing" else there & p) for k, (s, p) in rules.items()}


def site_rules(statuses: Column) -> dict[str, tuple[str, Column]]:
    """Rules on columns name, category, categories, type, periods, lat, lon, itm_lat, itm_lon, itm_x, in_council, dist_to_boundary_m, distance_now, provenance, reg_summary.

    itm_lat and itm_lon are the projection of the stored grid position, distance_now the distance recomputed from the coordinates.
    """
    c = F.col
    there = c("lat").isNotNull()
    inside = c("lat").between(*BOX[:2]) & c("lon").between(*BOX[2:])
    known = lambda k: F.coalesce(statuses[k] != "unknown", F.lit(False))
    category = c("category").isin(CATEGORIES)
    types = [t for group in SITE_TYPES.values() for t in group] + ["unknown"]
    some = lambda tests: F.array_contains(F.array(*tests), True)
    sources = lambda k: F.coalesce(c("provenance")[k], F.array().cast("array<string>"))
    e = era(c("periods"))
    return {
        "status_without_provenance": ("high", some([known(k) & (F.size(sources(k)) == 0) for k in AUTHORITY_ONLY])),
        "status_wrong_authority": ("high", some([known(k) & (F.size(F.array_except(sources(k), F.array(*map(F.lit, v)))) > 0) for k, v in AUTHORITY_ONLY.items()])),
        "jurisdiction_without_coordinate": ("medium", ~there & c("in_council").isNotNull()),
        "coordinate_outside_box": ("high", there & ~inside),
        "jurisdiction_mismatch": ("high", inside & ((c("distance_now") > 0) != F.coalesce("in_council", F.lit(False)))),
        "distance_stale": ("medium", inside & (F.abs(c("distance_now") - c("dist_to_boundary_m")) > 2)),
        "itm_disagrees_with_wgs84": ("high", inside & (haversine_m(c("lat"), c("lon"), c("itm_lat"), c("itm_lon")) > 60)),
        "itm_implausible": ("medium", inside & c("itm_x").isNotNull() & c("itm_lat").isNull()),
        "bad_category": ("high", ~F.coalesce(category, F.lit(False))),
        "category_not_in_categories": ("medium", category & ~F.coalesce(F.array_contains("categories", c("category")), F.lit(False))),
        "bad_type": ("medium", category & (c("type") != "") & ~c("type").isin(types)),
        "bad_period": ("high", category & (F.size(F.array_except("periods", F.array(*map(F.lit, PERIODS)))) > 0)),
        "category_contradicts_periods": ("medium", e.eqNullSafe("historic") & (c("category") == "archaeological") & ~known("reg_antiquity")),
        "historic_with_pre1700_periods": ("medium", e.eqNullSafe("archaeological") & (c("category") == "historic")),
        "status_axis_not_applicable": ("low", category & some([known(k) & ~c("category").isin(on) for k, (_, on) in AXES.items()])),
        "bad_status_value": ("high", category & some([F.coalesce(~statuses[k].isin(v), F.lit(False)) for k, (v, _) in AXES.items()])),
        "reg_summary_stale": ("medium", category & ~c("reg_summary").eqNullSafe(registered_summary(lambda k: statuses[k]))),
    }


def findings(sites: DataFrame, key: str, rules: dict[str, tuple[str, Column]]) -> DataFrame:
    """(key, kind, severity): one row for each rule that a site breaks; a predicate that is null isn't broken."""
    each = F.array_compact(F.array(*(F.when(p, F.struct(F.lit(k).alias("kind"), F.lit(s).alias("severity"))) for k, (s, p) in rules.items())))
    return sites.select(key, F.explode(each).alias("f")).select(key, "f.kind", "f.severity")


def summary(found: DataFrame) -> DataFrame:
    """(severity, kind, n), the most frequent first."""
    return found.groupBy("severity", "kind").agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), "severity", "kind")


def exit_code(found: DataFrame) -> int:
    """1 if any finding is of high severity: the gate of a build."""
    return int(not found.where("severity = 'high'").isEmpty())


def untraced(sites: DataFrame, statuses: Column) -> DataFrame:
    """(axis, n): values that trace to no source."""
    hits = F.array_compact(F.array(*(F.when((statuses[k] != "unknown") & (F.coalesce(F.size(F.col("provenance")[k]), F.lit(0)) <= 0), k) for k in AXES)))
    return sites.select(F.explode(hits).alias("axis")).groupBy("axis").agg(F.count(F.lit(1)).alias("n"))
