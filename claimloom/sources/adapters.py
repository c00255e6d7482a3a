"""One adapter for each source: payload rows in, claims out. Each says which rows belong, what their columns mean, and what the source may state.

inside_m is the signed distance to the boundary in metres: an expression over the rows' lat and lon, or a function that adds it to rows as column _inside_m; rows more than APRON outside go, so that a place
just over the line can still be matched. Columns
that a payload doesn't have count as null. localities are the known settlements' names, a closed list.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from claimloom.functions.geo import AREA, coords_from_plus_code, plus_parse, try_to_wgs84
from claimloom.functions.names import catalog_name, clean, founding_year, key, listed_periods, named_periods, similarity, site_type, without_tags
from claimloom.functions.scalar import year
from claimloom.functions.terms import (
    APPROVED_STAGES, CLASS_TYPES, CONSERVATION_STATE, COUNCIL, DESIGNATIONS_LISTED, ENGINEERING_STATE, EXCAVATION_STATE, INSTITUTION_TYPES, INVENTORY_STATE, MAP_TAG_TYPES, PROTECTED_KINDS, RELEVANT_CLASSES,
    RISK_LEVEL, SUBTYPES, TOURISM_ACCESS, TOURISM_DEVELOPMENT, TYPE_TERMS,
)
from claimloom.functions.vocab import CATEGORIES, CUTOFF_YEAR, PERIODS, SITE_TYPES
from claimloom.operators.joins import first_known_part
from claimloom.operators.merge import era
from claimloom.sources.claims import claims

#: Fixed value: metres outside the boundary up to which rows are kept.
APRON = -600.0


def padded(rows: DataFrame, columns: str) -> DataFrame:
    """rows with the columns of a DDL string that they lack, as null."""
    wanted = [c.strip().rsplit(" ", 1) for c in columns.split(", ")]
    return rows.withColumns({n.strip("`"): F.lit(None).cast(t) for n, t in wanted if n.strip("`") not in rows.columns})


def cases(pairs: list[tuple[Column, object]]) -> Column:
    """The value of the first test that holds; null without one."""
    return reduce(lambda out, c: out.when(*c), pairs, F.when(F.lit(False), F.lit(None).cast("string")))


def lookup(text: Column, known: dict[str, str]) -> Column:
    """The value of a text in a closed list, null if it isn't there."""
    return F.try_element_at(F.create_map(*(F.lit(x) for kv in known.items() for x in kv)), F.coalesce(text, F.lit("")))


def has(text: Column, *words: str) -> Column:
    return F.coalesce(reduce(lambda a, b: a | b, (F.contains(text, F.lit(w)) for w in words)), F.lit(False))


def text(name: str) -> Column:
    return clean(F.col(f"`{name}`").cast("string"))


def is_true(name: str) -> Column:
    return F.coalesce(F.col(f"`{name}`") == True, F.lit(False))  # noqa: E712


def is_false(name: str) -> Column:
    return F.coalesce(F.col(f"`{name}`") == False, F.lit(False))  # noqa: E712


def measured(rows: DataFrame, inside_m) -> tuple[DataFrame, Column | None]:
    """rows and the expression of their distance."""
    return (rows, inside_m) if inside_m is None or isinstance(inside_m, Column) else (inside_m(rows), F.col("_inside_m"))


def in_scope(inside_m: Column | None) -> Column:
    there = F.col("lat").isNotNull() & F.col("lon").isNotNull()
    return there if inside_m is None else there & F.coalesce(inside_m > APRON, F.lit(False))


def sane_locality(value: Column, localities: list[str]) -> Column:
    """The first part of a text, split at semicolons, bars and commas, whose key is that of a known locality."""
    return first_known_part(clean(value), F.array(*(key(F.lit(n)) for n in localities)) if localities else F.array().cast("array<string>"), of=key)


def settlement_reference(rows: DataFrame, column: str, places: list[tuple[str, float, float]], bar: float = 0.85) -> DataFrame:
    """rows with ref_lat and ref_lon: those of the place with the same trimmed name, or else of the most similar one, from the bar on; ties to the first in the list.

    places is a closed list of settlements; only distinct names that it doesn't hold are compared with it.
    """
    name = F.trim(F.col(f"`{column}`"))
    known = F.array(*(F.struct(F.lit(k).alias("ord"), F.lit(n.strip()).alias("place"), F.lit(float(a)).alias("lat"), F.lit(float(b)).alias("lon")) for k, (n, a, b) in enumerate(places)))
    exact = rows.withColumn("_exact", F.try_element_at(F.filter(known, lambda p: p["place"] == name), F.lit(1)))
    misses = exact.where(F.col("_exact").isNull() & name.isNotNull()).select(name.alias("_name")).distinct().withColumn("p", F.explode(known))
    alike = misses.withColumn("s", similarity(F.col("_name"), F.col("p.place"))).where(F.col("s") >= bar)
    best = alike.groupBy("_name").agg(F.min_by("p", F.struct(-F.col("s"), F.col("p.ord"))).alias("_near"))
    out = exact.join(best, name == F.col("_name"), "left")
    at = F.coalesce("_exact", "_near")
    return out.withColumns({"ref_lat": at["lat"], "ref_lon": at["lon"]}).drop("_exact", "_near", "_name")


# ---------------------------------------------------------------- shared readings


def statutory(value: Column) -> dict[str, Column]:
    """Statuses in a note on statutory protection: only a declaration states the antiquity register, and a park comes before a reserve."""
    return {
        "reg_antiquity": F.when(has(value, "מוכרז", "הכרזה"), "declared"),
        "protected_area": cases([(has(value, "גן לאומי", 'ג"ל'), "national_park"), (has(value, "שמורת טבע", 'ש"ט', 'רט"ג'), "nature_reserve")]),
    }


def protected_by_use(value: Column) -> Column:
    return cases([(has(value, "גן לאומי", 'ג"ל'), "national_park"), (has(value, "שמורת טבע"), "nature_reserve"), (has(value, "יער"), "forest")])


def ownership(value: Column) -> Column:
    """The first kind of owner that a text names."""
    return cases([
        (has(value, "פרטי"), "private"), (has(value, "ציבורי"), "state"), (has(value, "שלישי", "עמות"), "ngo"), (has(value, "מועצה"), "council"), (has(value, "דת", "וקף", "כנסי"), "religious"),
    ])


def category_of(type_: Column) -> Column:
    return cases([(type_.isin(v), k) for k, v in SITE_TYPES.items()])


# ---------------------------------------------------------------- adapters

SURVEY = (
    "LOCAL_AUTHORITY string, SHEM_ATAR string, FEATURE_NAME string, EXC_STATUS string, INV_TURISM string, SHIMUR_STATUS string, ENGINEERING_STATE string, GENERAL_RISK_LEVEL string, "
    "STATUTORY_PROTECTION string, CURRENT_USE string, INV_KNOWN_INTRS string, INV_PERIODS string, INV_ELEMENT string, CATEGORY string, SPATIAL_DISTRIBUTION string, ATAR_DESC string, DESCRIPTION string, "
    "EXC_YEAR string, SITE_XOID string, ATA_NUM string, _ata_site_number int, _ata_sub_number int, _record_id string, _excel_row int"
)


def conservation_survey(rows: DataFrame) -> DataFrame:
    """The conservation survey: no positions, but the richest statuses. Rows of the council by the source's own column."""
    rows = padded(rows, SURVEY)
    rows = rows.where(text("LOCAL_AUTHORITY") == COUNCIL).withColumn("_split", catalog_name(F.col("SHEM_ATAR"), TYPE_TERMS))
    name = F.coalesce(F.col("_split.name"), text("FEATURE_NAME"))
    said = statutory(F.col("STATUTORY_PROTECTION"))
    number = F.col("_ata_site_number").cast("string")
    return claims(
        rows, "iaa_cluster_table", F.coalesce("_record_id", F.concat(F.lit("A"), F.col("_excel_row").cast("string"))), name, [text("SHEM_ATAR"), text("FEATURE_NAME")],
        description=F.coalesce(text("ATAR_DESC"), text("DESCRIPTION")), category_hint=F.lit("archaeological"), periods=listed_periods(F.col("INV_PERIODS")),
        type=F.coalesce(F.col("_split.type"), site_type(F.col("INV_ELEMENT"), F.col("CATEGORY"), F.col("SPATIAL_DISTRIBUTION"), name)),
        excavation_years=F.when(text("EXC_YEAR").isNotNull(), F.array(F.col("EXC_YEAR"))),
        maps={
            "statuses": {
                "excavation": lookup(text("EXC_STATUS"), EXCAVATION_STATE), "visitor_dev": lookup(text("INV_TURISM"), TOURISM_DEVELOPMENT), "accessibility": lookup(text("INV_TURISM"), TOURISM_ACCESS),
                "reg_conservation": lookup(text("SHIMUR_STATUS"), CONSERVATION_STATE),
                "condition": F.coalesce(lookup(text("ENGINEERING_STATE"), ENGINEERING_STATE), lookup(text("GENERAL_RISK_LEVEL"), RISK_LEVEL)),
                "reg_antiquity": said["reg_antiquity"], "protected_area": F.coalesce(said["protected_area"], protected_by_use(F.col("CURRENT_USE"))),
                "ownership": F.when(has(text("INV_KNOWN_INTRS"), 'רט"ג'), "state"),
            },
            "ids": {"iaa_site_id": number},
            "extra": {
                "site_xoid": F.col("SITE_XOID"), "ata_num": text("ATA_NUM"), "feature_name": text("FEATURE_NAME"), "iaa_category": text("CATEGORY"), "current_use": text("CURRENT_USE"),
                "iaa_site_sub_id": F.concat(number, F.lit("/"), F.coalesce(F.col("_ata_sub_number").cast("string"), F.lit("None"))), "engineering_state": text("ENGINEERING_STATE"),
                "risk_level": text("GENERAL_RISK_LEVEL"), "shimur_status": text("SHIMUR_STATUS"), "periods_raw": text("INV_PERIODS"),
            },
        },
    )


#: Columns of the institute's inventory, in its language.
INVENTORY = {
    "name": "שם מוסד", "kind": "סוג רשומה", "side": "ארכיאולוגי / מורשת", "state": "פעיל / משומר / מוכר", "blue_sign": "קיום שלט כחול", "sign": "הנגשה - שילוט", "access": "הנגשה - גישה לנכים", "sector": "מגזר",
    "description": "תיאור (מה זה)", "settlement": "שם יישוב", "code": "קוד כתובת (גוגל)", "domain": "תחום", "address": "כתובת", "phone": "מספר טלפון", "email": "דואר אלקטרוני", "website": "אתר אינטרנט", "notes": "הערות",
}


def institute_inventory(rows: DataFrame) -> DataFrame:
    """The institute's inventory: rows of the council that aren't excluded. Where a row has no position, its Plus Code is read against its settlement (ref_lat, ref_lon, from settlement_reference)."""
    c = INVENTORY
    flags = {"blue_sign", "sign", "access"}
    rows = padded(rows, ", ".join(f"`{v}` {'boolean' if k in flags else 'string'}" for k, v in c.items()) + ", _is_emek_yizrael_council boolean, _excluded boolean, lat double, lon double, _plus_code_local string, _record_id string, _map_category_candidate string, ref_lat double, ref_lon double")
    rows = rows.where(is_true("_is_emek_yizrael_council") & ~is_true("_excluded"))
    side, code = text(c["side"]), F.coalesce("_plus_code_local", F.col(f"`{c['code']}`"))
    candidate = text("_map_category_candidate")
    category = cases([(side == "ארכיאולוגי", "archaeological"), (side == "מורשת", "historic"), (text(c["kind"]) == "מוסד", "culture"), (candidate == "culture_institution", "culture"), (candidate.isin("historic", "archaeological"), candidate)])
    rows = rows.withColumns({"_own": F.col("lat").isNotNull(), "_decoded": F.when(F.col("lat").isNull(), coords_from_plus_code(code, F.col("ref_lat"), F.col("ref_lon")))})
    located = F.col("_own") | F.col("_decoded").isNotNull()
    stated = {axis: F.when(text(c["state"]) == t, v) for t, (axis, v) in INVENTORY_STATE.items() if axis == "activity"}
    stated["reg_conservation"] = cases([(text(c["state"]) == t, v) for t, (axis, v) in INVENTORY_STATE.items() if axis == "reg_conservation"])
    return claims(
        rows, "iicp_culture_table", F.col("_record_id"), text(c["name"]),
        description=text(c["description"]), category_hint=category, type=site_type(text(c["description"]), text(c["name"]), F.col(f"`{c['domain']}`")), locality=text(c["settlement"]),
        lat=F.coalesce("lat", F.col("_decoded.lat")), lon=F.when(F.col("_own"), F.col("lon")).otherwise(F.col("_decoded.lon")), location_precision=F.when(located, "approx_100m").otherwise("unknown"),
        maps={
            "statuses": stated | {
                "signage": cases([(is_true(c["blue_sign"]), "blue_sign"), (is_false(c["blue_sign"]) & is_true(c["sign"]), "other_sign"), (is_false(c["blue_sign"]) & is_false(c["sign"]), "none")]),
                "a11y_disabled": cases([(is_true(c["access"]), "accessible"), (is_false(c["access"]), "not_accessible")]), "ownership": ownership(F.col(f"`{c['sector']}`")),
            },
            "practical": {k: text(c[k]) for k in ("address", "phone", "email", "website")},
            "extra": {
                "domain": text(c["domain"]), "record_kind": text(c["kind"]), "sector": text(c["sector"]), "notes": text(c["notes"]), "google_plus_code": text(c["code"]),
                "position_from_plus_code": F.when(~F.col("_own") & F.col("_decoded").isNotNull(), plus_parse(code)), "contact_is_private_sector": F.coalesce(text(c["sector"]) == "פרטי", F.lit(False)).cast("string"),
            },
        },
    )


CROSS_CHECK = (
    "rec_id string, rec_source string, lat double, lon double, in_council_boundary boolean, geom_method string, osm_type string, osm_id string, name string, `name:he` string, `name:en` string, alt_name string, "
    "`alt_name:he` string, `loc_name:he` string, old_name string, historic string, heritage string, archaeological_site string, tomb string, memorial string, ruins string, man_made string, tourism string, amenity string, railway string, "
    "boundary string, leisure string, information string, start_date string, protect_title string, protection_title string, wheelchair string, access string, `historic:civilization` string, `addr:city` string, `addr:city:he` string, "
    "`addr:street` string, `addr:housenumber` string, phone string, website string, opening_hours string, operator string, osm_url string, wikidata string, image string, `description:he` string, wd_url string, wd_qid string, "
    "wd_label_he string, wd_label_en string, wd_description_he string, wd_P1705_native_label string, wd_P1448_official_name string, wd_P31_instance_of_he string, wd_P31_instance_of_qids string, wd_P571_inception string, "
    "wd_P576_dissolved_demolished_date string, wd_P2348_time_period_he string, wd_P131_located_in_admin_entity_he string, wd_P1435_heritage_designation string, wd_P3941_israel_antiquities_authority_id string, "
    "wd_P2186_wiki_loves_monuments_id string, wd_P10392_inpa_park_id string, wd_relevance_groups string, wd_hewiki_url string, wd_P18_image string, wd_P6375_street_address string, wd_P1329_phone_number string, "
    "wd_P968_email string, wd_P856_official_website string"
)
#: Tags that make a map record relevant by themselves, with any or with these values; identifiers that make a class record relevant.
ALWAYS_RELEVANT = ["historic", "heritage", "archaeological_site", "tomb", "memorial", "ruins"]
RELEVANT_TAGS = {"man_made": ["watermill", "water_well", "cistern", "water_tower"], "tourism": ["museum", "gallery", "artwork"], "amenity": ["library", "arts_centre", "theatre", "community_centre", "cinema"]}
HERITAGE_IDS = ["wd_P1435_heritage_designation", "wd_P3941_israel_antiquities_authority_id", "wd_P2186_wiki_loves_monuments_id", "wd_P10392_inpa_park_id"]


def map_relevance(protected: Column | None = None) -> Column:
    """Why a map record is a heritage or culture place; null if it isn't. A place of worship needs evidence of heritage, or a start before 1948."""
    why = [(text(k).isNotNull(), F.concat(F.lit(f"{k}="), F.col(k))) for k in ALWAYS_RELEVANT]
    why += [(text(k).isin(v), F.concat(F.lit(f"{k}="), F.col(k))) for k, v in RELEVANT_TAGS.items()]
    why += [((text("boundary") == "protected_area") | (text("leisure") == "nature_reserve"), F.lit("protected_area"))]
    old = F.regexp_extract(F.coalesce(text("start_date"), F.lit("")), r"\b(1[0-9]{3})\b", 1).try_cast("int") < 1948
    why += [((text("amenity") == "place_of_worship") & old, F.lit("place_of_worship+heritage_evidence"))]
    return cases(why)


def class_relevance() -> Column:
    """Why a class record is relevant: an identifier, a relevance group, or one of its class labels."""
    labels = F.transform(F.split(F.coalesce(text("wd_P31_instance_of_he"), F.lit("")), r"[|;]"), lambda x: F.trim(x))
    hit = F.array_sort(F.array_intersect(labels, F.array(*map(F.lit, RELEVANT_CLASSES))))
    why = [(text(k).isNotNull(), F.lit(k)) for k in HERITAGE_IDS]
    why += [(text("wd_relevance_groups").isNotNull(), F.concat(F.lit("relevance="), text("wd_relevance_groups"))), (F.size(hit) > 0, F.concat(F.lit("class="), F.try_element_at(hit, F.lit(1))))]
    return cases(why)


def map_cross_check(rows: DataFrame, inside_m: Column | None = None, localities: list[str] = ()) -> DataFrame:
    """Records of an open map and an open knowledge base: located, inside (or marked as inside, without a boundary), relevant by either side's rules, and named."""
    rows, inside_m = measured(padded(rows, CROSS_CHECK).where("lat is not null and lon is not null"), inside_m)
    rows = rows.where(F.coalesce(inside_m >= APRON, F.lit(False)) if inside_m is not None else is_true("in_council_boundary"))
    rows = rows.withColumns({"_why_map": F.when(F.col("rec_source").isin("osm", "both"), map_relevance()), "_why_class": F.when(F.col("rec_source").isin("wikidata", "both"), class_relevance())})
    rows = rows.where(F.col("_why_map").isNotNull() | F.col("_why_class").isNotNull())
    first = lambda *names: F.coalesce(*(text(n) for n in names))
    name = first("name:he", "wd_label_he", "name", "wd_P1705_native_label")
    tags = [lookup(F.concat(F.lit(f"{t}="), text(t)), MAP_TAG_TYPES) for t in ("historic", "tourism", "amenity", "man_made", "railway")]
    classes = F.filter(F.regexp_extract_all(F.coalesce(text("wd_P31_instance_of_qids"), F.lit("")), F.lit(r"Q\d+"), F.lit(0)), lambda q: q.isin(list(CLASS_TYPES)))
    rows = rows.withColumn("_type", F.coalesce(lookup(F.lower(text("archaeological_site")), SUBTYPES), *tags, lookup(F.try_element_at(classes, F.lit(1)), CLASS_TYPES), site_type(text("wd_P31_instance_of_he"), text("wd_description_he"), name)))
    stated = listed_periods(text("wd_P2348_time_period_he"))
    rows = rows.withColumn("_periods", F.when(F.size(stated) > 0, stated).otherwise(listed_periods(text("historic:civilization"))))
    born = lambda c: F.when(year(text(c)) != 0, year(text(c)))  # noqa: E731  a year of zero gives way to the next
    rows = rows.withColumn("_from", F.coalesce(born("wd_P571_inception"), year(text("start_date"))))
    e, y = era(F.col("_periods")), F.col("_from")
    category = F.coalesce(e, F.when(y < CUTOFF_YEAR, "archaeological").when(y.isNotNull(), "historic"), category_of(F.col("_type")))
    title = F.coalesce(first("protect_title", "protection_title"), F.lit(""))
    guarded = F.coalesce((text("boundary") == "protected_area") | (text("leisure") == "nature_reserve"), F.lit(False))
    street = F.concat_ws(" ", text("addr:street"), text("addr:housenumber"))
    return claims(
        rows, "osm_wikidata", F.col("rec_id"), name, [text(n) for n in ("name", "alt_name", "alt_name:he", "loc_name:he", "old_name", "wd_P1448_official_name", "wd_label_he")],
        url=first("osm_url", "wd_url"), name_en=first("name:en", "wd_label_en"), description=first("description:he", "wd_description_he"), category_hint=category, type=F.col("_type"), periods=F.col("_periods"),
        year_from=y, year_to=year(text("wd_P576_dissolved_demolished_date")), date_text=text("wd_P2348_time_period_he"), lat=F.col("lat"), lon=F.col("lon"),
        location_precision=F.when(F.col("geom_method") == "osm_node_coordinates", "exact").otherwise("approx_100m"),
        locality=F.coalesce(*(sane_locality(F.col(f"`{c}`"), localities) for c in ("addr:city", "wd_P131_located_in_admin_entity_he", "addr:city:he"))),
        maps={
            "statuses": {
                "protected_area": cases([(guarded & has(title, "לאומי", "National"), "national_park"), (guarded, "nature_reserve"), (text("wd_P10392_inpa_park_id").isNotNull(), "national_park")]),
                "a11y_disabled": cases([(text("wheelchair").isin("yes", "designated"), "accessible"), (text("wheelchair") == "limited", "partial"), (text("wheelchair") == "no", "not_accessible")]),
                "accessibility": cases([(text("access").isin("yes", "public", "permissive"), "open_free"), (text("access").isin("private", "no"), "not_accessible")]),
                "condition": F.when((text("historic") == "ruins") | text("ruins").isNotNull(), "poor"),
            },
            "practical": {
                "address": F.coalesce(F.when(street != "", street), text("wd_P6375_street_address")), "phone": first("phone", "wd_P1329_phone_number"), "email": text("wd_P968_email"),
                "website": first("website", "wd_P856_official_website"), "hours_text": text("opening_hours"), "operator": text("operator"), "founded_year": F.when(y > 1700, y),
            },
            "ids": {"wikidata_qid": first("wd_qid", "wikidata"), "osm_id": F.concat(F.col("osm_type"), F.lit("/"), F.col("osm_id")), "iaa_site_id": text("wd_P3941_israel_antiquities_authority_id")},
            "extra": {
                "wikipedia_he": text("wd_hewiki_url"), "image_url": first("wd_P18_image", "image"), "image_credit": F.when(text("wd_P18_image").isNotNull(), "Wikimedia Commons"),
                "wd_classes": text("wd_P31_instance_of_he"), "relevance_reason": F.coalesce("_why_map", "_why_class"), "rec_source": F.col("rec_source"),
            },
        },
    )


REGISTER = (
    "_record_type string, entityId string, id string, originEntityId string, title_he string, atarOfficialName string, name_heb string, agol_ata_shem string, description_he string, description_heb string, atarDescription string, "
    "atarStatus string, derived_is_declared boolean, derived_site_number_main string, derived_site_number string, site_num string, derived_survey_site_ref string, derived_itm_x double, derived_itm_y double, lat double, lon double, "
    "derived_position_uncertainty_m double, derived_was_excavated boolean, derived_survey_count int, derived_public_access_flag boolean, derived_permalink string, externalUrl string, derived_excavator_he string, "
    "derived_attached_declared_site_numbers string, derived_excavation_years string, derived_licence_names string, atarNames array<string>, atarPeriodsAndElements array<string>, derived_tabu_yishuvim array<string>, "
    "derived_status_he string, atarOfficialAnnouncementGazette string"
)


def excavations_by_site(rows: DataFrame) -> DataFrame:
    """(site, n, years, licences, people): what the excavation events say of each declared site that they name; lists are sorted, people at most 20 and licences at most 40."""
    events = rows.where("_record_type = 'excavation'")
    sites = F.array_distinct(F.transform(F.split("derived_attached_declared_site_numbers", r"[;,|]"), lambda x: F.trim(F.substring_index(F.trim(x), "/", 1))))
    each = events.select(
        F.explode(sites).alias("site"), F.regexp_extract_all(F.coalesce("derived_excavation_years", F.lit("")), F.lit(r"\d{4}"), F.lit(0)).alias("y"),
        F.filter(F.transform(F.split(F.coalesce("derived_licence_names", F.lit("")), r"[;,|]"), lambda x: F.trim(x)), lambda x: x != "").alias("l"), text("derived_excavator_he").alias("p"),
    ).where("site != ''")
    every = lambda c: F.array_sort(F.array_distinct(F.flatten(F.collect_list(c))))
    return each.groupBy("site").agg(F.count(F.lit(1)).alias("n"), every("y").alias("years"), F.slice(every("l"), 1, 40).alias("licences"), F.slice(F.array_sort(F.collect_set("p")), 1, 20).alias("people"))


def antiquities_register(rows: DataFrame, inside_m: Column | None = None, localities: list[str] = ()) -> DataFrame:
    """The national register: declarations and survey sites are places; excavations are events that are added to the declared site that they name. Site numbers are compared as text."""
    rows = padded(rows, REGISTER)
    found = excavations_by_site(rows)
    at = F.when(F.col("lat").isNull(), try_to_wgs84(F.col("derived_itm_x"), F.col("derived_itm_y"), AREA))
    sites = rows.where("_record_type in ('declared_site', 'survey_site')").withColumn("_at", at).withColumn("lon", F.when(F.col("lat").isNull(), F.col("_at.lon")).otherwise(F.col("lon"))).withColumn("lat", F.coalesce("lat", F.col("_at.lat")))
    sites, inside_m = measured(sites, inside_m)
    sites = sites.where(in_scope(inside_m))
    plain = lambda c: F.trim(F.regexp_replace(F.regexp_replace(text(c), r"^\s*(?:אתר מוכרז|אתר עתיקות מוכרז)\s*", ""), r"\s+\d{1,6}\s*$", ""))
    known = F.coalesce(*(F.when(plain(c) != "", plain(c)) for c in ("atarOfficialName", "title_he", "name_heb", "agol_ata_shem")))
    declared = F.col("_record_type") == "declared_site"
    number = F.coalesce(text("derived_site_number_main"), F.substring_index(text("originEntityId"), "/", 1))
    sites = sites.withColumns({"_name": catalog_name(known, TYPE_TERMS)["name"], "_main": F.when(declared, number)}).join(found, F.col("_main") == F.col("site"), "left")
    description = F.coalesce(text("description_he"), text("description_heb"), text("atarDescription"))
    elements = F.array_join("atarPeriodsAndElements", ", ")
    listed = listed_periods(elements)
    excavated = is_true("derived_was_excavated") | (F.coalesce("n", F.lit(0)) > 0)
    u = F.col("derived_position_uncertainty_m")
    own_years = F.regexp_extract_all(F.coalesce("derived_excavation_years", F.lit("")), F.lit(r"\d{4}"), F.lit(0))
    return claims(
        sites, "iaa_discover", F.concat(F.col("_record_type"), F.lit(":"), F.coalesce("entityId", "id", "site_num", F.lit("None"))), F.col("_name"), [F.try_element_at("atarNames", F.lit(k)) for k in range(1, 9)],
        url=F.coalesce(text("derived_permalink"), text("externalUrl")), description=description, category_hint=F.lit("archaeological"), type=site_type(elements, description, F.col("_name")),
        periods=F.when(F.size(listed) > 0, listed).otherwise(named_periods(description)), lat=F.col("lat"), lon=F.col("lon"), itm_x=F.col("derived_itm_x"), itm_y=F.col("derived_itm_y"),
        location_precision=F.when(u <= 60, "exact").when(u <= 150, "approx_100m").when(u <= 600, "approx_500m").otherwise("approx_100m"),
        locality=sane_locality(F.array_join("derived_tabu_yishuvim", ";"), localities),
        excavation_years=F.coalesce("years", own_years), excavation_licenses=F.col("licences"), excavators=F.coalesce("people", F.array_compact(F.array(text("derived_excavator_he")))),
        maps={
            "statuses": {
                "reg_antiquity": cases([(~declared, "known"), (is_true("derived_is_declared") | F.coalesce(text("atarStatus") == "מוכרז/תקין", F.lit(False)), "declared"), (is_false("derived_is_declared") | F.coalesce(text("atarStatus") == "לא להכרזה", F.lit(False)), "known")]),
                "excavation": cases([(excavated, "excavated"), (~declared | (F.coalesce("derived_survey_count", F.lit(0)) > 0), "surveyed_only")]),
                "accessibility": F.when(is_true("derived_public_access_flag"), "open_free"),
            },
            "ids": {"iaa_site_id": F.col("_main")},
            "extra": {
                "record_type": F.col("_record_type"), "survey_site_num": F.coalesce(text("site_num"), text("derived_survey_site_ref")), "iaa_site_sub_id": F.coalesce(text("derived_site_number"), text("originEntityId")),
                "iaa_status_he": F.coalesce(text("derived_status_he"), text("atarStatus")), "gazette": text("atarOfficialAnnouncementGazette"), "excavation_count": F.col("n"), "position_uncertainty_m": u,
            },
        },
    )


DECLARED = "objectid string, ata_shem string, atar_number string, hp_ata_id string, atar_heb_desc string, hachraza_name_hebrew string, hachraza_name_english string, lat double, lon double, Shape__Area double, _gazette_reference string"
SURVEYED = "OBJECTID string, GlobalID string, NAME_HEB string, ADDITIONAL_NAME_HEB string, NAME_EN string, DESCRIPTION_HEB string, PERIOD_HEB string, REMAINS_HEB string, SITE_NUM string, MAP_ID string, lat double, lon double, _itm2039_x double, _itm2039_y double"


def declared_antiquities(polygons: DataFrame, points: DataFrame, inside_m: Column | None = None) -> DataFrame:
    """Declared polygons, whose area decides the precision, and survey points, which are known and not declared; the points' numbers are a survey map's and no identifiers."""
    p, near = measured(padded(polygons, DECLARED), inside_m)
    p = p.where(in_scope(near)).withColumn("_split", catalog_name(F.col("ata_shem"), TYPE_TERMS))
    area, described = F.col("Shape__Area"), text("atar_heb_desc")
    one = claims(
        p, "declared_antiquities", F.concat(F.lit("poly:"), F.coalesce("objectid", F.lit("None"))), F.col("_split.name"), [text("ata_shem"), text("hachraza_name_hebrew")], name_en=text("hachraza_name_english"),
        description=described, category_hint=F.lit("archaeological"), type=F.coalesce(F.col("_split.type"), site_type(described, F.col("_split.name"))), periods=named_periods(described), lat=F.col("lat"), lon=F.col("lon"),
        location_precision=F.when(area <= 20_000, "exact").when(area <= 120_000, "approx_100m").otherwise("approx_500m"),
        maps={
            "statuses": {"reg_antiquity": F.lit("declared")}, "ids": {"iaa_site_id": F.coalesce(F.substring_index(text("atar_number"), "/", 1), F.col("hp_ata_id"))},
            "extra": {"atar_number": text("atar_number"), "gazette": text("_gazette_reference"), "polygon_area_m2": F.bround(area).cast("long")},
        },
    )
    s, near = measured(padded(points, SURVEYED), inside_m)
    s = s.where(in_scope(near)).withColumn("_split", catalog_name(F.col("NAME_HEB"), TYPE_TERMS))
    plain = without_tags(F.col("DESCRIPTION_HEB"))
    described, listed = F.when(plain != "", plain), listed_periods(text("PERIOD_HEB"))
    two = claims(
        s, "declared_antiquities", F.concat(F.lit("survey:"), F.coalesce("GlobalID", "OBJECTID", F.lit("None"))), F.col("_split.name"), [text("ADDITIONAL_NAME_HEB"), text("NAME_HEB")], name_en=text("NAME_EN"),
        description=described, category_hint=F.lit("archaeological"), type=F.coalesce(F.col("_split.type"), site_type(text("REMAINS_HEB"), described, F.col("_split.name"))),
        periods=F.when(F.size(listed) > 0, listed).otherwise(named_periods(described)), lat=F.col("lat"), lon=F.col("lon"), itm_x=F.col("_itm2039_x"), itm_y=F.col("_itm2039_y"), location_precision=F.lit("exact"),
        maps={"statuses": {"reg_antiquity": F.lit("known")}, "extra": {"survey_site_num": F.col("SITE_NUM"), "survey_map_id": F.col("MAP_ID"), "remains": text("REMAINS_HEB"), "periods_raw": text("PERIOD_HEB")}},
    )
    return one.unionByName(two)


SIGNS = (
    "record_id string, site_name string, shimur_sign_name string, settlement string, address string, shimur_address string, sign_number string, sign_text string, site_category string, lat double, lon double, coord_source string, "
    "in_emek_yizrael_council_boundary boolean, emek_yizrael_settlement_matched string, settlement_matches_emek_yizrael_list boolean, pre1700_keyword_flags string, possible_archaeological_site boolean, image_files array<string>, "
    "wikidata_qid string, wikidata_label_he string, wikidata_label_en string, site_wiki_article_url string, shimur_url string, wikipedia_source_page_url string, shimur_sign_type string, shimur_year_on_sign_page string"
)


def blue_signs(rows: DataFrame, inside_m: Column | None = None, localities: list[str] = ()) -> DataFrame:
    """Blue signs: located rows in scope, and rows without a position that are tied to a settlement of the council. A year counts only after a founding phrase of the sign's own text."""
    rows, inside_m = measured(padded(rows, SIGNS), inside_m)
    tied = is_true("in_emek_yizrael_council_boundary") | F.coalesce(F.col("emek_yizrael_settlement_matched") != "", F.lit(False)) | is_true("settlement_matches_emek_yizrael_list")
    there = F.col("lat").isNotNull() & F.col("lon").isNotNull()
    rows = rows.where(F.when(there, in_scope(inside_m)).otherwise(tied))
    old = F.coalesce(F.col("pre1700_keyword_flags") != "", F.lit(False)) | is_true("possible_archaeological_site")
    said, kind = text("sign_text"), text("site_category")
    name = F.coalesce(text("site_name"), text("shimur_sign_name"))
    image = F.try_element_at("image_files", F.lit(1))
    return claims(
        rows, "blue_signs", F.col("record_id"), name, [text("shimur_sign_name"), text("wikidata_label_he")], url=F.coalesce(text("site_wiki_article_url"), text("shimur_url"), text("wikipedia_source_page_url")),
        name_en=text("wikidata_label_en"), description=said, category_hint=F.when(kind.isin(CATEGORIES), kind).when(old, "archaeological").otherwise("historic"),
        type=site_type(name, said, text("shimur_sign_type")), periods=named_periods(said), year_from=founding_year(said), lat=F.col("lat"), lon=F.col("lon"),
        location_precision=F.when(F.col("coord_source").isin("hewiki_bluesign_table_coord_template", "hewiki_article_geotag"), "exact").when(F.col("lat").isNotNull(), "approx_500m").otherwise("unknown"),
        locality=F.coalesce(sane_locality(F.col("settlement"), localities), text("settlement")),
        maps={
            "statuses": {"signage": F.lit("blue_sign")}, "practical": {"address": F.coalesce(text("address"), text("shimur_address"))}, "ids": {"wikidata_qid": text("wikidata_qid"), "blue_sign_number": text("sign_number")},
            "extra": {
                "sign_text": said, "wikipedia_he": text("site_wiki_article_url"), "image_url": F.concat(F.lit("https://commons.wikimedia.org/wiki/Special:FilePath/"), image),
                "image_credit": F.when(image.isNotNull(), "Wikimedia Commons"), "sign_page_year_not_a_site_date": text("shimur_year_on_sign_page"),
            },
        },
    )


INSTITUTIONS = (
    "inst_id string, name_he string, name_en string, type string, settlement string, address string, lat double, lon double, coord_confidence string, fallback_settlement_lat double, fallback_settlement_lon double, active string, "
    "recognised_museum boolean, registered_public_library boolean, accessibility string, admission string, operating_body string, amuta string, website string, phone string, email string, opening_hours string, year_founded string, "
    "notes string, active_evidence string, in_scope_for_map boolean, fallback_settlement_source string, coord_source string"
)


def institutions(rows: DataFrame, inside_m: Column | None = None) -> DataFrame:
    """Cultural institutions that are in scope. Without a position, the settlement's centre stands in; a stated absence of access is tested before access."""
    rows = padded(rows, INSTITUTIONS).where(is_true("in_scope_for_map")).withColumn("_own", F.col("lat").isNotNull())
    rows = rows.withColumns({"lat": F.coalesce("lat", "fallback_settlement_lat"), "lon": F.when(F.col("_own"), F.col("lon")).otherwise(F.col("fallback_settlement_lon"))})
    rows, inside_m = measured(rows, inside_m)
    rows = rows if inside_m is None else rows.where(F.col("lat").isNull() | F.coalesce(inside_m > APRON, F.lit(True)))
    access, body, fee, activity = text("accessibility"), F.coalesce(text("operating_body"), F.lit("")), text("admission"), text("active")
    centre = ~F.col("_own") & F.col("lat").isNotNull()
    return claims(
        rows, "culture_institutions", F.col("inst_id"), text("name_he"), url=text("website"), name_en=text("name_en"), description=text("notes"), category_hint=F.lit("culture"), locality=text("settlement"),
        type=F.coalesce(lookup(text("type"), INSTITUTION_TYPES), site_type(text("name_he"), text("notes"))), lat=F.col("lat"), lon=F.col("lon"),
        location_precision=F.when(F.col("_own") & (text("coord_confidence") == "high"), "exact").when(centre, "locality_centroid").otherwise("approx_100m"),
        maps={
            "statuses": {
                "activity": cases([(activity == "yes", "active"), (activity == "no", "inactive"), (activity == "seasonal", "seasonal")]),
                "reg_institution": cases([(is_true("recognised_museum"), "recognized_museum"), (is_true("registered_public_library"), "public_library")]),
                "a11y_disabled": cases([(has(access, "אינו נגיש", "לא נגיש"), "not_accessible"), (has(access, "נגיש", "מעלון", "מעלית", "כסא", "כיסא", "שירותי נכים"), F.when(has(access, "חלקית"), "partial").otherwise("accessible"))]),
                "accessibility": F.when(fee.startswith("כן") | F.contains(fee, F.lit('ש"ח')), "open_paid").when(fee.isNotNull(), "open_free"),
                "ownership": cases([(has(body, "מועצה אזורית"), "council"), (has(body, "עמות") | text("amuta").isNotNull(), "ngo")]),
            },
            "practical": {
                "address": text("address"), "phone": text("phone"), "email": text("email"), "website": text("website"), "hours_text": text("opening_hours"), "admission": fee, "operator": text("operating_body"),
                "founded_year": F.col("year_founded"),
            },
            "extra": {"activity_evidence": text("active_evidence"), "institution_type_raw": text("type"), "position_is_settlement_centre": centre.cast("string"), "accessibility_detail": access,
                      "contact_is_private_sector": (~has(body, "מועצה", "עמות") & text("amuta").isNull()).cast("string")},
        },
    )


HERITAGE = (
    "record_type string, id string, slug string, OBJECTID string, site_name string, shimur_title string, title string, jsonld_name string, lat double, lon double, holds_blue_sign boolean, conservation_history string, shimur_text string, "
    "designation_type string, TYPE_NAME string, open_to_public boolean, publicAccess boolean, entrance_fee string, free_entry boolean, isAccessibleForFree boolean, `site_opening_hours__הערות` string, opening_hours string, period string, "
    "map_category_expected string, source_url string, url string, site_official_url string, site_notes string, sign_type string, sign_place string, jurisdiction_muni_heb string, sign_address string, site_phone string, site_email string, "
    "wikidata_qid string, sign_local_authority string, mavat_name string, statutory_designation string, station_desc string, shape_area double, pl_name string, pl_number string, AREA_SQM double, SOURCE string, NAME string"
)
#: Records that are named places, and records that are designations on a plan.
NAMED_RECORDS = ["shimur_blue_sign", "shimur_heritage_site", "candidate_lead_check", "kkl_travel_site"]
PLAN_RECORDS, PARK_RECORD = ["iplan_conservation_polygon", "iplan_conservation_point"], "tmm_park_or_reserve"


def heritage_records(rows: DataFrame, inside_m: Column | None = None, localities: list[str] = ()) -> DataFrame:
    """The named records of the heritage bodies; designations become the overlay instead."""
    rows, inside_m = measured(padded(rows, HERITAGE).where(F.col("record_type").isin(NAMED_RECORDS)), inside_m)
    rows = rows.where(in_scope(inside_m))
    kind, note, about = F.col("record_type"), F.coalesce(text("period"), F.lit("")), text("shimur_text")
    name = F.coalesce(text("site_name"), text("shimur_title"), text("title"))
    restored = has(text("conservation_history"), "שוחזר", "שוקם") | has(about, "שוחזר")
    fee, free = text("entrance_fee"), is_true("free_entry") | is_true("isAccessibleForFree")
    hours = F.coalesce(text("site_opening_hours__הערות"), text("opening_hours"))
    ancient = (F.contains(note, F.lit("pre-1700")) & ~F.contains(note, F.lit("post-1700"))) | ((kind == "candidate_lead_check") & has(text("map_category_expected"), "archaeological", "pre-1700"))
    named = named_periods(note)
    return claims(
        rows, "heritage_official", F.concat(kind, F.lit(":"), F.coalesce("id", "slug", "OBJECTID", F.lit("None"))), name, [text("shimur_title"), text("jsonld_name")],
        url=F.coalesce(text("source_url"), text("url"), text("site_official_url")), description=F.coalesce(about, text("site_notes")),
        category_hint=F.when((kind != "kkl_travel_site") & ancient, "archaeological").otherwise("historic"), type=site_type(name, about, text("sign_type")),
        periods=F.when(F.size(named) > 0, named).otherwise(named_periods(about)), date_text=F.when(note != "", note), lat=F.col("lat"), lon=F.col("lon"), location_precision=F.lit("approx_100m"),
        locality=F.coalesce(sane_locality(F.col("sign_place"), localities), sane_locality(F.col("jurisdiction_muni_heb"), localities)),
        maps={
            "statuses": {
                "signage": F.when(is_true("holds_blue_sign"), "blue_sign"), "reg_conservation": F.when(kind.isin("shimur_blue_sign", "shimur_heritage_site"), F.when(restored, "restored").otherwise("listed")),
                "protected_area": lookup(text("designation_type"), PROTECTED_KINDS),
                "accessibility": cases([(is_true("open_to_public") | is_true("publicAccess"), F.when(fee.isNotNull(), "open_paid").otherwise("open_free")), (has(hours, "תיאום"), "by_appointment")]),
            },
            "practical": {"address": text("sign_address"), "phone": text("site_phone"), "website": text("site_official_url"), "hours_text": hours, "admission": fee}, "ids": {"wikidata_qid": text("wikidata_qid")},
            "extra": {"record_type": kind, "sign_type": text("sign_type"), "designation_type": text("designation_type"), "period_note": F.when(note != "", note), "email_withheld": text("site_email").isNotNull().cast("string"),
                      "free_entry": F.when(free, "true"), "contact_is_private_sector": ((kind == "shimur_heritage_site") & text("sign_local_authority").isNull()).cast("string")},
        },
    )


def statutory_overlay(rows: DataFrame, inside_m: Column | None = None) -> DataFrame:
    """(axis, feature, lat, lon, radius_m, value, designation, plan, plan_number, stage, record_type, source_id): designations as points with the radius of a circle of their area, within bounds."""
    rows, inside_m = measured(padded(rows, HERITAGE), inside_m)
    rows = rows.where(in_scope(inside_m))
    plan, park = F.col("record_type").isin(PLAN_RECORDS), F.col("record_type") == PARK_RECORD
    named, protected = F.coalesce(text("mavat_name"), text("statutory_designation")), F.coalesce(text("designation_type"), text("TYPE_NAME"))
    approved = F.coalesce(text("station_desc").isin(APPROVED_STAGES), F.lit(False))

    def radius(area: str, low: float, high: float, without: float) -> Column:
        r = F.least(F.lit(high), F.greatest(F.lit(low), F.sqrt(F.col(area) / F.lit(3.141592653589793))))
        return F.round(F.when(F.col(area) > 0, r).otherwise(without), 1)

    value = F.when(plan & named.isin(DESIGNATIONS_LISTED), F.when(approved, "plan_approved").otherwise("listed")).when(park, lookup(protected, PROTECTED_KINDS))
    rows = rows.withColumn("value", value).where("value is not null")
    return rows.select(
        F.when(plan, "reg_conservation").otherwise("protected_area").alias("axis"), F.coalesce("id", "slug", "OBJECTID").alias("feature"), "lat", "lon",
        F.when(plan, radius("shape_area", 40.0, 400.0, 40.0)).otherwise(radius("AREA_SQM", 80.0, 1500.0, 300.0)).alias("radius_m"), "value", F.when(plan, named).otherwise(protected).alias("designation"),
        F.when(plan, text("pl_name")).otherwise(text("SOURCE")).alias("plan"), F.when(plan, text("pl_number")).alias("plan_number"), F.when(plan, text("station_desc")).alias("stage"), "record_type",
        F.lit("heritage_official").alias("source_id"),
    )


ADDED = (
    "record_id string, name string, name_en string, names_alt array<string>, description string, url string, category_hint string, type string, periods array<string>, year_from int, year_to int, date_text string, lat double, lon double, "
    "location_precision string, locality string, statuses map<string,string>, practical map<string,string>, ids map<string,string>, extra map<string,string>, supplied_by string, supplied_on string, source_note string"
)


def manual_additions(rows: DataFrame, inside_m: Column | None = None) -> DataFrame:
    """Entries that a person supplied: named ones, in scope if they have a position; periods and types are checked against the vocabularies."""
    rows = padded(rows, ADDED).where("name is not null and name != ''")
    rows, inside_m = measured(rows, inside_m)
    rows = rows.where(F.col("lat").isNull() | in_scope(inside_m))
    types = [t for group in SITE_TYPES.values() for t in group] + ["unknown"]
    supplied = {k: F.col(k) for k in ("supplied_by", "supplied_on", "source_note")}
    pairs = F.array(*(F.struct(F.lit(k).alias("k"), v.alias("v")) for k, v in supplied.items()))
    extra = F.map_concat(F.coalesce("extra", F.create_map().cast("map<string,string>")), F.map_from_entries(F.filter(pairs, lambda p: p["v"].isNotNull())))
    empty = lambda c: F.coalesce(c, F.create_map().cast("map<string,string>"))
    return claims(
        rows, "manual_curated", F.col("record_id"), F.col("name"), [F.try_element_at("names_alt", F.lit(k)) for k in range(1, 9)], url=F.col("url"), name_en=F.col("name_en"), description=F.col("description"),
        category_hint=F.col("category_hint"), type=F.when(F.col("type").isin(types), F.col("type")).otherwise(site_type(F.col("name"))), periods=F.filter("periods", lambda p: p.isin(list(PERIODS))),
        year_from=F.col("year_from"), year_to=F.col("year_to"), date_text=F.col("date_text"), lat=F.col("lat"), lon=F.col("lon"), location_precision=F.coalesce("location_precision", F.lit("unknown")),
        locality=F.col("locality"), statuses=empty("statuses"), practical=empty("practical"), ids=empty("ids"), extra=extra,
    )


def _either(payloads: dict[str, DataFrame], one: str, two: str) -> tuple[DataFrame, DataFrame]:
    """Two payloads of which one may be missing: it is empty then."""
    there = payloads.get(one, payloads.get(two))
    if there is None:
        raise KeyError(one)
    none = there.sparkSession.range(0).select(F.lit(None).cast("double").alias("lat"), F.lit(None).cast("double").alias("lon"))
    return payloads.get(one, none), payloads.get(two, none)


#: Adapters by source. Each takes its payloads, by name, and the context (inside_m, localities), and uses what it needs.
ADAPTERS: dict[str, Callable[[dict[str, DataFrame], Column | None, list[str]], DataFrame]] = {
    "declared_antiquities": lambda p, inside, _: declared_antiquities(*_either(p, "declared_antiquities", "declared_antiquities_known_survey_points"), inside),
    "iaa_discover": lambda p, inside, known: antiquities_register(p["iaa_discover"], inside, known),
    "iaa_cluster_table": lambda p, *_: conservation_survey(p["iaa_cluster_table"]),
    "heritage_official": lambda p, inside, known: heritage_records(p["heritage_official"], inside, known),
    "manual_curated": lambda p, inside, _: manual_additions(p["manual_additions"], inside),
    "blue_signs": lambda p, inside, known: blue_signs(p["blue_signs"], inside, known),
    "culture_institutions": lambda p, inside, _: institutions(p["culture_institutions"], inside),
    "iicp_culture_table": lambda p, *_: institute_inventory(p["iicp_culture_table"]),
    "osm_wikidata": lambda p, inside, known: map_cross_check(p["osm_wikidata"], inside, known),
}


def run_adapters(payloads: dict[str, DataFrame], inside_m: Column | None = None, localities: list[str] = (), only: list[str] | None = None) -> DataFrame:
    """The claims of all adapters (or of only some) whose payloads are there, in one DataFrame."""
    found = []
    for source, adapt in ADAPTERS.items():
        if only is None or source in only:
            try:
                found.append(adapt(payloads, inside_m, list(localities)))
            except KeyError as missing:
                if missing.args[0] in payloads:
                    raise
    if not found:
        raise ValueError("no payload for any adapter")
    return reduce(DataFrame.unionByName, found)
