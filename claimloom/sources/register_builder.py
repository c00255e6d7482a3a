"""The national register's payload, built from raw entities: declared sites with their licences and what is attached to them, excavations with their sites, survey sites with their sheet.

Entities: entityType, entityId, originEntityId, title and description struct<hebrew, english>, licenses array<struct<licenseId, longName>>, shapes array<struct<wkt>>, thesaurus
array<struct<categoryId, wordName struct<hebrew>>>, parentEntities array<struct<parentType, parentEntityId>>, _srcfile; one row for each (entityType, entityId), as claims.read_entities gives them.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from claimloom.functions.geo import to_itm, try_to_wgs84
from claimloom.functions.scalar import let

# The windows in the grid and in degrees, a licence's form, the status of a valid declaration, periods that reach past 1700, thesaurus categories.
WINDOW, WINDOW_DEGREES = (197000.0, 709000.0, 249000.0, 752000.0), (32.55, 32.85, 35.05, 35.50)
LICENCE = r"^([A-Za-z]+)-(\d+(?:/\d+)?)/(\d{4})(?:-(\d+))?$"
DECLARED = "מוכרז/תקין"
LATE_PERIODS = ["עות'מנית", "ממלוכית-עותומנית", "ממלוכית-עותומנית-מודרנית", "מודרנית", "מנדט בריטי", "אסלאמית מאוחרת", "אסלאמית"]
PERIOD_WORDS, CONTEXT_WORDS = 4, 5

_POINT = "array<struct<x:double,y:double>>"


def vertices(wkt: Column) -> Column:
    """All points of a WKT text, as an array of structs (x, y); empty if it holds none."""
    pairs = F.regexp_extract_all(F.coalesce(wkt, F.lit("")), F.lit(r"-?\d+(?:\.\d+)?\s+-?\d+(?:\.\d+)?"), F.lit(0))
    return F.transform(pairs, lambda p: F.struct(F.element_at(F.split(p, r"\s+"), 1).cast("double").alias("x"), F.element_at(F.split(p, r"\s+"), 2).cast("double").alias("y")))


def _extent(points: Column) -> Column:
    x, y = F.transform(points, lambda p: p["x"]), F.transform(points, lambda p: p["y"])
    return F.struct(F.array_min(x).alias("x1"), F.array_min(y).alias("y1"), F.array_max(x).alias("x2"), F.array_max(y).alias("y2"))


def _area(points: Column) -> Column:
    """Area of a closed ring of points."""
    n = F.size(points)
    steps = F.transform(F.sequence(F.lit(1), n - 1), lambda i: F.element_at(points, i)["x"] * F.element_at(points, i + 1)["y"] - F.element_at(points, i + 1)["x"] * F.element_at(points, i)["y"])
    return F.abs(F.aggregate(steps, F.lit(0.0), lambda a, b: a + b)) / 2


def shape_summary(rows: DataFrame) -> DataFrame:
    """rows with the extent of their shapes together, its centre (grid and degrees), how uncertain that is (half the longer side), the number of shapes, and whether a single shape is a rectangle along the grid."""
    shapes = F.filter(F.transform(F.coalesce("shapes", F.array().cast("array<struct<wkt:string>>")), lambda s: vertices(s["wkt"])), lambda p: F.size(p) > 0)
    out = rows.withColumn("_s", shapes).withColumn("_e", F.when(F.size("_s") > 0, _extent(F.flatten("_s"))))
    e, one = F.col("_e"), F.element_at("_s", 1)
    box = (e["x2"] - e["x1"]) * (e["y2"] - e["y1"])
    rect = (F.size(one) == 5) & F.element_at("shapes", 1)["wkt"].startswith("POLYGON") & (F.abs(_area(one) - box) < F.greatest(F.lit(1.0), 0.02 * _area(one)))
    out = out.withColumns({
        "derived_itm_x": F.round((e["x1"] + e["x2"]) / 2, 2), "derived_itm_y": F.round((e["y1"] + e["y2"]) / 2, 2), "derived_bbox_width_m": F.round(e["x2"] - e["x1"], 1), "derived_bbox_height_m": F.round(e["y2"] - e["y1"], 1),
        "derived_position_uncertainty_m": F.round(F.greatest(e["x2"] - e["x1"], e["y2"] - e["y1"]) / 2, 1), "derived_n_shapes": F.size("_s"), "derived_shape_is_rectangle": F.when(F.size("_s") == 1, rect),
    })
    at = try_to_wgs84(F.col("derived_itm_x"), F.col("derived_itm_y"))
    return out.withColumn("_at", at).withColumns({"lat": F.col("_at.lat"), "lon": F.col("_at.lon")}).drop("_s", "_e", "_at")


def in_window(shapes: Column, window: tuple[float, float, float, float] = WINDOW) -> Column:
    """Whether the extent of any shape meets the window; exact for shapes that are rectangles along the grid."""
    x1, y1, x2, y2 = window

    def meets(s: Column) -> Column:
        return let(vertices(s["wkt"]), lambda p: let(_extent(p), lambda e: (F.size(p) > 0) & (e["x1"] <= x2) & (e["x2"] >= x1) & (e["y1"] <= y2) & (e["y2"] >= y1)))

    return F.coalesce(F.exists(shapes, meets), F.lit(False))


def licence(name: Column) -> Column:
    """struct(prefix, number, year) of a licence's long name; null parts if it has another form."""
    part = lambda k: F.when(F.trim(name).rlike(LICENCE), F.regexp_extract(F.trim(name), LICENCE, k))
    return F.struct(part(1).alias("prefix"), part(2).alias("number"), part(3).cast("int").alias("year"))


def title_year(title: Column) -> Column:
    """The year in square brackets of a title, the Hebrew one before the English one."""
    t = F.coalesce(F.when(title["hebrew"] != "", title["hebrew"]), title["english"])
    return F.when(t.rlike(r"\[\d{4}\]"), F.regexp_extract(t, r"\[(\d{4})\]", 1).cast("int"))


def responsible(description: Column) -> Column:
    """Who is responsible: what follows the first colon of a description, or all of it."""
    d = description["hebrew"]
    after = F.trim(F.when(F.contains(d, F.lit(":")), F.element_at(F.split(d, ":", 2), 2)).otherwise(d))
    return F.when(after != "", after)


def words(thesaurus: Column, category: int) -> Column:
    """The sorted distinct words of one category of the thesaurus; null without any."""
    found = F.array_sort(F.array_distinct(F.array_compact(F.transform(F.filter(thesaurus, lambda t: t["categoryId"] == category), lambda t: t["wordName"]["hebrew"]))))
    return F.when(F.size(found) > 0, found)


def _of(entities: DataFrame, kind: str) -> DataFrame:
    return entities.where(F.col("entityType") == kind)


def licence_parents(entities: DataFrame) -> DataFrame:
    """(lid, hachrazot, excavations, surveys): what each licence's own record names; the authoritative relation."""
    p = _of(entities, "license").select(F.col("originEntityId").try_cast("long").alias("lid"), F.coalesce("parentEntities", F.array().cast("array<struct<parentType:string,parentEntityId:string>>")).alias("p")).where("lid is not null")
    ids = lambda kind: F.transform(F.filter("p", lambda x: x["parentType"] == kind), lambda x: x["parentEntityId"])
    return p.groupBy("lid").agg(*(F.array_distinct(F.flatten(F.collect_list(ids(k)))).alias(k) for k in ("hachrazot", "excavations", "surveys")))


def licence_activities(activities: DataFrame) -> DataFrame:
    """(lid, excavation, survey): the activities that were found by a licence, for licences without a record of their own."""
    each = activities.select("entityType", "entityId", F.explode("licenses").alias("l")).select("entityType", "entityId", F.col("l.licenseId").alias("lid"))
    return each.groupBy("lid").agg(*(F.collect_set(F.when(F.col("entityType") == k, F.col("entityId"))).alias(k) for k in ("excavation", "survey")))


def classified_licences(entities: DataFrame, activities: DataFrame) -> DataFrame:
    """(site, at, lid, name, route, kind, excavations, surveys) of every licence of every declared site. By the licence's own record, if there is one, else by the activities found with it; a record that doesn't name
    the site makes the licence another one, whatever the activities say; without either it is unresolved."""
    sites = _of(entities, "hachraza").select(F.col("entityId").alias("site"), F.posexplode("licenses").alias("at", "l")).select("site", "at", F.col("l.licenseId").alias("lid"), F.col("l.longName").alias("name"))
    found = sites.join(licence_parents(entities), "lid", "left").join(licence_activities(activities), "lid", "left")
    own, other = F.col("hachrazot").isNotNull(), F.col("excavation").isNotNull()
    named = own & F.array_contains("hachrazot", F.col("site"))
    route = F.when(named, "bidirectional").when(~own & other, "site_asserted")
    none = F.array().cast("array<string>")
    digs, looks = F.when(named, F.col("excavations")).when(~own & other, F.col("excavation")).otherwise(none), F.when(named, F.col("surveys")).when(~own & other, F.col("survey")).otherwise(none)
    kind = F.when(own & ~named, "other").when(~own & ~other, "unresolved").when(F.size(digs) > 0, "excavation").when(F.size(looks) > 0, "survey").otherwise("other")
    return found.select("site", "at", "lid", "name", route.alias("route"), kind.alias("kind"), digs.alias("excavations"), looks.alias("surveys"))


def attached(entities: DataFrame) -> DataFrame:
    """(site, entityType, children): entities that name a declared site as their parent, once each: id, number, titles, who is responsible, the title's year, licences."""
    each = entities.select("entityType", "entityId", "originEntityId", "title", "description", "licenses", F.explode("parentEntities").alias("p")).where("p.parentType = 'hachrazot'")
    short = F.struct("entityId", "originEntityId", F.col("title.hebrew").alias("title_hebrew"), F.col("title.english").alias("title_english"), responsible(F.col("description")).alias("responsible_hebrew"), title_year(F.col("title")).alias("year_from_title"), F.transform("licenses", lambda x: x["longName"]).alias("licenses"))
    return each.groupBy(F.col("p.parentEntityId").alias("site"), "entityType").agg(F.array_sort(F.collect_set(short)).alias("children"))


def declared_sites(entities: DataFrame, activities: DataFrame, details: DataFrame, layer: DataFrame) -> DataFrame:
    """Declared sites whose shapes meet the window, with their licences' kinds and years, whether they were excavated (null: it can't be said) and on what evidence, periods, and what details say; then the sites that
    only the map layer has, so that nothing it holds is missing.

    details: hachrazaId, atarStatus, ataId, ataTatId, isPublicAtar. layer: atar_number, ata_shem, ata_id, ata_tat_id.
    """
    lic = classified_licences(entities, activities)
    by = lambda k: F.transform(F.sort_array(F.collect_list(F.when(F.col("kind") == k, F.struct("at", "name")))), lambda x: x["name"])
    every = lambda c: F.array_sort(F.array_distinct(F.flatten(F.collect_list(c))))
    of = lic.groupBy("site").agg(
        by("excavation").alias("dig_names"), by("survey").alias("survey_names"), by("unresolved").alias("unresolved_names"), every("excavations").alias("digs"), every("surveys").alias("looks"),
        F.max(F.when((F.col("kind") == "excavation") & (F.col("route") == "bidirectional"), 1)).alias("strong"), F.max(F.when((F.col("kind") == "excavation") & (F.col("route") == "site_asserted"), 1)).alias("weak"),
    )
    kids = attached(entities).where("entityType = 'excavation'").select("site", F.size("children").alias("kids"))
    rows = _of(entities, "hachraza").where(in_window(F.col("shapes")))
    rows = shape_summary(rows).join(of, F.col("entityId") == F.col("site"), "left").drop("site").join(kids, F.col("entityId") == F.col("site"), "left").drop("site")
    rows = rows.join(details.withColumn("_known", F.lit(True)), F.col("originEntityId") == F.col("hachrazaId"), "left")
    none = F.coalesce(F.size("licenses"), F.lit(0)) <= 0
    dug = (F.coalesce(F.size("dig_names"), F.lit(0)) > 0) | (F.coalesce(F.size("digs"), F.lit(0)) > 0) | (F.coalesce("kids", F.lit(0)) > 0)
    looked = (F.coalesce(F.size("survey_names"), F.lit(0)) > 0) & (F.coalesce(F.size("unresolved_names"), F.lit(0)) <= 0)
    parsed = F.transform("licenses", lambda x: licence(x["longName"]))
    years = F.array_sort(F.array_distinct(F.array_compact(F.transform(parsed, lambda p: p["year"]))))
    periods = words(F.col("thesaurus"), PERIOD_WORDS)
    some = lambda c: F.when(F.size(c) > 0, F.col(c))
    out = rows.select(
        F.lit("declared_site").alias("_record_type"), "entityId", "originEntityId", F.col("title.hebrew").alias("title_he"), *(c for c in rows.columns if c.startswith("derived_") or c in ("lat", "lon")),
        F.col("originEntityId").alias("derived_site_number"), F.col("ataId").cast("string").alias("derived_site_number_main"), F.when(F.col("_known"), F.coalesce(F.col("ataTatId"), F.lit(0)) != 0).alias("derived_is_sub_site"),
        F.when(F.col("_known"), F.coalesce(F.col("atarStatus") == DECLARED, F.lit(False))).alias("derived_is_declared"), F.col("isPublicAtar").alias("derived_public_access_flag"),
        F.when(F.size(years) > 0, years).alias("derived_licence_years"), some("dig_names").alias("derived_excavation_licence_names_confirmed"), some("survey_names").alias("derived_survey_licence_names_confirmed"),
        some("unresolved_names").alias("derived_licence_names_unresolved"), some("digs").alias("derived_excavation_entity_ids"), F.when(F.col("strong") == 1, "bidirectional").when(F.col("weak") == 1, "site_asserted").alias("derived_excavation_link_strength"),
        F.when(dug, True).when(none, False).alias("derived_was_excavated"),
        F.when(dug, "confirmed_excavation_licence").when(none, "no_licences_at_all").when(looked, "survey_licences_only").otherwise("unresolved").alias("derived_excavation_evidence"),
        periods.alias("derived_periods_he"), words(F.col("thesaurus"), CONTEXT_WORDS).alias("derived_archaeological_contexts_he"), F.coalesce(F.arrays_overlap(periods, F.array(*map(F.lit, LATE_PERIODS))), F.lit(False)).alias("derived_period_span_crosses_1700"),
    )
    only = layer.join(out.select(F.col("derived_site_number").alias("atar_number")), "atar_number", "left_anti").select(
        F.lit("declared_site").alias("_record_type"), F.col("atar_number").alias("originEntityId"), F.col("ata_shem").alias("title_he"), F.col("atar_number").alias("derived_site_number"),
        F.col("ata_id").cast("string").alias("derived_site_number_main"), (F.coalesce("ata_tat_id", F.lit(0)) != 0).alias("derived_is_sub_site"), F.lit("no_api_record").alias("derived_excavation_evidence"),
    )
    return out.unionByName(only, allowMissingColumns=True)


def excavations(entities: DataFrame) -> DataFrame:
    """Excavations whose shapes meet the window, with the declared sites that their licences' records name."""
    held = _of(entities, "hachraza").select(F.col("entityId").alias("site"), F.col("originEntityId").alias("number"))
    names = licence_parents(entities).select("lid", F.explode("hachrazot").alias("site")).join(held, "site")
    rows = _of(entities, "excavation").where(in_window(F.col("shapes")))
    of = rows.select("entityId", F.explode("licenses").alias("l")).select("entityId", F.col("l.licenseId").alias("lid")).join(names, "lid")
    of = of.groupBy("entityId").agg(F.transform(F.array_sort(F.collect_set(F.struct("site", "number"))), lambda x: x["number"]).alias("numbers"))
    out = shape_summary(rows).join(of, "entityId", "left")
    return out.select(
        F.lit("excavation").alias("_record_type"), "entityId", "originEntityId", F.col("title.hebrew").alias("title_he"), *(c for c in out.columns if c.startswith("derived_") or c in ("lat", "lon")),
        responsible(F.col("description")).alias("derived_excavator_he"), title_year(F.col("title")).alias("derived_year_from_title"), F.array_join("numbers", ";").alias("derived_attached_declared_site_numbers"),
        F.array_join(F.array_compact(F.transform("licenses", lambda x: licence(x["longName"])["year"].cast("string"))), ";").alias("derived_excavation_years"),
    )


def survey_sites(points: DataFrame, sheets: DataFrame) -> DataFrame:
    """Survey points inside the window of degrees with their sheet. points: id, site_num, gis_map_id, name_heb, description_heb, lon, lat; sheets: id, map_num, name."""
    low, high, west, east = WINDOW_DEGREES
    kept = points.where(F.col("lat").between(low, high) & F.col("lon").between(west, east))
    meta = sheets.select(F.col("id").cast("string").alias("gis_map_id"), "map_num", F.col("name").alias("map_name"))
    out = kept.withColumn("gis_map_id", F.col("gis_map_id").cast("string")).join(meta, "gis_map_id", "left").withColumn("_at", to_itm("lat", "lon"))
    return out.select(
        F.lit("survey_site").alias("_record_type"), F.col("id").cast("string").alias("id"), F.col("site_num").cast("string").alias("site_num"), "gis_map_id", "name_heb", "description_heb", F.round("lat", 7).alias("lat"), F.round("lon", 7).alias("lon"),
        F.col("_at.x").alias("derived_itm_x"), F.col("_at.y").alias("derived_itm_y"), "map_num", "map_name", F.concat("map_num", F.lit("/"), F.col("site_num").cast("string")).alias("derived_survey_site_ref"),
    )


def register_payload(*kinds: DataFrame) -> DataFrame:
    """All records in one table; columns that a kind of record lacks are null."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), kinds)
