"""Queries on the register builder: customers are declared sites, orders licences, suppliers excavations, parts survey points."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from claimloom.plans.adapter_queries import pick, picked
from claimloom.sources import register_builder as build
from claimloom.sources.files import table

_NAMES = ["A-4090/2004", "C-30/1956-1", "G-7/12/1999", "none"]
_TITLES = ["חפירה [1998]", "חפירה", "סקר [0012]"]
_WORDS = ["רומית", "עות'מנית", "ביזנטית"]


def entities(spark: SparkSession, sf_dir: str) -> DataFrame:
    c, o, s = F.col("c_custkey").cast("long"), F.col("o_orderkey").cast("long"), F.col("s_suppkey").cast("long")
    box = lambda k: F.format_string("POLYGON ((%1$d.5 %2$d, %3$d.5 %2$d, %3$d.5 %4$d, %1$d.5 %4$d, %1$d.5 %2$d))", (195000 + k * 37 % 60000).cast("long"), (705000 + k * 91 % 50000).cast("long"), (195000 + k * 37 % 60000 + 100 + k % 7 * 10).cast("long"), (705000 + k * 91 % 50000 + 60).cast("long"))
    title = lambda k: F.struct(pick(k, _TITLES, 1).alias("hebrew"), F.lit("dig").alias("english"))
    none = {"thesaurus": "array<struct<categoryId:int,wordName:struct<hebrew:string>>>", "shapes": "array<struct<wkt:string>>", "licenses": "array<struct<licenseId:bigint,longName:string>>", "parentEntities": "array<struct<parentType:string,parentEntityId:string>>"}
    lic = table(spark, sf_dir, "orders").where("o_orderkey % 3 <> 0").select(
        F.lit("license").alias("entityType"), F.concat(F.lit("l"), o.cast("string")).alias("entityId"), o.cast("string").alias("originEntityId"),
        F.filter(F.array(
            F.when(o % 5 != 0, F.struct(F.lit("hachrazot").alias("parentType"), F.concat(F.lit("h"), F.col("o_custkey").cast("string")).alias("parentEntityId"))),
            F.when(o % 2 == 0, F.struct(F.lit("excavations").alias("parentType"), F.concat(F.lit("x"), (o % 50).cast("string")).alias("parentEntityId"))), F.when(o % 7 == 0, F.struct(F.lit("surveys").alias("parentType"), F.lit("y1").alias("parentEntityId"))),
        ), lambda p: p.isNotNull()).alias("parentEntities"),
    )
    held = table(spark, sf_dir, "orders").groupBy(F.col("o_custkey").cast("long").alias("c_custkey")).agg(F.transform(F.sort_array(F.collect_list(F.col("o_orderkey").cast("long"))), lambda x: F.struct(x.alias("licenseId"), pick(x, _NAMES, 1).alias("longName"))).alias("licenses"))
    sites = table(spark, sf_dir, "customer").select(c.alias("c_custkey")).join(held, "c_custkey", "left").select(
        F.lit("hachraza").alias("entityType"), F.concat(F.lit("h"), c.cast("string")).alias("entityId"), F.concat(c.cast("string"), F.lit("/0")).alias("originEntityId"), title(c).alias("title"), "licenses", F.array(F.struct(box(c).alias("wkt"))).alias("shapes"),
        F.array(F.struct(F.lit(4).alias("categoryId"), F.struct(pick(c, _WORDS, 1).alias("hebrew")).alias("wordName")), F.struct(F.lit(5).alias("categoryId"), F.struct(F.lit("בור").alias("hebrew")).alias("wordName"))).alias("thesaurus"),
    )
    digs = table(spark, sf_dir, "supplier").select(
        F.lit("excavation").alias("entityType"), F.concat(F.lit("x"), s.cast("string")).alias("entityId"), s.cast("string").alias("originEntityId"), title(s).alias("title"), F.struct(F.concat(F.lit("אחראי: פלוני "), s.cast("string")).alias("hebrew")).alias("description"),
        F.array(F.struct((s * 4).alias("licenseId"), pick(s, _NAMES, 1).alias("longName")), F.struct((s * 4 + 1).alias("licenseId"), F.lit("B-1/2001").alias("longName"))).alias("licenses"), F.array(F.struct(box(s).alias("wkt"))).alias("shapes"),
        F.when(s % 10 == 0, F.array(F.struct(F.lit("hachrazot").alias("parentType"), F.concat(F.lit("h"), (s * 3).cast("string")).alias("parentEntityId")))).alias("parentEntities"),
    )
    out = build.register_payload(sites, lic, digs)
    return out.withColumns({n: F.coalesce(F.col(n), F.array().cast(t)) if n != "licenses" else F.col(n) for n, t in none.items()})


def _activities(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What was found by licences: some of those that have no record of their own."""
    o = F.col("o_orderkey").cast("long")
    return table(spark, sf_dir, "orders").where("o_orderkey % 9 = 0").select(F.when(o % 2 == 0, "excavation").otherwise("survey").alias("entityType"), F.concat(F.lit("z"), o.cast("string")).alias("entityId"), F.array(F.struct(o.alias("licenseId"))).alias("licenses"))


def licence_graph(spark, sf_dir):
    """Every licence of every declared site, classified by its own record or by the activities that were found with it."""
    found = build.classified_licences(entities(spark, sf_dir), _activities(spark, sf_dir))
    return found.select("site", "lid", "name", "route", "kind", F.array_join("excavations", ",").alias("excavations"), F.array_join("surveys", ",").alias("surveys"))


def register_sites(spark, sf_dir):
    c = F.col("c_custkey").cast("long")
    details = table(spark, sf_dir, "customer").where("c_custkey % 4 <> 0").select(F.concat(c.cast("string"), F.lit("/0")).alias("hachrazaId"), F.when(c % 3 == 0, "לא להכרזה").otherwise("מוכרז/תקין").alias("atarStatus"), c.alias("ataId"), (c % 2).cast("int").alias("ataTatId"), (c % 5 == 0).alias("isPublicAtar"))
    layer = table(spark, sf_dir, "customer").where("c_custkey % 2 = 0").select(F.concat(c.cast("string"), F.when(c % 6 == 0, "/9").otherwise("/0")).alias("atar_number"), F.lit("שם").alias("ata_shem"), c.alias("ata_id"), F.lit(None).cast("int").alias("ata_tat_id"))
    out = build.declared_sites(entities(spark, sf_dir), _activities(spark, sf_dir), details, layer)
    join = lambda n: F.array_join(n, ",").alias(n.removeprefix("derived_"))
    return out.select(
        "entityId", "derived_site_number", "derived_site_number_main", "derived_is_sub_site", "derived_is_declared", "derived_was_excavated", "derived_excavation_evidence", "derived_excavation_link_strength", "derived_itm_x", "derived_itm_y",
        "derived_position_uncertainty_m", "derived_shape_is_rectangle", "derived_period_span_crosses_1700", join("derived_excavation_licence_names_confirmed"), join("derived_licence_names_unresolved"), join("derived_licence_years"), join("derived_periods_he"),
    )


def register_excavations(spark, sf_dir):
    out = build.excavations(entities(spark, sf_dir))
    return out.select("entityId", "derived_itm_x", "derived_n_shapes", "derived_excavator_he", "derived_year_from_title", "derived_attached_declared_site_numbers", "derived_excavation_years")


def register_surveys(spark, sf_dir):
    k = F.col("p_partkey").cast("long")
    points = table(spark, sf_dir, "part").select(k.alias("id"), (k % 90).alias("site_num"), (k % 11).alias("gis_map_id"), F.col("p_name").alias("name_heb"), F.lit(None).cast("string").alias("description_heb"), (35.0 + k * 7 % 600 / 1000.0).alias("lon"), (32.5 + k * 11 % 400 / 1000.0).alias("lat"))
    sheets = table(spark, sf_dir, "nation").where("n_nationkey < 9").select(F.col("n_nationkey").alias("id"), F.concat(F.lit("m"), F.col("n_nationkey").cast("string")).alias("map_num"), F.col("n_name").alias("name"))
    return build.survey_sites(points, sheets).select("id", "lat", "lon", "map_num", "map_name", "derived_survey_site_ref")


def attached_children(spark, sf_dir):
    found = build.attached(entities(spark, sf_dir))
    one = F.element_at("children", 1)
    return found.select("site", "entityType", F.size("children").alias("n"), one["entityId"].alias("first"), one["responsible_hebrew"].alias("responsible"), one["year_from_title"].alias("year"))


_X, _Y = "(195000 + k * 37 % 60000)", "(705000 + k * 91 % 50000)"
_IN = f"({_X} + 0.5 <= 249000 AND {_X} + 100 + k % 7 * 10 + 0.5 >= 197000 AND {_Y} <= 752000 AND {_Y} + 60 >= 709000)"
_GRAPH = f"""g AS (SELECT 'h' || o_custkey AS site, CAST(o_custkey AS BIGINT) AS c, CAST(o_orderkey AS BIGINT) AS lid, {picked("o_orderkey", _NAMES, 1)} AS name,
CASE WHEN o_orderkey % 3 <> 0 THEN CASE WHEN o_orderkey % 5 <> 0 THEN 'bidirectional' END WHEN o_orderkey % 9 = 0 THEN 'site_asserted' END AS route FROM orders),
l AS (SELECT *, CASE WHEN route = 'bidirectional' AND lid % 2 = 0 THEN 'x' || (lid % 50) WHEN route = 'site_asserted' AND lid % 2 = 0 THEN 'z' || lid ELSE '' END AS excavations,
CASE WHEN route = 'bidirectional' AND lid % 7 = 0 THEN 'y1' WHEN route = 'site_asserted' AND lid % 2 = 1 THEN 'z' || lid ELSE '' END AS surveys FROM g),
k AS (SELECT *, CASE WHEN route IS NULL THEN CASE WHEN lid % 3 <> 0 THEN 'other' ELSE 'unresolved' END WHEN excavations <> '' THEN 'excavation' WHEN surveys <> '' THEN 'survey' ELSE 'other' END AS kind FROM l)"""
_YEARS = {"A-4090/2004": 2004, "C-30/1956-1": 1956, "G-7/12/1999": 1999}

QUERIES = {f.__name__: f for f in (licence_graph, register_sites, register_excavations, register_surveys, attached_children)}
ORACLES = {
    "licence_graph": f"WITH {_GRAPH} SELECT site, lid, name, route, kind, excavations, surveys FROM k",
    "register_sites": f"""WITH {_GRAPH}, a AS (SELECT c, count(*) AS n, string_agg(name, ',' ORDER BY lid) FILTER (WHERE kind = 'excavation') AS digs, string_agg(name, ',' ORDER BY lid) FILTER (WHERE kind = 'unresolved') AS unresolved, count(*) FILTER (WHERE kind = 'survey') AS looks,
max(kind = 'excavation' AND route = 'bidirectional') AS strong, max(kind = 'excavation' AND route = 'site_asserted') AS weak,
string_agg(DISTINCT CASE name {" ".join(f"WHEN '{n}' THEN '{y}'" for n, y in _YEARS.items())} END, ',' ORDER BY CASE name {" ".join(f"WHEN '{n}' THEN '{y}'" for n, y in _YEARS.items())} END) AS years FROM k GROUP BY c),
s AS (SELECT CAST(c_custkey AS BIGINT) AS k FROM customer), x AS (SELECT DISTINCT s_suppkey * 3 AS c FROM supplier WHERE s_suppkey % 10 = 0),
r AS (SELECT s.k, a.*, a.digs IS NOT NULL OR x.c IS NOT NULL AS dug FROM s LEFT JOIN a ON a.c = s.k LEFT JOIN x ON x.c = s.k WHERE {_IN})
SELECT 'h' || k AS "entityId", k || '/0' AS derived_site_number, CASE WHEN k % 4 <> 0 THEN CAST(k AS VARCHAR) END AS derived_site_number_main, CASE WHEN k % 4 <> 0 THEN k % 2 <> 0 END AS derived_is_sub_site, CASE WHEN k % 4 <> 0 THEN k % 3 <> 0 END AS derived_is_declared,
CASE WHEN dug THEN TRUE WHEN n IS NULL THEN FALSE END AS derived_was_excavated, CASE WHEN dug THEN 'confirmed_excavation_licence' WHEN n IS NULL THEN 'no_licences_at_all' WHEN looks > 0 AND unresolved IS NULL THEN 'survey_licences_only' ELSE 'unresolved' END AS derived_excavation_evidence,
CASE WHEN strong THEN 'bidirectional' WHEN weak THEN 'site_asserted' END AS derived_excavation_link_strength, {_X} + 0.5::DOUBLE + (100 + k % 7 * 10) / 2.0::DOUBLE AS derived_itm_x, {_Y} + 30::DOUBLE AS derived_itm_y, (100 + k % 7 * 10) / 2.0::DOUBLE AS derived_position_uncertainty_m,
TRUE AS derived_shape_is_rectangle, k % 3 = 1 AS derived_period_span_crosses_1700, digs AS excavation_licence_names_confirmed, unresolved AS licence_names_unresolved, years AS licence_years, {picked("k", _WORDS, 1)} AS periods_he FROM r
UNION ALL SELECT NULL, n, CAST(k AS VARCHAR), FALSE, NULL, NULL, 'no_api_record', NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL FROM (SELECT k, k || CASE WHEN k % 6 = 0 THEN '/9' ELSE '/0' END AS n FROM s WHERE k % 2 = 0) z WHERE NOT (k % 6 <> 0 AND {_IN})""",
    "register_excavations": f"""WITH s AS (SELECT CAST(s_suppkey AS BIGINT) AS k FROM supplier), o AS (SELECT CAST(o_orderkey AS BIGINT) AS lid, o_custkey AS c FROM orders WHERE o_orderkey % 3 <> 0 AND o_orderkey % 5 <> 0),
n AS (SELECT s.k, string_agg(DISTINCT c || '/0', ';' ORDER BY c || '/0') AS numbers, string_agg(DISTINCT 'h' || c, ';') AS h FROM s JOIN o ON o.lid IN (s.k * 4, s.k * 4 + 1) JOIN customer ON c_custkey = c GROUP BY s.k)
SELECT 'x' || s.k AS "entityId", {_X.replace("k", "s.k")} + 0.5::DOUBLE + (100 + s.k % 7 * 10) / 2.0::DOUBLE AS derived_itm_x, 1 AS derived_n_shapes, 'פלוני ' || s.k AS derived_excavator_he, CAST({picked("s.k", [1998, None, 12], 1)} AS INT) AS derived_year_from_title,
numbers AS derived_attached_declared_site_numbers, {picked("s.k", ["2004;2001", "1956;2001", "1999;2001", "2001"], 1)} AS derived_excavation_years FROM s LEFT JOIN n ON n.k = s.k WHERE {_IN.replace("k ", "s.k ")}""",
    "register_surveys": """WITH p AS (SELECT CAST(p_partkey AS BIGINT) AS k, 35.0::DOUBLE + (p_partkey * 7 % 600) / 1000.0::DOUBLE AS lon, 32.5::DOUBLE + (p_partkey * 11 % 400) / 1000.0::DOUBLE AS lat FROM part)
SELECT CAST(k AS VARCHAR) AS id, round(lat, 7) AS lat, round(lon, 7) AS lon, CASE WHEN k % 11 < 9 THEN 'm' || (k % 11) END AS map_num, n_name AS map_name, CASE WHEN k % 11 < 9 THEN 'm' || (k % 11) || '/' || (k % 90) END AS derived_survey_site_ref
FROM p LEFT JOIN nation ON n_nationkey = k % 11 AND n_nationkey < 9 WHERE lat BETWEEN 32.55 AND 32.85 AND lon BETWEEN 35.05 AND 35.5""",
    "attached_children": f"""SELECT 'h' || (s_suppkey * 3) AS site, 'excavation' AS "entityType", CAST(1 AS INT) AS n, 'x' || s_suppkey AS first, 'פלוני ' || s_suppkey AS responsible, CAST({picked("s_suppkey", [1998, None, 12], 1)} AS INT) AS year FROM supplier WHERE s_suppkey % 10 = 0
UNION ALL SELECT 'h' || o_custkey, 'license', CAST(count(*) AS INT), min('l' || o_orderkey), NULL, NULL FROM orders WHERE o_orderkey % 3 <> 0 AND o_orderkey % 5 <> 0 GROUP BY o_custkey""",
}
