"""Adapter queries: payload columns are picked from lists by a table's key, and the SQL picks from lists of what they must become, written by hand."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from claimloom.functions import names
from claimloom.sources import adapters
from claimloom.sources.files import table


def pick(k: Column, values: list, step: int) -> Column:
    """The value at place key * step modulo their number."""
    return F.element_at(F.array(*map(F.lit, values)), (k * step % len(values) + 1).cast("int"))


def picked(k: str, values: list, step: int) -> str:
    return f"list_extract([{', '.join(literal(v) for v in values)}], CAST({k} * {step} % {len(values)} + 1 AS INT))"


def literal(v) -> str:
    return "NULL" if v is None else str(v).upper() if isinstance(v, bool) else "'" + v.replace("'", "''") + "'" if isinstance(v, str) else repr(v)


class Picked:
    """Columns of a payload: name -> (values, step)."""

    def __init__(self, source: str, key: str, columns: dict[str, tuple[list, int]], lat: tuple[float, int] | None = (32.55, 37), missing: int = 0):
        self.source, self.key, self.columns, self.lat, self.missing = source, key, columns, lat, missing

    def rows(self, spark: SparkSession, sf_dir: str) -> DataFrame:
        k = F.col(self.key).cast("long")
        out = [k.alias("k"), *(pick(k, v, s).alias(n) for n, (v, s) in self.columns.items())]
        if self.lat:
            there = k % self.missing != 0 if self.missing else F.lit(True)
            out += [F.when(there, self.lat[0] + k * self.lat[1] % 3000 / 10000.0).alias("lat"), F.when(there, 35.05 + k * 91 % 4500 / 10000.0).alias("lon")]
        return table(spark, sf_dir, self.source).select(*out)

    def sql(self, more: dict[str, tuple[list, int]]) -> str:
        """FROM clause: k, the columns and more, columns of expected values."""
        parts = [f"{picked(self.key, v, s)} AS \"{n}\"" for n, (v, s) in {**self.columns, **more}.items()]
        if self.lat:
            there = f"{self.key} % {self.missing} <> 0" if self.missing else "TRUE"
            parts += [f"CASE WHEN {there} THEN {self.lat[0]}::DOUBLE + ({self.key} * {self.lat[1]} % 3000) / 10000.0::DOUBLE END AS lat", f"CASE WHEN {there} THEN 35.05::DOUBLE + ({self.key} * 91 % 4500) / 10000.0::DOUBLE END AS lon"]
        return f"(SELECT CAST({self.key} AS BIGINT) AS k, {', '.join(parts)} FROM {self.source})"


def flat(found: DataFrame, *columns: str) -> DataFrame:
    """Claims with lists and maps as text: entries sorted, joined by semicolons."""
    entries = lambda m: F.array_join(F.array_sort(F.transform(F.map_entries(m), lambda e: F.concat(e["key"], F.lit("="), e["value"]))), ";")
    kinds = dict(found.dtypes)
    shown = [F.array_join(c, ",").alias(c) if kinds[c].startswith("array") else entries(F.col(c)).alias(c) if kinds[c].startswith("map") else F.col(c) for c in columns]
    return found.select("record_id", "name", *shown)


def entries(**values: str) -> str:
    """SQL for a map as text: name=value in the order of names, where the value isn't null."""
    return "concat_ws(';', " + ", ".join(f"'{k}=' || {v}" for k, v in sorted(values.items())) + ")"


# Names of catalogues with what they become: (entry, name, type that the tail names, type that the name names).
ENTRIES = [
    ("פרוה, ח'", "ח' פרוה", None, None), ("בית שערים, בית כנסת", "בית שערים", "synagogue_ancient", None), ("תל שמרון", "תל שמרון", None, "tel"), ("א, ב ג", "א, ב ג", None, None), ("-", None, None, None),
    ("סומק, חורבת", "חורבת סומק", None, None), ("ברקאי, מגדל מים", "ברקאי", "industrial_heritage", None), ("מערת הנזירים", "מערת הנזירים", None, None),
]
# Attributions with the periods that they list, and texts with the periods that they name.
LISTED = [("רומית, ביזנטית", "roman,byzantine"), ("ברונזה קדומה; ברזל", "bronze_early,iron"), ("עות'מנית", "ottoman_early,ottoman_late"), (None, ""), ("רומית / רומאית", "roman"), ("לא ידוע", ""), ("ברונזה - פרסית", "bronze_early,bronze_middle,bronze_late,persian")]
NAMED = [
    ("חרסים מן התקופות הרומית והביזנטית", "roman,byzantine"), ("ממצא מהתקופה הביזנטית קדומה ומן הצלבנית", "byzantine,crusader"), ("מבנה", ""), (None, ""), ("שרידי ברונזה תיכונה וברזל", "bronze_middle,iron"),
    ("מצודה ממלוכית ועות'מנית מאוחרת", "ottoman_late,mamluk"), ("חדר קבורה רומית", "roman"),
]
NAMED_TYPES = [None, None, None, None, None, "fortification", "burial"]

_SURVEY = Picked("part", "p_partkey", {
    "LOCAL_AUTHORITY": (["עמק יזרעאל", "עמק יזרעאל", "מגידו", " עמק יזרעאל "], 1), "SHEM_ATAR": ([e[0] for e in ENTRIES], 3), "FEATURE_NAME": ([None, "מתקן", "בור"], 1),
    "EXC_STATUS": (["חפור במלואו", "לא חפור", "נסקר", "אחר", None], 1), "INV_TURISM": (["מוסדר ופתוח לקהל", "סגור למבקרים", "-"], 2), "SHIMUR_STATUS": (["בוצע שימור חלקי", "לא בוצע שימור", "פסיפסים הוצאו", None], 5),
    "ENGINEERING_STATE": (["יציב", None, "הרוס", "אחר"], 3), "GENERAL_RISK_LEVEL": (["גבוהה", "נמוכה"], 1), "STATUTORY_PROTECTION": (["מוכרז 33619", "גן לאומי", 'תמ"א 8', None, "הכרזה תקינה; שמורת טבע"], 3),
    "CURRENT_USE": (["יער נטוע", None, "שמורת טבע"], 7), "INV_KNOWN_INTRS": (['רט"ג', "קק\"ל"], 3), "INV_PERIODS": ([x[0] for x in LISTED], 3), "ATAR_DESC": ([None, "תיאור"], 5), "DESCRIPTION": (["אחר"], 1),
    "_ata_site_number": ([2500, None, 17], 5), "_ata_sub_number": ([33, None], 3), "EXC_YEAR": ([None, "1936"], 7),
}, lat=None)


def conservation_survey(spark, sf_dir):
    rows = _SURVEY.rows(spark, sf_dir).withColumn("_excel_row", F.col("k").cast("int"))
    return flat(adapters.conservation_survey(rows), "description", "type", "periods", "statuses", "ids", "excavation_years")


_SURVEY_SQL = f"""SELECT 'A' || k AS record_id, coalesce(n, "FEATURE_NAME") AS name, coalesce("ATAR_DESC", 'אחר') AS description,
coalesce(tt, CASE WHEN n IS NULL THEN CASE "FEATURE_NAME" WHEN 'בור' THEN NULL END ELSE nt END) AS type, ps AS periods,
{entries(excavation="ex", visitor_dev="vd", accessibility="acc", reg_conservation="rc", condition='coalesce(en, rk)', reg_antiquity="ra", protected_area='coalesce(pa, cu)', ownership="ow")} AS statuses,
coalesce('iaa_site_id=' || "_ata_site_number", '') AS ids, coalesce("EXC_YEAR", '') AS excavation_years
FROM {_SURVEY.sql({
    "n": ([e[1] for e in ENTRIES], 3), "tt": ([e[2] for e in ENTRIES], 3), "nt": ([e[3] for e in ENTRIES], 3), "ps": ([x[1] for x in LISTED], 3), "ex": (["excavated", "not_excavated", "surveyed_only", None, None], 1),
    "vd": (["developed", "undeveloped", None], 2), "acc": (["open_free", "not_accessible", None], 2), "rc": (["restored", "surveyed", "plan_approved", None], 5), "en": (["good", None, "destroyed", None], 3),
    "rk": (["endangered", None], 1), "ra": (["declared", None, None, None, "declared"], 3), "pa": ([None, "national_park", None, None, "nature_reserve"], 3), "cu": (["forest", None, "nature_reserve"], 7), "ow": (["state", None], 3),
})} WHERE trim("LOCAL_AUTHORITY") = 'עמק יזרעאל' AND coalesce(n, "FEATURE_NAME") IS NOT NULL"""  # fmt: skip

_INV = adapters.INVENTORY
_INVENTORY = Picked("customer", "c_custkey", {
    "_is_emek_yizrael_council": ([True, True, False, None], 1), "_excluded": ([False, None, True], 1), _INV["name"]: (["בית העם", "מוזיאון חנקין", " ", "ספרייה"], 3), _INV["kind"]: (["מוסד", "נקודה"], 1),
    _INV["side"]: ([None, "ארכיאולוגי", "מורשת"], 5), _INV["state"]: (["פעיל", "משומר", "מוכר", None], 7), _INV["blue_sign"]: ([True, False, None], 7), _INV["sign"]: ([True, False], 3), _INV["access"]: ([None, True, False], 2),
    _INV["sector"]: (["פרטי", "ציבורי", "מגזר שלישי", "מועצה אזורית", "וקף", None], 5), _INV["settlement"]: (["נהלל", None], 9), "_map_category_candidate": (["culture_institution", "historic", None], 4),
    "_plus_code_local": (["P4CV+H3", "קוד אחר", None], 5), "_record_id": (["r"], 1),
}, missing=2)


def institute_inventory(spark, sf_dir):
    rows = _INVENTORY.rows(spark, sf_dir).withColumn("_record_id", F.concat(F.lit("r"), F.col("k").cast("string"))).withColumns({"ref_lat": F.lit(32.6715), "ref_lon": F.lit(35.1440)})
    out = flat(adapters.institute_inventory(rows), "category_hint", "type", "locality", "location_precision", "statuses", "lat", "lon")
    return out.withColumns({"lat": F.round("lat", 5), "lon": F.round("lon", 5)})


_INVENTORY_SQL = f"""SELECT 'r' || k AS record_id, "{_INV['name']}" AS name, CASE "{_INV['side']}" WHEN 'ארכיאולוגי' THEN 'archaeological' WHEN 'מורשת' THEN 'historic' ELSE CASE WHEN "{_INV['kind']}" = 'מוסד' THEN 'culture' ELSE cc END END AS category_hint,
ty AS type, "{_INV['settlement']}" AS locality, CASE WHEN lat IS NOT NULL OR "_plus_code_local" = 'P4CV+H3' THEN 'approx_100m' ELSE 'unknown' END AS location_precision,
{entries(activity="ac", reg_conservation="rc", signage=f'CASE WHEN "{_INV["blue_sign"]}" THEN ' + "'blue_sign'" + f' WHEN NOT "{_INV["blue_sign"]}" THEN CASE WHEN "{_INV["sign"]}" THEN ' + "'other_sign' ELSE 'none' END END", a11y_disabled="dis", ownership="ow")} AS statuses,
round(coalesce(lat, CASE WHEN "_plus_code_local" = 'P4CV+H3' THEN 32.7214375::DOUBLE END), 5) AS lat, round(coalesce(lon, CASE WHEN "_plus_code_local" = 'P4CV+H3' THEN 35.1426875::DOUBLE END), 5) AS lon
FROM {_INVENTORY.sql({
    "cc": (["culture", "historic", None], 4), "ty": ([None, "museum", None, "library"], 3), "ac": (["active", None, None, None], 7), "rc": ([None, "restored", "listed", None], 7), "dis": ([None, "accessible", "not_accessible"], 2),
    "ow": (["private", "state", "ngo", "council", "religious", None], 5),
})} WHERE "_is_emek_yizrael_council" AND NOT coalesce("_excluded", FALSE) AND trim("{_INV['name']}") <> ''"""  # fmt: skip

_MAP = Picked("part", "p_partkey", {
    "rec_source": (["osm", "wikidata", "both"], 1), "in_council_boundary": ([True, True, True, False, None], 1), "historic": ([None, "ruins", None, "tomb", None, None, "yes"], 3), "amenity": ([None, "library", "place_of_worship", "cafe"], 5),
    "start_date": (["1890", "1950", None], 2), "tourism": ([None, "information", "museum", None, None], 7), "wheelchair": (["yes", "limited", "no", None], 9), "access": ([None, "private", "permissive"], 4),
    "name:he": ([None, "תחנת העמק"], 5), "name": (["Station", None, "מאגר"], 7), "wd_label_he": ([None, "מסגד ישן", None], 11), "wd_P31_instance_of_he": (["תל|הר", "הר", None, "אתר ארכאולוגי; מקום"], 3),
    "wd_P31_instance_of_qids": (["Q271669, Q839954", None, "Q33506"], 13), "wd_P2348_time_period_he": ([None, "רומית"], 3), "wd_P571_inception": ([None, "+1931-00-00", "-0037"], 5), "geom_method": (["osm_node_coordinates", "centroid"], 1),
    "addr:city": (["ישראל;נהלל", "עפולה", None], 5), "osm_type": (["node"], 1), "osm_id": (["7", None], 1), "boundary": ([None, None, None, "protected_area"], 7), "protect_title": (["גן לאומי", None], 3),
})


def map_cross_check(spark, sf_dir):
    rows = _MAP.rows(spark, sf_dir).withColumn("rec_id", F.col("k").cast("string"))
    return flat(adapters.map_cross_check(rows, localities=["נהלל", "אלוני אבא"]), "category_hint", "type", "periods", "year_from", "location_precision", "locality", "statuses", "ids", "names_alt").withColumn("relevance", F.lit("x")).drop("relevance")


_MAP_SQL = f"""WITH r AS (SELECT *, CASE WHEN rec_source <> 'wikidata' THEN CASE WHEN historic IS NOT NULL THEN 'h' WHEN tourism = 'museum' THEN 't' WHEN amenity = 'library' THEN 'a' WHEN boundary IS NOT NULL THEN 'b'
 WHEN amenity = 'place_of_worship' AND start_date = '1890' THEN 'w' END END AS m, CASE WHEN rec_source <> 'osm' AND ("wd_P31_instance_of_he" LIKE 'תל%' OR "wd_P31_instance_of_he" LIKE 'אתר%') THEN 'c' END AS c,
 coalesce("name:he", wd_label_he, name) AS n FROM {_MAP.sql({"ht": ([None, "khirbe", None, "burial", None, None, None], 3), "at": ([None, "library", "place_of_worship", None], 5), "tt": ([None, None, "museum", None, None], 7),
 "qt": (["settlement_remains", None, "museum"], 13), "ct": (["tel", None, None, None], 3), "py": ([None, 1931, -37], 5), "sy": ([1890, 1950, None], 2)})} WHERE in_council_boundary),
t AS (SELECT *, coalesce(ht, tt, "at", qt, ct, CASE WHEN n = 'מסגד ישן' THEN 'place_of_worship' END) AS ty, coalesce(py, sy) AS y, CASE WHEN "wd_P2348_time_period_he" IS NOT NULL THEN 'roman' ELSE '' END AS ps FROM r WHERE (m IS NOT NULL OR c IS NOT NULL) AND n IS NOT NULL)
SELECT CAST(k AS VARCHAR) AS record_id, n AS name, CASE WHEN ps <> '' THEN 'archaeological' WHEN y < 1700 THEN 'archaeological' WHEN y IS NOT NULL THEN 'historic' WHEN ty IN ('khirbe', 'burial', 'settlement_remains', 'tel') THEN 'archaeological'
 WHEN ty IN ('place_of_worship') THEN 'historic' WHEN ty IN ('library', 'museum') THEN 'culture' END AS category_hint, ty AS type, ps AS periods, CAST(y AS INT) AS year_from,
 CASE WHEN geom_method = 'centroid' THEN 'approx_100m' ELSE 'exact' END AS location_precision, CASE WHEN "addr:city" = 'ישראל;נהלל' THEN 'נהלל' END AS locality,
 {entries(protected_area="CASE WHEN boundary IS NOT NULL THEN CASE WHEN protect_title IS NOT NULL THEN 'national_park' ELSE 'nature_reserve' END END", a11y_disabled="CASE wheelchair WHEN 'yes' THEN 'accessible' WHEN 'limited' THEN 'partial' WHEN 'no' THEN 'not_accessible' END",
          accessibility="CASE access WHEN 'private' THEN 'not_accessible' WHEN 'permissive' THEN 'open_free' END", condition="CASE WHEN historic = 'ruins' THEN 'poor' END")} AS statuses,
 coalesce('osm_id=node/' || osm_id, '') AS ids, concat_ws(',', CASE WHEN name <> n THEN name END, CASE WHEN wd_label_he <> n THEN wd_label_he END) AS names_alt FROM t"""  # fmt: skip

_REGISTER = Picked("part", "p_partkey", {
    "_record_type": (["declared_site", "survey_site", "excavation", "declared_site"], 1), "title_he": (["אתר מוכרז בית שערים, ח' 2500", "אתר עתיקות מוכרז תל 12", "גבעה", "אתר מוכרז"], 3), "name_heb": ([None, "חורבה"], 7),
    "derived_is_declared": ([True, None, False], 1), "atarStatus": ([None, "מוכרז/תקין"], 5), "derived_position_uncertainty_m": ([10.0, 100.0, 400.0, 900.0, None], 1), "derived_was_excavated": ([None, True, False], 5),
    "derived_survey_count": ([None, 2, 0], 7), "derived_public_access_flag": ([None, True], 3), "description_he": ([x[0] for x in NAMED], 5),
})


def antiquities_register(spark, sf_dir):
    rows = _REGISTER.rows(spark, sf_dir)
    number = F.col("k") % 40
    rows = rows.withColumns({
        "entityId": F.col("k").cast("string"), "derived_site_number_main": F.when(number % 3 != 0, number.cast("string")), "originEntityId": F.concat((number + 1000).cast("string"), F.lit("/2")),
        "derived_attached_declared_site_numbers": F.concat((F.col("k") % 44).cast("string"), F.lit("/1; "), (F.col("k") % 20).cast("string")), "derived_excavation_years": F.concat(F.lit("19"), (F.col("k") % 60 + 30).cast("string")),
    })
    out = adapters.antiquities_register(rows)
    return flat(out, "type", "periods", "location_precision", "statuses", "ids", "excavation_years")


_REGISTER_SQL = f"""WITH r AS (SELECT *, CAST(k % 40 AS VARCHAR) AS number, coalesce(nt, CASE WHEN name_heb IS NOT NULL THEN 'חורבה' END) AS n FROM {_REGISTER.sql({
    "nt": (["ח' בית שערים", "תל", "גבעה", None], 3), "ps": ([x[1] for x in NAMED], 5), "dt": (NAMED_TYPES, 5)})}),
e AS (SELECT site, count(*) AS n, string_agg(DISTINCT y, ',' ORDER BY y) AS years FROM (SELECT DISTINCT k, CAST(unnest([k % 44, k % 20]) AS VARCHAR) AS site, '19' || (k % 60 + 30) AS y FROM r WHERE _record_type = 'excavation') GROUP BY site),
s AS (SELECT r.*, CASE WHEN _record_type = 'declared_site' THEN CASE WHEN (k % 40) % 3 <> 0 THEN number ELSE CAST(k % 40 + 1000 AS VARCHAR) END END AS main FROM r WHERE _record_type <> 'excavation' AND r.n IS NOT NULL)
SELECT _record_type || ':' || k AS record_id, s.n AS name, coalesce(dt, CASE s.n WHEN 'תל' THEN 'tel' WHEN 'חורבה' THEN 'khirbe' END) AS type, ps AS periods,
CASE WHEN derived_position_uncertainty_m <= 60 THEN 'exact' WHEN derived_position_uncertainty_m <= 150 THEN 'approx_100m' WHEN derived_position_uncertainty_m <= 600 THEN 'approx_500m' ELSE 'approx_100m' END AS location_precision,
{entries(reg_antiquity="CASE WHEN _record_type = 'survey_site' THEN 'known' WHEN derived_is_declared OR \"atarStatus\" IS NOT NULL THEN 'declared' WHEN NOT derived_is_declared THEN 'known' END",
         excavation="CASE WHEN coalesce(derived_was_excavated, FALSE) OR e.n > 0 THEN 'excavated' WHEN _record_type = 'survey_site' OR derived_survey_count > 0 THEN 'surveyed_only' END", accessibility="CASE WHEN derived_public_access_flag THEN 'open_free' END")} AS statuses,
coalesce('iaa_site_id=' || main, '') AS ids, coalesce(e.years, '19' || (k % 60 + 30)) AS excavation_years FROM s LEFT JOIN e ON e.site = s.main"""  # fmt: skip

_DECLARED = Picked("part", "p_partkey", {"ata_shem": ([e[0] for e in ENTRIES], 5), "atar_number": (["2500/33", None], 3), "hp_ata_id": (["99", None], 5), "atar_heb_desc": ([x[0] for x in NAMED], 3), "Shape__Area": ([1000.0, 50000.0, 500000.0, None], 7)}, missing=11)
_POINTS = Picked("supplier", "s_suppkey", {"NAME_HEB": ([e[0] for e in ENTRIES], 3), "DESCRIPTION_HEB": (["<p>בור מים</p>", None, "<b></b>", "חרסים <i>רומית</i>"], 5), "PERIOD_HEB": ([x[0] for x in LISTED], 3), "REMAINS_HEB": ([None, "גת"], 7)})


def declared_antiquities(spark, sf_dir):
    one = _DECLARED.rows(spark, sf_dir).withColumn("objectid", F.col("k").cast("string"))
    two = _POINTS.rows(spark, sf_dir).withColumn("OBJECTID", F.col("k").cast("string"))
    return flat(adapters.declared_antiquities(one, two), "type", "periods", "location_precision", "statuses", "ids", "description")


_DECLARED_SQL = f"""SELECT 'poly:' || k AS record_id, n AS name, coalesce(tt, dt, nt) AS type, ps AS periods, CASE WHEN "Shape__Area" <= 20000 THEN 'exact' WHEN "Shape__Area" <= 120000 THEN 'approx_100m' ELSE 'approx_500m' END AS location_precision,
 'reg_antiquity=declared' AS statuses, coalesce('iaa_site_id=' || coalesce(CASE WHEN atar_number IS NOT NULL THEN '2500' END, hp_ata_id), '') AS ids, atar_heb_desc AS description
FROM {_DECLARED.sql({"n": ([e[1] for e in ENTRIES], 5), "tt": ([e[2] for e in ENTRIES], 5), "nt": ([e[3] for e in ENTRIES], 5), "ps": ([x[1] for x in NAMED], 3), "dt": (NAMED_TYPES, 3)})} WHERE lat IS NOT NULL AND n IS NOT NULL
UNION ALL SELECT 'survey:' || k, n, coalesce(tt, rt, dt, nt), CASE WHEN ls <> '' THEN ls ELSE dp END, 'exact', 'reg_antiquity=known', '', d
FROM {_POINTS.sql({"n": ([e[1] for e in ENTRIES], 3), "tt": ([e[2] for e in ENTRIES], 3), "nt": ([e[3] for e in ENTRIES], 3), "ls": ([x[1] for x in LISTED], 3), "rt": ([None, "agricultural_installation"], 7),
                   "d": (["בור מים", None, None, "חרסים  רומית"], 5), "dt": (["water_installation", None, None, None], 5), "dp": (["", "", "", "roman"], 5)})} WHERE n IS NOT NULL"""  # fmt: skip

_SIGNS = Picked("customer", "c_custkey", {
    "site_name": (["בית ראשונים", None, "תחנת רכבת"], 1), "shimur_sign_name": (["שלט", None], 3), "in_emek_yizrael_council_boundary": ([None, True], 5), "emek_yizrael_settlement_matched": (["", "נהלל"], 7), "site_category": ([None, "culture", "other"], 5),
    "possible_archaeological_site": ([True, None], 3), "sign_text": (["המבנה נבנה בשנת 1894 בידי טמפלרים", "הוקם ב1921", "נוסד ב 150", None, "חורבה ביזנטית"], 3), "coord_source": (["hewiki_article_geotag", "map"], 1),
    "settlement": (["עמק; נהלל", "חיפה", None], 7), "sign_number": (["12", None], 3), "image_files": ([None], 1),
}, missing=3)


def blue_signs(spark, sf_dir):
    rows = _SIGNS.rows(spark, sf_dir).drop("image_files").withColumn("record_id", F.col("k").cast("string")).withColumn("image_files", F.when(F.col("k") % 2 == 0, F.array(F.lit("a.jpg"))))
    return flat(adapters.blue_signs(rows, localities=["נהלל"]), "category_hint", "type", "periods", "year_from", "location_precision", "locality", "statuses", "ids", "names_alt")


_SIGNS_SQL = f"""SELECT CAST(k AS VARCHAR) AS record_id, coalesce(site_name, shimur_sign_name) AS name, CASE WHEN site_category = 'culture' THEN 'culture' WHEN possible_archaeological_site THEN 'archaeological' ELSE 'historic' END AS category_hint,
coalesce(ty, dt) AS type, ps AS periods, CAST(y AS INT) AS year_from, CASE WHEN coord_source <> 'map' THEN 'exact' WHEN lat IS NOT NULL THEN 'approx_500m' ELSE 'unknown' END AS location_precision,
CASE WHEN settlement LIKE '%נהלל' THEN 'נהלל' ELSE settlement END AS locality, 'signage=blue_sign' AS statuses, coalesce('blue_sign_number=' || sign_number, '') AS ids, CASE WHEN site_name IS NOT NULL AND shimur_sign_name IS NOT NULL THEN shimur_sign_name ELSE '' END AS names_alt
FROM {_SIGNS.sql({"ty": (["founders_building", None, "railway"], 1), "dt": (["templer", None, None, None, "khirbe"], 3), "ps": (["", "", "", "", "byzantine"], 3), "y": ([1894, 1921, None, None, None], 3)})}
WHERE (lat IS NOT NULL OR in_emek_yizrael_council_boundary OR emek_yizrael_settlement_matched <> '') AND coalesce(site_name, shimur_sign_name) IS NOT NULL"""  # fmt: skip

_INSTITUTIONS = Picked("customer", "c_custkey", {
    "in_scope_for_map": ([True, True, False, None], 1), "name_he": (["מוזיאון", "גלריה לאמנות", "-"], 1), "type": (["heritage_museum", "culture_venue", "other", None], 5), "coord_confidence": (["high", "low"], 1),
    "active": (["yes", "no", "seasonal", None], 7), "recognised_museum": ([True, False], 3), "registered_public_library": ([True, None, False], 5), "accessibility": (["נגיש חלקית", "לא נגיש", "מעלית", "אחר", None], 3),
    "admission": (["כן, 20", "חינם", 'עד 10 ש"ח', None], 3), "operating_body": (["מועצה אזורית", "עמותת הבית", "פלוני", None], 5), "amuta": ([None, "580"], 7), "fallback_settlement_lat": ([32.6, None], 5), "fallback_settlement_lon": ([35.2, None], 5),
}, missing=2)


def cultural_institutions(spark, sf_dir):
    rows = _INSTITUTIONS.rows(spark, sf_dir).withColumn("inst_id", F.col("k").cast("string"))
    return flat(adapters.institutions(rows), "type", "location_precision", "statuses", "lat", "lon", "practical")


_INSTITUTIONS_SQL = f"""SELECT CAST(k AS VARCHAR) AS record_id, name_he AS name, coalesce(tt, CASE WHEN name_he = 'מוזיאון' THEN 'museum' ELSE 'gallery' END) AS type,
CASE WHEN lat IS NOT NULL AND coord_confidence = 'high' THEN 'exact' WHEN lat IS NULL AND fallback_settlement_lat IS NOT NULL THEN 'locality_centroid' ELSE 'approx_100m' END AS location_precision,
{entries(activity="ac", reg_institution="CASE WHEN recognised_museum THEN 'recognized_museum' WHEN registered_public_library THEN 'public_library' END", a11y_disabled="ax", accessibility="ad",
         ownership="CASE WHEN operating_body LIKE 'מועצה%' THEN 'council' WHEN operating_body LIKE 'עמות%' OR amuta IS NOT NULL THEN 'ngo' END")} AS statuses,
coalesce(lat, fallback_settlement_lat) AS lat, CASE WHEN lat IS NOT NULL THEN lon ELSE fallback_settlement_lon END AS lon, {entries(admission="admission", operator="operating_body")} AS practical
FROM {_INSTITUTIONS.sql({"tt": (["museum", "other_culture", None, None], 5), "ac": (["active", "inactive", "seasonal", None], 7), "ax": (["partial", "not_accessible", "accessible", None, None], 3), "ad": (["open_paid", "open_free", "open_paid", None], 3)})}
WHERE in_scope_for_map AND name_he <> '-'"""  # fmt: skip

_HERITAGE = Picked("part", "p_partkey", {
    "record_type": (["shimur_blue_sign", "candidate_lead_check", "kkl_travel_site", "iplan_conservation_polygon", "tmm_park_or_reserve", "shimur_heritage_site", "other"], 1), "site_name": ([None, "מגדל מים"], 1), "title": (["חאן", None, "באר"], 5),
    "holds_blue_sign": ([True, None], 3), "conservation_history": ([None, "שוחזר ב-1990", "ללא"], 1), "designation_type": (["שמורת יער", None, "גן לאומי", "אחר"], 3), "open_to_public": ([True, False, None], 2), "entrance_fee": ([None, "20"], 7),
    "opening_hours": (["בתיאום מראש", None], 9), "period": ([None, "pre-1700 רומית", "pre-1700 and post-1700", "post-1700"], 5), "map_category_expected": (["archaeological", None], 5), "shimur_text": ([x[0] for x in NAMED], 3),
    "mavat_name": (["מבנה לשימור", "רשת חלוקה", None, "שימור נופי"], 3), "station_desc": (["אישור", "בבדיקה"], 5), "shape_area": ([None, 100.0, 50000.0, 1e9], 7), "AREA_SQM": ([1e6, None, 10.0, 1e9], 9), "sign_place": (["נהלל", "חיפה"], 5),
}, missing=13)


def heritage_records(spark, sf_dir):
    rows = _HERITAGE.rows(spark, sf_dir).withColumn("id", F.col("k").cast("string"))
    return flat(adapters.heritage_records(rows, localities=["נהלל"]), "category_hint", "type", "periods", "locality", "statuses", "date_text")


_HERITAGE_MORE = {"nt": ([None, "industrial_heritage"], 1), "tt": (["khan", None, "water_heritage"], 5), "dt": (NAMED_TYPES, 3), "ps": ([x[1] for x in NAMED], 3), "pp": (["", "roman", "", ""], 5), "pr": (["forest", None, "national_park", None], 3)}
_HERITAGE_SQL = f"""SELECT record_type || ':' || k AS record_id, coalesce(site_name, title) AS name,
CASE WHEN record_type <> 'kkl_travel_site' AND ((period LIKE '%pre-1700%' AND period NOT LIKE '%post-1700%') OR (record_type = 'candidate_lead_check' AND map_category_expected IS NOT NULL)) THEN 'archaeological' ELSE 'historic' END AS category_hint,
coalesce(nt, CASE WHEN site_name IS NULL THEN tt END, dt) AS type, CASE WHEN pp <> '' THEN pp ELSE ps END AS periods, CASE WHEN sign_place = 'נהלל' THEN 'נהלל' END AS locality,
{entries(signage="CASE WHEN holds_blue_sign THEN 'blue_sign' END", reg_conservation="CASE WHEN record_type LIKE 'shimur%' THEN CASE WHEN conservation_history LIKE '%שוחזר%' THEN 'restored' ELSE 'listed' END END", protected_area="pr",
         accessibility="CASE WHEN open_to_public THEN CASE WHEN entrance_fee IS NOT NULL THEN 'open_paid' ELSE 'open_free' END WHEN opening_hours IS NOT NULL THEN 'by_appointment' END")} AS statuses, period AS date_text
FROM {_HERITAGE.sql(_HERITAGE_MORE)} WHERE record_type IN ('shimur_blue_sign', 'candidate_lead_check', 'kkl_travel_site', 'shimur_heritage_site') AND lat IS NOT NULL AND coalesce(site_name, title) IS NOT NULL"""  # fmt: skip


def statutory_overlay(spark, sf_dir):
    rows = _HERITAGE.rows(spark, sf_dir).withColumn("id", F.col("k").cast("string"))
    return adapters.statutory_overlay(rows).select("axis", "feature", "radius_m", "value", "designation")


_OVERLAY_SQL = f"""SELECT 'reg_conservation' AS axis, CAST(k AS VARCHAR) AS feature, round(CASE WHEN shape_area > 0 THEN least(400, greatest(40, sqrt(shape_area / pi()))) ELSE 40 END, 1)::DOUBLE AS radius_m,
CASE WHEN station_desc = 'אישור' THEN 'plan_approved' ELSE 'listed' END AS value, mavat_name AS designation FROM {_HERITAGE.sql({})} WHERE record_type = 'iplan_conservation_polygon' AND mavat_name <> 'רשת חלוקה' AND lat IS NOT NULL
UNION ALL SELECT 'protected_area', CAST(k AS VARCHAR), round(CASE WHEN "AREA_SQM" > 0 THEN least(1500, greatest(80, sqrt("AREA_SQM" / pi()))) ELSE 300 END, 1)::DOUBLE, pr, designation_type
FROM {_HERITAGE.sql({"pr": _HERITAGE_MORE["pr"]})} WHERE record_type = 'tmm_park_or_reserve' AND pr IS NOT NULL AND lat IS NOT NULL"""  # fmt: skip

_ADDED = Picked("supplier", "s_suppkey", {"name": (["באר הדרך", "", None, "מקום"], 1), "type": (["tel", "castle", None], 1), "location_precision": ([None, "exact"], 1), "supplied_by": (["צוות", None], 3), "category_hint": (["historic"], 1)}, missing=4)


def manual_additions(spark, sf_dir):
    rows = _ADDED.rows(spark, sf_dir).withColumn("record_id", F.col("k").cast("string")).withColumns({"periods": F.array(F.lit("roman"), pick(F.col("k"), ["bogus", "iron"], 3)), "statuses": F.create_map(F.lit("condition"), F.lit("good"), F.lit("bogus"), F.lit("x"))})
    return flat(adapters.manual_additions(rows), "type", "periods", "location_precision", "statuses", "extra")


_ADDED_SQL = f"""SELECT CAST(k AS VARCHAR) AS record_id, name, CASE WHEN type = 'tel' THEN 'tel' WHEN name LIKE 'באר%' THEN 'water_heritage' END AS type, 'roman' || CASE WHEN k * 3 % 2 = 1 THEN ',iron' ELSE '' END AS periods,
coalesce(location_precision, 'unknown') AS location_precision, 'condition=good' AS statuses, coalesce('supplied_by=' || supplied_by, '') AS extra FROM {_ADDED.sql({})} WHERE name <> ''"""


def adapter_totals(spark, sf_dir):
    """All adapters by the registry, counted in one pass over their claims."""
    number = lambda p, c: p.rows(spark, sf_dir).withColumn(c, F.col("k").cast("string"))
    payloads = {
        "blue_signs": number(_SIGNS, "record_id").drop("image_files"), "culture_institutions": number(_INSTITUTIONS, "inst_id"), "heritage_official": number(_HERITAGE, "id"), "manual_additions": number(_ADDED, "record_id"),
        "iaa_cluster_table": number(_SURVEY, "_record_id"),
    }
    return adapters_counts(adapters.run_adapters(payloads, localities=["נהלל"]))


def adapters_counts(found: DataFrame) -> DataFrame:
    from claimloom.sources.claims import adapter_counts

    return adapter_counts(found).select("source_id", "n", "located", "archaeological", "historic", "culture", "uncategorised")


_TOTALS_SQL = f"""WITH c AS (SELECT 'blue_signs' AS s, b.category_hint AS c, k % 3 <> 0 AS l FROM ({_SIGNS_SQL}) b JOIN (SELECT CAST(c_custkey AS VARCHAR) AS record_id, c_custkey AS k FROM customer) USING (record_id)
UNION ALL SELECT 'culture_institutions', 'culture', lat IS NOT NULL FROM ({_INSTITUTIONS_SQL}) UNION ALL SELECT 'heritage_official', category_hint, TRUE FROM ({_HERITAGE_SQL})
UNION ALL SELECT 'manual_curated', 'historic', CAST(record_id AS BIGINT) % 4 <> 0 FROM ({_ADDED_SQL}) UNION ALL SELECT 'iaa_cluster_table', 'archaeological', FALSE FROM ({_SURVEY_SQL}))
SELECT s AS source_id, count(*) AS n, count(*) FILTER (WHERE l) AS located, count(*) FILTER (WHERE c = 'archaeological') AS archaeological, count(*) FILTER (WHERE c = 'historic') AS historic, count(*) FILTER (WHERE c = 'culture') AS culture,
count(*) FILTER (WHERE c IS NULL) AS uncategorised FROM c GROUP BY s"""


def term_lists(spark, sf_dir):
    """Periods that attributions list and that texts name, types, and years, of every part."""
    k = F.col("p_partkey").cast("long")
    rows = table(spark, sf_dir, "part").select(k.alias("id"), pick(k, [x[0] for x in LISTED], 3).alias("listed"), pick(k, [x[0] for x in NAMED], 5).alias("said"), pick(k, [e[0] for e in ENTRIES], 7).alias("entry"))
    split = names.catalog_name(F.col("entry"), adapters.TYPE_TERMS)
    return rows.select("id", F.array_join(names.listed_periods(F.col("listed")), ",").alias("listed"), F.array_join(names.named_periods(F.col("said")), ",").alias("named"), names.site_type(F.col("said"), split["name"]).alias("type"), split["name"].alias("name"), split["type"].alias("tail"))


_TERMS_SQL = f"""SELECT CAST(p_partkey AS BIGINT) AS id, {picked("p_partkey", [x[1] for x in LISTED], 3)} AS listed, {picked("p_partkey", [x[1] for x in NAMED], 5)} AS named,
coalesce({picked("p_partkey", NAMED_TYPES, 5)}, {picked("p_partkey", [e[3] for e in ENTRIES], 7)}) AS type, {picked("p_partkey", [e[1] for e in ENTRIES], 7)} AS name, {picked("p_partkey", [e[2] for e in ENTRIES], 7)} AS tail FROM part"""

QUERIES = {
    f.__name__: f
    for f in (conservation_survey, institute_inventory, map_cross_check, antiquities_register, declared_antiquities, blue_signs, cultural_institutions, heritage_records, statutory_overlay, manual_additions, adapter_totals, term_lists)
}
ORACLES = {
    "conservation_survey": _SURVEY_SQL, "institute_inventory": _INVENTORY_SQL, "map_cross_check": _MAP_SQL, "antiquities_register": _REGISTER_SQL, "declared_antiquities": _DECLARED_SQL, "blue_signs": _SIGNS_SQL,
    "cultural_institutions": _INSTITUTIONS_SQL, "heritage_records": _HERITAGE_SQL, "statutory_overlay": _OVERLAY_SQL, "manual_additions": _ADDED_SQL, "adapter_totals": _TOTALS_SQL, "term_lists": _TERMS_SQL,
}
