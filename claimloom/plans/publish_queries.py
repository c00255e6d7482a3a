"""Publishing and the query surface: rows made from the test tables by key, and the same in SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from claimloom.functions import geo, names, scalar
from claimloom.functions.vocab import AXES, CATEGORIES, PERIODS, SITE_TYPES
from claimloom.operators import audit, facets, publish, redact, sites
from claimloom.plans.adapter_queries import pick, picked
from claimloom.sources.files import table

_NAMED = [("בית העם", True), ("מוזיאון חנקין", False), ("מגדל המים", True), ("בית העם נהלל", False), (None, False), ("תל שמרון", False)]
_PLACES = [("נהלל", None), (None, "אלוני אבא"), (None, None), ("", "יפעת")]
_PRECISE = ["exact", "approx_500m", "unknown", "locality_centroid", "approx_100m"]
_SEVERAL = ["roman", "iron", "ottoman_late", "state"]
#: Steps of the status axes' values: no two axes that are compared go together.
_STEPS = {a: 7 + 2 * i for i, a in enumerate(AXES)}


def _rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Site rows from customers."""
    k = F.col("c_custkey").cast("long")
    statuses = F.map_from_arrays(F.array(*map(F.lit, AXES)), F.array(*(pick(k, v, _STEPS[a]) for a, (v, _) in AXES.items())))
    rows = table(spark, sf_dir, "customer").select(
        F.concat(F.lit("s"), k.cast("string")).alias("id"), k.alias("k"), pick(k, [n for n, _ in _NAMED], 1).alias("name"), pick(k, CATEGORIES, 1).alias("category"), pick(k, [p for p, _ in _PLACES], 1).alias("locality"), pick(k, [p for _, p in _PLACES], 1).alias("nearest_settlement"),
        F.when(k % 10 != 0, 32.5 + k % 300 / 1000.0).alias("lat"), F.when(k % 10 != 0, 35.0 + k % 400 / 1000.0).alias("lon"), pick(k, _PRECISE, 3).alias("location_precision"), (k % 100 / 100.0).alias("confidence"), (k % 3 == 0).alias("needs_review"),
        F.when(k % 7 != 0, k % 4 != 0).alias("in_council"), F.when(k % 7 != 0, F.when(k % 4 != 0, 50.0).otherwise(-(k % 600).cast("double"))).alias("dist_to_boundary_m"), statuses.alias("statuses"), pick(k, ["tel", "museum", None, "khirbe"], 3).alias("type"),
        F.array_compact(F.array(pick(k, CATEGORIES, 1), F.when(k % 2 == 0, "culture"))).alias("categories"), F.array_compact(F.array(pick(k, _SEVERAL, 1), F.when(k % 3 == 0, pick(k, _SEVERAL, 3)))).alias("periods"), (k % 3 + 1).alias("source_count"),
        F.concat(F.lit("c"), k.cast("string"), F.lit("@example.org")).alias("email"), F.concat(F.lit("04-"), k.cast("string")).alias("phone"), F.concat(F.lit("ask c"), k.cast("string"), F.lit("@example.org, please")).alias("operator"),
        F.array(F.struct(F.lit("phone").alias("field"), F.lit("04").alias("value"), F.lit("blue_signs").alias("source_id")), F.struct(F.lit("name").alias("field"), F.concat(F.lit("n x"), k.cast("string"), F.lit("@a.org")).alias("value"), F.lit("blue_signs").alias("source_id"))).alias("log"),
        F.create_map(F.lit("blue_signs"), F.concat(F.lit("text of y"), k.cast("string"), F.lit("@b.org"))).alias("extra"),
    )
    return rows


_R = f"""r AS (SELECT 's' || c_custkey AS id, CAST(c_custkey AS BIGINT) AS k, {picked("c_custkey", [n for n, _ in _NAMED], 1)} AS name, {picked("c_custkey", [g for _, g in _NAMED], 1)} AS generic, {picked("c_custkey", CATEGORIES, 1)} AS category,
{picked("c_custkey", [p for p, _ in _PLACES], 1)} AS locality, {picked("c_custkey", [p for _, p in _PLACES], 1)} AS nearest, CASE WHEN c_custkey % 10 <> 0 THEN 32.5::DOUBLE + (c_custkey % 300) / 1000.0::DOUBLE END AS lat, CASE WHEN c_custkey % 10 <> 0 THEN 35.0::DOUBLE + (c_custkey % 400) / 1000.0::DOUBLE END AS lon,
{picked("c_custkey", _PRECISE, 3)} AS precise, c_custkey % 7 = 0 OR c_custkey % 4 <> 0 OR c_custkey % 600 <= 300 AS published, CASE WHEN c_custkey % 7 <> 0 THEN c_custkey % 4 <> 0 END AS inside, {picked("c_custkey", ["tel", "museum", None, "khirbe"], 3)} AS type,
{", ".join(f"{picked('c_custkey', v, _STEPS[a])} AS {a}" for a, (v, _) in AXES.items())} FROM customer)"""
_PLACE = "coalesce(nullif(locality, ''), nullif(nearest, ''))"
_LABEL = f"CASE WHEN generic AND {_PLACE} IS NOT NULL THEN name || ', ' || {_PLACE} ELSE name END"


def display_names(spark, sf_dir):
    return publish.with_display_name(_rows(spark, sf_dir)).select("id", "display_name", "display_name_is_qualified", publish.place_of().alias("place"))


def slim_payload(spark, sf_dir):
    out = publish.slim(publish.with_display_name(_rows(spark, sf_dir)))
    rest = lambda c: F.get_json_object("rest", f"$.{c}").alias(c)
    return out.select("id", "display_name", "category", "condition", rest("email"), rest("phone"), rest("operator"), rest("contact_withheld"))


def site_details(spark, sf_dir):
    out = publish.details(_rows(spark, sf_dir))
    return out.select("id", F.size("claims").alias("n"), F.element_at("claims", 1)["value"].alias("said"), F.col("detail")["blue_signs"].alias("more"))


def one_detail(spark, sf_dir):
    """The lookup of one site's details."""
    return publish.detail_of(publish.details(_rows(spark, sf_dir)), "s13").select("id", F.size("claims").alias("n"))


def point_features(spark, sf_dir):
    """Features of the sites with a position (JSON), read back."""
    out = publish.features(publish.with_display_name(_rows(spark, sf_dir)), {"types": {"tel": "Tel"}, "words": {"approx": "about", "unnamed": "without a name"}})
    get = lambda path: F.get_json_object("feature", path)
    return out.select("id", get("$.properties.name").alias("name"), get("$.properties.approx").cast("boolean").alias("approx"), get("$.properties.sub").alias("sub"), get("$.geometry.coordinates[1]").cast("double").alias("lat"))


def csv_export(spark, sf_dir):
    rows = _rows(spark, sf_dir).select("id", F.concat(F.coalesce("name", F.lit("")), F.lit(', "'), "category").alias("title"), "type", "lat")
    return publish.csv_lines(rows, {"id": "id", "title": "a, b", "type": "t"}).select("line")


def vocabulary(spark, sf_dir):
    return publish.vocabulary(spark).select("list", "key", "ord", "parent", "detail")


def status_tones(spark, sf_dir):
    return _rows(spark, sf_dir).select("id", *(publish.tone(a, F.col("statuses")[a]).alias(a) for a in ("reg_antiquity", "condition", "ownership")))


def payload_gate(spark, sf_dir):
    """An inventory as it may be archived: without persons, contacts, contact tags and mail addresses."""
    k = F.col("c_custkey").cast("long")
    rows = table(spark, sf_dir, "customer").select(
        k.alias("id"), pick(k, ["מוסד", " אדם "], 1).alias(redact.KIND), (k % 5 == 0).alias("_excluded"), F.lit("04-1").alias("מספר טלפון"), F.concat(F.lit("to a"), k.cast("string"), F.lit("@b.co!")).alias("note"),
        F.create_map(F.lit("contact:phone"), F.lit("1"), F.lit("name"), F.concat(F.lit("x"), k.cast("string"), F.lit("@y.org"))).alias("osm_tags"), F.array(F.struct(F.lit("z@z.org").alias("t"))).alias("deep"),
    )
    out = redact.redact_payload("iicp_culture_table", rows)
    return out.select("id", F.col("`מספר טלפון`").alias("phone"), "note", F.col("osm_tags")["name"].alias("tag"), F.size("osm_tags").alias("tags"), F.element_at("deep", 1)["t"].alias("deep"))


def licence_gate(spark, sf_dir):
    """Institutions and heritage records behind the gate: a licence keeps its kind and end, visiting notes lose their mail addresses."""
    k = F.col("s_suppkey").cast("long")
    rows = table(spark, sf_dir, "supplier").select(k.alias("id"), F.struct(F.lit("kiosk").alias("licence_type"), F.lit("2030").alias("valid_until"), F.lit("A. Holder").alias("holder")).alias("business_licence"), F.lit("a@b.org").alias("email"))
    out = redact.redact_payload("culture_institutions", rows)
    return out.select("id", F.to_json("business_licence").alias("licence"), "email")


CHOSEN = {"any_of": {"categories": ["culture"], "periods": ["roman", "state"]}, "one_of": {"type": ["tel", "unknown"], "reg_antiquity": ["declared", "known", "unknown"]}}


def _filterable(spark, sf_dir):
    rows = _rows(spark, sf_dir)
    return rows.withColumn("reg_antiquity", F.col("statuses")["reg_antiquity"])


def list_facets(spark, sf_dir):
    """Counts of list and plain facets, each under the choices of the others, of rows that are sure enough and not outside."""
    return facets.counts_without_self(_filterable(spark, sf_dir), **CHOSEN, least=0.1, inside=True)


def chosen_sites(spark, sf_dir):
    rows = _filterable(spark, sf_dir)
    search = facets.search_text("name", "locality", "nearest_settlement", "type")
    return rows.where(facets.matches(**CHOSEN, text="נהלל", search=search, least=0.1, inside=True)).select("id")


def facet_order(spark, sf_dir):
    out = facets.facet_order(facets.counts_without_self(_filterable(spark, sf_dir), **CHOSEN), "UTF8_BINARY")
    return out.select("facet", "value", "n")


def place_totals(spark, sf_dir):
    top, totals = facets.localities(_rows(spark, sf_dir), publish.place_of(), F.coalesce(F.col("locality"), F.lit("")) == "")
    return top.crossJoin(totals)


def table_page(spark, sf_dir):
    """The first twenty rows of the table view, by name and downwards (a page is the feature)."""
    rows = _rows(spark, sf_dir).select("id", "k", F.concat(F.coalesce("name", F.lit("")), F.lit(" "), F.lpad(F.col("k").cast("string"), 8, "0")).alias("name"))
    return facets.table_order(rows, "name", descending=True).limit(20).select("id", "name")


def header_counts(spark, sf_dir):
    return facets.tiles(_rows(spark, sf_dir).where("coalesce(in_council, true)"))


def coverage_meters(spark, sf_dir):
    rows = _rows(spark, sf_dir).select("lat", "locality", F.when(F.size("periods") > 0, 1).alias("dated"))
    return facets.coverage(rows, ["lat", "locality", "dated"])


def year_labels(spark, sf_dir):
    y = F.col("c_custkey").cast("int") * 13 % 4000 - 1500
    return table(spark, sf_dir, "customer").select(F.col("c_custkey").cast("long").alias("id"), facets.year_label(y).alias("label"))


def filter_hashes(spark, sf_dir):
    """States of the filter written to a hash and read back."""
    written = facets.filters_to_hash("תל", 0.5, True, False, "table", None, cats=["culture", "historic"], localities=["נהלל"], reg_antiquity=["known"])
    read = facets.hash_to_filters(F.lit(written))
    return spark.range(1).select(F.explode(read).alias("key", "values")).select("key", F.array_join("values", ",").alias("values"))


def grid_positions(spark, sf_dir):
    """Positions projected to the grid and back: metres between where they were and where they come back to, and the refusal of points off the grid."""
    rows = _rows(spark, sf_dir).where("lat is not null").withColumn("g", geo.to_itm("lat", "lon"))
    back, off = geo.try_to_wgs84(F.col("g.x"), F.col("g.y")), geo.try_to_wgs84(F.col("g.x"), F.col("g.y") - 400_000)
    rows = rows.withColumn("back", back).withColumn("off", off)
    far = scalar.haversine_m(F.col("lat"), F.col("lon"), F.col("back.lat"), F.col("back.lon"))
    return rows.select("id", (far < 1).alias("returns"), F.col("off").isNull().alias("refused"), (geo.detect_grid(F.col("g.x"), F.col("g.y"))).alias("grid"))


def position_errors(spark, sf_dir):
    """How far the centres of Plus Codes lie from the positions that they encode."""
    rows = _rows(spark, sf_dir).where("lat is not null").withColumn("at", geo.plus_center(geo.plus_encode(F.col("lat") + 0.00001, F.col("lon") + 0.00001)))
    out = sites.position_errors(rows.select("lat", "lon", F.col("at.lat").alias("lat2"), F.col("at.lon").alias("lon2")), "lat", "lon", "lat2", "lon2")
    return out.select("n", (F.col("largest_m") <= 12).alias("fine"), (F.col("median_m") <= F.col("largest_m")).alias("ordered"))


def audited_sites(spark, sf_dir):
    """Every rule on status provenance, geometry and classification, each broken by some rows and kept by others."""
    k = F.col("c_custkey").cast("long")
    rows = _rows(spark, sf_dir).withColumns({
        "provenance": F.when(F.col("k") % 3 == 0, F.create_map(F.lit("reg_antiquity"), F.array(F.lit("osm_wikidata")))).when(F.col("k") % 3 == 1, F.create_map(F.lit("reg_antiquity"), F.array(F.lit("declared_antiquities")), F.lit("signage"), F.array(F.lit("blue_signs")))),
        "reg_summary": F.lit("unknown"), "distance_now": F.when(F.col("k") % 11 == 0, -5.0).otherwise(F.col("dist_to_boundary_m")), "itm_lat": F.col("lat") + F.when(F.col("k") % 13 == 0, 0.01).otherwise(0.0), "itm_lon": F.col("lon"), "itm_x": F.lit(1.0),
        "category": F.when(F.col("k") % 17 == 0, "other").otherwise(F.col("category")), "type": F.when(F.col("k") % 5 == 0, "castle").otherwise(F.col("type")), "periods": F.when(F.col("k") % 19 == 0, F.array(F.lit("bogus"))).otherwise(F.col("periods")),
        "lat": F.when(F.col("k") % 23 == 0, 10.0).otherwise(F.col("lat")),
    }).withColumn("itm_lat", F.when(F.col("k") % 29 != 0, F.col("itm_lat")))
    return audit.findings(rows, "id", audit.site_rules(F.col("statuses")))


_AUDIT_ROWS = f"""a AS (SELECT *, CASE k % 3 WHEN 0 THEN 'osm' WHEN 1 THEN 'own' END AS prov, CASE WHEN k % 17 = 0 THEN 'other' ELSE category END AS cat, CASE WHEN k % 5 = 0 THEN 'castle' ELSE type END AS ty, CASE WHEN k % 23 = 0 THEN 10.0 ELSE lat END AS y0,
 CASE WHEN k % 7 <> 0 THEN CASE WHEN k % 4 <> 0 THEN 50.0 ELSE -(k % 600) END END AS dist, {picked("k", _SEVERAL, 1)} AS p1, CASE WHEN k % 3 = 0 THEN {picked("k", _SEVERAL, 3)} END AS p2 FROM r),
b AS (SELECT *, CASE WHEN k % 11 = 0 THEN -5.0 ELSE dist END AS now, y0 IS NOT NULL AND y0 BETWEEN 29.4 AND 33.4 AS inbox, cat IN ('archaeological', 'historic', 'culture') AS ok,
 CASE WHEN k % 19 = 0 THEN NULL WHEN p1 IN ('roman', 'iron') OR coalesce(p2 IN ('roman', 'iron'), FALSE) THEN 'archaeological' ELSE 'historic' END AS era FROM a)"""
_AUTHORITY = {"reg_antiquity": ("prov = 'own'", "prov = 'osm'"), "reg_institution": ("FALSE", "FALSE"), "signage": ("prov = 'own'", "FALSE")}
_RULES = [
    ("status_without_provenance", "high", " OR ".join(f"({a} <> 'unknown' AND NOT coalesce({own}, FALSE) AND NOT coalesce({wrong}, FALSE))" for a, (own, wrong) in _AUTHORITY.items())),
    ("status_wrong_authority", "high", "reg_antiquity <> 'unknown' AND prov = 'osm'"), ("jurisdiction_without_coordinate", "medium", "y0 IS NULL AND inside IS NOT NULL"), ("coordinate_outside_box", "high", "y0 IS NOT NULL AND NOT inbox"),
    ("jurisdiction_mismatch", "high", "inbox AND (now > 0) <> coalesce(inside, FALSE)"), ("distance_stale", "medium", "inbox AND abs(now - dist) > 2"), ("itm_disagrees_with_wgs84", "high", "inbox AND k % 13 = 0 AND k % 29 <> 0"),
    ("itm_implausible", "medium", "inbox AND k % 29 = 0"), ("bad_category", "high", "NOT ok"), ("category_not_in_categories", "medium", "FALSE"), ("bad_type", "medium", "ok AND ty = 'castle'"), ("bad_period", "high", "ok AND k % 19 = 0"),
    ("category_contradicts_periods", "medium", "era = 'historic' AND cat = 'archaeological' AND reg_antiquity = 'unknown'"), ("historic_with_pre1700_periods", "medium", "era = 'archaeological' AND cat = 'historic'"),
    ("status_axis_not_applicable", "low", "ok AND (" + " OR ".join(f"({a} <> 'unknown' AND cat NOT IN ({', '.join(map(repr, on))}))" for a, (_, on) in AXES.items() if len(on) < 3) + ")"), ("bad_status_value", "high", "FALSE"),
    ("reg_summary_stale", "medium", "ok AND CASE WHEN reg_antiquity = 'declared' OR reg_conservation IN ('listed', 'plan_approved', 'restored') OR reg_institution IN ('recognized_museum', 'public_library') OR protected_area IN ('national_park', 'nature_reserve') THEN TRUE WHEN 'unknown' IN (reg_antiquity, reg_conservation, reg_institution, protected_area) THEN FALSE ELSE TRUE END"),
]


def audit_totals(spark, sf_dir):
    found = audited_sites(spark, sf_dir)
    return audit.summary(found)


def untraced_axes(spark, sf_dir):
    rows = _rows(spark, sf_dir).withColumn("provenance", F.when(F.col("k") % 2 == 0, F.create_map(F.lit("reg_antiquity"), F.array(F.lit("declared_antiquities")))))
    return audit.untraced(rows, F.col("statuses"))


def audited_names(spark, sf_dir):
    """All rules on names, on names that break them and names that don't."""
    k = F.col("p_partkey").cast("long")
    return audit.findings(table(spark, sf_dir, "part").select(k.alias("id"), pick(k, [n for n, _ in _BAD], 1).alias("name")), "id", audit.name_rules(F.col("name")))


_BAD = [
    (None, ["name_missing"]), (" ", ["name_missing"]), ("גן לאומי", ["name_is_designation"]), ("הירבה, תל", ["name_inverted"]), ("שם 12345", ["name_trailing_number"]), ("שם 1948", []), ("Khirbet Tira", ["name_latin_only"]), ("אבן אבן", ["name_repeated_word"]),
    ("בית הבית בית", []), ("א" * 91, ["name_too_long"]), ("לת תיב", ["name_reversed"]), ("שם טוב", []), ("Tira תל", []),
]
_SEVERITY = {"name_missing": "high", "name_is_designation": "high", "name_inverted": "medium", "name_trailing_number": "medium", "name_latin_only": "medium", "name_repeated_word": "low", "name_too_long": "low", "name_reversed": "high"}


def name_folding(spark, sf_dir):
    """Keys, loose keys, generic names, slugs and display forms of names that the rules fold alike or keep apart."""
    k = F.col("p_partkey").cast("long")
    n = F.col("name")
    rows = table(spark, sf_dir, "part").select(k.alias("id"), pick(k, [x[0] for x in _FOLDED], 1).alias("name"))
    return rows.select("id", names.key(n).alias("key"), names.loose_key(n).alias("loose"), names.is_generic(names.key(n), ["נהלל"]).alias("generic"), names.distinctive(names.key(n), ["נהלל"]).alias("distinctive"), names.display(n).alias("shown"), scalar.slug(names.key(n)).alias("slug"))


# Names with their key, loose key, whether they are generic, their distinctive words, and how they are shown.
_FOLDED = [
    ("חירבת שמרון", "חורבת שמרונ", "חורבת סמרונ", False, "שמרונ", "חירבת שמרון"), ("חורבת שמרון", "חורבת שמרונ", "חורבת סמרונ", False, "שמרונ", "חורבת שמרון"), (" בית העם, ", "בית העמ", "בית מ", True, "העמ", "בית העם"),
    ("ח'ירבת אל-ג'ליל", "חורבת גליל", "חורבת גליל", False, "גליל", "ח'ירבת אל-ג'ליל"), ("שמורת טבע", "שמורת טבע", "סמורת תב", False, "שמורת טבע", "שמורת טבע"), ("בית העם נהלל", "בית העמ נהלל", "בית מ נל", True, "העמ", "בית העם נהלל"),
    ("תֵּל יוֹסֵף", "תל יוספ", "תל יוספ", False, "יוספ", "תל יוסף"), (None, "", "", True, "", None), ("מוזיאון (ישן)", "מוזיאונ ישנ", "מוזיונ יסנ", True, "מוזיאונ ישנ", "מוזיאון (ישן)"), ("עיון מים", "עיונ מימ", "יונ מימ", False, "עיונ מימ", "עיון מים"),
]

QUERIES = {
    f.__name__: f
    for f in (
        display_names, slim_payload, site_details, one_detail, point_features, csv_export, vocabulary, status_tones, payload_gate, licence_gate, list_facets, chosen_sites, facet_order, place_totals, table_page, header_counts, coverage_meters,
        year_labels, filter_hashes, grid_positions, position_errors, audited_sites, audit_totals, untraced_axes, audited_names, name_folding,
    )
}
_PUBLIC = "(reg_institution IN ('recognized_museum', 'public_library') OR ownership IN ('state', 'council'))"
_LISTS = f"""l AS (SELECT *, list_distinct(CASE WHEN k % 2 = 0 THEN [category, 'culture'] ELSE [category] END) AS cats, list_distinct(CASE WHEN k % 3 = 0 THEN [{picked("k", _SEVERAL, 1)}, {picked("k", _SEVERAL, 3)}] ELSE [{picked("k", _SEVERAL, 1)}] END) AS periods, coalesce(type, 'unknown') AS ty FROM r),
m AS (SELECT *, list_contains(cats, 'culture') AS fc, list_has_any(periods, ['roman', 'state']) AS fp, ty IN ('tel', 'unknown') AS ft, reg_antiquity <> 'none' AS fr, coalesce(inside, TRUE) AND k % 100 >= 10 AS base FROM l)"""
_COUNTS = """SELECT 'categories' AS facet, v AS value, count(*) AS n FROM (SELECT unnest(cats) AS v FROM m WHERE {base} fp AND ft AND fr) GROUP BY v UNION ALL SELECT 'periods', v, count(*) FROM (SELECT unnest(periods) AS v FROM m WHERE {base} fc AND ft AND fr) GROUP BY v
UNION ALL SELECT 'type', ty, count(*) FROM m WHERE {base} fc AND fp AND fr GROUP BY ty UNION ALL SELECT 'reg_antiquity', reg_antiquity, count(*) FROM m WHERE {base} fc AND fp AND ft GROUP BY reg_antiquity"""
_VALUES = lambda rows: "SELECT * FROM (VALUES " + ", ".join("(" + ", ".join("NULL" if x is None else repr(x) if isinstance(x, int) else "'" + x.replace("'", "''") + "'" for x in r) + ")" for r in rows) + ")"
_TONE = {"reg_antiquity": "CASE reg_antiquity WHEN 'declared' THEN 'good' WHEN 'known' THEN 'warn' WHEN 'none' THEN 'bad' ELSE 'gap' END", "condition": "CASE condition WHEN 'good' THEN 'good' WHEN 'fair' THEN 'warn' WHEN 'unknown' THEN 'gap' ELSE 'bad' END"}
_TONE["ownership"] = "CASE ownership WHEN 'unknown' THEN 'gap' ELSE 'neutral' END"

ORACLES = {
    "display_names": f"WITH {_R} SELECT id, {_LABEL} AS display_name, generic AND {_PLACE} IS NOT NULL AS display_name_is_qualified, coalesce({_PLACE}, '—') AS place FROM r",
    "slim_payload": f"""WITH {_R} SELECT id, {_LABEL} AS display_name, category, condition, CAST(NULL AS VARCHAR) AS email, CASE WHEN {_PUBLIC} THEN '04-' || k END AS phone, 'ask [הוסר], please' AS operator, 'true' AS contact_withheld FROM r WHERE published""",
    "site_details": f"WITH {_R} SELECT id, CAST(1 AS INT) AS n, 'n [הוסר]' AS said, 'text of [הוסר]' AS more FROM r WHERE published",
    "one_detail": f"WITH {_R} SELECT id, CAST(1 AS INT) AS n FROM r WHERE published AND id = 's13'",
    "point_features": f"""WITH {_R} SELECT id, coalesce({_LABEL}, 'without a name') AS name, precise IN ('approx_500m', 'unknown', 'locality_centroid') AS approx,
concat_ws(' · ', category, {_PLACE}, CASE type WHEN 'tel' THEN 'Tel' ELSE type END, CASE WHEN precise IN ('approx_500m', 'unknown', 'locality_centroid') THEN 'about' END) AS sub, lat FROM r WHERE lat IS NOT NULL""",
    "csv_export": f"""WITH {_R} SELECT chr(65279) || 'id,"a, b",t' AS line UNION ALL SELECT id || ',"' || coalesce(name, '') || ', ""' || category || '",' || coalesce(type, '') FROM r""",
    "vocabulary": _VALUES([("categories", c, i, None, None) for i, c in enumerate(CATEGORIES)] + [("site_types", t, i, c, None) for i, (c, t) in enumerate((c, t) for c, ts in SITE_TYPES.items() for t in ts)] + [("site_types", "unknown", 44, None, None)])
    + " AS v(list, key, ord, parent, detail) UNION ALL " + _VALUES([("periods", p, i, "archaeological" if i < 15 else "historic", f"{a},{b}") for i, (p, (a, b)) in enumerate(PERIODS.items())] + [("status_axes", a, i, None, ",".join(on)) for i, (a, (_, on)) in enumerate(AXES.items())])
    + " UNION ALL " + _VALUES([("status_values", v, i, a, publish.TONES.get(a, {}).get(v, "gap" if v == "unknown" else "neutral")) for a, (vs, _) in AXES.items() for i, v in enumerate(vs)])
    + " UNION ALL " + _VALUES([("sources", s, i, None, str(r)) for i, (s, r) in enumerate(publish.SOURCE_RANK.items())] + [("registered_positive", v, i, a, None) for a, vs in publish.REGISTERED.items() for i, v in enumerate(sorted(vs))]),
    "status_tones": f"WITH {_R} SELECT id, {', '.join(f'{v} AS {k}' for k, v in _TONE.items())} FROM r",
    "payload_gate": "SELECT CAST(c_custkey AS BIGINT) AS id, CAST(NULL AS VARCHAR) AS phone, 'to [הוסר]!' AS note, '[הוסר]' AS tag, CAST(1 AS INT) AS tags, '[הוסר]' AS deep FROM customer WHERE c_custkey % 2 = 0 AND c_custkey % 5 <> 0",
    "licence_gate": """SELECT CAST(s_suppkey AS BIGINT) AS id, '{"licence_type":"kiosk","valid_until":"2030"}' AS licence, CAST(NULL AS VARCHAR) AS email FROM supplier""",
    "list_facets": f"WITH {_R}, {_LISTS} " + _COUNTS.format(base="base AND"),
    "chosen_sites": f"WITH {_R}, {_LISTS} SELECT id FROM m WHERE base AND fc AND fp AND ft AND fr AND (contains(coalesce(name, ''), 'נהלל') OR locality = 'נהלל')",
    "facet_order": f"WITH {_R}, {_LISTS} " + _COUNTS.format(base=""),
    "place_totals": f"WITH {_R}, p AS (SELECT coalesce({_PLACE}, '—') AS value, coalesce(locality, '') = '' AS derived FROM r) SELECT value, count(*) AS n, (SELECT count(DISTINCT value) FROM p) AS places, (SELECT count(*) FILTER (WHERE derived) FROM p) AS derived FROM p GROUP BY value ORDER BY n DESC, value LIMIT 14",
    "header_counts": f"WITH {_R} SELECT count(*) AS n, count(lat) AS mappable, count(*) FILTER (WHERE lat IS NULL) AS gap, count(*) FILTER (WHERE k % 3 = 0) AS need_review, round(avg((k % 100) / 100.0::DOUBLE), 3) AS mean_confidence FROM r WHERE coalesce(inside, TRUE)",
    "coverage_meters": f"WITH {_R} SELECT field, CAST(sum(x) AS BIGINT) AS known, round(avg(x), 4) AS share FROM (SELECT unnest(['lat', 'locality', 'dated']) AS field, unnest([(lat IS NOT NULL)::INT, (locality IS NOT NULL)::INT, 1]) AS x FROM r) GROUP BY field",
    "year_labels": """WITH y AS (SELECT CAST(c_custkey AS BIGINT) AS id, c_custkey * 13 % 4000 - 1500 AS y FROM customer) SELECT id, format('{:,}', CAST(abs(y) AS BIGINT)) || CASE WHEN y < 0 THEN ' לפנה"ס' ELSE ' לספירה' END AS label FROM y""",
    "filter_hashes": _VALUES([("v", "table"), ("q", "תל"), ("c", "culture,historic"), ("mc", "50"), ("rv", "1"), ("s.reg_antiquity", "known")]) + ' AS h("key", "values")',
    "grid_positions": f"WITH {_R} SELECT id, TRUE AS returns, TRUE AS refused, 'itm' AS grid FROM r WHERE lat IS NOT NULL",
    "position_errors": f"WITH {_R} SELECT count(lat) AS n, TRUE AS fine, TRUE AS ordered FROM r",
    "audited_sites": f"WITH {_R}, {_AUDIT_ROWS} " + " UNION ALL ".join(f"SELECT id, '{k}' AS kind, '{s}' AS severity FROM b WHERE {p}" for k, s, p in _RULES),
    "audit_totals": f"WITH {_R}, {_AUDIT_ROWS} " + " UNION ALL ".join(f"SELECT '{s}' AS severity, '{k}' AS kind, count(*) AS n FROM b WHERE {p} HAVING count(*) > 0" for k, s, p in _RULES),
    "untraced_axes": f"WITH {_R} " + " UNION ALL ".join(f"SELECT '{a}' AS axis, count(*) AS n FROM r WHERE {a} <> 'unknown'" + (" AND k % 2 <> 0" if a == "reg_antiquity" else "") for a in AXES),
    "audited_names": f"WITH v AS ({_VALUES([(i, x, _SEVERITY[x]) for i, (_, kinds) in enumerate(_BAD) for x in kinds])} AS v(i, kind, severity)) SELECT CAST(p_partkey AS BIGINT) AS id, kind, severity FROM part JOIN v ON p_partkey % {len(_BAD)} = i",
    "name_folding": f"""SELECT CAST(p_partkey AS BIGINT) AS id, {picked("p_partkey", [x[1] for x in _FOLDED], 1)} AS key, {picked("p_partkey", [x[2] for x in _FOLDED], 1)} AS loose, {picked("p_partkey", [x[3] for x in _FOLDED], 1)} AS generic,
{picked("p_partkey", [x[4] for x in _FOLDED], 1)} AS distinctive, {picked("p_partkey", [x[5] for x in _FOLDED], 1)} AS shown, substr(sha1(coalesce(nullif({picked("p_partkey", [x[1] for x in _FOLDED], 1)}, ''), 'unnamed')), 1, 6) AS slug FROM part""",
    "table_page": f"WITH {_R} SELECT id, coalesce(name, '') || ' ' || lpad(CAST(k AS VARCHAR), 8, '0') AS name FROM r ORDER BY 2 DESC LIMIT 20",
}
