"""Fusion, audit and facet queries on the test tables, and their DuckDB counterparts. Positions and vocabulary values are derived from keys, alike in both."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from claimloom.functions import geo
from claimloom.functions.vocab import AXES, CATEGORIES, PERIODS
from claimloom.operators import audit, facets, joins, merge, redact
from claimloom.sources.files import table

SQUARE = [(205000.0, 717000.0), (247000.0, 717000.0), (247000.0, 751000.0), (205000.0, 751000.0)]
HOLE = [(215000.0, 725000.0), (225000.0, 725000.0), (225000.0, 735000.0), (215000.0, 735000.0)]


def _pick(k: Column, values: list[str], step: int) -> Column:
    return F.element_at(F.array(*map(F.lit, values)), (k * step % len(values) + 1).cast("int"))


def _picked(k: str, values: list[str], step: int) -> str:
    return f"list_extract([{', '.join(map(repr, values))}], CAST({k} * {step} % {len(values)} + 1 AS INT))"


def _suppliers(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("s_suppkey").cast("long")
    return table(spark, sf_dir, "supplier").select(k.alias("place"), (32.55 + k * 37 % 3000 / 10000.0).alias("lat"), (35.05 + k * 91 % 4500 / 10000.0).alias("lon"))


def _customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("c_custkey").cast("long")
    return table(spark, sf_dir, "customer").select(k.alias("id"), (32.55 + k * 41 % 3000 / 10000.0).alias("lat"), (35.05 + k * 97 % 4500 / 10000.0).alias("lon"))


_SUP = "SELECT CAST(s_suppkey AS BIGINT) AS place, 32.55::DOUBLE + (s_suppkey * 37 % 3000) / 10000.0::DOUBLE AS lat, 35.05::DOUBLE + (s_suppkey * 91 % 4500) / 10000.0::DOUBLE AS lon FROM supplier"
_CUS = "SELECT CAST(c_custkey AS BIGINT) AS id, 32.55::DOUBLE + (c_custkey * 41 % 3000) / 10000.0::DOUBLE AS lat, 35.05::DOUBLE + (c_custkey * 97 % 4500) / 10000.0::DOUBLE AS lon FROM customer"
_METRES = "2 * 6371008.8 * asin(sqrt(pow(sin(radians(b.lat - a.lat) / 2), 2) + cos(radians(a.lat)) * cos(radians(b.lat)) * pow(sin(radians(b.lon - a.lon) / 2), 2)))"


def nearest_place(spark, sf_dir):
    return joins.nearest(_customers(spark, sf_dir), _suppliers(spark, sf_dir), "id")


def radius_cover(spark, sf_dir):
    features = _suppliers(spark, sf_dir).withColumn("radius_m", (F.col("place") % 1000 + 2000).cast("double")).withColumnRenamed("place", "feature")
    return joins.within_own_radius(_customers(spark, sf_dir), features, "id", 3000.0)


def plus_codes(spark, sf_dir):
    return _customers(spark, sf_dir).select("id", geo.plus_encode(F.col("lat") + 0.00003, F.col("lon") + 0.00003).alias("code"))


def in_polygon(spark, sf_dir):
    k = F.col("p_partkey").cast("long")
    rows = table(spark, sf_dir, "part").select(k.alias("id"), (200000.5 + k * 7919 % 50000).alias("itm_x"), (715000.5 + k * 104729 % 40000).alias("itm_y"))
    return geo.jurisdiction(rows, geo.edges([SQUARE, HOLE])).select("id", "in_council", "near_boundary", "dist_to_boundary_m")


def detected_grid(spark, sf_dir):
    k = F.col("p_partkey").cast("long")
    return table(spark, sf_dir, "part").select(k.alias("id"), geo.detect_grid((k * 7919 % 400000).cast("double"), (k * 104729 % 900000 - 70000).cast("double")).alias("grid"))


def _status_rows(spark, sf_dir):
    k = F.col("o_orderkey").cast("long")
    return table(spark, sf_dir, "orders").select(k.alias("id"), *(_pick(k, v, 7 + 2 * i).alias(a) for i, (a, (v, _)) in enumerate(AXES.items())), _pick(k, CATEGORIES, 11).alias("category"))


_STATUS = "SELECT CAST(o_orderkey AS BIGINT) AS id, " + ", ".join(f"{_picked('o_orderkey', v, 7 + 2 * i)} AS {a}" for i, (a, (v, _)) in enumerate(AXES.items())) + f", {_picked('o_orderkey', CATEGORIES, 11)} AS category FROM orders"


def registration_summary(spark, sf_dir):
    return _status_rows(spark, sf_dir).select("id", merge.registered_summary(F.col).alias("reg_summary"))


def status_distribution(spark, sf_dir):
    return facets.status_distribution(_status_rows(spark, sf_dir), {k: on for k, (_, on) in AXES.items()})


def _period_rows(spark, sf_dir):
    return table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").cast("long").alias("cluster_id"), _pick(F.col("l_partkey").cast("long"), list(PERIODS), 5).alias("period"))


def period_union(spark, sf_dir):
    """Distinct periods of each order in their order, and the era they decide."""
    rows = _period_rows(spark, sf_dir).groupBy("cluster_id").agg(F.collect_set("period").alias("p"))
    return rows.select("cluster_id", F.array_join(merge.in_order(F.col("p")), ",").alias("periods"), merge.era(F.col("p")).alias("era"))


def period_histogram(spark, sf_dir):
    return facets.list_histogram(_period_rows(spark, sf_dir).groupBy("cluster_id").agg(F.collect_list("period").alias("p")), "p")


def audit_statuses(spark, sf_dir):
    """Axes with a value that don't apply to the category, and contradicting registrations, by severity and kind."""
    rows = _status_rows(spark, sf_dir)
    known = lambda k: F.col(k) != "unknown"
    rules = {f"not_applicable_{k}": ("low", known(k) & ~F.col("category").isin(on)) for k, (_, on) in AXES.items() if len(on) < 3}
    return audit.findings(rows, "id", rules)


def redacted(spark, sf_dir):
    k = F.col("c_custkey").cast("long")
    rows = table(spark, sf_dir, "customer").select(
        k.alias("id"), F.when(k % 3 != 0, F.concat(F.lit("c"), k.cast("string"), F.lit("@example.org"))).alias("email"), F.when(k % 5 != 0, F.concat(F.lit("04-"), k.cast("string"))).alias("phone"),
        _pick(k, AXES["reg_institution"][0], 3).alias("reg_institution"), _pick(k, AXES["ownership"][0], 3).alias("ownership"), F.concat(F.lit("write to c"), k.cast("string"), F.lit("@example.org now")).alias("note"),
    )
    return redact.redact_sites(rows).select("id", "email", "phone", "note", "contact_withheld", F.array_join("removed", ",").alias("removed"))


def leak_check(spark, sf_dir):
    return redact.leaks(table(spark, sf_dir, "documents"), "text", "doc_id").select("doc_id", F.size("found").alias("n"))


def filtered(spark, sf_dir):
    rows = table(spark, sf_dir, "documents").select("doc_id", "lang", "source", "text")
    return rows.where(facets.matches({}, {"lang": ["en", "de"]}, "the", facets.search_text("text", "source"))).select("doc_id")


def events_attached(spark, sf_dir):
    """Years of the events that name a customer, at most forty, sorted."""
    o = table(spark, sf_dir, "orders").select(F.concat(F.col("o_custkey").cast("string"), F.lit("/"), F.col("o_orderkey").cast("string"), F.lit(";")).alias("numbers"), F.year("o_orderdate").alias("years"))
    out = joins.attach_events(table(spark, sf_dir, "customer").select(F.col("c_custkey").cast("long").alias("id")), o, "id", "numbers", {"years": 40})
    return out.select("id", F.array_join("years", ",").alias("years"))


QUERIES = {
    f.__name__: f
    for f in (
        nearest_place, radius_cover, plus_codes, in_polygon, detected_grid, registration_summary, status_distribution, period_union, period_histogram,
        audit_statuses, redacted, leak_check, filtered, events_attached,
    )
}

_PERIOD = f"SELECT CAST(l_orderkey AS BIGINT) AS k, {_picked('l_partkey', list(PERIODS), 5)} AS p FROM lineitem"
_NUMBER = "CASE p " + " ".join(f"WHEN '{k}' THEN {i}" for i, k in enumerate(PERIODS)) + " END"
_DIGIT = lambda v, unit: f"substr('{geo._DIGITS}', CAST(({v} // {unit}) % 20 + 1 AS INT), 1)"
_SEGMENTS = " UNION ALL ".join(f"SELECT {a[0]}::DOUBLE AS x1, {a[1]}::DOUBLE AS y1, {b[0]}::DOUBLE AS x2, {b[1]}::DOUBLE AS y2" for r in (SQUARE, HOLE) for a, b in zip(r, r[1:] + r[:1]))
_MAIL = r"[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+\.[A-Za-z]{2,}"
_PUBLIC = "(ri IN ('recognized_museum', 'public_library') OR ow IN ('state', 'council'))"

ORACLES = {
    "nearest_place": f"""WITH b AS ({_SUP}), a AS ({_CUS}), d AS (SELECT a.id, b.place, {_METRES} AS d FROM a, b), r AS (SELECT *, row_number() OVER (PARTITION BY id ORDER BY d, place) AS n FROM d)
SELECT id, place, round(d / 1000, 2) AS km FROM r WHERE n = 1""",
    "radius_cover": f"""WITH b AS ({_SUP}), a AS ({_CUS}), d AS (SELECT a.id, b.place AS feature, {_METRES} AS d FROM a JOIN b ON abs(a.lat - b.lat) < 0.05 AND abs(a.lon - b.lon) < 0.05 AND {_METRES} <= b.place % 1000 + 2000),
r AS (SELECT *, row_number() OVER (PARTITION BY id ORDER BY d, feature) AS n FROM d) SELECT id, feature, round(d, 2) AS metres FROM r WHERE n = 1""",
    "plus_codes": f"""WITH g AS (SELECT id, CAST(floor((lat + 0.00003::DOUBLE + 90) * 8000 + 0.000001::DOUBLE) AS BIGINT) AS y, CAST(floor((lon + 0.00003::DOUBLE + 180) * 8000 + 0.000001::DOUBLE) AS BIGINT) AS x FROM ({_CUS}))
SELECT id, {" || ".join(_DIGIT(v, 20 ** (4 - k)) for k in range(4) for v in "yx")} || '+' || {_DIGIT("y", 1)} || {_DIGIT("x", 1)} AS code FROM g""",
    "in_polygon": f"""WITH e AS ({_SEGMENTS}), p AS (SELECT CAST(p_partkey AS BIGINT) AS id, 200000.5::DOUBLE + p_partkey * 7919 % 50000 AS x, 715000.5::DOUBLE + p_partkey * 104729 % 40000 AS y FROM part),
t AS (SELECT *, greatest(0, least(1, ((x - x1) * (x2 - x1) + (y - y1) * (y2 - y1)) / (pow(x2 - x1, 2) + pow(y2 - y1, 2)))) AS t FROM p, e),
d AS (SELECT id, count(*) FILTER (WHERE (y1 > y) <> (y2 > y) AND x < (x2 - x1) * (y - y1) / nullif(y2 - y1, 0) + x1) % 2 = 1 AS odd, round(min(sqrt(pow(x - x1 - t * (x2 - x1), 2) + pow(y - y1 - t * (y2 - y1), 2))), 1) AS d FROM t GROUP BY id)
SELECT id, odd AND d > 0 AS in_council, d <= 300 AS near_boundary, CASE WHEN odd THEN d ELSE -d END AS dist_to_boundary_m FROM d""",
    "detected_grid": """WITH g AS (SELECT CAST(p_partkey AS BIGINT) AS id, p_partkey * 7919 % 400000 AS x, p_partkey * 104729 % 900000 - 70000 AS y FROM part)
SELECT id, CASE WHEN y BETWEEN 300000 AND 820000 AND x BETWEEN 100000 AND 300000 THEN 'itm' WHEN y BETWEEN -60000 AND 299999 AND x BETWEEN 60000 AND 260000 THEN 'ics' ELSE 'unknown' END AS grid FROM g""",
    "registration_summary": f"""SELECT id, CASE WHEN reg_antiquity = 'declared' OR reg_conservation IN ('listed', 'plan_approved', 'restored') OR reg_institution IN ('recognized_museum', 'public_library') OR protected_area IN ('national_park', 'nature_reserve') THEN 'registered'
WHEN 'unknown' IN (reg_antiquity, reg_conservation, reg_institution, protected_area) THEN 'unknown' ELSE 'not_registered' END AS reg_summary FROM ({_STATUS})""",
    "status_distribution": f"WITH s AS ({_STATUS}) " + " UNION ALL ".join(f"SELECT '{k}' AS axis, {k} AS value, count(*) AS n FROM s WHERE category IN ({', '.join(map(repr, on))}) GROUP BY {k}" for k, (_, on) in AXES.items()),
    "period_union": f"""WITH r AS ({_PERIOD}), u AS (SELECT DISTINCT k, p, {_NUMBER} AS i FROM r)
SELECT k AS cluster_id, string_agg(p, ',' ORDER BY i) AS periods, CASE WHEN min(i) < 15 THEN 'archaeological' ELSE 'historic' END AS era FROM u GROUP BY k""",
    "period_histogram": f"SELECT p AS value, count(DISTINCT k) AS n FROM ({_PERIOD}) GROUP BY p",
    "audit_statuses": f"WITH s AS ({_STATUS}) " + " UNION ALL ".join(f"SELECT id, 'not_applicable_{k}' AS kind, 'low' AS severity FROM s WHERE {k} <> 'unknown' AND category NOT IN ({', '.join(map(repr, on))})" for k, (_, on) in AXES.items() if len(on) < 3),
    "redacted": f"""WITH c AS (SELECT CAST(c_custkey AS BIGINT) AS id, c_custkey % 3 <> 0 AS m, c_custkey % 5 <> 0 AS p, {_picked("c_custkey", AXES["reg_institution"][0], 3)} AS ri, {_picked("c_custkey", AXES["ownership"][0], 3)} AS ow FROM customer),
r AS (SELECT *, p AND NOT {_PUBLIC} AS hide FROM c)
SELECT id, CAST(NULL AS VARCHAR) AS email, CASE WHEN p AND NOT hide THEN '04-' || id END AS phone, 'write to [הוסר] now' AS note, m OR hide AS contact_withheld, concat_ws(',', CASE WHEN m THEN 'email' END, CASE WHEN hide THEN 'phone' END) AS removed FROM r""",
    "leak_check": f"WITH f AS (SELECT doc_id, list_distinct(regexp_extract_all(text, '{_MAIL}')) AS found FROM documents) SELECT doc_id, CAST(len(found) AS INT) AS n FROM f WHERE len(found) > 0",
    "filtered": "SELECT doc_id FROM documents WHERE lang IN ('en', 'de') AND contains(lower(concat_ws(' ', text, source)), 'the')",
    "events_attached": """SELECT c_custkey AS id, y.years FROM customer LEFT JOIN (SELECT o_custkey, string_agg(DISTINCT CAST(year(o_orderdate) AS VARCHAR), ',' ORDER BY CAST(year(o_orderdate) AS VARCHAR)) AS years FROM orders GROUP BY o_custkey) y ON o_custkey = c_custkey""",
}
