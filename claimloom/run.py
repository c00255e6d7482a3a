"""From payloads to published tables: the whole of the batch in one call."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from claimloom.functions import geo, names
from claimloom.operators import audit, matching, publish, sites
from claimloom.operators.redact import leaks
from claimloom.sources import adapters, claims
from claimloom.sources.files import materialise, read_json, shared_dir

_INVENTORY_FLAGS = {"blue_sign", "sign", "access"}
#: Payloads by file name, with the columns that are read.
PAYLOADS = {
    "declared_antiquities": adapters.DECLARED, "declared_antiquities_known_survey_points": adapters.SURVEYED, "iaa_discover": adapters.REGISTER, "iaa_cluster_table": adapters.SURVEY, "heritage_official": adapters.HERITAGE,
    "blue_signs": adapters.SIGNS, "culture_institutions": adapters.INSTITUTIONS, "osm_wikidata": adapters.CROSS_CHECK,
    "iicp_culture_table": ", ".join(f"`{v}` {'boolean' if k in _INVENTORY_FLAGS else 'string'}" for k, v in adapters.INVENTORY.items())
    + ", _is_emek_yizrael_council boolean, _excluded boolean, lat double, lon double, _plus_code_local string, _record_id string, _map_category_candidate string",
}


def read_payloads(spark: SparkSession, folders: dict[str, str]) -> dict[str, DataFrame]:
    """The payloads that are there: for each the first of the folders (name -> path, in order) that holds it, plain or gzipped. Manual additions are a list inside a document."""
    found = {n: publish.resolved(spark, f"{n}.json", folders) for n in PAYLOADS}
    out = {n: read_json(spark, at[0], PAYLOADS[n]) for n, at in found.items() if at}
    added = publish.resolved(spark, "additions.json", folders)
    if added:
        one = adapters.ADDED.replace(" ", ": ").replace(",: ", ", ")
        out["manual_additions"] = read_json(spark, added[0], f"entries array<struct<{one}>>").select(F.explode("entries").alias("e")).select("e.*")
    return out


def boundary_shape(rings: DataFrame):
    """The boundary's edges in the grid, as an array literal, from rings in degrees. A boundary is a closed list of a few thousand points."""
    points = rings.select("part", "ring", F.posexplode("points").alias("at", "p")).select("part", "ring", "at", geo.to_itm(F.col("p")[1], F.col("p")[0]).alias("g"))
    by: dict[tuple[int, int], list] = {}
    for r in points.orderBy("part", "ring", "at").collect():
        by.setdefault((r.part, r.ring), []).append((r.g.x, r.g.y))
    return geo.edges(list(by.values()))


def build(spark: SparkSession, folders: dict[str, str], out: str, only: list[str] | None = None) -> dict[str, DataFrame]:
    """Reads what the folders hold, writes claims, overlay, store, review queue, statistics, audit findings, slim rows, details, features and the vocabulary below out, and returns them by name.

    boundary.geojson and settlements.json are optional: without them, nothing is scoped to a boundary, and no settlement is named. An overlay is applied if a payload yields one.
    """
    shared_dir(spark)
    payloads = read_payloads(spark, folders)
    line, towns = publish.resolved(spark, "boundary.geojson", folders), publish.resolved(spark, "settlements.json", folders)
    shape = boundary_shape(claims.read_rings(spark, line[0])) if line else None

    def inside(rows: DataFrame) -> DataFrame:
        at = rows.withColumn("_grid", geo.to_itm("lat", "lon"))
        return at.withColumn("_inside_m", F.when(F.col("lat").isNotNull(), geo.signed_distance(F.col("_grid.x"), F.col("_grid.y"), shape)))

    inside = inside if shape is not None else None
    places = claims.read_places(spark, towns[0]).withColumn("name", F.col("place")).withColumn("place", F.xxhash64("place")) if towns else None
    closed = [(r["name"], r.lat, r.lon) for r in places.orderBy("name").collect()] if places is not None else []  # a council's settlements
    if "iicp_culture_table" in payloads:
        payloads["iicp_culture_table"] = adapters.settlement_reference(payloads["iicp_culture_table"], adapters.INVENTORY["settlement"], closed) if closed else payloads["iicp_culture_table"]
    found = materialise(adapters.run_adapters(payloads, inside, [n for n, *_ in closed], only))
    numbered = materialise(found.withColumn("ord", F.struct("source_id", "record_id")).withColumn("claim_id", F.monotonically_increasing_id()))
    heads = [r.w for r in numbered.select("locality").where("locality is not null").distinct().select(F.explode(names.locality_words(F.col("locality"))).alias("w")).distinct().collect()] + [w for n, *_ in closed for w in n.split() if len(w) >= 3]
    decisions = materialise(matching.decided(matching.scored(numbered, matching.candidates(numbered), heads)))
    groups, refused = matching.clusters(numbered, decisions, heads)
    clustered = materialise(numbered.join(groups, "claim_id"))
    merged = materialise(sites.merged_sites(clustered, places, shape))
    tables = {"claims": found}
    if "heritage_official" in payloads:
        tables["overlay"] = materialise(adapters.statutory_overlay(payloads["heritage_official"], inside))
        merged = materialise(sites.overlaid(merged, tables["overlay"]))
    links = materialise(sites.colocated(merged))
    merged = materialise(publish.with_display_name(sites.related(merged, links), heads))
    suspects = sites.duplicate_suspects(merged)
    checked = merged.withColumns({"distance_now": F.col("dist_to_boundary_m"), "_at": geo.try_to_wgs84(F.col("itm_x"), F.col("itm_y"))}).withColumns({"itm_lat": F.col("_at.lat"), "itm_lon": F.col("_at.lon")})
    findings = audit.findings(checked, "id", audit.name_rules(F.col("name")) | audit.site_rules(F.col("statuses")))
    doubtful = sites.possible_duplicates(suspects, links).join(merged.select(F.col("cluster_id").alias("i"), "id"), "i").select("id", F.lit("possible_duplicate").alias("kind"), F.lit("medium").alias("severity"))
    tables |= {
        "store": sites.store(merged), "review_queue": sites.review_items(numbered, decisions, refused).orderBy(F.desc("surfaced"), F.desc("score"), "i", "j"), "statistics": sites.statistics(merged),
        "audit": findings.unionByName(doubtful), "slim": publish.slim(merged), "details": publish.details(merged), "features": publish.features(merged), "vocabulary": publish.vocabulary(spark),
    }
    for name, table in tables.items():
        table.write.mode("overwrite").json(f"{out.rstrip('/')}/{name}")
    leaked = publish_leaks(tables["slim"], tables["details"])
    tables["audit"] = tables["audit"].unionByName(leaked)
    return tables


def publish_leaks(slim: DataFrame, details: DataFrame) -> DataFrame:
    """(id, kind, severity): mail addresses that are left in published texts, which is an error of the gate."""
    texts = slim.select("id", F.to_json(F.struct(*slim.columns)).alias("t")).unionByName(details.select("id", F.to_json(F.struct(*details.columns)).alias("t")))
    return leaks(texts, "t", "id").select("id", F.lit("published_personal_contact").alias("kind"), F.lit("high").alias("severity"))


def gate(tables: dict[str, DataFrame]) -> int:
    """The exit code of a build: 1 if the audit has a finding of high severity."""
    return audit.exit_code(tables["audit"])

