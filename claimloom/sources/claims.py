"""Claims: one contract for all sources, and the readers that make them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from claimloom.functions.names import composed, display, key
from claimloom.functions.vocab import AXES, CATEGORIES, SOURCE_RANK

_TEXT = "string"
#: Columns of a claim and their types.
CLAIM = {
    "source_id": _TEXT, "record_id": _TEXT, "url": _TEXT, "retrieved": _TEXT, "name": _TEXT, "names_alt": "array<string>", "name_en": _TEXT, "description": _TEXT,
    "lat": "double", "lon": "double", "itm_x": "double", "itm_y": "double", "location_precision": _TEXT, "category_hint": _TEXT, "type": _TEXT, "periods": "array<string>",
    "year_from": "int", "year_to": "int", "date_text": _TEXT, "locality": _TEXT, "statuses": "map<string,string>", "practical": "map<string,string>", "ids": "map<string,string>",
    "extra": "map<string,string>", "excavation_years": "array<string>", "excavation_licenses": "array<string>", "excavators": "array<string>",
}
SCHEMA = ", ".join(f"{k} {v}" for k, v in CLAIM.items())


def _map(entries: dict[str, Column]) -> Column:
    """A map of the entries that have a value."""
    if not entries:
        return F.create_map().cast("map<string,string>")
    pairs = F.array(*(F.struct(F.lit(k).alias("k"), v.cast("string").alias("v")) for k, v in entries.items()))
    return F.map_from_entries(F.filter(pairs, lambda p: p["v"].isNotNull() & (p["v"] != "")))


def _aliases(names: list[Column], name: Column) -> Column:
    """Other names in order, in display form, each key once and not the name's own."""
    entries = F.array(*(F.struct(display(n, normalise=False).alias("n"), key(n).alias("k")) for n in names))

    def add(kept: Column, e: Column) -> Column:
        seen = F.exists(kept, lambda x: x["k"] == e["k"]) | (e["k"] == key(name)) | (e["k"] == "")
        return F.when(seen, kept).otherwise(F.array_append(kept, e))

    return F.aggregate(entries, F.array().cast("array<struct<n:string,k:string>>"), add, lambda kept: F.transform(kept, lambda x: x["n"]))


def claims(
    rows: DataFrame, source: str, record_id: Column, name: Column, names_alt: list[Column] = (), maps: dict[str, dict[str, Column]] | None = None, normalise: bool = False, **columns: Column
) -> DataFrame:
    """rows as claims. Columns that aren't given are null, lists and maps empty, the precision 'unknown'; unknown statuses aren't stated. Rows without a name go.

    normalise: names and aliases are brought to NFC first, which needs Python; for sources that may hold decomposed text.
    """
    if source not in SOURCE_RANK:
        raise ValueError(f"unknown source: {source}")
    maps = maps or {}
    if normalise:
        rows = rows.withColumn("_name", composed(name))
        name, names_alt = F.col("_name"), list(names_alt)
        for k, n in enumerate(names_alt):
            rows = rows.withColumn(f"_alias{k}", composed(n))
            names_alt[k] = F.col(f"_alias{k}")
    given = {"source_id": F.lit(source), "record_id": record_id.cast("string"), "name": name, "location_precision": F.lit("unknown")} | columns
    if names_alt:
        given["names_alt"] = _aliases(list(names_alt), name)
    for m in ("statuses", "practical", "ids", "extra"):
        if m not in given:
            given[m] = _map(maps.get(m, {}))
    given["statuses"] = F.map_filter(given["statuses"], lambda k, v: (v != "unknown") & k.isin(list(AXES)))
    for c in ("names_alt", "periods", "excavation_years", "excavation_licenses", "excavators"):
        given[c] = F.coalesce(given.get(c, F.lit(None)).cast("array<string>"), F.array().cast("array<string>"))
    return rows.where(name.isNotNull()).select(*(given.get(c, F.lit(None)).cast(t).alias(c) for c, t in CLAIM.items()))


def read_claims(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    """Claims from JSON files, each an array, with ord, their order by file name and place in the array; a missing record_id is the file and the place; an unknown source is an error."""
    raw = spark.read.text(paths, wholetext=True).select(F.col("_metadata.file_name").alias("_f"), F.posexplode(F.from_json("value", f"array<struct<{_typed(SCHEMA)}>>", {"mode": "FAILFAST"})).alias("_n", "_c")).select("_f", "_n", "_c.*")
    ok = F.when(F.col("source_id").isin(list(SOURCE_RANK)), F.col("source_id")).otherwise(F.raise_error(F.concat(F.lit("unknown source: "), F.coalesce("source_id", F.lit("null")))).cast("string"))
    at = F.concat("_f", F.lit("-"), F.col("_n").cast("string"))
    return raw.withColumns({"source_id": ok, "record_id": F.coalesce("record_id", at), "ord": F.struct("_f", "_n")}).drop("_f", "_n")


def write_claims(found: DataFrame, path: str) -> None:
    """One folder for each source."""
    found.write.mode("overwrite").partitionBy("source_id").json(path)


def read_places(spark: SparkSession, path: str) -> DataFrame:
    """(place, lat, lon, code, category) of a list of places, or of an object that holds one under 'settlements' or 'records'; places without a category of residence go."""
    one = "name_he string, name string, shem_yishuv string, settlement string, lat double, lon double, cbs_yishuv_code int, category string"
    raw = spark.read.schema(f"{one}, settlements array<struct<{_typed(one)}>>, records array<struct<{_typed(one)}>>").option("multiLine", True).json(path)
    own = F.struct(*(c.split(" ")[0] for c in one.split(", ")))
    each = raw.select(F.explode(F.coalesce("settlements", "records", F.array(own))).alias("p")).select("p.*")
    found = each.select(F.coalesce("name_he", "name", "shem_yishuv", "settlement").alias("place"), "lat", "lon", F.col("cbs_yishuv_code").alias("code"), "category")
    return found.where("place is not null and category = 'residential_locality'")


def _typed(ddl: str) -> str:
    return ", ".join(c.replace(" ", ": ", 1) for c in ddl.split(", "))


def read_features(spark: SparkSession, paths: str | list[str], number: str, columns: dict[str, str]) -> DataFrame:
    """(number, columns) of the features' properties in GeoJSON files, one row for each number: that of the last file by name, and there the last feature."""
    raw = spark.read.text(paths, wholetext=True).select(F.col("_metadata.file_name").alias("_f"), F.posexplode(F.from_json(F.get_json_object("value", "$.features"), "array<string>")).alias("_n", "p"))
    pick = lambda c, t: F.get_json_object("p", f"$.properties.{c}").cast(t).alias(c)
    rows = raw.select("_f", "_n", pick(number, "string"), *(pick(c, t) for c, t in columns.items())).where(F.col(number).isNotNull())
    return rows.groupBy(number).agg(F.max_by(F.struct(*columns), F.struct("_f", "_n")).alias("r")).select(number, "r.*")


def key_values(doc: Column) -> Column:
    """A map from a list of {key, value} that is JSON, or JSON inside a JSON string; empty if it is neither."""
    inner = F.coalesce(F.get_json_object(F.concat(F.lit('{"d":'), doc, F.lit("}")), "$.d"), doc)
    pairs = F.coalesce(F.from_json(inner, "array<struct<key: string, value: string>>"), F.array().cast("array<struct<key:string,value:string>>"))
    return F.map_from_entries(F.filter(pairs, lambda p: p["key"].isNotNull()))


def read_rings(spark: SparkSession, path: str) -> DataFrame:
    """(part, ring, points) of a GeoJSON document: a collection, a feature or a bare geometry, of polygons or multipolygons."""
    raw = spark.read.text(path, wholetext=True)
    shape = lambda c: F.coalesce(F.get_json_object(c, "$.geometry"), c)
    features = F.coalesce(F.from_json(F.get_json_object("value", "$.features"), "array<string>"), F.array("value"))
    geometry = raw.select(F.explode(F.transform(features, shape)).alias("g")).select(F.get_json_object("g", "$.type").alias("t"), F.get_json_object("g", "$.coordinates").alias("c"))
    multi = F.when(F.col("t") == "MultiPolygon", F.from_json("c", "array<array<array<array<double>>>>")).when(F.col("t") == "Polygon", F.array(F.from_json("c", "array<array<array<double>>>")))
    parts = geometry.select(F.posexplode(multi).alias("part", "p"))
    return parts.select("part", F.posexplode("p").alias("ring", "points"))


def read_entities(spark: SparkSession, paths: str | list[str], entity: str) -> DataFrame:
    """Entities of raw payloads ({"entities": [...]}) with _srcfile; files that can't be parsed or lack entities are skipped. The first of each (entityType, entityId) stays."""
    raw = spark.read.schema(f"entities array<struct<{entity}>>, _corrupt string").option("multiLine", True).option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", "_corrupt").json(paths)
    each = raw.withColumn("_srcfile", F.col("_metadata.file_name")).where("entities is not null").select("_srcfile", F.posexplode("entities").alias("_n", "e")).select("_srcfile", "_n", "e.*")
    rest = [c for c in each.columns if c not in ("entityType", "entityId")]
    first = each.groupBy("entityType", "entityId").agg(F.min_by(F.struct(*rest), F.struct("_srcfile", "_n")).alias("r"))
    return first.select("entityType", "entityId", "r.*").drop("_n")


def adapter_counts(found: DataFrame) -> DataFrame:
    """(source_id, n, located, dated, typed, statuses, and one column for each category and for none) of claims, one pass."""
    by = [F.count_if(F.col("category_hint") == c).alias(c) for c in CATEGORIES]
    return found.groupBy("source_id").agg(
        F.count(F.lit(1)).alias("n"), F.count("lat").alias("located"), F.count_if(F.size("periods") > 0).alias("dated"), F.count("type").alias("typed"), F.sum(F.size("statuses")).alias("statuses"),
        *by, F.count_if(F.col("category_hint").isNull()).alias("uncategorised"),
    )
