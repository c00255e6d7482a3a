"""What is published: names for display, slim rows and details, features, CSV, the vocabulary, archives. Everything passes the redaction gate first."""

from __future__ import annotations

from functools import reduce

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from claimloom.functions.names import is_generic, key
from claimloom.functions.vocab import AXES, CATEGORIES, CUTOFF_YEAR, PERIODS, REGISTERED, SITE_TYPES, SOURCE_RANK, TONES
from claimloom.operators import redact

#: Columns that every point needs, those that ride along when they are there, and precisions that are drawn as approximate.
CORE = [
    "id", "name", "name_en", "category", "categories", "type", "periods", "year_from", "year_to", "date_text", "era_basis", "lat", "lon", "locality", "in_council", "dist_to_boundary_m", "near_boundary",
    "nearest_settlement", "nearest_settlement_km", "location_precision", "confidence", "status_completeness", "needs_review", "source_count", "reg_summary",
]
REST = [
    "names_alt", "description", "itm_x", "itm_y", "overlay_notes", "related", "in_council_method", "excavation_years", "excavation_licenses", "excavators", "address", "phone", "email", "website", "hours_text", "admission", "operator",
    "founded_year", "wikidata_qid", "wikipedia_he", "image_url", "image_credit", "iaa_site_id", "blue_sign_number", "osm_id", "external_links", "sources", "provenance", "conflicts", "components", "status_axes_known",
    "status_axes_applicable", "spread_m", "review_reasons",
]
APPROXIMATE = ["locality_centroid", "approx_500m", "unknown"]


def place_of(locality: str = "locality", nearest: str = "nearest_settlement") -> Column:
    """The settlement that a site is grouped under: a stated locality, or the nearest one; a dash without either."""
    said, near = (F.when(F.col(c) != "", F.col(c)) for c in (locality, nearest))
    return F.coalesce(said, near, F.lit("—"))


def with_display_name(sites: DataFrame, localities: list[str] = ()) -> DataFrame:
    """sites with display_name and display_name_is_qualified: a name that only says what kind of place it is gets its settlement, unless that is part of it."""
    place = F.coalesce(F.when(F.col("locality") != "", F.col("locality")), F.when(F.col("nearest_settlement") != "", F.col("nearest_settlement")))
    own = key(F.col("name"))
    plain = F.coalesce((F.col("name") != "") & is_generic(own, list(localities)) & ~F.contains(own, key(place)), F.lit(False))
    return sites.withColumns({"display_name": F.when(plain, F.concat("name", F.lit(", "), place)).otherwise(F.col("name")), "display_name_is_qualified": plain})


def filled(c: str, kind: str) -> Column:
    """A column's value if it has any: not null, not empty."""
    some = F.size(c) > 0 if kind.startswith(("array", "map")) else F.col(c).cast("string") != "" if not kind.startswith("struct") else F.lit(True)
    return F.when(F.col(c).isNotNull() & some, F.col(c))


def slim(sites: DataFrame) -> DataFrame:
    """One row a site: core columns, a column for each status axis, and rest, a JSON object of what else there is. Sites far outside are left out; mail addresses, and phones that aren't a public body's, too."""
    kept = redact.publishable(sites)
    for c, k in (("reg_institution", "reg_institution"), ("ownership", "ownership")):
        kept = kept.withColumn(f"_{c}", F.col("statuses")[k])
    kept = redact.redact_sites(kept, "_reg_institution", "_ownership")
    kinds = dict(kept.dtypes)
    rest = F.to_json(F.struct(*(filled(c, kinds[c]).alias(c) for c in REST if c in kinds), F.when(F.col("contact_withheld"), True).alias("contact_withheld")))
    shown = [c for c in [*CORE, "display_name", "display_name_is_qualified"] if c in kinds]
    return kept.select(*shown, *(F.col("statuses")[a].alias(a) for a in AXES), rest.alias("rest"))


def details(sites: DataFrame) -> DataFrame:
    """(id, claims, detail): the redacted claim log and what the sources say besides, for the sites that have either; it is looked up one site at a time."""
    kept = redact.publishable(sites)
    claims = redact.redact_claims(F.col("log"))
    kinds = dict(kept.dtypes)
    extra = redact.scrubbed(F.col("extra"), kept.schema["extra"].dataType) if "extra" in kinds else F.lit(None).cast("map<string,string>")
    return kept.select("id", claims.alias("claims"), extra.alias("detail")).where((F.size("claims") > 0) | (F.size("detail") > 0))


def detail_of(found: DataFrame, id_: str) -> DataFrame:
    """The details of one site: a point lookup that prunes by id."""
    return found.where(F.col("id") == id_)


def features(sites: DataFrame, labels: dict[str, dict[str, str]] | None = None) -> DataFrame:
    """One GeoJSON point feature, as JSON text, for each site with a position: id, label, category, whether the position is approximate, and a subtitle."""
    labels = labels or {}
    name = lambda what, c: reduce(lambda out, kv: out.when(F.col(c) == kv[0], kv[1]), labels.get(what, {}).items(), F.when(F.lit(False), "")).otherwise(F.col(c))
    approx = F.coalesce("location_precision", F.lit("unknown")).isin(APPROXIMATE)
    place = place_of()
    sub = F.concat_ws(" · ", name("categories", "category"), F.when(place != "—", place), name("types", "type"), F.when(approx, labels.get("words", {}).get("approx", "approximate")))
    label = F.coalesce(F.when(F.col("display_name") != "", F.col("display_name")), F.when(F.col("name") != "", F.col("name")), F.lit(labels.get("words", {}).get("unnamed", "unnamed")))
    shape = F.struct(F.lit("Point").alias("type"), F.array("lon", "lat").alias("coordinates"))
    props = F.struct("id", label.alias("name"), "category", approx.alias("approx"), sub.alias("sub"))
    return sites.where("lat is not null").select("id", F.to_json(F.struct(F.lit("Feature").alias("type"), props.alias("properties"), shape.alias("geometry"))).alias("feature"))


def csv_lines(rows: DataFrame, columns: dict[str, str]) -> DataFrame:
    """(n, line): the header, behind a byte order mark, and a line for each row, in the order of the first column; columns: name -> title. Cells with a quotation mark, a comma or a line end are quoted."""
    cell = lambda c: F.when(c.rlike('[",\\n]'), F.concat(F.lit('"'), F.replace(c, F.lit('"'), F.lit('""')), F.lit('"'))).otherwise(c)
    line = F.concat_ws(",", *(cell(F.coalesce(F.col(c).cast("string"), F.lit(""))) for c in columns))
    head = ",".join(f'"{t}"' if any(x in t for x in '",\n') else t for t in columns.values())
    spark = rows.sparkSession
    return spark.range(1).select(F.lit(None).cast("string").alias("at"), F.lit("\ufeff" + head).alias("line")).unionByName(rows.select(F.col(next(iter(columns))).cast("string").alias("at"), line.alias("line")))


def write_csv_document(rows: DataFrame, columns: dict[str, str], path: str) -> None:
    """The lines as one text document with CRLF ends: an export of what a filter leaves, so it goes through one task."""
    csv_lines(rows, columns).coalesce(1).sortWithinPartitions(F.col("at").asc_nulls_first()).select("line").write.mode("overwrite").option("lineSep", "\r\n").text(path)


def tone(axis: str, value: Column) -> Column:
    """Tone of a status value: 'gap' for an unknown one, 'neutral' for one without a tone."""
    known = TONES.get(axis, {})
    by = reduce(lambda out, kv: out.when(value == kv[0], kv[1]), known.items(), F.when(value.isNull() | (value == "unknown"), "gap"))
    return by.otherwise("neutral")


def vocabulary(spark: SparkSession) -> DataFrame:
    """(list, key, ord, parent, detail): the closed lists, one row for each entry: categories, types with their category, periods with years and era, axes with their values and tones, sources, registry values."""
    rows = [("categories", c, i, None, None) for i, c in enumerate(CATEGORIES)]
    rows += [("site_types", t, i, c, None) for i, (c, t) in enumerate((c, t) for c, ts in SITE_TYPES.items() for t in ts)] + [("site_types", "unknown", sum(map(len, SITE_TYPES.values())), None, None)]
    rows += [("periods", p, i, CATEGORIES[0] if a < CUTOFF_YEAR else CATEGORIES[1], f"{a},{b}") for i, (p, (a, b)) in enumerate(PERIODS.items())]
    rows += [("status_values", v, i, a, None) for a, (values, _) in AXES.items() for i, v in enumerate(values)]
    rows += [("status_axes", a, i, None, ",".join(on)) for i, (a, (_, on)) in enumerate(AXES.items())]
    rows += [("sources", s, i, None, str(r)) for i, (s, r) in enumerate(SOURCE_RANK.items())] + [("registered_positive", v, i, a, None) for a, vs in REGISTERED.items() for i, v in enumerate(sorted(vs))]
    entries = F.array(*(F.struct(*(F.lit(x).cast(t).alias(n) for x, n, t in zip(r, ("list", "key", "ord", "parent", "detail"), ("string", "string", "int", "string", "string")))) for r in rows))
    out = spark.range(1).select(F.inline(entries))
    tones = reduce(lambda o, a: o.when(F.col("parent") == a, tone(a, F.col("key"))), AXES, F.when(F.lit(False), ""))
    return out.withColumn("detail", F.when(F.col("list") == "status_values", tones).otherwise(F.col("detail")))


# ---------------------------------------------------------------- shapes for drawing


def simplified(rings: DataFrame, tolerance: float = 10.0) -> DataFrame:
    """(part, ring, points) with the points of each ring that a line within the tolerance needs (Douglas-Peucker), for drawing only; rings stay closed, with four points at least. One ring is one row."""

    @F.pandas_udf("array<array<double>>")
    def thin(points: pd.Series) -> pd.Series:
        return points.map(lambda p: _thinned([tuple(x) for x in p], tolerance))

    return rings.withColumn("points", thin("points"))


def _thinned(points: list[tuple[float, float]], tolerance: float) -> list[list[float]]:
    """Ends and the far end of the ring stay; of every stretch, the point farthest from its chord stays if it is farther than the tolerance, and splits it."""
    if len(points) <= 4:
        return [list(p) for p in points]
    far = max(range(len(points)), key=lambda k: (points[k][0] - points[0][0]) ** 2 + (points[k][1] - points[0][1]) ** 2)
    keep, todo = {0, far, len(points) - 1}, [(0, far), (far, len(points) - 1)]
    while todo:
        a, b = todo.pop()
        (x1, y1), (x2, y2) = points[a], points[b]
        length = ((x2 - x1) ** 2 + (y2 - y1) ** 2) ** 0.5
        best, at = -1.0, None
        for k in range(a + 1, b):
            x, y = points[k]
            d = abs((x2 - x1) * (y1 - y) - (x1 - x) * (y2 - y1)) / length if length else ((x - x1) ** 2 + (y - y1) ** 2) ** 0.5
            if d > best:
                best, at = d, k
        if at is not None and (best > tolerance or len(keep) + len(todo) < 4):
            keep.add(at)
            todo += [(a, at), (at, b)]
    return [list(points[k]) for k in sorted(keep)]


def bounding_box(rings: DataFrame) -> DataFrame:
    """One row: the extent of all points of rings."""
    at = rings.select(F.explode("points").alias("p")).select(F.col("p")[0].alias("x"), F.col("p")[1].alias("y"))
    return at.agg(F.min("x").alias("min_x"), F.min("y").alias("min_y"), F.max("x").alias("max_x"), F.max("y").alias("max_y"))


def scrim(rings: DataFrame) -> DataFrame:
    """(part, ring, points) of everything that isn't inside: the world with the outer rings as holes, and the holes as parts of their own."""
    spark = rings.sparkSession
    corner = [[-180.0, -85.0], [180.0, -85.0], [180.0, 85.0], [-180.0, 85.0], [-180.0, -85.0]]
    world = spark.range(1).select(F.lit(0).alias("part"), F.lit(0).alias("ring"), F.array(*(F.array(*map(F.lit, p)) for p in corner)).alias("points"))
    outer = rings.where("ring = 0").select(F.lit(0).alias("part"), (F.col("part") + 1).alias("ring"), "points")
    holes = rings.where("ring > 0").select((F.col("part") * 1000 + F.col("ring")).cast("int").alias("part"), F.lit(0).alias("ring"), "points")
    return world.unionByName(outer).unionByName(holes)


# ---------------------------------------------------------------- archives


def write_archive(payload: DataFrame, source: str, path: str) -> None:
    """A payload behind the gate, as gzipped JSON lines: no contact column and no mail address is left in it."""
    redact.redact_payload(source, payload).write.mode("overwrite").option("compression", "gzip").json(path)


def inventory(spark: SparkSession, names: list[str], folders: dict[str, str]) -> DataFrame:
    """(name, found): for each input, the first of the folders (name -> path, in order) that holds it, plain or gzipped ('working', 'frozen.gz'), or MISSING. Only the file system is asked."""
    rows = [(n, (resolved(spark, n, folders) or (None, "MISSING"))[1]) for n in names]
    return spark.createDataFrame(rows, "name string, found string")


def resolved(spark: SparkSession, name: str, folders: dict[str, str]) -> tuple[str, str] | None:
    """(path, label) of the first file that is there: in each folder the plain one, then the gzipped one."""
    jvm = spark.sparkContext._jvm
    for label, folder in folders.items():
        for end in ("", ".gz"):
            at = jvm.org.apache.hadoop.fs.Path(f"{folder.rstrip('/')}/{name}{end}")
            if at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(at):
                return f"{folder.rstrip('/')}/{name}{end}", label + end
    return None
