import json

import pytest
from pyspark.sql import functions as F

from claimloom.functions import geo, names
from claimloom.sources import adapters, claims, files


def test_institutions(spark):
    rows = spark.createDataFrame(
        [
            ("a", "מוזיאון", "נהלל", 32.7, 35.2, None, None, "high", True, "yes", True, None, "לא נגיש", "כן, 20", "עמותה", None, "-"),
            ("b", "גלריה", None, None, None, 32.6, 35.1, None, True, "no", None, True, "נגיש חלקית", "חינם", "מועצה אזורית", None, None),
            ("c", " ", None, 32.7, 35.2, None, None, None, True, None, None, None, None, None, None, None, None),
            ("d", "אולם", None, 32.7, 35.2, None, None, None, False, None, None, None, None, None, None, None, None),
        ],
        "inst_id string, name_he string, settlement string, lat double, lon double, fallback_settlement_lat double, fallback_settlement_lon double, coord_confidence string, in_scope_for_map boolean, active string, "
        "recognised_museum boolean, registered_public_library boolean, accessibility string, admission string, operating_body string, amuta string, website string",
    )
    a, b = adapters.institutions(rows).orderBy("record_id").collect()
    assert a.statuses == {"activity": "active", "reg_institution": "recognized_museum", "a11y_disabled": "not_accessible", "accessibility": "open_paid", "ownership": "ngo"}
    assert (a.location_precision, a.url, a.category_hint) == ("exact", None, "culture")
    assert b.statuses == {"activity": "inactive", "reg_institution": "public_library", "a11y_disabled": "partial", "accessibility": "open_free", "ownership": "council"}
    assert (b.lat, b.lon, b.location_precision) == (32.6, 35.1, "locality_centroid")
    counts = claims.adapter_counts(adapters.institutions(rows)).first()
    assert (counts.n, counts.located, counts.typed, counts.dated, counts.culture) == (2, 2, 2, 0, 2)
    with pytest.raises(ValueError, match="unknown source"):
        claims.claims(rows, "nobody", F.col("inst_id"), F.col("name_he"))


def test_aliases_once(spark):
    rows = spark.createDataFrame([("1", "חורבת א", "חירבת א", "תל ב", "תל-ב", None)], "id string, a string, b string, c string, d string, e string")
    got = claims.claims(rows, "blue_signs", F.col("id"), F.col("a"), [F.col(x) for x in "bcde"]).first()
    assert got.names_alt == ["תל ב"] and got.statuses == {} and got.location_precision == "unknown"


def test_readers(spark, tmp_path):
    place = {"name": "x", "lat": 32.5, "lon": 35.0, "cbs_yishuv_code": 7, "category": "residential_locality"}
    for i, doc in enumerate(([place, place | {"category": "other"}], {"settlements": [place]}, {"records": [place | {"name": None, "settlement": "y"}]})):
        (tmp_path / f"p{i}.json").write_text(json.dumps(doc))
    assert [claims.read_places(spark, str(tmp_path / f"p{i}.json")).first().place for i in range(3)] == ["x", "x", "y"]
    square = [[0, 0], [1, 0], [1, 1], [0, 0]]
    shapes = ({"type": "Polygon", "coordinates": [square, square]}, {"type": "Feature", "geometry": {"type": "Polygon", "coordinates": [square]}}, {"type": "FeatureCollection", "features": [{"type": "Feature", "geometry": {"type": "MultiPolygon", "coordinates": [[square], [square, square]]}}]})
    for i, doc in enumerate(shapes):
        (tmp_path / f"g{i}.json").write_text(json.dumps(doc, indent=1))
    assert [claims.read_rings(spark, str(tmp_path / f"g{i}.json")).count() for i in range(3)] == [2, 1, 3]
    (tmp_path / "e1.json").write_text(json.dumps({"entities": [{"entityType": "s", "entityId": "1", "title": "a"}, {"entityType": "s", "entityId": "1", "title": "b"}]}))
    (tmp_path / "e2.json").write_text("{not json")
    (tmp_path / "e3.json").write_text(json.dumps({"other": 1}))
    got = claims.read_entities(spark, [str(tmp_path / f"e{i}.json") for i in (1, 2, 3)], "entityType: string, entityId: string, title: string").collect()
    assert [(r.title, r._srcfile) for r in got] == [("a", "e1.json")]
    (tmp_path / "c.claims.json").write_text(json.dumps([{"source_id": "blue_signs", "name": "x"}, {"source_id": "nobody", "name": "y"}]))
    with pytest.raises(Exception, match="unknown source"):
        claims.read_claims(spark, str(tmp_path / "c.claims.json")).collect()


def test_written_claims_come_back(spark, tmp_path):
    rows = spark.createDataFrame([("1", "א", 1.0)], "id string, n string, lat double")
    one = claims.claims(rows, "blue_signs", F.col("id"), F.col("n"), lat=F.col("lat"), maps={"ids": {"osm_id": F.lit("n1"), "wikidata_qid": F.lit(None)}})
    claims.write_claims(one, str(tmp_path / "out"))
    back = files.read_json(spark, str(tmp_path / "out" / "source_id=blue_signs"), claims.SCHEMA).first()
    assert (back.record_id, back.name, back.lat, back.ids) == ("1", "א", 1.0, {"osm_id": "n1"})


def test_catalogue_names_and_years(spark):
    terms = {"בית כנסת": "synagogue_ancient", "תל": "tel"}
    rows = spark.createDataFrame([("פרוה, ח'",), ("בית שערים, בית כנסת",), ("א, ב ג",), ("-",), ("ללא פסיק",)], "t string")
    assert [tuple(r[0]) for r in rows.select(names.catalog_name(rows.t, terms)).collect()] == [("ח' פרוה", None), ("בית שערים", "synagogue_ancient"), ("א, ב ג", None), (None, None), ("ללא פסיק", None)]
    years = spark.createDataFrame([("המבנה נבנה בשנת 1894",), ("הוקמה ב 1921",), ("בשנת 200 נבנה",), ("2017",)], "t string")
    assert [r[0] for r in years.select(names.founding_year(years.t)).collect()] == [1894, None, None, None]
    assert spark.createDataFrame([("<p>a</p>",)], "t string").select(names.without_tags(F.col("t"))).first()[0] == "a"
    assert geo.AREA[0] < geo.AREA[1]
