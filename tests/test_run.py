import json

from claimloom import run


def test_from_payloads_to_published_tables(spark, tmp_path):
    """Two sources of one place, one of them with a contact, a third place outside, and a designation over the first."""
    put = lambda name, doc: (tmp_path / "in" / name).write_text(json.dumps(doc, ensure_ascii=False))
    (tmp_path / "in").mkdir()
    put("declared_antiquities.json", [{"objectid": "1", "ata_shem": "שמרון, תל", "atar_number": "10/0", "lat": 32.7, "lon": 35.2, "Shape__Area": 1000.0, "atar_heb_desc": "יישוב ביזנטית"}, {"objectid": "2", "ata_shem": "רחוק", "atar_number": "11/0", "lat": 32.9, "lon": 35.5}])
    put("osm_wikidata.json", [{"rec_id": "o1", "rec_source": "osm", "lat": 32.7005, "lon": 35.2, "name:he": "תל שמרון", "historic": "ruins", "operator": "write to a@b.org", "phone": "04-1", "osm_type": "node", "osm_id": "5"}])
    put("heritage_official.json", [{"record_type": "tmm_park_or_reserve", "id": "p", "lat": 32.7, "lon": 35.2, "designation_type": "גן לאומי", "AREA_SQM": 100000.0}])
    put("settlements.json", [{"name_he": "נהלל", "lat": 32.69, "lon": 35.197, "cbs_yishuv_code": 80, "category": "residential_locality"}])
    square = [[35.1, 32.6], [35.3, 32.6], [35.3, 32.8], [35.1, 32.8], [35.1, 32.6]]
    put("boundary.geojson", {"type": "Polygon", "coordinates": [square]})
    tables = run.build(spark, {"working": str(tmp_path / "in")}, str(tmp_path / "out"))
    (site,) = tables["store"].collect()
    assert {c.source_id for c in tables["claims"].collect()} == {"declared_antiquities", "osm_wikidata"}
    assert site.name == "תל שמרון" and site.source_count == 2 and site.in_council and site.nearest_settlement == "נהלל" and site.periods == ["byzantine"]
    assert site.statuses["protected_area"] == "national_park" and site.statuses["condition"] == "poor" and site.iaa_site_id == "10" and site.osm_id == "node/5"
    slim = tables["slim"].first()
    assert "@" not in slim.rest and "04-1" not in slim.rest and json.loads(slim.rest)["contact_withheld"]
    assert run.gate(tables) == 0 and tables["claims"].count() == 2
    written = {p.name for p in (tmp_path / "out").iterdir()}
    assert written == {"claims", "overlay", "store", "review_queue", "statistics", "audit", "slim", "details", "features", "vocabulary"}
    assert spark.read.json(str(tmp_path / "out" / "statistics")).first().sites == 1
