"""Vectors and fixtures for names, geometry, matching, merging, redaction and audit."""

import itertools
import random

import pytest
from pyspark.sql import functions as F

from claimloom.functions import geo, names
from claimloom.operators import audit, facets, joins, matching, merge, redact, sites

CLAIM = (
    "claim_id long, source_id string, record_id string, ord long, name string, names_alt array<string>, category_hint string, type string, lat double, lon double, "
    "location_precision string, locality string, ids map<string,string>, periods array<string>, year_from int, statuses map<string,string>"
)


def claim(n, source, name, lat=None, lon=None, hint="archaeological", type_="khirbe", **more):
    row = dict(claim_id=n, source_id=source, record_id=str(n), ord=n, name=name, names_alt=[], category_hint=hint, type=type_, lat=lat, lon=lon, location_precision="exact", locality=None, ids={}, periods=[], year_from=None, statuses={})
    return tuple((row | more).values())


def test_name_keys(spark):
    rows = spark.createDataFrame([("חירבת שמרון",), ("חורבת שמרון",), ('בית הַ"עם"',), ("אל-ג'ליל",), ("שמורת טבע",), ("",), (None,)], "n string")
    got = [tuple(r) for r in rows.select(names.key(rows.n), names.is_generic(names.key(rows.n))).collect()]
    assert got[0] == got[1] and got[0][0].endswith("שמרונ")
    assert got[2] == ("בית העמ", True)
    assert got[3][0] == "גליל"
    assert got[4][0] == "שמורת טבע"  # stop words stay where nothing else would
    assert got[5][0] == got[6][0] == ""


def lcs_ratio(a, b):
    row = [0] * (len(b) + 1)
    for x in a:
        row = list(itertools.accumulate(range(1, len(b) + 1), lambda left, j, r=row: r[j - 1] + 1 if x == b[j - 1] else max(left, r[j]), initial=0))
    return 2 * row[-1] / (len(a) + len(b)) if a or b else 1.0


def test_ratio_is_the_longest_common_subsequence():
    draw = random.Random(3)
    for _ in range(300):
        a, b = ("".join(draw.choices("abcd ", k=draw.randint(0, 12))) for _ in range(2))
        assert names.ratio(a, b) == pytest.approx(lcs_ratio(a, b))


@pytest.mark.parametrize(("a", "b", "sort", "whole"), [("beit haam", "beit haam nahalal", 0.6923, 1.0), ("a b", "c d", 0.3333, 0.3333), ("alpha beta", "beta alpha", 1.0, 1.0), ("", "a", 0.0, 0.0)])
def test_word_ratios(a, b, sort, whole):
    assert names.sort_ratio(a, b) == pytest.approx(sort, abs=1e-4)
    assert names.set_ratio(a, b) == pytest.approx(whole, abs=1e-4)


def test_similarity_needs_more_than_a_head(spark):
    rows = [("תל שמרון", "חורבת שמרון"), ("חירבת שמרון", "חורבת שימרון"), ("תל קשיש", "תל יוסף"), ("", "תל"), (None, None)]
    s = [r[0] for r in spark.createDataFrame(rows, "a string, b string").select(names.similarity(F.col("a"), F.col("b"))).collect()]
    assert s[0] >= 0.85 and s[1] >= 0.7 and s[2] < 0.5 and s[3] == s[4] == 0.0


def test_projection_and_grids(spark):
    p = spark.createDataFrame([(32.6963, 35.1972), (32.55, 35.05), (32.85, 35.5)], "lat double, lon double")
    rows = p.select("lat", "lon", geo.to_itm("lat", "lon").alias("i")).select("*", geo.try_to_wgs84(F.col("i.x"), F.col("i.y")).alias("w"), geo.try_to_wgs84(F.col("i.x"), F.col("i.y") - 400_000).alias("off")).collect()
    for r in rows:
        assert abs(r.w.lat - r.lat) < 1e-5 and abs(r.w.lon - r.lon) < 1e-5 and r.off is None
    assert abs(rows[1].i.x - 204950) < 3 and abs(rows[1].i.y - 717320) < 3
    g = spark.createDataFrame([(217000.0, 733000.0), (167000.0, 233000.0), (35.2, 32.7)], "x double, y double")
    assert [r[0] for r in g.select(geo.detect_grid(g.x, g.y)).collect()] == ["itm", "ics", "unknown"]


def test_plus_codes(spark):
    full = spark.createDataFrame([("7FG49Q00+", 20.375, 2.775), ("7FG49QCJ+2V", 20.3700625, 2.7821875), ("8FVC2222+22", 47.0000625, 8.0000625)], "code string, lat double, lon double")
    for r in full.select("lat", "lon", geo.plus_center(full.code).alias("c")).collect():
        assert abs(r.c.lat - r.lat) < 1e-9 and abs(r.c.lon - r.lon) < 1e-9
    p = spark.createDataFrame([(32.6963, 35.1972), (32.7323, 35.1710), (-33.857, 151.215), (0.0, 0.0)], "lat double, lon double")
    short = p.withColumn("code", geo.plus_encode(p.lat, p.lon)).withColumn("s", F.substring("code", 5, 20))
    for r in short.select("lat", "lon", geo.plus_center(F.col("code")).alias("c"), geo.plus_recover(F.col("s"), F.col("lat"), F.col("lon")).alias("r")).collect():
        assert abs(r.c.lat - r.lat) < 2e-4 and abs(r.r.lat - r.c.lat) < 1e-6 and abs(r.r.lon - r.c.lon) < 1e-6
    bad = spark.createDataFrame([("nothing",), (None,), ("P4CV+H3 Alonim",)], "t string")
    assert [r[0] is None for r in bad.select(geo.plus_parse(bad.t)).collect()] == [True, True, False]


def test_polygon_with_hole(spark):
    shape = geo.edges([[(0, 0), (10, 0), (10, 10), (0, 10)], [(4, 4), (6, 4), (6, 6), (4, 6)], [(20, 0), (30, 0), (30, 10), (20, 10)]])
    p = spark.createDataFrame([(2.0, 5.0), (5.0, 5.0), (15.0, 5.0), (25.0, 5.0), (0.0, 5.0), (None, 1.0)], "itm_x double, itm_y double")
    rows = geo.jurisdiction(p, shape).collect()
    assert [r.dist_to_boundary_m for r in rows] == [2.0, -1.0, -5.0, 5.0, 0.0, None]
    assert [r.in_council for r in rows] == [True, False, False, True, False, None]


def test_cluster_refuses_two_rows_of_one_source(spark):
    name = "מגדל שמרון"
    rows = [claim(1, "blue_signs", name, locality="נהלל"), claim(2, "blue_signs", name, locality="אלונים"), claim(3, "osm_wikidata", name), claim(4, "amudanan", "אחר", 32.9, 35.3)]
    claims = spark.createDataFrame(rows, CLAIM)
    pairs = matching.decided(matching.scored(claims, matching.candidates(claims)))
    found, refused = matching.clusters(claims, pairs)
    of = {r.claim_id: r.cluster_id for r in found.collect()}
    assert of == {1: 1, 2: 2, 3: 1, 4: 4}
    assert [tuple(r) for r in refused.collect()] == [(2, 3)]


def test_scores_by_distance_and_identifier(spark):
    rows = [
        claim(1, "blue_signs", "חורבת שמרון", 32.7, 35.2, ids={"iaa_site_id": "7"}), claim(2, "osm_wikidata", "חורבת שמרון", 32.7009, 35.2), claim(3, "amudanan", "חורבת שמרון", 32.7063, 35.2),
        claim(4, "iaa_discover", "שם אחר", 32.7, 35.2, ids={"iaa_site_id": "7"}), claim(5, "heritage_official", "חורבת שמרון", 32.7, 35.2, ids={"iaa_site_id": "8"}),
    ]
    claims = spark.createDataFrame(rows, CLAIM)
    pairs = spark.createDataFrame([(1, 2), (1, 3), (1, 4), (1, 5)], "i long, j long")
    got = {r.j: r for r in matching.decided(matching.scored(claims, pairs)).collect()}
    assert got[2].kind == "merge" and got[2].score == pytest.approx(0.6 + 0.4 * (1 - got[2].metres / 400), abs=1e-3)
    assert got[3].mode == "beyond_gate" and got[3].score == 0.6 + 0.0 and got[3].kind == "borderline_match"
    assert got[4].rank == 2.0 and got[5].rank == 1.5


def as_claims(spark, rows):
    """Rows of claim() with a cluster in front, padded to the contract."""
    from claimloom.sources.claims import CLAIM as CONTRACT

    df = spark.createDataFrame(rows, "cluster_id long, " + CLAIM)
    for c, t in CONTRACT.items():
        if c not in df.columns:
            df = df.withColumn(c, F.lit(None).cast(t))
    lists = {c: F.coalesce(c, F.array().cast("array<string>")) for c in ("excavation_years", "excavation_licenses", "excavators")}
    return df.withColumns(lists | {c: F.coalesce(c, F.create_map().cast("map<string,string>")) for c in ("practical", "extra")})


def test_merge_rules(spark):
    rows = [
        (1, *claim(1, "declared_antiquities", "א", 32.7, 35.2, periods=["roman", "iron"], year_from=1950, statuses={"reg_antiquity": "declared"})),
        (1, *claim(2, "osm_wikidata", "ב", 32.7001, 35.2, statuses={"reg_antiquity": "none", "condition": "fair"})),
        (3, *claim(3, "amudanan", "ג", hint=None, location_precision=None)),
        (5, *claim(5, "heritage_official", "תל א", hint="historic")), (5, *claim(6, "blue_signs", "טל-א", hint="historic", year_from=1900)), (5, *claim(7, "iaa_discover", "אחר", hint="historic", year_from=1900)),
    ]
    claims = as_claims(spark, rows)
    made = sites.merged_sites(claims)
    got = {r.cluster_id: r for r in made.collect()}
    one, three, five = got[1], got[3], got[5]
    assert (one.category, one.categories, one.era_basis, one.reg_summary) == ("archaeological", ["archaeological", "historic"], "authority_and_periods", "registered")
    assert one.periods == ["iron", "roman"] and one.statuses["reg_antiquity"] == "declared"
    assert [(c.field, c.chosen, [r.value for r in c.rejected]) for c in one.conflicts] == [("name", "א", ["ב"])]
    assert [(c.source_id, c.reason) for c in one.log if c.field == "reg_antiquity" and not c.used] == [("osm_wikidata", sites.NOT_THE_AUTHORITY)]
    assert one.components.existence == 0.98 and one.components.location == 0.98 and one.itm_x is not None
    assert "stated_year_1950_contradicts_periods" in one.review_reasons
    assert (three.category, three.era_basis, three.components.location) == ("archaeological", "unknown", 0.05)
    assert three.review_reasons == ["no_coordinate", "era_undetermined", "single_weak_source"]
    # names go by the category's list: blue signs first, and two spellings of one key agree
    assert five.name == "טל-א" and five.provenance["name"] == ["blue_signs", "heritage_official"] and [c.field for c in five.conflicts] == ["name"]
    cover = spark.createDataFrame([("protected_area", 1, 32.7, 35.2, 500.0, "national_park", "d", "p", None, None, "tmm", "heritage_official")], "axis string, feature long, lat double, lon double, radius_m double, value string, designation string, plan string, plan_number string, stage string, record_type string, source_id string")
    over = {r.cluster_id: r for r in sites.overlaid(made, cover).collect()}
    assert over[1].statuses["protected_area"] == "national_park" and over[3].statuses["protected_area"] == "unknown"
    assert over[1].status_axes_known == one.status_axes_known + 1 and over[1].provenance["protected_area"] == ["heritage_official"] and over[1].log[-1].value == "national_park"


def test_localities_are_no_patterns(spark):
    rows = spark.createDataFrame([("בית העם x(y",), ("בית a.b",), ("בית acb",)], "n string")
    odd = ["x(y", "a.b"]
    got = [tuple(r) for r in rows.select(names.is_generic(names.key(rows.n), odd), names.distinctive(names.key(rows.n), odd)).collect()]
    assert got[1] == (True, "בית a.b") and got[2] == (False, "acb")


@pytest.mark.parametrize(("a", "b", "least", "most"), [
    ("חורבת שמרון", "חירבת שמרון", 1.0, 1.0), ("תל שמרון", "חורבת שמרון", 0.85, 1.0), ("תל שמרון", "תל שימרון", 0.85, 1.0), ("מוזיאון בית הראשונים", "בית הראשונים", 0.0, 1.0), ("תל שמרון", "תל מגידו", 0.0, 0.5), ("כפר יהושע", "כפר ברוך", 0.0, 0.5), ("", "תל", 0.0, 0.01),
])
def test_similarity_bounds(spark, a, b, least, most):
    s = spark.createDataFrame([(a, b)], "a string, b string").select(names.similarity(F.col("a"), F.col("b"))).first()[0]
    assert least <= s <= most


def test_nearest_across_the_meridian_and_early_stop(spark):
    rows = spark.createDataFrame([(1, 10.0, 179.99), (2, 32.0, 35.0), (3, None, None)], "id long, lat double, lon double")
    places = spark.createDataFrame([(7, 10.0, -179.99), (8, 10.0, 178.0), (9, 32.001, 35.0)], "place long, lat double, lon double")
    assert sorted((r.id, r.place) for r in joins.nearest(rows, places, "id").collect()) == [(1, 7), (2, 9)]


def test_archives_inputs_and_shapes(spark, tmp_path):
    from claimloom.operators import publish
    from claimloom.sources import claims as reader

    rows = spark.createDataFrame([("a@b.co", "to x@y.org", "keep")], "email string, note string, name string")
    publish.write_archive(rows, "heritage_official", str(tmp_path / "frozen" / "h.json.gz"))
    assert spark.read.json(str(tmp_path / "frozen" / "h.json.gz")).first().asDict() == {"note": "to [הוסר]", "name": "keep"}
    (tmp_path / "work").mkdir()
    (tmp_path / "work" / "a.json").write_text("[]")
    (tmp_path / "work" / "b.json.gz").write_text("")
    folders = {"working": str(tmp_path / "work"), "frozen": str(tmp_path / "frozen")}
    assert [tuple(r) for r in publish.inventory(spark, ["a.json", "b.json", "h.json", "c.json"], folders).collect()] == [("a.json", "working"), ("b.json", "working.gz"), ("h.json", "frozen.gz"), ("c.json", "MISSING")]
    ring = [[0.0, 0.0], [50.0, 1.0], [100.0, 0.0], [100.0, 100.0], [0.0, 100.0], [0.0, 0.0]]
    rings = spark.createDataFrame([(0, 0, ring), (0, 1, [[40.0, 40.0], [60.0, 40.0], [60.0, 60.0], [40.0, 40.0]])], "part int, ring int, points array<array<double>>")
    thin = {r.ring: r.points for r in publish.simplified(rings, 10.0).collect()}
    assert thin[0] == [[0.0, 0.0], [100.0, 0.0], [100.0, 100.0], [0.0, 100.0], [0.0, 0.0]] and len(thin[1]) == 4
    assert publish.bounding_box(rings).first() == (0.0, 0.0, 100.0, 100.0) and publish.scrim(rings).count() == 3
    publish.write_csv_document(spark.createDataFrame([("1", 'a "b"'), ("0", None)], "id string, t string"), {"id": "id", "t": "text"}, str(tmp_path / "csv"))
    (part,) = (tmp_path / "csv").glob("part-*")
    assert part.read_bytes().decode() == '\ufeffid,text\r\n0,\r\n1,"a ""b"""\r\n'
    (tmp_path / "f1.geojson").write_text('{"features": [{"properties": {"n": "1/0", "s": "a"}}, {"properties": {"n": "2/0", "s": "b"}}]}')
    (tmp_path / "f2.geojson").write_text('{"features": [{"properties": {"n": "1/0", "s": "c"}}]}')
    found = reader.read_features(spark, [str(tmp_path / f"f{i}.geojson") for i in (1, 2)], "n", {"s": "string"})
    assert sorted(map(tuple, found.collect())) == [("1/0", "c"), ("2/0", "b")]
    docs = spark.createDataFrame([('[{"key": "a", "value": "1"}]',), ('"[{\\"key\\": \\"a\\", \\"value\\": \\"2\\"}]"',), ("no",)], "d string")
    assert [r[0] for r in docs.select(reader.key_values(F.col("d"))).collect()] == [{"a": "1"}, {"a": "2"}, {}]


def test_unknown_source_is_an_error(spark):
    with pytest.raises(Exception, match="unknown source"):
        spark.createDataFrame([("nobody",)], "s string").select(merge.source_rank(F.col("s"))).collect()


def test_redaction(spark):
    rows = spark.createDataFrame(
        [(1, "a@b.co", "04-1", "none", "private", {"k": "to x@y.org"}, [("n", "q@w.net")]), (2, "", "04-2", None, "state", None, None)],
        "id long, email string, phone string, reg_institution string, ownership string, extra map<string,string>, notes array<struct<a:string,b:string>>",
    )
    out = redact.redact_sites(rows)
    one, two = out.orderBy("id").collect()
    assert one.email is None and one.phone is None and one.removed == ["email", "phone"] and one.contact_withheld
    assert "@" not in one.extra["k"] and "@" not in one.notes[0].b
    assert two.phone == "04-2" and not two.contact_withheld and two.extra is None
    again = redact.redact_sites(out.drop("removed", "contact_withheld")).orderBy("id").collect()
    assert [(r.phone, r.extra, r.notes) for r in again] == [(r.phone, r.extra, r.notes) for r in (one, two)]
    assert redact.leaks(out.select("id", F.to_json("extra").alias("t")), "t", "id").isEmpty()


def test_audit(spark):
    bad = [(1, None), (2, "גן לאומי"), (3, "הירבה, תל"), (4, "שם 12345"), (5, "שם 1948"), (6, "Khirbet"), (7, "אבן אבן"), (8, "א" * 91), (9, "לת תיב"), (10, "שם טוב")]
    rows = spark.createDataFrame(bad, "id long, name string")
    found = audit.findings(rows, "id", audit.name_rules(F.col("name")))
    got = {}
    for r in found.collect():
        got.setdefault(r.id, set()).add(r.kind)
    assert got == {1: {"name_missing"}, 2: {"name_is_designation"}, 3: {"name_inverted"}, 4: {"name_trailing_number"}, 6: {"name_latin_only"}, 7: {"name_repeated_word"}, 8: {"name_too_long"}, 9: {"name_reversed"}}
    assert audit.exit_code(found) == 1 and audit.exit_code(found.where("id in (4, 7)")) == 0
    assert audit.summary(found).count() == 8
    site = spark.createDataFrame(
        [(1, "archaeological", ["archaeological"], "tel", ["state"], 32.7, 35.2, 32.7, 35.2, 1.0, True, 5.0, 5.0, {}, "registered", {"reg_antiquity": "declared"}), (2, "nothing", [], None, [], 10.0, 35.2, None, None, None, None, None, None, {}, None, {})],
        "id long, category string, categories array<string>, type string, periods array<string>, lat double, lon double, itm_lat double, itm_lon double, itm_x double, in_council boolean, dist_to_boundary_m double, distance_now double, provenance map<string,array<string>>, reg_summary string, statuses map<string,string>",
    )
    kinds = {(r.id, r.kind) for r in audit.findings(site, "id", audit.site_rules(F.col("statuses"))).collect()}
    assert kinds == {(1, "status_without_provenance"), (2, "coordinate_outside_box"), (2, "bad_category")}


def test_terms_and_filters(spark):
    t = spark.createDataFrame([("early bronze and iron",), ("bronze",), (None,)], "t string")
    terms = {"bronze": "B", "early bronze": "EB", "iron": "I"}
    assert [r[0] for r in t.select(names.first_term(t.t, terms)).collect()] == ["EB", "B", None]
    assert [r[0] for r in t.select(joins.all_terms(t.t, terms)).collect()] == [["EB", "I"], ["B"], []]
    known = F.array(F.lit("נהלל"), F.lit("יקנעם"))
    l = spark.createDataFrame([("אין; יקנעם|נהלל",), ("x",)], "t string")
    assert [r[0] for r in l.select(joins.first_known_part(l.t, known)).collect()] == ["יקנעם", None]
    h = spark.createDataFrame([("#cat=a,b&type=c%20d",)], "t string")
    assert h.select(facets.hash_to_filters(h.t)).first()[0] == {"cat": ["a", "b"], "type": ["c d"]}


def test_pairs_stay_within_a_collection(spark):
    from claimloom.operators.fusion import near_links

    rows = [(b, *claim(i, "osm_wikidata", "תל שמרון", 32.7, 35.2)) for b, i in ((1, 1), (1, 2), (2, 3), (2, 4))]
    claims = spark.createDataFrame(rows, "block long, " + CLAIM)
    inside = {(1, 2), (3, 4)}
    assert {tuple(r) for r in matching.candidates(claims, within=["block"]).collect()} == inside
    assert {(r.i, r.j) for r in near_links(claims, 300.0, within=["block"]).collect()} == inside
    assert matching.candidates(claims).count() == near_links(claims, 300.0).count() == 6


def test_similarities_equal_single_comparisons(spark):
    from claimloom.operators.fusion import similarities

    texts = ["תל שמרון", "חורבת שמרון", "מגדל המים", "", "תל-שמרון"]
    pairs = spark.createDataFrame([(a, b) for a in texts for b in texts] * 2, "x string, y string")
    want = {(r.x, r.y): r.s for r in pairs.select("x", "y", names.similarity(F.col("x"), F.col("y")).alias("s")).collect()}
    got = similarities(pairs).collect()
    assert len(got) == 25 and {(r.x, r.y): r.similarity for r in got} == want and all(r.keyed == (r.x != "" and r.y != "") for r in got)


def test_nearest_and_cover_of_repeated_positions(spark):
    rows = spark.createDataFrame([(i, 32.0 + i % 3 * 0.01, 35.0) for i in range(60)] + [(60, 40.0, 50.0), (61, None, 35.0)], "id long, lat double, lon double")
    places = spark.createDataFrame([(p, 32.0 + p % 2 * 0.012, 35.0) for p in range(40, 0, -1)], "place long, lat double, lon double")
    got = {r.id: r.place for r in joins.nearest(rows, places, "id").collect()}
    assert got == {i: (2, 1, 1)[i % 3] for i in range(60)} | {60: 1}
    features = places.select(F.col("place").alias("feature"), "lat", "lon", F.when(F.col("place") < 20, 100.0).otherwise(300.0).alias("radius_m"))
    cover = {r.id: (r.feature, r.metres) for r in joins.within_own_radius(rows, features, "id", 300.0).collect()}
    assert cover == {i: (2, 0.0) if i % 3 == 0 else (21, 222.39) for i in range(60) if i % 3 != 2} | {}
    assert joins.nearest(rows, places.limit(0), "id").isEmpty()
