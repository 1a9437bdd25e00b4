import json
import random

import pytest
from pyspark.sql import functions as F

from revtide.operators.geo import (
    admit_coordinates,
    assemble_routes,
    check_credit,
    decode_features,
    decode_places,
    decode_routes,
    resource_points,
    box_candidates,
    box_cells,
    within_bounds,
)
from revtide.verdicts import Refused

NAN, INF = float("nan"), float("inf")


def bodies(spark, **by_id):
    data = [(k, v if isinstance(v, str) else json.dumps(v)) for k, v in by_id.items()]
    return spark.createDataFrame(data, "response_id string, body string")


def reasons(refused):
    return {r.response_id: r.reject_reason for r in refused.collect()}


def test_coordinates(spark):
    frame = spark.createDataFrame(
        [(180.0, 90.0, 0.0), (-180.0, -90.0, 1.5), (180.1, 0.0, 0.0), (0.0, -90.5, 0.0), (NAN, 0.0, 0.0),
         (0.0, INF, 0.0), (None, 0.0, 0.0), (0.0, 0.0, -1.0), (0.0, 0.0, INF), (0.0, 0.0, NAN)],
        "lon double, lat double, metres double",
    )
    assert [r.reject_reason for r in admit_coordinates(frame, "metres").collect()] == [
        None, None, "longitude_out_of_range", "latitude_out_of_range", "not_finite", "not_finite",
        "not_finite", "metres_invalid", "metres_invalid", "metres_invalid",
    ]


def contains(box, lon, lat):
    west, south, east, north = box
    inside = lon >= west or lon <= east if west > east else west <= lon <= east
    return inside and south <= lat <= north


def test_boxes_equal_brute_force(spark):
    rng = random.Random(5)
    boxes = [(n, *rng.choice([(-180.0, 180.0), (170.0, -170.0), (10.0, 20.0), (-180.0, -180.0), (179.0, 178.0)]), -90.0, 90.0)
             for n in range(5)]
    boxes = [(n, w, s, e, top) for n, w, e, s, top in boxes]
    boxes += [(n, rng.uniform(-180, 180), -rng.uniform(0, 90), rng.uniform(-180, 180), rng.uniform(0, 90)) for n in range(5, 12)]
    boxes += [(90, 0.0, 10.0, 5.0, -10.0), (91, 0.0, -91.0, 5.0, 10.0), (92, 180.0, 0.0, 180.0, 90.0)]
    points = [(n, rng.choice([-180.0, 180.0, 175.0, 12.0, rng.uniform(-180, 180)]), rng.choice([-90.0, 90.0, 0.0, rng.uniform(-90, 90)]))
              for n in range(300)]
    points += [(900, 181.0, 0.0), (901, NAN, 0.0)]
    got = within_bounds(
        spark.createDataFrame(points, "p int, lon double, lat double"),
        spark.createDataFrame(boxes, "box_id int, west double, south double, east double, north double"),
        salts=3,
    )
    want = sorted(
        (p, b[0]) for p, lon, lat in points if p < 900 for b in boxes
        if b[0] not in (90, 91) and contains(b[1:], lon, lat)
    )
    assert sorted((r.p, r.box_id) for r in got.collect()) == want


def test_boxes_of_all_sizes_meet_few_points_in_vain(spark):
    rng = random.Random(11)
    boxes = []
    for n in range(300):
        wide, high = rng.choice([(0.3, 0.2), (2.0, 1.0), (60.0, 30.0), (0.5, 20.0), (90.0, 0.4)])
        west, south = rng.uniform(-180, 180), rng.uniform(-90, 90 - high)
        east = west + wide
        boxes.append((n, west, south, east - 360 if east > 180 else east, south + high))
    points = [(n, rng.uniform(-180, 180), rng.uniform(-90, 90)) for n in range(6000)]
    frame = spark.createDataFrame(points, "p int, lon double, lat double")
    areas = spark.createDataFrame(boxes, "box_id int, west double, south double, east double, north double")
    want = sorted((p, b[0]) for p, lon, lat in points for b in boxes if contains(b[1:], lon, lat))
    assert sorted((r.p, r.box_id) for r in within_bounds(frame, areas, salts=2).collect()) == want
    assert box_candidates(frame, areas, salts=2).count() <= 4 * len(want)
    most = box_cells(areas).groupBy("box_id").count().agg(F.max("count")).first()[0]
    assert most <= 100
    assert within_bounds(frame, areas.limit(0)).count() == 0


def test_cells_of_many_boxes_are_never_broadcast(spark):
    # The planner takes 2000 boxes for a small table, but they have 16 lanes of cells each.
    n = F.col("id")
    areas = spark.range(2000).select(
        n.alias("box_id"), (n % 300 - 170.0).alias("west"), (n % 100 - 80.0).alias("south"), (n % 300 - 169.0).alias("east"), (n % 100 - 79.5).alias("north")
    )
    points = spark.range(50).select(n.alias("p"), (n * 7 % 300 - 169.5).alias("lon"), (n * 3 % 100 - 79.75).alias("lat"))
    pairs = within_bounds(points, areas)
    assert "BroadcastHashJoin" not in pairs._jdf.queryExecution().executedPlan().toString()
    held = areas.crossJoin(points).filter("lon between west and east and lat between south and north")
    assert sorted((r.p, r.box_id) for r in pairs.collect()) == sorted((r.p, r.box_id) for r in held.collect())


def ford(**members) -> dict:
    """A well-formed place of this test's own; a member given as None is left out."""
    base = {
        "osm_type": "node", "osm_id": "731", "display_name": "Mill at the ford", "licence": "Valley survey",
        "lon": "-149.5", "lat": "-33.25", "boundingbox": ["-33.5", "-33.125", "-150", "-149"],
    }
    return {k: v for k, v in {**base, **members}.items() if v is not None}


#: For each rule of a place, members that break it.
BROKEN_PLACES = {
    "invalid_source": [
        {"osm_type": None}, {"osm_id": None}, {"osm_type": "street"}, {"osm_id": "7a"}, {"osm_id": ""},
        {"osm_id": "9" * 65}, {"osm_id": 1.5}, {"osm_type": None, "osm_id": None, "place_id": "x"},
    ],
    "invalid_coordinate": [
        {"lat": "90.5"}, {"lon": "-181"}, {"lat": None}, {"lon": "east"}, {"lon": "-149.5d"}, {"lat": " 3 "},
        {"lat": "3.0f"}, {"lat": "0x3"}, {"lon": "Infinity"}, {"lon": [1]},
    ],
    "invalid_bounds": [
        {"boundingbox": ["-33", "-34", "-150", "-149"]}, {"boundingbox": ["-34", "-33", "-149", "-150"]},
        {"boundingbox": ["-34", "-33", "-150"]}, {"boundingbox": "all"}, {"boundingbox": [1, 2, 3, "4d"]},
    ],
    "invalid_credit": [{"licence": None}, {"licence": "a<b"}, {"licence": 3}, {"licence": ""}],
    "invalid_label": [{"display_name": None}, {"display_name": ["Mill"]}, {"display_name": " \t"}],
}


def test_places_that_fit(spark):
    responses = bodies(
        spark,
        plain=[ford()],
        numbers=[ford(lat=12, lon=0.5, osm_id=31, boundingbox=None)],
        powers=[ford(lat="1.5e1", lon=".5", boundingbox=None)],
        scoped=[ford(osm_type=None, osm_id=None, place_id=640)],
        two=[ford(osm_type="relation"), ford(osm_id="0012")],
        none=[],
    )
    places, refused = decode_places(responses, 2, "places")
    rows = {(r.response_id, r.ordinal): r for r in places.collect()}
    assert reasons(refused) == {}
    assert {k: r.source_id for k, r in rows.items()} == {
        ("plain", 0): "node/731", ("numbers", 0): "node/31", ("powers", 0): "node/731",
        ("scoped", 0): "place/640", ("two", 0): "relation/731", ("two", 1): "node/0012",
    }
    first = rows["plain", 0]
    assert (first.lon, first.lat, first.label, first.credit) == (-149.5, -33.25, "Mill at the ford", "Valley survey")
    assert tuple(first.bounds) == (-150.0, -33.5, -149.0, -33.125)
    assert (rows["numbers", 0].lon, rows["numbers", 0].lat, rows["numbers", 0].bounds) == (0.5, 12.0, None)
    assert (rows["powers", 0].lon, rows["powers", 0].lat) == (0.5, 15.0)


def test_places_that_break_a_rule(spark):
    cases = {f"{rule}-{n}": [ford(**c)] for rule, all in BROKEN_PLACES.items() for n, c in enumerate(all)}
    places, refused = decode_places(bodies(spark, **cases), 2, "places")
    assert places.count() == 0
    assert reasons(refused) == {name: name.split("-")[0] for name in cases}


def test_place_responses_are_one_value(spark):
    whole = json.dumps([ford()])
    responses = bodies(
        spark, tail=whole + " x", second=whole + "[]", comma=whole + ",", closed=whole + '] , ["', cut=whole[:-1],
        object=ford(), three=[ford()] * 3, later=[ford(), {}], blank="", spaced=f" {whole}\n",
    )
    places, refused = decode_places(responses, 2, "places")
    assert [r.response_id for r in places.collect()] == ["spaced"]
    assert reasons(refused) == {
        **dict.fromkeys(("tail", "second", "comma", "closed", "cut", "object", "blank"), "invalid_response"),
        "three": "over_limit", "later": "invalid_source",
    }
    for limit in (0, 41):
        with pytest.raises(Refused):
            decode_places(responses, limit, "places")


def test_reverse_places(spark):
    responses = bodies(
        spark, found=ford(), sea={"error": "Unable to geocode"}, busy={"error": "Busy"},
        more={"error": "Unable to geocode", "code": 1}, listed=[ford()], tail=json.dumps(ford()) + "}",
    )
    places, refused = decode_places(responses, 1, "places", reverse=True)
    assert [r.response_id for r in places.collect()] == ["found"]
    assert set(reasons(refused)) == {"busy", "more", "listed", "tail"}


def test_features(spark):
    feature = {
        "type": "Feature", "id": "poi.1", "place_name": "Café", "center": [1, 2],
        "geometry": {"type": "Point", "coordinates": [1.5, 2]}, "bbox": [170, -1, -170, 1],
    }

    def response(features, **kw):
        return {"type": "FeatureCollection", "attribution": "<a>c</a>", "features": features, **kw}

    def change(**kw):
        return response([{**feature, **kw}])

    responses = bodies(
        spark, good=response([feature]), none=response([]), credit=response([feature], attribution="<a>d</a>"),
        many=response([feature] * 3), type=change(type="Thing"),
        line=change(geometry={"type": "LineString", "coordinates": [[1, 2], [3, 4]]}),
        point=change(geometry={"type": "Point", "coordinates": ["1", 2]}),
        three=change(geometry={"type": "Point", "coordinates": [1, 2, 3]}),
        center=change(center=[1]), box=change(bbox=[1, 2, 3]), id=change(id=7), name=change(place_name=None),
    )
    features, refused = decode_features(responses, 2, "features", "<a>c</a>", "© c", "https://c.example/x")
    rows = features.collect()
    assert [(r.response_id, r.source_id, r.lon, r.lat, r.credit) for r in rows] == [
        ("good", "poi.1", 1.5, 2.0, "© c")
    ]
    assert (rows[0].bounds.west, rows[0].bounds.east) == (170.0, -170.0)
    assert reasons(refused) == {
        "credit": "invalid_credit", "many": "over_limit", "type": "not_a_feature", "line": "not_a_point",
        "point": "invalid_coordinate", "three": "invalid_coordinate", "center": "invalid_center",
        "box": "invalid_bounds", "id": "invalid_source", "name": "invalid_label",
    }


def test_credits():
    assert check_credit("© c", "https://c.example/x") == ("© c", "https://c.example/x")
    for text, link in (("", None), ("a<b", None), ("a", "ftp://c"), ("a", "https://u@c/"), ("a", "https://c/?q")):
        with pytest.raises(Refused):
            check_credit(text, link)


def test_routes(spark):
    route = {"distance": 10.5, "duration": 3, "geometry": {"type": "LineString", "coordinates": [[1, 2], [3, 4.5]]}}

    def ok(*routes):
        return {"code": "Ok", "routes": list(routes)}

    def change(**kw):
        return ok({**route, **kw})

    def line(*points):
        return change(geometry={"type": "LineString", "coordinates": list(points)})

    good = {"good": ok(route), "two": ok(route, route), "empty": ok(), "busy": {"code": "NoRoute"},
            "negative": change(distance=-1), "text": change(distance="10"), "short": line([1, 2]),
            "range": line([1, 2], [1, 91]), "triple": line([1, 2], [1, 2, 3]), "long": line(*[[1, 2]] * 8193),
            "shape": change(geometry={"type": "Point", "coordinates": [[1, 2], [3, 4]]}),
            "nocode": {"routes": [route]}, "tail": json.dumps(ok(route)) + " x"}
    failed = {"none": {"code": "NoRoute"}, "far": {"code": "NoSegment"}, "big": {"code": "TooBig"},
              "odd": ok(route), "why": {"code": "Broken"}}
    rows = [(k, v if isinstance(v, str) else json.dumps(v), flag) for part, flag in ((good, True), (failed, False)) for k, v in part.items()]
    routes, refused = decode_routes(
        spark.createDataFrame(rows, "response_id string, body string, success boolean")
    )
    out = routes.collect()
    assert [(r.response_id, r.metres, r.seconds) for r in out] == [("good", 10.5, 3.0)]
    assert [(p.lon, p.lat) for p in out[0].line] == [(1.0, 2.0), (3.0, 4.5)]
    assert reasons(refused) == {
        "two": "too_large", "empty": "invalid_response", "busy": "invalid_response",
        "negative": "invalid_quantity", "text": "invalid_quantity", "short": "invalid_geometry",
        "range": "invalid_geometry", "triple": "invalid_geometry", "long": "too_large",
        "shape": "invalid_geometry", "nocode": "invalid_response", "tail": "invalid_response",
        "big": "too_large", "odd": "invalid_response", "why": "rejected",
    }


def test_lines_keep_order_and_bounds(spark):
    points = [("a", n, float(n), 0.0) for n in (3, 1, 2)] + [("one", 1, 0.0, 0.0), ("bad", 1, 0.0, 0.0), ("bad", 2, 0.0, 91.0)]
    points += [("hot", n, 0.0, 0.0) for n in range(9000)]
    frame = spark.createDataFrame(points, "route_id string, seq int, lon double, lat double").repartition(5)
    routes, refused = assemble_routes(frame)
    assert [json.loads(r.geojson) for r in routes.collect()] == [
        {"type": "LineString", "coordinates": [[1.0, 0.0], [2.0, 0.0], [3.0, 0.0]]}
    ]
    assert {r.route_id: r.reject_reason for r in refused.collect()} == {
        "one": "too_few_points", "bad": "invalid_coordinate", "hot": "too_many_points",
    }
    with pytest.raises(Refused):
        assemble_routes(frame, mode="flying")


def test_lines_of_several_parts(spark):
    points = [("m", part, n, float(part), float(n)) for part in (2, 1) for n in (1, 0)]
    points += [("s", 1, n, 0.0, float(n)) for n in (0, 1)]
    points += [("short", 1, 0, 0.0, 0.0), ("short", 2, 0, 0.0, 0.0), ("short", 2, 1, 0.0, 0.0)]
    points += [("big", n // 5000, n, 0.0, 0.0) for n in range(9000)]
    frame = spark.createDataFrame(points, "route_id string, part int, seq int, lon double, lat double")
    routes, refused = assemble_routes(frame)
    assert {r.route_id: json.loads(r.geojson) for r in routes.collect()} == {
        "m": {"type": "MultiLineString", "coordinates": [[[1.0, 0.0], [1.0, 1.0]], [[2.0, 0.0], [2.0, 1.0]]]},
        "s": {"type": "LineString", "coordinates": [[0.0, 0.0], [0.0, 1.0]]},
    }
    assert {r.route_id: r.reject_reason for r in refused.collect()} == {
        "short": "too_few_points", "big": "too_many_points",
    }


def test_points_of_resources(spark):
    full = {"title": '"T"', "longitude": "1.5", "latitude": "2"}
    rows = [("k", "ok", full), ("k", "hidden", {"title": '"T"', "latitude": "2"}), ("k", "null", {**full, "title": "null"}),
            ("k", "far", {**full, "latitude": "91"}), ("k", "text", {**full, "longitude": '"1"'}),
            ("k", "long", {**full, "title": '"' + "x" * 4097 + '"'}), ("k", "twice", full), ("k", "twice", full)]
    view = spark.createDataFrame(rows, "kind string, id string, fields map<string,string>")
    points, repeated = resource_points(view)
    assert [(r.id, r.title, r.lon, r.lat) for r in points.collect()] == [("ok", "T", 1.5, 2.0)]
    assert [(r.id, r.copies) for r in repeated.collect()] == [("twice", 2)]
