"""Geo queries over customers, nations and orders."""

from __future__ import annotations

from pyspark.sql import functions as F

from revtide.operators.geo import (
    admit_coordinates,
    assemble_routes,
    decode_features,
    decode_places,
    decode_routes,
    resource_points,
    within_bounds,
)
from revtide.operators.retrieval import authorized_view
from revtide.plans.registry import query
from revtide.plans.tables import POINTS_SQL, customer_points, table, text


@query(
    "coordinates_admitted",
    f"""SELECT c_custkey, CASE WHEN m = 1 THEN 'not_finite' WHEN m = 2 THEN 'longitude_out_of_range'
      WHEN m = 3 THEN 'latitude_out_of_range' WHEN m = 4 THEN 'metres_invalid' END AS reject_reason
    FROM (SELECT *, c_custkey % 17 AS m FROM ({POINTS_SQL}))""",
)
def coordinates_admitted(spark, sf_dir):
    m = F.col("c_custkey") % 17
    points = customer_points(spark, sf_dir).select(
        "c_custkey",
        F.when(m == 1, float("nan")).when(m == 2, 180.5).otherwise(F.col("lon")).alias("lon"),
        F.when(m == 3, -90.25).otherwise(F.col("lat")).alias("lat"),
        F.when(m == 4, -1.0).otherwise(F.col("lat") + 90).alias("metres"),
    )
    return admit_coordinates(points, "metres").select("c_custkey", "reject_reason")


@query(
    "points_in_boxes",
    f"""WITH b AS (SELECT n_nationkey AS box_id, n_nationkey * 53 % 360 - 180 AS west FROM nation),
    x AS (SELECT box_id, west, CASE WHEN west + 90 > 180 THEN west + 90 - 360 ELSE west + 90 END
          AS east FROM b)
    SELECT c_custkey, box_id FROM ({POINTS_SQL}), x
    WHERE lat BETWEEN -45 AND 45
      AND CASE WHEN west > east THEN lon >= west OR lon <= east
               ELSE lon BETWEEN west AND east END""",
)
def points_in_boxes(spark, sf_dir):
    """Every customer in every nation's box; some boxes cross the antimeridian."""
    west = F.col("n_nationkey") * 53 % 360 - 180
    boxes = table(spark, sf_dir, "nation").select(
        F.col("n_nationkey").alias("box_id"),
        west.cast("double").alias("west"),
        F.lit(-45.0).alias("south"),
        F.when(west + 90 > 180, west + 90 - 360).otherwise(west + 90).cast("double").alias("east"),
        F.lit(45.0).alias("north"),
    )
    points = customer_points(spark, sf_dir).select("c_custkey", "lon", "lat")
    return within_bounds(points, boxes).select("c_custkey", "box_id")


@query(
    "points_in_boxes_of_all_sizes",
    f"""WITH b AS (SELECT s_suppkey AS box_id, (s_suppkey * 6007 % 36000) / 100.0::DOUBLE - 180.0::DOUBLE AS west,
        (s_suppkey * 4019 % 13000) / 100.0::DOUBLE - 90.0::DOUBLE AS south, s_suppkey % 20 = 7 AS large FROM supplier),
    e AS (SELECT *, west + CASE WHEN large THEN 70.0::DOUBLE ELSE 0.75::DOUBLE END AS reach FROM b),
    x AS (SELECT box_id, west, south, CASE WHEN reach > 180 THEN reach - 360 ELSE reach END AS east,
        south + CASE WHEN large THEN 40.0::DOUBLE ELSE 0.5::DOUBLE END AS north FROM e)
    SELECT c_custkey, box_id FROM ({POINTS_SQL}), x
    WHERE lat BETWEEN south AND north
      AND CASE WHEN west > east THEN lon >= west OR lon <= east
               ELSE lon BETWEEN west AND east END""",
)
def points_in_boxes_of_all_sizes(spark, sf_dir):
    """Customers in one box for each supplier, most of a city's size and some of a continent's."""
    k = F.col("s_suppkey")
    large = k % 20 == 7
    boxes = (
        table(spark, sf_dir, "supplier")
        .select(k.alias("box_id"), large.alias("large"), (k * 6007 % 36000 / 100.0 - 180.0).alias("west"), (k * 4019 % 13000 / 100.0 - 90.0).alias("south"))
        .withColumn("reach", F.col("west") + F.when(F.col("large"), 70.0).otherwise(0.75))
        .select(
            "box_id",
            "west",
            "south",
            F.when(F.col("reach") > 180, F.col("reach") - 360).otherwise(F.col("reach")).alias("east"),
            (F.col("south") + F.when(F.col("large"), 40.0).otherwise(0.5)).alias("north"),
        )
    )
    points = customer_points(spark, sf_dir).select("c_custkey", "lon", "lat")
    return within_bounds(points, boxes).select("c_custkey", "box_id")


def _place_bodies(spark, sf_dir):
    """A response of zero to three places per customer; some places are out of range."""
    k = F.col("c_custkey")
    kinds = F.array(F.lit("node"), F.lit("way"), F.lit("relation"))

    def place(n):
        return F.struct(
            F.get(kinds, (k % 3).cast("int")).alias("osm_type"),
            text(k * 10 + n).alias("osm_id"),
            F.when(k % 29 == 0, F.lit("95.5")).otherwise(text("lat")).alias("lat"),
            F.col("lon").alias("lon"),
            F.concat(F.col("c_name"), F.lit(" #"), text(n)).alias("display_name"),
            F.lit("Data © contributors").alias("licence"),
        )

    places = F.filter(F.array(*[place(F.lit(n)) for n in range(3)]), lambda p, n: n < k % 4)
    return customer_points(spark, sf_dir).select(
        k.alias("response_id"), F.to_json(places).alias("body")
    )


@query(
    "places_decoded",
    f"""SELECT c_custkey AS response_id, n AS ordinal,
      (['node', 'way', 'relation'])[c_custkey % 3 + 1] || '/' || CAST(c_custkey * 10 + n AS VARCHAR)
        AS source_id, c_name || ' #' || CAST(n AS VARCHAR) AS label, lon, lat
    FROM ({POINTS_SQL}), (SELECT unnest([0, 1]) AS n)
    WHERE c_custkey % 4 IN (1, 2) AND n < c_custkey % 4 AND c_custkey % 29 <> 0""",
)
def places_decoded(spark, sf_dir):
    places, _ = decode_places(_place_bodies(spark, sf_dir), 2, "places")
    return places.select("response_id", "ordinal", "source_id", "label", "lon", "lat")


@query(
    "places_refused",
    """SELECT c_custkey AS response_id, CASE WHEN c_custkey % 4 = 3 THEN 'over_limit'
      ELSE 'invalid_coordinate' END AS reject_reason
    FROM customer WHERE c_custkey % 4 = 3 OR (c_custkey % 29 = 0 AND c_custkey % 4 <> 0)""",
)
def places_refused(spark, sf_dir):
    """More places than asked for are refused as a whole, not cut."""
    return decode_places(_place_bodies(spark, sf_dir), 2, "places")[1]


NATIVE_CREDIT = '<a href="https://example.org/">© Example</a>'


def _feature_bodies(spark, sf_dir):
    k = F.col("c_custkey")
    position = F.array("lon", F.when(k % 23 == 0, F.lit(-91.0)).otherwise(F.col("lat")))
    feature = F.struct(
        F.lit("Feature").alias("type"),
        F.concat(F.lit("poi."), text(k)).alias("id"),
        F.col("c_name").alias("place_name"),
        F.struct(F.lit("Point").alias("type"), position.alias("coordinates")).alias("geometry"),
        F.when(k % 5 == 0, F.array(F.lit(-1.0), F.lit(-2.0), F.lit(1.0), F.lit(2.0))).alias("bbox"),
    )
    body = F.struct(
        F.lit("FeatureCollection").alias("type"),
        F.when(k % 19 == 0, "other").otherwise(NATIVE_CREDIT).alias("attribution"),
        F.array(feature).alias("features"),
    )
    return customer_points(spark, sf_dir).select(
        k.alias("response_id"), F.to_json(body).alias("body")
    )


def _features(spark, sf_dir):
    return decode_features(
        _feature_bodies(spark, sf_dir), 1, "features", NATIVE_CREDIT, "© Example",
        "https://example.org/credit",
    )


@query(
    "features_decoded",
    f"""SELECT c_custkey AS response_id, 'poi.' || CAST(c_custkey AS VARCHAR) AS source_id,
      c_name AS label, lon, lat, CASE WHEN c_custkey % 5 = 0 THEN 2.0::DOUBLE END AS north,
      '© Example' AS credit
    FROM ({POINTS_SQL}) WHERE c_custkey % 19 <> 0 AND c_custkey % 23 <> 0""",
)
def features_decoded(spark, sf_dir):
    features, _ = _features(spark, sf_dir)
    return features.select(
        "response_id", "source_id", "label", "lon", "lat", F.col("bounds.north").alias("north"),
        "credit",
    )


@query(
    "features_refused",
    """SELECT c_custkey AS response_id, CASE WHEN c_custkey % 19 = 0 THEN 'invalid_credit'
      ELSE 'invalid_coordinate' END AS reject_reason
    FROM customer WHERE c_custkey % 19 = 0 OR c_custkey % 23 = 0""",
)
def features_refused(spark, sf_dir):
    return _features(spark, sf_dir)[1]


def _route_bodies(spark, sf_dir):
    """One routing response per order, most of them good."""
    k = F.col("o_orderkey")
    m = k % 11
    first = F.array((k % 361 - 180).cast("double"), (k % 181 - 90).cast("double"))
    second = F.array((k * 7 % 361 - 180).cast("double"), F.when(m == 5, 90.5).otherwise(10.0))
    route = F.struct(
        F.when(m == 4, -1.0).otherwise(F.col("o_totalprice")).alias("distance"),
        (k % 5000 / 4).alias("duration"),
        F.struct(
            F.lit("LineString").alias("type"), F.array(first, second).alias("coordinates")
        ).alias("geometry"),
    )
    code = (
        F.when(m == 1, "NoRoute").when(m == 2, "TooBig").when(m == 3, "Busy").otherwise("Ok")
    )
    routes = F.when(m == 6, F.array(route, route)).otherwise(F.array(route))
    return table(spark, sf_dir, "orders").select(
        k.alias("response_id"),
        (~m.isin(1, 2, 3)).alias("success"),
        F.to_json(F.struct(code.alias("code"), routes.alias("routes"))).alias("body"),
    )


@query(
    "routes_decoded",
    """SELECT o_orderkey AS response_id, o_totalprice AS metres,
      (o_orderkey % 5000) / 4.0::DOUBLE AS seconds,
      CAST(o_orderkey % 361 - 180 AS DOUBLE) AS first_lon, 10.0::DOUBLE AS last_lat
    FROM orders WHERE o_orderkey % 11 NOT IN (1, 2, 3, 4, 5, 6)""",
)
def routes_decoded(spark, sf_dir):
    routes, _ = decode_routes(_route_bodies(spark, sf_dir))
    line = F.col("line")
    return routes.select(
        "response_id", "metres", "seconds", line[0]["lon"].alias("first_lon"),
        line[1]["lat"].alias("last_lat"),
    )


@query(
    "routes_refused",
    """SELECT o_orderkey AS response_id, CASE o_orderkey % 11 WHEN 2 THEN 'too_large'
      WHEN 3 THEN 'rejected' WHEN 4 THEN 'invalid_quantity' WHEN 5 THEN 'invalid_geometry'
      ELSE 'too_large' END AS reject_reason
    FROM orders WHERE o_orderkey % 11 IN (2, 3, 4, 5, 6)""",
)
def routes_refused(spark, sf_dir):
    """"No route" is an answer and no refusal."""
    return decode_routes(_route_bodies(spark, sf_dir))[1]


def _waypoints(spark, sf_dir):
    """Orders of a customer in key order; busy customers exceed a request's 25 points."""
    k = F.col("o_orderkey")
    return table(spark, sf_dir, "orders").select(
        F.col("o_custkey").alias("route_id"),
        k.alias("seq"),
        (k % 360 - 180).cast("double").alias("lon"),
        F.when(k % 997 == 5, 91).otherwise(k * 3 % 180 - 90).cast("double").alias("lat"),
    )


_WAYPOINTS_SQL = """
  SELECT o_custkey AS route_id, count(*) AS points,
    count(*) FILTER (o_orderkey % 997 = 5) AS bad,
    '{"type":"LineString","coordinates":[' || string_agg(
      '[' || CAST(CAST(o_orderkey % 360 - 180 AS DOUBLE) AS VARCHAR) || ','
          || CAST(CAST(o_orderkey * 3 % 180 - 90 AS DOUBLE) AS VARCHAR) || ']', ','
      ORDER BY o_orderkey) || ']}' AS geojson
  FROM orders GROUP BY o_custkey
"""


@query(
    "route_lines",
    f"""SELECT route_id, points, geojson, 'driving' AS mode FROM ({_WAYPOINTS_SQL})
    WHERE points BETWEEN 2 AND 25 AND bad = 0""",
)
def route_lines(spark, sf_dir):
    return assemble_routes(_waypoints(spark, sf_dir), mode="driving")[0]


@query(
    "routes_unfit",
    f"""SELECT route_id, points, CASE WHEN points > 25 THEN 'too_many_points'
      WHEN bad > 0 THEN 'invalid_coordinate' ELSE 'too_few_points' END AS reject_reason
    FROM ({_WAYPOINTS_SQL}) WHERE points > 25 OR bad > 0 OR points < 2""",
)
def routes_unfit(spark, sf_dir):
    return assemble_routes(_waypoints(spark, sf_dir), mode="driving")[1]


@query(
    "resource_points",
    f"""SELECT CAST(c_custkey AS VARCHAR) AS id, c_name AS title, lon, lat FROM ({POINTS_SQL})
    WHERE c_custkey % 9 NOT IN (1, 2, 3, 4)""",
)
def points_of_resources(spark, sf_dir):
    """Customers on a map: hidden, null, deleted and impossible places stay away."""
    k = F.col("c_custkey")
    quoted = F.concat(F.lit('"'), F.col("c_name"), F.lit('"'))
    rows = customer_points(spark, sf_dir).select(
        F.lit("customer").alias("kind"),
        text(k).alias("id"),
        F.lit(1).alias("revision"),
        (k % 9 == 1).alias("tombstone"),
        k.alias("number"),
        F.create_map(
            F.lit("title"), F.when(k % 9 == 2, F.lit("null")).otherwise(quoted),
            F.lit("longitude"), text("lon"),
            F.lit("latitude"), F.when(k % 9 == 3, F.lit("-90.5")).otherwise(text("lat")),
        ).alias("fields"),
    )
    always = lambda actor: F.lit(True)
    view = authorized_view(
        rows,
        always,
        {"title": always, "latitude": always, "longitude": lambda actor: F.col("number") % 9 != 4},
        "r1",
    )
    points, _ = resource_points(view)
    return points.select("id", "title", "lon", "lat")
