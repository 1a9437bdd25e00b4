"""Geo tables: coordinates, boxes, provider responses, routes and resource points.

Longitude comes first. A box whose west exceeds its east crosses the antimeridian.
Responses are decoded with explicit schemas; a bad response is refused as a whole.
"""

from __future__ import annotations

from collections.abc import Callable
from urllib.parse import urlsplit

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from revtide.functions.vectors import is_finite
from revtide.operators.joins import SALTS, every_lane, lanes
from revtide.verdicts import Refused, first_reason

# Response and geometry limits.
RESPONSE_BYTES = 1_048_576
MAX_PLACES = 40
MAX_FEATURES = 10
LABEL_BYTES = 4096
CREDIT_BYTES = 1024
LINK_BYTES = 2048
NATIVE_CREDIT_BYTES = 8192
PROVIDER_BYTES = 128
TITLE_BYTES = 4096
MAX_VERTICES = 8192
MAX_WAYPOINTS = 25
MODES = ("driving", "cycling", "walking")
PLACES_LINK = "https://www.openstreetmap.org/copyright"
NO_COVERAGE = "Unable to geocode"

CONTROL = r"[\x00-\x1f\x7f-\x9f]"

#: Grids halve their cells from level to level; boxes use every ``LEVEL_STEP``-th, up to ``MAX_LEVEL``.
MAX_LEVEL, LEVEL_STEP = 20, 2


def valid_coordinate(lon: Column, lat: Column) -> Column:
    """True for a finite position in range; never NULL."""
    return F.coalesce(lon.between(-180, 180) & lat.between(-90, 90), F.lit(False))


def valid_quantity(value: Column) -> Column:
    """True for finite, non-negative metres or seconds; never NULL."""
    return F.coalesce((value >= 0) & is_finite(value), F.lit(False))


def admit_coordinates(df: DataFrame, *quantities: str, lon: str = "lon", lat: str = "lat"):
    """Add ``reject_reason`` for ``lon``, ``lat`` and any metre or second columns."""
    rules = [
        (~F.coalesce(is_finite(F.col(lon)) & is_finite(F.col(lat)), F.lit(False)), "not_finite"),
        (~F.col(lon).between(-180, 180), "longitude_out_of_range"),
        (~F.col(lat).between(-90, 90), "latitude_out_of_range"),
    ]
    rules += [(~valid_quantity(F.col(q)), f"{q}_invalid") for q in quantities]
    return df.withColumn("reject_reason", first_reason(*rules))


def valid_box(west: Column, south: Column, east: Column, north: Column) -> Column:
    return valid_coordinate(west, south) & valid_coordinate(east, north) & (south <= north)


def box_contains(west: Column, south: Column, east: Column, north: Column, lon: Column, lat: Column):
    """Inclusive test with the antimeridian rule."""
    wraps = west > east
    across = (lon >= west) | (lon <= east)
    return lat.between(south, north) & F.when(wraps, across).otherwise(lon.between(west, east))


def _cell(value: Column, origin: float, span: float, level: Column) -> Column:
    """Number of the cell of a grid of 2^level cells over ``span`` degrees."""
    return F.floor((value + origin) / F.lit(span) * F.pow(F.lit(2.0), level)).cast("long")


def _level(extent: Column, span: float) -> Column:
    """The coarsest grid whose cells are at most half of ``extent``, an eighth at least."""
    needed = F.ceil(F.log2(F.lit(2.0 * span) / F.greatest(extent, F.lit(span / 2**MAX_LEVEL))) / LEVEL_STEP) * LEVEL_STEP
    return F.least(needed, F.lit(MAX_LEVEL)).cast("int")


def _levelled(boxes: DataFrame) -> DataFrame:
    """Valid boxes with the grids ``_lx, _ly`` of their size."""
    w, s, e, n = (F.col(c) for c in ("west", "south", "east", "north"))
    return (
        boxes.filter(valid_box(w, s, e, n))
        .withColumn("_lx", _level(F.when(w > e, F.lit(360.0) - (w - e)).otherwise(e - w), 360.0))
        .withColumn("_ly", _level(n - s, 180.0))
    )


def box_cells(boxes: DataFrame) -> DataFrame:
    """Valid boxes with the cells ``_lx, _ly, _x, _y`` that cover them, each on grids of its own size: at most ten by ten."""
    w, s, e, n = (F.col(c) for c in ("west", "south", "east", "north"))
    wraps = w > e
    levelled = _levelled(boxes)
    first, last = _cell(w, 180.0, 360.0, F.col("_lx")), _cell(e, 180.0, 360.0, F.col("_lx"))
    edge = _cell(F.lit(180.0), 180.0, 360.0, F.col("_lx"))
    lons = F.when(wraps, F.concat(F.sequence(first, edge), F.sequence(F.lit(0).cast("long"), last))).otherwise(
        F.sequence(first, F.when(wraps, first).otherwise(last))
    )
    lats = F.sequence(_cell(s, 90.0, 180.0, F.col("_ly")), _cell(n, 90.0, 180.0, F.col("_ly")))
    # A box that wraps and meets itself in one cell would list that cell twice.
    return levelled.withColumn("_x", F.explode(F.array_distinct(lons))).withColumn("_y", F.explode(lats))


def box_candidates(points: DataFrame, boxes: DataFrame, salts: int = SALTS) -> DataFrame:
    """(point, box) pairs that share a cell, before the exact test.

    Boxes may be of all sizes: each is put on a grid of its own size, and a point looks up one cell for every
    pair of grids that some box uses, 121 at most. Points of a cell are spread over ``salts`` lanes so that one crowded
    cell is not one task. The join is a merge join by hint: a box has many cells in every lane, which the planner's guess
    of the table's size leaves out, so that it would send millions of rows to the driver.
    """
    cells = box_cells(boxes).withColumn("_lane", every_lane(salts))
    used = _levelled(boxes).agg(F.collect_set(F.struct("_lx", "_ly")).alias("levels")).scalar()
    located = (
        points.filter(valid_coordinate(F.col("lon"), F.col("lat")))
        .withColumn("_lane", lanes(*points.columns, salts=salts))
        .withColumn("_level", F.explode(used))
        .withColumns({"_lx": F.col("_level._lx"), "_ly": F.col("_level._ly")})
        .withColumns({"_x": _cell(F.col("lon"), 180.0, 360.0, F.col("_lx")), "_y": _cell(F.col("lat"), 90.0, 180.0, F.col("_ly"))})
        .drop("_level")
    )
    keys = ["_lx", "_ly", "_x", "_y", "_lane"]
    return located.join(cells.hint("merge"), keys).drop(*keys)


def within_bounds(points: DataFrame, boxes: DataFrame, salts: int = SALTS) -> DataFrame:
    """Every (point, box) pair where the valid box contains the valid point.

    ``points`` have ``lon, lat``; ``boxes`` have ``box_id, west, south, east, north``. Both meet on equal cells of
    grids that fit the boxes' sizes, then the exact test decides.
    """
    w, s, e, n = (F.col(c) for c in ("west", "south", "east", "north"))
    return box_candidates(points, boxes, salts).filter(box_contains(w, s, e, n, F.col("lon"), F.col("lat")))


def _plain(text: Column, limit: int) -> Column:
    """True for non-blank text of at most ``limit`` bytes without controls; never NULL."""
    fits = (F.octet_length(text) <= limit) & (F.trim(text) != "") & ~text.rlike(CONTROL)
    return F.coalesce(fits, F.lit(False))


def _check_plain(text: str, limit: int) -> str:
    if not text.strip() or len(text.encode()) > limit or not text.isprintable():
        raise Refused("text must be plain and within its limit")
    return text


def check_credit(text: str, link: str | None) -> tuple[str, str | None]:
    """Approved plain credit text and an optional bare http(s) link."""
    _check_plain(text, CREDIT_BYTES)
    if "<" in text or ">" in text:
        raise Refused("credit is plain text")
    if link is not None:
        parts = urlsplit(link)
        bare = not (parts.username or parts.password or parts.query)
        if len(link) > LINK_BYTES or parts.scheme not in ("http", "https") or not parts.hostname:
            raise Refused("credit link must be http or https")
        if not bare:
            raise Refused("credit link carries user info or a query")
    return text, link


def _let(value: Column, build: Callable[[Column], Column]) -> Column:
    """``build(value)`` with ``value`` evaluated once, however often it is used."""
    return F.transform(F.array(value), build)[0]


def _text(value: Column, path: str) -> Column:
    """A JSON string at ``path``, else NULL."""
    raw = F.variant_get(value, path, "variant")
    is_text = F.schema_of_variant(raw) == "STRING"
    return F.when(is_text, F.try_variant_get(value, path, "string"))


def _number(value: Column, path: str) -> Column:
    """A JSON number at ``path``, else NULL."""
    raw = F.variant_get(value, path, "variant")
    numeric = F.substring(F.schema_of_variant(raw), 1, 6).isin(
        "BIGINT", "DOUBLE", "FLOAT", "DECIMA"
    )
    return F.when(numeric, F.try_variant_get(value, path, "double"))


DECIMAL = r"^[+-]?([0-9]+([.][0-9]*)?|[.][0-9]+)([eE][+-]?[0-9]+)?$"


def _lenient_number(value: Column, path: str) -> Column:
    """A finite number given as JSON number or as text in plain decimal grammar."""
    text = _text(value, path)
    decimal = F.when(text.rlike(DECIMAL), text.try_cast("double"))
    parsed = F.coalesce(_number(value, path), decimal)
    return _let(parsed, lambda x: F.when(is_finite(x), x))


def _length(value: Column, path: str) -> Column:
    """Length of a JSON array at ``path``, else NULL."""
    items = F.try_variant_get(value, path, "array<variant>")
    return F.when(items.isNotNull(), F.size(items))


def _items(value: Column, path: str) -> Column:
    return F.try_variant_get(value, path, "array<variant>")


def _present(value: Column, path: str) -> Column:
    return F.variant_get(value, path, "variant").isNotNull()


def _decoded(df: DataFrame, kept: list[str], build: Callable[[Column], Column]) -> DataFrame:
    """``kept`` and ``_d = build(parsed body)``.

    The body is parsed once per row: the generator keeps later filters from being pushed
    below it, which would parse the text again for every use.
    """
    # A parser may stop after the first value. The digest behind the body, which no body can
    # hold, is read as the second of two values only if nothing else follows the first.
    mark = F.md5("body")
    pair = F.try_variant_get(
        F.try_parse_json(F.concat(F.lit("["), "body", F.lit(',"'), mark, F.lit('"]'))), "$", "array<variant>"
    )
    whole = _let(
        pair,
        lambda p: F.when(
            (F.size(p) == 2) & _text(F.get(p, F.lit(1)), "$").eqNullSafe(mark), F.get(p, F.lit(0))
        ),
    )
    parsed = F.transform(F.array(whole), build)
    return df.select(*kept, F.explode_outer(parsed).alias("_d"))


def _decode(
    df: DataFrame,
    id: str,
    judge: Callable[[Column], Column],
    rows: Callable[[Column], Column],
    item: Callable[[Column], Column],
) -> tuple[DataFrame, DataFrame]:
    """Decode each response in its own row: all of its items, or a reason.

    ``judge`` gives the response's own reason, ``rows`` its array of item variants and
    ``item`` a struct with a ``reason`` field. A response is bounded by its byte limit, so
    this needs no shuffle.
    """

    def build(v: Column) -> Column:
        return _let(
            F.struct(judge(v).alias("reason"), F.transform(rows(v), item).alias("items")), settle
        )

    def settle(d: Column) -> Column:
        bad = F.filter(d["items"], lambda i: i["reason"].isNotNull())
        return F.struct(
            F.coalesce(d["reason"], F.get(bad, F.lit(0))["reason"]).alias("reason"),
            d["items"].alias("items"),
        )

    decoded = _decoded(df, [id], build)
    refused = decoded.filter("_d.reason IS NOT NULL").select(
        id, F.col("_d.reason").alias("reject_reason")
    )
    good = (
        decoded.filter("_d.reason IS NULL")
        .select(id, F.posexplode("_d.items").alias("ordinal", "_i"))
        .select(id, "ordinal", "_i.*")
        .drop("reason")
    )
    return good, refused


def _native_id(value: Column, path: str) -> Column:
    text = _text(value, path)
    raw = F.variant_get(value, path, "variant")
    whole = F.schema_of_variant(raw).rlike(r"^(BIGINT|DECIMAL\(\d+,0\))$")
    number = F.when(whole, F.to_json(raw))
    return F.coalesce(
        F.when(text.rlike("^[0-9]{1,64}$"), text), F.when(number.rlike("^[0-9]+$"), number)
    )


def _place(provider: str):
    def build(v: Column) -> Column:
        kind = _text(v, "$.osm_type")
        has_kind, has_id = _present(v, "$.osm_type"), _present(v, "$.osm_id")
        referenced = F.when(
            kind.isin("node", "way", "relation"),
            F.concat(kind, F.lit("/"), _native_id(v, "$.osm_id")),
        )
        scoped = F.concat(F.lit("place/"), _native_id(v, "$.place_id"))
        box = _let(
            _items(v, "$.boundingbox"),
            lambda b: F.when(F.size(b) == 4, F.transform(b, lambda x: _lenient_number(x, "$"))),
        )
        read = F.struct(
            F.when(has_kind & has_id, referenced).when(~has_kind & ~has_id, scoped).alias("source"),
            _lenient_number(v, "$.lon").alias("lon"),
            _lenient_number(v, "$.lat").alias("lat"),
            _present(v, "$.boundingbox").alias("has_box"),
            box.alias("box"),
            _text(v, "$.display_name").alias("label"),
            _text(v, "$.licence").alias("licence"),
        )
        return _let(read, judge)

    def judge(r: Column) -> Column:
        # The provider lists a box as south, north, west, east and never lets it wrap.
        south, north, west, east = (F.get(r["box"], F.lit(i)) for i in range(4))
        box_ok = valid_box(west, south, east, north) & F.coalesce(west <= east, F.lit(False))
        credit_ok = _plain(r["licence"], CREDIT_BYTES) & ~F.coalesce(
            r["licence"].rlike("[<>]"), F.lit(True)
        )
        reason = first_reason(
            (r["source"].isNull(), "invalid_source"),
            (~valid_coordinate(r["lon"], r["lat"]), "invalid_coordinate"),
            (r["has_box"] & ~box_ok, "invalid_bounds"),
            (~credit_ok, "invalid_credit"),
            (~_plain(r["label"], LABEL_BYTES), "invalid_label"),
        )
        bounds = F.when(
            r["has_box"],
            F.struct(
                west.alias("west"), south.alias("south"), east.alias("east"), north.alias("north")
            ),
        )
        return F.struct(
            F.lit(provider).alias("provider"),
            r["source"].alias("source_id"),
            r["label"].alias("label"),
            r["lon"].alias("lon"),
            r["lat"].alias("lat"),
            bounds.alias("bounds"),
            r["licence"].alias("credit"),
            F.lit(PLACES_LINK).alias("credit_link"),
            reason.alias("reason"),
        )

    return build


def decode_places(
    df: DataFrame, limit: int, provider: str, id: str = "response_id", reverse: bool = False
) -> tuple[DataFrame, DataFrame]:
    """Geocoder responses (JSON text ``body``) -> (places, refused responses).

    A forward response is an array of at most ``limit`` places; more are refused, not cut.
    A reverse response is one place, or the provider's exact no-coverage object, which is
    an empty result.
    """
    if not 1 <= limit <= MAX_PLACES:
        raise Refused("limit outside 1..40")
    _check_plain(provider, PROVIDER_BYTES)
    too_large = (F.octet_length("body") > RESPONSE_BYTES, "too_large")

    def no_coverage(v: Column) -> Column:
        exact = (F.schema_of_variant(v) == "OBJECT<error: STRING>") & (
            _text(v, "$.error") == NO_COVERAGE
        )
        return F.coalesce(exact, F.lit(False))

    def judge_reverse(v: Column) -> Column:
        is_object = F.coalesce(F.schema_of_variant(v).startswith("OBJECT"), F.lit(False))
        return first_reason(
            too_large,
            (~is_object, "invalid_response"),
            (~no_coverage(v) & _present(v, "$.error"), "invalid_response"),
        )

    def judge_forward(v: Column) -> Column:
        count = _length(v, "$")
        return first_reason(
            too_large, (count.isNull(), "invalid_response"), (count > limit, "over_limit")
        )

    def one_row(v: Column) -> Column:
        return F.when(no_coverage(v), F.array().cast("array<variant>")).otherwise(F.array(v))

    if reverse:
        return _decode(df, id, judge_reverse, one_row, _place(provider))
    return _decode(df, id, judge_forward, lambda v: _items(v, "$"), _place(provider))


_NUMBER = r"(BIGINT|DOUBLE|FLOAT|DECIMAL\(\d+,\d+\))"


def _numbers(value: Column, path: str) -> Column:
    """A JSON array of numbers at ``path``, else NULL; text elements do not count."""
    raw = F.variant_get(value, path, "variant")
    strict = F.schema_of_variant(raw).rlike(f"^ARRAY<{_NUMBER}>$")
    return F.when(strict, F.try_variant_get(value, path, "array<double>"))


def _pair_ok(pair: Column) -> Column:
    """True for an array of exactly a valid longitude and latitude; never NULL."""
    return F.coalesce(F.size(pair) == 2, F.lit(False)) & valid_coordinate(
        F.get(pair, F.lit(0)), F.get(pair, F.lit(1))
    )


def _feature(provider: str, credit: str, link: str | None):
    def build(v: Column) -> Column:
        read = F.struct(
            _text(v, "$.type").alias("type"),
            _text(v, "$.geometry.type").alias("shape"),
            _numbers(v, "$.geometry.coordinates").alias("point"),
            _present(v, "$.center").alias("has_center"),
            _numbers(v, "$.center").alias("center"),
            _present(v, "$.bbox").alias("has_box"),
            _numbers(v, "$.bbox").alias("box"),
            _text(v, "$.id").alias("source"),
            _text(v, "$.place_name").alias("label"),
        )
        return _let(read, judge)

    def judge(r: Column) -> Column:
        west, south, east, north = (F.get(r["box"], F.lit(i)) for i in range(4))
        box_ok = F.coalesce(F.size(r["box"]) == 4, F.lit(False)) & valid_box(
            west, south, east, north
        )
        reason = first_reason(
            (~r["type"].eqNullSafe("Feature"), "not_a_feature"),
            (~r["shape"].eqNullSafe("Point"), "not_a_point"),
            (~_pair_ok(r["point"]), "invalid_coordinate"),
            (r["has_center"] & ~_pair_ok(r["center"]), "invalid_center"),
            (r["has_box"] & ~box_ok, "invalid_bounds"),
            (~_plain(r["source"], LABEL_BYTES), "invalid_source"),
            (~_plain(r["label"], LABEL_BYTES), "invalid_label"),
        )
        bounds = F.when(
            r["has_box"],
            F.struct(
                west.alias("west"), south.alias("south"), east.alias("east"), north.alias("north")
            ),
        )
        return F.struct(
            F.lit(provider).alias("provider"),
            r["source"].alias("source_id"),
            r["label"].alias("label"),
            F.get(r["point"], F.lit(0)).alias("lon"),
            F.get(r["point"], F.lit(1)).alias("lat"),
            bounds.alias("bounds"),
            F.lit(credit).alias("credit"),
            F.lit(link).cast("string").alias("credit_link"),
            reason.alias("reason"),
        )

    return build


def decode_features(
    df: DataFrame,
    limit: int,
    provider: str,
    native_credit: str,
    credit: str,
    link: str | None = None,
    id: str = "response_id",
) -> tuple[DataFrame, DataFrame]:
    """FeatureCollections of points -> (features, refused responses).

    The response must carry exactly the reviewed ``native_credit``; what is kept is its
    approved plain equivalent. Feature ids stay verbatim.
    """
    if not 1 <= limit <= MAX_FEATURES:
        raise Refused("limit outside 1..10")
    _check_plain(provider, PROVIDER_BYTES)
    check_credit(credit, link)
    if not native_credit.strip() or len(native_credit.encode()) > NATIVE_CREDIT_BYTES:
        raise Refused("native credit is empty or too large")

    def judge(v: Column) -> Column:
        count = _length(v, "$.features")
        return first_reason(
            (F.octet_length("body") > RESPONSE_BYTES, "too_large"),
            (v.isNull() | ~_text(v, "$.type").eqNullSafe("FeatureCollection"), "invalid_response"),
            (~_text(v, "$.attribution").eqNullSafe(native_credit), "invalid_credit"),
            (count.isNull(), "invalid_response"),
            (count > limit, "over_limit"),
        )

    feature = _feature(provider, credit, link)
    return _decode(df, id, judge, lambda v: _items(v, "$.features"), feature)


ROUTE_RESPONSE = (
    "array<struct<code string, routes array<struct<distance double, duration double, "
    "geometry struct<type string, coordinates array<array<double>>>>>>>"
)


def decode_routes(df: DataFrame, id: str = "response_id") -> tuple[DataFrame, DataFrame]:
    """Routing responses (``body``, ``success``) -> (routes, refused responses).

    Success needs code ``Ok`` and one LineString route. A failure that says there is no
    route or no nearby segment gives neither a route nor a refusal. Numbers given as text
    do not fit the schema, and text after the value breaks the enclosing array, so both
    leave a NULL that is refused.
    """
    wrapped = F.from_json(F.concat(F.lit("["), F.col("body"), F.lit("]")), ROUTE_RESPONSE)
    one = _let(wrapped, lambda w: F.when(F.size(w) == 1, w))
    parsed = df.select(
        id, "success", F.octet_length("body").alias("_bytes"), F.explode_outer(one).alias("_d")
    )
    ok, code, routes = F.col("success"), F.col("_d.code"), F.col("_d.routes")
    route = F.get(routes, F.lit(0))
    metres, seconds, line = route["distance"], route["duration"], route["geometry"]["coordinates"]
    reason = first_reason(
        (F.col("_bytes") > RESPONSE_BYTES, "too_large"),
        (code.isNull(), "invalid_response"),
        (~ok & code.isin("NoRoute", "NoSegment"), "no_route"),
        (~ok & (code == "TooBig"), "too_large"),
        (~ok & (code == "Ok"), "invalid_response"),
        (~ok, "rejected"),
        (code != "Ok", "invalid_response"),
        (routes.isNull() | (F.size(routes) == 0), "invalid_response"),
        (F.size(routes) > 1, "too_large"),
        (~valid_quantity(metres) | ~valid_quantity(seconds), "invalid_quantity"),
        (~route["geometry"]["type"].eqNullSafe("LineString"), "invalid_geometry"),
        (F.size(line) > MAX_VERTICES, "too_large"),
        (line.isNull() | (F.size(line) < 2), "invalid_geometry"),
        (F.exists(line, lambda p: ~_pair_ok(p)), "invalid_geometry"),
    )
    judged = parsed.withColumn("_reason", reason)
    points = F.transform(line, lambda p: F.struct(p[0].alias("lon"), p[1].alias("lat")))
    good = judged.filter("_reason IS NULL").select(
        id, metres.alias("metres"), seconds.alias("seconds"), points.alias("line")
    )
    refused = judged.filter("_reason <> 'no_route'").select(
        id, F.col("_reason").alias("reject_reason")
    )
    return good, refused


def _lines(points: DataFrame, route: list[str], limit: int, minimum: int):
    """(lines of bounded routes, refused routes) with the points of a line in ``seq`` order.

    Points are counted first. A route beyond the limit is dropped on salted keys before
    anything is gathered, so no group of more than ``limit`` points is ever built.
    """
    placed = points.withColumn("_ok", valid_coordinate(F.col("lon"), F.col("lat")))
    counts = placed.groupBy(*route).agg(
        F.count("*").alias("points"), F.count_if(~F.col("_ok")).alias("_bad")
    )
    judged = counts.withColumn(
        "reject_reason",
        first_reason(
            (F.col("points") > limit, "too_many_points"),
            (F.col("_bad") > 0, "invalid_coordinate"),
            (F.col("points") < minimum, "too_few_points"),
        ),
    )
    refused = judged.filter("reject_reason IS NOT NULL").select(*route, "points", "reject_reason")
    dropped = refused.select(*route, every_lane().alias("_lane"))
    spread = points.withColumn("_lane", lanes("seq", "lon", "lat"))
    kept = spread.join(dropped, [*route, "_lane"], "left_anti")
    ordered = F.array_sort(F.collect_list(F.struct("seq", "lon", "lat")))
    return kept.groupBy(*route).agg(ordered.alias("_line")), refused


def assemble_routes(
    points: DataFrame, route: str = "route_id", mode: str | None = None
) -> tuple[DataFrame, DataFrame]:
    """Ordered positions per route -> (routes with ``geojson``, refused routes).

    With ``mode`` the points are the 2..25 waypoints of a route request; without, they are
    a line of 2..8192 vertices. A ``part`` column makes a MultiLineString of the parts.
    """
    if mode is not None and mode not in MODES:
        raise Refused(f"travel mode is one of {MODES}")
    limit = MAX_WAYPOINTS if mode is not None else MAX_VERTICES
    multi = "part" in points.columns

    def coordinates(line: Column) -> Column:
        return F.transform(line, lambda p: F.array(p["lon"], p["lat"]))

    def geojson(kind: str, value: Column) -> Column:
        return F.to_json(F.struct(F.lit(kind).alias("type"), value.alias("coordinates")))

    if not multi:
        lines, refused = _lines(points, [route], limit, 2)
        out = lines.select(
            route,
            F.size("_line").cast("long").alias("points"),
            geojson("LineString", coordinates(F.col("_line"))).alias("geojson"),
        )
        return out.withColumn("mode", F.lit(mode)) if mode else out, refused
    # The vertex limit holds for the whole geometry, the minimum for every part.
    parts, short = _lines(points, [route, "part"], limit, 2)
    over = points.groupBy(route).agg(F.count("*").alias("points")).filter(F.col("points") > limit)
    bad = short.select(route, "points", "reject_reason").unionByName(
        over.withColumn("reject_reason", F.lit("too_many_points"))
    )
    refused = bad.groupBy(route).agg(
        F.max("points").alias("points"), F.max("reject_reason").alias("reject_reason")
    )
    whole = parts.join(refused, route, "left_anti")
    gathered = whole.groupBy(route).agg(
        F.array_sort(F.collect_list(F.struct("part", "_line"))).alias("_parts"),
        F.sum(F.size("_line")).alias("points"),
    )
    many = F.transform("_parts", lambda p: coordinates(p["_line"]))
    text = F.when(
        F.size("_parts") == 1, geojson("LineString", coordinates(F.col("_parts")[0]["_line"]))
    ).otherwise(geojson("MultiLineString", many))
    return gathered.select(route, "points", text.alias("geojson")), refused


def resource_points(view: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(points, duplicate keys) of an authorised view with ``title, longitude, latitude``.

    A row whose fields are hidden, null or invalid is silently absent; a key that comes
    twice is a fault of the set and is reported instead of shown.
    """
    fields = F.col("fields")
    title = F.try_variant_get(F.try_parse_json(fields["title"]), "$", "string")
    is_text = fields["title"].startswith('"')
    lon = _number(F.try_parse_json(fields["longitude"]), "$")
    lat = _number(F.try_parse_json(fields["latitude"]), "$")
    shown = is_text & (F.octet_length(title) <= TITLE_BYTES) & valid_coordinate(lon, lat)
    by_key = view.groupBy("kind", "id").agg(
        F.count("*").alias("copies"),
        F.min(
            F.struct(
                F.coalesce(shown, F.lit(False)).alias("shown"),
                title.alias("title"),
                lon.alias("lon"),
                lat.alias("lat"),
            )
        ).alias("p"),
    )
    points = by_key.filter((F.col("copies") == 1) & F.col("p.shown")).select(
        "kind", "id", "p.title", "p.lon", "p.lat"
    )
    return points, by_key.filter("copies > 1").select("kind", "id", "copies")
