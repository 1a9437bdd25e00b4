import hashlib
import math
import struct
import uuid

import numpy as np
import pytest
from pyspark.sql import functions as F

from revtide.functions.keys import KEY_TAG, admit_keys, key_hash, key_uuid
from revtide.functions.strict_json import Unfit, canonical, check_document, parse
from revtide.functions.values import Mapping, content_digest, select_fields
from revtide.functions.vectors import canonical_vector, l2_norm, l2_normalize
from revtide.verdicts import Refused

MAPPING = Mapping("deployment-a", "search", "mapping-v1", ("v",))


def digests(spark, values, mapping=MAPPING, revision=1):
    frame = spark.createDataFrame([(n, v) for n, v in enumerate(values)], "n int, value string")
    column = content_digest(mapping, F.lit("k"), F.lit("a"), F.lit(revision), F.col("value"))
    out = frame.select("n", column.alias("d")).orderBy("n").collect()
    return [(r.d.digest, r.d.reject_reason) for r in out]


def test_distinct_values_have_distinct_digests(spark):
    texts = [
        "{}", '{"v":null}', '{"v":false}', '{"v":0}', '{"v":0.0}', '{"v":""}', '{"v":[]}',
        '{"v":{}}', '{"v":18446744073709551615}', '{"v":18446744073709551614}', '{"v":-1}', None,
    ]
    found = [d for d, _ in digests(spark, texts)]
    assert None not in found and len(set(found)) == len(texts)


def test_equal_values_have_equal_digests(spark):
    same = [
        '{"v":{"a":1,"b":[1,2]}}', '{"x":9, "v":{"b":[1,2],"a":1}}',
        '{"v": {"b": [1, 2], "\\u0061": 1}}',
    ]
    assert len(set(digests(spark, same))) == 1
    floats = ['{"v":1.0}', '{"v":1e0}', '{"v":10.0e-1}']
    assert len(set(digests(spark, floats))) == 1
    zero = ['{"v":0.0}', '{"v":-0.0}', '{"v":-0}']
    assert len(set(digests(spark, zero))) == 1
    assert digests(spark, ['{"v":[1,2]}']) != digests(spark, ['{"v":[2,1]}'])
    assert digests(spark, ['{"v":1}']) != digests(spark, ['{"v":1}'], revision=2)


def test_refused_values(spark):
    deep = '{"v":' + "[" * 40 + "]" * 40 + "}"
    long_number = '{"v":' + "1" * 65 + "}"
    texts = [
        '{"v":1} x', '{"v":1,"v":2}', '{"v":{"a":1,"a":2}}', "[1]", '{"v":NaN}', '{"v":1e999}',
        deep, long_number, '{"v":"' + "x" * 17000 + '"}', '{"v":[' + "0," * 4096 + "0]}",
    ]
    reasons = [r for _, r in digests(spark, texts)]
    assert reasons == [
        "invalid_json", "duplicate_name", "duplicate_name", "invalid_value", "invalid_json",
        "number_not_finite", "too_deep", "number_too_long", "value_too_large", "value_too_large",
    ] or reasons[-1] == "too_many_nodes"


def test_vectors_are_part_of_the_digest(spark):
    mapping = Mapping("d", "p", "m", ("v",), model="m1", dimension=2)
    frame = spark.createDataFrame(
        [(1, '{"v":1}', [0.0, 1.0]), (2, '{"v":1}', [-0.0, 1.0]), (3, '{"v":1}', [0.5, 1.0]),
         (4, '{"v":1}', None), (5, '{"v":1}', [1.0]), (6, None, None), (7, None, [1.0, 2.0]),
         (8, '{"v":1}', [math.inf, 1.0])],
        "n int, value string, vector array<float>",
    )
    column = content_digest(
        mapping, F.lit("k"), F.lit("a"), F.lit(1), F.col("value"), F.col("vector")
    )
    out = {r.n: r.d for r in frame.select("n", column.alias("d")).collect()}
    assert out[1].digest == out[2].digest != out[3].digest
    assert [out[n].reject_reason for n in (4, 5, 6, 7, 8)] == [
        "vector_missing", "dimension_mismatch", None, "vector_forbidden", "vector_not_finite",
    ]


def test_mapping_is_validated_and_identified():
    assert MAPPING.fingerprint != Mapping("deployment-b", "search", "mapping-v1", ("v",)).fingerprint
    assert Mapping("d", "p", "m", ("b", "a")).fingerprint == Mapping("d", "p", "m", ("a", "b")).fingerprint
    for bad in (dict(fields=("a", "a")), dict(fields=("a\0",)), dict(fields=("a",), model="x"),
                dict(fields=tuple(map(str, range(65)))), dict(fields=("a",), dimension=3)):
        with pytest.raises(Refused):
            Mapping("d", "p", "m", **bad)


def test_documents_are_bounded():
    check_document(parse('{"n":18446744073709551615,"null":null,"empty":""}'))
    check_document(parse("7"))
    check_document(parse("[1]"))
    for text, reason in (
        ("[" * 33 + "]" * 33, "too_deep"),
        ("[" + "0," * 4096 + "0]", "too_many_nodes"),
        ('"' + "x" * 16385 + '"', "string_too_large"),
    ):
        with pytest.raises(Unfit, match=reason):
            check_document(parse(text))
    assert canonical({"a": 1.0}) == b"o\0\0\0\1\0\0\0\1ad" + struct.pack(">d", 1.0)


def test_selection_tells_missing_from_null(spark):
    frame = spark.createDataFrame(
        [(1, '{"a":null,"b b":"x","z":1}'), (2, '{"b b":[1,{"c":2}]}'), (3, None), (4, "[1]"), (5, "{")],
        "n int, value string",
    )
    out = {r.n: r for r in select_fields(frame, ["a", "b b"]).collect()}
    assert out[1].fields == {"a": "null", "b b": '"x"'}
    assert out[2].fields == {"b b": '[1,{"c":2}]'}
    assert out[3].fields is None and out[3].reject_reason is None
    assert out[4].reject_reason == out[5].reject_reason == "invalid_value"


def test_key_identity(spark):
    keys = [("k", "é€"), ("kind", "a"), ("ki", "nda")]
    frame = spark.createDataFrame(keys, "kind string, id string")
    out = frame.select(
        "kind", "id", key_hash(F.col("kind"), F.col("id")).alias("h"),
        key_uuid(F.col("kind"), F.col("id")).alias("u"),
    ).collect()
    for row in out:
        raw = KEY_TAG.encode()
        for part in (row.kind.encode(), row.id.encode()):
            raw += len(part).to_bytes(4, "big") + part
        digest = hashlib.sha256(raw).digest()
        assert row.h == digest.hex()
        assert uuid.UUID(row.u).version == 8 and uuid.UUID(row.u).variant == uuid.RFC_4122
        assert uuid.UUID(row.u).bytes[0] == digest[0]
    assert len({r.h for r in out}) == 3


def test_key_admission(spark):
    frame = spark.createDataFrame(
        [("k", "a", 1, 1), ("", "a", 1, 1), ("k", "", 1, 1), ("k", "a", 0, 1), ("k", "a", 1, 0),
         ("k", None, 1, 1), ("k", "x" * 1024, 1, 1), ("k", "x" * 1025, 1, 1)],
        "kind string, id string, revision long, position long",
    )
    assert [r.reject_reason for r in admit_keys(frame).collect()] == [
        None, "kind_empty", "id_empty", "revision_invalid", "position_invalid", "id_empty", None,
        "id_too_large",
    ]


def test_normalisation_is_safe_at_the_edges(spark):
    largest, least = float(np.finfo("f4").max), float(np.float32(1e-45))
    frame = spark.createDataFrame(
        [(1, [3.0, 4.0, -0.0]), (2, [largest, largest]), (3, [least, 0.0]), (4, [0.0, 0.0])],
        "n int, v array<float>",
    )
    out = frame.withColumn("v", canonical_vector(F.col("v"))).withColumn("norm", l2_norm(F.col("v")))
    got = {r.n: r.u for r in out.select("n", l2_normalize(F.col("v"), F.col("norm")).alias("u")).collect()}
    f4 = lambda *xs: [float(np.float32(x)) for x in xs]
    assert got[1] == f4(0.6, 0.8, 0.0) and math.copysign(1, got[1][2]) == 1
    assert got[2] == f4(0.5**0.5, 0.5**0.5)
    assert got[3] == [1.0, 0.0] and got[4] is None


def test_a_row_without_revision_is_refused_alone(spark):
    rows = spark.createDataFrame([("1", None, "{}"), ("2", 2**60 + 1, "{}"), ("3", -1, "{}")], "id string, revision long, value string")
    mapping = Mapping("d", "p", "m", ("t",))
    column = content_digest(mapping, F.lit("k"), F.lit("a"), F.col("revision"), F.col("value"))
    got = {r.id: r.c for r in rows.coalesce(1).select("id", column.alias("c")).collect()}
    assert got["1"].reject_reason == got["3"].reject_reason == "revision_invalid"
    exact = content_digest(mapping, F.lit("k"), F.lit("a"), F.lit(2**60 + 1), F.lit("{}"))
    assert got["2"].digest == spark.range(1).select(exact.alias("c")).first().c.digest
