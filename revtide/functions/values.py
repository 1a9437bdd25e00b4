"""Field selection, mapping profiles and content identity of journal values."""

from __future__ import annotations

import hashlib
import json
import re
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from revtide.functions import strict_json
from revtide.functions.keys import framed
from revtide.functions.vectors import MAX_DIMENSION, METRICS
from revtide.verdicts import Refused

# Limits of a mapping.
MAX_FIELDS = 64
NAME_BYTES = 128

DIGEST_TAG = b"revtide/content/v1"
PROFILE_TAG = b"revtide/mapping/v1"

DIGEST_TYPE = T.StructType(
    [T.StructField("digest", T.StringType()), T.StructField("reject_reason", T.StringType())]
)


def check_name(name: str) -> str:
    if not name or "\0" in name or len(name.encode()) > NAME_BYTES:
        raise Refused(f"invalid identifier {name!r}")
    return name


def check_fields(fields: Iterable[str]) -> tuple[str, ...]:
    names = tuple(sorted(check_name(f) for f in fields))
    if len(names) > MAX_FIELDS or len(set(names)) != len(names):
        raise Refused("a mapping selects at most 64 unique fields")
    return names


def _frame(raw: bytes) -> bytes:
    return len(raw).to_bytes(4, "big") + raw


@dataclass(frozen=True)
class Mapping:
    """What a projection selects: deployment, provider, mapping, fields, optional model."""

    deployment: str
    provider: str
    mapping: str
    fields: tuple[str, ...]
    model: str | None = None
    dimension: int | None = None
    metric: str | None = None

    def __post_init__(self):
        for name in (self.deployment, self.provider, self.mapping):
            check_name(name)
        object.__setattr__(self, "fields", check_fields(self.fields))
        if (self.model is None) != (self.dimension is None):
            raise Refused("a model and its dimension come together")
        if self.model is not None:
            check_name(self.model)
            if not 1 <= self.dimension <= MAX_DIMENSION:
                raise Refused("dimension outside 1..4096")
        if self.metric is not None and (self.model is None or self.metric not in METRICS):
            raise Refused("a metric belongs to a model and is a known one")

    @property
    def identity(self) -> bytes:
        names = (self.deployment, self.provider, self.mapping)
        parts = [_frame(n.encode()) for n in names]
        parts.append(b"\0" if self.model is None else b"\1" + _frame(self.model.encode()))
        parts.append(len(self.fields).to_bytes(4, "big"))
        parts += [_frame(f.encode()) for f in self.fields]
        parts.append((self.dimension or 0).to_bytes(4, "big"))
        if self.metric is not None:
            parts.append(_frame(self.metric.encode()))
        return b"".join(parts)

    @property
    def fingerprint(self) -> str:
        """Hex identity of the whole profile; the ``profile`` column of its projections."""
        return hashlib.sha256(PROFILE_TAG + self.identity).hexdigest()


def _path(name: str) -> str:
    if re.fullmatch(r"[A-Za-z_][A-Za-z0-9_]*", name):
        return f"$.{name}"
    return "$['" + name.replace("'", "\\'") + "']"


def select_fields(df: DataFrame, fields: Iterable[str], value: str = "value") -> DataFrame:
    """Keep only the listed top-level names of a JSON ``value``.

    Adds ``fields`` (name -> JSON text) in place of ``value``. A missing name has no entry,
    a JSON null has the entry ``null``, a tombstone has no map. A value that is not a JSON
    object gets ``reject_reason``.
    """
    names = check_fields(fields)
    def pick(variant: Column) -> Column:
        entries = F.array(
            *[
                F.struct(
                    F.lit(n).alias("name"),
                    F.to_json(F.variant_get(variant, _path(n), "variant")).alias("text"),
                )
                for n in names
            ]
        )
        # variant_get is NULL only for a missing name; a JSON null is the text "null".
        kept = F.filter(entries, lambda e: e["text"].isNotNull())
        is_object = F.coalesce(F.schema_of_variant(variant).startswith("OBJECT"), F.lit(False))
        return F.struct(
            F.when(is_object, F.map_from_entries(kept)).alias("fields"),
            F.when(F.col(value).isNotNull() & ~is_object, "invalid_value").alias("reject_reason"),
        )

    # A value is parsed once: the generator keeps filters on the outcome above it.
    parsed = F.transform(F.array(F.try_parse_json(value)), pick)
    others = [c for c in df.columns if c != value]
    return df.select("*", F.explode_outer(parsed).alias("_picked")).select(*others, "_picked.*")


def content_digest(
    mapping: Mapping, kind: Column, id: Column, revision: Column, value: Column, vector=None
) -> Column:
    """``struct(digest, reject_reason)`` of a revision under one mapping.

    The position is not content. Values are read from JSON text because VARIANT folds
    ``1.0`` and ``1`` together; hashing runs on Arrow batches.
    """
    head = DIGEST_TAG + _frame(mapping.identity)
    fields, dimension = mapping.fields, mapping.dimension

    def one(kind, id, revision, text, vector) -> tuple[str | None, str | None]:
        try:
            number = -1 if revision is None else int(revision)
            if number < 0 or kind is None or id is None:
                raise strict_json.Unfit("revision_invalid" if number < 0 else "key_missing")
            if text is None:
                if vector is not None:
                    raise strict_json.Unfit("vector_forbidden")
                body = b""
            else:
                value = strict_json.parse(text)
                if not isinstance(value, dict):
                    raise strict_json.Unfit("invalid_value")
                body = strict_json.canonical({f: value[f] for f in fields if f in value})
            bits = b"\0"
            if vector is not None:
                floats = np.asarray(vector, dtype=">f4") + np.float32(0)
                if dimension is None or len(floats) != dimension:
                    raise strict_json.Unfit("dimension_mismatch")
                if not np.isfinite(floats).all():
                    raise strict_json.Unfit("vector_not_finite")
                bits = b"\1" + floats.astype(">f4").tobytes()
            elif text is not None and dimension is not None:
                raise strict_json.Unfit("vector_missing")
            content = b"".join(
                (
                    head,
                    _frame(kind.encode()),
                    _frame(id.encode()),
                    number.to_bytes(8, "big"),
                    b"\1" if text is None else b"\0",
                    _frame(body),
                    bits,
                )
            )
            return hashlib.sha256(content).hexdigest(), None
        except strict_json.Unfit as fault:
            return None, str(fault)

    @F.pandas_udf(DIGEST_TYPE)
    def without_vector(
        kind: pd.Series, id: pd.Series, revision: pd.Series, value: pd.Series
    ) -> pd.DataFrame:
        rows = [one(k, i, r, v, None) for k, i, r, v in zip(kind, id, revision, value)]
        return pd.DataFrame(rows, columns=["digest", "reject_reason"], dtype=object)

    @F.pandas_udf(DIGEST_TYPE)
    def with_vector(
        kind: pd.Series, id: pd.Series, revision: pd.Series, value: pd.Series, vector: pd.Series
    ) -> pd.DataFrame:
        rows = [one(*row) for row in zip(kind, id, revision, value, vector)]
        return pd.DataFrame(rows, columns=["digest", "reject_reason"], dtype=object)

    # As text: beside a NULL, whole numbers would reach Python as floats.
    revision = revision.cast("string")
    if vector is None:
        return without_vector(kind, id, revision, value)
    return with_vector(kind, id, revision, value, vector)


def text_digest(
    mapping: Mapping,
    kind: Column,
    id: Column,
    revision: Column,
    live: Column,
    values: dict[str, Column],
    strings: set[str],
) -> Column:
    """The digest of ``content_digest`` for typed rows, without leaving the JVM.

    ``values`` maps every field to its column: those named in ``strings`` hold text, the
    others whole numbers. A NULL column is a missing name. For kinds with such a schema and
    no vector.
    """
    if set(values) != set(mapping.fields) or mapping.dimension is not None:
        raise Refused("typed digests need one column per mapped field and no model")

    def raw(data: bytes) -> Column:
        return F.lit(bytearray(data))

    def be(n: Column, width: int) -> Column:
        return F.unhex(F.lpad(F.hex(n), 2 * width, "0"))

    def member(name: str) -> Column:
        column = values[name]
        if name in strings:
            typed = F.concat(raw(b"s"), framed(column))
        else:
            whole = column.cast("bigint")
            typed = F.concat(F.when(whole < 0, raw(b"i")).otherwise(raw(b"u")), be(whole, 8))
        entry = F.concat(raw(_frame(name.encode())), typed)
        return F.when(column.isNull(), raw(b"")).otherwise(entry)

    present = F.array_compact(F.array(*[values[n].isNotNull() for n in mapping.fields]))
    count = F.size(F.filter(present, lambda here: here))
    body = F.concat(raw(b"o"), be(count, 4), *[member(n) for n in mapping.fields])
    body = F.when(live, body).otherwise(raw(b""))
    return F.sha2(
        F.concat(
            raw(DIGEST_TAG + _frame(mapping.identity)),
            framed(kind),
            framed(id),
            be(revision, 8),
            F.when(live, raw(b"\0")).otherwise(raw(b"\1")),
            be(F.octet_length(body), 4),
            body,
            raw(b"\0"),
        ),
        256,
    )


def embed(df: DataFrame, mapping: Mapping, model, model_id: str, fields: str = "fields") -> DataFrame:
    """Add ``vector`` from a deterministic host model over the selected fields.

    ``model()`` is called once per task and returns ``f(list of field maps) -> 2-d floats``.
    Tombstones never reach it. The model id must be the profile's.
    """
    if model_id != mapping.model:
        raise Refused("model id differs from the profile's model")
    dimension = mapping.dimension

    @F.pandas_udf(T.ArrayType(T.FloatType()))
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        predict = model()
        for batch in batches:
            out = pd.Series([None] * len(batch), dtype=object)
            live = [at for at, text in enumerate(batch) if text is not None]
            if live:
                vectors = np.asarray(predict([json.loads(batch.iloc[at]) for at in live]), "f4")
                if vectors.shape != (len(live), dimension):
                    raise ValueError("model returned another shape than the profile's dimension")
                for at, vector in zip(live, vectors):
                    out.iloc[at] = vector
            yield out

    return df.withColumn("vector", run(F.to_json(fields)))
