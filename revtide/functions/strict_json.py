"""Strict JSON for admission and digests.

Spark's JSON readers keep the last duplicate name or accept trailing text, so the two
places that must be exact (file admission and content identity) read the text in Python.
"""

from __future__ import annotations

import json
import math
import struct

# Hard ceilings of the document model.
DOCUMENT_BYTES = 65_536
DOCUMENT_STRING_BYTES = 16_384
VALUE_BYTES = 16_384
MAX_NODES = 4_096
MAX_DEPTH = 32
NUMBER_TEXT = 64

U64_END = 1 << 64
I64_START = -(1 << 63)


class Unfit(ValueError):
    """A document that is refused; the message is its reject reason."""


def _members(pairs):
    out = dict(pairs)
    if len(out) != len(pairs):
        raise Unfit("duplicate_name")
    return out


def _real(text: str) -> float:
    if len(text) > NUMBER_TEXT:
        raise Unfit("number_too_long")
    value = float(text)
    if not math.isfinite(value):
        raise Unfit("number_not_finite")
    return value


def _whole(text: str):
    if len(text) > NUMBER_TEXT:
        raise Unfit("number_too_long")
    value = int(text)
    # "-0" and integers beyond 64 bits are only representable as floats.
    if text == "-0" or not I64_START <= value < U64_END:
        return _real(text)
    return value


def _no_constant(_: str):
    raise Unfit("invalid_json")


_READER = json.JSONDecoder(
    object_pairs_hook=_members,
    parse_float=_real,
    parse_int=_whole,
    parse_constant=_no_constant,
)


def parse(text: str):
    """One JSON value, no duplicate names at any depth, nothing after it."""
    try:
        return _READER.decode(text)
    except Unfit:
        raise
    except RecursionError:
        raise Unfit("too_deep") from None
    except ValueError:
        raise Unfit("invalid_json") from None


def check_document(value, strings: int = DOCUMENT_STRING_BYTES) -> None:
    """Depth (root is one), node and string limits of an imported document."""
    nodes = 0
    todo = [(value, 1)]
    while todo:
        item, depth = todo.pop()
        nodes += 1
        if depth > MAX_DEPTH:
            raise Unfit("too_deep")
        if nodes > MAX_NODES:
            raise Unfit("too_many_nodes")
        if isinstance(item, str):
            if len(_utf8(item)) > strings:
                raise Unfit("string_too_large")
        elif isinstance(item, list):
            todo += [(child, depth + 1) for child in item]
        elif isinstance(item, dict):
            if any(len(_utf8(name)) > strings for name in item):
                raise Unfit("string_too_large")
            todo += [(child, depth + 1) for child in item.values()]


def _utf8(text: str) -> bytes:
    try:
        return text.encode()
    except UnicodeEncodeError:
        raise Unfit("invalid_json") from None


def _sized(raw: bytes) -> bytes:
    return len(raw).to_bytes(4, "big") + raw


def canonical(selected: dict) -> bytes:
    """Typed bytes of the selected fields: name order is dropped, everything else kept.

    null, false, true, unsigned, negative, float, string, array and object carry their
    own tag, so 0, 0.0, "", [], {} and an absent name never look alike.
    """
    parts: list[bytes] = []
    state = {"nodes": 0, "bytes": 0}

    def put(raw: bytes) -> None:
        state["bytes"] += len(raw)
        if state["bytes"] > VALUE_BYTES:
            raise Unfit("value_too_large")
        parts.append(raw)

    def walk(item, depth: int) -> None:
        state["nodes"] += 1
        if depth > MAX_DEPTH or state["nodes"] > MAX_NODES:
            raise Unfit("too_deep" if depth > MAX_DEPTH else "too_many_nodes")
        if item is None:
            put(b"n")
        elif item is True or item is False:
            put(b"t" if item else b"f")
        elif isinstance(item, int):
            put((b"u" if item >= 0 else b"i") + (item % U64_END).to_bytes(8, "big"))
        elif isinstance(item, float):
            put(b"d" + struct.pack(">d", item + 0.0))
        elif isinstance(item, str):
            put(b"s" + _sized(_utf8(item)))
        elif isinstance(item, list):
            put(b"a" + len(item).to_bytes(4, "big"))
            for child in item:
                walk(child, depth + 1)
        else:
            put(b"o" + len(item).to_bytes(4, "big"))
            members = sorted(((_utf8(k), v) for k, v in item.items()), key=lambda m: m[0])
            for name, child in members:
                put(_sized(name))
                walk(child, depth + 1)

    walk(selected, 0)
    return b"".join(parts)
