"""Plain restatements of the operators' results, for small inputs."""

from __future__ import annotations

import re
import zlib

import numpy as np
import public_tokenizers
import xxhash
from tokenizers import Tokenizer

TOKENIZER = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))

DOCS = "doc_id long, text string, lang string, source string, n_chars long"

#: Rows that every operator on documents must bear: nulls, empties, repeats, odd text.
ODD = [
    (1, None, "en", "a", 0),
    (2, "", "en", "a", 0),
    (3, " \t\n ", None, "a", 4),
    (4, "Same text here, twice over. And more of it!", "en", None, 43),
    (4, "Same text here, twice over. And more of it!", "en", None, 43),
    (None, "no id at all", "en", "b", None),
    (None, None, None, None, None),
    (7, "long " * 30_000, "en", "b", 150_000),
    (8, "<|endoftext|> İstanbul ΑΣ 日本語 é ½ ​\x1c", "xx", "b", 30),
    (9, "word", "en", "b", 4),
]


def documents(spark, rows=ODD):
    return spark.createDataFrame(rows, DOCS)


def with_clashes(docs):
    """The same documents with columns whose names operators might use themselves."""
    from pyspark.sql import functions as F

    names = ("id", "key", "hash", "fp", "doc", "version", "at", "pieces", "fill", "next", "chunk", "root", "a", "b", "words", "found", "lines")
    return docs.withColumns({n: F.lit(n) for n in names})


def token_ids(text: str | None) -> list[int]:
    return TOKENIZER.encode(text or "", add_special_tokens=False).ids


def crc(ids: list[int]) -> int:
    return zlib.crc32(np.array(ids, "<u4").tobytes())


def shingles(text: str | None, size: int) -> list[bytes]:
    words = re.findall(rb"[^\x20\x09-\x0D]+", re.sub(rb"[A-Z]", lambda m: m[0].lower(), (text or "").encode()))
    if len(words) < size:
        return [b" ".join(words)] if words else []
    return [b" ".join(words[i : i + size]) for i in range(len(words) - size + 1)]


def simhash(text: str | None, size: int) -> int:
    hashes = [xxhash.xxh64_intdigest(s, 42) for s in shingles(text, size)]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def groups(nodes, linked) -> dict:
    """Node -> least node of its component."""
    parent = {n: n for n in nodes}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    ordered = list(nodes)
    for i, a in enumerate(ordered):
        for b in ordered[:i]:
            if find(a) != find(b) and linked(a, b):
                low, high = sorted((find(a), find(b)))
                parent[high] = low
    return {n: find(n) for n in nodes}


def lines(text: str) -> list[str]:
    return re.findall(r"[^.,;:!?\n]*[.,;:!?\n]+\s*|[^.,;:!?\n]+", text)


def longest_common(a: list, b: list) -> int:
    row = [0] * (len(b) + 1)
    for x in a:
        before = row[:]
        for j, y in enumerate(b):
            row[j + 1] = before[j] + 1 if x == y else max(before[j + 1], row[j])
    return row[-1]
