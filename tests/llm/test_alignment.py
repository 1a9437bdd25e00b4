import hashlib
import random
import tracemalloc
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from tokenizers import Tokenizer

from revtide.llm import alignment
from tests.llm import brute

A = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
A.encode_special_tokens = True
B = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))


def byte_alphabet():
    """The byte that each character of side A's entries stands for."""
    own = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or b >= 174]
    rest = [b for b in range(256) if b not in own]
    return {chr(b): b for b in own} | {chr(256 + n): b for n, b in enumerate(rest)}


ALPHABET = byte_alphabet()


def token_bytes(text):
    a = [(i, bytes(ALPHABET[c] for c in A.id_to_token(i))) for i in A.encode(" " + text, add_special_tokens=False).ids]
    b = []
    for i in B.encode(text):
        piece = B.id_to_piece(i)
        b.append((i, bytes([int(piece[3:-1], 16)]) if B.is_byte(i) else piece.replace("▁", " ").encode()))
    return a, b


def spans(tokens):
    at, out = 0, []
    for i, raw in tokens:
        out.append((i, at, at + len(raw)))
        at += len(raw)
    return out


def restated(docs):
    """Every row by definition: all pairs of tokens compared."""
    seen, counts = [], Counter()
    for doc_id, text, *_ in docs:
        a, b = token_bytes(text) if text else ([], [])
        whole = (" " + (text or "")).encode()
        if not text or b"".join(x for _, x in a) != whole or b"".join(x for _, x in b) != whole:
            a, b = [], []
        a, b = spans(a), spans(b)
        links = [(i, j) for i, s, e in a for j, t, f in b if max(s, t) < min(e, f)]
        cuts = sorted({e for *_, e in a} & {e for *_, e in b})
        groups, low = [], 0
        for high in cuts:
            sides = [",".join(str(i) for i, s, e in side if s >= low and e <= high) for side in (a, b)]
            groups.append("|".join(sides))
            low = high
        counts.update(set(links))
        digest = hashlib.sha256(";".join(groups).encode()).hexdigest() if groups else ""
        seen.append((doc_id, len(a), len(b), len(groups), links, digest))
    best = {}
    for (i, _), n in counts.items():
        best[i] = max(best.get(i, 0), n)
    return sorted(
        (str(d), na, nb, g, len(links), sum(counts[x] == best[x[0]] for x in links), sum(counts[x] for x in links), digest)
        for d, na, nb, g, links, digest in seen
    )


def rows_of(frame):
    return sorted((str(r[0]), *r[1:]) for r in frame.collect())


def corpus(n=120, seed=3):
    draw = random.Random(seed)
    words = ["".join(draw.choices("abeghinorstéüñ", k=draw.randrange(1, 9))) for _ in range(150)]
    return [(i, draw.choice(["", " ", "\n"]) + " ".join(draw.choices(words, k=draw.randrange(0, 40))) + ", the end.", "en", "s", 1) for i in range(n)]


ODD = [(d, t if d != 7 else "long " * 300, *rest) for d, t, *rest in brute.ODD] + [
    (20, "  two  spaces\t\ttabs   and\r\nlines", "en", "s", 1),
    (21, "ﬁ ① Å ｆｕｌｌ é ▁ under ▁bar", "en", "s", 1),
    (22, "<s> </s> <unk> <0x41> <|endoftext|>", "en", "s", 1),
    (23, "👩‍👩‍👧 𝔘 ͸ \x00 \x7f \x85 　", "en", "s", 1),
]


def test_odd_rows_equal_the_definition(spark):
    assert rows_of(alignment.align(brute.with_clashes(brute.documents(spark, ODD)))) == restated(ODD)


@pytest.mark.parametrize("parts", [1, 7])
def test_counts_over_many_runs(spark, monkeypatch, parts):
    monkeypatch.setattr(alignment, "RUN_LINKS", 300)
    monkeypatch.setattr(alignment, "FAN_IN", 3)
    monkeypatch.setattr(alignment, "RUNS_AT_ONCE", 2)
    monkeypatch.setattr(alignment, "FRAME", 16)
    docs = corpus() + [(n, "of the same, the same", "en", "s", 1) for n in (1, 1, 500)]
    assert rows_of(alignment.align(brute.documents(spark, docs).repartition(parts))) == restated(docs)


def test_empty_tables(spark):
    assert alignment.align(brute.documents(spark, [])).collect() == []
    nothing = [(1, None, None, None, None), (2, "", None, None, None)]
    assert rows_of(alignment.align(brute.documents(spark, nothing))) == restated(nothing)


@pytest.mark.parametrize("seed", range(6))
def test_both_encoders_of_side_a_agree(seed):
    encode, table = alignment._byte_side(alignment.BYTES_SIDE)
    draw = random.Random(seed)
    every = [chr(c) for c in (9, 10, 13, *range(32, 127), *range(0xA0, 0x250))]
    for _ in range(400):
        some = draw.choices(every, k=6) + list(" \n's't've'LL ")
        text = "".join(draw.choices(some, k=draw.randrange(60)))
        assert encode(text) == A.encode(text, add_special_tokens=False).ids
        assert b"".join(table[i] for i in encode(text)) == text.encode()


def test_frames_give_back_their_columns(monkeypatch):
    monkeypatch.setattr(alignment, "FRAME", 4)
    first, second = np.arange(10, dtype="<u4"), np.arange(10, dtype="<i8") * 7
    parts = list(alignment._unframed(alignment._frames(first, second), alignment.PAIR))
    assert [len(a) for a, _ in parts] == [4, 4, 2]
    assert np.concatenate([b for _, b in parts]).tolist() == second.tolist()


def test_merge_adds_equal_pairs_and_finds_the_best():
    lists = [[(1 << 16 | 2, 3), (5 << 16, 1)], [(1 << 16 | 1, 4), (1 << 16 | 2, 2)], []]
    packed = [alignment._frames(*(c.astype(k) for c, k in zip(alignment._columns(iter(x)), alignment.PAIR))) for x in lists]
    found = list(alignment.merged(packed))
    assert found == [(1 << 16 | 1, 4), (1 << 16 | 2, 5), (5 << 16, 1)]
    assert alignment.with_best(*alignment._columns(iter(found))).tolist() == [5, 5, 1]


def test_a_run_may_end_past_its_number_of_documents(spark, monkeypatch):
    """A batch brings a run past ``RUN_DOCS``; the documents beyond it have their sums too."""
    monkeypatch.setattr(alignment, "RUN_DOCS", 50)
    docs = corpus()
    assert rows_of(alignment.align(brute.documents(spark, docs).coalesce(1))) == restated(docs)


def test_workers_get_no_more_texts_than_they_encode_together(spark, monkeypatch):
    def whole(batches, rows):
        for batch in batches:
            assert batch.num_rows <= rows
            yield batch

    monkeypatch.setattr(alignment, "slices", whole)
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(key)
    docs = brute.documents(spark, [(n, "of the same", "en", "s", 1) for n in range(600)]).coalesce(1)
    assert {r.count_sum for r in alignment.align(docs).collect()} == {r[6] for r in restated([(n, "of the same") for n in range(600)])}
    assert spark.conf.get(key) == before


def peak(work):
    tracemalloc.start()
    try:
        work()
        return tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()


def test_encoding_and_a_runs_rows_take_little_memory_a_link():
    draw = random.Random(5)
    words = ["".join(draw.choices("abeghinorst", k=draw.randrange(2, 9))) for _ in range(5000)]
    texts = [" ".join(draw.choices(words, k=400)) for _ in range(100)]
    alignment.Encoded(texts[:1], alignment.BYTES_SIDE, alignment.PIECES_SIDE)
    links = int(alignment.Encoded(texts, alignment.BYTES_SIDE, alignment.PIECES_SIDE).n_links.sum())
    assert peak(lambda: alignment.Encoded(texts, alignment.BYTES_SIDE, alignment.PIECES_SIDE)) < 150 * links
    run = alignment.Run()
    for _ in range(8):
        run.add(list(range(100)), alignment.Encoded(texts, alignment.BYTES_SIDE, alignment.PIECES_SIDE))
    assert peak(lambda: list(run.rows(0))) < 18 * run.links
