import random

import pytest

from revtide.llm import encoding, packing, tokencount
from tests.llm import brute


def check_pieces(docs, rows):
    by_doc, bins = {}, {}
    for r in rows:
        by_doc.setdefault((r.doc_id, r.ids_crc32 if r.doc_id is None else None), []).append(r)
        bins.setdefault(r.sequence_id, []).append(r)
    for own in bins.values():
        own.sort(key=lambda r: r.offset)
        at = 0
        for r in own:
            assert r.offset == at
            at += r.length
        assert at <= packing.CAPACITY
    expected = sorted(
        (str(d), n // 2048, n, len(part), brute.crc(part))
        for d, text, *_ in docs
        for ids in [brute.token_ids(text) + [0]]
        for n in range(0, len(ids), 2048)
        for part in [ids[n : n + 2048]]
    )
    assert sorted((str(r.doc_id), r.piece, r.start, r.length, r.ids_crc32) for r in rows) == expected
    return len(bins)


def test_packing_odd_rows(spark):
    check_pieces(brute.ODD, packing.pack(brute.with_clashes(brute.documents(spark))).collect())


def test_packing_is_tight_over_many_partitions(spark):
    draw = random.Random(5)
    docs = [(i, " ".join(["word"] * int(draw.paretovariate(0.7) * 20 % 1900)), "en", "s", 0) for i in range(800)]
    rows = packing.pack(brute.documents(spark, docs).repartition(40)).collect()
    used = check_pieces(docs, rows)
    assert used <= 1.02 * (sum(r.length for r in rows) / packing.CAPACITY) + 1


def test_packing_empty_table(spark):
    assert packing.pack(brute.documents(spark, [])).collect() == []


def test_best_fit_takes_the_fullest_bin_that_fits():
    assert packing.best_fit([6, 5, 4, 5], 10) == [0, 1, 0, 1]
    assert packing.best_fit([10, 10], 10) == [0, 1]
    assert packing.best_fit([], 10) == []


def test_bins_without_a_partner_are_packed_whole(spark):
    """Texts of about 1,400 tokens can't share a sequence, shorter ones fill them up."""
    docs = [(i, " ".join(["word"] * (1390 + i % 3)), "en", "s", 0) for i in range(480)]
    docs += [(1000 + i, " ".join(["word"] * 300), "en", "s", 0) for i in range(40)]
    frame = brute.documents(spark, docs).repartition(64)
    used = check_pieces(docs, packing.pack(frame).collect())
    assert used <= 481


def test_what_is_sent_up_is_bounded():
    many = [(1400, []) for _ in range(1000)] + [(1500, []) for _ in range(7)] + [(300, [])]
    bins = packing._packed(0, 0, many, 2048)
    assert sum(not b["done"] for b in bins if b["fill"] == 1400) == packing.FAN_IN
    assert sum(not b["done"] for b in bins if b["fill"] == 1500) == 6
    assert sorted(b["fill"] for b in bins if b["fill"] not in (1400, 1500)) == [1800]
    assert all(b["done"] for b in packing._packed(0, packing.ROUNDS, many, 2048))


@pytest.mark.parametrize("seed", range(20))
def test_holding_bins_back_costs_no_sequence(seed, monkeypatch):
    """Packed group by group with and without the rule: the same number of bins."""
    draw = random.Random(seed)
    groups = [[(draw.choice([1400, 1401, 1300, draw.randrange(1, 2049)]), []) for _ in range(draw.randrange(1, 120))] for _ in range(16)]

    def bins_of(limit):
        monkeypatch.setattr(packing, "FAN_IN", limit)
        low = [b for g, items in enumerate(groups) for b in packing._packed(g, 0, items, 2048)]
        up = [(b["fill"], b["pieces"]) for b in low if not b["done"]]
        return sum(b["done"] for b in low) + len(packing._packed(0, 1, up, 2048))

    assert bins_of(16) == bins_of(10**9)


def test_counts_odd_rows(spark):
    rows = tokencount.count_tokens(brute.with_clashes(brute.documents(spark))).collect()
    found = sorted((str(r.doc_id), r.n_bytes, r.n_tokens, r.over_limit) for r in rows)
    assert found == sorted(
        (str(d), len((t or "").encode()), len(brute.token_ids(t)), len(brute.token_ids(t)) > 2048)
        for d, t, *_ in brute.ODD
    )
    assert tokencount.count_tokens(brute.documents(spark, [])).collect() == []
    assert tokencount.count_tokens(brute.documents(spark, [(1, None, None, None, None)])).first().n_tokens == 0


@pytest.mark.parametrize("seed", range(4))
def test_words_give_the_library_s_ids(seed):
    draw = random.Random(seed)
    alphabet = "abcXYZ éÉßñ .,;:!?'\t\n1²ªº|<>-_İſΣ\x85\xa0́\x1c日"
    for _ in range(300):
        text = "".join(draw.choices(alphabet, k=draw.randrange(40)))
        got = encoding.text_ids(encoding.VOCABULARY, text)
        assert [int.from_bytes(got[i : i + 4], "little") for i in range(0, len(got), 4)] == brute.token_ids(text)


def test_a_full_memory_starts_anew(monkeypatch):
    monkeypatch.setattr(encoding, "CACHE", 3)
    words = encoding.WordIds(encoding.VOCABULARY)
    text = "one two three, four. five one six. two"
    got = b"".join(map(words.__getitem__, text.split()))
    assert [int.from_bytes(got[i : i + 4], "little") for i in range(0, len(got), 4)] == brute.token_ids(text)
    assert len(words) <= 3
