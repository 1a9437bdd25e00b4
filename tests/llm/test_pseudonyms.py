import ipaddress
import random
import re
from datetime import date

from revtide.llm import pseudonyms
from tests.llm import brute


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c) * (2 if i % 2 else 1)
        total += d - 9 if d > 9 else d
    return total % 10 == 0


def card(draw, n=16):
    head = "4" + "".join(draw.choices("0123456789", k=n - 2))
    return next(head + c for c in "0123456789" if luhn(head + c))


def run(spark, texts, key="k"):
    docs = [(i, t, "en", "s", 0) for i, t in enumerate(texts)]
    return [r for r in pseudonyms.pseudonymise(brute.documents(spark, docs), key).orderBy("doc_id").collect()]


def test_every_kind_keeps_its_format(spark):
    draw = random.Random(2)
    cards = [card(draw) for _ in range(60)]
    days = [date.fromordinal(date(1900, 1, 1).toordinal() + draw.randrange(73_049)) for _ in range(60)]
    ips = [str(ipaddress.IPv4Address(draw.getrandbits(32))) for _ in range(60)]
    ssns = [f"{draw.randrange(1, 665):03}-{draw.randrange(1, 100):02}-{draw.randrange(1, 10000):04}" for _ in range(60)]
    phones = [f"+1 ({draw.randrange(200, 999)}) 555-{draw.randrange(10000):04}" for _ in range(60)]
    texts = [
        f"Pay {c} or {c[:4]}-{c[4:8]}-{c[8:12]}-{c[12:]}$$ born {d.isoformat()}, {d:%d.%m.%Y} ip {i}### ssn {s}; call {p} {c}. mail Joe.{n}@Mail.example.com."
        for n, (c, d, i, s, p) in enumerate(zip(cards, days, ips, ssns, phones, strict=True))
    ]
    for row, text, c, d, i, s, p in zip(run(spark, texts), texts, cards, days, ips, ssns, phones, strict=True):
        kinds = [f.kind for f in row.found]
        assert kinds == ["card", "card", "date", "date", "ip", "ssn", "phone", "card", "email"]
        new = [f.pseudonym for f in row.found]
        assert luhn(new[0]) and len(new[0]) == 16 and new[1].replace("-", "") == new[0] == new[7]
        assert re.fullmatch(r"\d{4}(-\d{4}){3}", new[1])
        when = date.fromisoformat(new[2])
        assert 1900 <= when.year <= 2099 and f"{when:%d.%m.%Y}" == new[3]
        ipaddress.IPv4Address(new[4])
        assert re.fullmatch(r"\d{3}-(?!00)\d{2}-(?!0000)\d{4}", new[5]) and new[5][:3] == s[:3]
        assert re.fullmatch(r"\+1 \(\d{3}\) \d{3}-\d{4}", new[6])
        for secret in (c, d.isoformat(), i, s, p, "Joe."):
            assert secret not in row.text
        assert re.sub(r"[\w@]+", "", row.text).count(" ") == re.sub(r"[\w@]+", "", text).count(" ")


def test_the_mapping_is_one_to_one_and_keyed(spark):
    texts = [f"{i // 4:02}.{i % 4 + 1:02}.1999 and 10.0.{i}.7" for i in range(4, 100)]
    one, two = run(spark, texts), run(spark, texts, "other")
    flat = [f.pseudonym for r in one for f in r.found]
    assert len(set(flat)) == len(flat)
    assert [r.text for r in one] != [r.text for r in two]
    assert [r.text for r in run(spark, texts)] == [r.text for r in one]


def test_dates_with_slashes_are_one_to_one(spark):
    days = [date.fromordinal(date(1999, 1, 1).toordinal() + n) for n in range(1500)]
    texts = sorted({f"{d:%d/%m/%Y}" for d in days} | {f"{d:%m/%d/%Y}" for d in days})
    found = {t: r.found[0].pseudonym for t, r in zip(texts, run(spark, texts), strict=True)}
    assert len(set(found.values())) == len(texts)
    for old, new in found.items():
        assert re.fullmatch(r"\d\d/\d\d/\d{4}", new) and (old[3:5] > "12") == (new[3:5] > "12")


def test_what_fails_validation_stays(spark):
    texts = [
        "4111 1111 1111 1112 and 300.1.2.3 and 2023-02-30 and 000-12-3456 and 1.2.3.4.5",
        "no digits here",
        "12345678901234567890123",
        "version 1.2.3 of 2020",
        None,
        "",
        "x" * 100_000 + " 10.1.1.1",
    ]
    rows = run(spark, texts)
    assert [r.text for r in rows[:6]] == texts[:6]
    assert all(r.found == [] for r in rows[:6])
    assert rows[6].text.startswith("x" * 100_000 + " ") and len(rows[6].found) == 1


def test_odd_rows(spark):
    docs = brute.with_clashes(brute.documents(spark))
    rows = pseudonyms.pseudonymise(docs.drop("found"), "k")
    assert rows.count() == len(brute.ODD)
    assert pseudonyms.pseudonymise(brute.documents(spark, []), "k").collect() == []
    assert "Python" not in rows._jdf.queryExecution().toString()
