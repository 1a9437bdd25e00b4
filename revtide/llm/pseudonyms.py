"""Format-preserving pseudonyms for personal data, in DataFrame and SQL functions only.

Card numbers (Luhn), US social security numbers, telephone numbers, IPv4 addresses and dates are
found by pattern and validated; each valid value is permuted within its own format by a keyed
Feistel network, so that equal values stay equal in all documents and a pseudonym passes the same
validation as its original: separators, length and leading digits stay, a card number gets the
check digit of its new digits, a date is a date between the same two years. Where a permuted value
is not valid it is permuted again until it is (cycle walking), which keeps the mapping one to one.
The local part of an e-mail address is replaced by a keyed digest of the address.

The rounds use SHA-256 over the key. The key is a literal of the plan, so plans and event logs of
these queries are as secret as the key.

Cases: a NULL text stays NULL with no counts; texts without finds pass unchanged. NULL ``doc_id``
and repeated rows are kept as they are. An empty table gives an empty result. Matches that fail
their validation stay as they are.
"""

from __future__ import annotations

import hashlib

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from revtide.llm.common import others_aside

ROUNDS = 8
#: Rounds of cycle walking; at most two in five values are invalid in a format (dates of months before days).
WALKS = 48
FIRST_DAY, DAYS = "1900-01-01", 73_049  # up to 2099-12-31
#: Only texts with one of these can hold a find.
HINT = "[0-9@]"

EMAIL = r"(?<![\w.+-])[\w.+-]++@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+"
IPV4 = r"(?<![\w.])\d{1,3}(?:\.\d{1,3}){3}(?![\d]|\.\d)"
CARD = r"(?<![\w.-])(?:\d{13,19}|\d{4}(?:[ -]\d{4}){3}|\d{4}[ -]\d{6}[ -]\d{5})(?![\d]|-\d)"
DATE = r"(?<![\w./-])(?:\d{4}-\d{2}-\d{2}|\d{2}/\d{2}/\d{4}|\d{2}\.\d{2}\.\d{4})(?![\d]|[./-]\d)"
SSN = r"(?<![\w-])\d{3}-\d{2}-\d{4}(?![\d]|-\d)"
PHONE = (
    r"(?<![\w+])(?:\+\d{1,3}[ .-]?)?\(\d{2,4}\)[ .-]?\d{3,4}[ .-]?\d{3,4}(?!\d)"
    r"|(?<![\w+])\+\d{1,3}(?:[ .-]?\d{2,4}){2,4}(?!\d)"
    r"|(?<![\w.-])\d{3}[.-]\d{3}[.-]\d{4}(?![\d]|-\d)"
)
FIND = "|".join((EMAIL, IPV4, CARD, DATE, SSN, PHONE))
KINDS = ("email", "ip", "card", "date", "ssn", "phone")


def _sql_text(pattern: str) -> str:
    return "'" + pattern.replace("\\", "\\\\").replace("'", "\\'") + "'"


def feistel(value: str, high: str, low: str, tweak: str, key: str) -> str:
    """SQL: ``value`` below ``high * low`` permuted by ``ROUNDS`` keyed rounds on its two halves."""
    digest = (
        f"cast(conv(substr(sha2(concat_ws(':', '{key}', {tweak}, r, if(r % 2 = 0, s.b, s.a)), 256), 1, 15), 16, 10) as bigint)"
    )
    step = (
        f"if(r % 2 = 0, named_struct('a', (s.a + {digest}) % {high}, 'b', s.b),"
        f" named_struct('a', s.a, 'b', (s.b + {digest}) % {low}))"
    )
    start = f"named_struct('a', cast({value} as bigint) div {low}, 'b', cast({value} as bigint) % {low})"
    return f"aggregate(sequence(0, {ROUNDS - 1}), {start}, (s, r) -> {step}, s -> s.a * {low} + s.b)"


def _walked(value: str, high: str, low: str, tweak: str, key: str, valid: str) -> str:
    """SQL: permuted until ``valid``, a condition on the number ``w``, holds."""
    once = feistel("w", high, low, tweak, key)
    first = feistel(value, high, low, tweak, key)
    return f"aggregate(sequence(1, {WALKS}), {first}, (w, i) -> if({valid}, w, {once}))"


def _power(digits: str) -> str:
    return f"cast(power(10, {digits}) as bigint)"


def _digits_permuted(digits: str, keep: int, tweak: str, key: str) -> str:
    """SQL: a string of digits with all but the first ``keep`` permuted."""
    rest = f"substr({digits}, {keep + 1})"
    n = f"length({rest})"
    return (
        f"concat(substr({digits}, 1, {keep}), lpad(cast("
        + feistel(f"cast({rest} as bigint)", _power(f"{n} div 2"), _power(f"({n} - {n} div 2)"), tweak, key)
        + f" as string), {n}, '0'))"
    )


def _luhn_sum(digits: str, shift: int) -> str:
    """SQL: the Luhn sum; ``shift`` 0 for a number with its check digit, 1 for one without."""
    doubled = "if(int(c) > 4, int(c) * 2 - 9, int(c) * 2)"
    each = f"transform(split(reverse({digits}), ''), (c, i) -> if((i + {shift}) % 2 = 1, {doubled}, int(c)))"
    return f"aggregate({each}, 0, (t, d) -> t + d)"


def _in_format(original: str, digits: str) -> str:
    """SQL: ``digits`` put where ``original`` has digits."""
    return (
        f"array_join(transform(split({original}, ''), (c, i) -> if(c >= '0' and c <= '9',"
        f" substr({digits}, length(regexp_replace(substr({original}, 1, i + 1), '[^0-9]', '')), 1), c)), '')"
    )


def _days(original: str) -> str:
    parsed = (
        f"case when {original} like '____-__-__' then try_to_date({original}, 'yyyy-MM-dd')"
        f" when {original} like '__/__/____' then coalesce(try_to_date({original}, 'dd/MM/yyyy'), try_to_date({original}, 'MM/dd/yyyy'))"
        f" else try_to_date({original}, 'dd.MM.yyyy') end"
    )
    return f"datediff({parsed}, date'{FIRST_DAY}')"


def pseudonym_sql(key: str) -> tuple[str, str]:
    """SQL over a match ``m``: its kind (NULL if it fails validation); over ``m`` and its kind ``k``: its pseudonym."""
    digits = "regexp_replace(m, '[^0-9]', '')"
    whole = {k: f"m rlike {_sql_text('^(?:' + p + ')$')}" for k, p in zip(KINDS, (EMAIL, IPV4, CARD, DATE, SSN, PHONE), strict=True)}
    octets = "forall(split(m, '[.]'), o -> int(o) <= 255)"
    area = f"substr({digits}, 1, 3)"
    kind = (
        f"case when {whole['email']} then 'email'"
        f" when {whole['ip']} then if({octets}, 'ip', null)"
        f" when {whole['card']} then if({_luhn_sum(digits, 0)} % 10 = 0, 'card', null)"
        f" when {whole['date']} then if({_days('m')} between 0 and {DAYS - 1}, 'date', null)"
        f" when {whole['ssn']} then if({area} not in ('000', '666') and {area} < '900'"
        f" and substr({digits}, 4, 2) <> '00' and substr({digits}, 6) <> '0000', 'ssn', null)"
        f" when length({digits}) between 7 and 15 then 'phone' end"
    )
    number = "aggregate(split(m, '[.]'), 0L, (t, o) -> t * 256 + int(o))"
    ip = feistel(number, "65536L", "65536L", "'ip'", key)
    card_head = _digits_permuted(f"substr({digits}, 1, length({digits}) - 1)", 1, f"concat('card', length({digits}))", key)
    card_check = f"(10 - {_luhn_sum('h', 1)} % 10) % 10"
    card = f"transform(transform(array({card_head}), h -> concat(h, {card_check})), h -> {_in_format('m', 'h')})[0]"
    ssn_rest = _walked(
        f"cast(substr({digits}, 4) as bigint)", "1000L", "1000L", f"concat('ssn', {area})", key,
        "w % 10000 <> 0 and w div 10000 <> 0",
    )
    ssn = f"transform(array(lpad(cast({ssn_rest} as string), 6, '0')), h -> concat(substr(m, 1, 4), substr(h, 1, 2), '-', substr(h, 3)))[0]"
    # 04/17/2001 can only be month before day: its pseudonym must not read as day before month, which other originals map to.
    month_first = "substr(m, 3, 1) = '/' and substr(m, 4, 2) > '12'"
    apart = f"(not ({month_first}) or day(date_add(date'{FIRST_DAY}', int(w))) > 12)"
    day = _walked(_days("m"), "271L", "270L", "'date'", key, f"w < {DAYS} and {apart}")
    pattern = (
        "case when m like '____-__-__' then 'yyyy-MM-dd' when m like '__.__.____' then 'dd.MM.yyyy'"
        " when try_to_date(m, 'dd/MM/yyyy') is not null then 'dd/MM/yyyy' else 'MM/dd/yyyy' end"
    )
    date = f"date_format(date_add(date'{FIRST_DAY}', int({day})), {pattern})"
    phone_digits = _digits_permuted(digits, 2, f"concat('phone', length({digits}))", key)
    phone = f"transform(array({phone_digits}), h -> {_in_format('m', 'h')})[0]"
    email = f"concat('u', substr(sha2(concat_ws(':', '{key}', 'email', lower(m)), 256), 1, 12), substr(m, instr(m, '@')))"
    ip_text = f"transform(array({ip}), v -> concat_ws('.', v div 16777216, v div 65536 % 256, v div 256 % 256, v % 256))[0]"
    pseudonym = (
        f"case k when 'email' then {email} when 'ip' then {ip_text} when 'card' then {card}"
        f" when 'date' then {date} when 'ssn' then {ssn} when 'phone' then {phone} else m end"
    )
    return kind, pseudonym


def pseudonymise(docs: DataFrame, key: str) -> DataFrame:
    """The rows and columns of ``docs`` with ``text`` pseudonymised, and ``found``.

    ``found`` is an array of ``kind`` and ``pseudonym`` of the values that were replaced, in text order; a column
    ``found`` of ``docs`` gives way to it.
    """
    return others_aside(lambda own: _replaced(own, key), docs)


def _replaced(docs: DataFrame, key: str) -> DataFrame:
    secret = hashlib.sha256(key.encode()).hexdigest()
    kind, pseudonym = pseudonym_sql(secret)
    has = F.col("text").rlike(HINT)
    matched = docs.withColumn(
        "_matches", F.when(has, F.regexp_extract_all("text", F.lit(FIND), 0))
    ).withColumn("_matches", F.when(F.size("_matches") > 0, F.col("_matches")))
    named = matched.withColumn("_kinds", F.expr(f"transform(_matches, m -> {kind})")).withColumn(
        "_new", F.expr(f"zip_with(_matches, _kinds, (m, k) -> named_struct('kind', k, 'pseudonym', {pseudonym}))")
    )
    rebuilt = F.expr(
        f"array_join(zip_with(split(text, {_sql_text(FIND)}, -1), transform(_new, e -> e.pseudonym),"
        " (gap, p) -> concat(gap, coalesce(p, ''))), '')"
    )
    return named.withColumns(
        {
            "text": F.when(F.col("_new").isNotNull(), rebuilt).otherwise(F.col("text")),
            "found": F.coalesce(
                F.expr("filter(_new, e -> e.kind is not null)"),
                F.expr("cast(array() as array<struct<kind: string, pseudonym: string>>)"),
            ),
        }
    ).select(*docs.columns, "found")

