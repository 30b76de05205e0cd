"""Pseudonyms and secret scans against brute force; time that grows with the text alone."""

from __future__ import annotations

import hashlib
import math
import random
import re
import time
from collections import Counter
from datetime import date, timedelta

import pytest
from pyspark.sql import functions as F

from hazeline.llm import pseudonyms, queries, secret_scan
from hazeline.llm.matches import heads, located, replaced

SCHEMA = "doc_id long, text string, n_chars long, start string, kind string, _treated long, found long"


def _frame(spark, texts):
    rows = [(i, text, None if text is None else len(text), "s", None, 1, 2) for i, text in enumerate(texts)]
    return spark.createDataFrame(rows, SCHEMA)


# Brute force: secrets

def _entropy(window: str) -> float:
    return -sum(c / len(window) * math.log2(c / len(window)) for c in Counter(window).values())


def _peak(text: str, width: int) -> float:
    return max(_entropy(text[i:i + width]) for i in range(len(text) - width + 1))


def _secrets(text: str):
    base = []
    for m in re.finditer(secret_scan.ASSIGN, text, re.ASCII):
        if len(m[1]) >= 6:
            base.append((m.start(), 0, m.end()))
    base += [(m.start(), 1, m.end()) for m in re.finditer(secret_scan.ACCESS, text) if len(m[0]) >= 20]
    base += [(m.start(), 2, m.end()) for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 24]
    more = set()
    for one in secret_scan.CLASSES:
        for m in re.finditer(one.run, text):
            if (
                all(re.search(need, m[0]) for need in one.needs)
                and not any(re.search(known, m[0]) for known in secret_scan.ALLOWED)
                and _peak(m[0], one.window) >= one.bits
            ):
                more.add((m.start(), 3, m.end()))

    def written(spans):
        return ",".join(f"{secret_scan.KINDS[k]}:{a}:{b}" for a, k, b in sorted(spans))

    counts = [sum(s[1] == kind for s in base) for kind in range(3)]
    return *counts, hashlib.sha256(written(base).encode()).hexdigest(), written([*base, *more])


def _secret_texts():
    draw = random.Random(8)
    kinds = ["0123456789abcdef", "0123456789ABCDEF", "ABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789",
             "abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789+/_-", "ab1"]
    names = ["password", "PassWD", "api_key", "apikey", "Secret", "token", "AKIA", "é", "x"]
    joins = ["=", ": ", '" = "', "'", " ", "\n", "==", "-"]
    texts = []
    for _ in range(250):
        parts = []
        for _ in range(draw.randint(0, 12)):
            kind = draw.choice(kinds)
            parts += [draw.choice(names), draw.choice(joins), "".join(draw.choices(kind, k=draw.randint(1, 45)))]
            parts.append(draw.choice([" ", ", ", "=", "\U0001f600"]))
        texts.append("".join(parts))
    return [*texts, None, "", "é" * 50, texts[0], "AKIA" + "Z9" * 8, "AKIA" + "Z9" * 8 + "Q", "f" * 24, "token = abcde"]


def test_secrets_equal_brute_force(spark):
    texts = _secret_texts()
    found = secret_scan.digests(secret_scan.scanned(_frame(spark, texts))).collect()
    assert len(found) == len(texts) and sum(r.n_entropy for r in found) > 50
    for r in found:
        assert (r.n_assign, r.n_access, r.n_hex, r.base_sha256, r.spans) == _secrets(texts[r.doc_id] or ""), texts[r.doc_id]


def test_secrets_of_no_rows_and_null_ids(spark):
    assert secret_scan.digests(secret_scan.scanned(_frame(spark, []))).count() == 0
    one = spark.createDataFrame([(None, "f" * 24)] * 2, "doc_id long, text string")
    assert [(r.doc_id, r.n_hex) for r in secret_scan.digests(secret_scan.scanned(one)).collect()] == [(None, 1)] * 2


# Brute force: pseudonyms

def _prf(*parts) -> int:
    return int(hashlib.sha256("|".join(map(str, ("k", *parts))).encode()).hexdigest()[:15], 16)


def _feistel(tweak, left, right, u, v):
    for i in range(pseudonyms.ROUNDS):
        if i % 2 == 0:
            left = (left + _prf(tweak, i, right) % u) % u
        else:
            right = (right + _prf(tweak, i, left) % v) % v
    return left, right


def _digits(digits: str, kind: str) -> str:
    half = len(digits) // 2
    sizes = half, len(digits) - half
    out = _feistel(f"{kind}:{len(digits)}", int(digits[:half]), int(digits[half:]), *(10**n for n in sizes))
    return "".join(str(part).zfill(n) for part, n in zip(out, sizes))


def _refill(text: str, digits: str) -> str:
    turn = iter(digits)
    return "".join(next(turn) if c in "0123456789" else c for c in text)


def _luhn(digits: str) -> int:
    return sum(sum(divmod(int(d) * (1 + i % 2), 10)) for i, d in enumerate(reversed(digits))) % 10


FIRST = date(1800, 1, 1)
ALL_DAYS = [FIRST + timedelta(n) for n in range(146_097)]
LATE_DAYS = [day for day in ALL_DAYS if day.day > 12]


def _made(year, month, day):
    try:
        made = date(int(year), int(month), int(day))
    except ValueError:
        return None
    return made if 1800 <= made.year < 2200 else None


def _moved(days, place, tweak, u, v):
    left, right = _feistel(tweak, place % u, place // u, u, v)
    return days[right * u + left]


def _slash(text):
    x, y, year = text.split("/")
    first, second = _made(year, y, x), _made(year, x, y)
    if first:
        return _moved(ALL_DAYS, (first - FIRST).days, "date", 189, 773).strftime("%d/%m/%Y")
    if second:
        return _moved(LATE_DAYS, LATE_DAYS.index(second), "late date", 9, 9833).strftime("%m/%d/%Y")
    return None


def _pseudonym(text: str):
    """Kind and what stands there; (None, text) for a look-alike."""
    shape = {kind: re.fullmatch(p, text) for kind, p in pseudonyms.PATTERNS.items()}
    only = "".join(c for c in text if c in "0123456789")
    if "@" in text:
        whole = text.lower()
        local = hashlib.sha256(f"k|email|{whole}".encode()).hexdigest()[:20]
        return "email", f"u{local}@d{hashlib.sha256(f'k|domain|{whole.split("@")[-1]}'.encode()).hexdigest()[:12]}.invalid"
    if shape["date"]:
        if "/" in text:
            new = _slash(text)
        else:
            day = _made(*text.split("-"))
            new = day and _moved(ALL_DAYS, (day - FIRST).days, "date", 189, 773).isoformat()
        return ("date", new) if new else (None, text)
    if shape["ssn"]:
        a, g, n = map(int, text.split("-"))
        if a in (0, 666) or 0 in (g, n):
            return None, text
        left, right = _feistel("ssn", a - 1 - (a > 666), (g - 1) * 9999 + n - 1, 998, 99 * 9999)
        return "ssn", f"{left + 1 + (left >= 665):03d}-{right // 9999 + 1:02d}-{right % 9999 + 1:04d}"
    if shape["ip"]:
        o = [int(x) for x in text.split(".")]
        if max(o) > 255:
            return None, text
        left, right = _feistel("ip", o[0] * 256 + o[1], o[2] * 256 + o[3], 65536, 65536)
        return "ip", ".".join(map(str, (*divmod(left, 256), *divmod(right, 256))))
    if shape["card"] and not shape["phone"]:
        if _luhn(only):
            return None, text
        body = _digits(only[:-1], "card")
        return "card", _refill(text, body + str(-_luhn(body + "0") % 10))
    if shape["phone"]:
        code = (re.match(r"(\+[0-9]{1,3})[ .(-]", text) or [None, ""])[1]
        rest = text[len(code):]
        return "phone", code + _refill(rest, _digits("".join(c for c in rest if c.isdigit()), "phone"))
    return None, text


def _pii_texts():
    draw = random.Random(7)

    def digits(n):
        return "".join(draw.choices("0123456789", k=n))

    def card():
        body = digits(draw.choice([12, 13, 15, 15, 18]))
        number = body + (str(-_luhn(body + "0") % 10) if draw.random() < 0.8 else digits(1))
        return draw.choice(["", " ", "-"]).join(number[i:i + 4] for i in range(0, len(number), 4))

    makers = [
        card,
        lambda: draw.choice(["a.b+c@Mail.example.org", "x_1@y-z.co", "q@r.s.t9", "bad@host", "@x.com", "z@1.2.3.org5"]),
        lambda: draw.choice(["+49 ", "+1-", "(", "+1"]) + f"{digits(3)}) {digits(3)}-{digits(4)}",
        lambda: f"{digits(3)}{draw.choice('.-')}{digits(3)}{draw.choice('.-')}{digits(4)}",
        lambda: f"+{digits(2)} {digits(3)} {digits(4)} {digits(4)}",
        lambda: f"{draw.randint(1790, 2210)}-{draw.randint(0, 13):02d}-{draw.randint(0, 32):02d}",
        lambda: f"{draw.randint(0, 32):02d}/{draw.randint(0, 32):02d}/{draw.randint(1790, 2210)}",
        lambda: f"{draw.choice(['000', '666', '665', '667', digits(3)])}-{draw.choice(['00', digits(2)])}-{digits(4)}",
        lambda: ".".join(str(draw.randint(0, 270)) for _ in range(4)),
        lambda: digits(draw.randint(1, 22)),
    ]
    texts = ["".join(draw.choice(makers)() + draw.choice([" ", ", ", "é ", "\n", ".", "x "]) for _ in range(draw.randint(0, 15)))
             for _ in range(300)]
    return [*texts, texts[0], None, "", "nothing here"]


def test_pseudonyms_equal_brute_force(spark):
    texts = _pii_texts()
    frame = _frame(spark, texts)
    both = pseudonyms.pseudonymised(frame, "k", found_as="finds")
    assert both.columns == [*frame.columns, "finds"]
    seen = Counter()
    for r in both.collect():
        text = texts[r.doc_id]
        if text is None:
            assert (r.text, r.n_chars, r.finds) == (None, None, [])
            continue
        spans = []
        for m in re.finditer(pseudonyms.ANY, text):
            kind, _ = _pseudonym(m[0])
            if kind:
                spans.append((kind, m.start(), m.end()))
        assert [tuple(f) for f in r.finds] == spans, text
        assert r.text == re.sub(pseudonyms.ANY, lambda m: _pseudonym(m[0])[1], text), text
        assert (r.n_chars, r.start, r._treated, r.found) == (len(r.text), "s", 1, 2)
        seen.update(kind for kind, _, _ in spans)
    assert min(seen[kind] for kind in pseudonyms.KINDS) >= 20
    plain = pseudonyms.pseudonymised(frame, "k")
    assert plain.exceptAll(both.drop("finds")).count() == 0 and plain.count() == len(texts)


def test_no_two_dates_share_a_pseudonym(spark):
    days = spark.range(3 * 366).select(F.date_add(F.lit("2015-12-31").cast("date"), F.col("id").cast("int")).alias("d"))
    texts = days.select(F.explode(F.array(*[F.date_format("d", f) for f in ("dd/MM/yyyy", "MM/dd/yyyy", "yyyy-MM-dd")])).alias("t")).distinct()
    moved = texts.select("t", pseudonyms.pseudonym(F.col("t"), "k").alias("p"))
    assert moved.select("p").distinct().count() == texts.count()
    # What comes out is again a date of the same format.
    again = moved.select(pseudonyms.kind_of(F.col("p")).alias("kind")).distinct().collect()
    assert [r.kind for r in again] == ["date"]


def test_late_days_are_permuted_as_a_whole(spark):
    days = spark.createDataFrame([(day.strftime("%m/%d/%Y"),) for day in LATE_DAYS], "t string").repartition(8)
    moved = days.select(pseudonyms.pseudonym(F.col("t"), "k").alias("p"))
    assert days.count() == 9 * 9833 and days.exceptAll(moved).count() == 0


def test_security_numbers_stay_valid(spark):
    numbers = spark.range(40_000).select(F.concat_ws(
        "-", F.lpad((F.col("id") % 998 + 1 + F.when(F.col("id") % 998 >= 665, 1).otherwise(0)).cast("string"), 3, "0"),
        F.lpad((F.col("id") % 99 + 1).cast("string"), 2, "0"), F.lpad((F.col("id") % 9999 + 1).cast("string"), 4, "0"),
    ).alias("t"))
    moved = numbers.select(pseudonyms.pseudonym(F.col("t"), "k").alias("p"))
    assert moved.filter(pseudonyms.kind_of(F.col("p")) == "ssn").distinct().count() == 40_000


# Very long texts

@pytest.mark.parametrize("n", [1, 2, 63, 64, 65, 4096, 4097, 9000])
def test_heads(spark, n):
    sizes = [(i * 7) % 11 for i in range(n)]
    got = spark.createDataFrame([(sizes,)], "s array<int>").select(heads(F.col("s")).alias("h")).first().h
    assert got == [sum(sizes[:i]) for i in range(n)] if n < 100 else (got[-1] == sum(sizes[:-1]) and len(got) == n)


def _seconds(frame, column) -> float:
    frame.select(F.hash(column)).collect()
    start = time.perf_counter()
    frame.select(F.hash(column)).collect()
    return time.perf_counter() - start


@pytest.mark.parametrize("what", ["located", "replaced", "entropy"])
def test_time_grows_with_the_text(spark, what):
    draw = random.Random(5)

    def cost(n):
        if what == "entropy":
            text = "".join(draw.choices("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/", k=n))
            column = secret_scan.peak_entropy(F.col("t"), 20)
        else:
            text = "x1 " * n
            column = located(F.col("t"), "[0-9]") if what == "located" else replaced(F.col("t"), "[0-9]", lambda m: F.concat(m, m))
        return _seconds(spark.createDataFrame([(text,)], "t string"), column)

    small, large = cost(16_000), cost(160_000)
    assert large < 30 * max(small, 0.1), (small, large)


def test_very_long_runs_do_not_break_a_scan(spark):
    texts = ["a-" * 100_000 + "B1", "q@" + "b." * 100_000 + "com", "1-" * 100_000, "Aa1/" * 50_000, "+1 " * 60_000]
    rows = secret_scan.digests(secret_scan.scanned(_frame(spark, texts))).collect()
    assert len(rows) == 5
    assert pseudonyms.pseudonymised(_frame(spark, texts), "k", found_as="f").select(F.sum(F.length("text"))).first()[0] > 0


def test_query_counts_finds(spark):
    out = queries.op7_feistel_pseudonyms(spark, "/root/testdata/sf0.001")
    docs = queries.documents(spark, "/root/testdata/sf0.001")
    n = {r.doc_id: r.n_email for r in out.collect()}
    for r in docs.collect():
        assert n[r.doc_id] == sum("@" in m[0] for m in re.finditer(pseudonyms.ANY, r.text or ""))
