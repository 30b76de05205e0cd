"""Format-preserving pseudonyms for personal data.

Matches of a known shape are validated (check digit, octets, calendar) and replaced by a
keyed permutation of their own format: a Feistel network over the digits, with SHA-256 of key,
round and half as round function. Equal values get equal pseudonyms in every document, and
different values of a format never meet. Separators, country codes and number of digits stay.
Cards keep a right check digit; numbers of social security stay outside areas 000 and 666, group 00
and serial 0000. Dates run over the 400 Gregorian years from 1800, a domain of 189 * 773 days, so
no value has to be walked back into range. A slash date is read day first; one that can only be
month first (its day is above 12) is a format of its own, permuted among the 9 * 9833 such days, so
no two texts share a pseudonym. Mail addresses have no number format; both halves become keyed
digests.

Built-in functions only: a scan and one projection. Defined results: a null text stays null
and an empty one empty, with no finds; text around the matches is untouched; all other
columns pass through, whatever they hold; repeated rows give repeated rows and an empty table an
empty one.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hazeline.llm.bind import bind, free_name
from hazeline.llm.matches import located, pieces, rejoined, replaced, spans_of

ROUNDS = 8
EPOCH, SMALL, LARGE = "1800-01-01", 189, 773
# Days above the 12th of a month, in the 4,800 months from the epoch: 9 * 9833.
LATE_SMALL, LATE_LARGE, MONTHS = 9, 9833, 4800
AREAS, GROUPS, SERIALS = 998, 99, 9999

PATTERNS = {
    "email": r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]++@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+){0,126}\.[A-Za-z]{2,}",  # a name has at most 127 labels
    "phone": r"(?<![0-9A-Za-z+])\+[0-9]{1,3}[ .-]?\(?[0-9]{2,4}\)?[ .-]?[0-9]{3,4}[ .-]?[0-9]{3,4}(?![0-9])"
    r"|(?<![0-9A-Za-z])\([0-9]{3}\) ?[0-9]{3}[.-][0-9]{4}(?![0-9])"
    r"|(?<![0-9A-Za-z.-])[0-9]{3}[.-][0-9]{3}[.-][0-9]{4}(?![0-9]|[.-][0-9])",
    "date": r"(?<![0-9A-Za-z/.-])[0-9]{4}-[0-9]{2}-[0-9]{2}(?![0-9A-Za-z]|[/.-][0-9])"
    r"|(?<![0-9A-Za-z/.-])[0-9]{2}/[0-9]{2}/[0-9]{4}(?![0-9A-Za-z]|[/.-][0-9])",
    "ssn": r"(?<![0-9A-Za-z-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9A-Za-z]|-[0-9])",
    "ip": r"(?<![0-9A-Za-z.])[0-9]{1,3}(?:\.[0-9]{1,3}){3}(?![0-9A-Za-z]|\.[0-9])",
    "card": r"(?<![0-9A-Za-z])[0-9](?:[ -]?[0-9]){12,18}(?![0-9A-Za-z])",
}
KINDS = tuple(PATTERNS)
#: Any of the shapes, in one pass; the first that fits a place wins.
ANY = "|".join(f"(?:{p})" for p in PATTERNS.values())


def _prf(key: str, *parts: Column) -> Column:
    """60 bits of SHA-256 as a number."""
    text = F.concat_ws("|", F.lit(key), *[p.cast("string") for p in parts])
    return F.conv(F.substring(F.sha2(text, 256), 1, 15), 16, 10).cast("bigint")


def feistel(key: str, tweak: Column, left: Column, right: Column, u: Column, v: Column) -> Column:
    """struct<l, r>: a permutation of the pairs with l below u and r below v."""

    def step(acc: Column, i: Column) -> Column:
        return F.when(
            i % 2 == 0,
            F.struct(((acc["l"] + _prf(key, tweak, i, acc["r"]) % u) % u).alias("l"), acc["r"].alias("r")),
        ).otherwise(
            F.struct(acc["l"].alias("l"), ((acc["r"] + _prf(key, tweak, i, acc["l"]) % v) % v).alias("r"))
        )

    start = F.struct(left.cast("bigint").alias("l"), right.cast("bigint").alias("r"))
    return F.aggregate(F.sequence(F.lit(0), F.lit(ROUNDS - 1)), start, step)


def permuted_digits(digits: Column, key: str, kind: str) -> Column:
    """Another string of as many digits (2 to 20)."""
    size = F.length(digits)
    half = F.floor(size / 2).cast("int")

    def power(n: Column) -> Column:
        return F.rpad(F.lit("1"), n + 1, F.lit("0")).cast("bigint")

    tweak = F.concat(F.lit(f"{kind}:"), size.cast("string"))
    halves = feistel(
        key, tweak,
        F.substring(digits, F.lit(1), half), F.substring(digits, half + 1, size - half),
        power(half), power(size - half),
    )
    return bind(
        halves,
        lambda h: F.concat(
            F.lpad(h["l"].cast("string"), half, F.lit("0")),
            F.lpad(h["r"].cast("string"), size - half, F.lit("0")),
        ),
    )


def luhn(digits: Column) -> Column:
    """Luhn sum modulo 10; 0 for a valid number."""
    turned = F.split(F.reverse(digits), "")
    doubled = F.transform(
        turned,
        lambda d, i: F.when(i % 2 == 0, d.cast("int")).otherwise(
            d.cast("int") * 2 - F.when(d.cast("int") > 4, 9).otherwise(0)
        ),
    )
    return F.aggregate(doubled, F.lit(0), lambda total, d: total + F.coalesce(d, F.lit(0))) % 10


def _digits(text: Column) -> Column:
    return F.regexp_replace(text, "[^0-9]", "")


def _refilled(text: Column, digits: Column) -> Column:
    """The text with its digits replaced, one by one, by others."""
    state = F.struct(F.lit(0).alias("at"), F.lit("").alias("out"))

    def step(acc: Column, char: Column) -> Column:
        is_digit = char.between("0", "9")
        return F.struct(
            (acc["at"] + F.when(is_digit, 1).otherwise(0)).alias("at"),
            F.concat(
                acc["out"], F.when(is_digit, F.substring(digits, acc["at"] + 1, F.lit(1))).otherwise(char)
            ).alias("out"),
        )

    return F.aggregate(F.split(text, ""), state, step, lambda acc: acc["out"])


def _card(text: Column, key: str) -> Column:
    body = bind(_digits(text), lambda d: permuted_digits(F.substring(d, F.lit(1), F.length(d) - 1), key, "card"))
    whole = bind(
        body,
        lambda b: F.concat(b, ((F.lit(10) - luhn(F.concat(b, F.lit("0")))) % 10).cast("string")),
    )
    return bind(whole, lambda d: _refilled(text, d))


def _phone(text: Column, key: str) -> Column:
    code = F.regexp_extract(text, r"^(\+[0-9]{1,3})[ .(-]", 1)
    rest = F.substring(text, F.length(code) + 1, F.length(text))
    return bind(
        F.struct(code.alias("code"), rest.alias("rest")),
        lambda x: F.concat(
            x["code"], _refilled(x["rest"], permuted_digits(_digits(x["rest"]), key, "phone"))
        ),
    )


def _octets(text: Column) -> Column:
    return F.transform(F.split(text, r"\."), lambda o: o.try_cast("bigint"))


def _ip(text: Column, key: str) -> Column:
    def moved(o: Column) -> Column:
        halves = feistel(
            key, F.lit("ip"),
            F.get(o, F.lit(0)) * 256 + F.get(o, F.lit(1)), F.get(o, F.lit(2)) * 256 + F.get(o, F.lit(3)),
            F.lit(65_536), F.lit(65_536),
        )
        return bind(
            halves,
            lambda h: F.concat_ws(
                ".",
                *[x.cast("int").cast("string") for x in (F.floor(h["l"] / 256), h["l"] % 256, F.floor(h["r"] / 256), h["r"] % 256)],
            ),
        )

    return bind(_octets(text), moved)


def _day(text: Column) -> Column:
    """The date that the text names: ISO, else day first, else month first."""
    return F.coalesce(
        F.try_to_date(F.when(text.like("____-__-__"), text), "yyyy-MM-dd"),
        F.try_to_date(F.when(text.like("__/__/____"), text), "dd/MM/yyyy"),
        F.try_to_date(F.when(text.like("__/__/____"), text), "MM/dd/yyyy"),
    )


def _month_first(text: Column) -> Column:
    """Whether a slash date can't be read day first."""
    return F.try_to_date(F.when(text.like("__/__/____"), text), "dd/MM/yyyy").isNull() & text.contains("/")


def _any_day(day: Column, key: str) -> Column:
    """Another of the days from 1800 to 2199."""
    epoch = F.lit(EPOCH).cast("date")
    moved = bind(
        F.date_diff(day, epoch).cast("bigint"),
        lambda n: feistel(
            key, F.lit("date"), n % SMALL, F.floor(n / SMALL), F.lit(SMALL), F.lit(LARGE)
        ),
    )
    return bind(moved, lambda m: F.date_add(epoch, (m["r"] * SMALL + m["l"]).cast("int")))


def _late_day(day: Column, key: str) -> Column:
    """Another of the days from 1800 to 2199 that lie after the 12th of their month."""
    epoch = F.lit(EPOCH).cast("date")

    def before(month: Column) -> Column:
        # Such days in the months before this one, counted from the epoch.
        return F.date_diff(F.add_months(epoch, month), epoch) - month * 12

    month = (F.year(day) - 1800) * 12 + F.month(day) - 1
    moved = bind(
        (before(month) + F.dayofmonth(day) - 13).cast("bigint"),
        lambda n: feistel(
            key, F.lit("late date"), n % LATE_SMALL, F.floor(n / LATE_SMALL), F.lit(LATE_SMALL), F.lit(LATE_LARGE)
        ),
    )

    def named(n: Column) -> Column:
        # Months are so alike that the mean finds the right one or a neighbour.
        guess = F.floor(n * MONTHS / (LATE_SMALL * LATE_LARGE)).cast("int")
        near = [F.least(F.greatest(guess + step, F.lit(0)), F.lit(MONTHS - 1)) for step in (-1, 0, 1)]
        found = F.array_max(F.filter(F.array(*near), lambda m: before(m) <= n))
        return bind(found, lambda m: F.date_add(F.add_months(epoch, m), (n - before(m) + 12).cast("int")))

    return bind(bind(moved, lambda m: (m["r"] * LATE_SMALL + m["l"]).cast("int")), named)


def _date(text: Column, key: str) -> Column:
    return bind(
        _day(text),
        lambda day: F.when(text.contains("-"), F.date_format(_any_day(day, key), "yyyy-MM-dd"))
        .when(_month_first(text), F.date_format(_late_day(day, key), "MM/dd/yyyy"))
        .otherwise(F.date_format(_any_day(day, key), "dd/MM/yyyy")),
    )


def _ssn(text: Column, key: str) -> Column:
    area, group, serial = (F.split_part(text, F.lit("-"), F.lit(n)).cast("bigint") for n in (1, 2, 3))
    place = area - 1 - F.when(area > 666, 1).otherwise(0)
    halves = feistel(
        key, F.lit("ssn"), place, (group - 1) * SERIALS + serial - 1, F.lit(AREAS), F.lit(GROUPS * SERIALS)
    )

    def padded(number: Column, width: int) -> Column:
        return F.lpad(number.cast("bigint").cast("string"), width, "0")

    return bind(
        halves,
        lambda h: F.concat_ws(
            "-",
            padded(h["l"] + 1 + F.when(h["l"] >= 665, 1).otherwise(0), 3),
            padded(F.floor(h["r"] / SERIALS) + 1, 2),
            padded(h["r"] % SERIALS + 1, 4),
        ),
    )


def _email(text: Column, key: str) -> Column:
    whole = F.lower(text)
    return F.concat(
        F.lit("u"), F.substring(F.sha2(F.concat(F.lit(f"{key}|email|"), whole), 256), 1, 20),
        F.lit("@d"),
        F.substring(F.sha2(F.concat(F.lit(f"{key}|domain|"), F.substring_index(whole, "@", -1)), 256), 1, 12),
        F.lit(".invalid"),
    )


def kind_of(text: Column) -> Column:
    """Which kind a match is, validated; null for a look-alike, which stays as it is."""
    day = _day(text)
    dated = F.year(day).between(1800, 2199)
    octets = _octets(text)

    def whole(name: str) -> Column:
        return text.rlike(f"^(?:{PATTERNS[name]})$")

    return (
        F.when(text.contains("@"), F.lit("email"))
        .when(whole("date"), F.when(dated, F.lit("date")))
        .when(whole("ssn"), F.when(~text.rlike(r"^(?:000|666)|-00-|-0000$"), F.lit("ssn")))
        .when(whole("ip"), F.when(F.forall(octets, lambda o: o <= 255), F.lit("ip")))
        # A plain run of digits is a card; a phone number has a plus, a bracket or marks.
        .when(whole("card") & ~whole("phone"), F.when(bind(_digits(text), luhn) == 0, F.lit("card")))
        .when(whole("phone"), F.lit("phone"))
    )


def pseudonym(text: Column, key: str) -> Column:
    """What stands in the place of a match."""

    def of(kind: Column) -> Column:
        return (
            F.when(kind == "email", _email(text, key))
            .when(kind == "date", _date(text, key))
            .when(kind == "ssn", _ssn(text, key))
            .when(kind == "ip", _ip(text, key))
            .when(kind == "card", _card(text, key))
            .when(kind == "phone", _phone(text, key))
            .otherwise(text)
        )

    return bind(kind_of(text), of)


def _kinds(matches: Column) -> Column:
    return F.filter(
        F.transform(
            matches,
            lambda m: F.struct(kind_of(m["text"]).alias("kind"), m["start"].alias("start"), m["end"].alias("end")),
        ),
        lambda m: m["kind"].isNotNull(),
    )


def found(text: Column) -> Column:
    """array<struct<kind, start, end>> of the validated matches."""
    return _kinds(located(text, ANY))


def treated(text: Column, key: str) -> Column:
    """struct<text, found>: the protected text and the matches that were in it, in one pass."""

    def both(x: Column) -> Column:
        return F.struct(
            rejoined(x, lambda match: pseudonym(match, key)).alias("text"), _kinds(spans_of(x)).alias("found")
        )

    nothing = F.array().cast("array<struct<kind:string,start:int,end:int>>")
    untouched = F.struct(text.alias("text"), nothing.alias("found"))
    return F.when(text.rlike(ANY), bind(pieces(text, ANY), both)).otherwise(untouched)


def protected(text: Column, key: str) -> Column:
    return replaced(text, ANY, lambda match: pseudonym(match, key))


def pseudonymised(docs: DataFrame, key: str, found_as: str | None = None) -> DataFrame:
    """The same rows and columns, the text protected and `n_chars`, where present, brought up;
    `found_as` names a further column for the matches."""
    if found_as is None:
        out = docs.withColumn("text", protected(F.col("text"), key))
    else:
        whole = free_name(docs, "_treated")
        both = docs.withColumn(whole, treated(F.col("text"), key))
        out = both.withColumn("text", F.col(f"{whole}.text")).withColumn(found_as, F.col(f"{whole}.found")).drop(whole)
    if "n_chars" in docs.columns:
        # The text is a heavy expression: counting in a second projection keeps it single.
        out = out.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))
    return out
