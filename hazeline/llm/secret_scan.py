"""Secret scans: known shapes, and windows of high entropy in candidate strings.

Known shapes are found by pattern. Candidate strings are runs of one character class; over
each, a window slides by a character and its Shannon entropy follows from the counts of the
character that enters and the one that leaves: with S the sum of c * log2(c) over the
window's counts c, the entropy is log2(w) - S / w, and S changes by two terms a step. A
string is reported where its best window reaches the class's threshold and the allow-list
does not know it. The allow-list never touches the known shapes.

Built-in functions only: a scan and one projection, linear in a text's length and its matches.
Defined results: a null text is an empty one and has no spans; an empty table gives none; a null
doc_id stays; repeated rows give repeated results; other columns play no part. Places are in code
points.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hazeline.llm.bind import bind
from hazeline.llm.matches import located

ASSIGN = (
    r"""(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
)
ACCESS = r"AKIA[A-Z0-9]+"
HEX = r"[0-9a-f]{24,}"  # the runs of hex digits that are long enough
KINDS = ("assign", "access", "hex", "entropy")


@dataclass(frozen=True)
class CharClass:
    """Runs that are candidates, what they must hold, and the entropy a window must reach."""

    name: str
    run: str
    needs: tuple[str, ...]
    window: int
    bits: float


CLASSES = (
    CharClass("base64", r"(?<![A-Za-z0-9+/_-])[A-Za-z0-9+/_-]{24,}+={0,2}", ("[A-Z]", "[a-z]", "[0-9]"), 20, 3.7),
    CharClass("upper", r"(?<![A-Za-z0-9])[A-Z0-9]{20,}+(?![A-Za-z0-9])", ("[A-Z]", "[0-9]"), 20, 3.3),
    CharClass("hex", r"(?<![A-Za-z0-9])[0-9A-F]{24,}+(?![A-Za-z0-9])", ("[A-F]", "[0-9]"), 20, 2.8),
)

#: Strings that look random and are none: counting up, alphabets, sample values, links' paths.
ALLOWED = (
    r"(?i)0123456789|abcdefghij|(.)\1{5,}|example|sample|placeholder|xxxx",
    r"^[A-Za-z]++(?:[-_/][A-Za-z]++)++$",
    r"^[0-9a-fA-F]{8}-[0-9a-fA-F]{4}-[0-9a-fA-F]{4}-[0-9a-fA-F]{4}-[0-9a-fA-F]{12}$",
)


def _weight(c: Column) -> Column:
    return F.when(c > 1, c * F.log2(c.cast("double"))).otherwise(F.lit(0.0))


def _with(counts: Column, place: Column, value: Column) -> Column:
    """The array with one entry (from 0) replaced."""
    rest = F.size(counts) - place - 1
    return F.concat(F.slice(counts, F.lit(1), place), F.array(value), F.slice(counts, place + 2, rest))


def peak_entropy(text: Column, window: int) -> Column:
    """Highest entropy, in bits a character, of any `window` characters; null if shorter.

    The counts of the window, one for each character that the text has, move along with it: a step
    changes two of them, so the time is linear in the text.
    """

    def slid(x: Column) -> Column:
        codes, kinds = x["codes"], x["kinds"]

        def moved(acc: Column, i: Column) -> Column:
            def left(now: Column) -> Column:
                place = F.get(codes, i - window)

                def gone(count: Column) -> Column:
                    return F.struct(
                        _with(now["counts"], place, count - 1).alias("counts"),
                        (now["s"] + _weight(count - 1) - _weight(count)).alias("s"),
                    )

                return F.when(i >= window, bind(F.get(now["counts"], place), gone)).otherwise(now)

            def entered(count: Column) -> Column:
                return F.struct(
                    _with(acc["counts"], F.get(codes, i), count + 1).alias("counts"),
                    (acc["s"] + _weight(count + 1) - _weight(count)).alias("s"),
                )

            now = bind(bind(F.get(acc["counts"], F.get(codes, i)), entered), left)
            return bind(
                now,
                lambda n: F.struct(
                    n["counts"].alias("counts"),
                    n["s"].alias("s"),
                    F.when(i >= window - 1, F.least(acc["low"], n["s"])).otherwise(acc["low"]).alias("low"),
                ),
            )

        start = F.struct(
            F.array_repeat(F.lit(0), kinds).alias("counts"),
            F.lit(0.0).alias("s"),
            F.lit(float("inf")).alias("low"),
        )
        return F.aggregate(
            F.sequence(F.lit(0), F.size(codes) - 1), start, moved,
            lambda acc: F.log2(F.lit(float(window))) - acc["low"] / window,
        )

    def coded(chars: Column) -> Column:
        return bind(
            F.array_distinct(chars),
            lambda kinds: F.struct(
                F.transform(chars, lambda c: F.array_position(kinds, c).cast("int") - 1).alias("codes"),
                F.size(kinds).alias("kinds"),
            ),
        )

    return F.when(F.length(text) >= window, bind(bind(F.split(text, ""), coded), slid))


def _spans(found: Column, kind: str) -> Column:
    rank = KINDS.index(kind)
    return F.transform(
        found,
        lambda m: F.struct(m["start"].alias("start"), F.lit(rank).alias("rank"), m["end"].alias("end")),
    )


def base_spans(text: Column) -> dict[str, Column]:
    value = F.regexp_extract
    return {
        "assign": _spans(
            F.filter(located(text, ASSIGN), lambda m: F.length(value(m["text"], ASSIGN, 1)) >= 6), "assign"
        ),
        "access": _spans(F.filter(located(text, ACCESS), lambda m: F.length(m["text"]) >= 20), "access"),
        "hex": _spans(located(text, HEX), "hex"),
    }


def entropy_spans(
    text: Column, classes: tuple[CharClass, ...] = CLASSES, allowed: tuple[str, ...] = ALLOWED
) -> Column:
    def suspicious(m: Column, one: CharClass) -> Column:
        ok = F.lit(True)
        for need in one.needs:
            ok = ok & m["text"].rlike(need)
        for pattern in allowed:
            ok = ok & ~m["text"].rlike(pattern)
        return F.when(ok, bind(m["text"], lambda t: peak_entropy(t, one.window) >= one.bits)).otherwise(False)

    def of(one: CharClass) -> Column:
        return _spans(F.filter(located(text, one.run), lambda m: suspicious(m, one)), "entropy")

    # Sorted, then neighbours compared: distinct structs are found pair by pair otherwise.
    return bind(
        F.sort_array(F.concat(*[of(one) for one in classes])),
        lambda all_: F.filter(all_, lambda s, i: (i == 0) | (s != F.get(all_, i - 1))),
    )


def written(spans: Column) -> Column:
    """kind:start:end, by start, then kind, comma-joined."""
    names = F.array(*[F.lit(kind) for kind in KINDS])
    return F.array_join(
        F.transform(
            F.sort_array(spans),
            lambda s: F.concat_ws(
                ":", F.get(names, s["rank"]), s["start"].cast("string"), s["end"].cast("string")
            ),
        ),
        ",",
    )


def scanned(
    docs: DataFrame, classes: tuple[CharClass, ...] = CLASSES, allowed: tuple[str, ...] = ALLOWED
) -> DataFrame:
    """doc_id, and per kind array<struct<start, rank, end>> of the spans found in the text."""
    whole = docs.select("doc_id", F.coalesce(F.col("text"), F.lit("")).alias("text"))
    text = F.col("text")
    return whole.select(
        "doc_id",
        *[spans.alias(kind) for kind, spans in base_spans(text).items()],
        entropy_spans(text, classes, allowed).alias("entropy"),
    )


def digests(found: DataFrame) -> DataFrame:
    base = bind(F.concat("assign", "access", "hex"), written)
    return found.select(
        "doc_id",
        *[F.size(kind).cast("bigint").alias(f"n_{kind}") for kind in KINDS],
        F.sha2(base, 256).alias("base_sha256"),
        bind(F.concat("assign", "access", "hex", "entropy"), written).alias("spans"),
    )
