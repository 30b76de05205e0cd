"""Document fingerprints: a Merkle tree over sections and paragraphs.

A text is cut, without loss, after line feeds and after punctuation with a blank; the pieces
are the paragraphs, the leaves of the tree. A section ends with a paragraph whose digest says
so (three in sixteen), so an edit moves no later section. A section's digest covers its
paragraphs' digests, the root covers the sections'. The fingerprint writes the tree out:

    root | section:paragraphs, ... | paragraph, ...

Equal roots are equal texts; sections that differ lead to the paragraphs that differ.
Built-in functions only. Defined results: a null text is an empty one; an empty text has a
root, one section and one paragraph; two empty texts are alike.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from hazeline.llm.bind import bind

CUTS = r"(?<=\n)|(?<=[.!?;:,|] )"
SHORT = 8  # hex digits that a fingerprint keeps of an inner digest
SECTION = "012"  # a section ends with a paragraph whose digest ends so: 3 in 16


def _tree(leaves: Column) -> Column:
    def with_sections(full: Column) -> Column:
        last = F.size(full) - 1
        ends = F.array_compact(
            F.transform(
                full,
                lambda d, i: F.when((i == last) | F.substring(d, -1, 1).isin(list(SECTION)), i),
            )
        )

        def spans(e: Column) -> Column:
            return F.transform(
                e,
                lambda end, j: bind(
                    F.coalesce(F.get(e, j - 1), F.lit(-1)) + 1,
                    lambda start: F.struct(
                        F.sha2(F.array_join(F.slice(full, start + 1, end - start + 1), ","), 256).alias("d"),
                        (end - start + 1).alias("n"),
                    ),
                ),
            )

        def written(sections: Column) -> Column:
            return F.concat_ws(
                "|",
                F.sha2(F.array_join(F.transform(sections, lambda s: s["d"]), ","), 256),
                F.array_join(
                    F.transform(
                        sections,
                        lambda s: F.concat(F.substring(s["d"], 1, SHORT), F.lit(":"), s["n"].cast("string")),
                    ),
                    ",",
                ),
                F.array_join(F.transform(full, lambda d: F.substring(d, 1, SHORT)), ","),
            )

        return bind(bind(ends, spans), written)

    return bind(F.transform(leaves, lambda x: F.sha2(x, 256)), with_sections)


def fingerprint(text: Column) -> Column:
    return _tree(F.split(F.coalesce(text, F.lit("")), CUTS))


def root(print_: Column) -> Column:
    return F.substring_index(print_, "|", 1)


def paragraphs(print_: Column) -> Column:
    return F.split(F.substring_index(print_, "|", -1), ",")


def sections(print_: Column) -> Column:
    return F.split(F.substring_index(F.substring_index(print_, "|", 2), "|", -1), ",")


def likeness(one: Column, other: Column) -> Column:
    """Dice's measure over the distinct paragraphs: 1.0 for equal roots."""

    def dice(a: Column, b: Column) -> Column:
        return F.lit(2.0) * F.size(F.array_intersect(a, b)) / (
            F.size(F.array_distinct(a)) + F.size(F.array_distinct(b))
        )

    return F.when(root(one) == root(other), F.lit(1.0)).otherwise(
        bind(
            F.struct(paragraphs(one).alias("a"), paragraphs(other).alias("b")),
            lambda x: dice(x["a"], x["b"]),
        )
    )


def edits(one: Column, other: Column) -> Column:
    """Where the trees part: numbers (from 0) of paragraphs of `one` below sections that
    `other` doesn't have, and that are not found in `other`."""

    def firsts(x: Column) -> Column:
        sizes = F.transform(x["s"], lambda s: F.substring_index(s, ":", -1).cast("int"))
        theirs = x["t"]
        state = F.struct(F.lit(0).alias("at"), F.array().cast("array<int>").alias("found"))

        def step(acc: Column, j: Column) -> Column:
            size = F.get(sizes, j)
            inside = F.when(
                ~F.array_contains(theirs, F.get(x["s"], j)),
                F.filter(
                    F.sequence(acc["at"], acc["at"] + size - 1),
                    lambda i: ~F.array_contains(x["q"], F.get(x["p"], i)),
                ),
            ).otherwise(F.array().cast("array<int>"))
            return F.struct((acc["at"] + size).alias("at"), F.concat(acc["found"], inside).alias("found"))

        return F.aggregate(F.sequence(F.lit(0), F.size(x["s"]) - 1), state, step, lambda acc: acc["found"])

    return bind(
        F.struct(
            sections(one).alias("s"), sections(other).alias("t"),
            paragraphs(one).alias("p"), paragraphs(other).alias("q"),
        ),
        firsts,
    )


def _bucket(key: Column, bounds: list[int]) -> Column:
    """Number of bounds at or below the key, as a balanced tree of comparisons."""
    if not bounds:
        return F.lit(0)

    def among(low: int, high: int) -> Column:
        if low == high:
            return F.lit(low)
        middle = (low + high) // 2
        return F.when(key < bounds[middle], among(low, middle)).otherwise(among(middle + 1, high))

    return among(0, len(bounds))


def with_next(docs: DataFrame, carried: list[str]) -> DataFrame:
    """Each row with columns `next_<c>` of the row after it, doc_id descending; after the last
    comes the first. Rows of equal doc_id follow each other by text.

    Rows are dealt by ranges of doc_id, several to a task, and each range also gets a copy of
    the first row of the range below, so that one shuffle is enough. The driver holds one
    bound and one id for each range, as many as there are shuffle partitions.
    """
    spark = docs.sparkSession
    ranges = int(spark.conf.get("spark.sql.shuffle.partitions"))
    key = F.coalesce(F.col("doc_id"), F.lit(-(2**63)))
    cuts = docs.select(
        F.percentile_approx(key, [i / ranges for i in range(1, ranges)] or [0.5], 100 * ranges).alias("b")
    ).first()["b"]
    bucket = _bucket(key, sorted(set(cuts or [])))
    tops = [
        (row["bucket"], row["top"])
        for row in docs.select(bucket.alias("bucket"), key.alias("top")).groupBy("bucket")
        .agg(F.max("top").alias("top")).orderBy("bucket").collect()
    ]
    if not tops:
        tops = [(0, 0)]
    # The first row of each range also stands after the last row of the range above it.
    above = {top: tops[(i + 1) % len(tops)][0] for i, (_, top) in enumerate(tops)}
    known = F.create_map(*[F.lit(x) for top, to in above.items() for x in (F.lit(top).cast("bigint"), to)])
    places = F.array(F.struct(bucket.alias("range"), F.lit(False).alias("guest")))
    both = F.concat(places, F.array(F.struct(known[key].alias("range"), F.lit(True).alias("guest"))))
    dealt = docs.withColumn("_p", F.explode(F.when(key.isin(list(above)), both).otherwise(places)))
    order = Window.partitionBy(F.col("_p.range")).orderBy(
        F.col("_p.guest"), F.col("doc_id").desc_nulls_last(), F.xxhash64("text"), F.col("text")
    )
    following = {f"next_{c}": F.lead(c).over(order) for c in carried}
    return dealt.withColumns(following).filter(~F.col("_p.guest")).drop("_p")


def compared(docs: DataFrame) -> DataFrame:
    """Fingerprints of every text, of its edited text, and how alike they are."""
    held = docs.select(
        "doc_id", F.coalesce(F.col("text"), F.lit("")).alias("text")
    ).withColumn("fingerprint", fingerprint(F.col("text")))
    size, head = F.length("text"), F.col("next_text")
    third = F.floor(F.length("text") / 3).cast("int")
    edited = F.concat(
        F.substring(F.col("text"), F.lit(1), size - third), F.substring(head, F.lit(1), third)
    )
    rows = with_next(held, ["text", "fingerprint"]).select(
        "doc_id",
        size.cast("bigint").alias("n_chars"),
        "fingerprint",
        "next_fingerprint",
        bind(
            edited, lambda t: F.struct(F.sha2(t, 256).alias("sha"), fingerprint(t).alias("print"))
        ).alias("edited"),
    )
    return rows.select(
        "doc_id",
        "n_chars",
        F.col("edited.sha").alias("edited_sha256"),
        "fingerprint",
        F.col("edited.print").alias("edited_fingerprint"),
        likeness(F.col("fingerprint"), F.col("edited.print")).alias("near_edited"),
        likeness(F.col("fingerprint"), F.col("next_fingerprint")).alias("near_next"),
    )
