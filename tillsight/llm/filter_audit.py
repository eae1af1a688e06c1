"""How five quality filters act on one another, in every order.

Whether a document fails a filter does not depend on the order, so every document is one
combination of five bits, and all 120 orders follow from the counts of the 32 combinations. Four bits
come from the document alone. The fifth, a copy of a document with a smaller id, is an existential
self-join: a left-semi join on hash, exact text and smaller id. The ids that fail it are united with
those that fail the others, and the combinations are counted.
"""

from __future__ import annotations

from itertools import permutations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillsight.llm.common import spill

#: the filters in the order of their bits
FILTERS = "ABCDE"
COPY = 1 << FILTERS.index("E")
LEAST_WORDS, LEAST_DISTINCT_PCT, MOST_UPPER_PCT = 200, 50, 3
_SPACE, _MARKS, _NOT_UPPER = r"[\x20\x09-\x0D]+", r"[#$%&*|]", "[^A-Z]"
#: a hash that holds more than one part in this many of all rows is dealt out to this many parts
SHARE, PARTS = 1000, 64
COUNTS = ("kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley")


def own_failures(text: Column) -> Column:
    """Bits of the filters that a text fails by itself; ``text`` must not be null."""
    words = F.filter(F.split(text, _SPACE), lambda w: w != "")

    def bits(w: Column) -> Column:
        upper = F.length(F.regexp_replace(text, _NOT_UPPER, ""))
        fails = [
            F.size(w) < LEAST_WORDS,
            100 * F.size(F.array_distinct(w)) < LEAST_DISTINCT_PCT * F.size(w),
            100 * upper.cast("long") > MOST_UPPER_PCT * F.length(text).cast("long"),
            text.rlike(_MARKS),
        ]
        return sum((f.cast("int") * (1 << i) for i, f in enumerate(fails)), F.lit(0))

    # the words are made once
    return F.transform(F.array(words), bits)[0]


def copies(documents: DataFrame, hashes: DataFrame) -> DataFrame:
    """Rows (_id, part, _hash) of ``documents`` (_id, part, _text, _hash) whose text a smaller id has too.
    Ids must not be null. ``hashes`` holds the ``_hash`` of every row, so that the texts need not be read for it.

    Only texts whose hash returns are moved. The side that is looked up holds each of them once, with its
    smallest id; it is made with partial aggregation, so copies do not travel there. A hash with a
    large share of the rows (there are at most ``SHARE`` of them) is dealt out to ``PARTS`` parts, and its few
    texts go to each.
    """
    total = hashes.count()
    often = F.col("_n") * SHARE > F.lit(total)
    again = spill(
        hashes.groupBy("_hash").agg(F.count("*").alias("_n")).where(F.col("_n") > 1)
        .select("_hash", often.alias("_hot")),
        "repeated",
    )
    # at most SHARE rows
    hot = F.broadcast(again.where("_hot").select("_hash", F.lit(True).alias("_dealt")))
    every, one = F.sequence(F.lit(0), F.lit(PARTS - 1)), F.array(F.lit(0))

    def in_parts(df: DataFrame) -> DataFrame:
        return df.withColumn("_part", F.explode(F.when(F.col("_hot"), every).otherwise(one)))

    part = F.pmod(F.xxhash64("_id"), F.lit(PARTS)).cast("int")
    dealt = (
        documents.join(hot, "_hash", "left")
        .withColumn("_part", F.when(F.col("_dealt"), part).otherwise(0))
        .drop("_dealt")
    )
    met = spill(dealt.join(in_parts(again), ["_hash", "_part"]), "met")
    first = in_parts(met.groupBy("_hash", "_hot", "_text").agg(F.min("_id").alias("_first")))
    same = [met[c] == first[c] for c in ("_hash", "_text", "_part")]
    found = met.join(first, [*same, first["_first"] < met["_id"]], "left_semi")
    return found.select("_id", "part", "_hash")


def combinations(
    documents: DataFrame,
    labels: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    part_col: str = "lang",
) -> DataFrame:
    """Rows (part, bits, documents, good, toxic): how many documents of a part fail exactly the
    filters of ``bits``, how many of them are labelled good and toxic.

    Null texts are empty, a null part is the empty string. Equal rows count each; a document with
    several labels is good (toxic) if one of them says so. Rows without id have no label and are no
    copies. Other columns, whatever their names, are not read.
    """
    docs = documents.select(
        F.col(id_col).alias("_id"),
        F.coalesce(F.col(part_col).cast("string"), F.lit("")).alias("part"),
        F.coalesce(F.col(text_col), F.lit("")).alias("_text"),
    ).withColumn("_hash", F.xxhash64("_text"))
    alone = spill(
        docs.select(
            "_id", "part", "_hash", own_failures(F.col("_text")).alias("_bits"),
            F.lit(1).cast("long").alias("_n"),
        ),
        "alone",
    )
    known = F.col("_id").isNotNull()
    again = copies(docs.where(known), alone.where(known).select("_hash")).withColumns(
        {"_bits": F.lit(COPY), "_n": F.lit(0).cast("long")}
    )
    # all rows of an id with the same text fail the same filters
    failures = (
        alone.where(known)
        .unionByName(again)
        .groupBy("_id", "part", "_hash")
        .agg(F.bit_or("_bits").alias("bits"), F.sum("_n").alias("_n"))
    )
    marks = labels.where(F.col(id_col).isNotNull()).groupBy(F.col(id_col).alias("_id")).agg(
        F.max((F.col("quality") == 1).cast("long")).alias("_good"),
        F.max((F.col("toxic") == 1).cast("long")).alias("_toxic"),
    )
    n = F.col("_n")
    joined = failures.join(marks, "_id", "left").select(
        "part", "bits", "_n",
        (n * F.coalesce("_good", F.lit(0))).alias("_good"),
        (n * F.coalesce("_toxic", F.lit(0))).alias("_toxic"),
    )
    # rows without id meet nothing: they are counted where they are
    none = F.lit(0).cast("long")
    bare = alone.where(~known).select(
        "part", F.col("_bits").alias("bits"), "_n", none.alias("_good"), none.alias("_toxic")
    )
    return (
        joined.unionByName(bare)
        .groupBy("part", "bits")
        .agg(F.sum("_n").alias("documents"), F.sum("_good").alias("good"), F.sum("_toxic").alias("toxic"))
    )


def _mask(letters: Column) -> Column:
    """Bits of the filters whose letters a string holds."""
    return sum(
        (F.when(F.instr(letters, f) > 0, 1 << i).otherwise(0) for i, f in enumerate(FILTERS)), F.lit(0)
    )


def audit(counts: DataFrame) -> DataFrame:
    """One row per part, order of the filters and step, from the rows of :func:`combinations`.

    ``kept``, ``removed`` and ``redundant`` (failing, but removed by an earlier filter) at this
    step; ``unique_fails`` (failing this filter alone); ``good_lost`` and ``toxic_lost`` among the removed;
    ``shapley``, the filter's removed documents over all orders. A part has all rows, zeros
    included; no parts, no rows.
    """
    orders = F.array(*[F.lit("".join(p)) for p in permutations(FILTERS)])
    steps = (
        counts.withColumn("filter_order", F.explode(orders))
        .select("*", F.posexplode(F.split("filter_order", "")).alias("_at", "_letter"))
        .where(F.col("_letter") != "")
        .withColumns(
            {
                "step": (F.col("_at") + 1).cast("int"),
                "_own": _mask(F.col("_letter")),
                "_before": _mask(F.expr("substring(filter_order, 1, _at)")),
            }
        )
    )
    bits, own, before = F.col("bits"), F.col("_own"), F.col("_before")
    fails = bits.bitwiseAND(own) != 0
    gone = bits.bitwiseAND(before) != 0
    removed = fails & ~gone
    # a document that fails k filters is removed by each of them in 1/k of the orders
    shared = F.floor(F.lit(120) / F.bit_count(bits))

    def total(condition: Column, of: Column) -> Column:
        return F.sum(F.when(condition, of).otherwise(0)).cast("long")

    n = F.col("documents")
    made = [
        total(~fails & ~gone, n), total(removed, n), total(fails & gone, n), total(bits == own, n),
        total(removed, F.col("good")), total(removed, F.col("toxic")), total(fails, n * shared),
    ]
    return steps.groupBy("part", "filter_order", "step").agg(*[c.alias(a) for a, c in zip(COUNTS, made)])
