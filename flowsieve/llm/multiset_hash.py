"""Homomorphic multiset hash of a text's paragraphs.

Every paragraph hashes to a wide vector: eight lanes of 32 bits that tell paragraphs apart, and 64
lanes that each count how many of its word triples hash to a one there less those that hash to a zero.
A text's fingerprint is the sum of its paragraphs' vectors, lane by lane, modulo 2^32 and 2^16. The
order of the paragraphs has no part in it, and a paragraph is put in or taken out by adding or
subtracting its vector. Equal fingerprints mean equal paragraphs; of different ones, the angle of
the counting lanes tells how many triples the texts share. SQL functions only.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from flowsieve.llm.common import SPACE, stored

STRONG, COUNTING = 8, 64
STRONG_BITS, COUNTING_BITS = 32, 16
SHINGLE = 3
# Four counters in a 64-bit number: bits of a hash at distance 16, for as many triples as fit.
FOUR = (1 << 48) | (1 << 32) | (1 << 16) | 1
TRIPLES_A_COUNT = (1 << 15) - 1
LOW = (1 << 32) - 1
ROWS_A_RANGE = 100_000
COPIES_A_BLOCK = 10_000


def paragraphs(text: Column) -> Column:
    """The paragraphs of a text: what stands between line ends, empty ones left out."""
    return F.filter(F.split(text, "[\\r\\n]+"), lambda p: F.length(p) > 0)


def _triples(paragraph: Column) -> Column:
    """Hashes of the triples of words that start at each word; the last two are shorter."""
    words = F.filter(F.split(paragraph, f"[{SPACE}]+"), lambda w: F.length(w) > 0)
    # A lambda's argument is computed once, however often it is used inside.
    return F.flatten(
        F.transform(
            F.array(words),
            lambda ws: F.transform(
                ws, lambda w, i: F.xxhash64(*[w if k == 0 else F.get(ws, i + k) for k in range(SHINGLE)])
            ),
        )
    )


def lanes(text: Column) -> Column:
    """The fingerprint of a text as an array of ``STRONG`` + ``COUNTING`` lanes, each from 0."""
    return F.get(F.transform(F.array(paragraphs(text)), _paragraph_lanes), 0)


def _paragraph_lanes(parts: Column) -> Column:
    zero = F.lit(0).cast("bigint")
    strong = F.aggregate(
        parts,
        F.struct(*[zero.alias(f"s{i}") for i in range(STRONG)]),
        lambda acc, p: F.struct(*[
            (acc[f"s{i}"] + _half(F.xxhash64(F.lit(i // 2), p), i % 2)).alias(f"s{i}") for i in range(STRONG)
        ]),
        lambda acc: F.array(*[F.pmod(acc[f"s{i}"], F.lit(1 << STRONG_BITS)) for i in range(STRONG)]),
    )
    return F.concat(strong, F.get(F.transform(F.array(F.flatten(F.transform(parts, _triples))), _counts), 0))


def _counts(hashes: Column) -> Column:
    """The counting lanes of all hashes: counted in runs that no counter outgrows, then added up."""
    runs = F.sequence(F.lit(0), F.floor((F.size(hashes) - 1) / TRIPLES_A_COUNT).cast("int"))
    counted = F.transform(
        F.when(F.size(hashes) > 0, runs).otherwise(F.array().cast("array<int>")),
        lambda k: _run_counts(F.slice(hashes, k * TRIPLES_A_COUNT + 1, F.lit(TRIPLES_A_COUNT))),
    )
    return F.aggregate(
        counted,
        F.array_repeat(F.lit(0).cast("bigint"), COUNTING),
        lambda acc, run: F.transform(F.zip_with(acc, run, lambda x, y: x + y), lambda x: F.pmod(x, F.lit(1 << COUNTING_BITS))),
    )


def _run_counts(hashes: Column) -> Column:
    zero, numbers, mask = F.lit(0).cast("bigint"), COUNTING // 4, F.lit((1 << 16) - 1)
    return F.aggregate(
        hashes,
        F.struct(zero.alias("n"), *[zero.alias(f"c{i}") for i in range(numbers)]),
        lambda acc, h: F.struct((acc["n"] + 1).alias("n"), *[
            (acc[f"c{i}"] + F.shiftrightunsigned(h, i).bitwiseAND(F.lit(FOUR))).alias(f"c{i}") for i in range(numbers)
        ]),
        lambda acc: F.array(*[
            2 * F.shiftrightunsigned(acc[f"c{i}"], 16 * k).bitwiseAND(mask) - acc["n"] for k in range(4) for i in range(numbers)
        ]),
    )


def _half(number: Column, upper: int) -> Column:
    return F.shiftrightunsigned(number, 32) if upper else number.bitwiseAND(F.lit(LOW))


def combined(left: Column, right: Column, sign: int = 1) -> Column:
    """Fingerprint of the paragraphs of both, or with ``sign`` -1 of ``left`` without ``right``'s."""
    # Neither side may be named inside the lambda, where it would be computed for every lane.
    sums = F.zip_with(left, right, lambda x, y: x + sign * y)
    return F.transform(
        sums, lambda x, i: F.pmod(x, F.when(i < STRONG, 1 << STRONG_BITS).otherwise(1 << COUNTING_BITS))
    )


def inserted(fingerprint: Column, text: Column) -> Column:
    """Fingerprint after the paragraphs of ``text`` are added."""
    return combined(fingerprint, lanes(text))


def deleted(fingerprint: Column, text: Column) -> Column:
    """Fingerprint after the paragraphs of ``text``, which were among it, are taken out."""
    return combined(fingerprint, lanes(text), -1)


def narrow(fingerprint: Column) -> Column:
    """A fingerprint in a third of the bytes, for shuffling; ``widened`` gives it back."""
    counting = F.transform(
        F.slice(fingerprint, STRONG + 1, COUNTING), lambda x: F.when(x < 1 << 15, x).otherwise(x - (1 << 16)).cast("smallint")
    )
    return F.struct(F.slice(fingerprint, 1, STRONG).alias("strong"), counting.alias("counting"))


def widened(fingerprint: Column) -> Column:
    counting = F.transform(fingerprint["counting"], lambda x: F.pmod(x.cast("bigint"), F.lit(1 << COUNTING_BITS)))
    return F.concat(fingerprint["strong"], counting)


def as_string(fingerprint: Column) -> Column:
    """Hexadecimal digits of all lanes: eight for each of the first, four for each of the others."""
    return F.lower(
        F.array_join(
            F.transform(
                fingerprint,
                lambda x, i: F.when(i < STRONG, F.lpad(F.hex(x), STRONG_BITS // 4, "0")).otherwise(
                    F.lpad(F.hex(x), COUNTING_BITS // 4, "0")
                ),
            ),
            "",
        )
    )


def likeness(left: Column, right: Column) -> Column:
    """0 to 1: 1 for equal fingerprints, else the cosine of the counting lanes as signed numbers,
    which estimates the share of word triples the texts have in common; 0 where it is negative."""
    half = 1 << (COUNTING_BITS - 1)

    def signed(fingerprint: Column) -> Column:
        own = F.slice(fingerprint, STRONG + 1, COUNTING)
        return F.transform(own, lambda x: F.when(x < half, x).otherwise(x - 2 * half).cast("double"))

    def product(a: Column, b: Column) -> Column:
        zero = F.lit(0.0)
        return F.aggregate(F.zip_with(a, b, lambda x, y: x * y), zero, lambda acc, x: acc + x)

    cosine = product(signed(left), signed(right)) / F.nullif(
        F.sqrt(product(signed(left), signed(left)) * product(signed(right), signed(right))), F.lit(0.0)
    )
    bounded = F.least(F.greatest(F.coalesce(cosine, F.lit(0.0)), F.lit(0.0)), F.lit(1.0))
    return F.when(left == right, 1.0).otherwise(bounded)


def edited_lanes(fingerprint: Column, text: Column, kept: Column, new: Column) -> Column:
    """Fingerprint of ``text`` cut after ``kept`` characters with ``new`` behind, from the
    fingerprint of ``text``: paragraphs that end before the cut stay in, the others go out, and what
    now stands in their place comes in."""
    head = F.substring(text, F.lit(1), kept)
    # Where the paragraph with the cut starts: behind the last line end before it.
    start = F.length(F.regexp_extract(head, "(?s)^(.*[\\r\\n])", 1))
    old = F.substring(text, start + 1, F.length(text))
    put = F.concat(F.substring(head, start + 1, F.length(head)), new)
    return inserted(deleted(fingerprint, old), put)


def _keyed(docs: DataFrame, key: str, text: str) -> DataFrame:
    """doc_id, text and _key, a digest of both: rows with the same one are interchangeable."""
    own = F.col(f"`{key}`").cast("bigint")
    body = F.coalesce(F.col(f"`{text}`"), F.lit(""))
    digest = F.unhex(F.sha2(F.concat(F.coalesce(own.cast("string"), F.lit("-")), F.lit(" "), body), 256))
    return docs.select(own.alias("doc_id"), body.alias("text"), digest.alias("_key"))


def _followers(rows: DataFrame) -> DataFrame:
    """_key and next_key of stored ``rows`` (_key, doc_id), in ascending order of doc_id, nulls last,
    then of the digest; the last one's next is the first.

    Rows fall into ranges of that order, each of which a task sorts; only the first row of every
    range, one for ``ROWS_A_RANGE`` rows, is looked at together.
    """
    order = [F.asc_nulls_last("doc_id"), F.col("_key")]
    ranges = max(1, rows.count() // ROWS_A_RANGE)
    dealt = rows.select("doc_id", "_key").repartitionByRange(ranges, *order)
    dealt = stored(dealt.withColumn("range", F.spark_partition_id()), "ordered")
    lined = dealt.withColumn("next_key", F.lead("_key").over(Window.partitionBy("range").orderBy(*order)))
    heads = dealt.groupBy("range").agg(
        F.min_by("_key", F.struct(F.col("doc_id").isNull(), "doc_id", "_key")).alias("head")
    )
    by_range = Window.orderBy("range")
    everything = by_range.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    follow = heads.select("range", F.coalesce(F.lead("head").over(by_range), F.first("head").over(everything)).alias("_first"))
    return lined.join(follow, "range").select("_key", F.coalesce("next_key", "_first").alias("next_key"))


def fingerprints(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per document: doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint,
    near_edited, near_next.

    The edited text is the whole text with its last quarter of code points, rounded down, replaced
    by the first as many of the next document's, or all of them. Documents follow each other by
    doc_id, nulls last and equal ones by a digest of the text; the first follows the last. Rows equal
    in both are computed once and counted: all but the last of them are followed by their like. Null
    texts are empty, the fingerprint of which is zero; other columns play no part. An empty table
    gives an empty table.

    Texts are shuffled once, by digest, and prefixes of at most a quarter once more; everything else
    travels as narrow rows.
    """
    keyed = _keyed(docs, key, text)
    distinct = stored(
        keyed.select("doc_id", "_key", F.length("text").alias("n_chars"), narrow(lanes(F.col("text"))).alias("own"))
        .groupBy("_key")
        .agg(
            F.first("doc_id").alias("doc_id"), F.first("n_chars").alias("n_chars"), F.first("own").alias("own"),
            F.count(F.lit(1)).alias("copies"),
        ),
        "documents",
    )
    facts = distinct.select("_key", "doc_id", "n_chars", "copies")
    take = F.expr("n_chars div 4").cast("int")
    linked = stored(facts.join(_followers(facts), "_key").withColumn("take", take), "linked")
    # One shuffle of the texts serves both joins.
    texts, prints = keyed.groupBy("_key").agg(F.first("text").alias("text")), distinct.select("_key", "own")
    wanted = linked.select(F.col("next_key").alias("_key"), F.col("_key").alias("_to"), "take")
    heads = texts.join(wanted, "_key").join(prints, "_key").select(
        F.col("_to").alias("_key"), F.substring("text", F.lit(1), F.col("take")).alias("new"), F.col("own").alias("next_own")
    )
    met = texts.join(linked.drop("next_key"), "_key").join(prints, "_key").join(heads, "_key")
    last = F.struct(F.lit(1).cast("bigint").alias("copies"), "new", "next_own")
    others = F.struct(
        (F.col("copies") - 1).alias("copies"), F.substring("text", F.lit(1), F.col("take")).alias("new"),
        F.col("own").alias("next_own"),
    )
    cases = F.when(F.col("copies") > 1, F.array(last, others)).otherwise(F.array(last))
    kept = F.col("n_chars") - F.col("take")
    each = met.select(
        "doc_id", F.col("n_chars").cast("bigint").alias("n_chars"), widened(F.col("own")).alias("own"), "text",
        kept.alias("kept"), F.explode(cases).alias("case"),
    ).select("doc_id", "n_chars", "own", "text", "kept", "case.copies", "case.new", widened(F.col("case.next_own")).alias("next_own"))
    done = each.select(
        "doc_id", "n_chars", "copies",
        F.sha2(F.concat(F.substring("text", F.lit(1), F.col("kept")), "new"), 256).alias("edited_sha256"), "own", "next_own",
        # A generator's output is computed once, though three columns read it.
        F.explode(F.array(edited_lanes(F.col("own"), F.col("text"), F.col("kept"), F.col("new")))).alias("edited"),
    ).select(
        "doc_id", "n_chars", "copies", "edited_sha256", as_string(F.col("own")).alias("fingerprint"),
        as_string(F.col("edited")).alias("edited_fingerprint"),
        likeness(F.col("own"), F.col("edited")).alias("near_edited"),
        likeness(F.col("own"), F.col("next_own")).alias("near_next"),
    )
    one = F.lit(1).cast("bigint")
    most = distinct.agg(F.max("copies")).first()[0] or 0
    if most <= COPIES_A_BLOCK:
        return done.withColumn("copies", F.explode(F.sequence(one, F.col("copies")))).drop("copies")
    # Copies of one document are written out by several tasks, a block each.
    done = stored(done, "edited")
    blocks = F.expr(f"sequence(0, (copies - 1) div {COPIES_A_BLOCK})")
    counted = done.withColumn("_block", F.explode(blocks)).repartition(F.col("_block"), F.col("fingerprint"))
    n = F.least(F.lit(COPIES_A_BLOCK), F.col("copies") - F.col("_block") * COPIES_A_BLOCK)
    return counted.withColumn("_block", F.explode(F.sequence(one, n))).drop("copies", "_block")
