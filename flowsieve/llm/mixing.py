"""Mixing sources to target weights by Sainte-Lague apportionment.

The words to take are cut into equal blocks. Blocks are given to sources by the highest quotients
``target / (2k + 1)``, and each source's blocks to its shards by the same rule, so every shard has
an integer quota before any document is looked at. Inside a shard the documents stand in a seeded
order and the quota takes whole passes plus a run of blocks from a seeded start, wrapping round.
Everything is DataFrame and SQL functions.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from flowsieve.llm.common import SPACE, row_struct, stored, unpacked, word_count

WEIGHTS = (3, 1, 2)
SHARE = 1.5
MOST = 2.0
BLOCK = 32
SEED = "mix-1"
OUTPUT = ["size", "source_size", "target", "taken", "passes", "ranges"]


def source_targets(
    sizes: DataFrame, weights=WEIGHTS, share: float = SHARE, most: float = MOST
) -> DataFrame:
    """One row per source: source, place, rows, source_size, target.

    ``sizes`` has source and size. Sources stand by code point, null last; their weights repeat.
    They share ``share`` times all words by weight; a target stops at ``most`` times its source's
    words and the excess goes to the others by weight until none is above. That fixed point is one
    water level: with sources by the level at which they are full, the first whose share of what
    is left does not fill it sets the level. Windows here see one row per source.
    """
    by_source = sizes.groupBy("source").agg(
        F.sum("size").alias("source_size"), F.count(F.lit(1)).alias("rows")
    )
    place = F.row_number().over(Window.orderBy(F.asc_nulls_last("source")))
    kinds = F.array(*[F.lit(float(w)) for w in weights])
    ranked = by_source.withColumn("place", place)
    ranked = ranked.withColumn(
        "weight", F.element_at(kinds, ((F.col("place") - 1) % len(weights) + 1).cast("int"))
    )
    cap = F.lit(most) * F.col("source_size")
    order = Window.orderBy(cap / F.col("weight"), "place")
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    onward = order.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    budget = F.lit(share) * F.sum("source_size").over(Window.partitionBy())
    level = (budget - F.coalesce(F.sum(cap).over(before), F.lit(0.0))) / F.sum("weight").over(onward)
    levels = ranked.withColumn("level", level).withColumn("full", cap / F.col("weight"))
    water = levels.agg(
        F.min(F.struct("full", "place", "level")).alias("all"),
        F.min(F.when(F.col("level") <= F.col("full"), F.struct("full", "place", "level"))).alias("x"),
    ).select(F.coalesce(F.col("x.level"), F.lit(None).cast("double")).alias("water"))
    target = F.least(cap, F.coalesce(F.col("water") * F.col("weight"), cap))
    return levels.join(F.broadcast(water)).select(
        "source", F.col("place").cast("int").alias("place"), "rows", "source_size",
        target.alias("target"),
    )


def highest_quotients(parts: DataFrame, seats: Column, within: list[str], order: str) -> DataFrame:
    """Sainte-Lague seats of each part: the ``seats`` highest quotients ``share / (2k + 1)``.

    ``parts`` has share, the columns ``within`` (each combination is apportioned on its own) and
    ``order``, which breaks ties and is unique there. Some multiplier m makes the sum of
    round(m * share) equal the seats, and m times the total lies within half the number of parts of
    the seats. So all quotients above the low end are seats for certain, those below the high end
    are none, and only the few between, at most about four per part, are ranked.
    """
    whole = Window.partitionBy(*within)
    scaled = parts.withColumns(
        {"_seats": seats.cast("bigint"), "_sum": F.sum("share").over(whole),
         "_n": F.count(F.lit(1)).over(whole)}
    )
    end = lambda sign: F.floor(
        F.col("share") / F.col("_sum") * (F.col("_seats") + sign * F.col("_n") / 2) + 0.5
    )
    usable = (F.col("_sum") > 0) & (F.col("share") > 0)
    bounds = scaled.withColumns(
        {
            "_low": F.when(usable, F.greatest(F.lit(0), end(-1) - 1)).otherwise(0).cast("bigint"),
            "_high": F.when(usable, F.greatest(F.lit(0), end(1) + 1)).otherwise(0).cast("bigint"),
        }
    )
    open_seats = bounds.withColumn("_open", F.col("_seats") - F.sum("_low").over(whole))
    candidates = open_seats.filter("_high > _low").select(
        *within, order, "_open", "share",
        F.explode(F.sequence(F.col("_low"), F.col("_high") - 1)).alias("_k"),
    )
    quotient = F.col("share") / (2 * F.col("_k") + 1)
    ranks = F.row_number().over(whole.orderBy(quotient.desc(), order, "_k"))
    won = (
        candidates.withColumn("_rank", ranks)
        .filter(F.col("_rank") <= F.col("_open"))
        .groupBy(*within, order)
        .agg(F.count(F.lit(1)).alias("_won"))
    )
    return open_seats.join(won, [*within, order], "left").select(
        *[F.col(f"`{c}`") for c in parts.columns],
        (F.col("_low") + F.coalesce(F.col("_won"), F.lit(0))).alias("quota"),
    )


def _digest(*parts: Column) -> Column:
    return F.md5(F.concat_ws("|", *[F.coalesce(p.cast("string"), F.lit("")) for p in parts]))


def _number(digest: Column) -> Column:
    return F.conv(F.substring(digest, 1, 8), 16, 10).cast("bigint")


def shard_of(order: Column, rows: Column) -> Column:
    """Shard inside the source: as many shards as an eighth of the root of its rows, so that the
    number of shards and the rows of a shard grow alike."""
    return (_number(order) % F.ceil(F.sqrt(rows) / 8)).cast("int")


def overlap(first: Column, end: Column, low: Column, high: Column) -> Column:
    return F.greatest(F.lit(0), F.least(end, high) - F.greatest(first, low)).cast("bigint")


def mix(
    docs: DataFrame,
    size: str | None = None,
    text: str = "text",
    weights=WEIGHTS,
    share: float = SHARE,
    most: float = MOST,
    block: int = BLOCK,
    seed: str = SEED,
) -> DataFrame:
    """All columns of ``docs`` with size, source_size, target, taken, passes and ranges.

    ``taken`` words of a document are in the mix: ``passes`` whole copies and the word ranges
    (first, end) in ``ranges``. A source's taken words differ from its target by half a block and,
    where a shard would pass ``most`` times its words, by what that shard lacks. Sizes come from
    column ``size`` or are counted in ``text``; null texts have size 0 and are taken 0 words, null
    sources are one source. Rows that repeat a doc_id are documents of their own; equal rows are
    interchangeable. Reruns give the same rows. An empty table gives an empty table. An input column
    with an output's name is replaced.

    A window task holds one shard of one source, never a source; only the list of sources, a row each,
    is looked at in one task.
    """
    length = F.col(f"`{size}`") if size else word_count(F.col(f"`{text}`"))
    # Rows without a doc_id are dealt to the shards by their size.
    key = F.coalesce(F.col("_id").cast("string"), F.concat(F.lit("-"), F.col("size").cast("string")))
    rows = docs.select(
        row_struct(docs),
        F.col("doc_id").alias("_id"),
        F.col("source").alias("_source"),
        F.coalesce(length, F.lit(0)).cast("bigint").alias("size"),
    ).withColumn("_order", _digest(F.lit(seed), key))
    targets = stored(
        source_targets(rows.select(F.col("_source").alias("source"), "size"), weights, share, most),
        "targets",
    )
    known = targets.select(F.col("source").alias("_known"), "place", "rows", "source_size", "target")
    placed = rows.join(known, F.col("_source").eqNullSafe(F.col("_known"))).withColumn(
        "_shard", shard_of(F.col("_order"), F.col("rows"))
    )
    seats = F.round(F.sum(F.col("target")).over(Window.partitionBy()) / block)
    quotas = highest_quotients(
        targets.withColumns({"share": F.col("target"), "_all": F.lit(0)}), seats, ["_all"], "place"
    ).select("place", F.col("quota").alias("blocks"))
    shards = placed.groupBy("place", "_shard").agg(F.sum("size").alias("words"))
    shards = shards.join(quotas, "place").withColumn("share", F.col("words").cast("double"))
    shards = highest_quotients(shards, F.col("blocks"), ["place"], "_shard")
    words = F.least(F.col("quota") * block, F.floor(F.col("words") * most)).cast("bigint")
    spread = _digest(F.lit(seed), F.col("place"), F.col("_shard"))
    shards = stored(
        shards.filter("words > 0").select(
            F.col("place").alias("_place"),
            F.col("_shard").alias("_part"),
            "words",
            F.floor(words / F.col("words")).cast("bigint").alias("passes"),
            (words % F.col("words")).alias("_rest"),
            (_number(spread) % F.ceil(F.col("words") / block) * block).alias("_start"),
        ),
        "quotas",
    )
    line = Window.partitionBy("place", "_shard").orderBy("_order", F.asc_nulls_last("_id"), "size")
    inside = placed.withColumn(
        "_end", F.sum("size").over(line.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    ).withColumn("_first", F.col("_end") - F.col("size"))
    joined = inside.join(
        shards, (F.col("place") == F.col("_place")) & (F.col("_shard") == F.col("_part")), "left"
    ).na.fill(0, ["passes", "_rest", "_start", "words"])
    first, end, low = F.col("_first"), F.col("_end"), F.col("_start")
    high = F.least(F.col("words"), low + F.col("_rest"))
    wrapped = low + F.col("_rest") - F.col("words")
    run = lambda a, b: F.struct(
        (F.greatest(first, a) - first).alias("first"), (F.least(end, b) - first).alias("end")
    )
    ranges = F.filter(
        F.array(run(F.lit(0).cast("bigint"), wrapped), run(low, high)),
        lambda r: r["end"] > r["first"],
    )
    extra = overlap(first, end, low, high) + overlap(first, end, F.lit(0), wrapped)
    mixed = joined.withColumns(
        {"ranges": ranges, "taken": F.col("passes") * F.col("size") + extra}
    )
    return mixed.select(*unpacked(mixed, docs.columns, OUTPUT), *OUTPUT)


def words_between(text: Column, first: Column, end: Column) -> Column:
    """The words first to end of a text, each with the white space before it."""
    pieces = F.split(F.coalesce(text, F.lit("")), f"(?<=[^{SPACE}])(?=[{SPACE}])")
    return F.array_join(F.slice(pieces, (first + 1).cast("int"), (end - first).cast("int")), "")


def mixed_documents(docs: DataFrame, text: str = "text", **options) -> DataFrame:
    """The mix itself with the columns of ``docs``: every document as often as it is taken.

    Whole passes repeat the row; a range gives a row whose text is cut to its words (and whose
    n_chars, where that column exists, is that text's length).
    """
    mixed = mix(docs, text=text, **options)
    whole = F.array_repeat(F.lit(None).cast("struct<first:bigint,end:bigint>"), F.col("passes").cast("int"))
    ends_whole = F.transform(
        "ranges",
        lambda r: F.when((r["first"] == 0) & (r["end"] == F.col("size")), F.lit(None)).otherwise(r),
    )
    copies = mixed.select("*", F.explode(F.concat(whole, ends_whole)).alias("_cut"))
    body = F.when(F.col("_cut").isNull(), F.col(f"`{text}`")).otherwise(
        words_between(F.col(f"`{text}`"), F.col("_cut.first"), F.col("_cut.end"))
    )
    replaced = {text: body} | ({"n_chars": F.length(body).cast("bigint")} if "n_chars" in docs.columns else {})
    return copies.select(*[replaced[c].alias(c) if c in replaced else F.col(f"`{c}`") for c in docs.columns])
