"""SimHash near-duplicates with pivot distance tables.

Equal fingerprints are folded first. Two fingerprints within two bits agree on a whole block of
any three, and on the other two blocks they still agree on one part of any three: nine keys of
about 35 bits find every linked pair. Inside a key, the distances of all members to many fixed
reference fingerprints (the pivot table) are computed once; a pair whose distances to any pivot
differ by more than two is discarded, and the survivors are verified. A key shared by very many
fingerprints is not compared pairwise: its members meet over the values one flipped bit away, which
finds the same links in groups of at most 65.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from flowsieve.llm.common import release_memory, row_struct, small_batches, small_side, stored, unpacked
from flowsieve.llm.components import connected_components
from flowsieve.llm.exact_dedup import text_digest

SHINGLE = 3
DISTANCE = 2
PIVOTS = 32
LARGEST_KEY = 2048
BITS = 64
# Fixed: white-space bytes of the word rule, mapped to one separator.
_SPACES = bytes.maketrans(b"\t\n\x0b\x0c\r", b"     ")


def fingerprint(text: str | None, shingle: int = SHINGLE) -> int:
    """64-bit SimHash of a whole text: A-Z lowered, word shingles with repeats, XXH64 seed 42."""
    words = (text or "").encode("utf-8", "surrogatepass").lower().translate(_SPACES).split(b" ")
    words = [w for w in words if w]
    if not words:
        return 0
    line = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))
    last = min(shingle, len(words)) - 1
    spans = zip(starts[: len(starts) - last].tolist(), ends[last:].tolist())
    digest = xxhash.xxh64_intdigest
    hashes = np.fromiter((digest(line[s:e], 42) for s, e in spans), np.uint64)
    ones = np.zeros(BITS, np.int64)
    for at in range(0, len(hashes), 1 << 16):
        bits = np.unpackbits(hashes[at : at + (1 << 16)].astype(">u8").view(np.uint8).reshape(-1, 8), axis=1)
        ones += bits.sum(axis=0, dtype=np.int64)
    majority = np.packbits(ones * 2 > len(hashes))
    return int.from_bytes(majority.tobytes(), "big")


def _fingerprints(shingle: int):
    def compute(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = np.fromiter(
                (fingerprint(t.as_py(), shingle) for t in batch.column(1)), np.uint64, batch.num_rows
            )
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(found.view(np.int64)), *batch.columns[2:]],
                ["doc_id", "fp", *batch.schema.names[2:]],
            )
        release_memory()

    return compute


def fingerprints(docs: DataFrame, text: str = "text", shingle: int = SHINGLE) -> DataFrame:
    """doc_id and fp (the fingerprint's 64 bits as a signed long); null texts count as empty."""
    return small_batches(docs).select(F.col("doc_id").cast("bigint"), F.col(f"`{text}`")).mapInArrow(
        _fingerprints(shingle), "doc_id bigint, fp bigint"
    )


def _layout() -> list[tuple[int, int]]:
    """(first mask, second mask) of the nine keys: a block, and a part of what is outside it."""
    blocks = np.array_split(np.arange(BITS), 3)
    layout = []
    for block in blocks:
        outside = np.setdiff1d(np.arange(BITS), block)
        for part in np.array_split(outside, 3):
            layout.append(sum(1 << int(b) for b in [*block, *part]))
    return layout


def _signed(value: int) -> int:
    return value - (1 << BITS) if value >> (BITS - 1) else value


def keyed(distinct: DataFrame) -> DataFrame:
    """Nine rows (k, key, fp) per fingerprint."""
    masks = [_signed(m) for m in _layout()]
    keys = F.array(
        *[F.struct(F.lit(i).alias("k"), F.col("fp").bitwiseAND(F.lit(m)).alias("key")) for i, m in enumerate(masks)]
    )
    return distinct.select("fp", F.explode(keys).alias("e")).select("e.k", "e.key", "fp")


def pivot_fingerprints(pivots: int = PIVOTS) -> np.ndarray:
    """The reference fingerprints: fixed, and as good for one corpus as for another."""
    return np.random.default_rng(20240229).integers(0, 2**64, pivots, dtype=np.uint64)


def pivot_table(values: np.ndarray, references: np.ndarray) -> np.ndarray:
    """Hamming distances, a row per fingerprint and a column per reference."""
    return np.bitwise_count(values[:, None] ^ references[None, :]).astype(np.int8)


def linked_pairs(values: np.ndarray, references: np.ndarray, distance: int = DISTANCE):
    """Index pairs (i < j) of distinct fingerprints at most ``distance`` bits apart.

    Rows are sorted by their first pivot distance, so a row's candidates are a short run behind it;
    the other coordinates discard most of these, and the true distance decides."""
    table = pivot_table(values, references)
    order = np.argsort(table[:, 0], kind="stable")
    table, sorted_values = table[order], values[order]
    ends = np.searchsorted(table[:, 0], table[:, 0] + distance, side="right")
    left, right = [], []
    for low in range(0, len(values), 256):
        high = min(low + 256, len(values))
        last = int(ends[low:high].max())
        block = np.arange(low, last)
        near = np.ones((high - low, len(block)), bool)
        for p in range(table.shape[1]):
            near &= np.abs(table[low:high, p, None] - table[None, low:last, p]) <= distance
        near &= block[None, :] > np.arange(low, high)[:, None]
        i, j = np.nonzero(near)
        i, j = i + low, j + low
        close = np.bitwise_count(sorted_values[i] ^ sorted_values[j]) <= distance
        left.append(order[i[close]])
        right.append(order[j[close]])
    return np.concatenate(left), np.concatenate(right)


def forest(n: int, left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Smallest index of each node's group under the given pairs."""
    root = np.arange(n)
    while True:
        low = np.minimum(root[left], root[right])
        before = root.copy()
        np.minimum.at(root, left, low)
        np.minimum.at(root, right, low)
        root = root[root]
        if (root == before).all():
            return root


def _group_links(largest: int, pivots: int, distance: int):
    """Streams rows sorted by key; per key yields spanning links, or its members marked hot."""

    def compute(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        references = pivot_fingerprints(pivots)
        current, held, hot = None, [], False

        def links(held):
            values = np.array(held, np.int64).view(np.uint64)
            left, right = linked_pairs(values, references, distance)
            root = forest(len(values), left, right)
            members = np.flatnonzero(root != np.arange(len(values)))
            signed = values.view(np.int64)
            return zip(signed[members].tolist(), signed[root[members]].tolist())

        for batch in batches:
            out = []
            for k, key, fp in zip(*[c.to_pylist() for c in batch.columns]):
                if (k, key) != current:
                    if len(held) > 1:
                        out.extend(links(held))
                    current, held, hot = (k, key), [], False
                if hot:
                    out.append((fp, None))
                    continue
                held.append(fp)
                if len(held) > largest:
                    out.extend((value, None) for value in held)
                    held, hot = [], True
            yield _links_batch(out)
        if len(held) > 1:
            yield _links_batch(list(links(held)))

    return compute


def _links_batch(pairs: list) -> pa.RecordBatch:
    columns = [pa.array([p[i] for p in pairs], pa.int64()) for i in (0, 1)]
    return pa.RecordBatch.from_arrays(columns, ["a", "b"])


def fingerprint_links(
    distinct: DataFrame,
    distance: int = DISTANCE,
    pivots: int = PIVOTS,
    largest: int = LARGEST_KEY,
) -> DataFrame:
    """Links (a, b) whose components are those of all fingerprint pairs within ``distance`` (at
    most 2) bits. ``distinct`` has one row per fp.

    A key's rows pass through one task as a stream; at most ``largest`` are held and compared.
    Larger keys are compared by :func:`flipped_links`, exactly and without a group to grow.
    """
    if not 0 <= distance <= 2:
        raise ValueError("nine keys find links of at most 2 bits")
    keys = keyed(distinct)
    ordered = keys.repartition("k", "key").sortWithinPartitions("k", "key", "fp")
    found = stored(
        ordered.mapInArrow(_group_links(largest, pivots, distance), "a bigint, b bigint"), "links"
    )
    links = found.filter("b IS NOT NULL")
    hot = found.filter("b IS NULL").select(F.col("a").alias("fp")).distinct()
    return links.unionByName(flipped_links(hot, distance))


def flipped_links(distinct: DataFrame, distance: int = DISTANCE) -> DataFrame:
    """Links by values one flipped bit away: two fingerprints share such a value if and only if
    they differ by at most two bits. A value has at most 65 of them; each is linked to the
    smallest. For one bit or none, the value itself must be a fingerprint's own."""
    flips = [0] if distance == 0 else [0, *[_signed(1 << b) for b in range(BITS)]]
    near = distinct.select(
        "fp",
        F.explode(F.array(*[F.struct(F.col("fp").bitwiseXOR(F.lit(f)).alias("via"), F.lit(f == 0).alias("own")) for f in flips])).alias("e"),
    ).select("fp", "e.via", "e.own")
    if distance == 1:
        own = near.filter("own").select("via", F.col("fp").alias("b"))
        return near.join(own, "via").filter("fp <> b").select(F.col("fp").alias("a"), "b")
    least = F.min("fp").over(Window.partitionBy("via"))
    return near.select(F.col("fp").alias("a"), least.alias("b")).filter("a <> b")


def components(
    prints: DataFrame,
    distance: int = DISTANCE,
    pivots: int = PIVOTS,
    largest: int = LARGEST_KEY,
) -> DataFrame:
    """fp, component (its smallest fp) and component_id (smallest doc_id reachable) for every
    distinct fingerprint.

    ``prints`` has doc_id and fp; rows of one fingerprint fold to one before any comparison. The
    component_id of fingerprints without a doc_id is null.
    """
    distinct = stored(prints.groupBy("fp").agg(F.min("doc_id").alias("doc_id")), "distinct")
    linked = connected_components(fingerprint_links(distinct.select("fp"), distance, pivots, largest))
    members = distinct.join(linked.withColumnRenamed("node", "fp"), "fp", "left").withColumn(
        "component", F.coalesce("component", "fp")
    )
    ids = members.groupBy("component").agg(F.min("doc_id").alias("component_id"))
    return members.join(ids, "component").select("fp", "component", "component_id")


def near_duplicates(docs: DataFrame, text: str = "text", **options) -> DataFrame:
    """doc_id, fingerprint (16 hex digits) and component_id of every row of ``docs``.

    Texts without words have fingerprint zero and are linked like any other. Null texts count as
    empty. Rows that repeat a doc_id are rows of their own. An empty table gives an empty table.
    """
    prints = stored(fingerprints(docs, text, options.pop("shingle", SHINGLE)), "fingerprints")
    found = stored(components(prints, **options), "components")
    hexed = F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint")
    return prints.join(found, "fp").select("doc_id", hexed, "component_id")


def drop_near_duplicates(docs: DataFrame, text: str = "text", **options) -> DataFrame:
    """One document of each component, with all its columns: the one with the smallest doc_id, of
    several with that doc_id or of a component without any the one with the smallest text digest.

    Texts without words carry no evidence of likeness beyond being empty, and are one component.
    Rows without a doc_id are kept only if their component has no other. Only the ids and digests
    of the documents that stay travel to the texts.
    """
    id_, digest = F.col("doc_id").cast("bigint"), F.unhex(text_digest(F.col(f"`{text}`")))
    bodies = small_batches(docs).select(id_.alias("doc_id"), F.col(f"`{text}`"), digest.alias("digest"))
    compute = _fingerprints(options.pop("shingle", SHINGLE))
    prints = stored(bodies.mapInArrow(compute, "doc_id bigint, fp bigint, digest binary"), "fingerprints")
    found = components(prints.select("doc_id", "fp"), **options)
    return staying_rows(docs, text, prints, found)


def staying_rows(docs: DataFrame, text: str, prints: DataFrame, found: DataFrame) -> DataFrame:
    """The row of ``docs`` that stays of each component of ``found`` (fp, component), chosen by
    folding ``prints`` (doc_id, fp, digest): no component meets in a task, and a text travels only if
    its row stays."""
    place = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "digest", "n")
    folded = prints.groupBy("fp", "doc_id", "digest").agg(F.count(F.lit(1)).alias("n"))
    least = folded.groupBy("fp").agg(F.min(place).alias("stay"))
    stay = least.join(found.select("fp", "component"), "fp").groupBy("component").agg(F.min("stay").alias("stay"))
    stay = stored(stay.select("stay.doc_id", "stay.digest", "stay.n"), "stay")
    rows = docs.select(
        row_struct(docs),
        F.col("doc_id").cast("bigint").alias("_id"),
        F.unhex(text_digest(F.col(f"`{text}`"))).alias("_digest"),
    )

    def met(chosen: DataFrame) -> DataFrame:
        same = F.col("_id").eqNullSafe(F.col("doc_id")) & (F.col("_digest") == F.col("digest"))
        return rows.join(small_side(chosen), same, "left_semi")

    kept = met(stay.filter("n = 1"))
    repeated = stay.filter("n > 1")
    if not repeated.isEmpty():
        # Rows of one doc_id and one text: one stays, folded before the shuffle.
        single = met(repeated).groupBy("_id", "_digest").agg(F.min_by("_row", F.to_json("_row")).alias("_row"))
        kept = kept.select("_row").unionByName(single.select("_row"))
    return kept.select(*unpacked(kept, docs.columns, []))
