"""Ranked lexical search with hashed max-sketches.

The weight of a term in a document is its query-independent impact, (10^9 tf) div (1000 tf + 8 m),
times the term's weight in the corpus. A document's impacts are folded into a sketch: coordinate j
is the largest impact of its terms that hash to j. For a query, the sum over its terms of weight
times the sketch's coordinate is never below the document's score. A task looks the terms of a batch
of queries up in the sketches of a block of documents, goes through the documents of each query in
falling order of their bounds, and scores them exactly from their terms until the next bound is below
the query's last kept score, which the task carries on from block to block.
"""

from __future__ import annotations

import heapq
import math
import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from flowsieve.llm.common import stored

TOP = 10
COORDINATES = 4096
BLOCK = 512
ITEMS, ITEM_CHARACTERS = 8192, 4_000_000
COUNTED = 300_000
# Fixed: bytes that no term holds become blanks, A-Z become a-z, all others stay. All bytes of
# characters beyond ASCII are term bytes, so this splits UTF-8 as the term pattern splits characters.
FOLD = bytes(
    b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b > 127 else 32 for b in range(256)
)


def text_terms(text: str | None) -> list[bytes]:
    """Terms of a text: maximal runs of ASCII digits, letters and all other characters, A-Z folded."""
    return (text or "").encode("utf-8", "surrogatepass").translate(FOLD).split()


def _count_terms(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Terms with the number of a task's documents that hold them; under the empty term, the number
    of documents with a term and of all their terms."""

    def rows(found: Counter) -> Iterator[pa.RecordBatch]:
        yield pa.RecordBatch.from_arrays(
            [pa.array(found.keys(), pa.binary()), pa.array(found.values(), pa.int64()), pa.nulls(len(found), pa.int64())],
            ["term", "documents", "terms"],
        )

    found: Counter = Counter()
    documents = terms = 0
    for batch in batches:
        for text in batch.column(0):
            words = text_terms(text.as_py())
            if words:
                documents, terms = documents + 1, terms + len(words)
                found.update(set(words))
                if len(found) > COUNTED:
                    yield from rows(found)
                    found = Counter()
    yield from rows(found)
    yield pa.RecordBatch.from_arrays(
        [pa.array([b""], pa.binary()), pa.array([documents], pa.int64()), pa.array([terms], pa.int64())],
        ["term", "documents", "terms"],
    )


def corpus_counts(docs: DataFrame, text: str = "text") -> DataFrame:
    """term, documents (that hold it), terms: for every term of whole texts, and one row of the empty
    term with the number of documents that have a term and of all terms. Stored."""
    rows = docs.select(F.col(f"`{text}`")).mapInArrow(_count_terms, "term binary, documents bigint, terms bigint")
    return stored(rows.groupBy("term").agg(F.sum("documents").alias("documents"), F.sum("terms").alias("terms")), "terms")


@dataclass
class Queries:
    """A batch of items: distinct terms with their weights, and of each item its terms' places and
    repeats."""

    keys: list[int]
    weights: dict[bytes, int]
    terms: list[list[tuple[bytes, int]]]
    documents: int
    length: int

    def __post_init__(self):
        self.looked_up = []
        for terms in self.terms:
            total: Counter = Counter()
            for term, repeats in terms:
                total[coordinate(term)] += self.weights[term] * repeats
            places = np.fromiter(total, np.int64, len(total))
            self.looked_up.append((places, np.fromiter(total.values(), np.float64, len(total))))


def coordinate(term: bytes) -> int:
    return zlib.crc32(term) % COORDINATES


def term_weight(documents: int, holding: int) -> int:
    return math.floor(1000 * math.log((2 * documents + 2) / (2 * holding + 1)))


def _prepared(keys: list[int], texts: list[str | None], counts: DataFrame) -> Queries:
    """A batch of items with the corpus's counts of their terms."""
    found = [Counter(text_terms(t)) for t in texts]
    every = sorted(set().union(*found))
    spark = counts.sparkSession
    wanted = F.broadcast(spark.createDataFrame([(bytearray(t),) for t in every], "term binary"))
    rows = counts.join(wanted, "term", "left_semi").select("term", "documents").collect() if every else []
    holding = {bytes(r["term"]): r["documents"] for r in rows}
    total = counts.filter(F.length("term") == 0).first()
    n = total["documents"] if total else 0
    # A term of weight 0 adds nothing, and one that no document holds has no impact anywhere.
    weights = {t: w for t in holding if (w := term_weight(n, holding[t])) > 0}
    terms = [[(t, c) for t, c in f.items() if t in weights] for f in found]
    return Queries(keys, weights, terms, n, total["terms"] if total else 0)


def term_impact(tf: np.ndarray, m: np.ndarray) -> np.ndarray:
    return (1_000_000_000 * tf) // (1000 * tf + 8 * m)


def document_share(n: int, documents: int, length: int) -> int:
    """m of a document of n terms."""
    return 25 + (75 * n * documents) // length if length else 25


def _sketches(counts: list[Counter], shares: np.ndarray, places: dict[bytes, int]) -> np.ndarray:
    """Coordinates x documents: the largest impact of a document's terms at each coordinate."""
    sketch = np.zeros((COORDINATES, len(counts)))
    for d, found in enumerate(counts):
        if len(places) > COUNTED:
            places.clear()
        at = np.fromiter((places.get(t) or places.setdefault(t, coordinate(t)) for t in found), np.int64, len(found))
        tf = np.fromiter(found.values(), np.int64, len(found))
        np.maximum.at(sketch[:, d], at, term_impact(tf, shares[d]))
    return sketch


def _exact(terms: list[tuple[bytes, int]], weights: dict[bytes, int], found: Counter, share: int) -> int:
    score = 0
    for term, repeats in terms:
        tf = found.get(term)
        if tf:
            score += repeats * weights[term] * ((1_000_000_000 * tf) // (1000 * tf + 8 * share))
    return score


def _searcher(shared, top: int):
    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        queries = shared.value
        # Per query a heap of (score, order of the document turned round): the worst kept is first.
        best: list[list[tuple]] = [[] for _ in queries.keys]
        places: dict[bytes, int] = {}
        for batch in batches:
            for at in range(0, batch.num_rows, BLOCK):
                part = batch.slice(at, BLOCK)
                counts = [Counter(text_terms(t.as_py())) for t in part.column(1)]
                shares = np.array(
                    [document_share(sum(c.values()), queries.documents, queries.length) for c in counts], np.int64
                )
                ids = part.column(0).to_pylist()
                order = [(0, -i) if i is not None else (-1, 0) for i in ids]
                sketch = _sketches(counts, shares, places)
                for q, (coordinates, weights) in enumerate(queries.looked_up):
                    if len(coordinates):
                        bounds = weights @ sketch[coordinates]
                        _rescore(best[q], bounds, queries, q, counts, shares, order, top)
        rows = [(q, e) for q, heap in enumerate(best) for e in heap]
        yield pa.RecordBatch.from_arrays(
            [
                pa.array([queries.keys[q] for q, _ in rows], pa.int64()),
                pa.array([-e[1][1] if e[1][0] == 0 else None for _, e in rows], pa.int64()),
                pa.array([e[0] for _, e in rows], pa.int64()),
            ],
            ["item", "doc_id", "score"],
        )

    return search


def _rescore(heap: list, bounds: np.ndarray, queries: Queries, q: int, counts, shares, order, top: int) -> None:
    """Score a block's documents in falling order of their bounds while these can still get in: a
    document whose bound equals the last kept score may win the tie."""
    least = max(heap[0][0], 1) if len(heap) == top else 1
    possible = np.flatnonzero(bounds >= least)
    for d in possible[np.argsort(-bounds[possible], kind="stable")].tolist():
        if len(heap) == top and bounds[d] < heap[0][0]:
            break
        score = _exact(queries.terms[q], queries.weights, counts[d], int(shares[d]))
        if score > 0:
            entry = (score, order[d])
            if len(heap) < top:
                heapq.heappush(heap, entry)
            elif entry > heap[0]:
                heapq.heapreplace(heap, entry)


def ranked(
    docs: DataFrame,
    items: DataFrame,
    top: int = TOP,
    key: str = "doc_id",
    item: str = "item_id",
    text: str = "text",
) -> DataFrame:
    """item_id, rank (from 1), doc_id, score: the ``top`` highest-scoring documents of every item.

    All documents are scored or bounded for every item, whole texts. Null texts have no terms; an
    item without terms, or whose terms no document holds, has no rows. Rows that repeat an item_id
    are items of their own, rows that repeat a doc_id documents of their own; a null doc_id comes
    last among equal scores. Other columns play no part. Items go through the documents in batches
    of at most ``ITEMS``, of which a task holds the terms; a task hands on ``top`` rows an item.
    """
    counts = corpus_counts(docs, text)
    numbered = items.select(F.col(f"`{item}`").cast("bigint").alias("item_id"), F.col(f"`{text}`").alias("text"))
    numbered = stored(
        numbered.select(F.monotonically_increasing_id().alias("item"), "*"), "items"
    )
    rows = docs.select(F.col(f"`{key}`").cast("bigint").alias("doc_id"), F.col(f"`{text}`"))
    spark, found = docs.sparkSession, []
    for batch in _batches(numbered):
        queries = _prepared([r["item"] for r in batch], [r["text"] for r in batch], counts)
        shared = spark.sparkContext.broadcast(queries)
        hits = rows.mapInArrow(_searcher(shared, top), "item bigint, doc_id bigint, score bigint")
        order = Window.partitionBy("item").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
        best = hits.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= top)
        found.append(stored(best, "hits"))
    if not found:
        return spark.createDataFrame([], "item_id bigint, rank int, doc_id bigint, score bigint")
    every = found[0]
    for more in found[1:]:
        every = every.unionByName(more)
    return every.join(numbered.select("item", "item_id"), "item").select("item_id", "rank", "doc_id", "score")


def _batches(numbered: DataFrame) -> Iterator[list]:
    """The items in batches of at most ``ITEMS`` and about ``ITEM_CHARACTERS``, one batch in the
    driver at a time."""
    batch, characters = [], 0
    for row in numbered.toLocalIterator():
        batch.append(row)
        characters += len(row["text"] or "")
        if len(batch) == ITEMS or characters >= ITEM_CHARACTERS:
            yield batch
            batch, characters = [], 0
    if batch:
        yield batch


