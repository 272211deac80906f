"""Removal of long repeated byte strings by a hash-compared suffix sort.

A window is ``LENGTH`` bytes. Prefix polynomial hashes give the hash of any substring; the smallest
hash of a window's ``GRAM``-byte substrings (the leftmost of equals) is the window's anchor. Equal
windows have equal anchors at equal places, so windows only have to be compared with those of the
same anchor string, and one row per anchor, about one for 70 bytes, stands for all its windows.

Anchors are grouped by their string; those of very frequent strings are first counted by their
stretch, so that no string has to meet in a task. Anchors whose whole stretch of windows is equal are copies.
Where one string has different stretches, one stretch of each kind is fetched, and the suffixes
that start its windows are sorted by a mergesort whose comparisons find the common extension of two
suffixes by binary search over the prefix hashes. A window with an equal neighbour repeats; equal
hashes are verified on the bytes.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from flowsieve.llm.common import release_memory, small_batches, stored
from flowsieve.llm.exact_dedup import frequent

LENGTH = 200
GRAM = 64
CHUNK = 1 << 18
LARGEST_GROUP = 8192
SUFFIXES = 400_000
# As many anchor strings at most are counted by kind before they are shuffled.
FREQUENT = 512

_BASE = np.uint64(0xD6E8FEB86659FD93)
_INVERSE = np.uint64(pow(int(_BASE), -1, 1 << 64))
_BYTES = np.random.default_rng(20240301).integers(1, 2**64, 256, dtype=np.uint64)


class PrefixHashes:
    """Prefix polynomial hashes of a buffer modulo 2^64, and substring hashes from them."""

    powers = np.ones(1, np.uint64)
    inverses = np.ones(1, np.uint64)

    def __init__(self, buffer: np.ndarray):
        n = len(buffer) + 1
        if len(PrefixHashes.powers) < n:
            for name, base in (("powers", _BASE), ("inverses", _INVERSE)):
                full = np.full(n, base, np.uint64)
                full[0] = 1
                setattr(PrefixHashes, name, np.multiply.accumulate(full))
        self.prefix = np.zeros(n, np.uint64)
        np.cumsum(_BYTES[buffer] * PrefixHashes.powers[: n - 1], out=self.prefix[1:])

    def substring(self, start: np.ndarray, length) -> np.ndarray:
        return (self.prefix[start + length] - self.prefix[start]) * PrefixHashes.inverses[start]

    def every(self, length: int) -> np.ndarray:
        """Hashes of all substrings of one length, in order."""
        n = len(self.prefix) - length
        if n <= 0:
            return np.zeros(0, np.uint64)
        return (self.prefix[length:] - self.prefix[:n]) * PrefixHashes.inverses[:n]


def sliding_leftmost_minimum(values: np.ndarray, width: int) -> np.ndarray:
    """Position of the smallest of each ``width`` consecutive values, the leftmost of equals.

    Values are compared without their lowest byte. Running minima from both ends of blocks of
    ``width`` (at most 256) meet in the middle of every window.
    """
    n = len(values)
    blocks = -(-n // width) + 1
    packed = np.full(blocks * width, np.iinfo(np.uint64).max, np.uint64)
    packed[:n] = values
    table = packed.reshape(blocks, width)
    table &= ~np.uint64(255)
    table |= np.arange(width, dtype=np.uint64)
    ahead = np.minimum.accumulate(table, axis=1).ravel()
    behind = np.minimum.accumulate(table[:, ::-1], axis=1)[:, ::-1].ravel()
    start = np.arange(n - width + 1)
    left, right = behind[: len(start)], ahead[width - 1 : width - 1 + len(start)]
    block = start // width
    in_left = (left >> np.uint64(8)) <= (right >> np.uint64(8))
    place = np.where(in_left, left, right) & np.uint64(255)
    # A window that starts a block lies in it; others end in the next one.
    return (block + (~in_left & (start % width > 0))) * width + place.astype(np.int64)


def anchors(pieces: list[bytes], length: int = LENGTH, gram: int = GRAM):
    """Anchors of all windows inside each piece: piece, position, first and last window start
    (all but the first counted in the joined pieces), and the anchor string's hash."""
    joined = np.frombuffer(b"".join(pieces), np.uint8)
    sizes = np.fromiter(map(len, pieces), np.int64, len(pieces))
    empty = np.zeros(0, np.int64)
    if len(joined) < length:
        return empty, empty, empty, empty, np.zeros(0, np.uint64)
    hashes = PrefixHashes(joined).every(gram)
    mixed = hashes ^ (hashes >> np.uint64(31))
    mixed *= np.uint64(0x9E3779B97F4A7C15)
    mixed ^= mixed >> np.uint64(29)
    position = sliding_leftmost_minimum(mixed, length - gram + 1)
    ends = np.cumsum(sizes)
    piece = np.repeat(np.arange(len(pieces)), sizes)[: len(position)]
    inside = np.flatnonzero(np.arange(len(position)) + length <= ends[piece])
    at, of = position[inside], piece[inside]
    if not len(at):
        return empty, empty, empty, empty, np.zeros(0, np.uint64)
    new = np.flatnonzero(np.concatenate(([True], (at[1:] != at[:-1]) | (of[1:] != of[:-1]))))
    last = np.concatenate((new[1:], [len(at)])) - 1
    return of[new], at[new], inside[new], inside[last], hashes[at[new]]


def _slices(keys: list[int], texts: list[bytes], length: int) -> Iterator[list[tuple[int, int, bytes]]]:
    """Pieces (key, offset in the text, bytes) in groups of about CHUNK bytes. Longer texts are cut
    with an overlap that leaves every window in exactly one piece."""
    held, size = [], 0
    for key, text in zip(keys, texts):
        for low in range(0, max(len(text) - length + 1, 1), CHUNK):
            held.append((key, low, text[low : low + CHUNK + length - 1]))
            size += len(held[-1][2])
            if size >= CHUNK:
                yield held
                held, size = [], 0
    if held:
        yield held


def _anchor_rows(length: int, gram: int):
    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        digest = xxhash.xxh3_64_intdigest
        for batch in batches:
            keys = batch.column(0).to_pylist()
            texts = [t.as_buffer() if t.is_valid else b"" for t in batch.column(1)]
            texts = [bytes(t) for t in texts]
            for pieces in _slices(keys, texts, length):
                of, at, first, last, grams = anchors([p[2] for p in pieces], length, gram)
                if not len(of):
                    continue
                joined = b"".join(p[2] for p in pieces)
                sizes = np.fromiter((len(p[2]) for p in pieces), np.int64, len(pieces))
                offset = np.fromiter((p[1] for p in pieces), np.int64, len(pieces)) - (np.cumsum(sizes) - sizes)
                stretch = np.fromiter(
                    (digest(joined[s : e + length]) for s, e in zip(first.tolist(), last.tolist())),
                    np.uint64, len(of),
                )
                owner = np.fromiter((p[0] for p in pieces), np.int64, len(pieces))
                start = first + offset[of]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(grams.view(np.int64)), pa.array(stretch.view(np.int64)),
                        pa.array(((at - first) << 8) | (at - last)), pa.array(owner[of]), pa.array(start),
                    ],
                    ["gram", "stretch", "reach", "doc", "start"],
                )
        release_memory()

    return find


def document_key(doc_id: Column, text: Column) -> Column:
    """One key for rows that agree in doc_id and text; such rows have equal results."""
    return F.xxhash64(doc_id, text)


def anchor_table(docs: DataFrame, length: int = LENGTH, gram: int = GRAM) -> DataFrame:
    """gram, stretch, reach, doc, start of every anchor of ``docs`` (doc, text).

    ``start`` is the first window start, ``stretch`` a hash of all bytes of the anchor's windows and
    ``reach`` the distances from first and last window start to the anchor, as two bytes."""
    rows = small_batches(docs).select("doc", F.col("text").cast("binary").alias("text"))
    return rows.mapInArrow(
        _anchor_rows(length, gram), "gram bigint, stretch bigint, reach bigint, doc bigint, start bigint"
    )


KIND = ["gram", "stretch", "reach"]


def repeated_anchors(found: DataFrame) -> DataFrame:
    """Anchors whose string occurs more than once, with copies (number of equal stretches), several
    (the string has different stretches) and first (one of each kind of stretch).

    Windows run over sorted rows and spill; a string's rows are never held in memory together."""
    string, same = Window.partitionBy("gram"), Window.partitionBy(*KIND)
    marked = found.withColumns(
        {
            "several": (F.min("stretch").over(string) != F.max("stretch").over(string))
            | (F.min("reach").over(string) != F.max("reach").over(string)),
            "copies": F.count(F.lit(1)).over(same),
            "first": F.row_number().over(same.orderBy("doc", "start")) == 1,
        }
    )
    return marked.filter((F.col("copies") > 1) | F.col("several"))


def frequent_anchors(found: DataFrame, share: float) -> tuple[DataFrame, DataFrame]:
    """The same for the anchors of frequent strings, at most ``FREQUENT`` of them: the rows whose stretch
    has copies, and one row of each kind of stretch where a string has several kinds.

    Equal stretches fold to one row a task before any shuffle. Kinds with more than ``share`` rows, of
    which there are fewer than ``FREQUENT``, are sent to the rows; the others meet them by kind.
    """
    kinds = found.groupBy(*KIND).agg(F.count(F.lit(1)).alias("copies"), F.min(F.struct("doc", "start")).alias("at"))
    kinds = stored(kinds, "kinds")
    strings = kinds.groupBy("gram").agg((F.count(F.lit(1)) > 1).alias("several"))
    # One row per frequent string.
    first = kinds.join(F.broadcast(strings.filter("several")), "gram", "left_semi")
    repeated = kinds.filter("copies > 1").select(*KIND, "copies")
    heavy = F.broadcast(repeated.filter(F.col("copies") > share))
    light = repeated.filter(F.col("copies") <= share)
    rows = found.join(heavy, KIND).unionByName(found.join(heavy, KIND, "left_anti").join(light, KIND))
    return rows, first.select("gram", "reach", "at.doc", "at.start", "copies")


def _stretch_length(length: int) -> Column:
    windows = F.shiftright("reach", 8) - F.col("reach").bitwiseAND(F.lit(255))
    return windows + length


def fetch_stretches(asked: DataFrame, docs: DataFrame, length: int = LENGTH) -> DataFrame:
    """gram, reach, doc, start, alone, body: the bytes of the asked-for stretches."""
    wanted = asked.groupBy("doc").agg(
        F.collect_list(F.struct("gram", "reach", "start", (F.col("copies") == 1).alias("alone"))).alias("asks")
    )
    body = F.col("text").cast("binary")
    pieces = F.transform(
        "asks",
        lambda a: F.struct(
            a["gram"].alias("gram"), a["reach"].alias("reach"), a["start"].alias("start"), a["alone"].alias("alone"),
            F.substring(
                body, (a["start"] + 1).cast("int"),
                (F.shiftright(a["reach"], 8) - a["reach"].bitwiseAND(F.lit(255)) + length).cast("int"),
            ).alias("body"),
        ),
    )
    return docs.join(wanted, "doc").select("doc", F.inline(pieces))


class SuffixSorter:
    """Sorts suffixes of a buffer by their first ``length`` bytes with hash comparisons."""

    def __init__(self, buffer: np.ndarray, length: int):
        self.buffer, self.length = buffer, length
        self.hashes = PrefixHashes(buffer)

    def common(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Length of the common extension of suffixes a and b, at most ``length``: binary search
        for the longest prefix with equal hashes."""
        low = np.zeros(len(a), np.int64)
        high = np.full(len(a), self.length, np.int64)
        for _ in range(self.length.bit_length()):
            middle = (low + high + 1) >> 1
            same = self.hashes.substring(a, middle) == self.hashes.substring(b, middle)
            low = np.where(same, middle, low)
            high = np.where(same, high, np.maximum(middle - 1, low))
        return low

    def precedes(self, a: np.ndarray, b: np.ndarray, ties: np.ndarray) -> np.ndarray:
        """Whether suffix a sorts before b; equal ones do where ``ties``."""
        extent = self.common(a, b)
        equal = extent >= self.length
        inside = np.minimum(extent, self.length - 1)
        return np.where(equal, ties, self.buffer[a + inside] < self.buffer[b + inside])

    def sort(self, starts: np.ndarray, group: np.ndarray) -> np.ndarray:
        """Order of suffixes by group (given in ascending order) and then by suffix.

        Bottom-up mergesort of all groups together: every element finds its rank in the
        neighbouring run by binary search, so a level is a few vector operations."""
        n = len(starts)
        order = np.arange(n)
        low = np.searchsorted(group, group, side="left")
        high = np.searchsorted(group, group, side="right")
        place, width = np.arange(n) - low, 1
        largest = int((high - low).max()) if n else 0
        while width < largest:
            run = place // width
            other = low + (run ^ 1) * width
            first, last = np.minimum(other, high), np.minimum(other + width, high)
            active = np.flatnonzero(last > first)
            a, b = first[active].copy(), last[active].copy()
            mine, leftmost = starts[order[active]], run[active] % 2 == 0
            while True:
                open_ = np.flatnonzero(a < b)
                if not len(open_):
                    break
                middle = (a[open_] + b[open_]) >> 1
                theirs = starts[order[middle]]
                # Elements of the right run go behind equal ones of the left run.
                before = self.precedes(theirs, mine[open_], ~leftmost[open_])
                a[open_[before]] = middle[before] + 1
                b[open_[~before]] = middle[~before]
            to = np.arange(n)
            pair = low + (run // 2) * 2 * width
            inside = np.arange(n) - (low + run * width)
            to[active] = pair[active] + inside[active] + (a - first[active])
            merged = np.empty(n, np.int64)
            merged[to] = order
            order, width = merged, width * 2
        return order

    def verified_equal(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Whether the bytes of suffixes agree, for pairs with equal hashes."""
        reach = np.arange(self.length)
        equal = np.zeros(len(a), bool)
        for i in range(0, len(a), 8192):
            x, y = a[i : i + 8192, None] + reach, b[i : i + 8192, None] + reach
            equal[i : i + 8192] = (self.buffer[x] == self.buffer[y]).all(axis=1)
        return equal


def repeated_windows(bodies: list[bytes], reaches: list[int], strings: list[int], length: int):
    """(body, first window, last window) of each run of windows that occur in another place.

    A window is compared with those of the same anchor string and distance to the anchor."""
    buffer = np.frombuffer(b"".join(bodies), np.uint8)
    sizes = np.fromiter(map(len, bodies), np.int64, len(bodies))
    base = np.cumsum(sizes) - sizes
    windows = sizes - length + 1
    body = np.repeat(np.arange(len(bodies)), windows)
    window = np.arange(len(body)) - np.repeat(np.cumsum(windows) - windows, windows)
    distance = (np.array(reaches, np.int64) >> 8)[body] - window
    _, number = np.unique(np.array(strings, np.int64), return_inverse=True)
    group = number[body] * (length + 1) + distance
    by_group = np.argsort(group, kind="stable")
    starts = (base[body] + window)[by_group]
    group = group[by_group]
    sorter = SuffixSorter(buffer, length)
    order = sorter.sort(starts, group)
    one, two = starts[order[:-1]], starts[order[1:]]
    pairs = np.flatnonzero(group[order[:-1]] == group[order[1:]])
    pairs = pairs[sorter.common(one[pairs], two[pairs]) >= length]
    sure = sorter.verified_equal(one[pairs], two[pairs])
    repeats = np.zeros(len(starts), bool)
    repeats[order[pairs[sure]]] = True
    repeats[order[pairs[sure] + 1]] = True
    for wrong in np.unique(group[order[pairs[~sure]]]):  # a hash collision: settle by the bytes
        members = np.flatnonzero(group == wrong)
        texts = [buffer[s : s + length].tobytes() for s in starts[members]]
        repeats[members] = [texts.count(t) > 1 for t in texts]
    marked = np.zeros(len(starts), bool)
    marked[by_group] = repeats
    at = np.flatnonzero(marked)
    if not len(at):
        return []
    new = np.concatenate(([True], (at[1:] != at[:-1] + 1) | (body[at[1:]] != body[at[:-1]])))
    first = np.flatnonzero(new)
    last = np.concatenate((first[1:], [len(at)])) - 1
    return zip(body[at[first]].tolist(), window[at[first]].tolist(), window[at[last]].tolist())


def _compare_stretches(length: int, largest: int):
    """Rows sorted by string in; spans of repeated windows out. Strings with more stretches than
    ``largest`` are passed on as they are."""

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []  # whole strings waiting, then the current one
        current: list[tuple] = []
        string, hot, size = None, False, 0

        def batch_of(rows):
            names = ["doc", "start", "end", "gram", "reach", "alone", "body"]
            kinds = [pa.int64()] * 5 + [pa.bool_(), pa.binary()]
            return pa.RecordBatch.from_arrays(
                [pa.array([r[i] for r in rows], k) for i, k in enumerate(kinds)], names
            )

        def settle(rows):
            spans = []
            for i, low, high in repeated_windows(
                [r[5] for r in rows], [r[1] for r in rows], [r[0] for r in rows], length
            ):
                _, _, doc, start, alone, _ = rows[i]
                if alone:
                    spans.append((doc, start + low, start + high + length, None, None, None, None))
            return batch_of(spans)

        def raw(rows):
            return batch_of([(d, s, None, g, r, a, b) for g, r, d, s, a, b in rows])

        for batch in batches:
            for row in zip(*[c.to_pylist() for c in batch.columns]):
                if row[0] != string:
                    if hot and current:
                        yield raw(current)
                    elif len(current) > 1:
                        held.extend(current)
                    string, current, hot = row[0], [], False
                    if size >= SUFFIXES:
                        if held:
                            yield settle(held)
                        held, size = [], 0
                if hot:
                    current.append(row)
                    if len(current) >= 1024:
                        yield raw(current)
                        current = []
                    continue
                current.append(row)
                size += len(row[5]) - length + 1
                if len(current) > largest:
                    yield raw(current)
                    current, hot = [], True
        if hot and current:
            yield raw(current)
        elif len(current) > 1:
            held.extend(current)
        if held:
            yield settle(held)

    return compare


def _hot_spans(hot: DataFrame, length: int) -> DataFrame:
    """Spans for strings with very many stretches: their windows themselves are the keys, counted
    with partial aggregation, so that no group has to be held or compared."""
    last = F.shiftright("reach", 8) - F.col("reach").bitwiseAND(F.lit(255))
    windows = hot.select(
        "doc", "start", "alone", "body", F.explode(F.sequence(F.lit(0).cast("bigint"), last)).alias("w")
    ).select(
        "doc", "alone", (F.col("start") + F.col("w")).alias("start"),
        F.substring(F.col("body"), (F.col("w") + 1).cast("int"), F.lit(length)).alias("window"),
    )
    repeated = windows.groupBy("window").count().filter("count > 1").select("window")
    return windows.filter("alone").join(repeated, "window").select(
        "doc", "start", (F.col("start") + length).alias("end")
    )


def repeated_spans(
    docs: DataFrame, length: int = LENGTH, gram: int = GRAM, largest: int = LARGEST_GROUP
) -> DataFrame:
    """doc, start, end of byte spans that together cover every repeated window of ``docs``
    (doc, text); spans of a document may overlap."""
    if not 0 < length - gram < 256:
        raise ValueError("gram must be shorter than length by 1 to 255 bytes")
    every = stored(anchor_table(docs, length, gram), "anchors")
    hot, n = frequent(every.select(F.col("gram").cast("string")), "gram", FREQUENT)
    is_hot = F.col("gram").isin([int(g) for g in hot]) if hot else F.lit(False)
    found = stored(repeated_anchors(every.filter(~is_hot)), "repeated-anchors")
    rows, asked = found.filter("copies > 1"), found.filter("several AND first")
    asked = asked.select("gram", "reach", "doc", "start", "copies")
    if hot:
        more, more_asked = frequent_anchors(every.filter(is_hot), n / (FREQUENT + 1))
        rows, asked = rows.select("doc", "start", "reach").unionByName(more.select("doc", "start", "reach")), asked.unionByName(more_asked)
    copies = rows.select("doc", "start", (F.col("start") + _stretch_length(length)).alias("end"))
    stretches = fetch_stretches(asked, docs, length)
    ordered = stretches.select("gram", "reach", "doc", "start", "alone", "body")
    ordered = ordered.repartition("gram").sortWithinPartitions("gram")
    compared = stored(
        ordered.mapInArrow(
            _compare_stretches(length, largest),
            "doc bigint, start bigint, end bigint, gram bigint, reach bigint, alone boolean, body binary",
        ),
        "compared",
    )
    spans = compared.filter("end IS NOT NULL").select("doc", "start", "end")
    hot = compared.filter("end IS NULL")
    return copies.unionByName(spans).unionByName(_hot_spans(hot, length))


def merged(spans: list) -> list[tuple[int, int]]:
    """Maximal runs of bytes covered by the spans, in order; touching spans are one run."""
    runs: list[list[int]] = []
    for start, end in sorted((s["start"], s["end"]) for s in spans):
        if runs and start <= runs[-1][1]:
            runs[-1][1] = max(runs[-1][1], end)
        else:
            runs.append([start, end])
    return [tuple(r) for r in runs]


def _cutter(with_kept: bool):
    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
        for batch in batches:
            sizes, removed, runs, left, digests = [], [], [], [], []
            for body, spans in zip(batch.column(1), batch.column(2).to_pylist()):
                text = bytes(body.as_buffer()) if body.is_valid else b""
                kept, at = [], 0
                runs.append([{"start": s, "end": e} for s, e in merged(spans or [])])
                for run in runs[-1]:
                    kept.append(text[at : run["start"]])
                    at = run["end"]
                kept = b"".join([*kept, text[at:]])
                sizes.append(len(text))
                removed.append(len(text) - len(kept))
                digests.append(hashlib.sha256(kept).hexdigest())
                if with_kept:
                    left.append(kept)
            columns = {
                "doc_id": batch.column(0),
                "n_bytes": pa.array(sizes, pa.int64()),
                "n_removed": pa.array(removed, pa.int64()),
                "spans": pa.array(runs, kind),
                "kept_sha256": pa.array(digests, pa.string()),
            }
            if with_kept:
                columns["kept"] = pa.array(left, pa.binary())
            yield pa.RecordBatch.from_arrays(list(columns.values()), list(columns))

    return cut


def remove_repeats(
    docs: DataFrame,
    text: str = "text",
    length: int = LENGTH,
    gram: int = GRAM,
    largest: int = LARGEST_GROUP,
    with_kept: bool = True,
) -> DataFrame:
    """doc_id, n_bytes, n_removed, spans (removed runs), kept_sha256 and, if wanted, the kept bytes
    of every row of ``docs``.

    A byte goes if a string of ``length`` bytes over it also starts anywhere else in the table, the
    same text included; strings do not cross texts and are judged on the input. Null texts are
    empty. Rows that repeat a doc_id and text are occurrences of their own with equal results. Kept
    bytes may not be whole characters, hence their type. Other columns play no part. An empty
    table gives an empty table.
    """
    body = F.coalesce(F.col(f"`{text}`"), F.lit(""))
    keyed = docs.select("doc_id", document_key(F.col("doc_id"), body).alias("doc"), body.alias("text"))
    spans = repeated_spans(keyed.select("doc", "text"), length, gram, largest)
    by_doc = spans.groupBy("doc").agg(F.collect_list(F.struct("start", "end")).alias("spans"))
    joined = keyed.join(by_doc, "doc", "left").select(
        F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("binary").alias("text"), "spans"
    )
    schema = (
        "doc_id bigint, n_bytes bigint, n_removed bigint, "
        "spans array<struct<start:bigint,end:bigint>>, kept_sha256 string"
    )
    return joined.mapInArrow(_cutter(with_kept), schema + (", kept binary" if with_kept else ""))
