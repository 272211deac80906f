"""Best-fit decreasing packing of tokenised documents into sequences.

Bins with the same remaining capacity and pieces of the same length are interchangeable, so the
packing of any number of pieces follows from how many there are of each length: at most
``capacity`` numbers. The planner visits lengths from the longest down, finds the tightest open
capacity in a segment tree over the remaining capacities in logarithmic time, and writes down runs:
"pieces rank .. of this length go to bins .. at this offset". Spark counts the lengths, numbers
the pieces within each length, and looks every piece up in the runs.
"""

from __future__ import annotations

import os
import re
import zlib
from collections import deque
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from flowsieve.llm.common import release_memory, small_batches, stored

CAPACITY = 2048
END_ID = 0
KNOWN = 200_000
LINE = 256
PIECES = "doc_id bigint, piece int, start bigint, length bigint, ids_crc32 bigint"
# Fixed: the word pattern of the vocabulary file.
WORD = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+")
# Fixed: what may stand in a text that is split into words before encoding. These characters are
# left alone by NFC and their only white space is blank, tab and line ends; anything else, and
# the marks of special tokens, sends the whole text to the tokenizer as it is.
UNUSUAL = re.compile(r"[^\t\n\r\x20-\x7e\xa1-\u024f]")
MARK_START = "<|"
SPECIAL = re.compile(r"[0-9'_\xb2\xb3\xb9\xbc-\xbe]")
MARKS = re.compile(r"[^\w\s]+")


class Memory(dict):
    """A dictionary of bounded size: two generations, of which the older is forgotten when the newer
    is full. What is used moves to the newer one. A key that is not known gets an empty value, to be
    filled in place; the two are put down in ``wanted`` and ``empty``."""

    def __init__(self, most: int):
        self.most, self.old, self.wanted, self.empty = most, {}, [], []

    def __missing__(self, key):
        found = self.old.get(key)
        if found is None:
            found = bytearray()
            self.wanted.append(key)
            self.empty.append(found)
        self[key] = found
        return found

    def turn(self) -> None:
        """Begin the next generation if this one is full."""
        if len(self) >= self.most:
            self.old = dict(self)
            self.clear()

    def forget(self) -> None:
        """Between tasks a worker, which may go on to other work, keeps nothing."""
        self.clear()
        self.old, self.wanted, self.empty = {}, [], []


class WordTokenizer:
    """Ids of whole texts by a word-level BPE file, remembering what it has encoded.

    Such a file drops white space and encodes words one by one, so each distinct word is encoded
    once; the memory holds at most ``known`` words a generation. New words are encoded in lines of
    ``LINE``, which are cut where a token ends a word. Texts with unusual characters are encoded
    whole.
    """

    def __init__(self, path: str, known: int = KNOWN):
        self.tokenizer = Tokenizer.from_file(path)
        self.words = Memory(known)
        suffix = getattr(self.tokenizer.model, "end_of_word_suffix", None)
        tokens = self.tokenizer.get_vocab()
        self.ends = np.zeros(max(tokens.values(), default=0) + 1, bool)
        if suffix:
            self.ends[[i for token, i in tokens.items() if token.endswith(suffix)]] = True

    def _encode(self, texts: list[str]) -> list[bytes]:
        found = self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)
        return [np.array(e.ids, dtype="<u4").tobytes() for e in found]

    def _encode_words(self, words: list[str]) -> list[bytes]:
        """Ids of each word; a line whose words cannot be told apart is encoded word by word."""
        lines = [words[i : i + LINE] for i in range(0, len(words), LINE)]
        found = self.tokenizer.encode_batch_fast([" ".join(line) for line in lines], add_special_tokens=False)
        out = []
        for line, encoding in zip(lines, found):
            ids = np.array(encoding.ids, dtype="<u4")
            stops = 4 * (np.flatnonzero(self.ends[ids]) + 1)
            if len(stops) != len(line) or stops[-1] != 4 * len(ids):
                out.extend(self._encode(line))
                continue
            data, stops = ids.tobytes(), stops.tolist()
            out.extend([data[i:j] for i, j in zip([0, *stops], stops)])
        return out

    def encode(self, texts: list[str]) -> list[bytes]:
        """Little-endian unsigned 32-bit ids of each text."""
        split = [None if MARK_START in text or UNUSUAL.search(text) else text_words(text.lower()) for text in texts]
        self.words.turn()
        word = self.words.__getitem__
        try:
            parts = [None if words is None else list(map(word, words)) for words in split]
            new, empty = self.words.wanted, self.words.empty
            self.words.wanted, self.words.empty = [], []
            for i in range(0, len(new), 16 * LINE):
                for value, ids in zip(empty[i : i + 16 * LINE], self._encode_words(new[i : i + 16 * LINE])):
                    value += ids
        except BaseException:
            self.words.forget()  # it may hold values that were not filled
            raise
        return [
            self._encode([text])[0] if ids is None else b"".join(ids) for text, ids in zip(texts, parts)
        ]


def text_words(text: str) -> list[str]:
    """Words of a lower-case text of plain characters by the file's pattern. Where no numeral,
    apostrophe or underscore occurs, these are what is left after setting marks apart."""
    if SPECIAL.search(text):
        return WORD.findall(text)
    return MARKS.sub(r" \g<0> ", text).split()


@lru_cache(maxsize=2)
def _tokenizer(path: str) -> WordTokenizer:
    return WordTokenizer(path)


def _cutter(path: str, capacity: int, end_id: int, with_ids: bool):
    end = np.array([end_id], dtype="<u4").tobytes()

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # A task has one core: threads beside it would spend the time of other tasks' cores.
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        tokenizer = _tokenizer(path)
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                texts = [t or "" for t in part.column(1).to_pylist()]
                keys, piece, start, length, crc, ids = [], [], [], [], [], []
                for key, body in zip(part.column(0).to_pylist(), tokenizer.encode(texts)):
                    body += end
                    for n, low in enumerate(range(0, len(body), 4 * capacity)):
                        cut_ids = body[low : low + 4 * capacity]
                        keys.append(key)
                        piece.append(n)
                        start.append(low // 4)
                        length.append(len(cut_ids) // 4)
                        crc.append(zlib.crc32(cut_ids))
                        ids.append(cut_ids)
                columns = [
                    pa.array(keys, pa.int64()), pa.array(piece, pa.int32()),
                    pa.array(start, pa.int64()), pa.array(length, pa.int64()),
                    pa.array(crc, pa.int64()),
                ]
                names = ["doc_id", "piece", "start", "length", "ids_crc32"]
                if with_ids:
                    columns.append(
                        pa.array([np.frombuffer(i, "<u4").astype("i4") for i in ids], pa.list_(pa.int32()))
                    )
                    names.append("ids")
                yield pa.RecordBatch.from_arrays(columns, names)
        tokenizer.words.forget()
        release_memory()

    return cut


def token_pieces(
    docs: DataFrame,
    vocabulary: str,
    capacity: int = CAPACITY,
    end_id: int = END_ID,
    text: str = "text",
    with_ids: bool = False,
) -> DataFrame:
    """Pieces of at most ``capacity`` ids of every document: doc_id, piece (from 0), start, length,
    ids_crc32 (of the little-endian unsigned 32-bit ids) and, if asked for, the ids.

    A document is its text's ids and ``end_id``; a null text is empty, so every row gives at least
    one piece. Only documents longer than the capacity are cut. Rows that repeat a doc_id are
    documents of their own. ``vocabulary`` is a path every executor can open.
    """
    schema = PIECES + (", ids array<int>" if with_ids else "")
    return small_batches(docs).select("doc_id", F.col(f"`{text}`")).mapInArrow(
        _cutter(vocabulary, capacity, end_id, with_ids), schema
    )


class CapacityTree:
    """Segment tree over remaining capacities 0..capacity; a leaf holds the open bins left with it,
    as runs [first, end) of bin numbers. An inner node counts the runs below it."""

    def __init__(self, capacity: int):
        self.leaves = 1 << capacity.bit_length()
        self.count = [0] * (2 * self.leaves)
        self.runs: list[deque] = [deque() for _ in range(capacity + 1)]

    def _add(self, room: int, n: int) -> None:
        node = room + self.leaves
        while node:
            self.count[node] += n
            node >>= 1

    def put(self, room: int, first: int, end: int) -> None:
        if room and first < end:
            self.runs[room].append((first, end))
            self._add(room, 1)

    def take(self, room: int) -> tuple[int, int]:
        self._add(room, -1)
        return self.runs[room].popleft()

    def tightest(self, length: int) -> int | None:
        """The smallest room of an open bin that is at least ``length``."""
        node = length + self.leaves
        if self.count[node]:
            return length
        while node > 1:  # up to the first right-hand neighbour with open bins, then down
            if node % 2 == 0 and self.count[node + 1]:
                node += 1
                while node < self.leaves:
                    node = 2 * node if self.count[2 * node] else 2 * node + 1
                return node - self.leaves
            node >>= 1
        return None


def best_fit_runs(lengths: dict[int, int], capacity: int = CAPACITY) -> list[tuple]:
    """Best-fit decreasing over counted lengths: runs (length, rank, first_bin, each, offset).

    Pieces of ``length`` from number ``rank`` on go ``each`` to a bin, to bins from ``first_bin``
    on, the first at ``offset``. The result equals packing the pieces one by one: after a piece
    fits the tightest bin with room r, what is left is tighter still, so the bin takes r // length
    of them before another is opened or looked at.
    """
    tree, bins, runs = CapacityTree(capacity), 0, []
    for length in sorted(lengths, reverse=True):
        left, rank = lengths[length], 0
        while left:
            room = tree.tightest(length)
            if room is None:
                each = capacity // length
                for n, count in ((left // each, each), (min(1, left % each), left % each)):
                    if n:
                        runs.append((length, rank, bins, count, 0))
                        tree.put(capacity - count * length, bins, bins + n)
                        rank, bins = rank + n * count, bins + n
                break
            first, end = tree.take(room)
            each = room // length
            whole = min(end - first, left // each)
            for n, count in ((whole, each), (int(whole < end - first), left - whole * each)):
                if n and count:
                    runs.append((length, rank, first, count, capacity - room))
                    tree.put(room - count * length, first, first + n)
                    rank, left, first = rank + n * count, left - n * count, first + n
            tree.put(room, first, end)
    return runs


def _ranked(pieces: DataFrame) -> DataFrame:
    """Pieces numbered within their length from 0.

    Pieces are dealt into buckets by key, as many as a sixteenth of the root of their number;
    numbers run inside (bucket, length) and start where the lower buckets of the length end.
    """
    n = pieces.count()
    buckets = max(1, int(n**0.5) // 16)
    dealt = pieces.withColumn("_bucket", F.pmod(F.xxhash64("doc_id", "piece"), F.lit(buckets)))
    counts = dealt.groupBy("length", "_bucket").agg(F.count(F.lit(1)).alias("_n"))
    before = Window.partitionBy("length").orderBy("_bucket").rowsBetween(
        Window.unboundedPreceding, -1
    )
    starts = counts.select(
        "length", "_bucket", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_start")
    )
    inside = Window.partitionBy("length", "_bucket").orderBy("doc_id", "piece", "ids_crc32")
    return (
        dealt.withColumn("_place", F.row_number().over(inside) - 1)
        .join(starts, ["length", "_bucket"])
        .withColumn("_rank", F.col("_start") + F.col("_place"))
        .drop("_bucket", "_start", "_place")
    )


def pack(pieces: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """Pieces with sequence_id and offset (gapless from 0 inside a sequence).

    ``pieces`` has doc_id, piece, length (1 to ``capacity``) and ids_crc32, and should be stored:
    it is read twice. Only the count of each length reaches the driver, at most ``capacity``
    numbers; the runs that go back are as few as the lengths allow, whatever the number of pieces.
    """
    counts = {r[0]: r[1] for r in pieces.groupBy("length").count().collect()}
    runs = np.array(best_fit_runs(counts, capacity), dtype=np.int64).reshape(-1, 5)
    step = int(runs[:, 1].max()) + 1 if len(runs) else 1
    if step > 2**62 // (capacity + 1):
        raise ValueError("too many pieces of one length for 64-bit places")
    keys = runs[:, 0] * step + runs[:, 1]
    order = np.argsort(keys, kind="stable")
    keys, runs = keys[order], runs[order]
    ranked = _ranked(pieces)
    columns = [c for c in ranked.columns if c != "_rank"]

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            length = batch.column(batch.schema.get_field_index("length")).to_numpy()
            rank = batch.column(batch.schema.get_field_index("_rank")).to_numpy()
            # The last run of the length that starts at or before the rank.
            inside = np.minimum(rank, step - 1)
            run = runs[np.searchsorted(keys, length * step + inside, side="right") - 1]
            i = rank - run[:, 1]
            yield pa.RecordBatch.from_arrays(
                [batch.column(batch.schema.get_field_index(c)) for c in columns]
                + [
                    pa.array(run[:, 2] + i // run[:, 3], pa.int64()),
                    pa.array(run[:, 4] + i % run[:, 3] * length, pa.int64()),
                ],
                [*columns, "sequence_id", "offset"],
            )

    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in ranked.schema if f.name != "_rank")
    return ranked.mapInArrow(place, f"{kinds}, sequence_id bigint, offset bigint")


def pack_documents(
    docs: DataFrame, vocabulary: str, capacity: int = CAPACITY, end_id: int = END_ID
) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32, sequence_id, offset of every piece of ``docs``.

    Other columns of ``docs`` play no part. An empty table gives an empty table.
    """
    return pack(stored(token_pieces(docs, vocabulary, capacity, end_id), "pieces"), capacity)


def packed_sequences(placed: DataFrame, ids: str = "ids") -> DataFrame:
    """The sequences themselves: sequence_id, doc_ids, ids, from placed pieces with their ids.

    A group is one sequence, at most its capacity of ids."""
    parts: Column = F.array_sort(F.collect_list(F.struct("offset", "doc_id", ids)))
    return placed.groupBy("sequence_id").agg(parts.alias("_parts")).select(
        "sequence_id",
        F.transform("_parts", lambda p: p["doc_id"]).alias("doc_ids"),
        F.flatten(F.transform("_parts", lambda p: p[ids])).alias("ids"),
    )
