"""Exact dedup, near dedup, suffix dedup, sharding, mixing and packing on small tables."""

import hashlib
import os
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from flowsieve.llm import exact_dedup, mixing, packing, simhash, slots, suffix_dedup
from flowsieve.llm.components import connected_components
from flowsieve.llm.registry import QUERIES, vocabulary_path

SCHEMA = (
    "doc_id bigint, text string, lang string, source string, n_chars bigint, "
    "size string, kept string, shard string, fp string, taken string, length string"
)
EXTRA = ("x",) * 6
AWKWARD = [
    (1, "a b  c", "en", "s", 6),
    (2, "a b c", None, None, 5),
    (2, "a b c", None, None, 5),
    (3, None, "en", "s", None),
    (4, "", "en", "t", 0),
    (None, "a\tb c", "en", "t", 5),
    (None, None, None, None, None),
    (5, "word " * 30_000, "en", "u", 150_000),
    (6, " \n ", "en", "u", 3),
    (7, "zz", "en", "u", 2),
]


@pytest.fixture(scope="module")
def awkward(spark):
    return spark.createDataFrame([row + EXTRA for row in AWKWARD], SCHEMA)


@pytest.fixture(scope="module")
def nothing(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="module")
def documents(spark, sf_dir):
    return spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text", "source")


def rows_of(frame):
    return [tuple(r) for r in frame.collect()]


def test_copies_are_marked_once_per_group(awkward):
    found = exact_dedup.mark_duplicates(awkward, counters=2)
    assert found.columns[-4:] == ["keep_id", "group_size", "kept", "text_sha256"]
    assert found.columns.count("kept") == 1
    rows = found.select("doc_id", "text", "keep_id", "group_size", "kept").collect()
    abc = [r for r in rows if r.text and r.text.startswith("a")]
    assert len(rows) == len(AWKWARD) and len(abc) == 4
    assert {(r.keep_id, r.group_size) for r in abc} == {(1, 4)} and sum(r.kept for r in abc) == 1
    empty = [r for r in rows if not r.text]
    assert {(r.keep_id, r.group_size) for r in empty} == {(3, 3)} and sum(r.kept for r in empty) == 1


@pytest.mark.parametrize("counters", [1, 3, 1000])
def test_split_does_not_change_what_stays(spark, documents, counters):
    hot = documents.unionByName(documents.limit(1).crossJoin(spark.range(300)).drop("id"))
    found = exact_dedup.mark_duplicates(hot, counters=counters)
    groups = defaultdict(list)
    for doc_id, text, _ in rows_of(hot):
        groups[re.sub(r"[\x20\x09-\x0d]+", " ", text)].append(doc_id)
    want = Counter(
        (i, min(ids), len(ids), hashlib.sha256(t.encode()).hexdigest()) for t, ids in groups.items() for i in ids
    )
    assert Counter(rows_of(found.select("doc_id", "keep_id", "group_size", "text_sha256"))) == want
    assert found.filter("kept").count() == len(groups)
    assert exact_dedup.drop_duplicates(hot, counters=counters).count() == len(groups)


def test_frequent_digests_are_all_proposed(spark):
    rows = spark.range(3000).select(
        F.when(F.col("id") % 3 == 0, "hot").otherwise(F.col("id").cast("string")).alias("d")
    )
    found, n = exact_dedup.frequent(rows, "d", 5)
    assert n == 3000 and "hot" in found and len(found) <= 5


def test_empty_tables(nothing, awkward):
    assert exact_dedup.mark_duplicates(nothing).count() == 0
    assert exact_dedup.drop_duplicates(nothing).count() == 0
    assert simhash.near_duplicates(nothing).count() == 0
    assert simhash.drop_near_duplicates(nothing).count() == 0
    assert suffix_dedup.remove_repeats(nothing).count() == 0
    assert mixing.mix(nothing).count() == 0
    assert mixing.mixed_documents(nothing).columns == nothing.columns
    assert packing.pack_documents(nothing, vocabulary_path()).count() == 0


def plain_fingerprint(text):
    words = [w for w in re.split(r"[\x20\x09-\x0d]+", text or "") if w]
    words = [re.sub("[A-Z]", lambda m: m[0].lower(), w) for w in words]
    if not words:
        return 0
    shingles = [" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def plain_components(prints):
    """doc -> smallest doc reachable, over all pairs."""
    ids = list(prints)
    parent = {i: i for i in ids}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    values = np.array([prints[i] for i in ids], np.uint64)
    for i, j in zip(*np.nonzero(np.bitwise_count(values[:, None] ^ values[None, :]) <= 2)):
        a, b = find(ids[i]), find(ids[j])
        parent[max(a, b)] = min(a, b)
    return {i: find(i) for i in ids}


def test_fingerprints_and_components_of_documents(spark, sf_dir, documents):
    prints = {i: plain_fingerprint(t) for i, t, _ in rows_of(documents)}
    want = plain_components(prints)
    got = rows_of(QUERIES["op5_simhash_pivots"](spark, sf_dir))
    assert {(i, "%016x" % prints[i], want[i]) for i in prints} == set(got)


@pytest.mark.parametrize("largest", [2, 8, 5000])
def test_near_fingerprints_are_all_linked(spark, largest):
    rng = np.random.default_rng(5)
    centres = rng.integers(0, 2**64, 12, dtype=np.uint64)
    values = []
    for centre in centres:
        value = centre
        for _ in range(25):  # chains and clouds
            value = value ^ np.uint64(1 << int(rng.integers(64)))
            values.append(int(value) if rng.random() < 0.5 else int(centre ^ np.uint64(1 << int(rng.integers(64)))))
    prints = dict(enumerate([*values, 0, 2**64 - 1, 0]))
    frame = spark.createDataFrame(
        [(i, v - (1 << 64) if v >> 63 else v) for i, v in prints.items()], "doc_id bigint, fp bigint"
    )
    found = frame.join(simhash.components(frame, largest=largest), "fp")
    assert dict(rows_of(found.select("doc_id", "component_id"))) == plain_components(prints)


def test_near_dedup_of_awkward_rows(awkward):
    found = simhash.near_duplicates(awkward)
    assert found.count() == len(AWKWARD)
    stay = simhash.drop_near_duplicates(awkward)
    assert stay.columns == awkward.columns
    assert sorted(r.doc_id for r in stay.collect()) == [1, 3, 5, 7]


def test_every_component_keeps_a_row_whatever_its_ids(spark):
    first, second, third, fourth = (" ".join(f"{c}{i}" for i in range(60)) for c in "abcd")
    rows = [(None, first), (None, first), (None, second), (5, third), (5, fourth), (5, third), (4, fourth), (None, third)]
    docs = spark.createDataFrame([(i, t, "en", "s", len(t)) + EXTRA for i, t in rows], SCHEMA)
    stay = simhash.drop_near_duplicates(docs).select("doc_id", "text")
    assert set(rows_of(stay)) == {(None, first), (None, second), (5, third), (4, fourth)}
    assert stay.count() == 4


def test_components_of_chains(spark):
    edges = [(i, i + 1) for i in range(1, 40)] + [(100, 101), (102, 101), (7, 7)]
    found = dict(rows_of(connected_components(spark.createDataFrame(edges, "a bigint, b bigint"))))
    assert found == {i: 1 for i in range(1, 41)} | {100: 100, 101: 100, 102: 100}


def plain_removal(texts, length):
    windows = Counter(t[i : i + length] for t in texts for i in range(len(t) - length + 1))
    out = []
    for t in texts:
        gone = np.zeros(len(t) + 1, int)
        for i in range(len(t) - length + 1):
            if windows[t[i : i + length]] > 1:
                gone[i] += 1
                gone[i + length] -= 1
        gone = np.cumsum(gone)[:-1] > 0 if len(t) else np.zeros(0, bool)
        kept = bytes(b for b, g in zip(t, gone) if not g)
        runs = int((np.diff(np.concatenate(([0], gone.astype(int)))) == 1).sum())
        out.append((len(t), len(t) - len(kept), runs, hashlib.sha256(kept).hexdigest()))
    return Counter(out)


@pytest.mark.parametrize("largest", [1, 3, 8192])
def test_repeated_strings_are_removed(spark, documents, largest):
    rng = np.random.default_rng(11)
    long = "".join(rng.choice(list("abcdé "), 3000))
    texts = [
        long[:700], "x" + long[100:900] + "y", long[50:260], long[61:259], "ab" * 400, "z" * 201, "z" * 199,
        None, "", long[1500:1700], "q" + long[1500:1700], long[1500:1699] + "!", long[2000:2300] * 2, "solo",
    ]
    texts += [t for _, t, _ in rows_of(documents.limit(40))]
    frame = spark.createDataFrame([(i // 2, t) for i, t in enumerate(texts)], "doc_id bigint, text string")
    found = suffix_dedup.remove_repeats(frame, largest=largest).collect()
    got = Counter((r.n_bytes, r.n_removed, len(r.spans), r.kept_sha256) for r in found)
    assert got == plain_removal([(t or "").encode() for t in texts], 200)
    assert all(hashlib.sha256(r.kept).hexdigest() == r.kept_sha256 for r in found)


@pytest.mark.parametrize("frequent", [1, 4, 512])
def test_frequent_strings_are_counted_by_kind(spark, monkeypatch, frequent):
    """One passage in most texts, in several surroundings, with copies of whole texts, texts above the
    size of a slice, rows without a doc_id and columns with the operator's names."""
    monkeypatch.setattr(suffix_dedup, "FREQUENT", frequent)
    monkeypatch.setattr(suffix_dedup, "CHUNK", 4096)
    rng = np.random.default_rng(2)
    letters = list("abcdefgh ")
    draw = lambda n: "".join(rng.choice(letters, n))
    line, passage = draw(230), draw(400)
    texts = [draw(int(rng.integers(0, 90))) + line + draw(int(rng.integers(0, 90))) for _ in range(40)]
    texts += [line] * 60 + [draw(300) + passage + line] * 5 + [draw(9000) + passage + draw(5000), "z" * 12_000, draw(150), None, ""]
    rows = [(None if i % 3 == 0 else i // 2, t, *"xxxxx") for i, t in enumerate(texts)]
    frame = spark.createDataFrame(
        rows, "doc_id bigint, text string, gram string, start string, doc string, spans string, kept string"
    ).repartition(5)
    found = suffix_dedup.remove_repeats(frame).collect()
    got = Counter((r.n_bytes, r.n_removed, len(r.spans), r.kept_sha256) for r in found)
    assert got == plain_removal([(t or "").encode() for t in texts], 200)


def test_suffix_sort_order_and_collisions(monkeypatch):
    rng = np.random.default_rng(3)
    buffer = rng.integers(0, 2, 900).astype(np.uint8)
    starts = rng.permutation(800)[:300]
    group = np.sort(rng.integers(0, 4, 300))
    sorter = suffix_dedup.SuffixSorter(buffer, 24)
    order = sorter.sort(starts, group)
    keys = [(group[i], buffer[starts[i] : starts[i] + 24].tobytes()) for i in order]
    assert keys == sorted(keys)
    # All substrings of one length collide: verification has to tell the windows apart.
    monkeypatch.setattr(
        suffix_dedup.PrefixHashes, "substring", lambda self, start, length: np.zeros(len(start), np.uint64)
    )
    bodies = [b"a" * 10 + b"b", b"a" * 10 + b"c", b"a" * 10 + b"b"]
    found = list(suffix_dedup.repeated_windows(bodies, [0, 0, 0], [1, 1, 1], 11))
    assert found == [(0, 0, 0), (2, 0, 0)]


def test_shards_are_even_and_places_gapless(spark, tmp_path, awkward, nothing, sf_dir):
    found = QUERIES["op3_virtual_slots"](spark, sf_dir.replace("0.001", "0.01")).toPandas()
    sizes = found.groupby("shard")["size"].sum()
    assert len(sizes) == 16 and sizes.max() / sizes.mean() < 1.01
    for _, part in found.groupby("shard"):
        assert sorted(part.slot) == list(range(len(part)))
    assert found.groupby("virtual_slot").shard.nunique().max() == 1
    texts = dict(rows_of(spark.read.parquet(sf_dir.replace("0.001", "0.01") + "/documents.parquet").select("doc_id", "text")))
    assert all(zlib.crc32(texts[r.doc_id].encode()) == r.text_crc32 for r in found.itertuples())
    odd = slots.shard_documents(awkward, 4, str(tmp_path / "map")).collect()
    assert len(odd) == len(AWKWARD) and {r["size"] for r in odd if r.text is None} == {1}
    assert slots.shard_documents(nothing, 4, str(tmp_path / "map2")).count() == 0


def test_rows_without_an_id_spread_over_the_slots(spark, documents, tmp_path):
    rows = documents.select(F.when(F.col("doc_id") % 3 > 0, F.col("doc_id") % 40).alias("doc_id"), "text")
    rows.unionByName(rows.select(F.lit(None).cast("bigint").alias("doc_id"), F.lit("same").alias("text"))).write.parquet(
        f"{tmp_path}/documents.parquet"
    )
    found = QUERIES["op3_virtual_slots"](spark, str(tmp_path)).toPandas()
    rows_a_slot = found.groupby("virtual_slot").size()
    assert len(found) == 2 * documents.count() and rows_a_slot.max() <= 10
    sizes = found.groupby("shard")["size"].sum()
    largest = found.groupby("virtual_slot")["size"].sum().max()
    assert sizes.max() - sizes.min() <= largest
    mixed = mixing.mix(rows.withColumn("source", F.lit("s")))
    shard = F.pmod(F.xxhash64("size"), F.lit(2))
    assert mixed.filter("doc_id is null and taken > 0").select(shard).distinct().count() == 2


def test_map_versions_move_few_slots(spark):
    loads = spark.range(64).select(
        F.col("id").cast("int").alias("virtual_slot"), (F.col("id") * 7 % 13 * 100 + 1).alias("bytes")
    )
    first = slots.first_map(spark, 4, 64)
    second = slots.edited_map(first, loads, 4)
    third = slots.edited_map(second, loads, 5)
    one, two, three = (
        {r.virtual_slot: r.shard for r in m.collect()} for m in (first, second, third)
    )
    assert {r.version for r in third.collect()} == {3} and len(three) == 64
    weight = {r.virtual_slot: r.bytes for r in loads.collect()}
    for mapping, n in ((two, 4), (three, 5)):
        load = Counter()
        for slot, shard in mapping.items():
            load[shard] += weight[slot]
        assert len(load) == n and max(load.values()) - min(load.values()) <= max(weight.values())
    assert sum(one[s] != two[s] for s in one) < 32 and sum(two[s] != three[s] for s in two) < 32


def test_quotas_are_the_highest_quotients(spark):
    shares = [53.0, 24.0, 23.0, 0.0, 1.5, 400.0, 0.2]
    parts = spark.createDataFrame([(0, i, s) for i, s in enumerate(shares)], "g int, place int, share double")
    for seats in (0, 1, 7, 30, 501):
        found = mixing.highest_quotients(parts, F.lit(seats), ["g"], "place")
        got = {r.place: r.quota for r in found.collect()}
        want = Counter()
        for _ in range(seats):
            want[max(range(len(shares)), key=lambda i: (shares[i] / (2 * want[i] + 1), -i))] += 1
        assert got == {i: want[i] for i in range(len(shares))}


def test_mix_meets_targets(spark, documents, awkward):
    found = mixing.mix(documents).collect()
    taken, target, size = Counter(), {}, Counter()
    for r in found:
        taken[r.source] += r.taken
        size[r.source] += r["size"]
        target[r.source] = r.target
        assert 0 <= r.taken <= 2 * r["size"]
        assert r.taken == r.passes * r["size"] + sum(x.end - x.first for x in r.ranges)
    assert abs(sum(target.values()) - 1.5 * sum(size.values())) < 1e-6
    for source in target:
        assert target[source] <= 2 * size[source] + 1e-9 and abs(taken[source] - target[source]) <= 64
    assert sorted(map(str, found)) == sorted(map(str, mixing.mix(documents.repartition(7)).collect()))
    odd = mixing.mix(awkward)
    assert odd.count() == len(AWKWARD) and odd.columns.count("size") == 1
    assert {r.taken for r in odd.collect() if not r.text} == {0}


def test_mixed_documents_carry_the_taken_words(documents):
    mixed = mixing.mixed_documents(documents)
    words = lambda t: len(re.findall(r"[^\x20\x09-\x0d]+", t))
    got = Counter()
    for r in mixed.collect():
        got[r.doc_id] += words(r.text)
    want = {r.doc_id: r.taken for r in mixing.mix(documents).collect() if r.taken}
    assert dict(got) == want


def plain_best_fit(lengths, capacity):
    rooms, bins = [], 0
    for length in sorted(lengths, reverse=True):
        fitting = [r for r in rooms if r >= length]
        if fitting:
            rooms.remove(min(fitting))
            rooms.append(min(fitting) - length)
        else:
            bins += 1
            rooms.append(capacity - length)
    return bins, sorted(rooms)


def test_counted_best_fit_is_best_fit_decreasing():
    rng = np.random.default_rng(1)
    for capacity, n in ((10, 40), (64, 300), (100, 500), (7, 3), (2048, 400)):
        lengths = rng.integers(1, capacity + 1, n).tolist()
        room, seen = {}, Counter()
        for length, rank, first, each, offset in packing.best_fit_runs(Counter(lengths), capacity):
            assert rank == seen[length] or rank >= 0
            later = [r for r in packing.best_fit_runs(Counter(lengths), capacity) if r[0] == length and r[1] > rank]
            end = min([r[1] for r in later], default=Counter(lengths)[length])
            for i in range(end - rank):
                bin_, place = first + i // each, offset + i % each * length
                assert room.get(bin_, 0) == place
                room[bin_] = place + length
            seen[length] = end
        bins, rooms = plain_best_fit(lengths, capacity)
        assert len(room) == bins and sorted(capacity - u for u in room.values()) == rooms


def test_packed_documents(spark, documents, awkward):
    from tokenizers import Tokenizer

    placed = packing.pack_documents(awkward, vocabulary_path()).toPandas()
    assert placed.groupby("sequence_id").length.sum().max() <= 2048
    pieces = packing.token_pieces(documents.limit(60), vocabulary_path(), with_ids=True)
    stored = packing.stored(pieces, "test-pieces")
    found = packing.packed_sequences(packing.pack(stored, 2048)).collect()
    tokenizer = Tokenizer.from_file(vocabulary_path())
    want = Counter()
    for _, text, _ in rows_of(documents.limit(60)):
        want.update([*tokenizer.encode(text, add_special_tokens=False).ids, 0])
    assert sum((Counter(r.ids) for r in found), Counter()) == want
    for r in placed.itertuples():
        assert 1 <= r.length <= 2048
    plan = placed.sort_values(["sequence_id", "offset"])
    assert (plan.offset == plan.groupby("sequence_id").length.cumsum() - plan.length).all()


def test_unusual_texts_get_the_tokenizers_ids():
    from tokenizers import Tokenizer

    plain = Tokenizer.from_file(vocabulary_path())
    own = packing.WordTokenizer(vocabulary_path(), known=5)
    texts = [
        "It's  DON'T we'll\tx\n 12a b_c", "ÀÉ ß İstanbul naïve", "a b", "<|endoftext|> x", "", "日本語 テスト",
        "éa", "\x1c a\x85b", "'s 't''re", "one two three four five six seven one two",
    ]
    texts += [f"a{chr(c)}b {chr(c)}" for c in range(0x20, 0x300)]
    want = [np.array(plain.encode(t, add_special_tokens=False).ids, "<u4").tobytes() for t in texts]
    assert own.encode(texts) == want and own.encode(texts) == want


def test_a_packing_task_encodes_on_its_own_core(monkeypatch):
    import pyarrow as pa

    texts = [None, "Two words.", "<|endoftext|> x", "odd\u2028space"]
    batch = pa.RecordBatch.from_arrays([pa.array(range(4), pa.int64()), pa.array(texts)], ["doc_id", "text"])
    monkeypatch.setenv("TOKENIZERS_PARALLELISM", "true")
    found = [b.to_pydict() for b in packing._cutter(vocabulary_path(), 2048, 0, True)(iter([batch]))]
    assert os.environ["TOKENIZERS_PARALLELISM"] == "true"  # a user's own setting stays
    monkeypatch.delenv("TOKENIZERS_PARALLELISM")
    assert [b.to_pydict() for b in packing._cutter(vocabulary_path(), 2048, 0, True)(iter([batch]))] == found
    assert os.environ["TOKENIZERS_PARALLELISM"] == "false"


def test_words_are_asked_for_once_and_forgotten_if_their_ids_are_not_found(monkeypatch):
    own, plain = packing.WordTokenizer(vocabulary_path(), known=6), packing.WordTokenizer(vocabulary_path())
    assert own.encode(["a red fox", "a red hen"]) == plain.encode(["a red fox", "a red hen"])
    asked, encode = [], own._encode_words
    monkeypatch.setattr(own, "_encode_words", lambda words: asked.append(list(words)) or encode(words))
    texts = ["a hen and a cow", "one more cow", "hen"]
    assert own.encode(texts) == plain.encode(texts) and asked == [["and", "cow", "one", "more"]]
    assert own.encode(["a fox"]) == plain.encode(["a fox"]) and len(asked) == 1 and len(own.words) == 2

    def fails(words):
        raise RuntimeError

    monkeypatch.setattr(own, "_encode_words", fails)
    with pytest.raises(RuntimeError):
        own.encode(["never seen"])
    monkeypatch.setattr(own, "_encode_words", encode)
    assert own.encode(["never seen"]) == plain.encode(["never seen"])
