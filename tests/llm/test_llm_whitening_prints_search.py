"""Whitening, multiset fingerprints and lexical search against plain versions on small tables."""

import hashlib
import math
import re
from collections import Counter, defaultdict

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from flowsieve.llm import lexical_search, multiset_hash, whitening
from flowsieve.llm.registry import QUERIES

VECTORS = "vec_id bigint, embedding array<float>, n string, x string, component string, whitened string"
DOCUMENTS = "doc_id bigint, text string, n_chars string, own string, copies string, fingerprint string"


# --- whitening


def plain_whitening(vectors, components=32):
    x = np.floor(64 * np.array(vectors, np.float64)).astype(np.int64) + 1_000_000
    n, sums = len(x), x.sum(axis=0)
    y = (n * x - sums) / n
    values, columns = np.linalg.eigh(y.T @ y / n)
    order = np.argsort(-values)[:components]
    deviation = ((n * x - sums).astype(object) ** 2).sum(axis=1)
    return values[order], y @ columns[:, order] / np.sqrt(values[order]), deviation, values.sum()


def test_whitened_embeddings_match_the_eigenvectors(spark, sf_dir):
    rows = QUERIES["op11_cholesky_jacobi_whitening"](spark, sf_dir).toPandas()
    table = spark.read.parquet(f"{sf_dir}/embeddings.parquet").toPandas()
    values, white, deviation, trace = plain_whitening(np.stack(table.embedding))
    found = rows.pivot(index="vec_id", columns="component", values="whitened").loc[table.vec_id].to_numpy()
    sign = np.sign((found * white).sum(axis=0))
    assert found.shape == (len(table), min(32, len(values)))
    np.testing.assert_allclose(found, white * sign, atol=1e-7)
    first = rows[rows.component == 1].set_index("vec_id").loc[table.vec_id]
    assert first.deviation.tolist() == deviation.tolist() and (rows.n == len(table)).all()
    explained = rows.groupby("component").explained.first().to_numpy()
    np.testing.assert_allclose(explained, values / trace, rtol=1e-9)
    assert rows.identity_error.nunique() == 1 and rows.identity_error[0] < 1e-9


def test_awkward_vectors_take_no_part(spark):
    inf, nan = float("inf"), float("nan")
    good = [(i, [float(i % 3), float(i % 5), 1.0]) for i in range(40)]
    bad = [(90, None), (91, [1.0, None, 2.0]), (92, [nan, 1.0, 1.0]), (93, [inf, 0.0, 0.0]), (94, []), (95, [1.0])]
    more = [(None, [0.5, 0.25, 1.0]), (7, [2.0, 1.0, 1.0]), (7, [2.0, 1.0, 1.0])]
    frame = spark.createDataFrame([(*r, "a", "b", "c", "d") for r in good + bad + more], VECTORS)
    rows = whitening.whiten(frame).toPandas()
    # The third entry never varies: two components are left.
    assert set(rows.component) == {1, 2} and len(rows) == 2 * (len(good) + len(more))
    assert rows.vec_id.isna().sum() == 2 and (rows.vec_id == 7).sum() == 6
    assert not rows.vec_id.between(90, 95).any() and rows.identity_error[0] < 1e-9
    _, white, _, _ = plain_whitening([v for _, v in good + more], 2)
    found = rows[rows.component == 1].sort_values("vec_id", kind="stable").whitened.abs().sum()
    assert math.isclose(found, np.abs(white[:, 0]).sum(), rel_tol=1e-9)


def test_vectors_without_variance_give_no_rows(spark):
    def white(rows):
        return whitening.whiten(spark.createDataFrame([(*r, "", "", "", "") for r in rows], VECTORS)).collect()

    assert white([]) == [] and white([(1, None)]) == []
    assert white([(1, [1.0, 2.0])]) == [] and white([(i, [1.0, 2.0]) for i in range(5)]) == []


def test_large_entries_stay_exact():
    x = np.array([[2**40 + 3, 5], [2**40 + 4, -7], [2**61, 11]], np.int64)
    sums = whitening._exact_sums(x)
    assert sums == [sum(map(int, c)) for c in x.T]
    centred = whitening._times_minus(3, x, sums)
    want = [[3 * int(v) - s for v, s in zip(row, sums)] for row in x]
    assert centred.tolist() == want
    assert whitening._deviations(centred).to_pylist() == [
        t if (t := sum(v * v for v in row)) < 2**63 else None for row in want
    ]


@pytest.mark.parametrize("rank,size", [(1, 1), (3, 7), (8, 8), (20, 33)])
def test_factored_scatter(rank, size):
    rng = np.random.default_rng(rank)
    b = rng.normal(size=(size, rank)) * np.logspace(0, -5, rank)
    a = b @ b.T
    factor, order = whitening.pivoted_cholesky(a)
    np.testing.assert_allclose(factor @ factor.T, a[np.ix_(order, order)], atol=1e-12 * np.trace(a))
    rotated = whitening.jacobi_columns(factor)
    values = np.sort((rotated**2).sum(axis=0))[::-1]
    want = np.linalg.svd(b, compute_uv=False) ** 2
    # The product b b' is itself rounded to about this much.
    np.testing.assert_allclose(values[: len(want)], want, rtol=1e-6, atol=1e-15 * want[0])
    inner = rotated.T @ rotated
    assert np.abs(inner - np.diag(inner.diagonal())).max() < 1e-12 * np.trace(a)


# --- multiset fingerprints


def plain_lanes(text):
    lanes = [0] * 72
    for part in re.split(r"[\r\n]+", text or ""):
        if not part:
            continue
        for i in range(8):
            h = spark_hash(i // 2, part)
            lanes[i] = (lanes[i] + (h >> 32 if i % 2 else h & (2**32 - 1))) % 2**32
        words = [w for w in re.split(r"[\x20\x09-\x0d]+", part) if w]
        for i in range(len(words)):
            h = spark_hash(*words[i : i + 3])
            for j in range(64):
                # Lane j counts bit j: four counters of a number lie 16 bits apart.
                lanes[8 + j] = (lanes[8 + j] + (1 if h >> j & 1 else -1)) % 2**16
    return lanes


def spark_hash(*values):
    """Spark's xxhash64: each value's hash is the seed of the next."""
    seed = 42
    for v in values:
        data = v.to_bytes(4, "little") if isinstance(v, int) else v.encode()
        seed = xxhash.xxh64_intdigest(data, seed)
    return seed


def plain_string(lanes):
    return "".join(f"{x:08x}" if i < 8 else f"{x:04x}" for i, x in enumerate(lanes))


def plain_likeness(a, b):
    if a == b:
        return 1.0
    x, y = ([v - 2**16 if v >= 2**15 else v for v in lanes[8:]] for lanes in (a, b))
    size = math.sqrt(sum(v * v for v in x) * sum(v * v for v in y))
    return min(1.0, max(0.0, sum(v * w for v, w in zip(x, y)) / size)) if size else 0.0


def plain_fingerprints(rows):
    rows = sorted(
        rows,
        key=lambda r: (
            r[0] is None, r[0] or 0,
            hashlib.sha256(f"{'-' if r[0] is None else r[0]} {r[1] or ''}".encode()).digest(),
        ),
    )
    out = []
    for i, (doc_id, text) in enumerate(rows):
        text, following = text or "", rows[(i + 1) % len(rows)][1] or ""
        take = len(text) // 4
        edited = text[: len(text) - take] + following[:take]
        own, new, other = plain_lanes(text), plain_lanes(edited), plain_lanes(following)
        out.append(
            (doc_id, len(text), hashlib.sha256(edited.encode()).hexdigest(), plain_string(own), plain_string(new),
             round(plain_likeness(own, new), 9), round(plain_likeness(own, other), 9))
        )
    return Counter(out)


def rounded(frame):
    return Counter((*r[:5], round(r[5], 9), round(r[6], 9)) for r in frame.collect())


def test_fingerprints_match_the_plain_version(spark, sf_dir):
    found = QUERIES["op12_multiset_fingerprints"](spark, sf_dir)
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    assert rounded(found) == plain_fingerprints([tuple(r) for r in docs.collect()])


def test_awkward_documents_have_fingerprints(spark, monkeypatch):
    rows = [
        (1, "one two three\nfour five six seven"), (2, "four five six seven\n\none two three"), (3, None), (4, ""),
        (5, "\n \r\n"), (6, "é ü 𝄞𝄞 x"), (7, "w " * 70_000), (None, "no id"), (None, "no id"), (None, None),
        (8, "same"), (8, "same"), (8, "other"), (9, "x" * 5000),
    ]
    rows += [(11, "copy\nof copies")] * 25
    monkeypatch.setattr(multiset_hash, "COPIES_A_BLOCK", 10)
    monkeypatch.setattr(multiset_hash, "ROWS_A_RANGE", 4)
    frame = spark.createDataFrame([(*r, "a", "b", "c", "d") for r in rows], DOCUMENTS).repartition(3)
    found = multiset_hash.fingerprints(frame)
    assert rounded(found) == plain_fingerprints(rows)
    by_id = {r.doc_id: r for r in found.collect()}
    assert by_id[1].fingerprint == by_id[2].fingerprint and set(by_id[3].fingerprint) == {"0"}
    assert multiset_hash.fingerprints(frame.limit(0)).count() == 0
    one = multiset_hash.fingerprints(frame.filter("doc_id = 1")).collect()
    assert len(one) == 1 and one[0].near_next == 1.0


def test_paragraphs_go_in_and_out(spark):
    rows = [("a b c\nd e", "f g h i\nj"), ("", "x"), ("p", "")]
    frame = spark.createDataFrame(rows, "base string, more string")
    whole = multiset_hash.lanes(F.concat_ws("\n", "more", "base"))
    grown = multiset_hash.inserted(multiset_hash.lanes(F.col("base")), F.col("more"))
    back = multiset_hash.deleted(grown, F.col("more"))
    assert frame.filter(grown != whole).count() == 0
    assert frame.filter(back != multiset_hash.lanes(F.col("base"))).count() == 0


def test_likeness_tells_edited_texts_from_others(spark):
    found = QUERIES["op12_multiset_fingerprints"](spark, "/root/testdata/sf0.01")
    rows = found.filter("n_chars > 200").select("near_edited", "near_next").toPandas()
    assert (rows.near_edited > 0.4).mean() > 0.98 and (rows.near_next < 0.4).mean() > 0.98


# --- lexical search


def plain_search(docs, items, top=10):
    def terms(text):
        text = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
        return re.findall(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", text)

    counts = [Counter(terms(t)) for _, t in docs]
    lengths = [sum(c.values()) for c in counts]
    n, total = sum(x > 0 for x in lengths), sum(lengths)
    df = Counter(t for c in counts for t in c)
    out = []
    for item, text in items:
        asked = Counter(terms(text))
        scored = []
        for (doc_id, _), found, length in zip(docs, counts, lengths):
            m = 100 - 75 + (75 * length * n) // total if total else 25
            score = sum(
                r * math.floor(1000 * math.log((2 * n + 2) / (2 * df[t] + 1)))
                * ((1_000_000_000 * found[t]) // (1000 * found[t] + 8 * m))
                for t, r in asked.items() if t in found
            )
            if score > 0:
                scored.append((-score, doc_id is None, doc_id or 0, doc_id))
        out += [(item, rank, s[3], -s[0]) for rank, s in enumerate(sorted(scored)[:top], 1)]
    return Counter(out)


def test_search_matches_the_plain_version(spark, sf_dir):
    found = QUERIES["op13_max_sketch_search"](spark, sf_dir)
    docs, items = (
        [tuple(r) for r in spark.read.parquet(f"{sf_dir}/{t}.parquet").select(k, "text").collect()]
        for t, k in (("documents", "doc_id"), ("benchmark", "item_id"))
    )
    assert Counter(tuple(r) for r in found.collect()) == plain_search(docs, items)


def test_bounds_are_never_below_scores(monkeypatch, spark):
    """With few coordinates many terms share one; results stay those of the plain version."""
    rng = np.random.default_rng(5)
    docs = [(i, " ".join(f"w{x}" for x in rng.zipf(1.4, rng.integers(0, 60)) % 90)) for i in range(300)]
    docs += [(1000 + i, "W1 w2, w3") for i in range(40)]
    items = [(i, " ".join(f"w{x}" for x in rng.integers(0, 95, 6))) for i in range(20)]
    frame = spark.createDataFrame(docs, "doc_id bigint, text string").repartition(3)
    wanted = spark.createDataFrame(items, "item_id bigint, text string")
    monkeypatch.setattr(lexical_search, "ITEMS", 7)
    for top in (1, 10, 500):
        found = lexical_search.ranked(frame, wanted, top)
        assert Counter(tuple(r) for r in found.collect()) == plain_search(docs, items, top)


def test_sketch_is_the_coordinatewise_maximum():
    counts = [Counter(f"t{i}".encode() for i in range(9000)), Counter(), Counter({b"a": 7})]
    shares = np.array([25, 25, 100])
    sketch = lexical_search._sketches(counts, shares, {})
    want = defaultdict(int)
    for d, found in enumerate(counts):
        for term, tf in found.items():
            at = lexical_search.coordinate(term), d
            want[at] = max(want[at], 10**9 * tf // (1000 * tf + 8 * int(shares[d])))
    assert {(int(j), int(d)): int(sketch[j, d]) for j, d in np.argwhere(sketch)} == want


def test_awkward_tables_are_searched(spark):
    docs = [
        (1, "Alpha beta"), (2, None), (3, ""), (None, "alpha beta"), (None, "alpha beta"), (4, "alpha beta"),
        (4, "alpha beta"), (5, "ÄÖ alpha ÄÖ äö\x7f-\x00beta"), (6, "-- ,,"), (7, "gamma " * 50_000), (8, "delta alpha"),
    ]
    items = [(1, "ALPHA beta beta"), (1, "gamma"), (None, "ÄÖ"), (2, None), (3, ""), (4, "unheard of"), (5, "alpha")]
    extra = ("a", "b", "c", "d")
    frame = spark.createDataFrame(
        [(*r, *extra) for r in docs], "doc_id bigint, text string, score string, item string, rank string, item_id string"
    )
    wanted = spark.createDataFrame([(*r, "s") for r in items], "item_id bigint, text string, doc_id string")
    found = lexical_search.ranked(frame, wanted)
    assert found.columns == ["item_id", "rank", "doc_id", "score"]
    assert Counter(tuple(r) for r in found.collect()) == plain_search(docs, items)
    assert lexical_search.ranked(frame.limit(0), wanted).count() == 0
    assert lexical_search.ranked(frame, wanted.limit(0)).count() == 0
