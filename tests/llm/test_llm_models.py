"""Nearest neighbours, page text, language identification, toxicity and the pipeline."""

import math
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from flowsieve.llm import language_id, multi_index, page_text, toxicity
from flowsieve.llm.common import held_out
from flowsieve.llm.registry import QUERIES

VECTORS = "vec_id bigint, embedding array<float>, score string, rank string, id string"


def nearest_by_all_pairs(rows, top):
    out = {}
    for q, x in rows:
        scores = sorted((-sum(a * b for a, b in zip(x, y)), i) for i, y in rows if i != q)
        out[q] = [(i, -s) for s, i in scores[:top]]
    return out


def test_recall_against_all_pairs(spark, sf_dir):
    folder = sf_dir.replace("0.001", "0.01")
    found = QUERIES["op1_inverted_multi_index"](spark, folder).toPandas()
    vectors = spark.read.parquet(f"{folder}/embeddings.parquet").toPandas()
    x = np.array(vectors.embedding.tolist(), np.float64)
    ids = vectors.vec_id.to_numpy()
    hits = 0
    for i in np.flatnonzero(ids % 20 == 0):
        scores = x @ x[i]
        scores[i] = -np.inf
        best = ids[np.lexsort((ids, -scores))[:20]]
        mine = found[found.query_id == ids[i]].sort_values("rank")
        assert list(mine["rank"]) == list(range(1, 21)) and mine.score.is_monotonic_decreasing
        assert np.allclose(mine.score, [x[i] @ x[ids == j][0] for j in mine.vec_id], atol=1e-12)
        hits += len(set(best) & set(mine.vec_id))
    assert hits / len(found) >= 0.9


def test_few_and_unusable_vectors(spark):
    nan = float("nan")
    rows = [
        (20, [1.0, 0.0]), (40, [0.5, 0.5]), (1, [1.0, 0.0]), (2, [1.0, 0.0]), (3, [-1.0, 0.0]),
        (4, None), (60, [0.0, 0.0]), (80, [nan, 1.0]), (5, [None, 1.0]), (None, [1.0, 1.0]), (6, [1.0]),
        (100, [float("inf"), 0.0]), (20, [1.0, 0.0]),
    ]
    frame = spark.createDataFrame([(*r, "x", "x", "x") for r in rows], VECTORS)
    found = multi_index.nearest_neighbours(frame, F.col("id") % 20 == 0, top=3)
    got = {}
    for r in found.orderBy("query_id", "rank").collect():
        got.setdefault(r.query_id, []).append((r.vec_id, r.score))
    assert got == {20: [(1, 1.0), (2, 1.0), (40, 0.5)], 40: [(1, 0.5), (2, 0.5), (20, 0.5)]}
    none = spark.createDataFrame([], VECTORS)
    assert multi_index.nearest_neighbours(none, F.col("id") % 20 == 0).count() == 0
    # A key with several vectors is one item, with the smallest of them, as query and as candidate.
    several = [(20, [2.0, 0.0]), (20, [1.0, 0.0]), (7, [0.0, 9.0]), (7, [3.0, 1.0]), (8, [1.0, 1.0])]
    frame = spark.createDataFrame([(*r, "x", "x", "x") for r in several], VECTORS)
    found = multi_index.nearest_neighbours(frame, F.col("id") % 20 == 0, top=3).orderBy("rank")
    assert [(r.query_id, r.vec_id, r.score) for r in found.collect()] == [(20, 8, 1.0), (20, 7, 0.0)]


def test_equal_vectors_do_not_crowd_out_others(spark):
    rng = np.random.default_rng(2)
    rows = [(i, [1.0, 0.0, 0.0, 0.0]) for i in range(1, 900)]
    rows += [(i, (v / np.linalg.norm(v)).tolist()) for i, v in enumerate(rng.normal(size=(300, 4)), 1000)]
    frame = spark.createDataFrame([(*r, "x", "x", "x") for r in rows], VECTORS)
    found = multi_index.nearest_neighbours(frame, F.col("id") % 100 == 0, top=5, missed=0.01)
    exact = [(i, [float(np.float32(a)) for a in v]) for i, v in rows]
    want = nearest_by_all_pairs(exact, 5)
    got = {}
    for r in found.orderBy("query_id", "rank").collect():
        got.setdefault(r.query_id, []).append(r.vec_id)
    assert got[100] == [1, 2, 3, 4, 5] and set(got) == {i for i, _ in rows if i % 100 == 0}
    hits = sum(len(set(got[q]) & {i for i, _ in want[q]}) for q in got)
    assert hits >= 0.9 * 5 * len(got)


PAGE = """<!doctype html><html><head><title>T</title><style>p{{}}</style><script>var a="</p>";</script></head>
<body><header><p>Site name</p></header><nav><ul><li><a href="/a">Home</a><li><a href='/b'>More</a></ul></nav>
<!-- <p>hidden</p> --><div class="ad banner">Buy &amp; save</div><main><article><h1>Head&nbsp;line {0}</h1>
<p>One <b>two</b>three<br>four &lt;five&gt;<p>Second   para
 graph.</p><aside>See also</aside><div class="comments"><p>I disagree {0}</p></div>
<form><input name=q><button>Go</button></form></article></main><footer>&copy; X</footer></body></html>"""
TEXT = "Head line {0}\nOne twothree four <five>\nSecond para graph."


def test_blocks_and_rule_labels():
    blocks = page_text.page_blocks(PAGE.format(1))
    kept = [b.text for b, label in zip(blocks, page_text.rule_labels(blocks)) if label]
    assert "\n".join(kept) == TEXT.format(1)
    assert page_text.page_blocks(None) == [] and page_text.page_blocks("<p>") == []
    assert [b.text for b in page_text.page_blocks("a<div>b</span>c<")] == ["a", "bc<"]


def test_regions_behind_long_class_lists_are_read():
    utilities = "md:flex-row lg:flex-col px-four py-two mx-auto"
    page = (
        f'<main><p>Kept</p><div class="{utilities}" id="comments"><p>One</p></div>'
        f'<div class="{utilities} sidebar"><p>Two</p></div><div class="{utilities}" role="navigation"><p>Three</p></div></main>'
    )
    blocks = page_text.page_blocks(page)
    assert page_text.rule_labels(blocks) == [1, 0, 0, 0]
    assert "comments" in blocks[1].path[1].split()


def test_gradients_are_those_of_the_loss():
    rng = np.random.default_rng(0)
    model = page_text.Labeller()
    model.weights = {k: v.astype(np.float64) for k, v in model.weights.items()}
    pages = [rng.normal(size=(n, page_text.WIDTH)) for n in (2, 4)]
    labels = [rng.integers(0, 2, n).astype(float) for n in (2, 4)]

    def loss():
        found = model.probabilities(pages)
        return -sum((y * np.log(p) + (1 - y) * np.log(1 - p)).sum() for p, y in zip(found, labels)) / 6

    gradient = model.gradients(pages, labels)
    for name, weights in model.weights.items():
        flat = weights.ravel()
        for i in rng.integers(len(flat), size=4):
            old = flat[i]
            flat[i] = old + 1e-3
            high = loss()
            flat[i] = old - 1e-3
            low = loss()
            flat[i] = old
            assert math.isclose((high - low) / 2e-3, gradient[name].ravel()[i], rel_tol=1e-2, abs_tol=1e-6)


def test_page_text_of_labelled_and_odd_pages(spark):
    rows = [(i, PAGE.format(i), "x", "x") for i in range(80)]
    rows += [(None, None, "x", "x"), (900, "", "x", "x"), (901, "<p>" * 3000, "x", "x"), (902, "<p>a " * 5000, "x", "x")]
    pages = spark.createDataFrame(rows, "page_id bigint, html string, text string, n_chars string")
    found = page_text.extract(pages, page_text.fit(pages))
    assert sorted(found.columns) == ["n_blocks", "n_chars", "page_id", "text"]
    got = {r.page_id: r for r in found.collect()}
    assert all(got[i].text == TEXT.format(i) and got[i].n_chars == len(got[i].text) for i in range(80))
    assert got[None].text == got[900].text == got[901].text == "" and got[902].n_blocks == 5000
    none = pages.limit(0)
    assert page_text.extract(none, page_text.fit(none)).count() == 0


def test_page_text_of_the_pages_table(spark, sf_dir):
    folder = sf_dir.replace("0.001", "0.01")
    pages = {r.page_id: r.html for r in spark.read.parquet(f"{folder}/pages.parquet").collect()}
    right = 0
    for r in QUERIES["op7_recurrent_page_text"](spark, folder).collect():
        blocks = page_text.page_blocks(pages[r.page_id])
        want = [b.text for b, label in zip(blocks, page_text.rule_labels(blocks)) if label]
        right += r.text == "\n".join(want)
    assert right >= 0.99 * len(pages)


DOCUMENTS = "doc_id bigint, text string, lang string, score string, lang_pred string, rejected string, predicted string"
LATIN = {
    "en": "the and that with this from have which there their would about other could",
    "de": "der und die nicht mit auch sich auf eine werden durch wurde noch zwischen",
}


def bilingual(spark, extra=()):
    rng = np.random.default_rng(4)
    rows = []
    for i in range(400):
        lang = ("en", "de")[i % 2]
        words = rng.choice(LATIN[lang].split(), 30)
        rows.append((i, " ".join(words), lang, "x", "x", "x", "x"))
    return spark.createDataFrame(rows + list(extra), DOCUMENTS)


def plain_kneser_ney(words):
    """p(char | three before) by nested dictionaries, for one language."""
    counts = Counter()
    for w in words:
        line = "\0\0 " + w + " "
        for i in range(3, len(line)):
            counts[line[i - 3 : i + 1]] += 1
    tables = {4: counts}
    for n in (3, 2, 1):
        tables[n] = Counter(g[1:] for g in tables[n + 1])

    def p(gram):
        if not gram:
            return 1 / language_id.SYMBOLS
        table = tables[len(gram)]
        once, twice = (sum(v == k for v in table.values()) for k in (1, 2))
        d = min(max(once / (once + 2 * twice) if once + 2 * twice else 0.5, 0.05), 0.95)
        context = {g: n for g, n in table.items() if g[:-1] == gram[:-1]}
        total = sum(context.values())
        if not total:
            return p(gram[1:])
        return max(table[gram] - d, 0) / total + d * len(context) / total * p(gram[1:])

    return p


def test_models_equal_plain_kneser_ney(spark):
    docs = bilingual(spark)
    counts = language_id.gram_counts(docs)
    languages = ["de", "en"]
    tables = language_id.model_tables(counts, languages)
    model = language_id.CharacterModels.gathered(tables, languages)
    for place, lang in enumerate(model.languages):
        words = [w for r in docs.filter(F.col("lang") == lang).collect() for w in r.text.split()]
        p = plain_kneser_ney(words)
        for word in ("the", "nicht", "zzé", "a"):
            line = "\0\0 " + word + " "
            bits = -sum(math.log2(p(line[i - 3 : i + 1])) for i in range(3, len(line)))
            got, coded = model.word_bits([word])
            assert coded[0] == len(word) + 1 and math.isclose(got[0, place], bits, rel_tol=1e-4)


def test_language_of_odd_texts(spark):
    odd = [
        (900, None, "en", "x", "x", "x", "x"), (901, "", "en", "x", "x", "x", "x"), (902, "12 !?", None, "x", "x", "x", "x"),
        (None, "die nicht", None, "x", "x", "x", "x"), (903, "the " * 50_000, None, "x", "x", "x", "x"),
        (904, "xqzjvkqw " * 80, None, "x", "x", "x", "x"), (903, "日本語", None, "x", "x", "x", "x"),
    ]
    docs = bilingual(spark, odd)
    found = language_id.identify(docs, language_id.fit(docs))
    assert found.columns.count("score") == 1
    rows = found.collect()
    got = {(r.doc_id, (r.text or "")[:9]): r for r in rows}
    assert len(rows) == 407
    assert sum(r.lang == r.lang_pred and not r.rejected for r in rows if r.doc_id is not None and r.doc_id < 400) == 400
    assert all(got[i, t].lang_pred == "und" and got[i, t].rejected for i, t in ((900, ""), (901, ""), (902, "12 !?")))
    assert got[None, "die nicht"].lang_pred == "de" and got[903, "the the t"].lang_pred == "en"
    assert got[904, "xqzjvkqw "].rejected and got[903, "日本語"].lang_pred in ("de", "en")
    assert all(0 <= r.score <= 1 for r in rows)
    none = docs.limit(0)
    assert language_id.fit(none) is None and language_id.identify(none, None).count() == 0


@pytest.mark.parametrize("frequent", [3, 50_000])
def test_joins_give_what_the_sent_tables_give(spark, monkeypatch, frequent):
    odd = [(900, None, None, *"xxxx"), (None, "zq", None, *"xxxx"), (901, "𝄞𝄞 日本 der", None, *"xxxx"), (901, "12", None, *"xxxx")]
    docs = bilingual(spark, odd)
    columns = ["doc_id", "lang_pred", "score", "cross_entropy", "rejected"]
    sent = language_id.identify(docs, language_id.fit(docs)).select(columns).collect()
    monkeypatch.setattr(language_id, "MOST_VALUES", 10)
    monkeypatch.setattr(language_id, "FREQUENT_WORDS", frequent)
    models = language_id.fit(docs)
    assert models.stored is not None and not models.tables
    joined = language_id.identify(docs, models).select(columns).collect()
    order = lambda r: (r.doc_id is None, r.doc_id or 0, r.cross_entropy or 0)
    for a, b in zip(sorted(sent, key=order), sorted(joined, key=order), strict=True):
        assert (a.doc_id, a.lang_pred, a.rejected) == (b.doc_id, b.lang_pred, b.rejected)
        assert a.score == pytest.approx(b.score, rel=1e-5)
        assert (a.cross_entropy is None) == (b.cross_entropy is None)
        assert (a.cross_entropy or 0) == pytest.approx(b.cross_entropy or 0, rel=1e-5)


def test_many_ngrams_and_languages_keep_their_own_values(spark):
    """No two n-grams share a value, however many there are: entropies equal the plain model's, and
    a hundred languages take the bytes of what they hold."""
    rng = np.random.default_rng(9)
    rows = []
    for i in range(100):
        letters = [chr(0x4E00 + int(c)) for c in rng.integers(0, 20_000, 60)]
        for j in range(12):
            rows.append((i * 12 + j, " ".join("".join(rng.choice(letters, 5)) for _ in range(30)), f"l{i:02d}", *"xxxx"))
    docs = spark.createDataFrame(rows, DOCUMENTS)
    models = language_id.fit(docs)
    assert len(models.languages) == 100
    values = sum(len(t.value) for t in models.tables.values())
    assert sum(a.nbytes for t in models.tables.values() for a in (t.keys, t.starts, t.lang, t.value)) <= 22 * values + 64
    found = language_id.identify(docs, models).filter("lang = lang_pred and not rejected").count()
    assert found >= 0.99 * len(rows)
    for lang in ("l07", "l93"):
        words = [w for r in rows if r[2] == lang for w in r[1].split()]
        p = plain_kneser_ney(words)
        for word in (words[0], rows[0][1].split()[0]):
            line = "\0\0 " + word + " "
            bits = -sum(math.log2(p(line[i - 3 : i + 1])) for i in range(3, len(line)))
            got, _ = models.word_bits([word])
            assert math.isclose(got[0, models.languages.index(lang)], bits, rel_tol=1e-4)


def test_held_out_language_accuracy(spark, sf_dir):
    found = QUERIES["op9_kneser_ney_language"](spark, sf_dir)
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "lang")
    held = found.join(docs, "doc_id").filter("held_out").collect()
    assert len(held) > 20 and sum(r.lang == r.lang_pred for r in held) / len(held) > 0.97


def plain_maximal_segments(scores):
    """All maximal segments by their recursive definition: the highest (leftmost, shortest) segment
    and those of what is left and right of it."""
    best = None
    for i in range(len(scores)):
        total = 0.0
        for j in range(i, len(scores)):
            total += scores[j]
            if total > 1e-12 and (best is None or total > best[2] + 1e-9):
                best = (i, j + 1, total)
    if best is None:
        return []
    left = plain_maximal_segments(scores[: best[0]])
    right = plain_maximal_segments(scores[best[1] :])
    return left + [best] + [(i + best[1], j + best[1], s) for i, j, s in right]


def test_segments_are_the_maximal_ones():
    rng = np.random.default_rng(8)
    for _ in range(60):
        weights = {f"w{i}": float(w) for i, w in enumerate(rng.choice([-3.1, 1.3, 2.7, 5.9, -0.7], 8))}
        model = toxicity.ToxicityModel(weights, -0.53, 1.0)
        words = [f"w{i}" if i < 8 else "other" for i in rng.integers(0, 12, 25)]
        want = plain_maximal_segments([weights.get(w, -0.53) for w in words])
        got = toxicity.maximal_segments(words, model)
        assert [g[:2] for g in got] == [w[:2] for w in want]
        assert np.allclose([g[2] for g in got], [w[2] for w in want])


def test_toxicity_is_learnt_and_located(spark):
    rng = np.random.default_rng(6)
    rows, labels = [], []
    for i in range(600):
        words = list(rng.choice([f"v{chr(97 + k)}" for k in range(26)], 40))
        if i % 6 == 0:
            words[10:12] = rng.choice(["grr", "bah", "ugh"], 2)
        rows.append((i, " ".join(words) + f" u{i}", "en", "x", "x", "x", "x"))
        labels.append((i, int(i % 6 == 0)))
    rows += [(700, None, "en", "x", "x", "x", "x"), (701, "", "en", "x", "x", "x", "x"), (None, "bah grr", "en", "x", "x", "x", "x"), (702, "va " * 60_000 + "bah ugh grr", "en", "x", "x", "x", "x")]
    labels += [(700, None), (None, 1), (701, 0), (0, 1)]
    docs = spark.createDataFrame(rows, DOCUMENTS)
    known = spark.createDataFrame(labels, "doc_id bigint, toxic int")
    model = toxicity.fit(docs, known)
    assert {"grr", "bah", "ugh"} == {w for w, v in model.weights.items() if v > 0}
    found = toxicity.score(docs, model)
    got = {r.doc_id: r for r in found.collect()}
    assert len(got) == 604 and found.columns.count("score") == 1
    assert all(got[i].predicted == int(i % 6 == 0) for i in range(600))
    assert all(0 <= r.score <= 1 for r in got.values())
    assert got[700].predicted == got[701].predicted == 0 and got[None].predicted == 1
    assert [(p.first_word, p.end_word) for p in got[0].passages] == [(10, 12)]
    assert [p.first_word for p in got[702].passages] == [60_000]
    none = known.limit(0)
    assert toxicity.fit(docs, none) is None and {r.score for r in toxicity.score(docs, None).collect()} == {0.0}


def test_all_significant_words_count_however_many(spark):
    letters = [f"{chr(97 + i // 26)}{chr(97 + i % 26)}" for i in range(120)]
    rows, labels = [], []
    for i in range(1200):
        word = letters[i % 120]
        rows.append((i, f"va vb vc {word}{'bad' if i % 3 == 0 else 'fine'} vd ve {i}", "en", "x", "x", "x", "x"))
        labels.append((i, int(i % 3 == 0)))
    rows.append((1200, None, "en", "x", "x", "x", "x"))
    docs = spark.createDataFrame(rows, DOCUMENTS)
    known = spark.createDataFrame(labels, "doc_id bigint, toxic int")
    options = {"deviations": 1.0}
    whole, joined = (toxicity.fit(docs, known, lexicon=n, **options) for n in (500, 3))
    assert len(whole.weights) > 100 and joined.weights is None
    assert (joined.rest, joined.decay, joined.scale, joined.slope) == pytest.approx(
        (whole.rest, whole.decay, whole.scale, whole.slope)
    )
    want, got = ({r.doc_id: r for r in toxicity.score(docs, m).collect()} for m in (whole, joined))
    assert len(got) == 1201 and all(got[i].passages == want[i].passages for i in want)
    assert all(got[i].score == pytest.approx(want[i].score) for i in want)
    assert spark.read.parquet(joined.lexicon).count() == len(whole.weights)


def test_held_out_toxicity(spark, sf_dir):
    folder = sf_dir.replace("0.001", "0.1")
    labels = spark.read.parquet(f"{folder}/labels.parquet").select("doc_id", "toxic")
    held = QUERIES["op10_segment_toxicity"](spark, folder).join(labels, "doc_id").filter("held_out").collect()
    tp = sum(r.predicted and r.toxic for r in held)
    assert tp / sum(r.toxic for r in held) > 0.7 and tp / max(sum(r.predicted for r in held), 1) > 0.95


def test_pipeline_stages_keep_documents_columns(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    before = {r.doc_id: r for r in docs.collect()}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        path = f"{spark.conf.get('spark.checkpoint.dir')}/pipeline-{name}"
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
        assert docs.columns == corpus_pipeline.COLUMNS
        rows = docs.collect()
        if name != "mixing":
            assert all(r.text == before[r.doc_id].text for r in rows) and len({r.doc_id for r in rows}) == len(rows)
        if name == "language_id":
            assert len(rows) >= 0.99 * len(before)
    packed = corpus_pipeline.STAGES[-1][1](spark, docs, sf_dir).toPandas()
    again = corpus_pipeline.run(spark, sf_dir).toPandas()
    key = ["doc_id", "piece", "start", "length", "ids_crc32"]
    assert sorted(map(tuple, packed[key].values)) == sorted(map(tuple, again[key].values))
    assert packed.groupby("sequence_id").length.sum().max() <= 2048


def test_pipeline_of_nothing_and_of_awkward_rows(spark, tmp_path):
    rows = [
        (1, "a b c d e f g", "en", "s", 13), (1, "a b c d e f g", "en", "s", 13), (2, None, None, None, None),
        (3, "", "en", None, 0), (None, "one two three four", None, None, 18), (4, "a  b c d e f g", "en", "t", 14),
    ]
    schema = "doc_id bigint, text string, lang string, source string, n_chars bigint"
    for name, some in (("none", []), ("odd", rows)):
        spark.createDataFrame(some, schema).write.parquet(str(tmp_path / name / "documents.parquet"))
        assert corpus_pipeline.run(spark, str(tmp_path / name)).count() >= 0


def test_held_out_is_never_null(spark):
    rows = spark.createDataFrame([(None,), (1,), (2,)], "doc_id bigint").select(held_out(F.col("doc_id")).alias("h"))
    assert None not in {r.h for r in rows.collect()}
