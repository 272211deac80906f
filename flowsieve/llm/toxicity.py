"""Toxic passages by maximum-scoring segments of token log-odds.

Token weights are log-odds of toxic against clean texts with an informative Dirichlet prior (the
pooled frequencies); words whose weight is not significant share one weight, that of the rest. A
linear scan over a text finds every maximal segment of positive total. Segment scores of clean
texts follow an extreme-value law, fitted on all clean training texts, which turns a score and the
text's length into an expected number of chance passages; a passage is significant if that is
small. The evidence of the significant passages is turned into a probability by logistic
calibration on all training texts.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from flowsieve.llm.common import small_side, stored
from flowsieve.llm.exact_dedup import text_digest
from flowsieve.llm.language_id import text_words
from flowsieve.session import scratch_path

PRIOR = 0.125
DEVIATIONS = 4.0
STRENGTH = 1.0
# Up to so many significant words travel as a dictionary; above, texts meet their words in a join.
LEXICON = 500_000
EXPECTED = 0.05
BIN = 0.25
BINS = 400
PASSAGES = "array<struct<first_word:int,end_word:int,score:double,expected:double>>"


def _word_votes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Per slice of texts: word, number of toxic and of clean texts that hold it; the empty word
    counts the texts, the word of one blank all their distinct words."""
    for batch in batches:
        for at in range(0, batch.num_rows, 2048):
            part = batch.slice(at, 2048)
            votes = [Counter(), Counter()]
            for text, toxic in zip(part.column(0), part.column(1).to_pylist()):
                words = set(text_words(text.as_py()))
                votes[toxic].update(words)
                votes[toxic][""] += 1
                votes[toxic][" "] += len(words)
            words = list(votes[0] | votes[1])
            yield pa.RecordBatch.from_arrays(
                [pa.array(words, pa.string())]
                + [pa.array([votes[i][w] for w in words], pa.int64()) for i in (1, 0)],
                ["word", "toxic", "clean"],
            )


@dataclass
class ToxicityModel:
    """Weights of significant words, the weight of all others, and the two calibrations.

    ``weights`` is None if the words are too many for a dictionary; they are then rows of the stored
    table at ``lexicon``."""

    weights: dict[str, float] | None
    rest: float
    decay: float
    scale: float = 1.0
    slope: float = 1.0
    offset: float = 0.0
    lexicon: str | None = None

    def expected(self, score: float, words: int) -> float:
        """Expected number of segments of a clean text of that length with at least that score."""
        return self.scale * max(words, 1) * math.exp(-self.decay * score)

    def probability(self, evidence: np.ndarray) -> np.ndarray:
        return 1.0 / (1.0 + np.exp(-np.clip(self.slope * evidence + self.offset, -50, 50)))


def maximal_segments(
    words: list[str], model: ToxicityModel, own: dict[str, float] | None = None
) -> list[tuple[int, int, float]]:
    """All maximal segments (first, end, score) of positive total, in text order, in linear time.

    The scan keeps candidate segments with the running total before and after each. A new positive
    word joins to its left as long as an earlier candidate starts lower and ends no higher; words
    without a weight of their own only move the total. ``own`` has the text's weights where the
    model has no dictionary.
    """
    weights, rest = model.weights if own is None else own, model.rest
    held: list[list] = []  # first, end, total before, total after, nearest candidate starting lower
    total, last = 0.0, -1
    for i, word in enumerate(words):
        weight = weights.get(word)
        if weight is None:
            continue
        total += rest * (i - last - 1)
        last = i
        if weight <= 0:
            total += weight
            continue
        segment = [i, i + 1, total, total + weight, -1]
        total += weight
        at = len(held) - 1
        while True:
            while at >= 0 and held[at][2] >= segment[2]:
                at = held[at][4]
            if at < 0 or held[at][3] >= segment[3]:
                segment[4] = at
                held.append(segment)
                break
            segment[0], segment[2] = held[at][0], held[at][2]
            del held[at:]
            at = len(held) - 1
    return [(first, end, after - before) for first, end, before, after, _ in held]


def passages(
    words: list[str], model: ToxicityModel, own: dict[str, float] | None = None
) -> tuple[list[dict], float, float]:
    """Significant passages, their summed evidence, and the highest segment score.

    A passage's evidence is the log of how much rarer it is than the significance limit."""
    found, evidence, highest = [], 0.0, 0.0
    for first, end, score in maximal_segments(words, model, own):
        highest = max(highest, score)
        expected = model.expected(score, len(words))
        if expected <= EXPECTED:
            found.append(
                {"first_word": first, "end_word": end, "score": score, "expected": expected}
            )
            evidence += math.log(EXPECTED / max(expected, 1e-300))
    return found, evidence, highest


def _scan(shared, emit):
    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        for batch in batches:
            for at in range(0, batch.num_rows, 1024):
                part = batch.slice(at, 1024)
                rows = []
                own = part.column(1) if model.weights is None else None
                for i, text in enumerate(part.column(0)):
                    words = text_words(text.as_py())
                    mine = None if own is None else {e["word"]: e["weight"] for e in own[i].as_py() or ()}
                    rows.append((len(words), *passages(words, model, mine)))
                if own is not None:
                    part = part.select([0, *range(2, part.num_columns)])
                yield pa.RecordBatch.from_arrays(*emit(model, part, rows))

    return scan


def _distinct_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for at in range(0, batch.num_rows, 256):
            part = batch.slice(at, 256)
            keys, words = [], []
            for key, text in zip(part.column(0).to_pylist(), part.column(1)):
                found = set(text_words(text.as_py()))
                keys.extend([key] * len(found))
                words.extend(found)
            yield pa.RecordBatch.from_arrays(
                [pa.array(keys, pa.binary()), pa.array(words, pa.string())], ["_key", "word"]
            )


def with_weights(rows: DataFrame, model: ToxicityModel) -> DataFrame:
    """``rows``, whose first column is a text; if the model has no dictionary, the second column then
    lists the significant words of the text with their weights.

    Each distinct text meets the stored words by its own distinct words; only digests and words
    travel until the lists go back to the texts."""
    if model.weights is not None:
        return rows
    body, *others = [f"`{c}`" for c in rows.columns]
    key = F.unhex(F.sha2(F.coalesce(F.col(body), F.lit("")).cast("binary"), 256))
    words = rows.select(key.alias("_key"), body).mapInArrow(_distinct_words, "_key binary, word string")
    lexicon = rows.sparkSession.read.parquet(model.lexicon)
    lists = (
        words.distinct().join(lexicon, "word")
        .groupBy("_key")
        .agg(F.collect_list(F.struct("word", "weight")).alias("_own"))
    )
    return rows.withColumn("_key", key).join(lists, "_key", "left").select(body, "_own", *others)


def _emit_scores(model, part, rows):
    score = model.probability(np.array([r[2] for r in rows], np.float64))
    kind = pa.list_(
        pa.struct([("first_word", pa.int32()), ("end_word", pa.int32()), ("score", pa.float64()), ("expected", pa.float64())])
    )
    return (
        [*part.columns[1:], pa.array(score), pa.array([r[1] for r in rows], kind)],
        [*part.schema.names[1:], "score", "passages"],
    )


def _emit_highest(model, part, rows):
    """Chance of each clean text's highest segment under decay alone, for fitting the scale."""
    terms = [n * math.exp(-model.decay * highest) for n, _, _, highest in rows if n]
    return [pa.array([float(sum(terms))]), pa.array([len(terms)], pa.int64())], ["term", "n"]


def _emit_evidence(model, part, rows):
    bins = np.minimum((np.array([r[2] for r in rows]) / BIN).astype(np.int64), BINS)
    return [pa.array(bins), part.column(1)], ["bin", "toxic"]


def training_rows(docs: DataFrame, labels: DataFrame, text: str = "text") -> DataFrame:
    """text and toxic (0 or 1) of labelled documents, one row per distinct text and label.

    Copies of a text would otherwise vote once each. Labels other than 0 and 1 are left out, of
    several labels of one document each counts. Only ids and digests meet before the texts do.
    """
    known = labels.filter(F.col("toxic").isin(0, 1)).select(
        "doc_id", F.col("toxic").cast("int").alias("toxic")
    )
    digests = docs.select("doc_id", text_digest(F.col(text)).alias("_digest"))
    chosen = (
        digests.join(known, "doc_id")
        .groupBy("_digest", "toxic")
        .agg(F.min("doc_id").alias("doc_id"))
        .select("doc_id", "toxic")
    )
    side = small_side(stored(chosen, "labelled"))
    return docs.select("doc_id", F.col(text).alias("text")).join(side, "doc_id").select("text", "toxic")


def significant_words(
    rows: DataFrame,
    prior: float = PRIOR,
    deviations: float = DEVIATIONS,
    strength: float = STRENGTH,
    lexicon: int = LEXICON,
) -> ToxicityModel | None:
    """Log-odds weights with Dirichlet priors from (text, toxic) rows; None without both labels.

    A word votes once per text. Its prior is ``prior`` times its votes of both labels. Words whose
    log-odds are at least ``strength``, and ``deviations`` standard deviations from zero, keep their
    weight, as a dictionary up to ``lexicon`` words and as a stored table above; all others share the
    log-odds of what is left.
    Without the strength, words of a language with more toxic texts would add up over any text.
    """
    votes = stored(
        rows.mapInArrow(_word_votes, "word string, toxic bigint, clean bigint")
        .groupBy("word")
        .agg(F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean")),
        "word-votes",
    )
    totals = {r["word"]: (r["toxic"], r["clean"]) for r in votes.filter("word IN ('', ' ')").collect()}
    texts, mass = totals.get("", (0, 0)), totals.get(" ", (0, 0))
    if not texts[0] or not texts[1]:
        return None
    pooled = (F.col("toxic") + F.col("clean")) * F.lit(prior)
    whole = prior * sum(mass)
    odds = lambda n, of: F.log((F.col(n) + pooled) / (F.lit(of + whole) - F.col(n) - pooled + 1))
    delta = odds("toxic", mass[0]) - odds("clean", mass[1])
    spread = F.sqrt(1 / (F.col("toxic") + pooled) + 1 / (F.col("clean") + pooled))
    strong = scratch_path(rows.sparkSession, "lexicon")
    (
        votes.filter("word NOT IN ('', ' ')")
        .withColumn("weight", delta)
        .filter((F.abs(F.col("weight") / spread) >= deviations) & (F.abs("weight") >= strength))
        .write.parquet(strong)
    )
    known = rows.sparkSession.read.parquet(strong)
    # A weight follows from its votes, and words with the same votes are one row here.
    kinds = known.groupBy("toxic", "clean").agg(F.min("weight").alias("weight"), F.count(F.lit(1)).alias("n"))
    kinds = kinds.orderBy("toxic", "clean").toPandas()
    n = kinds["n"].to_numpy(np.int64)
    left = [mass[i] - int((kinds[name].to_numpy(np.int64) * n).sum()) for i, name in enumerate(("toxic", "clean"))]
    rest = math.log((max(left[0], 1) / max(mass[0], 1)) / (max(left[1], 1) / max(mass[1], 1)))
    model = ToxicityModel(None, min(rest, -0.01), 1.0, lexicon=strong)
    if n.sum() <= lexicon:
        model.weights = {r["word"]: r["weight"] for r in known.select("word", "weight").collect()}
    # How often clean texts show each weight; words never seen clean count half a text.
    clean = np.maximum(kinds["clean"].to_numpy(np.float64), 0.5) * n
    seen = np.append(clean, max(left[1], 1)) / max(mass[1], 1)
    values = np.append(kinds["weight"].to_numpy(np.float64), model.rest)
    model.decay = extreme_value_decay(values, seen / seen.sum())
    return model


def extreme_value_decay(values: np.ndarray, shares: np.ndarray) -> float:
    """The positive root x of sum(share * exp(x * value)) = 1; 1 where the mean is not negative."""
    if (values * shares).sum() >= 0 or values.max() <= 0:
        return 1.0
    low, high = 1e-6, 1.0
    gain = lambda x: float((shares * np.exp(np.clip(x * values, -700, 700))).sum()) - 1.0
    while gain(high) < 0 and high < 64:
        high *= 2
    for _ in range(80):
        middle = (low + high) / 2
        low, high = (middle, high) if gain(middle) < 0 else (low, middle)
    return high


def logistic_fit(x: np.ndarray, positive: np.ndarray, negative: np.ndarray) -> tuple[float, float]:
    """Slope and offset of a logistic curve through counted bins, by damped Newton steps with a
    weak pull of the slope to 0; the slope is kept from being negative."""
    slope, offset = 0.0, math.log((positive.sum() + 0.5) / (negative.sum() + 0.5))
    n = positive + negative
    for _ in range(100):
        p = 1.0 / (1.0 + np.exp(-np.clip(slope * x + offset, -50, 50)))
        g = np.array([((positive - n * p) * x).sum() - 0.01 * slope, (positive - n * p).sum()])
        w = n * p * (1 - p)
        h = np.array([[(w * x * x).sum() + 0.01, (w * x).sum()], [(w * x).sum(), w.sum() + 1e-9]])
        step = np.clip(np.linalg.solve(h, g), -2, 2)
        slope, offset = max(slope + step[0], 0.0), offset + step[1]
        if np.abs(step).max() < 1e-9:
            break
    return slope, offset


def fit(docs: DataFrame, labels: DataFrame, text: str = "text", **options) -> ToxicityModel | None:
    """The whole model from all labelled documents; None without labels of both kinds."""
    rows = stored(training_rows(docs, labels, text), "toxicity-rows")
    model = significant_words(rows, **options)
    if model is None:
        return None
    context = docs.sparkSession.sparkContext
    clean = rows.filter("toxic = 0").select("text")
    term, n = (
        with_weights(clean, model)
        .mapInArrow(_scan(context.broadcast(model), _emit_highest), "term double, n bigint")
        .agg(F.sum("term"), F.sum("n"))
        .first()
    )
    # Maximum likelihood of the scale of P(highest < s) = exp(-scale * words * exp(-decay * s)).
    model.scale = n / term if term else 1.0
    counts = (
        with_weights(rows.select("text", "toxic"), model)
        .mapInArrow(_scan(context.broadcast(model), _emit_evidence), "bin bigint, toxic int")
        .groupBy("bin")
        .agg(F.sum("toxic").alias("toxic"), F.count(F.lit(1)).alias("n"))
        .toPandas()
    )
    x = counts["bin"].to_numpy(np.float64) * BIN
    positive = counts["toxic"].to_numpy(np.float64)
    model.slope, model.offset = logistic_fit(x, positive, counts["n"].to_numpy(np.float64) - positive)
    return model


def score(docs: DataFrame, model: ToxicityModel | None, text: str = "text") -> DataFrame:
    """All columns of ``docs`` with score (0 to 1), predicted (score >= 0.5) and passages.

    ``passages`` lists every significant passage by word positions. Every whole text is scanned;
    null and empty texts have no evidence and get the score of none. Without a model all scores are
    0. Input columns with an output's name are replaced.
    """
    outputs = ["score", "predicted", "passages"]
    kept = [c for c in docs.columns if c.lower() not in outputs]
    own = [F.col(f"`{c}`") for c in kept]
    if model is None:
        return docs.select(
            *own, F.lit(0.0).alias("score"), F.lit(0).alias("predicted"),
            F.array().cast(PASSAGES).alias("passages"),
        )
    kinds = ", ".join(f"`{c}` {docs.schema[c].dataType.simpleString()}" for c in kept)
    shared = docs.sparkSession.sparkContext.broadcast(model)
    bodies = docs.select(F.col(f"`{text}`").alias("_body"), *own)
    scored = with_weights(bodies, model).mapInArrow(
        _scan(shared, _emit_scores), f"{kinds}, score double, passages {PASSAGES}"
    )
    return scored.withColumn("predicted", (F.col("score") >= 0.5).cast("int"))
