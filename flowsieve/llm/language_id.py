"""Language identification by interpolated Kneser-Ney character models.

Each language has a model of order 4 over the letters of words, lower-cased, with a word start and
a word end. Every training text is counted: tasks count distinct words, then the words' n-grams.
Discounts, continuation counts and back-off weights are Spark aggregations over the n-gram table.
The finished tables hold every n-gram under its own 64-bit key, so they grow with the corpus. Up to
``MOST_VALUES`` values they are sent to the tasks as sorted arrays; above, the n-grams of the distinct
words of the texts meet them in joins, with the same result. A text gets the language of the lowest
cross-entropy per character; rejection is calibrated on texts that a second count leaves out.
"""

from __future__ import annotations

import functools
import math
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from flowsieve.llm.common import release_memory, small_batches, stored

ORDER = 4
# Values of 14 bytes or less, keys of 12: some 150 MB in the driver and in a task at most.
MOST_VALUES = 6_000_000
CALIBRATION = 2000
LEFT_OUT = 10
REJECT_DEVIATIONS = 6.0
UNKNOWN = "und"
SYMBOLS = 65536.0
KNOWN_WORDS = 150_000
SLICE = 256
FREQUENT_WORDS = 50_000
LETTERS = re.compile(r"[^\W\d_]+")


def text_words(text: str | None) -> list[str]:
    """Runs of letters, lower-cased."""
    return LETTERS.findall((text or "").lower())


def word_grams(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Packed 4-grams of UTF-16 units ending at each letter and at the word's end, and the index of
    the word of each. A word is seen as two blanks, a start mark, its letters and the same mark."""
    line = "".join(f"\0\0 {w} " for w in words).encode("utf-16-le", "surrogatepass")
    units = np.frombuffer(line, "<u2").astype(np.uint64)
    if not len(units):
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    grams = units.copy()
    for back in range(1, ORDER):
        grams[back:] |= units[:-back] << np.uint64(16 * back)
    starts = (units[:-2] == 0) & (units[1:-1] == 0)
    word = np.cumsum(np.concatenate((starts, [False, False]))) - 1
    kept = units != 0
    kept[2:] &= ~((units[2:] == 32) & (units[1:-1] == 0))
    return grams[kept], word[kept]


def _counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for at in range(0, batch.num_rows, 1024):
            part = batch.slice(at, 1024)
            by_kind: dict[tuple, Counter] = {}
            for text, *kind in zip(part.column(0), part.column(1).to_pylist(), part.column(2).to_pylist()):
                by_kind.setdefault(tuple(kind), Counter()).update(text_words(text.as_py()))
            for (lang, left_out), words in by_kind.items():
                grams, word = word_grams(list(words))
                if not len(grams):
                    continue
                weights = np.fromiter(words.values(), np.int64, len(words))[word]
                found, inverse = np.unique(grams, return_inverse=True)
                n = np.bincount(inverse, weights=weights).astype(np.int64)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([lang] * len(found)), pa.array(found.view(np.int64)),
                        pa.array(n), pa.array(n * (not left_out)),
                    ],
                    ["lang", "gram", "n", "rest"],
                )
    release_memory()


def gram_counts(
    docs: DataFrame, text: str = "text", lang: str = "lang", left_out: Column | None = None
) -> DataFrame:
    """lang, gram (packed), n over whole texts, and rest over those that ``left_out`` does not mark;
    rows without text or language play no part."""
    mark = F.lit(False) if left_out is None else F.coalesce(left_out, F.lit(False))
    rows = docs.filter(F.col(lang).isNotNull() & F.col(text).isNotNull()).select(text, lang, mark.alias("_out"))
    found = rows.mapInArrow(_counts, "lang string, gram bigint, n bigint, rest bigint")
    return found.groupBy("lang", "gram").agg(F.sum("n").alias("n"), F.sum("rest").alias("rest"))


def model_tables(counts: DataFrame, languages: list[str]) -> DataFrame:
    """table, lang (place in ``languages``), key, value of all interpolated Kneser-Ney tables.

    Table ``2 * order`` is the discounted relative frequency of an n-gram, the next one the weight
    its context leaves to the lower order. The highest order counts occurrences, lower ones the
    different characters seen before. The discount of an order is n1 / (n1 + 2 n2), of its n-grams
    seen once and twice.
    """
    levels, grams = [], counts
    for order in range(ORDER, 0, -1):
        level = grams.select(F.lit(order).alias("n_order"), "lang", "gram", "n")
        levels.append(stored(level, f"grams-{order}"))
        lower = F.col("gram").bitwiseAND(F.lit((1 << (16 * (order - 1))) - 1)).alias("gram")
        grams = levels[-1].groupBy("lang", lower).agg(F.count(F.lit(1)).alias("n"))
    every = functools.reduce(DataFrame.unionByName, levels)
    once, twice = (F.sum((F.col("n") == k).cast("int")) for k in (1, 2))
    d = F.coalesce(once / F.nullif(once + 2 * twice, F.lit(0)), F.lit(0.5))
    # One row per order and language.
    discount = F.broadcast(
        every.groupBy("n_order", "lang").agg(F.least(F.greatest(d, F.lit(0.05)), F.lit(0.95)).alias("d"))
    )
    context = F.when(F.col("n_order") > 1, F.shiftrightunsigned("gram", 16)).otherwise(0)
    seen = every.withColumn("context", context.cast("bigint"))
    totals = seen.groupBy("n_order", "lang", "context").agg(
        F.sum("n").alias("total"), F.count(F.lit(1)).alias("kinds")
    )
    totals = stored(totals.join(discount, ["n_order", "lang"]), "contexts")
    joined = seen.join(totals, ["n_order", "lang", "context"])
    place = F.array_position(F.array(*[F.lit(x) for x in languages]), F.col("lang")) - 1

    def rows(frame: DataFrame, is_context: int, key: str, value: Column) -> DataFrame:
        return frame.select(
            (2 * F.col("n_order") + is_context).cast("tinyint").alias("table"),
            place.cast("smallint").alias("lang"), F.col(key).alias("gram"), value.alias("value"),
        )

    frequency = F.greatest(F.col("n") - F.col("d"), F.lit(0.0)) / F.col("total")
    left = F.col("d") * F.col("kinds") / F.col("total")
    table = rows(joined, 0, "gram", frequency).unionByName(rows(totals, 1, "context", left))
    return table.select("table", "lang", F.col("gram").alias("key"), F.col("value").cast("float"))


class GramTable:
    """Sorted n-gram keys and, of each, the languages that have it with their values."""

    def __init__(self, key: np.ndarray, lang: np.ndarray, value: np.ndarray, default: float):
        order = np.argsort(key, kind="stable")
        key = key[order]
        first = np.flatnonzero(np.concatenate(([True], key[1:] != key[:-1]))) if len(key) else np.zeros(0, np.int64)
        self.keys = key[first]
        self.starts = np.append(first, len(key)).astype(np.int64)
        self.lang, self.value = lang[order].astype(np.int16), np.minimum(value[order], 1.0).astype(np.float32)
        self.default = np.float32(default)

    def find(self, grams: np.ndarray, languages: int) -> np.ndarray:
        """A row per n-gram and a column per language; the default where the two were not met."""
        out = np.full((len(grams), languages), self.default)
        if len(self.keys):
            at = np.minimum(np.searchsorted(self.keys, grams), len(self.keys) - 1)
            rows = np.flatnonzero(self.keys[at] == grams)
            low, high = self.starts[at[rows]], self.starts[at[rows] + 1]
            n = high - low
            entries = np.repeat(low - np.concatenate(([0], np.cumsum(n)[:-1])), n) + np.arange(n.sum()) if len(n) else low
            out[np.repeat(rows, n), self.lang[entries]] = self.value[entries]
        return out


@dataclass
class CharacterModels:
    """The models of all languages: a table per order and kind, or the stored tables where these have
    too many values to be sent."""

    languages: list[str]
    tables: dict = field(default_factory=dict)
    limits: dict = field(default_factory=dict)
    sharpness: float = 1.0
    stored: DataFrame | None = None

    def __getstate__(self):
        return {**self.__dict__, "stored": None}

    @staticmethod
    def gathered(rows: DataFrame, languages: list[str]) -> CharacterModels:
        """From the stored tables, if they have at most ``MOST_VALUES`` values."""
        if rows.count() > MOST_VALUES:
            return CharacterModels(languages, stored=rows)
        model = CharacterModels(languages)
        for number in range(2, 2 * ORDER + 2):
            part = rows.filter(F.col("table") == number).select("lang", "key", "value").toArrow()
            lang, key, value = (part.column(c).to_numpy() for c in ("lang", "key", "value"))
            # An n-gram that was not met has no count and leaves all to the lower order.
            model.tables[number] = GramTable(key.view(np.uint64), lang, value, number % 2)
        return model

    def word_bits(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Bits each language needs for each word, and the number of characters coded."""
        grams, word = word_grams(words)
        distinct, inverse = np.unique(grams, return_inverse=True)
        p = np.full((len(distinct), len(self.languages)), 1.0 / SYMBOLS)
        for order in range(1, ORDER + 1):
            gram = distinct & np.uint64((1 << (16 * order)) - 1)
            context = gram >> np.uint64(16)
            found = (self.tables[2 * order + k].find(g, len(self.languages)) for k, g in enumerate((gram, context)))
            p = next(found) + next(found) * p
        bits = -np.log2(np.maximum(p, 1e-30))[inverse]
        n = len(words)
        total = np.stack([np.bincount(word, bits[:, i], n) for i in range(bits.shape[1])], axis=1)
        return total, np.bincount(word, minlength=n)

    def decide(self, entropy: np.ndarray, coded: np.ndarray) -> tuple:
        """Languages, scores and rejections for cross-entropies (texts x languages)."""
        best = entropy.argmin(axis=1)
        lowest = entropy[np.arange(len(best)), best]
        odds = np.exp(-self.sharpness * (entropy - lowest[:, None]))
        score = 1.0 / odds.sum(axis=1)
        rejected = np.ones(len(best), bool)
        for i, lang in enumerate(self.languages):
            mean, spread, single = self.limits.get(lang, (0.0, np.inf, 0.0))
            limit = mean + REJECT_DEVIATIONS * np.sqrt(spread**2 + single**2 / np.maximum(coded, 1))
            rejected[best == i] = lowest[best == i] > limit[best == i]
        return best, score, rejected


class _WordMemory:
    """Bits of the words met so far; starts anew when it is full."""

    def __init__(self, models: CharacterModels):
        self.models = models
        self.forget()

    def forget(self) -> None:
        self.place: dict[str, int] = {}
        self.bits = np.zeros((0, len(self.models.languages)))
        self.coded = np.zeros(0, np.int64)

    def look_up(self, texts: list[list[str]]) -> tuple[np.ndarray, np.ndarray]:
        """Total bits and coded characters of each text."""
        new = list({w for words in texts for w in words if w not in self.place})
        if len(self.place) + len(new) > KNOWN_WORDS and self.place:
            self.forget()
            new = list({w for words in texts for w in words})
        step = max(500, 40_000 // len(self.models.languages))
        for at in range(0, len(new), step):
            part = new[at : at + step]
            bits, coded = self.models.word_bits(part)
            self.place.update(zip(part, range(len(self.place), len(self.place) + len(part))))
            self.bits = np.concatenate((self.bits, bits))
            self.coded = np.concatenate((self.coded, coded))
        lengths = np.fromiter(map(len, texts), np.int64, len(texts))
        at = np.fromiter((self.place[w] for words in texts for w in words), np.int64, lengths.sum())
        text = np.repeat(np.arange(len(texts)), lengths)
        n = len(texts)
        bits = self.bits[at]
        total = np.stack([np.bincount(text, bits[:, i], n) for i in range(bits.shape[1])], axis=1)
        return total, np.bincount(text, self.coded[at], n)


def _entropies(shared, emit):
    """Scores whole texts slice by slice; ``emit`` turns entropies into output columns."""

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        models = shared.value
        memory = _WordMemory(models)
        for batch in batches:
            for at in range(0, batch.num_rows, SLICE):
                part = batch.slice(at, SLICE)
                words = [text_words(t.as_py()) for t in part.column(0)]
                bits, coded = memory.look_up(words)
                entropy = bits / np.maximum(coded, 1)[:, None]
                columns, names = emit(models, part, entropy, coded)
                yield pa.RecordBatch.from_arrays(columns, names)
        memory.forget()
        release_memory()

    return score


def _emit_decisions(models, part, entropy, coded):
    best, score, rejected = models.decide(entropy, coded)
    some = coded > 0
    langs = [models.languages[i] if s else UNKNOWN for i, s in zip(best, some)]
    return (
        [
            *part.columns[1:],
            pa.array(langs),
            pa.array(np.where(some, score, 0.0)),
            pa.array(np.where(some, entropy.min(axis=1), np.nan), from_pandas=True),
            pa.array(rejected | ~some),
        ],
        [*part.schema.names[1:], "lang_pred", "score", "cross_entropy", "rejected"],
    )


def _emit_entropies(models, part, entropy, coded):
    values = pa.array(list(entropy), pa.list_(pa.float64()))
    return [part.column(1), values, pa.array(coded.astype(np.int64))], ["lang", "entropy", "coded"]


def _document_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for at in range(0, batch.num_rows, SLICE):
            ids, words, counts = [], [], []
            part = batch.slice(at, SLICE)
            for key, text in zip(part.column(0).to_pylist(), part.column(1)):
                found = Counter(text_words(text.as_py()))
                ids += [key] * len(found)
                words += found.keys()
                counts += found.values()
            columns = [pa.array(ids, pa.int64()), pa.array(words, pa.string()), pa.array(counts, pa.int64())]
            yield pa.RecordBatch.from_arrays(columns, ["id", "word", "n"])


def _words_grams(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for at in range(0, batch.num_rows, 10_000):
            words = batch.column(0).slice(at, 10_000)
            grams, word = word_grams(words.to_pylist())
            yield pa.RecordBatch.from_arrays([words.take(pa.array(word)), pa.array(grams.view(np.int64))], ["word", "gram"])


def joined_entropies(texts: DataFrame, tables: DataFrame, languages: list[str]) -> DataFrame:
    """id, entropy (a cross-entropy per language), coded for every text (id, text) with a letter: as
    ``CharacterModels`` has them, by joins with the stored tables.

    Probabilities are worked out once for each distinct n-gram of the distinct words, order by order;
    an n-gram or context meets at most 65,536 others there. The most frequent words, a fixed number of
    them, are sent to the texts; the others meet the texts by word.
    """
    words = stored(texts.mapInArrow(_document_words, "id bigint, word string, n bigint"), "document-words")
    distinct = stored(words.groupBy("word").agg(F.sum("n").alias("n")), "words")
    grams = distinct.select("word").mapInArrow(_words_grams, "word string, gram bigint")
    grams = stored(grams.groupBy("word", "gram").agg(F.count(F.lit(1)).alias("k")), "word-grams")
    known = grams.select("gram").distinct()
    places = range(len(languages))

    def table(number: int, name: str) -> DataFrame:
        default = F.lit(float(number % 2))
        value = [F.coalesce(F.max(F.when(F.col("lang") == i, F.least("value", F.lit(1.0).cast("float")))), default) for i in places]
        found = tables.filter(F.col("table") == number).groupBy("key")
        return found.agg(F.array(*[v.cast("double") for v in value]).alias(name))

    def filled(name: str, number: int) -> Column:
        return F.coalesce(F.col(name), F.array(*[F.lit(float(number % 2)) for _ in places]))

    p = None
    for order in range(1, ORDER + 1):
        mask = (1 << (16 * order)) - 1
        own = known if order == ORDER else known.select(F.col("gram").bitwiseAND(F.lit(mask)).alias("gram")).distinct()
        keyed = own.select(
            "gram", F.shiftrightunsigned("gram", 16).alias("_context"),
            F.col("gram").bitwiseAND(F.lit((1 << (16 * (order - 1))) - 1)).alias("_suffix"),
        )
        met = keyed.join(table(2 * order, "_f").withColumnRenamed("key", "gram"), "gram", "left")
        met = met.join(table(2 * order + 1, "_c").withColumnRenamed("key", "_context"), "_context", "left")
        lower = F.array(*[F.lit(1.0 / SYMBOLS) for _ in places])
        if p is not None:
            met = met.join(p.select(F.col("gram").alias("_suffix"), F.col("p").alias("_p")), "_suffix")
            lower = F.col("_p")
        left = F.zip_with(filled("_c", 2 * order + 1), lower, lambda c, q: c * q)
        own_p = F.zip_with(filled("_f", 2 * order), left, lambda f, q: f + q)
        p = stored(met.select("gram", own_p.alias("p")), f"probabilities-{order}")
    bits = F.transform("p", lambda q: -F.log2(F.greatest(q, F.lit(1e-30))))
    by_word = grams.join(p.select("gram", bits.alias("bits")), "gram").groupBy("word").agg(
        F.array(*[F.sum(F.col("bits")[i] * F.col("k")) for i in places]).alias("bits"), F.sum("k").alias("coded")
    )
    by_word = stored(distinct.join(by_word, "word"), "word-bits")
    frequent = by_word.orderBy(F.desc("n"), "word").limit(FREQUENT_WORDS).select("word", "bits", "coded")
    frequent = F.broadcast(stored(frequent, "frequent-words"))
    sent = words.join(frequent, "word")
    others = words.join(frequent, "word", "left_anti").join(by_word.drop("n"), "word")
    totals = sent.unionByName(others).groupBy("id").agg(
        F.array(*[F.sum(F.col("bits")[i] * F.col("n")) for i in places]).alias("bits"),
        F.sum(F.col("coded") * F.col("n")).alias("coded"),
    )
    return totals.select("id", F.transform("bits", lambda b: b / F.col("coded")).alias("entropy"), "coded")


def _numbered(texts: DataFrame) -> DataFrame:
    """The rows with an ``_id``, stored: a number once given stays."""
    return stored(texts.withColumn("_id", F.monotonically_increasing_id()), "numbered")


def fit(
    docs: DataFrame,
    text: str = "text",
    lang: str = "lang",
    calibration: int = CALIBRATION,
) -> CharacterModels | None:
    """Models of every language in ``docs``, counted over all its texts; None if it has none.

    Rejection and score are calibrated on a tenth of each language's texts, ``calibration`` at most,
    chosen by a hash of their doc_id: their cross-entropies are those of models that are counted
    without them, as for texts the models have not seen.
    """
    labelled = small_batches(docs).filter(F.col(lang).isNotNull()).select("doc_id", text, lang)
    # A row per language.
    sizes = labelled.groupBy(lang).agg(F.count(F.lit(1)).alias("_n"))
    # A row-local choice, however large the language.
    place = F.pmod(F.xxhash64(F.lit("calibration"), "doc_id"), F.lit(1 << 30)) / F.lit(float(1 << 30))
    wanted = F.least(F.lit(float(calibration)), F.greatest(F.lit(1.0), F.col("_n") / LEFT_OUT))
    marked = labelled.join(F.broadcast(sizes), lang).withColumn("_left_out", place < wanted / F.col("_n"))
    counts = stored(gram_counts(marked, text, lang, F.col("_left_out")), "gram-counts")
    if counts.isEmpty():
        return None
    languages = sorted(r[0] for r in counts.select("lang").distinct().collect())
    models = CharacterModels.gathered(stored(model_tables(counts, languages), "models"), languages)
    rest = counts.filter("rest > 0").select("lang", "gram", F.col("rest").alias("n"))
    trial = CharacterModels.gathered(stored(model_tables(rest, languages), "trial-models"), languages)
    _calibrate(models, _sample_entropies(marked.filter("_left_out").select(text, lang), trial))
    return models


def _sample_entropies(sample: DataFrame, models: CharacterModels):
    """lang, entropy, coded of the calibration texts: bounded by their number, which is a parameter."""
    if models.stored is not None:
        rows = _numbered(sample.toDF("text", "lang"))
        found = joined_entropies(rows.select(F.col("_id").alias("id"), "text"), models.stored, models.languages)
        return rows.join(found, F.col("_id") == F.col("id")).select("lang", "entropy", "coded").toPandas()
    shared = sample.sparkSession.sparkContext.broadcast(models)
    rows = sample.mapInArrow(
        _entropies(shared, _emit_entropies), "lang string, entropy array<double>, coded bigint"
    ).toPandas()
    shared.destroy()
    return rows


def _calibrate(models: CharacterModels, rows) -> None:
    """Limits of each language's own cross-entropy, and the sharpness that makes scores likely."""
    rows = rows[rows.coded > 0]
    entropy = np.array(rows.entropy.tolist()).reshape(len(rows), len(models.languages))
    truth = np.array([models.languages.index(x) for x in rows.lang], np.int64)
    coded = rows.coded.to_numpy()
    own = entropy[np.arange(len(truth)), truth]
    for i, lang in enumerate(models.languages):
        mine, length = own[truth == i], coded[truth == i]
        if not len(mine):
            continue
        mean = float(np.average(mine, weights=length))
        long = length >= np.median(length)
        spread = float(np.std(mine[long]))
        # What short texts vary more than long ones is the variation of single characters.
        rest = np.maximum((mine - mean) ** 2 - spread**2, 0.0) * length
        models.limits[lang] = mean, max(spread, 0.1), math.sqrt(max(float(np.mean(rest)), 4.0))
    best = (np.inf, 1.0)
    for sharpness in np.geomspace(0.25, 64, 33):
        scaled = -sharpness * (entropy - entropy.min(axis=1, keepdims=True))
        loss = float(np.mean(np.log(np.exp(scaled).sum(axis=1)) - scaled[np.arange(len(truth)), truth]))
        best = min(best, (loss, float(sharpness)))
    models.sharpness = best[1]


def identify(docs: DataFrame, models: CharacterModels | None, text: str = "text") -> DataFrame:
    """All columns of ``docs`` with lang_pred, score, cross_entropy and rejected.

    Every whole text is scored. Null texts and texts without a letter are ``und`` with score 0 and
    rejected; so is everything if there is no model. Others get a learned language, and are
    rejected if their cross-entropy lies beyond what texts of that language and length reach. Input
    columns with an output's name are replaced.
    """
    outputs = ["lang_pred", "score", "cross_entropy", "rejected"]
    kept = [c for c in docs.columns if c.lower() not in outputs]
    own = [F.col(f"`{c}`") for c in kept]
    if models is None:
        return docs.select(
            *own, F.lit(UNKNOWN).alias("lang_pred"), F.lit(0.0).alias("score"),
            F.lit(None).cast("double").alias("cross_entropy"), F.lit(True).alias("rejected"),
        )
    rows = small_batches(docs).select(F.col(f"`{text}`").alias("_body"), *own)
    kinds = ", ".join(f"`{c}` {docs.schema[c].dataType.simpleString()}" for c in kept)
    if models.stored is not None:
        return _identified_by_joins(rows, models, kinds)
    shared = docs.sparkSession.sparkContext.broadcast(models)
    return rows.mapInArrow(
        _entropies(shared, _emit_decisions),
        f"{kinds}, lang_pred string, score double, cross_entropy double, rejected boolean",
    )


def _identified_by_joins(rows: DataFrame, models: CharacterModels, kinds: str) -> DataFrame:
    """``rows`` (_body and the columns that stay) with their decisions, by ``joined_entropies``."""
    numbered = _numbered(rows)
    found = joined_entropies(
        numbered.select(F.col("_id").alias("id"), F.col("_body").alias("text")), models.stored, models.languages
    )
    kept = [F.col(f"`{c}`") for c in rows.columns if c != "_body"]
    met = numbered.drop("_body").join(found, F.col("_id") == F.col("id"), "left").select("entropy", "coded", *kept)

    def decide(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        none = [math.inf] * len(models.languages)
        for batch in batches:
            entropy = np.array([e or none for e in batch.column(0).to_pylist()]).reshape(batch.num_rows, len(none))
            coded = np.array([c or 0 for c in batch.column(1).to_pylist()], np.int64)
            entropy[coded == 0] = 0.0
            rest = pa.RecordBatch.from_arrays(batch.columns[1:], batch.schema.names[1:])
            columns, names = _emit_decisions(models, rest, entropy, coded)
            yield pa.RecordBatch.from_arrays(columns, names)

    return met.mapInArrow(
        decide, f"{kinds}, lang_pred string, score double, cross_entropy double, rejected boolean"
    )
