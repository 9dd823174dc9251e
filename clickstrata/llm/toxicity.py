"""Toxicity: averaged subword embeddings under a linear softmax, trained jointly in numpy.

A word is the bag of its character n-grams (with marks for its beginning and end); every
n-gram has an embedding in a hashed table, so a misspelling never seen shares most of its
vectors with the word it stands for. A window of consecutive words is the average of its
words, a linear softmax over that average gives two classes, and embeddings and softmax are
trained together by gradient descent.

Labels are given to whole texts, but a few words decide them. A text therefore scores as its
most toxic window does; in training, the windows of toxic texts that count as toxic are chosen
anew before each pass. A logistic curve over the largest window margin, fitted to the training
texts, makes the score of a text.

The model is linear in the words of a window: scoring needs one number per distinct word, kept
by the worker, and a moving sum.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from clickstrata.llm.common import REMEMBERED_WORDS, WORD_BYTES, chunks, mixed, table

#: Scores from here on are predicted toxic.
THRESHOLD = 0.3

#: Texts, and words or windows, that the fit works on at once beside its batches.
FIT_TEXTS, FIT_WORDS = 64, 4096

FITTED = "weights binary, bias double, slope double, offset double"


@dataclass(frozen=True)
class Settings:
    """Parameters of the fit. ``rows`` bounds the labelled texts of each class that are
    fetched for it and ``windows`` the windows of a text, both chosen by hash."""

    rows: int = 1500
    windows: int = 48
    window: int = 8
    grams: tuple[int, ...] = (3, 4, 5, 6)
    bits: int = 16
    dim: int = 8
    passes: int = 6
    rate: float = 0.25
    seed: int = 7


SETTINGS = Settings()


def lower_words(text: str | None) -> list[bytes]:
    """Lower-case words of letters and digits, in UTF-8."""
    if not text:
        return []
    return text.lower().encode("utf-8", "surrogatepass").translate(WORD_BYTES).split()


def word_grams(words: list[bytes], grams: tuple[int, ...], bits: int):
    """Buckets of the n-grams of words: (number of the word, bucket), sorted by word.

    The whole word is one of its grams.
    """
    joined = np.frombuffer(b"<" + b"><".join(words) + b">", np.uint8).astype(np.uint64)
    lengths = np.fromiter(map(len, words), np.int64, len(words)) + 2
    owner = np.repeat(np.arange(len(words)), lengths)
    owners, buckets = [], []
    for n in grams:
        count = len(joined) - n + 1
        if count <= 0:
            continue
        code = np.full(count, n, np.uint64)
        for i in range(n):
            code = code * np.uint64(257) + joined[i : i + count]
        inside = owner[:count] == owner[n - 1 :]
        owners.append(owner[:count][inside])
        buckets.append(mixed(code[inside]))
    starts = np.concatenate([[0], np.cumsum(lengths)[:-1]])
    power = np.uint64(0x100000001B3) ** (np.arange(len(joined)) % 64).astype(np.uint64)
    owners.append(np.arange(len(words)))
    place = np.arange(len(joined)) - np.repeat(starts, lengths)
    code = (joined + np.uint64(1)) * mixed(place.astype(np.uint64) + power[0])
    buckets.append(mixed(np.add.reduceat(code, starts)))
    owners, buckets = np.concatenate(owners), np.concatenate(buckets)
    order = np.argsort(owners, kind="stable")
    return owners[order], (buckets[order] & np.uint64((1 << bits) - 1)).astype(np.int64)


@dataclass
class Model:
    """One number per n-gram bucket, and the curve from margins to scores.

    ``weights`` are the embeddings multiplied by the difference of the two softmax rows;
    ``margin(window) = bias + mean over words of mean over grams of weights``.
    """

    weights: np.ndarray
    bias: float
    slope: float
    offset: float
    settings: Settings

    def __post_init__(self):
        self.known: dict[bytes, float] = {}

    def word_scores(self, words: list[bytes]) -> np.ndarray:
        """The part of each word; new words are computed together."""
        if len(self.known) > REMEMBERED_WORDS:
            self.known.clear()
        new = list({w for w in words if w not in self.known})
        if new:
            owners, buckets = word_grams(new, self.settings.grams, self.settings.bits)
            sums = np.bincount(owners, self.weights[buckets], len(new))
            means = sums / np.bincount(owners, minlength=len(new))
            self.known.update(zip(new, means.tolist(), strict=True))
        return np.fromiter(map(self.known.__getitem__, words), np.float64, len(words))

    def margins(self, words: list[bytes]) -> np.ndarray:
        """Of each window; a text of fewer words is filled up with neutral ones."""
        size = self.settings.window
        scores = self.word_scores(words) if words else np.zeros(0)
        if len(scores) <= size:
            return np.array([scores.sum() / size + self.bias])
        sums = np.concatenate([[0.0], np.cumsum(scores)])
        return (sums[size:] - sums[:-size]) / size + self.bias

    def score(self, words: list[bytes]) -> float:
        best = float(self.margins(words).max())
        return 1.0 / (1.0 + float(np.exp(-(self.slope * best + self.offset))))


def training_windows(docs: DataFrame, labels: DataFrame, settings: Settings = SETTINGS):
    """(toxic, words of each chosen window) of a bounded, hashed choice of labelled texts."""
    chosen = None
    for toxic in (0, 1):
        of_class = labels.where((F.col("toxic") == toxic) & F.col("doc_id").isNotNull())
        rows = (
            of_class.select("doc_id", "toxic")
            .orderBy(F.xxhash64(F.col("doc_id").cast("string"), F.lit(settings.seed)), "doc_id")
            .limit(settings.rows)
        )
        chosen = rows if chosen is None else chosen.unionByName(rows)
    chosen = chosen.groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    joined = docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id")

    def windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            toxic, found = [], []
            for label, text in zip(batch.column(1), batch.column(2), strict=True):
                words = lower_words(text.as_py())
                starts = np.arange(0, max(1, len(words)), settings.window)
                keys = mixed(starts.astype(np.uint64) + np.uint64(len(words)))
                starts = starts[np.argsort(keys)[: settings.windows]]
                toxic.append(int(label.as_py()))
                found.append([b" ".join(words[s : s + settings.window]) for s in starts])
            yield pa.RecordBatch.from_arrays(
                [pa.array(toxic, pa.int32()), pa.array(found, pa.list_(pa.binary()))],
                ["toxic", "windows"],
            )

    joined = joined.select("doc_id", "toxic", "text")
    return joined.mapInArrow(windows, "toxic int, windows array<binary>")


def fit(docs: DataFrame, labels: DataFrame, settings: Settings = SETTINGS) -> Model:
    """Train on at most ``2 * settings.rows`` labelled texts, fetched as bounded windows.

    Labels that are null, or whose text is missing, are not used. Without texts of both
    classes the model scores every text 0. One task trains, on rows that do not grow with the
    input; the driver gets the finished numbers only.
    """
    counts = {r["toxic"]: r["count"] for r in labels.groupBy("toxic").count().collect()}

    def trained(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # one window a line; a line break sorts before all that a window holds
        rows = sorted(
            (label, b"\n".join(windows.as_py()))
            for batch in batches
            for label, windows in zip(batch.column(0).to_pylist(), batch.column(1), strict=True)
        )
        toxic = np.array([label for label, _ in rows], np.int64)
        if len(set(toxic.tolist())) == 2:
            model = _fitted([text for _, text in rows], toxic, counts, settings)
            numbers = [[model.weights.tobytes()], [model.bias], [model.slope], [model.offset]]
            names = ["weights", "bias", "slope", "offset"]
            yield pa.RecordBatch.from_arrays([pa.array(n) for n in numbers], names)

    rows = training_windows(docs, labels, settings).repartition(1)
    for weights, *numbers in rows.mapInArrow(trained, FITTED).collect():
        return Model(np.frombuffer(weights, np.float64), *numbers, settings)
    return Model(np.zeros(1 << settings.bits), 0.0, 0.0, -50.0, settings)


def _fitted(texts: list[bytes], toxic: np.ndarray, counts: dict, settings: Settings) -> Model:
    """The model of sorted texts, of one window a line, and their labels. ``counts``: of all labels."""
    weights, bias = _train(texts, toxic, settings)
    model = Model(weights, bias, 1.0, 0.0, settings)
    best = []
    for some in chunks(texts, FIT_TEXTS):
        model.word_scores(b"\n".join(some).split())
        best += [max(model.margins(w.split()).max() for w in text.split(b"\n")) for text in some]
    best = np.array(best)
    weight = np.array([counts[t] / (toxic == t).sum() for t in toxic.tolist()])
    model.slope, model.offset = _curve(best, toxic, weight * len(toxic) / weight.sum())
    return model


def _numbered(texts: list[bytes]):
    """Distinct words in order, the number of each word of all windows, and for each window that
    has words how many these are and the number of its text."""
    number: dict[bytes, int] = {}
    flat, sizes, text_of = [], [], []
    for t, text in enumerate(texts):
        windows = [words for line in text.split(b"\n") if (words := line.split())]
        own = [number.setdefault(w, len(number)) for words in windows for w in words]
        flat.append(np.array(own, np.int32))
        sizes.append(np.array([len(words) for words in windows], np.int64))
        text_of.append(np.full(len(windows), t))
    words = sorted(number)
    place = np.empty(len(words), np.int32)
    place[[number[w] for w in words]] = np.arange(len(words))
    return words, place[np.concatenate(flat)], np.concatenate(sizes), np.concatenate(text_of)


def _sums(values: np.ndarray, numbers: np.ndarray, edges: np.ndarray) -> np.ndarray:
    """Sums of the values with the ``numbers`` between each two edges, some at a time."""
    found = np.empty(len(edges) - 1)
    for at in range(0, len(found), FIT_WORDS):
        some = edges[at : at + FIT_WORDS + 1]
        inside = values[numbers[some[0] : some[-1]]]
        found[at : at + FIT_WORDS] = np.add.reduceat(inside, some[:-1] - some[0])
    return found


def _train(texts: list[bytes], toxic: np.ndarray, settings: Settings):
    """Gradient descent on embeddings and softmax together, over texts of one window a line.

    Windows of clean texts are clean. Of a toxic text, windows whose probability is at least
    half that of its best window count as toxic, chosen before each pass; the first pass takes
    them all.
    """
    words, flat, sizes, text_of = _numbered(texts)
    gram_count, buckets = [], []
    for some in chunks(words, FIT_WORDS):
        owners, found = word_grams(some, settings.grams, settings.bits)
        gram_count.append(np.bincount(owners, minlength=len(some)))
        buckets.append(found.astype(np.int32))
    gram_count, buckets = np.concatenate(gram_count), np.concatenate(buckets)
    first = np.concatenate([[0], np.cumsum(gram_count)])
    begins = np.concatenate([[0], np.cumsum(sizes)])
    del words
    rng = np.random.default_rng(settings.seed)
    embed = rng.normal(0, 0.3, (1 << settings.bits, settings.dim))
    out, bias = rng.normal(0, 0.3, (settings.dim, 2)), np.zeros(2)
    squares = np.full(1 << settings.bits, 1e-2)
    target = toxic[text_of]
    for step in range(settings.passes):
        use = np.ones(len(sizes), bool)
        if step:
            part = embed @ (out[:, 1] - out[:, 0])
            per_word = _sums(part, buckets, first) / gram_count
            margin = _sums(per_word, flat, begins) / settings.window
            top = np.full(len(texts), -np.inf)
            np.maximum.at(top, text_of, margin)
            use = (target == 0) | (margin >= top[text_of] - np.log(2))
        order = rng.permutation(np.flatnonzero(use))
        share = max(1.0, (target[order] == 0).sum() / max(1, (target[order] == 1).sum()))
        for at in range(0, len(order), 512):
            batch = order[at : at + 512]
            took = sizes[batch]
            of_window = np.repeat(np.arange(len(batch)), took)
            inside = np.arange(took.sum()) - np.repeat(np.cumsum(took) - took, took)
            ids = flat[np.repeat(begins[batch], took) + inside]
            counts = gram_count[ids]
            of_word = np.repeat(np.arange(len(ids)), counts)
            inner = np.arange(counts.sum()) - np.repeat(np.cumsum(counts) - counts, counts)
            grams = buckets[np.repeat(first[ids], counts) + inner]
            scale = (1.0 / (counts * settings.window))[of_word]
            owner = of_window[of_word]
            edge = np.concatenate([[0], np.flatnonzero(np.diff(owner)) + 1])
            scaled = embed[grams]
            scaled *= scale[:, None]
            mean = np.add.reduceat(scaled, edge)
            logits = mean @ out + bias
            logits -= logits.max(axis=1, keepdims=True)
            p = np.exp(logits)
            p /= p.sum(axis=1, keepdims=True)
            y = target[batch]
            p[np.arange(len(batch)), y] -= 1.0
            p *= np.where(y == 1, np.sqrt(share), 1.0)[:, None]
            back = p @ out.T
            out -= settings.rate * mean.T @ p / len(batch) * 10
            bias -= settings.rate * p.mean(axis=0)
            size = np.bincount(grams, (back**2).sum(axis=1)[owner] * scale**2, len(squares))
            squares += size
            for d in range(settings.dim):
                move = np.bincount(grams, back[owner, d] * scale, len(squares))
                embed[:, d] -= settings.rate * move / np.sqrt(squares)
    return embed @ (out[:, 1] - out[:, 0]), float(bias[1] - bias[0])


def _curve(margins: np.ndarray, toxic: np.ndarray, weight: np.ndarray) -> tuple[float, float]:
    """Logistic curve over one number, by Newton steps with a little shrinkage.

    ``weight`` gives the classes the proportion that they have among all labels.
    """
    mean, spread = margins.mean(), margins.std() + 1e-9
    x = np.stack([(margins - mean) / spread, np.ones(len(margins))], axis=1)
    w = np.zeros(2)
    for _ in range(30):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        gradient = x.T @ (weight * (p - toxic)) + 0.5 * w * [1, 0]
        hessian = (x * (weight * p * (1 - p))[:, None]).T @ x + np.diag([0.5, 1e-6])
        w -= np.linalg.solve(hessian, gradient)
    return float(w[0] / spread), float(w[1] - w[0] * mean / spread)


@lru_cache(maxsize=2)
def _received(weights: bytes, numbers: tuple, settings: Settings) -> Model:
    return Model(np.frombuffer(weights, np.float32).astype(np.float64), *numbers, settings)


def toxicity_score(text: Column, model: Model) -> Column:
    """Score of whole texts between 0 and 1; null and empty texts score as neutral words do."""
    weights = model.weights.astype(np.float32).tobytes()  # 2 ** bits numbers, at any data size
    numbers = model.bias, model.slope, model.offset
    settings = model.settings

    @F.arrow_udf("double")
    def score(texts: pa.Array) -> pa.Array:
        here = _received(weights, numbers, settings)
        return pa.array((here.score(lower_words(t.as_py())) for t in texts), pa.float64())

    return score(text)


def held_out(doc_id: Column) -> Column:
    """Whether the label of a document is kept from training."""
    return F.coalesce(F.crc32(doc_id.cast("string")) % 4 == 2, F.lit(False))


def score_documents(
    docs: DataFrame, model: Model, threshold: float = THRESHOLD
) -> DataFrame:
    """One row per row of ``docs``: ``doc_id``, ``held_out``, ``score`` and ``predicted``.

    Only the text decides the score. Repeated rows are scored each; a null id is not held out;
    an empty table gives an empty result.
    """
    return docs.select(
        "doc_id",
        held_out(F.col("doc_id")).alias("held_out"),
        toxicity_score(F.col("text"), model).alias("score"),
    ).withColumn("predicted", (F.col("score") >= threshold).cast("int"))


def drop_toxic(docs: DataFrame, model: Model, threshold: float = THRESHOLD) -> DataFrame:
    """The rows of ``docs``, with all their columns, that are not predicted toxic."""
    return docs.where(toxicity_score(F.col("text"), model) < threshold)


def toxicity_model(spark: SparkSession, sf_dir: str) -> Model:
    """Fitted to the labels that are not held out."""
    labels = table(spark, sf_dir, "labels", "doc_id", "toxic")
    labels = labels.where(~held_out(F.col("doc_id")))
    return fit(table(spark, sf_dir, "documents", "doc_id", "text"), labels)
