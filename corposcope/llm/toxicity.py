"""Toxicity of documents from subword-bag embeddings and a linear softmax, trained together.

A word's vector is the mean of the vectors of itself and of its character n-grams, so a misspelling that was
never seen shares most of its vectors with the word it is meant to be. The vectors of a passage's
words are averaged and go through the softmax; a document is as toxic as its most toxic passage.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from .common import crc_share, mix64, owners, slices, split_words
from .language import char_hashes

# Bounds of the training sample: rows of each label (expected), and characters of a row's excerpt.
ROWS = 2500
EXCERPT = 12_000
# Hashed vectors, their width, lengths of n-grams, words of a passage.
BUCKETS = 1 << 16
WIDTH = 8
NGRAMS = (3, 4, 5)
PASSAGE = 16
STEPS, BATCH, RATE = 800, 50, 0.5
# Vectors that fewer training texts have stay 0: they would learn those texts by heart.
LEAST_TEXTS = 3
_OTHER = re.compile(r"[\W_]+")


def plain(word: str) -> str:
    """A word in lower case without marks, between the signs of its start and end; empty if nothing is left."""
    word = _OTHER.sub("", word.lower())
    return f"<{word}>" if word else ""


def subwords(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Vector numbers of distinct words and where each word's end: the word itself, then its n-grams."""
    longest = max(NGRAMS)
    starts, ends, hashes = char_hashes(words, longest)
    word_of = owners(np.concatenate([[0], ends]))
    place = np.arange(len(word_of))
    weight = mix64(hashes[0] + (place - starts[word_of]).astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))
    total = np.concatenate([np.zeros(1, np.uint64), np.cumsum(weight, dtype=np.uint64)])
    found, owner = [mix64(total[ends] - total[starts])], [np.arange(len(words))]
    for k in NGRAMS:
        at = np.flatnonzero(place + k <= ends[word_of])
        found.append(mix64(hashes[k - 1][at] + np.uint64(k << 56)))
        owner.append(word_of[at])
    number, owner = (np.concatenate(found) & np.uint64(BUCKETS - 1)).astype(np.int64), np.concatenate(owner)
    order = np.argsort(owner, kind="stable")
    return number[order], np.concatenate([[0], np.cumsum(np.bincount(owner, minlength=len(words)))])


def passages(ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where the passages of all texts end, and the text of each; a text without words has none."""
    sizes = np.diff(ends)
    n = -(-sizes // PASSAGE)
    text = np.repeat(np.arange(len(n)), n)
    place = np.arange(n.sum()) - np.repeat(np.concatenate([[0], np.cumsum(n)[:-1]]), n)
    stops = np.minimum(ends[:-1][text] + (place + 1) * PASSAGE, ends[1:][text])
    return np.concatenate([[0], stops]).astype(np.int64), text


@dataclass
class Model:
    """Vectors, the weight of each of their columns (label 1 against 0), and the bias."""

    vectors: np.ndarray
    weights: np.ndarray
    bias: float

    def word_scores(self, words: list[str]) -> np.ndarray:
        """What a word adds to a passage's sum: the softmax is linear, so vectors can be weighed first."""
        if not words:
            return np.zeros(0)
        number, ends = subwords(words)
        each = (self.vectors @ self.weights)[number]
        return np.add.reduceat(each, ends[:-1]) / np.diff(ends)

    def score(self, texts: pa.Array) -> np.ndarray:
        """Chance of label 1 for each text."""
        words, codes, ends = _plain_words(texts)
        each = self.word_scores(words)[codes]
        stops, text = passages(ends)
        logits = np.full(len(texts), -np.inf)
        if len(text):
            means = np.add.reduceat(each, stops[:-1]) / np.diff(stops)
            np.maximum.at(logits, text, means)
        logits[np.isneginf(logits)] = 0.0  # no word: the bias alone
        return 1 / (1 + np.exp(-np.clip(logits + self.bias, -30, 30)))


def _plain_words(texts: pa.Array) -> tuple[list[str], np.ndarray, np.ndarray]:
    distinct, codes, ends = split_words(texts)
    forms = [plain(w) for w in distinct.to_pylist()]
    words = sorted({w for w in forms if w})
    number = {w: i for i, w in enumerate(words)}
    codes = np.array([number.get(w, -1) for w in forms], np.int64)[codes]
    ends = np.concatenate([[0], np.cumsum(codes >= 0)])[ends]
    return words, codes[codes >= 0], ends


def _shared(number: np.ndarray, at: np.ndarray, codes: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Which vectors occur in ``LEAST_TEXTS`` texts or more."""
    texts = np.zeros(BUCKETS, np.int64)
    for a, b in zip(ends, ends[1:]):
        own = np.unique(codes[a:b])
        sizes = at[own + 1] - at[own]
        spread = np.repeat(at[own] - np.concatenate([[0], np.cumsum(sizes)[:-1]]), sizes) if len(own) else own
        texts[np.unique(number[spread + np.arange(len(spread))])] += 1
    return texts >= LEAST_TEXTS


def train(texts: list[str], labels: list[int], prior: float | None = None, *, seed: int = 5) -> Model:
    """A model from texts and labels; ``prior`` is the share of label 1 where it will be used."""
    rng = np.random.default_rng(seed)
    model = Model(rng.uniform(-1, 1, (BUCKETS, WIDTH)) / WIDTH, rng.uniform(-1, 1, WIDTH) / WIDTH, 0.0)
    truth = np.array(labels, float)
    share = truth.mean() if len(truth) else 0.0
    prior = share if prior is None else prior
    if not 0 < share < 1:  # one label alone tells nothing about texts
        model.weights[:] = 0
        model.bias = float(np.log((prior + 1e-6) / (1 - prior + 1e-6)))
        return model
    words, codes, ends = _plain_words(pa.array(texts, pa.string()))
    number, at = subwords(words)
    known = _shared(number, at, codes, ends)
    model.vectors[~known] = 0
    squares = [np.full(model.vectors.shape, 1e-6), np.full(WIDTH, 1e-6), 1e-6]
    usable = np.flatnonzero(np.diff(ends) > 0)
    batches = max(-(-len(usable) // BATCH), 1)
    for _ in range(-(-STEPS // batches)):
        for batch in np.array_split(rng.permutation(usable), batches):
            if not len(batch):
                continue
            sizes = ends[batch + 1] - ends[batch]
            own = codes[np.repeat(ends[batch] - np.concatenate([[0], np.cumsum(sizes)[:-1]]), sizes) + np.arange(sizes.sum())]
            stops, text = passages(np.concatenate([[0], np.cumsum(sizes)]))
            used, own = np.unique(own, return_inverse=True)
            counts = at[used + 1] - at[used]
            begin = np.concatenate([[0], np.cumsum(counts)[:-1]])
            subs = number[np.repeat(at[used] - begin, counts) + np.arange(counts.sum())]
            vectors = np.add.reduceat(model.vectors[subs], begin, axis=0) / counts[:, None]
            lengths = np.diff(stops)
            means = np.add.reduceat(vectors[own], stops[:-1], axis=0) / lengths[:, None]
            logits = means @ model.weights
            # A soft maximum over the passages of a text shares its gradient among them.
            top = np.full(len(batch), -np.inf)
            np.maximum.at(top, text, logits)
            soft = np.exp(2 * (logits - top[text]))
            soft /= np.bincount(text, soft)[text]
            value = np.bincount(text, soft * logits) + model.bias
            wrong = (1 / (1 + np.exp(-np.clip(value, -30, 30))) - truth[batch]) / len(batch)
            passage = wrong[text] * soft
            by_weight = passage @ means
            by_word = np.zeros((len(used), WIDTH))
            token = np.repeat(passage / lengths, lengths)
            by_word = np.bincount(own, token, len(used))[:, None] * model.weights
            share_of = np.repeat(by_word / counts[:, None], counts, axis=0)
            touched, where = np.unique(subs, return_inverse=True)
            learns = known[touched][:, None]
            by_vector = np.stack([np.bincount(where, share_of[:, k], len(touched)) for k in range(WIDTH)], axis=1)
            squares[0][touched] += by_vector**2
            squares[1] += by_weight**2
            squares[2] += wrong.sum() ** 2
            model.vectors[touched] -= learns * (RATE * by_vector / np.sqrt(squares[0][touched]))
            model.weights -= RATE * by_weight / np.sqrt(squares[1])
            model.bias -= RATE * wrong.sum() / np.sqrt(squares[2])
    # The sample has its own share of label 1.
    model.bias += float(np.log(prior / (1 - prior)) - np.log(share / (1 - share))) if 0 < prior < 1 else 0.0
    return model


def training_sample(
    docs: DataFrame, labels: DataFrame, *, rows: int = ROWS, excerpt: int = EXCERPT, seed: int = 5
) -> tuple[list[str], list[int], float]:
    """Texts and labels of about ``rows`` hashed rows of each label, and the share of label 1 among all labelled rows.

    The chosen ids are as many as ``rows`` says, so they are broadcast and no text is shuffled. A text
    longer than ``excerpt`` characters is cut to those from a hashed place.
    """
    known = labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("toxic").cast("int").alias("toxic"))
    known = known.where("doc_id is not null and toxic in (0, 1)")
    counts = {r["toxic"]: r["n"] for r in known.groupBy("toxic").agg(F.count("*").alias("n")).collect()}
    draw = F.pmod(F.xxhash64("doc_id", F.lit(seed)), F.lit(1 << 30)) / float(1 << 30)
    share = F.when(F.col("toxic") == 1, rows / counts.get(1, 1)).otherwise(rows / counts.get(0, 1))
    chosen = F.broadcast(known.where(draw < share))
    room = F.greatest(F.length("text") - excerpt, F.lit(0)) + 1
    start = (F.pmod(F.xxhash64("doc_id", F.lit(seed + 1)), room) + 1).cast("int")
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).dropna()
    found = texts.join(chosen, "doc_id").select("doc_id", "toxic", F.substring("text", start, F.lit(excerpt)).alias("text"))
    picked = sorted(found.collect(), key=lambda r: (r["doc_id"], r["toxic"], r["text"]))
    total = sum(counts.values())
    return [r["text"] for r in picked], [r["toxic"] for r in picked], counts.get(1, 0) / total if total else 0.0


def held_out(key: str = "doc_id"):
    return F.coalesce(crc_share(key, 5) == 0, F.lit(False))


def fit(docs: DataFrame, labels: DataFrame, *, rows: int = ROWS) -> Model:
    """Train on a bounded sample of the labelled rows."""
    return train(*training_sample(docs, labels, rows=rows))


def with_toxicity(docs: DataFrame, model: Model, *, text: str = "text") -> DataFrame:
    """``docs`` with ``score``, the chance of label 1 for the whole text, and ``predicted``, 1 from 0.5 on.

    A null text, and one without a word, gets what the bias alone says. Columns of these names are
    replaced and no other column is looked at. Texts go through in slices.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)

    @F.arrow_udf("double")
    def score(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for texts in batches:
            parts = [shared.value.score(p.column(0)) for p in slices(pa.record_batch([texts], ["t"]), "t")]
            yield pa.array(np.concatenate(parts) if parts else [], pa.float64())

    scored = docs.drop("score", "predicted").withColumn("score", score(F.col(text).cast("string")))
    return scored.withColumn("predicted", (F.col("score") >= 0.5).cast("int"))
