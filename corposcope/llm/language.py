"""Language of documents by a linear-chain conditional random field over their words.

Every word is scored from hashed affixes and character n-grams and from its place in the lexicons
of the languages; learned transitions tie neighbouring words. Forward-backward gives each word's
chances, so a text that switches languages is labelled word by word, and the document's shares are their mean.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from .common import SLICE_BYTES, crc_share, mix64, owners, slices, split_words

UNKNOWN = "und"
# A text in which no language reaches this share of the words is not of a known language.
LEAST_SCORE = 0.35
# Nor is one most of whose words are strange: so many standard deviations below the usual spelling of any language.
STRANGE_WORD, MOST_STRANGE, SPARE_WORDS = -1.0, 0.5, 2
# Hashed runs of three characters, word ends included, that the spelling of a language is judged by.
GRAMS = 1 << 16
# Bounds of the training sample: rows of a language (expected), and characters of a row's excerpt.
ROWS = 250
EXCERPT = 2000
# Hashed features, longest affix, longest n-gram, documents that put a word into a lexicon.
FEATURES = 1 << 17
AFFIX, NGRAM, LEXICON_DOCS = 4, 3, 3
# Training: words of a run of one language in made-up switching texts, and of a sequence.
RUN, SEQUENCE = 12, 48
STEPS, RATE, DECAY = 60, 0.15, 1e-3
_EDGES = re.compile(r"^[\W\d_]+|[\W\d_]+$")


def bare(word: str) -> str:
    """A word in lower case without marks and digits at its ends; empty without a letter."""
    word = word.lower()
    if word.isalpha():
        return word
    inner = _EDGES.sub("", word)
    return inner if any(map(str.isalpha, inner)) else ""


def char_hashes(words: list[str], width: int) -> tuple[np.ndarray, np.ndarray, list[np.ndarray]]:
    """Starts and ends of the words in their joined characters, and the hash of the run of
    1 to ``width`` characters that begins at each character."""
    chars = np.frombuffer("".join(words).encode("utf-32-le"), np.uint32).astype(np.uint64)
    ends = np.cumsum([len(w) for w in words], dtype=np.int64) if words else np.zeros(0, np.int64)
    starts = np.concatenate([[0], ends[:-1]]).astype(np.int64) if words else ends
    hashes, padded = [], np.concatenate([chars, np.zeros(width, np.uint64)])
    run = np.zeros(len(chars), np.uint64)
    for k in range(width):
        run = run * np.uint64(0x100000001B3) + padded[k : k + len(chars)] + np.uint64(1)
        hashes.append(run)
    return starts, ends, hashes


def word_features(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Feature numbers of distinct words and the word that each belongs to."""
    starts, ends, hashes = char_hashes(words, max(AFFIX, NGRAM))
    sizes = ends - starts
    word_of = np.repeat(np.arange(len(words)), sizes)
    found, owner = [], []

    def add(kind: int, values: np.ndarray, of: np.ndarray) -> None:
        found.append((mix64(values + np.uint64(kind << 56)) & np.uint64(FEATURES - 1)).astype(np.int64))
        owner.append(of)

    for k in range(1, AFFIX + 1):
        long = np.flatnonzero(sizes >= k)
        add(k, hashes[k - 1][starts[long]], long)
        add(16 + k, hashes[k - 1][ends[long] - k], long)
    for k in range(2, NGRAM + 1):
        at = np.flatnonzero(np.arange(len(word_of)) + k <= ends[word_of])
        add(32 + k, hashes[k - 1][at], word_of[at])
    return np.concatenate(found), np.concatenate(owner)


def word_hash(words: list[str]) -> np.ndarray:
    """64 bits of each whole word."""
    starts, ends, (first,) = char_hashes(words, 1)
    power = np.uint64(0x9E3779B97F4A7C15)
    place = np.arange(len(first)) - np.repeat(starts, ends - starts)
    mixed = mix64(first + (place.astype(np.uint64) + np.uint64(1)) * power)
    total = np.concatenate([[np.uint64(0)], np.cumsum(mixed, dtype=np.uint64)])
    return mix64(total[ends] - total[starts])


def gram_counts(words: list[str], counts: np.ndarray) -> np.ndarray:
    """How often each hashed run of three characters occurs in distinct ``words`` that occur ``counts`` times."""
    codes, owner = spelled_grams(words)
    return np.bincount(codes, counts[owner], GRAMS)


def spelled_grams(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    starts, ends, hashes = char_hashes([f"^{w}$" for w in words], 3)
    of = np.repeat(np.arange(len(words)), ends - starts)
    at = np.flatnonzero(np.arange(len(of)) + 3 <= ends[of])
    return (mix64(hashes[2][at]) & np.uint64(GRAMS - 1)).astype(np.int64), of[at]


def spelling_scores(words: list[str], spelling: np.ndarray) -> np.ndarray:
    """The mean logarithm of the runs of each word, in each language."""
    codes, owner = spelled_grams(words)
    n = np.maximum(np.bincount(owner, minlength=len(words)), 1)
    return np.stack([np.bincount(owner, spelling[codes, k], len(words)) / n for k in range(spelling.shape[1])], axis=1)


def learn_spelling(texts: list[tuple[int, list[str]]], width: int) -> tuple[np.ndarray, np.ndarray]:
    """Logarithms of the runs of all ``texts`` (language, words); what is usual comes from words judged by the other half."""

    def logs(part: list[tuple[int, list[str]]]) -> np.ndarray:
        counts = np.zeros((GRAMS, width))
        for k in range(width):
            words, n = np.unique([w for lang, ws in part if lang == k for w in ws], return_counts=True)
            if len(words):
                counts[:, k] = gram_counts(words.tolist(), n)
        return np.log((counts + 0.05) / (counts.sum(axis=0) + 0.05 * GRAMS)).astype(np.float32)

    scores: list[list[np.ndarray]] = [[] for _ in range(width)]
    for half in (0, 1):
        learnt = logs([t for i, t in enumerate(texts) if i % 2 != half])
        for lang, words in texts[half::2]:
            if words:
                scores[lang].append(spelling_scores(words, learnt)[:, lang])
    usual = np.array([(np.mean(np.concatenate(x)), np.std(np.concatenate(x))) if x else (0.0, 1.0) for x in scores]).T
    return logs(texts), usual


@dataclass
class Model:
    """Weights of the field. ``lexicon`` has sorted word hashes and ``member`` the languages of each."""

    languages: list[str]
    weights: np.ndarray
    lexicon: np.ndarray
    member: np.ndarray
    lexicon_weights: np.ndarray
    transitions: np.ndarray
    # Logarithms of how often runs of characters occur in each language, and the mean and deviation that the
    # words of a language have by them.
    spelling: np.ndarray | None = None
    usual: np.ndarray | None = None

    def strange(self, words: list[str]) -> np.ndarray:
        """Words that are in no lexicon and spelled like none of the languages: unlike the chances, which add up to 1
        over the languages there are, this does not depend on how the languages compare with each other."""
        mean, deviation = self.usual
        likeness = ((spelling_scores(words, self.spelling) - mean) / np.maximum(deviation, 1e-6)).max(axis=1)
        return (likeness < STRANGE_WORD) & (self.membership(words)[:, -1] > 0)

    def membership(self, words: list[str]) -> np.ndarray:
        """1 for each lexicon that has the word, and a last column that is 1 for a word in none."""
        out = np.zeros((len(words), len(self.languages) + 1), np.float32)
        if len(self.lexicon):
            hashes = word_hash(words)
            at = np.minimum(np.searchsorted(self.lexicon, hashes), len(self.lexicon) - 1)
            hit = self.lexicon[at] == hashes
            out[hit, :-1] = self.member[at[hit]]
        out[:, -1] = ~out.any(axis=1)
        return out

    def emissions(self, words: list[str]) -> np.ndarray:
        features, owner = word_features(words)
        scores = self.membership(words) @ self.lexicon_weights
        for k in range(len(self.languages)):
            scores[:, k] += np.bincount(owner, self.weights[features, k], len(words))
        return scores

    def marginals(self, words: list[str], codes: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """Chances of the languages for each position, texts of any lengths side by side: the longest
        first, so that at every step those still running are the first rows."""
        scores = self.emissions(words)
        local = np.exp(scores - scores.max(axis=1, keepdims=True)).astype(np.float32)[codes]
        step = np.exp(self.transitions - self.transitions.max()).astype(np.float32)
        sizes = np.diff(ends)
        order = np.argsort(-sizes, kind="stable")
        first, sizes = ends[:-1][order], sizes[order]
        running = len(sizes) - np.searchsorted(sizes[::-1], np.arange(1, sizes.max(initial=0) + 1))
        forward = np.empty_like(local)
        now = None
        for t, n in enumerate(running):
            at = first[:n] + t
            now = local[at] if now is None else (now[:n] @ step) * local[at]
            now /= now.sum(axis=1, keepdims=True)
            forward[at] = now
        back = np.ones((0, local.shape[1]), np.float32)
        for t in range(len(running) - 1, -1, -1):
            n = running[t]
            if len(back) < n:
                back = np.vstack([back, np.ones((n - len(back), local.shape[1]), np.float32)])
            at = first[:n] + t
            both = forward[at] * back
            forward[at] = both / both.sum(axis=1, keepdims=True)
            back = (back * local[at]) @ step.T
            back /= back.sum(axis=1, keepdims=True)
        return forward


def train(samples: list[tuple[str, str]], *, seed: int = 7) -> Model:
    """A model from ``(language, text)`` pairs. The chains are made-up switching texts: runs of words
    of one language after another, so that the transitions are learned and not assumed."""
    languages = sorted({lang for lang, _ in samples})
    number = {lang: i for i, lang in enumerate(languages)}
    streams: list[list[str]] = [[] for _ in languages]
    seen: dict[str, np.ndarray] = {}
    texts = []
    for lang, text in samples:
        words = [w for w in map(bare, text.split()) if w]
        texts.append((number[lang], words))
        streams[number[lang]] += words
        for w in set(words):
            seen.setdefault(w, np.zeros(len(languages), np.int64))[number[lang]] += 1
    streams_of = [i for i, s in enumerate(streams) if s]
    known = sorted(w for w, n in seen.items() if n.max() >= LEXICON_DOCS)
    hashes = word_hash(known)
    order = np.argsort(hashes)
    member = np.array([seen[w] >= LEXICON_DOCS for w in known], bool).reshape(len(known), len(languages))[order]
    width = len(languages)
    model = Model(
        languages, np.zeros((FEATURES, width), np.float32), hashes[order], member,
        np.zeros((width + 1, width), np.float32), np.zeros((width, width), np.float32), *learn_spelling(texts, width),
    )
    if not streams_of:
        return model

    rng = np.random.default_rng(seed)
    total = sum(map(len, streams))
    chain, labels, at = [], [], [0] * width
    while len(chain) < total:
        k = streams_of[rng.integers(len(streams_of))]
        size = 3 + int(rng.geometric(1 / RUN))
        run = streams[k][at[k] : at[k] + size]
        at[k] = at[k] + size if at[k] + size < len(streams[k]) else 0
        chain += run
        labels += [k] * len(run)
    distinct = sorted(set(chain))
    index = {w: i for i, w in enumerate(distinct)}
    rows = -(-len(chain) // SEQUENCE)
    codes = np.resize(np.array([index[w] for w in chain]), (rows, SEQUENCE))
    truth = np.resize(np.array(labels), (rows, SEQUENCE))
    features, owner = word_features(distinct)
    lexical = model.membership(distinct)
    counted = np.zeros((width, width))
    np.add.at(counted, (truth[:, :-1].ravel(), truth[:, 1:].ravel()), 1)

    parts = [model.weights, model.lexicon_weights, model.transitions]
    moments = [(np.zeros_like(p), np.zeros_like(p)) for p in parts]
    hot = np.eye(width, dtype=np.float32)[truth]
    for it in range(1, STEPS + 1):
        scores = lexical @ model.lexicon_weights
        for k in range(width):
            scores[:, k] += np.bincount(owner, model.weights[features, k], len(distinct))
        chances, pairs = _chain_marginals(scores[codes], model.transitions)
        wrong = (chances - hot).reshape(-1, width) / codes.size
        of_word = np.stack([np.bincount(codes.ravel(), wrong[:, k], len(distinct)) for k in range(width)], axis=1)
        by_feature = np.stack([np.bincount(features, of_word[owner, k], FEATURES) for k in range(width)], axis=1)
        gradients = [by_feature, lexical.T @ of_word, (pairs - counted) / codes.size]
        for p, g, (m, v) in zip(parts, gradients, moments):
            g = g + DECAY / codes.size * p
            m += 0.1 * (g - m)
            v += 0.01 * (g * g - v)
            p -= (RATE * (m / (1 - 0.9**it)) / (np.sqrt(v / (1 - 0.99**it)) + 1e-8)).astype(np.float32)
    return model


def _chain_marginals(scores: np.ndarray, transitions: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Forward-backward over chains of one length: chances per position, expected transitions."""
    local = np.exp(scores - scores.max(axis=2, keepdims=True))
    step = np.exp(transitions - transitions.max())
    rows, steps, width = local.shape
    forward, back = np.empty_like(local), np.ones_like(local)
    now = np.ones((rows, width))
    for t in range(steps):
        now = (now @ step if t else now) * local[:, t]
        now = now / now.sum(axis=1, keepdims=True)
        forward[:, t] = now
    pairs = np.zeros((width, width))
    for t in range(steps - 2, -1, -1):
        after = local[:, t + 1] * back[:, t + 1]
        back[:, t] = after @ step.T
        back[:, t] /= back[:, t].sum(axis=1, keepdims=True)
        joint = forward[:, t, :, None] * step[None] * after[:, None, :]
        pairs += (joint / joint.sum(axis=(1, 2), keepdims=True)).sum(axis=0)
    both = forward * back
    return both / both.sum(axis=2, keepdims=True), pairs


def training_sample(labelled: DataFrame, *, rows: int = ROWS, excerpt: int = EXCERPT, seed: int = 7) -> list[tuple[str, str]]:
    """About ``rows`` hashed rows of each language and ``excerpt`` characters of each, from a hashed place."""
    counts = {r["lang"]: r["n"] for r in labelled.groupBy("lang").agg(F.count("*").alias("n")).collect()}
    if not counts:
        return []
    draw = F.pmod(F.xxhash64("doc_id", F.lit(seed)), F.lit(1 << 30)) / float(1 << 30)
    share = F.create_map(*[F.lit(x) for lang, n in counts.items() for x in (lang, rows / n)])
    room = F.greatest(F.length("text") - excerpt, F.lit(0)) + 1
    start = (F.pmod(F.xxhash64("doc_id", F.lit(seed + 1)), room) + 1).cast("int")
    picked = labelled.where(draw < share[F.col("lang")]).select("doc_id", "lang", F.substring("text", start, F.lit(excerpt)).alias("text"))
    return [(r["lang"], r["text"]) for r in sorted(picked.collect(), key=lambda r: (r["doc_id"], r["lang"], r["text"]))]


def fit(docs: DataFrame, *, rows: int = ROWS) -> Model:
    """Train on a bounded sample of the rows of ``docs`` that have text, a language and an id."""
    columns = docs.select("doc_id", F.col("text").cast("string").alias("text"), F.col("lang").cast("string").alias("lang"))
    return train(training_sample(columns.dropna(), rows=rows))


def with_language(docs: DataFrame, model: Model, *, text: str = "text", strange: bool = False) -> DataFrame:
    """``docs`` with ``lang_pred`` and ``score``, the language with the largest mean chance over the
    words of the whole text, and that mean.

    A null text, one without a letter, and every text under a model of no language get ``und`` and
    0. Ties go to the language that sorts first. Columns of these names are replaced; no other column is
    looked at. Words go through in slices, so memory follows the longest text, not the batch. With ``strange`` there is
    a column of this name, the share of words, but for the first ``SPARE_WORDS`` of them, that are spelled like no language.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)

    @F.arrow_udf("struct<lang: string, score: double, strange: double>")
    def label(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        model = shared.value
        for texts in batches:
            parts = [_labels(part.column(0), model, strange) for part in slices(pa.record_batch([texts], ["t"]), "t", SLICE_BYTES // 2)]
            langs = [x for part in parts for x in part[0]]
            scores, usual = (np.concatenate([part[k] for part in parts]) if parts else np.zeros(0) for k in (1, 2))
            yield pa.StructArray.from_arrays([pa.array(langs, pa.string()), pa.array(scores), pa.array(usual)], ["lang", "score", "strange"])

    found = docs.drop("lang_pred", "score", "_found").withColumn("_found", label(F.col(text).cast("string")))
    if strange:
        found = found.withColumn("strange", F.col("_found.strange"))
    return found.withColumn("lang_pred", F.col("_found.lang")).withColumn("score", F.col("_found.score")).drop("_found")


def _labels(texts: pa.Array, model: Model, strange: bool = False) -> tuple[list[str], np.ndarray, np.ndarray]:
    rows = len(texts)
    distinct, codes, ends = split_words(texts)
    forms = [bare(w) for w in distinct.to_pylist()]
    words = sorted({w for w in forms if w})
    if not words or not model.languages:
        return [UNKNOWN] * rows, np.zeros(rows), np.zeros(rows)
    number = {w: i for i, w in enumerate(words)}
    codes = np.array([number.get(w, -1) for w in forms])[codes]
    row = owners(ends)[codes >= 0]
    codes = codes[codes >= 0]
    sizes = np.bincount(row, minlength=rows)
    chances = model.marginals(words, codes, np.concatenate([[0], np.cumsum(sizes)]))
    means = np.stack([np.bincount(row, chances[:, k], rows) for k in range(len(model.languages))], axis=1)
    means /= np.maximum(sizes, 1)[:, None]
    best = means.argmax(axis=1)
    langs = [model.languages[k] if n else UNKNOWN for k, n in zip(best, sizes)]
    odd = np.zeros(rows)
    if strange:
        odd = np.maximum(np.bincount(row, model.strange(words)[codes], rows) - SPARE_WORDS, 0) / np.maximum(sizes, 1)
    return langs, np.where(sizes > 0, np.clip(means[np.arange(rows), best], 0, 1), 0.0), odd


def keep_identified(docs: DataFrame, *, least: float = LEAST_SCORE, strange: float = MOST_STRANGE) -> DataFrame:
    """The rows of ``docs`` whose text has a language with a score of ``least`` or more and is spelled like known ones.

    A text without a letter goes, and so does one in which more than a share of ``strange`` of the words is in no lexicon
    and spelled like no language; ``SPARE_WORDS`` are not counted, so the shortest texts stay. Repeated rows share
    their fate, null ids and other columns are kept as they are, an empty table stays empty. Without a
    row that has text, language and id there is no known language and everything goes.
    """
    model = fit(docs.where(~held_out()))
    found = with_language(docs.withColumnsRenamed({c: f"_in_{c}" for c in docs.columns}), model, text="_in_text", strange=True)
    kept = found.where((F.col("lang_pred") != UNKNOWN) & (F.col("score") >= least) & (F.col("strange") <= strange))
    return kept.select(*[F.col(f"_in_{c}").alias(c) for c in docs.columns])


def held_out(key: str = "doc_id"):
    return F.coalesce(crc_share(key, 4) == 2, F.lit(False))
