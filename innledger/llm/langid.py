"""Language identification by a linear-chain conditional random field over the words of a text.

Each word is labelled with a language. A run of more than WORD_LETTERS letters, as in scripts without spaces, is cut into
consecutive words of at most so many, in training and in prediction, so that every letter is read. Emissions come from its affixes, its letter n-grams and lexicons of frequent words,
hashed to FEATURES weights a language; transitions are learnt with them, from training sequences in which stretches of
different languages follow one another, so that labels change within code-switched text and not with every odd word.
Forward-backward gives each word's distribution over languages; a document's language is the one with the greatest mean, and
that mean its score.

The model is fitted on the driver from a bounded sample of labelled rows: about SAMPLE_DOCS documents a language, chosen by
a hash of id and text, of at most LANGUAGES languages, and SAMPLE_WORDS consecutive words of each. Prediction covers whole texts: all words of a run of texts
make one chain that restarts with every text. It is cut into blocks whose matrix products are computed side by side and
joined up after, so one very long text costs no more than many short ones.

Documents whose crc32(doc_id as text) leaves no remainder by 5 are held out and never learnt from. Null labels are not
learnt from. Null texts and texts without a letter are `und` with score 0. Repeated rows give repeated rows; a null id is not
held out and not learnt from. If there is nothing to learn from, every text is `und`. An empty table gives no rows. Further
columns are not read.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from innledger.llm.words import slices

UNKNOWN = "und"
SAMPLE_DOCS, SAMPLE_WORDS = 500, 120
#: Most languages that are learnt, those with the most labelled rows, by name among equals.
LANGUAGES = 200
FEATURES = 1 << 16
#: Frequent words of a language in its lexicon; words of a training sequence; mean words between two languages in it.
LEXICON, SEQUENCE, STRETCH = 2000, 64, 24
ROUNDS, RATE, DECAY = 60, 0.3, 1e-4
#: Words a worker keeps the emissions of; words of a block of the chain.
CACHE_WORDS, BLOCK = 400_000, 128
#: Bytes of text labelled at a time; the products of a run take some 200 bytes for each of them.
RUN_BYTES = 1 << 19
WORD_LETTERS = 40
WORD = re.compile(rf"[^\W\d_]{{1,{WORD_LETTERS}}}")


def words_of(text: str) -> list[str]:
    """Lower-cased runs of letters, long ones in pieces; none if the text has no letter."""
    words = WORD.findall(text.lower())
    if words and not words[0][0].isalpha() and not any(map(str.isalpha, "".join(words))):
        return []
    return words


def features(word: str, lexicon: dict[str, int]) -> list[int]:
    """Numbers of the weights of a word."""
    w = f"<{word}>"
    names = [w[:2], w[:3], w[:4], w[-2:] + "$", w[-3:] + "$", w[-4:] + "$"]
    names += [w[i : i + 2] for i in range(1, len(w) - 2)]
    names += [w[i : i + 3] for i in range(len(w) - 2)]
    found = [zlib.crc32(n.encode()) % FEATURES for n in names]
    marks = lexicon.get(word, 0)
    i = 0
    while marks:
        if marks & 1:
            found.append(zlib.crc32(b"lexicon %d" % i) % FEATURES)
        marks >>= 1
        i += 1
    return found


def chain(emissions: np.ndarray, restart: np.ndarray, step: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Forward messages of a chain of words, each scaled to sum one.

    message[t] = (message[t-1] @ step) * emissions[t], or first * emissions[t] where the chain restarts.
    """
    n, k = emissions.shape
    blocks = -(-n // BLOCK)
    padded = np.ones((blocks * BLOCK, k))
    padded[:n] = emissions
    starts = np.zeros(blocks * BLOCK, bool)
    starts[:n] = restart
    padded, starts = padded.reshape(blocks, BLOCK, k), starts.reshape(blocks, BLOCK)
    products = np.empty((BLOCK, blocks, k, k))
    now = np.broadcast_to(np.eye(k), (blocks, k, k))
    for t in range(BLOCK):
        following = (now.reshape(-1, k) @ step).reshape(blocks, k, k)
        again = starts[:, t]
        if again.any():
            following[again] = now[again].sum(2, keepdims=True) * first
        following *= padded[:, t, None, :]
        following /= following.sum((1, 2), keepdims=True)
        products[t] = now = following
    entering = np.empty((blocks, k))
    message = first / first.sum()
    for b in range(blocks):
        entering[b] = message
        message = message @ products[-1, b]
        message = message / message.sum()
    messages = np.einsum("bi,tbij->btj", entering, products).reshape(-1, k)[:n]
    return messages / messages.sum(1, keepdims=True)


def posteriors(emissions: np.ndarray, first_word: np.ndarray, step: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Distribution over languages of each word, by forward-backward; `first_word` marks where a text begins."""
    if not len(emissions):
        return emissions
    forward = chain(emissions, first_word, step, first)
    last_word = np.append(first_word[1:], True)
    backward = chain(emissions[::-1], last_word[::-1], step.T.copy(), np.ones(len(first)))[::-1]
    both = forward * backward / emissions
    return both / both.sum(1, keepdims=True)


@dataclass
class Model:
    languages: list[str]
    weights: np.ndarray
    step: np.ndarray
    first: np.ndarray
    lexicon: dict[str, int]

    def emissions(self, words: list[str]) -> np.ndarray:
        found = [features(w, self.lexicon) for w in words]
        sizes = np.fromiter(map(len, found), np.int64, len(found))
        flat = np.fromiter((f for fs in found for f in fs), np.int64, int(sizes.sum()))
        scores = np.add.reduceat(self.weights[flat], np.cumsum(sizes) - sizes) if len(found) else np.zeros((0, len(self.languages)))
        scores -= scores.max(1, keepdims=True)
        return np.exp(np.maximum(scores, -30.0))


def sequences(samples: list[tuple[str, list[str]]], languages: list[str], seed: int = 1) -> tuple[list[str], np.ndarray, np.ndarray]:
    """Distinct words, and training sequences of them with the label of each word: stretches of the samples in turn."""
    rng = np.random.Generator(np.random.PCG64(seed))
    stretches = []
    for lang, words in samples:
        at = 0
        while at < len(words):
            n = int(rng.geometric(1 / STRETCH))
            stretches.append((languages.index(lang), words[at : at + n]))
            at += n
    # Some stretches stay beside their neighbours, so that long texts of one language are seen as well.
    order = np.argsort(np.arange(len(stretches)) + rng.integers(0, 2, len(stretches)) * rng.random(len(stretches)) * len(stretches))
    place: dict[str, int] = {}
    words, labels = [], []
    for i in order:
        label, stretch = stretches[i]
        words += [place.setdefault(w, len(place)) for w in stretch]
        labels += [label] * len(stretch)
    n = len(words) // SEQUENCE * SEQUENCE
    if not n:
        n, pad = SEQUENCE, SEQUENCE - len(words)
        words, labels = (words * SEQUENCE)[:n], (labels * SEQUENCE)[:n]
    return list(place), np.array(words[:n]).reshape(-1, SEQUENCE), np.array(labels[:n]).reshape(-1, SEQUENCE)


def fit(samples: list[tuple[str, list[str]]]) -> Model:
    """The weights that maximise the conditional likelihood of the labels of the training sequences."""
    languages = sorted({lang for lang, words in samples if words})
    k = len(languages)
    if not k:
        return Model([], np.zeros((FEATURES, 0)), np.zeros((0, 0)), np.zeros(0), {})
    lexicon: dict[str, int] = {}
    for i, lang in enumerate(languages):
        uses = Counter(w for own, words in samples if own == lang for w in words)
        for word, n in uses.most_common(LEXICON):
            if n > 1:
                lexicon[word] = lexicon.get(word, 0) | 1 << i
    model = Model(languages, np.zeros((FEATURES, k)), np.full((k, k), 1 / k), np.full(k, 1 / k), lexicon)
    if k < 2:
        return model
    words, place, label = sequences([s for s in samples if s[1]], languages)
    found = [features(w, lexicon) for w in words]
    sizes = np.fromiter(map(len, found), np.int64, len(found))
    flat = np.fromiter((f for fs in found for f in fs), np.int64, int(sizes.sum()))
    owner = np.repeat(np.arange(len(words)), sizes)
    starts = np.cumsum(sizes) - sizes
    truth = np.eye(k)[label]
    pairs = np.einsum("sti,stj->ij", truth[:, :-1], truth[:, 1:])
    theta = [np.zeros((FEATURES, k)), np.zeros((k, k))]
    moments = [[np.zeros_like(t), np.zeros_like(t)] for t in theta]
    total = label.size
    for round_no in range(1, ROUNDS + 1):
        scores = np.add.reduceat(theta[0][flat], starts)[place]
        e = np.exp(np.maximum(scores - scores.max(2, keepdims=True), -30.0))
        step = np.exp(theta[1])
        alpha, beta = np.empty_like(e), np.empty_like(e)
        alpha[:, 0], beta[:, -1] = e[:, 0], 1.0
        for t in range(1, SEQUENCE):
            alpha[:, t - 1] /= alpha[:, t - 1].sum(1, keepdims=True)
            alpha[:, t] = alpha[:, t - 1] @ step * e[:, t]
            back = (beta[:, -t] * e[:, -t]) @ step.T
            beta[:, -t - 1] = back / back.sum(1, keepdims=True)
        gamma = alpha * beta
        gamma /= gamma.sum(2, keepdims=True)
        joint = alpha[:, :-1, :, None] * step * (e[:, 1:] * beta[:, 1:])[:, :, None, :]
        joint /= joint.sum((2, 3), keepdims=True)
        by_word = np.zeros((len(words), k))
        np.add.at(by_word, place, truth - gamma)
        grad = np.stack([np.bincount(flat, by_word[owner, j], FEATURES) for j in range(k)], 1)
        grads = [grad / total - DECAY * theta[0], (pairs - joint.sum((0, 1))) / total - DECAY * theta[1]]
        for t, g, (m, v) in zip(theta, grads, moments, strict=True):
            m += 0.1 * (g - m)
            v += 0.01 * (g * g - v)
            t += RATE * (m / (1 - 0.9**round_no)) / (np.sqrt(v / (1 - 0.99**round_no)) + 1e-8)
    model.weights = theta[0]
    model.step = np.exp(theta[1]) / np.exp(theta[1]).sum()
    return model


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 5 == 0, F.lit(False))


def train(documents: DataFrame) -> Model:
    """A model of the labelled rows that are not held out; about SAMPLE_DOCS x SAMPLE_WORDS words a language reach the driver."""
    rows = documents.select("doc_id", "text", "lang").where(
        F.col("lang").isNotNull() & F.col("text").isNotNull() & F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id"))
    )
    sizes = rows.groupBy("lang").agg(F.count("*").alias("n")).orderBy(F.desc("n"), "lang").limit(LANGUAGES)
    counts = {r["lang"]: r["n"] for r in sizes.collect()}
    if not counts:
        return fit([])
    every = F.create_map(*[F.lit(x) for lang, n in counts.items() for x in (lang, max(1, n // SAMPLE_DOCS))])
    chosen = rows.where(F.pmod(F.xxhash64(F.lit("sample"), "doc_id", "text"), every[F.col("lang")]) == 0)

    def stretches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            found = []
            for doc, text in zip(batch["doc_id"].to_pylist(), batch["text"].to_pylist(), strict=True):
                words = words_of(text)
                at = zlib.crc32(str(doc).encode()) % max(1, len(words) - SAMPLE_WORDS + 1)
                found.append(" ".join(words[at : at + SAMPLE_WORDS]))
            yield pa.RecordBatch.from_pydict({"doc_id": batch["doc_id"], "lang": batch["lang"], "words": found})

    # Copies of a row are chosen together and teach nothing more.
    found = chosen.mapInArrow(stretches, "doc_id long, lang string, words string").distinct().collect()
    order = lambda r: (r.lang, zlib.crc32(str(r.doc_id).encode()), r.doc_id, r.words)
    return fit([(r.lang, r.words.split()) for r in sorted(found, key=order)])


class Labeller:
    """A worker's model with the emissions of the words it has seen."""

    def __init__(self, model: Model):
        self.model = model
        self.clear()

    def clear(self) -> None:
        self.place: dict[str, int] = {}
        self.known = np.zeros((0, len(self.model.languages)))

    def label(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
        """Distribution of every word, text by text, and the number of words of each text."""
        if not self.model.languages:
            return np.zeros((0, 0)), np.zeros(len(texts), np.int64)
        if len(self.place) > CACHE_WORDS:
            self.clear()
        place = self.place
        counts = np.zeros(len(texts), np.int64)
        places: list[int] = []
        new: list[str] = []
        for i, text in enumerate(texts):
            words = words_of(text) if text else ()
            counts[i] = len(words)
            for w in words:
                at = place.get(w)
                if at is None:
                    at = place[w] = len(place)
                    new.append(w)
                places.append(at)
        if new:
            self.known = np.concatenate((self.known, self.model.emissions(new)))
        first = np.zeros(len(places), bool)
        first[(np.cumsum(counts) - counts)[counts > 0]] = True
        return posteriors(self.known[np.array(places, np.int64)], first, self.model.step, self.model.first), counts


def predict(documents: DataFrame, model: Model) -> DataFrame:
    """doc_id, held_out, lang_pred and score, and `spans`: runs of words with one label (first word, words, language)."""
    sent = documents.sparkSession.sparkContext.broadcast(model)
    schema = "doc_id long, lang_pred string, score double, spans array<struct<first:int,words:int,lang:string>>"

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        labeller = Labeller(sent.value)
        names = np.array([*sent.value.languages, UNKNOWN], object)
        for batch in slices(batches, size=RUN_BYTES):
            marginals, counts = labeller.label(batch["text"].to_pylist())
            n = len(counts)
            some = np.flatnonzero(counts) if len(names) > 1 else np.zeros(0, np.int64)
            best, score = np.full(n, len(names) - 1), np.zeros(n)
            lists = pa.array([0] * (n + 1), pa.int32())
            first = width = label = np.zeros(0, np.int64)
            if len(some):
                starts = (np.cumsum(counts) - counts)[some]
                means = np.add.reduceat(marginals, starts) / counts[some, None]
                best[some], score[some] = means.argmax(1), np.minimum(means.max(1), 1.0)
                own = marginals.argmax(1)
                text_of = np.repeat(np.arange(n), counts)
                at = np.flatnonzero(np.append(True, (np.diff(own) != 0) | (np.diff(text_of) != 0)))
                width, label = np.diff(np.append(at, len(own))), own[at]
                first = at - (np.cumsum(counts) - counts)[text_of[at]]
                lists = pa.array(np.append(0, np.cumsum(np.bincount(text_of[at], minlength=n))), pa.int32())
            spans = pa.StructArray.from_arrays(
                [pa.array(first, pa.int32()), pa.array(width, pa.int32()), pa.array(names[label], pa.string())],
                ["first", "words", "lang"],
            )
            yield pa.RecordBatch.from_pydict(
                {
                    "doc_id": batch["doc_id"],
                    "lang_pred": pa.array(names[best], pa.string()),
                    "score": score,
                    "spans": pa.ListArray.from_arrays(lists, spans),
                }
            )

    found = documents.select("doc_id", "text").mapInArrow(rows, schema)
    return found.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score", "spans")
