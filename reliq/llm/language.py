"""Language identification by a small convolutional network over bytes.

A text is cut into windows of fixed length. Filters of several widths run over the bytes of a
window, each keeps its largest answer, and a softmax layer turns these into languages. The
network is trained in numpy on windows of a bounded sample of labelled documents; a text gets
the mean of what its windows say.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from reliq.llm.arrow import pieces, texts_of
from reliq.llm.sharing import ship_package
from reliq.llm.text import whole_text

WINDOW = 256
WIDTHS = (2, 3, 4)
FILTERS = 12
EMBEDDING = 8
#: The sample that is trained on: about so many documents of each language, and windows of each.
SAMPLE_DOCUMENTS = 400
SAMPLE_WINDOWS = 8
STEPS, BATCH, RATE = 500, 128, 0.01
#: Windows judged at once.
AT_ONCE = 2048
LETTER = regex.compile(r"\p{L}")
UNDETERMINED = "und"


def held_out(doc_id: Column) -> Column:
    """Whether a document is kept from training; one without an id is not."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit(""))) % 4 == 2


def windows_of(raw: bytes) -> np.ndarray:
    """The bytes in rows of ``WINDOW``, the last one filled up with zeros."""
    rows = max(1, -(-len(raw) // WINDOW))
    whole = np.zeros(rows * WINDOW, np.uint8)
    whole[: len(raw)] = np.frombuffer(raw, np.uint8)
    return whole.reshape(rows, WINDOW)


@dataclass
class Network:
    """Byte vectors, one filter bank per width, and the softmax layer."""

    languages: list[str]
    vectors: np.ndarray
    banks: list[np.ndarray]
    biases: list[np.ndarray]
    weights: np.ndarray
    shift: np.ndarray

    @classmethod
    def fresh(cls, languages: list[str], seed: int = 7) -> Network:
        rng = np.random.default_rng(seed)
        draw = lambda *shape: rng.normal(0, 0.3, shape).astype(np.float32)
        banks = [draw(width, EMBEDDING, FILTERS) for width in WIDTHS]
        zeros = [np.zeros(FILTERS, np.float32) for _ in WIDTHS]
        top = draw(FILTERS * len(WIDTHS), len(languages))
        return cls(languages, draw(256, EMBEDDING), banks, zeros, top, np.zeros(len(languages), np.float32))

    def parameters(self) -> list[np.ndarray]:
        return [self.vectors, *self.banks, *self.biases, self.weights, self.shift]

    def gradients(self, x: np.ndarray, y: np.ndarray) -> list[np.ndarray]:
        """Gradients of the mean log loss of windows ``x`` (rows) with language numbers ``y``."""
        steps = x.T
        embedded = self.vectors[steps]
        n = np.arange(len(x))
        pooled, places = [], []
        for bank, bias in zip(self.banks, self.biases):
            length = WINDOW - len(bank) + 1
            answers = sum(embedded[j : length + j] @ bank[j] for j in range(len(bank))) + bias
            best = answers.argmax(0)
            places.append(best)
            pooled.append(np.maximum(np.take_along_axis(answers, best[None], 0)[0], 0))
        features = np.concatenate(pooled, 1)
        scores = features @ self.weights + self.shift
        scores = np.exp(scores - scores.max(1, keepdims=True))
        error = scores / scores.sum(1, keepdims=True)
        error[n, y] -= 1
        error /= len(x)
        back = (error @ self.weights.T) * (features > 0)
        vectors, banks, biases = np.zeros_like(self.vectors), [], []
        for k, (bank, best) in enumerate(zip(self.banks, places)):
            flow = back[:, k * FILTERS : (k + 1) * FILTERS]
            change = np.zeros_like(bank)
            for j in range(len(bank)):
                here = embedded[best + j, n[:, None]]
                change[j] = np.einsum("nfe,nf->ef", here, flow)
                np.add.at(vectors, steps[best + j, n[:, None]], flow[:, :, None] * bank[j].T[None])
            banks.append(change)
            biases.append(flow.sum(0))
        return [vectors, *banks, *biases, features.T @ error, error.sum(0)]

    def train(self, x: np.ndarray, y: np.ndarray, steps: int = STEPS, seed: int = 11) -> Network:
        """Adam over random batches in which every language is equally likely."""
        rng = np.random.default_rng(seed)
        by_language = [np.flatnonzero(y == k) for k in range(len(self.languages))]
        first, second = ([np.zeros_like(p) for p in self.parameters()] for _ in range(2))
        for step in range(1, steps + 1):
            kinds = rng.integers(0, len(self.languages), BATCH)
            chosen = np.array([rng.choice(by_language[k]) for k in kinds])
            batch = x[chosen].copy()
            # Some windows are cut short, as the last ones of texts are.
            for row in np.flatnonzero(rng.random(BATCH) < 0.3):
                batch[row, rng.integers(16, WINDOW) :] = 0
            rate = RATE * min(1.0, 2 * (1 - step / (steps + 1)))
            for p, g, m, v in zip(self.parameters(), self.gradients(batch, y[chosen]), first, second):
                m += 0.1 * (g - m)
                v += 0.01 * (g * g - v)
                p -= rate * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.99**step)) + 1e-6)
        return self

    def tables(self) -> list[list[np.ndarray]]:
        """Each bank as sums over pairs of bytes (and a last single one): one look-up for two bytes."""
        found = []
        for bank in self.banks:
            single = [(self.vectors @ part).astype(np.float32) for part in bank]
            pairs = [(a[:, None] + b[None]).reshape(-1, FILTERS) for a, b in zip(single[::2], single[1::2])]
            found.append(pairs + single[len(pairs) * 2 :])
        return found

    def judge(self, x: np.ndarray, tables: list[list[np.ndarray]]) -> np.ndarray:
        """Scores (before the softmax) of windows, ``AT_ONCE`` together."""
        results = []
        for start in range(0, len(x), AT_ONCE):
            steps = np.ascontiguousarray(x[start : start + AT_ONCE].T)
            pairs = steps[:-1].astype(np.intp) * 256 + steps[1:]
            size = steps.shape[1]
            answer, part = np.empty((size, FILTERS), np.float32), np.empty((size, FILTERS), np.float32)
            features = []
            for width, bank, bias in zip(WIDTHS, tables, self.biases):
                best = np.full((size, FILTERS), -np.inf, np.float32)
                for t in range(WINDOW - width + 1):
                    np.take(bank[0], pairs[t], axis=0, out=answer, mode="clip")
                    if width > 2:
                        rest = pairs[t + 2] if width == 4 else steps[t + 2]
                        np.take(bank[1], rest, axis=0, out=part, mode="clip")
                        answer += part
                    np.maximum(best, answer, out=best)
                features.append(np.maximum(best + bias, 0))
            results.append(np.concatenate(features, 1) @ self.weights + self.shift)
        return np.concatenate(results)


def sample_windows(docs: DataFrame, most: int = SAMPLE_DOCUMENTS) -> tuple[np.ndarray, np.ndarray, list[str]]:
    """Windows of about ``most`` training documents of each language: bytes, numbers, languages.

    Documents are chosen by a hash, windows are spread evenly over the whole text, at most
    ``SAMPLE_WINDOWS`` of each: what reaches the driver does not grow with the corpus.
    """
    ship_package(docs.sparkSession)
    text = whole_text(docs)
    known = docs.filter(~held_out(docs["doc_id"]) & docs["lang"].isNotNull() & (text != "")).select(
        docs["doc_id"].alias("doc_id"), docs["lang"].cast("string").alias("lang"), text.alias("text")
    )
    counts = known.groupBy("lang").agg(F.count("*").alias("n"))
    draw = F.pmod(F.xxhash64("doc_id", "text"), F.lit(1 << 30))
    chosen = known.join(F.broadcast(counts) if counts.count() < 10_000 else counts, "lang").filter(
        draw.cast("double") * F.col("n") < float(most << 30)
    )

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece in pieces(batches):
            langs, rows = [], []
            for lang, text in zip(piece.column("lang").to_pylist(), texts_of(piece)):
                if LETTER.search(text):
                    whole = windows_of(text.encode())
                    for k in np.unique(np.linspace(0, len(whole) - 1, SAMPLE_WINDOWS).astype(int)):
                        langs.append(lang)
                        rows.append(whole[k].tobytes())
            yield pa.RecordBatch.from_arrays([pa.array(langs, pa.string()), pa.array(rows, pa.binary())], ["lang", "bytes"])

    # The order of rows must not change what is learned.
    found = sorted(map(tuple, chosen.select("lang", "text").mapInArrow(cut, "lang string, bytes binary").collect()))
    languages = sorted({lang for lang, _ in found})
    number = {lang: k for k, lang in enumerate(languages)}
    x = np.frombuffer(b"".join(bytes(raw) for _, raw in found), np.uint8).reshape(-1, WINDOW)
    return x, np.array([number[lang] for lang, _ in found], np.int64), languages


def train(docs: DataFrame) -> Network | None:
    """A network of the languages of the training documents; None where there are none."""
    x, y, languages = sample_windows(docs)
    return Network.fresh(languages).train(x, y) if languages else None


def identify(docs: DataFrame, network: Network | None) -> DataFrame:
    """``row`` (the columns of ``docs`` but ``text``), ``lang_pred`` and ``score`` of every row.

    All windows of the whole text count equally but for their length. A null text or one
    without letters is ``und`` with score 0, as is every text where nothing was learned.
    """
    spark = ship_package(docs.sparkSession)
    shared = spark.sparkContext.broadcast(network)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        tables = model.tables() if model else []
        for piece in pieces(batches):
            texts = texts_of(piece)
            names, scores = [UNDETERMINED] * len(texts), [0.0] * len(texts)
            told = [i for i, text in enumerate(texts) if model and LETTER.search(text)]
            if told:
                raw = [texts[i].encode() for i in told]
                cut = [windows_of(r) for r in raw]
                judged = model.judge(np.concatenate(cut), tables).astype(np.float64)
                sizes = np.array([len(c) for c in cut])
                weight = np.full(sizes.sum(), float(WINDOW))
                ends = np.cumsum(sizes)
                weight[ends - 1] = [len(r) - WINDOW * (len(c) - 1) for r, c in zip(raw, cut)]
                total = np.add.reduceat(judged * weight[:, None], ends - sizes, axis=0)
                mean = total / np.array([len(r) for r in raw])[:, None]
                likely = np.exp(mean - mean.max(1, keepdims=True))
                likely /= likely.sum(1, keepdims=True)
                for i, p in zip(told, likely):
                    names[i], scores[i] = model.languages[int(p.argmax())], float(p.max())
            yield pa.RecordBatch.from_arrays(
                [piece.column("row"), pa.array(names, pa.string()), pa.array(scores, pa.float64())],
                ["row", "lang_pred", "score"],
            )

    rest = [docs[name] for name in docs.columns if name != "text"]
    given = docs.select(F.struct(*rest).alias("row"), whole_text(docs).alias("text"))
    schema = given.select("row", F.lit("").alias("lang_pred"), F.lit(0.0).alias("score")).schema
    return given.mapInArrow(run, schema)
