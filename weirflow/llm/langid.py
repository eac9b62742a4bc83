"""Language identification: sparse multinomial logistic regression on TF-IDF character n-grams.

* n-grams of one to three lower-cased characters are hashed to ``DIM`` features; a text is
  (1 + log count) * idf, scaled to length one.  Document frequencies cover all documents to learn from.
* The weights are trained with follow-the-regularised-leader (proximal, per coordinate) under an
  elastic-net penalty, on a bounded sample (``per_language`` documents of each language are
  expected), and a temperature is fitted on a part of the sample that training never sees.
* A text is scored whole, in its own row.  The model is ``languages x DIM`` numbers.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from weirflow.llm.common import let_go, own_prefix, remainder, sent, travels, without

DIM = 1 << 15
ORDERS = (1, 2, 3)
PER_LANGUAGE = 1200
UNKNOWN = "und"
OUTPUT = ["lang_pred", "score"]
TRIGRAMS = 1 << 18  # numbers that the trigrams of the stage are hashed to
ODD = 0.5  # of the way from the rareness that 99 in a hundred kept-out documents stay below to that of trigrams never seen
EVIDENCE = 0.5  # of the least evidence of a kept-out document: what a text in a known language must have
_BLOCK = 1 << 20  # characters hashed at a time

travels(__name__)


def ngram_counts(text: str) -> np.ndarray:
    """Counts of the hashed n-grams of a whole text."""
    codes = np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
    counts = np.zeros(DIM, np.int64)
    for start in range(0, len(codes), _BLOCK):
        block = codes[start : start + _BLOCK + max(ORDERS) - 1]
        for order in ORDERS:
            n = min(_BLOCK, len(block) - order + 1)
            if n <= 0:
                continue
            mixed = np.full(n, order, np.uint32)
            for k in range(order):
                mixed = (mixed ^ block[k : k + n]) * np.uint32(0x9E3779B1)
                mixed ^= mixed >> np.uint32(15)
            counts += np.bincount(mixed % np.uint32(DIM), minlength=DIM)
    return counts


def vector(counts: np.ndarray, idf: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Indices and TF-IDF values of one text."""
    index = np.flatnonzero(counts)
    value = (1 + np.log(counts[index])) * idf[index]
    norm = np.sqrt((value * value).sum())
    return index, value / norm if norm > 0 else value


@dataclass
class Ftrl:
    """Multinomial logistic regression trained by FTRL-proximal; an unused weight is exactly zero."""

    classes: int
    alpha: float = 0.5
    beta: float = 1.0
    l1: float = 0.02
    l2: float = 0.5
    z: np.ndarray = field(init=False)
    n: np.ndarray = field(init=False)

    def __post_init__(self) -> None:
        self.z = np.zeros((self.classes, DIM + 1))  # the last column is the bias
        self.n = np.zeros((self.classes, DIM + 1))

    def weights(self, index: np.ndarray | slice) -> np.ndarray:
        z, n = self.z[:, index], self.n[:, index]
        return np.where(np.abs(z) <= self.l1, 0.0, -(z - np.sign(z) * self.l1) / ((self.beta + np.sqrt(n)) / self.alpha + self.l2))

    def learn(self, index: np.ndarray, value: np.ndarray, label: int) -> None:
        index, value = np.append(index, DIM), np.append(value.astype(np.float64), 1.0)
        w = self.weights(index)
        p = softmax(w @ value)
        p[label] -= 1.0
        gradient = p[:, None] * value
        before = self.n[:, index]
        after = before + gradient * gradient
        self.z[:, index] += gradient - (np.sqrt(after) - np.sqrt(before)) / self.alpha * w
        self.n[:, index] = after


def softmax(logits: np.ndarray) -> np.ndarray:
    e = np.exp(logits - logits.max(axis=-1, keepdims=True))
    return e / e.sum(axis=-1, keepdims=True)


def fit_temperature(logits: np.ndarray, labels: np.ndarray, rounds: int = 80) -> float:
    """The temperature with the least log loss against smoothed labels; 1 without rows to fit it on.

    Rows without an error would make the least temperature the best one.  So a label counts only as
    1 - e, and e is spread over the other languages, e being 1 / (rows + 2): one error more than there
    are, the least that so many rows leave possible.  The loss is convex in 1 / temperature and grows without
    bound on both sides, so its minimum lies inside; golden sections find it between 1e-4 and 1e4.
    """
    n, k = logits.shape if len(labels) else (0, 0)
    if not n or k < 2:
        return 1.0
    wrong = 1 / (n + 2)
    target = np.full((n, k), wrong / (k - 1))
    target[np.arange(n), labels] = 1 - wrong

    def loss(log_t: float) -> float:
        scaled = logits / np.exp(log_t)
        top = scaled.max(axis=1, keepdims=True)
        return float((np.log(np.exp(scaled - top).sum(axis=1)) + top[:, 0] - (target * scaled).sum(axis=1)).mean())

    low, high, ratio = np.log(1e-4), np.log(1e4), (np.sqrt(5) - 1) / 2
    for _ in range(rounds):
        a, b = high - ratio * (high - low), low + ratio * (high - low)
        low, high = (low, b) if loss(a) <= loss(b) else (a, high)
    return float(np.exp((low + high) / 2))


@dataclass(frozen=True)
class LanguageModel:
    languages: tuple[str, ...]
    idf: np.ndarray
    weights: np.ndarray
    bias: np.ndarray
    temperature: float
    least: float = 0.0  # evidence that a text in one of the languages has

    def logits(self, index: np.ndarray, value: np.ndarray) -> np.ndarray:
        return self.weights[:, index] @ value + self.bias

    def predict(self, text: str | None) -> tuple[str, float]:
        if text is None or not self.languages or not any(map(str.isalpha, text)):
            return UNKNOWN, 0.0
        p = softmax(self.logits(*vector(ngram_counts(text), self.idf)) / self.temperature)
        best = int(p.argmax())
        return self.languages[best], float(p[best])

    def knows(self, text: str | None) -> bool:
        """Whether a text has a letter and the evidence (the largest logit, before the temperature) of a
        text in one of the languages; without a learned language, whether it has a letter."""
        if text is None or not any(map(str.isalpha, text)):
            return False
        return not self.languages or bool(self.logits(*vector(ngram_counts(text), self.idf)).max() >= self.least)


def _frequencies(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    let_go()
    seen, rows = np.zeros(DIM, np.int64), 0
    for batch in batches:
        for text in batch["text"]:
            seen += ngram_counts(text) > 0
            rows += 1
    index = np.flatnonzero(seen)
    yield pd.DataFrame({"feature": np.append(index, -1), "n": np.append(seen[index], rows)})


def document_frequencies(learn: DataFrame) -> tuple[np.ndarray, int]:
    """Over all documents: how many hold each feature, and their number.  Each task sends at most
    ``DIM + 1`` sums."""
    parts = learn.select("text").mapInPandas(_frequencies, "feature int, n bigint")
    found = parts.groupBy("feature").agg(F.sum("n").alias("n")).collect()
    df, rows = np.zeros(DIM), 0
    for feature, n in found:
        if feature < 0:
            rows = n
        else:
            df[feature] = n
    return df, rows


def _vectorise(idf: np.ndarray):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        let_go()
        for batch in batches:
            made = [vector(ngram_counts(t), idf) for t in batch["text"]]
            yield pd.DataFrame({"lang": batch["lang"], "order": batch["order"], "i": [m[0].astype(np.int32).tobytes() for m in made], "v": [m[1].astype(np.float32).tobytes() for m in made]})

    return run


def train(docs: DataFrame, text: str = "text", lang: str = "lang", id_column: str = "doc_id", per_language: int = PER_LANGUAGE, epochs: int = 3) -> LanguageModel:
    """Fit a model on all rows of ``docs`` with a language and a letter.

    The sample that reaches the driver holds about ``per_language`` rows of each language, chosen by a
    hash of the id and text, as vectors of at most ``DIM`` numbers.  Without rows the model knows no language.
    """
    usable = F.col(lang).isNotNull() & F.coalesce(F.col(text).rlike(r"\p{L}"), F.lit(False))
    learn = docs.filter(usable).select(F.col(lang).cast("string").alias("lang"), F.col(text).alias("text"), F.xxhash64(F.col(id_column), F.col(text)).alias("order"))
    df, rows = document_frequencies(learn)
    idf = np.log((1 + rows) / (1 + df)) + 1
    counts = {r["lang"]: r["count"] for r in learn.groupBy("lang").count().collect()}  # as many as the model has rows
    share = F.create_map(*(F.lit(x) for name, n in counts.items() for x in (name, min(1.0, per_language / n)))) if counts else F.create_map().cast("map<string,double>")
    chance = F.pmod(F.col("order"), F.lit(1 << 20)) / float(1 << 20)
    drawn = learn.filter(chance < share[F.col("lang")])
    found = drawn.mapInPandas(_vectorise(idf), "lang string, order bigint, i binary, v binary").collect()
    found.sort(key=lambda r: (r["order"] * 0x9E3779B97F4A7C15 % (1 << 64), r["lang"]))
    languages = tuple(sorted({r["lang"] for r in found}))
    label = {name: k for k, name in enumerate(languages)}
    sparse = [(np.frombuffer(r["i"], np.int32), np.frombuffer(r["v"], np.float32), label[r["lang"]]) for r in found]
    kept_out, fitted = sparse[: len(sparse) // 8], sparse[len(sparse) // 8 :]
    model = Ftrl(len(languages))
    for _ in range(epochs if len(languages) > 1 else 0):
        for row in fitted:
            model.learn(*row)
    w = model.weights(slice(None))
    trained = LanguageModel(languages, idf, w[:, :DIM].copy(), w[:, DIM].copy(), 1.0)
    logits = np.array([trained.logits(i, v) for i, v, _ in kept_out])
    t = fit_temperature(logits, np.array([y for *_, y in kept_out], dtype=int)) if len(languages) > 1 else 1.0
    least = EVIDENCE * float(logits.max(axis=1).min()) if len(languages) > 1 and len(logits) else 0.0
    return LanguageModel(languages, idf, trained.weights.astype(np.float32), trained.bias, t, max(0.0, least))


def identify(docs: DataFrame, model: LanguageModel, text: str = "text") -> DataFrame:
    """``docs`` with lang_pred and score (the calibrated probability of the predicted language).

    Null, empty and letterless texts are ``und`` with score 0, as is everything if the model knows no
    language.  Other columns pass through and are never looked at.
    """
    held = sent(docs.sparkSession, model)

    @F.pandas_udf("lang_pred string, score double")
    def predict(column: pd.Series) -> pd.DataFrame:
        return pd.DataFrame([held().predict(t) for t in column], columns=["lang_pred", "score"])

    found = f"{own_prefix(docs)}found"
    return docs.withColumn(found, predict(F.col(text))).select(*without(docs, OUTPUT), f"{found}.lang_pred", f"{found}.score")


def learnable(docs: DataFrame, id_column: str = "doc_id") -> DataFrame:
    """The rows that may be learned from: two thirds, by crc32 of the id."""
    return docs.filter(remainder(id_column, 3) != 1)


# --- texts that are no language ------------------------------------------------------------------


def trigrams(text: str) -> np.ndarray:
    """Hashed trigrams of a whole text, lower-cased, with one blank for white space and at either end."""
    codes = np.frombuffer(f" {' '.join(text.lower().split())} ".encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
    mixed = np.zeros(max(0, len(codes) - 2), np.uint32)
    for k in range(3):
        mixed = (mixed ^ codes[k : k + len(mixed)]) * np.uint32(0x9E3779B1)
        mixed ^= mixed >> np.uint32(15)
    return mixed % np.uint32(TRIGRAMS)


def rareness(text: str, idf: np.ndarray) -> float:
    """The mean rareness of a text's trigrams; of a text without one, that of a trigram never seen."""
    found = trigrams(text)
    return float(idf[found].mean()) if len(found) else float(idf.max())


def _trigram_frequencies(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    let_go()
    seen, rows = np.zeros(TRIGRAMS, np.int64), 0
    for batch in batches:
        for text in batch["text"]:
            seen[np.unique(trigrams(text))] += 1
            rows += 1
    index = np.flatnonzero(seen)
    yield pd.DataFrame({"feature": np.append(index, -1), "n": np.append(seen[index], rows)})


def oddity(docs: DataFrame, text: str = "text", lang: str = "lang", id_column: str = "doc_id") -> tuple[np.ndarray, float]:
    """Rareness of each trigram in the documents that may be learned from, and the mean rareness beyond which a
    text is odd: ``ODD`` of the way from the value that 99 in a hundred of the labelled documents kept out
    of learning stay below, so that no single document sets it, to that of a text of trigrams that were
    never seen.  Without such documents nothing is odd.

    Each task sends at most ``TRIGRAMS`` + 1 sums, and the driver keeps ``TRIGRAMS`` numbers.
    """
    usable = docs.filter(F.col(lang).isNotNull() & F.coalesce(F.col(text).rlike(r"\p{L}"), F.lit(False))).select(F.col(id_column).alias("id"), F.col(text).alias("text"))
    counted = learnable(usable, "id").select("text").mapInPandas(_trigram_frequencies, "feature int, n bigint").groupBy("feature").agg(F.sum("n").alias("n")).collect()
    df, rows = np.zeros(TRIGRAMS), 0
    for feature, n in counted:
        if feature < 0:
            rows = n
        else:
            df[feature] = n
    idf = np.log((1 + rows) / (1 + df)) + 1
    held = sent(docs.sparkSession, idf)

    @F.pandas_udf("double")
    def rare(column: pd.Series) -> pd.Series:
        return pd.Series([rareness(t, held()) for t in column], dtype=float)

    kept_out = usable.filter(remainder("id", 3) == 1).select(rare("text").alias("r"))
    common = kept_out.agg(F.percentile_approx("r", 0.99, 10_000)).first()[0] if rows else None
    unseen = float(np.log(1 + rows) + 1)
    return idf, float("inf") if common is None else common + ODD * max(0.0, unseen - common)


def drop_unknown(docs: DataFrame, id_column: str = "doc_id", text: str = "text", lang: str = "lang") -> DataFrame:
    """``docs`` without the texts that are in no language; same columns.  These are

    * null texts and texts without a letter,
    * odd texts, whose trigrams are much rarer than those of documents in the languages (see :func:`oddity`), and
    * texts with less than ``EVIDENCE`` of the least evidence that the model has for any of the documents
      kept out of its training.

    The calibrated score cannot decide, since it is near one for noise too where the languages are far
    apart.  If no language was learned (no labelled row), or one only, every text with a letter stays
    that is not odd.
    """
    model = train(learnable(docs, id_column), text, lang, id_column)
    idf, odd = oddity(docs, text, lang, id_column)
    held = sent(docs.sparkSession, (model, idf, odd))

    @F.pandas_udf("boolean")
    def knows(column: pd.Series) -> pd.Series:
        known, rare, limit = held()
        return pd.Series([known.knows(t) and rareness(t, rare) <= limit for t in column], dtype=bool)

    known = f"{own_prefix(docs)}known"
    return docs.withColumn(known, knows(F.col(text))).filter(F.col(known)).select(*docs.columns)
