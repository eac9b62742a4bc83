"""Toxicity of texts: a bidirectional GRU with attention pooling over character and word inputs.

* A word's input is its own embedding (words that the sample holds often enough) beside the mean of
  the embeddings of its hashed character trigrams, so inflected and unseen words are covered.
* A text is cut into overlapping windows of ``WINDOW`` words, every ``STRIDE`` words; each is read in
  both directions, pooled by attention and given a logit.  The text's score is the calibrated logit of
  its strongest window; all windows of whole texts are scored.
* The network is trained with Adam and back-propagation in numpy.  Only whole texts are labelled, so
  training goes in rounds: tasks score the whole texts of a bounded sample and send back their
  strongest windows, and the driver trains on these.  A part of the sample is kept for calibration.
"""

from __future__ import annotations

import math
import uuid
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from weirflow.llm.common import remainder, sent, texts, travels, without, worker_store, write_table

WINDOW, STRIDE = 24, 12
HIDDEN, EMBED, TRIGRAMS, VOCABULARY = 8, 12, 1 << 13, 6000
PER_CLASS = 2000  # expected rows of each label in the sample
FIRST_WINDOWS, TOP_WINDOWS, ROUNDS = 6, 2, 4
LEAST_STEPS = 60  # of the optimiser in a round, for small samples
KNOWN_WORDS = 200_000  # words whose inputs a worker keeps
BATCH = 2048
OUTPUT = ["score", "predicted"]
_GROUP = 1 << 20  # characters scored together
_WORD = re.compile(r"\w+")

travels(__name__)


def words_of(text: str) -> list[str]:
    return _WORD.findall(text.lower())


def window_starts(n: int) -> list[int]:
    """Starts of the windows over ``n`` words; the last window ends with the text."""
    if n <= WINDOW:
        return [0]
    starts = list(range(0, n - WINDOW, STRIDE))
    return [*starts, n - WINDOW]


def trigrams(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Hashed character trigrams of ``<word>`` for all words: (bucket, position of the word)."""
    if not words:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    codes = np.frombuffer(("<" + "><".join(words) + ">").encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
    word = np.cumsum(codes == ord("<")) - 1
    inside = (codes[:-2] != ord(">")) & (codes[1:-1] != ord(">"))
    mixed = np.zeros(len(codes) - 2, np.uint32)
    for k in range(3):
        mixed = (mixed ^ codes[k : len(codes) - 2 + k]) * np.uint32(0x9E3779B1)
        mixed ^= mixed >> np.uint32(15)
    return (mixed[inside] % np.uint32(TRIGRAMS)).astype(np.int64), word[:-2][inside]


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 0.5 * np.tanh(0.5 * x) + 0.5


@dataclass
class Network:
    """Weights; ``forward`` keeps what ``backward`` needs."""

    vocabulary: dict[str, int]
    p: dict[str, np.ndarray]

    @classmethod
    def fresh(cls, vocabulary: dict[str, int], seed: int = 7) -> Network:
        r, h = np.random.default_rng(seed), HIDDEN
        draw = lambda *shape, s: (r.standard_normal(shape) * s).astype(np.float32)
        p = {"word": draw(len(vocabulary) + 1, EMBED, s=0.1), "char": draw(TRIGRAMS, EMBED, s=0.3)}
        for d in "fb":
            p |= {f"w{d}": draw(2 * EMBED, 3 * h, s=0.3), f"b{d}": np.zeros(3 * h, np.float32), f"u{d}": draw(h, 3 * h, s=0.3)}
        p |= {"a": draw(2 * h, s=0.3), "v": draw(2 * h, s=0.3), "c": np.zeros(1, np.float32)}
        p["word"][0] = 0
        return cls(vocabulary, p)

    def inputs(self, words: list[str]) -> tuple[np.ndarray, np.ndarray, tuple]:
        """The input vector of each word, and what they were made of."""
        known = np.fromiter((self.vocabulary.get(w, 0) for w in words), dtype=np.int64, count=len(words))
        bucket, word = trigrams(words)
        count = np.bincount(word, minlength=len(words)).astype(np.float32)
        share = 1 / np.maximum(count, 1)
        chars = np.zeros((len(words), EMBED), np.float32)
        if len(bucket):
            present = np.flatnonzero(count)
            starts = np.concatenate(([0], np.cumsum(count[present].astype(np.int64))[:-1]))
            chars[present] = np.add.reduceat(self.p["char"][bucket], starts, axis=0) * share[present, None]
        return np.concatenate([self.p["word"][known], chars], axis=1), known, (bucket, word, share)

    def gates(self, x: np.ndarray) -> np.ndarray:
        """Input part of the gates of both directions; row 0 is padding, which keeps the state."""
        made = np.zeros((2, len(x) + 1, 3 * HIDDEN), np.float32)
        made[:, 0, :HIDDEN] = 30
        for at, d in enumerate("fb"):
            made[at, 1:] = x @ self.p[f"w{d}"] + self.p[f"b{d}"]
        return made

    def forward(self, gates: np.ndarray, index: np.ndarray, keep: bool = False) -> tuple[np.ndarray, dict]:
        """Logits of windows of word numbers (0: padding)."""
        h, n, steps = HIDDEN, len(index), index.shape[1]
        states = np.zeros((steps, n, 2 * h), np.float32)
        trace: dict = {}
        for d, at, order in (("f", 0, range(steps)), ("b", 1, range(steps - 1, -1, -1))):
            own, u, state = gates[at], self.p[f"u{d}"], np.zeros((n, h), np.float32)
            for t in order:
                g, hu = own[index[:, t]], state @ u
                zr = sigmoid(g[:, : 2 * h] + hu[:, : 2 * h])
                z, r = zr[:, :h], zr[:, h:]
                new = np.tanh(g[:, 2 * h :] + r * hu[:, 2 * h :])
                if keep:
                    trace[d, t] = (state, z, r, new, hu[:, 2 * h :])
                state = new + z * (state - new)
                states[t, :, at * h : (at + 1) * h] = state
        e = np.where(index.T == 0, np.float32(-30), states @ self.p["a"])
        e = np.exp(e - e.max(axis=0))
        alpha = e / e.sum(axis=0)
        pooled = (alpha[:, :, None] * states).sum(axis=0)
        if keep:
            trace |= {"states": states, "alpha": alpha, "pooled": pooled}
        return pooled @ self.p["v"] + self.p["c"][0], trace

    def backward(self, d_logit: np.ndarray, gates: np.ndarray, index: np.ndarray, trace: dict) -> tuple[np.ndarray, dict]:
        """Gradient by the gates' inputs, and by the weights beyond them."""
        h, steps = HIDDEN, index.shape[1]
        states, alpha = trace["states"], trace["alpha"]
        grad = {"v": d_logit @ trace["pooled"], "c": d_logit.sum(keepdims=True)}
        d_pooled = d_logit[:, None] * self.p["v"]
        d_alpha = (states * d_pooled).sum(axis=2)
        d_e = alpha * (d_alpha - (alpha * d_alpha).sum(axis=0))
        grad["a"] = np.einsum("tn,tnk->k", d_e, states)
        d_states = alpha[:, :, None] * d_pooled + d_e[:, :, None] * self.p["a"]
        d_gates = np.zeros_like(gates)
        for d, at, order in (("f", 0, range(steps - 1, -1, -1)), ("b", 1, range(steps))):
            u, d_u = self.p[f"u{d}"], np.zeros_like(self.p[f"u{d}"])
            d_state = np.zeros((len(index), h), np.float32)
            for t in order:
                before, z, r, new, hun = trace[d, t]
                d_state = d_state + d_states[t, :, at * h : (at + 1) * h]
                d_z = d_state * (before - new) * z * (1 - z)
                d_n = d_state * (1 - z) * (1 - new * new)
                d_r = d_n * hun * r * (1 - r)
                d_hu = np.concatenate([d_z, d_r, d_n * r], axis=1)
                np.add.at(d_gates[at], index[:, t], np.concatenate([d_z, d_r, d_n], axis=1))
                d_u += before.T @ d_hu
                d_state = d_state * z + d_hu @ u.T
            grad[f"u{d}"] = d_u
        return d_gates[:, 1:], grad


class Adam:
    def __init__(self, rate: float = 0.01):
        self.rate, self.t, self.m, self.s = rate, 0, {}, {}

    def step(self, p: dict[str, np.ndarray], grad: dict[str, np.ndarray]) -> None:
        self.t += 1
        for k, g in grad.items():
            m = self.m[k] = 0.9 * self.m.get(k, 0) + 0.1 * g
            s = self.s[k] = 0.999 * self.s.get(k, 0) + 0.001 * g * g
            p[k] -= (self.rate * (m / (1 - 0.9**self.t)) / (np.sqrt(s / (1 - 0.999**self.t)) + 1e-8)).astype(np.float32)


def fit_batch(net: Network, adam: Adam, windows: list[list[str]], labels: np.ndarray, weights: np.ndarray) -> float:
    """One step on windows of words; the mean log loss before it."""
    number: dict[str, int] = {}
    index = np.zeros((len(windows), WINDOW), np.int64)
    for k, window in enumerate(windows):
        for t, w in enumerate(window):
            index[k, t] = number.setdefault(w, len(number) + 1)
    words = list(number)
    x, known, (bucket, word, share) = net.inputs(words)
    gates = net.gates(x)
    logit, trace = net.forward(gates, index, keep=True)
    p = sigmoid(logit)
    d_gates, grad = net.backward(((p - labels) * weights / len(labels)).astype(np.float32), gates, index, trace)
    d_x = np.zeros_like(x)
    for at, d in enumerate("fb"):
        own = d_gates[at]
        grad[f"w{d}"], grad[f"b{d}"] = x.T @ own, own.sum(axis=0)
        d_x += own @ net.p[f"w{d}"].T
    grad["word"], grad["char"] = np.zeros_like(net.p["word"]), np.zeros_like(net.p["char"])
    np.add.at(grad["word"], known, d_x[:, :EMBED])
    grad["word"][0] = 0
    np.add.at(grad["char"], bucket, (d_x[:, EMBED:] * share[:, None])[word])
    adam.step(net.p, grad)
    return float(-(weights * (labels * np.log(p + 1e-7) + (1 - labels) * np.log(1 - p + 1e-7))).mean())


@dataclass(frozen=True)
class ToxicityModel:
    network: Network
    slope: float = 1.0
    shift: float = 0.0

    def probability(self, logit: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.slope * logit + self.shift, -40, 40)))


class Scorer:
    """Window logits of texts, with the inputs of words met so far kept up to a bound."""

    def __init__(self, net: Network):
        self.net = net
        self.known: dict[str, int] = {}
        self.gates = net.gates(np.zeros((0, 2 * EMBED), np.float32))
        self.size = self.gates.shape[1]

    def _learn(self, words: set[str]) -> None:
        new = words - self.known.keys()
        if len(self.known) + len(new) > KNOWN_WORDS:
            self.known, self.size, new = {}, 1, words
        if not new:
            return
        ordered = list(new)
        made = self.net.gates(self.net.inputs(ordered)[0])[:, 1:]
        need = self.size + len(ordered)
        if need > self.gates.shape[1]:
            grown = np.zeros((2, max(need, 2 * self.gates.shape[1]), 3 * HIDDEN), np.float32)
            grown[:, : self.size] = self.gates[:, : self.size]
            self.gates = grown
        self.gates[:, self.size : need] = made
        self.known.update(zip(ordered, range(self.size, need)))
        self.size = need

    def logits(self, several: list[list[str]]) -> list[np.ndarray]:
        """For each list of words the logits of its windows."""
        self._learn({w for words in several for w in words})
        out, rows, sizes = [], [], []
        held = 0
        steps = np.arange(WINDOW)

        def close() -> None:
            if rows:
                index = np.concatenate(rows)
                found = np.concatenate([self.net.forward(self.gates, index[k : k + BATCH])[0] for k in range(0, len(index), BATCH)])
                out.extend(np.split(found, np.cumsum(sizes)[:-1]))
            rows.clear(), sizes.clear()

        for words in several:
            ids = np.fromiter(map(self.known.__getitem__, words), dtype=np.int64, count=len(words))
            if len(ids) < WINDOW:
                ids = np.concatenate([ids, np.zeros(WINDOW - len(ids), np.int64)])
            starts = np.array(window_starts(len(ids)))
            if len(starts) > 8 * BATCH:  # a very long text in pieces
                close()
                held = 0
                out.append(np.concatenate([self.net.forward(self.gates, ids[starts[k : k + BATCH, None] + steps])[0] for k in range(0, len(starts), BATCH)]))
                continue
            rows.append(ids[starts[:, None] + steps])
            sizes.append(len(starts))
            held += len(starts)
            if held >= 8 * BATCH:
                close()
                held = 0
        close()
        return out


def groups(column: list[str]) -> Iterator[list[list[str]]]:
    """Words of the texts, some texts at a time."""
    group, size = [], 0
    for text in column:
        group.append(words_of(text))
        size += len(text)
        if size > _GROUP:
            yield group
            group, size = [], 0
    if group:
        yield group


def _scorer(net: Network, key: str) -> Scorer:
    store = worker_store("toxicity")
    if key not in store:
        store.clear()
        store[key] = Scorer(net)
    return store[key]


_WINDOWS = "label int, order bigint, logit float, words string"


def _first_windows(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        rows = []
        for label, order, text in zip(batch["label"], batch["order"], batch["text"]):
            words = words_of(text)
            starts = window_starts(len(words))
            chosen = np.random.default_rng(order & 0xFFFFFFFF).permutation(len(starts))[:FIRST_WINDOWS]
            rows += [(label, order, 0.0, " ".join(words[starts[k] : starts[k] + WINDOW])) for k in chosen]
        yield pd.DataFrame(rows, columns=["label", "order", "logit", "words"])


def _strongest_windows(held, key: str):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        scorer = _scorer(held(), key)
        for batch in batches:
            rows, k = [], 0
            for group in groups(batch["text"].tolist()):
                for words, logits in zip(group, scorer.logits(group)):
                    starts = window_starts(max(len(words), WINDOW))
                    for at in np.argsort(-logits, kind="stable")[:TOP_WINDOWS]:
                        rows.append((batch["label"].iloc[k], batch["order"].iloc[k], float(logits[at]), " ".join(words[starts[at] : starts[at] + WINDOW])))
                    k += 1
            yield pd.DataFrame(rows, columns=["label", "order", "logit", "words"])

    return run


def _calibrate(logit: np.ndarray, label: np.ndarray, weight: np.ndarray) -> tuple[float, float]:
    """Slope and shift of a logistic curve over the strongest logits, by Newton's method."""
    x, beta = np.stack([logit, np.ones_like(logit)], axis=1), np.array([1.0, 0.0])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ beta, -30, 30)))
        w = weight * p * (1 - p)
        hess = x.T @ (w[:, None] * x) + 1e-3 * np.eye(2)
        move = np.linalg.solve(hess, x.T @ (weight * (label - p)) - 1e-3 * (beta - np.array([1.0, 0.0])))
        beta = beta + np.clip(move, -1, 1)
        if np.abs(move).max() < 1e-6:
            break
    return (float(beta[0]), float(beta[1])) if beta[0] > 0 else (1.0, 0.0)


def draw(labels: DataFrame, label: str, id_column: str, per_class: int = PER_CLASS) -> tuple[DataFrame, dict[int, float]]:
    """Labels chosen by a hash of the id, about ``per_class`` of each kind, and the share chosen."""
    usable = labels.filter(F.col(label).isin(0, 1) & F.col(id_column).isNotNull()).select(id_column, F.col(label).cast("int").alias("label"))
    counts = {r["label"]: r["count"] for r in usable.groupBy("label").count().collect()}
    share = {k: min(1.0, per_class / n) for k, n in counts.items()}
    chance = F.pmod(F.xxhash64(id_column), F.lit(1 << 20)) / float(1 << 20)
    return usable.filter(chance < F.when(F.col("label") == 1, share.get(1, 0.0)).otherwise(share.get(0, 0.0))), share


def train(docs: DataFrame, labels: DataFrame, text: str = "text", label: str = "toxic", id_column: str = "doc_id", per_class: int = PER_CLASS, rounds: int = ROUNDS) -> ToxicityModel:
    """Fit a model on texts whose label is 0 or 1.

    About ``per_class`` labels of each kind are drawn by a hash of the id; they are few enough to be
    sent to all tasks, so that no text moves but those drawn.  What the driver gets of a text is a few
    windows of ``WINDOW`` words.  Repeated rows of one label count once.  Without texts of both labels
    the model gives one half to everything.
    """
    chosen, share = draw(labels, label, id_column, per_class)
    sample = docs.filter(F.col(text).isNotNull()).select(id_column, F.col(text).alias("text")).join(F.broadcast(chosen.distinct()), id_column)
    marked = sample.select("label", F.xxhash64(id_column, "text").alias("order"), "text").repartition(24, "label", "order").dropDuplicates(["label", "order"])
    spark = docs.sparkSession
    drawn = write_table(marked, "toxicity-sample")
    if len(drawn.select("label").distinct().collect()) < 2:
        net = Network.fresh({})
        net.p["v"][:] = 0
        return ToxicityModel(net)
    found = drawn.mapInPandas(_first_windows, _WINDOWS).collect()
    seen = Counter(w for r in found for w in set(r["words"].split()))
    vocabulary: dict[str, int] = {}
    net, adam, rng = None, Adam(), np.random.default_rng(11)
    for turn in range(rounds + 1):
        found.sort(key=lambda r: (r["order"], -r["logit"], r["words"]))
        if turn:
            seen.update(w for r in found for w in set(r["words"].split()))
        if net is None:
            vocabulary = {w: k + 1 for k, (w, _) in enumerate(sorted(((w, n) for w, n in seen.items() if n >= 3), key=lambda x: (-x[1], x[0]))[:VOCABULARY])}
            net = Network.fresh(vocabulary)
        if turn == rounds:
            break
        # A quarter of the texts is never trained on.
        fit = [r for r in found if r["order"] % 4 != 0]
        windows, labels = [r["words"].split() for r in fit], np.array([r["label"] for r in fit], dtype=np.float32)
        balance = np.where(labels == 1, len(labels) / max(1, 2 * labels.sum()), len(labels) / max(1, 2 * (1 - labels).sum())).astype(np.float32)
        steps = math.ceil(len(windows) / 128)
        for _ in range(max(2 if turn == 0 else 3, math.ceil(LEAST_STEPS / max(1, steps)))):
            order = rng.permutation(len(windows))
            for k in range(0, len(order), 128):
                part = order[k : k + 128]
                fit_batch(net, adam, [windows[i] for i in part], labels[part], balance[part])
        held = sent(spark, net)
        found = drawn.mapInPandas(_strongest_windows(held, uuid.uuid4().hex), _WINDOWS).collect()
    best: dict[int, tuple[float, int]] = {}
    for r in found:
        if r["order"] % 4 == 0 or len(found) < 40:
            best[r["order"]] = max(best.get(r["order"], (-1e9, 0)), (r["logit"], r["label"]))
    logit, label_of = np.array([b[0] for b in best.values()], dtype=float), np.array([b[1] for b in best.values()], dtype=float)
    if len(set(label_of.tolist())) < 2:
        return ToxicityModel(net)
    weight = np.where(label_of == 1, 1 / share[1], 1 / share[0])
    return ToxicityModel(net, *_calibrate(logit, label_of, weight / weight.mean()))


def score(docs: DataFrame, model: ToxicityModel, text: str = "text") -> DataFrame:
    """``docs`` with ``score`` (0 to 1) and ``predicted`` (1 from one half on) of each whole text.

    Null, empty and wordless texts get the score of a window without words.  Other columns pass
    through and are never looked at.
    """
    held = sent(docs.sparkSession, model)
    key = uuid.uuid4().hex

    @F.pandas_udf("double")
    def strongest(column: pd.Series) -> pd.Series:
        scorer = _scorer(held().network, key)
        best = [logits.max() for group in groups(column.tolist()) for logits in scorer.logits(group)]
        return pd.Series(np.round(held().probability(np.array(best, dtype=np.float64)), 6))

    rest = without(docs, OUTPUT)
    scored = docs.select(*rest, strongest(texts(text)).alias("score"))
    return scored.withColumn("predicted", (F.col("score") >= 0.5).cast("int"))


def toxicity_report(docs: DataFrame, labels: DataFrame, id_column: str = "doc_id", text: str = "text", label: str = "toxic") -> DataFrame:
    """Per row of ``docs``: the id, held_out, score and predicted.

    Labels are learned from the rows whose crc32 of the id modulo 5 is not 0 (``held_out`` false).
    """
    model = train(docs, labels.filter(remainder(id_column, 5) != 0), text, label, id_column)
    return score(docs.select(id_column, text), model, text).select(id_column, (remainder(id_column, 5) == 0).alias("held_out"), "score", "predicted")
