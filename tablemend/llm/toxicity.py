"""Toxicity by weak supervision.

Voters fire or abstain on a document: lexicons of insults in four languages, patterns of abusive wording, and word
beginnings that the labelled sample shows far more often in toxic documents. A generative label model sees their
votes without the labels and estimates by expectation-maximisation how often each voter fires in either class, and
from the residuals which voters repeat each other; correlated voters share one voice. Its posterior labels train a linear
classifier over word beginnings and voters, which scores every text.

What is fitted uses at most about `FIT_ROWS` labelled documents, drawn by a hash of the id; feature counts are made where the texts lie
and only the best `FEATURES` features and the votes of the sample come to the driver. Scoring reads all texts whole and
shuffles nothing.

Labels are learned only from rows whose crc32(doc_id) modulo 5 is not 0. A score depends on the text alone.

Defined cases: a NULL or empty text scores as a text without words; repeated labels of an id count once, toxic if any
is; labels that are NULL or without a document are passed over; a NULL doc_id is not held out; without both
classes among the labels the lexicons and patterns decide; an empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tablemend.llm.common import regrouped

FIT_ROWS = 20_000
FEATURES = 1024
VOTERS = 256
FOLDS = 5
#: Lengths of the word beginnings that serve as features.
BEGINNINGS = (4, 5, 6, 7, 8)
#: A beginning counts once more from so many words on.
LEVELS = (2, 3)
#: A beginning may vote if it is in at least so many labelled documents, and toxic ones hold it so many times more often.
SUPPORT, LIFT = 8, 6.0

LEXICONS = {
    "en": "idiot idiots moron morons stupid loser losers scum trash pathetic worthless disgusting clown dumb fool jerk bastard bitch asshole retard freak creep pig vermin filth",
    "de": "idiot trottel dumm dummkopf arschloch abschaum versager widerlich wertlos erbärmlich ekelhaft hurensohn schwachkopf vollidiot",
    "fr": "idiot imbécile stupide connard connasse salope abruti crétin minable dégoûtant pourriture ordure pathétique débile",
    "es": "idiota imbécil estúpido estúpida cabrón puta basura asqueroso patético inútil escoria payaso perdedor maldito",
}
PATTERNS = {
    "shut_up": r"\bshut up\b", "hate_you": r"\bi hate you\b", "you_are": r"\byou(?: are|'re) (?:a |an |so )?(?:idiot|moron|stupid|dumb|loser|trash)", "kill": r"\b(?:kill yourself|go die|kys)\b",
    "masked": r"\b(?:f[*@#]+ck|sh[*@#]+t|b[*@#]+tch|a[*@#]+hole)", "swear": r"\b(?:fuck|shit|damn)\w*",
}
_FIXED = [*(f"lexicon:{k}" for k in LEXICONS), *(f"pattern:{k}" for k in PATTERNS)]
_WORDS = {w: f"lexicon:{k}" for k, words in reversed(LEXICONS.items()) for w in words.split()}
_COMPILED = {f"pattern:{k}": re.compile(p) for k, p in PATTERNS.items()}
_HINTS = ("shut up", "hate you", "you", "kill", "die", "kys", "*", "@", "#", "fuck", "shit", "damn")
_EDGE = " .,;:!?\"'()[]{}<>*#$%&@~_-+=/\\|"


def features_of(text: str | None) -> set[str]:
    """Fixed voters that fire, and the beginnings of the words with their levels (`begi`, `begi#2`, `begi#3`)."""
    low = (text or "").lower()
    found, seen = set(), Counter()
    for word, times in Counter(w.strip(_EDGE) for w in low.split()).items():
        for n in BEGINNINGS:
            if len(word) < n:
                break
            seen[word[:n]] += times
        if word in _WORDS:
            found.add(_WORDS[word])
    found.update(seen)
    for level in LEVELS:
        found.update(f"{b}#{level}" for b, n in seen.items() if n >= level)
    if any(h in low for h in _HINTS):
        found.update(name for name, p in _COMPILED.items() if p.search(low))
    return found


@dataclass
class LabelModel:
    """Rates at which voters fire in either class, the offset that keeps the class balance, and each voter's voice."""

    balance: float
    rate: np.ndarray  # voters x 2: how often a voter fires in class 0 and 1
    voice: np.ndarray  # one over the number of voters that vote like a voter
    correlation: np.ndarray
    offset: float = 0.0

    def evidence(self, votes: np.ndarray) -> np.ndarray:
        """Log odds that the votes cast add, by row; a voter that abstains adds nothing."""
        return votes @ (np.log(self.rate[:, 1] / self.rate[:, 0]) * self.voice)

    def posterior(self, votes: np.ndarray) -> np.ndarray:
        """Probability of class 1 by row of votes."""
        return _logistic(self.evidence(votes) + self.offset)


def _logistic(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -40, 40)))


def _balanced(evidence: np.ndarray, balance: float) -> float:
    """The offset at which the mean probability is the class balance."""
    low, high = -60.0, 20.0
    for _ in range(50):
        middle = (low + high) / 2
        low, high = (middle, high) if _logistic(evidence + middle).mean() < balance else (low, middle)
    return low


def label_model(votes: np.ndarray, balance: float, rounds: int = 30) -> LabelModel:
    """Fit to a 0/1 matrix (documents x voters) without labels; all voters speak for class 1."""
    votes = votes.astype(np.float64)
    n, k = votes.shape
    fired = votes.mean(axis=0)
    centred = (votes - fired) / np.sqrt(np.maximum(fired * (1 - fired), 1e-12))
    correlation = centred.T @ centred / n
    alike = np.where(correlation > 0.8, correlation, 0)
    np.fill_diagonal(alike, 1)
    rate = np.stack([fired * 0.1, np.minimum(fired / balance, 0.9)], axis=1)
    model = LabelModel(balance, np.clip(rate, 1e-5, 0.95), 1 / alike.sum(axis=1), correlation)
    for _ in range(rounds):
        model.offset = _balanced(model.evidence(votes), balance)
        weight = model.posterior(votes)
        rate = np.stack([((1 - weight) @ votes + 0.1) / ((1 - weight).sum() + 1), (weight @ votes + 0.5) / (weight.sum() + 1)], axis=1)
        # Voters keep their polarity: they never fire more often in class 0.
        rate[:, 1] = np.maximum(rate[:, 1], rate[:, 0])
        model.rate = np.clip(rate, 1e-6, 1 - 1e-6)
    model.offset = _balanced(model.evidence(votes), balance)
    return model


def train_linear(rows: np.ndarray, columns: np.ndarray, n: int, k: int, target: np.ndarray, rounds: int = 300, decay: float = 1e-5) -> tuple[np.ndarray, float]:
    """Logistic regression on 0/1 features given as (row, column) pairs, with soft targets: weights and offset."""
    weight, offset = np.zeros(k), float(np.log((target.mean() + 1e-3) / (1 - target.mean() + 1e-3)))
    moment, square, m0, s0 = np.zeros(k), np.zeros(k), 0.0, 0.0
    for step in range(1, rounds + 1):
        score = np.bincount(rows, weight[columns], minlength=n) + offset
        error = (_logistic(score) - target) / n
        slope = np.bincount(columns, error[rows], minlength=k) + decay * weight
        moment, square = 0.9 * moment + 0.1 * slope, 0.99 * square + 0.01 * slope**2
        m0, s0 = 0.9 * m0 + 0.1 * error.sum(), 0.99 * s0 + 0.01 * error.sum() ** 2
        rise = 0.1 * np.sqrt(1 - 0.99**step) / (1 - 0.9**step)
        weight -= rise * moment / (np.sqrt(square) + 1e-9)
        offset -= rise * m0 / (np.sqrt(s0) + 1e-9)
    return weight, offset


@dataclass
class Model:
    """The fitted classifier: a weight for each feature."""

    weights: dict[str, float]
    offset: float
    label_model: LabelModel | None = None
    voters: list[str] = field(default_factory=list)

    def score(self, text: str | None) -> float:
        total = self.offset + sum(self.weights.get(f, 0.0) for f in features_of(text))
        return float(_logistic(total))


def held_out(doc_id: Column) -> Column:
    """Whether a document's labels may not be learned from."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % FOLDS == 0, F.lit(False))


def labelled_sample(documents: DataFrame, labels: DataFrame, fit_rows: int = FIT_ROWS) -> DataFrame:
    """(text, toxic) of about fit_rows labelled documents that may be learned from, drawn by a hash of the id.

    The drawn ids are broadcast: their number is bounded by fit_rows.
    """
    usable = (
        labels.select(F.col("doc_id").cast("long").alias("id"), F.col("toxic").cast("int").alias("toxic")).where("id IS NOT NULL AND toxic IS NOT NULL").where(~held_out(F.col("id"))).groupBy("id").agg(F.max("toxic").alias("toxic"))
    )
    number = usable.count()
    part = min(1.0, fit_rows / max(1, number))
    drawn = usable.where(F.pmod(F.xxhash64("id", F.lit("fit")), F.lit(1 << 62)) < int(part * (1 << 62)))
    read = documents.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return read.join(F.broadcast(drawn), F.col("doc_id") == F.col("id")).select("text", "toxic")


def fit(documents: DataFrame, labels: DataFrame, fit_rows: int = FIT_ROWS) -> Model:
    """Voters, label model and linear classifier from the labelled sample."""
    sample = labelled_sample(documents, labels, fit_rows)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = (Counter(), Counter())
        for batch in regrouped(batches, "text"):
            for text, toxic in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                seen[int(toxic > 0)].update(features_of(text))
                seen[int(toxic > 0)][""] += 1
            if len(seen[0]) + len(seen[1]) > 200_000:
                yield counted(seen)
                seen = (Counter(), Counter())
        yield counted(seen)

    def counted(seen: tuple[Counter, Counter]) -> pa.RecordBatch:
        names = list(seen[0] | seen[1])
        return pa.RecordBatch.from_pydict({"feature": pa.array(names, pa.string()), "clean": pa.array([seen[0][f] for f in names], pa.int64()), "toxic": pa.array([seen[1][f] for f in names], pa.int64())})

    counts = sample.mapInArrow(count, "feature string, clean long, toxic long").groupBy("feature").agg(F.sum("clean").alias("clean"), F.sum("toxic").alias("toxic"))
    # The counts of all documents stand under the empty feature; what is too rare or splits the classes too little stays behind.
    totals = counts.where("feature = ''").first()
    n0, n1 = (totals["clean"], totals["toxic"]) if totals else (0, 0)
    if not n0 or not n1:
        return Model({f: 6.0 for f in _FIXED}, -3.0)
    lift = ((F.col("toxic") + 0.1) / (n1 + 1)) / ((F.col("clean") + 0.1) / (n0 + 1))
    apart = F.abs(F.col("toxic") / n1 - F.col("clean") / n0) / F.sqrt((F.col("toxic") + F.col("clean") + 1.0) / (n0 + n1))
    best = counts.where(F.col("feature") != "").where(F.col("toxic") + F.col("clean") >= SUPPORT).select("feature", lift.alias("lift"), apart.alias("apart"), "toxic")
    top = best.orderBy(F.col("apart").desc(), "feature").limit(FEATURES).collect()
    learned = sorted(((-r["apart"], r["feature"]) for r in top if r["lift"] >= LIFT and r["toxic"] >= SUPPORT and ":" not in r["feature"]))
    voters = _FIXED + [f for _, f in learned[: VOTERS - len(_FIXED)]]
    features = list(dict.fromkeys([*voters, *(r["feature"] for r in top)]))
    number = {f: k for k, f in enumerate(features)}

    def active(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in regrouped(batches, "text"):
            rows = [sorted(number[f] for f in features_of(t) if f in number) for t in batch.column(0).to_pylist()]
            yield pa.RecordBatch.from_arrays([pa.array(rows, pa.list_(pa.int16()))], ["active"])

    # At most fit_rows short lists of feature numbers; no text comes to the driver.
    documents_active = [r[0] for r in sample.mapInArrow(active, "active array<short>").toLocalIterator()]
    n, k = len(documents_active), len(features)
    rows = np.repeat(np.arange(n), [len(a) for a in documents_active])
    columns = np.array([c for a in documents_active for c in a], np.int64)
    votes = np.zeros((n, len(voters)), np.float32)
    is_vote = columns < len(voters)
    votes[rows[is_vote], columns[is_vote]] = 1
    fires = votes.any(axis=0)
    model = label_model(votes[:, fires], n1 / (n0 + n1))
    target = model.posterior(votes[:, fires].astype(np.float64))
    weight, offset = train_linear(rows, columns, n, k, target)
    return Model({f: float(w) for f, w in zip(features, weight, strict=True) if abs(w) > 1e-3}, float(offset), model, [v for v, on in zip(voters, fires, strict=True) if on])


class Scorer:
    """Scores with a memory of words: a word's beginnings are looked up once for many texts."""

    def __init__(self, model: Model):
        self.model, self.words = model, {}
        self.bases = {f.split("#")[0] for f in model.weights}

    def features(self, word: str) -> tuple[str, ...]:
        plain = word.strip(_EDGE)
        found = [plain[:n] for n in BEGINNINGS if len(plain) >= n and plain[:n] in self.bases]
        if _WORDS.get(plain) in self.bases:
            found.append(_WORDS[plain])
        return tuple(found)

    def __call__(self, texts: list[str | None]) -> list[float]:
        if len(self.words) > 400_000:
            self.words = {}
        known, weights, scores = self.words, self.model.weights, []
        for text in texts:
            low = (text or "").lower()
            words = Counter(low.split())
            for word in words:
                if word not in known:
                    known[word] = self.features(word)
            seen: dict[str, int] = {}
            for word, times in words.items():
                for f in known[word]:
                    seen[f] = seen.get(f, 0) + times
            total = self.model.offset
            for f in sorted(seen):
                total += weights.get(f, 0.0)
                if ":" not in f:
                    total += sum(weights.get(f"{f}#{level}", 0.0) for level in LEVELS if seen[f] >= level)
            if any(h in low for h in _HINTS):
                total += sum(weights.get(name, 0.0) for name, p in _COMPILED.items() if name in weights and p.search(low))
            scores.append(float(_logistic(total)))
        return scores


def scored(documents: DataFrame, model: Model) -> DataFrame:
    """doc_id, held_out, score and predicted of every document."""

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = Scorer(model)
        for batch in regrouped(batches, "text", 2 << 20):
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(scorer(batch.column(1).to_pylist()), pa.float64())], ["doc_id", "score"])

    read = documents.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    out = read.mapInArrow(score, "doc_id long, score double")
    return out.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


def without_toxic(documents: DataFrame, model: Model) -> DataFrame:
    """The documents that score below one half; columns and other rows stay as they are."""
    at = documents.columns.index("text")

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = Scorer(model)
        for batch in regrouped(batches, "text", 2 << 20):
            yield batch.filter(pa.array([s < 0.5 for s in scorer(batch.column(at).to_pylist())], pa.bool_()))

    return documents.mapInArrow(keep, documents.schema)
