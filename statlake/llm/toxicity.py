"""Toxic passages: maximal scoring segments over token log-odds, with extreme-value calibration."""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from statlake.llm.common import hand_back, materialize, ship, slices

#: Labelled rows that the model is fitted on at most: those with the smallest hashes of doc_id.
TRAIN_ROWS = 20_000
#: Features that the model keeps at most, by z; it travels to every worker.
LEXICON = 20_000
#: Features need this z and this many toxic documents.
LEAST_Z, LEAST_DOCS = 3.3, 4
#: Pseudo-counts of the Dirichlet prior: these in all, spread as the features are, and one part each.
PRIOR_MASS, PRIOR_EACH = 500.0, 0.5
#: Score of a token without a feature.
DRIFT = -0.5
#: A passage whose chance of arising in a clean text of this length is below this is reported.
PASSAGE_P = 0.01

_PREFIXES = (4, 5, 6)
_EDGES = "\"'.,;:!?()[]{}<>*#%&$-_"
_CACHE = 100_000


def features(token: str) -> list[str]:
    """A word and its prefixes, so that inflected forms share evidence."""
    word = token.strip(_EDGES)
    return [word, *(f"{word[:k]}~" for k in _PREFIXES if len(word) > k)] if word else []


def tokens(text: str | None) -> list[str]:
    return (text or "").lower().split()


@dataclass
class ToxicityModel:
    """A bounded lexicon of log-odds and the calibration of segment scores."""

    odds: dict[str, float] = field(default_factory=dict)
    rate: float = 1.0  # lambda of the extreme-value law
    space: float = 0.1  # its K
    bias: float = -2.0
    slope: float = 0.0

    def token_score(self, token: str) -> float:
        return max((self.odds[f] for f in features(token) if f in self.odds), default=DRIFT)

    def chance(self, score: float, n: int) -> float:
        """The chance that a clean text of n tokens has a segment with at least this score."""
        return -math.expm1(-self.space * max(n, 1) * math.exp(-self.rate * score)) if score > 0 else 1.0

    def probability(self, chance: float) -> float:
        x = self.bias + self.slope * -math.log10(max(chance, 1e-30))
        return 1 / (1 + math.exp(-max(-500.0, min(500.0, x))))


def segments(scores: np.ndarray) -> list[tuple[int, int, float]]:
    """All maximal scoring segments (start, end, score), in order, in linear time.

    Each positive run becomes a candidate; it is merged with the latest earlier candidate that starts
    from a lower running sum, as long as that one ends lower than the new one does.
    """
    found: list[tuple[int, int, float, float]] = []  # start, end, sum before, sum after
    total, last = 0.0, 0
    for at in np.flatnonzero(scores > 0).tolist():
        total += float(scores[last:at].sum()) if at > last else 0.0
        own = (at, at + 1, total, total + float(scores[at]))
        total, last = own[3], at + 1
        while True:
            j = len(found) - 1
            while j >= 0 and found[j][2] >= own[2]:
                j -= 1
            if j < 0 or found[j][3] >= own[3]:
                break
            own = (found[j][0], own[1], found[j][2], own[3])
            del found[j:]
        found.append(own)
    return [(a, b, after - before) for a, b, before, after in found]


class _Scores(dict):
    """Token scores, kept while there are not too many."""

    def __init__(self, model: ToxicityModel) -> None:
        self.model = model

    def __missing__(self, token: str) -> float:
        if len(self) >= _CACHE:
            self.clear()
        self[token] = score = self.model.token_score(token)
        return score


def _counted(frames: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    counts: dict[int, Counter] = {0: Counter(), 1: Counter()}

    def out() -> pd.DataFrame:
        names = list(counts[0].keys() | counts[1].keys())
        frame = pd.DataFrame({"feature": names, "y1": [counts[1][x] for x in names], "y0": [counts[0][x] for x in names]})
        for c in counts.values():
            c.clear()
        return frame.astype({"y1": "int64", "y0": "int64"})

    for frame in frames:
        for text, toxic in zip(frame["text"], frame["toxic"], strict=True):
            counts[int(toxic)].update({f for t in set(tokens(text)) for f in features(t)})
            if len(counts[0]) + len(counts[1]) > _CACHE:
                yield out()
    if counts[0] or counts[1]:
        yield out()


def _scored(batches: Iterable[pa.RecordBatch], model: ToxicityModel) -> Iterator[pa.RecordBatch]:
    known = _Scores(model)
    kind = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64()), ("score", pa.float64()), ("chance", pa.float64())]))
    for batch in slices(batches, "text"):
        best, sizes, scores, passages = [], [], [], []
        for text in batch.column("text").to_pylist():
            words = tokens(text)
            values = np.fromiter(map(known.__getitem__, words), float, len(words))
            found = [(a, b, s, model.chance(s, len(words))) for a, b, s in segments(values)]
            top = max((s for _, _, s, _ in found), default=0.0)
            best.append(top), sizes.append(len(words))
            scores.append(model.probability(model.chance(top, len(words))))
            passages.append([dict(zip(("start", "end", "score", "chance"), x, strict=True)) for x in found if x[3] < PASSAGE_P])
        yield pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), pa.array(best, pa.float64()), pa.array(sizes, pa.int64()), pa.array(scores, pa.float64()), pa.array(passages, kind)],
            names=["doc_id", "best", "n_tokens", "score", "passages"],
        )


_SCORED = "doc_id long, best double, n_tokens long, score double, passages array<struct<start: long, end: long, score: double, chance: double>>"


def score_toxicity(docs: DataFrame, model: ToxicityModel) -> DataFrame:
    """doc_id, best (highest segment score), n_tokens, score (0 to 1) and passages of docs (doc_id, text).

    passages are the maximal scoring segments, as token positions, that a clean text of that length
    has with a chance below PASSAGE_P. A null, empty or blank text has no segment and the score of
    the least evidence. One result row for each input row; other columns are ignored.
    """
    ship(docs.sparkSession)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return rows.mapInArrow(lambda it: _scored(it, model), _SCORED)


def toxicity_score(docs: DataFrame, model: ToxicityModel) -> Column:
    """The score of docs' own text as a column, for filters that keep whole rows where they are."""
    ship(docs.sparkSession)

    @F.arrow_udf("double")
    def score(texts: Iterator[pa.Array]) -> Iterator[pa.Array]:
        known = _Scores(model)
        for part in texts:
            out = []
            for text in part:  # one text at a time: a batch may hold very long ones
                words = tokens(text.as_py())
                found = segments(np.fromiter(map(known.__getitem__, words), float, len(words)))
                out.append(model.probability(model.chance(max((s for _, _, s in found), default=0.0), len(words))))
            yield pa.array(out, pa.float64())
        known.clear()
        hand_back()

    return score(F.col("text").cast("string"))


def fit_toxicity(docs: DataFrame, labels: DataFrame, train_rows: int = TRAIN_ROWS) -> ToxicityModel:
    """Fit a model on labels (doc_id, toxic 0/1) of docs (doc_id, text).

    A bounded sample is used: the train_rows labelled ids with the smallest hash. Rows with a null id
    or label are left out; an id with several labels counts as toxic if one is. Of sampled documents
    with the same set of words (copies) and label the one with the smallest doc_id is used. Without any toxic or any
    clean document the model has no features and gives every text the same low score.
    """
    ship(docs.sparkSession)
    chosen = (
        labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("toxic").cast("int").alias("toxic"))
        .filter("doc_id is not null and toxic is not null")
        .groupBy("doc_id")
        .agg(F.max("toxic").alias("toxic"))
        .orderBy(F.xxhash64("doc_id"))
        .limit(train_rows)
    )
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).filter("text is not null")
    # at most train_rows rows of two numbers
    rows = texts.join(F.broadcast(chosen), "doc_id")
    words = F.array_sort(F.array_distinct(F.split(F.lower("text"), r"\s+")))
    fold = rows.groupBy(F.xxhash64(words).alias("fold"), "toxic").agg(F.min(F.struct("doc_id", "text")).alias("first"))
    rows = materialize(fold.select("first.*", "toxic"))
    counts = materialize(
        rows.select("text", "toxic").mapInPandas(_counted, "feature string, y1 long, y0 long").groupBy("feature").agg(F.sum("y1").alias("y1"), F.sum("y0").alias("y0"))
    )
    n1, n0 = (int(x or 0) for x in counts.agg(F.sum("y1"), F.sum("y0")).first())
    if not n1 or not n0:
        return ToxicityModel()
    prior = F.lit(PRIOR_EACH) + F.lit(PRIOR_MASS / (n1 + n0)) * (F.col("y1") + F.col("y0"))
    logit = lambda y, n: F.log((F.col(y) + prior) / (F.lit(float(n + PRIOR_MASS)) - F.col(y)))
    odds = logit("y1", n1) - logit("y0", n0)
    z = odds / F.sqrt(1 / (F.col("y1") + prior) + 1 / (F.col("y0") + prior))
    kept = (
        counts.filter(F.col("y1") >= LEAST_DOCS)
        .select("feature", "y0", odds.alias("odds"), z.alias("z"))
        .filter(F.col("z") >= LEAST_Z)
        .orderBy(F.col("z").desc(), "feature")
        .limit(LEXICON)
        .collect()
    )
    model = ToxicityModel({r["feature"]: r["odds"] for r in kept})
    if not kept:
        return model
    model.rate = _rate([(r["odds"], (r["y0"] + 0.5) / n0) for r in kept])
    # at most train_rows rows of three numbers
    found = (
        score_toxicity(rows, model).select("doc_id", "best", "n_tokens").join(rows.select("doc_id", "toxic"), "doc_id").select("best", "n_tokens", "toxic").toPandas()
    )
    # in an order of its own, so that equal tables give equal sums whatever their layout
    found = found.sort_values(["best", "n_tokens", "toxic"], kind="stable", ignore_index=True)
    by_chance = found[(found["toxic"] == 0) & (found["best"] > 0)]
    if len(by_chance) >= 10:
        # the mean of a Gumbel variable lies 0.5772 scales above its mode, which is log(K n) / lambda
        model.space = float(np.exp((model.rate * by_chance["best"] - np.log(by_chance["n_tokens"])).mean() - np.euler_gamma))
        model.space *= len(by_chance) / max(1, int((found["toxic"] == 0).sum()))
    chances = [model.chance(s, n) for s, n in zip(found["best"], found["n_tokens"], strict=True)]
    model.bias, model.slope = _logistic(-np.log10(np.maximum(chances, 1e-30)), found["toxic"].to_numpy(float))
    return model


def _rate(weighted: list[tuple[float, float]]) -> float:
    """The positive root x of the sum of p * exp(x * score) = 1 over the clean tokens' scores."""
    rest = max(0.0, 1 - sum(p for _, p in weighted))
    excess = lambda x: sum(p * math.exp(min(700.0, x * s)) for s, p in weighted) + rest * math.exp(x * DRIFT) - 1
    low, high = 1e-3, 5.0
    for _ in range(60):
        mid = (low + high) / 2
        low, high = (mid, high) if excess(mid) < 0 else (low, mid)
    return low


def _logistic(x: np.ndarray, y: np.ndarray) -> tuple[float, float]:
    """Bias and slope, by Newton's method with a small penalty on the slope."""
    design = np.stack([np.ones_like(x), x], axis=1)
    w = np.zeros(2)
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(design @ w, -30, 30)))
        grad = design.T @ (p - y) + np.array([0, 0.1]) * w
        hess = (design * (p * (1 - p))[:, None]).T @ design + np.diag([1e-6, 0.1])
        step = np.linalg.solve(hess, grad)
        w -= step
        if np.abs(step).max() < 1e-8:
            break
    return float(w[0]), float(max(w[1], 0.0))
