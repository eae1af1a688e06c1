"""Toxicity scores by non-negative positive-unlabelled learning.

Confirmed toxic texts and unlabelled texts are compared; the class prior says how many of the
unlabelled ones are toxic too. The risk of a classifier is then the prior times its loss on the
positives, plus its loss on the unlabelled texts as negatives less what the toxic ones among them
add to it; that second part cannot be negative in truth and is kept from becoming so, here for
each group of texts with like evidence.
"""

from __future__ import annotations

import re
import sys
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillsight.llm.common import LONG_KEY, text_values, with_derived

#: bounds of the fitting sample, in documents
MAX_POSITIVE = 3000
MAX_UNLABELLED = 9000
MAX_FEATURES = 200
#: lengths of the word beginnings that can be features beside whole words
BEGINNINGS = range(3, 8)
#: how far a feature must stand out: in standard errors, and how many times as common as in
#: unlabelled text it must be
LEAST_Z, LEAST_LIFT = 6.0, 3.0
LEAST_POSITIVES = 6
MEMBERS = 5
_KNOWN_WORDS = 150_000
THRESHOLD = 0.7
#: ways to keep the risk from being negative
GROUPED, PLAIN = "grouped", "plain"

#: near copies are dropped from the sample by bands of this many minimum hashes
_BAND = 3
_MIXERS = np.random.default_rng(0).integers(0, 1 << 63, 4 * _BAND, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_LETTERS = re.compile(r"[^\W\d_]+")


def words_of(text: str) -> list[str]:
    """Runs of letters, lowered."""
    return _LETTERS.findall(text.lower())


def features_of(word: str) -> list[str]:
    """A word as a whole, marked by its end, and its beginnings."""
    return [word + "$", *(word[:n] for n in BEGINNINGS if n <= len(word))]


@dataclass(frozen=True)
class Model:
    """Features with the evidence of each, and for each member of the ensemble its weights."""

    features: tuple[str, ...]
    evidence: np.ndarray
    weights: np.ndarray
    known: dict = field(default_factory=dict, compare=False, repr=False)

    def __reduce__(self):
        return Model, (self.features, self.evidence, self.weights)

    def score(self, texts: list[str]) -> np.ndarray:
        """Probability of being toxic, the mean of the members; an empty text has no feature."""
        place = {f: i for i, f in enumerate(self.features)}
        known, rows = self.known, []
        for text in texts:
            own: set = set()
            for w in set(words_of(text)):
                found = known.get(w)
                if found is None:
                    found = tuple(place[f] for f in features_of(w) if f in place)
                    if len(w) <= LONG_KEY:
                        if len(known) >= _KNOWN_WORDS:
                            known.clear()
                        known[w] = found
                if found:
                    own.update(found)
            rows.append(own)
        x = inputs(rows, self.evidence)
        return _sigmoid(x @ self.weights.T).mean(axis=1)


def inputs(rows: list[set], evidence: np.ndarray) -> np.ndarray:
    """What a member sees of a text: whether it has features, its strongest evidence, how many
    features more than one it has, and a constant."""
    x = np.zeros((len(rows), 4))
    x[:, 3] = 1.0
    for i, own in enumerate(rows):
        if own:
            x[i, :3] = 1.0, max(evidence[k] for k in own), np.log(len(own))
    return x


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1.0 / (1.0 + np.exp(-np.clip(x, -40, 40)))


def without_copies(documents: list) -> list:
    """The documents but for near copies of earlier ones, which would make the words of one text
    look like those of a class: any of a few bands of minimum hashes equal."""
    seen: set = set()
    out = []
    for d in documents:
        bands = []
        if d:
            own = np.fromiter((_order(w) for w in d), np.uint64, len(d))
            least = [int((own * m).min()) for m in _MIXERS]
            bands = [(i, *least[i : i + _BAND]) for i in range(0, len(least), _BAND)]
        if not any(b in seen for b in bands):
            out.append(d)
        seen.update(bands)
    return out


def choose_features(positive: list, unlabelled: list) -> list[str]:
    """Features that stand out in the positives, those that stand out most first. Of features that
    begin alike one is chosen, at equal rank the longest."""
    in_p = _counts(positive, None)
    in_p = {f: n for f, n in in_p.items() if n >= LEAST_POSITIVES}
    in_u = _counts(unlabelled, in_p)
    found = []
    for f, n in in_p.items():
        a, b = n / len(positive), in_u.get(f, 0) / len(unlabelled)
        share = (n + in_u.get(f, 0) + 1) / (len(positive) + len(unlabelled) + 2)
        error = np.sqrt(share * (1 - share) * (1 / len(positive) + 1 / len(unlabelled)))
        if a - b >= LEAST_Z * error and a >= LEAST_LIFT * b:
            found.append((round((b - a) / error, 6), -len(f), f))
    chosen: list[str] = []
    for _, _, f in sorted(found):
        if not any(f.startswith(c) or c.startswith(f) for c in chosen):
            chosen.append(f)
            if len(chosen) == MAX_FEATURES:
                break
    return chosen


def _counts(documents: list, wanted) -> dict[str, int]:
    """Documents that hold each feature; only the wanted ones if given."""
    counts: dict[str, int] = {}
    for d in documents:
        for f in {f for w in d for f in features_of(w) if wanted is None or f in wanted}:
            counts[f] = counts.get(f, 0) + 1
    return counts


def left_over(
    positive: np.ndarray, unlabelled: np.ndarray, n_p: int, n_u: int, prior: float
) -> np.ndarray:
    """Share of each group among the unlabelled texts, without the toxic ones among them.

    The prior and the positives tell how many these are. What is left cannot be negative: where it
    is below its standard error, zero is taken.
    """
    left = unlabelled / n_u - prior * positive / n_p
    error = np.sqrt(unlabelled / n_u**2 + prior**2 * positive / n_p**2)
    return np.where(left < error, 0.0, left)


def evidence_of(held_p: list[set], held_u: list[set], n: int, prior: float) -> np.ndarray:
    """Log odds of being toxic for texts with a feature, each feature by itself."""
    p = np.bincount([k for h in held_p for k in h], minlength=n).astype(float)
    u = np.bincount([k for h in held_u for k in h], minlength=n).astype(float)
    toxic = prior * (p + 0.5) / len(held_p)
    other = left_over(p, u, len(held_p), len(held_u), prior) + 0.5 * (1 - prior) / len(held_u)
    return np.clip(np.log(toxic / other), -3.0, 3.0)


def fit_weights(
    x_p: np.ndarray, x_u: np.ndarray, prior: float, steps: int = 1500, risk: str = GROUPED
) -> np.ndarray:
    """Logistic weights with the least non-negative risk, by gradient steps with momentum.

    The risk is the prior times the loss on the positives, plus the loss as negatives on what is left
    of the unlabelled texts. ``GROUPED`` keeps what is left from being negative for each group of texts with
    like evidence; ``PLAIN`` keeps the whole second part from it, as the estimator was published: where it
    falls below zero, a step leads back up.
    """
    x, row = np.unique(np.vstack([x_p, x_u]), axis=0, return_inverse=True)
    row = row.ravel()
    positive = np.bincount(row[: len(x_p)], minlength=len(x)).astype(float)
    unlabelled = np.bincount(row[len(x_p) :], minlength=len(x)).astype(float)
    group = np.where(x[:, 0] > 0, 1 + np.digitize(x[:, 1], (-1.0, 0.0, 1.0, 2.0)), 0)
    p, u = (np.bincount(group, c) for c in (positive, unlabelled))
    left = left_over(p, u, len(x_p), len(x_u), prior)
    toxic = prior * positive / len(x_p)
    grouped = unlabelled * (left / np.maximum(u, 1))[group]
    plain = unlabelled / len(x_u) - toxic
    w, mean, square = np.zeros((3, x.shape[1]))
    w[-1] = np.log(prior / (1 - prior))
    keep = np.append(np.full(len(w) - 1, 1e-4), 0.0)
    for t in range(1, steps + 1):
        f = x @ w
        # a toxic text costs log(1 + exp(-f)), another one log(1 + exp(f))
        if risk == GROUPED:
            pull = _sigmoid(f) * grouped - _sigmoid(-f) * toxic
        elif plain @ np.logaddexp(0.0, f) >= 0:
            pull = _sigmoid(f) * plain - _sigmoid(-f) * toxic
        else:
            pull = -_sigmoid(f) * plain
        g = pull @ x + keep * w
        mean = 0.9 * mean + 0.1 * g
        square = 0.999 * square + 0.001 * g * g
        rate = 0.1 / (1 + t / 500)
        w -= rate * (mean / (1 - 0.9**t)) / (np.sqrt(square / (1 - 0.999**t)) + 1e-8)
    return w


def fit_samples(positive: list, unlabelled: list, prior: float, risk: str = GROUPED) -> Model:
    """The ensemble on the word lists of both samples: one member on them, the others on samples
    drawn from them with replacement."""
    prior = min(max(prior, 1e-4), 0.9)
    positive, unlabelled = without_copies(positive), without_copies(unlabelled)
    names = choose_features(positive, unlabelled) if positive and unlabelled else []
    if not names:
        return Model((), np.zeros(0), np.array([[0.0, 0.0, 0.0, np.log(prior / (1 - prior))]]))
    place = {f: i for i, f in enumerate(names)}
    held_p, held_u = (
        [{place[f] for w in d for f in features_of(w) if f in place} for d in documents]
        for documents in (positive, unlabelled)
    )
    evidence = evidence_of(held_p, held_u, len(names), prior)
    x_p, x_u = inputs(held_p, evidence), inputs(held_u, evidence)
    rng = np.random.default_rng(0)
    members = [fit_weights(x_p, x_u, prior, risk=risk)]
    for _ in range(MEMBERS - 1):
        drawn = (x[rng.integers(0, len(x), len(x))] for x in (x_p, x_u))
        members.append(fit_weights(*drawn, prior, risk=risk))
    return Model(tuple(names), evidence, np.array(members))


def _sampled_words(documents: DataFrame, ids: DataFrame) -> list[tuple]:
    """Distinct words of the documents with the given ids, in the order of ids; of several rows with
    the same id, one."""

    def make(batches):
        for batch in batches:
            out = []
            for text in text_values(batch.column("text")):
                out.append(" ".join(sorted(set(words_of(text)))))
            yield pa.RecordBatch.from_arrays([batch.column("id"), pa.array(out, pa.string())], ["id", "words"])

    chosen = documents.join(F.broadcast(ids), "id", "left_semi")
    kind = documents.schema["id"].dataType.simpleString()
    words = chosen.mapInArrow(make, f"id {kind}, words string").groupBy("id").agg(F.min("words").alias("words"))
    table = words.toArrow().sort_by("id")
    return [tuple(sys.intern(w) for w in t.split(" ") if w) for t in table.column("words").to_pylist()]


def _order(word: str) -> int:
    return xxhash.xxh64_intdigest(word)


def fit(
    documents: DataFrame,
    labels: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    label_col: str = "toxic",
    prior: float | None = None,
    max_positive: int = MAX_POSITIVE,
    max_unlabelled: int = MAX_UNLABELLED,
    risk: str = GROUPED,
) -> Model:
    """Learn from the documents given: those labelled 1 are confirmed, all are unlabelled text.

    ``prior`` is the share of toxic text; by default the share of 1 among the labels given. Ids
    that are labelled both ways count as 1; null labels and ids do not count. The sample is bounded
    by ``max_positive`` and ``max_unlabelled`` documents, taken by hash, so that it does not depend
    on the order of rows; their words are all read. ``risk``: see :func:`fit_weights`. Without positives or without text all scores equal the prior.
    """
    marks = (
        labels.where(F.col(label_col).isNotNull() & F.col(id_col).isNotNull())
        .groupBy(F.col(id_col).alias("id")).agg(F.max(label_col).alias("mark"))
    )
    texts = documents.select(F.col(id_col).alias("id"), F.coalesce(text_col, F.lit("")).alias("text"))
    if prior is None:
        share = marks.agg(F.avg((F.col("mark") == 1).cast("int"))).first()[0]
        prior = 0.1 if share is None else float(share)
    # ranked by hash over ids alone, so that only sampled texts move
    rank = F.xxhash64("id")
    confirmed = marks.where("mark = 1").select("id").orderBy(rank, "id").limit(max_positive)
    every = texts.select("id").where("id is not null").distinct().orderBy(rank, "id").limit(max_unlabelled)
    positive, unlabelled = _sampled_words(texts, confirmed), _sampled_words(texts, every)
    return fit_samples(positive, unlabelled, prior, risk)


def with_score(
    df: DataFrame, model: Model, text_col: str = "text", out_col: str = "score"
) -> DataFrame:
    """Every row with its score from 0 to 1; null and empty texts get the score of no words. An
    input column of the same name is replaced, other columns pass through."""

    def make(batch):
        return [pa.array(model.score(text_values(batch.column(text_col))))]

    return with_derived(df, make, T.StructField(out_col, T.DoubleType()))
