"""Secret scans with a random forest that removes false positives.

A pattern proposes candidates, generously; the forest, trained from labelled findings, judges each by
its length, its character transitions, how much of it dictionary words cover, the path of its
document and the words beside it.
"""

from __future__ import annotations

import math
import re
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillsight.llm.common import discard, plus, spill, text_values

#: bounds of the fitting sample and of what is learned from it
MAX_FINDINGS = 20000
MAX_NEIGHBOURS = 500
MAX_PATHS = 500
MAX_DICTIONARY = 5000
TREES, DEPTH, BINS, LEAST_LEAF = 40, 10, 32, 2
THRESHOLD = 0.5
MARK = "[REDACTED]"

FINDING = T.StructType(
    [
        T.StructField("start", T.LongType()),
        T.StructField("length", T.LongType()),
        T.StructField("probability", T.DoubleType()),
        T.StructField("is_secret", T.BooleanType()),
    ]
)

# Names that a secret is assigned to.
SECRET_NAMES = (
    "token", "secret", "password", "passwd", "pwd", "api_key", "apikey", "access_key", "auth",
    "credential", "private_key", "client_secret",
)

_CANDIDATE = re.compile(r"(?<![A-Za-z0-9+/_=\-])[A-Za-z0-9+/_=\-]{16,}")
_LEAST = 16
_IS = re.compile(r"(?<!=)=++(?=[^=])")
_ASSIGNED = re.compile(
    r"([A-Za-z_][A-Za-z0-9_\-]*)[\"']?\s{0,3}(?::=|=>|=+|:)\s{0,3}([\"']?)"
    r"(?:(?:[Bb]earer|BEARER|[Bb]asic|BASIC|[Tt]oken)\s{1,3})?$"
)
_BEARER = re.compile(r"\b(?:[Bb]earer|BEARER)\s{1,3}$")
_DOTTED = re.compile(r"eyJ[A-Za-z0-9_\-]+\.[A-Za-z0-9_\-]+(?:\.[A-Za-z0-9_\-]*)*")
_LEAST_GIVEN = 6
_SIGN = re.compile(r":=|=>|=+|:")
_NAMED = re.compile(r"([A-Za-z_][A-Za-z0-9_\-]*)[\"']?\s{0,3}$")
_SCHEME = r"(?:(?:[Bb]earer|BEARER|[Bb]asic|BASIC|[Tt]oken)\s{1,3})?"
# a quoted value, with the other quote in it only if there is no white space, or one up to white
# space, a quote or the next parameter
_GIVEN = re.compile(
    r"\s{0,3}(?:(?P<quote>[\"'])" + _SCHEME
    + r"(?:(?P<quoted>(?:\\.|[^\"'\\\r\n])*)|(?P<tight>(?:\\.|(?!(?P=quote))[^\\\s])*))(?P=quote)"
    r"|[\"']?" + _SCHEME + r"(?P<bare>(?:(?![&;,](?:\s|$|[A-Za-z_][A-Za-z0-9_\-]*[=:]))[^\s\"'`<>])+))"
)
# Formats of keys that issuers give out.
_KNOWN = re.compile(
    r"(?<![A-Za-z0-9])(?:(?:AKIA|ASIA)[A-Z0-9]{16}|gh[pousr]_[A-Za-z0-9]{20,}|github_pat_[A-Za-z0-9_]{20,}"
    r"|glpat-[A-Za-z0-9_\-]{16,}|xox[abeoprs]-[A-Za-z0-9\-]{12,}|[sr]k_(?:live|test)_[A-Za-z0-9]{16,}"
    r"|AIza[A-Za-z0-9_\-]{35}|npm_[A-Za-z0-9]{30,}|eyJ[A-Za-z0-9_\-]{8,}\.[A-Za-z0-9_\-]{8,}"
    r"(?:\.[A-Za-z0-9_\-]*)*)(?![A-Za-z0-9])"
)
# what may be a sentence, a call or an address, and so is not certain
_OPEN = re.compile(r"\s|[(\[{]|://")
_VARIABLE = re.compile(r"\$\{\w+\}?|\$[A-Z_]+|%\w+%")
# What is certainly no secret: dates, ids, paths, words; digests are ids behind their name.
_DATE = re.compile(r"(?:19|20)\d\d([\-/]?)[01]\d\1[0-3]\d(?:[T_\-]?[\d\-]*)?Z?")
_ID = re.compile(r"[\d\-/+]+|[0-9A-Fa-f]{8}(?:-[0-9A-Fa-f]{4}){3}-[0-9A-Fa-f]{12}")
_WORDS = re.compile(r"[/\-_+=]*(?:(?:[A-Z]?[a-z]+|[A-Z]+|[a-z]+\d{1,2}|\d{1,4})(?:[/\-_+=]+|$))+")
_DIGEST = re.compile(r"[0-9A-Fa-f]{16,}")
_DIGEST_NAME = re.compile(
    r"\b(?:commit|checksum|digest|md5|sha-?\d*|hash|etag|revision|uuid|guid)\b[\"']?\s{0,3}[=:]?\s{0,3}[\"']?$", re.I
)
_WORD = re.compile(r"[^\W\d_]+(?:_[^\W\d_]+)*")
_BESIDE = 48
_FEATURES = (
    "length", "transitions", "digits", "hex", "upper", "signs", "entropy", "covered", "assigned",
    "quoted", "before", "after", "path", "path_depth",
)


def _values(text: str, start: int, end: int) -> list[tuple[int, int]]:
    """A run of key characters, cut behind each ``name=``; ``=`` at the end belongs to the value."""
    out = []
    for m in _IS.finditer(text, start, end):
        if m.end() < end:
            if _KNOWN.fullmatch(text, start, m.start()):
                out.append((start, m.start()))
            start = m.end()
    return [*out, (start, end)]


def _secret_name(name: str) -> bool:
    low = name.lower().replace("-", "_")
    return any(n in low for n in SECRET_NAMES)


def _given(text: str) -> list[tuple[int, int, int]]:
    """``(start of the name, start, end)`` of whole values of at least 6 signs of any kind that are
    assigned to the name of a secret, in order: what stands in the quotes, or up to white space."""
    out, done = [], 0
    for sign in _SIGN.finditer(text):
        if sign.start() < done:
            continue
        name = _NAMED.search(text, max(0, sign.start() - _BESIDE), sign.start())
        if not name or not _secret_name(name[1]) or not (m := _GIVEN.match(text, sign.end())):
            continue
        s, e = m.span(next(k for k in ("quoted", "tight", "bare") if m[k] is not None))
        if m["bare"]:
            e = s + len(text[s:e].rstrip(",;)]}."))
        if e - s >= _LEAST_GIVEN:
            out.append((name.start(1), s, e))
            done = e
    return out


def candidates(text: str) -> list[tuple[int, int]]:
    """Spans that may be secrets, in order and apart from each other.

    Values assigned to the name of a secret, whole; else runs of at least 16 key characters that
    hold a digit, have a known format or stand behind an assignment. The name before a ``=`` is no
    part of the value; a web token is one span, dots included."""
    given = _given(text)
    if not given:
        return _bare(text, 0, len(text))
    out, at = [], 0
    for name, s, e in given:
        out += [*_bare(text, at, name), (s, e)]
        at = e
    return out + _bare(text, at, len(text))


def _bare(text: str, start: int, end: int) -> list[tuple[int, int]]:
    out, done = [], start
    for m in _CANDIDATE.finditer(text, start, end):
        if m.end() <= done:
            continue
        for s, e in _values(text, max(m.start(), done), m.end()):
            if text.startswith("eyJ", s) and (dotted := _DOTTED.match(text, s, end)):
                e = done = dotted.end()
            value = text[s:e]
            if len(value) < _LEAST:
                continue
            near = max(0, s - _BESIDE)
            if any(c.isdigit() for c in value) or _KNOWN.search(value) or (
                value.isalpha() and (_ASSIGNED.search(text, near, s) or _BEARER.search(text, near, s))
            ):
                out.append((s, e))
    return out


@dataclass(frozen=True)
class Context:
    """What is learned about words and paths: a log odds each, and the dictionary."""

    before: dict
    after: dict
    path: dict
    dictionary: frozenset


def _beside(text: str, start: int, end: int) -> tuple[list[str], list[str]]:
    before = _WORD.findall(text[max(0, start - _BESIDE) : start].lower())[-2:]
    after = _WORD.findall(text[end : end + _BESIDE].lower())[:2]
    return before, after


def _kind(c: str) -> int:
    return 0 if c.isdigit() else 1 if c.islower() else 2 if c.isupper() else 3


def coverage(value: str, dictionary: frozenset) -> float:
    """Share of the characters that dictionary words of at least four letters cover, longest first."""
    low, at, covered = value.lower(), 0, 0
    while at < len(low):
        for n in range(min(12, len(low) - at), 3, -1):
            if low[at : at + n] in dictionary:
                covered += n
                at += n
                break
        else:
            at += 1
    return covered / max(1, len(low))


def features(text: str, start: int, end: int, path: str, context: Context) -> list[float]:
    value = text[start:end]
    n = len(value)
    kinds = [_kind(c) for c in value]
    counts = [value.count(c) / n for c in set(value)]
    assigned = _ASSIGNED.search(text, max(0, start - _BESIDE), start)
    before, after = _beside(text, start, end)
    return [
        float(n),
        sum(a != b for a, b in zip(kinds, kinds[1:])) / n,
        kinds.count(0) / n,
        sum(c in "0123456789abcdefABCDEF" for c in value) / n,
        kinds.count(2) / n,
        kinds.count(3) / n,
        -sum(p * math.log2(p) for p in counts),
        coverage(value, context.dictionary),
        float(assigned is not None),
        float(text[end : end + 1] in ('"', "'") and text[max(0, start - 1) : start] in ('"', "'")),
        max((context.before.get(w, 0.0) for w in before), default=0.0, key=abs),
        max((context.after.get(w, 0.0) for w in after), default=0.0, key=abs),
        context.path.get(path, 0.0),
        float(path.count("/")),
    ]


@dataclass(frozen=True)
class Tree:
    feature: np.ndarray
    limit: np.ndarray
    left: np.ndarray
    right: np.ndarray
    value: np.ndarray

    def predict(self, x: np.ndarray) -> np.ndarray:
        node = np.zeros(len(x), np.int64)
        for _ in range(DEPTH + 1):
            inner = self.feature[node] >= 0
            if not inner.any():
                break
            at = np.flatnonzero(inner)
            f = self.feature[node[at]]
            below = x[at, f] <= self.limit[node[at]]
            node[at] = np.where(below, self.left[node[at]], self.right[node[at]])
        return self.value[node]


@dataclass(frozen=True)
class Model:
    trees: tuple
    context: Context

    def probability(self, x: np.ndarray) -> np.ndarray:
        if not self.trees or not len(x):
            return np.zeros(len(x))
        return np.mean([t.predict(x) for t in self.trees], axis=0)


def grow_tree(x: np.ndarray, y: np.ndarray, seed: int) -> Tree:
    """One tree on a bootstrap sample: Gini splits at quantile cuts, a random subset of the features
    at each node."""
    rng = np.random.default_rng(seed)
    cuts = [np.unique(np.quantile(x[:, f], np.linspace(0, 1, BINS)[1:-1])) for f in range(x.shape[1])]
    binned = np.stack([np.searchsorted(c, x[:, f]) for f, c in enumerate(cuts)], axis=1)
    tried = max(2, round(math.sqrt(x.shape[1])) + 1)
    nodes: list[list] = []
    waiting = [(rng.integers(0, len(x), len(x)), 0, -1, 0)]
    while waiting:
        rows, depth, parent, side = waiting.pop()
        place, labels = len(nodes), y[rows]
        if parent >= 0:
            nodes[parent][2 + side] = place
        share = float(labels.mean())
        nodes.append([-1, 0.0, 0, 0, share])
        if depth >= DEPTH or share in (0.0, 1.0) or len(rows) < 2 * LEAST_LEAF:
            continue
        best = (share * (1 - share) * len(rows) - 1e-12, -1, 0)
        for f in rng.permutation(x.shape[1])[:tried]:
            if not len(cuts[f]):
                continue
            n = np.cumsum(np.bincount(binned[rows, f], minlength=len(cuts[f]) + 1))[:-1]
            p = np.cumsum(np.bincount(binned[rows, f], labels, len(cuts[f]) + 1))[:-1]
            m, q = len(rows) - n, labels.sum() - p
            with np.errstate(divide="ignore", invalid="ignore"):
                cost = p * (1 - p / n) + q * (1 - q / m)
            cost[(n < LEAST_LEAF) | (m < LEAST_LEAF)] = np.inf
            k = int(np.argmin(cost))
            if cost[k] < best[0]:
                best = (cost[k], int(f), k)
        if best[1] >= 0:
            _, f, k = best
            nodes[place][0], nodes[place][1] = f, float(cuts[f][k])
            below = binned[rows, f] <= k
            waiting.append((rows[below], depth + 1, place, 0))
            waiting.append((rows[~below], depth + 1, place, 1))
    columns = list(zip(*nodes))
    kinds = (np.int64, float, np.int64, np.int64, float)
    return Tree(*(np.array(c, k) for c, k in zip(columns, kinds)))


_SAMPLE = "path string, before string, value string, after string, is_secret int"


def _around(text: str, start: int, end: int) -> tuple[str, str]:
    return text[max(0, start - _BESIDE) : start], text[end : end + _BESIDE]


def findings(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(id, start, length)`` of every candidate, positions in characters."""

    def run(batches):
        for batch in batches:
            ids = batch.column("id").to_pylist()
            rows = [
                (i, s, e - s)
                for i, t in zip(ids, text_values(batch.column("text")))
                for s, e in candidates(t)
            ]
            yield pa.RecordBatch.from_arrays(
                [pa.array([r[k] for r in rows], pa.int64()) for k in range(3)],
                [id_col, "start", "length"],
            )

    rows = df.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    return rows.mapInArrow(run, f"`{id_col}` long, start long, length long")


def weak_labels(text: str) -> list[tuple[int, int, int | None]]:
    """Candidates with what is certain about them: 1 for a known format of keys and for a value of
    letters and digits, or quoted, that is assigned to the name of a secret or follows Bearer, unless
    it looks like a sentence, a call or an address; 0 for variables, dates, ids, paths and words; None
    for all others."""
    return [(s, e, _certain(text, s, e)) for s, e in candidates(text)]


def _certain(text: str, s: int, e: int) -> int | None:
    value, near = text[s:e], max(0, s - _BESIDE)
    if _KNOWN.search(value):
        return 1
    if _DATE.fullmatch(value):
        return 0
    m = _ASSIGNED.search(text, near, s)
    if m and _secret_name(m[1]) or _BEARER.search(text, near, s):
        mixed = any(c.isdigit() for c in value) and any(c.isalpha() for c in value)
        quoted = bool(m and m[2])
        if _VARIABLE.fullmatch(value) or not quoted and value.isalpha() and value[1:].islower():
            return 0
        quoted = quoted and (len(value) >= _LEAST or not value.isalpha())
        return 1 if (mixed or quoted) and not _OPEN.search(value) else None
    if _ID.fullmatch(value) or _WORDS.fullmatch(value):
        return 0
    return 0 if _DIGEST.fullmatch(value) and _DIGEST_NAME.search(text, near, s) else None


def fit(
    documents: DataFrame,
    labelled: DataFrame | None = None,
    id_col: str = "doc_id",
    text_col: str = "text",
    path_col: str | None = "source",
    max_findings: int = MAX_FINDINGS,
) -> Model:
    """Learn from labelled findings ``(id, start, length, is_secret)`` of ``documents``.

    Without ``labelled``, the candidates of the documents of which :func:`weak_labels` is certain are
    the findings; each also counts once without its neighbourhood, so that the forest learns the
    value itself and can judge the candidates that are left, bare keys among them. At
    most ``max_findings`` findings are used, taken by hash; each travels with its neighbourhood
    only, not with its document. Trees are grown by Spark tasks, one each. Rows with null label or
    id do not count; without findings of both kinds nothing is ever called a secret if no finding
    is one, and everything if all are.
    """
    path = F.coalesce(F.col(path_col).cast("string"), F.lit("")) if path_col else F.lit("")
    rows = documents.select(
        F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"), path.alias("path")
    )
    told = labelled is not None
    if told:
        marks = labelled.where(f"`{id_col}` is not null and is_secret is not null").select(
            F.col(id_col).cast("long").alias("id"), "start", "length",
            F.col("is_secret").cast("int").alias("mark"),
        )
        marks = marks.orderBy(F.xxhash64("id", "start"), "id", "start").limit(max_findings)
        spans = marks.groupBy("id").agg(F.collect_list(F.struct("start", "length", "mark")).alias("spans"))
        rows = rows.join(F.broadcast(spans), "id")

    def run(batches):
        for batch in batches:
            out = []
            paths = batch.column("path").to_pylist()
            given = batch.column("spans").to_pylist() if told else None
            for k, text in enumerate(text_values(batch.column("text"))):
                spans = (
                    [(x["start"], x["start"] + x["length"], x["mark"]) for x in given[k]]
                    if given is not None else weak_labels(text)
                )
                for s, e, mark in spans:
                    if mark is not None and 0 <= s < e <= len(text):
                        before, after = _around(text, s, e)
                        out.append((paths[k], before, text[s:e], after, mark))
            columns = list(zip(*out)) if out else [[]] * 5
            kinds = [pa.string()] * 4 + [pa.int32()]
            yield pa.RecordBatch.from_arrays(
                [pa.array(list(c), t) for c, t in zip(columns, kinds)],
                ["path", "before", "value", "after", "is_secret"],
            )

    sample = rows.mapInArrow(run, _SAMPLE)
    order = F.xxhash64("value", "before", "after", "path")
    # copies of a finding are one, and each label has its share, so that no key or kind crowds out the others
    distinct = spill(sample.distinct(), "distinct")
    each = [
        distinct.where(F.col("is_secret") == mark).orderBy(order, "value").limit(max_findings // 2)
        for mark in (0, 1)
    ]
    # written first: the least of all tasks meet on an executor, and only the sample comes here
    chosen = spill(each[0].unionByName(each[1]), "findings")
    table = sorted(chosen.toArrow().to_pylist(), key=lambda r: tuple(map(str, r.values())))
    discard(chosen, distinct)
    return _fit_sample(documents.sparkSession, table, alone=not told)


def _odds(groups: list[tuple[str, int]], most: int) -> dict[str, float]:
    """Smoothed log odds of being a secret by word, against the odds of all; the most seen words."""
    counts: dict[str, list[int]] = {}
    for word, mark in groups:
        counts.setdefault(word, [0, 0])[mark] += 1
    total = np.sum(list(counts.values()), axis=0) + 1 if counts else np.ones(2)
    base = math.log(total[1] / total[0])
    seen = sorted(counts, key=lambda w: (-sum(counts[w]), w))[:most]
    return {
        w: math.log((counts[w][1] + 1) / (counts[w][0] + 1)) - base
        for w in seen if sum(counts[w]) >= 3
    }


def _fit_sample(spark, sample: list[dict], alone: bool) -> Model:
    before, after, paths, words = [], [], [], {}
    for r in sample:
        mark = r["is_secret"]
        b, a = _beside(r["before"] + r["value"] + r["after"], len(r["before"]), len(r["before"]) + len(r["value"]))
        before += [(w, mark) for w in set(b)]
        after += [(w, mark) for w in set(a)]
        paths.append((r["path"], mark))
        for w in _WORD.findall((r["before"] + " " + r["after"]).lower()):
            if len(w) >= 4:
                words[w] = words.get(w, 0) + 1
    dictionary = frozenset(sorted(words, key=lambda w: (-words[w], w))[:MAX_DICTIONARY])
    context = Context(
        _odds(before, MAX_NEIGHBOURS), _odds(after, MAX_NEIGHBOURS), _odds(paths, MAX_PATHS), dictionary
    )
    if not sample:
        return Model((), context)
    if alone:
        sample = sample + [r | {"before": "", "after": ""} for r in sample]
    x = np.array(
        [
            features(r["before"] + r["value"] + r["after"], len(r["before"]),
                     len(r["before"]) + len(r["value"]), r["path"], context)
            for r in sample
        ]
    )
    y = np.array([r["is_secret"] for r in sample], float)

    def grow(frames):
        import pickle

        for frame in frames:
            trees = [pickle.dumps(grow_tree(x, y, int(s))) for s in frame["id"]]
            yield pd.DataFrame({"id": frame["id"], "tree": trees})

    import pickle

    grown = spark.range(0, TREES, 1, 8).mapInPandas(grow, "id long, tree binary").orderBy("id").collect()
    return Model(tuple(pickle.loads(r["tree"]) for r in grown), context)


def judge(model: Model, text: str, path: str) -> list[tuple[int, int, float]]:
    """``(start, end, probability)`` of each candidate. Only the neighbourhood is looked at, as in
    the labelled findings."""
    out, x = candidates(text), []
    for s, e in out:
        before, after = _around(text, s, e)
        x.append(features(before + text[s:e] + after, len(before), len(before) + e - s, path, model.context))
    p = model.probability(np.array(x).reshape(-1, len(_FEATURES)))
    return [(s, e, round(float(q), 6)) for (s, e), q in zip(out, p)]


def scan(
    df: DataFrame,
    model: Model,
    text_col: str = "text",
    path_col: str | None = "source",
    redact: bool = False,
    threshold: float = THRESHOLD,
    out_col: str = "findings",
) -> DataFrame:
    """Every row with ``findings``: start, length (in characters), probability and the verdict.

    With ``redact`` the text comes back with each secret replaced by a mark; findings keep the
    positions of the text before that. Null and empty texts have no findings and stay as they are, a
    null path counts as empty, equal rows are judged alike, an input column named ``findings`` is
    replaced, other columns pass through, an empty table stays empty. The step is narrow.
    """
    if path_col is not None and path_col not in df.columns:
        raise ValueError(f"no column {path_col}")
    schema = plus(df.schema, T.StructField(out_col, T.ArrayType(FINDING)))
    names = schema.names
    kind = pa.list_(pa.struct([
        ("start", pa.int64()), ("length", pa.int64()), ("probability", pa.float64()), ("is_secret", pa.bool_()),
    ]))

    def run(batches):
        for batch in batches:
            texts = batch.column(text_col).to_pylist()
            paths = batch.column(path_col).to_pylist() if path_col else [""] * len(texts)
            found, clean = [], []
            for text, path in zip(texts, paths):
                own = judge(model, text, str(path) if path is not None else "") if text else []
                found.append([
                    {"start": s, "length": e - s, "probability": p, "is_secret": p >= threshold}
                    for s, e, p in own
                ])
                for s, e, p in reversed(own):
                    if p >= threshold:
                        text = text[:s] + MARK + text[e:]
                clean.append(text)
            made = {out_col: pa.array(found, kind)}
            if redact:
                made[text_col] = pa.array(clean, pa.string())
            yield pa.RecordBatch.from_arrays(
                [made[n] if n in made else batch.column(n) for n in names], names
            )

    return df.mapInArrow(run, schema)
