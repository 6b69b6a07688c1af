"""Toxic spans and scores from a linear-chain conditional random field.

Training reads a bounded sample of labelled documents. Labels are given per document; tokens
get theirs from it: a token of a toxic document is labelled toxic if its word, or a stem of
it, is much denser in toxic documents than in others. The field tags tokens by word, stem
and ending features and by the tag before. Forward-backward gives each token's marginal
probability; the marginals of a text (their sum, their largest, their density) are
aggregated to a score by a logistic regression that was fitted on marginals of documents
the field had not seen. Scoring is one Arrow pass over whole texts.

Sequences are the tokens of a line, cut after ``SEQUENCE`` tokens.

Defined cases: a null, empty or wordless text has no token and gets the score of empty
marginals; without both classes among the labelled rows every score is the share of label 1
(0 if there is none); repeated rows get equal scores; an empty table gives no rows. Labels
of other values than 0 and 1, and null, are not used.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter, defaultdict
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from procrisk.llm.common import narrow, text_of, with_null_ids, with_whole_ids

#: Bounds of the training sample: documents and characters of each class in expectation,
#: characters of one document. They bound fitting only; scoring reads everything.
MAX_DOCUMENTS = 1_500
MAX_CHARACTERS = 4_000_000
MAX_LENGTH = 60_000

SEQUENCE = 64
STEMS = (3, 4, 5, 6, 7)
ENDINGS = (3, 4)
PREDICT_AT = 0.7

#: A feature makes tokens toxic if it is this much denser in toxic documents (log), occurs
#: in so many of them, and its document counts differ by so many standard deviations.
DENSER = 2.2
MIN_DOCUMENTS = 3
DEVIATIONS = 4.0

#: Marginals below this say nothing about a text.
NOTED = 0.2

_TOKEN = re.compile(r"\w+|\n")
_CACHE = 200_000


def features(token: str) -> list[str]:
    """Word, stems and endings of a token, lower-cased."""
    word = token.lower()
    n = len(word)
    return (
        [word]
        + [word[:k] + "-" for k in STEMS if n >= k]
        + ["-" + word[-k:] for k in ENDINGS if n > k]
    )


@dataclass
class Model:
    """Weights of features that tell the tags apart, log transitions, and the weights that
    turn a text's marginals into a score."""

    weights: dict[str, float] = field(default_factory=dict)
    bias: float = -5.0
    transitions: tuple[float, ...] = (0.0, 0.0, 0.0, 0.0)
    score: tuple[float, ...] = (0.0,) * 5

    def __post_init__(self):
        self._known: dict[str, float] = {}

    def __getstate__(self):
        return self.__dict__ | {"_known": {}}

    def emission(self, token: str) -> float:
        """Odds of the toxic tag by the token alone."""
        known = self._known.get(token)
        if known is None:
            get = self.weights.get
            total = self.bias
            for f in features(token):
                total += get(f, 0.0)
            known = float(np.exp(min(max(total, -30.0), 30.0)))
            if len(self._known) >= _CACHE:
                self._known.clear()
            self._known[token] = known
        return known


# -- The chain ------------------------------------------------------------------------


def _sequences(breaks: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Starts and lengths of the sequences of ``n`` tokens broken before ``breaks``."""
    edges = np.unique(np.concatenate([[0], breaks, [n]]))
    edges = edges[(edges >= 0) & (edges <= n)]
    starts, lengths = edges[:-1], np.diff(edges)
    parts = -(-lengths // SEQUENCE)
    first = np.repeat(starts, parts)
    step = np.arange(parts.sum()) - np.repeat(np.cumsum(parts) - parts, parts)
    starts2 = first + step * SEQUENCE
    ends = np.minimum(starts2 + SEQUENCE, np.repeat(starts + lengths, parts))
    return starts2, ends - starts2


def marginals(
    odds: np.ndarray, starts: np.ndarray, lengths: np.ndarray, transitions, pairs: bool = False
):
    """Probability of the toxic tag for every token, by forward-backward over all sequences
    at once: step t handles the t-th token of each sequence that long. ``transitions`` are
    log weights of 0-0, 0-1, 1-0, 1-1. With ``pairs`` also the expected transition counts."""
    t00, t01, t10, t11 = np.exp(transitions)
    order = np.argsort(-lengths, kind="stable")
    starts, lengths = starts[order], lengths[order]
    longest = int(lengths[0]) if len(lengths) else 0
    active = np.searchsorted(-lengths, -np.arange(longest), side="left")
    forward, backward = np.empty_like(odds), np.ones_like(odds)
    for t in range(longest):
        at = starts[: active[t]] + t
        if t == 0:
            forward[at] = odds[at]
        else:
            a = forward[at - 1]
            forward[at] = odds[at] * (t01 + t11 * a) / (t00 + t10 * a)
    counts = np.zeros(4)
    for t in range(longest - 2, -1, -1):
        at = starts[: active[t + 1]] + t
        x = odds[at + 1] * backward[at + 1]
        backward[at] = (t10 + t11 * x) / (t00 + t01 * x)
        if pairs:
            a = forward[at]
            joint = np.stack([np.full_like(a, t00), t01 * x, t10 * a, t11 * a * x])
            counts += (joint / joint.sum(0)).sum(1)
    both = forward * backward
    p = both / (1 + both)
    return (p, counts) if pairs else p


# -- Training -------------------------------------------------------------------------


def _tokenise(texts: list[str]) -> tuple[list[str], np.ndarray, np.ndarray]:
    """All tokens, the positions before which a sequence breaks, and each text's first."""
    tokens: list[str] = []
    breaks, first = [], []
    for text in texts:
        first.append(len(tokens))
        breaks.append(len(tokens))
        for found in _TOKEN.findall(text):
            if found == "\n":
                breaks.append(len(tokens))
            else:
                tokens.append(found)
    first.append(len(tokens))
    return tokens, np.array(breaks, dtype=np.int64), np.array(first, dtype=np.int64)


def _distinct(texts: list[str], labels: np.ndarray) -> tuple[list[str], np.ndarray]:
    """Texts that are no near copy of an earlier one: half of the eight minima of their word
    hashes agree with those of one earlier text."""
    holders: dict[tuple[int, int], list[int]] = defaultdict(list)
    keep = []
    rng = np.random.default_rng(7)
    factors = rng.integers(1, 1 << 62, 8, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
    for k, text in enumerate(texts):
        words = np.array(
            [zlib.crc32(w.encode()) for w in set(text.split())] or [0], dtype=np.uint64
        )
        minima = [(j, int((words * f >> np.uint64(16)).min())) for j, f in enumerate(factors)]
        agree = Counter(t for m in minima for t in holders[m])
        if max(agree.values(), default=0) < 4:
            keep.append(k)
            for m in minima:
                holders[m].append(k)
    return [texts[k] for k in keep], labels[keep]


def _toxic_features(texts: list[str], labels: np.ndarray) -> set[str]:
    """Features denser in toxic documents by far, compared by capped counts per document."""
    held = ({}, {})
    docs = (defaultdict(int), defaultdict(int))
    totals = [1.0, 1.0]
    for text, label in zip(texts, labels, strict=True):
        counts: dict[str, int] = defaultdict(int)
        found = _TOKEN.findall(text)
        for token in found:
            if token != "\n":
                for f in features(token):
                    counts[f] += 1
        totals[label] += min(len(found), 2_000)
        for f, n in counts.items():
            held[label][f] = held[label].get(f, 0) + min(n, 6)
            docs[label][f] += 1
    n0, n1 = max(1, int((labels == 0).sum())), max(1, int((labels == 1).sum()))
    chosen = set()
    for f, c1 in held[1].items():
        d1, d0 = docs[1][f], docs[0].get(f, 0)
        if d1 < MIN_DOCUMENTS:
            continue
        rate = np.log((c1 + 0.3) / totals[1]) - np.log((held[0].get(f, 0) + 0.3) / totals[0])
        share = (d1 + d0) / (n0 + n1)
        apart = (d1 / n1 - d0 / n0) / np.sqrt(share * (1 - share) * (1 / n0 + 1 / n1) + 1e-12)
        if rate >= DENSER and apart >= DEVIATIONS:
            chosen.add(f)
    return chosen


def _fit_chain(texts: list[str], labels: np.ndarray, rounds: int = 90) -> Model:
    """Tag weights by gradient ascent (Adam) on the likelihood of the token labels."""
    toxic = _toxic_features(texts, labels)
    tokens, breaks, first = _tokenise(texts)
    if not tokens or not toxic:
        return Model()
    kinds = {t: k for k, t in enumerate(dict.fromkeys(tokens))}
    kind = np.fromiter((kinds[t] for t in tokens), dtype=np.int64, count=len(tokens))
    names: dict[str, int] = {}
    rows, columns = [], []
    marked = np.zeros(len(kinds), dtype=bool)
    for token, k in kinds.items():
        for f in features(token):
            rows.append(k)
            columns.append(names.setdefault(f, len(names)))
            marked[k] |= f in toxic
    rows, columns = np.array(rows), np.array(columns)
    owner = np.repeat(np.arange(len(texts)), np.diff(first))
    y = (marked[kind] & (labels[owner] == 1)).astype(float)
    starts, lengths = _sequences(breaks, len(tokens))
    inner = np.ones(len(tokens), dtype=bool)
    inner[starts] = False
    at = np.flatnonzero(inner)
    seen = np.bincount((2 * y[at - 1] + y[at]).astype(int), minlength=4).astype(float)

    n = len(tokens)
    w = np.zeros(len(names) + 1)
    w[-1] = -4.0
    trans = np.zeros(4)
    m, v = np.zeros(len(w) + 4), np.zeros(len(w) + 4)
    for step in range(1, rounds + 1):
        score = np.bincount(rows, w[columns], minlength=len(kinds)) + w[-1]
        odds = np.exp(np.clip(score, -30, 30))[kind]
        p, counts = marginals(odds, starts, lengths, trans, pairs=True)
        by_kind = np.bincount(kind, y - p, minlength=len(kinds))
        gradient = np.concatenate(
            [
                np.bincount(columns, by_kind[rows], minlength=len(names)) - 0.3 * w[:-1],
                [(y - p).sum()],
                seen - counts - 0.1 * trans,
            ]
        )
        m = 0.9 * m + 0.1 * gradient
        v = 0.98 * v + 0.02 * gradient**2
        move = 0.15 * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.98**step)) + 1e-8 * n)
        w += move[:-4]
        trans += move[-4:]
        trans -= trans[0]
    weights = {f: float(w[k]) for f, k in names.items() if abs(w[k]) > 0.02}
    return Model(weights, float(w[-1]), tuple(float(t) for t in trans))


def _profile(p: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Per text: 1, the sum of its marginals up to 3, that sum's logarithm, the largest one's
    log odds from -5 to 5, and the density. Marginals below ``NOTED`` are left out, or long
    clean texts would add up to something."""
    count = np.diff(first)
    p = np.where(p >= NOTED, p, 0.0)
    total = np.add.reduceat(np.append(p, 0.0), first[:-1]) if len(count) else np.zeros(0)
    top = np.maximum.reduceat(np.append(p, 0.0), first[:-1]) if len(count) else np.zeros(0)
    empty = count == 0
    total, top = np.where(empty, 0.0, total), np.where(empty, 0.0, top)
    density = np.minimum(1.0, 20 * total / np.maximum(count, 20))
    odds = np.log(np.maximum(top, 1e-9) / np.maximum(1 - top, 1e-9))
    return np.stack(
        [
            np.ones(len(count)),
            np.minimum(total, 3),
            np.log1p(total),
            np.clip(odds, -5, 5) / 5,
            density,
        ],
        axis=1,
    )


def _read(model: Model, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Marginals of all tokens and each text's first token."""
    tokens, breaks, first = _tokenise(texts)
    if not tokens:
        return np.zeros(0), first
    odds = np.fromiter(map(model.emission, tokens), dtype=float, count=len(tokens))
    return marginals(odds, *_sequences(breaks, len(tokens)), model.transitions), first


def _regress(x: np.ndarray, y: np.ndarray, rounds: int = 40) -> np.ndarray:
    """Logistic regression by Newton steps, lightly regularised. A measure that came out
    negative is left out and the rest fitted anew: more toxic tokens never lower a score."""
    used = np.ones(x.shape[1], dtype=bool)
    while True:
        held, w = x[:, used], np.zeros(int(used.sum()))
        penalty = np.full(len(w), 0.02)
        penalty[0] = 1e-4
        for _ in range(rounds):
            p = 1 / (1 + np.exp(-np.clip(held @ w, -30, 30)))
            gradient = held.T @ (y - p) - penalty * w
            curve = (held * (p * (1 - p))[:, None]).T @ held + np.diag(penalty + 1e-9)
            step = np.linalg.solve(curve, gradient)
            w += np.clip(step, -2, 2)
            if np.abs(step).max() < 1e-6:
                break
        negative = np.flatnonzero(w[1:] < 0)
        if not len(negative):
            whole = np.zeros(x.shape[1])
            whole[used] = w
            return whole
        used[np.flatnonzero(used)[1 + negative[np.argmin(w[1:][negative])]]] = False


def fit_model(texts: list[str], labels: np.ndarray, odds: float = 1.0) -> Model:
    """Model from texts and labels 0/1; ``odds`` multiplies the odds of label 1 to undo
    unequal sampling of the classes."""
    labels = np.asarray(labels, dtype=np.int64)
    order = sorted(range(len(texts)), key=lambda k: texts[k])
    texts, labels = [texts[k] for k in order], labels[order]
    if len(set(labels.tolist())) < 2:
        share = float(labels.mean()) if len(labels) else 0.0
        level = 30.0 if share else -30.0
        return Model(score=(level, 0.0, 0.0, 0.0, 0.0))
    alone, alone_labels = _distinct(texts, labels)
    folds = np.arange(len(alone)) % 3
    x, y = [], []
    for k in range(3):
        chain = _fit_chain(
            [t for t, f in zip(alone, folds, strict=True) if f != k], alone_labels[folds != k]
        )
        apart = [t for t, f in zip(alone, folds, strict=True) if f == k]
        if apart:
            x.append(_profile(*_read(chain, apart)))
            y.append(alone_labels[folds == k])
    w = _regress(np.concatenate(x), np.concatenate(y).astype(float))
    w[0] += np.log(odds)
    model = _fit_chain(alone, alone_labels)
    model.score = tuple(float(v) for v in w)
    return model


def held_out(doc_id: Column) -> Column:
    """Rows that are never trained on."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 3 == 1, F.lit(False))


def _drawn(share: dict[int, float], seed: int) -> Column:
    """Rows drawn by a hash of doc_id, of each class its share."""
    least = F.when(F.col("toxic") == 1, share.get(1, 0.0)).otherwise(share.get(0, 0.0))
    return F.pmod(F.xxhash64(F.col("doc_id"), F.lit(seed)), F.lit(1 << 20)) < least * (1 << 20)


def train(
    docs: DataFrame,
    labels: DataFrame,
    max_documents: int = MAX_DOCUMENTS,
    max_characters: int = MAX_CHARACTERS,
) -> Model:
    """Model from the labelled rows that are not held out, of which a sample bounded by
    ``max_documents`` and ``max_characters`` per class is drawn by a hash of doc_id."""
    known = (
        labels.where(F.col("toxic").isin(0, 1) & F.col("doc_id").isNotNull())
        .where(~held_out(F.col("doc_id")))
        .groupBy("doc_id")
        .agg(F.max("toxic").cast("int").alias("toxic"))
    )
    # The sample of the labels bounds what is joined to the texts; these are not shuffled.
    some = {r["toxic"]: min(1.0, max_documents / r["count"]) for r in known.groupBy("toxic").count().collect()}
    rows = (
        narrow(docs, "doc_id", "text")
        .where(F.length(text_of()).between(1, MAX_LENGTH))
        .join(F.broadcast(known.where(_drawn(some, 11))), "doc_id")
    )
    sizes = rows.groupBy("toxic").agg(F.sum(F.length("text")).alias("characters"))
    fewer = {r["toxic"]: min(1.0, max_characters / r["characters"]) for r in sizes.collect()}
    share = {k: some[k] * fewer[k] for k in fewer}
    if not share:
        return fit_model([], np.zeros(0))
    sample = rows.where(_drawn(fewer, 13)).select("text", "toxic").toPandas()
    odds = share.get(0, 1.0) / share.get(1, 1.0)
    return fit_model(sample["text"].tolist(), sample["toxic"].to_numpy(), odds)


# -- Scoring --------------------------------------------------------------------------


def score_texts(model: Model, texts: list[str]) -> tuple[np.ndarray, list[list[tuple[int, int]]]]:
    """Score and offending spans (code points, end exclusive) of each text."""
    p, first = _read(model, texts)
    x = _profile(p, first) @ np.array(model.score)
    scores = 1 / (1 + np.exp(-np.clip(x, -30, 30)))
    spans: list[list[tuple[int, int]]] = [[] for _ in texts]
    for k in np.unique(np.searchsorted(first, np.flatnonzero(p >= 0.5), side="right") - 1):
        places = [m.span() for m in _TOKEN.finditer(texts[k]) if m.group() != "\n"]
        for (a, b), q in zip(places, p[first[k] : first[k + 1]], strict=True):
            if q >= 0.5:
                spans[k].append((a, b))
    return scores, spans


def score(docs: DataFrame, model: Model, predict_at: float = PREDICT_AT) -> DataFrame:
    """doc_id, score, predicted and ``spans``, the toxic tokens' offsets, of every row."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            texts = batch["text"].tolist()
            for a, b in _slices(texts):
                scores, spans = score_texts(shared.value, texts[a:b])
                yield pd.DataFrame(
                    {
                        "_known": batch["_known"].iloc[a:b],
                        "doc_id": batch["doc_id"].iloc[a:b],
                        "score": scores,
                        "predicted": (scores >= predict_at).astype(np.int32),
                        "spans": [[{"start": s, "end": e} for s, e in found] for found in spans],
                    }
                )

    rows = narrow(docs, "doc_id", "text").select("doc_id", text_of().alias("text"))
    kind = rows.schema["doc_id"].dataType.simpleString()
    scored = with_whole_ids(rows).mapInPandas(
        run,
        f"_known boolean, doc_id {kind}, score double, predicted int, "
        "spans array<struct<start:int,end:int>>",
    )
    return with_null_ids(scored)


def _slices(texts: list[str], characters: int = 2_000_000) -> Iterator[tuple[int, int]]:
    """Ranges of texts of about ``characters`` in all, one at least."""
    a, held = 0, 0
    for b, text in enumerate(texts):
        held += len(text)
        if held >= characters:
            yield a, b + 1
            a, held = b + 1, 0
    if a < len(texts):
        yield a, len(texts)
