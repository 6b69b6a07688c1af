"""Finding equal windows of many texts without pairs and without one task per window.

Texts are read in batches. A batch names its places by 64-bit hashes, settles what it can
among its own places, and asks about one place per name; questions travel in columns, one
row per batch and bucket of names. A bucket sees at most one question per name and batch,
however frequent the name is, and a task asks no second time about names it saw repeat.
Answers return to the batch, which writes one row per text.

A text is known by its doc_id and the hash of its content, so that rows that share a doc_id
keep apart; equal rows are judged alike. Rows without doc_id come first.
"""

from __future__ import annotations

import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from procrisk.llm.common import narrow, row_key, text_of

NO_ID = -(1 << 63)

#: Bytes of text in a batch, and of all texts per bucket of names.
BATCH_BYTES = 4 << 20
BUCKET_BYTES = 4 << 20
#: Frequent names a task remembers, at most; more are merely asked about again.
REMEMBERED = 500_000
#: Columns of a remembered place: id, content hash, start and the other half of its name.
PLACE = 4

QUESTIONS = (
    "bucket int, batch string, known boolean, ids binary, keys binary, owner binary, "
    "start binary, length binary, name binary, body binary"
)
ANSWERS = "batch string, ids binary, keys binary, owner binary, start binary, length binary"
RUNS = "_id long, text_key long, runs binary"

_MIX = np.uint64(0xBF58476D1CE4E5B9)
_ODD = np.uint64(0x9E3779B97F4A7C15)


def as_bytes(docs: DataFrame) -> DataFrame:
    """Rows (_id, text_key, raw) of whole texts."""
    return narrow(docs, "doc_id", "text").select(
        F.coalesce(F.col("doc_id").cast("long"), F.lit(NO_ID)).alias("_id"),
        row_key().alias("text_key"),
        text_of().cast("binary").alias("raw"),
    )


def buckets_for(docs: DataFrame) -> int:
    """Buckets that each hold the names of a bounded share of the texts."""
    size = docs.agg(F.sum(F.octet_length(text_of()))).first()[0] or 0
    least = 4 * int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return int(max(least, -(-size // BUCKET_BYTES)))


# -- Names ----------------------------------------------------------------------------


def mixed(values: np.ndarray) -> np.ndarray:
    values = values ^ (values >> np.uint64(31))
    values = values * _MIX
    return values ^ (values >> np.uint64(29))


def grams(names: np.ndarray, width: int) -> np.ndarray:
    """Names of every ``width`` consecutive items, built by doubling."""
    done, size, power, at = None, 0, names, 1
    while True:
        if width & at:
            if done is None:
                done, size = power, at
            else:
                n = min(len(done), len(power) - size)
                done = mixed(done[: max(n, 0)] * _ODD + power[size:][: max(n, 0)])
                size += at
        if at * 2 > width:
            return done[: max(len(names) - width + 1, 0)]
        n = max(len(power) - at, 0)
        power = mixed(power[:n] * _ODD + power[at:])
        at *= 2


def last_minima(values: np.ndarray, width: int) -> np.ndarray:
    """For every ``width`` consecutive values the place of the smallest, the last of equals."""
    n = len(values) - width + 1
    if n <= 0:
        return np.zeros(0, dtype=np.int32)
    v, p, s = values, np.arange(len(values), dtype=np.int32), 1
    while s * 2 <= width:
        take = v[s:] <= v[:-s]
        v, p = np.where(take, v[s:], v[:-s]), np.where(take, p[s:], p[:-s])
        s *= 2
    r = width - s
    if r:
        p = np.where(v[r:] <= v[:-r], p[r:], p[:-r])
    return p[:n]


def joined(raws: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Texts one after the other, a space behind each, and where each begins; one more
    entry tells the end."""
    sizes = np.fromiter((len(r) + 1 for r in raws), dtype=np.int64, count=len(raws))
    begins = np.concatenate([[0], np.cumsum(sizes)])
    return np.frombuffer(b" ".join(raws) + b" ", dtype=np.uint8), begins


_SPACE = np.zeros(256, dtype=bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True
_powers: list[np.ndarray] = []


def power_tables(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of an odd number and of its inverse modulo 2^64."""
    if not _powers or len(_powers[0]) < n:
        base = 0x9E3779B97F4A7C15
        size = 1 << max(n - 1, 1).bit_length()
        tables = []
        for b in (base, pow(base, -1, 1 << 64)):
            table = np.full(size, b, dtype=np.uint64)
            table[0] = 1
            tables.append(np.multiply.accumulate(table))
        _powers[:] = tables
    return _powers[0], _powers[1]


def word_names(text: np.ndarray, gaps: np.ndarray = _SPACE) -> tuple[np.ndarray, np.ndarray]:
    """Names of the words of a text that ends in a gap, and where each begins."""
    gap = gaps[text]
    edge = np.flatnonzero(gap[1:] != gap[:-1]) + 1
    if len(text) and not gap[0]:
        edge = np.concatenate([[0], edge])
    begin, end = edge[::2], edge[1::2]
    power, inverse = power_tables(len(text) + 1)
    total = np.concatenate(
        [np.zeros(1, np.uint64), np.cumsum((text.astype(np.uint64) + np.uint64(1)) * power[: len(text)])]
    )
    names = (total[end] - total[begin]) * inverse[begin]
    return mixed(names + (end - begin).astype(np.uint64) * _ODD), begin


# -- Questions ------------------------------------------------------------------------


class Frequent:
    """Names a task has asked about and saw repeat, with the place it asked for
    (``PLACE`` columns)."""

    def __init__(self):
        self.name = np.zeros(0, dtype=np.uint64)
        self.place = np.zeros((0, PLACE), dtype=np.int64)

    def find(self, names: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Which of ``names`` are remembered, and where."""
        if not len(self.name):
            return np.zeros(len(names), dtype=bool), np.zeros(len(names), dtype=np.int64)
        at = np.minimum(np.searchsorted(self.name, names), len(self.name) - 1)
        return self.name[at] == names, at

    def add(self, names: np.ndarray, places: np.ndarray) -> None:
        new = ~self.find(names)[0]
        if len(self.name) + new.sum() > REMEMBERED:
            return
        name = np.concatenate([self.name, names[new]])
        place = np.concatenate([self.place, places[new]])
        order = np.argsort(name)
        self.name, self.place = name[order], place[order]


def by_batch(
    rows: DataFrame, work: Callable[..., Iterator[dict]], limit: int = BATCH_BYTES
) -> DataFrame:
    """Questions of all batches; ``work(batch, rows, frequent)`` makes those of one. Rows are
    tuples whose third part is the text's bytes."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        part, number, held, size = TaskContext.get().partitionId(), 0, [], 0
        frequent = Frequent()

        def settled() -> pd.DataFrame:
            held.sort(key=lambda r: (r[0], r[1]))
            return pd.DataFrame(list(work(f"{part}-{number}", held, frequent)), columns=_COLUMNS)

        for frame in frames:
            for row in frame.itertuples(index=False, name=None):
                held.append(row)
                size += len(row[2]) + 1
                if size >= limit:
                    yield settled()
                    held, size, number = [], 0, number + 1
        if held:
            yield settled()

    return rows.mapInPandas(run, QUESTIONS)


_COLUMNS = [c.split()[0] for c in QUESTIONS.split(", ")]


def question_rows(
    batch: str,
    buckets: int,
    ids: np.ndarray,
    keys: np.ndarray,
    owner: np.ndarray,
    start: np.ndarray,
    name: np.ndarray,
    known_owner: np.ndarray,
    known_start: np.ndarray,
    length: np.ndarray | None = None,
    known_length: np.ndarray | None = None,
    body: Callable[[np.ndarray], bytes] | None = None,
) -> Iterator[dict]:
    """Open questions by bucket, and what is known already, which passes through one."""

    def row(bucket: int, known: bool, at, owner, start, length, name) -> dict:
        used, local = np.unique(owner, return_inverse=True)
        return {
            "bucket": bucket,
            "batch": batch,
            "known": known,
            "ids": ids[used].astype("<i8").tobytes(),
            "keys": keys[used].astype("<i8").tobytes(),
            "owner": local.astype("<u4").tobytes(),
            "start": start.astype("<i4").tobytes(),
            "length": b"" if length is None else length.astype("<i4").tobytes(),
            "name": b"" if name is None else name.astype("<u8").tobytes(),
            "body": body(at) if body is not None and not known else b"",
        }

    place = (name % np.uint64(buckets)).astype(np.int64)
    order = np.argsort(place, kind="stable")
    edges = np.flatnonzero(np.diff(place[order])) + 1
    for at in np.split(order, edges) if len(order) else ():
        yield row(
            int(place[at[0]]), False, at, owner[at], start[at],
            None if length is None else length[at], name[at],
        )
    if len(known_owner):
        home = zlib.crc32(batch.encode()) % buckets
        yield row(home, True, None, known_owner, known_start, known_length, None)


def ask_repeated(
    batch: str, buckets: int, ids, keys, owner, start, name, frequent: Frequent
) -> Iterator[dict]:
    """Questions that tell of each place whether its name occurs anywhere else."""
    kinds, first, which, count = np.unique(
        name, return_index=True, return_inverse=True, return_counts=True
    )
    asked, _ = frequent.find(kinds)
    twice = count >= 2
    known = (twice | asked)[which]
    open_at = first[~asked]
    frequent.add(kinds[twice & ~asked], np.zeros((int((twice & ~asked).sum()), PLACE), np.int64))
    yield from question_rows(
        batch, buckets, ids, keys, owner[open_at], start[open_at], name[open_at],
        owner[known], start[known],
    )


def kinds_of(name: np.ndarray, more: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of names of 128 bits in two halves: the first place of every kind, the kind of every
    place, and how many places each kind has."""
    order = np.lexsort((more, name))
    head = np.ones(len(name), dtype=bool)
    head[1:] = (name[order][1:] != name[order][:-1]) | (more[order][1:] != more[order][:-1])
    which = np.empty(len(name), dtype=np.int64)
    which[order] = np.cumsum(head) - 1
    first = order[head]
    return first, which, np.bincount(which, minlength=len(first))


def ask_later(
    batch: str, buckets: int, ids, keys, owner, start, name, more, frequent: Frequent
) -> Iterator[dict]:
    """Questions that tell of each place whether its name (``name`` and ``more``, 64 bits each)
    occurs at an earlier one: a smaller doc_id, then content hash, then start. Places must
    come in that order."""
    first, which, count = kinds_of(name, more)
    later = ~(
        (ids[owner] == ids[owner[first]][which])
        & (keys[owner] == keys[owner[first]][which])
        & (start == start[first][which])
    )
    asked, at = frequent.find(name[first])
    half = more[first].view(np.int64)
    own = np.stack([ids[owner[first]], keys[owner[first]], start[first], half], axis=1).astype(np.int64)
    if asked.any():
        seen = frequent.place[at]
        before = seen[:, 2] < own[:, 2]
        for c in (1, 0):
            before = (seen[:, c] < own[:, c]) | ((seen[:, c] == own[:, c]) & before)
        asked &= before & (seen[:, 3] == half)
    later |= asked[which]
    open_at = first[~asked]
    new = (count >= 2) & ~asked
    frequent.add(name[first][new], own[new])
    halves = more[open_at].astype("<u8")
    yield from question_rows(
        batch, buckets, ids, keys, owner[open_at], start[open_at], name[open_at],
        owner[later], start[later], body=lambda at: halves[at].tobytes(),
    )


# -- Answers --------------------------------------------------------------------------


def repeated(name, ids, keys, start) -> np.ndarray:
    """Places whose name occurs twice or more."""
    order = np.argsort(name)
    same = name[order][1:] == name[order][:-1]
    found = np.zeros(len(name), dtype=bool)
    found[order[1:][same]] = True
    found[order[:-1][same]] = True
    return found


def later(name, ids, keys, start) -> np.ndarray:
    """Places that are not the first of their name."""
    found = np.zeros(len(name), dtype=bool)
    at = np.flatnonzero(repeated(name, ids, keys, start))
    if not len(at):
        return found
    at = at[np.lexsort((start[at], keys[at], ids[at], name[at]))]
    head = np.concatenate([[True], name[at][1:] != name[at][:-1]])
    first = at[np.flatnonzero(head)[np.cumsum(head) - 1]]
    found[at] = ~(
        (ids[at] == ids[first]) & (keys[at] == keys[first]) & (start[at] == start[first])
    )
    return found


def answer(questions: DataFrame, rule: Callable[..., np.ndarray]) -> DataFrame:
    """Places for which ``rule(name, ids, keys, start)`` holds among all of their bucket. A
    question's body, if it has one, is the second half of its names."""

    def run(rows: pd.DataFrame) -> pd.DataFrame:
        out = [rows.loc[rows["known"], _ANSWERED]]
        rows = rows[~rows["known"]]
        if len(rows):
            owner = [np.frombuffer(b, "<u4") for b in rows["owner"]]
            ids = [np.frombuffer(b, "<i8")[o] for b, o in zip(rows["ids"], owner, strict=True)]
            keys = [np.frombuffer(b, "<i8")[o] for b, o in zip(rows["keys"], owner, strict=True)]
            start = [np.frombuffer(b, "<i4") for b in rows["start"]]
            name = np.concatenate([np.frombuffer(b, "<u8") for b in rows["name"]])
            more = np.frombuffer(b"".join(rows["body"]), "<u8")
            if len(more):
                name = kinds_of(name, more)[1].astype(np.uint64)
            found = rule(name, *(np.concatenate(x) for x in (ids, keys, start)))
            edge = np.cumsum([0, *map(len, owner)])
            told = []
            for k, (batch, i, y) in enumerate(
                zip(rows["batch"], rows["ids"], rows["keys"], strict=True)
            ):
                hit = found[edge[k] : edge[k + 1]]
                if hit.any():
                    told.append((batch, i, y, owner[k][hit].tobytes(), start[k][hit].tobytes(), b""))
            out.append(pd.DataFrame(told, columns=_ANSWERED))
        return pd.concat(out)

    return questions.groupBy("bucket").applyInPandas(run, ANSWERS)


_ANSWERED = [c.split()[0] for c in ANSWERS.split(", ")]


def merged_runs(text: np.ndarray, start: np.ndarray, length: np.ndarray):
    """Overlapping or touching runs of each text united; sorted by text and start."""
    order = np.lexsort((start, text))
    text, start = text[order].astype(np.int64), start[order].astype(np.int64)
    end = start + length[order]
    shift = text << np.int64(33)
    reach = np.maximum.accumulate(end + shift)
    head = np.concatenate([[True], (start + shift)[1:] > reach[:-1]])
    begins = np.flatnonzero(head)
    last = np.concatenate([begins[1:], [len(text)]]) - 1
    return text[begins], start[begins], reach[last] - shift[last] - start[begins]


def per_text(answers: DataFrame) -> DataFrame:
    """One row per text with its runs of places: pairs (start, length) of 32 bits. Equal rows
    of the input give equal rows here, of which one is kept."""

    def run(rows: pd.DataFrame) -> pd.DataFrame:
        owner = [np.frombuffer(b, "<u4") for b in rows["owner"]]
        ids = np.concatenate(
            [np.frombuffer(b, "<i8")[o] for b, o in zip(rows["ids"], owner, strict=True)]
        )
        keys = np.concatenate(
            [np.frombuffer(b, "<i8")[o] for b, o in zip(rows["keys"], owner, strict=True)]
        )
        start = np.concatenate([np.frombuffer(b, "<i4") for b in rows["start"]])
        length = np.concatenate(
            [
                np.frombuffer(b, "<i4") if b else np.ones(len(o), np.int32)
                for b, o in zip(rows["length"], owner, strict=True)
            ]
        )
        both = np.stack([ids, keys], axis=1)
        texts, which = np.unique(both, axis=0, return_inverse=True)
        text, start, length = merged_runs(which.reshape(-1), start, length)
        pairs = np.stack([start, length], axis=1).astype("<i4")
        edge = np.searchsorted(text, np.arange(len(texts) + 1))
        return pd.DataFrame(
            {
                "_id": texts[:, 0],
                "text_key": texts[:, 1],
                "runs": [
                    pairs[a:b].tobytes() for a, b in zip(edge[:-1], edge[1:], strict=True)
                ],
            }
        )

    found = answers.groupBy("batch").applyInPandas(run, RUNS)
    return found.groupBy("_id", "text_key").agg(F.max("runs").alias("runs"))


def run_places(blob: bytes | None) -> np.ndarray:
    """All places of a text's runs."""
    if not blob:
        return np.zeros(0, dtype=np.int64)
    pairs = np.frombuffer(blob, "<i4").reshape(-1, 2).astype(np.int64)
    first = np.repeat(pairs[:, 0], pairs[:, 1])
    step = np.arange(len(first)) - np.repeat(np.cumsum(pairs[:, 1]) - pairs[:, 1], pairs[:, 1])
    return first + step


def covered(blob: bytes | None, width: int, n: int) -> np.ndarray:
    """Which of ``n`` items lie in a window of ``width`` that starts in one of the runs."""
    change = np.zeros(n + 1, dtype=np.int64)
    if blob:
        pairs = np.frombuffer(blob, "<i4").reshape(-1, 2).astype(np.int64)
        np.add.at(change, np.minimum(pairs[:, 0], n), 1)
        np.add.at(change, np.minimum(pairs[:, 0] + pairs[:, 1] - 1 + width, n), -1)
    return np.cumsum(change[:n]) > 0
