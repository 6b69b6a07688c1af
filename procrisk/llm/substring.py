"""Substring dedup on words: seed on winnowed anchors, extend, keep maximal repeats.

Seeds: of every 13 consecutive 8-grams of words the smallest hash is an anchor, so that two
equal windows of 20 words share an anchor at the same place. Anchors that occur twice or
more anywhere are found by joining the texts on them.

Extension: around each repeated anchor a match must reach ``width`` words, some to the left
and the rest to the right. All ways to extend both sides are the windows that chose this
anchor; they are named by their words and joined with the windows of all other texts at
once, which meets every partner without pairs. A window whose words also start earlier is
removed; touching and overlapping windows make the maximal repeats.

Equal hashes are taken as equal: 64 bits of anchors, which only propose, and 128 bits of
windows, in two halves.

Defined cases: a null text has no words; texts shorter than a window lose nothing; rows that
share a doc_id are ordered by content hash, and equal rows are judged alike (neither is
earlier than the other); an empty table gives no rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from procrisk.llm import windows
from procrisk.llm.common import beside
from procrisk.session import stage

WIDTH = 20
SEED = 8
#: An odd number that gives words a second name.
_OTHER = np.uint64(0xC2B2AE3D27D4EB4F)


def _places(rows: list[tuple], width: int, seed: int):
    """Seeds of a batch: names of the 8-grams and windows, for every window its text, its
    start within the text and the place of its anchor, and each text's first word."""
    text, begins = windows.joined([r[2] for r in rows])
    names, at = windows.word_names(text)
    first = np.searchsorted(at, begins)
    grams = windows.grams(names, seed)
    anchors = windows.last_minima(grams, width - seed + 1)
    owner = np.searchsorted(first, np.arange(len(anchors)), side="right") - 1
    whole = np.arange(len(anchors)) + width <= first[owner + 1] if len(anchors) else owner > 0
    window = np.flatnonzero(whole)
    return names, grams, first, owner[window], window, anchors[window]


def _identities(rows: list[tuple]) -> tuple[np.ndarray, np.ndarray]:
    return (
        np.array([r[0] for r in rows], dtype=np.int64),
        np.array([r[1] for r in rows], dtype=np.int64),
    )


def repeated_anchors(docs: DataFrame, buckets: int, width: int, seed: int) -> DataFrame:
    """Per text the places (first words) of its anchors that occur elsewhere too."""

    def work(batch, rows, frequent) -> Iterator[dict]:
        _, grams, first, owner, _, anchors = _places(rows, width, seed)
        new = np.flatnonzero(np.concatenate([[True], anchors[1:] != anchors[:-1]])[: len(anchors)])
        owner, anchors = owner[new], anchors[new]
        ids, keys = _identities(rows)
        yield from windows.ask_repeated(
            batch, buckets, ids, keys, owner, anchors - first[owner], grams[anchors], frequent
        )

    asked = windows.by_batch(windows.as_bytes(docs), work)
    return windows.per_text(windows.answer(asked, windows.repeated))


def later_windows(
    docs: DataFrame, seeds: DataFrame, buckets: int, width: int, seed: int
) -> DataFrame:
    """Per text the starts of its windows that also start earlier."""

    def work(batch, rows, frequent) -> Iterator[dict]:
        names, _, first, owner, start, anchors = _places(rows, width, seed)
        marked = np.zeros(len(names) + 1, dtype=bool)
        for k, r in enumerate(rows):
            marked[first[k] + windows.run_places(r[3])] = True
        keep = marked[anchors]
        owner, start = owner[keep], start[keep]
        name = windows.grams(names, width)[start]
        more = windows.grams(windows.mixed(names * _OTHER), width)[start]
        ids, keys = _identities(rows)
        yield from windows.ask_later(
            batch, buckets, ids, keys, owner, start - first[owner], name, more, frequent
        )

    rows = windows.as_bytes(docs).join(seeds, ["_id", "text_key"])
    rows = rows.select("_id", "text_key", "raw", "runs")
    asked = windows.by_batch(rows, work)
    return windows.per_text(windows.answer(asked, windows.later))


def removals(docs: DataFrame, width: int = WIDTH, seed: int = SEED) -> DataFrame:
    """Rows (_id, text_key, runs): runs of starts of windows to remove, of texts with any."""
    buckets = windows.buckets_for(docs)
    seeds = stage(repeated_anchors(docs, buckets, width, seed), "word-seeds")
    seeds = beside(seeds, 24, "runs")
    return stage(later_windows(docs, seeds, buckets, width, seed), "word-repeats")


def dedup(docs: DataFrame, width: int = WIDTH, seed: int = SEED) -> DataFrame:
    """One row for each row of ``docs``: doc_id, n_words, n_removed, ``kept`` (the remaining
    words joined by a space, as bytes) and kept_sha256."""
    gone = beside(removals(docs, width, seed), 24, "runs")
    rows = windows.as_bytes(docs).join(gone, ["_id", "text_key"], "left")

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            out = []
            for doc_id, raw, runs in zip(
                frame["_id"], frame["raw"], frame["runs"], strict=True
            ):
                words = raw.split()
                n = len(words)
                if runs:
                    hit = windows.covered(runs, width, n)
                    words = [w for w, h in zip(words, hit.tolist(), strict=True) if not h]
                kept = b" ".join(words)
                out.append((doc_id, n, n - len(words), kept, hashlib.sha256(kept).hexdigest()))
            yield pd.DataFrame(out, columns=["_id", "n_words", "n_removed", "kept", "kept_sha256"])

    found = rows.select("_id", "raw", "runs").mapInPandas(
        run, "_id long, n_words long, n_removed long, kept binary, kept_sha256 string"
    )
    return found.select(
        F.when(F.col("_id") != windows.NO_ID, F.col("_id")).alias("doc_id"),
        "n_words",
        "n_removed",
        "kept",
        "kept_sha256",
    )
