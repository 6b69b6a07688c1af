"""Benchmark decontamination by greedy string tiling.

Words are runs of letters and digits of the lower-cased text (ASCII marks and white space
separate; other characters belong to words). The benchmark is taken in blocks of bounded
size. Every text looks up its 5-grams among those of a block; texts and items that share
seeds over enough of the item's words are tiled: maximal matches are found by Karp-Rabin
hashes of a search length that shrinks, the longest are marked first, and marked words are
not matched again. Tiles may stand in any order, so rearranged passages are caught. A text
is contaminated by an item if its tiles cover ``PERCENT`` of the item's words.

Equal 64-bit hashes of 5-grams are taken as equal seeds; tiles compare words one by one.

Defined cases: null texts have no words; items of fewer than five words hold no seed and
contaminate nothing; repeated rows are judged alike, repeated items are reported each; empty
tables give no rows. Items need an id to be reported; it may be null.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from procrisk.llm import windows
from procrisk.llm.common import narrow, row_key, text_of, with_null_ids, with_whole_ids, without
from procrisk.session import stage

SEED = 5
PERCENT = 75
#: First search length of the tiling.
SEARCH = 20
#: Characters of the benchmark that are looked up at once.
BLOCK_CHARACTERS = 8_000_000

_BYTES = np.arange(256)
#: Bytes that separate words: ASCII other than letters and digits.
GAPS = (_BYTES < 128) & ~(
    ((_BYTES >= 48) & (_BYTES < 58))
    | ((_BYTES >= 65) & (_BYTES < 91))
    | ((_BYTES >= 97) & (_BYTES < 123))
)

_BITS = 20
#: Characters of the texts that are judged at once.
_SLICE = 1 << 18


def words(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Names of all words, and the first word of each text; one more entry tells the end."""
    text, begins = windows.joined([t.lower().encode() for t in texts])
    names, at = windows.word_names(text, GAPS)
    return names, np.searchsorted(at, begins)


# -- Tiling of one pair ---------------------------------------------------------------


def _open_runs(marked: np.ndarray) -> np.ndarray:
    """How many words from each on are not marked."""
    n = len(marked)
    stop = np.where(marked, np.arange(n), n)
    return np.minimum.accumulate(stop[::-1])[::-1] - np.arange(n)


def _matches(a: np.ndarray, b: np.ndarray, open_a, open_b, length: int):
    """Maximal matches of unmarked words of ``length`` or more: (length, place in a, in b);
    alone the first longer than twice that, if there is one."""
    names_a, names_b = windows.grams(a, length), windows.grams(b, length)
    where: dict[int, list[int]] = {}
    for j in np.flatnonzero(open_b[: len(names_b)] >= length).tolist():
        where.setdefault(int(names_b[j]), []).append(j)
    found = []
    for i in np.flatnonzero(open_a[: len(names_a)] >= length).tolist():
        for j in where.get(int(names_a[i]), ()):
            most = int(min(open_a[i], open_b[j]))
            differ = np.flatnonzero(a[i : i + most] != b[j : j + most])
            size = int(differ[0]) if len(differ) else most
            if size < length:  # equal hashes of different words
                continue
            if size > 2 * length:
                return [(size, i, j)], True
            found.append((size, i, j))
    return found, False


def tiles(a: np.ndarray, b: np.ndarray, least: int = SEED) -> list[tuple[int, int, int]]:
    """Tiles (length, place in a, place in b) of two word sequences, longest first marked;
    of equally long ones the earlier in ``a``, then in ``b``."""
    marked_a, marked_b = np.zeros(len(a), dtype=bool), np.zeros(len(b), dtype=bool)
    length, out = max(least, min(SEARCH, len(b))), []
    while True:
        found, longer = _matches(a, b, _open_runs(marked_a), _open_runs(marked_b), length)
        if longer:
            length = found[0][0]
            continue
        again = False
        for size, i, j in sorted(found, key=lambda m: (-m[0], m[1], m[2])):
            if not (marked_a[i : i + size].any() or marked_b[j : j + size].any()):
                marked_a[i : i + size] = True
                marked_b[j : j + size] = True
                out.append((size, i, j))
            else:
                again = True  # what is left of it may still be long enough
        if again:
            continue
        if length == least:
            return out
        length = max(least, length // 2)


# -- Blocks of the benchmark ----------------------------------------------------------


@dataclass
class Block:
    """Words of some items, and their 5-grams sorted by name."""

    items: list
    names: np.ndarray
    first: np.ndarray
    seed: np.ndarray
    item: np.ndarray
    at: np.ndarray
    some: np.ndarray

    @classmethod
    def of(cls, items: list, texts: list[str]) -> Block:
        names, first = words(texts)
        grams = windows.grams(names, SEED)
        item = np.searchsorted(first, np.arange(len(grams)), side="right") - 1
        whole = np.arange(len(grams)) + SEED <= first[item + 1]
        place = np.flatnonzero(whole)
        order = place[np.argsort(grams[place], kind="stable")]
        seed = grams[order]
        some = np.zeros(1 << _BITS, dtype=bool)
        some[(seed >> np.uint64(64 - _BITS)).astype(np.int64)] = True
        return cls(items, names, first, seed, item[order], order - first[item[order]], some)

    def size(self, k: int) -> int:
        return int(self.first[k + 1] - self.first[k])


def _candidates(block: Block, grams: np.ndarray, owner: np.ndarray, whole: np.ndarray):
    """Seed matches (text, item, place in the joined texts, place in the item) of pairs whose
    seeds cover enough of the item, sorted by text and item."""
    maybe = np.flatnonzero(whole & block.some[(grams >> np.uint64(64 - _BITS)).astype(np.int64)])
    low = np.searchsorted(block.seed, grams[maybe], side="left")
    count = np.searchsorted(block.seed, grams[maybe], side="right") - low
    maybe, low, count = maybe[count > 0], low[count > 0], count[count > 0]
    hit = np.repeat(maybe, count)
    step = np.arange(len(hit)) - np.repeat(np.cumsum(count) - count, count)
    entry = np.repeat(low, count) + step
    text, item, at = owner[hit], block.item[entry], block.at[entry]
    order = np.lexsort((at, item, text))
    text, item, at, hit = text[order], item[order], at[order], hit[order]
    if not len(text):
        return text, item, hit, at
    head = np.concatenate([[True], (text[1:] != text[:-1]) | (item[1:] != item[:-1])])
    pair = np.cumsum(head) - 1
    # A seed covers its words up to the next one of the pair.
    gap = np.full(len(at), SEED)
    gap[:-1] = np.where(head[1:], SEED, np.minimum(SEED, at[1:] - at[:-1]))
    cover = np.bincount(pair, gap)
    sizes = np.diff(block.first)[item[head]]
    keep = (cover * 100 >= sizes * PERCENT)[pair]
    return text[keep], item[keep], hit[keep], at[keep]


def _judged(block: Block, texts: list[str]) -> Iterator[tuple[int, int, float, int, int]]:
    """(text, item, coverage, tiles, longest tile) of contaminated texts."""
    names, first = words(texts)
    grams = windows.grams(names, SEED)
    owner = np.searchsorted(first, np.arange(len(grams)), side="right") - 1
    whole = np.arange(len(grams)) + SEED <= first[owner + 1] if len(grams) else owner > 0
    text, item, hit, at = _candidates(block, grams, owner, whole)
    if not len(text):
        return
    edge = np.flatnonzero((np.diff(text) != 0) | (np.diff(item) != 0)) + 1
    for part in np.split(np.arange(len(text)), edge):
        t, k = int(text[part[0]]), int(item[part[0]])
        own = names[first[t] : first[t + 1]]
        # Tiles consist of seeds, so words that no seed covers cannot be in one. They are
        # replaced by nothing that an item could hold: a gap of one word per run.
        inside = np.zeros(len(own) + 1, dtype=np.int64)
        np.add.at(inside, np.unique(hit[part]) - first[t], 1)
        np.add.at(inside, np.unique(hit[part]) - first[t] + SEED, -1)
        held = np.cumsum(inside[:-1]) > 0
        edges = held & ~np.concatenate([[False], held[:-1]])
        kept = own[held]
        breaks = np.flatnonzero(edges[held])
        query = block.names[block.first[k] : block.first[k + 1]]
        absent = np.uint64(1)
        while absent in query:
            absent += np.uint64(1)
        found = tiles(np.insert(kept, breaks, absent), query)
        total = sum(size for size, _, _ in found)
        if total * 100 >= block.size(k) * PERCENT:
            yield t, k, total / block.size(k), len(found), max(f[0] for f in found)


def _blocks(benchmark: DataFrame) -> Iterator[Block]:
    """The benchmark in parts that are collected one at a time, each bounded by
    ``BLOCK_CHARACTERS`` in expectation."""
    items = narrow(benchmark, "item_id", "text").select("item_id", text_of().alias("text"))
    size = items.agg(F.sum(F.length("text"))).first()[0] or 0
    count = int(-(-size // BLOCK_CHARACTERS))
    for k in range(count):
        part = items
        if count > 1:
            part = items.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(count)) == k)
        rows = sorted(part.collect(), key=lambda r: (r["item_id"] is not None, r["item_id"], r["text"]))
        if rows:
            yield Block.of([r["item_id"] for r in rows], [r["text"] for r in rows])


def contaminations(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """doc_id, text_key, item_id, coverage, n_tiles and longest_tile, one row for each row of
    ``docs`` and item that contaminates it."""
    spark = docs.sparkSession
    rows = with_whole_ids(
        narrow(docs, "doc_id", "text").select(
            "doc_id", row_key().alias("text_key"), text_of().alias("text")
        )
    )
    kind = rows.schema["doc_id"].dataType.simpleString()
    item_kind = benchmark.schema["item_id"].dataType.simpleString()
    schema = (
        f"_known boolean, doc_id {kind}, text_key long, item_id {item_kind}, coverage double, "
        "n_tiles int, longest_tile int"
    )
    found = []
    for block in _blocks(benchmark):
        shared = spark.sparkContext.broadcast(block)

        def run(frames: Iterator[pd.DataFrame], shared=shared) -> Iterator[pd.DataFrame]:
            block = shared.value
            for frame in frames:
                total = frame["text"].map(len).cumsum() // _SLICE
                for _, part in frame.groupby(total, sort=True):
                    hits = list(_judged(block, part["text"].tolist()))
                    at = [t for t, *_ in hits]
                    yield pd.DataFrame(
                        {
                            "_known": part["_known"].iloc[at],
                            "doc_id": part["doc_id"].iloc[at],
                            "text_key": part["text_key"].iloc[at],
                            # As objects: a null among them must not make floats of the others.
                            "item_id": np.array([block.items[h[1]] for h in hits], dtype=object),
                            "coverage": [h[2] for h in hits],
                            "n_tiles": [h[3] for h in hits],
                            "longest_tile": [h[4] for h in hits],
                        }
                    )

        # Told and released before the next block, so that one block at a time is held.
        found.append(stage(rows.mapInPandas(run, schema), "contaminated-block"))
        shared.destroy()
    if not found:
        return with_null_ids(spark.createDataFrame([], schema))
    return with_null_ids(reduce(DataFrame.unionByName, found))


def drop_contaminated(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """``docs`` without contaminated rows, all columns kept."""
    found = contaminations(docs, benchmark).select("doc_id", "text_key").distinct()
    return without(docs, found, "contaminated")
