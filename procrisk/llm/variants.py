"""Spelling variants: words one letter apart, found in a trie of letter-group counts.

A word becomes the vector of how many of its letters belong to each of ``GROUPS``. Words
that differ by one inserted, deleted or replaced letter have vectors that differ by at most
one letter too many (surplus) and one too few (deficit). The trie arranges words by their
successive counts, one level per group. A depth-first search walks down with a budget of one
surplus and one deficit; the words of the leaves it reaches are compared letter by letter.

How Spark runs it: counts of the trie's nodes are one aggregation of vectors. The shallowest
nodes of at most ``limit`` words are the shards, so that a frequent beginning of the trie is
cut at a deeper level. The few nodes above them are sent to all tasks; there each word
begins its search and is dealt, with the budget it has left, to the shards it reaches. Tasks
go on below: a shard's words are one group of bounded size, and searches of a shard that
many words reach are dealt to several tasks, each with the shard's words.

Forms point to words ten times as frequent, so a chain has at most 18 steps and doubling its
pointers five times reaches every root.

Defined cases: null and empty texts have no words; a null doc_id counts as an empty text
where misspelled runs are drawn; repeated rows count each; ties between forms go to the
first in code-point order; an empty table gives an empty result. Words whose vectors agree
in all groups share a leaf and are compared in blocks, without a row per pair.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from procrisk.llm.common import beside, narrow, reachable, text_of
from procrisk.session import stage

LEAST_LENGTH = 7
LEAST_COUNT = 2
#: One run in this many loses a letter before words are counted.
TYPO = 31
#: A form is this many times as frequent as its word.
OVER = 10
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
ACCENTED = "".join(map(chr, range(0xC0, 0x100)))
#: Letters counted together, one level of the trie each: frequent ones alone.
GROUPS = (*"einatrsolduc", "mp", "hgf", "bvyq", "jkwxz", ACCENTED)
#: Words of a shard, searches of a task, and nodes above the shards as a share of all words.
SHARD_WORDS = (4_000, 50_000)
TASK_SEARCHES = 40_000
TOP_NODES = 10_000
#: States of a search block, pairs compared at once, and the width of the letter matrix.
STATES, PAIRS, WIDTH = 1 << 16, 1 << 17, 32

_LUT = np.zeros(256, dtype=np.int64)
for _k, _letters in enumerate(GROUPS):
    for _letter in _letters:
        _LUT[ord(_letter)] = _k


def word_counts(
    docs: DataFrame, least_length: int = LEAST_LENGTH, least_count: int = LEAST_COUNT, typo: int = TYPO
) -> DataFrame:
    """``word`` and ``n`` of the words of all texts, a letter of every ``typo``-th run lost."""
    lowered = F.translate(text_of(), UPPER, LOWER)
    runs = narrow(docs, "doc_id", "text").select(
        F.coalesce(F.col("doc_id").cast("string"), F.lit("")).alias("_id"),
        F.explode(F.regexp_extract_all(lowered, F.lit("[a-zÀ-ÿ]+"), F.lit(0))).alias("_run"),
    )
    runs = runs.where(F.length("_run") >= least_length).withColumn(
        "_h", F.crc32(F.concat("_id", F.lit(":"), "_run"))
    )
    at = (F.col("_h") % F.length("_run")).cast("int")
    run = F.col("_run")
    lost = F.concat(
        F.substring(run, F.lit(1), at), F.substring(run, at + 2, F.length(run))
    )
    word = F.when(F.col("_h") % typo == 0, lost).otherwise(run).alias("word")
    counted = runs.select(word).groupBy("word").agg(F.count(F.lit(1)).alias("n"))
    return counted.where((F.length("word") >= least_length) & (F.col("n") >= least_count))


def vector_of(word: Column) -> Column:
    """Letters of each group, by built-in functions."""
    size = F.length(word)
    return F.array(*[(size - F.length(F.translate(word, g, ""))).cast("int") for g in GROUPS])


# -- The trie of one shard --------------------------------------------------------------


def vectors(words: list[bytes]) -> np.ndarray:
    """Letter-group counts of Latin-1 words, a row each."""
    sizes = np.fromiter(map(len, words), dtype=np.int64, count=len(words))
    letters = np.frombuffer(b"".join(words), dtype=np.uint8)
    owner = np.repeat(np.arange(len(words)), sizes)
    flat = np.bincount(owner * len(GROUPS) + _LUT[letters], minlength=len(words) * len(GROUPS))
    return flat.reshape(len(words), len(GROUPS))


@dataclass(frozen=True)
class Trie:
    """Sorted child keys (node times ``span`` plus count) per level; the words of each leaf."""

    first: int
    span: int
    keys: list[np.ndarray]
    order: np.ndarray
    begins: np.ndarray

    @classmethod
    def of(cls, counts: np.ndarray, first: int) -> Trie:
        """Trie of words with these vectors below level ``first``, on which all agree."""
        order = np.lexsort(counts[:, ::-1].T)
        rows = counts[order]
        changed = rows[1:] != rows[:-1]
        span = int(counts.max(initial=0)) + 3
        keys, parent = [], np.zeros(len(rows), dtype=np.int64)
        new = np.zeros(len(rows), dtype=bool)
        new[:1] = True
        for level in range(first, counts.shape[1]):
            new[1:] |= changed[:, level]
            keys.append((parent * span + rows[:, level] + 1)[new])
            parent = np.cumsum(new) - 1
        begins = np.append(np.flatnonzero(new), len(rows)) if keys else np.array([0, len(rows)])
        return cls(first, span, keys, order, begins)

    def search(self, wanted: np.ndarray, surplus: np.ndarray, deficit: np.ndarray) -> Iterator:
        """Blocks of (search, leaf) within the budgets, deepest level first."""
        start = np.arange(len(wanted))
        stack = [(0, start, np.zeros(len(start), dtype=np.int64), surplus, deficit)]
        while stack:
            level, who, node, more, less = stack.pop()
            if level == len(self.keys):
                yield who, node
                continue
            if len(who) > STATES:
                half = len(who) // 2
                stack += [(level, *(x[s] for x in (who, node, more, less))) for s in (slice(half, None), slice(half))]
                continue
            keys = self.keys[level]
            count = wanted[who, self.first + level]
            found = []
            for step, may in ((0, None), (1, more), (-1, less)):
                ok = slice(None) if may is None else np.flatnonzero(may)
                key = node[ok] * self.span + np.minimum(count[ok] + step, self.span - 2) + 1
                at = np.minimum(np.searchsorted(keys, key), len(keys) - 1)
                hit = keys[at] == key
                left = (who[ok][hit], at[hit], more[ok][hit] - (step == 1), less[ok][hit] - (step == -1))
                if len(left[0]):
                    found.append(left)
            if found:
                stack.append((level + 1, *(np.concatenate(x) for x in zip(*found, strict=True))))


def one_apart(a: bytes, b: bytes) -> bool:
    """One inserted, deleted or replaced letter."""
    if len(a) < len(b):
        a, b = b, a
    if len(a) - len(b) > 1 or a == b:
        return False
    k = 0
    while k < len(b) and a[k] == b[k]:
        k += 1
    return a[k + 1 :] == (b[k + 1 :] if len(a) == len(b) else b[k:])


def _matrix(words: list[bytes]) -> np.ndarray:
    """Letters of the words, cut and padded to ``WIDTH`` and a place more."""
    text = b"".join([w[:WIDTH].ljust(WIDTH + 2, b"\0") for w in words])
    return np.frombuffer(text, dtype=np.uint8).reshape(len(words), WIDTH + 2)


def _verified(a: np.ndarray, b: np.ndarray, sizes_a: np.ndarray, sizes_b: np.ndarray) -> np.ndarray:
    """Which rows of two letter matrices are one apart."""
    out = np.zeros(len(a), dtype=bool)
    same = np.flatnonzero(sizes_a == sizes_b)
    out[same] = (a[same] != b[same]).sum(1) == 1
    for long, short, rows in (
        (a, b, np.flatnonzero(sizes_a == sizes_b + 1)),
        (b, a, np.flatnonzero(sizes_b == sizes_a + 1)),
    ):
        x, y = long[rows], short[rows, :-1]
        place = np.argmax(x[:, :-1] != y, axis=1)  # the longer word has a letter more
        after = np.arange(y.shape[1]) >= place[:, None]
        out[rows] = ~((x[:, 1:] != y) & after).any(1)
    return out


def near_words(
    stored: list[bytes], searched: list[bytes], surplus: np.ndarray, deficit: np.ndarray, first: int
) -> tuple[np.ndarray, np.ndarray]:
    """Pairs (search, stored word) one letter apart."""
    none = np.zeros(0, dtype=np.int64)
    if not stored or not searched:
        return none, none
    trie, wanted = Trie.of(vectors(stored), first), vectors(searched)
    sizes_s = np.fromiter(map(len, stored), dtype=np.int64, count=len(stored))
    sizes_q = np.fromiter(map(len, searched), dtype=np.int64, count=len(searched))
    letters_s, letters_q = _matrix(stored), _matrix(searched)
    found = [(none, none)]
    for who, leaf in trie.search(wanted, surplus, deficit):
        lengths = trie.begins[leaf + 1] - trie.begins[leaf]
        upto = np.cumsum(lengths)
        total = int(upto[-1]) if len(upto) else 0
        for a in range(0, total, PAIRS):
            flat = np.arange(a, min(a + PAIRS, total))
            row = np.searchsorted(upto, flat, side="right")
            q = who[row]
            s = trie.order[trie.begins[leaf[row]] + flat - (upto[row] - lengths[row])]
            close = np.abs(sizes_q[q] - sizes_s[s]) <= 1
            q, s = q[close], s[close]
            short = np.maximum(sizes_q[q], sizes_s[s]) <= WIDTH
            qs, ss = q[short], s[short]
            ok = _verified(letters_q[qs], letters_s[ss], sizes_q[qs], sizes_s[ss])
            found.append((qs[ok], ss[ok]))
            ql, sl = q[~short], s[~short]
            ok = [one_apart(searched[i], stored[j]) for i, j in zip(ql, sl, strict=True)]
            ok = np.array(ok, dtype=bool)
            found.append((ql[ok], sl[ok]))
    q, s = (np.concatenate(x) for x in zip(*found, strict=True))
    return q, s


# -- Dealing the searches ---------------------------------------------------------------


def _nodes(words: DataFrame, limit: int) -> tuple[DataFrame, DataFrame]:
    """The trie's nodes above the shards, and the shards: paths of counts."""
    leaves = words.select(vector_of(F.col("word")).alias("v")).groupBy("v").agg(F.count(F.lit(1)).alias("c"))
    depth = F.explode(F.sequence(F.lit(0), F.lit(len(GROUPS)))).alias("d")
    paths = leaves.select("v", "c", depth).select(F.slice("v", F.lit(1), F.col("d")).alias("path"), "d", "c")
    nodes = stage(paths.groupBy("path", "d").agg(F.sum("c").alias("c")), "trie-nodes")
    top = nodes.where((F.col("c") > limit) & (F.col("d") < len(GROUPS))).select("path")
    above = top.select(F.col("path").alias("_above"))
    parent = F.slice("path", F.lit(1), F.col("d") - 1)
    inner = nodes.where((F.col("d") == 0) | (F.col("c") > limit) & (F.col("d") < len(GROUPS)))
    shards = (
        nodes.where("d > 0").join(above, parent == F.col("_above"), "left_semi")
        .join(above, F.col("path") == F.col("_above"), "left_anti")
        .unionByName(inner.where((F.col("d") == 0) & (F.col("c") <= limit)))
    )
    return top, shards.select("path")


_ROUTED = "shard string, depth int, word string, n long, own boolean, surplus int, deficit int"


def _routes(words: DataFrame, top: list[tuple], shards: list[tuple]) -> DataFrame:
    """Every word with each shard its search reaches and the budget left there; ``own`` marks
    the shard that stores it."""
    inner, ends = set(top), {path: ",".join(map(str, path)) for path in shards}
    shared = words.sparkSession.sparkContext.broadcast((inner, ends))

    def route(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        nodes, leaves = shared.value
        reached: dict[tuple, list] = {}

        def walk(vector: tuple) -> list:
            out, stack = [], [((), 1, 1)]
            while stack:
                path, more, less = stack.pop()
                name = leaves.get(path)
                if name is not None:
                    out.append((name, len(path), path == vector[: len(path)], more, less))
                elif path in nodes:
                    count = vector[len(path)]
                    stack.append(((*path, count), more, less))
                    if more:
                        stack.append(((*path, count + 1), 0, less))
                    if less and count:
                        stack.append(((*path, count - 1), more, 0))
            return out

        deepest = max(map(len, leaves), default=0)
        for frame in frames:
            rows = []
            counts = vectors([w.encode("latin-1") for w in frame["word"]])[:, : max(deepest, 1)]
            for word, n, vector in zip(frame["word"], frame["n"], map(tuple, counts.tolist()), strict=True):
                found = reached.get(vector)
                if found is None:
                    if len(reached) > 100_000:
                        reached.clear()
                    found = reached[vector] = walk(vector)
                rows += [(s, d, word, n, own, more, less) for s, d, own, more, less in found]
                if len(rows) > 100_000:
                    yield pd.DataFrame(rows, columns=_ROUTE_NAMES)
                    rows = []
            yield pd.DataFrame(rows, columns=_ROUTE_NAMES)

    return words.select("word", "n").mapInPandas(route, _ROUTED)


_ROUTE_NAMES = [field.split()[0] for field in _ROUTED.split(", ")]


def _judge(frame: pd.DataFrame) -> pd.DataFrame:
    """Near words among the stored ones of a shard, counted per search, and the best of them."""
    first = int(frame["depth"].iloc[0])
    kept = frame[frame["stored"]].sort_values("word")
    asked = frame[frame["asks"]]
    words = [w.encode("latin-1") for w in kept["word"]]
    searched = [w.encode("latin-1") for w in asked["word"]]
    surplus, deficit = asked["surplus"].to_numpy(np.int64), asked["deficit"].to_numpy(np.int64)
    q, s = near_words(words, searched, surplus, deficit, first)
    n_near = np.bincount(q, minlength=len(searched))
    n = kept["n"].to_numpy(np.int64)
    order = np.lexsort((s, -n[s], q))
    q, s = q[order], s[order]
    best = np.full(len(searched), -1, dtype=np.int64)
    head = np.flatnonzero(np.diff(q, prepend=-1))
    best[q[head]] = s[head]
    names = kept["word"].to_numpy(object)
    has = best >= 0
    form = np.full(len(searched), None, dtype=object)
    form[has] = names[best[has]]
    form_n = np.zeros(len(searched), dtype=np.int64)
    form_n[has] = n[best[has]]
    out = pd.DataFrame({"word": asked["word"].to_numpy(object), "n": asked["n"].to_numpy(np.int64),
                        "n_near": n_near, "form": form, "form_n": form_n})
    # A search that found nothing only has to be told once, by the shard of its word.
    return out[has | asked["own"].to_numpy(bool)]


def near_forms(words: DataFrame, limit: int | None = None) -> DataFrame:
    """word, n, n_near and its best near word (``form``, ``form_n``), for a stored table of
    distinct words and counts."""
    spark = words.sparkSession
    total = words.count()
    if limit is None:
        low, high = SHARD_WORDS
        even = total // (4 * spark.sparkContext.defaultParallelism)
        limit = max(min(max(even, low), high), total // TOP_NODES)
    top, shards = _nodes(words, limit)
    # Nodes of more than ``limit`` words: at most ``TOP_NODES`` of each level.
    inner = [tuple(r["path"]) for r in top.collect()]
    ends = [tuple(r["path"]) for r in shards.collect()]
    routed = stage(_routes(words, inner, ends), "trie-searches")
    sizes = routed.groupBy("shard").agg(F.ceil(F.count(F.lit(1)) / TASK_SEARCHES).cast("int").alias("fan"))
    fans = beside(stage(sizes, "trie-fans"), 64)
    dealt = routed.join(fans, "shard")
    salt = F.pmod(F.xxhash64("word"), F.col("fan")).cast("int")
    # A stored word goes to all tasks of its shard and asks in one of them.
    to = F.explode(F.when(F.col("own"), F.sequence(F.lit(0), F.col("fan") - 1)).otherwise(F.array(salt)))
    rows = dealt.withColumn("salt", salt).withColumn("task", to).select(
        "shard", "task", "depth", "word", "n", "own", "surplus", "deficit",
        F.col("own").alias("stored"), (F.col("task") == F.col("salt")).alias("asks"),
    )
    judged = rows.groupBy("shard", "task").applyInPandas(
        _judge, "word string, n long, n_near long, form string, form_n long"
    )
    best = F.min(F.when(F.col("form").isNotNull(), F.struct((-F.col("form_n")).alias("m"), "form"))).alias("b")
    told = judged.groupBy("word").agg(F.max("n").alias("n"), F.sum("n_near").alias("n_near"), best)
    return told.select("word", "n", "n_near", F.col("b.form").alias("form"), (-F.col("b.m")).alias("form_n"))


def with_roots(forms: DataFrame) -> DataFrame:
    """A stored table of ``word`` and ``form`` with ``root``, the end of each word's forms."""
    ends = stage(forms.where(F.col("form").isNotNull()).select("word", F.col("form").alias("root")), "forms")
    for _ in range(5):
        ahead = ends.select(F.col("word").alias("root"), F.col("root").alias("_next"))
        moved = stage(
            ends.join(ahead, "root", "left").select(
                "word", F.coalesce("_next", "root").alias("root"), F.col("_next").isNotNull().alias("_moved")
            ),
            "roots",
        )
        ends = moved.select("word", "root")
        if moved.where("_moved").isEmpty():
            break
    return forms.join(ends, "word", "left").withColumn("root", F.coalesce("root", "word"))


def spelling_variants(docs: DataFrame, over: int = OVER, limit: int | None = None) -> DataFrame:
    """word, form, root, n, n_near and form_n of all words of ``docs``."""
    reachable(docs.sparkSession)
    near = near_forms(stage(word_counts(docs), "words"), limit)
    is_form = F.col("form_n") >= over * F.col("n")
    judged = near.select(
        "word", "n", "n_near",
        F.when(is_form, F.col("form")).alias("form"), F.when(is_form, F.col("form_n")).alias("form_n"),
    )
    found = with_roots(stage(judged, "variants"))
    return found.select("word", "form", "root", "n", "n_near", "form_n")
