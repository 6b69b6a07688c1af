"""Exact dedup of byte strings by merging the Burrows-Wheeler transforms of shards.

Every 200 bytes hold an anchor, the smallest of the hashes of their 32-grams, at the same
place in equal strings. Anchors that occur once only cannot lie in a repeated string with
that anchor; around the others the texts are cut into contexts, which hold all windows that
chose the anchor. Contexts meet in the bucket of their anchor; equal ones travel once per
batch and become one string with a count.

In a bucket the contexts of some batches form a shard. Each shard sorts its own suffixes and
keeps its transform: for each row the bytes before it and the row of that earlier suffix.
The merge holds one interleave of all shards' rows. A step looks at the bytes before each
row, in the order of the interleave, and deals the earlier suffixes out by them, stably,
which sorts the interleave by one stride of bytes more; it ends when nothing moves or the
windows' length is reached. Suffixes are never sorted across shards. Neighbours in the final
interleave are compared to get their common prefixes; those of a window's length make the
repeated intervals, whose rows are the windows that occur elsewhere.

An anchor of more contexts than ``HOT`` is not merged, for all its contexts would meet in one
task. Its windows are named by digests of 128 bits and meet by these, in the buckets of the
digests; a batch settles its own equal windows and asks about one of each.

Defined cases: a null text has no bytes; texts shorter than a window lose nothing; equal
rows are elsewhere to each other, so both lose what they share; an empty table gives no rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from procrisk.llm import windows
from procrisk.llm.common import beside
from procrisk.session import stage

WIDTH = 200
SEED = 32
#: Bytes of a symbol, and bytes that one step of the merge looks back; both divide the width.
STRIDE, STEP = 8, 40
#: Bytes of contexts merged at once (more only where one anchor has more), shards of them.
MERGED = 48 << 10
SHARDS = 6
#: Contexts of one anchor that are merged; of more, the windows' digests are compared.
HOT = 2_000


# -- Shards and their merge -----------------------------------------------------------


def _symbols(text: np.ndarray) -> np.ndarray:
    """The ``STRIDE`` bytes from each place on as one number, in the order of the bytes."""
    wide = np.zeros(len(text) + STRIDE, dtype=np.uint8)
    wide[: len(text)] = text
    out = np.zeros(len(text), dtype=np.uint64)
    for k in range(STRIDE):
        out = out << np.uint64(8) | wide[k : k + len(text)]
    return out


def _dense(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Ranks from 1 (0 is free), and the order of the values."""
    order = np.argsort(values)
    ranked = values[order]
    rank = np.empty(len(values), dtype=np.int64)
    rank[order] = np.cumsum(np.concatenate([[True], ranked[1:] != ranked[:-1]]))
    return rank, order


def deepened(
    rank: np.ndarray, depth: int, left: np.ndarray, width: int
) -> tuple[np.ndarray, np.ndarray]:
    """Ranks and order by ``width`` bytes from ranks by fewer: those by about twice as many
    come from pairs. ``left`` counts the bytes left in each place's string."""
    n = len(rank)
    while depth < width:
        shift = min(depth, width - depth)
        far = np.zeros(n, dtype=np.int64)
        if n > shift:
            far[:-shift] = np.where(left[:-shift] > shift, rank[shift:], 0)
        rank, order = _dense(rank * (rank.max(initial=0) + 1) + far)
        depth += shift
        if rank.max(initial=0) == n:
            break
    return rank, order


def _by_symbol(symbols: np.ndarray, wide: bool) -> np.ndarray:
    """A stable order; ranks beyond 16 bits take two passes."""
    if not wide:
        return np.argsort(symbols.astype(np.uint16), kind="stable")
    low = np.argsort((symbols & 0xFFFF).astype(np.uint16), kind="stable")
    return low[np.argsort((symbols[low] >> 16).astype(np.uint16), kind="stable")]


def repeated_windows(
    strings: list[bytes], spans: list[int], shards: list[int], width: int
) -> list[np.ndarray]:
    """For each string, which of its first ``span`` windows equal another window of any."""
    text = np.frombuffer(b"".join(strings), dtype=np.uint8)
    sizes = np.array([len(s) for s in strings], dtype=np.int64)
    begins = np.concatenate([[0], np.cumsum(sizes)])
    string = np.repeat(np.arange(len(strings)), sizes)
    into = np.arange(len(text)) - begins[string]
    left = sizes[string] - into
    symbols = _symbols(text)
    # Beyond a string's end there is nothing.
    short = np.flatnonzero(left < STRIDE)
    cut = (np.uint64(8) * (STRIDE - left[short]).astype(np.uint64)).astype(np.uint64)
    symbols[short] = symbols[short] >> cut << cut

    # One letter of the transforms: the next ``step`` bytes of a place, as a rank.
    step = STEP if width % STEP == 0 else STRIDE
    letter = _dense(symbols)[0]
    if step > STRIDE:
        letter = deepened(letter, STRIDE, left, step)[0]
    # Transforms of the shards: rows in the order of their suffixes.
    shard = np.array(shards)[string]
    place = []
    for k in np.unique(shard):
        own = np.flatnonzero(shard == k)
        place.append(own[deepened(letter[own], step, left[own], width)[1]])
    place = np.concatenate(place)
    row = np.empty(len(text), dtype=np.int32)
    row[place] = np.arange(len(text), dtype=np.int32)
    kind = letter - 1
    wide = int(kind.max(initial=0)) >= 1 << 16
    earlier = np.where(into[place] >= step, row[np.maximum(place - step, 0)], -1)
    before = np.where(earlier >= 0, kind[np.maximum(place - step, 0)], 0).astype(np.int32)
    # The last rows of strings follow no earlier row; their order is that of the strings.
    ends = row[np.flatnonzero(left <= step)]
    end_kind = kind[place[ends]].astype(np.int32)

    merged = np.arange(len(text), dtype=np.int32)
    for _ in range(width // step):
        found = earlier[merged]
        has = found >= 0
        rows = np.concatenate([ends, found[has]])
        dealt = _by_symbol(np.concatenate([end_kind, before[merged][has]]), wide)
        moved = rows[dealt].astype(np.int32)
        if np.array_equal(moved, merged):
            break
        merged = moved

    # Common prefixes of neighbours among the windows, a letter of the refinement at a time.
    at = place[merged]
    at = at[into[at] < np.array(spans)[string[at]]]
    a, b = at[:-1], at[1:]
    same = np.arange(len(a))
    for depth in range(0, width, step):
        same = same[letter[a[same] + depth] == letter[b[same] + depth]]
    twice = np.zeros(len(text), dtype=bool)
    twice[a[same]] = True
    twice[b[same]] = True
    return [
        twice[s : s + n] for s, n in zip(begins[:-1].tolist(), spans, strict=True)
    ]


# -- Anchors, contexts, buckets -------------------------------------------------------


def _last_minima(names: np.ndarray, width: int) -> np.ndarray:
    """As ``windows.last_minima`` by the upper 40 bits: these and the place, counted from
    behind, are one number, so that a step is one minimum. What is equal in these bits is told
    apart by place, which is alike in equal strings."""
    n = len(names) - width + 1
    if n <= 0 or len(names) >= 1 << 24:
        return windows.last_minima(names, width)
    behind = np.arange(len(names) - 1, -1, -1, dtype=np.uint64)
    v, s = names >> np.uint64(24) << np.uint64(24) | behind, 1
    while s * 2 <= width:
        v = np.minimum(v[s:], v[:-s])
        s *= 2
    if width > s:
        v = np.minimum(v[width - s :], v[: s - width])
    return (len(names) - 1 - (v[:n] & np.uint64((1 << 24) - 1)).astype(np.int64)).astype(np.int32)


#: Windows whose anchors are searched at once.
_SLICE = 1 << 15


def _gram_names(text: np.ndarray, seed: int) -> np.ndarray:
    """Names of every ``seed`` bytes, from differences of one running sum."""
    if len(text) < seed:
        return np.zeros(0, dtype=np.uint64)
    power, inverse = windows.power_tables(len(text) + 1)
    total = np.zeros(len(text) + 1, dtype=np.uint64)
    np.cumsum((text.astype(np.uint64) + np.uint64(1)) * power[: len(text)], out=total[1:])
    return windows.mixed((total[seed:] - total[:-seed]) * inverse[: len(text) - seed + 1])


def _anchors(raws: list[bytes], width: int, seed: int):
    """Names of the ``seed`` bytes at every place of the joined texts, where each text begins,
    and for every window its text, its place and that of its anchor. Names and anchors are
    found in slices that stay in a core's cache."""
    text, begins = windows.joined(raws)
    last = max(len(text) - width + 1, 0)
    names = np.zeros(max(len(text) - seed + 1, 0), dtype=np.uint64)
    chosen = np.zeros(last, dtype=np.int32)
    for a in range(0, last, _SLICE):
        b = min(a + _SLICE, last)
        found = _gram_names(text[a : b + width - 1], seed)
        names[a : a + len(found)] = found
        chosen[a:b] = _last_minima(found, width - seed + 1) + np.int32(a)
    counts = np.maximum(np.diff(begins) - width, 0)  # a space follows each text
    owner = np.repeat(np.arange(len(raws), dtype=np.int32), counts)
    skipped = (begins[:-1] - (np.cumsum(counts) - counts)).astype(np.int32)
    window = np.repeat(skipped, counts) + np.arange(len(owner), dtype=np.int32)
    return names, begins, owner, window, chosen[window]


def _identities(rows: list[tuple]) -> tuple[np.ndarray, np.ndarray]:
    return (
        np.array([r[0] for r in rows], dtype=np.int64),
        np.array([r[1] for r in rows], dtype=np.int64),
    )


def repeated_anchors(docs: DataFrame, buckets: int, width: int, seed: int) -> DataFrame:
    """Per text the places of its anchors that occur elsewhere too."""

    def work(batch, rows, frequent) -> Iterator[dict]:
        names, begins, owner, _, chosen = _anchors([r[2] for r in rows], width, seed)
        new = np.flatnonzero(np.concatenate([[True], chosen[1:] != chosen[:-1]])[: len(chosen)])
        owner, chosen = owner[new], chosen[new]
        ids, keys = _identities(rows)
        yield from windows.ask_repeated(
            batch, buckets, ids, keys, owner, chosen - begins[owner], names[chosen], frequent
        )

    asked = windows.by_batch(windows.as_bytes(docs), work)
    return windows.per_text(windows.answer(asked, windows.repeated))


def _contexts(
    docs: DataFrame, seeds: DataFrame, buckets: int, width: int, seed: int
) -> DataFrame:
    """Contexts of all repeated anchors, by bucket of the anchor. Of equal contexts in a
    batch one is sent; the windows of all of them are known to repeat."""

    def work(batch, rows, frequent) -> Iterator[dict]:
        raws = [r[2] for r in rows]
        names, begins, owner, window, chosen = _anchors(raws, width, seed)
        marked = np.zeros(int(begins[-1]) + 1, dtype=bool)
        for k, r in enumerate(rows):
            marked[begins[k] + windows.run_places(r[3])] = True
        keep = marked[chosen]
        owner, window, chosen = owner[keep], window[keep], chosen[keep]
        if not len(chosen):
            return
        head = np.concatenate([[True], chosen[1:] != chosen[:-1]])
        first = np.flatnonzero(head)
        span = np.diff(np.concatenate([first, [len(chosen)]]))
        owner, start, name = owner[first], window[first], names[chosen[first]]
        start = start - begins[owner]
        texts = [
            raws[o][s : s + n + width - 1]
            for o, s, n in zip(owner.tolist(), start.tolist(), span.tolist(), strict=True)
        ]
        where: dict[bytes, int] = {}
        kind = np.array([where.setdefault(t, k) for k, t in enumerate(texts)])
        count = np.bincount(kind, minlength=len(texts))
        known = count[kind] >= 2
        sent = np.flatnonzero(kind == np.arange(len(texts)))
        press = zstandard.ZstdCompressor(level=1)

        def body(at: np.ndarray) -> bytes:
            return press.compress(b"".join(texts[sent[k]] for k in at))

        ids, keys = _identities(rows)
        yield from windows.question_rows(
            batch, buckets, ids, keys, owner[sent], start[sent], name[sent],
            owner[known], start[known], span[sent], span[known], body,
        )

    rows = windows.as_bytes(docs).join(seeds, ["_id", "text_key"])
    rows = rows.select("_id", "text_key", "raw", "runs")
    return windows.by_batch(rows, work)


def hot_anchors(questions: DataFrame, hot: int, buckets: int) -> DataFrame:
    """Per bucket the names of its anchors with more than ``hot`` contexts, packed."""

    def count(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            names = np.frombuffer(b"".join(frame["name"]), "<u8")
            kinds, n = np.unique(names, return_counts=True)
            bucket = (kinds % np.uint64(buckets)).astype(np.int32)
            yield pd.DataFrame({"bucket": bucket, "name": kinds.view(np.int64), "n": n})

    names = questions.where(~F.col("known")).select("name")
    found = names.mapInPandas(count, "bucket int, name long, n long")
    found = found.groupBy("bucket", "name").agg(F.sum("n").alias("n")).where(F.col("n") > hot)
    return found.groupBy("bucket").agg(F.collect_list("name").alias("hot"))


def spread(questions: DataFrame, hot: DataFrame, buckets: int, width: int) -> DataFrame:
    """``questions`` with the contexts of the anchors in ``hot`` (a stored table of some names
    per bucket) replaced by questions about their windows: without lengths, the halves of a
    digest in name and body. Buckets without such an anchor are left as they are."""
    named = questions.join(beside(hot, 64), "bucket", "left")
    touched = F.col("hot").isNotNull() & ~F.col("known")
    rest = named.where(~touched).select(questions.columns)
    columns = [c.split()[0] for c in windows.QUESTIONS.split(", ")]

    def of_row(row) -> Iterator[dict]:
        name = np.frombuffer(row.name, "<u8")
        hit = np.isin(name, np.asarray(row.hot, dtype=np.int64).view(np.uint64))
        row = row._replace(hot=None)
        if not hit.any():
            yield row._asdict()
            return
        owner, start = np.frombuffer(row.owner, "<u4"), np.frombuffer(row.start, "<i4")
        length = np.frombuffer(row.length, "<i4")
        ids, keys = np.frombuffer(row.ids, "<i8"), np.frombuffer(row.keys, "<i8")
        whole = zstandard.ZstdDecompressor().decompress(row.body)
        ends = np.cumsum(length.astype(np.int64) + width - 1)
        begins = ends - length - (width - 1)
        rest = np.flatnonzero(~hit)
        if len(rest):
            body = b"".join(whole[begins[k] : ends[k]] for k in rest)
            yield row._asdict() | {
                "owner": owner[rest].tobytes(),
                "start": start[rest].tobytes(),
                "length": length[rest].tobytes(),
                "name": name[rest].tobytes(),
                "body": zstandard.ZstdCompressor(level=1).compress(body),
            }
        at = np.flatnonzero(hit)
        digests = b"".join(
            hashlib.blake2b(whole[p : p + width], digest_size=16).digest()
            for k in at
            for p in range(begins[k], begins[k] + length[k])
        )
        pairs = np.frombuffer(digests, "<u8").reshape(-1, 2)
        owner = np.repeat(owner[at], length[at])
        start = np.concatenate([start[k] + np.arange(length[k], dtype=np.int32) for k in at])
        _, first, which, count = np.unique(
            pairs, axis=0, return_index=True, return_inverse=True, return_counts=True
        )
        known = (count >= 2)[which.reshape(-1)]
        more = pairs[first, 1]
        yield from windows.question_rows(
            row.batch, buckets, ids, keys, owner[first], start[first], pairs[first, 0],
            owner[known], start[known], body=lambda asked: more[asked].tobytes(),
        )

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held: list[dict] = []
        for frame in frames:
            for row in frame.itertuples(index=False):
                held.extend(of_row(row))
                if len(held) >= 1_000:
                    yield pd.DataFrame(held, columns=columns)
                    held = []
        if held:
            yield pd.DataFrame(held, columns=columns)

    asked = named.where(touched).select(*questions.columns, "hot").mapInPandas(run, windows.QUESTIONS)
    return rest.unionByName(asked)


def _by_digest(rows: pd.DataFrame) -> list[tuple]:
    """Answers to a bucket's questions about windows: those whose digest occurs twice."""
    if not len(rows):
        return []
    name = np.frombuffer(b"".join(rows["name"]), "<u8")
    more = np.frombuffer(b"".join(rows["body"]), "<u8")
    order = np.lexsort((more, name))
    a, b = order[:-1], order[1:]
    same = (name[a] == name[b]) & (more[a] == more[b])
    found = np.zeros(len(name), dtype=bool)
    found[a[same]] = True
    found[b[same]] = True
    told, at = [], 0
    for row in rows.itertuples(index=False):
        owner, start = np.frombuffer(row.owner, "<u4"), np.frombuffer(row.start, "<i4")
        hit = found[at : at + len(owner)]
        at += len(owner)
        if hit.any():
            told.append(
                (row.batch, row.ids, row.keys, owner[hit].tobytes(), start[hit].tobytes(), b"")
            )
    return told


def _merged(rows: pd.DataFrame, width: int) -> list[tuple[int, np.ndarray, np.ndarray, np.ndarray]]:
    """Of a bucket's questions: row, its owners, starts and lengths of repeated windows."""
    press = zstandard.ZstdDecompressor()
    groups: dict[int, dict[bytes, list[tuple[int, int, int, int]]]] = {}
    for k, (owner, start, length, name, body) in enumerate(
        zip(rows["owner"], rows["start"], rows["length"], rows["name"], rows["body"], strict=True)
    ):
        whole, at = press.decompress(body), 0
        for o, s, n, key in zip(
            np.frombuffer(owner, "<u4").tolist(),
            np.frombuffer(start, "<i4").tolist(),
            np.frombuffer(length, "<i4").tolist(),
            np.frombuffer(name, "<u8").tolist(),
            strict=True,
        ):
            text = whole[at : at + n + width - 1]
            at += n + width - 1
            groups.setdefault(key, {}).setdefault(text, []).append((k, o, s, n))
    told: dict[int, list[tuple[int, int, int]]] = {}

    def tell(owners: list[tuple[int, int, int, int]], first: int, n: int) -> None:
        for k, o, s, _ in owners:
            told.setdefault(k, []).append((o, s + first, n))

    strings: list[bytes] = []
    owners_of: list[list] = []
    size = 0

    def merge() -> None:
        nonlocal strings, owners_of, size
        if strings:
            spans = [o[0][3] for o in owners_of]
            shards = [o[0][0] % SHARDS for o in owners_of]
            found = repeated_windows(strings, spans, shards, width)
            for owners, hit, n in zip(owners_of, found, spans, strict=True):
                if len(owners) >= 2:  # equal contexts: every window of theirs repeats
                    tell(owners, 0, n)
                elif hit.any():
                    edge = np.flatnonzero(np.diff(np.concatenate([[0], hit.view(np.int8), [0]])))
                    for a, b in zip(edge[::2].tolist(), edge[1::2].tolist(), strict=True):
                        tell(owners, a, b - a)
        strings, owners_of, size = [], [], 0

    for contexts in groups.values():
        for text, owners in contexts.items():
            strings.append(text)
            owners_of.append(owners)
            size += len(text)
        if size >= MERGED:
            merge()
    merge()
    return [
        (k, *(np.array(x) for x in zip(*runs, strict=True))) for k, runs in sorted(told.items())
    ]


def _answer(questions: DataFrame, width: int) -> DataFrame:
    def run(rows: pd.DataFrame) -> pd.DataFrame:
        columns = [c.split()[0] for c in windows.ANSWERS.split(", ")]
        out = [rows.loc[rows["known"], columns]]
        rows = rows[~rows["known"]]
        whole = rows["length"].map(len) > 0
        out.append(pd.DataFrame(_by_digest(rows[~whole]), columns=columns))
        rows = rows[whole].reset_index(drop=True)
        told = [
            (
                rows["batch"][k], rows["ids"][k], rows["keys"][k],
                o.astype("<u4").tobytes(), s.astype("<i4").tobytes(), n.astype("<i4").tobytes(),
            )
            for k, o, s, n in _merged(rows, width)
        ]
        out.append(pd.DataFrame(told, columns=columns))
        return pd.concat(out)

    return questions.groupBy("bucket").applyInPandas(run, windows.ANSWERS)


def repeats(
    docs: DataFrame, width: int = WIDTH, seed: int = SEED, hot: int = HOT
) -> DataFrame:
    """Rows (_id, text_key, runs): runs of starts of repeated windows, of texts with any."""
    if width % STRIDE:
        raise ValueError(f"the width must be a multiple of {STRIDE}")
    buckets = windows.buckets_for(docs)
    seeds = stage(repeated_anchors(docs, buckets, width, seed), "byte-seeds")
    seeds = beside(seeds, 24, "runs")
    asked = stage(_contexts(docs, seeds, buckets, width, seed), "byte-contexts")
    frequent = stage(hot_anchors(asked, hot, buckets), "hot-anchors")
    if not frequent.isEmpty():
        asked = spread(asked, frequent, buckets, width)
    return stage(windows.per_text(_answer(asked, width)), "byte-repeats")


def dedup(
    docs: DataFrame, width: int = WIDTH, seed: int = SEED, hot: int = HOT
) -> DataFrame:
    """One row for each row of ``docs``: doc_id, n_bytes, n_removed, n_spans, ``kept`` (the
    remaining bytes) and kept_sha256."""
    gone = beside(repeats(docs, width, seed, hot), 24, "runs")
    rows = windows.as_bytes(docs).join(gone, ["_id", "text_key"], "left")

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            out = []
            for doc_id, raw, runs in zip(
                frame["_id"], frame["raw"], frame["runs"], strict=True
            ):
                kept, n, spans = raw, len(raw), 0
                if runs:
                    hit = windows.covered(runs, width, n)
                    spans = int(hit[0]) + int((hit[1:] & ~hit[:-1]).sum())
                    kept = np.frombuffer(raw, dtype=np.uint8)[~hit].tobytes()
                out.append(
                    (doc_id, n, n - len(kept), spans, kept, hashlib.sha256(kept).hexdigest())
                )
            yield pd.DataFrame(
                out, columns=["_id", "n_bytes", "n_removed", "n_spans", "kept", "kept_sha256"]
            )

    found = rows.select("_id", "raw", "runs").mapInPandas(
        run,
        "_id long, n_bytes long, n_removed long, n_spans long, kept binary, kept_sha256 string",
    )
    return found.select(
        F.when(F.col("_id") != windows.NO_ID, F.col("_id")).alias("doc_id"),
        "n_bytes",
        "n_removed",
        "n_spans",
        "kept",
        "kept_sha256",
    )
