"""Near-duplicate documents by SetSketch registers.

A document is the set of its 5-word shingles. Register j holds the smallest of the shingles'
j-th hashes, read as exponentially distributed values and truncated to a power of ``BASE``;
registers of a union are the larger ones of its parts. Documents with equal sets form a
class, one of which stands for all. Classes that agree on a band of registers are
candidates. From the registers that are larger, smaller and equal and from the sizes of
both sets the likelihood of each similarity follows; pairs whose likeliest similarity is far
below the threshold are dropped, all others are verified on the whole sets.

A band's bucket is not expanded into pairs. First each member is compared with the one that
shares most bucket places with others; links then join members to components. Pairs within
a component need no comparison. All members of a centre's buckets that are left in different
components are compared in blocks, on their whole sets, without making rows for pairs, so
that no link between components is missed.

With 48 bands of 5 registers a pair at the threshold is missed with probability 2e-6.

Defined cases: documents without words have no shingles and are linked with nothing; with
fewer than five words the sequence is the only shingle; rows without doc_id are linked with
nothing and have no component; rows that share a doc_id count as one document; an empty
table gives no rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf
from pyspark.sql.types import MapType, VariantType

from procrisk.llm import windows
from procrisk.llm.common import (
    beside,
    join_dealt,
    narrow,
    row_key,
    text_of,
    with_null_ids,
    with_whole_ids,
)
from procrisk.llm.links import components
from procrisk.session import stage

SHINGLE = 5
#: Similarity in percent from which documents are linked.
PERCENT = 75
BANDS, ROWS = 48, 5
REGISTERS = BANDS * ROWS
#: Registers are powers of this base, 16 bits wide; the rate scales the exponentials.
BASE, RATE, LARGEST = 1.001, 20.0, (1 << 16) - 1
#: Members of a block that one task compares with another block, and shingles at once.
BLOCK = 256
_COLUMNS = 8192
#: A pair is verified unless its likeliest similarity is below this; the threshold lies six
#: standard errors above.
LIKELY = 0.57

_BLOCK = 4096


def _factors() -> np.ndarray:
    rng = np.random.default_rng(20_21)
    return rng.integers(0, 1 << 32, REGISTERS, dtype=np.uint64).astype(np.uint32) | np.uint32(1)


_FACTORS = _factors()


def shingle_sets(raws: list[bytes]) -> list[np.ndarray]:
    """Sorted distinct 64-bit names of each text's shingles."""
    text, begins = windows.joined([r.lower() for r in raws])  # bytes: A-Z only
    names, at = windows.word_names(text)
    first = np.searchsorted(at, begins)
    grams = windows.grams(names, SHINGLE)
    out = []
    for a, b in zip(first[:-1].tolist(), first[1:].tolist(), strict=True):
        if b - a >= SHINGLE:
            out.append(np.unique(grams[a : b - SHINGLE + 1]))
        elif b > a:
            short = windows.grams(names[a:b], b - a)
            out.append(windows.mixed(short + np.uint64(b - a)))
        else:
            out.append(np.zeros(0, dtype=np.uint64))
    return out


def registers(shingles: np.ndarray) -> np.ndarray:
    """SetSketch of a set of 64-bit names: 16-bit registers; all zero if it is empty."""
    if not len(shingles):
        return np.zeros(REGISTERS, dtype=np.uint16)
    small = (windows.mixed(shingles) >> np.uint64(32)).astype(np.uint32)
    least = np.full(REGISTERS, np.iinfo(np.uint32).max, dtype=np.uint32)
    for k in range(0, len(small), _BLOCK):
        np.minimum(
            least, (_FACTORS[:, None] * small[None, k : k + _BLOCK]).min(axis=1), out=least
        )
    exponential = -np.log1p(-(least + 0.5) / 2.0**32) / RATE
    return np.clip(
        np.floor(1 - np.log(exponential) / np.log(BASE)), 0, LARGEST
    ).astype(np.uint16)


def merged(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Registers of the union of two sets."""
    return np.maximum(a, b)


def band_names(sketch: np.ndarray) -> np.ndarray:
    """One 64-bit name per band of each sketch (rows); bands never share names by number."""
    parts = sketch.reshape(len(sketch), BANDS, ROWS).astype(np.uint64)
    names = np.broadcast_to(np.arange(BANDS, dtype=np.uint64), parts.shape[:2]).copy()
    for k in range(ROWS):
        names = windows.mixed(names * np.uint64(0x9E3779B97F4A7C15) + parts[:, :, k])
    return names


def likeliest(a: np.ndarray, b: np.ndarray, n_a: np.ndarray, n_b: np.ndarray) -> np.ndarray:
    """Similarity with the largest joint likelihood of the registers' comparison, given the
    sizes of the sets; searched over hundredths."""
    more = (a > b).sum(axis=1)[:, None]
    less = (a < b).sum(axis=1)[:, None]
    equal = REGISTERS - more - less
    u = (n_a / (n_a + n_b))[:, None]
    v = 1 - u
    most = np.minimum(u / v, v / u)
    grid = np.minimum(np.linspace(0, 1, 101)[None, :], most)

    def share(x: np.ndarray) -> np.ndarray:
        return np.clip(-np.log1p(-x * (BASE - 1) / BASE) / np.log(BASE), 1e-9, 1)

    above, below = share(np.maximum(u - v * grid, 0)), share(np.maximum(v - u * grid, 0))
    level = np.clip(1 - above - below, 1e-9, 1)
    fit = more * np.log(above) + less * np.log(below) + equal * np.log(level)
    return grid[np.arange(len(grid)), fit.argmax(axis=1)]


# -- Tables ---------------------------------------------------------------------------


def _rows(docs: DataFrame) -> DataFrame:
    return narrow(docs, "doc_id", "text").select(
        F.col("doc_id").cast("long").alias("doc_id"), text_of().cast("binary").alias("raw")
    )


def _in_slices(frames: Iterator[pd.DataFrame], size: int = 1 << 18) -> Iterator[pd.DataFrame]:
    """Parts of the frames of about ``size`` bytes of text, one row at least."""
    for frame in frames:
        total = frame["raw"].map(len).cumsum() // size
        for _, part in frame.groupby(total, sort=True):
            yield part


def sketches(docs: DataFrame) -> DataFrame:
    """doc_id, n_shingles, digest of the set and registers, one row for each row of docs."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for part in _in_slices(frames):
            sets = shingle_sets(part["raw"].tolist())
            yield pd.DataFrame(
                {
                    "_known": part["_known"],
                    "doc_id": part["doc_id"],
                    "n_shingles": [len(s) for s in sets],
                    "digest": [hashlib.blake2b(s.tobytes(), digest_size=16).digest() for s in sets],
                    "registers": [registers(s).tobytes() for s in sets],
                }
            )

    rows = with_whole_ids(_rows(docs).select("doc_id", "raw"))
    sketched = rows.mapInPandas(
        run, "_known boolean, doc_id long, n_shingles long, digest binary, registers binary"
    )
    return with_null_ids(sketched)


def _bands(classes: DataFrame) -> DataFrame:
    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            if not len(frame):
                continue
            sketch = np.stack([np.frombuffer(r, np.uint16) for r in frame["registers"]])
            yield pd.DataFrame(
                {
                    "id": np.repeat(frame["id"].to_numpy(), BANDS),
                    "band": band_names(sketch).reshape(-1).view(np.int64),
                }
            )

    return classes.select("id", "registers").mapInPandas(run, "id long, band long")


def _likeliest(a: pd.Series, b: pd.Series, n_a: pd.Series, n_b: pd.Series) -> pd.Series:
    if not len(a):
        return pd.Series([], dtype=float)
    left = np.stack([np.frombuffer(r, np.uint16) for r in a])
    right = np.stack([np.frombuffer(r, np.uint16) for r in b])
    return pd.Series(likeliest(left, right, n_a.to_numpy(float), n_b.to_numpy(float)))


def _shingles(docs: DataFrame, ids: DataFrame) -> DataFrame:
    """(id, shingles) of the documents named by ``ids``."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for part in _in_slices(frames):
            sets = shingle_sets(part["raw"].tolist())
            yield pd.DataFrame(
                {"id": part["doc_id"], "shingles": [s.view(np.int64) for s in sets]}
            )

    ids = beside(ids.withColumnRenamed("id", "doc_id"), 16)
    rows = _rows(docs).join(ids, "doc_id", "left_semi").select("doc_id", "raw")
    return rows.mapInPandas(run, "id long, shingles array<long>")


def _verified(docs: DataFrame, classes: DataFrame, pairs: DataFrame) -> DataFrame:
    """Pairs (a, b) whose sets overlap by the threshold. A centre is in the pairs of all its
    members: such an id's pairs are dealt by the other one."""
    pairs = stage(pairs, "candidate-pairs")
    known = classes.select("id", "n", "registers")
    left = known.withColumnsRenamed({"id": "a", "n": "n_a", "registers": "r_a"})
    right = known.withColumnsRenamed({"id": "b", "n": "n_b", "registers": "r_b"})
    sized = join_dealt(join_dealt(pairs, left, "a", "b"), right, "b", "a", pairs)
    sized = sized.where(
        F.least("n_a", "n_b") * 100 >= F.greatest("n_a", "n_b") * PERCENT
    )
    similarity = pandas_udf(_likeliest, "double")  # needs a session, so made here
    likely = sized.where(similarity("r_a", "r_b", "n_a", "n_b") >= LIKELY)
    likely = stage(likely.select("a", "b", "n_a", "n_b").distinct(), "likely-pairs")
    ids = likely.select(F.explode(F.array("a", "b")).alias("id")).distinct()
    sets = stage(_shingles(docs, stage(ids, "likely-ids")), "shingles")
    s_a = sets.withColumnsRenamed({"id": "a", "shingles": "s_a"})
    s_b = sets.withColumnsRenamed({"id": "b", "shingles": "s_b"})
    found = join_dealt(join_dealt(likely, s_b, "b", "a"), s_a, "a", "b", likely)
    shared = F.size(F.array_intersect("s_a", "s_b"))
    union = F.size("s_a") + F.size("s_b") - shared
    return found.where(shared * 100 >= union * PERCENT).select("a", "b").distinct()


def _with_weight(members: DataFrame) -> DataFrame:
    """``members`` (band, id, members) with ``weight``, how many bucket places a member shares
    with others in all: the text that others are copies of has the most."""
    weights = members.groupBy("id").agg(F.sum("members").alias("weight"))
    return members.select("band", "id").join(weights, "id")


def _centres(members: DataFrame) -> DataFrame:
    """(band, centre): the weightiest of each bucket, the smallest id of equals."""
    first = F.max(F.struct("weight", (-F.col("id")).alias("order")))
    return members.groupBy("band").agg((-first["order"]).alias("centre"))


def _pairs(a: str, b: str) -> list:
    return [F.least(a, b).alias("a"), F.greatest(a, b).alias("b")]


def _unsettled(members: DataFrame, labels: DataFrame) -> DataFrame:
    """(band, id, component) of the members of buckets that lie in several components."""
    own = members.select("band", "id").join(labels, "id", "left")
    own = stage(own.withColumn("component", F.coalesce("component", "id")), "bucket-members")
    parts = own.groupBy("band").agg(F.min("component").alias("low"), F.max("component").alias("high"))
    return stage(own.join(parts.where("low < high").select("band"), "band"), "open-buckets")


def _alone(sets: DataFrame) -> DataFrame:
    """(id, n, alone): the size of a set and how many of its shingles no other set here has.
    Ids with several sets count as if they had none alone."""
    sizes = sets.groupBy("id").agg(
        F.max(F.size("shingles")).alias("n"), F.count(F.lit(1)).alias("sets")
    )
    owners = sets.select("id", F.explode("shingles").alias("shingle")).groupBy("shingle")
    own = owners.agg(F.min("id").alias("id"), F.count(F.lit(1)).alias("held")).where("held = 1")
    counts = own.groupBy("id").agg(F.count(F.lit(1)).alias("found"))
    alone = F.when(F.col("sets") == 1, F.coalesce("found", F.lit(0))).otherwise(F.lit(0))
    return sizes.join(counts, "id", "left").select("id", "n", alone.alias("alone"))


def _links(docs: DataFrame, classes: DataFrame, members: DataFrame) -> DataFrame:
    """Links that join the members of every bucket as all their verified pairs would.

    One centre is compared with its whole bucket. After that only pairs across components
    matter. Shingles that no other member of an open bucket has cannot be shared: a set with
    more than a quarter of such shingles reaches the threshold with none.
    """
    centres = stage(_centres(members), "centres")
    stars = members.join(beside(centres, 16), "band").where("id <> centre")
    links = stage(_verified(docs, classes, stars.select(*_pairs("centre", "id")).distinct()), "links")
    left = _unsettled(members, components(links))
    if left.isEmpty():
        return links
    sets = stage(_shingles(docs, stage(left.select("id").distinct(), "open-ids")), "open-sets")
    facts = stage(_alone(sets), "open-facts")
    bounded = facts.where(F.col("alone") * 100 <= F.col("n") * (100 - PERCENT)).select("id")
    left = left.join(beside(bounded, 16), "id", "left_semi").join(beside(centres, 16), "band")
    left = stage(left.select("centre", "id", "component").distinct(), "open-members")
    return links.union(stage(_across(left, sets), "links"))


def _across(members: DataFrame, sets: DataFrame) -> DataFrame:
    """Links between members (centre, id, component) of a centre's buckets that lie in
    different components.

    The members of a centre are dealt to blocks of about ``BLOCK``; a task gets two blocks
    and counts their overlaps as a product of matrices, so no row is made for a pair. It
    returns a forest of the links it found.
    """
    sizes = members.groupBy("centre").agg(
        F.ceil(F.count(F.lit(1)) / BLOCK).cast("int").alias("blocks"),
        F.min("component").alias("low"),
        F.max("component").alias("high"),
    )
    sizes = stage(sizes.where("low < high").select("centre", "blocks"), "centre-blocks")
    rows = members.join(beside(sizes, 24), "centre")
    rows = rows.withColumn("block", F.pmod(F.xxhash64("id"), "blocks").cast("int"))
    rows = rows.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    rows = rows.select(
        "centre", "id", "component", "block",
        F.least("block", "other").alias("first"), F.greatest("block", "other").alias("second"),
    )
    rows = rows.join(sets, "id")
    return rows.groupBy("centre", "first", "second").applyInPandas(_compare, "a long, b long")


def _compare(rows: pd.DataFrame) -> pd.DataFrame:
    """Links of different components between two blocks, or within one."""
    empty = pd.DataFrame({"a": np.zeros(0, np.int64), "b": np.zeros(0, np.int64)})
    if len(rows) < 2:
        return empty
    ids, component = rows["id"].to_numpy(), rows["component"].to_numpy()
    sets = [np.asarray(s) for s in rows["shingles"]]
    n = np.array([len(s) for s in sets])
    owner = np.repeat(np.arange(len(sets)), n)
    # Shingles with one owner overlap with nothing.
    _, kind, count = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    shared = count[kind] >= 2
    number = np.cumsum(count >= 2) - 1
    owner, kind = owner[shared], number[kind[shared]]
    first = rows["block"].to_numpy() == rows["first"].to_numpy()
    one, two = np.flatnonzero(first), np.flatnonzero(~first)
    if not len(two):
        two = one
    overlap = np.zeros((len(one), len(two)), dtype=np.float32)
    order = np.argsort(kind, kind="stable")
    owner, kind = owner[order], kind[order]
    for low in range(0, int(kind.max(initial=-1)) + 1, _COLUMNS):
        a, b = np.searchsorted(kind, [low, low + _COLUMNS])
        holds = np.zeros((len(sets), _COLUMNS), dtype=np.float32)
        holds[owner[a:b], kind[a:b] - low] = 1
        overlap += holds[one] @ holds[two].T
    union = n[one][:, None] + n[two][None, :] - overlap
    linked = (overlap * 100 >= union * PERCENT) & (component[one][:, None] != component[two][None, :])
    at, to = np.nonzero(linked)
    root = {}

    def find(x: int) -> int:
        while root.setdefault(x, x) != x:
            root[x] = x = root[root[x]]
        return x

    out = []
    for x, y in zip(one[at].tolist(), two[to].tolist(), strict=True):
        p, q = find(int(component[x])), find(int(component[y]))
        if p != q:
            root[p] = q
            out.append((min(ids[x], ids[y]), max(ids[x], ids[y])))
    return pd.DataFrame(out, columns=["a", "b"], dtype=np.int64) if out else empty


def near_duplicates(docs: DataFrame) -> DataFrame:
    """doc_id, n_shingles, component_id (the smallest doc_id reachable over links) and kept,
    one row for each row of ``docs``."""
    sketched = stage(sketches(docs), "sketches")
    linked = sketched.where("n_shingles > 0 AND doc_id IS NOT NULL")
    first = stage(linked.groupBy("digest").agg(F.min("doc_id").alias("id")), "classes")
    stands = linked.join(beside(first, 48), "digest").where("doc_id = id")
    classes = stage(
        stands.select("id", F.col("n_shingles").alias("n"), "registers").dropDuplicates(
            ["id", "registers"]
        ),
        "class-sketches",
    )
    bands = _bands(classes).distinct()
    buckets = (
        bands.groupBy("band").agg(F.count(F.lit(1)).alias("members")).where("members > 1")
    )
    members = bands.join(beside(stage(buckets, "buckets"), 40), "band")
    members = stage(_with_weight(stage(members, "members")), "weighed-members")
    links = _links(docs, classes, members)
    copies = linked.select("digest", "doc_id").join(beside(first, 48), "digest")
    copies = copies.where("doc_id <> id").select(F.col("id").alias("a"), F.col("doc_id").alias("b"))
    labels = components(links.union(copies))
    labels = beside(labels.withColumnRenamed("id", "doc_id"), 40)
    found = sketched.drop("digest", "registers").join(labels, "doc_id", "left")
    component = F.coalesce("component", "doc_id")
    return found.select(
        "doc_id",
        "n_shingles",
        component.alias("component_id"),
        F.coalesce(F.col("doc_id") == component, F.lit(True)).alias("kept"),
    )


def keep_first(docs: DataFrame) -> DataFrame:
    """One row of ``docs`` for each component, all columns kept. Of rows that share a doc_id
    the one with the smallest text hash stays, of equal texts the one whose columns have the
    smallest hash (columns of maps left out); rows without doc_id all stay."""
    judged = stage(near_duplicates(docs), "near-duplicates")
    gone = judged.where(~F.col("kept")).select(F.col("doc_id").alias("_gone_id")).distinct()
    gone = beside(stage(gone, "duplicates"), 16)
    left = docs.join(gone, docs["doc_id"] == gone["_gone_id"], "left_anti")
    again = judged.where("doc_id IS NOT NULL").groupBy("doc_id").count().where("count > 1")
    again = stage(again.select(F.col("doc_id").alias("_again_id")), "repeated-ids")
    if again.isEmpty():
        return left
    again = beside(again, 16)
    repeated = left["doc_id"] == again["_again_id"]
    once = left.join(again, repeated, "left_anti")
    hashed = [
        docs[f"`{field.name}`"] for field in docs.schema
        if not isinstance(field.dataType, (MapType, VariantType))
    ]
    many = left.join(again, repeated, "left_semi").withColumn(
        "_order", F.struct(row_key().alias("text"), F.xxhash64(*hashed).alias("row"))
    )
    least = many.groupBy(F.col("doc_id").alias("_least_id")).agg(F.min("_order").alias("_least"))
    many = many.join(
        least, (F.col("doc_id") == F.col("_least_id")) & (F.col("_order") == F.col("_least"))
    ).drop("_least", "_least_id", "_order")
    return once.unionByName(many.dropDuplicates(["doc_id"]))
