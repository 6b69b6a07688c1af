"""Alignment of two tokenisers' ids by products of sparse incidence matrices.

Both tokenisers cut the same bytes. Row i of the incidence matrix A holds the bytes of the
i-th token of the first, B likewise. Their product A·Bᵀ, computed row by row (Gustavson:
gather the rows of Bᵀ that a row of A names, merge equal columns), has an entry for every
pair of tokens that overlap, and counts their common bytes. Bytes where tokens of both end
cut the text into groups; the product of the token-group incidences links all tokens that
share a group. Matrices are in compressed rows (``Csr``) and cover many texts at once, as
blocks on the diagonal; a text longer than a block is cut at group ends.

A corpus-wide count of each linked id pair is one aggregation of the pairs of every text,
which are stored once with their multiplicities. Texts then look up their own pairs: the
counts are broadcast when they were measured small, and joined by shuffle otherwise.

Defined cases: a null or empty text, and one that a tokeniser does not give back byte by
byte, has no tokens and no groups; strings of special tokens are plain text; repeated rows
count each; an empty table gives an empty result; other columns are not read.
"""

from __future__ import annotations

import hashlib
import json
import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from procrisk.llm.common import beside, narrow, reachable
from procrisk.session import stage

#: Bytes of text that one product covers, and rows told at once.
BLOCK = 1 << 19
_ROWS = 256
MARK = "▁"
#: A run without white space beyond this goes through the file's own library.
_LONG_RUN = re.compile(r"\S{50000}|\s{50000}")


# -- Sparse products --------------------------------------------------------------------


@dataclass(frozen=True)
class Csr:
    """Compressed rows: columns of row i are ``col[ptr[i]:ptr[i + 1]]``; all entries are 1."""

    ptr: np.ndarray
    col: np.ndarray
    width: int

    @classmethod
    def of(cls, row: np.ndarray, col: np.ndarray, height: int, width: int) -> Csr:
        """From entries in the order of their rows."""
        ptr = np.zeros(height + 1, dtype=np.int64)
        np.cumsum(np.bincount(row, minlength=height), out=ptr[1:])
        return cls(ptr, col, width)

    @property
    def rows(self) -> np.ndarray:
        """The row of every entry."""
        return np.repeat(np.arange(len(self.ptr) - 1), np.diff(self.ptr))

    def transposed(self) -> Csr:
        order = np.argsort(self.col, kind="stable")
        return Csr.of(self.col[order], self.rows[order], self.width, len(self.ptr) - 1)


def product(a: Csr, b: Csr) -> tuple[Csr, np.ndarray]:
    """a·b by Gustavson's rows: its pattern, and the value of every entry."""
    begin = b.ptr[a.col]
    sizes = b.ptr[a.col + 1] - begin
    row = np.repeat(a.rows, sizes)
    before = np.cumsum(sizes) - sizes
    col = b.col[np.repeat(begin - before, sizes) + np.arange(len(row))]
    key = row * b.width + col
    if len(key) > 1 and (key[1:] < key[:-1]).any():
        key = np.sort(key)
    head = np.flatnonzero(np.diff(key, prepend=-1))
    values = np.diff(np.append(head, len(key)))
    row, col = np.divmod(key[head], b.width) if b.width else (row, col)
    return Csr.of(row, col, len(a.ptr) - 1, b.width), values


def bytes_of_tokens(lengths: np.ndarray) -> Csr:
    """Incidence of consecutive tokens and the bytes they cover."""
    ptr = np.append(0, np.cumsum(lengths))
    return Csr(ptr, np.arange(ptr[-1]), int(ptr[-1]))


def cuts(a_ends: np.ndarray, b_ends: np.ndarray) -> np.ndarray:
    """Byte offsets where tokens of both end."""
    return np.intersect1d(a_ends, b_ends, assume_unique=True)


def groups_of_tokens(ends: np.ndarray, at: np.ndarray) -> Csr:
    """Incidence of tokens and the groups between the offsets ``at``."""
    group = np.searchsorted(at, ends)
    return Csr(np.arange(len(ends) + 1), group, len(at))


def overlap_links(a_lengths: np.ndarray, b_lengths: np.ndarray, at: np.ndarray) -> tuple:
    """Pairs (position in a, position in b) of overlapping tokens, by products over slices of
    about ``BLOCK`` bytes that end at group ends ``at``."""
    a_ends, b_ends = np.cumsum(a_lengths), np.cumsum(b_lengths)
    found, low = [], 0
    a0 = b0 = 0
    while a0 < len(a_lengths):
        high = at[min(np.searchsorted(at, low + BLOCK), len(at) - 1)]
        a1, b1 = np.searchsorted(a_ends, high) + 1, np.searchsorted(b_ends, high) + 1
        a, b = bytes_of_tokens(a_lengths[a0:a1]), bytes_of_tokens(b_lengths[b0:b1])
        # Tokens cover consecutive bytes, so the transpose needs no sorting.
        turned = Csr(np.arange(b.width + 1), b.rows, len(b.ptr) - 1)
        links, _ = product(a, turned)
        found.append((links.rows + a0, links.col + b0))
        low, a0, b0 = high, a1, b1
    none = np.zeros(0, dtype=np.int64)
    return tuple(np.concatenate(x) for x in zip(*found, strict=True)) if found else (none, none)


def shared_links(a_ends: np.ndarray, b_ends: np.ndarray, at: np.ndarray) -> tuple:
    """Pairs of tokens of one group."""
    a, b = groups_of_tokens(a_ends, at), groups_of_tokens(b_ends, at)
    links, _ = product(a, b.transposed())
    return links.rows, links.col


# -- Tokenisers -------------------------------------------------------------------------


class Tokens:
    """Bytes of every id of a vocabulary, as a list and back to back."""

    def __init__(self, names: list[bytes]):
        self.names = names
        self.sizes = np.fromiter(map(len, names), dtype=np.int64, count=len(names))
        self.begins = np.cumsum(self.sizes) - self.sizes
        self.blob = np.frombuffer(b"".join(names), dtype=np.uint8)

    def text(self, ids: np.ndarray) -> np.ndarray:
        """Bytes of the ids, joined."""
        sizes = self.sizes[ids]
        before = np.cumsum(sizes) - sizes
        return self.blob[np.repeat(self.begins[ids] - before, sizes) + np.arange(sizes.sum())]


class ByteLevel(Tokens):
    """A byte-level vocabulary of merges in the order of their ids, by a ranks encoder."""

    def __init__(self, path: str):
        import public_tokenizers
        import tiktoken
        from tokenizers import Tokenizer

        with open(path, encoding="utf-8") as file:
            model = json.load(file)["model"]
        plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
        others = sorted(set(range(256)) - set(plain))
        byte = {chr(b): b for b in plain} | {chr(256 + k): b for k, b in enumerate(others)}
        raw = {bytes(map(byte.__getitem__, name)): k for name, k in model["vocab"].items()
               if all(c in byte for c in name)}
        merges = [m.split(" ") if isinstance(m, str) else m for m in model["merges"]]
        if [model["vocab"]["".join(m)] for m in merges] != list(range(256, 256 + len(merges))):
            raise ValueError(f"ids of {path} are not in the order of their merges")
        ranks = {name: k for name, k in raw.items() if k < 256 + len(merges)}
        names = [b""] * (max(model["vocab"].values()) + 1)
        for name, k in ranks.items():
            names[k] = name
        super().__init__(names)
        self._ranks = tiktoken.Encoding(
            "ranks", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={}
        )
        self._file = Tokenizer.from_file(path)
        self._file.encode_special_tokens = True

    def encode(self, text: str) -> np.ndarray:
        """Ids of a space and the text."""
        text = " " + text
        if _LONG_RUN.search(text):
            ids = self._file.encode(text, add_special_tokens=False).ids
        else:
            ids = self._ranks.encode_ordinary(text)
        return np.array(ids, dtype=np.int64)


class PieceLevel(Tokens):
    """A SentencePiece vocabulary."""

    def __init__(self, path: str):
        from sentencepiece import SentencePieceProcessor

        self._model = SentencePieceProcessor(model_file=path)
        model, names = self._model, []
        for k in range(model.get_piece_size()):
            piece = model.id_to_piece(k)
            names.append(
                bytes([int(piece[3:5], 16)]) if model.is_byte(k) else piece.replace(MARK, " ").encode()
            )
        super().__init__(names)

    def encode(self, text: str) -> np.ndarray:
        """Ids of the text, before which the model puts a space."""
        return np.array(self._model.encode(text, num_threads=1), dtype=np.int64)


_loaded: dict[tuple[str, str], Aligner] = {}


class Aligner:
    """Both vocabularies, and how their ids are written."""

    def __init__(self, a_path: str, b_path: str):
        self.a, self.b = ByteLevel(a_path), PieceLevel(b_path)
        n_a, n_b = len(self.a.names), len(self.b.names)
        self._written = [f"{k}{end}".encode() for k in range(n_a) for end in ",|"]
        self._written += [f"{k}{end}".encode() for k in range(n_b) for end in ",;"]
        self._b_first = 2 * n_a

    @classmethod
    def at(cls, a_path: str, b_path: str) -> Aligner:
        """One per worker process."""
        key = (a_path, b_path)
        if key not in _loaded:
            _loaded[key] = cls(a_path, b_path)
        return _loaded[key]

    def tokens(self, text: str | None) -> tuple[np.ndarray, np.ndarray]:
        """Ids of both, none if one of them does not give the text back."""
        none = np.zeros(0, dtype=np.int64)
        if not text:
            return none, none
        a, b = self.a.encode(text), self.b.encode(text)
        raw = np.frombuffer(b" " + text.encode(), dtype=np.uint8)
        for side, ids in ((self.a, a), (self.b, b)):
            if side.sizes[ids].sum() != len(raw) or not np.array_equal(side.text(ids), raw):
                return none, none
        return a, b

    def rows(self, texts: list[str | None], wanted: set[str]) -> Iterator[dict]:
        """One dict of the wanted columns per text."""
        block, size = [], 0
        for text in texts:
            block.append(self.tokens(text))
            size += len(text or "")
            if size >= BLOCK:
                yield from self._block(block, wanted)
                block, size = [], 0
        yield from self._block(block, wanted)

    def _block(self, block: list[tuple], wanted: set[str]) -> Iterator[dict]:
        if not block:
            return
        a, b = (np.concatenate(ids) for ids in zip(*block, strict=True))
        n_a, n_b = (np.array(list(map(len, ids))) for ids in zip(*block, strict=True))
        a_sizes, b_sizes = self.a.sizes[a], self.b.sizes[b]
        a_ends, b_ends = np.cumsum(a_sizes), np.cumsum(b_sizes)
        at = cuts(a_ends, b_ends)
        a_groups, b_groups = groups_of_tokens(a_ends, at), groups_of_tokens(b_ends, at)
        link_a, link_b = overlap_links(a_sizes, b_sizes, at)
        a_to, b_to = np.cumsum(n_a), np.cumsum(n_b)
        a_from, b_from = a_to - n_a, b_to - n_b
        # The last group and link of each text.
        g_to = np.where(n_a > 0, a_groups.col[a_to - 1] + 1, 0) if len(a) else np.zeros_like(n_a)
        g_to = np.maximum.accumulate(g_to)
        l_to = np.searchsorted(link_a, a_to)
        per_a = np.bincount(a_groups.col, minlength=len(at))
        per_b = np.bincount(b_groups.col, minlength=len(at))
        shared = np.append(0, np.cumsum(per_a * per_b))
        if "groups" in wanted or "groups_sha256" in wanted:
            codes = self._codes(a, b, a_groups.col, b_groups.col, per_a, per_b)
        if "pairs" in wanted:
            pair = (a[link_a] << 32) | b[link_b]
        for k in range(len(block)):
            g0, g1 = (g_to[k - 1] if k else 0), g_to[k]
            l0, l1 = (l_to[k - 1] if k else 0), l_to[k]
            row = {
                "n_a": n_a[k], "n_b": n_b[k], "n_groups": g1 - g0, "n_links": l1 - l0,
                "n_shared": shared[g1] - shared[g0],
            }
            mine_a, mine_b = slice(a_from[k], a_to[k]), slice(b_from[k], b_to[k])
            if "a_ids" in wanted:
                row |= {"a_ids": a[mine_a], "b_ids": b[mine_b]}
            if "links" in wanted:
                row |= {"link_a": link_a[l0:l1] - a_from[k], "link_b": link_b[l0:l1] - b_from[k]}
            if "shared" in wanted:
                begin = a_ends[a_from[k] - 1] if a_from[k] else 0
                own = at[g0:g1] - begin
                x, y = shared_links(a_ends[mine_a] - begin, b_ends[mine_b] - begin, own)
                row |= {"shared_a": x, "shared_b": y}
            if "pairs" in wanted:
                row["pairs"], row["times"] = np.unique(pair[l0:l1], return_counts=True)
            if "groups" in wanted or "groups_sha256" in wanted:
                low, high = a_from[k] + b_from[k], a_to[k] + b_to[k]
                text = b"".join(map(self._written.__getitem__, codes[low:high].tolist()))[:-1]
                row["groups"] = text.decode()
                row["groups_sha256"] = hashlib.sha256(text).hexdigest() if text else ""
            yield row

    def _codes(self, a, b, a_group, b_group, per_a, per_b) -> np.ndarray:
        """How to write all ids in order: group by group, those of a before those of b."""
        a_last = np.append(a_group[1:] != a_group[:-1], True)[: len(a)]
        b_last = np.append(b_group[1:] != b_group[:-1], True)[: len(b)]
        codes = np.empty(len(a) + len(b), dtype=np.int64)
        codes[np.arange(len(a)) + (np.cumsum(per_b) - per_b)[a_group]] = 2 * a + a_last
        codes[np.arange(len(b)) + np.cumsum(per_a)[b_group]] = self._b_first + 2 * b + b_last
        return codes


# -- Operators --------------------------------------------------------------------------

_COLUMNS = {
    "a_ids": ["a_ids", "b_ids"],
    "links": ["link_a", "link_b"],
    "shared": ["shared_a", "shared_b"],
    "pairs": ["pairs", "times"],
    "groups": ["groups"],
    "groups_sha256": ["groups_sha256"],
}
_COUNTS = ["n_a", "n_b", "n_groups", "n_links", "n_shared"]


def align(docs: DataFrame, a_path: str, b_path: str, *wanted: str) -> DataFrame:
    """Row number, doc_id, counts of tokens, groups and both kinds of links, and by request
    ``a_ids`` (with b_ids), ``links`` (link_a, link_b: positions of overlapping tokens),
    ``shared`` (shared_a, shared_b: positions in one group, which grow with the square of a
    group), ``pairs`` (with times: different linked id pairs, a in the upper 32 bits),
    ``groups`` as text or its ``groups_sha256``."""
    reachable(docs.sparkSession)
    names = [name for w in wanted for name in _COLUMNS[w]]
    wide = {"pairs": pa.list_(pa.int64()), "groups": pa.string(), "groups_sha256": pa.string()}
    kinds = {n: pa.int64() for n in _COUNTS} | {n: wide.get(n, pa.list_(pa.int32())) for n in names}
    sql = {pa.int64(): "long", pa.string(): "string", pa.list_(pa.int64()): "array<long>"}
    schema = ", ".join(f"{n} {sql.get(k, 'array<int>')}" for n, k in kinds.items())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        both, number = Aligner.at(a_path, b_path), TaskContext.get().partitionId() << 40
        for batch in batches:
            ids = batch.column("doc_id").cast(pa.int64())
            for k in range(0, len(batch), _ROWS):
                texts = batch.column("text").slice(k, _ROWS).to_pylist()
                rows = list(both.rows(texts, set(wanted)))
                keys = pa.array(range(number, number + len(rows)), pa.int64())
                told = [_column([r[n] for r in rows], kind) for n, kind in kinds.items()]
                yield pa.RecordBatch.from_arrays(
                    [keys, ids.slice(k, _ROWS), *told], ["row", "doc_id", *kinds]
                )
                number += len(rows)

    return narrow(docs, "doc_id", "text").mapInArrow(run, f"row long, doc_id long, {schema}")


def _column(values: list, kind: pa.DataType) -> pa.Array:
    if not pa.types.is_list(kind):
        return pa.array(values, kind)
    ends = np.cumsum([0, *map(len, values)])
    flat = np.concatenate(values).astype(kind.value_type.to_pandas_dtype())
    return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(flat))


def pair_counts(aligned: DataFrame) -> DataFrame:
    """pair, count and ``best`` (no other pair of its b id is counted more often), for a
    stored table with pairs and times."""
    linked = aligned.select(F.explode(F.arrays_zip("pairs", "times")).alias("p")).select("p.*")
    counted = stage(
        linked.groupBy(F.col("pairs").alias("pair")).agg(F.sum("times").alias("count")), "pair-counts"
    )
    b_id = F.col("pair").bitwiseAND(F.lit(0xFFFFFFFF))
    tops = counted.groupBy(b_id.alias("b_id")).agg(F.max("count").alias("top"))
    with_id = counted.withColumn("b_id", b_id)
    return with_id.join(tops, "b_id").select("pair", "count", (F.col("count") == F.col("top")).alias("best"))


def alignments(docs: DataFrame, a_path: str, b_path: str) -> DataFrame:
    """Counts of every text, how many of its links are the best of their b id, the sum of the
    links' corpus-wide counts, and the digest of its groups."""
    aligned = stage(align(docs, a_path, b_path, "pairs", "groups_sha256"), "aligned")
    counts = beside(stage(pair_counts(aligned), "pair-tops"), 32)
    own = aligned.select("row", F.explode(F.arrays_zip("pairs", "times")).alias("p")).select(
        "row", F.col("p.pairs").alias("pair"), "p.times"
    )
    of_row = own.join(counts, "pair").groupBy("row").agg(
        F.sum(F.when(F.col("best"), F.col("times")).otherwise(0)).alias("n_best"),
        F.sum(F.col("count") * F.col("times")).alias("count_sum"),
    )
    told = aligned.select("row", "doc_id", *_COUNTS, "groups_sha256").join(of_row, "row", "left")
    zero = F.lit(0).cast("long")
    return told.select(
        "doc_id", "n_a", "n_b", "n_groups", "n_links",
        F.coalesce("n_best", zero).alias("n_best"), F.coalesce("count_sum", zero).alias("count_sum"),
        "groups_sha256", "n_shared",
    )
