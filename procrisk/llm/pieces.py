"""SentencePiece encoding by unigram Viterbi search, and decoding.

The pieces of a vocabulary file are put into a double-array trie over UTF-8 bytes. Their log
scores are those of Zipf's law for the file's order, or the file's own scores. Encoding
finds the segmentation with the largest sum of scores; a character that no piece begins with
alone gets the unknown score and is written as its bytes. White space is marked by U+2581,
with one mark put before the text; decoding turns marks into spaces and bytes into
characters and drops the first space again.

No piece of the vocabularies in use has a mark behind another character, so a best
segmentation never crosses the place before a mark, and the parts between such places are
segmented by themselves and remembered. For other vocabularies texts are not cut.

Defined cases: a null or empty text has no pieces and decodes to the empty text; a text's
own U+2581 becomes a space, as the format has no other sign for it; bytes that are no UTF-8
decode to U+FFFD; of segmentations with equal scores any may be taken, the same one each
time; an empty table gives no rows.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql.types import StructField, StructType

MARK = "▁"
#: How far an unknown character scores below the worst piece.
UNKNOWN_PENALTY = 10.0
#: Parts that are remembered, characters of the longest, and parts segmented at once.
_REMEMBERED = 60_000
_SHORT = 64
_TOGETHER = 4_000
#: Texts that are cut into parts at once.
_ROWS = 200
_PARTS = re.compile(f"{MARK}*[^{MARK}]+|{MARK}+")


# -- Double-array trie ----------------------------------------------------------------


#: Slots among which room for a node's children is looked for at once.
_LOOK = 4096


def _room(used: bytearray, codes: list[int], start: int) -> int:
    """The first base from ``start`` on whose children by ``codes`` are all free."""
    while True:
        taken = np.zeros(_LOOK, dtype=np.uint8)
        view = np.frombuffer(used, dtype=np.uint8)
        for c in codes:
            part = view[start + c : start + c + _LOOK]
            taken[: len(part)] |= part
        free = np.flatnonzero(taken == 0)
        if len(free):
            return start + int(free[0])
        start += _LOOK


@dataclass
class DoubleArray:
    """A trie in two arrays: the child of node s by byte c is t = base[s] + c + 1 if
    check[t] == s. ``value`` holds the piece that ends at a node, or -1."""

    base: np.ndarray
    check: np.ndarray
    value: np.ndarray

    @classmethod
    def of(cls, keys: dict[bytes, int]) -> DoubleArray:
        children: list[dict[int, int]] = [{}]
        value = [-1]
        for key, number in keys.items():
            node = 0
            for c in key:
                if c not in children[node]:
                    children[node][c] = len(children)
                    children.append({})
                    value.append(-1)
                node = children[node][c]
            value[node] = number
        # The widest bytes put a child 256 slots behind its base at most.
        size = 4 * len(children) + 4 * _LOOK
        base, check, out = [0] * size, [-1] * size, [-1] * size
        used = bytearray(size)
        used[0] = 1
        order, slot = [0], {0: 0}
        for node in order:
            order.extend(children[node].values())
        lone, many = 257, 1  # where to look for room for one child, and for several
        for node in order:
            own = slot[node]
            out[own] = value[node]
            codes = [c + 1 for c in sorted(children[node])]
            if not codes:
                continue
            if max(lone, many + 2 * _LOOK) + 1024 > size:
                more = size
                base += [0] * more
                check += [-1] * more
                out += [-1] * more
                used += bytearray(more)
                size += more
            if len(codes) == 1:
                lone = used.index(0, lone)
                at = lone - codes[0]
            else:
                at = _room(used, codes, many)
                many = max(many, at - _LOOK)  # what lies further back is crowded
            base[own] = at
            for c in codes:
                used[at + c] = 1
                check[at + c] = own
            for c, child in children[node].items():
                slot[child] = at + c + 1
        last = used.rindex(1) + 258
        arrays = (np.array((x + [0] * 300)[:last], np.int32) for x in (base, check, out))
        return cls(*arrays)


# -- Model ----------------------------------------------------------------------------


@dataclass
class Pieces:
    """Vocabulary, scores and trie; built once and broadcast."""

    pieces: list[str]
    scores: list[float]
    byte_ids: list[int]
    unknown: int
    trie: DoubleArray
    cut: bool
    fallback: bool
    dummy_prefix: bool = True
    _known: dict = field(default_factory=dict)
    _older: dict = field(default_factory=dict)

    def __getstate__(self):
        return {k: v for k, v in self.__dict__.items() if not k.startswith("_")}

    def __setstate__(self, state):
        self.__dict__.update(state, _known={}, _older={})

    def _loaded(self):
        if "_lists" not in self.__dict__:
            t = self.trie
            self._lists = (t.base.tolist(), t.check.tolist(), t.value.tolist())
        return self._lists

    @property
    def unknown_score(self) -> float:
        return min(s for s in self.scores if s > -np.inf) - UNKNOWN_PENALTY

    def segment(self, text: str) -> list[int]:
        """Ids of the best segmentation of marked text."""
        base, check, value = self._loaded()
        if "_unknown_score" not in self.__dict__:
            self._unknown_score = self.unknown_score
        raw, scores = text.encode(), self.scores
        n = len(raw)
        best = [-np.inf] * (n + 1)
        best[0] = 0.0
        origin, piece = [-1] * (n + 1), [0] * (n + 1)
        at = 0
        while at < n:
            lead = raw[at]
            one = at + (1 if lead < 128 else 2 if lead < 224 else 3 if lead < 240 else 4)
            here, node, alone = best[at], 0, False
            for end in range(at, n):
                child = base[node] + raw[end] + 1
                if check[child] != node:
                    break
                node = child
                number = value[node]
                if number >= 0:
                    stop = end + 1
                    total = here + scores[number]
                    if total > best[stop]:
                        best[stop], origin[stop], piece[stop] = total, at, number
                    alone |= stop == one
            if not alone:
                total = here + self._unknown_score
                if total > best[one]:
                    best[one], origin[one], piece[one] = total, at, -1
            at = one
        out: list[int] = []
        end = n
        while end > 0:
            start = origin[end]
            if piece[end] >= 0:
                out.append(piece[end])
            elif self.fallback:
                out.extend(self.byte_ids[b] for b in reversed(raw[start:end]))
            else:
                out.append(self.unknown)
            end = start
        out.reverse()
        return out

    def segment_many(self, parts: list[str]) -> list[bytes]:
        """Ids of the best segmentation of each short part, as 32-bit arrays.

        All parts are walked through the trie at once, one byte further in each step, which
        gives the edges of their lattices; then the places of equal distance from the
        beginning of their parts are settled at once, nearest first.
        """
        raws = [p.encode() for p in parts]
        sizes = np.fromiter(map(len, raws), dtype=np.int64, count=len(raws))
        begins = np.concatenate([[0], np.cumsum(sizes)])
        text = np.frombuffer(b"".join(raws), dtype=np.uint8)
        owner = np.repeat(np.arange(len(parts)), sizes)
        start = np.flatnonzero((text & 0xC0) != 0x80)
        first = text[start]
        width = 1 + (first >= 0xC0).astype(np.int64) + (first >= 0xE0) + (first >= 0xF0)

        base, check, value = self.trie.base, self.trie.check, self.trie.value
        s, at, node = start, start, np.zeros(len(start), dtype=np.int64)
        edges = []
        while len(s):
            child = base[node] + text[at].astype(np.int64) + 1
            ok = check[child] == node
            s, at, node = s[ok], at[ok] + 1, child[ok]
            number = value[node]
            hit = number >= 0
            edges.append((s[hit], at[hit], number[hit]))
            more = at < begins[owner[s] + 1]
            s, at, node = s[more], at[more], node[more]
        begin, end, piece = (np.concatenate(x) for x in zip(*edges, strict=True))
        # A character that is no piece by itself is an edge of its own.
        one = np.zeros(len(text) + 1, dtype=np.int64)
        one[start] = start + width
        alone = np.zeros(len(text) + 1, dtype=bool)
        alone[begin[end == one[begin]]] = True
        lost = ~alone[start]
        begin = np.concatenate([begin, start[lost]])
        end = np.concatenate([end, (start + width)[lost]])
        piece = np.concatenate([piece, np.full(int(lost.sum()), -1, piece.dtype)])
        if "_score_array" not in self.__dict__:
            self._score_array = np.array([*self.scores, self.unknown_score])
        score = self._score_array[piece]

        part = owner[begin]
        offset = begin - begins[part]
        order = np.lexsort((end, offset))
        groups = np.split(order, np.flatnonzero(np.diff(offset[order])) + 1)
        # Every part has a place more than bytes, for its end.
        tail, head = begin + part, end + part
        best = np.full(len(text) + len(parts), -np.inf)
        by = np.full(len(best), -1, dtype=np.int64)
        zero = begins[:-1] + np.arange(len(parts))
        best[zero] = 0.0
        for edge in groups:
            total = best[tail[edge]] + score[edge]
            better = total > best[head[edge]]
            edge = edge[better]
            best[head[edge]] = total[better]
            by[head[edge]] = edge

        which, place = np.arange(len(parts)), begins[1:] + np.arange(len(parts))
        found = []
        while len(which):
            edge = by[place]
            found.append((which, piece[edge]))
            place = tail[edge]
            more = place != zero[which]
            which, place = which[more], place[more]
        step = np.repeat(np.arange(len(found)), [len(w) for w, _ in found])
        which, ids = (np.concatenate(x) for x in zip(*found, strict=True))
        order = np.lexsort((-step, which))
        blob = ids[order].astype("<i4").tobytes()
        cuts = (4 * np.concatenate([[0], np.cumsum(np.bincount(which, minlength=len(parts)))])).tolist()
        out = [blob[a:b] for a, b in zip(cuts[:-1], cuts[1:], strict=True)]
        for k in np.unique(which[ids < 0]).tolist():  # unknown characters become bytes
            out[k] = np.array(self.segment(parts[k]), dtype="<i4").tobytes()
        return out

    def _learn(self, parts: set[str]) -> None:
        """Remembers the segmentations of ``parts``, which are not remembered yet."""
        short, known = [], self._known
        for part in parts:
            older = self._older.get(part)
            if older is not None:
                known[part] = older
            elif len(part) <= _SHORT:
                short.append(part)
            else:
                known[part] = np.array(self.segment(part), dtype="<i4").tobytes()
        for k in range(0, len(short), _TOGETHER):
            some = short[k : k + _TOGETHER]
            known.update(zip(some, self.segment_many(some), strict=True))

    def encode_many(self, texts: list[str]) -> list[np.ndarray]:
        """Ids of every text."""
        cut = []
        for text in texts:
            marked = text.replace(" ", MARK)
            if self.dummy_prefix and text:
                marked = MARK + marked
            cut.append(_PARTS.findall(marked) if self.cut else [marked] if marked else [])
        missing = set()
        for parts in cut:
            missing.update(parts)
        missing -= self._known.keys()
        if missing:
            self._learn(missing)
        get = self._known.__getitem__
        out = [np.frombuffer(b"".join(map(get, parts)), dtype="<i4") for parts in cut]
        for part in [p for p in missing if len(p) > _SHORT]:
            del self._known[part]
        if len(self._known) >= _REMEMBERED:  # drop the generation before this one
            self._older, self._known = self._known, {}
        return out

    def encode(self, text: str) -> np.ndarray:
        return self.encode_many([text])[0]

    def decode(self, ids: list[int]) -> str:
        if "_raw" not in self.__dict__:
            self._raw = [p.replace(MARK, " ").encode() for p in self.pieces]
            for b, k in enumerate(self.byte_ids):
                if k >= 0:
                    self._raw[k] = bytes([b])
        raw = b"".join(map(self._raw.__getitem__, ids))
        if self.dummy_prefix and raw[:1] == b" ":
            raw = raw[1:]
        return raw.decode(errors="replace")


def load_pieces(path: str, scores: str = "zipf") -> Pieces:
    """Vocabulary of a SentencePiece file. ``scores``: ``zipf``, log probabilities by the
    order of the pieces, or ``file``, the scores stored there."""
    from sentencepiece import SentencePieceProcessor

    read = SentencePieceProcessor(model_file=path)
    n = read.get_piece_size()
    names = [read.id_to_piece(k) for k in range(n)]
    byte_ids = [-1] * 256
    normal = []
    for k in range(n):
        if read.is_byte(k):
            byte_ids[int(names[k][3:5], 16)] = k
        elif not (read.is_control(k) or read.is_unknown(k) or read.is_unused(k)):
            normal.append(k)
    values = [-np.inf] * n
    ranked = sorted(normal, key=lambda k: (-read.get_score(k), k))
    total = np.log(np.sum(1.0 / np.arange(1, len(ranked) + 1)))
    for rank, k in enumerate(ranked, 1):
        values[k] = float(read.get_score(k)) if scores == "file" else float(-np.log(rank) - total)
    inner = re.compile(f"[^{MARK}]{MARK}")
    return Pieces(
        pieces=names,
        scores=values,
        byte_ids=byte_ids,
        unknown=read.unk_id(),
        trie=DoubleArray.of({names[k].encode(): k for k in normal}),
        cut=not any(inner.search(names[k]) for k in normal),
        fallback=min(byte_ids) >= 0,
    )


# -- Operators ------------------------------------------------------------------------


def _with_column(
    rows: DataFrame, source: str, name: str, kind: str, values: Callable[[pa.Array], pa.Array]
) -> DataFrame:
    """``rows`` with a column computed from ``source`` by Arrow batches; an older column of
    that name is replaced, all others pass through untouched."""
    rows = rows.select(*(c for c in rows.columns if c != name))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = values(batch.column(source))
            yield pa.RecordBatch.from_arrays([*batch.columns, found], [*batch.schema.names, name])

    return rows.mapInArrow(run, StructType([*rows.schema.fields, *_fields(f"{name} {kind}")]))


def _fields(ddl: str) -> list[StructField]:
    return StructType.fromDDL(ddl).fields


def encode(docs: DataFrame, model: Pieces, column: str = "text") -> DataFrame:
    """``docs`` with ``piece_ids`` (array of int); null texts count as empty."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def values(texts: pa.Array) -> pa.Array:
        ids, ends = [np.zeros(0, dtype=np.int32)], [0]
        for k in range(0, len(texts), _ROWS):
            found = shared.value.encode_many([t or "" for t in texts.slice(k, _ROWS).to_pylist()])
            ends += (ends[-1] + np.cumsum([len(f) for f in found])).tolist()
            ids.append(np.concatenate(found))
        return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(np.concatenate(ids)))

    return _with_column(docs, column, "piece_ids", "array<int>", values)


def decode(encoded: DataFrame, model: Pieces, column: str = "piece_ids") -> DataFrame:
    """``encoded`` with ``decoded``, the text of the ids in ``column``; null has none."""
    shared = encoded.sparkSession.sparkContext.broadcast(model)

    def values(rows: pa.Array) -> pa.Array:
        ids, ends = rows.values.to_numpy(zero_copy_only=False), rows.offsets.to_numpy()
        text = shared.value.decode
        return pa.array(
            [text(ids[a:b].tolist()) for a, b in zip(ends[:-1], ends[1:], strict=True)], pa.string()
        )

    return _with_column(encoded, column, "decoded", "string", values)


def encode_checked(docs: DataFrame, model: Pieces, column: str = "text") -> DataFrame:
    """``docs`` with ``piece_ids`` and ``round_trip``, whether these decode to the text, in one
    pass that holds the ids of a slice of rows at a time. Older columns of these two names are
    replaced, all others pass through; a null text counts as empty."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    names = ("piece_ids", "round_trip")
    rows = docs.select(*(c for c in docs.columns if c not in names))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy()
            for a, b in _slices_of(sizes):
                part = batch.slice(a, b - a)
                texts = [t or "" for t in part.column(column).to_pylist()]
                found = shared.value.encode_many(texts)
                same = [shared.value.decode(f.tolist()) == t for f, t in zip(found, texts, strict=True)]
                ends = np.cumsum([0, *map(len, found)])
                ids = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(np.concatenate(found)))
                yield pa.RecordBatch.from_arrays(
                    [*part.columns, ids, pa.array(same)], [*part.schema.names, *names]
                )

    told = _fields("piece_ids array<int>, round_trip boolean")
    return rows.mapInArrow(run, StructType([*rows.schema.fields, *told]))


def _slices_of(sizes: np.ndarray, size: int = 1 << 20) -> Iterator[tuple[int, int]]:
    """Ranges of rows of about ``size`` bytes of text in all, one row at least."""
    a, held = 0, 0
    for b, n in enumerate(sizes.tolist(), 1):
        held += n
        if held >= size or b == len(sizes):
            yield a, b
            a, held = b, 0
