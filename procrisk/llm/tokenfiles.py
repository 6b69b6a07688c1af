"""Token-id files: each text is tokenised and compressed by itself with a shared dictionary.

A file holds rows of shards. A shard keeps the compressed texts of a run of documents back
to back, with an index of their offsets, their token counts, their first position in the
stream of all ids, and the hash of the dictionary that decodes them, so one short document
is read by decompressing its own frame only. The dictionary is trained on serialised id
arrays of a bounded sample and stored beside the shards.

Texts are cut at single spaces between two other characters, where the tokenizer's own
pattern always starts a new word, and the ids of a piece are remembered, so that a frequent
word is tokenised once per worker. A special token of the vocabulary that a text spells out
has its own id, as in the library's plain call.

Defined cases: a null or empty text has the end id alone; rows are written in ascending
doc_id (nulls first), rows of one doc_id by text; an empty table gives empty files.
"""

from __future__ import annotations

import hashlib
import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from procrisk.llm.common import beside, narrow, row_key, text_of, with_whole_ids
from procrisk.session import fresh_path, stage

END = 2
#: Bounds of the dictionary's training sample: texts, characters of each, dictionary bytes.
SAMPLE_TEXTS = 800
SAMPLE_LENGTH = 20_000
DICTIONARY_BYTES = 64 << 10
#: Compressed bytes of a shard, and text bytes of a partition.
SHARD_BYTES = 2 << 20
PARTITION_BYTES = 32 << 20
LEVEL = 3

_CUT = re.compile(r"(?<=\S) (?=\S)")
#: Words of Latin letters, and marks that may follow them.
_LATIN = re.compile(r"[A-Za-zÀ-ÖØ-öø-ÿ]+")
_MARKS = ".,;:!?#*$%&|<>()\"/=+-"
#: White space that is neither a space nor a line end.
_ODD = re.compile(r"[^\S \n]")
_REMEMBERED = 300_000

SHARDS = (
    "part int, number int, start long, n_ids long, dictionary string, width int, "
    "doc_ids array<long>, without_id array<int>, offsets array<long>, counts array<long>, data binary"
)


_SHARD_SCHEMA = pa.schema(
    [
        ("part", pa.int32()), ("number", pa.int32()), ("start", pa.int64()), ("n_ids", pa.int64()),
        ("dictionary", pa.string()), ("width", pa.int32()), ("doc_ids", pa.list_(pa.int64())),
        ("without_id", pa.list_(pa.int32())), ("offsets", pa.list_(pa.int64())),
        ("counts", pa.list_(pa.int64())), ("data", pa.binary()),
    ]
)


def _byte_letters() -> dict[int, str]:
    """How byte-level vocabularies write bytes: printable ones as themselves, the others as
    letters from U+0100 on, in order."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [b for b in range(256) if b not in set(plain)]
    return {b: chr(b) for b in plain} | {b: chr(256 + k) for k, b in enumerate(others)}


class Encoder:
    """Ids of whole texts as serialised arrays of 16 or 32 bits, the end id included.

    A piece of Latin letters, with marks after them, is cut as the tokenizer's pattern cuts
    it and goes to its model directly; all others go through the whole tokenizer. What was
    found is kept in two generations, of which the older is dropped when the younger is full.
    """

    def __init__(self, vocabulary: str, end: int = END):
        from tokenizers import Tokenizer

        self._tokenizer = Tokenizer.from_file(vocabulary)
        self._model = self._tokenizer.model
        self._letters = _byte_letters()
        self._space = self._letters[32]
        size = max(self._tokenizer.get_vocab_size(with_added_tokens=True), end + 1)
        self.kind = np.dtype("<u2" if size <= 1 << 16 else "<u4")
        self._id = [k.to_bytes(self.kind.itemsize, "little") for k in range(size)]
        self._end = self._id[end]
        self._line = self._whole("\n")
        self._new: dict[str, bytes] = {}
        self._old: dict[str, bytes] = {}
        self._alone: dict[str, bytes] = {}

    def _model_ids(self, mapped: str) -> bytes:
        one = self._id
        return b"".join([one[t.id] for t in self._model.tokenize(mapped)])

    def _word(self, word: str, space: bool) -> bytes:
        """Ids of ``word``, and of a space before it, which the pattern takes as one with it."""
        mapped = word if word.isascii() else word.encode().decode("latin-1").translate(self._letters)
        return self._model_ids(self._space + mapped if space else mapped)

    def _marks(self, marks: str) -> bytes:
        found = self._alone.get(marks)
        if found is None:
            if len(self._alone) >= 20_000:
                self._alone.clear()
            found = self._alone[marks] = self._whole(marks)
        return found

    def _whole(self, text: str) -> bytes:
        one = self._id
        ids = self._tokenizer.encode(text, add_special_tokens=False).ids
        return b"".join([one[k] for k in ids])

    def _piece(self, piece: str, space: bool = True) -> bytes:
        """Ids of ``piece``, and of a space before it. A line end between two other characters
        is a word of its own for the pattern, so lines are taken one by one."""
        letters = piece.rstrip(_MARKS)
        if (letters.isascii() and letters.isalpha()) or _LATIN.fullmatch(letters):
            ids = self._word(letters, space)
            return ids if len(letters) == len(piece) else ids + self._marks(piece[len(letters) :])
        if "\n" in piece:
            lines = piece.split("\n")
            if all(lines):
                found = [self._piece(lines[0], space)]
                for line in lines[1:]:
                    found += (self._line, self._piece(line, False))
                return b"".join(found)
        return self._whole(" " + piece if space else piece)

    def _learn(self, piece: str) -> bytes:
        """Ids of a space and ``piece``, which is not among the younger ones, remembered."""
        found = self._old.get(piece)
        if found is None:
            found = self._piece(piece)
        if len(self._new) >= _REMEMBERED:
            self._old, self._new = self._new, {}
        self._new[piece] = found
        return found

    def _cut(self, text: str) -> bytes:
        """A text with other white space than single spaces and line ends."""
        head, *rest = _CUT.split(text)
        known = [self._new.get(piece) or self._learn(piece) for piece in rest]
        return b"".join([self._whole(head) if head else b"", *known, self._end])

    def encode(self, texts: list[str]) -> list[bytes]:
        """Texts cut at single spaces are encoded together: Arrow finds their different
        pieces, each of which is looked up once, and puts the ids back in order."""
        plain = [k for k, text in enumerate(texts) if _is_plain(text)]
        out: list[bytes] = [b""] * len(texts)
        for k in set(range(len(texts))) - set(plain):
            out[k] = self._cut(texts[k])
        if not plain:
            return out
        cut = pc.split_pattern(pa.array([texts[k] for k in plain], pa.large_string()), " ")
        begins = cut.offsets.to_numpy()
        coded = cut.values.dictionary_encode()
        names, at = coded.dictionary.to_pylist(), coded.indices.to_numpy()
        found = list(map(self._new.get, names))
        for k, ids in enumerate(found):
            if ids is None:
                found[k] = self._learn(names[k])
        # The first piece of a text has no space before it; every text ends with the end id.
        heads = [names[k] for k in at[begins[:-1]].tolist()]
        at = at.astype(np.int64)
        at[begins[:-1]] = len(found) + np.arange(len(heads))
        found += [self._piece(head, False) if head else b"" for head in heads]
        found.append(self._end)
        at = np.insert(at, begins[1:], len(found) - 1)
        ids = np.frombuffer(b"".join(found), dtype=self.kind)
        sizes = np.fromiter(map(len, found), dtype=np.int32, count=len(found)) // self.kind.itemsize
        starts = (np.cumsum(sizes, dtype=np.int32) - sizes)[at]
        sizes = sizes[at]
        upto = np.cumsum(sizes, dtype=np.int32)  # a slice of texts, or one long text
        order = np.repeat(starts - (upto - sizes), sizes) + np.arange(upto[-1], dtype=np.int32)
        blob = memoryview(ids[order].tobytes())
        ends = upto[begins[1:] + np.arange(len(plain))] * self.kind.itemsize
        for k, a, b in zip(plain, [0, *ends[:-1].tolist()], ends.tolist(), strict=True):
            out[k] = bytes(blob[a:b])
        return out


def _is_plain(text: str) -> bool:
    """Whether all white space is single spaces between words, and line ends without any."""
    if "  " in text or " \n" in text or "\n " in text or text[:1] == " " or text[-1:] == " ":
        return False
    return text.isprintable() or not _ODD.search(text)


_encoders: dict[str, Encoder] = {}


def encoder(vocabulary: str) -> Encoder:
    """One per worker process, so that what it remembers serves all its tasks."""
    if vocabulary not in _encoders:
        _encoders[vocabulary] = Encoder(vocabulary)
    return _encoders[vocabulary]


@dataclass(frozen=True)
class Dictionary:
    data: bytes

    @property
    def name(self) -> str:
        return hashlib.sha256(self.data).hexdigest()

    def _loaded(self):
        return zstandard.ZstdCompressionDict(self.data) if self.data else None

    def compressor(self):
        return zstandard.ZstdCompressor(
            level=LEVEL, dict_data=self._loaded(), write_checksum=False, write_dict_id=False
        )

    def decompressor(self):
        return zstandard.ZstdDecompressor(dict_data=self._loaded())


def train_dictionary(
    docs: DataFrame,
    vocabulary: str,
    sample_texts: int = SAMPLE_TEXTS,
    sample_length: int = SAMPLE_LENGTH,
) -> Dictionary:
    """Dictionary from serialised ids of about ``sample_texts`` texts, drawn by hash among
    those of up to ``sample_length`` characters. Too few texts give the empty dictionary."""
    fit = narrow(docs, "doc_id", "text").where(
        F.length(text_of()).between(1, sample_length)
    )
    total = fit.count()
    if not total:
        return Dictionary(b"")
    share = int(min(1.0, sample_texts / total) * (1 << 30))
    drawn = fit.where(F.pmod(F.xxhash64("doc_id", F.lit(5)), F.lit(1 << 30)) < share)
    # The bound is only met if ids repeat; then the texts of least hash are taken.
    drawn = drawn.orderBy(row_key(), "text").limit(4 * sample_texts)
    texts = sorted(r["text"] for r in drawn.select("text").collect())
    arrays = encoder(vocabulary).encode(texts)
    try:
        trained = zstandard.train_dictionary(DICTIONARY_BYTES, arrays, level=LEVEL)
    except zstandard.ZstdError:  # too little to learn from
        return Dictionary(b"")
    return Dictionary(trained.as_bytes())


def write_tokens(docs: DataFrame, vocabulary: str, folder: str | None = None) -> str:
    """Write the shards of ``docs`` and their dictionary; returns the folder."""
    spark = docs.sparkSession
    folder = folder or fresh_path(spark, "token-files")
    rows = narrow(docs, "doc_id", "text").select("doc_id", text_of().alias("text"))
    size = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    dictionary = train_dictionary(docs, vocabulary)
    spark.createDataFrame(
        [(dictionary.name, dictionary.data)], "dictionary string, data binary"
    ).write.parquet(f"{folder}/dictionary")
    parts = max(
        int(spark.conf.get("spark.sql.shuffle.partitions")), -(-size // PARTITION_BYTES), 1
    )

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, number, start = TaskContext.get().partitionId(), 0, 0
        tokens, press = encoder(vocabulary), dictionary.compressor()
        width = tokens.kind.itemsize
        ids, nulls, counts, frames_held, size = [], [], [], [], 0

        def shard() -> pa.RecordBatch:
            lengths = np.cumsum([0, *map(len, frames_held)])
            row = {
                "part": part,
                "number": number,
                "start": start,
                "n_ids": sum(counts),
                "dictionary": dictionary.name,
                "width": width,
                "doc_ids": ids,
                "without_id": nulls,
                "offsets": lengths.tolist(),
                "counts": counts,
                "data": b"".join(frames_held),
            }
            return pa.RecordBatch.from_pylist([row], _SHARD_SCHEMA)

        for batch in batches:
            keys, known, texts = (batch.column(c).to_pylist() for c in ("doc_id", "_known", "text"))
            for a, b in _slices(texts):
                for key, has_id, ids_written in zip(
                    keys[a:b], known[a:b], tokens.encode(texts[a:b]), strict=True
                ):
                    if not has_id:
                        nulls.append(len(ids))
                    ids.append(key)
                    counts.append(len(ids_written) // width)
                    frames_held.append(press.compress(ids_written))
                    size += len(frames_held[-1])
                    if size >= SHARD_BYTES:
                        yield shard()
                        start, number = start + sum(counts), number + 1
                        ids, nulls, counts, frames_held, size = [], [], [], [], 0
        if ids:
            yield shard()

    # Rows of one id, or of none, are dealt to many tasks by how their texts begin.
    first = F.col("doc_id").asc_nulls_first()
    ordered = rows.repartitionByRange(int(parts), first, F.substring("text", 1, 64))
    ordered = ordered.sortWithinPartitions(first, "text")
    with_whole_ids(ordered).mapInArrow(pack, SHARDS).write.option("compression", "none").parquet(
        f"{folder}/shards"
    )
    return folder


def _slices(texts: list[str], characters: int = 1 << 20) -> Iterator[tuple[int, int]]:
    """Ranges of texts of about ``characters`` in all, one text at least."""
    a, held = 0, 0
    for b, text in enumerate(texts, 1):
        held += len(text)
        if held >= characters or b == len(texts):
            yield a, b
            a, held = b, 0


def _dictionary(spark, folder: str) -> Dictionary:
    """The stored dictionary; its size is bounded by ``DICTIONARY_BYTES``."""
    row = spark.read.parquet(f"{folder}/dictionary").first()
    found = Dictionary(bytes(row["data"]))
    if found.name != row["dictionary"]:
        raise ValueError("the dictionary does not have the hash it is stored under")
    return found


def _frames(shard, dictionary: Dictionary) -> Iterator[np.ndarray]:
    """Id arrays of a shard's documents, each from its own frame."""
    if shard.dictionary != dictionary.name:
        raise ValueError("the shard was written with another dictionary")
    press, data = dictionary.decompressor(), memoryview(shard.data)
    kind = np.dtype("<u2" if shard.width == 2 else "<u4")
    for a, b in zip(shard.offsets[:-1], shard.offsets[1:], strict=True):
        yield np.frombuffer(press.decompress(data[a:b]), dtype=kind)


def read_tokens(
    spark, folder: str, doc_ids: list[int] | None = None, ids: bool = True
) -> DataFrame:
    """doc_id, start, n_tokens, ids_crc32 and, unless left out, the ids of every document in
    the files, or of ``doc_ids`` only, whose frames alone are decompressed."""
    dictionary = _dictionary(spark, folder)
    shards = spark.read.schema(SHARDS).parquet(f"{folder}/shards")
    # Ids before each partition: one row per partition that was written.
    sums = shards.groupBy("part").agg(F.sum("n_ids").alias("n"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    first = stage(
        sums.select("part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("before")), "token-starts"
    )
    shards = shards.join(beside(first, 16), "part")
    wanted = None if doc_ids is None else set(doc_ids)
    if wanted is not None:
        shards = shards.where(F.arrays_overlap("doc_ids", F.array(*map(F.lit, sorted(wanted)))))

    def unpack(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for shard in frame.itertuples(index=False):
                start, rows = shard.before + shard.start, []
                keys = shard.doc_ids.tolist()
                for k in shard.without_id.tolist():
                    keys[k] = None
                if wanted is None:
                    arrays = _frames(shard, dictionary)
                else:
                    arrays = _chosen(shard, dictionary, keys, wanted)
                for key, count, found in zip(keys, shard.counts, arrays, strict=True):
                    if found is not None:
                        wide = found.astype("<u4")
                        row = (key, start, len(wide), zlib.crc32(wide.tobytes()))
                        rows.append((*row, found.astype(np.int32)) if ids else row)
                    start += int(count)
                columns = ["doc_id", "start", "n_tokens", "ids_crc32"]
                out = pd.DataFrame([r[1:] for r in rows], columns=[*columns[1:], "ids"] if ids else columns[1:])
                out.insert(0, "doc_id", pd.array([r[0] for r in rows], dtype="Int64"))
                yield out

    kind = "doc_id long, start long, n_tokens long, ids_crc32 long"
    return shards.mapInPandas(unpack, kind + ", ids array<int>" if ids else kind)


def _chosen(shard, dictionary: Dictionary, keys: list, wanted: set) -> Iterator:
    """As ``_frames``, None for documents that are not wanted."""
    press, data = dictionary.decompressor(), memoryview(shard.data)
    kind = np.dtype("<u2" if shard.width == 2 else "<u4")
    for k, key in enumerate(keys):
        if key in wanted:
            a, b = shard.offsets[k], shard.offsets[k + 1]
            yield np.frombuffer(press.decompress(data[a:b]), dtype=kind)
        else:
            yield None
