"""Tokenising documents and packing them into sequences of fixed capacity by best-two-fit.

``token_pieces`` turns documents into pieces of at most ``capacity`` tokens, ``packed`` gives every
piece a place in a sequence, ``sequences`` writes the sequences out. Pieces are dealt at random into
groups of bounded size, which are packed on their own: a group leaves at most its last sequences
partly empty, one in some thousands.

Defined results: a null text counts as empty, and an empty document is its end token alone; null,
equal and repeated ids are carried along, since only the row counts; documents of any length are cut
into whole pieces; an empty table gives no pieces.
"""

from __future__ import annotations

import os
import struct
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cashloom.llm.storage import stored

CAPACITY = 4096
END_ID = 1
#: Pieces packed together in one task.
GROUP_PIECES = 16_384
#: Words of a generation whose ids a worker remembers; two generations take some 70 MB.
REMEMBERED_WORDS = 200_000
#: Bytes of text tokenised at once, and handed on together.
PORTION_BYTES = 1 << 20


def tokenizer_file(name: str = "word_bpe_49k.json") -> str:
    """The place of an installed public tokenizer."""
    import public_tokenizers

    return public_tokenizers.path(name)


def _byte_letters() -> dict[int, int]:
    """The letters that byte-level models write bytes as: visible ones as they are, others from 256 on."""
    visible = {*range(33, 127), *range(161, 173), *range(174, 256)}
    hidden = [b for b in range(256) if b not in visible]
    return {b: b for b in visible} | {b: 256 + n for n, b in enumerate(hidden)}


BYTE_LETTERS = _byte_letters()
#: Marks that end words; not the apostrophe, which tokenizers may join with letters.
MARKS = b'!"#$%&()*+,-./:;=?@[\\]^_`{|}~'
#: If these words come out alike with and without the steps before the model, all such words do.
PLAIN_PROBES = ("a", "the", "thereining", "über", "çané", "ñoñez", "straße", "łódź")


def _is_plain(word: str) -> bool:
    """Lower-case letters of the Latin blocks only: no step before the model changes or splits them."""
    return word.isalpha() and word == word.lower() and max(word) < "\u0250"


class WordIds(dict):
    """Ids of white-space separated words, as little-endian 32-bit integers, filled as words come up.

    Made for tokenizers that drop white space, ignore ASCII case, and separate letters from
    punctuation: there the ids of a text are those of its words, one after another. A word in capitals
    or with marks at its end has no entry of its own, which leaves room for others. When the table is
    full it becomes the older generation, from which words still in use come back.
    """

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        super().__init__()
        self.tokenizer = Tokenizer.from_file(path)
        self.model = self.tokenizer.model
        self.older: dict[bytes, bytes] = {}
        self.plain = all(self._of_letters(w) == self._encoded(w) for w in map(str.encode, PLAIN_PROBES))

    def __missing__(self, word: bytes) -> bytes:
        if len(self) >= REMEMBERED_WORDS:
            self.older = dict(self)
            self.clear()
        if (ids := self.older.get(word)) is not None:
            self[word] = ids
            return ids
        low = word.lower()
        if not word:  # between white space and the end of a text
            ids = b""
        elif b"<|" in word:  # perhaps a special token, whose case counts
            ids = self._encoded(word)
        elif low != word:
            return self[low]
        elif (stem := word.rstrip(MARKS)) != word and stem[-1:].isalpha():
            return self[stem] + self[word[len(stem) :]]
        elif self.plain and _is_plain(word.decode()):
            ids = self._of_letters(word)
        else:
            ids = self._encoded(word)
        self[word] = ids
        return ids

    def _of_letters(self, word: bytes) -> bytes:
        """By the model alone: lower-case Latin letters are one token text as they are, byte by byte."""
        ids = [t.id for t in self.model.tokenize(word.decode("latin-1").translate(BYTE_LETTERS))]
        return struct.pack(f"<{len(ids)}I", *ids)

    def _encoded(self, word: bytes) -> bytes:
        ids = self.tokenizer.encode(word.decode(), add_special_tokens=False).ids
        return struct.pack(f"<{len(ids)}I", *ids)

    def of(self, text: bytes) -> bytes:
        """The ids of a whole text; bytes.split() knows the blank and tab to carriage return only."""
        return b"".join(map(self.__getitem__, text.split()))

    def of_texts(self, texts: pa.LargeStringArray) -> Iterator[bytes]:
        """The ids of each text. Their different words are looked up once, and put in place by Arrow."""
        words = pc.ascii_split_whitespace(texts)  # the same white space as above
        coded = words.flatten().dictionary_encode()
        different = coded.dictionary.cast(pa.large_binary()).to_pylist()
        ids = pa.array(map(self.__getitem__, different), pa.large_binary())
        placed = ids.take(coded.indices)
        _, offsets, data = placed.buffers()
        ends = np.frombuffer(offsets, np.int64, len(placed) + 1, placed.offset * 8)
        edges = ends[np.asarray(words.offsets) - words.offsets[0].as_py()].tolist()
        values = memoryview(data) if data is not None else memoryview(b"")
        for start, stop in zip(edges, edges[1:]):
            yield bytes(values[start:stop])


_TABLES: dict[str, WordIds] = {}


def word_ids(path: str) -> WordIds:
    """The word table of this worker process for a tokenizer file."""
    if path not in _TABLES:
        _TABLES[path] = WordIds(path)
    return _TABLES[path]


def _portions(texts: pa.LargeStringArray) -> Iterator[tuple[int, pa.LargeStringArray]]:
    """The texts in slices of about ``PORTION_BYTES``, one at least, with the place of the first of each."""
    lengths = pc.binary_length(texts).to_numpy(zero_copy_only=False)
    first, held = 0, 0
    for row, length in enumerate(lengths.tolist()):
        held += length
        if held >= PORTION_BYTES:
            yield first, texts.slice(first, row + 1 - first)
            first, held = row + 1, 0
    if first < len(texts):
        yield first, texts.slice(first)


def token_pieces(
    docs: DataFrame,
    tokenizer_path: str,
    capacity: int = CAPACITY,
    end_id: int = END_ID,
    doc_id: str = "doc_id",
    text: str = "text",
) -> DataFrame:
    """Pieces of documents: doc_id, piece, start, length, ids (binary, 4 bytes a token)."""
    kind = docs.schema[doc_id].dataType
    source = docs.select(F.col(doc_id).alias("doc_id"), F.encode(F.coalesce(text, F.lit("")), "UTF-8").alias("text"))
    schema = f"doc_id {kind.simpleString()}, piece int, start long, length long, ids binary"

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table, end, step = word_ids(tokenizer_path), struct.pack("<I", end_id), 4 * capacity
        for batch in batches:
            pa.default_memory_pool().release_unused()  # or each worker keeps what its largest portion took
            for first, texts in _portions(batch.column(1).cast(pa.large_string())):
                owners: list[int] = []
                at: list[int] = []
                parts: list[bytes] = []
                for row, ids in enumerate(table.of_texts(texts), start=first):
                    ids += end
                    for piece in range(-(-len(ids) // step)):
                        owners.append(row)
                        at.append(piece)
                        parts.append(ids[piece * step : (piece + 1) * step])
                starts = np.array(at, dtype=np.int64) * capacity
                lengths = np.fromiter(map(len, parts), dtype=np.int64, count=len(parts)) // 4
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).take(pa.array(owners, pa.int64())), pa.array(at, pa.int32()), pa.array(starts), pa.array(lengths), pa.array(parts, pa.binary())],
                    ["doc_id", "piece", "start", "length", "ids"],
                )

    return source.mapInArrow(cut, schema)


def best_two_fit(lengths: list[int], capacity: int) -> tuple[list[int], list[int]]:
    """Bin and offset of each length.

    A bin is filled with the longest document that still fits, again and again. If a gap is left, its
    smallest document makes way for the two waiting ones that fill its place and the gap best, if two
    together fill more than it did. The waiting lengths are the bits of one number, so that the
    longest that fits, and a pair of a given sum, are found in a few operations on it.
    """
    waiting: dict[int, list[int]] = {}
    for index, length in enumerate(lengths):
        if not 0 < length <= capacity:
            raise ValueError(f"a piece of {length} tokens can't be packed into {capacity}")
        waiting.setdefault(length, []).append(index)
    there = mirrored = 0
    for length in waiting:
        there |= 1 << length
        mirrored |= 1 << (capacity - length)
    bins, offsets = [0] * len(lengths), [0] * len(lengths)
    number = 0

    def take(length: int) -> int:
        nonlocal there, mirrored
        index = waiting[length].pop()
        if not waiting[length]:
            there ^= 1 << length
            mirrored ^= 1 << (capacity - length)
        return index

    def give_back(index: int) -> None:
        nonlocal there, mirrored
        length = lengths[index]
        waiting[length].append(index)
        there |= 1 << length
        mirrored |= 1 << (capacity - length)

    def best_pair(most: int, least: int) -> tuple[int, int] | None:
        """Two waiting lengths with the largest sum of ``least`` + 1 to ``most``."""
        smallest = (there & -there).bit_length() - 1
        for total in range(most, max(least, 2 * smallest - 1), -1):
            pairs = there & (mirrored >> (capacity - total)) & ((1 << total) - 1)
            while pairs:
                long = pairs.bit_length() - 1
                if 2 * long != total or len(waiting[long]) > 1:
                    return long, total - long
                pairs ^= 1 << long
        return None

    while there:
        held, gap = [], capacity
        while fitting := there & ((2 << gap) - 1):
            length = fitting.bit_length() - 1
            held.append(take(length))
            gap -= length
        if gap and there:
            smallest = min(held, key=lengths.__getitem__)
            if pair := best_pair(gap + lengths[smallest], lengths[smallest]):
                held.remove(smallest)
                held += [take(pair[0]), take(pair[1])]
                give_back(smallest)
        offset = 0
        for index in held:
            bins[index], offsets[index] = number, offset
            offset += lengths[index]
        number += 1
    return bins, offsets


def packed(pieces: DataFrame, capacity: int = CAPACITY, group_pieces: int = GROUP_PIECES) -> DataFrame:
    """``pieces`` (with a ``length`` of 1 to ``capacity``) with ``sequence_id`` and ``offset``.

    The pieces are stored first, so that a task that runs again deals them out the same way. Pieces
    that fill a sequence don't take part in the packing. Columns of these names, and ones named
    packing_row and packing_group, are replaced.
    """
    pieces = pieces.drop("sequence_id", "offset", "packing_row", "packing_group")
    rows = stored(pieces.withColumn("packing_row", F.monotonically_increasing_id()), "pieces")
    whole = rows.where(F.col("length") == capacity)
    rest = rows.where(F.col("length") != capacity)
    groups = max(1, round(rest.count() / group_pieces))
    dealt = rest.withColumn("packing_group", F.pmod(F.xxhash64("packing_row"), F.lit(groups)))
    kept = [f"`{f.name}` {f.dataType.simpleString()}" for f in pieces.schema]

    def place(group: pa.Table) -> pa.Table:
        bins, offsets = best_two_fit(group.column("length").to_pylist(), capacity)
        base = group.column("packing_group")[0].as_py() << 32
        placed = group.drop_columns(["packing_row", "packing_group"])
        placed = placed.append_column("sequence_id", pa.array(np.array(bins, dtype=np.int64) + base))
        return placed.append_column("offset", pa.array(offsets, pa.int64()))

    placed = dealt.groupBy("packing_group").applyInArrow(place, ", ".join([*kept, "sequence_id long", "offset long"]))
    alone = whole.withColumn("sequence_id", -F.col("packing_row") - 1).withColumn("offset", F.lit(0).cast("long"))
    return placed.unionByName(alone.drop("packing_row"))


def sequences(placed: DataFrame) -> DataFrame:
    """The sequences themselves, from placed pieces with ``ids``: sequence_id, ids (binary)."""
    parts = placed.groupBy("sequence_id").agg(F.array_sort(F.collect_list(F.struct("offset", "ids"))).alias("parts"))
    ids = F.aggregate("parts", F.lit(b""), lambda done, part: F.concat(done, part["ids"]))
    return parts.select("sequence_id", ids.alias("ids"))
