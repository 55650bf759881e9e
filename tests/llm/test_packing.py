from __future__ import annotations

import random
import struct
import zlib
from collections import defaultdict

import public_tokenizers
import pyarrow as pa
from tokenizers import Tokenizer

from cashloom.llm import packing
from cashloom.llm.packing import WordIds, best_two_fit, packed, sequences, token_pieces

PATH = public_tokenizers.path("word_bpe_49k.json")

ODD = ["", None, " \n", "Don't, STOP. <|endoftext|> x<|EndOfText|>y <|startoftext|>,", "É. é, é. ß. İ. Σας.", "a,.b ., 's, 12,3.", "\x1c a\x1db c  . x́, q.́", "ñ" * 9000, "The end. " * 3000]


def ids_of(text):
    return Tokenizer.from_file(PATH).encode(text or "", add_special_tokens=False).ids


def test_word_ids_are_those_of_the_whole_text(spark, middle):
    table = WordIds(PATH)
    texts = [r.text for r in spark.read.parquet(f"{middle}/documents.parquet").collect()] + ODD
    whole = Tokenizer.from_file(PATH)
    for text in texts:
        got = table.of((text or "").encode())
        assert list(struct.unpack(f"<{len(got) // 4}I", got)) == whole.encode(text or "", add_special_tokens=False).ids


def check_places(rows, capacity):
    by = defaultdict(list)
    for r in rows:
        by[r.sequence_id].append((r.offset, r.length))
    for places in by.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= capacity
    return len(by)


def test_pieces_and_sequences_round_trip(documents):
    rows = list(enumerate(ODD)) + [(3, ODD[3]), (None, "a b")]
    pieces = token_pieces(documents(rows), PATH, capacity=64)
    placed = packed(pieces, capacity=64, group_pieces=50)
    got = placed.collect()
    check_places(got, 64)
    docs = defaultdict(list)
    for r in got:
        assert r.start == r.piece * 64 and r.length * 4 == len(r.ids)
        docs[r.doc_id].append((r.piece, bytes(r.ids)))
    for doc_id, text in rows:
        want = ids_of(text) + [1]
        packed_ids = struct.pack(f"<{len(want)}I", *want)
        parts = sorted(docs[doc_id])
        if doc_id == 3:
            parts = parts[::2]
        assert b"".join(p for _, p in parts) == packed_ids
    flat = {r.sequence_id: bytes(r.ids) for r in sequences(placed).collect()}
    for r in got:
        assert flat[r.sequence_id][4 * r.offset : 4 * (r.offset + r.length)] == bytes(r.ids)


def test_best_two_fit_fills_sequences():
    rng = random.Random(3)
    lengths = [min(4096, int(rng.lognormvariate(6, 1.2)) + 1) for _ in range(5000)]
    bins, offsets = best_two_fit(lengths, 4096)
    assert max(bins) + 1 <= -(-sum(lengths) // 4096) + 2


def test_smallest_makes_way_for_two():
    # 60 + 30 leaves 10; 20 + 20 fill the 40 that 30 and the gap give
    bins, _ = best_two_fit([60, 30, 20, 20], 100)
    assert bins[0] == bins[2] == bins[3] != bins[1]
    assert best_two_fit([], 10) == ([], [])
    # one waiting piece of a length can't be both of a pair
    bins, _ = best_two_fit([60, 35, 20], 100)
    assert bins == [0, 0, 1]


def test_empty_table(documents):
    assert packed(token_pieces(documents([]), PATH)).count() == 0


def test_query_reads_all_documents(spark, middle):
    from cashloom.llm.queries import op2_best_fit_packing

    rows = op2_best_fit_packing(spark, middle).collect()
    used = check_places(rows, 4096)
    total = sum(r.length for r in rows)
    assert used <= 1.01 * total / 4096 + 2
    assert len({r.doc_id for r in rows}) == spark.read.parquet(f"{middle}/documents.parquet").count()


def test_query_against_the_tokenizer(spark, small):
    """Every piece of every document: where it starts, how long it is and the checksum of its ids."""
    from cashloom.llm.queries import op2_best_fit_packing

    got = sorted((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in op2_best_fit_packing(spark, small).collect())
    want = []
    for r in spark.read.parquet(f"{small}/documents.parquet").select("doc_id", "text").collect():
        ids = ids_of(r.text) + [1]
        for piece, start in enumerate(range(0, len(ids), 4096)):
            part = ids[start : start + 4096]
            want.append((r.doc_id, piece, start, len(part), zlib.crc32(struct.pack(f"<{len(part)}I", *part))))
    assert got == sorted(want)


def test_texts_together_are_like_texts_alone():
    table, alone = WordIds(PATH), WordIds(PATH)
    texts = [t or "" for t in ODD] + ["", "  a ", "\x0b", "A.", "a\x85b \u2003c"]
    array = pa.array(texts, pa.large_string())
    assert list(table.of_texts(array)) == [alone.of(t.encode()) for t in texts]
    assert list(table.of_texts(array.slice(3, 4))) == [alone.of(t.encode()) for t in texts[3:7]]
    assert list(table.of_texts(array.slice(0, 0))) == []


def test_small_portions_and_memory(documents, monkeypatch):
    rows = [(k, f"Word{k % 7} and, more. " * (k % 5)) for k in range(40)]
    want = sorted((r.doc_id, r.piece, bytes(r.ids)) for r in token_pieces(documents(rows), PATH, capacity=16).collect())
    array, table = pa.array([t for _, t in rows], pa.large_string()), WordIds(PATH)
    monkeypatch.setattr(packing, "REMEMBERED_WORDS", 3)
    monkeypatch.setattr(packing, "PORTION_BYTES", 50)
    ids = [x for first, part in packing._portions(array) for x in table.of_texts(part)]
    assert ids == [WordIds(PATH).of(t.encode()) for _, t in rows]
    assert [first for first, _ in packing._portions(array)][:3] == sorted({first for first, _ in packing._portions(array)})[:3]
    assert len(want) >= 40


def test_clashing_names(documents):
    docs = documents([(1, "a b c"), (2, None)]).selectExpr("*", "1 AS packing_row", "2 AS packing_group", "3 AS sequence_id", "4 AS length", "5 AS ids")
    placed = packed(token_pieces(docs, PATH, capacity=64).selectExpr("*", "1 AS packing_row", "2 AS packing_group", "3 AS sequence_id"), capacity=64)
    assert sorted((r.doc_id, r.length) for r in placed.collect()) == [(1, 4), (2, 1)]
    assert check_places(placed.collect(), 64) == 1


def test_marks_and_capitals_take_no_entry_and_no_whole_encoding():
    encoded = []

    class Seen(packing.WordIds):
        def _encoded(self, word):
            encoded.append(word)
            return super()._encoded(word)

    text = "thereining$$$ Thereining,*** THEREINING. it's, x'sab!! stra\u00dfe%% a<|endoftext|> -- 12.5% e\u0301."
    table = Seen(packing.tokenizer_file())
    encoded.clear()
    whole = table.tokenizer.encode(text, add_special_tokens=False).ids
    assert table.of(text.encode()) == struct.pack(f"<{len(whole)}I", *whole)
    assert not [w for w in encoded if b"reining" in w]
    assert {b"thereining", b"$$$", b",***"} <= table.keys() and not {b"thereining$$$", b"THEREINING."} & table.keys()
