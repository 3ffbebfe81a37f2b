import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from streamwatch.llm import packing, token_store, tokens

from .conftest import ODD

BYTE, WORD = (public_tokenizers.path(name) for name in ("byte_bpe_50k.json", "word_bpe_49k.json"))

TRICKY = [
    "", "a  b", "  two  spaces\n\n\nx ", "it's don't 'sfoo ,'s x'll, 12ab34 é a   é 　z",
    "İstanbul ΣΑΣ ß", "日本語 テスト。  x", "\t\ta b\r\nc", "a≮b 1̸ ,́x",
    "ﬁ ½ ² x²y", "\x1c a\x1cb\x85c", "<|endoftext|> x", "KK Å", "अम् x̀ y",
]


SPECIAL = [
    "first part <|endoftext|> second", "<|endoftext|>", "<|endoftext|><|endoftext|>x", "a<|startoftext|>b<|ENDOFTEXT|> <|endoftext|",
    "|><|endoftext|>́ <|<|endoftext|>|> it<|endoftext|>'s\n<|startoftext|>\n\n 12<|endoftext|>34", "<|endof", "text|> <|endoftext|>",
]


@pytest.fixture(scope="module")
def encoders():
    return [tokens.TextEncoder(path) for path in (BYTE, WORD)]


UNTOUCHED = {}


def _whole(encoder, text):
    """By a tokenizer as the file has it."""
    path = BYTE if encoder.normalizer is None else WORD
    if path not in UNTOUCHED:
        UNTOUCHED[path] = Tokenizer.from_file(path)
    return UNTOUCHED[path].encode(text or "", add_special_tokens=False).ids


def test_units_give_the_ids_of_whole_texts(encoders):
    texts = TRICKY + SPECIAL + [row[1] for row in ODD if len(row[1] or "") < 1000]
    for encoder in encoders:
        for text, ids in zip(texts, encoder.encode(pa.array(texts))):
            assert ids.tolist() == _whole(encoder, text), text


def test_long_texts_in_blocks(encoders, monkeypatch):
    text = " ".join(TRICKY + SPECIAL) * 3
    for size in (1, 7, 40, 300):
        monkeypatch.setattr(tokens, "BLOCK_BYTES", size)
        for encoder in encoders:
            (ids,) = encoder.encode(pa.array([text]))
            assert ids.tolist() == _whole(encoder, text)


@settings(max_examples=200, deadline=None)
@given(st.text(alphabet=st.sampled_from(list("ab Z9'.,!-\n\t") + ["é", "́", " ", "　", "中", " ", "s", "t"]), max_size=40))
def test_units_of_any_text(text):
    for path in (BYTE, WORD):
        encoder = tokens.encoder(path)
        (ids,) = encoder.encode(pa.array([text]))
        assert ids.tolist() == _whole(encoder, text)


def test_store_round_trip_in_order(spark, odd, tmp_path):
    path = str(tmp_path / "store")
    token_store.write_tokens(odd, path, BYTE, segment_bytes=64, width=2, partitions=3)
    rows = sorted(token_store.read_tokens(spark, path).collect(), key=lambda row: row.start)
    assert len(rows) == len(ODD) and [row.doc_id for row in rows] == sorted((row[0] for row in ODD), key=lambda x: (x is not None, x))
    texts = {row[0]: row[1] for row in ODD}
    at = 0
    for row in rows:
        ids = np.frombuffer(bytes(row.ids), "<u4").tolist()
        assert ids == [*_whole(tokens.encoder(BYTE), texts[row.doc_id]), 2] and row.n_tokens == len(ids)
        assert row.start == at
        at += len(ids)
    assert [row.doc_id for row in token_store.lookup_tokens(spark, path, [6, 99]).collect()] == [6]


def test_store_with_a_trained_dictionary(spark, documents, tmp_path):
    texts = [(i, f"the {i} house and the {i * 7} tree stand by the river " * 3) for i in range(300)]
    path = str(tmp_path / "store")
    token_store.write_tokens(documents(texts), path, BYTE)
    assert len(bytes(spark.read.parquet(path + "/dictionary.parquet").first().bytes)) > 0
    assert token_store.read_tokens(spark, path).count() == 300


def test_store_of_no_documents(spark, no_docs, tmp_path):
    path = str(tmp_path / "store")
    token_store.write_tokens(no_docs, path, BYTE)
    assert token_store.read_tokens(spark, path).count() == 0


def _check_packing(rows, capacity):
    sequences = {}
    for row in rows:
        sequences.setdefault(row.sequence_id, []).append((row.offset, row.length))
    for parts in sequences.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= capacity
    return len(sequences)


def test_packing_of_odd_documents(odd):
    rows = packing.pack_documents(odd, WORD, capacity=64).collect()
    texts = {row[0]: row[1] for row in ODD}
    own = {}
    for row in rows:
        ids = [*_whole(tokens.encoder(WORD), texts[row.doc_id]), 0]
        piece = ids[row.start : row.start + 64]
        assert row.start == 64 * row.piece and row.length == len(piece)
        assert row.ids_crc32 == zlib.crc32(np.array(piece, "<u4").tobytes())
        own[row.doc_id] = own.get(row.doc_id, 0) + row.length
    assert own[5] == 2 * own[1]
    assert _check_packing(rows, 64) == -(-sum(own.values()) // 64)


class _Task:
    """In place of a table: what its tasks would run."""

    columns, schema = ["doc_id", "text"], None

    def select(self, *columns):
        return self

    def mapInArrow(self, work, schema):
        return work


def test_pieces_leave_a_worker_in_small_batches(spark, monkeypatch):
    texts = [row[1] for row in ODD] + TRICKY * 5
    batch = pa.RecordBatch.from_arrays([pa.array(range(len(texts)), pa.int64()), pa.array(texts, pa.string())], ["doc_id", "text"])

    def pieces():
        return list(packing.token_pieces(_Task(), WORD, capacity=16)(iter([batch, batch.slice(0, 0), batch])))

    whole = pa.Table.from_batches(pieces())
    monkeypatch.setattr(packing, "BATCH_BYTES", 256, raising=False)
    small = pieces()
    assert max(sum(map(len, part.column("ids").to_pylist())) for part in small) < 256 + 4 * 16
    assert pa.Table.from_batches(small).equals(whole)


def test_packing_of_no_documents(no_docs):
    assert packing.pack_documents(no_docs, WORD).count() == 0


def _least_sequences(lengths, capacity):
    """By trying all ways."""
    best = [len(lengths)]
    lengths = sorted(lengths, reverse=True)

    def place(k, rooms):
        if len(rooms) >= best[0]:
            return
        if k == len(lengths):
            best[0] = len(rooms)
            return
        for room in set(rooms):
            if room >= lengths[k]:
                rest = list(rooms)
                rest.remove(room)
                place(k + 1, [*rest, room - lengths[k]])
        place(k + 1, [*rooms, capacity - lengths[k]])

    place(0, [])
    return best[0]


@settings(max_examples=80, deadline=None)
@given(st.lists(st.integers(1, 12), min_size=1, max_size=9))
def test_dominance_keeps_an_optimal_packing(lengths):
    counts = {x: lengths.count(x) for x in lengths}
    fixed, left = packing.reduce_by_dominance(counts, 12)
    rest = [length for length, n in left.items() for _ in range(n)]
    assert sum(n for _, n in fixed) + (_least_sequences(rest, 12) if rest else 0) == _least_sequences(lengths, 12)


@settings(max_examples=80, deadline=None)
@given(st.dictionaries(st.integers(1, 50), st.integers(1, 30), min_size=1, max_size=30))
def test_plan_places_every_piece_once(counts):
    places, sequences = set(), {}
    for length, first, last, each, sequence, place in packing.packing_plan(counts, 50):
        for number in range(first, last):
            assert (length, number) not in places
            places.add((length, number))
            own = sequence + (number - first) // each
            sequences.setdefault(own, []).append((place + (number - first) % each * length, length))
    assert len(places) == sum(counts.values())
    for parts in sequences.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= 50
