"""Token counts, packing and token files against the libraries."""

import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from conftest import SF
from odd_rows import empty, engine, odd  # noqa: F401
from wardenlake.llm import catalog, packing, token_counts, token_files, units

PATH = public_tokenizers.path("byte_bpe_50k.json")
TOKENIZER = units.load(PATH)[0]
ENCODER = units.Encoder(PATH)
COUNTER = units.Counter(PATH, units.prove_whole_tokens(PATH))

MARKS = st.sampled_from([*" \n\t\r\x0b\x1c\x85\xa0\xad​　aAéß'st.,!<|>019_漢🙂ªº²", "<|endoftext|>", "  ", " '", "\n ", "x" * 70, " the", "é.", "×.", "÷", "ɏ's", "1,0", "a.b"])
TEXTS = st.lists(st.none() | st.lists(MARKS, max_size=25).map("".join) | st.text(max_size=20), max_size=5)


def ids_of(text):
    return TOKENIZER.encode(text or "", add_special_tokens=False).ids


@settings(max_examples=500, deadline=None)
@given(TEXTS)
def test_units_give_the_ids_of_the_library(texts):
    first, ids = ENCODER.encode(pa.array(texts, pa.string()))
    assert [ids[a:b].tolist() for a, b in zip(first[:-1], first[1:], strict=True)] == [ids_of(t) for t in texts]
    assert COUNTER.count(pa.array(texts, pa.string())).tolist() == [len(ids_of(t)) for t in texts]


def test_forgetting_units_changes_nothing(monkeypatch):
    monkeypatch.setattr(units, "REMEMBERED", 20)
    encoder = units.Encoder(PATH)
    for k in range(30):
        text = " ".join(f"word{i * k % 37}" for i in range(40))
        assert encoder.encode(pa.array([text]))[1].tolist() == ids_of(text)


def test_whole_tokens_are_single_tokens():
    proven = units.prove_whole_tokens(PATH)
    assert len(proven) > 40_000
    assert all(len(ids_of(t)) == 1 for t in proven[::500])


@pytest.mark.parametrize("name", ["word_bpe_49k.json", "piece_bpe_32k.model"])
def test_other_tokenizers(odd, name):
    path = public_tokenizers.path(name)
    if name.endswith(".model"):
        import sentencepiece

        count = lambda t, m=sentencepiece.SentencePieceProcessor(model_file=path): len(m.encode(t or ""))
    else:
        count = lambda t, m=units.load(path)[0]: len(m.encode(t or "", add_special_tokens=False).ids)
    found = token_counts.token_counts(odd, path)
    assert sorted(r.n_tokens for r in found.collect()) == sorted(count(r.text) for r in odd.collect())


def test_counts_of_documents(engine, odd, empty):
    rows = {r.doc_id: r for r in catalog.op2_token_counts(engine, SF).collect()}
    for r in engine.read.parquet(f"{SF}/documents.parquet").collect():
        n = len(ids_of(r.text))
        assert (rows[r.doc_id].n_bytes, rows[r.doc_id].n_tokens, rows[r.doc_id].over_limit) == (len(r.text.encode()), n, n > 1024)
    assert token_counts.token_counts(odd, PATH).count() == odd.count()
    assert token_counts.token_counts(empty, PATH).count() == 0


def check_packing(docs, rows, size):
    whole = {r.doc_id: [*ids_of(r.text), 0] for r in docs}
    sequences, parts = defaultdict(list), defaultdict(list)
    for r in rows:
        piece = whole[r.doc_id][r.start : r.start + r.length]
        assert len(piece) == r.length and zlib.crc32(np.array(piece, "<u4").tobytes()) == r.ids_crc32
        sequences[r.sequence_id].append((r.offset, r.length))
        parts[r.doc_id].append((r.piece, r.start, r.length))
    for found in sequences.values():
        at = 0
        for offset, length in sorted(found):
            assert offset == at
            at += length
        assert at <= size
    return sequences, parts, whole


def test_packing_of_documents(engine):
    docs = engine.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()
    sequences, parts, whole = check_packing(docs, catalog.op6_packing(engine, SF).collect(), 2048)
    for doc_id, found in parts.items():
        found.sort()
        assert [p for p, _, _ in found] == list(range(len(found)))
        assert sum(n for _, _, n in found) == len(whole[doc_id]) and all(n == 2048 for _, _, n in found[1:])
    assert len(sequences) <= 1.02 * sum(map(len, whole.values())) / 2048 + 1


def test_packing_of_odd_rows(odd, empty):
    rows = packing.pack(odd, PATH).collect()
    assert {r.doc_id for r in rows} == {r.doc_id for r in odd.collect()}
    assert packing.pack(empty, PATH).count() == 0
    joined = packing.sequences(packing.pack(odd, PATH, keep_ids=True)).collect()
    assert all(4 * r.n_tokens == len(r.ids) and r.n_tokens <= 2048 for r in joined)


@pytest.mark.parametrize("rule", ["norm", "dot"])
def test_every_capacity_holds(rule):
    draw = np.random.default_rng(3)
    lengths, numbers = np.unique(draw.integers(1, 100, 5000), return_counts=True)
    capacity = packing.Capacity(tokens=100, documents=4, cost=4000 if rule == "norm" else 10_000, rule=rule)
    histogram = {int(n): int(c) for n, c in zip(lengths, numbers, strict=True) if n * n <= capacity.cost}
    plan, used = packing.plan_bins(histogram, capacity)
    bins = defaultdict(list)
    for length, (ranks, firsts, offsets) in plan.items():
        for rank, stop, first, offset in zip(ranks, [*ranks[1:], histogram[length]], firsts, offsets, strict=True):
            for k in range(stop - rank):
                bins[first + k].append((offset, length))
    assert len(bins) == used and sum(map(len, bins.values())) == sum(histogram.values())
    for found in bins.values():
        found.sort()
        assert [o for o, _ in found] == [sum(n for _, n in found[:i]) for i in range(len(found))]
        assert sum(n for _, n in found) <= 100 and len(found) <= 4 and sum(n * n for _, n in found) <= capacity.cost
    with pytest.raises(ValueError, match="fits no sequence"):
        packing.plan_bins({101: 1}, capacity)


@pytest.mark.parametrize("segment_keys", [token_files.SEGMENT_KEYS, 16])
def test_token_files_round_trip(engine, monkeypatch, segment_keys):
    monkeypatch.setattr(token_files, "SEGMENT_KEYS", segment_keys)
    rows = {r.doc_id: r for r in catalog.op9_token_files(engine, SF).collect()}
    at = 0
    for r in engine.read.parquet(f"{SF}/documents.parquet").orderBy("doc_id").collect():
        ids = np.array([*ids_of(r.text), 0], "<u4")
        assert (rows[r.doc_id].start, rows[r.doc_id].n_tokens, rows[r.doc_id].ids_crc32) == (at, len(ids), zlib.crc32(ids.tobytes()))
        at += len(ids)


def test_token_files_keys(engine, odd, empty):
    files = token_files.write_ids(odd, PATH)
    asked = engine.createDataFrame([(1,), (7,), (99,), (None,)], "doc_id long")
    found = {r.doc_id: bytes(r.ids) for r in token_files.read_ids(files, token_files.look_up(files, asked)).collect()}
    assert {k: np.frombuffer(v, "<u4").tolist()[:-1] for k, v in found.items()} == {r.doc_id: ids_of(r.text) for r in odd.where("doc_id in (1, 7)").collect()}
    assert files.documents.count() == odd.count()
    none = token_files.write_ids(empty, PATH)
    assert token_files.look_up(none, asked).count() == 0


@pytest.mark.parametrize("size", [0, 1, 2, 1000, 50_000])
def test_perfect_hash_is_minimal(size):
    keys = np.random.default_rng(size).permutation(np.arange(size, dtype=np.int64) * 7919)
    made = token_files.PerfectHash.build(keys)
    read, used = token_files.PerfectHash.from_bytes(made.to_bytes())
    assert used == len(made.to_bytes()) and sorted(read.places(keys).tolist()) == list(range(size))
