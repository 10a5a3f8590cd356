"""Rows and columns that no operator may lose: repeated and missing ids, columns with clashing names, families of near copies."""

import random
import zlib

import corpus_pipeline
import numpy as np
import public_tokenizers
from odd_rows import WORDS, empty, engine, odd  # noqa: F401
from test_duplicates import groups
from wardenlake.llm import line_dedup, near_dedup, substring_dedup, token_files

TOKENIZER = public_tokenizers.path("byte_bpe_50k.json")


def long_text(seed, words=60):
    draw = random.Random(seed)
    return " ".join(draw.choice(WORDS) + str(draw.randrange(50)) for _ in range(words))


def test_each_text_of_a_repeated_id_is_decided(engine):
    copied, other, third = long_text(1), long_text(2), long_text(3)
    rows = [(1, copied), (5, copied), (5, other), (5, other), (6, third), (6, third), (7, None), (7, ""), (7, ""), (None, copied), (None, copied)]
    left = near_dedup.drop_near_duplicates(engine.createDataFrame(rows, "doc_id long, text string")).collect()
    kept = [(1, copied), (5, other), (6, third), (7, None), (7, ""), (7, ""), (None, copied), (None, copied)]
    assert sorted(map(str, map(tuple, left))) == sorted(map(str, kept))


def test_every_written_row_is_read_back(engine):
    rows = [(3, "three"), (1, "one"), (5, "b longer text"), (5, "a"), (None, "no id"), (None, "no id either"), (9, None)]
    docs = engine.createDataFrame(rows, "doc_id long, text string")
    files = token_files.write_ids(docs, TOKENIZER)
    found = token_files.read_ids(files, token_files.places(files), digest=True).collect()
    from tokenizers import Tokenizer

    encode = lambda t: [*Tokenizer.from_file(TOKENIZER).encode(t or "", add_special_tokens=False).ids, 0]
    wanted = [(d, len(encode(t)), zlib.crc32(np.array(encode(t), "<u4").tobytes())) for d, t in rows]
    assert sorted(map(str, ((r.doc_id, r.n_tokens, r.ids_crc32) for r in found))) == sorted(map(str, wanted))
    ordered = sorted(found, key=lambda r: r.start)
    assert [r.start for r in ordered] == [0, *np.cumsum([r.n_tokens for r in ordered])[:-1].tolist()]


def test_stages_keep_columns_of_any_name(engine):
    names = ["_id", "declared", "posterior", "_gone", "row", "id", "gone", "text_key", "component", "spans", "accepted"]
    rows = [(k, long_text(k), "en", "s", 60, *[f"{n}{k}" for n in names]) for k in range(12)]
    docs = engine.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long, " + ", ".join(f"`{n}` string" for n in names))
    for name, stage in corpus_pipeline.STAGES[:-1]:
        left = stage(engine, docs, "/root/testdata/sf0.001")
        assert left.columns == docs.columns, name
        for row in left.collect():
            assert all(row[n] == f"{n}{row.doc_id}" for n in names), name
    assert substring_dedup.drop_repeated(docs).columns == docs.columns
    assert line_dedup.drop_recurring_lines(docs).count() == 12


def test_families_of_near_copies_equal_brute_force(engine):
    draw = random.Random(4)
    base, rows = [f"b{i}" for i in range(60)], []
    for number in range(250):  # similarities on both sides of 0.8, most of them below
        words = list(base)
        for _ in range(draw.randint(1, 9)):
            at, turn = draw.randrange(len(words)), draw.random()
            if turn < 0.4:
                words[at] = f"n{draw.randrange(30)}"
            elif turn < 0.7:
                del words[at]
            else:
                words.insert(at, f"n{draw.randrange(3)}")
        rows.append((number, " ".join(words)))
    docs = engine.createDataFrame(rows, "doc_id long, text string")
    found = near_dedup.near_duplicates(docs, 5, 80).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in found} == groups(rows, 5)
