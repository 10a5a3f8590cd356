"""Near duplicates, repeated passages and recurring lines against brute force."""

import random
import re

import corpus_pipeline
from odd_rows import empty, engine, odd  # noqa: F401
from wardenlake.llm import line_dedup, near_dedup, shingles, substring_dedup
from wardenlake.llm.components import components

SPLIT = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = {c: c + 32 for c in range(65, 91)}


def sets(rows, width):
    out = []
    for _, text in rows:
        words = SPLIT.findall((text or "").translate(LOWER))
        out.append(frozenset(tuple(words[k : k + width]) for k in range(max(1, len(words) - width + 1))) if words else frozenset())
    return out


def groups(rows, width):
    """Smallest id reachable of every row, by comparing all pairs."""
    found, parent = sets(rows, width), list(range(len(rows)))

    def top(k):
        while parent[k] != k:
            k = parent[k]
        return k

    for a in range(len(rows)):
        for b in range(a):
            both = len(found[a] & found[b])
            if both and 100 * both >= 80 * (len(found[a]) + len(found[b]) - both):
                parent[top(a)] = top(b)
    least = {}
    for k, (number, _) in enumerate(rows):
        least[top(k)] = min(least.get(top(k), number), number)
    return {number: (len(found[k]), least[top(k)]) for k, (number, _) in enumerate(rows)}


def corpus(seed, count=400):
    """Families of copies with few to many changed words, so that similarities lie on both sides of 0.8."""
    draw, vocabulary = random.Random(seed), [f"w{i}" for i in range(400)]
    rows = []
    for number in range(count):
        if not rows or draw.random() < 0.2:
            words = [draw.choice(vocabulary) for _ in range(draw.randint(1, 120))]
        else:
            words = draw.choice(rows[-60:])[1].split(" ")
            for _ in range(draw.randint(0, 9)):
                words[draw.randrange(len(words))] = draw.choice(vocabulary)
        rows.append((number, " ".join(words)))
    return rows


def test_near_duplicates_equal_brute_force(engine):
    for width, seed in ((2, 1), (5, 2)):
        rows = corpus(seed)
        found = near_dedup.near_duplicates(engine.createDataFrame(rows, "doc_id long, text string"), width).collect()
        assert {r.doc_id: (r.n_shingles, r.component_id) for r in found} == groups(rows, width)
        assert all(r.kept == (r.doc_id == r.component_id) for r in found)


def test_near_duplicates_of_odd_rows(odd, empty):
    found = {r.doc_id: r for r in near_dedup.near_duplicates(odd).collect()}
    assert found[2].component_id == 1 and found[3].component_id == 3 and found[4].component_id == 4 and found[5].n_shingles == 0
    assert found[None].kept and found[None].component_id is None
    left = near_dedup.drop_near_duplicates(odd)
    assert left.columns == odd.columns
    assert sorted(r.doc_id or 0 for r in left.collect()) == [0, 1, 3, 4, 5, 6, 7] + [8] * (found[8].component_id == 8)
    assert near_dedup.near_duplicates(empty).count() == 0 and near_dedup.drop_near_duplicates(empty).count() == 0


def test_bands_rarely_miss():
    assert near_dedup.MIN_MAX.permutations * 2 == near_dedup.MIN_MAX.bands * near_dedup.MIN_MAX.rows
    assert near_dedup.MIN_MAX.miss(0.8) < 1e-6 and substring_dedup.BANDS.miss(0.8) < 1e-3


def test_components_of_chains_and_stars(engine):
    links = [(k, k + 1) for k in range(1, 40)] + [(100, k) for k in range(101, 160)] + [(7, 7), (None, 3)]
    found = {r.id: r.component for r in components(engine.createDataFrame(links, "a long, b long")).collect()}
    assert {found[k] for k in range(1, 41)} == {1} and {found[k] for k in range(100, 160)} == {100} and len(found) == 100
    assert components(engine.createDataFrame([], "a long, b long")).count() == 0


def sentence(draw):
    return " ".join(f"s{draw.randrange(5000)}" for _ in range(draw.randint(8, 14))) + "."


def test_pasted_passages_are_found(engine):
    draw = random.Random(9)
    passage = " ".join(sentence(draw) for _ in range(6))
    rows = []
    for number in range(60):
        lines = [" ".join(sentence(draw) for _ in range(5)) for _ in range(3)]
        if number % 10 == 3:
            lines[1] = lines[1][: lines[1].index(".") + 1] + f" p{number} " + passage + f" b{number} " + lines[1]
        rows.append((number, "\n".join(lines)))
    docs = engine.createDataFrame(rows, "doc_id long, text string")
    runs = substring_dedup.repeated_paragraphs(docs).collect()
    assert {r.doc_id for r in runs} == {13, 23, 33, 43, 53} and {r.keeper_doc_id for r in runs} == {3}
    words = passage.split(" ")
    for r in runs:
        held = dict(rows)[r.doc_id].split()[r.start : r.start + r.words]
        assert " ".join(held) in passage and r.words >= len(words) - 28
    cut = {r.doc_id: r.text for r in substring_dedup.drop_repeated(docs).collect()}
    assert cut[3] == dict(rows)[3] and words[30] in cut[3] and words[30] not in cut[13]
    assert all(cut[k] == t for k, t in rows if k % 10 != 3)


def test_passages_between_sentence_ends_are_found(engine):
    draw = random.Random(21)

    def words(count):
        return [f"s{draw.randrange(10**6)}" for _ in range(count)]

    stops = words(51)
    stops[17] += "."
    stops[32] += "."
    for passage in (stops, words(51), words(50)):
        rows = []
        for number in range(40):
            text = words(40)
            if number % 10 == 3:
                text = [*words(number), *words(5), *passage, *words(5), *words(60 - number)]
            rows.append((number, " ".join(text)))
        runs = substring_dedup.repeated_paragraphs(engine.createDataFrame(rows, "doc_id long, text string")).collect()
        assert {r.doc_id for r in runs} == {13, 23, 33} and {r.keeper_doc_id for r in runs} == {3}
        for r in runs:
            held = dict(rows)[r.doc_id].split()[r.start : r.start + r.words]
            assert set(held) <= set(passage) and r.words >= 20


def test_every_common_run_shares_a_stretch():
    import pyarrow as pa

    draw = random.Random(3)
    for size in (35, 50, 80):
        run = [f"r{draw.randrange(10**6)}" for _ in range(size)]
        texts = ["", "a b", *[" ".join([f"{n}x{k}" for k in range(draw.randrange(40))] + run + [f"{n}y{k}" for k in range(draw.randrange(40))]) for n in range(30)]]
        hashes, first = shingles.words(pa.array(texts))
        at, keys = substring_dedup._stretches(hashes, first)
        held = [{int(k): int(a - first[n]) for a, k in zip(at, keys, strict=True) if first[n] <= a < first[n + 1]} for n in range(len(texts))]
        common = set.intersection(*map(set, held[2:]))
        places = [held[n][k] - texts[n].split().index(run[0]) for n in range(2, len(texts)) for k in common]
        assert common and min(places) <= 15 and max(places) + 20 >= size - 15 and not held[0] and not held[1]


def test_changed_lines_are_found(engine):
    draw = random.Random(4)
    line = [f"t{draw.randrange(9000)}" for _ in range(80)]
    rows = [(k, " ".join(line[:40] + ([f"new{k}"] if k % 2 else line[40:41]) + line[41:]) if k < 4 else sentence(draw) * 4) for k in range(20)]
    runs = substring_dedup.repeated_paragraphs(engine.createDataFrame(rows, "doc_id long, text string")).collect()
    assert {r.doc_id for r in runs} == {1, 2, 3}


def test_passages_of_odd_rows(odd, empty):
    assert {(r.doc_id, r.keeper_doc_id) for r in substring_dedup.repeated_paragraphs(odd).collect()} >= {(2, 1), (8, 1)}
    assert substring_dedup.drop_repeated(odd).columns == odd.columns and substring_dedup.drop_repeated(odd).count() == odd.count()
    assert substring_dedup.repeated_paragraphs(empty).count() == 0


def test_lines_are_numbered_without_a_shuffle_of_their_texts(engine, monkeypatch):  # noqa: F811
    plans = []

    def seen(items, *args):
        plans.append(items._jdf.queryExecution().executedPlan().toString())
        return similar(items, *args)

    similar = substring_dedup.similar
    monkeypatch.setattr(substring_dedup, "similar", seen)
    line = " ".join(f"w{k}" for k in range(40))
    docs = engine.createDataFrame([(1, line), (2, line), (2, line), (3, "short")], "doc_id long, text string")
    assert [(r.doc_id, r.start, r.words, r.keeper_doc_id) for r in substring_dedup.repeated_paragraphs(docs).collect()] == [(2, 0, 40, 1)]
    assert len(plans) == 1 and "Exchange" not in plans[0]


def test_templates_with_variable_fields_are_cut(engine):
    draw = random.Random(8)
    rows = [(k, f"{sentence(draw)}\nVisit shop{k}@example.com for order {k} today please\n{sentence(draw)}") for k in range(30)]
    docs = engine.createDataFrame(rows, "doc_id long, text string")
    gone = line_dedup.recurring_lines(docs, documents=10, copy=0.6).collect()
    assert {(r.doc_id, r.line_no) for r in gone} == {(k, 1) for k in range(30)}
    assert {r.template for r in gone} == {"Visit <*> for order <*> today please"}
    left = {r.doc_id: r.text for r in line_dedup.drop_recurring_lines(docs, documents=10, copy=0.6).collect()}
    assert left[4] == "\n".join(x for i, x in enumerate(rows[4][1].split("\n")) if i != 1)


def test_lines_of_copies_and_odd_rows_stay(engine, odd, empty):
    copies = engine.createDataFrame([(k, "the same first line\nthe same second line") for k in range(40)], "doc_id long, text string")
    assert line_dedup.recurring_lines(copies).count() == 0
    left = line_dedup.drop_recurring_lines(odd)
    assert left.columns == odd.columns and sorted(left.collect(), key=str) == sorted(odd.collect(), key=str)
    assert line_dedup.drop_recurring_lines(empty).count() == 0


def test_pipeline_cuts_footers_of_any_share_below_a_copy(engine):
    draw = random.Random(12)
    footer = "All rights of these pages are kept by their owner"
    rows = [(k, "\n".join([" ".join(f"u{draw.randrange(10**6)}" for _ in range(1 + k)), footer])) for k in range(30)]
    rows += [(100 + k, footer + "\n" + footer) for k in range(3)]
    docs = engine.createDataFrame(rows, "doc_id long, text string")
    left = {r.doc_id: r.text for r in corpus_pipeline.without_templates(engine, docs, "").collect()}
    assert {k for k, t in left.items() if footer not in t} == set(range(30))
    assert all(left[k] == dict(rows)[k] for k in (100, 101, 102)) and footer not in left[0]


def test_words_of_any_slice(monkeypatch):
    import pyarrow as pa

    texts = ["Hello World hello", "", None, "  a\tb\x0bc  ", "ÀÉ é one", "x" * 500 + " y"]
    whole = shingles.words(pa.array(texts))
    monkeypatch.setattr(shingles, "SLICE", 7)
    parts = shingles.words(pa.array(texts))
    assert all((a == b).all() for a, b in zip(whole, parts, strict=True))
    assert (whole[1][1:] - whole[1][:-1]).tolist() == [len(SPLIT.findall(t or "")) for t in texts] and whole[0][0] == whole[0][2]
