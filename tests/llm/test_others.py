"""Language, decontamination, code search, web archives, the pipeline and the registered SQL."""

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from conftest import SF
from odd_rows import empty, engine, odd  # noqa: F401
from oracle import compare, connect
from wardenlake.llm import catalog, decontamination, language_id, topk_search, warc
from wardenlake.llm.shared import table


@pytest.mark.parametrize("name", sorted(catalog.oracle_sql()))
def test_same_rows_as_sql(engine, name):
    assert compare(catalog.queries()[name](engine, SF).toArrow(), connect(SF), catalog.oracle_sql()[name]) is None


def test_held_out_language_accuracy(engine):
    docs = table(engine, SF, "documents").selectExpr("doc_id as id", "text", "lang as language")
    model = language_id.fit_text_model(docs.where("id % 2 = 0"), per_language=20)
    held = docs.where("id % 2 = 1").selectExpr("id", "text", "language as truth", "cast(null as string) as declared")
    found = language_id.identify(held, language_id.fit(held, model, ())).collect()
    assert sum(r.language == r.truth for r in found) >= 0.95 * len(found)


def test_declaration_and_host_decide_short_texts(engine):
    docs = table(engine, SF, "documents").selectExpr("doc_id as id", "text", "lang as language")
    model = language_id.fit_text_model(docs)
    rows = docs.where("language in ('de', 'fr')").selectExpr("text", "language as declared", "concat(language, '.example') as host")
    fusion = language_id.fit(rows, model, ("host",))
    asked = engine.createDataFrame([("la", None, "fr.example"), ("la", None, "de.example"), ("la", "de-AT", "new")], "text string, declared string, host string")
    assert [r.language for r in language_id.identify(asked, fusion).collect()] == ["fr", "de", "de"]


def test_pages_and_odd_rows_have_a_language(engine, odd, empty):
    pages = catalog.language_id_pages(engine, SF).collect()
    truth = {r.page_id: r.declared for r in language_id.pages_text(table(engine, SF, "pages")).collect()}
    assert sum(r.language == truth[r.page_id] for r in pages) >= 0.9 * len(pages)
    found = language_id.identify_documents(odd)
    assert found.count() == odd.count() and not found.where("text is null or trim(text) = ''").where("accepted").count()
    assert language_id.identify_documents(empty).count() == 0


def test_leaks_equal_brute_force(engine):
    items = [r.text for r in table(engine, SF, "benchmark").collect()]
    docs = table(engine, SF, "documents").collect()
    found = {r.doc_id for r in catalog.op7_decontamination(engine, SF).collect()}
    assert found == {d.doc_id for d in docs if any(i in d.text for i in items)}


def test_new_parameters_are_caught_if_consistent(engine, odd, empty):
    item = "If Anna drives 30 km in 2 hours and then Anna rests for 5 minutes, how far does the car go in all, says Anna?"
    bench = engine.createDataFrame([(1, item), (2, None), (None, "x"), (3, "two words")], "item_id long, text string")
    same = item.replace("Anna", "Bob").replace("30", "45").replace("5", "9")
    mixed = "If Bob drives 30 km in 2 hours and then Carl rests for 5 minutes, how far does the car go in all, says Dora?"
    docs = engine.createDataFrame([(1, "before. " + same + " after"), (2, mixed), (3, "nothing"), (4, "only two words here")], "doc_id long, text string")
    rows = {(r.doc_id, r.item_id): r for r in decontamination.contaminated(docs, bench).collect()}
    assert set(rows) == {(1, 1), (4, 3)} and rows[1, 1].changed == 3
    assert decontamination.drop_contaminated(odd, bench).count() == odd.count() and decontamination.contaminated(empty, bench).count() == 0
    assert decontamination.drop_contaminated(odd, bench.limit(0)).count() == odd.count()


def test_short_items_are_found_at_any_place(engine):
    words = "which colour does a ripe lemon have when someone picks it today".split(" ")
    items = [(n, " ".join(words[:n])) for n in range(8, 12)]
    bench = engine.createDataFrame(items, "item_id long, text string")
    docs = [(100 * n + k, " ".join(f"{'abcdefgh'[j]}x" for j in range(k)) + " " + text + " end of it") for n, text in items for k in range(8)]
    found = {(r.doc_id, r.item_id) for r in decontamination.contaminated(engine.createDataFrame(docs, "doc_id long, text string"), bench).collect()}
    assert found >= {(d, d // 100) for d, _ in docs}


def test_names_at_the_start_of_a_sentence_are_parameters(engine):
    item = (
        "Anna buys ripe plums at our market every week. Anna pays exactly as much for plums as pears. "
        "Anna gives half of all fruit to their friends. Anna asks us how many plums are left now? the end when all is told"
    )
    other = "If they leave early then nobody sees where it went. When it rains the path is closed to all of us now"
    bench = engine.createDataFrame([(1, item), (2, "Paris"), (3, other)], "item_id long, text string")
    texts = {
        10: item.replace("Anna", "Bob"), 11: "Some words. " + item.replace("Anna", "Mary Ann") + " More words.", 12: item,
        13: item.replace("Anna", "Bob", 2).replace("Anna", "Carl"), 14: "London", 15: other, 16: "Bob goes home. Then Carl goes home too.",
        17: "Paris is far",
    }
    rows = decontamination.contaminated(engine.createDataFrame(list(texts.items()), "doc_id long, text string"), bench).collect()
    assert {(r.doc_id, r.item_id) for r in rows} == {(10, 1), (11, 1), (12, 1), (15, 3), (17, 2)}
    assert {r.doc_id: r.changed for r in rows} == {10: 1, 11: 1, 12: 0, 15: 0, 17: 0}


def test_readings_of_a_text(engine):
    row = engine.createDataFrame([("Then Anna Smith met USA2 and Bob, 5 Miles off. Rain (Now) xAnna 5 km",)], "text string")
    second = decontamination.tokens(F.col("text"))
    got = row.select(decontamination.first_reading(second).alias("a"), decontamination.canonical(second).alias("b")).first()
    assert [w.strip(decontamination.NAME + decontamination.UNIT) for w in got.a][:3] == ["Then", "Anna Smith", "met"]
    assert got.b[0] == decontamination.NAME and got.b[1] == "met" and got.a[-1] == decontamination.UNIT + "km"


def test_search_of_odd_vectors(engine):
    rows = [(k, [1.0 if (k >> b) & 1 else -1.0 for b in range(6)]) for k in range(0, 60)] + [(100, None), (None, [1.0]), (120, []), (140, [1.0, None, -1.0])]
    rows += [(200 + k, [1.0] * 6) for k in range(30)]
    vectors = engine.createDataFrame(rows, "vec_id long, embedding array<float>")
    usable = [(i, v) for i, v in rows if i is not None and v]
    want = set()
    for i, v in usable:
        if i % 20 == 0:
            near = sorted((sum((a is not None and a > 0) != (b is not None and b > 0) for a, b in zip(v, w, strict=True)), j) for j, w in usable if j != i and len(w) == len(v))
            want |= {(i, n + 1, j, d) for n, (d, j) in enumerate(near[:10])}
    assert {tuple(r) for r in topk_search.search(vectors).collect()} == want
    assert topk_search.search(vectors.limit(0)).count() == 0


def test_archives_round_trip(engine):
    big = "<p>" + "ü" * 600 + "</p>"
    rows = [(1, "http://a b/\r\n", big, 1), (2, None, big, 2), (3, "http://c", "small", 3), (4, "http://d", "small", 4), (5, "http://e", None, 5), (None, "http://f", big, 6), (9, "http://g", "y" * 300_000, 7)]
    pages = engine.createDataFrame(rows, "page_id long, url string, html string, offset int")
    index = warc.write_archives(pages)
    found = {r.page_id: r for r in warc.read_records(index).collect()}
    assert found[1].record_type == "revisit" and found[1].refers_to == 2 and found[1].payload_bytes == len(big.encode())
    assert {k: found[k].payload for k in (2, 3, 4, 5, 9, None)} == {2: big, 3: "small", 4: "small", 5: "", 9: "y" * 300_000, None: big}
    assert found[1].url == "http://a%20b/%0D%0A" and found[2].url is None
    chosen = warc.read_records(index.where("url like 'http://%d' or page_id = 9")).collect()
    assert sorted(r.page_id for r in chosen) == [4, 9]
    assert warc.read_records(warc.write_archives(pages.limit(0))).count() == 0


def test_pipeline_keeps_columns_and_documents(engine, odd):
    assert [name for name, _ in corpus_pipeline.STAGES] == ["language_id", "line_dedup", "near_dedup", "decontamination", "packing"]
    docs = table(engine, SF, "documents")
    for _, stage in corpus_pipeline.STAGES[:-1]:
        after = stage(engine, docs, SF)
        assert after.columns == docs.columns and after.dtypes == docs.dtypes
        docs = after
    kept = {r.doc_id for r in docs.select("doc_id").collect()}
    assert kept == {r.doc_id for r in corpus_pipeline.run(engine, SF).select("doc_id").collect()}
    assert len(kept) > 0.7 * table(engine, SF, "documents").count()
    for _, stage in corpus_pipeline.STAGES:
        stage(engine, odd, SF).count()


def test_window_keys_tell_the_readings_apart(spark):
    items = spark.createDataFrame([(1, "she has seen 5 km and 7% of it near Bob Alice, Ana 9 km ago")], "item_id long, text string")
    rows = decontamination.item_windows(items).collect()
    keys = {n: {r["key"] for r in rows if r["reading"] == n} for n in (1, 2)}
    assert keys[1] and len(keys[1]) == len(keys[2]) and not keys[1] & keys[2]  # one number names window and reading
    words = [w for r in rows if r["reading"] == 1 for w in r["item_words"]]
    assert {decontamination.UNIT + u for u in ("km", "%")} | {decontamination.NAME + n for n in ("Bob Alice", "Ana")} <= set(words)


def test_codes_of_whole_batches_are_those_of_single_vectors(engine):
    vectors = [[float((i * 37 + j * j) % 11 - 5) for j in range(70)] for i in range(40)]
    rows = engine.createDataFrame(list(enumerate(vectors)), "id long, vector array<float>").coalesce(1)
    odd_one = engine.createDataFrame([(99, [1.0, None, -1.0])], "id long, vector array<float>").coalesce(1)
    whole = {tuple(map(str, r)) for r in topk_search._codes(rows, 9).collect()}
    mixed = {tuple(map(str, r)) for r in topk_search._codes(rows.union(odd_one).coalesce(1), 9).collect()}
    assert len(whole) == 40 and mixed - whole == {("99", "3", "[1]", "[1]")} and whole < mixed


def test_vectors_of_one_length_are_a_matrix_of_signs():
    signs = topk_search._equal_lengths(pa.array([[1.0, -1.0], [0.0, 2.0], [3.0, 4.0]]).slice(1))
    assert signs.tolist() == [[False, True], [True, True]]
    for other in ([[1.0], [1.0, 2.0]], [[1.0, None]], [[1.0], None], [[], []], []):
        assert topk_search._equal_lengths(pa.array(other, pa.list_(pa.float64()))) is None


def test_probes_of_one_file_are_dealt_to_all_tasks(engine, monkeypatch):
    rows = engine.createDataFrame([(i, [1.0 if i >> j & 1 else -1.0 for j in range(8)]) for i in range(40)], "vec_id long, embedding array<double>")
    parts, through = [], topk_search.shuffle_parts
    monkeypatch.setattr(topk_search, "shuffle_parts", lambda spark: parts.append(1) or through(spark))
    assert topk_search.search(rows, k=2).count() == 4 and parts
