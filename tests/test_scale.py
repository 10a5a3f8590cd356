"""Rows of operators that were changed to grow with their input."""

import pathlib

import numpy as np
import pyarrow.parquet as pq
import pytest
from pyspark.errors import AnalysisException
from pyspark.ml.linalg import Vectors
from pyspark.sql import functions as F

from conftest import SF
from test_filters import FLOW, GOOD
from wardenlake import catalog
from wardenlake.catalog import streams
from wardenlake.catalog.features import detector_features
from wardenlake.operators import classify, corpus, details, joins, topics
from wardenlake.operators.detectors import autoencoder, forest, oneclass
from wardenlake.plans import detector_runs, netflow_features, suspicious
from wardenlake.session import cut_to_files, shared_dir


def test_asked_names_of_all_lengths_meet_the_names_that_contain_them(spark):
    names = ["a.b", "abababababababababab.x.org", "www.abababababababababab.x.org", "ababx", "q", "", None]
    asked = ["b", "ab", "aba", "babababababababababab.x.or", "abababababababababab.x.org", "", "ababy", None]
    when = ("2024 as y", "1 as m", "2 as d")
    hours = [(n, h) for n in names for h in (1, 2)]
    dns = spark.createDataFrame(hours, "dns_qry_name string, h int").selectExpr(*when, "h", "dns_qry_name")
    some = spark.createDataFrame([(a,) for a in asked], "asked string").selectExpr(*when, "1 as h", "asked")
    found = {(r.dns_qry_name, r.asked, r.h) for r in details._names_with(dns, some).collect()}
    assert found == {(n, a, 1) for n in names for a in asked if n is not None and a is not None and a in n}
    lengths = [r[0] for r in spark.range(0, 250).select(details._anchor_length(F.col("id"))).distinct().collect()]
    assert sorted(lengths) == [0, 1, 2, 4, 8, 16]


def test_entry_sums_read_stored_entries_only(spark):
    rows = spark.createDataFrame(
        [("a", Vectors.sparse(2**30, [1, 5], [2.0, 3.0])), ("b", Vectors.sparse(2**30, [], []))], ["doc", "features"]
    )
    found = rows.select("doc", topics.entry_sums("features").alias("s")).select("doc", "s.*").collect()
    assert sorted(map(tuple, found)) == [("a", 2, 5.0), ("b", 0, 0.0)]


def test_scores_of_several_models_come_from_one_look_up(spark):
    words = flow_words_of(spark)
    one = topics.TopicModel(1, words.selectExpr("doc", "array(1.0D) as mix").distinct(), words.selectExpr("word", "array(0.5D) as probs").distinct())
    two = topics.TopicModel(1, one.doc_topics, words.selectExpr("word", "array(0.25D) as probs").distinct())
    flow = spark.createDataFrame([tuple(GOOD.values())] * 2, FLOW)
    scored = suspicious.score_flow(flow, {"score": one, "trained": two})
    assert set(scored.columns) == {*flow.columns, "score", "trained"}
    assert [(r.score, r.trained) for r in scored.collect()] == [(0.5, 0.25)] * 2
    assert [r.score for r in suspicious.score_flow(flow, two).collect()] == [0.25] * 2


def flow_words_of(spark):
    return corpus.flow_corpus(spark.createDataFrame([tuple(GOOD.values())], FLOW))


@pytest.mark.parametrize("name", ["jn1_fn29_scored_flow", "jn2_jn4_scored_dns", "jn3_scored_proxy", "ml14_saved_model"])
def test_scored_queries_fit_topics(spark, monkeypatch, name):
    fitted = []
    fit = suspicious.fit_topics
    monkeypatch.setattr(suspicious, "fit_topics", lambda *a, **k: fitted.append(a[1]) or fit(*a, **k))
    rows = catalog.queries()[name](spark, SF)
    assert fitted == [5] and rows.where("not is_probability or is_probability is null").isEmpty()


def test_cosine_of_turns():
    u = np.random.default_rng(3).uniform(-400, 400, (50, 7))
    assert np.abs(oneclass.cosine_of_turns(u.copy()) - np.cos(2 * np.pi * u)).max() < 1e-11
    assert oneclass.cosine_of_turns(np.array([0.0, 0.25, 0.5, -0.5, 1.0])) == pytest.approx([1, 0, -1, -1, 1], abs=1e-14)


def test_possible_matches_lose_none(spark):
    keys = spark.range(0, 3000).selectExpr("cast(id * 7 as string) as a", "cast(id % 5 as int) as b")
    rows = spark.range(0, 30000).selectExpr("if(id = 3, null, cast(id as string)) as a", "cast(id / 7 as int) % 5 as b", "id")
    near = joins.possible_matches(rows, keys, ["a", "b"])
    assert near.columns == rows.columns
    wanted = rows.join(keys, ["a", "b"], "left_semi")
    assert wanted.exceptAll(near).isEmpty() and wanted.count() <= near.count() < 2 * wanted.count()


ENDS = [("a", "b"), ("b", "a"), ("a", "c"), ("c", "c"), ("c", "d"), ("d", "e"), (None, "a"), ("b", None), ("a", "b")]


def addressed(spark):
    rows = [(f"2024-01-02 03:04:0{i}", s, t, 1, 22, "TCP", i, 10 * i) for i, (s, t) in enumerate(ENDS)]
    return spark.createDataFrame(rows, "treceived string, sip string, dip string, sport int, dport int, proto string, ipkt long, ibyt long")


def test_long_lists_find_what_short_lists_find(spark, monkeypatch):
    flow = addressed(spark).selectExpr(
        "*", "2024 as y", "1 as m", "2 as d", "3 as h", "4 as trminute", "'' as flag", "0 as stos", "1 as input", "2 as output", "'' as rip",
        "0L as obyt", "0L as opkt")
    scores = flow.where("ipkt <> 4").selectExpr("treceived as tstart", "sip as srcip", "dip as dstip")
    anchors = spark.createDataFrame([("a", "b"), ("b", "a"), ("c", "c"), ("c", "d"), ("e", "d"), ("a", None), (None, "a")], "ip_threat string, peer string")
    results = []
    filtered = []
    through = details.possible_matches
    monkeypatch.setattr(details, "possible_matches", lambda *a: filtered.append(1) or through(*a))
    for small in (True, False):
        monkeypatch.setattr(details, "is_small", lambda df, small=small: small)
        found = details.flow_edges(flow, scores), details.chords(flow, scores), details.flow_timeline(flow, anchors)
        results.append([(df.columns, sorted(map(str, df.collect()))) for df in found])
    assert results[0] == results[1] and all(rows for _, rows in results[0])
    assert len(filtered) == 3


def test_large_tables_between_steps_are_files(spark, data):
    words = flow_words_of(spark)
    one = topics.TopicModel(1, words.selectExpr("doc", "array(1.0D) as mix").distinct(), words.selectExpr("word", "array(0.5D) as probs").distinct())
    assert suspicious._pair_scores(words.select("doc", "word"), {"score": one, "trained": one}).inputFiles()
    rows = detector_features(data)
    assert rows.inputFiles() and rows.count() == netflow_features.consolidate(data.view("v_flow")).count()
    assert forest.fit_predict_forest(rows, trees=3)[1].inputFiles()
    assert detector_runs.Spread().transform(data.view("v_flow")).inputFiles()
    steps = spark.range(4).selectExpr("array(double(id), 1.0D) as features")
    assert oneclass.fit_predict_one_class(steps, nu=0.5, steps=2, components=4)[1].inputFiles()
    assert autoencoder.fit_outliers(steps, hidden=2, epochs=1, steps=1)[1].inputFiles()


def test_cut_to_files_keeps_rows_and_types(spark):
    rows = spark.createDataFrame([("a", Vectors.sparse(3, [1], [2.0])), (None, None)], ["name", "v"]).selectExpr(
        "name", "v", "array(1.0D, null) as x", "map('k', 1) as m", "struct(cast(1 as decimal(5, 2)) as d, date'2024-01-02' as t) as s")
    kept = cut_to_files(rows)
    assert kept.inputFiles() and kept.dtypes == rows.dtypes
    assert sorted(map(str, kept.collect())) == sorted(map(str, rows.collect()))


def test_a_model_is_measured_once(spark, monkeypatch):
    words, measured = flow_words_of(spark), []
    model = topics.TopicModel(1, words.selectExpr("doc", "array(1.0D) as mix").distinct(), words.selectExpr("word", "array(0.5D) as probs").distinct())
    monkeypatch.setattr(topics, "is_small", lambda df: measured.append(1) or True)
    flow = spark.createDataFrame([tuple(GOOD.values())], FLOW)
    assert [suspicious.score_flow(flow, model).first().score for _ in range(3)] == [0.5] * 3 and len(measured) == 2


def test_files_of_a_stream_have_small_row_groups(spark, data, monkeypatch):
    asked = []
    monkeypatch.setattr(streams, "_run", lambda writer: asked.append(writer))
    rows = spark.range(0, 3_000_000, 1, 1).selectExpr("id", "xxhash64(id) as h")
    with pytest.raises(AnalysisException):  # nothing was streamed, so nothing can be read
        streams._live(data, rows, lambda batch: batch, "small-groups")
    folder = max(pathlib.Path(shared_dir(spark)).glob("work/small-groups-in-*"), key=lambda p: p.stat().st_mtime)
    assert max(pq.ParquetFile(f).metadata.num_row_groups for f in folder.glob("*.parquet")) > 2


def test_folds_keep_only_the_columns_of_the_pipeline(spark, monkeypatch):
    rows = spark.range(60).selectExpr("if(id % 2 = 0, 'a', 'b') as Class", "'TCP' as pr", "id % 7 as sp", "id % 2 as dp", "id as ipkt", "id as ibyt", "repeat('x', 50) as other")
    seen = []
    through = classify.CrossValidator.fit
    monkeypatch.setattr(classify.CrossValidator, "fit", lambda self, df: seen.append(df.columns) or through(self, df))
    _, scores = classify.cross_validated_forest(rows, trees=2, folds=2, depths=(2,), subsets=("auto",))
    assert seen == [["Class", "pr", "sp", "dp", "ipkt", "ibyt"]] and scores == [1.0]
