import pytest
from pyspark.sql import functions as F

from test_filters import DNS, DNS_GOOD, FLOW, GOOD
from wardenlake.operators import topics
from wardenlake.operators.indexing import dense_index
from wardenlake.operators.topics import TopicModel, fit_topics, score_pairs
from wardenlake.plans import suspicious
from wardenlake.plans.suspicious import Settings, dns_suspicious_connects, flow_suspicious_connects, proxy_suspicious_connects
from wardenlake import schemas
from wardenlake.session import work_path

CORPUS = "doc string, word string, count bigint"


def joint(model):
    docs = {r.doc: r.mix for r in model.doc_topics.collect()}
    words = {r.word: r.probs for r in model.word_topics.collect()}
    return {(d, w): sum(a * b for a, b in zip(docs[d], words[w])) for d in docs for w in words}


@pytest.mark.parametrize("seed", [0xDEADBEEF, 1])
def test_disjoint_documents(spark, seed):
    got = joint(fit_topics(spark.createDataFrame([("cat fancy", "cat", 1), ("dog world", "dog", 1)], CORPUS), k=2, alpha=1.2, seed=seed))
    assert got["cat fancy", "cat"] == pytest.approx(1, abs=0.01) and got["dog world", "dog"] == pytest.approx(1, abs=0.01)


def test_unbalanced_document(spark):
    got = joint(fit_topics(spark.createDataFrame([("pets", "cat", 1), ("pets", "dog", 999)], CORPUS), k=2, seed=1))
    assert got["pets", "cat"] == pytest.approx(0.001, abs=0.01) and got["pets", "dog"] == pytest.approx(0.999, abs=0.01)


@pytest.mark.parametrize("settings", [
    Settings(seed=1), Settings(seed=1, precision=32), Settings(seed=1, optimizer="online", max_iter=200, alpha=0.0009, beta=1e-5),
])
def test_odd_hour_flow(spark, settings):
    rows = [tuple({**GOOD, "trhour": h}.values()) for h in [0] + [13] * 9]
    got = sorted(r.score for r in flow_suspicious_connects(spark.createDataFrame(rows, FLOW), settings).suspicious.collect())
    assert got == pytest.approx([0.1] + [0.9] * 9, abs=0.01)


def test_odd_length_reply(spark):
    rows = [tuple({**DNS_GOOD, "frame_len": n}.values()) for n in [1] + [168] * 4]
    top = spark.createDataFrame([(1, "google.com")], "rank int, domain string")
    got = sorted(r.score for r in dns_suspicious_connects(spark.createDataFrame(rows, DNS), top, Settings(seed=1)).suspicious.collect())
    assert got == pytest.approx([0.2] + [0.8] * 4, abs=0.01)


def test_odd_host_request(spark):
    numbers = ("duration", "scbytes", "csbytes")
    schema = ", ".join(f"{c} {'int' if c in numbers else 'string'}" for c in schemas.PROXY_IN)
    good = {c: 1 if c in numbers else "x" for c in schemas.PROXY_IN}
    good.update(p_time="00:09:13", fulluri="ab", resconttype="text/plain", respcode="202")
    rows = [tuple({**good, "host": h}.values()) for h in ["own.com"] + ["maw.bronto.com"] * 9]
    top = spark.createDataFrame([(1, "google.com")], "rank int, domain string")
    got = sorted(r.score for r in proxy_suspicious_connects(spark.createDataFrame(rows, schema), top, Settings(seed=1, safe_domains=("own",))).suspicious.collect())
    assert got == pytest.approx([0.1] + [0.9] * 9, abs=0.01)


def test_scores_of_unseen_and_error_words(spark):
    docs = spark.createDataFrame([("a", [0.3, 0.7])], "doc string, mix array<double>")
    words = spark.createDataFrame([("w", [0.5, 0.1])], "word string, probs array<double>")
    pairs = spark.createDataFrame([("a", "w"), ("a", "new"), ("b", "w"), ("a", "word_error")], "doc string, word string")
    got = {(r.doc, r.word): (r.score, r.is_unseen) for r in score_pairs(pairs, TopicModel(2, docs, words)).collect()}
    assert got["a", "w"] == (pytest.approx(0.22), False)
    assert got["a", "new"] == (0.0, True) and got["b", "w"] == (0.0, True)
    assert got["a", "word_error"][0] == -1.0


def odd_flows(spark):
    """Flows with known and unknown ends, an error word and null addresses, and two models of which one lacks words."""
    changes = [{}, {}, {"sip": "9.9.9.9"}, {"sport": None}, {"sip": None}, {"dip": None}, {"dip": "8.8.8.8", "ibyt": 10**6}]
    flows = spark.createDataFrame([tuple({**GOOD, **c}.values()) for c in changes], FLOW)
    model = fit_topics(suspicious.bags.flow_corpus(flows.limit(1)), k=2, seed=1, max_iter=3)
    return flows, {"score": model, "other": TopicModel(2, model.doc_topics, model.word_topics.limit(1))}


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_small_models_are_looked_up_without_a_shuffle_of_records(spark, monkeypatch):
    flows, models = odd_flows(spark)
    straight = suspicious.score_flow(flows, models)
    assert "Exchange hashpartitioning" not in plan_of(straight) and "SortMergeJoin" not in plan_of(straight)
    clients = flows.selectExpr("sip as client", "case when sport is null then 'word_error' else proto end as word")
    words = TopicModel(2, models["score"].doc_topics, spark.createDataFrame([(GOOD["proto"], [0.5, 0.25])], "word string, probs array<double>"))
    of_clients = suspicious._score_client(clients, words, "client")
    monkeypatch.setattr(suspicious, "is_small_model", lambda model: False)
    for a, b in ((straight, suspicious.score_flow(flows, models)), (of_clients, suspicious._score_client(clients, words, "client"))):
        assert sorted(a.columns) == sorted(b.columns)
        assert sorted(map(str, a.select(*b.columns).collect())) == sorted(map(str, b.collect()))


def test_feedback_raises_the_score(spark):
    rows = spark.createDataFrame([tuple({**GOOD, "trhour": h}.values()) for h in [0] + [13] * 9], FLOW)
    judged = spark.createDataFrame([tuple({**GOOD, "trhour": 0}.values())], FLOW).select(*schemas.FLOW_MODEL)
    before = min(r.score for r in flow_suspicious_connects(rows, Settings(seed=1)).suspicious.collect())
    after = {r.trhour: r.score for r in flow_suspicious_connects(rows, Settings(seed=1, duplication=90), judged).suspicious.collect()}
    assert before < 0.11 and after[0] > 0.8


def test_save_and_load(spark):
    model = fit_topics(spark.createDataFrame([("pets", "cat", 1), ("pets", "dog", 9)], CORPUS), k=2, seed=1, max_iter=5)
    path = work_path(spark, "model")
    model.save(path)
    assert joint(TopicModel.load(spark, path)) == joint(model)


def test_unknown_optimizer(spark):
    with pytest.raises(ValueError):
        fit_topics(spark.createDataFrame([("a", "b", 1)], CORPUS), optimizer="gibbs")


def test_dense_index_reads_its_input_once(spark):
    read = spark.sparkContext.accumulator(0)

    def seen(word):
        read.add(1)
        return word

    words = spark.range(100).select(F.udf(seen, "string")(F.col("id").cast("string")).alias("word"))
    assert sorted(r.idx for r in dense_index(words, "word").collect()) == list(range(100))
    assert read.value == 100
