"""Phrases, chat windows and ranked search against brute force."""

import hashlib
import math
import random
import re
from collections import Counter

from odd_rows import empty, engine, odd  # noqa: F401
from wardenlake.llm import chat, lexical_search, phrases

LOWER = {c: c + 32 for c in range(65, 91)}


def brute_phrases(rows, least, top):
    counts, totals = {}, Counter()
    for lang, text in rows:
        lang = lang if lang is not None else "und"
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", (text or "").translate(LOWER)):
            words = re.findall(r"[^\x20\x09]+", piece)
            totals[lang] += len(words)
            for size in range(1, 6):
                for i in range(len(words) - size + 1):
                    key = (lang, tuple(words[i : i + size]))
                    counts[key] = counts.get(key, 0) + 1
    often = {k: v for k, v in counts.items() if v >= least}
    out = []
    for (lang, words), a in often.items():
        if len(words) < 2:
            continue
        cuts = []
        for k in range(1, len(words)):
            left, right = counts[(lang, words[:k])], counts[(lang, words[k:])]
            cuts.append((1000 * a * totals[lang] // (left * right), k, left, right))
        score, _, left, right = min(cuts)
        inside = any(
            o == lang and len(w) > len(words) and any(w[i : i + len(words)] == words for i in range(len(w) - len(words) + 1)) and f >= a
            for (o, w), f in often.items()
        )
        if not inside:
            out.append((lang, score, a, " ".join(words), left, right))
    ranked = []
    for lang in {x[0] for x in out}:
        best = sorted((x for x in out if x[0] == lang), key=lambda x: (-x[1], -x[2], x[3].encode()))[:top]
        ranked += [(lang, k, x[3], x[2], x[4], x[5], totals[lang], x[1]) for k, x in enumerate(best, 1)]
    return sorted(ranked)


def test_phrases_equal_brute_force(engine):
    draw = random.Random(4)
    vocabulary = ["a", "B", "é", "d", "long", "x1"]
    rows = []
    for number in range(60):
        parts = [draw.choice(vocabulary) + draw.choice([" ", " ", "\t", ", ", "\n", ". "]) for _ in range(draw.randint(0, 40))]
        rows.append((draw.choice(["en", "de", None]), "".join(parts) + "common words of all of them"))
    rows += [("en", None), ("de", ""), ("en", " . ,")]
    docs = engine.createDataFrame(rows, "lang string, text string")
    for budget in (20, 500_000):  # the small budget makes prefixes longer
        found = phrases.collocations(docs, least=5, top=40, budget=budget).collect()
        names = ("lang", "rank", "phrase", "a", "l", "r", "n", "score")
        assert sorted(tuple(r[n] for n in names) for r in found) == brute_phrases(rows, 5, 40)


def test_phrases_of_odd_rows(odd, empty):
    found = phrases.collocations(odd, least=100, top=5).collect()
    rows = [(r.lang, r.text) for r in odd.collect()]
    assert sorted((r.lang, r["rank"], r.phrase, r.a, r.l, r.r, r.n, r.score) for r in found) == brute_phrases(rows, 100, 5)
    assert phrases.collocations(empty).count() == 0


def words_of(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", (text or "").translate(LOWER))


def brute_search(docs, items, k):
    counted = [(d, Counter(words_of(t))) for d, t in docs]
    counted = [(d, c) for d, c in counted if c]
    n_docs, n_terms = len(counted), sum(sum(c.values()) for _, c in counted)
    df = Counter(t for _, c in counted for t in c)
    asked = {}
    for item, text in items:
        asked.setdefault(item, set()).update(words_of(text))
    out = []
    for item, terms in asked.items():
        scores = []
        for doc, c in counted:
            m = 50 + 50 * sum(c.values()) * n_docs // n_terms
            score = sum(math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * (10**9 * c[t] // (1000 * c[t] + 20 * m)) for t in terms if t in c)
            if score > 0:
                scores.append((-score, doc is None, doc))
        out += [(item, r, s[2], -s[0]) for r, s in enumerate(sorted(scores, key=lambda s: (s[0], s[1], s[2] or 0))[:k], 1)]
    return sorted(out, key=str)


def test_search_equals_brute_force(engine, monkeypatch):
    draw = random.Random(9)
    vocabulary = [f"w{int(draw.paretovariate(0.7)) % 60}" for _ in range(400)]
    docs = [(k, " ".join(draw.choice(vocabulary) for _ in range(draw.randint(1, 40))) + draw.choice(["", " É!", "\x7fW1"])) for k in range(300)]
    docs += [(400 + k, docs[7][1]) for k in range(20)] + [(7, "another w1"), (None, docs[7][1]), (500, None), (501, " ,")]
    items = [(k, " ".join(draw.choice(vocabulary) for _ in range(12))) for k in range(15)] + [(3, "É"), (20, None), (21, "nowhere"), (None, "w1 w2")]
    frames = engine.createDataFrame(docs, "doc_id long, text string"), engine.createDataFrame(items, "item_id long, text string")
    wanted = brute_search(docs, items, 10)
    for settings in ({}, {"SLICE_POSTINGS": 40, "FIRST_DOCS": 5, "GROWTH": 3, "BLOCK_TERMS": 60, "SLICE": 9}):
        for name, value in settings.items():
            monkeypatch.setattr(lexical_search, name, value)
        found = lexical_search.search(lexical_search.build_index(frames[0]), frames[1], k=10).collect()
        assert sorted(((r.item_id, r["rank"], r.doc_id, r.score) for r in found), key=str) == wanted


def test_search_of_odd_rows(engine, odd, empty):
    items = engine.createDataFrame([(1, "alpha beta"), (2, "one")], "item_id long, text string")
    rows = [(r.doc_id, r.text) for r in odd.collect()]
    found = lexical_search.search(lexical_search.build_index(odd), items, k=3).collect()
    assert [(r.score) for r in sorted(found, key=lambda r: (r.item_id, r["rank"]))] == [x[3] for x in brute_search(rows, [(1, "alpha beta"), (2, "one")], 3)]
    assert lexical_search.search(lexical_search.build_index(empty), items).count() == 0
    assert lexical_search.search(lexical_search.build_index(odd), items.where("item_id < 0")).count() == 0


TURNS = "conv_id long, turn long, role string, text string, window int, _conv_id string"


def talk(draw, number, turns, system):
    rows = [(number, 0, "system", "be brief " * draw.randint(1, 5), 1, "x")] if system else []
    for k in range(turns):
        text = " ".join(draw.choice(["yes", "<turn ", "</turn>", "<\\turn", "</\\\\turn>\n", "\\", "é", "a,b", ">\n"]) for _ in range(draw.randint(0, 30)))
        rows.append((number, len(rows), "user" if k % 2 == 0 else "assistant", text, 1, "x"))
    return rows


def test_windows_hold_every_turn_once(engine):
    draw = random.Random(2)
    rows = [r for n in range(12) for r in talk(draw, n, draw.randint(1, 200 if n == 0 else 25), n % 2)]
    rows += [(50, 0, "system", "word " * 80, 1, "x"), (50, 1, "assistant", "tail", 1, "x"), (51, 0, "system", "alone", 1, "x")]
    rows += [(52, 0, "user", "long " * 300, 1, "x"), (52, 1, "assistant", "reply " * 200, 1, "x"), (52, 2, "user", None, 1, "x")]
    rows += [(None, 5, None, "no id", 1, "x"), (None, None, "a<b>\\l", "first", 1, "x"), (53, 0, "assistant", "same", 1, "x"), (53, 0, "assistant", "same", 1, "x")]
    turns = engine.createDataFrame(rows, TURNS)
    made = chat.windows(turns, budget=100, history=30)
    windows = made.withColumn("turns", chat.read_turns(made["formatted"])).collect()
    for conv in {r[0] for r in rows}:
        own = [r for r in rows if r[0] == conv]
        own.sort(key=lambda r: (r[1] is not None, r[1] or 0, r[2] or "", hashlib.md5((r[3] or "").encode()).hexdigest()))
        wanted = [(r[2] or "", r[3] or "") for r in own]
        mine = sorted((w for w in windows if w.conv_id == conv), key=lambda w: w.window)
        assert [tuple(t) for w in mine for t in w.turns[w.n_repeated :]] == wanted
        said = [chat_unescape(w.formatted[s.start : s.end]) for w in mine for s in w.loss]
        assert said == [t for r, t in wanted if r == "assistant"]
        retained = wanted[0][0] == "system" and 2 * (size(wanted[0][1])) <= 100
        at = 0
        for w in mine:
            new = w.n_turns - w.n_repeated
            assert w.size == sum(size(t[1]) for t in w.turns) and (w.size <= 100 or (new == 1 and w.over_budget))
            again = [tuple(t) for t in w.turns[: w.n_repeated]]
            if retained and at:
                assert again.pop(0) == wanted[0]
            assert again == (wanted[at - len(again) : at] if again else []) and sum(size(t) for _, t in again) <= 30
            at += new
    assert any(w.n_repeated > 1 for w in windows)


def size(text):
    return len(re.findall(r"[A-Za-z0-9]+|[^A-Za-z0-9\x00-\x20]", text)) + 4


def chat_unescape(text):
    return re.sub(r"(</?\\*)\\(turn)", r"\1\2", text)


def test_digests_of_odd_conversations(engine, odd):
    turns = engine.createDataFrame([(1, 0, "user", "\\### Assistant: </turn> ok", 1, "x"), (1, 1, "assistant", "\\### Assistant: </turn> ok", 1, "x")], TURNS)
    (row,) = chat.digests(chat.windows(turns)).collect()
    text = "\\### Assistant: </turn> ok"
    assert row.turns_sha256 == hashlib.sha256(f"user\n{text}\nassistant\n{text}\n".encode()).hexdigest()
    assert (row.n_turns, row.loss_chars, row.loss_sha256) == (2, len(text), hashlib.sha256(text.encode()).hexdigest())
    assert chat.digests(chat.windows(turns.where("conv_id > 5"))).count() == 0
    long = engine.createDataFrame([(1, 0, "user", "x y " * 200_000, 1, "x"), (1, 1, "assistant", "", 1, "x")], TURNS)
    (row,) = chat.digests(chat.windows(long)).collect()
    assert (row.n_turns, row.loss_chars) == (2, 0)
