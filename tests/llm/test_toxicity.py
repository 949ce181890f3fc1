"""Toxicity scores: held-out accuracy, interactions, awkward rows."""

import collections
import math
import random
import re

import numpy as np
import xxhash
from brute import awkward, fold
from conftest import MEDIUM

from gatewatch.llm import queries, toxicity
from gatewatch.llm.toxicity import Machine, Settings, Terms


def test_held_out_accuracy(spark):
    got = queries.op4_toxicity(spark, MEDIUM).collect()
    labels = {r["doc_id"]: r["toxic"]
              for r in spark.read.parquet(f"{MEDIUM}/labels.parquet").collect()}
    assert len(got) == 1000 and all(0 <= r["score"] <= 1 for r in got)
    assert all(r["predicted"] == int(r["score"] >= 0.7) for r in got)
    held = [(r["score"], labels[r["doc_id"]]) for r in got
            if r["held_out"] and r["doc_id"] in labels]
    ones = [s for s, y in held if y]
    zeros = [s for s, y in held if not y]
    auc = np.mean([(a > b) + 0.5 * (a == b) for a in ones for b in zeros])
    assert len(ones) > 10 and auc > 0.9
    assert sum(s >= 0.7 for s in ones) > 0.7 * len(ones)
    assert sum(s >= 0.7 for s in zeros) <= 0.03 * len(zeros)


def test_pairs_that_no_sum_of_weights_can_tell(spark):
    """Toxic only where an insult and a group meet; each alone is harmless."""
    rng = random.Random(1)
    docs, labels = [], []
    for i in range(1200):
        insult, group = rng.random() < 0.5, rng.random() < 0.5
        words = rng.choices(["tea", "rain", "stone", "river", "lamp"], k=8)
        words += ["vermin"] * insult + ["northerners"] * group
        rng.shuffle(words)
        docs.append((i, " ".join(words)))
        labels.append((i, int(insult and group)))
    documents = spark.createDataFrame(docs, "doc_id long, text string")
    known = spark.createDataFrame(labels, "doc_id long, toxic int")
    machine = toxicity.fit(documents, known, "doc_id", "text", "toxic", Settings(epochs=200))
    tests = ["vermin tea rain", "northerners tea rain", "vermin northerners tea", "tea rain"]
    got = toxicity.score(spark.createDataFrame([(t,) for t in tests], "text string"), machine)
    scores = {r["text"]: r["score"] for r in got.collect()}
    assert scores[tests[2]] > 0.7
    assert max(scores[tests[k]] for k in (0, 1, 3)) < 0.4


def test_margin_is_the_sum_over_all_pairs():
    rng = np.random.default_rng(3)
    machine = Machine(Settings(), np.arange(6), 0.3, rng.normal(size=6), rng.normal(size=(6, 4)))
    at = np.array([0, 2, 5])
    expected = 0.3 + machine.weights[at].sum() + sum(
        machine.factors[a] @ machine.factors[b] for a, b in ((0, 2), (0, 5), (2, 5)))
    got = machine.margin([at, np.zeros(0, int)])
    assert abs(got[0] - expected) < 1e-12 and got[1] == 0.3


def test_terms_are_bounded_and_repeatable():
    terms = Terms(Settings())
    assert terms.of_text("Vermin, vermin!") == terms.of_text("vermin") != terms.of_text("verm")
    assert terms.of_text("") == set() and all(0 <= t < 1 << 20 for t in terms.of_text("äöü xyzzy"))


def test_awkward_documents(spark):
    df = awkward(spark)
    labels = spark.createDataFrame(
        [(1, 1), (1, 0), (5, 1), (6, None), (None, 1), (4, 0), (99, 1)], "doc_id long, toxic int")
    machine = toxicity.fit(df, labels, "doc_id", "text", "toxic")
    got = toxicity.score(df, machine)
    assert got.columns == [*(c for c in df.columns if c != "score"), "score"]
    rows = got.collect()
    assert len(rows) == df.count() and all(0 <= r["score"] <= 1 for r in rows)
    assert len({r["score"] for r in rows if r["doc_id"] in (1, 2, 3)}) == 1
    for none in (labels.limit(0), labels.where("toxic = 0")):
        constant = toxicity.fit(df, none, "doc_id", "text", "toxic")
        assert len({r["score"] for r in toxicity.score(df, constant).collect()}) == 1
    assert toxicity.score(df.limit(0), machine).collect() == []


def test_the_sample_is_bounded(spark):
    documents = spark.range(400).selectExpr("id AS doc_id", "concat('word', id % 7) AS text")
    labels = spark.range(400).selectExpr("id AS doc_id", "CAST(id % 2 AS INT) AS toxic")
    seen = []
    original = toxicity._choose

    def spy(rows, y, settings):
        seen.append(len(rows))
        return original(rows, y, settings)

    toxicity._choose = spy
    try:
        toxicity.fit(documents, labels, "doc_id", "text", "toxic", Settings(sample_rows=50))
    finally:
        toxicity._choose = original
    assert 20 <= seen[0] <= 90


def test_query_against_a_plain_version(spark):
    """Every score of the query, from terms in sets, a dense matrix and plain gradients."""
    docs = {r["doc_id"]: r["text"] or ""
            for r in spark.read.parquet(f"{MEDIUM}/documents.parquet").collect()}
    labels = {r["doc_id"]: r["toxic"]
              for r in spark.read.parquet(f"{MEDIUM}/labels.parquet").collect()}
    s = Settings()

    def terms(text):
        found = set()
        lower = re.sub("[A-Z]", lambda m: m[0].lower(), text)
        for w in re.findall("[a-z0-9\x80-\U0010ffff]+", lower):
            forms = ["w" + w, *("p" + w[:k] for k in s.prefixes if len(w) > k)]
            found |= {xxhash.xxh64_intdigest(f.encode(), 0) >> (64 - s.bits) for f in forms}
        return found

    rows = {i: terms(t) for i, t in docs.items()}
    teach = sorted(i for i in docs if i in labels and labels[i] is not None and fold(i, 3) != 1)
    assert len(teach) < s.sample_rows
    y = np.array([labels[i] for i in teach], float)
    n, n1 = len(y), y.sum()
    total, ones = collections.Counter(), collections.Counter()
    for i, label in zip(teach, y):
        total.update(rows[i])
        ones.update(rows[i] if label else ())
    z = {}
    for t, c in total.items():
        if c >= s.min_documents:
            pool = (c + 1) / (n + 2)
            z[t] = ((ones[t] + 0.5) / (n1 + 1) - (c - ones[t] + 0.5) / (n - n1 + 1)) / math.sqrt(
                pool * (1 - pool) * (1 / n1 + 1 / (n - n1)))
    chosen = sorted(sorted((t for t in z if abs(z[t]) >= s.min_z),
                           key=lambda t: (-abs(z[t]), t))[:s.max_terms])
    place = {t: k for k, t in enumerate(chosen)}

    def dense(ids):
        x = np.zeros((len(ids), len(chosen)))
        for k, i in enumerate(ids):
            x[k, [place[t] for t in rows[i] if t in place]] = 1
        return x

    def margin(x, b, w, v):
        return b + x @ w + 0.5 * ((x @ v) ** 2 - x @ (v * v)).sum(axis=1)

    x = dense(teach)
    share = (n1 + 0.5) / (n + 1)
    b, w = math.log(share / (1 - share)), np.zeros(len(chosen))
    v = np.random.default_rng(s.seed).normal(0, 0.01, (len(chosen), s.factors))
    gb, gw, gv = 1e-8, np.full(w.shape, 1e-8), np.full(v.shape, 1e-8)
    for _ in range(s.epochs):
        error = 1 / (1 + np.exp(-np.clip(margin(x, b, w, v), -30, 30))) - y
        db, dw = error.mean(), x.T @ error / n + s.shrink * w
        dv = (x.T @ (error[:, None] * (x @ v)) - (x.T @ error)[:, None] * v) / n + s.shrink * v
        gb, gw, gv = gb + db ** 2, gw + dw ** 2, gv + dv ** 2
        b, w, v = (b - s.rate * db / math.sqrt(gb), w - s.rate * dw / np.sqrt(gw),
                   v - s.rate * dv / np.sqrt(gv))
    ids = list(docs)
    score = 1 / (1 + np.exp(-np.clip(margin(dense(ids), b, w, v), -30, 30)))
    got = {r["doc_id"]: r for r in queries.op4_toxicity(spark, MEDIUM).collect()}
    assert got.keys() == docs.keys() and chosen
    assert max(abs(got[i]["score"] - p) for i, p in zip(ids, score)) < 1e-6
    assert all(got[i]["held_out"] == (fold(i, 3) == 1) for i in ids)
