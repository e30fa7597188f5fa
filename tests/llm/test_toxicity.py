"""Toxicity: automata against plain edit distances, the learned lexicon, quotation, odd rows and held-out accuracy."""

from __future__ import annotations

import random

import pytest

from deskstar.llm import toxicity
from deskstar.llm.queries import QUERIES
from deskstar.llm.toxicity import Matcher, Model, Term

DOCS = "doc_id long, text string, lang string, Score double, hits int, toxic string, share int"
LABELS = "doc_id long, quality int, toxic int, text string"


def distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        before, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            before, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, before + (x != y))
    return row[-1]


def test_automata_match_edit_distances():
    draw = random.Random(1)
    terms = [Term("abc", False, 0), Term("abcab", False, 1), Term("bcbca", True, 1), Term("aabbccaab", True, 2),
             Term("ccccccccc", False, 2), Term("cab", True, 0)]
    words = {"".join(draw.choices("abc", k=draw.randint(1, 14))) for _ in range(4000)} | {"abcab" * 30, "cab" + "b" * 100}
    matcher = Matcher(terms)
    matcher.learn(words)
    for word in words:
        found = []
        for number, term in enumerate(terms):
            ends = range(len(word) + 1) if term.open else [len(word)]
            least = min(distance(word[:e], term.text) for e in ends)
            if least <= term.edits:
                found.append((least, number))
        expected = min(found, default=None)
        assert matcher.bad.get(word) == (expected and expected[::-1]), word
        assert (word in matcher.clean) == (expected is None)


@pytest.fixture(scope="module")
def table(spark):
    """Clean prose, and toxic prose with one of six words or a word that begins with a stem."""
    draw = random.Random(2)
    plain = ["".join(draw.choices("aeiourstln", k=draw.randint(2, 7))) for _ in range(400)]
    bad = ["nitwit", "dumbhead", "blockhead", "scoundrel"]
    rows, labels = [], []
    for i in range(1200):
        words = draw.choices(plain, k=60)
        toxic = i % 5 == 0
        if toxic:
            for k in draw.sample(range(60), 3):
                words[k] = draw.choice([*bad, "zorg" + draw.choice("aeiou") * 2])
        rows.append((i, " ".join(words), "en", 0.5, 1, "x", 3))
        labels.append((i, 1, int(toxic), "clash"))
    # Copies of one toxic text must not turn its plain words into terms.
    copy = " ".join(f"plain{k}" for k in range(50)) + " nitwit blockhead"
    rows += [(2000 + k, copy + f" end{k}", "en", 0.5, 1, "x", 3) for k in range(200)]
    labels += [(2000 + k, 1, 1, "clash") for k in range(200)]
    return spark.createDataFrame(rows, DOCS).repartition(4), spark.createDataFrame(labels, LABELS)


@pytest.fixture(scope="module")
def model(table):
    return toxicity.learn(*table)


def judged(spark, model, texts):
    df = spark.createDataFrame([(i, t, "en", 0.5, 1, "x", 3) for i, t in enumerate(texts)], DOCS)
    return [r["s"] for r in df.select("doc_id", toxicity.scored(df["text"], model).alias("s")).orderBy("doc_id").collect()]


def test_lexicon(model, table):
    assert [(t.text, t.open) for t in model.terms] == [
        ("blockhead", False), ("dumbhead", False), ("nitwit", False), ("scoundrel", False), ("zorg", True)]
    assert all(t.edits == toxicity.edits_allowed(len(t.text)) for t in model.terms)
    again = toxicity.learn(*table)
    assert again == model


def test_misspellings_and_quotation(spark, model):
    plain, typo, quoted, none, other = judged(spark, model, [
        "oh you nitwit and such a blockhead", "oh you nitwitt and such a blokchead", 'they wrote "nitwit" once, a word',
        "nothing of that kind", "zorgabc here and zorguu there"])
    assert [h["term"] for h in plain["hits"]] == ["nitwit", "blockhead"] and plain["score"] >= 0.7
    assert [(h["term"], h["edits"]) for h in typo["hits"]] == [("nitwit", 1), ("blockhead", 2)]
    assert none["score"] < typo["score"] < plain["score"]
    assert quoted["hits"][0]["quoted"] > 0.5 and quoted["score"] < 0.7
    assert none["hits"] == [] and [h["term"] for h in other["hits"]] == ["zorg", "zorg"]
    start, end = plain["hits"][0]["start"], plain["hits"][0]["end"]
    assert "oh you nitwit and such a blockhead"[start:end] == "nitwit"


def test_long_texts_are_read_whole(spark, model, monkeypatch):
    text = "some words and more " * 60_000 + "nitwit here nitwit there"
    found, = judged(spark, model, [text])
    assert [h["start"] for h in found["hits"]] == [text.index("nitwit"), text.rindex("nitwit")]
    monkeypatch.setattr(toxicity, "PIECE", 50)
    assert [len(h) for h in toxicity.all_hits([text, None, "", "A NITWIT"], Matcher(model.terms))] == [2, 0, 0, 1]


def test_odd_rows(spark, model, table):
    docs, labels = table
    found = judged(spark, model, [None, "", " \n", "123 ☃", "NITWIT nitwit"])
    base = Model([], model.constant, model.weights).score([])
    assert [f["score"] for f in found[:4]] == [base] * 4 and base < 0.2 and found[4]["score"] > 0.7
    empty_docs, empty_labels = docs.limit(0), labels.limit(0)
    for d, k in ((empty_docs, labels), (docs, empty_labels), (docs, labels.where("toxic = 0"))):
        assert toxicity.learn(d, k).terms == []
    odd = docs.unionByName(docs.limit(30)).unionByName(spark.createDataFrame(
        [(None, "nitwit", None, None, None, None, None), (5000, None, None, None, None, None, None)], docs.schema))
    known = labels.unionByName(spark.createDataFrame([(None, 1, 1, "x"), (5000, 1, None, "x"), (1, 1, 0, "x")], LABELS))
    assert [t.text for t in toxicity.learn(odd, known).terms] == [t.text for t in model.terms]


def test_query_on_held_out_documents(spark):
    folder = "/root/testdata/sf0.01"
    docs, labels = (spark.read.parquet(f"{folder}/{t}.parquet") for t in ("documents", "labels"))
    rows = QUERIES["op11_toxicity"](spark, folder)
    assert rows.columns == ["doc_id", "held_out", "score", "predicted"] and rows.count() == docs.count()
    known = rows.join(labels, "doc_id").where("held_out").collect()
    assert all(0 <= r["score"] <= 1 and (r["score"] >= 0.7) == r["predicted"] for r in known)
    clean = [r["score"] for r in known if not r["toxic"]]
    caught = [r["predicted"] for r in known if r["toxic"]]
    # 33 toxic texts teach it: terms that few of them share are not learned at this size.
    assert max(clean) < 0.7 and sum(caught) >= 0.7 * len(caught)
