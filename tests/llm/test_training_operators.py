"""Each operator against brute force, and over nulls, empty texts, repeated rows, empty tables and clashing columns."""

from __future__ import annotations

import hashlib
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
import sentencepiece
from pyspark.sql import functions as F

import corpus_pipeline
from compare import compare, connect
from deskstar.llm import (collisions, language, line_dedup, mixing, near_documents, neighbours, pieces, repeats,
                          sharding)
from deskstar.llm.common import components, mapped
from deskstar.llm.queries import QUERIES, TWINS, VOCABULARY

SCHEMA = "doc_id long, text string, lang string, source string, size int, shard string, lines int, cut int"
ODD = [(None, "an odd one\nwithout id", "en", None), (3, None, None, "a"), (4, "", "en", "a"), (5, "123 456", "en", "b"),
       (6, "same text here " * 30, "en", "b"), (7, "same text here " * 30, "en", None),
       (7, "same text here " * 30, "en", None), (8, "x " * 30_000, "xx", "c"), (9, "ünï\n\n\tcödé ▁ ☃", "de", "")]


@pytest.fixture(scope="module")
def odd(spark):
    return spark.createDataFrame([(*row, 1, "s", 2, 3) for row in ODD], SCHEMA).repartition(3)


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="module")
def docs(spark, sf_dir):
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


@pytest.mark.parametrize("name", sorted(TWINS))
def test_twin(spark, sf_dir, name):
    assert not compare(spark, connect(sf_dir), name, QUERIES[name], TWINS[name], sf_dir)


def test_language_held_out_accuracy(spark, sf_dir, docs):
    rows = QUERIES["op1_language_id"](spark, sf_dir).join(docs, "doc_id").where("held_out").collect()
    assert rows and np.mean([r["lang_pred"] == r["lang"] for r in rows]) > 0.97


def test_language_counts_match_brute_force():
    text = "Ab abc, ünd 12 ab"
    counts = Counter()
    for word in ("ab", "abc", "ünd", "ab"):
        padded = f" {word} "
        counts.update(padded[i:i + n] for n in (1, 2, 3) for i in range(len(padded) - n + 1) if padded[i:i + n] != " ")
    keys, n = language.gram_counts(text)
    found = {"".join(chr(k >> s & 0x1FFFFF) for s in (42, 21, 0) if k >> s & 0x1FFFFF): c
             for k, c in zip(keys.tolist(), n.tolist(), strict=True)}
    assert found == counts


def test_language_choice_matches_brute_force(spark):
    """Distance, ties, score and the rule of held-out rows, gram by gram in plain Python."""
    rows = [(k, ("la casa de la " if k % 2 else "the house of the ") * (k % 3 + 1) + chr(97 + k % 26), "es" if k % 2 else "en")
            for k in range(60)]
    table = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    profiles = language.learn(table, length=50)
    held = {r["doc_id"] for r in table.where(language.held_out(F.col("doc_id"))).collect()}
    assert held == {k for k in range(60) if zlib.crc32(str(k).encode()) % 4 == 2}
    for name in ("en", "es"):
        total = Counter()
        for k, text, lang in rows:
            if lang == name and k not in held:
                keys, counts = language.gram_counts(text)
                total.update(dict(zip(keys.tolist(), counts.tolist(), strict=True)))
        assert profiles[name] == sorted(total, key=lambda g: (-total[g], g))[:50]
    twice = {"a": profiles["en"], "b": profiles["en"], "c": profiles["es"]}
    texts = ["the house", "la casa", "zzz", "123", ""]
    for text in texts:
        keys, counts = language.gram_counts(text)
        mine = sorted(keys.tolist(), key=dict(zip(keys.tolist(), (-counts).tolist(), strict=True)).get)[:50]
        apart = {n: sum(abs(k - p.index(g)) if g in p else 50 for k, g in enumerate(mine)) for n, p in twice.items()}
        best = min(sorted(apart), key=apart.get)
        expected = (best, 1 - apart[best] / (50 * len(mine))) if mine else ("und", 0.0)
        assert language.Profiles(twice, 50).classify(text) == pytest.approx(expected)


def test_language_odd_rows(odd, none):
    profiles = {"en": language.ranked(*language.gram_counts("the cat and the dog"), 400)}
    rows = odd.select("text", language.predicted(F.col("text"), profiles).alias("p")).collect()
    for row in rows:
        letters = any(c.isalpha() for c in row["text"] or "")
        assert row["p"]["lang"] == ("en" if letters else "und") and 0 <= row["p"]["score"] <= 1
    assert language.learn(none) == {}
    assert odd.select(language.predicted(F.col("text"), {}).alias("p")).where("p.lang <> 'und'").count() == 0


def test_perfect_hash_numbers_every_key():
    keys = np.unique(np.random.default_rng(1).integers(0, 2 ** 63, 5000, dtype=np.uint64))
    made = line_dedup.PerfectHash.load(line_dedup.PerfectHash.build(keys, keys + np.uint64(1), np.arange(1, len(keys) + 1)).dump())
    assert (made.probe(keys, keys + np.uint64(1)) == np.arange(1, len(keys) + 1)).all()
    assert not made.probe(keys, keys).any() and len(made.arrays["count"]) == len(keys)


@pytest.mark.parametrize("options", [{}, {"keys_per_shard": 2, "index_bytes": 60}])
def test_line_dedup_odd_rows(odd, none, options):
    rows = odd.unionByName(odd.select("doc_id", F.concat(F.lit("Shared \n"), F.coalesce("text", F.lit(""))).alias("text"), "lang",
                                      "source", "size", "shard", "lines", "cut"))
    found = line_dedup.drop_shared_lines(rows, min_docs=3, **options)
    counts = Counter(k for r in rows.collect() for k in set(line_dedup.line_keys((r["text"] or "").encode())[1]))
    for r in found.collect():
        lines, keys = line_dedup.line_keys((r["text"] or "").encode())
        kept = [x for x, k in zip(lines, keys, strict=True) if not k or counts[k] < 3]
        assert (r["lines"]["n_lines"], r["lines"]["n_dropped"]) == (len(lines), len(lines) - len(kept))
        assert r["lines"]["text"] == b"\n".join(kept).decode()
    assert line_dedup.drop_shared_lines(none).count() == 0


def test_mixing_odd_rows(odd, none):
    rows = mixing.mix(odd).collect()
    assert len(rows) == len(ODD) and all(0 <= r["taken"] <= 2 * r["size"] for r in rows)
    sums = defaultdict(int)
    for r in rows:
        sums[r["source_size"], r["target"]] += r["taken"]
    assert all(abs(taken - target * sum(1 for _ in [0])) <= 1 or size == 0 for (size, target), taken in sums.items())
    assert mixing.mix(none).count() == 0 and mixing.repeated(none).count() == 0


def test_mixing_repeats_whole_rows(docs):
    taken = mixing.mix(docs).agg(F.sum("taken")).first()[0]
    rows = mixing.repeated(docs)
    assert rows.columns == docs.columns
    assert rows.agg(F.sum(mixing.word_count(F.col("text")))).first()[0] == taken


def test_sharding(odd, none, docs):
    for rows, cell in ((odd, 1_000_000), (docs.repartition(5), 3)):
        found = sharding.shuffle_into_shards(rows.select("doc_id", "text"), 24, cell_rows=cell).collect()
        slots = defaultdict(list)
        for r in found:
            slots[r["shard"]].append(r["slot"])
        sizes = [len(slots.get(s, [])) for s in range(24)]
        assert sum(sizes) == rows.count() and max(sizes) - min(sizes) <= 1
        assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    assert sharding.shuffle_into_shards(none, 24).count() == 0


def test_hypergeometric_law(spark):
    u = [(k + 0.5) / 4000 for k in range(4000)]
    draw = sharding.hypergeometric(F.lit(50).cast("long"), F.lit(20).cast("long"), F.lit(10).cast("long"), F.col("u"))
    got = Counter(r[0] for r in spark.createDataFrame([(x,) for x in u], "u double").select(draw).collect())
    from math import comb
    for k in range(11):
        assert abs(got[k] / 4000 - comb(20, k) * comb(30, 10 - k) / comb(50, 10)) < 1e-3


VECTORS = "vec_id long, embedding array<float>, label int, key int"


@pytest.fixture(scope="module")
def vectors(spark):
    rng = np.random.default_rng(3)
    base = rng.standard_normal((300, 16))
    near = base[:60] + 0.1 * rng.standard_normal((60, 16))
    rows = [(i, [float(x) for x in v], 0, 0) for i, v in enumerate([*base, *near, *[base[0]] * 40])]
    rows += [(1000, None, 0, 0), (1001, [0.0] * 16, 0, 0), (1002, [1.0, None] + [0.0] * 14, 0, 0),
             (1003, [float("nan")] * 16, 0, 0), (1004, [1.0] * 3, 0, 0), (None, [1.0] * 16, 0, 0), (1005, [], 0, 0)]
    return spark.createDataFrame(rows, VECTORS).repartition(3)


def whole_vectors(vectors):
    rows = [r for r in vectors.collect() if r["vec_id"] is not None and r["vec_id"] < 1000]
    return np.array([r["vec_id"] for r in rows]), np.array([r["embedding"] for r in rows], dtype=np.float64)


def test_neighbours(spark, vectors):
    ids, x = whole_vectors(vectors)
    found = defaultdict(list)
    for r in neighbours.search(vectors, vectors.where("vec_id % 20 = 0"), shard_rows=100, query_rows=7).orderBy("rank").collect():
        found[r["query_id"]].append((r["vec_id"], r["score"]))
    hits = 0
    for q, rows in found.items():
        score = (x * x[ids == q][0]).sum(axis=1)
        order = [k for k in np.lexsort((ids, -score)) if ids[k] != q][:20]
        hits += len({i for i, _ in rows} & set(ids[order]))
        exact = dict(zip(ids, score, strict=True))
        assert rows == sorted(((i, exact[i]) for i, _ in rows), key=lambda r: (-r[1], r[0])) and len(rows) == 20
    assert set(found) == {i for i in ids if i % 20 == 0} and hits >= 0.9 * 20 * len(found)
    empty = spark.createDataFrame([], VECTORS)
    assert neighbours.search(empty, empty).count() == 0


def test_collisions(spark, vectors):
    ids, x = whole_vectors(vectors)
    unit = x / np.linalg.norm(x, axis=1)[:, None]
    near = unit @ unit.T >= 0.9
    label = {i: i for i in ids.tolist()}
    for _ in range(10):
        label = {i: min(label[j] for j in ids[near[k]].tolist()) for k, i in enumerate(ids.tolist())}
    rows = {r["vec_id"]: r for r in collisions.near_duplicates(vectors, block_rows=64).collect()}
    for k, i in enumerate(ids.tolist()):
        assert (rows[i]["n_links"], rows[i]["component_id"]) == (near[k].sum() - 1, label[i])
        assert rows[i]["kept"] == (label[i] == i)
    assert all(rows[i]["n_links"] == 0 and rows[i]["kept"] for i in (None, 1000, 1001, 1002, 1003, 1004, 1005))
    assert collisions.near_duplicates(spark.createDataFrame([], VECTORS)).count() == 0


def test_collisions_of_scaled_copies(spark):
    """One direction in many lengths ties in every projection; the block is split, and no link is lost."""
    rng = np.random.default_rng(3)
    base = rng.standard_normal((3, 8))
    rows = [(k, (base[0] * (1 + k / 7)).tolist()) for k in range(300)] + [(300, base[1].tolist()), (301, base[2].tolist())]
    table = spark.createDataFrame(rows, VECTORS.split(",")[0] + ", embedding array<double>")
    found = {r["vec_id"]: r for r in collisions.near_duplicates(table, block_rows=20).collect()}
    assert all((found[k]["n_links"], found[k]["component_id"]) == (299, 0) for k in range(300))
    assert all((found[k]["n_links"], found[k]["component_id"], found[k]["kept"]) == (0, k, True) for k in (300, 301))


def test_ranks_of_a_large_block():
    q = np.linspace(0.0, 1.0, 70_000)[:, None]
    p = np.array([[0.5], [2.0]])
    for half, hits in ((1.0, 70_000), (0.25, int((np.abs(q - 0.5) <= 0.25).sum()))):
        found = [np.stack(x) for x in collisions.reaching(p[:1], q, half, 1)]
        assert sum(x.shape[1] for x in found) == hits
    assert sum(len(i) for i, _ in collisions.reaching(p[1:], q, 0.5, 1)) == 0


def test_components_of_a_chain(spark):
    edges = spark.createDataFrame([(i, i + 1) for i in range(40)] + [(100, 101)], "a long, b long")
    assert {r["id"]: r["component"] for r in components(edges, "a", "b").collect()} == {
        **dict.fromkeys(range(41), 0), 100: 100, 101: 100}


def brute_repeats(rows):
    """Sizes, removed bytes, runs and digest per row by comparing all 50-byte strings."""
    holders: dict[bytes, int] = {}
    for i, text in rows:
        data = (text or "").encode()
        for k in range(len(data) - 49 if i is not None else 0):
            holders[data[k:k + 50]] = min(i, holders.get(data[k:k + 50], i))
    for i, text in rows:
        data = (text or "").encode()
        gone = np.zeros(len(data) + 1, dtype=bool)
        for k in range(len(data) - 49 if i is not None else 0):
            if holders[data[k:k + 50]] < i:
                gone[k:k + 50] = True
        kept = bytes(b for b, g in zip(data, gone, strict=False) if not g)
        spans = int((np.diff(gone.astype(int), prepend=0) == 1).sum())
        yield (i, len(data), int(gone.sum()), spans, hashlib.sha256(kept).hexdigest())


def test_repeats(docs, odd, none):
    for df in (docs, odd):
        rows = repeats.drop_repeats(df).select(
            "doc_id", "cut.n_bytes", "cut.n_removed", "cut.n_spans", F.sha2("cut.kept", 256)).collect()
        expected = brute_repeats([(r["doc_id"], r["text"]) for r in df.collect()])
        assert Counter(map(tuple, rows)) == Counter(expected)
    assert repeats.drop_repeats(none).count() == 0


def brute_groups(df, floor=0.0, threshold=0.8):
    """Smallest id of the group of each text, by the similarity of all pairs that share a shingle."""
    rows = [(r["doc_id"], r["text"]) for r in df.collect()]
    words = near_documents.WordHashes()
    texts = {t: near_documents.shingles(t, words) for _, t in rows if t is not None}
    often = Counter(k for _, t in rows if t is not None for k in texts[t][0].tolist())
    weight = {k: 1 + np.log(1 / max(n / max(len(rows), 1), floor)) for k, n in often.items()}
    weighed = {t: (k, c * np.array([weight[x] for x in k.tolist()])) for t, (k, c) in texts.items()}
    names, parent = list(weighed), {t: t for t in weighed}

    def root(t):
        while parent[t] != t:
            t = parent[t]
        return t

    sharing = defaultdict(list)
    for t in names:
        for k in weighed[t][0].tolist():
            sharing[k].append(t)
    for a, b in {(x, y) for ts in sharing.values() for x in ts for y in ts if x < y}:
        if near_documents.jaccard(weighed[a], weighed[b]) >= threshold:
            parent[root(a)] = root(b)
    least = {}
    for i, t in rows:
        if t is not None and i is not None:
            least[root(t)] = min(i, least.get(root(t), i))
    return Counter((i, i if t is None else least.get(root(t))) for i, t in rows)


def test_near_documents(spark, docs, odd, none):
    text = " ".join(f"w{k}" for k in range(300))
    copies = [(100 + k, text.replace(f"w{7 * k} ", "changed "), "en", "a", 1, "s", 2, 3) for k in range(30)]
    for df in (docs, odd.unionByName(spark.createDataFrame(copies, SCHEMA))):
        rows = near_documents.near_duplicate_groups(df).collect()
        assert Counter((r["doc_id"], r["group_id"]) for r in rows) == brute_groups(df)
        kept = near_documents.without_near_duplicates(df)
        assert kept.columns == df.columns
        assert kept.count() == len({(r["group_id"],) for r in rows if r["group_id"] is not None}) + sum(
            r["group_id"] is None for r in rows)
    assert near_documents.near_duplicate_groups(none).count() == 0


def test_loose_copies_and_the_parity_bound(spark):
    """Copies of one text at all distances: groups as by brute force, and no similar pair is outside the bound."""
    rng = np.random.default_rng(5)
    rows = []
    for i in range(160):
        text = [f"w{k}" for k in range(150)]
        for k in rng.choice(150, int(rng.integers(0, 14)), replace=False):
            text[k] = f"x{rng.integers(1 << 30)}"
        rows.append((i, " ".join(text), "en", "a", 1, "s", 2, 3))
    df = spark.createDataFrame(rows, SCHEMA)
    found = near_documents.near_duplicate_groups(df).collect()
    assert Counter((r["doc_id"], r["group_id"]) for r in found) == brute_groups(df)
    weights, words = near_documents.Counted(160, 0.0), near_documents.WordHashes()
    distinct = near_documents.distinct_texts(df, "doc_id", "text")
    signed = near_documents.signed(distinct, weights).select("number", "held_by")
    numbered = df.join(distinct.select("number", "text").join(signed, "number").drop("number"), "text").select(
        F.col("doc_id").alias("number"), "text", "held_by")
    held_by = {r["number"]: bytes(r["held_by"]) for r in numbered.collect()}
    texts = [near_documents.shingles(r[1], words) for r in rows]
    weighed = [(k, weights.of(k, n, held_by[i])) for i, (k, n) in enumerate(texts)]
    totals = spark.createDataFrame([(i, float(w.sum())) for i, (_, w) in enumerate(weighed)], "number long, total double")
    sketches = near_documents.parities(numbered, weights).join(totals, "number")
    pairs = sketches.alias("x").join(sketches.alias("y"), F.col("x.number") < F.col("y.number")).where(
        near_documents.within_bound("x", "y", 0.8, weights.rare)).select(F.col("x.number"), F.col("y.number")).collect()
    near = {(i, j) for j in range(160) for i in range(j) if near_documents.jaccard(weighed[i], weighed[j]) >= 0.8}
    assert near <= set(map(tuple, pairs)) and len(pairs) < 160 * 159 / 4


def test_every_document_frequency_counts(spark, sf_dir, docs, odd):
    """Without a floor: as by brute force, and texts that share a rare template are not one document."""
    template = " ".join(f"t{k}" for k in range(93))
    texts = [f"{template} " + " ".join(f"u{i}x{k}" for k in range(11)) for i in range(5)]
    texts += [" ".join(f"f{i}x{k}" for k in range(6)) for i in range(495)]
    df = spark.createDataFrame([(i, t, "en", "a", 1, "s", 2, 3) for i, t in enumerate(texts)], SCHEMA)
    assert corpus_pipeline.one_of_each_group(spark, df, sf_dir).count() == 500
    for each in (df, odd):
        rows = near_documents.near_duplicate_groups(each, floor=0.0).collect()
        assert Counter((r["doc_id"], r["group_id"]) for r in rows) == brute_groups(each, floor=0)
    rows = QUERIES["op10_near_documents"](spark, sf_dir).collect()
    assert Counter((r["doc_id"], r["group_id"]) for r in rows) == brute_groups(docs, floor=0)


def test_distinct_keys_are_those_of_unique():
    """One sort gives what ``np.unique`` gives with counts, types included."""
    keys = np.random.default_rng(3).integers(0, 2**64, 400, dtype=np.uint64)
    for some in (keys[:0], keys[:1], np.repeat(keys[:1], 5), np.concatenate([keys, keys[100:300], keys[:7]])):
        for got, want in zip(near_documents.distinct_keys(some), np.unique(some, return_counts=True), strict=True):
            assert got.dtype == want.dtype and got.tolist() == want.tolist()


def test_document_counts_are_exact(docs):
    distinct = near_documents.distinct_texts(docs, "doc_id", "text")
    classes = near_documents.signed(distinct, near_documents.Counted(docs.count(), 0.0))
    words, counts, own = near_documents.WordHashes(), Counter(), {}
    for r in docs.collect():
        own[r["doc_id"]] = near_documents.shingles(r["text"], words)[0]
        counts.update(own[r["doc_id"]].tolist())
    for r in classes.collect():
        assert near_documents.unpacked(bytes(r["held_by"])).tolist() == [counts[k] for k in own[r["id"]].tolist()]


def test_kept_and_texts_without_a_word(spark, sf_dir):
    """Wordless texts in a chunk of their own or among others, and null texts, which are kept."""
    words = "a b c d e f g"
    for texts, kept in (([words, None, words, "", "...", None], [True, True, False, True, True, True]),
                        (["", "...", "..."], [True, True, False])):
        df = spark.createDataFrame([(i, t, "en", "a", 1, "s", 2, 3) for i, t in enumerate(texts)], SCHEMA)
        rows = near_documents.near_duplicate_groups(df).orderBy("doc_id").collect()
        assert [r["kept"] for r in rows] == kept


def test_pipeline_over_one_shared_line(spark, docs, tmp_path):
    """Documents that lose all their lines go on as empty texts, of which one stays."""
    line = "the same line of this and that in all of them and with the others"
    rows = docs.where("lang = 'en'").limit(40).unionByName(spark.createDataFrame(
        [(10**6 + k, line, "en", "src0", len(line)) for k in range(12)], docs.schema))
    rows.write.parquet(f"{tmp_path}/documents.parquet")
    found = corpus_pipeline.run(spark, str(tmp_path)).collect()
    assert sum(r["doc_id"] >= 10**6 and r["n_pieces"] > 0 for r in found) == 0


@pytest.fixture(scope="module")
def vocabulary():
    return pieces.read_vocabulary(VOCABULARY)


def test_pieces_find_the_best_score(vocabulary, docs):
    model = sentencepiece.SentencePieceProcessor(model_file=VOCABULARY)
    scores = {p: s for p, _, s in vocabulary.pieces}
    segmenter = pieces.Segmenter(vocabulary)
    words = {w for r in docs.limit(20).collect() for w in r["text"].split()}
    for word in list(words)[:300]:
        marked, best = "▁" + word, [0.0]
        for end in range(1, len(marked) + 1):
            best.append(max((best[a] + scores[marked[a:end]] for a in range(end) if marked[a:end] in scores), default=-1e18))
        ids = segmenter.encode(word)
        assert list(segmenter.best(marked)) == ids
        if best[-1] > -1e17:
            assert sum(model.get_score(i) for i in ids) == best[-1]


def test_pieces_round_trip(spark, odd, none, docs, vocabulary):
    for df in (odd, docs):
        ids = df.select("text", pieces.encoded(spark, F.col("text"), vocabulary).alias("ids"))
        rows = ids.select("text", "ids", pieces.decoded(spark, F.col("ids"), vocabulary).alias("back")).collect()
        for r in rows:
            assert r["back"] == (None if r["text"] is None else r["text"].replace("▁", " "))
            assert (r["ids"] == []) == (r["text"] == "")
    assert none.select(pieces.encoded(spark, F.col("text"), vocabulary)).count() == 0


def test_pieces_there_and_back(spark, odd, none, docs, vocabulary):
    for df in (odd, docs):
        apart = df.select("doc_id", "text", pieces.encoded(spark, F.col("text"), vocabulary).alias("ids")).select(
            "doc_id", "ids", pieces.decoded(spark, F.col("ids"), vocabulary))
        found = df.select("doc_id", pieces.round_trip(spark, F.col("text"), vocabulary).alias("found"))
        assert sorted(map(repr, map(tuple, found.select("doc_id", "found.*").collect()))) == sorted(
            map(repr, map(tuple, apart.collect())))
    assert none.select(pieces.round_trip(spark, F.col("text"), vocabulary)).count() == 0


def test_texts_are_encoded_once(spark, sf_dir, docs):
    """A worker that also calls the encoder inside the decoder holds its tables and the results of a batch twice."""
    for df in (QUERIES["op2_sentencepiece"](spark, sf_dir), corpus_pipeline.encoded(spark, docs, sf_dir)):
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert set(re.findall(r"pythonUDF\d+", plan)) == {"pythonUDF0"}


def test_pieces_of_a_batch_come_in_runs(vocabulary, monkeypatch):
    monkeypatch.setattr(pieces, "BATCH_CHARS", 40)
    texts = ["some words", None, "", "x" * 100, "and other words, and more", "ü ▁ 語", None] * 3
    runs = list(pieces.encode_lists(vocabulary, iter([pa.array(texts), pa.array([], pa.string()), pa.array(texts[:2])])))
    segmenter = pieces.Segmenter(vocabulary)
    assert len(runs) > 6 and max(map(len, runs)) < len(texts)
    assert [ids for run in runs for ids in run.to_pylist()] == [
        None if text is None else segmenter.encode(text) for text in texts + texts[:2]]


def test_pipeline_stages(spark, sf_dir, docs):
    stage = dict(corpus_pipeline.STAGES)
    assert len(stage) == 5
    found = stage["language"](spark, docs, sf_dir)
    assert found.columns == docs.columns and found.count() >= 0.99 * docs.count()
    lines = stage["lines"](spark, docs, sf_dir)
    assert lines.columns == docs.columns and lines.count() == docs.count()
    last = stage["pieces"](spark, docs, sf_dir)
    assert last.where("NOT round_trip").count() == 0


def test_pipeline_small_batches(spark, sf_dir, none):
    """Ten thousand whole texts to a batch would leave the Python workers that all stages share as large as such a batch."""
    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    texts = spark.range(0, 200, 1, 1).select(F.repeat(F.lit("word "), 10_000).alias("text"))

    def sizes():
        found = mapped(texts, lambda b: [pa.record_batch([pa.array([b.num_rows]), pa.array([b.nbytes])], ["rows", "bytes"])],
                              "rows bigint, bytes bigint").collect()
        assert sum(r["rows"] for r in found) == 200
        return [r["bytes"] for r in found]

    try:
        for _, stage in corpus_pipeline.STAGES:
            spark.conf.unset(key)
            stage(spark, none, sf_dir)
            assert max(sizes()) < 3_000_000
        spark.conf.set(key, "500k")
        stage(spark, none, sf_dir)
        assert max(sizes()) < 600_000  # the caller's size stays
    finally:
        spark.conf.unset(key)
