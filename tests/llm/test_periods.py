"""Periodic runs against a scan of every lag."""

from __future__ import annotations

import hashlib
import re
import zlib

import numpy as np
import pytest

from deskstar.llm import periods
from deskstar.llm.queries import QUERIES

SCHEMA = "doc_id long, text string, Periodic int, found_runs string, runs int"


def brute_runs(words):
    """Start, length and period of all runs by comparing words at every lag."""
    best = {}
    for q in range(1, len(words) // 4 + 1):
        start = 0
        while start + q < len(words):
            end = start
            while end + q < len(words) and words[end] == words[end + q]:
                end += 1
            if end > start and end + q - start >= max(6, 4 * q):
                best.setdefault((start, end + q - start), q)
            start = end + 1
    return sorted((s, n, q) for (s, n), q in best.items())


def collapsed(words, runs):
    gone = {i for s, n, q in runs for i in range(s + q, s + n)}
    return [w for i, w in enumerate(words) if i not in gone]


def made_texts():
    rng = np.random.default_rng(3)
    for size in (0, 1, 5, 6, 7, 40, 300):
        for letters in (1, 2, 3, 50):
            yield [f"w{k}" for k in rng.integers(0, letters, size)]
    for period in (1, 2, 7, 8, 9, 15, 16, 17, 31, 32, 33, 64, 100):
        for length in (4 * period - 1, 4 * period, 4 * period + 1, 9 * period + 3):
            unit = [f"u{k}" for k in rng.integers(0, max(2, period // 3), period)]
            before, after = ([f"x{k}" for k in rng.integers(0, 40, int(rng.integers(0, 50)))] for _ in range(2))
            yield before + [unit[k % period] for k in range(length)] + after
    # A run in the period of a run, and two runs that overlap.
    inner = ["a"] * 9 + [f"b{k}" for k in range(20)]
    yield inner * 5
    yield [f"c{k % 11}" for k in range(60)] + [f"c{k % 10}" for k in range(60)]


@pytest.fixture(scope="module")
def texts():
    return [" ".join(words) for words in made_texts()]


def test_runs_match_a_scan_of_all_lags(texts):
    sizes, found, dropped, kept = periods.examined([*texts, None])
    for text, n, rows, lost, rest in zip([*texts, ""], sizes, found, dropped, kept, strict=True):
        words = text.split()
        expected = brute_runs(words)
        assert n == len(words) and [tuple(r) for r in rows.tolist()] == expected
        assert rest.split(" ") == (collapsed(words, expected) or [""]) and lost == n - len(rest.split())


def test_pieces_of_a_long_text(monkeypatch):
    text = "ünd  so\tweiter " * 1000
    monkeypatch.setattr(periods, "PIECE", 64)
    assert sum(periods.words_of(text), []) == text.split()
    _, found, _, kept = periods.examined([text])
    assert found[0].tolist() == [[0, 3000, 3]] and kept == ["ünd so weiter"]


def test_odd_rows(spark, texts):
    long = "one two three four five six seven eight nine " * 20_000
    rows = [(None, "a " * 10), (1, None), (2, ""), (3, " \n\t "), (4, long), (4, long), (5, "x y " * 8), (6, "b b b b b")]
    df = spark.createDataFrame([(*r, 1, "s", 2) for r in rows], SCHEMA).repartition(3)
    found = periods.periodic_runs(df)
    assert found.columns == ["doc_id", "text", "found_runs", "runs", "periodic"]
    got = {r["doc_id"]: r["periodic"] for r in found.collect()}
    assert [tuple(r) for r in got[None]["runs"]] == [(0, 10, 1)] and got[None]["text"] == "a"
    assert all(got[k]["n_words"] == 0 and got[k]["runs"] == [] and got[k]["text"] == "" for k in (1, 2, 3))
    assert [tuple(r) for r in got[4]["runs"]] == [(0, 180_000, 9)] and got[4]["n_dropped"] == 180_000 - 9
    assert [tuple(r) for r in got[5]["runs"]] == [(0, 8, 1)] and got[6]["runs"] == []
    assert found.count() == len(rows) and periods.periodic_runs(df.limit(0)).count() == 0


def test_query_matches_brute_force(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()
    found = {r["doc_id"]: tuple(r)[1:] for r in QUERIES["op13_periodic_runs"](spark, sf_dir).collect()}
    assert len(found) == len(docs)
    with_runs = 0
    for i, text in docs:
        words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
        h, n = zlib.crc32(str(i).encode()), len(words)
        if h % 10 == 0 and n:
            g = h // 10
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            words = [words[k] if k < a else words[a + (k - a) % p] for k in range(n)]
        runs = brute_runs(words)
        with_runs += bool(runs)
        top = min(runs, key=lambda r: (-r[1], r[0], r[2]), default=None)
        first = (len(runs), *((*top, 1000 * top[1] // top[2]) if top else (None,) * 4))
        digests = (hashlib.sha256("".join(f"{s},{m},{q}\n" for s, m, q in runs).encode()).hexdigest(),
                   hashlib.sha256(" ".join(collapsed(words, runs)).encode()).hexdigest())
        assert found[i] == (*first, *digests), i
    assert with_runs > 5
