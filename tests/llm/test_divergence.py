"""Source divergence: the transducer against sorted lists, and all results against plain counting."""

from __future__ import annotations

import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest

from deskstar.llm import divergence
from deskstar.llm.divergence import Lookup, Transducer

SCHEMA = "doc_id long, text string, lang string, source string, Value string, rank int, shard int, part string"


@pytest.mark.parametrize("words", [
    [], [""], ["a"], ["", "a", "ab", "b"], ["tap", "taps", "top", "tops"], ["ä", "äh", "öl", "über", "z"]])
def test_small_transducers(words):
    check([w.encode() for w in sorted(words, key=str.encode)])


def check(words):
    made = Transducer.load(Transducer.build(words).dump())
    assert made.size == len(words)
    assert made.places(words).tolist() == list(range(len(words)))
    assert [made.spelled(k) for k in range(len(words))] == words
    absent = [w + b"x" for w in words] + [w[:-1] for w in words] + [b"", b"\xff", b"zzzz"]
    place = {w: k for k, w in enumerate(words)}
    assert made.places(absent).tolist() == [place.get(w, -1) for w in absent]
    # Minimal: as many nodes as there are different sets of continuations.
    ends = defaultdict(set)
    for w in words:
        for k in range(len(w) + 1):
            ends[w[:k]].add(w[k:])
    assert len(made.final) == max(1, len(set(map(frozenset, ends.values()))))


def test_random_transducers():
    draw = random.Random(4)
    for size in (10, 100, 3000):
        check(sorted({"".join(draw.choices("abcé", k=draw.randint(1, 8))).encode() for _ in range(size)}))


def test_lookup_over_shards():
    words = [f"w{k:03}".encode() for k in range(100)]
    shards = [("en", k, part[0], part[-1], len(part), Transducer.build(part).dump())
              for k, part in enumerate(words[a:a + 30] for a in range(0, 100, 30)) if k != 1]
    found = Lookup(shards).codes("en", [*words, b"a", b"w000x", b"z"])
    assert found == {w: (k // 30) << 32 | k % 30 for k, w in enumerate(words) if not 30 <= k < 60}


def brute(rows, min_docs=10, top=10):
    pattern = re.compile(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+")
    lower = {c: c + 32 for c in range(65, 91)}
    docs = [(lang or "", source or "", [t.translate(lower) for t in pattern.findall(text or "")]) for lang, source, text in rows]
    holders = Counter((lang, t) for lang, _, words in docs for t in set(words))
    out = []
    for lang in {d[0] for d in docs}:
        kept = sorted((t for (g, t), n in holders.items() if g == lang and n >= min_docs), key=str.encode)
        counts = {s: Counter() for g, s, _ in docs if g == lang}
        for g, s, words in docs:
            if g == lang:
                counts[s].update(w for w in words if holders[lang, w] >= min_docs)

        def share(own):
            n = sum(own.values())
            return {t: 1 + 10**9 * (own[t] + 2) // (n + 2 * len(kept)) for t in kept}

        p = {s: share(c) for s, c in counts.items()}
        q = share(sum(counts.values(), Counter()))
        for s in counts:
            pairs = [(sum((p[s][t] - p[o][t])**2 // (p[s][t] + p[o][t]) for t in kept), o) for o in counts if o != s]
            own = [((p[s][t] - q[t])**2 // (p[s][t] + q[t]), t) for t in kept if counts[s][t] and p[s][t] > q[t]]
            for part, found in (("pair", pairs), ("term", own)):
                found.sort(key=lambda r: (-r[0], r[1].encode()))
                found = found if part == "pair" else found[:top]
                out += [(lang, s, part, item, value, k + 1) for k, (value, item) in enumerate(found)]
    return Counter(out)


@pytest.fixture(scope="module")
def rows():
    draw = random.Random(9)
    words = ["".join(draw.choices("abÄé", k=draw.randint(1, 3))) for _ in range(60)]
    made = [(draw.choice(["en", "de", None]), draw.choice(["a", "ä", "Z", None, "only en"]),
             " ".join(draw.choices(words, k=draw.randint(0, 30)))) for _ in range(400)]
    made = [(g, s, t) for g, s, t in made if s != "only en" or g == "en"]
    return [*made, *made[:20], ("en", "a", None), ("en", "quiet", ""), ("en", "quiet", "12 34"), ("fr", "x", "rare words"),
            ("fr", "y", None), ("xx", "alone", "lone " * 12), ("en", "a", "ab" * 100_000 + " " + "ab,ba " * 50_000)]


@pytest.mark.parametrize("sizes", [{}, {"terms_per_shard": 7, "index_bytes": 400}])
def test_matches_plain_counting(spark, rows, sizes, monkeypatch):
    """With odd rows and clashing columns; in one shard, and in many with several passes."""
    if sizes:
        monkeypatch.setattr(divergence, "CELLS", 20)
        monkeypatch.setattr(divergence, "HELD", 50)
        monkeypatch.setattr(divergence, "PIECE", 1000)
    df = spark.createDataFrame([(i, t, g, s, "x", 1, 2, "y") for i, (g, s, t) in enumerate(rows)], SCHEMA).repartition(3)
    found = divergence.divergences(df, **sizes)
    assert found.columns == ["lang", "source", "part", "item", "value", "rank"]
    assert Counter(map(tuple, found.collect())) == brute(rows)


def test_empty_table(spark):
    assert divergence.divergences(spark.createDataFrame([], SCHEMA)).count() == 0


def test_shares_are_exact():
    counts, total, kept = np.array([0, 1, 7, 10**14]), 10**15, 10**9
    expected = [1 + 10**9 * (c + 2) // (total + 2 * kept) for c in counts.tolist()]
    assert divergence.shares(counts, total, kept).tolist() == expected
    assert divergence.shares(counts[:3], 100, 5).tolist() == [1 + 10**9 * (c + 2) // 110 for c in (0, 1, 7)]
