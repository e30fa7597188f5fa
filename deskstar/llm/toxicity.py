"""Toxicity by a learned lexicon whose misspellings Levenshtein automata find, with windows that tell quotation from abuse.

1. **Lexicon.** Words, and beginnings of words, that are far more frequent in labelled toxic documents than in clean ones.
   A term is whole, or open: any word that begins with it counts.
2. **Misspellings.** The lexicon is one trie. A word's Levenshtein automaton runs down the trie with all branches: its state
   is one bit vector per number of edits, so a branch is left as soon as no bit is set. How many edits a term
   tolerates follows from its length, and is lowered until clean documents hardly ever have such a form.
3. **Windows.** The words around a hit decide how far it is quoted: quotation marks around it and words of reporting speak
   for quotation, address in the second person and further hits against it.
4. **Score.** A logistic model of four sums: exact and misspelled hits, each split by its share of quotation. It is fitted to
   the sample around a prior that gives quoted hits little weight, so labels overrule the prior where they show more.

The model is fitted on a bounded sample, about ``docs_per_label`` documents of each label; every document is scored whole.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from deskstar.llm.common import mapped, mix64, staged

TOKEN = re.compile(r"\w+(?:[@$*]\w+)*")
PIECE = 1 << 20
REMEMBERED = 500_000
LEAST_PREFIX = 3
PRINTS = 8
LONGEST_TERM = 48  # so that a word cut behind the longest term still fits a vector of 64 bits
RESULT = "struct<score: double, hits: array<struct<start: int, end: int, term: string, edits: int, quoted: double>>>"

# Signs of quotation and of address.
OPENING, CLOSING = "“„«‹‘‚", "”“»›’‘"
REPORTING = frozenset("said says say wrote writes called calls calling quoted quotes quote term word words slur insult "
                      "sagte sagt schrieb nannte nennt zitat zitiert wort begriff beleidigung dit disait écrit appelé mot "
                      "terme insulte citation dijo dice escribió llamó palabra término insulto cita".split())
ADDRESS = frozenset("you your youre u ur du dich dir dein deine ihr euch tu te toi ton vous votre tú usted eres".split())

WINDOW = 8  # words on either side
REACH = 200  # characters in which quotation marks count
# Prior of the score: weights of exact and misspelled hits, in plain use and quoted, and how firmly it is held.
PRIOR = (4.0, 2.0, 0.5, 0.25)
FIRMNESS = 0.05


def edits_allowed(length: int) -> int:
    return 0 if length < 5 else 1 if length < 9 else 2


@dataclass
class Term:
    text: str
    open: bool = False
    edits: int = 0


@dataclass
class Trie:
    """Nodes by number: letters to children, and the terms that end there."""

    terms: list[Term]
    children: list[dict[str, int]] = field(default_factory=lambda: [{}])
    ends: list[list[int]] = field(default_factory=lambda: [[]])

    def __post_init__(self) -> None:
        for number, term in enumerate(self.terms):
            node = 0
            for letter in term.text:
                if letter not in self.children[node]:
                    self.children[node][letter] = len(self.children)
                    self.children.append({})
                    self.ends.append([])
                node = self.children[node][letter]
            self.ends[node].append(number)
        self.edits = max((t.edits for t in self.terms), default=0)
        self.letters = sorted({letter for node in self.children for letter in node})


def step(states: list, mask, limit, most: int) -> list:
    """States of the automata after a letter: bit i of state e says that i letters of the word are read with e edits."""
    after = [(states[0] & mask) << 1]
    for e in range(1, most + 1):
        before = states[e - 1]
        after.append((((states[e] & mask) << 1) | before | (before << 1) | (after[e - 1] << 1)) & limit)
    return after


def intersected(trie: Trie, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """The term that each word matches with fewest edits (the first of equals, -1 for none), and the edits.

    The trie is walked once for all words; at each node only words whose automaton is still alive go on.
    """
    most = trie.edits
    size = np.array([len(w) for w in words], dtype=np.uint64)
    table = np.array(words, dtype=f"U{int(size.max(initial=1))}")
    codes = table.view(np.uint32).reshape(len(words), -1)
    powers = np.uint64(1) << np.arange(codes.shape[1], dtype=np.uint64)
    masks = {letter: (codes == ord(letter)) @ powers for letter in trie.letters}
    one = np.uint64(1)
    limit = (one << (size + one)) - one
    term, edits = np.full(len(words), -1), np.full(len(words), most + 1)

    def settle(node: int, alive: np.ndarray, states: list[np.ndarray]) -> None:
        for number in trie.ends[node]:
            t = trie.terms[number]
            for e in range(t.edits + 1):
                ended = states[e] != 0 if t.open else (states[e] >> size[alive]) & one != 0
                better = ended & ((edits[alive] > e) | (edits[alive] == e) & (term[alive] > number))
                term[alive[better]], edits[alive[better]] = number, e

    everything = np.arange(len(words))
    start = [np.full(len(words), (1 << (e + 1)) - 1, dtype=np.uint64) & limit for e in range(most + 1)]
    stack = [(0, everything, start)]
    while stack:
        node, alive, states = stack.pop()
        settle(node, alive, states)
        for letter, child in trie.children[node].items():
            after = step(states, masks[letter][alive], limit[alive], most)
            go = after[0] != 0
            for state in after[1:]:
                go |= state != 0
            if go.any():
                stack.append((child, alive[go], [state[go] for state in after]))
    return term, edits


class Matcher:
    """Terms of words, remembered up to a bound."""

    def __init__(self, terms: list[Term]):
        self.trie = Trie(terms)
        self.clean: set[str] = set()
        self.bad: dict[str, tuple[int, int]] = {}

    def learn(self, words: set[str]) -> None:
        fresh = words - self.clean - self.bad.keys()
        if not fresh or not self.trie.terms:
            return
        if len(self.clean) > REMEMBERED:
            self.clean.clear()
        # A longer word can only match an open term, which its beginning decides, or a term as long as itself.
        longest = max(len(t.text) for t in self.trie.terms) + self.trie.edits + 1
        by_width: dict[int, list[str]] = {}
        for word in fresh:
            by_width.setdefault((min(len(word), longest) + 7) // 8, []).append(word)
        for group in by_width.values():
            term, edits = intersected(self.trie, [w[:longest] for w in group])
            hit = term >= 0
            for k in np.flatnonzero(hit).tolist():
                self.bad[group[k]] = int(term[k]), int(edits[k])
            self.clean.update(w for w, h in zip(group, hit.tolist(), strict=True) if not h)


def pieces(text: str) -> Iterator[str]:
    """The text in parts that end at a blank."""
    at = 0
    while at < len(text):
        end = text.find(" ", at + PIECE)
        end = len(text) if end < 0 else end
        yield text[at:end]
        at = end


def distinct_words(text: str) -> set[str]:
    found: set[str] = set()
    for part in pieces(text):
        found.update(TOKEN.findall(part))
    return found


def quotation(left: str, right: str, near: list[str], others: int) -> float:
    """How far a hit is quoted, from 0 to 1, by its line on both sides and the words near it."""
    left, right = left.rsplit("\n", 1)[-1], right.split("\n", 1)[0]
    opened = max((left.rfind(c) for c in OPENING), default=-1)
    closed = max((left.rfind(c) for c in CLOSING if c not in OPENING), default=-1)
    marked = (opened > closed and any(c in right for c in CLOSING)) or (left.count('"') % 2 == 1 and '"' in right)
    share = 0.6 * marked + 0.3 * (not REPORTING.isdisjoint(near))
    share -= 0.2 * (not ADDRESS.isdisjoint(near)) + 0.1 * min(others, 2)
    return min(max(share, 0.0), 1.0)


def hits(text: str, matcher: Matcher) -> list[tuple[int, int, int, int, float]]:
    """Start, end, term, edits and share of quotation of each hit in a lower-case text."""
    found, offset = [], 0
    for part in pieces(text):
        spans = [(m.start(), m.end()) for m in TOKEN.finditer(part)]
        bad = [k for k, (a, b) in enumerate(spans) if part[a:b] in matcher.bad]
        for place, k in enumerate(bad):
            a, b = spans[k]
            low, high = max(0, k - WINDOW), min(len(spans), k + WINDOW + 1)
            left, right = part[max(0, a - REACH):a], part[b:b + REACH]
            near = [part[x:y] for x, y in spans[low:high]]
            others = sum(low <= j < high for j in bad[max(0, place - WINDOW):place + WINDOW + 1]) - 1
            found.append((offset + a, offset + b, *matcher.bad[part[a:b]], quotation(left, right, near, others)))
        offset += len(part)
    return found


def all_hits(texts: Iterable[str | None], matcher: Matcher) -> Iterator[list[tuple[int, int, int, int, float]]]:
    """Hits of each text in lower case; the words of many texts run through the trie together."""
    def settle() -> Iterator[list[tuple[int, int, int, int, float]]]:
        matcher.learn(set().union(*(words for _, words in waiting)))
        for text, words in waiting:
            yield hits(text, matcher) if not words.isdisjoint(matcher.bad) else []

    waiting, held = [], 0
    for text in texts:
        low = (text or "").lower()
        waiting.append((low, distinct_words(low)))
        held += len(low)
        if held >= PIECE:
            yield from settle()
            waiting, held = [], 0
    yield from settle()


def features(found: list[tuple[int, int, int, int, float]]) -> list[float]:
    """Logarithms of the sums of exact and misspelled hits, in plain use, then quoted."""
    sums = [0.0] * 4
    for _, _, _, edits, quoted in found:
        kind = 1 if edits else 0
        sums[kind] += 1.0 - quoted
        sums[kind + 2] += quoted
    return [math.log1p(s) for s in sums]


@dataclass
class Model:
    """Terms, and the score's constant and weights."""

    terms: list[Term]
    constant: float
    weights: tuple[float, ...]

    def score(self, found: list[tuple[int, int, int, int, float]]) -> float:
        z = self.constant + sum(w * f for w, f in zip(self.weights, features(found), strict=True))
        return 1.0 / (1.0 + math.exp(-max(min(z, 500.0), -500.0)))


def held_out(doc_id: Column) -> Column:
    """Whether crc32 of the id as text leaves 1 modulo 3; a null id is not held out."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 3 == 1, F.lit(False))


def fingerprints(text: str) -> np.ndarray:
    """For each of ``PRINTS`` orders the least hash of five words in a row; near copies share some of them."""
    words = TOKEN.findall(text)
    parts = (xxhash.xxh3_64_intdigest(" ".join(words[k:k + 5])) for k in range(max(1, len(words) - 4)))
    keys = np.fromiter(parts, np.uint64, max(1, len(words) - 4))
    return np.array([mix64(keys ^ np.uint64(slot)).min() >> np.uint64(1) for slot in range(PRINTS)], dtype=np.int64)


def sampled(docs: DataFrame, labels: DataFrame, doc_id: str, text: str, label: str, docs_per_label: int) -> DataFrame:
    """Labelled texts to learn from: toxic, share (of its label's ids), text in lower case.

    Of each label, a text goes that shares a fingerprint with one of smaller id, so copies do not make words look telling.

    About ``docs_per_label`` ids of each label, drawn by a hash of the id. Held-out and null ids, null labels and
    null texts teach nothing; an id with several labels takes the greatest.
    """
    known = labels.select(F.col(doc_id).alias("id"), (F.col(label) > 0).cast("int").alias("toxic"))
    known = known.where(F.col("id").isNotNull() & F.col("toxic").isNotNull() & ~held_out(F.col("id")))
    known = known.groupBy("id").agg(F.max("toxic").alias("toxic"))
    share = known.groupBy("toxic").agg((F.lit(float(docs_per_label)) / F.count("*")).alias("share"))
    draw = F.shiftrightunsigned(F.xxhash64(F.lit(13), F.col("id").cast("string")), 11) / F.lit(float(1 << 53))
    # Two rows, and then at most some docs_per_label ids for each of them.
    drawn = known.join(F.broadcast(share), "toxic").where(draw < F.col("share")).select("id", "toxic", "share")
    rows = docs.select(F.col(doc_id).alias("id"), F.col(text).alias("text")).where("text IS NOT NULL")
    rows = rows.join(F.broadcast(drawn), "id").select("id", "toxic", F.least("share", F.lit(1.0)).alias("share"), "text")

    def sign(batch: pa.RecordBatch) -> Iterable[pa.RecordBatch]:
        low = [t.lower() for t in batch.column(3).to_pylist()]
        yield pa.record_batch([*batch.columns[:3], pa.array(low, pa.string()), pa.array(map(fingerprints, low))],
                              ["id", "toxic", "share", "text", "prints"])

    kind = dict(rows.dtypes)["id"]
    signed = mapped(rows, sign, f"id {kind}, toxic int, share double, text string, prints array<bigint>")
    one = staged(signed.groupBy("toxic", F.col("prints")[0].alias("print")).agg(
        F.min(F.struct("id", "share", "text", "prints")).alias("r")).select("toxic", "r.*"), "signed")
    own = one.select("toxic", "id", F.posexplode("prints").alias("slot", "print"))
    first = own.groupBy("toxic", "slot", "print").agg(F.min("id").alias("first"))
    later = own.join(first, ["toxic", "slot", "print"]).where(F.col("first") < F.col("id")).select("toxic", "id").distinct()
    return staged(one.join(later, ["toxic", "id"], "left_anti").select("toxic", "share", "text"), "labelled")


def candidate_terms(sample: DataFrame, toxic: int, clean: int, min_share: float) -> list[Term]:
    """Words and beginnings of words that mark toxic documents beyond chance.

    With t of n holders toxic where r of all are, n KL(t / n || r) must exceed the logarithm of the number of keys looked
    at; besides, a term is in ``min_share`` of the toxic documents and in fewer than a fiftieth as many of the clean ones.
    So at most a bounded number of keys per document of the sample reaches the driver.
    """
    def count(batch: pa.RecordBatch) -> Iterable[pa.RecordBatch]:
        held: dict[tuple[str, bool], list[int]] = {}
        for bad, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
            words = distinct_words(text.as_py())
            keys = {(w, False) for w in words}
            keys.update((w[:k], True) for w in words for k in range(LEAST_PREFIX, min(len(w), 16) + 1))
            for key in keys:
                held.setdefault(key, [0, 0])[bad] += 1
        yield pa.record_batch([pa.array([k[0] for k in held], pa.string()), pa.array([k[1] for k in held], pa.bool_()),
                               pa.array([v[1] for v in held.values()], pa.int64()),
                               pa.array([v[0] for v in held.values()], pa.int64())], ["key", "open", "t", "c"])

    counts = mapped(sample.select("toxic", "text"), count, "key string, open boolean, t bigint, c bigint")
    counts = staged(counts.groupBy("key", "open").agg(F.sum("t").alias("t"), F.sum("c").alias("c")), "keys")
    r, t, c = toxic / (toxic + clean), F.col("t"), F.col("c")
    gain = t * F.log(t / (t + c) / r) + F.when(c > 0, c * F.log(c / (t + c) / (1 - r))).otherwise(0.0)
    marked = counts.where((t >= max(2, min_share * toxic)) & (c * 50 * toxic <= t * clean)
                          & F.length("key").between(LEAST_PREFIX, LONGEST_TERM)
                          & (gain > math.log(max(counts.count(), 2)))).collect()
    keys = {(row["key"], row["open"]): row["t"] for row in marked}
    chosen: list[Term] = []
    for (key, _), n in sorted(keys.items(), key=lambda x: (-x[1], -len(x[0][0]), x[0])):
        # The longest continuation that stands for nearly the same documents says most.
        same = [k for k, m in keys.items() if k[0].startswith(key) and m >= 0.95 * n]
        text, is_open = max(same, key=lambda k: (len(k[0]), not k[1], keys[k], k[0]))
        if not any(text.startswith(t.text) if t.open else text == t.text for t in chosen) and not any(
                t.text.startswith(text) for t in chosen if is_open):
            chosen.append(Term(text, is_open, edits_allowed(len(text))))
    return sorted(chosen, key=lambda t: (t.text, t.open))


def calibrated(sample: DataFrame, terms: list[Term], clean: int, stray: float) -> list[Term]:
    """Terms with the most edits at which at most a share ``stray`` of the clean documents has such a form."""
    matcher = Matcher(terms)

    def forms(batch: pa.RecordBatch) -> Iterable[pa.RecordBatch]:
        found: dict[tuple[int, int], int] = {}
        for each in all_hits((value.as_py() for value in batch.column(0)), matcher):
            for key in {h[2:4] for h in each}:
                found[key] = found.get(key, 0) + 1
        yield pa.record_batch([pa.array([k[0] for k in found], pa.int32()), pa.array([k[1] for k in found], pa.int32()),
                               pa.array(found.values(), pa.int64())], ["term", "edits", "n"])

    rows = mapped(sample.where("toxic = 0").select("text"), forms, "term int, edits int, n bigint").groupBy(
        "term", "edits").agg(F.sum("n").alias("n")).where(F.col("edits") > 0).collect()
    held = {(row["term"], row["edits"]): row["n"] for row in rows}
    out = []
    for number, term in enumerate(terms):
        edits = 0
        while edits < term.edits and held.get((number, edits + 1), 0) <= stray * clean:
            edits += 1
        out.append(Term(term.text, term.open, edits))
    return out


def fitted(x: np.ndarray, y: np.ndarray, weight: np.ndarray) -> tuple[float, tuple[float, ...]]:
    """Logistic regression by Newton steps, with weights held near the prior."""
    design = np.hstack([np.ones((len(x), 1)), x])
    prior = np.array([0.0, *PRIOR])
    firm = np.array([1e-3, *[FIRMNESS] * len(PRIOR)])
    beta = prior.copy()

    def loss(b: np.ndarray) -> float:
        z = design @ b
        return float((weight * (np.logaddexp(0, z) - y * z)).sum() + (firm * (b - prior) ** 2).sum() / 2)

    for _ in range(100):
        p = 1 / (1 + np.exp(-np.clip(design @ beta, -500, 500)))
        gradient = design.T @ (weight * (p - y)) + firm * (beta - prior)
        curve = (design * (weight * p * (1 - p))[:, None]).T @ design + np.diag(firm)
        move, size = np.linalg.solve(curve, gradient), 1.0
        while size > 1e-6 and loss(beta - size * move) > loss(beta):
            size /= 2
        beta = beta - size * move
        if np.abs(size * move).max() < 1e-9:
            break
    return float(beta[0]), tuple(beta[1:].tolist())


def learn(docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text", label: str = "toxic",
          docs_per_label: int = 5000, min_share: float = 0.005, stray: float = 0.0005) -> Model:
    """The model of the labelled documents, see ``sampled``; without both labels it has no terms and scores by their share.

    Only terms and four numbers for each document of the bounded sample reach the driver.
    """
    sample = sampled(docs, labels, doc_id, text, label, docs_per_label)
    n = {row["toxic"]: row["n"] for row in sample.groupBy("toxic").agg(F.count("*").alias("n")).collect()}
    toxic, clean = n.get(1, 0), n.get(0, 0)
    if not toxic or not clean:
        return Model([], math.log((toxic + 0.5) / (clean + 0.5)), PRIOR)
    terms = calibrated(sample, candidate_terms(sample, toxic, clean, min_share), clean, stray)
    matcher = Matcher(terms)

    def describe(batch: pa.RecordBatch) -> Iterable[pa.RecordBatch]:
        rows = [features(found) for found in all_hits((value.as_py() for value in batch.column(2)), matcher)]
        yield pa.record_batch([*batch.columns[:2], pa.array(rows, pa.list_(pa.float64()))], ["toxic", "share", "x"])

    rows = mapped(sample, describe, "toxic int, share double, x array<double>").orderBy("toxic", "share", "x").collect()
    y = np.array([row["toxic"] for row in rows], dtype=np.float64)
    weight = 1 / np.array([row["share"] for row in rows])
    constant, weights = fitted(np.array([row["x"] for row in rows]), y, weight / weight.mean())
    return Model(terms, constant, weights)


def scored(text: Column, model: Model) -> Column:
    """Struct score (0 to 1) and hits of each whole text, however long.

    A hit has its start and end in the lower-case text in characters, its term, edits and share of quotation. Null and
    empty texts have no hits and the score of a text without any.
    """
    matcher = Matcher(model.terms)

    def judge(texts: pa.Array) -> pa.Array:
        found = list(all_hits((value.as_py() for value in texts), matcher))
        flat = [h for each in found for h in each]
        columns = [pa.array([h[k] for h in flat], t) for k, t in ((0, pa.int32()), (1, pa.int32()))]
        columns += [pa.array([model.terms[h[2]].text for h in flat], pa.string()),
                    pa.array([h[3] for h in flat], pa.int32()), pa.array([h[4] for h in flat], pa.float64())]
        each = pa.StructArray.from_arrays(columns, names=["start", "end", "term", "edits", "quoted"])
        ends = np.cumsum([0, *map(len, found)]).astype(np.int32)
        return pa.StructArray.from_arrays([pa.array([model.score(f) for f in found], pa.float64()),
                                           pa.ListArray.from_arrays(pa.array(ends), each)], names=["score", "hits"])

    # Arrow functions are told apart by type hints, which must be classes here.
    judge.__annotations__ = {"texts": pa.Array, "return": pa.Array}
    return F.arrow_udf(judge, RESULT)(text)
