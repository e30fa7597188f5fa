"""How the sources of a language differ in their words: divergences of term shares, recounted by a transducer vocabulary.

1. Every language keeps the terms of at least ``min_docs`` of its documents; Spark sorts them by language and UTF-8 bytes and
   numbers them. A term's ordinal is its place among its language's terms.
2. Terms are cut into shards of following ordinals. A shard becomes a minimal acyclic transducer, built in one pass over the
   sorted terms: nodes with equal continuations are one node, and the numbers on a word's path add up to its place.
3. Documents stream through the transducers of their language, a bounded number of bytes of them at a time. What comes
   back is (source, shard, place) counts; no term is sent or joined again.
4. One task per shard lays its counts out as a table of sources by places and adds up the divergences of all pairs of
   sources in whole numbers. Sums over shards are the result. Leading terms are ranked by value, then ordinal, and only they
   are spelled out, by walking the transducer with the ordinal.

All arithmetic is on integers: the share of a term with count c in a group of N is ``1 + floor(10**9 (c + 2) / (N + 2 V))``,
and two shares p, q differ by ``floor((p - q)**2 / (p + q))``.
"""

from __future__ import annotations

import bisect
import io
import re
from collections import Counter
from collections.abc import Iterable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from deskstar.llm.common import mapped, staged

# In bytes, so that all of a character beyond ASCII is in the term, and only A-Z have another case.
TERM = re.compile(rb"[^\x00-\x40\x5B-\x60\x7B-\x7F]+")
BREAK = re.compile(rb"[\x00-\x40\x5B-\x60\x7B-\x7F]")
PIECE = 1 << 20
HELD = 400_000  # distinct terms counted before they are handed on
SCALE, PSEUDO = 1_000_000_000, 2
BYTES_PER_TERM = 24  # a generous bound for what a shard holds for a term
CELLS = 1 << 22  # of a table of sources by places


def terms(text: bytes) -> Iterator[list[bytes]]:
    """The terms of a text, part by part; parts end between terms."""
    at = 0
    while at < len(text):
        found = BREAK.search(text, at + PIECE)
        end = found.start() if found else len(text)
        yield TERM.findall(text[at:end].lower())
        at = end


class Transducer:
    """Minimal acyclic transducer from sorted byte strings to their places.

    ``keys`` are the arcs as node * 256 + byte, in order, with the node that they lead to in ``target`` and in ``before`` the
    number of strings through smaller arcs of the node, the string that ends there included. A node is final if ``final`` says so.
    """

    def __init__(self, keys: np.ndarray, target: np.ndarray, before: np.ndarray, final: np.ndarray, size: int):
        self.keys, self.target, self.before, self.final, self.size = keys, target, before, final, size

    @classmethod
    def build(cls, words: Iterable[bytes]) -> Transducer:
        """From distinct strings in ascending order: what the next string shares no more is finished, and equal ends are joined."""
        known: dict[tuple, int] = {}
        nodes: list[tuple] = []  # of finished nodes: final, count, arcs (byte, node)
        path: list[list] = [[False, []]]  # open nodes along the last string: final, arcs
        last, size = b"", 0

        def finish(down_to: int) -> None:
            for depth in range(len(path) - 1, down_to, -1):
                final, arcs = path.pop()
                key = (final, *arcs)
                if key not in known:
                    known[key] = len(nodes)
                    nodes.append((final, int(final) + sum(nodes[n][1] for _, n in arcs), arcs))
                path[depth - 1][1].append((last[depth - 1], known[key]))

        for word in words:
            same = 0
            while same < min(len(word), len(last)) and word[same] == last[same]:
                same += 1
            finish(same)
            path.extend([False, []] for _ in word[same:])
            path[-1][0] = True
            last, size = word, size + 1
        finish(0)
        root = len(nodes)
        nodes.append((path[0][0], size, path[0][1]))
        rows = []
        for number, (final, _, arcs) in enumerate(nodes):
            before = int(final)
            for byte, node in arcs:
                rows.append(((root - number) * 256 + byte, root - node, before))
                before += nodes[node][1]
        # The root is node 0.
        table = np.array(rows, dtype=np.int64).reshape(-1, 3)
        table = table[np.argsort(table[:, 0])]
        return cls(table[:, 0], table[:, 1].astype(np.int32), table[:, 2].astype(np.int32),
                   np.array([final for final, _, _ in reversed(nodes)], dtype=bool), size)

    def places(self, words: list[bytes]) -> np.ndarray:
        """The place of each string among the sorted ones, -1 if it is none of them; a byte of all at a time."""
        node, place = np.zeros(len(words), np.int64), np.zeros(len(words), np.int64)
        size = np.array([len(w) for w in words], dtype=np.int64)
        if not len(self.keys):
            return np.where((size == 0) & self.final[0], 0, -1)
        text = np.frombuffer(b"".join(words), dtype=np.uint8)
        start, alive = np.cumsum(size) - size, np.arange(len(words))
        for depth in range(int(size.max(initial=0))):
            alive = alive[size[alive] > depth]
            if not len(alive):
                break
            key = node[alive] * 256 + text[start[alive] + depth]
            at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
            found = self.keys[at] == key
            node[alive[~found]] = -1
            alive, at = alive[found], at[found]
            node[alive] = self.target[at]
            place[alive] += self.before[at]
        return np.where((node >= 0) & self.final[node], place, -1)

    def spelled(self, place: int) -> bytes:
        """The string of a place: at each node the last arc that is not past it."""
        node, left, word = 0, place, bytearray()
        while not (self.final[node] and left == 0):
            low, high = np.searchsorted(self.keys, [node * 256, node * 256 + 256])
            at = low + int(np.searchsorted(self.before[low:high], left, side="right")) - 1
            word.append(int(self.keys[at]) & 255)
            node, left = int(self.target[at]), left - int(self.before[at])
        return bytes(word)

    def dump(self) -> bytes:
        out = io.BytesIO()
        np.savez(out, keys=self.keys, target=self.target, before=self.before, final=self.final, size=self.size)
        return out.getvalue()

    @classmethod
    def load(cls, blob: bytes) -> Transducer:
        with np.load(io.BytesIO(blob)) as held:
            return cls(held["keys"], held["target"], held["before"], held["final"], int(held["size"]))


def kept_terms(docs: DataFrame, min_docs: int) -> DataFrame:
    """Columns lang, term (UTF-8), ordinal: terms of at least ``min_docs`` documents of the language, numbered from 0 in order."""
    def holders(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, Counter] = {}
        size = 0

        def flush() -> Iterator[pa.RecordBatch]:
            for lang, counts in held.items():
                yield pa.record_batch([pa.array([lang] * len(counts), pa.string()), pa.array(list(counts), pa.binary()),
                                       pa.array(list(counts.values()), pa.int64())], ["lang", "term", "n"])
            held.clear()

        for batch in batches:
            for lang, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                own: set[bytes] = set()
                for part in terms(text.as_py()):
                    own.update(part)
                counts = held.setdefault(lang, Counter())
                size -= len(counts)
                counts.update(own)
                size += len(counts)
                if size >= HELD:
                    yield from flush()
                    size = 0
        yield from flush()

    counts = docs.select("lang", "text").mapInArrow(holders, "lang string, term binary, n bigint")
    often = staged(counts.groupBy("lang", "term").agg(F.sum("n").alias("n")).where(F.col("n") >= min_docs).select(
        "lang", "term"), "kept")
    # Ranges of the order follow each other, so a range's first place of a language is the number of its terms before.
    ranged = staged(often.orderBy("lang", "term").select(
        "lang", "term", F.spark_partition_id().alias("part"), F.monotonically_increasing_id().alias("row")), "sorted")
    ranges = ranged.groupBy("lang", "part").agg(F.count("*").alias("n"), F.min("row").alias("first"))
    earlier = F.sum("n").over(Window.partitionBy("lang").orderBy("part").rowsBetween(Window.unboundedPreceding, -1))
    ranges = ranges.select("lang", "part", "first", F.coalesce(earlier, F.lit(0)).alias("base"))
    return ranged.join(ranges, ["lang", "part"]).select("lang", "term", (F.col("row") - F.col("first") + F.col("base")).alias("ordinal"))


def vocabulary(kept: DataFrame, terms_per_shard: int) -> DataFrame:
    """One row per shard: lang, shard, first and last term, n_terms and the packed transducer."""
    def build(rows: pd.DataFrame) -> pd.DataFrame:
        words = sorted(map(bytes, rows["term"]))
        return pd.DataFrame({"lang": [rows["lang"].iloc[0]], "shard": [rows["shard"].iloc[0]], "first": [words[0]],
                             "last": [words[-1]], "n_terms": [len(words)], "packed": [Transducer.build(words).dump()]})

    shard = F.floor(F.col("ordinal") / terms_per_shard)
    return staged(kept.withColumn("shard", shard).groupBy("lang", "shard").applyInPandas(
        build, "lang string, shard bigint, first binary, last binary, n_terms bigint, packed binary"), "vocabulary")


class Lookup:
    """The shards of a pass, to look terms up in."""

    def __init__(self, shards: list):
        self.shards: dict[str, list] = {}
        for lang, shard, first, last, _, packed in sorted((tuple(s) for s in shards), key=lambda s: (s[0], s[1])):
            self.shards.setdefault(lang, []).append((bytes(first), bytes(last), shard, Transducer.load(bytes(packed))))

    def codes(self, lang: str, words: Iterable[bytes]) -> dict[bytes, int]:
        """Shard and place, in one number, of the terms that the shards hold."""
        ordered, found, at = sorted(words), {}, 0
        for first, last, shard, transducer in self.shards[lang]:
            start = bisect.bisect_left(ordered, first, at)
            at = bisect.bisect_right(ordered, last, start)
            places = transducer.places(ordered[start:at])
            for k in np.flatnonzero(places >= 0).tolist():
                found[ordered[start + k]] = shard << 32 | int(places[k])
        return found


def recounted(docs: DataFrame, shards: DataFrame, terms_per_shard: int, index_bytes: int) -> DataFrame:
    """Columns lang, source, shard, place, n: how often each kept term occurs in each group, where it does.

    A pass broadcasts as many shards as ``index_bytes`` hold, whatever the size of the vocabulary.
    """
    spark = docs.sparkSession
    per_pass = max(1, index_bytes // (BYTES_PER_TERM * terms_per_shard))
    named = shards.select("lang", "shard").orderBy("lang", "shard").withColumn("row", F.monotonically_increasing_id())
    names = [(r["lang"], r["shard"]) for r in named.orderBy("row").collect()]
    passes = []
    for start in range(0, len(names), per_pass):
        chosen = spark.createDataFrame(names[start:start + per_pass], "lang string, shard bigint")
        held = spark.sparkContext.broadcast(
            [tuple(r) for r in shards.join(F.broadcast(chosen), ["lang", "shard"]).select(*shards.columns).collect()])
        passes.append(counted(docs, held))
    if not passes:
        return spark.createDataFrame([], "lang string, source string, shard bigint, place bigint, n bigint")
    rows = passes[0]
    for more in passes[1:]:
        rows = rows.unionByName(more)
    return staged(rows.groupBy("lang", "source", "shard", "place").agg(F.sum("n").alias("n")), "counts")


def counted(docs: DataFrame, held) -> DataFrame:
    """One pass: partial counts by the shards that ``held`` broadcasts."""
    names = ["lang", "source", "shard", "place", "n"]
    opened: list[Lookup] = []

    def stream(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if not opened:
            opened.append(Lookup(held.value))
        lookup, counts, size = opened[0], {}, 0

        def flush() -> Iterator[pa.RecordBatch]:
            for lang, sources in counts.items():
                codes = lookup.codes(lang, set().union(*sources.values()))
                for source, own in sources.items():
                    rows = [(codes[t], n) for t, n in own.items() if t in codes]
                    code, n = np.array(rows, dtype=np.int64).reshape(-1, 2).T
                    yield pa.record_batch([pa.array([lang] * len(n), pa.string()), pa.array([source] * len(n), pa.string()),
                                           pa.array(code >> 32), pa.array(code & 0xFFFFFFFF), pa.array(n)], names)
            counts.clear()

        for batch in batches:
            for lang, source, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2), strict=True):
                if lang in lookup.shards:
                    own = counts.setdefault(lang, {}).setdefault(source, Counter())
                    size -= len(own)
                    for part in terms(text.as_py()):
                        own.update(part)
                    size += len(own)
                    if size >= HELD:
                        yield from flush()
                        size = 0
        yield from flush()

    return docs.select("lang", "source", "text").mapInArrow(
        stream, "lang string, source string, shard bigint, place bigint, n bigint")


def shares(counts: np.ndarray, total: int, kept: int) -> np.ndarray:
    """Whole-number shares; sums are taken in two steps, so products stay below 2**63."""
    whole, bottom = counts.astype(np.int64) + PSEUDO, total + PSEUDO * kept
    # floor(10**9 a / b) by quotient and remainder of a / b; the remainder is below b.
    quotient, rest = np.divmod(whole, bottom)
    if bottom < (1 << 63) // SCALE:
        return 1 + quotient * SCALE + rest * SCALE // bottom
    return 1 + np.array([int(a) * SCALE // bottom for a in whole], dtype=np.int64)


def apart(p: np.ndarray, q: np.ndarray) -> np.ndarray:
    return (p - q) ** 2 // (p + q)


def divergences(docs: DataFrame, min_docs: int = 10, top: int = 10, terms_per_shard: int = 16_384,
                index_bytes: int = 128 << 20) -> DataFrame:
    """Columns lang, source, part, item, value and rank over the columns lang, source and text of ``docs``.

    Part ``pair``: each other source of the language, by the sum of divergences over all kept terms (0 without any). Part
    ``term``: the ``top`` terms that the source has and uses more than its language, by their divergence from it. Ranks
    are from 1 by falling value, then by item in UTF-8 order. Null text, lang and source count as empty. A repeated row
    counts again. Groups without terms count with all counts 0; a language with one source has no pairs. Other columns
    are ignored. An empty table gives an empty table.
    """
    blank = F.lit("")
    docs = docs.select(*[F.coalesce(F.col(c), blank).alias(c) for c in ("lang", "source")],
                       F.coalesce(F.col("text"), blank).cast("binary").alias("text"))
    kept = kept_terms(docs, min_docs)
    shards = vocabulary(kept, terms_per_shard)
    counts = recounted(docs, shards, terms_per_shard, index_bytes)
    groups = docs.select("lang", "source").distinct()
    totals = counts.groupBy("lang", "source").agg(F.sum("n").alias("total"))
    groups = staged(groups.join(totals, ["lang", "source"], "left").select(
        "lang", "source", F.coalesce("total", F.lit(0)).alias("total")), "groups")
    sizes = shards.groupBy("lang").agg(F.sum("n_terms").alias("kept"))
    # A row per source, as many as the result names for each source; sorted so that blocks agree.
    listed = groups.groupBy("lang").agg(F.sort_array(F.collect_list(F.struct("source", "total"))).alias("sources")).join(
        sizes, "lang", "left").select("lang", "sources", F.coalesce("kept", F.lit(0)).alias("kept"))
    listed = staged(listed, "sources")
    held = shards.join(listed, "lang").select("lang", "shard", "n_terms", "packed", "sources", "kept")

    def compare(rows: pa.Table, block: pa.Table) -> pa.Table:
        lang, shard, size = (block[c][0].as_py() for c in ("lang", "shard", "n_terms"))
        kept_here, sources = block["kept"][0].as_py(), block["sources"][0].as_py()
        names = [s["source"] for s in sources]
        totals_here = [s["total"] for s in sources]
        number = {name: k for k, name in enumerate(names)}
        owner = np.array([number[s] for s in rows["source"].to_pylist()], dtype=np.int64)
        place, n = rows["place"].to_numpy(), rows["n"].to_numpy()
        transducer = Transducer.load(block["packed"][0].as_py())
        sums = np.zeros((len(names), len(names)), dtype=np.int64)
        best: list[list[tuple[int, int]]] = [[] for _ in names]
        wide = max(1, CELLS // len(names))
        for start in range(0, size, wide):
            here = (place >= start) & (place < start + wide)
            table = np.zeros((len(names), min(wide, size - start)), dtype=np.int64)
            table[owner[here], place[here] - start] = n[here]
            p = np.stack([shares(row, total, kept_here) for row, total in zip(table, totals_here, strict=True)])
            for k in range(len(names)):
                for j in range(k):
                    sums[k, j] += apart(p[k], p[j]).sum()
            q = shares(table.sum(axis=0), sum(totals_here), kept_here)
            for k in range(len(names)):
                usable = np.flatnonzero((table[k] > 0) & (p[k] > q))
                value = apart(p[k][usable], q[usable])
                order = np.argsort(-value, kind="stable")[:top]
                best[k] = sorted([*best[k], *zip((-value[order]).tolist(), (usable[order] + start).tolist(), strict=True)])[:top]
        sums += sums.T
        out = [(lang, s, "pair", names[j], int(sums[k, j]), None) for k, s in enumerate(names) for j in range(len(names)) if j != k]
        out += [(lang, s, "term", transducer.spelled(at).decode(), -value, shard << 32 | at)
                for k, s in enumerate(names) for value, at in best[k]]
        return pa.Table.from_pylist([dict(zip(("lang", "source", "part", "item", "value", "ordinal"), r, strict=True)) for r in out],
                                    SCHEMA)

    schema = "lang string, source string, part string, item string, value bigint, ordinal bigint"
    found = staged(counts.groupBy("lang", "shard").cogroup(held.groupBy("lang", "shard")).applyInArrow(compare, schema), "parts")
    # Every pair of sources has a row, also where the language keeps no term.
    pairs = groups.select("lang", "source").join(groups.select("lang", F.col("source").alias("item")), "lang").where(
        "source <> item").select("lang", "source", "item", F.lit(0).cast("long").alias("value"))
    pairs = pairs.unionByName(found.where("part = 'pair'").select("lang", "source", "item", "value")).groupBy(
        "lang", "source", "item").agg(F.sum("value").alias("value"))
    by_item = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    by_ordinal = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "ordinal")
    leading = found.where("part = 'term'").withColumn("rank", F.row_number().over(by_ordinal)).where(F.col("rank") <= top)
    return pairs.select("lang", "source", F.lit("pair").alias("part"), "item", "value", F.row_number().over(by_item).alias("rank")).unionByName(
        leading.select("lang", "source", "part", "item", "value", "rank"))


SCHEMA = pa.schema([("lang", pa.string()), ("source", pa.string()), ("part", pa.string()), ("item", pa.string()),
                    ("value", pa.int64()), ("ordinal", pa.int64())])
