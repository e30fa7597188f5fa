"""SentencePiece encoding and decoding: one Viterbi pass driven by an Aho-Corasick automaton over the pieces.

The automaton reads the text once. At each position it reports, along its output links, every piece that ends there;
each relaxes the best score of a segmentation up to that position. A character that is no piece itself may also stand
alone as unknown, ten below the worst score; it is written as its UTF-8 bytes where the model has byte pieces.

No piece has a space mark after another character, so the best segmentation of a text is that of its space-led chunks one
after the other. The distinct chunks of a batch are segmented side by side: chunks of one length step through the
automaton together, its transitions in one table and its output links laid out by piece length. The table covers the
characters that occur in most pieces; chunks with others, and very long ones, take the same steps one by one.
"""

from __future__ import annotations

import math
import re
from array import array
from collections import Counter, defaultdict
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import count

import ahocorasick
import numpy as np
import pyarrow as pa
import sentencepiece
from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F

SPACE = "▁"
UNKNOWN_PENALTY = 10.0
CHUNK = re.compile(f"{SPACE}*[^{SPACE}]+|{SPACE}+")
TABLE_CHARS, LONGEST = 256, 48
BATCH_CHARS = 1_000_000


@dataclass(frozen=True)
class Vocabulary:
    """Pieces that text may become (piece, id, score), ids of bytes, surfaces of all ids, and the dummy prefix."""

    pieces: tuple[tuple[str, int, float], ...]
    byte_ids: tuple[int, ...]
    surfaces: tuple[bytes, ...]
    unknown: int
    prefix: bool


def read_vocabulary(model_file: str) -> Vocabulary:
    """The vocabulary of a model file; only the driver opens it."""
    model = sentencepiece.SentencePieceProcessor(model_file=model_file)
    pieces, surfaces, byte_ids = [], [], {}
    for i in range(model.get_piece_size()):
        piece = model.id_to_piece(i)
        if model.is_byte(i):
            byte_ids[int(piece[1:-1], 16)] = i
            surfaces.append(bytes([int(piece[1:-1], 16)]))
        elif model.is_unknown(i):
            surfaces.append(" ⁇ ".encode())
        elif model.is_control(i) or model.is_unused(i):
            surfaces.append(b"")
        else:
            pieces.append((piece, i, model.get_score(i)))
            surfaces.append(piece.replace(SPACE, " ").encode())
    if any(SPACE in piece.lstrip(SPACE) for piece, _, _ in pieces):
        raise ValueError("a piece holds a space mark after another character")
    prefix = len(model.encode("a")) > 0 and model.id_to_piece(model.encode("a")[0]).startswith(SPACE)
    return Vocabulary(tuple(pieces), tuple(byte_ids[b] for b in range(256)) if len(byte_ids) == 256 else (),
                      tuple(surfaces), model.unk_id(), prefix)


class Segmenter:
    def __init__(self, vocabulary: Vocabulary):
        self.v = vocabulary
        self.automaton = ahocorasick.Automaton()
        for piece, i, score in vocabulary.pieces:
            self.automaton.add_word(piece, (len(piece), i, score))
        self.automaton.make_automaton()
        self.alone = frozenset(piece for piece, _, _ in vocabulary.pieces if len(piece) == 1)
        self.worst = min((score for _, _, score in vocabulary.pieces), default=0.0) - UNKNOWN_PENALTY
        self.lay_out()

    def lay_out(self) -> None:
        """Transitions and output links over the table's characters as arrays."""
        common = Counter(c for piece, _, _ in self.v.pieces for c in set(piece) if c in self.alone)
        first = sorted(common, key=lambda c: (c >= "\u0250" and c != SPACE, -common[c], c))  # Latin, then the most common
        self.codes = {c: k for k, c in enumerate(first[:TABLE_CHARS])}
        self.code_of = np.full(0x110000, -1, dtype=np.int32)
        for c, k in self.codes.items():
            self.code_of[ord(c)] = k
        usable = [p for p in self.v.pieces if all(c in self.codes for c in p[0])]
        self.widest = max((len(piece) for piece, _, _ in usable), default=1)
        children: list[dict[int, int]] = [{}]
        ends: dict[int, tuple[int, int, float]] = {}
        for piece, i, score in usable:
            node = 0
            for c in piece:
                code = self.codes[c]
                if code not in children[node]:
                    children[node][code] = len(children)
                    children.append({})
                node = children[node][code]
            ends[node] = (len(piece), i, score)
        n = len(children)
        self.step = np.zeros((n, TABLE_CHARS), dtype=np.min_scalar_type(n))
        self.gain = np.full((n, self.widest), -np.inf)  # by length, longest first
        self.piece = np.full((n, self.widest), -1, dtype=np.int32)
        fail, queue = [0] * n, [0]
        for node in queue:
            if node:
                self.step[node] = self.step[fail[node]]
                self.gain[node], self.piece[node] = self.gain[fail[node]], self.piece[fail[node]]
            if node in ends:
                length, i, score = ends[node]
                self.gain[node, self.widest - length], self.piece[node, self.widest - length] = score, i
            for code, child in children[node].items():
                fail[child] = int(self.step[fail[node], code]) if node else 0
                queue.append(child)
            for code, child in children[node].items():
                self.step[node, code] = child

    def best_together(self, codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of the best segmentations of chunks of one length, flat, and their counts."""
        rows, n = codes.shape
        m = self.widest
        score = np.full((rows, n + m), -np.inf)
        score[:, m - 1] = 0.0
        length = np.zeros((rows, n + 1), dtype=np.int64)
        piece = np.zeros((rows, n + 1), dtype=np.int32)
        state, every = np.zeros(rows, dtype=np.int32), np.arange(rows)
        for end in range(1, n + 1):
            state = self.step[state, codes[:, end - 1]]
            reached = score[:, end - 1:end + m - 1] + self.gain[state]
            k = reached.argmax(axis=1)
            score[:, end + m - 1] = reached[every, k]
            length[:, end], piece[:, end] = m - k, self.piece[state, k]
        at, out = np.full(rows, n), []
        while at.any():
            out.append(np.where(at > 0, piece[every, at], -1))
            at = at - length[every, at]
        table = np.stack(out[::-1], axis=1)
        return table[table >= 0], (table >= 0).sum(axis=1)

    def segment(self, chunks: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of the chunks one after the other, and where each begins (with the end)."""
        groups: dict[int, list[int]] = {}
        for k, n in enumerate(map(len, chunks)):
            groups.setdefault(n if n <= LONGEST else 0, []).append(k)
        order, ids, counts = [], [], []
        slow = groups.pop(0, [])
        for n, members in groups.items():
            text = "".join([chunks[k] for k in members])
            codes = self.code_of[np.frombuffer(text.encode("utf-32-le", "surrogatepass"), dtype=np.uint32)].reshape(-1, n)
            fits = codes.min(axis=1) >= 0
            members = np.array(members)
            slow.extend(members[~fits].tolist())
            if fits.any():
                found, sizes = self.best_together(codes[fits])
                order.append(members[fits])
                ids.append(found)
                counts.append(sizes)
        if slow:
            alone = [self.best(chunks[k]) for k in slow]
            order.append(np.array(slow))
            ids.append(np.concatenate([np.frombuffer(a, dtype=np.int32) for a in alone]))
            counts.append(np.array([len(a) for a in alone]))
        if not order:
            return np.zeros(0, np.int32), np.zeros(1, np.int64)
        members, flat, sizes = np.concatenate(order), np.concatenate(ids), np.concatenate(counts)
        starts = np.concatenate([[0], np.cumsum(sizes)])[:-1]
        place = np.empty(len(members), dtype=np.int64)
        place[members] = np.arange(len(members))
        return gathered(flat, starts[place], sizes[place])

    def best(self, chunk: str) -> array:
        """Ids of the best segmentation; among equal scores the last piece is the longest."""
        n = len(chunk)
        score: list[float] = [0.0] + [-math.inf] * n
        choice: list[tuple | None] = [None] * (n + 1)
        if self.alone.issuperset(chunk):
            for last, match in self.automaton.iter(chunk):
                reached = score[last + 1 - match[0]] + match[2]
                if reached > score[last + 1]:
                    score[last + 1], choice[last + 1] = reached, match
        else:
            ending: dict[int, list[tuple]] = {}
            for last, match in self.automaton.iter(chunk):
                ending.setdefault(last, []).append(match)
            for last, char in enumerate(chunk):
                for match in ending.get(last, ()):
                    reached = score[last + 1 - match[0]] + match[2]
                    if reached > score[last + 1]:
                        score[last + 1], choice[last + 1] = reached, match
                if char not in self.alone and score[last] + self.worst > score[last + 1]:
                    score[last + 1], choice[last + 1] = score[last] + self.worst, (1, -1)
        out, at = [], n
        while at:
            match = choice[at]
            if match[1] >= 0:
                out.append(match[1])
            elif self.v.byte_ids:
                out.extend(self.v.byte_ids[b] for b in reversed(chunk[at - 1].encode()))
            else:
                out.append(self.v.unknown)
            at -= match[0]
        out.reverse()
        return array("i", out)

    def chunks(self, text: str) -> list[str]:
        """The space-led chunks of the text behind the dummy prefix, without their first space mark."""
        if "  " not in text and text[0] != " " and SPACE not in text:
            return text.split(" ")
        return [chunk[1:] for chunk in CHUNK.findall(SPACE + text.replace(" ", SPACE))]

    def encode_all(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts one after the other, and where each begins (with the end)."""
        numbers: dict[str, int] = defaultdict(count().__next__)
        seen, ends = array("q"), [0]
        for text in texts:
            if text and self.v.prefix:
                seen.extend(map(numbers.__getitem__, self.chunks(text)))
            elif text:
                marked = CHUNK.findall(text.replace(" ", SPACE))
                # Without a prefix only the first chunk can lack its space mark.
                seen.extend([numbers[chunk[1:] if chunk[0] == SPACE else "\0" + chunk] for chunk in marked])
            ends.append(len(seen))
        whole = [chunk[1:] if chunk[:1] == "\0" and not self.v.prefix else SPACE + chunk for chunk in numbers]
        flat, starts = self.segment(whole)
        at = np.frombuffer(seen, dtype=np.int64)
        ids, begins = gathered(flat, starts[at], np.diff(starts)[at])
        return ids, begins[ends]

    def encode(self, text: str) -> list[int]:
        return self.encode_all([text])[0].tolist()


def gathered(flat: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The runs of ``flat`` at ``starts`` of ``sizes`` one after the other, and where each begins (with the end)."""
    ends = np.concatenate([[0], np.cumsum(sizes)])
    at = np.arange(ends[-1]) + np.repeat(starts - ends[:-1], sizes)
    return flat[at], ends


def decode_ids(vocabulary: Vocabulary, ids) -> str:
    """Surfaces of the pieces in turn, without the space that encoding put in front."""
    text = b"".join(map(vocabulary.surfaces.__getitem__, ids)).decode(errors="replace")
    return text[1:] if vocabulary.prefix and text.startswith(" ") else text


def slices(texts: pa.Array) -> Iterator[list[str | None]]:
    """``texts`` in runs of about BATCH_CHARS characters; only one run is held as Python strings."""
    part, size = [], 0
    for value in texts:
        part.append(value.as_py())
        size += len(part[-1] or "")
        if size >= BATCH_CHARS:
            yield part
            part, size = [], 0
    if part:
        yield part


def encode_lists(vocabulary: Vocabulary, batches: Iterator[pa.Array]) -> Iterator[pa.ListArray]:
    """The ids of each text, null for a null one; a batch of long texts gives several arrays."""
    segmenter = Segmenter(vocabulary)
    for texts in batches:
        for part in slices(texts):
            ids, ends = segmenter.encode_all(part)
            yield pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(ids, pa.int32()),
                                           mask=pa.array([text is None for text in part], pa.bool_()))


def decode_lists(vocabulary: Vocabulary, lists: pa.ListArray) -> pa.Array:
    flat = lists.flatten().to_numpy()
    out, at = [], 0
    for n in lists.value_lengths().to_pylist():
        out.append(None if n is None else decode_ids(vocabulary, flat[at:at + n].tolist()))
        at += n or 0
    return pa.array(out, pa.string())


def encoded(spark: SparkSession, text: Column, vocabulary: Vocabulary) -> Column:
    """Array of piece ids of each whole text: null for a null text, empty for an empty one."""
    held = spark.sparkContext.broadcast(vocabulary)

    def encode(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        yield from encode_lists(held.value, batches)

    encode.__annotations__ = {"batches": Iterator[pa.Array], "return": Iterator[pa.Array]}
    return F.arrow_udf(encode, "array<int>")(text)


def round_trip(spark: SparkSession, text: Column, vocabulary: Vocabulary) -> Column:
    """Struct of ``encoded`` and of ``decoded`` over it, as ``piece_ids`` and ``text``.

    Two UDFs of which one takes the other's ids would run in one worker with the inner one called twice, its tables and
    results held twice. Here a text is encoded once, and its ids are decoded while they are held.
    """
    held = spark.sparkContext.broadcast(vocabulary)

    def there_and_back(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for ids in encode_lists(held.value, batches):
            yield pa.StructArray.from_arrays([ids, decode_lists(held.value, ids)], ["piece_ids", "text"])

    there_and_back.__annotations__ = {"batches": Iterator[pa.Array], "return": Iterator[pa.Array]}
    return F.arrow_udf(there_and_back, "piece_ids array<int>, text string")(text)


def decoded(spark: SparkSession, ids: Column, vocabulary: Vocabulary) -> Column:
    """Text of each array of ids; null for a null array.

    Gives back the encoded text, but for a space mark (U+2581) in the text itself, which the format cannot tell from a
    space. To encode and decode in one query, see ``round_trip``.
    """
    held = spark.sparkContext.broadcast(vocabulary)

    def decode(lists: pa.Array) -> pa.Array:
        return decode_lists(held.value, lists)

    decode.__annotations__ = {"lists": pa.Array, "return": pa.Array}
    return F.arrow_udf(decode, "string")(ids)
