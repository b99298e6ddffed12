"""Byte-level BPE: encoding in linear time by longest matches with backtracking, and decoding."""

from __future__ import annotations

import base64
import hashlib
import unicodedata
from array import array
from collections.abc import Iterable, Iterator

import ahocorasick
import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickerlark.llm.chunks import PLAIN, Remembered, chunks, once

#: Tokens of which a worker knows what goes after another one, before it begins anew.
MOST_PAIRS = 200_000
#: Texts whose ids are held at once.
HELD_ROWS = 500


def read_ranks(path: str) -> dict[bytes, int]:
    """Ranks of a file of lines ``base64 rank``."""
    with open(path, "rb") as f:
        return {base64.b64decode(a): int(b) for a, b in (line.split() for line in f if line.strip())}


def packed(ids: Iterable[int]) -> bytes:
    """Ids as bytes of four each: what is remembered takes less room, and is joined, as bytes."""
    return array("i", ids).tobytes()


class ByteBpe:
    """Encodes and decodes by a rank table and the pattern that cuts texts.

    A token sequence is what the merges give if each token comes out of its own bytes and each
    neighbouring pair comes out of the bytes of both. So: take the longest matching token, then
    shorter ones while it doesn't go with the token before, and step back if none does; no
    position that has failed is tried again, hence linear time.
    """

    def __init__(self, ranks: dict[bytes, int], pattern: str, remembered: int = 250_000):
        self.ranks, self.bytes_of = ranks, {i: b for b, i in ranks.items()}
        self.pattern = regex.compile(pattern)
        #: The two parts that the last merge of a token joins.
        self.halves: dict[int, tuple[int, int]] = {}
        alone = []
        for b, rank in ranks.items():
            parts = self._merged(b)
            if len(parts) == 1:
                alone.append(b)
                if len(b) > 1:
                    self.halves[rank] = (ranks[self._last[0]], ranks[self._last[1]])
        #: Whether each merge joins older tokens, as trained tables do.
        self.in_order = all(max(x) < rank for rank, x in self.halves.items())
        self.size_of = {i: len(b) for b, i in ranks.items()}
        #: All ids in order, whether they are 0, 1, .., their bytes, and their digits with a comma and zero bytes.
        self.known = np.array(sorted(self.bytes_of), np.int32)
        self.dense = bool((self.known == np.arange(len(self.known))).all())
        self.token_bytes = pa.array([self.bytes_of[i] for i in self.known.tolist()], pa.large_binary())
        digits = np.array([b"%d," % i for i in self.known.tolist()])
        self.token_digits = digits.view(np.uint8).reshape(len(digits), -1)
        #: After a token: the longest token at a place that goes with it, from the given one on; -1 if none does.
        self.pairs: dict[int, int] = {}
        self.trie = ahocorasick.Automaton()
        for b in alone:
            self.trie.add_word(b.decode("latin-1"), ranks[b])
        self.trie.make_automaton()
        #: The longest shorter token at the same place.
        self.shorter: dict[int, int] = {}
        able = set(alone)
        for b in alone:
            for n in range(len(b) - 1, 0, -1):
                if b[:n] in able:
                    self.shorter[ranks[b]] = ranks[b[:n]]
                    break
        self.after_space = Remembered(self._after_space, most=remembered)
        self.inside = Remembered(lambda piece: packed(self.encode_piece(piece.encode())), most=remembered // 4)

    def _merged(self, piece: bytes) -> list[bytes]:
        """The merges themselves, in rank order; for single tokens, which are short."""
        parts, ranks = [piece[i : i + 1] for i in range(len(piece))], self.ranks
        while len(parts) > 1:
            best = min(((ranks[parts[i] + parts[i + 1]], i) for i in range(len(parts) - 1) if parts[i] + parts[i + 1] in ranks), default=None)
            if best is None:
                break
            i = best[1]
            self._last = parts[i], parts[i + 1]
            parts[i : i + 2] = [parts[i] + parts[i + 1]]
        return parts

    def merged(self, piece: bytes) -> list[int]:
        return [self.ranks[p] for p in self._merged(piece)]

    def _goes(self, a: int, b: int) -> bool:
        """Whether the bytes of two tokens come out as these two.

        Merges are undone from the last one, along the two edges that face each other. If what
        then stands side by side could have been joined before the merge that was undone, the
        merges would have joined it. Of merges of one rank the left one comes first.
        """
        if not self.in_order:
            return self.merged(self.bytes_of[a] + self.bytes_of[b]) == [a, b]
        bytes_of, ranks, halves = self.bytes_of, self.ranks, self.halves
        until = len(ranks) + max(a, b) + 1
        while True:
            joined = ranks.get(bytes_of[a] + bytes_of[b])
            if joined is not None and joined < until:
                return False
            if a in halves and (a > b or b not in halves):
                until, a = a, halves[a][1]
            elif b in halves:
                until, b = b + 1, halves[b][0]
            else:
                return True

    def encode_piece(self, piece: bytes) -> list[int]:
        """The tokens of one match of the pattern."""
        known = self.ranks.get(piece)
        if known is not None:
            return [known]
        size = len(piece)
        pairs, shorter, size_of = self.pairs, self.shorter, self.size_of
        longest = [0] * (size + 1)
        for end, token in self.trie.iter(piece.decode("latin-1")):
            longest[end + 1 - size_of[token]] = token  # ends rise, so the longest stays
        token = longest[0]
        out: list[int] = []
        closed: set[int] = set()
        at, before = 0, -1
        while True:
            if before >= 0 and token >= 0:
                fits = pairs.get(before << 32 | token)
                token = self._fit(before, token) if fits is None else fits
            if token < 0:
                closed.add(at)
                token = out.pop()
                at -= size_of[token]
                before = out[-1] if out else -1
                token = shorter.get(token, -1)
                continue
            end = at + size_of[token]
            if closed and end in closed:
                token = shorter.get(token, -1)
                continue
            out.append(token)
            if end == size:
                return out
            at, before, token = end, token, longest[end]

    def _fit(self, before: int, token: int) -> int:
        """The longest token that goes after ``before``, of ``token`` and the shorter ones at its place; -1 if none."""
        if len(self.pairs) >= MOST_PAIRS:
            self.pairs.clear()
        fits = token
        while fits >= 0 and not self._goes(before, fits):
            fits = self.shorter.get(fits, -1)
        self.pairs[before << 32 | token] = fits
        return fits

    def pieces(self, text: str) -> list[str]:
        """The matches of the pattern; letters newer than this Python's tables count as symbols."""
        if text.isascii() or not any(unicodedata.category(c) == "Cn" for c in text):
            return self.pattern.findall(text)
        seen = "".join("\ue000" if unicodedata.category(c) == "Cn" else c for c in text)
        return [text[m.start() : m.end()] for m in self.pattern.finditer(seen)]

    def _after_space(self, chunk: str) -> bytes:
        if chunk.isascii() and chunk.isalpha():
            return packed(self.encode_piece((" " + chunk).encode()))
        plain = PLAIN(" " + chunk)
        if plain is None:
            return self._cut(" " + chunk)
        if plain[2]:
            return self.after_space[chunk[:-1]] + packed(self.encode_piece(plain[2].encode()))
        return packed(self.encode_piece(plain[1].encode()))

    def _cut(self, chunk: str) -> bytes:
        return b"".join([self.inside[piece] for piece in self.pieces(chunk)])

    def ids(self, text: str) -> np.ndarray:
        first, *rest = chunks(text)
        return np.frombuffer(b"".join([self._cut(first), *map(self.after_space.__getitem__, rest)]), np.int32)

    def encode(self, text: str) -> list[int]:
        return self.ids(text).tolist()

    def _at(self, ids: Iterable[int]) -> np.ndarray:
        """The places of ids in ``known``."""
        ids = np.asarray(ids, np.int32)
        at = ids if self.dense else np.searchsorted(self.known, ids)
        if len(ids) and (at.min() < 0 or at.max() >= len(self.known) or (not self.dense and (self.known[at] != ids).any())):
            raise KeyError("an id without a token")
        return at

    def decode(self, ids: Iterable[int]) -> bytes:
        at = self._at(ids)
        if not len(at):
            return b""
        _, ends, data = self.token_bytes.take(pa.array(at)).buffers()
        return bytes(memoryview(data)[: np.frombuffer(ends, np.int64)[len(at)]])

    def digits(self, ids: Iterable[int]) -> bytes:
        """The ids in decimal, joined by commas."""
        return self.token_digits.take(self._at(ids), axis=0).tobytes().translate(None, b"\0")[:-1]


def _encoded(docs: DataFrame, ranks: str, pattern: str, columns: dict[str, tuple[str, pa.DataType]], row, remembered: int = 250_000) -> DataFrame:
    """``row(bpe, text)`` for each text, beside its doc_id."""
    sent = docs.sparkSession.sparkContext.broadcast(read_ranks(ranks))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = once((ranks, pattern, len(sent.value), remembered), lambda: ByteBpe(sent.value, pattern, remembered))
        for batch in (whole.slice(at, HELD_ROWS) for whole in batches for at in range(0, whole.num_rows, HELD_ROWS)):
            rows = [row(bpe, x.as_py() or "") for x in batch.column(1)]
            made = [pa.array([r[i] for r in rows], kind) for i, (_, kind) in enumerate(columns.values())]
            yield pa.RecordBatch.from_arrays([batch.column(0), *made], names=["doc_id", *columns])

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return rows.mapInArrow(run, ", ".join(["doc_id long", *(f"{k} {v[0]}" for k, v in columns.items())]))


def encode_documents(docs: DataFrame, ranks: str, pattern: str, remembered: int = 100_000) -> DataFrame:
    """(doc_id, n_tokens, ids) for each row of ``docs(doc_id, text)``.

    ``ranks`` is the path of a rank file, read by the driver and broadcast (bounded by the
    vocabulary). A worker remembers twice ``remembered`` chunks at most, some 100 MB. One narrow pass over whole texts. Null text is empty and has no ids. Repeated
    and null doc_id rows are encoded row by row; other columns are ignored.
    """

    def row(bpe: ByteBpe, text: str) -> tuple:
        ids = bpe.ids(text)
        return len(ids), ids

    return _encoded(docs, ranks, pattern, {"n_tokens": ("long", pa.int64()), "ids": ("array<int>", pa.list_(pa.int32()))}, row, remembered)


def decode_documents(encoded: DataFrame, ranks: str) -> DataFrame:
    """(doc_id, text) for each row of ``encoded(doc_id, ids)``; null ids give null, no ids empty.

    Bytes that aren't UTF-8 (ids cut inside a character) come back as U+FFFD; an id without a
    token is an error.
    """
    sent = encoded.sparkSession.sparkContext.broadcast({i: b for b, i in read_ranks(ranks).items()})

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [None if x is None else b"".join(map(sent.value.__getitem__, x)).decode("utf-8", "replace") for x in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(texts, pa.string())], names=["doc_id", "text"])

    return encoded.select(F.col("doc_id").cast("long").alias("doc_id"), "ids").mapInArrow(run, "doc_id long, text string")


def round_trip_digests(docs: DataFrame, ranks: str, pattern: str) -> DataFrame:
    """(doc_id, n_tokens, ids_sha256, decoded_sha256): ids joined by commas, and the decoded bytes.

    The same pass as :func:`encode_documents`, then the decoding of its ids, without moving the
    ids out of the task. Nulls and repeated rows as there.
    """

    def row(bpe: ByteBpe, text: str) -> tuple:
        ids = bpe.ids(text)
        return len(ids), hashlib.sha256(bpe.digits(ids)).hexdigest(), hashlib.sha256(bpe.decode(ids)).hexdigest()

    return _encoded(docs, ranks, pattern, {"n_tokens": ("long", pa.int64()), "ids_sha256": ("string", pa.string()), "decoded_sha256": ("string", pa.string())}, row)
