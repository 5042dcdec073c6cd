"""Byte-level BPE encoding and decoding by longest matches with backtracking.

The vocabulary is a rank file (base64 token, rank). Bytes are mapped to
Latin-1 characters, so that one Aho-Corasick automaton over the tokens finds
the longest token at every byte of a piece in one pass. A sequence of tokens
is what the merges would give exactly if each adjacent pair is: a pair is
compatible if encoding its joined bytes gives the pair back. The encoder
walks over the piece with the longest token that is compatible with the one
before it, falls back to shorter tokens, and steps back where none fits; a
byte position that led nowhere is never tried again, so the work is linear
in the piece. Pair compatibility is memoised, and so are the ids of recent
pieces. The longest tokens are taken one after another by the automaton as
long as they fit; only where one does not, shorter ones are tried.
"""

from __future__ import annotations

import base64
import hashlib
import re
from collections.abc import Iterator
from itertools import accumulate, chain

import ahocorasick
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

_PAIRS = 1 << 19
_PIECES = 400_000
_MARKS = 50_000

# A space before a visible character always starts a new piece of the pattern.
_PART = re.compile(r" (?=\S)")
_LOOSE = re.compile(r" (?:\s|\Z)")


def read_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as f:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, f)}


class Bpe:
    """Encoder and decoder of one rank file; ``pattern`` cuts a text into pieces."""

    def __init__(self, ranks: dict[bytes, int], pattern: str):
        self.pieces = regex.compile(pattern).findall
        self.token = {i: t for t, i in ranks.items()}
        self.size = {i: len(t) for t, i in ranks.items()}
        self.text = {i: str(i) for i in self.token}
        if missing := [b for b in range(256) if bytes([b]) not in ranks]:
            raise ValueError(f"bytes without a token: {missing[:5]}")
        self.halves: dict[int, tuple[int, int]] = {}
        self.merged: dict[tuple[int, int], int] = {}
        for token, rank in sorted(ranks.items(), key=lambda x: x[1]):
            if len(token) > 1 and len(parts := _merge(token, ranks, rank)) == 2:
                self.halves[rank] = (parts[0], parts[1])
                self.merged[parts[0], parts[1]] = rank
        # The longest proper prefix of a token that is itself a token.
        self.shorter = {
            i: next((ranks[t[:n]] for n in range(len(t) - 1, 0, -1) if t[:n] in ranks), None) for t, i in ranks.items()
        }
        self.automaton = ahocorasick.Automaton(ahocorasick.STORE_ANY, ahocorasick.KEY_STRING)
        for token, rank in ranks.items():
            self.automaton.add_word(token.decode("latin-1"), rank)
        self.automaton.make_automaton()
        self.widest = max(map(len, ranks))
        self.window = max(256, 4 * self.widest)
        self.fits: dict[tuple[int, int], bool] = {}
        self.known: dict[str, tuple[int, ...]] = {}
        self.marks: dict[str, tuple[int, ...]] = {}

    def compatible(self, left: int, right: int) -> bool:
        """Whether merging the joined bytes of the two tokens gives exactly the two tokens."""
        pair = (left, right)
        found = self.fits.get(pair)
        if found is None:
            if len(self.fits) >= _PAIRS:
                self.fits.clear()
            found = self.fits[pair] = self._undo(left, right)
        return found

    def _undo(self, left: int, right: int) -> bool:
        """Take the merges of both tokens back, latest first, and look for an earlier merge across their border."""
        bound = len(self.token) + 1
        while True:
            across = self.merged.get((left, right))
            if across is not None and across < bound:
                return False
            # The side whose last merge has the higher rank was joined later; ties fall to the right side.
            left_rank = left if left in self.halves else -1
            right_rank = right if right in self.halves else -1
            if left_rank < 0 and right_rank < 0:
                return True
            if left_rank > right_rank:
                bound, left = left_rank, self.halves[left][1]
            else:
                # The merge on the right of the border comes after one across it at equal rank.
                bound, right = right_rank + 1, self.halves[right][0]

    def encode_piece(self, piece: bytes) -> list[int]:
        """Token ids of one piece."""
        text = piece.decode("latin-1")
        fits, size, shorter = self.fits, self.size, self.shorter
        out: list[int] = []
        closed: set[int] = set()
        at, before = 0, None
        while at < len(text):
            # The longest token at each place reached, as long as it fits the one before it. A window keeps the
            # cost of a restart bounded; its matches are the longest as long as a whole token fits into it.
            window = text[at : at + self.window]
            safe = len(text) if at + len(window) == len(text) else at + len(window) - self.widest
            start = at
            candidate: int | None = None
            for last, rank in self.automaton.iter_long(window):
                last += start
                if at > safe:
                    break
                if before is not None:
                    fit = fits.get((before, rank))
                    if not (self.compatible(before, rank) if fit is None else fit):
                        candidate = shorter[rank]
                        break
                if closed and last + 1 in closed:
                    candidate = shorter[rank]
                    break
                out.append(rank)
                at, before = last + 1, rank
            else:
                continue
            if at > safe:
                continue
            # A shorter token, or a step back where none fits: that place is closed, the token before it was too long.
            while True:
                while candidate is not None:
                    end = at + size[candidate]
                    if end not in closed and (before is None or self.compatible(before, candidate)):
                        break
                    candidate = shorter[candidate]
                if candidate is not None:
                    break
                closed.add(at)
                candidate = out.pop()
                at -= size[candidate]
                before = out[-1] if out else None
                candidate = shorter[candidate]
            out.append(candidate)
            at, before = end, candidate
        return out

    def _ids(self, part: str) -> tuple[int, ...]:
        """Ids of a stretch of text that starts and ends at borders of pieces."""
        pieces = self.pieces(part)
        if len(pieces) == 1:
            return tuple(self.encode_piece(part.encode("utf-8", "surrogatepass")))
        out: list[int] = []
        for piece in pieces:
            # A piece after a space may be known as a stretch of its own; the others are mostly marks.
            ids = self.known.get(piece[1:]) if piece[0] == " " else self.marks.get(piece)
            if ids is None:
                ids = tuple(self.encode_piece(piece.encode("utf-8", "surrogatepass")))
                if piece[0] != " ":
                    if len(self.marks) >= _MARKS:
                        self.marks.clear()
                    self.marks[piece] = ids
            out += ids
        return tuple(out)

    def encode(self, text: str) -> list[int]:
        if not text:
            return []
        first, *rest = text.split(" ") if not _LOOSE.search(text) else _PART.split(text)
        known = self.known
        if new := {p for p in rest if p not in known}:
            if len(known) + len(new) > _PIECES:
                known.clear()
                new = set(rest)
            for p in new:
                known[p] = self._ids(" " + p)
        ids = list(self._ids(first))
        ids.extend(chain.from_iterable(map(known.__getitem__, rest)))
        if len(known) > _PIECES:
            known.clear()
        return ids

    def decode(self, ids: list[int]) -> bytes:
        return b"".join(map(self.token.__getitem__, ids))


def _merge(token: bytes, ranks: dict[bytes, int], below: int) -> list[int]:
    """Merge a token's bytes by ranks smaller than ``below``."""
    parts = [token[i : i + 1] for i in range(len(token))]
    while len(parts) > 1:
        best, at = min((ranks.get(a + b, below), i) for i, (a, b) in enumerate(zip(parts, parts[1:])))
        if best >= below:
            break
        parts[at : at + 2] = [parts[at] + parts[at + 1]]
    return [ranks[p] for p in parts]


_LOADED: dict[tuple[str, str], Bpe] = {}


def loaded(path: str, pattern: str) -> Bpe:
    """The encoder of a rank file, built once per Python worker."""
    if (path, pattern) not in _LOADED:
        _LOADED[path, pattern] = Bpe(read_ranks(path), pattern)
    return _LOADED[path, pattern]


def encode_documents(docs: DataFrame, path: str, pattern: str) -> DataFrame:
    """``(doc_id, ids array<int>)`` for every row of ``docs(doc_id, text)``.

    ``path`` is the rank file on the executors. Null and empty texts give no
    ids. Rows are independent: repeated rows and null ids give their own
    results; an empty table gives an empty one; other columns are ignored.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = loaded(path, pattern)
        for batch in batches:
            for part in (batch.slice(lo, 500) for lo in range(0, batch.num_rows, 500)):
                ids = [bpe.encode(t or "") for t in part.column(1).to_pylist()]
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(ids, pa.list_(pa.int32()))], names=["doc_id", "ids"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", F.col("text").cast("string")).mapInArrow(run, f"doc_id {kind}, ids array<int>")


def decode_documents(encoded: DataFrame, path: str, pattern: str) -> DataFrame:
    """``(doc_id, bytes binary)`` for every row of ``encoded(doc_id, ids)``; null ids are no ids."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = loaded(path, pattern)
        for batch in batches:
            found = [bpe.decode(ids or []) for ids in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found, pa.binary())], names=["doc_id", "bytes"])

    kind = encoded.schema["doc_id"].dataType.simpleString()
    return encoded.select("doc_id", "ids").mapInArrow(run, f"doc_id {kind}, bytes binary")


def encoding_digests(docs: DataFrame, path: str, pattern: str, keep_ids: bool = False) -> DataFrame:
    """``(doc_id, n_tokens, ids_sha256, decoded_sha256)``: encode, then decode the ids, of every whole text.

    ``keep_ids`` adds ``ids array<int>``. Cases as in :func:`encode_documents`.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = loaded(path, pattern)
        for whole in batches:
            for batch in (whole.slice(lo, 500) for lo in range(0, whole.num_rows, 500)):
                n, of_ids, of_bytes, kept = [], [], [], []
                for text in batch.column(1).to_pylist():
                    ids = bpe.encode(text or "")
                    n.append(len(ids))
                    of_ids.append(hashlib.sha256(",".join(map(bpe.text.__getitem__, ids)).encode()).hexdigest())
                    of_bytes.append(hashlib.sha256(bpe.decode(ids)).hexdigest())
                    if keep_ids:
                        kept.append(pa.array(ids, pa.int32()))
                columns = [batch.column(0), pa.array(n, pa.int64()), pa.array(of_ids, pa.string()), pa.array(of_bytes, pa.string())]
                names = ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"]
                if keep_ids:
                    ends = pa.array([0, *accumulate(n)], pa.int32())
                    flat = pa.concat_arrays(kept) if kept else pa.array([], pa.int32())
                    columns.append(pa.ListArray.from_arrays(ends, flat))
                    names.append("ids")
                yield pa.RecordBatch.from_arrays(columns, names=names)

    kind = docs.schema["doc_id"].dataType.simpleString()
    out = f"doc_id {kind}, n_tokens long, ids_sha256 string, decoded_sha256 string" + ", ids array<int>" * keep_ids
    return docs.select("doc_id", F.col("text").cast("string")).mapInArrow(run, out)
