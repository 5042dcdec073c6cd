"""Token ids in binary files: write documents in id order, read them back by blocks.

Documents are range-partitioned by ``doc_id`` and sorted inside a partition,
so the shards follow each other in id order. A task tokenizes its documents,
appends the end id to each, and cuts the stream of ids into blocks of
``BLOCK`` ids; groups of blocks are coded together by
:mod:`workgrid.llm.range_coder`. A block is independent of all others and
carries its own checksum.

A file is a Parquet file of coded blocks: ``shard``, ``block``, ``payload``
and ``pieces``, the documents' stretches of the block in order (document,
number of the piece, its first id in the document, count). No whole shard is
held: a task keeps one group of blocks.
"""

from __future__ import annotations

import os
import zlib
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from workgrid.llm import range_coder

BLOCK = 4096
END = 0
_KNOWN = 400_000
_RUN = 64
_TEXT = 1 << 23  # bytes of the texts that are tokenized together
# White space as Python has it: code points, single bytes, and the first bytes of the longer ones.
_BLANKS = np.array([c for c in range(1 << 16) if chr(c).isspace()])
_BLANK = np.isin(np.arange(256), _BLANKS[_BLANKS < 128])
_BLANK_LEAD = np.isin(np.arange(256), [chr(c).encode()[0] for c in _BLANKS[_BLANKS >= 128]])

# ASCII letters and ASCII marks; the apostrophe is neither, as it may begin a contraction.
_LETTER = np.array([chr(c).isalpha() and c < 128 for c in range(256)])
_MARK = np.array([33 <= c < 127 and not chr(c).isalnum() and c != 39 for c in range(256)])

_PIECE = "struct<doc:long,doc_id:{kind},piece:long,start:long,n:long>"


def _visible(body: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Whether a character other than white space begins at each of the places ``at`` of UTF-8 bytes."""
    lead = body[at]
    out = ~_BLANK[lead]
    wide = np.flatnonzero(_BLANK_LEAD[lead])
    if wide.size:
        place, first = at[wide], lead[wide].astype(np.int64)
        second = body[place + 1] & 63
        third = body[np.minimum(place + 2, body.size - 1)] & 63
        point = np.where(first == 0xC2, 0x80 | second, (first & 15) << 12 | second.astype(np.int64) << 6 | third)
        out[wide] = ~np.isin(point, _BLANKS)
    return out


def _parts(texts: pa.LargeStringArray) -> tuple[pa.LargeStringArray, np.ndarray]:
    """The texts cut where the tokenizer's pattern surely starts a piece, and the number of the first part of each text.

    That is before a space that a visible character follows, between an
    ASCII letter and an ASCII mark, before a line feed after one of these,
    and after such a line feed before an ASCII letter. Fewer cuts would give
    the same ids. The parts lie in the bytes of the texts; nothing is copied.
    """
    at = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + len(texts) + 1]
    data = texts.buffers()[2]
    body = np.frombuffer(data, np.uint8)[at[0] : at[-1]] if data is not None else np.empty(0, np.uint8)
    starts, ends = at[:-1] - at[0], at[1:] - at[0]
    space = np.flatnonzero(body == 32)
    last = np.zeros(body.size + 1, bool)
    last[ends] = True
    space = space[~last[space + 1]]
    cut = np.zeros(body.size, bool)
    cut[space[_visible(body, space + 1)]] = True
    letter, mark = _LETTER[body], _MARK[body]
    line = body[1:] == 10
    line &= letter[:-1] | mark[:-1]
    cut[1:] |= (letter[:-1] & mark[1:]) | (mark[:-1] & letter[1:]) | line
    cut[2:] |= line[:-1] & letter[2:]
    cuts = np.flatnonzero(cut)
    before = np.searchsorted(cuts, starts)
    bounds = np.append(np.insert(cuts, before, starts), body.size).astype(np.int64)
    parts = pa.Array.from_buffers(pa.large_string(), bounds.size - 1, [None, pa.py_buffer(bounds), pa.py_buffer(body)])
    return parts, before + np.arange(starts.size)


class Encoder:
    """Ids of whole texts by the tokenizers library; parts between spaces are remembered.

    The tokenizer's pattern starts a new piece at every space before a
    visible character, so the ids of a text are those of its parts. Equal
    parts of a batch of texts are looked up once.
    """

    def __init__(self, path: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = True  # their strings in a text are ordinary text
        self.begins = np.zeros(1 << 16, bool)  # tokens that begin with a space, as byte-level vocabularies write it
        self.begins[[i for t, i in self.tokenizer.get_vocab().items() if t[:1] == "\u0120" and i < 1 << 16]] = True
        self.known: dict[str, bytes] = {}

    def _new(self, parts: list[str]) -> None:
        # Parts that begin with their only space are encoded many at once: a token that begins with a space begins a part.
        spaced = [p for p in parts if p[:1] == " " and p.count(" ") == 1 and len(p) > 1]
        runs = [spaced[lo : lo + _RUN] for lo in range(0, len(spaced), _RUN)]
        for run, ids in zip(runs, self._encoded(["".join(run) for run in runs])):
            starts = np.flatnonzero(self.begins[ids])
            if starts.size != len(run):
                raise ValueError("the tokens of a run of parts do not begin with the parts")
            data, ends = ids.tobytes(), [*(2 * starts[1:]).tolist(), 2 * ids.size]
            self.known.update(zip(run, (data[lo:hi] for lo, hi in zip([0, *ends], ends))))
        others = [p for p in parts if p not in self.known]
        self.known.update(zip(others, (ids.tobytes() for ids in self._encoded(others))))

    def _encoded(self, texts: list[str]) -> list[np.ndarray]:
        try:
            return [np.frombuffer(array("H", e.ids), np.uint16) for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]
        except OverflowError:
            raise ValueError("ids above 65535 do not fit the file format") from None

    def ids(self, texts: pa.Array | list[str | None]) -> list[np.ndarray]:
        """Ids of every text with the end id, as unsigned 16-bit integers."""
        whole = pa.array(texts, pa.large_string()) if isinstance(texts, list) else texts.cast(pa.large_string())
        if not len(whole):
            return []
        parts, first = _parts(whole.fill_null(""))
        coded = parts.dictionary_encode()
        words = coded.dictionary.to_pylist()
        new = [w for w in words if w not in self.known]
        if len(self.known) + len(new) > _KNOWN:
            # Too many: those of these texts stay.
            self.known = {w: self.known[w] for w in words if w in self.known}
        if new:
            self._new(new)
        known = [*map(self.known.__getitem__, words), array("H", [END]).tobytes()]
        flat = np.frombuffer(b"".join(known), np.uint16)
        size = np.fromiter(map(len, known), np.int64, len(known)) >> 1
        begin = np.cumsum(size) - size
        # The end id is a part of its own after the parts of each text.
        after = np.append(first[1:], len(parts))
        code = np.insert(coded.indices.to_numpy(), after, len(words))
        sizes = size[code]
        ends = np.cumsum(sizes)
        ids = flat[np.repeat(begin[code] - ends + sizes, sizes) + np.arange(ends[-1])]
        return np.split(ids, ends[after[:-1] + np.arange(first.size - 1)])


_LOADED: dict[str, Encoder] = {}


def _encoder(path: str) -> Encoder:
    """The tokenizer of a file, built once per Python worker."""
    if path not in _LOADED:
        _LOADED[path] = Encoder(path)
    return _LOADED[path]


def _by_size(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    """The batch in runs of rows with about ``_TEXT`` bytes of text."""
    ends = np.cumsum(pc.fill_null(pc.binary_length(batch.column(1)), 0).to_numpy(zero_copy_only=False).astype(np.int64))
    lo = 0
    while lo < batch.num_rows:
        hi = max(int(np.searchsorted(ends, (ends[lo - 1] if lo else 0) + _TEXT)), lo + 1)
        yield batch.slice(lo, hi - lo)
        lo = hi


def _write(path: str, kind: pa.DataType):
    piece = pa.struct([("doc", pa.int64()), ("doc_id", kind), ("piece", pa.int64()), ("start", pa.int64()), ("n", pa.int64())])
    schema = pa.schema([("shard", pa.int32()), ("block", pa.int64()), ("pieces", pa.list_(piece)), ("payload", pa.binary())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, shard = _encoder(path), TaskContext.get().partitionId()
        blocks: list[np.ndarray] = []
        pieces: list[list[dict]] = []
        open_: list[np.ndarray] = []  # stretches of the block that is being filled
        open_pieces: list[dict] = []
        filled = number = doc = 0

        def close() -> None:
            nonlocal open_, open_pieces, filled
            blocks.append(np.concatenate(open_))
            pieces.append(open_pieces)
            open_, open_pieces, filled = [], [], 0

        def coded() -> pa.RecordBatch:
            nonlocal blocks, pieces, number
            payload = range_coder.encode(blocks)
            out = pa.RecordBatch.from_arrays(
                [
                    pa.array([shard] * len(blocks), pa.int32()),
                    pa.array(range(number, number + len(blocks)), pa.int64()),
                    pa.array(pieces, pa.list_(piece)),
                    pa.array(payload, pa.binary()),
                ],
                schema=schema,
            )
            number += len(blocks)
            blocks, pieces = [], []
            return out

        for whole in batches:
            for batch in _by_size(whole):
                for doc_id, ids in zip(batch.column(0).to_pylist(), encoder.ids(batch.column(1))):
                    at = part = 0
                    while at < ids.size:
                        n = min(BLOCK - filled, ids.size - at)
                        open_.append(ids[at : at + n])
                        open_pieces.append({"doc": doc, "doc_id": doc_id, "piece": part, "start": at, "n": n})
                        at, part, filled = at + n, part + 1, filled + n
                        if filled == BLOCK:
                            close()
                            if len(blocks) == range_coder.LANES:
                                yield coded()
                    doc += 1
        if open_:
            close()
        if blocks:
            yield coded()

    return run


def write_token_files(docs: DataFrame, tokenizer: str, folder: str) -> None:
    """Write the ids of every document of ``docs(doc_id, text)`` to ``folder`` in ascending ``doc_id`` order.

    ``tokenizer`` is the path of a tokenizers file on the executors. Null and
    empty texts are the end id alone. Null ids come first; rows of equal id
    are ordered by the hash of their text. An empty table writes no block.
    """
    kind = docs.schema["doc_id"].dataType.simpleString()
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    rows = docs.select("doc_id", text.alias("text"))
    ordered = rows.repartitionByRange("doc_id").sortWithinPartitions(F.col("doc_id"), F.xxhash64("text"))
    out = f"shard int, block long, pieces array<{_PIECE.format(kind=kind)}>, payload binary"
    arrow = {"bigint": pa.int64(), "int": pa.int32(), "string": pa.string()}[kind]
    ordered.mapInArrow(_write(tokenizer, arrow), out).write.parquet(folder)


def _read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names = ["shard", "doc", "piece", "start", "n", "crc"]
    for whole in batches:
        for batch in (whole.slice(lo, range_coder.LANES) for lo in range(0, whole.num_rows, range_coder.LANES)):
            shards = batch.column(0).to_pylist()
            found = range_coder.decode(batch.column(2).to_pylist())
            rows: list[tuple] = []
            ids: list = []
            for shard, pieces, block in zip(shards, batch.column(1).to_pylist(), found):
                at = 0
                for p in pieces:
                    data = block[at : at + p["n"]].tobytes()
                    rows.append((shard, p["doc"], p["piece"], p["start"], p["n"], zlib.crc32(data)))
                    ids.append(p["doc_id"])
                    at += p["n"]
                if at != block.size:
                    raise ValueError("the pieces of a block do not cover its ids")
            columns = [pa.array(c, pa.int32() if k == 0 else pa.int64()) for k, c in enumerate(zip(*rows))] if rows else [pa.array([], pa.int64())] * 6
            kind = batch.schema.field(1).type.value_type.field("doc_id").type
            yield pa.RecordBatch.from_arrays([*columns, pa.array(ids, kind)], names=[*names, "doc_id"])


def _times_x8(crc: np.ndarray, n: np.ndarray) -> np.ndarray:
    """crc of texts followed by ``n`` zero bytes, without the final inversion: products of polynomials modulo the crc's."""
    out, n = crc.astype(np.int64), n.astype(np.int64)
    power = np.array([0x00800000])  # x**8, highest term in the lowest bit

    def product(a: np.ndarray, b: int) -> np.ndarray:
        found = np.zeros_like(a)
        for k in range(31, -1, -1):
            found ^= (a >> k & 1) * b
            b = (b >> 1) ^ (0xEDB88320 if b & 1 else 0)
        return found

    while n.any():
        at = np.flatnonzero(n & 1)
        if at.size:
            out[at] = product(out[at], int(power[0]))
        power = product(power, int(power[0]))
        n >>= 1
    return out


def joined_crcs(first: np.ndarray, n: np.ndarray, crc: np.ndarray) -> np.ndarray:
    """crc32 of texts from the bytes and crc32 of their consecutive parts; ``first`` has the place of each text's first part."""
    ends = np.cumsum(n)
    count = np.diff(np.append(first, n.size))
    whole = np.repeat(ends[first + count - 1], count)
    return np.bitwise_xor.reduceat(_times_x8(crc, whole - ends), first)


def joined_crc(parts: list[tuple[int, int]]) -> int:
    """crc32 of a text from ``(bytes, crc32)`` of its consecutive parts."""
    n, crc = np.array(parts, np.int64).T
    return int(joined_crcs(np.array([0]), n, crc)[0])


def _joined(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        at = batch.schema.get_field_index("parts")
        parts = batch.column(at)
        if batch.num_rows:
            # Every document has a part: its end id is one of its ids.
            first = parts.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64).cumsum()
            first = np.append(0, first[:-1])
            flat = parts.flatten()
            n, crc = (flat.field(k).to_numpy(zero_copy_only=False) for k in ("n", "crc"))
            crcs = joined_crcs(first, 4 * n, crc)
        else:
            crcs = np.empty(0, np.int64)
        yield batch.set_column(at, "ids_crc32", pa.array(crcs, pa.int64()))


def read_token_files(spark: SparkSession, folder: str) -> DataFrame:
    """``(doc_id, start, n_tokens, ids_crc32)`` from the decoded blocks of the files.

    Every block is decoded and checked on its own; a damaged block raises an
    error. A document's pieces (a row each, without ids) meet by document.
    """
    files = spark.read.parquet(folder)
    kind = files.schema["pieces"].dataType.elementType["doc_id"].dataType.simpleString()
    out = f"shard int, doc long, piece long, start long, n long, crc long, doc_id {kind}"
    pieces = files.select("shard", "pieces", "payload").mapInArrow(_read, out)
    docs = pieces.groupBy("shard", "doc").agg(
        F.first("doc_id").alias("doc_id"),
        F.sum("n").alias("n_tokens"),
        F.array_sort(F.collect_list(F.struct("piece", "n", "crc"))).alias("parts"),
    )
    sized = docs.select("shard", "doc", "doc_id", "n_tokens", "parts")
    whole = sized.mapInArrow(_joined, f"shard int, doc long, doc_id {kind}, n_tokens long, ids_crc32 long")
    stretch = Window.partitionBy("shard").orderBy("doc").rowsBetween(Window.unboundedPreceding, -1)
    # Shards are file-sized; their totals (a row per shard) are summed up in order.
    totals = files.select("shard", F.aggregate("pieces", F.lit(0).cast("long"), lambda a, p: a + p["n"]).alias("n"))
    before = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    base = totals.groupBy("shard").agg(F.sum("n").alias("n")).select("shard", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base"))
    return (
        whole.withColumn("inside", F.coalesce(F.sum("n_tokens").over(stretch), F.lit(0)))
        .join(base, "shard")
        .select("doc_id", (F.col("base") + F.col("inside")).alias("start"), "n_tokens", "ids_crc32")
    )
