"""Token ids in fixed-width bit-packed blocks (operator 6).

A written folder holds Parquet rows, one per block: ``(part, block, first_id, n_ids, width,
doc_ids, doc_starts, payload)``. ``payload`` is the block's ids, each in ``width`` bits, least
significant bit first; ``width`` is the fewest bits that hold the vocabulary. ``doc_starts`` are
the offsets of the block's documents within its ids (one more than documents), so any document,
or any id, is found without unpacking what stands before it: id ``i`` starts at bit
``i * width``. Blocks hold whole documents, about ``block_ids`` ids. ``part`` and ``block``
ascend with doc_id and ``first_id`` counts the part's ids before the block, so the sizes of the
parts (one number each) give global positions.

Texts are encoded with the tokenizers library. Its normaliser and splitter never let a token
cross a space, tab or line end and drop all of these, so each distinct chunk between them is
encoded once per task run of a worker, some hundreds per call, and whole texts are put together
by NumPy gathers.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

from tabforge.llm._store import fresh_dir
from tabforge.llm._text import byte_set, runs, span_hashes, word_spans

#: Chunks are runs of anything but these characters (a subset of what the tokenizer drops).
CHUNK = ~byte_set((0x20, 0x20), (0x09, 0x0A), (0x0D, 0x0D))
END_ID = 1
#: Distinct chunks a worker remembers before it starts afresh.
REMEMBERED = 1_500_000
SCHEMA = "part int, block int, first_id long, n_ids int, width int, doc_ids array<long>, doc_starts array<int>, payload binary"
_NAMES = [c.split()[0] for c in SCHEMA.split(", ")]


def pack(ids: np.ndarray, width: int) -> bytes:
    bits = np.unpackbits(ids.astype("<u4").view(np.uint8).reshape(-1, 4), axis=1, bitorder="little")[:, :width]
    return np.packbits(bits.ravel(), bitorder="little").tobytes()


def unpack(payload: bytes, width: int, start: int, stop: int) -> np.ndarray:
    """Ids ``start`` to ``stop`` of a block, reading only their bytes."""
    if stop <= start:
        return np.zeros(0, np.uint32)
    a, b = start * width, stop * width
    raw = np.frombuffer(payload, np.uint8)[a // 8:-(-b // 8)]
    bits = np.unpackbits(raw, bitorder="little")[a % 8:a % 8 + b - a].reshape(-1, width)
    full = np.zeros((len(bits), 32), np.uint8)
    full[:, :width] = bits
    return np.packbits(full, axis=1, bitorder="little").view("<u4").ravel()


class ChunkEncoder:
    """Ids of whole texts from the ids of their distinct chunks."""

    #: A chunk of its own between others when many are encoded in one call.
    MARK = "\ue000"

    def __init__(self, spec: str):
        from tokenizers import Tokenizer
        self.tok = Tokenizer.from_str(spec)
        self.width = max(1, (self.tok.get_vocab_size(with_added_tokens=True) - 1).bit_length())
        self.mark = np.array(self.tok.encode(self.MARK, add_special_tokens=False).ids, np.uint32)
        # known chunks: hash (sorted), first id, number of ids, whether used since the last clearing
        self.key, self.at = np.zeros(0, np.uint64), np.zeros(0, np.int64)
        self.size, self.used = np.zeros(0, np.int64), np.zeros(0, bool)
        self.ids = np.zeros(0, np.uint32)

    def _encode_chunks(self, chunks: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all chunks, number of ids of each); the mark tells chunks of one call apart."""
        parts = [chunks[a:a + 400] for a in range(0, len(chunks), 400)]
        texts = [f" {self.MARK} ".join(p) for p in parts]
        flat, sizes = [], []
        for part, text, e in zip(parts, texts, self.tok.encode_batch_fast(texts, add_special_tokens=False)):
            ids = np.array(e.ids, np.uint32)
            m = len(self.mark)
            hit = np.ones(max(0, len(ids) - m + 1), bool)
            for k in range(m):
                hit &= ids[k:k + len(hit)] == self.mark[k]
            cut = np.flatnonzero(hit)
            if text.count(self.MARK) != len(part) - 1 or len(cut) != len(part) - 1:   # a chunk holds the mark itself
                own = [np.array(x.ids, np.uint32) for x in self.tok.encode_batch_fast(part, add_special_tokens=False)]
            else:
                edge = np.concatenate(([-m], cut, [len(ids)]))
                own = [ids[x + m:y] for x, y in zip(edge[:-1], edge[1:])]
            flat += own
            sizes += [len(x) for x in own]
        return np.concatenate(flat) if flat else np.zeros(0, np.uint32), np.array(sizes, np.int64)

    def _learn(self, chunks: list[str], hashes: np.ndarray) -> None:
        if len(self.key) + len(hashes) > REMEMBERED:         # keep what was used since the last time
            keep = np.flatnonzero(self.used) if 2 * self.used.sum() < REMEMBERED else np.zeros(0, np.int64)
            off = np.concatenate(([0], np.cumsum(self.size[keep])))
            self.ids = self.ids[np.repeat(self.at[keep] - off[:-1], self.size[keep]) + np.arange(off[-1])]
            self.key, self.at, self.size, self.used = self.key[keep], off[:-1], self.size[keep], np.zeros(len(keep), bool)
        ids, size = self._encode_chunks(chunks)
        at = len(self.ids) + np.cumsum(size) - size
        self.ids = np.concatenate((self.ids, ids))
        where = np.searchsorted(self.key, hashes)
        self.key, self.at = np.insert(self.key, where, hashes), np.insert(self.at, where, at)
        self.size, self.used = np.insert(self.size, where, size), np.insert(self.used, where, False)

    def _find(self, uniq: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        k = np.searchsorted(self.key, uniq)
        known = np.zeros(len(uniq), bool)
        inside = k < len(self.key)
        known[inside] = self.key[k[inside]] == uniq[inside]
        return k, known

    def encode(self, buf: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all rows, each row closed by END_ID; offsets per row)."""
        starts, ends, woff = word_spans(buf, offs, CHUNK)
        uniq, first, inv = np.unique(span_hashes(buf, starts, ends, fold_case=False), return_index=True, return_inverse=True)
        k, known = self._find(uniq)
        self.used[k[known]] = True
        new = np.flatnonzero(~known)
        if len(new):
            self._learn([buf[starts[j]:ends[j]].tobytes().decode("utf-8", "replace") for j in first[new]], uniq[new])
            k, known = self._find(uniq)
            if not known.all():                              # a clearing dropped chunks of this run
                back = np.flatnonzero(~known)
                self._learn([buf[starts[j]:ends[j]].tobytes().decode("utf-8", "replace") for j in first[back]], uniq[back])
                k, _ = self._find(uniq)
        at, size = self.at[k[inv]], self.size[k[inv]]
        before = np.concatenate(([0], np.cumsum(size)))
        rows = len(offs) - 1
        out_off = before[woff] + np.arange(rows + 1)         # one END_ID after each row
        out = np.full(out_off[-1], END_ID, np.uint32)
        src = np.repeat(at - before[:-1], size) + np.arange(before[-1])
        row = np.repeat(np.arange(rows), before[woff[1:]] - before[woff[:-1]])
        out[np.arange(before[-1]) + row] = self.ids[src]
        return out, out_off


_HELD: dict[int, ChunkEncoder] = {}


def _shared(spec: str) -> ChunkEncoder:
    """The worker's encoder for a tokenizer file; a reused worker keeps what it has learned."""
    key = zlib.crc32(spec.encode())
    if key not in _HELD:
        _HELD.clear()
        _HELD[key] = ChunkEncoder(spec)
    return _HELD[key]


def _block_writer(spec, block_ids: int):
    def run(batches):
        enc, part, block = _shared(spec.value), TaskContext.get().partitionId(), 0
        docs: list = []
        ids: list[np.ndarray] = []
        size = first = 0

        def close():
            nonlocal block, first, docs, ids, size
            starts = np.concatenate(([0], np.cumsum([len(x) for x in ids])))
            row = [[part], [block], [first], [size], [enc.width], [docs], [starts.tolist()], [pack(np.concatenate(ids), enc.width)]]
            types = [pa.int32(), pa.int32(), pa.int64(), pa.int32(), pa.int32(), pa.list_(pa.int64()), pa.list_(pa.int32()), pa.binary()]
            out = pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in zip(row, types)], names=_NAMES)
            block, first, docs, ids, size = block + 1, first + size, [], [], 0
            return out

        for batch in batches:
            names = batch.column("doc_id").to_pylist()
            for lo, hi, buf, offs in runs(batch.column("text")):
                got, off = enc.encode(buf, offs)
                for k in range(hi - lo):
                    one = got[off[k]:off[k + 1]]
                    if docs and size + len(one) > block_ids:
                        yield close()
                    docs.append(names[lo + k])
                    ids.append(one)
                    size += len(one)
        if docs:
            yield close()
    return run


def write_tokens(docs: DataFrame, folder: str, tokenizer: str, block_ids: int = 65_536) -> None:
    """Encode every whole text of ``docs`` (doc_id, text) with the tokenizer file, close it with
    END_ID and write the blocks in ascending doc_id order (rows with equal ids by their text's
    checksum; null ids first). A null or empty text is just END_ID."""
    base = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    order = [F.col("doc_id"), F.crc32(F.coalesce("text", F.lit("")).cast("binary"))]
    ordered = base.repartitionByRange(*order).sortWithinPartitions(*order)
    with open(tokenizer, encoding="utf-8") as f:             # a vocabulary file on the driver, a few MB
        spec = docs.sparkSession.sparkContext.broadcast(f.read())
    ordered.mapInArrow(_block_writer(spec, block_ids), SCHEMA).write.option("compression", "none").parquet(folder)


def _reader(before: dict[int, int]):
    def run(batches):
        for batch in batches:
            for k in range(batch.num_rows):
                r = {c: batch.column(c)[k] for c in ("part", "width", "payload", "doc_ids", "doc_starts", "first_id")}
                s = np.array(r["doc_starts"].as_py(), np.int64)
                ids = unpack(r["payload"].as_buffer(), r["width"].as_py(), 0, int(s[-1])).astype("<u4")
                base = before[r["part"].as_py()] + r["first_id"].as_py()
                crc = [zlib.crc32(ids[a:b].tobytes()) for a, b in zip(s[:-1], s[1:])]
                yield pa.RecordBatch.from_arrays(
                    [r["doc_ids"].values, pa.array(base + s[:-1]), pa.array(np.diff(s)), pa.array(crc, pa.int64())],
                    names=["doc_id", "start", "n_tokens", "ids_crc32"])
    return run


def read_tokens(spark, folder: str) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32) of every document in a written folder: ``start``
    counts the ids of all documents before it. Only one number per part reaches the driver."""
    blocks = spark.read.schema(SCHEMA).parquet(folder)
    sizes = {r.part: r.n for r in blocks.groupBy("part").agg(F.sum("n_ids").alias("n")).collect()}
    before, total = {}, 0
    for p in sorted(sizes):
        before[p], total = total, total + sizes[p]
    return blocks.mapInArrow(_reader(before), "doc_id long, start long, n_tokens long, ids_crc32 long")


def token_roundtrip(docs: DataFrame, tokenizer: str, block_ids: int = 65_536) -> DataFrame:
    """Write ``docs`` to a new shared folder and return what reading it back gives."""
    folder = fresh_dir(docs.sparkSession, "tokens")
    write_tokens(docs, folder, tokenizer, block_ids)
    return read_tokens(docs.sparkSession, folder)
