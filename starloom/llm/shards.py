"""Training-order materialisation of token ids as fixed-stride binary shards.

Documents, each followed by an end id, are packed into sequences of fixed length
in the order of their input files. A keyed Feistel permutation with cycle walking
sends the ordinal of every sequence to its global slot; slot // per_shard is its
shard and the place in that file is a fixed stride times the rest. So a reader
streams shards in training order and resumes at any slot by one seek.

Ordinals need no shuffle: one pass counts the tokens of each input split, their
prefix sums (one row a split) go to the tasks, and the second pass counts on
within its split. Only the finished sequences move, once, to their shards.
"""

from __future__ import annotations

import uuid
from bisect import bisect_right
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.fs as pafs
import zstandard
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from starloom.llm.common import written
from starloom.llm.feistel import permute

#: Ids of byte tokens that no UTF-8 text holds.
BYTE_END, BYTE_PAD = 0xFF, 0xFE
#: The copy of the ids lies on disk until the shards are written; at the default level
#: and page size it would be 18% larger.
DENSE = {"parquet.compression.codec.zstd.level": "9", "parquet.page.size": str(8 << 20)}


@dataclass(frozen=True)
class Layout:
    """What a reader needs to know of a set of shards."""

    path: str
    sequences: int
    length: int
    per_shard: int
    dtype: str
    key: int

    @property
    def stride(self) -> int:
        return self.length * np.dtype(self.dtype).itemsize

    def place(self, slot: int) -> tuple[str, int]:
        """File and byte offset of a slot."""
        return f"{self.path}/shard-{slot // self.per_shard:08d}.bin", slot % self.per_shard * self.stride


def _flat(column: pa.Array, dtype: np.dtype, end: int) -> list[bytes]:
    """The bytes of each row's ids and its end id."""
    last = np.array([end], dtype).tobytes()
    if pa.types.is_list(column.type):
        return [np.array(ids or [], dtype).tobytes() + last for ids in column.to_pylist()]
    if pa.types.is_binary(column.type):
        return [(ids or b"") + last for ids in column.to_pylist()]
    return [(text or "").encode() + last for text in column.to_pylist()]


def _sequences(layout: Layout, end: int, pad: int):
    """Cuts the tokens of each split into sequences and gives them their slots."""
    dtype, stride = np.dtype(layout.dtype), layout.stride
    filler = np.array([pad], dtype).tobytes()

    def rows(pack, buffer: bytes, ids: list, ends: list[int], ordinal: int) -> pa.RecordBatch:
        n = -(-len(buffer) // stride)
        starts = np.arange(n) * stride
        stops = np.minimum(starts + stride, len(buffer))
        ends = np.array(ends)
        first, last = np.searchsorted(ends, starts, "right"), np.searchsorted(ends, stops, "left")
        data = buffer + filler * ((n * stride - len(buffer)) // dtype.itemsize)
        return pa.RecordBatch.from_arrays([
            pa.array(permute(ordinal + np.arange(n), layout.sequences, layout.key)),
            pa.array(((stops - starts) // dtype.itemsize).astype(np.int32)),
            pa.array([ids[a:b + 1] for a, b in zip(first, last)], pa.list_(pa.int64())),
            pa.array([pack(data[a:a + stride]) for a in starts.tolist()], pa.binary()),  # smaller on its way
        ], ["slot", "n_tokens", "doc_ids", "ids"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pack = zstandard.ZstdCompressor(level=3, write_checksum=False, write_dict_id=False).compress
        split, ordinal, held, ids, ends, size = None, 0, [], [], [], 0
        for batch in batches:
            base = batch.column("base").to_pylist()
            keys = list(zip(batch.column("file").to_pylist(), batch.column("start").to_pylist()))
            for key, at, doc, data in zip(keys, base, batch.column("doc_id").to_pylist(),
                                          _flat(batch.column("tokens"), dtype, end)):
                if key != split:
                    if held:
                        yield rows(pack, b"".join(held), ids, ends, ordinal)
                    split, ordinal, held, ids, ends, size = key, at, [], [], [], 0
                held.append(data)
                size += len(data)
                ids.append(doc)
                ends.append(size)
                if size >= max(1 << 21, stride):
                    buffer = b"".join(held)
                    whole = size // stride * stride
                    yield rows(pack, buffer[:whole], ids, ends, ordinal)
                    ordinal += whole // stride
                    held, size = [buffer[whole:]], size - whole
                    rest = bisect_right(ends, whole)  # the documents that reach beyond what is cut off
                    ids, ends = ids[rest:], [x - whole for x in ends[rest:]]
        if held and size:
            yield rows(pack, b"".join(held), ids, ends, ordinal)

    return run


def _writer(layout: Layout):
    """Writes each shard's sequences, which come in slot order, as one file. A file
    gets its name when it is whole, so a repeated task only replaces it by itself."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, root = pafs.FileSystem.from_uri(layout.path)
        out, shard, draft = None, None, ""
        unpack = zstandard.ZstdDecompressor().decompress

        def close():
            out.close()
            store.move(draft, f"{root}/shard-{shard:08d}.bin")

        for batch in batches:
            slots = batch.column("slot").to_numpy()
            shards = slots // layout.per_shard
            payload = batch.column("ids").to_pylist()
            for at in np.unique(shards, return_index=True)[1].tolist():
                to = int(np.searchsorted(shards, shards[at], "right"))
                if shards[at] != shard:
                    if out:
                        close()
                    shard = int(shards[at])
                    draft = f"{root}/.draft-{uuid.uuid4().hex}"
                    out = store.open_output_stream(draft)
                out.write(b"".join(map(unpack, payload[at:to])))
            yield pa.RecordBatch.from_arrays([
                batch.column("slot"), pa.array(shards), pa.array(slots % layout.per_shard * layout.stride),
                batch.column("n_tokens"), batch.column("doc_ids"),
            ], ["slot", "shard", "offset", "n_tokens", "doc_ids"])
        if out:
            close()

    return run


def write_shards(docs: DataFrame, path: str, tokens_col: str = "text", length: int = 1024, per_shard: int = 16384,
                 dtype: str = "uint8", end: int = BYTE_END, pad: int = BYTE_PAD, key: int = 1,
                 id_col: str = "doc_id", from_files: bool = False) -> tuple[Layout, DataFrame]:
    """Write shards under ``path`` (a URI that all executors reach); returns their
    layout and an index with one row per sequence: slot, shard, offset (bytes),
    n_tokens (without padding), doc_ids (documents with a token in it, in order).

    ``tokens_col``: a string (its UTF-8 bytes are the ids, ``dtype`` uint8), an
    array of ids that ``dtype`` holds, or the bytes of numbers of ``dtype`` (bpe.packed). Null and empty rows count as documents with
    the end id alone; null ids stay null; repeated rows are packed as often as they
    come. The last sequence of each input split is padded with ``pad``. No rows:
    no shard, an empty index. ``from_files``: ``docs`` is a plain scan of files
    whose splits tell its rows apart; otherwise its two columns are written first.
    """
    spark = docs.sparkSession
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(tokens_col).alias("tokens"))
    if not from_files:
        rows = written(rows, "tokens", "zstd", **DENSE)
    rows = rows.select("*", F.input_file_name().alias("file"), F.input_file_block_start().alias("start"))
    kind = dict(rows.dtypes)["tokens"]
    size = F.size("tokens") if kind.startswith("array") else F.floor(F.octet_length("tokens") / np.dtype(dtype).itemsize)
    counts = rows.groupBy("file", "start").agg(F.sum(F.greatest(F.coalesce(size, F.lit(0)), F.lit(0)) + 1).alias("n"))
    splits = written(counts.select("file", "start", F.ceil(F.col("n") / length).alias("sequences")), "splits")
    before = Window.orderBy("file", "start").rowsBetween(Window.unboundedPreceding, -1)
    bases = splits.select("file", "start", F.coalesce(F.sum("sequences").over(before), F.lit(0)).alias("base"))
    total = splits.agg(F.coalesce(F.sum("sequences"), F.lit(0))).first()[0]
    layout = Layout(path.rstrip("/"), int(total), length, per_shard, dtype, key)
    store, root = pafs.FileSystem.from_uri(layout.path)
    store.create_dir(root, recursive=True)
    # one row per input split: bounded by the input's size over the split size
    placed = (rows.join(F.broadcast(bases), ["file", "start"])
              .select("doc_id", "tokens", "file", "start", "base")
              .mapInArrow(_sequences(layout, end, pad), "slot long, n_tokens int, doc_ids array<long>, ids binary"))
    shards = max(1, -(-int(total) // per_shard))
    tasks = min(shards, max(int(spark.conf.get("spark.sql.shuffle.partitions")), shards // 64))
    shard = F.floor(F.col("slot") / per_shard)
    index = (placed.repartitionById(tasks, (shard * tasks / shards).cast("int"))
             .sortWithinPartitions("slot")
             .mapInArrow(_writer(layout), "slot long, shard long, offset long, n_tokens int, doc_ids array<long>"))
    return layout, written(index, "shard-index")


def read_slots(layout: Layout, first: int, count: int) -> np.ndarray:
    """``count`` sequences from slot ``first`` on, as a reader that resumes there gets
    them: one seek, then sequential reads."""
    out = []
    to = min(first + count, layout.sequences)
    while first < to:
        file, offset = layout.place(first)
        n = min(to, (first // layout.per_shard + 1) * layout.per_shard) - first
        store, at = pafs.FileSystem.from_uri(file)
        with store.open_input_file(at) as data:
            out.append(np.frombuffer(data.read_at(n * layout.stride, offset), layout.dtype).reshape(n, layout.length))
        first += n
    return np.concatenate(out) if out else np.zeros((0, layout.length), layout.dtype)
