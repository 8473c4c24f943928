"""Token ids in variable-length files (operator 6).

Ids are ranked by frequency over the corpus, so common tokens get small
numbers. A rank takes 1 to 4 data bytes; its length goes into a separate control stream, four
2-bit codes to a byte. Readers get the lengths of four ranks from one lookup.
"""

from __future__ import annotations

import json
from array import array

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from basketlens.llm.common import delete_at_exit, give_back, stored
from basketlens.llm.pretokens import Memo, ends_in_space, rows_of
from basketlens.session import scratch_path

# characters of texts that are encoded before their rows go on
BLOCK_CHARS = 16 << 20

# entries of each generation of a worker's memos (of chunks, of pieces)
MEMO = 500_000

# ids in a block of the files (a longer document is a block of its own)
BLOCK_IDS = 1 << 20

# the lengths that a control byte's four codes stand for, first code in the low bits
LENGTHS = ((np.arange(256)[:, None] >> np.array([0, 2, 4, 6])) & 3).astype(np.uint8) + 1


def pack(ranks: np.ndarray) -> tuple[bytes, bytes]:
    """Control and data bytes of unsigned 32-bit ``ranks``."""
    ranks = ranks.astype("<u4")
    n = 1 + (ranks > 0xFF).astype(np.uint8) + (ranks > 0xFFFF) + (ranks > 0xFFFFFF)
    codes = np.zeros(-(-len(ranks) // 4) * 4, np.uint8)
    codes[:len(ranks)] = n - 1
    codes = codes.reshape(-1, 4)
    control = codes[:, 0] | codes[:, 1] << 2 | codes[:, 2] << 4 | codes[:, 3] << 6
    used = np.arange(4) < n[:, None]
    return control.astype(np.uint8).tobytes(), ranks.view(np.uint8).reshape(-1, 4)[used].tobytes()


def unpack(control: bytes, data: bytes, n: int) -> np.ndarray:
    """The ``n`` ranks of ``control`` and ``data``: lengths by table, then a gather."""
    lengths = LENGTHS[np.frombuffer(control, np.uint8)].ravel()[:n]
    ends = np.cumsum(lengths, dtype=np.int64)
    starts = ends - lengths
    raw = np.concatenate([np.frombuffer(data, np.uint8), np.zeros(3, np.uint8)])
    out = raw[starts].astype(np.uint32)
    for k in (1, 2, 3):
        longer = np.flatnonzero(lengths > k)
        if len(longer):
            out[longer] |= raw[starts[longer] + k].astype(np.uint32) << np.uint32(8 * k)
    return out


# How the byte-level pre-tokenizer cuts a text, and the letters that
# stand for bytes: printable ones for themselves, the others for the next from 256 on.
PIECES = regex.compile(
    r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+")
_PRINTED = {*range(33, 127), *range(161, 173), *range(174, 256)}
BYTE_LETTERS = {b: b for b in sorted(_PRINTED)} | {
    b: 256 + i for i, b in enumerate(b for b in range(256) if b not in _PRINTED)}


class ChunkEncoder:
    """Ids of texts by the tokenizers library: chunks are cut into pieces as its
    byte-level pre-tokenizer cuts them, its model encodes the pieces, each only once
    as long as the worker remembers it. One per worker process: later blocks and
    tasks find its memos again.

    Texts that can't be cut at spaces or hold an added token's string, and all
    texts of a tokenizer with another pre-tokenizer, take the library's whole way.
    """

    made: dict = {}

    @classmethod
    def of(cls, model: str, kind: str) -> ChunkEncoder:
        key = (hash(model), kind)
        if key not in cls.made:
            cls.made.clear()
            cls.made[key] = cls(model, kind)
        return cls.made[key]

    def __init__(self, model: str, kind: str):
        import os

        from tokenizers import Tokenizer

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        self.tokenizer, self.code = Tokenizer.from_str(model), "H" if kind == "<u2" else "I"
        self.added = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        cut = json.loads(model)["pre_tokenizer"] or {}
        self.whole = self.tokenizer.normalizer is not None or not (
            cut.get("type") == "ByteLevel" and cut.get("use_regex", True) and not cut.get("add_prefix_space", True))
        self.tokens = self.tokenizer.model.tokenize
        self.pieces, self.chunks = Memo(self.piece, MEMO), Memo(self.chunk, MEMO)

    def one(self, text: str) -> bytes:
        return array(self.code, self.tokenizer.encode(text, add_special_tokens=False).ids).tobytes()

    def piece(self, piece: str) -> bytes:
        letters = piece.encode().decode("latin-1").translate(BYTE_LETTERS)
        return array(self.code, [t.id for t in self.tokens(letters)]).tobytes()

    def chunk(self, chunk: str) -> bytes | None:
        """None for a chunk after which a text can't be cut."""
        if chunk.isalpha():
            return self.pieces[" " + chunk]
        return None if ends_in_space(chunk) else self.cut_up(" " + chunk)

    def cut_up(self, text: str) -> bytes:
        return b"".join(map(self.pieces.__getitem__, PIECES.findall(text)))

    def encode(self, text: str) -> bytes:
        first, *chunks = text.split(" ")
        if self.whole or not chunks or (first and ends_in_space(first)) or any(a in text for a in self.added):
            return self.one(text)
        parts = list(map(self.chunks.__getitem__, chunks))
        if None in parts:
            return self.one(text)
        if first:
            parts.insert(0, self.cut_up(first))
        return b"".join(parts)


def _blocks(batches, size: int = BLOCK_CHARS):
    """doc_ids and texts (null: empty), about ``size`` characters at a time."""
    ids, texts, n = [], [], 0
    for batch in batches:
        for doc_id, text in rows_of(batch):
            ids += doc_id
            texts += [t or "" for t in text]
            n += sum(map(len, texts[len(texts) - len(text):]))
            if n >= size:
                yield ids, texts
                ids, texts, n = [], [], 0
    if ids:
        yield ids, texts


def encode_ids(docs: DataFrame, tokenizer_path: str, end_id: int) -> DataFrame:
    """doc_id, ids (binary of little-endian integers), wide per row of ``docs``;
    and per task one more row without doc_id and ids whose ``counts`` holds how
    often each id occurred in the task.

    Integers have 2 bytes if the vocabulary (and the end id) fit, else 4 (wide).
    """
    from tokenizers import Tokenizer

    with open(tokenizer_path, encoding="utf-8") as f:
        model = f.read()
    most = max(Tokenizer.from_str(model).get_vocab_size() - 1, end_id)
    wide = most > 0xFFFF
    kind = "<u4" if wide else "<u2"
    shared = docs.sparkSession.sparkContext.broadcast(model)
    columns = ["doc_id", "ids", "counts"]

    def run(batches):
        encoder = ChunkEncoder.of(shared.value, kind)
        end = np.array([end_id], kind).tobytes()
        counts = np.zeros(most + 1, np.int64)
        for ids, texts in _blocks(batches):
            out = [encoder.encode(t) + end for t in texts]
            counts += np.bincount(np.frombuffer(b"".join(out), kind), minlength=most + 1)
            yield pa.record_batch([pa.array(ids, pa.int64()), pa.array(out, pa.binary()),
                                   pa.array([None] * len(out), pa.binary())], columns)
        yield pa.record_batch([pa.array([None], pa.int64()), pa.array([None], pa.binary()),
                               pa.array([counts.tobytes()], pa.binary())], columns)
        give_back()

    return (docs.select(F.col("doc_id").cast("long"), "text")
            .mapInArrow(run, "doc_id long, ids binary, counts binary").withColumn("wide", F.lit(wide)))


def id_ranks(encoded: DataFrame) -> np.ndarray:
    """rank by id: ids by falling count over all documents, ties to the smaller
    id; unused ids come last. A row per id that occurs reaches the driver, which
    the vocabulary bounds."""
    def run(batches):
        for batch in batches:
            for raw in batch.column("counts").to_pylist():
                counts = np.frombuffer(raw, np.int64)
                used = np.flatnonzero(counts)
                yield pa.record_batch([pa.array(used, pa.int64()), pa.array(counts[used], pa.int64())], ["id", "n"])

    rows = (encoded.filter("counts is not null").select("counts").mapInArrow(run, "id long, n long")
            .groupBy("id").agg(F.sum("n").alias("n")).collect())
    size = max((r["id"] for r in rows), default=0) + 1
    counts = np.zeros(size, np.int64)
    for r in rows:
        counts[r["id"]] = r["n"]
    ranks = np.empty(size, np.uint32)
    ranks[np.lexsort((np.arange(size), -counts))] = np.arange(size, dtype=np.uint32)
    return ranks


def write_token_files(docs: DataFrame, tokenizer_path: str, path: str, end_id: int = 0,
                      block_ids: int = BLOCK_IDS) -> np.ndarray:
    """Write all of ``docs`` (doc_id, text) to ``path`` in ascending doc_id order.

    ``path`` gets a Parquet folder whose rows are blocks: ``part`` and ``block``
    (the order), doc_ids, their id counts, and the control and data bytes.
    Returns the rank table's inverse (id by rank), which readers need. Null
    texts are empty (the end id alone); null doc_ids come first; rows with equal
    doc_id follow each other in an order that their texts fix.
    """
    key = stored(encode_ids(docs, tokenizer_path, end_id), "token-ids")
    ranks = id_ranks(key)
    key = key.filter("counts is null").select("doc_id", "ids", "wide")
    shared = key.sparkSession.sparkContext.broadcast(ranks)

    def run(batches):
        from pyspark import TaskContext

        part, block = TaskContext.get().partitionId(), 0
        ids, texts, size = [], [], 0

        def row():
            control, data = pack(shared.value[np.concatenate(texts)])
            return pa.record_batch(
                [pa.array([part], pa.int32()), pa.array([block], pa.int32()),
                 pa.array([ids], pa.list_(pa.int64())),
                 pa.array([[len(t) for t in texts]], pa.list_(pa.int64())),
                 pa.array([size], pa.int64()), pa.array([control], pa.binary()), pa.array([data], pa.binary())],
                ["part", "block", "doc_ids", "counts", "n", "control", "data"])

        for batch in batches:
            kind = "<u4" if batch.num_rows and batch.column("wide")[0].as_py() else "<u2"
            for at in range(0, batch.num_rows, 256):
                rows = batch.slice(at, 256)
                for doc_id, raw in zip(rows.column("doc_id").to_pylist(), rows.column("ids").to_pylist()):
                    ids.append(doc_id)
                    texts.append(np.frombuffer(raw, kind))
                    size += len(texts[-1])
                    if size >= block_ids:
                        yield row()
                        block, ids, texts, size = block + 1, [], [], 0
        if ids:
            yield row()

    # a second key spreads a doc_id that a large share of the rows has; the ids
    # themselves are no range key, as Spark samples those on the driver
    first = F.col("doc_id").asc_nulls_first()
    ordered = (key.withColumn("tie", F.xxhash64("ids")).repartitionByRange(first, "tie")
               .sortWithinPartitions(first, "tie", "ids").drop("tie"))
    (ordered.select("doc_id", "ids", "wide")
     .mapInArrow(run, "part int, block int, doc_ids array<bigint>, counts array<bigint>, n long, "
                      "control binary, data binary")
     .write.option("compression", "uncompressed").parquet(path))
    by_rank = np.empty(len(ranks), np.uint32)
    by_rank[ranks] = np.arange(len(ranks), dtype=np.uint32)
    return by_rank


def _located(spark: SparkSession, path: str) -> DataFrame:
    """The blocks with ``start``, the ids of all documents before them: sums per
    part, then per block inside a part. The starts are stored first, so that Spark
    knows their size and need not shuffle the blocks to join them."""
    blocks = spark.read.parquet(path)
    sums = blocks.groupBy("part").agg(F.sum("n").alias("n"))
    parts = sums.select("part", (F.sum("n").over(Window.orderBy("part")) - F.col("n")).alias("part_start"))
    inside = Window.partitionBy("part").orderBy("block")
    starts = (blocks.select("part", "block", (F.sum("n").over(inside) - F.col("n")).alias("block_start"))
              .join(parts, "part")
              .select("part", "block", (F.col("part_start") + F.col("block_start")).alias("start")))
    return blocks.join(stored(starts, "block-starts"), ["part", "block"]).select(
        "doc_ids", "counts", "control", "data", "start")


def _decoded(batches, by_rank: np.ndarray):
    """Per block: doc_ids, bounds of the documents in the block, start, ids."""
    for batch in batches:
        for i in range(batch.num_rows):
            row = {k: v[0] for k, v in batch.slice(i, 1).to_pydict().items()}
            bounds = np.concatenate([[0], np.cumsum(np.array(row["counts"], np.int64))])
            ids = by_rank[unpack(row["control"], row["data"], int(bounds[-1]))]
            yield pa.array(row["doc_ids"], pa.int64()), bounds, row["start"], ids


def read_token_files(spark: SparkSession, path: str, by_rank: np.ndarray) -> DataFrame:
    """doc_id, start (ids of all documents before it), ids (array) per document."""
    shared = spark.sparkContext.broadcast(by_rank)

    def run(batches):
        for doc_ids, bounds, start, ids in _decoded(batches, shared.value):
            yield pa.record_batch(
                [doc_ids, pa.array(start + bounds[:-1], pa.int64()),
                 pa.ListArray.from_arrays(pa.array(bounds, pa.int32()), pa.array(ids.astype(np.int64)))],
                ["doc_id", "start", "ids"])

    return _located(spark, path).mapInArrow(run, "doc_id long, start long, ids array<bigint>")


def token_file_digests(spark: SparkSession, path: str, by_rank: np.ndarray) -> DataFrame:
    """doc_id, start, n_tokens, ids_crc32 of the documents as the files have them."""
    import zlib

    shared = spark.sparkContext.broadcast(by_rank)

    def run(batches):
        for doc_ids, bounds, start, ids in _decoded(batches, shared.value):
            raw = ids.astype("<u4").tobytes()
            cuts = (4 * bounds).tolist()
            crc = [zlib.crc32(raw[a:b]) for a, b in zip(cuts[:-1], cuts[1:])]
            yield pa.record_batch([doc_ids, pa.array(start + bounds[:-1], pa.int64()),
                                   pa.array(np.diff(bounds), pa.int64()), pa.array(crc, pa.int64())],
                                  ["doc_id", "start", "n_tokens", "ids_crc32"])

    return _located(spark, path).mapInArrow(run, "doc_id long, start long, n_tokens long, ids_crc32 long")


def new_files(spark: SparkSession) -> str:
    """A fresh folder for token files below ``spark.checkpoint.dir``."""
    path = scratch_path(spark, "token-files")
    delete_at_exit(spark, path)
    return path
