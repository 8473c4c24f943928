"""Byte-level BPE by a global shuffle of distinct words (operator 10).

1. Documents are exploded into pre-tokens with positions, a block of documents
   at a time: a block keeps each of its distinct words once, dealt to parts by a
   hash of the word, and a layout with the words' numbers in text order.
2. The words are shuffled by part, many words of a block to a row. A part meets
   all blocks, so each distinct word is merged once; its ids go back to every
   block that holds it. Layouts pass along.
3. A block's words and its layout meet again, and the ids are put in the order
   of the positions.

A block's name is a digest of its rows, so a task that runs again names its
blocks alike, and blocks of equal rows share their (equal) words.

A word that makes up a third of all pre-tokens is one entry per block. Decoding
looks ids up in the token-byte table, whose size the vocabulary fixes.
"""

from __future__ import annotations

import base64
import hashlib
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from basketlens.llm.common import give_back
from basketlens.llm.merging import merge
from basketlens.llm.pretokens import by_chunk, ends_in_space, rows_of

# characters of text in a block (a single longer text is a block of its own): larger
# blocks repeat fewer words, smaller ones need less memory
BLOCK_SIZE = 12 << 20

ROWS = "block long, part int, packed binary, word_parts binary, doc_id array<bigint>, n array<int>"


def read_ranks(path: str) -> dict[bytes, int]:
    """A rank file: a line per token, its bytes in base64 and its id."""
    with open(path, "rb") as f:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, f)}


class _BlockChunks(dict):
    """chunk -> its slots as bytes; words get slots in the order they appear."""

    def __init__(self, find):
        super().__init__()
        self.words: dict[str, int] = {}
        self.find = find

    def slots(self, text: str) -> bytes:
        seen = self.words
        return b"".join([seen.setdefault(w, len(seen)).to_bytes(4, "little") for w in self.find(text)])

    def __missing__(self, chunk: str):
        value = self[chunk] = None if ends_in_space(chunk) else self.slots(" " + chunk)
        return value


def _compressed(raw: bytes, level: int = 3) -> bytes:
    import zstandard

    return zstandard.ZstdCompressor(level=level).compress(raw)


def _plain(packed: bytes) -> bytes:
    import zstandard

    return zstandard.ZstdDecompressor().decompress(packed)


def _pack(numbers: np.ndarray) -> bytes:
    """32-bit numbers as four byte planes, compressed: the later ones are almost
    all zero."""
    planes = numbers.astype("<u4").view(np.uint8).reshape(-1, 4).T
    return _compressed(np.ascontiguousarray(planes).tobytes())


def _unpack(packed: bytes) -> np.ndarray:
    planes = np.frombuffer(_plain(packed), np.uint8).reshape(4, -1)
    return np.ascontiguousarray(planes.T).view("<u4").ravel()


def _pack_words(words: list[bytes]) -> bytes:
    sizes = np.array([len(w) for w in words], "<u4")
    return _compressed(len(words).to_bytes(4, "little") + sizes.tobytes() + b"".join(words), 6)


def _unpack_words(packed: bytes) -> list[bytes]:
    raw = _plain(packed)
    n = int.from_bytes(raw[:4], "little")
    ends = 4 + 4 * n + np.cumsum(np.frombuffer(raw, "<u4", n, 4), dtype=np.int64)
    starts = [4 + 4 * n, *ends.tolist()]
    return [raw[a:b] for a, b in zip(starts[:-1], starts[1:])]


def _explode(pattern: str, block_size: int, parts: int):
    """mapInArrow function: per block a row for each part with words, and a row
    with the layout and the words' parts (part below 0, any of them)."""
    def blocks(batches):
        ids, texts, size = [], [], 0
        for batch in batches:
            for doc_id, text in rows_of(batch, 64):
                for i, t in zip(doc_id, text):
                    ids.append(i)
                    texts.append(t or "")
                    size += len(texts[-1])
                    if size >= block_size:
                        full, ids, texts, size = (ids, texts), [], [], 0
                        yield full
                        del full
        if ids:
            yield ids, texts

    def run(batches):
        import regex

        find = regex.compile(pattern).findall
        for ids, texts in blocks(batches):
            chunks, layout, counts = _BlockChunks(find), [], []
            name = hashlib.blake2b(repr((ids, [len(t) for t in texts])).encode(), digest_size=8)
            for text in texts:
                name.update(text.encode())
                found = by_chunk(text, chunks, chunks.slots)
                slots = chunks.slots(text) if found is None else b"".join(found)
                layout.append(slots)
                counts.append(len(slots) // 4)
            block = int.from_bytes(name.digest(), "little", signed=True)
            slots = np.frombuffer(b"".join(layout), "<u4")
            # common words get small numbers, which pack well
            by_count = np.argsort(-np.bincount(slots, minlength=len(chunks.words)), kind="stable")
            number = np.empty(len(by_count), np.uint32)
            number[by_count] = np.arange(len(by_count), dtype=np.uint32)
            words = [w.encode() for w in chunks.words]
            words = [words[i] for i in by_count]
            part = np.array([zlib.crc32(w) % parts for w in words], np.uint32)
            order = np.argsort(part, kind="stable")
            out = [(block, -1 - (block % parts), _pack(number[slots]), _pack(part), ids, counts)]
            cuts = np.flatnonzero(np.diff(part[order].astype(np.int64), prepend=-1, append=parts + 1))
            for a, b in zip(cuts[:-1], cuts[1:]):
                out.append((block, int(part[order[a]]), _pack_words([words[i] for i in order[a:b]]), None, None, None))
            # freed before the next block is read
            del chunks, layout, slots, words, number, by_count, part, order, found, texts, ids
            yield _rows(*zip(*out))
            del out
        give_back()
    return run


def _rows(block, part, packed, word_parts, doc_id, n) -> pa.RecordBatch:
    return pa.record_batch(
        [pa.array(block, pa.int64()), pa.array(part, pa.int32()), pa.array(packed, pa.binary()),
         pa.array(word_parts, pa.binary()), pa.array(doc_id, pa.list_(pa.int64())), pa.array(n, pa.list_(pa.int32()))],
        ["block", "part", "packed", "word_parts", "doc_id", "n"])


def _word_ids(ranks):
    """mapInArrow over whole parts: the words of each row become their ids, layouts
    stay. A part's words are all in this task, so its dictionary merges each distinct
    word once; the number of parts bounds the dictionary."""
    def run(batches):
        table = ranks.value

        class Ids(dict):
            def __missing__(self, word):
                whole = table.get(word)
                pieces = [whole] if whole is not None else [
                    table[p] for p in merge([word[i:i + 1] for i in range(len(word))], table)]
                ids = self[word] = np.array(pieces, "<u4").tobytes()
                return ids

        known = Ids()
        for batch in batches:
            out = []
            for part, packed in zip(batch.column("part").to_pylist(), batch.column("packed").to_pylist()):
                if part < 0:
                    out.append(packed)
                    continue
                ids = list(map(known.__getitem__, _unpack_words(packed)))
                sizes = np.array([len(x) // 4 for x in ids], np.uint32)
                out.append(_pack(np.concatenate([[len(ids)], sizes, np.frombuffer(b"".join(ids), "<u4")])))
            yield batch.set_column(batch.schema.get_field_index("packed"), "packed", pa.array(out, pa.binary()))
        known.clear()
        give_back()
    return run


def _bytes_of(ids: np.ndarray, ends: list[int], look) -> list[bytes]:
    """The bytes of documents whose ids end at ``ends``, by the token-byte table."""
    raw = list(map(look, ids.tolist()))
    return [b"".join(raw[a:b]) for a, b in zip([0, *ends[:-1]], ends)]


def _reassemble(table: pa.Table, look=None) -> pa.Table:
    """One block: its words' ids and its layout -> doc_id, ids per document; and
    decoded, the bytes of those ids, if ``look`` is the token-byte table's lookup."""
    rows = table.to_pylist()
    layouts = [r for r in rows if r["part"] < 0]
    # 32-bit positions: a block has far fewer than 2 ** 31 ids
    sizes, values = [np.zeros(0, np.int32)], [np.zeros(0, np.uint32)]
    for _, packed in sorted({r["part"]: r["packed"] for r in rows if r["part"] >= 0}.items()):
        numbers = _unpack(packed)
        n = int(numbers[0])
        sizes.append(numbers[1:n + 1].astype(np.int32))
        values.append(numbers[n + 1:])
    found, values = np.concatenate(sizes), np.concatenate(values)
    out = []
    for layout in layouts:
        # words came by part; their numbers are by count
        number = np.argsort(_unpack(layout["word_parts"]), kind="stable")
        length, start = np.empty(len(found), np.int32), np.empty(len(found), np.int32)
        length[number] = found
        start[number] = np.cumsum(found, dtype=np.int32) - found
        order = _unpack(layout["packed"])
        n = length[order]
        ends = np.cumsum(n, dtype=np.int32)
        at = np.repeat(start[order] - (ends - n), n)
        at += np.arange(len(at), dtype=np.int32)
        flat = values[at]
        words = np.concatenate([[0], np.cumsum(np.array(layout["n"], np.int64))])
        bounds = np.concatenate([[0], ends])[words]
        columns = {"doc_id": pa.array(layout["doc_id"], pa.int64()),
                   "ids": pa.ListArray.from_arrays(pa.array(bounds, pa.int32()), pa.array(flat.astype(np.int32)))}
        if look:
            columns["decoded"] = pa.array(
                [x for a in range(0, len(bounds) - 1, 64) for x in _bytes_of(
                    flat[bounds[a]:bounds[min(a + 64, len(bounds) - 1)]],
                    (bounds[a + 1:a + 65] - bounds[a]).tolist(), look)], pa.binary())
        out.append(pa.table(columns))
    return pa.concat_tables(out)


def encode(docs: DataFrame, ranks_path: str, pattern: str, block_size: int = BLOCK_SIZE,
           parts: int | None = None, decoded: bool = False) -> DataFrame:
    """doc_id, ids (array of int) per row of ``docs`` (doc_id, text); with
    ``decoded``, also ``decode``'s column, made where the ids are put together.

    The ids are those of merging each match of ``pattern`` by the ranks in
    ``ranks_path``; no special tokens. ``parts``: groups of words, by default
    twice the shuffle partitions. Null and empty texts: an empty array. Repeated
    rows are encoded as often; null doc_ids stay; an empty table gives no rows.
    """
    spark = docs.sparkSession
    parts = parts or 2 * int(spark.conf.get("spark.sql.shuffle.partitions"))
    ranks = spark.sparkContext.broadcast(read_ranks(ranks_path))
    tokens = _token_bytes(spark, ranks_path) if decoded else None

    def together(table: pa.Table) -> pa.Table:
        return _reassemble(table, tokens.value.__getitem__ if tokens else None)

    return (docs.select(F.col("doc_id").cast("long"), "text")
            .mapInArrow(_explode(pattern, block_size, parts), ROWS)
            .repartition("part").mapInArrow(_word_ids(ranks), ROWS)
            .groupBy("block").applyInArrow(together, "doc_id long, ids array<int>" + ", decoded binary" * decoded))


def _token_bytes(spark, ranks_path: str):
    """The token-byte table: a row per token, so it is broadcast at any input size."""
    return spark.sparkContext.broadcast({rank: token for token, rank in read_ranks(ranks_path).items()})


def decode(encoded: DataFrame, ranks_path: str) -> DataFrame:
    """Adds ``decoded`` (binary): each id's bytes by the token-byte table, in order.

    The table has a row per token, so it is broadcast whatever the size of
    ``encoded``. Null ids give null; an id outside the table is an error.
    """
    tokens = _token_bytes(encoded.sparkSession, ranks_path)

    def run(batches):
        look = tokens.value.__getitem__
        for batch in batches:
            out = []
            ids = batch.column("ids")
            for at in range(0, batch.num_rows, 64):
                part = ids.slice(at, 64)
                sizes = [0 if n is None else n for n in part.value_lengths().to_pylist()]
                found = _bytes_of(part.flatten().to_numpy(), np.cumsum(sizes).tolist(), look)
                out += [x if ok else None for x, ok in zip(found, part.is_valid().to_pylist())]
            yield batch.append_column("decoded", pa.array(out, pa.binary()))

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in encoded.schema)
    return encoded.mapInArrow(run, schema + ", decoded binary")
