"""Byte-level BPE encoding and decoding through a distinct-word table.

**Encode.** Spark splits the texts into words (the tokenizer's own pattern, in
the JVM). ``BLOCK`` documents are a block: its distinct words go, packed by hash bucket, to the task of their bucket, its documents become arrays of
positions in the block's word list. A bucket's task sees the words of all
blocks, makes its part of the distinct-word table, encodes each distinct word
once and answers every block with the ids of its words. Block and answers meet
by the block's key (the hash of its words), and positions become ids.

A frequent word is sent once per block, not once per occurrence, so no bucket
is hot; a block is bounded by its rows and words, or one document; texts themselves are never shuffled. Blocks and words are dealt by one
exchange, which both steps read.

**Decode.** Ids meet the id-to-piece table by an Arrow lookup join in each task:
the table has one row per id of the vocabulary (50,257 here), a size that no
input changes, so every task holds it. Pieces of a document are concatenated
bytes, read as UTF-8 with U+FFFD for what isn't.

Nulls: a null text is empty and has no ids; null ids decode to the empty text;
ids that the vocabulary lacks are skipped. Rows with equal or null document ids
are each encoded. Strings of special tokens in a text get their special ids, as
the library does by default.
"""

from __future__ import annotations

import functools
import hashlib
import json
import os
import re

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import _util

VOCABULARY = "byte_bpe_50k.json"
CHUNK = 1 << 19
BLOCK, BLOCK_WORDS = 5_000, 2 << 20  # documents of a block, words after which it ends


def vocabulary_path(name: str = VOCABULARY) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


@functools.cache
def _tokenizer(path: str):
    # a task has one core; threads of the library's own would each keep memory in the worker
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(path)
    t.no_truncation()
    t.no_padding()
    return t


@functools.cache
def pieces_of(path: str) -> pa.Array:
    """Bytes of every id, in id order; null where there is no such id."""
    with open(path, encoding="utf-8") as f:
        spec = json.load(f)
    # fixed values: the bytes that byte-level BPE writes as themselves; the others follow from code point 256 on
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = [b for b in range(256) if b not in plain]
    to_byte = {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(others)}
    table: dict[int, bytes] = {}
    for token, i in spec["model"]["vocab"].items():
        table[i] = bytes(to_byte[c] for c in token)
    for t in spec["added_tokens"]:
        table[t["id"]] = t["content"].encode()
    return pa.array([table.get(i) for i in range(max(table) + 1)], pa.binary())


def word_pattern(path: str) -> str:
    """Java pattern of the tokenizer's words; special tokens are words of their own."""
    with open(path, encoding="utf-8") as f:
        specials = [t["content"] for t in json.load(f)["added_tokens"]]
    quoted = "|".join(re.sub(r"([^\w<>])", r"\\\1", s) for s in sorted(specials, key=len, reverse=True))
    stop = f"(?!{quoted})" if quoted else ""
    first = f"{quoted}|" if quoted else ""
    # fixed values: the split pattern of byte-level BPE, as published
    return (
        rf"(?U){first}'s|'t|'re|'ve|'m|'ll|'d| ?\p{{L}}++| ?\p{{N}}++"
        rf"| ?(?:{stop}[^\s\p{{L}}\p{{N}}])++|\s+(?!{stop}\S)|\s+"
    )


def _pack(arrays: dict[str, pa.Array]) -> bytes:
    sink = pa.BufferOutputStream()
    batch = pa.record_batch(list(arrays.values()), names=list(arrays))
    with pa.ipc.new_stream(sink, batch.schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as w:
        w.write_batch(batch)
    return sink.getvalue().to_pybytes()


def _unpack(payload) -> pa.RecordBatch:
    with pa.ipc.open_stream(payload.as_buffer()) as r:
        return r.read_next_batch()


def _small(x: np.ndarray) -> pa.Array:
    top = int(x.max(initial=0))
    return pa.array(x.astype(np.uint8 if top < 256 else np.uint16 if top < 65536 else np.uint32))


def encode(docs: DataFrame, path: str | None = None, id_col: str = "doc_id", text_col: str = "text", buckets: int | None = None, finish=None, columns: str = "token_ids array<int>") -> DataFrame:
    """(id, token_ids): the token ids of every row's whole text.

    ``buckets`` of the distinct-word table: 4 times the shuffle partitions unless given.
    ``finish`` turns an array of id lists into the arrays of ``columns`` in the task
    that made it; without it the lists themselves are returned."""
    path = path or vocabulary_path()
    spark = docs.sparkSession
    _util.small_batches(spark)
    buckets = buckets or 4 * int(spark.conf.get("spark.sql.shuffle.partitions"))
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    split = docs.select(F.col(id_col).alias("id"), F.regexp_extract_all(text, F.lit(word_pattern(path)), F.lit(0)).alias("words"))
    kind = dict(split.dtypes)["id"]

    def gathered(batches):
        held, rows, words = [], 0, 0
        for batch in batches:
            held.append(batch)
            rows += len(batch)
            words += len(batch.column(1).flatten())
            if rows >= BLOCK or words >= BLOCK_WORDS:
                yield pa.Table.from_batches(held).combine_chunks()
                held, rows, words = [], 0, 0
        if rows:
            yield pa.Table.from_batches(held).combine_chunks()

    def blocks(batches):
        for table in gathered(batches):
            ids, lists = (pa.concat_arrays(table.column(i).chunks) for i in (0, 1))
            del table
            words = lists.flatten().dictionary_encode()
            counts = pc.list_value_length(lists).to_numpy(zero_copy_only=False).astype(np.int64)
            seal = hashlib.blake2b(digest_size=8)
            hashed = []
            for _, _, data, offsets in _util.pieces(words.dictionary, 1 << 18):
                seal.update(data.tobytes() + offsets.tobytes())
                hashed.append((_util.RangeHash(data)(offsets[:-1], offsets[1:]) % np.uint64(buckets)).astype(np.int32))
            bucket = np.concatenate([np.zeros(0, np.int32), *hashed])
            order = np.argsort(bucket, kind="stable")
            rank = np.empty(len(order), np.int32)
            rank[order] = np.arange(len(order), dtype=np.int32)
            sorted_words = words.dictionary.take(pa.array(order))
            block = f"b{seal.hexdigest()}{len(order):x}"
            code_of = np.asarray(words.indices)
            del words, lists
            at = np.searchsorted(bucket[order], np.arange(buckets + 1))
            keys, owner, number, id_lists, payload = [], [], [], [], []
            for b in np.flatnonzero(at[1:] > at[:-1]):
                keys.append(f"w{b}")
                owner.append(block)
                number.append(int(b))
                id_lists.append(None)
                payload.append(_pack({"word": sorted_words[at[b] : at[b + 1]]}))
            first = np.concatenate([[0], np.cumsum(counts)])
            lo = 0
            while lo < len(counts):
                hi = max(lo + 1, int(np.searchsorted(first, first[lo] + CHUNK, "right")) - 1)
                keys.append(block)
                owner.append(block)
                number.append(-1)
                id_lists.append(ids[lo:hi].to_pylist())
                # lengths and positions are of different lengths: two messages in one row
                a, c = _pack({"n": pa.array(counts[lo:hi])}), _pack({"c": _small(rank[code_of[first[lo] : first[hi]]])})
                payload.append(len(a).to_bytes(8, "little") + a + c)
                lo = hi
            yield pa.RecordBatch.from_arrays(
                [pa.array(keys, pa.string()), pa.array(owner, pa.string()), pa.array(number, pa.int32()), pa.array(id_lists, pa.list_(ids.type)), pa.array(payload, pa.binary())],
                names=["key", "block", "bucket", "ids", "payload"],
            )

    dealt = split.mapInArrow(_util.lean(blocks), f"key string, block string, bucket int, ids array<{kind}>, payload binary").repartition("key")

    def answer(group: pa.Table) -> pa.Table:
        """The bucket's part of the distinct-word table, and its words' ids for every block."""
        own = group.filter(pc.greater_equal(group["bucket"], 0))
        out = {"key": [], "bucket": [], "payload": []}
        if own.num_rows:
            lists = [_unpack(p).column(0) for p in own["payload"]]
            every = pa.chunked_array(lists).combine_chunks().dictionary_encode()
            # the table: one row for each distinct word
            table, tokenizer = every.dictionary, _tokenizer(path)
            encoded = [e.ids for lo in range(0, len(table), 50_000) for e in tokenizer.encode_batch_fast(table[lo : lo + 50_000].to_pylist(), add_special_tokens=False)]
            lengths = np.fromiter(map(len, encoded), np.int64, len(encoded))
            flat = np.fromiter((i for e in encoded for i in e), np.int32, int(lengths.sum()))
            ids = pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(lengths)]).astype(np.int32)), pa.array(flat))
            at, seen = 0, set()
            for words, block in zip(lists, own["block"].to_pylist(), strict=True):
                part = ids.take(every.indices[at : at + len(words)])
                at += len(words)
                if block in seen:
                    continue
                seen.add(block)
                a = _pack({"n": _small(pc.list_value_length(part).to_numpy(zero_copy_only=False))})
                out["key"].append(block)
                out["bucket"].append(own["bucket"][0].as_py())
                out["payload"].append(len(a).to_bytes(8, "little") + a + _pack({"i": _small(part.flatten().to_numpy(zero_copy_only=False))}))
            del every, table, encoded, lengths, flat, ids, lists
            _util.trim()
        return pa.table(out, pa.schema([("key", pa.string()), ("bucket", pa.int32()), ("payload", pa.binary())]))

    answers = dealt.groupBy("key").applyInArrow(answer, "key string, bucket int, payload binary")

    def two(payload) -> tuple[np.ndarray, np.ndarray]:
        buffer = payload.as_buffer()
        cut = 8 + int.from_bytes(buffer[:8].to_pybytes(), "little")
        parts = []
        for part in (buffer[8:cut], buffer[cut:]):
            with pa.ipc.open_stream(part) as r:
                parts.append(r.read_next_batch().column(0).to_numpy(zero_copy_only=False).astype(np.int64))
        return parts[0], parts[1]

    def place(block: pa.Table, replies: pa.Table) -> pa.Table:
        own = block.filter(pc.less(block["bucket"], 0))
        out = []
        if own.num_rows:
            got = [two(p) for p in replies.sort_by("bucket")["payload"]]
            offsets = np.concatenate([[0], np.cumsum(np.concatenate([np.zeros(0, np.int64), *[g[0] for g in got]]))])
            table = pa.ListArray.from_arrays(pa.array(offsets.astype(np.int32)), pa.array(np.concatenate([np.zeros(0, np.int64), *[g[1] for g in got]]).astype(np.int32)))
            for ids, payload in zip(own["ids"], own["payload"], strict=True):
                counts, code = two(payload)
                taken = table.take(pa.array(code))
                ends = np.concatenate([[0], np.cumsum(pc.list_value_length(taken).to_numpy(zero_copy_only=False))])
                bounds = ends[np.concatenate([[0], np.cumsum(counts)])]
                out.append((ids.values, *made(pa.ListArray.from_arrays(pa.array(bounds.astype(np.int32)), taken.flatten()))))
        if not out:
            out = [(pa.array([], block.schema.field("ids").type.value_type), *made(pa.array([], pa.list_(pa.int32()))))]
        else:
            _util.trim()
        return pa.table([pa.chunked_array(list(c)) for c in zip(*out, strict=True)], names=["id", *added])

    made = finish or (lambda lists: [lists])
    added = [f.name for f in T._parse_datatype_string(columns).fields]
    placed = dealt.groupBy("key").cogroup(answers.groupBy("key")).applyInArrow(place, f"id {kind}, {columns}")
    return placed.select(F.col("id").alias(id_col), *added)


def decode_lists(lists: pa.Array, pieces: pa.Array) -> list[bytes]:
    """Bytes of each row's pieces."""
    lists = lists.fill_null([]) if lists.null_count else lists
    ids = lists.flatten()
    known = pc.and_kleene(pc.less(ids, len(pieces)), pc.greater_equal(ids, 0)).fill_null(False)
    taken = pieces.take(pc.if_else(known, ids, pa.scalar(0, ids.type)))
    taken = pc.if_else(known, taken, pa.scalar(b"")).fill_null(b"")
    data, offsets = _util.bytes_of(taken)
    bounds = offsets[np.concatenate([[0], np.cumsum(pc.list_value_length(lists).to_numpy(zero_copy_only=False))]).astype(np.int64)]
    whole = data.tobytes()
    return [whole[a:b] for a, b in zip(bounds[:-1], bounds[1:], strict=True)]


def decode(encoded: DataFrame, path: str | None = None, id_col: str = "doc_id") -> DataFrame:
    """(id, text) of rows (id, token_ids)."""
    path = path or vocabulary_path()

    def run(batches):
        pieces = pieces_of(path)
        for batch in batches:
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(_decoded(batch.column(1), pieces), pa.string())], names=[id_col, "text"])

    own = encoded.select(id_col, "token_ids")
    return own.mapInArrow(_util.lean(run), _util.extended(own.select(id_col), text="string"))


def _decoded(lists: pa.Array, pieces: pa.Array):
    """Texts of each row's pieces, a bounded number of pieces at a time."""
    first = np.concatenate([[0], np.cumsum(pc.list_value_length(lists).fill_null(0).to_numpy(zero_copy_only=False))]).astype(np.int64)
    lo = 0
    while lo < len(lists):
        hi = max(lo + 1, int(np.searchsorted(first, first[lo] + CHUNK, "right")) - 1)
        for b in decode_lists(lists[lo:hi], pieces):
            yield b.decode("utf-8", "replace")
        lo = hi


def digest(docs: DataFrame, path: str | None = None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Encode, decode, and report both: id, n_tokens, ids_sha256, decoded_sha256."""
    path = path or vocabulary_path()

    def finish(lists):
        ids = [np.asarray(r.values, np.uint32).astype("<u4").tobytes() for r in lists]
        text = _decoded(lists, pieces_of(path))
        return [
            pa.array([len(i) // 4 for i in ids], pa.int64()),
            pa.array([hashlib.sha256(i).hexdigest() for i in ids], pa.string()),
            pa.array([hashlib.sha256(t.encode()).hexdigest() for t in text], pa.string()),
        ]

    return encode(docs, path, id_col, text_col, None, finish, "n_tokens long, ids_sha256 string, decoded_sha256 string")


def round_trip(docs: DataFrame, path: str | None = None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, token_ids, n_tokens, text): what every row encodes to, and what that decodes to."""
    path = path or vocabulary_path()

    def finish(lists):
        return [lists, pc.list_value_length(lists).cast(pa.int64()), pa.array(_decoded(lists, pieces_of(path)), pa.string())]

    return encode(docs, path, id_col, text_col, None, finish, "token_ids array<int>, n_tokens long, text string")
