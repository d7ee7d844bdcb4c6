"""Removal of byte strings that repeat anywhere in the corpus, by suffix arrays.

A byte goes if a string of ``LENGTH`` bytes that covers it also starts anywhere
else, in the same text or another; overlaps count, and matches never cross texts.

One suffix array over the corpus would not fit a machine, so the corpus is cut
into shards such that equal strings always meet in one shard:

1. Equal texts are one text with a count, so a group of copies is one row.
2. The key of a window of ``LENGTH`` bytes is the least hash of the ``GRAM``-byte
   strings in it: a function of its content, which neighbouring windows mostly
   share. Each run of windows with one key is a region. A string that starts
   twice has one key in both places, so a key that occurs once needs no look.
3. Regions of the other keys go to shards by key, each distinct content once,
   with its count. The suffix array of a shard is made by induced sorting (run-length
   coded: a region's count stands for equal neighbours), the permuted common
   prefixes are computed from it, and windows whose common prefix with a neighbour
   reaches ``LENGTH`` are marked.
4. Marks go back to all places of their region and are merged for each text.

Hashes only choose the shard: two contents with one key are compared there. What
says that two texts or two regions are equal is a strong digest (128 bits of SHA-256
or BLAKE2b of the whole content), which no two known strings share.

A key whose distinct regions outgrow a shard (one passage amid many different
neighbours) is cut again, in the same way, by longer strings (``LEVELS``): windows
that share the longer string too stay together. At the last level the string is the
window itself, so its regions are copies of one content and their number is a count.

Nulls and empty texts have no bytes and lose none. Rows are judged each by their
text, whatever their ids, and repeated rows make each other repeat. Texts whose
kept bytes are no longer UTF-8 (a cut inside a character) lose the broken
character's other bytes in :func:`clean`; the digest is taken of the bytes.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import _util, suffix

LENGTH, GRAM, MOST_WINDOWS, SHARD = 200, 32, 2048, 2 << 20
LEVELS = (0.64, 0.88, 0.96, 0.99, 1.0)  # lengths of the strings that cut a hot key again, as shares of LENGTH
LONG = 1 << 23  # bytes whose places fit beside a hash
STOP = 0xFF  # in no UTF-8 text


def _identity(text: Column) -> list[Column]:
    """128 bits that stand for a text: two longs of its SHA-256."""
    sha = F.sha2(text, 256)
    return [F.conv(F.substring(sha, at, 16), 16, -10).cast("long").alias(name) for name, at in (("t1", 1), ("t2", 17))]


def _digests(whole: bytes, first: np.ndarray, stop: np.ndarray) -> pa.Array:
    """BLAKE2b of 128 bits of each part of ``whole``."""
    made = b"".join([hashlib.blake2b(whole[a:b], digest_size=16).digest() for a, b in zip(first.tolist(), stop.tolist(), strict=True)])
    ends = np.arange(0, len(made) + 1, 16, dtype=np.int32)
    return pa.Array.from_buffers(pa.binary(), len(first), [None, pa.py_buffer(ends), pa.py_buffer(made)])


def _texts(docs: DataFrame, text_col: str) -> DataFrame:
    """(t1, t2, text, copies): the distinct texts of ``docs``."""
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    return docs.select(text.alias("text")).select(*_identity(F.col("text")), "text").groupBy("t1", "t2").agg(F.max("text").alias("text"), F.count("*").alias("copies"))


def windows(data: np.ndarray, offsets: np.ndarray, length: int = LENGTH, gram: int = GRAM) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """The regions of some texts: first window, number of windows, key, and
    whether equal windows may lie within the region itself. They can only if the
    leftmost place of the least hash moves from its first window to its last."""
    n, width = len(data), length - gram + 1
    none = np.zeros(0, np.int64)
    if n < length:
        return none, none, none, none
    if n > LONG:
        parts = []
        for a, b in zip(offsets[:-1], offsets[1:], strict=True):
            for c in range(a, max(a + 1, b - length + 1), LONG - length + 1):
                own = data[c : min(b, c + LONG)]
                first, *rest = windows(own, np.array([0, len(own)]), length, gram)
                parts.append((first + c, *rest))
        return tuple(np.concatenate(x) for x in zip(*parts, strict=True))
    lens = np.diff(offsets)
    ok = np.arange(n) <= np.repeat(offsets[1:] - length, lens)
    at = np.arange(n - gram + 1)
    h = _util.gram_hashes(data, gram)
    low = np.uint64((1 << 24) - 1)
    blocks = -(-len(h) // width) + 1
    full = np.full(blocks * width, np.iinfo(np.uint64).max, np.uint64)
    full[: len(h)] = (h & ~low) | at.astype(np.uint64)  # the place breaks ties
    grid = full.reshape(blocks, width)
    left = np.minimum.accumulate(grid, axis=1).reshape(-1)
    right = np.minimum.accumulate(grid[:, ::-1], axis=1)[:, ::-1].reshape(-1)
    m = n - length + 1
    place = (np.minimum(right[:m], left[width - 1 : width - 1 + m]) & low).astype(np.int64)
    key = h[place]
    ok = ok[:m]
    change = np.concatenate([[True], key[1:] != key[:-1]])
    start = np.flatnonzero(ok & (change | np.concatenate([[True], ~ok[:-1]])))
    stop = np.flatnonzero(ok & np.concatenate([change[1:] | ~ok[1:], [True]])) + 1
    count = stop - start
    parts = -(-count // MOST_WINDOWS)
    if len(parts) and parts.max() > 1:
        which = np.repeat(np.arange(len(start)), parts)
        nth = np.arange(len(which)) - np.repeat(np.concatenate([[0], np.cumsum(parts)[:-1]]), parts)
        start, count = start[which] + nth * MOST_WINDOWS, np.minimum(count[which] - nth * MOST_WINDOWS, MOST_WINDOWS)
    return start, count, key[start], place[start] != place[start + count - 1]


def _regions(texts: DataFrame, length: int, keys_only: bool) -> DataFrame:
    """Regions of rows (t1, t2, text, copies): key and copies, or all of
    (key, h, t1, t2, first, n, copies); ``h`` is the digest of the content."""

    def run(batches):
        for batch in batches:
            t1, t2, text, copies = (batch.column(i) for i in range(4))
            for lo, hi, data, offsets in _util.pieces(text, 1 << 18):
                first, n, key, within = windows(data, offsets, length)
                row = np.searchsorted(offsets, first, "right") - 1
                weight = np.asarray(copies)[lo:hi][row]
                if keys_only:
                    unique, inverse = np.unique(key, return_inverse=True)
                    total = np.bincount(inverse, weight * (1 + within), len(unique)).astype(np.int64)
                    yield pa.RecordBatch.from_arrays([pa.array(unique.view(np.int64)), pa.array(total)], names=["key", "copies"])
                else:
                    h = _digests(data.tobytes(), first, first + n + length - 1)
                    start = (first - offsets[row]).astype(np.int32)
                    cols = [key.view(np.int64), np.asarray(t1)[lo:hi][row], np.asarray(t2)[lo:hi][row], start, n.astype(np.int32), weight]
                    cols = [pa.array(c) for c in cols]
                    yield pa.RecordBatch.from_arrays([cols[0], h, *cols[1:]], names=["key", "h", "t1", "t2", "first", "n", "copies"])

    schema = "key long, copies long" if keys_only else "key long, h binary, t1 long, t2 long, first int, n int, copies long"
    return texts.select("t1", "t2", "text", "copies").mapInArrow(_util.lean(run), schema)


CONTENT = "key long, h binary, copies long, size int, content binary"


def _contents(texts: DataFrame, places: DataFrame, length: int) -> DataFrame:
    """(key, h, copies, size, content) of regions (key, h, copies, t1, t2, first, n)."""
    grouped = places.groupBy("t1", "t2").agg(F.collect_list(F.struct("key", "h", "first", "n", F.col("copies").alias("c"))).alias("wanted"))
    joined = texts.join(grouped, ["t1", "t2"]).select("t1", "t2", "text", "copies", "wanted")

    def run(batches):
        for batch in batches:
            data, offsets = _util.bytes_of(batch.column(2))
            wanted = batch.column(4)
            row = np.repeat(np.arange(len(wanted)), pc.list_value_length(wanted).to_numpy(zero_copy_only=False))
            flat = wanted.flatten()
            first = np.asarray(flat.field("first")).astype(np.int64) + offsets[row]
            stop = first + np.asarray(flat.field("n")) + length - 1
            whole = data.tobytes()
            for lo in range(0, len(row), 8192):
                part = slice(lo, lo + 8192)
                content = [whole[a:b] for a, b in zip(first[part], stop[part], strict=True)]
                cut = flat.slice(lo, 8192)
                size = pa.array((stop[part] - first[part]).astype(np.int32))
                yield pa.RecordBatch.from_arrays([cut.field("key"), cut.field("h"), cut.field("c"), size, pa.array(content, pa.binary())], names=["key", "h", "copies", "size", "content"])

    return joined.mapInArrow(_util.lean(run), CONTENT)


def mark(contents: list[bytes], copies: np.ndarray, length: int = LENGTH) -> list[np.ndarray]:
    """For each region the windows (offsets) that start elsewhere too, by the
    suffix array of all.

    The array is run-length coded: a region that occurs several times stands in it
    once, and each of its suffixes for as many neighbours with the whole rest of
    the region in common, so its windows repeat without a look at other regions."""
    sizes = np.array([len(c) for c in contents], np.int32)
    begin = np.concatenate([[0], np.cumsum(sizes + 1)]).astype(np.int32)
    t = np.frombuffer(bytes([STOP]).join(contents) + bytes([STOP]), np.uint8)
    before, plcp = suffix.common_prefixes(t, suffix.suffix_array(t))
    hit = plcp >= length
    del plcp
    region = np.repeat(np.arange(len(contents), dtype=np.int32), sizes + 1)
    whole = (begin[1:] - 1)[region] - np.arange(len(t), dtype=np.int32) >= length
    hit = np.flatnonzero(hit & whole)
    repeated = whole & (np.asarray(copies) > 1)[region]
    repeated[hit] = True
    repeated[before[hit]] = True
    found = np.flatnonzero(repeated)
    region = region[found]
    offset = found - begin[region]
    bounds = np.searchsorted(region, np.arange(len(contents) + 1))
    return [offset[a:b] for a, b in zip(bounds[:-1], bounds[1:], strict=True)]


def _spans(offsets: np.ndarray, length: int) -> list[int]:
    """first, stop, first, stop ... of the bytes that windows at these offsets cover."""
    if not len(offsets):
        return []
    new = np.flatnonzero(np.concatenate([[True], np.diff(offsets) > length]))
    stop = np.append(offsets[new[1:] - 1], offsets[-1]) + length
    return np.stack([offsets[new], stop], 1).reshape(-1).tolist()


def _sharded(contents: DataFrame, length: int) -> DataFrame:
    """(key, h, spans) of regions with repeated windows. Regions of a key come to
    one task in a row; keys are gathered to shards of about ``SHARD`` bytes."""

    def shard(held: list[pa.RecordBatch]) -> pa.RecordBatch:
        rows = pa.Table.from_batches(held).combine_chunks()
        marks = mark(rows["content"].to_pylist(), rows["copies"].to_numpy(), length)
        some = [i for i, m in enumerate(marks) if len(m)]
        own = rows.select(["key", "h"]).take(pa.array(some, pa.int64())).combine_chunks()
        spans = pa.array([_spans(marks[i], length) for i in some], pa.list_(pa.int32()))
        return pa.RecordBatch.from_arrays([pa.concat_arrays(own[c].chunks) if some else pa.array([], own[c].type) for c in ("key", "h")] + [spans], names=["key", "h", "spans"])

    def run(batches):
        held, size, last = [], 0, None
        for batch in batches:
            key, total = np.asarray(batch.column(0)), np.cumsum(np.asarray(batch.column(3)).astype(np.int64))
            # a shard may end where a key begins
            start = np.flatnonzero(np.concatenate([[last is None or key[0] != last], key[1:] != key[:-1]])) if len(key) else []
            lo = 0
            for at in start:
                here = int(total[at - 1] - (total[lo - 1] if lo else 0)) if at > lo else 0
                if size + here >= SHARD:
                    yield shard([*held, batch.slice(lo, at - lo)] if at > lo else held)
                    held, size, lo = [], 0, at
            if lo < len(key):
                held.append(batch.slice(lo))
                size += int(total[-1] - (total[lo - 1] if lo else 0))
                last = key[-1]
        if held:
            yield shard(held)

    return contents.select("key", "h", "copies", "size", "content").repartition("key").sortWithinPartitions("key", "h").mapInArrow(_util.lean(run), "key long, h binary, spans array<int>")


def _cut_again(contents: DataFrame, length: int, gram: int) -> DataFrame:
    """(key, h, copies, size, content, parent, ph, first, within): the regions of regions,
    by strings of ``gram`` bytes."""

    def run(batches):
        for batch in batches:
            for lo in range(0, len(batch), 512):
                part = batch.slice(lo, 512)
                parts = part.column(4).to_pylist()
                data = b"".join(parts)
                offsets = np.concatenate([[0], np.cumsum([len(c) for c in parts])]).astype(np.int64)
                first, n, key, within = windows(np.frombuffer(data, np.uint8), offsets, length, gram)
                row = np.searchsorted(offsets, first, "right") - 1
                stop = first + n + length - 1
                content = pa.array([data[a:b] for a, b in zip(first.tolist(), stop.tolist(), strict=True)], pa.binary())
                of = part.take(pa.array(row))
                cols = [pa.array(key.view(np.int64)), _digests(data, first, stop), of.column(2), pa.array((stop - first).astype(np.int32)), content, of.column(0), of.column(1), pa.array((first - offsets[row]).astype(np.int32)), pa.array(within)]
                yield pa.RecordBatch.from_arrays(cols, names=["key", "h", "copies", "size", "content", "parent", "ph", "first", "within"])

    return contents.select("key", "h", "copies", "size", "content").mapInArrow(_util.lean(run), f"{CONTENT}, parent long, ph binary, first int, within boolean")


def _marks(contents: DataFrame, length: int, level: int = 0) -> DataFrame:
    """(key, h, spans) of distinct regions with repeated windows; ``contents`` is written."""
    grams = [round(share * length) for share in LEVELS]
    heavy = contents.groupBy("key").agg(F.sum("size").alias("_size")).filter(F.col("_size") > SHARD).select("key")
    if level == len(grams) or heavy.isEmpty():
        return _sharded(contents, length)
    rest = _sharded(contents.join(heavy, "key", "left_anti"), length)
    again = _util.saved(_cut_again(contents.join(heavy, "key", "left_semi"), length, grams[level]), compression="zstd")
    keys = again.groupBy("key").agg(F.sum(F.col("copies") * (1 + F.col("within").cast("int"))).alias("total")).filter("total > 1").select("key")
    own = again.join(keys, "key", "left_semi")
    distinct = _util.saved(own.groupBy("key", "h").agg(F.sum("copies").alias("copies"), F.first("size").alias("size"), F.first("content").alias("content")), compression="zstd")
    found = _marks(distinct, length, level + 1)
    back = own.select("key", "h", "parent", "ph", "first").join(found, ["key", "h"])
    back = back.select(F.col("parent").alias("key"), F.col("ph").alias("h"), F.transform("spans", lambda x: x + F.col("first")).alias("s"))
    return rest.unionByName(back.groupBy("key", "h").agg(F.flatten(F.collect_list("s")).alias("spans")))


def removals(docs: DataFrame, length: int = LENGTH, text_col: str = "text") -> DataFrame:
    """One row per distinct text: (t1, t2, text, copies, spans), spans as first
    and stop bytes, unmerged; null where nothing repeats."""
    _util.small_batches(docs.sparkSession)
    texts = _texts(docs, text_col)
    keys = _regions(texts, length, True).groupBy("key").agg(F.sum("copies").alias("total")).filter("total > 1").select("key")
    # kept, as two steps need them and making them means reading every text
    regions = _util.saved(_regions(texts, length, False).join(keys, "key", "left_semi"), compression="zstd")
    distinct = regions.groupBy("key", "h").agg(
        F.sum("copies").alias("copies"), F.min(F.struct("t1", "t2", "first")).alias("place"), F.max("n").alias("n")
    )
    places = distinct.select("key", "h", "copies", "n", "place.*")
    contents = _util.saved(_contents(texts, places, length), compression="zstd")
    marks = _util.saved(_marks(contents, length))
    _util.drop_saved(contents)
    placed = regions.join(marks, ["key", "h"]).select("t1", "t2", F.transform("spans", lambda x: x + F.col("first")).alias("s"))
    spans = placed.groupBy("t1", "t2").agg(F.flatten(F.collect_list("s")).alias("spans"))
    return texts.join(spans, ["t1", "t2"], "left").select("t1", "t2", "text", "copies", "spans")


def cut(data: bytes, spans) -> tuple[bytes, int]:
    """What is left of ``data`` and the number of maximal runs that go."""
    if spans is None or not len(spans):
        return data, 0
    edge = np.zeros(len(data) + 1, np.int32)
    s = np.asarray(spans).reshape(-1, 2)
    np.add.at(edge, s[:, 0], 1)
    np.add.at(edge, s[:, 1], -1)
    gone = np.cumsum(edge[:-1]) > 0
    runs = int(gone[0]) + int((gone[1:] & ~gone[:-1]).sum())
    return np.frombuffer(data, np.uint8)[~gone].tobytes(), runs


def _applied(docs: DataFrame, length: int, text_col: str, with_text: bool) -> DataFrame:
    def run(batches):
        for batch in batches:
            rows = {k: [] for k in ("n_bytes", "n_removed", "n_spans", "kept_sha256", "kept")}
            for text, spans in zip(batch.column(2), batch.column(4), strict=True):
                data = text.as_py().encode("utf-8", "replace")
                kept, runs = cut(data, spans.values if spans.is_valid else None)
                rows["n_bytes"].append(len(data))
                rows["n_removed"].append(len(data) - len(kept))
                rows["n_spans"].append(runs)
                rows["kept_sha256"].append(hashlib.sha256(kept).hexdigest())
                rows["kept"].append(kept.decode("utf-8", "ignore") if with_text else None)
            kinds = (pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.string())
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), *[pa.array(v, k) for v, k in zip(rows.values(), kinds, strict=True)]], names=["t1", "t2", *rows])

    found = removals(docs, length, text_col)
    return found.mapInArrow(_util.lean(run), "t1 long, t2 long, n_bytes long, n_removed long, n_spans long, kept_sha256 string, kept string")


def digest(docs: DataFrame, length: int = LENGTH, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: id, n_bytes, n_removed, n_spans, kept_sha256."""
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    own = docs.select(F.col(id_col), *_identity(text))
    return own.join(_applied(docs, length, text_col, False), ["t1", "t2"]).select(id_col, "n_bytes", "n_removed", "n_spans", "kept_sha256")


def clean(docs: DataFrame, length: int = LENGTH, text_col: str = "text", count_col: str | None = "n_chars") -> DataFrame:
    """``docs`` with the repeated bytes of ``text_col`` gone (a null text stays
    null) and ``count_col``, where there is one, counted anew; same columns."""
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    # the row travels as one column, so that no name of its own clashes
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row")
    own = docs.select(row, F.col(text_col).isNull().alias("missing"), *_identity(text))
    joined = own.join(_applied(docs, length, text_col, True).select("t1", "t2", "kept"), ["t1", "t2"])
    new = {text_col: F.when(~F.col("missing"), F.col("kept"))}
    if count_col in docs.columns:
        new[count_col] = F.when(~F.col("missing"), F.length("kept")).cast(dict(docs.dtypes)[count_col])
    return joined.select(*[new.get(c, F.col(f"row.`{c}`")).alias(c) for c in docs.columns])
