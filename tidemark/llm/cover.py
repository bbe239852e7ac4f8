"""Names of 400-byte windows by a difference-cover sort, distributed over Spark.

The texts are strings cut into chunks (one row holds many strings).  Places
whose number in their string is 1 or 2 modulo 3 - a difference cover modulo 3
- are sampled.  The sampled places' triples of eight-byte words are sorted and
named; triples of names are sorted and named again (24, 72, 216 bytes), and a
last pair of overlapping names covers 396 bytes.  Any two windows meet at
sampled places after skipping 0, 1 or 2 bytes, the same for both, so the
remaining places are merged in by three sorts, one for each pair of residues:
a sampled name with the bytes before and after it that fill 400.  Neighbours
with equal keys are equal windows.

A sort deals keys to buckets by hash and orders each bucket's keys that occur
twice; equal keys of a chunk travel once, with their count.  A name that occurs once is dropped; a
window that contains dropped names of both sampled residues has no equal and is
out.  Each level is
written to the shared folder.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, functions as F

from tidemark.llm.anchors import WINDOW
from tidemark.llm.common import materialise, release

#: (bytes covered, places of the names that a key joins); the first level joins words of the text.
LEVELS = ((24, (0, 8, 16)), (72, (0, 24, 48)), (216, (0, 72, 144)), (396, (0, 180)))
#: Bytes before and after a sampled name that fill a window, for the three pairs of residues.
MERGES = (((1, 2), 0, (396, 397, 398, 399)), ((0, 1), 1, (0, 397, 398, 399)), ((0, 2), 2, (0, 1, 398, 399)))
#: Bytes of a chunk, and keys that a bucket is meant for.
CHUNK_BYTES = 1 << 20
BUCKET_KEYS = 1 << 19
#: Passes in which the first level's buckets are dealt, to halve what a shuffle holds.
FIRST_PASSES = 2

_SEED, _ODD, _HALF = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC4CEB9FE1A85EC53), np.uint64(32)

SCHEMA = "chunk bigint, body binary, sizes binary, owners binary, names binary, alive binary"


def _pack(values: np.ndarray) -> bytes:
    """Numbers of eight bytes go byte by byte: the first bytes of all, the second ones, and so on."""
    flat = np.ascontiguousarray(values).reshape(-1)
    if flat.itemsize == 8:
        flat = np.ascontiguousarray(flat.view(np.uint8).reshape(-1, 8).T).reshape(-1)
    return zstandard.ZstdCompressor(level=1).compress(flat)


def _unpack(packed: bytes, kind) -> np.ndarray:
    flat = np.frombuffer(zstandard.ZstdDecompressor().decompress(packed), np.uint8)
    if np.dtype(kind).itemsize == 8:
        flat = np.ascontiguousarray(flat.reshape(8, -1).T).reshape(-1)
    return flat.view(kind)


class Chunk:
    """Strings one after the other, with the present level's names and the windows still in question."""

    def __init__(self, row: dict):
        self.row = row
        self.body = np.frombuffer(row["body"], np.uint8)
        self.sizes = np.frombuffer(row["sizes"], np.int64)
        self.here = np.arange(len(self.body), dtype=np.int32)
        ends = np.cumsum(self.sizes)
        self.place = self.here - np.repeat((ends - self.sizes).astype(np.int32), self.sizes)
        self.left = np.repeat(ends.astype(np.int32), self.sizes) - self.here
        self.residue = self.place % np.int32(3)
        self.names = np.zeros(len(self.body), np.int64)
        if row["names"]:
            self.names[self.residue != 0] = _unpack(row["names"], np.int64)
        self.alive = _unpack(row["alive"], bool) if row["alive"] else self.left >= WINDOW

    def sampled(self, covered: int) -> np.ndarray:
        """Sampled places of which ``covered`` bytes lie in a window that is in question."""
        last = np.maximum.accumulate(np.where(self.alive, self.here, np.int32(-WINDOW)))
        some = self.here - last <= np.minimum(self.place, np.int32(WINDOW - covered))
        some &= self.residue != 0
        some &= self.left >= covered
        return np.flatnonzero(some)

    def level_keys(self, level: int) -> tuple[np.ndarray, list[np.ndarray]]:
        """(places, keys): the keys' words, one array for each."""
        covered, offsets = LEVELS[level]
        at = self.sampled(covered)
        if level:
            words = [self.names[at + k].view(np.uint64) for k in offsets]
            # A place that joins a dropped name has no equal.
            whole = np.logical_and.reduce([w != 0 for w in words])
            return at[whole], [w[whole] for w in words]
        word = np.zeros(max(len(self.body) - 7, 0), np.uint64)
        for k in range(8):
            word <<= np.uint64(8)
            word |= self.body[k : k + len(word)]
        return at, [word[at + k] for k in offsets]

    def merge_keys(self) -> tuple[np.ndarray, list[np.ndarray]]:
        """(windows, keys): two keys for each window in question, by the pairs that its residue is in."""
        windows = np.flatnonzero(self.alive)
        residue = self.residue[windows]
        places, names, rests = [], [], []
        for tag, (residues, skip, fill) in enumerate(MERGES):
            mine = windows[(residue == residues[0]) | (residue == residues[1])]
            name = self.names[mine + skip].view(np.uint64)
            mine, name = mine[name != 0], name[name != 0]
            rest = np.full(len(mine), np.uint64(tag))
            for k in fill:
                rest = (rest << np.uint64(8)) | self.body[mine + k]
            places.append(mine)
            names.append(name)
            rests.append(rest)
        return np.concatenate(places), [np.concatenate(names), np.concatenate(rests)]

    def keys(self, level: int) -> tuple[np.ndarray, list[np.ndarray]]:
        return self.level_keys(level) if level < len(LEVELS) else self.merge_keys()

    def named(self, level: int, at: np.ndarray, names: np.ndarray) -> dict:
        """The chunk after a level.

        A window's equal has the same residue, and all names agree, or another
        one, and the names of one sampled residue agree: a window is out as
        soon as both residues have a dropped name (0) in it.
        """
        if level == len(LEVELS):
            alive = np.zeros(len(self.body), bool)
            alive[at[names != 0]] = True
            return self.row | {"names": b"", "alive": _pack(alive)}
        covered = LEVELS[level][0]
        filled = np.zeros(len(self.body), np.int64)
        filled[at] = names
        windows = np.flatnonzero(self.alive)
        every = self.sampled(covered)
        dropped = every[filled[every] == 0]
        keep = np.zeros(len(windows), bool)
        for residue in (1, 2):
            upto = np.zeros(len(self.body) + 1, np.int32)
            upto[dropped[self.residue[dropped] == residue] + 1] = 1
            upto = np.cumsum(upto, dtype=np.int32)
            keep |= upto[windows + (WINDOW - covered + 1)] == upto[windows]
        alive = np.zeros(len(self.body), bool)
        alive[windows[keep]] = True
        return self.row | {"names": _pack(filled[self.residue != 0]), "alive": _pack(alive)}


def _hashed(keys: list[np.ndarray]) -> np.ndarray:
    """64-bit hash of each key."""
    h = np.full(len(keys[0]), _SEED)
    for word in keys:
        h ^= word
        h *= _ODD
        h ^= h >> _HALF
    return h


def _bucket(h: np.ndarray, buckets: int) -> np.ndarray:
    """Buckets are ranges of the hash, decided by its upper half."""
    return ((h >> _HALF) * np.uint64(buckets)) >> _HALF


def _together(h: np.ndarray, keys: list[np.ndarray], mine: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray, list[np.ndarray], np.ndarray]:
    """Keys (those that are ``mine``) brought together by their hash: (their order, its hashes and keys, where another key begins).

    The hash gives up its low bits to the key's number, so that plain numbers
    are sorted.  Should different keys share what is left of it, a key may
    begin twice.
    """
    low = np.uint64(max(len(h) - 1, 1).bit_length())
    packed = h >> low << low
    packed |= np.arange(len(h), dtype=np.uint64)
    if mine is not None:
        packed = packed[mine]
    packed.sort()
    order = (packed & ((np.uint64(1) << low) - np.uint64(1))).view(np.int64)
    ordered = [word[order] for word in keys]
    new = np.zeros(len(order), bool)
    new[:1] = True
    for word in ordered:
        new[1:] |= word[1:] != word[:-1]
    return order, packed >> low, ordered, new


def _chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[Chunk]:
    for batch in batches:
        for row in batch.to_pylist():
            yield Chunk(row)


def _sent(level: int, buckets: int, part: int, parts: int) -> Callable:
    """Each chunk's distinct keys of the buckets that are dealt in this pass."""

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for chunk in _chunks(batches):
            _, keys = chunk.keys(level)
            h = _hashed(keys)
            mine = _bucket(h, buckets) % np.uint64(parts) == part if parts > 1 else None
            order, _, ordered, new = _together(h, keys, mine)
            first = np.flatnonzero(new)
            if not len(first):
                continue
            counts = np.minimum(np.diff(np.append(first, len(order))), 2).astype(np.uint8)
            distinct = np.stack([word[first] for word in ordered])
            # A key that begins twice is named once: the bucket's sort puts its counts together.
            bucket = _bucket(h[order[first]], buckets)
            cuts = (np.flatnonzero(np.diff(bucket)) + 1).tolist()
            rows = [
                (int(bucket[a]), chunk.row["chunk"], b - a, _pack(distinct[:, a:b]), _pack(counts[a:b]))
                for a, b in zip([0, *cuts], [*cuts, len(first)])
            ]
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(zip(*rows), (pa.int32(), pa.int64(), pa.int64(), pa.binary(), pa.binary()))],
                names=["bucket", "chunk", "n", "keys", "counts"],
            )

    return send


def _ranked(words: int) -> Callable:
    def rank(group: pa.Table) -> pa.Table:
        rows = group.to_pylist()
        keys = list(np.concatenate([_unpack(r["keys"], np.uint64).reshape(words, -1) for r in rows], axis=1))
        counts = np.concatenate([_unpack(r["counts"], np.uint8) for r in rows])
        order, hashes, ordered, new = _together(_hashed(keys), keys)
        if (new[1:] & (hashes[1:] == hashes[:-1])).any():  # different keys share a hash: only their sort parts them
            order = np.lexsort(keys[::-1])
            ordered = [word[order] for word in keys]
            new[1:] = np.logical_or.reduce([word[1:] != word[:-1] for word in ordered])
        first = np.flatnonzero(new)
        often = np.flatnonzero(np.add.reduceat(counts[order], first, dtype=np.int64) >= 2)
        # Order-keeping within the bucket; the bucket's number makes it unique.
        name = np.zeros(len(first), np.int64)
        name[often[np.lexsort([word[first[often]] for word in reversed(ordered)])]] = (np.int64(rows[0]["bucket"]) << np.int64(32)) + 1 + np.arange(len(often))
        names = np.zeros(len(order), np.int64)
        names[order] = np.repeat(name, np.diff(np.append(first, len(order))))
        parts = np.split(names, np.cumsum([r["n"] for r in rows])[:-1])
        return pa.table({
            "chunk": pa.array([r["chunk"] for r in rows], pa.int64()),
            "bucket": pa.array([r["bucket"] for r in rows], pa.int32()),
            "names": pa.array([_pack(p) for p in parts], pa.binary()),
        })

    return rank


def _received(level: int, buckets: int) -> Callable:
    def receive(state: pa.Table, told: pa.Table) -> pa.Table:
        out = []
        parts = sorted(zip(told["bucket"].to_pylist(), told["names"].to_pylist()))
        names = np.concatenate([_unpack(p, np.int64) for _, p in parts]) if parts else np.zeros(0, np.int64)
        for row in state.to_pylist():
            chunk = Chunk(row)
            at, keys = chunk.keys(level)
            order, _, _, new = _together(_hashed(keys), keys)
            got = np.zeros(len(at), np.int64)
            got[order] = names[np.cumsum(new) - 1]
            if level == len(LEVELS):  # a window has two keys
                at, got = at[got != 0], got[got != 0]
            out.append(chunk.named(level, at, got))
        return pa.Table.from_pylist(out, pa.schema([("chunk", pa.int64())] + [(c, pa.binary()) for c in ("body", "sizes", "owners", "names", "alive")]))

    return receive


def in_chunks(strings: DataFrame) -> DataFrame:
    """(owner bigint, body binary), owners unique -> chunk rows for :func:`repeated`; written once."""

    def collect(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        held, size, number = [], 0, TaskContext.get().partitionId() << 32

        def row() -> pa.RecordBatch:
            sizes = np.array([len(b) for _, b in held], np.int64)
            owners = np.array([o for o, _ in held], np.int64)
            values = [number, b"".join(b for _, b in held), sizes.tobytes(), owners.tobytes(), b"", b""]
            return pa.RecordBatch.from_arrays(
                [pa.array([v], pa.int64() if k == 0 else pa.binary()) for k, v in enumerate(values)], names=["chunk", "body", "sizes", "owners", "names", "alive"]
            )

        for batch in batches:
            for owner, body in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                held.append((owner, body))
                size += len(body)
                if size >= CHUNK_BYTES:
                    yield row()
                    held, size, number = [], 0, number + 1
        if held:
            yield row()

    return materialise(strings.select("owner", "body").mapInArrow(collect, SCHEMA), "cover-chunks")


def repeated(state: DataFrame) -> DataFrame:
    """(owner, starts array<int>, ends array<int>): runs of windows of each string that occur elsewhere in the strings.

    ``state`` is what :func:`in_chunks` made of the strings, and is deleted; a run's end is its last window's start.
    """
    spark = state.sparkSession
    spark.sparkContext._jvm.System.gc()  # lets Spark delete shuffle files that nothing reads any more
    size = state.agg(F.sum(F.octet_length("body"))).first()[0] or 0
    buckets = int(max(8, size // BUCKET_KEYS + 1))
    for level in range(len(LEVELS) + 1):
        words = len(LEVELS[level][1]) if level < len(LEVELS) else 2
        # The first level has the most and the longest keys: its buckets are dealt in passes, each freed before the next.
        parts = FIRST_PASSES if level == 0 else 1
        passes = []
        for part in range(parts):
            sent = state.mapInArrow(_sent(level, buckets, part, parts), "bucket int, chunk bigint, n bigint, keys binary, counts binary")
            passes.append(materialise(sent.groupBy("bucket").applyInArrow(_ranked(words), "chunk bigint, bucket int, names binary"), "cover-names"))
            spark.sparkContext._jvm.System.gc()
        told = passes[0]
        for more in passes[1:]:
            told = told.unionByName(more)
        after = state.groupBy("chunk").cogroup(told.groupBy("chunk")).applyInArrow(_received(level, buckets), SCHEMA)
        after = materialise(after, f"cover-{level}")
        for done in (state, *passes):
            release(done)
        state = after
        spark.sparkContext._jvm.System.gc()

    def runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for chunk in _chunks(batches):
            owners = np.frombuffer(chunk.row["owners"], np.int64)
            cuts = np.cumsum(chunk.sizes)
            out = []
            for owner, a, b in zip(owners.tolist(), cuts - chunk.sizes, cuts):
                edge = np.flatnonzero(np.diff(np.concatenate([[0], chunk.alive[a:b].astype(np.int8), [0]])))
                if len(edge):
                    out.append((owner, edge[0::2].tolist(), (edge[1::2] - 1).tolist()))
            if out:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, t) for c, t in zip(zip(*out), (pa.int64(), pa.list_(pa.int32()), pa.list_(pa.int32())))], names=["owner", "starts", "ends"]
                )

    return state.mapInArrow(runs, "owner bigint, starts array<int>, ends array<int>")
