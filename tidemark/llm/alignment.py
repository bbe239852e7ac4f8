"""Alignment of two tokenizers over a corpus by external spill counting (operator 11).

Every text is encoded by both tokenizers (:mod:`tidemark.llm.two_tokenizers`).
Tokens of A and B whose byte ranges overlap are linked; places where both end
cut the tokens into groups.  A pair's count is the number of links of the whole
corpus that hold it.

1. *Spill.*  A task collects pair-document records of whole documents until it
   has ``RUN_LINKS`` of them.  They are sorted B-major, radix-partitioned by
   the B id and written as zstd frames, one per (run, bucket): ``heads`` are
   the frame's pairs with their links in the run, ``records`` the documents
   behind each pair.
2. *Merge.*  A bucket's heads of all runs go through a k-way heap merge, which
   meets equal pairs together and so counts them.  As the order is B-major, the
   largest count of a B id is known when its pairs are through.  The counts
   stream back to the runs, each in the order of its own heads.
3. *Contributions.*  Each run meets its returned counts, and its records turn
   them into sums per document.

Only heads are merged: a pair that is linked a billion times is one head per
run, so no bucket grows with how often a pair occurs, only with how many
distinct pairs the runs hold.  There are about as many buckets as
``BUCKET_BYTES`` of text; a B id's heads are at most its partners times the runs.
The largest counts are one number per B id of the vocabulary.

Defined results: null and empty texts, and texts that a tokenizer does not give
back byte by byte, have no tokens: zeros and an empty digest.  A text of any
length is encoded whole and belongs to one run.  Ties: every pair that reaches
the largest count of its B id is a best one.  Repeated rows count, and are
returned, each on its own.  An empty table gives an empty result; other columns
take no part.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from heapq import merge
from itertools import islice

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

from tidemark.llm.common import materialise, text_of, tidy
from tidemark.llm.postings import packed, unpacked
from tidemark.llm.two_tokenizers import TwoTokenizers

A_PATH = "/opt/tokenizers/byte_bpe_50k.json"
B_PATH = "/opt/tokenizers/piece_bpe_32k.model"
#: Links of a run, at least, unless the task's documents end.
RUN_LINKS = 1 << 22
#: Bytes of text per bucket of B ids.
BUCKET_BYTES = 1 << 26
#: Characters of text encoded at once, and heads taken from the merge at once.
CHUNK, AT_ONCE = 1 << 20, 1 << 18


def squeezed(*columns: np.ndarray) -> bytes:
    """Columns of non-negative numbers as one zstd frame."""
    raw = [packed(c)[0] for c in columns]
    head = np.array([len(r) for r in raw], np.int64).tobytes()
    return zstandard.ZstdCompressor(level=1).compress(head + b"".join([r.tobytes() for r in raw]))


def unsqueezed(frame: bytes, columns: int) -> list[np.ndarray]:
    raw = np.frombuffer(zstandard.ZstdDecompressor().decompress(frame), np.uint8)
    sizes = raw[: 8 * columns].view(np.int64)
    ends = 8 * columns + np.cumsum(sizes)
    return [unpacked(raw[end - size : end]) for size, end in zip(sizes, ends)]


class Layout:
    """Numbers of pairs: the B id's rank by (bucket, id) above, the A id below; a record has the document's ordinal below that."""

    def __init__(self, a_size: int, b_size: int, buckets: int):
        self.buckets = buckets
        self.a_bits, self.doc_bits = (a_size - 1).bit_length(), 62 - (a_size - 1).bit_length() - (b_size - 1).bit_length()
        if self.doc_bits < 24:
            raise ValueError("vocabularies too large for a record of 64 bits")
        ids = np.arange(b_size, dtype=np.uint64)
        mixed = (ids * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(32)
        bucket = (mixed % np.uint64(buckets)).astype(np.int64)
        order = np.lexsort((ids, bucket))
        self.rank = np.empty(b_size, np.int64)
        self.rank[order] = np.arange(b_size)
        #: First pair of each bucket, and of the one that would follow.
        self.bounds = np.searchsorted(bucket[order], np.arange(buckets + 1)) << self.a_bits


class Run:
    """The run that a task is filling."""

    def __init__(self):
        self.links: list[np.ndarray] = []
        self.size = 0
        self.docs: list[tuple] = []

    def add(self, layout: Layout, both: TwoTokenizers, ids: list, encoded: list) -> None:
        """Documents and what :meth:`TwoTokenizers.encode` says of them."""
        kept = [x for x in encoded if x is not None]
        flat = [s for x in kept for s in x]
        flat_a, flat_b, flat_groups = zip(*flat) if flat else ((), (), ())
        a, b = np.frombuffer(b"".join(flat_a), np.int32), np.frombuffer(b"".join(flat_b), np.int32)
        # Segments of each document, and the tokens up to its end.
        cuts = np.cumsum([0, *map(len, kept)])
        upto_a, upto_b = (np.concatenate([[0], np.cumsum(np.fromiter(map(len, x), np.int64, len(x)) // 4)])[cuts] for x in (flat_a, flat_b))
        ends_a, ends_b = np.cumsum(both.a_sizes[a]), np.cumsum(both.b_sizes[b])
        total = int(ends_a[-1]) + 1 if len(a) else 1
        is_a, is_b = np.zeros(total, bool), np.zeros(total, bool)
        is_a[ends_a], is_b[ends_b] = True, True
        # Each stretch between neighbouring ends is what one token of A and one of B share.
        ends = np.flatnonzero(is_a | is_b)
        here_a, here_b = is_a[ends], is_b[ends]
        link_a, link_b = a[np.cumsum(here_a) - here_a], b[np.cumsum(here_b) - here_b]
        doc_ends = ends_a[upto_a[1:] - 1] if kept else np.zeros(0, np.int64)
        upto = np.concatenate([[0], np.searchsorted(ends, doc_ends, "right")])
        closed = np.concatenate([[0], np.cumsum(here_a & here_b)])[upto]
        ordinal = np.array([len(self.docs) + k for k, x in enumerate(encoded) if x is not None], np.int64)
        pair = layout.rank[link_b] << layout.a_bits | link_a
        self.links.append(pair << layout.doc_bits | np.repeat(ordinal, np.diff(upto)))
        self.size += len(pair)
        told = zip(*[np.diff(x).tolist() for x in (upto_a, upto_b, closed, upto)], cuts.tolist(), cuts[1:].tolist())
        for doc_id, x in zip(ids, encoded):
            if x is None:
                self.docs.append((doc_id, 0, 0, 0, 0, ""))
            else:
                *numbers, begin, end = next(told)
                self.docs.append((doc_id, *numbers, hashlib.sha256(";".join(flat_groups[begin:end]).encode()).hexdigest()))

    def rows(self, layout: Layout, run: int, id_type: pa.DataType) -> pa.RecordBatch:
        records = np.sort(np.concatenate(self.links)) if self.links else np.zeros(0, np.int64)
        first = np.flatnonzero(np.diff(records, prepend=-1))
        times = np.diff(np.append(first, len(records)))
        pair, doc = records[first] >> layout.doc_bits, records[first] & ((1 << layout.doc_bits) - 1)
        head = np.flatnonzero(np.diff(pair, prepend=-1))
        heads, docs_of = pair[head], np.diff(np.append(head, len(pair)))
        links_of = np.add.reduceat(times, head) if len(head) else times
        steps = np.diff(doc, prepend=0)
        steps[head] = doc[head]
        frames = []
        cuts, record_at = np.searchsorted(heads, layout.bounds), np.append(head, len(pair))
        for bucket in range(layout.buckets):
            x, y = cuts[bucket], cuts[bucket + 1]
            if x < y:
                some = slice(record_at[x], record_at[y])
                frames.append((bucket, squeezed(np.diff(heads[x:y], prepend=0), links_of[x:y]), squeezed(docs_of[x:y], steps[some], times[some])))
        n, d = len(frames), len(self.docs)
        bucket, heads, records = zip(*frames) if frames else ((), (), ())
        columns = list(zip(*self.docs)) if d else [()] * 6
        out = {
            "run": pa.array(np.full(n + d, run, np.int64)),
            "bucket": pa.array([*bucket, *[None] * d], pa.int32()),
            "heads": pa.array([*heads, *[None] * d], pa.binary()),
            "records": pa.array([*records, *[None] * d], pa.binary()),
            "ordinal": pa.array([*[None] * n, *range(d)], pa.int32()),
            "doc_id": pa.array([*[None] * n, *columns[0]], id_type),
        }
        for name, values in zip(("n_a", "n_b", "n_groups", "n_links"), columns[1:]):
            out[name] = pa.array([*[None] * n, *values], pa.int64())
        out["groups_sha256"] = pa.array([*[None] * n, *columns[5]], pa.string())
        return pa.RecordBatch.from_pydict(out)


_LOADED: dict[bytes, TwoTokenizers] = {}


def loaded(a_file: str, b_model: bytes) -> TwoTokenizers:
    """The process's tokenizers of these files."""
    key = hashlib.md5(a_file.encode() + b_model).digest()
    if key not in _LOADED:
        _LOADED[key] = TwoTokenizers(a_file, b_model)
    return _LOADED[key]


def spill_runs(docs: DataFrame, layout: Layout, files, run_links: int = RUN_LINKS) -> DataFrame:
    """The written runs: per (run, bucket) a row with heads and records, per document a row with its own numbers."""
    kind = docs.schema["doc_id"].dataType.simpleString()

    def spill(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        both, number, run, id_type = loaded(*files.value), TaskContext.get().partitionId() << 32, Run(), None
        try:
            for batch in batches:
                id_type = batch.schema.field(0).type
                ids, texts = batch.column(0).to_pylist(), batch.column(1).to_pylist()
                start = held = 0
                for k, text in enumerate(texts):
                    held += len(text or "") + 1
                    if held >= CHUNK or k + 1 == len(texts):
                        run.add(layout, both, ids[start : k + 1], both.encode(texts[start : k + 1]))
                        start, held = k + 1, 0
                        if run.size >= run_links:
                            yield run.rows(layout, number, id_type)
                            number, run = number + 1, Run()
            if run.docs:
                yield run.rows(layout, number, id_type)
        finally:
            both.forget()  # the process may serve other work next

    schema = (
        f"run bigint, bucket int, heads binary, records binary, ordinal int, doc_id {kind}, "
        "n_a bigint, n_b bigint, n_groups bigint, n_links bigint, groups_sha256 string"
    )
    return materialise(docs.select("doc_id", text_of().alias("body")).mapInArrow(tidy(spill), schema), "pair-runs")


def merged(frames: list[bytes], a_bits: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """K-way heap merge of the frames' heads.

    Yields, in merge order, (frame of each head, count of its pair) and (B
    rank, its largest count so far); a pair's heads stay together.
    """
    run_bits = max(1, (len(frames) - 1).bit_length())
    keys, links = [], []
    for k, frame in enumerate(frames):
        steps, n = unsqueezed(frame, 2)
        keys.append((np.cumsum(steps) << run_bits | k).tolist())
        links.append(n)
    taken = np.zeros(len(frames), np.int64)
    stream = merge(*keys)
    held, ended = np.zeros(0, np.int64), False
    while not ended:
        block = np.fromiter(islice(stream, AT_ONCE), np.int64)
        ended = len(block) < AT_ONCE
        block = np.concatenate([held, block])
        pair = block >> run_bits
        # The last pair may go on in the next block.
        whole = len(block) if ended else int(np.searchsorted(pair, pair[-1]))
        held, block, pair = block[whole:], block[:whole], pair[:whole]
        if not whole:
            continue
        frame = block & ((1 << run_bits) - 1)
        n = np.bincount(frame, minlength=len(frames))
        mine = np.empty(whole, np.int64)
        mine[np.argsort(frame, kind="stable")] = np.concatenate([links[k][taken[k] : taken[k] + n[k]] for k in range(len(frames))])
        taken += n
        first = np.flatnonzero(np.diff(pair, prepend=-1))
        count = np.add.reduceat(mine, first)
        rank = pair[first] >> a_bits
        begin = np.flatnonzero(np.diff(rank, prepend=-1))
        yield frame, np.repeat(count, np.diff(np.append(first, whole))), rank[begin], np.maximum.reduceat(count, begin)


def count_pairs(runs: DataFrame, layout: Layout) -> DataFrame:
    """Written: per (run, bucket, seq) the counts of the run's heads in their order; per B rank its largest count."""
    a_bits = layout.a_bits

    def count(group: pa.Table) -> pa.Table:
        bucket, run, frames = group.column("bucket")[0].as_py(), group.column("run").to_numpy(), group.column("heads").to_pylist()
        back, most = [], {}
        for seq, (frame, counts, ranks, best) in enumerate(merged(frames, a_bits)):
            for r, n in zip(ranks.tolist(), best.tolist()):  # a rank's pairs may lie in several blocks
                most[r] = max(most.get(r, 0), n)
            order = np.argsort(frame, kind="stable")
            cuts = np.concatenate([[0], np.cumsum(np.bincount(frame, minlength=len(frames)))])
            some = np.flatnonzero(np.diff(cuts))
            back += [(int(run[k]), seq, squeezed(counts[order[cuts[k] : cuts[k + 1]]])) for k in some]
        n, m = len(back), len(most)
        numbers, seqs, counts = zip(*back) if back else ((), (), ())
        return pa.table({
            "run": pa.array([*numbers, *[None] * m], pa.int64()),
            "bucket": pa.array([bucket] * (n + m), pa.int32()),
            "seq": pa.array([*seqs, *[None] * m], pa.int32()),
            "counts": pa.array([*counts, *[None] * m], pa.binary()),
            "rank": pa.array([*[None] * n, *most], pa.int64()),
            "best": pa.array([*[None] * n, *most.values()], pa.int64()),
        })

    heads = runs.filter("bucket IS NOT NULL").select("bucket", "run", "heads")
    schema = "run bigint, bucket int, seq int, counts binary, rank bigint, best bigint"
    return materialise(heads.groupBy("bucket").applyInArrow(count, schema), "pair-counts")


def align(docs: DataFrame, a_path: str = A_PATH, b_path: str = B_PATH, run_links: int = RUN_LINKS, bucket_bytes: int = BUCKET_BYTES) -> DataFrame:
    """doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256 of every row's text."""
    spark = docs.sparkSession
    with open(a_path, encoding="utf-8") as a, open(b_path, "rb") as b:
        contents = a.read(), b.read()
    files = spark.sparkContext.broadcast(contents)  # two vocabularies
    both = loaded(*contents)
    size = docs.select(F.sum(F.octet_length("text"))).first()[0] or 0
    layout = Layout(len(both.a_bytes), len(both.b_bytes), min(len(both.b_bytes), max(1, -(-size // bucket_bytes))))
    runs = spill_runs(docs, layout, files, run_links)
    counted = count_pairs(runs, layout)
    best = np.zeros(len(both.b_bytes), np.int64)
    told = counted.filter("rank IS NOT NULL").select("rank", "best").toArrow()  # one row per B id at most
    best[told["rank"].to_numpy()] = told["best"].to_numpy()
    shared = spark.sparkContext.broadcast(best)
    a_bits, kind = layout.a_bits, runs.schema["doc_id"].dataType.simpleString()

    def contribute(run: pa.Table, back: pa.Table) -> pa.Table:
        mine = run.filter(pc.is_valid(run["ordinal"]))
        n_docs = len(mine)
        n_best, count_sum = np.zeros(n_docs, np.int64), np.zeros(n_docs, np.int64)
        returned: dict[int, list] = {}
        for bucket, seq, counts in zip(*[back[c].to_pylist() for c in ("bucket", "seq", "counts")]):
            returned.setdefault(bucket, []).append((seq, counts))
        frames = run.filter(pc.is_valid(run["bucket"]))
        for bucket, heads, records in zip(*[frames[c].to_pylist() for c in ("bucket", "heads", "records")]):
            pairs = np.cumsum(unsqueezed(heads, 2)[0])
            counts = np.concatenate([unsqueezed(c, 1)[0] for _, c in sorted(returned[bucket])])
            docs_of, steps, times = unsqueezed(records, 3)
            begin = np.cumsum(docs_of) - docs_of
            upto = np.cumsum(steps)
            doc = upto - np.repeat(upto[begin] - steps[begin], docs_of)
            is_best = counts == shared.value[pairs >> a_bits]
            np.add.at(n_best, doc, np.where(np.repeat(is_best, docs_of), times, 0))
            np.add.at(count_sum, doc, np.repeat(counts, docs_of) * times)
        ordinal = mine["ordinal"].to_numpy()
        out = {c: mine[c] for c in ("doc_id", "n_a", "n_b", "n_groups", "n_links")}
        return pa.table(out | {"n_best": n_best[ordinal], "count_sum": count_sum[ordinal], "groups_sha256": mine["groups_sha256"]})

    schema = f"doc_id {kind}, n_a bigint, n_b bigint, n_groups bigint, n_links bigint, n_best bigint, count_sum bigint, groups_sha256 string"
    back = counted.filter("run IS NOT NULL").select("run", "bucket", "seq", "counts")
    return runs.groupBy("run").cogroup(back.groupBy("run")).applyInArrow(contribute, schema)
