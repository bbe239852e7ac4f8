"""Language identification with language-bitmask n-gram filters (operator 10).

Training collects, per language, the character n-grams that occur in at least
``MIN_SHARE`` of its sampled documents.  All languages' Bloom filters are kept
bit-sliced: one word per filter position whose bit ``l`` belongs to language
``l``, so the AND of an n-gram's few positions is the bitmask of all languages
that contain it.  A text's n-grams are looked up, each language's hits are
counted, the expected false positives (share of set positions to the power of
the number of hashes) are taken off, and the language with most remaining hits
decides.  ``score`` is the share of the text's n-grams left to that language.

The filter has ``SLOTS`` positions whatever the corpus, so the driver and the
broadcast hold a bounded model.  Training reads about ``SAMPLE`` documents per
language, chosen by a hash of doc_id; prediction reads every whole text.

Defined results: ``und`` and score 0 for a null text or one without a letter,
and for every row if there is nothing to learn from; a text of which no n-gram
is known gets the language with most training documents and score 0; ties go
to the language with more training documents, then to the smaller name.  A row
without doc_id counts as held out.  Repeated rows get equal results; other
columns take no part.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from tidemark.llm.common import materialise, tidy

SIZES = (3, 4)
SLOT_BITS = 20
SLOTS = 1 << SLOT_BITS
HASHES = 3
#: Expected number of sampled training documents per language, at most.
SAMPLE = 20_000
MIN_SHARE = 0.01
#: More languages than this are refused: the label column is then not a language.
MAX_LANGUAGES = 1024
WORD = 62
#: Characters handled at once, unless a run of letters is longer.
CHUNK = 1 << 18
#: Rows whose texts are unpacked at once.
ROWS = 1_000
#: Documents with a smaller share of known n-grams are rejected by :func:`keep_identified`.
MIN_SCORE = 0.2

_MULT = np.uint64(0x9E3779B97F4A7C15)
_LETTERS: list[np.ndarray] = []


def letters() -> np.ndarray:
    """Code point -> is it a letter (built once per process)."""
    if not _LETTERS:
        _LETTERS.append(np.fromiter((chr(c).isalpha() for c in range(0x110000)), bool, 0x110000))
    return _LETTERS[0]


def mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def pieces(texts: list[str]) -> Iterator[tuple[list[int], list[str]]]:
    """Chunks of about CHUNK characters: (index of each piece's text, pieces).

    A longer text is cut in front of a character that is no letter, so no
    n-gram is lost or made; a longer run of letters stays in one piece.
    """
    index, held, size = [], [], 0
    for k, text in enumerate(texts):
        at = 0
        while at < len(text) or not text:
            end = len(text) if len(text) - at <= CHUNK else _cut_at(text, at)
            index.append(k)
            held.append(text[at:end])
            size += end - at
            at = end
            if size >= CHUNK:
                yield index, held
                index, held, size = [], [], 0
            if not text:
                break
    if held:
        yield index, held


def _cut_at(text: str, begin: int) -> int:
    """The last place up to CHUNK characters from ``begin`` where no letter begins, else the first one beyond."""
    for end in range(begin + CHUNK, begin, -1):
        if not text[end].isalpha():
            return end
    return next((end for end in range(begin + CHUNK, len(text)) if not text[end].isalpha()), len(text))


def grams(held: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(n-gram hashes, position in ``held`` of each, whether each piece has a letter).

    Letters are lower-cased, all else is one boundary; an n-gram may begin or
    end with a boundary, but has none inside.
    """
    joined = "\n" + "\n".join(t.lower() for t in held) + "\n"
    codes = np.frombuffer(joined.encode("utf-32-le", "replace"), np.uint32)
    owner = np.cumsum(codes == 10) if not any("\n" in t for t in held) else None
    if owner is None:
        sizes = np.array([len(t.lower()) + 1 for t in held])
        owner = np.concatenate([np.repeat(np.arange(1, len(held) + 1), sizes), [len(held) + 1]])
    codes = np.where(letters()[codes], codes, np.uint32(0))
    keep = codes != 0
    keep[1:] |= codes[:-1] != 0
    keep[0] = True
    codes, owner = codes[keep].astype(np.uint64), owner[keep] - 1
    has = np.zeros(len(held) + 1, bool)
    has[owner[codes != 0]] = True
    hashes, owners = [], []
    for n in SIZES:
        count = len(codes) - n + 1
        if count <= 0:
            continue
        inside = np.ones(count, bool)
        for k in range(1, n - 1):
            inside &= codes[k : k + count] != 0
        h = np.full(count, np.uint64(n))
        for k in range(n):
            h = h * _MULT + codes[k : k + count] + np.uint64(1)
        hashes.append(mixed(h[inside]))
        owners.append(owner[1 : 1 + count][inside])
    if not hashes:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64), has[: len(held)]
    return np.concatenate(hashes), np.concatenate(owners), has[: len(held)]


def held_out() -> Column:
    return F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary")) % 5 == 0


def train(docs: DataFrame, sample: int = SAMPLE, min_share: float = MIN_SHARE) -> dict | None:
    """The model: languages by name, training documents of each, filter words (words x SLOTS), false positive rates.

    None if no document has both a text and a language outside the held-out fifth.
    """
    known = docs.select("doc_id", "text", "lang").filter("text IS NOT NULL AND lang IS NOT NULL").filter(~held_out())
    counts = known.groupBy("lang").count().limit(MAX_LANGUAGES + 1).collect()
    if len(counts) > MAX_LANGUAGES:
        raise ValueError(f"more than {MAX_LANGUAGES} languages")
    if not counts:
        return None
    docs_of = {r["lang"]: r["count"] for r in counts}
    names = sorted(docs_of)
    share = {n: min(1.0, sample / docs_of[n]) for n in names}
    pairs = F.create_map(*[F.lit(x) for n in names for x in (n, share[n])])
    ranks = F.create_map(*[F.lit(x) for k, n in enumerate(names) for x in (n, k)])
    million = F.lit(1_000_000)
    chosen = known.filter(F.pmod(F.xxhash64("doc_id"), million) < F.element_at(pairs, F.col("lang")) * million)
    chosen = chosen.select(F.element_at(ranks, F.col("lang")).alias("l"), "text")

    def document_grams(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            langs = np.asarray(batch.column(0).to_numpy(zero_copy_only=False), np.int64)
            for index, held in pieces(batch.column(1).to_pylist()):
                h, owner, _ = grams(held)
                at = np.asarray(index)
                for lang in np.unique(langs[at]):
                    mine = langs[at][owner] == lang
                    order = np.lexsort((owner[mine], h[mine]))
                    g, o = h[mine][order], owner[mine][order]
                    new = np.ones(len(g), bool)
                    new[1:] = (g[1:] != g[:-1]) | (o[1:] != o[:-1])
                    found, times = np.unique(g[new], return_counts=True)
                    texts = len(np.unique(at[langs[at] == lang]))
                    found = np.concatenate([found.view(np.int64), [0]])
                    times = np.concatenate([times, [texts]])
                    kind = np.zeros(len(found), bool)
                    kind[-1] = True
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(np.full(len(found), lang, np.int32)), pa.array(kind), pa.array(found), pa.array(times.astype(np.int64))],
                        names=["l", "total", "gram", "n"],
                    )

    counted = chosen.mapInArrow(tidy(document_grams), "l int, total boolean, gram bigint, n bigint").groupBy("l", "total", "gram").agg(F.sum("n").alias("n"))
    counted = materialise(counted, "language-grams")
    totals = {r["l"]: r["n"] for r in counted.filter("total").collect()}  # one row per language
    least = F.create_map(*[F.lit(x) for k, n in totals.items() for x in (k, max(2.0, min_share * n) if n >= 20 else 1.0)])
    kept = counted.filter(~F.col("total")).filter(F.col("n") >= F.element_at(least, F.col("l")))
    slots = F.array(*[F.shiftrightunsigned("gram", SLOT_BITS * k).bitwiseAND(F.lit(SLOTS - 1)).cast("int") for k in range(HASHES)])
    bits = kept.select(
        F.explode(slots).alias("slot"),
        F.floor(F.col("l") / WORD).cast("int").alias("word"),
        F.expr(f"shiftleft(1L, l % {WORD})").alias("mask"),
    )
    sliced = bits.groupBy("slot", "word").agg(F.bit_or("mask").alias("mask")).toArrow()  # at most SLOTS rows a word
    words = np.zeros(((len(names) + WORD - 1) // WORD, SLOTS), np.uint64)
    words[sliced["word"].to_numpy(), sliced["slot"].to_numpy()] = sliced["mask"].to_numpy().astype(np.uint64)
    fill = np.array([np.count_nonzero(words[k // WORD] >> np.uint64(k % WORD) & np.uint64(1)) / SLOTS for k in range(len(names))])
    return {"names": names, "docs": np.array([docs_of[n] for n in names]), "words": words, "false": fill**HASHES}


def scores(texts: list[str | None], model: dict) -> tuple[list[str], np.ndarray]:
    """(language, score) of each text."""
    names, words = model["names"], model["words"]
    hits = np.zeros((len(texts), len(names)))
    total = np.zeros(len(texts))
    lettered = np.zeros(len(texts), bool)
    for index, held in pieces([t or "" for t in texts]):
        h, owner, has = grams(held)
        at = np.asarray(index)
        np.logical_or.at(lettered, at, has)
        mine = at[owner]
        total += np.bincount(mine, minlength=len(texts))
        places = [(h >> np.uint64(SLOT_BITS * k) & np.uint64(SLOTS - 1)).astype(np.int64) for k in range(HASHES)]
        for w in range(len(words)):
            mask = words[w][places[0]]
            for p in places[1:]:
                mask &= words[w][p]
            for k in range(w * WORD, min(len(names), (w + 1) * WORD)):
                found = (mask >> np.uint64(k - w * WORD) & np.uint64(1)).astype(bool)
                hits[:, k] += np.bincount(mine[found], minlength=len(texts))
    false = model["false"][None, :]
    left = np.maximum(hits - total[:, None] * false, 0.0) / np.maximum(1.0 - false, 1e-9)
    # Preference among equals: more training documents, then the smaller name.
    order = np.lexsort((np.arange(len(names)), -model["docs"]))
    best = order[np.argmax(left[:, order], axis=1)]
    share = np.clip(left[np.arange(len(texts)), best] / np.maximum(total, 1), 0.0, 1.0)
    return [names[b] if ok else "und" for b, ok in zip(best, lettered)], np.where(lettered, share, 0.0)


def _predicted(rows: DataFrame, model: dict | None, keep: str) -> DataFrame:
    """``rows`` (a column ``keep`` and a text) with lang_pred and score."""
    if model is None:
        return rows.select(keep, F.lit("und").alias("lang_pred"), F.lit(0.0).alias("score"))
    shared = rows.sparkSession.sparkContext.broadcast(model)  # SLOTS words per 62 languages
    schema = rows.schema
    out = f"`{keep}` {schema[keep].dataType.simpleString()}, lang_pred string, score double"

    def predict(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            langs, share = scores(batch.column(1).to_pylist(), shared.value)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(langs, pa.string()), pa.array(share)], names=[keep, "lang_pred", "score"])

    return rows.select(keep, "__body").mapInArrow(tidy(predict), out)


def identify(docs: DataFrame, model: dict | None = None) -> DataFrame:
    """doc_id, held_out, lang_pred, score of every row; trains on ``docs`` unless a model is given."""
    model = model or train(docs)
    rows = docs.select("doc_id", F.col("text").alias("__body"))
    return _predicted(rows, model, "doc_id").select("doc_id", held_out().alias("held_out"), "lang_pred", "score")


def keep_identified(docs: DataFrame, model: dict | None = None, min_score: float = MIN_SCORE) -> DataFrame:
    """The rows with a language: neither ``und`` nor with a share of known n-grams below ``min_score``."""
    model = model or train(docs)
    if model is None:
        return docs.limit(0)
    shared = docs.sparkSession.sparkContext.broadcast(model)

    at = docs.columns.index("text")

    def identified(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            # Views of the batch, so that few texts are Python strings at a time.
            for start in range(0, batch.num_rows, ROWS):
                some = batch.slice(start, ROWS)
                langs, share = scores(some.column(at).to_pylist(), shared.value)
                yield some.filter(pa.array(np.array([x != "und" for x in langs], bool) & (share >= min_score)))

    return docs.mapInArrow(tidy(identified), docs.schema)
