"""SentencePiece encoding and decoding with the ``tokenizers`` library (operator 3).

The model file's protobuf is parsed and its parts are rebuilt: the normaliser
(character map, white-space rules, dummy prefix, metaspace marker), the unigram
scores - or, for a BPE model, the merges that its scores imply - and the byte
fallback.  The model is a parameter; the file is read on the driver and sent
to the tasks (its size is that of a vocabulary).

Where no piece of the vocabulary holds the marker after another character, the
marker always begins a new piece, and where none holds a line end, that stands
alone; so a normalised text is encoded exactly by encoding its marked words, cut
in front of line ends, one by one; each task encodes a distinct word once
(multithreaded batches), decodes its ids and holds them against the
sentencepiece library's.  All three are remembered in two generations: when the
younger is full it becomes the older one, and words met again move back.  The
ids are always the rebuilt backend's; ``parity`` is false for a text with a word
on which the library differs.  As the library, too, begins a piece at every
marker, its ids of a text are those of its words, so equal words are an equal text.

Decoding takes ids only: byte pieces become bytes, markers blanks, and the
dummy prefix goes.  A text's ids are its words' ids in a row, so it decodes to
their decoded words in a row.  ``roundtrip`` says that the decoded text is the
normalised text.

Defined results: null and empty texts have no ids and decode to the empty
text; every row gives one row, repeated ones too; texts of any length are
encoded whole; an empty table gives an empty result; other columns take no
part.
"""

from __future__ import annotations

import hashlib
import os
import re
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from tidemark.llm.common import text_of, tidy

MODEL_PATH = "/opt/tokenizers/piece_bpe_32k.model"
MARK = "▁"
#: Threads of one task's batch encoding.
THREADS = 2
#: Words of a generation, and the longest one that is remembered.
MEMO, LONGEST = 120_000, 200
#: Characters of text encoded at once, and rows whose texts are unpacked at once.
CHUNK, ROWS = 1 << 19, 1_000
_BYTE, _NORMAL, _USER, _CONTROL, _UNKNOWN = 6, 1, 4, 3, 2
_BPE = 2


class PieceCodec:
    """Encoder and decoder rebuilt from the bytes of a SentencePiece model."""

    def __init__(self, model: bytes, threads: int = THREADS, verify: bool = True):
        # Read by the library when it starts its thread pool.
        os.environ.setdefault("RAYON_NUM_THREADS", str(threads))
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "true" if threads > 1 else "false")
        from sentencepiece import SentencePieceProcessor, sentencepiece_model_pb2
        from tokenizers import Regex, Tokenizer, decoders, models, normalizers, pre_tokenizers

        proto = sentencepiece_model_pb2.ModelProto()
        proto.ParseFromString(model)
        trainer, rules = proto.trainer_spec, proto.normalizer_spec
        if any(p.type == _USER for p in proto.pieces):
            raise ValueError("user-defined pieces are not supported")
        unknown = next(k for k, p in enumerate(proto.pieces) if p.type == _UNKNOWN)
        if trainer.model_type == _BPE:
            vocab = {p.piece: k for k, p in enumerate(proto.pieces)}
            backend = models.BPE(
                vocab=vocab, merges=implied_merges(proto.pieces), unk_token=proto.pieces[unknown].piece, fuse_unk=True, byte_fallback=trainer.byte_fallback
            )
        else:
            backend = models.Unigram([(p.piece, p.score) for p in proto.pieces], unknown, trainer.byte_fallback)
        steps = [normalizers.Precompiled(rules.precompiled_charsmap)] if rules.precompiled_charsmap else []
        if rules.remove_extra_whitespaces:
            steps += [normalizers.Replace(Regex("^ +| +$"), ""), normalizers.Replace(Regex(" {2,}"), " ")]
        self.prefix = rules.add_dummy_prefix
        self.normaliser = normalizers.Sequence(steps) if steps else None
        self.words = Tokenizer(backend)
        if self.prefix:
            steps = [*steps, normalizers.Prepend(MARK)]
        self.whole = Tokenizer(backend)
        self.whole.normalizer = normalizers.Sequence([*steps, normalizers.Replace(" ", MARK)])
        usable = [p.piece for p in proto.pieces if p.type == _NORMAL]
        self.splits = not any(re.search(f"[^{MARK}]{MARK}", p) for p in usable)
        self.lines = not any("\n" in p for p in usable)
        if self.splits:
            self.whole.pre_tokenizer = pre_tokenizers.Split(Regex(f"{MARK}*[^{MARK}]+|{MARK}+"), "isolated")
        tail = [decoders.Strip(" ", 1, 0)] if self.prefix else []
        self.whole.decoder = decoders.Sequence([decoders.Replace(MARK, " "), decoders.ByteFallback(), decoders.Fuse(), *tail])
        self.words.decoder = decoders.Sequence([decoders.Replace(MARK, " "), decoders.ByteFallback(), decoders.Fuse()])
        self.check = SentencePieceProcessor(model_proto=model) if verify else None
        # A piece that starts with the marker starts a word; decoding cuts there.
        self.starts = np.array([p.piece.startswith(MARK) for p in proto.pieces], bool)
        # Word -> (ids, decoded, whether the library agrees).
        self.young: dict[str, tuple[bytes, str, bool]] = {}
        self.old: dict[str, tuple[bytes, str, bool]] = {}
        self.back: dict[bytes, str] = {}

    def normalised(self, text: str) -> str:
        """The text as it is cut into pieces: blanks are markers, the dummy prefix is there."""
        if self.normaliser is not None:
            text = self.normaliser.normalize_str(text)
        if not text:
            return ""
        return (MARK if self.prefix else "") + text.replace(" ", MARK)

    def plain(self, normal: str) -> str:
        """What decoding gives back for a normalised text."""
        text = normal.replace(MARK, " ")
        return text[1:] if self.prefix else text

    def _cut(self, normal: str) -> list[str]:
        if not self.splits:
            return [normal] if normal else []
        if normal[:1] == MARK and MARK + MARK not in normal:
            words = [MARK + w for w in normal[1:].split(MARK)] if normal != MARK else [MARK]
        else:
            words = re.findall(f"{MARK}*[^{MARK}]+|{MARK}+", normal)
        if not self.lines or "\n" not in normal:
            return words
        out: list[str] = []
        for w in words:
            if "\n" in w:
                first, *rest = w.split("\n")
                out += [first] if first else []
                out += ["\n" + part for part in rest]
            else:
                out.append(w)
        return out

    def _learn(self, new: list[str]) -> list[tuple[bytes, str, bool]]:
        """(ids, decoded, whether the library agrees) of each word."""
        ids = [x.ids for x in self.words.encode_batch_fast(new, add_special_tokens=False)]
        back = self.words.decode_batch(ids, skip_special_tokens=False)
        same = [True] * len(new)
        if self.check is not None and self.prefix:
            # The library adds the dummy prefix itself; where that would add to nothing, or is not there, the word is put behind a letter.
            letter = self.check.encode("a")
            alone = [w[:1] == MARK and w != MARK for w in new]
            asked = [w[1:].replace(MARK, " ") if by_itself else "a" + w.replace(MARK, " ") for w, by_itself in zip(new, alone)]
            told = self.check.encode(asked, num_threads=1)
            same = [(other if by_itself else other[len(letter) :]) == own for other, by_itself, own in zip(told, alone, ids)]
        return [(array("i", own).tobytes(), text, agrees) for own, text, agrees in zip(ids, back, same)]

    def forget(self) -> None:
        """Give back what is remembered of words."""
        self.young, self.old, self.back = {}, {}, {}

    def encoded(self, texts: list[str | None]) -> list[tuple[np.ndarray, bool, str, str]]:
        """(ids, whether both libraries agree, normalised text, decoded text) of each text."""
        normals = [self.normalised(t or "") for t in texts]
        out: list = [None] * len(texts)
        for some in _chunks(normals):
            cut = [self._cut(normals[k]) for k in some]
            young, old, new = self.young, self.old, []
            for w in set().union(*cut):
                if w not in young:
                    if w in old:
                        young[w] = old[w]
                    else:
                        new.append(w)
            young.update(zip(new, self._learn(new)))
            for k, words in zip(some, cut):
                if words:
                    ids, back, same = zip(*map(young.__getitem__, words))
                    text = "".join(back)
                    text = text[1:] if self.prefix and text[:1] == " " else text
                    out[k] = (np.frombuffer(b"".join(ids), np.int32), all(same), normals[k], text)
                else:
                    out[k] = (np.zeros(0, np.int32), True, normals[k], "")
            for w in new:
                if len(w) > LONGEST:
                    del young[w]
            if len(young) > MEMO:
                self.old, self.young = young, {}
        return out

    def encode(self, texts: list[str | None]) -> list[tuple[np.ndarray, bool, str]]:
        """(ids, whether both libraries agree, normalised text) of each text."""
        return [found[:3] for found in self.encoded(texts)]

    def decode(self, many: list[np.ndarray]) -> list[str]:
        """The text of each list of ids."""
        keys = []
        for ids in many:
            ids = np.ascontiguousarray(ids, np.int32)
            begin = np.flatnonzero(self.starts[ids])
            if len(ids) and (not len(begin) or begin[0]):
                begin = np.concatenate([[0], begin])
            cuts = (np.append(begin, len(ids)) * 4).tolist()
            raw = ids.tobytes()
            keys.append([raw[a:b] for a, b in zip(cuts, cuts[1:])])
        if len(self.back) > MEMO:  # starts anew
            self.back.clear()
        back = self.back
        new = list({k for words in keys for k in words if k not in back})
        back.update(zip(new, self.words.decode_batch([np.frombuffer(k, np.int32).tolist() for k in new], skip_special_tokens=False)))
        texts = ["".join([back[k] for k in words]) for words in keys]
        return [t[1:] if self.prefix and t[:1] == " " else t for t in texts]


def implied_merges(pieces) -> list[tuple[str, str]]:
    """Pairs of pieces that join to a piece, best score first."""
    score = {p.piece: p.score for p in pieces if p.type == _NORMAL}
    found = [(-s, k, p[:k], p[k:]) for p, s in score.items() for k in range(1, len(p)) if p[:k] in score and p[k:] in score]
    return [(left, right) for _, _, left, right in sorted(found)]


def _chunks(texts: list[str]) -> Iterator[list[int]]:
    held, size = [], 0
    for k, text in enumerate(texts):
        held.append(k)
        size += len(text)
        if size >= CHUNK:
            yield held
            held, size = [], 0
    if held:
        yield held


_CODECS: dict[bytes, PieceCodec] = {}


def codec(model: bytes) -> PieceCodec:
    """The process's codec of a model."""
    key = hashlib.md5(model).digest()
    if key not in _CODECS:
        _CODECS[key] = PieceCodec(model)
    return _CODECS[key]


def encode_texts(docs: DataFrame, model_path: str = MODEL_PATH, keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """``keep`` columns, ids, n_tokens, parity, roundtrip and decoded_sha256 of every row's text."""
    with open(model_path, "rb") as f:
        shared = docs.sparkSession.sparkContext.broadcast(f.read())
    kept = [docs.schema[c] for c in keep]
    schema = ", ".join([f"`{f.name}` {f.dataType.simpleString()}" for f in kept])
    schema += ", ids array<int>, n_tokens bigint, parity boolean, roundtrip boolean, decoded_sha256 string"
    names = [*keep, "ids", "n_tokens", "parity", "roundtrip", "decoded_sha256"]

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = codec(shared.value)
        try:
            # Views of the batches, so that few texts are Python strings at a time.
            for batch in (whole.slice(start, ROWS) for whole in batches for start in range(0, whole.num_rows, ROWS)):
                texts = batch.column(batch.num_columns - 1).to_pylist()
                for some in _chunks([t or "" for t in texts]):
                    done = own.encoded([texts[k] for k in some])
                    sizes = np.array([len(ids) for ids, *_ in done], np.int64)
                    flat = np.concatenate([ids for ids, *_ in done]) if done else np.zeros(0, np.int32)
                    lists = pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32)), pa.array(flat, pa.int32()))
                    at = pa.array(some)
                    yield pa.RecordBatch.from_arrays(
                        [batch.column(k).take(at) for k in range(batch.num_columns - 1)]
                        + [
                            lists,
                            pa.array(sizes),
                            pa.array([same for _, same, _, _ in done]),
                            pa.array([own.plain(normal) == text for _, _, normal, text in done]),
                            pa.array([hashlib.sha256(text.encode("utf-8", "surrogatepass")).hexdigest() for *_, text in done]),
                        ],
                        names=names,
                    )
        finally:
            own.forget()  # the process may serve other work next

    return docs.select(*[F.col(f"`{c}`") for c in keep], text_of().alias("__body")).mapInArrow(tidy(encode), schema)
