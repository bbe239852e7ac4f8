"""Token ids of a text by two tokenizers, a byte-level BPE file (A) and a SentencePiece model (B), and the bytes of each token.

Texts are encoded by segments.  A segment begins with the space or line end in
front of a word: no token of A spans such a place (its pattern begins a new
match there), nor does one of B if no piece holds the marker, or a line end,
beside another character in that way.  The files are looked at for this; if
either has a normaliser, another pattern or such pieces, whole texts are
encoded instead.  A task remembers segments' results in two generations:
when the younger is full it becomes the older one, and what is met again moves
back into the younger, so common segments stay and memory is bounded.
"""

from __future__ import annotations

import json
import os
import re
from array import array

import numpy as np

MARK = "▁"
#: Segments of a generation, and the longest one that is remembered.
MEMO, LONGEST = 250_000, 200
_BYTE, _NORMAL, _UNKNOWN = 6, 1, 2
_CUT = re.compile(r"(?<=\S)(?=[ \n]\S)")
_WIDE = re.compile(r"\s\s")


def byte_of() -> dict[str, int]:
    """Byte-level BPE's character of each byte, reversed: printable Latin-1 stands for itself, the others follow from U+0100."""
    plain = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or b >= 174]
    rest = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + k): b for k, b in enumerate(rest)}


class TwoTokenizers:
    def __init__(self, a_file: str, b_model: bytes):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from sentencepiece import SentencePieceProcessor, sentencepiece_model_pb2
        from tokenizers import Tokenizer

        told = json.loads(a_file)
        self.a = Tokenizer.from_str(a_file)
        self.a.encode_special_tokens = True
        self.b = SentencePieceProcessor(model_proto=b_model)
        proto = sentencepiece_model_pb2.ModelProto()
        proto.ParseFromString(b_model)
        byte = byte_of()
        self.a_bytes = [b""] * self.a.get_vocab_size()
        for token, k in self.a.get_vocab().items():
            self.a_bytes[k] = bytes(byte[c] for c in token) if all(c in byte for c in token) else token.encode()
        self.b_bytes = [bytes([int(p.piece[3:5], 16)]) if p.type == _BYTE else p.piece.replace(MARK, " ").encode() for p in proto.pieces]
        self._a_len, self._b_len = [len(x) for x in self.a_bytes], [len(x) for x in self.b_bytes]
        self._a_text, self._b_text = [str(k) for k in range(len(self.a_bytes))], [str(k) for k in range(len(self.b_bytes))]
        self.a_sizes, self.b_sizes = np.array(self._a_len, np.int64), np.array(self._b_len, np.int64)
        rules = proto.normalizer_spec
        usable = [p.piece for p in proto.pieces if p.type not in (_BYTE, _UNKNOWN)]
        cutter = told.get("pre_tokenizer") or {}
        self.splits = (
            told.get("normalizer") is None
            and cutter.get("type") == "ByteLevel"
            and cutter.get("use_regex", True)
            and not cutter.get("add_prefix_space")
            and not rules.precompiled_charsmap
            and not rules.remove_extra_whitespaces
            and rules.add_dummy_prefix
            and not any(re.search(f"[^{MARK}]{MARK}", p) or "\n" in p for p in usable)
            and len(self.b.encode("\n")) == 2
        )
        self.young: dict[str, tuple[bytes, bytes, str] | None] = {}
        self.old: dict[str, tuple[bytes, bytes, str] | None] = {}

    def segments(self, text: str) -> list[str]:
        """The segments of space + text; one that begins with a space and another character is given without the space."""
        if not self.splits:
            return [" " + text]
        if not (text[0].isspace() or text[-1].isspace() or _WIDE.search(text)):
            return text.replace("\n", " \n").split(" ")
        return [s[1:] if s[0] == " " and not s[1:2].isspace() else s for s in _CUT.split(" " + text)]

    def forget(self) -> None:
        """Give back what is remembered of segments."""
        self.young, self.old = {}, {}

    def _learn(self, new: list[str]) -> list[tuple[bytes, bytes, str] | None]:
        """(ids of A, ids of B, groups) of each segment; None where a tokenizer does not give back its bytes."""
        whole = [s if s[:1] in (" ", "\n") else " " + s for s in new]
        ids_a = [x.ids for x in self.a.encode_batch_fast(whole, add_special_tokens=False)]
        # B adds the space itself; in front of a line end it is a token of its own, which goes.
        ids_b = self.b.encode([s[1:] if s[0] == " " else s for s in whole], num_threads=1)
        bytes_a, bytes_b = self.a_bytes.__getitem__, self.b_bytes.__getitem__
        out = []
        for text, a, b in zip(whole, ids_a, ids_b):
            if text[0] == "\n":
                b = b[1:]
            same = b"".join(map(bytes_a, a)) == text.encode() == b"".join(map(bytes_b, b))
            out.append((array("i", a).tobytes(), array("i", b).tobytes(), self.groups(a, b)) if same else None)
        return out

    def groups(self, a: list[int], b: list[int]) -> str:
        """``a1,a2|b1;a3|b2,b3``: cut where a token of A and one of B end together."""
        a_len, b_len, a_text, b_text = self._a_len, self._b_len, self._a_text, self._b_text
        out, from_a, from_b, upto_b, end_a, end_b = [], 0, 0, 0, 0, 0
        for upto_a, k in enumerate(a, 1):
            end_a += a_len[k]
            while end_b < end_a:
                end_b += b_len[b[upto_b]]
                upto_b += 1
            if end_a == end_b:
                out.append(",".join([a_text[x] for x in a[from_a:upto_a]]) + "|" + ",".join([b_text[x] for x in b[from_b:upto_b]]))
                from_a, from_b = upto_a, upto_b
        return ";".join(out)

    def encode(self, texts: list[str | None]) -> list[list[tuple[bytes, bytes, str]] | None]:
        """Per text its segments' (ids of A, ids of B, groups); None for a text without tokens."""
        cut = [self.segments(t) if t else [] for t in texts]
        young, old, new = self.young, self.old, []
        for s in set().union(*cut):
            if s not in young:
                if s in old:
                    young[s] = old[s]
                else:
                    new.append(s)
        young.update(zip(new, self._learn(new)))
        out = []
        for words in cut:
            found = list(map(young.__getitem__, words))
            out.append(found if all(found) and found else None)
        for s in new:
            if len(s) > LONGEST:
                del young[s]
        if len(young) > MEMO:
            self.old, self.young = young, {}
        return out
