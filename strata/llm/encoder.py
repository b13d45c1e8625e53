"""Token ids of whole texts with the ``tokenizers`` library, each distinct word encoded once per worker.

For a byte-level BPE whose pre-tokenizer is the regular one (no normalizer, no
prefix space), a single space between two non-space characters is always a
pre-token boundary, and the space belongs to what follows.  So the ids of a text
are the ids of its space-separated pieces in a row.  Pieces are remembered, and
so are their pre-tokens, which the library's model encodes.  Whatever is not
plainly covered is encoded by the whole tokenizer: texts with a special token's
string or with space at an end, pieces with other characters than printable
ASCII, line ends and Latin letters, and every text of another kind of tokenizer.

Many texts at once (``encode_many``) are cut into pre-tokens by numpy where they hold
nothing but those characters and spaces: only distinct pre-tokens become objects, and
each occurrence is compared, byte by byte, with the one that is encoded for it.
"""

from __future__ import annotations

import codecs
import json
import os
import re
from array import array
from functools import lru_cache

import numpy as np
import pandas as pd

from strata.llm.words import byte_sums

PIECES = 150_000      # pieces and pre-tokens remembered per task; a memo is emptied beyond its limit
PRETOKENS = 300_000
SLICE_CHARS = 1 << 20  # of texts that are cut at a time
_SPACE_PAIR = re.compile(r"\s\s")
_SAFE_SPACE = re.compile(r"(?<=\S) (?=\S)")
_LATIN = "A-Za-zÀ-ÖØ-öø-ɏ"
_PLAIN = re.compile(rf"[\n!-~{_LATIN}]+")
# Fixed value: the pre-token pattern of byte-level BPE, on the characters of _PLAIN.
_PRETOKEN = re.compile(rf"'s|'t|'re|'ve|'m|'ll|'d| ?[{_LATIN}]+| ?[0-9]+| ?[^\s{_LATIN}0-9]+|\s+(?!\S)|\s+")
_PLAIN_TEXT = re.compile(rf"[ \n!-~{_LATIN}]+")
_SPACE, _BREAK, _LETTER, _DIGIT, _SIGN, _END = range(6)  # kinds of bytes; _END parts texts
_KINDS = bytes(_END if i == 0 else _SPACE if i == 32 else _BREAK if i == 10 else _DIGIT if 48 <= i <= 57 else
               _LETTER if i >= 128 or chr(i).isalpha() else _SIGN for i in range(256))


def pretoken_starts(joined: bytes) -> tuple[np.ndarray, np.ndarray]:
    """(starts, ends) of the pre-tokens of plain texts that each end with a zero byte; the zero bytes are among them."""
    data = np.frombuffer(joined, dtype=np.uint8)
    kind = np.frombuffer(joined.translate(_KINDS), dtype=np.uint8)
    blank, end = kind <= _BREAK, kind == _END
    as_run = np.maximum(kind, _BREAK)  # spaces and line ends stand in one run
    begins = np.ones(len(data) + 3, dtype=bool)  # room for what follows a contraction
    at = begins[:len(data)]
    at[1:] = as_run[1:] != as_run[:-1]
    at[1:] &= blank[1:] | (kind[:-1] != _SPACE)  # a space belongs to what follows
    at |= end
    at[:-1] |= blank[:-1] & ~blank[1:] & ~end[1:]  # the last of some blanks does not belong to the others
    quotes = np.flatnonzero(data[:-2] == 39)
    before = np.where(quotes > 0, kind[quotes - 1], _END)
    quotes = quotes[(before != _SPACE) & (before != _SIGN)]
    one, two = data[quotes + 1], data[quotes + 2]
    short = np.isin(one, np.frombuffer(b"stmd", dtype=np.uint8))
    long = (np.isin(one, np.frombuffer(b"rv", dtype=np.uint8)) & (two == 101)) | ((one == 108) & (two == 108))
    at[quotes[short | long] + 1] = False
    begins[quotes[short] + 2] = True
    begins[quotes[long] + 3] = True
    starts = np.flatnonzero(at)
    return starts, np.append(starts[1:], len(data))


def _byte_letters() -> dict[int, str]:
    """The printable letter that stands for each byte in a byte-level vocabulary."""
    printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in printable]
    return {b: chr(b) for b in printable} | {b: chr(256 + i) for i, b in enumerate(rest)}


_LETTERS = _byte_letters()
_LETTER_TABLE = "".join(_LETTERS[i] for i in range(256))


class _Pretokens(dict):
    """Ids of pre-tokens (UTF-8)."""

    def __init__(self, model):
        super().__init__()
        self.model = model

    def __missing__(self, pretoken: bytes) -> bytes:
        if len(self) >= PRETOKENS:
            self.clear()
        coded = codecs.charmap_decode(pretoken, "strict", _LETTER_TABLE)[0]
        ids = self[pretoken] = array("I", [t.id for t in self.model.tokenize(coded)]).tobytes()
        return ids


class Encoder:
    def __init__(self, path: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        spec = json.loads(self.tokenizer.to_str())
        pre = spec.get("pre_tokenizer") or {}
        self.by_piece = (pre.get("type") == "ByteLevel" and not pre.get("add_prefix_space")
                         and pre.get("use_regex", True) and spec.get("normalizer") is None)
        self.special = [t["content"] for t in spec.get("added_tokens", [])]
        self.size = self.tokenizer.get_vocab_size(with_added_tokens=True)
        self.pieces: dict[str, bytes] = {}
        self.pretokens = _Pretokens(self.tokenizer.model)

    def forget(self) -> None:
        """Empty the memos (at the end of a task: workers outlive them)."""
        self.pieces.clear()
        self.pretokens.clear()

    def _whole(self, text: str) -> bytes:
        return array("I", self.tokenizer.encode(text, add_special_tokens=False).ids).tobytes()

    def _piece(self, piece: str, lead: str) -> bytes:
        if not _PLAIN.fullmatch(piece):
            return self._whole(lead + piece)
        known = self.pretokens
        return b"".join([known[p.encode()] for p in _PRETOKEN.findall(lead + piece)])

    def encode(self, text: str) -> np.ndarray:
        """Ids (uint32) of a text."""
        if not self.by_piece or not text or text[0] == " " or text[-1] == " " or any(s in text for s in self.special):
            return np.frombuffer(self._whole(text), dtype="<u4")
        parts = _SAFE_SPACE.split(text) if _SPACE_PAIR.search(text) else text.split(" ")
        first = self._piece(parts[0], "")
        known = self.pieces
        if len(known) >= PIECES:
            known.clear()
        found = list(map(known.get, parts))
        found[0] = first
        if None in found:
            for i, ids in enumerate(found):
                if ids is None:
                    found[i] = ids = known.get(parts[i]) or self._piece(parts[i], " ")
                    known[parts[i]] = ids
        return np.frombuffer(b"".join(found), dtype="<u4")

    def encode_many(self, texts: list[str]) -> list[np.ndarray]:
        """Ids (uint32) of each text."""
        plain = [i for i, t in enumerate(texts) if self.by_piece and _PLAIN_TEXT.fullmatch(t) and not any(s in t for s in self.special)]
        out: list[np.ndarray | None] = [None] * len(texts)
        held, size = [], 0
        for n, i in enumerate(plain):
            held.append(i)
            size += len(texts[i])
            if size >= SLICE_CHARS or n == len(plain) - 1:
                for k, ids in zip(held, self._plain([texts[k] for k in held]), strict=True):
                    out[k] = ids
                held, size = [], 0
        return [self.encode(t) if ids is None else ids for t, ids in zip(texts, out, strict=True)]

    def _plain(self, texts: list[str]) -> list[np.ndarray]:
        joined = "\0".join([*texts, ""]).encode()
        starts, ends = pretoken_starts(joined)
        data = np.frombuffer(joined, dtype=np.uint8)
        sums, scale = byte_sums(data)
        which, _ = pd.factorize((sums[ends] - sums[starts]) * scale[starts])
        first = np.empty(which.max() + 1, dtype=np.int64)
        first[which[::-1]] = np.arange(len(which) - 1, -1, -1)
        sizes, model = ends - starts, first[which]
        if (sizes != sizes[model]).any() or (data != data[np.arange(len(data)) + np.repeat(starts[model] - starts, sizes)]).any():
            return [self.encode(t) for t in texts]  # two pre-tokens of one hash
        known = self.pretokens
        found = [known[joined[a:b]] if joined[a] else b"" for a, b in zip(starts[first].tolist(), ends[first].tolist(), strict=True)]
        ids, counts = np.frombuffer(b"".join(found), dtype="<u4"), np.array([len(x) // 4 for x in found])
        begin = np.cumsum(counts) - counts
        many = counts[which]
        until = np.cumsum(many)
        flat = ids[np.arange(until[-1]) + np.repeat(begin[which] - until + many, many)]
        return np.split(flat, until[data[starts] == 0][:-1])


@lru_cache(maxsize=2)
def encoder(path: str) -> Encoder:
    return Encoder(path)
