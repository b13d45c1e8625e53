"""Alignment of two tokenizers' ids over the same bytes, as a monoid of fragments.

Tokenizer A (byte-level BPE) encodes a space and the text, B (SentencePiece,
which adds that space itself) the text; neither reads control strings as special
tokens.  Byte offsets at which tokens of A and of B both end cut the two
sequences into *groups*; an A and a B token whose byte ranges overlap are
*linked*.  A link's count is how many links of the corpus join the same two ids.

A *fragment* is what is known of a byte range, from the tokens that end in it:
an open prefix (the tokens up to the first common end), closed groups, an open
suffix (the tokens behind the last common end).  A range without a common end is
one open run.  Joining two neighbours closes what lies between them, and is
associative.  A text of up to ``LONG_BYTES`` is one closed fragment.  Longer ones
are cut into chunks that tasks encode apart; the chunks' tokens are cut at every
``RANGE_BYTES`` of the document, wherever that falls, and Spark composes the
fragments ``FAN`` ranges at a time in as many rounds as the longest text needs.

Chunks are cut, and the ids of repeated words remembered (per task), only where
both tokenizers must begin anew: before a single space between two characters
that are not white space.  A vocabulary of B with a piece that has a space
further in is encoded by whole chunks of whole texts instead.

Ids and link counts of a document are kept in the shared folder between the two
passes: counting over the corpus, then scoring.  Counts of up to ``MAX_PAIRS``
id pairs are sent to the tasks; more are joined on the pair, dealt over salts.

Null or empty text, bytes that are not UTF-8, and texts whose tokens do not spell
their bytes have no tokens: zeros and ''.  Rows with the same id, or none, are
documents of their own.  An empty table gives no rows.  Other columns are not
read.  A document's digest needs its groups in one row, a few times its text.
"""

from __future__ import annotations

import hashlib
import os
import re
from array import array
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.llm import words as W
from strata.session import materialize

LONG_BYTES = 64 << 10
CHUNK_CHARS = 32 << 10
RANGE_BYTES = 16 << 10
FAN = 8
UNITS = 200_000         # words remembered in a task; the memo is emptied beyond it
MAX_PAIRS = 3_000_000   # id pairs whose counts are sent to the tasks (13 bytes each)
SALTS = 32

_SPACE_PAIR = re.compile(r"\s\s")
_SAFE_SPACE = re.compile(r"(?<=\S) (?=\S)")

ALIGNED = ("doc_id long, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, "
           "pairs binary, pair_links binary")
FRAGMENT = ("row_ long, doc_id long, at long, ok boolean, cut boolean, prefix_a binary, prefix_b binary, n_a long, n_b long, "
            "n_groups long, groups string, links binary, suffix_a binary, suffix_b binary")


def _byte_of_letter() -> dict[str, int]:
    """The byte that each printable letter of a byte-level vocabulary stands for."""
    printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in printable]
    return {chr(b): b for b in printable} | {chr(256 + i): b for i, b in enumerate(rest)}


# ------------------------------------------------------------- tokenizers

class TokenizerPair:
    """Both tokenizers, the bytes of their ids, and the code of an id pair."""

    def __init__(self, a_path: str, b_path: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        import sentencepiece
        from tokenizers import Tokenizer

        self.a = Tokenizer.from_file(a_path)
        self.a.encode_special_tokens = True
        self.b = sentencepiece.SentencePieceProcessor(model_file=b_path)
        letters = _byte_of_letter()
        self.a_bytes: list[bytes | None] = []
        for i in range(self.a.get_vocab_size(with_added_tokens=True)):
            token = self.a.id_to_token(i) or ""
            self.a_bytes.append(bytes(letters[c] for c in token) if token and all(c in letters for c in token) else None)
        self.b_bytes: list[bytes | None] = []
        for i in range(self.b.get_piece_size()):
            piece = self.b.id_to_piece(i)
            if self.b.is_byte(i):
                self.b_bytes.append(bytes([int(piece[1:-1], 16)]))
            else:
                self.b_bytes.append(None if self.b.is_control(i) or self.b.is_unknown(i)
                                    else piece.replace("▁", " ").encode())
        self.a_size = np.array([len(x or b"") for x in self.a_bytes], dtype=np.int64)
        self.b_size = np.array([len(x or b"") for x in self.b_bytes], dtype=np.int64)
        self.width = len(self.b_bytes)
        self.code = np.dtype("<u4") if len(self.a_bytes) * self.width <= 1 << 32 else np.dtype("<u8")
        self.by_unit = not any("▁" in self.b.id_to_piece(i).lstrip("▁") for i in range(self.width))
        self._links = "I" if self.code.itemsize == 4 else "Q"
        self._a_len, self._b_len = self.a_size.tolist(), self.b_size.tolist()
        self._a_name, self._b_name = ([str(i) for i in range(len(x))] for x in (self.a_bytes, self.b_bytes))

    def units(self, text: str) -> list[str]:
        """Pieces of a text that the tokenizers encode apart, each behind a space that is left out here."""
        if not self.by_unit or not text:
            return [text]
        if text[0].isspace() or text[-1].isspace() or _SPACE_PAIR.search(text):
            parts = _SAFE_SPACE.split(" " + text)
            parts[0] = parts[0][1:]
            return parts
        return text.split(" ")

    def closed(self, a: Sequence[int], b: Sequence[int]) -> tuple[str, bytes, int]:
        """Group text, link codes and number of groups of two runs that spell the same bytes."""
        if not len(a):
            return "", b"", 0
        a_name, b_name, width = self._a_name, self._b_name, self.width
        if len(a) == 1 or len(b) == 1:  # one group, all linked
            links = array(self._links, [x * width + y for x in a for y in b])
            return f"{','.join([a_name[x] for x in a])}|{','.join([b_name[y] for y in b])}", links.tobytes(), 1
        a_len, b_len = self._a_len, self._b_len
        i = j = i0 = j0 = 0
        ends_a, ends_b = a_len[a[0]], b_len[b[0]]
        groups, links = [], array(self._links)
        while True:
            links.append(a[i] * width + b[j])
            if ends_a == ends_b:
                i, j = i + 1, j + 1
                groups.append(f"{','.join([a_name[x] for x in a[i0:i]])}|{','.join([b_name[y] for y in b[j0:j]])}")
                if i == len(a):
                    return ";".join(groups), links.tobytes(), len(groups)
                i0, j0 = i, j
                ends_a += a_len[a[i]]
                ends_b += b_len[b[j]]
            elif ends_a < ends_b:
                i += 1
                ends_a += a_len[a[i]]
            else:
                j += 1
                ends_b += b_len[b[j]]


class UnitMemo(dict):
    """Unit -> (ids of a, ids of b, group text, link codes, groups), None where the tokens do not spell it.

    The ids are counted only, or kept as bytes (``keep_ids``).  Beyond ``UNITS``
    units, those that only one slice of texts needed are forgotten.
    """

    def __init__(self, pair: TokenizerPair, keep_ids: bool = False):
        super().__init__()
        self.pair, self.keep_ids = pair, keep_ids
        self.again: set[str] = set()

    def _forget(self) -> None:
        kept = {u: self[u] for u in self.again} if len(self.again) <= UNITS // 2 else {}
        self.clear()
        self.update(kept)
        self.again = set()

    def learn(self, needed: set[str]) -> None:
        """Encode the units not known yet, all in one call per tokenizer."""
        self.again |= self.keys() & needed
        if len(self) + len(needed) > UNITS:
            self._forget()
        new = list(needed.difference(self))
        if not new:
            return
        pair = self.pair
        coded = pair.a.encode_batch_fast([" " + u for u in new], add_special_tokens=False)
        for unit, enc, b in zip(new, coded, pair.b.encode(new, num_threads=1), strict=True):
            a = enc.ids
            spelt = (" " + unit).encode()
            if _spelling(pair.a_bytes, a) == spelt == _spelling(pair.b_bytes, b):
                self[unit] = (_raw(a) if self.keep_ids else len(a), _raw(b) if self.keep_ids else len(b), *pair.closed(a, b))
            else:
                self[unit] = None


def _spelling(of_id: list[bytes | None], ids: list[int]) -> bytes | None:
    try:
        return b"".join([of_id[i] for i in ids])
    except TypeError:  # an id that stands for no bytes
        return None


# -------------------------------------------------------------- fragments

def _tally(codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    values, n = np.unique(codes, return_counts=True)
    return values, n


@dataclass
class Fragment:
    """What the tokens that end in one byte range tell: open prefix, closed groups, open suffix."""

    cut: bool                 # whether tokens of a and b end together somewhere in the range
    prefix: tuple[list[int], list[int]]
    n_a: int = 0
    n_b: int = 0
    n_groups: int = 0
    groups: str = ""
    links: bytes = b""        # link codes, one per link
    suffix: tuple[list[int], list[int]] = ((), ())

    @classmethod
    def of(cls, pair: TokenizerPair, a: np.ndarray, a_ends: np.ndarray, b: np.ndarray, b_ends: np.ndarray) -> Fragment:
        """From the tokens of a range and the byte offsets at which they end."""
        common = np.intersect1d(a_ends, b_ends, assume_unique=True)
        if not len(common):
            return cls(False, (a.tolist(), b.tolist()))
        a0, a1 = np.searchsorted(a_ends, common[[0, -1]], side="right")
        b0, b1 = np.searchsorted(b_ends, common[[0, -1]], side="right")
        groups, links, n = pair.closed(a[a0:a1].tolist(), b[b0:b1].tolist())
        return cls(True, (a[:a0].tolist(), b[:b0].tolist()), int(a1 - a0), int(b1 - b0), n, groups, links,
                   (a[a1:].tolist(), b[b1:].tolist()))

    def then(self, pair: TokenizerPair, other: Fragment) -> Fragment:
        """The fragment of both ranges, ``other`` following."""
        if not self.cut:
            prefix = (self.prefix[0] + other.prefix[0], self.prefix[1] + other.prefix[1])
            return Fragment(other.cut, prefix, other.n_a, other.n_b, other.n_groups, other.groups, other.links, other.suffix)
        a, b = [*self.suffix[0], *other.prefix[0]], [*self.suffix[1], *other.prefix[1]]
        if not other.cut:
            return Fragment(True, self.prefix, self.n_a, self.n_b, self.n_groups, self.groups, self.links, (a, b))
        groups, links, n = pair.closed(a, b)
        text = ";".join([x for x in (self.groups, groups, other.groups) if x])
        return Fragment(True, self.prefix, self.n_a + len(a) + other.n_a, self.n_b + len(b) + other.n_b,
                        self.n_groups + n + other.n_groups, text, self.links + links + other.links, other.suffix)


#: What lies before a text: an end of both.  Texts begin with it.
BEGIN = Fragment(True, ([], []), suffix=([], []))


def _ids(payload: bytes) -> list[int]:
    return np.frombuffer(payload, dtype="<u4").tolist()


def _raw(ids: Sequence[int]) -> bytes:
    return array("I", ids).tobytes()


# ------------------------------------------------------------ documents

def _decoded(value) -> str:
    try:
        return (value or b"").decode()
    except UnicodeDecodeError:
        return ""


class _Rows:
    """Columns of ``ALIGNED`` rows under way."""

    def __init__(self, code: np.dtype):
        self.code, self.rows = code, []

    def add(self, doc_id, n_a: int, n_b: int, n_groups: int, groups: str, links: bytes) -> None:
        pairs, n = _tally(np.frombuffer(links, dtype=self.code))
        sha = hashlib.sha256(groups.encode()).hexdigest() if n_groups else ""
        kind = "u1" if n.max(initial=0) < 1 << 8 else "<u2" if n.max() < 1 << 16 else "<u4"
        self.rows.append((doc_id, n_a, n_b, n_groups, len(links) // self.code.itemsize, sha,
                          pairs.tobytes(), n.astype(kind).tobytes()))

    def take(self) -> pa.RecordBatch:
        kinds = [pa.int64()] * 5 + [pa.string(), pa.binary(), pa.binary()]
        names = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "groups_sha256", "pairs", "pair_links"]
        columns = zip(*self.rows, strict=True) if self.rows else [[] for _ in kinds]
        out = pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=names)
        self.rows = []
        return out


def _align_short(docs: DataFrame, a_path: str, b_path: str) -> DataFrame:
    """One closed fragment per document (doc_id, text binary)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pair = TokenizerPair(a_path, b_path)
        memo, out = UnitMemo(pair), _Rows(pair.code)
        for batch in W.slices(batches, "text", limit=1 << 20):
            texts = [_decoded(t) for t in batch.column(1).to_pylist()]
            parts = [pair.units(t) if t else [] for t in texts]
            memo.learn(set().union(*parts))
            for doc_id, units in zip(batch.column(0).to_pylist(), parts, strict=True):
                found = list(map(memo.__getitem__, units))
                if not found or None in found:
                    out.add(doc_id, 0, 0, 0, "", b"")
                    continue
                a, b, groups, links, n = zip(*found, strict=True)
                out.add(doc_id, sum(a), sum(b), sum(n), ";".join(groups), b"".join(links))
            yield out.take()

    return docs.mapInArrow(run, ALIGNED)


def _chunks(docs: DataFrame, a_path: str, b_path: str) -> DataFrame:
    """(row_, doc_id, text binary) -> (row_, doc_id, at, chunk): ``at`` is the byte offset in space and text."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        by_unit = TokenizerPair(a_path, b_path).by_unit
        for batch in W.slices(batches, "text"):
            for row, doc_id, value in zip(*[c.to_pylist() for c in batch.columns], strict=True):
                text = _decoded(value)
                starts, at, first = [], 0, 0
                while True:
                    m = _SAFE_SPACE.search(text, first + CHUNK_CHARS) if by_unit else None
                    piece = text[first:m.start() if m else None]
                    starts.append((at, piece.encode()))
                    if not m:
                        break
                    at += len(starts[-1][1]) + 1
                    first = m.end()
                n = len(starts)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([row] * n, pa.int64()), pa.array([doc_id] * n, pa.int64()),
                     pa.array([x[0] for x in starts], pa.int64()), pa.array([x[1] for x in starts], pa.binary())],
                    names=["row_", "doc_id", "at", "chunk"])

    return docs.mapInArrow(run, "row_ long, doc_id long, at long, chunk binary")


def _fragment_frame(rows: list[tuple]) -> pd.DataFrame:
    """(row_, doc_id, at, ok, fragment) -> columns of ``FRAGMENT``."""
    return pd.DataFrame(
        [(row, doc_id, at, ok, f.cut, _raw(f.prefix[0]), _raw(f.prefix[1]), f.n_a, f.n_b, f.n_groups, f.groups, f.links,
          _raw(f.suffix[0]), _raw(f.suffix[1])) for row, doc_id, at, ok, f in rows],
        columns=[c.split(" ")[0] for c in FRAGMENT.split(", ")]).astype({"doc_id": "Int64"})


def _fragment(r) -> Fragment:
    return Fragment(bool(r.cut), (_ids(r.prefix_a), _ids(r.prefix_b)), int(r.n_a), int(r.n_b), int(r.n_groups),
                    r.groups, bytes(r.links), (_ids(r.suffix_a), _ids(r.suffix_b)))


def chunk_fragments(pair: TokenizerPair, memo: UnitMemo, chunk: str, at: int, width: int) -> list[tuple[int, bool, Fragment]]:
    """(offset, spelt, fragment) per range of ``width`` document bytes that a chunk (behind a space at ``at``) touches."""
    units = pair.units(chunk)
    memo.learn(set(units))
    found = [memo[u] for u in units]
    if None in found:
        return [(at, False, Fragment(False, ([], [])))]
    a, b = (np.frombuffer(b"".join([f[k] for f in found]), dtype="<u4") for k in (0, 1))
    a_ends, b_ends = at + np.cumsum(pair.a_size[a]), at + np.cumsum(pair.b_size[b])
    edges = np.arange(at // width * width, int(a_ends[-1]) + width, width)
    a_cut, b_cut = (np.searchsorted(ends, edges, side="right") for ends in (a_ends, b_ends))
    out = []
    for k in range(len(edges) - 1):
        x, y = slice(a_cut[k], a_cut[k + 1]), slice(b_cut[k], b_cut[k + 1])
        if x.start < x.stop or y.start < y.stop:
            out.append((max(at, int(edges[k])), True, Fragment.of(pair, a[x], a_ends[x], b[y], b_ends[y])))
    return out


def _align_long(docs: DataFrame, a_path: str, b_path: str) -> DataFrame:
    """Fragments of chunks, composed in rounds (row_, doc_id, text binary; rows stored)."""
    longest = docs.agg(F.max(F.octet_length("text"))).first()[0] or 0  # one row
    chunks = _chunks(docs, a_path, b_path).repartition("row_", "at")

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pair = TokenizerPair(a_path, b_path)
        memo = UnitMemo(pair, keep_ids=True)
        for batch in W.slices(batches, "chunk", limit=1 << 20):
            rows = []
            for row, doc_id, at, chunk in zip(*[c.to_pylist() for c in batch.columns], strict=True):
                rows += [(row, doc_id, *made) for made in chunk_fragments(pair, memo, _decoded(chunk), at, RANGE_BYTES)]
            yield pa.RecordBatch.from_pandas(_fragment_frame(rows), preserve_index=False)

    def compose(pdf: pd.DataFrame) -> pd.DataFrame:
        pair = _pair(a_path, b_path)
        rows = list(pdf.sort_values("at").itertuples(index=False))
        if all(r.ok for r in rows):
            whole = _fragment(rows[0])
            for r in rows[1:]:
                whole = whole.then(pair, _fragment(r))
        else:
            whole = BEGIN
        doc_id = None if pd.isna(rows[0].doc_id) else int(rows[0].doc_id)
        return _fragment_frame([(rows[0].row_, doc_id, rows[0].at, all(r.ok for r in rows), whole)])

    fragments, width = chunks.mapInArrow(encode, FRAGMENT), RANGE_BYTES
    while True:
        width *= FAN
        fragments = fragments.groupBy("row_", F.floor(F.col("at") / F.lit(width)).alias("range_")).applyInPandas(
            compose, FRAGMENT)
        if width > longest + 1:
            break

    def finish(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pair = _pair(a_path, b_path)
        out = _Rows(pair.code)
        for batch in batches:
            for doc_id, r in zip(batch.column("doc_id").to_pylist(), batch.to_pandas().itertuples(index=False), strict=True):
                whole = BEGIN.then(pair, _fragment(r)) if r.ok else BEGIN
                if whole.suffix[0] or whole.suffix[1]:
                    whole = BEGIN  # the two token runs end apart
                out.add(doc_id, whole.n_a, whole.n_b, whole.n_groups, whole.groups, whole.links)
            yield out.take()

    return fragments.mapInArrow(finish, ALIGNED)


_PAIRS: dict[tuple[str, str], TokenizerPair] = {}


def _pair(a_path: str, b_path: str) -> TokenizerPair:
    """One pair of tokenizers per Python worker, for functions that run once per group."""
    key = (a_path, b_path)
    if key not in _PAIRS:
        _PAIRS.clear()
        _PAIRS[key] = TokenizerPair(a_path, b_path)
    return _PAIRS[key]


def align_documents(docs: DataFrame, a_path: str, b_path: str) -> DataFrame:
    """Per document (doc_id, text): ``ALIGNED``, stored; ``pairs`` are id pair codes, ``pair_links`` their links."""
    rows = docs.select("doc_id", F.col("text").cast("binary").alias("text"))
    size = F.coalesce(F.octet_length("text"), F.lit(0))
    short = _align_short(rows.where(size <= LONG_BYTES), a_path, b_path)
    many = materialize(rows.where(size > LONG_BYTES).withColumn("row_", F.monotonically_increasing_id())
                       .select("row_", "doc_id", "text"), "long-texts")
    both = short.union(_align_long(many, a_path, b_path))
    return materialize(both.withColumn("row_", F.monotonically_increasing_id()), "aligned")


# ---------------------------------------------------------- counts, scores

def _links_of(batch: pa.RecordBatch, code: np.dtype) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """All pair codes of a batch, their links, and how many pairs each row has."""
    pairs, n = batch.column("pairs").to_pylist(), batch.column("pair_links").to_pylist()
    sizes = np.array([len(p) // code.itemsize for p in pairs], dtype=np.int64)
    counts = [np.frombuffer(x, dtype=f"<u{len(x) // s}").astype(np.int64) for x, s in zip(n, sizes, strict=True) if s]
    return (np.frombuffer(b"".join(pairs), dtype=code).astype(np.int64),
            np.concatenate(counts) if counts else np.empty(0, np.int64), sizes)


def pair_counts(aligned: DataFrame, width: int, code: str) -> DataFrame:
    """(pair, n, best): links per id pair over the corpus, and whether no pair of the same B id has more."""
    kind = np.dtype(code)

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            pairs, n, _ = _links_of(batch, kind)
            values, place = np.unique(pairs, return_inverse=True)
            total = np.zeros(len(values), dtype=np.int64)
            np.add.at(total, place, n)
            yield pa.RecordBatch.from_arrays([pa.array(values), pa.array(total)], names=["pair", "n"])

    counts = (aligned.select("pairs", "pair_links").mapInArrow(add, "pair long, n long")
              .groupBy("pair").agg(F.sum("n").alias("n")))
    counts = materialize(counts.withColumn("b", F.col("pair") % F.lit(width)), "pair-counts")
    most = counts.groupBy("b").agg(F.max("n").alias("most"))  # a row per id of B
    return materialize(counts.join(most, "b").select("pair", "n", (F.col("n") == F.col("most")).alias("best")), "pair-best")


def link_scores(aligned: DataFrame, counts: DataFrame, code: str) -> DataFrame:
    """Per row of ``aligned``: its columns but the pairs, n_best and count_sum."""
    kept = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "groups_sha256"]
    kind = np.dtype(code)
    spark = aligned.sparkSession
    if counts.count() <= MAX_PAIRS:
        known = counts.toArrow().sort_by("pair")  # at most MAX_PAIRS rows
        table = spark.sparkContext.broadcast((known["pair"].to_numpy().astype(kind), known["n"].to_numpy(),
                                              known["best"].to_numpy()))

        def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            pair, links, best = table.value
            for batch in batches:
                codes, n, sizes = _links_of(batch, kind)
                at = np.searchsorted(pair, codes.astype(kind))
                ends = np.concatenate([[0], np.cumsum(sizes)])
                sums = [np.concatenate([[0], np.cumsum(x)])[ends] for x in (n * best[at], n * links[at])]
                yield pa.RecordBatch.from_arrays(
                    [*[batch.column(c) for c in kept], *[pa.array(np.diff(s).astype(np.int64)) for s in sums]],
                    names=[*kept, "n_best", "count_sum"])

        return aligned.select(*kept, "pairs", "pair_links").mapInArrow(
            score, "doc_id long, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, n_best long, count_sum long")

    def spread(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            codes, n, sizes = _links_of(batch, kind)
            yield pa.RecordBatch.from_arrays([pa.array(np.repeat(batch.column("row_").to_numpy(), sizes)), pa.array(codes),
                                              pa.array(n)], names=["row_", "pair", "links"])

    rows = aligned.select("row_", "pairs", "pair_links").mapInArrow(spread, "row_ long, pair long, links long")
    salted = counts.select("pair", "n", "best", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(SALTS - 1).cast("long"))).alias("salt"))
    sums = (rows.withColumn("salt", F.pmod(F.xxhash64("row_"), F.lit(SALTS))).join(salted, ["pair", "salt"])
            .groupBy("row_").agg(F.sum(F.when(F.col("best"), F.col("links")).otherwise(0)).alias("n_best"),
                                 F.sum(F.col("links") * F.col("n")).alias("count_sum")))
    zero = F.lit(0).cast("long")
    return aligned.join(sums, "row_", "left").select(*kept, F.coalesce("n_best", zero).alias("n_best"),
                                                     F.coalesce("count_sum", zero).alias("count_sum"))


def cross_tokenizer_alignment(docs: DataFrame, a_path: str, b_path: str) -> DataFrame:
    """Per document: doc_id, n_a, n_b, n_groups, n_links, groups_sha256, n_best, count_sum."""
    pair = TokenizerPair(a_path, b_path)
    aligned = align_documents(docs, a_path, b_path)
    counts = pair_counts(aligned, pair.width, pair.code.str)
    return link_scores(aligned, counts, pair.code.str)
