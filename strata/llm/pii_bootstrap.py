"""Personal data by bootstrapped contextual extraction.

1. One scan finds the base entities of every whole text (fixed patterns for
   e-mail, ip, card and phone), and the *candidates*: other words that look like
   identifiers (with digits, ``@`` or a written-out at sign), and identifiers of
   several words: digit groups joined by single blanks, dots, dashes or brackets,
   and addresses with blanks around the at sign or the dots, written out or not.
2. The words before an identifier and around it are its lexical patterns.  Base
   entities are the seeds.  Pattern-instance edges are counted over the corpus.
3. Spark scores the graph in rounds, per kind: a pattern is as good as the share
   of its instances that are believed (seeds fully, others at their score), and
   an instance that is no seed is believed by the noisy-or of its patterns.
   What confident patterns find are seeds of the next of ``STEPS`` scorings, so
   patterns beside which no base entity stands can become confident too.
4. Patterns of at least ``MIN_SEEDS`` distinct seeds and a score of
   ``MIN_SCORE`` extract: candidates in their places become further spans if they
   have the kind's make-up and do not overlap a base span.

Spans are code points, end exclusive.  Null text: empty, no spans.  Repeated rows
are separate rows; rows without a ``doc_id`` are returned; an empty table gives no
rows; other columns are not read.  Very long texts and runs take linear time.
"""

from __future__ import annotations

import re
from bisect import bisect_right
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.session import materialize

KINDS = ("email", "ip", "card", "phone")
ROUNDS = 3
STEPS = 3            # scorings; between them what was found becomes a seed
MIN_SEEDS = 3        # distinct seed entities that a pattern must have
MIN_SCORE = 0.8      # score from which a pattern extracts
SMOOTHING = 0.5      # disbelief that each pattern starts with, in instances
CONTEXT = 64         # characters read before and after an identifier for its two neighbouring words

# The base patterns of the contract.
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_AT_HOST = re.compile(r"@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_IP = re.compile(r"(?<![0-9])[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_DIGIT = re.compile(r"[0-9]")

_WORD = re.compile(r"(?<![^\x20\x09-\x0d])[^\x20\x09-\x0d]*(?:[0-9@]|\[at\]|\(at\))[^\x20\x09-\x0d]*")
_EDGE = ".,;:!?\"'()[]{}<>"

# Identifiers of several words.  No match is given back or begun again inside a run, so scans are linear.
_B = r"[\x20\t\xa0]"
_GROUPS = re.compile(rf"(?<![0-9A-Za-z_@.+/*-])\+?\(?[0-9*xX]++(?:\)?(?:{_B}?[-/]{_B}?|{_B}\.{_B}|\.|{_B})?\(?[0-9*xX]++)*+\)?")
_GROUP = re.compile(r"[0-9*xX]+")
_SHAPE = re.compile(  # cards of 4-4-4-4(-3) and 4-6-5, phones of 3-3-4 with or without a country's number
    rf"(?<![0-9*xX])(?:(?:[0-9*xX]{{4}}(?:{_B}|-)){{3}}[0-9*xX]{{4}}(?:(?:{_B}|-)[0-9]{{3}})?|[0-9*xX]{{4}}(?:{_B}|-)[0-9*xX]{{6}}(?:{_B}|-)[0-9*xX]{{5}}"
    rf"|(?:\+?[0-9]{{1,3}}(?:{_B}|[.-]))?(?:\([0-9]{{3}}\)|[0-9]{{3}}(?=[^0-9]))(?:{_B}|[.-])?[0-9]{{3}}(?:{_B}|[.-])[0-9]{{4}})(?![0-9*xX])")
_WRITTEN_DOT = rf"{_B}?[\[({{<]{_B}?(?:dot|\.){_B}?[\])}}>]{_B}?|{_B}dot{_B}|{_B}\.{_B}"
_AT = re.compile(rf"{_B}?(?:@|[\[({{<]{_B}?(?:at|@){_B}?[\])}}>]){_B}?|{_B}at{_B}", re.IGNORECASE)
_HOST = re.compile(rf"(?!www\.)[A-Za-z0-9-]{{1,63}}(?:(?:{_WRITTEN_DOT}|\.)[A-Za-z0-9-]{{1,63}}){{1,8}}+", re.IGNORECASE)
_OWNER = re.compile(rf"(?<![^\s\"'(\[{{<:;,=])[A-Za-z0-9_%+-][A-Za-z0-9._%+-]*(?:(?:{_WRITTEN_DOT})[A-Za-z0-9._%+-]+)*\Z", re.IGNORECASE)
_OWNER_CHARS = 80
_NO_OWNER = frozenset("us me you him her it them we i he she they this that these those and or is are was were be".split())


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = ord(c) - 48
        total += d if i % 2 == 0 else (2 * d if d < 5 else 2 * d - 9)
    return total % 10 == 0


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, kind number, end) of the base entities."""
    out = []
    end = 0
    if "@" in text:
        for m in _AT_HOST.finditer(text):  # the local part is what allowed characters precede the sign
            begin = m.start()
            while begin > end and text[begin - 1] in _LOCAL:
                begin -= 1
            if begin < m.start():
                out.append((begin, 0, m.end()))
                end = m.end()
    if _DIGIT.search(text):
        for m in _IP.finditer(text):
            if all(len(p.lstrip("0")) <= 3 and int("0" + p.lstrip("0")) <= 255 for p in m.group().split(".")):
                out.append((m.start(), 1, m.end()))
        for m in _CARD.finditer(text):
            digits = m.group().replace(" ", "").replace("-", "")
            if 14 <= len(digits) <= 19 and luhn(digits):
                out.append((m.start(), 2, m.end()))
        if "+" in text:
            for m in _PHONE.finditer(text):
                if 10 <= sum(c.isdigit() for c in m.group()) <= 15:
                    out.append((m.start(), 3, m.end()))
    return sorted(out)


def makeup(word: str) -> set[int]:
    """Kinds that a candidate could be of."""
    kinds = set()
    digits = sum("0" <= c <= "9" for c in word)
    lower = word.lower()
    at = max(lower.find("@"), lower.find("[at]"), lower.find("(at)"))
    if at > 0 and "." in lower[at:].strip("."):
        kinds.add(0)
    if digits >= 4 and re.fullmatch(r"[0-9a-fA-F]{1,4}(?:[.:][0-9a-fA-F]{0,4}){3,7}", word):
        kinds.add(1)
    groups = _GROUP.findall(word)
    if re.fullmatch(r"[0-9*xX][0-9*xX -]{11,22}[0-9]", word) and digits >= 4 and len(word) >= 13:
        if " " not in word or 13 <= sum(map(len, groups)) <= 19:
            kinds.add(2)
    if re.fullmatch(r"[(]?[0-9][0-9().\-/]{5,18}[0-9]", word) and 7 <= digits <= 15:
        kinds.add(3)
    elif re.fullmatch(r"\+?[(]?[0-9][0-9(). \-/]{5,28}[0-9]", word) and 2 * len(groups) <= digits and 7 <= digits <= 15:
        kinds.add(3)
    return kinds


def _neighbours(text: str, start: int, end: int) -> list[str]:
    """The lexical patterns of a place: the two words before it, and the words on both sides."""
    before = text[max(0, start - CONTEXT):start].lower().split()
    after = text[end:end + CONTEXT].lower().split()
    near = [w.strip(_EDGE) for w in before[-2:]]
    left = " ".join(["^", "^", *near][-2:])
    return ["< " + left, "<> " + (near[-1] if near else "^") + " _ " + (after[0].strip(_EDGE) if after else "$")]


def _bare(text: str, start: int, end: int) -> tuple[int, int]:
    """The place without brackets that have no partner inside it or enclose all of it."""
    if text[end - 1] == ")" and (text[start] == "(" and text.find(")", start, end) == end - 1 or "(" not in text[start:end]):
        end -= 1
    return start + (text[start] == "(" and ")" not in text[start:end]), end


def number_places(text: str) -> Iterator[tuple[int, int, int]]:
    """(start, end, bits of the possible kinds) of identifiers that are digit groups with blanks or brackets."""
    for m in _GROUPS.finditer(text):
        start, end = m.span()
        if end - start < 8:
            continue
        if end < len(text) and (text[end].isalnum() or text[end] in "_@"):  # its last group belongs to a word
            end = start + len(m.group().rstrip("0123456789*xX").rstrip("\x20\t\xa0./-("))
        pieces = [p.span() for p in _SHAPE.finditer(text, start, end)] or ([(start, end)] if end - start <= 34 else [])
        for s, e in pieces:
            s, e = _bare(text, s, e) if s < e else (s, e)
            said = text[s:e].replace("\t", " ").replace("\xa0", " ")
            if " " not in said and "(" not in said:
                continue
            if kinds := makeup(said) | makeup(said.replace(" . ", ".")):
                yield s, e, sum(1 << x for x in kinds)


def address_places(text: str) -> Iterator[tuple[int, int, int]]:
    """(start, end, bits) of addresses with blanks or written-out dots."""
    for m in _AT.finditer(text):
        host = _HOST.match(text, m.end())
        if not host or not re.search("[A-Za-z]{2}\\Z", host.group()):
            continue
        owner = _OWNER.search(text, max(0, m.start() - _OWNER_CHARS), m.start())
        if not owner or (m.group().strip().lower() == "at" and owner.group().lower() in _NO_OWNER):
            continue
        if re.search(_B, m.group() + host.group() + owner.group()) or "." not in host.group():
            yield owner.start(), host.end(), 1


class _Taken:
    """Places that are given away, in order and apart."""

    def __init__(self, spans: list[tuple[int, int]]):
        self.starts, self.ends = [], []
        for s, e in sorted(spans):
            if self.ends and s < self.ends[-1]:
                self.ends[-1] = max(e, self.ends[-1])
            else:
                self.starts.append(s)
                self.ends.append(e)

    def touch(self, start: int, end: int) -> bool:
        k = bisect_right(self.ends, start)
        return k < len(self.ends) and self.starts[k] < end


def candidates(text: str, base: list[tuple[int, int, int]]) -> list[tuple[int, int, int]]:
    """(start, end, bits of the possible kinds) of identifier-like places that no base span touches."""
    taken, out, last = _Taken([(s, e) for s, _, e in base]), [], 0
    for s, e, bits in sorted([*address_places(text), *number_places(text)]):
        if s >= last and not taken.touch(s, e):
            out.append((s, e, bits))
            last = e
    taken = _Taken([(s, e) for s, _, e in base] + [(s, e) for s, e, _ in out])
    for m in _WORD.finditer(text):
        word = m.group()
        start = m.start() + len(word) - len(word.lstrip(_EDGE))
        end = m.end() - (len(word) - len(word.rstrip(_EDGE)))
        if end - start < 6 or taken.touch(start, end):
            continue
        if kinds := makeup(text[start:end]):
            out.append((start, end, sum(1 << x for x in kinds)))
    return sorted(out)


_SPAN = "array<struct<start: int, kind: int, end: int>>"
_PLACE = "array<struct<start: int, end: int, kind: int, instance: string, patterns: array<string>>>"


def _scan(docs: DataFrame) -> DataFrame:
    """Per row: base spans, and the places of seeds (kind) and candidates (bits of the kinds, negative)."""
    span = pa.list_(pa.struct([("start", pa.int32()), ("kind", pa.int32()), ("end", pa.int32())]))
    place = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32()), ("kind", pa.int32()),
                                ("instance", pa.string()), ("patterns", pa.list_(pa.string()))]))

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            spans, places = [], []
            for raw in batch.column(2).to_pylist():
                text = raw.decode("utf-8", "replace") if raw else ""
                base = base_spans(text)
                spans.append([{"start": s, "kind": k, "end": e} for s, k, e in base])
                found = [(s, e, k) for s, k, e in base] + [(s, e, -bits) for s, e, bits in candidates(text, base)]
                places.append([{"start": s, "end": e, "kind": k, "instance": text[s:e].lower(),
                                "patterns": _neighbours(text, s, e)} for s, e, k in found])
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(spans, span),
                                              pa.array(places, place)], names=["row", "doc_id", "base", "places"])

    rows = docs.select(F.monotonically_increasing_id().alias("row"), F.col("doc_id").cast("long"), F.col("text").cast("binary"))
    return rows.mapInArrow(scan, f"row long, doc_id long, base {_SPAN}, places {_PLACE}")


def score_patterns(edges: DataFrame, rounds: int = ROUNDS) -> DataFrame:
    """(pattern, instance, kind) edges, kind null for candidates -> pattern, kind, score, seeds.

    Every (pattern, instance) counts once, so no frequent copy of one document carries a pattern.
    """
    edges = materialize(edges.groupBy("pattern", "instance").agg(F.max("kind").alias("kind")), "pii-edges")
    sizes = edges.groupBy("pattern").agg(F.count(F.lit(1)).alias("n")).withColumnRenamed("pattern", "of")
    # per pattern and kind that has a seed there: how many seeds of the kind, how many instances
    seeds = edges.filter("kind is not null").groupBy("pattern", F.col("kind").alias("k")).agg(F.count(F.lit(1)).alias("seeds"))
    base = materialize(seeds.join(sizes, F.col("pattern") == F.col("of")).drop("of"), "pii-patterns")
    score = F.col("seeds") / (F.col("n") + F.lit(SMOOTHING))
    patterns = base.withColumn("score", score)
    unseen = edges.filter("kind is null").select(F.col("pattern").alias("p"), "instance")
    for _ in range(rounds):
        reached = unseen.join(patterns, F.col("p") == F.col("pattern"))
        belief = reached.groupBy("instance", "k").agg(
            (1 - F.exp(F.sum(F.log(1 - F.least("score", F.lit(0.999)))))).alias("belief"))
        belief = belief.select(F.col("instance").alias("i"), F.col("k").alias("bk"), "belief")
        gained = (unseen.join(belief, F.col("instance") == F.col("i")).groupBy("p", "bk")
                  .agg(F.sum("belief").alias("gained")))
        patterns = base.join(gained, (F.col("pattern") == F.col("p")) & (F.col("k") == F.col("bk")), "left").select(
            "pattern", "k", "seeds", "n",
            ((F.col("seeds") + F.coalesce("gained", F.lit(0.0))) / (F.col("n") + F.lit(SMOOTHING))).alias("score"))
        patterns = materialize(patterns, "pii-patterns")
    return patterns


def bootstrap(edges: DataFrame, rounds: int = ROUNDS, steps: int = STEPS, min_seeds: int = MIN_SEEDS,
              min_score: float = MIN_SCORE) -> DataFrame:
    """(pattern, instance, kind, bits) edges -> the confident patterns: pattern, k, seeds, n, score.

    What the confident patterns of a step find (candidates whose ``bits`` allow the
    kind) are seeds of the next step, where patterns that no base entity has can
    become confident; it ends when nothing new is found.
    """
    edges = materialize(edges.groupBy("pattern", "instance").agg(F.max("kind").alias("kind"), F.bit_or("bits").alias("bits")), "pii-graph")
    for step in range(steps):
        scored = score_patterns(edges.select("pattern", "instance", "kind"), rounds)
        good = materialize(scored.filter((F.col("seeds") >= min_seeds) & (F.col("score") >= min_score)), "pii-confident")
        if step == steps - 1:
            break
        known = good.select(F.col("pattern").alias("p"), F.col("k"), "score")
        reached = edges.filter("kind is null").join(known, F.col("pattern") == F.col("p")).filter(F.expr("shiftright(bits, k) & 1 = 1"))
        found = reached.groupBy(F.col("instance").alias("i")).agg((-F.max(F.struct("score", (-F.col("k")).alias("k")))["k"]).alias("found"))
        found = materialize(found, "pii-found")
        if not found.take(1):
            break
        edges = materialize(edges.join(found, F.col("instance") == F.col("i"), "left").select(
            "pattern", "instance", F.coalesce("kind", "found").alias("kind"), "bits"), "pii-graph")
    return good


def personal_data(docs: DataFrame, rounds: int = ROUNDS, min_seeds: int = MIN_SEEDS,
                  min_score: float = MIN_SCORE, steps: int = STEPS) -> DataFrame:
    """Per row: doc_id, base (spans), added (spans the patterns discovered)."""
    rows = materialize(_scan(docs), "pii-rows")
    places = rows.select("row", F.explode("places").alias("x")).select("row", "x.*")
    edges = places.select(F.explode("patterns").alias("pattern"), "instance", F.when(F.col("kind") >= 0, F.col("kind")).alias("kind"),
                          F.when(F.col("kind") < 0, -F.col("kind")).otherwise(0).alias("bits"))
    good = bootstrap(edges, rounds, steps, min_seeds, min_score)
    good = good.select(F.col("pattern").alias("p"), F.col("k"), "score")
    open_places = places.filter("kind < 0").select("row", "start", "end", (-F.col("kind")).alias("bits"), F.explode("patterns").alias("pattern"))
    hits = open_places.join(good, F.col("pattern") == F.col("p")).filter(F.expr("shiftright(bits, k) & 1 = 1"))
    best = hits.groupBy("row", "start", "end").agg(F.max(F.struct("score", (-F.col("k")).alias("k")))["k"].alias("k"))
    added = best.groupBy("row").agg(F.collect_list(F.struct("start", (-F.col("k")).alias("kind"), "end")).alias("added"))
    return (rows.select("row", "doc_id", "base").join(added.withColumnRenamed("row", "of"), F.col("row") == F.col("of"), "left")
            .select("doc_id", "base", F.coalesce("added", F.array().cast(_SPAN)).alias("added")))


def digests(found: DataFrame) -> DataFrame:
    """doc_id, base counts per kind, base_sha256, spans, n_added, n_spans (base and added)."""
    names = F.array(*[F.lit(k) for k in KINDS])

    def written(spans):
        return F.array_join(F.transform(F.sort_array(spans), lambda s: F.concat_ws(
            ":", F.get(names, s["kind"]), s["start"].cast("string"), s["end"].cast("string"))), ",")

    def of_kind(number):
        return F.size(F.filter("base", lambda s: s["kind"] == number)).cast("long")

    counts = [of_kind(i).alias(f"n_{k}") for i, k in enumerate(KINDS)]
    return found.select("doc_id", *counts, F.sha2(written(F.col("base")), 256).alias("base_sha256"),
                        written(F.concat("base", "added")).alias("spans"), F.size("added").cast("long").alias("n_added"),
                        (F.size("base") + F.size("added")).cast("long").alias("n_spans"))
