"""Quality rules, personal data, suffix dedup, n-gram join, string tiling against brute force."""

import hashlib
import random
import re
import time
from collections import Counter, defaultdict
from pathlib import Path

import numpy as np
import pytest
from pyspark.sql import functions as F

from strata.llm import pii_bootstrap, prefix_trie_join, quality_rules, string_tiling, suffix_dedup
from strata.llm.words import flat_word_hashes
from strata.session import materialize
from tests.llm.cases import LOWER, empty, hostile, prose, rows_of, words

SMALL = "/root/testdata/sf0.001/documents.parquet"
SHUFFLE_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@pytest.fixture(scope="module", params=["hostile", "sf0.001", "empty"])
def docs(request, spark):
    return {"hostile": lambda: hostile(spark), "sf0.001": lambda: spark.read.parquet(SMALL), "empty": lambda: empty(spark)}[request.param]()


# --- quality rules

def base_rules(text):
    w = words(text)
    windows = Counter(tuple(w[i:i + 5]) for i in range(len(w) - 4))
    again = {j for i in range(len(w) - 4) if windows[tuple(w[i:i + 5])] > 1 for j in range(i, i + 5)}
    lines = [x for x in (text or "").split("\n") if words(x)]
    failed = len(w) < 10 or 100 * len(again) > 20 * len(w)
    return (len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in text or ""), len(lines) - len(set(lines)), len(again), failed)


def test_base_rules(docs):
    found = quality_rules.judge_documents(docs).collect()
    assert sorted(((r.doc_id, r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed) for r in found), key=repr) \
        == sorted(((r.doc_id, *base_rules(r.text)) for r in docs.collect()), key=repr)
    assert all(r.kept == (not r.base_failed and not r.host_rejected) for r in found)


def test_filter_agrees_with_verdicts_and_keeps_columns(docs):
    kept = quality_rules.filter_documents(docs)
    assert kept.columns == docs.columns
    verdicts = quality_rules.judge_documents(docs)
    assert sorted(map(repr, (r.doc_id for r in kept.collect()))) == sorted(map(repr, (r.doc_id for r in verdicts.collect() if r.kept)))


def test_host_verdict_is_shrunk(spark):
    bad = "la la la la la la la la la la la la"
    rows = [(i, prose(i, 40), "good" if i % 2 else "fine") for i in range(200)]
    rows += [(1000 + i, bad if i < 45 else prose(2000 + i, 40), "farm") for i in range(50)]
    rows += [(3000, bad, "tiny"), (3001, prose(9, 40), None)]
    found = quality_rules.judge_documents(spark.createDataFrame(rows, "doc_id long, text string, source string")).collect()
    rejected = {r.doc_id for r in found if r.host_rejected}
    assert rejected == set(range(1000, 1050))  # one bad document does not condemn a host; nine in ten do


# --- personal data

EMAIL = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
IP = re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")


def luhn(digits):
    return sum(sum(divmod(2 * int(c), 10)) if i % 2 else int(c) for i, c in enumerate(digits[::-1])) % 10 == 0


def base_entities(text):
    out = [(m.start(), 0, m.end()) for m in EMAIL.finditer(text)]
    out += [(m.start(), 1, m.end()) for m in IP.finditer(text) if all(int(p) <= 255 for p in m.group().split("."))]
    for m in CARD.finditer(text):
        d = re.sub("[^0-9]", "", m.group())
        if 14 <= len(d) <= 19 and luhn(d):
            out.append((m.start(), 2, m.end()))
    out += [(m.start(), 3, m.end()) for m in PHONE.finditer(text) if 10 <= len(re.sub("[^0-9]", "", m.group())) <= 15]
    return sorted(out)


def test_base_spans(docs):
    expected = []
    for r in docs.collect():
        found = base_entities(r.text or "")
        said = ",".join(f"{pii_bootstrap.KINDS[k]}:{s}:{e}" for s, k, e in found)
        expected.append((r.doc_id, *[sum(k == i for _, k, _ in found) for i in range(4)], hashlib.sha256(said.encode()).hexdigest()))
    got = pii_bootstrap.digests(pii_bootstrap.personal_data(docs))
    assert rows_of(got.select("doc_id", "n_email", "n_ip", "n_card", "n_phone", "base_sha256")) == sorted(expected, key=repr)


def test_base_spans_on_random_strings():
    r = random.Random(5)
    for _ in range(3000):
        text = "".join(r.choice("a1.@+ -(9%0x") for _ in range(r.randrange(60)))
        assert pii_bootstrap.base_spans(text) == base_entities(text), text
    for text in ("a" * 300_000, "1" * 300_000, "@a.b " * 60_000, "1." * 150_000, "+" * 300_000, "a@" * 150_000):
        pii_bootstrap.base_spans(text)  # linear


def test_patterns_discover_unseen_identifiers(spark):
    rows = [(i, f"{prose(i, 20)} please reach me under user{i}@mail{i}.org {prose(1000 + i, 20)}") for i in range(30)]
    rows += [(100, f"{prose(50, 20)} please reach me under bob[at]hidden.org {prose(51, 20)}"),
             (101, f"{prose(52, 20)} version 3.11.2-rc1 of tool[at]thing.org {prose(53, 20)}"), (102, None)]
    found = {r.doc_id: r for r in pii_bootstrap.digests(pii_bootstrap.personal_data(
        spark.createDataFrame(rows, "doc_id long, text string"))).collect()}
    start = rows[30][1].index("bob[at]")
    assert found[100].spans == f"email:{start}:{start + len('bob[at]hidden.org')}" and found[100].n_email == 0
    assert found[101].n_added == 0 and found[102].spans == "" and all(found[i].n_added == 0 for i in range(30))


SPACED = [("email", "bob (at) hidden.org"), ("email", "bob at hidden dot org"), ("email", "ann.lee [at] mail [dot] hidden [dot] org"),
          ("email", "bob @ hidden.org"), ("email", "bob(at)hidden(dot)org"), ("phone", "415 555 0132"), ("phone", "(415) 555-0132"),
          ("phone", "(415)555-0132"), ("phone", "1 (415) 555 0132"), ("phone", "030 1234 5678"), ("phone", "415 - 555 - 0132"),
          ("card", "4111 1111 1111 1112"), ("card", "4111-1111 1111-1112"), ("card", "xxxx xxxx xxxx 1112"), ("card", "3782 822463 10006")]


def test_patterns_discover_identifiers_with_spaces(spark):
    said = {"email": "please reach me under", "phone": "ring my desk on", "card": "charge this card number"}
    seeds = {"email": lambda i: f"user{i}@mail{i}.org", "phone": lambda i: f"+49 (30) 1234-{5000 + i}",
             "card": lambda i: next(d for d in (f"4111 1111 1111 {i:03}{c}" for c in range(10)) if luhn(d.replace(" ", "")))}
    rows = [(i, f"{prose(i, 20)} {said[k]} {seeds[k](i)} {prose(1000 + i, 20)}") for k in said for i in range(100, 130)]
    rows += [(1000 + i, f"{prose(i, 20)} {said[k]} {x} {prose(50 + i, 20)}") for i, (k, x) in enumerate(SPACED)]
    rows += [(2000 + i, f"{prose(i, 20)} none of {x}, {prose(50 + i, 20)}") for i, (_, x) in enumerate(SPACED)]
    found = {}
    for r in pii_bootstrap.digests(pii_bootstrap.personal_data(spark.createDataFrame(rows, "doc_id long, text string"))).collect():
        found.setdefault(r.doc_id, r)
    for i, (kind, x) in enumerate(SPACED):
        start = rows[90 + i][1].index(x)
        assert found[1000 + i].spans == f"{kind}:{start}:{start + len(x)}", x
        assert found[2000 + i].n_added == 0


def test_what_is_found_finds_more(spark):
    """Base addresses stand by one context only; masked ones there are seeds of a second, and that of a third."""
    r = random.Random(11)

    def masked(name):
        return f"{name}[at]hidden.org"

    shared, lone = [masked(f"u{i}x") for i in range(6)], [masked(f"v{i}y") for i in range(6)]
    last = [masked(f"w{i}z") for i in range(6)]
    texts = [f"mailbox {x} please" for x in [f"a{i}@open.org" for i in range(30)] + shared]
    texts += [f"reachable {x} daily" for x in shared + lone] + [f"scribe {x} often" for x in lone + last]
    texts += [f"version b{i}r4[at]9 shipped" for i in range(20)]  # look alike, but no context is believed
    r.shuffle(texts)
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    added = {k: {texts[x.doc_id].split()[1] for x in pii_bootstrap.digests(pii_bootstrap.personal_data(docs, steps=k)).collect()
                 if x.n_added} for k in (1, 2, 3)}
    assert added[1] == set(shared)
    assert added[2] == {*shared, *lone}
    assert added[3] == {*shared, *lone, *last}


def test_candidates_with_spaces():
    def said(text):
        return [text[s:e] for s, e, _ in pii_bootstrap.candidates(text, pii_bootstrap.base_spans(text))]

    assert said("in 2019 415 555 0132 (or 415 555 0199), 12 4111 1111 1111 1112.") == ["415 555 0132", "415 555 0199", "4111 1111 1111 1112"]
    assert said("1 2 3 4 5 6 7 8 9, see us at thing.org, at www.thing.org or at home. 12 people") == []
    assert said("bob (at) hidden.org. 415 555 0132 xylophones") == ["bob (at) hidden.org", "415 555 0132"]
    for text in ("1 " * 200_000 + "a", "(1) " * 100_000, "a at b dot " * 40_000, "x" * 300_000, "4111 1111 " * 40_000,
                 "a (at) " * 60_000, "(at)" * 100_000, "a dot " * 60_000 + " at b.org", " . " * 100_000, "1 . " * 100_000):
        pii_bootstrap.candidates(text, [])  # linear


# --- substring dedup

def repeats_cut(texts, window=35):
    starts = Counter(tuple(w[i:i + window]) for w in map(words, texts) for i in range(len(w) - window + 1))
    for t in texts:
        w = words(t)
        gone = {j for i in range(len(w) - window + 1) if starts[tuple(w[i:i + window])] > 1 for j in range(i, i + window)}
        kept = " ".join(x for j, x in enumerate(w) if j not in gone)
        yield len(w), len(gone), hashlib.sha256(kept.encode()).hexdigest()


@pytest.mark.parametrize("group_runs", [2000, 1])
def test_repeats(docs, group_runs):
    rows = docs.collect()
    got = suffix_dedup.remove_repeats(docs, group_runs=group_runs)
    assert rows_of(got) == sorted([(r.doc_id, *x) for r, x in zip(rows, repeats_cut([r.text for r in rows]), strict=True)], key=repr)


def test_thousands_of_repeated_rows(spark):
    text = prose(7, 300)
    part = " ".join(text.split()[:150]) + " " + prose(8, 100)
    docs = spark.createDataFrame([(None, text)] * 3000 + [(None, part), (1, part + " end")], "doc_id long, text string")
    rows = docs.collect()
    expected = Counter((r.doc_id, *x) for r, x in zip(rows, repeats_cut([r.text for r in rows]), strict=True))
    assert Counter(map(tuple, suffix_dedup.remove_repeats(docs).collect())) == expected
    runs = suffix_dedup._run_rows(docs, 35).withColumn("mixed", F.lit(True))  # every run left open
    first = suffix_dedup._first_verdicts(docs, runs, 35, False)
    assert first.agg(F.max(F.size("open_runs"))).first()[0] < 100  # the runs of one text, not of its copies


def test_repeats_of_overlapping_passages(spark):
    r = random.Random(3)
    source = [f"t{r.randrange(30)}" for _ in range(400)]
    rows = [(i, " ".join(source[a:a + n]) + " " + prose(i, 10)) for i, (a, n) in enumerate((r.randrange(300), r.randrange(20, 100)) for _ in range(60))]
    got = suffix_dedup.remove_repeats(spark.createDataFrame(rows, "doc_id long, text string"), keep_text=True)
    expected = list(repeats_cut([t for _, t in rows]))
    assert {x.doc_id: (x.n_words, x.n_removed, x.kept_sha256) for x in got.collect()} == {i: e for (i, _), e in zip(rows, expected, strict=True)}
    assert all(hashlib.sha256(x.kept).hexdigest() == x.kept_sha256 for x in got.collect())


def near_copies(n, changes, length=200, seed=5):
    """Copies of a text, each with words of its own at some places, and some whole copies of copies."""
    r, base, rows = random.Random(seed), prose(seed, length).split(), []
    for i in range(n):
        text = list(base)
        for _ in range(r.randrange(changes + 1)):
            text[r.randrange(length)] = f"own{i}x{r.randrange(3)}"
        rows += [" ".join(text)] * (2 if i % 10 == 0 else 1)
    return list(enumerate(rows))


@pytest.mark.parametrize("changes", [1, 12])
def test_repeats_of_many_near_copies(spark, changes):
    rows = near_copies(120, changes) + [(1000 + i, t) for i, t in near_copies(40, changes, length=60, seed=6)]
    got = suffix_dedup.remove_repeats(spark.createDataFrame(rows, "doc_id long, text string"), group_runs=3)
    expected = repeats_cut([t for _, t in rows])
    assert rows_of(got) == sorted([(i, *e) for (i, _), e in zip(rows, expected, strict=True)], key=repr)


def test_a_large_group_is_cut_by_parts_not_by_windows(spark, monkeypatch):
    docs = spark.createDataFrame(near_copies(300, 1), "doc_id long, text string")
    written, write = {}, suffix_dedup.materialize

    def noted(df, name):
        written.setdefault(name, []).append(write(df, name))
        return written[name][-1]

    monkeypatch.setattr(suffix_dedup, "materialize", noted)
    suffix_dedup.remove_repeats(docs, group_runs=20)
    runs = written["open-runs"][0].join(written["large-prefixes"][0], F.col("prefix") == F.col("p"), "left_semi").count()
    assert runs > 200 and len(written["run-parts"]) == 3
    assert max(x.count() for x in written["run-parts"]) <= 5 * runs  # up to 28 windows in each


def shuffle_files(spark):
    folders = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().localDirs()
    return {f for d in folders for f in Path(d.getPath()).rglob("shuffle_*")}


def test_written_steps_leave_no_shuffle_files(spark):
    docs = spark.createDataFrame(near_copies(100, 1), "doc_id long, text string")
    setting, before = spark.conf.get(SHUFFLE_CLEANUP), shuffle_files(spark)
    got = suffix_dedup.remove_repeats(docs, group_runs=20)
    until = time.time() + 20  # executors delete them shortly after each write
    while (left := shuffle_files(spark) - before) and time.time() < until:
        time.sleep(0.1)
    assert not left
    assert spark.conf.get(SHUFFLE_CLEANUP) == setting  # the session's own setting is back
    assert got.count() == docs.count()


def test_the_session_keeps_its_own_cleanup_setting(spark):
    for own in ("false", "true"):
        spark.conf.set(SHUFFLE_CLEANUP, own)
        materialize(spark.range(3), "three")
        assert spark.conf.get(SHUFFLE_CLEANUP) == own
    spark.conf.unset(SHUFFLE_CLEANUP)


def test_flat_word_hashes_tell_words_apart():
    r = random.Random(1)
    spaces = [b" ", b"  ", b"\n", b"\t\x0b\x0c\r", b" \n "]
    texts = [b"", b" ", b"a", b" a b ", b"\x1c\x85 \x00 \x00\x00", b"x" * 3000 + b" " + b"x" * 3001]
    texts += [b"".join(r.choice([b"a", b"b", b"ab", b"\xc3\xa9", b"ba", b"y" * 300]) + r.choice(spaces) for _ in range(400)) for _ in range(30)]
    hashes, counts = flat_word_hashes(texts)
    split = [t.split() for t in texts]
    assert counts.tolist() == list(map(len, split))
    found = dict(zip((w for ws in split for w in ws), hashes.tolist(), strict=False))
    assert [found[w] for ws in split for w in ws] == hashes.tolist() and len(set(found.values())) == len(found)
    assert [len(x) for x in flat_word_hashes([])] == [0, 0]


def test_deep_nodes_are_maximal_repeats():
    def coded(*xs):
        return b"".join(x.to_bytes(8, "big") for x in xs)
    suffixes = [coded(1, 2, 3), coded(1, 2, 4), coded(1, 5, 6), coded(7, 8, 9)]
    assert suffix_dedup.deep_nodes(suffixes, 2) == [(2, [0, 1])]
    assert suffix_dedup.deep_nodes(suffixes, 1) == [(1, [0, 1, 2])]


# --- n-gram Jaccard join

def shingles(text):
    w = words((text or "").translate(LOWER))
    if not w:
        return frozenset()
    return frozenset([tuple(w)]) if len(w) < 5 else frozenset(tuple(w[i:i + 5]) for i in range(len(w) - 4))


def components(rows):
    """(doc_id, set) -> least id reachable, by comparing all pairs."""
    ids = list(range(len(rows)))

    def root(i):
        while ids[i] != i:
            i = ids[i]
        return i
    for i, (_, a) in enumerate(rows):
        for j in range(i):
            b = rows[j][1]
            if a and b and 175 * len(a & b) >= 75 * (len(a) + len(b)):
                ids[root(i)] = root(j)
    least = defaultdict(lambda: 1 << 60)
    for i, (d, _) in enumerate(rows):
        least[root(i)] = min(least[root(i)], d)
    return [least[root(i)] if s else d for i, (d, s) in enumerate(rows)]


def expected_components(docs):
    rows = [(r.doc_id, shingles(r.text)) for r in docs.collect()]
    known = [(d, s) for d, s in rows if d is not None]
    out = [(d, len(s), c) for (d, s), c in zip(known, components(known), strict=True)]
    return sorted(out + [(None, len(s), None) for d, s in rows if d is None], key=repr)


def test_near_duplicates(docs):
    assert rows_of(prefix_trie_join.near_duplicates(docs)) == expected_components(docs)


def chains(spark):
    """Chains of edits, so that components are wider than a link, plus unrelated texts that share a passage."""
    r, rows = random.Random(11), []
    shared = [f"s{i}" for i in range(40)]
    for c in range(6):
        text = [f"c{c}x{i}" for i in range(r.choice([12, 60, 150]))]
        for _ in range(25):
            rows.append((len(rows), " ".join(text)))
            text = list(text)
            for _ in range(r.choice([1, 1, 2, 4])):
                text[r.randrange(len(text))] = f"e{r.randrange(10**9)}"
    for _ in range(60):
        rows.append((len(rows), " ".join([*shared, *[f"u{r.randrange(10**9)}" for _ in range(r.randrange(3, 20))]])))
    return spark.createDataFrame(rows, "doc_id long, text string")


@pytest.mark.parametrize("block", [1000, 7])
@pytest.mark.parametrize("hot", [10_000, 2])
def test_near_duplicates_in_chains_blocks_and_hot_ngrams(spark, monkeypatch, block, hot):
    monkeypatch.setattr(prefix_trie_join, "HOT_ROWS", hot)
    docs = chains(spark)
    assert rows_of(prefix_trie_join.near_duplicates(docs, block=block)) == expected_components(docs)


def test_shingle_sets_of_many_texts_at_once(docs):
    texts = [r.text for r in docs.collect()] + ["a b", "A\tB", "b a", "a b c d e", "y" * 300 + " z", "a b a b a b a b"]
    raws = [None if t is None else t.encode() for t in texts]
    flat, sizes = prefix_trie_join.shingle_sets(raws)
    sets = [s.tolist() for s in np.split(flat, np.cumsum(sizes)[:-1])]
    expected = [shingles(t) for t in texts]
    assert sizes.tolist() == [len(s) for s in expected] and all(s == sorted(set(s)) for s in sets)
    for x, a in zip(expected, sets, strict=True):
        assert [len(x & y) for y in expected] == [len(set(a) & set(b)) for b in sets]
    assert [a for part in prefix_trie_join.sliced(raws) for a in prefix_trie_join.shingle_sets(raws[part])[0].tolist()] == flat.tolist()
    empty_sets, none = prefix_trie_join.shingle_sets([])
    assert len(empty_sets) == len(none) == 0


@pytest.mark.parametrize("most", [3, 1 << 50])
def test_sets_in_a_row_come_in_order(most):
    r = np.random.default_rng(3)
    sketch = r.integers(0, most, 1 << prefix_trie_join.SKETCH_BITS)
    sets = [np.unique(r.integers(0, 1 << 64, n, dtype=np.uint64)) for n in (0, 5, 1, 0, 20_000, 300)]
    sizes = np.array([len(s) for s in sets])
    shift = np.uint64(64 - prefix_trie_join.SKETCH_BITS)
    expected = [x for s in sets for x in sorted(s.tolist(), key=lambda v: (sketch[v >> int(shift)], v))]
    assert prefix_trie_join.in_order(np.concatenate(sets), sizes, sketch).tolist() == expected


def test_groups_are_settled_a_few_at_a_time(spark, monkeypatch):
    monkeypatch.setattr(prefix_trie_join, "SLICE", 1)
    docs = chains(spark)
    assert rows_of(prefix_trie_join.near_duplicates(docs)) == expected_components(docs)


def test_trie_links_connect_all_links():
    r = random.Random(1)
    for _ in range(60):
        sets = [np.array(sorted(r.sample(range(12), r.randrange(1, 12)))) for _ in range(12)]
        sets = list({s.tobytes(): s for s in sets}.values())
        rows = [(i, frozenset(s.tolist())) for i, s in enumerate(sets)]
        parent = list(range(len(sets)))

        def root(i, parent=parent):
            while parent[i] != i:
                i = parent[i]
            return i
        for a, b in prefix_trie_join.trie_links(sets):
            assert 175 * len(rows[a][1] & rows[b][1]) >= 75 * (len(rows[a][1]) + len(rows[b][1]))
            parent[max(root(a), root(b))] = min(root(a), root(b))
        assert [root(i) for i in range(len(sets))] == components(rows)


def test_one_of_each_group(docs):
    kept = prefix_trie_join.one_of_each_group(docs)
    assert kept.columns == docs.columns
    ids = sorted((r.doc_id for r in kept.collect() if r.doc_id is not None))
    assert ids == sorted({d for d, n, c in expected_components(docs) if d is not None and (n == 0 or d == c)})


# --- string tiling

def naive_tiles(item, doc, k):
    """Greedy string tiling by trying every pair of places for the longest unmarked match."""
    k, used_i, used_d, out = min(k, len(item)), set(), set(), 0
    while k:
        best = (0, 0, 0)
        for i in range(len(item)):
            for j in range(len(doc)):
                n = 0
                while (i + n < len(item) and j + n < len(doc) and item[i + n] == doc[j + n]
                       and i + n not in used_i and j + n not in used_d):
                    n += 1
                if n > best[0]:
                    best = (n, i, j)
        n, i, j = best
        if n < k:
            return out
        used_i |= set(range(i, i + n))
        used_d |= set(range(j, j + n))
        out += n
    return out


def test_tiles_agree_with_naive_tiling():
    r = random.Random(4)
    for _ in range(150):
        item = np.array([r.randrange(4) for _ in range(r.randrange(1, 14))], dtype=np.uint64)
        doc = np.array([r.randrange(4) for _ in range(r.randrange(30))], dtype=np.uint64)
        assert sum(n for _, _, n in string_tiling.tile(item, doc, 3)) == naive_tiles(item.tolist(), doc.tolist(), 3)


def normal(text):
    return re.sub(r"[!-/:-@\[-`{-~]", " ", text or "").translate(LOWER).split()


def test_leaks_against_all_pairs(spark):
    docs, items = spark.read.parquet(SMALL), spark.read.parquet("/root/testdata/sf0.001/benchmark.parquet")
    expected = set()
    for d in docs.collect():
        grams = {tuple(normal(d.text)[i:i + 5]) for i in range(len(normal(d.text)))}
        for it in items.collect():
            w = normal(it.text)
            if w and any(tuple(w[i:i + 5]) in grams for i in range(len(w))):
                if 100 * naive_tiles(w, normal(d.text), 5) >= 50 * len(w):
                    expected.add((d.doc_id, it.item_id))
    assert {(r.doc_id, r.item_id) for r in string_tiling.leaks(docs, items).collect()} == expected and expected


def test_reordered_passages_and_hostile_rows(spark):
    item = prose(70, 40, 10**6).replace("\n", " ").split()
    docs = hostile(spark)
    more = spark.createDataFrame([(500, " ".join(item[20:] + ["between"] + item[:20]).upper()), (501, " ".join(item[:15])), (502, prose(71, 300))],
                                 "doc_id long, text string")
    docs = docs.unionByName(more, allowMissingColumns=True)
    items = spark.createDataFrame([(1, " ".join(item)), (2, None), (3, ""), (4, "one"), (1, " ".join(item)), (None, " ".join(item))],
                                  "item_id long, text string")
    found = {(r.doc_id, r.item_id) for r in string_tiling.leaks(docs, items).collect()}
    assert found == {(500, 1), (500, None), (3, 4), (4, 4), (5, 4), (6, 4)}
    left = string_tiling.drop_contaminated(docs, items)
    assert left.columns == docs.columns and left.count() == docs.count() - 1  # an item of one word drops nothing
    assert string_tiling.leaks(empty(spark), items).collect() == [] == string_tiling.leaks(docs, items.limit(0)).collect()
