"""Chat windows, Pfair mixing, co-training."""

import hashlib
import random
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from strata.llm import chat_windows, cotraining, pfair_mix
from strata.llm.queries import op4_chat_windows
from tests.llm.cases import empty, hostile

# --- chat windows

HEADER = "conv_id long, turn long, role string, text string, window int, tokens string"


def conversations(spark):
    r = random.Random(8)
    rows = [(1, 0, "system", "be kind <|im_end|>\n", 0, "x"), (1, 1, "user", "a\\|b <| \\\\ <\\| <|im_start|>user", 0, "x"),
            (1, 2, "assistant", None, 0, "x"), (1, 3, "assistant", "\\", 0, "x"), (2, 0, "sys\ntem", "", 0, "x"),
            (2, 0, None, "no role", 0, "x"), (2, None, "assistant", "tie", 0, "x"), (2, None, "assistant", "tie", 0, "x"),
            (3, 0, "system", "only a system turn", 0, "x"), (None, 0, "assistant", "nobody's\n\n", 0, "x")]
    for c in range(4, 14):
        rows += [(c, t, "system" if t == 0 and c % 2 else "user" if t % 2 else "assistant",
                  " ".join("é<|\\"[r.randrange(4)] + f"w{r.randrange(99)}" for _ in range(r.randrange(60 if c < 13 else 900))), 0, "x")
                 for t in range(r.randrange(1, 40))]
    return spark.createDataFrame(rows, HEADER)


def expected_turns(rows):
    convs = {}
    for r in rows:
        convs.setdefault(r.conv_id, []).append(((r.turn is not None, r.turn or 0), r.role or "", r.text or ""))
    out = {}
    for c, turns in convs.items():
        turns.sort()
        said = "".join(f"{role}\n{text}\n" for _, role, text in turns)
        loss = "".join(text for _, role, text in turns if role == "assistant")
        out[c] = (len(turns), hashlib.sha256(said.encode()).hexdigest(), len(loss), hashlib.sha256(loss.encode()).hexdigest())
    return out


@pytest.mark.parametrize("budget", [40, 512])
def test_windows_read_back(spark, budget):
    turns = conversations(spark)
    windows = chat_windows.chat_windows(turns, budget=budget, history_tokens=budget // 4).cache()
    got = chat_windows.digests(chat_windows.read_turns(windows)).collect()
    assert {r.conv_id: tuple(r)[1:5] for r in got} == expected_turns(turns.collect())
    chars = {}
    for w in windows.collect():
        chars[w.conv_id] = chars.get(w.conv_id, 0) + len(w.formatted)
        pieces = w.formatted.split("<|im_end|>\n")[:-1]
        assert all(p.startswith("<|im_start|>") for p in pieces) and w.n_repeated < len(pieces)
        led = w.window == 0 and w.formatted.startswith("<|im_start|>system\n")  # the system turn, new in the first window
        assert w.n_tokens <= budget or len(pieces) - w.n_repeated - led <= 1  # only a turn that is too large alone goes over
        targets = [p.split("\n", 1)[1] for p in pieces[w.n_repeated:] if p.startswith("<|im_start|>assistant\n")]
        assert [w.formatted[s.begin:s.end] for s in w.loss_spans] == targets
    assert {r.conv_id: r.formatted_chars for r in got} == chars
    later = [w for w in windows.collect() if w.window > 0 and w.conv_id is not None and w.conv_id % 2 and w.conv_id > 3]
    assert later and all(w.formatted.startswith("<|im_start|>system\n") for w in later)


def test_no_conversations(spark):
    assert chat_windows.chat_windows(conversations(spark).limit(0)).collect() == []


def test_query_adds_the_control_conversation(spark):
    rows = {r.conv_id: r for r in op4_chat_windows(spark, "/root/testdata/sf0.001").collect()}
    given = spark.read.parquet("/root/testdata/sf0.001/conversations.parquet")
    said = "<|im_end|><|im_start|>assistant ok"
    assert rows[-1].n_turns == 2 and rows[-1].loss_chars == len(said)
    assert rows[-1].loss_sha256 == hashlib.sha256(said.encode()).hexdigest()
    assert {c: tuple(r)[1:5] for c, r in rows.items() if c != -1} == expected_turns(given.collect())


def test_plan_is_native(spark):
    plan = chat_windows.read_turns(chat_windows.chat_windows(conversations(spark)))._jdf.queryExecution().toString()
    assert not any(x in plan for x in ("Python", "Arrow", "Pandas"))


# --- mixing

def test_a_mixed_table_can_be_mixed_again(spark):
    docs = spark.createDataFrame([(i, f"text {i}", f"s{i % 3}", "x", "y") for i in range(200)],
                                 "doc_id long, text string, source string, mix_place string, mix_source string")
    once = pfair_mix.mixed(docs, block_rows=4)
    again = pfair_mix.mixed(once, block_rows=4)
    assert again.columns == once.columns == [*docs.columns, "mix_block", "mix_slot", "mix_position"]
    assert sorted(map(tuple, again.collect())) == sorted(map(tuple, once.collect()))
    order = pfair_mix.in_mixed_order(once, block_rows=4)
    assert order.columns == once.columns and order.where("mix_place = 'x' AND mix_source = 'y'").count() == 200


def test_clashing_columns_pass_the_filters(spark):
    from strata.llm import quality_rules, string_tiling

    docs = spark.createDataFrame([(i, " ".join(f"w{i}x{j}" for j in range(30)), "s", 1, 2, 3) for i in range(8)],
                                 "doc_id long, text string, source string, measures_ int, row int, hash int")
    assert quality_rules.filter_documents(docs).columns == docs.columns and quality_rules.filter_documents(docs).count() == 8
    items = spark.createDataFrame([(1, "w1x1"), (2, " ".join(f"w2x{j}" for j in range(30)))], "item_id long, text string")
    kept = string_tiling.drop_contaminated(docs, items)
    assert kept.columns == docs.columns
    assert sorted(r.doc_id for r in kept.collect()) == [0, 1, 3, 4, 5, 6, 7]  # the one-word item drops nothing
    assert {(r.doc_id, r.item_id) for r in string_tiling.leaks(docs, items).collect()} == {(1, 1), (2, 2)}


@pytest.mark.parametrize("make", [hostile, empty])
def test_every_row_gets_its_place(spark, make):
    docs = make(spark)
    rows = pfair_mix.mixed(docs, block_rows=4, weights={"s1": 5.0}).collect()
    assert sorted(r.mix_position for r in rows) == list(range(docs.count()))
    assert sorted((r.doc_id is None, r.doc_id or 0) for r in rows) == sorted((r.doc_id is None, r.doc_id or 0) for r in docs.collect())
    by_place = sorted(rows, key=lambda r: r.mix_position)
    assert [r.mix_slot for r in by_place] == sorted(r.mix_slot for r in rows)
    assert len({(r.mix_slot, r.source) for r in rows}) == len({r.mix_slot for r in rows})
    ordered = pfair_mix.in_mixed_order(docs, block_rows=4, weights={"s1": 5.0})
    assert ordered.columns == docs.columns
    assert [r.doc_id for r in ordered.collect()] == [r.doc_id for r in by_place]


def test_places_are_repeatable_and_weights_hold(spark):
    docs = spark.range(20_000).select(F.col("id").alias("doc_id"), F.lit("x").alias("text"),
                                      F.when(F.col("id") % 3 == 0, "a").when(F.col("id") % 7 == 0, "b").otherwise("c").alias("source"))
    rows = sorted(pfair_mix.mixed(docs, weights={"a": 5, "b": 2, "c": 3}).collect(), key=lambda r: r.mix_position)
    first = [r.source for r in rows[:5000]]
    for s, share in (("a", 0.5), ("b", 0.2), ("c", 0.3)):
        assert abs(first.count(s) - 5000 * share) <= 2 * pfair_mix.BLOCK_ROWS
    again = pfair_mix.mixed(docs.repartition(7), weights={"a": 5, "b": 2, "c": 3}).collect()
    assert {r.doc_id: r.mix_position for r in again} == {r.doc_id: r.mix_position for r in rows}


def fluid_deviation(order, blocks, weights):
    """The widest gap, in blocks, between what each source has had and its unrounded share of the slots."""
    done, fluid, worst = np.zeros(len(blocks)), np.zeros(len(blocks)), 0.0
    for s in order:
        done[s] += 1
        left = 1.0
        while left > 1e-12 and (alive := fluid < blocks - 1e-9).any():
            rate = np.where(alive, weights, 0) / weights[alive].sum()
            step = min(left, ((blocks - fluid)[alive] / rate[alive]).min())
            fluid, left = fluid + rate * step, left - step
        worst = max(worst, np.abs(done - fluid).max())
    return worst


@pytest.mark.parametrize("chunk", [97, pfair_mix.CHUNK])
def test_exact_weights_deviate_by_less_than_a_block(chunk):
    r = np.random.default_rng(3)
    for blocks in (r.integers(1, 60, 50), np.array([30_000, *r.integers(900, 5000, 19)]), np.array([900, *[7] * 599])):
        weights = blocks ** 0.5 * r.uniform(0.9, 1.1, len(blocks))
        slots, order = pfair_mix.exact_slots(blocks, weights, chunk), np.empty(blocks.sum(), dtype=int)
        order[slots] = np.repeat(np.arange(len(blocks)), blocks)
        assert sorted(slots) == list(range(blocks.sum()))
        assert fluid_deviation(order[:30_000], blocks, weights) < 1 + 1e-6


def test_mixed_rows_follow_uneven_weights(spark):
    docs = spark.range(24_000).select(F.col("id").alias("doc_id"), F.lit("x").alias("text"), F.when(
        F.col("id") % 3 == 0, "big").otherwise(F.concat(F.lit("s"), (F.col("id") % 599).cast("string"))).alias("source"))
    rows = sorted(pfair_mix.mixed(docs, block_rows=1).collect(), key=lambda r: r.mix_slot)
    names = sorted({r.source for r in rows})
    blocks = np.array([sum(r.source == s for r in rows) for s in names])
    order = [names.index(r.source) for r in rows]
    assert fluid_deviation(order, blocks, blocks ** 0.5) < 1 + 1e-6


def test_thousands_of_sources(spark):
    docs = spark.range(9000).select(F.col("id").alias("doc_id"), F.lit("x").alias("text"), F.when(
        F.col("id") % 3 == 0, "big").otherwise(F.concat(F.lit("h"), (F.col("id") % 2999).cast("string"))).alias("source"))
    rows = sorted(pfair_mix.mixed(docs, block_rows=1).collect(), key=lambda r: r.mix_slot)
    assert [r.mix_position for r in rows] == list(range(9000))
    count = Counter(r.source for r in rows)
    number = {s: k for k, s in enumerate(count)}
    blocks = np.array(list(count.values()))
    assert len(number) > 2500
    assert fluid_deviation([number[r.source] for r in rows], blocks, blocks ** 0.5) < 1 + 1e-6


# --- co-training

def test_held_out_accuracy(spark):
    docs, labels = (spark.read.parquet(f"/root/testdata/sf0.1/{t}.parquet") for t in ("documents", "labels"))
    scores = cotraining.judged(cotraining.quality_scores(docs, labels, hold_out=1))
    assert scores.count() == docs.count()
    held = labels.filter(F.pmod(F.xxhash64("doc_id"), F.lit(cotraining.FOLDS)) == 1).join(scores, "doc_id").collect()
    right = sum((r.quality == 1) == r.kept for r in held)
    assert len(held) > 300 and right >= 0.97 * len(held)


def test_hostile_rows_are_scored(spark):
    docs = hostile(spark)
    labels = spark.createDataFrame([(1, 0), (3, 1), (7, 1), (7, 0), (8, 1), (13, 1), (15, 0), (None, 1), (9, None), (999, 1)], "doc_id long, quality int")
    assert cotraining.quality_scores(docs, labels).count() == docs.count()
    none = cotraining.quality_scores(docs, labels.limit(0)).collect()
    assert len(none) == docs.count() and {r.quality_score for r in none} == {0.5}
    assert cotraining.quality_scores(empty(spark), labels).collect() == []
