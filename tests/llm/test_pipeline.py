"""The pipeline's stages against brute force, and the entry's guard."""

import subprocess
import sys
import zlib

import numpy as np
import public_tokenizers
from tokenizers import Tokenizer

import corpus_pipeline
from strata.llm import pfair_mix, quality_rules
from strata.session import materialize
from tests.llm.cases import empty, hostile
from tests.llm.test_texts import base_rules, expected_components

SF = "/root/testdata/sf0.001"
TOKENIZER = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))


def run_stages(spark, docs):
    out = [docs]
    for name, stage in corpus_pipeline.STAGES:
        out.append(materialize(stage(spark, out[-1], SF), f"t-{name}"))
    return out


def check(spark, docs):
    given, good, unique, clean, order, ids = run_stages(spark, docs)
    for stage in (good, unique, clean, order):
        assert stage.columns == docs.columns
    rows = good.collect()
    verdicts = quality_rules.judge_documents(given).collect()
    assert sorted((r.doc_id for r in rows), key=repr) == sorted((r.doc_id for r in verdicts if r.kept), key=repr)
    assert not any(base_rules(r.text)[-1] for r in rows)
    assert sorted((r.doc_id for r in unique.collect() if r.doc_id is not None)) == sorted(
        {d for d, n, c in expected_components(good) if d is not None and (n == 0 or d == c)})
    places = {(r.doc_id, r.text): r.mix_position for r in pfair_mix.mixed(clean).collect()}
    stored = sorted(order.collect(), key=lambda r: places[(r.doc_id, r.text)])
    start, expected = 0, []
    for r in stored:
        tokens = np.array([*TOKENIZER.encode(r.text, add_special_tokens=False).ids, 2], dtype="<u4")
        expected.append((r.doc_id, start, len(tokens), zlib.crc32(tokens.tobytes())))
        start += len(tokens)
    assert sorted(map(tuple, ids.collect()), key=lambda r: r[1]) == expected
    return ids


def test_stages_on_the_tables(spark):
    ids = check(spark, spark.read.parquet(f"{SF}/documents.parquet"))
    assert sorted(map(tuple, corpus_pipeline.run(spark, SF).collect())) == sorted(map(tuple, ids.collect()))


def test_stages_on_hostile_rows(spark):
    check(spark, materialize(hostile(spark), "t-hostile"))
    check(spark, materialize(empty(spark), "t-empty"))


def test_unlike_texts_of_one_id_stay(spark):
    from strata.llm import prefix_trie_join

    a, b = (" ".join(f"{x}{i}" for i in range(40)) for x in "ab")
    rows = [(1, a, "x"), (1, b, "x"), (2, a, "y"), (3, b + " end", "z"), (4, "short text", "w"), (4, None, "w"), (None, a, "n"),
            (5, "alone " + a, "row"), (6, "same words", "p"), (6, "same words", "q")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, row string")
    got = prefix_trie_join.one_of_each_group(docs)
    assert got.columns == docs.columns
    kept = sorted(((r.doc_id, r.text) for r in got.collect() if r.doc_id is not None), key=repr)
    assert [(d, t) for d, t in kept if d == 1] == [(1, a), (1, b)]  # each the least id of its component
    assert [d for d, _ in kept if d in (2, 3, 5)] == []
    assert [d for d, _ in kept if d == 4] == [4, 4] and [d for d, _ in kept if d == 6] == [6]
    assert got.where("doc_id IS NULL").count() == 1


def test_entry_imports_without_the_subpackage():
    code = ("import sys; sys.modules['strata.llm'] = None\n"
            "class Gone:\n"
            "    def find_spec(self, name, path=None, target=None):\n"
            "        if name == 'corpus_pipeline' or name.startswith('strata.llm'):\n"
            "            raise ModuleNotFoundError(name, name=name)\n"
            "del sys.modules['strata.llm']; sys.meta_path.insert(0, Gone())\n"
            "import __spark_entry__ as e; q = e.queries(); assert 'apply_changes' in q and 'pipeline' not in q")
    subprocess.run([sys.executable, "-c", code], check=True, cwd=corpus_pipeline.__file__.rsplit("/", 1)[0])
