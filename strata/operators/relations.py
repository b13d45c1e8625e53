"""Entities that share a sentence, counted over the corpus.

A pair can only reach ``min_support`` sentences if both its entities do, so the
others are dropped before any pair is formed: a list of ten thousand names that
occur once costs ten thousand rows, not their square.  What is left of a sentence
is cut into blocks of ``BLOCK`` entities that meet pairwise, dealt over the tasks
by sentence and block, so no sentence is one task's work; pairs are added up
before they are shuffled, so a frequent pair is no hot key.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strata.operators.decorate import entity_spans, sentences
from strata.session import materialize

BLOCK = 128


def sentence_entities(docs: DataFrame, text: str = "text") -> DataFrame:
    """(sentence, entity): the distinct entities of every sentence that has two or more, stored."""
    per = docs.select(F.explode(F.transform(sentences(F.col(text)), lambda s: F.array_distinct(entity_spans(s)))).alias("entities"))
    per = materialize(per.where(F.size("entities") > 1).withColumn("sentence", F.monotonically_increasing_id()), "sentences")
    return per.select("sentence", F.explode("entities").alias("entity"))


def _blocks(entities: Column) -> Column:
    """An array in pieces of ``BLOCK``."""
    return F.transform(F.sequence(F.lit(0), F.floor((F.size(entities) - 1) / BLOCK).cast("int")),
                       lambda i: F.slice(entities, i * BLOCK + 1, BLOCK))


def entity_pairs(docs: DataFrame, text: str = "text", min_support: int = 2) -> DataFrame:
    """(source, target, sentences): pairs of entities (source before target) found together in ``min_support`` sentences."""
    rows = sentence_entities(docs, text)
    support = rows.groupBy("entity").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= min_support)
    kept = rows.join(support.select("entity"), "entity", "left_semi")
    held = kept.groupBy("sentence").agg(F.array_sort(F.collect_list("entity")).alias("e")).where(F.size("e") > 1)
    blocks = held.select("sentence", _blocks(F.col("e")).alias("b"))
    left = blocks.select("sentence", "b", F.posexplode("b").alias("i", "one"))
    both = left.select("sentence", "i", "one", F.posexplode(F.slice(F.col("b"), F.col("i") + 1, F.size("b"))).alias("j", "other"))
    both = both.repartition("sentence", "i", "j")
    one = both.select("other", F.explode("one").alias("source"))
    pairs = one.select("source", F.explode("other").alias("target")).where(F.col("source") < F.col("target"))
    return pairs.groupBy("source", "target").agg(F.count(F.lit(1)).alias("sentences")).where(F.col("sentences") >= min_support)
