"""Chat formatting in budgeted, turn-aligned windows (DataFrame functions only).

Template: ``<|im_start|>role\\ntext<|im_end|>\\n`` per turn.  Inside texts and
roles ``\\`` becomes ``\\\\`` and ``<|`` becomes ``<\\|``, and in roles a line end
becomes ``\\.``; so no control string can arise from a text, and reading back
restores every text.

Windows: prefix sums of the turns' tokens choose the spans.  A window takes turns
while system turn, repeated history and new turns stay within ``budget`` tokens;
a turn that is larger alone gets a window of its own, whole.  A system turn at
the start of the conversation leads every window; windows after the first repeat
up to ``history_turns`` turns before their first new one, of ``history_tokens`` at
most.  ``loss_spans`` (code points, begin and end) mark the assistant texts that
are new in the window: a repeated target is masked, so each counts once.

Tokens are counted as runs of letters, runs of digits and single other signs,
plus ``TURN_TOKENS`` for the template.  Null text or role: empty.  Turns sort by
(turn, role, text), nulls first; repeated rows are turns of their own; rows
without a ``conv_id`` form one conversation.  Empty tables give no windows; other
columns are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

BUDGET = 512
HISTORY_TURNS = 2
HISTORY_TOKENS = 128
TURN_TOKENS = 4
START, END = "<|im_start|>", "<|im_end|>\n"
_TOKEN = r"\p{L}+|\p{N}+|[^\s\p{L}\p{N}]"


def escape(text: Column) -> Column:
    return F.replace(F.replace(text, F.lit("\\"), F.lit("\\\\")), F.lit("<|"), F.lit("<\\|"))


def unescape(text: Column) -> Column:
    """Undo ``escape`` (and the line ends of roles): between doubled backslashes only ``\\|`` and ``\\.`` are left."""
    parts = F.split(text, r"\\\\", -1)

    def plain(p: Column) -> Column:
        return F.replace(F.replace(p, F.lit("\\|"), F.lit("|")), F.lit("\\."), F.lit("\n"))

    return F.array_join(F.transform(parts, plain), "\\")


def _escaped_role(role: Column) -> Column:
    return F.replace(escape(role), F.lit("\n"), F.lit("\\."))


def _total(values: Column) -> Column:
    return F.aggregate(values, F.lit(0), lambda a, x: a + x)


def chat_windows(turns: DataFrame, budget: int = BUDGET, history_turns: int = HISTORY_TURNS,
                 history_tokens: int = HISTORY_TOKENS) -> DataFrame:
    """(conv_id, turn, role, text) -> conv_id, window, formatted, n_repeated, n_tokens, loss_spans."""
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    rows = turns.select("conv_id", "turn", role.alias("role"), text.alias("text"))
    rows = rows.withColumn("tokens", F.regexp_count("text", F.lit(_TOKEN)) + TURN_TOKENS)
    order = Window.partitionBy("conv_id").orderBy("turn", "role", "text")
    rows = rows.withColumn("place", F.row_number().over(order)).withColumn(
        "upto", F.sum("tokens").over(order.rowsBetween(Window.unboundedPreceding, 0)))
    piece = F.struct("place", "role", (F.length(F.lit(START)) + F.length(_escaped_role(F.col("role"))) + 1).alias("lead"),
                     F.length(escape(F.col("text"))).alias("chars"), "upto", "tokens",
                     F.concat(F.lit(START), _escaped_role(F.col("role")), F.lit("\n"), escape(F.col("text")),
                              F.lit(END)).alias("out"))
    convs = rows.groupBy("conv_id").agg(F.sort_array(F.collect_list(piece)).alias("t"))
    convs = convs.withColumn("n", F.size("t")).withColumn("lead", F.when(F.col("t")[0]["role"] == "system", 1).otherwise(0))
    system = F.when(F.col("lead") == 1, F.col("t")[0]["tokens"]).otherwise(0)
    convs = convs.withColumn("system", system)

    def before(i: Column) -> Column:  # tokens of the turns before turn i
        return F.col("t")[i]["upto"] - F.col("t")[i]["tokens"]

    def history_from(i: Column) -> Column:  # the first turn of the history of a window that begins at turn i
        nearest = F.sequence(F.greatest(i - history_turns, F.col("lead")), i)
        fits = F.filter(nearest, lambda j: (before(i) - before(j) <= history_tokens)
                        & (F.col("system") + F.col("t")[i]["upto"] - before(j) <= budget))
        return F.coalesce(F.get(fits, F.lit(0)), i)

    start = F.struct(F.array(F.struct(F.col("lead").alias("new"), F.col("lead").alias("old"))).alias("w"))

    def step(state: Column, i: Column) -> Column:
        now = F.element_at(state["w"], -1)
        over = F.col("system") + F.col("t")[i]["upto"] - before(now["old"]) > budget
        grown = F.concat(state["w"], F.array(F.struct(i.alias("new"), history_from(i).alias("old"))))
        return F.when(over & (i > now["new"]), F.struct(grown.alias("w"))).otherwise(state)

    body = F.when(F.col("lead") < F.col("n"), F.sequence(F.col("lead"), F.col("n") - 1)).otherwise(
        F.array().cast("array<int>"))
    convs = convs.withColumn("spans", F.aggregate(body, start, step)["w"])

    def window(span: Column, k: Column) -> Column:
        end = F.coalesce(F.get(F.col("spans"), k + 1)["new"], F.col("n"))
        lead = F.when(F.col("lead") == 1, F.slice("t", 1, 1)).otherwise(F.slice("t", 1, 0))
        turns_in = F.concat(lead, F.slice("t", span["old"] + 1, end - span["old"]))
        repeated = span["new"] - span["old"] + F.when(k > 0, F.col("lead")).otherwise(0)
        return F.struct(k.alias("window"), repeated.alias("n_repeated"),
                        F.transform(turns_in, lambda x: F.struct(x["role"], x["lead"], x["chars"], x["tokens"], x["out"])).alias("p"))

    windows = convs.select("conv_id", F.explode(F.transform("spans", window)).alias("w")).select("conv_id", "w.*")
    place = F.transform("p", lambda x, j: F.struct(
        x["role"].alias("role"), j.alias("j"), x["chars"].alias("chars"),
        (_total(F.transform(F.slice("p", 1, j), lambda y: F.length(y["out"]))) + x["lead"]).alias("begin")))
    targets = F.filter(place, lambda x: (x["role"] == "assistant") & (x["j"] >= F.col("first_new")))
    # in the first window the system turn is new; later it is one of the repeated turns at the front
    windows = windows.withColumn("first_new", F.col("n_repeated"))
    return windows.select(
        "conv_id", "window", F.array_join(F.transform("p", lambda x: x["out"]), "").alias("formatted"), "n_repeated",
        _total(F.transform("p", lambda x: x["tokens"])).alias("n_tokens"),
        F.transform(targets, lambda x: F.struct(x["begin"].alias("begin"), (x["begin"] + x["chars"]).alias("end"))).alias("loss_spans"))


def read_turns(windows: DataFrame) -> DataFrame:
    """Windows -> conv_id, n_turns, turns (role, text: each once, in order), loss_text, formatted_chars."""
    pieces = F.split("formatted", r"<\|im_end\|>\n", -1)
    fresh = F.slice(pieces, F.col("n_repeated") + 1, F.size(pieces) - 1 - F.col("n_repeated"))
    body = F.transform(fresh, lambda p: F.substring(p, F.lit(len(START) + 1), F.length(p)))
    turns = F.transform(body, lambda p: F.struct(
        unescape(F.substring_index(p, "\n", 1)).alias("role"),
        unescape(F.substring(p, F.length(F.substring_index(p, "\n", 1)) + 2, F.length(p))).alias("text")))
    loss = F.array_join(F.transform("loss_spans", lambda s: unescape(
        F.substring("formatted", s["begin"] + 1, s["end"] - s["begin"]))), "")
    part = F.struct("window", turns.alias("turns"), loss.alias("loss"), F.length("formatted").alias("chars"))
    convs = windows.groupBy("conv_id").agg(F.sort_array(F.collect_list(part)).alias("w"))
    return convs.select("conv_id", F.flatten(F.transform("w", lambda x: x["turns"])).alias("turns"),
                        F.array_join(F.transform("w", lambda x: x["loss"]), "").alias("loss_text"),
                        _total(F.transform("w", lambda x: x["chars"])).cast("long").alias("formatted_chars")) \
        .withColumn("n_turns", F.size("turns").cast("long"))


def digests(convs: DataFrame) -> DataFrame:
    """The checkable digest of ``read_turns``."""
    said = F.array_join(F.transform("turns", lambda x: F.concat(x["role"], F.lit("\n"), x["text"], F.lit("\n"))), "")
    return convs.select("conv_id", "n_turns", F.sha2(said, 256).alias("turns_sha256"),
                        F.length("loss_text").cast("long").alias("loss_chars"),
                        F.sha2("loss_text", 256).alias("loss_sha256"), "formatted_chars")
