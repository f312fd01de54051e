"""Chat formatting in budgeted windows. JVM only.

A conversation becomes windows of at most ``budget`` tokens: prefix sums of the
turns' tokens choose spans that begin and end with turns. Every window repeats
the leading system turn and a limited history; only assistant turns that are
new in a window lie under its loss mask, so each is learnt once.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from estatelake.llm.common import running_totals, text_of

HEAD, HEAD_END, END = "<|from:", "|>\n", "<|end|>\n"
# Control strings of this template and of other common ones. A text that holds one
# gets a backslash after its first character; one that has backslashes there gets one more.
CONTROL = r"(?=\||/?s>|/?INST\]|</?SYS>>)"
TURN = r"(?s)<\|from:([^|]*)\|>\n(.*?)<\|end\|>\n"


@dataclass(frozen=True)
class Budget:
    """Tokens of a window, of which the history may take its share; turns of history at most."""

    tokens: int = 1024
    history_tokens: int = 256
    history_turns: int = 2


def escaped(text: Column) -> Column:
    return F.regexp_replace(text, rf"([<\[])(\\*){CONTROL}", r"$1\\$2")


def unescaped(text: Column) -> Column:
    return F.regexp_replace(text, rf"([<\[])\\(\\*){CONTROL}", r"$1$2")


def tokens_of(text: Column) -> Column:
    """Words, numbers and other marks of a text: a count that needs no vocabulary."""
    return F.regexp_count(text, F.lit(r"\p{L}+|\p{N}+|[^\s\p{L}\p{N}]"))


def chat_windows(conversations: DataFrame, budget: Budget = Budget()) -> DataFrame:
    """One row per window: conv_id, window, formatted, repeated, n_turns, n_tokens, loss.

    ``formatted`` is the text, ``repeated`` the number of its leading turns that
    earlier windows have, ``loss`` an array of (start, length) in code points:
    the escaped assistant texts that are new here. A turn longer than the budget
    gets a window of its own and is not cut. Turns go by ``turn``; ties by role
    and text, null turns first. A null text or role counts as empty, rows of a
    null conv_id are one conversation, other columns are ignored.

    One conversation is one record, as a document is: its turns meet in one row.
    """
    turn = F.struct(
        F.col("turn").alias("turn"), F.coalesce("role", F.lit("")).alias("role"), text_of().alias("text")
    )
    talks = conversations.groupBy("conv_id").agg(F.sort_array(F.collect_list(turn)).alias("_turns"))
    talks = talks.select(
        "conv_id",
        F.transform(
            "_turns",
            lambda t: F.struct(
                t["role"].alias("role"),
                (tokens_of(t["text"]) + 4).alias("tokens"),
                F.concat(F.lit(HEAD), F.url_encode(t["role"]), F.lit(HEAD_END)).alias("head"),
                escaped(t["text"]).alias("body"),
            ),
        ).alias("_turns"),
    )
    talks = talks.select(
        "conv_id", "_turns",
        F.size("_turns").alias("_n"),
        F.when(F.element_at("_turns", 1)["role"] == "system", 1).otherwise(0).alias("_first"),
        running_totals(F.transform("_turns", lambda t: t["tokens"])).alias("_ends"),
    )

    def upto(position: Column) -> Column:
        """Tokens of the first ``position`` turns."""
        return F.when(position > 0, F.element_at("_ends", F.greatest(position, F.lit(1)))).otherwise(0).cast("long")

    room = F.greatest(F.lit(budget.tokens - budget.history_tokens) - upto(F.col("_first")), F.lit(1))
    begin = F.struct(F.array(F.col("_first")).alias("starts"), upto(F.col("_first")).alias("base"))

    def cut(state: Column, i: Column) -> Column:
        full = (upto(i + 1) - state["base"] > room) & (F.element_at(state["starts"], -1) < i)
        return F.struct(
            F.when(full, F.concat(state["starts"], F.array(i))).otherwise(state["starts"]).alias("starts"),
            F.when(full, upto(i)).otherwise(state["base"]).alias("base"),
        )

    later = F.when(F.col("_first") < F.col("_n"), F.sequence(F.col("_first"), F.col("_n") - 1)).otherwise(
        F.array().cast("array<int>")
    )
    talks = talks.withColumn("_starts", F.aggregate(later, begin, cut, lambda s: s["starts"]))

    def window(start: Column, k: Column) -> Column:
        stop = F.when(
            k + 1 < F.size("_starts"), F.element_at("_starts", F.least(k + 2, F.size("_starts")))
        ).otherwise(F.col("_n"))
        oldest = F.greatest(F.col("_first"), start - budget.history_turns)
        history = F.filter(
            F.when(oldest < start, F.sequence(oldest, start - 1)).otherwise(F.array().cast("array<int>")),
            lambda j: upto(start) - upto(j) <= budget.history_tokens,
        )
        behind = F.size(history)
        turns = F.concat(
            F.slice("_turns", 1, F.col("_first")), F.slice("_turns", start - behind + 1, stop - start + behind)
        )
        return F.struct(
            k.alias("window"),
            turns.alias("turns"),
            F.when(k > 0, F.col("_first") + behind).otherwise(0).alias("repeated"),
        )

    windows = talks.select(
        "conv_id", F.explode(F.transform("_starts", window)).alias("_w")
    ).select("conv_id", "_w.*")
    windows = windows.withColumn(
        "_lengths",
        running_totals(
            F.transform("turns", lambda t: F.length(t["head"]) + F.length(t["body"]) + len(END))
        ),
    )
    marked = F.transform(
        "turns",
        lambda t, i: F.struct(
            ((i >= F.col("repeated")) & (t["role"] == "assistant")).alias("learn"),
            (F.element_at("_lengths", i + 1) - len(END) - F.length(t["body"])).alias("start"),
            F.length(t["body"]).cast("long").alias("length"),
        ),
    )
    return windows.select(
        "conv_id", "window",
        F.array_join(
            F.transform("turns", lambda t: F.concat(t["head"], t["body"], F.lit(END))), ""
        ).alias("formatted"),
        "repeated",
        F.size("turns").alias("n_turns"),
        F.aggregate("turns", F.lit(0).cast("long"), lambda a, t: a + t["tokens"]).alias("n_tokens"),
        F.transform(
            F.filter(marked, lambda m: m["learn"]),
            lambda m: F.struct(m["start"].alias("start"), m["length"].alias("length")),
        ).alias("loss"),
    )


def read_back(windows: DataFrame) -> DataFrame:
    """The conversations as the windows' text has them: conv_id, turns, learnt, formatted_chars.

    ``turns`` is an array of (role, text), each turn once; ``learnt`` the texts
    under the loss mask in order.
    """
    parsed = windows.select(
        "conv_id", "window",
        F.length("formatted").cast("long").alias("chars"),
        F.slice(
            F.zip_with(
                F.regexp_extract_all("formatted", F.lit(TURN), F.lit(1)),
                F.regexp_extract_all("formatted", F.lit(TURN), F.lit(2)),
                lambda r, t: F.struct(F.url_decode(r).alias("role"), unescaped(t).alias("text")),
            ),
            F.col("repeated") + 1,
            F.col("n_turns"),
        ).alias("turns"),
        F.transform(
            "loss",
            lambda x: unescaped(
                F.substring(F.col("formatted"), (x["start"] + 1).cast("int"), x["length"].cast("int"))
            ),
        ).alias("learnt"),
    )
    parts = F.sort_array(F.collect_list(F.struct("window", "turns", "learnt")))
    return parsed.groupBy("conv_id").agg(
        parts.alias("_p"), F.sum("chars").alias("formatted_chars")
    ).select(
        "conv_id",
        F.flatten(F.transform("_p", lambda p: p["turns"])).alias("turns"),
        F.flatten(F.transform("_p", lambda p: p["learnt"])).alias("learnt"),
        "formatted_chars",
    )
