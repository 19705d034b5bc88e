"""Preference formatting: the turns that two conversations share become the prompt, the rest two masked completions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Fixed values of the chat markup.
OPEN, CLOSE = "<|im_start|>", "<|im_end|>\n"
TURN = "struct<role:string,text:string>"


def conversations(turns: DataFrame, conv_col: str, turn_col: str, role_col: str, text_col: str) -> DataFrame:
    """One row per conversation: conv_id and its turns in order.

    Turns are ordered by number, then role and text, nulls first, so that repeated turn numbers have a fixed order; every
    row is a turn. A null role is `user` and a null text is empty.
    """
    turn = F.struct(F.col(f"`{turn_col}`").alias("turn"), F.coalesce(F.col(f"`{role_col}`").cast("string"), F.lit("user")).alias("role"),
                    F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit("")).alias("text"))
    grouped = turns.groupBy(F.col(f"`{conv_col}`").alias("conv_id")).agg(F.sort_array(F.collect_list(turn)).alias("turns"))
    return grouped.select("conv_id", F.transform("turns", lambda t: F.struct(t["role"].alias("role"), t["text"].alias("text"))).alias("turns"))


def common_turns(a: Column, b: Column) -> Column:
    """How many turns at the start of both arrays are equal in role and text."""
    same = F.zip_with(a, b, lambda x, y: F.coalesce((x["role"] == y["role"]) & (x["text"] == y["text"]), F.lit(False)))
    return (F.array_position(F.concat(same, F.array(F.lit(False))), False) - 1).cast("int")


def rendered(turn: Column) -> Column:
    """One turn in chat markup. Markers inside a text or role are broken up by a space, so they cannot end a turn."""
    return F.concat(F.lit(OPEN), F.replace(turn["role"], F.lit("<|"), F.lit("< |")), F.lit("\n"), _body(turn))


def _body(turn: Column) -> Column:
    return F.concat(F.replace(turn["text"], F.lit("<|"), F.lit("< |")), F.lit(CLOSE))


def _joined(turns: Column) -> Column:
    return F.array_join(F.transform(turns, rendered), "")


def _mask(turns: Column, trained: str) -> Column:
    """[start, end) in characters of what is learned in the joined turns: text and end marker of the trained role's turns."""
    none = F.array().cast("array<struct<start:int,end:int>>")

    def step(state: Column, turn: Column) -> Column:
        end = state["at"] + F.length(rendered(turn))
        span = F.struct((end - F.length(_body(turn))).alias("start"), end.alias("end"))
        return F.struct(end.alias("at"), F.when(turn["role"] == trained, F.concat(state["spans"], F.array(span))).otherwise(state["spans"]).alias("spans"))

    return F.aggregate(turns, F.struct(F.lit(0).alias("at"), none.alias("spans")), step, lambda s: s["spans"])


def format_pairs(pairs: DataFrame, chosen: str = "chosen", rejected: str = "rejected", trained: str = "assistant") -> DataFrame:
    """Every row of pairs with n_shared, prompt, and per side a completion and its mask.

    `chosen` and `rejected` are arrays of (role, text). Their longest common prefix of turns is rendered once as prompt,
    which is never learned; what follows is the side's completion, whose mask lists the character spans that are learned.
    Equal conversations have an empty completion on both sides; without a common turn the prompt is empty. A null side counts
    as a conversation without turns. Input columns with the name of an output are replaced.
    """
    def side(name: str) -> Column:
        return F.coalesce(F.col(f"`{name}`"), F.array().cast(f"array<{TURN}>"))

    outputs = {"n_shared": common_turns(side(chosen), side(rejected))}
    outputs["prompt"] = _joined(F.slice(side(chosen), F.lit(1), outputs["n_shared"]))
    for name in (chosen, rejected):
        rest = F.slice(side(name), outputs["n_shared"] + 1, F.greatest(F.size(side(name)), F.lit(1)))
        outputs[f"{name}_completion"], outputs[f"{name}_mask"] = _joined(rest), _mask(rest, trained)
    taken = set(outputs)
    kept = [F.col(f"`{c}`") for c in pairs.columns if c.lower() not in taken]
    return pairs.select(*kept, *[v.alias(n) for n, v in outputs.items()])


def swapped_replies(talks: DataFrame, trained: str = "assistant") -> DataFrame:
    """Preference pairs from plain conversations: conv_id, chosen, rejected.

    The chosen side is the conversation. The rejected side is the same up to its last trained turn, which is replaced by the
    last trained turn of the neighbour (conversations 2k and 2k + 1 are neighbours): a reply to another question. Without
    such a turn on either side, or without a neighbour, the rejected side just ends there. Every conversation gives one pair; one
    with a null id has no neighbour.
    """
    last = F.array_max(F.transform(F.sequence(F.lit(1), F.greatest(F.size("turns"), F.lit(1))), lambda k: F.when(F.get("turns", k - 1)["role"] == trained, k)))
    talks = talks.withColumn("last", last)
    replies = talks.select(F.col("conv_id").bitwiseXOR(F.lit(1)).alias("neighbour"), F.get("turns", F.col("last") - 1).alias("reply"))
    joined = talks.join(replies, talks["conv_id"] == replies["neighbour"], "left")
    before = F.when(F.col("last").isNull(), F.col("turns")).otherwise(F.slice("turns", F.lit(1), F.col("last") - 1))
    swap = F.when(F.col("last").isNotNull() & F.col("reply").isNotNull(), F.array("reply")).otherwise(F.array().cast(f"array<{TURN}>"))
    return joined.select("conv_id", F.col("turns").alias("chosen"), F.concat(before, swap).alias("rejected"))
