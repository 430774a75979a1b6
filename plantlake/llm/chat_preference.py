"""Preference formatting: a shared prompt once, and the chosen and rejected completions with masks.

Only DataFrame functions are used. A conversation is a set of rows with a turn number; it is never
gathered, so one of any length is spread like any other rows. The result has one row per rendered turn.
``preference_pairs`` makes one row per pair of these, where pairs fit a row.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The marks around a rendered turn.
OPEN, MIDDLE, CLOSE = "<|im_start|>", "\n", "<|im_end|>\n"
TRAINED_ROLE = "assistant"


def rendered(role: Column, text: Column) -> Column:
    empty = F.lit("")
    return F.concat(F.lit(OPEN), F.coalesce(role, empty), F.lit(MIDDLE), F.coalesce(text, empty), F.lit(CLOSE))


def preference_segments(chosen: DataFrame, rejected: DataFrame) -> DataFrame:
    """pair_id, part, turn, role, segment, trained: the turns of each pair of conversations.

    Both inputs have pair_id, turn, role and text; other columns are left out. The prompt is the longest
    common prefix: the turns before the first turn number whose rows differ between the sides. It comes
    once, with part ``prompt``; the rest comes as ``chosen`` and ``rejected``. ``trained`` is true for the
    assistant's turns of a completion; all else is masked.

    A pair that lacks one side has an empty prompt and one completion; equal sides are all prompt. A null
    turn stands in front of all; null role and text render as empty but differ from empty ones. Rows that
    repeat a turn in full count once; different rows of one turn number follow each other by role and
    text. Null pair ids form a pair of their own.

    One grouping by the whole turn finds which sides have it, one minimum per pair the end of the prompt.
    """
    sides = [
        df.select("pair_id", F.col("turn").cast("long").alias("turn"), "role", "text", F.lit(flag).alias("side"))
        for df, flag in ((chosen, 1), (rejected, 2))
    ]
    turns = sides[0].unionByName(sides[1]).groupBy("pair_id", "turn", "role", "text").agg(
        F.bit_or("side").alias("sides")
    )
    place = F.coalesce("turn", F.lit(-(1 << 63)))
    ends = turns.groupBy(F.col("pair_id").alias("_pair")).agg(F.min(F.when(F.col("sides") != 3, place)).alias("end"))
    joined = turns.join(ends, turns["pair_id"].eqNullSafe(ends["_pair"]))
    shared = F.col("end").isNull() | (place < F.col("end"))
    parts = F.when(shared, F.array(F.lit("prompt"))).otherwise(
        F.filter(
            F.array(F.when(F.col("sides").bitwiseAND(1) > 0, "chosen"), F.when(F.col("sides").bitwiseAND(2) > 0, "rejected")),
            lambda x: x.isNotNull(),
        )
    )
    trained = (F.col("part") != "prompt") & F.coalesce(F.col("role") == TRAINED_ROLE, F.lit(False))
    return joined.withColumn("part", F.explode(parts)).select(
        "pair_id", "part", "turn", "role", rendered(F.col("role"), F.col("text")).alias("segment"), trained.alias("trained")
    )


def preference_pairs(segments: DataFrame) -> DataFrame:
    """pair_id, prompt, chosen, rejected, chosen_mask, rejected_mask: one row per pair of ``preference_segments``.

    The prompt is rendered once; ``prompt || chosen`` and ``prompt || rejected`` are the whole texts. A mask
    lists the turns of its completion in order as (n_chars, trained) and covers the completion.

    Turns are ordered as in ``preference_segments``: by turn, null first, then role and text. A pair that
    lacks one side, and one with equal sides, has an empty completion with an empty mask. Null pair ids
    form one pair; other columns are left out; an empty table gives none.

    A pair is gathered in one row, so it has to fit one (2 GB at the most); pairs of any length stay turns.
    """
    place = F.coalesce("turn", F.lit(-(1 << 63)))
    turn = F.struct(place.alias("place"), "role", "segment", F.char_length("segment").alias("n_chars"), "trained")
    parts = ("prompt", "chosen", "rejected")
    gathered = segments.groupBy("pair_id").agg(
        *[F.array_sort(F.collect_list(F.when(F.col("part") == part, turn))).alias(part) for part in parts]
    )
    texts = [F.array_join(F.col(part)["segment"], "").alias(part) for part in parts]
    masks = [
        F.transform(part, lambda t: F.struct(t["n_chars"].alias("n_chars"), t["trained"].alias("trained"))).alias(f"{part}_mask")
        for part in parts[1:]
    ]
    return gathered.select("pair_id", *texts, *masks)


def with_swapped_ends(turns: DataFrame) -> DataFrame:
    """A rejected side for conversations (pair_id, turn, role, text) that have only one.

    The last turn gets the text of the last turn of the conversation numbered one higher; where there is
    none, it is left out. Other turns stay, so the pair shares them as its prompt. Other columns are left
    out, whatever their names. Rows that tie for the last turn all get the other's text; nulls in role or
    text stay; a null pair id has no other conversation; an empty table gives none.
    """
    turns = turns.select("pair_id", "turn", "role", "text")
    last = turns.groupBy("pair_id").agg(F.max(F.struct("turn", "role", "text")).alias("last"))
    ends = last.select(F.col("pair_id").alias("_pair"), F.col("last.turn").alias("_turn"))
    other = last.select((F.col("pair_id") - 1).alias("_other"), F.col("last.text").alias("_text"), F.lit(True).alias("_found"))
    swaps = ends.join(other, F.col("_pair") == F.col("_other"), "left")
    joined = turns.join(swaps, F.col("pair_id").eqNullSafe(F.col("_pair")))
    is_last = F.col("turn").eqNullSafe(F.col("_turn"))
    text = F.when(is_last, F.col("_text")).otherwise(F.col("text"))
    return joined.where(~is_last | F.col("_found").isNotNull()).select("pair_id", "turn", "role", text.alias("text"))
