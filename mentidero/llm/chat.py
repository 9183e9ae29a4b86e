"""Chat formatting as one relational expression: collected turn structs are sorted, adjacent turns of one
role share a block, and everything is concatenated by Spark expressions.

Template, per block: `<|turn|>` role `<|text|>` text, further texts of the same role after `<|part|>`, then
`<|end|>`. Every control string starts with `<|`. Inside roles and texts a backslash is put between `<` and
`|` (one more where some stand there already), so no control string can occur and the step can be undone.

Defined results: a null text or role is empty; turns are sorted by turn (nulls first), then role, then text;
repeated rows stay, each is a turn of its own; an empty table gives no rows; other columns are ignored;
rows without a conversation id form one conversation with a null id.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from mentidero.llm.common import let, narrow

# --- fixed values: the template ---
TURN, TEXT, PART, END = "<|turn|>", "<|text|>", "<|part|>", "<|end|>"
LEARNED_ROLE = "assistant"
# --- end of fixed values ---


def escape(text: Column) -> Column:
    return F.regexp_replace(text, r"<(\\*)\|", r"<$1\\|")


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, r"<\\(\\*)\|", r"<$1|")


def format_chats(turns: DataFrame, learned_role: str = LEARNED_ROLE) -> DataFrame:
    """One row per conversation: `formatted`, and `loss_runs`, the loss mask as run lengths in code points.

    A turn has two runs: characters outside the mask, then characters inside it (0 for other roles). The
    last `<|end|>` has a run of its own.
    """
    rows = narrow(turns, conv_id="bigint", turn="bigint", role="string", text="string")
    turn = F.struct(
        F.col("turn"),
        F.coalesce("role", F.lit("")).alias("role"),
        F.coalesce("text", F.lit("")).alias("text"),
    )
    sorted_turns = F.sort_array(F.collect_list(turn))
    grouped = rows.groupBy("conv_id").agg(sorted_turns.alias("turns"))

    def piece(all_turns: Column):
        def build(now: Column, i: Column) -> Column:
            before = F.get(all_turns, i - 1)
            head = (
                F.when(before["role"].eqNullSafe(now["role"]), F.lit(PART))
                .when(i == 0, F.concat(F.lit(TURN), escape(now["role"]), F.lit(TEXT)))
                .otherwise(F.concat(F.lit(END + TURN), escape(now["role"]), F.lit(TEXT)))
            )
            return F.struct(
                head.alias("head"),
                escape(now["text"]).alias("body"),
                (now["role"] == learned_role).alias("learned"),
            )

        return build

    pieces = grouped.select("conv_id", F.transform("turns", piece(F.col("turns"))).alias("pieces"))

    def run(p: Column) -> Column:
        outside, inside = F.char_length(p["head"]), F.char_length(p["body"])
        return F.array(
            F.when(p["learned"], outside).otherwise(outside + inside),
            F.when(p["learned"], inside).otherwise(F.lit(0)),
        )

    return pieces.select(
        "conv_id",
        F.concat(F.array_join(F.transform("pieces", lambda p: F.concat(p["head"], p["body"])), ""), F.lit(END)).alias("formatted"),
        F.concat(F.flatten(F.transform("pieces", run)), F.array(F.lit(len(END)), F.lit(0))).alias("loss_runs"),
    )


def _literal(marker: str) -> str:
    return marker.replace("|", r"\|")


def parse_chats(formatted: DataFrame) -> DataFrame:
    """The turns back from `formatted`, one row per conversation: array of (role, text)."""

    def block_turns(block: Column) -> Column:
        def parts(halves: Column) -> Column:
            role = unescape(halves[0])
            return F.transform(
                F.split(halves[1], _literal(PART)),
                lambda body: F.struct(role.alias("role"), unescape(body).alias("text")),
            )

        return let(F.split(F.regexp_replace(block, f"{_literal(END)}$", ""), _literal(TEXT)), parts)

    blocks = F.filter(F.split("formatted", _literal(TURN)), lambda b: b != "")
    return formatted.select(
        "conv_id", "formatted", "loss_runs", F.flatten(F.transform(blocks, block_turns)).alias("turns")
    )


def loss_text(turns: Column, learned_role: str = LEARNED_ROLE) -> Column:
    """The texts under the mask, in order, nothing between."""
    kept = F.filter(turns, lambda t: t["role"] == learned_role)
    return F.array_join(F.transform(kept, lambda t: t["text"]), "")


def masked_text(formatted: Column, loss_runs: Column) -> Column:
    """The texts that the loss mask covers in `formatted`, in order, nothing between."""
    start = F.struct(F.lit(1).alias("at"), F.array().cast("array<struct<at: int, length: int>>").alias("cuts"))

    def step(state: Column, i: Column) -> Column:
        begin, inside = state["at"] + F.get(loss_runs, 2 * i), F.get(loss_runs, 2 * i + 1)
        cut = F.array(F.struct(begin.alias("at"), inside.alias("length")))
        return F.struct((begin + inside).alias("at"), F.concat(state["cuts"], F.when(inside > 0, cut).otherwise(F.slice(cut, 1, 0))).alias("cuts"))

    cuts = F.aggregate(F.sequence(F.lit(0), (F.size(loss_runs) / 2).cast("int") - 1), start, step, lambda state: state["cuts"])
    return F.array_join(F.transform(cuts, lambda c: unescape(F.substring(formatted, c["at"], c["length"]))), "")
