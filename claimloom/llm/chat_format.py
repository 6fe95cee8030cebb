"""Chat formatting with DataFrame functions only: budgeted, turn-aligned windows of a conversation.

A turn is written `<|im_start|>role\\ntext<|im_end|>\\n`. In roles and texts a backslash is doubled and a control
string of this or another common template gets a backslash after its first character (in roles, line ends get one
before them), so that no control string stands inside a text; dropping a backslash before any character undoes it.

Prefix sums of turn tokens choose the windows: turns are added while the sum stays within the budget, and a
window begins where it would not. Every window repeats a leading system turn; later windows also repeat the turns
just before them, at most `history` of them and `history_budget` tokens. The loss mask covers the texts of
assistant turns where they stand first; repeated ones are masked. A turn larger than the budget has a window of
its own and is written whole.

Defined results: null roles and texts are empty. Turns are ordered by turn (nulls first), role and text, so ties
and repeated rows have a fixed place and all of them are written. Rows with a null conv_id are one conversation.
An empty table gives an empty result. Other columns are ignored. A conversation is one record, so its turns must
fit a task.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

OPEN, CLOSE = "<|im_start|>", "<|im_end|>\n"
BUDGET, HISTORY, HISTORY_BUDGET = 512, 2, 128
#: Tokens that a turn's marks count for.
TURN_TOKENS = 4
_CONTROL = r"(\\|<(?=\||/?s>|/?<?/?SYS>>)|\[(?=/?INST\]))"
_TOKEN = r"[\p{L}\p{M}\p{N}]+|[^\s\p{L}\p{M}\p{N}]"


def escaped(text, role: bool = False):
    """The text with its control strings broken by backslashes."""
    safe = F.regexp_replace(text, _CONTROL, r"$1\\")
    return F.regexp_replace(safe, "\n", "\\\\\n") if role else safe


def unescaped(text):
    """What `escaped` was given."""
    return F.regexp_replace(text, r"(?s)\\(.)", "$1")


def format_conversations(conversations: DataFrame, budget: int = BUDGET, history: int = HISTORY, history_budget: int = HISTORY_BUDGET) -> DataFrame:
    """Windows of conversations(conv_id, turn, role, text).

    (conv_id, window, formatted, repeated, n_tokens, loss): `repeated` counts the turns at the start that an
    earlier window holds; `loss` has the spans (start, length) in code points of formatted that are learned.
    """
    plain = conversations.select("conv_id", "turn", F.coalesce(F.col("role").cast("string"), F.lit("")).alias("role"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    turns = plain.select(
        "conv_id", "turn", "role", "text", escaped(F.col("role"), True).alias("safe_role"), escaped(F.col("text")).alias("safe_text"),
        (F.regexp_count("text", F.lit(_TOKEN)) + TURN_TOKENS).cast("bigint").alias("tokens"),
    )
    order = Window.partitionBy("conv_id").orderBy(F.col("turn").asc_nulls_first(), "role", "text")
    turns = turns.select(
        "conv_id",
        F.struct(
            (F.row_number().over(order) - 1).alias("i"),
            F.sum("tokens").over(order.rowsBetween(Window.unboundedPreceding, 0)).alias("total"),
            "tokens",
            (F.col("role") == "assistant").alias("target"),
            (F.length("safe_role") + len(OPEN) + 1).alias("skip"),
            F.length("safe_text").alias("size"),
            F.concat(F.lit(OPEN), "safe_role", F.lit("\n"), "safe_text", F.lit(CLOSE)).alias("written"),
            (F.col("role") == "system").alias("system"),
        ).alias("t"),
    )
    grouped = turns.groupBy("conv_id").agg(F.array_sort(F.collect_list("t")).alias("t"))
    grouped = grouped.withColumn("kept", F.expr("if(t[0].system, 1, 0)")).withColumn("kept_tokens", F.expr("if(t[0].system, t[0].tokens, 0L)"))
    repeats = f"""coalesce(array_max(filter(sequence(0, least({history}, greatest(x.i - kept, 0))), h ->
        h = 0 or (x.total - x.tokens - get(t, x.i - h).total + get(t, x.i - h).tokens <= {history_budget}
        and kept_tokens + x.total - get(t, x.i - h).total + get(t, x.i - h).tokens <= {budget}))), 0)"""
    begin = f"named_struct('i', x.i, 'h', cast({repeats} as int))"
    starts = grouped.withColumn(
        "starts",
        F.expr(f"""aggregate(t,
            named_struct('w', cast(array() as array<struct<i:int,h:int>>), 'origin', 0L),
            (a, x) -> case
                when size(a.w) = 0 then named_struct('w', array(named_struct('i', x.i, 'h', 0)), 'origin', 0L)
                when x.total - a.origin > {budget} then named_struct('w', concat(a.w, array({begin})),
                    'origin', x.total - x.tokens - kept_tokens - (x.total - x.tokens - get(t, x.i - {repeats}).total + get(t, x.i - {repeats}).tokens))
                else a end,
            a -> a.w)"""),
    )
    windows = starts.select(
        "conv_id",
        F.expr("""inline(transform(starts, (s, k) -> named_struct('window', k,
            'old', concat(if(k > 0 and kept = 1, slice(t, 1, 1), slice(t, 1, 0)), slice(t, s.i - s.h + 1, s.h)),
            'new', slice(t, s.i + 1, coalesce(get(starts, k + 1).i, size(t)) - s.i))))"""),
    )
    return windows.select(
        "conv_id",
        "window",
        F.expr("array_join(transform(concat(old, new), x -> x.written), '')").alias("formatted"),
        F.expr("size(old)").alias("repeated"),
        F.expr("aggregate(concat(old, new), 0L, (a, x) -> a + x.tokens)").alias("n_tokens"),
        F.expr("""aggregate(new,
            named_struct('at', aggregate(old, 0, (a, x) -> a + length(x.written)), 'spans', cast(array() as array<struct<start:int,length:int>>)),
            (a, x) -> named_struct('at', a.at + length(x.written), 'spans',
                if(x.target, concat(a.spans, array(named_struct('start', a.at + x.skip, 'length', x.size))), a.spans)),
            a -> a.spans)""").alias("loss"),
    )


def read_back(windows: DataFrame) -> DataFrame:
    """(conv_id, n_turns, turns, loss_text, formatted_chars) read from the formatted windows alone.

    turns is the text of role, line end, text, line end for each turn; repeated turns count once.
    """
    parts = F.expr(r"slice(split(formatted, '<\\|im_start\\|>'), repeated + 2, 2147483647)")
    head = r"(?s)^((?:[^\\\\\n]|\\\\.)*)\n(.*)<\\|im_end\\|>\n$"
    turn = f"""transform(parts, p -> concat(
        regexp_replace(regexp_extract(p, '{head}', 1), '(?s)\\\\\\\\(.)', '$1'), '\n',
        regexp_replace(regexp_extract(p, '{head}', 2), '(?s)\\\\\\\\(.)', '$1'), '\n'))"""
    loss = "transform(loss, s -> regexp_replace(substring(formatted, s.start + 1, s.length), '(?s)\\\\\\\\(.)', '$1'))"
    read = windows.withColumn("parts", parts).select(
        "conv_id",
        F.struct(
            "window",
            F.size("parts").cast("bigint").alias("n"),
            F.array_join(F.expr(turn), "").alias("turns"),
            F.array_join(F.expr(loss), "").alias("loss"),
            F.length("formatted").cast("bigint").alias("chars"),
        ).alias("w"),
    )
    grouped = read.groupBy("conv_id").agg(F.array_sort(F.collect_list("w")).alias("w"))
    return grouped.select(
        "conv_id",
        F.expr("aggregate(w, 0L, (a, x) -> a + x.n)").alias("n_turns"),
        F.expr("array_join(transform(w, x -> x.turns), '')").alias("turns"),
        F.expr("array_join(transform(w, x -> x.loss), '')").alias("loss_text"),
        F.expr("aggregate(w, 0L, (a, x) -> a + x.chars)").alias("formatted_chars"),
        F.size("w").alias("n_windows"),
    )


def digests(windows: DataFrame) -> DataFrame:
    """Counts and hashes of what `read_back` finds."""
    return read_back(windows).select(
        "conv_id",
        "n_turns",
        F.sha2(F.col("turns").cast("binary"), 256).alias("turns_sha256"),
        F.length("loss_text").cast("bigint").alias("loss_chars"),
        F.sha2(F.col("loss_text").cast("binary"), 256).alias("loss_sha256"),
        "formatted_chars",
        "n_windows",
    )
