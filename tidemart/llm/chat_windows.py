"""Chat formatting in budgeted windows, with DataFrame functions alone.

A conversation becomes one or more windows.  Prefix sums of turn tokens choose turn-aligned
spans: a span goes on up to the last turn whose sum the budget allows.  Each window repeats the
system turn and a limited history of the turns before its span.  Repeated turns are context: the loss mask covers the assistant
texts of a window's own span, so that every assistant text is learnt once.

Template of a turn: ``<turn ROLE>\\nTEXT</turn>\\n``.  ``&`` and ``<`` in texts (and ``>``
in roles) are written as ``&amp;``, ``&lt;`` and ``&gt;``, so no text can hold a mark.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Tokens of a window, tokens of repeated history, turns of repeated history.
BUDGET, HISTORY_TOKENS, HISTORY_TURNS = 1024, 256, 4
END = "</turn>\n"


def escaped(text: Column) -> Column:
    text = F.replace(text, F.lit("&"), F.lit("&amp;"))
    return F.replace(text, F.lit("<"), F.lit("&lt;"))


def unescaped(text: Column) -> Column:
    for mark, char in (("&lt;", "<"), ("&gt;", ">"), ("&amp;", "&")):
        text = F.replace(text, F.lit(mark), F.lit(char))
    return text


def token_estimate(text: Column) -> Column:
    """Tokens of a text: one for each four bytes begun, and three for its marks."""
    return F.ceil(F.octet_length(text) / 4).cast("long") + 3


def span_starts(budget: int, history_tokens: int, history_turns: int) -> Column:
    """Where spans begin (array of struct<ord, history>: the first turn, the turns repeated
    before it) from ``turns``, an ordered array of struct<ord, before, sum> (prefix sums without
    and with the turn), and ``room``, what the system turn leaves of the budget.

    A span ends before the first turn whose sum exceeds ``top``.  ``tail`` has the sums before
    the last turns of the span, newest first: history that may go along.
    """
    state = "struct<starts:array<struct<ord:bigint,history:int>>,top:bigint,tail:array<bigint>>"
    return F.expr(f"""aggregate(turns,
        cast(struct(array(), null, array()) as {state}),
        (span, t) -> if(t.sum <= span.top,
            cast(struct(span.starts, span.top,
                        slice(concat(array(t.before), span.tail), 1, {history_turns})) as {state}),
            element_at(transform(
                array(size(filter(span.tail, s -> t.before - s <=
                                  least({history_tokens}L, room - (t.sum - t.before))))),
                n -> cast(struct(
                    concat(span.starts, array(named_struct('ord', t.ord, 'history', n))),
                    if(n = 0, t.before, element_at(span.tail, greatest(n, 1))) + room,
                    slice(array(t.before), 1, {history_turns})) as {state})), 1)),
        span -> span.starts)""")


def chat_windows(conversations: DataFrame, budget: int = BUDGET,
                 history_tokens: int = HISTORY_TOKENS, history_turns: int = HISTORY_TURNS,
                 tokens: Column | None = None) -> DataFrame:
    """One row for each window: conv_id, window (from 0), formatted, tokens, ords (number of
    each of its turns within the conversation), repeated (is that turn context?) and
    loss (array of struct<start, len>, code points of ``formatted`` from 0).

    ``conversations`` has conv_id, turn, role, text, and ``tokens`` may count the tokens of a
    turn (null: 0).  Turns go by turn, role, text (null turns first); null roles and texts are
    empty; repeated rows are turns of their own; rows with a null conv_id are one conversation.
    A window holds at most ``budget`` tokens unless one turn and the system turn are more: that
    turn is never cut and is the only one of its window.
    """
    c = conversations
    text = F.coalesce(c["text"], F.lit(""))
    turns = c.select(
        "conv_id", "turn", F.coalesce(c["role"], F.lit("")).alias("role"), text.alias("text"),
        (token_estimate(text) if tokens is None
         else F.coalesce(tokens.cast("long"), F.lit(0))).alias("tokens"))
    in_order = Window.partitionBy("conv_id").orderBy("turn", "role", "text")
    whole = Window.partitionBy("conv_id")
    turns = (turns.withColumn("ord", F.row_number().over(in_order).cast("long"))
             .withColumn("is_system", (F.col("ord") == 1) & (F.col("role") == "system")))
    in_order = Window.partitionBy("conv_id").orderBy("ord")
    to_here = in_order.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    turns = turns.withColumn("sum", F.sum("tokens").over(to_here))
    # spans begin where the prefix sums say; only sums are gathered, no texts
    sums = turns.groupBy("conv_id").agg(
        F.array_sort(F.collect_list(F.when(~F.col("is_system"), F.struct(
            "ord", (F.col("sum") - F.col("tokens")).alias("before"), "sum")))).alias("turns"),
        (F.lit(budget) - F.sum(F.when(F.col("is_system"), F.col("tokens")).otherwise(0)))
        .alias("room"))
    begins = sums.select(
        F.col("conv_id").alias("id"),
        span_starts(budget, history_tokens, history_turns).alias("starts")).select(
        "id", F.expr("""inline(transform(starts, (s, i) -> struct(s.ord as begin, i as number,
                        coalesce(get(starts, i + 1).history, 0) as keeps)))"""))
    turns = turns.join(begins, F.col("conv_id").eqNullSafe(F.col("id"))
                       & (F.col("ord") == F.col("begin")), "left")
    # the system turn goes with the first span
    turns = (turns.withColumn("window", F.coalesce(F.max("number").over(to_here), F.lit(0)))
             .withColumn("last_window", F.max("window").over(whole)))
    # the last turns of a span, as far as the history allows, follow into the next window
    in_window = Window.partitionBy("conv_id", "window")
    turns = turns.withColumn("follows", ~F.col("is_system") & (
        F.max("ord").over(in_window) - F.col("ord")
        < F.coalesce(F.max("keeps").over(in_window), F.lit(0))))
    places = (F.when(F.col("is_system"), F.sequence(F.col("window"), F.col("last_window")))
              .when(F.col("follows"), F.array(F.col("window"), F.col("window") + 1))
              .otherwise(F.array(F.col("window"))))
    role = F.replace(escaped(F.col("role")), F.lit(">"), F.lit("&gt;"))
    head = F.concat(F.lit("<turn "), role, F.lit(">\n"))
    body = escaped(F.col("text"))
    placed = turns.select(
        "conv_id", "ord", "tokens", F.col("window").alias("home"), "role",
        head.alias("head"), body.alias("body"), F.explode(places).alias("window"))
    part = F.struct("ord", (F.col("window") != F.col("home")).alias("repeated"), "role", "tokens",
                    F.length("head").cast("long").alias("head_chars"),
                    F.length("body").cast("long").alias("body_chars"),
                    F.concat("head", "body", F.lit(END)).alias("piece"))
    windows = (placed.groupBy("conv_id", "window")
               .agg(F.array_sort(F.collect_list(part)).alias("parts")))
    # where each turn begins: prefix sums of the pieces' lengths
    sizes = f"transform(parts, p -> p.head_chars + p.body_chars + {len(END)})"
    starts = F.expr(
        f"slice(aggregate({sizes}, array(0L), (a, n) -> concat(a, array(element_at(a, -1) + n))),"
        " 1, size(parts))")
    windows = windows.withColumn("starts", starts)
    loss = F.expr("""transform(filter(arrays_zip(parts, starts),
                     x -> x.parts.role = 'assistant' and not x.parts.repeated),
                     x -> struct(x.starts + x.parts.head_chars as start,
                                 x.parts.body_chars as len))""")
    return windows.select(
        "conv_id", "window", F.expr("array_join(transform(parts, p -> p.piece), '')")
        .alias("formatted"),
        F.expr("aggregate(parts, 0L, (a, p) -> a + p.tokens)").alias("tokens"),
        F.expr("transform(parts, p -> p.ord)").alias("ords"),
        F.expr("transform(parts, p -> p.repeated)").alias("repeated"), loss.alias("loss"))


def parse_windows(windows: DataFrame) -> DataFrame:
    """The turns of ``chat_windows`` back from the formatted texts: conv_id, ord, role, text."""
    pieces = F.slice(F.split("formatted", END), 1, F.size("ords"))
    turns = windows.select("conv_id", F.explode(F.arrays_zip(
        pieces.alias("piece"), F.col("ords").alias("ord"), F.col("repeated"))).alias("x"))
    turns = turns.filter("not x.repeated").select("conv_id", "x.ord", "x.piece")
    begin = len("<turn ")
    return turns.select(
        "conv_id", "ord",
        unescaped(F.expr(f"substring(piece, {begin + 1}, locate('>\n', piece) - {begin + 1})"))
        .alias("role"),
        unescaped(F.expr("substring(piece, locate('>\n', piece) + 2)")).alias("text"))


def digests(windows: DataFrame) -> DataFrame:
    """Per conversation, read back from its windows: n_turns, turns_sha256 (role, newline,
    text, newline of each turn), loss_chars and loss_sha256 (the unescaped text under
    the loss mask) and formatted_chars."""
    turns = parse_windows(windows).select(
        "conv_id", F.struct("ord", F.concat("role", F.lit("\n"), "text", F.lit("\n"))
                            .alias("said")).alias("turn"))
    by_turn = turns.groupBy("conv_id").agg(
        F.count(F.lit(1)).alias("n_turns"),
        F.expr("sha2(array_join(transform(array_sort(collect_list(turn)), t -> t.said), ''), 256)")
        .alias("turns_sha256"))
    cut = F.expr("array_join(transform(loss, s -> "
                 "substring(formatted, cast(s.start as int) + 1, cast(s.len as int))), '')")
    masked = windows.select("conv_id", "window", unescaped(cut).alias("learnt"),
                            F.length("formatted").cast("long").alias("chars"))
    by_window = masked.groupBy("conv_id").agg(
        F.expr("array_join(transform(array_sort(collect_list(struct(window, learnt))), "
               "w -> w.learnt), '')").alias("learnt"), F.sum("chars").alias("formatted_chars"))
    # the grouping keys are renamed so that the null-safe join stays an equality join
    by_window = by_window.select(F.col("conv_id").alias("id"), "learnt", "formatted_chars")
    return by_turn.join(by_window, F.col("conv_id").eqNullSafe(F.col("id"))).select(
        "conv_id", "n_turns", "turns_sha256",
        F.length("learnt").cast("long").alias("loss_chars"),
        F.sha2("learnt", 256).alias("loss_sha256"), "formatted_chars")
