"""Chat formatting in budgeted windows, in DataFrame functions only.

Prefix sums of the turns' tokens cut a conversation greedily into turn-aligned spans.
Every window is the system turn, some history repeated from before the span, and the span
itself; only the assistant turns of its own span are targets, so that a repeated one
is masked and each is learnt once.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from headway.llm.rules import let

#: Tokens of a window, and the part of them for what is repeated in front of a span.
BUDGET = 1024
HISTORY = 256
#: Turn numbers of a block (a power of two), and characters of a block's rows: what one row holds at most.
BLOCK_BITS = 10
BLOCK_CHARS = 1 << 22
TURN, BODY, END = "<|", "|>", "</s>"
#: Control strings begin with < or [; inside texts these and the escape itself are
#: written as two letters, so that no control string can be part of a text.
ESCAPES = (("\\", "\\s"), ("<", "\\l"), ("[", "\\b"), ("|", "\\p"), ("\n", "\\n"))


def escaped(text: Column, newlines: bool = False) -> Column:
    for plain, written in ESCAPES if newlines else ESCAPES[:-1]:
        text = F.replace(text, F.lit(plain), F.lit(written))
    return text


def unescaped(text: Column) -> Column:
    for plain, written in reversed(ESCAPES):
        text = F.replace(text, F.lit(written), F.lit(plain))
    return text


def turn_tokens(text: Column) -> Column:
    """Tokens of a turn for the budget: its words, and four for the template."""
    return F.size(F.filter(F.split(F.coalesce(text, F.lit("")), "[ \\t-\\r]+"), lambda w: w != "")).cast("long") + 4


def formatted(role: Column, text: Column) -> Column:
    """One turn in the template: ``<|role|>text</s>`` and a line end."""
    return F.concat(F.lit(TURN), escaped(role, newlines=True), F.lit(BODY), escaped(text), F.lit(END + "\n"))


def _leading_system(given: DataFrame) -> DataFrame:
    """(conv_id, turn, text) of the conversations whose first of several turns is a system turn."""
    turn, role = F.col("turn"), F.col("role")
    firsts = (given.groupBy(F.col("conv_id").alias("of"))
              .agg(F.count("*").alias("n"), F.min(turn).alias("first"), F.min(F.when(role < "system", turn)).alias("other"),
                   F.min(F.when(role == "system", turn)).alias("at"))
              .filter("n > 1 and at = first and (other is null or other > at)").select("of", "at"))
    return (given.filter(role == "system").join(firsts, F.col("conv_id").eqNullSafe(F.col("of")) & (turn == F.col("at")))
            .groupBy("conv_id").agg(F.min("turn").alias("turn"), F.min("text").alias("text")))


def _turns(given: DataFrame) -> DataFrame:
    """A row per part of a conversation: its turns in order with the tokens before each, and the system turn's text."""
    block = F.shiftright("turn", BLOCK_BITS).alias("block")
    system = _leading_system(given)
    blocks = given.select(F.col("conv_id").alias("of"), block).distinct()
    heads = system.join(blocks, F.col("conv_id").eqNullSafe(F.col("of"))).select(
        "conv_id", "block", F.lit(0).alias("kind"), "turn", F.lit("system").alias("role"), "text")
    rows = given.select("conv_id", block, F.lit(1).alias("kind"), "turn", "role", "text").unionByName(heads)
    order = W.partitionBy("conv_id", "block").orderBy("kind", "turn", "role", "text")
    running = order.rowsBetween(W.unboundedPreceding, W.currentRow)
    placed = rows.withColumns({"tokens": turn_tokens(F.col("text")), "chars": F.length("text").cast("long")}).withColumns({
        "n": F.row_number().over(order) - 1,
        "system": F.first(F.when(F.col("kind") == 0, F.struct("turn", "text")), ignorenulls=True).over(running),
        "before": F.sum("tokens").over(running) - F.col("tokens"),
        "ahead": F.sum("chars").over(running) - F.col("chars")})
    # In a conversation's first block the turn after the copy of the system turn is that turn itself.
    itself = F.coalesce((F.col("n") == 1) & (F.shiftright("system.turn", BLOCK_BITS) == F.col("block")), F.lit(False))
    return (placed.filter((F.col("kind") == 1) & ~itself)
            .withColumns({"part": F.shiftright("n", BLOCK_BITS), "chunk": F.floor(F.col("ahead") / BLOCK_CHARS)})
            .groupBy("conv_id", "block", "part", "chunk")
            .agg(F.array_sort(F.collect_list(_turn(F.col("n"), F.col("before"), F.col("tokens"), F.col("role"), F.col("text")))).alias("turns"),
                 F.first("system.text", ignorenulls=True).alias("system")))


def _turn(n: Column, before: Column, tokens: Column, role: Column, text: Column) -> Column:
    head = F.length(F.concat(F.lit(TURN), escaped(role, newlines=True), F.lit(BODY)))
    return F.struct(n.alias("n"), before.alias("before"), tokens.alias("tokens"), role.alias("role"),
                    formatted(role, text).alias("text"), head.alias("head"))


def _spans(turns: Column, room: Column, history: int) -> Column:
    """(start, past) of greedy spans: each ends before the first turn whose prefix sum passes the room left.

    The first span has nothing to repeat and takes the whole room, later ones leave ``history`` of it.
    """
    def step(acc: Column, t: Column) -> Column:
        left = room - F.when(F.size(acc["starts"]) == 1, 0).otherwise(history)
        fits = (acc["i"] > 0) & (t["before"] + t["tokens"] - acc["base"] <= left)
        return F.struct(F.when(fits, acc["starts"]).otherwise(F.concat(acc["starts"], F.array(acc["i"]))).alias("starts"),
                        (acc["i"] + 1).alias("i"), F.when(fits, acc["base"]).otherwise(t["before"]).alias("base"))

    none = F.struct(F.array().cast("array<int>").alias("starts"), F.lit(0).alias("i"), F.lit(0).cast("long").alias("base"))
    starts = F.aggregate(turns, none, step, lambda acc: acc["starts"])
    return let(starts, lambda at: F.transform(
        at, lambda s, k: F.struct(s.alias("start"), F.coalesce(F.get(at, k + 1), F.size(turns)).alias("past"))))


def windows(conversations: DataFrame, budget: int = BUDGET, history: int = HISTORY) -> DataFrame:
    """(conv_id, window, text, targets, n_repeated, n_own, tokens) of all conversations.

    ``targets`` is the loss mask: an array of (start, length) in characters of ``text``, in
    order, of this window's own assistant turns.  Own turns fill a window greedily up to
    ``budget`` less the system turn and, behind the first window, less ``history``; then as
    many turns before them are repeated as fit into ``history`` and into what is left.  A
    turn is never cut: one that does not leave room for history stands without it, and only
    a turn that passes the budget by itself, with the system turn, is in a window over it.
    Turns are ordered by turn, role and text, null first.  A null role or text is empty;
    rows repeated in all columns are turns of their own; a null conv_id is a conversation.
    A leading ``system`` turn is repeated in every window; other system turns are turns like
    any other.  A conversation of a system turn only is one window.  ``window`` orders the
    windows of a conversation.  Long conversations are cut into blocks of 1,024 turn
    numbers, and those by rows and characters where turns repeat or are very long; a window
    never crosses such a cut and repeats nothing from before it but the system turn, so that
    no task holds a whole long conversation.  An empty table gives an empty result.
    """
    given = conversations.select(
        "conv_id", F.coalesce(F.col("turn").cast("long"), F.lit(-1 << 63)).alias("turn"),
        F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"))
    turns, system = F.col("turns"), F.col("system")
    nothing = F.lit(0).cast("long")
    heads = F.array(_turn(F.lit(-1), nothing, turn_tokens(system), F.lit("system"), system))
    room = F.lit(budget) - F.when(system.isNull(), 0).otherwise(turn_tokens(system))
    # Every turn has four tokens at least, which bounds how many can be repeated.
    furthest = history // 4

    def window(span: Column) -> Column:
        first, last = F.get(turns, span["start"]), F.get(turns, span["past"] - 1)
        left = F.least(F.lit(history), F.col("room") - (last["before"] + last["tokens"] - first["before"]))
        lo = F.greatest(span["start"] - furthest, F.lit(0))
        repeated = F.filter(F.slice(turns, lo + 1, span["start"] - lo), lambda t: first["before"] - t["before"] <= left)
        return F.struct(span["start"].alias("start"), F.concat(F.col("heads"), repeated).alias("repeated"),
                        F.slice(turns, span["start"] + 1, span["past"] - span["start"]).alias("own"))

    each = _turns(given).withColumns({"room": room, "heads": F.when(system.isNull(), F.slice(heads, 1, 0)).otherwise(heads)})
    each = each.select("conv_id", "block", "part", "chunk", F.explode(F.transform(_spans(turns, F.col("room"), history), window)).alias("w"))
    each = each.select("conv_id", F.struct("block", "part", "chunk", "w.start").alias("window"), "w.repeated", "w.own")
    parts = F.concat(F.col("repeated"), F.col("own"))
    # Where each own turn begins: a running sum of the lengths of those before it.
    ahead = F.aggregate("repeated", F.lit(0), lambda acc, t: acc + F.length(t["text"]))
    at = F.aggregate(
        "own", F.struct(ahead.alias("at"), F.array().cast("array<struct<start:int,length:int>>").alias("targets")),
        lambda acc, t: F.struct(
            (acc["at"] + F.length(t["text"])).alias("at"),
            F.when(t["role"] == "assistant", F.concat(acc["targets"], F.array(F.struct(
                (acc["at"] + t["head"]).alias("start"), (F.length(t["text"]) - t["head"] - len(END) - 1).alias("length")))))
            .otherwise(acc["targets"]).alias("targets")),
        lambda acc: acc["targets"])
    return each.select(
        "conv_id", "window", F.array_join(F.transform(parts, lambda t: t["text"]), "").alias("text"), at.alias("targets"),
        F.size("repeated").alias("n_repeated"), F.size("own").alias("n_own"),
        F.aggregate(parts, F.lit(0).cast("long"), lambda acc, t: acc + t["tokens"]).alias("tokens"))


def read_back(formatted_windows: DataFrame) -> DataFrame:
    """(conv_id, window, turns, losses): what the formatted texts alone say.

    ``turns``: (role, text) of all turns of a window, its repeated ones included;
    ``losses``: unescaped text under the loss mask, in order.
    """
    pieces = F.filter(F.split("text", F.lit(END + "\n"), -1), lambda p: p != "")
    turn = lambda p: F.struct(
        unescaped(F.substring_index(F.substr(p, F.lit(3)), BODY, 1)).alias("role"),
        unescaped(F.substr(p, F.position(F.lit(BODY), p) + 2)).alias("text"))
    losses = F.transform("targets", lambda t: unescaped(F.substr(F.col("text"), t["start"] + 1, t["length"])))
    return formatted_windows.select("conv_id", "window", "n_repeated", F.length("text").cast("long").alias("chars"),
                                    F.transform(pieces, turn).alias("turns"), losses.alias("losses"))
