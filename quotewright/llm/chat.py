"""Chat formatting with a grammar round trip (operator 9).

    conversation := turn*
    turn         := "<|im_start|>" header "\\n" body "<|im_end|>" "\\n"
    header       := role | "!" escaped role      (no "\\n" in either)

The parser is deterministic: the text is cut at every ``<|im_start|>``; a
header ends at the first line end and a body at the first ``<|im_end|>``, after
which exactly a line end must follow. A ``!`` says that role and body are
escaped. Every turn is rendered plainly, parsed again and compared; a turn
that does not come back as it was is rendered escaped. The whole conversation
is parsed once more at the end; ``identical`` is the result of that comparison.

Null roles and texts count as empty. Turns are ordered by turn, then role and
text, with null turns first; repeated rows are turns of their own. Rows with a
null ``conv_id`` form one conversation. Other columns are ignored. An empty
table gives no rows. One conversation is one output value, so all its turns
meet in one row; that is its natural bound.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

_START, _END = "<|im_start|>", "<|im_end|>"


def _escaped(text: Column) -> Column:
    r"""Backslashes as ``\s``, ``<|`` as ``<\|``; so each backslash of the result begins one of three pairs."""
    return F.replace(F.replace(text, F.lit("\\"), F.lit("\\s")), F.lit("<|"), F.lit("<\\|"))


def _escaped_role(role: Column) -> Column:
    r"""As a body, and line ends as ``\n``."""
    return F.replace(_escaped(role), F.lit("\n"), F.lit("\\n"))


def _unescaped(text: Column) -> Column:
    for pair, plain in (("\\|", "|"), ("\\n", "\n"), ("\\s", "\\")):
        text = F.replace(text, F.lit(pair), F.lit(plain))
    return text


def _rendered(role: Column, text: Column, escape: Column) -> Column:
    plain = F.concat(F.lit(_START), role, F.lit("\n"), text, F.lit(f"{_END}\n"))
    safe = F.concat(F.lit(f"{_START}!"), _escaped_role(role), F.lit("\n"), _escaped(text), F.lit(f"{_END}\n"))
    return F.when(escape, safe).otherwise(plain)


def _parsed(piece: Column) -> Column:
    """struct(role, text, valid, head_chars, body_chars) of what follows a ``<|im_start|>``."""
    cut = F.instr(piece, "\n")
    header = F.substring(piece, F.lit(1), F.greatest(cut - 1, F.lit(0)))
    rest = F.substr(piece, cut + 1)
    stop = F.instr(rest, _END)
    body = F.substr(rest, F.lit(1), F.greatest(stop - 1, F.lit(0)))
    tail = F.substr(rest, stop + len(_END))
    marked = F.startswith(header, F.lit("!"))
    return F.struct(
        F.when(marked, _unescaped(F.substr(header, F.lit(2)))).otherwise(header).alias("role"),
        F.when(marked, _unescaped(body)).otherwise(body).alias("text"),
        ((cut > 0) & (stop > 0) & (tail == "\n")).alias("valid"),
        F.length(header).alias("head_chars"),
        F.length(body).alias("body_chars"),
    )


def parse(formatted: Column) -> Column:
    """array<struct(role, text, valid, head_chars, body_chars)> of a formatted conversation."""
    pieces = F.split(formatted, r"<\|im_start\|>", -1)
    return F.transform(F.slice(pieces, F.lit(2), F.greatest(F.size(pieces) - 1, F.lit(0))), _parsed)


def format_conversations(turns: DataFrame) -> DataFrame:
    """``conv_id, formatted, loss_spans, escaped, identical`` for every conversation.

    ``loss_spans`` holds (start, end) in code points, end exclusive, of each
    assistant body within ``formatted``; ``escaped`` counts escaped turns.
    """
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    rows = turns.select("conv_id", F.col("turn").cast("long").alias("turn"), role.alias("role"), text.alias("text"))
    plain = _rendered(F.col("role"), F.col("text"), F.lit(False))
    rows = rows.withColumn("back", parse(plain))
    same = (
        (F.size("back") == 1) & F.col("back")[0]["valid"]
        & (F.col("back")[0]["role"] == F.col("role")) & (F.col("back")[0]["text"] == F.col("text"))
    )
    rows = rows.withColumn("escape", ~F.coalesce(same, F.lit(False)))
    rows = rows.select("conv_id", "turn", "role", "text", "escape", _rendered(F.col("role"), F.col("text"), F.col("escape")).alias("out"))
    talks = rows.groupBy("conv_id").agg(
        F.sort_array(F.collect_list(F.struct("turn", "role", "text", "out", "escape"))).alias("turns")
    )
    talks = talks.select(
        "conv_id", "turns", F.array_join("turns.out", "").alias("formatted")
    ).withColumn("back", parse(F.col("formatted")))
    return talks.select(
        "conv_id",
        "formatted",
        _assistant_spans(F.col("back")).alias("loss_spans"),
        F.size(F.filter("turns", lambda t: t["escape"])).cast("long").alias("escaped"),
        (
            F.forall("back", lambda t: t["valid"])
            & (F.transform("back", lambda t: F.struct(t["role"], t["text"]))
               == F.transform("turns", lambda t: F.struct(t["role"].alias("role"), t["text"].alias("text"))))
        ).alias("identical"),
    )


def _assistant_spans(back: Column) -> Column:
    """Bodies of the assistant, from the lengths of the parsed parts."""
    first = F.struct(F.lit(0).cast("long").alias("at"), F.array().cast("array<struct<start:long,end:long>>").alias("spans"))
    lead, trail = len(_START), len(_END) + 1

    def step(state, turn):
        begin = state["at"] + lead + turn["head_chars"] + 1
        end = begin + turn["body_chars"]
        span = F.struct(begin.alias("start"), end.alias("end"))
        spans = F.when(turn["role"] == "assistant", F.array_append(state["spans"], span)).otherwise(state["spans"])
        return F.struct((end + trail).alias("at"), spans.alias("spans"))

    return F.aggregate(back, first, step, lambda state: state["spans"])


def digests(talks: DataFrame) -> DataFrame:
    """Counts and digests, all read back from ``formatted`` and ``loss_spans``."""
    back = talks.withColumn("back", parse(F.col("formatted")))
    whole = F.array_join(
        F.transform("back", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), ""
    )
    masked = F.transform("loss_spans", lambda s: F.substr(F.col("formatted"), (s["start"] + 1).cast("int"), (s["end"] - s["start"]).cast("int")))
    marks = F.transform(
        F.filter("back", lambda t: t["role"] == "assistant"), lambda t: t["body_chars"]
    )
    # A header tells whether its body is escaped; it stands just before the span.
    flagged = F.transform(
        F.arrays_zip("loss_spans", masked.alias("body")),
        lambda z: F.when(
            F.substr(F.col("formatted"), (z["loss_spans"]["start"] - len("!assistant")).cast("int"), F.lit(10)) == "!assistant",
            _unescaped(z["body"]),
        ).otherwise(z["body"]),
    )
    loss = F.array_join(flagged, "")
    return back.select(
        "conv_id",
        F.size("back").cast("long").alias("n_turns"),
        F.sha2(whole, 256).alias("turns_sha256"),
        F.length(loss).cast("long").alias("loss_chars"),
        F.sha2(loss, 256).alias("loss_sha256"),
        F.length("formatted").cast("long").alias("formatted_chars"),
        "escaped",
        "identical",
        (F.size(marks) == F.size("loss_spans")).alias("masks_match"),
    )
