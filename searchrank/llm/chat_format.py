"""Chat formatting with a verified grammar round trip (DataFrame functions only).

A conversation is rendered as

    <|im_start|>ROLE \\n TEXT <|im_end|> \\n      (once per turn, in order)

and must be readable again by one deterministic parser (``parse``): cut at
``<|im_end|>\\n``, each block is ``<|im_start|>``, a role up to the first
line feed, then text, and neither control string may occur inside.  Every
turn is first rendered raw and parsed; where the recovered turn differs
from the source its content is escaped.  The whole conversation is then
parsed again and compared, and the job fails rather than return a text
that does not read back identically.

Escapes (reversible): a control string gains one backslash after ``<|``
(``<|im_end|>`` -> ``<|\\im_end|>``, ``<|\\im_end|>`` -> ``<|\\\\im_end|>``);
in roles ``%``, line feed and ``<`` become ``%25``, ``%0A``, ``%3C``.

Defined cases: null text and null role read as empty; turns are ordered by
(turn, role, text), nulls first, so ties and repeated rows have one order
and repeated rows stay; null conv_id is a conversation of its own; an empty
table gives no rows; other columns are ignored.  One conversation is one
output value, so its text has to fit one row.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

IM_START, IM_END = "<|im_start|>", "<|im_end|>"
_BLOCK_END = r"<\|im_end\|>\n"
_CONTROL = r"<\|(\\*)(im_start|im_end)\|>"
_ESCAPED = r"<\|\\(\\*)(im_start|im_end)\|>"


def escape_text(c: Column) -> Column:
    return F.regexp_replace(c, _CONTROL, r"<|\\$1$2|>")


def unescape_text(c: Column) -> Column:
    return F.when(F.contains(c, F.lit("<|\\")), F.regexp_replace(c, _ESCAPED, "<|$1$2|>")).otherwise(c)


def escape_role(c: Column) -> Column:
    for raw, code in (("%", "%25"), ("\n", "%0A"), ("<", "%3C")):
        c = F.replace(c, F.lit(raw), F.lit(code))
    return c


def unescape_role(c: Column) -> Column:
    for raw, code in (("\n", "%0A"), ("<", "%3C"), ("%", "%25")):
        c = F.replace(c, F.lit(code), F.lit(raw))
    return c


def _render(role: Column, text: Column) -> Column:
    return F.concat(F.lit(IM_START), role, F.lit("\n"), text, F.lit(IM_END + "\n"))


def _turn(block: Column) -> Column:
    """A block without its end mark -> struct(role, text), null if malformed."""
    body = F.substr(block, F.lit(len(IM_START) + 1))
    feed = F.instr(body, "\n")
    fine = (F.startswith(block, F.lit(IM_START)) & (feed > 0)
            & ~F.contains(body, F.lit(IM_START)) & ~F.contains(body, F.lit(IM_END)))
    return F.when(fine, F.struct(
        unescape_role(F.substr(body, F.lit(1), feed - 1)).alias("role"),
        unescape_text(F.substr(body, feed + 1)).alias("text")))


def parse(formatted: Column) -> Column:
    """Formatted text -> array of struct(role, text); a malformed block is null."""
    blocks = F.split(formatted, _BLOCK_END, -1)
    return F.transform(F.slice(blocks, F.lit(1), F.array_size(blocks) - 1), _turn)


def format_conversations(turns: DataFrame, loss_role: str = "assistant") -> DataFrame:
    """(conv_id, turn, role, text) -> conv_id, formatted, loss_spans, n_escaped.

    ``loss_spans``: per turn of ``loss_role``, in order, where its (escaped)
    text lies in ``formatted``: code points (``start``, ``end`` exclusive)
    and UTF-8 bytes (``byte_start``, ``byte_end``).
    """
    role, text = F.col("role"), F.col("text")
    src = turns.select("conv_id", "turn", F.coalesce(F.col("role").cast("string"), F.lit("")).alias("role"),
                       F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    want = F.array(F.struct(role.alias("role"), text.alias("text")))
    src = src.withColumn("clash", ~F.coalesce(parse(_render(role, text)).eqNullSafe(want), F.lit(False)))
    src = src.select(
        "conv_id", "turn", "role", "text", "clash",
        F.when(F.col("clash"), escape_role(role)).otherwise(role).alias("r"),
        F.when(F.col("clash"), escape_text(text)).otherwise(text).alias("t"))
    frame = len(IM_START) + 1 + len(IM_END) + 1
    order = Window.partitionBy("conv_id").orderBy("turn", "role", "text")
    upto = order.rowsBetween(Window.unboundedPreceding, 0)
    src = (src.withColumn("ord", F.row_number().over(order))
           .withColumn("end", F.sum(F.char_length("r") + F.char_length("t") + frame).over(upto))
           .withColumn("byte_end", F.sum(F.octet_length("r") + F.octet_length("t") + frame).over(upto)))
    tail = len(IM_END) + 1
    span = F.struct((F.col("end") - tail - F.char_length("t")).alias("start"),
                    (F.col("end") - tail).alias("end"),
                    (F.col("byte_end") - tail - F.octet_length("t")).alias("byte_start"),
                    (F.col("byte_end") - tail).alias("byte_end"))
    got = src.groupBy("conv_id").agg(
        F.sort_array(F.collect_list(F.struct(
            "ord", _render(F.col("r"), F.col("t")).alias("piece"), "role", "text",
            F.when(role == loss_role, span).alias("span")))).alias("turns"),
        F.sum(F.col("clash").cast("long")).alias("n_escaped"))
    got = got.withColumn("formatted", F.array_join(F.transform("turns", lambda t: t["piece"]), ""))
    same = parse(F.col("formatted")).eqNullSafe(
        F.transform("turns", lambda t: F.struct(t["role"].alias("role"), t["text"].alias("text"))))
    return got.select(
        "conv_id",
        F.when(same, F.col("formatted")).otherwise(
            F.raise_error(F.lit("formatted conversation does not read back identically"))).alias("formatted"),
        F.filter(F.transform("turns", lambda t: t["span"]), lambda s: s.isNotNull()).alias("loss_spans"),
        "n_escaped")


def loss_text(formatted: DataFrame) -> DataFrame:
    """Add ``loss_text``: the unescaped text under ``loss_spans``, in order.

    Spans are read by byte offset, so a conversation of many turns costs
    time in proportion to its length.
    """
    raw = formatted.withColumn("_raw", F.col("formatted").cast("binary"))
    return raw.withColumn("loss_text", F.array_join(F.transform(
        "loss_spans", lambda s: unescape_text(
            F.substring(F.col("_raw"), (s["byte_start"] + 1).cast("int"),
                        (s["byte_end"] - s["byte_start"]).cast("int")).cast("string"))), "")).drop("_raw")
