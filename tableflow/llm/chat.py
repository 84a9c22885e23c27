"""Chat formatting by prefix-target expansion, in DataFrame functions only.

Every assistant turn becomes an example of its own: all turns before it as context, and
only its text trainable. A turn is written ``<s>role[INST]text[/INST]`` in the context and
``<s>role[INST]text</s>`` as the target. In roles and texts the characters that control
strings start with are escaped, so no text can end or open a turn.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

OPEN, BODY, CLOSE, END = "<s>", "[INST]", "[/INST]", "</s>"
#: escapes, in order; undone in reverse order
ESCAPES = (("\\", "\\e"), ("<", "\\l"), ("[", "\\b"))


def escape(text: Column) -> Column:
    """Reversible: afterwards the text has no ``<`` and no ``[``."""
    for plain, code in ESCAPES:
        text = F.replace(text, F.lit(plain), F.lit(code))
    return text


def unescape(text: Column) -> Column:
    for plain, code in reversed(ESCAPES):
        text = F.replace(text, F.lit(code), F.lit(plain))
    return text


def _concat_all(parts: Column) -> Column:
    return F.array_join(parts, "")


def expand(turns: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role",
           text_col: str = "text", target_role: str = "assistant") -> DataFrame:
    """Examples: ``conv_col``, ``example`` (0, 1, ...), ``n_turns``, ``formatted``, ``loss_start``, ``loss_end``.

    Rows of a conversation go by turn; ties by role, then text, and repeated rows are
    turns of their own; a null turn comes first; a null role or text is empty; a null
    conversation id is one conversation. Turns after the last target (or of a
    conversation without one) form a last example without loss
    (``loss_start = loss_end``), so the output holds every turn. Loss positions are code
    points, end exclusive. An empty table gives no rows; other columns are ignored,
    whatever their names.

    One shuffle by conversation. The context is kept once for each conversation, and each
    example takes a prefix of it; what grows with the square of a conversation's turns is
    the output that this expansion is.
    """
    rows = turns.select(F.col(conv_col).alias("conv"), F.struct(
        F.col(turn_col).alias("turn"), F.coalesce(F.col(role_col), F.lit("")).alias("role"),
        F.coalesce(F.col(text_col), F.lit("")).alias("text")).alias("t"))
    convs = rows.groupBy("conv").agg(F.array_sort(F.collect_list("t")).alias("turns"))
    heads = F.transform("turns", lambda t: F.concat(F.lit(OPEN), escape(t["role"]), F.lit(BODY)))
    bodies = F.transform("turns", lambda t: escape(t["text"]))
    context = F.zip_with("heads", "bodies", lambda h, b: F.concat(h, b, F.lit(CLOSE)))
    convs = (convs.select("conv", F.transform("turns", lambda t: t["role"]).alias("roles"), heads.alias("heads"),
                          bodies.alias("bodies"))
             .withColumn("context", context)
             .withColumn("lengths", F.transform("context", lambda c: F.length(c).cast("bigint")))
             .withColumn("context", _concat_all(F.col("context"))))
    n = F.size("roles")
    # 0-based places of the targets, and one past the last turn if the last turn is no target
    places = F.filter(F.sequence(F.lit(0), n), lambda i: F.when(
        i < n, F.get("roles", i) == target_role).otherwise(F.get("roles", n - 1) != target_role))
    # characters of context before each place
    before = F.aggregate("lengths", F.array(F.lit(0).cast("bigint")),
                         lambda a, x: F.concat(a, F.array(F.element_at(a, -1) + x)))
    examples = convs.withColumn("before", before).select(
        "conv", "roles", "heads", "bodies", "context", "before", F.posexplode(places).alias("example", "place"))
    prefix = F.substring("context", F.lit(1), F.get("before", F.col("place")).cast("int"))
    head, body = F.get("heads", F.col("place")), F.get("bodies", F.col("place"))
    is_target = F.col("place") < F.size("roles")
    formatted = F.when(is_target, F.concat(prefix, head, body, F.lit(END))).otherwise(prefix)
    at = F.get("before", F.col("place"))
    start = F.when(is_target, at + F.length(head)).otherwise(at)
    end = F.when(is_target, at + F.length(head) + F.length(body)).otherwise(at)
    return examples.select(
        F.col("conv").alias(conv_col), F.col("example").cast("bigint").alias("example"),
        F.least(F.col("place") + 1, F.size("roles")).cast("bigint").alias("n_turns"), formatted.alias("formatted"),
        start.alias("loss_start"), end.alias("loss_end"))


def parse(formatted: Column) -> Column:
    """Turns (role, text) of one formatted example."""
    pieces = F.split(formatted, OPEN)
    parts = F.slice(pieces, F.lit(2), F.size(pieces) - 1)  # nothing stands before the first turn
    body = lambda p: F.substring_index(F.substring_index(p, END, 1), CLOSE, 1)
    return F.transform(parts, lambda p: F.struct(
        unescape(F.split_part(body(p), F.lit(BODY), F.lit(1))).alias("role"),
        unescape(F.split_part(body(p), F.lit(BODY), F.lit(2))).alias("text")))


def read_back(examples: DataFrame, conv_col: str = "conv_id") -> DataFrame:
    """Each conversation, read from its formatted examples alone: its turns, and the text under the loss mask.

    The last example holds all turns. The examples of a conversation lie together
    already, so this adds no shuffle.
    """
    loss = unescape(F.col("formatted").substr((F.col("loss_start") + 1).cast("int"),
                                              (F.col("loss_end") - F.col("loss_start")).cast("int")))
    rows = examples.select(conv_col, "example", "formatted", loss.alias("loss"))
    return rows.groupBy(conv_col).agg(
        F.max_by("formatted", "example").alias("last"),
        F.array_sort(F.collect_list(F.struct("example", "loss"))).alias("losses"),
        F.sum(F.length("formatted")).alias("formatted_chars"))


def chat_digests(turns: DataFrame) -> DataFrame:
    """Query rows: digests of what is read back from the formatted examples."""
    r = read_back(expand(turns)).withColumn("turns", parse(F.col("last")))
    said = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    loss = F.array_join(F.transform("losses", lambda x: x["loss"]), "")
    return r.select("conv_id", F.size("turns").cast("bigint").alias("n_turns"), F.sha2(said, 256).alias("turns_sha256"),
                    F.length(loss).cast("bigint").alias("loss_chars"), F.sha2(loss, 256).alias("loss_sha256"),
                    F.col("formatted_chars").cast("bigint").alias("formatted_chars"))
