"""Chat formatting with Spark expressions only.

A conversation's rows are collected as structs, sorted by turn, and neighbouring
turns of one role are merged into one block by array aggregation::

    <|turn|>role<|body|>text<|more|>text<|end|>

``<|more|>`` parts the texts that were merged, so no turn is lost.  Control strings
in roles and texts are escaped: ``&`` becomes ``&amp;``, and the ``<`` of ``<|`` and
of ``</s>`` and the ``[`` of ``[INST]`` and ``[/INST]`` become references too.  After
escaping no control string of this or of the common instruction templates is left
in a text, and unescaping gives back every text as it was.

The loss mask covers assistant texts; :func:`read_back` parses the formatted string
alone, by splitting at the control strings, so what it returns is what the output
holds.

Defined results: a null text or role counts as empty; null turns sort first; rows of
equal turn are ordered by role, then text; repeated rows stay; a null conversation
identifier is a conversation of its own; an empty table gives an empty result;
other columns, whatever their names, are not read.

A conversation is one training example and one output string, so its rows have to
meet in one task; rows of one conversation are therefore a bound of the format, not
of this operator.  Nothing else is grouped.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

TURN, BODY, MORE, END = "<|turn|>", "<|body|>", "<|more|>", "<|end|>"

#: Control strings and what stands for them inside texts; & comes first and is undone last.
ESCAPES = (
    ("&", "&amp;"),
    ("<|", "&lt;|"),
    ("</s>", "&lt;/s>"),
    ("<s>", "&lt;s>"),
    ("[INST]", "&lb;INST]"),
    ("[/INST]", "&lb;/INST]"),
)


def escape(text: Column) -> Column:
    text = F.coalesce(text, F.lit(""))
    for plain, safe in ESCAPES:
        text = F.replace(text, F.lit(plain), F.lit(safe))
    return text


def unescape(text: Column) -> Column:
    for plain, safe in reversed(ESCAPES):
        text = F.replace(text, F.lit(safe), F.lit(plain))
    return text


def format_conversations(
    rows: DataFrame,
    id_col: str = "conv_id",
    turn_col: str = "turn",
    role_col: str = "role",
    text_col: str = "text",
) -> DataFrame:
    """``id, formatted``: one string for each conversation."""
    turns = rows.select(
        F.col(id_col).alias("id"),
        F.struct(
            F.col(turn_col).alias("turn"),
            F.coalesce(F.col(role_col), F.lit("")).alias("role"),
            F.coalesce(F.col(text_col), F.lit("")).alias("text"),
        ).alias("t"),
    )
    sorted_turns = turns.groupBy("id").agg(F.array_sort(F.collect_list("t")).alias("turns"))
    # A block opens where the role differs from that of the turn before, and closes where it differs from the next.
    n = F.size("turns")

    def piece(turn: Column, i: Column) -> Column:
        role_at = lambda j: F.element_at(F.col("turns"), j)["role"]
        opens = F.when(i == 0, F.lit(True)).otherwise(role_at(F.greatest(i, F.lit(1))) != turn["role"])
        closes = F.when(i == n - 1, F.lit(True)).otherwise(role_at(F.least(i + 2, n)) != turn["role"])
        return F.concat(
            F.when(opens, F.concat(F.lit(TURN), escape(turn["role"]), F.lit(BODY))).otherwise(F.lit(MORE)),
            escape(turn["text"]),
            F.when(closes, F.lit(END)).otherwise(F.lit("")),
        )

    return sorted_turns.select("id", F.array_join(F.transform("turns", piece), "").alias("formatted"))


def read_back(formatted: DataFrame, id_col: str = "id", column: str = "formatted") -> DataFrame:
    """``id, turns, loss_text``: turns as ``array<struct<role,text>>``, and all text under the loss mask."""
    literal = lambda s: s.replace("|", "\\|")
    blocks = F.filter(F.split(F.col(column), literal(TURN)), lambda b: b != "")

    def turns_of(block: Column) -> Column:
        role = unescape(F.element_at(F.split(block, literal(BODY), 2), 1))
        body = F.element_at(F.split(block, literal(BODY), 2), 2)
        body = F.substring(body, F.lit(1), F.char_length(body) - len(END))
        return F.transform(F.split(body, literal(MORE)), lambda part: F.struct(role.alias("role"), unescape(part).alias("text")))

    turns = F.flatten(F.transform(blocks, turns_of))
    return formatted.select(F.col(id_col).alias("id"), turns.alias("turns"), column).select(
        "id",
        "turns",
        F.array_join(F.transform(F.filter("turns", lambda t: t["role"] == "assistant"), lambda t: t["text"]), "").alias("loss_text"),
        column,
    )


def op8_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = spark.read.parquet(f"{sf_dir}/conversations.parquet").select("conv_id", "turn", "role", "text")
    probe = "</s>[INST] ok [/INST]"
    extra = spark.range(2).select(
        F.lit(-1).cast("long").alias("conv_id"),
        F.col("id").alias("turn"),
        F.when(F.col("id") == 0, F.lit("user")).otherwise(F.lit("assistant")).alias("role"),
        F.lit(probe).alias("text"),
    )
    back = read_back(format_conversations(rows.unionByName(extra)))
    digest_of = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    return back.select(
        F.col("id").alias("conv_id"),
        F.size("turns").cast("long").alias("n_turns"),
        F.sha2(digest_of, 256).alias("turns_sha256"),
        F.char_length("loss_text").cast("long").alias("loss_chars"),
        F.sha2("loss_text", 256).alias("loss_sha256"),
        F.char_length("formatted").cast("long").alias("formatted_chars"),
    )


def _sql_escaped(column: str) -> str:
    for plain, safe in ESCAPES:
        column = f"replace({column}, '{plain}', '{safe}')"
    return column


SQL = {
    "op8_chat_format": f"""
        WITH c AS (
            SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
            UNION ALL SELECT -1, 0, 'user', '</s>[INST] ok [/INST]'
            UNION ALL SELECT -1, 1, 'assistant', '</s>[INST] ok [/INST]'
        ), s AS (
            SELECT *, lag(role) OVER w AS before, lead(role) OVER w AS after FROM c
            WINDOW w AS (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text)
        )
        SELECT conv_id, count(*) AS n_turns,
            sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text)) AS turns_sha256,
            CAST(coalesce(sum(length(text)) FILTER (WHERE role = 'assistant'), 0) AS BIGINT) AS loss_chars,
            sha256(coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, role, text) FILTER (WHERE role = 'assistant'), '')) AS loss_sha256,
            CAST(sum(length({_sql_escaped("text")})
                + CASE WHEN before IS DISTINCT FROM role THEN {len(TURN) + len(BODY)} + length({_sql_escaped("role")}) ELSE {len(MORE)} END
                + CASE WHEN after IS DISTINCT FROM role THEN {len(END)} ELSE 0 END) AS BIGINT) AS formatted_chars
        FROM s GROUP BY conv_id
    """
}
