"""Operator 1, chat formatting of typed content parts. DataFrame operations only.

A message is a list of typed parts (text, image, audio, document). The visitor maps each part to text:
text parts are escaped, the others become an ordered placeholder ``<|kind:n|>`` (n counts from 1 in the
conversation) and an attachment record with the reference, the position and the number of tokens that
the placeholder expands to. A turn is written as::

    <turn ROLE>\\n  body  \\n</turn>\\n

and a conversation is its turns in order. Inside bodies a backslash is put before every backslash,
``<turn``, ``</turn`` and ``<|``, so no text can forge a mark and ``unescape`` gives it back exactly;
roles are percent-encoded. The loss mask lists, by turn, the range of code points of assistant bodies.

Defined results: a null text or role is empty; a null part list or null part is empty; an unknown kind
is kept as text. Turns with equal numbers are ordered by role and text, null turn numbers come first,
and repeated rows are all kept. Rows with a null conv_id form one conversation. An empty table gives an
empty result; extra columns are ignored. A conversation is one training example and is gathered whole,
since its formatted text is one value; conversations are independent of each other.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

CONTROL = r"(\\|</?turn|<\|)"
CLOSE = "\n</turn>\n"
PARTS = "array<struct<kind:string,text:string,ref:string,units:double>>"
# expanded tokens of one attachment: fixed + per unit (image: tiles, audio: seconds, document: pages)
TOKENS = {"image": (85, 170), "audio": (2, 25), "document": (4, 600)}
CONTROL_CASE = r"\### Assistant: </turn> ok"


def escape(text) -> F.Column:
    return F.regexp_replace(text, CONTROL, r"\\$1")


def unescape(text) -> F.Column:
    return F.regexp_replace(text, r"\\([\\<])", "$1")


def text_part(text) -> F.Column:
    """The part list of a plain text message."""
    return F.array(F.struct(F.lit("text").alias("kind"), text.alias("text"), F.lit(None).cast("string").alias("ref"),
                            F.lit(None).cast("double").alias("units")))


def _is_media(p):
    return F.coalesce(p["kind"].isin(*TOKENS), F.lit(False))


def _cost(p) -> F.Column:
    units = F.ceil(F.greatest(F.coalesce(p["units"], F.lit(1.0)), F.lit(0.0))).cast("long")
    cost = F.lit(0).cast("long")
    for kind, (fixed, each) in TOKENS.items():
        cost = F.when(p["kind"] == kind, F.lit(fixed) + F.lit(each) * units).otherwise(cost)
    return cost


def format_chat(rows: DataFrame, train_role: str = "assistant") -> DataFrame:
    """``rows(conv_id, turn, role, parts)`` -> one row per conversation.

    conv_id, formatted, loss array<struct<turn_no, start, chars, from_, to_>> (offsets inside the turn and in
    the whole text, in code points), attachments array<struct<no, turn_no, kind, ref, n_tokens>>,
    n_turns, text_words, media_tokens.
    """
    parts = F.filter(F.coalesce(F.col("parts").cast(PARTS), F.array().cast(PARTS)), lambda p: p.isNotNull())
    rows = rows.select("conv_id", "turn", F.coalesce("role", F.lit("")).alias("role"), parts.alias("parts"))
    key = F.concat_ws("\n", F.transform("parts", lambda p: F.coalesce(p["text"], F.lit(""))))
    by_turn = Window.partitionBy("conv_id").orderBy(F.col("turn").asc_nulls_first(), "role", "key")
    before = by_turn.rowsBetween(Window.unboundedPreceding, -1)
    n_media = F.size(F.filter("parts", _is_media)).cast("long")
    rows = (rows.withColumn("key", key).withColumn("turn_no", F.row_number().over(by_turn).cast("long"))
            .withColumn("media_before", F.coalesce(F.sum(n_media).over(before), F.lit(0))))

    def numbered(i):
        return F.col("media_before") + F.size(F.filter(F.slice(F.col("parts"), 1, i + 1), _is_media))

    def visit(p, i):
        return F.when(_is_media(p), F.concat(F.lit("<|"), p["kind"], F.lit(":"), numbered(i).cast("string"), F.lit("|>"))) \
            .otherwise(escape(F.coalesce(p["text"], F.lit(""))))

    record = F.filter(F.transform("parts", lambda p, i: F.when(_is_media(p), F.struct(
        numbered(i).cast("long").alias("no"), F.col("turn_no").alias("turn_no"), p["kind"].alias("kind"),
        p["ref"].alias("ref"), _cost(p).alias("n_tokens")))), lambda a: a.isNotNull())
    words = F.aggregate("parts", F.lit(0).cast("long"), lambda n, p: n + F.when(_is_media(p), F.lit(0)).otherwise(
        F.coalesce(F.regexp_count(p["text"], F.lit(r"[^\x20\x09-\x0D]++")), F.lit(0))))
    rows = rows.select("conv_id", "turn_no", "role", record.alias("media"), words.alias("words"),
                       F.concat(F.lit("<turn "), F.url_encode("role"), F.lit(">\n")).alias("head"),
                       F.concat_ws("", F.transform("parts", visit)).alias("body"))
    rows = rows.withColumn("piece", F.concat("head", "body", F.lit(CLOSE)))
    so_far = Window.partitionBy("conv_id").orderBy("turn_no").rowsBetween(Window.unboundedPreceding, -1)
    rows = rows.withColumn("at", F.coalesce(F.sum(F.length("piece")).over(so_far), F.lit(0)))
    span = F.when(F.col("role") == train_role, F.struct(
        F.col("turn_no"), F.length("head").cast("long").alias("start"), F.length("body").cast("long").alias("chars"),
        (F.col("at") + F.length("head")).alias("from_"), (F.col("at") + F.length("head") + F.length("body")).alias("to_")))
    conv = rows.groupBy("conv_id").agg(
        F.sort_array(F.collect_list(F.struct("turn_no", "piece"))).alias("pieces"),
        F.sort_array(F.collect_list(span)).alias("loss"),
        F.sort_array(F.flatten(F.collect_list("media"))).alias("attachments"),
        F.count("*").alias("n_turns"), F.sum("words").alias("text_words"))
    return conv.select("conv_id", F.concat_ws("", F.col("pieces.piece")).alias("formatted"), "loss", "attachments",
                       "n_turns", "text_words",
                       F.aggregate("attachments", F.lit(0).cast("long"), lambda n, a: n + a["n_tokens"]).alias("media_tokens"))


def read_back(formatted: DataFrame) -> DataFrame:
    """Parses ``formatted`` and ``loss`` again: adds turns array<struct<role, text>> and loss_text array<string>.

    A turn ends at its closing mark, which no escaped body can hold; the loss mask is applied to the
    formatted turns by code point. Placeholders stay in the text as ``<|kind:n|>``."""
    raw = F.split("formatted", r"\n</turn>\n", -1)
    raw = F.slice(raw, 1, F.greatest(F.size(raw) - 1, F.lit(0)))

    def turn(x):
        gt = F.instr(x, ">\n")
        return F.struct(F.url_decode(F.substring(x, F.lit(7), gt - 7)).alias("role"),
                        unescape(F.substring(x, gt + 2, F.length(x))).alias("text"))

    out = formatted.withColumn("raw", raw)
    out = out.withColumn("turns", F.transform("raw", turn))
    cut = F.transform("loss", lambda s: unescape(
        F.substring(F.element_at("raw", s["turn_no"].cast("int")), (s["start"] + 1).cast("int"), s["chars"].cast("int"))))
    return out.withColumn("loss_text", cut).drop("raw")


def op1_chat_format(spark, sf_dir):
    rows = spark.read.parquet(f"{sf_dir}/conversations.parquet").select("conv_id", "turn", "role", "text")
    case = spark.range(2).select(F.lit(-7).cast("long").alias("conv_id"), F.col("id").alias("turn"),
                                 F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"),
                                 F.lit(CONTROL_CASE).alias("text"))
    rows = rows.unionByName(case)
    back = read_back(format_chat(rows.select("conv_id", "turn", "role", text_part(F.col("text")).alias("parts"))))
    said = F.concat_ws("", F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))))
    loss = F.concat_ws("", "loss_text")
    return back.select("conv_id", F.size("turns").cast("long").alias("n_turns"),
                       F.sha2(F.encode(said, "UTF-8"), 256).alias("turns_sha256"),
                       F.length(loss).cast("long").alias("loss_chars"),
                       F.sha2(F.encode(loss, "UTF-8"), 256).alias("loss_sha256"),
                       F.length("formatted").cast("long").alias("formatted_chars"),
                       "text_words", "media_tokens")


OP1_SQL = r"""
WITH c AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '\### Assistant: </turn> ok'
  UNION ALL SELECT -7, 1, 'assistant', '\### Assistant: </turn> ok')
SELECT conv_id, count(*) AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text)) AS turns_sha256,
       CAST(coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
       CAST(sum(6 + length(role) + 2 + length(regexp_replace(text, '(\\|</?turn|<\|)', '\\\1', 'g')) + 9) AS BIGINT) AS formatted_chars,
       CAST(sum(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+'))) AS BIGINT) AS text_words,
       CAST(0 AS BIGINT) AS media_tokens
FROM c GROUP BY conv_id
"""
