"""Preference formatting: two conversations become one prompt and two masked completions, in DataFrame operations only.

The longest common prefix of turns (equal role and text) is rendered once, as the prompt; what follows
in each conversation is its completion. A completion comes with the character ranges that training may
learn from: the texts of assistant turns with their end marks. Marks are broken up inside texts, so a
text cannot forge a turn.

A plain table of conversations holds no preferences; two rules make pairs of all of it:

- ``opening``: a conversation and the one with the next higher id that opens with the same turn;
- ``swapped``: a conversation up to its last answer, against the same one with that answer replaced by
  the last answer of the conversation with the next higher id.

Neighbouring ids are found within range partitions first and then between them, over the first id of
each partition: an opening shared by most conversations is no single task, and what meets in one window
is bounded by the number of partitions, dense or sparse as the ids may be. Conversations are put together
once and stored, as both rules and both sides of a pair read them.

Defined results: rows without a conv_id belong to no conversation. Rows of a conversation that repeat
each other count once; turns are ordered by turn (NULL last), then role and text. NULL text is empty
and a NULL role is ``unknown``. A conversation without a later neighbour begins no pair. Where a
conversation continues the other or equals it, one or both completions are empty; ``usable`` tells
whether both hold something to learn from. Other columns are ignored.
"""

from pyspark.sql import Column, DataFrame, Window, functions as F

from .frames import stored

ASSISTANT = "assistant"
OPEN, CLOSE, END = "<|", "|>\n", "<|end|>\n"


def conversations(turns: DataFrame) -> DataFrame:
    """conv_id and its turns in order, as array<struct<role, text>>."""
    turn = F.struct(
        F.col("turn").isNull().alias("unknown"), "turn",
        F.coalesce("role", F.lit("unknown")).alias("role"), F.coalesce("text", F.lit("")).alias("text"),
    )
    ordered = F.array_sort(F.collect_set(turn))
    kept = F.transform(ordered, lambda t: F.struct(t["role"].alias("role"), t["text"].alias("text")))
    return turns.where("conv_id is not null").groupBy("conv_id").agg(kept.alias("turns"))


def next_ids(ids: DataFrame, key: list[str]) -> DataFrame:
    """id and next_id: the next higher id with equal ``key`` columns; ids, each given once, without one are left out."""
    # Stored, as a partition read again after a loss must hold the same ids.
    placed = stored(ids.repartitionByRange(*key, "id").withColumn("block", F.spark_partition_id()), "neighbours")
    inside = F.lead("id").over(Window.partitionBy(*key, "block").orderBy("id"))
    found = placed.withColumn("next_id", inside)
    # The last id of a block has no neighbour in it. At most one row per block and key goes on from here.
    heads = placed.groupBy(*key, "block").agg(F.min("id").alias("head"), F.max("id").alias("id"))
    order = Window.partitionBy(*key) if key else Window.partitionBy(F.lit(0))
    between = heads.select("id", F.lead("head").over(order.orderBy("block")).alias("next_id"))
    return found.select("id", "next_id").union(between).where("next_id is not null")


def same_opening(talks: DataFrame) -> DataFrame:
    """Pairs of whole conversations with equal first turns."""
    first = F.element_at("turns", 1)
    opening = F.sha2(F.concat_ws("\x00", first["role"], first["text"]), 256)
    pairs = next_ids(talks.select(opening.alias("opening"), F.col("conv_id").alias("id")), ["opening"])
    chosen = talks.select(F.col("conv_id").alias("id"), F.col("turns").alias("chosen_turns"))
    rejected = talks.select(F.col("conv_id").alias("next_id"), F.col("turns").alias("rejected_turns"))
    found = pairs.join(chosen, "id").join(rejected, "next_id")
    return found.select(
        F.lit("opening").alias("pairing"), F.col("id").alias("chosen_id"), F.col("next_id").alias("rejected_id"),
        "chosen_turns", "rejected_turns",
    )


def swapped_answers(talks: DataFrame) -> DataFrame:
    """Pairs of a conversation up to its last answer and the same with the next conversation's last answer."""
    last = F.array_max(F.filter(F.transform("turns", lambda t, i: F.when(t["role"] == ASSISTANT, i + 1)), lambda i: i.isNotNull()))
    answered = talks.withColumn("last", last).where("last is not null")
    pairs = next_ids(answered.select(F.col("conv_id").alias("id")), [])
    answers = answered.select(F.col("conv_id").alias("next_id"), F.element_at("turns", F.col("last")).alias("answer"))
    found = answered.withColumnRenamed("conv_id", "id").join(pairs, "id").join(answers, "next_id")
    return found.select(
        F.lit("swapped").alias("pairing"), F.col("id").alias("chosen_id"), F.col("next_id").alias("rejected_id"),
        F.slice("turns", F.lit(1), F.col("last")).alias("chosen_turns"),
        F.concat(F.slice("turns", F.lit(1), F.col("last") - 1), F.array("answer")).alias("rejected_turns"),
    )


def _safe(text: Column) -> Column:
    return F.replace(text, F.lit(OPEN), F.lit("< |"))


def _rendered(turn: Column) -> Column:
    return F.concat(F.lit(OPEN), _safe(turn["role"]), F.lit(CLOSE), _safe(turn["text"]), F.lit(END))


def rendered(turns: Column) -> Column:
    """Turns as text."""
    return F.array_join(F.transform(turns, _rendered), "")


def learned_ranges(turns: Column) -> Column:
    """Character ranges (begin, end) of the rendered turns that training may learn from."""
    ranges = "array<struct<begin:int,end:int>>"
    start = F.struct(F.lit(0).alias("at"), F.array().cast(ranges).alias("ranges"))

    def step(state, turn):
        begin = state["at"] + F.length(_safe(turn["role"])) + len(OPEN) + len(CLOSE)
        end = begin + F.length(_safe(turn["text"])) + len(END)
        own = F.array(F.struct(begin.alias("begin"), end.alias("end")))
        return F.struct(
            end.alias("at"),
            F.when(turn["role"] == ASSISTANT, F.concat(state["ranges"], own)).otherwise(state["ranges"]).alias("ranges"),
        )

    return F.aggregate(turns, start, step, lambda state: state["ranges"])


def formatted(pairs: DataFrame) -> DataFrame:
    """n_shared, prompt, both completions with their ranges and usable for pairs of chosen_turns and rejected_turns."""
    def same(turn, i):
        other = F.get("rejected_turns", i)
        return turn["role"].eqNullSafe(other["role"]) & turn["text"].eqNullSafe(other["text"])

    differs = F.array_position(F.transform("chosen_turns", same), False)
    both = pairs.withColumn("n_shared", F.when(differs > 0, differs - 1).otherwise(F.size("chosen_turns")).cast("int"))

    def rest(name):
        return F.slice(name, F.col("n_shared") + 1, F.size(name))

    keys = [c for c in pairs.columns if c not in ("chosen_turns", "rejected_turns")]
    out = both.select(
        *keys, "n_shared", rendered(F.slice("chosen_turns", F.lit(1), F.col("n_shared"))).alias("prompt"),
        rendered(rest("chosen_turns")).alias("chosen"), learned_ranges(rest("chosen_turns")).alias("chosen_ranges"),
        rendered(rest("rejected_turns")).alias("rejected"), learned_ranges(rest("rejected_turns")).alias("rejected_ranges"),
    )
    return out.withColumn("usable", (F.size("chosen_ranges") > 0) & (F.size("rejected_ranges") > 0))


def preference_table(turns: DataFrame) -> DataFrame:
    """The formatted pairs of a conversations table, ranges as text ``begin-end,begin-end``."""
    talks = stored(conversations(turns.select("conv_id", "turn", "role", "text")), "conversations")
    found = formatted(same_opening(talks).union(swapped_answers(talks)))

    def as_text(ranges):
        return F.array_join(F.transform(ranges, lambda r: F.concat_ws("-", r["begin"].cast("string"), r["end"].cast("string"))), ",")

    return found.withColumn("chosen_ranges", as_text("chosen_ranges")).withColumn("rejected_ranges", as_text("rejected_ranges"))


_KEY = "pairing, chosen_id, rejected_id"


def _side(name: str) -> str:
    return f"""
{name}_at AS (
  SELECT s.*, length(safe_role) + {len(OPEN) + len(CLOSE)} AS head, length(safe_text) + {len(END)} AS body,
    sum(length(safe_role) + length(safe_text) + {len(OPEN) + len(CLOSE) + len(END)})
      OVER (PARTITION BY {_KEY} ORDER BY pos) - length(safe_text) - {len(END)} AS start
  FROM {name}_turn s JOIN shared USING ({_KEY}) WHERE pos > n_shared
), {name}_side AS (
  SELECT {_KEY}, string_agg('{OPEN}' || safe_role || '|>' || chr(10) || safe_text || '<|end|>' || chr(10), '' ORDER BY pos) AS {name},
    coalesce(string_agg(CAST(start AS BIGINT) || '-' || CAST(start + body AS BIGINT), ',' ORDER BY pos)
      FILTER (role = '{ASSISTANT}'), '') AS {name}_ranges
  FROM {name}_at GROUP BY {_KEY}
)"""


# Counterpart of ``preference_table`` in DuckDB's SQL.
SQL = f"""
WITH distinct_turn AS (
  SELECT DISTINCT conv_id, turn, coalesce(role, 'unknown') AS role, coalesce(text, '') AS text
  FROM conversations WHERE conv_id IS NOT NULL
), turn AS (
  SELECT *, replace(role, '{OPEN}', '< |') AS safe_role, replace(text, '{OPEN}', '< |') AS safe_text,
    row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS LAST, role, text) AS pos FROM distinct_turn
), answer AS (
  SELECT conv_id, max(pos) AS last, arg_max(text, pos) AS text, arg_max(safe_text, pos) AS safe_text
  FROM turn WHERE role = '{ASSISTANT}' GROUP BY conv_id
), pair AS (
  SELECT * FROM (
    SELECT 'opening' AS pairing, conv_id AS chosen_id, lead(conv_id) OVER (PARTITION BY role, text ORDER BY conv_id) AS rejected_id
    FROM turn WHERE pos = 1
    UNION ALL SELECT 'swapped', conv_id, lead(conv_id) OVER (ORDER BY conv_id) FROM answer
  ) WHERE rejected_id IS NOT NULL
), chosen_turn AS (
  SELECT pair.*, pos, role, t.text, safe_role, t.safe_text FROM pair JOIN turn t ON t.conv_id = chosen_id
  LEFT JOIN answer a ON a.conv_id = chosen_id WHERE pairing = 'opening' OR pos <= last
), rejected_turn AS (
  SELECT pair.*, pos, role, text, safe_role, safe_text FROM pair JOIN turn ON conv_id = rejected_id WHERE pairing = 'opening'
  UNION ALL SELECT pair.*, pos, role, t.text, safe_role, t.safe_text FROM pair JOIN turn t ON t.conv_id = chosen_id
    JOIN answer a ON a.conv_id = chosen_id WHERE pairing = 'swapped' AND pos < last
  UNION ALL SELECT pair.*, own.last, '{ASSISTANT}', other.text, '{ASSISTANT}', other.safe_text
    FROM pair JOIN answer own ON own.conv_id = chosen_id JOIN answer other ON other.conv_id = rejected_id WHERE pairing = 'swapped'
), compared AS (
  SELECT a.pairing, a.chosen_id, a.rejected_id, a.pos, b.pos IS NOT NULL AND a.role = b.role AND a.text = b.text AS same
  FROM chosen_turn a LEFT JOIN rejected_turn b
  ON a.pairing = b.pairing AND a.chosen_id = b.chosen_id AND a.rejected_id = b.rejected_id AND a.pos = b.pos
), shared AS (
  SELECT {_KEY}, CAST(coalesce(min(pos) FILTER (NOT same) - 1, count(*)) AS INTEGER) AS n_shared FROM compared GROUP BY {_KEY}
), prompts AS (
  SELECT {_KEY}, string_agg('{OPEN}' || safe_role || '|>' || chr(10) || safe_text || '<|end|>' || chr(10), '' ORDER BY pos) AS prompt
  FROM shared JOIN chosen_turn USING ({_KEY}) WHERE pos <= n_shared GROUP BY {_KEY}
), {_side("chosen").strip()}, {_side("rejected").strip()}
SELECT {_KEY}, n_shared, coalesce(prompt, '') AS prompt, coalesce(chosen, '') AS chosen,
  coalesce(chosen_ranges, '') AS chosen_ranges, coalesce(rejected, '') AS rejected,
  coalesce(rejected_ranges, '') AS rejected_ranges,
  coalesce(chosen_ranges, '') <> '' AND coalesce(rejected_ranges, '') <> '' AS usable
FROM shared LEFT JOIN prompts USING ({_KEY}) LEFT JOIN chosen_side USING ({_KEY}) LEFT JOIN rejected_side USING ({_KEY})
"""
