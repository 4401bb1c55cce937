"""Preference formatting: chosen and rejected conversations with their shared prompt, in
DataFrame functions only.

Two conversations that open with the same turn are alternatives; the one with more assistant text
is the chosen one (at a tie, the one with the smaller conv_id). The longest common turn prefix of
a pair is rendered once as the prompt; what follows is rendered as the two completions. A mask
gives each completion as runs `flag:length` in code points: 1 for what is trained on, the texts
and end marks of assistant turns, 0 for all else. A conversation without a partner is returned
with a null rejected side; its prompt ends before its last assistant turn.

With `derive`, a conversation without a partner that has an assistant turn is paired with a
rejected alternative: itself with the text of its last assistant turn taken from another
conversation, its donor (rejected_id, `derived` is true). Donors are dealt in rings of about
`RING` conversations, chosen by a hash of conv_id: each of a ring's different last answers is
answered by the next one. In a ring with one answer only, the rejected side stays null.

Partners are found within salts of an opening turn first and then among those left over, one at
most of each salt, so an opening that a third of all conversations share is not numbered in one
task. There are as many salts as the root of the number of conversations, `SALTS` at least.

Edge cases: turns are ordered by number, role and text, null numbers first; equal rows of a
conversation count once; rows without a conv_id belong to no conversation and are left out; a
null role is rendered as `unknown`, a null text as empty; `<|` in a text is rendered as `< |`; if
one conversation is a prefix of the other, its completion is empty; an empty table gives no rows;
other columns are ignored.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemart.llm.common import stored

SALTS = 64
RING = 1000
OPEN, CLOSE = "<|im_start|>", "<|im_end|>\n"


def conversations(turns: DataFrame) -> DataFrame:
    """conv_id, turns (ordered array of role and text), role, text (of the first), weight."""
    def plain(name: str) -> Column:
        return F.replace(F.col(name).cast("string"), F.lit("<|"), F.lit("< |"))

    rows = turns.where("conv_id is not null").select(
        "conv_id", F.col("turn").alias("at"),
        F.coalesce(plain("role"), F.lit("unknown")).alias("role"),
        F.coalesce(plain("text"), F.lit("")).alias("text"))
    held = rows.groupBy("conv_id").agg(
        F.array_sort(F.collect_set(F.struct("at", "role", "text"))).alias("t"))
    ordered = held.select("conv_id", F.transform("t", lambda x: F.struct(
        x["role"].alias("role"), x["text"].alias("text"))).alias("turns"))
    weight = F.aggregate("turns", F.lit(0).cast("long"), lambda s, x: s + F.when(
        x["role"] == "assistant", F.length(x["text"])).otherwise(0))
    return ordered.select("*", F.get("turns", F.lit(0))["role"].alias("role"),
                          F.get("turns", F.lit(0))["text"].alias("text"),
                          weight.alias("weight"))


def pairs(held: DataFrame) -> DataFrame:
    """chosen_id and rejected_id; rejected_id is null for a conversation without a partner."""
    salts = max(SALTS, math.ceil(math.sqrt(held.count())))
    keys = held.select("conv_id", "role", "text", "weight",
                       F.pmod(F.xxhash64("conv_id") if held.schema["conv_id"].dataType.typeName()
                              == "string" else F.col("conv_id"), F.lit(salts)).alias("salt"))
    mate = F.struct(F.col("conv_id").alias("id"), "weight")

    def numbered(rows: DataFrame, *by: str) -> DataFrame:
        order = Window.partitionBy("role", "text", *by).orderBy("conv_id")
        return rows.select("*", F.row_number().over(order).alias("r"),
                           F.lead(mate).over(order).alias("mate")).where("r % 2 = 1")

    first = stored(numbered(keys, "salt"), "mates")
    second = numbered(first.where("mate is null").drop("r", "mate"))
    both = first.where("mate is not null").drop("salt", "r").unionByName(
        second.drop("salt", "r"))
    better = F.col("mate").isNull() | (F.col("weight") >= F.col("mate.weight"))
    return both.select(
        F.when(better, F.col("conv_id")).otherwise(F.col("mate.id")).alias("chosen_id"),
        F.when(better, F.col("mate.id")).otherwise(F.col("conv_id")).alias("rejected_id"))


def last_answer(turns: Column) -> Column:
    """Place of the last assistant turn from 0, null without one."""
    return F.array_max(F.filter(F.sequence(F.lit(0), F.size(turns) - 1),
                                lambda i: F.get(turns, i)["role"] == "assistant"))


def donors(held: DataFrame) -> DataFrame:
    """chosen_id and donor: the first conversation of the ring that gives its next answer."""
    answer = F.get("turns", last_answer(F.col("turns")))["text"]
    answered = held.select("conv_id", F.md5(answer.cast("binary")).alias("answer")).where(
        "answer is not null")
    rings = answered.count() // RING + 1
    code = F.conv(F.substring(F.md5(F.col("conv_id").cast("string").cast("binary")), 1, 8), 16, 10)
    ringed = answered.withColumn("ring", code.cast("long") % rings)
    ring = Window.partitionBy("ring").orderBy("first")
    whole = ring.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    dealt = ringed.groupBy("ring", "answer").agg(F.min("conv_id").alias("first")).select(
        "ring", "answer", "first",
        F.coalesce(F.lead("first").over(ring), F.first("first").over(whole)).alias("donor"))
    return ringed.join(dealt.where("donor <> first"), ["ring", "answer"]).select(
        F.col("conv_id").alias("chosen_id"), "donor")


def render(turns: Column) -> Column:
    return F.array_join(F.transform(turns, lambda t: F.concat(
        F.lit(OPEN), t["role"], F.lit("\n"), t["text"], F.lit(CLOSE))), "")


def mask(turns: Column) -> Column:
    """`flag:length` runs of the rendered turns."""
    return F.array_join(F.transform(turns, lambda t: F.concat(
        F.lit("0:"), (F.length(t["role"]) + len(OPEN) + 1).cast("string"),
        F.when(t["role"] == "assistant", F.lit(",1:")).otherwise(F.lit(",0:")),
        (F.length(t["text"]) + len(CLOSE)).cast("string"))), ",")


def rest(turns: Column, after: Column) -> Column:
    return F.slice(turns, after + 1, F.greatest(F.lit(0), F.size(turns) - after))


def preference_pairs(turns: DataFrame, derive: bool = False) -> DataFrame:
    """chosen_id, rejected_id, derived, n_common, prompt, chosen, chosen_mask, rejected,
    rejected_mask."""
    held = stored(conversations(turns), "conversations")
    left = held.select(F.col("conv_id").alias("chosen_id"), F.col("turns").alias("c"))
    right = held.select(F.col("conv_id").alias("rejected_id"), F.col("turns").alias("d"))
    matched = pairs(held).withColumn("derived", F.lit(False))
    if derive:
        matched = matched.join(donors(held), "chosen_id", "left").select(
            "chosen_id", F.coalesce("rejected_id", "donor").alias("rejected_id"),
            F.expr("rejected_id is null and donor is not null").alias("derived"))
    met = matched.join(left, "chosen_id").join(right, "rejected_id", "left").select(
        "*", last_answer(F.col("c")).alias("at"))
    given = F.get("d", last_answer(F.col("d")))["text"]
    met = met.withColumn("x", F.when(F.col("derived"), F.transform(
        "c", lambda t, i: F.when(i == F.col("at"), F.struct(
            t["role"].alias("role"), given.alias("text"))).otherwise(t))).otherwise(F.col("d")))
    shorter = F.least(F.size("c"), F.size("x"))
    apart = F.filter(F.sequence(F.lit(0), shorter - 1),
                     lambda i: F.get("c", i) != F.get("x", i))
    common = F.when(F.col("x").isNull(), F.coalesce(F.col("at"), F.size("c"))).otherwise(
        F.coalesce(F.array_min(apart), shorter))
    cut = met.select("*", common.alias("n_common"))
    n = F.col("n_common")
    return cut.select(
        "chosen_id", "rejected_id", "derived", n.cast("long").alias("n_common"),
        render(F.slice("c", F.lit(1), n)).alias("prompt"),
        render(rest(F.col("c"), n)).alias("chosen"),
        mask(rest(F.col("c"), n)).alias("chosen_mask"),
        render(rest(F.col("x"), n)).alias("rejected"),
        mask(rest(F.col("x"), n)).alias("rejected_mask"))


# The same rows in DuckDB, with derived alternatives.
SQL = """
with rows as (
  select distinct conv_id, turn as place, coalesce(replace(role, '<|', '< |'), 'unknown') as role,
    coalesce(replace(text, '<|', '< |'), '') as text
  from conversations where conv_id is not null),
held as (
  select conv_id, list({'role': role, 'text': text} order by place nulls first, role, text) as turns,
    sum(case when role = 'assistant' then length(text) else 0 end) as weight
  from rows group by conv_id),
salted as (
  select *, ((conv_id % salts) + salts) % salts as salt from held, (
    select greatest(64, cast(ceil(sqrt(count(*))) as bigint)) as salts from held)),
numbered as (
  select *, row_number() over w as r,
    lead(conv_id) over w as mate, lead(weight) over w as mate_weight
  from salted window w as (partition by turns[1].role, turns[1].text, salt order by conv_id)),
firsts as (select * from numbered where r % 2 = 1),
again as (
  select conv_id, weight, row_number() over w as r, lead(conv_id) over w as mate,
    lead(weight) over w as mate_weight
  from firsts where mate is null
  window w as (partition by turns[1].role, turns[1].text order by conv_id)),
mates as (
  select conv_id, weight, mate, mate_weight from firsts where mate is not null
  union all select conv_id, weight, mate, mate_weight from again where r % 2 = 1),
pairs as (
  select case when mate is null or weight >= mate_weight then conv_id else mate end as chosen_id,
    case when mate is null or weight >= mate_weight then mate else conv_id end as rejected_id
  from mates),
answered as (
  select conv_id, turns, list_max(list_filter(range(len(turns)),
    lambda i: turns[i + 1].role = 'assistant')) + 1 as place
  from held where list_contains(list_transform(turns, lambda t: t.role), 'assistant')),
ringed as (
  select *, cast('0x' || substr(md5(cast(conv_id as varchar)), 1, 8) as bigint) % rings as ring
  from answered, (select count(*) // 1000 + 1 as rings from answered)),
answers as (
  select ring, turns[place].text as own, min(conv_id) as head from ringed group by all),
dealt as (
  select ring, own, head, coalesce(lead(own) over w, first_value(own) over w) as given,
    coalesce(lead(head) over w, first_value(head) over w) as donor
  from answers window w as (partition by ring order by head)),
donors as (
  select r.conv_id, r.place, a.given, a.donor
  from ringed r join dealt a on a.ring = r.ring and a.own = r.turns[r.place].text
  where a.donor <> a.head),
met as (
  select p.chosen_id, c.turns as c, coalesce(p.rejected_id, d.donor) as rejected_id,
    p.rejected_id is null and d.donor is not null as derived,
    case when d.donor is null or p.rejected_id is not null then x.turns
      else list_transform(c.turns, lambda t, i: case when i = d.place
        then {'role': t.role, 'text': d.given} else t end) end as x
  from pairs p join held c on c.conv_id = p.chosen_id
  left join held x on x.conv_id = p.rejected_id
  left join donors d on d.conv_id = p.chosen_id),
cut as (
  select *, case when x is null then coalesce(
      list_max(list_filter(range(len(c)), lambda i: c[i + 1].role = 'assistant')), len(c))
    else coalesce(list_min(list_filter(range(least(len(c), len(x))),
      lambda i: c[i + 1].role <> x[i + 1].role or c[i + 1].text <> x[i + 1].text)),
      least(len(c), len(x))) end as n from met),
sides as (
  select chosen_id, rejected_id, derived, n, c[1:n] as p, c[n + 1:] as c, x[n + 1:] as x from cut)
select chosen_id, rejected_id, derived, cast(n as bigint) as n_common,
  RENDER(p) as prompt, RENDER(c) as chosen, MASK(c) as chosen_mask,
  case when x is null then null else RENDER(x) end as rejected,
  case when x is null then null else MASK(x) end as rejected_mask
from sides"""


def _spelled(sql: str) -> str:
    for side in "pcx":
        sql = sql.replace(f"RENDER({side})", f"""coalesce(array_to_string(list_transform({side},
          lambda t: '{OPEN}' || t.role || chr(10) || t.text || '<|im_end|>' || chr(10)), ''), '')""")
        sql = sql.replace(f"MASK({side})", f"""coalesce(array_to_string(list_transform({side},
          lambda t: '0:' || (length(t.role) + {len(OPEN) + 1}) ||
          case when t.role = 'assistant' then ',1:' else ',0:' end ||
          (length(t.text) + {len(CLOSE)})), ','), '')""")
    return sql


SQL = _spelled(SQL)
