"""The registered queries of the subpackage and their DuckDB equivalents, where SQL can express one."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from spendwatch.llm import (chat, descent, divergence, forest, interpolation, langid, lexicon, linedup, neardup, negatives, packing,
                            parsing, wrappers)
from spendwatch.llm.common import fold, table

TOKENIZER = public_tokenizers.path("word_bpe_49k.json")


def op1_prefix_forest(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "embeddings")
    return forest.search(rows, rows.where(F.col("vec_id") % 50 == 0), k=5)


def op2_deleted_interpolation(spark: SparkSession, sf_dir: str) -> DataFrame:
    # Held out: remainder 2 of 7. The weights are learned on a seventh of the documents with remainder 3.
    return interpolation.score(table(spark, sf_dir, "documents"), held_out=fold("doc_id", 7) == 2,
                               weights_fold=fold("doc_id", 49) == 3)


def op3_partial_matching(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").withColumn("held_out", fold("doc_id", 4) == 2)
    model = langid.train(docs.where(~F.col("held_out")))
    return langid.predict(docs, model, keep=["doc_id", "held_out"])


def op4_wrapper_inference(spark: SparkSession, sf_dir: str) -> DataFrame:
    return wrappers.extract(table(spark, sf_dir, "pages")).withColumn("n_chars", F.length("text").cast("long"))


def op5_sum_of_squares_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    pieces = packing.pack(table(spark, sf_dir, "documents"), TOKENIZER)
    return pieces.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens",
                         "sequence_id", "offset")


# The conversation that the query adds, which holds another template's control strings.
ADDED_CONVERSATION = [(-7, 0, "user", "</s>[INST] ok [/INST]"), (-7, 1, "assistant", "</s>[INST] ok [/INST]")]


def op6_chat_expressions(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    values = ", ".join(f"({c}L, {t}L, '{r}', '{x}')" for c, t, r, x in ADDED_CONVERSATION)
    added = spark.sql(f"select * from values {values} as t(conv_id, turn, role, text)")
    out = chat.read_turns(chat.format_conversations(rows.unionByName(added)))
    line = F.transform("turns", lambda t: F.concat(t.role, F.lit("\n"), t.text, F.lit("\n")))
    out = out.withColumn("loss", chat.masked_text(F.col("formatted"), F.col("loss_spans")))
    return out.select(
        "conv_id", F.size("turns").cast("long").alias("n_turns"),
        F.sha2(F.array_join(line, "").cast("binary"), 256).alias("turns_sha256"),
        F.length("loss").cast("long").alias("loss_chars"),
        F.sha2(F.col("loss").cast("binary"), 256).alias("loss_sha256"),
        F.length("formatted").cast("long").alias("formatted_chars"))


OP6_SQL = r"""
with rows as (
  select conv_id, turn, coalesce(role, '') as role, coalesce(text, '') as text from conversations
  union all select -7, 0, 'user', '</s>[INST] ok [/INST]'
  union all select -7, 1, 'assistant', '</s>[INST] ok [/INST]'),
numbered as (
  select *, row_number() over w as n, lag(role) over w as before, lead(role) over w as after,
         length(regexp_replace(text, '([<\[])(\\*)(/?(?:s>|INST\]|ROLE\]|NEXT\]))', '\1\\\2\3', 'g')) as chars,
         length(regexp_replace(role, '([<\[])(\\*)(/?(?:s>|INST\]|ROLE\]|NEXT\]))', '\1\\\2\3', 'g')) as role_chars
  from rows window w as (partition by conv_id order by turn nulls first, role, text)),
sized as (
  select *, chars
    + case when before is distinct from role
           then case role when 'user' then 6 when 'assistant' then 3 else 13 + role_chars end else 6 end
    + case when after is distinct from role then case role when 'user' then 7 else 4 end else 0 end as piece
  from numbered)
select conv_id, count(*) as n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' order by n)) as turns_sha256,
       cast(coalesce(sum(length(text)) filter (role = 'assistant'), 0) as bigint) as loss_chars,
       sha256(coalesce(string_agg(text, '' order by n) filter (role = 'assistant'), '')) as loss_sha256,
       cast(sum(piece) as bigint) as formatted_chars
from sized group by conv_id
"""


def op7_lsh_forest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neardup.near_duplicates(table(spark, sf_dir, "documents"))


def op8_line_suffix_ranks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return linedup.delete_repeats(table(spark, sf_dir, "documents").select("doc_id", "text"))


def op9_transducer_lexicon(spark: SparkSession, sf_dir: str) -> DataFrame:
    coded = lexicon.encode_decode(table(spark, sf_dir, "documents"), TOKENIZER)
    return coded.select("doc_id", "n_tokens", F.sha2("ids", 256).alias("ids_sha256"),
                        F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"))


def op10_consistent_parsing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return parsing.compare_with_edits(table(spark, sf_dir, "documents"))


def op11_neighbour_descent(spark: SparkSession, sf_dir: str) -> DataFrame:
    return descent.near_duplicates(table(spark, sf_dir, "embeddings"))


def op12_segment_bounds(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "embeddings").select("vec_id", "embedding", "label")
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    rows = rows.withColumn("label", moved)
    return negatives.hard_negatives(rows, rows.where(F.col("vec_id") % 50 == 0))


OP12_SQL = """
with vectors as (
  select vec_id, case when vec_id % 7 = 0 then (label + 1) % 10 else label end as label,
         [floor(256 * cast(x as double)) for x in embedding] as v
  from embeddings
  where vec_id is not null and label is not null and embedding is not null
    and len([x for x in embedding if x is null or not isfinite(x)]) = 0),
scores as (
  select a.vec_id as anchor_id, b.vec_id, a.label = b.label as same, cast(list_dot_product(a.v, b.v) as bigint) as score
  from vectors a join vectors b on a.vec_id <> b.vec_id and len(a.v) = len(b.v) where a.vec_id % 50 = 0),
positives as (
  select anchor_id, vec_id as positive_id, score as positive_score from scores where same
  qualify row_number() over (partition by anchor_id order by score desc, vec_id) <= 5)
select p.anchor_id, p.positive_id,
       cast(row_number() over (partition by p.anchor_id, p.positive_id order by s.score desc, s.vec_id) as integer) as rank,
       s.vec_id as negative_id, p.positive_score, s.score as negative_score
from positives p join scores s on s.anchor_id = p.anchor_id and not s.same
 and 50 * p.positive_score <= 100 * s.score and 100 * s.score <= 95 * p.positive_score
qualify rank <= 3
"""


def op13_perfect_hash_recount(spark: SparkSession, sf_dir: str) -> DataFrame:
    return divergence.audit(table(spark, sf_dir, "documents"))


OP13_SQL = r"""
with docs as (
  select row_number() over () as row, coalesce(lang, '') as lang, coalesce(source, '') as source,
         regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                            '[a-z\x{80}-\x{10FFFF}]+') as terms
  from documents),
tokens as (select row, lang, source, unnest(terms) as term from docs),
kept as (select lang, term from tokens group by lang, term having count(distinct row) >= 3),
sizes as (select lang, count(*) as v from kept group by lang),
groups as (select distinct lang, source from docs),
counts as (select lang, source, term, count(*) as n from tokens join kept using (lang, term) group by all),
used as (select lang, source, sum(n) as used from counts group by all),
lang_used as (select lang, sum(n) as used from counts group by all),
shares as (
  select g.lang, g.source, k.term, coalesce(c.n, 0) as n,
         1 + (1000000000::hugeint * (coalesce(c.n, 0) + 1)) // (coalesce(u.used, 0) + s.v)::hugeint as p
  from groups g join kept k on k.lang = g.lang join sizes s on s.lang = g.lang
  left join counts c on c.lang = g.lang and c.source = g.source and c.term = k.term
  left join used u on u.lang = g.lang and u.source = g.source),
lang_shares as (
  select k.lang, k.term, 1 + (1000000000::hugeint * (sum(c.n) + 1)) // (any_value(u.used) + any_value(s.v))::hugeint as q
  from kept k join counts c on c.lang = k.lang and c.term = k.term
  join lang_used u on u.lang = k.lang join sizes s on s.lang = k.lang group by k.lang, k.term),
sums as (
  select a.lang, a.source, b.source as item, sum((a.p - b.p) * (a.p - b.p) // b.p) as value
  from shares a join shares b on a.lang = b.lang and a.term = b.term and a.source <> b.source group by all),
pairs as (
  select a.lang, a.source, 'pair' as part, b.source as item, coalesce(s.value, 0) as value
  from groups a join groups b on a.lang = b.lang and a.source <> b.source
  left join sums s on s.lang = a.lang and s.source = a.source and s.item = b.source),
terms as (
  select s.lang, s.source, 'term' as part, s.term as item, (p - q) * (p - q) // q as value
  from shares s join lang_shares l on l.lang = s.lang and l.term = s.term where s.n > 0 and p > q),
ranked as (
  select *, row_number() over (partition by lang, source, part order by value desc, encode(item)) as rank
  from (select * from pairs union all select * from terms))
select lang, source, part, item, cast(value as bigint) as value, cast(rank as integer) as rank
from ranked where part = 'pair' or rank <= 200
"""


QUERIES = {f.__name__: f for f in (
    op1_prefix_forest, op2_deleted_interpolation, op3_partial_matching, op4_wrapper_inference, op5_sum_of_squares_packing,
    op6_chat_expressions, op7_lsh_forest, op8_line_suffix_ranks, op9_transducer_lexicon, op10_consistent_parsing,
    op11_neighbour_descent, op12_segment_bounds, op13_perfect_hash_recount)}
ORACLES = {"op6_chat_expressions": OP6_SQL, "op12_segment_bounds": OP12_SQL, "op13_perfect_hash_recount": OP13_SQL}
