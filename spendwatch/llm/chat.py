r"""Chat formatting by relational expressions only: collected turns are sorted, adjacent turns of one role merged by an
array aggregation, and everything concatenated.

Template: a user's run of turns is `[INST]...[/INST]`, an assistant's `<s>...</s>`, any other role's
`[ROLE]name[/ROLE]...</s>`; `[NEXT]` stands between merged turns. Inside texts and role names, a control string gets a
backslash behind its opening bracket (`[\INST]`, `<\/s>`), one more if it has some already; taking one away restores
the text. No control string can arise across a border, as none has a bracket inside.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

# Fixed values of the template.
USER, ASSISTANT, NEXT = "user", "assistant", "[NEXT]"
_NAMES = r"s>|INST\]|ROLE\]|NEXT\]"
_PLAIN = rf"([<\[])(\\*)(/?(?:{_NAMES}))"
_ESCAPED = rf"([<\[])\\(\\*)(/?(?:{_NAMES}))"
_RUN = r"(?s)(\[INST\]|<s>|\[ROLE\](.*?)\[/ROLE\])(.*?)(?:\[/INST\]|</s>)"


def escape(text: Column) -> Column:
    return F.regexp_replace(text, F.lit(_PLAIN), F.lit(r"$1\\$2$3"))


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, F.lit(_ESCAPED), F.lit("$1$2$3"))


def _open(role: Column) -> Column:
    return (F.when(role == USER, "[INST]").when(role == ASSISTANT, "<s>")
            .otherwise(F.concat(F.lit("[ROLE]"), escape(role), F.lit("[/ROLE]"))))


def _close(role: Column) -> Column:
    return F.when(role == USER, "[/INST]").otherwise("</s>")


def _merged_runs(turns: Column) -> Column:
    """Adjacent turns of the same role as one (role, texts)."""
    def add(runs: Column, turn: Column) -> Column:
        last = F.element_at(runs, -1)
        grown = F.struct(turn.role.alias("role"), F.concat(last.texts, F.array(turn.text)).alias("texts"))
        fresh = F.struct(turn.role.alias("role"), F.array(turn.text).alias("texts"))
        same = (F.size(runs) > 0) & (F.try_element_at(runs, F.lit(-1)).role == turn.role)
        return F.when(same, F.concat(F.slice(runs, 1, F.size(runs) - 1), F.array(grown))).otherwise(
            F.concat(runs, F.array(fresh)))

    return F.aggregate(turns, F.expr("cast(array() as array<struct<role:string,texts:array<string>>>)"), add)


def _loss_spans(runs: Column) -> Column:
    """Where in the formatted text each assistant text stands: (start, length) in code points, start from 0."""
    empty = F.struct(F.lit(0).cast("long").alias("at"),
                     F.expr("cast(array() as array<struct<start:bigint,length:bigint>>)").alias("spans"))

    def run(state: Column, one: Column) -> Column:
        def text(inner: Column, value: Column) -> Column:
            length = F.length(value).cast("long")
            span = F.array(F.struct(inner.at.alias("start"), length.alias("length")))
            return F.struct((inner.at + length + len(NEXT)).alias("at"),
                            F.when(one.role == ASSISTANT, F.concat(inner.spans, span)).otherwise(inner.spans)
                            .alias("spans"))

        begin = F.struct((state.at + F.length(_open(one.role))).alias("at"), state.spans.alias("spans"))
        done = F.aggregate(one.texts, begin, text)
        return F.struct((done.at - len(NEXT) + F.length(_close(one.role))).alias("at"), done.spans.alias("spans"))

    return F.aggregate(runs, empty, run).spans


def format_conversations(turns: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role",
                         text: str = "text") -> DataFrame:
    """One row per conversation: its id, formatted, and loss_spans (start, length) over the assistant texts.

    Turns are sorted by number (null first), then role, then text, so ties and repeated rows have a fixed order and all
    of them stay. A null text or role counts as empty; a null id is a conversation of its own. Other columns
    are ignored; no rows give no conversations.
    """
    columns = [F.col(f"`{turn}`").alias("turn"), F.coalesce(F.col(f"`{role}`").cast("string"), F.lit("")).alias("role"),
               F.coalesce(F.col(f"`{text}`").cast("string"), F.lit("")).alias("text")]
    sorted_turns = (turns.select(F.col(f"`{conv}`").alias(conv), F.struct(*columns).alias("_turn"))
                    .groupBy(conv).agg(F.sort_array(F.collect_list("_turn")).alias("_turns")))
    escaped = F.transform("_turns", lambda t: F.struct(t.role.alias("role"), escape(t.text).alias("text")))
    formatted = F.array_join(F.transform("_runs", lambda r: F.concat(
        _open(r.role), F.array_join(r.texts, NEXT), _close(r.role))), "")
    return (sorted_turns.select(conv, _merged_runs(escaped).alias("_runs"))
            .select(conv, formatted.alias("formatted"), _loss_spans(F.col("_runs")).alias("loss_spans")))


def read_turns(frame: DataFrame) -> DataFrame:
    """`frame` with the column turns: (role, text) of every turn, read back from `formatted`."""
    parts = frame.withColumns({f"_part{i}": F.regexp_extract_all("formatted", F.lit(_RUN), F.lit(i))
                               for i in (1, 2, 3)})

    def run(part: Column) -> Column:
        role = (F.when(part["_part1"] == "[INST]", USER).when(part["_part1"] == "<s>", ASSISTANT)
                .otherwise(unescape(part["_part2"])))
        return F.transform(F.split(part["_part3"], r"\[NEXT\]", -1),
                           lambda t: F.struct(role.alias("role"), unescape(t).alias("text")))

    turns = F.flatten(F.transform(F.arrays_zip("_part1", "_part2", "_part3"), run))
    return parts.withColumn("turns", turns).drop("_part1", "_part2", "_part3")


def masked_text(formatted: Column, spans: Column) -> Column:
    """All text under the loss mask, unescaped, with nothing between."""
    return F.array_join(F.transform(spans, lambda s: unescape(F.substring(
        formatted, (s.start + 1).cast("int"), s.length.cast("int")))), "")
