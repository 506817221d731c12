"""Chat formatting: a finite-state machine over roles and a declarative template, with DataFrame operations only."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Marks of a turn by role, and whether its text is under the loss. Any other role is written between ROLE marks.
TEMPLATE = {
    "system": ("[SYS]", "[/SYS]", False),
    "user": ("[INST]", "[/INST]", False),
    "assistant": ("<s>", "</s>", True),
}
ROLE = ("[ROLE]", "[/ROLE]", "[/TURN]")
#: (state, role) -> state. A conversation is valid if it starts with system or user and then user and assistant alternate.
TURNS = {
    ("start", "system"): "system",
    ("start", "user"): "user",
    ("system", "user"): "user",
    ("user", "assistant"): "assistant",
    ("assistant", "user"): "user",
}
#: States in which a valid conversation may end.
ENDS = ("user", "assistant")
#: A turn out of order leads to the broken state of its role, from which no turn leads back.
BROKEN = "!"


def controls(template: dict) -> list[str]:
    return [m for a, z, _ in template.values() for m in (a, z)] + list(ROLE)


def escape(text: Column, template: dict) -> Column:
    """No control string is left in the text: & becomes &amp; and a control string's first character a reference."""
    text = F.replace(text, F.lit("&"), F.lit("&amp;"))
    for c in controls(template):
        text = F.replace(text, F.lit(c), F.lit(f"&#{ord(c[0])};{c[1:]}"))
    return text


def unescape(text: Column, template: dict) -> Column:
    for c in sorted({c[0] for c in controls(template)}):
        text = F.replace(text, F.lit(f"&#{ord(c)};"), F.lit(c))
    return F.replace(text, F.lit("&amp;"), F.lit("&"))


def format_chats(turns: DataFrame, template: dict = TEMPLATE, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text") -> DataFrame:
    """Per conversation: id, n_turns, valid (the machine accepts its roles), segments array<struct<text, loss>>.

    The machine goes from state to state by the turns' roles; the state that a turn leads to decides its marks and whether
    its text is under the loss. A turn out of order is marked like others (so it can be read back), but from there on the
    states are broken and the conversation is not valid. The formatted text is the segments' texts in order. Null texts
    and null roles are empty strings; a role without a mark is written out, and no such conversation is valid. Turns go
    by number, ties by role and text, null numbers first; repeated rows are turns of their own. Rows of a null id are one
    conversation. An empty table gives none. A conversation's turns meet in one row, as its digest needs the whole of it,
    so memory is bounded by the longest conversation and not by how many there are.
    """
    if any(len(c) < 2 or any(d[0] in c[1:] for d in controls(template)) for c in controls(template)):
        raise ValueError("a mark's first character must not occur inside any mark, or marks could form across a text's ends")
    role, text = F.coalesce(F.col(role_col).cast("string"), F.lit("")), F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    whole = turns.select(F.col(conv_col).alias("conv"), F.struct(F.col(turn_col).alias("turn"), role.alias("role"), text.alias("text")).alias("t")).groupBy("conv").agg(F.array_sort(F.collect_list("t")).alias("ts"))
    segments = F.flatten(F.zip_with("ts", F.slice(states(F.col("ts"), template), F.lit(2), F.size("ts")), lambda t, s: turn_segments(t, s, template)))
    last = F.element_at(states(F.col("ts"), template), -1)
    return whole.select(F.col("conv").alias(conv_col), F.size("ts").cast("long").alias("n_turns"), last.isin(*ENDS).alias("valid"), segments.alias("segments"))


def states(turns: Column, template: dict) -> Column:
    """The machine's states: start, and the state after each turn. A state is a role of the template or "" for any other, broken or not."""
    step = F.create_map(*[F.lit(x) for (state, role), to in TURNS.items() for x in (f"{state}>{role}", to)])

    def follow(path: Column, turn: Column) -> Column:
        broken = F.concat(F.when(turn["role"].isin(*template), turn["role"]).otherwise(""), F.lit(BROKEN))
        return F.array_append(path, F.coalesce(step[F.concat(F.element_at(path, -1), F.lit(">"), turn["role"])], broken))

    return F.aggregate(turns, F.array(F.lit("start")), follow)


def turn_segments(turn: Column, state: Column, template: dict) -> Column:
    """Opening mark, escaped text, closing mark of a turn in a state of the machine: array<struct<text, loss>>."""
    told = F.create_map(*[x for name, (a, z, loss) in template.items() for s in (name, name + BROKEN) for x in (F.lit(s), F.struct(F.lit(a).alias("a"), F.lit(z).alias("z"), F.lit(loss).alias("loss")))])
    other = F.struct(F.concat(F.lit(ROLE[0]), escape(turn["role"], template), F.lit(ROLE[1])).alias("a"), F.lit(ROLE[2]).alias("z"), F.lit(False).alias("loss"))
    part = lambda text, loss: F.struct(text.alias("text"), loss.alias("loss"))
    # The marks are bound once: as an element of an array that is transformed.
    return F.flatten(F.transform(F.array(F.coalesce(told[state], other)), lambda m: F.array(part(m["a"], F.lit(False)), part(escape(turn["text"], template), m["loss"]), part(m["z"], F.lit(False)))))


def read_chats(formatted: Column, template: dict = TEMPLATE) -> Column:
    """The formatted text's turns again: array<struct<role, text>>, unescaped."""
    any_of = lambda xs: "|".join(map(re.escape, xs))
    pattern = F.lit(f"(?s)({any_of([a for a, _, _ in template.values()])}|{re.escape(ROLE[0])}.*?{re.escape(ROLE[1])})(.*?)({any_of([z for _, z, _ in template.values()])}|{re.escape(ROLE[2])})")
    names = F.create_map(*[F.lit(x) for name, (a, _, _) in template.items() for x in (a, name)])
    written = lambda m: unescape(F.substr(m, F.lit(len(ROLE[0]) + 1), F.length(m) - len(ROLE[0]) - len(ROLE[1])), template)
    return F.transform(F.arrays_zip(F.regexp_extract_all(formatted, pattern, 1).alias("m"), F.regexp_extract_all(formatted, pattern, 2).alias("t")), lambda x: F.struct(F.coalesce(names[x["m"]], written(x["m"])).alias("role"), unescape(x["t"], template).alias("text")))


def digests(chats: DataFrame, template: dict = TEMPLATE, conv_col: str = "conv_id") -> DataFrame:
    """What a reader of the formatted conversations finds: turns, and the text under the loss mask, as SHA-256."""
    text = F.array_join(F.transform("segments", lambda s: s["text"]), "")
    loss = F.array_join(F.transform(F.filter("segments", lambda s: s["loss"]), lambda s: unescape(s["text"], template)), "")
    read = chats.select(conv_col, "valid", text.alias("formatted"), loss.alias("under_loss")).withColumn("turns", read_chats(F.col("formatted"), template))
    told = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    return read.select(
        conv_col, F.size("turns").cast("long").alias("n_turns"), F.sha2(told.cast("binary"), 256).alias("turns_sha256"), F.length("under_loss").cast("long").alias("loss_chars"), F.sha2(F.col("under_loss").cast("binary"), 256).alias("loss_sha256"),
        F.length("formatted").cast("long").alias("formatted_chars"), "valid",
    )


def _sql_escaped(text: str) -> str:
    out = f"replace({text}, '&', '&amp;')"
    for c in controls(TEMPLATE):
        out = f"replace({out}, '{c}', '&#{ord(c[0])};{c[1:]}')"
    return out


def oracle() -> str:
    marks = " ".join(f"WHEN '{name}' THEN {len(a) + len(z)}" for name, (a, z, _) in TEMPLATE.items())
    allowed = ", ".join(f"('{state}', '{role}')" for state, role in TURNS)
    return f"""
    WITH c AS (
      SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
      UNION ALL VALUES (-7, 0, 'user', '</s>[INST] ok [/INST]'), (-7, 1, 'assistant', '</s>[INST] ok [/INST]')),
    d AS (SELECT *, lag(role, 1, 'start') OVER w AS before, row_number() OVER (PARTITION BY conv_id ORDER BY turn DESC, role DESC, text DESC) AS from_end FROM c WINDOW w AS (PARTITION BY conv_id ORDER BY turn, role, text))
    SELECT conv_id, count(*) AS n_turns,
           sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
           coalesce(sum(length(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
           sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
           sum(length({_sql_escaped("text")}) + CASE role {marks} ELSE {sum(map(len, ROLE))} + length({_sql_escaped("role")}) END)::BIGINT AS formatted_chars,
           bool_and((before, role) IN ({allowed})) AND bool_or(from_end = 1 AND role IN {ENDS}) AS valid
    FROM d GROUP BY conv_id
    """
