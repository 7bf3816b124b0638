"""Operator 6, chat formatting (native): a finite-state machine over roles and a declarative
template that emits text segments with a loss flag each.

``ChatTemplate`` states the markers, the escape character, the roles under the loss mask and
the machine's transitions.  A conversation's turns are ordered by turn (ties by role, then
text) and become segments ``(text, loss)``: a header per turn, the escaped text, a footer.
Only the text of a loss role carries the flag.  Escaping is reversible and leaves no start
of a control string inside a text, so the formatted string splits back into its turns
whatever the texts contain (``parse_formatted``).

The state machine starts in ``start`` and moves by (state, role); a pair without a
transition counts as a violation and the machine goes on from the state named like the
role, or stays.  Invalid conversations are formatted all the same and flagged.

Scale: one shuffle by conversation.  The contract's digest covers the whole conversation, so
its turns end in one row; nothing else is gathered, and string building is linear
(``array_join`` over arrays, no running concatenation).

Defined edge results: null text or role: empty; null turn: sorts first; a null
conversation id is a group of its own; repeated rows are repeated turns; an empty table
gives an empty result; other columns are ignored.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class ChatTemplate:
    open: str = "<|"                         # every control string starts with this
    start: str = "<|im_start|>"              # start, role, newline, text, end, newline
    end: str = "<|im_end|>"
    escape: str = "\\"
    loss_roles: tuple[str, ...] = ("assistant",)
    transitions: dict[tuple[str, str], str] = field(default_factory=lambda: {
        ("start", "system"): "system", ("start", "user"): "user",
        ("system", "user"): "user", ("user", "assistant"): "assistant",
        ("assistant", "user"): "user"})
    final: tuple[str, ...] = ("assistant",)


CHAT = ChatTemplate()


def escape_text(c: Column, t: ChatTemplate = CHAT) -> Column:
    """Escape character doubled, then one put inside every start of a control string."""
    broken = t.open[0] + t.escape + t.open[1:]
    return F.replace(F.replace(c, F.lit(t.escape), F.lit(t.escape * 2)), F.lit(t.open), F.lit(broken))


def escape_role(c: Column, t: ChatTemplate = CHAT) -> Column:
    """As ``escape_text``; a newline would end the role, so it is escaped too."""
    return F.replace(escape_text(c, t), F.lit("\n"), F.lit(t.escape + "\n"))


def unescape(c: Column, t: ChatTemplate = CHAT) -> Column:
    return F.regexp_replace(c, "(?s)" + "\\" + t.escape + "(.)", "$1")


def role_states(turns: Column, t: ChatTemplate = CHAT) -> Column:
    """Run the machine over an array of turns: struct(state, violations)."""
    moves = F.create_map(*[F.lit(x) for (s, r), to in t.transitions.items() for x in (f"{s}\n{r}", to)])
    states = sorted({s for s, _ in t.transitions} | set(t.transitions.values()))

    def step(acc, turn):
        to = F.try_element_at(moves, F.concat(acc["state"], F.lit("\n"), turn["role"]))
        known = turn["role"].isin(*states)
        return F.struct(
            F.coalesce(to, F.when(known, turn["role"]).otherwise(acc["state"])).alias("state"),
            (acc["violations"] + F.when(to.isNull(), 1).otherwise(0)).alias("violations"))

    return F.aggregate(turns, F.struct(F.lit("start").alias("state"), F.lit(0).alias("violations")), step)


def format_conversations(convs: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn",
                         role_col: str = "role", text_col: str = "text",
                         template: ChatTemplate = CHAT) -> DataFrame:
    """One row per conversation: conv_id, n_turns, segments array<struct<text, loss>>, formatted,
    valid (turn order accepted and ended in a final state) and n_violations."""
    t = template
    src = convs.select(
        convs[conv_col].alias("conv_id"),
        F.struct(convs[turn_col].alias("turn"), F.coalesce(convs[role_col], F.lit("")).alias("role"),
                 F.coalesce(convs[text_col], F.lit("")).alias("text")).alias("_t"))
    grouped = src.groupBy("conv_id").agg(F.sort_array(F.collect_list("_t")).alias("_turns"))

    def segments(x):
        head = F.concat(F.lit(t.start), escape_role(x["role"], t), F.lit("\n"))
        return F.array(
            F.struct(head.alias("text"), F.lit(False).alias("loss")),
            F.struct(escape_text(x["text"], t).alias("text"), x["role"].isin(*t.loss_roles).alias("loss")),
            F.struct(F.lit(t.end + "\n").alias("text"), F.lit(False).alias("loss")))

    out = grouped.select(
        "conv_id", F.size("_turns").cast("long").alias("n_turns"),
        F.flatten(F.transform("_turns", segments)).alias("segments"),
        role_states(F.col("_turns"), t).alias("_end"))
    return out.select(
        "conv_id", "n_turns", "segments",
        F.array_join(F.transform("segments", lambda s: s["text"]), "").alias("formatted"),
        ((F.col("_end.violations") == 0) & F.col("_end.state").isin(*t.final)).alias("valid"),
        F.col("_end.violations").cast("long").alias("n_violations"))


def parse_formatted(formatted: Column, template: ChatTemplate = CHAT) -> Column:
    """The turns of a formatted conversation: array<struct<role, text>>, unescaped."""
    t = template
    esc = "\\" + t.escape
    quoted = "".join("\\" + ch if ch in "|\\.[]{}()*+?^$" else ch for ch in t.start)
    pieces = F.split(formatted, quoted)      # nothing stands before the first start marker
    parts = F.slice(pieces, F.lit(2), F.size(pieces))
    role = r"(?s)^((?:[^" + esc + r"\n]|" + esc + r".)*+)\n"
    tail = len(t.end) + 1

    def turn(p):
        raw_role = F.regexp_extract(p, role, 1)
        body = F.substring(p, F.length(raw_role) + 2, F.length(p) - F.length(raw_role) - 1 - tail)
        return F.struct(unescape(raw_role, t).alias("role"), unescape(body, t).alias("text"))

    return F.transform(parts, turn)


def chat_digest(formatted: DataFrame, template: ChatTemplate = CHAT) -> DataFrame:
    """Digest columns read back from the formatted strings and the segments' loss flags."""
    t = template
    loss = F.transform(F.filter("segments", lambda s: s["loss"]), lambda s: unescape(s["text"], t))
    back = formatted.select(
        "conv_id", "valid", "n_violations", F.length("formatted").cast("long").alias("formatted_chars"),
        parse_formatted(F.col("formatted"), t).alias("_turns"), F.array_join(loss, "").alias("_loss"))
    whole = F.array_join(F.transform("_turns", lambda x: F.concat(x["role"], F.lit("\n"), x["text"], F.lit("\n"))), "")
    return back.select(
        "conv_id", F.size("_turns").cast("long").alias("n_turns"),
        F.sha2(whole, 256).alias("turns_sha256"), F.length("_loss").cast("long").alias("loss_chars"),
        F.sha2(F.col("_loss"), 256).alias("loss_sha256"), "formatted_chars", "valid", "n_violations")


def oracle_sql(extra_rows: str) -> str:
    """DuckDB SQL of the digest over ``conversations`` plus ``extra_rows`` (a VALUES list)."""
    return rf"""
WITH c AS (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
           UNION ALL SELECT * FROM (VALUES {extra_rows}) v(conv_id, turn, role, text)),
k AS (SELECT *, CASE WHEN role IN ('system', 'user', 'assistant') THEN role END AS known,
             replace(replace(text, '', '\'), '<|', '<\|') AS esc,
             replace(replace(replace(role, '', '\'), '<|', '<\|'), chr(10), '' || chr(10)) AS esc_role FROM c),
p AS (SELECT *, coalesce(last_value(known IGNORE NULLS) OVER (PARTITION BY conv_id ORDER BY turn, role, text
                         ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 'start') AS prev,
             last_value(known IGNORE NULLS) OVER (PARTITION BY conv_id ORDER BY turn, role, text
                         ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING) AS ending FROM k),
g AS (SELECT conv_id, count(*) AS n_turns,
             string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text) AS whole,
             coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (role = 'assistant'), '') AS loss,
             sum(length(esc) + length(esc_role) + 24) AS formatted_chars, max(ending) AS ending,
             count(*) FILTER ((prev, role) NOT IN (('start', 'system'), ('start', 'user'), ('system', 'user'),
                                                   ('user', 'assistant'), ('assistant', 'user'))) AS bad
      FROM p GROUP BY conv_id)
SELECT conv_id, n_turns, sha256(whole) AS turns_sha256, length(loss) AS loss_chars, sha256(loss) AS loss_sha256,
       formatted_chars::BIGINT AS formatted_chars, bad = 0 AND coalesce(ending, '') = 'assistant' AS valid,
       bad AS n_violations FROM g"""
