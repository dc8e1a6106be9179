"""Chat formatting: a state machine over roles and text segments with loss flags, from a template.

Everything is DataFrame expressions: turns are gathered per conversation, the machine is a fold over the
roles with a lookup in the template's transitions, and the codes it leaves turn by turn decide what is a segment
under the loss.
"""

from __future__ import annotations

import re
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

@dataclass(frozen=True)
class Template:
    """A turn is ``turn_start``, the role, ``role_end``, the text, ``turn_end``.

    ``moves`` maps a state to the state each role leads to; roles not named there break the order.
    ``learned`` are the roles whose texts count in the loss. Control strings start with ``<|``, which
    escaping keeps out of roles and texts.
    """

    turn_start: str = "<|im_start|>"
    role_end: str = "\n"
    turn_end: str = "<|im_end|>\n"
    learned: tuple[str, ...] = ("assistant",)
    start: str = "start"
    final: tuple[str, ...] = ("answered",)
    moves: dict[str, dict[str, str]] = field(
        default_factory=lambda: {
            "start": {"system": "briefed", "user": "asked"},
            "briefed": {"user": "asked"},
            "asked": {"assistant": "answered"},
            "answered": {"user": "asked"},
        }
    )


CHATML = Template()


def escape(text: Column) -> Column:
    """One more backslash between each ``<`` and ``|``, so no ``<|`` is left; ``unescape`` undoes it."""
    return F.regexp_replace(text, r"<(\\*)\|", r"<$1\\|")


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, r"<(\\*)\\\|", r"<$1|")


def escape_role(role: Column) -> Column:
    """As ``escape``; line breaks, which end a role, become %0A."""
    return escape(F.replace(F.replace(role, F.lit("%"), F.lit("%25")), F.lit("\n"), F.lit("%0A")))


def unescape_role(role: Column) -> Column:
    return F.replace(F.replace(unescape(role), F.lit("%0A"), F.lit("\n")), F.lit("%25"), F.lit("%"))


# a code is one letter: what the machine knows after a turn
CODES = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz"
BEGUN, BROKEN, BROKEN_LEARNED = CODES[:3]


@dataclass(frozen=True)
class Machine:
    """The template's machine: ``moves`` from code and role to code; the codes after a turn that is
    learned, and those in which a conversation may end. Roles without a move lead to the broken codes, which have none."""

    moves: dict[str, str]
    learned: tuple[str, ...]
    final: tuple[str, ...]


def machine(template: Template) -> Machine:
    steps = [(state, role, to) for state, own in template.moves.items() for role, to in own.items()]
    # a state that is reached by learned and by other roles has a code for each
    reached = dict.fromkeys((to, role in template.learned) for _, role, to in steps)
    if len(reached) > len(CODES) - 3:
        raise ValueError(f"a template may have {len(CODES) - 3} states at most")
    codes = dict(zip(reached, CODES[3:]))
    of_state = {state: [code for (to, _), code in codes.items() if to == state] for state in template.moves}
    of_state[template.start] = [BEGUN, *of_state.get(template.start, [])]
    moves = {code + role: codes[to, role in template.learned] for state, role, to in steps for code in of_state[state]}
    learned = (BROKEN_LEARNED, *(code for (_, is_learned), code in codes.items() if is_learned))
    final = tuple(code for (to, _), code in codes.items() if to in template.final)
    return Machine(moves, learned, final + (BEGUN,) * (template.start in template.final))


def run_machine(roles: Column, template: Template) -> Column:
    """The codes after each turn, as an array: a fold over the roles with a lookup of the moves."""
    moves = F.create_map(*(F.lit(x) for pair in machine(template).moves.items() for x in pair))

    def step(done: Column, role: Column) -> Column:
        broken = F.when(role.isin(*template.learned), BROKEN_LEARNED).otherwise(BROKEN)
        code = F.coalesce(F.try_element_at(moves, F.concat(done["code"], role)), broken)
        return F.struct(code.alias("code"), F.concat(done["trail"], code).alias("trail"))

    begun = F.struct(F.lit(BEGUN).alias("code"), F.lit("").alias("trail"))
    return F.split(F.aggregate(roles, begun, step)["trail"], "")


def segments_of(turns: Column, codes: Column, template: Template) -> Column:
    """Per turn and the machine's code after it: its opening (no loss), its escaped text (loss if the code is
    that of a learned turn), its end (no loss)."""
    learned = machine(template).learned

    def parts(turn: Column, code: Column) -> Column:
        part = lambda text, loss: F.struct(text.alias("text"), loss.alias("loss"))
        opening = F.concat(F.lit(template.turn_start), escape_role(turn["role"]), F.lit(template.role_end))
        return F.array(
            part(opening, F.lit(False)),
            part(escape(turn["text"]), code.isin(*learned)),
            part(F.lit(template.turn_end), F.lit(False)),
        )

    return F.flatten(F.zip_with(turns, codes, parts))


def format_chats(df: DataFrame, template: Template = CHATML) -> DataFrame:
    """One row per conversation: conv_id, valid, segments (text, loss), formatted (their concatenation).

    Rows are ordered by turn (null first), ties by role and text. Null roles and texts are empty. A
    conversation that breaks the order of turns is formatted like any other, with valid = false; valid
    ones also end in a final state. A null conv_id is a conversation of its own. Extra columns are
    ignored, whatever their names; an empty table gives an empty result. A conversation is one row, as long as its texts.
    """
    turn = F.struct(F.col("turn"), F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"))
    chats = df.groupBy("conv_id").agg(F.array_sort(F.collect_list(turn)).alias("turns"))
    coded = chats.withColumn("codes", run_machine(F.transform("turns", lambda t: t["role"]), template))
    return coded.select(
        "conv_id",
        F.element_at("codes", -1).isin(*machine(template).final).alias("valid"),
        segments_of(F.col("turns"), F.col("codes"), template).alias("segments"),
    ).withColumn("formatted", F.array_join(F.transform("segments", lambda s: s["text"]), ""))


def read_turns(formatted: Column, template: Template = CHATML) -> Column:
    """The turns (role, text) back from a formatted conversation."""
    pieces = F.split(formatted, re.escape(template.turn_start), -1)

    def turn(piece: Column) -> Column:
        role = F.substring_index(piece, template.role_end, 1)
        begin = F.length(role) + len(template.role_end) + 1
        text = F.substring(piece, begin, F.length(piece) - begin + 1 - len(template.turn_end))
        return F.struct(unescape_role(role).alias("role"), unescape(text).alias("text"))

    return F.transform(F.slice(pieces, F.lit(2), F.greatest(F.size(pieces) - 1, F.lit(0))), turn)


def read_loss(segments: Column) -> Column:
    """All text under the loss mask, unescaped, in order, nothing between."""
    return F.array_join(F.transform(F.filter(segments, lambda s: s["loss"]), lambda s: unescape(s["text"])), "")
