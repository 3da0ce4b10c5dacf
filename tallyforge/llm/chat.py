"""Chat formatting with schema fingerprints, in DataFrame functions only.

A record's layout is the set of its nested field paths. Its hash, the fingerprint, selects one of the declared mappings, which says
where the turns' roles and texts stand; so prompt, instruction and message layouts come out as one list of (role, text). The
template writes a turn as ``<|role|>text<|end|>`` and a line end. Control strings inside roles and texts, ours and those of other
common templates, get a backslash after their first character, and backslashes are doubled first, so the text is read back exactly.
The loss mask is a list of ranges of the formatted text that cover each assistant's (escaped) text.

Edge cases: null texts and roles count as empty; turns are in order of turn (null last), then role, then text; repeated rows are turns of their
own; a null conversation id is a conversation; a record of no declared layout has no turns and the mapping null; empty tables give
an empty result. Other columns are never read.
"""

from __future__ import annotations

import hashlib
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyforge.llm.arrays import bound, sums_before

TURNS = "array<struct<role:string,text:string>>"
ASSISTANT = "assistant"
#: Fixed strings: what opens our marks, and control strings of other templates.
CONTROL = ("<|", "</s>", "<s>", "<<SYS>>", "<</SYS>>", "[INST]", "[/INST]")
#: Names that roles have in other layouts.
ROLES = {"human": "user", "gpt": "assistant", "bot": "assistant", "model": "assistant"}


@dataclass(frozen=True)
class Layout:
    """A declarative mapping. Either ``items`` is the path of a list whose elements have the fields (role, text) of ``pair``, or ``fields`` lists (role, field)."""

    name: str
    items: str | None = None
    pair: tuple[str, str] = ("role", "content")
    fields: tuple[tuple[str, str], ...] = ()
    renamed: bool = False

    @property
    def paths(self) -> str:
        if self.items:
            inner = ", ".join(f"{f}: *" for f in sorted(self.pair))
            return f"OBJECT<{self.items}: ARRAY<OBJECT<{inner}>>>"
        return f"OBJECT<{', '.join(f'{f}: *' for f in sorted(f for _, f in self.fields))}>"

    @property
    def fingerprint(self) -> str:
        return hashlib.sha256(self.paths.encode()).hexdigest()

    def turns(self, payload: Column) -> Column:
        if self.items:
            role, text = self.pair
            listed = F.variant_get(payload, f"$.{self.items}", f"array<struct<{role}:string,{text}:string>>")
            return F.transform(listed, lambda t: _turn(t[role], t[text], self.renamed))
        return F.array(*(_turn(F.lit(role), F.variant_get(payload, f"$.{field}", "string")) for role, field in self.fields))


def _turn(role: Column, text: Column, renamed: bool = False) -> Column:
    role = F.coalesce(role, F.lit(""))
    named = role if not renamed else reduce(lambda c, kv: c.when(role == kv[0], kv[1]), ROLES.items(), F.when(F.lit(False), "")).otherwise(role)
    return F.struct(named.alias("role"), F.coalesce(text, F.lit("")).alias("text"))


LAYOUTS = (
    Layout("messages", "messages"),
    Layout("sharegpt", "conversations", ("from", "value"), renamed=True),
    Layout("dialog", "turns", ("speaker", "text"), renamed=True),
    Layout("prompt_response", fields=(("user", "prompt"), ("assistant", "response"))),
    Layout("prompt_completion", fields=(("user", "prompt"), ("assistant", "completion"))),
    Layout("system_prompt_response", fields=(("system", "system"), ("user", "prompt"), ("assistant", "response"))),
    Layout("question_answer", fields=(("user", "question"), ("assistant", "answer"))),
    Layout("instruction_output", fields=(("user", "instruction"), ("assistant", "output"))),
    Layout("instruction_input_output", fields=(("user", "instruction"), ("user", "input"), ("assistant", "output"))),
)


def field_paths(payload: Column) -> Column:
    """The nested field paths of a variant, in order of name and without scalar types."""
    return F.regexp_replace(F.schema_of_variant(payload), r": (?!OBJECT<|ARRAY<)[A-Z]+(\([0-9, ]+\))?", ": *")


def canonical(records: DataFrame, payload_col: str, layouts: tuple[Layout, ...] = LAYOUTS) -> DataFrame:
    """``records`` with fingerprint, mapping and turns added; ``payload_col`` is a variant, or JSON text."""
    payload = F.col(payload_col)
    if records.schema[payload_col].dataType.simpleString() != "variant":
        payload = F.try_parse_json(payload)
    out = records.withColumn("fingerprint", F.sha2(field_paths(payload), 256))
    chosen = lambda value, default: reduce(lambda c, x: c.when(F.col("fingerprint") == x.fingerprint, value(x)), layouts, F.when(F.lit(False), default)).otherwise(default)
    return out.withColumn("mapping", chosen(lambda x: F.lit(x.name), F.lit(None).cast("string"))).withColumn("turns", chosen(lambda x: x.turns(payload), F.array().cast(TURNS)))


def escaped(text: Column, more: tuple[str, ...] = ()) -> Column:
    out = F.replace(text, F.lit("\\"), F.lit("\\\\"))
    for c in CONTROL + more:
        out = F.replace(out, F.lit(c), F.lit(f"{c[0]}\\{c[1:]}"))
    return out


def unescaped(text: Column) -> Column:
    return F.when(F.contains(text, F.lit("\\")), F.regexp_replace(text, r"(?s)\\(.)", "$1")).otherwise(text)


def formatted(turned: DataFrame, turns_col: str = "turns") -> DataFrame:
    """Adds ``formatted`` and ``loss`` (array of [start, end) in code points) to rows that have turns."""
    parts = F.transform(turns_col, lambda t: F.struct(F.concat(F.lit("<|"), escaped(t["role"], ("|>",)), F.lit("|>")).alias("head"), escaped(t["text"]).alias("body"), (t["role"] == ASSISTANT).alias("learned")))
    tail = "<|end|>\n"
    sizes = F.transform("__parts", lambda p: F.length(p["head"]) + F.length(p["body"]) + len(tail))

    def span(p: Column, at: Column) -> Column:
        start = at + F.length(p["head"])
        return F.when(p["learned"], F.struct(start.alias("start"), (start + F.length(p["body"])).alias("end")))

    out = turned.withColumn("__parts", parts)
    out = out.withColumn("formatted", F.array_join(F.transform("__parts", lambda p: F.concat(p["head"], p["body"], F.lit(tail))), ""))
    return out.withColumn("loss", F.array_compact(F.zip_with("__parts", sums_before(sizes), span))).drop("__parts")


def read_back(text: Column) -> Column:
    """The turns of a formatted text."""
    pieces = F.split(text, r"<\|", -1)
    heads = F.filter(pieces, lambda _, i: i % 2 == 1)
    end = lambda p: F.instr(p, "|>")
    return F.transform(heads, lambda p: F.struct(unescaped(F.substring(p, F.lit(1), end(p) - 1)).alias("role"), unescaped(F.substring(p, end(p) + 2, F.length(p))).alias("text")))


def loss_text(text: Column, loss: Column) -> Column:
    """All text under the loss mask, unescaped. Where the mask covers just the assistant's texts, as ours does, they are taken from the pieces between marks; any other mask is cut out range by range."""

    def bodies(pieces: Column) -> Column:
        def body(p: Column, at: Column) -> Column:
            end = F.instr(p, "|>")
            return F.struct((at + end + 1).alias("start"), (at + F.length(p)).alias("end"), F.substring(p, F.lit(1), end - 1).alias("role"), F.substring(p, end + 2, F.length(p)).alias("text"))

        every = F.zip_with(pieces, sums_before(F.transform(pieces, lambda p: F.length(p) + 2)), body)
        return F.filter(every, lambda b, i: (i % 2 == 1) & (unescaped(b["role"]) == ASSISTANT))

    def learned(own: Column) -> Column:
        cut = F.transform(loss, lambda s: unescaped(F.substring(text, s["start"] + 1, s["end"] - s["start"])))
        same = F.transform(own, lambda b: F.struct(b["start"].alias("start"), b["end"].alias("end"))) == loss
        return F.array_join(F.when(same, F.transform(own, lambda b: unescaped(b["text"]))).otherwise(cut), "")

    return bound(bound(F.split(text, r"<\|", -1), bodies), learned)


def message_records(rows: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text") -> DataFrame:
    """Rows of one turn each to (conv_id, payload): a variant in the messages layout. A conversation's text must be in one row, so its turns meet in one task."""
    row = F.struct(F.col(turn_col).isNull().alias("missing"), F.col(turn_col).alias("turn"), F.coalesce(F.col(role_col).cast("string"), F.lit("")).alias("role"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("content"))
    grouped = rows.select(F.col(conv_col).alias("conv_id"), row.alias("row")).groupBy("conv_id").agg(F.array_sort(F.collect_list("row")).alias("rows"))
    messages = F.transform("rows", lambda r: F.struct(r["role"].alias("role"), r["content"].alias("content")))
    return grouped.select("conv_id", F.to_variant_object(F.struct(messages.alias("messages"))).alias("payload"))


def digests(done: DataFrame, id_col: str = "conv_id") -> DataFrame:
    """What is read back from ``formatted`` and ``loss``: counts and digests of turns and of the text to learn."""
    back = done.select(F.col(id_col), "formatted", read_back(F.col("formatted")).alias("back"), loss_text(F.col("formatted"), F.col("loss")).alias("learned"))
    said = F.array_join(F.transform("back", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    return back.select(
        id_col, F.size("back").cast("long").alias("n_turns"), F.sha2(said, 256).alias("turns_sha256"),
        F.length("learned").cast("long").alias("loss_chars"), F.sha2(F.col("learned"), 256).alias("loss_sha256"), F.length("formatted").cast("long").alias("formatted_chars"),
    )
