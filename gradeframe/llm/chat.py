"""Chat formatting by schema fingerprints, in native expressions only.

Records of any layout come as a VARIANT. The nested field paths of a record
(its schema without the scalar types) are hashed; the hash selects a declarative
mapping that says where the turns are; the turns are written in one template:

    <turn>ROLE
    TEXT</turn>

``\\`` and ``<`` are escaped inside texts and roles (and line feeds inside roles), so no text can
hold a marker, and reading back is exact. The loss mask is run lengths in code
points, one entry a turn: ``off`` outside the loss, ``loss`` under it, ``rest`` outside.
"""

from __future__ import annotations

from dataclasses import dataclass, field
from itertools import combinations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

LOSS_ROLE = "assistant"
TURNS = "array<struct<role:string,text:string>>"
OPEN, CLOSE = "<turn>", "</turn>\n"


@dataclass(frozen=True)
class Mapping:
    """One layout. ``fields``: (role, field) in turn order, missing optional ones are left out; or ``items``:
    a list field whose objects hold ``role`` and ``text`` fields. ``roles`` renames roles."""

    name: str
    fields: tuple[tuple[str, str], ...] = ()
    optional: tuple[str, ...] = ()
    items: str = ""
    role: str = ""
    text: str = ""
    roles: dict[str, str] = field(default_factory=dict)

    def layouts(self) -> list[str]:
        """The layouts that this mapping reads, as ``layout`` writes them."""
        if self.items:
            parts = [self.role, self.text]
            some = [s for n in (2, 1) for s in combinations(sorted(parts), n)]
            return [f"OBJECT<{self.items}: ARRAY<OBJECT<{', '.join(s)}>>>" for s in some] + [f"OBJECT<{self.items}: ARRAY<>>"]
        names = {f for _, f in self.fields} | set(self.optional)
        return [f"OBJECT<{', '.join(sorted(names - set(gone)))}>" for n in range(len(self.optional) + 1) for gone in combinations(self.optional, n)]

    def turns(self, record: Column) -> Column:
        get = lambda path, kind="string": F.try_variant_get(record, f"$.{path}", kind)
        if self.items:
            found = get(self.items, f"array<struct<{self.role} string, {self.text} string>>")
            rename = lambda role: role
            if self.roles:
                names = F.create_map(*(F.lit(x) for pair in self.roles.items() for x in pair))
                rename = lambda role: F.coalesce(F.try_element_at(names, role), role)
            return F.transform(found, lambda t: F.struct(F.coalesce(rename(t[self.role]), F.lit("")).alias("role"), F.coalesce(t[self.text], F.lit("")).alias("text"))).cast(TURNS)
        each = []
        for role, name in self.fields:
            turn = F.struct(F.lit(role).alias("role"), F.coalesce(get(name), F.lit("")).alias("text"))
            each.append(F.when(get(name).isNotNull(), F.array(turn)).otherwise(F.array().cast(TURNS)) if name in self.optional else F.array(turn))
        return F.concat(*each).cast(TURNS)


MAPPINGS = (
    Mapping("messages", items="messages", role="role", text="content"),
    Mapping("conversations", items="conversations", role="from", text="value", roles={"human": "user", "gpt": "assistant", "bot": "assistant"}),
    Mapping("prompt_completion", fields=(("system", "system"), ("user", "prompt"), ("assistant", "completion")), optional=("system",)),
    Mapping("prompt_response", fields=(("system", "system"), ("user", "prompt"), ("assistant", "response")), optional=("system",)),
    Mapping("instruction", fields=(("system", "system"), ("user", "instruction"), ("user", "input"), ("assistant", "output")), optional=("system", "input")),
    Mapping("question_answer", fields=(("user", "question"), ("assistant", "answer"))),
)

_SCALAR = r"(?<=: |<)(VOID|BOOLEAN|BIGINT|FLOAT|DOUBLE|STRING|VARIANT|DATE|TIMESTAMP_NTZ|TIMESTAMP|BINARY|UUID|DECIMAL\(\d+,\d+\))(?=[,>]|$)"


def layout(record: Column) -> Column:
    """The nested field paths of a record: its schema, names in order, scalar types left out."""
    return F.regexp_replace(F.regexp_replace(F.schema_of_variant(record), _SCALAR, ""), r": (?=[,>])", "")


def fingerprint(record: Column) -> Column:
    return F.xxhash64(layout(record))


def canonical(records: DataFrame, record: str = "record", mappings: tuple[Mapping, ...] = MAPPINGS) -> DataFrame:
    """Adds ``mapping`` (name) and ``turns`` (role, text) to rows with a VARIANT column.

    A layout that no mapping reads, and a NULL record, give NULL for both. NULL
    roles and texts read as empty, a NULL optional field as absent."""
    columns = [c for c in records.columns if c not in ("mapping", "turns", "_fingerprint")]
    rows = records.select(*columns, fingerprint(F.col(record)).alias("_fingerprint"))
    name, turns = F.lit(None).cast("string"), F.lit(None).cast(TURNS)
    for m in reversed(mappings):
        chosen = F.col("_fingerprint").isin(*(F.xxhash64(F.lit(x)) for x in m.layouts()))
        name = F.when(chosen, F.lit(m.name)).otherwise(name)
        turns = F.when(chosen, m.turns(F.col(record))).otherwise(turns)
    return rows.select(*columns, name.alias("mapping"), turns.alias("turns"))


def escape(text: Column) -> Column:
    return F.replace(F.replace(text, F.lit("\\"), F.lit("\\e")), F.lit("<"), F.lit("\\l"))


def unescape(text: Column) -> Column:
    return F.replace(F.replace(text, F.lit("\\l"), F.lit("<")), F.lit("\\e"), F.lit("\\"))


def formatted(rows: DataFrame, loss_role: str = LOSS_ROLE) -> DataFrame:
    """Adds ``formatted`` (the template's text) and ``loss_mask`` to rows with ``turns``.

    No turns: an empty text and an empty mask; NULL turns: NULL for both. Other columns pass through."""
    def parts(t):
        role = F.replace(escape(t["role"]), F.lit("\n"), F.lit("\\n"))
        head = F.concat(F.lit(OPEN), role, F.lit("\n"))
        return F.struct(head.alias("head"), escape(t["text"]).alias("body"), (t["role"] == loss_role).alias("on"))

    def runs(p):
        head, body, tail = F.length(p["head"]), F.length(p["body"]), len(CLOSE)
        on = F.when(p["on"], body).otherwise(0)
        return F.struct(head.cast("bigint").alias("off"), on.cast("bigint").alias("loss"), (body - on + tail).cast("bigint").alias("rest"))

    columns = [c for c in rows.columns if c not in ("formatted", "loss_mask", "_parts")]
    made = rows.select(*columns, F.transform("turns", parts).alias("_parts"))
    text = F.array_join(F.transform("_parts", lambda p: F.concat(p["head"], p["body"], F.lit(CLOSE))), "")
    return made.select(*columns, text.alias("formatted"), F.transform("_parts", runs).alias("loss_mask"))


def read_back(rows: DataFrame) -> DataFrame:
    """Adds ``read_turns`` (role, text) and ``loss_text``, both from ``formatted`` and ``loss_mask`` alone."""
    pieces = F.split("formatted", CLOSE)
    blocks = F.slice(pieces, 1, F.size(pieces) - 1)  # behind the last marker is nothing

    def turn(b):
        line = F.instr(b, "\n")
        role = F.replace(F.substring(b, F.lit(len(OPEN) + 1), line - len(OPEN) - 1), F.lit("\\n"), F.lit("\n"))
        return F.struct(unescape(role).alias("role"), unescape(F.substring(b, line + 1, F.length(b))).alias("text"))

    columns = [c for c in rows.columns if c not in ("_blocks", "read_turns", "loss_text")]
    cut = rows.select(*columns, blocks.alias("_blocks"))
    # Every block begins where its entry of the mask does.
    under = F.zip_with("_blocks", "loss_mask", lambda b, m: F.when(m["loss"] > 0, unescape(F.substring(b, (m["off"] + 1).cast("int"), m["loss"].cast("int")))).otherwise(F.lit("")))
    return cut.select(*columns, F.transform("_blocks", turn).alias("read_turns"), F.array_join(under, "").alias("loss_text"))


def records_of(conversations: DataFrame) -> DataFrame:
    """One VARIANT record of layout ``messages`` per conv_id from rows (conv_id, turn, role, text).

    Turns are ordered by turn, then role and text (NULLs first); NULL texts and
    roles are empty; rows without conv_id are one conversation; extra columns are
    ignored. A conversation is one record, so it is one task's row."""
    item = F.struct("turn", F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"))
    rows = conversations.groupBy("conv_id").agg(F.sort_array(F.collect_list(item)).alias("rows"))
    messages = F.transform("rows", lambda r: F.struct(r["role"].alias("role"), r["text"].alias("content")))
    return rows.select("conv_id", F.to_variant_object(F.struct(messages.alias("messages"))).alias("record"))


def digest(rows: DataFrame) -> DataFrame:
    """Digests of formatted conversations, computed from what ``read_back`` returns."""
    said = F.array_join(F.transform("read_turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    return rows.select(
        "conv_id", F.size("read_turns").cast("bigint").alias("n_turns"), F.sha2(said, 256).alias("turns_sha256"),
        F.length("loss_text").cast("bigint").alias("loss_chars"), F.sha2("loss_text", 256).alias("loss_sha256"),
        F.length("formatted").cast("bigint").alias("formatted_chars"))
