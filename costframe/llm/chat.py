r"""Chat formatting by schema fingerprints; DataFrame functions only.

A record is a JSON text.  Which of the paths that some mapping reads it has is
hashed to a fingerprint, which selects a declarative mapping from that layout
to canonical turns (role, text).  Other fields don't matter, so an id, a source
or a message's name beside the mapped fields leave the layout what it is; a path
that holds an object or array where a text belongs is another path.  Layouts are
declared by an example each; the fingerprint of the example is computed by the
same expression as that of the records, so a mapping is data, not code.  Records
without a declared layout, also those that fit two at once, keep null turns and
are counted by :func:`layouts_found`.

Turns are then written with marks: ``<|im_start|>role``, a line feed, the text,
``<|im_end|>`` and a line feed.  Inside texts every backslash is doubled and one is
put behind a ``<`` or ``[`` that begins a control string, so a text can't hold a
mark; dropping the backslashes again gives the text back exactly.  Roles are
URL-encoded.  The loss mask is a list of (start, length) in code points of the
formatted text, one span for each assistant text.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from costframe.llm.common import fresh_name, table

START, STOP = "<|im_start|>", "<|im_end|>\n"
TURNS = "array<struct<role:string,text:string>>"
#: What a control string may go on with behind its first character; fixed values of common chat templates.
CONTROL = r"(<|\[)(?=\||s>|/s>|<|/?INST\])"


@dataclass(frozen=True)
class Layout:
    """A layout by example: where its turns are.

    ``turns`` is the path of an array of messages with its role and text fields,
    and ``roles`` lists its names of canonical roles; otherwise ``fields`` lists
    (role, path, ...): the paths of a role are joined by a blank line, absent or
    empty ones left out, and a role without text is left out.
    """

    name: str
    example: str
    turns: tuple[str, str, str] | None = None
    fields: tuple[tuple[str, ...], ...] = ()
    roles: tuple[tuple[str, str], ...] = ()

    def paths(self) -> list[str]:
        """The paths that the mapping reads; ``[*]`` stands for the elements of an array."""
        if self.turns:
            return [f"{self.turns[0]}[*].{field}" for field in self.turns[1:]]
        return [p for _, *paths in self.fields for p in paths]


#: Role names of shared conversations.
SHARED = (("human", "user"), ("gpt", "assistant"), ("bot", "assistant"), ("model", "assistant"))
LAYOUTS = (
    Layout("messages", '{"messages":[{"role":"r","content":"c"}]}', ("$.messages", "role", "content")),
    Layout("shared", '{"conversations":[{"from":"r","value":"c"}]}', ("$.conversations", "from", "value"), roles=SHARED),
    Layout("instruction", '{"instruction":"a","input":"b","output":"c"}',
           fields=(("user", "$.instruction", "$.input"), ("assistant", "$.output"))),
    Layout("instruction with system", '{"system":"s","instruction":"a","input":"b","output":"c"}',
           fields=(("system", "$.system"), ("user", "$.instruction", "$.input"), ("assistant", "$.output"))),
    Layout("bare instruction", '{"instruction":"a","output":"c"}', fields=(("user", "$.instruction"), ("assistant", "$.output"))),
    Layout("prompt and completion", '{"prompt":"a","completion":"c"}', fields=(("user", "$.prompt"), ("assistant", "$.completion"))),
    Layout("prompt and response", '{"prompt":"a","response":"c"}', fields=(("user", "$.prompt"), ("assistant", "$.response"))),
    Layout("question", '{"question":"a","answer":"c"}', fields=(("user", "$.question"), ("assistant", "$.answer"))),
    Layout("nested prompt", '{"data":{"prompt":"a","response":"c"}}', fields=(("user", "$.data.prompt"), ("assistant", "$.data.response"))),
)


def _mark(value: Column, path: str) -> Column:
    """The path of a value that is there: as it is for a text, number or null, with a brace for an object or array."""
    nested = F.schema_of_variant(value).rlike("^(OBJECT|ARRAY)")
    return F.when(value.isNotNull(), F.when(nested, path + "{").otherwise(path))


def field_paths(record: Column, layouts=LAYOUTS) -> Column:
    """The paths that the layouts read and the variant has, in one order, as one text."""
    marks = []
    for path in sorted({p for layout in layouts for p in layout.paths()}):
        array, _, field = path.partition("[*]")
        if not field:
            marks.append(F.array(_mark(F.try_variant_get(record, path, "variant"), path)))
        else:
            every = F.try_variant_get(record, array, "array<variant>")
            marks.append(F.array_sort(F.array_distinct(F.coalesce(F.transform(
                every, lambda x: _mark(F.try_variant_get(x, "$" + field, "variant"), path)), F.array()))))  # noqa: B023
    return F.array_join(F.flatten(F.array(*marks)), ",")


def fingerprint(record: Column, layouts=LAYOUTS) -> Column:
    return F.xxhash64(field_paths(record, layouts))


def _mapped(record: Column, layout: Layout) -> Column:
    text = lambda path: F.try_variant_get(record, path, "string")
    if layout.turns:
        path, role, body = layout.turns
        got = F.try_variant_get(record, path, f"array<struct<`{role}`:string,`{body}`:string>>")

        def named(said: Column) -> Column:
            known = F.create_map(*[F.lit(x) for pair in layout.roles for x in pair])
            return F.coalesce(F.try_element_at(known, said), said) if layout.roles else said

        return F.transform(got, lambda t: F.struct(
            F.coalesce(named(t.getField(role)), F.lit("")).alias("role"),
            F.coalesce(t.getField(body), F.lit("")).alias("text")))
    turns = []
    for role, *paths in layout.fields:
        parts = F.filter(F.array(*[text(p) for p in paths]), lambda x: x.isNotNull() & (x != ""))
        turns.append(F.struct(F.lit(role).alias("role"), F.array_join(parts, "\n\n").alias("text")))
    return F.filter(F.array(*turns), lambda t: t.getField("text") != "")


def canonical_turns(records: DataFrame, column: str = "record", layouts=LAYOUTS) -> DataFrame:
    """``records`` with ``fingerprint`` and ``turns``; turns is null for a layout that isn't declared or no JSON.

    Columns of these two names are replaced; all others stay.
    """
    parsed = fresh_name(records, "parsed")
    out = records.withColumn(parsed, F.try_parse_json(F.col(column)))
    out = out.withColumn("fingerprint", F.when(F.col(parsed).isNotNull(), fingerprint(F.col(parsed), layouts)))
    turns = F.lit(None).cast(TURNS)
    for layout in reversed(layouts):
        of = fingerprint(F.parse_json(F.lit(layout.example)), layouts)
        turns = F.when(F.col("fingerprint") == of, _mapped(F.col(parsed), layout)).otherwise(turns)
    return out.withColumn("turns", turns).drop(parsed)


def layouts_found(converted: DataFrame, layouts=LAYOUTS) -> DataFrame:
    """(fingerprint, layout, records) of :func:`canonical_turns`' rows; a null layout holds the records without a mapping,
    a null fingerprint those that are no JSON."""
    name = F.lit(None).cast("string")
    for layout in layouts:
        name = F.when(F.col("fingerprint") == fingerprint(F.parse_json(F.lit(layout.example)), layouts), layout.name).otherwise(name)
    return converted.groupBy("fingerprint").agg(F.count(F.lit(1)).alias("records")).select("fingerprint", name.alias("layout"), "records")


def escaped(text: Column) -> Column:
    return F.regexp_replace(F.regexp_replace(text, r"\\", r"\\\\"), CONTROL, r"$1\\")


def unescaped(text: Column) -> Column:
    return F.regexp_replace(text, r"\\(\\?)", "$1")


def formatted(rows: DataFrame, turns: str = "turns", learn: str = "assistant") -> DataFrame:
    """``rows`` with ``formatted`` text and ``loss_spans``: (start, length) of each text of role ``learn``, in code points from 0."""
    cut = fresh_name(rows, "parts")
    parts = F.transform(turns, lambda t: F.struct(
        F.concat(F.lit(START), F.url_encode(t.getField("role")), F.lit("\n")).alias("head"),
        escaped(t.getField("text")).alias("body"), (t.getField("role") == learn).alias("learn")))
    spans = F.aggregate(cut, F.struct(F.lit(0).cast("long").alias("at"), F.array().cast("array<struct<start:long,length:long>>").alias("spans")), lambda acc, p: F.struct(
        (acc["at"] + F.length(p["head"]) + F.length(p["body"]) + len(STOP)).alias("at"),
        F.when(p["learn"], F.concat(acc["spans"], F.array(F.struct(
            (acc["at"] + F.length(p["head"])).alias("start"), F.length(p["body"]).cast("long").alias("length")))))
        .otherwise(acc["spans"]).alias("spans")))
    text = F.array_join(F.transform(cut, lambda p: F.concat(p["head"], p["body"], F.lit(STOP))), "")
    return (rows.withColumn(cut, parts).withColumn("formatted", text)
            .withColumn("loss_spans", spans["spans"]).drop(cut))


def parsed_turns(text: Column) -> Column:
    """The turns of a formatted text, read back."""
    whole = F.split(text, r"<\|im_end\|>\n")
    return F.transform(F.slice(whole, 1, F.size(whole) - 1), lambda t: F.struct(
        F.url_decode(F.substring_index(F.substring(t, len(START) + 1, 1 << 30), "\n", 1)).alias("role"),
        unescaped(F.substring(t, F.instr(t, "\n") + 1, F.lit(1 << 30))).alias("text")))


def read_back(rows: DataFrame) -> DataFrame:
    """(conv_id, n_turns, turns_sha256, loss_chars, loss_sha256, formatted_chars) from the formatted texts and masks alone."""
    turns = parsed_turns(F.col("formatted"))
    masked = F.array_join(F.transform("loss_spans", lambda s: unescaped(
        F.substring(F.col("formatted"), s["start"].cast("int") + 1, s["length"].cast("int")))), "")
    rows = rows.select("conv_id", F.length("formatted").cast("long").alias("formatted_chars"), turns.alias("turns"), masked.alias("learnt"))
    said = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    return rows.select("conv_id", F.size("turns").cast("long").alias("n_turns"), F.sha2(said.cast("binary"), 256).alias("turns_sha256"),
                       F.length("learnt").cast("long").alias("loss_chars"),
                       F.sha2(F.col("learnt").cast("binary"), 256).alias("loss_sha256"), "formatted_chars")


def records_of(rows: DataFrame) -> DataFrame:
    """One JSON record for each conversation of rows (conv_id, turn, role, text), dealt over the layouts by a hash of conv_id.

    A conversation goes into a layout that can hold it: a user and an assistant
    text into any flat one, the same behind a system text into that with a system
    field, all others into the two with a list of turns.  Each record also has an
    id and a source that no mapping reads.  Turns are in the order of (turn,
    role, text), null turns first.  A conversation is one record, as its
    formatted text is one value, so its turns meet in one row; conversations are
    many and spread by conv_id.
    """
    turn = F.struct("turn", F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("content"))
    by = rows.groupBy("conv_id").agg(F.array_sort(F.collect_list(turn)).alias("t"))
    roles, texts = F.col("t.role"), F.col("t.content")
    full = ~F.array_contains(texts, "")
    pair = full & (roles == F.array(F.lit("user"), F.lit("assistant")))
    led = full & (roles == F.array(F.lit("system"), F.lit("user"), F.lit("assistant")))
    first, second, third = (F.get(texts, F.lit(k)) for k in range(3))
    empty = F.lit("")

    def record(**fields: Column) -> Column:
        return F.to_json(F.struct(F.col("conv_id").alias("id"), F.lit("conversations").alias("source"), *[c.alias(k) for k, c in fields.items()]))

    names = F.create_map(F.lit("user"), F.lit("human"), F.lit("assistant"), F.lit("gpt"))
    messages = record(messages=F.transform("t", lambda x: F.struct(x["role"].alias("role"), x["content"].alias("content"), F.lit("n").alias("name"))))
    shared = record(conversations=F.transform("t", lambda x: F.struct(
        F.coalesce(F.try_element_at(names, x["role"]), x["role"]).alias("from"), x["content"].alias("value"))))
    taken = F.arrays_overlap(roles, F.array(*[F.lit(said) for said, _ in SHARED]))
    flat = [record(instruction=first, input=empty, output=second), record(instruction=first, output=second),
            record(prompt=first, completion=second), record(prompt=first, response=second), record(question=first, answer=second),
            record(data=F.struct(first.alias("prompt"), second.alias("response")))]
    dealt = F.pmod(F.xxhash64("conv_id"), F.lit(2 + len(flat)))
    out = F.when((dealt % 2 == 1) & ~taken, shared).otherwise(messages)
    out = F.when(led & (dealt % 3 == 2), record(system=first, instruction=second, input=empty, output=third)).otherwise(out)
    for k, text in enumerate(flat):
        out = F.when(pair & (dealt == k + 2), text).otherwise(out)
    return by.select("conv_id", out.alias("record"))


def format_conversations(rows: DataFrame) -> DataFrame:
    """(conv_id, fingerprint, turns, formatted, loss_spans) of rows (conv_id, turn, role, text).

    Null texts and roles are empty; a null conv_id is one conversation; repeated
    rows are turns of their own; other columns are ignored; an empty table gives
    an empty result.
    """
    return formatted(canonical_turns(records_of(rows.select("conv_id", "turn", "role", "text"))).drop("record"))


def op6_fingerprint_chat(spark, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    kind = {f.name: f.dataType for f in rows.schema}
    more = spark.range(2).select(
        F.lit(-7).cast(kind["conv_id"]).alias("conv_id"), F.col("id").cast(kind["turn"]).alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"), F.lit("</s>[INST] ok [/INST]").alias("text"))
    return read_back(format_conversations(rows.union(more)))


OP6_SQL = r"""
WITH c AS (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
           UNION ALL SELECT -7, 0, 'user', '</s>[INST] ok [/INST]' UNION ALL SELECT -7, 1, 'assistant', '</s>[INST] ok [/INST]'),
e AS (SELECT *, length(regexp_replace(replace(text, '\', '\\'), '<\||<s>|</s>|<<|\[/?INST\]', '\0~', 'g')) AS coded FROM c)
SELECT conv_id, count(*) AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
       CAST(coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
       CAST(sum(coded + length(role) + 24) AS BIGINT) AS formatted_chars
FROM e GROUP BY conv_id
"""
