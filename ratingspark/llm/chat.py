"""Chat formatting from heterogeneous records by schema fingerprints.

A record is a JSON text. Its fingerprint is a hash of its nested field paths
(names and nesting, not values or scalar types), read from the parsed value by
Spark. A table of declarative mappings, keyed by fingerprint, says how a
layout becomes turns: which array holds them or which fields are turns of
which role. All records go through the same expressions on the JVM.

A turn is formatted as ``<|im_start|>role\\ntext<|im_end|>\\n``. Inside texts
and roles every ``<`` that is followed by backslashes and ``|`` gets one more
backslash, which is undone when reading back, so no text can hold a control
string. Percent signs and line ends in roles are percent-encoded. The output
has one segment per turn with the span of its assistant text: the loss mask.
Segments of a conversation in order are its formatted text; they are never
concatenated into one value, so a conversation of any length is formatted,
read back and hashed as a stream.

Defined cases: NULL texts and roles are empty; NULL turns sort first; equal
turn numbers are ordered by role, then text; a record that is no JSON object
or has an unknown layout gives one row with NULL ``layout``, role and text
from ``turns`` (for the caller to count or drop); a record whose array is
empty gives no turns; an empty table gives an empty result. Spark parses no
JSON string over 20,000,000 characters: a record with one counts as no JSON
object, so records made from rows keep long values beside the record (``flat_records``).
"""

from __future__ import annotations

import hashlib
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

START, END = "<|im_start|>", "<|im_end|>"


@dataclass(frozen=True)
class Mapping:
    """``paths``: the layout's nested fields in Spark's notation, scalars as
    ``*``. Either ``array`` with the ``role`` and ``text`` fields of its
    elements, or ``fields``: (role, names whose values a blank line joins), or
    ``flat``: the (turn, role, text) fields of a record that is one turn.
    ``roles`` renames roles."""

    name: str
    paths: str
    array: str | None = None
    role: str = "role"
    text: str = "content"
    fields: tuple[tuple[str, tuple[str, ...]], ...] = ()
    flat: tuple[str, str, str] | None = None
    roles: tuple[tuple[str, str], ...] = ()

    @property
    def fingerprint(self) -> str:
        return hashlib.md5(self.paths.encode()).hexdigest()


# The layouts known by default.
MAPPINGS = (
    Mapping("messages", "OBJECT<messages: ARRAY<OBJECT<content: *, role: *>>>", array="messages"),
    Mapping("conversations", "OBJECT<conversations: ARRAY<OBJECT<from: *, value: *>>>", array="conversations",
            role="from", text="value", roles=(("human", "user"), ("gpt", "assistant"))),
    Mapping("instruction with input", "OBJECT<input: *, instruction: *, output: *>",
            fields=(("user", ("instruction", "input")), ("assistant", ("output",)))),
    Mapping("instruction", "OBJECT<instruction: *, output: *>",
            fields=(("user", ("instruction",)), ("assistant", ("output",)))),
    Mapping("prompt and completion", "OBJECT<completion: *, prompt: *>",
            fields=(("user", ("prompt",)), ("assistant", ("completion",)))),
    Mapping("prompt and response", "OBJECT<prompt: *, response: *>",
            fields=(("user", ("prompt",)), ("assistant", ("response",)))),
    Mapping("system, prompt and response", "OBJECT<prompt: *, response: *, system: *>",
            fields=(("system", ("system",)), ("user", ("prompt",)), ("assistant", ("response",)))),
    Mapping("turn", "OBJECT<role: *, text: *, turn: *>", flat=("turn", "role", "text")),
)

TURN = "struct<turn:bigint,role:string,text:string>"

# Longer roles and texts of rows are carried beside their record.
LONG = 1_000_000
ASIDE = "struct<role:string,text:string>"


def fingerprint(value: Column) -> Column:
    """The hash of the nested field paths of a parsed JSON value."""
    scalars = r"(?<=: |ARRAY<)(?!OBJECT<|ARRAY<)[A-Z_]+(\([0-9]+,[0-9]+\))?"
    return F.md5(F.regexp_replace(F.schema_of_variant(value), scalars, "*"))


def _turns_of(m: Mapping, value: Column) -> Column:
    """array<TURN> of a record in layout ``m``."""
    get = lambda path, kind="string": F.try_variant_get(value, f"$.{path}", kind)

    def named(role: Column) -> Column:
        for a, b in m.roles:
            role = F.when(role == a, F.lit(b)).otherwise(role)
        return role

    if m.array:
        items = get(m.array, f"array<struct<`{m.role}`:string,`{m.text}`:string>>")
        out = F.transform(items, lambda x, i: F.struct(i.cast("bigint").alias("turn"), named(x[m.role]).alias("role"),
                                                       x[m.text].alias("text")))
    elif m.flat:
        turn, role, text = m.flat
        out = F.array(F.struct(get(turn, "bigint").alias("turn"), named(get(role)).alias("role"),
                               get(text).alias("text")))
    else:
        out = F.array(*[F.struct(F.lit(i).cast("bigint").alias("turn"), F.lit(role).alias("role"),
                                 F.concat_ws("\n\n", *[F.when(get(f) != "", get(f)) for f in names]).alias("text"))
                        for i, (role, names) in enumerate(m.fields)])
    return out.cast(f"array<{TURN}>")


def flat_records(rows: DataFrame, key: str) -> DataFrame:
    """Rows (key, turn, role, text) as records of one turn: key, record, and
    ``aside`` with the role and text that are too long for the record."""
    own = lambda c: F.when(F.length(c) <= LONG, F.col(c)).alias(c)
    rest = lambda c: F.when(F.length(c) > LONG, F.col(c)).alias(c)
    return rows.select(F.col(f"`{key}`").alias(key),
                       F.to_json(F.struct("turn", own("role"), own("text")), {"ignoreNullFields": "false"}).alias("record"),
                       F.struct(rest("role"), rest("text")).alias("aside"))


def turns(records: DataFrame, key: str, record: str = "record", mappings=MAPPINGS, aside: str | None = None) -> DataFrame:
    """Canonical turns of JSON records: key, layout, turn, role, text. Values
    of the column ``aside`` stand for those that the record leaves out."""
    beside = F.col(f"`{aside}`") if aside else F.lit(None).cast(ASIDE)
    parsed = records.select(F.col(f"`{key}`").alias("key"), F.try_parse_json(F.col(f"`{record}`")).alias("value"),
                            beside.alias("beside"))
    parsed = parsed.withColumn("print", fingerprint(F.col("value")))
    none = F.array(F.lit(None).cast(TURN))
    layout, found = F.lit(None).cast("string"), none
    for m in mappings:
        hit = F.col("print") == m.fingerprint
        layout = F.when(hit, F.lit(m.name)).otherwise(layout)
        found = F.when(hit, _turns_of(m, F.col("value"))).otherwise(found)
    return (parsed.select("key", "beside", layout.alias("layout"), F.explode(found).alias("t"))
                  .select(F.col("key").alias(key), "layout", "t.turn", F.coalesce("beside.role", "t.role").alias("role"),
                          F.coalesce("beside.text", "t.text").alias("text")))


def escape(c: Column) -> Column:
    return F.regexp_replace(c, r"<(\\*)\|", r"<\\$1|")


def unescape(c: Column) -> Column:
    return F.regexp_replace(c, r"<\\(\\*)\|", r"<$1|")


def format_turns(turns_: DataFrame, key: str, learn: str = "assistant") -> DataFrame:
    """One segment per turn: key, turn, segment, and loss_start, loss_length
    (code points of the segment under the loss mask; NULL for other roles)."""
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    safe = escape(F.regexp_replace(F.regexp_replace(role, "%", "%25"), "\n", "%0A"))
    head = F.concat(F.lit(START), safe, F.lit("\n"))
    body = escape(text)
    learnt = role == learn
    return turns_.select(F.col(f"`{key}`").alias(key), "turn", F.concat(head, body, F.lit(END + "\n")).alias("segment"),
                         F.when(learnt, F.length(head)).cast("bigint").alias("loss_start"),
                         F.when(learnt, F.length(body)).cast("bigint").alias("loss_length"))


def read_turns(segments: DataFrame, key: str) -> DataFrame:
    """Turns read back from formatted segments: key, turn, role, text,
    loss_text (NULL outside the mask), segment_chars. A segment that is not
    exactly one marked turn gives NULL role and text."""
    s = F.col("segment")
    line = F.locate("\n", s)
    role = F.substring(s, F.lit(len(START) + 1), line - len(START) - 1)
    text = F.substring(s, line + 1, F.length(s) - line - len(END) - 1)
    sound = (s.startswith(START) & s.endswith(END + "\n") & (F.locate(START, s, 2) == 0)
             & (F.locate(END, s) == F.length(s) - len(END)))
    plain = F.regexp_replace(F.regexp_replace(unescape(role), "%0A", "\n"), "%25", "%")
    loss = F.substring(s, F.col("loss_start") + 1, F.col("loss_length"))
    return segments.select(key, "turn", F.when(sound, plain).alias("role"), F.when(sound, unescape(text)).alias("text"),
                           F.when(sound, unescape(loss)).alias("loss_text"),
                           F.length(s).cast("bigint").alias("segment_chars"))


def _hash_stream(batches):
    """Rows sorted by key and turn -> one row per key. Keeps one running hash;
    a key's rows may span any number of batches."""
    done = object()
    state = [done, 0, None, 0, None, 0]

    def result():
        return pa.RecordBatch.from_pylist(
            [{"key": state[0], "n_turns": state[1], "turns_sha256": state[2].hexdigest(), "loss_chars": state[3],
              "loss_sha256": state[4].hexdigest(), "formatted_chars": state[5]}], schema=schema)

    schema = None
    for batch in batches:
        schema = schema or pa.schema([("key", batch.schema.field("key").type), ("n_turns", pa.int64()),
                                      ("turns_sha256", pa.string()), ("loss_chars", pa.int64()),
                                      ("loss_sha256", pa.string()), ("formatted_chars", pa.int64())])
        rows = []
        for r in batch.to_pylist():
            if state[0] is done or r["key"] != state[0]:
                if state[0] is not done:
                    rows.append(result())
                state[:] = [r["key"], 0, hashlib.sha256(), 0, hashlib.sha256(), 0]
            state[1] += 1
            state[2].update(f"{r['role']}\n{r['text']}\n".encode())
            state[5] += r["segment_chars"]
            if r["loss_text"] is not None:
                state[3] += len(r["loss_text"])
                state[4].update(r["loss_text"].encode())
        if rows:
            yield pa.Table.from_batches(rows).combine_chunks().to_batches()[0]
    if state[0] is not done:
        yield result()


def conversation_digests(read: DataFrame, key: str) -> DataFrame:
    """One row per conversation of turns that were read back: key, n_turns,
    turns_sha256, loss_chars, loss_sha256, formatted_chars."""
    key_type = read.schema[key].dataType.simpleString()
    ordered = (read.withColumnRenamed(key, "key").repartition("key")
                   .sortWithinPartitions("key", "turn", "role", "text"))
    return ordered.mapInArrow(_hash_stream, f"key {key_type}, n_turns bigint, turns_sha256 string, loss_chars bigint, "
                                            "loss_sha256 string, formatted_chars bigint").withColumnRenamed("key", key)
