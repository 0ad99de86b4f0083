"""Operator 3, chat formatting: records of any known layout to canonical, templated turns.

A record is a JSON string. Its fingerprint is a hash of its nested field paths (value types
are left out, so nulls and numbers do not change it), read from the record with its text values
emptied: parsers stop at long texts. Fingerprints select one of the declarative ``LAYOUTS``, each of which says how its fields become an array of (role, text)
turns. The template marks every turn

    <s>[INST] role [/INST] text </s>        (without the spaces)

and escapes control strings inside roles and texts: a backslash is doubled, and one is put
after the first character of a control string. ``unescape`` undoes both, so a formatted
conversation reads back exactly. The loss mask is a list of (start, length) spans, in code
points of the formatted string, over the assistant texts.

Everything is DataFrame expressions. Turns of a conversation are gathered with a partial
aggregation; a conversation is one output row, so its size is that of its own turns. A table of
turns becomes records of every layout that can carry them without loss; texts stay column
values: only the shape of a record is printed as JSON and fingerprinted.

Defined cases: null role or text is empty; a record that is no JSON or of an unknown layout
keeps its row with a null ``layout`` and no turns; turns with equal numbers are ordered by
role, then text, and a null number comes first; rows with a null ``conv_id`` form one
conversation; extra columns of turn tables are not read; an empty table gives no rows.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sparkplate.llm.common import let

BEGIN, END, ROLE_OPEN, ROLE_CLOSE = "<s>", "</s>", "[INST]", "[/INST]"
HEAD = BEGIN + ROLE_OPEN
TURNS = "array<struct<role:string,text:string>>"


# --- layouts ---------------------------------------------------------------------------

@dataclass(frozen=True)
class Layout:
    """``paths``: field-path strings that select it; ``schema``: how its JSON is read;
    ``turns``: (role or role field, text field) pairs, within ``each`` if it names an array."""
    name: str
    paths: tuple[str, ...]
    schema: str
    turns: tuple[tuple[str, str], ...]
    each: str | None = None
    roles: tuple[tuple[str, str], ...] = ()


LAYOUTS = (
    Layout("messages", ("OBJECT<messages: ARRAY<OBJECT<content, role>>>", "OBJECT<messages: ARRAY<VOID>>"),
           "messages array<struct<role:string,content:string>>", (("role", "content"),), "messages"),
    Layout("from_value", ("OBJECT<conversations: ARRAY<OBJECT<from, value>>>",),
           "conversations array<struct<`from`:string,value:string>>", (("from", "value"),), "conversations",
           (("human", "user"), ("gpt", "assistant"))),
    Layout("prompt_completion", ("OBJECT<completion, prompt>",), "prompt string, completion string",
           (("=user", "prompt"), ("=assistant", "completion"))),
    Layout("prompt_response", ("OBJECT<prompt, response>", "OBJECT<prompt, response, system>"),
           "system string, prompt string, response string",
           (("=system?", "system"), ("=user", "prompt"), ("=assistant", "response"))),
    Layout("instruction", ("OBJECT<instruction, output>", "OBJECT<input, instruction, output>"),
           "instruction string, input string, output string",
           (("=user", "instruction+input"), ("=assistant", "output"))),
)


#: A well-formed JSON string; one that is not stays in place, so that the record is no JSON.
_STRING = r'"[^"\\\x00-\x1F]*+(?:\\(?:["\\/bfnrt]|u[0-9A-Fa-f]{4})[^"\\\x00-\x1F]*+)*+"'
_VALUE = rf'\G([^"]*+(?:{_STRING}\s*+:[^"]*+)*+){_STRING}'
_ANY_LENGTH = {"maxStringLen": str(2**31 - 1)}


def field_paths(record: Column) -> Column:
    """Nested field paths of a JSON record, keys in order, value types left out."""
    shape = F.schema_of_variant(F.try_parse_json(F.regexp_replace(record, _VALUE, '$1""')))
    return F.regexp_replace(shape, r": [A-Z]+(\(\d+,\d+\))?(?=[,>])", "")


def fingerprint(record: Column) -> Column:
    return F.xxhash64(field_paths(record))


def _field(row: Column, name: str) -> Column:
    """A text field; ``a+b`` joins two with a blank line, leaving out an empty second one."""
    first, _, second = name.partition("+")
    text = F.coalesce(row[first], F.lit(""))
    if not second:
        return text
    more = F.coalesce(row[second], F.lit(""))
    return F.when(more == "", text).otherwise(F.concat(text, F.lit("\n\n"), more))


def _turns(layout: Layout, record: Column) -> Column:
    return let(F.from_json(record, layout.schema, _ANY_LENGTH), lambda row: _turns_of(layout, row)).cast(TURNS)


def _turns_of(layout: Layout, row: Column) -> Column:
    """The turns of a record that is read already, as a struct of the layout's schema."""
    def turn(row: Column, role: str, text: str) -> Column:
        if role.startswith("="):
            who = F.lit(role.strip("=?"))
        else:
            who = F.coalesce(row[role], F.lit(""))
            for theirs, ours in layout.roles:
                who = F.when(who == theirs, F.lit(ours)).otherwise(who)
        return F.struct(who.alias("role"), _field(row, text).alias("text"))

    if layout.each:
        (role, text), = layout.turns
        items = F.coalesce(row[layout.each], F.array().cast(layout.schema.partition(" ")[2]))
        return F.transform(items, lambda x: turn(x, role, text))
    parts = [F.when(_field(row, text) == "", F.array().cast(TURNS)).otherwise(F.array(turn(row, role, text)))
             if role.endswith("?") else F.array(turn(row, role, text)) for role, text in layout.turns]
    return F.concat(*parts)


def _layout(pick) -> Column:
    """``pick`` of the layout that the fingerprint ``_fp`` selects."""
    chosen = pick(None)
    for known in reversed(LAYOUTS):
        hit = F.lit(False)
        for paths in known.paths:
            hit = hit | F.col("_fp").eqNullSafe(F.xxhash64(F.lit(paths)))
        chosen = F.when(hit, pick(known)).otherwise(chosen)
    return chosen


def _name(known: Layout | None) -> Column:
    return F.lit(known and known.name).cast("string")


def canonical(records: DataFrame, record: str = "record") -> DataFrame:
    """``records`` plus ``layout`` (null if unknown) and canonical ``turns``."""
    own = [c for c in records.columns if c not in ("layout", "turns", "_fp")]
    printed = records.select(*own, fingerprint(F.col(record)).alias("_fp"))
    turns = _layout(lambda known: _turns(known, F.col(record)) if known else F.array().cast(TURNS))
    return printed.select(*own, _layout(_name).alias("layout"), turns.alias("turns"))


def _gathered(turn_rows: DataFrame) -> DataFrame:
    """(conv_id, messages): a table of turns as arrays of the ``messages`` layout."""
    gathered = turn_rows.groupBy("conv_id").agg(F.sort_array(F.collect_list(
        F.struct("turn", F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("content")))).alias("m"))
    return gathered.select("conv_id", F.transform("m", lambda x: F.struct(x["role"].alias("role"), x["content"].alias("content"))).alias("messages"))


def _json(messages: Column) -> Column:
    return F.to_json(F.struct(messages.alias("messages")), {"ignoreNullFields": "false"})


def records_of(turn_rows: DataFrame) -> DataFrame:
    """(conv_id, record): a table of turns as JSON records of the ``messages`` layout."""
    return _gathered(turn_rows).select("conv_id", _json(F.col("messages")).alias("record"))


def _records(messages: Column) -> dict[str, tuple[Column, Column]]:
    """Per layout: whether it carries gathered turns without loss, and the record it would be.

    A record is a struct with the fields of the layout's schema; a field it does not use is null.
    """
    who = F.transform(messages, lambda m: m["role"])
    pair = who == F.array(F.lit("user"), F.lit("assistant"))
    led = (who == F.array(F.lit("system"), F.lit("user"), F.lit("assistant"))) & (F.get(messages, F.lit(0))["content"] != "")

    def text(i: int) -> Column:
        return F.get(messages, F.lit(i))["content"]

    def theirs(role: Column, roles: tuple[tuple[str, str], ...]) -> Column:
        out = role
        for name, ours in roles:
            out = F.when(role == ours, F.lit(name)).otherwise(out)
        return out

    layouts = {x.name: x for x in LAYOUTS}
    names = [name for name, _ in layouts["from_value"].roles]
    gap = F.locate("\n\n", text(0))
    split = (gap > 0) & (F.length(text(0)) > gap + 1)  # an empty second part would not come back
    record = {
        "messages": (F.lit(True), [messages]),
        "from_value": (~F.exists(who, lambda r: r.isin(names)), [F.transform(messages, lambda m: F.struct(
            theirs(m["role"], layouts["from_value"].roles), m["content"]))]),
        "prompt_completion": (pair, [text(0), text(1)]),
        "prompt_response": (pair | led, [F.when(led, text(0)), F.when(led, text(1)).otherwise(text(0)),
                                         F.when(led, text(2)).otherwise(text(1))]),
        "instruction": (pair, [F.when(split, F.substr(text(0), F.lit(1), gap - 1)).otherwise(text(0)),
                               F.when(split, F.substr(text(0), gap + 2)), text(1)]),
    }
    return {name: (fits, F.struct(*[value.cast(kind).alias(field) for value, (field, kind) in zip(values, _fields(layouts[name]))]))
            for name, (fits, values) in record.items()}


def _fields(layout: Layout) -> list[tuple[str, str]]:
    """(name, type) of the top-level fields of a layout's records."""
    return [tuple(field.split(" ", 1)) for field in layout.schema.split(", ")]


def _shape(known: Layout, record: Column) -> Column:
    """JSON of a record with its text values emptied and one turn of its array."""
    empty = F.lit("")
    fields = []
    for field, _ in _fields(known):
        if field == known.each:
            names = known.turns[0]
            kept = F.transform(F.slice(record[field], 1, 1), lambda _: F.struct(*[empty.alias(n) for n in names]))
        else:
            kept = F.when(record[field].isNotNull(), empty)
        fields.append(kept.alias(field))
    return F.to_json(F.struct(*fields))


def heterogeneous(turn_rows: DataFrame, layouts: tuple[str, ...]) -> DataFrame:
    """(conv_id, one column per layout, shape): each conversation as a record of one layout.

    The layout is drawn by a hash of ``conv_id`` among those of ``layouts`` that carry the
    turns without loss (``messages`` always does); the columns of the others are null.
    ``shape`` is the record's JSON without texts.
    """
    gathered = _gathered(turn_rows)
    made = _records(F.col("messages"))
    able = F.filter(F.array(*[F.when(fits, F.lit(name)) for name, (fits, _) in made.items() if name in layouts]), lambda x: x.isNotNull())
    drawn = F.conv(F.substring(F.md5(F.coalesce(F.col("conv_id").cast("string"), F.lit(""))), 1, 7), 16, 10).cast("bigint")
    chosen = gathered.select("conv_id", "messages", let(able, lambda x: F.get(x, (drawn % F.size(x)).cast("int"))).alias("_as"))
    told = chosen.select("conv_id", *[F.when(F.col("_as") == name, record).alias(name) for name, (_, record) in made.items()])
    shape = F.coalesce(*[F.when(F.col(x.name).isNotNull(), _shape(x, F.col(x.name))) for x in LAYOUTS])
    return told.select("*", shape.alias("shape"))


def conversations(turn_rows: DataFrame, layouts: tuple[str, ...] = ("messages",)) -> DataFrame:
    """(conv_id, layout, turns): records of the ``layouts``, mapped back by their fingerprints.

    Works as ``canonical`` does on JSON, but a text stays a column value and is never parsed,
    so its length has no bound.
    """
    printed = heterogeneous(turn_rows, layouts).withColumn("_fp", fingerprint(F.col("shape")))
    lost = F.raise_error(F.lit("a conversation gathered from turns has no layout")).cast(TURNS)
    turns = _layout(lambda known: _turns_of(known, F.col(known.name)).cast(TURNS) if known else lost)
    return printed.select("conv_id", _layout(_name).alias("layout"), turns.alias("turns"))


# --- template --------------------------------------------------------------------------

def escape(text: Column) -> Column:
    doubled = F.regexp_replace(text, r"\\", r"\\\\")
    return F.regexp_replace(doubled, r"<(?=/?s>)|\[(?=/?INST\])", r"$0\\")


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, r"(?s)\\(.)", "$1")


def template(df: DataFrame) -> DataFrame:
    """Replace ``turns`` by ``formatted`` and the ``loss_spans`` of the assistant texts."""
    own = [c for c in df.columns if c not in ("turns", "formatted", "loss_spans")]
    safe = F.transform("turns", lambda t: F.struct((t["role"] == "assistant").alias("learn"),
                                                   F.concat(F.lit(HEAD), escape(t["role"]), F.lit(ROLE_CLOSE)).alias("head"),
                                                   escape(t["text"]).alias("body")))
    spans = "array<struct<start:bigint,length:bigint>>"

    def place(state: Column, t: Column) -> Column:
        start, size = state["at"] + F.length(t["head"]), F.length(t["body"]).cast("bigint")
        mine = F.array(F.struct(start.alias("start"), size.alias("length")))
        return F.struct((start + size + len(END)).alias("at"),
                        F.when(t["learn"], F.concat(state["spans"], mine)).otherwise(state["spans"]).alias("spans"))

    zero = F.struct(F.lit(0).cast("bigint").alias("at"), F.array().cast(spans).alias("spans"))
    made = let(safe, lambda s: F.struct(
        F.array_join(F.transform(s, lambda t: F.concat(t["head"], t["body"], F.lit(END))), "").alias("formatted"),
        F.aggregate(s, zero, place, lambda a: a["spans"]).alias("loss_spans")))
    return df.select(*own, made.alias("_made")).select(*own, "_made.formatted", "_made.loss_spans")


def read_turns(formatted: Column) -> Column:
    """The turns of a formatted conversation, unescaped."""
    parts = F.split(formatted, END)
    bodies = let(parts, lambda p: F.slice(p, 1, F.size(p) - 1))

    def turn(x: Column) -> Column:
        role = F.substring_index(F.substr(x, F.lit(len(HEAD) + 1)), ROLE_CLOSE, 1)
        return let(role, lambda r: F.struct(
            unescape(r).alias("role"),
            unescape(F.substr(x, F.length(r) + len(HEAD) + len(ROLE_CLOSE) + 1)).alias("text")))

    return F.transform(bodies, turn)


def read_loss(formatted: Column, spans: Column) -> Column:
    """All text under the loss mask, unescaped and concatenated in order."""
    return F.array_join(F.transform(spans, lambda s: unescape(
        F.substr(formatted, (s["start"] + 1).cast("int"), s["length"].cast("int")))), "")


def op3_chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = spark.read.parquet(f"{sf_dir}/conversations.parquet").select("conv_id", "turn", "role", "text")
    probe = "</s>[INST] ok [/INST]"
    types = dict(rows.dtypes)
    extra = spark.range(2).select(F.lit(-1).cast(types["conv_id"]).alias("conv_id"), F.col("id").cast(types["turn"]).alias("turn"),
                                  F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"), F.lit(probe).alias("text"))
    done = template(conversations(rows.unionByName(extra), tuple(x.name for x in LAYOUTS)))
    back = done.select("conv_id", "layout", "formatted", read_turns(F.col("formatted")).alias("t"),
                       read_loss(F.col("formatted"), F.col("loss_spans")).alias("loss"))
    told = F.array_join(F.transform("t", lambda x: F.concat(x["role"], F.lit("\n"), x["text"], F.lit("\n"))), "")
    return back.select("conv_id", "layout", F.size("t").cast("bigint").alias("n_turns"), F.sha2(told, 256).alias("turns_sha256"),
                       F.length("loss").cast("bigint").alias("loss_chars"), F.sha2("loss", 256).alias("loss_sha256"),
                       F.length("formatted").cast("bigint").alias("formatted_chars"))


ORACLE_SQL = r"""
WITH c AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -1, 0, 'user', '</s>[INST] ok [/INST]' UNION ALL SELECT -1, 1, 'assistant', '</s>[INST] ok [/INST]'),
x AS (
  SELECT *, role || text AS s FROM c),
e AS (
  SELECT *, length(s) + (length(s) - length(replace(s, '\', '')))
    + (length(role) - length(replace(role, '<s>', '')) + length(text) - length(replace(text, '<s>', ''))) // 3
    + (length(role) - length(replace(role, '</s>', '')) + length(text) - length(replace(text, '</s>', ''))) // 4
    + (length(role) - length(replace(role, '[INST]', '')) + length(text) - length(replace(text, '[INST]', ''))) // 6
    + (length(role) - length(replace(role, '[/INST]', '')) + length(text) - length(replace(text, '[/INST]', ''))) // 7
    + 20 AS n FROM x),
g AS (
  SELECT conv_id, list(role ORDER BY turn NULLS FIRST, role, text) AS who,
         first(text ORDER BY turn NULLS FIRST, role, text) AS opening FROM c GROUP BY conv_id),
able AS (
  SELECT conv_id, [x FOR x IN [
      'messages', CASE WHEN NOT list_has_any(who, ['human', 'gpt']) THEN 'from_value' END,
      CASE WHEN who = ['user', 'assistant'] THEN 'prompt_completion' END,
      CASE WHEN who = ['user', 'assistant'] OR (who = ['system', 'user', 'assistant'] AND opening <> '') THEN 'prompt_response' END,
      CASE WHEN who = ['user', 'assistant'] THEN 'instruction' END] IF x IS NOT NULL] AS names FROM g),
l AS (
  SELECT conv_id, names[1 + ('0x' || substr(md5(coalesce(conv_id::VARCHAR, '')), 1, 7))::BIGINT % len(names)] AS layout FROM able)
SELECT e.conv_id, any_value(layout) AS layout, count(*)::BIGINT AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
       coalesce(sum(length(text)) FILTER (WHERE role = 'assistant'), 0)::BIGINT AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (WHERE role = 'assistant'), '')) AS loss_sha256,
       sum(n)::BIGINT AS formatted_chars
FROM e JOIN l ON e.conv_id IS NOT DISTINCT FROM l.conv_id GROUP BY e.conv_id
"""
