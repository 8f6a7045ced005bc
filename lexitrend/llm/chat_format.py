"""Chat formatting: layouts found by schema fingerprint, canonical turns, reversible template.

The nested field paths of a schema (or of one JSON record) that any mapping knows are
sorted and hashed; the fingerprint selects a declarative mapping that says where
conversation, position, role and text are.  If no mapping has that very fingerprint, the
one with the most fields among those whose fields are all there is taken (ties: registry
order); without one, table input raises and a JSON record gives no turns but is counted.

The template marks turns; control strings inside texts get a backslash after their first
character (one more where there are some), which ``unescape`` takes away again.

Defined results: null role or text is empty; turns of one conversation come by turn (null
first), then role, then text, repeated rows included; a null conv_id is a conversation of
its own; extra columns are not read; an empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
import json
import re
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import ready, schema


@dataclass(frozen=True)
class Mapping:
    """Where a layout keeps things.  ``each``: the array that holds one element per turn, its
    fields then are ``role`` and ``text``; without it, ``turns`` lists (role, field) in order,
    or, with ``role`` set, each record is one turn."""
    name: str
    conv: str = "conv_id"
    turn: str = ""
    each: str = ""
    role: str = ""
    text: str = ""
    turns: tuple[tuple[str, str], ...] = ()
    optional: tuple[str, ...] = ()

    def paths(self) -> frozenset[str]:
        if self.each:
            return frozenset([f"{self.each}[].{self.role}", f"{self.each}[].{self.text}"])
        if self.turns:
            return frozenset(f for _, f in self.turns if f not in self.optional)
        return frozenset([self.turn, self.role, self.text])


MAPPINGS = (
    Mapping("turn_rows", turn="turn", role="role", text="text"),
    Mapping("messages", each="messages", role="role", text="content"),
    Mapping("from_value", each="conversations", role="from", text="value"),
    Mapping("instruction_input", turns=(("system", "system"), ("user", "instruction"), ("user", "input"),
                                        ("assistant", "output")), optional=("system", "input")),
    Mapping("prompt_response", turns=(("user", "prompt"), ("assistant", "response"))),
    Mapping("prompt_completion", turns=(("user", "prompt"), ("assistant", "completion"))),
    Mapping("question_answer", turns=(("user", "question"), ("assistant", "answer"))),
)
#: Role names of nested layouts, as canonical ones; others, and those of turn rows, stay as they are.
ROLES = {"human": "user", "gpt": "assistant", "bot": "assistant", "model": "assistant"}

BEGIN, END = "<|im_start|>", "<|im_end|>\n"
#: Control strings of this and other templates: first character, then the rest.
CONTROL = r"([<\[])(\\*)(\|im_start\|>|\|im_end\|>|\|endoftext\|>|/?s>|/?INST\]|</?SYS>>)"
_ESCAPED = re.compile(CONTROL.replace(r"(\\*)", r"\\(\\*)"))
_TURN = re.compile(r"<\|im_start\|>([^\n]*)\n(.*?)<\|im_end\|>\n", re.DOTALL)


def schema_paths(kind: T.DataType, at: str = "") -> set[str]:
    """Nested field paths; ``[]`` stands for the elements of an array."""
    if isinstance(kind, T.StructType):
        return set().union(*(schema_paths(f.dataType, f"{at}.{f.name}" if at else f.name) for f in kind.fields), set())
    if isinstance(kind, T.ArrayType):
        return schema_paths(kind.elementType, f"{at}[]")
    return {at}


def value_paths(value, at: str = "") -> set[str]:
    """The same for a parsed JSON value."""
    if isinstance(value, dict):
        return set().union(*(value_paths(v, f"{at}.{k}" if at else k) for k, v in value.items()), set())
    if isinstance(value, list):
        return set().union(*(value_paths(v, f"{at}[]") for v in value), set())
    return {at}


def fingerprint(paths) -> str:
    return hashlib.sha256("\n".join(sorted(paths)).encode()).hexdigest()


class Registry:
    """Mappings by the fingerprint of their paths."""

    def __init__(self, mappings: tuple[Mapping, ...] = MAPPINGS):
        self.mappings = mappings
        self.known = frozenset().union(*(m.paths() | set(m.optional) for m in mappings))
        self.by_print = {}
        for m in mappings:
            self.by_print.setdefault(fingerprint(m.paths()), m)
            self.by_print.setdefault(fingerprint(m.paths() | set(m.optional)), m)

    def find(self, paths: set[str]) -> tuple[str, Mapping | None]:
        """(fingerprint of the known paths among these, its mapping)."""
        mark = fingerprint(paths & self.known)
        if mark not in self.by_print:
            fit = [m for m in self.mappings if m.paths() <= paths]
            self.by_print[mark] = max(fit, key=lambda m: len(m.paths()), default=None)
        return mark, self.by_print[mark]


def _canonical_role(role):
    low = F.coalesce(role.cast("string"), F.lit(""))
    out = low
    for a, b in ROLES.items():
        out = F.when(low == a, b).otherwise(out)
    return out


def turns_of_table(df: DataFrame, registry: Registry | None = None) -> DataFrame:
    """(conv_id, turn, role, text) of a table in any registered layout."""
    mark, m = (registry or Registry()).find(schema_paths(df.schema))
    if m is None:
        raise ValueError(f"no mapping for the layout {mark}: {sorted(schema_paths(df.schema))}")
    conv = F.col(m.conv).alias("conv_id") if m.conv in df.columns else F.lit(None).cast("long").alias("conv_id")
    if m.each:
        e = df.select(conv, F.posexplode(F.col(m.each)).alias("turn", "e"))
        rows = e.select("conv_id", "turn", F.col(f"e.{m.role}").alias("role"), F.col(f"e.{m.text}").alias("text"))
    elif m.turns:
        there = [(k, r, f) for k, (r, f) in enumerate(m.turns) if f in df.columns]
        parts = F.array(*[F.struct(F.lit(k).alias("turn"), F.lit(r).alias("role"), F.col(f).cast("string").alias("text"),
                                   F.lit(f in m.optional).alias("optional")) for k, r, f in there])
        e = df.select(conv, F.explode(parts).alias("e"))
        e = e.where(~F.col("e.optional") | (F.coalesce("e.text", F.lit("")) != ""))
        rows = e.select("conv_id", "e.turn", "e.role", "e.text")
    else:
        rows = df.select(conv, F.col(m.turn).alias("turn"), F.col(m.role).alias("role"), F.col(m.text).alias("text"))
    role = _canonical_role(F.col("role")) if m.each or m.turns else F.coalesce(F.col("role").cast("string"), F.lit(""))
    return rows.select("conv_id", F.col("turn").cast("long").alias("turn"), role.alias("role"),
                       F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))


def turns_of_json(df: DataFrame, record: str = "record", conv: str = "conv_id",
                  registry: Registry | None = None) -> DataFrame:
    """(conv_id, fingerprint, mapping, turn, role, text) of mixed JSON records, one layout per
    record; records without a mapping, or that are not JSON objects, give one row with null turn."""
    ready(df.sparkSession)
    registry = registry or Registry()

    def turns(value: dict, m: Mapping):
        if m.each:
            for e in value.get(m.each) or []:
                yield (e or {}).get(m.role), (e or {}).get(m.text)
        elif m.turns:
            for r, f in m.turns:
                if f in value and (f not in m.optional or value[f] not in (None, "")):
                    yield r, value[f]
        else:
            yield value.get(m.role), value.get(m.text)

    def said(x) -> str:
        return "" if x is None else x if isinstance(x, str) else json.dumps(x, ensure_ascii=False)

    def run(batches):
        for b in batches:
            cols = [[], [], [], [], [], []]
            for c, r in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                try:
                    value = json.loads(r or "null")
                except ValueError:
                    value = None
                mark, m = registry.find(value_paths(value)) if isinstance(value, dict) else (None, None)
                rows = [(k, *x) for k, x in enumerate(turns(value, m))] if m else []
                for k, role, text in rows or [(None, None, None)]:
                    if m and not (m.each or m.turns):
                        k = value.get(m.turn)
                    role = None if not rows else said(role) if not (m.each or m.turns) else ROLES.get(said(role), said(role))
                    out = (c, mark, m.name if m else None, k, role, said(text) if rows else None)
                    for a, v in zip(cols, out, strict=True):
                        a.append(v)
            kinds = [b.schema.field(0).type, pa.string(), pa.string(), pa.int64(), pa.string(), pa.string()]
            yield pa.RecordBatch.from_arrays([pa.array(a, k) for a, k in zip(cols, kinds, strict=True)],
                                             ["conv_id", "fingerprint", "mapping", "turn", "role", "text"])

    return df.select(F.col(conv), F.col(record)).mapInArrow(
        run, schema(("conv_id", df.schema[conv].dataType),
                    "fingerprint string, mapping string, turn long, role string, text string"))


def _escape(c):
    return F.regexp_replace(c, CONTROL, r"$1\\$2$3")


def unescape(s: str) -> str:
    return _ESCAPED.sub(r"\1\2\3", s)


def format_turns(turns: DataFrame) -> DataFrame:
    """(conv_id, turn, role, text) to (conv_id, turn, piece, loss_start, loss_end): the formatted
    text of a conversation is its pieces in order, the loss mask is on the code points from
    loss_start to loss_end of a piece (empty unless the assistant speaks)."""
    head = F.regexp_replace(F.regexp_replace(F.col("role"), r"\\", r"\\\\"), "\n", r"\\n")
    head = F.concat(F.lit(BEGIN), _escape(head), F.lit("\n"))
    rows = turns.select("conv_id", "turn", "role", head.alias("head"), _escape(F.col("text")).alias("body"))
    spoken = F.col("role") == "assistant"
    start = F.length("head")
    return rows.select("conv_id", "turn", F.concat("head", "body", F.lit(END)).alias("piece"),
                       F.when(spoken, start).otherwise(0).alias("loss_start"),
                       F.when(spoken, start + F.length("body")).otherwise(0).alias("loss_end"))


def parse_piece(piece: str) -> list[tuple[str, str]]:
    """(role, text) of every turn in formatted text."""
    out, at = [], 0
    for m in _TURN.finditer(piece):
        if m.start() != at:
            raise ValueError("text between turns")
        role = re.sub(r"\\(.)", lambda x: "\n" if x[1] == "n" else x[1], unescape(m[1]))
        out.append((role, unescape(m[2])))
        at = m.end()
    if at != len(piece):
        raise ValueError("text after the last turn")
    return out


def read_back(pieces: DataFrame) -> DataFrame:
    """One row per conversation, read from its formatted pieces alone: n_turns, turns_sha256 (role,
    newline, text, newline per turn), loss_chars, loss_sha256 (the text under the loss mask,
    unescaped), formatted_chars.  Rows stream through in order, so a conversation of any length
    needs no more memory than one batch."""
    ready(pieces.sparkSession, 2048)
    kind = pieces.schema["conv_id"].dataType
    # of one turn by role and text: neither the closing mark nor escapes take part
    said = F.substr(F.col("piece"), F.lit(len(BEGIN) + 1), F.length("piece") - len(BEGIN) - len(END))
    said = F.regexp_replace(said, _ESCAPED.pattern, "$1$2$3")
    rows = pieces.repartition("conv_id").sortWithinPartitions("conv_id", "turn", said)

    def run(batches):
        key, now, first = None, None, True

        def batch(done, conv_type):
            cols = list(zip(*done, strict=True))
            kinds = [conv_type, pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64()]
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds, strict=True)], OUT)

        def closed():
            return (key, now[0], now[1].hexdigest(), now[2], now[3].hexdigest(), now[4])

        for b in batches:
            done = []
            conv_type = b.schema.field(0).type
            for conv, piece, s, e in zip(*(b.column(k).to_pylist() for k in range(4)), strict=True):
                if first or conv != key:
                    if not first:
                        done.append(closed())
                    key, now, first = conv, [0, hashlib.sha256(), 0, hashlib.sha256(), 0], False
                for role, text in parse_piece(piece):
                    now[0] += 1
                    now[1].update(f"{role}\n{text}\n".encode())
                loss = unescape(piece[s:e])
                now[2] += len(loss)
                now[3].update(loss.encode())
                now[4] += len(piece)
            if done:
                yield batch(done, conv_type)
        if not first:
            yield batch([closed()], conv_type)

    return rows.select("conv_id", "piece", "loss_start", "loss_end").mapInArrow(
        run, schema(("conv_id", kind), "n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, "
                                       "formatted_chars long"))


OUT = ["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"]


def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    from ..sources.tables import table
    rows = turns_of_table(table(spark, sf_dir, "conversations"))
    ok = "</s>[INST] ok [/INST]"
    planted = spark.createDataFrame([(-7, [("user", ok), ("assistant", ok)])],
                                    "conv_id long, messages array<struct<role string, content string>>")
    return read_back(format_turns(rows.unionByName(turns_of_table(planted))))


def _escaped_sql(x: str) -> str:
    return f"regexp_replace({x}, '{CONTROL}', '\\1\\\\\\2\\3', 'g')"


_HEAD_SQL = "replace(replace(role, '\\', '\\\\'), chr(10), '\\n')"
_ORDER_SQL = "ORDER BY turn NULLS FIRST, role, text"
ORACLE = f"""
WITH r AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '</s>[INST] ok [/INST]' UNION ALL SELECT -7, 1, 'assistant', '</s>[INST] ok [/INST]')
SELECT conv_id, count(*) AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' {_ORDER_SQL})) AS turns_sha256,
       CAST(sum(CASE WHEN role = 'assistant' THEN length(text) ELSE 0 END) AS BIGINT) AS loss_chars,
       sha256(coalesce(string_agg(CASE WHEN role = 'assistant' THEN text END, '' {_ORDER_SQL}), '')) AS loss_sha256,
       CAST(sum({len(BEGIN)} + length({_escaped_sql(_HEAD_SQL)}) + 1 + length({_escaped_sql("text")}) + {len(END)}) AS BIGINT)
         AS formatted_chars
FROM r GROUP BY conv_id
"""
