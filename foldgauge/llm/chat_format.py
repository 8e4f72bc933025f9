"""Chat formatting with typed content parts (operator 11).

A turn is a list of parts: text, image, audio or document. A visitor, one method for each type, flattens them in order with built-in functions: a text
part is escaped, any other becomes a placeholder such as ``<|image|>`` and an attachment record (kind, ref, source, tokens) with the
number of tokens that the placeholder stands for; the k-th placeholder of a turn is its k-th attachment. Plain texts are cut
into parts at Markdown links to image, audio and document files (``text_parts``). Turns are marked ``<|im_start|>role``, newline,
content, ``<|im_end|>``, newline; the loss mask covers the content of the assistant's turns.

Escaping: a control string (CONTROL: the marks of this and of other common templates) is broken by a backslash behind its first character; one that
already has backslashes there gets one more, so taking one away restores every text exactly. Two text parts in a row are kept apart by
``<|text|>``, so no control string arises at their border. In roles, backslashes and newlines are escaped as well.

One shuffle sorts the rows by range over (conversation, turn), so a long conversation lies in many tasks; there turns are formatted row by row and
assembled into parts of at most ``part_chars`` characters (or one turn) with loss spans and attachments. Nothing holds a
conversation whole. ``read_back`` parses such parts: a conversation that is one part inside a task is finished there, the parts of others
are brought together in order and streamed through their digests, which are chains, in constant memory.

Nulls: a null text, part or list of parts is empty, a null role is an empty role, null turns come first, null ids are one conversation. Rows of the same
turn go by role, then by a hash of their content; repeated rows are turns of their own. Parts of unknown types are documents. Other columns are ignored; an
empty table gives no rows.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from foldgauge.llm.common import arrow_rows
from foldgauge.llm.registry import query, table
from foldgauge.session import materialize

START, END, JOINT = "<|im_start|>", "<|im_end|>", "<|text|>"
KINDS = ("image", "audio", "document")
PART_CHARS = 1 << 20
ASSISTANT = "assistant"

#: What may follow ``<`` or ``[`` in a control string. None of these holds ``<`` or ``[``, so none can overlap another.
CONTROL = r"(?:\||/?s>|/?INST\]|/?SYS>>|unk>|pad>|bos>|eos>|start_of_turn>|end_of_turn>)"
TO_ESCAPE = rf"([<\[])(\\*{CONTROL})"
ESCAPED = rf"([<\[])\\(\\*{CONTROL})"

#: Endings of files that plain texts link to.
ENDINGS = {"image": "png|jpg|jpeg|gif|webp", "audio": "wav|mp3|flac|ogg", "document": "pdf|docx|pptx|html|csv"}
_LINK = r"!?\[[^\]\[\n]*\]\([^()\s]+\.(?:%s)\)"
ANY_LINK = _LINK % "|".join(ENDINGS.values())

#: Tokens of a part whose size is not known, and the units that known sizes are counted in.
IMAGE_TOKENS, PATCH = 576, 14
AUDIO_TOKENS, TOKENS_A_SECOND = 750, 25
PAGE_TOKENS = 512

PART = "struct<type:string,text:string,ref:string,width:int,height:int,seconds:double,pages:int>"
ATTACHMENT = "struct<kind:string,ref:string,source:string,tokens:bigint>"


def escaped(text: Column) -> Column:
    return F.regexp_replace(text, F.lit(TO_ESCAPE), F.lit(r"$1\\$2"))


def unescaped(text: str) -> str:
    return _UNESCAPE.sub(r"\1\2", text)


_UNESCAPE = re.compile(ESCAPED)
_ROLE = re.compile(r"\\(.)")
_TURN = re.compile(r"<\|im_start\|>([^\n]*)\n(.*?)<\|im_end\|>\n", re.DOTALL)
_HOLES = re.compile(r"<\|(text|image|audio|document)\|>")


class PartVisitor:
    """One method for each type of part; each gives (content, attachment) as a struct."""

    def _flat(self, content: Column, attachment: Column | None = None) -> Column:
        none = F.lit(None).cast(ATTACHMENT)
        return F.struct(content.alias("content"), (none if attachment is None else attachment).alias("attachment"))

    def _held(self, kind: str, part: Column, tokens: Column) -> Column:
        record = F.struct(F.lit(kind).alias("kind"), part["ref"].alias("ref"), part["text"].alias("source"), tokens.cast("long").alias("tokens"))
        return self._flat(F.lit(f"<|{kind}|>"), record.cast(ATTACHMENT))

    def text(self, part: Column, before: Column) -> Column:
        joint = F.when(before == "text", F.lit(JOINT)).otherwise(F.lit(""))
        return self._flat(F.concat(joint, escaped(F.coalesce(part["text"], F.lit("")))))

    def image(self, part: Column) -> Column:
        known = (part["width"] > 0) & (part["height"] > 0)
        return self._held("image", part, F.when(known, F.ceil(part["width"] / PATCH) * F.ceil(part["height"] / PATCH)).otherwise(F.lit(IMAGE_TOKENS)))

    def audio(self, part: Column) -> Column:
        return self._held("audio", part, F.when(part["seconds"] >= 0, F.ceil(part["seconds"] * TOKENS_A_SECOND)).otherwise(F.lit(AUDIO_TOKENS)))

    def document(self, part: Column) -> Column:
        return self._held("document", part, F.when(part["pages"] > 0, part["pages"].cast("long")).otherwise(F.lit(1)) * PAGE_TOKENS)

    def visit(self, part: Column, before: Column) -> Column:
        kind = part["type"]
        flat = F.when(kind == "text", self.text(part, before)).when(kind == "image", self.image(part)).when(kind == "audio", self.audio(part))
        return flat.otherwise(self.document(part))


def text_parts(text: Column) -> Column:
    """The parts of a plain text: links to image, audio and document files apart from the text between them."""
    whole = F.coalesce(text, F.lit(""))

    def part(kind: Column, content: Column, ref: Column) -> Column:
        fields = [kind.alias("type"), content.alias("text"), ref.alias("ref"), *(F.lit(None).alias(x) for x in ("width", "height", "seconds", "pages"))]
        return F.struct(*fields).cast(PART)

    def both(between: Column, link: Column) -> Column:
        ref = F.regexp_extract(link, r"\(([^()\s]+)\)\z", 1)
        ending = F.lower(F.substring_index(ref, ".", -1))
        kind = F.when(ending.isin(ENDINGS["image"].split("|")), "image").when(ending.isin(ENDINGS["audio"].split("|")), "audio")
        after = F.when(link.isNotNull(), part(kind.otherwise("document"), link, ref))
        return F.array(F.when(between != "", part(F.lit("text"), between, F.lit(None).cast("string"))), after)

    links = F.regexp_extract_all(whole, F.lit(f"({ANY_LINK})"), F.lit(1))
    cut = F.array_compact(F.flatten(F.zip_with(F.split(whole, ANY_LINK, -1), links, both)))
    plain = F.array(part(F.lit("text"), whole, F.lit(None).cast("string")))
    return F.when(F.contains(whole, F.lit("](")), cut).otherwise(plain)


def formatted_turns(rows: DataFrame, visitor: PartVisitor | None = None) -> DataFrame:
    """(conv, formatted, loss_start, loss_end, attachments, tokens) of each (conv, role, parts), built-in functions only, row order kept."""
    visitor = visitor or PartVisitor()
    role = F.coalesce("role", F.lit(""))
    line = escaped(F.replace(F.replace(role, F.lit("\\"), F.lit("\\\\")), F.lit("\n"), F.lit("\\n")))
    given = F.filter(F.coalesce("parts", F.array().cast(f"array<{PART}>")), lambda p: p.isNotNull())
    staged = rows.select("conv", role.alias("role"), F.concat(F.lit(START), line, F.lit("\n")).alias("head"), given.alias("parts"))
    flat = F.transform("parts", lambda p, i: visitor.visit(p, F.try_element_at("parts", F.nullif(i, F.lit(0)))["type"]))
    staged = staged.select("conv", "role", "head", flat.alias("flat"))
    staged = staged.select("conv", "role", "head", F.array_join("flat.content", "").alias("content"), F.array_compact("flat.attachment").alias("attachments"))
    starts, ends = F.char_length("head"), F.char_length("head") + F.char_length("content")
    learned = F.col("role") == ASSISTANT
    return staged.select(
        "conv",
        F.concat("head", "content", F.lit(f"{END}\n")).alias("formatted"),
        F.when(learned, starts).cast("long").alias("loss_start"),
        F.when(learned, ends).cast("long").alias("loss_end"),
        "attachments",
        F.aggregate("attachments", F.lit(0).cast("long"), lambda total, a: total + a["tokens"]).alias("tokens"),
    )


def _packed(rows: list[tuple], names: list[str], types: list[pa.DataType]) -> pa.RecordBatch:
    columns = list(zip(*rows, strict=True)) if rows else [()] * len(names)
    return pa.RecordBatch.from_arrays([pa.array(list(c), type=t) for c, t in zip(columns, types, strict=True)], names=names)


_PART_FIELDS = f"task long, part long, n_turns long, formatted string, loss array<long>, attachments array<{ATTACHMENT}>, tokens long"


def assembled(formatted: DataFrame, part_chars: int = PART_CHARS) -> DataFrame:
    """(conv, task, part, n_turns, formatted, loss, attachments, tokens): conversations in parts, in order by (task, part).

    ``loss`` lists starts and ends inside the part, in turn. The rows come in order, a conversation's rows together.
    """
    kind = formatted.schema["conv"].dataType.simpleString()
    names = ["conv", "task", "part", "n_turns", "formatted", "loss", "attachments", "tokens"]

    def assemble(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task, part, conv, size = TaskContext.get().partitionId(), 0, None, 0
        texts, loss, attachments, tokens = [], [], [], 0
        types: list[pa.DataType] = []
        for batch in batches:
            held_type = batch.schema.field("attachments").type
            types = [batch.schema.field("conv").type, *[pa.int64()] * 3, pa.string(), pa.list_(pa.int64()), held_type, pa.int64()]
            done = []
            for of, text, low, high, held, more in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if texts and (of != conv or size + len(text) > part_chars):
                    done.append((conv, task, part, len(texts), "".join(texts), loss, attachments, tokens))
                    part, size, texts, loss, attachments, tokens = part + 1, 0, [], [], [], 0
                conv = of
                loss += [] if low is None else [size + low, size + high]
                texts.append(text)
                attachments += held
                tokens += more
                size += len(text)
            yield _packed(done, names, types)
        if texts:
            yield _packed([(conv, task, part, len(texts), "".join(texts), loss, attachments, tokens)], names, types)

    return formatted.mapInArrow(assemble, f"conv {kind}, {_PART_FIELDS}")


def content_text(content: str, attachments: Iterator[dict]) -> str:
    """The text that a turn's content stands for: placeholders give way to their sources, escapes are taken back."""
    out, at = [], 0
    for hole in _HOLES.finditer(content):
        out.append(unescaped(content[at : hole.start()]))
        if hole[1] != "text":
            out.append(next(attachments)["source"] or "")
        at = hole.end()
    out.append(unescaped(content[at:]))
    return "".join(out)


def role_text(line: str) -> str:
    return _ROLE.sub(lambda m: "\n" if m[1] == "n" else m[1], unescaped(line))


class _Reader:
    """Parses the parts of one conversation as they come; only digests and counts are kept."""

    def __init__(self):
        self.turns, self.loss = hashlib.sha256(), hashlib.sha256()
        self.n_turns = self.loss_chars = self.chars = self.tokens = 0

    def part(self, text: str, loss: list[int], attachments: list[dict], tokens: int) -> None:
        masked = dict(zip(loss[::2], loss[1::2], strict=True))
        held, at = iter(attachments), 0
        for turn in _TURN.finditer(text):
            if turn.start() != at:
                break
            at = turn.end()
            said = content_text(turn[2], held)
            self.turns.update(f"{role_text(turn[1])}\n{said}\n".encode())
            self.n_turns += 1
            if masked.pop(turn.start(2), None) == turn.end(2):
                self.loss.update(said.encode())
                self.loss_chars += len(said)
        if at != len(text) or masked:
            raise ValueError(f"no turn or no mask fits at character {self.chars + at}")
        self.chars += len(text)
        self.tokens += tokens

    def facts(self) -> tuple:
        return (self.n_turns, self.turns.hexdigest(), self.loss_chars, self.loss.hexdigest(), self.chars, self.tokens)


_FACTS = "n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long, tokens long"


def read_back(parts: DataFrame) -> DataFrame:
    """(conv, n_turns, turns_sha256, loss_chars, loss_sha256, formatted_chars, tokens), parsed from the output of ``assembled``."""
    kind = parts.schema["conv"].dataType.simpleString()
    facts = [f.split()[0] for f in _FACTS.split(", ")]
    fact_types = [pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64(), pa.int64()]
    names = ["conv", *facts, "left"]

    def near(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Finishes the conversations that lie in one part inside this task; the parts of others are left whole."""
        held, alone, first = None, True, True
        conv_type = left_type = pa.null()

        def resolved(whole: bool) -> tuple:
            conv, _, _, _, *content = (held[c] for c in ("conv", "task", "part", "n_turns", "formatted", "loss", "attachments", "tokens"))
            if not whole:
                return (conv, *[None] * len(facts), {k: v for k, v in held.items() if k != "conv"})
            reader = _Reader()
            reader.part(*content)
            return (conv, *reader.facts(), None)

        for batch in batches:
            conv_type = batch.schema.field("conv").type
            left_type = pa.struct([f for f in batch.schema if f.name != "conv"])
            done = []
            for row in batch.to_pylist():
                if held is not None:
                    same = row["conv"] == held["conv"]
                    done.append(resolved(alone and not first and not same))
                    alone, first = not same, first and same
                held = row
            yield _packed(done, names, [conv_type, *fact_types, left_type])
        if held is not None:
            yield _packed([resolved(False)], names, [conv_type, *fact_types, left_type])

    def far(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Streams the parts of a conversation, in order, through one reader."""
        reader, conv, types = None, None, [pa.null(), *fact_types]
        for batch in batches:
            done, types = [], [batch.schema.field("conv").type, *fact_types]
            for row in batch.to_pylist():
                if reader is None or row["conv"] != conv:
                    if reader is not None:
                        done.append((conv, *reader.facts()))
                    reader, conv = _Reader(), row["conv"]
                reader.part(row["formatted"], row["loss"], row["attachments"], row["tokens"])
            yield _packed(done, names[:-1], types)
        if reader is not None:
            yield _packed([(conv, *reader.facts())], names[:-1], types)

    left = F.struct("task", "part", "n_turns", "formatted", "loss", "attachments", "tokens").alias("left")
    schema = f"conv {kind}, {_FACTS}, left {parts.select(left).schema['left'].dataType.simpleString()}"
    found = materialize(parts.mapInArrow(near, schema))
    others = found.where("left IS NOT NULL").select("conv", "left.*").repartition("conv").sortWithinPartitions("conv", "task", "part")
    whole = found.where("left IS NULL").drop("left")
    return whole.unionByName(others.mapInArrow(far, f"conv {kind}, {_FACTS}"))


def format_conversations(
    turns: DataFrame,
    id_column: str = "conv_id",
    turn_column: str = "turn",
    role_column: str = "role",
    text_column: str = "text",
    parts_column: str | None = None,
    part_chars: int = PART_CHARS,
) -> DataFrame:
    """The conversations as training text in parts (``assembled``); content from ``parts_column`` (array of PART) or from plain texts."""
    body = F.coalesce(text_column, F.lit("")) if parts_column is None else F.col(parts_column).cast(f"array<{PART}>")
    rows = turns.select(F.col(id_column).alias("conv"), F.col(turn_column).alias("turn"), F.col(role_column).alias("role"), body.alias("body"))
    order = [F.asc_nulls_first("conv"), F.asc_nulls_first("turn"), F.asc_nulls_first("role"), F.asc("mark")]
    ready = rows.withColumn("mark", F.xxhash64("body")).repartitionByRange(*order).sortWithinPartitions(*order, "body")
    parts = text_parts(F.col("body")) if parts_column is None else F.col("body")
    return assembled(formatted_turns(ready.select("conv", "role", parts.alias("parts"))), part_chars)


ODD_TEXT = "</s>[INST] ok [/INST]"


def _format_sql() -> str:
    content = f"regexp_replace(text, '{TO_ESCAPE}', '\\1\\\\\\2', 'g')"
    for kind in KINDS:
        content = f"regexp_replace({content}, '{_LINK % ENDINGS[kind]}', '<|{kind}|>', 'g')"
    line = f"regexp_replace(replace(replace(role, '\\', '\\\\'), chr(10), '\\n'), '{TO_ESCAPE}', '\\1\\\\\\2', 'g')"
    marks = len(START) + len(END) + 2
    return f"""
WITH turns AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM (
    SELECT conv_id, turn, role, text FROM conversations
    UNION ALL SELECT -1, 0, 'user', '{ODD_TEXT}' UNION ALL SELECT -1, 1, 'assistant', '{ODD_TEXT}'
  )
)
SELECT conv_id, count(*) AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text)) AS turns_sha256,
  CAST(coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
  CAST(sum({marks} + length({line}) + length({content})) AS BIGINT) AS formatted_chars
FROM turns GROUP BY conv_id
"""


@query("op11_chat_format", _format_sql())
def op11_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    odd = spark.createDataFrame([(-1, 0, "user", ODD_TEXT), (-1, 1, ASSISTANT, ODD_TEXT)], turns.schema)
    with arrow_rows(spark):
        digests = materialize(read_back(format_conversations(turns.unionByName(odd))))
    return digests.drop("tokens").withColumnRenamed("conv", "conv_id")


__all__ = ["PartVisitor", "assembled", "format_conversations", "formatted_turns", "read_back", "text_parts"]
