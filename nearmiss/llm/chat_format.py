"""Chat formatting by schema fingerprints.

Records of conversations come in many layouts: lists of messages, prompt and response,
instruction with an optional input, rows of single turns. The nested field paths of a
record are hashed to a fingerprint, the fingerprint selects a declarative mapping, and the
mapping gives canonical turns (role, text). A fingerprint is resolved once, however many
records share it. A template then writes turns as one text with marked roles and a loss
mask; control strings inside texts are escaped in a way that reads back exactly.
"""

from __future__ import annotations

import hashlib
import json
import re
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field
from functools import cached_property

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from nearmiss.llm.common import arrow_batch

# ------------------------------------------------------------------ layouts


@dataclass(frozen=True)
class Turn:
    """One turn of fixed role, its text at a path; further paths are joined by an empty line.
    A turn whose texts are all missing or null is left out if ``optional``."""

    role: str
    paths: tuple[str, ...]
    optional: bool = False


@dataclass(frozen=True)
class EachTurn:
    """A turn for each item of a list of objects, role and text in fields of the item."""

    path: str
    role: str
    text: str


@dataclass(frozen=True)
class Alternating:
    """A list of plain texts, the first by the user, then by turns."""

    path: str
    roles: tuple[str, ...] = ("user", "assistant")


@dataclass(frozen=True)
class RowTurn:
    """The whole record is one turn of a conversation that other rows continue."""

    conversation: str
    turn: str
    role: str
    text: str


@dataclass(frozen=True)
class Mapping:
    """A layout: the field paths that a record must have, and how to read its turns.

    ``optional`` paths may be there or not.
    """

    name: str
    paths: tuple[str, ...]
    turns: tuple[Turn | EachTurn | Alternating | RowTurn, ...]
    optional: tuple[str, ...] = ()


#: Names under which roles occur in the layouts.
ROLES = {"human": "user", "gpt": "assistant", "bot": "assistant", "model": "assistant", "chatgpt": "assistant"}

#: Mappings in order of preference.
LAYOUTS = (
    Mapping("rows", ("conv_id", "turn", "role", "text"), (RowTurn("conv_id", "turn", "role", "text"),)),
    Mapping("messages", ("messages[].role", "messages[].content"),
            (Turn("system", ("system",), optional=True), EachTurn("messages", "role", "content")), ("system",)),
    Mapping("from_value", ("conversations[].from", "conversations[].value"),
            (Turn("system", ("system",), optional=True), EachTurn("conversations", "from", "value")), ("system",)),
    Mapping("instruction", ("instruction", "output"),
            (Turn("system", ("system",), optional=True), Turn("user", ("instruction", "input")), Turn("assistant", ("output",))),
            ("input", "system")),
    Mapping("prompt_response", ("prompt", "response"),
            (Turn("system", ("system",), optional=True), Turn("user", ("prompt",)), Turn("assistant", ("response",))), ("system",)),
    Mapping("prompt_completion", ("prompt", "completion"), (Turn("user", ("prompt",)), Turn("assistant", ("completion",)))),
    Mapping("question_answer", ("question", "answer"),
            (Turn("user", ("context", "question")), Turn("assistant", ("answer",))), ("context",)),
    Mapping("texts", ("dialog[]",), (Alternating("dialog"),)),
)


def fingerprint(paths: Iterable[str]) -> str:
    """16 hex digits that name a set of field paths, whatever their order."""
    return hashlib.sha256("\n".join(sorted(set(paths))).encode("utf-8", "replace")).hexdigest()[:16]


def record_paths(value, at: str = "") -> set[str]:
    """The paths of a record's leaves: ``a.b`` for nested objects, ``a[]`` for items of lists.
    An empty list or object is a leaf."""
    if isinstance(value, dict) and value:
        return set().union(*(record_paths(v, f"{at}.{k}" if at else k) for k, v in value.items()))
    if isinstance(value, list):
        return set().union({f"{at}[]"} if not value else set(), *(record_paths(v, f"{at}[]") for v in value))
    return {at}


def schema_paths(kind: T.DataType, at: str = "") -> set[str]:
    """The paths of a table's leaves, as ``record_paths`` of its rows."""
    if isinstance(kind, T.StructType):
        return set().union(*(schema_paths(f.dataType, f"{at}.{f.name}" if at else f.name) for f in kind))
    if isinstance(kind, T.ArrayType):
        return schema_paths(kind.elementType, f"{at}[]")
    return {at}


class Layouts:
    """Finds the mapping of a fingerprint.

    First by the fingerprint itself: that of a mapping's paths, with any of the optional ones.
    Otherwise by the paths behind it: the mapping most of whose paths are there, of those all
    of whose required paths are; earlier ones win ties. So fields that no mapping knows are
    ignored, and an empty list of messages fits a list of messages.
    """

    def __init__(self, mappings: Iterable[Mapping] = LAYOUTS):
        self.mappings = tuple(mappings)
        self.known: dict[str, Mapping | None] = {}
        for m in reversed(self.mappings):
            for k in range(1 << len(m.optional)):
                chosen = [p for j, p in enumerate(m.optional) if k >> j & 1]
                self.known[fingerprint([*m.paths, *chosen])] = m

    def find(self, paths: set[str]) -> tuple[str, Mapping | None]:
        mark = fingerprint(paths)
        if mark not in self.known:
            if len(self.known) > 100_000:  # fingerprints of wild records; they are found again
                self.known.clear()
            self.known[mark] = self._closest(paths)
        return mark, self.known[mark]

    def _closest(self, paths: set[str]) -> Mapping | None:
        best, most = None, 0
        for m in self.mappings:
            there = sum(p in paths for p in (*m.paths, *m.optional))
            fits = all(p in paths or any(p.startswith(f"{q}.") for q in paths if q.endswith("[]")) for p in m.paths)
            if fits and max(there, 1) > most:
                best, most = m, max(there, 1)
        return best


def read_turns(record: dict, mapping: Mapping) -> list[tuple[str, str]]:
    """Canonical turns (role, text) of a record that holds a whole conversation."""
    out = []
    for spec in mapping.turns:
        if isinstance(spec, Turn):
            values = [_at(record, p) for p in spec.paths]
            there = [_text(v) for v in values if v is not None and v != ""]
            if there or not spec.optional:
                out.append((spec.role, "\n\n".join(there)))
        elif isinstance(spec, EachTurn):
            for item in _list(_at(record, spec.path)):
                item = item if isinstance(item, dict) else {spec.text: item}
                out.append((_role(item.get(spec.role)), _text(item.get(spec.text))))
        elif isinstance(spec, Alternating):
            for k, item in enumerate(_list(_at(record, spec.path))):
                out.append((spec.roles[k % len(spec.roles)], _text(item)))
        else:
            out.append((_role(_at(record, spec.role)), _text(_at(record, spec.text))))
    return out


def _at(record, path: str):
    for name in path.split("."):
        record = record.get(name) if isinstance(record, dict) else None
    return record


def _list(value) -> list:
    return value if isinstance(value, list) else [] if value is None else [value]


def _text(value) -> str:
    """A value as text, others than text as JSON; half of a surrogate pair becomes a question mark."""
    text = "" if value is None else value if isinstance(value, str) else json.dumps(value, ensure_ascii=False)
    return text.encode("utf-8", "replace").decode()


def _role(value) -> str:
    role = _text(value)
    return ROLES.get(role, role)


TURN_SCHEMA = "conv_id long, turn long, role string, text string"
_RECORD_SCHEMA = f"{TURN_SCHEMA}, fingerprint string, layout string"
_RECORD_TYPES = {"conv_id": pa.int64(), "turn": pa.int64(), "role": pa.string(), "text": pa.string(),
                 "fingerprint": pa.string(), "layout": pa.string()}


def turns_of_records(
    records: DataFrame, mappings: Iterable[Mapping] = LAYOUTS, *, id_col="conv_id", record_col="record"
) -> DataFrame:
    """``conv_id, turn, role, text, fingerprint, layout`` of records given as JSON text.

    One row for each turn. A record whose fingerprint fits no mapping, a null one and one
    that isn't a JSON object (or is nested too deep to read) gives one row with null turn, role, text and layout (the
    last two also a null fingerprint), so that nothing is lost unseen. Records of the layout of
    single turns bring their own conversation and turn numbers; the others get ``id_col`` and
    turns from 0 on. Columns other than these two are not read.
    """
    mappings = tuple(mappings)

    def run(batches):
        layouts = Layouts(mappings)
        for batch in batches:
            rows = []
            for conv_id, text in zip(batch.column(0).to_pylist(), (x.as_py() for x in batch.column(1))):
                try:
                    record = json.loads(text) if text is not None else None
                    paths = record_paths(record)
                except (ValueError, RecursionError):
                    record = None
                if not isinstance(record, dict):
                    rows.append((conv_id, None, None, None, None, None))
                    continue
                mark, mapping = layouts.find(paths)
                if mapping is None:
                    rows.append((conv_id, None, None, None, mark, None))
                    continue
                row = next((s for s in mapping.turns if isinstance(s, RowTurn)), None)
                for k, (role, said) in enumerate(read_turns(record, mapping)):
                    ids = (_long(_at(record, row.conversation)), _long(_at(record, row.turn))) if row else (conv_id, k)
                    rows.append((*ids, role, said, mark, mapping.name))
            columns = list(zip(*rows)) or [()] * len(_RECORD_TYPES)
            yield arrow_batch(dict(zip(_RECORD_TYPES, columns)), _RECORD_TYPES)

    slim = records.select(F.col(id_col).cast("long").alias("conv_id"), F.col(record_col).cast("string").alias("record"))
    return slim.mapInArrow(run, _RECORD_SCHEMA)


def _long(value) -> int | None:
    whole = isinstance(value, int) and not isinstance(value, bool) and -(1 << 63) <= value < 1 << 63
    return value if whole else None


def turns_of_table(
    df: DataFrame, mappings: Iterable[Mapping] = LAYOUTS, *, id_col="conv_id"
) -> DataFrame:
    """``conv_id, turn, role, text, fingerprint, layout`` of a table of one layout.

    All rows share the table's schema: its fingerprint is taken once, and the mapping becomes
    plain column expressions. Roles are renamed as in ``turns_of_records``; null roles and texts
    are empty, null conversation ids and turn numbers stay null. Raises ``ValueError`` where no
    mapping fits.
    """
    paths = schema_paths(df.schema)
    mark, mapping = Layouts(mappings).find(paths)
    if mapping is None:
        raise ValueError(f"no mapping for the field paths {sorted(paths)}")
    parts: list[Column] = []
    for spec in mapping.turns:
        if isinstance(spec, RowTurn):
            parts.append(F.array(_turn(_role_column(_column(spec.role)), _text_column(_column(spec.text)))))
        elif isinstance(spec, Turn):
            there = [F.nullif(_column(p).cast("string"), F.lit("")) for p in spec.paths if p in paths]
            said = F.concat_ws("\n\n", *there) if there else F.lit("")
            one = F.array(_turn(F.lit(spec.role), said))
            parts.append(F.when(said != "", one).otherwise(F.slice(one, 1, 0)) if spec.optional else one)
        elif isinstance(spec, EachTurn):
            parts.append(F.coalesce(F.transform(_column(spec.path), _item_turn(spec)), F.array().cast(_TURNS)))
        else:
            parts.append(F.coalesce(F.transform(_column(spec.path), _place_turn(spec)), F.array().cast(_TURNS)))
    row = next((s for s in mapping.turns if isinstance(s, RowTurn)), None)
    conv = _column(row.conversation if row else id_col).cast("long").alias("conv_id")
    number = _column(row.turn).cast("long").alias("_turn") if row else F.lit(None).cast("long").alias("_turn")
    laid = df.select(conv, number, F.posexplode(F.concat(*parts)).alias("_k", "_said"))
    turn = F.col("_turn") if row else F.col("_k").cast("long")
    return laid.select(
        "conv_id", turn.alias("turn"), "_said.role", "_said.text", F.lit(mark).alias("fingerprint"), F.lit(mapping.name).alias("layout")
    )


_TURNS = "array<struct<role:string,text:string>>"


def _column(path: str) -> Column:
    return F.col(".".join(f"`{name}`" for name in path.split(".")))


def _text_column(c: Column) -> Column:
    return F.coalesce(c.cast("string"), F.lit(""))


def _role_column(c: Column) -> Column:
    names = F.create_map(*(F.lit(x) for pair in ROLES.items() for x in pair))
    role = _text_column(c)
    return F.coalesce(F.try_element_at(names, role), role)


def _item_turn(spec: EachTurn):
    return lambda item: _turn(_role_column(item[spec.role]), _text_column(item[spec.text]))


def _place_turn(spec: Alternating):
    roles = F.array(*map(F.lit, spec.roles))
    return lambda item, k: _turn(F.get(roles, k % len(spec.roles)), _text_column(item))


def _turn(role: Column, text: Column) -> Column:
    return F.struct(role.alias("role"), text.alias("text"))


# ----------------------------------------------------------------- template


@dataclass(frozen=True)
class Template:
    """How turns are written: ``open role mid text close``.

    ``controls`` are further strings that no text may hold as they are. Inside texts and roles
    a backslash goes before a backslash and behind the first character of a control string, so no
    control string is left and taking the backslashes out gives the text again. Control strings
    have two characters or more and no backslash, and no end of one begins itself (``mid``
    and ``close`` are then found where they were put).
    """

    open: str = "<|turn|>"
    mid: str = "<|says|>"
    close: str = "</s>"
    controls: tuple[str, ...] = field(default=("<s>", "[INST]", "[/INST]", "<<SYS>>", "<</SYS>>"))
    learnt: tuple[str, ...] = ("assistant",)

    def __post_init__(self):
        for c in self.marks:
            if len(c) < 2 or "\\" in c or any(c.startswith(c[k:]) for k in range(1, len(c))):
                raise ValueError(f"not a control string: {c!r}")

    @property
    def marks(self) -> tuple[str, ...]:
        return tuple(dict.fromkeys((self.open, self.mid, self.close, *self.controls)))

    @cached_property
    def _starts(self) -> re.Pattern:
        return re.compile(rf"\\|(?:{'|'.join(f'{re.escape(c[0])}(?={re.escape(c[1:])})' for c in self.marks)})", re.S)

    def escape(self, text: str) -> str:
        return self._starts.sub(lambda m: "\\\\" if m[0] == "\\" else m[0] + "\\", text)

    def unescape(self, text: str) -> str:
        # a backslash behind the first character of a control string, or one of a pair
        return re.sub(r"\\(.)", r"\1", text, flags=re.S)

    def write(self, role: str, text: str) -> tuple[str, int, int]:
        """A turn as text, and where the loss mask holds in it (empty for other roles)."""
        head = f"{self.open}{self.escape(role)}{self.mid}"
        said = self.escape(text)
        end = len(head) + len(said)
        return f"{head}{said}{self.close}", len(head), end if role in self.learnt else len(head)

    def read(self, formatted: str) -> Iterator[tuple[str, str]]:
        """The turns of a formatted text."""
        at = 0
        while at < len(formatted):
            if not formatted.startswith(self.open, at):
                raise ValueError(f"no turn begins at character {at}")
            mid = formatted.index(self.mid, at + len(self.open))
            close = formatted.index(self.close, mid + len(self.mid))
            yield self.unescape(formatted[at + len(self.open) : mid]), self.unescape(formatted[mid + len(self.mid) : close])
            at = close + len(self.close)


#: Characters of a piece beyond which a conversation goes on in another piece.
PIECE_CHARS = 1 << 20
#: Rows and bytes of a batch that goes back to Spark.
BATCH_ROWS, BATCH_BYTES = 1000, 4 << 20
_SPANS = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
_PIECE_TYPES = {
    "conv_id": pa.int64(), "part": pa.int64(), "piece": pa.int64(), "whole": pa.bool_(), "n_turns": pa.int64(),
    "formatted": pa.string(), "loss": _SPANS,
}
PIECE_SCHEMA = (
    "conv_id long, part long, piece long, whole boolean, n_turns long, formatted string, "
    "loss array<struct<start:long,end:long>>"
)


def _batches(rows: Iterable[tuple], types: dict[str, pa.DataType], sized: tuple[int, ...]) -> Iterator[pa.RecordBatch]:
    """Rows in record batches of a bounded number of rows and bytes; ``sized`` are the columns
    that hold the bytes."""
    held, size = [], 0
    for row in rows:
        held.append(row)
        size += sum(len(row[k] or "") for k in sized)
        if len(held) >= BATCH_ROWS or size >= BATCH_BYTES:
            yield arrow_batch(dict(zip(types, zip(*held))), types)
            held, size = [], 0
    if held:
        yield arrow_batch(dict(zip(types, zip(*held))), types)


def format_conversations(turns: DataFrame, template: Template = Template(), *, piece_chars: int = PIECE_CHARS) -> DataFrame:
    """``conv_id, part, piece, whole, n_turns, formatted, loss`` of turns (``conv_id, turn, role, text``).

    A conversation is the texts of its pieces in order of (part, piece). Nearly all have one,
    which is then marked ``whole``; one of over ``piece_chars`` characters goes on in further
    pieces of whole turns. Rows are dealt out by range of (conversation, turn), so that
    even a conversation with a third of all rows is written by many tasks; the first and last
    conversation of a task may go on in another one and aren't marked. ``loss`` are the spans of
    code points of learnt texts, one for each such turn.

    Equal turn numbers go by role, then text; null ids form a conversation of their own, null
    turn numbers come first; null roles and texts are empty. Repeated rows are repeated turns.
    Columns other than the four are not read.
    """

    def pieces(batches):
        part, at, n_conversations, last = TaskContext.get().partitionId(), 0, 0, None
        texts, spans, size, goes_on = [], [], 0, False
        for batch in batches:
            columns = (batch.column(0).to_pylist(), batch.column(1).to_pylist(), (x.as_py() for x in batch.column(2)))
            for conv_id, role, text in zip(*columns):
                new = n_conversations == 0 or conv_id != last
                if texts and (new or size > piece_chars):
                    whole = new and n_conversations > 1 and not goes_on
                    yield last, part, at, whole, len(texts), "".join(texts), spans
                    at, texts, spans, size, goes_on = at + 1, [], [], 0, not new
                n_conversations += new
                last = conv_id
                said, lo, hi = template.write(role, text)
                if role in template.learnt:
                    spans.append({"start": size + lo, "end": size + hi})
                texts.append(said)
                size += len(said)
        if texts:
            yield last, part, at, False, len(texts), "".join(texts), spans

    said = [F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in ("role", "text")]
    slim = turns.select(F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"), *said)
    ranged = slim.repartitionByRange("conv_id", "turn").sortWithinPartitions("conv_id", "turn", "role", "text")
    return ranged.select("conv_id", "role", "text").mapInArrow(
        lambda batches: _batches(pieces(batches), _PIECE_TYPES, (5,)), PIECE_SCHEMA
    )


# --------------------------------------------------------------- reading back

_DIGEST_TYPES = {
    "conv_id": pa.int64(), "n_turns": pa.int64(), "turns_sha256": pa.string(),
    "loss_chars": pa.int64(), "loss_sha256": pa.string(), "formatted_chars": pa.int64(),
}
DIGEST_SCHEMA = (
    "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long"
)
_READ_TYPES = {**_DIGEST_TYPES, "part": pa.int64(), "piece": pa.int64(), "turn_bytes": pa.binary(), "loss_bytes": pa.binary()}
_READ_SCHEMA = f"{DIGEST_SCHEMA}, part long, piece long, turn_bytes binary, loss_bytes binary"


def read_back(pieces: DataFrame, template: Template = Template()) -> DataFrame:
    """``conv_id, n_turns, turns_sha256, loss_chars, loss_sha256, formatted_chars`` of the
    pieces of ``format_conversations``, one row for each conversation.

    Everything is read off the formatted text and the loss mask. Whole conversations are
    digested where they are. Of the others (two for each task, and very long ones) the bytes
    travel by conversation and are fed to the digests row by row, in order: a sha256 can't be
    split, so one task does that in constant memory however long the conversation is.
    """

    def read(batches):
        for batch in batches:
            names = ("conv_id", "part", "piece", "whole")
            keys = zip(*(batch.column(n).to_pylist() for n in names))
            texts = zip((x.as_py() for x in batch.column("formatted")), (x.as_py() for x in batch.column("loss")))
            for (conv_id, part, piece, whole), (text, loss) in zip(keys, texts):
                turns = [f"{role}\n{said}\n" for role, said in template.read(text)]
                learnt = "".join(template.unescape(text[s["start"] : s["end"]]) for s in loss)
                t, l = "".join(turns).encode(), learnt.encode()
                digests = (hashlib.sha256(t).hexdigest(), hashlib.sha256(l).hexdigest()) if whole else (None, None)
                yield (
                    conv_id, len(turns), digests[0], len(learnt), digests[1], len(text), part, piece,
                    None if whole else t, None if whole else l,
                )

    def join(batches):
        last, open_ = None, None  # the conversation whose pieces are being joined: digests and sums
        for batch in batches:
            columns = [batch.column(k).to_pylist() for k in range(6)]
            held = zip(zip(*columns), batch.column("turn_bytes"), batch.column("loss_bytes"))
            for row, turn_bytes, loss_bytes in held:
                if row[2] is not None:
                    yield row
                    continue
                if open_ is None or row[0] != last:
                    if open_ is not None:
                        yield _closed(last, open_)
                    last, open_ = row[0], [hashlib.sha256(), hashlib.sha256(), 0, 0, 0]
                open_[0].update(turn_bytes.as_py())
                open_[1].update(loss_bytes.as_py())
                for k, n in enumerate((row[1], row[3], row[5])):
                    open_[2 + k] += n
        if open_ is not None:
            yield _closed(last, open_)

    found = pieces.mapInArrow(lambda batches: _batches(read(batches), _READ_TYPES, (8, 9)), _READ_SCHEMA)
    ordered = found.repartition("conv_id").sortWithinPartitions("conv_id", "part", "piece")
    return ordered.mapInArrow(lambda batches: _batches(join(batches), _DIGEST_TYPES, ()), DIGEST_SCHEMA)


def _closed(conv_id: int | None, state: list) -> tuple:
    turns, loss, n_turns, loss_chars, chars = state
    return conv_id, n_turns, turns.hexdigest(), loss_chars, loss.hexdigest(), chars
