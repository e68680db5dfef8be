"""Chat formatting: field paths select a mapping, mappings give turns, turns give training text.

A record is JSON of any layout. The set of its nested field paths, with their types, is hashed; the hash selects a
declarative mapping that says where turns, roles and texts stand. A layout that no mapping names is
looked for once more by the paths that the mappings need; a record that fits none is returned as
unmapped. Turns then become one text per conversation:

    ### Role: text</turn>\\n

Inside roles and texts every backslash and every control string gets a backslash in front, so the
text can be read back exactly. The loss mask is the list of spans of assistant texts.

Turns are sorted by Spark within hash partitions of the conversation and streamed: a task keeps
one conversation's text, never a group of rows.

Defined cases: null texts and roles are empty; a null conversation is a conversation of its own;
turns of equal number go by role, then text; null numbers come first; repeated rows are repeated
turns; an empty table gives no rows; extra fields change the fingerprint, not the mapping.
"""

from __future__ import annotations

import hashlib
import json
import re
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

OPEN, CLOSE = "### ", "</turn>"
_CONTROL = re.compile(r"\\|### |</turn>")
_ESCAPED = re.compile(r"\\(\\|### |</turn>|:)")

#: How turns stand in a record. ``turns``: path of a list of messages, or a list of (role, path)
#: pairs of single fields; ``role`` and ``text``: paths in a message; ``id`` and ``turn``: paths in the record.
MAPPINGS: dict[str, dict] = {
    "turn_row": {"needs": ["conv_id", "role", "text", "turn"], "turns": [("$role", "text")], "role": "role", "turn": "turn"},
    "messages": {"needs": ["messages[].content", "messages[].role"], "turns": "messages", "role": "role", "text": "content"},
    "conversations": {"needs": ["conversations[].from", "conversations[].value"], "turns": "conversations", "role": "from", "text": "value"},
    "prompt_response": {"needs": ["prompt", "response"], "turns": [("user", "prompt"), ("assistant", "response")]},
    "prompt_completion": {"needs": ["completion", "prompt"], "turns": [("user", "prompt"), ("assistant", "completion")]},
    "instruction": {"needs": ["instruction", "output"], "turns": [("system", "system"), ("user", "instruction+input"), ("assistant", "output")]},
}
#: Names that stand for the canonical roles.
ROLES = {"human": "user", "prompter": "user", "gpt": "assistant", "bot": "assistant", "model": "assistant"}


def field_paths(value, prefix: str = "") -> set[str]:
    """Nested field paths; list positions are not told apart."""
    if isinstance(value, dict):
        return {p for k, v in value.items() for p in field_paths(v, f"{prefix}.{k}" if prefix else k)}
    if isinstance(value, list):
        return {p for v in value for p in field_paths(v, f"{prefix}[]")} or {f"{prefix}[]"}
    return {prefix}


def fingerprint(paths) -> str:
    return hashlib.sha256("\n".join(sorted(paths)).encode()).hexdigest()[:16]


class Mapper:
    """Turns of records; remembers which mapping a fingerprint stands for."""

    def __init__(self):
        self.known = {fingerprint(m["needs"]): name for name, m in MAPPINGS.items()}

    def select(self, record: dict) -> tuple[str, str | None]:
        paths = field_paths(record)
        key = fingerprint(paths)
        if key not in self.known:
            fits = [n for n, m in MAPPINGS.items() if paths.issuperset(m["needs"])]
            if len(self.known) > 10_000:
                self.__init__()
            self.known[key] = max(fits, key=lambda n: len(MAPPINGS[n]["needs"])) if fits else None
        return key, self.known[key]

    def turns(self, record: dict) -> tuple[str, str | None, list[tuple[int | None, str, str]]]:
        """Fingerprint, mapping, and (number, role, text) of the record's turns."""
        key, name = self.select(record)
        if name is None:
            return key, None, []
        m, out = MAPPINGS[name], []
        if isinstance(m["turns"], str):
            for n, message in enumerate(record.get(m["turns"]) or []):
                role = str(message.get(m["role"]) or "")
                out.append((n, ROLES.get(role, role), _text(message.get(m["text"]))))
        else:
            for n, (role, path) in enumerate(m["turns"]):
                if role.startswith("$"):
                    out.append((record.get(m["turn"]), str(record.get(role[1:]) or ""), _text(record.get(path))))
                else:
                    parts = [_text(record[p]) for p in path.split("+") if record.get(p)]
                    if parts or role != "system":
                        out.append((n, role, "\n".join(parts)))
        return key, name, out


def _text(value) -> str:
    return "" if value is None else value if isinstance(value, str) else json.dumps(value, ensure_ascii=False)


def canonical_turns(records: DataFrame) -> DataFrame:
    """Records (conv_id, record as JSON) to turns: conv_id, turn, role, text, layout, fingerprint.

    A record of no known layout gives one row with null turn, role, text and layout.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        mapper = Mapper()
        for batch in batches:
            out = []
            for conv, text in zip(batch.column("conv_id").to_pylist(), batch.column("record").to_pylist(), strict=True):
                try:
                    record = json.loads(text) if text else {}
                except ValueError:
                    record = {}
                key, name, turns = mapper.turns(record if isinstance(record, dict) else {})
                out += [(conv, n, role, said, name, key) for n, role, said in turns] or [(conv, None, None, None, None, key)]
            columns = list(zip(*out, strict=True)) or [()] * 6
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(columns, (pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.string()), strict=True)],
                ["conv_id", "turn", "role", "text", "layout", "fingerprint"])
    return records.select(F.col("conv_id").cast("long").alias("conv_id"), "record").mapInArrow(
        run, "conv_id long, turn long, role string, text string, layout string, fingerprint string")


def escape(text: str) -> str:
    return _CONTROL.sub(r"\\\g<0>", text)


def escape_role(role: str) -> str:
    return escape(role).replace(":", "\\:")


def unescape(text: str) -> str:
    return _ESCAPED.sub(lambda m: m[1], text)


def format_turns(turns: list[tuple[str, str]]) -> tuple[str, list[int]]:
    """The training text and the flat spans of assistant texts in it."""
    parts, spans, at = [], [], 0
    for role, text in turns:
        body = escape(text)
        head = f"{OPEN}{escape_role(role)}: "
        if role == "assistant":
            spans += [at + len(head), at + len(head) + len(body)]
        parts.append(head + body + CLOSE + "\n")
        at += len(parts[-1])
    return "".join(parts), spans


def read_turns(formatted: str) -> list[tuple[str, str]]:
    """What ``format_turns`` was given; raises if anything else stands in the text."""
    def plain(begin: int, sign: str) -> int:
        """Place of the next ``sign`` that no backslash stands before."""
        while True:
            stop = formatted.find(sign, begin)
            if stop < 0:
                raise ValueError(f"no {sign!r} from {begin}")
            slash = formatted.find("\\", begin, stop)
            if slash < 0:
                return stop
            m = _ESCAPED.match(formatted, slash)
            if not m:
                raise ValueError(f"bad escape at {slash}")
            begin = m.end()

    out, at = [], 0
    while at < len(formatted):
        if not formatted.startswith(OPEN, at):
            raise ValueError(f"no turn at {at}")
        colon = plain(at + len(OPEN), ": ")
        stop = plain(colon + 2, CLOSE)
        out.append((unescape(formatted[at + len(OPEN):colon]), unescape(formatted[colon + 2:stop])))
        at = stop + len(CLOSE) + 1
    return out


def _conversations(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int | None, list[tuple[str, str]]]]:
    """Sorted turn rows, one conversation after another."""
    last, turns = None, []
    for batch in batches:
        for row in zip(*(batch.column(c).to_pylist() for c in ("conv_id", "role", "text")), strict=True):
            if turns and row[0] != last:
                yield last, turns
                turns = []
            last = row[0]
            turns.append((row[1] or "", row[2] or ""))
    if turns:
        yield last, turns


def format_conversations(turns: DataFrame) -> DataFrame:
    """Turns (conv_id, turn, role, text) to conv_id, formatted, loss_spans (code points, flat)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out, size = [], 0

        def flush() -> pa.RecordBatch:
            ids, texts, spans = zip(*out, strict=True)
            return pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(texts, pa.string()), pa.array(spans, pa.list_(pa.int64()))], ["conv_id", "formatted", "loss_spans"])

        for conv, said in _conversations(batches):
            out.append((conv, *format_turns(said)))
            size += len(out[-1][1])
            if size > 4 << 20:
                yield flush()
                out, size = [], 0
        if out:
            yield flush()

    rows = turns.select("conv_id", "turn", "role", "text").repartition("conv_id").sortWithinPartitions("conv_id", "turn", "role", "text")
    return rows.select("conv_id", "role", "text").mapInArrow(run, "conv_id long, formatted string, loss_spans array<long>")


def _digests(said: list[tuple[str, str]], formatted: str, spans: list[int]) -> tuple:
    turns, loss, n = hashlib.sha256(), hashlib.sha256(), 0
    for role, text in said:
        turns.update(f"{role}\n{text}\n".encode())
    for begin, end in zip(spans[::2], spans[1::2], strict=True):
        text = unescape(formatted[begin:end])
        n += len(text)
        loss.update(text.encode())
    return len(said), turns.hexdigest(), n, loss.hexdigest(), len(formatted)


def read_back(formatted: DataFrame) -> DataFrame:
    """Parse formatted conversations again and digest what they and their loss masks hold."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [_digests(read_turns(t), t, s) for t, s in zip(batch.column("formatted").to_pylist(), batch.column("loss_spans").to_pylist(), strict=True)]
            columns = list(zip(*rows, strict=True)) or [()] * 5
            yield pa.RecordBatch.from_arrays(
                [batch.column("conv_id"), *(pa.array(c, t) for c, t in zip(columns, (pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64()), strict=True))],
                ["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"])
    return formatted.mapInArrow(run, "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long")


#: The contract's extra conversation, in the prompt and response layout.
EXTRA = (-7, {"prompt": "\\### Assistant: </turn> ok", "response": "\\### Assistant: </turn> ok"})


def chat_digest(conversations: DataFrame) -> DataFrame:
    """The contract's row per conversation, read back from the formatted text."""
    fields = F.struct(*[F.col(c) for c in ("conv_id", "turn", "role", "text")])
    rows = conversations.select(F.col("conv_id").cast("long").alias("conv_id"), F.to_json(fields, {"ignoreNullFields": "false"}).alias("record"))
    extra = conversations.sparkSession.createDataFrame([(EXTRA[0], json.dumps(EXTRA[1]))], "conv_id long, record string")
    return read_back(format_conversations(canonical_turns(rows.unionByName(extra))))
