"""Chat formatting in budgeted windows with a loss mask.

A conversation's turns are rendered by a template that marks each turn, and cut into windows of a token
budget. Prefix sums of the turns' tokens choose spans of whole turns; each window retains the system
turn, repeats as much of the latest history as a second, smaller budget allows, and masks what it
repeats: every assistant text is a target exactly once. A turn longer than the budget gets a window of
its own, whole.

Tokens are counted where the table is read; conversations are then streamed in sorted partitions with
the turns of about one window in memory, so a conversation may have any number of turns. One of more than
LONG_BYTES is cut into runs of RUN_TOKENS by the prefix sums of its tokens, and each run is windowed apart
with the system turn and the latest history carried into it; a window never spans two runs. Only the digests
of ``read_back`` need a conversation's windows one after another.

Null texts and roles count as empty; rows with equal or null turn numbers are ordered by role and text,
nulls last; rows without a conversation id form one conversation; repeated rows are repeated turns; an
empty table gives an empty one. Texts are never cut.
"""

from __future__ import annotations

import base64
import hashlib
import re
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tierline.operators.joins import broadcast_if, null_safe_join, row_bytes
from tierline.session import stage

BUDGET = 1024
HISTORY = 256
LONG_BYTES = 1 << 24  # of roles and texts; a conversation beyond it is cut into runs
RUN_TOKENS = 1 << 20
SLICE_RUNS = 64  # bytes of a sorted slice of long conversations for each token of a run
MOST_SLICES = 1 << 16
PART = 20_000  # characters counted at a time: pieces of endless words are counted, not merged, across

# The template's own marks and those of the common instruction format.
OPEN, CLOSE = "<s>", "</s>"
_CONTROL = re.compile(r"<(\\*)(/?s>)|\[(\\*)(/?INST\])")
_ESCAPED = re.compile(r"<\\(\\*)(/?s>)|\[\\(\\*)(/?INST\])")
_TURN = re.compile(r"<s>(.*?)\n(.*?)</s>\n", re.DOTALL)


def escape(text: str) -> str:
    """One more backslash after the first sign of every control string, escaped ones included."""
    return _CONTROL.sub(lambda m: f"<\\{m[1]}{m[2]}" if m[2] else f"[\\{m[3]}{m[4]}", text)


def unescape(text: str) -> str:
    return _ESCAPED.sub(lambda m: f"<{m[1]}{m[2]}" if m[2] else f"[{m[3]}{m[4]}", text)


def _role(role: str) -> str:
    return escape(role.replace("\\", "\\\\").replace("\n", "\\n"))


def _read_role(role: str) -> str:
    return re.sub(r"\\(.)", lambda m: "\n" if m[1] == "n" else m[1], unescape(role))


def render(role: str, text: str) -> tuple[str, int, int]:
    """A turn, and where its escaped text begins and ends in it."""
    head = f"{OPEN}{_role(role)}\n"
    body = escape(text)
    return f"{head}{body}{CLOSE}\n", len(head), len(head) + len(body)


def read(window: str) -> list[tuple[str, str]]:
    """The (role, text) turns of a window."""
    return [(_read_role(m[1]), unescape(m[2])) for m in _TURN.finditer(window)]


def encoding(path: str, pattern: str):
    """A byte-level tokenizer from its file of ranks and the pattern that splits texts into words."""
    import tiktoken

    with open(path, "rb") as file:
        ranks = {base64.b64decode(token): int(rank) for token, rank in (line.split() for line in file)}
    return tiktoken.Encoding("turns", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})


def _counted(turns: DataFrame, path: str, pattern: str) -> DataFrame:
    schema = T.StructType([*turns.schema.fields, T.StructField("tokens", T.LongType())])

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = encoding(path, pattern)
        for batch in batches:
            tokens = []
            for role, text in zip(batch.column("role").to_pylist(), batch.column("text").to_pylist()):
                whole = render(role or "", text or "")[0]
                tokens.append(sum(len(coder.encode_ordinary(whole[at : at + PART])) for at in range(0, len(whole), PART)))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(tokens, pa.int64())], names=schema.names)

    return turns.mapInArrow(count, schema)


SYSTEM, PAST, OWN = range(3)  # what a row is to its run: carried into it, or its own
ORDER = [F.asc_nulls_first, F.asc_nulls_last, F.asc_nulls_last, F.asc_nulls_last]


def _order() -> list:
    return [how(name) for how, name in zip(ORDER, ("conv_id", "turn", "role", "text"))]


def _summed(turns: DataFrame) -> DataFrame:
    """Sorted partitions with their number as ``slice`` and, as ``before``, the tokens of the same
    conversation that come before a turn in it."""
    schema = T.StructType([*turns.schema.fields, T.StructField("slice", T.IntegerType()), T.StructField("before", T.LongType())])

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, last, held = TaskContext.get().partitionId(), add, 0
        for batch in batches:
            if not batch.num_rows:
                continue
            convs = batch.column("conv_id").dictionary_encode("encode")
            codes = convs.indices.to_numpy()
            tokens = batch.column("tokens").to_numpy()
            begins = np.flatnonzero(np.concatenate([[True], codes[1:] != codes[:-1]]))
            lengths = np.diff(np.append(begins, len(codes)))
            before = np.cumsum(tokens) - tokens
            before -= np.repeat(before[begins], lengths)
            names = convs.dictionary.to_pylist()
            if names[codes[0]] == last:
                before[: lengths[0]] += held
            last, held = names[codes[-1]], int(before[-1] + tokens[-1])
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(np.full(len(codes), part, np.int32)), pa.array(before)], names=schema.names
            )

    return turns.mapInArrow(add, schema)


def _runs(counted: DataFrame, slices: int, history: int, run_tokens: int) -> DataFrame:
    """The turns of long conversations by run, and those that are carried into each run.

    Turns are range-partitioned in their order, equal rows by an id besides, so that a conversation runs on
    over neighbouring slices; between those only sums move, one a (conversation, slice). A run is at least
    as long as the history, so a turn is carried into the next run alone.
    """
    pinned = stage(counted.withColumn("__id", F.monotonically_increasing_id()), "turns")
    by = [*_order(), F.asc("__id")]
    found = stage(_summed(pinned.repartitionByRange(slices, *by).sortWithinPartitions(*by).drop("__id")), "slices")
    sums = found.groupBy("conv_id", "slice").agg(F.sum("tokens").alias("tokens"))
    earlier = Window.partitionBy("conv_id").orderBy("slice").rowsBetween(Window.unboundedPreceding, -1)
    offsets = stage(sums.select("conv_id", "slice", F.coalesce(F.sum("tokens").over(earlier), F.lit(0)).alias("offset")), "offsets")
    size = offsets.agg(F.sum(row_bytes(offsets, offsets.columns))).first()[0] or 0
    placed = null_safe_join(found, broadcast_if(offsets, size), ["conv_id", "slice"], "inner")
    placed = placed.withColumn("before", F.col("offset") + F.col("before")).drop("slice", "offset")
    placed = placed.withColumn("run", F.floor(F.col("before") / run_tokens))
    starts = stage(placed.groupBy("conv_id", "run").agg(F.min("before").alias("first")), "runs")
    onward = Window.partitionBy("conv_id").orderBy("run")
    following = starts.select("conv_id", "run", F.lead("run").over(onward).alias("next"), F.lead("first").over(onward).alias("next_first"))
    system = (F.col("before") == 0) & F.coalesce(F.col("role") == "system", F.lit(False))
    near = placed.filter(~system & ((F.col("run") + 1) * run_tokens - F.col("before") <= history))
    past = null_safe_join(near, following, ["conv_id", "run"], "inner").filter(F.col("next_first") - F.col("before") <= history)
    first = null_safe_join(starts.filter("run > 0").select("conv_id", "run"), placed.filter(system).drop("run"), ["conv_id"], "inner")
    parts = [(first, SYSTEM), (past.withColumn("run", F.col("next")), PAST), (placed, OWN)]
    columns = ["conv_id", "run", "role", "text", "tokens", "before"]
    return reduce(DataFrame.unionByName, [rows.select(*columns, F.lit(kind).alias("kind")) for rows, kind in parts])


class _Conversation:
    """Turns of a conversation or a run of it come in, windows go out; holds the system turn, some history
    and what waits."""

    def __init__(self, budget: int, history: int, run: int = 0):
        self.budget, self.most_history, self.run = budget, history, run
        self.system: list[tuple[str, str, int]] = []
        self.past: list[tuple[str, str, int]] = []
        self.waiting: list[tuple[str, str, int]] = []
        self.tokens = 0
        self.seen = self.windows = 0

    def carry(self, turn: tuple[str, str, int], kind: int) -> None:
        """A turn that an earlier run has shown; history comes in its order."""
        if kind == SYSTEM:
            self.system = [turn]
        else:
            self.past.append(turn)

    def add(self, turn: tuple[str, str, int]) -> Iterator[tuple]:
        if self.run == 0 and self.seen == 0 and turn[0] == "system":
            self.system = [turn]
        self.seen += 1
        self.waiting.append(turn)
        self.tokens += turn[2]
        while self.tokens > self.budget and len(self.waiting) > 1:
            yield self._window()

    def end(self) -> Iterator[tuple]:
        while self.waiting:
            yield self._window()

    def _window(self) -> tuple:
        first = self.run == 0 and self.windows == 0
        kept = [] if first else self.system
        sums = np.cumsum([t[2] for t in self.waiting])
        room = self.budget - sum(t[2] for t in kept)
        back = np.cumsum([t[2] for t in reversed(self.past)]) if self.past else np.zeros(0, int)
        n = int(np.searchsorted(back, min(self.most_history, room - sums[0]), "right"))
        repeated = [*kept, *self.past[len(self.past) - n :]]
        room -= int(back[n - 1]) if n else 0
        taken = max(1, int(np.searchsorted(sums, room, "right")))
        fresh, self.waiting = self.waiting[:taken], self.waiting[taken:]
        self.tokens -= int(sums[taken - 1])
        self.past = [t for t in [*self.past, *fresh] if not self.system or t is not self.system[0]]
        held = np.cumsum([t[2] for t in reversed(self.past)]) if self.past else np.zeros(0, int)
        self.past = self.past[len(self.past) - int(np.searchsorted(held, self.most_history, "right")) :]
        out, spans, at = [], [], 0
        for nth, (role, text, _) in enumerate([*repeated, *fresh]):
            rendered, begin, end = render(role, text)
            if nth >= len(repeated) and role == "assistant":
                spans.append({"start": at + begin, "end": at + end})
            out.append(rendered)
            at += len(rendered)
        tokens = sum(t[2] for t in [*repeated, *fresh])
        self.windows += 1
        return self.windows - 1, "".join(out), spans, len(repeated), tokens


def _windows(turns: DataFrame, budget: int, history: int) -> DataFrame:
    """Windows of turns whose runs lie in one partition each, in order, behind what is carried into them."""
    schema = T.StructType(
        [
            turns.schema["conv_id"],
            T.StructField("run", T.LongType()),
            T.StructField("window", T.LongType()),
            T.StructField("text", T.StringType()),
            T.StructField("loss", T.ArrayType(T.StructType([T.StructField("start", T.LongType()), T.StructField("end", T.LongType())]))),
            T.StructField("repeated", T.LongType()),
            T.StructField("tokens", T.LongType()),
        ]
    )
    arrow = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))

    def windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, chat = None, None
        kind = pa.int64()

        def batch_of(rows: list[tuple]) -> pa.RecordBatch:
            columns = list(zip(*rows))
            types = [kind, pa.int64(), pa.int64(), pa.string(), arrow, pa.int64(), pa.int64()]
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], names=schema.names)

        for batch in batches:
            kind = batch.schema.field("conv_id").type
            rows = []
            columns = [batch.column(c).to_pylist() for c in ("conv_id", "run", "kind", "role", "text", "tokens")]
            for conv, run, part, role, text, tokens in zip(*columns):
                if chat is None or (conv, run) != key:
                    if chat is not None:
                        rows += [(*key, *w) for w in chat.end()]
                    key, chat = (conv, run), _Conversation(budget, history, run)
                turn = (role or "", text or "", tokens)
                if part == OWN:
                    rows += [(*key, *w) for w in chat.add(turn)]
                else:
                    chat.carry(turn, part)
            if rows:
                yield batch_of(rows)
        if chat is not None:
            yield batch_of([(*key, *w) for w in chat.end()])

    return turns.mapInArrow(windows, schema)


def formatted_parts(
    turns: DataFrame, tokenizer: str, pattern: str, budget: int = BUDGET, history: int = HISTORY,
    long_bytes: int = LONG_BYTES, run_tokens: int = RUN_TOKENS,
) -> list[DataFrame]:
    """The windows of ``format_chats`` in one or two frames: those of conversations of up to ``long_bytes``,
    each in one partition, in order, and those of the others, by runs of ``run_tokens`` or more, where there
    are any. ``turns`` is read once more to find out."""
    run_tokens = max(run_tokens, history, 1)
    given = turns.select("conv_id", "turn", F.col("role").cast("string").alias("role"), F.col("text").cast("string").alias("text"))
    size = sum((F.coalesce(F.octet_length(c), F.lit(0)) for c in ("role", "text")), F.lit(16).cast("bigint"))
    sizes = given.groupBy("conv_id").agg(F.sum(size).alias("bytes")).filter(F.col("bytes") > long_bytes)
    hot = stage(sizes, "long-conversations")
    n, total, width = hot.agg(F.count(F.lit(1)), F.sum("bytes"), F.sum(row_bytes(hot, hot.columns))).first()
    usual, parts = given, []
    if n:
        ids = broadcast_if(hot.select("conv_id"), width)
        usual = null_safe_join(given, ids, ["conv_id"], "left_anti")
        slices = min(MOST_SLICES, -(-total // (SLICE_RUNS * run_tokens)))
        counted = _counted(null_safe_join(given, ids, ["conv_id"], "left_semi"), tokenizer, pattern)
        runs = _runs(counted, slices, history, run_tokens).repartition("conv_id", "run")
        runs = runs.sortWithinPartitions(F.asc_nulls_first("conv_id"), "run", "kind", "before")
        parts = [_windows(runs, budget, history)]
    whole = _counted(usual, tokenizer, pattern).repartition("conv_id").sortWithinPartitions(*_order())
    whole = whole.withColumns({"run": F.lit(0).cast("bigint"), "kind": F.lit(OWN)})
    return [_windows(whole, budget, history), *parts]


def format_chats(
    turns: DataFrame, tokenizer: str, pattern: str, budget: int = BUDGET, history: int = HISTORY,
    long_bytes: int = LONG_BYTES, run_tokens: int = RUN_TOKENS,
) -> DataFrame:
    """(conv_id, run, window, text, loss, repeated, tokens) from rows of (conv_id, turn, role, text).

    ``loss`` holds the code point spans of ``text`` to learn from, ``repeated`` how many turns at its
    beginning an earlier window has already shown. Windows are numbered in each run; there is one run,
    number 0, but for conversations of more than ``long_bytes``.
    """
    parts = formatted_parts(turns, tokenizer, pattern, budget, history, long_bytes, run_tokens)
    return reduce(DataFrame.unionByName, parts)


def read_back(usual: DataFrame, by_run: DataFrame | None = None) -> DataFrame:
    """A row for each conversation, from its windows alone: counts and digests of turns and targets.

    Takes the frames of ``formatted_parts`` as they are. A digest is taken byte after byte, so the windows
    of a long conversation are streamed through one task here, in order.
    """
    if by_run is not None:
        ordered = by_run.repartition("conv_id").sortWithinPartitions(F.asc_nulls_first("conv_id"), "run", "window")
        return read_back(usual).unionByName(read_back(ordered))
    formatted = usual
    schema = T.StructType(
        [
            formatted.schema["conv_id"],
            *[T.StructField(n, T.StringType() if n.endswith("256") else T.LongType())
              for n in ("n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars")],
        ]
    )

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, state, kind = None, None, pa.int64()

        def batch_of(rows: list[tuple]) -> pa.RecordBatch:
            types = [kind, pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64()]
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)], names=schema.names)

        def closed() -> tuple:
            n, turns, chars, loss, size = state
            return key, n, turns.hexdigest(), chars, loss.hexdigest(), size

        for batch in batches:
            kind = batch.schema.field(0).type
            rows = []
            for conv, text, spans, repeated in zip(*[batch.column(c).to_pylist() for c in ("conv_id", "text", "loss", "repeated")]):
                if state is None or conv != key:
                    if state is not None:
                        rows.append(closed())
                    key, state = conv, [0, hashlib.sha256(), 0, hashlib.sha256(), 0]
                for role, body in read(text)[repeated:]:
                    state[0] += 1
                    state[1].update(f"{role}\n{body}\n".encode("utf-8", "surrogatepass"))
                for span in spans:
                    target = unescape(text[span["start"] : span["end"]])
                    state[2] += len(target)
                    state[3].update(target.encode("utf-8", "surrogatepass"))
                state[4] += len(text)
            if rows:
                yield batch_of(rows)
        if state is not None:
            yield batch_of([closed()])

    return formatted.mapInArrow(digest, schema)
