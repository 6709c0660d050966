"""Chat formatting (operator 3): transcript parsing by a hidden Markov model.

A transcript is the lines of one conversation in turn order.  Lines that open
with a speaker marker start a new segment; a row starts one as well.  Each
segment is an observation: its marker, its number of lines, its length, whether
it opens the conversation.  Hidden states are roles.  The model's start,
transition and emission probabilities are counted over all labelled training
rows (with add-one smoothing); Viterbi recovers the roles, and turns are
rendered in one canonical form.

A conversation may hold any share of the rows.  Segments are range-partitioned
by (conversation, turn), so a long one spans partitions.  Each partition's part
of a conversation becomes one max-plus matrix (states x states); the matrices
of a conversation (at most one per partition) fix the states at the parts'
borders, and each part then runs Viterbi between its borders.

Edge cases: null texts count as empty, null roles never train, null conversation
ids form one conversation, null turns come first; ties between states go to the
role that sorts first; rows that tie in turn are ordered by text, role and
length; repeated rows are turns of their own; an empty table gives an empty
result.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, functions as F

from reelhouse.llm.util import shuffle_partitions

ROLES = ("assistant", "system", "user")
#: Speaker markers at the start of a line, by role (fixed values).
MARKERS = {
    "user": ("user", "human", "question", "q", "customer", "me"),
    "assistant": ("assistant", "ai", "bot", "answer", "a", "agent", "model"),
    "system": ("system", "instruction", "instructions"),
}
MARKER = re.compile(r"^[ \t]*(?:\*\*|<\|?|\[|#{1,4} *)?(" + "|".join(sorted(sum(MARKERS.values(), ()), key=len, reverse=True))
                    + r")(?:\|?>|\]|\*\*)?[ \t]*[:>][ \t]*", re.IGNORECASE)
ROLE_OF = {m: r for r, ms in MARKERS.items() for m in ms}


def segments_of(text: str | None) -> list[tuple[str, str]]:
    """(marker's role or '', text) of the stretches that speaker markers open."""
    out: list[list] = []
    for line in (text or "").split("\n"):
        m = MARKER.match(line)
        if m:
            out.append([ROLE_OF[m.group(1).lower()], [line[m.end():]]])
        elif out:
            out[-1][1].append(line)
        else:
            out.append(["", [line]])
    if len(out) > 1 and not out[0][0] and not any(x.strip() for x in out[0][1]):
        out = out[1:]
    return [(marker, "\n".join(lines)) for marker, lines in out]


def observation(marker: str, text: str) -> str:
    """Speaker-marker and line features of a segment as one symbol each, joined."""
    lines = text.count("\n") + 1
    mark = f"m:{marker or 'none'}"
    ends = text.rstrip()[-1:]
    return " ".join((mark, f"n:{min(lines, 6)}", f"w:{min(len(text).bit_length(), 14)}",
                     f"q:{int(ends == '?')}"))


def render(role: str, text: str) -> str:
    """Canonical form of a turn."""
    return f"<|{role}|>\n{text.strip()}\n<|end|>"


@dataclass
class Model:
    roles: tuple[str, ...]
    start: np.ndarray
    step: np.ndarray
    emit: dict[str, np.ndarray] = field(default_factory=dict)  # feature -> log probability by role
    seen: dict[str, np.ndarray] = field(default_factory=dict)  # kind of feature -> log probability of an unseen value

    def emission(self, symbols: str) -> np.ndarray:
        total = np.zeros(len(self.roles))
        for s in symbols.split(" "):
            p = self.emit.get(s)
            total = total + (p if p is not None else self.seen.get(s[0], 0.0))
        return total


SEGMENTS = ("conv_id long, turn long, seg long, role string, train boolean, marker string, symbols string, text string")


def to_segments(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        out: list[list] = [[] for _ in range(8)]
        for conv, turn, role, text, train in zip(*(b.column(i).to_pylist() for i in range(5))):
            for k, (marker, part) in enumerate(segments_of(text)):
                for col, x in zip(out, (conv, turn, k, role, train, marker, observation(marker, part), part)):
                    col.append(x)
        kinds = [pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.bool_(), pa.string(), pa.string(), pa.string()]
        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(out, kinds)],
                                         names=[x.split(" ")[0] for x in SEGMENTS.split(", ")])


def parts_of(batches: Iterator[pa.RecordBatch], names: tuple[str, ...]) -> Iterator[tuple]:
    """(conversation, whether a new part of it begins, row) over a sorted partition."""
    at, first = None, True
    for b in batches:
        for row in zip(*(b.column(b.schema.get_field_index(n)).to_pylist() for n in names)):
            yield row[0], first or row[0] != at, row
            at, first = row[0], False


def count_steps(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Role transitions and starts of a partition's labelled training rows."""
    counts: dict[tuple, int] = {}
    last = None
    for conv, new, (_, seg, turn, role, train) in parts_of(batches, ("conv_id", "seg", "turn", "role", "train")):
        if not train or role is None or seg:
            last = last if seg and not new else None
            continue
        key = ("" if new or last is None else last, role)
        counts[key] = counts.get(key, 0) + 1
        last = role
    rows = [(*k, v) for k, v in counts.items()]
    yield pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows], pa.string()), pa.array([r[1] for r in rows], pa.string()),
                                      pa.array([r[2] for r in rows], pa.int64())], names=["before", "role", "n"])


def learn(segments: DataFrame) -> Model:
    """Counts over all labelled training segments; the driver gets sums by role and feature only."""
    steps = (segments.select("conv_id", "seg", "turn", "role", "train").mapInArrow(count_steps, "before string, role string, n long")
             .groupBy("before", "role").agg(F.sum("n").alias("n")).collect())
    known = segments.filter("train and role is not null and seg = 0")
    seen = (known.select("role", F.explode(F.split("symbols", " ")).alias("s")).groupBy("role", "s").count().collect())
    roles = tuple(sorted({r["role"] for r in seen} | ({*ROLES} if not seen else set())))
    index = {r: i for i, r in enumerate(roles)}
    k = len(roles)
    start, step = np.ones(k), np.ones((k, k))
    for r in steps:
        if r["before"]:
            step[index[r["before"]], index[r["role"]]] += r["n"]
        else:
            start[index[r["role"]]] += r["n"]
    table: dict[str, np.ndarray] = {}
    for r in seen:
        table.setdefault(r["s"], np.zeros(k))[index[r["role"]]] += r["count"]
    for role in roles:  # a marker names its role even where training has none
        if role in MARKERS:
            row = table.setdefault(f"m:{role}", np.zeros(k))
            if not row.any():
                row[index[role]] = max(10.0, sum(v[index[role]] for s, v in table.items() if s[0] == "n"))
    emit, unseen = {}, {}
    for kind in {s[0] for s in table}:
        own = {s: v for s, v in table.items() if s[0] == kind}
        total = sum(own.values()) + 0.1 * (len(own) + 1)
        emit |= {s: np.log((v + 0.1) / total) for s, v in own.items()}
        unseen[kind] = np.log(0.1 / total)
    return Model(roles, np.log(start / start.sum()), np.log(step / step.sum(axis=1, keepdims=True)), emit, unseen)


def matrices(model: Model):
    """Max-plus matrix of every partition's part of a conversation: [state before, state at its end]."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pid, out, m, at = TaskContext.get().partitionId(), [], None, None
        for conv, new, (_, symbols) in parts_of(batches, ("conv_id", "symbols")):
            e = model.emission(symbols)
            if new:
                if m is not None:
                    out.append((at, m))
                first = model.start + e  # as the conversation's first segment
                m, at = np.vstack([model.step + e, first]), conv
            else:
                m = (m[:, :, None] + model.step[None]).max(axis=1) + e
        if m is not None:
            out.append((at, m))
        yield pa.RecordBatch.from_arrays(
            [pa.array([c for c, _ in out], pa.int64()), pa.array([pid] * len(out), pa.int64()),
             pa.array([x.ravel().tolist() for _, x in out], pa.list_(pa.float64()))], names=["conv_id", "pid", "m"])

    return run


def borders(k: int):
    """For each conversation: the state before each part (-1: none) and at its end."""

    def run(key, pdf):
        import pandas as pd

        pdf = pdf.sort_values("pid")
        score, back = None, []
        for m in pdf["m"]:
            m = np.array(m).reshape(k + 1, k)
            if score is None:
                score = m[k]
                back.append(np.full(k, -1))
            else:
                paths = score[:, None] + m[:k]
                back.append(paths.argmax(axis=0))
                score = paths.max(axis=0)
        ends = [int(np.argmax(score))]
        for b in back[:0:-1]:
            ends.append(int(b[ends[-1]]))
        ends = ends[::-1]
        return pd.DataFrame({"conv_id": pdf["conv_id"].to_numpy(), "pid": pdf["pid"].to_numpy(), "before": [-1, *ends[:-1]], "ending": ends})

    return run


def decode_part(model: Model, symbols: list[str], before: int, ending: int) -> list[int]:
    """Viterbi over one part between its border states."""
    score = model.emission(symbols[0]) + (model.start if before < 0 else model.step[before])
    back = []
    for s in symbols[1:]:
        paths = score[:, None] + model.step
        back.append(paths.argmax(axis=0))
        score = paths.max(axis=0) + model.emission(s)
    out = [ending if ending >= 0 else int(score.argmax())]
    for b in reversed(back):
        out.append(int(b[out[-1]]))
    return out[::-1]


PARSED = "conv_id long, turn long, seg long, role_pred string, rendered string, held_out boolean"


def decode(model: Model, sent):
    """Roles and canonical turns of a partition; ``sent``: borders of conversations that span partitions."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pid = TaskContext.get().partitionId()
        known = {c: (b, e) for c, p, b, e in sent.value if p == pid}
        rows: list[tuple] = []

        def flush():
            before, ending = known.get(rows[0][0], (-1, -1))
            states = decode_part(model, [r[4] for r in rows], before, ending)
            out = [(r[0], r[1], r[2], model.roles[s], render(model.roles[s], r[3]), not r[5]) for r, s in zip(rows, states)]
            rows.clear()
            cols = list(zip(*out))
            kinds = [pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.string(), pa.bool_()]
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds)],
                                              names=[x.split(" ")[0] for x in PARSED.split(", ")])

        for _, new, row in parts_of(batches, ("conv_id", "turn", "seg", "text", "symbols", "train")):
            if new and rows:
                yield flush()
            rows.append(row)
        if rows:
            yield flush()

    return run


def parse_transcripts(conversations: DataFrame, train: Column) -> DataFrame:
    """Roles and canonical turns of every segment; learns roles from the ``train`` rows only."""
    spark = conversations.sparkSession
    rows = conversations.select(F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"),
                                "role", "text", F.coalesce(train, F.lit(False)).alias("train"))
    order = ("conv_id", "turn", F.coalesce("text", F.lit("")), "role", "train")
    dealt = rows.repartitionByRange(shuffle_partitions(spark), "conv_id", "turn", F.xxhash64("text")).sortWithinPartitions(*order)
    segments = dealt.mapInArrow(to_segments, SEGMENTS).checkpoint()  # keeps partitions and their order
    model = learn(segments)
    parts = segments.select("conv_id", "symbols").mapInArrow(matrices(model), "conv_id long, pid long, m array<double>")
    # only conversations that span partitions need borders: at most one for each partition but the last
    spanning = parts.groupBy("conv_id").agg(F.min("pid").alias("a"), F.max("pid").alias("b")).filter("a < b").select(F.col("conv_id").alias("c"))
    wide = parts.join(F.broadcast(spanning), F.col("conv_id").eqNullSafe(F.col("c"))).drop("c")
    fixed = wide.groupBy("conv_id").applyInPandas(borders(len(model.roles)), "conv_id long, pid long, before long, ending long")
    sent = spark.sparkContext.broadcast([tuple(r) for r in fixed.collect()])  # at most two for each partition
    return segments.mapInArrow(decode(model, sent), PARSED)
