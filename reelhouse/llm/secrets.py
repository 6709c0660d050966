"""Secret scans (operator 10): assignment, access-key and hex patterns, and spans of
high sliding-window Shannon entropy per character class, with an allow list.

Candidates of the entropy method are runs of token characters.  A window of
``WIDTHS`` characters slides over each run; its character counts change by one
character in and one out per step, and its entropy follows from the sum of
c*log2(c), kept along.  A window counts when all of its characters belong to the
class, it mixes the class's kinds of characters and its entropy reaches the
class's threshold.  Every class asks for a digit.  Overlapping windows join to
one span; what a pattern's span covers of it is left out and the rest is
reported.  A token that the allow list names (up to the length of a sample key or
of its digest) is left out of the run, the parts around it are scanned.

Edge cases: a null text counts as empty and has no spans; offsets are code
points, end exclusive; texts are scanned whole; repeated rows give equal rows.
"""

from __future__ import annotations

import hashlib
import math
import re

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F
from pyspark.sql import types as T

from reelhouse.llm.util import add_columns

ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
                    re.IGNORECASE | re.ASCII)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{32,}")  # maximal runs, as [0-9a-f]+ finds them, of 32 and more
KINDS = ("assign", "access", "hex", "entropy")

WINDOW = 24
#: class -> (its characters, entropy threshold in bits, kinds that a window must mix)
CLASSES = {
    "hex": (frozenset("0123456789abcdefABCDEF"), 3.0, ("09", "afAF")),
    "base64": (frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_=-"), 3.9,
               ("09", "az", "AZ")),
    "lower": (frozenset("abcdefghijklmnopqrstuvwxyz0123456789"), 3.3, ("09", "az")),
    "upper": (frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789"), 3.0, ("09", "AZ")),
}
WIDTHS = {"hex": WINDOW, "base64": WINDOW, "lower": 20, "upper": 16}
CANDIDATE = re.compile(r"[A-Za-z0-9+/_=-]{%d,}" % min(WIDTHS.values()))
#: class -> its maximal runs that a window fits in
STRETCHES = {name: re.compile("[%s]{%d,}" % (re.escape("".join(sorted(chars))), WIDTHS[name])) for name, (chars, _, _) in CLASSES.items()}
DIGIT = re.compile("[0-9]")
#: Strings that look random and are no secrets: UUIDs, labelled digests, documented sample keys.
ALLOW = re.compile(r"^[0-9a-fA-F]{8}(-[0-9a-fA-F]{4}){3}-[0-9a-fA-F]{12}$|^sha(1|256|384|512)-|EXAMPLE|^[0-9-]+$|0123456789|abcdefghij")
SAMPLE = 40  # characters of the longest documented sample key and of a UUID, at most
#: A digest and its label; what follows its last character is not part of it.
DIGEST = re.compile(r"sha(?:1-[\w+/-]{0,27}|256-[\w+/-]{0,43}|384-[\w+/-]{0,64}|512-[\w+/-]{0,86})={0,2}", re.ASCII)
TOKEN = re.compile("[^=]+")
C_LOG_C = [0.0] + [c * math.log2(c) for c in range(1, WINDOW + 2)]


def kind_of(ch: str) -> int:
    """0 digit, 1 lower hex, 2 other lower, 3 upper hex, 4 other upper, 5 rest."""
    if ch.isdigit():
        return 0
    if ch.islower():
        return 1 if ch <= "f" else 2
    if ch.isupper():
        return 3 if ch <= "F" else 4
    return 5


MIXES = {"hex": ((0,), (1, 3)), "base64": ((0,), (1, 2), (3, 4)), "lower": ((0,), (1, 2)), "upper": ((0,), (3, 4))}


def entropy_windows(run: str, chars: frozenset, least: float, mixes: tuple, width: int = WINDOW) -> list[tuple[int, int]]:
    """Joined [start, end) of the windows of ``run`` that reach the threshold."""
    counts: dict[str, int] = {}
    kinds = [0] * 6
    total, foreign = 0.0, 0
    found: list[list[int]] = []
    for i, ch in enumerate(run):
        c = counts.get(ch, 0)
        counts[ch] = c + 1
        total += C_LOG_C[c + 1] - C_LOG_C[c]
        kinds[kind_of(ch)] += 1
        foreign += ch not in chars
        if i >= width:
            old = run[i - width]
            c = counts[old]
            counts[old] = c - 1
            total -= C_LOG_C[c] - C_LOG_C[c - 1]
            kinds[kind_of(old)] -= 1
            foreign -= old not in chars
        if (i >= width - 1 and not foreign and math.log2(width) - total / width >= least
                and all(any(kinds[k] for k in group) for group in mixes)):
            if found and found[-1][1] >= i - width + 1:
                found[-1][1] = i + 1
            else:
                found.append([i - width + 1, i + 1])
    return [tuple(x) for x in found]


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, kind, end) of the patterns' matches, leftmost and non-overlapping per kind."""
    spans = [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if m.end(2) - m.start(2) >= 8]
    spans += [(m.start(), 1, m.end()) for m in ACCESS.finditer(text) if m.end() - m.start() >= 16]
    spans += [(m.start(), 2, m.end()) for m in HEX.finditer(text)]
    return sorted(spans)


def subtract(spans: list[tuple[int, int]], holes: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """What ``holes`` (sorted by start) leave of ``spans``."""
    out = []
    for a, b in spans:
        for s, e in holes:
            if s >= b:
                break
            if e > a:
                if s > a:
                    out.append((a, s))
                a = e
        if a < b:
            out.append((a, b))
    return out


def allowed(run: str) -> list[tuple[int, int]]:
    """Allow-listed tokens of a candidate run."""
    if not ALLOW.search(run):
        return []
    m = DIGEST.match(run)
    out = [m.span()] if m else []
    at = out[0][1] if out else 0
    return out + [m.span() for m in TOKEN.finditer(run, at) if m.end() - m.start() <= SAMPLE and ALLOW.search(m.group())]


def entropy_spans(text: str, base: list[tuple[int, int, int]]) -> list[tuple[int, int, int]]:
    """Spans of high entropy: what ``base`` and allow-listed tokens leave of them."""
    found: list[tuple[int, int]] = []
    for m in CANDIDATE.finditer(text):
        run = m.group()
        if not DIGIT.search(run):
            continue
        windows = []
        for at, z in subtract([(0, len(run))], allowed(run)):
            for name, (chars, least, _) in CLASSES.items():
                for x in STRETCHES[name].finditer(run, at, z):
                    if DIGIT.search(run, x.start(), x.end()):
                        windows += [(x.start() + a, x.start() + b) for a, b in
                                    entropy_windows(x.group(), chars, least, MIXES[name], WIDTHS[name])]
        end = -1
        for a, b in sorted(windows):
            if a <= end:
                end = max(end, b)
                found[-1] = (found[-1][0], m.start() + end)
            else:
                end = b
                found.append((m.start() + a, m.start() + b))
    holes = sorted((s, e) for s, _, e in base)
    return [(a, 3, b) for a, b in (subtract(found, holes) if holes else found)]


def joined(spans) -> str:
    return ",".join(f"{KINDS[k]}:{s}:{e}" for s, k, e in spans)


def scan_text(text: str | None):
    """(base spans, all spans), each sorted by start, then kind."""
    text = text or ""
    base = base_spans(text)
    return base, sorted(base + entropy_spans(text, base))


def scan_secrets(docs: DataFrame) -> DataFrame:
    """doc_id, n_assign, n_access, n_hex, n_entropy, base_sha256, spans of every row."""

    def scan(b: pa.RecordBatch) -> list:
        counts, shas, spans = [[], [], [], []], [], []
        for text in b.column(b.schema.get_field_index("text")).to_pylist():
            base, every = scan_text(text)
            for k, col in enumerate(counts):
                col.append(sum(x[1] == k for x in every))
            shas.append(hashlib.sha256(joined(base).encode()).hexdigest())
            spans.append(joined(every))
        return [pa.array(c, pa.int64()) for c in counts] + [pa.array(shas, pa.string()), pa.array(spans, pa.string())]

    fields = [T.StructField(f"n_{k}", T.LongType()) for k in KINDS]
    fields += [T.StructField("base_sha256", T.StringType()), T.StructField("spans", T.StringType())]
    return add_columns(docs.select("doc_id", "text"), scan, fields, drop=("text",))


def redact_text(text: str | None, mark: str = "[SECRET]") -> str | None:
    """``text`` with every span replaced by ``mark`` (overlapping spans by one)."""
    if not text:
        return text
    out, at = [], 0
    for s, _, e in scan_text(text)[1]:
        if e <= at:
            continue
        if s >= at:
            out += [text[at:s], mark]
        at = e
    return "".join([*out, text[at:]]) if out else text


def redact_secrets(docs: DataFrame) -> DataFrame:
    """``docs`` with secrets masked in ``text``; ``n_chars``, if there, follows the text."""

    def redact(b: pa.RecordBatch) -> list:
        texts = b.column(b.schema.get_field_index("text")).to_pylist()
        return [pa.array([redact_text(x) for x in texts], pa.string())]

    out = add_columns(docs, redact, [T.StructField("__redacted", T.StringType())])
    changed = ~F.col("__redacted").eqNullSafe(F.col("text"))
    if "n_chars" in docs.columns:
        kind = docs.schema["n_chars"].dataType
        out = out.withColumn("n_chars", F.when(changed, F.length("__redacted").cast(kind)).otherwise(F.col("n_chars")))
    return out.withColumn("text", F.col("__redacted")).select(*docs.columns)
