"""Transcript parsing with a hidden Markov model.

The lines of a transcript are observations: which speaker marker opens them, whether a blank line stands before them,
how long they are and how they end. The hidden states are the roles, each as the first line of a turn or as a later
one. Start, transition and observation probabilities are learned by counting labelled lines; the most probable
sequence of states (Viterbi) gives the turns, which are rendered in one canonical form.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from supportlens.llm.rows import ROW, identified, numbered

ROLES = ("system", "user", "assistant")
#: Speaker names by role; case doesn't matter.
NAMES = {
    "system": ("system", "sys", "instruction", "instructions", "context"),
    "user": ("user", "human", "customer", "client", "question", "q", "prompt", "me"),
    "assistant": ("assistant", "ai", "bot", "agent", "chatbot", "model", "answer", "a", "response"),
}
ROLE_OF = {name: role for role, names in NAMES.items() for name in names}
#: A speaker name alone on its line or followed by a sign; a dash for a speaker without a name.
MARKER = re.compile(
    r"\s*(?:(?:#+\s*|\*\*|<\||\[|\()(?P<decorated>[A-Za-z]{1,12})(?:\s*:)?(?:\*\*|\|>|\]|\))?(?:\s*:)?(?:\s+|\Z)"
    r"|(?P<plain>[A-Za-z]{1,12})\s?[:>](?:\s+|\Z)|(?P<dash>[-–—*])\s+)"
)
STATES = tuple((role, first) for role in ROLES for first in (True, False))
SMOOTHING, BEGIN = 0.1, len(STATES)
#: Turn numbers in one transcript; a longer conversation is several transcripts.
TURNS = 256
VALUES = {"marker": (*ROLES, "unnamed", "none"), "gap": ("begin", "blank", "none"), "length": tuple(range(13)), "end": ("?", ".", ":", "")}
FEATURES = tuple((name, value) for name, values in VALUES.items() for value in values)
PLACE = {f: i for i, f in enumerate(FEATURES)}


def marked(line: str) -> tuple[str, str]:
    """The marker that opens a line (a role, ``unnamed`` or ``none``) and the rest of the line."""
    found = MARKER.match(line)
    if found:
        name = found["decorated"] or found["plain"]
        role = "unnamed" if name is None else ROLE_OF.get(name.lower())
        if role:
            return role, line[found.end() :]
    return "none", line


def observed(lines: Sequence[str]) -> list[tuple[int, list[int]]]:
    """Index and features of every line that isn't blank."""
    out, gap = [], "begin"
    for i, line in enumerate(lines):
        bare = line.strip()
        if not bare:
            gap = gap if gap == "begin" else "blank"
            continue
        end = bare[-1] if bare[-1] in "?.:" else ""
        length = min(len(bare).bit_length(), 12)
        out.append((i, [PLACE["marker", marked(line)[0]], PLACE["gap", gap], PLACE["length", length], PLACE["end", end]]))
        gap = "none"
    return out


@dataclass(frozen=True)
class Hmm:
    """Log-probabilities: of a state after a state (the last row: at the begin), of a feature in a state."""

    moves: np.ndarray
    emits: np.ndarray

    def viterbi(self, features: Sequence[Sequence[int]]) -> list[int]:
        """Most probable states of the lines; of equally probable ones the first."""
        if not len(features):
            return []
        seen = np.array([self.emits[:, f].sum(axis=1) for f in features])
        best, back = self.moves[BEGIN] + seen[0], []
        for row in seen[1:]:
            through = best[:, None] + self.moves[:BEGIN]
            back.append(through.argmax(axis=0))
            best = through.max(axis=0) + row
        path = [int(best.argmax())]
        for step in reversed(back):
            path.append(int(step[path[-1]]))
        return path[::-1]


def allowed() -> np.ndarray:
    """A later line follows a line of its own role; the first line of a turn may follow any."""
    return np.array([[first or (a < BEGIN and STATES[a][0] == role) for role, first in STATES] for a in range(BEGIN + 1)])


def labelled(turns: Sequence[tuple[str | None, str]]) -> list[tuple[int | None, list[int]]]:
    """State and features of the lines of rendered turns (role, lines with their marker); no state for unknown roles."""
    lines, states = [], []
    for role, text in turns:
        first = True
        for line in text.split("\n"):
            lines.append(line)
            states.append(STATES.index((role, first)) if role in ROLES else None)
            first = first and not line.strip()
    return [(states[i], f) for i, f in observed(lines)]


def train(transcripts: DataFrame) -> Hmm:
    """Learn from all rows of ``turns`` (array of role and rendered text). Of turns with an unknown or null role and of
    the steps into and out of them nothing is learned. The counts that reach the driver are a fixed number of states
    times features."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = Counter()
        for batch in batches:
            for turns in batch.column(0).to_pylist():
                at = BEGIN
                for state, features in labelled([(t["role"], t["text"]) for t in turns or ()]):
                    if state is not None:
                        found.update([(1, state, f) for f in features])
                        if at is not None:
                            found[0, at, state] += 1
                    at = state
        rows = [(*k, n) for k, n in found.items()]
        columns = list(zip(*rows, strict=True)) if rows else [()] * 4
        yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], ["kind", "a", "b", "n"])

    table = transcripts.select("turns").mapInArrow(run, "kind long, a long, b long, n long")
    counts = table.groupBy("kind", "a", "b").agg(F.sum("n").alias("n")).collect()
    moves, emits = np.full((BEGIN + 1, BEGIN), SMOOTHING), np.full((BEGIN, len(FEATURES)), SMOOTHING)
    for kind, a, b, n in counts:
        (emits if kind else moves)[a, b] += n
    moves = np.where(allowed(), moves, 0)
    with np.errstate(divide="ignore"):
        moves = np.log(moves / moves.sum(axis=1, keepdims=True))
    start = 0
    for values in VALUES.values():
        part = slice(start, start + len(values))
        emits[:, part] /= emits[:, part].sum(axis=1, keepdims=True)
        start += len(values)
    return Hmm(moves, np.log(emits))


TAG, TAGGED, UNTAG = re.compile(r"<(\\*)\|"), r"<\\\1|", re.compile(r"<\\(\\*)\|")
TURN = re.compile(r"<\|(\w+)\|>\n(.*?)\n<\|end\|>\n", re.DOTALL)


def turns_of(text: str | None, model: Hmm) -> list[tuple[str, str]]:
    """Role and text of each turn; markers and the blank lines around a turn are gone."""
    lines = re.split(r"\r\n|\r|\n", text or "")
    seen = observed(lines)
    path, out = model.viterbi([f for _, f in seen]), []
    for number, ((i, _), state) in enumerate(zip(seen, path, strict=True)):
        role, first = STATES[state]
        if first or not out:
            out.append((role, [marked(lines[i])[1]]))
        else:
            out[-1][1].extend(lines[seen[number - 1][0] + 1 : i + 1])
    return [(role, "\n".join(part).strip("\n")) for role, part in out]


def canonical(turns: Sequence[tuple[str, str]]) -> str:
    """Turns between tags. What looks like the begin of a tag in a text gets a backslash, so ``from_canonical`` reads
    the same turns back."""
    return "".join(f"<|{role}|>\n{TAG.sub(TAGGED, text)}\n<|end|>\n" for role, text in turns)


def from_canonical(text: str) -> list[tuple[str, str]]:
    """Role and text of the turns of a canonical text."""
    return [(role, UNTAG.sub(r"<\1|", said)) for role, said in TURN.findall(text)]


def parse(transcripts: DataFrame, model: Hmm, text: str = "transcript") -> DataFrame:
    """``transcripts`` without the text, with ``n_turns``, ``roles`` (joined by commas) and the ``canonical`` text.

    A null, empty or blank transcript has no turns and an empty canonical text. Rows are parsed one by one: repeated
    rows give equal results, an empty table an empty one. The three columns replace ones of the same name.
    """
    others = [c for c in transcripts.columns if c not in (text, "n_turns", "roles", "canonical")]
    rows = transcripts.select(*[F.col(f"`{c}`") for c in others], F.col(text).alias("_llm_text"))
    schema = rows.drop("_llm_text").schema.add("n_turns", "long").add("roles", "string").add("canonical", "string")
    shared = transcripts.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [turns_of(t.as_py(), shared.value) for t in batch.column(batch.num_columns - 1)]
            columns = [batch.column(i) for i in range(batch.num_columns - 1)]
            yield pa.RecordBatch.from_arrays(
                [*columns, pa.array([len(t) for t in found], pa.int64()), pa.array([",".join(r for r, _ in t) for t in found], pa.string()), pa.array([canonical(t) for t in found], pa.string())],
                [*others, "n_turns", "roles", "canonical"],
            )

    return rows.mapInArrow(run, schema)


#: Styles in which conversations are written out: the markers of the three roles, and which turns lack theirs.
STYLES = (
    ("System: ", "User: ", "Assistant: ", 0), ("Instructions: ", "Human: ", "AI: ", 0), ("[SYSTEM] ", "[USER] ", "[ASSISTANT] ", 0),
    ("### System\n", "### User\n", "### Assistant\n", 0), ("<|system|> ", "Q: ", "A: ", 3), ("- ", "- ", "- ", 0),
)


def transcribed(conversations: DataFrame, style: Column | None = None) -> DataFrame:
    """Transcripts of the conversations: ``conv_id``, ``part``, ``style``, ``turns`` (role and rendered text) and ``transcript``.

    The style depends on the conversation; a turn without a role has a dash for a marker. Every row is a turn, repeated
    ones too. Turns are ordered by number (null: 0), role and text, nulls first, and equal ones as they are stored. A
    part holds ``TURNS`` turns, so that a very long conversation isn't one row or the work of one task.
    """
    number = F.coalesce(F.col("turn"), F.lit(0)).cast("long")
    kind = F.coalesce(F.crc32(F.col("conv_id").cast("string")), F.lit(0)) % len(STYLES) if style is None else style
    turns = identified(conversations).select("conv_id", number.alias("turn"), "role", F.coalesce("text", F.lit("")).alias("text"), *ROW)
    placed = numbered(turns, F.col("conv_id"), ["turn", "role", "text", *ROW], "chat-turns")
    rows = placed.select("conv_id", F.floor(F.col("i") / TURNS).alias("part"), "i", "turn", "role", "text")
    marker = F.lit("- ")
    for i, (*markers, missing) in enumerate(STYLES):
        for role, value in zip(ROLES, markers, strict=True):
            shown = F.lit(value) if not missing else F.when(F.col("turn") % missing == missing - 1, "").otherwise(value)
            marker = F.when((F.col("style") == i) & (F.col("role") == role), shown).otherwise(marker)
    told = rows.withColumn("style", kind.cast("int")).withColumn("said", F.concat(marker, F.col("text")))
    grouped = told.groupBy("conv_id", "part", "style").agg(F.sort_array(F.collect_list(F.struct("i", "role", "said"))).alias("said"))
    return grouped.select(
        "conv_id", "part", "style",
        F.transform("said", lambda t: F.struct(t["role"].alias("role"), F.concat(t["said"], F.lit("\n")).alias("text"))).alias("turns"),
        F.array_join(F.transform("said", lambda t: t["said"]), "\n\n").alias("transcript"),
    )
