"""Operator 7: transcript parsing by a hidden Markov model, and canonical rendering of the turns.

A transcript is a sequence of lines without roles, given in order. Each line is observed by its speaker marker (a
name before a colon, in brackets, or in a chat tag; read through ``MARKERS``), its number of words (in powers of two), and
whether it ends in a question mark. The hidden state of a line is its role and whether it opens a turn. Start, transition
and emission probabilities are counted (with add-one smoothing) over all labelled lines; Viterbi recovers the states, and
each line is rendered with ``<|role|>`` where a turn opens and ``<|end|>`` where the last one closes.

Scale: a transcript may be longer than a task should hold, so lines are dealt by ranges of (transcript, place) and decoded in
chunks of at most ``CHUNK`` lines, exactly. Viterbi steps are products of matrices over (max, +), which are associative:
every chunk first gives the best score from each entry state to each end state; a transcript's few chunk matrices (one row a
chunk) then fix the states at its chunk borders; and last, each chunk is decoded between its border states.

Defined results: null text is an empty line; a text of several lines counts line by line; rows that share transcript and place
are ordered by their text; null ids form one transcript, nulls first; without labelled lines all states are alike, and ties go
to the first role listed; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.llm.common import bounded_batches, fold, read, written

# Roles and the speaker names that mark them.
ROLES = ["user", "assistant", "system"]
MARKERS = {"user": ["user", "human", "question", "q", "customer", "me"], "assistant": ["assistant", "ai", "bot", "answer", "a", "model"],
           "system": ["system", "context", "instructions", "sys"]}
CHUNK = 1024
KINDS = len(ROLES) + 2  # no marker, one of each role, another name
SIZES = 8
STATES = 2 * len(ROLES)  # role * 2 + (0 opens a turn, 1 goes on)
MARKER = r"^\s*(?:<\|([A-Za-z]{1,12})\|>|\[([A-Za-z]{1,12})\]|([A-Za-z]{1,12}):)\s*"


def observed(line: Column) -> Column:
    """Number of a line's observation: marker kind, size class, question mark."""
    name = F.lower(F.concat(*[F.regexp_extract(line, MARKER, k) for k in (1, 2, 3)]))
    kind = F.when(name == "", 0)
    for k, role in enumerate(ROLES):
        kind = kind.when(name.isin(MARKERS[role]), k + 1)
    words = F.size(F.split(F.trim(line), r"\s+"))
    size = F.least(F.floor(F.log2(words.cast("double"))), F.lit(SIZES - 1)).cast("int")
    return ((kind.otherwise(KINDS - 1) * SIZES + size) * 2 + F.trim(line).endswith("?").cast("int")).cast("int")


def lines_of(messages: DataFrame) -> DataFrame:
    """(id, place, part, line, obs) and ``role`` where ``messages`` (id, place, text) has it: one row a line."""
    labels = [c for c in ("role",) if c in messages.columns]
    some = messages.select("id", "place", *labels, F.coalesce("text", F.lit("")).alias("text"))
    split = some.select("id", "place", *labels, F.xxhash64("text").alias("tie"), F.posexplode(F.split("text", "\n")).alias("part", "line"))
    return split.withColumn("obs", observed(F.col("line")))


class Chain:
    """Log-probabilities: start (state), move (state, state), emit (state, observation)."""

    def __init__(self, start: np.ndarray, move: np.ndarray, emit: np.ndarray):
        self.start, self.move, self.emit = (np.log((x + 1) / (x + 1).sum(-1, keepdims=True)) for x in (start, move, emit))
        # A line that goes on keeps its turn's role; a transcript opens with a turn.
        for s in range(STATES):
            for t in range(1, STATES, 2):
                if s // 2 != t // 2:
                    self.move[s, t] = -np.inf
        self.start[1::2] = -np.inf


def fit_chain(messages: DataFrame) -> Chain:
    """Counts over all labelled messages (id, place, text, role): small tables of states and observations."""
    role = F.array_position(F.array(*[F.lit(r) for r in ROLES]), F.lower("role")) - 1
    known = messages.filter(F.lower("role").isin(ROLES)).withColumn("role", role.cast("int"))
    lines = lines_of(known).withColumn("state", F.col("role") * 2 + (F.col("part") > 0).cast("int"))
    emit = np.zeros((STATES, KINDS * SIZES * 2))
    for r in lines.groupBy("state", "obs").count().collect():
        emit[r["state"], r["obs"]] = r["count"]
    # Inside a turn: one opening line, then the others. Between turns: a message and the next place of its transcript.
    turn = known.select("id", "place", "role", (F.size(F.split(F.coalesce("text", F.lit("")), "\n")) - 1).alias("more"))
    move, start = np.zeros((STATES, STATES)), np.zeros(STATES)
    for r in turn.groupBy("role").agg(F.sum((F.col("more") > 0).cast("long")).alias("second"), F.sum("more").alias("more")).collect():
        move[2 * r["role"], 2 * r["role"] + 1] = r["second"]
        move[2 * r["role"] + 1, 2 * r["role"] + 1] = r["more"] - r["second"]
    last = turn.select("id", (F.col("place") + 1).alias("place"), (F.col("role") * 2 + (F.col("more") > 0).cast("int")).alias("from"))
    # Equal (id, place) rows are counted first, so that repeats don't multiply in the join.
    now = turn.groupBy("id", "place", "role").agg(F.count("*").alias("n"))
    before = last.groupBy("id", "place", "from").agg(F.count("*").alias("m"))
    pairs = now.join(before, ["id", "place"], "left").groupBy("role", "from").agg(F.sum(F.least("n", F.coalesce("m", "n"))).alias("n"))
    for r in pairs.collect():
        if r["from"] is None:
            start[2 * r["role"]] += r["n"]
        else:
            move[r["from"], 2 * r["role"]] += r["n"]
    return Chain(start, move, emit)


def products(chain: Chain, obs: np.ndarray, opens: bool) -> np.ndarray:
    """(entry state, end state) best scores over some lines; an opening chunk has the same row for every entry."""
    score = np.tile(chain.start, (STATES, 1)) if opens else chain.move.copy()
    score = score + chain.emit[:, obs[0]]
    for o in obs[1:]:
        score = (score[:, :, None] + chain.move).max(1) + chain.emit[:, o]
    return score


def decode(chain: Chain, obs: np.ndarray, entry: int, end: int) -> np.ndarray:
    """Viterbi path over some lines, from an entry state (-1: they open the transcript) to an end state (-1: free)."""
    score = (chain.start if entry < 0 else chain.move[entry]) + chain.emit[:, obs[0]]
    back = np.zeros((len(obs), STATES), np.int64)
    for t in range(1, len(obs)):
        via = score[:, None] + chain.move
        back[t] = via.argmax(0)
        score = via.max(0) + chain.emit[:, obs[t]]
    path = np.empty(len(obs), np.int64)
    state = int(score.argmax()) if end < 0 else end
    for t in range(len(obs) - 1, -1, -1):
        path[t] = state
        state = back[t, state]
    return path


def parse_transcripts(messages: DataFrame, chain: Chain) -> DataFrame:
    """(id, place, part, line, role, opens, closes) for every line of ``messages`` (id, place, text); ``closes`` marks a line
    that opens a turn after another one."""
    bounded_batches(messages.sparkSession)
    sent = messages.sparkSession.sparkContext.broadcast(chain)
    order = [F.col("id").asc_nulls_first(), F.col("place").asc_nulls_first(), F.col("tie"), F.col("part")]

    def chunk(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        task, number, held, size = TaskContext.get().partitionId(), 0, None, 0
        for pdf in batches:
            ids = pdf["id"].fillna("\0")
            fresh = (ids != ids.shift(fill_value=held if held is not None else "\0\0")).to_numpy()
            out = np.empty(len(pdf), np.int64)
            for k, new in enumerate(fresh):
                if (new and (k or held is not None)) or size == CHUNK:
                    number, size = number + 1, 0
                out[k] = number
                size += 1
            held = ids.iloc[-1] if len(ids) else held
            yield pdf.assign(task=task, chunk=out)

    lines = lines_of(messages.select(F.col("id").cast("string"), F.col("place").cast("string").alias("place"), "text")
                     .withColumn("place", F.col("place").cast("long")))
    named = ["id", "place", "tie", "part", "line", "obs"]
    dealt = lines.select(*named).repartitionByRange(*order).sortWithinPartitions(*order).withColumn("place", F.col("place").cast("string"))
    cut = written(dealt.mapInPandas(chunk, "id string, place string, tie long, part int, line string, obs int, task int, chunk long")
                  .withColumn("place", F.col("place").cast("long")), "transcript-lines")
    key = ["task", "chunk"]
    inside = ["task", "chunk", F.col("place").asc_nulls_first(), "tie", "part"]

    def by_chunk(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        """Whole chunks, from frames in which each one's rows are consecutive."""
        held: list[pd.DataFrame] = []
        for pdf in batches:
            for _, part in pdf.groupby(["task", "chunk"], sort=False):
                if held and (held[0]["task"].iloc[0], held[0]["chunk"].iloc[0]) != (part["task"].iloc[0], part["chunk"].iloc[0]):
                    yield pd.concat(held)
                    held = []
                held.append(part)
        if held:
            yield pd.concat(held)

    # Chunks of transcripts that are cut; whether a transcript is cut is known from counts by (task, chunk) alone.
    chunks = cut.groupBy("id", "task", "chunk").agg(F.count("*").alias("n"))
    cuts = chunks.groupBy(F.col("id").alias("whole")).agg(F.count("*").alias("chunks"), F.min(F.struct("task", "chunk")).alias(
        "head")).filter("chunks > 1")
    split = cut.join(cuts, F.col("id").eqNullSafe(F.col("whole"))).select(
        "id", *key, "place", "tie", "part", "obs",
        ((F.col("head.task") == F.col("task")) & (F.col("head.chunk") == F.col("chunk"))).alias("opening"))

    def matrices(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for c in by_chunk(batches):
            m = products(sent.value, c["obs"].to_numpy(), bool(c["opening"].iloc[0]))
            yield pd.DataFrame({"id": [c["id"].iloc[0]], "task": [c["task"].iloc[0]], "chunk": [c["chunk"].iloc[0]], "scores": [m.ravel()]})

    scored = split.repartition(*key).sortWithinPartitions(*inside).mapInPandas(
        matrices, "id string, task int, chunk long, scores array<double>")

    def borders(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(["task", "chunk"])
        steps = [np.array(x).reshape(STATES, STATES) for x in pdf["scores"]]
        best, back = steps[0][0], []
        for m in steps[1:]:
            via = best[:, None] + m
            back.append(via.argmax(0))
            best = via.max(0)
        ends = [int(best.argmax())]
        for b in reversed(back):
            ends.append(int(b[ends[-1]]))
        ends = ends[::-1]
        return pd.DataFrame({"task": pdf["task"], "chunk": pdf["chunk"], "entry": [-1, *ends[:-1]], "end": ends})

    # One row a chunk of CHUNK lines, so a transcript's group here is a thousandth of it.
    known = scored.groupBy("id").applyInPandas(borders, "task int, chunk long, entry int, `end` int")

    def states(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for c in by_chunk(batches):
            path = decode(sent.value, c["obs"].to_numpy(), int(c["entry"].iloc[0]), int(c["end"].iloc[0]))
            yield pd.DataFrame({"id": c["id"], "place": c["place"], "part": c["part"], "line": c["line"],
                                "role": [ROLES[s // 2] for s in path], "opens": path % 2 == 0,
                                "first": np.arange(len(c)) == 0, "whole": int(c["entry"].iloc[0]) < 0})

    joined = cut.join(known, key, "left").withColumn("entry", F.coalesce("entry", F.lit(-1))).withColumn("end", F.coalesce("end", F.lit(-1)))
    out = (joined.repartition(*key).sortWithinPartitions(*inside).withColumn("place", F.col("place").cast("string"))
           .mapInPandas(states, "id string, place string, part int, line string, role string, opens boolean, first boolean, whole boolean"))
    return out.select("id", F.col("place").cast("long").alias("place"), "part", "line", "role", "opens",
                      (F.col("opens") & ~(F.col("first") & F.col("whole"))).alias("closes"))


def rendered(lines: DataFrame) -> DataFrame:
    """``text``: each line in canonical form; a turn is <|role|>, its lines without the marker, and <|end|>."""
    bare = F.when(F.col("opens"), F.regexp_replace("line", MARKER, "")).otherwise(F.col("line"))
    head = F.concat(F.when(F.col("closes"), F.lit("<|end|>\n")).otherwise(F.lit("")),
                    F.when(F.col("opens"), F.concat(F.lit("<|"), F.col("role"), F.lit("|>\n"))).otherwise(F.lit("")))
    return lines.withColumn("text", F.concat(head, bare))


def transcripts(conversations: DataFrame) -> DataFrame:
    """Transcripts of a table of (conv_id, turn, role, text) as people paste them: markers in one of four styles by
    transcript, and none at every third turn. The role itself is left for labels and checks."""
    style = F.pmod(F.xxhash64("conv_id"), F.lit(4))
    other = {"user": "Human", "assistant": "AI", "system": "Context"}
    short = {"user": "Q", "assistant": "A", "system": "System"}
    name = lambda table: F.coalesce(F.create_map(*[F.lit(x) for kv in table.items() for x in kv])[F.lower("role")], F.lit("Note"))
    marked = (F.when(style == 0, F.concat(F.initcap("role"), F.lit(": "))).when(style == 1, F.concat(name(other), F.lit(": ")))
              .when(style == 2, F.concat(F.lit("["), F.col("role"), F.lit("] "))).otherwise(F.concat(name(short), F.lit(": "))))
    bare = F.pmod(F.xxhash64("conv_id", "turn"), F.lit(3)) == 0
    mark = F.when(F.col("role").isNull() | bare, "").otherwise(marked)
    return conversations.select(F.col("conv_id").alias("id"), F.col("turn").alias("place"), "role",
                                F.concat(mark, F.coalesce("text", F.lit(""))).alias("text"))


def op7_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every line of every conversation's transcript: recovered role, turn borders, canonical text. The chain learns from
    conversations whose crc32(conv_id as text) mod 3 is not 1."""
    given = transcripts(read(spark, sf_dir, "conversations", "conv_id", "turn", "role", "text"))
    chain = fit_chain(given.filter(fold(F.col("id"), 3) != 1))
    parsed = rendered(parse_transcripts(given.drop("role"), chain))
    return parsed.select(F.col("id").cast("long").alias("conv_id"), F.col("place").alias("turn"), F.col("part").alias("line"),
                         (fold(F.col("id"), 3) == 1).alias("held_out"), "role", "opens", "text")
