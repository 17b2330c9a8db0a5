"""Conversation structure repair: the least edits that give role initials ``(s?(ua)+)?``, by parallel Viterbi.

1. Equal turns (conv_id, turn, role, text) are one row with a number of copies, so a much repeated turn
   is light.  Rows are put in order by conversation, turn, role and hash of the text by a distributed
   sort, and cut into chunks of at most ``CHUNK_ROWS``, however long a conversation is.
2. Backward costs of the four states of the pattern (nothing yet, after s, after u, after a) matter up
   to a constant only, and such cost vectors form a small fixed set (``VECTORS``).  A chunk that does
   not end its conversation starts from every vector of the set at once; runs that come to differ by a
   constant are one run from there on.  What is left is a map from the vector behind the chunk to the one
   before it, often with a single value: the chunk has then converged.
3. Fix-up passes give each chunk the vector behind it, until no chunk waits for one.  A pass composes
   the maps of chunks that wait for each other, so the passes grow with the logarithm of a chain.
4. A second run over each chunk, from its true vector, gives stitched costs.  They trace the least audit
   forward: at each point the first letter in ASCII that keeps to the least cost.  The state in which a
   chunk is entered is found by the same passes over maps of states.
5. Texts meet their edits once, partitioned by conversation and sorted, and are streamed.

Defined cases: a null role or text is one blank; rows with a null turn come first; a null conv_id is a
conversation of its own.  Rows of one turn stand by role, then by md5 of the text.  A role begins with s,
u or a (exactly) or can only be given a new role or be deleted.  Empty and very long texts are ordinary;
texts are hashed where they are and only travel once.  An empty table gives an empty result; further
columns are left out.  The rows of one conversation stream through one task at the end, one batch at a
time, as a digest of them in order is asked for; nothing else takes a conversation as a whole.
"""

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tallyweave.storage import written

CHUNK_ROWS = 1 << 14
SPACE = r"[\x20\x09-\x0D]"
DELETE, INSERT, REROLE, MEND = 2, 5, 1, 5  # costs; MEND: a truncated turn that stays
INITIALS = "sua"
PLAIN, TRUNCATED, FORCED = range(3)  # FORCED: blank or duplicate, has to be deleted
START, AFTER_S, AFTER_U, AFTER_A = range(4)
_NEXT_TURN = (AFTER_U, AFTER_U, AFTER_A, AFTER_U)  # where a user or assistant turn leads, whichever fits
_TAIL = ("", "II", "I", "")  # what ends a conversation from each state
_SET_BY_DAMAGE = 20

Vector = tuple[float, float, float, float]


# --- cost vectors up to a constant ---------------------------------------------------------------


def _closed(v) -> Vector:
    """Costs with turns inserted first where that is cheaper."""
    to_u, to_a = min(v[2], INSERT + v[3]), min(v[3], INSERT + v[2])
    return min(v[0], INSERT + to_u), min(v[1], INSERT + to_u), to_u, to_a


def _kept_in(state: int, initial: int) -> int | None:
    """The state after keeping a turn, or None where it does not fit."""
    if initial == 0:
        return AFTER_S if state == START else None
    return _NEXT_TURN[state] if _NEXT_TURN[state] == initial + 1 else None


def _moves(code: int, state: int) -> list[tuple[str, int, int]]:
    """(letter, cost, next state) of the ways to treat a turn."""
    initial, kind = divmod(code, 3)
    moves = [("D", DELETE, state)]
    if kind != FORCED:
        mend = MEND if kind == TRUNCATED else 0
        kept = _kept_in(state, initial)
        if kept is not None:
            moves.append(("K", mend, kept))
        moves.append(("R", REROLE + mend, _NEXT_TURN[state]))
    return moves


def _before(code: int, behind: Vector) -> Vector:
    return _closed([min(cost + behind[to] for _, cost, to in _moves(code, s)) for s in range(4)])


def _traced(code: int, behind: Vector, state: int) -> tuple[str, int, int]:
    """Letters up to and with the turn's own, the state after it and their cost."""
    here, letters, spent = _before(code, behind), "", 0
    while True:
        moves = [(letter, cost, to, cost + behind[to]) for letter, cost, to in _moves(code, state)]
        moves.append(("I", INSERT, _NEXT_TURN[state], INSERT + here[_NEXT_TURN[state]]))
        letter, cost, state, _ = min((m for m in moves if m[3] == here[state]), key=lambda m: m[0])
        letters, spent = letters + letter, spent + cost
        if letter != "I":
            return letters, state, spent


def _tables():
    codes = range(3 * (len(INITIALS) + 1))
    vectors: list[Vector] = [_closed((0, np.inf, np.inf, 0))]  # behind the last turn
    at = {vectors[0]: 0}
    steps = []
    for vector in vectors:  # grows while it is read
        row = []
        for code in codes:
            found = _before(code, vector)
            found = tuple(x - min(found) for x in found)
            if found not in at:
                at[found] = len(vectors)
                vectors.append(found)
            row.append(at[found])
        steps.append(row)
    traces = [[[_traced(code, v, s) for s in range(4)] for v in vectors] for code in codes]
    return vectors, np.array(steps, np.int64).T.copy(), traces


VECTORS, _STEPS, _TRACES = _tables()
_STEP_LISTS = _STEPS.tolist()
END = 0  # the vector behind the last turn of a conversation


def vector_map(codes: list[int]) -> list[int]:
    """For every vector behind the turns, the one before them."""
    run = np.arange(len(VECTORS))
    for place in range(len(codes) - 1, -1, -1):
        run = _STEPS[codes[place]][run]
        if (run == run[0]).all():  # converged: all differ by constants only
            one = int(run[0])
            for code in reversed(codes[:place]):
                one = _STEP_LISTS[code][one]
            return [one] * len(VECTORS)
    return run.tolist()


def stitched(codes: list[int], behind: int) -> list[int]:
    """The vector behind each turn, from the true one behind the last."""
    out = [0] * len(codes)
    for place in range(len(codes) - 1, -1, -1):
        out[place] = behind
        behind = _STEP_LISTS[codes[place]][behind]
    return out


def traced(codes: list[int], behind: int, state: int) -> tuple[list[str], list[int], int, int]:
    """Letters of each turn, the state before each, the state at the end and the cost."""
    letters, states, spent = [], [], 0
    for code, vector in zip(codes, stitched(codes, behind)):
        states.append(state)
        text, state, cost = _TRACES[code][vector][state]
        letters.append(text)
        spent += cost
    return letters, states, state, spent


def illegal_pairs(codes: list[int]) -> int:
    return sum(_illegal(a // 3, b // 3) for a, b in zip(codes, codes[1:]))


def _illegal(a: int, b: int) -> bool:
    return (a, b) not in ((0, 1), (1, 2), (2, 1))


# --- turns in order, chunk by chunk ----------------------------------------------------------------


def _turns(conversations: DataFrame, copies: Column) -> DataFrame:
    """conv (never null), turn, role, text, mark of the text and number of copies of a row."""
    text, role = F.coalesce("text", F.lit(" ")), F.coalesce("role", F.lit(" "))
    return conversations.select(
        F.coalesce(F.concat(F.lit("="), F.col("conv_id").cast("string")), F.lit("")).alias("conv"),
        F.col("turn").cast("bigint").alias("turn"),
        role.alias("role"),
        text.alias("text"),
        F.unhex(F.md5(text)).alias("mark"),
        copies.cast("bigint").alias("copies"),
    )


def _in_order(turns: DataFrame) -> DataFrame:
    """A row for each different turn: conv, turn, role, mark, copies, fault flags, code and place."""
    meaning = F.regexp_replace("text", f"{SPACE}+\\z", "")
    rows = turns.select(
        "conv", "turn", "role", "mark", "copies", (meaning == "").alias("blank"), (~meaning.rlike(r"[.!?]\z")).alias("cut")
    )
    same = ["conv", "turn", "role", "mark"]
    rows = rows.groupBy(*same).agg(
        F.sum("copies").alias("copies"), F.first("blank").alias("blank"), F.first("cut").alias("cut")
    )
    rows = written(rows, "turns")
    said = rows.where("not blank").groupBy("conv", "role", "mark")
    said = said.agg(F.count(F.lit(1)).alias("n"), F.min("turn").alias("least"), F.bool_or(F.isnull("turn")).alias("null_turn"))
    said = said.where("n > 1").select("conv", "role", "mark", F.when(~F.col("null_turn"), F.col("least")).alias("first_turn"), F.lit(True).alias("repeated"))
    rows = rows.join(written(said, "repeated-turns"), ["conv", "role", "mark"], "left")
    again = F.coalesce(F.col("repeated"), F.lit(False)) & ~F.col("turn").eqNullSafe(F.col("first_turn"))
    initial = F.array_position(F.array(*map(F.lit, INITIALS)), F.substring("role", 1, 1))
    initial = F.when(initial > 0, initial - 1).otherwise(len(INITIALS))
    kind = F.when(F.col("blank") | again, FORCED).when(F.col("cut"), TRUNCATED).otherwise(PLAIN)
    rows = rows.select(*same, "copies", "blank", "cut", again.alias("again"), (initial * 3 + kind).cast("int").alias("code"))
    rows = rows.repartitionByRange(*same).sortWithinPartitions(*same)
    return written(rows.withColumn("place", F.monotonically_increasing_id()), "turns-in-order")


def _parts(rows: DataFrame) -> DataFrame:
    """conv, chunk and the turns of each conversation in each chunk, in order."""
    # A place is the partition's number times 2^33 plus the row's, so a chunk has rows of one partition.
    chunk = F.floor(F.col("place") / CHUNK_ROWS).alias("chunk")
    one = F.struct("place", "code", "copies", "turn", "role", "mark")
    return rows.groupBy("conv", chunk).agg(F.sort_array(F.collect_list(one)).alias("rows"))


def _resolved(links: DataFrame, label: str) -> DataFrame:
    """conv, chunk and ``known`` of every link, by passes that compose the maps of links that wait.

    A link has ``known``, or waits for the link ``to`` of its conversation and takes ``map`` of its value.
    """
    links = written(links, label)
    while not links.where("known is null").isEmpty():
        other = links.select("conv", F.col("chunk").alias("to"), F.col("known").alias("k"), F.col("map").alias("m"), F.col("to").alias("on"))
        waits = links.where("known is null").join(other, ["conv", "to"])
        composed = F.expr("transform(m, x -> map[x])")
        converged = F.array_min(composed) == F.array_max(composed)
        known = F.when(F.col("k").isNotNull(), F.expr("map[k]")).when(converged, composed[0])
        waits = waits.select("conv", "chunk", F.col("on").alias("to"), known.alias("known"), composed.alias("map"))
        links = written(links.where("known is not null").select(*waits.columns).unionByName(waits), label)
    return links.select("conv", "chunk", "known")


def _pylist(batch: pa.RecordBatch, name: str) -> list:
    return batch.column(batch.schema.get_field_index(name)).to_pylist()


def _maps(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        maps = [vector_map(codes) for codes in _pylist(batch, "codes")]
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(maps, pa.list_(pa.int32()))], ["conv", "chunk", "map"])


def _state_maps(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        both = zip(_pylist(batch, "codes"), _pylist(batch, "behind"))
        maps = [[traced(codes, behind, state)[2] for state in range(4)] for codes, behind in both]
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(maps, pa.list_(pa.int32()))], ["conv", "chunk", "map"])


def _linked(parts: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Parts with the vector behind and the state before each, and the neighbours of split conversations."""
    over = Window.partitionBy("conv").orderBy("chunk")  # one row for each chunk that a conversation has rows in
    whole = Window.partitionBy("conv")
    codes = F.col("rows.code")
    several = parts.groupBy("conv").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("conv")
    several = written(several, "split-conversations")
    if several.isEmpty():
        none = F.lit(None).cast("int").alias("code_before")
        return parts.select("conv", "chunk", "rows", F.lit(END).alias("behind"), F.lit(START).alias("entered"), none, F.lit(True).alias("ends"))
    ends = parts.join(several, "conv", "left_semi").select("conv", "chunk", codes.alias("codes"))
    ends = written(ends, "split-parts")
    around = ends.select("conv", "chunk", F.element_at("codes", -1).alias("last")).select(
        "conv",
        "chunk",
        F.lag("chunk").over(over).alias("previous"),
        F.lead("chunk").over(over).alias("next"),
        F.lag("last").over(over).alias("code_before"),
        F.count(F.lit(1)).over(whole).alias("parts"),
    )
    around = written(around, "neighbours")
    maps = written(ends.mapInArrow(_maps, "conv string, chunk bigint, map array<int>"), "vector-maps")
    # The vector behind a part is that before the next one.
    following = maps.withColumnRenamed("chunk", "next")
    none = F.lit(None).cast("int")
    links = around.where("next is not null").join(following, ["conv", "next"]).select(
        "conv", "chunk", F.col("next").alias("to"), F.when(F.array_min("map") == F.array_max("map"), F.col("map")[0]).alias("known"), "map"
    )
    last = around.where("next is null").select("conv", "chunk", F.lit(None).cast("bigint").alias("to"), F.lit(END).alias("known"), F.lit(None).cast("array<int>").alias("map"))
    behind = written(_resolved(links.unionByName(last), "vectors-behind"), "behind").withColumnRenamed("known", "behind")
    states = ends.join(behind, ["conv", "chunk"]).select("conv", "chunk", "codes", "behind")
    states = written(states.mapInArrow(_state_maps, "conv string, chunk bigint, map array<int>"), "state-maps")
    # The state before a part is that at the end of the previous one.
    preceding = states.withColumnRenamed("chunk", "previous")
    links = around.where("previous is not null").join(preceding, ["conv", "previous"]).select(
        "conv", "chunk", F.col("previous").alias("to"), none.alias("known"), "map"
    )
    first = around.where("previous is null").select("conv", "chunk", F.lit(None).cast("bigint").alias("to"), F.lit(START).alias("known"), F.lit(None).cast("array<int>").alias("map"))
    entered = _resolved(links.unionByName(first), "states-before").withColumnRenamed("known", "entered")
    known = around.join(behind, ["conv", "chunk"]).join(entered, ["conv", "chunk"])
    known = written(known.select("conv", "chunk", "behind", "entered", "code_before", F.isnull("next").alias("ends")), "known-ends")
    return parts.join(known, ["conv", "chunk"], "left").select(
        "conv",
        "chunk",
        "rows",
        F.coalesce("behind", F.lit(END)).alias("behind"),
        F.coalesce("entered", F.lit(START)).alias("entered"),
        "code_before",
        F.coalesce("ends", F.lit(True)).alias("ends"),
    )


_EDITED = "conv string, chunk bigint, cost bigint, illegal bigint, audit string, letters array<string>, states array<int>, ending int"


def _edit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names = [field.split()[0] for field in _EDITED.split(", ")]
    for batch in batches:
        out = {name: [] for name in names[2:]}
        columns = [_pylist(batch, name) for name in ("codes", "copies", "behind", "entered", "code_before", "ends")]
        for codes, copies, behind, entered, code_before, ends in zip(*columns):
            letters, states, ending, cost = traced(codes, behind, entered)
            more = sum(copies) - len(copies)  # equal turns after the first, each deleted
            audit = "".join(text + "D" * (n - 1) for text, n in zip(letters, copies))
            tail = _TAIL[ending] if ends else ""
            out["cost"].append(cost + DELETE * more + INSERT * len(tail))
            pairs = illegal_pairs(codes) + more
            out["illegal"].append(pairs + (code_before is not None and _illegal(code_before // 3, codes[0] // 3)))
            out["audit"].append(audit + tail)
            out["letters"].append(letters)
            out["states"].append(states)
            out["ending"].append(ending if tail else None)
        types = [pa.int64(), pa.int64(), pa.string(), pa.list_(pa.string()), pa.list_(pa.int32()), pa.int32()]
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), batch.column(1), *[pa.array(out[n], t) for n, t in zip(names[2:], types)]], names
        )


# --- the operator --------------------------------------------------------------------------------------


class Repair:
    """The repair of a table of conversations (conv_id, turn, role, text); ``copies`` repeats rows.

    ``audits``: conv, blank, duplicate, truncated, illegal, cost, audit; conversations without turns are
    not in it.  ``turns``: conv, place, role, text of the repaired conversations, each conversation in order
    within one partition.  ``conv`` is the text of conv_id after "=", empty for null.
    """

    def __init__(self, conversations: DataFrame, copies: Column | None = None):
        self._texts = _turns(conversations, F.lit(1) if copies is None else copies)
        self._rows = _in_order(self._texts)
        parts = written(_parts(self._rows), "parts")
        linked = _linked(parts)
        columns = ["conv", "chunk", F.col("rows.code").alias("codes"), F.col("rows.copies").alias("copies")]
        edits = linked.select(*columns, "behind", "entered", "code_before", "ends").mapInArrow(_edit, _EDITED)
        self._edits = written(edits, "edits")
        self._parts = parts

    @property
    def audits(self) -> DataFrame:
        one_each = F.when(F.col("blank"), 0).when(F.col("again"), F.col("copies")).otherwise(F.col("copies") - 1)
        stays = ~F.col("blank") & ~F.col("again")
        by_turn = self._rows.groupBy("conv", "turn").agg(
            F.sum(F.when(F.col("blank"), F.col("copies")).otherwise(0)).alias("blank"),
            F.sum(one_each).alias("duplicate"),
            F.sum((stays & F.col("cut")).cast("bigint")).alias("truncated"),
        )
        span = F.max("turn") - F.min("turn") + 1 - F.count("turn")
        counts = by_turn.groupBy("conv").agg(
            F.coalesce(span, F.lit(0)).alias("gaps"), *[F.sum(c).alias(c) for c in ("blank", "duplicate", "truncated")]
        )
        pieces = F.transform(F.sort_array(F.collect_list(F.struct("chunk", "audit"))), lambda x: x["audit"])
        found = self._edits.groupBy("conv").agg(
            F.sum("illegal").alias("illegal"), F.sum("cost").alias("cost"), F.array_join(pieces, "").alias("audit")
        )
        return counts.join(found, "conv")

    @property
    def turns(self) -> DataFrame:
        rows = self._parts.join(self._edits.select("conv", "chunk", "letters", "states"), ["conv", "chunk"])
        each = F.explode(F.arrays_zip(F.col("rows.turn").alias("turn"), F.col("rows.role").alias("role"), F.col("rows.mark").alias("mark"), "letters", "states")).alias("e")
        each = rows.select("conv", each).select("conv", "e.*").where("letters <> 'D'")
        nothing = F.lit(None).cast("string")
        each = each.select("conv", F.lit(0).alias("last"), "turn", "role", "mark", F.lit(0).alias("kind"), "letters", F.col("states").alias("state"), nothing.alias("text"))
        tails = self._edits.where("ending is not null").select(
            "conv", F.lit(1).alias("last"), F.lit(None).cast("bigint").alias("turn"), nothing.alias("role"), F.lit(None).cast("binary").alias("mark"),
            F.lit(0).alias("kind"), F.lit("").alias("letters"), F.col("ending").alias("state"), nothing.alias("text"),
        )
        texts = self._texts.select(
            "conv", F.lit(0).alias("last"), "turn", "role", "mark", F.lit(1).alias("kind"), nothing.alias("letters"), F.lit(None).cast("int").alias("state"), "text"
        )
        order = ["conv", "last", "turn", "role", "mark", "kind"]
        merged = each.unionByName(tails).unionByName(texts).repartition("conv").sortWithinPartitions(*order)
        return merged.mapInArrow(_apply, "conv string, place bigint, role string, text string")


def _apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Repaired turns, from rows in which the edit of a turn stands before the turn's text."""
    conv, place, edit = None, 0, None
    for batch in batches:
        out: list[tuple] = []

        def emit(role: str, text: str) -> None:
            nonlocal place
            out.append((conv, place, role, text))
            place += 1

        def insert(state: int, letters: str) -> int:
            for letter in letters:
                if letter == "I":
                    emit("assistant" if state == AFTER_U else "user", "")
                    state = _NEXT_TURN[state]
            return state

        columns = [_pylist(batch, name) for name in ("conv", "last", "turn", "role", "mark", "kind", "letters", "state", "text")]
        for row_conv, last, turn, role, mark, kind, letters, state, text in zip(*columns):
            if row_conv != conv:
                conv, place, edit = row_conv, 0, None
            if last:
                insert(state, _TAIL[state])
            elif kind == 0:
                edit = (turn, role, mark, letters, state)
            elif edit is not None and edit[:3] == (turn, role, mark):
                state, letter = insert(edit[4], edit[3]), edit[3][-1]
                if letter == "K":
                    emit(role, text)
                elif letter == "R":
                    emit("assistant" if state == AFTER_U else "user", text)
                edit = None  # further copies are deleted
        fields = [pa.string(), pa.int64(), pa.string(), pa.string()]
        by_column = list(zip(*out)) or [()] * 4
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(by_column, fields)], ["conv", "place", "role", "text"])


def _digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """sha256 of the ``role:text`` of each conversation, as its turns stream by."""

    def batch_of(found: list[tuple[str, str]]) -> pa.RecordBatch:
        columns = list(zip(*found)) or [(), ()]
        return pa.RecordBatch.from_arrays([pa.array(c, pa.string()) for c in columns], ["conv", "repaired_sha256"])

    conv, digest = None, None
    for batch in batches:
        done = []
        for row_conv, role, text in zip(_pylist(batch, "conv"), _pylist(batch, "role"), _pylist(batch, "text")):
            if row_conv != conv:
                if digest is not None:
                    done.append((conv, digest.hexdigest()))
                conv, digest = row_conv, hashlib.sha256()
            else:
                digest.update(b"\n")
            digest.update(f"{role}:{text}".encode())
        yield batch_of(done)
    if digest is not None:
        yield batch_of([(conv, digest.hexdigest())])


def damaged(conversations: DataFrame) -> DataFrame:
    """Conversations with the faults of the query's contract; a row that is repeated has two copies."""
    blank = F.lit(" ")
    key = F.concat(F.coalesce(F.col("conv_id").cast("string"), blank), F.lit(":"), F.coalesce(F.col("turn").cast("string"), blank))
    rows = conversations.select("conv_id", "turn", "role", "text", (F.crc32(key) % _SET_BY_DAMAGE).alias("fault")).where("fault <> 0")
    text = F.coalesce("text", blank)
    text = F.when(F.col("fault") == 1, "").when(F.col("fault") == 2, F.regexp_replace(text, "[.!?]", "")).otherwise(text)
    role = F.when(F.col("fault") == 4, "user").otherwise(F.coalesce("role", blank))
    return rows.select("conv_id", "turn", role.alias("role"), text.alias("text"), F.when(F.col("fault") == 3, 2).otherwise(1).alias("copies"))


def repair_report(conversations: DataFrame, all_ids: DataFrame, copies: Column | None = None) -> DataFrame:
    """conv_id, gaps, fault counts, cost, audit and repaired_sha256 of every conv_id of ``all_ids``."""
    repair = Repair(conversations, copies)
    digests = written(repair.turns.mapInArrow(_digest, "conv string, repaired_sha256 string"), "digests")
    ids = all_ids.select("conv_id").distinct().withColumn("conv", F.coalesce(F.concat(F.lit("="), F.col("conv_id").cast("string")), F.lit("")))
    zero = F.lit(0).cast("bigint")
    found = ids.join(repair.audits, "conv", "left").join(digests, "conv", "left")
    return found.select(
        "conv_id",
        *[F.coalesce(F.col(c).cast("bigint"), zero).alias(c) for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")],
        F.coalesce("audit", F.lit("")).alias("audit"),
        F.coalesce("repaired_sha256", F.sha2(F.lit(""), 256)).alias("repaired_sha256"),
    )


def op13_conversation_repair(spark: SparkSession, folder: str) -> DataFrame:
    conversations = spark.read.parquet(f"{folder}/conversations.parquet").select("conv_id", "turn", "role", "text")
    return repair_report(damaged(conversations), conversations, F.col("copies"))


SQL = r"""
WITH RECURSIVE keyed AS (
  SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
    coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' ') AS k FROM conversations
), marked AS (
  SELECT *, xor(list_reduce(list_prepend(4294967295::BIGINT, list_transform(string_split(k, ''), lambda c: ord(c)::BIGINT)),
    lambda a, b: list_reduce(list_prepend(xor(a, b), [0, 0, 0, 0, 0, 0, 0, 0]::BIGINT[]),
      lambda x, i: xor(x >> 1, 3988292384 * (x & 1)))), 4294967295) % 20 AS fault FROM keyed
), damaged AS (
  SELECT conv_id, turn, CASE WHEN fault = 4 THEN 'user' ELSE role END AS role,
    CASE fault WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text,
    unnest(range(CASE WHEN fault = 3 THEN 2 ELSE 1 END)) AS copy
  FROM marked WHERE fault <> 0
), placed AS (
  SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, md5(text)) AS rn,
    regexp_replace(text, '[\x20\x09-\x0D]+\z', '') AS meaning FROM damaged
), ranked AS (SELECT *, row_number() OVER (PARTITION BY conv_id, role, text ORDER BY rn) AS time FROM placed),
judged AS (
  SELECT conv_id, turn, role, text, rn, left(role, 1) AS i, CASE WHEN meaning = '' THEN 'blank' WHEN time > 1 THEN 'duplicate'
    WHEN NOT regexp_matches(meaning, '[.!?]\z') THEN 'truncated' ELSE '' END AS fault,
    lag(left(role, 1)) OVER (PARTITION BY conv_id ORDER BY rn) AS i_before
  FROM ranked
), counts AS (
  SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count(*) FILTER (fault = 'blank') AS blank,
    count(*) FILTER (fault = 'duplicate') AS duplicate, count(*) FILTER (fault = 'truncated') AS truncated,
    count(*) FILTER (rn > 1 AND i_before || i NOT IN ('su', 'ua', 'au')) AS illegal, max(rn) AS n
  FROM judged GROUP BY conv_id
), inserts(s, t, letters, cost, said) AS (VALUES
  (0, 0, '', 0, []::VARCHAR[]), (1, 1, '', 0, []), (2, 2, '', 0, []), (3, 3, '', 0, []),
  (0, 2, 'I', 5, ['user:']), (1, 2, 'I', 5, ['user:']), (3, 2, 'I', 5, ['user:']), (2, 3, 'I', 5, ['assistant:']),
  (0, 3, 'II', 10, ['user:', 'assistant:']), (1, 3, 'II', 10, ['user:', 'assistant:'])
), moves(t, v, i, letter, cost) AS (VALUES
  (0, 0, '', 'D', 2), (1, 1, '', 'D', 2), (2, 2, '', 'D', 2), (3, 3, '', 'D', 2),
  (0, 1, 's', 'K', 0), (0, 2, 'u', 'K', 0), (1, 2, 'u', 'K', 0), (3, 2, 'u', 'K', 0), (2, 3, 'a', 'K', 0),
  (0, 2, '', 'R', 1), (1, 2, '', 'R', 1), (3, 2, '', 'R', 1), (2, 3, '', 'R', 1)
), best AS (
  SELECT conv_id, 0::BIGINT AS rn, 0 AS s, {'cost': 0::BIGINT, 'audit': '', 'said': []::VARCHAR[]} AS p FROM counts
  UNION ALL
  SELECT b.conv_id, j.rn, m.v AS s, min({
    'cost': (b.p.cost + e.cost + m.cost + CASE WHEN j.fault = 'truncated' AND m.letter <> 'D' THEN 5 ELSE 0 END)::BIGINT,
    'audit': b.p.audit || e.letters || m.letter,
    'said': list_concat(b.p.said, list_concat(e.said, CASE m.letter WHEN 'D' THEN []::VARCHAR[] WHEN 'K' THEN [j.role || ':' || j.text]
      ELSE [CASE m.v WHEN 2 THEN 'user:' ELSE 'assistant:' END || j.text] END))}) AS p
  FROM best b JOIN judged j ON j.conv_id IS NOT DISTINCT FROM b.conv_id AND j.rn = b.rn + 1
  JOIN inserts e ON e.s = b.s
  JOIN moves m ON m.t = e.t AND (m.i = '' OR m.i = j.i) AND (m.letter = 'D' OR j.fault NOT IN ('blank', 'duplicate'))
  GROUP BY b.conv_id, j.rn, m.v
), ended AS (
  SELECT c.conv_id, min({'cost': b.p.cost + e.cost, 'audit': b.p.audit || e.letters, 'said': list_concat(b.p.said, e.said)}) AS p
  FROM counts c JOIN best b ON b.conv_id IS NOT DISTINCT FROM c.conv_id AND b.rn = c.n
  JOIN inserts e ON e.s = b.s AND e.t IN (0, 3) GROUP BY c.conv_id
)
SELECT o.conv_id, coalesce(gaps, 0)::BIGINT AS gaps, coalesce(blank, 0)::BIGINT AS blank, coalesce(duplicate, 0)::BIGINT AS duplicate,
  coalesce(truncated, 0)::BIGINT AS truncated, coalesce(illegal, 0)::BIGINT AS illegal, coalesce(e.p.cost, 0)::BIGINT AS cost,
  coalesce(e.p.audit, '') AS audit, sha256(coalesce(array_to_string(e.p.said, chr(10)), '')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) o
LEFT JOIN counts c ON c.conv_id IS NOT DISTINCT FROM o.conv_id LEFT JOIN ended e ON e.conv_id IS NOT DISTINCT FROM o.conv_id
"""
QUERIES = {"op13_conversation_repair": op13_conversation_repair}
ORACLE_SQL = {"op13_conversation_repair": SQL}
