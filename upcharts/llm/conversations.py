"""Conversation structure repair by rank-convergence parallel Viterbi.

A conversation's turns are edited at the least cost until their role initials read
``(s?(ua)+)?``. A turn is kept (no cost), gets the role user or assistant, or is deleted;
empty turns of user or assistant are inserted anywhere. Blank turns and those that repeat
an earlier role and text have to be deleted; a truncated turn that stays costs more. Of
edits of equal cost, the one whose letters (K, R, D, I, in order) are least counts.

1. Turns stand in the order of (turn, role, hash of text), nulls first. They are range
   partitioned in this order, so a long conversation lies in many partitions, and each
   partition's share of a conversation makes chunks of at most ``CHUNK`` turns, one byte
   a turn. Text stays behind.
2. Costs run backwards over the four states of the pattern. A chunk starts from a
   speculative cost vector, that of the conversation's end, and returns the vector at its
   front. Fix-up passes: a chunk whose successor's front differs from the vector it
   started from by more than a constant starts again from that front, until none does.
   Vectors less their minimum are few, so steps are looked up in a table that grows as it is used.
3. Some turns never let vectors converge (a long run of one role keeps its parity). What
   is left after ``PASSES`` passes gets the exact vectors: each chunk is run from the four unit
   vectors, and these are combined over the chunks of a conversation.
4. The constants are stitched to the costs, and each chunk traces its edits forwards
   from the state in which the chunk before ends, along cheapest steps, least letter first.

A null role or text counts as one space. A null conv_id is a conversation of its own.
Equal turns are told apart by a row number. Other columns are ignored, whatever their
names. No rows, no conversations.
"""

from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from upcharts.llm.ship import in_tasks
from upcharts.session import materialise

CHUNK = 1 << 16
#: partitions that turns are dealt to, at most
PARTITIONS = 20_000
PASSES = 4

# states: nothing yet, after a system turn, after a user turn, after an assistant turn
START, SYSTEM, USER, ASSISTANT = range(4)
#: per initial (s, u, a): the states in which it may follow, and the state it leads to
_NEXT = {0: {START: SYSTEM}, 1: {START: USER, SYSTEM: USER, ASSISTANT: USER}, 2: {USER: ASSISTANT}, 3: {}}
_ROLE = {USER: "user", ASSISTANT: "assistant"}
FAR = 1 << 40

# faults of a turn
FINE, TRUNCATED, BLANK, DUPLICATE = range(4)


@dataclass(frozen=True)
class Costs:
    rerole: int = 1
    delete: int = 2
    insert: int = 5
    truncated: int = 5


class Steps:
    """One turn's, or no turn's, cheapest steps; remembered for each vector and symbol.

    A symbol is 4 * fault + initial. Vectors are tuples with minimum 0.
    """

    def __init__(self, costs: Costs):
        self.costs = costs
        self.back: dict[tuple, tuple] = {}
        self.ahead: dict[tuple, tuple] = {}
        # of a user or an assistant turn: the states before and after
        self.added = {START: USER, SYSTEM: USER, USER: ASSISTANT, ASSISTANT: USER}
        #: costs at the end of a conversation
        self.end = self._with_inserts([0, FAR, FAR, 0])

    def _with_inserts(self, vector: list[int]) -> tuple[int, ...]:
        # the states lead to user and assistant in turn: three rounds reach all
        for _ in range(3):
            for state, to in self.added.items():
                vector[state] = min(vector[state], vector[to] + self.costs.insert)
        return tuple(vector)

    def _options(self, symbol: int, state: int) -> list[tuple[str, int, int]]:
        """Edits of a turn: letter, cost, state after."""
        fault, initial = divmod(symbol, 4)
        out = [("D", self.costs.delete, state)]
        if fault < BLANK:
            stays = self.costs.truncated if fault == TRUNCATED else 0
            if state in _NEXT[initial]:
                out.append(("K", stays, _NEXT[initial][state]))
            out.append(("R", stays + self.costs.rerole, self.added[state]))
        return out

    def before(self, vector: tuple[int, ...], symbol: int) -> tuple[tuple[int, ...], int]:
        """The vector before a turn, less its minimum, and that minimum."""
        known = self.back.get((vector, symbol))
        if known is None:
            raw = [min(cost + vector[to] for _, cost, to in self._options(symbol, state)) for state in range(4)]
            found = self._with_inserts(raw)
            low = min(found)
            known = self.back[vector, symbol] = (tuple(min(x - low, FAR) for x in found), low)
        return known

    def front(self, vector: tuple[int, ...], symbols: bytes) -> tuple[tuple[int, ...], int]:
        """The vector before a run of turns, less its minimum, and the sum of the minima."""
        total = 0
        for symbol in reversed(symbols):
            vector, low = self.before(vector, symbol)
            total += low
        return vector, total

    def after(self, vector: tuple[int, ...], symbol: int | None, state: int) -> tuple[str, int, tuple]:
        """Letters, state after and turns that come out (own or added, new role) at a turn (None: the end).

        ``vector`` is the one behind the turn.
        """
        known = self.ahead.get((vector, symbol, state))
        if known is None:
            known = self.ahead[vector, symbol, state] = self._cheapest(vector, symbol, state)
        return known

    def _cheapest(self, vector: tuple[int, ...], symbol: int | None, state: int) -> tuple[str, int, tuple]:
        here = self.end
        if symbol is not None:
            here = self._with_inserts([min(c + vector[to] for _, c, to in self._options(symbol, q)) for q in range(4)])
        letters, made = "", []
        while symbol is not None or here[state]:
            steps = [] if symbol is None else [s for s in self._options(symbol, state) if s[1] + vector[s[2]] == here[state]]
            if self.costs.insert + here[self.added[state]] == here[state]:
                steps.append(("I", self.costs.insert, self.added[state]))
            letter, _, state = min(steps)
            letters += letter
            if letter != "D":
                made.append((letter != "I", None if letter == "K" else _ROLE[state]))
            if letter != "I":
                break
        return letters, state, tuple(made)

    def trace(self, vector: tuple[int, ...], symbols: bytes, state: int, last: bool) -> tuple[str, int, list]:
        """Letters, state after, and (turn's place or None, new role or None) of the turns that come out."""
        vectors = [vector]
        for symbol in reversed(symbols):
            vectors.append(self.before(vectors[-1], symbol)[0])
        letters, out = [], []
        for at, symbol in enumerate(symbols):
            some, state, made = self.after(vectors[len(symbols) - 1 - at], symbol, state)
            letters.append(some)
            out.extend((at if own else None, role) for own, role in made)
        if last:
            more, state, made = self.after(self.end, None, state)
            letters.append(more)
            out.extend((None, role) for _, role in made)
        return "".join(letters), state, out


def _initial(role: Column) -> Column:
    first = F.substring(role, 1, 1)
    return F.when(first == "s", 0).when(first == "u", 1).when(first == "a", 2).otherwise(3)


def with_faults(turns: DataFrame) -> DataFrame:
    """Of stored turns (row, conv_id, turn, role, text): row, conv_id, turn, role, order and symbol."""
    ends = F.rtrim("text", F.lit(" \t\n\x0b\x0c\r"))
    facts = turns.select(
        "row", "conv_id", "turn", "role",
        F.xxhash64("text").alias("h"), F.xxhash64(F.lit(1), "text").alias("g"),
        (F.length(ends) == 0).alias("blank"),
        (~F.substring(ends, -1, 1).isin(".", "!", "?")).alias("cut"),
    )
    firsts = facts.where(~F.col("blank")).groupBy("conv_id", "role", "h", "g").agg(F.min(F.struct("turn", "row")).alias("at"))
    seen = facts.join(firsts.select(F.col("at.row").alias("row"), F.lit(True).alias("is_first")), "row", "left")
    fault = F.when(F.col("blank"), BLANK).when(F.col("is_first").isNull(), DUPLICATE).when(F.col("cut"), TRUNCATED).otherwise(FINE)
    return seen.select("row", "conv_id", "turn", "role", "h", (fault * 4 + _initial(F.col("role"))).alias("symbol"))


def _chunks(size: int):
    """Chunks of the sorted turns of a partition."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["conv_id", "turn", "row", "symbol"]
        held: dict[str, list] = {n: [] for n in names}
        ready: list[tuple] = []
        part, made = 0, 0

        def close() -> None:
            nonlocal made
            if held["row"]:
                known = sorted({t for t in held["turn"] if t is not None})
                ends = (known[0], known[-1]) if known else (None, None)
                ready.append((held["conv_id"][0], (part << 33) + made, bytes(held["symbol"]), list(held["row"]), len(known), *ends))
                made += 1
                for n in names:
                    held[n].clear()

        def batch_of(rows: list[tuple]) -> pa.RecordBatch:
            kinds = [conv_kind, pa.int64(), pa.binary(), pa.list_(pa.int64()), pa.int64(), pa.int64(), pa.int64()]
            columns = zip(*rows, strict=True)
            return pa.record_batch([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], ["conv_id", "chunk", "symbols", "rows", "turns", "first", "last"])

        conv_kind = None
        for batch in batches:
            if not batch.num_rows:
                continue
            conv_kind = batch.schema.field("conv_id").type
            part = batch.column("part")[0].as_py()
            columns = {n: batch.column(n).to_pylist() for n in names}
            convs, begin = columns["conv_id"], 0
            while begin < batch.num_rows:
                if held["row"] and (held["conv_id"][0] != convs[begin] or len(held["row"]) >= size):
                    close()
                end, room = begin + 1, size - len(held["row"])
                while end < batch.num_rows and end - begin < room and convs[end] == convs[begin]:
                    end += 1
                for n in names:
                    held[n].extend(columns[n][begin:end])
                begin = end
            if len(ready) > 1:
                yield batch_of(ready)
                ready.clear()
        close()
        if ready:
            yield batch_of(ready)

    return run


def _fronts(costs: Costs):
    """The vector and constant before each chunk, from the vector ``start`` behind it."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        steps = Steps(costs)
        for batch in batches:
            starts = batch.column("start").to_pylist()
            found = [steps.front(tuple(v), s) for v, s in zip(starts, batch.column("symbols").to_pylist(), strict=True)]
            kept = [batch.column(c) for c in ("conv_id", "chunk", "start")]
            front = pa.array([f[0] for f in found], pa.list_(pa.int64()))
            yield pa.record_batch([*kept, front, pa.array([f[1] for f in found], pa.int64())], ["conv_id", "chunk", "start", "front", "low"])

    return run


def _units(costs: Costs):
    """Four vectors of each chunk: from each state in front, the costs to each state behind."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        steps = Steps(costs)
        for batch in batches:
            units = []
            for symbols in batch.column("symbols").to_pylist():
                columns = [steps.front(steps._with_inserts([0 if q == to else FAR for q in range(4)]), symbols) for to in range(4)]
                units.append([min(columns[to][0][q] + columns[to][1], FAR) if columns[to][0][q] < FAR // 2 else FAR for q in range(4) for to in range(4)])
            yield pa.record_batch([batch.column("conv_id"), batch.column("chunk"), pa.array(units, pa.list_(pa.int64()))], ["conv_id", "chunk", "units"])

    return run


def _combined(costs: Costs):
    """The vector behind each chunk, from the units of the chunks behind it (last chunk first)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        end = Steps(costs).end
        conv, vector = object(), end
        for batch in batches:
            out = []
            for of, units in zip(batch.column("conv_id").to_pylist(), batch.column("units").to_pylist(), strict=True):
                if of != conv:
                    conv, vector = of, end
                out.append(vector)
                found = [min(units[4 * q + to] + vector[to] for to in range(4)) for q in range(4)]
                vector = tuple(min(x - min(found), FAR) for x in found)
            yield pa.record_batch([batch.column("conv_id"), batch.column("chunk"), pa.array(out, pa.list_(pa.int64()))], ["conv_id", "chunk", "start"])

    return run


def _exits(costs: Costs):
    """The state behind each chunk, for each state in front of it."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        steps = Steps(costs)
        for batch in batches:
            found = [
                [steps.trace(tuple(v), s, q, False)[1] for q in range(4)]
                for v, s in zip(batch.column("start").to_pylist(), batch.column("symbols").to_pylist(), strict=True)
            ]
            yield pa.record_batch([batch.column("conv_id"), batch.column("chunk"), pa.array(found, pa.list_(pa.int32()))], ["conv_id", "chunk", "exits"])

    return run


def _entries(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The state in front of each chunk, first chunk first."""
    conv, state = object(), START
    for batch in batches:
        out = []
        for of, exits in zip(batch.column("conv_id").to_pylist(), batch.column("exits").to_pylist(), strict=True):
            if of != conv:
                conv, state = of, START
            out.append(state)
            state = exits[state]
        yield pa.record_batch([batch.column("conv_id"), batch.column("chunk"), pa.array(out, pa.int32())], ["conv_id", "chunk", "entry"])


def _traced(costs: Costs):
    """Letters of each chunk, the turns that come out (row or null, new role or null), and what the turns in it show."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        steps = Steps(costs)
        names = ["start", "symbols", "entry", "final", "rows"]
        for batch in batches:
            audits, out, counts = [], [], []
            for start, symbols, entry, final, rows in zip(*[batch.column(n).to_pylist() for n in names], strict=True):
                letters, _, made = steps.trace(tuple(start), symbols, entry, final)
                audits.append(letters)
                out.append([{"row": None if at is None else rows[at], "role": role} for at, role in made])
                faults, initials = [s // 4 for s in symbols], [s % 4 for s in symbols]
                illegal = sum((a, b) not in _LEGAL for a, b in zip(initials, initials[1:], strict=False))
                counts.append((faults.count(BLANK), faults.count(DUPLICATE), faults.count(TRUNCATED), illegal, initials[0], initials[-1]))
            columns = [pa.array(c, pa.int64()) for c in zip(*counts, strict=True)] if counts else [pa.array([], pa.int64())] * 6
            kind = pa.list_(pa.struct([("row", pa.int64()), ("role", pa.string())]))
            yield pa.record_batch(
                [batch.column("conv_id"), batch.column("chunk"), pa.array(audits, pa.string()), pa.array(out, kind), *columns],
                ["conv_id", "chunk", "audit", "made", "blank", "duplicate", "truncated", "illegal", "initial", "ending"],
            )

    return run


#: initials that may stand side by side: su, ua, au
_LEGAL = {(0, 1), (1, 2), (2, 1)}


def _per_chunk(left: DataFrame, right: DataFrame, how: str = "inner") -> DataFrame:
    """Join on conversation (null too) and chunk; ``chunk`` alone tells chunks apart."""
    return left.join(right.drop("conv_id"), "chunk", how)


def _cost_vectors(chunks: DataFrame, costs: Costs, kind: str) -> DataFrame:
    """conv_id, chunk, start, front, low: the vector behind each chunk, and that in front of it with its constant."""
    end = F.array(*[F.lit(x).cast("long") for x in Steps(costs).end])
    schema = f"conv_id {kind}, chunk long, start array<long>, front array<long>, low long"
    solved = materialise(in_tasks(chunks.select("conv_id", "chunk", "symbols", end.alias("start")), _fronts(costs), schema), "fronts")
    # a conversation of one chunk started from its true end
    behind = Window.partitionBy("conv_id").orderBy("chunk")
    several = chunks.groupBy("conv_id").agg(F.count("*").alias("size")).where("size > 1")
    linked = chunks.join(several, chunks["conv_id"].eqNullSafe(several["conv_id"]), "left_semi").select("conv_id", "chunk")
    linked = materialise(linked.withColumn("behind", F.lead("chunk").over(behind)), "chunk_order")
    for _ in range(PASSES):
        wrong = _started_wrong(linked, solved)
        if not wrong.limit(1).count():
            return solved
        again = in_tasks(_per_chunk(chunks.select("conv_id", "chunk", "symbols"), wrong), _fronts(costs), schema)
        right = solved.join(wrong.select("chunk"), "chunk", "left_anti").select(*solved.columns)
        solved = materialise(right.union(again), "fronts")
    wrong = _started_wrong(linked, solved)
    if not wrong.limit(1).count():
        return solved
    # every chunk of what has not converged, from the unit vectors
    open_ = wrong.select("conv_id").distinct()
    open_chunks = materialise(linked.join(open_, linked["conv_id"].eqNullSafe(open_["conv_id"]), "left_semi").select("conv_id", "chunk"), "open_chunks")
    units = in_tasks(_per_chunk(chunks.select("conv_id", "chunk", "symbols"), open_chunks), _units(costs), f"conv_id {kind}, chunk long, units array<long>")
    ordered = materialise(units, "units").repartition("conv_id").sortWithinPartitions("conv_id", F.desc("chunk"))
    starts = in_tasks(ordered, _combined(costs), f"conv_id {kind}, chunk long, start array<long>")
    again = in_tasks(_per_chunk(chunks.select("conv_id", "chunk", "symbols"), starts), _fronts(costs), schema)
    right = solved.join(open_chunks.select("chunk"), "chunk", "left_anti").select(*solved.columns)
    return materialise(right.union(again), "fronts")


def _started_wrong(linked: DataFrame, solved: DataFrame) -> DataFrame:
    """Chunks whose start differs from the front of the chunk behind by more than a constant, with that front."""
    fronts = solved.select(F.col("chunk").alias("behind"), F.col("front").alias("true_start"))
    pairs = linked.where("behind is not null").join(fronts, "behind").join(solved.select("chunk", "start"), "chunk")
    return pairs.where(F.col("start") != F.col("true_start")).select("conv_id", "chunk", F.col("true_start").alias("start"))


def repair(rows: DataFrame, costs: Costs = Costs(), chunk: int = CHUNK) -> tuple[DataFrame, DataFrame]:
    """Conversations and their repaired turns, of ``rows`` (conv_id, turn, role, text).

    The first has a row per conversation: conv_id, gaps (turn numbers missing between the
    least and the largest), blank, duplicate, truncated (first fault of each turn), illegal
    (neighbours whose role initials are not su, ua or au), cost and audit (the edits' letters).
    The second has a row per turn that comes out: conv_id, chunk, place (order inside a conversation), role, text.
    """
    kind = rows.schema["conv_id"].dataType.simpleString()
    spaced = [F.coalesce(c, F.lit(" ")).alias(c) for c in ("role", "text")]
    turns = materialise(rows.select("conv_id", F.col("turn").cast("long").alias("turn"), *spaced).withColumn("row", F.monotonically_increasing_id()), "turns")
    facts = materialise(with_faults(turns), "turn_facts")
    order = ["conv_id", "turn", "role", "h", "row"]
    parts = min(PARTITIONS, max(1, -(-facts.count() // chunk)))
    ranged = facts.repartitionByRange(parts, *order).sortWithinPartitions(*order).withColumn("part", F.spark_partition_id())
    schema = f"conv_id {kind}, chunk long, symbols binary, rows array<long>, turns long, first long, last long"
    chunks = materialise(in_tasks(ranged.select("conv_id", "turn", "row", "symbol", "part"), _chunks(chunk), schema), "chunks")

    solved = _cost_vectors(chunks, costs, kind)
    by_conv = Window.partitionBy("conv_id").orderBy("chunk")
    several = chunks.groupBy("conv_id").agg(F.count("*").alias("size")).where("size > 1")
    long_ = chunks.join(several, chunks["conv_id"].eqNullSafe(several["conv_id"]), "left_semi")
    exits = in_tasks(_per_chunk(long_.select("conv_id", "chunk", "symbols"), solved), _exits(costs), f"conv_id {kind}, chunk long, exits array<int>")
    ordered = materialise(exits, "exits").repartition("conv_id").sortWithinPartitions("conv_id", "chunk")
    entries = materialise(in_tasks(ordered, _entries, f"conv_id {kind}, chunk long, entry int"), "entries")
    finals = long_.groupBy("conv_id").agg(F.max("chunk").alias("chunk")).select("chunk", F.lit(True).alias("closes"))
    placed = _per_chunk(_per_chunk(chunks, solved.select("conv_id", "chunk", "start", "low", "front")), entries, "left").join(finals, "chunk", "left")
    # a chunk alone begins in the first state and closes its conversation
    alone = F.col("entry").isNull()
    placed = placed.withColumn("final", alone | F.coalesce("closes", F.lit(False))).withColumn("entry", F.coalesce("entry", F.lit(START)))
    schema = (
        f"conv_id {kind}, chunk long, audit string, made array<struct<row:long,role:string>>, "
        "blank long, duplicate long, truncated long, illegal long, initial long, ending long"
    )
    traced = materialise(in_tasks(placed.select("conv_id", "chunk", "symbols", "rows", "start", "entry", "final"), _traced(costs), schema), "traced")

    joined = _per_chunk(traced.drop("made"), placed.select("conv_id", "chunk", "low", "front", "turns", "first", "last"))
    ahead = by_conv.rowsBetween(Window.unboundedPreceding, -1)
    before = joined.withColumns({"ending_before": F.lag("ending").over(by_conv), "last_before": F.last("last", True).over(ahead)})
    pair = F.col("ending_before") * 4 + F.col("initial")
    seam = (F.col("ending_before").isNotNull() & ~pair.isin(*[a * 4 + b for a, b in _LEGAL])).cast("long")
    again = F.coalesce((F.col("first") == F.col("last_before")).cast("long"), F.lit(0))
    # fronts behind the first chunk have minimum 0: the constants are in low
    total = F.sum("low") + F.min_by(F.element_at("front", START + 1), "chunk")
    span = F.max("last") - F.min("first") + 1 - F.sum(F.col("turns") - again)
    conversations = before.groupBy("conv_id").agg(
        F.coalesce(span, F.lit(0)).alias("gaps"),
        *[F.sum(c).alias(c) for c in ("blank", "duplicate", "truncated")],
        F.sum(F.col("illegal") + seam).alias("illegal"),
        total.alias("cost"),
        F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("chunk", "audit"))), lambda x: x["audit"]), "").alias("audit"),
    )
    return conversations, _repaired(traced, turns)


def _repaired(traced: DataFrame, turns: DataFrame) -> DataFrame:
    made = traced.select("conv_id", "chunk", F.posexplode("made").alias("place", "m")).select("conv_id", "chunk", "place", "m.row", F.col("m.role").alias("new"))
    texts = turns.select("row", "role", "text")
    kept = made.where("row is not null").join(texts, "row").select("conv_id", "chunk", "place", F.coalesce("new", "role").alias("role"), "text")
    added = made.where("row is null").select("conv_id", "chunk", "place", F.col("new").alias("role"), F.lit("").alias("text"))
    return kept.union(added)


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """sha256 of the lines of each conversation, one turn after the other."""
    import hashlib

    conv, sha, kind = object(), None, None
    ready: list[tuple] = []

    def out() -> pa.RecordBatch:
        return pa.record_batch([pa.array([r[0] for r in ready], kind), pa.array([r[1] for r in ready], pa.string())], ["conv_id", "sha"])

    for batch in batches:
        kind = batch.schema.field("conv_id").type
        for of, role, text in zip(*[batch.column(c).to_pylist() for c in ("conv_id", "role", "text")], strict=True):
            if of != conv:
                if sha is not None:
                    ready.append((conv, sha.hexdigest()))
                conv, sha = of, hashlib.sha256()
            else:
                sha.update(b"\n")
            sha.update(f"{role}:{text}".encode())
        if ready:
            yield out()
            ready.clear()
    if sha is not None:
        ready.append((conv, sha.hexdigest()))
        yield out()


def turn_digests(repaired: DataFrame) -> DataFrame:
    """conv_id and the sha256 of its ``role:text`` lines; one task reads a conversation, turn by turn."""
    kind = repaired.schema["conv_id"].dataType.simpleString()
    ordered = repaired.repartition("conv_id").sortWithinPartitions("conv_id", "chunk", "place")
    return in_tasks(ordered.select("conv_id", "role", "text"), _digests, f"conv_id {kind}, sha string")


def damage(rows: DataFrame) -> DataFrame:
    """Turns with planted faults, by crc32 of ``conv_id:turn``: conv_id, turn, role, text."""
    spaced = {c: F.coalesce(F.col(c), F.lit(" ")) for c in ("role", "text")}
    name = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    kind = F.crc32(F.concat(name("conv_id"), F.lit(":"), name("turn"))) % 20
    text = F.when(F.col("kind") == 1, "").when(F.col("kind") == 2, F.regexp_replace("text", "[.!?]", "")).otherwise(F.col("text"))
    role = F.when(F.col("kind") == 4, "user").otherwise(F.col("role"))
    copies = F.explode(F.when(F.col("kind") == 3, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1))))
    marked = rows.select("conv_id", "turn", *[c.alias(n) for n, c in spaced.items()], kind.alias("kind")).where("kind != 0")
    return marked.select("conv_id", "turn", role.alias("role"), text.alias("text"), copies.alias("copy")).drop("copy")


EMPTY_SHA = "e3b0c44298fc1c149afbf4c8996fb92427ae41e4649b934ca495991b7852b855"


def repair_report(rows: DataFrame) -> DataFrame:
    """Every conv_id of ``rows``, after ``damage``, with what ``repair`` says and the digest of its repaired turns."""
    conversations, repaired = repair(damage(rows))
    digests = turn_digests(repaired)
    ids = rows.select("conv_id").distinct()
    found = ids.join(conversations.withColumnRenamed("conv_id", "c"), F.col("conv_id").eqNullSafe(F.col("c")), "left").drop("c")
    found = found.join(digests.withColumnRenamed("conv_id", "c"), F.col("conv_id").eqNullSafe(F.col("c")), "left").drop("c")
    counts = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost"]
    return found.select(
        "conv_id", *[F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in counts],
        F.coalesce("audit", F.lit("")).alias("audit"), F.coalesce("sha", F.lit(EMPTY_SHA)).alias("repaired_sha256"),
    )
