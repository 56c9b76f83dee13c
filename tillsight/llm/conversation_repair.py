"""Repair of conversation structure over a suffix-shared automaton of role and fault signatures.

A row of a conversation is one symbol: `d` (blank or duplicate, must go) or its role's initial `s`, `u`, `a`,
`x` (any other), in upper case where the text is truncated. A conversation's symbols in order are its
signature, and the cheapest repair of what follows a row depends on nothing but the symbols that follow
and the state of the grammar `(s?(ua)+)?`.

1. Equal rows are counted, a text's first turn in its conversation is joined back, and rows are put in order
   by range partitions of (conversation, turn, role, text), so a conversation of any size is spread over
   tasks. A task cuts its rows into **pieces** of at most `PIECE_ROWS` rows and `PIECE_CHARS` characters.
2. **End vectors.** What a piece costs depends on the four costs-to-go behind it. Those of a conversation's
   last piece are fixed; a pass over the pieces in reverse order carries four numbers on.
3. **The automaton.** The distinct (end vector, signature) pairs are sorted by reversed signature, so that
   signatures with a common suffix follow one another and every suffix is built once: a node is a
   suffix, shared by all conversations that end in it. It keeps, for each of the four states, the
   cost-to-go, the first edit of the best audit and the state after it. A range partition builds again
   only the suffix that it shares with the one before it.
4. A pass over the pieces in order picks the audit of the state that each is entered in, and the texts meet
   their audits by piece, where the repaired lines are written and hashed. The lines of a conversation
   of several pieces are hashed one after the other (SHA-256 has no other way), a megabyte a row.

At a node all candidate edits begin with different initials, so ties of cost are settled by the initial
alone (D < I < K < R) and no audit is ever compared or copied as a whole.

Memory: a task holds one piece, one signature's path of nodes, and at the end the audit of one conversation
(the contract wants it in one cell). No conversation is gathered.

Defined cases: null columns count as one space, a null conv_id is a conversation of its own; turns go up,
nulls first, rows of one turn by role, then text; exact copies of a row are adjacent and all but the first are
duplicates; a conversation without rows gives zeros, an empty audit and the hash of the empty string; an
empty table gives an empty result; extra columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillsight.llm.common import in_arrow, meet, stored

PIECE_ROWS, PIECE_CHARS = 2048, 1 << 20
#: Characters of a text and of a signature that take part in finding range bounds (never in comparing).
BOUND_CHARS = 64
OPEN = 1 << 40            # a cost that no repair has
START, SYSTEM, USER, ASSISTANT = range(4)
#: Grammar: state after a role's initial.
AFTER = {"s": {START: SYSTEM}, "u": {START: USER, SYSTEM: USER, ASSISTANT: USER}, "a": {USER: ASSISTANT}, "x": {}}
#: The role a repair may put in each state, and the state after it.
PUT = {START: ("user", USER), SYSTEM: ("user", USER), USER: ("assistant", ASSISTANT), ASSISTANT: ("user", USER)}
KEEP, REROLE, DELETE, INSERT, TRUNCATED = 0, 2, 3, 2, 1
#: Costs-to-go where no row follows, and the insertions they stand for.
END, END_AUDITS = (0, 2 * INSERT, INSERT, 0), ("", "II", "I", "")
BLANKS = r"[\x20\x09-\x0D]"


def damaged(rows: DataFrame) -> DataFrame:
    """The rows with planted faults, by crc32 of `conv_id:turn` modulo 20; ``role`` and ``text`` without nulls."""
    blank = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    kind = F.crc32(F.concat(blank("conv_id"), F.lit(":"), blank("turn"))) % 20
    hurt = rows.select("conv_id", "turn", blank("role").alias("role"), blank("text").alias("text"), kind.alias("kind"))
    hurt = hurt.where("kind <> 0").select(
        "conv_id", "turn", F.when(F.col("kind") == 4, "user").otherwise(F.col("role")).alias("role"),
        F.when(F.col("kind") == 1, "").when(F.col("kind") == 2, F.regexp_replace("text", "[.!?]", ""))
         .otherwise(F.col("text")).alias("text"), F.when(F.col("kind") == 3, 2).otherwise(1).alias("copies"))
    return hurt.select("conv_id", "turn", "role", "text", F.explode(F.sequence(F.lit(1), "copies")).alias("_")).drop("_")


def judged(rows: DataFrame) -> DataFrame:
    """One row for all equal ones (``n`` of them), with the symbol of the first and whether a copy of it came before."""
    counted = stored(rows.groupBy("conv_id", "turn", "role", "text").agg(F.count(F.lit(1)).alias("n")), "repair-rows")
    digest = F.unhex(F.sha2(F.concat_ws("\x00", F.col("conv_id").isNull().cast("string"), F.col("conv_id").cast("string"),
                                        F.length("role").cast("string"), "role", "text"), 256))
    place = F.struct(F.col("turn").isNotNull().alias("late"), "turn")
    firsts = counted.groupBy(digest.alias("digest")).agg(F.min(place).alias("first"), F.count(F.lit(1)).alias("rows")).where("rows > 1")
    met = meet(counted.withColumn("digest", digest), stored(firsts, "repair-firsts"), ["digest"], "rows")
    blank = ~F.col("text").rlike(r"[^\x20\x09-\x0D]")
    again = F.coalesce(place > F.col("first"), F.lit(False))
    cut = ~F.col("text").rlike(rf"[.!?]{BLANKS}*\z")
    initial = F.when(F.col("role").rlike("^[sua]"), F.substring("role", 1, 1)).otherwise("x")
    symbol = F.when(blank, "b").when(again, "d").when(cut, F.upper(initial)).otherwise(initial)
    return met.select("conv_id", "turn", "role", "text", "n", symbol.alias("symbol"))


_STATS = ["turns", "blank", "duplicate", "truncated", "illegal"]


def pieces(rows: DataFrame) -> DataFrame:
    """Ordered rows as pieces (conv_id, piece, part, signature, roles, texts, first and last turn and role initial,
    counts). ``piece`` is the place of the first row, ``part`` which of its copies; both grow along a conversation."""
    n = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    keys = ["conv_id", "turn", "role"]
    # Bounds are found on the first characters: these order the rows as the whole values do.
    short = F.when(F.length("role") <= BOUND_CHARS, F.substring("text", 1, BOUND_CHARS)).otherwise("")
    ordered = (rows.repartitionByRange(n, "conv_id", "turn", F.substring("role", 1, BOUND_CHARS), short)
                   .sortWithinPartitions(*keys, "text").withColumn("at", F.monotonically_increasing_id()))
    ordered = ordered.select("conv_id", "turn", "role", "text", "n", "symbol", "at")
    conv, turn = rows.schema["conv_id"].dataType.simpleString(), rows.schema["turn"].dataType.simpleString()
    schema = (f"conv_id {conv}, piece bigint, part bigint, signature string, roles array<string>, texts array<string>, "
              f"first_turn {turn}, last_turn {turn}, first_initial string, last_initial string, "
              + ", ".join(f"{s} bigint" for s in _STATS))
    kinds = {}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict | None = None
        for batch in batches:
            kinds.setdefault("conv", batch.schema.field("conv_id").type)
            kinds.setdefault("turn", batch.schema.field("turn").type)
            out = []
            for c, turn, role, text, copies, symbol, at in zip(*(x.to_pylist() for x in batch.columns), strict=True):
                for k in range(copies):
                    if held and (held["conv_id"] != c or len(held["roles"]) >= PIECE_ROWS or held["chars"] >= PIECE_CHARS):
                        out.append(held)
                        held = None
                    if held is None:
                        held = {"conv_id": c, "piece": at, "part": k, "symbols": [], "roles": [], "texts": [], "chars": 0, "first_turn": None,
                                "last_turn": None, "first_initial": role[:1], **dict.fromkeys(_STATS, 0)}
                    if turn is not None:
                        held["turns"] += turn != held["last_turn"]
                        if held["first_turn"] is None:
                            held["first_turn"] = turn
                        held["last_turn"] = turn
                    if held["roles"] and held["last_initial"] + role[:1] not in ("su", "ua", "au"):
                        held["illegal"] += 1
                    held["last_initial"] = role[:1]
                    now = symbol if symbol in "bd" or not k else "d"
                    held["blank"] += now == "b"
                    held["duplicate"] += now == "d"
                    held["truncated"] += now.isupper()
                    held["symbols"].append("d" if now == "b" else now)
                    held["roles"].append(role)
                    held["texts"].append(text)
                    held["chars"] += len(text) + len(role)
            if out:
                yield _batch(out)
        if held:
            yield _batch([held])

    def _batch(out: list[dict]) -> pa.RecordBatch:
        cols = [("conv_id", kinds["conv"]), ("piece", pa.int64()), ("part", pa.int64()), ("signature", pa.string()),
                ("roles", pa.list_(pa.string())), ("texts", pa.list_(pa.string())), ("first_turn", kinds["turn"]),
                ("last_turn", kinds["turn"]), ("first_initial", pa.string()), ("last_initial", pa.string()),
                *[(s, pa.int64()) for s in _STATS]]
        for r in out:
            r["signature"] = "".join(r["symbols"])
        return pa.RecordBatch.from_arrays([pa.array([r[n] for r in out], t) for n, t in cols], names=[n for n, _ in cols])

    return in_arrow(ordered, run, schema)


def node(symbol: str, behind: tuple) -> tuple:
    """A node from its symbol and the node behind it: per state (cost-to-go, first edit, state after, state in
    which the signature is left). The edits are to be read with ``audit_of``."""
    best: list = [None] * 4
    low = symbol.lower()
    more = TRUNCATED if symbol != low else 0
    for state in range(4):
        cost, _, _, left = behind[state]
        options = [(cost + DELETE, "D", state, left)]
        if low != "d":
            after = AFTER[low].get(state)
            if after is not None:
                options.append((behind[after][0] + more + KEEP, "K", after, behind[after][3]))
            after = PUT[state][1]
            options.append((behind[after][0] + more + REROLE, "R", after, behind[after][3]))
        best[state] = min(options)
    eaten = list(best)
    # Insertions lead to another state of the same node; twice at most, since four costs separate no states further.
    for _ in range(2):
        for state in range(4):
            after = PUT[state][1]
            option = (best[after][0] + INSERT, "I", after, best[after][3])
            best[state] = min(eaten[state], option, key=lambda o: o[:2])
    return tuple(best)


def end_node(vector: tuple) -> tuple:
    return tuple((c, "", s, s) for s, c in enumerate(vector))


def audit_of(path: list[tuple], state: int, final: bool) -> str:
    """The best audit from ``state`` at the signature's first row; ``path`` holds its nodes, the end first."""
    out, at = [], len(path) - 1
    while at:
        _, edit, after, _ = path[at][state]
        out.append(edit)
        state = after
        at -= edit != "I"
    return "".join(out) + (END_AUDITS[state] if final else "")


def end_vectors(parts: DataFrame) -> DataFrame:
    """Narrow pieces with the costs-to-go behind them (less their least, ``behind``) and whether they are the first and
    the last of their conversation."""
    narrow = parts.drop("roles", "texts")
    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in narrow.schema) + ", behind array<bigint>, first boolean, last boolean"
    names = [*narrow.columns, "behind", "first", "last"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        behind, before, held = END, None, None          # before: the row that comes next in its conversation

        def judge(batch: pa.RecordBatch, follows) -> pa.RecordBatch:
            """``follows``: the conversation of the row after the batch."""
            nonlocal behind, before
            convs, vectors, first, last = batch.column("conv_id").to_pylist(), [], [], []
            for c, signature, other in zip(convs, batch.column("signature").to_pylist(), [*((x,) for x in convs[1:]), follows], strict=True):
                last.append(before is None or before[0] != c)
                if last[-1]:
                    behind = END
                else:
                    now = end_node(behind)
                    for symbol in reversed(before[1]):
                        now = node(symbol, now)
                    least = min(x[0] for x in now)
                    behind = tuple(x[0] - least for x in now)
                first.append(other != (c,))
                vectors.append(behind)
                before = (c, signature)
            return pa.RecordBatch.from_arrays([*batch.columns, pa.array(vectors, pa.list_(pa.int64())), pa.array(first), pa.array(last)], names=names)

        for batch in batches:
            if batch.num_rows:
                if held is not None:
                    yield judge(held, (batch.column("conv_id")[0].as_py(),))
                held = batch
        if held is not None:
            yield judge(held, None)

    back = narrow.repartition("conv_id").sortWithinPartitions("conv_id", F.desc("piece"), F.desc("part"))
    return in_arrow(back, run, schema)


def automaton(words: DataFrame) -> DataFrame:
    """(behind, final, signature) with the costs, exit states and audits of the four entry states (only state 0 where
    ``whole``: the signature begins its conversations). Rows come sorted by reversed signature, and the
    nodes of the suffix shared with the row before are taken over."""
    n = int(words.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    turned = words.withColumn("turned", F.reverse("signature"))
    turned = (turned.repartitionByRange(n, "final", "behind", F.substring("turned", 1, BOUND_CHARS))
                    .sortWithinPartitions("final", "behind", "turned").select("behind", "final", "signature", "turned", "whole", "n"))
    schema = "behind array<bigint>, final boolean, signature string, costs array<bigint>, exits array<int>, audits array<string>, n bigint"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        root, word, path = None, "", []
        for batch in batches:
            costs, exits, audits = [], [], []
            for behind, final, _, turned, whole, _ in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if (final, behind) != root:
                    root, word, path = (final, behind), "", [end_node(tuple(behind))]
                shared = 0
                for x, y in zip(word, turned):     # noqa: B905
                    if x != y:
                        break
                    shared += 1
                del path[shared + 1:]
                for symbol in turned[shared:]:
                    path.append(node(symbol, path[-1]))
                word = turned
                states = range(1 if whole else 4)
                costs.append([path[-1][s][0] for s in states])
                exits.append([path[-1][s][3] for s in states])
                audits.append([audit_of(path, s, final) for s in states])
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), batch.column(2), pa.array(costs, pa.list_(pa.int64())),
                 pa.array(exits, pa.list_(pa.int32())), pa.array(audits, pa.list_(pa.string())), batch.column(5)],
                names=["behind", "final", "signature", "costs", "exits", "audits", "n"])

    return in_arrow(turned, run, schema)


def walked(narrow: DataFrame) -> DataFrame:
    """Per piece the state it is entered in and its audit; on a conversation's last piece its counts, cost and whole
    audit as well."""
    conv = narrow.schema["conv_id"].dataType.simpleString()
    counts = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost"]
    schema = (f"conv_id {conv}, piece bigint, part bigint, entry int, edits string, alone boolean, last boolean, "
              + ", ".join(f"{c} bigint" for c in counts) + ", audit string")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        so_far = None
        for batch in batches:
            out = []
            for r in batch.to_pylist():
                if so_far is None:
                    so_far = {"state": START, "audit": [], "first": None, "turn": None, "turns": 0, "initial": None, "n": 0,
                              **dict.fromkeys(counts, 0)}
                k = so_far
                state = k["state"]
                edits = r["audits"][state]
                k["cost"] += r["costs"][state] - (0 if r["last"] else r["behind"][r["exits"][state]])
                k["audit"].append(edits)
                k["turns"] += r["turns"] - (r["first_turn"] is not None and r["first_turn"] == k["turn"])
                k["first"] = r["first_turn"] if k["first"] is None else k["first"]
                k["turn"] = k["turn"] if r["last_turn"] is None else r["last_turn"]
                for c in ("blank", "duplicate", "truncated", "illegal"):
                    k[c] += r[c]
                if k["initial"] is not None:
                    k["illegal"] += k["initial"] + r["first_initial"] not in ("su", "ua", "au")
                k["initial"] = r["last_initial"]
                k["state"] = r["exits"][state]
                k["n"] += 1
                k["gaps"] = 0 if k["first"] is None else k["turn"] - k["first"] + 1 - k["turns"]
                done = r["last"]
                out.append([r["conv_id"], r["piece"], r["part"], state, edits, done and k["n"] == 1, done,
                            *[k[c] if done else None for c in counts], "".join(k["audit"]) if done else None])
                if done:
                    so_far = None
            types = [batch.schema.field("conv_id").type, pa.int64(), pa.int64(), pa.int32(), pa.string(), pa.bool_(), pa.bool_(),
                     *[pa.int64()] * len(counts), pa.string()]
            yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in out], t) for i, t in enumerate(types)],
                                             names=["conv_id", "piece", "part", "entry", "edits", "alone", "last", *counts, "audit"])

    return in_arrow(narrow.repartition("conv_id").sortWithinPartitions("conv_id", "piece", "part"), run, schema)


def repaired(roles: list[str], texts: list[str], state: int, edits: str) -> list[tuple[str, str]]:
    """(role, text) of the rows that the edits leave."""
    out, at = [], 0
    for edit in edits:
        if edit == "I":
            role, state = PUT[state]
            out.append((role, ""))
            continue
        if edit == "K":
            out.append((roles[at], texts[at]))
            state = AFTER[roles[at][:1]][state]
        elif edit == "R":
            role, state = PUT[state]
            out.append((role, texts[at]))
        at += 1
    return out


def hashes(parts: DataFrame, walks: DataFrame) -> DataFrame:
    """(conv_id, repaired_sha256) of every conversation that has a piece."""
    met = parts.select("piece", "part", "roles", "texts").join(
        walks.select("conv_id", "piece", "part", "entry", "edits", "alone", "last"), ["piece", "part"])
    lines = met.select("conv_id", "piece", "part", "alone", "last", "roles", "texts", "entry", "edits")
    conv = walks.schema["conv_id"].dataType.simpleString()

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sums, bodies = [], []
            for alone, roles, texts, entry, edits in zip(*(batch.column(c).to_pylist() for c in (
                    "alone", "roles", "texts", "entry", "edits")), strict=True):
                rows = repaired(roles, texts, entry, edits)
                body = "\n".join(f"{r}:{t}" for r, t in rows).encode()
                sums.append(hashlib.sha256(body).hexdigest() if alone else None)
                bodies.append(None if alone or not rows else body)
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in ("conv_id", "piece", "part", "last")), pa.array(sums, pa.string()),
                                              pa.array(bodies, pa.binary())], names=["conv_id", "piece", "part", "last", "sum", "body"])

    def chain(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        digest, begun = hashlib.sha256(), False
        for batch in batches:
            convs, sums = [], []
            for c, _, _, last, _, body in zip(*(x.to_pylist() for x in batch.columns), strict=True):
                if body is not None:
                    digest.update(b"\n" + body if begun else body)
                    begun = True
                if last:
                    convs.append(c)
                    sums.append(digest.hexdigest())
                    digest, begun = hashlib.sha256(), False
            yield pa.RecordBatch.from_arrays([pa.array(convs, batch.schema.field(0).type), pa.array(sums, pa.string())],
                                             names=["conv_id", "repaired_sha256"])

    made = in_arrow(lines, write, f"conv_id {conv}, piece bigint, part bigint, last boolean, sum string, body binary")
    made = stored(made, "repair-lines")
    long = made.where("sum IS NULL").repartition("conv_id").sortWithinPartitions("conv_id", "piece", "part")
    return made.where("sum IS NOT NULL").select("conv_id", F.col("sum").alias("repaired_sha256")).unionByName(
        in_arrow(long, chain, f"conv_id {conv}, repaired_sha256 string"))


_NOTHING = hashlib.sha256(b"").hexdigest()


def repair(rows: DataFrame, conversations: DataFrame | None = None) -> DataFrame:
    """Every conversation of ``rows`` (and of ``conversations``, if some may have no rows left) with gaps, faults, cost, audit
    and the hash of its repaired rows."""
    parts = stored(pieces(judged(rows.select("conv_id", "turn", "role", "text"))), "repair-pieces")
    narrow = stored(end_vectors(parts), "repair-signatures")
    words = narrow.groupBy("behind", F.col("last").alias("final"), "signature").agg(
        F.min("first").alias("whole"), F.count(F.lit(1)).alias("n"))
    table = stored(automaton(words), "repair-automaton")
    walks = stored(walked(meet(narrow.withColumn("final", F.col("last")), table, ["behind", "final", "signature"], "n")), "repair-walks")
    done = walks.where("last").select("conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit")
    sums = hashes(parts, walks).withColumnRenamed("conv_id", "_conv")
    out = done.join(sums, F.col("conv_id").eqNullSafe(F.col("_conv"))).drop("_conv")
    if conversations is None:
        return out
    every = conversations.select(F.col("conv_id").alias("_conv")).distinct()
    out = every.join(out, F.col("_conv").eqNullSafe(F.col("conv_id")), "left")
    return out.select(F.col("_conv").alias("conv_id"),
                      *[F.coalesce(c, F.lit(0).cast("long")).alias(c) for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")],
                      F.coalesce("audit", F.lit("")).alias("audit"), F.coalesce("repaired_sha256", F.lit(_NOTHING)).alias("repaired_sha256"))

