"""Repair of damaged conversations at the least cost, with the least audit of its edits.

A conversation's rows in order of turns are to give role initials `(s?(ua)+)?`. Rows can be kept, given another role, deleted,
and empty user or assistant rows inserted. The grammar has four states, so a row is a 4x4 matrix of least costs, and
the costs from every row to the end are products of matrices, made by doubling. An arc between nodes (row, state) is optimal
if it lies on a cheapest path. Nodes are then ranked by their least audits of 1, 2, 4, ... letters: the rank of twice the length
comes from the pair of a node's rank and that of the node its pointer reaches, and the pointers double in step. From one node
no two arcs have the same letter, so the first ranks choose the arc and all further ones order whole audits; equal final
ranks share one audit, which is read off the doubled pointers.

Rows are dealt by ranges of (conversation, turn, role, text), so a conversation with many rows lies in several tasks.
There it becomes pieces of bounded rows and bytes. A conversation of one piece is solved on the spot. For longer ones
the pieces' matrices give the costs at their borders and, after that, the states in which they are entered; both are
some bytes a piece, and each piece is solved by itself. Only the digest of the repaired text is sequential: it streams over the
pieces. One audit is one string, so a conversation has less than 2**31 rows.

Nulls in a row count as one space (a NULL conversation is one of its own, NULL turns come first). Rows of one turn are taken by role
and text in code-point order; repeated rows are duplicates. A conversation without rows after the damage has zeros, an empty
audit and the digest of nothing. An empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tablespan.llm.registry import query, read
from tablespan.sources.shared import kept

#: Fixed values of the contract.
BLANKS = "\t\n\x0b\x0c\r "
RELABEL, DELETE, INSERT, CUT = 3, 4, 3, 3
ROLES = {"u": "user", "a": "assistant"}

PIECE_ROWS = 4096
PIECE_BYTES = 1 << 21  # of text in a piece of several rows
BATCH_ROWS = 1 << 14  # solved together

START, SYSTEM, USER, ASSISTANT = range(4)
LETTERS = " DIKR"  # of audits, in ASCII order; the first one ends an audit
OTHER, S, U, A = range(4)  # initials
BLANK, DUPLICATE, TRUNCATED = 4, 8, 16  # added to a row's initial
_FAR = 1 << 40
_ON = np.array([USER, USER, ASSISTANT, USER])  # the state after a user or assistant row made to fit
_KEPT = np.array([[-1, SYSTEM, USER, -1], [-1, -1, USER, -1], [-1, -1, -1, ASSISTANT], [-1, -1, USER, -1]])  # [state, initial]
_INSERTED = np.array([[0, _FAR, 3, 6], [_FAR, 0, 3, 6], [_FAR, _FAR, 0, 3], [_FAR, _FAR, 3, 0]])
_ENDS = np.array([0, 6, 3, 0])  # from each state to an accepted end, by inserted rows

PIECE = (
    "conv_id long, part int, piece int, low long, high long, turns long, illegal long, first string, last string, "
    "codes binary, digests binary, roles array<string>, texts array<string>"
)
RESULT = "conv_id long, gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string, repaired_sha256 string"


def _product(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Products of 4x4 matrices of least costs."""
    return (a[:, :, :, None] + b[:, None, :, :]).min(axis=2)


def _rows_costs(codes: np.ndarray) -> np.ndarray:
    """For each row the least costs from state to state by edits up to and including the one of the row."""
    n = len(codes)
    initial, must = codes & 3, (codes & (BLANK | DUPLICATE)) > 0
    cut = np.where(codes & TRUNCATED, CUT, 0)
    own = np.full((n, 4, 4), _FAR)
    rows = np.arange(n)
    for p in range(4):
        own[:, p, p] = DELETE
        own[:, p, _ON[p]] = np.minimum(own[:, p, _ON[p]], np.where(must, _FAR, RELABEL + cut))
        to = _KEPT[p][initial]
        good = (to >= 0) & ~must
        own[rows[good], p, to[good]] = np.minimum(own[rows[good], p, to[good]], cut[good])
    return np.minimum(_product(np.broadcast_to(_INSERTED, (n, 4, 4)), own), _FAR)


def _suffix_costs(codes: np.ndarray, stops: np.ndarray) -> np.ndarray:
    """For each row the costs of its piece from there on; `stops`: each row's end of its piece."""
    sums = _rows_costs(codes)
    rows = np.arange(len(codes))
    step = 1
    longest = int((stops - rows).max(initial=0))
    while step < longest:
        more = rows[rows + step < stops]
        sums[more] = np.minimum(_product(sums[more], sums[more + step]), _FAR)
        step *= 2
    return sums


class Solved:
    """The least audits of pieces from each state in which they can be entered."""

    def __init__(self, pieces: list[np.ndarray], ends: np.ndarray, last: np.ndarray):
        """`pieces`: the codes of each; `ends`: costs from each state behind it; `last`: whether rows can be inserted there."""
        lengths = np.array([len(x) for x in pieces], dtype=np.int64)
        codes = np.concatenate(pieces) if pieces else np.zeros(0, np.uint8)
        owner = np.repeat(np.arange(len(pieces)), lengths)
        stops = np.cumsum(lengths)
        # Nodes: one position more than rows in each piece.
        at = np.arange(len(codes)) + owner
        end_at = stops + np.arange(len(pieces))
        costs = np.zeros((len(codes) + len(pieces), 4), dtype=np.int64)
        costs[end_at] = ends
        costs[at] = (_suffix_costs(codes, stops[owner] if len(codes) else stops) + ends[owner][:, None, :]).min(axis=2)
        self.costs, self.begins = costs, end_at - lengths
        self._choose(codes, at, end_at[last], costs)
        self._rank()

    def _choose(self, codes: np.ndarray, at: np.ndarray, inserting: np.ndarray, costs: np.ndarray) -> None:
        """Each node's optimal arc of the least letter, and the node it leads to; 0 and the node itself at an end."""
        letter = np.zeros(costs.shape, dtype=np.int64)
        target = np.arange(costs.size).reshape(costs.shape)
        initial, must = codes & 3, (codes & (BLANK | DUPLICATE)) > 0
        cut = np.where(codes & TRUNCATED, CUT, 0)
        open_at = np.append(at, inserting)

        def take(positions: np.ndarray, state: int, good: np.ndarray, sign: str, to: np.ndarray) -> None:
            good = good & (letter[positions, state] == 0)
            letter[positions[good], state] = LETTERS.index(sign)
            target[positions[good], state] = to[good]

        for p in range(4):
            take(at, p, costs[at, p] == DELETE + costs[at + 1, p], "D", (at + 1) * 4 + p)
            take(open_at, p, costs[open_at, p] == INSERT + costs[open_at, _ON[p]], "I", open_at * 4 + _ON[p])
            to = _KEPT[p][initial]
            take(at, p, (to >= 0) & ~must & (costs[at, p] == cut + costs[at + 1, to]), "K", (at + 1) * 4 + to)
            take(at, p, ~must & (costs[at, p] == RELABEL + cut + costs[at + 1, _ON[p]]), "R", (at + 1) * 4 + _ON[p])
        self.letter, self.pointers = letter.ravel(), [target.ravel()]

    def _rank(self) -> None:
        """Ranks by audits of doubled lengths until every pointer stands at an end."""
        rank, pointer = self.letter, self.pointers[0]
        self.lengths = (rank > 0).astype(np.int64)
        while (self.letter[pointer] > 0).any():
            pairs = rank * (int(rank.max()) + 1) + rank[pointer]
            rank = np.unique(pairs, return_inverse=True)[1].reshape(-1)
            self.lengths = self.lengths + self.lengths[pointer]
            pointer = pointer[pointer]
            self.pointers.append(pointer)
        self.rank, self.exits = rank, pointer

    def nodes(self, state: int) -> np.ndarray:
        """The first node of each piece."""
        return self.begins * 4 + state

    def audits(self, nodes: np.ndarray) -> list[str]:
        """The least audits from these nodes; those of equal ranks are read once."""
        _, first, back = np.unique(self.rank[nodes], return_index=True, return_inverse=True)
        starts = nodes[first]
        lengths = self.lengths[starts]
        steps = np.arange(int(lengths.sum())) - np.repeat(np.cumsum(lengths) - lengths, lengths)
        on = np.repeat(starts, lengths)
        for k, pointer in enumerate(self.pointers):
            far = (steps >> k) & 1 > 0
            on[far] = pointer[on[far]]
        signs = np.frombuffer(LETTERS.encode(), dtype=np.uint8)[self.letter[on]].tobytes().decode()
        cuts = np.cumsum(lengths).tolist()
        texts = [signs[b - n : b] for b, n in zip(cuts, lengths.tolist(), strict=True)]
        return [texts[i] for i in back.reshape(-1).tolist()]


def repaired(audit: str, roles: list[str], texts: list[str], state: int = START) -> Iterator[str]:
    """The rows that an audit leaves, as `role:text`."""
    row = 0
    for sign in audit:
        made = "a" if state == USER else "u"
        if sign == "I":
            yield f"{ROLES[made]}:"
        elif sign != "D":
            role = roles[row] if sign == "K" else ROLES[made]
            made = role[:1]
            yield f"{role}:{texts[row]}"
        row += sign != "I"
        if sign != "D":
            state = {"s": SYSTEM, "u": USER, "a": ASSISTANT}[made]


def damaged(rows: DataFrame) -> DataFrame:
    """(conv_id, turn, role, text) after the damage that the contract deals out by hashes of places."""
    blank = F.lit(" ")
    place = F.concat(F.coalesce(F.col("conv_id").cast("string"), blank), F.lit(":"), F.coalesce(F.col("turn").cast("string"), blank))
    given = rows.select(
        F.col("conv_id").cast("long").alias("conv_id"),
        F.col("turn").cast("long").alias("turn"),
        F.coalesce(F.col("role").cast("string"), blank).alias("role"),
        F.coalesce(F.col("text").cast("string"), blank).alias("text"),
        (F.crc32(place.cast("binary")) % 20).alias("kind"),
    ).filter("kind <> 0")
    kind = F.col("kind")
    return given.select(
        "conv_id",
        "turn",
        F.when(kind == 4, "user").otherwise(F.col("role")).alias("role"),
        F.when(kind == 1, "").when(kind == 2, F.translate("text", ".!?", "")).otherwise(F.col("text")).alias("text"),
        F.explode(F.when(kind == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))).alias("copy"),
    ).drop("copy")


def _code() -> Column:
    """A row's initial, and its faults but for duplicates."""
    initial = F.substring("role", 1, 1)
    end = F.substring(F.rtrim(F.col("text"), F.lit(BLANKS)), -1, 1)
    code = F.when(initial == "s", S).when(initial == "u", U).when(initial == "a", A).otherwise(OTHER)
    return (code + F.when(end == "", BLANK).when(~end.isin(".", "!", "?"), TRUNCATED).otherwise(0)).cast("tinyint")


def pieces_of(rows: DataFrame, piece_rows: int = PIECE_ROWS) -> DataFrame:
    """Rows (conv_id, turn, role, text) as pieces; duplicates are marked within a piece."""
    digest = F.unhex(F.md5(F.concat(F.length("role").cast("string"), F.lit(":"), "role", "text").cast("binary")))
    full = rows.withColumns({"code": _code(), "digest": digest})
    keys = ["conv_id", "turn", "role"]
    dealt = full.repartitionByRange(*keys, F.substring("text", 1, 32)).sortWithinPartitions(*keys, "text")

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId()
        number, size, owner = 0, 0, None
        held: list[tuple] = []

        def piece() -> dict:
            codes = np.array([r[4] for r in held], dtype=np.uint8)
            met: set[bytes] = set()
            for i, r in enumerate(held):
                if r[5] in met and not codes[i] & BLANK:
                    codes[i] = codes[i] & 3 | DUPLICATE
                met.add(r[5])
            turns = [r[1] for r in held if r[1] is not None]
            initials = [r[2][:1] for r in held]
            return {
                "conv_id": owner, "part": part, "piece": number, "low": turns[0] if turns else None, "high": turns[-1] if turns else None,
                "turns": len(set(turns)), "illegal": sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:], strict=False)),
                "first": initials[0], "last": initials[-1], "codes": codes.tobytes(), "digests": b"".join(r[5] for r in held),
                "roles": [r[2] for r in held], "texts": [r[3] for r in held],
            }

        made: list[dict] = []
        made_bytes = 0
        for given in batches:
            for row in zip(*(given.column(i).to_pylist() for i in range(6)), strict=True):
                if held and (row[0] != owner or len(held) == piece_rows or size + len(row[3]) > PIECE_BYTES):
                    made.append(piece())
                    number = number + 1 if row[0] == owner else 0
                    made_bytes, held, size = made_bytes + size + 64 * len(held), [], 0
                    if made_bytes > PIECE_BYTES:
                        yield pa.RecordBatch.from_pylist(made, schema=_PIECES)
                        made, made_bytes = [], 0
                owner = row[0]
                held.append(row)
                size += len(row[3])
        if held:
            made.append(piece())
        if made:
            yield pa.RecordBatch.from_pylist(made, schema=_PIECES)

    return dealt.select("conv_id", "turn", "role", "text", "code", "digest").mapInArrow(cut, PIECE)


_KINDS = {"long": pa.int64(), "int": pa.int32(), "string": pa.string(), "binary": pa.binary(), "array<string>": pa.list_(pa.string()), "array<long>": pa.list_(pa.int64())}


def _schema(text: str) -> pa.Schema:
    return pa.schema([(name, _KINDS[kind]) for name, kind in (x.split() for x in text.split(", "))])


_PIECES = _schema(PIECE)


def _batches(batches: Iterator[pa.RecordBatch]) -> Iterator[list[dict]]:
    """Rows with codes, some thousands of codes at a time."""
    for given in batches:
        held: list[dict] = []
        size = 0
        for i in range(given.num_rows):
            row = {name: given.column(j)[i].as_py() for j, name in enumerate(given.schema.names)}
            row["codes"] = np.frombuffer(row["codes"], dtype=np.uint8)
            held.append(row)
            size += len(row["codes"])
            if size >= BATCH_ROWS:
                yield held
                held, size = [], 0
        if held:
            yield held


def _faults(codes: np.ndarray) -> dict[str, int]:
    return {name: int(((codes & flag) > 0).sum()) for name, flag in (("blank", BLANK), ("duplicate", DUPLICATE), ("truncated", TRUNCATED))}


def whole(pieces: DataFrame) -> DataFrame:
    """Results of conversations that are one piece."""
    schema = _schema(RESULT)

    def solve(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in _batches(batches):
            solved = Solved([r["codes"] for r in rows], np.tile(_ENDS, (len(rows), 1)), np.ones(len(rows), dtype=bool))
            starts = solved.nodes(START)
            out = []
            for r, audit, cost in zip(rows, solved.audits(starts), solved.costs.ravel()[starts].tolist(), strict=True):
                text = "\n".join(repaired(audit, r["roles"], r["texts"]))
                gaps = 0 if r["low"] is None else r["high"] - r["low"] + 1 - r["turns"]
                out.append(
                    {"conv_id": r["conv_id"], "gaps": gaps, "illegal": r["illegal"], "cost": cost, "audit": audit, **_faults(r["codes"])}
                    | {"repaired_sha256": hashlib.sha256(text.encode()).hexdigest()}
                )
            yield pa.RecordBatch.from_pylist(out, schema=schema)

    return pieces.mapInArrow(solve, RESULT)


def _beside(pieces: DataFrame, found: DataFrame, how: str = "inner") -> DataFrame:
    """Pieces with what was found for each."""
    keys = ["conv_id", "part", "piece"]
    other = found.select(*(F.col(k).alias(f"own_{k}") for k in keys), *(c for c in found.columns if c not in keys))
    same = F.col("conv_id").eqNullSafe(F.col("own_conv_id")) & (F.col("part") == F.col("own_part")) & (F.col("piece") == F.col("own_piece"))
    return pieces.join(other, same, how).drop(*(f"own_{k}" for k in keys))


def _marked(pieces: DataFrame) -> DataFrame:
    """Pieces with the rows marked that repeat one of an earlier piece."""
    place = F.struct("part", "piece", "row")
    cells = pieces.select("conv_id", "part", "piece", F.posexplode(F.expr("transform(sequence(0, length(digests) div 16 - 1), i -> substring(digests, i * 16 + 1, 16))")).alias("row", "digest"))
    first = cells.groupBy("conv_id", "digest").agg(F.min(place).alias("first"), F.count("*").alias("n")).filter("n > 1")
    first = first.select(F.col("conv_id").alias("owner"), F.col("digest").alias("seen"), "first")
    again = cells.join(first, F.col("conv_id").eqNullSafe(F.col("owner")) & (F.col("digest") == F.col("seen"))).filter(place > F.col("first"))
    found = again.groupBy("conv_id", "part", "piece").agg(F.collect_list("row").alias("again"))  # at most a piece's rows
    joined = _beside(pieces.drop("digests"), found, "left")

    def mark(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for given in batches:
            codes = []
            for text, rows in zip(given.column("codes").to_pylist(), given.column("again").to_pylist(), strict=True):
                own = np.frombuffer(text, dtype=np.uint8).copy()
                rows = np.array(rows or [], dtype=np.int64)
                rows = rows[(own[rows] & BLANK) == 0]
                own[rows] = own[rows] & 3 | DUPLICATE
                codes.append(own.tobytes())
            at = given.schema.get_field_index("codes")
            yield given.set_column(at, "codes", pa.array(codes, pa.binary())).drop_columns(["again"])

    names = [f for f in PIECE.split(", ") if not f.startswith("digests")]
    return joined.mapInArrow(mark, ", ".join(names))


def _matrices(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for rows in _batches(batches):
        lengths = np.array([len(r["codes"]) for r in rows])
        stops = np.cumsum(lengths)
        sums = _suffix_costs(np.concatenate([r["codes"] for r in rows]), np.repeat(stops, lengths))
        out = [{"conv_id": r["conv_id"], "part": r["part"], "piece": r["piece"], "costs": sums[b].ravel().tolist()} for r, b in zip(rows, (stops - lengths).tolist(), strict=True)]
        yield pa.RecordBatch.from_pylist(out, schema=_schema(COSTS))


PLACE = "conv_id long, part int, piece int, "
COSTS = PLACE + "costs array<long>"
BORDERS = PLACE + "ends array<long>, final int"
WAYS = PLACE + "ends array<long>, audits array<string>"


def _borders(frame: pd.DataFrame) -> pd.DataFrame:
    """Costs behind each piece of one conversation: less than 2**31 / PIECE_ROWS rows."""
    frame = frame.sort_values(["part", "piece"], ignore_index=True)
    ends, out = _ENDS, []
    for costs in frame.costs[::-1]:
        out.append(ends.tolist())
        ends = (np.asarray(costs).reshape(4, 4) + ends).min(axis=1)
    frame = frame.drop(columns="costs")
    frame["ends"] = out[::-1]
    frame["final"] = (np.arange(len(frame)) == len(frame) - 1).astype("int32")
    return frame


def _ways(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Each piece's four audits and the states in which they leave it."""
    for rows in _batches(batches):
        solved = Solved([r["codes"] for r in rows], np.array([r["ends"] for r in rows]), np.array([r["final"] > 0 for r in rows]))
        nodes = [solved.nodes(p) for p in range(4)]
        audits = [solved.audits(x) for x in nodes]
        states = [(solved.exits[x] % 4).tolist() for x in nodes]
        out = [
            {"conv_id": r["conv_id"], "part": r["part"], "piece": r["piece"], "ends": [s[i] for s in states], "audits": [a[i] for a in audits]}
            for i, r in enumerate(rows)
        ]
        yield pa.RecordBatch.from_pylist(out, schema=_schema(WAYS))


def _entries(frame: pd.DataFrame) -> pd.DataFrame:
    """The state in which each piece of one conversation is entered."""
    frame = frame.sort_values(["part", "piece"], ignore_index=True)
    state, out = START, []
    for ends in frame.ends:
        out.append(state)
        state = int(ends[state])
    frame = frame.drop(columns="ends")
    frame["state"] = np.array(out, dtype="int32")
    return frame


def _streamed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Results of conversations whose pieces come in order."""
    schema = _schema(RESULT)
    owner: object = _streamed  # no conversation yet
    sums: dict = {}
    audits: list[str] = []

    def result() -> pa.RecordBatch:
        gaps = 0 if sums["low"] is None else sums["high"] - sums["low"] + 1 - sums["turns"]
        row = {k: sums[k] for k in ("blank", "duplicate", "truncated", "illegal", "cost")}
        row |= {"conv_id": owner, "gaps": gaps, "audit": "".join(audits), "repaired_sha256": sums["hash"].hexdigest()}
        return pa.RecordBatch.from_pylist([row], schema=schema)

    for given in batches:
        for r in given.to_pylist():
            if r["conv_id"] != owner:
                if owner is not _streamed:
                    yield result()
                owner, audits = r["conv_id"], []
                sums = dict.fromkeys(("blank", "duplicate", "truncated", "illegal", "cost", "turns"), 0)
                sums |= {"low": None, "high": None, "last": None, "hash": hashlib.sha256(), "any": False}
            codes = np.frombuffer(r["codes"], dtype=np.uint8)
            for name, n in _faults(codes).items():
                sums[name] += n
            sums["illegal"] += r["illegal"] + (sums["last"] is not None and sums["last"] + r["first"] not in ("su", "ua", "au"))
            sums["last"] = r["last"]
            if r["low"] is not None:
                sums["turns"] += r["turns"] - (sums["high"] == r["low"])
                sums["low"] = r["low"] if sums["low"] is None else sums["low"]
                sums["high"] = r["high"]
            row = 0
            for sign in r["audit"]:
                cut = sign in "KR" and codes[row] & TRUNCATED
                sums["cost"] += {"D": DELETE, "I": INSERT, "K": 0, "R": RELABEL}[sign] + (CUT if cut else 0)
                row += sign != "I"
            audits.append(r["audit"])
            for line in repaired(r["audit"], r["roles"], r["texts"], r["state"]):
                sums["hash"].update((("\n" if sums["any"] else "") + line).encode())
                sums["any"] = True
    if owner is not _streamed:
        yield result()


def long_ones(spark: SparkSession, pieces: DataFrame) -> DataFrame:
    """Results of conversations that are several pieces."""
    pieces = kept(spark, _marked(pieces))
    borders = pieces.select("conv_id", "part", "piece", "codes").mapInArrow(_matrices, COSTS).groupBy("conv_id").applyInPandas(_borders, BORDERS)
    ways = kept(spark, _beside(pieces.select("conv_id", "part", "piece", "codes"), borders).mapInArrow(_ways, WAYS))
    entries = ways.select("conv_id", "part", "piece", "ends").groupBy("conv_id").applyInPandas(_entries, PLACE + "state int")
    entered = _beside(ways.drop("ends"), entries).select("conv_id", "part", "piece", "state", F.col("audits")[F.col("state")].alias("audit"))
    ready = _beside(pieces, entered)
    return ready.repartition("conv_id").sortWithinPartitions("conv_id", "part", "piece").mapInArrow(_streamed, RESULT)


def repairs(spark: SparkSession, conversations: DataFrame, rows: DataFrame, piece_rows: int = PIECE_ROWS) -> DataFrame:
    """The repair of each conversation of the first table, whose rows are those of the second."""
    pieces = kept(spark, pieces_of(rows, piece_rows))
    several = pieces.groupBy("conv_id").agg(F.count("*").alias("n")).filter("n > 1").select(F.col("conv_id").alias("long_id"))
    several = kept(spark, several)
    is_long = F.col("conv_id").eqNullSafe(F.col("long_id"))
    found = whole(pieces.join(several, is_long, "left_anti")).unionAll(long_ones(spark, pieces.join(several, is_long, "left_semi")))
    named = conversations.select(F.col("conv_id").cast("long").alias("id")).distinct()
    none = F.lit(0).cast("long")
    return named.join(found, F.col("id").eqNullSafe(F.col("conv_id")), "left").select(
        F.col("id").alias("conv_id"),
        *(F.coalesce(c, none).alias(c) for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")),
        F.coalesce("audit", F.lit("")).alias("audit"),
        F.coalesce("repaired_sha256", F.lit(hashlib.sha256().hexdigest())).alias("repaired_sha256"),
    )


@query(
    r"""
    WITH RECURSIVE c AS (SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
             hex(encode(coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' '))) AS x FROM conversations),
    h AS (SELECT *, xor(4294967295::UBIGINT, list_reduce(list_prepend(4294967295::UBIGINT, flatten(list_transform(
                range(1, len(x), 2), lambda i: [('0x' || x[i:i + 1])::UBIGINT, 0, 0, 0, 0, 0, 0, 0]))),
              lambda c, b: CASE WHEN xor(c, b) % 2 = 1 THEN xor(xor(c, b) // 2, 3988292384::UBIGINT) ELSE xor(c, b) // 2 END)) % 20 AS m FROM c),
    d AS (SELECT conv_id, turn, CASE m WHEN 4 THEN 'user' ELSE role END AS role,
                 CASE m WHEN 1 THEN '' WHEN 2 THEN translate(text, '.!?', '') ELSE text END AS text,
                 unnest(range(CASE m WHEN 3 THEN 2 ELSE 1 END)) AS copy FROM h WHERE m <> 0),
    o AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text, copy) AS i, substr(role, 1, 1) AS ini,
                 right(rtrim(text, e' \t\n\x0b\x0c\r'), 1) AS final FROM d),
    f AS (SELECT *, lag(ini) OVER (PARTITION BY conv_id ORDER BY i) AS prev, final = '' AS blank,
                 final <> '' AND row_number() OVER (PARTITION BY conv_id, role, text ORDER BY i) > 1 AS dup FROM o),
    r AS (SELECT *, NOT blank AND NOT dup AND final NOT IN ('.', '!', '?') AS cut FROM f),
    a AS (SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, sum(blank::INT)::BIGINT AS blank,
                 sum(dup::INT)::BIGINT AS duplicate, sum(cut::INT)::BIGINT AS truncated,
                 sum((prev IS NOT NULL AND prev || ini NOT IN ('su', 'ua', 'au'))::INT)::BIGINT AS illegal, max(i) AS n FROM r GROUP BY conv_id),
    ins(p, q, k, audit, made) AS (VALUES ('', '', 0, '', []::VARCHAR[]), ('s', 's', 0, '', []), ('u', 'u', 0, '', []), ('a', 'a', 0, '', []),
      ('', 'u', 3, 'I', ['user:']), ('s', 'u', 3, 'I', ['user:']), ('u', 'a', 3, 'I', ['assistant:']), ('a', 'u', 3, 'I', ['user:']),
      ('', 'a', 6, 'II', ['user:', 'assistant:']), ('s', 'a', 6, 'II', ['user:', 'assistant:'])),
    arc(p, kind, q) AS (VALUES ('', 's', 's'), ('', 'u', 'u'), ('s', 'u', 'u'), ('u', 'a', 'a'), ('a', 'u', 'u')),
    fit(p, q, role) AS (VALUES ('', 'u', 'user'), ('s', 'u', 'user'), ('u', 'a', 'assistant'), ('a', 'u', 'user')),
    step AS (
      SELECT conv_id, i, p, p AS q, 4 AS k, 'D' AS audit, []::VARCHAR[] AS made FROM r, (VALUES (''), ('s'), ('u'), ('a')) s(p)
      UNION ALL SELECT conv_id, i, p, q, cut::INT * 3, 'K', [role || ':' || text] FROM r JOIN arc ON kind = ini WHERE NOT blank AND NOT dup
      UNION ALL SELECT conv_id, i, p, q, 3 + cut::INT * 3, 'R', [fit.role || ':' || text] FROM r, fit WHERE NOT blank AND NOT dup),
    way AS (
      SELECT conv_id, 0::BIGINT AS i, '' AS q, {'k': 0::BIGINT, 'audit': ''} AS best, []::VARCHAR[] AS made FROM a
      UNION ALL
      SELECT w.conv_id, w.i + 1, s.q, min({'k': w.best.k + ins.k + s.k, 'audit': w.best.audit || ins.audit || s.audit}),
             arg_min(w.made || ins.made || s.made, {'k': w.best.k + ins.k + s.k, 'audit': w.best.audit || ins.audit || s.audit})
      FROM way w JOIN ins ON ins.p = w.q JOIN step s ON s.conv_id IS NOT DISTINCT FROM w.conv_id AND s.i = w.i + 1 AND s.p = ins.q
      GROUP BY w.conv_id, w.i + 1, s.q),
    done AS (SELECT w.conv_id, min({'k': w.best.k + ins.k, 'audit': w.best.audit || ins.audit}) AS best,
                    arg_min(w.made || ins.made, {'k': w.best.k + ins.k, 'audit': w.best.audit || ins.audit}) AS made
             FROM way w JOIN a ON a.conv_id IS NOT DISTINCT FROM w.conv_id AND a.n = w.i JOIN ins ON ins.p = w.q AND ins.q IN ('', 'a') GROUP BY w.conv_id)
    SELECT c.conv_id, coalesce(gaps, 0) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate, coalesce(truncated, 0) AS truncated,
           coalesce(illegal, 0) AS illegal, coalesce(done.best.k, 0) AS cost, coalesce(done.best.audit, '') AS audit,
           sha256(coalesce(array_to_string(made, chr(10)), '')) AS repaired_sha256
    FROM (SELECT DISTINCT conv_id FROM conversations) c LEFT JOIN a ON a.conv_id IS NOT DISTINCT FROM c.conv_id
    LEFT JOIN done ON done.conv_id IS NOT DISTINCT FROM c.conv_id
    """
)
def op11_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = read(spark, sf_dir, "conversations")
    return repairs(spark, rows, damaged(rows))
