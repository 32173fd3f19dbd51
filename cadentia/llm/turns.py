"""Conversation structure repair: turns aligned with ``(s?(ua)+)?`` by least cost (``alignment``).

1. Equal rows of a conversation become one with a number of copies before they move; the first
   turn of each (conversation, role, text) tells copies from originals.
2. Rows are range-partitioned and sorted by conversation and turn, so a long conversation spreads
   over many tasks, and cut into blocks of at most ``ROWS`` turns: codes of the turns, and texts.
3. Every block is aligned for itself, for each state it may be entered and left in. Small cost
   tables are combined from a conversation's end, which gives every block the cost from its exits on.
4. Every block is traced back for the states it may be entered in, in parallel; one ordered pass over
   the blocks of a conversation follows the states and writes the repaired turns.

Only that last pass sees a conversation in one task, a block at a time: a hash over its whole
text can't be taken otherwise.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from cadentia.llm import alignment as A
from cadentia.session import materialise

#: White space of the contract, and what ends a turn.
BLANKS, ENDS = " \t\n\x0b\x0c\r", [".", "!", "?"]
#: Turns of a block, and bytes of its texts beyond which it ends.
ROWS, BYTES = 512, 4 << 20
#: Leading characters of a text that range partitions tell apart, where turns and roles tie.
PREFIX = 64
#: Rows taken from an Arrow batch at once, and blocks given to one.
SLICE, GIVEN = 256, 64

_LEGAL = {"su", "ua", "au"}
_ROLES = {A.USER: "user", A.ASSISTANT: "assistant"}
_ORDER = ["no_conv", "conv", "has_turn", "turn", "role"]
_COUNTS = ["n", "blank", "duplicate", "truncated", "illegal", "turns"]


def _classified(turns: DataFrame, copies: Column) -> DataFrame:
    """One row for all equal ones, with ``copies``, ``code``, ``initial`` and the fault that counts."""
    slim = turns.select(
        F.col("conv_id").isNull().alias("no_conv"),
        F.coalesce("conv_id", F.lit("0").cast(turns.schema["conv_id"].dataType)).alias("conv"),
        F.col("turn").isNotNull().alias("has_turn"),
        F.coalesce("turn", F.lit(0)).cast("long").alias("turn"),
        F.coalesce("role", F.lit(" ")).alias("role"),
        F.coalesce("text", F.lit(" ")).alias("text"),
        copies.cast("long").alias("copies"),
    )
    key = F.unhex(F.sha1("text"))
    rows = slim.groupBy(*_ORDER, key.alias("key")).agg(F.first("text").alias("text"), F.sum("copies").alias("copies"))
    solid = F.rtrim("text", F.lit(BLANKS))
    rows = rows.withColumns({"blank": solid == "", "ended": F.right(solid, F.lit(1)).isin(ENDS), "initial": F.left("role", F.lit(1))})
    seen = rows.filter("not blank and copies > 0").groupBy("no_conv", "conv", "role", "key")
    firsts = seen.agg(F.min(F.struct("has_turn", "turn")).alias("f")).select("no_conv", "conv", "f.has_turn", "f.turn", "role", "key", F.lit(True).alias("first"))
    rows = rows.join(firsts, [*_ORDER, "key"], "left")
    kind = F.when(F.col("initial").isin("s", "u", "a"), F.col("initial")).otherwise("o")
    code = F.when(F.col("blank") | F.col("first").isNull(), A.GONE).when(F.col("ended"), kind).otherwise(F.upper(kind))
    return rows.select(*_ORDER, "text", "copies", "blank", "initial", code.alias("code"))


@dataclass
class _Open:
    """A block while it grows."""

    no_conv: bool
    conv: object
    opens: bool  # no earlier block of the conversation, as far as this task knows
    codes: list[str] = field(default_factory=list)
    roles: list[str | None] = field(default_factory=list)
    texts: list[str | None] = field(default_factory=list)
    size: int = 0
    blank: int = 0
    duplicate: int = 0
    truncated: int = 0
    illegal: int = 0
    turns: int = 0
    first_turn: int | None = None
    last_turn: int | None = None
    first_initial: str | None = None
    last_initial: str | None = None

    def add(self, has_turn: bool, turn: int, role: str, text: str, blank: bool, initial: str, code: str) -> None:
        if self.codes:
            self.illegal += self.last_initial + initial not in _LEGAL
        else:
            self.first_initial = initial
        self.last_initial = initial
        if has_turn:
            if self.last_turn != turn:
                self.turns += 1
            if self.first_turn is None:
                self.first_turn = turn
            self.last_turn = turn
        gone = code == A.GONE
        self.blank += blank
        self.duplicate += gone and not blank
        self.truncated += code.isupper()
        self.codes.append(code)
        self.roles.append(None if gone else role)
        self.texts.append(None if gone else text)
        self.size += 0 if gone else len(text)

    def row(self) -> dict:
        out = {k: getattr(self, k) for k in (*_COUNTS[1:], "no_conv", "conv", "opens", "roles", "texts", *_EDGES)}
        return out | {"n": len(self.codes), "codes": "".join(self.codes)}


_EDGES = ["first_turn", "last_turn", "first_initial", "last_initial"]


def _batches(rows: Iterator[dict], schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    held, size = [], 0
    for row in rows:
        held.append(row)
        texts = row.get("texts") or [turn["text"] for turn in row.get("repaired", ())]
        size += 1 + sum(len(t or "") for t in texts) // (BYTES // GIVEN)
        if size >= GIVEN:
            yield pa.RecordBatch.from_pylist(held, schema)
            held, size = [], 0
    if held:
        yield pa.RecordBatch.from_pylist(held, schema)


def _rows(batches: Iterator[pa.RecordBatch], step: int = SLICE) -> Iterator[dict]:
    for batch in batches:
        for at in range(0, batch.num_rows, step):
            yield from batch.slice(at, step).to_pylist()


def _kinds(turns: DataFrame, column: str = "conv_id") -> tuple[str, pa.DataType]:
    kind = turns.schema[column].dataType
    return kind.simpleString(), to_arrow_type(kind)


def blocks(turns: DataFrame, copies: Column | None = None) -> DataFrame:
    """The blocks of all conversations, in order by ``(part, nth)``, with what their turns count."""
    name, arrow = _kinds(turns)
    rows = _classified(turns, F.lit(1) if copies is None else copies)
    order = [*_ORDER, F.left("text", F.lit(PREFIX))]
    rows = rows.repartitionByRange(*order).sortWithinPartitions(*_ORDER, "text")
    counts = ", ".join(f"{c} long" for c in _COUNTS)
    schema = f"""part int, nth long, no_conv boolean, conv {name}, opens boolean, codes string, roles array<string>,
        texts array<string>, {counts}, first_turn long, last_turn long, first_initial string, last_initial string"""
    fields = [("part", pa.int32()), ("nth", pa.int64()), ("no_conv", pa.bool_()), ("conv", arrow), ("opens", pa.bool_())]
    fields += [("codes", pa.string()), ("roles", pa.list_(pa.string())), ("texts", pa.list_(pa.string()))]
    fields += [(c, pa.int64()) for c in (*_COUNTS, "first_turn", "last_turn")]
    fields += [("first_initial", pa.string()), ("last_initial", pa.string())]

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        part, nth, now = TaskContext.get().partitionId(), 0, None
        for r in _rows(batches):
            if now is None or (now.no_conv, now.conv) != (r["no_conv"], r["conv"]):
                if now:
                    yield now.row() | {"part": part, "nth": nth}
                    nth += 1
                now = _Open(r["no_conv"], r["conv"], opens=nth > 0)
            code = r["code"]
            for _ in range(r["copies"]):
                if len(now.codes) >= ROWS or now.size >= BYTES:
                    yield now.row() | {"part": part, "nth": nth}
                    nth, now = nth + 1, _Open(r["no_conv"], r["conv"], opens=False)
                now.add(r["has_turn"], r["turn"], r["role"], r["text"], r["blank"], r["initial"], code)
                code = A.GONE
        if now:
            yield now.row() | {"part": part, "nth": nth}

    return rows.mapInArrow(lambda batches: _batches(cut(batches), pa.schema(fields)), schema)


def _after(found: DataFrame, name: str, arrow: pa.DataType) -> DataFrame:
    """``part, nth, after``: the least cost from each state a block is left in to its conversation's end."""
    keys = [("part", pa.int32()), ("nth", pa.int64()), ("no_conv", pa.bool_()), ("conv", arrow)]

    def aligned(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        for r in _rows(batches):
            codes = r.pop("codes")
            yield r | {"cost": [c for row in A.costs(codes) for c in row]}

    schema = f"part int, nth long, no_conv boolean, conv {name}, cost array<long>"
    cost = found.select("part", "nth", "no_conv", "conv", "codes").mapInArrow(
        lambda batches: _batches(aligned(batches), pa.schema([*keys, ("cost", pa.list_(pa.int64()))])), schema
    )

    def combined(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        conv, after = None, None
        for r in _rows(batches):
            if conv != (r["no_conv"], r["conv"]):
                conv, after = (r["no_conv"], r["conv"]), list(A.END_COST)
            yield {"part": r["part"], "nth": r["nth"], "after": after}
            after = A.before([r["cost"][i : i + 4] for i in range(0, 16, 4)], after)

    by_end = cost.repartition("no_conv", "conv").sortWithinPartitions("no_conv", "conv", F.desc("part"), F.desc("nth"))
    fields = [*keys[:2], ("after", pa.list_(pa.int64()))]
    return by_end.mapInArrow(lambda batches: _batches(combined(batches), pa.schema(fields)), "part int, nth long, after array<long>")


_TRACED = "audits array<string>, exits array<int>"
_SETTLED = "audit string, cost long, repaired array<struct<role: string, text: string>>"


def settled(turns: DataFrame, copies: Column | None = None) -> DataFrame:
    """The repaired conversations of ``turns(conv_id, turn, role, text)``, a row per block of turns.

    ``no_conv, conv`` name the conversation (a null id is a conversation too), ``part, nth`` order its
    blocks, and a conversation's blocks follow one another in one partition in that order. ``audit``
    has the edits of the block (the last block those at the end too), ``repaired`` the turns it leaves.
    Null roles and texts are one space; turns go by ``turn`` with nulls first, ties by role and text.
    Equal rows are turns of their own; ``copies`` says how many a row stands for, 0 keeps
    just the conversation. Other columns are not looked at. No rows give no rows.
    """
    name, arrow = _kinds(turns)
    found = materialise(blocks(turns, copies), "blocks")
    after = materialise(_after(found, name, arrow), "after")
    base = found.join(after, ["part", "nth"])

    @F.arrow_udf(f"struct<{_TRACED.replace(' array', ': array')}>")
    def traced(codes: pa.Array, opens: pa.Array, after: pa.Array) -> pa.Array:
        out = []
        for c, o, a in zip(codes.to_pylist(), opens.to_pylist(), after.to_pylist(), strict=True):
            ways = [A.audit(c, entry, a) if entry == A.START or not o else (None, None) for entry in range(4)]
            out.append({"audits": [w[0] for w in ways], "exits": [w[1] for w in ways]})
        return pa.array(out, pa.struct([("audits", pa.list_(pa.string())), ("exits", pa.list_(pa.int32()))]))

    base = base.withColumn("traced", traced("codes", "opens", "after")).select("*", "traced.*").drop("traced", "after")
    ordered = base.repartition("no_conv", "conv").sortWithinPartitions("no_conv", "conv", "part", "nth")

    def followed(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        held, conv, state = None, None, A.START

        def close(row: dict) -> dict:
            for role in [_ROLES[A.USER], _ROLES[A.ASSISTANT]][2 - len(A.END_AUDIT[state]) :]:
                row["repaired"].append({"role": role, "text": ""})
            return row | {"audit": row["audit"] + A.END_AUDIT[state], "cost": row["cost"] + A.END_COST[state]}

        for r in _rows(batches, 16):
            if held and conv != (r["no_conv"], r["conv"]):
                held = close(held)
            if held:
                yield held
            if conv != (r["no_conv"], r["conv"]):
                conv, state = (r["no_conv"], r["conv"]), A.START
            audit, left = r.pop("audits")[state], r.pop("exits")[state]
            held = _applied(r, audit, state)
            state = left
        if held:
            yield close(held)

    kept = ["part", "nth", "no_conv", "conv", *_COUNTS, *_EDGES]
    schema = ", ".join(f"{c} {t}" for c, t in ordered.dtypes if c in kept) + ", " + _SETTLED
    turn = pa.struct([("role", pa.string()), ("text", pa.string())])
    fields = {"part": pa.int32(), "nth": pa.int64(), "no_conv": pa.bool_(), "conv": arrow}
    fields |= {c: pa.int64() for c in (*_COUNTS, "first_turn", "last_turn")} | {c: pa.string() for c in ("first_initial", "last_initial")}
    own = pa.schema([(c, fields[c]) for c, _ in ordered.dtypes if c in kept] + [("audit", pa.string()), ("cost", pa.int64()), ("repaired", pa.list_(turn))])
    return ordered.mapInArrow(lambda batches: _batches(followed(batches), own), schema)


def _applied(block: dict, audit: str, state: int) -> dict:
    """The block with the turns that its audit leaves, and what the edits cost."""
    codes, roles, texts = block.pop("codes"), block.pop("roles"), block.pop("texts")
    out, cost, at = [], 0, 0
    for edit in audit:
        wanted = A.ASSISTANT if state == A.USER else A.USER
        if edit == "I":
            out.append({"role": _ROLES[wanted], "text": ""})
            cost, state = cost + A.INSERT, wanted
            continue
        if edit == "D":
            cost += A.DELETE
        else:
            cost += A.UNENDED * codes[at].isupper() + A.REROLE * (edit == "R")
            out.append({"role": _ROLES[wanted] if edit == "R" else roles[at], "text": texts[at]})
            state = A.SYSTEM if edit == "K" and state == A.START and codes[at] in "sS" else wanted
        at += 1
    return block | {"audit": audit, "cost": cost, "repaired": out}


def repaired_turns(found: DataFrame) -> DataFrame:
    """``conv_id, part, nth, at, role, text`` of every turn of ``settled`` conversations; ``part, nth, at`` order them."""
    each = found.select(_conv_id(), "part", "nth", F.posexplode("repaired").alias("at", "turn"))
    return each.select("conv_id", "part", "nth", "at", "turn.role", "turn.text")


def _conv_id() -> Column:
    return F.when(~F.col("no_conv"), F.col("conv")).alias("conv_id")


def conversations(found: DataFrame) -> DataFrame:
    """One row for each of ``settled`` conversations: faults, cost, audit and hash of the repaired turns.

    Reads the blocks where they lie, in their order; a conversation's audit is a value as long as its turns.
    """
    name, arrow = _kinds(found, "conv")
    sums = ["blank", "duplicate", "truncated", "illegal", "cost"]

    def summed(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        now: dict = {}
        for r in _rows(batches, 16):
            if not now or (now["no_conv"], now["conv"]) != (r["no_conv"], r["conv"]):
                if now:
                    yield ended(now)
                now = {"no_conv": r["no_conv"], "conv": r["conv"], "audit": [], "hash": hashlib.sha256(), "lines": 0}
                now |= dict.fromkeys(sums, 0) | {"turns": 0, "low": None, "high": None, "initial": None}
            for c in sums:
                now[c] += r[c]
            if r["n"]:
                if now["initial"] is not None:
                    now["illegal"] += now["initial"] + r["first_initial"] not in _LEGAL
                now["initial"] = r["last_initial"]
            if r["first_turn"] is not None:
                now["turns"] += r["turns"] - (now["high"] == r["first_turn"])
                now["low"] = r["first_turn"] if now["low"] is None else now["low"]
                now["high"] = r["last_turn"]
            now["audit"].append(r["audit"])
            for turn in r["repaired"]:
                now["hash"].update(f"{chr(10) if now['lines'] else ''}{turn['role']}:{turn['text']}".encode("utf-8", "surrogatepass"))
                now["lines"] += 1
        if now:
            yield ended(now)

    def ended(now: dict) -> dict:
        gaps = 0 if now["low"] is None else now["high"] - now["low"] + 1 - now["turns"]
        return now | {"gaps": gaps, "audit": "".join(now["audit"]), "repaired_sha256": now["hash"].hexdigest()}

    out = ["gaps", *sums]
    schema = f"no_conv boolean, conv {name}, {', '.join(f'{c} long' for c in out)}, audit string, repaired_sha256 string"
    fields = [("no_conv", pa.bool_()), ("conv", arrow), *((c, pa.int64()) for c in out), ("audit", pa.string()), ("repaired_sha256", pa.string())]

    def batches_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = [f[0] for f in fields]
        return _batches(({k: r[k] for k in names} for r in summed(batches)), pa.schema(fields))

    whole = found.mapInArrow(batches_of, schema)
    return whole.select(_conv_id(), *out, "audit", "repaired_sha256")


def damaged(turns: DataFrame) -> tuple[DataFrame, Column]:
    """The contract's damage to ``turns``, and how often each row of it then stands there.

    A row that the damage drops stays without role and text, 0 times, so its conversation is not lost.
    """
    part = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    slim = turns.select("conv_id", "turn", F.coalesce("role", F.lit(" ")).alias("role"), F.coalesce("text", F.lit(" ")).alias("text"))
    kind = F.crc32(F.concat(part("conv_id"), F.lit(":"), part("turn")).cast("binary")) % 20
    text = F.when(F.col("kind").isin(0, 1), "").when(F.col("kind") == 2, F.regexp_replace("text", "[.!?]", "")).otherwise(F.col("text"))
    role = F.when(F.col("kind") == 0, "").when(F.col("kind") == 4, "user").otherwise(F.col("role"))
    turn = F.when(F.col("kind") != 0, F.col("turn"))
    copies = F.when(F.col("kind") == 0, 0).when(F.col("kind") == 3, 2).otherwise(1)
    out = slim.withColumn("kind", kind).select("conv_id", turn.alias("turn"), role.alias("role"), text.alias("text"), copies.alias("copies"))
    return out, F.col("copies")


def op12_turn_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows, copies = damaged(spark.read.parquet(f"{sf_dir}/conversations.parquet"))
    return conversations(settled(rows, copies))
