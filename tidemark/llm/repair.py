"""Repair of conversations: the cheapest edits that make the roles of each one well formed.

Rows are sorted by conversation and turn over all tasks, so that a long conversation lies in many, and
are numbered in that order. Stretches of up to ``STRETCH`` rows of one conversation give a transfer
matrix each (``repair_grammar``); those of a conversation are multiplied in order, and the edits chosen
go back to the rows. Texts are only moved for the rows that stay.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm import repair_grammar as g
from tidemark.llm.common import materialise

STRETCH_BITS = 10                       # rows of a stretch: 1,024
TOGETHER = 100_000                      # symbols that one grammar is made of
BLANKS = " \t\n\x0b\x0c\r"
HEAD = 32                               # characters that order rows of one turn and role


class Repaired(NamedTuple):
    """``conversations``: a row each; ``rows``: what stays, with ``stretch, place`` as its order."""

    conversations: DataFrame
    rows: DataFrame


def _short_digest(c: Column) -> Column:
    return F.substring(F.unhex(F.sha2(c, 256)), 1, 16)


def _text(c: Column) -> Column:
    return F.coalesce(c.cast("string"), F.lit(" "))


def _facts(turns: DataFrame) -> DataFrame:
    role, text = _text(turns["role"]), _text(turns["text"])
    # lengths keep the parts of what is hashed apart
    said = F.concat(F.length(role).cast("string"), F.lit(":"), role, text)
    where = [F.concat(F.coalesce(F.length(c.cast("string")).cast("string"), F.lit("-")), F.lit(":"),
                      F.coalesce(c.cast("string"), F.lit(""))) for c in (turns["conv_id"], turns["turn"])]
    trimmed = F.rtrim(text, F.lit(BLANKS))
    initial = F.instr(F.lit(g.CLASSES[:3]), F.substring(role, 1, 1))
    kind = F.when((F.length(role) > 0) & (initial > 0), initial - 1).otherwise(len(g.CLASSES) - 1)
    fault = (F.when(trimmed == "", g.MUST_GO).when(F.right(trimmed, F.lit(1)).isin(".", "!", "?"), g.SOUND)
             .otherwise(g.CUT_SHORT))
    return turns.select(
        turns["conv_id"].alias("conv_id"), turns["turn"].cast("long").alias("turn"), role.alias("role"),
        F.substring(text, 1, HEAD).alias("head"), (kind * 3 + fault).cast("int").alias("symbol"),
        _short_digest(said).alias("said"), _short_digest(F.concat(*where, said)).alias("identity"), text.alias("text"))


def _stretch_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    grammar = g.Grammar()
    for batch in batches:
        done, waiting, size = 0, [], 0
        for at in range(batch.num_rows):
            waiting.append(_stretch(batch.column(2)[at].as_py()))
            size += len(waiting[-1]["symbols"])
            if size >= TOGETHER or at == batch.num_rows - 1:
                matrices = grammar.solve([[ord(c) - 65 for c in w.pop("solve")] for w in waiting])
                for w, matrix in zip(waiting, matrices, strict=True):
                    w["costs"] = [None if e is None else e[0] for e in matrix]
                    w["edits"] = [None if e is None else g.letters(e[1]) for e in matrix]
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(done, len(waiting)), batch.column(1).slice(done, len(waiting)),
                     pa.array(waiting, _STRETCH_ARROW)], names=["conv_id", "stretch", "found"])
                done, waiting, size = at + 1, [], 0


_COUNTS = ("blank", "duplicate", "truncated", "illegal", "turns")
_STRETCH_ARROW = pa.struct(
    [("symbols", pa.string()), ("first_at", pa.int64()), ("first_turn", pa.int64()), ("last_turn", pa.int64()),
     *[(c, pa.int64()) for c in _COUNTS], ("costs", pa.list_(pa.int64())), ("edits", pa.list_(pa.string()))])
_STRETCH_SCHEMA = ("struct<symbols string, first_at long, first_turn long, last_turn long, "
                   + ", ".join(f"{c} long" for c in _COUNTS) + ", costs array<long>, edits array<string>>")


def _legal(a: str, b: str) -> bool:
    return (g.CLASSES[(ord(a) - 65) // 3] + g.CLASSES[(ord(b) - 65) // 3]) in ("su", "ua", "au")


def _stretch(members: list[dict]) -> dict:
    """Faults of a stretch's rows and their symbols. Members without a symbol mark first occurrences."""
    first = {m["at"] for m in members if m["symbol"] is None}
    rows = sorted(((m["at"], m["symbol"], m["turn"]) for m in members if m["symbol"] is not None), key=lambda r: r[0])
    out = dict.fromkeys(_COUNTS, 0)
    plain, solve, last = [], [], None
    for at, symbol, turn in rows:
        plain.append(chr(65 + symbol))
        if symbol % 3 == g.MUST_GO:
            out["blank"] += 1
        elif at not in first:
            out["duplicate"] += 1
            symbol += g.MUST_GO - symbol % 3
        elif symbol % 3 == g.CUT_SHORT:
            out["truncated"] += 1
        solve.append(chr(65 + symbol))
        if turn is not None and turn != last:
            out["turns"] += 1
            last = turn
    known = [r[2] for r in rows if r[2] is not None]
    out["illegal"] = sum(not _legal(a, b) for a, b in zip(plain, plain[1:], strict=False))
    return out | {"symbols": "".join(plain), "solve": "".join(solve), "first_at": rows[0][0],
                  "first_turn": known[0] if known else None, "last_turn": known[-1] if known else None}


class _Conversation:
    """Stretches of one conversation, taken in order."""

    def __init__(self):
        self.counts = dict.fromkeys(_COUNTS, 0)
        self.first_turn = self.last_turn = self.last_symbol = None
        self.row: list[g.Entry] = [(0, ""), None, None, None]
        self.past: list[tuple[int, int, str, list[int], list[str | None]]] = []

    def add(self, stretch: int, found: dict) -> None:
        for c in _COUNTS:
            self.counts[c] += found[c]
        if self.last_symbol is not None and not _legal(self.last_symbol, found["symbols"][0]):
            self.counts["illegal"] += 1
        if found["first_turn"] is not None:
            self.counts["turns"] -= found["first_turn"] == self.last_turn
            self.first_turn = found["first_turn"] if self.first_turn is None else self.first_turn
            self.last_turn = found["last_turn"]
        self.last_symbol = found["symbols"][-1]
        matrix = [None if c is None else (c, e) for c, e in zip(found["costs"], found["edits"], strict=True)]
        self.row, origin = g.step(self.row, matrix)
        used = [matrix[k * g.STATES + j][1] if k >= 0 else None for j, k in enumerate(origin)]
        self.past.append((stretch, found["first_at"], found["symbols"], origin, used))

    def result(self) -> tuple[dict, list[tuple]]:
        """The summary, and (stretch, place, edit, row number or None, new role or None) of what stays."""
        cost, rope, state = g.closed(self.row)
        audit, pieces, end = g.letters(rope), [], state
        for *_, origin, used in reversed(self.past):
            pieces.append(used[end])
            end = origin[end]
        pieces.reverse()
        pieces[-1] += audit[sum(map(len, pieces)):]         # the inserts that close the conversation
        rows, state = [], 0
        for (stretch, first_at, symbols, *_), piece in zip(self.past, pieces, strict=True):
            left, state = g.lines(piece, symbols, state)
            rows += [(stretch, place, edit, None if row is None else first_at + row, role)
                     for place, edit, row, role in left]
        spread = 0 if self.first_turn is None else self.last_turn - self.first_turn + 1 - self.counts["turns"]
        summary = {c: self.counts[c] for c in _COUNTS[:4]}
        return summary | {"gaps": spread, "cost": cost, "audit": audit}, rows


_SUMMARY_ARROW = pa.struct([(c, pa.int64()) for c in ("gaps", *_COUNTS[:4], "cost")] + [("audit", pa.string())])
_DECIDED_SCHEMA = ("summary struct<" + ", ".join(f"{c}: long" for c in ("gaps", *_COUNTS[:4], "cost"))
                   + ", audit: string>, stretch long, place long, edit string, at long, role string")
_FLUSH = 50_000                         # rows of an output batch, unless one conversation has more


def _decide_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Batches sorted by conversation and stretch; a conversation may go on in the next batch."""
    keys, rows = [], []
    key, now, key_type = None, None, None

    def ended() -> None:
        if now is not None:
            summary, left = now.result()
            rows.append((summary, None, None, None, None, None))
            rows.extend((None, *r) for r in left)
            keys.extend([key] * (len(left) + 1))

    def batch_of() -> pa.RecordBatch:
        columns = list(zip(*rows, strict=True)) if rows else [()] * 6
        types = (_SUMMARY_ARROW, pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string())
        arrays = [pa.array(c, t) for c, t in zip(columns, types, strict=True)]
        out = pa.RecordBatch.from_arrays([pa.array(keys, key_type), *arrays], names=[
            "conv_id", "summary", "stretch", "place", "edit", "at", "role"])
        keys.clear()
        rows.clear()
        return out

    for batch in batches:
        key_type = batch.schema.field(0).type
        for conv_id, stretch, found in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(),
                                           batch.column(2), strict=True):
            if now is None or conv_id != key:
                ended()
                key, now = conv_id, _Conversation()
                if len(rows) >= _FLUSH:
                    yield batch_of()
            now.add(stretch, found.as_py())
    ended()
    if rows:
        yield batch_of()


def repair(turns: DataFrame) -> Repaired:
    """The cheapest edits of each conversation, from rows ``conv_id, turn, role, text``.

    ``conversations``: ``conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit`` of every
    conversation; ``audit`` has a letter for each edit (K keep, R rerole, D delete, I insert), the least
    of the cheapest ones. ``rows``: ``conv_id, stretch, place, edit, role, text`` of each row after the
    edits, to be read in order of stretch and place; a row deleted has none.

    Null roles and texts count as one space; null ids are one conversation, null turns come first
    and leave no gap. An empty role, like any other whose first letter is not s, u or a, cannot
    stay. Rows of one turn go by role, first 32 characters and a digest; repeated rows are
    duplicates but for one. Columns other than the four are not read. No rows give no conversations.

    A conversation may have any number of rows. A task holds one row per stretch of 1,024 of its rows
    and a few bytes a row for the choices, as its audit does. Texts are told apart by 128 bits of SHA-256.
    """
    facts = _facts(turns)
    order = ["conv_id", "turn", "role", "head", "said", "salt"]
    sorted_rows = (facts.select("conv_id", "turn", "role", "head", "symbol", "said", "identity",
                                F.monotonically_increasing_id().alias("salt"))     # spreads equal rows
                   .repartitionByRange(*order).sortWithinPartitions(*order)
                   .select("conv_id", "turn", "symbol", "said", "identity", F.monotonically_increasing_id().alias("at")))
    numbered = materialise(sorted_rows, "conversation-rows")
    firsts = (numbered.where(F.col("symbol") % 3 != g.MUST_GO).groupBy("conv_id", "said")
              .agg(F.min("at").alias("at")))
    members = numbered.select("conv_id", "at", "symbol", "turn").unionByName(
        firsts.select("conv_id", "at", F.lit(None).cast("int").alias("symbol"), F.lit(None).cast("long").alias("turn")))
    stretches = members.groupBy("conv_id", F.shiftright("at", STRETCH_BITS).alias("stretch")).agg(
        F.collect_list(F.struct("at", "symbol", "turn")).alias("members"))
    key = turns.schema["conv_id"].dataType.simpleString()
    solved = stretches.mapInArrow(_stretch_batches, f"conv_id {key}, stretch long, found {_STRETCH_SCHEMA}")
    decided = materialise(
        solved.repartition("conv_id").sortWithinPartitions("conv_id", "stretch")
        .mapInArrow(_decide_batches, f"conv_id {key}, {_DECIDED_SCHEMA}"), "conversation-edits")
    conversations = decided.where(F.col("summary").isNotNull()).select("conv_id", "summary.*")
    left = decided.where(F.col("summary").isNull()).drop("summary")
    stays = left.where(F.col("at").isNotNull()).join(numbered.select("at", "identity"), "at")
    texts = (facts.where(F.col("symbol") % 3 != g.MUST_GO).groupBy("identity")
             .agg(F.first(F.struct("role", "text")).alias("row")))
    kept = stays.join(texts, "identity").select(
        "conv_id", "stretch", "place", "edit", F.coalesce("role", "row.role").alias("role"), "row.text")
    added = left.where(F.col("at").isNull()).select(
        "conv_id", "stretch", "place", "edit", "role", F.lit("").alias("text"))
    return Repaired(conversations, kept.unionByName(added))


def damaged(turns: DataFrame) -> DataFrame:
    """A test bed: rows of ``turns`` damaged by a checksum of id and turn, nulls as one space.

    Of 20 rows one is dropped, one emptied, one loses its ends of sentences, one is repeated and one
    becomes the user's.
    """
    draw = F.crc32(F.concat(_text(turns["conv_id"]), F.lit(":"), _text(turns["turn"]))) % 20
    rows = turns.select("conv_id", "turn", _text(turns["role"]).alias("role"), _text(turns["text"]).alias("text"),
                        draw.alias("draw")).where("draw <> 0")
    return rows.select(
        "conv_id", "turn", F.when(F.col("draw") == 4, "user").otherwise(F.col("role")).alias("role"),
        F.when(F.col("draw") == 1, "").when(F.col("draw") == 2, F.translate("text", ".!?", ""))
        .otherwise(F.col("text")).alias("text"),
        F.explode(F.array_repeat(F.lit(1), F.when(F.col("draw") == 3, 2).otherwise(1))).alias("copy")).drop("copy")


def digest(ids: DataFrame, repaired: Repaired) -> DataFrame:
    """One row per conversation of ``ids``: its counts, edits, and a digest of what it has become.

    Conversations without rows have zeros. The whole repaired text of a conversation comes together in
    one row, as its digest must read it in order.
    """
    none = F.lit(None)
    counts = ("gaps", *_COUNTS[:4], "cost")
    lines = repaired.rows.groupBy("conv_id").agg(F.sort_array(F.collect_list(F.struct(
        "stretch", "place", F.concat("role", F.lit(":"), "text").alias("line")))).alias("lines"))
    hashed = lines.select("conv_id", *[none.cast("long").alias(c) for c in counts], none.cast("string").alias("audit"),
                          F.sha2(F.array_join(F.col("lines.line"), "\n"), 256).alias("hashed"))
    found = repaired.conversations.withColumn("hashed", none.cast("string"))
    known = ids.select("conv_id", *[none.cast("long").alias(c) for c in counts],
                       none.cast("string").alias("audit"), none.cast("string").alias("hashed"))
    together = known.unionByName(found).unionByName(hashed).groupBy("conv_id").agg(
        *[F.coalesce(F.max(c), F.lit(0)).cast("long").alias(c) for c in counts],
        F.coalesce(F.max("audit"), F.lit("")).alias("audit"),
        F.coalesce(F.max("hashed"), F.sha2(F.lit(""), 256)).alias("repaired_sha256"))
    return together
