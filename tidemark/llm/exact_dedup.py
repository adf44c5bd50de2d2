"""Exact dedup by most-significant-digit radix partitioning.

A digit is a run of the text's next bytes. Each round splits the open groups by their
next digit; a group closes when it has one member or its text has ended. What is left
open reads on, with longer digits, since the longer two texts agree the likelier they
are copies. Equality is decided by the bytes themselves, no digest is compared.
"""

from __future__ import annotations

from collections.abc import Sequence
from itertools import chain, repeat

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import BLANK, materialise, numbered, sha256_text, whole

# bytes per digit by round; the last width repeats until every group has closed
DIGITS = (48, 512, 4096, 32768, 262144)
_ALL = 2 ** 31 - 1


def normalised(text: Column | str) -> Column:
    """Null as empty, every run of blanks as one space."""
    return F.regexp_replace(whole(text), BLANK, " ")


def _split(rows: DataFrame, width: int) -> DataFrame:
    """One round: groups by digit; what is alone in its group is left out, it has no copy.

    A group whose digit is short has ended, and its members are equal.
    """
    first = F.min(F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "row"))
    # partial sums shrink a hot group before the shuffle. Written, so that the join shuffles both
    # sides anew and a hot digit can be split among tasks
    found = materialise(rows.groupBy("group", "digit").agg(first.alias("first"), F.count("*").alias("members"))
                        .where("members > 1"), "equal-groups")
    both = rows.join(found.hint("merge"), ["group", "digit"])
    return materialise(
        both.withColumn("group", F.col("first.row")).withColumn("keep_id", F.col("first.doc_id"))
        .withColumn("ended", F.octet_length("digit") < width).drop("first", "digit"), "equal-split")


def groups_of_equals(docs: DataFrame, digits: Sequence[int] = DIGITS) -> tuple[DataFrame, DataFrame]:
    """The numbered documents, and a decision for each.

    Decisions are ``row, doc_id, keep_id, group_size, kept, text_sha256``. Of equal texts the
    smallest doc_id stays, null ids last, and of rows with the same id the first read. Null
    texts are empty texts, and those are equal to each other.
    """
    base = numbered(docs, "equal-docs")
    plain = F.encode(normalised("doc.text"), "UTF-8")
    heads = materialise(
        base.select("row", "doc.doc_id", plain.alias("bytes"))
        .select("row", "doc_id", F.substring("bytes", 1, digits[0]).alias("digit"),
                sha256_text(F.col("bytes")).alias("text_sha256")), "equal-heads")
    split = _split(heads.select("row", "doc_id", F.lit(0).cast("long").alias("group"), "digit"), digits[0])
    closed = [split.where("ended").select("row", "group", "keep_id", "members")]
    going = split.where("NOT ended").select("row", "doc_id", "group")
    # what is left of the texts of open groups, fetched once. A merge join at every size: sent
    # to all tasks, the open rows would have to stay small.
    rest = F.substring("bytes", digits[0] + 1, _ALL)
    rows = materialise(base.select("row", plain.alias("bytes")).select("row", rest.alias("rest"))
                       .join(going.hint("merge"), "row"), "equal-open")
    for width in chain(digits[1:], repeat(digits[-1])):
        if rows.isEmpty():
            break
        split = _split(rows.select("row", "doc_id", "group", "rest",
                                   F.substring("rest", 1, width).alias("digit")), width)
        closed.append(split.where("ended").select("row", "group", "keep_id", "members"))
        rows = split.where("NOT ended").select(
            "row", "doc_id", "group", F.substring("rest", width + 1, _ALL).alias("rest"))
    copies = closed[0]
    for more in closed[1:]:
        copies = copies.unionByName(more)
    alone = F.col("group").isNull()
    decided = heads.select("row", "doc_id", "text_sha256").join(copies, "row", "left").select(
        "row", "doc_id",
        F.when(alone, F.col("doc_id")).otherwise(F.col("keep_id")).alias("keep_id"),
        F.coalesce("members", F.lit(1)).cast("long").alias("group_size"),
        (alone | (F.col("row") == F.col("group"))).alias("kept"), "text_sha256")
    return base, decided


def exact_dedup_decisions(docs: DataFrame) -> DataFrame:
    """A row per document: ``doc_id, keep_id, group_size, kept, text_sha256``."""
    return groups_of_equals(docs)[1].drop("row")


def exact_dedup(docs: DataFrame) -> DataFrame:
    """The documents that stay, with all their columns."""
    base, decided = groups_of_equals(docs)
    return base.join(decided.where("kept").select("row"), "row", "left_semi").select("doc.*")
