"""Mixing sources to target weights by weighted fair queueing (Demers, Keshav and Shenker, 1989), in DataFrame expressions.

Each source shuffles its documents by the MD5 of their keys and offers them up to ``passes`` times, pass after pass. A copy's virtual
finish time is the words its source has handed out by then, divided by the source's target. All copies stand in one order by finish time, and
the mix ends where its running total comes nearest to the budget, so every source is about one document off its target at most.

Rules: a null or blank text has no words: it stays in ``documents()`` and is in no mix. A null source is a source of its own, the last one.
Rows with equal keys, repeated rows too, count one by one, ordered by size and place in the input. Sources whose documents have no words have target 0.
An empty table gives empty frames. Columns of the input beyond key, text and source are not read.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from snapbook.llm.shared import cut

PASSES = 3
WEIGHTS = (1, 2, 3)
SALT = "mix"

SPACE, WORD = r"[\x20\x09-\x0D]", r"[^\x20\x09-\x0D]"


def count_words(text: Column) -> Column:
    """Words of a text: each one, with the white space around it, becomes a single letter; blank texts have none."""
    letters = F.regexp_replace(F.coalesce(text, F.lit("")), f"{SPACE}*{WORD}+{SPACE}*", "w")
    return F.when(letters.startswith("w"), F.octet_length(letters)).otherwise(F.lit(0)).cast("long")


def running_totals(df: DataFrame, order: Sequence[Column], totals: dict[str, str]) -> DataFrame:
    """Add, for each column of ``totals``, its sum up to and with each row over a total order, without gathering the rows in one task.

    Range partitions are written to the shared folder; a row's total is the sum of the partitions before its own plus the sum inside it. Only the
    partitions' sums, one row each, meet in one task.
    """
    placed = cut(df.repartitionByRange(*order).withColumn("_part", F.spark_partition_id()))
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    sums = placed.groupBy("_part").agg(*(F.sum(c).alias(c) for c in totals))
    offsets = sums.select("_part", *(F.coalesce(F.sum(c).over(before), F.lit(0)).alias(f"_before_{c}") for c in totals))
    inside = Window.partitionBy("_part").orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    rows = placed.withColumns({f"_inside_{c}": F.sum(c).over(inside) for c in totals})
    return rows.join(F.broadcast(offsets), "_part").select(
        *df.columns, *((F.col(f"_before_{c}") + F.col(f"_inside_{c}")).alias(name) for c, name in totals.items())
    )


def source_targets(sizes: DataFrame, budget: int, weights: Sequence[int] = WEIGHTS, passes: int = PASSES) -> DataFrame:
    """``source, source_size, number, before, target`` from ``source, source_size``; ``before`` is the size of all sources in front.

    Sources in code point order, null last, take the weights in turn and share the budget by them. A target stops at ``passes`` times its
    source's size and the excess is shared again until none is above. In the order of size by weight the stopped sources come first, so one
    pair of running totals decides all of them.
    """
    counted = running_totals(sizes.withColumn("_one", F.lit(1).cast("long")), [F.col("source").asc_nulls_last()], {"_one": "number", "source_size": "_ends"})
    weight = F.element_at(F.array(*(F.lit(w).cast("long") for w in weights)), ((F.col("number") - 1) % len(weights) + 1).cast("int"))
    weighed = counted.withColumns({"before": F.col("_ends") - F.col("source_size"), "_weight": weight, "_most": F.col("source_size") * passes})
    order = [(F.col("_most") / F.col("_weight")).asc(), F.col("number").asc()]
    weighed = cut(running_totals(weighed, order, {"_most": "_most_to", "_weight": "_weight_to"}))
    exact = lambda c: c.cast("decimal(19,0)")
    whole = weighed.agg(F.coalesce(F.sum("_weight"), F.lit(0))).first()[0]
    # What is left for this source and the ones behind it, and their weights: a share above its most stops there.
    left, rest = F.lit(budget) - F.col("_most_to") + F.col("_most"), F.lit(whole) - F.col("_weight_to") + F.col("_weight")
    judged = weighed.withColumn("_stops", exact(F.col("_most")) * exact(rest) <= exact(left) * exact(F.col("_weight")))
    spent, open_weight = judged.agg(
        F.coalesce(F.sum(F.when(F.col("_stops"), F.col("_most"))), F.lit(0)), F.coalesce(F.sum(F.when(~F.col("_stops"), F.col("_weight"))), F.lit(0))
    ).first()
    share = (exact(F.lit(budget - spent)) * exact(F.col("_weight"))).cast("double") / F.lit(float(open_weight))
    target = F.when(F.col("_stops"), F.col("_most").cast("double")).otherwise(share)
    return judged.select("source", "source_size", "number", "before", target.alias("target"))


class Mix:
    """A mix of the rows of ``docs``. ``budget`` is in words; all words of the input unless given."""

    def __init__(self, docs: DataFrame, key: str = "doc_id", text: str = "text", source: str = "source", budget: int | None = None,
                 weights: Sequence[int] = WEIGHTS, passes: int = PASSES, salt: str = SALT) -> None:
        if passes < 1 or not weights or min(weights) < 1:
            raise ValueError("weights and passes must be at least 1")
        self.passes = passes
        named = docs.select(F.col(f"`{key}`").alias("doc_id"), F.col(f"`{text}`").alias("_text"), F.col(f"`{source}`").alias("source"))
        sized = cut(named.select("doc_id", "source", count_words(F.col("_text")).alias("size")))
        sizes = cut(sized.groupBy("source").agg(F.sum("size").alias("source_size")))
        self.total = sizes.agg(F.coalesce(F.sum("source_size"), F.lit(0))).first()[0]
        self.budget = self.total if budget is None else min(budget, passes * self.total)
        self.sources = cut(source_targets(sizes, self.budget, weights, passes))
        shuffled = F.md5(F.concat_ws(":", F.lit(salt), F.col("doc_id").cast("string")).cast("binary"))
        placed = sized.withColumnRenamed("source", "_source").withColumns({"_mixed": shuffled, "_position": F.monotonically_increasing_id()})
        joined = placed.join(self.sources, F.col("_source").eqNullSafe(F.col("source"))).drop("_source")
        order = [F.col("number").asc(), F.col("_mixed").asc(), F.col("doc_id").asc_nulls_first(), F.col("size").asc(), F.col("_position").asc()]
        # The running total goes on from source to source; a source's own begins where the ones before it end.
        summed = running_totals(joined, order, {"size": "_to"}).withColumn("_to", F.col("_to") - F.col("before"))
        self.offers = cut(summed.select("doc_id", "source", "size", "source_size", "number", "target", "_to"))
        self.end = self._last()

    def _finish(self, to: Column) -> Column:
        return to.cast("double") / F.col("target")

    def _copies(self) -> DataFrame:
        """Every copy on offer with its finish time and the words handed out with all copies before it."""
        turns = F.explode(F.sequence(F.lit(0), F.lit(self.passes - 1)))
        rows = self.offers.filter("size > 0 and target > 0").withColumn("turn", turns)
        rows = rows.withColumn("_to", F.col("_to") + F.col("turn") * F.col("source_size"))
        rows = rows.select("doc_id", "source", "size", "turn", self._finish(F.col("_to")).alias("finish"), "number", F.col("_to").alias("handed"))
        return running_totals(rows, [F.col("finish").asc(), F.col("number").asc(), F.col("handed").asc()], {"size": "position"})

    def _last(self):
        """The place in the order of the last copy in the mix: the one whose middle still lies within the budget."""
        self.copies = self._copies()
        inside = self.copies.filter(2 * F.col("position") - F.col("size") <= F.lit(2 * self.budget))
        return inside.agg(F.max(F.struct("finish", "number", "handed")).alias("last")).first()["last"]

    def _taken(self, finish: Column, number: Column, handed: Column) -> Column:
        if self.end is None:
            return F.lit(False)
        last = F.struct(F.lit(self.end["finish"]).alias("finish"), F.lit(self.end["number"]).cast("long").alias("number"), F.lit(self.end["handed"]).cast("long").alias("handed"))
        return F.struct(finish.alias("finish"), number.cast("long").alias("number"), handed.cast("long").alias("handed")) <= last

    def schedule(self) -> DataFrame:
        """``doc_id, source, size, turn, finish, position``: the copies of the mix; sorted by ``position`` (words before a copy) they are its order."""
        rows = self.copies.filter(self._taken(F.col("finish"), F.col("number"), F.col("handed")))
        return rows.select("doc_id", "source", "size", "turn", "finish", (F.col("position") - F.col("size")).alias("position"))

    def documents(self) -> DataFrame:
        """One row per document with its source's size and target and the words the mix takes of it; narrow, for the end is one place."""
        times = F.lit(0)
        for turn in range(self.passes):
            to = F.col("_to") + turn * F.col("source_size")
            times = times + F.when((F.col("target") > 0) & self._taken(self._finish(to), F.col("number"), to), 1).otherwise(0)
        return self.offers.select("doc_id", "source", "size", "source_size", "target", (F.col("size") * times).cast("long").alias("taken"))
