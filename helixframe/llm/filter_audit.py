"""Filter interaction audit: what each filter removes in each order of the filters, by decision diagrams.

Each document has a failure mask, a bit for each filter that it fails. Documents are counted by part and mask, at most
2 ** filters rows for each part, and one count-weighted decision diagram is built from a part's masks: a level for each
filter, at each node the masks that pass and those that fail it, equal sub-diagrams held once, and at each node the
weights below it (documents, and those of each mark). A new order of the filters comes from the one before by swapping
two adjacent levels, so all orders are visited with one swap each. In an order, the path from the root on which all
filters pass gives its steps: the passing child of a step's node weighs what is kept, the failing one what is removed
here.

What a filter removes as the first of an order is all that fails it, and as the last all that fails it alone; its
Shapley sum adds what it removes in every order.

Defined results: null text is empty; a null part is the empty string; a null id repeats no other text and has no marks;
rows that repeat an id don't repeat each other's text; an id with several rows of marks has a mark if one of them has
it; an empty table gives an empty result; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from helixframe.llm.common import lookup, written

SPACE = r"[\x20\x09-\x0D]+"
LEAST_WORDS, LEAST_DISTINCT, MOST_CAPITALS, SYMBOLS = 200, 50, 2, r"[#$%&*|]"
MARKS = ("quality", "toxic")


class Diagram:
    """A count-weighted decision diagram. A node is 0 for no documents, or a number with (level, passing, failing) and weights.

    `order` has the variable of each level. Leaves stand below the last level; no two nodes have the same children.
    """

    def __init__(self, counts: dict[int, tuple[int, ...]], variables: int) -> None:
        self.order = list(range(variables))
        self.zero = (0,) * len(next(iter(counts.values()), ()))
        self.known: dict[tuple, int] = {}
        self.nodes: list[tuple] = [()]
        self.weights: list[tuple[int, ...]] = [self.zero]
        self.root = self._built(counts, 0)

    def _node(self, key: tuple, weight: tuple[int, ...]) -> int:
        if not any(weight):
            return 0
        if key not in self.known:
            self.known[key] = len(self.nodes)
            self.nodes.append(key)
            self.weights.append(weight)
        return self.known[key]

    def _leaf(self, weight: tuple[int, ...]) -> int:
        return self._node((len(self.order), weight), weight)

    def _inner(self, level: int, passing: int, failing: int) -> int:
        return self._node((level, passing, failing), tuple(a + b for a, b in zip(self.weights[passing], self.weights[failing], strict=True)))

    def _built(self, counts: dict[int, tuple[int, ...]], level: int) -> int:
        if level == len(self.order):
            return self._leaf(tuple(map(sum, zip(*counts.values(), strict=True))) or self.zero)
        sides: tuple[dict, dict] = ({}, {})
        for mask, weight in counts.items():
            sides[mask >> level & 1][mask] = weight
        return self._inner(level, *(self._built(side, level + 1) if side else 0 for side in sides))

    def children(self, node: int) -> tuple[int, int]:
        return self.nodes[node][1:] if node else (0, 0)

    def swap(self, level: int) -> None:
        """Exchanges the variables of a level and the next; the levels below stay as they are."""
        done: dict[int, int] = {}

        def swapped(node: int) -> int:
            if not node or self.nodes[node][0] > level:
                return node
            if node not in done:
                passing, failing = self.children(node)
                if self.nodes[node][0] < level:
                    done[node] = self._inner(self.nodes[node][0], swapped(passing), swapped(failing))
                else:
                    (pp, pf), (fp, ff) = self.children(passing), self.children(failing)
                    done[node] = self._inner(level, self._inner(level + 1, pp, fp), self._inner(level + 1, pf, ff))
            return done[node]

        self.root = swapped(self.root)
        self.order[level], self.order[level + 1] = self.order[level + 1], self.order[level]

    def steps(self) -> list[tuple[int, tuple[int, ...], tuple[int, ...]]]:
        """(variable, weights kept, weights removed) of each level on the path on which all filters pass."""
        out, node = [], self.root
        for variable in self.order:
            node, failing = self.children(node)
            out.append((variable, self.weights[node], self.weights[failing]))
        return out


def adjacent_swaps(n: int) -> Iterator[int]:
    """The places of the swaps that lead from one order of n things through all others: each thing moves through the orders of those before it."""
    if n < 2:
        return
    moves, left = range(n - 1), True
    inner = adjacent_swaps(n - 1)
    while True:
        yield from reversed(moves) if left else moves
        k = next(inner, None)
        if k is None:
            return
        yield k + 1 if left else k
        left = not left


def audited(counts: dict[int, tuple[int, ...]], names: str) -> list[dict]:
    """The rows of one part: counts by mask, the documents first and then those with each mark."""
    diagram, orders = Diagram(counts, len(names)), {}
    orders[tuple(diagram.order)] = diagram.steps()
    for k in adjacent_swaps(len(names)):
        diagram.swap(k)
        orders[tuple(diagram.order)] = diagram.steps()
    failing, alone, shapley = ([0] * len(names) for _ in range(3))
    for steps in orders.values():
        first, last = steps[0], steps[-1]
        failing[first[0]], alone[last[0]] = first[2][0], last[2][0]
        for variable, _, removed in steps:
            shapley[variable] += removed[0]
    return [
        {"filter_order": "".join(names[v] for v in order), "step": k, "kept": kept[0], "removed": removed[0], "redundant": failing[v] - removed[0], "unique_fails": alone[v], "good_lost": removed[1], "toxic_lost": removed[2], "shapley": shapley[v]}
        for order, steps in orders.items()
        for k, (v, kept, removed) in enumerate(steps, 1)
    ]


AUDIT = "part string, filter_order string, step int, kept long, removed long, redundant long, unique_fails long, good_lost long, toxic_lost long, shapley long"


def audit(masks: DataFrame, names: str) -> DataFrame:
    """The steps of all orders of the filters `names`, a letter each, from rows (part, mask, n, good, toxic), bit k for the filter k.

    A part has at most 2 ** len(names) masks and gets len(names)! orders.
    """
    counts = masks.groupBy("part", "mask").agg(F.sum("n").alias("n"), F.sum("good").alias("good"), F.sum("toxic").alias("toxic"))
    parts = counts.groupBy("part").agg(F.collect_list(F.struct("mask", "n", "good", "toxic")).alias("masks"))

    def step(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for part, found in zip(frame["part"], frame["masks"], strict=True):
                rows = audited({r["mask"]: (r["n"], r["good"], r["toxic"]) for r in found}, names)
                yield pd.DataFrame(rows).assign(part=part)[[c.split()[0] for c in AUDIT.split(", ")]]

    return parts.mapInPandas(step, AUDIT)


def failures(text: Column, repeated: Column) -> dict[str, Column]:
    """The filters by letter, each a condition on which a text fails."""
    words = F.array_remove(F.split(text, SPACE), "")
    capitals = F.regexp_count(text, F.lit("[A-Z]"))
    return {
        "A": F.size(words) < LEAST_WORDS,
        "B": 100 * F.size(F.array_distinct(words)) < LEAST_DISTINCT * F.size(words),
        "C": 100 * capitals > MOST_CAPITALS * F.length(text),
        "D": F.regexp_like(text, F.lit(SYMBOLS)),
        "E": repeated,
    }


def failure_masks(docs: DataFrame, labels: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", part_col: str = "source") -> DataFrame:
    """(part, mask, n, good, toxic): documents counted by part and failure mask, bit k for the letter k of ABCDE.

    Texts are read once; what follows runs on ids and 128-bit hashes of texts, counted before they are joined.
    """
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    bits = lambda conditions: sum((c.cast("int") * (1 << k) for k, c in enumerate(conditions)), F.lit(0))
    own = [c for letter, c in failures(text, F.lit(False)).items() if letter != "E"]
    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.coalesce(F.col(part_col).cast("string"), F.lit("")).alias("part"), F.unhex(F.md5(text)).alias("hash"), bits(own).alias("own"))
    rows = written(rows.groupBy("id", "part", "hash", "own").agg(F.count(F.lit(1)).alias("n")), "audit-masks")
    first = rows.filter("id is not null").groupBy("hash").agg(F.min("id").alias("first"), F.max("id").alias("last"), F.count(F.lit(1)).alias("rows")).filter("first < last").drop("last")
    rows = lookup(rows, written(first, "audit-repeats"), "hash", "rows")
    mask = F.col("own") + F.when(F.col("first") < F.col("id"), 16).otherwise(0)
    marks = labels.groupBy(F.col(id_col).cast("long").alias("id")).agg(*(F.max((F.col(m) == 1).cast("int")).alias(m) for m in MARKS)).filter("id is not null")
    by_id = rows.groupBy("id", "part", mask.alias("mask")).agg(F.sum("n").alias("n")).join(marks, "id", "left")
    marked = lambda m: F.sum(F.col("n") * F.coalesce(m, F.lit(0)))
    return by_id.groupBy("part", "mask").agg(F.sum("n").alias("n"), marked("quality").alias("good"), marked("toxic").alias("toxic"))


def audit_documents(docs: DataFrame, labels: DataFrame, **columns) -> DataFrame:
    """The audit of the filters ABCDE over documents."""
    return audit(failure_masks(docs, labels, **columns), "ABCDE")


ORACLE_SQL = r"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS t, coalesce(source, '') AS part FROM documents),
w AS (SELECT *, list_filter(regexp_split_to_array(t, '[\x20\x09-\x0D]+'), lambda x: x <> '') AS ws FROM d),
m AS (SELECT doc_id, part,
  (len(ws) < 200)::INT + 2 * (100 * len(list_distinct(ws)) < 50 * len(ws))::INT
  + 4 * (100 * length(regexp_replace(t, '[^A-Z]', '', 'g')) > 2 * length(t))::INT
  + 8 * regexp_matches(t, '[#$%&*|]')::INT
  + 16 * coalesce(min(doc_id) OVER (PARTITION BY t) < doc_id, false)::INT AS mask FROM w),
l AS (SELECT doc_id, max((quality = 1)::INT) AS good, max((toxic = 1)::INT) AS toxic FROM labels GROUP BY doc_id),
c AS (SELECT part, mask, count(*) AS n, sum(coalesce(good, 0)) AS good, sum(coalesce(toxic, 0)) AS toxic FROM m LEFT JOIN l USING (doc_id) GROUP BY part, mask),
f AS (SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS x, unnest([1, 2, 4, 8, 16]) AS bit),
o AS (SELECT [a.x, b.x, c.x, d.x, e.x] AS xs, [a.bit, b.bit, c.bit, d.bit, e.bit] AS bits FROM f a, f b, f c, f d, f e WHERE len(list_distinct([a.x, b.x, c.x, d.x, e.x])) = 5),
s AS (SELECT array_to_string(xs, '') AS filter_order, k AS step, bits[k] AS bit, coalesce(list_sum(bits[1:k - 1]), 0)::INT AS before FROM o, range(1, 6) r(k)),
r AS (SELECT part, filter_order, step::INT AS step, bit,
  coalesce(sum(n) FILTER (WHERE mask & (before | bit) = 0), 0)::BIGINT AS kept,
  coalesce(sum(n) FILTER (WHERE mask & before = 0 AND mask & bit > 0), 0)::BIGINT AS removed,
  coalesce(sum(n) FILTER (WHERE mask & before > 0 AND mask & bit > 0), 0)::BIGINT AS redundant,
  coalesce(sum(n) FILTER (WHERE mask = bit), 0)::BIGINT AS unique_fails,
  coalesce(sum(good) FILTER (WHERE mask & before = 0 AND mask & bit > 0), 0)::BIGINT AS good_lost,
  coalesce(sum(toxic) FILTER (WHERE mask & before = 0 AND mask & bit > 0), 0)::BIGINT AS toxic_lost
  FROM c, s GROUP BY part, filter_order, step, bit)
SELECT part, filter_order, step, kept, removed, redundant, unique_fails, good_lost, toxic_lost, (sum(removed) OVER (PARTITION BY part, bit))::BIGINT AS shapley FROM r
"""
