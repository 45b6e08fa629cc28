"""Mixing sources to target weights by min-cost flow.

Documents may belong to several sources. Those with the same set of sources
form a pattern; the flow routes words from patterns to source quotas. Taking a
pattern once costs less than taking it twice, and so on: the repetition costs
are convex and depend on the round alone, so the cheapest flow is the one that
uses up each round before it opens the next, each by augmenting paths that may
reroute what was sent before. Then seeded documents fill each pattern's share.
"""

from __future__ import annotations

import json
from collections import deque
from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from heddle.llm.shared import stored
from heddle.sources import read_table

WORD = r"[^\x20\x09-\x0D]+"
SHARE, MOST = 1.5, 2
WEIGHTS = (5, 2, 1)
SEED = 20240601
BROADCAST = 50_000  # rows, of a few dozen bytes each
BITS = 10  # of the order's digest, for each of two levels of cells


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def source_targets(sizes: Sequence[int], weights: Sequence[float], share: float = SHARE, most: float = MOST) -> list[float]:
    """Weighted shares of ``share`` x all sizes; what exceeds ``most`` x a size goes to the others by weight."""
    out = [0.0] * len(sizes)
    left, rest = share * sum(sizes), [i for i, n in enumerate(sizes) if n > 0]
    while rest:
        rate = left / sum(weights[i] for i in rest)
        over = [i for i in rest if weights[i] * rate > most * sizes[i]]
        if not over:
            for i in rest:
                out[i] = weights[i] * rate
            break
        for i in over:
            out[i] = float(most * sizes[i])
            left -= out[i]
        rest = [i for i in rest if i not in set(over)]
    return out


class Flow:
    """Maximum flow by Dinic's phases; capacity may be added between calls of push()."""

    def __init__(self, nodes: int):
        self.out: list[list[int]] = [[] for _ in range(nodes)]
        self.to: list[int] = []
        self.room: list[int] = []

    def edge(self, a: int, b: int, room: int) -> int:
        for u, v, r in ((a, b, room), (b, a, 0)):
            self.out[u].append(len(self.to))
            self.to.append(v)
            self.room.append(r)
        return len(self.to) - 2

    def push(self, source: int, sink: int) -> int:
        total = 0
        while True:
            level = {source: 0}
            queue = deque([source])
            while queue:
                u = queue.popleft()
                for e in self.out[u]:
                    if self.room[e] and self.to[e] not in level:
                        level[self.to[e]] = level[u] + 1
                        queue.append(self.to[e])
            if sink not in level:
                return total
            tried = [0] * len(self.out)
            path: list[int] = []
            u = source
            while True:
                if u == sink:
                    least = min(self.room[e] for e in path)
                    total += least
                    for e in path:
                        self.room[e] -= least
                        self.room[e ^ 1] += least
                    path, u = [], source
                elif tried[u] < len(self.out[u]):
                    e = self.out[u][tried[u]]
                    if self.room[e] and level.get(self.to[e]) == level[u] + 1:
                        path.append(e)
                        u = self.to[e]
                    else:
                        tried[u] += 1
                elif path:
                    u = self.to[path.pop() ^ 1]
                    tried[u] += 1
                else:
                    break


def route(patterns: Sequence[tuple[Sequence, int]], quotas: dict, rounds: int = MOST) -> list[dict]:
    """Words that each pattern (its sources, its size) gives to each of its sources, at the least repetition cost."""
    names = list(quotas)
    at = {s: 1 + len(patterns) + i for i, s in enumerate(names)}
    sink = 1 + len(patterns) + len(names)
    flow = Flow(sink + 1)
    inner = [[(s, flow.edge(1 + p, at[s], sum(quotas.values()))) for s in sources if s in at] for p, (sources, _) in enumerate(patterns)]
    for s in names:
        flow.edge(at[s], sink, quotas[s])
    for _ in range(rounds):
        for p, (_, size) in enumerate(patterns):
            flow.edge(0, 1 + p, size)
        flow.push(0, sink)
    return [{s: flow.room[e ^ 1] for s, e in edges} for edges in inner]


def weighted_quotas(sizes: dict, weights: Sequence[float] = WEIGHTS) -> dict[object, float]:
    """Targets of sources by code point, null last; weights are dealt in that order, again and again."""
    names = sorted(sizes, key=lambda s: (s is None, s or ""))
    return dict(zip(names, source_targets([sizes[s] for s in names], [weights[i % len(weights)] for i in range(len(names))])))


def _pattern(sources: Column) -> Column:
    """A set of sources as text."""
    return F.coalesce(F.to_json(F.array_sort(sources), {"ignoreNullFields": "false"}), F.lit("[]"))


def mix(
    docs: DataFrame,
    sources: Column,
    targets: Callable[[dict], dict] = weighted_quotas,
    id_col: str = "doc_id",
    text_col: str = "text",
    seed: int = SEED,
    rounds: int = MOST,
) -> tuple[DataFrame, DataFrame]:
    """The mix and its sources.

    ``sources``: array of the sources of a row, each at most once; a null in it
    is a source of its own, a null or empty array is in none and gives nothing.
    ``targets``: words wanted of each source, from {source: its words}.

    First result: (id, text_hash, pattern, size, taken), a row for each row of
    ``docs``; taken is in words, repeats counted, at most ``rounds`` x size; the
    document at a pattern's cut gives only the words still wanted. Ties and
    repeated rows: rows of equal id and text are interchangeable; at the cut
    they share what is wanted, rounded down. Null and empty texts have size 0,
    very long ones count whole. Other columns aren't read. Second: (source, pattern_of_one, source_size, target, taken).

    What reaches the driver is a row for each distinct set of sources. Up to
    BROADCAST of them, tables of a row a set are broadcast; beyond, joined.
    """
    text = F.col(text_col)
    base = docs.select(
        F.col(id_col).cast("long").alias("id"),
        F.xxhash64(text).alias("text_hash"),
        _pattern(sources).alias("pattern"),
        word_count(text).alias("size"),
        F.md5(F.concat_ws(":", F.lit(str(seed)), F.col(id_col).cast("long"), text)).alias("h"),
    )
    base = stored(base, "sizes")
    cell = F.conv(F.substring("h", 1, 2 * BITS // 4), 16, 10).cast("int")
    base = base.withColumns({"c1": F.shiftright(cell, BITS), "c2": cell.bitwiseAND((1 << BITS) - 1)})

    totals = sorted((r.pattern, int(r.n)) for r in base.groupBy("pattern").agg(F.sum("size").alias("n")).collect())
    patterns = [(json.loads(p), n) for p, n in totals]
    sizes: dict = {}
    for members, n in patterns:
        for s in members:
            sizes[s] = sizes.get(s, 0) + n
    wanted = targets(sizes)
    routed = route(patterns, {s: round(t) for s, t in wanted.items()}, rounds)
    given: dict = dict.fromkeys(sizes, 0)
    for flows in routed:
        for s, n in flows.items():
            given[s] += n
    spark = docs.sparkSession
    plan = spark.createDataFrame(
        [(p, *divmod(sum(f.values()), n)) if n else (p, 0, 0) for (p, n), f in zip(totals, routed)], "p string, full long, rest long"
    )
    table = spark.createDataFrame(
        [(s, n, float(wanted[s]), given[s]) for s, n in sizes.items()],
        "source string, source_size long, target double, taken long",
    ).select("source", _pattern(F.array("source")).alias("pattern_of_one"), "source_size", "target", "taken")

    by_pattern = Window.partitionBy("pattern")
    before = by_pattern.rowsBetween(Window.unboundedPreceding, -1)

    def cut(rows: DataFrame, cell: str, start: Column, keep: list) -> DataFrame:
        """The cell in which a pattern's remainder ends, and the words before it."""
        sums = rows.groupBy("pattern", *keep, "rest", cell).agg(F.sum("size").alias("n"), F.first(start).alias("start"))
        sums = sums.withColumn("start", F.col("start") + F.coalesce(F.sum("n").over(before.orderBy(cell)), F.lit(0)))
        return stored(sums.where("start <= rest and rest < start + n").select(F.col("pattern").alias("p"), *keep, F.col(cell).alias(cell + "_cut"), F.col("start").alias("begun")), "cut")

    sent = F.broadcast if len(totals) <= BROADCAST else lambda table: table
    rows = base.join(sent(plan), F.col("pattern") == F.col("p"), "left").drop("p")
    first = cut(rows, "c1", F.lit(0).cast("long"), [])
    inside = rows.join(sent(first), (F.col("pattern") == F.col("p")) & (F.col("c1") == F.col("c1_cut"))).drop("p")
    second = cut(inside, "c2", F.col("begun"), ["c1_cut"])
    rows = rows.join(sent(second), F.col("pattern") == F.col("p"), "left")
    at_cut = (F.col("c1") == F.col("c1_cut")) & (F.col("c2") == F.col("c2_cut"))
    early = (F.col("c1") < F.col("c1_cut")) | ((F.col("c1") == F.col("c1_cut")) & (F.col("c2") < F.col("c2_cut")))
    whole = rows.where(~F.coalesce(at_cut, F.lit(False))).withColumn("extra", F.when(early, F.col("size")).otherwise(0))
    # rows of equal id and text, of which there may be many, are one row here and share what they give
    at = rows.where(at_cut)
    equal = at.groupBy("pattern", "h", "size", "rest", "begun").agg(F.count(F.lit(1)).alias("k"))
    room = F.col("rest") - F.col("begun") - F.coalesce(F.sum(F.col("k") * F.col("size")).over(before.orderBy("h", "size")), F.lit(0))
    equal = equal.select(F.col("pattern").alias("of_pattern"), F.col("h").alias("of"), F.col("size").alias("n"), F.floor(F.greatest(F.lit(0), F.least(F.col("k") * F.col("size"), room)) / F.col("k")).alias("extra"))
    part = at.join(equal, (F.col("pattern") == F.col("of_pattern")) & (F.col("h") == F.col("of")) & (F.col("size") == F.col("n")))
    cols = ["id", "text_hash", "pattern", "size", (F.col("full") * F.col("size") + F.col("extra")).alias("taken")]
    return whole.select(*cols).union(part.select(*cols)), table


def op2_mixing_flow(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, size, source_size, target, taken (and source) of all documents."""
    mixed, table = mix(read_table(spark, sf_dir, "documents"), F.array("source"))
    of = table.select(F.col("pattern_of_one").alias("pattern"), "source", "source_size", "target")
    return mixed.join(of, "pattern", "left").select(F.col("id").alias("doc_id"), "size", "source_size", "target", "taken", "source")


QUERIES = {"op2_mixing_flow": op2_mixing_flow}
ORACLE_SQL = {
    "op2_mixing_flow": f"""
WITH docs AS (
  SELECT doc_id, source, md5(concat_ws(':', '{SEED}', doc_id, text)) AS h,
         len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+')) AS size FROM documents),
sources AS (
  SELECT source, CAST(sum(size) AS BIGINT) AS n,
         CASE row_number() OVER (ORDER BY source NULLS LAST) % 3 WHEN 1 THEN {WEIGHTS[0]} WHEN 2 THEN {WEIGHTS[1]} ELSE {WEIGHTS[2]} END AS w
  FROM docs GROUP BY source),
filled AS (  -- the more a source's limit exceeds its weight, the later it is reached
  SELECT *, {MOST} * n / w AS reached,
         ({SHARE} * sum(n) OVER () - coalesce(sum({MOST} * n) OVER earlier, 0)) / sum(w) OVER later AS rate
  FROM sources WHERE n > 0
  WINDOW earlier AS (ORDER BY {MOST} * n / w, source ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING),
         later AS (ORDER BY {MOST} * n / w, source ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)),
rated AS (SELECT coalesce((SELECT rate FROM filled WHERE rate <= reached ORDER BY reached, source LIMIT 1), 0) AS rate),
targets AS (
  SELECT source, n, CASE WHEN n = 0 THEN 0.0 ELSE CAST(least({MOST} * n, w * rate) AS DOUBLE) END AS target FROM sources, rated),
planned AS (SELECT *, CAST(round_even(target, 0) AS BIGINT) AS wanted FROM targets),
equal AS (
  SELECT source, h, size, count(*) AS k FROM docs GROUP BY ALL),
ordered AS (
  SELECT *, coalesce(sum(k * size) OVER (PARTITION BY source ORDER BY h, size ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before FROM equal)
SELECT doc_id, docs.size, n AS source_size, target, docs.source,
       CASE WHEN n = 0 THEN 0 ELSE CAST(wanted // n * docs.size + greatest(0, least(k * docs.size, wanted % n - before)) // k AS BIGINT) END AS taken
FROM docs JOIN planned ON docs.source IS NOT DISTINCT FROM planned.source
JOIN ordered o ON o.h = docs.h AND o.size = docs.size AND o.source IS NOT DISTINCT FROM docs.source
"""
}
