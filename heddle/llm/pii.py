"""Personal data: patterns, and information-theoretic sanitisation of the terms that give it away.

Base spans come from patterns. A term discloses an entity (one address, number
and so on) if knowing the term removes most of the entity's information:
PMI(entity; term) / IC(entity) >= DISCLOSED, with probabilities from the
corpus, each distinct text counted once (Sanchez and Batet's C-sanitisation).
The chance of the entity given the term is smoothed by PRIOR texts at its overall
rate, so one text's word on an entity that others hold too says less than many.
All counts are over whole texts; every entity and every term counts. Disclosing
terms become spans wherever they occur, and are generalised like the rest.

All of it is DataFrame and SQL functions.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from heddle.llm.shared import stored
from heddle.sources import read_table

KINDS = ("email", "ip", "card", "phone")
# The stated patterns. Possessive quantifiers and looks behind keep their matches (a run that fails from
# its first character fails from all others, unless a match ended inside it: \G) and rule out quadratic searches.
PATTERNS = {
    "email": r"(?:(?<![A-Za-z0-9._%+\-])|\G)[A-Za-z0-9._%+\-]++@[A-Za-z0-9\-]++(?:\.[A-Za-z0-9\-]++)++",
    "ip": r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[\x20\-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9\-]+[0-9]",
}
MUST_HOLD = {"email": "@", "ip": ".", "card": "", "phone": "+"}
PRIOR = 1  # texts
DISCLOSED = 0.9
TERM = r"[^\p{L}]+"
# Pieces of a text of up to 8000 code points, each ending with a letter run or between runs.
PIECES = r"(?s).{0,7999}\P{L}|.{1,8000}$|\p{L}+"
TERMS_AT_ONCE = 500_000  # broadcast together; more take more passes
BROADCAST = 500_000  # digests of 16 bytes, and a number; more of them are joined
FOUND = "array<struct<kind:string,start:int,end:int,value:string>>"


def _luhn(digits: Column) -> Column:
    n = F.length(digits)

    def add(total: Column, i: Column) -> Column:
        d = F.substring(digits, n - i + 1, F.lit(1)).cast("int")
        return total + F.when(i % 2 == 0, d * 2 - F.when(d > 4, 9).otherwise(0)).otherwise(d)

    return F.aggregate(F.sequence(F.lit(1), n), F.lit(0), add) % 10 == 0


def _valid(kind: str, hit: Column) -> Column:
    if kind == "ip":
        part = r"0*(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[1-9]?[0-9])"
        return hit.rlike(rf"^{part}\.{part}\.{part}\.{part}$")
    if kind in ("card", "phone"):
        digits = F.regexp_replace(hit, "[^0-9]", "")
        low, high = (16, 19) if kind == "card" else (8, 15)
        fits = F.length(digits).between(low, high)
        return F.when(fits, _luhn(digits)).otherwise(False) if kind == "card" else fits
    return F.lit(True)


def _keeps(kind: str):
    return lambda s: _valid(kind, s["value"])


def _is(kind: str):
    return lambda s: s["kind"] == kind


def _located(kind: str, hits: Column, pieces: Column) -> Column:
    """FOUND of the matches ``hits``, between which the text splits into ``pieces``. Offsets are in code points, ends exclusive."""
    n = F.size(hits)
    rows = F.zip_with(hits, F.slice(pieces, F.lit(1), n), lambda hit, before: F.struct(hit.alias("hit"), before.alias("before")))

    def add(state: Column, x: Column) -> Column:
        start = state["at"] + F.length(x["before"])
        end = start + F.length(x["hit"])
        one = F.struct(F.lit(kind).alias("kind"), start.alias("start"), end.alias("end"), x["hit"].alias("value"))
        return F.struct(end.alias("at"), F.concat(state["out"], F.array(one)).alias("out"))

    first = F.struct(F.lit(0).alias("at"), F.array().cast(FOUND).alias("out"))
    return F.when(n > 0, F.aggregate(rows, first, add)["out"]).otherwise(F.array().cast(FOUND))


def _terms(text: Column) -> Column:
    """Distinct words of over two letters, but for those in a token with a digit or an @."""
    return F.filter(F.array_distinct(F.split(F.lower(F.regexp_replace(text, r"\S*[@0-9]\S*", " ")), TERM)), lambda w: F.length(w) > 2)


def base_spans(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, digest, spans FOUND, own_terms) of every row: the patterns' valid matches by kind, then start, and the terms of the texts that have some. digest is the text's MD5; null is empty."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    rows = docs.select(F.col(id_col).cast("long").alias("id"), text.alias("t")).withColumn("digest", F.unhex(F.md5("t")))
    none = F.array().cast("array<string>")
    cut = {}
    for kind, pattern in PATTERNS.items():
        may = F.contains("t", F.lit(MUST_HOLD[kind]))
        cut[f"{kind}_hits"] = F.when(may, F.regexp_extract_all("t", F.lit(pattern), F.lit(0))).otherwise(none)
        cut[f"{kind}_pieces"] = F.when(may, F.split("t", pattern)).otherwise(none)
    rows = rows.withColumns(cut)
    spans = [F.filter(_located(k, F.col(f"{k}_hits"), F.col(f"{k}_pieces")), _keeps(k)) for k in KINDS]
    rows = rows.select("id", "digest", F.concat(*spans).alias("spans"), "t")
    return rows.select("id", "digest", "spans", F.when(F.size("spans") > 0, _terms(F.col("t"))).alias("own_terms"))


def _disclosure(texts: int) -> Column:
    """Smoothed PMI / IC of a pair of entity and term."""
    given = (F.col("n_pair") + PRIOR * F.col("n_entity") / texts) / (F.col("n_term") + PRIOR)
    return 1 + F.log2(given) / F.log2(F.lit(texts) / F.col("n_entity"))


def disclosing_terms(docs: DataFrame, base: DataFrame, text_col: str = "text") -> DataFrame | None:
    """(digest, terms array<string>) of the texts that hold terms which disclose an entity; None if there are none.

    A candidate is each term of each text that holds an entity. Its PMI / IC is
    1 + log((n_pair + PRIOR * n_entity / N) / (n_term + PRIOR)) / log(N / n_entity),
    in counts of distinct texts.
    """
    held = base.select("digest", F.explode("spans").alias("s")).select("digest", F.concat("s.kind", F.lit(":"), F.lower("s.value")).alias("entity")).distinct()
    held = stored(held, "held")
    texts = base.select("digest").distinct().count()
    if texts < 2:
        return None
    entities = held.groupBy("entity").agg(F.count(F.lit(1)).alias("n_entity")).where(F.col("n_entity") < texts)
    # entities of one text alone give the same pairs: the text's digest stands for all of them
    entities = held.join(entities, "entity").withColumn("entity", F.when(F.col("n_entity") == 1, F.hex("digest")).otherwise(F.col("entity"))).distinct()
    # n_pair is n_entity at most, so a term of more texts than this falls short
    most = (F.col("n_entity") * (1 + PRIOR / texts)) * F.pow(F.lit(texts) / F.col("n_entity"), F.lit(1 - DISCLOSED)) - PRIOR + 1e-6
    entities = stored(entities.withColumn("most", most), "entities")
    text = F.coalesce(F.col(text_col), F.lit(""))
    rows = docs.select(F.unhex(F.md5(text)).alias("digest"), text.alias("t"))
    several = base.groupBy("digest").agg(F.count(F.lit(1)).alias("times")).where("times > 1").withColumnRenamed("digest", "of")
    several = stored(several, "several")
    few = F.broadcast(several) if several.count() <= BROADCAST else several  # then no text is shuffled
    words = rows.join(few, F.col("digest") == F.col("of"), "left").select(F.coalesce("times", F.lit(1)).alias("times"), F.explode(F.array_distinct(F.split(F.lower("t"), TERM))).alias("term"))
    # equal texts count as one together
    counts = stored(words.groupBy("term").agg(F.round(F.sum(1 / F.col("times"))).cast("long").alias("n_term")), "counts")
    bounds = entities.groupBy("digest").agg(F.max("most").alias("bound"))
    mine = base.where("own_terms is not null").groupBy("digest").agg(F.first("own_terms").alias("own_terms"))
    mine = mine.join(bounds, "digest").select("digest", "bound", F.explode("own_terms").alias("term"))
    mine = stored(mine.join(counts, "term").where("n_term <= bound").drop("bound"), "candidates")
    pairs = mine.join(entities, "digest").where("n_term <= most").groupBy("entity", "n_entity", "term", "n_term").agg(F.count(F.lit(1)).alias("n_pair"))
    telling = stored(pairs.where(_disclosure(texts) >= DISCLOSED).select("term", "n_term").distinct(), "telling")
    if telling.isEmpty():
        return None
    found = mine.join(telling.select("term"), "term").select("digest", "term")
    # only terms that have texts beyond these are looked for in all texts
    more = telling.join(mine.groupBy("term").agg(F.count(F.lit(1)).alias("n_found")), "term", "left").where("n_found is null or n_found < n_term")
    more = stored(more.select("term"), "looked_for")
    words = rows.select("digest", F.explode(F.array_distinct(F.split(F.lower("t"), TERM))).alias("term"))
    passes = -(-more.count() // TERMS_AT_ONCE)
    for i in range(passes):  # each broadcasts a bounded part of the terms
        found = found.union(words.join(F.broadcast(more.where(F.pmod(F.xxhash64("term"), F.lit(passes)) == i)), "term", "left_semi").select("digest", "term"))
    return stored(found.groupBy("digest").agg(F.sort_array(F.collect_set("term")).alias("terms")), "telling_by_text")


def personal_data(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, digest, base FOUND, spans array<struct<kind, start, end>>): a row for each row of ``docs``.

    spans are the base spans by kind, then start, and behind them those of kind
    "term", words that disclose an entity, where they overlap no base span.
    Null texts count as empty and have no spans. Repeated rows repeat, and
    count once as texts. Very long texts are searched whole. Other columns
    aren't read. An empty table gives no rows.
    """
    base = stored(base_spans(docs, id_col, text_col), "base")
    telling = disclosing_terms(docs, base, text_col)
    plain = F.transform("spans", lambda s: F.struct(s["kind"].alias("kind"), s["start"].alias("start"), s["end"].alias("end")))
    if telling is None:
        return base.select("id", "digest", F.col("spans").alias("base"), plain.alias("spans"))
    text = F.coalesce(F.col(text_col), F.lit(""))
    rows = docs.select(F.unhex(F.md5(text)).alias("digest"), text.alias("t"))
    if telling.count() <= BROADCAST:  # then only their texts are shuffled
        rows = rows.join(F.broadcast(telling.select("digest")), "digest", "left_semi")
    rows = rows.join(telling, "digest")
    # terms are looked for in pieces that hold few of them, so that very long texts take no longer by the character
    ends = F.transform("pieces_of", lambda x: F.length(x))
    begin = F.aggregate(ends, F.array(F.lit(0)), lambda sums, n: F.concat(sums, F.array(F.element_at(sums, -1) + n)))
    rows = rows.groupBy("digest").agg(F.first("terms").alias("terms"), F.first("t").alias("t"))
    rows = rows.select("digest", "terms", F.regexp_extract_all("t", F.lit(PIECES), F.lit(0)).alias("pieces_of"))
    rows = rows.select("digest", "terms", F.explode(F.arrays_zip(F.col("pieces_of").alias("piece"), begin.alias("begin"))).alias("x")).where("x.piece is not null")
    rows = rows.select("digest", F.col("x.begin").alias("begin"), F.col("x.piece").alias("t"), F.array_intersect("terms", F.split(F.lower("x.piece"), TERM)).alias("terms")).where(F.size("terms") > 0)
    rows = rows.withColumn("pattern", F.concat(F.lit(r"(?iu)(?<!\p{L})(?:"), F.array_join("terms", "|"), F.lit(r")(?!\p{L})")))
    rows = rows.select("digest", "begin", F.expr("regexp_extract_all(t, pattern, 0)").alias("hits"), F.expr("split(t, pattern)").alias("pieces"))
    found = _located("term", F.col("hits"), F.col("pieces"))
    rows = rows.select("digest", F.transform(found, lambda s: F.struct(s["kind"].alias("kind"), (s["start"] + F.col("begin")).alias("start"), (s["end"] + F.col("begin")).alias("end"))).alias("terms"))
    rows = stored(rows.groupBy("digest").agg(F.array_sort(F.flatten(F.collect_list("terms"))).alias("terms")).withColumnRenamed("digest", "of"), "term_spans")
    joined = base.join(rows, F.col("digest") == F.col("of"), "left")
    clear = F.filter("terms", lambda t: ~F.exists("spans", lambda s: (s["start"] < t["end"]) & (t["start"] < s["end"])))
    return joined.select("id", "digest", F.col("spans").alias("base"), F.when(F.col("terms").isNull(), plain).otherwise(F.concat(plain, clear)).alias("spans"))


def sanitised(text: Column, spans: Column) -> Column:
    """``text`` with each span generalised to [KIND]; of spans that overlap, the first by start stays. Null stays null."""

    def add(state: Column, s: Column) -> Column:
        piece = F.concat(F.substring(text, state["at"] + 1, s["start"] - state["at"]), F.lit("["), F.upper(s["kind"]), F.lit("]"))
        return F.when(s["start"] < state["at"], state).otherwise(F.struct(s["end"].alias("at"), F.concat(state["out"], F.array(piece)).alias("out")))

    by_start = F.array_sort(F.transform(spans, lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end"), s["kind"].alias("kind"))))
    done = F.aggregate(by_start, F.struct(F.lit(0).alias("at"), F.array().cast("array<string>").alias("out")), add)
    return F.concat(F.array_join(done["out"], ""), F.substring(text, done["at"] + 1, F.length(text)))


def _written(spans: Column) -> Column:
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def op5_pii_disclosure(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, n_email, n_ip, n_card, n_phone, base_sha256, spans of all documents."""
    rows = personal_data(read_table(spark, sf_dir, "documents"))
    counts = [F.size(F.filter("base", _is(k))).cast("long").alias(f"n_{k}") for k in KINDS]
    return rows.select(F.col("id").alias("doc_id"), *counts, F.sha2(_written(F.col("base")), 256).alias("base_sha256"), _written(F.col("spans")).alias("spans"))


QUERIES = {"op5_pii_disclosure": op5_pii_disclosure}
ORACLE_SQL = {
    "op5_pii_disclosure": rf"""
WITH docs AS (SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS t FROM documents),
kinds(kind, place, pattern) AS (VALUES
  ('email', 1, '[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+'), ('ip', 2, '[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)'),
  ('card', 3, '[0-9]([ -]?[0-9])+'), ('phone', 4, '\+[0-9][ ().0-9-]+[0-9]'), ('term', 5, '\p{{L}}+')),
cut AS (  -- hits and what stands before each
  SELECT r, kind, place, unnest(range(1, len(hits) + 1)) AS k, unnest(hits) AS value, unnest(pieces[1:len(hits)]) AS piece
  FROM (SELECT r, kind, place, regexp_extract_all(t, pattern) AS hits, string_split_regex(t, pattern) AS pieces FROM docs, kinds)),
found AS (
  SELECT r, kind, place, value, regexp_replace(value, '[^0-9]', '', 'g') AS digits,
         sum(length(piece)) OVER w + coalesce(sum(length(value)) OVER (w ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS start
  FROM cut WINDOW w AS (PARTITION BY r, kind ORDER BY k)),
base AS (
  SELECT r, kind, place, value, start, start + length(value) AS stop FROM found
  WHERE CASE kind WHEN 'email' THEN true
    WHEN 'ip' THEN len(list_filter(string_split(value, '.'), lambda x: length(ltrim(x, '0')) > 3 OR CAST(right('000' || x, 3) AS INT) > 255)) = 0
    WHEN 'card' THEN length(digits) BETWEEN 16 AND 19
      AND list_sum(list_transform(string_split(reverse(digits), ''), lambda c, i: CASE WHEN i % 2 = 1 THEN CAST(c AS INT) WHEN CAST(c AS INT) > 4 THEN 2 * CAST(c AS INT) - 9 ELSE 2 * CAST(c AS INT) END)) % 10 = 0
    WHEN 'phone' THEN length(digits) BETWEEN 8 AND 15 ELSE false END),
texts AS (SELECT t, min(r) AS r FROM docs GROUP BY t),
size AS (SELECT count(*) AS n FROM texts),
words AS (SELECT DISTINCT r, unnest(string_split_regex(lower(t), '[^\p{{L}}]+')) AS term FROM texts),
terms AS (SELECT term, count(*) AS n_term FROM words GROUP BY term),
held AS (SELECT DISTINCT r, kind || ':' || lower(value) AS entity FROM base SEMI JOIN texts USING (r)),
entities AS (SELECT entity, count(*) AS n_entity FROM held GROUP BY entity),
own AS (
  SELECT DISTINCT r, term FROM (
    SELECT r, unnest(string_split_regex(lower(regexp_replace(t, '\S*[@0-9]\S*', ' ', 'g')), '[^\p{{L}}]+')) AS term FROM texts WHERE r IN (SELECT r FROM held))
  WHERE length(term) > 2),
pairs AS (SELECT entity, term, count(*) AS n_pair FROM held JOIN own USING (r) GROUP BY entity, term),
telling AS (
  SELECT DISTINCT term FROM pairs JOIN entities USING (entity) JOIN terms USING (term), size
  WHERE n_entity < n AND 1 + log2((n_pair + {PRIOR} * n_entity / n) / (n_term + {PRIOR})) / log2(n / n_entity) >= {DISCLOSED}),
spans AS (
  SELECT r, kind, place, start, stop FROM base
  UNION ALL
  SELECT r, kind, place, start, start + length(value) FROM found f
  WHERE kind = 'term' AND lower(value) IN (SELECT term FROM telling)
    AND NOT EXISTS (SELECT 1 FROM base b WHERE b.r = f.r AND b.start < f.start + length(f.value) AND f.start < b.stop)),
written AS (
  SELECT r, count(*) FILTER (kind = 'email') AS n_email, count(*) FILTER (kind = 'ip') AS n_ip, count(*) FILTER (kind = 'card') AS n_card, count(*) FILTER (kind = 'phone') AS n_phone,
         string_agg(kind || ':' || start || ':' || stop, ',' ORDER BY place, start) FILTER (kind <> 'term') AS base,
         string_agg(kind || ':' || start || ':' || stop, ',' ORDER BY place, start) AS spans
  FROM spans GROUP BY r)
SELECT doc_id, coalesce(n_email, 0) AS n_email, coalesce(n_ip, 0) AS n_ip, coalesce(n_card, 0) AS n_card, coalesce(n_phone, 0) AS n_phone,
       sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans
FROM docs LEFT JOIN written USING (r)
"""
}
