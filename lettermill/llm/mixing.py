"""Mixing sources to target weights: rake token weights to marginals, then sample.

The weights of the cells (source x language x topic) are fitted to target shares by
iterative proportional fitting, no cell beyond the tokens that it has. Values without a target of their own fall into the
class "*", so the number of cells is bounded by the targets given, whatever the
corpus: only that table is ever in one task or broadcast. Every document is then
kept with the probability of its cell, by a hash of its id.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lettermill.llm.common import packed, whole_text
from lettermill.storage import stored

DIMS = ("source", "lang", "topic")
MOST_CELLS = 100_000
#: Window steps of one plan; the query's targets take 60.
PLAN_STEPS = 64


@dataclass(frozen=True)
class Targets:
    """Shares of tokens wanted, by value; "*" is every value that is not named."""

    source: dict[str, float] = field(default_factory=lambda: {"src0": 0.25, "src1": 0.06, "src2": 0.06, "*": 0.63})
    lang: dict[str, float] = field(default_factory=lambda: {"en": 0.55, "de": 0.18, "fr": 0.15, "es": 0.11, "*": 0.01})
    topic: dict[str, float] = field(default_factory=lambda: {"tables": 0.1, "lists": 0.2, "*": 0.7})
    rounds: int = 16
    budget: float = 0.5  # of the corpus' tokens
    seed: str = "mix"

    def cells(self) -> int:
        return (len(self.source) + 1) * (len(self.lang) + 1) * (len(self.topic) + 1)


def n_words(text: Column) -> Column:
    return F.size(F.regexp_extract_all(text, F.lit(r"([^\x20\x09-\x0D]+)"), F.lit(1)))


def topic_of(text: Column, words: Column) -> Column:
    """What kind of text it is, by counts that any engine can repeat: tables hold a bar for
    ten words, lists a line for eight, everything else is prose."""
    bars = F.length(text) - F.length(F.replace(text, F.lit("|")))
    lines = F.length(text) - F.length(F.replace(text, F.lit("\n"))) + 1
    return F.when(bars * 10 >= words, "tables").when(lines * 8 >= words, "lists").otherwise("prose")


def _class(value: Column, shares: dict[str, float]) -> Column:
    named = [v for v in shares if v != "*"]
    return F.when(value.isin(named), value).otherwise(F.lit("*"))


def _share(value: Column, shares: dict[str, float]) -> Column:
    out = F.lit(float(shares.get("*", 0.0)))
    for v, s in shares.items():
        if v != "*":
            out = F.when(value == v, F.lit(float(s))).otherwise(out)
    return out


def rake(cells: DataFrame, targets: Targets) -> DataFrame:
    """source, lang, topic (classes), n_tokens -> the same with weight (share of the kept tokens, at most
    what the cell has: `cap`), share_source, share_lang, share_topic (what is aimed at) and
    probability: weight by cap.

    Targets of classes that hold no tokens are shared out among the others, and so is what a
    class can't give: it is kept whole then. A cell at its cap stays there while the others of
    its classes are raked up. One task: `cells` has at most `targets.cells()` rows.
    """
    everywhere, steps = Window.partitionBy(), 0

    def cut(frame: DataFrame) -> DataFrame:
        """Every so many steps the plan is cut by a written table: long ones can't be sent to tasks."""
        nonlocal steps
        steps += 1
        return stored(frame, "raked") if steps % PLAN_STEPS == 0 else frame

    out = cells.coalesce(1).withColumn("cap", F.col("n_tokens") / (F.sum("n_tokens").over(everywhere) * targets.budget))
    wanted = {d: Window.partitionBy(d) for d in DIMS}
    for d in DIMS:
        t, k, c = f"share_{d}", f"k_{d}", f"c_{d}"
        out = out.withColumns(
            {
                t: _share(F.col(d), getattr(targets, d)),
                k: F.count(F.lit(1)).over(wanted[d]),
                c: F.sum("cap").over(wanted[d]),
            }
        )
        out = out.withColumn(t, F.col(t) / F.sum(F.col(t) / F.col(k)).over(everywhere))
        for _ in range(len(getattr(targets, d))):  # each time one more class is found short, or none is left
            short = F.col(t) >= F.col(c)
            lack = 1 - F.sum(F.least(t, c) / F.col(k)).over(everywhere)
            free = F.sum(F.when(~short, F.col(t) / F.col(k)).otherwise(0.0)).over(everywhere)
            out = cut(out.withColumn(t, F.when(short, F.col(c)).when(free > 0, F.col(t) + lack * F.col(t) / free).otherwise(F.col(t))))
        out = out.withColumn(t, F.least(t, c))
    out = out.withColumn("weight", F.col("cap") * targets.budget)
    for _ in range(targets.rounds):
        for d in DIMS:
            total = F.sum("weight").over(wanted[d])
            raked = F.least(F.col("cap"), F.col("weight") * F.col(f"share_{d}") / total)
            out = cut(out.withColumn("weight", F.when(total > 0, raked).otherwise(0.0)))
    shares = [f"share_{d}" for d in DIMS]
    return out.select(*DIMS, "n_tokens", "weight", *shares, F.least(F.lit(1.0), F.col("weight") / F.col("cap")).alias("probability"))


def uniform(doc_id: Column, text: Column, seed: str) -> Column:
    """A number in [0, 1) that depends on the document alone, wherever it is computed."""
    key = F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.md5(text.cast("binary"))))
    return F.conv(F.substring(F.md5(key.cast("binary")), 1, 12), 16, 10).cast("double") / F.lit(float(16**12))


def mix(docs: DataFrame, targets: Targets = Targets()) -> DataFrame:  # noqa: B008
    """A row per input row: row (struct of all input columns), n_tokens, source_class, lang_class,
    topic, probability, kept.

    Tokens are words; a text without words, or null, weighs one. A null source or language
    belongs to the class "*". The draw hangs on doc_id (on the text where it is null), so a
    repeated row is kept or dropped as its copies are. An empty table gives an empty table;
    columns besides doc_id, text, lang and source are carried only.
    """
    if targets.cells() > MOST_CELLS:
        raise ValueError(f"{targets.cells()} cells: name fewer values, the rest falls into '*'")
    text = whole_text()
    measured = docs.select(packed(docs), text.alias("whole")).withColumn("words", n_words(F.col("whole")))
    classed = measured.select(
        "row",
        F.greatest(F.col("words"), F.lit(1)).cast("long").alias("n_tokens"),
        _class(F.col("row.source"), targets.source).alias("source"),
        _class(F.col("row.lang"), targets.lang).alias("lang"),
        topic_of(F.col("whole"), F.col("words")).alias("topic_name"),
        uniform(F.col("row.doc_id"), F.col("whole"), targets.seed).alias("draw"),
    ).withColumn("topic", _class(F.col("topic_name"), targets.topic))
    cells = classed.groupBy(*DIMS).agg(F.sum("n_tokens").alias("n_tokens"))
    rates = rake(cells, targets).select(*DIMS, "probability")  # at most MOST_CELLS rows
    return classed.join(F.broadcast(rates), list(DIMS), "left").select(
        "row",
        "n_tokens",
        F.col("source").alias("source_class"),
        F.col("lang").alias("lang_class"),
        F.col("topic_name").alias("topic"),
        "probability",
        (F.col("draw") < F.col("probability")).alias("kept"),
    )


def op2_mixing(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text", "lang", "source")
    return mix(docs).select(
        F.col("row.doc_id").alias("doc_id"),
        "n_tokens", "source_class", "lang_class", "topic",
        F.round("probability", 9).alias("probability"),
        "kept",
    )


def mixed_sql(table: str, targets: Targets = Targets()) -> str:  # noqa: B008
    """CTEs over `table` (doc_id, text, lang, source); the last is mix_rows."""

    def cls(value: str, shares: dict[str, float]) -> str:
        named = ", ".join(f"'{v}'" for v in shares if v != "*")
        return f"CASE WHEN {value} IN ({named}) THEN {value} ELSE '*' END"

    def share(d: str) -> str:
        shares = getattr(targets, d)
        cases = " ".join(f"WHEN '{v}' THEN {s!r}::DOUBLE" for v, s in shares.items() if v != "*")
        return f"CASE {d} {cases} ELSE {shares.get('*', 0.0)!r}::DOUBLE END"

    blank = "' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"
    bars = "length(whole) - length(replace(whole, '|', ''))"
    breaks = "length(whole) - length(replace(whole, chr(10), '')) + 1"
    steps, last = [], "mix_k"

    def step(name: str, select: str) -> None:
        nonlocal last
        steps.append(f"{name} AS MATERIALIZED (SELECT {select} FROM {last})")
        last = name

    for d in DIMS:
        t, k, c = f"t_{d}", f"k_{d}", f"c_{d}"
        step(f"mix_t_{d}", f"* REPLACE ({t} / sum({t} / {k}) OVER () AS {t})")
        for i in range(len(getattr(targets, d))):
            lack = f"(1 - sum(least({t}, {c}) / {k}) OVER ())"
            free = f"sum(CASE WHEN {t} >= {c} THEN 0 ELSE {t} / {k} END) OVER ()"
            more = f"CASE WHEN {t} >= {c} THEN {c} WHEN {free} > 0 THEN {t} + {lack} * {t} / {free} ELSE {t} END"
            step(f"mix_t{i}_{d}", f"* REPLACE ({more} AS {t})")
        step(f"mix_l_{d}", f"* REPLACE (least({t}, {c}) AS {t})")
    for i in range(targets.rounds):
        for d in DIMS:
            total = f"sum(weight) OVER (PARTITION BY {d})"
            raked = f"CASE WHEN {total} > 0 THEN least(cap, weight * t_{d} / {total}) ELSE 0 END"
            step(f"mix_w{i}_{d}", f"* REPLACE ({raked} AS weight)")
    ks = ", ".join(
        f"{share(d)} AS t_{d}, count(*) OVER (PARTITION BY {d}) AS k_{d}, sum(cap) OVER (PARTITION BY {d}) AS c_{d}" for d in DIMS
    )
    budget = f"{targets.budget!r}::DOUBLE"
    return f"""mix_words AS (
  SELECT doc_id, source AS src, lang AS lng, coalesce(text, '') AS whole,
    len(list_filter(string_split(translate(coalesce(text, ''), {blank}, '      '), ' '), lambda x: x <> '')) AS words
  FROM {table}),
mix_docs AS (
  SELECT *, {cls('topic_name', targets.topic)} AS topic FROM (
    SELECT doc_id, whole, CAST(greatest(words, 1) AS BIGINT) AS n_tokens,
      {cls('src', targets.source)} AS source, {cls('lng', targets.lang)} AS lang,
      CASE WHEN ({bars}) * 10 >= words THEN 'tables' WHEN ({breaks}) * 8 >= words THEN 'lists'
        ELSE 'prose' END AS topic_name,
      CAST(CAST('0x' || substr(md5('{targets.seed}:' || coalesce(CAST(doc_id AS VARCHAR), md5(whole))), 1, 12)
        AS BIGINT) AS DOUBLE) / {16**12}::DOUBLE AS draw
    FROM mix_words)),
mix_cells AS (SELECT source, lang, topic, CAST(sum(n_tokens) AS DOUBLE) AS n_tokens FROM mix_docs GROUP BY ALL),
mix_caps AS (SELECT *, n_tokens / (sum(n_tokens) OVER () * {budget}) AS cap FROM mix_cells),
mix_k AS (SELECT *, cap * {budget} AS weight, {ks} FROM mix_caps),
{(',' + chr(10)).join(steps)},
mix_rates AS (
  SELECT source, lang, topic,
    least(1.0::DOUBLE, weight / cap) AS probability
  FROM {last}),
mix_rows AS (
  SELECT d.doc_id, d.n_tokens, d.source AS source_class, d.lang AS lang_class, d.topic_name AS topic,
    r.probability, d.draw < r.probability AS kept
  FROM mix_docs d JOIN mix_rates r USING (source, lang, topic))"""


OP2_SQL = f"""WITH {mixed_sql('documents')}
SELECT * REPLACE (round(probability, 9) AS probability) FROM mix_rows"""
