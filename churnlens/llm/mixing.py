"""Mixing sources to target weights by Sainte-Laguë apportionment (DataFrame functions only).

1. Every source gets a target share of all words by weight, stopped at ``max_epochs`` times its own
   words; the excess is shared again by weight (water filling, in closed form over the source table).
2. Targets become integer quotas of ``block_words`` blocks by highest quotients, first over sources,
   then over the hash shards of each source, so no step needs a whole source in one task.
3. In a shard the documents' words stand end to end and are cut into blocks.  A quota of q blocks over
   n is q // n whole passes plus q % n distinct blocks, picked by a seeded affine permutation of the
   block numbers: exact counts, no sort, the same choice on every run.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from churnlens.session import scratch_path

WEIGHTS = (5, 2, 1)
BLOCK_WORDS = 32
DOCS_PER_SHARD = 4096
SEED = 20
MAX_EPOCHS = 3
#: A prime above any number of blocks in a shard, so the step permutes every block range.
STEP = 2147483647
WORD = r"[^\x20\x09-\x0D]+"


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def _draw(*parts: Column) -> Column:
    """A seeded 48-bit number from md5, the same in every engine."""
    return F.conv(F.substring(F.md5(F.concat_ws("|", *parts)), 1, 12), 16, 10).cast("long")


def source_targets(sizes: DataFrame, weights: Sequence[int] = WEIGHTS, max_epochs: int = MAX_EPOCHS) -> DataFrame:
    """``source, source_size, total, target`` for each source of ``sizes(source, size)``.

    Weights follow the sources' code point order, null last, and repeat.  All windows run over the
    source table, one row per source."""
    per = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    everything = Window.partitionBy(F.lit(1))
    w = per.withColumn("pos", (F.row_number().over(by_name) - 1) % len(weights)).withColumn(
        "weight", F.element_at(F.array(*[F.lit(int(x)).cast("long") for x in weights]), F.col("pos") + 1)
    ).withColumn("cap", F.col("source_size") * max_epochs)
    # Sources that stop first have the least cap per weight; source i stops if the level that the
    # ones before it leave would lift it above its cap.
    order = [(F.col("cap") / F.col("weight")).asc(), F.col("source").asc_nulls_last()]
    before = Window.orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    w = (
        w.withColumn("total", F.sum("source_size").over(everything))
        .withColumn("left", F.col("total") - F.coalesce(F.sum("cap").over(before), F.lit(0)))
        .withColumn("shares", F.sum("weight").over(everything) - F.coalesce(F.sum("weight").over(before), F.lit(0)))
        .withColumn("stops", F.col("left") * F.col("weight") > F.col("cap") * F.col("shares"))
    )
    free = Window.partitionBy(F.lit(1))
    w = w.withColumn("free_left", F.max(F.struct(F.when(~F.col("stops"), F.col("shares")).alias("s"), F.col("left").alias("l"))).over(free))
    level = F.col("weight") * F.col("free_left.l") / F.col("free_left.s")
    return w.select(
        "source", "source_size", "total",
        F.when(F.col("stops"), F.col("cap").cast("double")).otherwise(F.coalesce(level, F.lit(0.0))).alias("target"),
    )


def apportion(parties: DataFrame, house: Sequence[str], key: Column, votes: str, seats: str) -> DataFrame:
    """Sainte-Laguë: adds ``won``, the party's seats out of its house's ``seats`` by the highest
    quotients votes / (2 s - 1); ties go to the smaller key.

    Seats below floor(quota) - c are certain and those above floor(quota) + c impossible, where c
    bounds how far the divisor method strays from the quota, so only 2 c + 1 quotients of each party
    are listed.  A house without votes wins nothing."""
    whole = Window.partitionBy(*[F.col(h) for h in house]) if house else Window.partitionBy(F.lit(1))
    q = (
        parties.withColumn("_votes", F.sum(votes).over(whole))
        .withColumn("_quota", F.when(F.col("_votes") > 0, F.col(seats) * F.col(votes) / F.col("_votes")).otherwise(F.lit(0.0)))
        .withColumn("_stray", (F.ceil(
            F.count(F.lit(1)).over(whole) * F.max("_quota").over(whole) / (2 * F.greatest(F.col(seats), F.lit(1)))
        ) + 2).cast("long"))
        .withColumn("_sure", F.greatest(F.floor("_quota") - F.col("_stray"), F.lit(0)).cast("long"))
        .withColumn("_open", F.when(F.col("_votes") > 0, F.col(seats)).otherwise(F.lit(0)) - F.sum("_sure").over(whole))
    )
    best = whole.orderBy(F.col("_quotient").desc(), key)
    won = (
        q.withColumn("_seat", F.explode(F.sequence(F.col("_sure") + 1, (F.floor("_quota") + F.col("_stray") + 1).cast("long"))))
        .withColumn("_quotient", F.col(votes) / (2 * F.col("_seat") - 1))
        .withColumn("_rank", F.row_number().over(best))
        .withColumn("_won", ((F.col("_rank") <= F.col("_open")) & (F.col("_quotient") > 0)).cast("long"))
    )
    return won.groupBy(*parties.columns, "_sure").agg(F.sum("_won").alias("_more")).select(
        *parties.columns, (F.col("_sure") + F.col("_more")).alias("won")
    )


def mix_plan(
    docs: DataFrame, id_col: str = "doc_id", source_col: str = "source", text_col: str = "text",
    weights: Sequence[int] = WEIGHTS, max_epochs: int = MAX_EPOCHS, block_words: int = BLOCK_WORDS,
    docs_per_shard: int = DOCS_PER_SHARD, seed: int = SEED,
) -> DataFrame:
    """One row per document: ``doc_id, source, size, tie, source_size, target, taken`` and the block
    choice ``(before, passes, picks, shift, blocks)`` that ``taken`` follows from; ``tie`` is the text's MD5.

    ``taken`` counts words, repeats included, and is at most ``max_epochs * size``.  Null text: size
    0.  A null source is a source of its own, last.  Repeated rows count as often as they stand; rows
    of one id are told apart by their text, so many rows without an id spread over the shards as well.
    Null ids come first in their shard.  Empty table: no rows.

    A source has shards by its own rows, so that a small source beside large ones keeps whole blocks and
    reaches its target.  The texts are read once: sizes and ties are written before they are used."""
    spark, path = docs.sparkSession, scratch_path(docs.sparkSession, "mix-sizes")
    text = F.coalesce(F.col(text_col), F.lit(""))
    docs.select(
        F.col(id_col).alias("doc_id"), F.col(source_col).alias("source"), word_count(text).alias("size"), F.md5(text).alias("tie")
    ).write.parquet(path)
    sized = spark.read.parquet(path)
    sources = source_targets(sized, weights, max_epochs)
    m = F.round(F.col("total") / block_words).cast("long")
    quotas = apportion(sources.withColumn("seats", m), [], F.col("source").asc_nulls_last(), "target", "seats")

    # Only sources of more than one shard are listed: at most one per docs_per_shard rows.
    cut = sized.groupBy(F.col("source").alias("_source")).agg(F.ceil(F.count(F.lit(1)) / docs_per_shard).alias("_shards")).where("_shards > 1")
    in_shard = sized.join(cut, F.col("source").eqNullSafe(F.col("_source")), "left").withColumn("shard", F.pmod(
        _draw(F.lit(str(seed)), F.coalesce(F.col("doc_id").cast("string"), F.lit("")), F.col("tie")), F.coalesce("_shards", F.lit(1))
    )).drop("_source", "_shards")
    shards = in_shard.groupBy("source", "shard").agg(F.sum("size").alias("words"))
    shards = shards.alias("s").join(quotas.alias("q"), F.col("s.source").eqNullSafe(F.col("q.source"))).select(
        "s.source", "s.shard", "s.words", "q.source_size", "q.target", F.col("q.won").alias("seats")
    )
    cuts = apportion(shards, ["source"], F.col("shard").asc(), "words", "seats")
    n = F.ceil(F.col("words") / block_words).cast("long")
    cuts = cuts.withColumn("blocks", n).withColumn("quota", F.least("won", n * max_epochs)).select(
        "source", "shard", "source_size", "target", "blocks",
        F.when(n > 0, F.expr("quota div blocks")).otherwise(0).cast("long").alias("passes"),
        F.when(n > 0, F.expr("quota % blocks")).otherwise(0).cast("long").alias("picks"),
        _draw(F.lit(f"{seed}pick"), F.coalesce("source", F.lit("")), F.col("shard").cast("string")).alias("shift"),
    )
    laid = Window.partitionBy("source", "shard").orderBy("doc_id", "size", "tie").rowsBetween(Window.unboundedPreceding, -1)
    placed = in_shard.withColumn("before", F.coalesce(F.sum("size").over(laid), F.lit(0)))
    joined = placed.alias("p").join(
        cuts.alias("c"), F.col("p.source").eqNullSafe(F.col("c.source")) & (F.col("p.shard") == F.col("c.shard"))
    ).select("p.doc_id", "p.source", "p.size", "p.tie", "p.before", "c.source_size", "c.target", "c.blocks", "c.passes", "c.picks", "c.shift")
    picked = F.aggregate(
        picked_slices(block_words), F.lit(0).cast("long"), lambda total, x: total + x["words"]
    )
    return joined.withColumn("taken", F.col("passes") * F.col("size") + picked)


def picked_slices(block_words: int = BLOCK_WORDS) -> Column:
    """For a row of ``mix_plan``: its part of each picked block as ``(at, words)``, ``at`` counted
    from 0 in the document's own words."""
    b = F.lit(block_words)
    first, end = F.col("before"), F.col("before") + F.col("size")
    mine = F.when(F.col("size") > 0, F.sequence(F.floor(first / b), F.floor((end - 1) / b))).otherwise(
        F.array().cast("array<bigint>")
    )
    chosen = F.filter(mine, lambda k: F.pmod(k * F.lit(STEP) + F.col("shift"), F.col("blocks")) < F.col("picks"))
    return F.transform(chosen, lambda k: F.struct(
        (F.greatest(k * b, first) - first).alias("at"),
        (F.least((k + 1) * b, end) - F.greatest(k * b, first)).alias("words"),
    ))


def mixed_documents(docs: DataFrame, block_words: int = BLOCK_WORDS, **options) -> DataFrame:
    """The mix itself, with the columns of ``docs(doc_id, text, source, ...)``: each document once per
    whole pass, unchanged, and once more with the words of its picked blocks joined by spaces;
    ``n_chars``, if there, follows the text.  Documents of which no word is taken are absent."""
    keys = ["doc_id", "source", "tie"]
    # Rows that repeat (id, source, text) are told apart by their number, in either frame.
    number = Window.partitionBy(*keys)
    plan = mix_plan(docs, block_words=block_words, **options).withColumn("slices", picked_slices(block_words))
    plan = plan.where("taken > 0").withColumn("n", F.row_number().over(number.orderBy("before")))
    rows = docs.select("doc_id", "source", F.md5(F.coalesce("text", F.lit(""))).alias("tie"), F.struct(*docs.columns).alias("row"))
    rows = rows.withColumn("n", F.row_number().over(number.orderBy("tie")))
    p, r = plan.alias("p"), rows.alias("r")
    same = F.col("p.n") == F.col("r.n")
    for k in keys:
        same = same & F.col(f"p.{k}").eqNullSafe(F.col(f"r.{k}"))
    found = F.regexp_extract_all("r.row.text", F.lit(f"({WORD})"), F.lit(1))
    cut = r.join(p, same).select("r.row", "p.passes", "p.slices", F.when(F.size("p.slices") > 0, found).alias("words"))
    part = F.array_join(F.flatten(F.transform(
        "slices", lambda x: F.slice("words", x["at"].cast("int") + 1, x["words"].cast("int"))
    )), " ")
    texts = F.concat(
        F.array_repeat(F.col("row.text"), F.col("passes").cast("int")),
        F.when(F.size("slices") > 0, F.array(part)).otherwise(F.array().cast("array<string>")),
    )
    out = cut.select("row", F.explode(texts).alias("out"))
    return out.select(*[
        F.col("out").alias(c) if c == "text" else F.length("out").cast("long").alias(c) if c == "n_chars" else F.col(f"row.{c}").alias(c)
        for c in docs.columns
    ])


def _apportion_sql(name: str, parties: str, house: str, key: str, votes: str, columns: str) -> str:
    part = f"PARTITION BY {house}" if house else ""
    return f"""
{name}_q AS (
  SELECT *, sum({votes}) OVER ({part}) AS all_votes,
    CASE WHEN sum({votes}) OVER ({part}) > 0
      THEN CAST(seats AS DOUBLE) * {votes} / sum({votes}) OVER ({part}) ELSE 0.0 END AS quota
  FROM {parties}),
{name}_s AS (
  SELECT *, CAST(ceil(count(*) OVER ({part}) * max(quota) OVER ({part}) / (2.0 * greatest(seats, 1))) AS BIGINT) + 2 AS stray
  FROM {name}_q),
{name}_o AS (
  SELECT *, CAST(greatest(floor(quota) - stray, 0) AS BIGINT) AS sure FROM {name}_s),
{name}_p AS (
  SELECT *, CASE WHEN all_votes > 0 THEN seats ELSE 0 END - sum(sure) OVER ({part}) AS open FROM {name}_o),
{name}_e AS (
  SELECT *, unnest(range(sure + 1, CAST(floor(quota) AS BIGINT) + stray + 2)) AS seat FROM {name}_p),
{name}_r AS (
  SELECT *, row_number() OVER ({part} ORDER BY CAST({votes} AS DOUBLE) / (2 * seat - 1) DESC, {key}) AS place FROM {name}_e),
{name} AS (
  SELECT {columns}, CAST(any_value(sure) + count(*) FILTER (WHERE place <= open AND {votes} > 0) AS BIGINT) AS won
  FROM {name}_r GROUP BY {columns})"""


def oracle_sql(
    weights: Sequence[int] = WEIGHTS, epochs: int = MAX_EPOCHS, block: int = BLOCK_WORDS,
    docs_per_shard: int = DOCS_PER_SHARD, seed: int = SEED,
) -> str:
    """The mix in DuckDB SQL."""
    draw = "CAST('0x' || substr(md5({}), 1, 12) AS BIGINT)"
    shard = draw.format(f"'{seed}|' || coalesce(CAST(doc_id AS VARCHAR), '') || '|' || tie")
    shift = draw.format(f"'{seed}pick|' || coalesce(source, '') || '|' || CAST(shard AS VARCHAR)")
    return f"""
WITH sized AS (
  SELECT doc_id, source, CAST(coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0) AS BIGINT) AS size,
    md5(coalesce(text, '')) AS tie FROM documents),
per AS (
  SELECT source, CAST(sum(size) AS BIGINT) AS source_size, row_number() OVER (ORDER BY source NULLS LAST) - 1 AS pos
  FROM sized GROUP BY source),
capped AS (
  SELECT *, CAST({list(weights)}[1 + pos % {len(weights)}] AS BIGINT) AS weight, {epochs} * source_size AS cap,
    CAST(sum(source_size) OVER () AS BIGINT) AS total FROM per),
levels AS (
  SELECT *, CAST(total - coalesce(sum(cap) OVER before, 0) AS BIGINT) AS left_,
    CAST(sum(weight) OVER () - coalesce(sum(weight) OVER before, 0) AS BIGINT) AS shares
  FROM capped WINDOW before AS (ORDER BY CAST(cap AS DOUBLE) / weight, source NULLS LAST
    ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
stopped AS (SELECT *, left_ * weight > cap * shares AS stops FROM levels),
sources AS (
  SELECT source, source_size, CAST(round(total / {block}.0) AS BIGINT) AS seats,
    CASE WHEN stops THEN CAST(cap AS DOUBLE) ELSE CAST(weight * (SELECT arg_max(left_, shares) FROM stopped WHERE NOT stops) AS DOUBLE)
      / (SELECT max(shares) FROM stopped WHERE NOT stops) END AS target
  FROM stopped),
{_apportion_sql("quotas", "sources", "", "source NULLS LAST", "target", "source, source_size, target, seats").strip()},
placed AS (
  SELECT *, {shard} % CAST(ceil(count(*) OVER (PARTITION BY source) / {docs_per_shard}.0) AS BIGINT) AS shard FROM sized),
shards AS (
  SELECT s.*, q.source_size, q.target, q.won AS seats
  FROM (SELECT source, shard, CAST(sum(size) AS BIGINT) AS words FROM placed GROUP BY source, shard) s
  JOIN quotas q ON s.source IS NOT DISTINCT FROM q.source),
{_apportion_sql("cuts", "shards", "source", "shard", "words", "source, shard, words, source_size, target, seats").strip()},
plan AS (
  SELECT source, shard, source_size, target, n AS blocks, {shift} AS shift,
    CASE WHEN n > 0 THEN least(won, {epochs} * n) // n ELSE 0 END AS passes,
    CASE WHEN n > 0 THEN least(won, {epochs} * n) % n ELSE 0 END AS picks
  FROM (SELECT *, CAST(ceil(words / {block}.0) AS BIGINT) AS n FROM cuts)),
laid AS (
  SELECT *, CAST(coalesce(sum(size) OVER (PARTITION BY source, shard ORDER BY doc_id NULLS FIRST, size, tie
    ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT) AS before FROM placed)
SELECT d.doc_id, d.size, c.source_size, c.target,
  CAST(c.passes * d.size + CASE WHEN d.size > 0 THEN coalesce(list_sum([
    least((k + 1) * {block}, before + size) - greatest(k * {block}, before)
    FOR k IN range(before // {block}, (before + size - 1) // {block} + 1)
    IF (k * {STEP} + c.shift) % c.blocks < c.picks]), 0) ELSE 0 END AS BIGINT) AS taken
FROM laid d JOIN plan c ON d.source IS NOT DISTINCT FROM c.source AND d.shard = c.shard
"""
