"""Document fingerprints by threshold-scaled sketches (DataFrame functions only).

A sketch holds every distinct hash of a five-word shingle that lies below a fixed fraction of the hash
range.  Which hashes stay does not depend on the document, so the sketch of a union is the union of
the sketches, and the share of one sketch that lies in another estimates containment between texts
of any lengths.  A text whose hashes all lie above the threshold keeps its least one, so that no text
with words has an empty sketch; ``merge`` drops such a stand-in where the union has a proper hash.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from churnlens.session import scratch_path

SHINGLE = 5
FRACTION = 1 / 8
#: Hashes are the first 60 bits of MD5, so they fit a long and read alike in every engine.
DIGITS = 15
SPACES = r"[\x20\x09-\x0D]+"


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once."""
    return F.element_at(F.transform(F.array(value), body), 1)


def threshold(fraction: float = FRACTION) -> int:
    return int(fraction * 16**DIGITS)


def _below(hashes: Column, fraction: float) -> Column:
    """Hashes below the threshold; of hashes that are all above it, the least."""
    return _let(F.filter(hashes, lambda h: h < F.lit(threshold(fraction))), lambda low: F.when(
        (F.size(low) > 0) | (F.size(hashes) == 0), F.array_sort(F.array_distinct(low))
    ).otherwise(F.array(F.array_min(hashes))))


def sketch(text: Column, shingle: int = SHINGLE, fraction: float = FRACTION) -> Column:
    """Ascending distinct hashes (array of long) of the shingles of ``text``; a text of fewer words is
    one shingle, a text without words has none."""

    def number(s: Column) -> Column:
        return F.conv(F.substring(F.md5(s), 1, DIGITS), 16, 10).cast("long")

    def hashes(words: Column) -> Column:
        n = F.size(words)
        windows = F.transform(
            F.sequence(F.lit(1), n - (shingle - 1)), lambda i: number(F.array_join(F.slice(words, i, shingle), " "))
        )
        return (
            F.when(n >= shingle, windows)
            .when(n > 0, F.array(number(F.array_join(words, " "))))
            .otherwise(F.array().cast("array<bigint>"))
        )

    words = F.filter(F.split(text, SPACES, -1), lambda w: w != "")
    return _let(_let(words, hashes), lambda h: _below(h, fraction))


def merge(a: Column, b: Column, fraction: float = FRACTION) -> Column:
    """The sketch of the union of both shingle sets."""
    return _let(F.array_union(a, b), lambda h: _below(h, fraction))


def containment(a: Column, b: Column) -> Column:
    """Estimated share of a's shingles that b holds; an empty sketch is in an empty one alone."""
    return F.when(F.size(a) > 0, F.size(F.array_intersect(a, b)) / F.size(a)).otherwise(
        (F.size(b) == 0).cast("double")
    )


def as_text(hashes: Column) -> Column:
    return F.array_join(F.transform(hashes, lambda h: F.lpad(F.lower(F.hex(h)), DIGITS, "0")), ",")


def following(keys: DataFrame, *order: str) -> DataFrame:
    """``keys`` with ``next``, the struct of ``order`` of the next row in ascending order, nulls first;
    the last row is followed by the first.

    Rows are range-partitioned, written with their partition and led inside it; only the first row of
    each partition meets the other partitions', so the one unpartitioned window has a row a partition."""
    spark = keys.sparkSession
    path = scratch_path(spark, "following")
    dealt = keys.repartitionByRange(*[F.col(c).asc_nulls_first() for c in order])
    dealt.withColumn("_part", F.spark_partition_id()).write.parquet(path)
    rows = spark.read.parquet(path)
    row = F.struct(*order)
    inside = Window.partitionBy("_part").orderBy(*[F.col(c).asc_nulls_first() for c in order])
    firsts = rows.groupBy("_part").agg(F.min(row).alias("_first"))
    across = Window.partitionBy(F.lit(1)).orderBy("_part")
    everywhere = across.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    after = firsts.select("_part", F.coalesce(F.lead("_first").over(across), F.first("_first").over(everywhere)).alias("_after"))
    led = rows.withColumn("_next", F.lead(row).over(inside)).join(F.broadcast(after), "_part")
    return led.select(*keys.columns, F.coalesce("_next", "_after").alias("next"))


def edited_pairs(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = SHINGLE, fraction: float = FRACTION
) -> DataFrame:
    """One row per document: its sketch and that of its edited text, whose last half is the beginning
    of the next document, with the containment of the document in the edited text and in the next.

    Columns ``doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next``.
    A null text is an empty one.  Ids ascend, null first; rows of one id follow in the order of the MD5
    of id and text, and rows that are equal in both are one document in that order, though each is
    returned.  One document follows itself.  Empty table: no rows.  Other columns are not read."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    name = F.coalesce(F.col(id_col).cast("string"), F.lit(""))
    # The id stands in the key, so that both joins below want the same columns and share one exchange.
    key = F.concat(F.md5(F.concat(name, F.lit(":"), text)), name)
    whole = docs.select(key.alias("key"), text.alias("text"), sketch(text, shingle, fraction).alias("sketch"))
    narrow = docs.select(F.col(id_col).alias("doc_id"), key.alias("key"), F.length(text).cast("long").alias("n")).distinct()
    links = following(narrow, "doc_id", "key").select(
        F.col("key").alias("own_key"), F.expr("n div 2").cast("int").alias("half"), F.col("next.key").alias("key")
    )
    # The part of the next document that is needed, once for each key however often that document stands.
    ahead = (
        whole.join(links, "key")
        .select("own_key", F.left("text", F.col("half")).alias("head"), F.col("sketch").alias("next_sketch"))
        .groupBy(F.col("own_key").alias("key")).agg(F.first("head").alias("head"), F.first("next_sketch").alias("next_sketch"))
    )
    n = F.length("text").cast("long")
    doc_id = F.when(F.length("key") > 32, F.expr("substring(key, 33)")).cast(docs.schema[id_col].dataType)
    both = whole.join(ahead, "key").select(
        doc_id.alias("doc_id"), n.alias("n_chars"), "sketch", "next_sketch",
        F.concat(F.left("text", n - F.floor(n / 2)), F.col("head")).alias("edited"),
    )
    both = both.withColumn("edited_sketch", sketch(F.col("edited"), shingle, fraction))
    return both.select(
        "doc_id", "n_chars", F.sha2("edited", 256).alias("edited_sha256"),
        as_text(F.col("sketch")).alias("fingerprint"), as_text(F.col("edited_sketch")).alias("edited_fingerprint"),
        containment(F.col("sketch"), F.col("edited_sketch")).alias("near_edited"),
        containment(F.col("sketch"), F.col("next_sketch")).alias("near_next"),
    )


def oracle_sql(shingle: int = SHINGLE, fraction: float = FRACTION) -> str:
    """The same table in DuckDB SQL."""
    limit = f"{threshold(fraction):0{DIGITS}x}"

    def hashes(words: str) -> str:
        whole = "md5(array_to_string({}, ' '))[:{}]"
        return (
            f"CASE WHEN len({words}) >= {shingle} THEN [{whole.format(f'{words}[i:i + {shingle - 1}]', DIGITS)} "
            f"FOR i IN range(1, len({words}) - {shingle - 2})] "
            f"WHEN len({words}) > 0 THEN [{whole.format(words, DIGITS)}] ELSE [] END"
        )

    def low(h: str) -> str:
        kept = f"[x FOR x IN {h} IF x < '{limit}']"
        return (
            f"CASE WHEN len({h}) = 0 THEN [] WHEN len({kept}) > 0 THEN list_sort(list_distinct({kept})) "
            f"ELSE [list_min({h})] END"
        )

    def words(text: str) -> str:
        return f"regexp_extract_all({text}, '[^\\x20\\x09-\\x0D]+')"

    def near(a: str, b: str) -> str:
        return (
            f"CASE WHEN len({a}) > 0 THEN len(list_intersect({a}, {b})) / CAST(len({a}) AS DOUBLE) "
            f"ELSE CAST(len({b}) = 0 AS DOUBLE) END"
        )

    return f"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS text, md5(coalesce(CAST(doc_id AS VARCHAR), '') || ':' || coalesce(text, '')) AS key FROM documents),
u AS (SELECT DISTINCT doc_id, key, text FROM d),
n AS (
  SELECT *, coalesce(lead(text) OVER (ORDER BY doc_id NULLS FIRST, key), first_value(text) OVER (ORDER BY doc_id NULLS FIRST, key)) AS follows
  FROM u),
e AS (
  SELECT *, left(text, length(text) - length(text) // 2) || left(follows, length(text) // 2) AS edited FROM n),
w AS (SELECT *, {words("text")} AS ws, {words("edited")} AS es, {words("follows")} AS fs FROM e),
h AS (SELECT *, {hashes("ws")} AS wh, {hashes("es")} AS eh, {hashes("fs")} AS fh FROM w),
s AS (SELECT *, {low("wh")} AS a, {low("eh")} AS b, {low("fh")} AS c FROM h)
SELECT d.doc_id, length(s.text) AS n_chars, sha256(s.edited) AS edited_sha256,
  array_to_string(a, ',') AS fingerprint, array_to_string(b, ',') AS edited_fingerprint,
  {near("a", "b")} AS near_edited, {near("a", "c")} AS near_next
FROM d JOIN s ON d.key = s.key
"""
