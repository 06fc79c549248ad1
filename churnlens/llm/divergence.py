"""Source divergence audit by chunk factorization.

1. *Chunks.*  Documents are cut at white space.  Each task counts the chunks of its documents in
   blocks of about ``BLOCK_PAIRS`` chunks, repeats included, and makes one row per block, language and
   distinct chunk: occurrences by source, number of documents and, where those are fewer than the
   vocabulary threshold, which documents.  The rows are kept in buckets of language and chunk.
2. *Terms.*  Each distinct chunk of a language is tokenized once, in its bucket.
3. *Vocabulary.*  A term is in at least as many documents as its most frequent chunk and in at most as
   many as its chunks together.  Where the threshold lies between, all its chunks are rare, so the
   listed documents decide exactly.
4. *Occurrences* of kept terms are those of the chunk, once for each time that it holds the term.
5. *Divergence.*  Smoothed integer shares; pairs of sources are summed as dense blocks of
   ``BLOCK_TERMS`` terms by all sources of a language, so no row per term and pair exists.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from churnlens.llm.tables import shuffle_partitions
from churnlens.session import scratch_path

TERM = r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+"
MIN_DOCS = 30
TOP_TERMS = 50
SCALE = 1_000_000_000
PRIOR = 5
#: Chunk occurrences of a block.
BLOCK_PAIRS = 4_500_000
BLOCK_TERMS = 2048
OUT_ROWS = 50_000

CHUNK_SCHEMA = (
    "lang string, source string, chunk string, docs int, block long, in_docs array<int>, sources array<string>, times_in array<bigint>"
)


class _Codes(dict):
    """Numbers its keys as they are first looked up."""

    def __missing__(self, key) -> int:
        self[key] = code = len(self)
        return code


class _Block:
    """Chunks of a bounded run of documents."""

    def __init__(self, number: int, rare: int):
        self.number, self.rare = number, rare
        self.chunks = _Codes()
        self.langs: dict[str, int] = {}
        self.sources: dict[str, int] = {}
        self.groups: set[tuple[int, int]] = set()
        self.doc_lang: list[int] = []
        self.doc_source: list[int] = []
        self.codes: list[np.ndarray] = []
        self.words = 0

    def add(self, lang: str, source: str, text: bytes) -> None:
        at, by = self.langs.setdefault(lang, len(self.langs)), self.sources.setdefault(source, len(self.sources))
        self.groups.add((at, by))
        words = text.split()  # bytes split at 0x20 and 0x09-0x0D
        if not words:
            return
        self.codes.append(np.fromiter(map(self.chunks.__getitem__, words), np.int32, len(words)))
        self.doc_lang.append(at)
        self.doc_source.append(by)
        self.words += len(words)

    def batches(self) -> Iterator[pa.RecordBatch]:
        """A row per group, then a row per language and chunk, whose documents and sources are slices of
        the pairs in that order."""
        langs, sources, chunks = list(self.langs), list(self.sources), pa.array(list(self.chunks), pa.binary()).cast(pa.string())
        lang_names, source_names = pa.array(langs, pa.string()), pa.array(sources, pa.string())
        groups, none = sorted(self.groups), np.empty(0, np.int32)
        flat = np.zeros(len(groups) + 1, np.int32)
        yield self._batch([langs[a] for a, _ in groups], [sources[b] for _, b in groups], pa.nulls(len(groups), pa.string()), flat[1:], flat, none, flat, [], none)
        if not self.words:
            return
        # Documents in the order of language and source: a sort of each language's occurrences by chunk and
        # document then brings together a chunk's sources and documents.
        by = np.lexsort((self.doc_source, self.doc_lang))
        sizes = [len(self.codes[d]) for d in by]
        key = np.concatenate([self.codes[d] for d in by]).astype(np.int64)
        key *= len(by)
        key += np.repeat(np.arange(len(by)), sizes)
        ends = np.cumsum(sizes)[np.append(np.flatnonzero(np.diff(np.asarray(self.doc_lang)[by])), len(by) - 1)]
        for a, b in zip([0, *ends.tolist()], ends.tolist()):
            key[a:b].sort()
        pairs = np.flatnonzero(np.concatenate(([True], key[1:] != key[:-1])))
        n = np.diff(np.append(pairs, len(key)))
        code, place = np.divmod(key[pairs], len(by))
        doc = by.astype(np.int32)[place]
        source = np.asarray(self.doc_source, np.int32)[doc]
        key = np.asarray(self.doc_lang)[doc] * len(chunks) + code
        new_row = np.concatenate(([True], key[1:] != key[:-1]))
        parts = np.flatnonzero(new_row | np.concatenate(([True], source[1:] != source[:-1])))
        rows = np.flatnonzero(new_row)
        docs = np.diff(np.append(rows, len(key)))
        total = np.add.reduceat(n, parts, dtype=np.int64)
        part_at = np.append(np.searchsorted(parts, rows), len(parts))
        for a in range(0, len(rows), OUT_ROWS):
            b = min(a + OUT_ROWS, len(rows))
            held = slice(rows[a], rows[b] if b < len(rows) else len(key))
            p0, p1 = part_at[a], part_at[b]
            few = docs[a:b] < self.rare
            lang, chunk = np.divmod(key[rows[a:b]], len(chunks))
            yield self._batch(
                lang_names.take(pa.array(lang)), pa.nulls(b - a, pa.string()), chunks.take(pa.array(chunk)), docs[a:b],
                np.concatenate(([0], np.cumsum(np.where(few, docs[a:b], 0)))), doc[held][np.repeat(few, docs[a:b])],
                part_at[a : b + 1] - p0, source_names.take(pa.array(source[parts[p0:p1]])), total[p0:p1],
            )

    def _batch(self, langs, sources, chunks, docs, doc_at, in_docs, part_at, names, n) -> pa.RecordBatch:
        part_at = pa.array(part_at, pa.int32())
        return pa.RecordBatch.from_arrays([
            pa.array(langs, pa.string()), pa.array(sources, pa.string()), chunks,
            pa.array(docs, pa.int32()), pa.array(np.full(len(langs), self.number), pa.int64()),
            pa.ListArray.from_arrays(pa.array(doc_at, pa.int32()), pa.array(in_docs, pa.int32())),
            pa.ListArray.from_arrays(part_at, pa.array(names, pa.string())), pa.ListArray.from_arrays(part_at, pa.array(n, pa.int64())),
        ], ["lang", "source", "chunk", "docs", "block", "in_docs", "sources", "times_in"])


def _count_blocks(block_words: int, rare: int):
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        number = TaskContext.get().partitionId() << 32
        block = _Block(number, rare)
        for batch in batches:
            texts = batch.column(2).cast(pa.large_binary())
            for lang, source, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), texts):
                block.add(lang, source, text.as_py())
                if block.words >= block_words:
                    yield from block.batches()
                    number += 1
                    block = _Block(number, rare)
        yield from block.batches()

    return count


def chunk_counts(docs: DataFrame, min_docs: int = MIN_DOCS, block_pairs: int = BLOCK_PAIRS) -> DataFrame:
    """Chunk rows (``CHUNK_SCHEMA``) of ``docs(lang, source, text)``: per block, language and chunk; a row
    with a null chunk names a (lang, source) group of the block."""
    named = docs.select(*[F.coalesce(F.col(c), F.lit("")).alias(c) for c in ("lang", "source", "text")])
    return named.mapInArrow(_count_blocks(block_pairs, min_docs), CHUNK_SCHEMA)


def lower_ascii(text: Column) -> Column:
    """``text`` with A-Z lowered; where no other letters occur, by the plain function."""
    upper = "".join(map(chr, range(ord("A"), ord("Z") + 1)))
    return F.when(F.octet_length(text) == F.char_length(text), F.lower(text)).otherwise(F.translate(text, upper, upper.lower()))


def _written(df: DataFrame, name: str) -> DataFrame:
    spark = df.sparkSession
    path = scratch_path(spark, f"divergence-{name}")
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.parquet(path)


def _bucketed(df: DataFrame, *keys: str) -> DataFrame:
    """``df`` written in buckets of ``keys``, so that later joins and groups on them move it no more."""
    spark = df.sparkSession
    path, n = scratch_path(spark, "divergence-chunks"), shuffle_partitions(spark)
    name = path.rsplit("/", 1)[1].replace("-", "_")
    # A task writes one bucket; with a writer kept open a bucket its rows need no sort by bucket.
    writers, before = "spark.sql.maxConcurrentOutputFileWriters", spark.conf.get("spark.sql.maxConcurrentOutputFileWriters")
    spark.conf.set(writers, "8")
    try:
        df.repartition(n, *keys).write.bucketBy(n, *keys).option("path", path).saveAsTable(name)
    finally:
        spark.conf.set(writers, before)
    return spark.table(name)


def vocabulary(chunks: DataFrame, min_docs: int = MIN_DOCS) -> DataFrame:
    """``lang, chunk, term`` for every term in at least ``min_docs`` documents of its language, a row for each
    time that the chunk holds the term."""
    held = F.regexp_extract_all(lower_ascii(F.col("chunk")), F.lit(TERM), F.lit(0))
    spread = chunks.groupBy("lang", "chunk").agg(F.sum("docs").alias("docs"))  # in the buckets
    terms = _written(spread.select("lang", "chunk", "docs", F.explode(held).alias("term")), "terms")
    # A term that a chunk holds twice adds its documents twice: ``most`` is then too large, never too small.
    bounds = terms.groupBy("lang", "term").agg(F.max("docs").alias("least"), F.sum("docs").alias("most"))
    sure = bounds.where(F.col("least") >= min_docs).select("lang", "term")
    unsure = bounds.where((F.col("least") < min_docs) & (F.col("most") >= min_docs)).select("lang", "term")
    # The chunk rows stay in their buckets and unsorted: the short side is hashed, a bucket a task.
    listed = (
        chunks.where(F.col("docs") < min_docs).select("lang", "chunk", "block", "in_docs")
        .join(terms.join(unsure, ["lang", "term"]).select("lang", "chunk", "term").hint("shuffle_hash"), ["lang", "chunk"])
        .select("lang", "term", "block", F.explode("in_docs").alias("doc")).distinct()
        .groupBy("lang", "term").agg(F.count(F.lit(1)).alias("docs"))
        .where(F.col("docs") >= min_docs).select("lang", "term")
    )
    return terms.join(sure.unionAll(listed), ["lang", "term"]).select("lang", "chunk", "term")


def _share(count: Column, total: Column, terms: Column) -> Column:
    """1 + floor(SCALE (count + PRIOR) / (total + PRIOR terms)), exact in integers of 38 digits."""
    whole = (count + F.lit(PRIOR)).cast("decimal(20,0)") * F.lit(SCALE).cast("decimal(10,0)")
    return F.lit(1).cast("long") + F.call_function("div", whole, (total + F.lit(PRIOR) * terms).cast("decimal(20,0)"))


DIV_SCHEMA = "lang string, source string, item string, value long"


def _pair_sums(key, table):
    """L1 distances of all pairs of sources over one block of terms; rows without a term carry the
    share of a term that the source does not hold."""
    sources, terms, shares = (table.column(c).to_pylist() for c in ("source", "term", "p"))
    names = [s for s, t in zip(sources, terms) if t is None]
    at, row = {s: i for i, s in enumerate(names)}, {}
    for t in terms:
        if t is not None:
            row.setdefault(t, len(row))
    base = np.zeros(len(names), np.int64)
    for s, t, p in zip(sources, terms, shares):
        if t is None:
            base[at[s]] = p
    grid = np.tile(base, (len(row), 1))
    for s, t, p in zip(sources, terms, shares):
        if t is not None:
            grid[row[t], at[s]] = p
    left, right, value = [], [], []
    for i in range(len(names) - 1):
        left += [names[i]] * (len(names) - i - 1)
        right += names[i + 1 :]
        value.append(np.abs(grid[:, i + 1 :] - grid[:, i : i + 1]).sum(axis=0))
    values = np.concatenate(value) if value else np.empty(0, np.int64)
    return pa.table({
        "lang": pa.array([key[0].as_py()] * len(left), pa.string()), "source": pa.array(left, pa.string()),
        "item": pa.array(right, pa.string()), "value": pa.array(values, pa.int64()),
    })


def audit(
    docs: DataFrame, min_docs: int = MIN_DOCS, top: int = TOP_TERMS, block_pairs: int = BLOCK_PAIRS,
    block_terms: int = BLOCK_TERMS,
) -> DataFrame:
    """``lang, source, part, item, value, rank`` of ``docs(text, lang, source)``.

    Null text, lang and source count as ''.  Every row is a document, repeated rows included.  Texts
    without terms still name their group.  A language without kept terms has pairs of value 0.  Ties of
    value rank by item in code point order.  Other columns are not read.  Empty table: no rows."""
    blocks = _bucketed(chunk_counts(docs, min_docs, block_pairs), "lang", "chunk")
    groups = blocks.where("chunk IS NULL").select("lang", "source").distinct()
    chunks = blocks.where("chunk IS NOT NULL").drop("source")
    kept = _written(vocabulary(chunks, min_docs), "kept")
    counts = _written(
        chunks.select("lang", "chunk", "sources", "times_in").join(kept.hint("shuffle_hash"), ["lang", "chunk"])
        .select("lang", "term", F.inline(F.arrays_zip("sources", "times_in")))
        .groupBy("lang", F.col("sources").alias("source"), "term").agg(F.sum("times_in").alias("n")),
        "counts",
    )
    size = kept.select("lang", "term").distinct().groupBy("lang").agg(F.count(F.lit(1)).alias("terms"))
    held = counts.groupBy("lang", "source").agg(F.sum("n").alias("held"))
    of_lang = held.groupBy("lang").agg(F.sum("held").alias("lang_held"))
    totals = groups.join(size, "lang", "left").join(held, ["lang", "source"], "left").join(of_lang, "lang", "left").select(
        "lang", "source", *[F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in ("terms", "held", "lang_held")]
    )
    totals = _written(totals, "totals")

    shares = counts.join(totals, ["lang", "source"]).withColumn("p", _share(F.col("n"), F.col("held"), F.col("terms")))
    whole = counts.groupBy("lang", "term").agg(F.sum("n").alias("in_lang"))
    above = (
        shares.join(whole, ["lang", "term"])
        .withColumn("value", F.col("p") - _share(F.col("in_lang"), F.col("lang_held"), F.col("terms")))
        .where("n > 0 AND value > 0").select("lang", "source", F.col("term").alias("item"), "value")
    )
    ranked = Window.partitionBy("lang", "source").orderBy(F.col("value").desc(), F.col("item").asc())
    term_part = above.withColumn("rank", F.row_number().over(ranked)).where(F.col("rank") <= top).select(
        "lang", "source", F.lit("term").alias("part"), "item", "value", "rank"
    )

    blocks_of = F.ceil(F.col("terms") / F.lit(block_terms))
    dealt = shares.select("lang", "source", "term", "p", F.pmod(F.xxhash64("term"), blocks_of).alias("block"))
    absent = totals.where("terms > 0").select(
        "lang", "source", F.lit(None).cast("string").alias("term"),
        _share(F.lit(0).cast("long"), F.col("held"), F.col("terms")).alias("p"),
        F.explode(F.sequence(F.lit(0).cast("long"), blocks_of - 1)).alias("block"),
    )
    sums = dealt.unionByName(absent).groupBy("lang", "block").applyInArrow(_pair_sums, DIV_SCHEMA)
    ones = sums.groupBy("lang", "source", "item").agg(F.sum("value").alias("value"))
    both = ones.select("lang", F.explode(F.array(
        F.struct(F.col("source").alias("source"), F.col("item").alias("item")),
        F.struct(F.col("item").alias("source"), F.col("source").alias("item")),
    )).alias("pair"), "value").select("lang", "pair.source", "pair.item", "value")
    # A language without a kept term: its sources differ by nothing.
    bare = totals.where("terms = 0").select("lang", "source")
    bare = bare.join(bare.select("lang", F.col("source").alias("item")), "lang").where("source <> item").select(
        "lang", "source", "item", F.lit(0).cast("long").alias("value")
    )
    pair_part = both.unionByName(bare).withColumn("rank", F.row_number().over(ranked)).select(
        "lang", "source", F.lit("pair").alias("part"), "item", "value", "rank"
    )
    return pair_part.unionByName(term_part)


def oracle_sql(min_docs: int = MIN_DOCS, top: int = TOP_TERMS) -> str:
    """The audit in DuckDB SQL, term by term and without chunks."""
    upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    share = f"1 + CAST({SCALE} AS HUGEINT) * ({{n}} + {PRIOR}) // ({{held}} + {PRIOR} * terms)"
    return f"""
WITH d AS (
  SELECT row_number() OVER () AS doc, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
    unnest(list_concat([NULL], regexp_extract_all(coalesce(text, ''), '{TERM}'))) AS word FROM documents),
w AS (SELECT doc, lang, source, translate(word, '{upper}', '{upper.lower()}') AS term FROM d WHERE word IS NOT NULL),
kept AS (SELECT lang, term FROM w GROUP BY ALL HAVING count(DISTINCT doc) >= {min_docs}),
size AS (SELECT lang, count(*) AS terms FROM kept GROUP BY lang),
counts AS (SELECT lang, source, term, count(*) AS n FROM w SEMI JOIN kept USING (lang, term) GROUP BY ALL),
groups AS (SELECT DISTINCT lang, source FROM d),
totals AS (
  SELECT g.lang, g.source, coalesce(s.terms, 0) AS terms,
    coalesce((SELECT sum(n) FROM counts c WHERE c.lang = g.lang AND c.source = g.source), 0) AS held,
    coalesce((SELECT sum(n) FROM counts c WHERE c.lang = g.lang), 0) AS lang_held
  FROM groups g LEFT JOIN size s ON g.lang = s.lang),
grid AS (
  SELECT t.lang, t.source, k.term, coalesce(c.n, 0) AS n, terms,
    {share.format(n="coalesce(c.n, 0)", held="held")} AS p, lang_held
  FROM totals t JOIN kept k ON t.lang = k.lang
  LEFT JOIN counts c ON c.lang = t.lang AND c.source = t.source AND c.term = k.term),
whole AS (SELECT lang, term, sum(n) AS n FROM counts GROUP BY ALL),
term_part AS (
  SELECT g.lang, g.source, 'term' AS part, g.term AS item,
    g.p - ({share.format(n="w.n", held="g.lang_held").replace("terms", "g.terms")}) AS value
  FROM grid g JOIN whole w ON g.lang = w.lang AND g.term = w.term WHERE g.n > 0),
pair_part AS (
  SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(s.value, 0) AS value
  FROM groups a JOIN groups b ON a.lang = b.lang AND a.source <> b.source
  LEFT JOIN (SELECT x.lang, x.source, y.source AS item, sum(abs(x.p - y.p)) AS value
    FROM grid x JOIN grid y ON x.lang = y.lang AND x.term = y.term AND x.source <> y.source GROUP BY ALL) s
  ON s.lang = a.lang AND s.source = a.source AND s.item = b.source)
SELECT lang, source, part, item, CAST(value AS BIGINT) AS value,
  CAST(row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS INTEGER) AS rank
FROM (SELECT * FROM term_part WHERE value > 0 UNION ALL SELECT * FROM pair_part)
QUALIFY part = 'pair' OR rank <= {top}
"""
