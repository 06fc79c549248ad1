"""SimHash, substring de-duplication, byte BPE and mixing against brute force."""

import hashlib
import re
from collections import defaultdict

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from churnlens.llm import bpe, mixing, queries, simhash, substring, words

WORD = re.compile(r"[^\x20\x09-\x0D]+")

from .conftest import SF


def _docs(df):
    return [(r["doc_id"], r["text"]) for r in df.select("doc_id", "text").collect()]


def _slow_simhash(text):
    ws = WORD.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))
    if not ws:
        return 0
    sh = [" ".join(ws[i : i + 3]) for i in range(len(ws) - 2)] or [" ".join(ws)]
    h = [xxhash.xxh64_intdigest(s.encode(), 42) for s in sh]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def _components(keys, linked):
    parent = {k: k for k in keys}

    def find(x):
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    for a, b in linked:
        a, b = find(a), find(b)
        parent[max(a, b)] = min(a, b)
    return {k: find(k) for k in keys}


def _slow_near(docs):
    fps = [(i, _slow_simhash(t)) for i, t in docs]
    u = sorted({f for _, f in fps})
    comp = _components(u, [(a, b) for i, a in enumerate(u) for b in u[i + 1 :] if (a ^ b).bit_count() <= 2])
    least = {}
    for i, f in fps:
        if i is not None:
            least[comp[f]] = min(i, least.get(comp[f], i))
    return sorted(((i, f"{f:016x}", least.get(comp[f])) for i, f in fps), key=str)


@pytest.mark.parametrize("group_rows", [128, 1])
def test_simhash_equals_brute_force(documents, odd, group_rows):
    for df in (odd, documents):
        got = simhash.near_duplicates(df, group_rows=group_rows)
        rows = got.select("doc_id", simhash.hex_fingerprint("fp").alias("f"), "component_id").collect()
        assert sorted((tuple(r) for r in rows), key=str) == _slow_near(_docs(df))


def test_near_duplicate_stage_keeps_one_row_of_each_component(spark, documents):
    import corpus_pipeline

    x, y, z = (" ".join(f"{c}{i}" for i in range(40)) for c in "xyz")
    rows = [(1, x), (5, x), (5, y), (5, z), (5, z), (None, x), (None, "only " + y[::-1]), (None, "only " + y[::-1]), (7, z)]
    got = corpus_pipeline.near_duplicate_stage(spark, spark.createDataFrame(rows, "doc_id long, text string"), "").collect()
    assert sorted(map(str, map(tuple, got))) == sorted(map(str, [(1, x), (5, y), (5, z), (None, "only " + y[::-1])]))
    want = simhash.near_duplicates(documents).where("doc_id = component_id").select("doc_id").collect()
    kept = corpus_pipeline.near_duplicate_stage(spark, documents, "")
    assert kept.columns == documents.columns
    assert sorted(r["doc_id"] for r in kept.collect()) == sorted(r["doc_id"] for r in want)


def test_simhash_links_of_a_dense_group(spark):
    rng = np.random.default_rng(1)
    base = [int(x) for x in rng.integers(0, 2**63, 3)]
    fps = {b ^ (1 << int(i)) ^ (1 << int(j)) ^ (1 << int(k)) for b in base for i, j, k in rng.integers(0, 64, (200, 3))}
    signed = [x - 2**64 if x >= 2**63 else x for x in fps]
    df = spark.createDataFrame([(x,) for x in signed], "fp long")
    for bits in (0, 1, 2):
        want = _components(signed, [(a, b) for i, a in enumerate(signed) for b in signed[i + 1 :] if ((a ^ b) & (2**64 - 1)).bit_count() <= bits])
        for rows in (4, 10**6):
            pairs = [(r["a"], r["b"]) for r in simhash.links(df, bits, rows).collect()]
            assert all(((a ^ b) & (2**64 - 1)).bit_count() <= bits for a, b in pairs)
            assert _components(signed, pairs) == want


def test_xxh64_matches_the_library():
    rng = np.random.default_rng(0)
    raw = rng.integers(33, 127, 4000, dtype=np.uint8)
    starts = rng.integers(0, 3900, 500)
    ends = starts + rng.integers(0, 80, 500)
    got = words.xxh64(raw, starts, ends, 42)
    assert got.tolist() == [xxhash.xxh64_intdigest(raw[a:b].tobytes(), 42) for a, b in zip(starts, ends)]


def _slow_substring(docs, w=13):
    where = defaultdict(set)
    lists = [(i, WORD.findall(t or "")) for i, t in docs]
    for i, ws in lists:
        for p in range(len(ws) - w + 1):
            where[tuple(ws[p : p + w])].add(i)
    out = []
    for i, ws in lists:
        gone = set()
        for p in range(len(ws) - w + 1):
            if any(j is not None and (i is None or j < i) for j in where[tuple(ws[p : p + w])]):
                gone.update(range(p, p + w))
        kept = " ".join(x for k, x in enumerate(ws) if k not in gone)
        out.append((i, len(ws), len(gone), hashlib.sha256(kept.encode()).hexdigest()))
    return sorted(out, key=str)


def test_substring_equals_brute_force(documents, odd):
    for df in (odd, documents):
        rows = substring.deduplicate(df.select("doc_id", "text"), with_text=True).collect()
        got = sorted(((r["doc_id"], r["n_words"], r["n_removed"], r["kept_sha256"]) for r in rows), key=str)
        assert got == _slow_substring(_docs(df))
        assert all(sum(s["words"] for s in r["spans"]) == r["n_removed"] for r in rows)
        texts = defaultdict(set)
        for i, t in _docs(df):
            texts[i].add(t or "")
        assert all(r["kept_text"] in texts[r["doc_id"]] for r in rows if not r["n_removed"])


def test_substring_carries_columns(odd):
    rows = substring.deduplicate(odd, with_text=True)
    assert rows.columns == [*[c for c in odd.columns if c != "text"], "n_words", "n_removed", "spans", "kept_sha256", "kept_text"]
    assert sorted(str(r["bucket"]) + str(r["source"]) for r in rows.collect()) == sorted("x" + str(r["source"]) for r in odd.collect())


def _tiktoken():
    import base64

    import public_tokenizers as p
    import tiktoken

    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(queries.vocabulary(), "rb"))}
    return tiktoken.Encoding("own", pat_str=p.PATTERN, mergeable_ranks=ranks, special_tokens={})


def _bpe_rows(docs):
    lib = _tiktoken()
    out = []
    for i, t in docs:
        ids = lib.encode_ordinary(t or "")
        out.append((i, len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(), hashlib.sha256((t or "").encode()).hexdigest()))
    return sorted(out, key=str)


def test_bpe_equals_the_library(documents, odd):
    for df in (odd, documents):
        got = bpe.round_trip(df, queries.vocabulary()).collect()
        assert sorted((tuple(r) for r in got), key=str) == _bpe_rows(_docs(df))


def test_bpe_offsets_and_decoding(odd):
    enc = bpe.encode(odd, queries.vocabulary())
    for r in enc.collect():
        assert len(r["offsets"]) == len(r["ids"]) + 1
    got = bpe.decode(enc, queries.vocabulary()).collect()
    assert sorted((str(r["doc_id"]), bytes(r["raw"])) for r in got) == sorted((str(i), (t or "").encode()) for i, t in _docs(odd))


def test_bpe_slices_random_text():
    import public_tokenizers as p
    import regex

    rng = np.random.default_rng(5)
    alphabet = list("ab1 '\t\nstrevlmd!é½　你\x1c\x85") + ["'s", "'re", "'ll", "  ", " '"]
    texts = ["".join(rng.choice(alphabet, rng.integers(0, 60))) for _ in range(3000)]
    got, first = bpe.pieces(texts)
    for k, t in enumerate(texts):
        assert got[first[k] : first[k + 1]] == regex.findall(p.PATTERN, t), repr(t)


def test_bpe_long_merges():
    enc = bpe.encoder(queries.vocabulary())
    rng = np.random.default_rng(6)
    for _ in range(20):
        ids = [enc.byte_ids[b] for b in rng.choice(np.frombuffer(b"thenaioust", np.uint8), 300)]
        short = enc._merge_long(list(ids))
        none = 1 << 30
        slow = list(ids)
        while True:
            ranks = [enc.pairs.get(a << 20 | b, none) for a, b in zip(slow, slow[1:])]
            if not ranks or min(ranks) == none:
                break
            i = ranks.index(min(ranks))
            slow[i : i + 2] = [ranks[i]]
        assert short == slow


def test_bpe_classes_match_the_library():
    lib = _tiktoken()
    import public_tokenizers as p
    import regex

    table = bpe._classes()
    for pattern, kind in ((r"\p{L}", bpe._LETTER), (r"\p{N}", bpe._NUMBER), (r"\s", bpe._INNER)):
        got = {i for i in range(0x110000) if table[i] == kind and not 0xD800 <= i < 0xE000}
        rx = regex.compile(pattern, regex.V1)
        want = {i for i in range(0x110000) if not 0xD800 <= i < 0xE000 and rx.match(chr(i))}
        odd_ones = got ^ want  # code points of a newer Unicode version at most
        for i in sorted(odd_ones)[:200]:
            text = f"a{chr(i)}b"
            assert bpe.encoder(queries.vocabulary()).encode([text])[0] == np.array(lib.encode_ordinary(text), "<u4").tobytes(), hex(i)
    assert p.PATTERN


def _duck(con, df, name):
    con.register("documents", df.toPandas())
    return con.sql(queries.ORACLES[name])


def _norm(rows):
    return sorted((tuple(repr(v) for v in r) for r in rows))


def test_mix_equals_sql(documents, odd, spark):
    import duckdb

    for df in (documents, odd.drop("size", "score", "bucket")):
        con = duckdb.connect()
        con.execute("CREATE TABLE documents(doc_id BIGINT, text VARCHAR, lang VARCHAR, source VARCHAR, n_chars BIGINT)")
        con.executemany("INSERT INTO documents VALUES (?, ?, ?, ?, ?)", [tuple(r[c] for c in ("doc_id", "text", "lang", "source", "n_chars")) for r in df.collect()])
        rel = con.sql(queries.ORACLES["op6_source_mix"])
        cols = ["doc_id", "size", "source_size", "target", "taken"]
        assert list(rel.columns) == cols
        assert _norm(tuple(r) for r in mixing.mix_plan(df).select(*cols).collect()) == _norm(rel.fetchall())


def _slow_targets(sizes, weights=(5, 2, 1)):
    names = sorted(sizes, key=lambda s: (s is None, s or ""))
    w = {s: weights[i % 3] for i, s in enumerate(names)}
    total, fixed = sum(sizes.values()), {}
    while True:
        free = [s for s in names if s not in fixed]
        if not free:
            return fixed
        left = total - sum(fixed.values())
        share = {s: left * w[s] / sum(w[x] for x in free) for s in free}
        over = [s for s in free if share[s] > 3 * sizes[s]]
        if not over:
            return fixed | share
        fixed |= {s: 3.0 * sizes[s] for s in over}


def test_mix_targets_quotas_and_bounds(documents, odd):
    for df in (documents, odd):
        rows = mixing.mix_plan(df).collect()
        sizes, taken, target = defaultdict(int), defaultdict(int), {}
        for r in rows:
            sizes[r["source"]] += r["size"]
            taken[r["source"]] += r["taken"]
            target[r["source"]] = r["target"]
            assert 0 <= r["taken"] <= 3 * r["size"]
        want = _slow_targets(sizes)
        for s, t in want.items():
            assert target[s] == pytest.approx(t)
            assert abs(taken[s] - t) <= 3 * mixing.BLOCK_WORDS, (s, taken[s], t)
        again = mixing.mix_plan(df.repartition(7)).collect()
        key = lambda r: (str(r["doc_id"]), str(r["source"]), r["size"], r["taken"])
        assert sorted(map(key, rows)) == sorted(map(key, again))


def test_apportion_equals_highest_quotients(spark):
    import heapq

    from pyspark.sql import functions as F

    rng = np.random.default_rng(2)
    votes = [("a", i, int(v)) for i, v in enumerate(rng.integers(0, 1000, 30))] + [("b", 0, 5000), *[("b", i, 3) for i in range(1, 15)], ("c", 0, 0)]
    df = spark.createDataFrame(votes, "house string, k int, v long").withColumn("seats", F.lit(137).cast("long"))
    got = {(r["house"], r["k"]): r["won"] for r in mixing.apportion(df, ["house"], F.col("k").asc(), "v", "seats").collect()}
    for house in "abc":
        heap = [(-v / 1, k, 1, v) for h, k, v in votes if h == house and v]
        heapq.heapify(heap)
        won = defaultdict(int)
        for _ in range(137 if heap else 0):
            _, k, s, v = heapq.heappop(heap)
            won[k] += 1
            heapq.heappush(heap, (-v / (2 * s + 1), k, s + 1, v))
        assert {k: got[house, k] for h, k, _ in votes if h == house} == {k: won[k] for h, k, _ in votes if h == house}


def test_mixed_documents_hold_the_words_taken(documents, odd):
    for df in (documents, odd):
        plan, want = mixing.mix_plan(df).collect(), defaultdict(int)
        for r in plan:
            want[r["doc_id"]] += r["taken"]
        out = mixing.mixed_documents(df)
        assert out.columns == df.columns
        got = defaultdict(int)
        for r in out.collect():
            assert r["n_chars"] == len(r["text"])
            got[r["doc_id"]] += len(WORD.findall(r["text"]))
        assert {k: v for k, v in got.items() if v} == {k: v for k, v in want.items() if v}


@pytest.mark.parametrize("weights", [(5, 2, 1), (50, 50, 1)])
def test_mixed_documents_of_a_small_source_beside_large_ones(spark, weights):
    short, long = " ".join(["w"] * 20), " ".join(["v"] * 40)
    rows = [(i, short, "small") for i in range(64)] + [(i, long, "ab"[i % 2]) for i in range(64, 1064)]
    rows += [(i, short, None) for i in range(2000, 2064)]
    sizes = {"a": 20000, "b": 20000, "small": 1280, None: 1280}
    got = defaultdict(int)
    for r in mixing.mixed_documents(spark.createDataFrame(rows, "doc_id long, text string, source string"), weights=weights, docs_per_shard=32).collect():
        got[r["source"]] += len(r["text"].split())
    for s, t in _slow_targets(sizes, weights).items():
        assert abs(got[s] - t) <= max(3 * mixing.BLOCK_WORDS, 0.02 * t), (s, got[s], t)  # half a block of each of many shards


def test_empty_tables(nothing):
    assert simhash.near_duplicates(nothing).count() == 0
    assert substring.deduplicate(nothing, with_text=True).count() == 0
    assert bpe.round_trip(nothing, queries.vocabulary()).count() == 0
    assert mixing.mix_plan(nothing).count() == 0
    assert mixing.mixed_documents(nothing).count() == 0


def test_registered_queries_read_the_whole_table(spark, documents):
    for name in ("op2_simhash_dedup", "op4_substring_dedup", "op5_byte_bpe", "op6_source_mix"):
        got = [r["doc_id"] for r in queries.QUERIES[name](spark, SF).select("doc_id").collect()]
        assert sorted(got) == sorted(r["doc_id"] for r in documents.select("doc_id").collect())


def test_small_source_beside_many_shards_reaches_its_target(spark):
    large = spark.range(20_000).selectExpr("id AS doc_id", "repeat('w ', 100) AS text", "'a' AS source")
    small = spark.range(400).selectExpr("id + 100000 AS doc_id", "repeat('v ', 20) AS text", "'b' AS source")
    unnamed = spark.range(3000).selectExpr("CAST(NULL AS BIGINT) AS doc_id", "concat('u', id) AS text", "'c' AS source")
    rows = mixing.mix_plan(large.unionByName(small).unionByName(unnamed), docs_per_shard=40)
    got = {r["source"]: r for r in rows.groupBy("source").agg(F.sum("taken").alias("taken"), F.first("target").alias("target")).collect()}
    assert got["b"]["target"] == 24_000 and got["b"]["taken"] >= 0.95 * 24_000
    assert abs(got["a"]["taken"] / got["a"]["target"] - 1) < 0.02
    # Rows without an id spread over the shards of their source.
    assert rows.where("source = 'c'").groupBy("shift").count().agg(F.max("count")).first()[0] < 100
