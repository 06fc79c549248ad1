"""Conversation repair, document fingerprints and source divergence against brute force and SQL."""

import hashlib
import itertools
import random
import re
import zlib

import duckdb
import pandas as pd
import pytest

from churnlens.llm import conversations, divergence, fingerprint, queries

from .conftest import ODD_TEXTS, SF

GRAMMAR = re.compile("(s?(ua)+)?")


def _sql(sql, **tables):
    con = duckdb.connect()
    for name, t in tables.items():
        if isinstance(t, str):
            con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{t}')")
        else:
            con.register(name, t)
    rel = con.sql(sql)
    return sorted(rel.columns), sorted((tuple(map(repr, (r[rel.columns.index(c)] for c in sorted(rel.columns)))) for r in rel.fetchall()))


def _spark(df):
    return sorted(df.columns), sorted(tuple(repr(r[c]) for c in sorted(df.columns)) for r in df.collect())


# --- conversations -------------------------------------------------------------------------------

def _every_repair(initials, kinds, most_inserts):
    """All edit sequences with few inserts that end in the grammar, cheapest and ASCII-least."""
    best = []
    for edits in itertools.product("DKua", repeat=len(kinds)):  # u, a: rerole to it
        for gaps in itertools.product(["", "u", "a", "ua", "au"], repeat=len(kinds) + 1):
            if sum(map(len, gaps)) > most_inserts:
                continue
            cost, audit, out = 3 * sum(map(len, gaps)), "I" * len(gaps[0]), gaps[0]
            for i, e in enumerate(edits):
                if e == "D":
                    cost += 4
                elif kinds[i] == "x" or e == initials[i]:
                    break
                else:
                    cost += (e != "K") * 3 + 3 * (kinds[i] == "t")
                    out += initials[i] if e == "K" else e
                    if e == "K" and not initials[i]:
                        break
                audit += e if e in "DK" else "R"
                audit, out = audit + "I" * len(gaps[i + 1]), out + gaps[i + 1]
            else:
                if GRAMMAR.fullmatch(out):
                    best.append((cost, audit))
    return min(best)


def test_alignment_equals_every_repair():
    rng = random.Random(3)
    for _ in range(60):
        n = rng.randint(1, 3)
        initials, kinds = [rng.choice("suasuax") for _ in range(n)], "".join(rng.choice("..tx") for _ in range(n))
        cost, audit, state = conversations.align(initials, kinds, conversations.START, conversations.CLOSING)
        assert (cost, audit + "I" * (conversations.CLOSING[state] // 3)) == _every_repair(initials, kinds, 4), (initials, kinds)


def _by_state(roles, texts, kinds):
    """Turn by turn: the cheapest repair that ends in each state."""
    best = {"": (0, "", [])}

    def better(states, state, entry):
        if state not in states or entry < states[state]:
            states[state] = entry

    def pushed(states):
        for _ in range(2):
            for s, (c, a, o) in list(states.items()):
                t = "a" if s == "u" else "u"
                better(states, t, (c + 3, a + "I", o + [conversations.ROLE[t] + ":"]))
        return states

    for role, text, kind in zip(roles, texts, kinds):
        new, extra = {}, 3 * (kind == "t")
        for s, (c, a, o) in pushed(dict(best)).items():
            want = "a" if s == "u" else "u"
            if kind != "x":
                for t in {want, "s"} if s == "" else {want}:
                    if role[:1] == t:
                        better(new, t, (c + extra, a + "K", o + [f"{role}:{text}"]))
                if role[:1] != want:
                    better(new, want, (c + extra + 3, a + "R", o + [f"{conversations.ROLE[want]}:{text}"]))
        for s, (c, a, o) in best.items():  # an insert before a deleted row can stand after it
            better(new, s, (c + 4, a + "D", o))
        for s, (c, a, o) in pushed(dict(best)).items():
            better(new, s, (c + 4, a + "D", o))
        best = new
    ends = [best[s] for s in ("", "a") if s in best]
    for s, tail in (("u", ["assistant:"]), ("s", ["user:", "assistant:"])):
        if s in best:
            c, a, o = best[s]
            ends.append((c + 3 * len(tail), a + "I" * len(tail), o + tail))
    return min(ends)


def _slow_conversations(rows):
    """The contract, conversation by conversation."""
    held = {}
    for conv, turn, role, text in rows:
        here = held.setdefault(conv, [])
        name = f"{' ' if conv is None else conv}:{' ' if turn is None else turn}"
        draw = zlib.crc32(name.encode()) % 20
        role, text = " " if role is None else role, " " if text is None else text
        if draw == 0:
            continue
        text = "" if draw == 1 else re.sub("[.!?]", "", text) if draw == 2 else text
        here += [(turn, "user" if draw == 4 else role, text)] * (2 if draw == 3 else 1)
    out = []
    for conv, here in held.items():
        here.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1].encode(), r[2].encode()))
        kinds, seen = "", set()
        for _, role, text in here:
            words = text.strip(" \t\n\r\x0b\x0c")
            kinds += "x" if not words else "d" if (role, text) in seen else "." if words[-1] in ".!?" else "t"
            seen.add((role, text))
        turns = [t for t, _, _ in here if t is not None]
        initials = [r[:1] for _, r, _ in here]
        cost, audit, lines = _by_state([r for _, r, _ in here], [t for _, _, t in here], kinds.replace("d", "x"))
        out.append({
            "conv_id": conv, "gaps": max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0,
            "blank": kinds.count("x"), "duplicate": kinds.count("d"), "truncated": kinds.count("t"),
            "illegal": sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:])),
            "cost": cost, "audit": audit, "repaired_sha256": hashlib.sha256("\n".join(lines).encode()).hexdigest(),
        })
    return sorted(out[0]), sorted(tuple(repr(r[c]) for c in sorted(r)) for r in out)


def _odd_conversations():
    rng = random.Random(11)
    words = ["Yes.", "no", "", None, " \t", "Right!\n", "why?", "Ünd", "yes. ", "word " * 4000 + "."]
    roles = ["system", "user", "assistant", "user", "assistant", "tool", None, "", "user"]
    rows = [(c, rng.choice([None, *range(-1, 9)]), rng.choice(roles), rng.choice(words)) for c in range(40) for _ in range(rng.randint(1, 9))]
    rows += [(None, t, rng.choice(roles), rng.choice(words)) for t in range(5)]
    rows += [(77, t, ("user", "assistant")[t % 2], f"turn {t}.") for t in range(300)]
    rows += [(78, t, rng.choice(roles), rng.choice(words) if t % 3 else f"text {t}!") for t in range(120)]
    return rows + [(79, 4, "user", "same.")] * 40


@pytest.mark.parametrize("block_rows", [256, 3])
def test_conversations_equal_brute_force(spark, block_rows):
    rows = _odd_conversations()
    df = spark.createDataFrame([(*r, 1, "x") for r in rows], "conv_id long, turn long, role string, text string, key int, draw string")
    assert _spark(conversations.damaged_and_repaired(df, block_rows)) == _slow_conversations(rows)
    assert conversations.damaged_and_repaired(df.limit(0)).count() == 0


def test_conversations_equal_sql(spark):
    want = _sql(conversations.oracle_sql(), conversations=f"{SF}/conversations.parquet")
    assert _spark(queries.QUERIES["op11_conversation_repair"](spark, SF)) == want
    given = spark.read.parquet(f"{SF}/conversations.parquet").select("conv_id", "turn", "role", "text")
    assert _spark(conversations.damaged_and_repaired(given, 2)) == want == _slow_conversations(list(map(tuple, given.collect())))


# --- fingerprints --------------------------------------------------------------------------------

def _slow_sketch(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    shingles = [" ".join(words[i : i + 5]) for i in range(len(words) - 4)] or ([" ".join(words)] if words else [])
    h = {hashlib.md5(s.encode()).hexdigest()[:15] for s in shingles}
    low = {x for x in h if int(x, 16) < 16**15 // 8}
    return sorted(low or ({min(h)} if h else set()))


def _slow_near(a, b):
    return len(set(a) & set(b)) / len(a) if a else float(not b)


def test_fingerprints_equal_brute_force(odd, documents, nothing):
    for df in (odd, documents):
        rows = [(r["doc_id"], r["text"] or "") for r in df.select("doc_id", "text").collect()]
        key = lambda r: hashlib.md5(f"{'' if r[0] is None else r[0]}:{r[1]}".encode()).digest()
        line = sorted(set(rows), key=lambda r: (r[0] is not None, r[0] or 0, key(r)))
        after = {a: b for a, b in zip(line, line[1:] + line[:1])}
        want = []
        for r in rows:
            text, nxt = r[1], after[r][1]
            half = len(text) // 2
            edited = text[: len(text) - half] + nxt[:half]
            a, b, c = map(_slow_sketch, (text, edited, nxt))
            want.append((r[0], len(text), hashlib.sha256(edited.encode()).hexdigest(), ",".join(a), ",".join(b), _slow_near(a, b), _slow_near(a, c)))
        got = fingerprint.edited_pairs(df)
        assert got.columns == ["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"]
        assert sorted(map(repr, map(tuple, got.collect()))) == sorted(map(repr, want))
    assert fingerprint.edited_pairs(nothing).count() == 0


def test_fingerprints_equal_sql(spark, odd):
    frame = pd.DataFrame([(i, t) for i, t, _ in ODD_TEXTS], columns=["doc_id", "text"]).astype({"doc_id": "Int64"})
    want = _sql(fingerprint.oracle_sql(), documents=frame)
    assert _spark(fingerprint.edited_pairs(odd)) == want


def test_sketches_merge_and_contain(spark):
    rng = random.Random(5)
    words = [f"w{i}" for i in range(4000)]
    long, other = " ".join(words), " ".join(rng.sample(words, 40)) + " end"
    short = " ".join(words[100:700])
    df = spark.createDataFrame([(long, short, other)], "long string, short string, other string")
    s = {c: fingerprint.sketch(df[c]) for c in df.columns}
    joined = df.select(
        s["long"].alias("a"), s["short"].alias("b"), s["other"].alias("c"), fingerprint.merge(s["short"], s["other"]).alias("bc"),
        fingerprint.containment(s["short"], s["long"]).alias("inside"), fingerprint.containment(s["long"], s["short"]).alias("share"),
    ).first()
    assert joined["inside"] == 1.0 and abs(joined["share"] - 596 / 3996) < 0.05
    assert joined["bc"] == sorted(x for x in set(joined["b"]) | set(joined["c"]) if x < fingerprint.threshold())
    assert abs(len(joined["a"]) / 3996 - 1 / 8) < 0.03


def test_fingerprints_stay_in_the_jvm(spark, documents, capsys):
    fingerprint.edited_pairs(documents).explain()
    plan = capsys.readouterr().out
    assert "Arrow" not in plan and "Python" not in plan


# --- divergence ----------------------------------------------------------------------------------

def _audit_rows():
    rng = random.Random(9)
    words = ["The", "the,", "the.", "cat", "Cat", "(cat)", "dog-cat", "a1b", "Éte", "éte", "x\x00y", "...", "12", " z", "cat’s"]
    rows = [(" ".join(rng.choices(words, k=rng.randint(0, 12))), lang, src) for lang in ("en", "fr", None, "") for src in ("a", "b", "c", None, "é") for _ in range(8)]
    rows += [("hot hot word", "en", "big")] * 150 + [(f"only{i} rare{i % 40}.", "en", "a") for i in range(80)] + [("", "xx", "p"), (None, "xx", "q"), ("  ", "yy", "r")]
    return rows


@pytest.mark.parametrize("block_pairs, block_terms", [(7, 3), (3_000_000, 2048)])
def test_divergence_equals_sql(spark, nothing, block_pairs, block_terms):
    rows = _audit_rows()
    df = spark.createDataFrame([(*r, 1, "x") for r in rows], "text string, lang string, source string, docs int, chunk string").repartition(5)
    frame = pd.DataFrame(rows, columns=["text", "lang", "source"])
    for least in (2, 30):
        got = divergence.audit(df, min_docs=least, top=7, block_pairs=block_pairs, block_terms=block_terms)
        assert _spark(got) == _sql(divergence.oracle_sql(least, 7), documents=frame)
    assert divergence.audit(nothing).count() == 0


def test_divergence_block_rows(spark):
    """op13: chunks are numbered when first looked up, and rows of a block are taken by number."""
    block = divergence._Block(3, 2)
    block.add("en", "b", b"one two one")
    block.add("en", "a", b"two")
    block.add("fr", "a", b"one")
    assert block.chunks == {b"one": 0, b"two": 1} and isinstance(block.chunks, divergence._Codes)
    df = spark.createDataFrame([("en", "b", "one two one"), ("en", "a", "two"), ("fr", "a", "one")], "lang string, source string, text string")
    found = [r for r in divergence.chunk_counts(df.coalesce(1), 2).collect() if r["chunk"]]
    assert sorted((r["lang"], r["chunk"], r["docs"], sorted(r["in_docs"]), sorted(zip(r["sources"], r["times_in"]))) for r in found) == [
        ("en", "one", 1, [0], [("b", 2)]), ("en", "two", 2, [], [("a", 1), ("b", 1)]), ("fr", "one", 1, [2], [("a", 1)]),
    ]


def test_divergence_counts_by_one_sort_and_tokenizes_in_the_buckets(spark):
    """op13: a block's occurrences are sorted once by language, chunk, source and document, and a chunk that
    holds a term twice counts it twice, without a join of chunks and terms."""
    block = divergence._Block(0, 9)
    for lang, source, text in (("fr", "b", b"z a z"), ("en", "b", b"a a b"), ("fr", "a", b"a"), ("en", "a", b"b a"), ("en", "a", b" ")):
        block.add(lang, source, text)
    assert block.words == 9
    rows = [r for b in block.batches() for r in b.to_pylist() if r["chunk"]]
    assert [(r["lang"], r["chunk"], r["docs"], r["in_docs"], r["sources"], r["times_in"]) for r in rows] == [
        ("fr", "z", 1, [0], ["b"], [2]), ("fr", "a", 2, [0, 2], ["b", "a"], [1, 1]),
        ("en", "a", 2, [1, 3], ["b", "a"], [2, 1]), ("en", "b", 2, [1, 3], ["b", "a"], [1, 1]),
    ]
    df = spark.createDataFrame([("en", "a", "\u00c9t-Et.et x1")] * 2, "lang string, source string, text string")
    chunks = divergence.chunk_counts(df, 2).where("chunk IS NOT NULL").drop("source")
    found = divergence.vocabulary(chunks, 2)
    assert sorted(map(tuple, found.collect())) == [("en", "x1", "x"), ("en", "\u00c9t-Et.et", "et"), ("en", "\u00c9t-Et.et", "et"), ("en", "\u00c9t-Et.et", "\u00c9t")]
