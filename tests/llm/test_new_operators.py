"""Alignment, prefix trie and shards against plain brute force, and their edge cases."""

import collections
import hashlib
import math
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from shelfscope.llm import alignment as A
from shelfscope.llm import prefix_trie as P
from shelfscope.llm import queries, shards
from shelfscope.llm.common import table

SF_DIR = "/root/testdata/sf0.001"
ODD_TEXTS = [
    None, "", " ", "  ", "x ", "x  ", " x", "\n y", "a\n \nb", "a\n  b", "  a  b ", "don't <s> <|endoftext|> <unk> it's", "a▁b", "▁",
    "日本語の文章です。長い文 " * 40, "日本語" * 300, "\x00\x1c a\xa0 b　 c", "a  \n  b\t \tc", "é́ ñ ﬁ Ａ 😀👩‍👩‍👧 x", "x" * 3000,
    "1234567 89 3.14!!! ... ??", "\r\n x\r\n", "é " * 5000, "one two one two " * 50, "ԱՐԵՎ بسم ᏣᎳᎩ ok",
]


def in_order(rows):
    return sorted((tuple(r) for r in rows), key=lambda r: tuple((x is not None, x) for x in r))


def brute_alignment(rows):
    """Whole texts encoded at once, links by two pointers over the tokens' ends."""
    v = A.Vocabularies()
    out, per_text = [], []
    for doc_id, text in rows:
        raw = f" {text or ''}".encode()
        a = v.a.encode(f" {text}", add_special_tokens=False).ids if text else []
        b = v.b.encode(text) if text else []
        if not text or b"".join(v.a_bytes[i] for i in a) != raw or b"".join(v.b_bytes[i] for i in b) != raw:
            out.append((doc_id, 0, 0, 0, 0, ""))
            per_text.append(collections.Counter())
            continue
        a_ends, b_ends = (np.cumsum([len(t[i]) for i in ids]).tolist() for t, ids in ((v.a_bytes, a), (v.b_bytes, b)))
        links, groups, in_a, in_b, i, j = [], [], [], [], 0, 0
        while i < len(a):
            links.append((a[i], b[j]))
            x, y = a_ends[i], b_ends[j]
            in_a += [str(a[i])] * (x <= y)
            in_b += [str(b[j])] * (y <= x)
            i, j = i + (x <= y), j + (y <= x)
            if x == y:
                groups.append(f"{','.join(in_a)}|{','.join(in_b)}")
                in_a, in_b = [], []
        out.append((doc_id, len(a), len(b), len(groups), len(links), hashlib.sha256(";".join(groups).encode()).hexdigest()))
        per_text.append(collections.Counter(links))
    n = collections.Counter(p for c in per_text for p in c)
    best = collections.Counter()
    for (x, _), k in n.items():
        best[x] = max(best[x], k)
    return [(*o[:5], sum(k for p, k in c.items() if n[p] == best[p[0]]), sum(k * n[p] for p, k in c.items()), o[5]) for o, c in zip(out, per_text, strict=True)]


@pytest.fixture(scope="module")
def texts(spark):
    """A test table, odd texts (each twice, one without an id), and columns that clash with the operator's."""
    docs = table(spark, SF_DIR, "documents").select("doc_id", "text").limit(60)
    odd = spark.createDataFrame([(None if t == "x" else 10_000 + i, t) for i, t in enumerate(ODD_TEXTS * 2)] + [(None, "no id")], "doc_id long, text string")
    return docs.unionByName(odd).withColumns({"row": F.lit("r"), "pairs": F.lit(1), "n_a": F.lit(2)})


@pytest.mark.parametrize("limits", [{}, {"part_bytes": 300, "range_bytes": 40, "frequent_pairs": 50}])
def test_alignment_equals_brute_force(texts, limits):
    want = in_order(brute_alignment([(r["doc_id"], r["text"]) for r in texts.collect()]))
    assert in_order(A.alignment(texts, **limits).collect()) == want


def test_alignment_of_an_empty_table_has_no_rows(texts):
    assert A.alignment(texts.limit(0)).collect() == []


def test_fragments_compose_in_any_bracketing():
    """Ranges of any size, any tree: the same groups, links and pairs as the whole."""
    v = A.Vocabularies()
    text = "Ünbelievable tokenization of naïve (words)… " * 9
    a, _, b, _ = v.encode([text])
    a_ends, b_ends = np.cumsum(v.a_sizes[a]), np.cumsum(v.b_sizes[b])
    tokens = A.Open(a.tolist(), a_ends.tolist(), b.tolist(), b_ends.tolist())
    whole = A.closed_groups(tokens, v.n_b)
    rng = np.random.default_rng(3)
    for size in (1, 2, 3, 7, 20, 1000):
        cuts = np.arange(0, a_ends[-1] + size, size)
        i, j = np.searchsorted(a_ends, cuts, "right"), np.searchsorted(b_ends, cuts, "right")
        parts = [A.fragment(tokens.cut(i[k], i[k + 1], j[k], j[k + 1]), v.n_b) for k in range(len(cuts) - 1)]
        while len(parts) > 1:
            k = int(rng.integers(len(parts) - 1))
            parts[k : k + 2] = [parts[k].then(parts[k + 1], v.n_b)]
        (f,) = parts
        assert not f.suffix.a and not f.suffix.b
        got = A.closed_groups(f.prefix, v.n_b) + (f.closed or A.Closed())
        assert (got.n_a, got.n_b, got.n_groups, got.n_links, got.text) == (whole.n_a, whole.n_b, whole.n_groups, whole.n_links, whole.text)
        assert sorted(np.concatenate(got.pairs)) == sorted(np.concatenate(whole.pairs))


def test_encoding_by_rank_is_the_vocabularys():
    v = A.Vocabularies()
    assert v.ranked is not None
    for text in [t for t in ODD_TEXTS if t]:
        units = v.units(text)
        a, n_a, b, n_b = v.encode(units)
        assert a.tolist() == v.a.encode(f" {text}", add_special_tokens=False).ids and n_a.sum() == len(a)
        assert b.tolist() == v.b.encode(text) and n_b.sum() == len(b)


def trie(conversations):
    turns, ids = P.with_borrowed_heads(P.turn_index(conversations))
    nodes, ends = P.prefix_trie(turns, ids)
    out = nodes.join(P.joined_ids_sha256(ends), ["x", "y"], "left").fillna(P.NO_IDS, ["ends_sha256"])
    columns = ("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256")
    return in_order(out.select(*columns).collect())


def brute_trie(rows):
    turns = collections.defaultdict(list)
    for conv_id, turn, role, text in rows:
        if conv_id is not None:
            role, text = role or "", text or ""
            digest = hashlib.sha256((hashlib.sha256(role.encode()).hexdigest() + text).encode()).hexdigest()
            turns[conv_id].append(((turn is not None, turn or 0, digest[:15], digest[15:30]), (role, text)))
    turns = {c: [t for _, t in sorted(ts, key=lambda x: x[0])] for c, ts in turns.items()}
    rebuilt = {}
    for c, own in turns.items():
        h = zlib.crc32(str(c).encode()) % 4
        rebuilt[c] = turns.get(c - int(math.fmod(c, 20)), [])[:h] + own[h:]
    members = collections.defaultdict(list)
    for c, ts in rebuilt.items():
        for d in range(len(ts) + 1):
            members[tuple(ts[:d])].append(c)
    children = collections.Counter(k[:-1] for k in members if k)
    leaves, saved = collections.Counter(), collections.Counter()
    for k, m in members.items():
        for d in range(len(k) + 1):
            leaves[k[:d]] += children[k] == 0
            saved[k[:d]] += (len(m) - 1) * len(re.findall(r"[^\x20\x09-\x0D]+", k[-1][1])) if k else 0
    out = []
    for k, m in members.items():
        ends = ",".join(map(str, sorted(c for c in m if len(rebuilt[c]) == len(k))))
        parent = min(members[k[:-1]]) if k else None
        out.append((min(m), len(k), parent, len(m), children[k], leaves[k], saved[k], hashlib.sha256(ends.encode()).hexdigest()))
    return in_order(out)


CONVERSATION = "conv_id long, turn int, role string, text string"


def test_trie_of_odd_conversations_equals_brute_force(spark):
    """Turns without number, repeated turns, NULLs, lenders that lack, negative ids, conversations of many blocks."""
    rows = [
        (c, None if i % 7 == 0 else i // 2, "u" if i % 2 else None, f"w{(i if c % 3 else i * (i < 70 + c % 5)) % 9}  x")
        for c in range(-45, 60, 3)
        for i in range(c % 4 * 40 + (c % 5) * 9)
    ]
    rows += [(None, 1, "u", "x")] * 3 + [(7, 1, "u", "dup dup")] * 5 + [(500 + i, 0, "u", "hi") for i in range(40)] + [(900, None, None, None)] * 2
    df = spark.createDataFrame(rows, CONVERSATION).withColumns({"pos": F.lit(1), "a": F.lit("x"), "depth": F.lit(None)})
    assert trie(df) == brute_trie(rows)


def test_trie_of_one_very_long_conversation_and_of_none(spark):
    rows = [(1, i, "u", str(i % 5)) for i in range(700)] + [(2, i, "u", str(i % 5)) for i in range(650)] + [(3, i, "u", "z" if i == 600 else str(i % 5)) for i in range(700)]
    assert trie(spark.createDataFrame(rows, CONVERSATION)) == brute_trie(rows)
    assert trie(spark.createDataFrame([], CONVERSATION)) == []


def placed(rows, n_shards):
    """Slots of each shard; fails where they have gaps or the counts differ by more than one."""
    by = collections.defaultdict(list)
    for r in rows:
        by[r["shard"]].append(r["slot"])
    counts = [len(by[s]) for s in range(n_shards)]
    assert max(counts) - min(counts) <= 1 and set(by) <= set(range(n_shards))
    assert all(sorted(slots) == list(range(len(slots))) for slots in by.values())
    return by


def test_op13_contract(spark):
    docs = table(spark, SF_DIR, "documents")
    rows = queries.QUERIES["op13_shards"](spark, SF_DIR).collect()
    placed(rows, 8)
    want = sorted((r["doc_id"], len((r["text"] or "").encode()) + 1, zlib.crc32((r["text"] or "").encode())) for r in docs.collect())
    assert sorted((r["doc_id"], r["size"], r["text_crc32"]) for r in rows) == want
    assert {(r["law"], r["grown_shard"]) for r in rows} == {("rows", None)}


def test_shuffle_depends_on_rows_and_seed_alone(spark):
    docs = table(spark, SF_DIR, "documents")
    key = lambda df: sorted((r["doc_id"], r["shard"], r["slot"]) for r in df.select("doc_id", "shard", "slot").collect())
    one = key(shards.shuffled_shards(docs, bucket_bytes=1 << 15))
    assert one == key(shards.shuffled_shards(docs.repartition(7), bucket_bytes=1 << 15))
    assert one != key(shards.shuffled_shards(docs, seed=5, bucket_bytes=1 << 15))


def test_every_order_of_a_bucket_is_as_likely(spark):
    """Fisher-Yates by seed: each of six orders of three rows in 1,200 draws, within five standard deviations."""
    arrays = spark.range(1200).select(F.shuffle(F.array(*map(F.lit, "abc")), F.lit(7)).alias("x"))
    counts = collections.Counter("".join(r["x"]) for r in arrays.collect())
    assert len(counts) == 6 and all(abs(n - 200) < 5 * math.sqrt(200 * 5 / 6) for n in counts.values())


def test_rows_spread_uniformly_over_shards(spark):
    """Neighbouring ids, and texts of one source, meet no pattern in shards and slots."""
    df = spark.range(4000).select(F.col("id").alias("doc_id"), F.lit("same text").alias("text"))
    rows = shards.shuffled_shards(df, 8, bucket_bytes=1 << 11).collect()
    placed(rows, 8)
    counts = collections.Counter((r["doc_id"] * 8 // 4000, r["shard"]) for r in rows)
    chi = sum((counts[i, s] - 62.5) ** 2 / 62.5 for i in range(8) for s in range(8))
    assert chi < 49 + 5 * math.sqrt(2 * 49)
    order = [r["doc_id"] for r in sorted(rows, key=lambda r: (r["shard"], r["slot"]))]
    assert abs(np.corrcoef(order, range(4000))[0, 1]) < 0.08


def test_a_row_repeated_beyond_a_bucket_is_dealt_out(spark):
    many = spark.range(30_000).select(F.lit(1).cast("long").alias("doc_id"), F.lit("abc " * 50).alias("text"), F.lit("x").alias("Shard"))
    odd = spark.createDataFrame([(None, None, None)] * 5 + [(2, "", "s"), (3, "q" * 400_000, None)], "doc_id long, text string, Shard string")
    docs = many.unionByName(odd)
    out = shards.shuffled_shards(docs, bucket_bytes=1 << 17)
    assert out.columns == ["shard", "slot", "bucket", "doc_id", "text", "Shard_in"]
    rows = out.collect()
    placed(rows, 8)
    assert collections.Counter((r["doc_id"], r["text"], r["Shard_in"]) for r in rows) == collections.Counter(map(tuple, docs.collect()))
    assert max(collections.Counter(r["bucket"] for r in rows).values()) < 2_000


def test_small_and_empty_tables(spark):
    docs = table(spark, SF_DIR, "documents")
    assert shards.shuffled_shards(docs.limit(0)).collect() == []
    placed(shards.shuffled_shards(docs.limit(3)).collect(), 8)
    placed(shards.shuffled_shards(docs.limit(7), n_shards=1).collect(), 1)
