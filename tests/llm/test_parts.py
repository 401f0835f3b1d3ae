"""The methods themselves: each against a plain version of the same thing."""

import base64
import io
import itertools
import json
import random
import tracemalloc

import numpy as np
import pyarrow as pa
import pytest
import sentencepiece
from pyspark.sql import functions as F

from shelfscope.llm import archives, decontaminate, jaccard_join, langid, line_dedup, pieces, rules, secrets, toxicity


def test_marginals_equal_enumeration():
    rng = np.random.default_rng(1)
    for length in (1, 2, 5):
        score, links = rng.normal(size=length), rng.normal(size=(2, 2))
        p, pairs = toxicity.marginals(score, np.array([0, length]), links)
        weight, marks, joint = 0.0, np.zeros(length), np.zeros((2, 2))
        for y in itertools.product((0, 1), repeat=length):
            w = np.exp(sum(score[i] for i in range(length) if y[i]) + sum(links[a, b] for a, b in zip(y, y[1:])))
            weight += w
            marks += w * np.array(y)
            for a, b in zip(y, y[1:]):
                joint[a, b] += w
        assert np.allclose(p, marks / weight) and np.allclose(pairs, joint / weight)


def test_marginals_do_not_depend_on_neighbours_or_blocks():
    rng = np.random.default_rng(2)
    links, parts = rng.normal(size=(2, 2)), [rng.normal(size=n) for n in (3, 0, 200, 64, 1)]
    bounds = np.cumsum([0, *map(len, parts)])
    together, _ = toxicity.marginals(np.concatenate(parts), bounds, links)
    apart = [toxicity.marginals(x, np.array([0, len(x)]), links)[0] for x in parts]
    assert np.allclose(together, np.concatenate(apart))


def test_scoring_needs_the_tokens_only():
    rng = np.random.default_rng(4)
    score, bounds, links = rng.normal(size=300), np.array([0, 0, 70, 300]), rng.normal(size=(2, 2))
    assert (toxicity.token_marginals(score, bounds, links) == toxicity.marginals(score, bounds, links)[0]).all()
    assert len(toxicity.token_marginals(np.zeros(0), np.array([0]), links)) == 0


@pytest.mark.parametrize("stage", ["clean", "encode"])
def test_a_large_batch_is_worked_in_small_slices(spark, monkeypatch, stage):
    docs, ran = spark.createDataFrame([(1, "a")], "doc_id long, text string"), []
    monkeypatch.setattr(type(docs), "mapInArrow", lambda self, run, schema: ran.append(run))
    weights = np.zeros((3, toxicity.BUCKETS))
    if stage == "clean":
        toxicity.clean_only(docs, toxicity.ToxicModel(*weights, np.zeros((2, 2)), 0.0, (-50.0, 0.0, 0.0)))
    else:
        pieces.encode(docs)
    rng = random.Random(5)
    words = ["".join(rng.choices("abcdefgh", k=5)) for _ in range(2000)]
    texts = [" ".join(rng.choices(words, k=1000)) for _ in range(600)]

    def batch(texts: list) -> pa.RecordBatch:
        return pa.RecordBatch.from_pydict({"doc_id": list(range(len(texts))), "text": texts})

    large, (run,) = batch(texts), ran
    list(run(iter([batch(texts[:1])])))  # the tables of a model are made before
    tracemalloc.start()
    try:
        n = sum(out.num_rows for out in run(iter([large])))
        peak = tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()
    assert n == len(texts)
    assert peak < 60 << 20, f"{peak >> 20} MB for {large.nbytes >> 20} MB of text"


def test_encoder_equals_the_library():
    data = open(pieces.MODEL, "rb").read()
    library, vocabulary = sentencepiece.SentencePieceProcessor(model_proto=data), pieces.PieceVocabulary.read(data)
    encoder, rng = pieces.WordEncoder(vocabulary), random.Random(3)
    texts = ["a", " a", "  two  ", "aaaaaaaaaaa", "naïve ☃ 日本語 \U0001f600", "x\x00y", "    ", "\n\n"]
    texts += ["".join(rng.choice("ab \n.éßtheing日") for _ in range(rng.randint(1, 50))) for _ in range(300)]
    for text in texts:
        assert encoder.encode(pieces.words_of(text, encoder.breaks))[0].tolist() == library.encode(text), text


def test_occurrences_equal_search():
    text, names = "abracadabra\0", ["a", "ab", "abra", "ra", "zz"]
    low, high = np.array(names, "<U4"), np.array([x + "\U0010ffff" for x in names], "<U5")
    starts, numbers = pieces.occurrences(text, low, high)
    want = {(i, k) for k, x in enumerate(names) for i in range(len(text)) if text.startswith(x, i)}
    assert set(zip(starts.tolist(), numbers.tolist())) == want


def test_tiles_find_reordered_passages():
    a, b, c = (list(range(k, k + 12)) for k in (0, 100, 200))
    found = decontaminate.tiles(a + b + c, c + [7000] + a + b)
    assert sum(n for *_, n in found) == 36 and found[0] == (0, 13, 24)
    assert decontaminate.tiles(a, a[:4]) == [] and decontaminate.tiles(a[:5], a) == [(0, 0, 5)]
    assert [n for *_, n in decontaminate.tiles([1] * 10, [1] * 23)] == [10]


def test_arc_versions():
    body = b"HTTP/1.0 200 OK\r\nX-Record-Key: 7\r\n\r\nhi\n\nfiledesc://no"
    for version, tail in ((1, ""), (2, "200 - - 0 f.arc ")):
        opening = f"{version} 0 test\n{' '.join(archives.ARC_FIELDS[version])}\n".encode()
        rest = "" if version == 1 else "200 - - 0 - "
        data = f"filedesc://f.arc 0.0.0.0 1999 text/plain {rest}{len(opening)}\n".encode() + opening + b"\n"
        data += f"http://x 1.2.3.4 19990203040506 text/html {tail}{len(body)}\n".encode() + body + b"\n"
        ((header, content),) = archives.arc_entries(io.BytesIO(data))
        assert header["URL"] == "http://x" and content == body
    with pytest.raises(ValueError):
        list(archives.arc_entries(io.BytesIO(data[:-10])))
    assert archives._arc_time("19990203040506") == "1999-02-03T04:05:06Z" and archives._arc_time("1999") == "1999-01-01T00:00:00Z"


def test_record_ids_hold_their_key(spark):
    keys = [0, 1, -1, 2**62, -(2**63), 2**63 - 1]
    rows = spark.createDataFrame([(k,) for k in keys], "key long").select("key", archives.record_id(F.lit("D"), F.col("key"), F.lit("u")).alias("i")).collect()
    assert all(archives.key_of_record_id(r["i"]) == r["key"] for r in rows)


def test_cuckoo_filter_adds_and_removes():
    rng = np.random.default_rng(4)
    keys = np.unique(rng.integers(0, 2**63, 4000).astype(np.uint64))
    one = line_dedup.CuckooFilter(3000)  # too small on purpose: what finds no place is kept aside
    one.add(keys)
    assert one.has(keys).all()
    one = line_dedup.CuckooFilter.from_bytes(one.to_bytes())
    one.remove(keys[:2000])
    assert one.has(keys[2000:]).all() and one.has(keys[:2000]).mean() < 0.05


def test_line_index_is_reversible(spark):
    line = "a line that is long enough to have a key of its own"
    make = lambda ids, text=line: spark.createDataFrame([(i, f"{text}\n{i}") for i in ids], "doc_id long, text string")
    first, second = make(range(4)), make([10, 11])
    state = lambda i: {(bytes(r["key"]), r["n_docs"], r["holder"]) for r in i.counts.collect()}
    index = line_dedup.LineIndex(spark).insert(first)
    before = state(index)
    assert index.doomed(first).count() == 0
    index.insert(second).insert(second)
    assert {r["doc_id"] for r in index.doomed(first.union(second)).collect()} == {0, 1, 2, 3, 10}
    index.delete(second.where("doc_id = 11").select("doc_id"))
    left = first.union(second.where("doc_id = 10"))
    assert {r["doc_id"] for r in index.doomed(left).collect()} == {0, 1, 2, 3}
    index.delete(second.select("doc_id"))
    assert state(index) == before and index.doomed(first).count() == 0


def test_a_token_of_all_documents_is_counted_once_per_slice(spark):
    """The class is exact, and what a bucket is sent does not grow with the documents that hold one token."""
    shared = "these five words are everywhere"
    texts = [f"{shared} {' '.join(f'w{i}x{j}' for j in range(5))}" + (" rare one two three four" if i % 150 == 0 else "") for i in range(3000)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").coalesce(2)
    found = jaccard_join.frequent_tokens(docs, 100)
    every = jaccard_join.Tokens().of([f"{shared}", "rare one two three four", texts[7]])
    assert found.has(every[0]).all() and not found.has(every[1]).any() and found.has(every[2]).sum() == 1
    assert found.has(jaccard_join.Tokens().of(["rare one two three four"])[0]).sum() == 0
    some = jaccard_join.frequent_tokens(docs, 19)
    assert some.has(jaccard_join.Tokens().of(["rare one two three four"])[0]).all()


@pytest.mark.parametrize("most", [line_dedup.FILTER_BYTES, 0])
def test_filters_of_any_size_answer_alike(spark, monkeypatch, most):
    """Beyond the size that is sent, keys stream past their shard's filter; a line in a third of all documents is one key."""
    monkeypatch.setattr(line_dedup, "FILTER_BYTES", most)
    monkeypatch.setattr(line_dedup, "SHARD_KEYS", 20)
    hot = "a line that every third of all documents holds, hot as can be"
    own = [f"line number {i % 130} that a few documents share, and no more than that" for i in range(900)]
    docs = spark.createDataFrame([(i, f"{own[i]}\n{hot if i % 3 == 0 else i}\n{own[-i]}") for i in range(900)] + [(None, hot)], "doc_id long, text string")
    index = line_dedup.LineIndex(spark).insert(docs)
    assert index.shards > 3 and index.filters.count() > 3
    holders = {}
    for i in range(900):
        for line in {own[i], own[-i], *([hot] if i % 3 == 0 else [])}:
            holders.setdefault(line, []).append(i)
    want = {i: {line_dedup.line_key(x, 40) for x, ids in holders.items() if len(ids) >= 5 and i in ids and i != max(ids)} for i in range(900)}
    got = {r["doc_id"]: set(map(bytes, r["doomed_keys"])) for r in index.doomed(docs).collect()}
    assert got == {i: keys for i, keys in want.items() if keys}


def test_index_goes_on_from_its_folder(spark, tmp_path):
    line = "a line that is long enough to have a key of its own"
    make = lambda ids: spark.createDataFrame([(i, line) for i in ids], "doc_id long, text string")
    line_dedup.LineIndex(spark, folder=str(tmp_path / "index")).insert(make(range(4))).insert(make([9]))
    index = line_dedup.LineIndex.open(spark, str(tmp_path / "index"))
    assert index.version == 2 and {r["doc_id"] for r in index.doomed(make(range(10))).collect()} == set(range(9))
    index.delete(make([0, 9]).select("doc_id"))
    again = line_dedup.LineIndex.open(spark, str(tmp_path / "index"))
    assert again.version == 3 and again.doomed(make(range(4))).count() == 0
    assert [(r["n_docs"], r["holder"]) for r in again.counts.collect()] == [(3, 3)]


def test_short_items_and_scripts_without_spaces(spark):
    items = [("s", "Hello, world"), ("one", "Zebra!"), ("han", "今日は天気がとても良いです"), ("none", "…"), ("long", "one two three four five six seven")]
    benchmark = spark.createDataFrame(items, "item_id string, text string")
    texts = ["say hello world again", "hello big world", "a ZEBRA crossing", "彼は今日は天気がとても良いですと言った", "今日は雨です", "hello", "", None, "x one two three four five six seven", "world hello"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    found = {(r["doc_id"], r["item_id"]): r["coverage"] for r in decontaminate.matches(docs, benchmark).collect()}
    assert found == {(0, "s"): 1.0, (2, "one"): 1.0, (3, "han"): 1.0, (8, "long"): 1.0}
    best = {r["doc_id"]: (r["contaminated"], r["best_item"]) for r in decontaminate.contamination(docs, benchmark).collect()}
    assert best == {0: (True, "s"), 2: (True, "one"), 3: (True, "han"), 8: (True, "long")}
    assert sorted(r["doc_id"] for r in decontaminate.clean_only(docs, benchmark).collect()) == [1, 4, 5, 6, 7, 9]


def test_settling_one_language_early_changes_no_set(monkeypatch):
    """Texts of every mixture and length: the proven ones and those that run the selection agree with running it for all."""
    rng = np.random.default_rng(8)
    base = np.log(np.where(np.eye(4) > 0, 0.93, 0.07 / 3))
    words, bounds = [], [0]
    for _ in range(400):
        n, main, other = int(rng.integers(0, 60)), *rng.choice(4, 2, replace=False)
        share = rng.choice([0, 0.01, 0.05, 0.2, 0.5])
        words += [base[other if rng.random() < share else main] + rng.normal(0, 0.7, 4) for _ in range(n)]
        bounds.append(len(words))
    likely, bounds = np.array(words), np.array(bounds)
    got = langid.mixtures(likely, bounds)
    settled = ~langid._may_have_more(np.exp(likely - likely.max(1, keepdims=True)), bounds, *langid._mixture(np.exp(likely - likely.max(1, keepdims=True)), bounds, np.ones((400, 4))), got.argmax(1))
    monkeypatch.setattr(langid, "_may_have_more", lambda likely, bounds, *rest: np.ones(len(bounds) - 1, bool))
    whole = langid.mixtures(likely, bounds)
    full = np.diff(bounds) > 0
    assert (got[full] == whole[full]).all() and settled[full].sum() > 50 and (~settled[full]).sum() > 50


def test_encodings_that_keys_hide_in():
    inner = bytes.fromhex("0201000482") + (256).to_bytes(2, "big") + bytes(i * 7 % 256 for i in range(256))
    der = b"\x30\x82" + len(inner).to_bytes(2, "big") + inner
    encoded = base64.b64encode(der).decode()
    lines = "\n".join(encoded[i : i + 64] for i in range(0, len(encoded), 64))
    found = lambda text: [(secrets.KINDS[k], text[a:b]) for a, k, b in secrets.confirmed_spans(text)]
    begin, end = "-----BEGIN RSA PRIVATE KEY-----", "-----END RSA PRIVATE KEY-----"
    block = f"{begin}\n{lines}\n{end}"
    account = json.dumps({"type": "service_account", "private_key": block + "\n", "id": 1})
    assert found(account) == [("key", json.dumps(block)[1:-1])]
    assert found(f"text\n{lines}\nmore words follow") == [("key", lines)]
    assert found(f"a\n{lines}\n{'B' * 64}\nend") == [("key", lines)]  # the declared length ends the key
    escaped = lines.replace("\n", "\\n")
    assert found(f'{{"k": "{escaped}"}}') == [("key", escaped)]
    assert found(f"{begin}\nComment: mine\n\n{lines}\n{end}")[0][0] == "key"
    body = base64.b64encode(bytes(i * 11 % 256 for i in range(320))).decode()
    sealed = f"{begin}\nProc-Type: 4,ENCRYPTED\nDEK-Info: AES-128-CBC,AABB\n\n{{}}\n{end}"
    assert found(sealed.format(body)) == [("key", sealed.format(body))] and found(sealed.format(body[:-7])) == []
    mixed = "".join(c.upper() if i % 3 else c for i, c in enumerate(der.hex()))
    assert found(f"<{mixed}>") == [("key", mixed)] and found(f"<{mixed[:-2]}>") == []
    for head in (b'{"alg": "x"}', b'{ "alg": "x"}', b'{\n "alg": "x"}', b'{\t"alg": "x"}'):
        token = ".".join(base64.urlsafe_b64encode(x).decode().rstrip("=") for x in (head, b"{}", b"s" * 32))
        assert found(f"({token})") == [("jwt", token)]
    assert found(("QUJD" * 16 + "\n") * 5) == [] and found("A" * 5000) == [] and found(f"{begin}\n{end}") == []


def test_secrets_are_confirmed_by_structure():
    der = bytes.fromhex("3026020100") + bytes([0x04, 33]) + bytes(range(33))
    encoded = base64.b64encode(der).decode()
    block = f"-----BEGIN PRIVATE KEY-----\n{encoded}\n-----END PRIVATE KEY-----"
    token = ".".join(base64.urlsafe_b64encode(x).decode().rstrip("=") for x in (json.dumps({"alg": "HS256"}).encode(), b"{}", b"s" * 32))
    kinds = lambda text: [secrets.KINDS[k] for _, k, _ in secrets.confirmed_spans(text)]
    assert secrets.is_key(der) and not secrets.is_key(der[:-1]) and not secrets.is_key(der + b"x")
    assert kinds(block) == ["key"] and kinds(encoded) == ["key"] and kinds(der.hex()) == ["key"] and kinds(f"x {token} y") == ["jwt"]
    assert kinds("A" * 60) == [] and kinds("eyJhbGc.eyJ.x") == [] and kinds("0" * 80) == []


def test_mixture_of_two_languages():
    likely = np.log(np.array([[0.9, 0.1, 1e-6]] * 60 + [[0.1, 0.9, 1e-6]] * 40))
    share = langid.mixtures(likely, np.array([0, 100, 100]))
    assert share[0].argmax() == 0 and 0.5 < share[0, 0] < 0.75 and share[0, 2] == 0
    assert langid.mixtures(likely[:60], np.array([0, 60]))[0].tolist() == [1, 0, 0]


def test_rules_are_learned_and_pruned(spark):
    rows = spark.range(900).selectExpr(
        *(f"cast(pmod(hash(id, {k}), 100) as double) as {f}" for k, f in enumerate(rules.FEATURES) if f != "symbol_share"),
        "if(id % 10 = 0, 0.5D, 0.01D) as symbol_share", "id % 10 = 0 as bad", "id % 3 > 0 as growing",
    )
    learned = rules.learn(rows)
    assert [[x.feature for x in r] for r in learned] == [["symbol_share"]] and learned[0][0].above
    assert rows.select((rules.verdict(learned) > 0).alias("out"), "bad").where("out <> bad").count() == 0


def test_bitmap_bound_and_similarity():
    rng = np.random.default_rng(5)
    for _ in range(200):
        base = np.unique(rng.integers(0, 2**63, int(rng.integers(1, 300))).astype(np.uint64))
        other = np.unique(np.concatenate([base[rng.random(len(base)) < 0.9], rng.integers(0, 2**63, int(rng.integers(0, 20))).astype(np.uint64)]))
        if not len(other):
            continue
        shared = len(np.intersect1d(base, other))
        want = 100 * shared >= 80 * (len(base) + len(other) - shared)
        assert jaccard_join.similar(base, other) == want
        if want:
            assert jaccard_join.may_be_similar(jaccard_join.bitmap(base), jaccard_join.bitmap(other), len(base), len(other))


def test_index_keys_meet_for_every_similar_pair():
    rng = np.random.default_rng(6)
    met = 0
    for _ in range(400):
        base = np.unique(rng.integers(0, 2**63, int(rng.integers(1, 400))).astype(np.uint64))
        drop = rng.random(len(base)) < rng.uniform(0, 0.15)
        other = np.unique(np.concatenate([base[~drop], rng.integers(0, 2**63, int(drop.sum() * rng.random())).astype(np.uint64)]))
        if not len(other) or not jaccard_join.similar(base, other):
            continue
        frequent = base[rng.random(len(base)) < rng.choice([0, 0.5, 0.9, 0.97, 1])]  # of the shared and the own tokens
        keys = [jaccard_join.index_keys(x, np.isin(x, frequent)) for x in (base, other)]
        assert any(len(np.intersect1d(a, b)) for a, b in zip(*keys))
        met += 1
    assert met > 100
