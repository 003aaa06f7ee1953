"""The ten corpus operators against brute force, round trips and held-out labels, on small tables with odd rows."""

import base64
import hashlib
import os
import sys
import zlib

import numpy as np
import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import public_tokenizers as P  # noqa: E402
from pyspark.sql import functions as F  # noqa: E402

import __spark_entry__ as E  # noqa: E402
import corpus_pipeline  # noqa: E402
from oracle_compare import compare, duck  # noqa: E402
from tidecast.llm import ann, bpe, common, crf, packing, pu, repeats, rules, separators, simhash, tokenfiles, tokens  # noqa: E402

SF = "/root/testdata/sf0.001"
SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint, score double, n_words int, fp string"
LONG = "lorem ipsum dolor sit amet consectetur " * 30
ODD = [
    (1, None, "en", "a"), (2, "", "en", "a"), (3, " \n\t ", None, "a"), (4, "one two three four five six seven", "en", None),
    (5, LONG, "en", "a"), (6, LONG, "en", "a"), (7, "x" + LONG + "é中😀　 end", "en", "a"), (7, "x" + LONG + "é中😀　 end", "en", "a"),
    (None, LONG[:450], "en", "a"), (9, "ab" * 900, "en", "a"), (10, "Tail.  Two  spaces\n\nand lines\r\nİstanbul ΣΑΣ don't 1234 ¾ ﬁ", "de", "b"),
    (2**60 + 1, "word " * 4000, "en", "a"),
]


@pytest.fixture(scope="module")
def odd(spark):
    return spark.createDataFrame([(i, t, a, b, None, 1.0, 2, "z") for i, t, a, b in ODD], SCHEMA).repartition(3)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="module")
def texts(spark):
    return {r.doc_id: r.text for r in common.documents(spark, SF).collect()}


def raw(t):
    return (t or "").encode()


# ---------------------------------------------------------------- 1, 8: classifiers
LABELS = "doc_id bigint, quality int, toxic int"


def labelled(spark):
    docs = {r.doc_id: r.text for r in common.documents(spark, "/root/testdata/sf0.01").collect()}
    return [(docs[r.doc_id], r.quality, r.toxic, zlib.crc32(str(r.doc_id).encode()) % 5 == 0)
            for r in spark.read.parquet("/root/testdata/sf0.01/labels.parquet").collect() if r.doc_id in docs]


@pytest.mark.parametrize("name, column, least", [("op1_pu_quality", "quality", 0.9), ("op8_crf_toxicity", "toxic", 0.9)])
def test_classifiers_tell_held_out_labels(spark, name, column, least):
    sf = "/root/testdata/sf0.01"
    got = E.queries()[name](spark, sf).join(spark.read.parquet(f"{sf}/labels.parquet"), "doc_id").where("held_out")
    rows = got.select("score", "predicted", F.col(column).alias("y")).collect()
    assert sum(r.predicted == r.y for r in rows) >= least * len(rows)
    good, bad = [r.score for r in rows if r.y == 1], [r.score for r in rows if r.y == 0]
    # few toxic texts to learn from at this scale: languages without one are not told
    assert np.mean([(a > b) + 0.5 * (a == b) for a in good for b in bad]) > (0.95 if column == "quality" else 0.6)


@pytest.mark.parametrize("module", [pu, crf])
def test_classifiers_on_odd_tables(spark, odd, empty, module):
    none = spark.createDataFrame([], LABELS)
    some = spark.createDataFrame([(i, i % 2, (i + 1) % 2) for i in range(4, 11)] + [(None, 1, 1), (5, None, None)], LABELS)
    for labels in (none, some):
        rows = module.classify(odd, labels).collect()
        assert len(rows) == len(ODD) and all(0 <= r.score <= 1 for r in rows)
        assert module.classify(empty, labels).count() == 0
    assert sorted(r.held_out for r in rows) == sorted(i is not None and zlib.crc32(str(i).encode()) % 5 == 0 for i, *_ in ODD)


def test_marginals_are_those_of_the_plain_recursion():
    rng = np.random.default_rng(0)
    lengths = np.array([3, 0, 130, 64, 65, 1])
    emit, trans, begin = rng.normal(size=lengths.sum()) * 2, rng.normal(size=(2, 2)), rng.normal(size=2)
    p, pairs = crf.marginals(emit, lengths, trans, begin)
    want, total, at = [], np.zeros((2, 2)), 0
    for n in lengths[lengths > 0]:
        e = np.stack([np.zeros(n), emit[at:at + n]], 1)
        a, b = np.zeros((n, 2)), np.zeros((n, 2))
        a[0] = begin + e[0]
        for k in range(1, n):
            a[k] = e[k] + np.logaddexp.reduce(a[k - 1][:, None] + trans, axis=0)
        for k in range(n - 2, -1, -1):
            b[k] = np.logaddexp.reduce(trans + e[k + 1] + b[k + 1], axis=1)
        z = np.logaddexp.reduce(a[-1])
        want += list(np.exp(a[:, 1] + b[:, 1] - z))
        for k in range(1, n):
            total += np.exp(a[k - 1][:, None] + trans + e[k] + b[k] - z)
        at += n
    assert np.allclose(p, want) and np.allclose(pairs, total)


def test_offending_spans(spark):
    rng = np.random.default_rng(1)
    words = [f"w{i}" for i in range(200)]
    made = [" ".join([*rng.choice(words, 30), *(["vile", "grubby"] if k % 3 == 0 else [])]) for k in range(90)]
    field = crf.train_field(made, np.array([int(k % 3 == 0) for k in range(90)]))
    score, found = crf.tag(field, ["w1 w2 vile w3 w4 Grubby w5", "w7 w8", ""])
    assert ["w1 w2 vile w3 w4 Grubby w5"[a:b] for a, b in found[0]] == ["vile", "Grubby"]
    assert found[1] == found[2] == [] and score[0] > 0.5 > max(score[1:])


def test_class_prior_estimate():
    rng = np.random.default_rng(2)
    pos = rng.normal(3, 1, 4000)
    unl = np.concatenate([rng.normal(3, 1, 2800), rng.normal(-3, 1, 1200)])
    assert abs(pu.class_prior(pos, unl) - 0.7) < 0.05


# ---------------------------------------------------------------- 2: rules
def test_rules_match_sql(spark):
    assert compare(spark, "op2", E.queries()["op2_rule_cascade"], E.oracle_sql()["op2_rule_cascade"], SF, duck(SF))["ok"]


def test_rules_on_odd_tables(spark, odd, empty):
    got = {r.doc_id: r for r in rules.base_counts(odd).collect()}
    for i, t, *_ in ODD:
        w = [x.decode() for x in raw(t).split()]
        win = [tuple(w[k:k + 5]) for k in range(len(w) - 4)]
        cover = {k + j for k, g in enumerate(win) if win.count(g) > 1 for j in range(5)} if len(win) < 500 else set(range(len(w)))
        assert (got[i].n_words, got[i].n_repeat_words) == (len(w), len(cover))
        assert got[i].word_chars == sum(map(len, w))
    assert rules.base_counts(empty).count() == 0 and rules.kept(empty).columns == empty.columns


def test_cascade_verdict_does_not_depend_on_order(spark, odd):
    names = lambda ordered: sorted(map(str, odd.select("doc_id", rules.first_broken(rules.text_of(F.col("text")), ordered).isNull().alias("ok")).collect()))
    every = rules.BASE + rules.MORE
    assert names(every) == names(tuple(reversed(every)))
    ranked = rules.order_rules(odd)
    assert [r["selectivity"] / r["cost"] for r in ranked] == sorted((r["selectivity"] / r["cost"] for r in ranked), reverse=True)


def test_rules_plan_has_no_python(spark, odd):
    plan = rules.base_counts(odd)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan


# ---------------------------------------------------------------- 3: repeats
def covered(pairs, length):
    seen = {}
    for _, t in pairs:
        for k in range(len(t) - length + 1):
            seen[t[k:k + length]] = seen.get(t[k:k + length], 0) + 1
    out = []
    for i, t in pairs:
        m = np.zeros(len(t) + 1, int)
        for k in range(len(t) - length + 1):
            if seen[t[k:k + length]] > 1:
                m[k] += 1
                m[k + length] -= 1
        m = np.cumsum(m)[:-1] > 0
        kept = bytes(np.frombuffer(t, np.uint8)[~m])
        out.append((i, len(t), int(m.sum()), int((m & ~np.r_[False, m[:-1]]).sum()), hashlib.sha256(kept).hexdigest()))
    return sorted(map(str, out))


def test_repeats_on_odd_tables(odd, empty):
    assert sorted(str(tuple(r)) for r in repeats.report(odd).collect()) == covered([(i, raw(t)) for i, t, *_ in ODD], 400)
    assert repeats.report(empty).count() == 0
    kept = repeats.remove(odd)
    assert kept.columns == odd.columns and kept.count() == len(ODD)


@pytest.mark.parametrize("hot", [2, 4096])
def test_repeats_in_hot_groups(spark, hot):
    rng = np.random.default_rng(3)
    letters = np.array(list("abcdefgh"))
    common_part = "".join(rng.choice(letters, 700))
    rows = [(k, "".join(rng.choice(letters, 150 + k)) + common_part[k % 90:640 + k % 50] + "".join(rng.choice(letters, 200)))
            for k in range(24)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    spans = {r.doc_id: repeats.merged(r.a, r.b) for r in repeats.repeated_spans(docs, hot=hot).collect()}
    want = {eval(s)[0]: eval(s)[2:4] for s in covered([(i, t.encode()) for i, t in rows], 400)}
    for i, t in rows:
        got = spans.get(i, [])
        assert (sum(b - a for a, b in got), len(got)) == want[i]


def test_column_sort_finds_repeats_of_any_column():
    rng = np.random.default_rng(4)
    segs = [bytes(rng.integers(97, 99, rng.integers(8, 30), dtype=np.uint8)) for _ in range(60)]
    left = rng.integers(-6, 3, 60)
    group = np.sort(rng.integers(0, 3, 60))
    got = repeats.columns(segs, left, group, np.ones(60, int), length=8)
    for i, s in enumerate(segs):
        hit = {c for a, b in got[i] for c in range(a, b + 1)}
        for c in range(left[i], left[i] + len(s) - 7):
            mine = s[c - left[i]:c - left[i] + 8]
            same = any(j != i and group[j] == group[i] and c >= left[j] and segs[j][c - left[j]:c - left[j] + 8] == mine for j in range(60))
            assert (c in hit) == same


# ---------------------------------------------------------------- 4, 5, 6, 10: tokens
MULTI = P.path("byte_bpe_multi_50k.tiktoken")


def library():
    import tiktoken
    with open(MULTI, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    return tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={})


def test_bpe_equals_the_library(odd, empty, texts):
    enc, mine = library(), bpe.ByteBPE(MULTI, P.PATTERN)
    some = [t or "" for t in texts.values()] + [t or "" for _, t, *_ in ODD] + [" " * 700 + "x", "\U0003fac6's ՘a", "日本" * 300]
    for t, (ids, csv) in zip(some, mine.encode(some)):
        assert ids.tolist() == enc.encode_ordinary(t) and csv == ",".join(map(str, ids.tolist())) and mine.decode(ids) == t.encode()
    rows = {r.doc_id: r for r in bpe.round_trip(odd, MULTI, P.PATTERN).collect()}
    for i, t, *_ in ODD:
        assert rows[i].decoded_sha256 == hashlib.sha256(raw(t)).hexdigest()
    ids = bpe.encode(odd, MULTI, P.PATTERN)
    assert {(r.doc_id, bytes(r.decoded)) for r in bpe.decode(ids, MULTI, P.PATTERN).collect()} == {(i, raw(t)) for i, t, *_ in ODD}
    assert bpe.round_trip(empty, MULTI, P.PATTERN).count() == 0


def whole(path, some):
    from tokenizers import Tokenizer
    tok = Tokenizer.from_file(path)
    tok.encode_special_tokens = True
    return [e.ids for e in tok.encode_batch(some, add_special_tokens=False)]


@pytest.mark.parametrize("name, keeps", [("byte_bpe_50k.json", True), ("word_bpe_49k.json", False)])
def test_chunked_encoding_equals_the_library(texts, name, keeps):
    rng = np.random.default_rng(5)
    parts = ["a", "The", "İ", "Σ", "ß", "ÿ", "É", "́", " ", "  ", "\n", "\t", "\x1c", "\x85", "᠎", "　", "'s", "'", "1",
             "٣", "!", ".", ",", "|", "*#", "<|endoftext|>", "中", "😀", "ﬁ", "\xad"]
    some = [t or "" for t in texts.values()] + ["".join(rng.choice(parts, rng.integers(0, 25))) for _ in range(3000)]
    c = tokens.Chunked(P.path(name), keeps)
    got = [np.frombuffer(x, c.dtype).tolist() for x in c.encode(some)]
    assert got == whole(P.path(name), some)


def test_names_of_special_tokens_in_token_files_and_packing(spark):
    from tokenizers import Tokenizer
    rng = np.random.default_rng(12)
    parts = ["a", "The", "é", " ", "\n", "|", "<", ">", "<|endoftext|>", "<|startoftext|>", "<|ENDOFTEXT|>", "<|endoftext", "1"]
    some = ["a <|endoftext|> b", "plain text"] + ["".join(rng.choice(parts, rng.integers(0, 12))) for _ in range(300)]
    docs = spark.createDataFrame(list(enumerate(some)), "doc_id bigint, text string").repartition(3)
    plain = lambda n: [e.ids for e in Tokenizer.from_file(P.path(n)).encode_batch(some, add_special_tokens=False)]
    out = tokenfiles.write_files(docs, P.path("word_bpe_49k.json"), tokenfiles.new_folder(spark), False, 1, 49_408)
    want = plain("word_bpe_49k.json")
    assert want[0] == [320, 49407, 321]
    assert {r.doc_id: r.ids for r in tokenfiles.read_ids(spark, out).collect()} == {i: x + [1] for i, x in enumerate(want)}
    want = plain("byte_bpe_50k.json")
    assert want[0] == [64, 220, 50256, 275]
    got = packing.token_pieces(docs, P.path("byte_bpe_50k.json"), 2, with_ids=True).collect()
    assert {r.doc_id: r.ids for r in got} == {i: x + [2] for i, x in enumerate(want)}
    counts = {r.doc_id: r.n_tokens for r in separators.token_counts(docs, P.path("byte_bpe_50k.json"), 50_256).collect()}
    assert counts == {i: len(x) for i, x in enumerate(whole(P.path("byte_bpe_50k.json"), some))}


def test_huffman_code_is_optimal_and_limited():
    rng = np.random.default_rng(6)
    counts = (rng.zipf(1.3, 3000) % 10**6) * rng.integers(0, 2, 3000)
    n = tokenfiles.code_lengths(counts)
    assert n.max() <= tokenfiles.MAX_BITS and abs(sum(2.0 ** -int(k) for k in n[n > 0]) - 1) < 1e-12
    import heapq
    heap = [int(c) for c in counts if c]
    heapq.heapify(heap)
    best = 0
    while len(heap) > 1:
        x = heapq.heappop(heap) + heapq.heappop(heap)
        best += x
        heapq.heappush(heap, x)
    assert int((counts.astype(np.int64) * n.astype(np.int64)).sum()) >= best and (n.max() == tokenfiles.MAX_BITS or int((counts.astype(np.int64) * n.astype(np.int64)).sum()) == best)
    code = tokenfiles.Code(n)
    for size in (0, 1, 255, 256, 257, 5000):
        ids = rng.choice(np.flatnonzero(counts), size)
        bits, marks = code.encode(ids)
        assert code.decode(bits, marks, size).tolist() == ids.tolist()


def test_token_files_round_trip(spark, odd, empty, monkeypatch):
    monkeypatch.setattr(tokenfiles, "PART_CHARS", 4000)
    path = P.path("word_bpe_49k.json")
    out = tokenfiles.write_files(odd, path, tokenfiles.new_folder(spark), False, 1, 49_408)
    rows = sorted(tokenfiles.read_files(spark, out).collect(), key=lambda r: r.start)
    want = sorted(((-1 if i is None else i, ids + [1]) for (i, *_), ids in zip(ODD, whole(path, [t or "" for _, t, *_ in ODD]))), key=lambda x: x[0])
    at = 0
    for r, (i, ids) in zip(rows, want, strict=True):
        data = np.array(ids, "<u4")
        assert (-1 if r.doc_id is None else r.doc_id, r.start, r.n_tokens, r.ids_crc32) == (i, at, len(ids), zlib.crc32(data.tobytes()))
        at += len(ids)
    assert sorted(tokenfiles.read_ids(spark, out).collect(), key=lambda r: r.start)[-1].ids == want[-1][1]
    assert tokenfiles.read_files(spark, tokenfiles.write_files(empty, path, tokenfiles.new_folder(spark), False, 1, 49_408)).count() == 0


def test_pieces_and_packing(spark, odd, empty):
    path = P.path("byte_bpe_50k.json")
    pieces = packing.token_pieces(odd, path, 2, with_ids=True)
    rows = packing.pack(pieces).collect()
    want = sorted(((i is None, i or 0), tuple(ids) + (2,)) for (i, *_), ids in zip(ODD, whole(path, [t or "" for _, t, *_ in ODD])))
    got = {}
    for r in sorted(rows, key=lambda r: (r.doc_id is None, r.doc_id or 0, r.start)):
        assert r.length == len(r.ids) <= 1024 and r.ids_crc32 == zlib.crc32(np.array(r.ids, "<u4").tobytes())
        got.setdefault((r.doc_id is None, r.doc_id or 0), []).append(r)
    for key, ids in want:
        mine = [r for r in got[key]]
        copies = sum(k == key for k, _ in want)
        assert sum(r.length for r in mine) == copies * len(ids) and all(r.length == 1024 for r in mine if r.piece > 0)
    fill = {}
    for r in sorted(rows, key=lambda r: (r.sequence_id, r.offset)):
        assert r.offset == fill.get(r.sequence_id, 0)
        fill[r.sequence_id] = r.offset + r.length
    assert max(fill.values()) <= 1024
    seqs = packing.sequences(packing.pack(pieces)).collect()
    assert sum(len(s.ids) for s in seqs) == sum(fill.values())
    assert packing.pack(packing.token_pieces(empty, path, 2)).count() == 0


def test_packing_is_near_the_bound_and_shards_stay_small(spark):
    rng = np.random.default_rng(7)
    n = rng.integers(1, 1024, 6000)
    rows = spark.createDataFrame([(int(x),) for x in n], "length int").repartition(5)
    got = packing.pack(rows, shard_pieces=2000)
    assert got.groupBy("sequence_id").agg(F.sum("length").alias("s")).agg(F.max("s")).first()[0] <= 1024
    assert got.select("sequence_id").distinct().count() <= 1.02 * n.sum() / 1024 + 3
    same = spark.range(3000).select(F.lit(400).alias("length"))
    assert packing.pack(same, shard_pieces=500).select("sequence_id").distinct().count() <= 1500 + 6


def test_local_search_empties_bins():
    lengths = np.array([6, 6, 4, 3, 3, 2])
    bins = [[0, 2], [1], [3, 4], [5]]
    assert len(packing.local_search(bins, lengths, 12)) == 2


@pytest.mark.parametrize("block", [1, 7, 1 << 17])
def test_separator_scan(odd, empty, block):
    path = P.path("byte_bpe_50k.json")
    if block == 1:
        odd = odd.where("length(text) < 100 OR text IS NULL")
    got = sorted((-1 if r.doc_id is None else r.doc_id, r.n_tokens) for r in separators.token_counts(odd, path, 50_256, block_ids=block).collect())
    some = [(i, t or "") for i, t, *_ in ODD if block > 1 or len(t or "") < 100]
    assert got == sorted((-1 if i is None else i, len(ids)) for (i, _), ids in zip(some, whole(path, [t for _, t in some])))
    assert separators.token_counts(empty, path, 50_256).count() == 0


def test_separator_scan_of_an_unclosed_file(spark):
    pay = [np.array(x, "<u2").tobytes() for x in ([5, 0, 0, 7], [8], [], [9, 0, 3])]
    blocks = spark.createDataFrame([(1, k, bytearray(p), 2) for k, p in enumerate(pay)] + [(2, 0, None, 2)],
                                   "file int, block int, payload binary, itemsize int")
    rows = sorted(tuple(r) for r in separators.scan(blocks, 0).collect())
    assert rows == [(1, 0, 0, 1, True), (1, 1, 2, 0, True), (1, 2, 3, 3, True), (1, 3, 7, 1, False)]


# ---------------------------------------------------------------- 7: near duplicates
def by_pairs(pairs, distance=3):
    fp = [simhash.fingerprint(raw(t)) for _, t in pairs]
    root = list(range(len(fp)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a in range(len(fp)):
        for b in range(a):
            if (fp[a] ^ fp[b]).bit_count() <= distance:
                root[find(a)] = find(b)
    ids = {}
    for k, (i, _) in enumerate(pairs):
        if i is not None:
            ids[find(k)] = min(i, ids.get(find(k), i))
    return sorted(str((i, f"{fp[k]:016x}", ids.get(find(k)))) for k, (i, _) in enumerate(pairs))


def test_simhash_equals_all_pairs(spark, odd, empty, texts):
    assert sorted(str(tuple(r)) for r in simhash.near_duplicates(odd).collect()) == by_pairs([(i, t) for i, t, *_ in ODD])
    got = sorted(str(tuple(r)) for r in E.queries()["op7_simhash"](spark, SF).collect())
    assert got == by_pairs(list(texts.items()))
    assert simhash.near_duplicates(empty).count() == 0


def test_simhash_links_connect_dense_groups(spark):
    rng = np.random.default_rng(8)
    base = rng.integers(0, 2**63, 4, dtype=np.uint64)
    fps = {int(b) ^ sum(1 << int(k) for k in rng.choice(64, rng.integers(0, 4), replace=False)) for b in base for _ in range(150)}
    signed = sorted(f - (1 << 64) if f >= 1 << 63 else f for f in fps)
    found = simhash.links(spark.createDataFrame([(f,) for f in signed], "fp bigint"))
    got = {r.node: r.root for r in simhash.components(found).collect()}
    root = {f: f for f in signed}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a in signed:
        for b in signed:
            if a < b and ((a ^ b) & (2**64 - 1)).bit_count() <= 3:
                x, y = find(a), find(b)
                root[max(x, y)] = min(x, y)
    assert {f: got.get(f, f) for f in signed} == {f: find(f) for f in signed}


def test_keep_one_of_each_group(odd):
    kept = simhash.keep_one(odd)
    ids = [r.doc_id for r in kept.collect()]
    assert kept.columns == odd.columns and sorted(i for i in ids if i is not None) == sorted(set(i for i in ids if i is not None))
    assert 1 in ids and 2 not in ids and 3 not in ids and 5 in ids and 6 not in ids


def test_keep_one_keeps_a_row_of_every_component_where_ids_repeat_or_are_null(spark):
    rng = np.random.default_rng(11)
    base = [" ".join(rng.choice([f"w{k}" for k in range(900)], 60)) for _ in range(12)]
    rows = [(5, base[0]), (5, base[1]), (3, base[2]), (5, base[2]), (None, base[3]), (None, base[3]), (None, base[3] + " "),
            (8, base[4]), (None, base[4]), (None, base[5]), (6, base[6]), (6, base[6]), (4, base[6]), (None, None), (None, " ")]
    rows += [(9, b) for b in base[7:]] + [(7, b) for b in base[7:9]]
    docs = spark.createDataFrame([(i, t, k) for k, (i, t) in enumerate(rows)], "doc_id bigint, text string, place int").repartition(4)
    # each group of this table is a text, up to white space
    want = {}
    for i, t in rows:
        t = (t or "").strip()
        want[t] = min(want.get(t, (True, 0)), (i is None, i or 0))
    kept = simhash.keep_one(docs)
    got = [((r.text or "").strip(), (r.doc_id is None, r.doc_id or 0)) for r in kept.collect()]
    assert kept.columns == docs.columns and sorted(got) == sorted(want.items())
    assert simhash.keep_one(docs.drop("place")).count() == len(want)       # rows that agree in every column


# ---------------------------------------------------------------- 9: neighbours
def test_neighbours_recall_and_scores(spark):
    sf = "/root/testdata/sf0.01"
    rows = spark.read.parquet(f"{sf}/embeddings.parquet").collect()
    x = {r.vec_id: np.array(r.embedding, float) for r in rows}
    cos = lambda a, b: float((a * b).sum() / (np.sqrt((a * a).sum()) * np.sqrt((b * b).sum())))
    got = E.queries()["op9_learned_partitions"](spark, sf).collect()
    hit = 0
    for q in (i for i in x if i % 50 == 0):
        mine = sorted((r for r in got if r.query_id == q), key=lambda r: r.rank)
        assert [r.rank for r in mine] == [1, 2, 3, 4, 5]
        assert all(abs(r.score - cos(x[q], x[r.vec_id])) < 1e-12 for r in mine)
        best = sorted((-cos(x[q], v), i) for i, v in x.items() if i != q)[:5]
        hit += len({i for _, i in best} & {r.vec_id for r in mine})
    assert hit >= 0.9 * len(got)


def test_neighbours_on_odd_tables(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, 0.0]), (1, [2.0, 0.0]), (2, [0.0, 1.0]), (3, None), (4, [0.0, 0.0]), (5, [nan, 1.0]), (6, [inf, 0.0]), (7, [None, 1.0]),
            (None, [1.0, 1.0]), (50, [1.0, 1.0]), (8, [1.0, 0.0]), (8, [1.0, 0.0])]
    v = spark.createDataFrame([(i, e, 1.0, 2) for i, e in rows], "vec_id bigint, embedding array<float>, score double, p int")
    got = ann.search(v, v.where("vec_id % 50 = 0")).collect()
    by = lambda q: [(r.rank, r.vec_id) for r in sorted(got, key=lambda r: r.rank) if r.query_id == q]
    assert by(0) == [(1, 1), (2, 8), (3, 8), (4, 50), (5, 2)]
    assert [i for _, i in by(50)] == [0, 1, 2, 8, 8]
    assert ann.search(v.where("false"), v.where("false")).count() == 0


def test_equal_vectors_are_spread_over_blocks(spark, monkeypatch):
    monkeypatch.setattr(ann, "BLOCK", 50)
    rng = np.random.default_rng(9)
    rows = [(i, [1.0, 2.0, 3.0] if i % 3 else rng.normal(size=3).tolist()) for i in range(600)]
    v = spark.createDataFrame(rows, "vec_id bigint, embedding array<double>")
    got = ann.search(v, v.where("vec_id IN (1, 2)"), parts=4, target=1.1).orderBy("query_id", "rank").collect()
    assert [r.vec_id for r in got] == [2, 4, 5, 7, 8, 1, 4, 5, 7, 8] and all(abs(r.score - 1) < 1e-12 for r in got)


# ---------------------------------------------------------------- the pipeline
def test_pipeline_stages(spark):
    sf = "/root/testdata/sf0.01"
    docs, kept = common.documents(spark, sf), []
    for name, stage in corpus_pipeline.STAGES:
        out = common.stored(stage(spark, docs, sf), "test-stage")
        kept.append((name, docs, out))
        docs = out
    columns = common.documents(spark, sf).columns
    assert all(out.columns == columns for _, _, out in kept[:-1])
    toxic, rule, near, cut, packed = [(a, b) for _, a, b in kept]
    labels = spark.read.parquet(f"{sf}/labels.parquet")
    clean = toxic[0].join(labels.where("toxic = 0"), "doc_id", "left_semi")
    assert toxic[1].join(clean, "doc_id", "left_semi").count() >= 0.98 * clean.count()
    verdict = {r.doc_id: r.kept for r in rules.base_counts(rule[0]).collect()}
    assert {r.doc_id for r in rule[1].collect()} == {i for i, ok in verdict.items() if ok}
    groups = simhash.near_duplicates(near[0]).select("doc_id", "component_id").collect()
    assert sorted(r.doc_id for r in near[1].collect()) == sorted({r.component_id for r in groups})
    removed = {r.doc_id: r.n_bytes - r.n_removed for r in repeats.report(cut[0]).collect()}
    for r in cut[1].collect():
        assert removed[r.doc_id] - 8 <= len(raw(r.text)) <= removed[r.doc_id] and r.n_chars == len(r.text or "")
    ids = dict(zip([r.doc_id for r in packed[0].collect()], whole(P.path("byte_bpe_50k.json"), [r.text or "" for r in packed[0].collect()])))
    sums = {r.doc_id: r.n for r in packed[1].groupBy("doc_id").agg(F.sum("length").alias("n")).collect()}
    assert sums == {i: len(x) + 1 for i, x in ids.items()}


def test_stages_pass_columns_of_any_name(spark):
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    names = ["_n", "__n", "a.b", "c`d", "__score", "__broken", "__id", "__th", "__a", "fp", "component_id", "rank", "node"]
    docs = common.documents(spark, SF).where("doc_id < 60")
    more = docs.withColumns({c: F.col("doc_id") + k for k, c in enumerate(names)}).withColumn(
        "m", F.create_map(F.lit("k"), F.col("doc_id")))
    for keep in (lambda d: crf.not_toxic(d, labels), rules.kept, simhash.keep_one, repeats.remove):
        want, got = keep(docs), keep(more)
        assert got.columns == more.columns
        assert sorted(map(str, want.collect())) == sorted(str(r) for r in got.select(*docs.columns).collect())
        assert all(r["a.b"] == r.doc_id + 2 and r["m"] == {"k": r.doc_id} for r in got.collect())


def test_packing_passes_columns_of_any_name(spark):
    rows = spark.createDataFrame([(i, 1 + i % 700, i, i, "x") for i in range(50)], "doc_id int, length int, __shard int, __tie int, offset string")
    got = packing.pack(rows).collect()
    assert sorted((r["__shard"], r["__tie"]) for r in got) == [(i, i) for i in range(50)]


def test_samples_stay_bounded_where_an_id_repeats(spark):
    docs = spark.createDataFrame([(i % 2, f"text {i}") for i in range(400)], "doc_id int, text string")
    labels = spark.createDataFrame([(i % 2, i % 2) for i in range(40)], "doc_id int, toxic int")
    got = common.train_rows(docs, labels, "toxic", 5, 100).collect()
    fitted = [i for i in (0, 1) if zlib.crc32(str(i).encode()) % 5]
    assert sorted((r.text, r.label) for r in got) == [(f"text {i}", i) for i in fitted]


@pytest.mark.parametrize("size", [0, 40])
def test_full_caches_change_no_ids(texts, monkeypatch, size):
    some = [texts[i] or "" for i in sorted(texts)[:40]] + ["y" * 5000, "y" * 5000 + " z"]
    monkeypatch.setattr(tokens, "CACHE_BYTES", size)
    monkeypatch.setattr(bpe, "CACHE_CHARS", size)
    tok = tokens.Chunked(P.path("word_bpe_49k.json"), False)
    one = bpe.ByteBPE(P.path("byte_bpe_multi_50k.tiktoken"), P.PATTERN)
    for lo in range(0, len(some), 5):
        part = some[lo:lo + 5]
        assert tok.encode(part) == tok._whole(part)
        assert [one.decode(ids) for ids, _ in one.encode(part)] == [t.encode() for t in part]


def test_pipeline_takes_an_empty_table(spark):
    docs = common.documents(spark, SF).where("false")
    for _, stage in corpus_pipeline.STAGES:
        docs = common.stored(stage(spark, docs, SF), "test-empty")
        assert docs.count() == 0


def test_marks_counted_in_spark_are_those_of_the_plain_count(spark):
    rows = [(t, int(y)) for t, _, y, held in labelled(spark) if y is not None and t and not held]
    texts, toxic = [t for t, _ in rows], np.array([y for _, y in rows])
    want = crf.token_labels([crf._lower_words(t) for t in texts], toxic)
    got = crf.marks_of(spark.createDataFrame(rows, "text string, label int").repartition(5))
    assert want and got == want


def test_marks_when_no_text_of_a_task_has_evidence_left(spark):
    # one task's toxic texts are all explained by the first marks: it has no feature to count
    rows = [(f"vileword number{k} vileword", 1) for k in range(40)] + [(f"plain text number{k}", 0) for k in range(40)]
    assert "w:vileword" in crf.marks_of(spark.createDataFrame(rows, "text string, label int").repartition(3))


def test_field_fitted_in_blocks_is_that_of_one_block(monkeypatch):
    rng = np.random.default_rng(4)
    words = [f"w{i}" for i in range(60)]
    made = [" ".join([*rng.choice(words, int(rng.integers(0, 40))), *(["vile"] if k % 3 == 0 else [])]) for k in range(60)]
    toxic = np.array([int(k % 3 == 0) for k in range(60)])
    whole = crf.train_field(made, toxic, {"w:vile"})
    monkeypatch.setattr(crf, "TRAIN_BLOCK", 100)
    parts = crf.train_field(made, toxic, {"w:vile"})
    assert np.allclose(whole.trans, parts.trans) and np.allclose(whole.scale, parts.scale) and whole.bias == pytest.approx(parts.bias)
    assert whole.weights == pytest.approx(parts.weights)


def test_toxic_texts_are_found_not_only_clean_ones_passed(spark):
    sf = "/root/testdata/sf0.01"
    got = E.queries()["op8_crf_toxicity"](spark, sf).join(spark.read.parquet(f"{sf}/labels.parquet"), "doc_id").collect()
    toxic = [r for r in got if r.toxic == 1]
    # a constant answer finds none, or flags every clean text
    assert np.mean([r.predicted for r in toxic]) >= 0.6 and np.mean([r.predicted for r in got if r.toxic == 0]) <= 0.05


def test_score_and_tag_cut_tokens_alike():
    field = crf.train_field(["vile İstanbul x" if k % 2 else "plain words here" for k in range(60)],
                            np.array([k % 2 for k in range(60)]))
    texts = ["İİ vile İstanbul", "ﬁne ǅ words", ""]
    assert np.allclose(crf.tag(field, texts)[0], crf.score_texts(field, texts))


def test_search_empties_bins_of_a_poor_start():
    rng = np.random.default_rng(8)
    lengths = rng.integers(20, 700, 1500)
    start, room = [], []                                   # next fit in the order of arrival
    for i, n in enumerate(lengths.tolist()):
        if not start or room[-1] < n:
            start.append([])
            room.append(1024)
        start[-1].append(i)
        room[-1] -= n
    before = [list(b) for b in start]
    found = packing.local_search(start, lengths, 1024)
    assert sorted(i for b in found for i in b) == list(range(1500))
    assert all(lengths[b].sum() <= 1024 for b in found)
    squares = lambda bins: sum(int(lengths[b].sum()) ** 2 for b in bins)
    assert squares(found) > squares(before) and len(found) < 0.9 * len(before)
    assert len(found) >= packing.fewest(lengths, 1024)


def test_packing_keeps_columns_of_any_name_and_type(spark):
    df = spark.createDataFrame([(i, None if i % 3 else 2**60 + i, i, None, 1 + i % 50, [i]) for i in range(200)],
                               "`a.b` bigint, `__no_doc_id` bigint, doc_id bigint, `__row` string, length int, `x y` array<int>")
    got = packing.pack(df, capacity=64, shard_pieces=50)
    assert got.columns == [*df.columns, "sequence_id", "offset"] and got.drop("sequence_id", "offset").exceptAll(df).count() == 0
    rows = got.collect()
    assert len(rows) == 200
    by: dict = {}
    for r in rows:
        by.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for parts in by.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= 64


def test_neighbours_of_extreme_and_ragged_vectors(spark):
    rows = [(0, [1e200, 1e200]), (1, [1e-200, 0.0]), (2, [0.0, 1e300]), (3, [5e-324, 0.0]), (4, [1.0, 1.0]), (5, [1.0, 2.0, 3.0]),
            (6, [1.0, 2.0, 2.0]), (7, [1.0]), (8, []), (9, [-1e308, -1e308])]
    v = spark.createDataFrame(rows, "vec_id bigint, embedding array<double>")
    got = ann.search(v, v).collect()
    by = lambda q: [(r.vec_id, round(r.score, 9)) for r in sorted(got, key=lambda r: r.rank) if r.query_id == q]
    half = round(0.5 ** 0.5, 9)
    assert by(0) == [(4, 1.0), (1, half), (2, half), (3, half), (9, -1.0)]
    assert by(1) == [(3, 1.0), (0, half), (4, half), (2, 0.0), (9, -half)]
    assert [i for i, _ in by(5)] == [6] and [i for i, _ in by(6)] == [5] and by(7) == [] and by(8) == []


def test_clustered_vectors_need_few_partitions(spark):
    rng = np.random.default_rng(12)
    centres = rng.normal(size=(60, 32))
    x = centres[rng.integers(0, 60, 6000)] + 0.15 * rng.normal(size=(6000, 32))
    router = ann.learn(x[:3000], 16)
    u = ann.unit(x)
    home, asked = router.place(u), router.probes(u[:200])
    s = u[:200] @ u.T
    s[np.arange(200), np.arange(200)] = -2
    near = np.argsort(-s, axis=1)[:, :5]
    assert np.mean([np.isin(home[n], p).mean() for n, p in zip(near, asked)]) >= 0.9
    size = np.bincount(home, minlength=16)
    assert np.mean([size[p].sum() for p in asked]) < 0.25 * len(x)


def test_queries_of_a_partition_are_dealt_over_blocks(spark, monkeypatch):
    rng = np.random.default_rng(13)
    v = spark.createDataFrame([(i, rng.normal(size=4).tolist()) for i in range(300)], "vec_id bigint, embedding array<double>")
    whole = sorted(map(tuple, ann.search(v, v, target=1.1).collect()))
    monkeypatch.setattr(ann, "BLOCK", 30)
    monkeypatch.setattr(ann, "QUERY_BLOCK", 20)
    assert sorted(map(tuple, ann.search(v, v, target=1.1).collect())) == whole


def nearest_by_hand(ids, x, asked, k=5):
    u = x / np.linalg.norm(x, axis=1, keepdims=True)
    out = {}
    for q in asked:
        s = u @ u[q]
        out[int(ids[q])] = [int(ids[i]) for i in np.lexsort((ids, -s)) if ids[i] != ids[q]][:k]
    return out


def test_the_sample_of_vectors_does_not_pass_the_driver_task_by_task(spark):
    rows = spark.range(0, 40_000, 1, 40).select(F.col("id").alias("vec_id"), F.transform(
        F.sequence(F.lit(1), F.lit(8)), lambda j: F.xxhash64("id", j) / F.lit(2.0**63)).alias("embedding"))
    conf = spark._jsc.sc().conf()
    most = conf.get("spark.driver.maxResultSize", "1g")
    conf.set("spark.driver.maxResultSize", "2m")           # 40 tasks with a sample of 1,000 each have 5 MB
    try:
        got = ann.search(rows, rows.where("vec_id % 4000 = 7"), parts=4, target=1.1, sample=1000).orderBy("query_id", "rank").collect()
    finally:
        conf.set("spark.driver.maxResultSize", most)
    x = np.array([r.embedding for r in rows.orderBy("vec_id").collect()])
    want = nearest_by_hand(np.arange(40_000), x, range(7, 40_000, 4000))
    assert {q: [r.vec_id for r in got if r.query_id == q] for q in want} == want


def test_a_query_goes_to_a_cell_of_partitions_once(spark, monkeypatch):
    rng = np.random.default_rng(14)
    x = rng.normal(size=(900, 6)).astype(np.float32)
    v = spark.createDataFrame([(i, e.tolist()) for i, e in enumerate(x)], "vec_id bigint, embedding array<float>")
    monkeypatch.setattr(ann, "CELLS", 3)
    got = ann.search(v, v.where("vec_id % 9 = 0"), parts=16, target=1.1).orderBy("query_id", "rank")
    plan = got._jdf.queryExecution().optimizedPlan().toString()
    assert "MapInArrow" in plan and "FlatMapGroups" not in plan
    want = nearest_by_hand(np.arange(900), x.astype(float), range(0, 900, 9))
    assert {q: [r.vec_id for r in got.collect() if r.query_id == q] for q in want} == want
    cells = ann._by_cell([np.arange(16), np.array([4, 1]), np.array([-6])], 3).to_pylist()
    assert [[(c["cell"], c["probes"]) for c in row] for row in cells] == [
        [(0, [0, 3, 6, 9, 12, 15]), (1, [1, 4, 7, 10, 13]), (2, [2, 5, 8, 11, 14])], [(1, [1, 4])], [(0, [-6])]]


def test_rows_of_the_querys_id_push_out_no_others(spark):
    rows = [(0, [1.0, 0.001 * j]) for j in range(9)] + [(i, [1.0, float(i)]) for i in range(1, 8)]
    v = spark.createDataFrame(rows, "vec_id bigint, embedding array<float>")
    got = ann.search(v, v.where("vec_id = 0").limit(1), target=1.1).orderBy("rank").collect()
    assert [r.vec_id for r in got] == [1, 2, 3, 4, 5]


def test_blocks_find_the_nearest_of_all_rows(monkeypatch):
    for name, value in (("QUERIES_AT_ONCE", 16), ("PAIRS_AT_ONCE", 50)):
        monkeypatch.setattr(ann, name, value)
    for seed in range(40):
        rng = np.random.default_rng(seed)
        n, k = int(rng.integers(1, 200)), int(rng.integers(1, 7))
        x = rng.normal(size=(n, int(rng.integers(1, 6)))).astype([np.float32, np.float64][seed % 2])
        x = np.round(x) + 0.5 if seed % 3 == 0 else x      # ties
        x[rng.random(n) < 0.4] = 3 * x[0]                  # equal vectors
        x = x * (10.0 ** rng.integers(-20, 20, (n, 1))).astype(x.dtype) if seed % 5 == 0 else x
        ids = rng.integers(0, n, n) if seed % 4 == 0 else rng.permutation(n)
        asked = rng.integers(0, n, 30)
        block = ann.Block(ids[asked], x[asked], k)
        for lo in range(0, n, 23):
            block.add(np.arange(25), ids[lo:lo + 23], x[lo:lo + 23])
        all_of = ann.scaled(x.astype(float))
        for i, q in enumerate(asked):
            s = ann.cosines(np.repeat(all_of[q:q + 1], n, 0), ann.norms(all_of)[q], all_of, ann.norms(all_of))
            want = sorted((-s[j], ids[j]) for j in range(n) if ids[j] != ids[q])[:k] if i < 25 else []
            some = block.score[i] > -np.inf
            assert [*zip(-block.score[i][some], block.found[i][some])] == want
