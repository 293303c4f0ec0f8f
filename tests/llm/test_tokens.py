import random
from zlib import crc32

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from citylode.llm import encoder, packing, repair, separators, token_files, topk, url_filter

VOCABULARY = public_tokenizers.path("word_bpe_49k.json")
ODD = ["", None, "  \n", "it's İstanbul ΣΑΣ ﬁne don't we'll e\u0301 <|endoftext|>x 12,345.67 x² \u2003y\u200bq",
       "a\x1cb\x85c", "日本語 テスト 🎉🎉", "a_b-c/d e`f ~x", "O'Re O'RE 'Sx 's", "#", "# #", "Ünïcode, Wörter! (so) \"x\"",
       "w " * 40_000, "z" * 5_000]


def frame(spark, texts, start=0):
    return spark.createDataFrame([(start + i, t, 0, "x") for i, t in enumerate(texts)], "doc_id bigint, text string, start int, n string")


def test_encoder_is_the_library(monkeypatch):
    plain = Tokenizer.from_file(VOCABULARY)
    monkeypatch.setattr(encoder, "MEMO_ENTRIES", 3)
    chunks = encoder.Chunks(VOCABULARY, False)
    for text in ODD:
        assert np.frombuffer(chunks.encode(text), "<u2").tolist() == plain.encode(text or "", add_special_tokens=False).ids


def test_repair_round_trip():
    rng = np.random.default_rng(1)
    for ids in (np.zeros(0), [5], [5, 5], [5, 5, 5], np.zeros(5000), rng.integers(0, 9, 20_000), rng.integers(0, 49408, 3000),
                np.tile(rng.integers(0, 49408, 37), 200)):
        ids = np.asarray(ids, np.uint16)
        lengths = np.array([len(ids) // 3, 0, len(ids) - len(ids) // 3])
        data = repair.pack_shard(np.array([3, 9, 4]), lengths, ids, 49408)
        shard = repair.open_shard(data)
        assert (shard.ids() == ids).all() and shard.doc_ids.tolist() == [3, 9, 4]
        assert (np.concatenate([shard.document(k) for k in range(3)]) == ids).all()
        for _ in range(5):
            a, b = sorted(rng.integers(0, len(ids) + 1, 2).tolist())
            assert (shard.ids(a, b) == ids[a:b]).all()
    assert len(shard.symbols) < len(ids) / 4 and len(shard.rules)
    with pytest.raises(ValueError, match="shard"):
        repair.open_shard(b"none" + data[4:])


def plain_repair(ids, base, least):
    """One pair at a time, the most frequent first."""
    symbols, rules = ids.astype(np.uint32), 0
    while len(symbols) > 1:
        pairs = symbols[:-1].astype(np.uint64) << np.uint64(32) | symbols[1:]
        found, counts = np.unique(pairs, return_counts=True)
        if counts.max() < least:
            break
        where = np.flatnonzero(pairs == found[counts.argmax()])
        where = where[repair.taken_places(where)]
        used = symbols.copy()
        used[where] = base + rules
        used = np.delete(used, where + 1)
        if len(symbols) - len(used) < least:
            break
        symbols, rules = used, rules + 1
    return symbols, rules


def bits(symbols, rules, base=49408):
    width = max(16, int(base + rules).bit_length())
    return width * (len(symbols) + 2 * rules) + 8 * rules


def test_repair_goes_on_to_its_end():
    """No pair is left that occurs often enough, and one pair at a time does not do much better."""
    encode = Tokenizer.from_file(VOCABULARY)
    rng = random.Random(11)
    words = ["the", "city", "counts", "bicycles", "every", "hour", "and", "air", "is", "measured", "at", "many", "sites"]
    phrases = [" ".join(rng.choices(words, k=rng.randrange(2, 7))) for _ in range(150)]
    ids = np.array(encode.encode(" ".join(rng.choice(phrases) for _ in range(4000))).ids, np.uint16)
    for sample in (ids, rng.choices(range(60), k=8000), np.repeat(ids[:300], 3), np.tile(ids[:500], 9)):
        sample = np.asarray(sample, np.uint16)
        symbols, rules = repair.compress(sample, 49408)
        counts = np.unique(np.column_stack([symbols[:-1], symbols[1:]]), axis=0, return_counts=True)
        left = {tuple(p): n for p, n in zip(counts[0].tolist(), counts[1].tolist(), strict=True)}
        assert all(n < repair.LEAST or (a == b and (n + 1) // 2 < repair.LEAST) for (a, b), n in left.items())
        assert bits(symbols, len(rules)) <= 1.02 * bits(*plain_repair(sample, 49408, repair.LEAST))
    whole = np.tile(ids[:1000], 40)  # a passage of 1,000 ids, repeated: not 16 ids a symbol
    assert repair.expansion_lengths(repair.compress(whole, 49408)[1], 49408).max() >= 1000


@pytest.mark.parametrize("width", [16, 17, 19, 32])
def test_packed_symbols(width):
    rng = np.random.default_rng(width)
    for n in (0, 1, 7, 8, 1001):
        symbols = rng.integers(0, 1 << width, n, dtype=np.uint32)
        data = repair.pack_symbols(symbols, width)
        assert len(data) == repair.packed_size(n, width) and (repair.unpack_symbols(data, n, width) == symbols).all()


def brute(texts, end):
    plain, start, out = Tokenizer.from_file(VOCABULARY), 0, []
    for i, t in enumerate(texts):
        ids = [*plain.encode(t or "", add_special_tokens=False).ids, end]
        out.append((i, start, len(ids), crc32(np.array(ids, "<u4"))))
        start += len(ids)
    return out


def test_token_files(spark):
    rng = random.Random(3)
    texts = ODD + [" ".join(rng.choices(["the", "then", "there", "other,"], k=rng.randrange(300))) for _ in range(80)]
    shards = token_files.token_files(spark, frame(spark, texts).orderBy(F.rand(1)), VOCABULARY, shard_ids=2000)
    assert shards.count() > 5
    got = token_files.documents_of(shards).collect()
    assert sorted((r.doc_id, r.start, r.n_tokens, r.ids_crc32) for r in got) == brute(texts, 2)


def test_token_files_odd_ids(spark):
    rows = spark.createDataFrame([(7, "b"), (None, "a"), (7, "b"), (7, "c c"), (1, None)], "doc_id bigint, text string")
    got = token_files.documents_of(token_files.token_files(spark, rows, VOCABULARY)).orderBy("start").collect()
    assert [r.doc_id for r in got] == [None, 1, 7, 7, 7] and [r.start for r in got][:3] == [0, 2, 3]
    assert sum(r.n_tokens for r in got) == 10
    assert token_files.documents_of(token_files.token_files(spark, rows.limit(0), VOCABULARY)).count() == 0
    least = spark.createDataFrame([(-(1 << 63), "a"), (None, "b"), (None, None), (0, "c")], "doc_id bigint, text string")
    got = token_files.documents_of(token_files.token_files(spark, least, VOCABULARY)).orderBy("start").collect()
    assert [r.doc_id for r in got] == [None, None, -(1 << 63), 0]


@pytest.mark.parametrize("block_ids", [1, 7, 1 << 20])
def test_separator_scan(spark, block_ids):
    texts = [*ODD[:11], "one two three four five six", "", "x"]
    special = Tokenizer.from_file(VOCABULARY)
    special.encode_special_tokens = True
    want = [(i, len(special.encode(t or "", add_special_tokens=False).ids)) for i, t in enumerate(texts)]
    docs = frame(spark, texts).repartition(3)
    got = separators.document_token_counts(spark, docs, VOCABULARY, block_ids=block_ids).collect()
    assert sorted((r.doc_id, r.n_tokens) for r in got) == want
    for file in {r.file for r in got}:
        at = sorted((r.start, r.n_tokens) for r in got if r.file == file)
        assert at[0][0] == 0 and all(a + n + 1 == b for (a, n), (b, _) in zip(at, at[1:]))
    assert separators.document_token_counts(spark, docs.limit(0), VOCABULARY).count() == 0


def test_separator_scan_of_unfinished_files(spark):
    end = 9
    files = {0: [[1, 2], [3, 9], [9, 4, 5]], 1: [[9, 9]], 2: [[1], [1]], 3: [[]], 4: [[7, 9], None]}
    rows = [(f, b, None if ids is None else np.array(ids, "<u2").tobytes()) for f, blocks in files.items() for b, ids in enumerate(blocks)]
    got = separators.count_tokens(spark.createDataFrame(rows, "file int, block int, ids binary"), end).collect()
    assert sorted((r.file, r.start, r.n_tokens, r.terminated) for r in got) == [
        (0, 0, 3, True), (0, 4, 0, True), (0, 5, 2, False), (1, 0, 0, True), (1, 1, 0, True), (2, 0, 2, False), (4, 0, 1, True)]


def test_url_filter_against_brute_force(spark):
    rules = [url_filter.Rule("allow", "com"), url_filter.Rule("block", "example.com", "/en/"),
             url_filter.Rule("allow", "www.example.com", "/en/"), url_filter.Rule("block", "net", "/es/"),
             url_filter.Rule("block", "a*b.org", "/x?"), *[url_filter.Rule("block", f"host{k}.test", "/p/") for k in range(30)]]
    rng = random.Random(5)
    hosts = ["com", "x.com", "EXAMPLE.com", "www.Example.COM", "a.www.example.com", "notexample.com", "net", "b.net", "a*b.org",
             "aab.org", "host3.test", "sub.host29.test", "example.com:80", "", "é.com", "org"]
    paths = ["", "/", "/en/", "/en", "/EN/x", "/es/1?q=/en/", "/x?", "/x", "/p/q#f", "/net/es/", "/x.com/en/", "#/", "?a=://b.com/"]
    urls = [rng.choice(["http://", "https://", "", "x", "://"]) + h + p for h in hosts for p in paths] + [None, "", "http", "a://" + "b/" * 9000]

    def judge(url):
        rest = url.split("://", 1)[1] if url and "://" in url else ""
        cut = min([rest.find(c) for c in "/?#" if c in rest] or [len(rest)])
        host = "".join(c.lower() if "A" <= c <= "Z" else c for c in rest[:cut])
        path = rest[cut:].split("?")[0].split("#")[0]
        fits = [r for r in rules if (host == r.host or host.endswith("." + r.host)) and path.startswith(r.path)]
        best = max(fits, key=lambda r: len(r.name), default=None)
        return host, path, best and best.name, best.verdict if best else "allow"

    pages = spark.createDataFrame([(i, u, "h") for i, u in enumerate(urls)], "page_id bigint, url string, host string")
    got = {r.page_id: tuple(r)[1:] for r in url_filter.judge_urls(pages, rules).collect()}
    assert got == {i: judge(u) for i, u in enumerate(urls)}
    assert {r.verdict for r in url_filter.judge_urls(pages, [], "block").collect()} == {"block"}
    assert url_filter.judge_urls(pages.limit(0), rules).count() == 0


def test_globs():
    globs = ["a*c", "a**c", "?b", "**", "\\*x", "", "a*" + "b" * 100 + "**"]
    texts = ["abc", "a/c", "ac", "xb", "/b", "*x", "zx", "", "a" + "b" * 100, "aqq" + "b" * 100 + "/z", "b" * 100]
    data = np.frombuffer("".join(texts).encode(), np.uint8)
    found = url_filter.Automaton(globs).run(data, np.cumsum([0, *map(len, texts)]))
    want = {0: ["abc", "ac"], 1: ["abc", "a/c", "ac"], 2: ["xb"], 3: texts, 4: ["*x"], 5: [""], 6: texts[8:10]}
    assert {k: [t for t, hit in zip(texts, found[:, k], strict=True) if hit] for k in want} == want


def test_top_k_against_brute_force(spark):
    rng = np.random.default_rng(4)
    vectors = rng.normal(size=(300, 9)).round(2)
    vectors[50:120] = vectors[7]  # a third of them alike
    rows = [(i, v.tolist()) for i, v in enumerate(vectors)]
    odd = [(900, None), (901, [1.0, None] + [0.0] * 7), (902, [float("nan")] * 9), (903, [float("inf")] * 9), (None, [0.5] * 9),
           (904, [1.0, 2.0]), (906, [3.0, 1.0]), (905, []), (908, [1e300] * 9), (910, [-0.0] * 9)]
    data = spark.createDataFrame([(i, v, "q") for i, v in rows + odd], "vec_id bigint, embedding array<float>, q string")
    whole = {i: np.floor(64 * np.array(v, np.float32).astype(float)).astype(int) for i, v in rows + [odd[5], odd[6], odd[7], odd[9]]}
    want = set()
    for q in (i for i in whole if i % 2 == 0):
        best = sorted((-int(whole[q] @ whole[i]), i) for i in whole if i != q and len(whole[i]) == len(whole[q]))[:20]
        want |= {(q, k + 1, i, -s) for k, (s, i) in enumerate(best)}
    for size in (64, 1000):
        got = topk.top_k(data, F.col("vec_id") % 2 == 0, index_rows=size, query_rows=50).collect()
        assert {tuple(r) for r in got} == want and len(got) == len(want)
    assert topk.top_k(data.limit(0), F.col("vec_id") % 2 == 0).count() == 0
    few = topk.top_k(data.filter("vec_id < 3"), F.col("vec_id") == 0, k=20).collect()
    assert len(few) == 2


def test_top_k_takes_large_vectors(spark):
    rng = np.random.default_rng(5)
    rows = [(i, v.tolist()) for i, v in enumerate(rng.normal(size=(60, 4)))]
    rows += [(100 + i, (10.0 ** (5 + i % 5) * v).tolist()) for i, v in enumerate(rng.normal(size=(40, 4)))]
    rows += [(200, [1e17, 0.0, 0.0, 0.0]), (201, [-1e17, 1.0, 0.0, 0.0]), (202, [-1.4e17] * 4), (203, [0.0] * 4)]
    whole = {i: [int(np.floor(64 * x)) for x in v] for i, v in rows}
    data = spark.createDataFrame([*rows, (204, [1e300] * 4)], "vec_id bigint, embedding array<double>")
    want = set()
    for q in (i for i in whole if i % 2 == 0):
        scores = {i: sum(a * b for a, b in zip(whole[q], v, strict=True)) for i, v in whole.items() if i != q}
        best = sorted((-s, i) for i, s in scores.items() if -2**63 <= s < 2**63)[:20]
        want |= {(q, k + 1, i, -s) for k, (s, i) in enumerate(best)}
    got = topk.top_k(data, F.col("vec_id") % 2 == 0, index_rows=40).collect()
    assert {tuple(r) for r in got} == want and len(got) == len(want)


def check_packing(pieces, counts, capacities):
    bins = {}
    for r in pieces:
        if r.length:
            bins.setdefault((r.bin_id, r.capacity), []).append((r.position, r.length))
    assert len({b for b, _ in bins}) == len(bins)
    for (_, capacity), items in bins.items():
        at = 0
        for position, length in sorted(items):
            assert position == at
            at += length
        assert capacity == min(c for c in capacities if c >= at)
    assert sum(r.length for r in pieces) == sum(max(n or 0, 0) for _, n in counts)
    return bins


def test_packing_is_whole_and_tight(spark):
    rng = random.Random(9)
    caps = (16, 32, 64)
    counts = [(i, rng.choice([1, 5, 5, 5, 5, 13, 17, 30, 64, 65, 200])) for i in range(800)]
    counts += [(None, 5), (3, 5), (3, 5), (5000, 0), (5001, None), (5002, -2), (5003, 128)]
    frame = spark.createDataFrame([(i, n, 1) for i, n in counts], "doc_id bigint, n_tokens bigint, piece int")
    got = packing.pack(spark, frame, caps).collect()
    bins = check_packing(got, counts, caps)
    assert sum(c for _, c in bins) <= 1.05 * sum(max(n or 0, 0) for _, n in counts)
    assert {r.doc_id for r in got if r.bin_id is None} == {5000, 5001, 5002}
    starts = sorted((r.start, r.length) for r in got if r.doc_id == 5003)
    assert starts == [(0, 64), (64, 64)]
    assert packing.pack(spark, frame.limit(0), caps).count() == 0


def test_plan_is_best_fit_and_does_not_grow_with_counts():
    plan = packing.plan_packing({10: 1, 6: 1, 4: 1}, (10, 16), lambda c: c)
    assert sorted(plan.run_content.tolist()) == [10, 10]
    rng = random.Random(2)
    histogram = {k: rng.randrange(1, 50) for k in range(1, 65)}
    once = packing.plan_packing(histogram, (16, 32, 64))
    many = packing.plan_packing({k: n * 10**6 for k, n in histogram.items()}, (16, 32, 64))
    assert len(many.rank) < 6 * len(once.rank) + 200
    for length, n in histogram.items():
        ranks = np.arange(n)
        bins, position, capacity = once.place(np.full(n, length), ranks)
        assert (position + length <= capacity).all()


def test_pack_documents_reads_whole_texts(spark):
    texts = [*ODD, "word " * 20_000, "a b c"]
    got = packing.pack_documents(spark, frame(spark, texts)).collect()
    counts = [(i, len((t or "").encode().split()) if t != "a\x1cb\x85c" else 1) for i, t in enumerate(texts)]
    check_packing(got, counts, packing.CAPACITIES)


def test_a_word_is_kept_once_and_tokenised_once(monkeypatch):
    chunks, asked = encoder.Chunks(VOCABULARY, False), []
    word = encoder.Chunks.word
    monkeypatch.setattr(encoder.Chunks, "word", lambda self, text: asked.append(text) or word(self, text))
    text = "Plain plain PLAIN plain, Plain; été Été, ÉTÉ"
    assert chunks.encode(text) == chunks.whole(text)
    assert asked == ["plain", "été"]
    assert not hasattr(chunks, "words") and {"plain", "été", ",", ";"} <= set(chunks)


def test_repair_looks_at_a_place_a_few_times(monkeypatch):
    """However many rounds there are, a place is counted when its pair arises and when the limit reaches it."""
    rng = random.Random(5)
    ids = np.array([int(rng.paretovariate(0.7)) % 5000 for _ in range(60_000)], np.uint16)
    counted, real = [], np.bincount
    monkeypatch.setattr(np, "bincount", lambda x, *a, **k: counted.append(len(x)) or real(x, *a, **k))
    repair.compress(ids, 49408)
    assert len(counted) > 15 and sum(counted) < 4 * len(ids)


@pytest.mark.parametrize("bits", [6, 31])
def test_pairs_are_sorted_with_their_places(bits):
    rng = np.random.default_rng(bits)
    left, right = rng.integers(0, 1 << bits, 500, dtype=np.uint32) | np.uint32(1), rng.integers(0, 9, 500, dtype=np.uint32)
    pairs, order = repair.by_pair(left, right, bits)
    assert order.tolist() == sorted(range(500), key=lambda i: (left[i], right[i], i))
    assert (pairs == (left[order].astype(np.uint64) << np.uint64(32) | right[order])).all()


def test_a_full_memo_keeps_what_is_met_again(monkeypatch):
    monkeypatch.setattr(encoder, "MEMO_ENTRIES", 20)
    chunks, asked = encoder.Chunks(VOCABULARY, False), []
    word = encoder.Chunks.word
    monkeypatch.setattr(encoder.Chunks, "word", lambda self, text: asked.append(text) or word(self, text))
    text = " ".join(f"often {a}{b}" for a in "abcdefgh" for b in "klmnopqrst")
    assert chunks.encode(text) == chunks.whole(text)
    assert asked.count("often") == 1 and len(chunks) + len(chunks.older) <= 40
