"""Packing: exact round trip of the tokens, and validity of every sequence."""

import random
import zlib
from collections import Counter, defaultdict

import numpy as np
from conftest import SF_SMALL
from tokenizers import Tokenizer

from tablekit.llm import packing as P
from tablekit.llm.queries import op4_best_fit_packing, tokenizer_path
from tablekit.llm.wordcodes import codes_for


def check(rows, texts, capacity):
    """rows: (doc_id, piece, start, length, ids, crc, sequence, offset)."""
    tokens = Tokenizer.from_file(tokenizer_path())
    want = Counter()
    for d, t in texts:
        ids = tokens.encode(t or "", add_special_tokens=False).ids + [0]
        for p, a in enumerate(range(0, len(ids), capacity)):
            cut = np.asarray(ids[a:a + capacity], dtype="<u4").tobytes()
            want[d, p, a, len(cut) // 4, zlib.crc32(cut)] += 1
    assert Counter((d, p, s, n, c) for d, p, s, n, _, c, _, _ in rows) == want
    bins = defaultdict(list)
    for r in rows:
        bins[r[6]].append((r[7], r[3]))
    for parts in bins.values():
        at = 0
        for offset, n in sorted(parts):
            assert offset == at
            at += n
        assert at <= capacity
        assert sum(3 * n > capacity for _, n in parts) <= 2
    return len(bins), sum(n for parts in bins.values() for _, n in parts)


def test_query_on_all_documents(spark):
    docs = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{SF_SMALL}/documents.parquet").select("doc_id", "text").collect()]
    rows = [(r["doc_id"], r["piece"], r["start"], r["length"], None, r["ids_crc32"], r["sequence_id"], r["offset"])
            for r in op4_best_fit_packing(spark, SF_SMALL).collect()]
    n, total = check(rows, docs, 2048)
    assert n <= -(-total // 2048) * 1.02 + 1


def test_nulls_ties_repeats_and_long_texts(spark, prose=None):
    rnd = random.Random(1)
    texts = [(1, None), (1, None), (None, ""), (2, "word " * 700), (3, "<|endoftext|> it's l'été ½ 日本 Ｆｕｌｌ"), (4, "\x1c\x85 \xa0a\xa0b"),
             *[(10 + i, " ".join(rnd.choice(["one", "Two", "x9", "é!"]) for _ in range(rnd.randint(0, 60)))) for i in range(120)]]
    frame = spark.createDataFrame([(*t, "s") for t in texts], "doc_id long, text string, length string").repartition(5)
    for capacity in (16, 64):
        out = P.pack_documents(frame, tokenizer_path(), capacity)
        rows = [tuple(r) for r in out.collect()]
        rows = [(r[0], r[1], r[2], r[3], r[4], r[5], r[6], r[7]) for r in rows]
        n, total = check(rows, texts, capacity)
        assert n <= -(-total // capacity) * 1.1 + 1
        whole = {r["sequence_id"]: bytes(r["ids"]) for r in P.sequences(out).collect()}
        for d, p, s, length, ids, _, seq, offset in rows:
            assert whole[seq][4 * offset:4 * (offset + length)] == bytes(ids)


def test_plan_of_any_histogram_is_valid():
    rnd = random.Random(3)
    for _ in range(200):
        capacity = rnd.choice([1, 2, 3, 10, 50, 2048])
        histogram = Counter(rnd.randint(1, capacity) for _ in range(rnd.choice([0, 1, 7, 400])))
        bins, ranks = defaultdict(list), defaultdict(list)
        for n, a, b, first, per, offset in P.plan_bins(dict(histogram), capacity):
            for r in range(a, b):
                ranks[n].append(r)
                bins[first + (r - a) // per].append((offset + (r - a) % per * n, n))
        assert {n: sorted(r) for n, r in ranks.items()} == {n: list(range(c)) for n, c in histogram.items()}
        for parts in bins.values():
            at = 0
            for offset, n in sorted(parts):
                assert offset == at
                at += n
            assert at <= capacity


def test_word_codes_equal_the_tokenizer():
    rnd = random.Random(4)
    pool = "ab'sSTRe .,!?ßÿÀ×÷ªµº²é1९\n\t\r\x0b\x1c\x85\xa0́Åk日<|>_~"
    texts = ["".join(rnd.choice(pool) for _ in range(rnd.randint(0, 60))) for _ in range(3000)]
    tokens, codes = Tokenizer.from_file(tokenizer_path()), codes_for(tokenizer_path())
    for t, e in zip(texts, tokens.encode_batch(texts, add_special_tokens=False)):
        assert np.frombuffer(codes.encode(t), "<u4").tolist() == e.ids, t


def test_empty_table(spark):
    assert P.pack_documents(spark.createDataFrame([], "doc_id long, text string"), tokenizer_path()).count() == 0
